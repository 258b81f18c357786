"""Fixed table layouts. Nothing is inferred at ingest; all times are UTC wall clock."""

from __future__ import annotations

# Source layout of one auction listing (key names are fixed by the feed).
AUCTION_ENTRY = (
    "domainName STRING, link STRING, auctionType STRING, auctionEndTime STRING, price STRING, "
    "numberOfBids INT, domainAge STRING, description STRING, pageviews INT, valuation STRING, "
    "monthlyParkingRevenue STRING, isAdult STRING"
)
AUCTION_ENVELOPE = f"meta STRING, data ARRAY<STRUCT<{AUCTION_ENTRY}>>"

# The marketplace file's column titles and the names used inside.
MARKET_COLUMNS = {
    "Domain Name": "name",
    "Start Time": "start_time",
    "End Time": "end_time",
    "Reserve Price": "reserve_price",
    "Domain is IDN": "domain_is_idn",
    "Domain has hyphen": "domain_has_hyphen",
    "Domain has numbers": "domain_has_numbers",
    "Domain Length": "domain_length",
    "TLD": "tld",
    "Traffic": "traffic",
}
MARKET_EXTRA = ("Link",)

STAGED = "name STRING, tld STRING, registrar STRING, expired STRING, registered STRING"
# Both sides of a batch file: real quotes, line breaks within them, and empty text apart from NULL.
STAGED_QUOTING = {
    "quote": '"', "escape": '"', "nullValue": "\\N", "multiLine": True,
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}

DIMENSION = "id INT, name STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"

DOMAIN = (
    "id STRING, name STRING, tld STRING, tld_id INT, registrar_id INT, "
    "expired TIMESTAMP_NTZ, registered TIMESTAMP_NTZ, has_wiki BOOLEAN, alexa_score INT, "
    "branding_score INT, attempts INT, last_attempt TIMESTAMP_NTZ, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)

# Answers of one run: each source's latest with its time, and the lookups that failed.
CHANGE = (
    "name STRING, tld STRING, "
    "alexa STRUCT<fetched_at: TIMESTAMP_NTZ, seq: BIGINT, answer: INT>, "
    "wiki STRUCT<fetched_at: TIMESTAMP_NTZ, seq: BIGINT, answer: BOOLEAN>, "
    "whois STRUCT<fetched_at: TIMESTAMP_NTZ, seq: BIGINT, "
    "answer: STRUCT<registered: TIMESTAMP_NTZ, expired: TIMESTAMP_NTZ>>, "
    "failed INT, answered_at TIMESTAMP_NTZ, failed_at TIMESTAMP_NTZ"
)

# Attribute tables of the feeds, one row per domain id, with the row's turn.
AUCTION_META = (
    "domain_id STRING, seq BIGINT, auctionType STRING, auctionEndTime TIMESTAMP_NTZ, "
    "price DECIMAL(19,2), numberOfBids INT, domainAge INT, description STRING, pageviews INT, "
    "valuation DECIMAL(19,2), monthlyParkingRevenue DECIMAL(19,2), isAdult BOOLEAN"
)
MARKET_META = (
    "domain_id STRING, seq BIGINT, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, "
    "reserve_price DECIMAL(19,2), domain_is_idn BOOLEAN, domain_has_hyphen BOOLEAN, "
    "domain_has_numbers BOOLEAN, domain_length INT, tld STRING, traffic INT"
)

RESPONSE = "domain STRING, source STRING, body STRING, fetched_at TIMESTAMP_NTZ, error STRING"

RECORDSET = (
    "p_id INT, first_name STRING, last_name STRING, p_attribute STRING, quote_content STRING"
)

# Limits of the stored text columns.
NAME_LIMIT = 256
TLD_LIMIT = 64
REGISTRAR_LIMIT = 63
