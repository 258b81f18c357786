"""The listing feeds as they are loaded."""

from __future__ import annotations

from lapseflow.operators.normalise import Feed
from lapseflow.sources import auctions

AUCTION_JSON = Feed("godaddy", auctions.auction_json, "domainName")
AUCTION_ARCHIVES = Feed("godaddy", auctions.zipped_auction_json, "domainName")
MARKET_CSV = Feed("sedo", auctions.market_csv, "Domain Name")
