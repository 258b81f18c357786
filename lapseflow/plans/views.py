"""The inputs and shared steps stated in SQL, independently of the operators."""

from __future__ import annotations

import re

from lapseflow.functions.names import URL_NAMESPACE


def uuid_sql(text: str) -> str:
    """Version-3 UUID of a text expression in the URL namespace."""
    h = f"md5(from_hex('{URL_NAMESPACE}') || encode({text}))"
    return (
        f"substr({h},1,8) || '-' || substr({h},9,4) || '-3' || substr({h},14,3) || '-' || "
        f"substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr({h},17,1)), 1) || "
        f"substr({h},18,3) || '-' || substr({h},21,12)"
    )


def numbered(source: str) -> str:
    return (
        "SELECT CAST(row_number() OVER (ORDER BY md5(name), name) AS INTEGER) AS id, name "
        f"FROM (SELECT DISTINCT {source})"
    )


def latest_answer(columns: str, source: str) -> str:
    return (
        f"SELECT id, {columns} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY id ORDER BY fetched_at DESC, seq DESC) AS rn FROM {source}) q WHERE rn = 1"
    )


VIEWS: dict[str, str] = {
    "fx_listing": """
        SELECT o_orderkey AS seq,
               CASE WHEN o_orderkey % 2 = 0 THEN 'GoDaddy' ELSE 'sedo' END AS registrar,
               concat(CASE WHEN o_custkey % 3 = 0 THEN replace(p_name, ' ', '-')
                           WHEN o_custkey % 3 = 1
                             THEN concat(replace(p_name, ' ', ''), CAST(o_custkey AS VARCHAR))
                           ELSE split_part(p_name, ' ', 1) END,
                      CASE o_orderkey % 8 WHEN 0 THEN '.com' WHEN 1 THEN '.net' WHEN 2 THEN '.org'
                           WHEN 3 THEN '.io' WHEN 4 THEN '.COM' WHEN 5 THEN '.co.uk' WHEN 6 THEN ''
                           ELSE '.site' END) AS domain_name,
               o_orderdate AS auction_end, o_totalprice AS price
        FROM orders JOIN part ON p_partkey = o_custkey""",
    "fx_norm": """
        SELECT seq, lower(registrar) AS registrar, lower(split_part(domain_name, '.', 1)) AS name,
               lower(substr(domain_name, strpos(domain_name, '.') + 1)) AS tld, auction_end, price
        FROM fx_listing WHERE domain_name LIKE '%.%'""",
    "fx_domain": """
        SELECT name, tld, registrar, seq FROM (
            SELECT *, row_number() OVER (PARTITION BY name, tld ORDER BY seq) AS rn FROM fx_norm
        ) q WHERE rn = 1""",
    "fx_attr": """
        SELECT o_orderkey AS seq,
               concat('$', CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR), ',',
                      lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0')) AS price,
               CASE o_orderkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' END AS is_adult,
               CASE WHEN o_orderkey % 5 = 0 THEN 'n/a'
                    ELSE CAST(o_custkey % 30 AS VARCHAR) END AS domain_age,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS auction_end_time
        FROM orders""",
    "fx_registry": "SELECT name, tld, min(auction_end) AS created FROM fx_norm GROUP BY name, tld",
    "fx_dated": """
        SELECT d.*, r.created AS registered, r.created + INTERVAL 365 DAY AS expired
        FROM fx_domain d JOIN fx_registry r ON d.name = r.name AND d.tld = r.tld""",
    "fx_search": """
        SELECT name, tld, CAST(seq % 150 AS INTEGER) + 1 AS rank,
               CASE WHEN seq % 4 = 0 THEN concat(name, '.', tld) ELSE 'other.example.com' END AS host
        FROM fx_domain""",
    "fx_page_host": """
        SELECT page_id, lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) AS host FROM pages""",
    "fx_words": "SELECT DISTINCT split_part(p_name, ' ', 1) AS word FROM part",
    "fx_tld": numbered("tld AS name FROM fx_norm"),
    "fx_registrar": numbered("registrar AS name FROM fx_norm"),
    "fx_table": f"""
        SELECT {uuid_sql("d.name || '.' || d.tld")} AS id, d.name, d.tld, t.id AS tld_id,
               r.id AS registrar_id, l.auction_end AS updated_at
        FROM fx_domain d JOIN fx_norm l ON l.seq = d.seq
        JOIN fx_tld t ON t.name = d.tld JOIN fx_registrar r ON r.name = d.registrar""",
    "fx_bodies": """
        SELECT seq, fetched_at, event_type,
               CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN '<ALEXA/>'
                    ELSE concat('<REACH RANK="', CAST(user_id AS VARCHAR), '"/><COUNTRY RANK="3"/>')
                    END AS alexa,
               CASE WHEN event_type = 'error' THEN 'oops'
                    WHEN event_type = 'click' THEN '["q",["a","b"],[],[]]'
                    ELSE '["q",[],[],[]]' END AS wiki,
               CASE WHEN event_type = 'error' THEN '[]'
                    ELSE concat('[["statuscode"]', repeat(',["200"]', user_id % 5), ']') END AS archive,
               CASE event_type WHEN 'error' THEN NULL
                    WHEN 'click' THEN concat('{"creation_date":["', d, '","1990-01-01 00:00:00"],',
                                             '"expiration_date":["', x, '"]}')
                    WHEN 'view' THEN concat('{"creation_date":"', d, '","expiration_date":"', x, '"}')
                    WHEN 'signup' THEN '{"creation_date":null,"expiration_date":null}'
                    ELSE '{"creation_date":[],"expiration_date":[]}' END AS whois
        FROM (SELECT event_id AS seq, ts AS fetched_at, event_type, user_id,
                     concat('20', lpad(CAST(user_id % 20 AS VARCHAR), 2, '0'), '-03-15 00:00:00') AS d,
                     concat('20', lpad(CAST(user_id % 20 + 5 AS VARCHAR), 2, '0'),
                            '-03-15 00:00:00') AS x
              FROM events) e""",
    "fx_parsed": f"""
        SELECT b.seq, b.fetched_at, concat(n.name, '.', n.tld) AS domain,
               {uuid_sql("n.name || '.' || n.tld")} AS id, b.alexa, b.wiki, b.whois,
               CASE WHEN b.alexa IS NULL THEN NULL
                    ELSE coalesce(TRY_CAST(nullif(regexp_extract(b.alexa, 'RANK="(\\d+)"', 1), '')
                                  AS INTEGER), 0) END AS score,
               CASE WHEN json_valid(b.wiki) THEN json_array_length(b.wiki, '$[1]') > 0 END AS has_wiki,
               CASE json_type(b.whois, '$.creation_date')
                    WHEN 'ARRAY' THEN json_extract_string(b.whois, '$.creation_date[0]')
                    WHEN 'VARCHAR' THEN json_extract_string(b.whois, '$.creation_date')
                    END AS created_text,
               CASE json_type(b.whois, '$.expiration_date')
                    WHEN 'ARRAY' THEN json_extract_string(b.whois, '$.expiration_date[0]')
                    WHEN 'VARCHAR' THEN json_extract_string(b.whois, '$.expiration_date')
                    END AS expires_text,
               b.whois IS NOT NULL
                 AND coalesce(json_array_length(b.whois, '$.creation_date'), 0)
                     + CASE WHEN json_type(b.whois, '$.creation_date') = 'ARRAY' THEN 0 ELSE 1 END > 0
                 AND coalesce(json_array_length(b.whois, '$.expiration_date'), 0)
                     + CASE WHEN json_type(b.whois, '$.expiration_date') = 'ARRAY' THEN 0 ELSE 1 END > 0
                 AS usable
        FROM fx_bodies b JOIN fx_norm n ON n.seq = b.seq""",
    "fx_new_rank": latest_answer("score", "(SELECT * FROM fx_parsed WHERE score IS NOT NULL)"),
    "fx_new_wiki": latest_answer("has_wiki", "(SELECT * FROM fx_parsed WHERE has_wiki IS NOT NULL)"),
    "fx_new_dates": latest_answer(
        "CAST(created_text AS TIMESTAMP) AS registered, CAST(expires_text AS TIMESTAMP) AS expired",
        "(SELECT * FROM fx_parsed WHERE usable)",
    ),
    "fx_enriched": """
        SELECT t.id, t.name, t.tld, t.tld_id, t.registrar_id, r.score AS alexa_score, w.has_wiki,
               d.registered, d.expired,
               CASE WHEN r.id IS NOT NULL OR w.id IS NOT NULL OR d.id IS NOT NULL
                    THEN TIMESTAMP '1999-02-01 00:00:00' ELSE t.updated_at END AS updated_at,
               CASE WHEN t.id IN (SELECT id FROM fx_parsed
                                  WHERE score IS NULL OR has_wiki IS NULL OR NOT usable)
                    THEN TIMESTAMP '1999-02-01 00:00:00' END AS last_attempt
        FROM fx_table t LEFT JOIN fx_new_rank r ON r.id = t.id
        LEFT JOIN fx_new_wiki w ON w.id = t.id LEFT JOIN fx_new_dates d ON d.id = t.id""",
}


def _needed(sql: str) -> list[str]:
    return [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]


def with_views(sql: str) -> str:
    """Prefix a statement with the views it uses, directly or through others."""
    needed: set[str] = set()
    open_views = _needed(sql)
    while open_views:
        view = open_views.pop()
        if view not in needed:
            needed.add(view)
            open_views += _needed(VIEWS[view])
    if not needed:
        return sql
    parts = ", ".join(f"{v} AS ({VIEWS[v]})" for v in VIEWS if v in needed)
    return f"WITH {parts} {sql}"
