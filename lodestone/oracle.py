"""ANSI SQL with the same results, for an independent engine on the same tables."""

from . import catalog, fixed
from .sources.proxies import PRIORITY

AS_OF_MS = catalog.AS_OF_MS
SEQ = 1 << 55
BLANKS = r"\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listing(values) -> str:
    return "[" + ", ".join("NULL" if v is None else q(v) for v in values) + "]"


def pick(values, index: str) -> str:
    return f"({listing(values)})[1 + ({index}) % {len(values)}]"


def nz(n: int, expr: str, key: str = "o_orderkey") -> str:
    return f"CASE WHEN {key} % {n} <> 0 THEN {expr} END"


WIDE = """orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey"""


def _common(step: int) -> str:
    price = nz(23, f"floor(o_totalprice / {step}) * {step}.0")
    posted = listing(("today", "yesterday", "3 days ago", "2 weeks ago", "5 hours ago", None))
    return f"""o_orderkey AS seq, o_orderpriority AS source, CAST({price} AS DOUBLE) AS price,
  '€' || CAST(CAST({price} AS BIGINT) AS VARCHAR) || CASE WHEN o_orderstatus = 'P' THEN ' (reserve price)' ELSE '' END
    AS "priceDisplay",
  {nz(31, "n_name || ', ' || r_name")} AS location,
  CASE WHEN n_name NOT LIKE '%7' THEN r_name END AS district,
  CASE WHEN o_orderkey % 7 = 1 THEN '' WHEN o_orderkey % 7 <> 0 THEN 'https://img.test/' || o_orderkey || '.jpg' END
    AS image,
  {nz(11, "'https://EX.test/p/' || (o_orderkey * 7919 % (SELECT count(*) * 9 // 10 FROM orders))"
          " || CASE WHEN o_orderkey % 3 = 0 THEN '/' ELSE '' END")} AS link,
  ({posted})[1 + o_orderkey % 6] AS posted,
  CASE WHEN o_orderkey % 4 = 0 THEN epoch_ms(o_orderdate) END AS "postedTs",
  'R' || o_orderkey AS ref,
  CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%d/%m/%Y') END AS "auctionDate" """


HOUSES = f"""houses AS (SELECT {_common(5000)}, 'house' AS kind,
  (1 + o_custkey % 6) || ' bedroom house, ' || c_mktsegment AS title,
  CAST({nz(5, "60 + o_orderkey * 37 % 240")} AS DOUBLE) AS "houseSqm",
  CAST(CASE WHEN o_orderkey % 29 = 0 THEN 0 WHEN o_orderkey % 13 <> 0 THEN 200 + o_orderkey * 53 % 1800 END AS DOUBLE)
    AS "plotSqm",
  CAST({nz(17, "1 + o_custkey % 6")} AS INTEGER) AS beds,
  CAST({nz(10, "1 + o_orderkey % 3")} AS INTEGER) AS baths,
  CAST({nz(19, "1950 + o_custkey % 75")} AS INTEGER) AS "buildYear",
  CASE WHEN o_orderstatus = 'F' THEN 'Residence' END AS "propertyType",
  CASE o_orderkey % 4 WHEN 0 THEN '1/1' WHEN 1 THEN '1/2' END AS share
  FROM {WIDE})"""

PLOTS = f"""plots AS (SELECT {_common(20000)}, 'plot' AS kind, 'Plot, ' || c_mktsegment AS title,
  CAST({nz(13, "200 + o_orderkey * 53 % 1800")} AS DOUBLE) AS "plotSqm",
  CASE o_orderstatus WHEN 'F' THEN 'Residential' WHEN 'O' THEN 'Agricultural' WHEN 'P' THEN 'Commercial' END AS "plotType",
  CASE WHEN o_orderkey % 5 = 0 THEN 'Ka' || (o_orderkey % 9) END AS zone
  FROM {WIDE})"""


def houses(select: str) -> str:
    return f"WITH {HOUSES} {select}"


def plots(select: str) -> str:
    return f"WITH {PLOTS} {select}"


# --- deduplication: the walk unrolled publisher by publisher ---------------------------


def _rows(kind: str, priority) -> str:
    rank = f"coalesce(list_position({listing(priority)}, source), {len(priority) + 1}) - 1"
    return f"""{HOUSES if kind == "house" else PLOTS},
r AS MATERIALIZED (SELECT seq, source, CAST({rank} AS BIGINT) AS rank, CAST({rank} AS BIGINT) * {SEQ} + seq AS ord,
  nullif(regexp_replace(lower(coalesce(link, '')), '/+$', ''), '') AS lk, price, district,
  {'beds, "houseSqm" AS area' if kind == "house" else '"plotSqm" AS area'} FROM {kind}s)"""


def _match(kind: str, a: str, b: str) -> str:
    gap = f"abs({a}.area - {b}.area) / greatest({a}.area, {b}.area)"
    if kind == "house":
        return f"""{a}.source <> {b}.source AND {a}.beds = {b}.beds AND {a}.price = {b}.price
    AND CASE WHEN {a}.area IS NOT NULL AND {b}.area IS NOT NULL THEN {gap} <= 0.05 ELSE {a}.district = {b}.district END"""
    return f"""{a}.source <> {b}.source AND {a}.price = {b}.price AND {a}.district IS NOT DISTINCT FROM {b}.district
    AND {gap} <= 0.03"""


def _walk(kind: str, rows: str | None = None, ranks: int = len(PRIORITY)) -> str:
    """All sources listed: a step per source, each against what is kept so far. ``rows`` are the CTEs up to ``r``."""
    parts, kept = [rows or _rows(kind, PRIORITY)], "SELECT * FROM r WHERE false"
    for i in range(ranks):
        parts.append(f"""before{i} AS MATERIALIZED ({kept}),
open{i} AS MATERIALIZED (SELECT * FROM r WHERE rank = {i}
  AND seq NOT IN (SELECT a.seq FROM r a JOIN before{i} k ON a.lk = k.lk WHERE a.rank = {i})
  AND seq NOT IN (SELECT a.seq FROM r a JOIN before{i} k ON {_match(kind, "a", "k")} WHERE a.rank = {i})),
kept{i} AS MATERIALIZED (SELECT * FROM open{i} WHERE lk IS NULL OR seq IN (SELECT min(seq) FROM open{i} GROUP BY lk))""")
        kept = " UNION ALL ".join(f"SELECT * FROM kept{j}" for j in range(i + 1))
    return _decided(kind, parts, kept)


def _rounds(kind: str, priority, n: int) -> str:
    """Unlisted sources: rounds over explicit conflicts, unrolled often enough to decide every row."""
    parts = [_rows(kind, priority)]
    parts.append(f"""pairs AS MATERIALIZED (SELECT a.ord AS late, b.ord AS early FROM r a JOIN r b
    ON {_match(kind, "a", "b")} WHERE b.ord < a.ord
  UNION ALL SELECT a.ord, b.ord FROM r a JOIN r b ON a.lk = b.lk WHERE b.ord < a.ord)""")
    parts.append("u0 AS (SELECT ord FROM r)")
    for i in range(n):
        parts.append(f"""first{i} AS MATERIALIZED (SELECT ord FROM u{i} WHERE ord NOT IN (SELECT late FROM pairs
    WHERE early IN (SELECT ord FROM u{i}) AND late IN (SELECT ord FROM u{i}))),
u{i + 1} AS MATERIALIZED (SELECT ord FROM u{i} WHERE ord NOT IN (SELECT ord FROM first{i})
  AND ord NOT IN (SELECT late FROM pairs WHERE early IN (SELECT ord FROM first{i})))""")
    kept = "SELECT * FROM r WHERE ord IN (" + " UNION ALL ".join(f"SELECT ord FROM first{i}" for i in range(n)) + ")"
    return _decided(kind, parts, kept)


def _decided(kind: str, parts: list[str], kept: str) -> str:
    parts.append(f"""kept AS MATERIALIZED ({kept}),
by_link AS (SELECT a.seq, min(k.ord) AS ord FROM r a JOIN kept k ON a.lk = k.lk AND k.ord < a.ord GROUP BY a.seq),
by_cross AS (SELECT a.seq, min(k.ord) AS ord FROM r a JOIN kept k ON {_match(kind, "a", "k")} AND k.ord < a.ord
  GROUP BY a.seq),
decided AS (SELECT r.seq, r.source,
  CASE WHEN l.ord IS NOT NULL THEN 'link' WHEN c.ord IS NOT NULL THEN 'cross' ELSE 'kept' END AS decision,
  coalesce(l.ord, c.ord) % {SEQ} AS kept_seq
  FROM r LEFT JOIN by_link l USING (seq) LEFT JOIN by_cross c USING (seq))""")
    return "WITH " + ",\n".join(parts)


def _report(kind: str) -> str:
    return f"""({_walk(kind)} SELECT '{kind}' AS kind, count(*) AS scraped,
  count(*) FILTER (decision = 'kept') AS kept, count(*) FILTER (decision = 'link') AS same_link,
  count(*) FILTER (decision = 'cross') AS cross_source FROM decided)"""


def _matches(kind: str) -> str:
    return f"""WITH {_rows(kind, PRIORITY)}
SELECT a.seq, a.source, count(b.seq) AS n_matches,
  min(CASE WHEN b.ord < a.ord THEN b.ord END) % {SEQ} AS first_match
FROM r a LEFT JOIN r b ON {_match(kind, "a", "b")} GROUP BY a.seq, a.source"""


# --- places ---------------------------------------------------------------------------------


def _case(tests, default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {q(value)}" for test, value in tests) + f" ELSE {default} END"


def _word(text: str, names) -> str:
    return _case((f"regexp_matches({text}, {q(rf'(?i)\b{name}\b')})", value) for name, value in names.items())


SELF = {d: d for d in fixed.DISTRICTS}


def _first_segment(areas, transliterate: bool) -> str:
    first = "trim(split_part(place, ',', 1))"
    middle = f"{_word('place', fixed.DISTRICT_TRANSLITERATED)}," if transliterate else ""
    prefix = _case((f"starts_with({first}, {q(a)})", d) for a, d in areas.items())
    return f"coalesce({_word('place', SELF)}, {middle} {prefix}, nullif({first}, ''))"


def _last_segment(areas) -> str:
    prefix = _case((f"regexp_matches(place, {q(rf'(?i)\b{a}')})", d) for a, d in areas.items())
    return f"coalesce({_word('place', SELF)}, {prefix}, nullif(trim(string_split(place, ',')[-1]), ''))"


def _title_words(text: str) -> str:
    """Title case by list functions, for ASCII words split at spaces and hyphens."""
    def words(sep: str, inner: str) -> str:
        return f"array_to_string(list_transform(string_split({inner}, '{sep}'), lambda w: upper(w[1]) || w[2:]), '{sep}')"

    return words("-", words(" ", f"lower({text})"))


# --- labels -----------------------------------------------------------------------------------

RATIO = '(CASE WHEN price <> 0 AND "plotSqm" <> 0 THEN price / "plotSqm" END)'


def _fixed(v: str, digits: int) -> str:
    scaled = f"({v} * {2 ** (digits + 1)})"
    lifted = f"CASE WHEN {scaled} = floor({scaled}) AND floor({scaled}) % 2 = 1 THEN {v} + {10.0 ** -(digits + 2):.4f} ELSE {v} END"
    return f"format('{{:.{digits}f}}', {lifted})"


def per_sqm(v: str) -> str:
    return f"""(CASE WHEN {v} >= 10 THEN '€' || format('{{:,}}', CAST(floor({v} + 0.5) AS BIGINT)) || '/m²'
    WHEN {v} >= 1 THEN '€' || {_fixed(v, 1)} || '/m²' WHEN {v} IS NOT NULL THEN '€' || {_fixed(v, 2)} || '/m²' END)"""


PRICE_LABEL = """coalesce('€' || format('{:,}', CAST(price AS BIGINT)), 'Price on request')
  || CASE WHEN "priceDisplay" LIKE '%reserve%' THEN ' (reserve)' ELSE '' END"""
RANK = """CASE coalesce(posted, '') WHEN '' THEN 999.0 WHEN '5 hours ago' THEN 0.0 WHEN 'today' THEN 0.5
  WHEN 'yesterday' THEN 1.0 WHEN '3 days ago' THEN 3.0 WHEN '2 weeks ago' THEN 14.0 END::DOUBLE"""
AGE = f"""CASE WHEN "postedTs" <> 0 THEN ({AS_OF_MS} - "postedTs") / 86400000.0::DOUBLE ELSE {RANK} END"""


def _card(kind: str, chips: list[str]) -> str:
    short = "split_part(source, ' ', 1)"
    return f"""SELECT seq, {PRICE_LABEL} AS price_label, title,
  coalesce(location, '') || CASE WHEN ref <> '' THEN ' · Ref ' || ref ELSE '' END AS location_label,
  concat_ws('|', {", ".join(chips)}) AS chips,
  CASE WHEN posted <> '' THEN 'Posted: ' || posted ELSE 'Posted: not shown by source' END AS posted_label,
  nullif(image, '') AS image, CASE WHEN nullif(image, '') IS NULL THEN 'No photo available' END AS placeholder,
  source, 'source-' || {short} AS source_class, link FROM {kind}s"""


def _int(c: str) -> str:
    return f"CAST(CAST({c} AS BIGINT) AS VARCHAR)"


HOUSE_CHIPS = [
    "CASE WHEN beds <> 0 THEN beds || ' bed' END",
    "CASE WHEN baths <> 0 THEN baths || ' bath' END",
    f"""CASE WHEN "houseSqm" <> 0 THEN {_int('"houseSqm"')} || ' m² house' END""",
    f"""CASE WHEN "plotSqm" <> 0 THEN {_int('"plotSqm"')} || ' m² plot' END""",
    f"{per_sqm(RATIO)} || ' plot'",
    """CASE WHEN "buildYear" <> 0 THEN 'Built ' || "buildYear" END""",
    '"propertyType"',
    "CASE WHEN share <> '1/1' THEN 'Share ' || share END",
    """'Auction ' || "auctionDate" """,
]
PLOT_CHIPS = [
    """CASE WHEN "plotSqm" <> 0 THEN format('{:,}', CAST("plotSqm" AS BIGINT)) || ' m² plot' END""",
    per_sqm(RATIO),
    '"plotType"',
    "'Zone ' || zone",
    """'Auction ' || "auctionDate" """,
]

SORT_KEYS = {
    "price_asc": "price ASC NULLS LAST",
    "price_desc": "price DESC NULLS LAST",
    "sqm_desc": '"houseSqm" DESC NULLS LAST',
    "plot_desc": '"plotSqm" DESC NULLS LAST',
    "plot_asc": '"plotSqm" ASC NULLS LAST',
    "ppsqm_asc": f"{RATIO} ASC NULLS LAST",
    "ppsqm_desc": f"{RATIO} DESC NULLS LAST",
    "recent": f"{AGE} ASC",
}
COMBINED = """source IN ('1-URGENT', '2-HIGH', '5-LOW') AND (price IS NULL OR price >= 50000)
  AND (price IS NULL OR price <= 400000) AND beds >= 2 AND "plotSqm" >= 300
  AND (contains(lower(title), 'building') OR contains(lower(coalesce(location, '')), 'building')
       OR contains(lower(ref), 'building'))"""


def _diff_side(start: str, end: str) -> str:
    return f"""SELECT o_custkey AS key, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS price FROM orders
  WHERE o_orderdate >= TIMESTAMP '{start}' AND o_orderdate < TIMESTAMP '{end}' GROUP BY 1"""


PART_CACHE = """SELECT 'R' || p_partkey AS ref, CASE WHEN p_partkey % 8 <> 0 THEN CAST(p_size AS DOUBLE) END AS "plotSqm",
  CASE WHEN p_partkey % 6 <> 0 THEN '/photos/' || p_partkey || '-1.jpg' END AS image,
  CASE WHEN p_partkey % 4 = 0 THEN '1/2' END AS share, CASE WHEN p_partkey % 4 <> 1 THEN p_type END AS "propertyType",
  CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS registration FROM part"""

DETAILS = f"""{HOUSES}, d AS (SELECT seq, {pick(catalog.DETAIL_SOURCES, "seq")} AS source, seq % 11 = 0 AS at_root,
    price, "priceDisplay", "houseSqm", "plotSqm", beds, baths, "buildYear", seq % 2 = 1 AND seq % 11 <> 0 AS seen,
    CAST(101 + seq % 900 AS DOUBLE) AS land, CAST(50 + seq % 300 AS DOUBLE) AS home, CAST(seq % 4 AS INTEGER) AS nb,
    CAST(1795 + seq % 320 AS INTEGER) AS yr, CAST(1 + seq % 5 AS INTEGER) AS rooms, CAST(seq % 5 * 1000 AS DOUBLE) AS ask
  FROM houses),
merged AS (SELECT seq, source,
  CASE WHEN source = 'Giovani Homes' AND seen THEN nullif(ask, 0) ELSE price END AS price,
  "priceDisplay" AS shown,
  CASE source WHEN 'Realting' THEN coalesce("houseSqm", CASE WHEN seen THEN home END)
    WHEN 'A Place in the Sun' THEN CASE WHEN seen THEN home ELSE "houseSqm" END
    WHEN 'Giovani Homes' THEN CASE WHEN seen THEN home + 1 ELSE "houseSqm" END ELSE "houseSqm" END AS "houseSqm",
  CASE WHEN NOT seen THEN "plotSqm" WHEN source IN ('Altamira Real Estate', 'Realting') THEN land
    WHEN source = 'A Place in the Sun' THEN 10000 + land WHEN source = 'Kadis Estates' THEN land + 1 END AS "plotSqm",
  CASE WHEN NOT seen THEN beds WHEN source = 'Altamira Real Estate' THEN coalesce(beds, rooms)
    WHEN source = 'Giovani Homes' THEN rooms ELSE beds END AS beds,
  CASE WHEN NOT seen THEN baths WHEN source IN ('Altamira Real Estate', 'A Place in the Sun') THEN coalesce(baths, nullif(nb, 0))
    WHEN source = 'Realting' THEN nb WHEN source = 'Giovani Homes' THEN nullif(nb, 0) ELSE baths END AS baths,
  CASE WHEN NOT seen THEN "buildYear"
    WHEN source = 'Altamira Real Estate' THEN coalesce(CASE WHEN yr > 1800 AND yr < 2100 THEN yr END, "buildYear")
    WHEN source = 'Realting' THEN CASE WHEN yr > 1800 AND yr < 2100 THEN yr END ELSE "buildYear" END AS "buildYear"
  FROM d),
published AS (SELECT * FROM merged WHERE source <> 'Giovani Homes' OR price <> 0)"""

CENTS = "CAST(floor(p_retailprice * 100) AS BIGINT)"
WS = f"[{BLANKS}]"


def sql() -> dict[str, str]:
    out = {
        "listing_snapshot": houses("SELECT * FROM houses"),
        "union_heterogeneous": """SELECT c_custkey AS seq, 'customers' AS source, c_name AS ref, c_acctbal AS price,
  c_mktsegment AS "propertyType", CAST(NULL AS VARCHAR) AS agent, CAST(NULL AS INTEGER) AS beds FROM customer
UNION ALL SELECT s_suppkey, 'suppliers', NULL, s_acctbal, NULL, s_name, NULL FROM supplier""",
        "canonical_district": f"""WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN
  {pick(catalog.DISTRICT_WORDS, "o_orderkey")} END AS spelled FROM orders)
SELECT o_orderkey, spelled, CASE spelled WHEN 'Pafos' THEN 'Paphos' WHEN 'Lefkosia' THEN 'Nicosia'
  WHEN 'Ammochostos' THEN 'Famagusta' WHEN 'Germasogeia' THEN 'Limassol' WHEN 'Lemesos' THEN 'Limassol'
  ELSE spelled END AS district FROM s""",
        "district_resolve": f"""WITH s AS (SELECT p_partkey, {pick(catalog.PLACE_WORDS, "p_partkey")} || ', '
  || {pick(catalog.REGION_WORDS, "p_partkey // 3")} || ', ' || p_name AS place FROM part)
SELECT p_partkey, {_case(((f"contains(lower(place), {q(d.lower())})", d) for d in fixed.DISTRICTS), "'Other'")} AS d1,
  {_case((f"contains(place, {q(a)})", d) for a, d in {**SELF, **fixed.REALTING_AREAS}.items())} AS d2,
  {_first_segment(fixed.KADIS_AREAS, True)} AS d3, {_first_segment(fixed.KADIS_PLOT_AREAS, False)} AS d3_plots,
  {_last_segment(fixed.KAZO_AREAS)} AS d4, {_last_segment(fixed.CYPRUS_PROPERTIES_AREAS)} AS d4_cp,
  {_word("place", SELF)} AS d5, trim(split_part(place, ',', 1)) AS d7_first,
  trim(string_split(place, ',')[-1]) AS d7_last FROM s""",
        "district_codes": f"""WITH s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 8 <> 7 THEN
  {pick(catalog.CODE_WORDS, "s_suppkey")} END AS word, {pick((*fixed.GIOVANI_CITIES, "Athens"), "s_suppkey")} AS city
  FROM supplier)
SELECT s_suppkey, CASE WHEN word IS NULL THEN 'Other' WHEN word = 'PAFOS' THEN 'Paphos'
  ELSE {_title_words("word")} END AS d6,
  {_case((f"city = {q(c)}", d) for c, d in fixed.GIOVANI_CITIES.items())} AS d9 FROM s""",
        "source_priority_order": houses(
            f"""SELECT seq, source, CAST(coalesce(list_position({listing(PRIORITY[1:4])}, source), 4) - 1 AS BIGINT) AS rank,
  row_number() OVER (ORDER BY coalesce(list_position({listing(PRIORITY[1:4])}, source), 4), seq) AS position FROM houses"""
        ),
        "link_keys": """SELECT page_id, regexp_replace(lower(url), '/+$', '') AS link_key,
  split_part(url, '?', 1) AS no_query,
  nullif(regexp_extract(url, '/(\\d+)(?:[/?#]|$)', 1), '') AS ref,
  'https://site.test' || nullif(regexp_extract(url, '^https?://[^/]+(/.*)$', 1), '') AS absolute FROM pages""",
        "same_property_matches": _matches("house"),
        "same_plot_matches": _matches("plot"),
        "dedup_houses": _walk("house") + " SELECT * FROM decided",
        "dedup_incremental": _walk("house") + " SELECT * FROM decided",
        "dedup_plots": _walk("plot") + " SELECT * FROM decided",
        "dedup_unlisted_sources": _rounds("house", PRIORITY[:2], 12) + " SELECT * FROM decided",
        "dedup_report": f"SELECT * FROM {_report('house')} UNION ALL SELECT * FROM {_report('plot')}",
        "filter_price_keep_null": houses(
            "SELECT seq, price FROM houses WHERE (price IS NULL OR price >= 100000) AND (price IS NULL OR price <= 200000)"
        ),
        "filter_attr_drop_null": houses(
            """SELECT seq, "houseSqm", "plotSqm", "buildYear", beds FROM houses WHERE "houseSqm" >= 120
  AND "plotSqm" BETWEEN 400 AND 1500 AND "buildYear" >= 1975 AND beds >= 2"""
        ),
        "filter_zero_bound": houses('SELECT seq, "plotSqm" FROM houses WHERE "plotSqm" >= 0'),
        "filter_sources": houses(
            "SELECT seq, source, district FROM houses WHERE source IN ('1-URGENT', '5-LOW') AND district = 'ASIA'"
        ),
        "filter_no_source": houses("SELECT seq, source FROM houses WHERE false"),
        "filter_plot_type": plots("""SELECT seq, "plotType" FROM plots WHERE "plotType" = 'Residential'"""),
        "search_text": houses(
            """SELECT seq, title, location, ref FROM houses WHERE contains(lower(title), 'nation_1')
  OR contains(lower(coalesce(location, '')), 'nation_1') OR contains(lower(ref), 'nation_1')"""
        ),
        "search_documents": " UNION ALL ".join(
            f"""SELECT doc_id AS seq, {q(w)} AS q FROM documents WHERE contains(lower(coalesce(text, '')), {q(w.lower())})
  OR contains(lower(coalesce(lang, '')), {q(w.lower())}) OR contains(lower(coalesce(source, '')), {q(w.lower())})"""
            for w in ("e. T", "%%")
        ),
        "filter_combined": houses(f'SELECT seq, source, price, beds, "plotSqm", title FROM houses WHERE {COMBINED}'),
        "sort_default": f"""WITH {HOUSES}, {PLOTS}
SELECT seq, row_number() OVER (ORDER BY price NULLS LAST, seq) AS position, 'house' AS kind FROM houses UNION ALL
SELECT seq, row_number() OVER (ORDER BY "plotSqm" DESC NULLS LAST, seq), 'plot' FROM plots""",
        "cheapest_listings": houses(f"SELECT seq, price FROM houses WHERE {COMBINED} ORDER BY price NULLS LAST, seq LIMIT 50"),
        "page_caps": """SELECT event_type AS source, count(*) AS n FROM events
  WHERE datediff('day', DATE '2024-01-01', ts::DATE) + 1 <= CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 5 ELSE 10 END
  GROUP BY 1""",
        "stats_bar": houses(
            """SELECT count(*) AS total, count(DISTINCT source) AS sources, count(*) FILTER (image <> '') AS with_photo,
  CAST(floor(coalesce(avg(price), -0.5) + 0.5) AS BIGINT) AS avg_price, count(DISTINCT nullif(district, '')) AS districts
  FROM houses"""
        ),
        "stats_bar_empty": houses(
            """SELECT count(*) AS total, count(DISTINCT source) AS sources, count(*) FILTER (image <> '') AS with_photo,
  CAST(0 AS BIGINT) AS avg_price, count(DISTINCT nullif(district, '')) AS districts FROM houses WHERE price IS NULL"""
        ),
        "facet_sources": houses("SELECT source, count(*) AS n, min(seq) AS first_seq FROM houses GROUP BY source"),
        "facet_values": plots(
            """SELECT DISTINCT district AS value, 'district' AS facet FROM plots WHERE district <> '' UNION ALL
SELECT DISTINCT "plotType", 'plotType' FROM plots WHERE "plotType" <> ''"""
        ),
        "result_counts": houses(f"SELECT count(*) FILTER ({COMBINED}) AS shown, count(*) AS total FROM houses"),
        "source_health": """SELECT o_orderpriority AS source, count(*) AS n, true AS succeeded FROM orders GROUP BY 1
UNION ALL SELECT r_name, 0, r_name <> 'ASIA' FROM region""",
        "harvest_report": f"""SELECT count(*) AS harvested, count(image) AS with_photos,
  count(coalesce("plotSqm"::VARCHAR, share, "propertyType", registration)) AS with_table FROM ({PART_CACHE})""",
        "price_per_sqm": houses(f"SELECT seq, {RATIO} AS ratio, {per_sqm(RATIO)} AS label FROM houses"),
        "price_labels": houses(f"SELECT seq, {PRICE_LABEL} AS label, split_part(title, ' ', 1) AS first_word FROM houses"),
        "short_names": f"""WITH s AS (SELECT c_custkey, {pick(fixed.HOUSE_PRIORITY, "c_custkey")} AS name FROM customer)
SELECT c_custkey, CASE name WHEN 'A Place in the Sun' THEN 'APITS' ELSE split_part(name, ' ', 1) END AS house,
  CASE name WHEN 'A Place in the Sun' THEN 'APITS' WHEN 'eAuction Cyprus' THEN 'eAuction' WHEN 'Kadis Estates' THEN 'Kadis'
    ELSE split_part(name, ' ', 1) END AS plot FROM s""",
        "card_view": houses(_card("house", HOUSE_CHIPS)),
        "card_view_plots": plots(_card("plot", PLOT_CHIPS)),
        "posted_age": houses(f"SELECT seq, {RANK} AS rank, round({AGE}, 6) AS age FROM houses"),
        "posted_text": """SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN epoch_ms(o_orderdate) END AS ms,
  CASE WHEN o_orderkey % 6 <> 0 THEN strftime(o_orderdate, '%-d %b %Y') END AS posted FROM orders""",
        "price_parse": f"""WITH p AS (SELECT p_partkey AS k, CAST({CENTS} AS DOUBLE) AS c FROM part)
SELECT k AS p_partkey, CASE WHEN k % 7 <> 0 THEN c END AS n1, CASE WHEN k % 5 <> 0 THEN c END AS n2, c AS n3,
  c + 0.5 AS n4, c AS n5,
  CASE WHEN k % 3 = 0 THEN ((1 + k % 9) * 100 + CAST(c AS BIGINT) % 100) * 10000.0::DOUBLE ELSE c END AS n6,
  CASE WHEN k % 2 = 0 THEN c ELSE 99.0::DOUBLE END AS n7, c AS n8, CASE WHEN k % 7 <> 0 THEN c ELSE 0.0::DOUBLE END AS n9,
  c AS n10 FROM p""",
        "number_parse": """WITH p AS (SELECT p_partkey AS k, p_size AS s FROM part)
SELECT k AS p_partkey, CAST(s + 1 AS DOUBLE) AS n11, CAST(s * 1000 AS DOUBLE) AS n12,
  CAST(s * 10 + k % 10 AS DOUBLE) AS n13, CAST(s AS DOUBLE) AS n14_first, CAST(s + 7 AS DOUBLE) AS n14_second,
  s AS n15, CASE WHEN k % 400 + 1750 > 1800 AND k % 400 + 1750 < 2100 THEN CAST(k % 400 + 1750 AS DOUBLE) END AS n16,
  ([1235.0, 13.0, 900.0, 3000000.0, NULL, NULL]::DOUBLE[])[1 + k % 6] AS n17,
  s % 7 > 0 AND s % 7 <= k % 9 AS n18,
  (['Residential', 'Agricultural', 'Agricultural', NULL, 'Tourist', NULL])[1 + k % 6] AS g2,
  (['Residential', 'Agricultural', NULL, NULL, 'Tourist', NULL])[1 + k % 6] AS g2_strict,
  ([NULL, 'Ka4', NULL, 'H2-a'])[1 + k % 4] AS g3 FROM p""",
        "text_clean": f"""SELECT p_partkey, {_title_words("p_type || '-' || p_name")} || ' X' AS g1,
  {_title_words("replace(p_name, '-', ' ')")} || ' For Sale' AS g5,
  p_brand || ' - ' || p_type AS g6_after, p_name || ', ' || p_brand AS g6_place, p_name || ' ' || p_type AS g7,
  p_name || ' & – ' || p_brand AS g8, CAST(p_partkey AS VARCHAR) AS g12, p_name AS g11_first, p_brand AS g11_last,
  {_title_words("p_name")} AS g14 FROM part""",
        "enrich_left_join": houses(
            f"""SELECT h.seq, h.source, CASE WHEN h.source <> '1-URGENT' THEN h."houseSqm" END AS "houseSqm",
  CASE WHEN h.source = '1-URGENT' THEN c."plotSqm" ELSE h."plotSqm" END AS "plotSqm",
  CASE WHEN h.source = '1-URGENT' THEN c.image ELSE h.image END AS image,
  CASE WHEN h.source = '1-URGENT' THEN c.share ELSE h.share END AS share,
  CASE WHEN h.source = '1-URGENT' THEN c."propertyType" ELSE h."propertyType" END AS "propertyType",
  CASE WHEN h.source = '1-URGENT' THEN c.registration END AS registration
  FROM houses h LEFT JOIN ({PART_CACHE}) c ON h.ref = c.ref"""
        ),
        "enrich_merge_policy": f"""WITH {DETAILS} SELECT seq, source, price, "houseSqm", "plotSqm", beds, baths, "buildYear"
  FROM published""",
        "detail_inner_priced": f"""WITH {DETAILS} SELECT seq, source, price,
  CASE WHEN source = 'Giovani Homes' AND price <> 0 THEN '€' || format('{{:,}}', CAST(price AS BIGINT)) END AS "priceDisplay"
  FROM published""",
        "term_lookup": """WITH o AS (SELECT o_orderkey, [o_orderkey % 97, o_custkey % 53, (o_orderkey + 5) % 211] AS ids FROM orders),
x AS (SELECT o_orderkey, unnest(ids) AS id, generate_subscripts(ids, 1) AS nth FROM o),
y AS (SELECT o_orderkey, string_agg(s_name, ', ' ORDER BY nth) AS names, arg_min(s_name, nth) AS first_name
  FROM x JOIN supplier ON s_suppkey = id GROUP BY 1)
SELECT o_orderkey, names, first_name, list_contains(ids, 7) AS has_seven, NOT list_contains(ids, 29) AS lacks_29,
  CAST(len(list_distinct(ids)) AS INTEGER) AS n_distinct FROM o LEFT JOIN y USING (o_orderkey)""",
        "cache_upsert": """WITH n AS (SELECT o_custkey + 10 AS code, max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS amount,
  max(o_orderstatus) AS status FROM orders GROUP BY 1)
SELECT coalesce(c_custkey, code) AS code, c_mktsegment AS segment, coalesce(amount, c_acctbal) AS amount, status
  FROM customer FULL OUTER JOIN n ON c_custkey = code""",
        "pages_cards": f"""WITH s AS (SELECT page_id, string_split(html, '<p>') AS parts FROM pages),
x AS (SELECT page_id, unnest(parts[2:]) AS card, generate_subscripts(parts[2:], 1) - 1 AS pos FROM s)
SELECT page_id, CAST(pos AS INTEGER) AS pos, regexp_replace(regexp_replace(regexp_replace(card, '<[^>]+>', ' ', 'g'),
  '{WS}+', ' ', 'g'), '^{WS}+|{WS}+$', '', 'g') AS text FROM x""",
        "pages_fields": f"""SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
  nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') AS lang,
  regexp_replace(regexp_replace(regexp_replace(nullif(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), ''), '<[^>]+>', ' ', 'g'),
  '{WS}+', ' ', 'g'), '^{WS}+|{WS}+$', '', 'g') AS heading,
  nullif(CAST(nullif(regexp_extract(html, 'track\\((\\d+)\\)', 1), '') AS DOUBLE), 0) AS track,
  CAST(len(string_split(html, '<p>')) - 1 AS INTEGER) AS paragraphs FROM pages""",
        "pages_links": """WITH s AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]+)"', 1) AS l FROM pages),
x AS (SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) AS nth FROM s),
y AS (SELECT page_id, link, min(nth) AS nth FROM x GROUP BY 1, 2),
z AS (SELECT page_id, count(*) AS n, string_agg(link, ' ' ORDER BY nth) AS links FROM y GROUP BY 1)
SELECT page_id, CAST(coalesce(n, 0) AS INTEGER) AS n_links, coalesce(links, '') AS links FROM s LEFT JOIN z USING (page_id)""",
        "json_payload": """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
  CASE event_id % 3 WHEN 0 THEN '<p>' || event_type || '</p>' WHEN 1 THEN '' ELSE '<p>raw ' || event_type || '</p>' END AS html,
  CAST(user_id AS VARCHAR) AS meta_a, '' AS meta_b FROM events""",
        "band_join_tokens": """WITH tok AS (SELECT l_orderkey AS code, l_partkey, l_linenumber, CAST(floor(l_quantity) AS INTEGER) AS x,
  CAST(floor(l_extendedprice / 100) % 200 AS INTEGER) AS y FROM lineitem)
SELECT a.code, a.l_partkey AS marker, a.y AS anchor_y, count(*) AS n,
  min(CASE WHEN abs(b.x - 20) <= 10 THEN b.x END) AS leftmost, count(*) FILTER (abs(b.x - 40) <= 5) AS near_40
  FROM tok a JOIN tok b ON a.code = b.code AND abs(b.y - a.y) < 22 WHERE a.l_linenumber = 1 GROUP BY 1, 2, 3""",
        "notice_table": f"""WITH o AS (SELECT o_orderkey AS k, lot, doc FROM orders, (VALUES (1), (2)) v(lot), (VALUES ('a'), ('b')) w(doc)
  WHERE doc = 'a' OR o_orderkey % 10 = 0)
SELECT CAST(k AS VARCHAR) AS code, doc, lot AS idx, '0/' || k AS registration,
  CASE WHEN k % 5 * lot BETWEEN 1 AND 4 THEN (k % 5 * lot) || '/4' END AS share,
  CAST((k % 1000) * 1000 + lot * 100 + 1 AS DOUBLE) AS "areaSqm",
  {pick((*fixed.NOTICE_PROPERTY_TYPES.values(), None), "k")} AS "propertyType" FROM o""",
        "harvest_cache": f"""WITH fresh AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS code, CAST((k % 1000) * 1000 + 101 AS DOUBLE) AS sqm,
  CASE WHEN k % 5 BETWEEN 1 AND 4 THEN (k % 5) || '/4' END AS share, {pick((*fixed.NOTICE_PROPERTY_TYPES.values(), None), "k")} AS ptype,
  '0/' || k AS reg FROM orders),
shots AS (SELECT CAST(l_orderkey AS VARCHAR) AS code, count(*) AS n FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1),
new AS (SELECT code, sqm, share, ptype, reg, n FROM fresh FULL JOIN shots USING (code)),
old AS (SELECT CAST(p_partkey AS VARCHAR) AS code, CASE WHEN p_partkey % 8 <> 0 THEN CAST(p_size AS DOUBLE) END AS sqm,
  CASE WHEN p_partkey % 6 <> 0 THEN 1 END AS n, CASE WHEN p_partkey % 4 = 0 THEN '1/2' END AS share,
  CASE WHEN p_partkey % 4 <> 1 THEN p_type END AS ptype, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS reg FROM part)
SELECT code, coalesce(new.sqm, old.sqm) AS "plotSqm", coalesce(new.share, old.share) AS share, coalesce(new.ptype, old.ptype) AS "propertyType",
  coalesce(new.reg, old.reg) AS registration, CAST(coalesce(new.n, old.n) AS INTEGER) AS n_images FROM old FULL JOIN new USING (code)""",
        "harvest_summary": f"""WITH fresh AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS code, CAST((k % 1000) * 1000 + 101 AS DOUBLE) AS sqm,
  CASE WHEN k % 5 BETWEEN 1 AND 4 THEN (k % 5) || '/4' END AS share, {pick((*fixed.NOTICE_PROPERTY_TYPES.values(), None), "k")} AS ptype,
  '0/' || k AS reg FROM orders),
shots AS (SELECT CAST(l_orderkey AS VARCHAR) AS code, count(*) AS n FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1),
new AS (SELECT code, sqm, share, ptype, reg, n FROM fresh FULL JOIN shots USING (code))
SELECT count(*) AS harvested, count(n) AS with_photos, count(reg) AS with_table FROM new""",
        "lot_select": """WITH r AS (SELECT 'C' || l_orderkey || CASE WHEN l_orderkey % 3 = 0 THEN '' ELSE '-00' || (1 + l_orderkey % 4) END AS code,
  CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 1 + l_orderkey % 4 END AS want, l_linenumber AS idx, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem)
SELECT code, idx, l_partkey, l_suppkey, l_extendedprice FROM r
QUALIFY row_number() OVER (PARTITION BY code ORDER BY idx <> want, l_partkey, l_suppkey, l_extendedprice) = 1""",
        "photo_discriminator": """WITH px AS (SELECT vec_id, embedding AS e, unnest(range(len(embedding) // 3)) AS i FROM embeddings),
c AS (SELECT vec_id, i, CASE WHEN vec_id % 7 = 0 THEN 150 ELSE 220 END AS width,
  list_transform([1, 2, 3], lambda o: greatest(CAST(floor(least(greatest((CAST(e[i * 3 + o] AS DOUBLE) + 0.25) * 512, 0.0), 255.0)) AS INTEGER),
    CASE WHEN vec_id % 5 = 0 THEN 240 ELSE 0 END)) AS rgb FROM px),
m AS (SELECT vec_id, width, i, list_max(rgb) AS mx, list_min(rgb) AS mn FROM c),
s AS (SELECT vec_id, width, avg(CASE WHEN mx = 0 THEN 0.0 ELSE (mx - mn) / CAST(mx AS DOUBLE) * 100 END) AS sat,
  avg(CASE WHEN mx > 235 AND mx - mn < 15 THEN 1.0 ELSE 0.0 END) AS white FROM m
  WHERE i % greatest(1, width * 220 // 20000) = 0 GROUP BY 1, 2)
SELECT CAST(vec_id AS VARCHAR) AS image_id, round(sat, 6) AS sat, round(white, 6) AS white,
  sat >= 12 AND white <= 0.5 AND width >= 200 AS is_photo FROM s""",
        "harvest_links": "SELECT o_orderkey AS seq, 'https://a.test/Auction/Details/' || o_orderkey AS link FROM orders WHERE o_orderkey % 2 = 0",
        "capture_coverage": """WITH c AS (SELECT event_type AS source, datediff('day', DATE '2024-01-01', ts::DATE) + 1 AS page_no, user_id AS id FROM events),
f AS (SELECT source, id, min(page_no) AS page_no FROM c GROUP BY 1, 2),
n AS (SELECT source, page_no, count(*) AS new_ids FROM f GROUP BY 1, 2),
p AS (SELECT source, page_no, count(*) AS cards FROM c GROUP BY 1, 2)
SELECT source, CAST(page_no AS INTEGER) AS page_no, cards, coalesce(new_ids, 0) AS new_ids FROM p LEFT JOIN n USING (source, page_no)""",
        "capture_walk_end": """WITH c AS (SELECT event_type AS source, datediff('day', DATE '2024-01-01', ts::DATE) + 1 AS page_no, user_id AS id FROM events),
f AS (SELECT source, id, min(page_no) AS page_no FROM c GROUP BY 1, 2)
SELECT source, CAST(max(page_no) AS INTEGER) AS last_page,
  CAST(min(CASE WHEN (source, page_no) NOT IN (SELECT source, page_no FROM f) THEN page_no END) AS INTEGER) AS first_empty
  FROM c GROUP BY 1""",
        "freshness": f"""WITH m AS (SELECT coalesce(event_type, '(all)') AS source, max(ts) AS newest FROM events GROUP BY ROLLUP (event_type))
SELECT source, CAST(floor(epoch(newest)) AS BIGINT) AS newest_s,
  CAST(floor((epoch_ms(TIMESTAMP '{catalog.AS_OF}') - epoch_ms(newest)) / 3600000.0) AS BIGINT) AS age_hours,
  epoch_ms(TIMESTAMP '{catalog.AS_OF}') - epoch_ms(newest) > 30 * 3600000 AS stale FROM m""",
        "snapshot_diff": f"""WITH o AS ({_diff_side("1900-01-01", "1997-01-01")}), n AS ({_diff_side("1995-01-01", "2100-01-01")})
SELECT coalesce(o.key, n.key) AS key, CASE WHEN o.key IS NULL THEN 'added' WHEN n.key IS NULL THEN 'removed' ELSE 'changed' END AS change,
  o.price AS old_value, n.price AS new_value FROM o FULL OUTER JOIN n ON o.key = n.key
  WHERE o.price IS DISTINCT FROM n.price""",
        "stream_first_seen": "SELECT DISTINCT event_type AS source, user_id AS ref FROM events",
    }
    line = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
    whole = f"{line}, l_discount, l_tax, l_linestatus, l_shipdate, l_returnflag"
    ids = "CASE WHEN l_returnflag <> 'R' THEN l_orderkey || '-' || l_linenumber END"
    ranked = f"""SELECT {line}, {ids} AS item_id, row_number() OVER (PARTITION BY coalesce('=' || {ids},
  concat_ws('#', {whole})) ORDER BY {whole}) AS rn FROM lineitem"""
    out["insource_first_wins"] = f"SELECT {line}, item_id FROM ({ranked}) WHERE rn = 1"
    out["insource_drop_null_ids"] = f"SELECT {line}, item_id FROM ({ranked}) WHERE rn = 1 AND item_id IS NOT NULL"
    for sort, key in SORT_KEYS.items():
        kind, cte = ("plots", PLOTS) if sort == "plot_asc" else ("houses", HOUSES)
        out[f"sort_{sort}"] = f"WITH {cte} SELECT seq, row_number() OVER (ORDER BY {key}, seq) AS position FROM {kind}"
    return out
