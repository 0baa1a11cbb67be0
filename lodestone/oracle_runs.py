"""The queries of `catalog_runs.py` in SQL."""

from . import oracle
from .oracle import HOUSES, PART_CACHE, PLOTS
from .plans.changes import FIELDS
from .schema import LISTING

_HAVE = (
    "source", "title", "price", "priceDisplay", "location", "district", "image", "link", "houseSqm", "plotSqm", "beds", "baths",
    "posted", "postedTs", "buildYear", "ref", "auctionDate", "share", "propertyType",
)
_QUOTED = ", ".join(f'"{c}"' for c in _HAVE)
_KEY = "coalesce(nullif(regexp_replace(lower(coalesce(link, '')), '/+$', ''), ''), concat_ws('|', source, ref))"
BEFORE = f"""{HOUSES}, before AS (
  SELECT * REPLACE (CASE WHEN seq % 43 = 0 THEN price + 5000 ELSE price END AS price, CASE WHEN seq % 47 <> 0 THEN image END AS image,
    CASE WHEN seq % 43 = 0 THEN 99 ELSE beds END AS beds) FROM houses WHERE seq % 41 <> 0
  UNION ALL SELECT * REPLACE (seq + {1 << 40} AS seq, 'X' || ref AS ref, NULL AS link) FROM houses WHERE seq % 53 = 0
)"""


def _changes() -> str:
    assert set(_HAVE) <= set(FIELDS) <= set(LISTING.names)
    unlike = ", ".join(f"""CASE WHEN l."{f}" IS DISTINCT FROM p."{f}" THEN '{f}' END""" for f in FIELDS if f in _HAVE)
    return f"""WITH {BEFORE}, o AS (SELECT {_KEY} AS key, {_QUOTED} FROM before), n AS (SELECT {_KEY} AS key, {_QUOTED} FROM houses),
l AS (SELECT * FROM o EXCEPT ALL SELECT * FROM n), p AS (SELECT * FROM n EXCEPT ALL SELECT * FROM o),
k AS (SELECT key, count(*) FILTER (side = 0) AS n_l, count(*) FILTER (side = 1) AS n_p
  FROM (SELECT key, 0 AS side FROM l UNION ALL SELECT key, 1 FROM p) GROUP BY key),
single AS (SELECT key, list_filter([{unlike}], lambda x: x IS NOT NULL) AS fields FROM l JOIN p USING (key)
  WHERE key IN (SELECT key FROM k WHERE n_l = 1 AND n_p = 1))
SELECT key, CASE WHEN key NOT IN (SELECT key FROM o) THEN 'added' WHEN key NOT IN (SELECT key FROM n) THEN 'removed' ELSE 'changed' END AS change,
  fields FROM k LEFT JOIN single USING (key)"""


def sql() -> dict[str, str]:
    bar = oracle.sql()["stats_bar"]
    return {
        "snapshot_changes": _changes(),
        "publish_gate": f"""WITH {BEFORE}, b AS (SELECT count(*) AS n FROM before), h AS (SELECT count(*) AS n FROM houses)
SELECT 1::INT AS run, true AS published, 'first' AS reason, n AS listings FROM b UNION ALL SELECT 2, true, 'changed', n FROM h
UNION ALL SELECT 3, false, 'unchanged', n FROM h UNION ALL SELECT 4, false, 'refused', n FROM h UNION ALL SELECT 5, true, 'changed', 0""",
        "cache_scan": f"""SELECT ref AS code, "plotSqm",
  CASE WHEN share IS NOT NULL THEN '}}, {{"' || ref || '": \\"{{' ELSE image END AS image,
  CASE WHEN image IS NOT NULL THEN 1 END::INT AS n_images, share, "propertyType", registration FROM ({PART_CACHE})""",
        "enrich_stored": oracle.sql()["enrich_left_join"],
        "search_indexed": oracle.sql()["search_text"],
        "filter_clustered": f"""WITH {HOUSES} SELECT seq, source, district, price, "plotSqm" FROM houses
WHERE district = 'ASIA' AND (price IS NULL OR price BETWEEN 100000 AND 200000) AND "plotSqm" BETWEEN 400 AND 1500""",
        "stats_from_summaries": f"SELECT *, (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 2 = 0) AS listings FROM ({bar})",
        "facets_from_summaries": """SELECT o_orderpriority AS source, count(*) AS n, min(o_orderkey) AS first_seq,
  row_number() OVER (ORDER BY min(o_orderkey)) AS position FROM orders GROUP BY 1""",
        "refresh_all_failed": "SELECT o_orderpriority AS source, count(*) AS n, true AS stopped FROM orders GROUP BY 1",
        "facet_places": f"""WITH {PLOTS} SELECT source AS value, row_number() OVER (ORDER BY min(seq)) AS position, 'source' AS facet FROM plots GROUP BY source
UNION ALL SELECT district, row_number() OVER (ORDER BY district), 'district' FROM (SELECT DISTINCT district FROM plots WHERE district <> '')
UNION ALL SELECT "plotType", row_number() OVER (ORDER BY "plotType"), 'plotType' FROM (SELECT DISTINCT "plotType" FROM plots WHERE "plotType" <> '')""",
        "refresh_health": f"""SELECT registry, place::INT AS source_order,
  CASE WHEN registry = 'Bazaraki' THEN (SELECT count(*) FROM ({_bazaraki_plots()})) ELSE 0 END AS n,
  registry IN ('Bazaraki', 'Cyprus Properties', 'EstateBud-WP agencies') AS succeeded
FROM (SELECT unnest({_plot_registry()}) AS registry, generate_subscripts({_plot_registry()}, 1) - 1 AS place)""",
        "capture_quarantine": """WITH c AS (SELECT o_orderkey AS k FROM orders), b AS (SELECT kind, k FROM c, (SELECT unnest(['house', 'plot']) AS kind))
SELECT 'Bazaraki' AS source, kind, 'page' AS of, count(*) AS n FROM b GROUP BY kind
UNION ALL SELECT 'Bazaraki', kind, 'sound', 2 * count(*) FROM b WHERE k % 50 <> 0 GROUP BY kind
UNION ALL SELECT 'Bazaraki', kind, 'held payload', count(*) FROM b WHERE k % 50 = 0 GROUP BY kind
UNION ALL SELECT 'eAuction Cyprus', 'house', 'page', count(*) FROM c
UNION ALL SELECT 'eAuction Cyprus', 'house', 'sound', 2 * count(*) FROM c WHERE k % 5 <> 4
UNION ALL SELECT 'eAuction Cyprus', 'house', unnest(['invalid', 'held card']), 2 * count(*) FROM c WHERE k % 5 = 4""",
    }


def _plot_registry() -> str:
    from . import fixed

    return "[" + ", ".join(f"'{n}'" for n in fixed.PLOT_REGISTRY) + "]"


def _bazaraki_plots() -> str:
    from . import captures, oracle_extract

    return oracle_extract.sql()[captures.query_name("Bazaraki", "plot")]
