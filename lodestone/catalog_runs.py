"""Queries of what lies between runs: stores, indexes, changes, the gate, health and quarantine."""

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import captures, catalog
from .operators import enrich
from .plans import changes, cluster, query, refresh, search, stats, summaries
from .session import Workspace
from .sources import extract, proxies, readers
from .sources.specs import specs

col = F.col


def snapshot_before(rows: DataFrame) -> DataFrame:
    """The houses as an earlier run may have had them: some absent, some other ones, some fields unlike."""
    k = col("seq")
    old = rows.where(k % 41 != 0).withColumns(
        {
            "price": F.when(k % 43 == 0, col("price") + 5000).otherwise(col("price")),
            "image": F.when(k % 47 != 0, col("image")),
            "beds": F.when(k % 43 == 0, F.lit(99)).otherwise(col("beds")),
        }
    )
    gone = rows.where(k % 53 == 0).withColumns(
        {"seq": k + (1 << 40), "ref": F.concat(F.lit("X"), col("ref")), "link": F.lit(None).cast("string")}
    )
    return old.unionByName(gone)


def snapshot_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Added, removed and changed listings over all fields, where digests of buckets differ."""
    rows = proxies.houses(spark, sf)
    return changes.listing_changes(snapshot_before(rows), rows)


def publish_gate(spark: SparkSession, sf: str) -> DataFrame:
    """R1, SNK1: a run is published if something changed and no source failed; capture order is no change."""
    rows = proxies.houses(spark, sf)
    path = f"{Workspace(spark, 'gate').path}/snapshot"
    shifted = rows.withColumn("seq", col("seq") + 7)
    steps = (
        (snapshot_before(rows), {}), (rows, {}), (shifted, {}), (rows.where("price > 0"), {"Realting": "no capture"}), (rows.limit(0), {}),
    )
    out = []
    for run, (listings, failed) in enumerate(steps, 1):
        outcome = refresh.Refresh(listings, listings.select("seq"), failed)
        done = changes.publish_if_changed(outcome, "house", path, run, on_failure="refuse")
        out.append((run, done.published, done.reason, refresh.latest(spark, path).count()))
    return spark.createDataFrame(out, "run int, published boolean, reason string, listings bigint")


def cache_text(entries: DataFrame, path: str, per_object: int = 1_000) -> None:
    """Cache entries as text: JSON objects of some entries each, one after the other, an entry per line."""
    fields = [c for c in entries.columns if c != "code"]
    name = F.regexp_extract(F.to_json(F.struct("code")), r'^\{"code":(.*)\}$', 1)
    line = F.concat(F.lit("\n  "), name, F.lit(": "), F.to_json(F.struct(*fields)))
    blocks = entries.withColumn("_block", F.pmod(F.xxhash64("code"), F.greatest(F.lit(1), F.lit(entries.count() // per_object))))
    # The entries of an object are bounded by the number of objects, which grows with them.
    texts = blocks.groupBy("_block").agg(F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list(line)), ","), F.lit("\n}")).alias("value"))
    texts.select("value").write.text(path)


def cache_scan(spark: SparkSession, sf: str) -> DataFrame:
    """SRC2: a cache written as JSON objects and read back by entries, with braces and quotes inside strings."""
    path = f"{Workspace(spark, 'cache').path}/cache"
    entries = catalog._part_cache(spark, sf)
    odd = F.when(col("share").isNotNull(), F.concat(F.lit('}, {"'), col("code"), F.lit('": \\"{'))).otherwise(col("image"))
    cache_text(entries.withColumn("image", odd), path)
    back = readers.cache_scan(spark, path)
    return back.select("code", "plotSqm", "image", F.size("images").alias("n_images"), "share", "propertyType", "registration")


def enrich_stored(spark: SparkSession, sf: str) -> DataFrame:
    """J1 against a cache stored in buckets of its key, which is not shuffled."""
    rows = proxies.houses(spark, sf)
    name = f"cache_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cache = enrich.store_keyed(catalog._part_cache(spark, sf), name, f"{Workspace(spark, 'stored').path}/cache", ("code",), buckets)
    rows = enrich.merge_cache(rows, cache, source="1-URGENT", n_rows=rows.count(), stored=True)
    return rows.select("seq", "source", "houseSqm", "plotSqm", "image", "share", "propertyType", "registration")


def search_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """F9 through the trigram index."""
    path = Workspace(spark, "search").path
    search.write_index(proxies.houses(spark, sf), path, chunk=4096)
    return search.search(spark, path, "NATION_1")


def filter_clustered(spark: SparkSession, sf: str) -> DataFrame:
    """F1-F8 over a snapshot laid out along a curve of price, plot and district."""
    path = f"{Workspace(spark, 'clustered').path}/snapshot"
    rows = proxies.houses(spark, sf)
    cluster.write_clustered(rows, path, files=16)
    wanted = query.ListingQuery(district="ASIA", min_price=100000, max_price=200000, min_plot=400, max_plot=1500)
    return wanted.filter(spark.read.schema(rows.schema).parquet(path)).select("seq", "source", "district", "price", "plotSqm")


def stats_from_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """A1, A4: the stats bar of three parts from their summaries, and the listings of two parts that overlap."""
    path = Workspace(spark, "summaries").path
    rows = proxies.houses(spark, sf)
    for part in range(3):
        summaries.write_summary(rows.where(col("seq") % 3 == part), path, str(part))
    summaries.write_summary(rows.where(col("seq") % 2 == 0), path, "even")
    bar = summaries.stats_bar(spark, path, ("0", "1", "2")).withColumn("_j", F.lit(1))
    both = summaries.distinct_listings(spark, path, ("0", "even")).withColumn("_j", F.lit(1))
    return bar.join(both, "_j").drop("_j")  # one row each


def facets_from_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """A2: sources with their counts and their place in first-seen order."""
    path = Workspace(spark, "summaries").path
    rows = proxies.houses(spark, sf)
    for part in range(3):
        summaries.write_summary(rows.where(col("seq") % 3 == part), path, str(part))
    return query.positions(summaries.facet_sources(spark, path)).select("source", "n", "first_seq", "position")


HEALTH = ("Bazaraki", "Kadis Estates", "Cyprus Properties", "Kazo Real Estate", "EstateBud-WP agencies")


def refresh_health(spark: SparkSession, sf: str) -> DataFrame:
    """A6, R1, SRC7: a failing source, one that gives nothing, sources that were not captured, and a sound one."""
    own = {s.registry: captures.capture(spark, sf, s.registry, "plot") for s in specs("plot") if s.registry in HEALTH[:3]}
    broken = own["Kadis Estates"].withColumn("page_no", F.lit(-1).cast("bigint"))
    empty = own["Cyprus Properties"].withColumn("html", F.lit("<html></html>"))
    bronze = {"json": own["Bazaraki"], "html": broken.unionByName(empty)}
    counts: dict[str, int] = {}
    listings, failed = refresh.extract_sources(spark, "plot", bronze, counts=counts)
    return refresh.health(spark, "plot", refresh.Refresh(listings, listings, failed, counts)).select("registry", "source_order", "n", "succeeded")


def capture_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """SRC3, SRC5, R3: captured pages and cards, those that give no listing, and those that do."""
    parts = []
    for registry, kind in (("Bazaraki", "house"), ("eAuction", "house"), ("Bazaraki", "plot")):
        spec, pages = specs(kind, registry)[0], captures.capture(spark, sf, registry, kind)
        # Of the cards only their place and whether they are valid: the fields behind need not be found, nor written.
        cards = extract.cards(spec, pages).select(*extract.CAPTURE, "pos", "valid")
        cards = Workspace(spark, "quarantine").table("cards", cards)
        held = extract.quarantine(spec, pages, cards)
        rows = [
            extract.pages_of(spec, pages).select("source", "kind", F.lit("page").alias("of")),
            cards.select("source", "kind", F.when(col("valid"), "sound").otherwise("invalid").alias("of")),
            held.select("source", "kind", F.concat(F.lit("held "), "reason").alias("of")),
        ]
        parts.append(rows[0].unionByName(rows[1]).unionByName(rows[2]))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("source", "kind", "of").agg(F.count("*").alias("n"))


def source_predicate(spark: SparkSession, sf: str) -> DataFrame:
    """a source's own predicate, an expression in its specification, over its first copies."""
    spec = replace(specs("house", "Bazaraki")[0], keep="price >= 100000 AND beds > 2")
    cards = extract.cards(spec, captures.capture(spark, sf, spec.registry, "house"))
    return captures.shown(extract.listings_of(cards))


def partial_walk(spark: SparkSession, sf: str) -> DataFrame:
    """A walk that stopped half way gives what was captured, and the run goes on with it."""
    last = proxies.table(spark, sf, "orders").agg(F.floor(F.max("o_orderkey") / 20) * 10 + 5).first()[0]
    pages = captures.capture(spark, sf, "Bazaraki", "plot").where(col("page_no") <= last + 1)
    listings, _ = refresh.extract_sources(spark, "plot", {"json": pages})
    return captures.shown(listings)


def refresh_all_failed(spark: SparkSession, sf: str) -> DataFrame:
    """R2: a refresh where every source fails publishes nothing; the snapshot stays as it was."""
    path = f"{Workspace(spark, 'all-failed').path}/snapshot"
    refresh.publish(proxies.houses(spark, sf), path, 1)
    pages = [captures.capture(spark, sf, name, "plot").withColumn("page_no", F.lit(-1).cast("bigint")) for name in ("Kadis Estates", "Cyprus Properties")]
    try:  # the sources of the other forms have no captures
        out = refresh.refresh(spark, "plot", {"html": pages[0].unionByName(pages[1])})
        refresh.publish(out.listings, path, 2)
        stopped = False
    except refresh.AllSourcesFailed:
        stopped = True
    return refresh.latest(spark, path).groupBy("source").agg(F.count("*").alias("n")).withColumn("stopped", F.lit(stopped))


def facet_places(spark: SparkSession, sf: str) -> DataFrame:
    """A2, A3: each facet value with its place: sources as first seen, districts and plot types by code point."""
    rows = proxies.plots(spark, sf)
    parts = [query.positions(stats.facet_sources(rows)).select(col("source").alias("value"), "position", F.lit("source").alias("facet"))]
    for name in ("district", "plotType"):
        parts.append(query.positions(stats.facet_values(rows, name)).select("value", "position", F.lit(name).alias("facet")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        snapshot_changes, publish_gate, cache_scan, enrich_stored, search_indexed, filter_clustered, stats_from_summaries,
        facets_from_summaries, refresh_health, capture_quarantine, source_predicate, partial_walk, refresh_all_failed, facet_places,
    )
    return {fn.__name__: fn for fn in found}
