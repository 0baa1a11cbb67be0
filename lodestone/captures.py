"""Captures of every source rebuilt from the star-schema tables.

Each listing becomes a card in the source's markup, so that the extraction job runs
on pages that grow with the tables. A page carries the card twice, the second time
with another price, and every tenth id repeats that of the page before: the
first-copy rule has work to do on the page and across pages.
"""

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog, fixed
from .plans import refresh
from .schema import CARD_TEXT
from .session import Workspace
from .sources import extract, proxies, readers
from .sources.specs import specs
from .streaming import ingest, silver

OUT = (
    "source", "kind", "ref", "title", "price", "priceDisplay", "location", "district", "image", "link", "houseSqm",
    "plotSqm", "beds", "baths", "posted", "postedTs", "buildYear", "agent", "auctionDate", "status", "plotType", "zone",
)
PLACES = ("Kato Paphos", "Strovolos", "Ayia Napa", "LIMASSOL marina", "Germasogeia", "Somewhere")
CITIES = ("Limassol", "Paphos", "Pafos", "Athens", "Ammochostos", "Nicosia", "Paralimni", "Ayia Napa")
TITLES = ("Commercial plot", "Open field", "Land", "Tourist view")
SECOND_PRICE = 77777
PREFIX = '<!DOCTYPE html><body class="list">'

# --- captures and queries -----------------------------------------------------------------

CARD, HTML, ITEM, POST, ENVELOPE = "card", "html", "item", "post", "envelope"
# Form of the capture, function in `markup.py`, capture partitions.
FORMS: dict[str, tuple[str, str, tuple[str, ...]]] = {
    "Altamira": (CARD, "altamira", ()),
    "Bazaraki": (ITEM, "bazaraki", fixed.BAZARAKI_PARTITIONS),
    "eAuction": (HTML, "eauction", ("3", "5", "6", "7", "9")),
    "Zyprus": (CARD, "zyprus", ()),
    "BidX1": (CARD, "bidx1", ()),
    "BuySellCyprus": (CARD, "buysell", ()),
    "home.cy": (CARD, "homecy", ()),
    "FOX Realty": (CARD, "fox", fixed.FOX_PARTITIONS),
    "Realting": (HTML, "realting", ()),
    "A Place in the Sun": (HTML, "apits", ()),
    "Kadis Estates": (HTML, "kadis", ()),
    "Kazo Real Estate": (CARD, "kazo", ()),
    "Cyprus Properties": (HTML, "cyprus_properties", ("house", "apartment")),
    "EstateBud-WP agencies": (ENVELOPE, "nch", ()),
    "DOM real estate": (HTML, "dom", ()),
    "Pafilia": (POST, "pafilia", ()),
    "Giovani Homes": (POST, "giovani", ()),
}


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A taxonomy with one term per nation, for both WordPress sources."""
    rows = proxies.table(spark, sf_dir, "nation").select(
        F.explode(F.array(F.lit("Pafilia"), F.lit("Giovani Homes"))).alias("source"),
        F.col("n_nationkey").alias("term_id"), F.element_at(F.array(*[F.lit(c) for c in CITIES]), (F.col("n_nationkey") % len(CITIES) + 1)).alias("name"),
    )
    return rows


def capture(spark: SparkSession, sf_dir: str, registry: str, kind: str) -> DataFrame:
    """Bronze rows of one source: one page per listing."""
    from .sources import markup as m

    form, card_name, partitions = FORMS[registry]
    card = getattr(m, card_name)
    if kind == "plot" and registry == "Cyprus Properties":
        partitions = ("land",)
    source = specs(kind, registry)[0].source
    price, second = m.whole("price"), F.lit(SECOND_PRICE).cast("bigint")
    head = [
        F.lit(source).alias("source"), F.lit(kind).alias("kind"),
        (m.pick(partitions, m.k) if partitions else F.lit("")).alias("partition"), (m.k + 1).alias("page_no"),
        F.timestamp_seconds(F.lit(1700000000)).alias("captured_at"),
    ]
    rows = proxies.spread(proxies.houses(spark, sf_dir), "seq")
    if form == CARD:
        unique = registry not in ("Altamira",)
        copies = [(0, price), (1, second)] if unique else [(0, price)]
        # One row with both cards, split in two: the listings are made and spread once.
        cards = [F.struct(F.lit(pos).alias("pos"), *[c.alias(n) for n, c in card(p, kind).items()]) for pos, p in copies]
        both = rows.select(*head, F.explode(F.array(*cards)).alias("card")).select("*", "card.*").drop("card")
        have = set(both.columns)
        return both.select(
            *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in CARD_TEXT.fields]
        )
    if form == POST:
        return rows.select(*head, F.to_json(F.array(card(price, kind))).alias("payload"))
    if form == ITEM:
        page = F.struct(F.array(card(price, kind), card(second, kind)).alias("results"), F.lit("n").alias("next"))
        broken = F.when(m.k % 50 == 0, F.lit("<html>blocked</html>")).otherwise(F.to_json(page))
        return rows.select(*head, broken.alias("payload"))
    page = F.concat(F.lit(PREFIX), card(price, kind), card(second, kind))
    if form == ENVELOPE:
        boxed = F.when(m.k % 2 == 0, F.to_json(F.struct(page.alias("html")))).otherwise(page)
        return rows.select(*head, boxed.alias("payload"))
    return rows.select(*head, m.tpl("https://c.test/@k@", k=m.k).alias("url"), page.alias("html"))


def listings(spark: SparkSession, sf_dir: str, registry: str, kind: str) -> DataFrame:
    """The extraction job over one source's captures."""
    spec = specs(kind, registry)[0]
    taxonomy = terms(spark, sf_dir) if FORMS[registry][0] == POST else None
    cards = extract.cards(spec, capture(spark, sf_dir, registry, kind), taxonomy)
    return shown(extract.listings_of(cards))


def query_name(registry: str, kind: str) -> str:
    word = re.sub(r"[^a-z0-9]+", "_", registry.lower()).strip("_")
    return f"extract_{word}_{kind}s"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def query(registry: str, kind: str):
        return lambda spark, sf_dir: listings(spark, sf_dir, registry, kind)

    out = {
        query_name(spec.registry, kind): query(spec.registry, kind) for kind in ("house", "plot") for spec in specs(kind)
    }
    return out | {"stream_refresh": stream_refresh, "stream_runs": stream_runs, "refresh_plots": refresh_plots, "refresh_houses": refresh_houses, "snapshot_publish": snapshot_publish}


def shown(listings: DataFrame) -> DataFrame:
    return listings.select(*OUT, F.when(F.col("images").isNotNull(), F.size("images")).alias("n_images"))


def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1: captures arrive as files, a stream types them, the snapshot is published again."""
    work = Workspace(spark, "stream-refresh")
    work.table("bronze", capture(spark, sf_dir, "Bazaraki", "plot"))
    ingest.ingest_cards(
        spark, "plot", "json", f"{work.path}/bronze", f"{work.path}/silver", f"{work.path}/checkpoint",
        max_files=4,
    ).awaitTermination()
    ingest.republish(spark, "plot", f"{work.path}/silver", f"{work.path}/snapshot", run=1)
    return shown(refresh.latest(spark, f"{work.path}/snapshot"))


def stream_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1, ST2, U4: two runs of all plot sources streamed into the store of cards, compacted, and published.

    The first run misses every seventh page, so the second publication decides those rows, and
    what they reach, and leaves the others.
    """
    work = Workspace(spark, "stream-runs")
    store = silver.Silver(spark, f"{work.path}/silver")
    bronze = bronze_of(spark, sf_dir, "plot")  # the pages of both runs
    for run, missing in ((1, F.col("page_no") % 7 == 0), (2, F.lit(False))):
        for form, pages in bronze.items():
            folder = f"{work.path}/bronze-{form}"
            pages.where(~missing).withColumn("run", F.lit(run).cast("bigint")).write.mode("append").parquet(folder)
            ingest.ingest_cards(spark, "plot", form, folder, store.path, f"{work.path}/checkpoint-{form}").awaitTermination()
        ingest.republish(spark, "plot", store.path, f"{work.path}/snapshot", run, since=run - 1 or None)
        store.compact("plot")
        store.expire("plot", keep_runs=1)
    return shown(refresh.latest(spark, f"{work.path}/snapshot"))


def bronze_of(spark: SparkSession, sf_dir: str, kind: str) -> dict[str, DataFrame]:
    """Captures of all sources of a dataset, in bronze tables laid out by kind and source."""
    work = Workspace(spark, f"bronze-{kind}")
    shapes, jobs = {}, []
    with ThreadPoolExecutor(refresh.SOURCES_AT_ONCE) as pool:
        for spec in specs(kind):
            pages = capture(spark, sf_dir, spec.registry, kind)
            shapes[spec.bronze] = pages.schema
            jobs.append(pool.submit(readers.store_captures, pages, f"{work.path}/{spec.bronze}", kind, spec.source))
        for job in jobs:
            job.result()
    return {form: readers.stored_captures(spark, f"{work.path}/{form}", shape) for form, shape in shapes.items()}


def refresh_plots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All plot sources extracted, united and deduplicated with the real priorities."""
    out = refresh.refresh(spark, "plot", bronze_of(spark, sf_dir, "plot"))
    return out.decisions.groupBy("source", "decision").agg(F.count("*").alias("n"))


def auction_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache entries from parts, under the codes of the auction listings."""
    number = F.expr("substring(code, 2)")
    return catalog._part_cache(spark, sf_dir).withColumn("code", F.concat(F.lit("Q"), number, F.lit("-001")))


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages of every second listing of two sources."""
    k = F.col("o_orderkey")
    rows = proxies.spread(proxies.table(spark, sf_dir, "orders"), "o_orderkey").where(k % 2 == 1)
    land, home = (100 + k % 900).cast("string"), (50 + k % 300).cast("string")
    pages = {
        "Realting": (
            F.concat(F.lit(fixed.SITES["Realting"] + "/cyprus/property/"), k),
            F.concat(F.lit("<div>Land area</div> <div> "), (101 + k % 900).cast("string"), F.lit("</div><div>Total area</div> <div> "), home, F.lit("</div>")),
        ),
        "Kadis Estates": (
            F.concat(F.lit("https://kadis.com.cy/property-"), k, F.lit("/x")),
            F.concat(F.lit("<p>Plot Area "), land, F.lit(".5m2</p>")),
        ),
    }
    each = [F.struct(F.lit(s).alias("source"), link.alias("link"), html.alias("html")) for s, (link, html) in pages.items()]
    captured = F.timestamp_seconds(F.lit(1000)).alias("captured_at")
    return rows.select(F.explode(F.array(*each)).alias("page")).select("page.source", "page.link", captured, "page.html")


def refresh_houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All house sources with terms, cache and details; the source without a taxonomy is reported."""
    known = terms(spark, sf_dir).where(F.col("source") == "Pafilia")
    out = refresh.refresh(
        spark, "house", bronze_of(spark, sf_dir, "house"), known, detail_pages(spark, sf_dir), auction_cache(spark, sf_dir)
    )
    kept = out.listings.select("source", "ref", "price", "district", "houseSqm", "plotSqm", "beds", "image", F.lit(False).alias("failed"))
    failed = spark.createDataFrame([(name, True) for name in out.failed], "source string, failed boolean")
    return kept.unionByName(failed, allowMissingColumns=True)


def snapshot_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1 and SRC1: two runs published side by side, the newest one read back, once more through JSON."""
    work = Workspace(spark, "publish")
    rows = proxies.houses(spark, sf_dir)
    refresh.publish(rows.where("price IS NULL"), f"{work.path}/snapshot", run=1)
    refresh.publish(rows, f"{work.path}/snapshot", run=2)
    readers.write_snapshot_json(refresh.latest(spark, f"{work.path}/snapshot"), f"{work.path}/json")
    back = readers.snapshot_json(spark, f"{work.path}/json")
    return back.drop("images", "agent", "status", "registration", "plotType", "zone")
