"""Every registered query: a callable of (spark, sf_dir) over the given tables."""

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixed
from .functions import labels, numbers as n, places, text as t
from .operators import dedup, dedup_changes, documents, enrich
from .plans import query as q, stats
from .session import Workspace
from .sources import extract, proxies, readers
from .sources.proxies import table
from .streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

HOUSE_RULE = replace(dedup.HOUSES, priority=proxies.PRIORITY)
PLOT_RULE = replace(dedup.PLOTS, priority=proxies.PRIORITY)
AS_OF_MS = 1009843200000  # 2002-01-01 UTC
AS_OF = "2024-02-01 00:00:00"


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


col = F.col

# --- snapshot, union, places -----------------------------------------------------


@register
def listing_snapshot(spark, sf):
    """Canonical projection of every listing."""
    return proxies.houses(spark, sf).drop("images", "agent", "status", "registration", "plotType", "zone")


@register
def union_heterogeneous(spark, sf):
    """Sources with different fields; what a source lacks is null."""
    buyers = table(spark, sf, "customer").select(
        col("c_custkey").alias("seq"), F.lit("customers").alias("source"), col("c_name").alias("ref"),
        col("c_acctbal").alias("price"), col("c_mktsegment").alias("propertyType"),
    )
    sellers = table(spark, sf, "supplier").select(
        col("s_suppkey").alias("seq"), F.lit("suppliers").alias("source"), col("s_name").alias("agent"),
        col("s_acctbal").alias("price"),
    )
    both = extract.union_listings([buyers, sellers])
    return both.select("seq", "source", "ref", "price", "propertyType", "agent", "beds")


DISTRICT_WORDS = ("Pafos", "Lefkosia", "Ammochostos", "Germasogeia", "Lemesos", "Larnaca", "Paphos", "Elsewhere")


def pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


@register
def canonical_district(spark, sf):
    """D8 over one spelling per order."""
    spelled = F.when(col("o_orderkey") % 9 != 0, pick(DISTRICT_WORDS, col("o_orderkey")))
    return table(spark, sf, "orders").select(
        "o_orderkey", spelled.alias("spelled"), places.canonical(spelled).alias("district")
    )


PLACE_WORDS = (
    "Lakatameia", "PAPHOS", "Kato Pafos", "Somewhere", "Ayia Napa", "Germasogeia", "Larnaka", "Strovolos hill",
    "Nicosia", "Kouklia", "Mesa Geitonia", "Livadia", "Lemesos", "Pyrgos", "",
)
REGION_WORDS = ("Cyprus", "Limassol", "Famagusta district", "Engomi", "", "Old larnaca road", "Protaras")


def place_text() -> Column:
    k = col("p_partkey")
    return F.concat(pick(PLACE_WORDS, k), F.lit(", "), pick(REGION_WORDS, F.floor(k / 3)), F.lit(", "), col("p_name"))


@register
def district_resolve(spark, sf):
    """D1-D5 and D7 (J8) over a place text per part."""
    text = table(spark, sf, "part").select("p_partkey", place_text().alias("place"))
    c = col("place")
    return text.select(
        "p_partkey",
        places.by_substring(c).alias("d1"),
        places.by_alias(c, fixed.REALTING_AREAS).alias("d2"),
        places.by_first_segment(c, fixed.KADIS_AREAS).alias("d3"),
        places.by_first_segment(c, fixed.KADIS_PLOT_AREAS, transliterate=False).alias("d3_plots"),
        places.by_last_segment(c, fixed.KAZO_AREAS).alias("d4"),
        places.by_last_segment(c, fixed.CYPRUS_PROPERTIES_AREAS).alias("d4_cp"),
        places.by_word(c).alias("d5"),
        t.nth(places.comma_parts(c), 1).alias("d7_first"),
        t.last(places.comma_parts(c)).alias("d7_last"),
    )


CODE_WORDS = ("LIMASSOL", "NICOSIA", "PAFOS", "FAMAGUSTA", "LARNACA", "KYRENIA EAST", "TROODOS-HILLS")


@register
def district_codes(spark, sf):
    """Exact tables with a title-case fallback."""
    word = F.when(col("s_suppkey") % 8 != 7, pick(CODE_WORDS, col("s_suppkey")))
    city = pick((*fixed.GIOVANI_CITIES, "Athens"), col("s_suppkey"))
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        places.by_code(word, fixed.AUCTION_DISTRICTS, t.title_case(word)).alias("d6"),
        places.mapped(city, fixed.GIOVANI_CITIES).alias("d9"),
    )


# --- order, first copies, links ----------------------------------------------------


@register
def source_priority_order(spark, sf):
    """Priority rank and place in the visiting order; two sources are unlisted."""
    rows = dedup.priority_order(proxies.houses(spark, sf).select("seq", "source"), proxies.PRIORITY[1:4])
    return q.positions(rows)


LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@register
def insource_first_wins(spark, sf):
    """U1, null ids kept: first copy of each (order, line); returned lines carry no id."""
    item = F.when(col("l_returnflag") != "R", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    order = (*LINE, "l_discount", "l_tax", "l_linestatus", "l_shipdate", "l_returnflag")
    rows = table(spark, sf, "lineitem").withColumn("item_id", item)
    return extract.first_copies(rows, [], order=order).select(*LINE, "item_id")


@register
def insource_drop_null_ids(spark, sf):
    """U1, null ids dropped."""
    item = F.when(col("l_returnflag") != "R", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    order = (*LINE, "l_discount", "l_tax", "l_linestatus", "l_shipdate", "l_returnflag")
    rows = table(spark, sf, "lineitem").withColumn("item_id", item).where("item_id IS NOT NULL")
    return extract.first_copies(rows, [], order=order).select(*LINE, "item_id")


@register
def link_keys(spark, sf):
    """U2, G9 and G10 over page addresses."""
    url = col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        t.link_key(F.concat(F.upper(url), F.lit("//"))).alias("link_key"),
        t.without_query(url).alias("no_query"),
        t.grab(url, r"/(\d+)(?:[/?#]|$)").alias("ref"),
        t.absolute(t.grab(url, r"^https?://[^/]+(/.*)$"), "https://site.test").alias("absolute"),
    )


# --- cross-source matching ----------------------------------------------------------


@register
def same_property_matches(spark, sf):
    """Matches of each house at other sources, without building pairs."""
    return dedup.match_summary(proxies.houses(spark, sf), HOUSE_RULE)


@register
def same_plot_matches(spark, sf):
    """J6."""
    return dedup.match_summary(proxies.plots(spark, sf), PLOT_RULE)


@register
def dedup_houses(spark, sf):
    """Decision per house, with the kept row it met."""
    return dedup.decide(proxies.houses(spark, sf), HOUSE_RULE)


@register
def dedup_plots(spark, sf):
    """U4 and U5."""
    return dedup.decide(proxies.plots(spark, sf), PLOT_RULE)


@register
def dedup_unlisted_sources(spark, sf):
    """U3 where only two sources are listed: the other three share the last rank."""
    rule = replace(HOUSE_RULE, priority=proxies.PRIORITY[:2])
    return dedup.decide(proxies.houses(spark, sf), rule)


@register
def dedup_incremental(spark, sf):
    """U3 and ST1: decisions of all houses, from those of an earlier run where some were absent, others priced or linked otherwise."""
    new = proxies.houses(spark, sf)
    k = col("seq")
    old = new.where(k % 41 != 0).withColumns(
        {"price": F.when(k % 43 == 0, col("price") + 5000).otherwise(col("price")), "link": F.when(k % 47 != 0, col("link"))}
    )
    old = old.unionByName(new.where(k % 53 == 0).withColumns({"seq": k + (1 << 40), "link": F.lit(None).cast("string")}))
    known = Workspace(spark, "dedup-before").table("rows", old.select(*dedup_changes.matching_columns(HOUSE_RULE)))
    decided = dedup.decide(known, HOUSE_RULE)
    return dedup_changes.decide_changes(known, decided, new, HOUSE_RULE).drop("again")


@register
def dedup_report(spark, sf):
    """A5 for houses and plots."""
    parts = [
        stats.dedup_report(dedup.decide(rows, rule)).withColumn("kind", F.lit(kind))
        for kind, rows, rule in (
            ("house", proxies.houses(spark, sf), HOUSE_RULE),
            ("plot", proxies.plots(spark, sf), PLOT_RULE),
        )
    ]
    return parts[0].unionByName(parts[1])


# --- filters ------------------------------------------------------------------------


@register
def filter_price_keep_null(spark, sf):
    """F4."""
    return q.ListingQuery(min_price=100000, max_price=200000).filter(proxies.houses(spark, sf)).select("seq", "price")


@register
def filter_attr_drop_null(spark, sf):
    """F5-F8."""
    bounds = q.ListingQuery(min_sqm=120, min_plot=400, max_plot=1500, min_year=1975, min_beds=2)
    return bounds.filter(proxies.houses(spark, sf)).select("seq", "houseSqm", "plotSqm", "buildYear", "beds")


@register
def filter_zero_bound(spark, sf):
    """zero is an active bound."""
    return q.ListingQuery(min_plot=0).filter(proxies.houses(spark, sf)).select("seq", "plotSqm")


@register
def filter_sources(spark, sf):
    """F1 and F2."""
    some = q.ListingQuery(sources=frozenset(("1-URGENT", "5-LOW")), district="ASIA")
    return some.filter(proxies.houses(spark, sf)).select("seq", "source", "district")


@register
def filter_no_source(spark, sf):
    """an empty selection gives nothing."""
    return q.ListingQuery(sources=frozenset()).filter(proxies.houses(spark, sf)).select("seq", "source")


@register
def filter_plot_type(spark, sf):
    """F3."""
    return q.ListingQuery(plot_type="Residential").filter(proxies.plots(spark, sf)).select("seq", "plotType")


@register
def search_text(spark, sf):
    """F9 over title, location and reference."""
    return q.ListingQuery(q="NATION_1").filter(proxies.houses(spark, sf)).select("seq", "title", "location", "ref")


@register
def search_documents(spark, sf):
    """F9 over whole texts; the search text is literal, so `.` and `%` are themselves."""
    docs = table(spark, sf, "documents")
    listing = docs.select(
        col("doc_id").alias("seq"), col("text").alias("title"), col("lang").alias("location"), col("source").alias("ref")
    )
    dotted = q.ListingQuery(q="e. T").filter(listing).select("seq", F.lit("e. T").alias("q"))
    percent = q.ListingQuery(q="%%").filter(listing).select("seq", F.lit("%%").alias("q"))
    return dotted.unionAll(percent)


COMBINED = q.ListingQuery(
    sources=frozenset(("1-URGENT", "2-HIGH", "5-LOW")), min_price=50000, max_price=400000, min_beds=2, min_plot=300, q="building"
)


@register
def filter_combined(spark, sf):
    """all predicates at once."""
    return COMBINED.filter(proxies.houses(spark, sf)).select("seq", "source", "price", "beds", "plotSqm", "title")


# --- sorts --------------------------------------------------------------------------


def _sorted_by(sort: str) -> Query:
    def run(spark, sf):
        rows = proxies.plots(spark, sf) if sort == "plot_asc" else proxies.houses(spark, sf)
        return q.positions(q.ListingQuery(sort=sort).run(rows, as_of_ms=AS_OF_MS).select("seq"))

    run.__doc__ = f"Order {sort}: place of every listing."
    return run


for _sort in q.SORTS:
    QUERIES[f"sort_{_sort}"] = _sorted_by(_sort)


@register
def sort_default(spark, sf):
    """The default order of each dataset."""
    houses = q.positions(q.reset().run(proxies.houses(spark, sf), "house").select("seq"))
    plots = q.positions(q.reset().run(proxies.plots(spark, sf), "plot").select("seq"))
    return houses.withColumn("kind", F.lit("house")).unionByName(plots.withColumn("kind", F.lit("plot")))


@register
def cheapest_listings(spark, sf):
    """L1 and O1: the first fifty of a filtered list, a top-k plan."""
    return COMBINED.run(proxies.houses(spark, sf), limit=50).select("seq", "price")


@register
def page_caps(spark, sf):
    """L2: a page cap per source is a pushed-down predicate."""
    return extract.capped(_day_pages(spark, sf), {"click": 3, "view": 5}, default=10).groupBy("source").agg(F.count("*").alias("n"))


# --- statistics -----------------------------------------------------------------------


@register
def stats_bar(spark, sf):
    """A1."""
    return stats.stats_bar(proxies.houses(spark, sf))


@register
def stats_bar_empty(spark, sf):
    """A1 where no listing is priced: the average is 0."""
    return stats.stats_bar(proxies.houses(spark, sf).where("price IS NULL"))


@register
def facet_sources(spark, sf):
    """A2."""
    return stats.facet_sources(proxies.houses(spark, sf))


@register
def facet_values(spark, sf):
    """Districts and plot types."""
    rows = proxies.plots(spark, sf)
    parts = [stats.facet_values(rows, c).select("value", F.lit(c).alias("facet")) for c in ("district", "plotType")]
    return parts[0].unionByName(parts[1])


@register
def result_counts(spark, sf):
    """A4."""
    return stats.counts_in_one_pass(proxies.houses(spark, sf), COMBINED.matches())


@register
def source_health(spark, sf):
    """Rows per registered source, also for a source without rows."""
    names = table(spark, sf, "orders").select(col("o_orderpriority").alias("source")).distinct()
    registry = names.unionByName(table(spark, sf, "region").select(col("r_name").alias("source")))
    return stats.source_health(registry, proxies.houses(spark, sf), failed=("ASIA",))


@register
def harvest_report(spark, sf):
    """A7 over cache entries derived from parts."""
    return stats.harvest_report(_part_cache(spark, sf))


# --- labels ---------------------------------------------------------------------------


@register
def price_per_sqm(spark, sf):
    """M4 and M5."""
    ratio = labels.price_per_sqm(col("price"), col("plotSqm"))
    rows = proxies.houses(spark, sf)
    return rows.select("seq", ratio.alias("ratio"), labels.per_sqm_label(ratio).alias("label"))


@register
def price_labels(spark, sf):
    """M3 and M8."""
    rows = proxies.houses(spark, sf)
    return rows.select(
        "seq",
        labels.price_label(col("price"), col("priceDisplay")).alias("label"),
        labels.short_name(col("title"), "house").alias("first_word"),
    )


@register
def short_names(spark, sf):
    """M8 over publisher names."""
    name = pick(fixed.HOUSE_PRIORITY, col("c_custkey"))
    return table(spark, sf, "customer").select(
        "c_custkey", labels.short_name(name, "house").alias("house"), labels.short_name(name, "plot").alias("plot")
    )


def _cards(rows: DataFrame, kind: str) -> DataFrame:
    return q.card_view(rows, kind).withColumn("chips", F.array_join("chips", "|"))


@register
def card_view(spark, sf):
    """P3 for houses."""
    return _cards(proxies.houses(spark, sf), "house")


@register
def card_view_plots(spark, sf):
    """P3 for plots."""
    return _cards(proxies.plots(spark, sf), "plot")


@register
def posted_age(spark, sf):
    """M6 and M7 at a fixed time."""
    rows = proxies.houses(spark, sf)
    return rows.select(
        "seq",
        labels.posted_rank(col("posted")).alias("rank"),
        F.round(labels.effective_age(col("postedTs"), col("posted"), AS_OF_MS), 6).alias("age"),
    )


@register
def posted_text(spark, sf):
    """M1 and M2: time stamp text to epoch and display."""
    text = F.when(col("o_orderkey") % 6 == 0, F.lit("soon")).otherwise(
        F.date_format(proxies.instant("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss")
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        labels.epoch_ms(text).alias("ms"),
        labels.posted_display(labels.epoch_ms(text)).alias("posted"),
    )


# --- parsing ------------------------------------------------------------------------------


@register
def price_parse(spark, sf):
    """N1-N10 over prices written in each style."""
    cents = F.floor(col("p_retailprice") * 100).cast("bigint")
    commas = F.format_number(cents, 0)
    dots = F.replace(commas, F.lit(","), F.lit("."))
    k = col("p_partkey")
    part = F.lpad((cents % 100).cast("string"), 2, "0")
    millions = F.concat(F.lit("€"), (1 + k % 9).cast("string"), F.lit(","), part, F.lit("M"))
    shown = F.concat(F.lit("€"), commas)
    either = F.when(k % 2 == 0, F.concat(shown, F.lit(" 5 4"))).otherwise(F.concat(commas, F.lit("€ 5 4 272sqm")))
    attribute = F.when(k % 2 == 0, F.concat(F.lit('<b itemprop="price" content="'), cents, F.lit('">'))).otherwise(
        F.concat(F.lit('<b content="'), cents, F.lit('" itemprop="price">'))
    )
    return table(spark, sf, "part").select(
        "p_partkey",
        n.price_commas(F.when(k % 7 == 0, F.lit("€0")).otherwise(shown)).alias("n1"),
        n.price_dots(F.concat(F.lit("€"), dots, F.when(k % 5 == 0, F.lit(",00")).otherwise(""))).alias("n2"),
        n.price_both(F.concat(dots, F.lit(","))).alias("n3"),
        n.price_decimal(F.concat(F.lit("EUR "), cents, F.lit(".5"))).alias("n4"),
        n.price_digits(F.concat(F.lit("EUR "), dots)).alias("n5"),
        n.price_or_millions(F.when(k % 3 == 0, millions).otherwise(F.concat(F.lit("from € "), commas))).alias("n6"),
        n.price_bracketed(F.concat(F.lit("£"), commas, F.when(k % 2 == 0, F.concat(F.lit(" [€"), commas, F.lit("]"))).otherwise(" €99"))).alias("n7"),
        n.price_either_side(either).alias("n8"),
        n.price_euro_commas(F.when(k % 7 == 0, F.lit("€0")).otherwise(F.concat(F.lit("Price "), shown))).alias("n9"),
        n.number(
            F.coalesce(
                t.grab(attribute, r'itemprop="price"[^>]*content="(\d+)"'),
                t.grab(attribute, r'content="(\d+)"[^>]*itemprop="price"'),
            )
        ).alias("n10"),
    )


@register
def number_parse(spark, sf):
    """N11-N18 and G2, G3 over texts built from parts."""
    k, size = col("p_partkey"), col("p_size")
    area = F.concat(size, F.lit("."), k % 10, pick((" m²", " m2", "sqm", " SQM"), k))
    two = F.concat(col("p_name"), F.lit(" "), size, F.lit(" m² and "), size + 7, F.lit(" m²"))
    beds = F.concat(F.lit("€ 1,000 "), F.when(k % 2 == 0, F.concat(size, F.lit(" Beds 2 baths"))).otherwise(F.concat(size, F.lit(" 3 90sqm"))))
    kind = pick(("Residential plot", "Agricultural Field", "Open FIELD", "Battlefield", "Tourist land", "Shop"), k)
    token = pick(("1.234,5", "12,50", "900", "3000000", "a1", "7/8"), k)
    share = F.concat(size % 7, F.lit("/"), k % 9)
    labelled = t.grab(beds, r"(?i)(\d+)\s*(?:Beds?|bed)")
    return table(spark, sf, "part").select(
        "p_partkey",
        n.to_int(F.concat(F.lit("about "), size, F.lit(".5 m"))).alias("n11"),
        n.grab_number(F.concat(F.lit("Land: "), F.format_number(size * 1000, 0)), r"Land: ([\d,]+)").alias("n12"),
        n.area_any_unit(area).alias("n13"),
        n.areas(two, 1).alias("n14_first"),
        n.areas(two, 2).alias("n14_second"),
        n.int_of(F.coalesce(labelled, t.grab(beds, r"(?i)€\s*[\d,]+ (\d+)\s+(\d+)\s+[\d.,]+\s*(?:m²|m2|sqm)"))).alias("n15"),
        n.year_between(n.number(F.concat(k % 400 + 1750))).alias("n16"),
        n.notice_area(token).alias("n17"),
        n.share_is_valid(share).alias("n18"),
        t.plot_type(kind, fixed.PLOT_TYPES, True).alias("g2"),
        t.plot_type(kind, fixed.PLOT_TYPES, False).alias("g2_strict"),
        t.planning_zone(pick(("--", "Ka4", " - ", "H2-a"), k)).alias("g3"),
    )


@register
def text_clean(spark, sf):
    """Title case, slugs, splits, tags and entities."""
    k, name = col("p_partkey"), col("p_name")
    slug = F.concat(F.lit("https://x.test/p/"), F.replace(name, F.lit(" "), F.lit("-")), F.lit("-for-sale-"), k, F.lit("/"))
    headed = F.concat(name, F.lit(" - "), col("p_brand"), F.lit(" - "), col("p_type"))
    after = F.split(headed, " - ", 2)
    placed = F.concat(F.lit("Villa in "), name, F.lit(" / "), col("p_brand"))
    tagged = F.concat(F.lit("<b> "), name, F.lit("</b>\n<i>"), col("p_type"), F.lit("</i> "))
    return table(spark, sf, "part").select(
        "p_partkey",
        t.title_case(F.concat(col("p_type"), F.lit("-"), name, F.lit("  x"))).alias("g1"),
        t.slug_title(slug).alias("g5"),
        t.trim(t.nth(after, 2)).alias("g6_after"),
        t.swap(t.grab(placed, r"(?i)\bin\s+(.+)$"), r"\s*/\s*", ", ").alias("g6_place"),
        t.strip_tags(tagged).alias("g7"),
        t.replace_all(F.concat(name, F.lit(" &amp; &#8211; "), col("p_brand")), {"&#8211;": "–", "&amp;": "&"}).alias("g8"),
        t.labelled(
            F.concat(F.lit("<p>Plot Size:</span> <span> "), k, F.lit("</span>")), "", "Plot Size", r":</span>\s*<span>\s*", r"\d+"
        ).alias("g12"),
        t.nth(t.lines(F.concat(F.lit("\n "), name, F.lit("\n\n"), col("p_brand"), F.lit("\n"))), 1).alias("g11_first"),
        t.last(t.lines(F.concat(F.lit("\n "), name, F.lit("\n\n"), col("p_brand"), F.lit("\n")))).alias("g11_last"),
        t.last(F.split(t.title_case(t.swap(F.concat(F.lit("D. A,"), name), r"^D\.\s*", "")), ",")).alias("g14"),
    )


# --- enrichment ------------------------------------------------------------------------------


def _part_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Cache entries from parts, in the cache schema."""
    k = col("p_partkey")
    return table(spark, sf, "part").select(
        F.concat(F.lit("R"), k).alias("code"),
        F.when(k % 8 != 0, col("p_size").cast("double")).alias("plotSqm"),
        F.lit(None).cast("double").alias("houseSqm"),
        F.when(k % 6 != 0, F.concat(F.lit("/photos/"), k, F.lit("-1.jpg"))).alias("image"),
        F.when(k % 6 != 0, F.array(F.concat(F.lit("/photos/"), k, F.lit("-1.jpg")))).alias("images"),
        F.when(k % 4 == 0, F.lit("1/2")).alias("share"),
        F.when(k % 4 != 1, col("p_type")).alias("propertyType"),
        F.when(k % 3 == 0, col("p_brand")).alias("registration"),
    )


@register
def enrich_left_join(spark, sf):
    """One source's listings get the cache's facts, unmatched ones nulls."""
    rows = proxies.houses(spark, sf)
    rows = enrich.merge_cache(rows, _part_cache(spark, sf), source="1-URGENT", n_rows=rows.count())
    return rows.select("seq", "source", "houseSqm", "plotSqm", "image", "share", "propertyType", "registration")


DETAIL_SOURCES = ("Altamira Real Estate", "Realting", "A Place in the Sun", "Kadis Estates", "Giovani Homes")


def _detail_listings(spark: SparkSession, sf: str) -> DataFrame:
    rows = proxies.houses(spark, sf)
    return rows.withColumns(
        {
            "source": pick(DETAIL_SOURCES, col("seq")),
            "link": F.when(col("seq") % 11 == 0, F.lit(fixed.SITES["Altamira Real Estate"])).otherwise(
                F.concat(F.lit("https://d.test/"), col("seq"))
            ),
        }
    )


def _detail_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Two captures of a detail page per order, the newer one counts; for an even key the
    page is at an address no listing has."""
    k = col("o_orderkey")
    first = proxies.spread(table(spark, sf, "orders"), "o_orderkey")
    both = first.withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    land, home, baths, year = 100 + k % 900 + col("v"), 50 + k % 300, k % 4, 1795 + k % 320
    source = pick(DETAIL_SOURCES, k)

    def page(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    ld = page('<script type="application/ld+json">{broken</script><script type="application/ld+json">{"floorSize":{"value":', home,
              '},"yearBuilt":"', year, '","numberOfFullBathrooms":', baths, "}</script>")
    html = (
        F.when(source == DETAIL_SOURCES[0], page('<i class="superf_land"> ', land, ' m2</i><i class="hab"> ', 1 + k % 5,
               '</i><i class="ban">', baths, "</i> It was built around ", year, "."))
        .when(source == DETAIL_SOURCES[1], F.concat(page("<div>Land area</div> <div> ", land, "</div>"), ld))
        .when(source == DETAIL_SOURCES[2], page("Property Size: ", home, " m Plot size: 1,", F.lpad(land.cast("string"), 4, "0"), " Bathrooms: ", baths))
        .when(source == DETAIL_SOURCES[3], page("<p>Plot Area ", land, ".5m2</p>"))
        .otherwise(page("<strong>Price:</strong> <span>€ ", k % 5 * 1000, "</span><strong>Property Size :</strong> ", home,
                        ".6 m<strong>Bedrooms:</strong>", 1 + k % 5, "<strong>Bathrooms:</strong>", baths, "<"))
    )
    return both.select(
        source.alias("source"), F.concat(F.when(k % 2 == 1, "https://d.test/").otherwise("https://gone.test/"), k).alias("link"),
        F.timestamp_seconds(F.lit(1000) + col("v")).alias("captured_at"), html.alias("html"),
    )


@register
def enrich_merge_policy(spark, sf):
    """J2, J3, G12 and SRC6: detail pages joined by link with a policy per source and field."""
    rows = _detail_listings(spark, sf)
    rows = enrich.merge_details(rows, enrich.detail_fields(_detail_pages(spark, sf)), n_rows=rows.count())
    return rows.select("seq", "source", "price", "houseSqm", "plotSqm", "beds", "baths", "buildYear")


@register
def detail_inner_priced(spark, sf):
    """A source priced on its detail page keeps only the priced listings, any other keeps all."""
    rows = _detail_listings(spark, sf)
    rows = enrich.merge_details(rows, enrich.detail_fields(_detail_pages(spark, sf)), n_rows=rows.count())
    late = F.when(col("source").isin(*enrich.PRICED_ON_DETAIL), col("priceDisplay"))
    return rows.select("seq", "source", "price", late.alias("priceDisplay"))


def _order_terms(spark: SparkSession, sf: str) -> DataFrame:
    k = col("o_orderkey")
    ids = F.array((k % 97).cast("int"), (col("o_custkey") % 53).cast("int"), ((k + 5) % 211).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", ids.alias("ids"))


@register
def term_lookup(spark, sf):
    """Ids to names in id order, first mapped nation, membership tests."""
    terms = table(spark, sf, "supplier").select(
        col("s_suppkey").cast("int").alias("term_id"), col("s_name").alias("name")
    )
    orders = _order_terms(spark, sf)
    n_ids = 3 * orders.count()
    rows = enrich.lookup_names(orders, ["o_orderkey"], col("ids"), terms, "names", n_ids)
    return rows.select(
        "o_orderkey",
        F.array_join("names", ", ").alias("names"),
        t.nth(col("names"), 1).alias("first_name"),
        F.array_contains("ids", 7).alias("has_seven"),
        (~F.array_contains("ids", 29)).alias("lacks_29"),
        F.size(F.array_distinct("ids")).alias("n_distinct"),
    )


@register
def cache_upsert(spark, sf):
    """SNK2: customers as the cache, facts of their orders as the harvest."""
    old = table(spark, sf, "customer").select(
        col("c_custkey").alias("code"), col("c_mktsegment").alias("segment"), col("c_acctbal").alias("amount"),
        F.lit(None).cast("string").alias("status"),
    )
    new = table(spark, sf, "orders").groupBy((col("o_custkey") + 10).alias("code")).agg(
        F.max(F.when(col("o_orderstatus") == "P", col("o_totalprice"))).alias("amount"),
        F.max("o_orderstatus").alias("status"),
        F.lit(None).cast("string").alias("segment"),
    )
    return enrich.upsert(old, new, "code")


# --- pages and payloads ---------------------------------------------------------------------------


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", "html")


@register
def pages_cards(spark, sf):
    """SRC4 and G7: pages split at a marker, the head dropped, tags stripped."""
    cards = readers.html_cards(_pages(spark, sf), "<p>")
    return cards.select("page_id", "pos", t.strip_tags(col("card")).alias("text"))


@register
def pages_fields(spark, sf):
    """Fields of whole pages by pattern."""
    h = col("html")
    return _pages(spark, sf).select(
        "page_id",
        t.grab(h, "<title>([^<]*)</title>").alias("title"),
        t.grab(h, r'<html lang="([a-z]+)"').alias("lang"),
        t.strip_tags(t.grab(h, "(?s)<h1>(.*?)</h1>")).alias("heading"),
        n.grab_number(h, r"track\((\d+)\)").alias("track"),
        F.size(t.grab_all(h, "(<p>)")).alias("paragraphs"),
    )


@register
def pages_links(spark, sf):
    """Distinct links of each page, in page order."""
    links = F.array_distinct(t.grab_all(col("html"), r'<a href="([^"]+)"'))
    return _pages(spark, sf).select("page_id", F.size(links).alias("n_links"), F.array_join(links, " ").alias("links"))


@register
def json_payload(spark, sf):
    """SRC3, SRC5 and G13: open maps, JSON-or-raw payloads, first meta value."""
    props = F.from_json("props", "map<string,string>")
    boxed = F.concat(F.lit('{"html":"<p>'), col("event_type"), F.lit('</p>"}'))
    payload = F.when(col("event_id") % 3 == 0, boxed).when(col("event_id") % 3 == 1, col("props")).otherwise(
        F.concat(F.lit("<p>raw "), col("event_type"), F.lit("</p>"))
    )
    meta = F.from_json(F.concat(F.lit('{"a":["'), col("user_id"), F.lit('"],"b":[]}')), "map<string,array<string>>")
    return table(spark, sf, "events").select(
        "event_id",
        n.number(F.try_element_at(props, F.lit("k"))).alias("k"),
        readers.html_of_payload(payload).alias("html"),
        F.coalesce(t.nth(F.try_element_at(meta, F.lit("a")), 1), F.lit("")).alias("meta_a"),
        F.coalesce(t.nth(F.try_element_at(meta, F.lit("b")), 1), F.lit("")).alias("meta_b"),
    )


# --- documents ----------------------------------------------------------------------------------------


def _tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as positioned tokens: an order is a page, quantity and price give the place."""
    return table(spark, sf, "lineitem").select(
        col("l_orderkey").alias("code"), F.lit(1).alias("page"), "l_partkey", "l_linenumber",
        col("l_quantity").cast("int").alias("x"), (F.floor(col("l_extendedprice") / 100) % 200).cast("int").alias("y"),
    )


@register
def band_join_tokens(spark, sf):
    """Tokens near each row marker, by height."""
    tokens = _tokens(spark, sf)
    anchors = tokens.where(col("l_linenumber") == 1).select(
        "code", "page", col("l_partkey").alias("marker"), col("y").alias("anchor_y")
    )
    pairs = documents.band_join(anchors, tokens, ["code", "page"], fixed.NOTICE_ROW_BAND)
    return pairs.groupBy("code", "marker", "anchor_y").agg(
        F.count("*").alias("n"),
        F.min(F.when(F.abs(col("x") - 20) <= 10, col("x"))).alias("leftmost"),
        F.count_if(F.abs(col("x") - 40) <= 5).alias("near_40"),
    )


@register
def notice_table(spark, sf):
    """Whole notice pages, one per order, laid out from its facts."""
    return documents.notice_rows(_notice_items(spark, sf)).select(
        "code", "doc", "idx", "registration", "share", "areaSqm", "propertyType"
    )


def _harvested(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of a harvest: the notices of all orders, and two photographs of each."""
    lines = table(spark, sf, "lineitem").where(col("l_linenumber") <= 2)
    photos = lines.select(
        col("l_orderkey").cast("string").alias("code"), col("l_linenumber").alias("n"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("image"),
    )
    return documents.harvest_entries(documents.notice_rows(_notice_items(spark, sf)), photos)


@register
def harvest_cache(spark, sf):
    """J10, SNK2: a harvest merged into the cache, written under a new name and read back."""
    old = _part_cache(spark, sf).withColumn("code", F.substring("code", 2, 20))
    merged = enrich.upsert(old, _harvested(spark, sf), "code")
    cache = Workspace(spark, "cache").table("entries", merged)
    return cache.select("code", "plotSqm", "share", "propertyType", "registration", F.size("images").alias("n_images"))


@register
def harvest_summary(spark, sf):
    """A7 over a whole harvest."""
    return stats.harvest_report(_harvested(spark, sf))


GREEK = tuple(fixed.NOTICE_PROPERTY_TYPES)


def _notice_items(spark: SparkSession, sf: str) -> DataFrame:
    k = col("o_orderkey")
    word = pick((*GREEK, "ΑΛΛΟ"), k)
    cells = [
        (0, F.lit("Αριθμός Εγγραφής Εγγραφή"), 60, 10), (1, F.lit("Έκταση τ.μ."), 200, 10),
        (2, F.lit("Εγγεγραμμένο"), 290, 10), (3, F.lit("συμφέρον"), 300, 12), (4, F.lit("Είδος"), 400, 10),
    ]
    for lot in (1, 2):
        y, at = 60 * lot, 10 * lot
        cells += [
            (at, F.lit(f"{lot}.*"), 20, y),
            (at + 1, F.concat(F.lit("0/"), k), 70, y + 3),
            (at + 2, F.concat((k % 5 * lot).cast("string"), F.lit("/4")), 310, y - 21),
            (at + 3, F.concat((k % 1000).cast("string"), F.lit(f".{lot}00,5")), 205, y + 21),
            (at + 4, F.lit("999"), 206, y + 22),
            (at + 5, word if lot == 1 else F.concat(F.lit("παλαιά "), word), 410 if lot == 1 else 480, y),
        ]
    rows = F.array(
        *[F.struct(F.lit(i).alias("item_no"), s.alias("s"), F.lit(x).alias("x"), F.lit(y).alias("y")) for i, s, x, y in cells]
    )
    return proxies.spread(table(spark, sf, "orders"), "o_orderkey").select(
        k.cast("string").alias("code"),
        F.explode(F.when(k % 10 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))).alias("doc"),
        F.lit(1).alias("page"), rows.alias("cells"),
    ).select("code", "doc", "page", F.explode("cells").alias("i")).select("code", "doc", "page", "i.*")


@register
def lot_select(spark, sf):
    """The lot a code asks for, else the first row."""
    suffix = F.when(col("l_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("-00"), 1 + col("l_orderkey") % 4))
    rows = table(spark, sf, "lineitem").select(
        F.concat(F.lit("C"), "l_orderkey", suffix).alias("code"),
        col("l_linenumber").alias("idx"), "l_partkey", "l_suppkey", "l_extendedprice",
    )
    return documents.pick_lot(rows, ["l_partkey", "l_suppkey", "l_extendedprice"])


@register
def photo_discriminator(spark, sf):
    """Embedding values as pixels of one picture per vector."""
    e = col("embedding")
    pixel = F.explode(F.sequence(F.lit(0), F.floor(F.size(e) / 3).cast("int") - 1)).alias("i")

    def channel(off: int) -> Column:
        value = F.element_at(e, col("i") * 3 + 1 + off).cast("double")
        return F.floor(F.least(F.greatest((value + 0.25) * 512, F.lit(0.0)), F.lit(255.0))).cast("int")

    # A light picture per fifth vector, a narrow one per seventh.
    light = F.when(col("vec_id") % 5 == 0, F.lit(240)).otherwise(F.lit(0))
    pixels = table(spark, sf, "embeddings").select("vec_id", "embedding", pixel).select(
        col("vec_id").cast("string").alias("image_id"),
        F.when(col("vec_id") % 7 == 0, 150).otherwise(220).alias("width"),
        F.lit(220).alias("height"),
        "i",
        *[F.greatest(channel(off), light).alias(name) for off, name in enumerate("rgb")],
    )
    out = documents.photo_test(pixels)
    return out.select("image_id", F.round("sat", 6).alias("sat"), F.round("white", 6).alias("white"), "is_photo")


@register
def harvest_links(spark, sf):
    """listings that have a detail page."""
    rows = proxies.houses(spark, sf)
    link = F.when(col("seq") % 2 == 0, F.concat(F.lit("https://a.test/Auction/Details/"), col("seq"))).otherwise(col("link"))
    return documents.detail_links(rows.withColumn("link", link)).select("seq", "link")


# --- coverage, freshness, snapshots, streams ----------------------------------------------------------------


def _day_pages(spark: SparkSession, sf: str) -> DataFrame:
    day = F.datediff("ts", F.lit("2024-01-01")) + 1
    return table(spark, sf, "events").select(
        col("event_type").alias("source"), day.alias("page_no"), col("user_id").alias("id"), proxies.instant("ts").alias("captured_at")
    )


@register
def capture_coverage(spark, sf):
    """A10: cards and newly seen ids per page."""
    return stats.capture_coverage(_day_pages(spark, sf))


@register
def capture_walk_end(spark, sf):
    """A10: first page that brought nothing new."""
    return stats.walk_end(stats.capture_coverage(_day_pages(spark, sf)))


@register
def freshness(spark, sf):
    """ST3: age of the newest capture per source and overall."""
    out = stats.freshness(_day_pages(spark, sf), AS_OF)
    return out.select("source", F.unix_seconds("newest").alias("newest_s"), "age_hours", "stale")


def _snapshot(spark: SparkSession, sf: str, start: str, end: str) -> DataFrame:
    """Latest order of each customer in a period, as a listing keyed by customer."""
    inside = (col("o_orderdate") >= F.lit(start).cast("timestamp_ntz")) & (col("o_orderdate") < F.lit(end).cast("timestamp_ntz"))
    return (
        table(spark, sf, "orders").where(inside).groupBy(col("o_custkey").alias("key"))
        .agg(F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("price"))
    )


@register
def snapshot_diff(spark, sf):
    """Added, removed and re-priced listings between two captures."""
    old = _snapshot(spark, sf, "1900-01-01", "1997-01-01")
    new = _snapshot(spark, sf, "1995-01-01", "2100-01-01")
    return stats.snapshot_diff(old, new)


@register
def stream_first_seen(spark, sf):
    """ST2: a file stream of captures, each (source, id) let through once."""
    work = Workspace(spark, "first-seen")
    files = table(spark, sf, "events")
    stream = spark.readStream.schema(files.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    captures = stream.select(col("event_type").alias("source"), col("user_id").alias("ref"), proxies.instant("ts").alias("captured_at"))
    seen = ingest.first_seen(captures, ["source", "ref"], "captured_at", "3650 days").select("source", "ref")
    ingest.drain(seen, f"{work.path}/out", f"{work.path}/checkpoint")
    return spark.read.schema(seen.schema).parquet(f"{work.path}/out")
