"""Statistics, facets, reports and comparisons of listing sets."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import link_key


def per_place(listings: DataFrame, *also: str) -> DataFrame:
    """What the statistics need of the listings, one row per source and district: such rows can be added up."""
    has_image = F.coalesce(F.col("image") != "", F.lit(False))
    return listings.groupBy(*also, "source", "district").agg(
        F.count("*").alias("n"),
        F.count_if(has_image).alias("photos"),
        F.sum("price").alias("asked"),
        F.count("price").alias("priced"),
        F.min("seq").alias("first_seq"),
    )


def bar_of(places: DataFrame) -> DataFrame:
    """The stats bar from rows of `per_place`, of one or several parts of the listings."""
    return places.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count_distinct("source").alias("sources"),
        F.coalesce(F.sum("photos"), F.lit(0)).alias("with_photo"),
        F.coalesce(F.floor(F.try_divide(F.sum("asked"), F.sum("priced")) + 0.5), F.lit(0)).cast("bigint").alias("avg_price"),
        F.count_distinct(F.nullif("district", F.lit(""))).alias("districts"),
    )


def stats_bar(listings: DataFrame) -> DataFrame:
    """Total, sources, with photo, average asking price (half up, 0 when none), districts."""
    return bar_of(per_place(listings))


def facet_sources(listings: DataFrame) -> DataFrame:
    """Listings per source, in first-seen order."""
    return (
        listings.groupBy("source")
        .agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))
        .orderBy("first_seq")
    )


def facet_values(listings: DataFrame, column: str) -> DataFrame:
    """Distinct non-empty values of a facet, sorted."""
    values = listings.select(F.col(column).alias("value")).where(F.col("value") != "")
    return values.distinct().orderBy("value")


def result_counts(listings: DataFrame, matching: DataFrame) -> DataFrame:
    """`Showing n of N`, in one row."""
    parts = matching.select(F.lit(1).alias("hit")).unionAll(listings.select(F.lit(0).alias("hit")))
    return parts.agg(F.sum("hit").cast("bigint").alias("shown"), F.count_if(F.col("hit") == 0).alias("total"))


def counts_in_one_pass(listings: DataFrame, predicate: Column) -> DataFrame:
    """Same counts where the filter is one predicate: a single scan."""
    return listings.agg(F.count_if(predicate).alias("shown"), F.count("*").alias("total"))


def dedup_report(decisions: DataFrame) -> DataFrame:
    return decisions.agg(
        F.count("*").alias("scraped"),
        F.count_if(F.col("decision") == "kept").alias("kept"),
        F.count_if(F.col("decision") == "link").alias("same_link"),
        F.count_if(F.col("decision") == "cross").alias("cross_source"),
    )


def source_health(registry: DataFrame, listings: DataFrame, failed: tuple[str, ...] = ()) -> DataFrame:
    """Rows per registered source; a source that raised, or was never captured, is marked."""
    rows = listings.groupBy("source").agg(F.count("*").alias("n"))
    return registry.join(rows, "source", "left").select(
        "source",
        F.coalesce("n", F.lit(0)).alias("n"),
        (~F.col("source").isin(*failed) if failed else F.lit(True)).alias("succeeded"),
    )


def harvest_report(harvest: DataFrame) -> DataFrame:
    """Harvested entries, those with photos and those whose notice had a table row.

    A row counts also when none of its cells could be read (``has_row`` of a harvest);
    entries of a cache, which don't say, count by a filled field.
    """
    fields = ("plotSqm", "share", "propertyType", "registration")
    any_field = F.coalesce(*[F.col(f).cast("string") for f in fields]).isNotNull()
    if "has_row" in harvest.columns:
        any_field = F.col("has_row")
    return harvest.agg(
        F.count("*").alias("harvested"),
        F.count_if(F.coalesce(F.size("images") > 0, F.lit(False))).alias("with_photos"),
        F.count_if(any_field).alias("with_table"),
    )


def capture_coverage(cards: DataFrame) -> DataFrame:
    """Per page: cards and ids seen there for the first time."""
    first = cards.groupBy("source", "id").agg(F.min("page_no").alias("page_no"))
    new = first.groupBy("source", "page_no").agg(F.count("*").alias("new_ids"))
    return (
        cards.groupBy("source", "page_no")
        .agg(F.count("*").alias("cards"))
        .join(new, ["source", "page_no"], "left")
        .select("source", "page_no", "cards", F.coalesce("new_ids", F.lit(0)).alias("new_ids"))
    )


def walk_end(coverage: DataFrame) -> DataFrame:
    """First page per source that brought nothing new: where the walk could have stopped."""
    return coverage.groupBy("source").agg(
        F.max("page_no").alias("last_page"), F.min(F.when(F.col("new_ids") == 0, F.col("page_no"))).alias("first_empty")
    )


def freshness(captures: DataFrame, as_of: str, stale_hours: int = fixed.STALE_AFTER_HOURS) -> DataFrame:
    """Newest capture per source and overall, its age in hours and whether it is stale."""
    now = F.lit(as_of).cast("timestamp")
    newest = F.max("captured_at").alias("newest")
    return (
        captures.rollup("source")
        .agg(newest, F.grouping_id().alias("overall"))
        .select(
            F.when(F.col("overall") == 1, F.lit("(all)")).otherwise(F.col("source")).alias("source"),
            "newest",
            F.floor((F.unix_millis(now) - F.unix_millis("newest")) / 3600000).alias("age_hours"),
            (F.unix_millis(now) - F.unix_millis("newest") > stale_hours * 3600000).alias("stale"),
        )
    )


def identity(listings: DataFrame) -> Column:
    """Key of a listing across snapshots: its link, else source and reference."""
    return F.coalesce(link_key(F.col("link")), F.concat_ws("|", "source", "ref"))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str = "key", value: str = "price") -> DataFrame:
    """Added, removed and re-priced listings: one grouping over both snapshots."""
    sides = old.select(key, value, F.lit(0).alias("_new")).unionAll(new.select(key, value, F.lit(1).alias("_new")))

    def of(side: int) -> Column:
        return F.max(F.when(F.col("_new") == side, F.col(value)))

    both = sides.groupBy(key).agg(
        F.count_if(F.col("_new") == 0).alias("n_old"),
        F.count_if(F.col("_new") == 1).alias("n_new"),
        of(0).alias("old_value"),
        of(1).alias("new_value"),
    )
    change = (
        F.when(F.col("n_old") == 0, F.lit("added"))
        .when(F.col("n_new") == 0, F.lit("removed"))
        .when(~F.col("old_value").eqNullSafe(F.col("new_value")), F.lit("changed"))
    )
    return both.withColumn("change", change).where("change IS NOT NULL").select(key, "change", "old_value", "new_value")


def snapshot_changed(old: DataFrame, new: DataFrame) -> bool:
    """Is there any row in one snapshot and not in the other?"""
    return not (old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty())
