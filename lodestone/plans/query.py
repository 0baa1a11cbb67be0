"""Listing queries: optional null-aware filters, one sort order, the card view."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.text import contains_text
from ..session import Workspace

DEFAULT_SORT = {"house": "price_asc", "plot": "plot_desc"}


@dataclass(frozen=True)
class ListingQuery:
    """All parameters are optional and combine with AND; zero is an active bound.

    ``sources=None`` selects every source, an empty set selects none. Unpriced
    listings pass the price bounds; every other bound drops listings without the
    value.
    """

    sources: frozenset[str] | None = None
    district: str = ""
    plot_type: str = ""
    min_price: float | None = None
    max_price: float | None = None
    min_sqm: float | None = None
    min_plot: float | None = None
    max_plot: float | None = None
    min_year: int | None = None
    min_beds: int | None = None
    q: str = ""
    sort: str | None = None

    def predicates(self) -> list[Column]:
        col = F.col
        out: list[Column] = []
        if self.sources is not None:
            out.append(col("source").isin(*sorted(self.sources)) if self.sources else F.lit(False))
        if self.district:
            out.append(col("district") == self.district)
        if self.plot_type:
            out.append(col("plotType") == self.plot_type)
        if self.min_price is not None:
            out.append(col("price").isNull() | (col("price") >= self.min_price))
        if self.max_price is not None:
            out.append(col("price").isNull() | (col("price") <= self.max_price))
        if self.min_sqm is not None:
            out.append(col("houseSqm") >= self.min_sqm)
        if self.min_plot is not None:
            out.append(col("plotSqm") >= self.min_plot)
        if self.max_plot is not None:
            out.append(col("plotSqm") <= self.max_plot)
        if self.min_year is not None:
            out.append(col("buildYear") >= self.min_year)
        if self.min_beds is not None:
            out.append(col("beds") >= self.min_beds)
        if self.q:
            out.append(reduce(Column.__or__, [contains_text(col(c), self.q) for c in ("title", "location", "ref")]))
        return out

    def matches(self) -> Column:
        """All predicates as one; null counts as no."""
        return reduce(Column.__and__, self.predicates(), F.lit(True))

    def filter(self, listings: DataFrame) -> DataFrame:
        return reduce(DataFrame.where, self.predicates(), listings)

    def run(self, listings: DataFrame, kind: str = "house", as_of_ms: int = 0, limit: int | None = None) -> DataFrame:
        """Filtered listings in order; ``limit`` gives the top of the list."""
        out = self.filter(listings).orderBy(*sort_keys(self.sort or DEFAULT_SORT[kind], as_of_ms))
        return out if limit is None else out.limit(limit)


SORTS = ("price_asc", "price_desc", "sqm_desc", "plot_desc", "plot_asc", "ppsqm_asc", "ppsqm_desc", "recent")


def sort_keys(sort: str, as_of_ms: int = 0) -> list[Column]:
    """Sort columns of an order; rows without the value come last, ties keep capture order."""
    ratio = labels.price_per_sqm(F.col("price"), F.col("plotSqm"))
    age = labels.effective_age(F.col("postedTs"), F.col("posted"), as_of_ms)
    first = {
        "price_asc": F.col("price").asc_nulls_last(),
        "price_desc": F.col("price").desc_nulls_last(),
        "sqm_desc": F.col("houseSqm").desc_nulls_last(),
        "plot_desc": F.col("plotSqm").desc_nulls_last(),
        "plot_asc": F.col("plotSqm").asc_nulls_last(),
        "ppsqm_asc": ratio.asc_nulls_last(),
        "ppsqm_desc": ratio.desc_nulls_last(),
        "recent": age.asc(),
    }[sort]
    return [first, F.col("seq").asc()]


def positions(ordered: DataFrame) -> DataFrame:
    """Adds the place (from 1) of each row of an ordered listing, without one global window.

    Rows are numbered inside their range partition; the offsets come from one count
    per partition, so that list is as long as the number of partitions.
    """
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    workspace = Workspace(ordered.sparkSession, "positions")
    numbered = workspace.table("rows", ordered.withColumns({"_part": F.spark_partition_id(), "_at": at}))
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return numbered.join(F.broadcast(offsets), "_part").select(
        *ordered.columns, (F.col("_before") + F.col("_at") + 1).alias("position")
    )


def reset() -> ListingQuery:
    """The query with every parameter at its default."""
    return ListingQuery()


def card_view(listings: DataFrame, kind: str = "house") -> DataFrame:
    """What a listing card shows."""
    col = F.col
    ratio = labels.price_per_sqm(col("price"), col("plotSqm"))

    def chip(shown: Column, *parts: Column | str) -> Column:
        text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
        return F.when(shown, text)

    def filled(name: str) -> Column:
        return F.coalesce(col(name) != "", F.lit(False))

    auction = chip(filled("auctionDate"), "Auction ", col("auctionDate"))
    if kind == "plot":
        chips = [
            chip(labels.given(col("plotSqm")), labels.grouped(col("plotSqm")), " m² plot"),
            labels.per_sqm_label(ratio),
            chip(filled("plotType"), col("plotType")),
            chip(filled("zone"), "Zone ", col("zone")),
            auction,
        ]
    else:
        chips = [
            chip(labels.given(col("beds")), col("beds").cast("string"), " bed"),
            chip(labels.given(col("baths")), col("baths").cast("string"), " bath"),
            chip(labels.given(col("houseSqm")), labels.plain(col("houseSqm")), " m² house"),
            chip(labels.given(col("plotSqm")), labels.plain(col("plotSqm")), " m² plot"),
            F.concat(labels.per_sqm_label(ratio), F.lit(" plot")),
            chip(labels.given(col("buildYear")), "Built ", col("buildYear").cast("string")),
            chip(filled("propertyType"), col("propertyType")),
            chip(filled("share") & (col("share") != "1/1"), "Share ", col("share")),
            auction,
        ]
    no_photo = F.when(col("source") == "eAuction Cyprus", F.lit("No photo published (auction listing)")).otherwise(
        "No photo available"
    )
    ref = F.when(filled("ref"), F.concat(F.lit(" · Ref "), col("ref"))).otherwise("")
    posted = F.when(filled("posted"), F.concat(F.lit("Posted: "), col("posted"))).otherwise("Posted: not shown by source")
    return listings.select(
        "seq",
        labels.price_label(col("price"), col("priceDisplay")).alias("price_label"),
        "title",
        F.concat(F.coalesce("location", F.lit("")), ref).alias("location_label"),
        F.array_compact(F.array(*chips)).alias("chips"),
        posted.alias("posted_label"),
        F.when(filled("image"), col("image")).alias("image"),
        F.when(~filled("image"), no_photo).alias("placeholder"),
        "source",
        F.concat(F.lit("source-"), labels.short_name(col("source"), kind)).alias("source_class"),
        "link",
    )
