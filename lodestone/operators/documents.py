"""Notice documents: table rows from positioned text, lot choice, photo test."""

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import numbers as n
from ..functions.text import grab, has, trim

PAGE = ["code", "doc", "page"]  # a code may have several documents
BLOCK_BANDS = 16  # row bands in a block of heights
TASK_ROWS = 1_000_000  # tokens of a notice that a task should see


def band_join(anchors: DataFrame, tokens: DataFrame, on: list[str], reach: int) -> DataFrame:
    """Pairs (anchor, token) on one page whose heights differ by less than ``reach``.

    Tokens fall into bands of that height; an anchor probes its band and the two
    beside it, so a crowded page is cut by height instead of being crossed whole.
    ``anchors`` carries the height as ``anchor_y``, ``tokens`` as ``y``.
    """
    band = F.floor(F.col("anchor_y") / reach)
    probes = anchors.withColumn("_band", F.explode(F.array(band - 1, band, band + 1)))
    targets = tokens.withColumn("_band", F.floor(F.col("y") / reach))
    return (
        probes.join(targets, [*on, "_band"]).where(F.abs(F.col("y") - F.col("anchor_y")) < reach).drop("_band")
    )


def page_key() -> Column:
    """One text that names a page, so that shuffles and sorts have a single key; null where a part is."""
    return F.concat("page", F.lit(":"), F.length("code"), F.lit(":"), "code", "doc").alias("_page")


def heading_positions(items: DataFrame) -> DataFrame:
    """Column positions of a page: place of the first token that holds a heading; a page without headings has no row."""
    held = {name: [F.contains("s", F.lit(w)) for w in words] for name, words in fixed.NOTICE_HEADINGS.items()}
    picks = []
    for name, tests in held.items():
        hits = [F.min(F.when(test, F.struct("item_no", "x")))["x"] for test in tests]
        picks.append(F.coalesce(*hits, F.lit(None).cast("int")).alias(f"{name}_x"))
    return items.where(reduce(or_, sum(held.values(), []))).select(page_key(), "s", "item_no", "x").groupBy("_page").agg(*picks)


def type_order(token: Column) -> Column:
    """Place of the first property word contained in a token."""
    return F.coalesce(
        *[F.when(F.contains(token, F.lit(w)), F.lit(i)) for i, w in enumerate(fixed.NOTICE_PROPERTY_TYPES)]
    )


def cell_values(items: DataFrame, reach: int) -> DataFrame:
    """The tokens that can be a cell, as what they can be: a fraction, an area, a property word; once for each block they reach into.

    The explode parts the values from the choice of tokens: Spark would move a plain filter below the
    values and search every pattern once more.
    """
    text = items.select(page_key(), "item_no", "x", "y", trim(F.col("s")).alias("s"))
    s, fraction = F.col("s"), F.col("fraction")
    numeric = F.ascii(s).between(ord(","), ord("9"))  # what starts otherwise is no number, and needs no pattern
    text = text.select(
        "_page", "item_no", "x", "y", F.when(numeric & has(s, r"^\d+/\d+$"), s).alias("fraction"),
        F.when(numeric, n.notice_area(s)).alias("area"), type_order(s).alias("word"),
    )
    some = fraction.isNotNull() | F.col("area").isNotNull() | F.col("word").isNotNull()
    height = reach * BLOCK_BANDS
    first, last = (F.floor((F.col("y") + d) / height) for d in (1 - reach, reach - 1))
    cell = [F.struct(block.alias("_block"), "fraction", "area", "word") for block in (first, last)]
    value = F.explode_outer(F.when(some, F.when(first == last, F.array(cell[0])).otherwise(F.array(*cell))))
    text = text.select("_page", "item_no", "x", "y", value.alias("value")).where("value IS NOT NULL")
    return text.select("_page", "item_no", "x", "y", "value.*")


def notice_rows(items: DataFrame) -> DataFrame:
    """Lots of a notice table, read by column position around each row marker.

    A marker takes its page's heading positions along, so only tokens that fill a cell leave the join, and
    a marker without any still gives a row. Markers lie in one block of heights, tokens near the
    edge of a block also in the next, so a crowded page is cut by height.
    """
    s = trim(F.col("s"))
    known = reduce(and_, [F.col(c).isNotNull() for c in (*PAGE, "y")])
    page, spot = [*PAGE, "_page"], ["_page", "_block"]
    markers = items.where((F.col("x") < fixed.NOTICE_MARKER_X) & has(s, r"^\d+\.\*{0,4}$") & known).select(
        *PAGE, page_key(), F.col("item_no").alias("row_no"), F.col("y").alias("anchor_y"), n.int_of(grab(s, r"^(\d+)")).alias("idx"),
    )
    reach = fixed.NOTICE_ROW_BAND
    markers = markers.join(heading_positions(items), "_page", "left").withColumn("_block", F.floor(F.col("anchor_y") / (reach * BLOCK_BANDS)))
    tokens = cell_values(items, reach)

    def near(name: str) -> Column:
        return F.coalesce(F.abs(F.col("x") - F.col(f"{name}_x")) <= fixed.NOTICE_TOLERANCE[name], F.lit(False))

    def leftmost(test: Column, value: str) -> Column:
        return F.min(F.when(test, F.struct("x", "item_no", F.col(value).alias("v"))))

    cells = {
        "registration": (near("registration") & F.col("fraction").isNotNull(), "fraction"),
        "share": (near("share") & F.col("fraction").isNotNull() & n.share_is_valid(F.col("fraction")), "fraction"),
        "_area": (near("area") & F.col("area").isNotNull(), "area"),
    }
    fills = reduce(or_, [test for test, _ in cells.values()]) | F.col("word").isNotNull()
    on = reduce(and_, [markers[c] == tokens[c] for c in spot])
    on = on & (F.abs(F.col("y") - F.col("anchor_y")) < reach) & fills
    parts = task_count(items)
    met = markers.repartition(parts, *spot).join(tokens.repartition(parts, *spot), on, "left").drop(*[tokens[c] for c in spot])
    word = F.col("word")
    found = met.groupBy(*page, "_block", "row_no", "idx").agg(
        *[leftmost(test, value).alias(name) for name, (test, value) in cells.items()],
        F.min(F.when(near("type"), word)).alias("_near"), F.min(word).alias("_any"),
    )
    # A marker's number is its own as a rule, and its row complete; markers that share one are one row.
    rows = found.repartition(parts, "_page").groupBy(*page, "row_no", "idx").agg(
        *[F.min(name)["v"].alias(name) for name in cells], F.coalesce(F.min("_near"), F.min("_any")).alias("_type")
    )
    english = F.array(*[F.lit(v) for v in fixed.NOTICE_PROPERTY_TYPES.values()])
    return rows.select(
        *PAGE, "row_no", "idx", "registration", "share",
        F.when(F.col("_area").between(1, fixed.NOTICE_MAX_AREA), F.col("_area")).alias("areaSqm"),
        F.try_element_at(english, F.col("_type") + 1).alias("propertyType"),
    )


def task_count(items: DataFrame) -> int:
    """Tasks by rows. The adaptive shuffle counts bytes, of which short and similar tokens have so few
    that its tasks hold, and spill, twenty times as much once they are read."""
    return max(items.sparkSession.sparkContext.defaultParallelism, -(-items.count() // TASK_ROWS))


def wanted_lot(code: Column) -> Column:
    """Lot number in a code: `…-002` is the second lot, no suffix the first."""
    return F.coalesce(n.number(grab(code, r"-(\d+)$")), F.lit(1.0))


def pick_lot(rows: DataFrame, order: list[str], idx: str = "idx") -> DataFrame:
    """Per code: the first row with the wanted lot number, else the first row.

    A minimum per code, so it combines before the shuffle.
    """
    rest = [c for c in rows.columns if c != "code"]
    misses = (F.col(idx) != wanted_lot(F.col("code"))).cast("int")
    key = F.struct(F.coalesce(misses, F.lit(1)).alias("_miss"), *[F.col(c).alias(f"_o_{c}") for c in order])
    best = F.min_by(F.struct(*rest), key)
    return rows.groupBy("code").agg(best.alias("_row")).select("code", "_row.*")


def harvest_entries(rows: DataFrame, photos: DataFrame) -> DataFrame:
    """Cache entries of a harvest: the lot's facts and the photo addresses of its code."""
    lot = pick_lot(rows, ["doc", "page", "row_no"]).select(
        "code", F.lit(True).alias("has_row"), F.col("areaSqm").alias("plotSqm"), "share", "propertyType", "registration"
    )
    shots = photos.groupBy("code").agg(F.sort_array(F.collect_list(F.struct("n", "image"))).alias("_shots")).select(
        "code", F.col("_shots")["image"].alias("images")
    )
    return lot.join(shots, "code", "full_outer").select(
        "code", "plotSqm", F.lit(None).cast("double").alias("houseSqm"),
        F.try_element_at("images", F.lit(1)).alias("image"), "images", "share", "propertyType", "registration",
        F.coalesce("has_row", F.lit(False)).alias("has_row"),
    )


def saturation(r: Column, g: Column, b: Column) -> Column:
    """HSV saturation in percent."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    return F.when(top == 0, F.lit(0.0)).otherwise((top - low) / top * 100)


def near_white(r: Column, g: Column, b: Column) -> Column:
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    return (top > fixed.NEAR_WHITE_MAX) & (top - low < fixed.NEAR_WHITE_SPREAD)


def photo_test(pixels: DataFrame) -> DataFrame:
    """Per image: mean saturation and white share of the sampled pixels, and the verdict."""
    step = F.greatest(F.lit(1), F.floor(F.col("width") * F.col("height") / fixed.PHOTO_SAMPLES))
    rgb = (F.col("r"), F.col("g"), F.col("b"))
    sampled = pixels.where(F.pmod(F.col("i"), step) == 0)
    per_image = sampled.groupBy("image_id", "width", "height").agg(
        F.avg(saturation(*rgb)).alias("sat"), F.avg(near_white(*rgb).cast("double")).alias("white")
    )
    sides = F.least("width", "height") >= fixed.PHOTO_MIN_SIDE
    verdict = (F.col("sat") >= fixed.PHOTO_MIN_SATURATION) & (F.col("white") <= fixed.PHOTO_MAX_WHITE) & sides
    return per_image.withColumn("is_photo", verdict)


def detail_links(listings: DataFrame, limit: int | None = None) -> DataFrame:
    """Listings with a detail page to harvest, in capture order; ``limit`` caps the harvest."""
    out = listings.where(has(F.col("link"), "/Auction/Details/")).orderBy("seq")
    return out if limit is None else out.limit(limit)
