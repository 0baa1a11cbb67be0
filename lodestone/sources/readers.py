"""Readers and writers for captures, caches and snapshots."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed, schema
from ..functions.text import blank_to_null, grab_all
from ..session import Workspace, shuffles_removed


def snapshot_json(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """A snapshot kept as JSON: one object per line, or one pretty-printed array.

    An array file cannot be split and is read by one task; published snapshots
    have one object per line.
    """
    return spark.read.schema(schema.LISTING).option("multiLine", array).json(path)


def write_snapshot_json(listings: DataFrame, path: str) -> None:
    listings.write.mode("overwrite").json(path)


def enrichment_cache(spark: SparkSession, path: str) -> DataFrame:
    """Keyed cache file ``{code: {field: value}}`` as rows; empty when there is none."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema.CACHE)
    entries = F.from_json("value", T.MapType(schema.STR, schema.CACHE_ENTRY))
    return text.select(F.explode(entries).alias("code", "entry")).select("code", "entry.*")


# Code points of a cache file between closing braces: escapes go first, then whole strings.
_ESCAPE, _STRING = r"\\.", r'"[^"]*("|$)'
_PLACE = ("_file", "_block", "_at")


def _before(pieces: DataFrame, column: str, out: str) -> DataFrame:
    """Adds the sum of ``column`` over all earlier pieces of the file.

    Pieces are summed within their block, a split of the file, and blocks over the file by
    one row each, so no task has to see a whole file.
    """
    here = Window.partitionBy("_file", "_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sums = pieces.groupBy("_file", "_block").agg(F.sum(column).alias("_sum"))
    blocks = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_file", "_block", F.coalesce(F.sum("_sum").over(blocks), F.lit(0)).alias("_earlier"))
    return (
        pieces.withColumn(out, F.coalesce(F.sum(column).over(here), F.lit(0)))
        .join(F.broadcast(sums), ["_file", "_block"])  # a row per split of the files
        .withColumn(out, F.col(out) + F.col("_earlier")).drop("_earlier")
    )


def cache_scan(spark: SparkSession, path: str) -> DataFrame:
    """The entries of keyed cache files ``{code: {field: value}}``, each file read by many tasks.

    The files are split at closing braces, wherever a task's share of bytes ends. Quotes
    counted over the pieces before tell whether a piece begins inside a string, and braces
    outside strings at which depth; so pieces that are one whole entry are parsed where
    they lie, and only the others (a brace in a string, an object in an entry) are joined, in
    order. Of a code that occurs several times the last entry counts. An entry that doesn't
    parse gives no row; no file gives no rows. A file may hold several objects one after
    the other.
    """
    try:
        text = spark.read.option("lineSep", "}").text(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema.CACHE)
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at")]
    work = Workspace(spark, "cache-scan")
    pieces = work.table("pieces", text.select(*place, "value"))

    plain = F.regexp_replace("value", _ESCAPE, "")
    quotes = F.length(plain) - F.length(F.replace(plain, F.lit('"')))

    def opened(text: Column) -> Column:
        return F.length(F.regexp_replace(F.regexp_replace(text, _STRING, ""), r"[^{]", ""))

    # Short rows: what a piece holds if it begins outside a string, and if inside one.
    counts = pieces.select(*_PLACE, quotes.alias("q"), opened(plain).alias("out"), opened(F.concat(F.lit('"'), plain)).alias("in"))
    counts = _before(work.table("counts", counts), "q", "quotes")
    inside, ends_inside = F.col("quotes") % 2 == 1, (F.col("quotes") + F.col("q")) % 2 == 1
    closes = F.when(ends_inside, 0).otherwise(1)
    depths = counts.select(*_PLACE, inside.alias("inside"), closes.alias("closes"), (F.when(inside, F.col("in")).otherwise(F.col("out")) - closes).alias("step"))
    depths = _before(work.table("steps", depths), "step", "depth")
    ends = (F.col("closes") == 1) & (F.col("depth") + F.col("step") == 1)
    marked = work.table("marked", depths.withColumn("ends", ends.cast("int")))
    whole = F.col("ends").cast("boolean") & ~F.col("inside") & (F.col("depth") <= 1)
    parts = _before(marked, "ends", "entry").where(~whole).select(*_PLACE, "entry", "ends")
    parts = work.table("parts", parts)

    # Of the text only the parts of entries that were cut travel.
    alone = pieces.join(parts.select(*_PLACE), list(_PLACE), "left_anti")
    cut = pieces.join(parts, list(_PLACE)).groupBy("_file", "entry").agg(
        F.sort_array(F.collect_list(F.struct("_block", "_at", "value"))).alias("_of"), F.max("ends").alias("ends")
    )
    first = F.col("_of")[0]
    cut = cut.where("ends = 1").select("_file", first["_block"].alias("_block"), first["_at"].alias("_at"), F.array_join(F.col("_of")["value"], "}").alias("value"))
    one = F.concat(F.lit("{"), F.regexp_replace("value", r"^[\s,{}]*", ""), F.lit("}}"))
    parsed = F.from_json(one, T.MapType(schema.STR, schema.CACHE_ENTRY))
    entries = alone.unionByName(cut).select(*_PLACE, F.explode(parsed).alias("code", "entry"))
    last = entries.groupBy("code").agg(F.max_by("entry", F.struct(*_PLACE)).alias("entry"))
    return last.select("code", "entry.*")


def store_captures(pages: DataFrame, path: str, kind: str, source: str) -> None:
    """Add captures of one source to a bronze table laid out by kind and source, so that a job of one source reads its own.

    Pages are mostly markup that comes again, which zstd makes much smaller than the default.
    """
    with shuffles_removed(pages.sparkSession):
        pages.drop("kind", "source").write.mode("append").option("compression", "zstd").parquet(f"{path}/kind={kind}/source={source}")


def stored_captures(spark: SparkSession, path: str, shape: T.StructType) -> DataFrame:
    return spark.read.schema(shape).parquet(path)


def _each(df: DataFrame, array: Column, name: str, drop: tuple[str, ...]) -> DataFrame:
    """One row per element. The outer form keeps Spark from inferring a filter that
    would evaluate the array, a whole parse or split, a second and third time."""
    keep = [c for c in df.columns if c not in drop]
    return df.select(*keep, F.posexplode_outer(array).alias("pos", name)).where("pos IS NOT NULL")


def json_items(pages: DataFrame, payload_type: T.DataType, items: str | None = None) -> DataFrame:
    """One row per item of each captured payload; a page that does not parse gives none."""
    parsed = F.from_json("payload", payload_type)
    return _each(pages, parsed[items] if items else parsed, "item", ("payload",))


def html_cards(pages: DataFrame, marker: str, text: Column | None = None) -> DataFrame:
    """One row per block that follows a marker; what precedes the first marker is dropped."""
    blocks = F.split(F.col("html") if text is None else text, marker)
    return _each(pages, F.slice(blocks, 2, 1 << 30), "card", ("html", "payload"))


def html_of_payload(payload: Column) -> Column:
    """The page inside a JSON envelope, or the payload itself when it is no JSON."""
    boxed = F.coalesce(
        blank_to_null(F.get_json_object(payload, "$.html")), F.get_json_object(payload, "$.listing"), F.lit("")
    )
    return F.when(F.try_parse_json(payload).isNotNull(), boxed).otherwise(payload)


def json_ld(html: Column, *wanted: str) -> Column:
    """First embedded JSON-LD block that carries one of the fields; broken blocks are skipped."""
    blocks = grab_all(html, r'<script type="application/ld\+json">([\s\S]*?)</script>')

    def carries(block: Column) -> Column:
        hits = [
            F.coalesce(~F.get_json_object(block, f"$.{name}").isin("", "0", "false", "null"), F.lit(False))
            for name in wanted
        ]
        test = hits[0]
        for hit in hits[1:]:
            test = test | hit
        return F.try_parse_json(block).isNotNull() & test

    return F.try_element_at(F.filter(blocks, carries), F.lit(1))


def source_registry(spark: SparkSession, kind: str) -> DataFrame:
    """The registered sources of a dataset with their capture order."""
    names = fixed.HOUSE_REGISTRY if kind == "house" else fixed.PLOT_REGISTRY
    return spark.createDataFrame(
        [(n, kind, i) for i, n in enumerate(names)], "registry string, kind string, source_order int"
    )
