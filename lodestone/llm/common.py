"""What several operators share: row keys, sequences in order, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.session import Workspace

# A table of at most this many rows may be broadcast; beyond it the join is shuffled.
SMALL_ROWS = 100_000


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str = "text") -> Column:
    """With doc_id, names a row: rows equal in both are the same document twice."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def share_of(rows: int, wanted: int, *by: str) -> Column:
    """Picks rows by a hash of ``by``, so that of ``rows`` about twice the ``wanted`` number is left to take that many from.

    All of them, if there are no more than that. What tasks send for a sample is bounded
    by it in this way, however many tasks there are.
    """
    if rows <= 2 * wanted:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit("sample"), *by), F.lit(1 << 40)) < int((1 << 40) * 2 * wanted / rows)


def packed(docs: DataFrame, **named: Column) -> DataFrame:
    """The whole row as one struct ``_row`` beside the named columns.

    Other columns of the input, whatever their names, can clash with nothing then.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[c.alias(k) for k, c in named.items()])


def ranked(ws: Workspace, name: str, keys: DataFrame, by: str) -> DataFrame:
    """``keys`` with ``_rank``, its place from 0 in ascending order of ``by`` (nulls last), without one task for all.

    ``keys`` holds each value once. It is cut into ranges and written; a row's place is
    its place in its range plus the sizes of the ranges before.
    """
    ranges = keys.repartitionByRange(F.col(by).asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    ranges = ws.table(name, ranges)
    sizes = ranges.groupBy("_part").count()
    before = sizes.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(by).asc_nulls_last())) - 1
    return ranges.withColumn("_place", place).join(before, "_part").withColumn("_rank", F.col("_before") + F.col("_place")).drop("_part", "_before", "_place")


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """The smallest id that each id reaches over ``edges`` (a, b), as columns id, component.

    Ids that are the smallest of their component, or in no edge, are left out. Large
    and small stars take turns: each id hands its larger neighbours, then itself and
    its smaller ones, to the smallest. All steps are grouped minima and equi-joins on
    written tables; the driver sees a count and a checksum per round.
    """
    k, seen = 0, None
    stars = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        stars = ws.table(f"stars-{k}", stars)
        now = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or now[0] == 0:
            return stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
        seen, k = now, k + 1
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        stars = small.distinct()
