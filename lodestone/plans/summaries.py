"""Statistics from summaries of parts of the listings, that are added up without reading the listings again.

A summary holds sums and counts per source and district, and a bitmap of the listings' numbers
per block of 32,768 numbers. Sums of parts without common listings add up; bitmaps also merge
where parts overlap, as runs of a source do.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .stats import bar_of, per_place


def write_summary(listings: DataFrame, path: str, part: str) -> None:
    """Add, or write again, the summary of one part; the other parts stay as they are."""
    per_place(listings).write.mode("overwrite").parquet(f"{path}/places/part={part}")
    numbers = listings.select(F.bitmap_bucket_number("seq").alias("block"), F.bitmap_bit_position("seq").alias("at"))
    bits = numbers.groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits"))
    bits.write.mode("overwrite").parquet(f"{path}/numbers/part={part}")


def _parts(spark: SparkSession, path: str, table: str, parts: tuple[str, ...] | None) -> DataFrame:
    rows = spark.read.parquet(f"{path}/{table}").withColumn("part", F.col("part").cast("string"))
    return rows if parts is None else rows.where(F.col("part").isin(*parts))


def stats_bar(spark: SparkSession, path: str, parts: tuple[str, ...] | None = None) -> DataFrame:
    """The stats bar of the named parts (all, if none are), which share no listing."""
    return bar_of(_parts(spark, path, "places", parts))


def facet_sources(spark: SparkSession, path: str, parts: tuple[str, ...] | None = None) -> DataFrame:
    """Listings per source, with the number first seen and the source's place in that order."""
    return _parts(spark, path, "places", parts).groupBy("source").agg(F.sum("n").alias("n"), F.min("first_seq").alias("first_seq")).orderBy("first_seq")


def distinct_listings(spark: SparkSession, path: str, parts: tuple[str, ...] | None = None) -> DataFrame:
    """How many listings the parts hold together, common ones counted once."""
    merged = _parts(spark, path, "numbers", parts).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("listings"))
