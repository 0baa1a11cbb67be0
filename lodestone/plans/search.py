"""Free-text search through an index of trigrams, with the results of the scan.

    texts/      chunk=              the searched fields of each listing, by range of `seq`
    postings/   bucket=             for each trigram and chunk the sorted list of its listings

A search reads the lists of the needle's trigrams, from their buckets, intersects them within
each chunk, reads the chunks that have a candidate left and tests the candidates exactly.
A needle shorter than a trigram is searched by a scan of the texts.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import contains_text

FIELDS = ("title", "location", "ref")
GRAM = 3
CHUNK = 1 << 16  # numbers in a chunk, so the most entries of a list
BUCKETS = 64
# Chunks named in a filter; with more candidates' chunks than this the texts are joined unpruned.
NAMED_CHUNKS = 1_000


def _grams(c: Column) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    starts = F.when(F.length(low) >= GRAM, F.sequence(F.lit(1), F.length(low) - GRAM + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(low, i, F.lit(GRAM)))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def write_index(listings: DataFrame, path: str, chunk: int = CHUNK) -> None:
    """Write the index of ``listings``, whose ``seq`` is unique."""
    rows = listings.select(F.floor(F.col("seq") / chunk).cast("bigint").alias("chunk"), "seq", *FIELDS)
    rows.repartitionByRange("chunk").write.partitionBy("chunk").mode("overwrite").parquet(f"{path}/texts")
    grams = rows.select("chunk", "seq", F.explode(F.array_distinct(F.flatten(F.array(*[_grams(F.col(f)) for f in FIELDS])))).alias("gram"))
    # A trigram that every listing has is cut by chunk, so no list outgrows one.
    lists = grams.groupBy("gram", "chunk").agg(F.sort_array(F.collect_list("seq")).alias("seqs")).withColumn("bucket", _bucket(F.col("gram")))
    lists.repartition("bucket", "chunk").sortWithinPartitions("bucket", "gram", "chunk").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/postings")


def candidates(spark: SparkSession, path: str, needle: str) -> DataFrame:
    """`chunk` and `seq` of the listings that have every trigram of the needle."""
    low = needle.lower()
    grams = sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})
    named = spark.range(1).select(F.explode(F.array(*[F.lit(g) for g in grams])).alias("gram"))
    buckets = [r[0] for r in named.select(_bucket(F.col("gram"))).distinct().collect()]
    lists = spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(*buckets) & F.col("gram").isin(*grams))
    met = lists.groupBy("chunk").agg(F.collect_list("seqs").alias("lists")).where(F.size("lists") == len(grams))
    common = F.aggregate("lists", F.col("lists")[0], F.array_intersect)
    return met.select("chunk", F.explode(common).alias("seq"))


def search(spark: SparkSession, path: str, needle: str) -> DataFrame:
    """`seq` and the searched fields of the listings that contain the needle, by the test of `contains_text`."""
    texts = spark.read.parquet(f"{path}/texts")
    test = reduce(Column.__or__, [contains_text(F.col(f), needle) for f in FIELDS])
    if len(needle.lower()) >= GRAM:
        found = candidates(spark, path, needle)
        chunks = [r[0] for r in found.select("chunk").distinct().limit(NAMED_CHUNKS + 1).collect()]
        if len(chunks) <= NAMED_CHUNKS:
            texts = texts.where(F.col("chunk").isin(*chunks) if chunks else F.lit(False))
        texts = texts.join(found, ["chunk", "seq"], "left_semi")
    return texts.where(test).select("seq", *FIELDS)
