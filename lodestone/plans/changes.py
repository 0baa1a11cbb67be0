"""What changed between two snapshots, over all fields, and the gate that publishes only changes.

Each snapshot has a two-level digest tree: a row's fields give two hashes, a row's identity
gives its bucket, and a bucket's digest is the number of its rows and the sums of the
hashes, so neither order nor partitioning matters. A few hundred upper digests tell
whether anything differs and where; only rows of differing buckets are read and compared.
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..operators import dedup
from ..sources.specs import specs
from .refresh import RULES, Refresh, latest, publish
from .stats import identity

# Lower buckets, and how many of them share an upper one. Both are fixed, so digests of all runs compare.
BUCKETS = 4096
FAN = 64
FIELDS = tuple(f.name for f in schema.LISTING.fields if f.name not in ("seq", "kind"))
SUM = "decimal(38,0)"


def row_hash(seed: str, fields: tuple[str, ...] = FIELDS) -> Column:
    """Hash of a listing's fields; a null differs from every value, and from a null elsewhere."""
    return F.xxhash64(F.lit(seed), *[x for f in fields for x in (F.col(f).isNull(), F.col(f))])


def keyed(listings: DataFrame) -> DataFrame:
    """Adds `key`, the listing's identity across snapshots, and its `bucket`."""
    return listings.withColumn("key", identity(listings)).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))


def digests(listings: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """The tree's lower level: `bucket`, `n`, `first`, `second`; `BUCKETS` rows at most."""
    return keyed(listings).groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.sum(row_hash("1", fields).cast(SUM)).alias("first"),
        F.sum(row_hash("2", fields).cast(SUM)).alias("second"),
    )


def upper(lower: DataFrame) -> DataFrame:
    """The tree's upper level, from the lower one alone."""
    sums = [F.sum(c).cast(SUM).alias(c) for c in ("first", "second")]
    mixed = lower.select((F.col("bucket") / FAN).cast("int").alias("top"), "n", *[F.xxhash64(F.lit(c), "bucket", F.col(c)).cast(SUM).alias(c) for c in ("first", "second")])
    return mixed.groupBy("top").agg(F.sum("n").alias("n"), *sums)


def _unlike(old: DataFrame, new: DataFrame, key: str) -> list[int]:
    """Keys of the entries that only one side has, or that differ."""
    sides = [d.select(key, F.struct("n", "first", "second").alias(name)) for d, name in ((old, "_a"), (new, "_b"))]
    both = sides[0].join(sides[1], key, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b")))
    return [r[key] for r in both.select(key).collect()]


def differing(old: DataFrame, new: DataFrame) -> list[int]:
    """Buckets whose digests differ: upper entries first, then the lower ones below those."""
    tops = _unlike(upper(old), upper(new), "top")
    if not tops:
        return []
    own = (F.col("bucket") / FAN).cast("int").isin(*tops)
    return _unlike(old.where(own), new.where(own), "bucket")


def listing_changes(
    old: DataFrame, new: DataFrame, old_digests: DataFrame | None = None, new_digests: DataFrame | None = None,
    fields: tuple[str, ...] = FIELDS,
) -> DataFrame:
    """Added, removed and changed listings: `key`, `change`, and `fields`, the names of those that differ.

    Digests that were stored with a snapshot spare a scan of it. Several listings of one key
    count as one entry, compared as a whole: rows that are equal on both sides cancel,
    and the fields are named only where one row stands against one. A key that is null (no
    link, source and reference) is an empty text.
    """
    buckets = differing(digests(old, fields) if old_digests is None else old_digests, digests(new, fields) if new_digests is None else new_digests)
    own = F.col("bucket").isin(*buckets) if buckets else F.lit(False)
    parts = []
    for side, rows in ((-1, old), (1, new)):
        hashed = keyed(rows).where(own).select("key", row_hash("1", fields).alias("_h"), F.struct(*fields).alias("_row"))
        parts.append(hashed.withColumn("_side", F.lit(side)))
    # Equal rows of both sides cancel; partial sums combine before the shuffle, so many copies of a row travel as one.
    rows = parts[0].unionByName(parts[1]).groupBy("key", "_h").agg(
        F.sum("_side").alias("_more"), F.count_if(F.col("_side") < 0).alias("_o"), F.count_if(F.col("_side") > 0).alias("_n"), F.any_value("_row").alias("_row")
    )
    less, more = F.col("_more") < 0, F.col("_more") > 0

    def only(test: Column) -> Column:
        return F.max(F.when(test, F.struct("_h", "_row")))["_row"]

    sides = rows.groupBy("key").agg(
        F.sum("_o").alias("_o"), F.sum("_n").alias("_n"),
        F.coalesce(F.sum(F.when(less, -F.col("_more"))), F.lit(0)).alias("_less"), F.coalesce(F.sum(F.when(more, F.col("_more"))), F.lit(0)).alias("_plus"),
        only(less).alias("_a"), only(more).alias("_b"),
    ).where("_less > 0 OR _plus > 0")
    change = F.when(F.col("_o") == 0, F.lit("added")).when(F.col("_n") == 0, F.lit("removed")).otherwise(F.lit("changed"))
    unlike = F.array_compact(F.array(*[F.when(~F.col(f"_a.{f}").eqNullSafe(F.col(f"_b.{f}")), F.lit(f)) for f in fields]))
    named = F.when((change == "changed") & (F.col("_less") == 1) & (F.col("_plus") == 1), unlike)
    return sides.select("key", change.alias("change"), named.alias("fields"))


# --- the gate -----------------------------------------------------------------------


@dataclass(frozen=True)
class Published:
    """What the gate did."""

    published: bool
    reason: str  # first, changed, unchanged, refused
    buckets: int  # that differ from the run before
    kept_sources: tuple[str, ...]  # failed sources whose last rows stay


FAILURE_RULES = ("publish", "keep", "refuse")


def _latest(spark: SparkSession, path: str) -> tuple[int, DataFrame] | None:
    try:
        run = spark.read.schema("run bigint").parquet(f"{path}-runs").agg(F.max("run")).first()[0]
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return run, latest(spark, path)


def _stored_digests(spark: SparkSession, path: str, run: int, rows: DataFrame) -> DataFrame:
    try:
        return spark.read.schema(f"bucket int, n bigint, first {SUM}, second {SUM}").parquet(f"{path}-digests/run={run}")
    except AnalysisException as err:  # a run that was published without the gate
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return digests(rows)


def publish_if_changed(outcome: Refresh, kind: str, path: str, run: int, on_failure: str = "keep") -> Published:
    """Publish the outcome of a refresh, unless nothing changed since the newest recorded run.

    ``on_failure`` says what a failed source means: ``publish`` without its listings, ``keep``
    its rows of the newest run (deduplicated again with the others), or ``refuse`` to
    publish. Nothing is published of a run that is refused or unchanged; capture order
    (`seq`) alone is no change. The digests are written before the run is recorded.
    """
    if on_failure not in FAILURE_RULES:
        raise ValueError(f"on_failure is one of {FAILURE_RULES}")
    spark, listings, kept = outcome.listings.sparkSession, outcome.listings, ()
    before = _latest(spark, path)
    if outcome.failed and on_failure == "refuse":
        return Published(False, "refused", 0, ())
    if outcome.failed and on_failure == "keep" and before:
        kept = tuple(sorted({s.source for s in specs(kind) if s.registry in outcome.failed}))
        old = before[1].where(F.col("source").isin(*kept) & (F.col("kind") == kind))
        both = schema.as_listing(listings).unionByName(old)
        listings = dedup.dedupe(both, RULES[kind])
    listings = schema.as_listing(listings).withColumn("kind", F.coalesce("kind", F.lit("house")))
    fresh = digests(listings)
    fresh.coalesce(1).write.mode("overwrite").parquet(f"{path}-digests/run={run}")
    fresh = _stored_digests(spark, path, run, listings)
    buckets = differing(_stored_digests(spark, path, before[0], before[1]), fresh) if before else []
    if before and not buckets:
        return Published(False, "unchanged", 0, kept)
    publish(listings, path, run)
    return Published(True, "changed" if before else "first", len(buckets), kept)
