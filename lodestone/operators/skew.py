"""Equi-join of many rows with a small-per-key side when some keys are hot."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot above this many rows, or above 1/MAX_HOT of all rows if that is more.
HOT_ROWS = 1_000_000
MAX_HOT = 10_000
# A key of just that size is expected this often in the sample that looks for hot keys.
IN_SAMPLE = 50


def hot_threshold(n_rows: int, hot_rows: int = HOT_ROWS) -> int:
    return max(hot_rows, n_rows // MAX_HOT)


@dataclass(frozen=True)
class HotKeys:
    """Hot keys of a table and the number of slices each is cut into."""

    on: tuple[str, ...]
    keys: DataFrame | None  # columns `on` and `slices`; None when no key can be hot

    @staticmethod
    def find(rows: DataFrame, on: tuple[str, ...], n_rows: int, hot_rows: int, *spread_by: str) -> "HotKeys":
        """Look for hot keys in an evenly spread sample of the rows.

        Only the slicing depends on the sample, never a result. Counting every key
        would shuffle as much as the join itself. A key is listed from half the
        threshold on, so the list has at most 2 * MAX_HOT entries: the size bound of
        its broadcast.
        """
        limit = hot_threshold(n_rows, hot_rows)
        if n_rows <= limit:
            return HotKeys(on, None)
        one_in = max(1, limit // IN_SAMPLE)
        sample = rows.where(_all_present(on) & (F.pmod(F.xxhash64(*spread_by, F.lit(1)), F.lit(one_in)) == 0))
        rows_of_key = F.count("*") * one_in
        counted = sample.groupBy(*on).agg(rows_of_key.alias("_n")).where(F.col("_n") > limit // 2)
        return HotKeys(on, counted.select(*on, F.ceil(2 * F.col("_n") / limit).cast("int").alias("slices")))

    def kept(self, workspace, name: str) -> "HotKeys":
        """The same keys, read back from a written table."""
        return self if self.keys is None else HotKeys(self.on, workspace.table(name, self.keys))

    def left_join(self, rows: DataFrame, side: DataFrame, *spread_by: str) -> DataFrame:
        """``rows LEFT JOIN side``; slices of a hot key meet copies of its one side row.

        ``spread_by`` names columns that differ between rows of one key. Rows with a
        null key match nothing; they are spread evenly instead of meeting in the one
        partition of the null key.
        """
        on = list(self.on)
        if self.keys is None:
            return rows.join(side, on, "left")
        mark = F.xxhash64(*spread_by)
        slices = F.broadcast(self.keys)
        slot = F.when(_all_present(self.on), F.pmod(mark, F.coalesce("slices", F.lit(1)))).otherwise(
            F.pmod(mark, F.lit(1 << 16))
        )
        left = rows.join(slices, on, "left").withColumn("_slot", slot.cast("int")).drop("slices")
        copies = (
            side.join(slices, on, "left")
            .withColumn("_slot", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)))
            .drop("slices")
        )
        return left.join(copies, [*on, "_slot"], "left").drop("_slot")

    def left_join_stored(self, rows: DataFrame, side: DataFrame) -> DataFrame:
        """``rows LEFT JOIN side`` for a side stored in buckets of ``on``, which stays where it lies.

        Slices would part a bucket, so the entries of the hot keys (at most 2 * MAX_HOT) are
        broadcast instead, and rows with a null key are not moved at all.
        """
        on = list(self.on)
        known = _all_present(self.on)
        keyed, alone = rows.where(known), rows.where(~known)
        if self.keys is None:
            joined = keyed.join(side, on, "left")
        else:
            hot = F.broadcast(self.keys.select(*on))
            few = F.broadcast(side.join(hot, on, "left_semi"))
            joined = keyed.join(hot, on, "left_anti").join(side, on, "left")
            joined = joined.unionByName(keyed.join(hot, on, "left_semi").join(few, on, "left"))
        return joined.unionByName(alone, allowMissingColumns=True)


def _all_present(on) -> Column:
    test = F.lit(True)
    for c in on:
        test = test & F.col(c).isNotNull()
    return test
