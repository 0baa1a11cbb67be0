"""A snapshot laid out along a space-filling curve, so that filters on several fields skip row groups.

Each field's value becomes its rank among quantiles of a bounded sample; the bits of the ranks
are interleaved (Morton order), and the rows are written by ranges of that key. Rows that are
near in all fields lie in the same file, whose minima and maxima the reader compares with the
filter. Only the layout depends on the sample, never a result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ("price", "plotSqm", "district")
BITS = 4
SAMPLE_ROWS = 20_000


def quantiles(listings: DataFrame, column: str, bits: int = BITS, by: str = "seq", sample: int = SAMPLE_ROWS) -> list:
    """The 2^bits - 1 inner boundaries of a field, from about ``sample`` rows (twice that at most) by a hash of ``by``."""
    n = listings.count()
    share = F.lit(True) if n <= sample else F.pmod(F.xxhash64(by), F.lit(1 << 40)) < int((1 << 40) * sample / n)
    values = sorted(r[0] for r in listings.where(share & F.col(column).isNotNull()).select(column).limit(2 * sample).collect())
    at = [values[len(values) * i >> bits] for i in range(1, 1 << bits)] if values else []
    return sorted(set(at))


def curve_key(ranks: list[Column], bits: int = BITS) -> Column:
    """The ranks' bits, highest first, one of each rank in turn."""
    key = F.lit(0).cast("bigint")
    for b in reversed(range(bits)):
        for rank in ranks:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(rank, b).bitwiseAND(1).cast("bigint"))
    return key


def rank_in(c: Column, bounds: list) -> Column:
    """How many boundaries a value reaches; null reaches none."""
    if not bounds:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= c)), F.lit(0))


def write_clustered(listings: DataFrame, path: str, files: int, columns: tuple[str, ...] = COLUMNS, bits: int = BITS, row_group: int | None = None) -> None:
    """Write ``listings`` in ``files`` ranges of the curve, sorted along it; ``row_group`` is the bytes of a row group."""
    ranks = [F.greatest(rank_in(F.col(c), quantiles(listings, c, bits)), F.lit(0)) for c in columns]
    keyed = listings.withColumn("_curve", curve_key(ranks, bits))
    laid = keyed.repartitionByRange(files, "_curve", "seq").sortWithinPartitions("_curve", "seq").drop("_curve")
    writer = laid.write.mode("overwrite")
    (writer.option("parquet.block.size", row_group) if row_group else writer).parquet(path)
