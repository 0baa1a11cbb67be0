"""Threshold-scaled document fingerprints, in DataFrame functions only.

A sketch holds every 63-bit hash of a five-word shingle that lies below a fixed fraction
of the hash range (``FRACTION``). Sketches of that kind merge by union, and compare for
documents of very unequal length, as a long document simply keeps more hashes. A text
with fewer than ``FLOOR`` hashes there keeps its ``FLOOR`` smallest ones instead, all
of them if it has no more; short texts then compare exactly. Two sketches compare on
the range that both cover.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
FRACTION = 16
FLOOR = 16
BOUND = (1 << 63) // FRACTION
_ALL = (1 << 63) - 1
# Rows with one id and one text that are more than this, and more than a bucket should hold, are spread;
# of so many, as many as ``STAY`` are expected to stay where they are, and one has to.
REPEATED_ROWS, STAY = 10_000, 100


def words(text: Column) -> Column:
    """Lower-case words between blanks; none for a null, empty or blank text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def hashes(of: str) -> Column:
    """63-bit hashes of the shingles of the array of words in column ``of``; fewer words than a shingle are one."""
    w, n = F.col(of), F.size(of)
    each = F.transform(F.slice(w, 1, F.greatest(n - (SHINGLE - 1), F.lit(1))), lambda x, i: F.shiftrightunsigned(F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]), 1))
    return F.when(n > 0, each).otherwise(F.array().cast("array<bigint>"))


def with_sketch(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the sketch of a text column: its hashes, ascending and distinct."""
    out = rows.withColumn("_words", words(F.col(text))).withColumn("_hashes", hashes("_words")).drop("_words")
    out = out.withColumn("_below", F.array_sort(F.array_distinct(F.filter("_hashes", lambda h: h < BOUND))))
    short = F.slice(F.array_sort(F.array_distinct("_hashes")), 1, FLOOR)
    return out.withColumn(name, F.when(F.size("_below") >= FLOOR, F.col("_below")).otherwise(short)).drop("_hashes", "_below")


def _covers(sketch: Column) -> Column:
    """The largest hash up to which the sketch holds every hash of its text."""
    return F.when(F.size(sketch) < FLOOR, F.lit(_ALL)).otherwise(F.greatest(F.element_at(sketch, -1), F.lit(BOUND - 1)))


def _shared(a: Column, b: Column) -> tuple[Column, Column, Column]:
    most = F.least(_covers(a), _covers(b))
    x, y = F.filter(a, lambda h: h <= most), F.filter(b, lambda h: h <= most)
    return F.size(F.array_intersect(x, y)), F.size(x), F.size(y)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1; two texts without words are alike."""
    both, x, y = _shared(a, b)
    every = x + y - both
    return F.when(every == 0, 1.0).otherwise(both / F.greatest(every, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; a text without words is contained in any."""
    both, x, _ = _shared(a, b)
    return F.when(x == 0, F.when(F.size(a) == 0, 1.0)).otherwise(both / F.greatest(x, F.lit(1)))


def merged(a: Column, b: Column) -> Column:
    """The sketch of the two texts' shingles together."""
    most = F.least(_covers(a), _covers(b))
    return F.array_sort(F.filter(F.array_union(a, b), lambda h: h <= most))


def as_text(sketch: Column) -> Column:
    """16 lower-case hex digits for each hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _numbers(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def in_buckets(rows: DataFrame, doc_id: str = "doc_id", tie: str = "_tie") -> DataFrame:
    """``rows`` with ``_bucket`` and ``_spread``: ranges of (id, tie), ascending, about as many as shuffle partitions.

    The limits are approximate quantiles of the ids, one number per bucket. An id that fills
    several buckets is cut into as many even ranges of the tie, a hash; so are rows without
    id, which come first. Rows that are equal in both, in such an id, cannot be parted by order and need
    none: most of them get a ``_spread`` from 1 on, the others and all other rows 0. The limits sit in
    groups, so that a row looks at about twice the square root of their number.
    """
    count = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("_id", F.col(doc_id).cast("long"))
    parts = [i / count for i in range(1, count)] or [0.5]
    found, total, known = rows.agg(F.percentile_approx("_id", parts, 10 * count), F.count("*"), F.count("_id")).first()
    shares = Counter((1, limit) for limit in found or [0])  # (0 for rows without id, id): buckets it fills
    shares[0, 0] = max(1, count * (total - known) // max(1, total))
    step = {at: (1 << 64) // n for at, n in shares.items()}
    limits = sorted((*at, k * step[at] - (1 << 63)) for at, n in shares.items() for k in range(n))
    size = max(1, round(len(limits) ** 0.5))

    def structs(values: list[tuple[int, int, int]]) -> Column:
        return F.arrays_zip(*[_numbers([v[i] for v in values]).alias(name) for i, name in enumerate(("known", "id", "tie"))])

    at = F.struct(F.col("_id").isNotNull().cast("bigint").alias("known"), F.coalesce("_id", F.lit(0).cast("bigint")).alias("id"), F.col(tie).alias("tie"))
    rows = rows.withColumn("_at", at)
    group = F.size(F.filter(structs(limits[::size]), lambda b: b <= F.col("_at")))
    inside = F.size(F.filter(F.slice(structs(limits), (F.col("_group") - 1) * size + 1, F.lit(size)), lambda b: b <= F.col("_at")))
    out = rows.withColumn("_group", group).withColumn("_bucket", (F.col("_group") - 1) * size + inside)

    # Rows in crowded ids that are equal in id and tie: at most as many pairs as buckets.
    crowded = [i for (known, i), n in shares.items() if known and n > 1]
    often = max(REPEATED_ROWS, total // count)
    spread = F.lit(0)
    if crowded or shares[0, 0] > 1:
        test = F.array_contains(_numbers(crowded), F.col("_id")) if crowded else F.lit(False)
        repeated = rows.where(test | F.col("_id").isNull()).groupBy("_id", tie).count().where(F.col("count") > often).collect()
        if repeated:
            pairs = structs([(int(r["_id"] is not None), r["_id"] or 0, r[tie]) for r in repeated])
            out = out.withColumn("_chance", F.rand(7))
            away = F.array_contains(pairs, F.col("_at")) & (F.col("_chance") >= max(1 / count, STAY / often))
            spread = F.when(away, 1 + F.floor(F.col("_chance") * count)).otherwise(0)
    return out.withColumn("_spread", spread.cast("int")).drop("_group", "_id", "_at", "_chance")


def edited(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each document with an edited text, and the fingerprints of both.

    Returns doc_id, n_chars, text, edited (the last quarter replaced by the beginning of
    the next document), sketch, edited_sketch, next_sketch. Documents follow each other
    by doc_id, nulls first, then by a hash of their texts, so rows that repeat a doc_id
    follow one another; after the last comes the first. A null text counts as empty. A
    single document is its own next one. No rows give none. Other columns are not read.
    """
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("_tie", F.xxhash64("text"))
    rows = in_buckets(rows)
    narrow = rows.select("_bucket", "doc_id", "_tie")
    # One row per bucket: its first document, whose text the last document of the bucket before needs.
    least = F.min(F.struct(F.col("doc_id").isNotNull().alias("some"), F.col("doc_id").alias("id"), F.col("_tie").alias("tie")))
    firsts = narrow.groupBy("_bucket").agg(least.alias("at"))
    order = Window.orderBy("_bucket")
    firsts = firsts.select("_bucket", "at", F.coalesce(F.lag("_bucket").over(order), F.max("_bucket").over(Window.partitionBy())).alias("_after"))
    heads = rows.join(F.broadcast(firsts), (rows["_bucket"] == firsts["_bucket"]) & rows["doc_id"].eqNullSafe(firsts["at.id"]) & (rows["_tie"] == firsts["at.tie"]))
    heads = with_sketch(heads.groupBy("_after").agg(F.min("text").alias("_head")), "_head", "_head_sketch")
    own = with_sketch(rows, "text", "sketch")
    follow = Window.partitionBy("_bucket", "_spread").orderBy(F.col("doc_id").asc_nulls_first(), "_tie")
    own = own.withColumns({"_next": F.lead("text").over(follow), "_next_sketch": F.lead("sketch").over(follow)}).drop("_tie")
    own = own.join(heads, own["_bucket"] == heads["_after"], "left")

    def after(lead: str, head: str, self: str) -> Column:
        return F.when(F.col("_spread") > 0, F.col(self)).otherwise(F.coalesce(lead, head))

    own = own.select("doc_id", "text", "sketch", after("_next", "_head", "text").alias("_next"), after("_next_sketch", "_head_sketch", "sketch").alias("next_sketch"))
    own = own.withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    own = own.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("_next", F.lit(1), cut))).drop("_next")
    return with_sketch(own, "edited", "edited_sketch")
