"""How five document filters interact: what each removes, and in which order of use.

A filter fails a document by itself, so an order of filters is known from subsets alone:
what is left after the first k filters is what no filter of that set fails. Each document
becomes one word of 32 bits, bit S telling whether it survives the subset S. Per part and
label, positional popcounts over these words (a carry-save adder: three words of one
weight become a sum word of that weight and a carry word of twice the weight) give the
survivors of all 32 subsets at once, and those give every step of all 120 orders.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import Workspace

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # percent of the words
MOST_UPPER = 5  # percent of the code points
MARKS = re.compile(rb"[#$%&*|]")
REPEAT = 1 << FILTERS.index("E")
# The word of a document by the set of filters it fails: bit S is set if it fails none of S.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & fails) for fails in range(SUBSETS)], dtype=np.uint32)
# Parts that a task counts at once before it hands on what it has.
HELD_PARTS = 4_096


def fails(text: bytes) -> int:
    """The filters A to D that a whole text (its UTF-8 bytes) fails, as bits 0 to 3."""
    words = text.split()  # of bytes: at x20 and x09-x0D
    points = np.frombuffer(text, np.uint8)
    n_points = int(np.count_nonzero((points & 0xC0) != 0x80))
    n_upper = int(np.count_nonzero((points >= 65) & (points <= 90)))
    few = len(words) < LEAST_WORDS
    alike = 100 * len(set(words)) < LEAST_DISTINCT * len(words)
    return few | alike << 1 | (100 * n_upper > MOST_UPPER * n_points) << 2 | bool(MARKS.search(text)) << 3


def tested(docs: DataFrame, text: str = "text", part: str = "source") -> DataFrame:
    """``doc_id``, ``part``, the bits of the failed filters A to D and a digest of each whole text."""
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("_text")]
            found = pa.array([fails(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), found, digests], ["doc_id", "part", "fails", "digest"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, part string, fails int, digest binary")


def survivors(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set, by carry-save addition."""
    total, weight, carries = np.zeros(32, np.int64), 1, words
    while len(carries):
        level, above = carries, []
        while len(level) > 2:
            third = len(level) // 3
            a, b, c = level[:third], level[third : 2 * third], level[2 * third : 3 * third]
            either = a ^ b
            above.append((a & b) | (either & c))
            level = np.concatenate((either ^ c, level[3 * third :]))
        for word in level:
            total += weight * np.unpackbits(np.array([word], "<u4").view(np.uint8), bitorder="little").astype(np.int64)
        carries = np.concatenate(above) if above else words[:0]
        weight *= 2
    return total


def counted(rows: DataFrame) -> DataFrame:
    """Survivors of each subset: ``part``, ``subset``, and the counts ``n``, ``good``, ``toxic`` of what the tasks saw.

    ``rows`` holds part, fails (bits A to E), good and toxic.
    """

    def held(parts: dict[str, np.ndarray]) -> pa.RecordBatch:
        names = np.repeat(np.array(list(parts), dtype=object), SUBSETS)
        table = np.concatenate([p.T for p in parts.values()])
        subsets = np.tile(np.arange(SUBSETS, dtype=np.int32), len(parts))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(subsets), *[pa.array(np.ascontiguousarray(table[:, i])) for i in range(3)]], ["part", "subset", "n", "good", "toxic"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column("part").dictionary_encode()
            words = WORDS[batch.column("fails").to_numpy()]
            labels = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("good", "toxic")]
            of = coded.indices.to_numpy()
            order = np.argsort(of, kind="stable")
            ends = np.append(np.flatnonzero(np.diff(of[order])) + 1, len(order))
            for begin, end in zip(np.append(0, ends[:-1]), ends, strict=True):
                own = order[begin:end]
                if not len(own):
                    continue
                name = coded.dictionary[int(of[own[0]])].as_py()
                counts = [survivors(words[own]), *[survivors(words[own[label[own]]]) for label in labels]]
                parts[name] = parts.get(name, 0) + np.stack(counts)
            if len(parts) > HELD_PARTS:
                yield held(parts)
                parts = {}
        if parts:
            yield held(parts)

    return rows.mapInArrow(run, "part string, subset int, n long, good long, toxic long")


def steps(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> Iterator[tuple]:
    """The row of every order and step, from the survivors of each subset."""
    orders, shares = [], dict.fromkeys(FILTERS, 0)
    for order in itertools.permutations(FILTERS):
        before = 0
        for k, f in enumerate(order):
            after = before | 1 << FILTERS.index(f)
            orders.append(("".join(order), k + 1, f, before, after))
            shares[f] += int(n[before] - n[after])
            before = after
    every = SUBSETS - 1
    for order, k, f, before, after in orders:
        bit = after ^ before
        removed = int(n[before] - n[after])
        yield order, k, int(n[after]), removed, int(n[0] - n[bit]) - removed, int(n[every ^ bit] - n[every]), int(good[before] - good[after]), int(toxic[before] - toxic[after]), shares[f]


COLUMNS = {"part": "string", "filter_order": "string", "step": "int"} | dict.fromkeys(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "long")


def interactions(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "source") -> DataFrame:
    """A row per part, order of the five filters and step, with the counts of ``COLUMNS``.

    Filter E fails a document whose text a document with a smaller doc_id has anywhere in
    the table. Null texts are empty texts, a null part is the empty string. Rows that share
    a doc_id don't fail E for each other, and a row without doc_id is neither smaller nor
    larger than any: it never fails E, nor makes another fail. Labels of one doc_id count as
    soon as one row has them; labels that are null, or of a null doc_id, count as 0. No
    documents give no rows. Other columns are not read.
    """
    ws = Workspace(docs.sparkSession, "audit")
    rows = ws.table("tested", tested(docs, text, part))
    # Copies of a text, and rows of one id, meet as partial counts first, so no group of either travels row by row.
    lowest = rows.groupBy("digest").agg(F.min("doc_id").alias("lowest"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    marks = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id")
    marks = marks.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # Rows without an id match no label; the text spreads them.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest", "part")).otherwise(F.lit(0))
    labelled = rows.withColumn("_spread", spread).join(marks.withColumn("_spread", F.lit(0).cast("long")), ["doc_id", "_spread"], "left")
    repeats = labelled.join(lowest, "digest", "left")
    fails_all = F.col("fails").bitwiseOR(F.when(F.col("doc_id") > F.col("lowest"), F.lit(REPEAT)).otherwise(F.lit(0)))
    words = repeats.select("part", fails_all.alias("fails"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    sums = counted(words).groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    # 32 entries a part.
    parts = sums.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("subset", "n", "good", "toxic"))).alias("counts"))
    parts = parts.select("part", *[F.col(f"counts.{c}").alias(c) for c in ("n", "good", "toxic")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = list(zip(*steps(*[np.array(row[c]) for c in ("n", "good", "toxic")]), strict=True))
                kinds = [pa.string(), pa.int32(), *[pa.int64()] * 7]
                arrays = [pa.array([row["part"]] * len(found[0]), pa.string()), *[pa.array(c, k) for c, k in zip(found, kinds, strict=True)]]
                yield pa.RecordBatch.from_arrays(arrays, list(COLUMNS))

    return parts.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in COLUMNS.items()))
