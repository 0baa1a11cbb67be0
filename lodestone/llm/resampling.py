"""Importance resampling towards the texts of a target, by hashed word runs.

Texts are lowered in ASCII and cut into words by an untrained Split of the tokenizers
library, which returns each word with its offsets; windows over consecutive pairs of offsets
are the features, the runs of 1 to ``runs`` words. A feature's bucket is a CRC of it. Two
histograms over the buckets, of the documents and of the target, give each bucket a gain:
how much more of it the target has. A document's weight is the sum of its gains; with Gumbel
noise fixed by its id, the highest scores are a draw without replacement by those weights.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from lodestone.llm import common
from lodestone.session import Workspace

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Characters that are cut into words at once, if the text can be cut between words.
PIECE = 1 << 18
_BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
# Word checksums that a worker remembers.
REMEMBERED = 1 << 18


@dataclass(frozen=True)
class Rule:
    """What counts as a feature, and what is drawn."""

    runs: int = 1  # longest run of words
    buckets: int = 10_000
    seed: int = 2024
    least_words: int = 20  # shorter documents are not drawn
    percent: int = 10  # of the others


@lru_cache(maxsize=1)
def _splitter():
    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


@lru_cache(maxsize=1)
def _remembered() -> dict[str, int]:
    return {}


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > PIECE and (place := _BETWEEN.search(text, at + PIECE)):
            end = place.start()
        yield text[at:end]
        at = end


def _checksum(word: str) -> int:
    known = _remembered()
    found = known.get(word)
    if found is None:
        if len(known) >= REMEMBERED:
            known.clear()
        found = known[word] = zlib.crc32(word.encode())
    return found


def histogram(text: str | None, rule: Rule) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, and the buckets of a whole text's features, ascending, with their counts."""
    n_words, tail, found = 0, [], []
    for piece in _pieces((text or "").encode().lower().decode()):  # lower() of bytes changes A-Z only
        words = _splitter().pre_tokenize_str(piece)
        n_words += len(words)
        if rule.runs == 1:
            sums = [_checksum(word) for word, _ in words]
        else:
            # Windows over pairs of offsets: those that end in this piece, though they may begin in the one before.
            spans = [*tail, *[piece[a:b].encode() for _, (a, b) in words]]
            sums = []
            for i in range(len(spans)):
                h = 0
                for j in range(i, min(i + rule.runs, len(spans))):
                    h = zlib.crc32(spans[j], zlib.crc32(b" ", h) if j > i else 0)
                    if j >= len(tail):
                        sums.append(h)
            tail = spans[max(0, len(spans) - rule.runs + 1) :]
        found.append(np.unique(np.array(sums, dtype=np.uint32) % np.uint32(rule.buckets), return_counts=True))
    if not found:
        return 0, np.empty(0, np.int32), np.empty(0, np.int64)
    if len(found) == 1:
        buckets, counts = found[0]
    else:
        buckets, at = np.unique(np.concatenate([b for b, _ in found]), return_inverse=True)
        counts = np.zeros(len(buckets), np.int64)
        np.add.at(counts, at, np.concatenate([c for _, c in found]))
    return n_words, buckets.astype(np.int32), counts.astype(np.int64)


def features(docs: DataFrame, rule: Rule, keep: tuple[str, ...], text: str) -> DataFrame:
    """The columns ``keep``, the number of words and the histogram of each whole text."""
    rows = docs.select(*keep, F.col(text).alias("_text"))
    columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["n_words long, buckets array<int>, counts array<long>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [histogram(t.as_py(), rule) for t in batch.column(len(keep))]
            arrays = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int32())), pa.array([f[2] for f in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *arrays], [*keep, "n_words", "buckets", "counts"])

    return rows.mapInArrow(run, columns)


def totals(rows: DataFrame, rule: Rule) -> np.ndarray:
    """The features in each bucket over all rows: a partial histogram per task, ``rule.buckets`` numbers on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(rule.buckets, np.int64)
        for batch in batches:
            np.add.at(total, batch.column("buckets").flatten().to_numpy(), batch.column("counts").flatten().to_numpy())
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["bucket", "n"])

    sums = rows.select("buckets", "counts").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(rule.buckets, np.int64)
    for bucket, n in sums.collect():
        total[bucket] = n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight, in thousandths, rounded down."""
    n, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    ratios = ((t + 1) * (all_s + n) / ((s + 1) * (all_t + n)) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], dtype=np.int64)


def noise(doc_id, seed: int) -> int:
    """Gumbel noise of a document in thousandths, rounded down; a null id is one id."""
    h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance(docs: DataFrame, target: DataFrame, rule: Rule = Rule(), text: str = "text", target_text: str = "text") -> DataFrame:
    """``doc_id``, ``_text_key``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of each row of ``docs``.

    Of the N rows with at least ``rule.least_words`` words the floor(percent * N / 100) highest
    scores are drawn and ranked from 1, ties to the smaller doc_id (none last); the rank of
    the others is null. Null and empty texts have no features and weight 0. Repeated
    rows keep a row each, and ranks of their own. An empty target counts as one without
    features; no documents give no rows. Other columns are not read.
    """
    ws = Workspace(docs.sparkSession, "resampling")
    keyed = docs.select("doc_id", common.text_key(text).alias("_text_key"), F.col(text).alias("_of"))
    rows = ws.table("features", features(keyed, rule, ("doc_id", "_text_key"), "_of"))
    gain = gains(totals(rows, rule), totals(features(target, rule, (), target_text), rule))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column("counts")
            ends = np.cumsum(counts.value_lengths().fill_null(0).to_numpy())
            n = counts.flatten().to_numpy()
            sums = [np.concatenate(([0], np.cumsum(v)))[np.concatenate(([0], ends))] for v in (n, n * gain[batch.column("buckets").flatten().to_numpy()])]
            n_features, weight = np.diff(sums[0]), np.diff(sums[1])
            added = np.array([noise(i, rule.seed) for i in batch.column("doc_id").to_pylist()], dtype=np.int64)
            arrays = [pa.array(n_features), pa.array(weight), pa.array(weight + added)]
            names = ["doc_id", "_text_key", "n_words"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *arrays], [*names, "n_features", "weight", "score"])

    scored = rows.mapInArrow(score, f"doc_id {kind}, _text_key long, n_words long, n_features long, weight long, score long")
    # A number per row, fixed once the table is written, so that ranges never depend on how equal rows fall.
    scored = ws.table("scored", scored.withColumn("_row", F.monotonically_increasing_id()))
    able = F.col("n_words") >= rule.least_words
    drawn = scored.where(able).count() * rule.percent // 100
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ordered = scored.where(able).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "_row")
    ordered = ws.table("ordered", ordered.withColumns({"_part": F.spark_partition_id(), "_place": place}))
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per partition
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    rank = F.col("_before") + F.col("_place") + 1
    ranked = ordered.join(F.broadcast(before), "_part").withColumn("rank", F.when(rank <= drawn, rank))
    columns = ["doc_id", "_text_key", "n_words", "n_features", "weight", "score"]
    rest = scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, "rank").unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, rule: Rule = Rule(), text: str = "text", target_text: str = "text") -> DataFrame:
    """The drawn rows of ``docs``, all columns as they are; of rows equal in doc_id and text all are drawn or none."""
    found = importance(docs, target, rule, text, target_text).where("rank IS NOT NULL").select(F.col("doc_id").alias("_id"), F.col("_text_key").alias("_key")).distinct()
    rows = common.packed(docs, _doc=F.col("doc_id"), _text=common.text_key(text))
    return rows.join(found, rows["_doc"].eqNullSafe(found["_id"]) & (rows["_text"] == found["_key"]), "left_semi").select("_row.*")
