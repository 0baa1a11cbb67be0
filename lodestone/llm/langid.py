"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's vector is the mean of the embeddings of all its character n-grams, hashed into
buckets; a linear softmax names the language. Embeddings and softmax are learned together
by stochastic gradient descent in numpy, on a bounded sample of labelled rows. A part
of the sample is held back: a temperature is fitted on it, and the level of the
calibrated score below which a text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm import common, hashing
from lodestone.session import Workspace

BITS = 15
SIZES = (1, 2, 3)
DIMENSIONS = 16
# Rows that the model learns from: at most so many of each language.
SAMPLE_PER_LANGUAGE = 500
EPOCHS, RATE = 6, 4.0
# Share of the held-back rows that may fall below the level of rejection, and the highest level.
REJECTED, LEVEL = 0.002, 0.4
UNKNOWN = "und"


def subwords(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of the whole text's words, in parts; nothing if it has no letter."""
    points = hashing.words_only(hashing.code_points((text or "").lower()))
    if len(points) > 1:
        yield from hashing.parts(points, SIZES, BITS)


def _features(rows: DataFrame) -> DataFrame:
    """Of (lang, _order, _text): the buckets that a text has and their shares, at most 2^BITS numbers a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, share = [], []
            for text in batch.column("_text"):
                counts = np.zeros(1 << BITS, dtype=np.int64)
                for part in subwords(text.as_py()):
                    counts += np.bincount(part, minlength=1 << BITS)
                at = np.flatnonzero(counts)
                index.append(at.astype(np.int32))
                share.append((counts[at] / max(1, counts.sum())).astype(np.float32))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("_order"), pa.array(index, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32()))], ["lang", "_order", "at", "share"])

    return rows.mapInArrow(run, "lang string, _order long, at array<int>, share array<float>")


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # buckets x languages: embeddings times softmax weights, over the temperature
    bias: np.ndarray
    level: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated score; ``und`` and 0 for a text without letters."""
        total, n = np.zeros(len(self.languages)), 0
        for part in subwords(text):
            total += self.weights[part].sum(axis=0, dtype=np.float64)
            n += len(part)
        if not n or not self.languages:
            return UNKNOWN, 0.0
        scores = _softmax(total / n + self.bias)
        best = int(scores.argmax())
        return self.languages[best], float(scores[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def trained(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learns from rows with text and language; rows with a null in either, or no letter, are passed over.

    Of each language at most ``SAMPLE_PER_LANGUAGE`` distinct texts are taken, by their hashes, so the same rows give the same model. Without any row the model knows no
    language and answers ``und``.
    """
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("_order"), F.col(text).alias("_text")).where("lang is not null and _text is not null")
    ws = Workspace(labelled.sparkSession, "langid")
    # Of a language with many texts only a share of the hashes, about four times the texts wanted, is looked at.
    # Copies are one text, so they don't shrink the sample.
    texts = ws.table("texts", rows.select("lang", "_order").distinct())
    sizes = ws.table("languages", texts.groupBy("lang").agg(F.count("*").alias("_texts")))
    some = F.pmod(F.xxhash64(F.lit("sample"), "_order"), F.lit(1 << 30)).cast("double") * F.col("_texts") < F.lit((1 << 30) * 4.0 * SAMPLE_PER_LANGUAGE)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("_order"))
    keys = texts.join(sizes, "lang").where(some).select("lang", "_order")
    keys = ws.table("sample", keys.withColumn("_n", first).where(F.col("_n") <= SAMPLE_PER_LANGUAGE).drop("_n"))
    if keys.count() <= common.SMALL_ROWS:
        keys = F.broadcast(keys)
    sample = _features(rows.join(keys, ["lang", "_order"], "left_semi").dropDuplicates(["lang", "_order"]))
    data = sample.where(F.size("at") > 0).toArrow().sort_by([("_order", "ascending"), ("lang", "ascending")])
    lists = {c: [np.asarray(x.values) for x in data.column(c)] for c in ("at", "share")}
    return fitted(data.column("lang").to_pylist(), lists["at"], lists["share"])


def fitted(names: list[str], at: list[np.ndarray], share: list[np.ndarray]) -> Model:
    """The model of rows in a fixed order: every tenth is held back for calibration."""
    languages = tuple(sorted(set(names)))
    if not languages:
        return Model((), np.zeros((1 << BITS, 0), np.float32), np.zeros(0), 0.0)
    y = np.array([languages.index(n) for n in names])
    rng = np.random.default_rng(7)
    vectors = (rng.random((1 << BITS, DIMENSIONS), np.float32) - 0.5) / DIMENSIONS
    softmax = np.zeros((DIMENSIONS, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    held = np.arange(len(y)) % 10 == 9
    learn = np.flatnonzero(~held)
    # Rare languages weigh as much as frequent ones.
    weight = (1 / np.bincount(y[learn], minlength=len(languages)).clip(1))[y]
    weight = weight / weight[learn].mean()
    steps, total = 0, EPOCHS * len(learn)
    for _ in range(EPOCHS):
        for i in rng.permutation(learn):
            rate = np.float32(RATE * (1 - steps / total) * min(weight[i], 10))
            mean = share[i] @ vectors[at[i]]
            slope = _softmax(mean @ softmax + bias)
            slope[y[i]] -= 1
            back = softmax @ slope
            softmax -= rate * np.outer(mean, slope)
            bias -= np.float32(0.01) * rate * slope
            vectors[at[i]] -= rate * share[i][:, None] * back[None, :]
            steps += 1
    flat = vectors @ softmax
    test = np.flatnonzero(held) if held.any() else learn
    raw = np.stack([share[i] @ flat[at[i]] + bias for i in test])
    # The temperature of the least loss on the held-back rows.
    heats = np.geomspace(0.05, 20, 60)
    losses = [-np.log(_softmax(raw / t)[np.arange(len(test)), y[test]] + 1e-12).mean() for t in heats]
    heat = heats[int(np.argmin(losses))]
    scores = _softmax(raw / heat).max(axis=1)
    level = min(LEVEL, float(np.quantile(scores, REJECTED)))
    return Model(languages, (flat / heat).astype(np.float32), bias / heat, level)


def identified(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``lang_pred``, ``score`` and ``rejected``, of each whole text.

    Null, empty and letterless texts are ``und``, score 0, rejected. A text below the
    model's level keeps its best guess and is rejected. Equal texts have equal results;
    repeated rows stay; no rows give none. Only the text is read for a prediction.
    """
    rows = docs.select(*keep, F.col(text).alias("_lang_text"))
    columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["lang_pred string, score double, rejected boolean"])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            found = [known.predict(t.as_py()) for t in batch.column(len(keep))]
            new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[0] == UNKNOWN or f[1] < known.level for f in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *new], [*keep, "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, columns)


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with all their columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            found = [known.predict(t.as_py()) for t in batch.column(text)]
            yield batch.filter(pa.array([f[0] != UNKNOWN and f[1] >= known.level for f in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
