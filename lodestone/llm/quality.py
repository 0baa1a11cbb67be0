"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on each whole text. All documents are
counted by their pattern of votes, of which there are at most 3^labellers, and expectation-
maximisation on these counts estimates how good documents are shared out and how often each
labeller says what on good and on bad ones. The posterior of a pattern is the soft label of
its documents. A linear scorer on hashed character n-grams and statistics is trained on
the soft labels of a bounded sample, and scores every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import common, hashing
from lodestone.session import Workspace

# Documents that the scorer is fitted on, at most, spread over good and bad posteriors alike.
FIT_SAMPLE = 3_000
BITS, SIZES = 15, (1, 2, 3)
EPOCHS, RATE, DECAY = 6, 2.0, 1e-6
EM_ROUNDS = 200
KEEP = 0.5

LOWER, UPPER, DIGIT, BLANK, POINT, OTHER = range(6)


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """The kind of each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    out[hashing.letters()] = LOWER
    out[np.frombuffer(bytes(map(str.isupper, map(chr, range(0x110000)))), np.bool_)] = UPPER
    out[np.frombuffer(bytes(map(str.isdigit, map(chr, range(0x110000)))), np.bool_)] = DIGIT
    out[np.frombuffer(bytes(map(str.isspace, map(chr, range(0x110000)))), np.bool_)] = BLANK
    out[[ord(c) for c in ".,;:?'\"()-–’"]] = POINT
    return out


def statistics(text: str) -> dict[str, float]:
    """Figures of a whole text that the labellers look at."""
    words = text.split()
    n = len(words)
    count = np.zeros(6, np.int64)
    for i in range(0, len(text), hashing.PART):
        count += np.bincount(kinds()[hashing.code_points(text[i : i + hashing.PART])], minlength=6)
    letters = int(count[LOWER] + count[UPPER])
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    return {
        "words": n,
        "mean": (len(text) - int(count[BLANK])) / n if n else 0.0,
        "symbols": int(count[OTHER]) / max(1, len(text) - int(count[BLANK])),
        "upper": int(count[UPPER]) / max(1, letters),
        "letters": letters / max(1, len(text) - int(count[BLANK])),
        "distinct": len(set(words)) / n if n else 0.0,
        "ends": sum(x[-1] in ".!?:\"'" for x in lines) / len(lines) if lines else 0.0,
        "lines": 1 - len(set(lines)) / len(lines) if lines else 0.0,
        "marks": sum(1 for w in words if not any(map(str.isalnum, w))) / n if n else 0.0,
    }


# A labeller: a statistic; the range in which it votes good; the range in which it votes bad. Elsewhere, or in texts of
# fewer words than its last number, it doesn't vote.
LABELLERS = (
    ("words", (8, np.inf), (0, 3), 0),
    ("mean", (3, 9), (12, np.inf), 3),
    ("symbols", (0, 0.02), (0.06, 1), 1),
    ("upper", (0, 0.15), (0.3, 1), 3),
    ("letters", (0.85, 1), (0, 0.7), 1),
    ("distinct", (0.3, 1), (0, 0.15), 20),
    ("ends", (0.5, 1), (0, 0.1), 8),
    ("lines", (0, 0.1), (0.3, 1), 8),
    ("marks", (0, 0.02), (0.08, 1), 3),
)


def votes(figures: dict[str, float]) -> list[int]:
    """1 good, 2 bad, 0 no vote, of each labeller."""
    out = []
    for name, good, bad, least in LABELLERS:
        x = figures[name]
        out.append(0 if figures["words"] < least else 1 if good[0] <= x <= good[1] else 2 if bad[0] <= x <= bad[1] else 0)
    return out


def coded(pattern: list[int]) -> int:
    return sum(v * 3**k for k, v in enumerate(pattern))


def pattern_of(code: int) -> list[int]:
    return [code // 3**k % 3 for k in range(len(LABELLERS))]


def features(text: str, figures: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text: shares of its n-grams, and one bucket for each statistic's place."""
    counts = np.zeros(1 << BITS, np.int64)
    for i in range(0, len(text), hashing.PART):
        points = hashing.code_points(text[i : i + hashing.PART + max(SIZES) - 1])
        counts += np.bincount(hashing.buckets(points, SIZES, BITS), minlength=1 << BITS)
    at = np.flatnonzero(counts)
    share = counts[at] / max(1, counts.sum())
    # log of a count and tenths of a share name the place; their buckets follow those of the n-grams
    places = [min(15, int(np.log2(1 + x)) if k in ("words", "mean") else int(10 * x)) for k, x in figures.items()]
    own = (1 << BITS) + 16 * np.arange(len(places)) + np.array(places)
    return np.concatenate((at, own)).astype(np.int32), np.concatenate((share, np.full(len(places), 0.2))).astype(np.float32)


WIDTH = (1 << BITS) + 16 * 9


@dataclass(frozen=True)
class Labels:
    """Share of good documents; for good and bad, each labeller's probabilities of its three answers."""

    good: float
    answers: np.ndarray  # 2 x labellers x 3

    def posterior(self, pattern: list[int]) -> float:
        """Probability that a document with these votes is good; the share of good ones if nobody votes."""
        k = np.arange(len(pattern))
        cast = np.array(pattern) > 0
        log = np.log(self.answers[:, k, pattern]) @ cast + np.log([self.good, 1 - self.good])
        return float(1 / (1 + np.exp(np.clip(log[1] - log[0], -60, 60))))


def fitted_labels(patterns: list[int], counts: list[int]) -> Labels:
    """Expectation-maximisation over counted patterns, begun at the majority of votes."""
    votes_of = np.array([pattern_of(p) for p in patterns]).reshape(-1, len(LABELLERS))
    n = np.array(counts, dtype=np.float64)
    if not n.sum():
        return Labels(0.5, np.full((2, len(LABELLERS), 3), 1 / 3))
    is_vote = np.stack([votes_of == v for v in range(3)], axis=2)  # patterns x labellers x answers
    good, bad = (votes_of == 1).sum(1), (votes_of == 2).sum(1)
    p = np.where(bad > 0, 0.5 * good / np.maximum(1, good + 2 * bad), np.where(good > 0, 0.9, 0.5))
    cast = is_vote[:, :, 1:]
    for _ in range(EM_ROUNDS):
        share = float(np.clip((p * n).sum() / n.sum(), 1e-3, 1 - 1e-3))
        weights = np.stack((p * n, (1 - p) * n))
        said = np.einsum("cp,pkv->ckv", weights, cast) + 0.5  # smoothed
        said = said / said.sum(axis=2, keepdims=True)
        log = np.einsum("ckv,pkv->pc", np.log(said), cast) + np.log([share, 1 - share])
        new = 1 / (1 + np.exp(np.clip(log[:, 1] - log[:, 0], -60, 60)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    answers = np.concatenate((np.ones((2, len(LABELLERS), 1)), said), axis=2)
    # Labellers are better than chance: "good" is the class in which they vote good more often.
    if answers[0, :, 1].mean() < answers[1, :, 1].mean():
        share, answers = 1 - share, answers[::-1].copy()
    return Labels(share, answers)


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, at: np.ndarray, value: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[at] @ value + self.bias, -60, 60))))


def fitted_scorer(at: list[np.ndarray], value: list[np.ndarray], soft: np.ndarray) -> Scorer:
    """Logistic regression on soft labels by stochastic gradient descent, good and bad weighing the same."""
    weights, bias = np.zeros(WIDTH, np.float32), 0.0
    balance = np.clip(np.array([soft.sum(), (1 - soft).sum()]) / max(1, len(soft)), 0.02, 1)
    rng, steps, total = np.random.default_rng(5), 0, max(1, EPOCHS * len(soft))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(soft)):
            p = 1 / (1 + np.exp(-np.clip(weights[at[i]] @ value[i] + bias, -60, 60)))
            weigh = 0.5 * (soft[i] / balance[0] + (1 - soft[i]) / balance[1])
            step = RATE * (1 - steps / total) * weigh * (p - soft[i])
            weights[at[i]] -= np.float32(step) * value[i] * np.float32(20) + np.float32(DECAY) * weights[at[i]]
            bias -= 0.1 * step
            steps += 1
    return Scorer(weights, float(bias))


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_order`` (a hash of the text) and ``pattern``, the labellers' votes, of every row."""
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text")).select(F.xxhash64("_text").alias("_order"), "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [coded(votes(statistics(t.as_py()))) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_order"), pa.array(found, pa.int32())], ["_order", "pattern"])

    return rows.mapInArrow(run, "_order long, pattern int")


def trained(docs: DataFrame, text: str = "text") -> tuple[Labels, Scorer]:
    """The label model of all documents and the scorer fitted on the bounded sample."""
    ws = Workspace(docs.sparkSession, "quality")
    texts = ws.table("votes", labelled(docs, text).groupBy("_order", "pattern").agg(F.count("*").alias("n")))  # a row per text
    patterns = sorted(map(tuple, texts.groupBy("pattern").agg(F.sum("n"), F.count("*")).collect()))
    labels = fitted_labels([p for p, _, _ in patterns], [n for _, n, _ in patterns])
    soft = {p: labels.posterior(pattern_of(p)) for p, _, _ in patterns}
    bad = [p for p in soft if soft[p] < 0.5]
    half = FIT_SAMPLE // 2
    chosen = None
    # The share is of distinct texts, so copies don't shrink the sample.
    for one, n in ((F.col("pattern").isin(bad), sum(n for p, _, n in patterns if p in bad)), (~F.col("pattern").isin(bad), sum(n for p, _, n in patterns if p not in bad))):
        part = texts.where(one & common.share_of(n, half, "_order")).select("_order", "pattern").orderBy(F.xxhash64("_order"), "_order").limit(half)
        chosen = part if chosen is None else chosen.union(part)
    keys = ws.table("sample", chosen)  # at most FIT_SAMPLE rows
    whole = docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn("_order", F.xxhash64("_text"))
    sample = whole.join(F.broadcast(keys), "_order").dropDuplicates(["_order"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t, statistics(t)) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_order"), batch.column("pattern"), pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float32()))], ["_order", "pattern", "at", "value"])

    data = sample.select("_order", "pattern", "_text").mapInArrow(run, "_order long, pattern int, at array<int>, value array<float>").toArrow().sort_by("_order")
    lists = {c: [np.asarray(x.values) for x in data.column(c)] for c in ("at", "value")}
    return labels, fitted_scorer(lists["at"], lists["value"], np.array([soft[p] for p in data.column("pattern").to_pylist()]))


def classified(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``weak_label`` (posterior of the votes), ``score`` and ``good`` of each whole text.

    A document is good if its score is at least ``KEEP``. Null and empty texts count as
    empty and are not good: weak_label as the model has it, score 0. Equal texts have
    equal results; repeated rows stay. No rows give none. Columns not in ``keep`` are not
    read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs, text))
    rows = docs.select(*keep, F.col(text).alias("_quality_text"))
    columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["weak_label double, score double, good boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, scorer = sent.value
        known: dict[int, float] = {}
        for batch in batches:
            weak, scores = [], []
            for text in batch.column(len(keep)):
                text = text.as_py() or ""
                figures = statistics(text)
                code = coded(pattern := votes(figures))
                if code not in known:
                    known[code] = labels.posterior(pattern)
                weak.append(known[code])
                scores.append(scorer.score(*features(text, figures)) if figures["words"] else 0.0)
            new = [pa.array(weak, pa.float64()), pa.array(scores, pa.float64()), pa.array([s >= KEEP for s in scores], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *new], [*keep, "weak_label", "score", "good"])

    return rows.mapInArrow(run, columns)
