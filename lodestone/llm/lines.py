"""Removal of repeated passages by hashed units of text.

A text is cut into units: lines, and the sentences of a line. Full-width stops end a
sentence without a blank too. Words are counted at blanks; in scripts without blanks, and
in long strings, by letters (``size_of``). Units of three words or more are normalised (lower case, blanks collapsed) and hashed to 128 bits. Per digest the
smallest doc_id is found over all documents; there the unit stays. Elsewhere, or when it
comes again in its own document, it is a repeat. A run of repeated units is removed if
it has ``RUN_WORDS`` words in all; shorter units between two removed ones go with them, so
a passage goes as a whole and a stray common phrase stays. Offsets of what was removed
refer to the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestone.llm import common
from lodestone.session import Workspace

UNIT_WORDS = 3
RUN_WORDS = 8
# Letters that count as a word: of any text, so that strings without blanks count; of scripts written without blanks.
WORD_LETTERS, HAN_LETTERS, THAI_LETTERS = 12, 2, 5
_END = re.compile(r"[.!?]+\s+|\n+")
_FULL_STOP = re.compile("[。．！？｡]")
_ANY_END = re.compile(r"[.!?]+\s+|[。．！？｡]+[」』）”’]*\s*|\n+")  # slower than _END
_HAN = re.compile("[\u2e80-\u2fdf\u3005-\u3007\u3021-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\ua4cf\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
_THAI = re.compile("[\u0e01-\u0eff\u0f40-\u0fbc\u1000-\u109f\u1780-\u17d3]")
_LAST = (1 << 63) - 1


def size_of(unit: str, words: int) -> int:
    """Words of a normalised unit of ``words`` between blanks, or as many as its letters make."""
    if unit.isascii():
        return max(words, len(unit) // WORD_LETTERS)
    return max(words, len(unit) // WORD_LETTERS, len(_HAN.findall(unit)) // HAN_LETTERS + len(_THAI.findall(unit)) // THAI_LETTERS)


def units(text: str) -> tuple[list[tuple[int, int]], list[int], list[bytes | None]]:
    """Spans that tile the text, their words, and their digests (None for short units)."""
    spans, words, digests, at = [], [], [], 0
    ends = _END if text.isascii() or not _FULL_STOP.search(text) else _ANY_END
    for end in [m.end() for m in ends.finditer(text)] + [len(text)]:
        if end == at:
            continue
        tokens = text[at:end].lower().split()
        spans.append((at, end))
        unit = " ".join(tokens)
        words.append(len(tokens) if len(tokens) >= RUN_WORDS else size_of(unit, len(tokens)))  # no floor asks for more
        digests.append(xxhash.xxh3_128_digest(unit.encode("utf-8", "replace")) if words[-1] >= UNIT_WORDS else None)
        at = end
    return spans, words, digests


def _rank(doc_id) -> int:
    return _LAST if doc_id is None else int(doc_id)


def occurrences(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row (doc, key, h1, h2) for every distinct digest of a row; rows without id are the last document.

    ``key`` is the text key: together with doc it names a row, whose digests its own text bounds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, found = [], [], []
            for doc, text in zip(batch.column("doc_id"), batch.column("_text"), strict=True):
                own = set(units(text.as_py() or "")[2]) - {None}
                ids.append(_rank(doc.as_py()))
                counts.append(len(own))
                found.extend(own)
            digests = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
            names = [np.repeat(x, counts) for x in (np.array(ids, np.int64), batch.column("_key").to_numpy())]
            yield pa.RecordBatch.from_arrays([*map(pa.array, names), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy())], ["doc", "key", "h1", "h2"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_key(text).alias("_key"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, "doc long, key long, h1 long, h2 long")


def repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc``, ``key`` and ``digests``, those of the row's units that an earlier document has.

    Kept per row and not per document: however many rows share a doc_id, or have none, a
    set is no larger than one text.
    """
    ws = Workspace(docs.sparkSession, "lines")
    rows = occurrences(docs, text)
    first = rows.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    first = ws.table("first", first.select("h1", "h2", "first"))
    again = rows.join(first, ["h1", "h2"]).where("doc > first")
    # A set: equal rows bring a digest once.
    return ws.table("repeats", again.groupBy("doc", "key").agg(F.collect_set(F.struct("h1", "h2")).alias("digests")))


def removed(text: str, known: set[bytes]) -> list[tuple[int, int]]:
    """Spans to remove of a text, whose repeated digests are ``known``."""
    spans, words, digests = units(text)
    seen: set[bytes] = set()
    again = []
    for d in digests:
        again.append(None if d is None else d in known or d in seen)
        seen.add(d)
    out, at = [], 0
    while at < len(spans):
        if not again[at]:  # a run begins with a repeat
            at += 1
            continue
        end, last = at, at
        while end < len(spans) and again[end] is not False:
            last = end if again[end] else last
            end += 1
        if sum(words[at : last + 1]) >= RUN_WORDS:
            out.append((spans[at][0], spans[last][1]))
        at = last + 1
    return out


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_row`` (the row as it was), ``clean`` (its text without repeats) and ``removed`` (spans in the original, code points).

    Documents rank by doc_id; those without come last, as one document. Rows that share
    a doc_id are one document: their units are no repeats of each other. A null text
    stays null, an empty one empty; both lose nothing. Texts of any length are read
    whole. No rows give none.
    """
    known = repeats(docs, text)
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    rows = common.packed(docs, _doc=rank, _key=common.text_key(text), _text=F.col(text))
    joined = rows.join(known, (rows["_doc"] == known["doc"]) & (rows["_key"] == known["key"]), "left").select("_row", "_text", "digests")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, spans = [], []
            for text, digests in zip(batch.column("_text"), batch.column("digests"), strict=True):
                text = text.as_py()
                have = {np.array([d["h1"], d["h2"]], "<i8").tobytes() for d in digests.as_py() or ()}
                gone = removed(text, have) if text else []
                at, kept = 0, []
                for a, b in gone:
                    kept.append(text[at:a])
                    at = b
                clean.append(text if not gone else "".join(kept) + text[at:])
                spans.append([{"begin": a, "end": b} for a, b in gone])
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(clean, pa.string()), pa.array(spans, kind)], ["_row", "clean", "removed"])

    new = StructType.fromDDL("clean string, removed array<struct<begin:int,end:int>>")
    return joined.mapInArrow(run, StructType([rows.schema["_row"], *new.fields]))


def deduplicated(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with repeats removed from the text; a document that loses all its words goes.

    All columns are kept; an integer column n_chars gets the new length.
    """
    found = without_repeats(docs, text)
    left = found.where(F.col("clean").isNull() | (F.size("removed") == 0) | (F.length(F.trim(F.regexp_replace("clean", r"\s+", " "))) > 0))
    new = {text: F.col("clean")}
    if "n_chars" in docs.columns:
        same = F.size("removed") == 0
        new["n_chars"] = F.when(same, F.col("_row.n_chars")).otherwise(F.length("clean")).cast(docs.schema["n_chars"].dataType)
    return left.select(*[new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
