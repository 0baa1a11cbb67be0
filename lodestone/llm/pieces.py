"""SentencePiece encoding and decoding over a table of distinct marked words.

The library turns each blank into a marker and puts one before the text. If no piece of
the model has a marker behind another character, no merge crosses the place before a run
of markers, so a text's ids are those of its marked words, run of markers included, one
after the other. Texts are cut there; the library segments each distinct word of a task
once, into the task's table, and the ids are joined back by the words' positions in the
text. The table is bounded and nothing is shuffled: a table of all tasks' words would
have to travel to every text, or every text to it, which costs more than it saves (see
README).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
MARKED = re.compile(f"{MARK}+[^{MARK}]*")
# A worker's table of distinct words starts anew beyond this many.
TABLE_WORDS = 1 << 19
# Texts are encoded together until they have so many words.
GROUP_WORDS = 1 << 18
OUTPUTS = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}
_ARROW = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "ids_sha256": pa.string(), "decoded": pa.string(), "decoded_sha256": pa.string()}


class Codec:
    """A model whose pieces don't cross markers; ids without begin and end, without sampling."""

    def __init__(self, model: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = map(self.model.id_to_piece, range(len(self.model)))
        crossing = any(MARK in p.lstrip(MARK) for p in pieces)
        marked = self.model.normalize("  a  b ") == f"{MARK * 3}a{MARK * 2}b{MARK}"
        if crossing or not marked or self.model.piece_to_id(MARK) == self.model.unk_id():
            raise ValueError("pieces cross the markers, or the model lacks the marker or does not mark each blank: words can't be segmented apart")
        self.decimal = [str(i) for i in range(len(self.model))]

    def words(self, text: str) -> list[str]:
        """The marked words of a whole text; they join to its normal form."""
        return MARKED.findall(self.model.normalize(text))

    def segmented(self, words: list[str]) -> list[list[int]]:
        """The ids of each marked word. The marker that the library sets before it is taken off first."""
        plain = [w[1:].replace(MARK, " ") for w in words]
        for word, text, normal in zip(words, plain, self.model.normalize(plain), strict=True):
            if text and normal != word:
                raise ValueError("the model's normal form is not its own normal form: words can't be segmented apart")
        # A text of one marker only, which no plain text gives, is that piece.
        return [ids if text else [self.model.piece_to_id(MARK)] for text, ids in zip(plain, self.model.encode(plain, num_threads=1), strict=True)]

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


class Table:
    """The distinct words met so far, with their ids as decimal text: plain strings, which the garbage collector need not visit."""

    def __init__(self, code: Codec):
        self.code, self.known = code, {}

    def learn(self, texts: list[list[str]]) -> None:
        """Segments the words that are new, each once, all of them together."""
        if len(self.known) > TABLE_WORDS:
            self.known = {}
        fresh = [w for w in dict.fromkeys(chain.from_iterable(texts)) if w not in self.known]
        decimal = self.code.decimal
        for word, ids in zip(fresh, self.code.segmented(fresh), strict=True):
            self.known[word] = ",".join([decimal[i] for i in ids])

    def of(self, words: list[str]) -> str:
        """The ids of learned words, in order, joined by commas."""
        known = self.known
        return ",".join([known[w] for w in words])


@lru_cache(maxsize=2)
def codec(model: str) -> Codec:
    """One codec per Python worker; the model file is part of the installation on every executor."""
    return Codec(model)


def tokenized(docs: DataFrame, model: str, outputs: tuple[str, ...] = ("n_tokens", "ids"), keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` and, of each whole text, the ``outputs`` asked for (see ``OUTPUTS``).

    A null or empty text has no tokens and decodes to the empty text. Every row gives a row,
    repeated rows too; no rows give none. ``decoded`` and ``decoded_sha256`` come from the
    ids alone. Columns not in ``keep`` are not read; a kept column may not have the name of an
    output. Raises where the model's pieces can cross markers.
    """
    codec(model)  # a model that can't be cut at its markers fails here, not in a task
    kept = docs.select(*keep, F.col(text).alias("_piece_text"))
    columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + [f"{o} {OUTPUTS[o]}" for o in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(model)
        table = Table(code)
        for batch in batches:
            found = {o: [] for o in outputs}
            for joined in _encoded(table, batch.column(len(keep))):
                ids = np.fromstring(joined, np.int32, sep=",") if joined else np.empty(0, np.int32)
                if "decoded" in found or "decoded_sha256" in found:
                    back = code.decode(ids.tolist()) if joined else ""
                for o in outputs:
                    if o == "n_tokens":
                        found[o].append(len(ids))
                    elif o == "ids":
                        found[o].append(pa.array(ids))
                    elif o == "ids_sha256":
                        found[o].append(hashlib.sha256(joined.encode()).hexdigest())
                    elif o == "decoded":
                        found[o].append(back)
                    else:
                        found[o].append(hashlib.sha256(back.encode()).hexdigest())
            arrays = [pa.array(found[o], _ARROW[o]) if o != "ids" else _lists(found[o]) for o in outputs]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *arrays], [*keep, *outputs])

    return kept.mapInArrow(run, columns)


def _encoded(table: Table, texts: pa.Array) -> Iterator[str]:
    """The ids of each text, as decimal text; the table learns a bounded number of words at a time, or one text's."""
    group, size = [], 0
    for i, text in enumerate(texts):
        group.append(table.code.words(text.as_py() or ""))
        size += len(group[-1])
        if size >= GROUP_WORDS or i + 1 == len(texts):
            table.learn(group)
            yield from map(table.of, group)
            group, size = [], 0


def _lists(rows: list[pa.Array]) -> pa.Array:
    offsets = [0]
    for r in rows:
        offsets.append(offsets[-1] + len(r))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays(rows) if rows else pa.array([], pa.int32()))
