"""Byte-level BPE over a local rank file, encoding and decoding in one pass of Arrow batches.

A text of more than ``PIECE`` characters is cut where a match of the splitting pattern
always ends, so that its tokens are those of the uncut text: between a non-blank and a
blank, or else where letters or digits end. Only a run without such a place stays whole;
if it is one long run of blanks, which the pattern engine can't take, its matches are
known without it. Ids decode to bytes, not to text, so nothing is replaced on the way.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters that are encoded at once, if the text can be cut.
PIECE = 100_000
# A run of blanks of at least this length is taken out before the pattern sees it.
BLANKS = 10_000
OUTPUTS = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded": "binary", "decoded_sha256": "string"}
_ARROW = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "ids_sha256": pa.string(), "decoded": pa.binary(), "decoded_sha256": pa.string()}

_SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])")
_RUN = regex.compile(rf"\s{{{BLANKS},}}+")


class Codec:
    """A rank file and a splitting pattern; encodes without special tokens."""

    def __init__(self, ranks: str, pattern: str):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.decimal = {rank: str(rank) for rank in table.values()}

    def encode(self, text: str) -> list[int]:
        if len(text) <= BLANKS:
            return self.encoding.encode_ordinary(text)
        ids, at = [], 0
        for run in _RUN.finditer(text):
            # Of a run of blanks before a word, one match takes all but the last, which goes with the word or alone.
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += self._cut(text[at : run.start()])
            ids += self.encoding._encode_single_piece(text[run.start() : end])
            at = end
        return ids + self._cut(text[at:])

    def _cut(self, text: str) -> list[int]:
        ids, at = [], 0
        while at < len(text):
            end = len(text)
            if end - at > PIECE and (place := _SAFE.search(text, at + PIECE)):
                end = place.start()
            ids += self.encoding.encode_ordinary(text[at:end])
            at = end
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)

    def digest(self, ids: list[int]) -> str:
        return hashlib.sha256(" ".join(map(self.decimal.__getitem__, ids)).encode()).hexdigest()


@lru_cache(maxsize=2)
def codec(ranks: str, pattern: str) -> Codec:
    """One codec per Python worker; the rank file is part of the installation on every executor."""
    return Codec(ranks, pattern)


def tokenized(docs: DataFrame, ranks: str, pattern: str, outputs: tuple[str, ...] = ("n_tokens", "ids"), keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns ``keep`` and, of each whole text, the ``outputs`` asked for (see ``OUTPUTS``).

    A null or empty text has no tokens and decodes to no bytes. Every row gives a row,
    repeated rows too; no rows give none. ``decoded`` and ``decoded_sha256`` come from
    the ids alone. Columns not in ``keep`` are not read; a kept column may not have the
    name of an output.
    """
    kept = docs.select(*keep, F.col(text).alias("_bpe_text"))
    columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + [f"{o} {OUTPUTS[o]}" for o in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(ranks, pattern)
        for batch in batches:
            found = {o: [] for o in outputs}
            for text in batch.column(len(keep)):
                ids = code.encode(text.as_py() or "")
                if "decoded" in found or "decoded_sha256" in found:
                    raw = code.decode(ids)
                for o in outputs:
                    if o == "n_tokens":
                        found[o].append(len(ids))
                    elif o == "ids":
                        found[o].append(pa.array(ids, pa.int32()))
                    elif o == "ids_sha256":
                        found[o].append(code.digest(ids))
                    elif o == "decoded":
                        found[o].append(raw)
                    else:
                        found[o].append(hashlib.sha256(raw).hexdigest())
            arrays = [_lists(found[o]) if o == "ids" else pa.array(found[o], _ARROW[o]) for o in outputs]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *arrays], [*keep, *outputs])

    return kept.mapInArrow(run, columns)


def _lists(rows: list[pa.Array]) -> pa.Array:
    offsets = [0]
    for r in rows:
        offsets.append(offsets[-1] + len(r))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays(rows) if rows else pa.array([], pa.int32()))


def decoded(tokens: DataFrame, ranks: str, pattern: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the raw bytes ``decoded`` of the array of ids; null ids decode to no bytes."""
    kept = tokens.select(*keep, F.col(ids).alias("_bpe_ids"))
    columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]] + ["decoded binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(ranks, pattern)
        for batch in batches:
            raw = [code.decode(row.as_py() or []) for row in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(raw, pa.binary())], [*keep, "decoded"])

    return kept.mapInArrow(run, columns)
