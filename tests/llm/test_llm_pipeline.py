"""The pipeline against a plain version of it, and its stages on odd tables."""

import base64
import collections

import pytest
import tiktoken

import corpus_pipeline
from lodestone.llm import common, langid, mixing, queries

from .test_llm_new_ops import near_pairs
from .test_llm_ops import brute_lines, groups_of

ODD = [(1, None, "en", "s", 0), (2, "", None, None, 0), (3, "the of and then with that this", "en", "s", 5), (3, "the of and then with that this", "en", "s", 5), (4, "der und nicht " * 50_000, "de", None, 1), (None, "le de la et les des", "fr", "t", 2)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_run_is_the_plain_pipeline(spark, sf):
    docs = common.table(spark, sf, "documents")
    model = langid.trained(docs.where(~queries.held_out()))
    rows = [r for r in docs.collect() if (p := model.predict(r.text))[0] != "und" and p[1] >= model.level]
    of = groups_of([r.doc_id for r in rows], near_pairs([(r.doc_id, r.text) for r in rows]))
    rows = [r for r in rows if of[r.doc_id] == r.doc_id]
    clean = brute_lines([(r.doc_id, r.text) for r in rows])
    rows = [(r.doc_id, clean[r.doc_id], r.lang, r.source, len(clean[r.doc_id])) for r in rows if clean[r.doc_id].strip()]
    mix = mixing.mixed(spark.createDataFrame(rows, SCHEMA)).collect()
    copies = {r.doc_id: r.copies for r in mix}
    with open(queries.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("t", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = corpus_pipeline.run(spark, sf).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter({i: n for i, n in copies.items() if n})
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        assert list(r.ids) == encoding.encode_ordinary(texts[r.doc_id])


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_tables(spark, sf, k):
    name, stage = corpus_pipeline.STAGES[k]
    docs = spark.createDataFrame([(*r, "x", 1) for r in ODD], SCHEMA + ", taken string, _key int")
    out = stage(spark, docs, sf)
    rows = out.collect()
    if k < 4:
        assert out.columns == docs.columns
    assert stage(spark, docs.limit(0), sf).count() == 0
    if name == "simhash_near_dedup":
        assert sorted(str(r.doc_id) for r in rows) == ["1", "3", "4", "None"]
    if name == "byte_bpe":
        assert len(rows) == len(ODD)
