"""Each operator against a plain version on whole small tables, or by held-out accuracy."""

import base64
import collections
import hashlib
import math
import re
import textwrap

import numpy as np
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F

from lodestone.llm import bpe, common, fracmin, langid, licenses, lines, mixing, quality, queries, rabitq, simhash, warc
from lodestone.session import Workspace


def groups_of(ids, pairs):
    """Smallest id reachable, by plain union-find."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.fixture(scope="module")
def documents(spark, sf):
    return [r.asDict() for r in common.table(spark, sf, "documents").orderBy("doc_id").collect()]


# --- components ----------------------------------------------------------------------------


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (139, 300), (300, 250)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {r.id: r.component for r in common.components(Workspace(spark, "t"), edges).collect()}
    want = groups_of({x for p in pairs for x in p}, pairs)
    assert got == {i: c for i, c in want.items() if i != c}


def test_components_of_nothing(spark):
    assert common.components(Workspace(spark, "t"), spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1: quality ----------------------------------------------------------------------------


def test_quality_agrees_with_the_labels(spark, sf):
    got = {r.doc_id: r for r in queries.quality_classifier(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in common.table(spark, sf, "labels").collect()}
    good = [got[i].score for i, q in labels.items() if q == 1]
    bad = [got[i].score for i, q in labels.items() if q == 0]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.9
    assert sum(got[i].good for i, q in labels.items() if q == 1) >= 0.95 * len(good)


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.7
    right = np.linspace(0.6, 0.95, len(quality.LABELLERS))
    votes = np.where(rng.random((20_000, len(right))) < right, np.where(truth, 1, 2)[:, None], np.where(truth, 2, 1)[:, None])
    votes[rng.random(votes.shape) < 0.2] = 0
    counts = collections.Counter(quality.coded(v) for v in votes.tolist())
    model = quality.fitted_labels(list(counts), list(counts.values()))
    assert abs(model.good - 0.7) < 0.03
    assert np.abs(model.answers[0, :, 1] - right).max() < 0.05 and np.abs(model.answers[1, :, 2] - right).max() < 0.05


def test_quality_sample_is_of_distinct_texts(spark, monkeypatch):
    monkeypatch.setattr(quality, "FIT_SAMPLE", 20)
    soft = []
    monkeypatch.setattr(quality, "fitted_scorer", lambda at, value, given: soft.extend(given))
    rows = [("",)] * 3000 + [("#$% " * (20 + k),) for k in range(30)] + [(f"This is the plain sentence number {k} of a good document.",) for k in range(100)]
    quality.trained(spark.createDataFrame(rows, "text string"))
    assert sum(p < 0.5 for p in soft) == 10 and sum(p >= 0.5 for p in soft) == 10


# --- 2: WARC -------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    big = "é" * 300_000
    rows = [(1, "u", "a"), (2, "u", "a"), (2, "u", "a"), (3, None, None), (4, "x y\n", ""), (5, "u", big), (None, "u", "a"), (9, "u", "b")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload_bytes string")
    archives, folder = warc.archived(pages)
    got = warc.read(archives, folder).collect()
    assert sorted(((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=str) == sorted(
        [(1, "revisit", 2, 1), (2, "response", None, 1), (2, "response", None, 1), (3, "revisit", 4, 0), (4, "response", None, 0), (5, "response", None, 600_000), (0, "response", None, 1), (9, "response", None, 1)],
        key=str,
    )
    for r in got:
        html = next(h or "" for p, _, h in rows if p == r.page_id)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert r.payload == (html.encode() if r.record_type == "response" else b"")


def test_warc_of_no_pages(spark):
    archives, folder = warc.archived(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read(archives, folder).count() == 0


def test_warc_least_bytes(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    archives, folder = warc.archived(pages, least_bytes=3)
    assert {r.page_id: r.refers_to for r in warc.read(archives, folder).collect()} == {1: None, 2: None, 3: 4, 4: None}


def archive(records, dictionary=b"", packed=False):
    import io

    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    encoder = zstandard.ZstdCompressor(dict_data=known) if known else zstandard.ZstdCompressor()
    lead = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
    return io.BytesIO(warc.opening(lead) + b"".join(map(encoder.compress, records)))


def test_warc_dictionaries_and_damage():
    import io

    import zstandard

    texts = [f"<html><p>{i} some words of a page {i * 7 % 11}</p></html>".encode() * 30 for i in range(60)]
    records = [warc.record(i, "http://a/b", t, len(t), warc.digest(t), None, False) for i, t in enumerate(texts)]
    dictionary = zstandard.train_dictionary(2048, records).as_bytes()
    for packed in (False, True):
        assert list(warc.records(archive(records, dictionary, packed))) == records
    assert list(warc.records(archive(records))) == records
    whole = archive(records, dictionary).getvalue()
    for bad in (whole[:-5], whole[8 + len(dictionary) :], whole[:3], whole[:20], whole + b"xy", whole + b"abcdefgh"):
        with pytest.raises(warc.Damaged):
            list(warc.records(io.BytesIO(bad)))
    good = records[0]
    header, http, payload = warc.parsed(good)
    assert header["WARC-Type"] == "response" and payload == texts[0] and int(http["Content-Length"]) == len(payload)
    for bad in (good[:-1], good.replace(b"WARC-Date", b"WARC-Dat"), good.replace(b"WARC/1.1", b"WARC/0.1", 1), good.replace(b"some", b"some more"), good.replace(b"sha1:", b"sha1:A"), good.replace(b"response\r\nWARC-Rec", b"revisit\r\nWARC-Rec")):
        with pytest.raises(warc.Damaged):
            warc.parsed(bad)


# --- 3: vectors ----------------------------------------------------------------------------


def brute_vectors(rows):
    sound = {}
    width = max((len(v) for _, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)), default=0)
    for k, (i, v) in enumerate(rows):
        if i is not None and v and len(v) == width and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            sound[k] = x / np.linalg.norm(x)
    pairs = [(a, b) for a in sound for b in sound if a < b and sound[a] @ sound[b] >= 0.9]
    n = collections.Counter(x for p in pairs for x in p)
    ids = groups_of({i for i, _ in rows if i is not None}, [(rows[a][0], rows[b][0]) for a, b in pairs])
    return sorted(((i, n[k], ids.get(i), i is None or ids[i] == i) for k, (i, _) in enumerate(rows)), key=str)


def test_vectors_against_all_pairs(spark, sf, monkeypatch):
    rows = [(r.vec_id, list(r.embedding)) for r in common.table(spark, sf, "embeddings").collect()]
    want = brute_vectors(rows)
    for size in (rabitq.LIST_VECTORS, 60):  # one list, and several with visitors
        monkeypatch.setattr(rabitq, "LIST_VECTORS", size)
        got = rabitq.near_duplicates(common.table(spark, sf, "embeddings")).collect()
        found, all_links = sum(r.n_links for r in got), sum(w[1] for w in want)
        assert 0.98 * all_links <= found <= all_links
        if size == rabitq.LIST_VECTORS == 1000:
            assert sorted((tuple(r) for r in got), key=str) == want


def test_vectors_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(rabitq, "CHUNK", 50)
    rng = np.random.default_rng(3)
    middle = rng.standard_normal(32)
    rows = [(i, (middle + rng.standard_normal(32) * 0.25 * rng.random()).tolist()) for i in range(150)] + [(i, rng.standard_normal(32).tolist()) for i in range(150, 250)]
    got = rabitq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_vectors(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, [1.0, 0.0]), (3, [2.0, 0.0]), (3, [1.0, 0.0]), (1, None), (2, []), (4, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 0.0]), (8, [None, 1.0]), (None, [1.0, 0.0]), (9, [1.0]), (10, [0.0, 1e-30]), (11, [0.0, 1e30])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, v int, id string")
    assert sorted((tuple(r) for r in rabitq.near_duplicates(frame).collect()), key=str) == brute_vectors(rows)
    assert rabitq.near_duplicates(frame.limit(0)).count() == 0


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(4)
    middle = rng.standard_normal(24)
    some = [(i, (middle + rng.standard_normal(24) * 0.2).tolist()) for i in range(40)]
    others = [(i, (middle[:16] + rng.standard_normal(16) * 0.2).tolist()) for i in range(40, 60)]
    odd = [(60, [*middle.tolist(), 1.0]), (61, [1.0] * 5000), (62, [1.0] * 4999 + [2.0])]
    got = sorted(tuple(r) for r in rabitq.near_duplicates(spark.createDataFrame(some + others + odd, "vec_id long, embedding array<double>")).collect())
    assert got == sorted(r for part in (some, others, odd[:1], odd[1:]) for r in brute_vectors(part))
    assert sum(r[1] for r in got[:40]) and sum(r[1] for r in got[40:60]) and [r[1:] for r in got[60:]] == [(0, 60, True), (1, 61, True), (1, 61, False)]


def test_estimate_is_unbiased():
    rng = np.random.default_rng(2)
    turn = rabitq.rotation(64)
    x = rabitq.units(rng.standard_normal((1, 64)))
    errors = []
    for seed in range(300):
        q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((64, 64)))
        own = x @ q
        code = np.where(own >= 0, 1, -1) / 8
        y = 0.8 * x + 0.6 * rabitq.units(rng.standard_normal((1, 64)))
        y = y / np.linalg.norm(y)
        errors.append(float((code @ (y @ q).T / (code * own).sum() - x @ y.T).item()))
    assert abs(np.mean(errors)) < 0.02 and np.allclose(turn @ turn.T, np.eye(64))


# --- 4: BPE --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoding():
    with open(queries.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_of_documents(spark, sf, documents, encoding):
    got = {r.doc_id: r for r in queries.byte_bpe(spark, sf).collect()}
    assert len(got) == len(documents)
    for d in documents:
        ids = encoding.encode_ordinary(d["text"] or "")
        r = got[d["doc_id"]]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_bpe_cuts_change_nothing(monkeypatch, encoding):
    monkeypatch.setattr(bpe, "PIECE", 7)
    monkeypatch.setattr(bpe, "BLANKS", 4)
    monkeypatch.setattr(bpe, "_RUN", regex.compile(r"\s{4,}+"))
    code = bpe.Codec(queries.RANKS, queries.PATTERN)
    texts = ["don't we'll  go\n\n\n\n\nnow", "a" * 50, "1a2b3c4d5e6f7g8h9i", "      x", "x      ", "     \n\n\n\n 's it", "I'm 42.5% sure!!! ok?  \t\t\t\t\t7", "été 中文字符 🙂🙂🙂🙂🙂 ok", "     x", "     ", "word " * 30, "''''''sss'''''ll", "á" * 20, "   　   7"]
    for t in texts:
        assert code.encode(t) == encoding.encode_ordinary(t), t
        assert code.decode(code.encode(t)) == t.encode()


def test_bpe_of_odd_texts(spark, encoding):
    texts = [None, "", " " * 1_500_000 + "x", "ab c" * 200_000, "q" * 150_000, "<|endoftext|>"]
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*texts, "a", "a"])], "doc_id long, text string, ids int")
    tokens = bpe.tokenized(rows, queries.RANKS, queries.PATTERN)
    back = {r.doc_id: bytes(r.decoded).decode() for r in bpe.decoded(tokens, queries.RANKS, queries.PATTERN).collect()}
    assert back == {i: t or "" for i, t in enumerate([*texts, "a", "a"])}
    ids = {r.doc_id: r.ids for r in tokens.collect()}
    assert ids[0] == ids[1] == [] and ids[3] == encoding.encode_ordinary(texts[3]) and ids[5] == encoding.encode_ordinary(texts[5])
    assert bpe.tokenized(rows.limit(0), queries.RANKS, queries.PATTERN).count() == 0


# --- 5: repeated passages ------------------------------------------------------------------


def plain_units(text):
    at, out = 0, []
    for m in re.finditer(r"[.!?]+\s+|\n+", text):
        out.append(text[at : m.end()])
        at = m.end()
    return [u for u in [*out, text[at:]] if u]


def brute_lines(docs):
    first = {}
    for i, t in docs:
        for u in plain_units(t or ""):
            k = " ".join(u.lower().split())
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, t in docs:
        seen, flags = set(), []
        for u in plain_units(t or ""):
            k = " ".join(u.lower().split())
            n = len(k.split())
            flags.append((u, n, None if n < 3 else first[k] < i or k in seen))
            seen.add(k)
        text, run = "", []

        def close(run):
            tail = []
            while run and run[-1][2] is None:
                tail.insert(0, run.pop())
            head = [] if sum(f[1] for f in run) >= 8 else run
            return "".join(f[0] for f in head + tail)

        for f in flags:
            if f[2] or (run and f[2] is None):
                run.append(f)
            else:
                text += close(run) + f[0]
                run = []
        out[i] = None if t is None else text + close(run)
    return out


def test_lines_of_documents(spark, sf, documents):
    got = {r.doc_id: r for r in queries.substring_dedup(spark, sf).collect()}
    want = brute_lines([(d["doc_id"], d["text"]) for d in documents])
    assert {i: r.text for i, r in got.items()} == want
    assert any(r.n_removed for r in got.values()) and not got[0].n_removed
    for d in documents:
        kept, at = "", 0
        for span in filter(None, got[d["doc_id"]].removed.split(",")):
            a, b = map(int, span.split("-"))
            kept, at = kept + d["text"][at:a], b
        assert kept + (d["text"] or "")[at:] == (want[d["doc_id"]] or "")


def test_lines_of_odd_texts(spark):
    passage = "One two three four. Five six.\nSeven eight nine ten eleven. "
    rows = [(1, "Alpha beta gamma delta. " + passage + "Own ending here now."), (2, passage.upper() + "Another thing is said here."), (3, passage), (3, passage), (None, passage), (None, "x"), (4, None), (5, ""), (6, "Stray one two. " * 3 + "tail of the text"), (7, "Own ending here now."), (8, "w " * 200_000)]
    frame = spark.createDataFrame([(*r, "k", 5, 7) for r in rows], "doc_id long, text string, doc string, removed int, n_chars int")
    got = sorted(((r._row.doc_id, r.clean) for r in lines.without_repeats(frame).collect()), key=str)
    assert got == sorted([(1, rows[0][1]), (2, "Another thing is said here."), (3, ""), (3, ""), (None, ""), (None, "x"), (4, None), (5, ""), (6, "Stray one two. " * 3 + "tail of the text"), (7, rows[9][1]), (8, rows[10][1])], key=str)
    kept = lines.deduplicated(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.n_chars) for r in kept.collect()) == [(0, 7), (1, 7), (2, 27), (4, 7), (5, 7), (6, 7), (7, 7), (8, 7)]
    assert lines.deduplicated(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    "passage",
    [
        "這是一段在許多文件中重複出現的文字，它沒有空白。第二句也在這裡結束！",
        "これは多くの文書に現れる文章です。二つ目の文もここで終わります。",
        "ข้อความนี้ปรากฏซ้ำในเอกสารหลายฉบับและไม่มีช่องว่างระหว่างคำเลย\n",
        "q83hfkT0" * 20 + "\n",
    ],
)
def test_lines_without_blanks(spark, passage):
    assert all(lines.units(passage)[2])
    rows = [(1, "Begin of one.\n" + passage + "独自の結び一。"), (2, "别的开头。" + passage + "End of two."), (3, "Two words\n" + passage)]
    got = {r._row.doc_id: r.clean for r in lines.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "别的开头。End of two.", 3: "Two words\n"}


@pytest.mark.parametrize("hot", [None, 7])
def test_lines_of_many_rows_of_one_id(spark, hot):
    shared = [f"This is the shared line number {k} of all." for k in range(400)]
    rows = [(0, "\n".join(shared))] + [(hot, f"A line that only row {k} has here.\n{shared[k]}\nAnd a last one {k} of it.") for k in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    # What is kept of a row is bounded by its own text, however many rows have its id.
    assert lines.repeats(frame).agg(F.count("*"), F.max(F.size("digests"))).first() == (400, 1)
    got = sorted(r.clean for r in lines.without_repeats(frame).where("_row.doc_id is null or _row.doc_id <> 0").collect())
    assert got == sorted(f"A line that only row {k} has here.\nAnd a last one {k} of it." for k in range(400))


# --- 6: fingerprints -----------------------------------------------------------------------


def plain_sketch(text):
    words = [w for w in re.split(r"[ \t\n\x0B\f\r]+", text.lower()) if w]
    found = set()
    for i in range(max(1, len(words) - 4) if words else 0):
        h = 42
        for w in words[i : i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        found.add(h >> 1)
    below = sorted(h for h in found if h < fracmin.BOUND)
    return below if len(below) >= fracmin.FLOOR else sorted(found)[: fracmin.FLOOR]


def test_fingerprints_of_documents(spark, sf, documents):
    got = {r.doc_id: r for r in queries.document_fingerprints(spark, sf).collect()}
    texts = [d["text"] or "" for d in documents]
    near = []
    for d, text, after in zip(documents, texts, texts[1:] + texts[:1], strict=True):
        r, m = got[d["doc_id"]], len(text) // 4
        edited = text[: len(text) - m] + after[:m]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{h:016x}" for h in plain_sketch(text))
        assert r.edited_fingerprint == "".join(f"{h:016x}" for h in plain_sketch(edited))
        a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (text.lower().split(), edited.lower().split()))
        near.append(abs(r.near_edited - len(a & b) / len(a | b)))
        assert 0 <= r.near_next <= 1
    assert np.mean(near) < 0.06


def test_fingerprints_of_odd_texts(spark):
    rows = [(2, None), (1, "a b"), (None, "x"), (3, "a b"), (3, "a b"), (9, "w " * 100_000), (4, "\U0001f642" * 9)]
    frame = spark.createDataFrame([(*r, "q", 1) for r in rows], "doc_id long, text string, sketch string, _bucket int")
    got = {(r.doc_id, r.text): r for r in fracmin.edited(frame).collect()}
    assert got[(None, "x")].edited == "x" and got[(1, "a b")].edited == "a b" and got[(2, "")].edited == ""
    assert got[(4, "\U0001f642" * 9)].edited == "\U0001f642" * 7 + "w "
    assert got[(9, "w " * 100_000)].edited == "w " * 75_000 + "x"
    assert fracmin.edited(frame.limit(0)).count() == 0
    one = fracmin.edited(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).first()
    assert one.edited == "abcdefab" and one.next_sketch == one.sketch


def test_sketches_merge_and_contain(spark):
    rng = np.random.default_rng(4)
    long = [f"w{i}" for i in rng.integers(0, 10**6, 20_000)]
    short = long[5_000:7_000]
    other = [f"v{i}" for i in rng.integers(0, 10**6, 8_000)]
    frame = spark.createDataFrame([(" ".join(long), " ".join(short), " ".join(other))], "l string, s string, o string")
    for c in "lso":
        frame = fracmin.with_sketch(frame, c, f"{c}_sketch")
    l, s, o = (F.col(f"{c}_sketch") for c in "lso")
    r = frame.select(fracmin.containment(s, l).alias("in"), fracmin.containment(l, s).alias("of"), fracmin.likeness(s, o).alias("none"), fracmin.merged(l, o).alias("both"), "l_sketch", "o_sketch").first()
    assert r["in"] == 1.0 and abs(r["of"] - 0.1) < 0.03 and r["none"] == 0
    assert r.both == sorted({*r.l_sketch, *r.o_sketch})


# --- 7: languages --------------------------------------------------------------------------


def test_languages_held_out(spark, sf, documents):
    got = {r.doc_id: r for r in queries.language_id(spark, sf).collect()}
    import zlib

    right = total = 0
    for d in documents:
        r = got[d["doc_id"]]
        assert r.held_out == (zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0) and 0 <= r.score <= 1
        if r.held_out and d["lang"]:
            total += 1
            right += r.lang_pred == d["lang"]
    assert total > 20 and right >= 0.97 * total
    assert sum(r.rejected for r in got.values()) <= 0.01 * len(got)


def test_languages_of_odd_texts(spark, sf):
    docs = common.table(spark, sf, "documents")
    model = langid.trained(docs)
    rows = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "123 !!", 1), (4, "the of and then with", 1), (4, "the of and then with", 1), (5, "der und nicht " * 100_000, 1)], "doc_id long, text string, score int")
    got = sorted((r.doc_id, r.lang_pred, r.rejected) for r in langid.identified(rows, model).collect())
    assert got == [(1, "und", True), (2, "und", True), (3, "und", True), (4, "en", False), (4, "en", False), (5, "de", False)]
    assert sorted(r.doc_id for r in langid.accepted(rows, model).collect()) == [4, 4, 5] and langid.accepted(rows, model).columns == rows.columns
    empty = langid.trained(docs.limit(0))
    assert {r.lang_pred for r in langid.identified(rows, empty).collect()} == {"und"}


def test_languages_of_many_copies(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_PER_LANGUAGE", 10)
    names = []
    monkeypatch.setattr(langid, "fitted", lambda given, at, share: names.extend(given))
    rows = [(f"text number {'abcdefghij'[k % 10]}{'klmn'[k // 10]}", "xx") for k in range(40)] * 200 + [(f"ein anderer Text {k}", "de") for k in range(30)]
    langid.trained(spark.createDataFrame(rows, "text string, lang string"))
    assert collections.Counter(names) == {"xx": 10, "de": 10}


# --- 8: mixing -----------------------------------------------------------------------------


def test_mix_hits_its_targets(spark, sf):
    got = queries.source_mix(spark, sf).join(common.table(spark, sf, "documents").select("doc_id", "source"), "doc_id").collect()
    by = collections.defaultdict(list)
    for r in got:
        assert r.taken <= 2 * r.size and r.taken in (0, r.size, 2 * r.size)
        by[r.source].append(r)
    assert abs(sum(rows[0].target for rows in by.values()) - 1.5 * sum(r.size for r in got)) < 1e-3
    for rows in by.values():
        assert rows[0].target <= 2 * rows[0].source_size == 2 * sum(r.size for r in rows)
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r.size for r in rows) / 2
    again = queries.source_mix(spark, sf).collect()
    assert sorted(map(tuple, again)) == sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got)


def test_mix_of_odd_rows(spark, monkeypatch):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, None, "s"), (3, "", None), (4, "x y z", None), (None, "p q", "t"), (5, "\x1c \x0b\x0c", "u"), (6, "w " * 100_000, "t")]
    frame = spark.createDataFrame([(*r, 9, 9) for r in rows], "doc_id long, text string, source string, size int, _key int")
    want = None
    for small in (common.SMALL_ROWS, 0):  # the table of sources broadcast, or salted
        monkeypatch.setattr(common, "SMALL_ROWS", small)
        mix = mixing.mixed(frame)
        got = sorted((r.doc_id or 0, r.size, r.source_size, r.target, r.taken) for r in mix.collect())
        assert [g[:3] for g in got] == [(0, 2, 100_002), (1, 3, 6), (1, 3, 6), (2, 0, 6), (3, 0, 2), (4, 2, 2), (5, 1, 1), (6, 100_000, 100_002)]
        assert want in (None, got)
        want = got
    copies = mixing.repeated(mix)
    assert copies.columns == frame.columns and copies.where("doc_id = 6").count() in (1, 2)
    assert mixing.mixed(frame.limit(0)).count() == 0


def test_mix_of_rows_without_id_hits_its_target(spark):
    rows = [(hot, f"some words of the row number {k}", source) for hot, source in ((None, "s"), (7, "t")) for k in range(200)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string")).select("_row.source", "size", "target", "taken").collect()
    for source in "st":
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= own[0].size / 2


# --- 9: licences ---------------------------------------------------------------------------


def brute_licenses(files):
    word = re.compile(r"[a-z]+(?:-[a-z]+)*|[0-9]+(?:\.[0-9]+)*")
    have = collections.defaultdict(set)
    for path, text in files:
        for part in re.split(r"\n|(?<=[.!?;])\s+", text or ""):
            part = re.sub(r"\s+", " ", part).strip(" ")
            if re.search(licenses.ANCHOR, part):
                have[path].add(part)
    n = collections.Counter(s for found in have.values() for s in found)
    df = collections.Counter()
    for s, k in n.items():
        for t in set(word.findall(s.lower())):
            df[t] += k

    def vector(text):
        tf = collections.Counter(word.findall(text.lower()))
        w = {t: c * (math.log((1 + sum(n.values())) / (1 + df[t])) + 1) for t, c in tf.items()}
        size = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / size for t, x in w.items()} if size else {}

    named = [(name, vector(t)) for name, t in licenses.TEMPLATES]
    best = {}
    for s in n:
        v = vector(s)
        scores = [(round(sum(x * t.get(k, 0) for k, x in v.items()), 9), name) for name, t in named]
        score, name = min(scores, key=lambda x: (-x[0], x[1]))
        if score >= licenses.COSINE:
            best[s] = (score, name)
    own = {p: min((best[s] for s in found if s in best), key=lambda x: (-x[0], x[1])) for p, found in have.items() if any(s in best for s in found)}
    heads = {}
    for p, (score, name) in own.items():
        if p is not None and re.search(licenses.LICENCE_FILE, p.split("/")[-1]):
            d = "/".join(p.lstrip("/").split("/")[:-1])
            heads[d] = min(heads.get(d, (0, "~", "")), (-score, p, name))
    out = set()
    for p in {p for p, _ in files}:
        if p in own:
            out.add((p, own[p][1], round(own[p][0], 6), "own", p))
            continue
        d = None if p is None else p.lstrip("/").split("/")[:-1]
        while d and "/".join(d) not in heads:
            d = d[:-1]
        head = heads.get("/".join(d)) if d is not None else None
        out.add((p, head[2], round(-head[0], 6), "inherited", head[1]) if head else (p, None, None, "none", None))
    return out


def test_licenses_of_documents(spark, sf):
    files = [(r.path, r.text) for r in queries.document_files(spark, sf).collect()]
    got = queries.license_scan(spark, sf).collect()
    assert len(got) == len(files)
    assert {(r.path, r.license, r.cosine, r.origin, r.named_by) for r in got} == brute_licenses(files)


def test_licenses_of_odd_files(spark):
    mit, apache = "Released under the MIT License.", "x\nLicensed under the Apache License, Version 2.0. More"
    files = [("LICENSE", mit), ("a/b/c.txt", "none"), ("a/COPYING", apache), ("a/COPYING-2", apache), ("/a/b/d", None), ("z", ""), ("a/e", mit), ("a/e", "This work is licensed under the GNU General Public License, version 3."), (None, "text"), ("q/r/LICENSE.md", "copyright of nobody"), ("q/r/s", "w " * 200_000), ("a", "t")]
    frame = spark.createDataFrame([(*f, 1, 2) for f in files], "path string, text string, license int, dir int")
    got = {(r.path, r.license, round(r.cosine, 6) if r.cosine else None, r.origin, r.named_by) for r in licenses.scanned(frame).collect()}
    assert got == brute_licenses(files)
    of = {g[0]: g[1] for g in got}
    assert of["a/b/c.txt"] == of["/a/b/d"] == "Apache-2.0" and of["z"] == of["q/r/s"] == of["a"] == "MIT" and of[None] is None
    assert licenses.scanned(frame.limit(0)).count() == 0


def test_licenses_of_whole_texts(spark):
    def wrapped(text, mark=""):
        return "".join(f"{mark}{x}\n" if x else mark.rstrip() + "\n" for p in text.split("\n") for x in textwrap.wrap(p, 76) or [""])

    whole = dict(reversed(licenses.standard_texts()))  # the whole texts come first, so they stay
    headers = {name: "\n\n".join(parts) for name, parts in licenses.HEADERS}
    files = [(f"whole/{n}/LICENSE", wrapped(t.replace("<year>", "2020").replace("<owner>", "A. Nobody"))) for n, t in whole.items()]
    files += [(f"whole/{n}/src/a.c", "int a;") for n in whole]
    files += [(f"head/{n}/{k}.c", "/*\n" + wrapped("Copyright (C) 2020 A. Nobody\n\n" + t, mark) + "*/\n\nint a;") for n, t in headers.items() for k, mark in enumerate((" * ", ""))]
    got = {r.path: r for r in licenses.scanned(spark.createDataFrame(files, "path string, text string")).collect()}
    assert {p: r.license for p, r in got.items()} == {p: p.split("/")[1] for p, _ in files}
    assert all(r.origin == ("inherited" if "/src/" in p else "own") for p, r in got.items())


# --- 10: SimHash ---------------------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_simhash(rows):
    points = {}
    for i, p in rows:
        points.setdefault(p, []).append(i)
    distinct = sorted(points)
    pairs = [(a, b) for k, a in enumerate(distinct) for b in distinct[k + 1 :] if (a ^ b).bit_count() <= 3]
    of = groups_of(distinct, pairs)
    least = {}
    for p, root in of.items():
        ids = [i for i in points[p] if i is not None]
        if ids:
            least[root] = min(least.get(root, min(ids)), min(ids))
    return {p: least.get(root) for p, root in of.items()}


def test_simhash_of_documents(spark, sf, documents):
    got = {r.doc_id: r for r in queries.simhash_near_dedup(spark, sf).collect()}
    rows = [(d["doc_id"], plain_fingerprint(d["text"])) for d in documents]
    of = brute_simhash(rows)
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{p:016x}", of[p]) for i, p in rows}
    assert any(r.component_id != i for i, r in got.items())


@pytest.mark.parametrize("spread", [2, 6, 64])
def test_simhash_tree_loses_no_link(spark, monkeypatch, spread):
    monkeypatch.setattr(simhash, "SHARD_POINTS", 100)
    monkeypatch.setattr(simhash, "BLOCK_POINTS", 20)
    rng = np.random.default_rng(spread)
    middles = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    points = set()
    while len(points) < 700:
        p = int(rng.choice(middles))
        for b in rng.integers(0, 64, rng.integers(0, spread + 1)):
            p ^= 1 << int(b)
        points.add(p)
    points = sorted(points)
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in points], "fp long")
    edges = simhash.links(Workspace(spark, "t"), frame).collect()
    pairs = [(int(np.int64(r.a).view(np.uint64)), int(np.int64(r.b).view(np.uint64))) for r in edges]
    brute = [(a, b) for k, a in enumerate(points) for b in points[k + 1 :] if (a ^ b).bit_count() <= 3]
    assert groups_of(points, pairs) == groups_of(points, brute)


def test_simhash_of_odd_rows(spark):
    rows = [(3, None), (1, ""), (2, " \n"), (5, "a b c d"), (5, "a b c d"), (4, "A B C D"), (None, "a b c d"), (None, "q r s t u"), (None, "q r s t u"), (7, "x " * 300_000), (8, "x y")]
    frame = spark.createDataFrame([(*r, "f", 0) for r in rows], "doc_id long, text string, fp string, component_id int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(frame).collect()), key=str)
    assert got == sorted([(3, 1), (1, 1), (2, 1), (5, 4), (5, 4), (4, 4), (None, 4), (None, None), (None, None), (7, 7), (8, 8)], key=str)
    kept = simhash.deduplicated(frame)
    assert kept.columns == frame.columns and sorted((str(r.doc_id) for r in kept.collect())) == ["1", "4", "7", "8", "None"]
    assert simhash.near_duplicates(frame.limit(0)).count() == 0 and simhash.deduplicated(frame.limit(0)).count() == 0
