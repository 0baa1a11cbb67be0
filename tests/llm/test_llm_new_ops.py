"""Operators 11 to 13 against plain versions, on whole tables and on odd rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from lodestone.llm import audit, common, fracmin, pieces, queries, resampling, simhash
from lodestone.session import Workspace

SPACE = r"[^\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- 11: importance resampling ---------------------------------------------------------------


def brute_importance(rows, target, runs=1, buckets=10_000, seed=2024, least=20, percent=10):
    def features(text):
        words = re.findall(WORD, lowered(text))
        return words, [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, runs + 1) for i in range(len(words) - n + 1)]

    s = collections.Counter(b for _, t in rows for b in features(t)[1])
    t = collections.Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        words, found = features(text)
        weight = sum(gain[b] for b in found)
        h = int(sha(f"{seed}:{'null' if i is None else i}")[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=str)


def plain_rows(frame):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in frame.collect()), key=str)


def test_importance_of_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in common.table(spark, sf, "documents").collect()]
    target = [r.text for r in common.table(spark, sf, "benchmark").collect()]
    assert plain_rows(queries.importance_resampling(spark, sf)) == brute_importance(rows, target)


@pytest.mark.parametrize("runs", [1, 2, 3])
def test_importance_of_odd_rows(spark, monkeypatch, runs):
    monkeypatch.setattr(resampling, "PIECE", 50)
    monkeypatch.setattr(resampling, "REMEMBERED", 7)
    rng = random.Random(runs)
    words = ["Alpha", "beta", "ΓΑΜΜΑ", "été", "x1", "漢字", "z" * 70]
    rows = [(i, " -\x00".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(40)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (None, rows[6][1]), (None, None), (90, None), (91, ""), (92, "!?"), (93, "alpha " * 5_000), (94, rows[7][1])]
    target = ["alpha beta", None, "", "été x1 X1"]
    rule = resampling.Rule(runs, 97, 7, 5, 35)
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, rank int, _row int, buckets string")
    goals = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.importance(docs, goals, rule)
    assert plain_rows(found) == brute_importance(rows, target, runs, 97, 7, 5, 35)
    assert plain_rows(resampling.importance(docs, goals.limit(0), rule)) == brute_importance(rows, [], runs, 97, 7, 5, 35)
    assert resampling.importance(docs.limit(0), goals, rule).count() == 0
    drawn = resampling.resampled(docs, goals, rule)
    assert drawn.columns == docs.columns
    assert {(r.doc_id, r.text) for r in drawn.collect()} == {(r.doc_id, t) for r in found.where("rank IS NOT NULL").collect() for i, t in rows if i == r.doc_id and (i is not None or t == rows[6][1])}


def test_ranks_without_ties_are_whole(spark):
    docs = spark.createDataFrame([(i, "one two three") for i in range(5_000)], "doc_id long, text string").repartition(37)
    found = resampling.importance(docs, docs.limit(1), resampling.Rule(least_words=3, percent=50)).collect()
    drawn = sorted((r["rank"], -r.score, r.doc_id) for r in found if r["rank"])
    assert [r[0] for r in drawn] == list(range(1, 2_501))
    assert [r[1:] for r in drawn] == sorted((-r.score, r.doc_id) for r in found)[:2_500]


# --- 12: SentencePiece ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


def test_sentencepiece_of_documents(spark, sf, library):
    rows = common.table(spark, sf, "documents").collect()
    got = {r.doc_id: r for r in queries.sentencepiece(spark, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "")
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert got[r.doc_id].decoded_sha256 == sha(library.decode(ids))


ODD = [
    None, "", " ", "   ", "a", " a", "  a  b ", "a\n\tb", "▁", "▁▁x ▁", "é漢字 　ﬁ①\x00​", "x" * 50_000, " " * 3_000, "no-blank-" * 3_000,
    "the of and " * 20_000, "<s> </s> <unk> <0x0A>", "😀 👩‍👩‍👧 a", "1234567 89", " x y", "é",
]


def test_sentencepiece_of_odd_rows(spark, monkeypatch, library):
    monkeypatch.setattr(pieces, "TABLE_WORDS", 5)
    monkeypatch.setattr(pieces, "GROUP_WORDS", 9)
    rng = random.Random(1)
    texts = [*ODD, *["".join(rng.choices("ab ▁é\n漢😀.", k=rng.randint(1, 40))) for _ in range(300)]]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "a b", 1, None), (None, "a b", 1, None), (1, "b", 2, "y"), (1, "b", 2, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block int, word string")
    outputs = ("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256")
    got = pieces.tokenized(docs, queries.PIECES, outputs, ("doc_id", "block", "word"))
    assert got.columns == ["doc_id", "block", "word", *outputs]
    want = []
    for i, t, b, w in rows:
        ids = library.encode(t or "")
        back = library.decode(ids) if ids else ""
        want.append((i, b, w, tuple(ids), len(ids), sha(",".join(map(str, ids))), back, sha(back)))
    assert collections.Counter((*r[:3], tuple(r.ids), *r[4:]) for r in got.collect()) == collections.Counter(want)
    assert pieces.tokenized(docs.limit(0), queries.PIECES).count() == 0


def test_each_word_is_segmented_once(library, monkeypatch):
    code = pieces.codec(queries.PIECES)
    seen = []
    monkeypatch.setattr(code, "segmented", lambda words, own=code.segmented: seen.extend(words) or own(words))
    table = pieces.Table(code)
    for text in ("a b a", "b  c", "a b c  c "):
        table.learn([code.words(text), code.words(text)])
        assert table.of(code.words(text)) == ",".join(map(str, library.encode(text)))
    assert sorted(seen) == sorted(set(seen)) == ["▁", "▁a", "▁b", "▁c", "▁▁c"]


# --- 13: filter audit ----------------------------------------------------------------------


def brute_audit(docs, labels):
    rows = [(i, t or "", "" if s is None else s) for i, t, s in docs]
    lowest = {}
    for i, t, _ in rows:
        if i is not None:
            lowest[t] = min(lowest.get(t, i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}

    def failed(i, t):
        words = re.findall(SPACE, t)
        tests = (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search("[#$%&*|]", t)), i is not None and i > lowest[t])
        return {f for f, x in zip("ABCDE", tests, strict=True) if x}

    out, shapley = {}, collections.Counter()
    marked = [(p, failed(i, t), i in good, i in toxic) for i, t, p in rows]
    for part in {p for p, *_ in marked}:
        own = [m[1:] for m in marked if m[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [m for m in left if f in m[0]]
                left = [m for m in left if f not in m[0]]
                redundant = sum(f in m[0] for m in own) - len(gone)
                out[part, "".join(order), k + 1] = [len(left), len(gone), redundant, sum(m[0] == {f} for m in own), sum(m[1] for m in gone), sum(m[2] for m in gone)]
                shapley[part, f] += len(gone)
    return {key: (*v, shapley[key[0], key[1][key[2] - 1]]) for key, v in out.items()}


def audited(frame):
    rows = frame.collect()
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(got) == len(rows)
    return got


def test_audit_of_documents(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in common.table(spark, sf, "documents").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in common.table(spark, sf, "labels").collect()]
    assert audited(queries.filter_audit(spark, sf)) == brute_audit(docs, labels)


def test_audit_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(audit, "HELD_PARTS", 1)
    rng = random.Random(3)
    made = [" ".join(rng.choices(["a", "B", "c#", "déjà", "D" * 9, *map(str, range(40))], k=rng.randint(0, 90))) for _ in range(60)]
    rows = [(i, rng.choice(made), rng.choice(["s", "t", None, ""])) for i in range(200)]
    rows += [(7, made[0], "s"), (7, made[0], "s"), (None, made[1], "s"), (None, made[1], "u"), (None, None, None), (300, None, "s"), (301, "", "s"), (-5, made[2], "t"), (302, "word " * 100_000, "t"), (303, "\x0b\x0c \xa0", "v")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 220, 2)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1), (8, 1, 1), (8, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "x", 0) for r in rows], "doc_id long, text string, source string, part int, digest string, good int")
    marks = spark.createDataFrame([(*r, "z") for r in labels], "doc_id long, quality int, toxic int, lowest string")
    assert audited(audit.interactions(docs, marks)) == brute_audit(rows, labels)
    assert audited(audit.interactions(docs, marks.limit(0))) == brute_audit(rows, [])
    assert audit.interactions(docs.limit(0), marks).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 31, 1_000, 12_345])
def test_popcounts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    assert audit.survivors(words).tolist() == [int(np.count_nonzero(words >> np.uint32(b) & 1)) for b in range(32)]


# --- 9: ids of the licence query ---------------------------------------------------------------


def test_license_query_keeps_every_row_and_id(spark):
    mit, plain = "Released under the MIT License.", "nothing to see"
    rows = [(None, mit, "web"), (None, plain, "web"), (None, plain, "web2"), (None, None, "src0"), (None, plain, "src1"), (-7, mit, "src0"), (7, plain, "src0")]
    rows += [(0, mit, "web2"), (20, plain, "web2"), (20, plain, "web2"), (20, plain, "web2"), (3, plain, None), (3, plain, "")]
    docs = spark.createDataFrame([(*r, "p", 1) for r in rows], "doc_id long, text string, source string, path string, license int")
    got = [(r.doc_id, r.license, r.origin) for r in queries.licensed(docs).collect()]
    want = [(None, "MIT", "own"), (None, None, "none"), (None, None, "none"), (None, None, "none"), (None, None, "none"), (-7, "MIT", "own"), (7, "MIT", "inherited")]
    # Documents 0 and -7 are licence files with a licence; those of their directories inherit from them.
    want += [(0, "MIT", "own"), *[(20, "MIT", "inherited")] * 3, (3, None, "none"), (3, None, "none")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert queries.licensed(docs.limit(0)).count() == 0


# --- 10: copies that are 0.8 alike -------------------------------------------------------------


def plain_shingles(text):
    words = re.findall(SPACE, lowered(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_pairs(rows, least=0.8):
    """All pairs of ids whose 5-word shingles have a Jaccard similarity of at least ``least``."""
    sets = [(i, plain_shingles(t)) for i, t in rows]
    out = []
    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            low, high = sorted((len(a), len(b)))
            if low >= least * high and (high == 0 or len(a & b) >= least * len(a | b)):
                out.append((i, j))
    return out


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def test_copies_are_found_and_others_left(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3_000)]
    rows = []
    for group in range(60):
        base = rng.choices(vocabulary, k=rng.randint(100, 400))
        rows += [" ".join(edited(rng, base, max(1, len(base) // 130))) for _ in range(4)]
        rows.append(" ".join(rng.sample(base, len(base))))  # the same words in another order
    rows = list(enumerate(rows))
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    pairs = near_pairs(rows)
    joined = sum(got[a] == got[b] for a, b in pairs)
    assert len(pairs) > 150 and joined >= 0.9 * len(pairs)
    # No group holds what the links don't join.
    from .test_llm_ops import groups_of

    whole = groups_of([i for i, _ in rows], pairs)
    assert all(whole[i] == whole[c] for i, c in got.items())


def test_partners_are_links():
    rng = np.random.default_rng(4)
    points = np.unique(np.concatenate([rng.integers(0, 1 << 63, 20, dtype=np.uint64)] * 30) ^ (np.uint64(1) << rng.integers(0, 63, 600, dtype=np.uint64)))
    a, b = simhash.partners(points, simhash.compared(points, points[:0]))
    assert (np.bitwise_count(a ^ b) <= 3).all() and len(a) <= 2 * len(points)
    linked = {int(p) for p in points if (np.bitwise_count(points ^ p) <= 3).sum() > 1}
    assert {int(x) for x in np.concatenate((a, b))} == linked


def test_copies_of_odd_rows(spark):
    long = "x y z " * 50_000
    rows = [(3, None), (1, ""), (2, " \n"), (5, "a b c d e f g"), (5, "a b c d e f g"), (4, "A B  C D E F G"), (None, "a b c d e f g"), (None, "q r s t u"), (None, "q r s t u"), (7, long), (8, "x y"), (9, long + "x"), (10, "a b c d e f h")]
    frame = spark.createDataFrame([(*r, "f", 0) for r in rows], "doc_id long, text string, fps string, component_id int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_copies(frame).collect()), key=str)
    want = [(3, 1), (1, 1), (2, 1), (5, 4), (5, 4), (4, 4), (None, 4), (None, None), (None, None), (7, 7), (9, 7), (8, 8), (10, 10)]
    assert got == sorted(want, key=str)
    kept = simhash.without_copies(frame)
    assert kept.columns == frame.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "10", "4", "7", "8", "None"]
    assert simhash.near_copies(frame.limit(0)).count() == 0 and simhash.without_copies(frame.limit(0)).count() == 0


# --- crowded keys ----------------------------------------------------------------------------


def test_shards_in_chunks(spark, monkeypatch):
    """Chunks of a shard find the links that one task, and all pairs, find."""
    rng = np.random.default_rng(8)
    middles = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    points = {int(m) for m in middles}
    for m in middles:
        points |= {int(m ^ sum(np.uint64(1) << np.uint64(b) for b in rng.choice(64, k, replace=False))) for k in (1, 2, 3, 4, 5) for _ in range(4)}
    points = np.array(sorted(points), np.uint64)
    a, b = np.nonzero(np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= simhash.RADIUS, 1))
    want = simhash.forest(points, [(points[a], points[b])])
    frame = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    for least in (simhash.TASK_POINTS, 300):
        monkeypatch.setattr(simhash, "TASK_POINTS", least)
        monkeypatch.setattr(simhash, "SHARD_POINTS", 400)
        edges = simhash.links(Workspace(spark, "t"), frame).collect()
        found = [np.array([r[c] for r in edges], np.int64).view(np.uint64) for c in "ab"]
        got = simhash.forest(points, [(found[0], found[1])])
        assert all(np.array_equal(x, y) for x, y in zip(got, want, strict=True))


def test_chunks_meet_each_pair(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_POINTS", 50)  # the vantage points of a task part homes from those of other chunks
    rng = np.random.default_rng(9)
    points = np.unique(rng.integers(0, 1 << 14, 900, dtype=np.uint64))
    homes, visitors = points[::2], points[1::2]
    sides = {(c, v): p[p % 2 == c] for v, p in ((False, homes), (True, visitors)) for c in (0, 1)}
    met = [p for low, high in ((0, 0), (0, 1), (1, 1)) for p in simhash.met(sides, low, high)]
    got = sorted((min(x, y), max(x, y)) for a, b in met for x, y in zip(a.tolist(), b.tolist(), strict=True))
    own = set(homes.tolist())
    want = [(x, y) for i, x in enumerate(points.tolist()) for y in points.tolist()[i + 1 :] if (x in own or y in own) and (x ^ y).bit_count() <= simhash.RADIUS]
    assert got == want


def test_fingerprints_of_one_id(spark, monkeypatch):
    """Most rows share an id, or have none, with texts alike and unlike: still in order, and in no bucket together."""
    monkeypatch.setattr(fracmin, "REPEATED_ROWS", 500)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    rows = [(7, f"text {i} of seven") for i in range(3_000)] + [(7, "the same")] * 3_000 + [(None, "")] * 2_000 + [(None, f"no id {i}") for i in range(500)]
    rows += [(i, f"text of {i}") for i in range(-400, 400) if i != 7]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, "text").cache()
    buckets = fracmin.in_buckets(frame.withColumn("_tie", F.xxhash64("text")))
    assert max(r["count"] for r in buckets.groupBy("_bucket", "_spread").count().collect()) < 3 * len(rows) // 16
    key = {r.text: r.k for r in frame.select("text", F.xxhash64("text").alias("k")).distinct().collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, key[r[1]]))
    want = [(i, t, t[: len(t) - len(t) // 4] + after[: len(t) // 4]) for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True)]
    got = [(r.doc_id, r.text, r.edited) for r in fracmin.edited(frame).select("doc_id", "text", "edited").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    frame.unpersist()
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_copies_beside_a_smaller_text_of_the_same_words(spark):
    """Texts of the same words share all fingerprints; each order of them is a group, whichever text is the smallest."""
    words = [f"w{i}" for i in range(100)]
    rows = []
    for family in range(6):
        random.Random(family).shuffle(words)
        rows += [(2 * family, " ".join(words)), (2 * family + 1, " ".join([*words[:-2], words[-1], words[-2]]))]
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(12)}


def test_links_between_names(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    points = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << np.uint64(b)) for b in range(4)]]))
    names = {int(p): int(i % 7) for i, p in enumerate(points.view(np.int64))}
    want = {(a, b) for a in names for b in names if a < b and (a ^ b).bit_count() <= 3 and names[a] != names[b]}
    frame = spark.createDataFrame([(v, fp, n) for v in (0, 1) for fp, n in names.items()], "view int, fp long, name long")
    for per_task in (1 << 20, 16):
        monkeypatch.setattr(simhash, "TASK_POINTS", per_task)
        got = [(r.view, min(r.a, r.b), max(r.a, r.b)) for r in simhash.links(Workspace(spark, "t"), frame).collect()]
        assert sorted(got) == sorted((v, *p) for v in (0, 1) for p in want)


def test_rest_is_compared_where_texts_meet(spark, monkeypatch):
    """Unlike texts of the same words: all pairs are within reach, only links leave the tasks, with chunks or without."""
    words = [f"w{i}" for i in range(120)]
    rng = random.Random(11)
    rows = []
    for family in range(40):
        rng.shuffle(words)
        rows += [(2 * family, " ".join(words)), (2 * family + 1, " ".join([*words[:-2], words[-1], words[-2]]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for part in (simhash.PART_BYTES, 1 << 13):
        monkeypatch.setattr(simhash, "PART_BYTES", part)
        made, keep = [], Workspace.table

        def table(self, name, df, by=None):
            made.append(keep(self, name, df, by))
            return made[-1]

        with monkeypatch.context() as m:
            m.setattr(Workspace, "table", table)
            got = {r.doc_id: r.component_id for r in simhash.near_copies(frame).collect()}
        assert got == {i: i - i % 2 for i in range(80)}
        # 80 texts of one fingerprint in each view: 3,160 pairs in each, of which none is a row.
        assert max(t.count() for t in made) <= simhash.VIEWS * len(rows)


def test_copies_join_names():
    rng = np.random.default_rng(12)
    base = [np.unique(rng.integers(0, 1 << 63, 60, dtype=np.uint64)) for _ in range(12)]
    sets = [np.unique(np.concatenate((b[k:], rng.integers(0, 1 << 63, k, dtype=np.uint64)))) for b in base for k in (0, 3, 5, 9, 20)] + [base[0][:0]] * 2
    points = rng.integers(0, 4, len(sets), dtype=np.uint64)
    names = np.arange(len(sets)) // 2
    places = np.arange(len(sets))

    def groups(pairs):
        label = {int(n): int(n) for n in names}
        for a, b in pairs:
            x, y = sorted((label[int(names[a])], label[int(names[b])]))
            label = {k: x if v == y else v for k, v in label.items()}
        return label

    want = [(a, b) for a in range(len(sets)) for b in range(a) if int(points[a] ^ points[b]).bit_count() <= 1 and simhash.alike(sets[a], sets[b]) >= 0.8]
    for meets in ([(places, places)], [(places[::2], places[1::2]), *[(p, p) for p in (places[::2], places[1::2])]]):
        got = simhash.copies(points, names, sets, meets, 1, 0.8)
        assert set(got) <= {*want, *[(b, a) for a, b in want]} and groups(got) == groups(want) and len(got) == len(set(groups([]).values())) - len(set(groups(want).values()))


def test_few_points_are_compared(monkeypatch):
    """Of unlike points only those that share a block of bits meet; crowded ones, which all do, are parted by vantage points."""
    rng = np.random.default_rng(13)
    middles = rng.integers(0, 1 << 63, 6_000, dtype=np.uint64)
    points = np.unique(np.concatenate((middles, middles[:500] ^ (np.uint64(7) << rng.integers(0, 61, 500, dtype=np.uint64)))))
    asked, count = [], np.bitwise_count
    with monkeypatch.context() as m:
        m.setattr(np, "bitwise_count", lambda x: asked.append(x.size) or count(x))
        found = [p for a, b in simhash.compared(points[::2], points[1::2]) for p in zip(a.tolist(), b.tolist(), strict=True)]
    assert sum(asked) < len(points) ** 2 // 100
    own = set(points[::2].tolist())
    r, c = np.nonzero(np.triu(count(points[:, None] ^ points[None, :]) <= simhash.RADIUS, 1))
    want = [p for p in zip(points[r].tolist(), points[c].tolist(), strict=True) if own & set(p)]
    assert len(want) > 100 and sorted(tuple(sorted(p)) for p in found) == want
    for reach in (0, 1, 5, 64):
        few = np.unique(rng.integers(0, 1 << 10, 60, dtype=np.uint64))
        got = sorted(tuple(sorted(p)) for a, b in simhash.compared(few, few[:0], reach) for p in zip(a.tolist(), b.tolist(), strict=True))
        assert got == [(x, y) for i, x in enumerate(few.tolist()) for y in few.tolist()[i + 1 :] if (x ^ y).bit_count() <= reach]


def test_many_shards_are_not_cut(spark, monkeypatch):
    """Texts travel once for each chunk of their shard: where the shards are as many as the tasks, none is cut."""
    words = [f"w{i}" for i in range(120)]
    rng = random.Random(14)
    rows = []
    for family in range(40):
        rng.shuffle(words)
        rows += [(2 * family, " ".join(words)), (2 * family + 1, " ".join([*words[:-2], words[-1], words[-2]]))]
    monkeypatch.setattr(simhash, "PART_BYTES", 1 << 10)
    cells, dealt = [], simhash._dealt
    monkeypatch.setattr(simhash, "_dealt", lambda df: cells.append(df) or dealt(df))
    monkeypatch.setattr(simhash, "_tasks", lambda spark: 8)
    simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).count()
    # A shard in each view: two chunks at most, as eight tasks have work then.
    assert cells[-1].groupBy("view", "key").count().agg(F.max("count")).first()[0] <= 2
