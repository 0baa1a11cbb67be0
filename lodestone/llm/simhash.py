"""SimHash near-duplicates, found through a vantage-point tree.

A fingerprint has 64 bits, each the majority of that bit over the hashes of the
text's 3-word shingles. Equal fingerprints collapse first, so groups of exact copies,
of any size, are one point. A vantage-point tree splits the distinct fingerprints by
Hamming distance to vantage points (``d <= median`` is inside). Its upper levels, built
from a bounded sample, are the shards. Every point has one home shard; it also visits a
shard that a partner at ``RADIUS`` or less may call home, by the triangle bound at each
vantage point. Of a pair that is parted at some vantage point, only the outer point
crosses over, so a pair meets in exactly one shard. In the shard's task, of two points within
``RADIUS`` bits one of ``RADIUS + 1`` blocks of bits is equal, so only points that share a block are
compared. Where so many do that this saves little, the task goes on splitting by vantage points
and compares the small rests bit by bit; all of it is exact. A shard of more than
``TASK_POINTS`` points, visitors included, is cut into chunks, and each pair of chunks is
a task of its own, so a task holds about that many at most, however the tree parts the points.

A shard returns a spanning forest of its links, never the pairs of a group, and
connected components are found on these edges.

``near_copies`` uses the same tree to find texts whose 5-word shingles are 0.8 alike. Such
texts differ in up to 13 bits of a fingerprint of their shingles, too far for a tree, but in
about 4 bits of one of their distinct words. Each text has several such fingerprints, of
independent hashes; a pair within ``RADIUS`` in one of them is a candidate, and the Jaccard
similarity of the shingles decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import common
from lodestone.session import Workspace

RADIUS = 3
SHINGLE = 3
SEED = 42
# Fingerprints of a text's distinct words, the shingles that decide, and how alike they have to be.
VIEWS = 8
COPY_SHINGLE = 5
COPY_LEAST = 0.8
# The tree's upper levels are built from this many distinct fingerprints at most; every fingerprint is routed.
TREE_SAMPLE = 20_000
# Home points that a shard should have, those of a shard whose texts are compared, and at which a task stops splitting.
SHARD_POINTS = 1 << 16
CROWD_POINTS = 16_000
BLOCK_POINTS = 4_096
# Points that share a block are compared, if they are fewer than one in so many of all pairs; so many pairs at once.
BLOCKS_SAVE = 16
BLOCK_PAIRS = 1 << 20
# Points, with visitors, that one task holds; a larger shard is cut into chunks that meet in pairs.
TASK_POINTS = 1 << 20
# Rows of the distance matrix made at once.
STRIPE = 256
# Bytes of sets (each counted as COPY_BYTES at least) that a task comparing texts holds. Less than that is
# still cut, from PART_BYTES on and into MOST_PARTS at most, so that the pairs of a large group are many tasks.
TASK_BYTES = 1 << 25
COPY_BYTES = 1 << 10
PART_BYTES = 1 << 21
MOST_PARTS = 8


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one whole text; null and no words give 0."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and the blanks x20 x09-x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[len(words) - n :].tolist(), strict=True)
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``_text_key`` and the fingerprint as a signed long, one row per document."""
    rows = docs.select("doc_id", common.text_key(text).alias("_text_key"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("_text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_text_key"), pa.array(points.view(np.int64))], ["doc_id", "_text_key", "fp"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, _text_key long, fp long")


def vantage(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """The vantage point, of a few, that splits ``points`` most evenly, and its inner radius; None if none splits."""
    best, found = 0, None
    for at in points[:: max(1, len(points) // 8)][:8]:
        far = np.bitwise_count(points ^ at)
        radius = int(np.sort(far)[(len(far) - 1) // 2])
        for r in (radius - 1, radius):
            inner = int(np.count_nonzero(far <= r))
            if min(inner, len(far) - inner) > best:
                best, found = min(inner, len(far) - inner), (at, r)
    return found


def grown(sample: np.ndarray, depth: int) -> dict[int, tuple[np.uint64, int]]:
    """Vantage points of the upper levels, by heap number: node k has the children 2k (inside) and 2k + 1."""
    tree, level = {}, {1: sample}
    for _ in range(depth):
        below = {}
        for node, points in level.items():
            if len(points) > 1 and (split := vantage(points)):
                tree[node] = split
                inside = np.bitwise_count(points ^ split[0]) <= split[1]
                below |= {2 * node: points[inside], 2 * node + 1: points[~inside]}
        level = below
    return tree


def routed(points: np.ndarray, tree: dict, node: int = 1, visits: bool = False, reach: int = RADIUS) -> Iterator[tuple[int, bool, np.ndarray]]:
    """(shard, whether they visit it, points) for every shard that one of the points has to be in."""
    if not len(points):
        return
    if node not in tree:
        yield node, visits, points
        return
    at, radius = tree[node]
    far = np.bitwise_count(points ^ at).astype(np.int64)
    if visits:
        yield from routed(points[far <= radius + reach], tree, 2 * node, True, reach)
        yield from routed(points[far > radius - reach], tree, 2 * node + 1, True, reach)
    else:
        inside = far <= radius
        yield from routed(points[inside], tree, 2 * node, False, reach)
        yield from routed(points[~inside], tree, 2 * node + 1, False, reach)
        yield from routed(points[~inside & (far <= radius + reach)], tree, 2 * node, True, reach)


def blocks(reach: int) -> list[tuple[np.uint64, np.uint64]]:
    """(shift, mask) of the ``reach`` + 1 blocks that 64 bits are cut into: two points within reach are equal in one of them."""
    cuts = [64 * i // (reach + 1) for i in range(reach + 2)]
    return [(np.uint64(a), np.uint64((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:], strict=False)]


def sharing(homes: np.ndarray, others: np.ndarray, reach: int, each_once: bool) -> Iterator[tuple[np.ndarray, np.ndarray]] | None:
    """Linked pairs, in parts, of points that share a block; None if too many do. ``each_once``: both sides are the same points."""
    of, most = [], len(homes) * len(others) // BLOCKS_SAVE
    for shift, mask in blocks(reach):
        mine, theirs = homes >> shift & mask, others >> shift & mask
        order = np.argsort(theirs, kind="stable")
        low, high = (np.searchsorted(theirs[order], mine, side) for side in ("left", "right"))
        most -= int((high - low).sum())
        if most < 0:
            return None
        of.append([x.astype(np.int32) for x in (order, low, high - low)])

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at, (order, low, n) in enumerate(of):
            upto = np.cumsum(n)
            begin = 0
            while begin < len(n):  # as many home points as have so many pairs, one at least
                end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + BLOCK_PAIRS, "right")))
                here = n[begin:end]
                r = np.repeat(np.arange(begin, end), here)
                c = order[np.arange(len(r)) - np.repeat(np.cumsum(here) - here, here) + np.repeat(low[begin:end], here)]
                keep = r < c if each_once else np.ones(len(r), bool)
                begin = end
                apart = homes[r] ^ others[c]
                keep &= np.bitwise_count(apart) <= reach
                for shift, mask in blocks(reach)[:at]:  # a pair that shares several blocks counts in the first
                    keep &= (apart >> shift & mask) != 0
                if keep.any():
                    yield homes[r[keep]], others[c[keep]]

    return pairs()


def compared(homes: np.ndarray, visitors: np.ndarray, reach: int = RADIUS, own: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs, in parts: of home points with each other (if ``own``), and with visitors."""
    sides = ((homes, True), (visitors, False))[0 if own else 1 :]
    found = [sharing(homes, others, reach, each_once) for others, each_once in sides] if reach < 64 else [None]
    if all(f is not None for f in found):
        for f in found:
            yield from f
        return
    split = vantage(homes) if len(homes) > BLOCK_POINTS else None
    if split:
        tree = {1: split}
        at = {2: [], 3: []}
        calls = {2: [], 3: []}
        for node, visits, points in routed(homes, tree, reach=reach):
            if own or not visits:
                (calls if visits else at)[node].append(points)
        for node, _, points in routed(visitors, tree, visits=True, reach=reach):
            calls[node].append(points)
        none = homes[:0]
        for node in (2, 3):
            yield from compared(np.concatenate([none, *at[node]]), np.concatenate([none, *calls[node]]), reach, own)
        return
    for i in range(0, len(homes), STRIPE):
        rows = homes[i : i + STRIPE]
        for others, each_once in ((homes[i:], True), (visitors, False))[0 if own else 1 :]:
            for j in range(0, len(others), 1 << 14):
                part = others[j : j + (1 << 14)]
                r, c = np.nonzero(np.bitwise_count(rows[:, None] ^ part[None, :]) <= reach)
                keep = r < c + j if each_once else slice(None)
                if len(r[keep]):
                    yield rows[r[keep]], part[c[keep]]


def met(sides: dict[tuple[int, bool], np.ndarray], low: int, high: int, reach: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of two chunks of a shard, or of one with itself; ``sides`` holds points by (chunk, whether they visit)."""
    homes, visitors = sides[low, False], sides[low, True]
    if low == high:
        yield from compared(homes, visitors, reach)
        return
    yield from compared(homes, np.concatenate((sides[high, False], sides[high, True])), reach, False)
    yield from compared(sides[high, False], visitors, reach, False)


def forest(points: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Links (point, smallest point of its group) that join what ``pairs`` join; at most one per point."""
    order = np.unique(points)
    label = np.arange(len(order))
    for a, b in pairs:
        a, b = np.searchsorted(order, a), np.searchsorted(order, b)
        while True:  # both ends of each link take the smaller label, through the label's own label
            la, lb = label[a], label[b]
            if np.array_equal(la, lb):
                break
            np.minimum.at(label, np.concatenate((la, lb)), np.concatenate((lb, la)))
            while not np.array_equal(label, label[label]):
                label = label[label]
    moved = label != np.arange(len(order))
    return order[moved], order[label[moved]]


def partners(points: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Of each point its smallest and its nearest linked point: two links at most, however many it has."""
    order = np.unique(points)
    low = np.arange(len(order))
    near = np.full(len(order), 127 << 48)
    for a, b in pairs:
        far = np.bitwise_count(a ^ b).astype(np.int64) << 48
        a, b = np.searchsorted(order, a), np.searchsorted(order, b)
        for x, y in ((a, b), (b, a)):
            np.minimum.at(low, x, y)
            np.minimum.at(near, x, far | y)
    near = np.where(near < 127 << 48, near & ((1 << 48) - 1), low)
    at = np.concatenate((np.flatnonzero(low < np.arange(len(order))), np.flatnonzero(near != low)))
    to = np.concatenate((low[low < np.arange(len(order))], near[near != low]))
    return order[at], order[to]


def apart(points: np.ndarray, names: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The linked pairs whose points have different names, in parts."""
    order, at = np.unique(points, return_index=True)
    name = names[at]
    for a, b in pairs:
        differ = name[np.searchsorted(order, a)] != name[np.searchsorted(order, b)]
        if differ.any():
            yield a[differ], b[differ]


def upper_levels(points: DataFrame, shard: int) -> dict[int, tuple[np.uint64, int]]:
    """The tree's upper levels. All views are as large, and as random: one tree, of the first one's points, serves them all."""
    one = points.where("view = 0")
    count = one.count()
    depth = max(0, int(np.ceil(np.log2(max(count, 1) / shard))))
    sample = [r.fp for r in one.where(common.share_of(count, TREE_SAMPLE, "fp")).orderBy(F.xxhash64("fp"), "fp").limit(TREE_SAMPLE).collect()] if depth else []
    return grown(np.array(sample, dtype=np.int64).view(np.uint64), depth)


CELL = ("view", "shard", "low", "high")


def _tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _dealt(cells: DataFrame) -> DataFrame:
    """Cells over all tasks. The count is explicit, as the adaptive shuffle counts bytes, and cells of few bytes are long work."""
    return cells.repartition(_tasks(cells.sparkSession), *CELL)


def links(ws: Workspace, points: DataFrame, reach: int = RADIUS, found=forest, ends: bool = False) -> DataFrame:
    """Edges a, b (signed longs) of the distinct fingerprints ``fp``, within each ``view`` if there is that column.

    ``found`` picks them from a shard's links: a forest that joins all that the links join, or else `partners`.
    Points with a column ``name`` (a long) give every link between different names instead, in parts, or with
    ``ends`` only the points of such links, each as an edge to itself and at most once per task.
    """
    views, named = "view" in points.columns, "name" in points.columns
    points = points.select(F.col("view") if views else F.lit(0).alias("view"), "fp", *(["name"] if named else []))
    tree = upper_levels(points, SHARD_POINTS)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column("view").to_numpy()
            all_points = batch.column("fp").to_numpy().view(np.uint64)
            parts = [(v, *p) for v in np.unique(of).tolist() for p in routed(all_points[of == v], tree, reach=reach)]
            packs = [pa.array([p[i] for p in parts], t) for i, t in ((0, pa.int32()), (1, pa.int32()), (2, pa.bool_()))]
            packs.append(pa.array([p[3].astype("<u8").tobytes() for p in parts], pa.binary()))
            names = [b""] * len(parts)
            if named:
                name, orders = batch.column("name").to_numpy(), {}
                for v in np.unique(of).tolist():
                    order = np.argsort(all_points[of == v])
                    orders[v] = all_points[of == v][order], name[of == v][order]
                names = [orders[v][1][np.searchsorted(orders[v][0], held)].astype("<i8").tobytes() for v, _, _, held in parts]
            yield pa.RecordBatch.from_arrays([*packs, pa.array(names, pa.binary())], ["view", "shard", "visits", "points", "names"])

    shards = points.mapInArrow(route, "view int, shard int, visits boolean, points binary, names binary")
    shards = ws.table("routed", shards)
    # A row per shard, of which the tree has at most as many as its sample has points.
    sizes = shards.groupBy("view", "shard").agg(F.sum(F.octet_length("points") / 8).alias("n"))
    cuts = sizes.select("view", "shard", F.when(F.col("n") <= TASK_POINTS, 1).otherwise(F.ceil(2 * F.col("n") / TASK_POINTS)).cast("int").alias("chunks"))
    shards = shards.join(F.broadcast(cuts), ["view", "shard"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for view, shard, visits, held, names, chunks in zip(*(batch.column(c) for c in ("view", "shard", "visits", "points", "names", "chunks")), strict=True):
                chunks, held, names = chunks.as_py(), np.frombuffer(held.as_py(), "<u8"), np.frombuffer(names.as_py(), "<i8")
                chunk = (held * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(chunks) if chunks > 1 else np.zeros(len(held), np.uint64)
                for own in np.unique(chunk).tolist():
                    mine = held[chunk == own].tobytes()
                    of_mine = names[chunk == own].tobytes() if named else b""
                    cells = [(min(own, other), max(own, other)) for other in range(chunks)]
                    part = {"view": [view.as_py()] * chunks, "shard": [shard.as_py()] * chunks, "low": [c[0] for c in cells], "high": [c[1] for c in cells]}
                    columns = [pa.array(v, pa.int32()) for v in part.values()] + [pa.array([own] * chunks, pa.int32()), pa.array([visits.as_py()] * chunks), pa.array([mine] * chunks, pa.binary()), pa.array([of_mine] * chunks, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, [*part, "chunk", "visits", "points", "names"])

    def join(key, parts: pa.Table) -> pa.Table:
        low, high = key[2].as_py(), key[3].as_py()
        held = {(c, v): [np.empty(0, "<u8")] for c in (low, high) for v in (False, True)}
        for chunk, visits, packed in zip(*(parts.column(c).to_pylist() for c in ("chunk", "visits", "points")), strict=True):
            held[chunk, visits].append(np.frombuffer(packed, "<u8"))
        sides = {k: np.sort(np.concatenate(v)) for k, v in held.items()}
        a, b = found(np.concatenate(list(sides.values())), met(sides, low, high, reach))
        return pa.table({"view": pa.array([key[0].as_py()] * len(a), pa.int32()), "a": a.view(np.int64), "b": b.view(np.int64)})

    def join_apart(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = key[2].as_py(), key[3].as_py()
        held = {(c, v): [np.empty(0, "<u8")] for c in (low, high) for v in (False, True)}
        names = {k: [np.empty(0, "<i8")] for k in held}
        for batch in batches:
            for chunk, visits, packed, of in zip(*(batch.column(c).to_pylist() for c in ("chunk", "visits", "points", "names")), strict=True):
                held[chunk, visits].append(np.frombuffer(packed, "<u8"))
                names[chunk, visits].append(np.frombuffer(of, "<i8"))
        sides = {k: np.concatenate(v) for k, v in held.items()}
        of = np.concatenate([n for v in names.values() for n in v])
        pairs = apart(np.concatenate(list(sides.values())), of, met({k: np.sort(v) for k, v in sides.items()}, low, high, reach))
        if ends:
            seen = np.empty(0, "<u8")
            for a, b in pairs:
                seen = np.union1d(seen, np.union1d(a, b))
            pairs = [(seen, seen)]
        for a, b in pairs:
            columns = [pa.array(np.full(len(a), key[0].as_py(), np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["view", "a", "b"])

    cells = shards.mapInArrow(cut, "view int, shard int, low int, high int, chunk int, visits boolean, points binary, names binary")
    groups = _dealt(cells).groupBy(*CELL)
    edges = groups.applyInArrow(join_apart if named else lambda k, t: join(k, t), "view int, a long, b long")
    return edges if views else edges.drop("view")


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, reach: int = RADIUS) -> DataFrame:
    """``doc_id``, ``_text_key``, ``fp`` (signed long) and ``component_id`` for each row of ``docs``.

    Rows link at ``reach`` or fewer differing bits; component_id is the smallest
    doc_id reachable. Null texts count as empty and have, like texts without words, the
    fingerprint zero, which links like any other. Rows that repeat a doc_id keep a row
    each. A null doc_id is never the smallest; a group of null ids only has a null
    component_id. No rows give no rows. Columns other than doc_id and the text are not
    read.
    """
    ws = Workspace(docs.sparkSession, "simhash")
    rows = ws.table("fingerprints", fingerprints(docs, text, shingle))
    points = ws.table("points", rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    edges = ws.table("edges", links(ws, points, reach))
    groups = common.components(ws, edges)
    named = points.join(groups.withColumnRenamed("id", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_point = ws.table("components", named.join(smallest, "component").select("fp", "component_id"))
    return rows.join(of_point, "fp")


# --- copies that are 0.8 alike -----------------------------------------------------------


def word_prints(text: str | None, views: int = VIEWS) -> list[int]:
    """Signed fingerprints of the distinct words of a whole text, each of other hashes; zeros if it has none."""
    words = set((text or "").encode().lower().split())
    if not words:
        return [0] * views
    ones = np.zeros(64 * (views + views % 2), dtype=np.int64)
    words = list(words)
    for i in range(0, len(words), 1 << 14):
        part = words[i : i + (1 << 14)]
        hashes = [b"".join([xxhash.xxh3_128_digest(w, seed) for w in part]) for seed in range((views + 1) // 2)]
        for seed, held in enumerate(hashes):
            bits = np.unpackbits(np.frombuffer(held, np.uint8).reshape(-1, 16), axis=1)
            ones[128 * seed : 128 * seed + 128] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(words)).view("<i8")[:views].tolist()


def shingles(text: str | None, size: int = COPY_SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a whole text; shorter texts are one shingle, texts without words none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, "<u8")
    spans = {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, spans), dtype="<u8", count=len(spans)))


def alike(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity; two empty sets are the same."""
    common_ = len(np.intersect1d(a, b, assume_unique=True))
    return common_ / (len(a) + len(b) - common_) if len(a) + len(b) else 1.0


def copies(points: np.ndarray, names: np.ndarray, sets: list[np.ndarray], meets: list[tuple[np.ndarray, np.ndarray]], reach: int, least: float) -> list[tuple[int, int]]:
    """Pairs of places of texts that are copies and join two names: a forest over the names, the texts of which may be many.

    ``meets`` has places that are compared with others, or with each other if both are the same array. Texts beyond
    ``reach`` or of one name by then need no comparison, nor those whose sets are of too unlike sizes.
    """
    size = np.array([len(s) for s in sets], np.int64)
    start = np.concatenate(([0], np.cumsum(size)))
    tokens = np.unique(np.concatenate([np.empty(0, "<u8"), *sets]), return_inverse=True)[1]
    mark = np.zeros(len(tokens) + 1, bool)
    name, out = np.unique(names, return_inverse=True)[1], []
    for rows, others in meets:
        each_once = rows is others
        for i in range(0, len(rows), STRIPE):
            for j in range(0, len(others), 1 << 14):
                part = others[j : j + (1 << 14)]
                r, c = np.nonzero(np.bitwise_count(points[rows[i : i + STRIPE]][:, None] ^ points[part][None, :]) <= reach)
                cuts = np.searchsorted(r, np.arange(len(rows[i : i + STRIPE]) + 1))
                for k in np.flatnonzero(np.diff(cuts)).tolist():
                    at, to = rows[i + k], c[cuts[k] : cuts[k + 1]]
                    to = part[to[to + j > i + k]] if each_once else part[to]
                    # Sets of such unlike sizes cannot be alike enough; one more than that, as products are rounded.
                    to = to[(name[to] != name[at]) & (np.minimum(size[to], size[at]) + 1 >= least * np.maximum(size[to], size[at]))]
                    if not len(to):
                        continue
                    mine = tokens[start[at] : start[at + 1]]
                    mark[mine] = True
                    upto = np.concatenate(([0], np.cumsum(size[to])))
                    held = np.arange(upto[-1]) + np.repeat(start[to] - upto[:-1], size[to])
                    hits = np.concatenate(([0], np.cumsum(mark[tokens[held]])))
                    mark[mine] = False
                    both = hits[upto[1:]] - hits[upto[:-1]]
                    either = size[to] + size[at] - both
                    for other in to[(either == 0) | (both / np.maximum(either, 1) >= least)].tolist():
                        if name[other] != name[at]:
                            out.append((int(at), other))
                            name[name == name[other]] = name[at]
    return out


def near_copies(docs: DataFrame, text: str = "text", views: int = VIEWS, reach: int = RADIUS, shingle: int = COPY_SHINGLE, least: float = COPY_LEAST) -> DataFrame:
    """``doc_id``, ``_text_key``, ``component_id`` and ``_group`` for each row of ``docs``.

    Rows link if their texts' sets of ``shingle`` words have a Jaccard similarity of ``least`` or
    more and one of the ``views`` fingerprints of their distinct words brings them within ``reach`` bits.
    Few comparisons come first: a text with the smallest text of its fingerprint, and that one with
    those of the smallest and the nearest fingerprint within reach. Of all other pairs within
    reach those that are in one group by then need none, and the rest are all compared, where their
    texts meet; only links that join groups leave a task, never pairs. Every link is
    exact; a pair that no view brings together is missed (measured in the README). Texts
    without words are alike. Odd rows as in `near_duplicates`; ``_group`` names the group where no row has an id.
    """
    ws = Workspace(docs.sparkSession, "near-copies")
    rows = docs.select("doc_id", common.text_key(text).alias("_text_key"), F.col(text).alias("_text"))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([word_prints(t.as_py(), views) for t in batch.column("_text")], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_text_key"), found], ["doc_id", "_text_key", "fps"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    rows_of = ws.table("rows", rows.mapInArrow(prints, f"doc_id {kind}, _text_key long, fps array<long>"))
    # Copies are one text from here on.
    texts = ws.table("texts", rows_of.groupBy("_text_key").agg(F.min("doc_id").alias("least"), F.any_value("fps").alias("fps")))
    seen = ws.table("seen", texts.select(F.col("_text_key").alias("key"), F.posexplode("fps").alias("view", "fp")))
    points = ws.table("points", seen.groupBy("view", "fp").agg(F.min("key").alias("first"), F.count("*").alias("n")))
    near = ws.table("near", links(ws, points, reach, partners))
    ends = points.select("view", "fp", "first")
    between = near.join(ends.select("view", F.col("fp").alias("a"), F.col("first").alias("x")), ["view", "a"])
    between = between.join(ends.select("view", F.col("fp").alias("b"), F.col("first").alias("y")), ["view", "b"]).select("x", "y")
    shared = seen.join(points.where("n > 1"), ["view", "fp"]).select(F.col("key").alias("x"), F.col("first").alias("y"))
    pairs = between.unionByName(shared).where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    pairs = ws.table("pairs", pairs)

    # Only texts of a pair have their shingles made, and only once.
    wanted = pairs.select(F.col("x").alias("_text_key")).union(pairs.select("y")).distinct()
    source = rows.join(wanted, "_text_key", "left_semi").dropDuplicates(["_text_key"]).select("_text_key", "_text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py(), shingle) for t in batch.column("_text")]
            columns = [batch.column("_text_key"), pa.array([len(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "size", "set"])

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [batch.column(c) for c in ("a", "b")]
            keep = [alike(*[np.frombuffer(s[i].as_py(), "<u8") for s in sets]) >= least for i in range(batch.num_rows)]
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    sets = ws.table("sets", source.mapInArrow(hashed, "key long, size long, set binary"))

    def linked(pairs: DataFrame) -> DataFrame:
        both = pairs
        for end, held in (("x", "a"), ("y", "b")):
            both = both.join(sets.select(F.col("key").alias(end), F.col("set").alias(held)), end)
        return both.select("x", "y", "a", "b").mapInArrow(checked, "x long, y long").select(F.col("x").alias("a"), F.col("y").alias("b"))

    edges = ws.table("edges", linked(pairs))
    rest = _links_between(ws, texts, seen, points, near, common.components(ws, edges), sets, reach, least)
    edges = edges.unionByName(ws.table("edges-rest", rest))
    groups = common.components(Workspace(docs.sparkSession, "near-copies-groups"), edges)
    named = texts.select(F.col("_text_key").alias("id"), "least").join(groups, "id", "left").withColumn("_group", F.coalesce("component", "id"))
    smallest = named.groupBy("_group").agg(F.min("least").alias("component_id"))
    of_text = ws.table("components", named.join(smallest, "_group").select(F.col("id").alias("_text_key"), "component_id", "_group"))
    return rows_of.select("doc_id", "_text_key").join(of_text, "_text_key").select("doc_id", "_text_key", "component_id", "_group")


def _links_between(ws: Workspace, texts: DataFrame, seen: DataFrame, points: DataFrame, near: DataFrame, groups: DataFrame, sets: DataFrame, reach: int, least: float) -> DataFrame:
    """Links a, b that join different ``groups``: what the first comparisons may have missed, of all pairs that a view brings within reach.

    Only fingerprints with a partner, or of several texts, can have such pairs. The texts of those that do have a place in
    the tree as points have, with their sets. A shard is cut into chunks by a hash of the text, and each
    pair of chunks is a task, which compares its pairs where they are: it holds ``TASK_BYTES`` of sets and gives a forest.
    """
    of_text = texts.select(F.col("_text_key").alias("id")).join(groups, "id", "left").select(F.col("id").alias("key"), F.coalesce("component", "id").alias("of"))
    fps = near.select("view", F.col("a").alias("fp")).union(near.select("view", "b")).union(points.where("n > 1").select("view", "fp")).distinct()
    members = ws.table("members", seen.join(fps, ["view", "fp"], "left_semi").join(of_text, "key"))
    held = members.groupBy("view", "fp").agg(F.min("of").alias("low"), F.max("of").alias("high"))
    # A fingerprint of several groups has a name of its own, unlike all others.
    own = F.xxhash64("fp", F.lit("several"))
    held = ws.table("held", held.select("view", "fp", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(own).alias("name"), (F.col("low") < F.col("high")).alias("several")))
    far = links(Workspace(ws.spark, "near-copies-rest"), held.select("view", "fp", "name"), reach, ends=True).select("view", F.col("a").alias("fp"))
    crowd = ws.table("crowd", far.union(held.where("several").select("view", "fp")).distinct())
    tree = upper_levels(crowd, CROWD_POINTS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column("view").to_numpy()
            for v in np.unique(of).tolist():
                for shard, visits, held in routed(batch.column("fp").to_numpy().view(np.uint64)[of == v], tree, reach=reach):
                    columns = [pa.array([x] * len(held), t) for x, t in ((v, pa.int32()), (shard, pa.int32()), (visits, pa.bool_()))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(held.view(np.int64))], ["view", "shard", "visits", "fp"])

    places = crowd.mapInArrow(place, "view int, shard int, visits boolean, fp long")
    placed = members.join(places, ["view", "fp"]).join(sets.select("key", "size"), "key")
    placed = ws.table("placed", placed.select("view", "shard", "visits", "fp", "key", "of", "size"))
    sizes = placed.groupBy("view", "shard").agg(F.sum(F.greatest(8 * F.col("size"), F.lit(COPY_BYTES))).alias("n"))
    sizes = ws.table("sizes", sizes)  # a row per shard
    # Each text is sent to as many cells as its shard has chunks, so a shard is cut further only as far as its part of
    # the work, which grows as the square of its size, is more than a task's.
    work = float(sizes.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 1)
    even = F.ceil(F.sqrt(2 * _tasks(ws.spark) * (F.col("n").cast("double") * F.col("n") / work)))
    chunks = F.greatest(F.ceil(2 * F.col("n") / TASK_BYTES), F.least(even, F.ceil(F.col("n") / PART_BYTES), F.lit(MOST_PARTS)), F.lit(1))
    cuts = sizes.select("view", "shard", chunks.cast("int").alias("chunks"))
    cells = placed.drop("size").join(F.broadcast(cuts), ["view", "shard"]).join(sets.select("key", "set"), "key")
    cells = cells.withColumn("chunk", F.pmod(F.xxhash64("key"), "chunks").cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = cells.select("view", "shard", F.least("chunk", "_other").alias("low"), F.greatest("chunk", "_other").alias("high"), "chunk", "visits", "fp", "key", "of", "set")

    def compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = key[2].as_py(), key[3].as_py()
        rows = pa.Table.from_batches(list(batches))
        chunk, visits, fp, keys, of = (rows.column(c).to_numpy() for c in ("chunk", "visits", "fp", "key", "of"))
        held = [np.frombuffer(s, "<u8") for s in rows.column("set").to_pylist()]
        side = {(c, v): np.flatnonzero((chunk == c) & (visits == v)) for c in (low, high) for v in (False, True)}
        homes, visitors = side[low, False], side[low, True]
        if low == high:
            meets = [(homes, homes), (homes, visitors)]
        else:
            meets = [(homes, np.concatenate((side[high, False], side[high, True]))), (side[high, False], visitors)]
        found = np.array(copies(fp.view(np.uint64), of, held, meets, reach, least), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(keys[found[:, 0]]), pa.array(keys[found[:, 1]])], ["a", "b"])

    return _dealt(cells).groupBy(*CELL).applyInArrow(compare, "a long, b long")


def without_copies(docs: DataFrame, text: str = "text", **rule) -> DataFrame:
    """The rows of ``docs`` without near copies (`near_copies` with that rule): of each group the one with the smallest doc_id."""
    return _smallest(docs, text, near_copies(docs, text, **rule))


def deduplicated(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the one with the smallest doc_id.

    Of rows that share that doc_id one stays. Rows without doc_id stay only in groups
    that have no other. All columns of ``docs`` are kept as they are.
    """
    return _smallest(docs, text, near_duplicates(docs, text).withColumn("_group", F.col("fp")))


def _smallest(docs: DataFrame, text: str, found: DataFrame) -> DataFrame:
    """Of each group of ``found`` the row with the smallest doc_id, of those one."""
    ws = Workspace(docs.sparkSession, "simhash-keep")
    order = F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("id"), F.col("_text_key").alias("key"))
    # A group without any id has a null component_id and is known by its other name, so group by both.
    best = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("_group")).alias("_of")).agg(F.min(order).alias("best"))
    kept = ws.table("kept", best.select(F.col("best.id").alias("_id"), F.col("best.key").alias("_key")))
    rows = common.packed(docs, _doc=F.col("doc_id"), _text=common.text_key(text))
    out = rows.join(kept, rows["_doc"].eqNullSafe(kept["_id"]) & (rows["_text"] == kept["_key"]), "left_semi")
    return out.dropDuplicates(["_doc", "_text"]).select("_row.*")
