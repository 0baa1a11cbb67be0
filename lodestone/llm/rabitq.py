"""Near-duplicate vectors by randomised-rotation binary codes.

Only vectors of one length are compared: each length has its own lists and rotation.
Equal vectors collapse first. Each distinct vector has a home list, that of its nearest
centroid (spherical k-means on a bounded sample), and visits lists of smaller number whose
centroid is nearly as near (``MARGIN``); all vectors are indexed. In a list every home
vector is a code: the signs of the rotated unit vector, with the inner product of code
and vector as correction factor. ``<code, y> / factor`` estimates the cosine without bias;
its confidence bound, and the bound that the angle between code and vector sets for
certain, say which pairs may reach the threshold. Only those are computed again, in
double precision, from the vectors themselves.

Long lists are cut into chunks, and pairs of chunks are separate tasks. A task returns
link counts and a spanning forest, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import common
from lodestone.llm.simhash import forest
from lodestone.session import Workspace

THRESHOLD = 0.9
# Vectors that the centroids are fitted on; vectors per list; most lists.
FIT_SAMPLE, LIST_VECTORS, MOST_LISTS = 20_000, 1_000, 4_096
MARGIN = 0.2
# Width of the confidence interval in standard errors of the estimate.
CONFIDENCE = 5.0
CHUNK = 4_096
STRIPE = 512
# Vectors with more components are compared without codes, as their rotation would be too large.
MOST_ROTATED = 4_096
SEED = 11


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, scaled first so that very small and very large ones keep their direction."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@lru_cache(maxsize=2)
def rotation(n: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((n, n)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """Unit centroids of spherical k-means, begun at the first vectors of the sample."""
    middle = sample[:count]
    for _ in range(rounds):
        of = (sample @ middle.T).argmax(axis=1)
        sums = np.zeros_like(middle)
        np.add.at(sums, of, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        middle = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), middle)
    return middle


def links(codes_of: np.ndarray, others: np.ndarray, turn: np.ndarray | None, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of unit vectors with a cosine of at least the threshold; of one set with itself each pair once.

    Without a rotation all pairs are computed.
    """
    d = codes_of.shape[1]
    turned = others.astype(np.float32) if turn is None else (others @ turn).astype(np.float32)
    for i in range(0, len(codes_of), STRIPE):
        rows = codes_of[i : i + STRIPE]
        own = rows if turn is None else rows @ turn
        code = np.where(own >= 0, 1.0, -1.0) / np.sqrt(d)
        factor = np.clip((code * own).sum(axis=1), 1e-6, 1.0)
        error = np.sqrt((1 - factor**2) / (factor**2 * max(1, d - 1)))
        likely = factor * (THRESHOLD - CONFIDENCE * error)  # on <code, y>: estimate plus confidence bound reaches the threshold
        certain = np.cos(np.minimum(np.pi, np.arccos(THRESHOLD) + np.arccos(factor)))  # below it no vector can
        least = (np.maximum(likely, certain) - 1e-5).astype(np.float32)
        if turn is None:
            code, least = own, np.full(len(own), THRESHOLD - 1e-3, np.float32)
        begin = i if same else 0
        a, b = np.nonzero(code.astype(np.float32) @ turned[begin:].T >= least[:, None])
        if same:
            a, b = a[a < b], b[a < b]
        exact = np.concatenate([np.einsum("ij,ij->i", rows[a[k : k + 65536]], others[b[k : k + 65536] + begin]) for k in range(0, len(a), 65536)] or [np.empty(0)])
        hit = exact >= THRESHOLD
        yield a[hit] + i, b[hit] + begin


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    A vector that is null, empty, zero, or holds a null or non-finite component links with
    nothing, and others only with vectors of their own length. A row without vec_id links
    with nothing; its component_id is null. Equal vectors link, in rows that repeat a
    vec_id too: n_links counts the other rows linked, component_id is the smallest vec_id
    reachable. No rows give none. Other columns are not read.
    """
    spark = vectors.sparkSession
    ws = Workspace(spark, "rabitq")
    kind = "array<float>" if vectors.schema[embedding].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast(kind).alias("v"))
    sound = F.col("vec_id").isNotNull() & F.coalesce(F.size("v") > 0, F.lit(False)) & F.expr("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))") & F.expr("exists(v, x -> x <> 0)")
    rows = rows.withColumn("ok", F.coalesce(sound, F.lit(False)))
    rows = rows.withColumn("v", F.when(F.col("ok"), F.col("v"))).drop("ok")
    groups = ws.table("groups", rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    middles = {}  # centroids of the lengths that have more than one list
    for width, count in groups.groupBy(F.size("v").alias("width")).count().where(F.col("count") >= 2 * LIST_VECTORS).collect():
        of_width = groups.where((F.size("v") == width) & common.share_of(count, FIT_SAMPLE, "v"))
        sample = of_width.orderBy(F.xxhash64("v"), "id").limit(FIT_SAMPLE).select("v").toArrow()
        middles[width] = centroids(units(_vectors(sample.column("v"))), int(min(MOST_LISTS, count // LIST_VECTORS)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            for width in np.unique(sizes):
                own = batch.take(pa.array(np.flatnonzero(sizes == width)))
                if width in middles:
                    near = units(_vectors(own.column("v"))) @ middles[width].T
                    home = near.argmax(axis=1)
                    visits = (near >= near.max(axis=1, keepdims=True) - MARGIN) & (np.arange(near.shape[1])[None, :] < home[:, None])
                    visits[np.arange(len(home)), home] = True
                    row, at = np.nonzero(visits)
                else:
                    row, home = np.arange(len(own)), np.zeros(len(own), np.int64)
                    at = home
                part = own.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), width, np.int32)), pa.array(at.astype(np.int32)), pa.array(at == home[row]), *part.columns], ["width", "list", "home", "v", "id", "copies"])

    id_type = groups.schema["id"].dataType.simpleString()
    members = groups.mapInArrow(assign, f"width int, list int, home boolean, v {kind}, id {id_type}, copies long")
    members = ws.table("members", members)
    cuts = members.groupBy("width", "list").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))  # at most MOST_LISTS rows per length
    members = members.join(F.broadcast(cuts), ["width", "list"]).withColumn("chunk", F.pmod(F.xxhash64("v"), F.col("chunks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    members = members.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})

    def search(key, table: pa.Table) -> pa.Table:
        if len(table) < 2:
            return table.select(["id", "copies", "id", "v"]).rename_columns(["id", "links", "root", "v"]).slice(0, 0)
        v, home = units(_vectors(table.column("v"))), table.column("home").to_numpy()
        turn = rotation(v.shape[1]) if v.shape[1] <= MOST_ROTATED else None
        chunk, copies = table.column("chunk").to_numpy(), table.column("copies").to_numpy()
        sides = [(chunk == key[2].as_py()) & home, (chunk == key[2].as_py()) & ~home, (chunk == key[3].as_py()) & home, (chunk == key[3].as_py()) & ~home]
        pairs = [(0, 0), (0, 1)] if key[2] == key[3] else [(0, 2), (0, 3), (2, 1)]
        n_links, found = np.zeros(len(v), np.int64), []
        for a, b in pairs:
            i, j = np.flatnonzero(sides[a]), np.flatnonzero(sides[b])
            for x, y in links(v[i], v[j], turn, a == b):
                np.add.at(n_links, i[x], copies[j[y]])
                np.add.at(n_links, j[y], copies[i[x]])
                child, root = forest(np.concatenate((i[x], j[y])), [(i[x], j[y])])  # at once: a group's pairs are never kept
                found.append((child, root))
        child, root = forest(np.arange(len(v)), iter(found))
        to = np.arange(len(v))
        to[child] = root
        hit = np.flatnonzero(n_links)
        ids = table.column("id").combine_chunks()
        return pa.table({"id": ids.take(pa.array(hit)), "links": pa.array(n_links[hit]), "root": ids.take(pa.array(to[hit])), "v": table.column("v").combine_chunks().take(pa.array(hit))})

    found = members.groupBy("width", "list", "low", "high").applyInArrow(lambda k, t: search(k, t), f"id {id_type}, links long, root {id_type}, v {kind}")
    found = ws.table("found", found)
    joined = common.components(ws, found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    n_links = found.groupBy("v").agg(F.sum("links").alias("links"))
    known = groups.join(n_links, "v", "left").join(joined, "id", "left")
    known = ws.table("known", known.select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "id").alias("component")))
    out = rows.join(known, "v", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
