"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

A source with a target of t words and s words in all takes each of its documents
``floor(t / s)`` times, then whole documents in ascending order of an exponential key,
scaled by their quality weights, until the words of the rest of the target are reached;
the document at the edge comes in if that leaves the smaller gap. In that order a source
is a set of ranges, so no task holds a whole source; the edge of each source is one row,
and taking or leaving a document compares its key with that edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm import common
from lodestone.session import Workspace

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix-1"
# Copies of the table of sources, if it is too large for a broadcast: a hot source's documents meet them in as many parts.
SALTS = 64


def size_of(text: str = "text") -> Column:
    """Words of the whole text: runs of anything but space and x09 to x0D. Null has none."""
    bare = F.trim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(bare) == 0, 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def quality_of(text: str, size: Column) -> Column:
    """Weight 1 for texts whose mean word length is that of prose (3 to 10 characters), else one half."""
    mean = (F.length(text) + 1) / F.greatest(size, F.lit(1)) - 1
    return F.when(mean.between(3, 10), 1.0).otherwise(0.5)


def exponential_key(weight: Column, doc_id: str = "doc_id", seed: str = SEED) -> Column:
    """-ln(u) / weight for a uniform u that depends on the id and the seed only."""
    digits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))), 1, 13), 16, 10)
    u = (digits.cast("double") + 0.5) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def targets(ws: Workspace, sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of each source, from (source, source_size).

    Sources weigh ``weights`` in turn, by code point, null last; together they get
    ``share`` of all words. None gets more than ``most`` times its size; what is over
    goes to the others by weight, again until none is above. A source of no words gets 0.
    """
    placed = common.ranked(ws, "sources", sources, "source")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    placed = ws.table("weights", placed.select("source", "source_size", turn.alias("_weight"), (F.col("source_size") * most).alias("_cap")))
    whole = placed.agg(F.sum("source_size")).first()[0] or 0
    goal, level, filled = whole * share, None, -1
    while True:  # each round closes the sources that are above; a round's figures are three numbers
        over = F.lit(False) if level is None else F.col("_cap") <= F.col("_weight") * level
        closed, words, weight = placed.agg(F.count(F.when(over, 1)), F.sum(F.when(over, F.col("_cap"))), F.sum(F.when(~over, F.col("_weight")))).first()
        if closed == filled or not weight:
            break
        filled, level = closed, (goal - (words or 0)) / weight
    target = F.least(F.col("_cap").cast("double"), F.col("_weight") * F.lit(level)) if level is not None else F.col("_cap").cast("double")
    return placed.select("source", "source_size", target.alias("target"))


def edges(ws: Workspace, docs: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: ``epochs``, and the last key that the rest of its target takes (``_edge``, null if none).

    ``docs`` has source, size, _key, _id, _text (a hash). Its prefix sums run inside ranges of (source,
    key), on top of the sums of the ranges before, so a hot source spreads over many tasks.
    """
    order = [F.col("source").asc_nulls_last(), F.col("_key"), F.col("_id").asc_nulls_last(), F.col("_text")]
    ranges = ws.table("ranges", docs.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sums = ranges.groupBy("_part", "source").agg(F.sum("size").alias("_sum"))
    before = sums.withColumn("_before", F.sum("_sum").over(Window.partitionBy("source").orderBy("_part")) - F.col("_sum")).drop("_sum")
    goal = goals.select("source", (F.col("target") / F.greatest("source_size", F.lit(1))).alias("_share"), "target", "source_size")
    goal = goal.select("source", F.floor("_share").alias("epochs"), (F.col("target") - F.floor("_share") * F.col("source_size")).alias("_rest"))
    start = before.join(goal, before["source"].eqNullSafe(goal["source"])).select("_part", before["source"].alias("_source"), "_before", "epochs", "_rest")
    upto = F.sum("size").over(Window.partitionBy("_part", "source").orderBy("_key", F.col("_id").asc_nulls_last(), "_text").rowsBetween(Window.unboundedPreceding, 0))
    placed = ranges.withColumn("_upto", upto)
    placed = placed.join(start, (placed["_part"] == start["_part"]) & placed["source"].eqNullSafe(start["_source"]))
    taken = F.col("_before") + F.col("_upto") - F.col("size") / 2 <= F.col("_rest")
    edge = F.max(F.when(taken & (F.col("_rest") > 0), F.struct(F.col("_key").alias("key"), F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_text").alias("text"))))
    found = placed.groupBy("source").agg(edge.alias("_edge"))
    return goal.join(found, goal["source"].eqNullSafe(found["source"]), "left").select(goal["source"], "epochs", "_edge")


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED, text: str = "text") -> DataFrame:
    """Each row as ``_row`` with size, source_size, target of its source, and taken, the words the mix takes of it.

    ``taken`` is the document's size times the copies that the mix has of it, of which
    no document has more than ``most``. Null and empty texts have size 0 and take 0 words;
    ``copies`` says how often a row is in the mix. A null source is a source of its own,
    the last. Rows with the same doc_id in a source and quality weight share one key, and
    null ids are one id; a hash of the text orders them, so that only rows equal in both
    share one decision. The same rows and seed give the same mix in any order or layout. No
    rows give none.
    """
    ws = Workspace(docs.sparkSession, "mix")
    size = size_of(text)
    rows = common.packed(docs, source=F.col("source"), doc_id=F.col("doc_id"), text=F.col(text)).withColumn("size", size)
    rows = rows.withColumn("_key", exponential_key(quality_of("text", F.col("size")), seed=seed)).withColumn("_text", common.text_key()).drop("text")
    narrow = ws.table("sizes", rows.select("source", F.col("doc_id").alias("_id"), "size", "_key", "_text"))
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = ws.table("targets", targets(ws, sources, weights, share, most))
    plan = edges(ws, narrow, goals).withColumnRenamed("source", "_name")
    plan = ws.table("plan", plan.join(goals, plan["_name"].eqNullSafe(goals["source"])).drop("_name").withColumnRenamed("source", "_source"))
    if plan.count() <= common.SMALL_ROWS:
        found = rows.join(F.broadcast(plan), rows["source"].eqNullSafe(plan["_source"]))
    else:
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        copies = plan.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
        found = salted.join(copies, salted["source"].eqNullSafe(copies["_source"]) & (salted["_salt"] == copies["_copy"]))
    own = F.struct(F.col("_key").alias("key"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_text").alias("text"))
    copies = F.col("epochs") + F.when(own <= F.col("_edge"), 1).otherwise(0)
    copies = F.when(F.col("source_size") > 0, copies).otherwise(0).cast("int")
    return found.select("_row", "doc_id", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"))


def repeated(mix: DataFrame) -> DataFrame:
    """The documents of a mix, each as often as the mix has it."""
    return mix.where("copies > 0").withColumn("_copy", F.explode(F.expr("sequence(1, copies)"))).select("_row.*")
