"""Physical plans that must stay as they are."""

import re
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from lodestone import captures, catalog
from lodestone.operators import dedup
from lodestone.session import Workspace
from lodestone.sources import extract, proxies
from lodestone.sources.specs import specs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_copies_are_cut_before_the_shuffle(spark, sf):
    text = plan(catalog.QUERIES["insource_first_wins"](spark, sf))
    before, after = text.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_matching_builds_no_pairs_of_rows(spark, sf):
    matcher, rows, _ = dedup.prepare(proxies.houses(spark, sf), catalog.HOUSE_RULE)
    text = plan(matcher.conflicts(rows, rows))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert text.count("partial_min") >= 3  # minima combine before each shuffle


def test_areas_do_not_meet_areas(spark, sf):
    """The area step has no join; its windows are cut by key and block of areas, in one layout."""
    matcher, rows, _ = dedup.prepare(proxies.houses(spark, sf), catalog.HOUSE_RULE)
    offered = rows.where("akey IS NOT NULL").groupBy(*matcher.keys, "akey").agg(F.min("ord").alias("m"))
    text = plan(matcher.near(None, offered, list(matcher.keys), F.min, {"m": "a_m"}))
    assert "Join" not in text
    windows = [line for line in text.splitlines() if re.search(r"\bWindow \[", line)]
    assert len(windows) == 1 and all("_block" in line for line in windows)
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*_block", text)) == 1


def test_decided_rows_are_read_by_folder(spark):
    table = Workspace(spark, "plans").table("t", spark.range(9).withColumn("waits", F.col("id") > 4), by="waits")
    text = table.where(~F.col("waits"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(waits" in text
    assert [r["id"] for r in table.where("waits").orderBy("id").collect()] == [5, 6, 7, 8]


def test_top_of_a_list_is_not_a_full_sort(spark, sf):
    assert "TakeOrderedAndProject" in plan(catalog.QUERIES["cheapest_listings"](spark, sf))


def test_source_filter_is_pushed_down(spark, sf):
    text = plan(catalog.QUERIES["filter_sources"](spark, sf))
    assert "In(o_orderpriority, [1-URGENT,5-LOW])" in text
    scan = next(line for line in text.splitlines() if "o_orderpriority" in line and "ReadSchema" in line)
    assert "o_totalprice" not in scan and "o_orderdate" not in scan


def test_a_source_reads_its_own_captures(spark, sf):
    bronze = captures.bronze_of(spark, sf, "plot")
    for spec in specs("plot"):
        for df in (extract.cards(spec, bronze[spec.bronze]), extract.pages_of(spec, bronze[spec.bronze])):
            filters = plan(df).split("PartitionFilters:")[1].split("PushedFilters")[0]
            assert f"= {spec.source})" in filters and "(kind#" in filters


def test_written_tables_leave_no_shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {f for f in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}

    before, name = shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    conf = spark.conf.get(name)
    rows = spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count()
    with ThreadPoolExecutor(3) as pool:  # jobs at the same time share the session's setting
        tables = list(pool.map(lambda i: Workspace(spark, "t").table(f"rows-{i}", rows), range(3)))
    for _ in range(100):  # they are removed on the side
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert spark.conf.get(name) == conf
    assert [t.count() for t in tables] == [7, 7, 7]
