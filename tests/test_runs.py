"""What lies between runs: cache scan, changes and gate, search index, layout, summaries, stored joins, quarantine, health."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lodestone import captures, catalog, catalog_runs, fixed, schema
from lodestone.operators import enrich
from lodestone.plans import changes, cluster, query, refresh, search, stats, summaries
from lodestone.sources import extract, proxies, readers
from lodestone.sources.specs import specs

from .test_sources import frame


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- cache scan ------------------------------------------------------------------------------


def entries(path, spark):
    return {r["code"]: {k: v for k, v in r.asDict().items() if k != "code" and v is not None} for r in readers.cache_scan(spark, str(path)).collect()}


NASTY = ["plain", "}", "{", '}, {"x": {"share": "1"}', 'a"b', "back\\slash\\", '\\"}', "}}}", "", "né {漢}"]


@pytest.mark.parametrize("layout", [dict(indent=2), dict(separators=(",", ":")), dict()], ids=["pretty", "dense", "plain"])
def test_cache_scan_is_the_object(spark, tmp_path, layout):
    rng = random.Random(1)
    cache = {f'K{i}{rng.choice(["", "}", chr(34), "{"])}': {"share": rng.choice(NASTY), "images": rng.choices(NASTY, k=2), "plotSqm": float(i)} for i in range(60)}
    cache["empty"] = {}
    (tmp_path / "c.json").write_text(json.dumps(cache, ensure_ascii=False, **layout))
    assert entries(tmp_path / "c.json", spark) == cache
    whole = {r["code"]: r for r in readers.enrichment_cache(spark, str(tmp_path / "c.json")).collect()}
    assert {c: r["share"] for c, r in whole.items()} == {c: e.get("share") for c, e in cache.items()}


def test_cache_scan_by_many_tasks(spark, tmp_path):
    cache = {f"K{i}": {"propertyType": "} {" * 40 + str(i), "plotSqm": float(i)} for i in range(8_000)}
    text = json.dumps(cache)
    assert len(text) > 1_000_000
    (tmp_path / "c.json").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 8
        assert entries(tmp_path, spark) == cache
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_cache_scan_of_odd_files(spark, tmp_path):
    assert readers.cache_scan(spark, str(tmp_path / "none")).count() == 0
    for name, text in (("a", ""), ("b", "{}"), ("c", "no json"), ("d", '{"Q1": {"share": "1"}, "Q1": {"share": "2"}}\n{"Q2": {"share": "3"}}')):
        (tmp_path / name).write_text(text)
    assert [entries(tmp_path / n, spark) for n in "abc"] == [{}, {}, {}]
    assert entries(tmp_path / "d", spark) == {"Q1": {"share": "2"}, "Q2": {"share": "3"}}


# --- changes and the gate ---------------------------------------------------------------------


def listings(spark, *rows):
    return frame(spark, schema.LISTING, [{"seq": i, "kind": "house"} | r for i, r in enumerate(rows)])


def test_changes_of_all_fields(spark):
    same = dict(source="A", link="l1", price=1.0, title="t")
    old = listings(spark, same, dict(source="A", link="L2/", price=1.0), dict(source="B", ref="r", title=None), dict(source="B", link="gone"), dict(source="C"), dict(source="C"))
    new = listings(spark, dict(source="B", ref="r", title=""), same, dict(source="A", link="l2", price=2.0, images=["x"]), dict(source="N", link="new"), dict(source="C"))
    got = {r["key"]: (r["change"], r["fields"]) for r in changes.listing_changes(old, new).collect()}
    # The rows "C" stand for one key twice, of which one is gone.
    assert got["l2"][0] == "changed" and set(got["l2"][1]) == {"price", "images", "link"}
    assert got["B|r"] == ("changed", ["title"]) and got["gone"] == ("removed", None) and got["new"] == ("added", None) and got["C"] == ("changed", None)
    assert len(got) == 5
    assert changes.listing_changes(old, old.orderBy(F.col("seq").desc())).count() == 0
    assert changes.listing_changes(old.limit(0), old.limit(0)).count() == 0


def test_only_differing_buckets_are_compared(spark, sf):
    rows = proxies.houses(spark, sf).where("link IS NOT NULL")
    one = rows.withColumn("price", F.when(F.col("seq") == 5, -1.0).otherwise(F.col("price")))
    old, new = changes.digests(rows).cache(), changes.digests(one).cache()
    assert len(changes.differing(old, new)) == 1 and changes.differing(old, changes.digests(rows.repartition(5))) == []
    text = plan(changes.listing_changes(rows, one, old, new))
    assert "pmod(xxhash64" in text and [r["fields"] for r in changes.listing_changes(rows, one, old, new).collect()] in ([["price"]], [None])


def test_the_gate(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    rows = [dict(source="Realting", link="l1", price=1.0), dict(seq=50, source="Kadis Estates", link="l2", price=2.0)]

    def run(n, failed, *which, **kw):
        out = listings(spark, *which)
        done = changes.publish_if_changed(refresh.Refresh(out, out.select("seq"), failed), "house", path, n, **kw)
        return done.published, done.reason, sorted(r["link"] for r in refresh.latest(spark, path).collect())

    assert run(1, {}, *rows) == (True, "first", ["l1", "l2"])
    assert run(2, {}, *reversed(rows)) == (False, "unchanged", ["l1", "l2"])
    failing = {"Kadis Estates": "timeout"}
    assert run(3, failing, rows[0], on_failure="refuse") == (False, "refused", ["l1", "l2"])
    assert run(4, failing, rows[0]) == (False, "unchanged", ["l1", "l2"])  # its last rows stay
    moved = dict(source=fixed.HOUSE_PRIORITY[0], link="l2", price=9.0)  # a better source now has the link
    assert run(5, failing, rows[0], moved) == (True, "changed", ["l1", "l2"])
    assert run(6, failing, rows[0], on_failure="publish") == (True, "changed", ["l1"])
    with pytest.raises(ValueError):
        run(7, {}, on_failure="hide")


# --- search, layout, summaries ------------------------------------------------------------------


def test_search_is_the_scan(spark, sf, tmp_path):
    rows = proxies.houses(spark, sf).select("seq", *search.FIELDS)
    odd = [(10**6, "Übergröße ΑΒΓ", None, "r%_."), (10**6 + 1, "", "", ""), (10**6 + 2, None, "aaaa", "AaA")]
    rows = rows.unionByName(spark.createDataFrame(odd, rows.schema))
    path = str(tmp_path / "index")
    search.write_index(rows, path, chunk=100)
    held = rows.cache()
    for needle in ("3", "R1", "r12", "NATION_1", "bedroom HOUSE, auto", "5 bedroom house, machinery", "GRÖSSE", "größe α", "%_.", "aaa", "aaaaa", "zzz", "nation_10, america and nothing"):
        test = query.ListingQuery(q=needle)
        assert {r["seq"] for r in search.search(spark, path, needle).collect()} == {r["seq"] for r in test.filter(held).collect()}, needle
    text = plan(search.search(spark, path, "r123"))
    assert "chunk#" in text.split("PartitionFilters:")[1].split("]")[0]


def rows_read(df):
    """Rows that come out of the file scans of a plan that has run."""
    df.collect()
    stack, n = [df._jdf.queryExecution().executedPlan()], 0
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            n += node.metrics().apply("numOutputRows").value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return n


def test_clustered_snapshot_is_read_in_part(spark, sf, tmp_path):
    rows = proxies.houses(spark, sf)
    clustered, plain = str(tmp_path / "c"), str(tmp_path / "p")
    cluster.write_clustered(rows, clustered, files=64)
    rows.repartition(64).write.parquet(plain)
    wanted = query.ListingQuery(district="ASIA", min_plot=400, max_plot=700, min_sqm=100)
    read = {}
    for path in (clustered, plain):
        df = wanted.filter(spark.read.schema(rows.schema).parquet(path)).select("seq")
        read[path] = rows_read(df), sorted(r["seq"] for r in df.collect())
    assert read[clustered][1] == read[plain][1] and read[clustered][1]
    assert read[clustered][0] < read[plain][0] / 2


def test_summaries_of_parts(spark, sf, tmp_path):
    rows, path = proxies.houses(spark, sf), str(tmp_path / "s")
    for part, test in (("a", "seq % 3 = 0"), ("b", "seq % 3 <> 0"), ("c", "seq < 700")):
        summaries.write_summary(rows.where(test), path, part)
    summaries.write_summary(rows.where("seq % 3 = 0"), path, "a")  # once more
    assert summaries.stats_bar(spark, path, ("a", "b")).first() == stats.stats_bar(rows).first()
    assert [tuple(r) for r in summaries.facet_sources(spark, path, ("a", "b")).collect()] == [tuple(r) for r in stats.facet_sources(rows).collect()]
    assert summaries.distinct_listings(spark, path).first()[0] == rows.count()
    assert summaries.distinct_listings(spark, path, ("a", "c")).first()[0] == rows.where("seq % 3 = 0 OR seq < 700").count()
    assert "orders" not in plan(summaries.stats_bar(spark, path))


# --- stored joins, quarantine, health ------------------------------------------------------------


def test_stored_side_is_not_shuffled(spark, sf, tmp_path):
    rows = proxies.houses(spark, sf)
    cache = catalog._part_cache(spark, sf)
    stored = enrich.store_keyed(cache, "cache_of_test", str(tmp_path / "cache"), ("code",), 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich.merge_cache(rows, stored, source="1-URGENT", stored=True)
        join = plan(joined).split("SortMergeJoin", 1)[1].split("\n+- Union")[0]
        assert join.count("Exchange hashpartitioning(ref") == 1 and "Exchange hashpartitioning(code" not in join
        want = sorted(map(str, enrich.merge_cache(rows, cache, source="1-URGENT").collect()))
        assert sorted(map(str, joined.collect())) == want
        sliced = enrich.merge_cache(rows.withColumn("ref", F.when(F.col("seq") % 2 == 0, "R1").when(F.col("seq") % 5 > 0, F.col("ref"))), stored, source="1-URGENT", n_rows=rows.count(), hot_rows=50, stored=True)
        plain = enrich.merge_cache(rows.withColumn("ref", F.when(F.col("seq") % 2 == 0, "R1").when(F.col("seq") % 5 > 0, F.col("ref"))), cache, source="1-URGENT")
        assert sorted(map(str, sliced.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS cache_of_test")


def test_quarantine_by_capture(spark):
    spec = specs("house", "Bazaraki")[0]
    payloads = ['{"results": []}', "<html>blocked</html>", None, '{"detail": "throttled"}', '{"results": "no"}', '{"results": [{"id": 1, "slug": "a"}]}']
    pages = frame(spark, schema.BRONZE_JSON, [dict(source=spec.source, kind="house", partition="x", page_no=i, payload=p) for i, p in enumerate(payloads)])
    held = {r["page_no"]: (r["reason"], r["payload"]) for r in extract.quarantine(spec, pages, extract.cards(spec, pages)).where("reason <> 'card'").collect()}
    assert held == {1: ("payload", payloads[1]), 2: ("payload", None), 3: ("items", payloads[3]), 4: ("items", payloads[4])}


def test_health_needs_no_count(spark, sf):
    bronze = {"json": captures.capture(spark, sf, "Bazaraki", "plot")}
    counts = {}
    listings_, failed = refresh.extract_sources(spark, "plot", bronze, counts=counts)
    assert counts["Bazaraki"] == listings_.where("source = 'Bazaraki'").count() and set(failed) == {"Kadis Estates", "Cyprus Properties", "Kazo Real Estate"}
    assert all("Traceback" in e for e in failed.values())
    got = {r["registry"]: (r["n"], r["succeeded"]) for r in refresh.health(spark, "plot", refresh.Refresh(listings_, listings_, failed, counts)).collect()}
    assert got["Bazaraki"] == (counts["Bazaraki"], True) and got["Kadis Estates"] == (0, False) and got["EstateBud-WP agencies"] == (0, True)


@pytest.mark.parametrize("registry", ["Pafilia", "Giovani Homes"])
def test_long_taxonomies_are_joined(spark, sf, monkeypatch, registry):
    spec, pages = specs("house", registry)[0], captures.capture(spark, sf, registry, "house")
    known = captures.terms(spark, sf)
    known = known.unionByName(known.where("term_id < 3").withColumn("name", F.lit("Zzz")))

    def found():
        return sorted(map(str, extract.listings_of(extract.cards(spec, pages, known)).collect()))

    short = found()
    monkeypatch.setattr(enrich, "TERMS_IN_PLAN", 3)
    assert short and found() == short
    assert "_names" in plan(extract.cards(spec, pages, known))
    with pytest.raises(LookupError):
        extract.cards(spec, pages, known.limit(0))


def test_quarantine_keeps_no_fields(spark, sf, monkeypatch):
    """The quarantine's count writes the places of the cards, not their listings."""
    written, table = [], catalog_runs.Workspace.table
    monkeypatch.setattr(catalog_runs.Workspace, "table", lambda self, name, df, by=None: written.append(df.columns) or table(self, name, df, by))
    catalog_runs.capture_quarantine(spark, sf)
    assert written == [[*extract.CAPTURE, "pos", "valid"]] * 3


def test_seq_of_many_pages(spark):
    """The six-fold large tables have 54 million pages of one source; the last source's numbers still fit."""
    pages = spark.createDataFrame([(2**25, 0), (2**26 - 1, 2**20 - 1)], "page_no bigint, pos int")
    last = len(fixed.HOUSE_REGISTRY) - 1
    found = [r[0] for r in pages.select(schema.capture_seq(last, F.lit(15), F.col("page_no"), F.col("pos"))).collect()]
    assert found[0] < found[1] < 2**schema.SEQ_BITS and last < 32
