"""Extraction, enrichment, refresh and streaming on small hand-written captures."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lodestone import captures, fixed, schema
from lodestone.functions import numbers as n
from lodestone.operators import dedup, enrich
from lodestone.plans import refresh, stats
from lodestone.sources import extract, proxies, readers
from lodestone.sources.specs import SourceSpec, specs
from lodestone.streaming import ingest
from tests.test_dedup import sequential

T0, T1 = datetime(2026, 1, 1), datetime(2026, 1, 2)


def frame(spark, struct, rows):
    names = struct.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], struct)


def html(spark, source, kind, *pages, partition="", captured_at=T0):
    rows = [
        dict(source=source, kind=kind, partition=partition, page_no=i + 1, captured_at=captured_at, html=page)
        for i, page in enumerate(pages)
    ]
    return frame(spark, schema.BRONZE_HTML, rows)


def payloads(spark, source, kind, *pages, partition=""):
    rows = [
        dict(source=source, kind=kind, partition=partition, page_no=i + 1, captured_at=T0, payload=page)
        for i, page in enumerate(pages)
    ]
    return frame(spark, schema.BRONZE_JSON, rows)


def listings(spark, name, kind, bronze, **kw):
    spec = specs(kind, name)[0]
    return extract.listings_of(extract.cards(spec, bronze, **kw)).orderBy("seq").collect()


TEASER = '<div class="teaser-tile" data-id="{}"><a class="teaser-title">{} bedroom villa</a><p>Tala, Cyprus</p>{} 120 m²'


def test_first_copy_hides_a_priced_later_one(spark):
    page = "head" + TEASER.format(1, 3, "$9") + TEASER.format(2, 2, "€1,09M") + TEASER.format(1, 3, "€300,000")
    got = listings(spark, "Realting", "house", html(spark, "Realting", "house", page, TEASER.format(2, 4, "€400,000")))
    assert [(r["ref"], r["price"], r["beds"], r["district"]) for r in got] == [("2", 1090000.0, 2, "Paphos")]


def test_no_marker_no_cards(spark):
    assert listings(spark, "Realting", "house", html(spark, "Realting", "house", "nothing here", "")) == []


def test_page_cap(spark):
    pages = [TEASER.format(i, 3, "€300,000") for i in range(25)]
    bronze = html(spark, "Realting", "house", *pages)
    assert len(listings(spark, "Realting", "house", bronze)) == 25
    assert len(listings(spark, "Realting", "house", bronze, caps={"Realting": 20})) == 20


def test_status_order_decides_between_copies(spark):
    block = 'AList-BoxContainer">Unique Code</span> AList-BoxTextBlue500"> EE1-002 <b AList-BoxTextPrice"> {} €'
    late = html(spark, "eAuction Cyprus", "house", block.format("150.000"), partition="7")
    early = html(spark, "eAuction Cyprus", "house", block.format("90.000"), partition="5")
    closed = html(spark, "eAuction Cyprus", "house", block.format("10.000"), partition="9")
    (row,) = listings(spark, "eAuction", "house", late.unionAll(early).unionAll(closed))
    assert (row["price"], row["district"], row["title"]) == (90000.0, "Other", "Residence auction — Other")
    assert row["priceDisplay"] == "€90,000 (reserve price)" and row["link"].endswith(fixed.EAUCTION_LIST_PATH)


def test_json_pages(spark):
    item = {"id": 7, "slug": "s", "title": "Residential plot", "price": "1200.00", "attrs": {"attrs__plot-area": "501.5 m²", "attrs__planning-zone": "--"}}
    bronze = payloads(spark, "Bazaraki", "plot", json.dumps({"results": [item, item]}), "<html>blocked</html>", "{}", partition="Paphos")
    (row,) = listings(spark, "Bazaraki", "plot", bronze)
    assert (row["ref"], row["price"], row["plotSqm"], row["plotType"], row["zone"]) == ("7", 1200.0, 502.0, "Residential", None)
    assert row["images"] == [] and row["priceDisplay"] == "€1,200" and row["district"] == "Paphos"


def test_position_form_of_beds_and_baths(spark):
    card = dict(source="Kazo Real Estate", kind="house", page_no=1, pos=0, id="5", link="https://k.test/property/5", txt="3,995,000€ 5 4 272sqm", title="Villa", images=["u"])
    bronze = frame(spark, schema.CARD_TEXT, [card, card | {"pos": 1}, card | {"pos": 2, "id": None}])
    (row,) = listings(spark, "Kazo Real Estate", "house", bronze)
    assert (row["price"], row["beds"], row["baths"], row["houseSqm"], row["district"]) == (3995000.0, 5, 4, 272.0, "Villa")


def test_rows_without_id_stay(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x"), (4, "x")], "seq bigint, item_id string")
    assert sorted(r["seq"] for r in extract.first_copies(df, []).collect()) == [1, 2, 3]


def test_latest_pages(spark):
    old = html(spark, "Realting", "house", TEASER.format(1, 3, "€300,000"), TEASER.format(2, 3, "€200,000"))
    new = html(spark, "Realting", "house", TEASER.format(3, 3, "€500,000"), captured_at=T1)
    spec, bronze = specs("house", "Realting")[0], old.unionAll(new)
    cards = extract.cards(spec, bronze)
    assert sorted(r["ref"] for r in extract.latest_pages(cards, extract.pages_of(spec, bronze)).collect()) == ["2", "3"]


def test_extra_predicate_of_a_source(spark):
    base = specs("house", "Realting")[0]
    spec = SourceSpec(**{**base.__dict__, "keep": "beds >= 3"})
    bronze = html(spark, "Realting", "house", TEASER.format(1, 2, "€300,000") + TEASER.format(2, 3, "€300,000"))
    assert [r["ref"] for r in extract.listings_of(extract.cards(spec, bronze)).collect()] == ["2"]


def test_capture_order_out_of_range_fails(spark):
    bronze = html(spark, "Realting", "house", TEASER.format(1, 2, "€300,000")).withColumn("page_no", F.lit(-1).cast("bigint"))
    with pytest.raises(Exception, match="page_no outside"):
        listings(spark, "Realting", "house", bronze)


def test_terms_by_map_and_by_join(spark):
    terms = frame(spark, schema.TERMS, [dict(source="Pafilia", term_id=i, name=f"n{i}") for i in range(5)])
    df = spark.createDataFrame(
        [("p", 1, 0, T0, ([3, 9, 1],)), ("p", 1, 1, T0, ([],)), (None, 1, 2, T0, ([3, 3],))],
        "partition string, page_no bigint, pos int, captured_at timestamp, item struct<property_city:array<int>>",
    )
    twice = terms.unionByName(terms.withColumn("name", F.concat(F.lit("z"), "name")))
    for taxonomy in (terms, twice):
        wide, names = enrich.term_names(df, "Pafilia", taxonomy)
        rows = wide.select("pos", F.array_join(F.filter(names(F.col("item.property_city")), lambda x: x.isNotNull()), ",").alias("n"))
        assert {r["pos"]: r["n"] or "" for r in rows.collect()} == {0: "n3,n1", 1: "", 2: "n3,n3"}


def test_no_taxonomy_fails_the_source(spark):
    df = spark.createDataFrame([("p", 1, 0, T0, ([3],))], "partition string, page_no bigint, pos int, captured_at timestamp, item struct<property_city:array<int>>")
    for terms in (None, frame(spark, schema.TERMS, [dict(source="Other", term_id=1, name="x")])):
        _, names = enrich.term_names(df, "Pafilia", terms)
        with pytest.raises(LookupError, match="no taxonomy for Pafilia"):
            names(F.col("item.property_city"))


def test_a_page_of_many_cards(spark):
    page = "head" + "".join(TEASER.format(i, 3, "€300,000") for i in range(5000))
    assert len(listings(spark, "Realting", "house", html(spark, "Realting", "house", page))) == 5000


def test_an_overlong_number_is_no_number(spark):
    card = '<div class="estatebud-property"><a href="https://kadis.com.cy/property-{}/x"><strong>{}</strong> Beds <strong>2</strong> Baths'
    got = listings(spark, "Kadis Estates", "house", html(spark, "Kadis Estates", "house", "head" + card.format(1, 35799123456) + card.format(2, 3)))
    assert [(r["ref"], r["beds"], r["baths"]) for r in got] == [("1", None, 2), ("2", 3, 2)]


def test_the_newest_capture_of_a_page_counts(spark):
    old = html(spark, "Realting", "house", "head" + TEASER.format(1, 3, "€100,000"))
    new = html(spark, "Realting", "house", "head" + TEASER.format(1, 3, "€90,000"), captured_at=T1)
    scraped, _ = refresh.extract_sources(spark, "house", {"html": old.unionByName(new)})
    assert [r["price"] for r in scraped.where("source = 'Realting'").collect()] == [90000.0]


def test_pages_that_empty_or_vanish(spark):
    def walk(run, at, *pages):
        return html(spark, "Realting", "house", *pages, captured_at=at).withColumn("run", F.lit(run).cast("bigint"))

    teaser = "head" + TEASER
    first = walk(1, T0, teaser.format(1, 3, "€100,000"), teaser.format(2, 3, "€200,000"), teaser.format(3, 3, "€300,000"))
    second = walk(2, T1, teaser.format(1, 3, "€110,000"), "nothing on this page")
    scraped, _ = refresh.extract_sources(spark, "house", {"html": first.unionByName(second)})
    assert [(r["ref"], r["price"]) for r in scraped.where("source = 'Realting'").collect()] == [("1", 110000.0)]


def test_cache_file(spark, tmp_path):
    assert readers.enrichment_cache(spark, str(tmp_path / "none.json")).collect() == []
    path = tmp_path / "cache.json"
    path.write_text(json.dumps({"A-1": {"plotSqm": 203, "images": ["a", "b"], "share": "1/1"}, "B": {"image": "x"}}, indent=1))
    cache = readers.enrichment_cache(spark, str(path))
    assert {r["code"]: (r["plotSqm"], r["images"], r["image"]) for r in cache.collect()} == {"A-1": (203.0, ["a", "b"], None), "B": (None, None, "x")}
    new = frame(spark, schema.CACHE, [dict(code="B", plotSqm=5.0), dict(code="C", share="1/3")])
    merged = {r["code"]: r for r in enrich.upsert(cache, new, "code").collect()}
    assert merged["B"]["plotSqm"] == 5.0 and merged["B"]["image"] == "x" and merged["A-1"]["share"] == "1/1" and merged["C"]["share"] == "1/3"


def test_array_snapshot(spark, tmp_path):
    path = tmp_path / "listings.json"
    path.write_text(json.dumps([{"source": "A", "price": 1, "beds": 2}, {"source": "B", "images": ["x"]}], indent=1))
    rows = readers.snapshot_json(spark, str(path), array=True).orderBy("source").collect()
    assert (rows[0]["price"], rows[0]["beds"], rows[1]["images"]) == (1.0, 2, ["x"])


def test_registry(spark):
    assert [r["registry"] for r in readers.source_registry(spark, "plot").orderBy("source_order").collect()] == list(fixed.PLOT_REGISTRY)
    assert [s.registry for s in specs("house")] == list(fixed.HOUSE_REGISTRY)
    assert [s.source for s in specs("plot", "EstateBud-WP agencies")] == ["NCH Real Estate"]


def test_embedded_data_skips_broken_blocks(spark):
    block = '<script type="application/ld+json">{}</script>'
    page = block.format("{broken") + block.format('{"name":"x"}') + block.format('{"yearBuilt":"0"}') + block.format('{"yearBuilt":"1999"}')
    row = spark.createDataFrame([(page,)], "h string").select(readers.json_ld(F.col("h"), "floorSize", "yearBuilt").alias("b")).first()
    assert row["b"] == '{"yearBuilt":"1999"}'


def decisions_by_walk(rule, rows):
    fields = ("seq", "source", "beds", "price", "houseSqm", "plotSqm", "district", "link")
    return {s: d for s, (d, _) in sequential(rule, [{f: r[f] for f in fields} for r in rows]).items()}


def test_refresh_goes_on_without_a_failing_source(spark, sf, tmp_path):
    bronze = {"json": captures.capture(spark, sf, "Bazaraki", "plot").unionByName(captures.capture(spark, sf, "EstateBud-WP agencies", "plot"))}
    broken = captures.capture(spark, sf, "Kadis Estates", "plot").withColumn("page_no", F.lit(-1).cast("bigint"))
    bronze["html"] = broken.unionByName(captures.capture(spark, sf, "Cyprus Properties", "plot"))
    out = refresh.refresh(spark, "plot", bronze)
    assert set(out.failed) == {"Kadis Estates", "Kazo Real Estate"}
    got = {r["seq"]: r["decision"] for r in out.decisions.collect()}
    scraped, _ = refresh.extract_sources(spark, "plot", bronze)
    rows = [r.asDict() for r in refresh.finish(scraped).collect()]
    assert got == decisions_by_walk(dedup.PLOTS, rows) and set(got.values()) == {"kept", "cross"}
    report = stats.dedup_report(out.decisions).first()
    assert report["scraped"] == len(rows) and report["kept"] == out.listings.count()
    path = str(tmp_path / "snapshot")
    refresh.publish(out.listings.limit(0), path, 1)
    refresh.publish(out.listings, path, 2)
    assert refresh.latest(spark, path).count() == report["kept"]


def test_all_sources_failed(spark):
    with pytest.raises(refresh.AllSourcesFailed):
        refresh.refresh(spark, "plot", {})


def test_stream_replaces_recaptured_pages(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("bronze", "silver", "checkpoint", "snapshot")]
    bronze, silver, checkpoint, snapshot = paths

    def arrive(df, run):
        df.write.mode("append").parquet(bronze)
        ingest.ingest_cards(spark, "house", "html", bronze, silver, checkpoint).awaitTermination()
        ingest.republish(spark, "house", silver, snapshot, run)
        return {r["ref"]: r["price"] for r in refresh.latest(spark, snapshot).collect()}

    first = html(spark, "Realting", "house", TEASER.format(1, 3, "€300,000"), TEASER.format(2, 3, "€200,000"))
    again = html(spark, "Realting", "house", TEASER.format(1, 3, "€310,000"), captured_at=T1)
    assert arrive(first, 1) == {"1": 300000.0, "2": 200000.0}
    assert arrive(again, 2) == {"1": 310000.0, "2": 200000.0}


def test_freshness(spark):
    df = spark.createDataFrame([("A", T0), ("A", T1), ("B", T0)], "source string, captured_at timestamp")
    got = {r["source"]: (r["age_hours"], r["stale"]) for r in stats.freshness(df, "2026-01-02 12:00:00").collect()}
    assert got == {"A": (12, False), "B": (36, True), "(all)": (12, False)}


def test_proxy_source_health(spark, sf):
    registry = spark.createDataFrame([("1-URGENT",), ("nobody",)], "source string")
    rows = {r["source"]: r for r in stats.source_health(registry, proxies.houses(spark, sf), failed=("nobody",)).collect()}
    assert rows["1-URGENT"]["n"] > 0 and rows["1-URGENT"]["succeeded"] and not rows["nobody"]["succeeded"]


def test_enrichment_with_hot_keys(spark):
    """One link and one code hold most of the rows; the sliced join gives the same."""
    rows = [dict(seq=i, source="Realting" if i % 3 else "eAuction Cyprus", link="hot" if i % 5 else f"l{i}", ref="hot" if i % 7 else None) for i in range(200)]
    df = frame(spark, schema.LISTING, rows)
    details = spark.createDataFrame(
        [("Realting", link, *[float(j) for j in range(6)], True) for link in ("hot", "l10", "l20")],
        "source string, link string, " + ", ".join(f"d_{f} double" for f in enrich.DETAIL_FIELDS) + ", d_seen boolean",
    )
    cache = frame(spark, schema.CACHE, [dict(code="hot", plotSqm=7.0)])
    plain = enrich.merge_details(enrich.merge_cache(df, cache), details)
    sliced = enrich.merge_details(enrich.merge_cache(df, cache, n_rows=200, hot_rows=10), details, n_rows=200, hot_rows=10)
    assert sorted(map(str, plain.collect())) == sorted(map(str, sliced.collect()))
    assert plain.where("plotSqm = 7").count() == sum(1 for r in rows if r["source"].startswith("e") and r["ref"])


def test_hot_terms(spark):
    df = spark.createDataFrame([(i, [1, i % 4, 9]) for i in range(100)], "k int, ids array<int>")
    terms = spark.createDataFrame([(i, f"n{i}") for i in range(4)], "term_id int, name string")
    args = (df, ["k"], F.col("ids"), terms, "names")
    plain = {r["k"]: r["names"] for r in enrich.lookup_names(*args).collect()}
    sliced = {r["k"]: r["names"] for r in enrich.lookup_names(*args, n_ids=300, hot_rows=10).collect()}
    assert plain == sliced and plain[2] == ["n1", "n2"]


def test_captures_of_cards_read_their_listings_once(spark, sf):
    for registry in ("FOX Realty", "Altamira"):
        pages = captures.capture(spark, sf, registry, "house")
        assert "Union" not in pages._jdf.queryExecution().optimizedPlan().toString()
    pages = captures.capture(spark, sf, "FOX Realty", "house")
    assert pages.schema.names == schema.CARD_TEXT.names
    assert {r["pos"]: r["count"] for r in pages.groupBy("pos").count().collect()} == dict.fromkeys((0, 1), proxies.houses(spark, sf).count())


def test_patterns_are_searched_once(spark, sf):
    """The pattern of the link of an agency card, on which the card's validity depends, stands in the plan once."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    for registry, kind, pattern in (("EstateBud-WP agencies", "house", r"nchrealestate\.com/property"), ("Kadis Estates", "plot", r"kadis\.com\.cy/property")):
        plan = captures.listings(spark, sf, registry, kind)._jdf.queryExecution().executedPlan().toString()
        assert plan.count(pattern) == 1


def test_attributes_in_any_case(spark):
    texts = ["<STRONG>1,280.5</Strong> M²", "<strong>3</strong> <strong>4</strong> m²", "<strong>5</strong> m", "İ <strong>6</strong> m²", None]
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string")
    found = rows.select("i", n.strong_attr(F.col("s"), "m²").alias("v")).orderBy("i").collect()
    assert [r.v for r in found] == [12805.0, 4.0, None, 6.0, None]
