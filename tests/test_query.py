"""Filters, orders, cards and statistics on a small hand-written set."""

from pyspark.sql import functions as F

from lodestone.plans import query, stats
from lodestone.plans.query import ListingQuery

SCHEMA = (
    "seq bigint, source string, title string, location string, ref string, price double, priceDisplay string, "
    "district string, houseSqm double, plotSqm double, beds int, baths int, buildYear int, posted string, postedTs bigint, "
    "image string, link string, propertyType string, share string, auctionDate string, plotType string, zone string"
)
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
DAY = 86400000
ROWS = [
    dict(seq=0, source="A", title="Villa 100% new", price=300.0, houseSqm=100.0, plotSqm=200.0, beds=3, buildYear=1990, district="N", posted="3 days ago"),
    dict(seq=1, source="B", title="a_b", price=None, houseSqm=None, plotSqm=0.0, beds=0, district=None, posted="today", image=""),
    dict(seq=2, source="A", title="a.b (x)", price=100.0, houseSqm=0.0, plotSqm=None, beds=None, buildYear=2000, district="", postedTs=95 * DAY, image="i.jpg"),
    dict(seq=3, source="eAuction Cyprus", title="plain", location="Upper", ref="Ref9", price=100.0, priceDisplay="€100 (reserve price)", plotSqm=50.0,
         share="1/2", auctionDate="01/02/2026", district="N"),
    dict(seq=4, source="B", title="zero", price=0.0, houseSqm=80.0, plotSqm=10.0, district="L"),
]


def listings(spark):
    return spark.createDataFrame([tuple(r.get(n) for n in NAMES) for r in ROWS], SCHEMA)


def found(spark, **params):
    return [r["seq"] for r in ListingQuery(**params).filter(listings(spark)).orderBy("seq").collect()]


def test_filters(spark):
    assert found(spark) == [0, 1, 2, 3, 4]
    assert found(spark, sources=frozenset()) == []
    assert found(spark, sources=frozenset({"A"})) == [0, 2]
    assert found(spark, min_price=150) == [0, 1]
    assert found(spark, max_price=100) == [1, 2, 3, 4]
    assert found(spark, min_sqm=0) == [0, 2, 4]
    assert found(spark, min_plot=0, max_plot=100) == [1, 3, 4]
    assert found(spark, min_year=1990) == [0, 2]
    assert found(spark, min_beds=0) == [0, 1]
    assert found(spark, district="N") == [0, 3]
    assert found(spark, min_price=50, min_plot=100, q="VILLA") == [0]


def test_search_is_literal(spark):
    assert found(spark, q="%") == [0]
    assert found(spark, q="_") == [1]
    assert found(spark, q=".") == [2]
    assert found(spark, q="(") == [2]
    assert found(spark, q="upper") == [3]
    assert found(spark, q="ref9") == [3]
    assert found(spark, q=" ") == [0, 2]


def test_orders(spark):
    def order(sort):
        return [r["seq"] for r in ListingQuery(sort=sort).run(listings(spark), as_of_ms=100 * DAY).collect()]

    assert order("price_asc") == [4, 2, 3, 0, 1]
    assert order("price_desc") == [0, 2, 3, 4, 1]
    assert order("sqm_desc") == [0, 4, 2, 1, 3]
    assert order("plot_desc") == [0, 3, 4, 1, 2]
    assert order("plot_asc") == [1, 4, 3, 0, 2]
    assert order("ppsqm_asc") == [0, 3, 1, 2, 4]
    assert order("ppsqm_desc") == [3, 0, 1, 2, 4]
    assert order("recent") == [1, 0, 2, 3, 4]


def test_positions(spark):
    numbers = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("seq"))
    rows = query.positions(numbers.orderBy(F.col("seq").desc())).collect()
    assert {r["seq"]: r["position"] for r in rows} == {s: 1000 - s for s in range(1000)}


def test_defaults(spark):
    assert query.DEFAULT_SORT == {"house": "price_asc", "plot": "plot_desc"}
    assert [r["seq"] for r in query.reset().run(listings(spark), "plot", limit=2).collect()] == [0, 3]


def test_cards(spark):
    cards = {r["seq"]: r for r in query.card_view(listings(spark)).collect()}
    assert cards[0]["chips"] == ["3 bed", "100 m² house", "200 m² plot", "€1.5/m² plot", "Built 1990"]
    assert cards[1]["price_label"] == "Price on request" and cards[1]["chips"] == []
    assert cards[1]["placeholder"] == "No photo available" and cards[2]["placeholder"] is None
    assert cards[3]["price_label"] == "€100 (reserve)" and cards[3]["location_label"] == "Upper · Ref Ref9"
    assert cards[3]["chips"] == ["50 m² plot", "€2.0/m² plot", "Share 1/2", "Auction 01/02/2026"]
    assert "auction" in cards[3]["placeholder"]
    plot = {r["seq"]: r for r in query.card_view(listings(spark), "plot").collect()}
    assert plot[0]["chips"] == ["200 m² plot", "€1.5/m²"]


def test_stats(spark):
    row = stats.stats_bar(listings(spark)).first()
    assert row.asDict() == {"total": 5, "sources": 3, "with_photo": 1, "avg_price": 125, "districts": 2}
    empty = stats.stats_bar(listings(spark).where("false")).first()
    assert empty.asDict() == {"total": 0, "sources": 0, "with_photo": 0, "avg_price": 0, "districts": 0}
    assert [(r["source"], r["n"]) for r in stats.facet_sources(listings(spark)).collect()] == [("A", 2), ("B", 2), ("eAuction Cyprus", 1)]
    assert [r["value"] for r in stats.facet_values(listings(spark), "district").collect()] == ["L", "N"]
    some = ListingQuery(min_beds=1)
    assert stats.result_counts(listings(spark), some.filter(listings(spark))).first() == (1, 5)
    assert stats.counts_in_one_pass(listings(spark), some.predicates()[0]).first() == (1, 5)


def test_snapshots(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None)], "key string, price double")
    new = spark.createDataFrame([("b", 3.0), ("c", None), ("d", 4.0)], "key string, price double")
    got = {r["key"]: r["change"] for r in stats.snapshot_diff(old, new).collect()}
    assert got == {"a": "removed", "b": "changed", "d": "added"}
    assert stats.snapshot_changed(old, new) and not stats.snapshot_changed(old, old)


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "listings")
    listings(spark).write.parquet(path)
    q = ListingQuery(district="N", min_beds=2).filter(spark.read.parquet(path)).select("seq")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(district,N)" in plan and "GreaterThanOrEqual(beds,2)" in plan
    assert "title" not in plan.split("ReadSchema")[1]
