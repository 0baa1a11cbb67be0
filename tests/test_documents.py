"""Notice tables, lots, photographs."""

from pyspark.sql import functions as F

from lodestone import schema
from lodestone.operators import documents, enrich


def items(spark, *cells):
    rows = [("C-002", "a", 1, i, s, x, y) for i, (s, x, y) in enumerate(cells)]
    return spark.createDataFrame(rows, schema.PDF_ITEMS)


HEAD = [("Εγγραφή", 60, 10), ("Έκταση", 200, 10), ("Εγγεγραμμένο", 250, 10), ("συμφέρον", 300, 12), ("Είδος", 400, 10)]


def test_notice_rows(spark):
    cells = [
        *HEAD,
        ("1.", 20, 60), ("0/7", 105, 60), ("0/8", 106, 60), ("5/3", 290, 60), ("1/2", 301, 60), ("1.234,5", 210, 81),
        ("ΔΙΑΜΕΡΙΣΜΑ", 10, 70), ("η ΚΑΤΟΙΚΙΑ", 455, 60), ("ΓΗ", 456, 60),
        ("2.**", 35, 120), ("99", 210, 142), ("0", 215, 120), ("ΓΗ", 10, 125), ("1.", 36, 300),
    ]
    got = {r["idx"]: r for r in documents.notice_rows(items(spark, *cells)).collect()}
    assert set(got) == {1, 2}
    assert (got[1]["registration"], got[1]["share"], got[1]["areaSqm"], got[1]["propertyType"]) == ("0/7", "1/2", 1235.0, "Residence")
    assert (got[2]["registration"], got[2]["share"], got[2]["areaSqm"], got[2]["propertyType"]) == (None, None, None, "Land")


def test_documents_of_one_code_stay_apart(spark):
    first = items(spark, *HEAD, ("1.\u00a0", 20, 60), ("100", 200, 60))
    second = items(spark, *HEAD, ("1.", 20, 60), ("300", 200, 60)).withColumn("doc", F.lit("b"))
    both = documents.notice_rows(first.unionByName(second))
    assert {(r["doc"], r["areaSqm"]) for r in both.collect()} == {("a", 100.0), ("b", 300.0)}
    photos = spark.createDataFrame([], "code string, n int, image string")
    entry = documents.harvest_entries(both, photos).first()
    assert entry["plotSqm"] == 100.0 and entry["has_row"]


def test_overlong_lot_number(spark):
    rows = spark.createDataFrame([("EA-20260305123", 2, "b"), ("EA-20260305123", 1, "a")], "code string, idx int, v string")
    assert documents.pick_lot(rows, ["idx"]).first()["v"] == "a"


def test_band_join_is_open_at_its_edge(spark):
    anchors = spark.createDataFrame([(1, 0), (1, -5)], "page int, anchor_y int")
    tokens = spark.createDataFrame([(1, y) for y in range(-40, 40)], "page int, y int")
    got = {r["anchor_y"]: r["n"] for r in documents.band_join(anchors, tokens, ["page"], 22).groupBy("anchor_y").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 43, -5: 43}


def test_lots_and_cache(spark):
    rows = documents.notice_rows(items(spark, *HEAD, ("1.", 20, 60), ("100", 200, 60), ("2.", 20, 120), ("200", 200, 120)))
    assert documents.pick_lot(rows, ["page", "row_no"]).first()["idx"] == 2
    plain = rows.withColumn("code", F.lit("C"))
    assert documents.pick_lot(plain, ["page", "row_no"]).first()["idx"] == 1
    missing = rows.withColumn("code", F.lit("C-009"))
    assert documents.pick_lot(missing, ["page", "row_no"]).first()["idx"] == 1
    photos = spark.createDataFrame([("C-002", 2, "b"), ("C-002", 1, "a"), ("D", 1, "d")], "code string, n int, image string")
    entries = documents.harvest_entries(rows, photos)
    old = spark.createDataFrame([("C-002", 5.0, None, "x", ["x"], "1/1", None, None)], schema.CACHE)
    cache = {r["code"]: r for r in enrich.upsert(old, entries, "code").collect()}
    assert (cache["C-002"]["plotSqm"], cache["C-002"]["images"], cache["C-002"]["share"]) == (200.0, ["a", "b"], "1/1")
    assert cache["D"]["image"] == "d"


def test_photo_test(spark):
    def image(name, side, rgb):
        return [(name, side, 200, i, *rgb) for i in range(20)]

    rows = image("photo", 200, (200, 100, 50)) + image("map", 200, (250, 248, 245)) + image("small", 199, (200, 100, 50)) + image("black", 200, (0, 0, 0))
    got = {r["image_id"]: r["is_photo"] for r in documents.photo_test(spark.createDataFrame(rows, schema.PIXELS)).collect()}
    assert got == {"photo": True, "map": False, "small": False, "black": False}


def test_detail_links(spark):
    df = spark.createDataFrame([(2, "/Auction/Details/2"), (1, "/Auction/Details/1"), (3, "/x"), (4, None)], "seq bigint, link string")
    assert [r["seq"] for r in documents.detail_links(df).collect()] == [1, 2]
    assert [r["seq"] for r in documents.detail_links(df, limit=1).collect()] == [1]


def test_notice_rows_of_odd_places(spark):
    """Blocks of heights, negative heights, pages without headings, markers of one number and rows without a place."""
    reach = documents.fixed.NOTICE_ROW_BAND
    edge = reach * documents.BLOCK_BANDS
    cells = [
        *HEAD, ("1.", 20, edge), ("0/7", 60, edge - reach + 1), ("1/2", 300, edge + reach - 1), ("5", 200, edge - reach),
        ("2.", 20, -edge), ("0/9", 60, -edge - reach + 1), ("1.234.567,5", 200, -edge - 1), ("1,2,3", 190, -edge), ("00001/2", 300, -edge),
    ]
    rows = [("C", "a", 1, i, *c) for i, c in enumerate(cells)]
    rows += [("D", "a", 1, 0, "1.", 20, 60), ("D", "a", 1, 1, "ΓΗ", 90, 60), ("D", "a", 1, 2, "0/7", 60, 60)]
    rows += [("E", "a", 1, 0, "Εγγραφή", 60, 0), ("E", "a", 1, 1, "1.", 20, 60), ("E", "a", 1, 1, "1.", 20, 60 + 2 * edge), ("E", "a", 1, 2, "0/3", 60, 60 + 2 * edge)]
    rows += [(None, "a", 1, 0, "1.", 20, 60), ("F", "a", None, 0, "1.", 20, 60), ("F", "a", 1, 0, "1.", 20, None), ("F", "a", 1, 1, None, 20, 5)]
    got = documents.notice_rows(spark.createDataFrame(rows, schema.PDF_ITEMS)).select("code", "idx", "registration", "share", "areaSqm", "propertyType")
    assert sorted(map(tuple, got.collect())) == [
        ("C", 1, "0/7", "1/2", None, None), ("C", 2, "0/9", None, 1234568.0, None), ("D", 1, None, None, None, "Land"), ("E", 1, "0/3", None, None, None),
    ]




def test_notice_tokens_do_not_travel_whole(spark):
    """Only what can be a cell is shuffled, in tasks by rows; headings, markers and other words stay behind."""
    tokens = documents.cell_values(items(spark, *HEAD, ("1.", 20, 60), ("0/7", 105, 60), ("1.234,5", 210, 81), ("η ΓΗ", 1, 60), ("word", 1, 60)), 22)
    assert [(r["fraction"], r["area"], r["word"] is None) for r in tokens.orderBy("item_no").collect()] == [
        (None, 1.0, True), ("0/7", None, True), (None, 1235.0, True), (None, None, False),
    ]
