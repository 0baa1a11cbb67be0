"""Scalar functions on hand-written values."""

import pytest
from pyspark.sql import functions as F

from lodestone import fixed
from lodestone.functions import labels, numbers as n, places, text as t


def results(spark, fn, values, dtype="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {dtype}")
    return [r["y"] for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


CASES = [
    (n.price_or_millions, ["€1,09M", "€647,000", "€ 647,000", "€2M", "$5"], [1090000.0, 647000.0, 647000.0, 2000000.0, None]),
    (n.price_bracketed, ["£644,206 [€740,000]", "€5,000", "£1"], [740000.0, 5000.0, None]),
    (n.price_either_side, ["€70,000", "3,995,000€", "€ 5"], [70000.0, 3995000.0, None]),
    (n.price_dots, ["€150.000", "150.000,00", "€ 1.250.000"], [150000.0, None, 1250000.0]),
    (n.price_commas, ["€0", "€250,000", None], [None, 250000.0, None]),
    (n.price_euro_commas, ["€0", "x €1,000", "1,000€"], [0.0, 1000.0, None]),
    (n.price_decimal, ["EUR 1200.50", "0", "free"], [1200.5, None, None]),
    (lambda c: n.strong_attr(c, "m²"), ["<strong>280.5</strong> m²"], [2805.0]),
    (n.to_int, ["120.5 m", "0", "none"], [121.0, None, None]),
    (n.area_any_unit, ["93 m²", "272sqm", "272 M2", "1.234 m²"], [93.0, 272.0, 272.0, 1234.0]),
    (n.share_is_valid, ["33/118", "0/4211", "5/3", "x"], [True, False, False, False]),
    (n.notice_area, ["1.234,5", "12", "a", "1,2,3"], [1235.0, 12.0, None, None]),
    (lambda c: t.swap(t.grab(c, r"(?i)\bin\s+(.+)$"), r"\s*/\s*", ", "), ["Villa in Limassol / Potamos Germasogeias"], ["Limassol, Potamos Germasogeias"]),
    (lambda c: t.plot_type(c, fixed.PLOT_TYPES, False), ["Residential Plot", "Agricultural Field", "Field"], ["Residential", "Agricultural", None]),
    (lambda c: t.plot_type(c, fixed.PLOT_TYPES, True), ["Field", "Battlefield"], ["Agricultural", None]),
    (t.planning_zone, ["--", " - ", "Ka4", None], [None, None, "Ka4", None]),
    (places.canonical, ["Pafos", "Lefkosia", "Ammochostos", "Germasogeia", "Lemesos", "Larnaca", None],
     ["Paphos", "Nicosia", "Famagusta", "Limassol", "Limassol", "Larnaca", None]),
    (lambda c: places.by_first_segment(c, fixed.KADIS_AREAS), ["Lakatameia, X", "Somewhere, Y", None, "x, old PAFOS", "Xpafos"],
     ["Nicosia", "Somewhere", None, "Paphos", "Xpafos"]),
    (lambda c: places.by_last_segment(c, fixed.KAZO_AREAS), ["a, mesa geitonia", "a, Elsewhere ", ""], ["Limassol", "Elsewhere", None]),
    (places.by_substring, ["House in PAPHOS", "elsewhere", None], ["Paphos", "Other", "Other"]),
    (places.by_word, ["Limassol / Y", "Limassolx"], ["Limassol", None]),
    (lambda c: places.by_alias(c, fixed.REALTING_AREAS), ["Kato Paphos", "Tala, Cyprus", "paphos", None], ["Paphos", "Paphos", None, None]),
    (t.title_case, ["AGIOS-NIKOLAOS  foo", "ΑΓΙΟΣ ab", "élan"], ["Agios-Nikolaos Foo", "αγιος Ab", "éLan"]),
    (t.slug_title, ["https://x/nice-house-in-3-rooms-123/", "https://x/9"], ["Nice House In 3 Rooms", None]),
    (t.link_key, ["HTTPS://A/x//", "https://a/x", "", None], ["https://a/x", "https://a/x", None, None]),
    (t.strip_tags, ["<b>a</b>  <i>b</i>"], ["a b"]),
    (labels.posted_rank, ["5 hours ago", "Today", "yesterday", "3 days ago", "2 weeks ago", "01/02/2024", None, ""],
     [0.0, 0.5, 1.0, 3.0, 14.0, 500.0, 999.0, 999.0]),
    (lambda c: labels.posted_display(labels.epoch_ms(c)), ["2026-07-09T10:11:12", "soon"], ["9 Jul 2026", None]),
    (lambda c: labels.short_name(c, "house"), ["A Place in the Sun", "eAuction Cyprus"], ["APITS", "eAuction"]),
    (lambda c: labels.short_name(c, "plot"), ["Kadis Estates", "DOM real estate"], ["Kadis", "DOM"]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_text(spark, case):
    fn, values, expected = CASES[case]
    assert results(spark, fn, values) == expected


def test_per_sqm_label(spark):
    values = [1250.0, 9.96, 0.03, 1.25, 1.005, 0.125, 10.5, None]
    expected = ["€1,250/m²", "€10.0/m²", "€0.03/m²", "€1.3/m²", "€1.0/m²", "€0.13/m²", "€11/m²", None]
    assert results(spark, labels.per_sqm_label, values, "double") == expected


def test_money(spark):
    assert results(spark, labels.euro, [150000.5, 1000.0, 0.0, None], "double") == ["€150,000.5", "€1,000", "€0", None]
    assert results(spark, labels.asking, [1000.0, 0.0, None], "double") == ["€1,000", None, None]


def test_pattern_dialect():
    assert t.rx(r"a\s[\s\S]b$").startswith("a[") and r"\z" in t.rx("x$")
    assert t.rx(r"[A-Z\s]\.") == f"[A-Z{t.BLANK}]\\."


def test_blanks(spark):
    odd = ["  a\t　b  c ", " a b ", "\n", "a​b", "x   y", None]
    assert results(spark, t.clean, odd) == ["a b c", "a b", "", "a​b", "x y", None]
    assert results(spark, t.trim, odd) == ["a\t　b  c", "a b", "", "a​b", "x   y", None]
    chars = [(i, chr(i)) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000]
    every = spark.createDataFrame(chars, "id int, c string")
    blank = {r["id"] for r in every.where(F.col("c").rlike(f"[{t.BLANK}]")).collect()}
    assert blank == set(map(ord, t.BLANKS))
    assert every.where(F.col("c").rlike(f"[^{t.BLANK}<]")).count() == every.count() - len(blank) - 1
    # Only ends are looked at: a trim by pattern tries every place of the text.
    assert "regexp" not in spark.range(1).select(t.trim(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
