"""Enrichment joins: cache by code, detail pages by link, term names by id."""

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions import labels, numbers as n, text as t
from ..sources.readers import json_ld
from .skew import HOT_ROWS, HotKeys

# --- detail pages ------------------------------------------------------------

DETAIL_FIELDS = ("price", "houseSqm", "plotSqm", "beds", "baths", "buildYear")


def _altamira(h: Column) -> dict[str, Column]:
    return {
        "plotSqm": n.grab_number(h, r'(?i)class="superf_land">\s*([\d,]+)\s*m'),
        "beds": n.grab_number(h, r'(?i)class="hab">\s*(\d+)'),
        "baths": n.grab_number(h, r'(?i)class="ban">\s*(\d+)'),
        "buildYear": n.year_between(n.grab_number(h, r"(?i)built[^.]{0,20}?\b((?:18|19|20)\d{2})\b")),
    }


def _realting(h: Column) -> dict[str, Column]:
    ld = json_ld(h, "floorSize", "yearBuilt")

    def table(label: str) -> Column:
        return n.positive(
            n.number(n.drop_chars(t.labelled(h, "(?i)>", label, r"</div>\s*<div>\s*", r"[\d,]+"), ","))
        )

    def linked(path: str) -> Column:
        return n.number(F.get_json_object(ld, path))

    return {
        "plotSqm": table("Land area"),
        "houseSqm": F.coalesce(table("Total area"), linked("$.floorSize.value")),
        "baths": F.coalesce(table("Bathrooms"), linked("$.numberOfFullBathrooms")),
        "buildYear": n.year_between(F.coalesce(table("The year of construction"), linked("$.yearBuilt"))),
    }


def _apits(h: Column) -> dict[str, Column]:
    return {
        "houseSqm": n.grab_number(h, r"(?i)Property Size:\s*([\d,]+)", ",."),
        "plotSqm": F.coalesce(
            n.grab_number(h, r"(?i)Land Area:\s*([\d,]+)", ",."), n.grab_number(h, r"(?i)Plot size:\s*([\d,]+)", ",.")
        ),
        "baths": n.grab_number(h, r"(?i)Bathrooms:\s*(\d+)", ",."),
    }


def _kadis(h: Column) -> dict[str, Column]:
    return {"plotSqm": n.positive(n.half_up(n.number(n.drop_chars(t.grab(h, r"(?i)Plot Area\s*([\d,.]+)\s*m2"), ","))))}


def _giovani(h: Column) -> dict[str, Column]:
    def block(label: str) -> Column:
        return t.labelled(h, "<strong>", label, r"\s*:?\s*</strong>\s*(?:<span>)?\s*", r"[^<]+")

    return {
        "price": n.price_digits(block("Price")),
        "houseSqm": n.rounded_number(block("Property Size")),
        "plotSqm": n.rounded_number(block("Property Lot Size")),
        "beds": n.rounded_number(block("Bedrooms")),
        "baths": n.rounded_number(block("Bathrooms")),
    }


DETAIL_PAGES: dict[str, Callable[[Column], dict[str, Column]]] = {
    "Altamira Real Estate": _altamira,
    "Realting": _realting,
    "A Place in the Sun": _apits,
    "Kadis Estates": _kadis,
    "Giovani Homes": _giovani,
}

# How a detail value meets the card's value, per source and field:
#   overwrite  the detail page decides, also when it has nothing
#   fill       only where the card has nothing
#   set        only where the detail page has something
MERGE_POLICY: dict[str, dict[str, str]] = {
    "Altamira Real Estate": {"plotSqm": "overwrite", "beds": "fill", "baths": "fill", "buildYear": "set"},
    "Realting": {"plotSqm": "overwrite", "houseSqm": "fill", "baths": "overwrite", "buildYear": "overwrite"},
    "A Place in the Sun": {"houseSqm": "overwrite", "plotSqm": "overwrite", "baths": "fill"},
    "Kadis Estates": {"plotSqm": "set"},
    "Giovani Homes": {f: "overwrite" for f in ("price", "houseSqm", "plotSqm", "beds", "baths")},
}
# Sources that publish only listings priced on their detail page.
PRICED_ON_DETAIL = ("Giovani Homes",)


def merged(current: Column, detail: Column, seen: Column, policy: str) -> Column:
    if policy == "overwrite":
        return F.when(seen, detail).otherwise(current)
    return F.coalesce(current, detail) if policy == "fill" else F.coalesce(detail, current)


def detail_fields(detail_html: DataFrame) -> DataFrame:
    """Typed fields of the newest capture of each detail page; the page text stays behind."""
    found = {source: fields(F.col("html")) for source, fields in DETAIL_PAGES.items()}

    def value(field: str) -> Column:
        own = [F.when(F.col("source") == s, f[field].cast("double")) for s, f in found.items() if field in f]
        return F.coalesce(*own, F.lit(None).cast("double")).alias(f"d_{field}")

    parts = detail_html.where(F.col("source").isin(*DETAIL_PAGES)).select(
        "source", "link", "captured_at", F.xxhash64("html").alias("_tie"), *[value(f) for f in DETAIL_FIELDS]
    )
    # Captures of the same time have an order of their own, so a rerun picks the same one.
    newest = Window.partitionBy("source", "link").orderBy(F.col("captured_at").desc(), "_tie")
    return (
        parts.withColumn("_copy", F.row_number().over(newest))
        .where(F.col("_copy") == 1)
        .drop("_copy", "captured_at", "_tie")
        .withColumn("d_seen", F.lit(True))
    )


def _join(
    rows: DataFrame, side: DataFrame, on: tuple[str, ...], n_rows: int | None, hot_rows: int, stored: bool = False
) -> DataFrame:
    """Left join of listings with a side that has one row per key. With the number of
    rows known, hot keys are found and sliced; else skew is left to the adaptive join."""
    hot = HotKeys(on, None) if n_rows is None else HotKeys.find(rows, on, n_rows, hot_rows, "seq")
    return hot.left_join_stored(rows, side) if stored else hot.left_join(rows, side, "seq")


def store_keyed(side: DataFrame, table: str, path: str, key: tuple[str, ...], buckets: int) -> DataFrame:
    """Write a cache or detail table in sorted buckets of its key and return it.

    Joins on the key (``stored=True``) shuffle the listings only, if there are at least as many
    buckets as shuffle partitions; with fewer Spark takes the shuffle for the better plan.
    """
    (
        side.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).option("path", path)
        .mode("overwrite").saveAsTable(table)
    )
    return side.sparkSession.table(table)


def merge_details(
    listings: DataFrame, details: DataFrame, n_rows: int | None = None, hot_rows: int = HOT_ROWS, stored: bool = False
) -> DataFrame:
    """Left join by link with each source's merge policy; rows that cannot match skip the shuffle.

    ``stored`` says that the details are a table of `store_keyed` by source and link.
    """
    asks = F.coalesce(
        F.col("source").isin(*MERGE_POLICY)
        & F.col("link").isNotNull()
        & (F.col("link") != fixed.SITES["Altamira Real Estate"]),
        F.lit(False),
    )
    joined = _join(listings.where(asks), details, ("source", "link"), n_rows, hot_rows, stored)
    seen = F.col("d_seen").isNotNull()
    values = {}
    for field in DETAIL_FIELDS:
        value = F.col(field)
        for source, policy in MERGE_POLICY.items():
            if field in policy:
                new = merged(F.col(field), F.col(f"d_{field}"), seen, policy[field])
                value = F.when(F.col("source") == source, new).otherwise(value)
        values[field] = value.try_cast(listings.schema[field].dataType)
    joined = joined.withColumns(values)
    both = joined.select(*listings.columns).unionByName(listings.where(~asks))
    late = F.col("source").isin(*PRICED_ON_DETAIL)
    return both.where(F.coalesce(~late, F.lit(True)) | labels.given(F.col("price"))).withColumn(
        "priceDisplay", F.when(late, labels.asking(F.col("price"))).otherwise(F.col("priceDisplay"))
    )


# --- keyed cache -----------------------------------------------------------------

CACHE_FIELDS = ("image", "images", "houseSqm", "plotSqm", "share", "propertyType", "registration")


def merge_cache(
    listings: DataFrame, cache: DataFrame, source: str = "eAuction Cyprus", n_rows: int | None = None, hot_rows: int = HOT_ROWS,
    stored: bool = False,
) -> DataFrame:
    """Left join of one source's listings with the cache by code; an unmatched row gets nulls.

    ``stored`` says that the cache is a table of `store_keyed` by code.
    """
    own = F.col("source") == source
    facts = cache.select(F.col("code").alias("ref"), *[F.col(f).alias(f"c_{f}") for f in CACHE_FIELDS])
    joined = _join(listings.where(own), facts, ("ref",), n_rows, hot_rows, stored)
    joined = joined.withColumns({f: F.col(f"c_{f}").cast(listings.schema[f].dataType) for f in CACHE_FIELDS})
    return joined.select(*listings.columns).unionByName(listings.where(F.coalesce(~own, F.lit(True))))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New non-null fields override, others stay; keys of either side survive."""
    fields = [c for c in old.columns if c != key]
    fresh = new.select(key, *[F.col(c).alias(f"n_{c}") for c in fields])
    return old.join(fresh, key, "full_outer").select(
        key, *[F.coalesce(F.col(f"n_{c}"), F.col(c)).alias(c) for c in fields]
    )


# --- term names -------------------------------------------------------------------

def lookup_names(
    df: DataFrame, row_key: list[str], ids: Column, terms: DataFrame, out: str,
    n_ids: int | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Names for an array of ids, in id order; ids without a name are left out.

    ``n_ids`` is the number of ids in all rows, where known: then hot terms are sliced.
    """
    wide = df.select(*row_key, F.posexplode(ids).alias("_at", "term_id"))
    hot = HotKeys(("term_id",), None) if n_ids is None else HotKeys.find(wide, ("term_id",), n_ids, hot_rows, *row_key, "_at")
    named = (
        hot.left_join(wide, terms.select("term_id", "name"), *row_key)
        .where(F.col("name").isNotNull())
        .groupBy(*row_key)
        .agg(F.sort_array(F.collect_list(F.struct("_at", "name"))).alias("_named"))
        .select(*row_key, F.col("_named")["name"].alias(out))
    )
    return df.join(named, row_key, "left")


# A taxonomy of at most this many terms stands in the plan as one constant map.
TERMS_IN_PLAN = 5_000
TERM_FIELDS = ("property_status", "property_city", "property_category", "property_action_category")
_CARD = ["partition", "page_no", "captured_at", "pos"]


def term_names(
    df: DataFrame, source: str, terms: DataFrame | None
) -> tuple[DataFrame, Callable[[Column], Column]]:
    """The items, and a function from a column of their term ids to a column of names.

    A short taxonomy becomes a constant map; of a longer one each item is given the names of its own
    ids by a join (`_names`), so no taxonomy has to fit anywhere as a whole. Of a term id with
    several names the first by code point counts. A source that needs names and has no
    taxonomy fails, as its listings would be incomplete.
    """
    own, found = [], None
    if terms is not None and "item" in df.columns:
        usable = (F.col("source") == source) & F.col("term_id").isNotNull() & F.col("name").isNotNull()
        found = terms.where(usable).groupBy("term_id").agg(F.min("name").alias("name"))
        own = found.limit(TERMS_IN_PLAN + 1).collect()
    joined = len(own) > TERMS_IN_PLAN
    if joined:
        df = _with_names(df, found)

    def names(ids: Column) -> Column:
        if not own:
            raise LookupError(f"no taxonomy for {source}")
        if joined:
            known = F.col("_names")
        else:
            known = F.from_json(F.lit(json.dumps({str(r["term_id"]): r["name"] for r in own})), "map<string,string>")
        return F.transform(ids, lambda i: F.try_element_at(known, i.cast("string")))

    return df, names


def _with_names(df: DataFrame, terms: DataFrame) -> DataFrame:
    """Adds `_names`, the names of all term ids of an item, as a map; items of the same place share theirs."""
    ids = F.flatten(F.array(*[F.coalesce(F.col(f"item.{f}"), F.array().cast("array<int>")) for f in TERM_FIELDS]))
    place = F.xxhash64(*[x for c in _CARD for x in (F.col(c).isNull(), F.col(c))])
    df = df.withColumn("_place", place)
    wide = df.select("_place", F.explode(ids).alias("term_id")).distinct().join(terms, "term_id")
    entry = F.struct(F.col("term_id").cast("string").alias("key"), F.col("name").alias("value"))
    named = wide.groupBy("_place").agg(F.map_from_entries(F.collect_list(entry)).alias("_names"))
    return df.join(named, "_place", "left").drop("_place").withColumn("_names", F.coalesce("_names", F.create_map().cast("map<string,string>")))
