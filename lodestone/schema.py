"""Listing and bronze schemas."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STR, DBL, INT, LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
STRINGS = T.ArrayType(STR)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


# The canonical listing. `seq` is the visiting order of the capture; `kind` is
# explicit for both datasets.
LISTING = _struct(
    seq=LONG, source=STR, kind=STR, title=STR, price=DBL, priceDisplay=STR,
    location=STR, district=STR, image=STR, images=STRINGS, link=STR,
    houseSqm=DBL, plotSqm=DBL, beds=INT, baths=INT, posted=STR, postedTs=LONG,
    buildYear=INT, ref=STR, agent=STR, auctionDate=STR, status=STR, share=STR,
    propertyType=STR, registration=STR, plotType=STR, zone=STR,
)

# `run` numbers a walk of a source, as soon as it is complete; captures without runs are one walk.
BRONZE_JSON = _struct(
    source=STR, kind=STR, partition=STR, page_no=LONG, captured_at=T.TimestampType(), payload=STR, run=LONG,
)
BRONZE_HTML = _struct(
    source=STR, kind=STR, partition=STR, page_no=LONG, captured_at=T.TimestampType(), url=STR, html=STR, run=LONG,
)
CARD_TEXT = _struct(
    source=STR, kind=STR, partition=STR, page_no=LONG, pos=INT, id=STR, link=STR, txt=STR,
    title=STR, location=STR, priceText=STR, description=STR, image=STR, images=STRINGS,
    captured_at=T.TimestampType(), run=LONG,
)
DETAIL_HTML = _struct(source=STR, link=STR, captured_at=T.TimestampType(), html=STR)
TERMS = _struct(source=STR, term_id=INT, name=STR)
CACHE_ENTRY = _struct(
    plotSqm=DBL, houseSqm=DBL, image=STR, images=STRINGS, share=STR, propertyType=STR, registration=STR,
)
CACHE = T.StructType([T.StructField("code", STR, True), *CACHE_ENTRY.fields])
PDF_ITEMS = _struct(code=STR, doc=STR, page=INT, item_no=INT, s=STR, x=INT, y=INT)
PIXELS = _struct(image_id=STR, width=INT, height=INT, i=INT, r=INT, g=INT, b=INT)

# Raw items inside the captured JSON payloads.
MARKET_ITEM = _struct(
    id=LONG, slug=STR, title=STR, price=STR, currency=STR, created_dt=STR,
    images=T.ArrayType(_struct(url=STR, orig=STR)), attrs=T.MapType(STR, STR),
)
MARKET_PAGE = _struct(results=T.ArrayType(MARKET_ITEM), next=STR)
POST = _struct(
    id=LONG, link=STR, date=STR, title=_struct(rendered=STR),
    property_status=T.ArrayType(INT), property_city=T.ArrayType(INT),
    property_category=T.ArrayType(INT), property_action_category=T.ArrayType(INT),
    property_meta=T.MapType(STR, STRINGS),
    _embedded=T.MapType(STR, T.ArrayType(_struct(source_url=STR))),
)
POST_PAGE = T.ArrayType(POST)

# `seq` packs the place of a card in the capture: source, partition, page, position.
SEQ_BITS = 55
_PART_BITS, _PAGE_BITS, _POS_BITS = 4, 26, 20  # 5 bits are left for the source: 32 in a registry


def capture_seq(source_order: int, part_order: Column, page_no: Column, pos: Column) -> Column:
    """Stable visiting order of a card; raises where a field leaves its range."""

    def ranged(c: Column, bits: int, what: str) -> Column:
        c = c.cast("bigint")
        return F.when(c.between(0, (1 << bits) - 1), c).otherwise(
            F.raise_error(F.lit(f"{what} outside 0..2^{bits}-1")).cast("bigint")
        )

    page = F.lit(source_order).cast("bigint") * (1 << _PART_BITS) + ranged(part_order, _PART_BITS, "partition order")
    page = page * (1 << _PAGE_BITS) + ranged(page_no, _PAGE_BITS, "page_no")
    return page * (1 << _POS_BITS) + ranged(pos, _POS_BITS, "pos")


def as_listing(df: DataFrame) -> DataFrame:
    """Project to the canonical schema: missing columns become typed nulls."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in LISTING.fields
        ]
    )
