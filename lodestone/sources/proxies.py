"""Listing views over the star-schema tables, for trying the operators at scale."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema

PRIORITY = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instant(name: str) -> Column:
    """A stored wall-clock time as an instant of the session time zone."""
    return F.col(name).cast("timestamp")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Compact rows over all cores, before each of them grows into a page of text.

    A table of one small file would be one task. The count is explicit because the
    adaptive shuffle sizes partitions by bytes, and these rows are short but costly.
    """
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartition(n, F.col(key))


def null_every(n: int, c: Column, key: str = "o_orderkey") -> Column:
    return F.when(F.col(key) % n != 0, c)


def _orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    orders = table(spark, sf_dir, "orders")
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    wide = (
        orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return wide, orders.count()


def _common(n_orders: int, step: int) -> dict[str, Column]:
    k = F.col("o_orderkey")
    price = null_every(23, F.floor(F.col("o_totalprice") / step) * float(step))
    slash = F.when(k % 3 == 0, F.lit("/")).otherwise("")
    address = F.concat(F.lit("https://EX.test/p/"), (k * 7919 % (n_orders * 9 // 10)).cast("string"), slash)
    reserve = F.when(F.col("o_orderstatus") == "P", F.lit(" (reserve price)")).otherwise("")
    return {
        "seq": k,
        "source": F.col("o_orderpriority"),
        "price": price,
        "priceDisplay": F.concat(F.lit("€"), price.cast("bigint").cast("string"), reserve),
        "location": null_every(31, F.concat_ws(", ", "n_name", "r_name")),
        "district": F.when(~F.col("n_name").endswith("7"), F.col("r_name")),
        "image": F.when(k % 7 == 1, F.lit("")).otherwise(
            null_every(7, F.concat(F.lit("https://img.test/"), k.cast("string"), F.lit(".jpg")))
        ),
        "link": null_every(11, address),
        "posted": F.element_at(
            F.array(*[F.lit(p) for p in ("today", "yesterday", "3 days ago", "2 weeks ago", "5 hours ago", None)]),
            (k % 6 + 1).cast("int"),
        ),
        "postedTs": F.when(k % 4 == 0, F.unix_millis(instant("o_orderdate"))),
        "ref": F.concat(F.lit("R"), k.cast("string")),
        "auctionDate": F.when(F.col("o_orderstatus") == "P", F.date_format(instant("o_orderdate"), "dd/MM/yyyy")),
    }


def houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One house per order, with collisions in price, area and link."""
    wide, n = _orders(spark, sf_dir)
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    own = {
        "kind": F.lit("house"),
        "title": F.concat((1 + cust % 6).cast("string"), F.lit(" bedroom house, "), F.col("c_mktsegment")),
        "houseSqm": null_every(5, (60 + k * 37 % 240).cast("double")),
        "plotSqm": F.when(k % 29 == 0, F.lit(0.0)).otherwise(null_every(13, (200 + k * 53 % 1800).cast("double"))),
        "beds": null_every(17, 1 + cust % 6),
        "baths": null_every(10, 1 + k % 3),
        "buildYear": null_every(19, 1950 + cust % 75),
        "propertyType": F.when(F.col("o_orderstatus") == "F", F.lit("Residence")),
        "share": F.when(k % 4 == 0, F.lit("1/1")).when(k % 4 == 1, F.lit("1/2")),
    }
    return _listing(wide, _common(n, 5000) | own)


def plots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One plot per order."""
    wide, n = _orders(spark, sf_dir)
    k = F.col("o_orderkey")
    own = {
        "kind": F.lit("plot"),
        "title": F.concat(F.lit("Plot, "), F.col("c_mktsegment")),
        "plotSqm": null_every(13, (200 + k * 53 % 1800).cast("double")),
        "plotType": F.element_at(
            F.create_map(*[F.lit(x) for x in ("F", "Residential", "O", "Agricultural", "P", "Commercial")]),
            F.col("o_orderstatus"),
        ),
        "zone": F.when(k % 5 == 0, F.concat(F.lit("Ka"), (k % 9).cast("string"))),
    }
    return _listing(wide, _common(n, 20000) | own)


def _listing(wide: DataFrame, fields: dict[str, Column]) -> DataFrame:
    return schema.as_listing(wide.select(*[c.alias(name) for name, c in fields.items()]))
