"""Sales panel, raw sales and event calendars derived from the given parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (date, store_nbr, family): region of the supplier is the store, part type the family.

    No join hints: the dimensions grow with the data, so Catalyst and AQE pick broadcast or shuffle
    by measured size, and AQE splits a hot part or supplier. Each join has a plain table on its right:
    the estimate for a join of two dimensions is their product, which would make the fact table look
    like the smaller side. The final aggregate combines map-side.
    """
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        "l_partkey",
        F.col("l_shipdate").cast("date").alias("date"),
        "l_quantity",
        F.when(F.col("l_discount") > 0.085, 1).otherwise(0).alias("promo"),
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_regionkey") + 1).cast("int").alias("store_nbr"))
    families = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("family"))
    return (
        items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(families, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("date", "store_nbr", "family")
        .agg(F.sum("l_quantity").alias("sales"), F.sum("promo").alias("onpromotion"))
    )


def _series(store: int, family: str) -> Column:
    return (F.col("store_nbr") == store) & (F.col("family") == family)


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel made dirty: nulls, negatives, spikes and duplicates, in one pass over the panel."""
    day, month, date = F.dayofmonth("date"), F.month("date"), F.col("date")
    negative = _series(5, "LARGE") & (day == 1)
    june = _series(4, "SMALL") & (month == 6)
    null = F.lit(None).cast("double")
    sales = (
        F.when(_series(1, "PROMO") & (day == 10), null)
        .when(_series(2, "PROMO") & date.between("1997-03-01", "1997-03-25"), null)
        .when(_series(3, "PROMO") & date.between("1998-01-01", "1998-12-31"), null)
        .when(june & (day == 10), F.col("sales") * 1000)
        .when(june & day.between(11, 12), F.col("sales") * 100)
        .when(negative, F.lit(-5.0))
        .otherwise(F.col("sales"))
    )
    promo = F.when(negative, F.lit(-2).cast("bigint")).otherwise(F.col("onpromotion"))
    dirty = F.struct(sales.alias("sales"), promo.alias("onpromotion"))
    clean = F.struct("sales", "onpromotion")
    doubled = _series(1, "SMALL") & (day == 15)
    return sales_panel(spark, sf_dir).select(
        "date", "store_nbr", "family", F.inline(F.when(doubled, F.array(dirty, clean)).otherwise(F.array(dirty)))
    )


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sales as an uploaded file would hold them: all text, with unreadable cells."""
    raw, null_sales = raw_sales(spark, sf_dir), F.col("sales").isNull()
    text = {c: F.col(c).cast("string") for c in raw.columns}
    return raw.select(
        F.when((F.col("store_nbr") == 3) & (F.dayofmonth("date") == 31), "bad-date").otherwise(text["date"]).alias("date"),
        text["store_nbr"].alias("store_nbr"),
        "family",
        F.when(null_sales & (F.col("store_nbr") == 1), "NaN").when(null_sales, "n/a").otherwise(text["sales"]).alias("sales"),
        F.when((F.col("store_nbr") == 2) & (F.dayofmonth("date") == 5), "many").otherwise(text["onpromotion"]).alias("onpromotion"),
    )


# The event calendar that goes with the raw sales.
_CALENDAR = """
select cast(d as date) as date, type, locale, description, transferred from (values
  ('1995-12-25','Holiday','National','Xmas',false),
  ('1996-12-25','Holiday','National','Xmas',false),
  ('1997-12-25','Holiday','National','Xmas',true),
  ('1997-12-26','Transfer','National','Xmas moved',false),
  ('1998-12-25','Holiday','National','Xmas',false),
  ('1999-06-10','Event','National','Fair',false),
  ('2000-06-10','Additional','Local','Town day',false),
  ('2000-01-03','Work Day','National','Make-up',false),
  ('2000-12-26','Bridge','National','Bridge',false)
) as v(d, type, locale, description, transferred)
"""


def calendar(spark: SparkSession) -> DataFrame:
    return spark.sql(_CALENDAR)


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar as large as the orders table: order priorities stand for event types."""
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.when(priority == "1-URGENT", "Holiday")
        .when(priority == "2-HIGH", "Event")
        .when(priority == "3-MEDIUM", "Additional")
        .when(priority == "4-NOT SPECIFIED", "Transfer")
        .otherwise("Work Day")
        .alias("type"),
        F.lit("National").alias("locale"),
        F.concat(F.lit("Event "), F.pmod(F.col("o_custkey"), F.lit(100)).cast("string")).alias("description"),
        (F.col("o_orderstatus") == "P").alias("transferred"),
    )
