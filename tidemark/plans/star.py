"""The sales star laid over the order tables of the test data.

Lines with status F are store sales, those with status O web sales. The order
is the date key, the part the item, the supplier the store, and the supplier's
nation the web site.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sales import STORE, WEB, Channel
from tidemark.sources.writers import stamp

RUN_DATE = "2024-02-01"

def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(amount: str) -> Column:
    return F.rint(F.col(amount) * 100).cast("long")


def _percent_of(cents: Column, percent: Column) -> Column:
    """Part of an amount, rounded half up to a cent."""
    return F.floor((cents * percent + 50) / 100)


def _fact(lines: DataFrame, outlet_key: Column, channel: Channel) -> DataFrame:
    """Fact rows with whole cents: exact in any order, and summed as longs."""
    price = _cents("l_extendedprice")
    tax = _percent_of(price, _cents("l_tax"))
    coupon = _percent_of(price, _cents("l_discount"))
    columns = {
        "sold_date_sk": F.col("l_orderkey"),
        "item_sk": F.col("l_partkey"),
        channel.outlet_key: outlet_key,
        "quantity": F.col("l_quantity").cast("int"),
        "ext_wholesale_cost": _percent_of(price, F.lit(75)),
        "ext_list_price": price,
        "ext_ship_cost": _percent_of(price, F.lit(5)),
        "ext_tax": tax,
        "coupon_amt": coupon,
        "net_paid": price - coupon,
        "net_paid_inc_tax": price - coupon + tax,
    }
    if not channel.ships:
        del columns["ext_ship_cost"]
    return stamp(
        lines.select(*[c.alias(f"{channel.prefix}_{n}") for n, c in columns.items()]), RUN_DATE)


def sales_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six tables ``sales_lines`` joins; amounts in cents."""
    lines, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    supplier = load(spark, sf_dir, "supplier")
    web_lines = lines.where(F.col("l_linestatus") == "O").join(
        supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), on="l_suppkey")
    day = F.col("o_orderdate").cast("date")
    return {
        "store_sales": _fact(
            lines.where(F.col("l_linestatus") == "F"), F.col("l_suppkey"), STORE),
        "web_sales": _fact(web_lines, F.col("s_nationkey"), WEB),
        "date_dim": orders.select(
            F.col("o_orderkey").alias("d_date_sk"),
            day.alias("d_date"),
            F.year(day).alias("d_year"),
            F.concat(F.year(day), F.lit("Q"), F.quarter(day)).alias("d_quarter_name"),
        ),
        "item": load(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("i_item_sk"),
            F.col("p_brand").alias("i_brand"),
            F.col("p_type").alias("i_manufact"),
            F.col("p_name").alias("i_product_name"),
        ),
        "store": supplier.select(
            F.col("s_suppkey").alias("s_store_sk"), F.col("s_name").alias("s_store_name")),
        "web_site": load(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("web_site_sk"), F.col("n_name").alias("web_name")),
    }
