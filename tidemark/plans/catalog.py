"""The registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.durable import scratch_path
from tidemark.functions import columns
from tidemark.operators import (
    cleaning,
    drift,
    features,
    quality,
    sales,
    scoring,
    stability,
    suites,
    synth,
    training,
)
from tidemark.plans import flows
from tidemark.plans.star import RUN_DATE, load, sales_star
from tidemark.sources import keyed, readers, writers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL."""
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        SQL[build.__name__] = sql
        return build
    return register


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in names})


# ------------------------------------------------------------------ sales

_RATE = "cast(cast(l_extendedprice as decimal(8,2)) * cast({} as decimal(3,2)) as decimal(8,2))"
_LINES_SQL = f"""
with priced as (
  select l_orderkey, l_partkey, l_suppkey, l_linestatus,
    cast(l_quantity as int) as sold_quantity,
    cast(l_extendedprice as decimal(8,2)) as ext_list_price,
    {_RATE.format('0.75')} as ext_wholesale_cost,
    {_RATE.format('0.05')} as ship,
    {_RATE.format('l_tax')} as ext_tax,
    {_RATE.format('l_discount')} as coupon_amt
  from lineitem),
lines as (
  select date '{RUN_DATE}' as partition_date, cast(o_orderdate as date) as date,
    cast(year(o_orderdate) as int) as year,
    concat(year(o_orderdate), 'Q', quarter(o_orderdate)) as quarter_name,
    p_brand as brand, p_type as manufact, p_name as product_name,
    case when l_linestatus = 'F' then 'Store' else 'Web' end as source,
    case when l_linestatus = 'F' then s_name else n_name end as store_name,
    sold_quantity, ext_wholesale_cost, ext_list_price,
    case when l_linestatus = 'F' then 0.0 else cast(ship as double) end as ext_ship_cost,
    ext_tax, coupon_amt,
    ext_list_price - coupon_amt as net_paid,
    ext_list_price - coupon_amt + ext_tax as net_paid_inc_tax
  from priced join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
    join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  where l_linestatus in ('F', 'O'))
"""
_MONEY = ["ext_wholesale_cost", "ext_list_price", "ext_ship_cost", "ext_tax", "coupon_amt",
          "net_paid", "net_paid_inc_tax"]


def _totals_sql(keys) -> str:
    money = ", ".join(f"round(cast(sum({m}) as double), 2) as total_{m}" for m in _MONEY)
    return (f"{_LINES_SQL} select {', '.join(keys)}, "
            f"cast(sum(sold_quantity) as bigint) as total_sold_quantity, {money} "
            f"from lines group by {', '.join(keys)}")


def _in_units(df: DataFrame, prefix: str = "") -> DataFrame:
    """Cents as an amount with two decimals."""
    return df.withColumns({prefix + m: F.col(prefix + m) / 100.0 for m in _MONEY})


def _cube(spark, sf_dir) -> DataFrame:
    return sales.sales_cube(**sales_star(spark, sf_dir))


@query(_totals_sql(sales.CUBE_KEYS))
def sales_curated(spark, sf_dir):
    return _in_units(_cube(spark, sf_dir), "total_")


@query(_totals_sql(("year", "brand", "source")))
def sales_by_brand(spark, sf_dir):
    lines = sales.sales_lines(**sales_star(spark, sf_dir))
    totals = sales.sales_totals(lines, ["year", "brand", "source"])
    return _in_units(totals, "total_")


@query(_LINES_SQL + "select * replace (" + ", ".join(
    f"round(cast({m} as double), 2) as {m}" for m in _MONEY) + ") from lines")
def sales_lines(spark, sf_dir):
    return _in_units(sales.sales_lines(**sales_star(spark, sf_dir)))


# ------------------------------------------------- reading and writing tables

_INGESTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@query(" union all ".join(
    f"select '{t}' as name, date '{RUN_DATE}' as partition_date, count(*) as n_rows from {t}"
    for t in _INGESTED))
def ingest_bulk(spark, sf_dir):
    root = scratch_path(spark, "raw")
    writers.ingest_tables({t: load(spark, sf_dir, t) for t in _INGESTED}, root, run_date=RUN_DATE)
    counts = None
    for t in _INGESTED:
        written = readers.read_table(spark, f"{root}/{t}").groupBy("partition_date").agg(
            F.count(F.lit(1)).alias("n_rows"))
        line = written.select(F.lit(t).alias("name"), "partition_date", "n_rows")
        counts = line if counts is None else counts.unionByName(line)
    return counts


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, "
       "cast(year(o_orderdate) as int) as o_year from orders")
def layer_roundtrip(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate")).drop(
        "o_orderdate")
    path = scratch_path(spark, "layer")
    writers.write_table(orders, path, partition_by="o_year", rebalance=True)
    again = readers.read_table(spark, path)
    writers.rebuild_table(again, path, partition_by="o_year", reads_target=True, rebalance=True)
    return readers.read_table(spark, path)


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def csv_roundtrip(spark, sf_dir):
    customer = load(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv")
    customer.write.option("header", True).csv(path)
    return readers.read_csv(spark, path, customer.schema)


def _events(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias("day"))


_EVENTS_SQL = ("select event_id, user_id, event_type, value, cast(ts as date) as day from events")


@query(f"select * from ({_EVENTS_SQL}) where day = date '2024-01-15'")
def read_partition(spark, sf_dir):
    path = scratch_path(spark, "events")
    writers.write_table(_events(spark, sf_dir), path, partition_by="day", rebalance=True)
    return readers.read_partition(spark, path, dt.date(2024, 1, 15), "day")


@query(_EVENTS_SQL)
def append_partitions(spark, sf_dir):
    events, path = _events(spark, sf_dir), scratch_path(spark, "events")
    for part in (F.col("day") <= "2024-01-15", F.col("day") > "2024-01-15"):
        writers.write_table(events.where(part), path, partition_by="day", mode="append",
                            rebalance=True)
    return readers.read_table(spark, path)


@query(_EVENTS_SQL)
def append_idempotent(spark, sf_dir):
    events, path = _events(spark, sf_dir), scratch_path(spark, "events")
    first_half = events.where(F.col("day") <= "2024-01-15")
    for batch in (first_half, events, events):
        writers.append_new_days(batch, path, day_col="day", rebalance=True)
    return readers.read_table(spark, path)


def _u(column: str, day: str, row: str) -> str:
    text = f"concat_ws('|', '7', '{column}', cast({day} as varchar), cast({row} as varchar))"
    return f"(cast(('0x' || substr(md5({text}), 1, 8)) as bigint) / 4294967295.0)"


def _draw_sql(column: str, kind: str, day: str = "day", row: str = "id") -> str:
    u = _u(column, day, row)
    if kind == "int":
        return (f"least(cast(floor(cast({column}_lo as double) + {u} * "
                f"cast({column}_hi - {column}_lo + 1 as double)) as bigint), {column}_hi)")
    if kind == "double":
        return f"({column}_lo + {u} * ({column}_hi - {column}_lo))"
    size = f"len({column}_list)"
    return f"{column}_list[least(cast(floor({u} * {size}) as bigint) + 1, {size})]"


@query(f"""
with held as ({_EVENTS_SQL}),
p as (select min(user_id) as user_id_lo, max(user_id) as user_id_hi, min(value) as value_lo,
        max(value) as value_hi, list_sort(list(distinct event_type)) as event_type_list,
        count(*) // 30 as n from held),
gaps as (select cast(d as date) as day
  from generate_series(date '2023-12-25', date '2024-02-05', interval 1 day) g(d)
  where cast(d as date) not in (select day from held)),
ids as (select i as id, day, p.* from p, gaps, range(1, (select n + 1 from p)) r(i))
select event_id, user_id, event_type, round(value, 6) as value, day from held
union all
select id as event_id, {_draw_sql('user_id', 'int')} as user_id,
  {_draw_sql('event_type', 'text')} as event_type,
  round({_draw_sql('value', 'double')}, 6) as value, day from ids
""")
def backfill_dates(spark, sf_dir):
    events, path = _events(spark, sf_dir), scratch_path(spark, "events")
    writers.write_table(events, path, partition_by="day", rebalance=True)
    profile = synth.profile_table(events, exclude=["event_id", "day"])
    rows_per_day = events.count() // 30

    def make_rows(days):
        return synth.synth_rows(spark, profile, days, rows_per_day=rows_per_day, seed=7,
                                id_col="event_id", day_col="day")

    writers.backfill_days(spark, "2023-12-25", "2024-02-05", path, make_rows, day_col="day")
    return rounded(readers.read_table(spark, path), 6, "value")


@query("""
with spent as (select o_custkey as k, cast(sum(cast(o_totalprice as decimal(10,2))) as double) as s
               from orders group by o_custkey),
source as (select k as c_custkey, s as c_acctbal from spent
  union all select -1 - s_suppkey, s_acctbal from supplier)
select c_custkey, c_acctbal from source
union all
select c_custkey, c_acctbal from customer where c_custkey not in (select c_custkey from source)
""")
def upsert_by_key(spark, sf_dir):
    path = scratch_path(spark, "accounts")
    accounts = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    keyed.create_keyed_table(accounts, path, ["c_custkey"])
    spent = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(10,2)")).cast("double").alias("c_acctbal"))
    opened = load(spark, sf_dir, "supplier").select(
        (F.lit(-1) - F.col("s_suppkey")).alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    keyed.upsert_table(spark, path, spent.unionByName(opened), ["c_custkey"])
    return readers.read_table(spark, path)


_ORDER_YEARS = "cast(date_trunc('year', o_orderdate) as date) as day"


def _orders_by_year(spark, sf_dir, *columns) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        *columns, F.trunc(F.col("o_orderdate").cast("date"), "year").alias("day"))


@query(f"""
with o as (select *, {_ORDER_YEARS} from orders)
select o_orderkey, o_custkey, case when year(day) in (1998, 1999) then o_totalprice / 2 else o_totalprice end
    as o_totalprice, case when year(day) in (1998, 1999) then o_orderpriority end as note, day
from o where year(day) < 2000
union all
select -o_orderkey, o_custkey, o_totalprice, o_orderstatus, day from o where year(day) = 1999
""")
def upsert_partitioned(spark, sf_dir):
    """Two of the years are touched; a column comes, another becomes wider."""
    path, keys = scratch_path(spark, "orders"), ["o_orderkey", "day"]
    orders = _orders_by_year(spark, sf_dir, "o_orderkey", "o_custkey", "o_totalprice",
                             "o_orderpriority", "o_orderstatus")
    start = orders.where(F.year("day") < 2000).select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), "o_totalprice", "day")
    keyed.create_keyed_table(start, path, keys, partition_by="day")
    some = orders.where(F.year("day").isin(1998, 1999))
    halved = some.select("o_orderkey", "o_custkey", (F.col("o_totalprice") / 2).alias("o_totalprice"),
                         F.col("o_orderpriority").alias("note"), "day")
    added = some.where(F.year("day") == 1999).select(
        (-F.col("o_orderkey")).alias("o_orderkey"), "o_custkey", "o_totalprice",
        F.col("o_orderstatus").alias("note"), "day")
    keyed.upsert_table(spark, path, halved.unionAll(added), keys, partition_by="day")
    return readers.read_table(spark, path)


@query(f"""
select o_orderkey, o_custkey, o_totalprice, day,
  case when year(day) in (1996, 1998) then o_orderpriority end as remark,
  case when year(day) >= 1997 then o_orderstatus end as state
from (select *, {_ORDER_YEARS} from orders) where o_custkey % 7 <> 0 or year(day) not in (1996, 1998)
""")
def append_widening(spark, sf_dir):
    """The daily job over years: a column is empty at first, then has values, or nulls in some rows,
    is empty again, another comes late, and one gets wider."""
    raw, path = scratch_path(spark, "raw"), scratch_path(spark, "enriched")
    years = F.year("day")
    orders = _orders_by_year(spark, sf_dir, "o_orderkey", "o_custkey", "o_totalprice",
                             "o_orderpriority", "o_orderstatus")
    rows = orders.select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), "o_totalprice",
        F.when(years.isin(1996, 1998) & (F.col("o_custkey") % 7 != 0), F.col("o_orderpriority")).alias("remark"),
        F.when(years >= 1997, F.col("o_orderstatus")).alias("state"), "day")
    writers.write_table(rows, raw, partition_by="day", rebalance=True)
    days = [r.day for r in rows.select("day").distinct().orderBy("day").collect()]
    for day in [*days[:-1], *days[:-1]]:  # the second time adds nothing
        flows.house_enriched(spark, raw, path, ["o_orderkey", "day"], day, day_col="day")
    last = rows.where(F.col("day") == F.lit(days[-1])).withColumn("o_custkey", F.col("o_custkey").cast("long"))
    writers.append_new_days(cleaning.clean(last), path, day_col="day", day=days[-1], widen=True)
    return readers.read_table(spark, path)


@query(f"""
select o_orderkey, o_custkey, day,
  cast(o_orderpriority = '1-URGENT' as int) as "1-URGENT", cast(o_orderpriority = '2-HIGH' as int) as "2-HIGH",
  cast(o_orderpriority = '3-MEDIUM' as int) as "3-MEDIUM",
  cast(o_orderpriority = '4-NOT SPECIFIED' as int) as "4-NOTSPECIFIED", cast(o_orderpriority = '5-LOW' as int) as "5-LOW"
from (select *, {_ORDER_YEARS} from orders)
where case when year(day) < 1998 then o_orderpriority not in ('1-URGENT', '5-LOW') else o_orderpriority <> '2-HIGH' end
""")
def feature_increments(spark, sf_dir):
    """Three runs: a first one, one with categories that are new and one that is missing, and one again."""
    path, store, keys = scratch_path(spark, "features"), scratch_path(spark, "store"), ["o_orderkey", "day"]
    orders = _orders_by_year(spark, sf_dir, "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    priority = F.col("o_orderpriority")
    historical = orders.where((F.year("day") < 1998) & ~priority.isin("1-URGENT", "5-LOW"))
    daily = orders.where((F.year("day") >= 1998) & (priority != "2-HIGH"))
    for rows in (daily.limit(0), daily, daily):
        flows.build_features(spark, historical, rows, path, store, keys, "o_orderpriority", "o_totalprice", "day")
    built, merged = (flows.read_features(spark, p, flows.registry_of(path), "o_orderpriority") for p in (path, store))
    # The two tables hold the same rows: what one has more often than the other would be added.
    return merged.unionByName(built.exceptAll(merged.select(built.columns)))


@query("select c_custkey, c_nationkey, c_acctbal from customer")
def feature_table(spark, sf_dir):
    path = scratch_path(spark, "features")
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    keyed.create_keyed_table(rows, path, ["c_custkey"])
    return readers.read_table(spark, path)


_PRIORITIES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]


@query("""
select o_orderkey, cast(rank as int) as rank from orders join (values """ + ", ".join(
    f"('{p}', {r})" for p, r in _PRIORITIES) + """) v(priority, rank) on o_orderpriority = priority
""")
def inline_rows(spark, sf_dir):
    ranks = readers.inline_rows(spark, _PRIORITIES, "o_orderpriority string, rank int")
    return load(spark, sf_dir, "orders").join(ranks, on="o_orderpriority").select(
        "o_orderkey", "rank")


@query("select o_orderkey, o_custkey, o_totalprice from orders "
       "order by o_custkey, o_orderkey limit 20")
def preview(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return readers.preview(orders, 20, ["o_custkey", "o_orderkey"])


# ---------------------------------------------------------- profile and synthesis

_NUMBERS = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
            "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
            "l_discount": "double", "l_tax": "double"}


@query(" union all ".join(
    f'select \'{c}\' as "column", \'{t}\' as dtype, cast(min({c}) as double) as min, '
    f"cast(max({c}) as double) as max from lineitem" for c, t in _NUMBERS.items()))
def profile_table(spark, sf_dir):
    return synth.numeric_profile(load(spark, sf_dir, "lineitem"))


@query(" union all ".join(
    f'select distinct \'{c}\' as "column", {c} as value from orders'
    for c in ("o_orderstatus", "o_orderpriority")))
def profile_distinct(spark, sf_dir):
    return synth.value_profile(load(spark, sf_dir, "orders"),
                               ["o_orderstatus", "o_orderpriority"])


@query(f"""
with p as (select min(p_size) as p_size_lo, max(p_size) as p_size_hi,
    min(p_retailprice) as p_retailprice_lo, max(p_retailprice) as p_retailprice_hi,
    list_sort(list(distinct p_name)) as p_name_list,
    list_sort(list(distinct p_brand)) as p_brand_list,
    list_sort(list(distinct p_type)) as p_type_list from part),
ids as (select i as id, day, p.* from p, range(1, (select count(*) + 1 from part)) r(i),
  (values (date '2024-02-01'), (date '2024-02-02')) d(day))
select id as house_id, {_draw_sql('p_name', 'text')} as p_name,
  {_draw_sql('p_brand', 'text')} as p_brand, {_draw_sql('p_type', 'text')} as p_type,
  cast({_draw_sql('p_size', 'int')} as int) as p_size,
  round({_draw_sql('p_retailprice', 'double')}, 6) as p_retailprice, day as "Date" from ids
""")
def synth_rows(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    profile = synth.profile_table(part, exclude=["p_partkey"])
    days = [dt.date(2024, 2, 1), dt.date(2024, 2, 2)]
    rows = synth.synth_rows(spark, profile, days, rows_per_day=part.count(), seed=7)
    return rounded(rows, 6, "p_retailprice")


# ------------------------------------------------------------------ cleaning

_DIRTY_SQL = """
dirty as (
  select l_orderkey, l_partkey, l_suppkey, nullif(l_linenumber, 3) as l_linenumber, l_quantity,
    l_extendedprice, l_returnflag, cast(null as varchar) as l_remark from lineitem
  union all
  select l_orderkey, l_partkey, l_suppkey, nullif(l_linenumber, 3) as l_linenumber, l_quantity,
    l_extendedprice, l_returnflag, cast(null as varchar) as l_remark from lineitem)
"""
_DIRTY_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_extendedprice", "l_returnflag", "l_remark"]


def _dirty(spark, sf_dir) -> DataFrame:
    """Every line twice, one line number lost, and a column without values."""
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.nullif(F.col("l_linenumber"), F.lit(3)).alias("l_linenumber"),
        "l_quantity", "l_extendedprice", "l_returnflag",
        F.lit(None).cast("string").alias("l_remark"))
    return lines.unionByName(lines)


@query(f"with {_DIRTY_SQL} select distinct * from dirty")
def dedup_rows(spark, sf_dir):
    return cleaning.drop_duplicate_rows(_dirty(spark, sf_dir))


@query("""
select l_orderkey, l_linenumber, r.q as l_quantity, r.e as l_extendedprice, r.p as l_partkey
from (select l_orderkey, l_linenumber,
        min({'q': l_quantity, 'e': l_extendedprice, 'p': l_partkey}) as r
      from lineitem group by l_orderkey, l_linenumber)
""")
def dedup_keys(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_partkey")
    return cleaning.drop_duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@query(f"with {_DIRTY_SQL} " + " union all ".join(
    f'select \'{c}\' as "column", count(*) as n_rows, count(*) - count({c}) as n_null from dirty'
    for c in _DIRTY_COLUMNS))
def null_profile(spark, sf_dir):
    return cleaning.null_profile(_dirty(spark, sf_dir))


@query(f"with {_DIRTY_SQL} select * exclude (l_remark) from dirty")
def drop_null_columns(spark, sf_dir):
    return cleaning.drop_null_columns(_dirty(spark, sf_dir))


@query(f"with {_DIRTY_SQL} select * exclude (l_remark) from dirty where l_linenumber is not null")
def drop_null_rows(spark, sf_dir):
    return cleaning.drop_null_rows(_dirty(spark, sf_dir).drop("l_remark"))


@query(f"with {_DIRTY_SQL} select distinct * exclude (l_remark) from dirty "
       "where l_linenumber is not null")
def clean_layer(spark, sf_dir):
    return cleaning.clean(_dirty(spark, sf_dir))


# ------------------------------------------------------------------ features

@query("""
select c_custkey as k, c_acctbal as balance, c_mktsegment as segment, cast(null as int) as nation
from customer
union all
select s_suppkey, s_acctbal, null, s_nationkey from supplier
""")
def combine_by_name(spark, sf_dir):
    customer = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"))
    supplier = load(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("k"),
        F.col("s_acctbal").alias("balance"))
    return features.combine_by_name(customer, supplier)


@query(f"select * from ({_EVENTS_SQL}) where day not in "
       "(select cast(ts as date) from events where ts < timestamp '2024-01-21')")
def incremental_anti(spark, sf_dir):
    events = _events(spark, sf_dir)
    existing = events.where(F.col("day") < "2024-01-21")
    return features.new_days_only(events, existing, "day")


@query("select distinct cast(ts as date) as day from events")
def distinct_dates(spark, sf_dir):
    return features.distinct_days(_events(spark, sf_dir), "day")


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("select c_custkey, c_nationkey, " + ", ".join(
    f"case when s = '< {v}' then 1 else 0 end as {v}" for v in _SEGMENTS) + """
from (select *, nullif(concat('< ', c_mktsegment), case when c_acctbal < 0 then
        concat('< ', c_mktsegment) end) as s from customer)
""")
def one_hot(spark, sf_dir):
    segment = F.concat(F.lit("< "), "c_mktsegment")
    customer = load(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal",
        F.when(F.col("c_acctbal") >= 0, segment).alias("segment"))
    return features.one_hot(customer, "segment", target="c_acctbal")


@query("select cast(o_orderkey as bigint) as o_orderkey, cast(o_orderdate as date) as o_day, "
       "o_totalprice from orders")
def label_columns(spark, sf_dir):
    orders = _dated_orders(spark, sf_dir).withColumn(
        "o_orderkey", F.col("o_orderkey").cast("string"))
    return training.label_columns(orders, ["o_orderkey", "o_day"], "o_orderkey", "o_totalprice")


def _dated_orders(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "orders").withColumn("o_day", F.col("o_orderdate").cast("date"))


@query("select o_orderkey, o_totalprice, cast(o_orderdate as date) as o_day from orders "
       "where cast(o_orderdate as date) between date '1997-01-01' and date '1998-12-31'")
def date_range_filter(spark, sf_dir):
    orders = _dated_orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "o_day")
    return training.in_date_range(orders, "o_day", "1997-01-01", "1998-12-31")


@query("""
select l_extendedprice, l_quantity, p_size, p_retailprice
from lineitem left join (select * from part where p_size >= 10) on l_partkey = p_partkey
""")
def feature_lookup(spark, sf_dir):
    labels = load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), "l_extendedprice", "l_quantity")
    known = load(spark, sf_dir, "part").where(F.col("p_size") >= 10).select(
        "p_partkey", "p_size", "p_retailprice")
    return features.lookup_features(labels, known, ["p_partkey"])


# ------------------------------------------------------------------ training

_ORDER_KEYS = ["o_orderkey", "o_day"]


@query("select o_orderkey, cast(o_orderdate as date) as o_day, o_totalprice from orders")
def training_all(spark, sf_dir):
    orders = _dated_orders(spark, sf_dir)
    return training.training_labels(
        orders.where(F.col("o_day") < "1999-01-01"), orders.where(F.col("o_day") >= "1999-01-01"),
        _ORDER_KEYS, "o_orderkey", "o_totalprice", mode="all", day_col="o_day")


@query("select o_orderkey, cast(o_orderdate as date) as o_day, o_totalprice from orders "
       "where o_orderdate < timestamp '1999-01-01' or cast(o_orderdate as date) "
       "between date '2000-01-01' and date '2000-06-30'")
def training_range(spark, sf_dir):
    orders = _dated_orders(spark, sf_dir)
    return training.training_labels(
        orders.where(F.col("o_day") < "1999-01-01"), orders.where(F.col("o_day") >= "1999-01-01"),
        _ORDER_KEYS, "o_orderkey", "o_totalprice", mode="range", day_col="o_day",
        start="2000-01-01", end="2000-06-30")


_LINE_KEYS = ["l_orderkey", "l_linenumber"]
_SPLIT_SQL = """case when cast(('0x' || substr(md5(concat_ws('|', cast(l_orderkey as varchar),
  cast(l_linenumber as varchar))), 1, 8)) as bigint) % 100 < 80 then 'train' else 'test' end"""


@query(f"select l_orderkey, l_linenumber, l_extendedprice, {_SPLIT_SQL} as split from lineitem")
def train_test_split(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select(*_LINE_KEYS, "l_extendedprice")
    return training.with_split(lines, _LINE_KEYS)


_TERMS = ["l_quantity", "l_discount"]


def _ols_sql(source: str, y: str = "l_extendedprice") -> str:
    """Closed form for two features over the relation ``source``."""
    return f"""(select (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) as b1,
  (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) as b2, m1, m2, my
from (select covar_pop(l_quantity, {y}) as s1y, covar_pop(l_discount, {y}) as s2y,
  var_pop(l_quantity) as s11, var_pop(l_discount) as s22,
  covar_pop(l_quantity, l_discount) as s12, avg(l_quantity) as m1, avg(l_discount) as m2,
  avg({y}) as my from {source}))"""


_MODEL_SQL = """
select '(intercept)' as term, round(my - b1 * m1 - b2 * m2, 3) as coefficient from fit
union all select 'l_quantity', round(b1, 3) from fit
union all select 'l_discount', round(b2, 3) from fit"""


def _fit_rows(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(*_LINE_KEYS, *_TERMS, "l_extendedprice")


@query(f"with fit as {_ols_sql('lineitem')} {_MODEL_SQL}")
def ols_coefficients(spark, sf_dir):
    model = training.fit_linear(_fit_rows(spark, sf_dir), _TERMS, "l_extendedprice")
    return rounded(training.model_frame(spark, model), 3, "coefficient")


_FIXED_MODEL = training.LinearModel(tuple(_TERMS), (1050.5, -12.25), 7.125)
_FIXED_SQL = "7.125::double + 1050.5::double * l_quantity + (-12.25)::double * l_discount"


@query(f"select l_orderkey, l_linenumber, l_quantity, l_discount, l_extendedprice, "
       f"round({_FIXED_SQL}, 6) as predictions from lineitem")
def score_linear(spark, sf_dir):
    return rounded(scoring.score(_fit_rows(spark, sf_dir), _FIXED_MODEL), 6, "predictions")


@query(f"""
with marked as (select *, {_SPLIT_SQL} as split from lineitem),
fit as {_ols_sql("(select * from marked where split = 'train')")},
scored as (select avg((l_extendedprice - (my + b1 * (l_quantity - m1) + b2 * (l_discount - m2))) ** 2)
  as mse from marked, fit where split = 'test')
select round(mse, 0) as mse, round(sqrt(mse), 4) as rmse, sqrt(mse) < 2500 as accepted from scored
""")
def eval_mse_rmse(spark, sf_dir):
    train, test = training.train_test_split(_fit_rows(spark, sf_dir), _LINE_KEYS)
    model = training.fit_linear(train, _TERMS, "l_extendedprice")
    result = training.errors(scoring.score(test, model), "l_extendedprice")
    return rounded(rounded(result, 0, "mse"), 4, "rmse")


@query(f"""
with marked as (select *, {_SPLIT_SQL} as split from lineitem),
fit as {_ols_sql("(select * from marked where split = 'train')")}
select l_orderkey, l_linenumber, round(my + b1 * (l_quantity - m1) + b2 * (l_discount - m2), 2) as predictions,
  'accepted,rejected' as stages from marked, fit where split = 'test'
""")
def validated_scores(spark, sf_dir):
    """Two versions are registered and validated, a fit and a later one that is far off; rows are scored by the accepted one."""
    train, test = training.train_test_split(_fit_rows(spark, sf_dir), _LINE_KEYS)
    fitted = training.fit_linear(train, _TERMS, "l_extendedprice")
    far_off = training.LinearModel(fitted.features, fitted.coefficients, fitted.intercept + 1e7)
    registry, decided = scratch_path(spark, "models"), scratch_path(spark, "stages")
    stages = []
    for model in (fitted, far_off):
        training.register_model(spark, registry, "price", model)
        found = flows.validate_latest(spark, test, "l_extendedprice", registry, decided, "price", limit=1e6)
        stages.append(found.first()["stage"])
    model = training.load_accepted(spark, registry, decided, "price")
    scored = scoring.score(test, model).select(*_LINE_KEYS, "predictions", F.lit(",".join(stages)).alias("stages"))
    return rounded(scored, 2, "predictions")


@query("""
with registry as (select l_returnflag as model, cast(year(l_shipdate) - 1994 as int) as version,
  avg(l_extendedprice) as intercept from lineitem group by 1, 2)
select model, version, round(intercept, 4) as intercept from registry r
where version = (select max(version) from registry s where s.model = r.model)
""")
def latest_version(spark, sf_dir):
    registry = load(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("model"),
        (F.year("l_shipdate") - 1994).alias("version"),
    ).agg(F.avg("l_extendedprice").alias("intercept"))
    newest = training.latest_versions(registry)
    return rounded(registry.join(newest, on=["model", "version"]), 4, "intercept")


# ------------------------------------------------------------------ drift

def _orders_and_keys(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    returned = load(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("o_orderkey"))
    return orders, returned


@query("""
select o_orderkey, o_custkey, o_totalprice from orders
left join (select l_orderkey from lineitem where l_returnflag = 'R') on o_orderkey = l_orderkey
""")
def reference_frame_left(spark, sf_dir):
    orders, returned = _orders_and_keys(spark, sf_dir)
    return drift.reference_rows_left(orders, returned, ["o_orderkey"])


@query("""
select o_orderkey, o_custkey, o_totalprice from orders where exists
(select 1 from lineitem where l_returnflag = 'R' and o_orderkey = l_orderkey)
""")
def reference_frame_semi(spark, sf_dir):
    orders, returned = _orders_and_keys(spark, sf_dir)
    return drift.reference_rows(orders, returned, ["o_orderkey"])


_SINCE = "1998-01-01"
_DRIFT_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _before_after(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    split = F.lit(_SINCE).cast("timestamp_ntz")
    return df.where(F.col(column) < split), df.where(F.col(column) >= split)


_KS_SQL = f"""
long as ({' union all '.join(
    f"select '{c}' as feature, {c} as v, (l_shipdate < timestamp '{_SINCE}')::int as r from lineitem"
    for c in _DRIFT_FEATURES)}),
counted as (select feature, v, sum(r) as a, sum(1 - r) as b from long group by feature, v),
cdf as (select feature, sum(a) over (partition by feature order by v) as au,
  sum(b) over (partition by feature order by v) as bu,
  sum(a) over (partition by feature) as n, sum(b) over (partition by feature) as m from counted),
gaps as (select feature, cast(max(n) as bigint) as n_ref, cast(max(m) as bigint) as n_test,
  max(abs(au::double / n::double - bu::double / m::double)) as statistic from cdf group by feature),
scaled as (select *, sqrt(n_ref::double * n_test / (n_ref + n_test)) * statistic as x from gaps),
ks as (select feature, n_ref, n_test, statistic, case when x < 0.2 then 1.0 else
  least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101), lambda k:
    (case when k % 2 = 1 then 1.0::double else -1.0::double end) * exp(-2.0::double * k * k * x * x)
  )))) end::double as p_value from scaled)
"""


def _ks(spark, sf_dir) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    return drift.ks_drift(*_before_after(lines, "l_shipdate"), _DRIFT_FEATURES)


@query(f"with {_KS_SQL} select feature, n_ref, n_test, round(statistic, 9) as statistic, "
       "round(p_value, 6) as p_value from ks")
def drift_ks(spark, sf_dir):
    return rounded(rounded(_ks(spark, sf_dir), 9, "statistic"), 6, "p_value")


_INDICATORS = {"is_open": "O", "is_filled": "F"}
_CATEGORICAL = ["o_orderpriority", "o_orderstatus", *_INDICATORS]


def _category_sql(column: str) -> str:
    if column in _INDICATORS:
        return f"(o_orderstatus = '{_INDICATORS[column]}')::int::varchar"
    return column


_CHI_SQL = f"""
cats as ({' union all '.join(
    f"select '{c}' as feature, {_category_sql(c)} as v, "
    f"(o_orderdate < timestamp '{_SINCE}')::int as r from orders" for c in _CATEGORICAL)}),
cells as (select feature, v, sum(r)::double as a, sum(1 - r)::double as b from cats
  group by feature, v),
sized as (select *, sum(a) over (partition by feature) as n, sum(b) over (partition by feature) as m,
  count(*) over (partition by feature) as k from cells),
dist as (select *, n * (a + b) / (n + m) as ea, m * (a + b) / (n + m) as eb from sized),
moved as (select *,
  case when k = 2 then greatest(abs(a - ea) - 0.5, 0.0) else abs(a - ea) end::double as da,
  case when k = 2 then greatest(abs(b - eb) - 0.5, 0.0) else abs(b - eb) end::double as db from dist),
stat as (select feature, max(n)::bigint as n_ref, max(m)::bigint as n_test,
  sum(da * da / ea + db * db / eb) as statistic, (max(k) - 1)::int as df from moved group by feature),
chi as (select *, case df
  when 1 then 1 - exp(-statistic / 2) * list_sum(list_transform(range(0, 150), lambda i:
    exp((2 * i + 1) * ln(sqrt(statistic / 2)) - lgamma(i + 1.5))))
  when 2 then exp(-statistic / 2)
  when 4 then exp(-statistic / 2) * (1 + statistic / 2) end as p_value from stat)
"""


def _chi_square(spark, sf_dir) -> DataFrame:
    orders = load(spark, sf_dir, "orders").withColumns({
        name: (F.col("o_orderstatus") == status).cast("int")
        for name, status in _INDICATORS.items()})
    return drift.chi_square_drift(*_before_after(orders, "o_orderdate"), _CATEGORICAL)


@query(f"with {_CHI_SQL} select feature, n_ref, n_test, df, round(statistic, 6) as statistic, "
       "round(p_value, 6) as p_value from chi")
def drift_chi2(spark, sf_dir):
    return rounded(_chi_square(spark, sf_dir), 6, "statistic", "p_value")


@query(f"""with {_KS_SQL}, {_CHI_SQL},
tests as (select feature, p_value from ks union all select feature, p_value from chi)
select count(*) as n_features, round(min(p_value), 6) as min_p,
  round(0.5::double / count(*), 6) as threshold, min(p_value) < 0.5 / count(*) as is_drift from tests
""")
def drift_verdict(spark, sf_dir):
    tests = _ks(spark, sf_dir).select("feature", "p_value").unionByName(
        _chi_square(spark, sf_dir).select("feature", "p_value"))
    return rounded(drift.drift_verdict(tests), 6, "min_p", "threshold")


# ------------------------------------------------------------------ stability

_REFIT_SQL = f"""
marked as (select *, {_SPLIT_SQL} as split from lineitem),
refit_rows as (select l_quantity, l_discount, case when split = 'train' then l_extendedprice
  else {_FIXED_SQL} end as y from marked)
"""


def _refit(spark, sf_dir) -> training.LinearModel:
    train, test = training.train_test_split(_fit_rows(spark, sf_dir), _LINE_KEYS)
    rows = stability.refit_rows(train, scoring.score(test, _FIXED_MODEL), "l_extendedprice")
    return training.fit_linear(rows, _TERMS, "l_extendedprice")


@query(f"with {_REFIT_SQL}, fit as {_ols_sql('refit_rows', 'y')} {_MODEL_SQL}")
def refit_with_scores(spark, sf_dir):
    return rounded(training.model_frame(spark, _refit(spark, sf_dir)), 3, "coefficient")


@query("select c_custkey, (c_acctbal > 0)::int as balance_flag, "
       "(c_acctbal > 5000)::int as above_flag, 0 as zero_flag from customer")
def sign_flags(spark, sf_dir):
    values = F.array(F.col("c_acctbal"), F.col("c_acctbal") - 5000, F.lit(0.0))
    flags = load(spark, sf_dir, "customer").select(
        "c_custkey", columns.sign_flags(values).alias("f"))
    return flags.select(
        "c_custkey", F.col("f")[0].alias("balance_flag"), F.col("f")[1].alias("above_flag"),
        F.col("f")[2].alias("zero_flag"))


_SIGNS_SQL = f"""
with {_REFIT_SQL}, a as {_ols_sql('lineitem')}, b as {_ols_sql('refit_rows', 'y')},
signs as (select 'l_quantity' as feature, (a.b1 > 0)::int as registered_flag,
    (b.b1 > 0)::int as refit_flag from a, b
  union all select 'l_discount', (a.b2 > 0)::int, (b.b2 > 0)::int from a, b)
"""


def _sign_comparison(spark, sf_dir) -> DataFrame:
    registered = training.fit_linear(_fit_rows(spark, sf_dir), _TERMS, "l_extendedprice")
    return stability.compare_signs(spark, registered, _refit(spark, sf_dir))


@query(_SIGNS_SQL + "select *, registered_flag = refit_flag as same from signs")
def sign_comparison(spark, sf_dir):
    return _sign_comparison(spark, sf_dir)


@query(_SIGNS_SQL + "select bool_and(registered_flag = refit_flag) as stable from signs")
def sign_stability(spark, sf_dir):
    return stability.is_stable(_sign_comparison(spark, sf_dir))


# ------------------------------------------------------------------ quality

def _check_sql(suite: str, table: str, rule: str, column: str, severity: str, threshold: str,
               rows: str, unexpected: str, success: str, source: str) -> str:
    return f"""select '{suite}' as suite, '{table}' as "table", '{rule}' as rule,
  '{column}' as "column", '{severity}' as severity, cast(n as bigint) as element_count,
  cast(u as bigint) as unexpected_count, round(100.0::double * u / n, 2) as unexpected_percent,
  '{threshold}' as threshold, {success} as success
from (select {rows} as n, {unexpected} as u from {source})"""


def _line_check(rule, column, severity, threshold, condition, success="u = 0"):
    return _check_sql("lines", "lineitem", rule, column, severity, threshold, "count(*)",
                      f"count(*) filter (where {condition})", success, "dirty")


def _run(spark, sf_dir, *rules) -> DataFrame:
    return quality.run_suite(_dirty(spark, sf_dir), rules, suite="lines", table="lineitem")


def _with_dirty(*checks: str) -> str:
    return f"with {_DIRTY_SQL} " + " union all ".join(checks)


_NULL_CHECKS = [_line_check("not_null", c, "ERROR", "mostly=1.0", f"{c} is null")
                for c in ("l_orderkey", "l_linenumber")]


@query(_with_dirty(*_NULL_CHECKS))
def dq_not_null(spark, sf_dir):
    return _run(spark, sf_dir, quality.NotNull("l_orderkey"), quality.NotNull("l_linenumber"))


@query(_with_dirty(*[
    _line_check("not_null", "l_linenumber", "WARN", f"mostly={m}", "l_linenumber is null",
                f"(n - u) / n >= {m}::double") for m in (0.5, 0.95)]))
def dq_null_fraction(spark, sf_dir):
    return _run(spark, sf_dir, *[
        quality.NotNull("l_linenumber", m, "WARN") for m in (0.5, 0.95)])


_LENGTH_CHECKS = [
    _line_check("value_length", "l_partkey", "WARN", "1..3",
                "length(l_partkey::varchar) not between 1 and 3"),
    _line_check("value_length", "l_linenumber", "WARN", "0..1",
                "length(l_linenumber::varchar) not between 0 and 1"),
]


@query(_with_dirty(*_LENGTH_CHECKS))
def dq_value_length(spark, sf_dir):
    return _run(spark, sf_dir, quality.ValueLength("l_partkey", 1, 3),
                quality.ValueLength("l_linenumber", 0, 1))


@query(_with_dirty(
    _line_check("value_range", "l_linenumber", "WARN", "1..6", "l_linenumber not between 1 and 6"),
    _line_check("value_range", "l_quantity", "WARN", "1..50", "l_quantity not between 1 and 50")))
def dq_value_range(spark, sf_dir):
    return _run(spark, sf_dir, quality.ValueRange("l_linenumber", 1, 6),
                quality.ValueRange("l_quantity", 1, 50))


@query(_with_dirty(
    _check_sql("lines", "lineitem", "row_count", "*", "WARN", "60000", "count(*)",
               "abs(count(*) - 60000)", "u = 0", "dirty"),
    _check_sql("lines", "lineitem", "column_count", "*", "WARN", "8", "8", "0", "u = 0",
               "(select 1)")))
def dq_shape(spark, sf_dir):
    return _run(spark, sf_dir, quality.RowCount(60000), quality.ColumnCount(8))


def _unique_check(table: str, keys: str, severity: str, source: str, suite: str = "lines") -> str:
    return _check_sql(
        suite, table, "unique", keys, severity, "1 row per key", "sum(c)",
        "coalesce(sum(c) filter (where c > 1), 0)", "u = 0",
        f"(select count(*) as c from {source} group by {keys})")


@query(_unique_check("lineitem", "l_orderkey,l_linenumber", "WARN", "lineitem"))
def dq_unique(spark, sf_dir):
    return quality.run_suite(load(spark, sf_dir, "lineitem"), [quality.Unique(tuple(_LINE_KEYS))],
                             suite="lines", table="lineitem")


def _schema_check(rule: str, column: str, threshold: str) -> str:
    return _check_sql("curated", "sales", rule, column, "ERROR", threshold, "1", "0", "u = 0",
                      "(select 1)")


@query(_LINES_SQL + " union all ".join([
    *[_schema_check("has_column", c, "present") for c in suites.CURATED_MANDATORY],
    *[_schema_check("type_in", c, "|".join(quality.NUMERIC_TYPES)) for c in suites.CURATED_TOTALS],
    *[_schema_check("type_in", c, "DateType") for c in ("date", "partition_date")],
    _check_sql("curated", "sales", "not_null", "brand", "ERROR", "mostly=1.0", "count(*)",
               "count(*) filter (where brand is null)", "u = 0",
               f"(select {', '.join(sales.CUBE_KEYS)} from lines "
               f"group by {', '.join(sales.CUBE_KEYS)})"),
]))
def dq_schema(spark, sf_dir):
    rules = [*suites.curated_suite(), quality.NotNull("brand")]
    return quality.run_suite(_cube(spark, sf_dir), rules, suite="curated", table="sales")


@query(f"with {_DIRTY_SQL} select date '{RUN_DATE}' as run_date, * from (" + " union all ".join([
    *_NULL_CHECKS, *_LENGTH_CHECKS,
    _unique_check("lineitem", "l_orderkey,l_linenumber", "ERROR", "dirty"),
    _check_sql("orders", "orders", "not_null", "o_custkey", "ERROR", "mostly=1.0", "count(*)",
               "count(*) - count(o_custkey)", "u = 0", "orders"),
    _unique_check("orders", "o_orderkey", "WARN", "orders", "orders")]) + ")")
def dq_suite(spark, sf_dir):
    path = scratch_path(spark, "results")
    quality.record_results(_run(
        spark, sf_dir, quality.NotNull("l_orderkey"), quality.NotNull("l_linenumber"),
        quality.ValueLength("l_partkey", 1, 3), quality.ValueLength("l_linenumber", 0, 1),
        quality.Unique(tuple(_LINE_KEYS), severity="ERROR")), path, RUN_DATE)
    quality.record_results(quality.run_suite(
        load(spark, sf_dir, "orders"),
        [quality.NotNull("o_custkey"), quality.Unique(("o_orderkey",))],
        suite="orders", table="orders"), path, RUN_DATE)
    return readers.read_table(spark, path)
