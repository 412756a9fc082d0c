"""The sales cube: two channels joined to their dimensions, stacked and summed."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, IntegralType, StructField, StructType

from tidemark.durable import remove, scratch_path, shuffles_freed

# The measures of a sales line, in output order, and the column
# of the fact table (after its two-letter prefix) each comes from.
MEASURES = {
    "sold_quantity": "quantity",
    "ext_wholesale_cost": "ext_wholesale_cost",
    "ext_list_price": "ext_list_price",
    "ext_ship_cost": "ext_ship_cost",
    "ext_tax": "ext_tax",
    "coupon_amt": "coupon_amt",
    "net_paid": "net_paid",
    "net_paid_inc_tax": "net_paid_inc_tax",
}

# The grouping columns of the cube.
CUBE_KEYS = (
    "partition_date", "date", "year", "quarter_name", "brand", "manufact",
    "product_name", "source", "store_name",
)

# So many lines are summed by one task: as many groups at most, with all their names.
LINES_A_TASK = 500_000

# So many lines are joined at once. More are cut by date key and by item key, into
# GRID x GRID cells at most: what lies on disk and how often the sales are read
# then grow with the lines, and no faster.
LINES_A_CELL = 2_000_000
GRID = 4


@dataclass(frozen=True)
class Channel:
    """How a channel names its fact columns and its point of sale."""

    source: str
    prefix: str
    outlet_key: str  # fact column, without prefix
    outlet_id: str
    outlet_name: str
    ships: bool


STORE = Channel("Store", "ss", "store_sk", "s_store_sk", "s_store_name", ships=False)
WEB = Channel("Web", "ws", "web_site_sk", "web_site_sk", "web_name", ships=True)


def channel_lines(fact: DataFrame, date_dim: DataFrame, item: DataFrame,
                  outlet: DataFrame, channel: Channel) -> DataFrame:
    """Sales lines of one channel with their date, item and outlet.

    No join hints: small dimensions are broadcast by their size, and adaptive
    execution splits a hot item or date when a dimension is too large for that.
    A channel that does not ship has a shipping cost of 0.
    """
    p = channel.prefix
    measures = []
    for name, column in MEASURES.items():
        if name == "ext_ship_cost" and not channel.ships:
            measures.append(F.lit(0.0).alias(name))
        else:
            measures.append(fact[f"{p}_{column}"].alias(name))
    return (
        fact.join(date_dim, fact[f"{p}_sold_date_sk"] == date_dim["d_date_sk"])
        .join(item, fact[f"{p}_item_sk"] == item["i_item_sk"])
        .join(outlet, fact[f"{p}_{channel.outlet_key}"] == outlet[channel.outlet_id])
        .select(
            fact["partition_date"],
            date_dim["d_date"].alias("date"),
            date_dim["d_year"].alias("year"),
            date_dim["d_quarter_name"].alias("quarter_name"),
            item["i_brand"].alias("brand"),
            item["i_manufact"].alias("manufact"),
            item["i_product_name"].alias("product_name"),
            F.lit(channel.source).alias("source"),
            outlet[channel.outlet_name].alias("store_name"),
            *measures,
        )
    )


def sales_lines(store_sales: DataFrame, web_sales: DataFrame, date_dim: DataFrame,
                item: DataFrame, store: DataFrame, web_site: DataFrame) -> DataFrame:
    """Lines of both channels under one schema, copies kept."""
    return channel_lines(store_sales, date_dim, item, store, STORE).unionByName(
        channel_lines(web_sales, date_dim, item, web_site, WEB)
    )


def sales_totals(lines: DataFrame, keys: Sequence[str] = CUBE_KEYS) -> DataFrame:
    """Sums of all measures by ``keys``."""
    return lines.groupBy(*keys).agg(*[F.sum(m).alias(f"total_{m}") for m in MEASURES])


def _dealt_totals(lines: DataFrame, n_lines: int) -> DataFrame:
    """Totals by ``CUBE_KEYS``, of lines dealt out so that a task has ``LINES_A_TASK``."""
    tasks = -(-n_lines // LINES_A_TASK)
    if tasks > 1:
        lines = lines.repartition(tasks, *CUBE_KEYS, "net_paid")
    return sales_totals(lines)


def _share(df: DataFrame, key: str, parts: int) -> Column:
    """Which of ``parts`` a key falls to; equal whole numbers to the same one, whatever their types."""
    whole = isinstance(df.schema[key].dataType, IntegralType)
    return F.pmod(F.xxhash64(df[key].cast("long") if whole else df[key]), F.lit(parts))


def _cell_keys(channel: Channel) -> tuple[str, str]:
    return f"{channel.prefix}_sold_date_sk", f"{channel.prefix}_item_sk"


def _matching(dimension: DataFrame, key: str, fact: DataFrame, fact_key: str, share: int, parts: int) -> DataFrame:
    """Rows whose key may stand in that share of the facts: all, unless both keys are whole numbers."""
    if isinstance(dimension.schema[key].dataType, IntegralType) and isinstance(
            fact.schema[fact_key].dataType, IntegralType):
        return dimension.where(_share(dimension, key, parts) == share)
    return dimension


def _cell_lines(fact: DataFrame, date_dim: DataFrame, item: DataFrame, outlet: DataFrame,
                channel: Channel, cell: tuple[int, int], grid: int) -> DataFrame:
    """``channel_lines`` of the sales in a cell, joined to the dates and items these may have."""
    date_key, item_key = _cell_keys(channel)
    return channel_lines(
        fact.where((_share(fact, date_key, grid) == cell[0]) & (_share(fact, item_key, grid) == cell[1])),
        _matching(date_dim, "d_date_sk", fact, date_key, cell[0], grid),
        _matching(item, "i_item_sk", fact, item_key, cell[1], grid),
        outlet, channel)


def _totals_by_cells(store_sales: DataFrame, web_sales: DataFrame, date_dim: DataFrame, item: DataFrame,
                     store: DataFrame, web_site: DataFrame, cells: Counter, grid: int) -> DataFrame:
    """Totals by ``CUBE_KEYS``: summed in each cell and written, then over all cells.

    A group may have lines in many cells, so the written sums are cut by a hash of its keys, and
    each cut is summed and written by itself. The shuffle files of a write go when it ends, and
    a cut goes when its sums are written.
    """
    spark = store_sales.sparkSession
    partial, totals = scratch_path(spark, "cell_totals"), scratch_path(spark, "cube")
    schema = sales_totals(sales_lines(store_sales, web_sales, date_dim, item, store, web_site)).schema
    cuts = 2 * grid
    try:
        with shuffles_freed(spark):
            for cell, n_lines in sorted(cells.items()):
                lines = _cell_lines(store_sales, date_dim, item, store, STORE, cell, grid).unionByName(
                    _cell_lines(web_sales, date_dim, item, web_site, WEB, cell, grid))
                cut = F.pmod(F.xxhash64(*CUBE_KEYS), F.lit(cuts)).cast("int").alias("cut")
                _dealt_totals(lines, n_lines).select("*", cut).write.partitionBy("cut").parquet(
                    partial, mode="append", compression="zstd")
            written = spark.read.schema(StructType([*schema, StructField("cut", IntegerType())])).parquet(partial)
            for k in range(cuts):
                sums = written.where(F.col("cut") == k)
                tasks = -(-sums.count() // LINES_A_TASK)
                if tasks > 1:  # a group has a row per cell at most: none is hot, and one shuffle does
                    sums = sums.repartition(tasks, *CUBE_KEYS)
                sums.groupBy(*CUBE_KEYS).agg(*[
                    F.sum(c).cast(schema[c].dataType).alias(c) for c in schema.names if c.startswith("total_")
                ]).write.parquet(totals, mode="append", compression="zstd")
                remove(spark, f"{partial}/cut={k}")
    except BaseException:
        remove(spark, totals)
        raise
    finally:
        remove(spark, partial)
    return spark.read.schema(schema).parquet(totals)


def sales_cube(store_sales: DataFrame, web_sales: DataFrame, **dimensions: DataFrame) -> DataFrame:
    """The totals by ``CUBE_KEYS``, ``LINES_A_TASK`` lines to a task.

    Keys of facts take a few bytes in a shuffle, so a joined partition may be millions of
    lines, nearly each a group of its own. The sales are counted, and
    the lines dealt out again before they are summed. A hot group is spread
    by one of its measures, and its sums are partial first.

    Each line goes through a shuffle per join and two more with all its names. Of many
    lines that is many times the sales on disk, so beyond ``LINES_A_CELL`` they are
    cut into cells, one after another, and the totals are written. The
    sales are read once a cell then: pass tables.
    """
    cells = Counter()
    for fact, channel in ((store_sales, STORE), (web_sales, WEB)):
        keys = [_share(fact, key, GRID).alias(f"part_{i}") for i, key in enumerate(_cell_keys(channel))]
        for by_date, by_item, n in fact.groupBy(*keys).count().collect():
            cells[by_date, by_item] += n
    n_lines = sum(cells.values())
    grid = 1
    while grid < GRID and n_lines > grid * grid * LINES_A_CELL:
        grid *= 2
    if grid == 1:
        return _dealt_totals(sales_lines(store_sales, web_sales, **dimensions), n_lines)
    joined = Counter()
    for (by_date, by_item), n in cells.items():
        joined[by_date % grid, by_item % grid] += n
    return _totals_by_cells(store_sales, web_sales, **dimensions, cells=joined, grid=grid)
