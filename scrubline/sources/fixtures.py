"""The four menu tables derived from order, line and part tables, with dirt added.

Keys decide by arithmetic which cells are blank, zero, unmapped or dangling, so that
any SQL engine can derive the same rows (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline import vocab as V
from scrubline.sources.workspace import partitions

MENU = """
select cast(o_orderkey as string) as id,
  case when o_orderkey % 97 = 0 then '' when o_orderkey % 89 = 0 then '0190-03-06'
       when o_orderkey % 83 = 0 then '2928-01-01'
       else concat(substr(cast(o_orderdate as string), 1, 10), 'T00:00:00Z') end as date,
  case when o_orderpriority = '5-LOW' then '' when o_orderpriority = '4-NOT SPECIFIED' then 'Francs'
       else 'Dollars' end as currency,
  case when o_orderstatus = 'P' then 'under review' else 'complete' end as status
from {orders}
"""

# Pages are told apart by their numbers, which hash and shuffle cheaper than their texts.
PAGE = """
select cast(id as string) as id, cast(menu_id as string) as menu_id
from (select distinct l_orderkey * 8 + l_linenumber % 2 as id, l_orderkey as menu_id from {lineitem}) t
"""

ITEM = """
select cast(l_orderkey * 1000 + rn as string) as id,
  cast(l_orderkey * 8 + l_linenumber % 2 as string) as menu_page_id,
  case when (l_orderkey + rn) % 5 = 0 then '' when (l_orderkey + rn) % 31 = 0 then '0.0'
       when (l_orderkey + rn) % 151 = 0 then cast(cast(l_extendedprice as decimal(18,2)) as string)
       else cast(cast(l_quantity as decimal(18,1)) as string) end as price,
  case when (l_orderkey + rn) % 7 = 0 then cast(cast(l_quantity + 10 as decimal(18,1)) as string)
       when (l_orderkey + rn) % 11 = 0 then '0.0' else '' end as high_price,
  case when (l_orderkey + rn) % 41 = 0 then '' when (l_orderkey + rn) % 43 = 0 then '999999999'
       else cast(l_partkey % 50 as string) end as dish_id
from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
        l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) as rn
      from {lineitem}) t
"""

DISH = """
select cast(p_partkey as string) as id,
  case when p_partkey % 101 = 0 then '&' when p_partkey % 13 = 0 then concat(' ', p_name, '  & Sauce')
       when p_partkey % 11 = 0 then concat(p_name, '-', p_brand)
       when p_partkey % 7 = 0 then concat('Médoc ', upper(p_name), '.') else p_name end as name,
  case when p_partkey % 17 = 0 then '' when p_partkey % 5 = 0 then '0.0'
       else cast(cast(p_size as decimal(18,1)) as string) end as lowest_price,
  case when p_partkey % 19 = 0 then '' when p_partkey % 5 = 0 then '0.0'
       else cast(cast(p_size + 5 as decimal(18,1)) as string) end as highest_price
from {part}
"""

_SQL = {
    "menu": ("orders", MENU),
    "menu_page": ("lineitem", PAGE),
    "menu_item": ("lineitem", ITEM),
    "dish": ("part", DISH),
}


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of ``menu, menu_page, menu_item, dish`` as raw text."""
    source, sql = _SQL[table]
    src = base(spark, sf_dir, source)
    if table == "menu_item":
        # As the window needs it, but in tasks that don't grow with the table.
        src = src.repartition(partitions(spark, f"{sf_dir}/{source}.parquet"), "l_orderkey")
    return spark.sql(sql.format(**{source: "{src}"}), src=src)


def stamped(raw: DataFrame, table: str) -> DataFrame:
    """Provenance for a derived table: its source name and, as row number, its own key.

    Derived rows have no position in a file; :func:`scrubline.sources.text.stamp_rows`
    numbers the rows of real files.
    """
    return raw.select(
        "*",
        F.lit(f"{table}.csv").alias(V.SOURCE_FILE),
        F.col("id").cast("bigint").alias(V.SOURCE_ROW),
        F.lit("").alias(V.LOG),
    )
