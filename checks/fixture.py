"""The driver tables as raw incident text: every query starts from this view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_YEAR, SCENARIO_YEAR = 1996, 2000

# One text for both engines but for the weekday expression.
INCIDENTS_SQL = """
select
  cast(o_orderkey as varchar(20)) as incident_id,
  cast(year(o_orderdate) as varchar(20)) as yr,
  cast(month(o_orderdate) as varchar(20)) as mon,
  cast({dow} as varchar(20)) as wday,
  cast(o_orderkey % 26 as varchar(20)) as hr,
  case when o_custkey % 97 = 0 then null
       when o_custkey % 89 = 0 then 'n/a'
       else cast(o_custkey % 11 as varchar(20)) end as weather,
  concat(' ', cast(1 + o_orderkey % 6 as varchar(20)), ',0 ') as light,
  cast(1 + o_custkey % 3 as varchar(20)) as zone,
  case o_orderkey % 4 when 0 then '13' when 1 then '14'
       when 2 then '0' else '7' end as incident_type,
  cast(case when o_orderkey % 53 = 0 then -1
       else cast(floor(o_totalprice / 100000) as int) end as varchar(20)) as casualties,
  case when o_orderkey % 13 = 0 and o_totalprice >= 100000 then '1' else '0' end as fatal,
  case when o_orderkey % 17 = 0 and o_totalprice >= 200000 then '1' else '0' end as serious,
  replace(cast(cast(o_totalprice as decimal(15,2)) as varchar(20)), '.', ',') as km
from {orders}
"""

COLUMNS = (
    "incident_id", "yr", "mon", "wday", "hr", "weather", "light", "zone",
    "incident_type", "casualties", "fatal", "serious", "km",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return spark.sql(
        INCIDENTS_SQL.format(dow="weekday(o_orderdate) + 1", orders="{orders}"), orders=orders
    )


def incidents_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the third severity column, so that the parts add up to the total."""
    return incidents(spark, sf_dir).selectExpr(
        "*", "cast(cast(casualties as int) - cast(fatal as int) - cast(serious as int) as string) as minor"
    )
