"""Name to query and name to SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

STAMP = "yyyy-MM-dd HH:mm:ss"


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is what an ANSI engine would run on the same tables."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


# Explicit schemas: no job has to read a file footer before a plan exists.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def stamp(col: Column | str) -> Column:
    return F.date_format(col, STAMP)


def day(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def props_k(col: str = "props") -> Column:
    """The number in ``events.props``."""
    return F.get_json_object(col, "$.k").cast("int")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and clocks as text: types every engine prints alike."""
    shown = {
        "decimal": "cast({c} AS double)",
        "timestamp": f"date_format({{c}}, '{STAMP}')",
        "timestamp_ntz": f"date_format({{c}}, '{STAMP}')",
        "date": "date_format({c}, 'yyyy-MM-dd')",
        "integer": "cast({c} AS bigint)",
    }
    name = lambda f: f"`{f.name}`"
    return df.selectExpr(
        *[f"{shown.get(f.dataType.typeName(), '{c}').format(c=name(f))} AS {name(f)}" for f in df.schema.fields]
    )
