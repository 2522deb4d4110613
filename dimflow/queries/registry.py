"""Query registry and the shapes the given tables are brought into."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.operators.windows import daily, latest_per_key
from dimflow.plans.scd import type2_versions
from dimflow.session import scratch_path, tune
from dimflow.sources.readers import read_table

MODULES = ("sources", "sinks", "columns", "scalars", "joins", "windows", "incremental", "quality", "jobs")

_QUERIES: dict[str, Callable[["Tables"], DataFrame]] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The given tables as attributes, and DataFrames shaped from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def snapshot(self) -> DataFrame:
        """Daily state per user: the day's last event."""
        rows = self.events.select("user_id", F.to_date("ts").alias("rpt_dt"), "ts", "event_id", "event_type", "value")
        return daily(rows, ["user_id"], "rpt_dt", [F.col("ts").desc(), F.col("event_id").desc()]).drop("ts")

    def priority_days(self) -> DataFrame:
        """Daily state per customer: the priority of the day's last order."""
        rows = self.orders.select(
            "o_custkey", F.to_date("o_orderdate").alias("rpt_dt"), "o_orderkey", "o_orderpriority"
        )
        return daily(rows, ["o_custkey"], "rpt_dt", [F.col("o_orderkey").desc()]).drop("o_orderkey")

    def priority_versions(self) -> DataFrame:
        """Type-2 dimension of customers by order priority."""
        return type2_versions(
            self.priority_days(), ["o_custkey"], ["o_orderpriority"], "rpt_dt", sk="cust_sk", one_row_a_day=True
        )

    def shipments(self) -> DataFrame:
        """Dated fact rows: line items with their order's customer."""
        lines = self.lineitem.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.to_date("l_shipdate").alias("ship_dt")
        )
        owners = self.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        return lines.join(owners, "l_orderkey")

    def latest_orders(self, before: str | None = None, since: str | None = None) -> DataFrame:
        rows = self.orders
        if before:
            rows = rows.filter(F.col("o_orderdate") < F.lit(before).cast("date"))
        if since:
            rows = rows.filter(F.col("o_orderdate") >= F.lit(since).cast("date"))
        return latest_per_key(rows, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


# SQL of the shapes, as WITH members.
SNAP = """snap AS (
  SELECT user_id, CAST(ts AS DATE) AS rpt_dt, event_id, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1)"""

SNAP_VERSIONS = """snap_runs AS (
  SELECT user_id, rpt_dt, event_type FROM snap
  QUALIFY lag(event_type) OVER (PARTITION BY user_id ORDER BY rpt_dt) IS DISTINCT FROM event_type
       OR row_number() OVER (PARTITION BY user_id ORDER BY rpt_dt) = 1),
snap_versions AS (
  SELECT user_id, event_type, rpt_dt, rpt_dt AS eff_dt,
    coalesce(CAST(lead(rpt_dt) OVER (PARTITION BY user_id ORDER BY rpt_dt) - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS disc_dt
  FROM snap_runs)"""

DAYS = """prio_days AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS rpt_dt, o_orderpriority FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1)"""

VERSIONS = DAYS + """,
prio_runs AS (
  SELECT o_custkey, rpt_dt, o_orderpriority FROM prio_days
  QUALIFY lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY rpt_dt) IS DISTINCT FROM o_orderpriority
       OR row_number() OVER (PARTITION BY o_custkey ORDER BY rpt_dt) = 1),
prio_versions AS (
  SELECT md5(CAST(o_custkey AS VARCHAR) || '-' || CAST(rpt_dt AS VARCHAR)) AS cust_sk,
    o_custkey, o_orderpriority, rpt_dt, rpt_dt AS eff_dt,
    coalesce(CAST(lead(rpt_dt) OVER (PARTITION BY o_custkey ORDER BY rpt_dt) - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS disc_dt
  FROM prio_runs)"""

SHIPMENTS = """shipments AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(l_shipdate AS DATE) AS ship_dt, o_custkey
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


def padded(col: str, width: int):
    """A key as text of at least ``width`` digits; a longer key keeps all of them."""
    text = F.col(col).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def padded_sql(col: str, width: int) -> str:
    text = f"CAST({col} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest(length({text}), {width}) AS INTEGER), '0')"


def latest_orders_sql(where: str) -> str:
    return f"""SELECT * FROM orders WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def sql_of(name: str) -> str:
    """The SQL of a query registered before, for another way to the same rows."""
    return _SQL[name]


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"dimflow.queries.{m}")


def _run(fn, spark: SparkSession, folder: str) -> DataFrame:
    return fn(Tables(tune(spark), folder))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: partial(_run, fn) for name, fn in _QUERIES.items()}


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
