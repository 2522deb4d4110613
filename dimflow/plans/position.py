"""Position dimension and the manager hierarchy above it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.functions.dates import open_end
from dimflow.functions.keys import row_hash, surrogate_key
from dimflow.operators.hierarchy import hierarchy_paths
from dimflow.operators.reshape import explode_path
from dimflow.operators.windows import close_intervals, daily, islands


def build_position_dim(
    snapshots: DataFrame,
    key: str = "position_id",
    attrs: list[str] | None = None,
    date_col: str = "rpt_eff_dt",
    *,
    overlap: str = "has_overlap_worker_ind",
    one_row_a_day: bool = False,
    sk: str = "position_sk",
) -> DataFrame:
    """Runs of equal state, with end dates that know about overlapping workers.

    A version with an overlapping worker lasts until the next such version of
    the position. The last of them stays open while the position's newest
    version still has the overlap; else it ends before the next version.

    All of it is read off the position's versions in one pass from the newest
    back: the next start, the next overlap start and the newest indicator. A
    position has one row per report date at most, so the window is bounded.
    """
    attrs = attrs or [c for c in snapshots.columns if c not in (key, date_col)]
    rows = snapshots.select(key, *attrs, date_col)
    rows = rows if one_row_a_day else daily(rows, [key], date_col, attrs)
    runs = islands(rows, [key], attrs, date_col).withColumn("eff_dt", F.col(date_col).cast("date"))
    has = F.col(overlap).cast("int") == 1
    back = Window.partitionBy(key).orderBy(F.col("eff_dt").desc())
    later = back.rowsBetween(Window.unboundedPreceding, -1)
    upto = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = runs.withColumn("__has", has).withColumns(
        {
            "__next": F.lag("eff_dt").over(back),
            "__next_ovl": F.last(F.when(has, F.col("eff_dt")), ignorenulls=True).over(later),
            "__newest": F.first(F.col(overlap).cast("int")).over(upto),
        }
    )
    before_next = F.when(F.col("__next") == F.col("eff_dt"), F.col("eff_dt")).otherwise(F.date_sub("__next", 1))
    overlapping = (
        F.when(F.col("__next_ovl").isNotNull(), F.date_sub("__next_ovl", 1))
        .when(F.col("__newest") == 1, open_end())
        .otherwise(before_next)
    )
    ends = F.when(F.coalesce(F.col("__has"), F.lit(False)), overlapping).otherwise(
        F.coalesce(F.date_sub("__next", 1), open_end())
    )
    out = joined.withColumn("disc_dt", ends).withColumn("is_current", F.col("disc_dt") == open_end())
    return out.select(
        surrogate_key(key, "eff_dt").alias(sk),
        key,
        *attrs,
        date_col,
        "eff_dt",
        "disc_dt",
        "is_current",
        row_hash(*attrs).alias("dbt_hash"),
    )


def build_manager_hierarchy(
    positions: DataFrame,
    roots: list,
    *,
    position: str = "position_id",
    emp: str = "emp_id",
    mgr: str = "mgr_id",
) -> DataFrame:
    """One row per position and manager above it, with level and validity.

    Level 1 is the root. The interval of a (position, level) ends before the
    start of the next manager there.
    """
    staffed = positions.filter(F.col(emp).isNotNull() & (F.col(emp).cast("string") != ""))
    nodes = staffed.select(position, emp, mgr, "eff_dt", "disc_dt")
    paths = hierarchy_paths(nodes, emp, mgr, roots)
    members = explode_path(paths.select(position, "eff_dt", "path"), "path", "manager_hier")
    first = members.groupBy(position, "manager_hier", "level").agg(F.min("eff_dt").alias("eff_dt"))
    # Bounded: a position has at most one manager of a level per start date and manager.
    closed = close_intervals(
        first, [position, "level"], "eff_dt", order=["eff_dt", "manager_hier"], same_day=False
    )
    return closed.select(
        surrogate_key(position, "level", "eff_dt").alias("manager_sk"),
        position,
        "manager_hier",
        "level",
        "eff_dt",
        "disc_dt",
        "is_current",
    )
