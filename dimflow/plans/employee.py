"""Employee dimension: state runs enriched with hires and terminations."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions.keys import surrogate_key
from dimflow.functions.text import correct_cost_center, cost_center_code, split_part_safe, tagged_value
from dimflow.operators.joins import exclude_superseded, join_any
from dimflow.operators.reshape import null_out, stamp
from dimflow.operators.windows import Carry, RunMax, close_intervals, daily, islands, keyed_window, latest_per_key

# How the event feed and the snapshots name things.
HIRE = "Hire"
TERMINATIONS = ("Termination", "End Contingent Worker Contract")
COMPLETED = "Successfully Completed"
CONTINGENT = "Contingent Worker"
TERMINATED = "Terminated"
NO_COST_CENTER = "CC_20000000951"
ACQUISITION_TAG = "Acquired Company/"

TERM_COLS = ("pay_through_dt", "term_completed_dt", "term_dt", "term_reason_sens", "eligible_for_rehire_sens", "term_wid")


@dataclass(frozen=True)
class EmployeeColumns:
    """Columns with a role of their own; all others are tracked as they are."""

    key: str = "ein"
    date: str = "rpt_effective_dt"
    active: str = "active_status"
    worker_type: str = "worker_type"
    status: str = "status"
    cost_center: str = "cost_center_id"
    rehire: str = "is_rehire"
    original_hire: str = "original_hire_dt"
    snapshot_terms: tuple[str, ...] = ("pay_through_dt", "termination_dt", "termination_reason_sens")


def employee_versions(
    snapshots: DataFrame, c: EmployeeColumns = EmployeeColumns(), *, one_row_a_day: bool = False
) -> DataFrame:
    """Runs of equal state, without termination data on active days."""
    rows = exclude_superseded(
        snapshots, c.key, c.worker_type, CONTINGENT, F.col(c.status) == TERMINATED
    )
    nulled = [t for t in c.snapshot_terms if t in snapshots.columns]
    rows = null_out(rows, F.col(c.active).cast("int") == 1, nulled)
    attrs = [a for a in snapshots.columns if a not in (c.key, c.date)]
    rows = rows if one_row_a_day else daily(rows, [c.key], c.date, attrs)
    runs = islands(rows, [c.key], attrs, c.date)
    return runs.withColumn("eff_dt", F.col(c.date).cast("date"))


def hire_dates(versions: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Versions with the start of the hire they belong to.

    A hire counts where it falls on a version's first day and holds until the next.
    """
    hires = (
        events.filter((F.col("bp_type") == HIRE) & (F.col("bp_transaction_status") == COMPLETED))
        .select(F.col(key).alias("__k"), F.col("bp_effective_dt").cast("date").alias("__hired"))
        .distinct()
    )
    on = (versions[key] == hires["__k"]) & (versions["eff_dt"] == hires["__hired"])
    marked = versions.join(hires, on, "left").drop("__k")
    return keyed_window(marked, [key], ["eff_dt"], {"__hire": Carry("__hired")}, bounded=True).drop("__hired")


def terminations(events: DataFrame, key: str) -> DataFrame:
    """One completed termination per person and effective date, the latest completed."""
    ends = events.filter(
        F.col("bp_type").isin(*TERMINATIONS)
        & (F.col("bp_transaction_status") == COMPLETED)
        & F.col("bp_effective_dt").isNotNull()
    ).select(
        F.col(key).alias("__tk"),
        F.col("bp_event_completed_dt").cast("date").alias("term_completed_dt"),
        F.col("bp_effective_dt").cast("date").alias("term_dt"),
        F.trim(F.replace(split_part_safe("bp_reason_sens", ">", 3), F.lit("(inactive)"), F.lit(""))).alias(
            "term_reason_sens"
        ),
        F.col("term_eligible_for_rehire_ind_sens").alias("eligible_for_rehire_sens"),
        F.col("term_pay_through_dt").alias("pay_through_dt"),
        F.col("overall_bp_wid").alias("term_wid"),
    )
    return latest_per_key(ends, ["__tk", "term_dt"], [F.col("term_completed_dt").desc(), "term_wid"])


def build_employee_dim(
    snapshots: DataFrame,
    events: DataFrame,
    *,
    columns: EmployeeColumns = EmployeeColumns(),
    one_row_a_day: bool = False,
    rec_src: str | None = None,
    now: dt.datetime | None = None,
) -> DataFrame:
    c = columns
    versions = hire_dates(employee_versions(snapshots, c, one_row_a_day=one_row_a_day), events, c.key)
    own = [x for x in versions.columns if x not in (*c.snapshot_terms, "__hire")]
    versions = versions.select(*own, "__hire")

    # Terminations completed or effective on a version's first day; the last one counts.
    met = join_any(versions, terminations(events, c.key), {c.key: "__tk"}, "eff_dt", ["term_completed_dt", "term_dt"])
    met = latest_per_key(met, [c.key, "eff_dt"], [F.col("term_completed_dt").desc(), F.col("term_dt").desc()])
    first_stay = F.col(c.rehire).cast("int") == 0
    own_terms = met.withColumns({t: F.when(first_stay, F.col(t)) for t in TERM_COLS}).drop("__tk")
    filled = keyed_window(
        own_terms,
        [c.key],
        ["eff_dt"],
        {f"__m_{t}": RunMax(t) for t in TERM_COLS},
        bounded=True,
    )
    kept = filled.withColumns(
        {t: F.when(F.col(t).isNull() & first_stay, F.col(f"__m_{t}")).otherwise(F.col(t)) for t in TERM_COLS}
    ).drop(*[f"__m_{t}" for t in TERM_COLS])
    closed = close_intervals(kept, [c.key], "eff_dt", current="is_curr")
    derived = {"hire_dt": F.coalesce(F.col("__hire"), F.col(c.original_hire))}
    if c.cost_center in snapshots.columns:
        derived["cost_center_cd"] = correct_cost_center(cost_center_code(c.cost_center), NO_COST_CENTER)
    if "other_ids_pii" in snapshots.columns:
        derived["acquisition_id"] = tagged_value("other_ids_pii", ACQUISITION_TAG)
    if "location" in snapshots.columns:
        inner = F.split_part(F.split_part("location", F.lit("("), F.lit(2)), F.lit(")"), F.lit(1))
        derived["location_id"] = F.concat(F.lit("LOC_"), inner)
    out = closed.withColumns(derived).drop("__hire")
    out = out.select(surrogate_key(c.key, "eff_dt").alias("emp_sk"), *out.columns)
    return stamp(out, rec_src, now) if rec_src is not None else out
