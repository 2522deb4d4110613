"""Pay codes, accumulator bridges, costing, compensation plans, roles, term reasons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.functions.convert import flag
from dimflow.functions.dates import open_end
from dimflow.functions.keys import row_hash, surrogate_key
from dimflow.functions.text import split_part_safe
from dimflow.operators.joins import join_nullable, join_one_row
from dimflow.operators.reshape import append_rows, explode_list, stamp, sum_as_text, union_extracts
from dimflow.operators.windows import Lead, Number, close_intervals, daily, first_seen, islands, keyed_window, latest_per_key

# Pay code types of the two kinds.
EARNING_TYPES = ("Workday_Earning_Code", "Earning_Code")
DEDUCTION_TYPES = ("Workday_Deduction_Code", "Deduction_Code")


def membership(df: DataFrame, members: dict[str, tuple[DataFrame, str]], on: str) -> DataFrame:
    """One 1/null flag per named member list, matched on trimmed text.

    Each list is reduced to its distinct trimmed names first, so a name listed
    twice does not double the row.
    """
    for name, (table, col) in members.items():
        side = table.select(F.trim(F.col(col)).alias("__m")).filter(F.col("__m").isNotNull()).distinct()
        df = df.join(side, F.trim(df[on]) == side["__m"], "left").withColumn(name, F.when(F.col("__m").isNotNull(), 1))
        df = df.drop("__m")
    return df


def build_accumulator_bridge(
    acc: DataFrame,
    paycodes: DataFrame,
    groups: DataFrame,
    calcs: DataFrame,
    col: str,
    *,
    wid: str = "pay_accumulation_wid",
    code: str = "pay_accumulation_cd",
    stamp_col: str = "sf_insert_timestamp",
    sk: str | None = None,
) -> DataFrame:
    """One row per accumulator and element of a ';'-list, with four membership flags."""
    pieces = explode_list(acc.select(wid, code, col, stamp_col), col)
    one = latest_per_key(pieces, [wid, col], [F.col(stamp_col).desc(), code])
    earn = paycodes.filter(F.col("pay_cd_type").isin(*EARNING_TYPES))
    deduct = paycodes.filter(F.col("pay_cd_type").isin(*DEDUCTION_TYPES))
    flagged = membership(
        one,
        {
            "earning_cd_ind": (earn, "calc_cd"),
            "deduction_cd_ind": (deduct, "calc_cd"),
            "pay_component_group_ind": (groups, "pay_component_group_name"),
            "pcrc_ind": (calcs, "payroll_calc"),
        },
        col,
    )
    return flagged.select(
        surrogate_key(wid, col).alias(sk or f"{col}_sk"),
        F.concat(F.col(wid), F.lit("-"), F.col(col)).alias(f"{col}_id"),
        wid,
        code,
        col,
        "earning_cd_ind",
        "deduction_cd_ind",
        "pay_component_group_ind",
        "pcrc_ind",
    )


def build_paycodes(
    earnings: DataFrame,
    deductions: DataFrame,
    *,
    key: tuple[str, str] = ("pay_cd", "pay_cd_type"),
    stamp_col: str = "sf_insert_timestamp",
    rec_src: str | None = None,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Earnings and deductions in one shape, the newest row per code and type."""
    both = earnings.unionByName(deductions, allowMissingColumns=True)
    one = latest_per_key(union_extracts(both), list(key), [F.col(stamp_col).desc()])
    out = one.select(surrogate_key(*key).alias("paycode_sk"), *[c for c in one.columns if c != stamp_col])
    return stamp(out, rec_src, now) if rec_src is not None else out


def build_paycode_group_bridge(earn: DataFrame, deduct: DataFrame) -> DataFrame:
    """Group, earning and deduction, with groups that have only one of the two.

    Both sides are made distinct before they meet. The group is the earning
    side's, as the source defines it: null for deduction-only groups.
    """
    e = earn.select(F.col("pay_component_group_id").alias("g"), F.col("paycode_earning_id").alias("pay_cd_earning_id"))
    d = deduct.select(F.col("pay_component_group_id").alias("h"), F.col("paycode_deduction_id").alias("pay_cd_deduction_id"))
    e, d = e.distinct(), d.distinct()
    both = e.join(d, F.col("g") == F.col("h"), "full_outer")
    # A deduction without a group partner shows no group; equal ones fall together.
    out = both.select(F.col("g").alias("pay_component_group_id"), "pay_cd_earning_id", "pay_cd_deduction_id").distinct()
    return out.select(surrogate_key(*out.columns).alias("paycode_component_group_sk"), *out.columns)


def build_costing_allocations(
    stage: DataFrame, keys: list[str], amount: str, *, out: str = "dist_pct_sens", sk: str = "costing_allocations_sk"
) -> DataFrame:
    """Summed distribution per allocation, as text."""
    summed = sum_as_text(stage, keys, amount, out)
    return summed.select(surrogate_key(*keys).alias(sk), *summed.columns)


def build_comp_plan(
    stage: DataFrame,
    key: list[str],
    attrs: list[str],
    date_col: str = "rpt_eff_dt",
    *,
    sk: str = "comp_plan_sk",
    null_safe: bool = True,
) -> DataFrame:
    """Versions of a plan whose composite key may hold nulls.

    ``null_safe=True`` takes null as a key value, so the next version is a
    window step. ``null_safe=False`` lets a null fit any value when looking for
    the next version, as a join on version number and wildcard columns.
    """
    states = first_seen(stage, [*key, *attrs], date_col)
    year = F.year(date_col)
    if null_safe:
        dated = states.withColumn("eff_dt", F.col(date_col).cast("date"))
        closed = close_intervals(dated, key, "eff_dt", order=["eff_dt", *attrs], same_day=False, bounded=False, slice_by=year)
    else:
        numbered = keyed_window(
            states, key, [F.col(date_col).desc(), *attrs], {"__v": Number()}, slice_by=-year
        ).withColumn("eff_dt", F.col(date_col).cast("date"))
        left = numbered.withColumnsRenamed({k: f"l_{k}" for k in key}).withColumn("__prev", F.col("__v") - 1)
        right = numbered.select(
            *[F.col(k).alias(f"r_{k}") for k in key], F.col("__v").alias("__rv"), F.col("eff_dt").alias("__next")
        )
        renamed = left.withColumnsRenamed({"__prev": "prev_version", "__v": "version"})
        right = right.withColumnsRenamed({"__rv": "next_version", "__next": "next_eff"})
        met = join_nullable(renamed, right, key, {"prev_version": "next_version"}, null_safe=False)
        closed = met.withColumnsRenamed({f"l_{k}": k for k in key}).withColumn(
            "disc_dt", F.coalesce(F.date_sub("next_eff", 1), open_end())
        )
        closed = closed.withColumn("is_current", F.col("next_eff").isNull())
    return closed.select(
        surrogate_key(*key, "eff_dt").alias(sk),
        *key,
        *attrs,
        date_col,
        "eff_dt",
        "disc_dt",
        "is_current",
        row_hash(*attrs).alias("dbt_hash"),
    )


def build_role_assignments(
    stage: DataFrame,
    key: list[str],
    attrs: list[str],
    date_col: str = "rpt_eff_dt",
    *,
    sk: str = "role_assign_sk",
    one_row_a_day: bool = False,
) -> DataFrame:
    """Runs of equal state; the last run of a key that left the feed ends on its last date."""
    rows = stage.select(*key, *attrs, date_col)
    rows = rows if one_row_a_day else daily(rows, key, date_col, attrs)
    # A key's last date is read on the partitioning the runs need anyway.
    dated = rows.withColumn("eff_dt", F.col(date_col).cast("date"))
    dated = dated.withColumn("__last", F.max("eff_dt").over(Window.partitionBy(*key)))
    runs = islands(dated, key, attrs, date_col)
    nexts = keyed_window(runs, key, ["eff_dt"], {"__next": Lead("eff_dt")}, bounded=True)
    seen = join_one_row(nexts, stage.agg(F.max(F.col(date_col).cast("date")).alias("__feed")))
    end = (
        F.when(F.col("__next") == F.col("eff_dt"), F.col("eff_dt"))
        .when(F.col("__next").isNull() & (F.col("__last") < F.col("__feed")), F.col("__last"))
        .otherwise(F.date_sub("__next", 1))
    )
    out = seen.withColumn("disc_dt", F.coalesce(end, open_end()))
    return out.select(
        surrogate_key(*key, "eff_dt").alias(sk),
        *key,
        *attrs,
        date_col,
        "eff_dt",
        "disc_dt",
        (F.col("disc_dt") == open_end()).alias("is_current"),
        row_hash(*attrs).alias("dbt_hash"),
    )


# Event types that end employment.
TERMINATION_TYPES = ("Termination", "End Contingent Worker Contract")

# Termination reasons that count as turnover.
TURNOVER_REASONS = (
    "Workplace Dynamics - Supervisor / Manager",
    "Workplace Dynamics - Job Dissatisfaction",
    "Work Eligibility / Licensure",
    "Unsatisfactory Performance",
    "Safety Violation(s)",
    "Personal / Career Advancement (inactive)",
    "Personal / Career Advancement",
    "Other (inactive)",
    "Misconduct - Violation Comp Policy",
    "Misconduct - Absolutes & Standards",
    "Job Abandonment",
    "Family / Personal - Work Relocation",
    "Family / Personal - Work Location / Commute",
    "Family / Personal - Flexibility (Work Schedule / Hours)",
    "Failure to Return from LOA",
    "Education - Return to School",
    "Education - Lack of Training / Certification",
    "Compensation / Benefits - Compensation to Non-Competitor",
    "Compensation / Benefits - Compensation to Competitor",
    "Compensation / Benefits - Benefits (Medical, Dental, PTO, 401k, etc.)",
    "Career Growth - Moving to Non-Competitor",
    "Career Growth - Moving to Competitor",
    "Attendance",
)

# Rows always present (type, category, subcategory, involuntary, retirement, turnover).
TERM_REASON_ROWS = (
    ("-1", "-1", "-1", 0, 0, 0),
    ("Termination", "Resignation", "Personal / Career Advancement", 0, 0, 1),
    ("Termination", "Other", "Improper ATS Processing", 0, 0, 0),
    ("Termination", "Other", "Allied Merger-Severance", 0, 0, 0),
    ("Termination", "Resignation", "Other", 0, 0, 1),
)


def build_term_reason_lookup(
    events: DataFrame,
    *,
    types: tuple[str, ...] = TERMINATION_TYPES,
    turnover: tuple[str, ...] = TURNOVER_REASONS,
    extra_rows: tuple[tuple, ...] = TERM_REASON_ROWS,
) -> DataFrame:
    """Distinct termination reasons with a turnover flag, and the fixed rows."""

    def level(col: str, n: int) -> Column:
        return F.trim(split_part_safe(col, ">", n))

    reasons = (
        events.filter(F.col("bp_type").isin(*types))
        .select(
            F.col("bp_type").alias("term_type"),
            level("bp_reason_category_sens", 2).alias("term_category"),
            level("bp_reason_sens", 3).alias("term_subcategory"),
            F.col("involuntary").cast("int").alias("involuntary"),
            F.col("retirement").cast("int").alias("retirement"),
        )
        .distinct()
        .filter(F.col("term_category").isNotNull())
    )
    flagged = reasons.withColumn("turnover_filter", flag(F.col("term_subcategory").isin(*turnover)))
    return append_rows(flagged, list(extra_rows))
