"""Type-1 and Type-2 dimensions and attribute-change logs from daily snapshots."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.functions.dates import open_end
from dimflow.functions.keys import row_hash, surrogate_key
from dimflow.operators import merge
from dimflow.operators.joins import intersect_intervals
from dimflow.operators.reshape import changes_only, rename_map, stamp, unpivot_attrs
from dimflow.operators.windows import (
    Lag,
    Lead,
    close_intervals,
    daily,
    disappeared,
    first_seen,
    islands,
    keyed_window,
    latest_per_key,
)
from dimflow.sources.readers import history_of_changed_keys, since_watermark, since_watermark_by_key
from dimflow.session import stage_table


def build_scd1(
    stage: DataFrame,
    key: list[str],
    order: list[Column | str],
    *,
    sk: str,
    rename: dict[str, str] | None = None,
    target: DataFrame | None = None,
    date_col: str | None = None,
    target_date_col: str | None = None,
    per_key_mark: bool = False,
    rec_src: str | None = None,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Latest row per key, merged into the target when there is one.

    ``key`` and ``order`` use the names after ``rename``; so does the surrogate
    key, which is taken over the same columns that identify a row.
    """
    fresh = rename_map(stage, rename) if rename else stage
    if target is not None and date_col is not None:
        at = target_date_col or date_col
        if per_key_mark:
            fresh = since_watermark_by_key(fresh, target, key, date_col, at)
        else:
            fresh = since_watermark(fresh, target, date_col, at)
    # Ranked by the surrogate key, in which null and '' are the same; the order ends with all columns.
    ties = [F.col(c) for c in fresh.columns if fresh.schema[c].dataType.typeName() not in ("map", "variant")]
    latest = latest_per_key(fresh.withColumn(sk, surrogate_key(*key)), [sk], [*order, *ties])
    out = latest.select(sk, *fresh.columns)
    if rec_src is not None:
        out = stamp(out, rec_src, now)
    if target is None:
        return out
    return merge.merge_upsert(target, stage_table(out, sk), [sk], no_update_cols=("ins_batch_id",))


def type2_versions(
    stage: DataFrame,
    key: list[str],
    attrs: list[str],
    date_col: str,
    *,
    sk: str,
    method: str = "islands",
    order: list[Column | str] | None = None,
    one_row_a_day: bool = False,
    gap_days: int | None = None,
) -> DataFrame:
    """Versions with validity interval, surrogate key and row hash.

    ``islands`` keeps the first row of every run of equal attributes;
    ``first_seen`` keeps each distinct attribute tuple once.
    """
    rows = stage.select(*key, *attrs, date_col) if order is None else stage
    if method == "first_seen":
        # Aggregated before the shuffle; a state holds one row per key whatever
        # the number of days it lasted.
        starts = first_seen(rows, [*key, *attrs], date_col)
        ranked = [date_col, *attrs]
        # Several states a day are possible here, so a key is not bounded by days.
        bounded = one_row_a_day
    elif method == "islands":
        rows = rows if one_row_a_day else daily(rows, key, date_col, order or list(attrs))
        starts = islands(rows, key, attrs, date_col, gap_days=gap_days).select(*key, *attrs, date_col)
        ranked, bounded = [date_col], True
    else:
        raise ValueError(f"unknown method {method!r}")
    dated = starts.withColumn("eff_dt", F.col(date_col).cast("date"))
    closed = close_intervals(dated, key, "eff_dt", order=ranked, bounded=bounded, slice_by=F.year("eff_dt"))
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


def build_scd2(
    stage: DataFrame,
    key: list[str],
    attrs: list[str],
    date_col: str,
    *,
    sk: str,
    target: DataFrame | None = None,
    arrived: Column | None = None,
    done: dt.date | None = None,
    rec_src: str | None = None,
    now: dt.datetime | None = None,
    **how,
) -> DataFrame:
    """Type-2 dimension; with a target, only keys that reported since its mark are touched.

    ``arrived`` tells the rows of the stage that are new in this run, by a load date or a
    report date, and ``done`` the last day that earlier runs have seen. Then the new days
    go on from the latest version of their keys and no older row is read, except for keys
    with a late row, one of a day earlier runs have seen. Without ``arrived``, for states
    first seen and with gaps, which a version doesn't tell, the whole history of every
    key that reported is taken. A rebuilt key's versions that are not built again, as
    after a late report, are taken out of the target.
    """
    if target is None:
        out = type2_versions(stage, key, attrs, date_col, sk=sk, **how)
        return stamp(out, rec_src, now) if rec_src is not None else out
    if arrived is None or how.get("method", "islands") != "islands" or how.get("gap_days") is not None:
        changed = since_watermark(stage, target, date_col, date_col)
        history = history_of_changed_keys(stage, changed, key)
        out = type2_versions(history, key, attrs, date_col, sk=sk, **how)
    else:
        if done is None:
            done = stage.filter(~arrived).agg(F.max(F.col(date_col).cast("date"))).first()[0]
        new, day = stage.filter(arrived), F.col(date_col).cast("date")
        late = stage_table(new.filter(day <= F.lit(done)).select(*key).distinct(), "late")
        fresh = new if done is None else new.filter(day > F.lit(done))
        built = continue_versions(_of_keys(fresh, late, key, "left_anti"), target, key, attrs, date_col, sk=sk, **how)
        if late.isEmpty():
            rebuilt = stage_table(stamp(built, rec_src, now) if rec_src is not None else built, sk)
            return merge.merge_upsert(target, rebuilt, [sk], no_update_cols=("ins_batch_id",))
        history = type2_versions(_of_keys(stage, late, key, "left_semi"), key, attrs, date_col, sk=sk, **how)
        fixed = _replace_keys(target, stamp(history, rec_src, now) if rec_src is not None else history, key, sk)
        rebuilt = stage_table(stamp(built, rec_src, now) if rec_src is not None else built, sk)
        return merge.merge_upsert(fixed, rebuilt, [sk], no_update_cols=("ins_batch_id",))
    if rec_src is not None:
        out = stamp(out, rec_src, now)
    return _replace_keys(target, out, key, sk)


def _of_keys(df: DataFrame, keys: DataFrame, key: list[str], how: str) -> DataFrame:
    named = keys.select(*[F.col(k).alias(f"__k_{k}") for k in key])
    return df.join(named, reduce(lambda a, b: a & b, [df[k].eqNullSafe(named[f"__k_{k}"]) for k in key]), how)


def _replace_keys(target: DataFrame, out: DataFrame, key: list[str], sk: str) -> DataFrame:
    """The target with the keys of ``out`` as they are in ``out``."""
    rebuilt = stage_table(out, sk)
    again = rebuilt.select(F.col(sk).alias("__again"))
    of_keys = _of_keys(target, rebuilt.select(*key).distinct(), key, "left_semi")
    stale = of_keys.join(again, F.col(sk) == F.col("__again"), "left_anti").select(sk)
    kept = target.join(stale, sk, "left_anti")
    return merge.merge_upsert(kept, rebuilt, [sk], no_update_cols=("ins_batch_id",))


def continue_versions(
    fresh: DataFrame,
    target: DataFrame,
    key: list[str],
    attrs: list[str],
    date_col: str,
    *,
    sk: str,
    order: list[Column | str] | None = None,
    one_row_a_day: bool = False,
    method: str = "islands",
) -> DataFrame:
    """Versions that new days begin, and the versions these end, from each key's latest version.

    That version stands before the new days as if it were a row of its first day: its
    state is all that the history says about them. ``fresh`` holds days after all that
    the target has been built from. Versions that stay as they are aren't returned.
    """
    rows = fresh if one_row_a_day else daily(fresh, key, date_col, order or list(attrs))
    rows = stage_table(rows.select(*key, *attrs, date_col), "days")
    ranked = [F.col("eff_dt").desc(), F.col(sk).desc()]
    latest = latest_per_key(_of_keys(target, rows.select(*key).distinct(), key, "left_semi"), key, ranked)
    latest = stage_table(latest.select(sk, *key, *attrs, date_col, "disc_dt"), "latest")
    before = latest.select(*key, *attrs, F.col(date_col).cast(rows.schema[date_col].dataType).alias(date_col))
    out = type2_versions(rows.unionByName(before), key, attrs, date_col, sk=sk, one_row_a_day=True)
    same = latest.select(F.col(sk).alias("__sk"), F.col("disc_dt").alias("__disc"))
    return out.join(same, (F.col(sk) == F.col("__sk")) & (F.col("disc_dt") == F.col("__disc")), "left_anti")


def load_scd2_history(
    stage: DataFrame,
    key: list[str],
    attrs: list[str],
    date_col: str,
    *,
    sk: str,
    until: dt.date | None = None,
    one_row_a_day: bool = False,
) -> DataFrame:
    """One-off backfill for an absent target, from the states first seen up to a date."""
    past = stage if until is None else stage.filter(F.col(date_col) <= F.lit(until))
    return type2_versions(past, key, attrs, date_col, sk=sk, method="first_seen", one_row_a_day=one_row_a_day)


def close_disappeared(
    dim: DataFrame,
    stage: DataFrame,
    key: list[str],
    date_col: str,
    *,
    disc: str = "disc_dt",
    current: str = "is_current",
) -> DataFrame:
    """Close the open version of keys that have left the feed, on their last date.

    Gaps inside a key's history close nothing; only leaving for good does.
    """
    gone = disappeared(stage, key, date_col, "last_seen_dt")
    return merge.update_from(
        dim,
        gone,
        key,
        {disc: F.col("s_last_seen_dt").cast("date"), current: F.lit(False)},
        when=F.col(disc) == open_end(),
        check=False,
    )


# Column that carries a key's last report date from the snapshots to the finished log.
LAST_SEEN = "__last_seen"


def _finish_log(changes: DataFrame, key: list[str], feed_end: Column, sk: str, deleted: str) -> DataFrame:
    """Validity, next value, current/deleted/rescind flags of a log of changes.

    ``changes`` carries each key's last report date, so no second look at the
    snapshots is needed to tell which keys have left the feed.
    """
    series = [*key, "change_column"]
    # One row per key, attribute and start: a window is bounded by the days.
    nexts = keyed_window(
        changes,
        series,
        ["eff_dt", "current_value"],
        {"__next_eff": Lead("eff_dt"), "next_value": Lead("current_value")},
        bounded=True,
    )
    marked = nexts.withColumn("disc_dt", F.coalesce(F.date_sub("__next_eff", 1), open_end())).withColumn(
        "is_current", F.col("__next_eff").isNull().cast("int")
    )
    is_deleted = (F.col(LAST_SEEN) != feed_end) & (F.col("is_current") == 1)
    return marked.select(
        surrogate_key("change_column", *key, "rpt_dt").alias(sk),
        "change_column",
        *key,
        "current_value",
        "prior_value",
        "next_value",
        "eff_dt",
        "disc_dt",
        "is_current",
        F.when(is_deleted, 1).otherwise(0).alias("is_deleted"),
        F.when(is_deleted, F.date_add(LAST_SEEN, 1)).alias("deleted_dt"),
        F.when(is_deleted, F.lit(deleted))
        .when(F.col("eff_dt") > F.col("disc_dt"), F.lit("Rescind"))
        .alias("change_type"),
    )


def _feed_end(stage: DataFrame, date_col: str) -> Column:
    """The feed's last date: a scan of one column, put in as a constant."""
    return stage.agg(F.max(F.col(date_col).cast("date"))).scalar()


def attribute_changes(
    stage: DataFrame,
    key: list[str],
    attrs: list[str],
    date_col: str,
    order: list[Column | str] | None = None,
    *,
    one_row_a_day: bool = False,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """(key, attribute, value, prior value, date) for every change of a known value.

    Everything after the daily rows runs on one partitioning by key.
    """
    keep = keep or {}
    rows = stage.select(*key, *attrs, date_col, *[c.alias(n) for n, c in keep.items()])
    rows = rows if one_row_a_day else daily(rows, key, date_col, order or list(attrs))
    day = F.col(date_col).cast("date")
    dated = rows.withColumn(LAST_SEEN, F.max(day).over(Window.partitionBy(*key)))
    tall = unpivot_attrs(dated.withColumn("rpt_dt", day), [*key, "rpt_dt", LAST_SEEN, *keep], attrs)
    lagged = keyed_window(
        tall, [*key, "change_column"], ["rpt_dt"], {"prior_value": Lag("current_value")}, bounded=True
    )
    return changes_only(lagged).withColumn("eff_dt", F.col("rpt_dt"))


def build_attribute_log(
    stage: DataFrame,
    key: list[str],
    attrs: list[str],
    date_col: str,
    *,
    sk: str = "event_sk",
    deleted: str = "Deleted",
    order: list[Column | str] | None = None,
    one_row_a_day: bool = False,
) -> DataFrame:
    """Change log: one row per change of one attribute, with prior and next value."""
    changes = attribute_changes(stage, key, attrs, date_col, order, one_row_a_day=one_row_a_day)
    return _finish_log(changes, key, _feed_end(stage, date_col), sk, deleted)


def termination_changes(
    stage: DataFrame,
    key: str,
    term_col: str,
    date_col: str,
    *,
    until: dt.date | None = None,
    attribute: str = "TERMINATION_DT",
) -> DataFrame:
    """Changes of a termination date that is present or absent from day to day.

    A key contributes its undated days before its latest known termination and
    that termination itself. Absence is carried as a sentinel date, so that an
    absence is a value with a prior and a next; it is null in the result.
    A termination takes effect on the day after its date.

    The snapshots are reduced to one row per key, day and date before the one
    shuffle by key, on which all steps run.
    """
    # Fixed value: stands for 'no termination' while changes are detected.
    none = F.lit("1900-01-01")
    rows = stage.select(key, F.col(term_col).cast("date").alias("term"), F.col(date_col).cast("date").alias("day"))
    rows = rows.distinct()
    usable = F.lit(True) if until is None else F.col("day") <= F.lit(until)
    by_key = Window.partitionBy(key)
    known = F.when(usable & F.col("term").isNotNull(), F.struct("day", "term"))
    rows = rows.withColumns({LAST_SEEN: F.max("day").over(by_key), "__known": F.max(known).over(by_key)})
    is_last = F.col("term").isNotNull() & (F.struct("day", "term") == F.col("__known"))
    is_absent = F.col("term").isNull() & (F.col("__known").isNull() | (F.col("day") < F.col("__known.term")))
    points = rows.filter(usable & (is_last | is_absent)).select(
        key,
        LAST_SEEN,
        F.coalesce(F.col("term").cast("string"), none).alias("current_value"),
        F.coalesce("term", "day").alias("day"),
    )
    lagged = keyed_window(
        points, [key], ["day", "current_value"], {"prior_value": Lag("current_value")}, bounded=True
    )
    changed = changes_only(lagged)
    return changed.select(
        F.lit(attribute).alias("change_column"),
        key,
        F.nullif("current_value", none).alias("current_value"),
        F.nullif("prior_value", none).alias("prior_value"),
        F.when(F.col("current_value") != none, F.date_add("day", 1)).otherwise(F.col("day")).alias("eff_dt"),
        F.col("day").alias("rpt_dt"),
        LAST_SEEN,
    )


def build_termination_log(
    stage: DataFrame,
    key: str,
    term_col: str,
    date_col: str,
    *,
    until: dt.date | None = None,
    sk: str = "event_sk",
    deleted: str = "Deleted",
) -> DataFrame:
    changes = termination_changes(stage, key, term_col, date_col, until=until)
    return _finish_log(changes, [key], _feed_end(stage, date_col), sk, deleted)


def build_employee_log(
    stage: DataFrame,
    key: str,
    attrs: list[str],
    date_col: str,
    *,
    term_col: str,
    hire_col: str,
    first_report: dt.date,
    until: dt.date | None = None,
    sk: str = "event_sk",
    deleted: str = "Employee_Deleted",
) -> DataFrame:
    """Attribute log with a termination attribute and back-dated first values.

    A first value starts on the original hire date, but not before
    ``first_report``, the day the feed began.
    """
    hire = F.col(hire_col).cast("date")
    plain = attribute_changes(stage, [key], attrs, date_col, keep={"__hire": hire})
    start = F.when(
        F.col("prior_value").isNull() & F.col("__hire").isNotNull(),
        F.greatest(F.col("__hire"), F.lit(first_report)),
    ).otherwise(F.col("eff_dt"))
    plain = plain.withColumn("eff_dt", start).drop("__hire")
    terms = termination_changes(stage, key, term_col, date_col, until=until)
    return _finish_log(plain.unionByName(terms), [key], _feed_end(stage, date_col), sk, deleted)


def wide_view(log: DataFrame, key: str, attrs: list[str], *, sk: str = "emp_sk") -> DataFrame:
    """Attribute log back to wide rows, one per span in which all attributes are known.

    Rescinded rows are left out. The key is a plain md5 of key and start.
    """
    live = log.filter(F.coalesce(F.col("change_type"), F.lit("")) != "Rescind")
    wide = intersect_intervals(live, [key], attrs)
    return wide.withColumn(sk, F.md5(F.concat(F.col(key).cast("string"), F.col("eff_dt").cast("string"))))


def build_job_desc(
    events: DataFrame,
    id_col: Column,
    desc_col: str,
    date_col: str,
    *,
    sk: str = "job_desc_sk",
    id_name: str = "position_id",
) -> DataFrame:
    """Type-2 from an event feed whose id is derived from the row."""
    rows = events.select(id_col.alias(id_name), F.col(desc_col), F.col(date_col).cast("date").alias(date_col))
    return type2_versions(rows, [id_name], [desc_col], date_col, sk=sk, method="first_seen")


