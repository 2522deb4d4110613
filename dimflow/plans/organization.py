"""Organisation dimension (three sources, hash compare, Type-2 merge) and its views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.convert import canonical_code, prefer
from dimflow.functions.dates import OPEN_END, open_end
from dimflow.functions.keys import row_hash, surrogate_key
from dimflow.functions.text import correct_cost_center
from dimflow.operators.merge import scd2_merge
from dimflow.operators.reshape import min_max_dates, stamp
from dimflow.operators.windows import latest_per_key
from dimflow.session import stage_table

# Levels of the hierarchy as (name, code column, description column).
LEVELS = (
    ("region", "region_nbr", "region_nm"),
    ("area", "area_nbr", "area_nm"),
    ("business_unit", "bu_nbr", "bu_desc"),
    ("division", "div_nbr", "div_nm"),
    ("lob", "lob", "lob_desc"),
    ("department", "sub_lob", "sub_lob_desc"),
    ("local_use", "local_use", "local_desc"),
)
NO_LOCAL_USE = "0000"
# Date sentinels of the hierarchy source.
NEVER_ENDED = dt.date(1816, 3, 29)
FIRST_START = dt.date(1950, 1, 1)
UNDATED_START = dt.date(1900, 1, 1)

CANONICAL = ("division_cd", "department_cd", "curr_division_cd", "curr_department_cd")


def company_rows(company: DataFrame) -> DataFrame:
    """Newest row per corrected cost centre, split into its code fields."""
    cc = F.col("cost_center")
    block = F.trim(F.substring(cc, 8, 4))
    zeroed = (block < "1000") | (block == "ARCH")
    rows = company.filter(~F.upper("cc_code").like("CC_UPDATE%")).select(
        F.trim(F.substring(cc, 1, 4)).alias("com_div"),
        F.when(zeroed, F.lit(NO_LOCAL_USE)).otherwise(block).alias("com_local"),
        F.trim(F.substring(cc, 15, 4)).alias("com_dept"),
        F.when(zeroed, F.concat(F.substring("cc_code", 1, 7), F.lit("0000"), F.substr("cc_code", F.lit(12))))
        .otherwise(F.col("cc_code"))
        .alias("cost_center_cd"),
        correct_cost_center(cc).alias("cost_center_desc"),
        F.when(zeroed, F.concat(F.substring(cc, 1, 7), F.lit("0000 -"), F.substring(cc, 14, 4)))
        .otherwise(F.substring(cc, 1, 17))
        .alias("cost_center_id"),
        "rpt_run_dtm",
    )
    return latest_per_key(rows, ["cost_center_cd"], [F.col("rpt_run_dtm").desc(), "cost_center_desc"])


def legal_entities(company: DataFrame) -> DataFrame:
    """Newest legal entity per division."""
    rows = company.filter(~F.upper("cc_code").like("CC_UPDATE%")).select(
        F.trim(F.substring("cost_center", 1, 4)).alias("fein_div"), "fein", "company_name", "rpt_run_dtm"
    )
    return latest_per_key(rows, ["fein_div"], [F.col("rpt_run_dtm").desc(), "fein", "company_name"]).drop("rpt_run_dtm")


def hierarchy_rows(hier: DataFrame, source_system: str = "OFC") -> DataFrame:
    """Live hierarchy rows with repaired dates, first start per place."""
    ended = F.when(F.col("disc_dt").cast("date") != F.lit(NEVER_ENDED), F.col("disc_dt").cast("date"))
    rows = hier.filter(F.col("is_current") & (F.col("source_system") == source_system)).withColumns(
        {
            "h_eff": F.when(F.col("disc_dt").isNull(), F.lit(FIRST_START)).otherwise(F.col("eff_dt").cast("date")),
            "h_disc": F.coalesce(ended, open_end()),
            "h_local": F.coalesce(F.col("local_use"), F.lit(NO_LOCAL_USE)),
        }
    )
    place = ["region_nbr", "area_nbr", "bu_nbr", "div_nbr", "local_use", "sub_lob"]
    return latest_per_key(rows, place, ["h_eff", "div_nm"])


def _wanted() -> dict[str, str]:
    """Output column -> hierarchy column."""
    cols: dict[str, str] = {"lob_category": "lob_category", "curr_lob_category": "cur_lob_category"}
    for name, code, desc in LEVELS:
        cols[f"{name}_cd"], cols[f"{name}_desc"] = code, desc
        now = "" if name == "local_use" else "cur_"
        cols[f"curr_{name}_cd"], cols[f"curr_{name}_desc"] = now + code, now + desc
    return cols


def organization_rows(
    hier: DataFrame, company: DataFrame, target: DataFrame | None, today: dt.date
) -> DataFrame:
    """Today's organisation rows: hierarchy first, what it lacks from the current dimension."""
    h = hierarchy_rows(hier).alias("h")
    com = company_rows(company).alias("c")
    legal = legal_entities(company).alias("f")
    wanted = _wanted()
    cost = ["cost_center_cd", "cost_center_desc", "cost_center_id"]
    entity = {"legal_entity_cd": "fein", "legal_entity_desc": "company_name"}
    joined = (
        h.join(
            com,
            (F.col("c.com_div") == F.col("h.div_nbr"))
            & (F.col("c.com_local") == F.col("h.h_local"))
            & (F.col("c.com_dept") == F.col("h.sub_lob")),
            "left",
        ).join(legal, F.col("f.fein_div") == F.col("h.div_nbr"), "left")
    )
    if target is not None:
        kept = target.filter("is_current").alias("o")
        place = surrogate_key("h.div_nbr", "h.h_local", "h.sub_lob")
        joined = joined.join(
            kept, place == surrogate_key("o.division_cd", "o.local_use_cd", "o.department_cd"), "left"
        )

    def else_kept(first: str, name: str, *more: Column) -> Column:
        kept = [F.col(f"o.{name}")] if target is not None else []
        return prefer(first, *kept, *more).cast("string")

    out: dict[str, Column] = {c: F.col(f"c.{c}") for c in cost}
    out |= {n: else_kept(f"f.{s}", n) for n, s in entity.items()}
    out |= {n: else_kept(f"h.{s}", n, *([F.lit(NO_LOCAL_USE)] if n == "local_use_cd" else [])) for n, s in wanted.items()}
    out |= {f"curr_{c}": else_kept(f"c.{c}", f"curr_{c}") for c in cost}
    out |= {f"curr_{n}": else_kept(f"f.{s}", f"curr_{n}") for n, s in entity.items()}
    for c in CANONICAL:
        out[c] = canonical_code(out[c])
    start = F.when(F.col("h.h_eff") == F.lit(UNDATED_START), F.lit(today)).otherwise(F.col("h.h_eff"))
    rows = joined.select(*[c.alias(n) for n, c in out.items()], start.alias("eff_dt"))
    place = ["division_cd", "local_use_cd", "department_cd"]
    return rows.select(
        surrogate_key(*place, "eff_dt").alias("org_sk"),
        surrogate_key(*place).alias("org_pk"),
        row_hash(*out).alias("dbt_hash"),
        *rows.columns,
    )


def build_org_dim(
    hier: DataFrame,
    company: DataFrame,
    target: DataFrame | None = None,
    *,
    today: dt.date,
    rec_src: str | None = None,
    now: dt.datetime | None = None,
) -> DataFrame:
    """New and changed organisations, merged as new versions into the target.

    Rows whose hash the target already holds are dropped first. One new version
    per organisation: the row with the latest start.
    """
    rows = organization_rows(hier, company, target, today)
    fresh = rows if target is None else rows.join(target.select("dbt_hash").distinct(), "dbt_hash", "left_anti")
    one = latest_per_key(fresh, ["org_pk"], [F.col("eff_dt").desc(), "dbt_hash"])
    out = one.drop("eff_dt").withColumns(
        {"rpt_eff_dt": F.lit(today), "disc_dt": F.lit(OPEN_END), "is_current": F.lit(True)}
    )
    if rec_src is not None:
        out = stamp(out, rec_src, now)
    return out if target is None else scd2_merge(target, stage_table(out, "org"), ["org_pk"], check=False)


# -- current views -------------------------------------------------------------

_BASE = ["region", "area", "business_unit", "division"]


def current_org_view(dim: DataFrame, level: str) -> DataFrame:
    """Current organisations rolled up to 'div', 'local' or 'lob'.

    One row per code tuple with the dates it spans; of several descriptions of
    one tuple the first in text order is shown. Grouping by codes and
    descriptions is partially aggregated, so the window sees groups only.
    """
    extra = {
        "div": [],
        "local": ["department", "local_use", "legal_entity", "cost_center"],
        "lob": ["department", "local_use", "lob", "legal_entity", "cost_center"],
    }[level]
    names = _BASE + extra
    keys = [f"{n}_cd" for n in names]
    shown = keys + [f"{n}_desc" for n in names]
    shown += ["cost_center_id"] if extra else []
    shown += ["lob_category"] if "lob" in extra else []
    grouped = min_max_dates(dim.filter("is_current"), shown, "rpt_eff_dt", "disc_dt")
    one = latest_per_key(grouped, keys, [c for c in shown if c not in keys])
    codes = [c for c in ("division_cd", "department_cd") if c in keys]
    return one.withColumns({c: canonical_code(c) for c in codes})


def current_org_views(dim: DataFrame) -> dict[str, DataFrame]:
    return {level: current_org_view(dim, level) for level in ("div", "local", "lob")}
