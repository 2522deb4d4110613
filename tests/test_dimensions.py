import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimflow.plans import employee, organization, pay, position


@pytest.fixture(scope="module")
def staff(spark, day):
    snaps = [
        # ein, day, worker type, status, active, termination date, cost centre
        ("e", "2024-01-01", "Employee", "Active", 1, None, "2000 - 0999 - 300"),
        ("e", "2024-01-02", "Employee", "Active", 1, "2023-12-01", "2000 - 0999 - 300"),  # flicker on an active day
        ("e", "2024-01-05", "Employee", "Terminated", 0, "2024-01-05", "2000 - 0999 - 300"),
        ("e", "2024-01-08", "Employee", "Terminated", 0, "2024-01-05", "2000 - 1200 - 300"),
        ("c", "2024-01-01", "Contingent Worker", "Terminated", 0, None, None),
        ("c", "2024-01-02", "Employee", "Active", 1, None, None),
        ("only", "2024-01-01", "Contingent Worker", "Terminated", 0, None, None),
    ]
    cols = "ein string, rpt_effective_dt date, worker_type string, status string, active_status int, termination_dt date, cost_center_id string"
    df = spark.createDataFrame([(e, day(x), w, s, a, day(t), c) for e, x, w, s, a, t, c in snaps], cols)
    df = df.withColumns({"is_rehire": F.lit(0), "original_hire_dt": F.lit("2020-01-01").cast("date")})
    events = [
        ("e", "Hire", "2024-01-01", "2024-01-01", None, "w0"),
        ("e", "Termination", "2024-01-05", "2024-01-06", "x > y > Moved (inactive)", "w1"),
        ("e", "Termination", "2024-01-05", "2024-01-04", "x > y > Older", "w2"),
    ]
    ev = spark.createDataFrame(
        [(e, t, "Successfully Completed", day(x), day(y), r, w) for e, t, x, y, r, w in events],
        "ein string, bp_type string, bp_transaction_status string, bp_effective_dt date, bp_event_completed_dt date, bp_reason_sens string, overall_bp_wid string",
    ).withColumns({"term_eligible_for_rehire_ind_sens": F.lit("N"), "term_pay_through_dt": F.lit("2024-01-20").cast("date")})
    return df, ev


def test_employee_dim(staff, as_rows, day):
    out = employee.build_employee_dim(*staff)
    e = as_rows(out.filter("ein = 'e'"), "eff_dt", "disc_dt", "is_curr", "hire_dt", "term_dt", "term_reason_sens", "term_wid", "cost_center_cd")
    o = day("9999-12-31")
    hired, ended = day("2024-01-01"), day("2024-01-05")
    assert e == [
        # The termination date on an active day starts no version.
        (day("2024-01-01"), day("2024-01-04"), False, hired, None, None, None, "CC_20000000300"),
        # Of two terminations of one day the one completed last counts, and it is carried on.
        (day("2024-01-05"), day("2024-01-07"), False, hired, ended, "Moved", "w1", "CC_20000000300"),
        (day("2024-01-08"), o, True, hired, ended, "Moved", "w1", "CC_20001200300"),
    ]
    c = as_rows(out.filter("ein = 'c'"), "worker_type", "hire_dt", "cost_center_cd")
    assert c == [("Employee", day("2020-01-01"), "CC_20000000951")]
    assert out.filter("ein = 'only'").count() == 1


def test_rehired_staff_have_no_termination(staff):
    snaps, events = staff
    out = employee.build_employee_dim(snaps.withColumn("is_rehire", F.lit(1)), events)
    assert out.filter("term_dt is not null or term_wid is not null").isEmpty()


def test_position_overlap(spark, day, as_rows):
    data = [
        ("open", "2024-01-01", "a", 0), ("open", "2024-01-05", "b", 1), ("open", "2024-01-09", "c", 1),
        ("ends", "2024-01-01", "a", 1), ("ends", "2024-01-05", "b", 0), ("ends", "2024-01-09", "c", 0),
        ("twice", "2024-01-01", "a", 1), ("twice", "2024-01-05", "b", 0), ("twice", "2024-01-09", "a", 1),
        ("plain", "2024-01-01", "a", 0),
    ]
    df = spark.createDataFrame([(p, day(x), j, o) for p, x, j, o in data], "position_id string, rpt_eff_dt date, job string, has_overlap_worker_ind int")
    got = as_rows(position.build_position_dim(df), "position_id", "eff_dt", "disc_dt", "is_current")
    o = day("9999-12-31")
    want = [
        ("open", "2024-01-01", "2024-01-04"), ("open", "2024-01-05", "2024-01-08"), ("open", "2024-01-09", None),
        ("ends", "2024-01-01", "2024-01-04"), ("ends", "2024-01-05", "2024-01-08"), ("ends", "2024-01-09", None),
        ("twice", "2024-01-01", "2024-01-08"), ("twice", "2024-01-05", "2024-01-08"), ("twice", "2024-01-09", None),
        ("plain", "2024-01-01", None),
    ]
    assert got == sorted([(p, day(a), day(b) or o, b is None) for p, a, b in want], key=repr)


def test_manager_hierarchy(spark, day, as_rows):
    o = "9999-12-31"
    data = [("p1", "boss", "boss", "2024-01-01", o), ("p2", "m1", "boss", "2024-01-01", o), ("p4", "m2", "boss", "2024-01-01", o),
            ("p3", "w", "m1", "2024-01-01", "2024-01-31"), ("p3", "w", "m2", "2024-02-01", o), ("p9", "", "boss", "2024-01-01", o)]
    df = spark.createDataFrame([(p, e, m, day(a), day(b)) for p, e, m, a, b in data], "position_id string, emp_id string, mgr_id string, eff_dt date, disc_dt date")
    out = position.build_manager_hierarchy(df, ["boss"])
    got = as_rows(out.filter("position_id = 'p3'"), "level", "manager_hier", "eff_dt", "disc_dt", "is_current")
    assert got == sorted(
        [
            (1, "boss", day("2024-01-01"), day(o), True),
            (2, "m1", day("2024-01-01"), day("2024-01-31"), False),
            (2, "m2", day("2024-02-01"), day(o), True),
            (3, "w", day("2024-01-01"), day(o), True),
        ],
        key=repr,
    )
    assert out.filter("position_id = 'p9'").isEmpty()


@pytest.fixture(scope="module")
def org_feeds(spark):
    place = {"region_nbr": "1", "region_nm": " North ", "area_nbr": "10", "area_nm": "Area", "bu_nbr": "5", "bu_desc": "Unit",
             "lob": "L", "lob_desc": " ", "lob_category": "C", "sub_lob_desc": "Desk", "local_desc": "Local", "source_system": "OFC"}
    keys = [("0042", "1000", "007"), ("0043", None, "007"), ("0044", "1000", "007")]
    hier = []
    for div, local, dept in keys:
        row = {**place, "div_nbr": div, "div_nm": f"Div {div}", "sub_lob": dept, "local_use": local}
        row |= {f"cur_{c}": row[c] for c in list(row) if c not in ("source_system", "local_use", "local_desc")}
        hier.append(row)
    h = spark.createDataFrame(hier).withColumns(
        {"eff_dt": F.lit("2020-01-01").cast("date"), "disc_dt": F.lit(None).cast("date"), "is_current": F.lit(True)}
    )
    company = spark.createDataFrame(
        [("0042 - 1000 - 007 desk", "CC_00421000007", "F42", "Firm", dt.datetime(2024, 1, 2)),
         ("0042 - 1000 - 007 old", "CC_00421000007", "F41", "Firm old", dt.datetime(2024, 1, 1)),
         ("0043 - 0999 - 007 desk", "CC_00430999007", "F43", "Firm", dt.datetime(2024, 1, 1)),
         ("0044 - ARCH - 007 desk", "cc_update_44", "F44", "Firm", dt.datetime(2024, 1, 1))],
        "cost_center string, cc_code string, fein string, company_name string, rpt_run_dtm timestamp",
    )
    return h, company


def test_org_dim(org_feeds, as_rows, spark, tmp_path, day):
    hier, company = org_feeds
    one = organization.build_org_dim(hier, company, today=dt.date(2024, 2, 1))
    got = as_rows(one, "division_cd", "local_use_cd", "department_cd", "cost_center_cd", "cost_center_id", "legal_entity_cd", "region_desc", "lob_desc")
    assert got == sorted(
        [
            ("42", "1000", "7", "CC_00421000007", "0042 - 1000 - 007", "F42", "North", None),
            ("43", "0000", "7", "CC_00430000007", "0043 - 0000 - 007", "F43", "North", None),
            ("44", "1000", "7", None, None, None, "North", None),
        ],
        key=repr,
    )
    one.write.parquet(str(tmp_path / "o"))
    target = spark.read.parquet(str(tmp_path / "o"))
    # Nothing new: nothing changes.
    again = organization.build_org_dim(hier, company, target, today=dt.date(2024, 3, 1))
    assert as_rows(again, *one.columns) == as_rows(one)
    renamed = hier.withColumn("div_nm", F.when(F.col("div_nbr") == "0042", "Renamed").otherwise(F.col("div_nm")))
    two = organization.build_org_dim(renamed, company, target, today=dt.date(2024, 3, 1))
    assert as_rows(two.filter("division_cd = '42'"), "division_desc", "disc_dt", "is_current") == sorted(
        [("Div 0042", day("2024-02-29"), False), ("Renamed", day("9999-12-31"), True)], key=repr
    )
    # What the hierarchy lacks is kept from the dimension. The dimension holds
    # canonical codes, so only equal codes find each other.
    views = organization.current_org_views(two)
    assert views["div"].count() == 3 and views["local"].count() == 3 and "lob_category" in views["lob"].columns


def test_kept_values_of_the_dimension(org_feeds, spark, tmp_path):
    hier, company = org_feeds
    plain = hier.withColumns({"div_nbr": F.lit("42"), "sub_lob": F.lit("7"), "local_use": F.lit("1000")}).limit(1)
    one = organization.build_org_dim(plain, company, today=dt.date(2024, 2, 1))
    one.write.parquet(str(tmp_path / "o"))
    target = spark.read.parquet(str(tmp_path / "o"))
    rows = organization.organization_rows(plain.withColumn("area_nm", F.lit("  ")), company, target, dt.date(2024, 3, 1))
    assert rows.first()["area_desc"] == "Area"


def test_accumulator_bridge(spark, as_rows):
    acc = spark.createDataFrame([("w", "A", "x; y ;x", "2024"), ("v", "B", None, "2024")], "pay_accumulation_wid string, pay_accumulation_cd string, add_to string, sf_insert_timestamp string")
    codes = spark.createDataFrame([("x ", "Earning_Code"), ("x", "Earning_Code"), ("y", "Workday_Deduction_Code")], "calc_cd string, pay_cd_type string")
    groups = spark.createDataFrame([("y",)], "pay_component_group_name string")
    calcs = spark.createDataFrame([("z",)], "payroll_calc string")
    out = pay.build_accumulator_bridge(acc, codes, groups, calcs, "add_to")
    assert as_rows(out, "add_to_id", "earning_cd_ind", "deduction_cd_ind", "pay_component_group_ind", "pcrc_ind") == [
        ("w-x", 1, None, None, None), ("w-y", None, 1, 1, None),
    ]


def test_paycodes_and_group_bridge(spark, as_rows):
    e = spark.createDataFrame([("c", "t", "old", 1), ("c", "t", "new", 2)], "pay_cd string, pay_cd_type string, name string, sf_insert_timestamp int")
    d = spark.createDataFrame([("d", "t", "x", 5, 1)], "pay_cd string, pay_cd_type string, name string, priority int, sf_insert_timestamp int")
    assert as_rows(pay.build_paycodes(e, d), "pay_cd", "name", "priority") == [("c", "new", None), ("d", "x", 5)]
    earn = spark.createDataFrame([("g1", "e1"), ("g2", "e2"), ("g2", "e2")], "pay_component_group_id string, paycode_earning_id string")
    ded = spark.createDataFrame([("g2", "d2"), ("g3", "d3")], "pay_component_group_id string, paycode_deduction_id string")
    assert as_rows(pay.build_paycode_group_bridge(earn, ded)).__len__() == 3
    assert as_rows(pay.build_paycode_group_bridge(earn, ded), "pay_component_group_id", "pay_cd_earning_id", "pay_cd_deduction_id") == sorted(
        [("g1", "e1", None), ("g2", "e2", "d2"), (None, None, "d3")], key=repr
    )


def test_term_reasons(spark, as_rows):
    data = [("Termination", "a > Resignation > c", "x > y > Attendance", 0, 0), ("Termination", None, "x > y > Attendance", 0, 0),
            ("Hire", "a > b > c", "x > y > z", 0, 0), ("Termination", "a > Other", "x > y", 1, 0)]
    ev = spark.createDataFrame(data, "bp_type string, bp_reason_category_sens string, bp_reason_sens string, involuntary int, retirement int")
    out = as_rows(pay.build_term_reason_lookup(ev))
    assert ("Termination", "Resignation", "Attendance", 0, 0, 1) in out
    assert ("Termination", "Other", "", 1, 0, 0) in out
    assert ("-1", "-1", "-1", 0, 0, 0) in out and len(out) == 7
