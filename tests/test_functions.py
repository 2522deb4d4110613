import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from dimflow import functions as X
from dimflow.functions.text import POSITION_IDS, REQUISITION_IDS


def one(spark, col, **values):
    row = spark.range(1).select([F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return row.select(col.alias("x")).first()["x"]


def test_surrogate_key_takes_null_as_empty(spark):
    key = X.surrogate_key("a", "b", "c")
    got = one(spark, key, a="x", b=None, c=7)
    assert got == hashlib.md5(b"x--7").hexdigest()
    assert got == one(spark, key, a="x", b="", c=7)


def test_surrogate_key_of_dates_uses_iso_text(spark):
    assert one(spark, X.surrogate_key("d"), d=dt.date(2024, 1, 2)) == hashlib.md5(b"2024-01-02").hexdigest()


def test_greatest_least_propagate_null(spark):
    assert one(spark, X.greatest_strict("a", "b"), a=1, b=2) == 2
    assert one(spark, X.greatest_strict("a", F.lit(None)), a=1) is None
    assert one(spark, X.least_strict("a", F.lit(None)), a=1) is None


@pytest.mark.parametrize(
    "text,want",
    [("P_1 Clerk", "P_1"), ("P_1", ""), ("  x", ""), (None, None)],
)
def test_first_token(spark, text, want):
    assert one(spark, X.first_token(F.lit(text).cast("string"))) == want


def test_after_colon_takes_ten_characters(spark):
    assert one(spark, X.after_colon("s"), s="Request: R-123456 (open)") == "R-123456"
    assert one(spark, X.after_colon("s"), s="abc:0123456789XYZ") == "0123456789"


def test_split_part_zero_is_one(spark):
    assert one(spark, X.split_part_safe("s", " -", 0), s="12 -Union") == "12"
    assert one(spark, X.split_part_safe("s", "-", 9), s="a-b") == ""


def test_strtok_skips_empty_tokens(spark):
    assert one(spark, X.strtok("s", "(", 2), s="((Site ((123456)") == "123456)"
    assert one(spark, X.strtok("s", "(", 2), s="Site") is None


def test_cost_center(spark):
    assert one(spark, X.cost_center_code("s"), s="2000 - 1234 - 300") == "CC_20001234300"
    fixed = X.correct_cost_center("s", "CC_none")
    assert one(spark, fixed, s="CC_20000999951") == "CC_20000000951"
    assert one(spark, fixed, s="CC_20001000951") == "CC_20001000951"
    # The comparison is on text: 'ARCH' sorts after '1000' and has a rule of its own.
    assert one(spark, fixed, s="CC_2000ARCH951") == "CC_20000000951"
    assert one(spark, X.correct_cost_center(F.lit(None).cast("string"), "CC_none")) == "CC_none"


def test_strip_code_prefix(spark):
    assert one(spark, X.strip_code_prefix("s"), s="1234 Name") == "Name"
    assert one(spark, X.strip_code_prefix("s"), s="Name 1234") == "Name 1234"


def test_tagged_value(spark):
    assert one(spark, X.tagged_value("s", "Acquired Company/"), s="A/1;Acquired Company/Z9;B/2") == "Z9"
    assert one(spark, X.tagged_value("s", "Acquired Company/"), s="A/1") is None


def test_longer_ids_are_not_cut(spark):
    ids = X.distinct_ids(["s"], REQUISITION_IDS)
    assert one(spark, ids, s="r-1234567 and R-123456, R_41295BR_01 R_41295BR_EVRGRN R-123456") == [
        "R-123456",
        "R-1234567",
        "R_41295BR_01",
        "R_41295BR_EVRGRN",
    ]
    assert one(spark, X.distinct_ids(["s"], POSITION_IDS), s="p_1234567890 P-12345678") == ["P-12345678", "P_1234567890"]
    assert one(spark, X.distinct_ids(["s"], POSITION_IDS), s="none") == []


def test_single_or_null(spark):
    for arr, want in (([], None), (["a"], "a"), (["a", "b"], None)):
        col = F.array(*[F.lit(a) for a in arr]).cast("array<string>")
        assert one(spark, X.single_or_null(col)) == want
    assert one(spark, X.single_or_null(F.lit(None).cast("array<string>"))) is None


@pytest.mark.parametrize(
    "text,want",
    [
        ("20240229", "2024-02-29"),
        ("99999999", "1700-01-01"),
        ("20230230", "1900-01-01"),
        ("2024", "1900-01-01"),
        (None, "1900-01-01"),
        ("19400101", "1900-01-01"),
        ("16991231", "1700-01-01"),
        ("50000101", "4000-12-30"),
    ],
)
def test_parse_yyyymmdd(spark, text, want):
    assert str(one(spark, X.parse_yyyymmdd(F.lit(text).cast("string")))) == want


def test_int_to_date_or_default(spark):
    assert str(one(spark, X.int_to_date_or_default("n"), n=20240131)) == "2024-01-31"
    assert str(one(spark, X.int_to_date_or_default("n"), n=20241331)) == "1900-01-01"


def test_parse_ts14(spark):
    assert one(spark, X.parse_ts14("s"), s="20240131235958") == dt.datetime(2024, 1, 31, 23, 59, 58)
    assert one(spark, X.parse_ts14("s"), s="x") is None


def test_defaulting_casts(spark):
    assert one(spark, X.to_bool_or_false("s"), s="true") is True
    assert one(spark, X.to_bool_or_false("s"), s="maybe") is False
    assert one(spark, X.to_int_or_null("s"), s="12x") is None
    assert int(one(spark, X.to_int_or_null("s"), s="0012")) == 12
    assert one(spark, X.canonical_code("s"), s="0042") == "42"


def test_decimal_out_of_range_is_an_error(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of range"):
        one(spark, X.to_decimal("s", 9, 6), s="12345.6")


def test_prefer(spark):
    assert one(spark, X.prefer("a", "b"), a="  ", b="kept") == "kept"
    assert one(spark, X.prefer("a", "b"), a=" new ", b="kept") == "new"


def test_stringify(spark):
    df = spark.createDataFrame([("nan", 1), ("<NA>", None), ("None", 3), ("ok", 4)], "a string, b int")
    out = X.stringify(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "string"]
    assert [tuple(r) for r in out.collect()] == [(None, "1"), (None, None), (None, "3"), ("ok", "4")]


def test_date_parts(spark):
    df = spark.createDataFrame([("202401311205",)], "t string")
    row = X.add_date_parts(df, "t", "yyyyMMddHHmm", ("year", "month", "day", "hour", "minute", "second")).first()
    assert tuple(row)[1:] == (2024, 1, 31, 12, 5, 0)
    with pytest.raises(ValueError):
        X.add_date_parts(df, "absent")


def test_registered_functions_round_trip(spark):
    X.register_functions(spark)
    row = spark.sql(
        """SELECT datetoint(DATE '2024-03-01') a, inttodate(20240301) b,
           timestamptoint(TIMESTAMP '2022-01-02 03:04:05.123') c, inttotimestamp(20220102030405123) d"""
    ).first()
    assert row.a == 20240301 and row.b == dt.date(2024, 3, 1) and row.c == 20220102030405123
    assert row.d == dt.datetime(2022, 1, 2, 3, 4, 5, 123000)
