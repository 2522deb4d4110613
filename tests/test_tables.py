import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimflow.operators import merge as M
from dimflow.sources.tables import TableChanged, VersionedTable


@pytest.fixture
def table(spark, tmp_path):
    out = VersionedTable(spark, str(tmp_path / "t"))
    out.overwrite(spark.range(0, 80).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).repartitionByRange(8, "k"))
    return out


def stamps(table):
    return {f: os.stat(f"{table.path}/{f}").st_mtime_ns for f in table.manifest()["files"]}


def source(spark, rows, schema="k long, v long"):
    return spark.createDataFrame(rows, schema)


def test_upsert_rewrites_touched_files_only(spark, table, as_rows):
    before, old = stamps(table), table.read()
    new = source(spark, [(3, -3), (5, -5), (700, 7)])
    want = as_rows(M.merge_upsert(old, new, ["k"]))
    assert len(before) == 8 and table.upsert(new, ["k"]) == 2
    after = stamps(table)
    kept = before.keys() & after.keys()
    assert len(kept) == 7 and all(before[f] == after[f] for f in kept)
    assert as_rows(table.read()) == want
    assert as_rows(table.read(1)) == [(k, 10 * k) for k in sorted(range(80), key=lambda k: repr((k, 10 * k)))]


@pytest.mark.parametrize("rows", [[], [(900, 1)], [(0, 1), (79, 1)]])
def test_delete_insert(spark, table, as_rows, rows):
    new = source(spark, [*rows, *rows])
    want = as_rows(M.delete_insert(table.read(), new, ["k"]))
    before = stamps(table)
    table.delete_insert(new, ["k"])
    assert as_rows(table.read()) == want
    assert len(before.keys() & stamps(table).keys()) == 8 - len({k // 10 for k, _ in rows if k < 80})


def test_scd2_equals_the_whole_merge(spark, tmp_path, as_rows, day):
    schema = "k int, dbt_hash string, rpt_eff_dt date, disc_dt date, is_current boolean"
    rows = [(k, "h0", day("2024-01-01"), day("2024-01-09"), False) for k in range(40)]
    rows += [(k, "h1", day("2024-01-10"), day("9999-12-31"), True) for k in range(40)]
    rows += [(5, "h2", day("2024-01-11"), day("9999-12-31"), True)]  # two open versions
    old = spark.createDataFrame(rows, schema)
    new = [(1, "h1"), (2, "h9"), (5, "h2"), (77, "h1")]
    new = spark.createDataFrame([(k, h, day("2024-02-01"), day("9999-12-31"), True) for k, h in new], schema)
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.overwrite(old.repartitionByRange(8, "k"))
    before = stamps(table)
    table.scd2(new, ["k"])
    assert as_rows(table.read()) == as_rows(M.scd2_merge(old, new, ["k"]))
    assert len(before.keys() & stamps(table).keys()) >= len(before) - 2


def test_new_columns_and_wider_types(spark, table, as_rows):
    table.append(source(spark, [(1000, 1, "x")], "k long, v int, note string"))
    assert as_rows(table.read().filter("k in (7, 1000)"), "k", "v", "note") == [(1000, 1, "x"), (7, 70, None)]
    files = set(table.manifest()["files"])
    table.upsert(source(spark, [(7, Decimal("0.5"))], "k long, v decimal(20,2)"), ["k"])
    assert table.read().schema["v"].dataType.simpleString() == "decimal(21,2)"
    assert not files & set(table.manifest()["files"])  # a column's type changes: all files are written again
    assert table.read().agg(F.sum("v")).first()[0] == sum(range(0, 800, 10)) - 70 + 1 + Decimal("0.5")


def test_second_writer_of_a_version_is_refused(spark, table):
    base = table.version()
    other = VersionedTable(spark, table.path)
    other.append(source(spark, [(1, 1)]))
    with pytest.raises(TableChanged):
        table._replace(base, table.read(base).schema, [], source(spark, [(2, 2)]))
    assert table.version() == base + 1 and table.read().filter("v = 1").count() == 1


def test_a_write_cut_off_leaves_the_table(spark, table, monkeypatch):
    monkeypatch.setattr(table, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("cut")))
    with pytest.raises(RuntimeError):
        table.append(source(spark, [(1, 1)]))
    assert VersionedTable(spark, table.path).read().count() == 80


def test_repeated_source_keys_empty_tables_and_vacuum(spark, table, tmp_path):
    with pytest.raises(M.DuplicateKeyError):
        table.upsert(source(spark, [(1, 1), (1, 2)]), ["k"])
    for n in range(3):
        table.upsert(source(spark, [(n, n)]), ["k"])
    assert table.vacuum(keep=2) > 0
    assert table.versions() == [3, 4] and table.read().count() == 80
    assert table.read(3).filter("k = 2").first()["v"] == 20
    empty = VersionedTable(spark, str(tmp_path / "e"))
    assert empty.version() == 0 and empty.read().count() == 0
    empty.upsert(source(spark, []), ["k"])
    assert empty.read().columns == ["k", "v"] and empty.read().count() == 0
