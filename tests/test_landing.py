import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from dimflow.plans import landing
from dimflow.sources import readers as R
from dimflow.sources import sinks as S
from dimflow.streaming.landing import ingest_landing_stream

TODAY = dt.date(2024, 1, 31)


@pytest.fixture()
def clock(tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("EMP,TIATIM,NOTE\n1,202401300800,nan\n2,202312010800,old\n3,202401010800,None\n")
    (src / "b.csv").write_text("EMP,TIATIM,NOTE\n4,202401311200,ok\n5,202312310000,<NA>\n")
    return src


def test_timeclock(spark, clock, tmp_path, as_rows):
    out, audit = str(tmp_path / "out"), str(tmp_path / "audit")
    report = landing.ingest_timeclock(spark, str(clock), out, audit, time_col="TIATIM", fmt="yyyyMMddHHmm", today=TODAY)
    back = spark.read.parquet(out)
    assert as_rows(back, "EMP", "NOTE", "month", "day") == [("1", None, 1, 30), ("3", None, 1, 1), ("4", "ok", 1, 31)]
    assert {f.dataType.simpleString() for f in back.schema.fields if f.name in ("EMP", "TIATIM", "NOTE")} == {"string"}
    assert (report["source_rows"], report["insert_rows"], report["rejected_rows"]) == (5, 3, 2)
    assert spark.read.parquet(audit).first()["status"] == "SUCCESS"
    assert all(r["raw_filename"].endswith(".csv") for r in back.collect())


def test_stream_equals_batch_and_takes_each_file_once(spark, clock, tmp_path, as_rows):
    batch = str(tmp_path / "batch")
    landing.ingest_timeclock(spark, str(clock), batch, str(tmp_path / "a1"), time_col="TIATIM", fmt="yyyyMMddHHmm", today=TODAY)

    def run():
        ingest_landing_stream(
            spark, str(clock), str(tmp_path / "stream"), str(tmp_path / "state"), schema="EMP string, TIATIM string, NOTE string",
            time_col="TIATIM", fmt="yyyyMMddHHmm", today=TODAY, audit=str(tmp_path / "a2"), max_files=1,
        ).awaitTermination()
        return spark.read.parquet(str(tmp_path / "stream"))

    shown = ("EMP", "TIATIM", "NOTE", "year", "month", "day")
    assert as_rows(run(), *shown) == as_rows(spark.read.parquet(batch), *shown)
    (clock / "c.csv").write_text("EMP,TIATIM,NOTE\n6,202401200000,x\n")
    assert sorted(r["EMP"] for r in run().collect()) == ["1", "3", "4", "6"]
    audit = S.read_audit(spark, str(tmp_path / "a2"))
    assert audit.agg(F.sum("source_rows"), F.sum("insert_rows")).first()[:] == (6, 4)


def test_repeated_batch_and_refusals_of_the_stream(spark, clock, tmp_path, monkeypatch):
    import shutil

    from dimflow.streaming import landing as streaming

    def run():
        ingest_landing_stream(
            spark, str(clock), str(tmp_path / "stream"), str(tmp_path / "state"), schema="EMP string, TIATIM string, NOTE string",
            time_col="TIATIM", fmt="yyyyMMddHHmm", today=TODAY, audit=str(tmp_path / "a"),
        ).awaitTermination()

    run()
    before = S.read_audit(spark, str(tmp_path / "a")).collect()
    shutil.rmtree(tmp_path / "state" / "commits")  # as if the stream had stopped before it noted the batch
    run()
    assert S.read_audit(spark, str(tmp_path / "a")).collect() == before
    assert [r["rejected_rows"] for r in before] == [2]
    (clock / "d.csv").write_text("EMP,TIATIM,NOTE\n7,202401200000,x\n")
    monkeypatch.setattr(streaming, "count_rows", lambda *a: 0)
    with pytest.raises(Exception):
        run()
    monkeypatch.undo()
    (clock / "b.txt").write_text("EMP\n1\n")
    with pytest.raises(R.InvalidFileFormat):
        run()


def test_landing_csv_checks(spark, tmp_path):
    (tmp_path / "e.csv").write_text("A,B\n")
    (tmp_path / "x.txt").write_text("A,B\n1,2\n")
    with pytest.raises(R.EmptyFile):
        R.read_landing_csv(spark, str(tmp_path / "e.csv"))
    with pytest.raises(R.InvalidFileFormat):
        R.read_landing_csv(spark, str(tmp_path / "x.txt"))
    with pytest.raises(R.EmptyFile):
        R.read_landing_csv(spark, str(tmp_path / "p_$folder$"))
    assert R.read_landing_csv(spark, str(tmp_path / "e.csv"), allow_empty=True).isEmpty()


def test_report_without_entries(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"Report_Entry": []}')
    assert R.read_report_json(spark, str(tmp_path / "r.json")).count() == 0
    (tmp_path / "q.json").write_text('{"Other": []}')
    with pytest.raises(ValueError):
        R.read_report_json(spark, str(tmp_path / "q.json"))


def test_chunks_are_bounded_and_whole(spark, tmp_path):
    df = spark.range(2000).select("id", F.repeat(F.lit("é"), (F.col("id") % 90).cast("int")).alias("t"), F.lit(None).cast("string").alias("n"))
    path = str(tmp_path / "c")
    listing = S.write_json_chunks(df, path, max_mb=0.02).collect()
    files = sorted((tmp_path / "c").glob("*.txt"))
    limit = int(0.02 * S.MEGABYTE)
    assert len(files) == len(listing) > 3
    docs = [json.loads(f.read_text(encoding="utf-8"))["Report_Entry"] for f in files]
    assert all(f.stat().st_size <= limit + 1 for f in files)
    assert sorted(r["id"] for d in docs for r in d) == list(range(2000))
    assert "n" in docs[0][0]
    back = R.read_report_json(spark, path)
    assert back.count() == 2000


def test_a_row_above_the_limit_is_kept(spark):
    df = spark.range(3).select("id", F.repeat(F.lit("x"), (F.col("id") * 500).cast("int")).alias("t")).coalesce(1)
    chunks = S.json_chunks(df, max_bytes=300).collect()
    assert sum(c["n_records"] for c in chunks) == 3


def test_land_report(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"Report_Entry": [{"k": i, "v": "x"} for i in range(50)]}))
    audit = str(tmp_path / "audit")
    got = landing.land_report(spark, str(tmp_path / "r.json"), str(tmp_path / "out"), audit, run_key="k1")
    assert got["source_rows"] == got["insert_rows"] == 50
    row = S.read_audit(spark, audit).first()
    assert (row["status"], row["run_key"]) == ("SUCCESS", "k1")
    (tmp_path / "z.json").write_text('{"Report_Entry": []}')
    empty = landing.land_report(spark, str(tmp_path / "z.json"), str(tmp_path / "out2"), audit, run_key="k2")
    assert empty["source_rows"] == 0 and not (tmp_path / "out2").exists()
    with pytest.raises(Exception):
        landing.land_report(spark, str(tmp_path / "missing.json"), str(tmp_path / "out3"), audit, run_key="k3")
    status = {r["run_key"]: r["status"] for r in S.read_audit(spark, audit).collect()}
    assert status == {"k1": "SUCCESS", "k2": "SUCCESS", "k3": "FAILED"}


def test_export_parquet(spark, tmp_path):
    meta = S.export_parquet(spark.range(7), str(tmp_path / "e"))
    assert meta["num_rows"] == 7 and meta["schema"] == "struct<id:bigint>"
    assert list((tmp_path / "e").glob("*.gz.parquet"))


def test_jdbc_options_without_a_database(spark, monkeypatch, tmp_path):
    """The calls made to Spark; no database is started for this test."""
    calls = {}

    class Reader:
        def jdbc(self, url, table, **kw):
            calls.update(url=url, table=table, **kw)
            return spark.range(4)

    class Session:
        read = Reader()

    R.read_jdbc(Session(), "jdbc:x", "t", "id", (0, 100), 8, properties={"fetchsize": "1000"})
    assert calls["numPartitions"] == 8 and calls["lowerBound"] == 0 and calls["column"] == "id"
    monkeypatch.setattr(landing, "read_jdbc", lambda *a, **k: spark.range(4))
    assert landing.export_table(spark, "jdbc:x", "t", str(tmp_path / "x"))["num_rows"] == 4


def test_partitioned_append(spark, tmp_path):
    df = spark.range(100).withColumn("p", F.col("id") % 3)
    path = str(tmp_path / "p")
    S.write_partitioned(df, path, ["p"])
    S.write_partitioned(df, path, ["p"])
    assert spark.read.parquet(path).count() == 200
    assert sorted(x.name for x in (tmp_path / "p").glob("p=*")) == ["p=0", "p=1", "p=2"]


def test_sorted_csv(spark, tmp_path):
    S.export_csv(spark.range(50).orderBy(F.rand(1)), str(tmp_path / "s"), ["id"])
    text = [ln for f in sorted((tmp_path / "s").glob("part-*")) for ln in f.read_text().split() if ln != "id"]
    assert text == [str(i) for i in range(50)]


def test_a_heavy_partition_value_is_split(spark, tmp_path):
    """Most rows under one value: it must not be one task's work alone."""
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "64KB")
    try:
        df = spark.range(0, 200_000, 1, 8).select(F.rand(3).alias("v"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("p"))
        S.write_partitioned(df, str(tmp_path / "h"), ["p"])
    finally:
        spark.conf.set(conf, before)
    assert len(list((tmp_path / "h" / "p=0").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "h")).count() == 200_000
