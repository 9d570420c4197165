"""Compaction and retention by folders."""

from datetime import datetime

import pytest

from wakeline.sinks import maintenance

COLUMNS = "k BIGINT, name STRING"


def _batch(spark, path, query, batch, rows=20):
    spark.range(batch * 1000, batch * 1000 + rows, numPartitions=4).selectExpr("id AS k", f"'{query}' AS name").write.mode("overwrite").parquet(
        f"{path}/query_id={query}/batch_id={batch}")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _files(folder):
    return [f for f in folder.rglob("*.parquet") if f.is_file()]


def test_same_rows_and_bounded_files(spark, tmp_path):
    path = tmp_path / "out"
    out = maintenance.BatchFolders(spark, str(path), COLUMNS)
    assert out.read().count() == 0
    out.compact()
    for batch in range(6):
        for query in ("a", "b"):
            _batch(spark, path, query, batch)
        before = _rows(out.read())
        assert len(before) == 40 * (batch + 1)
        out.compact()
        assert _rows(out.read()) == before
        # for each query the newest batch and the one just compacted, the last two turns, their manifests
        assert len(_files(path)) <= 2 * 2 * 4 + 2 + 2


def test_closed_turns_are_not_written_again(spark, tmp_path):
    path = tmp_path / "out"
    out = maintenance.BatchFolders(spark, str(path), COLUMNS, file_bytes=400)
    seen = {}
    for batch in range(5):
        _batch(spark, path, "a", batch, rows=200)
        out.compact()
        now = {f: f.stat().st_mtime_ns for f in _files(path / "_compacted")} if (path / "_compacted").exists() else {}
        assert all(now.get(f) == at for f, at in seen.items())
        seen = now
    assert out.read().count() == 1000 and len(out._live().turns) == 4


def test_a_batch_that_runs_again_or_a_failed_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    path = tmp_path / "out"
    out = maintenance.BatchFolders(spark, str(path), COLUMNS)
    for batch in range(3):
        _batch(spark, path, "a", batch)
    want = _rows(out.read())
    monkeypatch.setattr(maintenance.Store, "size", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        out.compact()
    monkeypatch.undo()
    assert _rows(out.read()) == want
    out.compact()
    _batch(spark, path, "a", 2)  # the newest once more
    assert _rows(out.read()) == want
    out.compact()
    out.compact()
    assert _rows(out.read()) == want


def test_retention_reads_no_dropped_day(spark, tables_with_days):
    path, rows = tables_with_days
    broken = next((path / "year=2024" / "month=1").glob("day=3/*.parquet"))
    broken.write_bytes(b"not parquet at all")  # reading it would fail
    untouched = {f: f.stat().st_mtime_ns for f in path.rglob("day=7/*.parquet")}
    maintenance.drop_before(spark, str(path), datetime(2024, 1, 5, 12))
    left = spark.read.parquet(str(path))
    want = rows.filter("base_datetime >= TIMESTAMP_NTZ '2024-01-05 12:00:00'")
    assert _rows(left.select("id", "base_datetime")) == _rows(want.select("id", "base_datetime"))
    assert not (path / "year=2024" / "month=1" / "day=4").exists()
    assert {f: f.stat().st_mtime_ns for f in path.rglob("day=7/*.parquet")} == untouched


@pytest.fixture
def tables_with_days(spark, tmp_path):
    rows = spark.range(240).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, id) AS base_datetime")
    rows = rows.selectExpr("*", "year(base_datetime) AS year", "month(base_datetime) AS month", "day(base_datetime) AS day")
    rows.write.partitionBy("year", "month", "day").parquet(str(tmp_path / "t"))
    return tmp_path / "t", rows
