"""Sources, sinks, merges and quality rules on small hand-made rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wakeline.operators import merge
from wakeline.plans import queries
from wakeline.quality import checks
from wakeline.session import scratch_dir
from wakeline.sinks import tables as sinks
from wakeline.sources import files
from wakeline.streaming import bronze, storms
from wakeline.streaming.state import BucketTable, SlotTable


def test_canonical_header_wins_over_alias(spark):
    df = spark.createDataFrame([("1", "2", "3")], " MMSI  string, LAT string, lat_x string".replace(" MMSI  ", "MMSI "))
    assert files.resolve_headers(df).columns == ["mmsi", "lat", "lat_x"]


def test_header_versions():
    assert files.header_version(["MMSI", "LAT"]) == "v1"
    assert files.header_version(["mmsi", "TransceiverClass".lower(), "transceiver_class"]) == "v2"
    assert files.header_version(["mmsi", "Heading", "transceiver"]) == "v3"


def test_blank_fields_stay_unknown_unless_asked(spark):
    raw = spark.createDataFrame(
        [("1.0", "2024-01-01 00:00:00", "10", "20", None, "nan")], "mmsi string, base_datetime string, lat string, lon string, sog string, vessel_name string"
    )
    kept = files.ingest(raw).first()
    assert kept["sog"] is None and kept["vessel_name"] is None
    filled = files.ingest(raw, blank_as_null=False).first()
    assert filled["sog"] == 0.0 and filled["vessel_name"] == "nan"


def test_capped_sample_is_repeatable_and_capped(spark, tables):
    rows = tables.silver.withColumn("source_file", F.expr("concat('f', day % 3)"))
    first = files.capped_sample(rows, 90, split=None)
    again = files.capped_sample(rows.repartition(7), 90, split=None)
    assert {r[0] for r in first.select("event_id").collect()} == {r[0] for r in again.select("event_id").collect()}
    assert all(r["count"] == 30 for r in first.groupBy("source_file").count().collect())


def test_capped_sample_splits_the_bound_exactly(tables):
    rows = tables.silver.withColumn("source_file", F.expr("concat('f', event_id % 30)"))
    assert files.capped_sample(rows, 20, split=None).count() == 20  # more files than rows
    assert files.capped_sample(rows, 100, split=None).count() == 100  # not a multiple of the files
    assert files.capped_sample(rows, 10**9, split=None).count() == rows.count()


def test_track_fact_has_all_rows_unless_asked(tables):
    everything = sinks.track_fact(tables.silver).count()
    assert everything == tables.silver.filter("data_split = 'train'").count()
    some = sinks.track_fact(tables.silver, target_rows=everything // 2).count()
    assert everything // 2 <= some < everything


def test_storms_of_a_stream_are_raised_once(spark, tmp_path):
    """Runs of busy minutes over midnight and over batches; the last row moves the watermark on."""
    runs = {datetime(2024, 1, 1, 23, 58): 5, datetime(2024, 1, 2, 0, 10): 3, datetime(2024, 1, 2, 0, 20): 2, datetime(2024, 1, 2, 0, 23): 3}
    at = sorted(first + timedelta(minutes=k) for first, n in runs.items() for k in range(n))
    rows = [(t,) for t in at for _ in range(3)] + [(datetime(2024, 1, 2, 0, 30),), (None,)]
    df = spark.createDataFrame(rows, "created_at timestamp_ntz")
    batch = checks.alert_bursts(df, per_minute=2, minutes=3)
    starts = {r["minute"] for r in batch.collect() if r["storm"]}
    starts = sorted(m for m in starts if m - timedelta(minutes=1) not in starts)
    assert storms.storm_alerts(df, 2, 3).orderBy("first_minute").collect() == [(m, m + timedelta(minutes=3), 9) for m in starts]
    rows.append((datetime(2024, 1, 2, 3, 0),))
    for name, cut in (("one", len(rows)), ("many", 5)):
        for k in range(0, len(rows), cut):  # files of one batch each, in the order of time
            spark.createDataFrame(rows[k : k + cut], "created_at timestamp_ntz").coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
        raised = storms.storm_alerts(stream, 2, 3)
        path = str(tmp_path / f"{name}-raised")
        bronze.append_direct(raised, path, str(tmp_path / f"{name}-cp")).awaitTermination()
        found = spark.read.schema(raised.schema).parquet(path).orderBy("first_minute").collect()
        assert found == [(m, m + timedelta(minutes=3), 9) for m in starts]


def test_storm_across_midnight(spark):
    at = [datetime(2024, 1, 1, 23, 59), datetime(2024, 1, 2, 0, 0), datetime(2024, 1, 2, 0, 1)]
    df = spark.createDataFrame([(t,) for t in at for _ in range(3)], "created_at timestamp_ntz")
    assert [r["storm"] for r in checks.alert_bursts(df, per_minute=2, minutes=3).collect()] == [True] * 3
    assert [r["storm"] for r in checks.alert_bursts(df, per_minute=2, minutes=4).collect()] == [False] * 3


def test_load_reads_the_newest_period_again(spark):
    from wakeline.plans import warehouse

    columns = "k string, at timestamp_ntz, n int"
    hour, now = datetime(2024, 1, 1, 5), F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    stored, control = spark.createDataFrame([], columns), spark.createDataFrame([], warehouse.CONTROL_COLUMNS)
    counted = []
    for rows in ([("a", hour, 5)], [("a", hour, 9), ("b", hour, 1)], [("a", hour, 9), ("b", hour, 1)]):
        source = spark.createDataFrame(rows, columns)
        stored, control = warehouse.incremental_load(stored, control, source, "t", ("k", "at"), "at", now)
        stored, control = (spark.createDataFrame(df.collect(), df.schema) for df in (stored, control))
        counted.append(control.first()["rows_loaded"])
    assert sorted((r["k"], r["n"]) for r in stored.collect()) == [("a", 9), ("b", 1)]
    assert counted == [1, 3, 3]


OLD = "k string, name string, n int"


def test_upsert_policies(spark):
    stored = spark.createDataFrame([("a", "old", 1), ("b", "old", 2)], OLD)
    new = spark.createDataFrame([("b", "new", 5), ("c", "new", 7)], OLD)
    got = merge.upsert(stored, new, ("k",), keep=("name",), on_match={"n": F.expr("old.n + fresh.n")})
    assert sorted(tuple(r) for r in got.collect()) == [("a", "old", 1), ("b", "old", 7), ("c", "new", 7)]
    assert sorted(tuple(r) for r in merge.upsert(got, new, ("k",)).collect())[1] == ("b", "new", 5)


def test_slot_table_repeats_a_batch_without_harm(spark):
    table = SlotTable(spark, scratch_dir(spark, "slots"), OLD)
    new = spark.createDataFrame([("a", "x", 1)], OLD)

    def add(old):
        return merge.upsert(old, new, ("k",), on_match={"n": F.expr("old.n + fresh.n")})

    for batch in (0, 1, 1, 2, 2):
        table.replace("query", batch, add)
    assert [tuple(r) for r in table.read().collect()] == [("a", "x", 3)]
    table.replace("started anew", 0, add)  # a new checkpoint counts from 0 again and loses nothing
    assert [tuple(r) for r in table.read().collect()] == [("a", "x", 4)]


def _add(new):
    return lambda old: merge.upsert(old, new, ("k",), on_match={"n": F.expr("old.n + fresh.n")})


def _written(spark, path, turn):
    """Rows and files of a turn."""
    return spark.read.parquet(f"{path}/turn={turn}").count(), len(list((path / f"turn={turn}").rglob("*.parquet")))


def test_bucket_table_repeats_a_batch_without_harm(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), OLD, "k")
    assert table.read().count() == 0 and table.read_like(spark.createDataFrame([("a",)], "k string")).count() == 0
    new = spark.createDataFrame([("a", "x", 1)], OLD)
    for batch in (0, 1, 1, 2, 2):
        table.merge("query", batch, new, _add(new))
    assert [tuple(r) for r in table.read().collect()] == [("a", "x", 3)]
    assert [tuple(r) for r in table.read("query", 2).collect()] == [("a", "x", 2)]
    table.merge("started anew", 0, new, _add(new))
    assert [tuple(r) for r in table.read().collect()] == [("a", "x", 4)]
    table.merge("started anew", 1, new.limit(0), _add(new.limit(0)))
    assert table.read().count() == 1


def test_bucket_table_splits_and_forgets(spark, tmp_path, monkeypatch):
    """Buckets stay small, all rows are found, and replaced folders are deleted one turn later."""
    monkeypatch.setattr(BucketTable, "BUCKET_ROWS", 20)
    table = BucketTable(spark, str(tmp_path / "t"), OLD, "k")
    want = {}
    for batch in range(6):
        keys = [f"v{k}" for k in range(batch * 40, batch * 80 + 90)]
        new = spark.createDataFrame([(k, "x", 1) for k in keys], OLD)
        table.merge("q", batch, new, _add(new))
        want = {**want, **{k: want.get(k, 0) + 1 for k in keys}}
        assert {r["k"]: r["n"] for r in table.read().collect()} == want
    turn, manifest = table._manifest()
    live = manifest.filter("NOT gone").collect()
    assert max(r["n"] for r in live) <= 20 and sum(r["n"] for r in live) == len(want)
    some = spark.createDataFrame([("v7",), ("v100",)], "k string")
    found = {r["k"] for r in table.read_like(some).collect()}
    assert {"v7", "v100"} <= found and len(found) <= 40
    folders = {tuple(p.relative_to(tmp_path / "t").parts) for p in (tmp_path / "t").glob("turn=*/depth=*/prefix=*")}
    kept = {(f"turn={r['at']}", f"depth={r['depth']}", f"prefix={r['prefix']}") for r in manifest.collect() if r["n"]}
    assert folders == kept
    assert sorted(p.name for p in (tmp_path / "t" / "manifest").glob("turn=*")) == [f"turn={turn - 1}", f"turn={turn}"]


def test_a_batch_writes_by_its_keys_not_by_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(BucketTable, "BUCKET_ROWS", 100)
    wrote = []
    for fleet in (2_000, 20_000):
        table = BucketTable(spark, str(tmp_path / str(fleet)), OLD, "k")
        rows = spark.range(fleet).selectExpr("CAST(id AS STRING) AS k", "'x' AS name", "1 AS n")
        table.merge("q", 0, rows, _add(rows))
        new = spark.createDataFrame([(str(k), "y", 5) for k in range(10)], OLD)
        table.merge("q", 1, new, _add(new))
        wrote.append(_written(spark, tmp_path / str(fleet), 1))
        assert table.read().count() == fleet and table.read().filter("n = 6").count() == 10
    # ten keys: ten buckets at most, each of at most a hundred rows; a tenfold fleet does not make it twice as much
    assert all(rows <= 1000 and files <= 10 for rows, files in wrote) and wrote[1][0] < 2 * wrote[0][0]


def test_near_misses_whatever_the_batches(spark, tmp_path):
    """A backlog of two hours in one batch or in many gives the same near misses as all pairs compared."""
    import random
    from datetime import datetime, timedelta

    from wakeline.streaming import bronze, scoring

    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    reports = []
    for k in range(150):
        at = start + timedelta(seconds=rng.randrange(7200))
        reports.append((at, f"36600000{rng.randrange(6)}", 30 + rng.randrange(4) * 0.0006, -90 + rng.randrange(3) * 0.0006))
    reports = sorted({(r[0], r[1]): r for r in reports}.values())
    want = set()
    for i, (at, a, lat, lon) in enumerate(reports):
        for other, b, lat2, lon2 in reports[:i]:
            apart = ((lat - lat2) * 60) ** 2 + ((lon - lon2) * 60 * 0.866) ** 2
            if a != b and (at - other).total_seconds() <= 300 and 0 < apart < 0.01:
                want.add((min(a, b), max(a, b), at))
    found = []
    for n in (1, 5):
        (tmp_path / f"in{n}").mkdir()
        for k in range(n):
            part = reports[k * len(reports) // n : (k + 1) * len(reports) // n]
            (tmp_path / f"in{n}" / f"{k}.txt").write_text("".join(
                f'{{"mmsi": "{m}", "base_datetime": "{at:%Y-%m-%d %H:%M:%S}", "lat": {lat}, "lon": {lon}, "sog": 5.0, "heading": 10.0}}\n'
                for at, m, lat, lon in part))
            stream = spark.readStream.text(str(tmp_path / f"in{n}"))
            scoring.start_scoring(
                scoring.live_reports(stream), str(tmp_path / f"out{n}"), str(tmp_path / f"cp{n}"), bronze.UNTIL_DONE, late_seconds=0
            ).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / f"out{n}" / "alerts")).filter("alert_type = 'COLLISION_RISK'").collect()
        found.append(sorted((r["mmsi_1"], r["mmsi_2"], r["created_at"]) for r in rows))
    assert found[0] == found[1] == sorted(want) and want


def test_another_stage_changes_the_scorer(spark, tmp_path):
    """A forest that calls everything an outlier is recorded between two batches of one running scorer."""
    import numpy as np

    from wakeline import config as C
    from wakeline.models import isolation_forest, live, runs
    from wakeline.streaming import scoring

    rows = spark.createDataFrame([(f"36600{k:04d}", k, 30.0 + k / 100, -90.0, 5.0 + k % 7, 1.0 * k) for k in range(60)],
                                 "mmsi string, event_id long, lat double, lon double, sog double, heading double")
    rows = rows.selectExpr("*", "heading AS cog", "'' AS vessel_name", "'70' AS vessel_type", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS base_datetime")
    motion = rows.selectExpr("*", "0D AS sog_change", "0D AS heading_change", "0D AS distance_nm")
    forest = isolation_forest.fit(motion, C.FOREST_FEATURES, trees=20)
    table, handle = str(tmp_path / "runs"), None
    handle = live.ModelHandle(spark, table)
    scorer = scoring.LiveScorer(spark, str(tmp_path / "out"), models=handle)
    kinds = []
    for batch, cut in ((0, None), (1, -2.0), (2, 1.0)):
        if cut is not None:
            forest.cut = cut
            forest.save(spark, str(tmp_path / f"forest{batch}"))
            at = F.lit(f"2024-01-0{batch} 00:00:00").cast("timestamp_ntz")
            runs.record(spark, table, live.FOREST, f"run{batch}", "Production", str(tmp_path / f"forest{batch}"), {}, {}, at)
        scorer(rows, batch)
        out = spark.read.parquet(f"{tmp_path}/out/scored").filter(f"batch_id = {batch}")
        kinds.append(out.filter("anomaly_type = 'ML_ANOMALY'").count())
    assert kinds[0] == kinds[1] == 0 and kinds[2] > 50
    assert np.isfinite(forest.low) and handle.current().sources == {live.FOREST: "registry:Production"}


def test_a_batch_is_parsed_once(spark, tables, tmp_path):
    """The scorer looks for stored vessels and scores: each message of the batch is read a single time, and nothing stays cached."""
    from wakeline.streaming import scoring

    read = spark.sparkContext.accumulator(0)

    def counted(mmsi):
        read.add(1)
        return mmsi

    given = tables.silver.limit(60).drop("data_split", "sog_change", "heading_change", "time_delta_sec", "distance_nm").coalesce(1).persist()
    batch = given.withColumn("mmsi", F.udf(counted, "string")("mmsi"))
    scorer = scoring.LiveScorer(spark, str(tmp_path / "out"))
    scorer(batch, 0)
    given.unpersist()
    assert read.value == 60 and not batch.is_cached
    assert spark.read.parquet(f"{tmp_path}/out/scored").count() == 60


def test_polls_find_their_alerts_once(spark, monkeypatch):
    """The second poll copies the stored alerts of the first: pairs, which may be very many, are not searched again."""
    from pyspark.sql.readwriter import DataFrameWriter

    from checks import cases_streaming  # noqa: F401
    from checks.registry import QUERIES

    plans, write = [], DataFrameWriter.parquet

    def kept(self, path, *args, **more):
        if "/polls-" in path:
            plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, path, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", kept)
    QUERIES["st_08_new_critical"](spark, "/root/testdata/sf0.001")
    assert len(plans) == 2 and "Join" in plans[0] and "Join" not in plans[1]


def test_a_new_checkpoint_replaces_no_batch(spark, tmp_path):
    from wakeline.streaming import bronze

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\ntwo\n")
    for name in ("first", "second", "second"):
        stream = spark.readStream.text(str(tmp_path / "in"))
        bronze.append_batches(stream, str(tmp_path / "out"), str(tmp_path / name), bronze.UNTIL_DONE).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.count() == 4 and stored.select("query_id").distinct().count() == 2


def test_live_path_from_plain_messages(spark, tmp_path):
    """Messages without ids, a vessel of the batch near one stored earlier, ids and defaults of the alerts."""
    from wakeline.streaming import bronze, scoring

    def message(mmsi, at, lat, lon):
        return f'{{"mmsi": "{mmsi}", "base_datetime": "{at}", "lat": {lat}, "lon": {lon}, "sog": 35.0, "heading": 10.0}}\n'

    (tmp_path / "in").mkdir()
    texts = [message("366000001", "2024-01-01 00:00:00", 30.0, -90.0), message("366000002", "2024-01-01 00:00:30", 30.0005, -90.0),
             message("366000003", "2024-01-01 02:00:00", 30.0, -90.0005)]
    for k, text in enumerate(texts):
        (tmp_path / "in" / f"{k}.txt").write_text(text)
        stream = spark.readStream.text(str(tmp_path / "in"))
        rows = scoring.live_reports(stream)
        scoring.start_scoring(rows, str(tmp_path / "out"), str(tmp_path / "cp"), bronze.UNTIL_DONE).awaitTermination()
    alerts = spark.read.parquet(str(tmp_path / "out" / "alerts")).collect()
    assert all(r["id"] is not None and r["is_resolved"] is False for r in alerts)
    assert len({r["id"] for r in alerts}) == len(alerts) == 4  # three speeds; the third vessel came two hours later
    near = [r for r in alerts if r["alert_type"] == "COLLISION_RISK"]
    assert [(r["mmsi_1"], r["mmsi_2"]) for r in near] == [("366000001", "366000002")]


def test_ids_of_large_reports_do_not_overflow(spark):
    from wakeline.functions import cleaning

    df = spark.createDataFrame([("a", 10**18), ("a", 10**18 + 1), ("b", 10**18), (None, None)], "k string, n long")
    ids = [r["i"] for r in df.select(cleaning.content_id("k", "n").alias("i")).collect()]
    assert len(set(ids)) == 4 and all(0 <= i < 2**60 for i in ids)


def test_each_file_of_a_folder_has_its_own_header(spark, tmp_path):
    """Another order, other spellings, other columns, an empty file, one with a header alone, odd names, many lines."""
    lines = "".join(f"{k},2024-01-01 00:00:00,{30 + k / 1e4},-91.3\n" for k in range(1, 3000))
    (tmp_path / "a.csv").write_text("MMSI,BaseDateTime,LAT,LON\n" + lines)
    (tmp_path / "b.csv").write_text("MMSI,LON,LAT,BaseDateTime\n7,-91.3,30.5,2024-01-02 00:00:00\n")
    (tmp_path / "c d[1].csv").write_text("\nlongitude,latitude,Time, mmsi ,sog\n-91.3,30.5,2024-01-03 00:00:00,8,4.5\n")
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "f.csv").write_text("MMSI,BaseDateTime,LAT,LON\n")
    rows = files.read_days(spark, [str(tmp_path)])
    assert rows.filter("CAST(lat AS DOUBLE) BETWEEN 30 AND 31 AND lon = '-91.3'").count() == 3001 == rows.count()
    got = {r["mmsi"]: (r["base_datetime"], r["sog"]) for r in rows.filter("source_file <> 'a.csv'").collect()}
    assert got == {"7": ("2024-01-02 00:00:00", None), "8": ("2024-01-03 00:00:00", "4.5")}
    assert len(files.file_headers(spark, [str(tmp_path)])) == 3


def test_unknown_header_names_its_file(spark, tmp_path):
    (tmp_path / "good.csv").write_text("MMSI,BaseDateTime,LAT,LON\n1,2024-01-01 00:00:00,30.5,-91.3\n")
    (tmp_path / "odd.csv").write_text("MMSI,When,LAT,LON\n1,2024-01-01 00:00:00,30.5,-91.3\n")
    with pytest.raises(ValueError, match="odd.csv.*base_datetime"):
        files.read_days(spark, [str(tmp_path)])
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "empty.csv").write_text("")
    assert files.read_days(spark, [str(tmp_path / "none")]).count() == 0


def test_ingest_makes_an_id(spark):
    raw = spark.createDataFrame([("1", "2024-01-01 00:00:00", "10", "20", "5"), ("1", "2024-01-01 00:00:00", "10", "20", "6")],
                                "mmsi string, base_datetime string, lat string, lon string, sog string")
    assert files.ingest(raw).select("event_id").distinct().count() == 2


def test_request_bounds():
    assert queries.check_range("top_n", 50, 1, 500) == 50
    with pytest.raises(ValueError):
        queries.check_range("top_n", 0, 1, 500)


def test_empty_table_has_the_columns_the_job_writes(spark, tables):
    path = scratch_dir(spark, "empty")
    sinks.create_empty(spark, path, sinks.TABLE_COLUMNS["silver"])
    empty = spark.read.parquet(path)
    assert empty.count() == 0
    assert set(empty.columns) == set(tables.silver.columns) - {"event_id"}


def test_jdbc_needs_an_address(monkeypatch):
    monkeypatch.delenv("WAREHOUSE_JDBC_URL", raising=False)
    with pytest.raises(RuntimeError):
        sinks.jdbc_options()


@pytest.mark.parametrize("mmsi,verdict", [
    ("366123456", "valid"), ("970123456", "valid"), ("200123456", "invalid_mid_prefix"), ("800123456", "invalid_mid_prefix"),
    ("12345", "wrong_length_5"), ("36612345x", "non-numeric"), (None, "non-numeric"),
])
def test_mmsi_verdict(spark, mmsi, verdict):
    df = spark.createDataFrame([(mmsi,)], "mmsi string")
    assert df.select(checks.mmsi_verdict().alias("v")).first()["v"] == verdict


def test_alert_storm_needs_consecutive_minutes(spark):
    at = [datetime(2024, 1, 1, 0, m) for m in (0, 1, 2, 9)]
    df = spark.createDataFrame([(t,) for t in at for _ in range(3)], "created_at timestamp_ntz")
    got = {r["minute"].minute: r["storm"] for r in checks.alert_bursts(df, per_minute=2, minutes=3).collect()}
    assert got == {0: True, 1: True, 2: True, 9: False}


def test_stored_rows_are_pruned(spark, tables):
    plan = queries.track(tables.silver, "360000001", limit=5000)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(mmsi), EqualTo(mmsi,360000001)]" in plan
    assert "TakeOrdered" in plan


def test_a_load_shuffles_no_row_before_its_period(spark, tmp_path):
    """With broadcasts off: stored rows older than the watermark reach the result from their scan, with a pushed filter."""
    from wakeline.plans import warehouse

    rows = spark.range(1000).selectExpr(
        "CAST(id % 7 AS STRING) AS cell", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, id) AS hour", "id AS n")
    rows.write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    control = spark.createDataFrame([], warehouse.CONTROL_COLUMNS)
    now = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    empty, control = warehouse.incremental_load(stored.limit(0), control, stored, "t", ("cell", "hour"), "hour", now)
    assert empty.count() == 1000
    control = spark.createDataFrame(control.collect(), warehouse.CONTROL_COLUMNS)
    source = stored.withColumn("n", F.when(F.col("hour") >= control.first()["last_loaded"], F.col("n") + 1).otherwise(-1))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loaded, after = warehouse.incremental_load(stored, control, source, "t", ("cell", "hour"), "hour", now)
        plan = loaded._jdf.queryExecution().executedPlan().toString()
        first = plan[plan.index("Union") :].split("FileScan")  # the union's first branch is what stays as it is
        assert "Exchange" not in first[0] and "LessThan(hour" in first[1].splitlines()[0] and "Exchange" in plan
        assert after.first()["rows_loaded"] == 1001
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    got = {(r["cell"], r["hour"]): r["n"] for r in loaded.collect()}
    assert len(got) == 1000 and sorted(got.values())[-1] == 1000 and min(got.values()) == 0


def test_a_load_replaces_older_rows_of_its_keys(spark):
    from wakeline.plans import warehouse

    day = "TIMESTAMP_NTZ '2024-01-0{} 00:00:00'"
    stored = spark.sql(f"SELECT 'a' AS mmsi, {day.format(1)} AS at, 1 AS n UNION ALL SELECT 'b', {day.format(3)}, 2 UNION ALL SELECT 'c', NULL, 3")
    control = spark.sql(f"SELECT 't' AS table_name, {day.format(3)} AS last_loaded, 2L AS rows_loaded, {day.format(3)} AS updated_at")
    source = spark.sql(f"SELECT 'a' AS mmsi, {day.format(4)} AS at, 5 AS n UNION ALL SELECT 'b', {day.format(3)}, 2")
    loaded, after = warehouse.incremental_load(stored, control, source, "t", ("mmsi",), "at", F.lit("2024-01-05").cast("timestamp_ntz"))
    assert sorted((r["mmsi"], r["n"]) for r in loaded.collect()) == [("a", 5), ("b", 2), ("c", 3)]
    assert after.first()["rows_loaded"] == 3


def test_near_misses_are_left_out_where_alerts_are_filtered(tables):
    """A consumer of other alerts does not search for near misses, and the table holds both kinds."""
    plan = queries.recent_anomalies(tables.alerts, tables.as_of, 48)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Union" not in plan
    whole = tables.alerts._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in whole and "Join" in whole


def test_a_stream_of_stored_files_keeps_its_batches(spark, tables, tmp_path):
    """Rows are sent as their tasks hold them, in as many files as there are, and arrive in so many batches."""
    from checks.cases_streaming import _in_batches

    path, out = str(tmp_path / "sent"), str(tmp_path / "got")
    rows = spark.range(0, 100, numPartitions=6)
    rows.write.parquet(path)
    query = bronze.append_direct(_in_batches(tables, rows, path, 2), out, str(tmp_path / "cp"))
    query.awaitTermination()
    assert query.lastProgress["batchId"] == 1
    assert spark.read.schema(rows.schema).parquet(out).count() == 100
