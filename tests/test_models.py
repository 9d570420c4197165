"""Models on small data, late rows in state, and the exchanges of the silver job."""

from datetime import datetime

import numpy as np
import pandas as pd
import pytest

from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from checks import cases_models
from wakeline.models import evaluation, isolation_forest, scaling, supervised
from wakeline.plans import alerts, silver
from wakeline.streaming.motion import MotionLinker


@pytest.fixture(scope="module")
def cluster(spark):
    rng = np.random.default_rng(5)
    points = pd.DataFrame(rng.normal(0, 1, (600, 2)), columns=["x", "y"])
    points.loc[len(points)] = [40.0, -40.0]
    points["mmsi"] = [f"{i:04d}" for i in range(len(points))]
    points["base_datetime"] = "t"
    points["flat"] = 1.0
    return spark.createDataFrame(points)


def test_forest_finds_the_outlier_and_survives_storage(spark, cluster, tmp_path):
    fitted = isolation_forest.fit(cluster, ("x", "y", "flat"), trees=50, contamination=0.002)
    scored = isolation_forest.score(cluster, fitted)
    assert scored.orderBy("raw_score").first()["mmsi"] == "0600"
    assert "0600" in {r["mmsi"] for r in scored.filter("outlier").collect()}
    fitted.save(spark, str(tmp_path / "forest"))
    again = isolation_forest.Forest.load(spark, str(tmp_path / "forest"))
    assert isolation_forest.score(cluster, again).exceptAll(scored).count() == 0
    importance = {r["feature"]: r["importance"] for r in isolation_forest.importance(spark, fitted).collect()}
    assert "flat" not in importance and sum(importance.values()) == pytest.approx(1)


def test_forest_importance_is_the_variance_explained(spark, cluster):
    features, seed = ("x", "y"), 7
    fitted = isolation_forest.fit(cluster, features, trees=6, max_samples=40, seed=seed)
    data = scaling.filled(cluster, features).select("mmsi", "base_datetime", *features)
    samples = isolation_forest._tree_samples(data, 6, 40, seed, ("mmsi", "base_datetime")).toPandas()
    shares = []
    for tree, rows in samples.groupby("tree"):
        nodes = fitted.nodes[fitted.nodes["tree"] == tree].set_index("node")
        rows = rows.sort_values("__rn")
        x, y = rows[list(features)].to_numpy(float), isolation_forest.targets(seed, tree, len(rows))
        gain = np.zeros(2)

        def walk(node, members):
            n = nodes.loc[node]
            if n["feature"] < 0:
                return
            f, left = int(n["feature"]), x[members, int(n["feature"])] <= n["threshold"]
            parts = members[left], members[~left]
            gain[f] += len(members) * y[members].var() - sum(len(p) * y[p].var() for p in parts)
            walk(n["left"], parts[0])
            walk(n["right"], parts[1])

        walk(0, np.arange(len(rows)))
        shares.append(gain / gain.sum())
    found = {r["feature"]: r["importance"] for r in isolation_forest.importance(spark, fitted).collect()}
    assert [found["x"], found["y"]] == pytest.approx(list(np.mean(shares, axis=0)))


def test_boosted_importance_is_the_mean_gain_of_a_split(spark):
    df = spark.range(300).selectExpr("double(id % 10) AS a", "double(id % 7) AS b", "0D AS c", "double(id % 10) * 2 + double(id % 7) AS y")
    rows = supervised.assembled(df, ("a", "b", "c"))
    model = GBTRegressor(labelCol="y", maxIter=3, maxDepth=2, seed=1).fit(rows)
    pdf, gains = df.toPandas(), {0: [], 1: []}
    residual, predicted = pdf["y"].to_numpy(), np.zeros(300)
    x = pdf[["a", "b", "c"]].to_numpy()

    def walk(node, members):
        if node.numDescendants() == 0:
            return np.full(len(members), node.prediction())
        split, out = node.split(), np.zeros(len(members))
        left = x[members, split.featureIndex()] <= split.threshold()
        y = residual[members]
        gains[split.featureIndex()].append(len(y) * y.var() - left.sum() * y[left].var() - (~left).sum() * y[~left].var())
        out[left], out[~left] = walk(node.leftChild(), members[left]), walk(node.rightChild(), members[~left])
        return out

    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        predicted = predicted + weight * walk(tree._java_obj.rootNode(), np.arange(300))
        residual = 2 * (pdf["y"].to_numpy() - predicted)
    mean = {name: np.mean(gains[k]) for k, name in enumerate("ab") if gains[k]}
    found = {r["feature"]: r["importance"] for r in supervised.boosted_importance(model, ("a", "b", "c")).collect()}
    assert found == pytest.approx({f: g / sum(mean.values()) for f, g in mean.items()}, rel=1e-6)
    splits = {r["feature"]: r["importance"] for r in supervised.boosted_importance(model, ("a", "b", "c"), "weight").collect()}
    assert splits == pytest.approx({name: len(gains[k]) / sum(map(len, gains.values())) for k, name in enumerate("ab") if gains[k]})


def test_fitting_twice_gives_the_same_forest(cluster):
    a = isolation_forest.fit(cluster, ("x", "y"), trees=8)
    b = isolation_forest.fit(cluster.repartition(5), ("x", "y"), trees=8)
    order = ["tree", "node"]
    pd.testing.assert_frame_equal(
        a.nodes.sort_values(order).reset_index(drop=True), b.nodes.sort_values(order).reset_index(drop=True)
    )


def test_every_tree_has_its_full_sample(cluster):
    fitted = isolation_forest.fit(cluster, ("x", "y"), trees=20)
    assert set(fitted.nodes.loc[fitted.nodes["node"] == 0, "size"]) == {256}


def test_close_values_do_not_break_a_split():
    grow = isolation_forest._grow(("x",), 8, 1)
    sample = pd.DataFrame({"tree": 0, "__rn": range(4), "x": [1.0, np.nextafter(1.0, 2), 1.0, np.nextafter(1.0, 2)]})
    assert grow(sample)["size"].iloc[0] == 4


def test_scaling_ignores_infinite(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("inf"),), (None,)], "x double")
    assert scaling.fit(df, ["x"])["x"] == (1.0, pytest.approx(np.std([1, 3, 0, 0])))


def test_rules_override_in_order(spark):
    df = spark.createDataFrame([(35.0, -6.0, 90.0, False), (0.1, -6.0, 0.0, True), (31.0, 0.0, None, False), (5.0, None, 10.0, False)],
                               "sog double, sog_change double, heading_change double, in_us_port_zone boolean")
    got = [(r["anomaly_type"], r["anomaly_score"]) for r in alerts.rule_anomalies(df).collect()]
    assert got == [("SHARP_TURN", 0.5), ("STATIONARY_RISK", 0.9), ("UNUSUAL_SPEED", 31 / 60), ("", 0.0)]


def test_class_report_counts_missing_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "t string, p string")
    report = {r["class"]: (r["precision"], r["recall"]) for r in evaluation.class_report(df, "t", "p").collect()}
    assert report == {"a": (0.5, 0.5), "b": (0.5, 1.0), "c": (0.0, 0.0)}


def test_congestion_model_learns_a_threshold(spark):
    df = spark.range(400).selectExpr("id % 20 AS vessel_count", "1.0 AS avg_sog", "0 AS stopped_count", "if(id % 20 >= 15, 'HIGH', 'LOW') AS congestion_level")
    features = ("vessel_count", "avg_sog", "stopped_count")
    model = supervised.train_congestion(df, features, trees=10, depth=4)
    scored = supervised.predict_congestion(df, model, features)
    assert scored.filter("predicted_level <> congestion_level").count() == 0
    assert supervised.importance(spark, model, features).first()["feature"] == "vessel_count"


def test_too_few_rows_give_no_model(tables):
    with pytest.raises(ValueError, match="are needed"):
        supervised.train_position(tables.silver.limit(50), 5)


def _pings(spark, rows):
    return spark.createDataFrame(
        [(e, "a", datetime(2024, 1, 1, h), 1.0, 1.0, float(h), 0.0) for e, h in rows],
        "event_id long, mmsi string, event_time timestamp_ntz, lat double, lon double, sog double, heading double")


def test_late_report_leaves_the_state_alone(spark, tmp_path):
    linker = MotionLinker(spark, str(tmp_path))
    found = {}
    for batch, rows in enumerate([[(1, 5), (2, 6)], [(3, 4), (4, 8)], [(5, 7)]]):
        linker(_pings(spark, rows), batch)
        out = spark.read.parquet(f"{tmp_path}/motion").filter(f"batch_id = {batch}")
        found |= {r["event_id"]: (r["sog_change"], r["time_delta_sec"]) for r in out.collect()}
    assert found == {1: (None, None), 2: (1.0, 3600), 3: (None, None), 4: (2.0, 7200), 5: (None, None)}
    assert [r["base_datetime"].hour for r in linker.last.read().collect()] == [8]


def test_one_vessel_with_two_million_reports(spark, tmp_path):
    """In one batch, after an earlier ping: no row is gathered in Python, and every report has its predecessor."""
    linker = MotionLinker(spark, str(tmp_path))
    n = 2_000_000
    rows = spark.range(n, numPartitions=8).selectExpr(
        "id AS event_id", "'a' AS mmsi", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS event_time", "1D AS lat", "1D AS lon",
        "CAST(id AS DOUBLE) AS sog", "0D AS heading")
    first = _pings(spark, [(-1, 0)]).selectExpr("event_id", "mmsi", "event_time - INTERVAL 1 SECOND AS event_time", "lat", "lon", "-1D AS sog", "heading")
    linker(first, 0)
    linker(rows, 1)
    got = spark.read.parquet(f"{tmp_path}/motion").filter("batch_id = 1")
    assert got.filter("sog_change = 1 AND time_delta_sec = 1").count() == n == got.count()
    assert linker.last.read().first()["event_id"] == n - 1


def test_no_exchange_of_reports_by_vessel_alone(spark, tables):
    """With broadcasts off, wide rows are partitioned by (vessel, time) and (vessel, day), never by vessel only."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = silver.silver(tables.bronze)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "WindowGroupLimit" in plan
    lines = plan.splitlines()
    alone = [i for i, line in enumerate(lines) if "hashpartitioning(mmsi" in line and line.count("#", line.index("hashpartitioning"), line.index(")")) == 1]
    assert alone, "the day summary is windowed per vessel"
    for i in alone:
        assert "SortAggregate" in lines[i + 1] or "HashAggregate" in lines[i + 1], lines[i + 1]


def test_density_merges_on_the_map_side(tables):
    from wakeline.operators import density

    plan = density.traffic_density(tables.silver)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_scores_equal_a_walk_through_the_nodes(cluster):
    fitted = isolation_forest.fit(cluster, ("x", "y"), trees=6)
    scored = isolation_forest.with_raw_score(cluster, fitted).toPandas()

    def walk(row):
        total = 0.0
        for _, nodes in fitted.nodes.groupby("tree"):
            table = nodes.set_index("node")
            node = table.loc[0]
            while node["feature"] >= 0:
                value = (row["x"], row["y"])[int(node["feature"])]
                node = table.loc[int(node["left"] if value <= node["threshold"] else node["right"])]
            total += node["depth"] + float(isolation_forest.average_path(node["size"]))
        return -(2 ** (-(total / 6) / float(isolation_forest.average_path(256))))

    for i in (0, 17, 300, 600):
        assert scored.loc[i, "raw_score"] == pytest.approx(walk(scored.loc[i]))


def test_position_rounds_start_from_stored_rows(tables, monkeypatch):
    """Each round runs the plan of its training rows: a scan, without the windows that made them."""
    plans, fit = [], GBTRegressor.fit

    def kept(self, rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return fit(self, rows)

    monkeypatch.setattr(GBTRegressor, "fit", kept)
    supervised.train_position(tables.silver, 5, rounds=1, depth=2, min_rows=1)
    assert len(plans) == 2
    assert not any("InMemoryRelation" in p or "lead(" in p for p in plans)


def test_registered_position_model_has_all_rounds(tables, monkeypatch):
    """The registered run takes the rounds, depth and rate of the library: none of the work is left out."""
    seen = []

    class Enough(Exception):
        pass

    def kept(self, rows):
        seen.append((self.getMaxIter(), self.getMaxDepth(), self.getStepSize()))
        raise Enough

    monkeypatch.setattr(GBTRegressor, "fit", kept)
    monkeypatch.setattr(cases_models, "_POSITION", {})
    with pytest.raises(Enough):
        cases_models.position_model(tables)
    assert seen == [(300, 6, 0.05)] * 2


def test_congestion_forest_is_trained_on_equal_parts(spark, monkeypatch):
    """The rows of one stored file are many tasks; no part has much more than its share."""
    seen = []

    class Watched(supervised.Pipeline):
        def _fit(self, dataset):
            seen.append([r["n"] for r in dataset.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()])
            return super()._fit(dataset)

    monkeypatch.setattr(supervised, "Pipeline", Watched)
    monkeypatch.setattr(supervised, "ROWS_OF_A_TASK", 50)
    rows = spark.range(2000, numPartitions=1).selectExpr(
        "id % 20 AS vessel_count", "id * 0.1D AS avg_sog", "if(id % 20 >= 15, 'HIGH', 'LOW') AS congestion_level")
    features = ("vessel_count", "avg_sog")
    model = supervised.train_congestion(rows, features, trees=3, depth=3)
    assert len(seen[0]) == 40 and sum(seen[0]) == 2000 and max(seen[0]) <= 60
    assert supervised.predict_congestion(rows, model, features).filter("congestion_level <> predicted_level").count() == 0
