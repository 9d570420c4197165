"""Position and congestion models with MLlib, and their use with rule fallbacks."""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import config as C
from wakeline.functions import labels
from wakeline.models import evaluation, scaling
from wakeline.operators import timesplit
from wakeline.plans.alerts import heading_or_course, predict_positions
from wakeline.session import checkpoint_root, materialise, scratch_dir


def assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(scaling.filled(df, features))


def hash_split(df: DataFrame, identity: Sequence[str], share: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds ``part``; the hash is independent of the class, so every class is split in the same proportion."""
    bucket = F.pmod(F.xxhash64(*identity, F.lit(seed)), F.lit(10_000))
    return df.withColumn("part", F.when(bucket < int(share * 10_000), "train").otherwise("test"))


# --- position ----------------------------------------------------------------------------------


def train_position(
    silver: DataFrame, minutes: int, rounds: int = 300, depth: int = 6, rate: float = 0.05, min_rows: int = 1000,
    seed: int = 42,
) -> tuple[dict[str, GBTRegressionModel], DataFrame]:
    """Boosted trees for the latitude and longitude change, and their errors on the later fifth of time.

    The training rows are written once and read back: every round runs a task for each partition, whose number then follows
    the bytes of these rows, and not the shuffles that made them.

    Fewer than ``min_rows`` rows are an error: whether to go on with dead reckoning is the caller's choice. MLlib
    truncates the lineage of the rounds in the checkpoint folder. Rounds follow one another and each is some small jobs, one a level
    of its tree, so the two axes, which do not depend on each other, are trained at once.
    """
    spark = silver.sparkSession
    spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    rows = silver.withColumns({"hour": F.hour("base_datetime"), "month": F.month("base_datetime")})
    rows = materialise(timesplit.future_position(rows, minutes).select(
        "mmsi", "base_datetime", *C.POSITION_FEATURES, "delta_lat", "delta_lon"
    ), "position-rows")
    if (n := rows.limit(min_rows).count()) < min_rows:
        raise ValueError(f"{n} rows to train on, {min_rows} are needed")
    parts = assembled(timesplit.split_by_time(rows, "base_datetime"), C.POSITION_FEATURES)
    axes = ("lat", "lon")

    def fitted(axis: str) -> GBTRegressionModel:
        booster = GBTRegressor(
            labelCol=f"delta_{axis}", featuresCol="features", predictionCol=f"pred_{axis}", maxIter=rounds,
            maxDepth=depth, stepSize=rate, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed,
        )
        return booster.fit(parts.filter("part = 'train'"))

    with ThreadPoolExecutor(len(axes)) as pool:
        # each thread with a copy of its own of the session's local properties
        running = {axis: pool.submit(inheritable_thread_target(spark)(fitted), axis) for axis in axes}
    models = {axis: found.result() for axis, found in running.items()}
    tested = parts.filter("part = 'test'")
    for model in models.values():
        tested = model.transform(tested)
    report = evaluation.position_errors(tested)
    return models, spark.createDataFrame(report.collect(), report.schema)


def _model_inputs(rows: DataFrame, minutes: int, as_of: Column, *more: Column) -> DataFrame:
    """The features as in live use: the time gap is the horizon and the changes are 0; training saw the gap between pings."""
    return rows.select("lat", "lon", *[
        F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("sog", "cog", "heading")
    ], *more).withColumns({
        "sog_change": F.lit(0.0), "heading_change": F.lit(0.0), "time_delta_sec": F.lit(float(minutes * 60)),
        "hour": F.hour(as_of), "month": F.month(as_of),
    })


def _with_axes(inputs: DataFrame, models: dict[str, GBTRegressionModel]) -> DataFrame:
    scored = assembled(inputs, C.POSITION_FEATURES)
    for model in models.values():
        scored = model.transform(scored)
    return scored


def predict_with_models(
    rows: DataFrame, models: dict[str, GBTRegressionModel] | None, minutes: int, as_of: Column,
) -> DataFrame:
    """Position ``minutes`` ahead by the models of that horizon, else by dead reckoning."""
    if not models:
        return predict_positions(rows, minutes)
    return _with_axes(_model_inputs(rows, minutes, as_of, F.col("mmsi")), models).select(
        "mmsi", "lat", "lon",
        F.round(F.col("lat") + F.col("pred_lat"), 6).alias("predicted_lat"),
        F.round(F.col("lon") + F.col("pred_lon"), 6).alias("predicted_lon"),
        F.lit("gbt").alias("method"), F.lit(minutes).alias("minutes_ahead"), F.lit(0.82).alias("confidence"),
    )


def with_predictions(
    rows: DataFrame, models: dict[str, GBTRegressionModel] | None, minutes: int, as_of: Column, min_sog: float | None = None,
) -> DataFrame:
    """``rows`` with predicted position, method, horizon and confidence; vessels below ``min_sog`` get none.

    A row without heading takes its course, as dead reckoning does.
    """
    if not models:
        return predict_positions(rows, minutes, min_sog)
    whole = rows.withColumns({"__row": F.struct(*rows.columns), "__at": as_of}).withColumn("heading", heading_or_course())
    scored = _with_axes(_model_inputs(whole, minutes, F.col("__at"), F.col("__row"), F.col("__at")), models)
    moving = F.lit(True) if min_sog is None else F.col("__row.sog") >= min_sog
    return scored.select("__row", *[
        F.when(moving, value).alias(name) for name, value in (
            ("predicted_lat", F.round(F.col("lat") + F.col("pred_lat"), 6)),
            ("predicted_lon", F.round(F.col("lon") + F.col("pred_lon"), 6)), ("method", F.lit("gbt")),
        )
    ], F.lit(minutes).alias("minutes_ahead"), F.when(moving, 0.82).alias("confidence")).select("__row.*", *[
        "predicted_lat", "predicted_lon", "method", "minutes_ahead", "confidence",
    ])


# --- congestion --------------------------------------------------------------------------------


ROWS_OF_A_TASK = 100_000


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` in equal parts: two for each core, or more, so that none has over ``ROWS_OF_A_TASK`` of the ``n`` rows.

    Each part is sorted, as the samples that MLlib draws follow the order of a part's rows.
    """
    parts = max(2 * rows.sparkSession.sparkContext.defaultParallelism, math.ceil(n / ROWS_OF_A_TASK))
    return rows.repartition(parts).sortWithinPartitions(*rows.columns)


def train_congestion(
    train: DataFrame, features: Sequence[str] = C.CONGESTION_FEATURES, label: str = "congestion_level",
    trees: int = 200, depth: int = 10, min_leaf: int = 5, seed: int = 42,
) -> PipelineModel:
    """Random forest with balanced class weights n / (k * n_class). The class counts are a few rows.

    MLlib keeps a row with its number of draws for every tree, some 5 bytes a tree, and each level of the trees is a pass over
    all rows. How the rows are stored must then not decide on the size of the tasks: few bytes are many rows here.
    """
    counts = train.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("k"))
    weights = counts.select(
        label, (totals.select("n").scalar() / (totals.select("k").scalar() * F.col("n"))).alias("weight")
    )
    rows = scaling.filled(train.join(F.broadcast(weights), label), features).select(*features, label, "weight")
    indexer = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, seed=seed,
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    dealt = _dealt(indexer.transform(rows).drop(label), counts.agg(F.sum("n")).first()[0] or 0)
    fitted = Pipeline(stages=[assembler, forest]).fit(dealt)
    names = IndexToString(inputCol="prediction", outputCol="predicted_level", labels=indexer.labels)
    return PipelineModel([*fitted.stages, names])


def predict_congestion(
    cells: DataFrame, model: PipelineModel | None, features: Sequence[str] = C.CONGESTION_FEATURES,
) -> DataFrame:
    """Adds ``predicted_level``: by the model, else by the count thresholds."""
    if model is None:
        return cells.withColumn("predicted_level", labels.congestion_level("vessel_count"))
    scored = model.transform(scaling.filled(cells, features))
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def importance(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """Importance of every feature of a fitted tree model, highest first."""
    trees = model.stages[1] if isinstance(model, PipelineModel) else model
    values = [float(v) for v in trees.featureImportances.toArray()]
    total = sum(values) or 1.0
    rows = [(f, v / total) for f, v in zip(features, values, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def boosted_importance(model: GBTRegressionModel, features: Sequence[str], kind: str = "gain") -> DataFrame:
    """Importance of the features a boosted model splits on, shares that sum to 1, highest first.

    ``gain`` is the mean reduction of squared error a split on the feature brings, ``weight`` the number of such splits,
    ``cover`` the mean number of rows they split. Taken from the stored node rows of the trees.
    """
    measures = {"gain": F.avg(F.col("gain") * F.col("rawCount")), "weight": F.count("*").cast("double"), "cover": F.avg("rawCount")}
    spark = SparkSession.active()
    folder = scratch_dir(spark, "boosted-nodes")
    model.write().overwrite().save(folder)
    nodes = spark.read.parquet(f"{folder}/data").select("nodeData.*").filter("leftChild >= 0")
    names = F.array(*[F.lit(f) for f in features])
    per_feature = nodes.groupBy(F.element_at(names, F.col("split.featureIndex") + 1).alias("feature")).agg(
        measures[kind].alias("measure"))
    total = per_feature.agg(F.sum("measure")).scalar()
    return per_feature.select("feature", (F.col("measure") / total).alias("importance")).orderBy(F.desc("importance"), "feature")


def weather_challenger(
    density: DataFrame, weather_of, trees: int = 200, depth: int = 10,
) -> DataFrame:
    """Does weather help? Two forests on the same chronological split, compared by accuracy and macro F1.

    ``density`` are cell-hours with the next hour's level; ``weather_of(df)`` adds ``weather_severity``.
    """
    parts = timesplit.split_by_time(weather_of(density), "hour_bucket").withColumn(
        "weather_severity", F.coalesce("weather_severity", F.lit(0.0))
    ).persist()
    try:
        reports = []
        for name, features in (
            ("baseline", C.CONGESTION_FEATURES), ("augmented", (*C.CONGESTION_FEATURES, "weather_severity")),
        ):
            model = train_congestion(parts.filter("part = 'train'"), features, "future_congestion", trees, depth)
            tested = predict_congestion(parts.filter("part = 'test'"), model, features)
            report = evaluation.class_report(tested, "future_congestion", "predicted_level")
            reports.append(evaluation.overall(report).first().asDict() | {"model": name})
    finally:
        parts.unpersist()
    base, augmented = reports
    f1_delta = augmented["macro_f1"] - base["macro_f1"]
    verdict = "no effect" if abs(f1_delta) < 0.005 else "promote" if f1_delta > 0 else "reject"
    return density.sparkSession.createDataFrame(
        [(base["accuracy"], augmented["accuracy"], augmented["accuracy"] - base["accuracy"],
          base["macro_f1"], augmented["macro_f1"], f1_delta, verdict)],
        "base_accuracy double, augmented_accuracy double, accuracy_delta double, base_macro_f1 double, "
        "augmented_macro_f1 double, macro_f1_delta double, verdict string",
    )
