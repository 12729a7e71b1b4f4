from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from skytune.plans import training


@pytest.fixture(scope="module")
def data(spark):
    return spark.range(1200).select(
        "id",
        F.timestamp_seconds(F.col("id") * 1800).alias("at"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) / 10).alias("x"),
        (F.pmod(F.xxhash64(F.col("id") + 5), F.lit(100)) / 10).alias("noise"),
        F.lit(True).alias("flag"),
        F.lit("t").alias("text"),
    ).withColumn("y", F.col("x") * 2 + F.when(F.hour("at") >= 12, 3).otherwise(0))


def test_features_are_numeric_without_target(data):
    timed = training.with_hour(data, "at")
    assert training.feature_names(timed, "y") == ["id", "x", "noise", "hour"]
    assert training.feature_names(timed, "y", exclude=["id"]) == ["x", "noise", "hour"]
    frame = training.feature_frame(data, "y", "at", ["id"])
    assert frame.columns == ["x", "noise", "hour", "y"]


@pytest.mark.parametrize("target", ["flag", "text", "missing"])
def test_target_must_be_numeric(data, target):
    with pytest.raises(ValueError, match=target):
        training.feature_names(data, target)


def test_forest_learns_and_survives_saving(spark, data, tmp_path):
    trained = training.train_mood(data, "y", "at", ["id"], "drop", exclude=["id"], trees=20, depth=7)
    scores = training.regression_metrics(trained.predictions()).first()
    assert scores.n == trained.test.count() and scores.r2 > 0.95
    ranked = [r.feature for r in trained.importances().collect()]
    assert ranked[0] == "x" and set(ranked) == {"x", "noise", "hour"}
    trained.save(str(tmp_path / "model"))
    trained.save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model")).transform(trained.test)
    before = trained.model.transform(trained.test)
    assert again.select("id", "prediction").exceptAll(before.select("id", "prediction")).isEmpty()


def test_columns_that_no_tree_can_split_by_are_left_out(data, monkeypatch):
    wide = data.withColumns(
        {
            "again": F.col("x"),
            "same": F.lit(7),
            "turned": F.lit(9.9) - F.col("x"),
            "clock": F.hour("at"),
        }
    )
    names = ["x", "noise", "again", "same", "turned", "clock", "hour"]
    timed = training.with_hour(wide, "at")
    assert training.splitting_columns(timed, names) == ["x", "noise", "turned", "clock"]
    # nothing to split by, no row, no value at all
    assert training.splitting_columns(timed, ["same"]) == ["same"]
    assert training.splitting_columns(timed.where("false"), names) == names
    void = timed.withColumn("void", F.lit(None).cast("double"))
    assert training.splitting_columns(void, ["same", "void"]) == ["void"]

    def fit():
        return training.train_mood(wide, "y", "at", ["id"], "drop", trees=20, depth=5)

    def shown(trained):
        scored = trained.model.transform(trained.test).select("id", "prediction")
        return sorted(scored.collect()), dict(trained.importances().collect())

    few = fit()
    assert few.used == ["x", "noise", "turned", "clock"]
    monkeypatch.setattr(training, "splitting_columns", lambda df, columns: list(columns))
    monkeypatch.setattr(training, "SUMS_MB", 1024)
    every = fit()
    assert every.used == every.features == few.features
    (scores, weights), (all_scores, all_weights) = shown(few), shown(every)
    assert scores == all_scores and weights == pytest.approx(all_weights, rel=1e-9)


def test_metrics_and_bins(rows):
    df = rows("actual double, prediction double", (1.0, 2.0), (3.0, 3.0), (-0.5, 0.5))
    got = training.regression_metrics(df).first()
    mean = 3.5 / 3
    spread = sum((a - mean) ** 2 for a in (1.0, 3.0, -0.5))
    assert got.n == 3 and got.mse == pytest.approx(2 / 3)
    assert got.r2 == pytest.approx(1 - 2 / spread)
    bins = {r.actual_bin: (r.n, r.mean_error) for r in training.residual_bins(df).collect()}
    assert bins == {1.0: (1, 1.0), 3.0: (1, 0.0), -1.0: (1, 1.0)}
    constant = rows("actual double, prediction double", (1.0, 2.0), (1.0, 1.0))
    assert training.regression_metrics(constant).first().r2 is None
