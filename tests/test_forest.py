from __future__ import annotations

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from skytune.operators import forest
from skytune.plans import training

NAMES = ["x", "z", "u", "same", "turned", "signed"]


def made(spark, rows):
    """Values that repeat, a copy turned around and negative numbers; every sum of labels is exact."""

    def number(k):
        return F.pmod(F.xxhash64(F.col("id") + k), F.lit(100))

    df = spark.range(rows).select(
        "id",
        (number(0) / 10).alias("x"),
        (number(5) / 10).alias("z"),
        (number(9) % 7).alias("u"),
        F.lit(3).alias("same"),
        (number(3) * number(4) / 7 - 300).alias("signed"),
    )
    y = F.floor(F.col("x") * 2 + F.col("z") * F.col("u") + F.col("signed") / 9) / 4
    return df.withColumns({"turned": F.lit(9.9) - F.col("x"), "y": y})


def learner(trees, depth):
    return RandomForestRegressor(
        featuresCol="features", labelCol="y", numTrees=trees, maxDepth=depth, seed=42,
        featureSubsetStrategy="all",
    )


def nodes(spark, model, folder):
    model.write().overwrite().save(str(folder))
    saved = spark.read.parquet(f"{folder}/data").collect()
    return sorted((r.treeID, *r.nodeData) for r in saved)


@pytest.fixture
def large(monkeypatch):
    """Every input counts as large, and no more than one row goes to Spark's own fit."""
    monkeypatch.setattr(forest, "FEW_ROWS", 0)
    fit = RandomForestRegressor.fit

    def small(self, df, params=None):
        assert df.count() == 1
        return fit(self, df, params)

    def own(self, df):
        return fit(self, df)

    monkeypatch.setattr(RandomForestRegressor, "fit", small)
    return own


@pytest.mark.parametrize(
    ("rows", "names", "trees", "depth"),
    [
        (3000, NAMES, 9, 6),
        (12000, NAMES, 7, 4),  # thresholds come from a sample
        (40, NAMES, 3, 8),
        (300, ["same"], 3, 3),
        (300, ["x"], 3, 0),
    ],
)
def test_large_forest_is_sparks_own(spark, tmp_path, large, rows, names, trees, depth):
    df = made(spark, rows).repartition(8, "id").sortWithinPartitions("id")
    ours = forest.fit_forest(df, names, learner(trees, depth), rows)
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    theirs = large(learner(trees, depth), assembled)
    assert nodes(spark, ours, tmp_path / "a") == nodes(spark, theirs, tmp_path / "b")
    assert ours.featureImportances == theirs.featureImportances


def test_training_on_many_rows(spark, large, monkeypatch):
    df = made(spark, 1500).withColumn("at", F.timestamp_seconds(F.col("id") * 1800))

    def shown():
        trained = training.train_mood(df, "y", "at", ["id"], "drop", trees=6, depth=4)
        return sorted(trained.predictions().collect()), trained.importances().collect()

    many = shown()
    monkeypatch.setattr(forest, "FEW_ROWS", 10**6)
    monkeypatch.setattr(RandomForestRegressor, "fit", large)
    assert many == shown()


def test_rows_without_numbers_are_refused(spark, large):
    df = made(spark, 50)
    lacking = df.withColumn("x", F.when(F.col("id") > 0, F.col("x")))
    with pytest.raises(Exception, match="lacks a value"):
        forest.fit_forest(lacking, ["x"], learner(2, 2), 50)
    odd = df.withColumn("x", F.when(F.col("id") > 0, F.col("x")).otherwise(float("inf")))
    with pytest.raises(Exception, match="no number"):
        forest.fit_forest(odd, ["x"], learner(2, 2), 50)
    with pytest.raises(ValueError, match="no row"):
        forest.fit_forest(df.where("false"), ["x"], learner(2, 2), 0)


def test_training_reads_numbers_time_and_key(data_of_one_row):
    kept = training.training_columns(data_of_one_row, "at", ["key"])
    assert kept.columns == ["key", "at", "x"]


@pytest.fixture
def data_of_one_row(rows):
    return rows("key string, name string, at string, x double, flag boolean", ("k", "n", "t", 1.0, True))
