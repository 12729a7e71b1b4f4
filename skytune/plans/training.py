"""Regression on mood: feature choice, forest training, evaluation, saved models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from skytune.operators.forest import fit_forest
from skytune.operators.splitting import split

TREES = 200
SEED = 42
#: Sums of the nodes that grow in one pass over the rows. A row adds to a place of every feature in
#: every tree, so sums far beyond a processor's cache make each addition a read from memory.
SUMS_MB = 6


def with_combined_target(mart: DataFrame, name: str = "combined_mood") -> DataFrame:
    """A default target, ours: the mean of song and weather mood. Callers with a target of
    their own skip this step."""
    return mart.withColumn(name, (F.col("song_mood") + F.col("weather_mood")) / 2)


def training_columns(df: DataFrame, stamp: str, row_key: Sequence[str]) -> DataFrame:
    """What training reads of a frame: its numbers, the time and the row key."""
    wanted = {*numeric_columns(df), stamp, *row_key}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c in wanted))


def with_hour(df: DataFrame, stamp: str) -> DataFrame:
    parsed = df.withColumn(stamp, F.to_timestamp(F.col(f"`{stamp}`")))
    return parsed.withColumn("hour", F.hour(F.col(f"`{stamp}`")))


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of numeric type; booleans are not numbers here."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def feature_names(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> list[str]:
    """Every numeric column but the target. ``exclude`` keeps out the component scores a
    target is computed from."""
    numeric = numeric_columns(df)
    if target not in numeric:
        raise ValueError(f"target {target!r} is not among the numeric columns {numeric}")
    return [c for c in numeric if c != target and c not in exclude]


def feature_frame(
    df: DataFrame, target: str, stamp: str, exclude: Sequence[str] = ()
) -> DataFrame:
    """``hour`` added, then numeric features and target only."""
    timed = with_hour(df, stamp)
    return timed.select(*feature_names(timed, target, exclude), target)


@dataclass
class Trained:
    model: PipelineModel
    features: list[str]
    target: str
    test: DataFrame
    lacking: int = 0
    used: list[str] = field(default_factory=list)

    def predictions(self) -> DataFrame:
        """Actual against predicted, on the held-out rows."""
        scored = self.model.transform(self.test)
        return scored.select(F.col(self.target).cast("double").alias("actual"), "prediction")

    def importances(self) -> DataFrame:
        """One row per feature, most important first (as many rows as columns)."""
        weights = self.model.stages[-1].featureImportances.toArray().tolist()
        known = dict(zip(self.used or self.features, weights, strict=True))
        rows = [(n, known.get(n, 0.0)) for n in self.features]
        frame = self.test.sparkSession.createDataFrame(rows, "feature string, importance double")
        return frame.orderBy(F.desc("importance"), "feature")

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)


def completed(df: DataFrame, columns: Sequence[str], missing: str) -> tuple[DataFrame, int]:
    """Rows fit for training, and how many rows miss a value in ``columns`` (NULL or NaN).

    ``missing`` is ``raise``, ``drop`` (leave those rows out) or ``impute`` (take the mean).
    """
    if missing not in ("raise", "drop", "impute"):
        raise ValueError(f"missing must be raise, drop or impute, not {missing!r}")
    absent = reduce(or_, (F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in columns))
    lacking = df.where(absent).count()
    if missing == "raise" and lacking:
        raise ValueError(f"{lacking} rows lack one of {list(columns)}")
    if missing == "impute" and lacking:
        means = df.agg(
            *(F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in columns)
        ).first()
        return df.withColumns(
            {
                c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(means[c]))
                for c in columns
            }
        ), lacking
    return (df.where(~absent) if lacking else df), lacking


def splitting_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that a tree can split by: not constant, no copy of an earlier one in every row.

    Of equal gains a tree takes the first column, so the others never occur in it: leaving them out
    gives the same trees. Columns without any value stay. If no column is left, it is the first one.
    """
    value = {c: F.col(f"`{c}`").cast("double") for c in columns}
    kinds = {"least": F.min, "most": F.max, "total": F.sum}
    facts = df.agg(
        *(f(value[c]).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in kinds.items())
    ).first()
    alike: dict[tuple, list[str]] = {}
    for i, c in enumerate(columns):
        least, most, total = (facts[f"{k}{i}"] for k in kinds)
        if least is None or least != most:
            alike.setdefault((least, most, total), []).append(c)
    pairs = [
        (a, b)
        for (least, *_), same in alike.items()
        if least is not None
        for i, b in enumerate(same)
        for a in same[:i]
    ]
    copies: set[str] = set()
    if pairs:
        equal = df.agg(
            *(F.bool_and(value[a].eqNullSafe(value[b])).alias(str(i)) for i, (a, b) in enumerate(pairs))
        ).first()
        copies = {b for i, (_, b) in enumerate(pairs) if equal[str(i)]}
    kept = {c for same in alike.values() for c in same} - copies
    return [c for c in columns if c in kept] or list(columns[:1])


def train_mood(
    df: DataFrame,
    target: str,
    stamp: str,
    row_key: Sequence[str],
    missing: str,
    exclude: Sequence[str] = (),
    trees: int = TREES,
    depth: int = 8,
    seed: int = SEED,
    partitions: int = 8,
) -> Trained:
    """Forest regression with an 80/20 split by row key, which is no feature itself.

    ``missing`` says what happens to rows with a missing feature or target (see ``completed``);
    the result has their number. Bagging follows partitions, so rows go to a fixed number of them
    by their key and are sorted there: the fit is the same on any cluster.
    ``depth`` has to be stated: the library the results are compared with grows trees
    without a bound, Spark stops at 30. Features that no tree can split by are not given to the
    forest (see ``splitting_columns``) and have no importance.
    """
    timed = with_hour(df, stamp)
    features = feature_names(timed, target, [*exclude, *row_key])
    complete, lacking = completed(timed, [*features, target], missing)
    train, test = split(complete, row_key)
    used = splitting_columns(train, features)
    learner = RandomForestRegressor(
        featuresCol="features",
        labelCol=target,
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy="all",
        maxMemoryInMB=SUMS_MB,
        seed=seed,
    )
    dealt = train.repartition(partitions, *row_key).sortWithinPartitions(*row_key)
    forest = fit_forest(dealt.select(*used, target), used, learner, train.count())
    model = PipelineModel([VectorAssembler(inputCols=used, outputCol="features"), forest])
    return Trained(model, features, target, test, lacking, used)


def regression_metrics(predictions: DataFrame) -> DataFrame:
    """Rows, MSE and R² from sums that combine map-side (columns actual, prediction)."""
    actual, error = F.col("actual"), F.col("actual") - F.col("prediction")
    return predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        (F.lit(1.0) - F.avg(error * error) / F.nullif(F.var_pop(actual), F.lit(0.0))).alias("r2"),
    )


def residual_bins(predictions: DataFrame, width: float = 1.0) -> DataFrame:
    """Actual-against-predicted chart data: mean prediction and error per actual bin."""
    error = F.col("prediction") - F.col("actual")
    return (
        predictions.groupBy((F.floor(F.col("actual") / width) * width).alias("actual_bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("prediction").alias("mean_prediction"),
            F.avg(error).alias("mean_error"),
        )
    )
