"""Equi-joins of a large fact side to a lookup side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


#: A key with this share of the facts is hot; there can be at most so many of them.
HOT_SHARE, CANDIDATES = 1 / 256, 256


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst will broadcast ``df`` by its estimate of the size."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


def hot_keys(facts: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> Column:
    """Hashes of the keys that hold at least ``share`` of the facts, as a scalar array.

    A frequent-items sketch counts the keys in one pass, merged from task to task. It may take a
    key for hot that is not quite, never the other way round by more than its error, and what it
    says only decides where rows go, not which rows match.
    """
    sketch = F.expr(f"approx_top_k(h, {CANDIDATES}, {16 * CANDIDATES})")
    counted = facts.select(F.xxhash64(*on).alias("h")).agg(
        sketch.alias("top"), F.count(F.lit(1)).alias("n")
    )
    often = F.filter("top", lambda t: t["count"] >= F.col("n") * share)
    return counted.select(F.transform(often, lambda t: t["item"])).scalar()


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    salt_by: Sequence[str],
    how: str = "left",
    salts: int = 8,
) -> DataFrame:
    """Join ``facts`` to ``lookup`` when one key may hold a large share of the facts.

    A ``lookup`` that Catalyst knows to be under ``autoBroadcastJoinThreshold`` is broadcast as it
    is. Beyond that both sides shuffle, and a pass over the keys of the facts finds the hot ones.
    The facts of a hot key spread over ``salts`` partitions by ``salt_by`` (columns that vary within
    a key) and only its lookup rows are repeated, once per salt, so no match is lost and the lookup
    side grows by the rows of at most ``CANDIDATES`` keys. The repeat also puts an exchange directly
    under each side of the join, which lets AQE split what is still too large.
    """
    keys = list(on)
    if salts <= 1 or fits_broadcast(lookup):
        return facts.join(lookup, keys, how)
    none = F.array().cast("array<bigint>")  # of no facts no key is hot
    hot = F.array_contains(F.coalesce(hot_keys(facts, keys), none), F.xxhash64(*keys))
    spread = F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")
    salted = facts.withColumn(SALT, F.when(hot, spread).otherwise(0))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    repeated = lookup.withColumn(SALT, F.explode(F.when(hot, every).otherwise(F.array(F.lit(0)))))
    return salted.join(repeated, [*keys, SALT], how).drop(SALT)


def null_safe_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join where a NULL key matches a NULL key; keeps the left keys."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on]
    return left.join(renamed, condition, how).drop(*(f"_r_{k}" for k in on))
