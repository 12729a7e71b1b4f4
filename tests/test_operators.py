from __future__ import annotations

import random

import pytest
from conftest import executed
from pyspark.sql import Window
from pyspark.sql import functions as F

from skytune.operators import picks
from skytune.operators.context import with_group_context
from skytune.operators.joins import HOT_SHARE, fits_broadcast, hot_keys, lookup_join, null_safe_join
from skytune.operators.lagging import bucketed_lag, with_null_ranges
from skytune.operators.reshape import parallel_arrays_to_rows, positional_to_rows, to_records
from skytune.operators.splitting import md5_bucket, split
from skytune.sources.measures import counted, profile


def global_lag(df, values, order_by, keys=()):
    """Plain form: one window over all rows of a key."""
    window = Window.partitionBy(*keys).orderBy(*(F.col(c).asc_nulls_first() for c in order_by))
    return df.withColumns({out: F.lag(src).over(window) for out, src in values.items()})


def _series(spark, keyed: bool, undated: float = 0.1):
    rng = random.Random(7)
    data = [
        (
            i % 3 if keyed else 0,
            i,
            None if rng.random() < undated else 1_700_000_000 + 3600 * rng.randrange(400),
            None if rng.random() < 0.2 else rng.randrange(50),
        )
        for i in range(800)
    ]
    df = spark.createDataFrame(data, "place int, id int, s bigint, v int")
    return df.withColumn("ts", F.timestamp_seconds("s")).withColumn("day", F.to_date("ts"))


@pytest.mark.parametrize("undated", [0, 0.1, 0.34, 1])
@pytest.mark.parametrize("keys", [(), ("place",)])
def test_bucketed_lag_equals_global_lag(spark, keys, undated):
    df = _series(spark, bool(keys), undated)
    df = df.withColumn("id", F.when(F.col("id") % 400 != 7, F.col("id")))  # a tie-break may be missing
    order = ["ts", "id", "s"]
    plain = global_lag(df, {"prev": "v"}, order, keys).select("id", "prev")
    levels = bucketed_lag(df, {"prev": "v"}, "day", order, keys).select("id", "prev")
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(
        map(tuple, levels.collect()), key=str
    )


def test_rows_without_a_bucket_are_cut_into_ranges(spark):
    df = _series(spark, False, 0.34)
    context = {"rows": F.count(F.lit(1)), "top": F.max("v")}
    got = bucketed_lag(df, {"prev": "v"}, "day", ["ts", "id"], context=context)
    assert got.columns == [*df.columns, "rows", "top", "prev"] or set(got.columns) == {
        *df.columns, "rows", "top", "prev"}
    lost = df.where("day IS NULL")
    row = got.where("day IS NULL").select("rows", "top").distinct().collect()
    assert [tuple(r) for r in row] == [(lost.count(), lost.agg(F.max("v")).first()[0])]
    ranges = with_null_ranges(df, "day", ["ts", "id"]).groupBy("day", "_sub").count()
    sizes = [r["count"] for r in ranges.where("day IS NULL").collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)
    assert ranges.where("day IS NOT NULL AND _sub <> 0").isEmpty()
    # text has no quantiles, so those rows stay together, with the same result
    text = df.withColumn("id", F.lpad(F.col("id").cast("string"), 4, "0"))
    plain = global_lag(text, {"prev": "v"}, ["ts", "id"]).select("id", "prev")
    levels = bucketed_lag(text, {"prev": "v"}, "day", ["ts", "id"]).select("id", "prev")
    assert plain.exceptAll(levels).isEmpty() and levels.count() == 800


def test_bucketed_lag_keeps_rows_apart(spark):
    df = _series(spark, keyed=False).withColumn("pad", F.repeat(F.lit("x"), 10))
    plan = bucketed_lag(df, {"prev": "v"}, "day", ["ts", "id"])._jdf.queryExecution()
    single = [
        line for line in plan.executedPlan().toString().split("\n") if "SinglePartition" in line
    ]
    # only the frame with one row per day is ordered as a whole; the cuts are one row
    assert 1 <= len(single) <= 3
    for gathered in plan.executedPlan().toString().split("SinglePartition")[1:]:
        assert "pad" not in gathered.split("\n")[1]


def test_group_context_equals_window(rows):
    df = rows("g string, v int", ("a", 1), ("a", 3), (None, 5), (None, 7), ("b", None))
    got = with_group_context(df, ["g"], {"m": F.avg("v"), "lo": F.min("v")})
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a", 1, 2.0, 1), ("a", 3, 2.0, 1), (None, 5, 6.0, 5), (None, 7, 6.0, 5),
         ("b", None, None, None)], key=str)


def _skewed(spark):
    facts = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97))
        .alias("k"),
        "id",
    )
    lookup = spark.createDataFrame(
        [("hot", 1), ("k1", 2), ("k1", 3), ("unused", 4)], "k string, w int"
    )
    return facts, lookup


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_equals_plain_join(spark, how):
    facts, lookup = _skewed(spark)
    plain = facts.join(lookup, "k", how).select("k", "id", "w")
    salted = lookup_join(facts, lookup, ["k"], ["id"], how).select("k", "id", "w")
    assert plain.count() == salted.count()
    assert plain.exceptAll(salted).isEmpty()


def test_small_lookup_is_broadcast_as_it_is(spark):
    facts, _ = _skewed(spark)
    lookup = spark.range(9).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("w"))
    assert fits_broadcast(lookup) and not fits_broadcast(spark.range(10**8))
    plan = executed(lookup_join(facts, lookup, ["k"], ["id"]))
    assert "BroadcastHashJoin" in plan and "approx_top_k" not in plan


def test_only_hot_keys_are_repeated(spark):
    facts, lookup = _skewed(spark)
    hot = spark.range(1).select(hot_keys(facts, ["k"]).alias("h")).first().h
    often = facts.groupBy("k").count().where(F.col("count") >= 6000 * HOT_SHARE)
    assert set(hot) == {r[0] for r in often.select(F.xxhash64("k")).collect()}
    few = facts.unionByName(spark.range(9000, 200000).select(F.col("id").cast("string").alias("k"), "id"))
    hot = spark.range(1).select(hot_keys(few, ["k"]).alias("h")).first().h
    assert hot == [facts.where("k = 'hot'").select(F.xxhash64("k")).first()[0]]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for f in (few, facts.where("id < 0"), facts.withColumn("k", F.lit(None).cast("string"))):
            for how in ("left", "inner"):
                plain = f.join(lookup, "k", how).select("k", "id", "w")
                salted = lookup_join(f, lookup, ["k"], ["id"], how).select("k", "id", "w")
                assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()
        joined = lookup_join(few, lookup, ["k"], ["id"], "inner")
        assert "BroadcastHashJoin" not in executed(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_key_is_spread_and_split_without_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "500",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts, lookup = _skewed(spark)
        best = picks.top_per_key(lookup, ["k"], [F.desc("w")])
        # identical rows can not be told apart by salt; the runtime split has to cut them
        copies = facts.repartition(8).withColumn("same", F.col("id") >= 0)
        joined = lookup_join(copies, best, ["k"], ["same"], "inner")
        assert joined.count() == 2000 + facts.where("k = 'k1'").count()
        assert "skew=true" in executed(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_null_safe_join(rows):
    left = rows("k int, a int", (1, 10), (None, 20), (2, 30))
    right = rows("k int, b int", (1, 5), (None, 6))
    got = {(r.k, r.a, r.b) for r in null_safe_join(left, right, ["k"]).collect()}
    assert got == {(1, 10, 5), (None, 20, 6), (2, 30, None)}


def test_top_per_key_prefers_known_popularity_then_lowest_id(rows):
    df = rows("k string, p int, id string", ("a", 5, "T2"), ("a", 5, "T1"), ("a", None, "T0"),
              ("b", None, "T9"), (None, 1, "T5"), (None, 2, "T6"))
    best = picks.top_per_key(df, ["k"], [F.desc_nulls_last("p"), F.asc("id")])
    assert {(r.k, r.id) for r in best.collect()} == {("a", "T1"), ("b", "T9"), (None, "T6")}
    plan = executed(best).split("== Initial Plan ==")[1]
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle


def test_latest_and_distinct(rows):
    df = rows("t int, id int", (1, 1), (3, 2), (2, 3), (3, 2))
    assert [tuple(r) for r in picks.latest(df, [F.desc("t"), F.desc("id")], 2).collect()] == [
        (3, 2), (3, 2)]
    assert picks.distinct_rows(df).count() == 3


def test_parallel_arrays(spark):
    doc = '{"h":{"t":["a","b"],"v":[1.5,null]}}'
    schema = "h struct<t:array<string>,v:array<double>>"
    df = spark.createDataFrame([(doc,)], "j string").select(F.from_json("j", schema).alias("d"))
    got = parallel_arrays_to_rows(df.select("d.*"), "h", ["t", "v"]).collect()
    assert [tuple(r) for r in got] == [("a", 1.5), ("b", None)]


def test_arrays_of_unequal_length_are_refused(rows):
    df = rows("h struct<t:array<string>,v:array<int>>", ((["a", "b"], [1]),))
    with pytest.raises(Exception, match="differ in length"):
        parallel_arrays_to_rows(df, "h", ["t", "v"]).collect()


def test_positional_names_follow_the_request(rows):
    df = rows("t array<string>, v array<array<double>>", (["x", "y"], [[1.0, 2.0], [3.0, 4.0]]))
    got = positional_to_rows(df, "v", ["humidity", "cloud"], "t").collect()
    assert [r.asDict() for r in got] == [
        {"t": "x", "humidity": 1.0, "cloud": 3.0}, {"t": "y", "humidity": 2.0, "cloud": 4.0}]


def test_records_keep_null_fields(rows):
    got = to_records(rows("a int, b string", (1, None))).first()[0]
    assert got == '{"a":1,"b":null}'


def test_split_is_stable_complete_and_about_a_fifth(spark):
    df = spark.range(5000)
    train, test = split(df, ["id"])
    assert train.count() + test.count() == 5000
    assert train.intersect(test).isEmpty()
    assert 850 < test.count() < 1150
    # md5("7") = 8f14e45f...
    assert spark.range(7, 8).select(md5_bucket(["id"])).first()[0] == 0x8F14E45F % 100


def test_profile_and_counts(rows):
    df = rows("a int, `b c` string", (1, None), (None, None), (3, "x"))
    assert [tuple(r) for r in profile(df).collect()] == [
        ("a", "int", 3, 2, 1), ("b c", "string", 3, 1, 2)]
    watched, seen = counted(df, "stage")
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 3
