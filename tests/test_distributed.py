"""The distributed statistics against brute force, with hot groups, ties and NULLs."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from row_values import rows_of
from stockledger.functions import distributed
from stockledger.functions.distributed import frequency_profile, grouped_medians, running_total


def sample(seed, size, values):
    rng = random.Random(seed)
    groups = ["hot"] * 4 + ["b", "c", None]
    return [(rng.choice(groups), values(rng)) for _ in range(size)]


def by_group(data):
    groups = {}
    for k, v in data:
        groups.setdefault(k, []).append(v)
    return groups


def check_frequencies(spark, data, kind):
    found = frequency_profile(spark.createDataFrame(data, f"k string, v {kind}"), ["k"], "v")
    expected = []
    for k, values in by_group(data).items():
        known = [v for v in values if v is not None]
        top = max(values.count(v) for v in set(values))
        modes = [v for v in set(values) if values.count(v) == top]
        mode = None if None in modes else min(modes)
        expected.append((k, mode, max(known), statistics.fmean(known), statistics.stdev(known), min(known)))
    want = spark.createDataFrame(expected, f"k string, mode {kind}, hi {kind}, mean double, std double, lo {kind}")
    assert rows_of(found) == rows_of(want)


def test_frequency_profile_matches_brute_force(spark):
    check_frequencies(spark, sample(3, 4000, lambda r: None if r.random() < 0.05 else r.randint(-20, 20)), "bigint")
    check_frequencies(spark, sample(4, 4000, lambda r: None if r.random() < 0.05 else r.randint(-20, 20) / 4), "double")


def test_deviation_of_large_whole_numbers_is_exact(spark):
    base = 10**9
    df = spark.createDataFrame([("a", base + d) for d in (0, 1, 2)] + [("b", base)] * 3, "k string, v bigint")
    assert rows_of(frequency_profile(df, ["k"], "v"), "k", "std") == [("a", 1.0), ("b", 0.0)]


def test_profile_of_small_groups(spark):
    df = spark.createDataFrame([("one", 4.0), ("none", None), ("two", 1.0), ("two", 2.0)], "k string, v double")
    assert rows_of(frequency_profile(df, ["k"], "v"), "k", "mode", "mean", "std") == [
        ("none", None, None, None), ("one", 4.0, 4.0, None), ("two", 1.0, 1.5, 0.707107)
    ]


def check_medians(spark, data, partitions):
    df = spark.createDataFrame([(k, v, None if v is None else -v) for k, v in data], "k string, v double, w double")
    medians = grouped_medians(df.repartition(partitions), ["k"], {"v": "mv", "w": "mw"}, [F.count("*").alias("rows")])
    found = {r.k: (r.mv, r.mw) for r in medians.collect()}
    assert sum(r.rows for r in medians.collect()) == len(data)
    for k, values in by_group(data).items():
        known = [v for v in values if v is not None]
        middle = statistics.median(known)
        assert found[k] == (middle, -middle), k


def test_medians_of_continuous_values(spark):
    check_medians(spark, sample(5, 60001, lambda r: r.gauss(0, 1)), 7)


def test_medians_of_many_sizes(spark):
    data = [(f"g{n}", float(v)) for n in (*range(1, 40), 999, 5000, 5001) for v in random.Random(n).sample(range(10 * n), n)]
    check_medians(spark, data, 9)


def test_medians_without_slices_and_beyond_numbers(spark, monkeypatch):
    inf = float("inf")
    data = [("a", -inf), ("a", inf), ("a", 3.0), ("b", -inf), ("b", 1.0), ("b", 2.0), ("c", 1e308), ("c", -1e308), ("c", 5.0), ("c", 6.0)]
    check_medians(spark, data, 2)
    monkeypatch.setattr(distributed, "SLICES", 1)
    check_medians(spark, sample(8, 9000, lambda r: r.random()), 3)


def test_medians_run_nothing_before_they_are_read_and_rank_few_rows(spark):
    tracker, group = spark.sparkContext.statusTracker(), "medians"
    df = spark.range(200_000).selectExpr("id % 2 AS k", "hash(id) / 7.0D AS v")
    spark.sparkContext.setJobGroup(group, group)
    medians = grouped_medians(df, ["k"], {"v": "m"})
    assert tracker.getJobIdsForGroup(group) == []
    values = df.toPandas()
    found = {r.k: r.m for r in medians.collect()}
    assert found == {k: own.v.median() for k, own in values.groupby("k")}
    plan = medians._jdf.queryExecution().executedPlan().toString()
    assert "percentile_approx" in plan and plan.count("Window") >= 2


def test_medians_with_heavy_ties_and_nulls(spark):
    check_medians(spark, sample(6, 9000, lambda r: r.choice([0.0, 0.0, 0.0, 1.0, r.random(), None])), 5)
    check_medians(spark, sample(7, 40000, lambda r: r.choice([0.0, 0.0, 1.0, r.random(), None])), 5)


def test_medians_of_tiny_groups(spark):
    check_medians(spark, [("a", 1.0), ("b", 1.0), ("b", 2.0), ("c", 1.0), ("c", 5.0), ("c", 2.0), (None, 7.0)], 3)


def test_running_total_equals_one_global_window(spark):
    rng = random.Random(9)
    # two thirds of the rows share one value
    data = [(i, rng.choice([5, 5, rng.randint(-50, 50)])) for i in range(3000)]
    df = spark.createDataFrame(data, "k bigint, v bigint")
    order = [F.col("v").desc(), F.col("k").asc()]
    for partitions in (1, 3, 16):
        found = running_total(df, order, "v", "upto", "whole", partitions)
        w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        want = df.withColumn("upto", F.sum("v").over(w)).withColumn("whole", F.lit(sum(v for _, v in data)))
        assert rows_of(found, "k", "v", "upto", "whole") == rows_of(want, "k", "v", "upto", "whole")


def test_running_total_of_nothing(spark):
    df = spark.createDataFrame([], "k bigint, v bigint")
    assert running_total(df, [F.col("k")], "v", "upto", "whole", 3).count() == 0


def test_shared_folder_is_the_one_the_session_names(spark):
    folder = distributed.shared_folder(spark)
    assert folder == spark.sparkContext.getCheckpointDir()

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        distributed.shared_folder(Session())


def test_kept_tables_outlive_their_owner(spark, tmp_path):
    written = []
    with distributed.Scratch(spark) as outer:
        with distributed.Scratch(spark) as inner:
            gone, kept = distributed.materialize(spark.range(3)), inner.keep(spark.range(5))
            written += [inner.paths[0], outer.paths[0]]
        assert kept.count() == 5 and inner.paths == [] and outer.paths == written[1:]
        with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST|does not exist"):
            gone.collect()
    with distributed.Scratch(spark) as alone:
        free = alone.keep(spark.range(7))
    assert free.count() == 7 and outer.paths == []


def test_values_of_groups_that_the_sketch_holds_are_not_shuffled(spark, tmp_path):
    """One large group among many small ones: its values alone meet for their ranks."""
    many = 2 * distributed.HELD_WHOLE
    df = spark.range(30_000).selectExpr(f"IF(id < {many}, -1, id DIV 3) AS k", "hash(id) / 7.0D AS v")
    df.write.parquet(f"{tmp_path}/lines")
    medians = grouped_medians(spark.read.parquet(f"{tmp_path}/lines"), ["k"], {"v": "m"})
    rows = {r.k: r.m for r in medians.collect()}
    assert rows == {k: own.v.median() for k, own in df.toPandas().groupby("k")}
    plan = medians._jdf.queryExecution().executedPlan()
    exchanges, waiting = [], [plan.executedPlan()]
    while waiting:
        node = waiting.pop()
        if node.nodeName().endswith("QueryStage"):
            waiting.append(node.plan())
        if node.nodeName() == "Exchange":
            exchanges.append(node.metrics().apply("shuffleRecordsWritten").value())
        waiting += [node.children().apply(i) for i in range(node.children().length())]
    # the groups once or twice, and the large group's values
    assert sum(exchanges) < 2.5 * len(rows) + 2 * many


@pytest.mark.parametrize("size", [distributed.SKETCH_ACCURACY // 5 + d for d in (-1, 0, 1, 2)])
def test_medians_where_the_sketch_stops_holding_a_group(spark, size):
    check_medians(spark, [("a", float(v)) for v in random.Random(size).sample(range(10**6), size)], 5)
