import random

import pytest
from pyspark.sql import functions as F

from linkloom.operators import sampler as S
from linkloom.operators import series as R


def brute(times, rate):
    last, acc, out = None, 0, []
    for t in sorted(times):
        if last is None:
            last = t
        acc += 1
        gap = (t - last) // rate
        if gap >= 1:
            out += [acc] + [0] * (gap - 1)
            acc, last = 0, t
    return out + [acc]


def tick_table(spark, times_by_worker):
    rows = [(w, int(t), 1) for w, times in times_by_worker.items() for t in times]
    return spark.createDataFrame(rows, "worker string, t bigint, n bigint")


def dense(spark, times_by_worker, rate, fold_limit):
    rows = S.dense(S.samples(tick_table(spark, times_by_worker), rate, fold_limit)).collect()
    out = {}
    for r in rows:
        out.setdefault(r.worker, {})[r.idx] = r.jobs
    assert all(sorted(v) == list(range(len(v))) for v in out.values())
    return {w: [v[i] for i in range(len(v))] for w, v in out.items()}


@pytest.mark.parametrize("fold_limit", [1_000, 20, 0])
def test_null_times_and_workers(spark, fold_limit):
    rng = random.Random(4)
    log = [(rng.choice([None, "a", "b"]), None if rng.random() < 0.1 else rng.randrange(900 * S.SECOND)) for _ in range(200)]
    table = spark.createDataFrame(log, "worker string, us bigint").withColumn("processed_at", F.timestamp_micros("us"))
    rows = S.dense(S.samples(S.ticks(table), 60, fold_limit)).collect()
    got = {w: [r.jobs for r in sorted((r for r in rows if r.worker == w), key=lambda r: r.idx)] for w in (None, "a", "b")}
    assert got == {w: brute([t for v, t in log if v == w and t is not None], 60 * S.SECOND) for w in (None, "a", "b")}
    lost = {r.worker: r.n_untimed for r in S.untimed(table).collect()}
    assert lost == {w: sum(v == w and t is None for v, t in log) for w in (None, "a", "b")}


def test_long_gaps_are_spread(spark):
    rows = S.dense(S.samples(tick_table(spark, {"a": [0, 3_000_000 * S.SECOND]}), 1))
    assert rows.withColumn("p", F.spark_partition_id()).select("p").distinct().count() > 1
    assert rows.count() == 3_000_001


@pytest.mark.parametrize("fold_limit", [1_000, 0])
def test_golden(spark, fold_limit):
    s = S.SECOND
    times = {
        "a": [0, 10 * s, 70 * s, 250 * s],
        "b": [5 * s],
        "c": [0, 60 * s],
        "d": [0, 60 * s, 60 * s, 60 * s, 61 * s, 120 * s],
        "e": [0, 59 * s, 119 * s, 179 * s, 239 * s, 300 * s],
    }
    got = dense(spark, times, 60, fold_limit)
    assert got["a"] == [3, 1, 0, 0, 0]
    assert got["b"] == [1]
    assert got["c"] == [2, 0]
    assert got == {w: brute(t, 60 * s) for w, t in times.items()}


@pytest.mark.parametrize("fold_limit", [10**6, 40, 0])
def test_random_against_brute_force(spark, fold_limit):
    rng = random.Random(7)
    rate = 3 * S.SECOND
    times = {}
    for w in range(12):
        t, out = rng.randrange(10**12), []
        for _ in range(rng.choice([1, 5, 60, 400])):
            t += rng.choice([0, 1, rng.randrange(S.SECOND), rng.randrange(9 * S.SECOND), rate, rate - 1])
            if rng.random() < 0.02:
                t += rng.randrange(10**4) * S.SECOND
            out.append(t)
        times[f"w{w}"] = out
    got = dense(spark, times, 3, fold_limit)
    assert got == {w: brute(t, rate) for w, t in times.items()}
    assert all(sum(got[w]) == len(times[w]) for w in times)


def test_both_paths_agree_on_since_and_open(spark):
    rng = random.Random(3)
    times = {"x": [rng.randrange(10**9) for _ in range(500)], "y": [1, 2, 3]}
    rows = tick_table(spark, times)
    a = sorted(map(tuple, S.samples(rows, 7, 10**6).collect()))
    b = sorted(map(tuple, S.samples(rows, 7, 0).collect()))
    assert a == b
    assert sum(r[5] for r in a) == 2


def align(spark, series):
    rows = [
        (w, start * S.SECOND, i, jobs, 1, i == len(samples) - 1, 0)
        for w, (start, samples) in series.items()
        for i, jobs in enumerate(samples)
    ]
    table = spark.createDataFrame(
        rows, "worker string, start bigint, idx bigint, jobs bigint, slots bigint, open boolean, since bigint"
    )
    return [r.jobs for r in R.consolidate(table, 60).orderBy("bucket").collect()]


def test_alignment(spark):
    assert align(spark, {"a": (0, [3, 1, 0, 0, 0]), "b": (130, [2, 5])}) == [3, 1, 2, 5, 0]
    assert align(spark, {"a": (0, [1]), "b": (180, [1])}) == [1, 0, 0, 1]


@pytest.mark.parametrize("chunk", [3, 4, 10_000])
def test_moving_average(spark, chunk):
    values = [3, 1, 2, 5, 8, 0, 1, 7, 7]
    rows = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "stage string, idx bigint, jobs bigint")
    got = [r.moving_avg for r in R.moving_average(rows, 3, ["stage"], chunk=chunk).orderBy("idx").collect()]
    want = [sum(values[max(0, i - 2) : i + 1]) / len(values[max(0, i - 2) : i + 1]) for i in range(len(values))]
    assert got == pytest.approx(want)


def test_bounds(spark):
    s = S.SECOND
    rows = S.samples(tick_table(spark, {"a": [0, 10 * s, 70 * s, 250 * s], "b": [130 * s]}), 60)
    bounds = S.sample_bounds(rows, 60)
    assert {tuple(r) for r in bounds.collect()} == {("a", 0, 5, 300 * s), ("b", 130 * s, 1, 190 * s)}
    assert tuple(S.overall_bounds(bounds).first()) == (0, 300 * s)
