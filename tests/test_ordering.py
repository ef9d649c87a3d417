import random

import pytest
from pyspark.sql import functions as F

from linkloom.operators import ordering as O
from linkloom.sources import text


@pytest.fixture
def many_files(spark):
    """Stop small partitions from being merged, so groups span files."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_position(spark, many_files):
    ids = random.Random(1).sample(range(10**6), 3_000)
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(5)
    got = {r.id: r.position for r in O.with_position(rows, ["id"]).collect()}
    assert got == {v: i for i, v in enumerate(sorted(ids))}


def test_running_sums_across_files(spark, many_files):
    rng = random.Random(2)
    data = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(40)}", i, rng.randrange(9)) for i in range(4_000)]
    rows = spark.createDataFrame(data, "g string, i bigint, v bigint").withColumn("one", F.lit(1))
    got = O.with_running_sums(rows, ["g"], ["i"], {"total": "v", "nth": "one"})
    sums = {}
    want = {}
    for g, i, v in data:
        total, nth = sums.get(g, (0, 0))
        sums[g] = want[i] = (total + v, nth + 1)
    assert {r.i: (r.total, r.nth) for r in got.collect()} == want


def test_running_sums_of_a_null_group(spark, many_files):
    rows = spark.createDataFrame([(None, i, 1) for i in range(400)], "g string, i bigint, v bigint").repartition(4)
    got = O.with_running_sums(rows, ["g"], ["i"], {"total": "v"})
    assert {r.i: r.total for r in got.collect()} == {i: i + 1 for i in range(400)}


def test_random_order_is_a_repeatable_permutation(spark):
    a = {r.id: r.position for r in O.random_order(spark.range(500), "id", seed=1).collect()}
    b = {r.id: r.position for r in O.random_order(spark.range(500).repartition(7), "id", seed=1).collect()}
    c = {r.id: r.position for r in O.random_order(spark.range(500), "id", seed=2).collect()}
    assert a == b != c
    assert sorted(a.values()) == list(range(500))


def test_url_list_keeps_file_order_over_splits(spark, tmp_path):
    lines = [f" line {i} " + "x" * (i % 50) for i in range(5_000)]
    (tmp_path / "seeds.txt").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        urls = text.url_list(spark, f"file://{tmp_path}/seeds.txt")
        assert urls.rdd.getNumPartitions() >= 1
        got = {r.line_no: r.url for r in urls.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == dict(enumerate(lines))
    assert [r.url for r in text.first_urls(urls, 3).orderBy("line_no").collect()] == lines[:3]


def test_smallest_is_exact(spark, monkeypatch):
    monkeypatch.setattr(O, "BINS", 4)
    rng = random.Random(1)
    values = rng.sample(range(-(10**15), 10**18), 400) + list(range(100, 300))
    table = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(5)
    for wanted in (0, 1, 17, 399, 599, 600, 10**9):
        got = sorted(r.v for r in O.smallest(table, "v", wanted).collect())
        assert got == sorted(values)[:wanted]
    assert O.smallest(table.where("false"), "v", 5).collect() == []


def test_pieces_are_small_and_in_order(spark):
    table = spark.range(1_000).selectExpr("id % 3 as g", "id * 7 % 1000 as v").repartition(6)
    rows = O.in_pieces(table, ["g", "v"], 16).orderBy("piece", "place").collect()
    assert [(r.g, r.v) for r in rows] == sorted((i % 3, i * 7 % 1000) for i in range(1_000))
    sizes = [n for _, n in sorted((p, sum(r.piece == p for r in rows)) for p in {r.piece for r in rows})]
    assert max(sizes) <= 16
