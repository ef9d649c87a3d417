import collections
import random

import pytest
from pyspark.sql import functions as F

from linkloom.operators import frontier as FR
from linkloom.operators import visited
from linkloom.operators.edges import store

SMALL = [("a", 0, "b"), ("a", 1, "c"), ("b", 0, "d"), ("c", 0, "d"), ("d", 0, "a")]


def edge_table(spark, edges):
    return spark.createDataFrame(edges, "src string, pos int, dst string")


def seed_table(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "position bigint, url string")


def crawl(seeds, edges, max_depth, max_jobs=10**9, dedupe=False):
    """One first-in first-out crawl."""
    links = collections.defaultdict(list)
    for src, pos, dst in sorted(edges, key=lambda e: (e[0], e[1])):
        links[src].append(dst)
    queue, seen, out = collections.deque(), set(), []

    def add(url, depth):
        if dedupe and url in seen:
            return
        seen.add(url)
        queue.append((depth, url))

    for url in seeds:
        add(url, 0)
    while queue and len(out) < max_jobs:
        depth, url = queue.popleft()
        out.append((depth, url))
        if depth < max_depth:
            for dst in links[url]:
                add(dst, depth + 1)
    return out


def random_graph(seed):
    rng = random.Random(seed)
    urls = [f"u{i}" for i in range(30)]
    edges = []
    for url in urls:
        edges += [(url, pos, rng.choice(urls)) for pos in range(rng.choice([0, 1, 2, 4]))]
    # One source holds a third of all links.
    edges += [("hub", pos, rng.choice(urls)) for pos in range(len(edges) // 2)]
    return ["hub", *rng.sample(urls, 3), "u1", "u1"], edges


def test_golden(spark):
    seeds, edges = seed_table(spark, ["a"]), edge_table(spark, SMALL)
    jobs = {(r.link_depth, r.url): r.n_jobs for r in FR.expand_all(seeds, edges, 2).collect()}
    assert jobs == {(0, "a"): 1, (1, "b"): 1, (1, "c"): 1, (2, "d"): 2}
    found = {(r.link_depth, r.url) for r in FR.expand_distinct(seeds, edges, 2).collect()}
    assert found == {(0, "a"), (1, "b"), (1, "c"), (2, "d")}
    queue = FR.expand_fifo(seeds, edges, 2, 3).orderBy("position").collect()
    assert [(r.position, r.url) for r in queue] == [(0, "a"), (1, "b"), (2, "c")]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_plain_crawl(spark, seed):
    seeds, edges = random_graph(seed)
    s, e = seed_table(spark, seeds), edge_table(spark, edges)
    every = collections.Counter(crawl(seeds, edges, 3))
    jobs = {(r.link_depth, r.url): r.n_jobs for r in FR.expand_all(s, e, 3).collect()}
    assert jobs == every
    first = crawl(seeds, edges, 5, dedupe=True)
    assert sorted((r.link_depth, r.url) for r in FR.expand_distinct(s, e, 5).collect()) == sorted(first)
    assert {(r.link_depth, r.url) for r in FR.visited(s, e, 3).collect()} == set(every)


@pytest.mark.parametrize("dedupe", [False, True])
@pytest.mark.parametrize("max_jobs", [7, 60, 300])
def test_queue_order(spark, dedupe, max_jobs):
    seeds, edges = random_graph(3)
    got = FR.expand_fifo(seed_table(spark, seeds), edge_table(spark, edges), 3, max_jobs, dedupe, repeat_limit=1)
    got = [(r.position, r.link_depth, r.url) for r in got.orderBy("position").collect()]
    want = crawl(seeds, edges, 3, max_jobs, dedupe)
    assert got == [(i, depth, url) for i, (depth, url) in enumerate(want)]


@pytest.mark.parametrize("max_jobs", [0, -1])
def test_budget_below_one_is_no_limit(spark, max_jobs):
    seeds, edges = random_graph(3)
    got = FR.expand_fifo(seed_table(spark, seeds), edge_table(spark, edges), 2, max_jobs)
    got = [(r.position, r.link_depth, r.url) for r in got.orderBy("position").collect()]
    assert got == [(i, depth, url) for i, (depth, url) in enumerate(crawl(seeds, edges, 2))]


@pytest.mark.parametrize("max_depth", [0, 1, 3])
@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("max_jobs", [0, 25])
def test_depth_first_equals_a_stack(spark, seed, max_depth, max_jobs):
    seeds, edges = random_graph(seed)  # has cycles
    links = collections.defaultdict(list)
    for src, _, dst in sorted(edges, key=lambda e: (e[0], e[1])):
        links[src].append(dst)
    stack, want = [(0, url) for url in seeds], []
    while stack:
        depth, url = stack.pop()
        want.append((len(want), depth, url))
        if depth < max_depth:
            stack += [(depth + 1, dst) for dst in links[url]]
    got = FR.depth_first(seed_table(spark, seeds), edge_table(spark, edges), max_depth, max_jobs)
    assert sorted(map(tuple, got.collect())) == (want[:max_jobs] if max_jobs else want)


def test_depth_first_on_a_tree(spark):
    edges = [(f"t{i}", k, f"t{3 * i + k + 1}") for i in range(13) for k in range(3)]
    got = FR.depth_first(seed_table(spark, ["t0"]), edge_table(spark, edges), 3).orderBy("position").collect()
    assert [r.url for r in got[:6]] == ["t0", "t3", "t12", "t39", "t38", "t37"] and len(got) == 40


def test_visited_urls_stay_where_they_are(spark):
    seen = visited.create(spark)
    for step in range(3):
        rows = spark.createDataFrame([(f"u{i}", step) for i in range(step * 100, step * 100 + 100)], "url string, link_depth int")
        seen.add(rows, step, placed=False)
    new = spark.createDataFrame([(f"u{i}",) for i in range(250, 350)], "url string").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        unseen = seen.unseen(new)
        plan = unseen._jdf.queryExecution().executedPlan().toString()
        assert unseen.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The only exchange is that of the new urls.
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan
    seen.forget()


def test_repeats_without_a_budget_are_not_hinted(spark):
    stored = store(edge_table(spark, [("hub", i, f"t{i}") for i in range(50)]), ["pos", "dst"])
    parents = spark.createDataFrame([("hub", i) for i in range(40)], "url string, _before bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        reached = FR._reached_with_repeats(stored, parents, 10)
        plan = reached._jdf.queryExecution().optimizedPlan().toString()
        assert reached.count() == 2_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("strategy=broadcast") <= 1  # the sliced sources, fewer than buckets
    stored.forget()


def test_depth_totals(spark):
    jobs = FR.expand_all(seed_table(spark, ["a"]), edge_table(spark, SMALL), 3)
    got = [tuple(r) for r in FR.depth_totals(jobs).orderBy("link_depth").collect()]
    assert got == [(0, 1, 1, 1), (1, 2, 2, 3), (2, 1, 2, 5), (3, 1, 2, 7)]


def test_hot_source_is_spread_and_edges_stay_put(spark):
    edges = [("hub", i, f"t{i}") for i in range(3_000)] + [(f"s{i}", 0, "t") for i in range(6_000)]
    stored = store(edge_table(spark, edges), ["pos", "dst"])
    assert [(r.url, r._slices) for r in stored.sliced.collect()] == [("hub", 3)]
    assert stored.table.where("src = 'hub'").select("slice").distinct().count() == 3
    frontier = spark.createDataFrame([("hub", 1), ("s5", 2), ("none", 3)], "url string, n bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        reached = stored.reached_from(frontier)
        plan = reached._jdf.queryExecution().executedPlan().toString()
        assert reached.count() == 3_001
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The only hash exchange is that of the frontier.
    assert plan.count("Exchange hashpartitioning") == 1
    assert reached.groupBy("n").count().where("n = 1").first()["count"] == 3_000
    assert reached.agg(F.countDistinct("dst")).first()[0] == 3_001
    stored.forget()
