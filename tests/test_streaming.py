import random

import pytest
from pyspark.sql import functions as F

from linkloom import session
from linkloom.operators import frontier as FR
from linkloom.operators import pages as P
from linkloom.operators import sampler as S
from linkloom.sinks import pages as page_sink
from linkloom.streaming import crawl as ST
from linkloom.streaming import queue as QU

LOG = "worker string, processed_at timestamp, n_links bigint"
RATE = 60


def write_batches(spark, folder, batches, schema, transform=lambda df: df):
    for i, batch in enumerate(batches):
        transform(spark.createDataFrame(batch, schema)).coalesce(1).write.mode("append").parquet(f"file://{folder}")


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{folder}")


def log_batches():
    """Three time-ordered batches; worker hot has a third of all jobs and more."""
    rng = random.Random(5)
    rows = [
        (rng.choice(["hot", "hot", "w1", "w2", f"x{rng.randrange(9)}"]), rng.randrange(3_000 * 1_000_000), rng.randrange(5))
        for _ in range(900)
    ]
    rows.sort(key=lambda r: r[1])
    return [rows[:300], rows[300:600], rows[600:]]


def timed(df):
    return df.select("worker", F.timestamp_micros("us").alias("processed_at"), "n_links")


@pytest.fixture
def log(spark, tmp_path):
    write_batches(spark, tmp_path / "log", log_batches(), "worker string, us bigint, n_links bigint", timed)
    return tmp_path


def latest_state(spark, path):
    """The newest version of every bucket."""
    table = spark.read.parquet(f"{path}/state")
    newest = table.groupBy("bucket").agg(F.max("batch_id").alias("batch_id"))
    return table.join(newest, ["bucket", "batch_id"])


def test_sampler_leaves_nothing_behind_and_touches_few_buckets(spark, tmp_path):
    s = S.SECOND
    batches = [[(f"w{i}", 10 * n * s, 0) for i in (range(40) if n == 0 else [7])] for n in range(6)]
    write_batches(spark, tmp_path / "log", batches, "worker string, us bigint, n_links bigint", timed)
    path = f"file://{tmp_path}/run"
    before = set(session.folders(spark, session._run_dir(spark)))
    ST.sampler(stream(spark, tmp_path / "log", LOG), RATE, path, fold_limit=1).awaitTermination()
    assert set(session.folders(spark, session._run_dir(spark))) <= before
    versions = {b.name: sorted(v.name for v in b.glob("batch_id=*")) for b in (tmp_path / "run" / "state").glob("bucket=*")}
    assert len(versions) > 10
    # Only the bucket of the busy worker was written after the first batch; it keeps its last two versions.
    assert [v for v in versions.values() if v != ["batch_id=0"]] == [["batch_id=4", "batch_id=5"]]
    assert latest_state(spark, path).count() == 40


@pytest.mark.parametrize("fold_limit", [1_000, 20])
def test_sampler_equals_batch(spark, log, fold_limit):
    path = f"file://{log}/run"
    ST.sampler(stream(spark, log / "log", LOG), RATE, path, fold_limit=fold_limit).awaitTermination()
    whole = S.samples(S.ticks(spark.read.parquet(f"file://{log}/log")), RATE)
    columns = ["worker", "start", "idx", "jobs", "slots", "since"]
    closed = spark.read.parquet(f"{path}/out").select(*columns)
    assert sorted(closed.collect()) == sorted(whole.where("not open").select(*columns).collect())
    state = latest_state(spark, path)
    still_open = whole.where("open").select("worker", "start", F.col("since").alias("last"), F.col("jobs").alias("acc"), "idx")
    assert sorted(state.select("worker", "start", "last", "acc", "idx").collect()) == sorted(still_open.collect())
    assert state.agg(F.sum("n_dropped")).first()[0] == 0


def test_sampler_counts_late_jobs(spark, tmp_path):
    s = S.SECOND
    batches = [[("a", 0, 0), ("a", 70 * s, 0)], [("a", 10 * s, 0), ("a", 75 * s, 0), ("a", 200 * s, 0)]]
    write_batches(spark, tmp_path / "log", batches, "worker string, us bigint, n_links bigint", timed)
    path = f"file://{tmp_path}/run"
    ST.sampler(stream(spark, tmp_path / "log", LOG), RATE, path).awaitTermination()
    closed = spark.read.parquet(f"{path}/out").orderBy("idx").collect()
    assert [(r.idx, r.jobs, r.slots) for r in closed] == [(0, 2, 1), (1, 2, 2)]
    state = latest_state(spark, path).first()
    assert (state["last"], state.acc, state.idx, state.n_dropped) == (200 * s, 0, 3, 1)


def test_throughput_equals_batch(spark, log):
    path = f"file://{log}/run"
    ST.throughput(stream(spark, log / "log", LOG), RATE, "10 minutes", path).awaitTermination()
    batch = spark.read.parquet(f"file://{log}/log").groupBy(
        F.window("processed_at", f"{RATE} seconds").start.alias("window_start"), "worker"
    )
    want = batch.agg(F.count("*").alias("jobs")).collect()
    assert sorted(ST.read_throughput(spark, path).collect()) == sorted(want)


def test_late_jobs_are_counted(spark, tmp_path):
    s = S.SECOND
    batches = [
        [("a", 0, 0), ("a", 5_000 * s, 0), ("b", 5_010 * s, 0)],
        [("a", 6_000 * s, 0)],
        [("a", 10 * s, 0), ("b", 4_990 * s, 0), ("a", 20 * s, 0), ("a", 6_000 * s, 0)],
        [("b", 4_990 * s, 0), ("c", None, 0), ("c", 6_001 * s, 0)],
    ]
    schema = "worker string, us bigint, n_links bigint"
    write_batches(spark, tmp_path / "log", batches, schema, timed)
    path = f"file://{tmp_path}/run"
    query = ST.throughput(stream(spark, tmp_path / "log", LOG), RATE, "10 minutes", path)
    query.awaitTermination()
    ST.note_arrivals(query, path)
    ST.note_arrivals(query, path)
    got = [tuple(r) for r in ST.read_late(spark, path).orderBy("batch_id").collect()]
    # A batch drops what is behind the watermark that the batch before it began with.
    assert got == [(0, 3, 0, 3, 0), (1, 1, 0, 1, 0), (2, 4, 0, 2, 2), (3, 3, 1, 1, 1)]


def test_totals(spark, log):
    path = f"file://{log}/run"
    ST.totals(stream(spark, log / "log", LOG), path).awaitTermination()
    rows = [r for batch in log_batches() for r in batch]
    assert tuple(ST.read_totals(spark, path).first()) == (len(rows), sum(r[2] for r in rows))


PAGES = "page_id bigint, url string, html string"


def page_batches():
    page = "<meta name=title content='t{0}'><body>{0}<a href=http://a/{0}><a href=/b>"
    return [
        [(1, "u1", page.format(1)), (2, "u1", page.format(2)), (3, "u2", None)],
        [(4, "u1", page.format(4)), (5, "u3", page.format(5))],
    ]


def test_tables_are_folders_or_files_and_may_be_empty(spark, tmp_path):
    write_batches(spark, tmp_path / "pages.parquet", page_batches(), PAGES)
    one = next((tmp_path / "pages.parquet").glob("part-*"))
    for n, (table, rows) in enumerate([(tmp_path / "pages.parquet", 5), (one, None)]):
        path = f"file://{tmp_path}/run{n}"
        ST.parse_pages(ST.read_table(spark, f"file://{table}", PAGES, 1), ["page_id"], path).awaitTermination()
        got = ST.read_parsed(spark, path, ["page_id bigint"])
        assert got.count() == (rows or spark.read.parquet(f"file://{one}").count())
    spark.createDataFrame([], PAGES).write.parquet(f"file://{tmp_path}/none.parquet")
    path = f"file://{tmp_path}/run-empty"
    ST.store_pages(ST.read_table(spark, f"file://{tmp_path}/none.parquet", PAGES), ["page_id"], path).awaitTermination()
    assert page_sink.read_pages(spark, f"{path}/out").collect() == []
    assert ST.read_samples(spark, path).collect() == []
    assert tuple(ST.read_totals(spark, f"{path}/x").first()) == (0, 0)


def test_parse_equals_batch(spark, tmp_path):
    write_batches(spark, tmp_path / "in", page_batches(), PAGES)
    path = f"file://{tmp_path}/run"
    ST.parse_pages(stream(spark, tmp_path / "in", PAGES), ["page_id"], path).awaitTermination()
    got = spark.read.parquet(f"{path}/out")
    want = P.parse(spark.read.parquet(f"file://{tmp_path}/in"), ["page_id"])
    assert sorted(got.drop("pruned_links").collect()) == sorted(want.collect())
    pruned = {r.page_id: r.pruned_links for r in got.collect()}
    assert pruned[1] == ["http://a/1"] and pruned[3] == []


def test_page_table_equals_batch(spark, tmp_path):
    write_batches(spark, tmp_path / "in", page_batches(), PAGES)
    path = f"file://{tmp_path}/run"
    ST.store_pages(stream(spark, tmp_path / "in", PAGES), ["page_id"], path).awaitTermination()
    got = page_sink.read_pages(spark, f"{path}/out")
    parsed = P.parse(spark.read.parquet(f"file://{tmp_path}/in"), ["page_id", "url"])
    first = parsed.groupBy("url").agg(F.min("page_id").alias("page_id"))
    want = page_sink.page_rows(parsed.join(first, ["url", "page_id"]))
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
    assert {(r.page_url, r.title) for r in got.collect()} == {("u1", "t1"), ("u2", None), ("u3", "t5")}


def graph(spark):
    rng = random.Random(8)
    urls = [f"u{i}" for i in range(40)]
    edges = [(u, pos, rng.choice(urls)) for u in urls for pos in range(rng.choice([0, 1, 3]))]
    edges += [("hub", pos, rng.choice(urls)) for pos in range(30)]
    return spark.createDataFrame(["hub", "u1", "u2", "u2"], "string").toDF("url"), spark.createDataFrame(edges, "src string, pos int, dst string")


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("files_per_batch", [1, 1_000])
def test_queue_equals_frontier(spark, tmp_path, dedupe, files_per_batch):
    seeds, edges = graph(spark)
    path = QU.crawl(seeds, lambda path: QU.by_edges(edges, 3), dedupe, files_per_batch, f"file://{tmp_path}/crawl")
    want = FR.expand_distinct(seeds, edges, 3) if dedupe else FR.expand_all(seeds, edges, 3)
    assert sorted(QU.read_jobs(spark, path, dedupe).select(want.columns).collect()) == sorted(want.collect())


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("fails_at", ["process", "queue"])
def test_queue_goes_on_after_a_failure(spark, tmp_path, dedupe, fails_at):
    seeds, edges = graph(spark)
    path = f"file://{tmp_path}/crawl"
    QU.submit(seeds, path)
    whole = QU.by_edges(edges, 3)

    def breaks(jobs, batch_id):
        found = whole(jobs, batch_id)
        if batch_id == 2:
            if fails_at == "queue":  # its jobs are in the queue already when it fails
                found.write.mode("overwrite").parquet(f"{path}/queue/batch-{batch_id}")
            raise RuntimeError("lost")
        return found

    with pytest.raises(Exception, match="lost"):
        QU.run(spark, breaks, path, dedupe)
    QU.run(spark, whole, path, dedupe)
    want = FR.expand_distinct(seeds, edges, 3) if dedupe else FR.expand_all(seeds, edges, 3)
    assert sorted(QU.read_jobs(spark, path, dedupe).select(want.columns).collect()) == sorted(want.collect())


def test_running_queue_takes_more_seeds_and_shorter_ways(spark, tmp_path):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "e")], "src string, dst string")
    path = f"file://{tmp_path}/crawl"
    QU.submit(spark.createDataFrame([("a",)], "url string"), path, "first")
    query = QU.follow(spark, QU.by_edges(edges, 2), path)
    try:
        query.processAllAvailable()
        QU.submit(spark.createDataFrame([("c",), (None,)], "url string"), path, "second")
        query.processAllAvailable()
    finally:
        query.stop()
    # c was two links away at first and led nowhere.
    assert sorted(map(tuple, QU.read_jobs(spark, path).collect())) == [(0, "a"), (0, "c"), (1, "b"), (1, "d"), (2, "e")]


def test_queue_fetches_and_stores_pages(spark, tmp_path):
    page = "<base href=http://h/x/><title>{0}</title><meta name=title content={0}><a href={1}><a href=../{2}><a href=mailto:x>"
    pages = spark.createDataFrame(
        [("http://h/a", page.format("a", "b", "c")), ("http://h/x/b", page.format("b", "../a", "gone"))], "url string, html string"
    )
    seeds = spark.createDataFrame([("http://h/a",)], "url string")
    path = QU.crawl(seeds, lambda path: QU.by_pages(pages, 2, path), path=f"file://{tmp_path}/crawl")
    assert sorted(map(tuple, QU.read_jobs(spark, path).collect())) == [
        (0, "http://h/a"), (1, "http://h/c"), (1, "http://h/x/b"), (2, "http://h/gone"),
    ]
    assert sorted((r.page_url, r.title) for r in page_sink.read_pages(spark, f"{path}/pages").collect()) == [("http://h/a", "a"), ("http://h/x/b", "b")]
