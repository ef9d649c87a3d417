import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from linkloom import session
from linkloom.functions import times as T
from linkloom.operators import graph as G
from linkloom.operators import pages as P
from linkloom.operators import records as R
from linkloom.operators import report as RP
from linkloom.schemas import JOB, PAGE_WIDTHS
from linkloom.sinks import links as link_sink
from linkloom.sinks import pages as page_sink
from linkloom.sinks import series as series_sink
from linkloom.sources import pages as page_reader


OFFER = "id int, url string, html string"


def offers(spark, rows):
    return spark.createDataFrame([(t, url, f"<meta name=title content={title}>") for url, t, title in rows], OFFER)


def test_first_write_wins(spark, tmp_path):
    path = f"file://{tmp_path}/pages"
    page_sink.store_pages(offers(spark, [("u1", 0, "old")]), ["id"], path, 0)
    new = offers(spark, [("u1", 1, "new"), ("u2", 3, "late"), ("u2", 2, "early")])
    for _ in range(2):
        page_sink.store_pages(new, ["id"], path, 1)
        got = [(r.page_url, r.title) for r in page_sink.read_pages(spark, path).collect()]
        assert sorted(got) == [("u1", "old"), ("u2", "early")]
    page_sink.store_pages(new, ["id"], path, 2)
    assert page_sink.read_pages(spark, path).count() == 2


def test_targets_have_their_own_keys(spark, tmp_path):
    path = f"file://{tmp_path}/pages"
    rows = offers(spark, [("u1", 0, "a"), ("u1", 1, "b"), ("u1", 2, "c")]).withColumn(
        "database", F.when(F.col("id") == 1, "y").otherwise("x")
    )
    page_sink.store_pages(rows, ["id"], path, 0, ["database"])
    page_sink.store_pages(rows, ["id"], path, 1, ["database"])
    got = {(r.database, r.page_url, r.title) for r in page_sink.read_pages(spark, path, ["database"]).collect()}
    assert got == {("x", "u1", "a"), ("y", "u1", "b")}


def test_release_deletes_only_this_run(spark, tmp_path):
    kept = spark.range(3)
    kept.write.parquet(f"file://{tmp_path}/kept")
    stored = session.materialize(kept, "x")
    assert stored.count() == 3
    session.release(spark)
    assert spark.read.parquet(f"file://{tmp_path}/kept").count() == 3
    with pytest.raises(AnalysisException):
        spark.read.parquet(stored.inputFiles()[0]).count()


def test_only_keys_of_the_touched_buckets_are_read(spark, tmp_path):
    path = f"file://{tmp_path}/pages"
    page_sink.store_pages(offers(spark, [(f"u{i}", i, "old") for i in range(500)]), ["id"], path, 0)
    offered = page_sink.first_offers(offers(spark, [("u3", 0, "x"), ("new", 1, "y")]), ["id"])
    known = page_sink.known_keys(offered, path, 1)
    folders = {f.rpartition("/")[0].rpartition("/")[2] for f in known.inputFiles()}
    assert len(list((tmp_path / "pages" / "_keys").glob("bucket=*"))) > 40
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert "ReadSchema: struct<url:string,batch_id:bigint>" in plan
    rows = known.collect()
    buckets = {r.bucket for r in offered.select(page_sink._bucket(F.col("url"))).collect()}
    assert folders <= {f"bucket={n}" for n in range(page_sink.KEY_BUCKETS)} and len(buckets) == 2
    assert {r.url for r in rows} == {f"u{i}" for i in range(500)} & {
        r.url for r in spark.read.parquet(f"{path}/_keys").where(F.col("bucket").isin(*buckets)).collect()
    }
    assert [r.url for r in page_sink.unknown(offered, known).collect()] == ["new"]


def test_long_urls_and_texts_are_stored_whole(spark, tmp_path):
    html = f"<meta name=title content={'t' * 200}><body>b"
    pages = spark.createDataFrame([(1, "u" * 80 + "1", html), (2, "u" * 80 + "2", html)], OFFER)
    page_sink.store_pages(pages, ["id"], f"file://{tmp_path}/whole", 0)
    rows = page_sink.read_pages(spark, f"file://{tmp_path}/whole").collect()
    assert sorted(r.page_url for r in rows) == ["u" * 80 + "1", "u" * 80 + "2"]
    assert {len(r.title) for r in rows} == {200}
    page_sink.store_pages(pages, ["id"], f"file://{tmp_path}/cut", 0, widths=PAGE_WIDTHS)
    rows = page_sink.read_pages(spark, f"file://{tmp_path}/cut").collect()
    assert {(len(r.page_url), len(r.title)) for r in rows} == {(81, 100)}


def test_targets_named_by_digits_stay_text(spark, tmp_path):
    path = f"file://{tmp_path}/pages"
    pages = spark.createDataFrame([(1, "u", "<body>b"), (2, "u", "<body>c"), (3, None, "<body>d")], OFFER)
    for batch_id in range(2):
        page_sink.store_pages(pages.withColumn("database", F.lit("01")), ["id"], path, batch_id, ["database"])
    assert [(r.database, r.page_url, r.body_text) for r in page_sink.read_pages(spark, path, ["database"]).collect()] == [("01", "u", "b")]


def test_only_winners_are_parsed(spark):
    pages = spark.createDataFrame([(1, "u", "<body>b"), (2, "u", "<body>c")], OFFER)
    won = page_sink.offered_pages(pages, page_sink.first_offers(pages, ["id"]), ["id"])
    parsed = page_sink.page_rows(P.parse(won, ["url"]))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan[plan.index("LeftSemi") :].lower()


def test_nothing_stored_yet_is_an_empty_table(spark, tmp_path):
    assert page_sink.read_pages(spark, f"file://{tmp_path}/none").collect() == []


def test_clip_columns(spark):
    row = spark.createDataFrame([("t" * 200, "k")], "title string, other string")
    clipped = R.clip_columns(row).first()
    assert (len(clipped.title), clipped.other) == (100, "k")


def test_archive_and_packages(spark):
    jobs = spark.createDataFrame(
        [("http://a/", 2, "<b>Hi</b>"), ("http://gone/", 1, None)], "url string, link_depth int, html string"
    )
    clock = T.format_time(F.lit("2011-03-05 04:06:07").cast("timestamp"), padded=False)
    rows = page_sink.archive(jobs, clock, "p").collect()
    assert len(rows) == 1 and rows[0].archive_id.startswith("p_")
    assert rows[0].content == (
        "<!-- url: http://a/ --><!-- timestamp: 5/3/2011 4:6:7 --><!-- linkDepth: 2 --><b>Hi</b>"
    )
    parsed = P.parse(
        spark.createDataFrame([(1, "<meta name=title content='\"é\\'><a href=x>"), (2, None)], "id int, html string"), ["id"]
    )
    back = page_sink.from_packages(page_sink.to_packages(parsed, ["id"]), ["id"])
    assert sorted(back.collect()) == sorted(parsed.collect())


def test_site_links(spark, tmp_path):
    edges = spark.createDataFrame(
        [
            ("http://www.a.example/1", "https://b.example/x"),
            ("http://www.a.example/2", "https://b.example/y"),
            ("http://c.example/", "http://www.a.example/"),
            ("http://c.example/", "/relative"),
        ],
        "src string, dst string",
    )
    path = f"file://{tmp_path}/links"
    link_sink.add_site_links(link_sink.site_link_rows(edges), path, 0)
    assert {tuple(r) for r in link_sink.read_site_links(spark, path).collect()} == {
        ("www.a", "www_a", "b.example", 2),
        ("c.example", "c_example", "www.a", 1),
    }
    assert link_sink.read_site_links(spark, path, "www.a").count() == 1
    assert tuple(G.hostless(edges).first()) == (1, 4)


def test_site_link_batches_add_up(spark, tmp_path):
    path = f"file://{tmp_path}/links"

    def edges(rows):
        return spark.createDataFrame([(f"http://{a}/", f"http://{b}/") for a, b in rows], "src string, dst string")

    assert link_sink.read_site_links(spark, path).collect() == []
    batches = [[("a", "b"), ("a", "b"), ("c", "a")], [("a", "b")], [("a", "c"), ("c", "a")], [("d", "a")]]
    whole = link_sink.site_link_rows(edges(sum(batches, [])))
    for n in (0, 1, 1, 0, 2):
        link_sink.add_site_links(link_sink.site_link_rows(edges(batches[n])), path, n)
        if n == 2:
            link_sink.merge_site_links(spark, path, 1)
    # Batch 1 is merged by now, batch 2 is not.
    for n in (1, 2, 3):
        link_sink.add_site_links(link_sink.site_link_rows(edges(batches[n])), path, n)
    assert sorted(link_sink.read_site_links(spark, path).collect()) == sorted(whole.collect())
    link_sink.merge_site_links(spark, path, 3)
    link_sink.merge_site_links(spark, path, 2)
    assert session.folders(spark, f"{path}/added") == [] and session.folders(spark, f"{path}/whole") == ["upto=3"]
    assert sorted(link_sink.read_site_links(spark, path).collect()) == sorted(whole.collect())
    assert [r.n_links for r in link_sink.read_site_links(spark, path, "a").orderBy("link_to").collect()] == [3, 1]


def test_scratch_goes_with_its_block(spark):
    with session.scratch(spark):
        stored = session.materialize(spark.range(3), "x")
        with session.scratch(spark):
            inner = session.materialize(spark.range(4), "y")
            assert inner.count() == 4
        assert stored.count() == 3
        with pytest.raises(Exception, match="not exist|No such file|PATH_NOT_FOUND"):
            inner.collect()
    assert not any(f.startswith("scratch") for f in session.folders(spark, session._run_dir(spark)))


def test_link_list_appends(spark, tmp_path):
    path = f"file://{tmp_path}/list"
    links = spark.createDataFrame([("a",), ("b",)], "href string")
    link_sink.append_link_list(links, path)
    link_sink.append_link_list(links, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["a", "a", "b", "b"]


def test_series_files(spark, tmp_path):
    series = spark.createDataFrame([(2, 5), (0, 3), (1, 0)], "bucket bigint, jobs bigint")
    path = f"file://{tmp_path}/s"
    series_sink.write_series(RP.throughput_minutes(series, 30), "time", path)
    lines = [line for f in sorted((tmp_path / "s").glob("part-*")) for line in f.read_text().split()]
    assert lines == ["time,jobs", "0.0,3", "0.5,0", "1.0,5"]
    raw = RP.throughput_seconds(series, 30, "Time (s)", "Throughput (jobs)")
    assert raw.columns == ["Time (s)", "Throughput (jobs)"]


def test_series_report(spark, tmp_path):
    points = spark.createDataFrame(
        [("f{pps}", 2, 7.5), ("f{pps}", 1, 4.0), ("f{threads}", 1, 1.0), ("f{threads}", 2, 2.0)],
        "series string, idx int, value double",
    )
    info = spark.createDataFrame([(1, "b", "2"), (0, "a", "1")], "position int, key string, value string")
    report = RP.series_report(points, info)
    assert [r.line for r in report.orderBy("line_no").collect()] == [
        "a=1",
        "b=2",
        "series0_name=f{pps}",
        "series0_data=4.0,7.5",
        "series1_name=f{threads}",
        "series1_data=1.0,2.0",
    ]
    series_sink.write_report(report, f"file://{tmp_path}/r")
    assert spark.read.text(f"file://{tmp_path}/r").count() == 6


def test_long_series_are_strung_together_from_pieces(spark, monkeypatch):
    monkeypatch.setattr(RP, "PIECE", 7)
    n = 1_000
    points = spark.range(n).selectExpr("if(id % 3 = 0, 'a', 'b') as series", "int(id) as idx", "id * 2 as value").repartition(5)
    lines = [r.line for r in RP.series_report(points).orderBy("line_no").collect()]
    assert lines == [
        "series0_name=a", "series0_data=" + ",".join(str(2 * i) for i in range(0, n, 3)),
        "series1_name=b", "series1_data=" + ",".join(str(2 * i) for i in range(n) if i % 3),
    ]


def test_jobs_and_fetch(spark):
    clock = F.lit("2024-01-01 00:00:00").cast("timestamp")
    jobs = R.build_jobs(spark.createDataFrame([("u1",), ("u2",), ("u1",)], "url string"), 1, clock)
    assert [(f.name, f.dataType) for f in jobs.schema] == [(f.name, f.dataType) for f in JOB]
    pages = spark.createDataFrame([("u1", "<p>"), ("u3", "<q>")], "url string, html string")
    got = page_reader.fetch(jobs, pages)
    assert sorted((r.url, r.html or "") for r in got.collect()) == [("u1", "<p>"), ("u1", "<p>"), ("u2", "")]
    assert R.missing_pages(got, "drop").count() == 2
    assert R.missing_pages(got).count() == 3
    assert R.may_expand(jobs, 1).count() == 0 and R.may_expand(jobs, 2).count() == 3
    with pytest.raises(ValueError):
        R.missing_pages(got, "maybe")
