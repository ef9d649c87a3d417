import pytest

from linkloom.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string, taken int"


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        rate = left / open_weight if open_weight else 0
        over = {s for s in names if s not in full and rate * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else rate * weight[s] for s in names}
        full |= over


def plain_quotas(weights, seats):
    got = [0] * len(weights)
    for _ in range(seats):
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


@pytest.mark.parametrize("weights,seats", [([5.0, 3.0, 1.0], 7), ([1.0] * 5, 3), ([10.0, 0.1, 0.1, 0.1], 4), ([2.0, 0.0], 5), ([1.0, 1.0], 0)])
def test_highest_quotients(spark, weights, seats):
    cells = spark.createDataFrame([(i, w) for i, w in enumerate(weights)], "k int, weight double")
    found = {r.k: r.quota for r in mixing.apportion(cells, seats, ["k"]).collect()}
    assert [found[i] for i in range(len(weights))] == plain_quotas(weights, seats)


def test_targets_and_takes(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = mixing.mix(docs).collect()
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    sizes, taken = {}, {}
    for r in rows:
        s = source[r.doc_id]
        sizes[s], taken[s] = sizes.get(s, 0) + r.size, taken.get(s, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    targets = plain_targets(sizes)
    for r in rows:
        assert r.target == pytest.approx(targets[source[r.doc_id]], rel=1e-12) and r.source_size == sizes[source[r.doc_id]]
    for s, target in targets.items():
        assert taken[s] == pytest.approx(target, rel=0.01)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()))


def test_hot_source_over_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 200)
    rows = [(i, "hot", "w " * (i % 7), "", 0) for i in range(600)] + [(i, f"s{i % 3}", "w " * 5, "", 0) for i in range(600, 700)]
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    for source, low, high in (("hot", 0, 600),):
        target = next(r.target for r in found if r.doc_id == low)
        assert sum(r.taken for r in found if r.doc_id < high) == pytest.approx(target, rel=0.02)


def test_rows_of_any_kind(spark):
    rows = [(1, "a", "x y", "", 0), (1, "a", "x y", "", 0), (None, "b", "q", None, None), (3, None, "w " * 7, "", 0), (4, "b", None, "", 0)]
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.size, r.source_size, r.target) for r in found) == [(0, 1, 1, 2.0), (1, 2, 4, 8.0), (1, 2, 4, 8.0), (3, 7, 7, 8.0), (4, 0, 1, 2.0)]
    out = mixing.mixed(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "source", "text", "size", "taken"]
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 0, 1, 1, 1, 1, 3]
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = mixing.mix(spark.createDataFrame([(1, None, None, "", 0)], SCHEMA)).collect()
    assert [tuple(r) for r in alone] == [(1, 0, 0, 0.0, 0)]


def test_long_documents_are_kept_in_their_share_of_seeds(spark):
    # The long one is near half of a source whose target is a sixth of it: no run of blocks covers half of it.
    rows = [(0, "b", "w " * 9_000, "", 0)] + [(i, "b", "w " * 100, "", 0) for i in range(1, 101)]
    rows += [(1_000 + i, "a", "w " * 500, "", 0) for i in range(9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept, part = 0, 0.0
    for seed in range(12):
        taken = {r.doc_id: r for r in mixing.mix(docs, weights=(30, 1), share=0.5, seed=seed).collect()}
        out = [r.doc_id for r in mixing.mixed(docs, weights=(30, 1), share=0.5, seed=seed).collect()]
        kept, part = kept + out.count(0), part + taken[0].taken / taken[0]["size"]
        for i, r in taken.items():
            assert abs(out.count(i) - r.taken / r["size"]) < 1
        for source in (range(101), range(1_000, 1_009)):
            whole = sum(taken[i].taken / taken[i]["size"] for i in source)
            assert abs(sum(out.count(i) for i in source) - whole) < 1 + 1e-9
    assert part > 0.4 and abs(kept - part) < 3


def test_stages_keep_columns_of_any_name(spark):
    from linkloom.llm import exact, simhash

    names = ["_row_id", "_ROW_ID_", "_simhash", "_copy", "_copies", "_stays", "copies", "fp", "taken"]
    rows = [(i, "a", f"text number {i} {'w' * i}", *[f"{n}{i}" for n in names]) for i in range(6)]
    docs = spark.createDataFrame(rows + rows[:2], ["doc_id", "source", "text", *names])
    for stage in (exact.keep_first, simhash.keep_one):
        out = stage(docs)
        assert out.columns == docs.columns and set(map(tuple, out.collect())) <= set(rows)
    assert sorted(map(tuple, exact.keep_first(docs).collect())) == sorted(rows)
    assert set(map(tuple, mixing.mixed(docs, share=2.0).collect())) == set(rows)
    for stage in (exact.keep_first, simhash.keep_one, mixing.mixed):
        assert stage(docs.where("false")).collect() == []
