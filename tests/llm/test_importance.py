import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from linkloom.llm import byte_words, importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, rank string, score string, _neg long, _nth long"


def runs(text, most):
    words = WORD.findall((text or "").translate(UPPER))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, most=1, buckets=10_000, percent=10):
    """(doc_id, n_features, weight, score, rank) by the definition."""

    def counts(texts):
        found = [0] * buckets
        for t in texts:
            for f in runs(t, most)[1]:
                found[zlib.crc32(f.encode()) % buckets] += 1
        return found

    s, t = counts([x for _, x in docs]), counts(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    rows, able = [], []
    for doc_id, text in docs:
        n_words, features = runs(text, most)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in features) // len(features) if features else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n_words >= 20:
                able.append((-score, doc_id, len(rows)))
        rows.append([doc_id, len(features), weight, score, None])
    for rank, (*_, i) in enumerate(sorted(able)[: len(able) * percent // 100], 1):
        rows[i][4] = rank
    return sorted(map(str, rows))


@pytest.mark.parametrize("text", ["", "Ab-cD é9", "中文 ab\x7f\x00c", "{a}[b]`c`", "x" * 100 + " " + "y" * 64, "É ABC ßẞ", "_a_b_"])
def test_words_are_those_of_the_pattern(text):
    words = byte_words.words_of(pa.array([None, text, "", text + "Z"])[1:])
    found = [bytes(words.buffer[a:b]).decode() for a, b in zip(words.starts, words.ends, strict=True)]
    expected = [WORD.findall(t.translate(UPPER)) for t in (text, "", text + "Z")]
    assert found == sum(expected, []) and words.rows.tolist() == [i for i, e in enumerate(expected) for _ in e]
    assert byte_words.crc32(words).tolist() == [zlib.crc32(w.encode()) for w in found]


def test_runs_do_not_cross_texts():
    words = byte_words.words_of(pa.array(["A b-c", "", "d", "e  F"]))
    pairs = byte_words.runs_of(words, 2)
    assert [bytes(pairs.buffer[a:b]).decode() for a, b in zip(pairs.starts, pairs.ends, strict=True)] == ["a b", "b c", "e f"]
    assert pairs.rows.tolist() == [0, 0, 3]
    assert len(byte_words.runs_of(words, 9).rows) == 0


@pytest.mark.parametrize("most", [1, 2])
def test_same_as_definition(spark, most):
    rng = np.random.default_rng(most)
    docs = [(i, " ".join(f"W{w}" for w in rng.zipf(1.4, rng.integers(5, 60)) % 500)) for i in range(400)]
    docs += docs[:30] + [(500, None), (501, ""), (None, docs[0][1]), (-7, "é w1 " * 40_000), (502, "- ." * 50)]
    target = [f"w{i % 9} w{i} w{i + 1}" for i in range(60)] + [None]
    table = spark.createDataFrame([(i, t, "x", "y", 5, 6) for i, t in docs], DOCS).repartition(7)
    found = importance.resample(table, spark.createDataFrame([(t,) for t in target], "text string"), max_run=most, buckets=997)
    assert found.dtypes == [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_features", "weight", "score", "rank")]]
    expected = plain(docs, target, most, 997)
    # Repeated rows have equal keys, so either may hold the rank.
    assert sorted(str([*r]) for r in found.collect()) == expected


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 30, "", "", 0, 0)], DOCS)
    none = spark.createDataFrame([], "text string")
    assert importance.resample(docs.where("false"), none).collect() == []
    assert [r["rank"] for r in importance.resample(docs, none, percent=100).collect()] == [1]
    assert [r["rank"] for r in importance.resample(docs, none).collect()] == [None]


def test_cutoff_is_exact_with_ties_and_uneven_partitions(spark, monkeypatch):
    monkeypatch.setattr(importance, "LARGE", 10)
    rng = np.random.default_rng(0)
    keys = [(int(a), int(b), i) for i, (a, b) in enumerate(zip(rng.integers(0, 6, 700), rng.integers(0, 5, 700), strict=True))]
    table = spark.createDataFrame(keys, "_neg long, _doc long, _nth long").repartition(9, "_neg")
    for wanted in (1, 2, 70, 699, 700):
        assert importance.cutoff(table, wanted) == sorted(keys)[wanted - 1]
    assert importance.cutoff(table, 0) is None


def test_a_round_discards_a_quarter():
    rng = np.random.default_rng(1)
    for _ in range(50):
        parts = [sorted(rng.integers(0, 1000, n).tolist()) for n in rng.integers(1, 80, rng.integers(1, 30))]
        pivot = importance._weighted_median([(p[(len(p) - 1) // 2],) for p in parts], list(map(len, parts)))[0]
        every = np.concatenate(parts)
        assert (every <= pivot).mean() >= 0.25 and (every >= pivot).mean() >= 0.25
