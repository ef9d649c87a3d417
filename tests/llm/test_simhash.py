from itertools import combinations

import numpy as np
import pytest
import xxhash

from linkloom.llm import simhash

SCHEMA = "doc_id long, text string, fp string, component_id long"


def plain_print(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= 4:
            parent[root(i)] = root(j)
    least = {}
    for i, doc in enumerate(ids):
        known = [d for d in (least.get(root(i)), doc) if d is not None]
        least[root(i)] = min(known, default=None)
    return [least[root(i)] for i in range(len(ids))]


def families(rng, n_families, copies):
    prints = []
    for _ in range(n_families):
        p = int(rng.integers(1 << 63))
        for _ in range(copies):
            prints.append(p)
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                p ^= 1 << int(b)
    return prints


def test_triples_cover_all_fours():
    assert len(simhash.TRIPLES) == 20
    assert all(any(set(t) <= set(four) for t in simhash.TRIPLES) for four in combinations(range(8), 4))


@pytest.mark.parametrize("text", [None, "", " \n", "A b", "a b C d e\x0bf é É", "x " * 300, "one\ttwo three four five"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_print(text)


@pytest.mark.parametrize("limit", [4096, 2])
def test_components_match_all_pairs(spark, limit):
    prints = families(np.random.default_rng(5), 12, 12)
    rows = [(i, int(np.uint64(p).astype(np.int64))) for i, p in enumerate(prints)]
    found = simhash.components(spark.createDataFrame(rows, "doc_id long, fp long"), list_limit=limit)
    found = {r.fp: r.component_id for r in found.collect()}
    assert [found[fp] for _, fp in rows] == plain_components(range(len(prints)), prints)


def test_rows_of_any_kind(spark):
    rows = [(5, None, "x", 1), (3, "", "x", 1), (None, " ", "x", 1), (7, "a b c d e", "x", 1), (7, "a b c d e", "x", 1), (9, "A  b c\nd e", None, None)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or -1, r.fingerprint == "0" * 16, r.component_id) for r in found) == [
        (-1, True, 3), (3, True, 3), (5, True, 3), (7, False, 7), (7, False, 7), (9, False, 7),
    ]
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "fp", "component_id"]
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7]


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    assert simhash.keep_one(spark.createDataFrame([], SCHEMA)).collect() == []
