import hashlib
import re

import numpy as np

from linkloom.llm import exact

SCHEMA = "doc_id long, text string, fp string, sha long, _norm string"


def plain(rows):
    norm = [re.sub("[\x20\x09-\x0d]+", " ", r[1] or "") for r in rows]
    out = []
    for r, n in zip(rows, norm, strict=True):
        ids = [x[0] for x, m in zip(rows, norm, strict=True) if m == n]
        known = [i for i in ids if i is not None]
        out.append((r[0], min(known, default=None), len(ids), hashlib.sha256(n.encode()).hexdigest()))
    return out


def test_against_plain_version(spark):
    rows = [(4, "a  b", "", 0, ""), (2, "a\tb", "", 0, ""), (9, "a b ", "", 0, ""), (1, None, "", 0, ""), (3, "", None, None, None),
            (5, " ", "", 0, ""), (6, "\n\x0b", "", 0, ""), (None, "a b", "", 0, ""), (8, "é" * 50_000, "", 0, ""), (2, "a b", "", 0, ""), (None, "alone", "", 0, "")]
    found = exact.exact_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    key = lambda r: (str(r[0]), str(r[1]), r[2], r[3])
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=key)
    assert got == sorted(plain(rows), key=key)
    for sha in {r.text_sha256 for r in found}:
        kept = [r for r in found if r.text_sha256 == sha and r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id
    stays = exact.keep_first(spark.createDataFrame(rows, SCHEMA))
    assert stays.columns == ["doc_id", "text", "fp", "sha", "_norm"]
    assert sorted(str(r.doc_id) for r in stays.collect()) == sorted(str(r.doc_id) for r in found if r.kept)


def test_filters_merge_without_loss(spark):
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 50, 3000).tolist() + rng.integers(-(1 << 62), 1 << 62, 500).tolist()
    df = spark.createDataFrame([(int(p),) for p in prints], "fp long").repartition(5)
    counts = dict(zip(*np.unique(prints, return_counts=True), strict=True))
    expected = {int(p): int(n) for p, n in counts.items() if n > 1}
    for rows in (10, 200_000):  # one block, several blocks
        assert {r.fp: r.n for r in exact.repeated(df, rows).collect()} == expected


def test_merge_sorted_adds_counts():
    remainders, counts = exact.merge_sorted(np.array([1, 5, 5, 1, 9], np.uint64), np.array([1, 2, 3, 4, 5]))
    assert remainders.tolist() == [1, 5, 9] and counts.tolist() == [5, 5, 5]


def test_empty_table(spark):
    assert exact.exact_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
