import hashlib
import pathlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from linkloom.llm import align

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = align.ByteLevel(pathlib.Path(A_PATH).read_text(encoding="utf-8")), align.Pieces(pathlib.Path(B_PATH).read_bytes())
DOCS = "doc_id long, text string, n_a string, a_ids string, _align_row string"


def plain(texts):
    """Rows by the definition: cuts where both end, all overlapping pairs, counts over all texts."""
    every, rows = Counter(), []
    for text in texts:
        x = y = []
        if text:
            x, y = A.encode([text])[0], B.encode([text])[0]
            whole = b" " + text.encode()
            if any(b"".join(t.tokens[i] for i in ids) != whole for t, ids in ((A, x), (B, y))):
                x = y = []
        spans = []
        for t, ids in ((A, x), (B, y)):
            at, side = 0, []
            for i in ids:
                side.append((at, at + len(t.tokens[i]), i))
                at += len(t.tokens[i])
            spans.append(side)
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        parts, begin = [], 0
        for cut in cuts:
            parts.append("|".join(",".join(str(i) for s, e, i in side if begin <= s and e <= cut) for side in spans))
            begin = cut
        found = [(i, j) for s, e, i in spans[0] for u, v, j in spans[1] if s < v and u < e]
        every.update(found)
        rows.append((len(x), len(y), len(parts), found, hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""))
    most = {}
    for (_, j), n in every.items():
        most[j] = max(most.get(j, 0), n)
    return [(na, nb, ng, len(f), sum(every[p] == most[p[1]] for p in f), sum(every[p] for p in f), sha) for na, nb, ng, f, sha in rows]


TEXTS = [None, "", " ", "  two  blanks ", "Hello World's <|endoftext|> <s>a</s>", "naïve café 中文 😀👍🏽", "▁under", "\x00\t\n\r ", "é ﬁ ½", "<0x41>", "ab" * 3000]


@pytest.mark.parametrize("table_pairs", [0, 40, 1 << 20])
def test_same_as_definition(spark, table_pairs):
    rng = np.random.default_rng(2)
    texts = TEXTS + [" ".join(rng.choice(["the", "thing", "haing", "über", "42", "x."], 30)) for _ in range(60)]
    texts += texts[:15]
    rows = [(i if i % 9 else None, t, "x", None, "y") for i, t in enumerate(texts)]
    found = align.align(spark.createDataFrame(rows, DOCS).repartition(5), A_PATH, B_PATH, table_pairs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected = [(rows[i][0], *r) for i, r in enumerate(plain(texts))]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_few_held_pairs_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(align, "HELD_PAIRS", 10)
    texts = TEXTS[3:8]
    table = spark.createDataFrame([(i, t, "", "", "") for i, t in enumerate(texts)], DOCS)
    ids = align.encode_both(table, pathlib.Path(A_PATH).read_text(encoding="utf-8"), pathlib.Path(B_PATH).read_bytes())
    total = align.pair_counts(ids, (A.lengths, B.lengths)).groupBy().sum("n").collect()[0][0]
    assert total == sum(r[3] for r in plain(texts))
    assert align.align(table.where("false"), A_PATH, B_PATH).collect() == []
    nothing = align.align(table.where("doc_id < 0").union(spark.createDataFrame([(1, None, "", "", "")], DOCS)), A_PATH, B_PATH).collect()
    assert [tuple(r) for r in nothing] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_very_long_text(spark):
    text = "Ünter den word! " * 60_000
    (row,) = align.align(spark.createDataFrame([(1, text, "", "", "")], DOCS), A_PATH, B_PATH).collect()
    assert row.n_links == row.n_a + row.n_b - row.n_groups and row.n_a > 60_000


def by_library(text):
    return A.library.encode(" " + text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("abcdest'THLR 019½²ªº.,!?_<|>\t\n\r\x1c\x85\xa0éßÀǅɏ中ʼ")), max_size=60))
def test_merging_by_rank_gives_the_tokens_of_the_library(text):
    assert list(A.encode([text])[0]) == by_library(text)


def test_every_settled_character_and_token_is_encoded_alike():
    for code in range(0x250):
        for text in (f"a{chr(code)}b", f" {chr(code) * 2} ", f"1{chr(code)}1'{chr(code)}s", f"\n{chr(code)}\n {chr(code)}!"):
            assert list(A.by_rank.encode_ordinary(" " + text)) == by_library(text)
    texts = [t.decode() for t in A.tokens if not any(b & 128 for b in t)]
    for text, ids in zip(texts, A.library.encode_batch([" " + t for t in texts], add_special_tokens=False), strict=True):
        assert list(A.by_rank.encode_ordinary(" " + text)) == ids.ids
    for text in ("x" * 3000, " " * 3000, "ab " * 2000, "é" * 999):
        assert list(A.encode([text])[0]) == by_library(text)


lengths = st.lists(st.integers(1, 6), min_size=1, max_size=30)


@settings(max_examples=200, deadline=None)
@given(lengths, lengths)
def test_groups_and_links(a, b):
    gap = sum(a) - sum(b)
    a, b = (a, b + [gap]) if gap > 0 else (a + [-gap], b) if gap < 0 else (a, b)
    x, y = np.array(a), np.array(b)
    group, side, place = align.groups(x, y)
    at, to = align.links(x, y)
    ends = [np.cumsum(x), np.cumsum(y)]
    expected = {(i, j) for i in range(len(x)) for j in range(len(y)) if ends[0][i] - x[i] < ends[1][j] and ends[1][j] - y[j] < ends[0][i]}
    assert set(zip(at.tolist(), to.tolist(), strict=True)) == expected and len(at) == len(expected)
    of = {(int(s), int(p)): int(g) for g, s, p in zip(group, side, place, strict=True)}
    assert len(of) == len(x) + len(y) and all(of[0, i] == of[1, j] for i, j in expected)
    assert max(of.values()) + 1 == len(set(ends[0].tolist()) & set(ends[1].tolist()))
