import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from linkloom.llm import pitman_yor as lm

SCHEMA = "doc_id long, text string, w string, score string, rest string"


def plain_tokens(text):
    words = (text or "").encode().lower().split()
    return list(zip([*words, b"</s>"], [b"<s>", *words], strict=True))


@pytest.mark.parametrize("piece", [40, 1 << 20])
def test_tokens(monkeypatch, piece):
    monkeypatch.setattr(lm, "PIECE_BYTES", piece)
    texts = [None, "", " ", "A b\x0bc", "ñandú " * 30, "one", "x" * 200 + " y", "", "last words here"]
    found = [(o, h) for a, b in lm.tokens(texts) for o, h in zip(a.tolist(), b.tolist(), strict=True)]
    expected = [(i, w) for i, t in enumerate(texts) for w, _ in plain_tokens(t)]
    assert [o for o, _ in found] == [i for i, _ in expected]
    names = dict(zip([h for _, h in found], [w for _, w in expected], strict=True))
    assert [names[h] for _, h in found] == [w for _, w in expected]
    assert len(names) == len(set(names.values())) and names[lm.END] == b"</s>"


@pytest.mark.parametrize("x", [[], [0], [0, 0, 255, 256], [1 << 62, 3, (1 << 63) + 5, (1 << 64) - 1, 0, 1 << 61]])
def test_numbers_in_planes(x):
    x = np.array(x, np.uint64)
    assert lm._unplaned(lm._planes(x), np.uint64).tolist() == x.tolist()
    assert len(lm._planes(np.full(1000, 7))) == 1016


def test_table_counts_follow_the_conditional():
    """Against the distribution found by listing all seatings of a few customers."""
    d, mass, c = 0.4, 0.7, 6
    weight = np.zeros(c + 1)

    def seat(k, sizes, w):
        if k == c:
            weight[len(sizes)] += w
            return
        seat(k + 1, [*sizes, 1], w * mass)
        for i, n in enumerate(sizes):
            seat(k + 1, [*sizes[:i], n + 1, *sizes[i + 1 :]], w * (n - d))

    seat(1, [1], mass)
    drawn = lm.draw_tables(np.full(40_000, c), np.full(40_000, mass), d, np.random.default_rng(0))
    assert np.allclose(np.bincount(drawn, minlength=c + 1) / 40_000, weight / weight.sum(), atol=0.01)


@pytest.mark.parametrize("mass", [0.2, 3.0])
def test_many_customers_continue_few(mass):
    rng = np.random.default_rng(1)
    few, many = (lm.draw_tables(np.full(20_000, c), np.full(20_000, mass), 0.6, rng).mean() for c in (lm.EXACT, lm.EXACT + 1))
    assert few == pytest.approx(many, rel=0.05)


def test_likelihood_of_a_seating():
    """Against the product of the probabilities of seating customers one after the other, all arrangements summed."""
    planes = {x: lm._planes(np.array(v)) for x, v in {"u": [7, 9], "k": [2, 1], "words": [1, 2], "word": [0, 1, 0], "c": [3, 1, 2]}.items()}
    cells = lm.Part({"part": 0, "refs": [], **planes})
    deal = lm.Deal(lm.Codes(np.empty(0, np.uint64), np.empty(0, np.int64)), 1, 6)
    parent = lm.Parent(5, (0.5, 0.5), 2.0, [1], [1])
    found = lm._fit(cells, np.array([2, 1, 1]), parent, deal)

    def exact(theta, d):
        # Context 7: word 1 has tables of 2 and 1 (three ways), word 2 one; context 9: one table of two.
        first = (theta + d) * (theta + 2 * d) * 3 * (1 - d) / ((theta + 1) * (theta + 2) * (theta + 3))
        return np.log(first * (1 - d) / (theta + 1))

    n = len(lm.DISCOUNTS)
    assert np.allclose(np.diff(found[:n]), np.diff([exact(2.0, d) for d in lm.DISCOUNTS]))
    assert np.allclose(np.diff(found[n:]), np.diff([exact(x, 0.5) for x in lm.STRENGTHS]))


def docs_of(rng, n):
    names = [f"w{i}" for i in range(60)]
    return [(i, " ".join(names[min(int(rng.pareto(1.0)), 59)] for _ in range(int(rng.integers(0, 60)))), "x", "x", "x") for i in range(n)]


def small(monkeypatch, table, part, chunk):
    monkeypatch.setattr(lm, "TABLE_WORDS", table)
    monkeypatch.setattr(lm, "PART_TOKENS", part)
    monkeypatch.setattr(lm, "CHUNK_TOKENS", chunk)


SIZES = pytest.mark.parametrize("sizes", [(lm.TABLE_WORDS, lm.PART_TOKENS, lm.CHUNK_TOKENS), (20, 300, 100), (0, 500, 1)])


@SIZES
def test_counts_and_base(spark, monkeypatch, sizes):
    small(monkeypatch, *sizes)
    rows = docs_of(np.random.default_rng(2), 60) + [(900, None, "", "", ""), (901, "", "", "", ""), (None, "w1 newword", "", "", ""), (902, "w1 " * 50_000, None, None, None), (3, "w1", "", "", "")]
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows}
    count = Counter(w for i, t, *_ in rows if i is not None and not held[i] for w, _ in plain_tokens(t))
    n, v = sum(count.values()), len(count)
    found = lm.score_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    by = {(r.doc_id, r.n_tokens): r for r in found}
    for i, text, *_ in rows:
        own = plain_tokens(text)
        r = by[i, len(own)]
        assert (r.held_out, r.n_known, r.train_tokens) == (held[i], sum(count[w] > 0 for w, _ in own), n)
        assert r.base_score == pytest.approx(sum(log10((count[w] + 1) / (n + v + 1)) for w, _ in own), rel=1e-9)
        assert r.score < 0


@SIZES
def test_scores_follow_from_the_seating(spark, monkeypatch, sizes):
    """Every score, and sums of probabilities, from counts made here and the stored tables."""
    small(monkeypatch, *sizes)
    rows = docs_of(np.random.default_rng(3), 120)
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id long, text string").repartition(4)
    lm.common.prepare(spark)
    learned = docs.selectExpr("doc_id", "doc_id % 5 = 0 as held_out", "doc_id % 5 <> 0 as learned", "monotonically_increasing_id() as _row_id", "text")
    words, counts = lm.counted_words(docs.where("doc_id % 5 <> 0"))
    codes, tables = lm._frequent(words), lm.Tables(spark)
    stored = lm.chunks(learned, codes, tables)
    model = lm.train(stored, counts, codes, tables)
    cells = [lm.Part(r.asDict(recursive=True)) for r in model.cells.collect()]
    assert sizes[1] > 1000 or len(cells) > 2
    assert len(model.deal.busy) > 0 or sizes[0] != 20  # contexts dealt by word are words of the table
    answers, swept = [r.asDict() for r in lm._right(model.roots, model.swept).collect()], {}
    customers, tables_of, opened, above = {}, Counter(), {}, {}
    for part in cells:
        mine = [r for r in answers if r["part"] == part.part]
        rc, rt = part.received([r for r in mine if r["share"] >= 0], model.deal)
        above.update((int(w), (rc[:, i], rt[:, i])) for i, w in enumerate(part.words))
        state = next(r for r in mine if r["share"] < 0)
        t = lm._unplaned(state["rc"])
        by = lm._unplaned(state["rt"]).reshape(lm.SAMPLES, -1)
        for i, u in enumerate(part.u.tolist()):
            opened[u] = opened.get(u, 0) + by[:, i]
        for k, u in enumerate(part.u[part.context].tolist()):
            key = u, int(part.words[part.word[k]])
            assert key not in customers
            customers[key], swept[key] = int(part.c[k]), int(t[k])
            assert (part.c[k] > 0) <= (t[k] >= lm.SAMPLES) and t[k] <= lm.SAMPLES * part.c[k]
            tables_of[key[1]] += int(t[k])
    assert all(tables_of[w] == rc[:-1].sum() for w, (rc, _) in above.items())
    assert sum(sum(x) for x in opened.values()) == sum(swept.values())

    def code(word):
        h = lm._words(b" " + word + b" ")[1] if word != b"</s>" else np.array([lm.END], np.uint64)
        return int(lm.BEGIN) if word == b"<s>" else int(codes.of(h)[0])

    plain = Counter((code(u), code(w)) for i, t, *_ in rows if i % 5 for w, u in plain_tokens(t))
    assert plain == {k: c for k, c in customers.items() if c}
    totals, (d, d0), strength = Counter(), model.parent.discounts, model.parent.strength
    for (u, _), c in plain.items():
        totals[u] += c
    v = len({w for _, w in plain})

    def probability(u, w):
        p = 0.0
        for s in range(lm.SAMPLES):
            rc, rt = (x[s] for x in above[w]) if w in above else (0, 0)
            root_c, root_t = (sum(x[k][s] for x in above.values()) for k in (0, 1))
            parent = (rc - d0 * rt + (lm.STRENGTH + d0 * root_t) / (v + 1)) / (lm.STRENGTH + root_c)
            most = opened[u][s] if u in opened else 0
            p += (strength + d * most) / (strength + totals[u]) * parent / lm.SAMPLES
        return p + (customers.get((u, w), 0) - d * swept.get((u, w), 0) / lm.SAMPLES) / (strength + totals[u])

    found = {r.doc_id: r.score for r in lm.score(stored, model, codes).collect()}
    for i, t, *_ in rows[::6]:
        assert found[i] == pytest.approx(sum(log10(probability(code(u), code(w))) for w, u in plain_tokens(t)), rel=1e-6)
    vocabulary = sorted({w for _, w in plain})
    for u in [code(b"<s>"), code(b"w0"), code(b"w9"), 12345678]:
        unknown = next((w for w in above if w not in vocabulary), 99)
        assert sum(probability(u, w) for w in [*vocabulary, unknown]) == pytest.approx(1, abs=1e-9)
    tables.forget()


def test_word_order_counts(spark):
    """Below what a plain interpolated model of word pairs reaches on the same texts."""
    found = lm.score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    held = [r for r in found if r.held_out]
    perplexity = 10 ** (-sum(r.score for r in held) / sum(r.n_tokens for r in held))
    print(perplexity)
    assert perplexity < 2_950, perplexity


def test_clashing_and_extra_columns(spark):
    rows = [(i, f"a b c{i}", 7, "x", "y", 1) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, _row_id int, learned string, chunk string, n int")
    plain = lm.score_documents(docs.select("doc_id", "text")).collect()
    assert sorted(lm.score_documents(docs).collect()) == sorted(plain)


def test_no_rows(spark):
    assert lm.score_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = lm.score_documents(spark.createDataFrame([(None, "a b", "", "", "")], SCHEMA)).collect()
    assert [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in alone] == [(None, False, 3, 0, 0, 0.0, 0.0)]
