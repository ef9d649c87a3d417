import zlib

import numpy as np

from linkloom.llm import langid

SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string"


def test_windows_hold_whole_texts():
    texts = [b"", b"a", b"x" * langid.WINDOW, b"y" * (2 * langid.WINDOW + 5)]
    x, owner, sizes = langid.windows_of(texts)
    assert owner.tolist() == [1, 2, 3, 3, 3] and sizes.tolist() == [1, 128, 128, 128, 5]
    assert b"".join(bytes(r[:n]) for r, n in zip(x, sizes, strict=True)) == b"".join(texts)


def test_fast_responses_equal_plain_ones():
    network = langid.ByteNetwork(["a", "b"])
    x = np.random.default_rng(0).integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    pooled = []
    for w in langid.WIDTHS:
        at = x.shape[1] - w + 1
        pooled.append(sum(network.tables[w][k][x[:, k : k + at]] for k in range(w)).max(axis=1))
    expected = langid.softmax(np.maximum(np.concatenate(pooled, 1), 0) @ network.out + network.bias)
    assert np.allclose(network.probabilities(x), expected, atol=1e-5)


def test_gradients_match_differences():
    network = langid.ByteNetwork(["a", "b", "c"])
    x = np.random.default_rng(1).integers(97, 110, (6, 20)).astype(np.uint8)
    y = np.array([0, 1, 2, 0, 1, 2])

    def loss():
        network.__dict__.pop("_pair_tables", None)
        return -np.log(network.probabilities(x)[np.arange(6), y].astype(np.float64)).mean()

    gradients = network._gradients(x, y)
    for values, gradient in ((network.out, gradients[-2]), (network.bias, gradients[-1])):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        before, step = values[at], 1e-2
        values[at] = before + step
        up = loss()
        values[at] = before - step
        assert abs((up - loss()) / (2 * step) - gradient[at]) < 1e-2 * abs(gradient[at]) + 1e-4
        values[at] = before


def test_held_out_accuracy(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    langs = {r.doc_id: r.lang for r in docs.collect()}
    found = langid.predict_languages(docs).collect()
    assert len(found) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.95


def test_rows_of_any_kind(spark):
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 3, "en" if i % 2 else "de", "x", "x") for i in range(40)]
    rows += [(100, None, "en", "x", "x"), (101, "12 34 --", None, "x", "x"), (None, "the cat", "en", "x", "x"), (102, "", "de", "x", "x"), (103, "und die " * 60_000, None, "x", "x"), (103, "der hund", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {(r.doc_id, r.score > 0): r.lang_pred for r in langid.predict_languages(df).collect() if r.doc_id is None or r.doc_id >= 100}
    assert found == {(100, False): "und", (101, False): "und", (None, True): "en", (102, False): "und", (103, True): "de"}
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == 43
    none = langid.predict_languages(spark.createDataFrame([(1, "a b", None, "", "")], SCHEMA)).collect()
    assert [tuple(r) for r in none] == [(1, False, "und", 0.0)]
    assert langid.predict_languages(spark.createDataFrame([], SCHEMA)).collect() == []
    assert langid.keep_identified(spark.createDataFrame([(1, "a b", None, "", ""), (2, "1", None, "", "")], SCHEMA)).count() == 1
