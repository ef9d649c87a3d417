import numpy as np
import pytest

from linkloom.llm import quality

DOCS = "doc_id long, text string, quality int, score double"


def plain_features(text):
    """Words, marks for repeated words, and n-grams with a blank for the edges, by plain loops."""
    found, last = [], None
    m, mix = 0x100000001B3, 0x9E3779B97F4A7C15

    def bucket(h, kind):
        return (((h + kind) * mix) % (1 << 64)) >> (64 - quality.BITS)

    for word in text.encode().split():
        found.append(bucket(sum(b * m**i for i, b in enumerate(word)) % (1 << 64), 1))
        if word == last:
            found += [bucket(k, 2) for k in range(quality.MARKS)]
        last = word
        edged = b" " + word + b" "
        for n in quality.GRAMS:
            for i in range(len(edged) - n + 1):
                h = 0
                for b in edged[i : i + n]:
                    h = (h * m + b) % (1 << 64)
                found.append(bucket(h, n))
    return sorted(found)


@pytest.mark.parametrize("text", ["", "  ", "a", "ab ab  cd", "é&&& x\n\nlonger words, here here here", "tail "])
def test_features(text):
    found = np.concatenate([np.empty(0, int), *quality.features(text)]).tolist()
    assert sorted(found) == plain_features(text)


def test_compiled_score_is_the_softmax():
    model = quality.Classifier()
    rng = np.random.default_rng(0)
    model.layer[:] = rng.normal(size=model.layer.shape)
    model.bias[:] = [0.2, -0.1]
    text = "some words and some more words"
    ids = np.concatenate(list(quality.features(text)))
    z = model.vectors[ids].mean(axis=0) @ model.layer + model.bias
    assert quality.score(model.compiled(), text) == pytest.approx(np.exp(z[1]) / np.exp(z).sum(), rel=1e-4)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = [r for r in quality.predict_quality(docs, labels).collect() if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in found) / len(found) > 0.95
    assert all(r.predicted == (r.score >= 0.3) for r in found)


def test_rows_of_any_kind(spark):
    good, bad = "plain words in a row here", "bad&&& bad&&& $$$ $$$"
    rows = [(i, good if i % 2 else bad, 0, 0.0) for i in range(60)]
    rows += [(100, None, 0, 0.0), (101, "", 0, 0.0), (None, good, 0, 0.0), (102, good + " more" * 50_000, None, None), (1, good, 0, 0.0)]
    docs = spark.createDataFrame(rows, DOCS)
    marks = [(i, i % 2, "x") for i in range(60)] + [(None, 1, "x"), (101, None, "x"), (102, 7, "x"), (1, 1, "x")]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, text string")
    found = quality.predict_quality(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert {r.predicted for r in found if r.doc_id is not None and r.doc_id < 60 and r.doc_id % 2} == {1}
    assert {r.predicted for r in found if r.doc_id is not None and r.doc_id < 60 and not r.doc_id % 2} == {0}
    none = quality.predict_quality(docs, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.predict_quality(docs.where("false"), labels).collect() == []
