import numpy as np

from linkloom.llm import toxicity

DOCS = "doc_id long, text string, toxic int, evidence string"


def test_index_is_exact():
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(400):
        terms = np.sort(rng.choice(30, rng.integers(1, 6), replace=False))
        w = rng.random(len(terms)) + 0.1
        vectors.append((terms, w / np.sqrt((w * w).sum())))
    index = toxicity.BlockMaxIndex(np.arange(400), vectors, np.zeros(400), np.ones(400), 30)
    dense = np.zeros((400, 30))
    for i, (terms, w) in enumerate(vectors):
        dense[i, terms] = w
    for i in range(0, 400, 7):
        terms, w = vectors[i]
        sims = dense[:, terms] @ w
        sims[i] = 0
        order = np.lexsort((np.arange(400), -np.round(sims, 12)))
        expected = [j for j in order if sims[j] > 0][:10]
        rows, found = index.search(terms, w, skip=i)
        assert rows.tolist() == expected and np.allclose(found, sims[expected])


def test_near_copies_are_one_family():
    rng = np.random.default_rng(0)
    texts = [[f"w{i}" for i in rng.integers(0, 3000, 200)] for _ in range(60)]
    copies = [sorted({*texts[0][:190], f"x{i}"}) for i in range(12)]
    bags = [sorted(set(t)) for t in texts] + copies
    family = toxicity.families(bags)
    assert len(set(family[60:].tolist())) <= 2
    assert len(set(family[:60].tolist())) >= 58


def test_finds_held_out_toxic_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    clean = [d for d, t in truth.items() if t == 0]
    assert sum(rows[d].predicted for d in clean) / len(clean) < 0.01
    insults = {"moron", "idiot", "scum", "trash"}  # words of the generator
    for r in docs.collect():
        hit = insults & set(toxicity.words(r.text))
        if len(hit) >= 2:
            assert rows[r.doc_id].predicted == 1 and rows[r.doc_id].evidence


def test_rows_of_any_kind(spark):
    rng = np.random.default_rng(2)

    def prose():
        return " ".join(f"w{'abcdefghij'[i]}" for i in rng.integers(0, 10, 30))

    rows = [(i, prose() + (" vile nasty" if i % 3 == 0 else ""), 0, "x") for i in range(150)]
    rows += [(200, None, 0, "x"), (201, "", 0, "x"), (None, "vile nasty", 0, "x"), (202, "wa " * 60_000 + "NASTY vile", 0, "x"), (3, rows[3][1], None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 == 0), "x") for i in range(150)] + [(None, 1, "x"), (200, None, "x"), (201, 5, "x")], "doc_id long, toxic int, text string")
    found = toxicity.score_toxicity(docs, labels).collect()
    assert len(found) == len(rows)
    assert all(r.predicted == int(r.doc_id is None or r.doc_id == 202 or (r.doc_id < 150 and r.doc_id % 3 == 0)) for r in found)
    assert {r.score for r in toxicity.score_toxicity(docs, labels.where("false")).collect()} == {0.0}
    assert toxicity.score_toxicity(docs.where("false"), labels).collect() == []


def test_copy_of_a_toxic_example_without_frequent_insults_is_toxic(spark):
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    lexicon = ["".join(rng.choice(letters, 7)) for _ in range(400)]

    def prose(n):
        return " ".join(lexicon[i] for i in rng.integers(0, 400, n))

    # Each toxic document has an insult of its own, so no word is associated with the class.
    rows = [(i, prose(40) + (" " + "".join(rng.choice(letters, 9)) if i % 5 == 0 else ""), 0, "x") for i in range(300)]
    copies = [(1000 + i, rows[i][1], 0, "x") for i in range(0, 300, 5)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0), "x") for i in range(300)], "doc_id long, toxic int, text string")
    found = {r.doc_id: r for r in toxicity.score_toxicity(spark.createDataFrame(rows + copies, DOCS), labels).collect()}
    learned = [i for i in range(0, 300, 5) if not found[i].held_out]
    assert len(learned) > 30
    for i in learned:
        nearest = found[1000 + i].evidence[0]
        assert (nearest.doc_id, nearest.toxic, round(nearest.similarity, 9)) == (i, 1, 1.0)
        assert found[1000 + i].predicted == 1
    assert not any(found[i].predicted for i in range(300) if i % 5)


def test_index_is_exact_with_columns_and_blocks():
    rng = np.random.default_rng(5)
    p = 1 / np.arange(2, 302)
    dense = np.where(rng.random((700, 300)) < p * 2, rng.random((700, 300)) + 0.1, 0)
    dense[:, 299] += 0.01
    dense /= np.sqrt((dense * dense).sum(axis=1, keepdims=True))
    vectors = [(np.flatnonzero(v), v[v > 0]) for v in dense]
    index = toxicity.BlockMaxIndex(np.arange(700), vectors, np.zeros(700), np.ones(700), 300)
    assert 0 < len(index.columns) < 300
    for i in range(0, 700, 11):
        sims = dense @ dense[i]
        sims[i] = 0
        expected = np.lexsort((np.arange(700), -np.round(sims, 12)))[:10]
        rows, found = index.search(*vectors[i], skip=i)
        assert rows.tolist() == expected.tolist() and np.allclose(found, sims[expected])


def test_sample_is_not_cut_for_memory():
    assert toxicity.PER_CLASS >= 1500
