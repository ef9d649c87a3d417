"""Registered queries against their SQL, and the pipeline against plain versions of its stages."""

import duckdb
import pytest

import corpus_pipeline
from linkloom.llm.oracle import ORACLE
from linkloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_small, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "benchmark"):
        con.execute(f"create view {table} as select * from '{sf_small}/{table}.parquet'")
    expected = con.sql(ORACLE[name])
    found = QUERIES[name](spark, sf_small)
    columns = sorted(found.columns)
    assert sorted(expected.columns) == columns
    rows = [tuple(r[c] for c in columns) for r in found.collect()]
    assert sorted(map(str, rows)) == sorted(map(str, expected.select(*map(duckdb.ColumnExpression, columns)).fetchall()))


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark, sf_small):
    from test_simhash import plain_components

    from linkloom.llm import mixing, simhash

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns = docs.columns
    kept = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    def step(name, rows):
        out = stages[name](spark, rows, sf_small)
        return spark.createDataFrame(out.collect(), out.schema)

    rows = step("language identification", docs)
    assert rows.columns == columns
    assert {r.doc_id for r in rows.collect()} == {d for d, r in kept.items() if r.text and any(map(str.isalpha, r.text))}

    before, rows = rows.collect(), step("exact dedup", rows)
    first = {}
    for r in sorted(before, key=lambda r: r.doc_id):
        first.setdefault(" ".join(r.text.replace("\x0b", " ").split()) if r.text.strip() == r.text else r.text, r.doc_id)
    assert rows.columns == columns and {r.doc_id for r in rows.collect()} == set(first.values())

    before, rows = sorted(rows.collect(), key=lambda r: r.doc_id), step("near dedup", rows)
    groups = plain_components([r.doc_id for r in before], [simhash.fingerprint(r.text) for r in before])
    assert rows.columns == columns and {r.doc_id for r in rows.collect()} == set(groups)

    before, rows = rows, step("source mixing", rows)
    takes = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix(before).collect()}
    often = {}
    for r in rows.collect():
        often[r.doc_id] = often.get(r.doc_id, 0) + 1
    assert rows.columns == columns
    assert all(abs(often.get(d, 0) - (taken / size if size else 0)) < 1 for d, (taken, size) in takes.items())
    assert sum(often.values()) == pytest.approx(sum(taken / size for taken, size in takes.values() if size), rel=0.02)

    encoded = stages["encoding"](spark, rows, sf_small).collect()
    assert len(encoded) == rows.count() and all(len(r.tokens) == r.n_tokens for r in encoded)
