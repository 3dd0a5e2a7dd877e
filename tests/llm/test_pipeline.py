"""The stages in order over the small tables, held against the operators' own contracts."""

import os

import pytest

import corpus_pipeline
from rfspark.llm import pii

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, tables[-1], SF)
        out.write.parquet(f"{tmp_path}/{i}")
        tables.append(spark.read.parquet(f"{tmp_path}/{i}"))
    _, clean, single, apart, hidden, packed = tables
    assert all(t.columns == columns for t in tables[:-1])
    assert clean.count() >= 0.8 * docs.count()
    lower = [r["text"].lower() for r in clean.select("text").collect()]
    assert single.count() <= len(set(lower)) + 5 and apart.count() <= single.count()
    # One document of every group stays, and what is told apart stays too.
    words = {r["doc_id"]: r["text"].lower().split() for r in single.collect()}
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for i, w in words.items()}
    left = {r["doc_id"] for r in apart.collect()}
    for i in set(sets) - left:
        assert max(len(sets[i] & s) / len(sets[i] | s) for j, s in sets.items() if j < i) >= 0.8
    assert hidden.count() == apart.count()
    assert not any(pii.base_spans(r["text"]) for r in hidden.collect())
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == left
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "pii", "packing"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_stages_on_odd_rows_and_on_none(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with names that operators use."""
    columns = spark.read.parquet(f"{SF}/documents.parquet").schema
    usual = " ".join(f"word{i}" for i in range(80))
    long = " ".join(f"long{i}" for i in range(150_000))
    texts = [(1, None), (2, ""), (3, long), (4, usual), (5, usual.upper()), (6, usual + " more"), (7, ""), (7, ""), (None, "no id at all")]
    texts += [(8, "write to ann@example.com or 10.1.2.3"), (9, " \t\n")]
    rows = [tuple({"doc_id": i, "text": t}.get(f.name) for f in columns) + (0, "x", None) for i, t in texts]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns) + ", id long, node string, key string"
    docs = spark.createDataFrame(rows, schema)
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF)
        assert name == "packing" or got.columns == docs.columns
        out[name] = got.collect()
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert {(r["doc_id"], r["text"]) for r in out["toxicity"]} <= set(texts)
    # Null and empty are one text; of equal texts the largest id stays, of repeated rows one.
    assert sorted((r["doc_id"] or 0) for r in out["exact_dedup"]) == [0, 3, 5, 6, 7, 8, 9]
    kept = [r["doc_id"] for r in out["simhash_near_dedup"]]
    assert {3, 4, 8} <= set(kept) and not {5, 6} & set(kept) and len(kept) == len(set(kept))
    hidden = {r["doc_id"]: r["text"] for r in out["pii"]}
    assert len(out["pii"]) == len(texts) and hidden[1] is None and hidden[2] == "" and hidden[3] == long
    assert "ann@" not in hidden[8] and "10.1.2.3" not in hidden[8]
    assert {r["doc_id"] for r in out["packing"]} == {i for i, _ in texts}
    tokens = {}
    for r in out["packing"]:
        tokens.setdefault(r["sequence_id"], []).append(r["length"])
    assert all(sum(x) <= 2048 for x in tokens.values()) and sum(r["length"] for r in out["packing"] if r["doc_id"] == 3) > 150_000
