"""Registered queries of the subpackage: SQL, contracts, and the pipeline's stages."""

import hashlib
import pathlib

import duckdb
import public_tokenizers
import pytest
import tiktoken  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from roadpulse.llm import queries, sql
from workload.compare import canonical, same_types


@pytest.fixture(scope="module")
def oracle(small):
    db = duckdb.connect()
    for path in pathlib.Path(small).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def test_all_are_registered():
    names = list(queries.QUERIES)
    assert sorted(n.split("_")[0] for n in names) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])
    assert set(sql.SQL) <= set(names)


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_query_equals_sql(spark, small, oracle, name):
    got = queries.QUERIES[name](spark, small)
    want = oracle.sql(sql.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    ours = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    assert same_types(ours, dict(zip(want.columns, map(str, want.types))))
    assert canonical(got.columns, got.collect()) == canonical(want.columns, want.fetchall())


@pytest.mark.parametrize("name", ["op1_license_scans", "op2_chat_formatting", "op9_document_fingerprints"])
def test_native_plans(spark, small, name):
    text = queries.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_token_counts(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    from roadpulse.llm.tokens import Counter
    import base64

    with open(queries.BYTE_RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    count = Counter(ranks, public_tokenizers.PATTERN).encoding.encode_ordinary
    for r in queries.op5_token_counts(spark, small).collect():
        text = texts[r["doc_id"]]
        n, third = len(text), len(text) // 3
        assert r["n_tokens"] == len(count(text))
        new = text[:third] + text[:12] + text[third + min(20, n - third) :]
        half = len(new) // 2
        new = new[:half] + " " + text[:9][::-1] + new[half:]
        before = len(new) - 1 - len(text[:9])
        new = new[:before]
        assert (r["edited_chars"], r["edited_tokens"]) == (len(new), len(count(new)))
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, seen = docs.columns, []
    for _, stage in P.STAGES[:-1]:
        after = stage(spark, docs, small)
        assert after.columns == columns and [t for _, t in after.dtypes] == [t for _, t in docs.dtypes]
        seen.append({r["doc_id"]: r["text"] for r in after.collect()})
        docs = spark.createDataFrame(after.collect(), docs.schema)
    scores = {r["doc_id"]: r["predicted"] for r in queries.op3_quality_classifier(spark, small).collect()}
    assert set(seen[0]) == {k for k, v in scores.items() if v}
    # Every string of 50 bytes stands in one document only.
    owners = {}
    for key, text in seen[1].items():
        data = text.encode()
        for i in range(len(data) - 49):
            owners.setdefault(data[i : i + 50], set()).add(key)
    assert set(seen[2]) == set(seen[1])
    for key, text in seen[1].items():
        data, gone = text.encode(), set()
        for i in range(len(data) - 49):
            if min(owners[data[i : i + 50]]) < key:
                gone |= set(range(i, i + 50))
        assert seen[2][key] == bytes(b for i, b in enumerate(data) if i not in gone).decode("utf-8", "ignore")
    library = Tokenizer.from_file(queries.WORD_BPE)
    last = P.run(spark, small).collect()
    assert {r["doc_id"] for r in last} == set(seen[3]) and set(seen[3]) < set(seen[2])
    for r in last:
        want = library.encode(seen[3][r["doc_id"]], add_special_tokens=False).ids
        assert list(r["ids"]) == want and r["n_tokens"] == len(want)
        text = library.decode(want, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_pipeline_keeps_one_of_each_group(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = {r["doc_id"] for r in P.keep_one_of_a_group(spark, docs, small).collect()}
    groups = queries.op4_simhash_near_dedup(spark, small).select(F.col("component_id")).distinct().collect()
    assert kept == {r[0] for r in groups}
