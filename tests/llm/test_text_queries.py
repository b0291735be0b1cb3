"""The text queries over the given tables: against their SQL, or against brute force where SQL cannot express them."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
import __spark_entry__ as entry_point
from compare import connect, duck_rows, duck_types, spark_rows
from sparkledger.llm import byte_bpe, quality, secrets
from sparkledger.llm.queries import BYTE_PATTERN, BYTE_RANKS, ORACLES, QUERIES, WORD_TOKENIZER
from test_text_operators import closed, expected_base, expected_groups, expected_leaks, expected_print

SPARK_TYPE = {"BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def rows(spark, data):
    return [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]


def test_all_are_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLES.items() <= entry_point.oracle_sql().items()
    assert entry_point.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, data, name):
    duck = connect(data)
    df = QUERIES[name](spark, data)
    assert spark_rows(df) == duck_rows(duck, ORACLES[name])
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == {c: SPARK_TYPE[k] for c, k in duck_types(duck, ORACLES[name]).items()}


def test_byte_bpe(spark, data, rows):
    encoding = tiktoken.Encoding("own", pat_str=BYTE_PATTERN, mergeable_ranks=byte_bpe.read_ranks(BYTE_RANKS), special_tokens={})
    found = {r["doc_id"]: r for r in QUERIES["op2_byte_bpe"](spark, data).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        ids = encoding.encode_ordinary(text or "")
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_simhash(spark, data, rows):
    prints = [expected_print(t) for _, t in rows]
    root = closed([(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4], len(rows))
    least: dict[int, int] = {}
    for (i, _), r in zip(rows, root):
        least[r] = min(least.get(r, i), i)
    expected = {i: (format(p, "016x"), least[r]) for (i, _), p, r in zip(rows, prints, root)}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op4_simhash"](spark, data).collect()} == expected


def test_token_blocks(spark, data, rows):
    tokenizer = Tokenizer.from_file(WORD_TOKENIZER)
    found = {r["doc_id"]: r for r in QUERIES["op5_token_blocks"](spark, data).collect()}
    at = 0
    for i, text in sorted(rows):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        assert (found[i]["start"], found[i]["n_tokens"], found[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_quality(spark, data, rows):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    found = QUERIES["op6_quality"](spark, data).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(i for i, _ in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) for r in found)
    held = [r["predicted"] == labels[r["doc_id"]] for r in found if r["held_out"] and r["doc_id"] in labels]
    assert sum(held) >= 0.85 * len(held)


def test_secrets(spark, data, rows):
    text_of = dict(rows)
    for r in QUERIES["op7_secrets"](spark, data).collect():
        base = expected_base(text_of[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(secrets.joined(base).encode()).hexdigest()
        assert r["n_assign"] + r["n_access"] + r["n_hex"] == len(base)


def test_toxicity(spark, data, rows):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    found = QUERIES["op9_toxicity"](spark, data).collect()
    assert len(found) == len(rows)
    right = [r["predicted"] == labels[r["doc_id"]] for r in found if r["doc_id"] in labels]
    assert sum(right) >= 0.9 * len(right)


def test_pipeline(spark, data, rows):
    """Each stage against brute force over what the one before kept."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    predicted = {r["doc_id"]: r["predicted"] for r in QUERIES["op6_quality"](spark, data).collect()}
    left = [(i, t) for i, t in rows if predicted[i]]
    kept = {i for i, _, _, stays, _ in expected_groups(left) if stays}
    equal = [(i, t) for i, t in left if i in kept]
    prints = [expected_print(t) for _, t in equal]
    root = closed([(a, b) for a in range(len(equal)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4], len(equal))
    least: dict[int, int] = {}
    for (i, _), r in zip(equal, root):
        least[r] = min(least.get(r, i), i)
    near = [(i, t) for (i, t), r in zip(equal, root) if least[r] == i]
    clean = {r[0] for r in expected_leaks(near, items) if not r[5]}
    expected = [[i for i, _ in left], [i for i, _ in equal], [i for i, _ in near], sorted(clean)]
    at = docs
    for (name, stage), ids in zip(corpus_pipeline.STAGES, expected):
        at = stage(spark, at, data)
        assert at.columns == docs.columns, name
        assert sorted(r["doc_id"] for r in at.select("doc_id").collect()) == sorted(ids), name
    assert quality.THRESHOLD == 0.3
    found = corpus_pipeline.run(spark, data).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(clean)
    text_of = dict(rows)
    assert all(r["decoded_sha256"] == hashlib.sha256((text_of[r["doc_id"]] or "").encode()).hexdigest() for r in found)


def test_pipeline_edge_cases(spark, data):
    """Nulls, repeated rows, null ids and more columns go through; an empty table stays empty."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _kept string, fp long"
    rows = [(1, None), (2, ""), (3, "a b c d e"), (3, "a b c d e"), (None, "one two three four five six"), (None, None), (5, "x" * 20_000)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "k", 1) for i, t in rows], schema)
    for given in (docs, docs.limit(0)):
        at = given
        for name, stage in corpus_pipeline.STAGES[1:]:
            at = stage(spark, at, data)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert at.columns == docs.columns
        found = [r["doc_id"] for r in at.collect()]
        assert len(found) == len(set(found)) and set(found) <= {1, 2, 3, 5, None}
    assert corpus_pipeline.STAGES[0][1](spark, docs, data).columns == docs.columns
