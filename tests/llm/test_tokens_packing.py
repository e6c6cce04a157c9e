import random

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from weftlink.llm import corpus_tokens, packing
from weftlink.llm.queries import QUERIES

TEXTS = [None, "", " ", "\n\n \t", "a", "don't stop   here now", "naïve ſtrange ﬁ 漢字 🙂🙂  x", "'s've 12ab½ Ⅷ", " 　wide\u0085line", "x" * 40_000, "word " * 30_000, "é ​﻿", "\x00\x01"]


def reference(texts):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{corpus_tokens.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS block", "3 AS key", "'<|endoftext|>' AS w")


def test_ids_are_the_tokenizer_s(spark):
    texts = [*TEXTS, "<|endoftext|> is text"]
    got = {r[0]: r[1] for r in corpus_tokens.encode(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == reference(texts)


def test_ids_of_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").toPandas()
    got = {r[0]: r[1] for r in QUERIES["p8_ids"](spark, SMALL).collect()}
    assert [got[i] for i in docs.doc_id] == reference(docs.text)


def test_decode_round_trip(spark):
    df = frame(spark, TEXTS)
    got = {r[0]: r[1] for r in corpus_tokens.decode(corpus_tokens.encode(df)).collect()}
    assert [got[i] for i in range(len(TEXTS))] == [t or "" for t in TEXTS]


def test_counts_vectors_and_empty(spark):
    rows = {r["doc_id"]: r for r in corpus_tokens.token_counts(frame(spark, TEXTS), dims=3).collect()}
    assert [rows[i]["n_tokens"] for i in range(len(TEXTS))] == [len(x) for x in reference(TEXTS)]
    assert all(len(r["vector"]) == 3 for r in rows.values())
    empty = frame(spark, TEXTS).limit(0)
    assert corpus_tokens.encode(empty).collect() == [] and corpus_tokens.token_counts(empty).collect() == []


def test_repeated_keys_keep_their_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c")], "doc_id long, text string")
    assert sorted(r[1] for r in corpus_tokens.encode(df).collect()) == sorted(reference(["a b", "a b", "c"]))


def test_hilbert_steps_are_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = packing.hilbert(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        along = grid[np.argsort(key)]
        assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("partitions", [1, 3])
def test_packing(spark, partitions):
    r = random.Random(3)
    sizes = [r.choice([0, None, 5, 300, 700, 1000, 2048, 2049, 5000, 20_000]) for _ in range(600)]
    rows = [(i, s, [1.0, 2.0] if i % 3 == 0 else [r.random(), r.random()] if i % 7 else None) for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long, vector array<float>").selectExpr("*", "1 AS piece", "2 AS container", "3 AS curve")
    out = packing.pack(df, "doc_id", "n_tokens", "vector", 2, 2048, partitions)
    got = out.collect()
    full = {}
    for x in got:
        full[x["container"]] = full.get(x["container"], 0) + x["n_tokens"]
    assert max(full.values()) <= 2048 and sum(full.values()) == sum(s or 0 for s in sizes)
    pieces = {}
    for x in got:
        pieces.setdefault(x["doc_id"], []).append((x["piece"], x["start"], x["n_tokens"]))
    assert len(pieces) == 600
    for i, s in enumerate(sizes):
        p = sorted(pieces[i])
        assert [a for a, _, _ in p] == list(range(len(p))) and sum(n for *_, n in p) == (s or 0)
        assert len(p) == 1 if (s or 0) <= 2048 else p[0][2] == 2048
        assert all(b[1] == a[1] + a[2] for a, b in zip(p, p[1:]))
    least = -(-sum(full.values()) // 2048)
    assert len(full) <= least * 1.05 + partitions * 2
    assert packing.pack(df.limit(0), "doc_id", "n_tokens", "vector", 2).collect() == []


def test_containers_of_the_table_are_full(spark):
    r = QUERIES["p9_fill"](spark, SMALL).first()
    assert r["fullest"] <= 2048 and r["filled"] > 0.9
    tokens = corpus_tokens.token_counts(spark.read.parquet(f"{SMALL}/documents.parquet")).agg(F.sum("n_tokens")).first()[0]
    assert r["tokens"] == tokens
