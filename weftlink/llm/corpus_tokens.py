"""Encoding of a corpus with a public byte-level vocabulary through a table of distinct words.

1. Spark splits each text into the vocabulary's words (one regular expression, JVM-side). Each Arrow batch of
   documents is a *block*: its words become positions in a block dictionary, and the documents keep these codes.
2. The block dictionaries are folded into one table of distinct words, and each word is encoded once.
3. The ids are joined back: to the block dictionaries by word, then to the documents of the block by position.

Nothing is broadcast but the vocabulary file itself (a fixed size). A word in every document is one row a block, so no key
is hot. Blocks are bounded by documents and, for long texts, by words.

Nulls: a null text and an empty text give the empty list. White space is text like any other. Texts are never cut. Repeated
ids are encoded each for itself. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.session import settle

#: Where the public vocabularies lie.
TOKENIZERS = "/opt/tokenizers"
#: Documents and words of a block, at most (a single longer document is a block of its own).
BLOCK_DOCS, BLOCK_WORDS = 4000, 2_000_000

# The word pattern of the vocabulary; Java's \s is ASCII only, hence the explicit white space.
_WS = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORDS = rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"


def ranks(vocabulary: str = "byte_bpe_50k", path: str = TOKENIZERS) -> bytes:
    """The vocabulary file: a line for each piece, base64 and rank."""
    with open(f"{path}/{vocabulary}.tiktoken", "rb") as f:
        return f.read()


_encoders: dict[int, object] = {}


def _encoder(data: bytes):
    """The encoder of a vocabulary file, kept in the worker."""
    key = hash(data)
    if key not in _encoders:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        _encoders[key] = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=table, special_tokens={})
    return _encoders[key]


def _cuts(lengths: np.ndarray) -> list[int]:
    """Where blocks begin in a batch, by documents and words."""
    cuts, docs, words = [0], 0, 0
    for i, n in enumerate(lengths):
        if docs and (docs >= BLOCK_DOCS or words + n > BLOCK_WORDS):
            cuts.append(i)
            docs = words = 0
        docs, words = docs + 1, words + int(n)
    return [*cuts, len(lengths)]


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values))


_BLOCKS = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("key", pa.int64()), ("codes", pa.binary()), ("words", pa.list_(pa.string())), ("vector", pa.list_(pa.float32()))])


def _signs(words: pa.Array, dims: int) -> np.ndarray:
    """A vector of pseudo-random numbers in -1..1 for each word, from its hash."""
    import xxhash

    h = np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))
    out = np.empty((len(h), dims), np.float32)
    for k in range(dims):
        x = h * np.uint64(0x9E3779B97F4A7C15 + 2 * k) + np.uint64(k)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        out[:, k] = ((x >> np.uint64(40)).astype(np.float32) / np.float32(1 << 23)) - 1
    return out


def _encode_blocks(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = (TaskContext.get().partitionId() << 32) - 1
        for batch in batches:
            keys, lists = batch.column(0), batch.column(1)
            lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            cuts = _cuts(lengths)
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                block += 1
                coded = lists.slice(a, b - a).flatten().dictionary_encode()
                codes = coded.indices.to_numpy(zero_copy_only=False).astype("<u4")
                if len(coded.dictionary) < 1 << 16:
                    codes = codes.astype("<u2")
                ends = np.cumsum(lengths[a:b])
                wide = codes.itemsize
                cells = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(np.concatenate([[0], ends * wide]).astype(np.int32)), pa.py_buffer(codes)])
                if dims:
                    signs = _signs(coded.dictionary, dims)
                    sums = np.zeros((b - a, dims), np.float32)
                    full = np.flatnonzero(lengths[a:b])
                    if len(full):
                        starts = (ends - lengths[a:b])[full]
                        for k in range(dims):
                            sums[full, k] = np.add.reduceat(signs[codes, k], starts)
                    sums /= np.sqrt(np.maximum(lengths[a:b], 1)).astype(np.float32)[:, None]
                    vectors = _lists(sums.ravel(), np.full(b - a, dims))
                else:
                    vectors = pa.nulls(b - a, pa.list_(pa.float32()))
                n = b - a
                yield pa.RecordBatch.from_arrays([pa.array([block] * n, pa.int64()), pa.array(["doc"] * n), keys.slice(a, n), cells, pa.nulls(n, pa.list_(pa.string())), vectors], schema=_BLOCKS)
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array(["words"]), pa.array([wide], pa.int64()), pa.nulls(1, pa.binary()), _lists(coded.dictionary, np.array([len(coded.dictionary)])), pa.nulls(1, pa.list_(pa.float32()))], schema=_BLOCKS)

    return run


def _encode_words(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = _encoder(vocabulary.value)._encode_single_piece
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([piece(w.encode()) for w in b.column(0).to_pylist()], pa.list_(pa.int32()))], ["word", "ids"])

    return run


def _join_back(counts_only: bool):
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        order = np.argsort(words.column("code").to_numpy(), kind="stable")
        lists = words.column("ids").combine_chunks()
        size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)[order].astype(np.int64)
        wide = "<u2" if len(words) < 1 << 16 else "<u4"
        cells = docs.column("codes").combine_chunks()
        if len(cells):
            codes = np.concatenate([np.frombuffer(x, wide) for x in cells.to_pylist()]) if len(cells) else np.zeros(0, wide)
            lengths = pc.binary_length(cells).to_numpy(zero_copy_only=False).astype(np.int64) // np.dtype(wide).itemsize
        else:
            codes, lengths = np.zeros(0, wide), np.zeros(0, np.int64)
        each = size[codes]
        total = np.concatenate([[0], np.cumsum(each)])
        ends = np.cumsum(lengths)
        per_doc = total[ends] - total[ends - lengths]
        if counts_only:
            return pa.table({"key": docs.column("key"), "n_tokens": pa.array(per_doc, pa.int64()), "vector": docs.column("vector")})
        start = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])[:-1][order]
        at = np.repeat(start[codes] - total[:-1], each) + np.arange(total[-1])
        values = lists.flatten().to_numpy(zero_copy_only=False)
        return pa.table({"key": docs.column("key"), "ids": _lists(values[at].astype(np.int32), per_doc)})

    return run


def _parts(df: DataFrame, key: str, text: str, vocabulary: str, path: str, dims: int) -> tuple[DataFrame, DataFrame]:
    """Coded documents by block, and the ids of every block's words."""
    spark = df.sparkSession
    data = spark.sparkContext.broadcast(ranks(vocabulary, path))
    split = df.select(F.col(key).cast("long").alias("key"), F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORDS), F.lit(0)).alias("w"))
    kind = "block long, kind string, key long, codes binary, words array<string>, vector array<float>"
    blocks = settle(split.mapInArrow(_encode_blocks(dims), kind), "kind")
    docs = blocks.filter("kind = 'doc'").select("block", "key", "codes", "vector")
    local = blocks.filter("kind = 'words'").select(F.col("block").alias("of"), F.posexplode("words").alias("code", "word"))
    table = local.select("word").distinct().mapInArrow(_encode_words(data), "word string, ids array<int>")
    return docs, local.join(table, "word").select("of", "code", "ids")


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k", path: str = TOKENIZERS) -> DataFrame:
    """(key, ids): one row for each row of ``df``, ids without special tokens."""
    docs, words = _parts(df, key, text, vocabulary, path, 0)
    joined = docs.groupBy("block").cogroup(words.groupBy("of")).applyInArrow(_join_back(False), "key long, ids array<int>")
    return joined.select(F.col("key").alias(key), "ids")


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k", path: str = TOKENIZERS, dims: int = 0) -> DataFrame:
    """(key, n_tokens, vector): sizes in tokens and, with ``dims``, the hashed document vector projected to so many numbers."""
    docs, words = _parts(df, key, text, vocabulary, path, dims)
    joined = docs.groupBy("block").cogroup(words.groupBy("of")).applyInArrow(_join_back(True), "key long, n_tokens long, vector array<float>")
    return joined.select(F.col("key").alias(key), "n_tokens", "vector")


def pieces(spark: SparkSession, vocabulary: str = "byte_bpe_50k", path: str = TOKENIZERS) -> DataFrame:
    """(id, piece): the bytes of every id; as many rows as the vocabulary has."""
    rows = [(int(b), bytearray(base64.b64decode(a))) for a, b in map(bytes.split, ranks(vocabulary, path).splitlines())]
    return spark.createDataFrame(rows, "id int, piece binary")


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str = "byte_bpe_50k", path: str = TOKENIZERS) -> DataFrame:
    """(key, text): the text of each list of ids, by a join of ids with pieces; the empty list gives the empty text.

    ``key`` must be unique. The vocabulary has a fixed size, so its side is broadcast.
    """
    table = F.broadcast(pieces(df.sparkSession, vocabulary, path))
    rows = df.select(F.col(key).alias("key"), F.posexplode_outer(ids).alias("pos", "id"))
    hexed = rows.join(table, "id", "left").groupBy("key").agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", F.hex("piece").alias("h"))))).alias("p"))
    return hexed.select(F.col("key").alias(key), F.decode(F.unhex(F.array_join("p.h", "")), "UTF-8").alias("text"))
