"""Token counts per document from the pieces of distinct pre-tokens.

A byte-level BPE splits a text into pre-tokens and encodes each by itself, so a document's
count is the sum over its pre-tokens.  Each task turns blocks of documents into inverted
lists: a pre-token with the block's documents that hold it, once per occurrence.  Pre-tokens
are dealt by hash; the tokenizer library encodes each distinct one once, the counts are
joined to the lists, and the sums are aggregated per document.  No ids of a document are ever
made.  Pre-tokens that are themselves pieces of the vocabulary, and the FREQUENT most frequent
others (counted over all documents), take a shorter way: each is encoded once, and the bounded
table of their counts is joined by a broadcast, so they are summed where the text is read.

Defined cases: null text counts as empty (0 bytes, 0 tokens); special strings in a text are one
token each, as the library takes them by default; a repeated row is counted for itself; there
are no ties; an empty table gives an empty result; only id and text are read, so other columns
may have any name; a very long text is cut into its pre-tokens in one task, in memory of a few
times its size.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickmart.llm.common import most_frequent

#: Bytes of text (code points, to be exact) and documents of a block.
BLOCK_CHARS = 12_000_000
BLOCK_DOCS = 65_535
#: Pre-tokens outside the vocabulary whose counts are broadcast, at most.
FREQUENT = 500_000

#: Begins the key of a block's documents; no pre-token does, as none has letters on both sides of a blank.
HEAD = "documents of block "
LISTS = "key string, block long, found binary"
ARROW = pa.schema([("key", pa.string()), ("block", pa.int64()), ("found", pa.binary())])
COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def count_pieces(path: str, pretokens: list[str]) -> list[int]:
    """Tokens of each pre-token as the library gives them."""
    return [len(e.ids) for e in _tokenizer(path).encode_batch_fast(pretokens, add_special_tokens=False)]


def vocabulary_counts(path: str) -> dict[str, int]:
    """Counts of the vocabulary's pieces that are whole texts by themselves."""
    t = _tokenizer(path)
    special = {a.content for a in t.get_added_tokens_decoder().values()}
    texts = sorted({x for x in (t.decode([i], skip_special_tokens=False) for i in range(t.get_vocab_size())) if x and "�" not in x} - special)
    return dict(zip(texts, count_pieces(path, texts), strict=True))


class _Numbers(dict):
    """Numbers new keys in their order."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def _block(block: int, doc_ids: list, sizes: list[int], special: list[int], words: _Numbers, found: list[np.ndarray], known: dict[str, int]) -> Iterator[pa.RecordBatch]:
    lengths = [len(x) for x in found]
    number = np.concatenate(found) if found else np.empty(0, np.int32)
    doc = np.repeat(np.arange(len(found)), lengths)
    names = list(words)
    counts = np.array([known.get(w, 0) for w in names], dtype=np.int64)
    own = counts[number] if len(number) else np.empty(0, np.int64)
    tokens = np.bincount(doc, weights=own, minlength=len(found)).astype(np.int64) + np.array(special, dtype=np.int64)
    # the block's documents: id, null or not, bytes, tokens so far
    ids = np.array([0 if i is None else i for i in doc_ids], dtype="<i8")
    head = np.stack([ids, np.array([i is None for i in doc_ids], "<i8"), np.array(sizes, "<i8"), tokens.astype("<i8")])
    yield pa.record_batch([pa.array([f"{HEAD}{block}"]), pa.array([block]), pa.array([head.tobytes()], pa.binary())], schema=ARROW)
    open_ = own == 0
    number, doc = number[open_], doc[open_].astype("<u2")
    order = np.argsort(number, kind="stable")
    number, doc = number[order], doc[order]
    starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else np.empty(0, np.int64)
    ends = np.r_[starts[1:], len(number)]
    data = doc.tobytes()
    for at in range(0, len(starts), 20_000):
        s, e = starts[at : at + 20_000], ends[at : at + 20_000]
        m = len(s)
        offsets = np.r_[s, e[-1]] * 2 - s[0] * 2
        lists = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data[2 * s[0] : 2 * e[-1]])])
        yield pa.record_batch([pa.array([names[i] for i in number[s].tolist()]), pa.array(np.full(m, block)), lists], schema=ARROW)


def _splitter(pattern: str, specials: list[str]):
    """Splits a text into its pre-tokens and the number of its special strings."""
    split = regex.compile(pattern)
    cut = re.compile("|".join(map(re.escape, specials))) if specials else None

    def pretokens(text: str) -> tuple[list[str], int]:
        if not cut or not any(s in text for s in specials):
            return split.findall(text), 0
        parts = cut.split(text)
        return [w for p in parts for w in split.findall(p)], len(parts) - 1

    return pretokens


def _repeated(pattern: str, specials: list[str], known):
    """Pre-tokens outside the vocabulary that occur more than once in a block, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pretokens, vocabulary = _splitter(pattern, specials), known.value
        held, chars = Counter(), 0

        def flush() -> pa.RecordBatch:
            own = [(w, n) for w, n in held.items() if n > 1 and w not in vocabulary]
            return pa.record_batch([pa.array([w for w, _ in own], pa.string()), pa.array([n for _, n in own], pa.int64())], names=["key", "count"])

        for batch in batches:
            for text in batch.column("text"):
                text = text.as_py() or ""
                held.update(pretokens(text)[0])
                chars += len(text)
                if chars >= BLOCK_CHARS:
                    yield flush()
                    held.clear()
                    chars = 0
        if held:
            yield flush()

    return run


def _inverted(pattern: str, specials: list[str], known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pretokens = _splitter(pattern, specials)
        block = TaskContext.get().partitionId() << 32
        words, found, doc_ids, sizes, special, chars = _Numbers(), [], [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                own, cuts = pretokens(text)
                found.append(np.fromiter(map(words.__getitem__, own), np.int32, len(own)))
                doc_ids.append(doc_id)
                sizes.append(len(text.encode()))
                special.append(cuts)
                chars += len(text)
                if chars >= BLOCK_CHARS or len(found) >= BLOCK_DOCS:
                    yield from _block(block, doc_ids, sizes, special, words, found, known.value)
                    words, found, doc_ids, sizes, special, chars = _Numbers(), [], [], [], [], 0
                    block += 1
        if found:
            yield from _block(block, doc_ids, sizes, special, words, found, known.value)

    return run


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column("key"), pa.array(count_pieces(path, batch.column("key").to_pylist()), pa.int64())], names=["key", "pieces"])

    return run


def _summed(joined: pa.Table) -> pa.Table:
    """The documents of a block with their sums."""
    found, head = joined.column("found").to_pylist(), joined.column("head").to_pylist()
    at = head.index(True)
    ids, none, sizes, tokens = np.frombuffer(found[at], "<i8").reshape(4, -1)
    lists = [x for x, h in zip(found, head, strict=True) if not h]
    pieces = joined.column("pieces").to_numpy()[~np.array(head)]
    docs = np.frombuffer(b"".join(lists), "<u2")
    weights = np.repeat(pieces, [len(x) // 2 for x in lists])
    tokens = tokens + np.bincount(docs, weights=weights, minlength=len(ids)).astype(np.int64)
    return pa.table([pa.array(ids, pa.int64(), mask=none == 1), pa.array(sizes), pa.array(tokens)], schema=COUNTS)


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    ``path``: a byte-level BPE file of the tokenizers library; ``pattern``: its pre-token pattern.
    """
    spark = docs.sparkSession
    specials = [a.content for a in _tokenizer(path).get_added_tokens_decoder().values()]
    sc = spark.sparkContext
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    vocabulary = vocabulary_counts(path)
    repeated = docs.select("text").mapInArrow(_repeated(pattern, specials, sc.broadcast(vocabulary)), "key string, count long")
    frequent = most_frequent(repeated.groupBy("key").agg(F.sum("count").alias("count")), FREQUENT)
    frequent = frequent.select("key").mapInArrow(_counted(path), "key string, pieces long").toPandas()
    known = sc.broadcast(vocabulary | dict(zip(frequent["key"].tolist(), frequent["pieces"].tolist(), strict=True)))
    lists = docs.mapInArrow(_inverted(pattern, specials, known), LISTS)
    lists = lists.repartition("key")
    # every column is used here as below, so that both read the same exchange
    distinct = lists.groupBy("key").agg(F.max("block").alias("block"), F.max(F.octet_length("found")).alias("most"))
    pieces = distinct.mapInArrow(_counted(path), "key string, pieces long")
    # a left join adds no filter below the exchange, which would make it another one
    joined = lists.join(pieces, "key", "left").select("block", F.col("key").startswith(HEAD).alias("head"), "found", "pieces")
    sums = joined.groupBy("block").applyInArrow(_summed, "doc_id long, n_bytes long, n_tokens long")
    return sums.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
