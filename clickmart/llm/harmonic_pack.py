"""Harmonic packing of token pieces into sequences of a fixed capacity.

A document's ids (and the end id) are cut into full sequences and a tail.  A piece of length r
belongs to the reciprocal class k = capacity // r, and k pieces of class k fill a sequence,
whatever their exact lengths.  A piece of class 1, such as every full sequence, is one by
itself.  Each worker numbers its pieces of any other class and puts k consecutive ones into each
sequence, with no search and without other workers.  Cuts are free,
so a tail that would waste over ``waste`` of its sequences is cut at the largest reciprocal
length below it, and its rest is treated likewise.  The last, incomplete sequence of each class
holds fewer than k pieces; a worker packs those (fewer than the sum of its classes) by first
fit, longest first.

Ids come from tiktoken, which has the same vocabulary as the .json's library and gives the same
ids; a text that its pattern matcher refuses (a run of about a million blanks) is encoded by the
.json's library itself.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each for
itself, in workers dealt by row; an empty table gives an empty result; ties (equal lengths) don't
matter, as any pieces of a class fit together; only id and text are read, so other columns may
have any name; a very long text is encoded whole, in memory in proportion to it.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import materialise

CAPACITY = 1024
#: A rest of this class or beyond is not cut further.
CLASSES = 64
#: Part of a sequence that a class may waste before a tail is cut.
WASTE = 0.04
#: Pieces of a worker, about.
WORKER_PIECES = 200_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@functools.lru_cache(maxsize=2)
def _encoding(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...]) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("pack", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> tokenizers.Tokenizer:
    return tokenizers.Tokenizer.from_file(path)


def ids_of(text: str, encoding: tiktoken.Encoding, tokenizer_path: str | None) -> np.ndarray:
    try:
        return encoding.encode_to_numpy(text, allowed_special="all").astype("<u4")
    except ValueError:  # its matcher's stack ends where a run of white space is very long
        if tokenizer_path is None:
            raise
        return np.array(_tokenizer(tokenizer_path).encode(text, add_special_tokens=False).ids, "<u4")


def cuts(n: int, capacity: int = CAPACITY, waste: float = WASTE) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    full, rest = divmod(n, capacity)
    out = [capacity] * full
    while rest:
        k = min(CLASSES, capacity // rest)
        if k == CLASSES or capacity - k * rest <= waste * capacity or rest <= capacity // (k + 1):
            out.append(rest)
            break
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


def _pieces(ranks_path: str, pattern: str, special: tuple, end_id: int, capacity: int, waste: float, tokenizer_path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks_path, pattern, special)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(ids_of(text.as_py() or "", encoding, tokenizer_path), np.uint32(end_id)).astype("<u4")
                data, start = ids.tobytes(), 0
                for length in cuts(len(ids), capacity, waste):
                    rows.append((doc_id, start, length, zlib.crc32(data[4 * start : 4 * (start + length)]), len(ids)))
                    start += length
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def _first_fit(capacity: int):
    def run(rest: pd.DataFrame) -> pd.DataFrame:
        rest = rest.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], ignore_index=True)
        used, bins, offsets = [], [], []
        for length in rest["length"].tolist():
            b = next((i for i, u in enumerate(used) if u + length <= capacity), len(used))
            if b == len(used):
                used.append(0)
            bins.append(b)
            offsets.append(used[b])
            used[b] += length
        return rest.assign(bin=pd.Series(bins, dtype="int64"), offset=pd.Series(offsets, dtype="int64"))

    return run


def pieces(docs: DataFrame, ranks_path: str, pattern: str, special: dict[str, int], end_id: int = 0, capacity: int = CAPACITY, waste: float = WASTE, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None) -> DataFrame:
    """The cut pieces: doc_id, start, length, ids_crc32, doc_tokens.

    ``tokenizer_path``: the same vocabulary as .json, for texts that tiktoken refuses.
    """
    run = _pieces(ranks_path, pattern, tuple(sorted(special.items())), end_id, capacity, waste, tokenizer_path)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def pack(cut: DataFrame, capacity: int = CAPACITY, worker_pieces: int = WORKER_PIECES) -> DataFrame:
    """``cut`` (see ``pieces``) with sequence_id and offset."""
    # a number of the row, so that pieces of repeated rows don't go to one worker
    cut = materialise(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    workers = max(1, -(-cut.count() // worker_pieces))
    worker = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "row"), F.lit(workers)).alias("worker")
    k = F.floor(F.lit(capacity) / F.col("length")).cast("long").alias("class")
    cut = cut.select("*", worker, k)
    # class 1 needs no numbers: ids below zero, by the place in the written pieces
    alone = cut.filter("class = 1").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    group = Window.partitionBy("worker", "class")
    order = group.orderBy("doc_id", "start", "ids_crc32", "row")
    numbered = cut.filter("class > 1").withColumn("number", F.row_number().over(order) - 1).withColumn("all", F.count(F.lit(1)).over(group))
    numbered = numbered.withColumn("bin", F.floor(F.col("number") / F.col("class"))).withColumn("full", (F.col("bin") + 1) * F.col("class") <= F.col("all"))
    before = Window.partitionBy("worker", "class", "bin").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    numbered = numbered.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "worker", "class", "bin", "offset"]
    numbered = materialise(numbered.select(*columns, "full"), "numbered")
    types = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker long, class long, bin long, offset long"
    rest = numbered.filter(~F.col("full")).select(*columns).groupBy("worker").applyInPandas(_first_fit(capacity), types)
    rest = rest.withColumn("class", F.lit(0).cast("long"))
    packed = numbered.filter("full").select(*columns).unionByName(rest.select(*columns))
    # classes go up to the capacity
    sequence = F.shiftleft(F.col("worker"), 32 + capacity.bit_length()) + F.shiftleft(F.col("class"), 32) + F.col("bin")
    packed = packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", sequence.alias("sequence_id"), F.col("offset").cast("long").alias("offset"))
    return alone.unionByName(packed)


def pack_documents(docs: DataFrame) -> DataFrame:
    """``docs`` packed with the vocabulary of byte_bpe_50k."""
    ranks, tokenizer = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
    return pack(pieces(docs, ranks, public_tokenizers.PATTERN, {"<|endoftext|>": 50256}, tokenizer_path=tokenizer))


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
