"""Ranked lexical search: an Aho-Corasick scan of the documents for the terms of all items.

Terms are the longest runs of ASCII letters and digits and of any characters beyond ASCII, A-Z
lower-cased.  With N documents that hold a term, L terms in all, n in a document, df documents
that hold a term and tf of its occurrences in a document:

    w = floor(1000 ln((2 N + 2) / (2 df + 1)))
    m = 50 + (50 n N) div L
    score = sum over an item's distinct terms of w * ((10**9 tf) div (1000 tf + 20 m))

1. Items.  Their distinct terms are dealt into blocks of about BLOCK_BYTES; a block is one scan
   of all documents, so what is broadcast has that bound however many items there are.
2. Scan.  All separators become one guard character, and the automaton holds each term between
   two guards, so it matches whole terms only, all items' terms in one pass over the text.  Its
   outputs are term numbers; their counts are the tf, without an index of the documents' other
   terms.  Each document leaves n and its (term, tf) pairs, once, in the shared folder.
3. Statistics.  N, L and the df are counted over all documents from what the scan left.
4. Ranking.  A task maps terms to items (an array of items per term), sums the scores of a
   portion of documents with one weighted count, exact as all sums stay under 2**53, and keeps
   each item's best rows.  Those of the tasks are merged in two steps, so that no task sees
   more than a share of them.

Defined cases: null and empty texts have no term and no row; items without terms have none;
equal scores rank by doc_id, null ids last; a repeated document row is ranked as a row of its
own; items that share an id are one item with the terms of all, a null item_id is an id; empty
tables give no rows; other columns are never read; a very long text is scanned in portions of
about CHUNK bytes, cut at separators.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import materialise

MOST = 50
#: Bytes of the items' terms (16 more each) in one scan's automaton, about.
BLOCK_BYTES = 2 << 20
#: Bytes of a text that are scanned together, about.
CHUNK = 1 << 24
#: Scores (documents times items) that are summed together, and documents at most.
SCORES, PORTION = 1 << 21, 256
#: Groups of tasks whose best rows are merged first.
GROUPS = 64

_GUARD = b" "
#: Letters and digits, lower-cased, and bytes beyond ASCII stay; the others separate.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def portions(text: bytes | None, most: int = CHUNK) -> Iterator[bytes]:
    """The text's terms (UTF-8) with guards between them and at both ends."""
    data, at = (text or b"").translate(_TERMS), 0
    while at < len(data):
        end = at + most
        if end < len(data):
            end = data.rfind(_GUARD, at, end)
            if end < 0:  # one term, longer than a portion
                end = data.find(_GUARD, at + most)
            end = len(data) if end < 0 else end + 1
        yield _GUARD + data[at:end] + _GUARD
        at = end


def n_terms(portion: bytes) -> int:
    inside = np.frombuffer(portion, np.uint8) != 32
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


def automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    """One character a byte: Latin-1 maps bytes to characters one by one."""
    out = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        out.add_word((_GUARD + term + _GUARD).decode("latin-1"), i)
    out.make_automaton()
    return out


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, terms = [], []
        for i, text in zip(batch.column("item_id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
            own = {t for p in portions(text.as_py()) for t in p.split()}
            ids += [i] * len(own)
            terms += own
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["item_id", "term"])


def _scan(machine):
    """doc_id, n and the numbers and counts of the automaton's terms; documents without any term are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, found = [], []
            for text in batch.column("text").cast(pa.binary()):
                n, tf = 0, Counter()
                for part in portions(text.as_py()):
                    n += n_terms(part)
                    tf.update(map(itemgetter(1), machine.value.iter(part.decode("latin-1"))))
                size.append(n)
                found.append(tf)
            keep = np.flatnonzero(size)
            found = [found[i] for i in keep]
            offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            terms = np.fromiter((t for tf in found for t in tf.keys()), np.int32)
            counts = np.fromiter((c for tf in found for c in tf.values()), np.int32)
            lists = (pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (terms, counts))
            yield pa.record_batch([batch.column("doc_id").take(pa.array(keep)), pa.array(np.array(size, np.int64)[keep]), *lists], names=["doc_id", "n", "terms", "counts"])

    return run


class Best:
    """The best rows of each item so far: highest score, then smallest id, null ids last."""

    def __init__(self, items: int, most: int):
        self.most, self.least = most, np.zeros(items, np.int64)
        self.item = self.score = self.id = np.empty(0, np.int64)
        self.none = np.empty(0, bool)

    def add(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        new = score >= np.maximum(self.least[item], 1)
        item, score = np.r_[self.item, item[new]], np.r_[self.score, score[new]]
        ids, none = np.r_[self.id, ids[new]], np.r_[self.none, none[new]]
        order = np.lexsort((ids, none, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        at = order[place < self.most]
        last = order[place == self.most - 1]
        self.item, self.score, self.id, self.none = item[place < self.most], score[at], ids[at], none[at]
        self.least[item[place == self.most - 1]] = score[last]


def length_norm(n: int, documents: int, terms: int) -> int:
    return 50 + (50 * n * documents) // terms


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _ranked(shared, documents: int, terms: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, weights, first, of = shared.value
        best = Best(len(ids), most)
        step = max(1, min(PORTION, SCORES // len(ids)))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                doc = part.column("doc_id")
                term = part.column("terms").flatten().to_numpy().astype(np.int64)
                tf = part.column("counts").flatten().to_numpy().astype(np.int64)
                m = np.array([length_norm(n, documents, terms) for n in part.column("n").to_pylist()], np.int64)
                row = np.repeat(np.arange(part.num_rows), part.column("terms").value_lengths().to_numpy())
                gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[row]))
                # each (document, term) for each of the term's items
                many = first[term + 1] - first[term]
                begin = np.cumsum(many) - many
                item = of[np.repeat(first[term] - begin, many) + np.arange(many.sum())]
                score = np.bincount(np.repeat(row, many) * len(ids) + item, np.repeat(gain, many), part.num_rows * len(ids))
                hit = np.flatnonzero(score)
                none = doc.is_null().to_numpy(zero_copy_only=False)
                value = doc.fill_null(0).to_numpy()
                best.add(hit % len(ids), score[hit].astype(np.int64), value[hit // len(ids)], none[hit // len(ids)])
        item_id = pa.array([ids[i] for i in best.item.tolist()], pa.int64())
        yield pa.record_batch([item_id, pa.array(best.id, mask=best.none), pa.array(best.score)], names=["item_id", "doc_id", "score"])

    return run


def _search_block(docs: DataFrame, block: DataFrame, most: int) -> DataFrame | None:
    spark = docs.sparkSession
    pairs = [(r["item_id"], bytes(r["term"])) for r in block.collect()]  # about BLOCK_BYTES
    if not pairs:
        return None
    ids = sorted({i for i, _ in pairs}, key=lambda i: (i is None, i or 0))
    names = sorted({t for _, t in pairs})
    number, place = {t: k for k, t in enumerate(names)}, {i: k for k, i in enumerate(ids)}
    seen = materialise(docs.mapInArrow(_scan(spark.sparkContext.broadcast(automaton(names))), "doc_id long, n long, terms array<int>, counts array<int>"), "scanned")
    total = seen.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    if not total["documents"]:
        return None
    df = dict(seen.select(F.explode("terms").alias("term")).groupBy("term").count().collect())  # a row per term of the block
    weights = np.array([weight(total["documents"], df.get(k, 0)) for k in range(len(names))], np.int64)
    of = np.array(sorted((number[t], place[i]) for i, t in pairs), np.int64)
    first = np.searchsorted(of[:, 0], np.arange(len(names) + 1))
    shared = spark.sparkContext.broadcast((ids, weights, first, of[:, 1].copy()))
    return seen.mapInArrow(_ranked(shared, total["documents"], total["terms"], most), "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, most: int = MOST, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per item and each of its ``most`` best documents: item_id, rank, doc_id, score.

    ``items``: item_id, text.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    terms = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(_item_terms, "item_id long, term binary")
    terms = materialise(terms.distinct(), "item_terms")
    held = terms.agg(F.sum(F.length("term") + 16).alias("bytes")).first()["bytes"] or 0
    blocks = -(-held // block_bytes)
    found = []
    for b in range(blocks):
        block = terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        found.append(_search_block(docs, block, most))
    found = [x for x in found if x is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = reduce(DataFrame.unionByName, found).withColumn("group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "group").orderBy(*order))).filter(F.col("rank") <= most)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    best = best.select("item_id", "doc_id", "score").withColumn("rank", rank).filter(F.col("rank") <= most)
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_OWN = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_OWN} AS terms FROM documents),
sized AS (SELECT r, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0),
total AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM sized),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM sized) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
item AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_OWN}) AS term FROM benchmark)),
weighted AS (SELECT item_id, item.term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) AS w FROM item JOIN df USING (term), total),
scored AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // l)))) AS BIGINT) AS score
  FROM weighted JOIN tf USING (term) JOIN sized USING (r), total GROUP BY item_id, r),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {MOST}
"""
