"""Repeated passages: every byte covered by a 200-byte string that starts anywhere else, too.

1. Anchors.  Of the GRAM-byte strings inside a window of LENGTH bytes, the one with the smallest
   hash (leftmost of equals) is the window's anchor.  It depends on the window's bytes alone, so
   equal windows have equal anchors at the same place.  An occurrence of an anchor owns a run of
   consecutive windows; the bytes they cover are its context.
2. Occurrences meet by the hash of their anchor.  An anchor that occurs once owns no repeated
   window.  Contexts that are identical as a whole are repeated as a whole.
3. Where one anchor has different contexts, one context of each kind goes into a block, the
   contexts of an anchor always together.  On the block's Burrows-Wheeler transform, intervals
   are expanded breadth first by backward extension: an interval of strings of n bytes sets the
   common prefix n of the row behind it where that is still open, and only then is extended
   further.  Common prefixes so appear by increasing value, and the expansion stops at LENGTH:
   rows still open share at least LENGTH bytes with their neighbour, and their windows repeat.
4. The intervals of a document are united and cut out of its bytes.

Bounds: a block's bytes are bounded by the anchor with the most different contexts.  Anchors
with over WIDE of them don't form a block: their windows are compared one by one, by hash
(equal windows meet after partial aggregation), which is exact as well, and dealt out by row
and place.  Anchors with over
HOT_ROWS occurrences are grouped with partial aggregation, so that none fills a task.

Rows are told apart by a 64-bit hash of id and text; a row repeated with id and text repeats
all its strings.  Equality of contexts is that of two 64-bit hashes, of anchor and context.
Defined cases: null text counts as empty; texts under LENGTH bytes lose nothing by themselves;
ties (equal contexts) don't matter, as each of them is marked; an empty table gives an empty
result; only id and text are read, so other columns may have any name; a very long text is hashed
in stretches of STRETCH bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import join_classes, materialise, text_or_empty
from clickmart.llm.rolling import Sums, mix, sliding_min

LENGTH = 200
GRAM = 64
#: Bytes hashed together, and the longest stretch of a text that is hashed at once.
CHUNK = 1 << 20
STRETCH = 1 << 23
#: Contexts of one anchor, and bytes of a block of several anchors.
WIDE = 16_384
BLOCK = 1 << 21
HOT_ROWS = 100_000

_PLACE = 28  # bits for a place in a chunk beside the hash that orders the anchors


def anchors(stretches: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(key, digest, number of the stretch, first window, last window) of all anchor occurrences."""
    lengths = np.array([len(s) for s in stretches])
    ends = np.cumsum(lengths)
    sums = Sums(np.frombuffer(b"".join(stretches), np.uint8))
    grams = sums.grams(gram)
    place = np.arange(len(grams), dtype=np.uint64)
    smallest = sliding_min((grams >> np.uint64(_PLACE)) << np.uint64(_PLACE) | place, length - gram + 1)
    if not len(smallest):
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    owner = (smallest & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    of = np.repeat(np.arange(len(stretches)), lengths)[: len(owner)]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (of[1:] != of[:-1])])
    last = np.minimum(np.r_[first[1:], len(owner)] - 1, ends[of[first]] - length)
    own = last >= first
    first, last = first[own], last[own]
    digest = mix(sums.value(first, last + length) ^ mix((last - first).astype(np.uint64)))
    start = ends[of[first]] - lengths[of[first]]
    return grams[owner[first]].view(np.int64), digest.view(np.int64), of[first], first - start, last - start


def _occurrences(length: int, gram: int):
    names = ["key", "digest", "rid", "first", "last"]

    def rows(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        key, digest, of, first, last = anchors([h[2] for h in held], length, gram)
        rid, base = np.array([h[0] for h in held], np.int64)[of], np.array([h[1] for h in held], np.int64)[of]
        return pa.record_batch([pa.array(key), pa.array(digest), pa.array(rid), pa.array((first + base).astype(np.int32)), pa.array((last + base).astype(np.int32))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_py().encode()
                for at in range(0, len(data) - length + 1, STRETCH):
                    held.append((rid, at, data[at : at + STRETCH + length - 1]))
                    size += len(held[-1][2])
                    if size >= CHUNK:
                        yield rows(held)
                        held, size = [], 0
        if held:
            yield rows(held)

    return run


def suffix_order(contexts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rows): contexts with a separator after each, and their suffixes sorted by ``depth`` symbols at least.

    A symbol is 0 for a separator, else byte + 1; separators count as different, in their order.
    """
    data = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8).astype(np.int64) + 1
    ends = np.cumsum([len(c) + 1 for c in contexts]) - 1
    data[ends] = 0
    n, h = len(data), 7
    to_end = np.repeat(ends, np.diff(np.r_[-1, ends])) - np.arange(n)
    key = np.zeros(n, np.int64)
    padded = np.r_[data, np.zeros(h, np.int64)]
    for j in range(h):
        key = (key << 9) | np.where(to_end >= j, padded[j : j + n], 0)
    rows = np.argsort(key, kind="stable")
    # a suffix that has reached its separator differs from all others
    fresh = np.r_[True, (key[rows[1:]] != key[rows[:-1]]) | (to_end[rows[1:]] < h)]
    rank = np.empty(n, np.int64)
    rank[rows] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    while h < depth:
        open_ = np.flatnonzero(~fresh | np.r_[~fresh[1:], False])
        if not len(open_):
            break
        own = rows[open_]
        key = rank[own] * (n + 1) + rank[np.minimum(own + h, n - 1)]
        order = np.argsort(key, kind="stable")
        own, key = own[order], key[order]
        rows[open_] = own
        fresh[open_] = np.r_[True, key[1:] != key[:-1]]
        rank[own] = open_[np.maximum.accumulate(np.where(fresh[open_], np.arange(len(open_)), 0))]
        h *= 2
    return data, rows


def repeated_windows(contexts: list[bytes], length: int) -> np.ndarray:
    """For each byte of the contexts (a separator after each): whether the window that starts there occurs at another place of them."""
    data, rows = suffix_order(contexts, length)
    n = len(rows)
    transform = data[rows - 1]  # the row before the first is the last separator
    step = np.empty(n, np.int64)
    step[np.argsort(transform.astype(np.int16), kind="stable")] = np.arange(n)
    bucket = np.r_[0, np.cumsum(np.bincount(data, minlength=257))]

    open_ = np.ones(n + 1, bool)  # the row's common prefix with the one above isn't known yet
    open_[0] = open_[n] = False
    separators = int(bucket[1])
    # strings of one symbol: each separator by itself, each byte's rows
    symbol = np.flatnonzero(np.diff(bucket)[1:]) + 1
    left, right = np.r_[np.arange(separators), bucket[symbol]], np.r_[np.arange(separators), bucket[symbol + 1] - 1]
    open_[right + 1] = False
    for _ in range(1, length):
        if not len(left):
            break
        # all rows of the intervals, then by symbol to the rows one byte longer
        size = right - left + 1
        row = np.arange(size.sum()) + np.repeat(left - np.r_[0, np.cumsum(size)[:-1]], size)
        of = np.repeat(np.arange(len(left)), size)
        inner = transform[row] > 0
        row, of = row[inner], of[inner]
        to = step[row]
        order = np.argsort(to)
        to, of, by = to[order], of[order], transform[row[order]]
        if not len(to):
            break
        new = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (by[1:] != by[:-1])])
        left, right = to[new], to[np.r_[new[1:], len(to)] - 1]
        fresh = open_[right + 1]
        left, right = left[fresh], right[fresh]
        open_[right + 1] = False
    out = np.zeros(n, bool)
    out[rows] = open_[:n] | open_[1:]
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true flags."""
    edge = np.diff(np.r_[False, flags, False].astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


CONTEXT = "key long, rid long, first int, alone boolean, wide boolean, context binary"
SPAN = "rid long, begin int, end int"


def _cut_out(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for rid, text, wanted in zip(batch.column("rid").to_pylist(), batch.column("text"), batch.column("wanted").to_pylist(), strict=True):
                data = text.as_py().encode()
                rows += [(w["key"], rid, w["first"], w["alone"], w["wide"], data[w["first"] : w["last"] + length]) for w in wanted]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
            for at in range(0, len(rows), 20_000):
                columns = list(zip(*rows[at : at + 20_000], strict=True))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "rid", "first", "alone", "wide", "context"])

    return run


def _blocks(length: int):
    def spans(keys, rids, firsts, alone, contexts) -> pa.RecordBatch:
        flags = repeated_windows(contexts, length)
        starts = np.r_[0, np.cumsum([len(c) + 1 for c in contexts])]
        a, b = _runs(flags)
        of = np.searchsorted(starts, a, side="right") - 1
        # a run ends with its context: windows reach no separator
        own = np.array(alone, bool)[of]
        a, b, of = a[own], b[own], of[own]
        first = np.array(firsts, np.int64)[of]
        begin, end = a - starts[of] + first, b - starts[of] + first + length
        return pa.record_batch([pa.array(np.array(rids, np.int64)[of]), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))], names=["rid", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        size, key = 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "rid", "first", "alone", "context", "wide")]
            for *row, wide in zip(*columns, strict=True):
                if wide:
                    continue
                if row[0] != key and size >= BLOCK:
                    yield spans(*held)
                    held, size = [[], [], [], [], []], 0
                key = row[0]
                for own, x in zip(held, row, strict=True):
                    own.append(x)
                size += len(row[4])
        if held[0]:
            yield spans(*held)

    return run


def _single_windows(length: int):
    """The windows of wide anchors' contexts one by one, told by two hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("wide"))
            for rid, first, alone, context in zip(*(batch.column(c).to_pylist() for c in ("rid", "first", "alone", "context")), strict=True):
                sums = Sums(np.frombuffer(context, np.uint8))
                at = np.arange(len(context) - length + 1)
                value = sums.value(at, at + length)
                halves = sums.value(at, at + length // 2)
                n = len(at)
                yield pa.record_batch(
                    [pa.array(mix(value).view(np.int64)), pa.array(mix(halves).view(np.int64)), pa.array(np.full(n, rid)), pa.array((at + first).astype(np.int32)), pa.array(np.full(n, alone))],
                    names=["whole", "half", "rid", "first", "alone"],
                )

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("spans").to_pylist(), strict=True):
            data, removed, n_spans, at, kept = text.as_py().encode(), 0, 0, 0, hashlib.sha256()
            reach = -1
            for s in sorted((s["begin"], s["end"]) for s in spans or ()):
                begin, end = s
                if begin > reach:
                    n_spans += 1
                    kept.update(data[at:begin])
                    at = begin
                if end > at:
                    removed += end - at
                    at = end
                reach = max(reach, end)
            kept.update(data[at:])
            rows.append((doc_id, len(data), removed, n_spans, kept.hexdigest()))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()], strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, wide: int = WIDE, hot_rows: int = HOT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    text = text_or_empty(text_col)
    docs = docs.select(F.xxhash64(F.col(id_col), text).alias("rid"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    found = docs.select("rid", "text").mapInArrow(_occurrences(length, gram), "key long, digest long, rid long, first int, last int")

    hot = materialise(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows), "hot-anchors")
    n_hot = hot.count()
    hot = F.broadcast(hot.select("key")) if n_hot <= 100_000 else hot.select("key")

    # anchors in tasks by key
    same, kind = Window.partitionBy("key"), Window.partitionBy("key", "digest")
    cold = found.join(hot, "key", "left_anti") if n_hot else found
    seen = cold.withColumn("n", F.count(F.lit(1)).over(kind)).withColumn("number", F.row_number().over(kind.orderBy("rid", "first")))
    seen = seen.withColumn("kinds", F.sum((F.col("number") == 1).cast("long")).over(same)).filter((F.col("n") > 1) | (F.col("kinds") > 1))
    seen = seen.select("key", "rid", "first", "last", "n", "number", "kinds")
    # one pass: the places of whole repeats, and one context of each kind where an anchor has several
    some = (F.col("kinds") > 1) & (F.col("number") == 1)
    wanted_row = F.when(some, F.struct("key", "first", "last", (F.col("n") == 1).alias("alone"), (F.col("kinds") > wide).alias("wide")))
    whole = F.when(F.col("n") > 1, F.struct(F.col("first").alias("begin"), (F.col("last") + length).alias("end")))
    marked = seen.select("rid", wanted_row.alias("wanted"), whole.alias("span"))

    if n_hot:
        busy = found.join(hot, "key", "left_semi").withColumn("both", F.struct("key", "digest"))
        kinds = busy.groupBy("both").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "first", "last")).alias("one"))
        kinds = materialise(kinds.select("both", "n", "one"), "hot-contexts")
        per_key = kinds.groupBy(F.col("both.key").alias("key")).agg(F.count(F.lit(1)).alias("kinds"))
        total = kinds.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        repeated = join_classes(busy.select("both", "rid", "first", "last"), kinds.filter("n > 1").select("both", "n"), "both", "n", total)
        spans = repeated.select("rid", F.lit(None).cast(marked.schema["wanted"].dataType).alias("wanted"), F.struct(F.col("first").alias("begin"), (F.col("last") + length).alias("end")).alias("span"))
        more = kinds.select(F.col("both.key").alias("key"), "n", "one").join(per_key.filter("kinds > 1"), "key")
        more = more.select(F.col("one.rid").alias("rid"), F.struct("key", F.col("one.first").alias("first"), F.col("one.last").alias("last"), (F.col("n") == 1).alias("alone"), (F.col("kinds") > wide).alias("wide")).alias("wanted"))
        marked = marked.unionByName(spans).unionByName(more.withColumn("span", F.lit(None).cast(marked.schema["span"].dataType)))

    per_row = marked.groupBy("rid").agg(F.collect_list("wanted").alias("wanted"), F.collect_list("span").alias("whole"))
    per_row = materialise(per_row, "marked")

    # the same columns in both uses, so that the texts are dealt out once
    dealt = docs.repartition("rid")
    contexts = dealt.join(per_row.filter(F.size("wanted") > 0).select("rid", "wanted"), "rid").select("rid", "doc_id", "text", "wanted").mapInArrow(_cut_out(length), CONTEXT)
    # the contexts of a wide anchor meet nowhere, so they are spread
    contexts = contexts.repartition("key", F.when(F.col("wide"), F.xxhash64("rid", "first")).otherwise(0))
    spans = contexts.sortWithinPartitions("key").mapInArrow(_blocks(length), SPAN)

    single = contexts.mapInArrow(_single_windows(length), "whole long, half long, rid long, first int, alone boolean")
    windows = single.groupBy("whole", "half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    lone = single.filter("alone").join(windows, ["whole", "half"], "left_semi")
    spans = spans.unionByName(lone.select("rid", F.col("first").alias("begin"), (F.col("first") + length).alias("end")))

    spans = spans.groupBy("rid").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    none = F.array().cast("array<struct<begin:int,end:int>>")
    spans = spans.join(per_row.filter(F.size("whole") > 0).select("rid", "whole"), "rid", "full")
    spans = spans.select("rid", F.concat(F.coalesce("spans", none), F.coalesce("whole", none)).alias("spans"))
    return dealt.join(spans, "rid", "left").select("rid", "doc_id", "text", "spans").mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
