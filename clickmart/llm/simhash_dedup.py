"""Near duplicates by SimHash, found with pigeonring filtering.

A document's shingles are its 3-word sequences (runs of non-space, A-Z lower-cased, joined by one
blank, repeats included; of fewer words, the whole sequence).  A bit of the 64-bit fingerprint is
set where over half of the shingles' XXH64 values (seed 42) have it.  Fingerprints link when at
most RADIUS = 2 bits differ; a component holds all documents that links reach.

Links are sought between distinct fingerprints, so exact copies cost one row each:

1. Chains.  The fingerprint is a ring of 8 segments of 8 bits.  If two fingerprints differ in at
   most 2 bits, some segment starts a chain along which the differences stay within budget: the
   first l segments together differ in at most 2 l / 8 bits, so in none of the first 3, at most
   one of the first 7, two of all 8 (the pigeonring principle).
2. Keys.  With at most one differing bit in segments 4 to 7, either 4 and 5 agree or 6 and 7 do.
   So each fingerprint has 16 keys of 40 bits (8 starts, two halves), and any linked pair shares
   one for a start whose whole chain is within budget.  Random fingerprints hardly ever share 40
   bits, so the keys stay selective for billions of documents.
3. Buckets.  A bucket isn't expanded into all of its pairs: one with over PAIRS members is cut by
   a further half of the bits that may differ once, again and again (a pair agrees in one of the
   halves), down to PAIRS members or the last segment's 256 values.  Inside, chains are checked
   segment by segment, the full Hamming distance last, and only a spanning forest of the links
   is returned, at most one row per member.  A bucket holds distinct fingerprints that agree in
   40 bits, so 2**24 of them (128 MB) at most, whatever the table.

Defined cases: null and empty texts and white space alone have fingerprint zero and link like any
other; repeated rows are rows of one fingerprint; a null id takes its component's smallest id
(null if all are); an empty table gives no rows; of the columns only id and text are read, so
others may have any name; a very long text is hashed in portions of CHUNK words, in memory of a
few times its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from clickmart.llm.common import join_classes, materialise
from clickmart.llm.components import components

WORDS = 3
SEED = 42
BITS, SEGMENTS, RADIUS = 64, 8, 2
#: Members of a bucket that are compared with each other; larger buckets are cut first.
PAIRS = 64
#: Words of a text that are hashed together.
CHUNK = 1 << 16

_U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WIDTH = BITS // SEGMENTS
#: First bits of a chain that agree; those after them of which one may differ; what a key takes of these.
_EQUAL, _ONCE, _HALF = 3 * _WIDTH, 4 * _WIDTH, 2 * _WIDTH


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """The SimHash of a text (UTF-8), from 0 to 2**64 - 1."""
    own = (text or b"").translate(_LOWER).split()
    if not own:
        return 0
    n = max(1, len(own) - words + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        part = own[at : at + CHUNK + words - 1]
        if len(own) < words:
            digests = xxh64_digest(b" ".join(own), SEED)
        else:
            digests = b"".join([xxh64_digest(s, SEED) for s in map(b" ".join, zip(*(part[i:] for i in range(words)), strict=False))])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            prints = np.array([fingerprint(t.as_py(), words) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(prints)], names=["doc_id", "node"])

    return run


def turned(prints: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """The ring turned so that the segment ``start`` has the lowest bits."""
    by = np.asarray(start, _U) * _U(_WIDTH)
    return (prints >> by) | (prints << ((_U(BITS) - by) % _U(BITS)))


def keys(prints: np.ndarray) -> np.ndarray:
    """(16, n): start and half (4 bits), then the 40 bits of the chain that have to agree."""
    out = []
    equal, half = _U((1 << _EQUAL) - 1), _U((1 << _HALF) - 1)
    for start in range(SEGMENTS):
        ring = turned(prints, start)
        for second in range(2):
            more = (ring >> _U(_EQUAL + _HALF * second)) & half
            out.append(_U(start << 1 | second) << _U(_EQUAL + _HALF) | more << _U(_EQUAL) | ring & equal)
    return np.array(out, np.uint64)


def within_budget(differing: np.ndarray) -> np.ndarray:
    """Which chains (turned rings of differing bits) stay within budget up to the last segment,
    that is the Hamming distance; each segment is counted for those still in question."""
    left = np.arange(len(differing))
    for l in range(1, SEGMENTS + 1):
        first = _U((1 << _WIDTH * l) - 1)
        left = left[np.bitwise_count(differing[left] & first) <= l * RADIUS // SEGMENTS]
    return left


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest of 0 to n - 1 that each can reach by the links (a, b)."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _cut(ring: np.ndarray, at: np.ndarray, low: int, bits: int) -> Iterator[np.ndarray]:
    """Parts of the members ``at`` that hold every pair with at most one differing bit of the
    ``bits`` from ``low`` on."""
    if len(at) <= PAIRS or bits <= 1:
        yield at
        return
    half = bits // 2
    for start, n, rest_low, rest in ((low, half, low + half, bits - half), (low + half, bits - half, low, half)):
        value = (ring[at] >> _U(start)) & _U((1 << n) - 1)
        order = np.argsort(value, kind="stable")
        bounds = np.flatnonzero(np.diff(value[order], prepend=value[order[0]] + _U(1), append=value[order[-1]] + _U(1)))
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if j - i > 1:
                yield from _cut(ring, at[order[i:j]], rest_low, rest)


def bucket_links(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within the buckets; rows are sorted by key."""
    change = np.flatnonzero(np.diff(key)) + 1
    begin, end = np.r_[0, change], np.r_[change, len(key)]
    size = end - begin
    ring = turned(node, key >> _U(_EQUAL + _HALF + 1))
    links = []
    few = np.repeat((size > 1) & (size <= PAIRS), size)
    last, here = np.repeat(end, size), np.flatnonzero(few)
    a, b, step = [], [], 1
    while len(here := here[here + step < last[here]]):
        hit = here[within_budget(ring[here] ^ ring[here + step])]
        a.append(hit)
        b.append(hit + step)
        step += 1
    if a:
        a, b = np.concatenate(a), np.concatenate(b)
        label = forest(a, b, len(key))
        moved = np.flatnonzero(label != np.arange(len(key)))
        links.append((node[label[moved]], node[moved]))
    for i in np.flatnonzero(size > PAIRS).tolist():
        second = int(key[begin[i]] >> _U(_EQUAL + _HALF)) & 1
        free = _EQUAL if second else _EQUAL + _HALF
        for at in _cut(ring, np.arange(begin[i], end[i]), free, _HALF):
            x, y = np.triu_indices(len(at), 1)
            hit = within_budget(ring[at[x]] ^ ring[at[y]])
            label = forest(x[hit], y[hit], len(at))
            moved = np.flatnonzero(label != np.arange(len(at)))
            links.append((node[at[label[moved]]], node[at[moved]]))
    none = np.empty(0, np.uint64)
    return tuple(np.concatenate([none, *side]) for side in zip(*links, strict=True)) if links else (none, none)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node = batch.column("node").to_numpy(zero_copy_only=False)
        key = keys(node.view(np.uint64))
        yield pa.record_batch([pa.array(key.ravel().view(np.int64)), pa.array(np.tile(node, len(key)))], names=["key", "node"])


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of buckets; rows come sorted by key, a bucket may go on in the next batch."""

    def found(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        a, b = bucket_links(key, node)
        return pa.record_batch([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("key", "node"))
        start = int(np.searchsorted(key, key[-1]))  # of the last bucket
        if held and held[0][0][0] == key[-1]:
            held.append((key, node))
            continue
        rows = [*held, (key[:start], node[:start])]
        yield found(*(np.concatenate(x) for x in zip(*rows, strict=True)))
        held = [(key[start:], node[start:])]
    if held:
        yield found(*(np.concatenate(x) for x in zip(*held, strict=True)))


def linked(nodes: DataFrame) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column node, long) that connect whatever is within RADIUS."""
    dealt = nodes.select("node").mapInArrow(_keyed, "key long, node long").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_bucketed, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint, component_id."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = materialise(docs.mapInArrow(_fingerprints(words), "doc_id long, node long"), "fingerprints")
    nodes = materialise(rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows")), "nodes")
    labels = components(materialise(linked(nodes), "links"))
    labelled = nodes.join(labels, "node", "left").select("node", "doc_id", "rows", F.coalesce("label", "node").alias("label"))
    labelled = materialise(labelled, "labelled")
    smallest = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("members"))
    classes = join_classes(labelled.select("node", "rows", "label"), smallest, "label", "members", nodes.count())
    classes = materialise(classes.select("node", "rows", "component_id"), "classes")
    out = join_classes(rows, classes, "node", "rows", rows.count())
    return out.select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
