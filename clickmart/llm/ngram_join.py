"""Similarity join of documents by their word n-grams, as connected components.

A document's set is that of its distinct n-word shingles.  Documents with equal sets are one
node.  Two nodes link when 100 * intersection >= percent * union.

Candidates come from token-combination prefixes.  All tokens (shingle hashes) have one global
order: rare ones first, then by frequency, at last the tiers of very frequent ones.  A set of m tokens can miss d = m -
ceil(percent * m / 100) of them in any partner.  Its prefix is extended until it holds d + 1
units: a rare token is one unit and is indexed by itself; the tokens of a tier of combinations
of k are dealt to classes by hash, a class with c of them in the prefix counts c - k + 1 units
and is indexed by its k-combinations.  Of two linked sets, consider the prefix that ends first:
at most d of its tokens are missing in the other set, so some class keeps k shared tokens, and
they lie in the other prefix, too.  The number of classes follows the size of the sets (by
powers of two; a set is indexed for every power its partners can have), so that combinations
stay few and units suffice; the tokens of very short sets are all indexed by themselves.

The frequencies are counts of the tasks' batches over all documents; only tokens seen once in a
batch aren't passed on.  Any order gives the same result; the counts just make buckets small.

A bucket (one signature) isn't expanded into pairs.  Its member with the fewest tokens of its own
is compared with each other one and the links' components are formed.  Members outside the bucket's largest component
are then compared with all members of other components, in the smallest of the buckets that the
two share (as far as a few of each one's smallest signatures tell), so no link is lost.  A
candidate pair is dropped where the prefixes show too many misses: of the set whose prefix ends
first, every prefix token that no other set has in its prefix is missing in the partner; and, in
the second comparison, where the parities of the sets' tokens in 256 buckets differ in more bits
than linked sets differ in tokens.  A comparison then bounds the intersection from above: a set's tokens are counted in buckets by
hash, and the sum of the smaller counts is no less than the intersection.  Pairs that can reach
the threshold by that bound are decided on the whole texts of both nodes.

Nodes are told apart by a 64-bit hash of their sets, tokens by one of their words.
Defined cases: null or empty text, or white space alone: no shingles, linked with nothing, its
component is its own id; fewer than n words: the whole sequence is the one shingle; a repeated
row belongs to its node as any other; a null id takes its component's smallest id; ties don't
arise, as components have no order; an empty table gives an empty result; only id and text are
read, so other columns may have any name; a very long text is one set, hashed in memory of a few
times its size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import join_classes, materialise, most_frequent, row_key
from clickmart.llm.components import components
from clickmart.llm.rolling import mix, shingles

#: (least count, k): tokens with that count are indexed in combinations of k.
TIERS = ((1_000, 2), (100_000, 3))
#: Tokens from this count on are ordered by it; the most frequent MOST_FREQUENT of them are sent
#: to the tasks (about 10 bytes each), the others count as rare.
FREQUENT = 4
MOST_FREQUENT = 1_000_000
#: Tokens of a set for each class of a tier, about.
CLASS_TOKENS = 8
#: Ids up to this many are broadcast to fetch the candidates' texts; more are joined by shuffle.
BROADCAST_IDS = 2_000_000
#: Code points of the texts that are hashed together, about, and tokens that are counted together.
CHUNK = 1 << 18
COUNTED = 1 << 21


def _text_chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, list[str]]]:
    """(number of the first, texts) in turn."""
    held, size, start = [], 0, 0
    for i, text in enumerate(batch.column(column)):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= CHUNK:
            yield start, held
            held, size, start = [], 0, i + 1
    if held:
        yield start, held


def node_of(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(words: int):
    names = ["doc_id", "rid", "node", "n", "token", "count"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def counted(tokens: list[np.ndarray]) -> pa.RecordBatch:
        token, count = np.unique(np.concatenate(tokens), return_counts=True)
        token, count = token[count > 1].view(np.int64), count[count > 1]
        none = [pa.nulls(len(token), t) for t in types[:4]]
        return pa.record_batch([*none, pa.array(token), pa.array(count.astype(np.int64))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, tokens, size = set(), [], 0
        for batch in batches:
            nodes, sizes = [], []
            for _, texts in _text_chunks(batch):
                for own in shingles(texts, words):
                    node = node_of(own) if len(own) else None
                    nodes.append(node)
                    sizes.append(len(own))
                    if len(own) and node not in seen:
                        seen.add(node)
                        tokens.append(own)
                        size += len(own)
                if size >= COUNTED:
                    yield counted(tokens)
                    seen, tokens, size = set(), [], 0
            k = len(nodes)
            yield pa.record_batch([batch.column("doc_id"), batch.column("rid"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names=names)
        if tokens:
            yield counted(tokens)

    return run


#: Beyond the place of any rare token: level (7 bits), then the leading bits of the hash.
FARTHEST = 2**63 - 1


def misses(n: int, percent: int) -> int:
    """Tokens of a set of n that a linked set can lack."""
    return n - -(-percent * n // 100)


def _power(n: int) -> int:
    return n.bit_length() - 1


def _classes(power: int, ks: tuple[int, ...], percent: int) -> int:
    """Classes of a tier for sets of 2**power tokens and more; 0: index all tokens by themselves.

    A class holds back k - 1 tokens that count no unit.  Of n tokens there must remain d + 1 <=
    n - percent * n / 100 + 1 units, and n is percent / 100 * 2**power at least.
    """
    held_back = sum(k - 1 for k in ks)
    return min(max(1, (1 << power) // CLASS_TOKENS), max(0, (percent * percent << power) // 10_000 - 1) // held_back)


def signatures(tokens: np.ndarray, tier: np.ndarray, ks: tuple[int, ...], percent: int, level: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """Signatures of a set: sorted distinct tokens with their tiers (0: rare, i: combinations of
    ks[i - 1]) and their frequency levels; and the place in the order up to which its rare tokens
    are all indexed (that of the last one; FARTHEST where no rare token is left out)."""
    n = len(tokens)
    need = misses(n, percent) + 1
    largest = 100 * n // percent
    if largest <= n and misses(n, percent) == 0:
        return tokens[:0], 0  # its partners are equal sets only
    order = np.lexsort((tokens, tier) if level is None else (tokens, level, tier))
    tokens, tier = tokens[order], tier[order]
    rare = int(np.searchsorted(tier, 1))
    out = [tokens[: min(rare, need)]]
    end = FARTHEST
    if rare >= need:
        at = order[need - 1]
        end = (0 if level is None else int(level[at])) << 56 | int(tokens[need - 1]) >> 8
    if rare < need:
        for power in range(_power(max(1, -(-percent * n // 100))), _power(largest) + 1):
            classes = _classes(power, ks, percent)
            if not classes:
                out.append(tokens[:need])
                continue
            held: dict[tuple[int, int], list[int]] = {}
            units, found = rare, []
            for token, t in zip(tokens[rare:].tolist(), tier[rare:].tolist(), strict=True):
                if units >= need:
                    break
                own = held.setdefault((t, token % classes), [])
                own.append(token)
                units += len(own) >= ks[t - 1]
            for (t, _), own in held.items():
                found += [(power, *c) for c in combinations(own, ks[t - 1])]
            if found:
                h = np.zeros(len(found), np.uint64)
                width = max(map(len, found))
                for part in np.array([f + (0,) * (width - len(f)) for f in found], dtype=np.uint64).T:
                    h = mix(h * np.uint64(31) + part + np.uint64(1))
                out.append(h)
    return np.unique(np.concatenate(out)), end


def _signed(words: int, percent: int, frequent, ks: tuple[int, ...]):
    names = ["signature", "node", "n", "common", "end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tiers, levels = frequent.value
        for batch in batches:
            seen = set()
            for _, texts in _text_chunks(batch):
                nodes, sizes, ends, found, common = [], [], [], [], []
                for own in shingles(texts, words):
                    if not len(own) or (node := node_of(own)) in seen:
                        continue
                    seen.add(node)
                    tier, level = np.zeros(len(own), np.int8), np.zeros(len(own), np.int8)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                        hit = known[at] == own
                        tier[hit], level[hit] = tiers[at[hit]], levels[at[hit]]
                    s, end = signatures(own, tier, ks, percent, level)
                    nodes.append(node)
                    sizes.append(len(own))
                    ends.append(end)
                    found.append(s)
                    # tokens that aren't known to be frequent; combinations are of frequent ones
                    common.append(~np.isin(s, own[level == 0], assume_unique=True))
                lengths = [len(s) for s in found]
                if not nodes:
                    continue
                of = np.repeat(np.arange(len(nodes)), lengths)
                node, n = np.array(nodes, np.int64), np.array(sizes, np.int32)
                none = pa.nulls(len(of), pa.int64())
                yield pa.record_batch([pa.array(np.concatenate(found).view(np.int64)), pa.array(node[of]), pa.array(n[of]), pa.array(np.concatenate(common)), none], names=names)
                # the nodes themselves
                k = len(nodes)
                yield pa.record_batch([pa.nulls(k, pa.int64()), pa.array(node), pa.array(n), pa.nulls(k, pa.bool_()), pa.array(ends, pa.int64())], names=names)

    return run


def _linked(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, left_set = None, None
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            for at, texts in _text_chunks(batch, "b_text"):
                for i, own in enumerate(shingles(texts, words), at):
                    if a[i] != left:
                        left, left_set = a[i], shingles([batch.column("a_text")[i].as_py() or ""], words)[0]
                    shared = len(np.intersect1d(left_set, own, assume_unique=True))
                    if 100 * shared >= percent * (len(left_set) + len(own) - shared):
                        keep.append(i)
            yield pa.record_batch([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"])

    return run


def bucket_counts(tokens: np.ndarray) -> np.ndarray:
    """Tokens per bucket by the leading bits of their hash; two to four tokens a bucket on average."""
    bits = max(0, _power(max(1, len(tokens))) - 1)
    if not bits:
        return np.array([min(len(tokens), 255)], np.uint8)
    counts = np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8)


def most_shared(a: np.ndarray, b: np.ndarray, n: int) -> int:
    """No less than the intersection of two sets with these bucket counts; ``n``: the smaller set's tokens."""
    if max(a.max(), b.max()) == 255:
        return n  # a count may be cut off
    if len(a) < len(b):
        a, b = b, a
    folded = a.reshape(len(b), -1).sum(axis=1, dtype=np.int64)
    return int(np.minimum(folded, b).sum())


#: Columns of a node's parities.
PARITIES = ("p0", "p1", "p2", "p3")


def parities(tokens: np.ndarray) -> np.ndarray:
    """Whether each of 256 buckets by hash holds an odd number of tokens, as four longs.

    A token that only one of two sets has changes one bit, so two sets differ in no fewer tokens
    than their parities in bits.
    """
    odd = np.bincount((tokens & np.uint64(64 * len(PARITIES) - 1)).astype(np.int64), minlength=64 * len(PARITIES)) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _few_differ(one: str, other: str, percent: int) -> Column:
    """Whether two nodes' parities (columns with these beginnings) leave room for a link."""
    differing = sum((F.bit_count(F.col(f"{one}{p}").bitwiseXOR(F.col(f"{other}{p}"))) for p in PARITIES), F.lit(0))
    both = F.col(f"{one}n") + F.col(f"{other}n")
    return (both - differing) * 100 >= (both + differing) * percent


#: Columns of a node's smallest signatures, one of each remainder of signature by their number.
LEAST = tuple(f"k{i}" for i in range(8))


def _with_least(member: DataFrame) -> DataFrame:
    """``member`` (signature, node) with the node's LEAST signatures; no shuffle where it is dealt by node."""
    own = Window.partitionBy("node")
    of = F.pmod(F.col("signature"), F.lit(len(LEAST)))
    return member.select("*", *(F.min(F.when(of == i, F.col("signature"))).over(own).alias(k) for i, k in enumerate(LEAST)))


def _met(open_: DataFrame, columns: list[str], percent: int) -> DataFrame:
    """Members of different components that share a bucket (with its ``main`` component) and can link: x_node, node.

    Two nodes share many buckets, and one meeting is enough: that in the smallest they share.  So a
    bucket passes by the two where a smaller one is among the LEAST of both; where they share none
    of those, a pair comes more than once.
    """
    stray = open_.filter(F.col("label") != F.col("main")).select("signature", *(F.col(c).alias(f"x_{c}") for c in (*columns, "label", *PARITIES, *LEAST)))
    once = (F.col("label") == F.col("main")) | (F.col("x_node") < F.col("node"))  # two strays meet twice
    before = F.lit(False)
    for k in LEAST:
        before = before | F.coalesce((F.col(k) == F.col(f"x_{k}")) & (F.col(k) < F.col("signature")), F.lit(False))
    both = stray.join(open_, "signature").filter((F.col("label") != F.col("x_label")) & once & ~before & _can_link("", "x_", percent) & _few_differ("", "x_", percent))
    return both.select("x_node", "node")


def _own(words: int, batch: pa.RecordBatch) -> Iterator[tuple[int, str, np.ndarray]]:
    """(node, text, tokens) of the rows whose text has the node's set."""
    nodes = batch.column("node").to_pylist()
    for at, texts in _text_chunks(batch):
        for i, own in enumerate(shingles(texts, words), at):
            if len(own) and node_of(own) == nodes[i]:
                yield nodes[i], texts[i - at], own


def _counted(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(node, bucket_counts(own).tobytes(), parities(own)) for node, _, own in _own(words, batch)]
            odd = np.array([r[2] for r in rows], np.int64).reshape(len(rows), len(PARITIES))
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), *map(pa.array, odd.T)], names=["node", "counts", *PARITIES])

    return run


def _texts(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(node, text) for node, text, _ in _own(words, batch)]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["node", "text"])

    return run


COUNTED_COLUMNS = "node long, counts binary, " + ", ".join(f"{p} long" for p in PARITIES)


def _fetched(docs: DataFrame, nodes: DataFrame, run, columns: str) -> DataFrame:
    """What ``run`` makes of one text of each of ``nodes`` (node, rid, again: whether that row repeats)."""

    def read(of: DataFrame) -> DataFrame:
        of = of.select("node", "rid")
        return docs.join(F.broadcast(of) if few else of, "rid").select("node", "text").mapInArrow(run, columns)

    few = nodes.count() <= BROADCAST_IDS
    out = read(nodes.filter(~F.col("again")))
    if nodes.filter("again").count():
        out = out.unionByName(read(nodes.filter("again")).dropDuplicates(["node"]))
    return out


def _possible(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = (batch.column(c).to_pylist() for c in ("a_n", "b_n", "a_counts", "b_counts"))
            for i, (a_n, b_n, a, b) in enumerate(zip(*columns, strict=True)):
                shared = most_shared(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8), min(a_n, b_n))
                if 100 * shared >= percent * (a_n + b_n - shared):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def _possible_pairs(pairs: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that can link by their bucket counts."""
    for side in ("a", "b"):
        own = counts.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n"), F.col("counts").alias(f"{side}_counts"))
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", "a_n", "b_n", "a_counts", "b_counts").mapInArrow(_possible(percent), "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    right = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
    both = right.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a").select("a", "b", "a_text", "b_text")
    return both.mapInArrow(_linked(words, percent), "a long, b long")


def _can_link(one: str, other: str, percent: int) -> Column:
    """Whether the sizes and prefixes of two nodes (columns with these beginnings) leave room for a link."""
    n, m = F.col(f"{one}n"), F.col(f"{other}n")
    left_n, left_m = n - F.col(f"{one}alone"), m - F.col(f"{other}alone")
    ends = F.col(f"{one}end"), F.col(f"{other}end")
    # of the set whose prefix ends first.  Where both hold all of their sets' rare tokens, of both;
    # two ends that are equal otherwise may stand for two tokens, so one of those isn't counted.
    both = F.least(left_n, left_m)
    shared = F.when(ends[0] < ends[1], left_n).when(ends[0] > ends[1], left_m).when(ends[0] == FARTHEST, both).otherwise(both + 1)
    shared = F.least(shared, n, m)
    return shared * 100 >= (n + m - shared) * percent


def _links(docs: DataFrame, nodes: DataFrame, counts: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The candidate pairs that link, written: first by the bound, then by their texts."""
    pairs = materialise(_possible_pairs(pairs, counts, percent), "pairs")
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = materialise(_fetched(docs, nodes.join(needed, "node", "left_semi"), _texts(words), "node long, text string"), "texts")
    return materialise(_verified(pairs, texts, words, percent), "links")


def linked_components(docs: DataFrame, words: int, percent: int, tiers: tuple = TIERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("rid"), F.col(text_col).alias("text"))
    first = materialise(docs.mapInArrow(_sets(words), "doc_id long, rid long, node long, n int, token long, count long"), "sets")
    rows = first.filter(F.col("n").isNotNull()).select("doc_id", "rid", "node", "n")
    counts = first.filter(F.col("token").isNotNull()).groupBy("token").agg(F.sum("count").alias("count"))
    counts = most_frequent(counts.filter(F.col("count") >= min(FREQUENT, tiers[0][0])), MOST_FREQUENT).toPandas()
    token = counts["token"].to_numpy(dtype=np.int64).view(np.uint64)
    count = counts["count"].to_numpy(dtype=np.int64)
    tier = sum((count >= least).astype(np.int8) for least, _ in tiers)
    level = np.floor(np.log2(np.maximum(count, 1))).astype(np.int8)
    order = np.argsort(token)
    frequent = spark.sparkContext.broadcast((token[order], tier[order], level[order]))

    signed = docs.mapInArrow(_signed(words, percent, frequent, tuple(k for _, k in tiers)), "signature long, node long, n int, common boolean, end long")
    signed = materialise(signed, "signed")
    # few members have a signature that isn't common, so one shuffle is enough; common ones are
    # aggregated before they are dealt out, and their members follow by a join
    bucket = Window.partitionBy("signature")
    rare = signed.filter("signature IS NOT NULL AND NOT common").select("signature", "node", "n")
    rare = rare.withColumn("first", F.min("node").over(bucket)).withColumn("last", F.max("node").over(bucket)).withColumn("members", F.count(F.lit(1)).over(bucket))
    common = signed.filter("signature IS NOT NULL AND common").select("signature", "node", "n").distinct()
    buckets = common.groupBy("signature").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    common = common.join(buckets.filter("first != last"), "signature").select("signature", "node", "n", "first")
    shared = rare.filter("first != last").select("signature", "node", "n", "first").unionByName(common).distinct()
    # a set in several batches has several rows in its buckets
    alone = rare.filter("first = last").groupBy("node").agg(F.max("n").alias("n"), F.round(F.sum(1 / F.col("members"))).cast("int").alias("alone"))
    shared = shared.withColumn("alone", F.lit(None).cast("int"))
    alone = alone.select(F.lit(None).cast("long").alias("signature"), "node", "n", F.lit(None).cast("long").alias("first"), "alone")
    member = materialise(shared.unionByName(alone), "members")
    alone, member = member.filter("alone IS NOT NULL").select("node", "alone"), member.filter("alone IS NULL").drop("alone")

    sizes = member.select("node").distinct().join(alone, "node", "left").join(signed.filter("signature IS NULL").select("node", "n", "end").distinct(), "node")
    sizes = materialise(sizes.select("node", "n", F.coalesce("alone", F.lit(0)).alias("alone"), "end"), "candidates")
    member = materialise(member.drop("n", "first").join(sizes, "node"), "sized")
    # a bucket's first member: the one with the fewest tokens of its own, so the most like the others
    lead = member.groupBy("signature").agg(F.min(F.struct("alone", "node"))["node"].alias("first"))
    member = materialise(member.join(lead, "signature"), "led")
    nodes = rows.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("rid").alias("rid"), F.count(F.lit(1)).alias("rows"))
    repeated = rows.groupBy("rid").count().filter("count > 1").select("rid", F.lit(True).alias("again"))
    nodes = nodes.join(repeated, "rid", "left").select("node", "doc_id", "rid", "rows", F.coalesce("again", F.lit(False)).alias("again"))
    nodes = materialise(nodes, "nodes")
    counts = _fetched(docs, nodes.join(sizes.select("node"), "node", "left_semi"), _counted(words), COUNTED_COLUMNS).join(sizes, "node")
    counts = materialise(counts.select("node", "n", "counts", *PARITIES), "counts")

    small = sizes.select(*(F.col(c).alias(f"first_{c}" if c != "node" else "first") for c in sizes.columns))
    pairs = member.filter(F.col("node") != F.col("first")).select("first", *sizes.columns).distinct().join(small, "first")
    pairs = pairs.filter(_can_link("", "first_", percent)).select(F.col("first").alias("a"), F.col("node").alias("b"))
    links = _links(docs, nodes, counts, pairs, words, percent)
    labels = components(links)

    # members of a bucket outside its largest component meet those of the others
    # both joins by node, so the members are shuffled once
    known = member.join(labels, "node", "left").join(counts.select("node", *PARITIES), "node")
    known = known.select("signature", *sizes.columns, "first", F.coalesce("label", "node").alias("label"), *PARITIES)
    known = materialise(_with_least(known), "labelled")
    per_label = known.groupBy("signature", "label").agg(F.count(F.lit(1)).alias("members"))
    split = per_label.groupBy("signature").agg(F.count(F.lit(1)).alias("labels"), F.max(F.struct("members", "label"))["label"].alias("main")).filter("labels > 1")
    open_ = known.join(split.select("signature", "main"), "signature")
    open_ = open_.filter(F.col("node") != F.col("first"))  # the first has met all others
    met = _met(open_, sizes.columns, percent)
    pairs = met.select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b")).distinct()
    more = _links(docs, nodes, counts, pairs, words, percent)
    if more.count():
        labels = components(links.unionByName(more))

    total = rows.count()
    labelled = nodes.join(labels, "node", "left").select("node", "doc_id", "rows", F.coalesce("label", "node").alias("label"))
    labelled = materialise(labelled, "classes")
    smallest = labelled.join(labels.select("label").distinct(), "label", "left_semi").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    classes = labelled.join(smallest, "label", "left").select("node", "rows", F.coalesce("component_id", "doc_id").alias("component_id"))
    with_set = join_classes(rows.filter(F.col("node").isNotNull()).drop("rid"), classes, "node", "rows", total).select("doc_id", "n", "component_id")
    without = rows.filter(F.col("node").isNull()).select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return with_set.unionByName(without).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def query(spark, sf_dir: str) -> DataFrame:
    return linked_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 90)


SQL = r"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS sh FROM d),
n AS (SELECT r, doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
e AS (SELECT r, unnest(sh) AS t FROM s),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM e AS a JOIN e AS b ON a.t = b.t AND a.r <> b.r GROUP BY a.r, b.r),
l AS (SELECT a, b FROM p JOIN n AS x ON x.r = a JOIN n AS y ON y.r = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT r AS a, r AS b FROM n UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
least AS (SELECT a, min(y.doc_id) AS component_id FROM reach JOIN n AS y ON y.r = b GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id FROM n JOIN least ON a = r
"""
