"""Benchmark decontamination by SimHash of item-sized windows, with DataFrame functions alone.

A benchmark item of n words has n - 4 shingles of five words (letters and digits, lower case).
A document leaks it where a window of n words has weighted-shingle similarity THRESHOLD or more
with it: the sum over shingles of the smaller count, divided by that of the larger one.

1. Windows.  A window of W shingles that similar shares at least need = ceil(t (W + n - 4) / (1 + t))
   of them with its item (W = n - 4, or fewer where the document is shorter than the item), and
   moving its start to its first shared shingle loses none.  So windows start
   where a document's shingle is one of the item's and the need-th next such shingle is still
   inside (and at the last place where a window fits); no other window can reach the threshold.
2. Fingerprints.  Shingles are numbered by occurrence, so that the second of a kind is an element
   of its own: weighted similarity then is that of plain sets, and a repeated word doesn't move a
   bit again and again.  A window's and an item's SimHash sums, for each of 64 bits, +1 or -1 per
   element and keeps the sign.
3. Multi-index.  The bits are cut into RADIUS + 1 blocks of two or three bits; two fingerprints
   within RADIUS agree in one block at least, so an equi-join on (item, block, value) finds all
   of them, and the number of differing bits confirms them.  A leak at the threshold differs in 8
   to 12 bits on average, an unrelated window in 32: of simulated leaks at similarity 0.8 (3000
   for each item size from 1 to 400 shingles, the worst of all sizes of the window) at least
   0.9997 are within the radius, whether the rest is distinct or one word repeated.
4. The exact similarity decides.

Defined cases: null or empty texts and documents or items under five words leak nothing; a
document shorter than an item is one window; repeated rows are found once each; an empty
benchmark or table gives an empty result; of several windows the most similar, then first, stands
for a row and item; only id and text are read, so other columns may have any name; a very long
text's windows grow with its shared shingles, the numbering of repeats inside a window with the
square of the item's length.  Rows are told apart by a hash of id and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import materialise, text_or_empty

SHINGLE = 5
THRESHOLD = 0.8
BITS = 64
#: Lowest bit of each half of a long.
HALVES = 1 << 32 | 1
#: Differing bits of two fingerprints, at most.
RADIUS = 23
#: Shingles of the benchmark, and windows, up to which they are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 500_000


def _words(column: str) -> Column:
    return F.filter(F.split(F.lower(text_or_empty(column)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


#: Hashes of the shingles of the array column ``words``.
SHINGLES = f"""CASE WHEN size(words) >= {SHINGLE}
  THEN transform(sequence(0, size(words) - {SHINGLE}), i -> xxhash64({", ".join(f"words[i + {j}]" for j in range(SHINGLE))}))
  ELSE array() END"""

#: The array column ``own`` with its elements numbered by occurrence.
NUMBERED = """CASE WHEN size(array_distinct(own)) = size(own) THEN transform(own, h -> xxhash64(h, 1))
  ELSE transform(own, (h, i) -> xxhash64(h, size(filter(slice(own, 1, i + 1), x -> x = h)))) END"""

#: SimHash of the array column ``numbered``, row by row; ``fingerprints`` gives the same by aggregation.
FINGERPRINT = f"""aggregate(sequence(0, {BITS - 1}), 0L, (f, b) -> f |
  CASE WHEN aggregate(numbered, 0, (s, h) -> s + CAST(shiftright(h, b) & 1L AS INT) * 2 - 1) > 0 THEN shiftleft(1L, b) ELSE 0L END)"""


def fingerprints(windows: DataFrame, key: list[str]) -> DataFrame:
    """``key`` and SimHash (``fingerprint``) of the array column ``numbered``; ``key`` is unique, no array empty.

    A row per element, aggregated: sum i of HALVES counts bit i in its lower 32 bits and bit
    i + 32 in its upper ones.  A window's elements lie in one task, so windows are shuffled, not
    elements.
    """
    each = windows.select(*key, F.explode("numbered").alias("h"))
    halves = [F.expr(f"sum(shiftrightunsigned(h, {i}) & {HALVES}L)").alias(f"s{i}") for i in range(BITS // 2)]
    sums = each.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *halves)
    count = {i: f"(s{i} & 4294967295L)" for i in range(BITS // 2)} | {i + BITS // 2: f"shiftrightunsigned(s{i}, 32)" for i in range(BITS // 2)}
    bits = [f"CASE WHEN 2 * {count[b]} > n THEN shiftleft(1L, {b}) ELSE 0L END" for b in range(BITS)]
    # in groups, as an operator's arguments nest
    parts = ["(" + " | ".join(f"({x})" for x in bits[i : i + 8]) + ")" for i in range(0, BITS, 8)]
    return sums.select(*key, F.expr(" | ".join(parts)).alias("fingerprint"))


def blocks(radius: int) -> str:
    """(block, value) pairs of ``fingerprint``, radius + 1 of them."""
    cuts = [(BITS * i // (radius + 1), BITS * (i + 1) // (radius + 1)) for i in range(radius + 1)]
    parts = [f"struct({i} AS block, shiftrightunsigned(fingerprint, {a}) & {(1 << (b - a)) - 1}L AS value)" for i, (a, b) in enumerate(cuts)]
    return f"array({', '.join(parts)})"


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` and item that it leaks: doc_id, item_id, start (word), words, differing_bits, similarity.

    ``benchmark``: item_id, text.  Of several windows the most similar, then first, is returned.
    """
    items = benchmark.select("item_id", _words("text").alias("words")).select("item_id", F.size("words").alias("long"), F.expr(SHINGLES).alias("own"))
    items = items.filter(F.col("long") >= SHINGLE).dropDuplicates(["item_id", "own"]).withColumn("item", F.xxhash64("item_id", "own"))
    items = materialise(items.withColumn("numbered", F.expr(NUMBERED)), "items")
    item_prints = materialise(fingerprints(items, ["item"]), "item-prints")
    n_items = items.count()
    shingles = items.select("item", "long", F.explode(F.array_distinct("own")).alias("hash"))

    rows = docs.select(F.xxhash64(F.col(id_col), text_or_empty(text_col)).alias("rid"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    hashed = rows.select("rid", _words("text").alias("words")).select("rid", F.size("words").alias("size"), F.expr(SHINGLES).alias("own"))
    # outer: an inner explode adds a filter on the array's size, which would compute the array again below
    hits = hashed.select("rid", "size", F.posexplode_outer("own").alias("at", "hash")).join(_small(shingles, shingles.count()), "hash")
    hits = hits.groupBy("rid", "item").agg(F.sort_array(F.collect_set("at")).alias("at"), F.first("size").alias("size"), F.first("long").alias("long"))
    both = F.least("size", "long") + F.col("long") - 2 * (SHINGLE - 1)
    hits = hits.withColumn("need", F.ceil(F.lit(threshold / (1 + threshold)) * both - 1e-9).cast("int"))
    hits = hits.filter(F.size("at") >= F.col("need"))
    starts = f"""array_union(
      transform(filter(sequence(0, size(at) - need), j -> at[j + need - 1] <= at[j] + long - {SHINGLE}), j -> greatest(0, least(at[j], size - long))),
      CASE WHEN at[size(at) - 1] >= size - long THEN array(greatest(0, size - long)) ELSE array() END)"""
    windows = hits.select("rid", "item", "long", F.explode_outer(F.array_distinct(F.expr(starts))).alias("start")).filter(F.col("start").isNotNull())
    windows = materialise(windows, "windows")
    per_row = windows.groupBy("rid").agg(F.collect_set(F.struct("item", "long", "start")).alias("windows"))

    found = rows.join(_small(per_row, windows.count()), "rid").select("doc_id", "windows", _words("text").alias("words"), F.monotonically_increasing_id().alias("row"))
    found = found.select("doc_id", "row", "windows", F.expr(SHINGLES).alias("shingles"))
    found = found.select("doc_id", "row", "shingles", F.explode("windows").alias("w")).select("doc_id", "row", F.col("w.item").alias("item"), "w.long", "w.start", F.expr(f"slice(shingles, w.start + 1, w.long - {SHINGLE - 1})").alias("own"))
    found = materialise(found.withColumn("numbered", F.expr(NUMBERED)).drop("own"), "elements")
    prints = materialise(fingerprints(found, ["row", "item", "start"]), "fingerprints")

    cut = F.explode(F.expr(blocks(radius))).alias("b")
    left = prints.select("row", "item", "start", "fingerprint", cut).select("row", "item", "start", "fingerprint", "b.block", "b.value")
    right = item_prints.select("item", F.col("fingerprint").alias("item_print"), cut).select("item", "item_print", "b.block", "b.value")
    bits = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))).alias("differing_bits")
    near = left.join(_small(right, n_items * (radius + 1)), ["item", "block", "value"]).select("row", "item", "start", bits)
    near = near.filter(F.col("differing_bits") <= radius).distinct()

    known = items.select("item", "item_id", F.col("numbered").alias("of"))
    pairs = found.join(near, ["row", "item", "start"]).join(known, "item")
    shared = F.size(F.array_intersect("numbered", "of"))
    pairs = pairs.withColumn("shared", shared).withColumn("similarity", F.col("shared") / (F.size("numbered") + F.size("of") - F.col("shared")))
    pairs = pairs.filter(F.col("similarity") >= threshold)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), F.col("long").alias("words"), "differing_bits", "doc_id")).alias("best")
    pairs = pairs.groupBy("row", "item", "item_id").agg(best)
    return pairs.select("best.doc_id", "item_id", (-F.col("best.before")).alias("start"), "best.words", "best.differing_bits", "best.similarity")


def query(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
