"""Byte-balanced shards by Karmarkar-Karp differencing.

Indivisible items are groups of rows with equal texts.  Each task turns its share of the items
into one partial partition of k sums: it repeatedly takes the two partial partitions with the
largest spread and adds them oppositely ordered (largest bin onto smallest).  The partial
partitions of all tasks are then combined by the same rule, k sums each, which gives every bin
of every task its shard.

A group with more bytes than one shard's fair share can't be balanced whole by any method; its
rows are cut, by a hash of their number, into pieces of about a quarter of a fair share, and the
result says so (``cut``).  There are fewer such groups than shards.  All others stay whole.

Defined cases: null text has no bytes (a row's size is then the fixed overhead) and the group
of the empty text; repeated rows are rows of one group, told apart by a number written with them;
an empty table gives an empty result; ties (equal bytes) go by digest; only id and text are read,
so other columns may have any name; a very long text is one row's size.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickmart.llm.common import join_classes, materialise, text_or_empty

#: Bytes that a row has besides its text.
ROW_BYTES = 16
#: Items of a task, about, and the most tasks: the last combination sees at most MOST_TASKS * shards sums.
TASK_ITEMS = 50_000
MOST_TASKS = 16_384
#: Rows of a numbering window, about.
SLOT_ROWS = 50_000


def combine(a: tuple[list, list], b: tuple[list, list], k: int) -> tuple[list, list]:
    """Two partial partitions (sums descending, members by bin) added oppositely ordered."""
    sums, members = list(a[0]), list(a[1])
    for j, (s, m) in enumerate(zip(*b, strict=True)):
        at = k - 1 - j
        if at < len(a[0]):
            sums[at] += s
            x, y = members[at], m
            if len(x) < len(y):
                x, y = y, x
            x.extend(y)
            members[at] = x
        else:
            sums.append(s)
            members.append(m)
    order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
    return [sums[i] for i in order], [members[i] for i in order]


def difference(partials: list[tuple[list, list]], k: int) -> tuple[list, list]:
    """All partial partitions combined into one, largest spreads first."""

    def spread(p: tuple[list, list]) -> int:
        return p[0][0] - (p[0][-1] if len(p[0]) == k else 0)

    heap = [(-spread(p), i, p) for i, p in enumerate(partials)]
    heapq.heapify(heap)
    serial = len(heap)
    while len(heap) > 1:
        first, second = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        p = combine(first, second, k)
        heapq.heappush(heap, (-spread(p), serial, p))
        serial += 1
    return heap[0][2] if heap else ([], [])


def _local(k: int):
    def run(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["bytes", "digest", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        sums, members = difference([([s], [[i]]) for i, s in enumerate(items["bytes"].tolist())], k)
        bins = [0] * len(items)
        for b, own in enumerate(members):
            for i in own:
                bins[i] = b
        return items.assign(bin=bins)[["digest", "piece", "bytes", "n", "task", "bin"]]

    return run


def _last(k: int):
    def run(sums: pd.DataFrame) -> pd.DataFrame:
        partials = []
        for task, own in sums.sort_values(["task", "bytes"], ascending=[True, False]).groupby("task", sort=True):
            partials.append((own["bytes"].tolist(), [[(task, b)] for b in own["bin"].tolist()]))
        _, members = difference(partials, k)
        return pd.DataFrame([(t, b, s) for s, own in enumerate(members) for t, b in own], columns=["task", "bin", "shard"])

    return run


def shards(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard (0 to k - 1), slot, grown_shard (null), cut."""
    text = text_or_empty(text_col)
    size = (F.octet_length(text) + ROW_BYTES).cast("long")
    rows = materialise(docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"), size.alias("size"), F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("row")), "sizes")
    n_rows, all_bytes = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()

    # the groups over a fair share: fewer than k
    large = rows.groupBy("digest").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") * k > all_bytes)
    large = F.broadcast(large.select("digest", F.ceil(F.col("bytes") * 4 * k / F.lit(float(max(1, all_bytes)))).cast("int").alias("pieces")))
    piece = F.pmod(F.xxhash64("row"), F.coalesce("pieces", F.lit(1))).cast("int")
    rows = rows.join(large, "digest", "left").withColumn("piece", piece).withColumn("cut", F.col("pieces").isNotNull()).drop("pieces")

    items = materialise(rows.groupBy("digest", "piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "items")
    n_items = items.count()
    tasks = max(1, min(MOST_TASKS, -(-n_items // TASK_ITEMS)))
    items = items.withColumn("task", F.pmod(F.xxhash64("digest", "piece"), F.lit(tasks)).cast("int"))
    placed = materialise(items.groupBy("task").applyInPandas(_local(k), "digest binary, piece int, bytes long, n long, task int, bin int"), "placed")
    sums = placed.groupBy("task", "bin").agg(F.sum("bytes").alias("bytes"))
    shard = sums.groupBy(F.lit(0).alias("all")).applyInPandas(_last(k), "task int, bin int, shard int")
    placed = placed.join(F.broadcast(shard), ["task", "bin"]).select("digest", "piece", "n", "shard")

    parts = max(1, -(-n_rows // (k * SLOT_ROWS)))
    part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    # a group of many small rows, such as empty texts, is far below a fair share of bytes
    rows = join_classes(rows, placed, ["digest", "piece"], "n", n_rows)
    rows = materialise(rows.select("doc_id", "size", "text_crc32", "cut", "row", "shard", part.alias("part")), "sharded")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size", "row"))
    slots = rows.withColumn("number", number).join(counts, ["shard", "part"])
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("before") + F.col("number") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "cut",
    )


def query(spark, sf_dir: str) -> DataFrame:
    return shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), 40)
