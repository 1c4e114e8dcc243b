"""Exact dedup against a minimal perfect hash over historical distinct digests.

The distinct digests of the historical and of the incoming rows are dealt to buckets of bounded
size by their first bytes.  Each bucket holds a minimal perfect hash (levels of bit arrays: a digest that
is alone at its position of a level is placed there, the others go to the next level; its
slot is the rank of its bit) and, by slot, the full digest and the locator of the group's
winner.  Incoming rows are first grouped by digest; each distinct digest looks up its slot
and compares all 32 bytes.  Members join the historical group; the others, which a perfect
hash maps to some foreign slot, fail the comparison and form groups of their own.

Defined cases: null text counts as empty; texts of white space alone are equal to the empty
text; a null id sorts after all others; a row repeated with its id is a row of the group as
any other, and all rows with the winner's id are kept; ties (equally long originals) go to the smallest id;
an empty table gives an empty result; only id and text are read, so other columns may have any
name; a very long text is hashed whole, inside the JVM.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import SPACES, join_classes, materialise, text_or_empty

#: Distinct digests of a bucket, about.
BUCKET_DIGESTS = 32_768
#: Dropped rows (id and digest, about 80 bytes) up to which they are broadcast; more are joined by shuffle.
BROADCAST_LOST = 500_000
#: Positions of a level for each digest that reaches it.
GAMMA = 2.0

GROUP = "digest binary, chars long, keep_id long, rows long"
INDEX = "bucket long, n long, sizes array<long>, bits array<binary>, digests binary, chars binary, keep_ids binary, no_id binary, rows binary"


def _mixed(words: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of the digests (as four words each) for a level."""
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    h = words[:, level % 4] + seed + (words[:, (level + 1) % 4] >> np.uint64(7))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def build_mph(digests: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Sizes and bit arrays of the levels for distinct 32-byte digests."""
    words, sizes, bits = _words(digests), [], []
    while len(words):
        size = max(64, int(GAMMA * len(words)))
        at = (_mixed(words, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone).tobytes())
        words = words[~alone[at]]
    return sizes, bits


def slots_of(digests: list[bytes], sizes: list[int], bits: list[bytes]) -> np.ndarray:
    """Slot of each digest, or -1 where no level holds a bit for it."""
    words = _words(digests)
    slots, open_, before = np.full(len(words), -1), np.arange(len(words)), 0
    for level, (size, packed) in enumerate(zip(sizes, bits, strict=True)):
        marked = np.unpackbits(np.frombuffer(packed, np.uint8), count=size)
        rank = np.cumsum(marked)
        at = (_mixed(words[open_], level) % np.uint64(size)).astype(np.int64)
        hit = marked[at] == 1
        slots[open_[hit]] = before + rank[at[hit]] - 1
        open_, before = open_[~hit], before + int(rank[-1])
    return slots


def _longs(values) -> bytes:
    return np.asarray(values, dtype="<i8").tobytes()


def _index_of(key: tuple, groups: pd.DataFrame) -> pd.DataFrame:
    digests = [bytes(d) for d in groups["digest"]]
    sizes, bits = build_mph(digests)
    order = np.argsort(slots_of(digests, sizes, bits))
    own = groups.iloc[order]
    row = {
        "bucket": key[0],
        "n": len(own),
        "sizes": sizes,
        "bits": bits,
        "digests": b"".join(bytes(d) for d in own["digest"]),
        "chars": _longs(own["chars"]),
        "keep_ids": _longs(own["keep_id"].fillna(0).astype("int64")),
        "no_id": own["keep_id"].isna().to_numpy(dtype=np.uint8).tobytes(),
        "rows": _longs(own["rows"]),
    }
    return pd.DataFrame([row])


def _rank(chars: int, keep_id: int | None) -> tuple:
    """Winners compare by this, smallest first."""
    return (-chars, keep_id is None, keep_id or 0)


def _merged(incoming: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """All groups of a bucket: historical ones with their incoming members, then the others."""
    new = list(zip((bytes(d) for d in incoming["digest"]), incoming["chars"].tolist(), (None if pd.isna(x) else int(x) for x in incoming["keep_id"]), incoming["rows"].tolist(), strict=True))
    out = []
    if len(index):
        x = index.iloc[0]
        digests, chars, ids, rows = bytes(x["digests"]), *(np.frombuffer(x[c], "<i8").tolist() for c in ("chars", "keep_ids", "rows"))
        ids = [None if no else i for i, no in zip(ids, bytes(x["no_id"]), strict=True)]
        slots = slots_of([d for d, *_ in new], list(x["sizes"]), [bytes(b) for b in x["bits"]]) if new else []
        rest = []
        for slot, (digest, c, i, r) in zip(slots, new, strict=True):
            if slot >= 0 and digests[32 * slot : 32 * slot + 32] == digest:
                rows[slot] += r
                chars[slot], ids[slot] = min(((chars[slot], ids[slot]), (c, i)), key=lambda g: _rank(*g))
            else:
                rest.append((digest, c, i, r))
        out = [(digests[32 * s : 32 * s + 32], chars[s], ids[s], rows[s], True) for s in range(len(ids))]
        new = rest
    out += [(*g, False) for g in new]
    frame = pd.DataFrame(out, columns=["digest", "chars", "keep_id", "rows", "historical"])
    return frame.astype({"keep_id": "Int64"})


def group_rows(rows: DataFrame) -> DataFrame:
    """One row per digest: the winner's length and id, and the number of rows."""
    best = F.min(F.struct((-F.col("chars")).alias("neg"), F.col("doc_id").isNull().alias("none"), "doc_id"))
    found = rows.groupBy("digest").agg(best.alias("w"), F.count(F.lit(1)).alias("rows"))
    return found.select("digest", (-F.col("w.neg")).alias("chars"), F.col("w.doc_id").alias("keep_id"), "rows")


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    head = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long")
    return groups.withColumn("bucket", F.pmod(head, F.lit(buckets)))


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket of the historical groups (``group_rows``)."""
    return _bucketed(history, buckets).groupBy("bucket").applyInPandas(_index_of, INDEX)


def probe(incoming: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """All groups after the incoming ones (``group_rows``) met the index: GROUP and ``historical``."""
    return _bucketed(incoming, buckets).groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(_merged, GROUP + ", historical boolean")


def exact_dedup(docs: DataFrame, is_history: Column | None = None, id_col: str = "doc_id", text_col: str = "text", bucket_digests: int = BUCKET_DIGESTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``is_history`` marks the rows whose digests are indexed first; by default the rows whose id
    has an even CRC-32.  The groups are the same whatever it marks.
    """
    if is_history is None:
        is_history = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 2 == 0
    text = text_or_empty(text_col)
    digest = F.unhex(F.sha2(F.translate(text, SPACES, ""), 256))
    rows = materialise(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), digest.alias("digest"), F.length(text).cast("long").alias("chars"), F.coalesce(is_history, F.lit(False)).alias("old")),
        "digests",
    )
    total = rows.count()
    history = materialise(group_rows(rows.filter("old")), "history")
    incoming = materialise(group_rows(rows.filter(~F.col("old"))), "incoming")
    # of the larger side, as a task holds a bucket's digests of both
    buckets = max(1, -(-max(history.count(), incoming.count()) // bucket_digests))
    index = materialise(build_index(history, buckets), "mph")
    groups = materialise(probe(incoming, index, buckets), "groups")
    joined = join_classes(rows.select("doc_id", "digest"), groups.select("digest", "keep_id", "rows", "historical"), "digest", "rows", total)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return joined.select("doc_id", "keep_id", F.col("rows").alias("group_size"), kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def keep_winners(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per group of equal texts, with all its columns."""
    judged = materialise(exact_dedup(docs).select("doc_id", "kept", "text_sha256"), "judged")
    columns = docs.columns
    sha = F.sha2(F.translate(text_or_empty("text"), SPACES, ""), 256)
    keyed = docs.withColumn("_llm_sha", sha)
    lost = judged.filter(~F.col("kept")).select(F.col("doc_id").alias("_llm_id"), F.col("text_sha256").alias("_llm_of")).distinct()
    lost = materialise(lost, "lost")
    n_lost = lost.count()
    same = F.col("doc_id").eqNullSafe(F.col("_llm_id")) & (F.col("_llm_sha") == F.col("_llm_of"))
    kept = keyed.join(F.broadcast(lost) if n_lost <= BROADCAST_LOST else lost, same, "left_anti")
    # rows repeated with id and text: all are the winner; one stays
    again = judged.filter("kept").groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("text_sha256").alias("_llm_sha"))
    again = materialise(again, "again")
    if again.count():
        kept = kept.join(again, "_llm_sha", "left_anti").unionByName(kept.join(again, "_llm_sha", "left_semi").dropDuplicates(["_llm_sha"]))
    return kept.select(*columns)


def query(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT text_sha256, arg_min(doc_id, (-chars, doc_id)) AS keep_id, count(*) AS group_size
  FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN w USING (text_sha256)
"""
