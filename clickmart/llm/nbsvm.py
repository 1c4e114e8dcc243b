"""Quality classifier: a linear support vector machine on naive Bayes features.

Features are indicators of a text's byte n-grams (NGRAM bytes, case kept), hashed to FEATURES
positions, and of n-grams of one word repeated, whatever the word (one position for each length
in REPEATS).  Each indicator is scaled by its class log-count ratio over the labelled sample, the
vectors are scaled to unit length, and a linear model with hinge loss is fitted by dual
coordinate descent.  The sample is dealt to shards, each shard is fitted by itself and the
weights are averaged; margins of a shard's rows under the other shards' models calibrate the
score (a logistic curve).

Only the fit uses a sample: at most SAMPLE_ROWS labelled rows, the first by a hash of their id.
Every row is scored, on its whole text.

Defined cases: null text counts as empty; a text shorter than an n-gram has no features and
gets the score of the model's offset; ids labelled twice count with the lower label; without
labels of both classes the score is the share of label 1 (0.5 without any label); repeated rows
are scored each for itself, and count in the fit as often as they are there; a score of exactly
the threshold is accepted; an empty table gives an empty result; of the documents only id and
text are read, so other columns may have any name; a very long text is one vector of at most
FEATURES indicators.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import materialise

NGRAM = 3
FEATURES = 1 << 18
#: Lengths of the n-grams of one repeated word; their features follow the hashed ones.
REPEATS = (2, 3, 4, 6, 9)
SPACE = FEATURES + len(REPEATS)
#: Bound of the labelled sample that the model is fitted on.
SAMPLE_ROWS = 20_000
SHARDS = 4
EPOCHS = 12
#: Cost of the hinge loss.
COST = 1.0
#: Added to each count of the log-count ratios.
SMOOTHING = 1.0


def features(text: str, mark: np.ndarray) -> np.ndarray:
    """Distinct features of a text; ``mark`` is scratch space of FEATURES integers."""
    longest = run = 1
    words = text.split()
    for a, b in zip(words, words[1:], strict=False):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    repeats = np.arange(FEATURES, FEATURES + bisect.bisect_right(REPEATS, longest), dtype=np.uint32)
    b = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
    n = len(b) - NGRAM + 1
    if n <= 0:
        return repeats
    code = np.zeros(n, np.uint32)
    for i in range(NGRAM):
        code = (code << np.uint32(8)) | b[i : i + n]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - FEATURES.bit_length() + 1)
    at = np.arange(n, dtype=np.int32)
    mark[code] = at
    return np.concatenate((code[mark[code] == at], repeats))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mark = np.zeros(FEATURES, np.int32)
    for batch in batches:
        found = [np.sort(features(t.as_py() or "", mark)).tobytes() for t in batch.column("text")]
        yield pa.record_batch([batch.column("doc_id"), batch.column("label"), pa.array(found, pa.binary())], names=["doc_id", "label", "features"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, SPACE), np.int64)
    for batch in batches:
        for label, own in zip(batch.column("label").to_pylist(), batch.column("features").to_pylist(), strict=True):
            counts[label, np.frombuffer(own, np.uint32)] += 1
    seen = np.flatnonzero(counts.any(axis=0))
    yield pa.record_batch([pa.array(seen), pa.array(counts[0, seen]), pa.array(counts[1, seen])], names=["feature", "zeros", "ones"])


def log_count_ratios(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    p, q = ones + SMOOTHING, zeros + SMOOTHING
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, epochs: int, cost: float, seed: int) -> tuple[np.ndarray, float]:
    """Weights and offset that minimise the regularised hinge loss; labels are -1 and 1."""
    w, offset, alpha = np.zeros(len(ratios)), 0.0, np.zeros(len(rows))
    scale = [1 / max(1e-9, float(np.sqrt(np.square(ratios[r]).sum()))) for r in rows]
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            r, y = rows[i], labels[i]
            x = ratios[r] * scale[i]
            gradient = y * (w[r] @ x + offset) - 1
            # the square of a row's length: one, and one for the offset
            new = min(max(alpha[i] - gradient / 2, 0.0), cost)
            if new != alpha[i]:
                step = (new - alpha[i]) * y
                w[r] += step * x
                offset += step
                alpha[i] = new
    return w, offset


def _fitted(ratios, epochs: int, cost: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", ignore_index=True)
        found = [np.frombuffer(bytes(f), np.uint32) for f in rows["features"]]
        w, offset = dual_descent(found, rows["label"].to_numpy() * 2 - 1, ratios.value, epochs, cost, int(key[0]))
        return pd.DataFrame({"shard": [key[0]], "weights": [w.astype("<f8").tobytes()], "offset": [offset]})

    return run


def margin(found: np.ndarray, weights: np.ndarray, ratios: np.ndarray, offset: float) -> float:
    r = ratios[found]
    return float(weights[found] @ r) / max(1e-9, float(np.sqrt(r @ r))) + offset


def _margins(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios, weights, offsets = model.value
        for batch in batches:
            found = [np.frombuffer(f, np.uint32) for f in batch.column("features").to_pylist()]
            out = [margin(f, weights[s], ratios, offsets[s]) for f, s in zip(found, batch.column("shard").to_pylist(), strict=True)]
            yield pa.record_batch([batch.column("label"), pa.array(out, pa.float64())], names=["label", "margin"])

    return run


def logistic(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the curve that gives the labels' probabilities from margins."""
    x, theta = np.c_[margins, np.ones(len(margins))], np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (p - labels) + 1e-3 * theta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), gradient)
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def _scores(texts: pa.Array, model: tuple) -> np.ndarray:
    ratios, weights, offset, slope, shift = model
    mark = np.zeros(FEATURES, np.int32)
    m = np.array([margin(features(t.as_py() or "", mark), weights, ratios, offset) for t in texts], dtype=np.float64)
    return 1 / (1 + np.exp(-np.clip(slope * m + shift, -700, 700)))


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(_scores(batch.column("text"), model.value), pa.float64())
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), score], names=["doc_id", "held_out", "score"])

    return run


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> tuple:
    """(ratios, weights, offset, slope, shift) from the sample of the labelled rows."""
    sc = docs.sparkSession.sparkContext
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
    known = known.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known.select(F.col("doc_id").cast("long").alias("doc_id"), "label")), "doc_id")
    rows = materialise(rows.mapInArrow(_sampled, "doc_id long, label int, features binary"), "sample")
    zeros, ones, classes = np.zeros(SPACE), np.zeros(SPACE), {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    if len(classes) < 2:
        share = classes.get(1, 0) / sum(classes.values()) if classes else 0.5
        none = np.zeros(SPACE, np.float64)
        return none, none, 0.0, 1.0, float(np.log((share + 1e-9) / (1 - share + 1e-9)))
    counts = rows.mapInArrow(_counted, "feature long, zeros long, ones long").groupBy("feature").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toPandas()
    zeros[counts["feature"]], ones[counts["feature"]] = counts["zeros"], counts["ones"]
    ratios = log_count_ratios(zeros, ones)

    shard = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(SHARDS)).cast("int").alias("shard")
    models = rows.select("*", shard).groupBy("shard").applyInPandas(_fitted(sc.broadcast(ratios), EPOCHS, COST), "shard int, weights binary, offset double").collect()
    weights = {m["shard"]: np.frombuffer(bytes(m["weights"]), "<f8") for m in models}
    offsets = {m["shard"]: m["offset"] for m in models}

    def average(of: list[int]) -> tuple[np.ndarray, float]:
        return np.mean([weights[s] for s in of], axis=0), float(np.mean([offsets[s] for s in of]))

    others = {s: average([t for t in weights if t != s] or [s]) for s in weights}
    model = sc.broadcast((ratios, {s: x[0] for s, x in others.items()}, {s: x[1] for s, x in others.items()}))
    seen = rows.select("*", shard).mapInArrow(_margins(model), "label int, margin double").toPandas()
    slope, shift = logistic(seen["margin"].to_numpy(), seen["label"].to_numpy())
    return ratios, *average(list(weights)), slope, shift


def score(docs: DataFrame, model: tuple, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    ratios, weights, offset, slope, shift = model
    shared = docs.sparkSession.sparkContext.broadcast((ratios.astype("<f4"), weights.astype("<f4"), offset, slope, shift))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(_scored(shared), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_accepted(docs: DataFrame, model: tuple, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the model accepts, with all their columns; no shuffle."""
    ratios, weights, offset, slope, shift = model
    shared = docs.sparkSession.sparkContext.broadcast((ratios.astype("<f4"), weights.astype("<f4"), offset, slope, shift))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = docs_columns.index(text_col)
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(at), shared.value) >= threshold))

    docs_columns = docs.columns
    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
