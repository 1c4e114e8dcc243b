"""The whole pipeline against plain versions of its stages, and the classifier's solver against a plain one."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import regex
import tokenizers

import corpus_pipeline
from clickmart.llm import nbsvm
from clickmart.llm.common import materialise
from tests.conftest import SF_SMALL
from tests.llm.test_similarity import plain_leaks
from tests.llm.test_tokens_packing_pii import check_packing

SPACES = str.maketrans("", "", " \t\n\v\f\r")


def plain_scores(model, rows):
    """Scores from the model's numbers, one text and feature after another."""
    ratios, weights, offset, slope, shift = model
    out = {}
    for i, text in rows:
        b = (text or "").encode()
        grams = {b[k : k + nbsvm.NGRAM] for k in range(len(b) - nbsvm.NGRAM + 1)}
        found = {(int.from_bytes(g, "big") * 2654435761 % 2**32) >> (32 - nbsvm.FEATURES.bit_length() + 1) for g in grams}
        longest = run = 1
        words = (text or "").split()
        for one, other in zip(words, words[1:], strict=False):
            run = run + 1 if one == other else 1
            longest = max(longest, run)
        found |= {nbsvm.FEATURES + k for k, n in enumerate(nbsvm.REPEATS) if n <= longest}
        length = sum(float(np.float32(ratios[f])) ** 2 for f in found) ** 0.5
        margin = sum(float(np.float32(weights[f])) * float(np.float32(ratios[f])) for f in found) / max(1e-9, length) + offset
        out[i] = 1 / (1 + np.exp(-(slope * margin + shift)))
    return out


def plain_near(rows):
    """Groups at five words and 80 percent by comparing all pairs; the smallest id of each stays."""

    def shingles(t):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ")
        w = [x for x in w if x]
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for k, a in enumerate(sets):
        for j in range(k):
            shared = len(a & sets[j])
            if a and 100 * shared >= 80 * (len(a) + len(sets[j]) - shared):
                one, other = root(k), root(j)
                label[max(one, other)] = min(one, other)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(root(k), []).append(rows[k])
    return [min(g) for g in groups.values()]


def leaks_of(rows, items):
    """``plain_leaks`` of the rows and items that share a run of five words; no others can leak."""

    def runs(t):
        w = regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    known = [(i, t, runs(t)) for i, t in items]
    out = set()
    for i, t in rows:
        own = runs(t)
        out |= plain_leaks([(i, t)], [(k, u) for k, u, r in known if r & own])
    return out


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_run_against_plain_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    rows, frame = pairs(docs), docs

    scores = plain_scores(nbsvm.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet")), rows)
    rows = [r for r in rows if scores[r[0]] >= 0.3]
    frame = materialise(stages["quality"](spark, frame, SF_SMALL), "quality")
    assert pairs(frame) == rows and 0 < len(rows) < 200

    best = {}
    for i, t in rows:
        key = (-len(t or ""), i)
        own = (t or "").translate(SPACES)
        best[own] = min(best.get(own, key), key)
    keep = {i for _, i in best.values()}
    rows = [r for r in rows if r[0] in keep]
    frame = materialise(stages["exact"](spark, frame, SF_SMALL), "exact")
    assert pairs(frame) == rows

    rows = sorted(plain_near(rows))
    frame = materialise(stages["near"](spark, frame, SF_SMALL), "near")
    assert pairs(frame) == rows

    leaking = {i for i, _, _ in leaks_of(rows, benchmark)}
    assert leaking
    rows = [r for r in rows if r[0] not in leaking]
    frame = materialise(stages["clean"](spark, frame, SF_SMALL), "clean")
    assert pairs(frame) == rows

    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = stages["packed"](spark, frame, SF_SMALL).collect()
    check_packing(packed, rows, tokenizer)
    # run() applies the same stages
    ran = corpus_pipeline.run(spark, SF_SMALL).collect()
    check_packing(ran, rows, tokenizer)


def test_dual_descent_against_projected_gradient():
    """The same objective, minimised by projected gradient steps on the whole dual."""
    rng = np.random.default_rng(2)
    n, d, cost = 120, 60, 1.0
    labels = rng.choice([-1, 1], n)
    rows = [np.unique(np.r_[rng.integers(0, d - 10, 6), rng.choice([d - 10 + (y > 0), d - 9 - (y > 0)], p=[0.8, 0.2])]).astype(np.uint32) for y in labels]
    zeros, ones = np.zeros(d), np.zeros(d)
    for r, y in zip(rows, labels, strict=True):
        (ones if y > 0 else zeros)[r] += 1
    ratios = nbsvm.log_count_ratios(zeros, ones)
    x = np.zeros((n, d + 1))
    for i, r in enumerate(rows):
        x[i, r] = ratios[r] / np.sqrt(np.square(ratios[r]).sum())
    x[:, d] = 1  # the offset

    def objective(w):
        return 0.5 * w @ w + cost * np.maximum(0, 1 - labels * (x @ w)).sum()

    q = (x * labels[:, None]) @ (x * labels[:, None]).T
    alpha, step = np.zeros(n), 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(20_000):
        alpha = np.clip(alpha - step * (q @ alpha - 1), 0, cost)
    want = (alpha * labels) @ x
    for epochs, slack in ((nbsvm.EPOCHS, 1.05), (300, 1.0005)):
        w, offset = nbsvm.dual_descent(rows, labels, ratios, epochs, cost, 0)
        assert objective(np.r_[w, offset]) <= slack * objective(want)
    assert np.abs(np.r_[w, offset] - want).max() < 0.02
