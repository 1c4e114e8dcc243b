"""Repeated passages, the n-gram join, decontamination, the classifier and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from clickmart.llm import bwt_dedup, components, decontaminate, nbsvm, ngram_join, rolling
from tests.conftest import SF_SMALL
from tests.llm.fixtures import documents, edge_rows, prose


# ---- rolling hashes
def test_sliding_min():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 50, 137):
        for w in (1, 2, 7, 50):
            x = rng.integers(0, 1000, n).astype(np.uint64)
            assert rolling.sliding_min(x, w).tolist() == [min(x[i : i + w]) for i in range(n - w + 1)]


def test_shingle_hashes():
    texts = ["", " ", "a", "A b", "a  b\nc", "a b c d", "a b c a b c a b c", "é É"]
    got = rolling.shingles(texts, 3)
    assert [len(x) for x in got] == [0, 0, 1, 1, 1, 2, 3, 1]
    assert rolling.shingles(["a b"], 3)[0].tolist() == got[3].tolist()
    assert rolling.shingles(["A B C d"], 3)[0].tolist() == got[5].tolist()


# ---- repeated passages
def plain_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, texts, strict=True):
        cover = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                cover[p] += 1
                cover[p + length] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i or -1, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found_repeats(df):
    return sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
def test_repeated_windows(seed):
    for k in range(60):
        rng = random.Random(seed * 1000 + k)
        length = rng.choice([3, 5, 8, 20])
        contexts = [bytes(rng.choice(b"ab" if rng.random() < 0.8 else b"abcd\0\xff") for _ in range(rng.randint(length, 60))) for _ in range(rng.randint(1, 8))]
        count = Counter(c[p : p + length] for c in contexts for p in range(len(c) - length + 1))
        want = [p + length <= len(c) and count[c[p : p + length]] > 1 for c in contexts for p in range(len(c) + 1)]
        assert bwt_dedup.repeated_windows(contexts, length).tolist() == want


def repeat_rows():
    rng = random.Random(4)
    shared = prose(rng, 60)
    return edge_rows() + [(200 + i, prose(rng, rng.randint(0, 30)) + " " + shared[rng.randint(0, 50) :] + prose(rng, rng.randint(0, 30))) for i in range(25)] + [(300, "ab " * 500), (301, "ab " * 300 + "c")]


@pytest.mark.parametrize("wide, hot", [(16_384, 1_000_000), (2, 1_000_000), (16_384, 3), (2, 3)])
def test_repeated_passages(spark, wide, hot):
    """Blocks, single windows of wide anchors, and anchors with many occurrences give the same result."""
    rows = [(i, t if t is None or len(t) < 5000 else t[:5000]) for i, t in repeat_rows()]
    got = found_repeats(bwt_dedup.remove_repeats(documents(spark, rows), 40, 16, wide=wide, hot_rows=hot))
    assert got == plain_repeats(rows, 40)


def test_repeated_passages_at_full_length(spark):
    rows = repeat_rows()
    assert found_repeats(bwt_dedup.remove_repeats(documents(spark, rows))) == plain_repeats(rows, 200)


# ---- n-gram join
def plain_sets(rows, words):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        out.append((i, {tuple(w[j : j + words]) for j in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}))
    return out


def plain_components(rows, words, percent):
    sets = plain_sets(rows, words)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        ids[find(k)].append(i)
    return sorted((i or -1, len(s), min((x for x in ids[find(k)] if x is not None), default=None) or -1) for k, (i, s) in enumerate(sets))


def near_rows(seed=5):
    rng = random.Random(seed)
    rows = edge_rows()
    for g in range(6):
        base = prose(rng, rng.choice([4, 9, 14, 60, 150])).split()
        for k in range(12):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(["same", "other", prose(rng, 1)])
            rows.append((400 + 20 * g + k, " ".join(own)))
    return rows


@pytest.mark.parametrize("words, percent, tiers", [(3, 90, ngram_join.TIERS), (3, 90, ((2, 2), (6, 3))), (5, 80, ((3, 2), (9, 3))), (1, 60, ((2, 2), (4, 3)))])
def test_linked_components(spark, words, percent, tiers):
    rows = near_rows()
    # near copies without an id, and one row repeated as a whole
    rows += [(None, rows[-1][1] + " more"), (None, rows[-2][1]), rows[-1], rows[-1]]
    got = ngram_join.linked_components(documents(spark, rows, 1), words, percent, tiers).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got) == plain_components(rows, words, percent)


def test_signatures_meet():
    """Any two sets at the threshold share a signature, whatever the tiers."""
    rng = random.Random(9)
    ks = (2, 3)
    for _ in range(3000):
        percent = rng.choice([60, 80, 90])
        n = rng.randint(1, 80)
        pool = rng.sample(range(1, 10_000), n + 40)
        x, spare = pool[:n], pool[n:]
        miss = rng.randint(0, max(1, n // 5))
        y = x[miss:] + spare[: rng.randint(0, max(1, n // 8))]
        shared = len(set(x) & set(y))
        if not y or 100 * shared < percent * len(set(x) | set(y)) or set(x) == set(y):
            continue
        tier_of = {t: rng.choice([0, 1, 1, 2]) for t in pool}
        both = []
        for s in (x, y):
            tokens = np.array(sorted(s), np.uint64)
            both.append(set(ngram_join.signatures(tokens, np.array([tier_of[int(t)] for t in tokens]), ks, percent)[0].tolist()))
        assert both[0] & both[1], (x, y, percent)


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long").repartition(4)
    got = {r.node: r.label for r in components.components(links).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[101] == 100
    assert components.components(links.limit(0)).count() == 0


# ---- decontamination
def plain_leaks(rows, items):
    def shingles(t):
        w = regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    out = set()
    for i, t in rows:
        s = shingles(t)
        for item, text in items:
            own = shingles(text)
            if not own:
                continue
            a, best = Counter(own), 0.0
            for p in range(max(1, len(s) - len(own) + 1)):
                b = Counter(s[p : p + len(own)])
                best = max(best, sum((a & b).values()) / sum((a | b).values()))
            if best >= 0.8:
                out.add((i, item, round(best, 9)))
    return out


def test_leaks(spark):
    rng = random.Random(6)
    items = [(k, prose(rng, n)) for k, n in enumerate([3, 5, 12, 20, 30, 45, 59])] + [(50, None), (51, ""), (52, "one two three four five six one two three four five six seven")]
    rows = edge_rows()
    for k, (_, text) in enumerate(items):
        w = (text or "").split()
        changed = list(w)
        if len(w) > 8:
            changed[len(w) // 3] = "edited"
        inserted = w[: len(w) // 2] + ["more"] + w[len(w) // 2 :]
        for v, own in enumerate((w, changed, inserted, w[len(w) // 2 :], w[::-1], w + w)):
            before, after = prose(rng, rng.choice([0, 3, 30])), prose(rng, rng.choice([0, 30]))
            rows.append((500 + 10 * k + v, f"{before} {' '.join(own)}{rng.choice(['', '&&&', '.'])} {after}"))
        rows.append((500 + 10 * k + 9, " ".join(w).upper()))
    docs = documents(spark, rows)
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, own string")
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert got == plain_leaks(rows, items)
    assert decontaminate.leaks(docs.limit(0), benchmark).count() == 0
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0


def test_leaks_of_documents_shorter_than_the_item(spark):
    rng = random.Random(8)
    items = [(n, prose(rng, n)) for n in (14, 29, 50, 100, 200)]
    rows = []
    for n, text in items:
        w = text.split()
        for size in range(n * 78 // 100, n * 91 // 100 + 1):
            rows += [(1000 * n + size, " ".join(w[:size])), (1000 * n + 500 + size, " ".join(w[n - size :]))]
    # an edited one of 46 words: 41 of its 42 shingles among the item's 46
    w = items[2][1].split()
    rows.append((1, " ".join([*w[:45], "edited"])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontaminate.leaks(documents(spark, rows), benchmark).collect()}
    want = plain_leaks(rows, items)
    assert sum(i // 1000 == 50 for i, *_ in want) == 2 * 5 and (1, 50) in {x[:2] for x in want}
    assert got == want


def repeated_ends(seed, lengths, copies):
    """(items, rows): a document for each item that shares just enough first words, then repeats one word."""
    rng = random.Random(seed)
    items = [(k, prose(rng, n)) for k, n in enumerate(n for n in lengths for _ in range(copies))]
    rows = []
    for k, text in items:
        w = text.split()
        same = -(-8 * (len(w) - 4) // 9)  # 0.8 of similarity for windows of the item's size
        rows.append((1000 + k, " ".join([*w[: same + 4], *["again"] * (len(w) - 4 - same)])))
    return items, rows


def test_leaks_beside_a_repeated_word(spark):
    items, rows = repeated_ends(9, (50, 104, 154, 204), 6)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontaminate.leaks(documents(spark, rows), benchmark).collect()}
    assert got == plain_leaks(rows, items)
    assert {x[:2] for x in got} == {(1000 + k, k) for k, _ in items}


# ---- classifier
def test_dual_descent_separates():
    rng = np.random.default_rng(1)
    labels = rng.choice([-1, 1], 200)
    rows = [np.unique(np.r_[rng.integers(0, 40, 5), 40 + (y > 0)]).astype(np.uint32) for y in labels]
    zeros, ones = np.zeros(50), np.zeros(50)
    for r, y in zip(rows, labels, strict=True):
        (ones if y > 0 else zeros)[r] += 1
    ratios = nbsvm.log_count_ratios(zeros, ones)
    w, b = nbsvm.dual_descent(rows, labels, ratios, 20, 1.0, 0)
    assert all((nbsvm.margin(r, w, ratios, b) > 0) == (y > 0) for r, y in zip(rows, labels, strict=True))


def test_classifier_on_held_out_rows(spark):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = nbsvm.score(docs, nbsvm.fit(docs, labels)).join(labels, "doc_id").filter("held_out").toPandas()
    assert ((got.score > 0.5) == (got.quality == 1)).mean() > 0.9
    assert got.score.between(0, 1).all()


def test_classifier_edge_cases(spark):
    docs = documents(spark)
    for rows in ([], [(1, 1), (7, 1), (None, 0)], [(i, i % 2) for i in range(30)] + [(5, 0), (5, 1), (6, None)]):
        labels = spark.createDataFrame([(i, q, 0) for i, q in rows], "doc_id long, quality int, toxic int")
        got = nbsvm.score(docs, nbsvm.fit(docs, labels)).collect()
        assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert nbsvm.score(docs.limit(0), nbsvm.fit(docs, labels)).count() == 0


# ---- pipeline
def test_pipeline_stages(spark):
    docs = documents(spark, near_rows())
    at = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "clean", "packed"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialise(stage(spark, docs, SF_SMALL), name)
        assert out.columns == docs.columns
        assert out.exceptAll(docs).count() == 0
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
        assert stage(spark, at, SF_SMALL).columns == at.columns


def test_pipeline_decisions(spark):
    rows = near_rows()
    docs = documents(spark, rows).withColumn("n_chars", F.lit(None).cast("long"))
    once = corpus_pipeline.exact(spark, docs, SF_SMALL)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.materialise(once, "once").collect()]
    strip = str.maketrans("", "", " \t\n\v\f\r")
    assert Counter((t or "").translate(strip) for _, t in kept) == Counter(list({(t or "").translate(strip) for _, t in rows}))
    near = corpus_pipeline.near(spark, corpus_pipeline.materialise(once, "once"), SF_SMALL).collect()
    want = {c if c != -1 else None for i, n, c in plain_components(kept, 5, 80) if n}
    assert {r.doc_id for r in near if plain_sets([(0, r.text)], 5)[0][1]} >= {w for w in want if w is not None}
    with_words = [k for k in kept if plain_sets([k], 5)[0][1]]
    assert sum(1 for r in near if plain_sets([(0, r.text)], 5)[0][1]) == groups_of(with_words)


def groups_of(rows):
    """Number of components at five words and 80 percent."""
    numbered = [(1 + k, t) for k, (_, t) in enumerate(rows)]
    return len({c for _, _, c in plain_components(numbered, 5, 80)})


def test_bucket_counts_bound_the_intersection():
    rng = np.random.default_rng(3)
    for _ in range(500):
        x = np.unique(rng.integers(0, 2**64, rng.integers(1, 600), dtype=np.uint64))
        y = np.unique(np.r_[x[: rng.integers(0, len(x) + 1)], rng.integers(0, 2**64, rng.integers(1, 300), dtype=np.uint64)])
        shared = len(np.intersect1d(x, y))
        assert ngram_join.most_shared(ngram_join.bucket_counts(x), ngram_join.bucket_counts(y), min(len(x), len(y))) >= shared
    same = np.arange(1000, dtype=np.uint64)  # all in one bucket: the count is cut off
    assert ngram_join.most_shared(ngram_join.bucket_counts(same), ngram_join.bucket_counts(same), 1000) == 1000
