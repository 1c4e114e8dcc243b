"""Ranked search, whitening and SimHash near duplicates against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clickmart.llm import lexical_search, registry, simhash_dedup, whitening
from tests.conftest import SF_SMALL
from tests.llm.fixtures import documents, edge_rows, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


# ---- ranked search
def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(rows, items, most):
    docs = [(i, Counter(terms_of(t))) for i, t in rows]
    docs = [(i, tf) for i, tf in docs if tf]
    count, total = len(docs), sum(sum(tf.values()) for _, tf in docs)
    df = Counter(t for _, tf in docs for t in tf)
    own = {}
    for i, text in items:
        own.setdefault(i, set()).update(terms_of(text))
    out = []
    for item, terms in own.items():
        scored = []
        for i, tf in docs:
            m = 100 - 50 + ((50 * sum(tf.values()) * count) // total)
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in terms if t in tf)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:most], 1)]
    return sorted(out, key=str)


def found_search(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, "x", None) for i, t in items], "item_id long, text string, doc_id string, score string")


ITEMS = [(1, "The a b, X_y café 9 words"), (1, "call host 10"), (2, None), (3, " .,"), (None, "text with words but a"), (4, "zzz unseen"), (5, "ünï😀 codé cödé ab"), (6, "x X x")]


@pytest.mark.parametrize("most,block", [(50, 2 << 20), (3, 40)])
def test_search_edge_rows(spark, most, block):
    got = lexical_search.search(documents(spark, parts=4), items_frame(spark, ITEMS), most, block)
    assert found_search(got) == plain_search(edge_rows(), ITEMS, most)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("seed", range(3))
def test_search_random(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcABé9") for _ in range(rng.randint(1, 3))) for _ in range(40)]

    def text():
        return "".join(rng.choice(words) + rng.choice([" ", "  ", ", ", "_", "\n", "'"]) for _ in range(rng.randint(0, 60)))

    rows = [(rng.choice([None, k, k // 2]), rng.choice([text(), text(), None, "", "a b"])) for k in range(150)]
    items = [(k % 9, text()) for k in range(12)]
    got = lexical_search.search(documents(spark, rows, 7), items_frame(spark, items), 10)
    assert found_search(got) == plain_search(rows, items, 10)


def test_search_long_text_in_portions():
    text = ("Ab cd, é9 " * 50 + "x" * 300 + " ab").encode()
    for most in (7, 64, 10_000):
        parts = list(lexical_search.portions(text, most))
        assert [t for p in parts for t in p.split()] == [t.encode() for t in terms_of(text.decode())]
        assert sum(map(lexical_search.n_terms, parts)) == len(terms_of(text.decode()))
        tf = Counter()
        machine = lexical_search.automaton([b"ab", "é9".encode(), b"x" * 300])
        for p in parts:
            tf.update(t for _, t in machine.iter(p.decode("latin-1")))
        assert tf == {0: 51, 1: 50, 2: 1}


def test_search_empty(spark):
    none = documents(spark, []), items_frame(spark, [])
    assert lexical_search.search(none[0], items_frame(spark, ITEMS)).count() == 0
    assert lexical_search.search(documents(spark), none[1]).count() == 0
    assert lexical_search.search(documents(spark, [(1, None), (2, "."), (None, "")]), items_frame(spark, ITEMS)).count() == 0


def test_search_query_and_sql(spark):
    got = found_search(registry.QUERIES["op11_lexical_search"](spark, SF_SMALL))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert got == plain_search(rows, items, 50)
    with duckdb.connect() as con:
        for t in ("documents", "benchmark"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
        assert got == sorted(con.execute(registry.SQL["op11_lexical_search"]).fetchall(), key=str)


# ---- whitening
def vectors(spark, rows, parts=3, kind="float"):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, x string, n int").repartition(parts)


def check_whitened(rows, got, kind=np.float32):
    kept = [(i, np.array(v, kind).astype(float)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in kept]
    fit = np.array(sorted({tuple(v) for _, v in x}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = np.array([[float(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in fit])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1].T
    k = min(16, int((values > 1e-12 * values.sum()).sum()))
    assert len(got) == len(x) * k
    assert {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, k + 1))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-9
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    want = [(-1 if i is None else i, sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))) for i, v in x for _ in range(k)]
    want = sorted((i, w if w < 2**63 else -1) for i, w in want)  # null beyond a long
    assert sorted((-1 if r.vec_id is None else r.vec_id, -1 if r.deviation is None else r.deviation) for r in got) == want
    # either sign, the same for all rows; only where the eigenvalue stands alone
    for c in range(1, k + 1):
        gap = min(abs(values[c - 1] - values[j]) for j in range(len(values)) if j != c - 1)
        if gap < 1e-3 * values[c - 1]:
            continue
        want = sorted((-1 if i is None else i, float(np.array([float(n * a - s) / n for a, s in zip(v, sums, strict=True)]) @ axes[c - 1] / values[c - 1] ** 0.5)) for i, v in x)
        own = sorted((-1 if r.vec_id is None else r.vec_id, r.whitened) for r in got if r.component == c)
        want = np.array([w for _, w in want])
        own = np.array([w for _, w in own])
        ids = [-1 if i is None else i for i, _ in x]
        if len(set(ids)) == len(ids):
            assert min(np.abs(own - want).max(), np.abs(own + want).max()) < 1e-7


def test_whitening_random(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((6, 20)) * np.array([3, 1, 1, 0.5, 0.3, 0.1])[:, None]
    data = rng.standard_normal((300, 6)) @ base + 0.05 * rng.standard_normal((300, 20)) + 5
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(data)]
    rows += [(1000 + k, rows[0][1]) for k in range(150)]  # a hot vector counts once
    check_whitened(rows, whitening.whiten(vectors(spark, rows)).collect())


def test_whitening_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0, 0.0]), (1, [0.5, 1.0, 0.0]), (None, [0.25, -1.0, 2.0]), (2, None), (3, []), (4, [1.0, None, 0.0]), (5, [nan, 0.0, 0.0]), (6, [0.0, inf, 0.0]), (7, [0.0, -inf, 0.0]), (8, [-0.5, 0.75, 1.0]), (9, [4.0, 1.0, -3.0])]
    got = whitening.whiten(vectors(spark, rows))
    assert got.schema.simpleString() == "struct<" + whitening.RESULT.replace(" long", ":bigint").replace(" ", ":").replace(",:", ",") + ">"
    check_whitened(rows, got.collect())


def test_whitening_few_vectors(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    rows = [(k, [float(k), 1.0, 2.0 * k]) for k in range(9)]  # rank one
    check_whitened(rows, whitening.whiten(vectors(spark, rows)).collect())
    with pytest.raises(ValueError, match="2 to 3 entries"):
        whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])]))


def test_whitening_large_entries(spark):
    for far in (2**20, 2**23, 2**30, 2**40):
        rows = [(k, [float(far * (k % 3)), float(k), float(-2 * far * k)]) for k in range(7)]
        check_whitened(rows, whitening.whiten(vectors(spark, rows, kind="double")).collect(), np.float64)


def test_inertia_counts():
    rng = np.random.default_rng(3)
    for d in (1, 2, 3, 8, 30):
        a = rng.standard_normal((d, d))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in rng.uniform(values[0] - 1, values[-1] + 1, 20):
            assert whitening.count_below(a, float(shift)) == int((values < shift).sum())
    assert whitening.count_below(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1  # needs a block of two


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [3, 3, 3, 1, 1], [1, 1, 1, 1, 1], [2, 2 + 1e-9, 1, 1 - 1e-12, 0], [7, 0, 0, 0, 0], [1e-9, 1e-10, 1e-11, 1e-12, 1e-13], [9, 1e-3, 1e-6, 1e-6, 1e-9]])
def test_slices(values):
    rng = np.random.default_rng(4)
    d = 12
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    spectrum = np.sort(np.r_[np.array(values, float), np.zeros(d - len(values))])[::-1]
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    got, axes = whitening.Slices(a).leading(16)
    want = spectrum[spectrum > 1e-12 * spectrum.sum()]
    assert abs(len(got) - len(want)) <= 1 and np.allclose(got[: len(want)], want[: len(got)], rtol=1e-9, atol=1e-13 * spectrum[0])
    assert np.abs(axes @ axes.T - np.eye(len(got))).max() < 1e-12
    assert np.abs(axes @ a - got[:, None] * axes).max() < 1e-13 * spectrum[0] * d


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check_whitened(rows, registry.QUERIES["op12_whitening"](spark, SF_SMALL).collect())


# ---- SimHash
def plain_print(text):
    words = (text or "").encode().translate(bytes(LOWER.get(c, c) for c in range(256))).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    distinct = np.array(sorted(set(prints)), np.uint64)
    label = list(range(len(distinct)))

    def root(i):
        while label[i] != i:
            label[i] = i = label[label[i]]
        return i

    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(distinct[i + 1 :] ^ distinct[i]) <= radius).tolist():
            label[root(i)] = root(i + 1 + j)
    place = {int(p): i for i, p in enumerate(distinct)}
    return [root(place[p]) for p in prints]


def plain_near(rows):
    prints = [plain_print(t) for _, t in rows]
    roots = plain_components(prints)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(((i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, roots, strict=True)), key=str)


def found_near(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_fingerprint_is_sparks_hash(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b é")).alias("h")).first()
    assert row.h % 2**64 == xxhash.xxh64_intdigest("a b é".encode(), 42)


def test_fingerprint_in_portions(monkeypatch):
    text = prose(random.Random(5), 500)
    want = plain_print(text)
    for chunk in (1, 7, 497, 498, 499, 1 << 16):
        monkeypatch.setattr(simhash_dedup, "CHUNK", chunk)
        assert simhash_dedup.fingerprint(text.encode()) == want


def test_near_duplicates_edge_rows(spark):
    assert found_near(simhash_dedup.near_duplicates(documents(spark))) == plain_near(edge_rows())
    assert simhash_dedup.near_duplicates(documents(spark, [])).count() == 0
    assert found_near(simhash_dedup.near_duplicates(documents(spark, [(None, None), (None, " ")]))) == [(None, "0" * 16, None)] * 2


def _node_components(spark, prints, parts=4):
    nodes = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in set(prints)], "node long").repartition(parts)
    links = [(r.a, r.b) for r in simhash_dedup.linked(nodes).collect()]
    distinct = sorted(set(prints))
    place = {int(np.uint64(p).view(np.int64)): i for i, p in enumerate(distinct)}
    a, b = (np.array([place[x] for x in side], np.int64) for side in (zip(*links, strict=True) if links else ([], [])))
    for p, q in links:
        assert (p ^ q).bit_count() <= 2 * 64  # forest rows may join members by way of others
    label = simhash_dedup.forest(a, b, len(distinct))
    return [int(label[place[int(np.uint64(p).view(np.int64))]]) for p in prints], len(links)


def _same_partition(one, other):
    return len(set(zip(one, other, strict=True))) == len(set(one)) == len(set(other))


@pytest.mark.parametrize("seed", range(4))
def test_links_by_chains(spark, seed):
    """Random fingerprints with families of copies 0 to 5 bits apart, at all places of the ring."""
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(200)]
    for _ in range(600):
        p = rng.choice(prints)
        for b in rng.sample(range(64), rng.choice((0, 1, 2, 2, 3, 4, 5))):
            p ^= 1 << b
        prints.append(p)
    got, _ = _node_components(spark, prints)
    assert _same_partition(got, plain_components(prints))


@pytest.mark.parametrize("bits,count", [(range(64), 1500), (range(20, 44), 1200), (list(range(60, 64)) + list(range(9)), 1500), (range(0, 64, 8), 256)])
def test_links_in_a_hot_family(spark, bits, count):
    """Many distinct fingerprints around one, so that buckets are far larger than PAIRS."""
    rng = random.Random(8)
    centre, bits = rng.getrandbits(64), list(bits)
    prints = set()
    while len(prints) < min(count, 2 ** len(bits)):
        p = centre
        for b in rng.sample(bits, rng.randint(0, min(len(bits), 9))):
            p ^= 1 << b
        prints.add(p)
    prints = sorted(prints)
    got, links = _node_components(spark, prints)
    assert _same_partition(got, plain_components(prints))
    assert links < 16 * 32 * len(prints)


def test_every_pair_within_radius_has_a_chain():
    rng = random.Random(2)
    pairs = [(a, b) for a in range(64) for b in range(a, 64)]
    base = np.array([rng.getrandbits(64) for _ in pairs], np.uint64)
    other = np.array([int(x) ^ (1 << a) ^ (0 if a == b else 1 << b) for x, (a, b) in zip(base, pairs, strict=True)], np.uint64)
    same = simhash_dedup.keys(base) == simhash_dedup.keys(other)
    ok = np.zeros(len(pairs), bool)
    for start in range(8):
        hit = np.zeros(len(pairs), bool)
        hit[simhash_dedup.within_budget(simhash_dedup.turned(base ^ other, start))] = True
        ok |= hit & (same[2 * start] | same[2 * start + 1])
    assert ok.all()


def test_near_duplicates_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert found_near(registry.QUERIES["op13_simhash_dedup"](spark, SF_SMALL)) == plain_near(rows)
