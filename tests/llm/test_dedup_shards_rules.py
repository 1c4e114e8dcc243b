"""Exact dedup, shards and URL rules against plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from clickmart.llm import kk_shards, mph_dedup, url_rules
from clickmart.llm.common import SPACES
from tests.llm.fixtures import documents, edge_rows


def normal(text):
    return "".join(c for c in text or "" if c not in SPACES)


def expected_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append((-len(t or ""), i is None, i or 0, i))
    return {g: (min(v)[3], len(v)) for g, v in groups.items()}


def test_minimal_perfect_hash():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    sizes, bits = mph_dedup.build_mph(digests)
    assert sorted(mph_dedup.slots_of(digests, sizes, bits)) == list(range(5000))
    foreign = [hashlib.sha256(f"x{i}".encode()).digest() for i in range(1000)]
    assert (mph_dedup.slots_of(foreign, sizes, bits) < 5000).all()


@pytest.mark.parametrize("history", ["default", "all", "none"])
def test_exact_dedup_edge_cases(spark, history):
    from pyspark.sql import functions as F

    rows = edge_rows()
    mark = {"default": None, "all": F.lit(True), "none": F.lit(False)}[history]
    got = mph_dedup.exact_dedup(documents(spark), mark, bucket_digests=4).collect()
    groups = expected_groups(rows)
    want = sorted((i is None, i or 0, groups[normal(t)][0] or -1, groups[normal(t)][1], hashlib.sha256(normal(t).encode()).hexdigest()) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.keep_id or -1, r.group_size, r.text_sha256) for r in got) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


@pytest.mark.parametrize("n_old", [0, 3])
def test_incoming_digests_are_dealt_to_buckets(spark, monkeypatch, n_old):
    """A small or empty history doesn't put all incoming digests into one group."""
    from pyspark.sql import functions as F

    probe, seen = mph_dedup.probe, []

    def watched(incoming, index, buckets):
        sizes = mph_dedup._bucketed(incoming, buckets).groupBy("bucket").count().collect()
        seen.append((buckets, max(r["count"] for r in sizes)))
        return probe(incoming, index, buckets)

    monkeypatch.setattr(mph_dedup, "probe", watched)
    rows = [(i, f"text {i % 900}") for i in range(1000)]
    got = mph_dedup.exact_dedup(documents(spark, rows), F.col("doc_id") < n_old, bucket_digests=100).collect()
    groups = expected_groups(rows)
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == sorted((i, *groups[normal(t)]) for i, t in rows)
    assert seen[0][0] == 9 and seen[0][1] < 200


def test_keep_winners(spark):
    docs = documents(spark)
    kept = mph_dedup.keep_winners(docs)
    assert kept.columns == docs.columns
    assert len({normal(r.text) for r in kept.collect()}) == kept.count() == len(expected_groups(edge_rows()))


def test_empty_tables(spark):
    none = documents(spark).limit(0)
    assert mph_dedup.exact_dedup(none).count() == 0
    assert mph_dedup.keep_winners(none).count() == 0
    assert kk_shards.shards(none, 4).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(pages, url_rules.rules_frame(spark, url_rules.RULES)).count() == 0


def check_shards(got, rows, k):
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
    for s, own in by_shard.items():
        assert 0 <= s < k
        assert sorted(r.slot for r in own) == list(range(len(own)))
    want = sorted((i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} <= {("bytes", None)}
    return [sum(r["size"] for r in by_shard[s]) for s in range(k)]


def test_shards_edge_cases(spark):
    check_shards(kk_shards.shards(documents(spark), 4).collect(), edge_rows(), 4)


def test_shards_balance_and_groups(spark):
    rng = random.Random(3)
    rows = [(i, "x" * rng.randint(1, 2000)) for i in range(600)] + [(1000 + i, "hot " * 100) for i in range(300)] + [(2000 + i, f"pair {i % 50}") for i in range(100)]
    got = kk_shards.shards(documents(spark, rows), 8).collect()
    sizes = check_shards(got, rows, 8)
    assert max(sizes) - min(sizes) < 0.01 * np.mean(sizes)
    of = {r.doc_id: r.shard for r in got}
    for i in range(50):  # groups below a fair share stay together
        assert of[2000 + i] == of[2050 + i]


def test_differencing_beats_greedy():
    rng = random.Random(5)
    sizes = [rng.randint(1, 1000) for _ in range(400)]
    sums, members = kk_shards.difference([([s], [[i]]) for i, s in enumerate(sizes)], 7)
    assert sorted(i for own in members for i in own) == list(range(400))
    assert sums == [sum(sizes[i] for i in own) for own in members]
    greedy = [0] * 7
    for s in sorted(sizes, reverse=True):
        greedy[greedy.index(min(greedy))] += s
    assert max(sums) - min(sums) <= max(greedy) - min(greedy)


def plain_verdict(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = []
    for verdict, rule in rules:
        h, p = rule.split("/", 1)[0], "/" + rule.split("/", 1)[1]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(rule), len(h), verdict == "block", rule, verdict))
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


URLS = [
    None, "", "no scheme", "http://", "https:///path", "http://Example.NET/en/1?x#y", "http://a.example.net/en", "http://a.example.net/en/", "ftp://b.c.net?q=/", "http://net/",
    "http://xnet/", "http://example.com/de/", "http://example.com/den", "http://m.example.com/de/a/b", "http://x.org/fr/", "http://org/fr/ü", "http://x.org/FR/", "http://a..net/", "x://y://z.net/a",
    "http://ÄB.net/a\nb", "http://host.example.net#en/", "http://u@p:80.net/", "http://" + "a." * 300 + "net/" + "p/" * 2000,
]


def test_url_rules(spark):
    rules = [*url_rules.RULES, ("block", "org/"), ("allow", "org/"), ("block", "example.net/en/1"), ("block", "net/")]
    rows = [(i, u, "x") for i, u in enumerate(URLS * 2)] + [(None, "http://a.net/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, url_rules.rules_frame(spark, rules)).collect()}
    assert got == {(i, *plain_verdict(u, rules)) for i, u, _ in rows}


def test_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    rows = url_rules.judge(pages, url_rules.rules_frame(spark, [])).collect()
    assert [(r.rule, r.verdict) for r in rows] == [(None, "allow")]
