"""Token counts, packing and personal data against the libraries and plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickmart.llm import harmonic_pack, pii, token_counts
from tests.llm.fixtures import documents, edge_rows, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["don't  stop\t\n\n now", "x y z 　 ", "\0\0 \0a", "ﬁﬂ Ⅷ ½ ٣٤ 한국어 日本語", "a" * 5000, "   ", "\r\n\r\n", "ȩ́ 👩‍👩‍👧", "1234567890 3.14 1,000", "<|endoftext|>", "a<|endoftext|><|endoftext|> b"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def rows_with_odd():
    return edge_rows() + [(100 + i, t) for i, t in enumerate(ODD)]


def test_token_counts(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK_DOCS", 7)  # several blocks in a task
    rows = rows_with_odd()
    got = token_counts.token_counts(documents(spark, rows), PATH, public_tokenizers.PATTERN, 100).collect()
    want = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in got)) == sorted((i or -1, b, n, n > 100) for i, b, n in want)


def test_empty_tables(spark):
    none = documents(spark).limit(0)
    assert token_counts.token_counts(none, PATH, public_tokenizers.PATTERN).count() == 0
    assert harmonic_pack.pack_documents(none).count() == 0
    assert pii.find_pii(none).count() == 0


def check_packing(got, rows, tokenizer, capacity=1024):
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
    for i, copies in ids.items():
        pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got if r.doc_id == i)
        want = []
        for own in copies:
            start = 0
            for n in harmonic_pack.cuts(len(own)):
                want.append((start, n, zlib.crc32(np.array(own[start : start + n], "<u4").tobytes()), len(own)))
                start += n
        assert pieces == sorted(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(r.length for r in got) / (capacity * len(sequences))


def test_packing_edge_cases(spark, tokenizer):
    rows = rows_with_odd()
    check_packing(harmonic_pack.pack_documents(documents(spark, rows)).collect(), rows, tokenizer)


def test_packing_fills_sequences(spark, tokenizer):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.choice([3, 20, 90, 200, 400, 1500]))) for i in range(300)]
    assert check_packing(harmonic_pack.pack_documents(documents(spark, rows)).collect(), rows, tokenizer) > 0.97


@pytest.mark.parametrize("worker_pieces", [200_000, 3000])
def test_packing_fills_sequences_with_very_short_texts(spark, tokenizer, worker_pieces):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = [(i, [None, "", "a", "a b c", "word " * (i % 15)][i % 5]) for i in range(4000)]
    cut = harmonic_pack.pieces(documents(spark, rows), ranks, public_tokenizers.PATTERN, {"<|endoftext|>": 50256})
    assert check_packing(harmonic_pack.pack(cut, worker_pieces=worker_pieces).collect(), rows, tokenizer) > 0.85


def test_many_workers(spark, tokenizer):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = [(i, "word " * (i % 700)) for i in range(200)]
    cut = harmonic_pack.pieces(documents(spark, rows), ranks, public_tokenizers.PATTERN, {"<|endoftext|>": 50256})
    check_packing(harmonic_pack.pack(cut, worker_pieces=40).collect(), rows, tokenizer)


@pytest.mark.parametrize("n", [1, 15, 16, 17, 341, 342, 511, 512, 513, 600, 1000, 1023, 1024, 1025, 5000])
def test_cuts(n):
    own = harmonic_pack.cuts(n)
    assert sum(own) == n and all(0 < x <= 1024 for x in own)


def luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        d = int(c) * 2 if k % 2 else int(c)
        total += d // 10 + d % 10
    return total % 10 == 0


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern in ((2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 2 and 12 <= len(digits) <= 19 and luhn(digits)) or (kind == 3 and 9 <= len(digits) <= 15):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_on_random_strings():
    rng = random.Random(11)
    for _ in range(20_000):
        text = "".join(rng.choice(["a", "Z", "@", ".", "-", "+", " ", "1", "25", "255", "4111 1111 1111 1111", "é", "(", "\n", "x.y"]) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_are_linear():
    assert pii.base_spans("1" * 300_000 + " " + "a" * 300_000 + "@" + "b" * 100_000 + "+" + "2 " * 50_000) is not None


def test_pii_edge_cases(spark):
    rows = rows_with_odd()
    got = {(r.doc_id, r.base_sha256): r for r in pii.find_pii(documents(spark, rows)).collect()}
    for i, t in rows:
        base = plain_spans(t or "")
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        r = got[i, hashlib.sha256(text.encode()).hexdigest()]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert set(text.split(",")) <= set(r.spans.split(","))


def test_ip_with_thousands_of_zeros(spark):
    zeros = "0" * 4301
    for text, found in ((zeros + ".1.1.1", True), ("1.1.1." + zeros + "255", True), ("1.1.1." + zeros + "256", False), ("1.1." + "9" * 5000 + ".1", False)):
        assert [x for x in pii.base_spans(text) if x[1] == 1] == ([(0, 1, len(text))] if found else [])
    got = pii.find_pii(documents(spark, [(1, zeros + ".1.1.1")])).collect()
    assert [(r.doc_id, r.n_ip) for r in got] == [(1, 1)] and "ip:0:4307" in got[0].spans


def test_added_kinds():
    iban = "pay to account GB82 WEST 1234 5698 7654 32 today"
    assert [pii.KINDS[k] for _, k, _ in pii.added_spans(iban, pii.base_spans(iban))] == ["iban"]
    assert not pii.added_spans(iban.replace("GB82", "GB83"), [])  # fails mod-97
    for text, kinds in (("call 212 555-0100 now", ["local_phone"]), ("size 212 555-0100 now", []), ("SSN 123-45-6789", ["ssn"]), ("part 123-45-6789", [])):
        assert [pii.KINDS[k] for _, k, _ in pii.added_spans(text, pii.base_spans(text))] == kinds
