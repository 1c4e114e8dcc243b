"""Personal data: proposed by patterns, confirmed by checksums, scored by nearby words.

Kinds with a fixed definition: email, ip (parts at most 255), card (12 to 19 digits that pass
Luhn), phone (``+`` and 9 to 15 digits).  The method adds: iban (mod-97 remainder 1) and
local_phone and ssn, which have no checksum and so need a context word nearby.  A span's score
is that of its kind plus CONTEXT where one of the kind's words stands within WINDOW code points
of it; added kinds are kept from ACCEPT on, and only where they overlap no other span.

The matching is linear in the text: an email is looked for around each ``@``, the others are
anchored so that a run of digits is tried once.  Added spans are held against the accepted ones
in one sweep for each kind.

Defined cases: null text counts as empty; texts without personal data have counts of 0, an
empty ``spans`` and the digest of the empty string; repeated rows are judged each for itself;
of added spans that overlap, the earlier kind stays, base spans always; an empty table gives an
empty result; only id and text are read, so other columns may have any name; a very long text is
searched whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: kinds in their order, scores, context words
KINDS = ("email", "ip", "card", "phone", "iban", "local_phone", "ssn")
BASE_KINDS = 4
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "local_phone": 0.4, "ssn": 0.4}
WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "credit", "visa", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax"),
    "ssn": ("ssn", "social security"),
}
CONTEXT = 0.2
ACCEPT = 0.6
WINDOW = 40

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a later start in a run of digits would meet the same end of the run
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
DIGIT = re.compile("[0-9]")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def at_most_255(digits: str) -> bool:
    own = digits.lstrip("0")  # int() refuses thousands of digits, leading zeros included
    return len(own) <= 3 and int(own or "0") <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and LOCAL.match(text[start - 1]):
            start -= 1
        floor = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            floor = m.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """(start, number of the kind, end) of the fixed kinds, in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(at_most_255(p) for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m[0])) <= 15]
    return sorted(out)


def score(text: str, span: Span) -> float:
    start, kind, end = span
    near = (text[max(0, start - WINDOW) : start] + " " + text[end : end + WINDOW]).lower()
    return SCORES[KINDS[kind]] + CONTEXT * any(re.search(rf"\b{w}", near) for w in WORDS[KINDS[kind]])


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans of the further kinds that are confirmed, score enough and overlap no other span."""
    if not DIGIT.search(text):
        return []
    found = [(m.start(), 4, m.end()) for m in IBAN.finditer(text) if mod97(m[0].replace(" ", ""))]
    found += [(m.start(), 5, m.end()) for m in LOCAL_PHONE.finditer(text)]
    found += [(m.start(), 6, m.end()) for m in SSN.finditer(text)]
    out: list[Span] = []
    taken = merged([(a, b) for a, _, b in base])
    for kind in sorted({k for _, k, _ in found}):
        # those of one kind don't overlap each other
        new = apart([s for s in found if s[1] == kind and score(text, s) >= ACCEPT], taken)
        taken = merged([*taken, *((a, b) for a, _, b in new)])
        out += new
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of the spans, as disjoint ones in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def apart(spans: list[Span], taken: list[tuple[int, int]]) -> list[Span]:
    """Those of ``spans`` that overlap none of ``taken``; both in order, ``taken`` disjoint."""
    out, at = [], 0
    for span in spans:
        while at < len(taken) and taken[at][1] <= span[0]:
            at += 1
        if at == len(taken) or span[2] <= taken[at][0]:
            out.append(span)
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores"]
    types = [pa.int64()] * 5 + [pa.string()] * 3
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            base = base_spans(text)
            spans = sorted([*base, *added_spans(text, base)])
            counts = [sum(k == n for _, k, _ in base) for n in range(BASE_KINDS)]
            rows.append((doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), ",".join(f"{score(text, s):.1f}" for s in spans)))
        columns = list(zip(*rows, strict=True)) or [()] * 8
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, counts of the fixed kinds, base_sha256, spans, scores."""
    columns = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores string"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_found, columns)


def query(spark, sf_dir: str) -> DataFrame:
    return find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
