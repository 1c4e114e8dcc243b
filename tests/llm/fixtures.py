"""Small tables with the cases that every operator must handle."""

from __future__ import annotations

import random

#: Columns that clash with names the operators use themselves.
EXTRA = ("digest", "key", "node", "rows", "size", "row", "rid", "label", "words", "hash", "bin", "shard", "pieces", "own", "spans")


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(words))


def edge_rows() -> list[tuple]:
    """(doc_id, text): nulls, empty and long texts, repeated rows, ties, equal and similar texts."""
    rng = random.Random(7)
    base, long = prose(rng, 120), prose(rng, 30_000)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    passage = prose(rng, 70)
    rows = [
        (1, "a b c"), (1, "a b c"), (2, None), (3, ""), (4, " \n\t"), (None, "text without an id but with words"), (None, None),
        (5, long), (6, long + " tail"), (7, base), (8, base.upper()), (9, near), (10, base + "  "), (11, "x"), (12, "x"), (13, "X y"),
        (14, prose(rng, 40) + " " + passage + " " + prose(rng, 40)), (15, prose(rng, 50) + " " + passage), (16, passage + " " + prose(rng, 30)),
        (17, "mail a.b@c.org, call +1 (212) 555-0100, host 10.0.0.255, card 4111 1111 1111 1111"), (18, "€ünï\u00a0cödé 😀 " * 30), (19, "ab" * 400), (20, base),
        (21, "<|endoftext|> it's\n\n  9  words <|endoftext|>"), (22, "a b c "), (23, "a  bc"),
    ]
    return rows


def documents(spark, rows: list[tuple] | None = None, parts: int = 3):
    """Documents with the given (doc_id, text) and clashing further columns, null here and there."""
    rows = edge_rows() if rows is None else rows
    names = ["doc_id long", "text string", "lang string", "source string", "n_chars long", *(f"{c} string" for c in EXTRA)]
    data = [(i, t, None if k % 3 else "en", "src0" if k % 2 else None, None, *(None if k % 2 else c for c in EXTRA)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join(names)).repartition(parts)
