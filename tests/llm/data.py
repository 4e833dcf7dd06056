"""A small table with the hard cases, and files to read it from."""

from __future__ import annotations

import random

WORDS = "the of and to in is on by it or be at as an are was with that this from".split()
COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, digest string, "
           "fid string, row long, label long, node long, key long, kept boolean, start long, "
           "`a.b` string")


def prose(n: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(n))


def edited(text: str, every: int, seed: int) -> str:
    words = text.split()
    for i in range(seed % every, len(words), every):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


def hard_cases() -> list[tuple[int | None, str | None]]:
    """(doc_id, text): nulls, empty, white space, short, long, copies, near
    copies, shared passages, repeated rows, several alphabets."""
    base, passage = prose(300, 1), prose(120, 2)
    rows: list[tuple[int | None, str | None]] = [
        (1, base), (2, base), (2, base), (3, edited(base, 97, 5)), (4, edited(base, 97, 6)),
        (5, None), (6, ""), (7, "   \n\t "), (8, "one two"), (9, "one two"), (None, "no id here"),
        (None, base), (10, prose(50, 3) + " " + passage), (11, passage + " " + prose(40, 4)),
        (12, "x" * 1500), (13, "über straße " * 90), (14, "日本語のテキスト " * 70), (15, prose(9000, 7)),
        (16, prose(60, 8)), (-5, prose(61, 9)), (2**62, prose(62, 10)), (17, "a b c  d"),
        (18, "line\nline\nline"), (19, "é" * 300 + "e" * 300), (20, "<|endoftext|> </s> ▁x"),
    ]
    return rows


def documents(spark, tmp_path, rows=None, name: str = "docs"):
    """The rows as a Parquet table with extra columns of clashing names."""
    rows = hard_cases() if rows is None else rows
    full = [(i, t, "en" if n % 3 else "de", None if n % 5 == 0 else f"src{n % 2}", len(t or ""),
             "d", "f", n, n, n, n, n % 2 == 0, n, "dot") for n, (i, t) in enumerate(rows)]
    path = str(tmp_path / name)
    spark.createDataFrame(full, COLUMNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)
