from __future__ import annotations

import random

import pytest

SF_SMALL = "/root/testdata/sf0.001"

WORDS = ("the of and to in house water green stone river under over light night sound paper "
         "table window garden summer winter letter number simple music people country").split()


def prose(seed: int, n: int, lines: int = 4) -> str:
    rnd = random.Random(seed)
    words = [rnd.choice(WORDS) + rnd.choice(["", "", "s", "er", "ly"]) + str(rnd.randint(0, 99))
             if rnd.random() < 0.5 else rnd.choice(WORDS) for _ in range(n)]
    step = max(1, n // lines)
    return "\n".join(" ".join(words[i:i + step]) for i in range(0, n, step))


def edited(text: str, seed: int, share: float) -> str:
    rnd = random.Random(seed)
    return " ".join(w + "x" if rnd.random() < share else w for w in text.split(" "))


def hard_rows() -> list[tuple]:
    """Nulls, empties, repeated rows, ties, odd white space, a very long text."""
    base, other = prose(1, 120), prose(2, 90)
    line = "A line that several documents share, long enough to count as one."
    rows = [(1, base), (2, None), (3, ""), (4, " \n\t  \n"), (5, base), (6, edited(base, 3, 0.02)),
            (7, other), (7, other), (8, base.upper()), (9, "two words"), (10, "Two  WORDS "),
            (11, prose(4, 20_000, 300)), (12, "é à ü ß 漢字 \U0001f600 \x1f\x85 end"),
            (13, "<|endoftext|> 100% sure | yes #1 a<b>"), (None, other), (None, None)]
    rows += [(20 + i, f"{prose(50 + i, 30)}\n  {line.upper() if i % 2 else line}\t\n{prose(70 + i, 9)}")
             for i in range(6)]
    rows += [(40 + i, edited(other, i, 0.01)) for i in range(5)]
    return rows


@pytest.fixture(scope="session")
def hard(spark):
    """The hard rows with columns named like those that operators add."""
    rows = [(i, t, "en" if k % 3 else None, "src", None if t is None else len(t), k, "x", "y", "z")
            for k, (i, t) in enumerate(hard_rows())]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n_lines int, "
              "hits string, quality string, drop string").repartition(3)


@pytest.fixture(scope="session")
def nothing(hard):
    return hard.limit(0)
