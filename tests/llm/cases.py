"""Small tables with what real ones have: nulls, empty and very long texts, ties, repeated rows."""

from __future__ import annotations

import random

WORDS = ["".join(random.Random(i).choices("abcdefghéß", k=random.Random(-i).randint(1, 9))) for i in range(900)]


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(words))


def documents() -> list[tuple[int | None, str | None]]:
    base, shared = prose(1, 120), prose(2, 60)
    near = base.split(" ")
    near[60] = "changed"
    return [
        (1, base),
        (2, base),
        (3, " ".join(near)),
        (4, base.upper()),
        (5, None),
        (6, ""),
        (7, " \n\t "),
        (8, "two words"),
        (9, "Two\twords"),
        (10, prose(3, 80) + " " + shared + " " + prose(4, 70)),
        (11, prose(5, 30) + " " + shared + " " + prose(6, 90)),
        (12, prose(7, 30_000)),
        (13, "x" * 5000),
        (14, "same same " * 400),
        (15, "日本語のテキスト 😀 naïve  double  spaces \n \n end  "),
        (16, "<|endoftext|> it's 12,5 kg!!! <|endoftext|>"),
        (16, "<|endoftext|> it's 12,5 kg!!! <|endoftext|>"),
        (17, "ՠ ֋ \u001c \u0085  \U0001e6c0 'll"),
        (None, prose(8, 50)),
        (None, None),
    ]


SCHEMA = "doc_id long, text string"


def frame(spark, rows=None, parts: int = 3):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(parts)


def clashing(df, *names: str):
    """``df`` with further columns that bear the names of results."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("clash") for n in names})
