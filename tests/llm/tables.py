"""Small hand-made tables: NULLs, empty and repeated rows, ties, extra columns with clashing names."""

from __future__ import annotations

import random

EXTRA = "doc_id long, text string, lang string, shard int, rank int, key long, row string, kept string, size long"


def documents(spark, rows):
    """Documents (doc_id, text[, lang]) with further columns whose names the operators use themselves."""
    full = [(row[0], row[1], row[2] if len(row) > 2 else None, 7, 7, 7, "row", "kept", 7) for row in rows]
    return spark.createDataFrame(full, EXTRA)


def random_texts(seed: int, count: int, vocabulary: int, longest: int) -> list[str]:
    draw = random.Random(seed)
    made: list[list[str]] = []
    for _ in range(count):
        words = [f"w{draw.randrange(vocabulary)}" for _ in range(draw.randrange(longest))]
        if made and draw.random() < 0.6:
            other = draw.choice(made)
            at = draw.randrange(len(other) + 1)
            words += other[at : at + draw.randrange(60)] + ["end"] * draw.randrange(20)
        made.append(words)
    return [draw.choice([" ", "  ", "\n"]).join(words) for words in made]
