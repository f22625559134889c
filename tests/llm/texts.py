"""Small document tables with the cases every operator must take."""

import random

HARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "a b c d"), (6, "a b c d"), (6, "a b c d"),
    (7, "naïve 日本語 😀 ▁▁x <|endoftext|> \x00 end"), (None, "no id here"), (8, "x" * 70_000), (9, "word " * 20_000),
    (10, "A B C D"), (11, "1" * 30_000 + " @ " * 500 + "+1" * 2_000),
]


def documents(spark, rows, extra=True):
    """doc_id, text, and columns whose names clash with those inside operators."""
    df = spark.createDataFrame(list(rows), "doc_id long, text string")
    if not extra:
        return df
    return df.selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "CAST(length(text) AS long) AS n_chars",
        "0 AS v", "'x' AS label", "1 AS part", "2 AS score", "3 AS tile",
    )


def prose(seed, n, words=400):
    r = random.Random(str(seed))
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))
