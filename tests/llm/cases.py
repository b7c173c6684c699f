"""Small tables with the odd cases that every operator has to take."""

import random

LONG = " ".join(f"word{i % 977} and" for i in range(30_000))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, fingerprint string, size int, start int"


def odd_documents(spark):
    """Null ids, texts and sources, empty and very long texts, repeated rows, and columns named like results."""
    rng = random.Random(1)
    words = ["the", "of", "and", *(f"w{i}" for i in range(60))]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 200))) for _ in range(30)]
    rows = [(i, t, "en", f"s{i % 3}", len(t), 9.0, "x", 1, 2) for i, t in enumerate(texts)]
    rows += [
        (100, None, None, None, None, None, None, None, None),
        (101, "", "en", "s0", 0, 9.0, "x", 1, 2),
        (102, " \t\n ", "en", None, 4, 9.0, "x", 1, 2),
        (103, LONG, "en", "s0", len(LONG), 9.0, "x", 1, 2),
        (None, "a row that has no id", "en", "s1", 20, 9.0, "x", 1, 2),
        (None, None, None, None, None, None, None, None, None),
        *[(104, texts[0], "en", "s2", len(texts[0]), 9.0, "x", 1, 2)] * 3,
        (105, "é日本 🙂 ß\x00 <|endoftext|> <s>", "xx", "s1", 20, 9.0, "x", 1, 2),
        (-7, texts[1], "en", "s1", len(texts[1]), 9.0, "x", 1, 2),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
