"""Small tables that the tests share."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size long, bucket string, `row` string, key string, _id long, raw string"


def documents(spark, rows, partitions=3):
    """(doc_id, text[, lang, source]) as documents with columns whose names operators use themselves."""
    whole = []
    for row in rows:
        doc_id, text, lang, source = (*row, None, None)[:4] if len(row) < 4 else row
        whole.append((doc_id, text, lang, source, len(text or ""), None, -1, "b", "r", "k", 7, "w"))
    return spark.createDataFrame(whole, SCHEMA).repartition(partitions) if whole else spark.createDataFrame([], SCHEMA)


def words(rng: random.Random, n: int) -> list[str]:
    syllables = "ba ce di fo gu la me ni po ru sa te vi".split()
    return ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]


ODD = [
    (1, "one two three", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n\x0b\x0c\r ", "en", ""),
    (None, "one two three", "en", "a"),
    (None, None, None, None),
    (5, "one  two\nthree", "fr", "b"),
    (5, "one  two\nthree", "fr", "b"),
    (6, "ONE two three", "fr", "\U0001f600"),
    (7, "été 你好 \U0001f600 x", "fr", "b"),
    (8, "word " * 30000, "en", "b"),
    (9, "x" * 70000, "en", "b"),
]
