"""Awkward rows that every operator is run on."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int, line: int = 12) -> str:
    rng = random.Random(seed)
    out = ["".join(rng.choice(["ba", "du", "ki", "lo", "ñé", "stra"]) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return "\n".join(" ".join(out[i:i + line]) + "." for i in range(0, words, line))


def documents() -> list[tuple]:
    long_text = prose(5, 30_000)
    rows = [
        (1, prose(1, 120), "en", "a", 1), (2, prose(1, 120), "en", "b", 2), (3, prose(2, 90).replace("ba", "Ba", 1), "en", None, None),
        (4, prose(2, 90), None, "a", 3), (5, "", "en", "a", 0), (6, None, None, None, None), (7, " \t\n \r\n", "de", "b", 6),
        (8, "one", "en", "c", 3), (9, "one two", "en", "c", 7), (10, "one two", "en", "c", 7), (11, long_text, "en", "a", 9),
        (12, "x " * 400, "en", "b", 800), (13, "\x00odd\x85 text with 🙂 signs # * $ % & | < >", "fr", "d", 1),
        (None, prose(3, 60), "en", "a", 4), (14, prose(4, 200) + "\n" + prose(1, 24), "es", "a", 5),
        (15, prose(4, 200), "es", "a", 5), (15, prose(4, 200), "es", "a", 5), (16, prose(6, 3), "en", "z", 1),
    ]
    return rows


def table(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
