"""Documents at the edges: nulls, empty and very long texts, repeated rows, names that operators use themselves."""

import random

LONG = " ".join(f"Word{i % 997}, and then{i % 13}." for i in range(20_000))
SAME = "The very same sentence of more than thirteen words stands in several of these documents here.\nA second line."

ROWS = [
    (1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (4, "word", "en"), (5, "é", "fr"), (6, "12 .. !!", None),
    (7, LONG, "en"), (8, SAME, "en"), (9, SAME, "en"), (9, SAME, "en"), (None, SAME, "en"), (None, None, None),
    (10, "😀 𝔘nicode é é   wide", "de"), (11, SAME + " And a third one that differs a little.", "en"),
    (12, "der die das und nicht mit einer von den", "de"), (13, "le la les des et une pas que dans", "fr"),
    (14, "a\n\nb\n\n\nc", "en"), (15, "\n".join(["One line that is long enough to count."] * 3), "en"),
]


def documents(spark, rows=ROWS):
    """documents with extra columns whose names operators use for their own."""
    return spark.createDataFrame(
        [(i, t, lang, "src", 7, "x", 1.5, 3, 4, [5]) for i, t, lang in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, found string, score double, "
        "n_removed bigint, start bigint, covers array<int>")


def empty(spark):
    return documents(spark).where("false")


def random_texts(n, seed=1, words=40, vocabulary=60):
    rng = random.Random(seed)
    names = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 8))) for _ in range(vocabulary)]
    return [" ".join(rng.choice(names) for _ in range(rng.randrange(words))) for _ in range(n)]
