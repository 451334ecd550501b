"""Small tables with the odd cases every operator must take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, digest string, rank long"


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(rng.choice(names) for _ in range(n))


def rows():
    """Nulls in every column, empty and very long texts, ties, repeats, odd characters; extra columns that clash."""
    base = words(120, 1)
    near = base.split()
    near[60] = "changed"
    passage = "The passage that several documents share is longer than fifty bytes, so it counts."
    long = words(30_000, 2)
    texts = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, " ".join(near), "en", "b"), (4, base.replace(" ", "\n", 3), None, "b"),
        (5, None, "en", "a"), (6, "", "de", None), (7, " \t\n", None, None), (8, long, "en", "c"), (9, long + " end", "en", "c"),
        (10, passage + " " + words(30, 3), "de", "a"), (11, words(30, 4) + " " + passage, "de", "d"),
        (12, "x" + passage + passage, None, "d"), (13, "1234 5678 !!", "en", "a"), (14, "two words", "de", "b"),
        (15, "two words", "de", "b"), (15, "two words", "de", "b"), (None, "no id here at all", "en", "a"), (None, None, None, None),
        (16, "é ü <|endoftext|> a  b c 字字字", "fr", "é"), (17, "A" * 5000, "en", "a"), (18, words(40, 5), "en", "zz"),
    ]
    return [(i, t, g, s, None if t is None else len(t), True, "clash", 7) for i, t, g, s in texts]


def documents(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)
