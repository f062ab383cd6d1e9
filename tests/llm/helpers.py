"""Frames shared by the tests of the training-data operators."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, root long, fp long, key string, part int, length long, row string, spans string")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(1, 9)))
                    for _ in range(n))


def edge_rows():
    long_text = words(1, 40_000)
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, long_text), (5, "short"), (5, "short"), (None, words(2, 60)),
             (None, None), (6, "1234 !!! ???"), (7, words(3, 80)), (8, words(3, 80)), (9, words(3, 79)),
             (10, words(4, 80) + " " + words(3, 70)), (11, "日本語のテキスト " * 20), (12, "a" * 400), (13, "a" * 399)]
    return [(d, t, [None, "en", "fr"][i % 3], [None, "x", "y"][i % 3], len(t) if t else None,
             0.5, 1, 2, "k", 3, 4, "r", "s") for i, (d, t) in enumerate(texts)]


def edge_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names operators use inside."""
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
