"""Frames with what real tables hold now and then: nulls, empties, repeated rows, long texts, clashing names."""

import random

from pyspark.sql import functions as F

CLASHING = ["node", "rep", "sig", "root", "n", "_words", "_key", "_share", "block", "piece", "start", "length", "size",
            "target", "taken", "whole", "p", "gram", "limit", "kept", "score", "y", "v", "list", "id", "member", "unit"]


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def sentences(seed: int, n: int) -> str:
    return "\n".join(words(seed * 1000 + i, 12).capitalize() + "." for i in range(n))


def rows():
    long = sentences(5, 2_000)
    text = sentences(1, 10)
    return [(1, text, "en", "a", 3), (2, text, "en", "a", 3), (3, text.upper() + " More words here.", None, "b", 1),
            (4, None, "en", None, None), (5, "", "", "", 0), (6, " \t\n ", "fr", "b", 4), (None, text, "en", "b", 5),
            (None, None, None, None, None), (7, long, "en", "c", len(long)), (8, "one", "en", "c", 3),
            (8, "one", "en", "c", 3), (8, "two words", "en", "c", 9), (9, "ünï cödé \U0001f600 <|endoftext|> ok", "xx", "c", 9),
            (10, sentences(2, 9), "en", "a", 1), (11, sentences(2, 9) + "\nOne line more than before.", "en", "a", 1)]


def documents(spark):
    frame = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long")
    return frame.select("*", *[F.lit("x").alias(c) for c in CLASHING])


def empty(spark):
    return documents(spark).limit(0)
