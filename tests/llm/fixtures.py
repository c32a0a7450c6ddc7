"""Small documents with everything that may go wrong in them."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(400)}" for _ in range(n))


def lined(seed: int, n: int) -> str:
    return "\n".join(words(seed * 1000 + i, 6) for i in range(n))


def rows() -> list[tuple]:
    passage = words(1, 70)
    block = lined(2, 12)
    texts = [
        None, "", " \t\n ", "one", "two words", "a b c", passage, words(3, 30) + " " + passage + " " + words(4, 30),
        words(5, 45) + "\n" + passage, block, "head\nline\n" + block + "\ntail\nend", block, lined(6, 40),
        lined(6, 40).replace("w1 ", "w2 ", 1), "Ärger über größe\x0bniño " * 30, "漢字 テスト 😀 " * 40,
        "<|endoftext|> inside " + words(7, 20), "it's 12 o'clock, isn't it?   no\t\ttabs  ", "x" * 5000,
        words(8, 60_000), "lorem ipsum " * 300, "", None, words(9, 120).upper(), words(9, 120),
        "\n\n\n", "a\n\n\nb", "#$% &* !!" * 40,
    ]
    out = [(i, t, "en" if i % 3 else None, [None, "s0", "s1", "s10", "s2"][i % 5], len(t or ""))
           for i, t in enumerate(texts)]
    out += [(100, passage, "en", "s0", 1), (100, passage, "en", "s0", 1), (101, block, "en", "s1", 2),
            (101, words(10, 80), "en", "s1", 2), (None, passage, None, None, None), (None, block, "en", "s0", 3),
            (None, None, None, None, None), (-5, words(3, 30) + " " + passage, "en", "s2", 0)]
    return out


def documents(spark):
    """The rows above in five partitions, beside columns whose names operators use too."""
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    clash = ("score", "fp", "th", "mini", "size", "shard", "label", "row", "chunks", "key", "tie", "h", "part", "kept")
    return df.select("*", *(F.lit(f"?{c}").alias(c) for c in clash))


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
