"""Java-compatible string functions against straightforward Python models."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from rillet.functions.text import java_split, java_string_hash, poly_hash, scaled_hash_code

ALPHABET = st.sampled_from(list("ab _,é€x\n"))
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=1, max_size=40)


def java_split_model(s: str, sep: str):
    if s == "":
        return [""]
    parts = re.split(re.escape(sep), s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def java_hash_model(s: str) -> int:
    h = 0
    for ch in s:
        h = (h * 31 + ord(ch)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def poly_model(s: str, seed=61, cap=1 << 29) -> int:
    h = 0
    for ch in s:
        h = h * seed + ord(ch)
    return h & (cap - 1)


@settings(max_examples=5, deadline=None)
@given(TEXTS, st.sampled_from([" ", ",", "_"]))
def test_java_split_model(spark, texts, sep):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.p for r in df.select(java_split("s", sep).alias("p")).collect()]
    assert got == [java_split_model(t, sep) for t in texts]


@settings(max_examples=5, deadline=None)
@given(TEXTS)
def test_hash_models(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select("s", java_string_hash("s").alias("h"), scaled_hash_code("s", 23).alias("h23"),
                     poly_hash("s").alias("p")).collect()
    for r in rows:
        h = java_hash_model(r.s)
        assert r.h == h
        assert r.h23 == ((h * 23 + (1 << 31)) % (1 << 32)) - (1 << 31)
        assert r.p == poly_model(r.s)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=-(1 << 63), max_value=(1 << 63) - 1), min_size=1, max_size=40))
def test_integer_poly_hash_matches_string_form(spark, values):
    from rillet.functions.text import poly_hash_of_integer
    df = spark.createDataFrame([(v,) for v in values], "u bigint")
    rows = df.select("u", poly_hash_of_integer("u").alias("h")).collect()
    assert [r.h for r in rows] == [poly_model(str(v)) for v in values]


def test_scratch_is_the_applications_own(spark):
    import os

    from rillet.session import list_subdirs, scratch_path, scratch_root

    path = scratch_path(spark, "mine")
    spark.range(3).write.parquet(path)
    assert os.path.basename(path) in list_subdirs(spark, scratch_root(spark))
    assert spark.sparkContext.applicationId in path and spark.read.parquet(path).count() == 3
