"""User aggregates: partial per task, merged after one shuffle."""

import random

import pandas as pd
from pyspark.sql import functions as F

from rillet.functions.aggregates import Course, Mean, aggregate_by


def _rows(n=3000):
    rng = random.Random(2)
    out = []
    for i in range(n):
        key = None if i % 50 == 0 else "hot" if i % 3 else f"k{rng.randrange(40)}"
        out.append((key, i % 2 == 0, i, None if rng.random() < 0.1 or key == "k7" else rng.randrange(-50, 50) / 4))
    return out


SCHEMA = "k string, even boolean, arr bigint, v double"


def _expected(rows, keys):
    groups = {}
    for row in rows:
        groups.setdefault(tuple(row[i] for i in keys), []).append(row)
    return groups


def test_mean_and_course_equal_a_plain_loop(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    for held in (100_000, 5):  # tasks that send their accumulators early change nothing
        got = {(r.k, r.even): r.mean for r in aggregate_by(df, ["k", "even"], Mean("v"), held).collect()}
        want = {}
        for key, group in _expected(rows, (0, 1)).items():
            values = [r[3] for r in group if r[3] is not None]
            want[key] = sum(values) / len(values) if values else None
        assert got == want  # quarters: sums are exact in any order

        got = {r.k: tuple(r)[1:] for r in aggregate_by(df, ["k"], Course("arr", "v"), held).collect()}
        for (key,), group in _expected(rows, (0,)).items():
            there = sorted((r[2], r[3]) for r in group if r[3] is not None)
            v = [x for _, x in there]
            assert got[key] == ((len(group), there[0][0], there[-1][0], v[-1] - v[0], max(v) - min(v)) if there
                                else (len(group), None, None, None, None))
        assert len(got) == len(_expected(rows, (0,)))


def test_partial_lies_below_the_one_shuffle(spark):
    class Counted(Mean):
        """How many accumulators met."""

        state, returns = "parts bigint, n bigint", "parts bigint"

        def create(self):
            return 1, 0

        def add(self, acc, rows):
            return acc[0], acc[1] + len(rows)

        def result(self, acc):
            return (acc[0],)

    df = spark.createDataFrame(_rows(), SCHEMA).repartition(4).select("k", "arr", "v")
    out = aggregate_by(df, ["k"], Mean("v"))
    plan = out._jdf.queryExecution().sparkPlan().toString().splitlines()
    at = [i for i, line in enumerate(plan) if "MapInPandas" in line]
    shuffle = [i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert len(at) == 2 and len(shuffle) == 1 and at[0] < shuffle[0] < at[1]
    # a hot key sends an accumulator a task, not its rows
    accs = aggregate_by(df, ["k"], Counted("v")).collect()
    assert sum(r.parts for r in accs) <= 4 * len(accs)


def test_course_calls_do_not_grow_with_the_keys():
    """A batch of ten thousand keys is folded, combined and read out in a few calls."""
    course, n = Course("arr", "v"), 10_000
    rows = pd.DataFrame({"arr": range(2 * n), "v": [float(i % 7) for i in range(2 * n)]})
    group = pd.Series(range(2 * n)).mod(n).to_numpy()
    for single in ("create", "add", "merge", "result"):
        setattr(course, single, None)
    accs = course.fold(rows, group, n)
    out = course.results(course.combine(pd.concat([accs, accs]), pd.Series([*range(n), *range(n)]).to_numpy(), n))
    assert out.n.tolist() == [4] * n and out.first_at.tolist() == list(range(n))
    assert out.last_at.tolist() == list(range(n, 2 * n))
    assert out.rise.tolist() == [float((i + n) % 7 - i % 7) for i in range(n)]
    assert out.spread.tolist() == [float(abs((i + n) % 7 - i % 7)) for i in range(n)]


def test_mean_calls_do_not_grow_with_the_keys():
    mean, n = Mean("v"), 10_000
    group = pd.Series(range(2 * n)).mod(n).to_numpy()
    for single in ("create", "add", "merge", "result"):
        setattr(mean, single, None)
    accs = mean.fold(pd.DataFrame({"v": [None] * n + [i / 4 for i in range(n)]}), group, n)
    out = mean.results(mean.combine(pd.concat([accs, accs]), pd.Series([*range(n), *range(n)]).to_numpy(), n))
    assert out["mean"].tolist() == [i / 4 for i in range(n)]
    assert mean.results(mean.fold(pd.DataFrame({"v": [None]}), group[:1], 1))["mean"].isna().all()


def test_course_without_arrivals_and_with_long_ids(spark):
    big = (1 << 60) + 1
    rows = [(1, None, 5.0), (1, None, 2.0), (2, big, 1.0), (2, big + 2, 4.0), (2, None, 9.0), (None, 7, None), (3, 4, 1.5)]
    df = spark.createDataFrame(rows, "k bigint, arr bigint, v double").where("arr IS NULL OR arr > 0")
    got = {r.k: tuple(r)[1:] for r in aggregate_by(df.coalesce(1), ["k"], Course("arr", "v"), 2).collect()}
    assert got[1] == (2, None, None, None, 3.0) and got[None] == (1, None, None, None, None)
    assert got[3] == (1, 4, 4, 0.0, 0.0) and got[2][0] == 3 and got[2][3:] == (3.0, 8.0)
    long = df.where("k = 2 AND arr IS NOT NULL").union(spark.createDataFrame([(2, big, None), (4, 9, None)], df.schema))
    out = {r.k: tuple(r)[1:] for r in aggregate_by(long, ["k"], Course("arr", "v")).collect()}
    assert out == {2: (3, big, big + 2, 3.0, 3.0), 4: (1, None, None, None, None)}


def test_row_wise_form_equals_the_columnar_one(spark):
    class RowWise(Course):
        def create(self):
            return super().create()

        def merge(self, a, b):
            return super().merge(a, b)

        def result(self, acc):
            return super().result(acc)

    df = spark.createDataFrame(_rows(600), SCHEMA).repartition(3)
    for by in (["k"], ["k", "even"]):
        a, b = ({tuple(r) for r in aggregate_by(df, by, kind("arr", "v"), 7).collect()} for kind in (Course, RowWise))
        assert a == b and len(a) > 40


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = aggregate_by(df, ["k"], Course("arr", "v"))
    assert out.collect() == [] and out.columns == ["k", "n", "first_at", "last_at", "rise", "spread"]
    one = spark.createDataFrame(pd.DataFrame({"k": ["a"], "v": [1.5]}))
    assert aggregate_by(one, ["k"], Mean("v")).select("k", F.col("mean")).collect()[0].mean == 1.5
