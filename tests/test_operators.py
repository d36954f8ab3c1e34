"""Operators against plain Python on random rows with duplicates, ties and NULLs."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shopledger.functions.cleaning import Band, band, recode
from shopledger.operators.cohort import new_versus_returning
from shopledger.operators.dedup import keep_first
from shopledger.operators.funnel import funnel_stages
from shopledger.operators.rollup import rollup_distinct, rollup_via


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(7)

    def maybe(value):
        return None if pick.random() < 0.15 else value

    return [
        (maybe(pick.choice("abc")), maybe(pick.randint(1, 40)), maybe(pick.randint(-5, 9)), maybe(pick.random() < 0.4))
        for _ in range(800)
    ]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "g string, id int, v int, flag boolean").repartition(5).cache()


def total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def test_rollup_distinct(df, rows):
    got = rollup_distinct(
        df,
        ["g"],
        "id",
        {"v": F.col("v")},
        {"flagged": F.col("flag"), "ids": F.lit(True)},
        earliest={"low": F.col("v")},
        latest={"high": F.col("v")},
    ).collect()
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    expected = {
        g: (
            total(r[2] for r in members),
            len({r[1] for r in members if r[3] and r[1] is not None}),
            len({r[1] for r in members} - {None}),
            min(r[2] for r in members if r[2] is not None),
            max(r[2] for r in members if r[2] is not None),
        )
        for g, members in groups.items()
    }
    assert {r["g"]: tuple(r[1:]) for r in got} == expected


def test_rollup_distinct_equals_count_distinct(df):
    ours = rollup_distinct(df, ["g"], "id", {"v": F.col("v")}, {"n": F.col("flag")})
    theirs = df.groupBy("g").agg(F.sum("v").alias("v"), F.count_distinct(F.when(F.col("flag"), F.col("id"))).alias("n"))
    assert ours.exceptAll(theirs).count() == theirs.exceptAll(ours).count() == 0


def test_rollup_without_keys_or_rows(df):
    empty = rollup_distinct(df.filter("false"), [], "id", {"v": F.col("v")}, {"n": F.lit(True)})
    assert [tuple(r) for r in empty.collect()] == [(None, 0)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_rollup_via_equals_join_then_group(spark, df, how):
    # Id 3 is listed twice and ids above 30 not at all.
    names = spark.createDataFrame([(i, f"n{i % 4}") for i in [*range(1, 31), 3]], "id int, name string")
    ours = rollup_via(df, "id", names, ["name"], {"v": F.col("v"), "n": F.lit(1)}, how)
    theirs = df.join(names, "id", how).groupBy("name").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"))
    assert ours.exceptAll(theirs).count() == theirs.exceptAll(ours).count() == 0


def test_keep_first(df, rows):
    got = keep_first(df, ["g"], ["v", "id", "flag"]).collect()

    def nulls_first(row):
        return [(x is not None, x if x is not None else 0) for x in (row[2], row[1], row[3])]

    best = {}
    for row in rows:
        if row[0] not in best or nulls_first(row) < nulls_first(best[row[0]]):
            best[row[0]] = row
    assert {r["g"]: tuple(r) for r in got} == best


def test_new_versus_returning(df, rows):
    got = new_versus_returning(df.filter("g IS NOT NULL"), "id", "g", F.col("v")).collect()
    seen = [r for r in rows if r[0] is not None and r[1] is not None]
    first = {}
    for g, i, *_ in seen:
        first[i] = min(first.get(i, g), g)
    expected = {
        p: (
            sum(f == p for f in first.values()),
            len({i for g, i, *_ in seen if g == p and first[i] < p}),
            total(v for g, i, v, _ in seen if g == p and first[i] == p),
            total(v for g, i, v, _ in seen if g == p and first[i] < p),
        )
        for p in "abc"
    }
    assert {r["g"]: tuple(r[1:]) for r in got} == expected


def test_funnel_stages(spark):
    counts = spark.createDataFrame([(8, 2)], "a long, b long")
    out = funnel_stages(counts, [("a", "All"), ("b", "Some")], lambda step, part, base: part * 100 / base)
    assert [tuple(r) for r in out.orderBy("step").collect()] == [(1, "All", 8, 100.0), (2, "Some", 2, 25.0)]


def test_band_and_recode(spark):
    df = spark.createDataFrame([(1, "Ab"), (5, "cd"), (9, "EF"), (None, None)], "n int, s string")
    out = df.select(
        band(F.col("n"), [Band("low", below=5), Band("mid", at_least=5, at_most=8)], "rest").alias("n"),
        recode(F.col("s"), {"Ab": "x", "CD": "y"}).alias("strict"),
        recode(F.col("s"), {"Ab": "x", "CD": "y"}, ignore_case=True).alias("loose"),
    ).collect()
    assert [tuple(r) for r in out] == [("low", "x", "x"), ("mid", "cd", "y"), ("rest", "ef", "ef"), ("rest", None, None)]
