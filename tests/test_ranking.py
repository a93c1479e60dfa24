"""Row numbers against brute force, with groups far above the hot limit."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import ranking

SCHEMA = "person long, kind string, ts int, text string"


def rows(n: int, seed: int, hot_share: float, copies: int) -> list[tuple]:
    """A third or more of the rows belong to one (also NULL) group, a part of
    them exact copies of one row."""
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        person = None if rng.random() < hot_share else rng.randrange(50)
        made.append((person, rng.choice(["a", "b", None]), rng.choice([None, *range(40)]), rng.choice("xyz")))
    return made + [(None, "a", 7, "x")] * copies


def brute_force(data, newest_first: bool) -> list[tuple]:
    groups = defaultdict(list)
    for row in data:
        groups[row[0], row[1]].append(row)
    numbered = []
    for members in groups.values():
        def key(row):
            ts = row[2]
            time = (ts is None, -(ts or 0)) if newest_first else (ts is not None, ts or 0)
            return (*time, row[3])
        for i, row in enumerate(sorted(members, key=key), 1):
            numbered.append((*row, i))
    return sorted(map(repr, numbered))


@pytest.mark.parametrize("newest_first", [True, False])
@pytest.mark.parametrize("hot_rows", [None, 10**9, 300, 20])
def test_row_numbers_equal_brute_force(spark, newest_first, hot_rows):
    data = rows(3000, seed=5, hot_share=0.4, copies=500)
    time = ranking.newest_first("ts") if newest_first else ranking.oldest_first("ts")
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    got = ranking.row_numbers(df, ["person", "kind"], [time, *ranking.ties(["text"])], "n", hot_rows)
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_force(data, newest_first)


def test_many_copies_are_dealt_out_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_COPIES_PER_TASK_ROW", 7)
    data = [(1, "a", 1, "x")] * 100 + [(1, "a", 2, "x")] * 3
    df = spark.createDataFrame(data, SCHEMA)
    got = ranking.row_numbers(df, ["person"], ranking.ties(["ts"]), "n", hot_rows=10)
    numbers = sorted((r.ts, r.n) for r in got.collect())
    assert numbers == [(1, i) for i in range(1, 101)] + [(2, i) for i in range(101, 104)]


@pytest.mark.parametrize("hot_rows", [None, 10**9, 20])
@pytest.mark.parametrize("chunk", [3, 10_000])
def test_counted_copies_equal_brute_force(spark, monkeypatch, hot_rows, chunk):
    monkeypatch.setattr(ranking, "_COPIES_PER_TASK_ROW", chunk)
    data = rows(1500, seed=9, hot_share=0.4, copies=300)
    counted = spark.createDataFrame(data, SCHEMA).groupBy("person", "kind", "ts", "text")
    df = counted.agg(F.count(F.lit(1)).alias("n_copies"))
    order = [ranking.newest_first("ts"), *ranking.ties(["text"])]
    got = ranking.row_numbers(df, ["person", "kind"], order, "n", hot_rows, "n_copies")
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_force(data, True)


def test_a_hot_group_is_spread_over_tasks(spark):
    df = spark.range(20_000).select(F.lit(1).alias("person"), F.col("id").alias("ts"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranking.row_numbers(df, ["person"], [F.col("ts").asc()], "n", hot_rows=100)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 3
    assert max(sizes) < 12_000


def test_first_rows_are_limited_before_the_shuffle(spark):
    df = spark.createDataFrame(rows(200, 1, 0.4, 5), SCHEMA)
    first = ranking.first_rows(df, ["person"], [ranking.newest_first("ts"), *ranking.ties(["text"])], "n")
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    assert {r.n for r in first.collect()} == {1}


def test_copies_of_a_hot_group_are_dealt_to_many_tasks(spark):
    df = spark.range(400).selectExpr("1 AS person", "id AS ts", "900L AS n_copies")
    got = ranking.row_numbers(df, ["person"], ranking.ties(["ts"]), "n", hot_rows=1000, copies="n_copies")
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 360_000 and max(per_task) < 200_000
    assert got.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 360_000, 360_000)
