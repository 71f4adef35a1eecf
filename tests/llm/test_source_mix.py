"""Mixing sources: targets against plain fractions, draws, limits and edge cases."""

from __future__ import annotations

import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from triagegrid.llm import source_mix

SCHEMA = "doc_id long, text string, source string, mix string, __MIX_rate int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "m", 1) for i, t, s in rows], SCHEMA)


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares that stop at the limit, the excess reshared until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, over = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in over)
        free = sum(weight[s] for s in names if s not in over)
        out = {s: Fraction(most * sizes[s]) if s in over else Fraction(weight[s] * rest, free) for s in names}
        more = {s for s in names if out[s] > most * sizes[s]}
        if not more:
            return out
        over |= more


def rows_for(sizes, each=7):
    rows, at = [], 0
    for s, size in sizes.items():
        while size > 0:
            rows.append((at, "w " * min(each, size), s))
            size, at = size - each, at + 1
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 5, "b": 3000, "é": 2, "z": 1, "": 40, None: 700},
        {"a": 1, "b": 2, "c": 4, "d": 8, "e": 16, "f": 9000},
        {"only": 12},
    ],
)
def test_targets_and_copies(spark, sizes):
    docs = docs_of(spark, rows_for(sizes))
    want = plain_targets(sizes)
    got = {r.source: r for r in source_mix.source_rates(docs).collect()}
    assert {s: r.source_size for s, r in got.items()} == sizes
    for s, r in got.items():
        rate = want[s] / sizes[s]
        assert r.target == float(want[s]) and r.copies == rate // 1 and r.fraction == float(rate % 1)
    assert sum(want.values()) == sum(sizes.values())


def test_copies_follow_the_draw_and_come_near_the_target(spark):
    rows = rows_for({"a": 7000, "b": 21_000, "c": 14_000})
    docs = docs_of(spark, rows)
    taken = {r.source: r.taken for r in source_mix.mixed(docs).groupBy("source").agg(F.sum(source_mix.word_count(F.col("text"))).alias("taken")).collect()}
    for s, target in plain_targets({"a": 7000, "b": 21_000, "c": 14_000}).items():
        assert abs(taken[s] - target) < 0.06 * target
    out = source_mix.with_copies(docs)
    assert out.columns == [*docs.columns, "_mix"]
    again = source_mix.with_copies(docs.repartition(3))
    first, second = ({r.doc_id: r["_mix"].copies for r in x.collect()} for x in (out, again))
    assert first == second and max(first.values()) <= 3
    assert source_mix.mixed(docs).columns == docs.columns
    other = {r.doc_id: r["_mix"].copies for r in source_mix.with_copies(docs, seed="other").collect()}
    assert other != first


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", "b"), (None, "x y z", "b"), (3, " \t\n", None), (3, " \t\n", None), (4, "w" * 300_000, "b"), (5, "v " * 50_000 + " " * 50_000, "b")]
    got = source_mix.with_copies(docs_of(spark, rows)).select("doc_id", "_mix.*").collect()
    assert len(got) == len(rows)
    assert sorted(r.size for r in got) == [0, 0, 0, 0, 1, 2, 3, 50_000]
    assert all(r.target == 0 and r.copies == 0 for r in got if r.source_size == 0)
    assert {r.copies for r in got if r.source_size} == {1}
    assert source_mix.with_copies(docs_of(spark, [])).count() == 0 and source_mix.mixed(docs_of(spark, [(1, None, None)])).count() == 0


def test_words_are_those_of_the_pattern(spark):
    texts = ["", " ", "a", " a", "a ", "a\tb\x0bc\x0c\rd\n e", "é\x85ß x y", "x\x1cy"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select("text", source_mix.word_count(F.col("text")).alias("n")).collect()
    assert [r.n for r in got] == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]
