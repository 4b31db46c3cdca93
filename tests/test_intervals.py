import random

import pytest

from pagewright.operators.intervals import coverage


def brute(intervals, domains):
    out = []
    for d, (lo, hi) in domains.items():
        cov = {p for e, s, t in intervals if e == d and s is not None and t is not None and s <= t for p in range(max(s, lo), min(t, hi) + 1)}
        run = None
        for p in range(lo, hi + 1):
            kind = "period" if p in cov else "gap"
            if run and run[1] == kind:
                run[3] = p
            else:
                run = [d, kind, p, p]
                out.append(run)
    return sorted(map(tuple, out))


@pytest.mark.parametrize("width", [1, 3, 7, 64])
def test_random_against_brute_force(spark, width):
    rng = random.Random(width)
    domains = {d: (rng.choice([-3, 0, 1]), rng.randint(1, 40)) for d in range(25)}
    iv = []
    for _ in range(200):
        s = rng.choice([None, *range(-5, 45)])
        e = rng.choice([None, *range(-5, 45)]) if s is None or rng.random() < 0.2 else s + rng.choice([0, 1, 5, 30])
        iv.append((rng.choice([None, *range(27)]), s, e))
    i = spark.createDataFrame(iv, "doc_id int, page_start int, page_end int")
    m = spark.createDataFrame([(d, lo, hi) for d, (lo, hi) in domains.items()] * 2, "doc_id int, lo int, hi int")
    got = sorted(tuple(r) for r in coverage(i, m, shard_width=width).collect())
    assert got == brute(iv, domains)


def test_empty_tables_and_extra_columns(spark):
    i = spark.createDataFrame([], "doc_id int, page_start int, page_end int, lo string, span_kind string")
    m = spark.createDataFrame([(1, 1, 3, "x"), (2, 5, 4, "x"), (3, None, 4, "x"), (None, 1, 2, "x")], "doc_id int, lo int, hi int, page_start string")
    assert [tuple(r) for r in coverage(i, m).collect()] == [(1, "gap", 1, 3)]
    assert coverage(i, m.limit(0)).count() == 0


def test_touching_and_repeated_rows(spark):
    i = spark.createDataFrame([(1, 1, 3), (1, 4, 6), (1, 4, 6), (1, 9, 99)], "doc_id int, page_start int, page_end int")
    m = spark.createDataFrame([(1, 1, 10)], "doc_id int, lo int, hi int")
    assert sorted(tuple(r) for r in coverage(i, m).collect()) == [(1, "gap", 7, 8), (1, "period", 1, 6), (1, "period", 9, 10)]


def test_wide_ranges_cost_nothing(spark):
    """Microseconds of years: rows follow the intervals, not the width of the range."""
    year = 31_536_000_000_000
    rows = [(1, 5 * year, 7 * year), (1, 7 * year + 1, 9 * year), (1, 20 * year, 20 * year + 1), (2, 3, 4)]
    i = spark.createDataFrame(rows, "doc_id int, page_start long, page_end long")
    m = spark.createDataFrame([(1, 0, 50 * year), (2, 0, 60 * year), (3, -(2**61), 2**61 - 1)], "doc_id int, lo long, hi long")
    assert sorted(tuple(r) for r in coverage(i, m).collect()) == [
        (1, "gap", 0, 5 * year - 1), (1, "gap", 9 * year + 1, 20 * year - 1), (1, "gap", 20 * year + 2, 50 * year), (1, "period", 5 * year, 9 * year), (1, "period", 20 * year, 20 * year + 1),
        (2, "gap", 0, 2), (2, "gap", 5, 60 * year), (2, "period", 3, 4), (3, "gap", -(2**61), 2**61 - 1),
    ]
