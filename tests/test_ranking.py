from __future__ import annotations

import random

from careflow.operators.ranking import global_row_index, ntile


def brute_ntile(n, k):
    q, r = divmod(n, k)
    out = []
    for b in range(k):
        out += [b + 1] * (q + 1 if b < r else q)
    return out


def _frame(spark, n, seed):
    rnd = random.Random(seed)
    # heavy ties on the first key: one value holds about a third of the rows
    rows = [(1 if rnd.random() < 0.34 else rnd.randint(0, 30), i, rnd.randint(0, 23)) for i in range(n)]
    return spark.createDataFrame(rows, "a int, d int, h int"), rows


def test_global_row_index_is_total_order(spark):
    df, rows = _frame(spark, 1000, 7)
    got = [(r["a"], r["d"], r["h"]) for r in global_row_index(df, ["a", "d", "h"], "i").orderBy("i").collect()]
    assert got == sorted(rows)
    idx = sorted(r["i"] for r in global_row_index(df, ["a", "d", "h"], "i").collect())
    assert idx == list(range(1000))


def test_ntile_matches_sql_definition(spark):
    for n, k in [(1000, 5), (7, 5), (3, 5), (1001, 4)]:
        df, rows = _frame(spark, n, n)
        got = ntile(df, k, ["a", "d", "h"], "b").collect()
        by_key = {(r["a"], r["d"], r["h"]): r["b"] for r in got}
        expect = dict(zip(sorted(rows), brute_ntile(n, k)))
        assert by_key == expect


def test_global_cumsum_weighted(spark):
    from careflow.operators.ranking import global_cumsum

    rnd = random.Random(3)
    rows = [(rnd.choice("abc"), float(i), 1000 if i % 17 == 0 else rnd.randint(1, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "c string, x double, n long")
    got = {(r["c"], r["x"]): r["cb"] for r in global_cumsum(df, ["c", "x"], "n", "cb").collect()}
    running, expect = 0, {}
    for c, x, n in sorted(rows):
        expect[(c, x)] = running
        running += n
    assert got == expect
