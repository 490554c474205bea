"""Typed parsing agrees with the SQL engine the warehouse was defined in, on random
inputs: lenient integer casts (rounding, blanks, junk, overflow) and day-first
timestamps with and without zero padding."""

from __future__ import annotations

import random

import duckdb
from pyspark.sql import functions as F

from careflow.functions.parsing import parse_int_rounding, parse_visit_ts


def _int_texts(n=400, seed=11):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.3:
            s = str(rnd.randint(-500, 500))
        elif kind < 0.6:
            s = f"{rnd.uniform(-300, 300):.{rnd.randint(1, 3)}f}"
        elif kind < 0.7:
            s = f"{rnd.randint(-99, 99)}.5"
        elif kind < 0.8:
            s = " " * rnd.randint(0, 2) + str(rnd.randint(0, 99)) + " " * rnd.randint(0, 2)
        elif kind < 0.9:
            s = rnd.choice(["abc", "", "1e2", "12abc", "--3", "99999999999", "2147483647", "-2147483648",
                            "2147483648", "+7", "0.0", "-0"])
        else:
            s = None
        out.append(s)
    return out


def test_int_parsing_matches_duckdb(spark):
    texts = _int_texts()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    ours = {r["i"]: r["v"] for r in df.select("i", parse_int_rounding(F.col("t")).alias("v")).collect()}
    con = duckdb.connect()
    con.execute("create table x (i int, t varchar)")
    con.executemany("insert into x values (?, ?)", list(enumerate(texts)))
    theirs = dict(con.execute("select i, try_cast(t as integer) from x").fetchall())
    diff = {texts[i]: (ours[i], theirs[i]) for i in ours if ours[i] != theirs[i]}
    assert not diff, diff


def test_day_first_timestamps_match_duckdb(spark):
    rnd = random.Random(5)
    texts = []
    for _ in range(300):
        d, m, y = rnd.randint(1, 28), rnd.randint(1, 12), rnd.randint(1995, 2030)
        hh, mm = rnd.randint(0, 23), rnd.randint(0, 59)
        pad = rnd.random() < 0.5
        texts.append(f"{d:02d}-{m:02d}-{y} {hh:02d}:{mm:02d}" if pad else f"{d}-{m}-{y} {hh}:{mm}")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    ours = {r["i"]: r["v"] for r in df.select("i", parse_visit_ts(F.col("t")).alias("v")).collect()}
    con = duckdb.connect()
    con.execute("create table x (i int, t varchar)")
    con.executemany("insert into x values (?, ?)", list(enumerate(texts)))
    theirs = dict(con.execute("select i, strptime(t, '%d-%m-%Y %H:%M') from x").fetchall())
    assert ours == theirs
