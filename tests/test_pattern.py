import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventide.operators import Stage, match_pattern, match_sequence

T0 = datetime(2024, 1, 1)


def brute(rows, letters, strict, within):
    """Each try by itself, event by event, over the key's ordered events."""
    out = []
    for key in {r[0] for r in rows}:
        ev = sorted((r[1], r[2], r[3]) for r in rows if r[0] == key and r[1] is not None)
        for i, (t0, _, kind) in enumerate(ev):
            if kind != letters[0]:
                continue
            times, tag = [t0], "timeout"
            for t, _, kind in ev[i + 1:]:
                if t >= t0 + timedelta(seconds=within):
                    break
                k = len(times)
                if kind == letters[k]:
                    times.append(t)
                    if len(times) == len(letters):
                        tag = "matched"
                        break
                elif strict[k]:
                    tag = "broken"
                    break
            out.append((str(key), *times, *[None] * (len(letters) - len(times)), len(times), tag))
    return sorted(out, key=str)


def run(spark, rows, letters, strict, within, **kw):
    df = spark.createDataFrame(rows, "k long, t timestamp, seq long, kind string")
    stages = [Stage(f"s{i}", F.col("kind") == c, s) for i, (c, s) in enumerate(zip(letters, strict))]
    got = match_pattern(df, ["k"], "t", stages, f"{within} seconds", seq="seq", **kw)
    assert got.columns == ["k", *[f"s{i}_ts" for i in range(len(letters))], "n_matched", "tag"]
    return sorted(((str(r[0]), *r[1:]) for r in got.collect()), key=str)


def events(n, seed, kinds="abcx"):
    rnd = random.Random(seed)
    return [(rnd.choice([1, 1, 1, 2, None]), T0 + timedelta(seconds=rnd.randrange(n)), i, rnd.choice([*kinds, None]))
            for i in range(n)]


@pytest.mark.parametrize("letters,strict", [
    ("ab", (False, False)), ("aa", (False, True)), ("abc", (False, False, True)), ("abc", (False, True, False)),
    ("aba", (False, False, False)), ("abca", (False, True, True, False))])
@pytest.mark.parametrize("hot", [None, 20])
def test_patterns_equal_brute_force(spark, letters, strict, hot):
    rows = events(250, 7)
    want = brute(rows, letters, strict, 40)
    assert len({w[-1] for w in want}) > 1
    assert run(spark, rows, letters, strict, 40, hot_rows=hot) == want


def test_a_try_may_span_many_buckets(spark):
    """Key 1 is cut into buckets; the only b and c come at its very end."""
    rows = [(1, T0 + timedelta(seconds=i), i, "a" if i % 50 == 0 else "x") for i in range(600)]
    rows += [(1, T0 + timedelta(seconds=600), 600, "b"), (1, T0 + timedelta(seconds=601), 601, "c")]
    for strict in ((False, False, True), (False, False, False), (False, True, True)):
        want = brute(rows, "abc", strict, 10_000)
        assert run(spark, rows, "abc", strict, 10_000, hot_rows=50) == want
        assert {w[-1] for w in want} == ({"broken"} if strict[1] else {"matched"})


def test_null_times_empty_tables_and_bad_patterns(spark):
    rows = [(1, None, 0, "a"), (1, T0, 1, "a"), (1, T0, 2, "b"), (1, T0 + timedelta(seconds=5), 3, "c")]
    # exactly ``within`` after the start is too late
    assert run(spark, rows, "abc", (False,) * 3, 5) == [("1", T0, T0, None, 2, "timeout")]
    assert run(spark, rows, "abc", (False,) * 3, 6)[0][-1] == "matched"
    assert run(spark, [], "abc", (False,) * 3, 5) == []
    with pytest.raises(ValueError):
        match_pattern(spark.range(1), ["id"], "id", [Stage("one", F.lit(True))], "1 second")


def test_match_sequence_takes_three_stages(spark):
    df = spark.createDataFrame(events(120, 3), "k long, t timestamp, seq long, kind string")
    stages = [(c, F.col("kind") == c) for c in "abc"]
    for how, strict in (("strict", True), ("relaxed", False)):
        got = match_sequence(df, ["k"], "t", stages, "40 seconds", contiguity=how, seq="seq")
        want = match_pattern(df, ["k"], "t", [Stage(c, w, strict and c != "a") for c, w in stages], "40 seconds", seq="seq")
        want = want.filter("tag = 'matched'") if strict else want
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_exchange_for_all_stages(spark):
    df = spark.createDataFrame(events(50, 1), "k long, t timestamp, seq long, kind string")
    stages = [Stage("a", F.col("kind") == "a"), Stage("b", F.col("kind") == "b", True), Stage("c", F.col("kind") == "c")]
    plan = match_pattern(df, ["k"], "t", stages, "40 seconds", seq="seq")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
