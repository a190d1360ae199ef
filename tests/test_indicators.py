"""EMA and RSI against the recurrence, row by row, over many chunks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from candlewick.operators import indicators as IND

START = dt.date(1990, 1, 1)


def _ema(prices, p):
    out, e = [None] * len(prices), None
    for i, x in enumerate(prices):
        if i == p - 1:
            e = sum(prices[:p]) / p
        elif i >= p:
            e = e + 2 / (p + 1) * (x - e)
        out[i] = e
    return out


def _rsi(prices, p):
    moves = [None] + [b - a for a, b in zip(prices, prices[1:])]
    out, up, down = [None] * len(prices), None, None
    for i in range(p, len(prices)):
        if i == p:
            up, down = (sum(max(s * m, 0) for m in moves[1:p + 1]) / p for s in (1, -1))
        else:
            up, down = ((a * (p - 1) + max(s * moves[i], 0)) / p for a, s in ((up, 1), (down, -1)))
        out[i] = 50.0 if up + down == 0 else 100 * up / (up + down)
    return out


@pytest.fixture(scope="module")
def prices():
    rng = random.Random(7)
    return {"LONG": [round(rng.uniform(1, 900), 2) for _ in range(3 * IND.CHUNK + 5)], "EDGE": [round(rng.uniform(1, 9), 2) for _ in range(IND.CHUNK + 1)],
            "FLAT": [12.5] * 300, "SHORT": [1.0, 2.0], "ONE": [3.0]}


@pytest.mark.parametrize("period", [2, 14, 200])
@pytest.mark.parametrize("name", ["ema", "rsi"])
def test_every_value(spark, prices, name, period):
    rows = [(t, START + dt.timedelta(days=3 * i), x) for t, xs in prices.items() for i, x in enumerate(xs)]
    random.Random(1).shuffle(rows)
    closes = spark.createDataFrame(rows, "ticker string, trade_date date, close double")
    got = {}
    for r in getattr(IND, name)(closes, period).orderBy("ticker", "trade_date").collect():
        got.setdefault(r.ticker, []).append(r.value)
    for t, xs in prices.items():
        want = {"ema": _ema, "rsi": _rsi}[name](xs, period)
        assert len(got[t]) == len(want)
        assert all((g is None) == (w is None) and (w is None or abs(g - w) < 6e-5) for g, w in zip(got[t], want)), t


def test_plan_has_no_python_and_one_exchange(spark):
    closes = spark.createDataFrame([("A", START, 1.0)], "ticker string, trade_date date, close double")
    for f in (IND.ema, IND.rsi):
        plan = f(closes.where(F.col("close") > 0), 5)._jdf.queryExecution().executedPlan().toString()
        assert "Pandas" not in plan and plan.count("Exchange hashpartitioning") == 1
