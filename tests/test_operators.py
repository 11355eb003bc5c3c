"""Operators on small hand-made series."""

from __future__ import annotations

import gzip
import hashlib
import random
import zipfile
from datetime import datetime, timedelta
from math import erfc, sqrt
from statistics import median

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidegauge.functions import blocks, scalars
from tidegauge.functions import time as T
from tidegauge.operators import asof, bars, events, features, metrics, outcomes, placebo, quality, quantiles, screen, writes
from tidegauge.sources import readers

T0 = datetime(2024, 1, 2, 10, 0)


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_trade_side(spark):
    rows = [("buy", 1.0, 5.0, 6.0), (None, 6.0, 5.0, 6.0), (None, 5.0, 5.0, 6.0), (None, 5.6, 5.0, 6.0), (None, 5.4, 5.0, 6.0), (None, 5.5, 5.0, 6.0), (None, 5.5, None, None), (None, 5.5, 7.0, 6.0)]
    df = frame(spark, rows, "side string, p double, b double, a double")
    got = [r[0] for r in df.select(scalars.trade_side("side", "p", "b", "a")).collect()]
    assert got == ["buy", "buy", "sell", "buy", "sell", None, None, "sell"]


def test_asof_tolerance_and_ties(spark):
    left = frame(spark, [(1, at(5), 1), (1, at(9), 2), (2, at(5), 3)], "k int, ts timestamp_ntz, id int")
    right = frame(spark, [(1, at(0), 10, 1.0), (1, at(5), 11, 2.0), (1, at(5), 12, 3.0)], "k int, ts timestamp_ntz, id int, v double")
    got = {r["id"]: (r["q_v"], r["q_age"]) for r in asof.asof_backward(left, right, ["k"], ["v"], tolerance=239).collect()}
    assert got == {1: (3.0, 0.0), 2: (None, None), 3: (None, None)}  # the largest tie counts; 240 s is too old
    edge = {r["id"]: r["q_v"] for r in asof.asof_backward(left, right, ["k"], ["v"], tolerance=240).collect()}
    assert edge[2] == 3.0
    ahead = {r["id"]: (r["q_v"], r["q_wait"]) for r in asof.asof_forward(left, right, ["k"], ["v"]).collect()}
    assert ahead == {1: (2.0, 0.0), 2: (None, None), 3: (None, None)}


def test_bars_completeness_and_order(spark):
    ticks = frame(spark, [("x", at(i), i, 100.0 + i, 1.0) for i in range(15)] + [("x", at(15), 15, 1.0, 1.0)], "k string, ts timestamp_ntz, id int, price double, size double")
    shuffled = ticks.repartition(3).orderBy(F.desc("id"))
    got = bars.build_bars(shuffled, ["k"], 900, interior=300, min_rows=15).collect()
    assert len(got) == 1
    b = got[0]
    assert (b["open"], b["close"], b["high"], b["low"], b["n"]) == (100.0, 114.0, 114.0, 100.0, 15)
    assert b["final_return"] == pytest.approx(114 / 109 - 1)
    assert b["signal_ts"] == at(15)
    assert bars.incomplete_buckets(bars.build_bars(ticks, ["k"], 900), ["k"], 15).collect()[0]["missing"] == 14


def test_gap_guard_and_no_look_ahead(spark):
    rows = [("x", at(15 * i), float(100 + i)) for i in (0, 1, 2, 4, 5)]
    df = frame(spark, rows, "k string, ts timestamp_ntz, close double")
    w = features.series(["k"], "ts")
    ret = lambda d: {r["ts"]: r["r"] for r in d.select("ts", features.lag_returns(w, {"r": 1}, ts="ts", step=900)["r"].alias("r")).collect()}
    got = ret(df)
    assert got[at(60)] is None and got[at(15)] == pytest.approx(0.01)
    later = ret(df.union(frame(spark, [("x", at(90), 1.0)], "k string, ts timestamp_ntz, close double")))
    assert {k: later[k] for k in got} == got


def test_touching_intervals_merge(spark):
    rows = [("x", at(0), at(10)), ("x", at(10), at(20)), ("x", at(2), at(3)), ("x", at(21), at(22))]
    got = features.merge_intervals(frame(spark, rows, "k string, start timestamp_ntz, end timestamp_ntz"), ["k"]).orderBy("start").collect()
    assert [(r["start"], r["end"], r["spans"]) for r in got] == [(at(0), at(20), 3), (at(21), at(22), 1)]


def test_greedy_selection(spark):
    df = frame(spark, [("x", at(m), i) for i, m in enumerate((0, 60, 119, 120, 230, 240))], "k string, ts timestamp_ntz, id int")
    assert [r["id"] for r in events.cooldown(df, ["k"], 7200).orderBy("id").collect()] == [0, 3, 5]
    ends = df.withColumn("e", F.when(F.col("id") == 0, F.lit(None)).otherwise(T.shift("ts", 3600)).cast("timestamp_ntz"))
    assert [r["id"] for r in events.greedy(ends, ["k"], "ts", F.col("e"), "id").orderBy("id").collect()] == [1, 3, 4]  # no outcome: blocks nothing


def test_baseline_is_deterministic(spark):
    df = frame(spark, [("x", at(m)) for m in range(60)], "k string, ts timestamp_ntz").withColumn("day", F.to_date("ts"))
    one = events.baseline_sample(df, "k", "day", "ts", 1.0, "s").collect()
    assert len(one) == 1 and one == events.baseline_sample(df.repartition(7), "k", "day", "ts", 1.0, "s").collect()
    assert events.baseline_sample(df, "k", "day", "ts", 0.0, "s").count() == 0


def test_window_chunks_and_sessions(spark):
    df = frame(spark, [(at(0), at(700)), (at(0), at(300)), (at(0), at(0))], "start timestamp_ntz, end timestamp_ntz")
    got = events.chunk_windows(df, 300).orderBy("end", "chunk").select("chunk_start", "chunk_end").collect()
    assert [tuple(r) for r in got] == [(at(0), at(0)), (at(0), at(300)), (at(0), at(300)), (at(300), at(600)), (at(600), at(700))]
    # 14:30 UTC is 09:30 in New York in winter and 10:30 in summer; the session starts at 09:30 local
    stamps = frame(spark, [("2024-01-16 14:30:00",), ("2024-01-16 14:29:00",), ("2024-07-16 13:30:00",), ("2024-01-20 15:00:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"), "s")
    inside = {r["s"] for r in stamps.where(T.in_session("ts", 570, 960, "America/New_York")).collect()}
    assert inside == {"2024-01-16 14:30:00", "2024-07-16 13:30:00"}


def test_epoch_units(spark):
    df = frame(spark, [(1_704_189_600,), (1_704_189_600_000,), (1_704_189_600_000_000,), (1_704_189_600_000_000_000,)], "v long")
    assert {r[0] for r in df.select(T.from_epoch("v")).collect()} == {datetime(2024, 1, 2, 10)}


def test_book_levels(spark):
    df = frame(spark, [('[["99", "5"], ["98", "0"]]',), ('[{"price": 99, "size": 5}, {"price": -1, "size": 2}]',), ("[]",)], "t string")
    got = [[tuple(x) for x in r[0]] for r in df.select(blocks.price_levels("t")).collect()]
    assert got == [[(99.0, 5.0)], [(99.0, 5.0)], []]


def test_outcomes_and_sweep(spark):
    prices = frame(spark, [("x", at(60 * i), 100.0 - i) for i in range(6)], "k string, ts timestamp_ntz, close double")
    trades = outcomes.hedged(prices.where(F.col("ts") == at(0)).select("k", "ts").withColumn("id", F.lit(1)), prices, ["k"], 3600, 3 * 3600, 0.0, 0.01)
    row = trades.collect()[0]
    assert row["gross"] == pytest.approx(3 / 99) and row["net"] == pytest.approx(3 / 99 - 0.01)
    path = outcomes.excursions(trades, prices, ["k"], 3600).collect()[0]
    assert (path["points"], path["mae"]) == (4, 0.0) and path["mfe"] == pytest.approx(3 / 99)
    holed = outcomes.excursions(trades, prices.where(F.col("ts") != at(120)), ["k"], 3600).collect()[0]
    assert holed["points"] == 3 and holed["mae"] is None
    asks = frame(spark, [("b", 101.0, 2.0, 1), ("b", 102.0, 4.0, 2)], "k string, price double, amount double, i int")
    grid = outcomes.sweep(asks, ["k"], (304.0, 1e6), F.col("price"), "i")
    got = {r["notional"]: r for r in grid.collect()}
    assert got[304.0]["depth_ok"] and got[304.0]["quantity"] == pytest.approx(3.0)
    assert not got[1e6]["depth_ok"] and got[1e6]["quantity"] is None and got[1e6]["unfilled"] == pytest.approx(1e6 - 610)
    bids = frame(spark, [("b", 110.0, 1.0, 1), ("b", 100.0, 9.0, 2)], "k string, price double, amount double, i int")
    sold = {r["notional"]: r for r in outcomes.capacity_returns(grid, bids, ["k"], F.desc("price"), "i").collect()}
    assert sold[304.0]["proceeds"] == pytest.approx(310.0) and sold[304.0]["return"] == pytest.approx(310 / 304 - 1)
    assert not sold[1e6]["depth_ok"] and sold[1e6]["return"] is None
    none = outcomes.capacity_returns(grid, bids.where("false"), ["k"], F.desc("price"), "i").collect()
    assert not any(r["depth_ok"] for r in none)


def test_band_sum_is_open_at_the_start(spark):
    e = frame(spark, [(1, "x", at(0), at(60))], "id int, k string, entry_ts timestamp_ntz, exit_ts timestamp_ntz")
    paid = frame(spark, [("x", at(0), 1.0), ("x", at(30), 2.0), ("x", at(60), 4.0), ("x", at(61), 8.0)], "k string, ts timestamp_ntz, v double")
    assert outcomes.band_sum(e, paid, ["k"], "v").collect()[0]["paid"] == 6.0


def plain_metrics(rows):
    """The thirty metrics of (ts, id, net, symbol, mae, mfe, concurrency) rows, one after the other."""
    rows = sorted(rows, key=lambda r: r[:3])
    x = [r[2] for r in rows]
    won, lost = [v for v in x if v > 0], [v for v in x if v < 0]
    total = peak = worst = 0.0
    streak = longest = 0
    for v in x:
        total += v
        peak = max(peak, total)
        worst = min(worst, total - peak)
        streak = streak + 1 if v < 0 else 0
        longest = max(longest, streak)
    counts = {}
    for r in rows:
        counts[r[3]] = counts.get(r[3], 0) + 1
    gaps = [int((b[0] - a[0]).total_seconds()) for a, b in zip(rows, rows[1:])]
    avg = lambda v: sum(v) / len(v) if v else None
    mid = lambda v: median(v) if v else None
    at = lambda q: sorted(x)[int((len(x) - 1) * q)] + (sorted(x)[min(len(x) - 1, int((len(x) - 1) * q) + 1)] - sorted(x)[int((len(x) - 1) * q)]) * ((len(x) - 1) * q % 1)
    low = min(lost) if lost else 0.0
    return {
        "n": len(x), "wins": len(won), "losses": len(lost), "flats": len(x) - len(won) - len(lost), "n_symbols": len(counts), "n_dates": len({r[0].date() for r in rows}), "most_of_one_symbol": max(counts.values()),
        "hit_rate": len(won) / len(x), "mean": avg(x), "median": mid(x), "avg_winner": avg(won), "median_winner": mid(won), "avg_loser": avg(lost), "median_loser": mid(lost),
        "profit_factor": sum(won) / -sum(lost) if lost else float("inf") if won else None, "worst_loss": low, "p05": at(0.05), "p01": at(0.01), "worst_mae": min(r[4] for r in rows), "best_mfe": max(r[5] for r in rows),
        "worst_loss_ratio": -low / avg(won) if won else None, "losers_near": sum(-v <= 0.1 * avg(won) for v in lost) / len(lost) if lost and won else None if lost else 1.0,
        "total": sum(x), "drawdown": worst, "losing_streak": longest, "longest_gap": max(gaps) if gaps else None, "max_concurrency": max(r[6] for r in rows), "avg_concurrency": avg([r[6] for r in rows]),
    }


@pytest.mark.parametrize("limit", [1_000_000, 2])
def test_trade_metrics_equal_a_plain_pass(spark, monkeypatch, limit):
    draw = random.Random(5)
    monkeypatch.setattr(quantiles.percentiles_of, "__defaults__", (None, limit))
    rows = []
    for g, n in (("many", 400), ("few", 5), ("gains", 6), ("losses", 7), ("flat", 3), ("one", 1)):
        for i in range(n):
            net = {"gains": abs, "losses": lambda v: -abs(v), "flat": lambda v: 0.0}.get(g, lambda v: v)(round(draw.choice([0.0, draw.uniform(-1, 1), draw.uniform(-1, 0.4)]), 3) or (0.0 if g not in ("gains", "losses") else 0.5))
            rows.append((g, at(draw.randrange(0, 60 * 24 * 40)), draw.randrange(50), net, draw.choice("abc"), -draw.random(), draw.random(), draw.randrange(9)))
    df = frame(spark, rows, "g string, ts timestamp_ntz, id int, net double, symbol string, mae double, mfe double, concurrency int")
    got = {r["g"]: r.asDict() for r in metrics.trade_metrics(df, ["g"]).collect()}
    for g in got:
        expected = plain_metrics([r[1:] for r in rows if r[0] == g])
        for k, v in expected.items():
            assert got[g][k] == (v if v is None or isinstance(v, int) else pytest.approx(v)), (g, k)
        assert len(got[g]) == 31
    assert set(got) == {"many", "few", "gains", "losses", "flat", "one"}
    assert got["flat"]["losing_streak"] == 0 and got["gains"]["profit_factor"] == float("inf") and got["flat"]["profit_factor"] is None


def test_event_metrics_edges(spark):
    df = frame(spark, [("gains", 0.1), ("gains", 0.12), ("losses", -0.1), ("one", 0.2)], "g string, net double")
    got = {r["g"]: r for r in metrics.event_metrics(df, ["g"]).collect()}
    assert got["gains"]["worst_loss_ratio"] == 0 and got["gains"]["profit_factor"] is None and got["gains"]["avg_winner"] == pytest.approx(0.11)
    assert got["losses"]["worst_loss_ratio"] is None and got["one"]["sd"] is None and got["gains"]["sd"] == pytest.approx(0.0141421356)


def test_percentiles_and_places_by_range_equal_those_in_memory(spark):
    draw = random.Random(8)
    rows = [(draw.choice("ab"), float(draw.choice([3, 3, 3, draw.randrange(200)]))) for _ in range(3000)] + [("c", 1.0), ("d", None)]
    df = frame(spark, rows, "g string, v double").repartition(7)
    points = {"p0": 0.0, "p37": 0.37, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    a, b = (sorted(tuple(r) for r in quantiles.percentiles(df, ["g"], "v", points, limit).collect()) for limit in (10**6, 1))
    assert len(a) == len(b) == 3
    for x, y in zip(a, b, strict=True):
        assert x[0] == y[0] and x[1:] == pytest.approx(y[1:])
    placed = quantiles.places(df.where("v is not null"), ["g"], ["v"], "r").collect()
    for g in "ab":
        own = sorted((r["r"], r["v"]) for r in placed if r["g"] == g)
        assert [x for x, _ in own] == list(range(1, len(own) + 1)) and [v for _, v in own] == sorted(v for _, v in own)
    assert sorted(r["r"] for r in quantiles.places(df, [], ["v"], "r").collect()) == list(range(1, len(rows) + 1))


def test_concentration_and_gates(spark):
    rows = [("even", s, 0.1, i) for i, s in enumerate("abcdef")] + [("led", "a", 5.0, 0), ("led", "b", -0.1, 1), ("led", "c", -0.1, 2), ("single", "a", 1.0, 0)]
    df = frame(spark, rows, "g string, s string, net double, i int")
    got = {r["g"]: r for r in metrics.concentration(df, ["g"], "s").collect()}
    assert got["even"]["concentration_ok"] and not got["led"]["concentration_ok"] and not got["single"]["concentration_ok"]
    assert got["led"]["worst_left_out"] == pytest.approx(-0.1) and got["led"]["mean_rest"] == pytest.approx(-0.1)
    g = {r["g"]: r for r in placebo.gates(df, ["g"], "s", F.col("i") % 3, F.col("i") < 2, [0.01, 0.05], cost=0.01).collect()}
    assert g["even"]["positive_blocks"] == 3 and g["even"]["stressed_ok"] and g["even"]["executable_ok"] and g["even"]["mean_stressed"] == pytest.approx(0.04)
    assert not g["led"]["stressed_ok"] and g["led"]["profit_factor"] == pytest.approx(4.99 / 0.22)
    m = frame(spark, [(9, 0.6, 0.1, 2.0, 0.1, True, True), (20, 0.6, 0.1, 2.0, 0.1, True, True), (20, 0.6, 0.1, 2.0, -0.1, True, True), (20, 0.6, 0.1, None, 0.1, False, True)], "n int, hit_rate double, mean double, profit_factor double, mean_stressed double, checks_ok boolean, concentration_ok boolean")
    assert [r["grade"] for r in placebo.grade_forward(m).collect()] == ["B", "A", "D", "C"]


def test_tail_probabilities(spark):
    zs = [-3.0, 0.0, 1.0, 2.5, None]
    df = frame(spark, [(z,) for z in zs], "z double")
    got = [tuple(r) for r in df.select(screen.one_sided_p("z"), screen.two_sided_p("z")).collect()]
    for z, (one, two) in zip(zs, got, strict=True):
        if z is None:
            assert one is None
        else:
            assert one == pytest.approx(0.5 * erfc(z / sqrt(2))) and two == pytest.approx(min(1, erfc(abs(z) / sqrt(2))))


def test_bh_and_freeze(spark):
    df = frame(spark, [("a", 0.001), ("b", 0.02), ("c", 0.5), ("d", None)], "t string, p double")
    got = {r["t"]: r["q"] for r in screen.bh_qvalues(df, tie=["t"]).collect()}
    assert got["a"] == pytest.approx(0.003) and got["b"] == pytest.approx(0.03) and got["c"] == pytest.approx(0.5) and got["d"] is None


def test_screen_config_is_checked():
    phases = {"discovery": (at(0), at(10)), "validation": (at(10), at(20))}
    screen.ScreenConfig(**phases)
    for wrong in ({"quantiles": (0.5,)}, {"quantiles": ()}, {"fdr": 0}, {"validation": (at(5), at(20))}, {"discovery": (at(10), at(10))}):
        with pytest.raises(ValueError):
            screen.ScreenConfig(**(phases | wrong))


def test_holdout_opens_once(spark, tmp_path):
    guard = screen.HoldoutGuard(spark, f"file://{tmp_path}/h")
    df = frame(spark, [("a", 1), ("a", 2), ("b", 1), ("b", 2)], "entity string, h int")
    with pytest.raises(ValueError):
        guard.write(df, 5, "entity", 2)
    guard.write(df, 4, "entity", 2, {("entity",): 2})
    assert guard.open().count() == 4
    with pytest.raises(PermissionError):
        guard.open()


def test_permutation_keeps_values(spark):
    df = frame(spark, [("g", i, float(i)) for i in range(20)], "g string, id int, v double")
    got = screen.permuted(df, ["g"], ["id"], ["s", "t"], ["v"]).collect()
    for seed in "st":
        own = [r for r in got if r["seed"] == seed]
        assert sorted(r["v"] for r in own) == [float(i) for i in range(20)] and any(r["v"] != r["id"] for r in own)
    assert [r["v"] for r in sorted(got, key=lambda r: (r["seed"], r["id"]))][:20] != [r["v"] for r in sorted(got, key=lambda r: (r["seed"], r["id"]))][20:]


def test_permutation_of_rows_that_share_an_id_is_the_same_each_time(spark):
    rows = [("g", 1, float(i), i) for i in range(6)] + [("g", 2, 9.0, 0), ("g", 2, 9.0, 0)]
    df = frame(spark, rows, "g string, id int, v double, k int")
    a, b = (sorted((r["id"], r["k"], r["v"]) for r in screen.permuted(x, ["g"], ["id", "v", "k"], ["s"], ["v"]).collect()) for x in (df.repartition(3), df.orderBy(F.desc("v")).coalesce(1)))
    assert a == b


def test_config_problems_are_those_of_the_config(spark):
    day = lambda n: datetime(2024, 1, n)
    rows = [(q, day(a), day(b), day(c), day(d), f) for q in ([0.1], [], [0.5], [0.2, 0.0]) for a, b, c, d in ((1, 5, 5, 9), (5, 5, 6, 9), (1, 5, 4, 9), (1, 5, 6, 6)) for f in (0.05, 0.0, 1.0)]
    df = frame(spark, rows, "quantiles array<double>, discovery_start timestamp_ntz, discovery_end timestamp_ntz, validation_start timestamp_ntz, validation_end timestamp_ntz, fdr double")
    for r in screen.config_problems(df).collect():
        try:
            screen.ScreenConfig((r[1], r[2]), (r[3], r[4]), tuple(r[0]), fdr=r[5])
            assert r["problems"] == []
        except ValueError:
            assert r["problems"]


def test_perturbation_and_grades(spark):
    df = frame(spark, [(1.0, 5.0), (1.15, 5.0), (None, 9.0)], "a double, b double")
    got = {(r["parameter"], r["factor"]): r["count"] for r in placebo.perturbed(df, {"a": ("<=", 1.0), "b": (">=", 5.0)}, [0.8, 1.2]).groupBy("parameter", "factor").count().collect()}
    assert got == {("a", 1.2): 2, ("b", 0.8): 1}
    m = frame(spark, [(0.6, 0.1, 40, 2, True), (0.6, 0.1, 9, 2, True), (0.4, -0.1, 40, 0, True), (0.4, 0.1, 40, 3, True)], "hit_rate double, mean double, n int, positive_blocks int, ok boolean")
    m = m.withColumns({k: F.col("ok") for k in ("stressed_ok", "executable_ok", "concentration_ok")})
    assert [r["grade"] for r in placebo.grade_history(m).collect()] == ["A", "B", "D", "C"]


def test_quality_gate_and_contracts(spark):
    df = frame(spark, [(1,), (None,), (3,)], "v int")
    checks = quality.contracts(df, {"known": ("error", F.col("v") > 0)})
    assert checks.collect()[0]["violations"] == 1  # unknown violates
    assert quality.gate(checks).collect()[0]["verdict"] == "fail"
    assert quality.gate(checks.withColumn("severity", F.lit("warning"))).collect()[0]["verdict"] == "review"
    assert quality.gate(checks.withColumn("violations", F.lit(0))).collect()[0]["verdict"] == "pass"
    with pytest.raises(PySparkException):
        quality.enforce(df, {"known": F.col("v") > 0}).collect()


def test_writes_to_files(spark, tmp_path):
    df = frame(spark, [("a", 1), ("b", 2)], "k string, v int")
    path = f"file://{tmp_path}/t"
    writes.replace_slice(df, path, ["k"])
    writes.replace_slice(frame(spark, [("b", 3)], "k string, v int"), path, ["k"])
    assert {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 3)}
    manifest = writes.write_segments(df, f"file://{tmp_path}/s", ["k"])
    stored = {r["k"]: r for r in manifest.collect()}
    assert {k: r["rows"] for k, r in stored.items()} == {"a": 1, "b": 1}
    for r in stored.values():
        content = open(r["path"].removeprefix("file:"), "rb").read()
        assert (len(content), hashlib.sha256(content).hexdigest()) == (r["bytes"], r["checksum"])
    assert spark.read.json(f"file://{tmp_path}/s").count() == 2
    writes.export_csv({"t": df.withColumn("n", F.struct("v"))}, f"file://{tmp_path}/e")
    assert spark.read.option("header", True).option("escape", '"').csv(f"file://{tmp_path}/e/t").where("k = 'a'").collect()[0]["n"] == '{"v":1}'


def test_quote_files_and_required_columns(spark, tmp_path):
    lines = ["exchange,symbol,timestamp,local_timestamp,ask_amount,ask_price,bid_price,bid_amount", "x,S,1704189600000000,1704189600000001,2,101,99,3", "x,S,bad,0,1,1,1,1", "x,S,1704189600000000,0,1,,1,1"]
    with gzip.open(tmp_path / "q.csv.gz", "wt") as out:
        out.write("\n".join(lines))
    got = readers.quote_files(spark, f"file://{tmp_path}/q.csv.gz").collect()
    assert len(got) == 1 and got[0]["ts"] == datetime(2024, 1, 2, 10) and (got[0]["ask_price"], got[0]["bid_amount"]) == (101.0, 3.0)
    with gzip.open(tmp_path / "w.csv.gz", "wt") as out:
        out.write("exchange,symbol,timestamp\nx,S,1\n")
    with pytest.raises(ValueError):
        readers.quote_files(spark, f"file://{tmp_path}/w.csv.gz")


def test_unknown_messages_are_counted(spark):
    rows = [
        ("binance_spot", "{broken"), ("binance_spot", None), ("nowhere", "{}"), ("kraken", '{"channel":"trade","data":[]}'), ("kraken", '{"channel":"heartbeat"}'), ("coinbase", '{"type":"match","product_id":"A","price":"x","size":"1"}'),
        ("bybit", '{"topic":"publicTrade.A","data":[{"T":1704189600000,"S":"Buy","v":"1","p":"2"},{"T":1704189600000,"S":"Sell","v":"3","p":"4"}]}'),
    ]
    got = readers.venue_events(frame(spark, rows, "venue string, body string")).groupBy("venue", "kind").count().collect()
    assert {(r["venue"], r["kind"]): r["count"] for r in got} == {("binance_spot", "unknown"): 2, ("nowhere", "unknown"): 1, ("kraken", "unknown"): 2, ("coinbase", "unknown"): 1, ("bybit", "trade"): 2}


def test_zip_klines(spark, tmp_path):
    start = 1_704_189_600_000
    lines = ["open_time,open,high,low,close,volume,close_time,quote_volume,count,a,b,c"]
    lines += [f"{start + 60_000 * i},1,2,0.5,{1 + i},10,0,10,3,1,4,0" for i in range(30) if i != 20] + ["broken"]
    with zipfile.ZipFile(tmp_path / "BTC-1m-2024-01.zip", "w") as z:
        z.writestr("BTC-1m-2024-01.csv", "\n".join(lines))
    rows = readers.klines(readers.zip_lines(spark, f"file://{tmp_path}"))
    assert rows.count() == 29
    built = bars.build_bars(rows.select(F.lit("x").alias("k"), "ts", F.monotonically_increasing_id().alias("id"), F.col("close").alias("price"), F.col("volume").alias("size")), ["k"], 900)
    assert built.where("n = 15").count() == 1
    assert bars.incomplete_buckets(built, ["k"], 15).collect()[0]["missing"] == 1


def test_reader_errors_and_aliases(spark):
    df = frame(spark, [(1, 0.0001)], "calc_time int, last_funding_rate double")
    assert readers.resolve_columns(df, readers.FUNDING).columns == ["ts", "rate"]
    with pytest.raises(ValueError):
        readers.resolve_columns(df.drop("calc_time"), readers.FUNDING)
    with pytest.raises(ValueError):
        readers.named_by_position(df, ["a"])
    with pytest.raises(ValueError):
        readers.required(df, ["nope"])
    candles = frame(spark, [("[[1704189600, 1, 4, 2, 3, 9]]",)], "b string")
    assert tuple(readers.candle_payloads(candles, "b", []).collect()[0]) == (datetime(2024, 1, 2, 10), 1.0, 4.0, 2.0, 3.0, 9.0)


def test_empty_tables(spark):
    empty = frame(spark, [], "k string, ts timestamp_ntz, id int, price double, size double")
    assert bars.build_bars(empty, ["k"], 60).count() == 0
    assert events.cooldown(empty, ["k"], 60).count() == 0
    assert asof.asof_backward(empty, empty, ["k"], ["price"]).count() == 0
    assert features.concurrency(empty.withColumn("e", F.col("ts")), ["k"], "ts", "e").count() == 0
