"""Phrases of filings with the text around them, against a loop."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidegauge.functions import scalars

PHRASES = ("warrant", "sales agreement", "war", "a.b")


def plain(text, before, after, most):
    low, found, cuts = text.lower(), [], []
    for p in PHRASES:
        start = 0
        while len(cuts) < most and (at := low.find(p, start)) >= 0:
            found.append(p)
            cut = text[max(0, at - before) : at + len(p) + after].strip()
            if cut not in cuts:
                cuts.append(cut)
            start = at + len(p)
    return sorted(set(found)), cuts


def test_signals_equal_a_loop(spark):
    draw = random.Random(6)
    texts = ["", "none here", "axb a.b", "Warrant", "  warrant\n", "warrant" * 12] + [" ".join(draw.choice(["Warrant", "Sales Agreement", "war", "a.b", "x", "yy"]) for _ in range(draw.randrange(60))) for _ in range(60)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for before, after, most in ((5, 9, 4), (180, 260, 8)):
        rows = frame.select("i", scalars.phrase_signals("text", PHRASES, before, after, most).alias("f")).collect()
        got = {r["i"]: (r["f"]["phrases"], r["f"]["snippets"]) for r in rows}
        assert got == {i: plain(t, before, after, most) for i, t in enumerate(texts)}


def test_amounts(spark):
    text = "Sold $ 1,250.50 million, $3 and $3 for 1,000 Shares or 5 units, 7 shares."
    row = spark.createDataFrame([(text,)], "t string").select(scalars.mentions("t", scalars.MONEY).alias("m"), scalars.mentions("t", scalars.SHARES).alias("s"), scalars.phrase_signals(F.lit(None).cast("string")).alias("f")).first()
    assert row["m"] == ["$ 1,250.50 million", "$3 "]
    assert row["s"] == ["1,000 Shares", "5 units", "7 shares"]
    assert row["f"]["phrases"] == row["f"]["snippets"] == []


def test_a_text_is_cut_once_a_phrase(spark):
    """However many places a phrase has; white space of every kind goes from both ends, and that inside stays."""
    texts = ["war \t\x0b" + "x y\n" * 3 + "\f\r", " \twar\n ", "  war  ", "é war\té ", "war " * 3000]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")
    found = frame.select("i", scalars.phrase_signals("text", PHRASES, 9, 14, 4).alias("f"))
    assert {r["i"]: (r["f"]["phrases"], r["f"]["snippets"]) for r in found.collect()} == {i: plain(x, 9, 14, 4) for i, x in enumerate(texts)}
    places = frame.select(scalars.places_of(F.col("text"), "war").alias("p"))
    assert places.collect()[-1]["p"] == list(range(0, 12000, 4))
    assert places._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
