"""Zip archives, spans of every length, and leave-one-out screens against pairs."""

from __future__ import annotations

import io
import random
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import asof, screen
from tidegauge.sources import archives

START = datetime(2024, 1, 1)


def test_members_of_every_file_are_read(spark, tmp_path):
    for name, members in {"a": {"x.csv": "1,2\r\n3,4\n", "empty": ""}, "sub/b": {"y": "é,ü"}}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            for m, text in members.items():
                z.writestr(m, text)
    (tmp_path / "c.txt").write_text("no archive")
    got = {(r["path"].rsplit("/", 1)[1], r["member"], r["line_no"], r["line"]) for r in archives.zip_lines(spark, f"file://{tmp_path}").collect()}
    assert got == {("a.zip", "x.csv", 0, "1,2"), ("a.zip", "x.csv", 1, "3,4"), ("b.zip", "y", 0, "é,ü")}
    assert archives.zip_lines(spark, str(tmp_path / "a.zip")).count() == 2
    assert archives.zip_lines(spark, str(tmp_path / "none")).count() == 0


def test_a_damaged_member_fails(spark, tmp_path):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as z:
        z.writestr("m", "line one\nline two\n")
    data = bytearray(raw.getvalue())
    data[data.index(b"two")] ^= 1
    (tmp_path / "bad.zip").write_bytes(data)
    with pytest.raises(Exception, match="CRC"):
        archives.zip_lines(spark, str(tmp_path)).collect()


def test_a_long_member_streams_through_one_task(spark, tmp_path):
    lines = spark.range(90_000).select(F.lit("big").alias("a"), F.lit("m").alias("b"), "id", F.concat(F.lit("row "), F.col("id").cast("string")).alias("line"))
    archives.write_zips(lines, f"{tmp_path}/z", "a", "b", ["id"])
    found = archives.zip_lines(spark, f"{tmp_path}/z")
    assert found.rdd.getNumPartitions() == 1
    assert found.where(F.col("line") == F.concat(F.lit("row "), F.col("line_no").cast("string"))).count() == 90_000


def test_headers_are_optional(spark):
    rows = [("p", "bare", 0, "1,2.5"), ("p", "bare", 1, "2, 3.5"), ("p", "headed", 0, " Rate ,OTHER,calc_time"), ("p", "headed", 1, "7.5,x,9"), ("p", "headed", 2, ",x"), ("p", "poor", 0, "other"), ("p", "poor", 1, "x")]
    lines = spark.createDataFrame(rows, "path string, member string, line_no long, line string")
    got = {(r["member"], r["line_no"], r["ts"], r["rate"]) for r in archives.fields(lines, ["ts", "rate"], {"ts": ["calc_time"]}).collect()}
    assert got == {("bare", 0, "1", "2.5"), ("bare", 1, "2", "3.5"), ("headed", 1, "9", "7.5"), ("headed", 2, None, None), ("poor", 1, None, None)}


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_spans_of_seconds_and_of_years(spark, closed, how):
    draw = random.Random(7)
    when = lambda: START + timedelta(seconds=draw.randrange(10**8))
    spans = [(draw.choice("ab"), s := when(), s + timedelta(seconds=draw.choice([0, 1, 59, 3600, 86_400, 5 * 10**7, -5])), i) for i in range(60)]
    points = [(draw.choice("abc"), when(), i) for i in range(300)] + [(k, s, 1000 + i) for k, s, _, i in spans] + [(k, e, 2000 + i) for k, _, e, i in spans]
    p, s = spark.createDataFrame(points, "k string, ts timestamp_ntz, p int"), spark.createDataFrame(spans, "k string, start timestamp_ntz, end timestamp_ntz, s int")
    got = sorted(((r["p"], r["s"]) for r in asof.interval_join(p, s, ["k"], 60, how=how, closed=closed).collect() if r["s"] is not None))
    expected = sorted((i, j) for k, t, i in points for q, a, b, j in spans if k == q and a <= t and (t <= b if closed else t < b))
    assert got == expected


def test_a_long_span_is_listed_in_few_runs(spark):
    rows = [(a, a + n) for a in (0, 1, 17, 12345) for n in (0, 3, 4, 5, 63, 64, 1000, 10**6)]
    frame = spark.createDataFrame(rows, "a long, b long").withColumn("r", asof._dyadic(F.col("a"), F.col("b")))
    for r in frame.collect():
        cells = sorted((x["cell"] << x["level"], (x["cell"] + 1) << x["level"]) for x in r["r"])
        assert cells[0][0] == r["a"]
        assert cells[-1][1] == r["b"] + 1
        assert all(x[1] == y[0] for x, y in zip(cells, cells[1:], strict=False))
        assert len(cells) <= max(asof.SHORT, 2 * (r["b"] - r["a"] + 2).bit_length())


@pytest.mark.parametrize("cost", [0.0, 0.05])
def test_leave_one_out_screen_equals_pairs(spark, cost):
    draw = random.Random(11)
    config = screen.ScreenConfig(discovery=(START, START + timedelta(hours=300)), validation=(START + timedelta(hours=300), START + timedelta(hours=500)), quantiles=(0.1, 0.3), cost=cost, min_discovery=5, min_validation=3, min_hit=0.3)
    feats, outs = [], []
    for h in range(500):
        phase = "discovery" if h < 300 else "validation"
        for e in "abcde":
            feats += [(e, START + timedelta(hours=h), f, phase, draw.gauss(0, 1)) for f in ("f", "g")]
            if draw.random() < 0.8:
                outs += [(e, START + timedelta(hours=h), z, draw.choice([None, 0.0, 0.05, -0.05, draw.gauss(0.01, 0.2)])) for z in (1, 2) for _ in range(draw.choice([1, 1, 2]))]
    features = spark.createDataFrame(feats, "e string, t timestamp_ntz, feature_key string, phase string, value double")
    outcomes = spark.createDataFrame(outs, "e string, t timestamp_ntz, horizon int, gross double")
    events = screen.tail_events(features, screen.thresholds(features, config.quantiles))
    columns = [*screen.TEST, "direction", *(f"{m}_{p}" for p in ("discovery", "validation") for m in ("n", "mean", "hit", "worst", "winner", "sd")), "z", "passes"]
    plain = screen.tail_screen(features, outcomes, config, ["t"], events=screen.other_entities(events, outcomes, "e", "t"))
    summed = screen.peer_screen(features, outcomes, config, "e", "t")
    a, b = (sorted(map(tuple, x.select(*columns).collect())) for x in (plain, summed))
    assert len(a) == len(b) > 4
    for x, y in zip(a, b, strict=True):
        assert all(u == v or (isinstance(u, float) and abs(u - v) <= 1e-9 * max(1, abs(u))) for u, v in zip(x, y, strict=True)), (x, y)
