"""Queries of streams: the batch twins of windowed aggregates, and stateful operators run as streams over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import time as T
from tidegauge.functions.scalars import change
from tidegauge.operators.bars import build_bars
from tidegauge.operators.scratch import scratch_path
from tidegauge.plans.inputs import TICKS, read, rounded, ticks
from tidegauge.plans.registry import query
from tidegauge.operators.writes import merge_additive, upsert
from tidegauge.streaming import aggregates as A
from tidegauge.streaming import feeds, rules
from tidegauge.streaming import stateful as P

SIDED = TICKS + ", sided as (select *, case when id % 3 = 0 then 'buy' when id % 3 = 1 then 'sell' end as side from ticks)"


def sided(spark, sf_dir):
    return ticks(spark, sf_dir).withColumn("side", F.when(F.col("id") % 3 == 0, "buy").when(F.col("id") % 3 == 1, "sell"))


def bucket(width: str) -> str:
    return f"time_bucket(interval '{width}', ts, timestamp '1970-01-01')"


@query(
    "T1_trade_windows",
    f"""with {SIDED} select venue, {bucket("1 hour")} as bucket, count(*) as trades, coalesce(sum(size) filter (side = 'buy'), 0) as buy_volume, coalesce(sum(size) filter (side = 'sell'), 0) as sell_volume,
  round(coalesce(sum(price * size) filter (side = 'buy'), 0), 6) as buy_quote, round(coalesce(sum(price * size) filter (side = 'sell'), 0), 6) as sell_quote, arg_max(price, ts) as last_price from sided group by all""",
)
def trade_windows(spark, sf_dir):
    return rounded(A.second_bars(sided(spark, sf_dir), ["venue"], "1 hour"), 6, "buy_quote", "sell_quote")


@query(
    "T3_latest_fields",
    f"""with {TICKS}, u as (select entity, ts, id, case when venue = 'view' then price end as bid, case when venue = 'click' then price end as ask from ticks)
select entity, {bucket("1 day")} as bucket, arg_max(bid, ts) filter (bid is not null) as bid, arg_max(ask, ts) filter (ask is not null) as ask from u group by all""",
)
def latest_fields(spark, sf_dir):
    t = ticks(spark, sf_dir)
    u = t.select("entity", "ts", "id", F.when(F.col("venue") == "view", F.col("price")).alias("bid"), F.when(F.col("venue") == "click", F.col("price")).alias("ask"))
    return A.latest_fields(u, ["entity"], ["bid", "ask"], "1 day")


@query(
    "T4_liquidation_notional",
    f"""with {SIDED} select venue, {bucket("6 hours")} as bucket, round(coalesce(sum(price * size) filter (side = 'buy'), 0), 6) as buy_notional, round(coalesce(sum(price * size) filter (side = 'sell'), 0), 6) as sell_notional from sided group by all""",
)
def liquidation_notional(spark, sf_dir):
    s = sided(spark, sf_dir)
    twice = s.unionByName(s.where("id % 4 = 0"))  # replayed rows
    return rounded(A.liquidations(twice, ["venue"], "6 hours"), 6, "buy_notional", "sell_notional")


@query("T6_observations", f"with {TICKS} select entity, {bucket('15 minutes')} as bucket, max(ts) as observed_at, arg_max(price, ts) as price, arg_max(size, ts) as size from ticks group by all")
def observations(spark, sf_dir):
    return A.observations(ticks(spark, sf_dir), ["entity"], "15 minutes")


@query("T7_pretrigger_rows", f"with {TICKS} select d.id as detection, d.ts as detected_at, o.ts, o.price, o.entity from ticks d join ticks o on o.entity = d.entity and o.ts between d.ts - interval 120 minutes and d.ts where d.venue = 'error' and d.price >= 20")
def pretrigger_rows(spark, sf_dir):
    t = ticks(spark, sf_dir)
    d = t.where("venue = 'error' and price >= 20").select("entity", F.col("id").alias("detection"), F.col("ts").alias("detected_at"))
    return A.pretrigger(d, t, ["entity"]).select("detection", "detected_at", "ts", "price", "entity")


@query("T8_live_targets", f"""with {TICKS}, d as (select entity, max(epoch(ts)) + 180 * 60 as expires, arg_max(price, ts) as score, max(epoch(ts)) as seen from ticks where price >= 40 and ts < timestamp '2024-01-20' group by 1), l as (select * from d where expires > epoch(timestamp '2024-01-19 12:00:00'))
select entity, round(expires, 3) as expires, row_number() over (order by score desc, seen desc, cast(entity as varchar)) as rank, row_number() over (order by score desc, seen desc, cast(entity as varchar)) <= 10 as admitted from l""")
def live_targets(spark, sf_dir):
    """Events as detections of three hours' life; the targets alive at noon of the 19th and their places."""

    def changes(events: DataFrame) -> DataFrame:
        found = events.where((F.col("value") >= 40) & (F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")))
        return P.targets(found.select(F.col("user_id").cast("string").alias("asset"), F.col("ts").cast("timestamp").alias("at"), F.col("ts").cast("timestamp").cast("double").alias("ts"), F.col("value").alias("score")), 180 * 60.0)

    noon = 1_705_665_600.0
    out = P.admitted(streamed(spark, read(spark, sf_dir, "events"), changes, files=True), noon, 10)
    return out.select(F.col("asset").cast("long").alias("entity"), F.round("expires", 3).alias("expires"), "rank", "admitted")


@query(
    "T8_target_log",
    f"""with {TICKS}, d as (select entity, max(epoch(ts)) + 180 * 60 as expires, arg_max(price, ts) as score, max(epoch(ts)) as seen from ticks where price >= 40 group by 1), l as (select *, row_number() over (order by score desc, seen desc, cast(entity as varchar)) as rank from d where expires > (select max(seen) from d))
select d.entity, round(d.expires, 3) as expires, rank, coalesce(rank <= 2, false) as admitted, case when rank is null then 'expired' when rank <= 2 then 'admitted' else 'cap reached' end as reason from d left join l using (entity)""",
)
def target_log(spark, sf_dir):
    """Every admission and refusal, with its reason, as batches of detections come; of each target the last decision."""
    path = scratch_path(spark, "targets")
    log = feeds.TargetLog(path, 2, P.admitted)
    detections = ticks(spark, sf_dir).where("price >= 40").select(F.col("entity").cast("string").alias("asset"), F.col("ts").cast("timestamp").cast("double").alias("seen"), (F.col("ts").cast("timestamp").cast("double") + 180 * 60.0).alias("expires"), F.col("price").alias("score"))
    stream = read_stream(spark, detections.select("asset", "expires", "score", "seen").repartition(1))
    stream.writeStream.foreachBatch(log).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    last = log.log(spark).groupBy("asset").agg(F.max_by(F.struct("expires", "rank", "admitted", "reason"), "batch").alias("l"))
    return last.select(F.col("asset").cast("long").alias("entity"), F.round("l.expires", 3).alias("expires"), "l.rank", "l.admitted", "l.reason")


@query("T9_late_rows", f"with {TICKS}, a as (select *, ts + to_minutes(cast(size as int)) as arrived from ticks) select id, ts < arrived - interval 30 minutes as late from a")
def late_rows(spark, sf_dir):
    a = ticks(spark, sf_dir).withColumn("arrived", F.timestamp_add("MINUTE", F.col("size").cast("int"), F.col("ts")))
    on_time, late = A.late_rows(a, F.col("arrived"), "30 MINUTES")
    return on_time.select("id", F.lit(False).alias("late")).unionByName(late.select("id", F.lit(True).alias("late")))


@query("T10_replayed_merge", f"with {TICKS} select entity, {bucket('1 day')} as bucket, count(*) as n, sum(size) as volume from ticks group by all")
def replayed_merge(spark, sf_dir):
    """A stream whose every batch is written twice, as after a failure: the second time nothing is counted."""
    path = scratch_path(spark, "merge")
    put = A.once_per_batch(f"{path}/rows", lambda d: d.groupBy(F.col("user_id").alias("entity"), T.floor_to("ts", 86_400).alias("bucket")).agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("double")).alias("volume")))

    def twice(df: DataFrame, batch_id: int) -> None:
        put(df, batch_id)
        put(df, batch_id)

    stream = read_stream(spark, read(spark, sf_dir, "events"), files=True)
    stream.writeStream.foreachBatch(twice).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    parts = spark.read.schema("entity long, bucket timestamp_ntz, n long, volume double").parquet(f"{path}/rows")
    return parts.groupBy("entity", "bucket").agg(F.sum("n").alias("n"), F.sum("volume").alias("volume"))


@query(
    "T9_late_merge",
    f"""with {TICKS} select entity, {bucket("1 day")} as bucket, count(*) as n, sum(size) as volume, arg_max(price, ts) as last_price, max(ts) as last_ts from ticks group by all""",
)
def late_merge(spark, sf_dir):
    """Ticks that arrive in a random order, in several batches, so that most are behind the watermark: the sums are those
    of the whole table."""
    path = scratch_path(spark, "late")
    key, sums, last = ["entity", "bucket"], ["n", "volume"], ["last_price", "last_ts"]
    schema = "entity long, bucket timestamp_ntz, n long, volume double, last_price double, last_ts timestamp_ntz"

    def daily(rows: DataFrame) -> DataFrame:
        placed = rows.select("*", T.floor_to("ts", 86_400).alias("bucket"))
        return placed.groupBy(*key).agg(F.count("*").alias("n"), F.sum("size").alias("volume"), F.max_by("price", "ts").alias("last_price"), F.max("ts").alias("last_ts"))

    def added(old: DataFrame, new: DataFrame) -> DataFrame:
        return merge_additive([old, new], key, sums, last, "last_ts")

    into = feeds.SliceMerge(f"{path}/days", schema, F.date_trunc("month", "bucket").cast("date"), added)
    write = feeds.LateRows(path, 600.0, daily, into)
    stream = read_stream(spark, ticks(spark, sf_dir).repartition(4, "id"), per_batch=1)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return into.rows(spark).drop("_batch", "_slice")


@query(
    "K1_streamed_upsert",
    f"with {TICKS} select entity, venue, max(id) as id, arg_max(price, id) as price from ticks group by all",
)
def streamed_upsert(spark, sf_dir):
    """Every batch's latest row of each key, merged into the slices that it touches."""
    path = scratch_path(spark, "upsert")
    key = ["entity", "venue"]
    into = feeds.SliceMerge(f"{path}/rows", "entity long, venue string, id long, price double", F.pmod("entity", F.lit(16)), lambda old, new: upsert(old, new, key, "id"))

    def latest(df: DataFrame, batch_id: int) -> None:
        into(df.groupBy(*key).agg(F.max("id").alias("id"), F.max_by("price", "id").alias("price")), batch_id)

    stream = read_stream(spark, ticks(spark, sf_dir).repartition(3, "id"), per_batch=1)
    stream.writeStream.foreachBatch(latest).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return into.rows(spark).drop("_batch", "_slice")


@query(
    "T11_feed_gap_stream",
    f"""with {TICKS}, m as (select epoch_ms(max(ts)) - 600000 as mark from ticks), f as (select entity, ts from ticks, m where epoch_ms(ts) < mark),
c as (select entity, lag(ts) over (partition by entity order by ts) as gap_start, ts as gap_end from f), l as (select entity, max(ts) as ts from f group by 1)
select entity, gap_start, gap_end from c where gap_end > gap_start + interval 12 hours
union all select entity, ts, null from l, m where epoch_ms(ts + interval 12 hours) + 1 < mark""",
)
def feed_gap_stream(spark, sf_dir):
    """Silences of over twelve hours as they happen: closed ones up to the watermark, and those that are still open."""
    out = streamed(spark, read(spark, sf_dir, "events"), lambda events: feeds.feed_gaps(events, "user_id", 43_200.0), files=True)
    return out.select(F.col("entity").cast("long").alias("entity"), *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("gap_start", "gap_end")))


@query("T12_segments", f"with {TICKS} select venue, strftime({bucket('6 hours')}, '%Y%m%dT%H%M') as segment, count(*) as rows from ticks group by all")
def segments(spark, sf_dir):
    """Raw rows through the segment sink, and the segments read back."""
    path = scratch_path(spark, "segments")
    stream = read_stream(spark, ticks(spark, sf_dir).select("venue", "ts", "id"))
    A.segments(stream, f"{path}/raw", f"{path}/checkpoint", ["venue"], "6 hours").trigger(availableNow=True).start().awaitTermination()
    raw = spark.read.schema("id long, ts timestamp_ntz, venue string, segment string").json(f"{path}/raw")
    return raw.groupBy("venue", "segment").agg(F.count("*").alias("rows"))


#: Input files of a micro-batch: a batch's rows of one key are sorted in memory.
FILES = 8


def read_stream(spark: SparkSession, table: DataFrame, files: bool = False, per_batch: int | None = FILES) -> DataFrame:
    """A table as a stream: from its own ``files``, of which it has to be all rows and columns, or from a copy below the
    scratch folder. A copy's files are in no order of time: without ``per_batch`` they all come in one batch."""
    source = spark.readStream.schema(table.schema)
    if per_batch is not None:
        source = source.option("maxFilesPerTrigger", per_batch)
    if files:
        paths = table.inputFiles()
        glob = paths[0].rsplit("/", 1)[1] if len(paths) == 1 else "*.parquet"
        return source.option("pathGlobFilter", glob).parquet(paths[0].rsplit("/", 1)[0])
    path = f"{scratch_path(spark, 'stream-input')}/rows"
    table.write.parquet(path)
    return source.parquet(path)


STORE = "spark.sql.streaming.stateStore.providerClass"


NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def started(spark: SparkSession, stream, out: str, settle: bool, **more: str) -> DataFrame:
    """What ``stream()`` gives of all that its source has by now, written and read back. The state store that stateful
    processors need, and ``more`` settings, are set for the query's start alone."""
    wanted = {STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", NO_DATA: str(settle).lower(), **more}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        found = stream()
        found.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(found.schema).parquet(f"{out}/rows")


def streamed(spark: SparkSession, table: DataFrame, transform, files: bool = False, settle: bool = True, per_batch: int | None = FILES, **more: str) -> DataFrame:
    """A table read as a stream, transformed, written until all of it is read, and read back. ``settle``: batches without rows
    follow while timers or the watermark call for them; with the machine's clock they always do, so a stream with states that
    expire by it needs False."""
    return started(spark, lambda: transform(read_stream(spark, table, files, per_batch)), scratch_path(spark, "stream"), settle, **more)


#: Rows of a micro-batch of a replay, and the files that they are dealt to.
REPLAYED, SPREAD = 8_000_000, 16
#: Packed rows are large: they are read and go to Python in batches of some 16 MB.
LARGE_ROWS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20), "spark.sql.parquet.columnarReaderBatchSize": "128"}


def replayed(spark: SparkSession, table: DataFrame, observations, transform, rows: int) -> DataFrame:
    """``transform`` of the ``observations`` of a table as a stream in order of their time, however the table's files lie: a
    micro-batch has a range of time of some ``rows``, so no task holds more, and rows of equal time are in one. A table of no
    more rows is a single one, from its own files, of which it has to be all rows and columns."""
    parts = -(-table.count() // rows)
    if parts <= 1:
        return streamed(spark, table, lambda stream: transform(observations(stream)), files=True, settle=False, per_batch=None, **LARGE_ROWS)
    o, path, out = observations(table), scratch_path(spark, "stream-input"), scratch_path(spark, "stream")
    cuts = sorted(set(o.agg(F.percentile_approx("t", [i / parts for i in range(1, parts)], 10_000)).first()[0] or []))
    part = sum((F.when(F.col("t") >= cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    packed = P.pack(o.withColumn("part", part), [*P.VENUE, "part"])
    # files in proportion to the rows, however many tasks have read them
    file = F.col("part") * SPREAD + F.pmod(F.xxhash64("records"), F.lit(SPREAD)).cast("int")
    packed.repartitionById((len(cuts) + 1) * SPREAD, file).write.partitionBy("part").parquet(f"{path}/dealt")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(f"{path}/come"))
    for i in range(len(cuts) + 1):
        if fs.exists(hadoop(f"{path}/dealt/part={i}")) and not fs.rename(hadoop(f"{path}/dealt/part={i}"), hadoop(f"{path}/come/{i}")):
            raise OSError(f"{path}/dealt/part={i} could not be moved")
        # the same query goes on with the files that have come since
        stream = lambda: transform(spark.readStream.schema(packed.drop("part").schema).option("recursiveFileLookup", True).parquet(f"{path}/come"))
        found = started(spark, stream, out, False, **LARGE_ROWS)
    return found


@query("T2_book_states")
def book_states(spark, sf_dir):
    """Events as book updates of each user: views set a bid, clicks an ask, errors take a level away."""

    def updates(events: DataFrame) -> DataFrame:
        level = F.concat(F.lit("[["), F.round("value", 0).cast("string"), F.lit(","), F.when(F.col("event_type") == "error", "0").otherwise("1"), F.lit("]]"))
        is_bid = F.col("event_type") == "view"
        return P.book_states(
            events.where("event_type in ('view', 'click', 'error')").select(
                F.col("user_id").cast("string").alias("book"), F.col("ts").cast("timestamp").alias("ts"), F.lit("update").alias("kind"),
                F.when(is_bid, level).otherwise("[]").alias("bids"), F.when(is_bid, "[]").otherwise(level).alias("asks"),
            )
        )

    return streamed(spark, read(spark, sf_dir, "events"), updates, files=True)


#: The detector's windows in hours and limits in tens of percent, as the events are sparse and their values vary much.
SPARSE = P.DetectorConfig(fast=6 * 3600, base=24 * 3600, slow=72 * 3600, fast_limit=75.0, base_limit=150.0, slow_limit=250.0, confirmed=75.0, derivative_limit=50.0, spot_limit=20.0, volume_move=50.0, evidence=6 * 3600, cooldown=12 * 3600)


def observed(events: DataFrame) -> DataFrame:
    """Events as observations of ten assets on five venues, of which each user is a symbol."""
    return events.select(
        (F.col("user_id") % 10).cast("string").alias("asset"), F.col("ts").cast("timestamp").cast("double").alias("t"), F.col("event_type").alias("provider"), F.when(F.col("event_type").isin("view", "click"), "spot").otherwise("perp").alias("market"),
        (F.col("user_id") % 3).cast("string").alias("symbol"), (F.col("value") - 3).alias("price"), F.when(F.col("event_id") % 5 != 0, F.col("event_id") * 1.0).alias("volume"), F.col("event_id").alias("id"),
    )


@query("T5_multi_venue_detections")
def multi_venue_detections(spark, sf_dir):
    """Events as a stream of observations; tests compare it with the cooldown over E12."""
    return replayed(spark, read(spark, sf_dir, "events"), observed, lambda observations: P.multi_venue(observations, SPARSE), REPLAYED)


def before_sql(seconds: int) -> str:
    """The place of a venue's last row at least so long ago: rows are numbered by time in each venue."""
    return f"(select max(b.n) from o b where b.asset = o.asset and b.provider = o.provider and b.symbol = o.symbol and b.ts <= o.ts - interval {seconds} seconds and b.ts >= o.ts - interval {SPARSE.retention} seconds)"


def move_sql(name: str, seconds: int) -> str:
    return f"case when {name}.ts >= s.ts - interval {int(seconds * 1.25)} seconds then 100 * (s.price / {name}.price - 1) end"


@query(
    "E12_batch_detections",
    f"""with e as (select cast(user_id % 10 as varchar) as asset, event_type as provider, case when event_type in ('view', 'click') then 'spot' else 'perp' end as market, cast(user_id % 3 as varchar) as symbol, ts, event_id as id, value - 3 as price, case when event_id % 5 <> 0 then event_id * 1.0 end as volume from events where value > 3),
o as (select *, row_number() over (partition by asset, provider, symbol order by ts, id) as n from e), p as (select *, {before_sql(SPARSE.fast)} as nf, {before_sql(SPARSE.base)} as nb, {before_sql(SPARSE.slow)} as ns, {before_sql(2 * SPARSE.base)} as nd from o),
g as (select s.*, {move_sql("f", SPARSE.fast)} as fast, {move_sql("b", SPARSE.base)} as base, {move_sql("w", SPARSE.slow)} as slow, case when s.volume is null or b.volume is null or d.volume is null then null when s.volume - b.volume <= 0 then 0 when b.volume - d.volume <= 0 then 10 else least((s.volume - b.volume) / (b.volume - d.volume), 10) end as growth
  from p s left join o f on f.asset = s.asset and f.provider = s.provider and f.symbol = s.symbol and f.n = s.nf left join o b on b.asset = s.asset and b.provider = s.provider and b.symbol = s.symbol and b.n = s.nb left join o w on w.asset = s.asset and w.provider = s.provider and w.symbol = s.symbol and w.n = s.ns
  left join o d on d.asset = s.asset and d.provider = s.provider and d.symbol = s.symbol and d.n = s.nd),
k as (select *, case when coalesce(base, 0) <> 0 then base else nullif(fast, 0) end as lead, greatest(fast, base, slow) as best from g where fast is not null or base is not null or slow is not null),
l as (select a.asset, a.id as aid, a.ts as a_ts, v.* exclude (asset) from k a join k v on v.asset = a.asset and v.ts >= a.ts - interval {SPARSE.evidence} seconds and (v.ts < a.ts or (v.ts = a.ts and v.id <= a.id)) qualify row_number() over (partition by a.id, v.provider, v.symbol order by v.ts desc, v.id desc) = 1),
j as (select asset, aid, a_ts, bool_or(coalesce(fast >= 75, false)) as c1, bool_or(coalesce(base >= 150, false)) as c2, bool_or(coalesce(slow >= 250, false)) as c3, count(distinct provider) filter (base >= 75 or fast >= 45 or slow >= 131.25) >= 2 as c4,
  coalesce(max(lead) filter (market = 'perp') >= 50, false) and coalesce(max(lead) filter (market = 'spot') >= 20, false) as c5, bool_or(coalesce(lead >= 50 and growth >= 3, false)) as c6, count(distinct provider) as providers,
  max(greatest(coalesce(fast, 0) / 75, coalesce(base, 0) / 150, coalesce(slow, 0) / 250)) as ratio, coalesce(median(best) filter (best > 0), 0) as usual, max(coalesce(growth, 0)) as growth from l group by all)
select asset, aid as id, concat_ws(',', case when c1 then 'fast' end, case when c2 then 'base' end, case when c3 then 'slow' end, case when c4 then 'cross_venue' end, case when c5 then 'derivative_led' end, case when c6 then 'volume' end) as triggers, providers,
  round(least(30 * least(ratio, 2) + 8 * least(providers, 4) + 8 * least(usual / 75, 2) + 7 * least(growth / 3, 2) + case when c4 then 10 else 0 end + case when c5 then 8 else 0 end, 100), 4) as score from j where c1 or c2 or c3 or c4 or c5 or c6""",
)
def batch_detections(spark, sf_dir):
    out = P.batch_detections(observed(read(spark, sf_dir, "events")), SPARSE)
    return out.select("asset", "id", "triggers", F.col("providers").cast("long").alias("providers"), F.round("score", 4).alias("score"))


@query(
    "T13_live_rule",
    f"""with recursive {TICKS}, b as (select entity, {bucket("6 hours")} as bucket, arg_max(price, ts) / nullif(arg_min(price, ts), 0) - 1 as ret, count(*) as n from ticks group by all),
l as (select *, lag(ret) over w as before, lag(bucket) over w as prev from (select * from b where ret is not null) window w as (partition by entity order by bucket)),
q as (select entity, bucket, bucket + interval 6 hours as ends, n > 3 as late from l where ret <= -0.5 and not coalesce(before <= -0.5 and prev = bucket - interval 6 hours, false)),
f as (select entity, min(ends) as ends from q where not late group by 1 union all select f.entity, (select min(q.ends) from q where q.entity = f.entity and not q.late and q.ends >= f.ends + interval 48 hours) as ends from f where f.ends is not null)
select cast(q.entity as varchar) as entity, q.bucket, case when exists (select 1 from f where f.entity = q.entity and f.ends < q.ends and q.ends < f.ends + interval 48 hours) then 'blocked' when late then 'missed' else 'signal' end as verdict from q""",
)
def live_rule(spark, sf_dir):
    """Six-hour bars as a stream of closed bars that arrive half a minute later for each of their rows."""
    b = build_bars(ticks(spark, sf_dir), ["entity"], 6 * 3600)
    seconds = F.col("bucket").cast("timestamp").cast("double")
    closed = b.select(F.col("entity").cast("string").alias("entity"), seconds.alias("bar_start"), (seconds + 6 * 3600).alias("bar_end"), (seconds + 6 * 3600 + 30 * F.col("n")).alias("arrived"), change("close", "open").alias("ret"))
    out = streamed(spark, closed, lambda bars: P.live_rules(bars, -0.5, 48 * 3600.0, 90.0), per_batch=None)
    return out.select("entity", F.timestamp_seconds("bar_start").cast("timestamp_ntz").alias("bucket"), "verdict")


#: Bars of the live rules, with their arrival: half a minute after their end for each of their rows. On time are those of at most three.
LIVE = f"""with recursive {TICKS}, b as (select venue, {bucket("1 hour")} as bucket, arg_max(price, ts) / nullif(arg_min(price, ts), 0) - 1 as ret, count(*) as n from ticks group by all),
m as (select max(epoch_ms(bucket) + 3600000 + 30000 * n) - 600000 as mark from b), o as (select * from b where n <= 3)"""


def closed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build_bars(ticks(spark, sf_dir), ["venue"], 3600)
    start = F.col("bucket").cast("timestamp")
    return b.select("venue", start.alias("bar_start"), F.timestamp_seconds(start.cast("long") + 3600 + 30 * F.col("n")).alias("arrived"), change("close", "open").alias("value"))


@query(
    "T13_live_leaders",
    LIVE
    + """, d as (select distinct date_trunc('day', bucket) as day from o where venue in ('view', 'click', 'purchase')), e as (select day, day + to_hours(h) as bucket, h from d, range(24) r(h)),
v as (select e.*, max(ret) filter (venue = 'view') as a, max(ret) filter (venue = 'click') as b, max(ret) filter (venue = 'purchase') as c, count(venue) as k, coalesce(bool_or(venue = 'purchase'), false) as has_c, coalesce(bool_or(venue <> 'purchase'), false) as has_l
  from e left join (select * from o where venue in ('view', 'click', 'purchase')) x using (bucket) group by all),
q as (select v.*, bool_and(k = 3 or epoch_ms(bucket) + 3690000 < mark) over (partition by day order by bucket) as decided from v, m),
t as (select *, h between 6 and 20 as inside, h between 6 and 20 and coalesce((a >= 0.5 or b >= 0.8) and c > 0, false) as hot from q where decided),
s as (select *, hot and coalesce(lag(k) over w, 0) > 0 and not lag(hot) over w as edge from t window w as (partition by day order by bucket)),
f as (select min(bucket) as ts from s where edge union all select (select min(bucket) from s where edge and bucket >= f.ts + interval 3 hours) from f where f.ts is not null)
select bucket, case when not (has_c and has_l) then 'missed' when exists (select 1 from f where f.ts = bucket) then 'signal' else 'blocked' end as verdict from s where inside and (edge or not (has_c and has_l))""",
)
def live_leaders(spark, sf_dir):
    """The leaders' rule over bars as they arrive, by session; a bar without the confirmer or any leader in time is missed."""
    rule = rules.LeaderRule({"view": 0.5, "click": 0.8}, "purchase", 3 * 3600)
    live = lambda bars: rules.live_sessions(bars, rule, F.lit("market"), F.col("venue"), 3600, 90, (6 * 3600, 20 * 3600), "10 minutes")
    out = streamed(spark, closed_bars(spark, sf_dir), live, per_batch=None)
    return out.select(F.col("bar_start").cast("timestamp_ntz").alias("bucket"), "verdict")


@query(
    "T13_live_tails",
    LIVE
    + """, d as (select distinct venue, date_trunc('day', bucket) as day from o), e as (select venue, day, day + to_hours(h) as bucket from d, range(24) r(h)),
q as (select e.*, o.ret, o.venue is not null as there, bool_and(o.venue is not null or epoch_ms(e.bucket) + 3690000 < mark) over (partition by e.venue, day order by e.bucket) as decided from m, e left join o on o.venue = e.venue and o.bucket = e.bucket),
t as (select *, coalesce(ret <= -0.5, false) as below from q where decided), l as (select *, below and not coalesce(lag(below) over (partition by venue, day order by bucket), false) as entry from t where there),
s as (select venue, min(bucket) as bucket from l where entry group by venue, day)
select venue, bucket, 'signal' as verdict from s union all select venue, bucket, 'missed' from t where not there""",
)
def live_tails(spark, sf_dir):
    """Each venue's first tail of the day over bars as they arrive; the day's other bars that don't come in time are missed."""
    live = lambda bars: rules.live_sessions(bars, rules.TailRule(-0.5), F.col("venue"), F.lit("bar"), 3600, 90, watermark="10 minutes")
    out = streamed(spark, closed_bars(spark, sf_dir), live, per_batch=None)
    return out.select(F.col("key").alias("venue"), F.col("bar_start").cast("timestamp_ntz").alias("bucket"), "verdict")
