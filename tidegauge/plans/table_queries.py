"""Queries of sources, write semantics and data quality, over tables and raw forms that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions import time as T
from tidegauge.operators import quality as Q
from tidegauge.operators import screen as D
from tidegauge.operators import writes as K
from tidegauge.operators.scratch import materialize, scratch_path
from tidegauge.plans.inputs import TICKS, read, ticks
from tidegauge.plans.join_queries import trades
from tidegauge.plans.registry import query
from tidegauge.sources import archives as A
from tidegauge.sources import readers as S
from tidegauge.sources import vendors as V



def micros(c: str = "ts"):
    return F.timestamp_diff("MICROSECOND", F.expr(T.ORIGIN), F.col(c))


@query("S1_bar_scan", f"with {TICKS} select id, ts, price from ticks where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-12' and entity = 7")
def bar_scan(spark, sf_dir):
    return S.bars(ticks(spark, sf_dir), "2024-01-10 00:00:00", "2024-01-12 00:00:00", instrument=7).select("id", "ts", "price")


@query(
    "S2_kline_lines",
    f"with {TICKS} select id, case when id % 2 = 0 then make_timestamp((epoch_us(ts) // 1000) * 1000) else ts end as ts, price as open, price + 1 as high, price as low, price as close, size as volume, cast(size as bigint) as trades from ticks where id % 10 <> 9",
)
def kline_lines(spark, sf_dir):
    t = ticks(spark, sf_dir)
    epoch = F.when(F.col("id") % 2 == 0, F.floor(micros() / 1000)).otherwise(micros())
    text = lambda c: c.cast("string")
    p = F.col("price")
    fields = [epoch, p, p + 1, p, p, F.col("size"), epoch, F.lit(0.0), F.col("size").cast("long"), F.lit(0.0), F.lit(0.0), F.lit(0)]
    good = F.concat_ws(",", *map(text, fields))
    # every tenth line is broken: a header or too few fields
    line = F.when(F.col("id") % 20 == 9, "open_time,open,high,low,close,volume,close_time,quote_volume,trades,taker_base,taker_quote,ignore").when(F.col("id") % 20 == 19, "1,2,3").otherwise(good)
    return S.klines(t.select("id", line.alias("line")), keep=["id"]).select("id", "ts", "open", "high", "low", "close", "volume", "trades")


@query(
    "S2_kline_archives",
    f"with {TICKS} select venue, ts, price as open, price + 1 as high, price as close, size as volume, cast(size as bigint) as trades from ticks",
)
def kline_archives(spark, sf_dir):
    """Klines in a zip file for each venue with a member for each month, written by tasks and read by the data source."""
    path = f"{scratch_path(spark, 'archives')}/zips"
    p, text = F.col("price"), lambda c: c.cast("string")
    values = [micros(), p, p + 1, p, p, F.col("size"), micros(), F.lit(0.0), F.col("size").cast("long"), F.lit(0.0), F.lit(0.0), F.lit(0)]
    A.write_zips(ticks(spark, sf_dir).select("venue", F.date_format("ts", "yyyy-MM").alias("month"), "id", F.concat_ws(",", *map(text, values)).alias("line")), path, "venue", "month", ["id"])
    found = S.klines(A.zip_lines(spark, path), keep=["path"])
    return found.select(F.regexp_extract("path", "([^/]*)[.]zip$", 1).alias("venue"), "ts", "open", "high", "close", "volume", "trades")


@query("S3_mark_archives", "select o_orderpriority as priority, o_orderkey, o_orderdate as ts, o_totalprice as mark from orders")
def mark_archives(spark, sf_dir):
    """Archives of which some begin with a header, in an order of its own, and some have none."""
    path = f"{scratch_path(spark, 'marks')}/zips"
    epoch = F.unix_micros(F.col("o_orderdate").cast("timestamp")).cast("string")
    rows = read(spark, sf_dir, "orders").select(F.substring("o_orderpriority", 1, 1).alias("archive"), F.col("o_orderpriority").alias("member"), "o_orderkey", F.col("o_orderkey").cast("string").alias("k"), epoch.alias("t"), F.col("o_totalprice").cast("string").alias("m"))
    headed = F.col("archive") > "2"
    lines = rows.select("archive", "member", "o_orderkey", F.when(headed, F.concat_ws(",", "m", "k", "t")).otherwise(F.concat_ws(",", "k", "t", "m")).alias("line"))
    heads = rows.where(headed).select("archive", "member").distinct().select("archive", "member", F.lit(-1).cast("long").alias("o_orderkey"), F.lit("Mark_Price,O_OrderKey,calc_time").alias("line"))
    A.write_zips(lines.unionByName(heads), path, "archive", "member", ["o_orderkey"])
    found = A.fields(A.zip_lines(spark, path), ["o_orderkey", "ts", "mark"], {"ts": ["calc_time"], "mark": ["mark_price"]})
    return found.select(F.col("member").alias("priority"), F.col("o_orderkey").cast("long").alias("o_orderkey"), T.from_epoch("ts").alias("ts"), F.col("mark").cast("double").alias("mark"))


@query("S3_funding_aliases", "select o_orderkey, o_orderdate as ts, o_totalprice as rate from orders")
def funding_aliases(spark, sf_dir):
    raw = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("calc_time"), F.col("o_totalprice").alias("last_funding_rate"), "o_orderstatus")
    return S.resolve_columns(raw, {"o_orderkey": [], **S.FUNDING})


@query("S4_book_ticker", f"with {TICKS} select id as update_id, price as bid, size as bid_size, price + 1 as ask, size as ask_size, ts from ticks")
def book_ticker(spark, sf_dir):
    raw = ticks(spark, sf_dir).select("id", "price", "size", F.col("price") + 1, F.col("size").alias("s2"), "ts")
    return S.resolve_columns(S.named_by_position(raw, ["update_id", "best_bid_price", "best_bid_qty", "best_ask_price", "best_ask_qty", "transaction_time"]), S.BOOK_TICKER)


@query("S5_quote_lines", f"with {TICKS} select venue as symbol, ts, price as ask_price, size as ask_amount from ticks")
def quote_lines(spark, sf_dir):
    line = F.concat_ws(",", "venue", micros().cast("string"), F.col("price").cast("string"), F.col("size").cast("string"))
    parsed = ticks(spark, sf_dir).select(F.from_csv(line, "symbol string, timestamp long, ask_price double, ask_amount double").alias("r")).select("r.*")
    checked = S.required(parsed, ["symbol", "timestamp", "ask_price", "ask_amount"])
    return checked.select("symbol", T.from_epoch("timestamp").alias("ts"), "ask_price", "ask_amount")


@query("S5_quote_files", f"with {TICKS} select venue as symbol, ts, price as ask_price, size as ask_amount, price - 0.5 as bid_price, size + 1 as bid_amount from ticks")
def quote_files(spark, sf_dir):
    """Quotes written as gzipped CSV files and read by the reader."""
    path = scratch_path(spark, "quotes")
    t = ticks(spark, sf_dir)
    files = t.select(
        F.lit("x").alias("exchange"), F.col("venue").alias("symbol"), micros().alias("timestamp"), micros().alias("local_timestamp"), F.col("size").alias("ask_amount"), F.col("price").alias("ask_price"), (F.col("price") - 0.5).alias("bid_price"), (F.col("size") + 1).alias("bid_amount")
    )
    files.write.option("header", True).option("compression", "gzip").csv(f"{path}/files")
    return S.quote_files(spark, f"{path}/files").select("symbol", "ts", "ask_price", "ask_amount", "bid_price", "bid_amount")


@query(
    "S6_depth_levels",
    """with w as (select l_orderkey, max(case when l_linenumber = 1 then l_discount end) as b1, max(case when l_linenumber = 2 then l_discount end) as b2, max(case when l_linenumber = 3 then l_tax + 0.05 end) as a1 from lineitem group by 1)
select l_orderkey, (coalesce(b1, 0) > 0)::int + (coalesce(b2, 0) > 0)::int as n_bids, case when b1 > 0 then b1 else b2 end as best_bid, a1 as best_ask from w where (coalesce(b1, 0) > 0 or coalesce(b2, 0) > 0) and a1 > 0 and case when b1 > 0 then b1 else b2 end < a1""",
)
def depth_levels(spark, sf_dir):
    at = lambda n, c: F.max(F.when(F.col("l_linenumber") == n, c))
    wide = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        at(1, F.col("l_discount")).alias("bids[0].price"), at(2, F.col("l_discount")).alias("bids[1].price"), at(3, F.col("l_tax") + 0.05).alias("asks[0].price"), F.lit(1.0).alias("amount")
    )
    out = S.level_arrays(wide, {"bids": [("bids[0].price", "amount"), ("bids[1].price", "amount")], "asks": [("asks[0].price", "amount")]}, ["l_orderkey"])
    best = lambda s: F.get(F.col(s), F.lit(0))["price"]
    return out.select("l_orderkey", F.size("bids").alias("n_bids"), best("bids").alias("best_bid"), best("asks").alias("best_ask"))


@query(
    "S7_short_volume",
    "select cast(cast(l_shipdate as date) as varchar) as date, p_brand as symbol, l_quantity as short, l_quantity * 2 as total, l_orderkey from lineitem join part on p_partkey = l_partkey where p_brand in ('Brand#1', 'Brand#2')",
)
def short_volume(spark, sf_dir):
    """Line items as lines; the order's key rides in the market field."""
    items = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    line = F.concat_ws("|", F.to_date("l_shipdate").cast("string"), "p_brand", F.col("l_quantity").cast("string"), F.lit("0"), (F.col("l_quantity") * 2).cast("string"), F.col("l_orderkey").cast("string"))
    known = read(spark, sf_dir, "part").where("p_brand in ('Brand#1', 'Brand#2')").select(F.col("p_brand").alias("symbol"))
    return S.short_volume(items.select(line.alias("line")), known).select("date", "symbol", "short", "total", F.col("market").cast("long").alias("l_orderkey"))


@query("S8_payload_rows", "select l_orderkey, l_linenumber, l_extendedprice as price, l_quantity as size from lineitem")
def payload_rows(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem")
    packed = items.groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col("l_extendedprice").alias("p"), F.col("l_quantity").alias("s"))).alias("trades"))).alias("payload"))
    return S.object_payloads(packed, "payload", "trades", {"l_linenumber": ("n", "int"), "price": ("p", "double"), "size": ("s", "double")}, ["l_orderkey"])


VENDOR_COLUMNS = ("open", "high", "low", "close", "volume", "quote_volume", "trades", "price", "size", "side", "trade_id", "bid", "ask_size", "name", "value")


@query(
    "S8_vendor_rows",
    f"""with {TICKS}, f as (select id, id % 7 as k, make_timestamp((epoch_us(ts) // 1000000) * 1000000) as ts, price, size, id % 2 = 0 as maker from ticks)
select ['alpaca', 'alpaca', 'alpaca', 'binance_klines', 'binance_trades', 'coinbase_candles', 'twelvedata'][k + 1] as feed, ['bar', 'trade', 'quote', 'bar', 'trade', 'bar', 'indicator'][k + 1] as kind, ts,
  case when k in (0, 3, 5) then price end as open, case when k in (0, 3, 5) then price + 1 end as high, case when k in (0, 3, 5) then price - 1 end as low, case when k in (0, 3, 5) then price end as close, case when k in (0, 3, 5) then size end as volume, case when k = 3 then price * size end as quote_volume,
  case when k in (0, 3) then cast(id as bigint) end as trades, case when k in (1, 4) then price end as price, case when k in (1, 4) then size end as size, case when k = 4 then case when maker then 'sell' else 'buy' end end as side, case when k in (1, 4) then cast(id as varchar) end as trade_id,
  case when k = 2 then price end as bid, case when k = 2 then size end as ask_size, case when k = 6 then 'rsi' end as name, case when k = 6 then price end as value from f""",
)
def vendor_rows(spark, sf_dir):
    """Ticks as payloads of five vendors, a user's ticks of a kind in one payload, read into one table."""
    t = ticks(spark, sf_dir).withColumns({"k": F.col("id") % 7, "sec": F.floor(micros() / 1_000_000)})
    p, size, sec, key = F.col("price"), F.col("size"), F.col("sec"), F.col("id")
    text = lambda c: c.cast("string")
    iso = F.date_format(F.timestamp_seconds(sec).cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    told = lambda **kv: F.to_json(F.struct(*(v.alias(k) for k, v in kv.items())))
    array = lambda *cs: F.concat(F.lit("["), F.concat_ws(",", *map(text, cs)), F.lit("]"))
    items = [
        told(t=iso, o=p, h=p + 1, l=p - 1, c=p, v=size, n=key), told(t=iso, p=p, s=size, i=key), told(t=iso, bp=p, bs=F.lit(1), ap=p, **{"as": size}),
        array(sec * 1000, p, p + 1, p - 1, p, size, sec, p * size, key, F.lit(0), F.lit(0)), told(a=key, p=text(p), q=text(size), T=sec * 1000, m=key % 2 == 0), array(sec, p - 1, p + 1, p, p, size), told(datetime=iso, rsi=text(p)),
    ]
    item = F.lit(None).cast("string")
    for k, x in enumerate(items):
        item = F.when(F.col("k") == k, x).otherwise(item)
    names = {0: "bars", 1: "trades", 2: "quotes", 6: "values"}
    packed = t.groupBy("entity", "k").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(item)), F.lit("]")).alias("list"))
    body = F.col("list")
    for k, name in names.items():
        body = F.when(F.col("k") == k, F.concat(F.lit(f'{{"{name}":'), F.col("list"), F.lit("}"))).otherwise(body)
    feed = F.element_at(F.array(*map(F.lit, ("alpaca", "alpaca", "alpaca", "binance_klines", "binance_trades", "coinbase_candles", "twelvedata"))), (F.col("k") + 1).cast("int"))
    return V.vendor_rows(packed.select(feed.alias("feed"), body.alias("body"))).select("feed", "kind", "ts", *VENDOR_COLUMNS)


#: What each of eighteen ticks is told by: venue, kind, and whether the message has a time, a price and size, a side, levels.
FORMS = (
    ("binance_spot", "trade"), ("binance_spot", "book"), ("binance_futures", "book"), ("binance_futures", "mark"), ("binance_futures", "liquidation"), ("binance_spot", "ticker"),
    ("coinbase", "trade"), ("coinbase", "book"), ("coinbase", "book"), ("coinbase", "ticker"), ("kraken", "trade"), ("kraken", "book"), ("bybit", "trade"), ("bybit", "book"), ("bybit", "mark"), ("bybit", "liquidation"), ("kraken", "ticker"), ("bybit", "unknown"),
)


@query(
    "S9_venue_messages",
    f"""with {TICKS}, f as (select id, id % 18 as k, entity, make_timestamp((epoch_us(ts) // 1000) * 1000) as ts, price, size, id % 2 = 0 as sells from ticks)
select id, [{", ".join(f"'{v}'" for v, _ in FORMS)}][k + 1] as venue, [{", ".join(f"'{x}'" for _, x in FORMS)}][k + 1] as kind, case when k <> 17 then 'S' || entity end as symbol, case when k not in (7, 17) then ts end as ts,
  case when k in (0, 4, 5, 6, 9, 10, 12, 14, 15, 16) then price end as price, case when k in (0, 4, 6, 10, 12, 15) then size end as size, case when k in (0, 4, 6, 10, 12, 15) then case when sells then 'sell' else 'buy' end end as side,
  case when k in (1, 2, 7, 8, 11, 13) then case when k = 8 and sells then 0 else 1 end end as n_bids, case when k in (1, 2, 7, 8, 11, 13) then case when k = 8 and not sells then 0 when k = 8 then 1 else 2 end end as n_asks,
  case when k in (1, 2, 7, 11, 13) then price + 1 end as best_ask, case when k in (1, 7, 11) then true when k in (2, 8, 13) then false end as snapshot, case when k in (3, 14) then price end as mark_price, case when k in (3, 14) then size / 1000 end as funding_rate,
  case when k = 14 then size end as open_interest, case when k in (5, 14) then size when k in (9, 16) then size * price end as volume from f""",
)
def venue_messages(spark, sf_dir):
    """Ticks told by the messages of five venues, each kind of each of them, and heartbeats."""
    t = ticks(spark, sf_dir)
    k, ms, sells = F.col("id") % 18, F.floor(micros() / 1000), F.col("id") % 2 == 0
    text = lambda c: c.cast("string")
    sym, p, q, p1, p2 = F.concat(F.lit("S"), text(F.col("entity"))), text(F.col("price")), text(F.col("size")), text(F.col("price") + 1), text(F.col("price") + 2)
    iso = F.date_format(F.timestamp_add("MICROSECOND", ms * 1000, F.expr(T.ORIGIN)), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    side = lambda a, b: F.when(sells, a).otherwise(b)
    rate = text(F.col("size") / 1000)
    say = F.format_string
    bodies = [
        say('{"stream":"x@aggTrade","data":{"e":"aggTrade","E":%d,"s":"%s","p":"%s","q":"%s","T":%d,"m":%s}}', ms, sym, p, q, ms, side("true", "false")),
        say('{"stream":"%s@depth20","data":{"lastUpdateId":1,"E":%d,"bids":[["%s","%s"]],"asks":[["%s","1"],["%s","2"]]}}', F.lower(sym), ms, p, q, p1, p2),
        say('{"stream":"x","data":{"e":"depthUpdate","E":%d,"s":"%s","b":[["%s","%s"]],"a":[["%s","1"],["%s","0"]]}}', ms, sym, p, q, p1, p2),
        say('{"stream":"x","data":{"e":"markPriceUpdate","E":%d,"s":"%s","p":"%s","i":"%s","r":"%s","T":%d}}', ms, sym, p, p1, rate, ms),
        say('{"stream":"x","data":{"e":"forceOrder","E":%d,"o":{"s":"%s","S":"%s","p":"1","ap":"%s","q":"%s","T":%d}}}', ms, sym, side("SELL", "BUY"), p, q, ms),
        say('{"e":"24hrMiniTicker","E":%d,"s":"%s","c":"%s","q":"%s"}', ms, sym, p, q),
        say('{"type":"match","product_id":"%s","time":"%s","price":"%s","size":"%s","side":"%s"}', sym, iso, p, q, side("buy", "sell")),
        say('{"type":"snapshot","product_id":"%s","bids":[["%s","%s"]],"asks":[["%s","1"],["%s","2"]]}', sym, p, q, p1, p2),
        say('{"type":"l2update","product_id":"%s","time":"%s","changes":[["%s","%s","%s"]]}', sym, iso, side("sell", "buy"), p, q),
        say('{"type":"ticker","product_id":"%s","time":"%s","price":"%s","volume_24h":"%s"}', sym, iso, p, q),
        say('{"channel":"trade","type":"update","data":[{"symbol":"%s","side":"%s","price":%s,"qty":%s,"timestamp":"%s"}]}', sym, side("sell", "buy"), p, q, iso),
        say('{"channel":"book","type":"snapshot","data":[{"symbol":"%s","bids":[{"price":%s,"qty":%s}],"asks":[{"price":%s,"qty":1},{"price":%s,"qty":2}],"timestamp":"%s"}]}', sym, p, q, p1, p2, iso),
        say('{"topic":"publicTrade.%s","type":"snapshot","ts":1,"data":[{"T":%d,"s":"%s","S":"%s","v":"%s","p":"%s"}]}', sym, ms, sym, side("Sell", "Buy"), q, p),
        say('{"topic":"orderbook.50.%s","type":"delta","ts":%d,"data":{"s":"%s","b":[["%s","%s"]],"a":[["%s","1"],["%s","2"]]}}', sym, ms, sym, p, q, p1, p2),
        say('{"topic":"tickers.%s","ts":%d,"data":{"symbol":"%s","lastPrice":"%s","markPrice":"%s","indexPrice":"%s","fundingRate":"%s","openInterest":"%s","turnover24h":"%s"}}', sym, ms, sym, p, p, p1, rate, q, q),
        say('{"topic":"allLiquidation.%s","ts":%d,"data":[{"T":%d,"s":"%s","S":"%s","v":"%s","p":"%s"}]}', sym, ms, ms, sym, side("Sell", "Buy"), q, p),
        say('{"channel":"ticker","type":"update","data":[{"symbol":"%s","last":%s,"volume":%s,"timestamp":"%s"}]}', sym, p, q, iso),
        F.lit('{"op":"pong"}'),
    ]
    body, venue = bodies[-1], F.lit("bybit")
    for i, (b, (v, _)) in enumerate(zip(bodies[:-1], FORMS, strict=False)):
        body, venue = F.when(k == i, b).otherwise(body), F.when(k == i, F.lit(v)).otherwise(venue)
    out = S.venue_events(t.select("id", venue.alias("venue"), body.alias("body")))
    return out.select(
        "id", "venue", "kind", "symbol", "ts", "price", "size", "side", F.size("bids").cast("long").alias("n_bids"), F.size("asks").cast("long").alias("n_asks"), F.get("asks", F.lit(0))["price"].alias("best_ask"), "snapshot", "mark_price", "funding_rate", "open_interest", "volume"
    ).withColumns({c: F.when(F.col("kind") == "book", F.col(c)) for c in ("n_bids", "n_asks", "best_ask")}).withColumn("best_ask", F.when(k != 8, F.col("best_ask")))


@query(
    "S10_merged_series",
    f"""with {TICKS} select entity, time_bucket(interval 6 hours, ts, timestamp '1970-01-01') as bucket, max(price) filter (venue = 'view') as open_interest, max(price) filter (venue = 'click') as ratio, max(size) filter (venue = 'error') as funding from ticks where venue in ('view', 'click', 'error') group by all""",
)
def merged_series(spark, sf_dir):
    t = ticks(spark, sf_dir).withColumn("bucket", T.floor_to("ts", 21_600))
    one = lambda v, c, n: t.where(F.col("venue") == v).select("entity", "bucket", F.col(c).alias(n))
    return S.merged_series([one("view", "price", "open_interest"), one("click", "price", "ratio"), one("error", "size", "funding")], ["entity", "bucket"])


@query(
    "S11_archive_plan",
    """with d as (select distinct o_orderpriority as symbol, cast(o_orderdate as date) as day from orders), m as (select distinct symbol, cast(date_trunc('month', day) as date) as month from d where month(day) % 2 = 0)
select symbol, false as daily, month as start, last_day(month) as "end" from m where last_day(month) >= date '1997-03-10' and month <= date '1998-09-20'
union all select symbol, true, day, day from d where day between date '1997-03-10' and date '1998-09-20' and not exists (select 1 from m where m.symbol = d.symbol and m.month = cast(date_trunc('month', d.day) as date))""",
)
def archive_plan(spark, sf_dir):
    days = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("day")).distinct()
    daily = days.select("symbol", F.concat(F.lit("daily/x-1m-"), F.col("day").cast("string"), F.lit(".zip")).alias("key"))
    months = days.where(F.month("day") % 2 == 0).select("symbol", F.concat(F.lit("monthly/x-1m-"), F.date_format("day", "yyyy-MM"), F.lit(".zip")).alias("key")).distinct()
    return S.archive_plan(daily.unionByName(months), "1997-03-10", "1998-09-20").select("symbol", "daily", "start", "end")


@query("S12_columnar_rows", "select o_custkey, o_orderkey, o_orderstatus from orders where o_orderdate >= timestamp '1999-01-01' and o_orderstatus in ('F', 'P')")
def columnar_rows(spark, sf_dir):
    recent = read(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    listed = recent.groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus")).alias("l")).select("o_custkey", F.col("l.o_orderkey").alias("o_orderkey"), F.col("l.o_orderstatus").alias("o_orderstatus"))
    return S.columnar_rows(listed, ["o_orderkey", "o_orderstatus"], ["o_custkey"]).where("o_orderstatus in ('F', 'P')")


@query(
    "S12_filings",
    """select o_custkey, o_orderkey || '-' || o_custkey as accession, cast(o_orderdate as date) as filed, o_orderpriority as form, case o_orderpriority when '1-URGENT' then 'current' when '2-HIGH' then 'periodic' else 'other' end as form_class,
  'https://example.org/archives/' || o_custkey || '/' || o_orderkey || o_custkey || '/' || o_orderstatus || '.htm' as url from orders where cast(o_orderdate as date) >= date '1997-06-01'""",
)
def filings(spark, sf_dir):
    """Orders as each customer's columnar filings."""
    o = read(spark, sf_dir, "orders")
    row = F.struct(F.concat_ws("-", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")).alias("a"), F.to_date("o_orderdate").cast("string").alias("d"), F.col("o_orderpriority").alias("f"), F.concat("o_orderstatus", F.lit(".htm")).alias("p"))
    listed = o.groupBy("o_custkey").agg(F.collect_list(row).alias("l"))
    payload = F.to_json(F.struct(F.struct(F.col("l.a").alias("accessionNumber"), F.col("l.d").alias("filingDate"), F.col("l.f").alias("form"), F.col("l.p").alias("primaryDocument")).alias("recent")))
    return S.filings(listed.select("o_custkey", payload.alias("payload")), "payload", "o_custkey", "https://example.org/archives", "1997-06-01", {"1-URGENT": "current", "2-HIGH": "periodic"})


@query("S13_article_symbols", "select p_partkey, unnest(string_split(p_name, ' ')) as symbol from part")
def article_symbols(spark, sf_dir):
    return S.articles(read(spark, sf_dir, "part").withColumn("words", F.split("p_name", " ")), "words").select("p_partkey", "symbol")


@query(
    "S14_stacked_snapshots",
    "select o_custkey as k, 'total' as source, o_totalprice as value, o_orderdate as asof from orders where o_orderstatus = 'P' union all select o_custkey, 'count', cast(count(*) as double), max(o_orderdate) from orders group by 1",
)
def stacked_snapshots(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "k")
    late = o.where("o_orderstatus = 'P'").withColumn("effective", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate")))
    counts = o.groupBy("k").agg(F.count("*").alias("n"), F.max("o_orderdate").alias("d"))
    return S.stacked_snapshots({"total": (late, "o_totalprice", "effective", "o_orderdate"), "count": (counts, "n", None, "d")}, "k")


@query("S15_supply_snapshots", f"with {TICKS} select entity, date_trunc('minute', ts) as minute, max(price) as supply from ticks group by all")
def supply_snapshots(spark, sf_dir):
    body = F.to_json(F.struct(F.col("entity").alias("coin"), F.col("price").alias("supply")))
    raw = ticks(spark, sf_dir).select("ts", F.from_json(body, "coin long, supply double").alias("m"))
    return raw.groupBy(F.col("m.coin").alias("entity"), T.floor_to("ts", 60).alias("minute")).agg(F.max("m.supply").alias("supply"))


@query(
    "S16_catalogue",
    """with c as (select p_partkey, p_brand as base, p_retailprice as priority, case when p_size < 10 then 'too small' when p_type = 'ECONOMY' then 'excluded type' end as reason from part), t as (select *, reason is null and p_partkey % 7 <> 0 as tradable from c)
select p_partkey, base, reason, tradable, tradable and row_number() over (partition by base, tradable order by priority desc, p_partkey) = 1 as preferred from t""",
)
def catalogue(spark, sf_dir):
    p = read(spark, sf_dir, "part").withColumnRenamed("p_brand", "base")
    out = S.catalogue(p, "base", F.col("p_partkey") % 7 != 0, [("too small", F.col("p_size") < 10), ("excluded type", F.col("p_type") == "ECONOMY")], F.col("p_retailprice"), "p_partkey")
    return out.select("p_partkey", "base", "reason", "tradable", "preferred")


@query("S17_option_chain", "select o_custkey, max(o_orderkey) as o_orderkey, arg_max(o_totalprice, o_orderkey) as o_totalprice from orders group by 1")
def option_chain(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    active, inactive = o.where("o_orderstatus <> 'F'"), o.where("o_orderstatus = 'F'")
    return S.last_per_symbol(active, inactive, "o_custkey", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "S18_dataset_inventory",
    "select 'events' as dataset, 'event' as grain, count(*) as rows, min(ts) as first_ts, max(ts) as last_ts from events union all select 'orders', 'order', count(*), min(o_orderdate), max(o_orderdate) from orders union all select 'absent', 'none', null, null, null",
)
def dataset_inventory(spark, sf_dir):
    registry = spark.createDataFrame([("events", "event"), ("orders", "order"), ("absent", "none")], "dataset string, grain string")
    tables = {"events": read(spark, sf_dir, "events").select("ts"), "orders": read(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("ts"))}
    return S.inventory(registry, tables).select("dataset", "grain", "rows", "first_ts", "last_ts")


# ---- write semantics ----------------------------------------------------------------------------------------------------


def halves(spark, sf_dir):
    """Orders as an old and a new batch that share customers."""
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("version"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"))
    latest = lambda d: d.groupBy("k").agg(F.max_by(F.struct("version", "id", "v"), F.struct("version", "id")).alias("r")).select("k", "r.*")
    return latest(o.where("id % 2 = 0")), latest(o.where("id % 2 = 1"))


HALVES = """o as (select o_custkey as k, o_orderdate as version, o_orderkey as id, o_totalprice as v from orders),
old as (select * from o where id % 2 = 0 qualify row_number() over (partition by k order by version desc, id desc) = 1), new as (select * from o where id % 2 = 1 qualify row_number() over (partition by k order by version desc, id desc) = 1)"""


@query("K1_upsert", f"with {HALVES}, u as (select *, 0 as fresh from old union all select *, 1 from new) select k, version, id, v from u qualify row_number() over (partition by k order by version desc, fresh desc) = 1")
def upsert(spark, sf_dir):
    old, new = halves(spark, sf_dir)
    return K.upsert(old, new, ["k"], "version")


@query("K2_insert_absent", f"with {HALVES}, n as (select * from o where id % 2 = 1 qualify row_number() over (partition by k order by version, id) = 1) select * from old union all select * from n where k not in (select k from old)")
def insert_absent(spark, sf_dir):
    old, _ = halves(spark, sf_dir)
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("version"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"))
    return K.insert_absent(old, o.where("id % 2 = 1"), ["k"], ["version", "id"])


@query(
    "K3_additive_merge",
    f"""with {TICKS}, p as (select entity, time_bucket(interval 1 day, ts, timestamp '1970-01-01') as bucket, venue, count(*) as n, sum(size) as volume, max(case when size > 50 then price end) as last_price, max(id) as o from ticks where venue in ('view', 'click') group by all)
select entity, bucket, cast(sum(n) as bigint) as n, sum(volume) as volume, arg_max(last_price, o) filter (last_price is not null) as last_price from p group by all""",
)
def additive_merge(spark, sf_dir):
    p = ticks(spark, sf_dir).groupBy("entity", T.floor_to("ts", 86_400).alias("bucket"), "venue").agg(F.count("*").alias("n"), F.sum("size").alias("volume"), F.max(F.when(F.col("size") > 50, F.col("price"))).alias("last_price"), F.max("id").alias("o"))
    parts = [p.where(F.col("venue") == v).drop("venue") for v in ("view", "click")]
    return K.merge_additive(parts, ["entity", "bucket"], ["n", "volume"], ["last_price"], "o")


@query("K4_coalescing_upsert", f"with {HALVES} select k, case when n.k is not null then n.v else o.v end as v, coalesce(case when n.v > 100000 then n.id end, o.id) as id from old o full join new n using (k)")
def coalescing_upsert(spark, sf_dir):
    old, new = halves(spark, sf_dir)
    return K.coalescing_upsert(old, new.withColumn("id", F.when(F.col("v") > 100_000, F.col("id"))), ["k"], ["v"], ["id"])


@query("K5_segment_manifest", f"with {TICKS} select venue, entity % 4 as shard, cast(ts as date) as segment, count(*) as rows, true as intact from ticks group by all")
def segment_manifest(spark, sf_dir):
    """Segments written as objects; their manifest against what is read back."""
    path = scratch_path(spark, "segments")
    t = ticks(spark, sf_dir).select("venue", (F.col("entity") % 4).alias("shard"), F.to_date("ts").alias("segment"), "id", "ts", "price")
    manifest = materialize(K.write_segments(t, f"{path}/raw", ["venue", "shard", "segment"]), "manifest")
    stored = K.segment_manifest(spark, f"{path}/raw", {}).select("path", F.col("bytes").alias("_b"), F.col("checksum").alias("_c"))
    same = (F.col("bytes") == F.col("_b")) & (F.col("checksum") == F.col("_c")) & (F.length("checksum") == 64)
    out = manifest.join(stored, "path", "left").groupBy("venue", "shard", "segment")
    return out.agg(F.sum("rows").alias("rows"), F.bool_and(F.coalesce(same, F.lit(False))).alias("intact"))


@query("K6_snapshot_replace", f"with {HALVES} select k, v, true as tradable from new union all select k, v, false from old where k not in (select k from new)")
def snapshot_replace(spark, sf_dir):
    old, new = halves(spark, sf_dir)
    return K.snapshot_replace(old.select("k", "v"), new.select("k", "v"), ["k"])


@query("K7_slice_rebuild", "select o_orderkey, case when o_orderpriority = '1-URGENT' then o_totalprice * 2 else o_totalprice end as v from orders")
def slice_rebuild(spark, sf_dir):
    """A table by priority of which one slice is rebuilt in place."""
    path = scratch_path(spark, "slices")
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("v"), "o_orderpriority")
    K.replace_slice(o, f"{path}/rows", ["o_orderpriority"])
    K.replace_slice(o.where("o_orderpriority = '1-URGENT'").withColumn("v", F.col("v") * 2), f"{path}/rows", ["o_orderpriority"])
    return spark.read.schema(o.schema).parquet(f"{path}/rows").select("o_orderkey", "v")


@query("K8_export_rows", "select o_custkey, '[' || string_agg('{\"k\":' || o_orderkey || ',\"s\":\"' || o_orderstatus || '\"}', ',' order by o_orderkey) || ']' as orders from orders group by 1")
def export_rows(spark, sf_dir):
    """Customers and their orders through the CSV export, read back."""
    path = scratch_path(spark, "export")
    listed = F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))))
    K.export_csv({"orders": read(spark, sf_dir, "orders").groupBy("o_custkey").agg(listed.alias("orders"))}, path)
    return spark.read.schema("o_custkey long, orders string").option("header", True).option("escape", '"').csv(f"{path}/orders")


@query("K9_ledger_rows", "select p_brand, '{\"p_brand\":\"' || p_brand || '\",\"n\":' || count(*) || '}' as frozen_definition, sha256('{\"p_brand\":\"' || p_brand || '\",\"n\":' || count(*) || '}') as definition_hash, 'v1' as contract from part group by p_brand")
def ledger_rows(spark, sf_dir):
    g = read(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    return K.ledger_rows(g, ["p_brand", "n"], "v1").drop("n")


@query("K10_new_alerts", f"with {TICKS}, a as (select distinct entity, cast(ts as date) as day from ticks where price >= 100), p as (select distinct entity, cast(ts as date) as day from ticks where price >= 200) select * from a except select * from p")
def new_alerts(spark, sf_dir):
    t = ticks(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return K.alerts_to_append(t.where("price >= 200").select("entity", "day"), t.where("price >= 100").select("entity", "day"), ["entity", "day"])


@query("K11_universe_snapshot", "select c_mktsegment, count(*) as known, count(*) filter (c_acctbal > 0) as tradable, count(*) filter (c_acctbal > 5000) as preferred from customer group by 1")
def universe_snapshot(spark, sf_dir):
    b = F.col("c_acctbal")
    return read(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("known"), F.count_if(b > 0).alias("tradable"), F.count_if(b > 5000).alias("preferred"))


@query("K12_surrogate_keys", "with d as (select distinct p_brand from part where p_partkey < 200) select p_brand, p_brand not in (select p_brand from d) as created from (select distinct p_brand from part)")
def surrogate_keys(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    known = p.where("p_partkey < 200").select("p_brand").distinct().withColumn("key", F.lit(0).cast("long"))
    out = K.surrogate_keys(known, p, ["p_brand"], "key")
    return out.select("p_brand", (F.col("key") != 0).alias("created"))


# ---- quality -------------------------------------------------------------------------------------------------------------

RULES_SQL = """c as (select 'discount in range' as "check", 'error' as severity, count(*) filter (not (l_discount between 0 and 0.1)) as violations from lineitem union all select 'tax positive', 'warning', count(*) filter (not l_tax > 0) from lineitem
union all select 'quantity', 'info', count(*) filter (not l_quantity > 1) from lineitem)"""


def line_checks(spark, sf_dir):
    rules = {"discount in range": ("error", F.col("l_discount").between(0, 0.1)), "tax positive": ("warning", F.col("l_tax") > 0), "quantity": ("info", F.col("l_quantity") > 1)}
    return Q.contracts(read(spark, sf_dir, "lineitem"), rules)


@query("Q1_readiness_gate", f"with {RULES_SQL} select case when bool_or(severity = 'error' and violations > 0) then 'fail' when bool_or(severity = 'warning' and violations > 0) then 'review' else 'pass' end as verdict, cast(sum(violations) as bigint) as violations from c")
def readiness_gate(spark, sf_dir):
    return Q.gate(line_checks(spark, sf_dir))


@query("Q2_row_contracts", f"with {RULES_SQL} select * from c")
def row_contracts(spark, sf_dir):
    return line_checks(spark, sf_dir)


@query("Q3_extent_consistency", f"with {TICKS}, x as (select venue, min(ts) as a, max(ts) as b, count(*) as n from ticks group by 1) select venue, a <= b and n > 0 and a >= timestamp '2024-01-01' - interval 1 minute and b < timestamp '2024-01-31' + interval 1 minute as consistent from x")
def extent_consistency(spark, sf_dir):
    x = Q.extents(ticks(spark, sf_dir), ["venue"], "ts")
    t = lambda s: F.lit(s).cast("timestamp_ntz")
    ok = (F.col("first_ts") <= F.col("last_ts")) & (F.col("rows") > 0) & (F.col("first_ts") >= t("2023-12-31 23:59:00")) & (F.col("last_ts") < t("2024-01-31 00:01:00"))
    return x.select("venue", ok.alias("consistent"))


@query("Q4_reconciliation", "select o_orderpriority as k, count(*) filter (o_orderkey % 50 <> 0) as expected, count(*) as stored, count(*) filter (o_orderkey % 50 <> 0) = count(*) as matches from orders group by 1")
def reconciliation(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "k")
    manifest = o.where("o_orderkey % 50 <> 0").groupBy("k").agg(F.count("*").alias("expected"))
    return Q.reconcile(manifest, o, ["k"])


@query("Q5_duplicate_audit", "select l_orderkey, l_linenumber, count(*) as rows, count(distinct {'p': l_partkey, 's': l_suppkey}) as versions, count(distinct {'p': l_partkey, 's': l_suppkey}) > 1 as conflicting from lineitem group by all having count(*) > 1")
def duplicate_audit(spark, sf_dir):
    return Q.duplicate_audit(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query("Q6_coverage_counters", f"with {TICKS} select count(*) as rows, count(distinct entity) as entities, count(distinct cast(ts as date)) as days, count(distinct {{'e': entity, 'd': cast(ts as date)}}) as entity_days from ticks")
def coverage_counters(spark, sf_dir):
    d = F.to_date("ts")
    return ticks(spark, sf_dir).agg(F.count("*").alias("rows"), F.count_distinct("entity").alias("entities"), F.count_distinct(d).alias("days"), F.count_distinct(F.struct("entity", d)).alias("entity_days"))


@query("Q7_extent_fingerprints", f"with {TICKS} select venue, sha256(count(*) || '|' || strftime(min(ts), '%Y-%m-%d %H:%M:%S') || '|' || strftime(max(ts), '%Y-%m-%d %H:%M:%S')) as fingerprint from ticks group by 1")
def extent_fingerprints(spark, sf_dir):
    return Q.extents(ticks(spark, sf_dir), ["venue"], "ts").select("venue", "fingerprint")


@query("Q9_calendar", f"with {TICKS}, d as (select distinct entity from ticks), c as (select entity, cast(unnest(generate_series(date '2024-01-01', date '2024-01-30', interval 1 day)) as date) as day from d), n as (select entity, cast(ts as date) as day, count(*) as rows from ticks group by all) select entity, day, coalesce(rows, 0) as rows from c left join n using (entity, day)")
def calendar(spark, sf_dir):
    return Q.calendar_gaps(ticks(spark, sf_dir), ["entity"], F.to_date("ts"), "2024-01-01", "2024-01-30")


@query("D8_tail_probabilities")
def tail_probabilities(spark, sf_dir):
    """brand, z and its one-sided and two-sided chance; SQL has no erfc, so tests compare it with Python's."""
    from tidegauge.operators.metrics import cluster_means

    b = cluster_means(trades(spark, sf_dir), ["brand"], ["supplier"], "net")
    return b.select("brand", "z", D.one_sided_p("z").alias("p_one_sided"), D.two_sided_p("z").alias("p_two_sided"))
