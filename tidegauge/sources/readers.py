"""Sources: files and raw messages into typed rows. Malformed rows are skipped where a source says so."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions.time import col, from_epoch

KLINE = ("open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "trades", "taker_base", "taker_quote")
#: Lines of a zip member in one row batch.
LINES = 50_000


def bars(df: DataFrame, start: str, end: str, provider: str | None = None, instrument: object = None, ts: str = "ts") -> DataFrame:
    """Rows of [start, end), of one provider and instrument if given. The filters reach the scan."""
    out = df.where((F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz")))
    if provider is not None:
        out = out.where(F.col("provider") == provider)
    return out.where(F.col("entity") == instrument) if instrument is not None else out


def zip_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line_no, line of the text members of zip files; a file is one task's, its lines stream out in batches."""

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        with io.TextIOWrapper(archive.open(member), "utf-8") as lines:
                            rows, at = [], 0
                            for line in lines:
                                rows.append(line.rstrip("\r\n"))
                                if len(rows) == LINES:
                                    yield pd.DataFrame({"path": name, "line_no": range(at, at + len(rows)), "line": rows})
                                    at, rows = at + len(rows), []
                            if rows:
                                yield pd.DataFrame({"path": name, "line_no": range(at, at + len(rows)), "line": rows})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path", "content")
    return files.mapInPandas(unzip, "path string, line_no long, line string")


def klines(lines: DataFrame, line: str = "line", keep: list[str] | None = None) -> DataFrame:
    """Bars from lines of at least 11 comma-separated fields; epochs in milli- or microseconds. Lines that don't parse,
    headers among them, are skipped."""
    f = F.split(col(line), ",")
    number = lambda i: f[i].try_cast("double")
    out = lines.where(F.size(f) >= 11).select(
        *(keep or []),
        from_epoch(f[0].try_cast("long")).alias("ts"),
        *(number(i).alias(n) for i, n in enumerate(KLINE) if n in ("open", "high", "low", "close", "volume", "quote_volume")),
        f[8].try_cast("long").alias("trades"),
        number(10).alias("taker_quote"),
    )
    return out.dropna(subset=["ts", "open", "high", "low", "close"])


def resolve_columns(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns under their canonical names, whichever alias the source uses; a missing one raises ValueError."""
    have = {c.lower(): c for c in df.columns}
    found = {}
    for name, options in aliases.items():
        match = next((have[o] for o in [name, *options] if o in have), None)
        if match is None:
            raise ValueError(f"no column for {name}: {df.columns}")
        found[name] = match
    return df.select(*(F.col(f"`{c}`").alias(n) for n, c in found.items()))


FUNDING = {"ts": ["funding_time", "calc_time", "fundingtime", "timestamp"], "rate": ["funding_rate", "last_funding_rate", "fundingrate"]}
BOOK_TICKER = {
    "update_id": ["u"], "bid": ["best_bid_price", "bid_price", "b"], "bid_size": ["best_bid_qty", "bid_qty"],
    "ask": ["best_ask_price", "ask_price", "a"], "ask_size": ["best_ask_qty", "ask_qty"], "ts": ["transaction_time", "event_time"],
}


def named_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """Names for a table without header of exactly these columns."""
    if len(df.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, found {len(df.columns)}")
    return df.toDF(*names)


def required(df: DataFrame, columns: list[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def level_arrays(df: DataFrame, sides: dict[str, list[tuple[str, str]]], keep: list[str]) -> DataFrame:
    """Wide price and amount columns into arrays of levels; levels that are empty or not positive, and rows without a
    side or with a bid at or above the ask, are left out."""
    arrays = {}
    for side, columns in sides.items():
        raw = F.array(*(F.struct(F.col(f"`{p}`").cast("double").alias("price"), F.col(f"`{a}`").cast("double").alias("amount")) for p, a in columns))
        arrays[side] = F.filter(raw, lambda x: (x["price"] > 0) & (x["amount"] > 0))
    out = df.select(*keep, *(a.alias(s) for s, a in arrays.items()))
    best = lambda s: F.get(F.col(s), F.lit(0))["price"]
    return out.where((F.size("bids") > 0) & (F.size("asks") > 0) & (best("bids") < best("asks")))


#: Columns of a file of best quotes.
QUOTES = ("exchange", "symbol", "timestamp", "local_timestamp", "ask_amount", "ask_price", "bid_price", "bid_amount")


def quote_files(spark: SparkSession, path: str, columns: tuple[str, ...] = QUOTES) -> DataFrame:
    """Best quotes from CSV files with header, gzipped or not: ts, exchange, symbol and sizes and prices of either side. Epochs
    are of any unit. A file without one of the columns raises ValueError; rows without a time or a price are left out."""
    raw = required(spark.read.option("header", True).csv(path), list(columns))
    number = lambda c: F.col(c).try_cast("double").alias(c)
    out = raw.select("exchange", "symbol", from_epoch(F.col("timestamp").try_cast("long")).alias("ts"), from_epoch(F.col("local_timestamp").try_cast("long")).alias("received"), *map(number, columns[4:]))
    return out.dropna(subset=["ts", "ask_price", "bid_price"])


def short_volume(lines: DataFrame, catalogue: DataFrame, line: str = "line", symbol: str = "symbol") -> DataFrame:
    """date, symbol, short, total, market from lines `date|symbol|short|exempt|total|market`, of catalogued symbols only;
    a line without a market has none."""
    f = F.split(col(line), r"\|")
    rows = lines.where(F.size(f) >= 5).select(f[0].alias("date"), f[1].alias(symbol), f[2].try_cast("double").alias("short"), f[4].try_cast("double").alias("total"), F.get(f, F.lit(5)).alias("market"))
    return rows.dropna(subset=["date", symbol, "short", "total"]).join(catalogue.select(symbol).distinct(), symbol, "left_semi")


CANDLES = "array<array<double>>"


def candle_payloads(df: DataFrame, payload: str, keep: list[str]) -> DataFrame:
    """Rows of `[[time, low, high, open, close, volume], ...]`."""
    x = df.select(*keep, F.explode(F.from_json(payload, CANDLES)).alias("_c"))
    names = ("low", "high", "open", "close", "volume")
    return x.select(*keep, from_epoch(F.col("_c")[0].cast("long")).alias("ts"), *(F.col("_c")[i + 1].alias(n) for i, n in enumerate(names)))


def object_payloads(df: DataFrame, payload: str, path: str, fields: dict[str, tuple[str, str]], keep: list[str]) -> DataFrame:
    """Rows of an array of objects under ``path``; fields: canonical name -> (vendor's name, type)."""
    inner = ", ".join(f"`{v}`: {t}" for v, t in fields.values())
    schema = f"struct<`{path}`: array<struct<{inner}>>>"
    x = df.select(*keep, F.explode(F.from_json(payload, schema)[path]).alias("_o"))
    return x.select(*keep, *(F.col("_o")[v].alias(n) for n, (v, _) in fields.items()))


#: What a message may say; columns that a kind doesn't have are null. A snapshot's levels replace the book.
EVENT = {
    "kind": "string", "symbol": "string", "ts": "timestamp_ntz", "event_id": "string", "price": "double", "size": "double", "side": "string",
    "bids": "array<struct<price:double,size:double>>", "asks": "array<struct<price:double,size:double>>", "snapshot": "boolean",
    "mark_price": "double", "index_price": "double", "funding_rate": "double", "next_funding_at": "timestamp_ntz", "open_interest": "double", "volume": "double",
}


def _event(kind: str, **values: Column) -> Column:
    given = {"kind": F.lit(kind), **values}
    return F.struct(*(given.get(name, F.lit(None)).try_cast(kind_).alias(name) for name, kind_ in EVENT.items()))


def _object(text: Column) -> Column:
    """A JSON object as a map of names, which may differ in case only, to the text of their values."""
    return F.from_json(text, "map<string,string>")


def _objects(text: Column) -> Column:
    """An array of JSON objects; a single one counts as an array of one."""
    return F.when(text.startswith("["), F.from_json(text, "array<map<string,string>>")).otherwise(F.array(_object(text)))


def _pairs(text: Column) -> Column:
    """[[price, size], ...] as levels; none where there is no such text."""
    found = F.coalesce(F.from_json(text, "array<array<string>>"), F.array().cast("array<array<string>>"))
    return F.transform(found, lambda x: F.struct(x[0].try_cast("double").alias("price"), x[1].try_cast("double").alias("size")))


def _time(value: Column) -> Column:
    """An epoch of any unit or an ISO time."""
    return F.coalesce(from_epoch(value.try_cast("long")), F.regexp_replace(value, "Z$", "").try_cast("timestamp_ntz"))


def _binance(body: Column) -> Column:
    """Spot and futures: trades with a maker flag, books whole or as changes, marks, liquidations, tickers."""
    d = _object(F.coalesce(_object(body)["data"], body))
    o, e = _object(d["o"]), d["e"]
    at = _time(F.coalesce(d["E"], d["T"], o["T"]))
    whole = d["bids"].isNotNull() | d["asks"].isNotNull()
    symbol = F.upper(F.coalesce(d["s"], o["s"], F.split_part(_object(body)["stream"], F.lit("@"), F.lit(1))))
    return (
        F.when(e.isin("aggTrade", "trade"), _event("trade", symbol=symbol, ts=at, price=d["p"], size=d["q"], side=F.when(d["m"] == "true", "sell").otherwise("buy")))
        .when(whole, _event("book", symbol=symbol, ts=at, bids=_pairs(d["bids"]), asks=_pairs(d["asks"]), snapshot=F.lit(True)))
        .when(e == "depthUpdate", _event("book", symbol=symbol, ts=at, bids=_pairs(d["b"]), asks=_pairs(d["a"]), snapshot=F.lit(False)))
        .when(e == "markPriceUpdate", _event("mark", symbol=symbol, ts=at, mark_price=d["p"], index_price=d["i"], funding_rate=d["r"], next_funding_at=_time(d["T"])))
        .when(e == "forceOrder", _event("liquidation", symbol=symbol, ts=at, event_id=F.coalesce(o["T"], d["E"]), price=F.coalesce(o["ap"], o["p"]), size=o["q"], side=F.lower(o["S"])))
        .when(e.isin("24hrMiniTicker", "24hrTicker"), _event("ticker", symbol=symbol, ts=at, price=d["c"], volume=d["q"]))
    )


def _coinbase(body: Column) -> Column:
    """Trades with the maker's side, which is turned round; books, changes and tickers."""
    d = _object(body)
    kind, symbol, at = d["type"], d["product_id"], _time(d["time"])
    changes = F.from_json(d["changes"], "array<array<string>>")
    of = lambda side: F.transform(F.filter(changes, lambda x: x[0] == side), lambda x: F.struct(x[1].try_cast("double").alias("price"), x[2].try_cast("double").alias("size")))
    return (
        F.when(kind.isin("match", "last_match"), _event("trade", symbol=symbol, ts=at, price=d["price"], size=d["size"], side=F.when(d["side"] == "sell", "buy").otherwise("sell")))
        .when(kind == "snapshot", _event("book", symbol=symbol, ts=at, bids=_pairs(d["bids"]), asks=_pairs(d["asks"]), snapshot=F.lit(True)))
        .when(kind == "l2update", _event("book", symbol=symbol, ts=at, bids=of("buy"), asks=of("sell"), snapshot=F.lit(False)))
        .when(kind == "ticker", _event("ticker", symbol=symbol, ts=at, price=d["price"], volume=d["volume_24h"].try_cast("double") * d["price"].try_cast("double")))
    )


def _kraken(body: Column) -> Column:
    """Several items a message: trades with the taker's side, books as objects of levels, tickers."""
    m = _object(body)
    channel = m["channel"]
    levels = lambda text: F.transform(F.coalesce(F.from_json(text, "array<struct<price:double,qty:double>>"), F.array().cast("array<struct<price:double,qty:double>>")), lambda x: F.struct(x["price"].alias("price"), x["qty"].alias("size")))
    one = lambda d: (
        F.when(channel == "trade", _event("trade", symbol=d["symbol"], ts=_time(d["timestamp"]), price=d["price"], size=d["qty"], side=F.coalesce(d["side"], F.lit("sell"))))
        .when(channel == "book", _event("book", symbol=d["symbol"], ts=_time(d["timestamp"]), bids=levels(d["bids"]), asks=levels(d["asks"]), snapshot=m["type"] == "snapshot"))
        .when(channel == "ticker", _event("ticker", symbol=d["symbol"], ts=_time(d["timestamp"]), price=d["last"], volume=d["volume"].try_cast("double") * d["last"].try_cast("double")))
    )
    return F.transform(_objects(m["data"]), one)


def _bybit(body: Column) -> Column:
    """Several items a message: trades and liquidations with the taker's side; books whole or as changes; tickers, which
    tell the mark, the funding and the open interest."""
    m = _object(body)
    topic, at = m["topic"], _time(m["ts"])
    symbol = F.element_at(F.split(topic, r"\."), -1)
    when = lambda d: F.coalesce(_time(d["T"]), at)
    side = lambda d: F.lower(F.coalesce(d["S"], F.lit("Sell")))
    one = lambda d: (
        F.when(topic.startswith("publicTrade"), _event("trade", symbol=symbol, ts=when(d), price=d["p"], size=d["v"], side=side(d)))
        .when(topic.startswith("orderbook"), _event("book", symbol=symbol, ts=at, bids=_pairs(d["b"]), asks=_pairs(d["a"]), snapshot=m["type"] == "snapshot"))
        .when(topic.startswith("tickers"), _event("mark", symbol=symbol, ts=at, price=d["lastPrice"], mark_price=d["markPrice"], index_price=d["indexPrice"], funding_rate=d["fundingRate"], open_interest=d["openInterest"], volume=d["turnover24h"]))
        .when(topic.startswith("allLiquidation"), _event("liquidation", symbol=symbol, ts=when(d), event_id=d["T"], price=d["p"], size=d["v"], side=side(d)))
    )
    return F.transform(_objects(m["data"]), one)


def venue_events(messages: DataFrame, venue: str = "venue", body: str = "body") -> DataFrame:
    """Messages of five venues as one table: the columns of ``messages`` but the body, and those of EVENT, one row for each
    item of a message. Works on streams too.

    kind: trade (side is the taker's), book, mark, liquidation or ticker; messages that are none of these, heartbeats and
    broken JSON among them, have the kind unknown, so that they can be counted. Trades and liquidations without a price
    or size are unknown too.
    """
    text = F.col(body)
    one = lambda c: F.array(c)
    found = F.when(F.col(venue).isin("binance_spot", "binance_futures"), one(_binance(text))).when(F.col(venue) == "coinbase", one(_coinbase(text))).when(F.col(venue) == "kraken", _kraken(text)).when(F.col(venue) == "bybit", _bybit(text))
    empty = _event("unknown")
    priced = lambda x: ~x["kind"].isin("trade", "liquidation") | (x["price"].isNotNull() & x["size"].isNotNull())
    sound = F.transform(found, lambda x: F.when(x.isNotNull() & priced(x), x).otherwise(empty))
    events = F.when(F.coalesce(F.size(sound), F.lit(0)) > 0, sound).otherwise(F.array(empty))
    return messages.withColumn("_m", F.explode(events)).select(*[c for c in messages.columns if c != body], "_m.*")


def merged_series(series: list[DataFrame], key: list[str]) -> DataFrame:
    """Sparse series of one key as one row per key: the largest value of each column."""
    both = series[0]
    for s in series[1:]:
        both = both.unionByName(s, allowMissingColumns=True)
    return both.groupBy(*key).agg(*(F.max(c).alias(c) for c in both.columns if c not in key))


def archive_plan(listing: DataFrame, first: str, last: str, key: str = "key") -> DataFrame:
    """Monthly archives that touch [first, last] and daily ones for dates that no monthly archive covers."""
    period = F.regexp_extract(col(key), r"(\d{4}-\d{2}(?:-\d{2})?)\.zip$", 1)
    dated = listing.withColumn("_p", period).where("_p <> ''")
    dated = dated.withColumns({"daily": F.length("_p") == 10, "start": F.when(F.length("_p") == 10, F.to_date("_p")).otherwise(F.to_date(F.concat("_p", F.lit("-01"))))})
    dated = dated.withColumn("end", F.when(F.col("daily"), F.col("start")).otherwise(F.last_day("start")))
    inside = dated.where((F.col("end") >= F.lit(first).cast("date")) & (F.col("start") <= F.lit(last).cast("date")))
    monthly, by_day = inside.where("not daily"), inside.where("daily")
    covered = monthly.select("symbol", F.trunc("start", "month").alias("_month")).distinct()
    rest = by_day.withColumn("_month", F.trunc("start", "month")).join(covered, ["symbol", "_month"], "left_anti").drop("_month")
    return monthly.unionByName(rest.select(monthly.columns)).drop("_p")


def columnar_rows(df: DataFrame, arrays: list[str], keep: list[str]) -> DataFrame:
    """Parallel arrays as rows."""
    return df.select(*keep, F.explode(F.arrays_zip(*arrays)).alias("_r")).select(*keep, *(F.col(f"_r.{a}").alias(a) for a in arrays))


def filings(df: DataFrame, payload: str, entity: str, base: str, cutoff: str, classes: dict[str, str]) -> DataFrame:
    """Filings of each entity from columnar JSON ({"recent": {"accessionNumber": [...], "filingDate": [...], "form": [...],
    "primaryDocument": [...]}}) on or after the cutoff: entity, accession, filed, form, form_class (by form, else
    other) and url."""
    names = ("accessionNumber", "filingDate", "form", "primaryDocument")
    recent = F.from_json(payload, "struct<recent:struct<" + ",".join(f"{n}:array<string>" for n in names) + ">>")["recent"]
    rows = columnar_rows(df.select(F.col(entity), *(recent[n].alias(n) for n in names)), list(names), [entity])
    form_class = F.coalesce(F.create_map(*(F.lit(x) for pair in classes.items() for x in pair))[F.col("form")], F.lit("other"))
    url = F.concat_ws("/", F.lit(base), F.col(entity).cast("string"), F.regexp_replace("accessionNumber", "-", ""), "primaryDocument")
    out = rows.select(entity, F.col("accessionNumber").alias("accession"), F.col("filingDate").try_cast("date").alias("filed"), "form", form_class.alias("form_class"), url.alias("url"))
    return out.where(F.col("filed") >= F.lit(cutoff).cast("date"))


def articles(df: DataFrame, symbols: str, wanted: Column | None = None) -> DataFrame:
    """One row per article and symbol."""
    out = df.withColumn("symbol", F.explode(symbols))
    return out.where(wanted) if wanted is not None else out


def stacked_snapshots(sources: dict[str, tuple[DataFrame, str, str | None, str]], key: str) -> DataFrame:
    """As-of rows of several sources: key, source, value, asof; asof is the effective date or else the fallback."""
    out = None
    for name, (df, value, effective, fallback) in sources.items():
        asof = F.coalesce(F.col(effective), F.col(fallback)) if effective else F.col(fallback)
        rows = df.select(key, F.lit(name).alias("source"), F.col(value).cast("double").alias("value"), asof.alias("asof"))
        out = rows if out is None else out.unionByName(rows)
    return out


def catalogue(df: DataFrame, base: str, tradable: Column, reasons: list[tuple[str, Column]], priority: Column, tie: str, every: bool = False) -> DataFrame:
    """Instruments with tradable, reason (the first that excludes), priority and preferred: the best tradable one of each
    base, or every one."""
    reason = F.coalesce(*(F.when(c, F.lit(n)) for n, c in reasons))
    out = df.withColumns({"reason": reason, "priority": priority}).withColumn("tradable", tradable & F.col("reason").isNull())
    rank = F.row_number().over(Window.partitionBy(base, "tradable").orderBy(F.desc("priority"), tie))
    return out.withColumn("preferred", F.col("tradable") if every else F.col("tradable") & (rank == 1))


def last_per_symbol(active: DataFrame, inactive: DataFrame, symbol: str, order: str) -> DataFrame:
    """Rows of both lists, of each symbol the last by order."""
    both = active.unionByName(inactive)
    return both.groupBy(symbol).agg(F.max_by(F.struct(*both.columns), F.struct(order)).alias("_r")).select("_r.*")


def inventory(registry: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Registered datasets (dataset, grain, ts_column, pit_safe) with the rows and extent of their tables."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")).withColumn("dataset", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return registry.join(out, "dataset", "left")
