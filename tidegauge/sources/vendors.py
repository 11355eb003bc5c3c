"""Payloads of market-data vendors as one canonical table of bars, trades, quotes and indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.sources.readers import _objects, _time

#: The canonical columns; those that a kind doesn't have are null. side is the taker's.
ROW = {
    "kind": "string", "ts": "timestamp_ntz", "open": "double", "high": "double", "low": "double", "close": "double", "volume": "double", "quote_volume": "double", "trades": "long", "vwap": "double",
    "taker_base": "double", "taker_quote": "double", "price": "double", "size": "double", "side": "string", "trade_id": "string", "bid": "double", "bid_size": "double", "ask": "double", "ask_size": "double",
    "name": "string", "value": "double",
}


def _row(kind: str, **values: Column) -> Column:
    given = {"kind": F.lit(kind), **values}
    return F.struct(*(given.get(name, F.lit(None)).try_cast(of).alias(name) for name, of in ROW.items()))


def _listed(body: Column, path: str) -> Column:
    """The objects of the array under a name of the payload, as maps of text."""
    return F.coalesce(_objects(F.from_json(body, "map<string,string>")[path]), F.array().cast("array<map<string,string>>"))


def _arrays(body: Column) -> Column:
    """An array of arrays, as text."""
    return F.coalesce(F.from_json(body, "array<array<string>>"), F.array().cast("array<array<string>>"))


def _long(rows: Column, n: int) -> Column:
    return F.filter(rows, lambda r: F.size(r) >= n)


def _alpaca(body: Column) -> Column:
    """Pages of bars, of trades (without a taker's side) and of quotes."""
    bar = lambda x: _row("bar", ts=_time(x["t"]), open=x["o"], high=x["h"], low=x["l"], close=x["c"], volume=x["v"], trades=x["n"], vwap=x["vw"])
    trade = lambda x: _row("trade", ts=_time(x["t"]), price=x["p"], size=x["s"], trade_id=x["i"])
    quote = lambda x: _row("quote", ts=_time(x["t"]), bid=x["bp"], bid_size=x["bs"], ask=x["ap"], ask_size=x["as"])
    return F.concat(*(F.transform(_listed(body, path), one) for path, one in (("bars", bar), ("trades", trade), ("quotes", quote))))


def _klines(body: Column) -> Column:
    """Arrays of eleven fields at least; a shorter one is left out."""
    one = lambda x: _row("bar", ts=_time(x[0]), open=x[1], high=x[2], low=x[3], close=x[4], volume=x[5], quote_volume=x[7], trades=x[8], taker_base=x[9], taker_quote=x[10])
    return F.transform(_long(_arrays(body), 11), one)


def _aggregated(body: Column) -> Column:
    """Trades of one taker order each; the buyer as maker makes the taker a seller."""
    one = lambda x: _row("trade", ts=_time(x["T"]), price=x["p"], size=x["q"], side=F.when(x["m"] == "true", "sell").otherwise("buy"), trade_id=x["a"])
    return F.transform(F.coalesce(_objects(body), F.array().cast("array<map<string,string>>")), one)


def _candles(body: Column) -> Column:
    """Arrays of time, low, high, open, close and volume; a shorter one is left out."""
    one = lambda x: _row("bar", ts=_time(x[0]), low=x[1], high=x[2], open=x[3], close=x[4], volume=x[5])
    return F.transform(_long(_arrays(body), 6), one)


#: What a row of values says of a bar; any other name is an indicator's.
_BAR = ("open", "high", "low", "close", "volume")


def _values(body: Column) -> Column:
    """Rows with a time and either a bar's five values or indicators, of which each is a row of its own."""
    listed = _listed(body, "values")
    bars = F.transform(F.filter(listed, lambda x: x["close"].isNotNull()), lambda x: _row("bar", ts=_time(x["datetime"]), **{c: x[c] for c in _BAR}))
    named = lambda x: F.filter(F.map_entries(x), lambda e: ~e["key"].isin("datetime", *_BAR))
    points = F.flatten(F.transform(listed, lambda x: F.transform(named(x), lambda e: _row("indicator", ts=_time(x["datetime"]), name=e["key"], value=e["value"]))))
    return F.concat(bars, points)


FEEDS = {"alpaca": _alpaca, "binance_klines": _klines, "binance_trades": _aggregated, "coinbase_candles": _candles, "twelvedata": _values}


def vendor_rows(payloads: DataFrame, feed: str = "feed", body: str = "body") -> DataFrame:
    """The columns of ``payloads`` but the body, and those of ROW, one row for each item of a payload.

    Payloads of a feed that isn't known, and broken ones, give no rows. An item without a time, a trade without a price or
    size, a bar without a close and an indicator without a number are left out.
    """
    none = F.array().cast(f"array<struct<{','.join(f'{k}:{v}' for k, v in ROW.items())}>>")
    items = none
    for name, read in FEEDS.items():
        items = F.when(F.col(feed) == name, read(F.col(body))).otherwise(items)
    kept = [c for c in payloads.columns if c != body]
    rows = payloads.select(*kept, F.explode(items).alias("_i")).select(*kept, "_i.*")
    whole = F.when(F.col("kind") == "trade", F.col("price").isNotNull() & F.col("size").isNotNull()).when(F.col("kind") == "bar", F.col("close").isNotNull()).when(F.col("kind") == "indicator", F.col("value").isNotNull()).otherwise(True)
    return rows.where(F.col("ts").isNotNull() & whole)
