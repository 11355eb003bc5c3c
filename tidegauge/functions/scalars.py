"""Column expressions: quotes, books, candles, ratios, names, hashes, text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge.functions.time import col


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(col(a), col(b))


def quotient(a: Column | str, b: Column | str) -> Column:
    """a / b of doubles; where b is zero infinite or, for 0 / 0, not a number."""
    return F.when(col(b) == 0, col(a) * F.pow(col(b), F.lit(-1.0))).otherwise(F.try_divide(col(a), col(b)))


def change(now: Column | str, before: Column | str) -> Column:
    return ratio(now, before) - 1


def valid_quote(bid: Column | str, ask: Column | str) -> Column:
    """Bid positive and not above the ask."""
    return (col(bid) > 0) & (col(ask) >= col(bid))


def mid(bid: Column | str, ask: Column | str) -> Column:
    return (col(bid) + col(ask)) / 2


def spread_bps(bid: Column | str, ask: Column | str) -> Column:
    return ratio(col(ask) - col(bid), mid(bid, ask)) * 10_000


def trade_side(side: Column | str, price: Column | str, bid: Column | str, ask: Column | str) -> Column:
    """The given side, else buy at or above the ask, sell at or below the bid, else by the middle; null in doubt."""
    s, p, b, a = col(side), col(price), col(bid), col(ask)
    return (
        F.when(s.isin("buy", "sell"), s)
        .when((a > 0) & (p >= a), "buy")
        .when((b > 0) & (p <= b), "sell")
        .when((a >= b) & (p > (a + b) / 2), "buy")
        .when((a >= b) & (p < (a + b) / 2), "sell")
    )


def depth(levels: Column | str, n: int = 20) -> Column:
    """Sum of the first n sizes of an array of (price, amount)."""
    return F.aggregate(F.slice(col(levels), 1, n), F.lit(0.0), lambda s, x: s + x["amount"])


def weighted_price(levels: Column | str, n: int = 20) -> Column:
    top = F.slice(col(levels), 1, n)
    return ratio(F.aggregate(top, F.lit(0.0), lambda s, x: s + x["price"] * x["amount"]), depth(levels, n))


def microprice(bid: Column | str, bid_size: Column | str, ask: Column | str, ask_size: Column | str) -> Column:
    return ratio(col(ask) * col(bid_size) + col(bid) * col(ask_size), col(bid_size) + col(ask_size))


def imbalance(a: Column | str, b: Column | str) -> Column:
    return ratio(col(a) - col(b), col(a) + col(b))


def candle_shape(o: str = "open", h: str = "high", lo: str = "low", c: str = "close") -> dict[str, Column]:
    """Body efficiency, wick shares and range of a candle."""
    height = F.col(h) - F.col(lo)
    return {
        "body_efficiency": ratio(F.abs(F.col(c) - F.col(o)), height),
        "upper_wick_share": ratio(F.col(h) - F.greatest(o, c), height),
        "lower_wick_share": ratio(F.least(o, c) - F.col(lo), height),
        "range": change(h, lo),
    }


def log1p_clipped(x: Column | str) -> Column:
    return F.log1p(F.greatest(col(x).cast("double"), F.lit(0.0)))


def wilson(wins: Column | str, n: Column | str, z: float = 1.96) -> tuple[Column, Column]:
    """Bounds of the Wilson score interval; null for n = 0."""
    k, m = col(wins).cast("double"), F.nullif(col(n).cast("double"), F.lit(0.0))
    share = k / m
    scale = 1 + z * z / m
    centre = (share + z * z / (2 * m)) / scale
    half = z * F.sqrt(share * (1 - share) / m + z * z / (4 * m * m)) / scale
    return centre - half, centre + half


def votes(conditions: list[Column], null_as_false: bool = False) -> Column:
    """How many conditions hold; null if one is unknown, unless those count as false."""
    total = F.lit(0)
    for c in conditions:
        total = total + (F.coalesce(c, F.lit(False)) if null_as_false else c).cast("int")
    return total


def all_but(parts: dict[str, Column], left_out: str | None = None) -> Column:
    """Conjunction of the named conditions without one of them."""
    out = F.lit(True)
    for name, c in parts.items():
        if name != left_out:
            out = out & c
    return out


def contract_multiplier(symbol: Column | str, exceptions: tuple[str, ...] = ("1000SATSUSDT",)) -> Column:
    """1000 for symbols that quote a thousand units, else 1."""
    s = col(symbol)
    return F.when(s.rlike("^1000.*USDT$") & ~s.isin(*exceptions), 1000.0).otherwise(1.0)


def contract_candidates(base: Column | str) -> Column:
    """Names under which a base may be listed."""
    return F.array(F.concat(col(base), F.lit("USDT")), F.concat(F.lit("1000"), col(base), F.lit("USDT")))


def asset_code(code: Column | str) -> Column:
    """Upper-case code; XBT is BTC; a leading X or Z of a four-letter code goes."""
    c = F.upper(F.trim(col(code)))
    short = F.when((F.length(c) == 4) & c.rlike("^[XZ]"), F.substring(c, 2, 3)).otherwise(c)
    return F.when(short == "XBT", "BTC").when(short == "XDG", "DOGE").otherwise(short)


LEVERAGED = r"(UP|DOWN|BULL|BEAR|[0-9]+[LS])$"


def is_leveraged(base: Column | str) -> Column:
    return col(base).rlike(LEVERAGED)


def period_of(key: Column | str) -> Column:
    """yyyy-MM or yyyy-MM-dd in a file name; empty if there is none."""
    return F.regexp_extract(col(key), r"(\d{4}-\d{2}(?:-\d{2})?)\.[a-z]+$", 1)


def content_key(*columns: Column | str) -> Column:
    """SHA-256 of the columns as one JSON object."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def safe_name(name: Column | str) -> Column:
    """Lower-case ASCII letters, digits and -._ only, with a digest's start where anything was replaced."""
    n = col(name)
    plain = F.regexp_replace(n, r"[^A-Za-z0-9._-]+", "_")
    return F.when(plain == n, plain).otherwise(F.concat(plain, F.lit("-"), F.substring(F.sha2(n, 256), 1, 8)))


def symbol_class(symbol: Column | str) -> Column:
    """crypto or fx for pairs with a slash, by their first part; index for a leading mark; else stock."""
    s = col(symbol)
    fx = ("USD", "EUR", "GBP", "JPY", "CHF", "AUD", "CAD", "NZD")
    base = F.split(s, "/").getItem(0)
    return F.when(s.contains("/") & base.isin(*fx), "fx").when(s.contains("/"), "crypto").when(s.rlike(r"^[\^$]"), "index").otherwise("stock")


def html_to_text(html: Column | str) -> Column:
    """Text of a page by patterns: without scripts, styles and tags, white space made single."""
    t = F.regexp_replace(col(html), r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]+>", " ")
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(sign))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def phrases_found(text: Column | str, phrases: list[str]) -> Column:
    """The phrases that the text contains, in the given order, whatever their case."""
    low = F.lower(col(text))
    return F.filter(F.array(*map(F.lit, phrases)), lambda p: F.contains(low, p))


def snippets(text: Column | str, phrases: list[str], before: int = 180, after: int = 260, most: int = 8) -> Column:
    """Up to ``most`` stretches of text around each phrase's first place, in the order of the phrases."""
    t = col(text)
    found = F.transform(phrases_found(t, phrases), lambda p: F.instr(F.lower(t), p))
    cut = F.transform(found, lambda i: F.substring(t, F.greatest(i - before, F.lit(1)), i + after - F.greatest(i - before, F.lit(1))))
    return F.slice(cut, 1, most)


#: Phrases that speak of new shares, and the patterns of amounts of money and of shares.
DILUTION = (
    "at-the-market", "at the market offering", "sales agreement", "shelf registration", "prospectus supplement", "common stock offering", "registered direct offering", "private placement", "warrant", "convertible note",
    "convertible preferred", "shares of common stock", "resale prospectus", "equity line", "purchase agreement",
)
MONEY = r"(?i)\$\s?\d[\d,]*(?:\.\d+)?\s?(?:million|billion)?"
SHARES = r"(?i)\b\d[\d,]*(?:\.\d+)?\s+(?:shares|units)\b"


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def places_of(text: Column, phrase: str) -> Column:
    """The places (from 0) at which a text has the phrase, from left to right and not overlapping."""

    def walked(parts: Column) -> Column:
        place = lambda at, x: F.concat(at, F.array(F.element_at(at, -1) + len(phrase) + F.length(x)))
        return F.aggregate(F.slice(parts, F.lit(2), F.size(parts) - 2), F.array(F.length(F.get(parts, F.lit(0)))), place)

    return F.when(F.contains(text, F.lit(phrase)), _once(F.split(text, rf"\Q{phrase}\E"), walked)).otherwise(F.array().cast("array<int>"))


def phrase_signals(text: Column | str, phrases: tuple[str, ...] = DILUTION, before: int = 180, after: int = 260, most: int = 8) -> Column:
    """phrases (sorted) and snippets: up to ``most`` different stretches of text around the phrases' places, all places of a
    phrase before those of the next. Phrases that come only after the last stretch has been taken don't count."""
    t = F.coalesce(col(text), F.lit(""))

    def around(own: Column, phrase: str) -> Column:
        left = lambda i: F.greatest(i - before, F.lit(0))
        cut = lambda i: F.substring(t, left(i) + 1, i + len(phrase) + after - left(i))
        # spaces alone are trimmed much faster
        bare = lambda i: F.when(own["odd"], F.btrim(cut(i), F.lit(" \t\n\x0b\f\r"))).otherwise(F.trim(cut(i)))
        return F.transform(places_of(own["low"], phrase), lambda i: F.struct(F.lit(phrase).alias("p"), bare(i).alias("s")))

    def kept(met: Column) -> Column:
        cuts = F.transform(met, lambda x: x["s"])
        last = lambda own: F.when(F.size(own) >= most, F.array_position(cuts, F.get(own, F.lit(most - 1)))).otherwise(F.size(met)).cast("int")
        found = lambda own: F.array_sort(F.array_distinct(F.transform(F.slice(met, F.lit(1), last(own)), lambda x: x["p"])))
        return _once(F.array_distinct(cuts), lambda own: F.struct(found(own).alias("phrases"), F.slice(own, 1, most).alias("snippets")))

    known = F.struct(F.lower(t).alias("low"), t.rlike(r"[\x09-\x0D]").alias("odd"))
    return _once(known, lambda own: _once(F.concat(*(around(own, p) for p in phrases)), kept))


def mentions(text: Column | str, pattern: str, most: int = 10) -> Column:
    """Up to ``most`` distinct matches of the pattern, in order."""
    return F.slice(F.array_distinct(F.regexp_extract_all(col(text), F.lit(pattern), F.lit(0))), 1, most)
