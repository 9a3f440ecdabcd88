"""Vendors' option files as one chain schema. Files are read by Spark in parallel; headers and layouts differ by vendor."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from volframe.functions.pricing import occ_symbol

# fixed values: names under which vendors give a column (see header), those that come first win
NAMES = {
    "as_of": ("date", "quote_date", "data_date", "trade_date", "as_of", "quotedate"),
    "expiration": ("expiration", "expire_date", "expiry", "expiration_date", "exp_date"),
    "strike": ("strike", "strike_price"),
    "option_type": ("option_type", "cp_flag", "type", "call_put"),
    "implied_volatility": ("implied_volatility", "iv", "impl_volatility", "implied_vol"),
    "underlying_price": ("underlying_price", "stock_price", "spot", "close", "underlying_last", "active_underlying_price"),
    "bid": ("bid",), "ask": ("ask",), "volume": ("volume",), "open_interest": ("open_interest", "oi"),
    "call_iv": ("call_iv", "c_iv", "call_implied_volatility", "impl_volatility_c"), "put_iv": ("put_iv", "p_iv", "put_implied_volatility", "impl_volatility_p"),
    "call_bid": ("call_bid", "c_bid", "best_bid_c", "bid_c"), "put_bid": ("put_bid", "p_bid", "best_bid_p", "bid_p"),
    "call_ask": ("call_ask", "c_ask", "best_offer_c", "ask_c"), "put_ask": ("put_ask", "p_ask", "best_offer_p", "ask_p"),
    "call_volume": ("call_volume", "c_volume", "volume_c"), "put_volume": ("put_volume", "p_volume", "volume_p"),
    "call_open_interest": ("call_open_interest", "c_oi", "open_interest_c", "call_oi"), "put_open_interest": ("put_open_interest", "p_oi", "open_interest_p", "put_oi"),
}
NUMBERS = ("strike", "bid", "ask", "volume", "open_interest", "implied_volatility_market", "underlying_price")


def header(name: str) -> str:
    """A column name without brackets and parentheses, in lower case, words joined by underscores."""
    return re.sub("[ -]", "_", re.sub(r"[\[\]()]", "", name.strip().lower()).strip())


def resolved(raw: DataFrame) -> dict[str, str]:
    """Our name -> the vendor's column, the first of NAMES that is there, whatever its spelling (see header)."""
    have = {header(c): c for c in raw.columns}
    return {ours: have[n] for ours, names in NAMES.items() for n in [next((x for x in names if x in have), None)] if n}


def _finished(rows: DataFrame, ticker: str | None) -> DataFrame:
    """Typed columns, mid, T in years and ticker; rows that have expired, or are neither call nor put, go."""
    t = F.lower(F.trim("option_type"))
    out = rows.withColumn("option_type", F.when(t.isin("c", "call"), "call").when(t.isin("p", "put"), "put"))
    out = out.withColumns({c: F.col(c).try_cast("double") for c in NUMBERS if c in rows.columns} | {c: F.to_date(F.col(c)) for c in ("as_of", "expiration")})
    if {"bid", "ask"} <= set(rows.columns):
        out = out.withColumn("mid", (F.col("bid") + F.col("ask")) / 2)
    out = out.withColumn("T", F.datediff("expiration", "as_of") / F.lit(365.0))
    if ticker is not None:
        out = out.withColumn("ticker", F.lit(ticker))
    return out.where((F.col("T") > 0) & F.col("option_type").isNotNull())


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def normalised(raw: DataFrame, ticker: str | None = "SPY", keep: tuple[str, ...] = ()) -> DataFrame:
    """A wide table (a call and a put in each row) or a long one as a chain; rows without a positive volatility go.

    Raises if date, expiration or strike has no column, or if the table is neither wide nor long. keep: columns to keep.
    """
    at = resolved(raw)
    if missing := {"as_of", "expiration", "strike"} - at.keys():
        raise ValueError(f"no columns for {sorted(missing)} in {raw.columns}")
    base = [_q(at[c]).alias(c) for c in ("as_of", "expiration", "strike", "underlying_price") if c in at] + [_q(c) for c in keep]
    if "call_iv" in at or "put_iv" in at:
        fields = [f for f in ("iv", "bid", "ask", "volume", "open_interest") if f"call_{f}" in at or f"put_{f}" in at]
        name = {"iv": "implied_volatility_market"}
        side = lambda s: F.struct(F.lit(s).alias("option_type"), *[(_q(at[f"{s}_{f}"]) if f"{s}_{f}" in at else F.lit(None)).cast("double").alias(name.get(f, f)) for f in fields])
        rows = raw.select(*base, F.explode(F.array(side("call"), side("put"))).alias("q")).select("*", "q.*").drop("q")
    elif {"option_type", "implied_volatility"} <= at.keys():
        rest = [_q(at[c]).alias(c) for c in ("option_type", "bid", "ask", "volume", "open_interest") if c in at]
        rows = raw.select(*base, _q(at["implied_volatility"]).alias("implied_volatility_market"), *rest)
    else:
        raise ValueError(f"neither a wide nor a long table: {raw.columns}")
    out = _finished(rows, ticker).where(F.col("implied_volatility_market") > 0)
    return out.withColumn("implied_volatility", F.col("implied_volatility_market"))


#: A vendor's flat JSON records, all values strings.
RECORD = "contractID string, symbol string, expiration string, strike string, type string, bid string, ask string, volume string, open_interest string, date string, implied_volatility string"


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of files of flat {...} objects, whatever encloses them: lists of lists, or an object keyed by date.

    Files are split at closing braces, so a file of any size is read by many tasks; what is no record is left out.
    """
    pieces = spark.read.option("lineSep", "}").text(path)
    text = F.concat(F.regexp_extract("value", r"(?s)(\{[^{]*)$", 1), F.lit("}"))
    return pieces.select(F.from_json(text, RECORD).alias("r")).where("r.expiration is not null and r.date is not null").select("r.*")


def normalise_records(records: DataFrame, spots: DataFrame, ticker: str | None = "SPY", keep: tuple[str, ...] = ()) -> DataFrame:
    """Records with the day's close of spots(date, close) as underlying price; days without one go. spots: a row a day."""
    rows = records.select(
        F.col("date").alias("as_of"), "expiration", "strike", F.col("type").alias("option_type"), F.col("implied_volatility").alias("implied_volatility_market"), "bid", "ask", "volume", "open_interest", *keep
    )
    out = _finished(rows, ticker).join(spots.select(F.col("date").alias("as_of"), F.col("close").cast("double").alias("underlying_price")), "as_of")
    return out.where(F.col("underlying_price").isNotNull()).withColumn("implied_volatility", F.col("implied_volatility_market"))


PAYLOAD = "data struct<symbol: string, current_price: double, close: double, options: array<struct<option: string, bid: double, ask: double, iv: double, open_interest: double, volume: double, last_trade_price: double>>>"


def delayed_quotes(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """payloads(ticker, as_of, JSON text) as a chain: symbols are parsed, volatilities that aren't positive are null.

    A payload without options, or one that is no JSON, gives no rows; the price is the current one, else the close.
    """
    p = payloads.select("ticker", F.col("as_of").cast("date").alias("as_of"), F.from_json(column, PAYLOAD)["data"].alias("d"))
    spot = F.coalesce(F.when(F.col("d.current_price") != 0, F.col("d.current_price")), F.col("d.close"))
    q = p.select("ticker", "as_of", spot.alias("underlying_price"), F.explode("d.options").alias("o"))
    parsed = {n: c for n, c in occ_symbol(F.col("o.option")).items() if n != "root"}
    out = q.select("*", *[c.alias(n) for n, c in parsed.items()], "o.bid", "o.ask", F.col("o.last_trade_price").alias("last_price"), "o.volume", "o.open_interest", F.when(F.col("o.iv") > 0, F.col("o.iv")).alias("implied_volatility_market"))
    return _finished(out.drop("o"), None).withColumn("source", F.lit("cboe"))


def two_sided(chain: DataFrame, keys=("ticker", "as_of")) -> DataFrame:
    """Contracts with a positive bid and ask, per snapshot."""
    return chain.groupBy(*keys).agg(F.count_if((F.col("bid") > 0) & (F.col("ask") > 0)).alias("two_sided"))


# fixed value: below this share of two-sided contracts a chain counts as thin
THIN = 0.6


def better_source(first: DataFrame, second: DataFrame, keys=("ticker", "as_of"), thin: float = THIN) -> DataFrame:
    """Per snapshot the rows of the first source; those of the second where the first has none, or less than `thin` of its
    contracts two-sided, and the second has more two-sided ones. Nulls in the keys match nothing."""
    columns = [c for c in first.columns if c in second.columns]
    size = first.groupBy(*keys).agg(F.count("*").alias("rows"))
    a, b = two_sided(first, keys).join(size, list(keys)).withColumnRenamed("two_sided", "a"), two_sided(second, keys).withColumnRenamed("two_sided", "b")
    healthy = F.coalesce(F.col("a") >= thin * F.col("rows"), F.lit(False))
    pick = a.join(b, list(keys), "full_outer").select(*keys, (~healthy & (F.coalesce("b", F.lit(0)) > F.coalesce("a", F.lit(0)))).alias("_second"))
    both = first.select(*columns, F.lit(False).alias("_own")).unionByName(second.select(*columns, F.lit(True).alias("_own")))
    return both.join(pick, list(keys)).where(F.col("_own") == F.col("_second")).select(*columns)
