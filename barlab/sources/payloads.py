"""Provider payloads held as JSON text, normalized in bulk.

A payload is parsed once, into a VARIANT; what is wanted is read from it by path, and whatever else
it holds stays in it (see `unknown_keys`). A payload that is no JSON has no rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _at(value: Column, path: str, kind: str) -> Column:
    """The value at a path, null where there is none or it is of another kind."""
    return F.try_variant_get(value, path, kind)


def _text(value: Column, path: str = "$") -> Column:
    return _at(value, path, "string")


def _fields(value: Column) -> Column:
    """An object as a map of its keys, null for anything else."""
    return _at(value, "$", "map<string,variant>")


def _number(text: Column) -> Column:
    return text.try_cast("double")


def _count(text: Column) -> Column:
    """A whole number; a JSON number such as 75.0 is one too."""
    number = text.try_cast("double")
    return F.coalesce(text.try_cast("bigint"), F.when(F.abs(number) < 1e18, number.cast("bigint")))


def parsed(payloads: DataFrame) -> DataFrame:
    """The payload column as a VARIANT, null where it is no JSON."""
    return payloads.withColumn("payload", F.try_parse_json("payload"))


def unknown_keys(payloads: DataFrame, path: str, known: list[str]) -> DataFrame:
    """Keys that the objects at a path hold beside the known ones, with how many hold them: what a
    provider has added. The path leads to an object or to an array of objects."""
    found = F.coalesce(_at(F.col("payload"), path, "array<variant>"), F.array(_at(F.col("payload"), path, "variant")))
    keys = parsed(payloads).select(F.explode(found).alias("o")).select(F.explode(F.map_keys(_fields(F.col("o")))).alias("key"))
    return keys.filter(~F.col("key").isin(known)).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def candles(payloads: DataFrame) -> DataFrame:
    """Arrays [time, o, h, l, c, v, oi] as typed rows, oldest first inside a payload, bad
    times last. A bad number or time becomes null; a malformed row stays, also one that is no
    array or null (SRC9).

    payloads: symbol, payload.
    """
    listed = _at(F.col("payload"), "$.data.candles", "array<variant>")
    names = ("open", "high", "low", "close", "volume", "open_interest")
    typed = F.transform(listed, lambda r, i: F.struct(
        F.try_to_timestamp(_text(r, "$[0]")).isNull().alias("late"), F.try_to_timestamp(_text(r, "$[0]")).alias("timestamp"),
        i.alias("listed"), _text(r, "$[0]").alias("raw_time"), *[_number(_text(r, f"$[{k}]")).alias(n) for k, n in enumerate(names, 1)]))
    return parsed(payloads).select("symbol", F.posexplode(F.array_sort(typed)).alias("place", "c")) \
        .select("symbol", "place", "c.raw_time", "c.timestamp", *[f"c.{n}" for n in names])


def bars_of(rows: DataFrame) -> DataFrame:
    """Candles as bars: the date as the provider wrote it, non-numeric values null (SRC10)."""
    day = F.when(F.col("timestamp").isNotNull(), F.to_date(F.substring("raw_time", 1, 10)))
    return rows.select("symbol", F.col("place").alias("arrival"), day.alias("trading_date"),
                       "open", "high", "low", "close", "volume")


def instruments(payloads: DataFrame, exchange: str | None = None) -> DataFrame:
    """Instrument rows; those lacking exchange or trading symbol are skipped, an empty token
    falls back to the key (SRC11)."""
    rows = parsed(payloads).select(F.explode(_at(F.col("payload"), "$.data", "array<variant>")).alias("o")).select(_fields(F.col("o")).alias("i"))
    get = lambda k: _text(F.try_element_at("i", F.lit(k)))
    rows = rows.filter(F.map_contains_key("i", "exchange") & F.map_contains_key("i", "tradingsymbol"))
    if exchange:
        rows = rows.filter(get("exchange") == exchange)
    return rows.select(
        F.concat(get("exchange"), F.lit(":"), get("tradingsymbol")).alias("symbol"), F.coalesce(get("name"), F.lit("")).alias("name"),
        get("exchange").alias("exchange"), F.coalesce(get("instrument_type"), F.lit("")).alias("instrument_type"),
        F.coalesce(_count(get("lot_size")), F.lit(0).cast("bigint")).alias("lot_size"),
        F.coalesce(_number(get("tick_size")), F.lit(0.0)).alias("tick_size"),
        F.coalesce(F.nullif(get("instrument_token"), F.lit("")), get("instrument_key"), F.lit("")).alias("instrument_token"),
        get("isin").alias("isin"))


QUOTE_NUMBERS = {"last_price": "ltp", "high": "high", "low": "low", "open": "open", "close": "close",
                 "bid_price": "bid_price", "ask_price": "ask_price"}
QUOTE_COUNTS = ("volume", "bid_quantity", "ask_quantity")


def quotes(payloads: DataFrame) -> DataFrame:
    """Quotes keyed by symbol; an absent number is 0 and an absent time null. A row with a
    number or a time that does not parse is dropped (SRC12)."""
    rows = parsed(payloads).select(F.explode(_at(F.col("payload"), "$.data", "map<string,variant>")).alias("symbol", "o"))
    rows = rows.select("symbol", _fields(F.col("o")).alias("q")).filter("q is not null")
    absent = lambda key: ~F.map_contains_key("q", key)
    value = lambda key: _text(F.try_element_at("q", F.lit(key)))
    number = lambda key: F.when(absent(key), F.lit(0.0)).otherwise(_number(value(key)))
    count = lambda key: F.when(absent(key), F.lit(0).cast("bigint")).otherwise(_count(value(key)))
    at = F.try_to_timestamp(value("timestamp"))
    typed = rows.filter(absent("timestamp") | at.isNotNull()).select(
        "symbol", *[number(key).alias(name) for name, key in QUOTE_NUMBERS.items()], *[count(key).alias(key) for key in QUOTE_COUNTS], at.alias("timestamp"))
    return typed.dropna(subset=[*QUOTE_NUMBERS, *QUOTE_COUNTS])


def option_chain(payloads: DataFrame) -> DataFrame:
    """One row per strike with its call and put keys; strikes or expiries that do not parse
    are skipped (SRC13). payloads: underlying, payload."""
    payload = F.col("payload")
    rows = parsed(payloads).select("underlying", _text(payload, "$.data.expiry").alias("e"), F.explode(_at(payload, "$.data.strikes", "map<string,variant>")).alias("s", "legs"))
    return (rows.withColumn("strike_price", _number(F.col("s")))
            .withColumn("expiry", F.to_date(F.try_to_timestamp("e", F.lit("yyyy-MM-dd"))))
            .filter(F.col("strike_price").isNotNull() & (F.col("expiry").isNotNull() | (F.coalesce("e", F.lit("")) == "")))
            .select("underlying", "strike_price", "expiry", _text(F.col("legs"), "$.CE.instrument_key").alias("ce_key"),
                    _text(F.col("legs"), "$.PE.instrument_key").alias("pe_key")))
