"""Schemas of the files that are read."""
from __future__ import annotations

from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def texts(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


UNIVERSE_CSV = texts("Company Name", "Industry", "Symbol", "Series", "ISIN Code")
REVIEW_CSV = texts("symbol", "isin", "event_type", "effective_date", "reason", "reviewer", "review_state")
RESOLUTION_CSV = texts("date", "status", "session_type", "circulars", "note")
INSTRUMENT = texts("segment", "name", "exchange", "isin", "instrument_type", "instrument_key", "trading_symbol", "_corrupt")
HOLIDAY_MASTER = StructType([StructField("CM", ArrayType(texts("tradingDate", "description"))), StructField("_corrupt", StringType())])
