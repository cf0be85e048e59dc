"""Schemas at the boundaries. Inside, prices are integer cents."""

from pyspark.sql import types as T

# The assumed layout of a daily price CSV, and its usual header line. Columns are
# bound by position; readers take another header line as an argument.
CSV_HEADER = "trade_date,open,high,low,close,volume"
CSV_SCHEMA = (
    T.StructType()
    .add("trade_date", "date")
    .add("open", "decimal(22,8)")
    .add("high", "decimal(22,8)")
    .add("low", "decimal(22,8)")
    .add("close", "decimal(22,8)")
    .add("volume", "long")
    .add("_bad", "string")
)
CSV_DDL = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in CSV_SCHEMA)

KEY = ["symbol", "trade_date"]
BAR_VALUES = ["open_c", "high_c", "low_c", "close_c", "volume"]
BAR_COLUMNS = KEY + BAR_VALUES

# One row per (symbol, trade_date). That key is what bounds every per-symbol
# window in this package: a symbol has at most one row per calendar day.
BARS = T.StructType().add("symbol", "string").add("trade_date", "date")
for _name in BAR_VALUES:
    BARS.add(_name, "long")
