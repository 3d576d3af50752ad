"""Names, enumerations and table schemas."""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
INDICATORS = ["open_price", "high_price", "low_price", "close_price", "latest_price"]
TIMEFRAMES = ["day", "week", "month", "year"]
MODELS = ["linear_trend", "holt_smoothing"]
HORIZON = 3
MIN_OBS = 3
TEST_SIZE = 1
RANKABLE = [
    "open_price", "high_price", "low_price", "close_price", "latest_price",
    "price_change", "price_change_pct", "intraday_range", "intraday_range_pct",
    "category_avg_close",
]
# ----------------------------------------------------------------------------

BAR_KEY = ["symbol", "timeframe", "time_index"]
SERIES_KEY = ["symbol", "timeframe", "indicator"]
FEATURES = [
    "price_change", "price_change_pct", "price_trend",
    "intraday_range", "intraday_range_pct", "volatility_level",
    "category_avg_close", "category_count",
]
BRONZE_COLUMNS = ["symbol", "name", "indicator", "timeframe", "time_index", "value", "source"]
SILVER_COLUMNS = ["symbol", "name", "category", "timeframe", "time_index", *INDICATORS, *FEATURES]
FACT_COLUMNS = ["id", "timeframe", "time_index", *INDICATORS, *FEATURES]

_STRING_FEATURES = {"price_trend", "volatility_level"}


def _type_of(column: str) -> T.DataType:
    if column in {"id", "category_count"}:
        return T.LongType()
    if column in {"time_index", "predicted_time"}:
        return T.DateType()
    if column in {*INDICATORS, *FEATURES, "value"} - _STRING_FEATURES - {"category_count"}:
        return T.DoubleType()
    if column in {"predicted_value", "confidence_low", "confidence_high"}:
        return T.DecimalType(18, 4)
    if column in {"ingested_at", "loaded_at", "run_at"}:
        return T.TimestampType()
    return T.StringType()


def struct(columns: list[str], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(c, _type_of(c), c not in required) for c in columns])


LONG_SCHEMA = struct(BRONZE_COLUMNS, required=("indicator", "timeframe", "time_index"))
BRONZE_SCHEMA = struct([*BRONZE_COLUMNS, "ingested_at"])
SILVER_SCHEMA = struct([*SILVER_COLUMNS, "loaded_at"])
DIM_SCHEMA = struct(["id", "symbol", "name", "category"])
FACT_SCHEMA = struct([*FACT_COLUMNS, "loaded_at"])
SERVED_SCHEMA = struct([*FACT_COLUMNS, "loaded_at", "category"])
COUNTS_SCHEMA = T.StructType(
    [T.StructField("place", T.IntegerType()), T.StructField("step", T.StringType()), T.StructField("rows", T.LongType())]
)
PREDICTION_COLUMNS = [
    "id", "timeframe", "indicator", "model_name", "predicted_time",
    "predicted_value", "confidence_low", "confidence_high",
]
PREDICTION_SCHEMA = struct([*PREDICTION_COLUMNS, "fit_scope", "run_at"])

# Columns the not-null check looks at, per layer.
NOT_NULL = {
    "bronze": ["symbol", "indicator", "timeframe", "time_index"],
    "silver": ["symbol", "timeframe", "time_index"],
    "dim": ["id", "symbol"],
    "fact": ["id", "timeframe", "time_index"],
    "predictions": ["id", "timeframe", "indicator", "model_name", "predicted_time"],
}
