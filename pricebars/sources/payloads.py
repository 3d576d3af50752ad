"""JSON payloads landed by a market-data collector: candles, quotes and profiles."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebars.functions.numeric import clean_double, zero_as_null
from pricebars.functions.reference_data import DEFAULT_PROFILES, PROFILE_CATEGORY

# Field names and formats of the landed payloads.
# Prices are read as text first: one bad number must become one NULL, not a rejected payload.
_CANDLE = "s STRING, t ARRAY<STRING>, o ARRAY<STRING>, h ARRAY<STRING>, l ARRAY<STRING>, c ARRAY<STRING>"
_QUOTE = "c STRING, o STRING, h STRING, l STRING, pc STRING"
SECONDS = (-2208988800, 7258118400)
_PROFILE = "MAP<STRING, STRING>"  # vendors prefix the industry field with their name


def newest_payloads(landed: DataFrame) -> DataFrame:
    """``symbol, landed_at, payload`` -> the newest payload of each symbol.

    Reduced on the map side: a symbol that has landed many times sends one payload per split.
    """
    newest = F.max(F.struct("landed_at", "payload")).alias("n")
    return landed.groupBy("symbol").agg(newest).select("symbol", "n.payload")


def explode_candles(payloads: DataFrame) -> DataFrame:
    """``symbol, payload`` -> one row per candle with a close; ``seq`` orders the candles of a date.

    A payload counts only when its status is ``ok`` and all five arrays are there; the shortest array
    decides how many candles it has.  A candle whose time is no second between 1900 and 2200 is left out.
    """
    arrays = ["t", "o", "h", "l", "c"]
    candles = payloads.select("symbol", F.from_json("payload", _CANDLE).alias("p")).select("symbol", "p.*")
    complete = F.col("s") == "ok"
    for name in arrays:
        complete = complete & F.col(name).isNotNull()
    usable = F.least(*[F.size(name) for name in arrays])
    return (
        candles.filter(complete)
        .select("symbol", F.posexplode(F.slice(F.arrays_zip(*arrays), F.lit(1), usable)).alias("place", "k"))
        .withColumn("second", clean_double(F.col("k.t")))
        .filter(F.col("second").between(*SECONDS))
        .select(
            "symbol",
            F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("second") / 86400).cast("int")).alias("ts"),
            # seconds of the day first, then the place in the payload, in one number
            (F.floor(F.pmod("second", F.lit(86400.0))).cast("long") * F.lit(1 << 32) + F.col("place")).alias("seq"),
            clean_double(F.col("k.o")).alias("open"),
            clean_double(F.col("k.h")).alias("high"),
            clean_double(F.col("k.l")).alias("low"),
            clean_double(F.col("k.c")).alias("close"),
        )
        .filter(F.col("close").isNotNull() & F.col("ts").isNotNull())
    )


def pack_candles(day_bars: DataFrame) -> DataFrame:
    """Day bars -> one candle payload per symbol, as a collector would land it.

    One bar per symbol and date, so an array is as long as the calendar at most.
    """
    bar = F.struct("time_index", "open_price", "high_price", "low_price", "close_price")
    bars = day_bars.groupBy("symbol").agg(F.sort_array(F.collect_list(bar)).alias("b"))

    def column(field: str) -> Column:
        return F.transform("b", lambda x: x[field])

    return bars.select(
        "symbol",
        F.to_json(
            F.struct(
                F.lit("ok").alias("s"),
                F.transform("b", lambda x: F.unix_date(x["time_index"]).cast("long") * 86400).alias("t"),
                column("open_price").alias("o"),
                column("high_price").alias("h"),
                column("low_price").alias("l"),
                column("close_price").alias("c"),
            )
        ).alias("payload"),
    )


def quote_snapshot(quotes: DataFrame, today: Column) -> DataFrame:
    """``symbol, name, payload`` -> one day bar per quote that has a price.

    A previous close that is missing or 0 gives way to the current price.
    """
    q = quotes.select("symbol", "name", F.from_json("payload", _QUOTE).alias("q"))
    current = clean_double(F.col("q.c"))
    return q.filter(zero_as_null(current).isNotNull()).select(
        "symbol",
        F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("symbol")).alias("name"),
        F.lit("day").alias("timeframe"),
        today.alias("time_index"),
        clean_double(F.col("q.o")).alias("open_price"),
        clean_double(F.col("q.h")).alias("high_price"),
        clean_double(F.col("q.l")).alias("low_price"),
        F.coalesce(zero_as_null(clean_double(F.col("q.pc"))), current).alias("close_price"),
        current.alias("latest_price"),
    )


def default_profiles(spark) -> DataFrame:
    rows = [(symbol, name, category) for symbol, (name, category) in DEFAULT_PROFILES.items()]
    return spark.createDataFrame(rows, "symbol STRING, name STRING, category STRING")


def resolve_profile(symbols: DataFrame, payloads: DataFrame, defaults: DataFrame) -> DataFrame:
    """Name and category per symbol: from the profile payload, else the defaults, else the symbol itself.

    Empty text counts as missing.  ``payloads`` and ``defaults`` hold one row per symbol.
    """
    profile = payloads.select("symbol", F.from_json("payload", _PROFILE).alias("p"))
    known = defaults.select("symbol", F.col("name").alias("d_name"), F.col("category").alias("d_category"))

    def text(column: Column) -> Column:
        return F.nullif(column, F.lit(""))

    def field(name: str) -> Column:
        return text(F.try_element_at("p", F.lit(name)))

    industries = F.map_values(F.map_filter("p", lambda k, v: F.lower(k).endswith("industry") & (v != "")))
    return (
        symbols.select("symbol").distinct()
        .join(profile, "symbol", "left")
        .join(known, "symbol", "left")
        .select(
            "symbol",
            F.coalesce(field("name"), field("ticker"), text(F.col("d_name")), F.col("symbol")).alias("name"),
            F.coalesce(
                F.get(industries, F.lit(0)), field("exchange"), text(F.col("d_category")), F.lit(PROFILE_CATEGORY)
            ).alias("category"),
        )
    )
