"""History for symbols that only have a quote: prices decayed back from it at a rate set by the symbol."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricebars.functions.periods import period_start, project_date
from pricebars.functions.reference_data import BACKCAST, BACKCAST_FLOOR
from pricebars.schema import INDICATORS


def symbols_without_history(quotes: DataFrame, bars: DataFrame) -> DataFrame:
    """Quotes of symbols that have no bar.  The bars are reduced to distinct symbols before the join."""
    return quotes.join(bars.select("symbol").distinct(), "symbol", "left_anti")


def symbol_seed(symbol: Column) -> Column:
    """Sum of the character codes."""
    codes = F.transform(F.split(symbol, ""), F.ascii)
    return F.aggregate(codes, F.lit(0), lambda total, code: total + code)


def backcast(quotes: DataFrame, today: date, years: int = 5) -> DataFrame:
    """Quote bars -> back-cast bars of all timeframes plus the quote's own day bar."""
    plan = F.array(
        *[
            F.struct(
                F.lit(timeframe).alias("timeframe"),
                F.lit(periods or years).alias("periods"),
                *[F.lit(v).alias(k) for k, v in zip(("step", "a", "b", "high_ratio", "low_ratio"), rest)],
            )
            for timeframe, (periods, *rest) in BACKCAST.items()
        ]
    )
    seed, k = F.col("seed"), F.col("k")
    base = F.coalesce("latest_price", "close_price", "open_price")
    growth = 1 + (seed % 9 - 4) * F.col("p.step")
    day = F.lit(today)
    moved = project_date(F.col("p.timeframe"), day, -k)
    past = (
        quotes.withColumns({"base": base, "seed": symbol_seed(F.col("symbol"))})
        .withColumn("p", F.explode(plan))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("p.periods"))))
        .withColumn("close_price", F.greatest(F.lit(BACKCAST_FLOOR), F.col("base") / F.pow(growth, k)))
        .withColumn("open_price", F.col("close_price") * (F.col("p.a") + (seed % 5) * F.col("p.b")))
        .select(
            "symbol", "name",
            F.col("p.timeframe").alias("timeframe"),
            period_start(F.col("p.timeframe"), moved).alias("time_index"),
            "open_price",
            (F.greatest("open_price", "close_price") * F.col("p.high_ratio")).alias("high_price"),
            (F.least("open_price", "close_price") * F.col("p.low_ratio")).alias("low_price"),
            "close_price",
            F.col("close_price").alias("latest_price"),
            F.concat(F.lit("backcast "), F.col("p.timeframe")).alias("source"),
        )
    )
    own = quotes.select("symbol", "name", "timeframe", "time_index", *INDICATORS, F.lit("quote").alias("source"))
    return past.unionByName(own)
