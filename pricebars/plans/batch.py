"""The whole batch job on landed payloads, for ``spark-submit``.

    spark-submit pricebars/plans/batch.py --landing DIR --out DIR --today 2024-01-31 [--years 5] [--symbols A,B] [--invent-history]

``DIR/candles``, ``DIR/quotes`` and ``DIR/profiles`` hold Parquet tables ``symbol, payload[, landed_at]``; a
missing one counts as empty, and the newest payload of a symbol counts.  Symbols without usable candles take their quote; ``--invent-history`` adds
prices cast back from it, which the bronze layer marks as ``backcast``.
"""

import argparse
import sys
from datetime import date, datetime, time
from pathlib import Path

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from pricebars.functions.text import symbol_list  # noqa: E402
from pricebars.operators import backcast, bars, reshape, series  # noqa: E402
from pricebars.plans.warehouse import Warehouse, export, load, predict  # noqa: E402
from pricebars.schema import BRONZE_COLUMNS, TIMEFRAMES  # noqa: E402
from pricebars.sources import payloads, store, tables  # noqa: E402

PAYLOADS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("landed_at", T.TimestampType()),
    ]
)


def sources(
    spark: SparkSession, landing: str, today: date, years: int, symbols: str | None, invent_history: bool = False
):
    """Long rows of candles and of quotes without candles, and the profiles of all symbols.

    Symbols count in upper case, however they landed.  With ``invent_history`` quotes are cast back over the years.
    """
    def landed(name: str) -> DataFrame:
        rows = tables.read_or_empty(spark, f"{landing}/{name}", PAYLOADS).withColumn("symbol", F.upper("symbol"))
        wanted = rows.filter(F.col("symbol").isin(symbol_list(symbols))) if symbols else rows
        return payloads.newest_payloads(wanted)

    candles, quotes = landed("candles"), landed("quotes")
    profiles = store.materialise(
        payloads.resolve_profile(
            candles.select("symbol").unionByName(quotes.select("symbol")), landed("profiles"), payloads.default_profiles(spark)
        ),
        "profiles",
    )
    daily = store.materialise(
        series.in_history(payloads.explode_candles(candles), today, years, "ts"), "candles"
    )
    history = bars.roll_up(bars.candle_bars(daily), TIMEFRAMES)
    quoted = payloads.quote_snapshot(quotes.join(profiles.select("symbol", "name"), "symbol"), F.lit(today))
    alone = backcast.symbols_without_history(quoted, daily)
    projected = backcast.backcast(alone, today, years) if invent_history else alone.withColumn("source", F.lit("quote"))
    from_candles = (
        reshape.to_long(history.join(profiles.select("symbol", "name"), "symbol"))
        .withColumn("source", F.lit("candles")).select(*BRONZE_COLUMNS)
    )
    return [from_candles, reshape.to_long(projected).select(*BRONZE_COLUMNS)], profiles


def run(
    spark: SparkSession, landing: str, out: str, today: date, years: int = 5, symbols: str | None = None,
    invent_history: bool = False,
) -> Warehouse:
    at = datetime.combine(today, time())
    built = Warehouse(spark, out)
    rows, profiles = sources(spark, landing, today, years, symbols, invent_history)
    # A stored price beats a projected one if a symbol ever has both.
    with built.change() as new:
        load(new, rows, profiles, at, priority={"candles": 2, "quote": 1})
        predict(new, at)
    export(built, f"{out}/export")
    return built


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--landing", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--today", required=True, type=date.fromisoformat)
    parser.add_argument("--years", type=int, default=5, choices=range(1, 21), metavar="1..20")
    parser.add_argument("--symbols")
    parser.add_argument("--invent-history", action="store_true", help="cast quotes without candles back over the years")
    options = parser.parse_args()
    spark = SparkSession.builder.appName("pricebars").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run(spark, options.landing, options.out, options.today, options.years, options.symbols, options.invent_history)
    spark.stop()


if __name__ == "__main__":
    main()
