from datetime import date, datetime

from pricebars.schema import BAR_KEY, INDICATORS

D = date.fromisoformat
TS = datetime.fromisoformat

BARS = "symbol STRING, timeframe STRING, time_index DATE, " + ", ".join(f"{i} DOUBLE" for i in INDICATORS)
SERIES = "symbol STRING, timeframe STRING, indicator STRING, points ARRAY<STRUCT<time_index: DATE, value: DOUBLE>>"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def bar(symbol, timeframe, day, open_, high, low, close):
    return (symbol, timeframe, D(day), open_, high, low, close, close)


def one(df):
    (row,) = df.collect()
    return row


def by_key(df, *columns):
    return {tuple(r[k] for k in BAR_KEY): tuple(r[c] for c in columns) for r in df.collect()}
