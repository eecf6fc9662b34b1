from datetime import date, timedelta

BAR_SCHEMA = "symbol string, trading_date date, open double, high double, low double, close double, volume double"


def weekdays(n, start=date(2020, 1, 1)):
    out, day = [], start
    while len(out) < n:
        if day.weekday() < 5:
            out.append(day)
        day += timedelta(days=1)
    return out


def bar_rows(symbol, closes, volumes=None, start=date(2020, 1, 1)):
    volumes = volumes or [1000.0] * len(closes)
    return [(symbol, d, float(c), float(c) + 1, float(c) - 1, float(c), v)
            for d, c, v in zip(weekdays(len(closes), start), closes, volumes)]


def rows_by(df, key="symbol"):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}
