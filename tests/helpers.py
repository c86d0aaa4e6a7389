from datetime import date


def d(text):
    return date.fromisoformat(text)


def column(df, name, *order):
    """Values of one column in the given order."""
    return [r[name] for r in df.orderBy(*order).collect()]


def series(spark, *points, series_id="S"):
    rows = [(series_id, d(day), value) for day, value in points]
    return spark.createDataFrame(rows, "series_id string, date date, value double")


def closes(spark, symbol, *points):
    rows = [(symbol, d(day), float(v)) for day, v in points]
    return spark.createDataFrame(rows, "symbol string, date date, close double")


def days(spark, *texts):
    return spark.createDataFrame([(d(t),) for t in texts], "date date")


def calendar(spark, start, end):
    from barloom.sources import nyse_holidays, trading_calendar

    span = spark.createDataFrame([(d(start), d(end))], "start date, end date")
    return trading_calendar(span, nyse_holidays(spark, 1990, 2040))
