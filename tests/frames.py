"""Small frames for tests."""

from datetime import date, datetime


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows(df, *columns):
    """Rows as plain tuples in a fixed order; NULLs first."""
    found = [tuple(row) for row in df.select(*columns).collect()]
    return sorted(found, key=lambda row: [(v is not None, str(v)) for v in row])


def day(text):
    return date.fromisoformat(text)


def time(text):
    return datetime.fromisoformat(text)
