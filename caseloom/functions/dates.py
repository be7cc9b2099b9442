"""Date helpers shared by the operators."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: day zero of spreadsheet serial dates.
SERIAL_ORIGIN = "1899-12-30"

# Names that contain "date" yet hold no date.
NOT_DATES = r"week|earliestdatetype|detectedatentry"


def as_col(d: dt.date | str | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(str(d)).cast("date")


def to_date(x: Column, dtype: T.DataType) -> Column:
    """Date from a date, timestamp or ISO text; unreadable text gives null."""
    if isinstance(dtype, T.DateType):
        return x
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return x.cast("date")
    return x.cast("string").try_cast("date")


def from_serial(x: Column) -> Column:
    days = F.floor(x.cast("string").try_cast("double")).cast("int")
    return F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), days)


def flat_dates(df: DataFrame) -> DataFrame:
    """Turn every ``*Date*`` column that holds serial text, a logical or a timestamp into a date.

    The name match is case-sensitive; the schema alone decides, no data is read.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if "Date" in f.name:
            if isinstance(f.dataType, T.StringType):
                c = from_serial(c)
            elif isinstance(f.dataType, T.BooleanType):
                c = from_serial(c.cast("int"))
            elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
                c = c.cast("date")
        out.append(c.alias(f.name))
    return df.select(*out)


def parse_dates(df: DataFrame) -> DataFrame:
    """Dates from the ISO text of columns named like dates, for sources that deliver text only."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        named = "date" in f.name.lower() and not re.search(NOT_DATES, f.name, re.IGNORECASE)
        if named and isinstance(f.dataType, T.StringType):
            c = to_date(c, f.dataType)
        out.append(c.alias(f.name))
    return df.select(*out)


def week_of_year(d: Column) -> Column:
    """Week counted in whole sevens from 1 January (not the ISO week)."""
    return (F.floor((F.dayofyear(d) - 1) / 7) + 1).cast("int")


def date_columns(df: DataFrame) -> list[str]:
    """Date-typed columns whose name contains ``date``."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.DateType) and "date" in f.name.lower()
    ]
