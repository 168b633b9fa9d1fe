"""Rows of Spark and DuckDB in one form."""

import datetime
import math

import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "None"
    if isinstance(value, float):
        return repr(round(value, 9))
    if isinstance(value, datetime.datetime):
        return str(pd.Timestamp(value).tz_localize(None))
    return str(value)


def rows_of(tuples):
    return sorted(tuple(map(plain, row)) for row in tuples)
