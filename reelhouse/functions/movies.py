"""Title and genre expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelhouse import fixed_values as fixed


def release_year(title: Column) -> Column:
    """Year in brackets that ends the title; NULL when there is none."""
    return F.regexp_extract(title, fixed.RELEASE_YEAR_PATTERN, 1).try_cast("int")


def clean_title(title: Column) -> Column:
    """Title without its year; empty (not NULL) when it carries no year."""
    return F.regexp_extract(title, fixed.CLEAN_TITLE_PATTERN, 1)


def decade_of(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def genre_list(genres: Column) -> Column:
    return F.split(genres, re.escape(fixed.GENRE_SEPARATOR))


def is_recent(year: Column) -> Column:
    return year > fixed.RECENT_AFTER_YEAR
