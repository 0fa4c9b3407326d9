"""Column rules for dirty commerce text: missing values, flags, dates, statuses."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts that stand for "missing" after trimming blanks and folding case.
SENTINELS = ["\n", "?", "", "null", "na", "n/a"]

# The null mark that counts anywhere inside a value.
NULL_MARK = "\\N"

# Accepted date patterns, in the order in which they are tried.
DATE_PATTERNS = ["MM/dd/yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "MM-dd-yyyy", "dd-MM-yyyy"]

# Raw order statuses (English, Spanish, German, Hindi, Chinese) by standard status.
STATUS_WORDS = {
    "completed": ["completed", "completado", "abgeschlossen", "पूर्ण", "已完成"],
    "pending": ["pending", "pendiente", "ausstehend", "लंबित", "待处理"],
    "cancelled": ["cancelled", "cancelado", "storniert", "रद्द", "已取消"],
    "shipped": ["shipped", "versandt", "enviado", "भेज दिया", "已发货"],
}


def is_missing(name: str, null_mark: bool = False) -> Column:
    """True where the value is null, a sentinel, or (if asked) holds the null mark."""
    value = F.col(name)
    test = value.isNull() | F.lower(F.trim(value)).isin(SENTINELS)
    return test | value.contains(NULL_MARK) if null_mark else test


def keep_present(name: str, null_mark: bool = False) -> Column:
    """The value as it stands (blanks and case kept), or null where it is missing."""
    return F.when(~is_missing(name, null_mark), F.col(name)).alias(name)


def any_missing(checks: Mapping[str, bool]) -> Column:
    """True where any of the checked columns is missing; values tell whether the null mark counts."""
    return reduce(or_, (is_missing(name, mark) for name, mark in checks.items()))


def validity_flag(checks: Mapping[str, bool]) -> Column:
    """1 where every checked raw value is present, else 0."""
    return F.when(any_missing(checks), 0).otherwise(1)


def null_sentinels(df: DataFrame, columns: Iterable[str], null_mark: Iterable[str] = ()) -> DataFrame:
    """Null the missing values of ``columns``; ``null_mark`` lists those where the mark counts."""
    marked = set(null_mark)
    return df.withColumns({name: keep_present(name, name in marked) for name in columns})


def _calendar_date(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", year, month, day).try_cast("date")


def _is_iso(text: Column) -> Column:
    return text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z")


def iso_date(text: Column) -> Column:
    """ISO date text to date, null where it is not one; the plain shape is cast, see ``parse_date``."""
    return F.when(_is_iso(text), text.try_cast("date")).otherwise(F.try_to_date(text, "yyyy-MM-dd"))


def parse_date(text: Column) -> Column:
    """The date read by the first pattern of ``DATE_PATTERNS`` that fits, or null.

    Texts of the two plain ten-character shapes are cut into their fields and cast: a failing cast
    is a null, whereas a failing pattern parse costs a Java exception per pattern and row. Every
    other shape goes through the patterns themselves.
    """
    first, second, last = F.substring(text, 1, 2), F.substring(text, 4, 2), F.substring(text, 7, 4)
    month_first = F.coalesce(_calendar_date(last, first, second), _calendar_date(last, second, first))
    return (
        F.when(text.rlike(r"\A[0-9]{2}([/-])[0-9]{2}\1[0-9]{4}\z"), month_first)
        .when(_is_iso(text), text.try_cast("date"))
        .otherwise(F.coalesce(*[F.try_to_date(text, pattern) for pattern in DATE_PATTERNS]))
    )


def normalise_date(name: str) -> Column:
    """ISO text of the parsed date; text that no pattern fits stays as it is."""
    return F.coalesce(F.date_format(parse_date(F.col(name)), "yyyy-MM-dd"), F.col(name)).alias(name)


def status_map(spark: SparkSession) -> DataFrame:
    """The fixed status table (raw_status, standard_status), twenty rows."""
    rows = ", ".join(f"('{raw}', '{standard}')" for standard, raws in STATUS_WORDS.items() for raw in raws)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(raw_status, standard_status)")
