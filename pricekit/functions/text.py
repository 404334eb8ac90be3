"""Text canonicalisation of dates, quarters, cluster paths and amounts.

All helpers return built-in Spark expressions (no Python UDF), so they run
in whole-stage codegen and never leave the JVM. Parsing uses the ``try_``
family: dirty text becomes NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricekit.functions._col import as_col

# Fixed values that must equal the source system's formats.
DAY_MONTH_YEAR = "dd-MMM-yy"       # e.g. 12-Nov-24
ISO_DATE = "yyyy-MM-dd"            # e.g. 2024-11-12
DAY_MONTH_YEAR_SHAPE = "%-___-%"   # LIKE pattern recognising dd-MMM-yy text
PERIOD_PATH_SHAPE = "2___q_"       # LIKE pattern of a period prefix such as 2024q1


def normalise_date_text(c: Column | str) -> Column:
    """``dd-MMM-yy`` text → ``yyyy-MM-dd`` text; any other text unchanged.

    Text of the day-month-year shape that does not parse (``2-Nov-24``)
    becomes NULL. Two-digit years land in 2000-2099 (Spark's ``yy``).
    """
    c = as_col(c)
    parsed = F.date_format(F.try_to_date(c, DAY_MONTH_YEAR), ISO_DATE)
    return F.when(c.like(DAY_MONTH_YEAR_SHAPE), parsed).otherwise(c)


def parse_date_text(c: Column | str) -> Column:
    """Text in ISO form or ``dd-MMM-yy`` → DATE; anything else → NULL."""
    c = as_col(c)
    return F.coalesce(c.try_cast("date"), F.try_to_date(c, DAY_MONTH_YEAR))


def parse_timestamp_text(c: Column | str) -> Column:
    """Text of a timestamp or date, ISO or ``dd-MMM-yy`` → TIMESTAMP; anything else → NULL."""
    c = as_col(c)
    return F.coalesce(c.try_cast("timestamp"), F.try_to_date(c, DAY_MONTH_YEAR).cast("timestamp"))


def to_amount(c: Column | str) -> Column:
    """Amount text (or number) → DOUBLE; unparsable text such as ``n/a`` → NULL."""
    return as_col(c).try_cast("double")


def clean_path(c: Column | str) -> Column:
    """Cluster path canonicalisation.

    ``2024q1,a,b`` → ``a,b`` (period prefix dropped); bare ``2024q1`` → NULL;
    everything else, including upper-case ``Q`` prefixes, unchanged.
    """
    c = as_col(c)
    return (F.when(c.like(PERIOD_PATH_SHAPE + ",%"), _after_first_comma(c))
            .when(c.like(PERIOD_PATH_SHAPE), F.lit(None).cast("string"))
            .otherwise(c))


def _after_first_comma(c: Column) -> Column:
    # substring(c FROM position(',' IN c) + 1)
    return F.substr(c, F.locate(",", c) + F.lit(1))


def normalise_quarter(c: Column | str) -> Column:
    """Fiscal quarter text → canonical ``YYYYQ0n``: ``2024q1`` and ``2024Q1`` → ``2024Q01``."""
    c = as_col(c)
    return F.replace(F.replace(c, F.lit("q"), F.lit("Q")), F.lit("Q"), F.lit("Q0"))
