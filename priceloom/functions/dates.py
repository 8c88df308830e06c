"""Date parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from priceloom.functions.numerics import ColumnOrName, col

# Accepted text layouts of a sales date (ISO first, then US);
# months and days may have one digit, and an ISO date a time behind it.
ISO_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?\s*$"
US_DATE = "M/d/yyyy"
DAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def parse_iso_date(c: ColumnOrName) -> Column:
    """``YYYY-MM-DD`` text, with or without a time -> DATE; anything else -> NULL."""
    text = col(c).cast("string")
    return F.when(text.rlike(ISO_DATE), F.trim(text).try_cast("date"))


def parse_mixed_date(c: ColumnOrName, extra_formats: tuple[str, ...] = ()) -> Column:
    """ISO (see above) or ``MM/DD/YYYY`` text -> DATE; unparseable -> NULL.

    A column that is already DATE / TIMESTAMP passes through.
    """
    parts = [parse_iso_date(c), F.try_to_date(F.trim(col(c).cast("string")), US_DATE)]
    parts += [F.try_to_date(col(c), f) for f in extra_formats]
    return F.coalesce(*parts)


def year_month(c: ColumnOrName) -> Column:
    """``2024-03``, from the numbers for years of four digits: a formatter
    takes the date to a timestamp first."""
    d, month = col(c), F.month(col(c))
    text = F.concat(F.year(d).cast("string"), F.when(month < 10, F.lit("-0")).otherwise(F.lit("-")), month.cast("string"))
    return F.when(F.year(d).between(1000, 9999), text).otherwise(F.date_format(d, "yyyy-MM"))


def day_name(c: ColumnOrName) -> Column:
    """Full English weekday name (``Saturday``); ``dayname`` gives ``Sat``."""
    # guarded: under ANSI mode a missing index reads as the last element
    return F.when(col(c).isNotNull(), F.element_at(F.array(*[F.lit(x) for x in DAYS]), F.dayofweek(col(c))))
