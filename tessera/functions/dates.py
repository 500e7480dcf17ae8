"""Date expressions: ISO text to dates, the current year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._column import as_column as _col


def current_year() -> Column:
    """``datetime.now().year`` (session time zone)."""
    return F.year(F.current_date())


def iso_date(c) -> Column:
    """ISO ``yyyy-MM-dd`` text to a date; text that is not a date gives NULL."""
    return F.try_to_date(_col(c), "yyyy-MM-dd")


def date_text(c) -> Column:
    """A date or timestamp as ISO ``yyyy-MM-dd`` text."""
    return F.date_format(_col(c), "yyyy-MM-dd")
