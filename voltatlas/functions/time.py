"""Time filters written so that the bare column reaches the scan."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month labels.
MONTH_LABELS = ("01-Jan", "02-Feb", "03-Mar", "04-Apr", "05-May", "06-Jun",
                "07-Jul", "08-Aug", "09-Sep", "10-Oct", "11-Nov", "12-Dec")


def timestamp(value: datetime) -> Column:
    """Literal without a zone, independent of the zone of the Python process."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def since_year(column: Column, year: int) -> Column:
    """``year(column) >= year`` as a range on the column, so file statistics can prune."""
    return column >= timestamp(datetime(year, 1, 1))


#: Column of a table kept in folders by the month of its time.
MONTH_OF = "time_month"


def rows_since(table: DataFrame, year: int, column: str = "time") -> DataFrame:
    """Rows of a year and later; of a table kept by month, only the folders of these months are read."""
    rows = table.where(since_year(F.col(column), year))
    return rows.where(F.col(MONTH_OF) >= F.lit(f"{year}-01-01").cast("date")) if MONTH_OF in table.columns else rows


def before(as_of: datetime, **back: float) -> Column:
    """Literal ``as_of`` minus an interval, folded on the driver."""
    return timestamp(as_of - timedelta(**back))


def month_label(month: Column) -> Column:
    """Sortable label of a month number; NULL for anything but 1 to 12."""
    return F.get(F.array(*[F.lit(label) for label in MONTH_LABELS]), month - 1)
