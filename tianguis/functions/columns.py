"""Column expressions shared by the plans; all of them stay inside code generation."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character that counts as white space when text is trimmed.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

RATIO_OPERAND = T.DecimalType(29, 9)  # (29,9)/(29,9) is the only split that yields (38,9)


def strip(c: Column) -> Column:
    """Trim all white space; Spark's own ``trim`` removes blanks only."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def ratio(a: Column, b: Column) -> Column:
    """Exact ``a / b`` with nine decimals, rounded half up; NULL when ``b`` is zero or NULL."""
    return F.try_divide(a.cast(RATIO_OPERAND), b.cast(RATIO_OPERAND))


def month(c: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(c, "MM")


def day(d: date) -> Column:
    return F.lit(d)


def utc(at: datetime, to: T.DataType | None = None) -> Column:
    """A moment as a timestamp (or, for ``to`` without zone, its UTC clock). A naive time is UTC."""
    if at.tzinfo is not None:
        at = at.astimezone(timezone.utc).replace(tzinfo=None)
    clock = at.isoformat(sep=" ")
    if isinstance(to, T.TimestampNTZType):
        return F.lit(clock).cast("timestamp_ntz")
    return F.lit(clock + "Z").cast("timestamp")


def days_between(later: Column, earlier: Column) -> Column:
    return F.date_diff(later, earlier).cast("bigint")


def months_back(as_of: date, n: int) -> Column:
    """``n`` months before ``as_of``, clamped to the month end; constant-folded, so it prunes partitions."""
    return F.add_months(F.lit(as_of), -n)


def signed(is_positive: Column, amount: Column) -> Column:
    """``amount``, negated unless the test is true. A NULL test counts as not true."""
    return F.when(is_positive, amount).otherwise(-amount)


def only(test: Column, amount: Column) -> Column:
    """``amount`` where the test is true, else zero."""
    return F.when(test, amount).otherwise(F.lit(0))


# Document types (sales F invoice, D return; purchases C receipt, D return)
# and the status of a cancelled document.
def is_invoice() -> Column:
    return F.col("TIPO_DOCTO") == "F"


def is_return() -> Column:
    return F.col("TIPO_DOCTO") == "D"


def is_receipt() -> Column:
    return F.col("TIPO_DOCTO") == "C"


def not_cancelled() -> Column:
    """A NULL status is not kept either."""
    return F.col("ESTATUS") != "C"
