"""Safe parsers: text that does not match the accepted form becomes NULL, never an error.

Patterns end in ``\\z`` because Java's ``$`` also matches before a final newline.
Casts are ``try_cast`` because the optimizer may evaluate them on rows a filter
would have removed, and ANSI casts raise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms.
INTEGER = r"^-?[0-9]+\z"
DECIMAL = r"^-?[0-9]+(\.[0-9]+)?\z"
ORDER_TIMESTAMP = (
    r"^(19|20)[0-9]{2}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])"
    r" ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z"
)
FLOAT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"


def parse_int(c: Column) -> Column:
    text = F.trim(c)
    return F.when(text.rlike(INTEGER), text.try_cast("int"))


def parse_amount(c: Column) -> Column:
    """Money rounded to cents, half away from zero, in one rounding step."""
    text = F.trim(c)
    return F.when(text.rlike(DECIMAL), text.try_cast("decimal(14,2)"))


def parse_order_ts(c: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` in years 1900-2099; impossible dates are NULL."""
    text = F.trim(c)
    return F.when(text.rlike(ORDER_TIMESTAMP), text.try_cast("timestamp_ntz"))


def parse_float(c: Column) -> Column:
    """Lenient number for profiling: also accepts ``1e5``, ``.5`` and ``+3``."""
    return F.when(c.rlike(FLOAT), F.trim(c).try_cast("double"))
