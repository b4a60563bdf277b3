"""Money text and numeric coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the money format: the currency sign is removed before
# parsing; suffix "m" means millions, suffix "k" thousands, anything else 0.
CURRENCY_SIGN = "€"
MILLION_SUFFIX = "m"
THOUSAND_SUFFIX = "k"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing white space, Unicode blanks and U+001C-U+001F included."""
    return F.regexp_replace(_col(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def money_millions(col: str | Column) -> Column:
    """Parse ``'€75.5m'`` / ``'€500k'`` / ``'-'`` to millions.

    null or ``-`` -> 0; the currency sign is removed and the text stripped;
    a text containing ``m`` (case-sensitive) is read without its ``m``s; else
    one containing ``k`` is read without its ``k``s and divided by 1000; any
    other text (``€500``, ``€1.20bn``) is 0. A number that does not parse
    yields null, so callers can quarantine the row instead of failing.
    """
    c = _col(col)
    body = strip_ws(F.replace(c, F.lit(CURRENCY_SIGN), F.lit("")))
    parsed = (
        F.when(body.contains(MILLION_SUFFIX),
               F.replace(body, F.lit(MILLION_SUFFIX), F.lit("")).try_cast("double"))
        .when(body.contains(THOUSAND_SUFFIX),
              F.replace(body, F.lit(THOUSAND_SUFFIX), F.lit("")).try_cast("double") / 1000.0)
        .otherwise(F.lit(0.0))
    )
    return F.when(c.isNull() | (c == F.lit("-")), F.lit(0.0)).otherwise(parsed)


def numeric_or_zero(col: str | Column) -> Column:
    """``to_numeric(errors='coerce').fillna(0)`` (P6): unparsable or null -> 0."""
    return F.coalesce(_col(col).cast("string").try_cast("double"), F.lit(0.0))


def exact_money(col: str | Column) -> Column:
    """Money as DECIMAL(24,6) so sums do not depend on row order."""
    return _col(col).cast("decimal(24,6)")
