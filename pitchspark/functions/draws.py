"""Retry-stable numbers for the split order.

``rand()`` changes when a lost task is recomputed; a hash of
``seed|run|key`` does not, and DuckDB computes the same number:
``('0x' || substr(md5(s), 1, 8))::bigint / 4294967296.0``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uniform(*parts) -> Column:
    """A number in [0, 1) from the md5 of the parts joined with ``|``."""
    s = F.concat_ws("|", *[_col(p).cast("string") if not isinstance(p, (int, float)) else F.lit(str(p))
                           for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)
