"""Exact decimal arithmetic for scores and rates.

Scores are rounded HALF_UP at 1-3 decimals. Rounding a DOUBLE is only as
good as its binary approximation (``round(1.005, 2)``), and averaging doubles
depends on the order rows arrive in. All score arithmetic therefore runs on
DECIMAL values (exact, JVM-side, inside whole-stage codegen) and is cast to
DOUBLE only when a result column is produced.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 20 integer digits and 18 fractional digits: the quotient of two counts is
# exact far beyond the 3 decimals any score keeps, so HALF_UP rounding of the
# quotient never lands on the wrong side of a tie.
WIDE = "decimal(38,18)"


def dec(value: str | int) -> Column:
    """A DECIMAL literal (``dec("0.25")``), exact unlike a DOUBLE literal."""
    from decimal import Decimal

    return F.lit(Decimal(str(value)))


def quotient(num: Column, den: Column) -> Column:
    """num / den as a wide DECIMAL; NULL when den is 0 or NULL."""
    return num.cast(WIDE) / F.nullif(den, F.lit(0)).cast("decimal(38,0)")


def exact_avg(col: Column) -> Column:
    """AVG of an integer or decimal column without float rounding (aggregate)."""
    return quotient(F.sum(col.cast(WIDE)), F.count(col))
