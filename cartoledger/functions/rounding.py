"""Output rounding for floating-point results.

Sums and means are computed in a data-dependent order, so their last bits are
not stable across engines or partitionings. Results that are compared by value
are rounded to a number of significant digits with exact steps only (a power
of ten that is an exact double, one division or multiplication, one round).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_sig(x, digits: int = 6) -> Column:
    x = x if isinstance(x, Column) else F.col(x)
    k = (F.floor(F.log10(F.abs(x))) - F.lit(digits - 1)).cast("int")
    up = F.pow(F.lit(10.0), k.cast("double"))
    down = F.pow(F.lit(10.0), (-k).cast("double"))
    return (
        F.when(x.isNull() | (x == F.lit(0.0)), x)
        .when(k >= 0, F.round(x / up, 0) * up)
        .otherwise(F.round(x * down, 0) / down)
    )
