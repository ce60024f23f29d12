"""Vector functions over array columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_float32(vector: Column) -> Column:
    return vector.cast("array<float>")


def settle(distance: Column) -> Column:
    """Distance on the grid hits are ranked on: nine decimals, halves up."""
    scaled = distance * F.lit(1e9) + F.lit(0.5)
    # from 2^53 on a double is a whole number, and its remainder need not exist
    whole = F.when(scaled < F.lit(2.0**53), scaled - F.pmod(scaled, F.lit(1.0))).otherwise(scaled)
    return whole / F.lit(1e9)


def squared_l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance, summed in double."""
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)


def finite(vector: Column) -> Column:
    """True if no element is NULL, NaN or infinite, never NULL."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(whole, F.lit(False))


def usable(vector: Column, dim: int) -> Column:
    """True for a finite vector of the given width, never NULL."""
    return F.coalesce(F.size(vector) == dim, F.lit(False)) & finite(vector)
