"""Which embedded chunks enter the index."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from wellspring.functions.vectors import finite


def present(width: Column, text: Column) -> Column:
    """A vector and a text are there; whitespace counts as text. Never NULL."""
    return F.coalesce((width > 0) & (text != ""), F.lit(False))


def indexable(width: Column, text: Column, dim: int) -> Column:
    """Rows the index takes. Plain comparisons, so a Parquet scan can skip on them."""
    return (width == dim) & (text != "")


def misfit(width: Column, text: Column, dim: int) -> Column:
    """Rows with a vector of the wrong width; they are set aside, not dropped."""
    return present(width, text) & (width != dim)


def verdict(width: Column, text: Column, dim: int, vector: Column | None = None) -> Column:
    """``missing`` (dropped), ``width`` or ``value`` (set aside) or ``indexed``. Elements of
    ``vector``, where it is given, must be finite numbers."""
    sound = F.lit(True) if vector is None else finite(vector)
    return (
        F.when(misfit(width, text, dim), "width")
        .when(present(width, text) & sound, "indexed")
        .when(present(width, text), "value")
        .otherwise("missing")
    )
