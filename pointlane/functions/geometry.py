"""Column expressions for boxes, voxels, ranges and sensor cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

AXES = ("x", "y", "z")


def axis_name(axis: str | int) -> str:
    """x, y or z; unknown names mean y, numbers are clipped to 0..2."""
    if isinstance(axis, str):
        return axis.strip().lower() if axis.strip().lower() in AXES else "y"
    return AXES[min(2, max(0, int(axis)))]


def other_axes(axis: str) -> tuple[str, str]:
    """(lateral, vertical): the two other axes in order."""
    a, b = (x for x in AXES if x != axis)
    return a, b


@dataclass(frozen=True)
class Box:
    """An axis-aligned box; bounds of an axis may come in either order."""

    x: tuple[float, float]
    y: tuple[float, float]
    z: tuple[float, float]

    def bounds(self, axis: str) -> tuple[float, float]:
        low, high = getattr(self, axis)
        return min(low, high), max(low, high)

    def holds(self, prefix: str = "") -> Column:
        """Inclusive on all six sides; nine comparisons that reach the Parquet scan."""
        return F.expr(" AND ".join(f"{prefix}{a} BETWEEN {self.bounds(a)[0]} AND {self.bounds(a)[1]}" for a in AXES))


def finite(*cols: str) -> Column:
    out = F.lit(True)
    for c in cols:
        out &= F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) != float("inf"))
    return out


def distance_from_origin() -> Column:
    return F.sqrt(sum((F.col(a).cast("double") * F.col(a).cast("double") for a in AXES), F.lit(0.0)))


def voxel(col: str, size: float, single: bool = False) -> Column:
    """Index of the voxel; ``single`` divides in 32-bit floats, as float32 clouds are keyed."""
    if single:
        return F.floor((F.col(col).cast("float") / F.lit(size).cast("float")).cast("float"))
    return F.floor(F.col(col) / F.lit(size))


def voxels(size: float, single: bool = False) -> list[Column]:
    return [voxel(a, size, single).alias(f"v{a}") for a in AXES]


def radians_if_degrees(angle: Column) -> Column:
    """Angles beyond pi are taken for degrees."""
    return F.when(F.abs(angle) > F.lit(3.141592653589793), F.radians(angle)).otherwise(angle)


def range_corrected(signal: Column, range_: Column) -> Column:
    return signal * range_ * range_


def column_index(columns: Column) -> Column:
    """Azimuth bin of a point among ``columns`` bins of the full circle."""
    pi = F.lit(3.141592653589793)
    turn = (F.atan2(F.col("y").cast("double"), F.col("x").cast("double")) + pi) / (2 * pi)
    return F.pmod(F.floor(turn * columns), columns).cast("int")


def row_index(beams: list[float]) -> Column:
    """The beam nearest to a point's elevation; of equals the first."""
    r = distance_from_origin()
    up = F.when(r > 0, F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("z") / r)))).otherwise(F.lit(0.0))
    gaps = F.array(*[F.abs(up - F.lit(float(b))) for b in beams])
    return (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int")


def uniform_row_index(low: float, high: float, rows: int) -> Column:
    """Without beam angles: even elevation bins over the field of view."""
    if rows <= 1:
        return F.lit(0)
    r = distance_from_origin()
    up = F.when(r > 0, F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("z") / r)))).otherwise(F.lit(0.0))
    share = (up - F.lit(low)) / F.lit(max(high - low, 1e-9))
    return F.greatest(F.lit(0), F.least(F.lit(rows - 1), F.floor(share * rows))).cast("int")


def milli(c: Column) -> Column:
    """Thousandths as a long, from just below a half up (sums differ in their last bits): how results of floating-point steps are compared."""
    return F.floor(c * 1000 + 0.500001).cast("long")
