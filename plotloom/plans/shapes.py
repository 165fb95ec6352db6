"""Ring-shaped views of the derived tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.functions import geo


def corner_ring():
    return F.array(*[geo.pt(F.col(f"x{n}"), F.col(f"y{n}")) for n in (1, 2, 3, 4)])


def plots(fx, holes: bool = False) -> DataFrame:
    """village, survey, poly_id, plot_no, i, ring, rings."""
    base = fx.lattice_fx
    rings = F.array(corner_ring())
    if holes:
        c, r = F.col("c") * 40, F.col("r") * 25
        hole = F.array(*[geo.pt(c + x, r + y) for x, y in ((15, 10), (15, 15), (25, 15), (25, 10))])
        rings = F.when(F.col("i") % 5 == 0, F.array(corner_ring(), hole)).otherwise(rings)
    return base.select("village", "survey", "poly_id", "plot_no", "i", "p_size", corner_ring().alias("ring"), rings.alias("rings"))


def r(col, n: int = 6):
    """Rounded for comparison, with no negative zero."""
    return F.round(col, n) + F.lit(0.0)
