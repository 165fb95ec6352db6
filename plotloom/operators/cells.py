"""Spatial joins as equi-joins on grid cells.

One side is unfolded over the cells its box (or its reach) touches, the other over its own cells, and
the exact predicate runs on the matches. The planner sees a plain equi-join, so AQE can split hot cells.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cell(v, size: float) -> Column:
    return F.floor(v / size).cast("int")


def over_box(df: DataFrame, minx, miny, maxx, maxy, size: float) -> DataFrame:
    """One row per cell of the box: columns cell_x, cell_y."""
    xs = F.sequence(_cell(minx, size), _cell(maxx, size))
    ys = F.sequence(_cell(miny, size), _cell(maxy, size))
    return df.withColumn("cell_x", F.explode(xs)).withColumn("cell_y", F.explode(ys))


def at_point(df: DataFrame, x, y, size: float) -> DataFrame:
    return df.withColumns({"cell_x": _cell(x, size), "cell_y": _cell(y, size)})


def over_segment(df: DataFrame, x0, y0, x1, y1, size: float, pad: float = 0.0) -> DataFrame:
    """Only the cells within ``pad`` of the segment: per column of cells the rows the segment crosses there.

    A long segment costs as many rows as cells along it, not as many as its box holds.
    """
    lox, hix = F.least(x0, x1), F.greatest(x0, x1)
    d = df.withColumn("cell_x", F.explode(F.sequence(_cell(lox - pad, size), _cell(hix + pad, size))))
    left = F.greatest(lox, F.col("cell_x") * size - pad)
    right = F.least(hix, (F.col("cell_x") + 1) * size + pad)
    dx = x1 - x0

    def y_at(x):
        return F.when(dx == 0, None).otherwise(y0 + (x - x0) * (y1 - y0) / F.when(dx != 0, dx))
    ya, yb = F.coalesce(y_at(left), y0), F.coalesce(y_at(right), y1)
    eps = pad + 1e-6
    return d.withColumn("cell_y", F.explode(F.sequence(_cell(F.least(ya, yb) - eps, size), _cell(F.greatest(ya, yb) + eps, size))))


def box_pairs(a: DataFrame, b: DataFrame, keys: list[str], size: float, reach: float = 0.0,
              keep: Callable[[], Column] | None = None) -> DataFrame:
    """Pairs of boxes closer than ``reach``, each pair once, without a distinct.

    Inputs carry minx..maxy; those of ``b`` come back prefixed with ``o_``. A pair meeting in many cells is
    kept only in the lowest cell both sides share.
    """
    right = b.select(*keys, *[F.col(c).alias(f"o_{c}") for c in b.columns if c not in keys])
    left = over_box(a, F.col("minx") - reach, F.col("miny") - reach, F.col("maxx") + reach, F.col("maxy") + reach, size)
    right = over_box(right, F.col("o_minx"), F.col("o_miny"), F.col("o_maxx"), F.col("o_maxy"), size)
    home = ((F.col("cell_x") == F.greatest(_cell(F.col("minx") - reach, size), _cell(F.col("o_minx"), size)))
            & (F.col("cell_y") == F.greatest(_cell(F.col("miny") - reach, size), _cell(F.col("o_miny"), size))))
    near = ((F.col("o_minx") <= F.col("maxx") + reach) & (F.col("o_maxx") >= F.col("minx") - reach)
            & (F.col("o_miny") <= F.col("maxy") + reach) & (F.col("o_maxy") >= F.col("miny") - reach))
    cond = home & near if keep is None else home & near & keep()
    return left.join(right, [*keys, "cell_x", "cell_y"]).filter(cond).drop("cell_x", "cell_y")


def nearest(points: DataFrame, targets: DataFrame, keys: list[str], id_cols: list[str], dist: Column, within: Column | float,
            pick: list[str], tie: list[str]) -> DataFrame:
    """Best target per point among those of the same cell: smallest distance, then ``tie``.

    Both inputs already carry cell_x, cell_y. Points without a target keep null columns. The choice is an
    aggregate (combined before the shuffle), never a sorted window.
    """
    ok = dist <= within if not isinstance(within, Column) else within
    hits = (points.join(targets, [*keys, "cell_x", "cell_y"]).withColumn("dist", dist).filter(ok)
            .groupBy(*keys, *id_cols)
            .agg(F.min_by(F.struct("dist", *pick), F.struct("dist", *tie)).alias("_n"))
            .select(*keys, *id_cols, "_n.*"))
    return hits
