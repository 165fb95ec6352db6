"""Block adjustment: robust least squares over all observations of many villages at once.

A village whose observations fit a task is adjusted there, all rounds of it, beside all the others. One with more goes round by round:
the observations meet the present poses in a join, tasks turn them into weighted normal equations, which are summed into one 3x3 block per
survey pair, and only those blocks reach the per-village solve. Either way that goes level by level through a village (20 000 surveys take some 0.8 GB).
"""

import math
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.functions import kernels
from plotloom.session import cut_lineage

F_SCALE = 1.5
SIGMA_START, SIGMA_START_DEG = 10.0, 10.0
STEP = "village string, survey string, d_theta double, d_tx double, d_ty double"
SIGMAS = "village string, survey string, sigma_head_deg double, sigma_pos_m double"
#: Rounds after which a village that still moves is an error, not a result.
GIVE_UP = 500
#: Observations up to which a village is adjusted in one task; some 300 bytes each there.
IN_TASK = 300_000
POSES = "village string, survey string, theta double, tx double, ty double, sigma_head_deg double, sigma_pos_m double"
OBS = ("village", "kind", "a", "pax", "pay", "b", "q1x", "q1y", "q2x", "q2y", "sigma")


def observations(pair: DataFrame | None = None, line: DataFrame | None = None, gcp: DataFrame | None = None,
                 pair_line: DataFrame | None = None) -> DataFrame:
    """All observation kinds as one table; ``kind`` is point or line, b is null for fixed targets.

    ``pair``: village, a, b, pax, pay, pbx, pby, sigma. ``line``: village, survey, x, y, ax, ay, bx, b_y, sigma
    (ground line). ``gcp``: village, survey, x, y, mx, my, sigma. ``pair_line``: village, survey, other, x, y,
    x0, y0, x1, y1, sigma (edge in the other sheet's metres).
    """
    no = F.lit(None).cast("double")
    nobody = F.lit(None).cast("string")
    spec = [(pair, "point", ("a", "pax", "pay", "b", "pbx", "pby", no, no)),
            (line, "line", ("survey", "x", "y", nobody, "ax", "ay", "bx", "b_y")),
            (gcp, "point", ("survey", "x", "y", nobody, "mx", "my", no, no)),
            (pair_line, "line", ("survey", "x", "y", "other", "x0", "y0", "x1", "y1"))]
    out = None
    for df, kind, cols in spec:
        if df is None:
            continue
        t = df.select("village", F.lit(kind).alias("kind"), *[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(cols, OBS[2:10])], "sigma")
        out = t if out is None else out.unionByName(t)
    return out


def _at_poses(obs: DataFrame, poses: DataFrame) -> DataFrame:
    """Observations with the poses of both ends; one whose other end has no pose is left out."""
    def posed(side):
        return poses.select("village", F.col("survey").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("theta", "tx", "ty", "free")])
    return obs.join(posed("a"), ["village", "a"]).join(posed("b"), ["village", "b"], "left").filter("b is null or b_theta is not null")


def _prior_blocks(poses: DataFrame, priors: DataFrame) -> DataFrame:
    """What the priors add to each free survey's own block: three residuals, none of which touches the others."""
    p = poses.filter("free").join(priors.select("village", "survey", "p_theta", "p_tx", "p_ty", "sigma_pos", "sigma_head"), ["village", "survey"])
    turn = F.pmod(F.col("theta") - F.col("p_theta") + math.pi, F.lit(2 * math.pi)) - math.pi
    sigma = [F.radians("sigma_head"), F.col("sigma_pos"), F.col("sigma_pos")]
    p = p.select("village", F.col("survey").alias("i"), F.col("survey").alias("j"), *[s.alias(f"s{k}") for k, s in enumerate(sigma)],
                 *[(v / s).alias(f"r{k}") for k, (v, s) in enumerate(zip((turn, F.col("tx") - F.col("p_tx"), F.col("ty") - F.col("p_ty")), sigma))])
    w = [F.least(F.lit(1.0), F_SCALE / F.greatest(F.abs(f"r{k}"), F.lit(1e-300))) for k in range(3)]
    m = [(w[a] / (F.col(f"s{a}") * F.col(f"s{a}")) if a == b else F.lit(0.0)).alias(f"m{a}{b}") for a in range(3) for b in range(3)]
    return p.select("village", "i", "j", *m, *[(w[k] * F.col(f"r{k}") / F.col(f"s{k}")).alias(f"g{k}") for k in range(3)])


def _blocks(obs: DataFrame | None, poses: DataFrame, priors: DataFrame) -> DataFrame:
    """Weighted normal blocks per (i, j), the gradient on the diagonal ones; tasks sum their batches before the shuffle."""
    rows = _prior_blocks(poses, priors)
    if obs is not None:
        schema = "village string, i string, j string, " + ", ".join(f"{c} double" for c in kernels.BLOCK_VALUES)
        rows = rows.unionByName(_at_poses(obs, poses).mapInPandas(kernels.normal_blocks(F_SCALE), schema))
    return rows.groupBy("village", "i", "j").agg(*[F.sum(c).alias(c) for c in kernels.BLOCK_VALUES])


def _by_rounds(obs: DataFrame, start: DataFrame, pr: DataFrame, tol: float, sigmas: bool) -> DataFrame:
    """Adjusted free poses of villages with many observations, all villages round by round."""
    poses = start.withColumn("live", F.col("free"))
    for number in count():
        going = poses.filter("live").select("village").distinct()
        if going.isEmpty():
            break
        if number == GIVE_UP:
            raise RuntimeError(f"still moving after {GIVE_UP} rounds: {[r.village for r in going.limit(5).collect()]}")
        at = poses.join(going, "village", "left_semi")
        step = _blocks(obs, at, pr).groupBy("village").applyInPandas(kernels.solve_village, STEP)
        big = step.groupBy("village").agg((F.max(F.greatest(F.abs(F.col("d_theta") * 100.0), F.abs("d_tx"), F.abs("d_ty"))) > tol).alias("_more"))
        j = poses.join(step, ["village", "survey"], "left").join(big, "village", "left")
        poses = cut_lineage(j.select("village", "survey", *[(F.col(c) + F.coalesce(f"d_{c}", F.lit(0.0))).alias(c) for c in ("theta", "tx", "ty")], "free", "_ox", "_oy",
                                     (F.col("free") & F.coalesce("_more", F.lit(False))).alias("live")))
    if sigmas:
        blocks = _blocks(obs, poses, pr)
        poses = poses.join(blocks.groupBy("village").applyInPandas(kernels.village_sigmas, SIGMAS), ["village", "survey"], "left")
    else:
        poses = poses.withColumns({c: F.lit(None).cast("double") for c in ("sigma_head_deg", "sigma_pos_m")})
    return poses.filter("free").select("village", "survey", "theta", "tx", "ty", "sigma_head_deg", "sigma_pos_m")


def block_adjust(free: DataFrame, fixed: DataFrame, obs: DataFrame | None, priors: DataFrame | None = None,
                 tol: float = 1e-7, sigmas: bool = True) -> DataFrame:
    """Adjusted pose of every free survey, its change and its sigmas; fixed surveys never move.

    ``free`` and ``fixed``: village, survey, theta (degrees), tx, ty. Without ``priors`` each start pose is
    its own weak prior (10 m, 10 degrees). Coordinates are taken from the village's mean position; a village
    leaves the loop once its largest step is below ``tol``; one that never does is an error.
    """
    cols = ["village", "survey", "theta", "tx", "ty"]
    origin = cut_lineage(free.groupBy("village").agg(F.avg("tx").alias("_ox"), F.avg("ty").alias("_oy")))
    both = free.select(*cols, F.lit(True).alias("free")).unionByName(fixed.select(*cols, F.lit(False).alias("free")))
    start = cut_lineage(both.join(origin, "village").select("village", "survey", F.radians("theta").alias("theta"), (F.col("tx") - F.col("_ox")).alias("tx"),
                                                           (F.col("ty") - F.col("_oy")).alias("ty"), "free", "_ox", "_oy"))
    if priors is None:
        pr = start.filter("free").select("village", "survey", F.col("theta").alias("p_theta"), F.col("tx").alias("p_tx"), F.col("ty").alias("p_ty"),
                                         F.lit(SIGMA_START).alias("sigma_pos"), F.lit(SIGMA_START_DEG).alias("sigma_head"))
    else:
        pr = priors.join(origin, "village").select("village", "survey", F.radians("theta").alias("p_theta"), (F.col("tx") - F.col("_ox")).alias("p_tx"),
                                                   (F.col("ty") - F.col("_oy")).alias("p_ty"), "sigma_pos", "sigma_head")
    if obs is not None:
        grounded = F.col("b").isNull()
        obs = obs.join(origin, "village").select(*[
            F.when(grounded, F.col(c) - F.col("_ox" if c.endswith("x") else "_oy")).otherwise(F.col(c)).alias(c) if c in ("q1x", "q1y", "q2x", "q2y") else F.col(c)
            for c in OBS])
        obs = cut_lineage(obs)
    many = None
    if obs is None:
        obs = start.select("village", *[F.lit(None).cast("string" if c in ("kind", "a", "b") else "double").alias(c) for c in OBS[1:]]).limit(0)
    else:
        most = obs.groupBy("village").agg(F.count("*").alias("n")).filter(F.col("n") > IN_TASK)
        many = cut_lineage(most.select("village"))
        many = None if many.isEmpty() else many
    few = [df if many is None else df.join(many, "village", "left_anti") for df in (start.join(pr, ["village", "survey"], "left"), obs)]
    run = kernels.adjusted_village(F_SCALE, tol, sigmas, GIVE_UP)
    poses = few[0].drop("_ox", "_oy").groupBy("village").cogroup(few[1].groupBy("village")).applyInPandas(run, POSES)
    if many is not None:
        here = [df.join(many, "village", "left_semi") for df in (obs, start, pr)]
        poses = poses.unionByName(_by_rounds(*here, tol, sigmas))
    th = F.degrees("theta")
    began = free.select("village", "survey", F.col("theta").alias("th0"), F.col("tx").alias("tx0"), F.col("ty").alias("ty0"))
    out = poses.join(origin, "village").select("village", "survey", th.alias("theta"), (F.col("tx") + F.col("_ox")).alias("tx"), (F.col("ty") + F.col("_oy")).alias("ty"),
                                               "sigma_head_deg", "sigma_pos_m")
    return out.join(began, ["village", "survey"]).select(
        "village", "survey", "theta", "tx", "ty", (F.pmod(F.col("theta") - F.col("th0") + 180, F.lit(360.0)) - 180).alias("dtheta_deg"),
        F.hypot(F.col("tx") - F.col("tx0"), F.col("ty") - F.col("ty0")).alias("shift_m"), "sigma_head_deg", "sigma_pos_m")


