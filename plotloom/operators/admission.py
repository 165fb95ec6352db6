"""Which shared boundaries a block may use: trusted runs first, the ones it cannot satisfy out again, single edges by trial."""

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotloom.operators import adjust, fits
from plotloom.session import cut_lineage

SIGMA_PAIR, SIGMA_POS, SIGMA_HEAD_DEG = 0.30, 2.5, 3.0
TRUSTED_PAIRS, LIMIT_M, WORSE_M = 3, 1.0, 0.1
#: A step below which a village is settled, in metres.
SETTLED = 1e-5
CHAIN = ["village", "a", "b"]


def _points(chains: DataFrame) -> DataFrame:
    p = chains.select(*CHAIN, F.explode("pairs").alias("p"))
    return p.select(*CHAIN, F.col("p.ax").alias("pax"), F.col("p.ay").alias("pay"), F.col("p.bx").alias("pbx"), F.col("p.b_y").alias("pby"), F.lit(SIGMA_PAIR).alias("sigma"))


def _misfits(chains: DataFrame, poses: DataFrame) -> DataFrame:
    return fits.residuals_by_pair(_points(chains), poses, ["village"]).select(*CHAIN, "rms")


def trusted_first_admission(chains: DataFrame, starts: DataFrame, centres: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs with their fate and misfit (village, a, b, n_pairs, used, rms), and the poses of the block that uses the good ones.

    ``chains``: village, a, b, n_pairs, pairs (both in their sheet's metres; one run for each pair of sheets). ``starts``: village,
    survey, theta, tx, ty as placed by hand, a weak prior. ``centres``: village, survey, x, y, mx, my: sheet centroids and where the
    hand placed them. All villages advance together. First all runs of TRUSTED_PAIRS or more count; while a village has one that
    misfits by more than LIMIT_M its worst goes. Then single edges and what went are tried, the best-fitting first: one stays if it
    fits with it in the block and no run in use gets worse for it. Every trial either takes a run in or marks it tried until the
    next is taken in, so the loops end by themselves.
    """
    chains, starts = cut_lineage(chains.select(*CHAIN, "n_pairs", "pairs")), cut_lineage(starts.select("village", "survey", "theta", "tx", "ty"))
    centres = cut_lineage(centres)
    priors = starts.withColumns({"sigma_pos": F.lit(1e6), "sigma_head": F.lit(SIGMA_HEAD_DEG)})

    def solved(used: DataFrame, villages: DataFrame) -> DataFrame:
        here = [df.join(villages, "village", "left_semi") for df in (starts, used, centres, priors)]
        held = here[2].select("village", "survey", "x", "y", "mx", "my", F.lit(SIGMA_POS).alias("sigma"))
        obs = adjust.observations(pair=_points(here[1]), gcp=held)
        out = adjust.block_adjust(here[0], starts.limit(0), obs, here[3], SETTLED, sigmas=False)
        return cut_lineage(out.select("village", "survey", "theta", "tx", "ty"))

    def replaced(poses: DataFrame, new: DataFrame) -> DataFrame:
        return cut_lineage(poses.join(new.select("village").distinct(), "village", "left_anti").unionByName(new))
    every = starts.select("village").distinct()
    used = cut_lineage(chains.filter(F.col("n_pairs") >= TRUSTED_PAIRS))
    poses = solved(used, every)
    for _ in count():       # each round takes a run out
        worst = _misfits(used, poses).groupBy("village").agg(F.max(F.struct("rms", "a", "b")).alias("w")).filter(F.col("w.rms") > LIMIT_M)
        worst = cut_lineage(worst.select("village", "w.a", "w.b"))
        if worst.isEmpty():
            break
        used = cut_lineage(used.join(worst, CHAIN, "left_anti"))
        poses = replaced(poses, solved(used, worst.select("village")))
    pending = cut_lineage(chains.join(used.select(*CHAIN), CHAIN, "left_anti"))
    tried = pending.select(*CHAIN).limit(0)
    for _ in count():       # see above
        left = pending.join(tried, CHAIN, "left_anti")
        pick = _misfits(left, poses).groupBy("village").agg(F.min(F.struct("rms", "a", "b")).alias("w")).select("village", "w.a", "w.b")
        pick = cut_lineage(pick)
        if pick.isEmpty():
            break
        trial = cut_lineage(used.join(pick.select("village"), "village", "left_semi").unionByName(pending.join(pick, CHAIN, "left_semi")))
        new = solved(trial, pick.select("village"))
        before = _misfits(used.join(pick.select("village"), "village", "left_semi"), poses).groupBy("village").agg(F.max("rms").alias("before"))
        after = _misfits(trial, new).join(pick.withColumn("own", F.lit(True)), CHAIN, "left").groupBy("village").agg(
            F.max(F.when(F.col("own"), F.col("rms"))).alias("own"), F.max(F.when(F.col("own").isNull(), F.col("rms"))).alias("others"))
        fits_in = (F.col("own") <= LIMIT_M) & (F.coalesce("others", F.lit(0.0)) <= F.greatest(F.lit(LIMIT_M), F.coalesce("before", F.lit(0.0)) + WORSE_M))
        good = cut_lineage(after.join(before, "village", "left").filter(fits_in).select("village"))
        taken = cut_lineage(pick.join(good, "village", "left_semi"))
        used = cut_lineage(used.unionByName(pending.join(taken, CHAIN, "left_semi")))
        pending = cut_lineage(pending.join(taken, CHAIN, "left_anti"))
        poses = replaced(poses, new.join(good, "village", "left_semi"))
        tried = cut_lineage(tried.join(good, "village", "left_anti").unionByName(pick.join(good, "village", "left_anti")))
    fate = chains.join(used.select(*CHAIN, F.lit(1).alias("used")), CHAIN, "left").join(_misfits(chains, poses), CHAIN, "left")
    return fate.select(*CHAIN, "n_pairs", F.coalesce("used", F.lit(0)).alias("used"), "rms"), poses
