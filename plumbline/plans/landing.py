"""Landing probabilities of an ordered list of choices.

A choice's threshold moves from year to year; its past moves, weighted by likeness, give the chance that
it comes in reach. With independent moves the chance of landing on a choice is a running product, so the
probabilities are exact sums; drawing at random is offered as a check only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import numeric
from plumbline.operators import projection, ranking
from plumbline.sources.storage import settle

POPULATION = 400_000
#: Samples that a tier of likeness needs, and below which the pool is blended with the rank bucket's.
TIER_ROWS, SHRINK_ROWS, THIN_ROWS = 80, 40, 15
TIERS = ("rank+family+plan+region", "rank+family+plan", "rank+family", "rankbin+family", "near_rank", "rankbin")


def transition_samples(model: DataFrame, years: list[str], trend: str = "rankbin_centered", population: float = POPULATION) -> DataFrame:
    """A sample for each two neighbouring years: rank_mid, delta_z, rank_bin, model_delta_z and the row's family, plan and region.

    model: family, plan_count, region and the years' ranks. trend: raw, global_centered or rankbin_centered.
    """
    out = projection.pairs(model, ["family", "plan_count", "region"], years)
    old, new = F.col("old").cast("double"), F.col("new").cast("double")
    out = out.withColumn("rank_mid", (old + new) / 2).withColumn("delta_z", numeric.logit_rank(new, population) - numeric.logit_rank(old, population))
    out = out.withColumn("rank_bin", numeric.rank_bin(F.col("rank_mid"))).withColumn("plan_bin", numeric.plan_bin(F.col("plan_count"))).drop("from", "old", "new")
    if trend == "raw":
        return out.withColumn("model_delta_z", F.col("delta_z"))
    if trend == "global_centered":
        center = ranking.medians(out, [], "delta_z", "center")
        return out.join(F.broadcast(center)).withColumn("model_delta_z", F.col("delta_z") - F.col("center")).drop("center")  # one row
    if trend == "rankbin_centered":
        centers = ranking.medians(out, ["rank_bin"], "delta_z", "center")
        return out.join(F.broadcast(centers), "rank_bin").withColumn("model_delta_z", F.col("delta_z") - F.col("center")).drop("center")  # a dozen buckets
    raise ValueError(f"unknown trend {trend!r}")


#: Ranks count as near from NEAR[0] to NEAR[1] times a choice's, so logarithms by this width put them into two or three buckets.
NEAR = (0.65, 1.45)
_WIDTH = math.log(NEAR[1] / NEAR[0])


def _pairs(choices: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples with the choices that they are near or in one rank bucket with, once each, and the tests of the tiers as t.

    Both sides meet by bucket, so nothing is compared with everything.
    """
    low, high = F.greatest(F.lit(1.0), F.col("c_rank") * NEAR[0]), F.least(F.lit(399_999.0), F.col("c_rank") * NEAR[1])
    near = F.coalesce(F.col("rank_mid").between(low, high), F.lit(False))
    bucket = lambda x: F.floor(F.ln(x) / F.lit(_WIDTH)).cast("int")
    reach = choices.where(low <= high).withColumn("_bucket", F.explode(F.sequence(bucket(low), bucket(high))))
    close = samples.where("rank_mid >= 1").withColumn("_bucket", bucket(F.col("rank_mid"))).join(reach, "_bucket").where(near).drop("_bucket").withColumn("near", F.lit(True))
    rest = samples.join(choices, F.col("rank_bin") == F.col("c_bin")).where(~near).withColumn("near", F.lit(False))
    family, plan = F.col("family").eqNullSafe(F.col("c_family")), F.col("plan_bin").eqNullSafe(F.col("c_plan_bin"))
    region, same_bin = F.col("region").eqNullSafe(F.col("c_region")), F.coalesce(F.col("rank_bin") == F.col("c_bin"), F.lit(False))
    n = F.col("near")
    tests = [n & family & plan & region, n & family & plan, n & family, same_bin & family, n, same_bin]
    return close.unionByName(rest).select(*[c for c in (*choices.columns, "rank_mid", "family", "plan_count", "region", "model_delta_z") if c not in ("c_bin", "c_plan_bin")], F.array(*tests).alias("t"))


#: Parts that samples are dealt to for the choices whose pool has all of them.
PARTS = 64


def _by_part(samples: DataFrame, choices: DataFrame) -> DataFrame:
    """Each choice with every sample, which is what its pool consists of: the choice goes to all parts, a sample is in one."""
    dealt = samples.withColumn("_part", F.pmod(F.xxhash64(*samples.columns), F.lit(PARTS)))
    return dealt.join(choices.withColumn("_to", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))), F.col("_part") == F.col("_to")).drop("_part", "_to")


def similarity_pool(choices: DataFrame, samples: DataFrame, population: float = POPULATION) -> DataFrame:
    """(choice, delta, weight, tier, n, effective_n): the samples of each choice's best tier, weights adding up to 1.

    choices: choice, rank, family, plan_count, region. Tiers are tried in order for enough samples near the
    choice's rank; without one the near ones, and without any all. Fewer than SHRINK_ROWS are blended with
    those of the rank's bucket, or with all if it has none. A choice without a plan counts as 3, a sample without
    one as the choice's.
    """
    c = settle(choices.select(
        "choice", F.col("rank").cast("double").alias("c_rank"), F.col("family").alias("c_family"), F.col("plan_count").cast("double").alias("c_plan"), F.col("region").alias("c_region"),
        numeric.rank_bin(F.col("rank")).alias("c_bin"), numeric.plan_bin(F.col("plan_count")).alias("c_plan_bin"),
    ))
    pairs = settle(_pairs(c, samples))
    counted = pairs.groupBy("choice").agg(*[F.count_if(F.col("t")[i]).alias(f"n{i}") for i in range(6)])
    counts = c.select("choice").join(counted, "choice", "left").na.fill(0)
    tier = F.coalesce(*[F.when(F.col(f"n{i}") >= TIER_ROWS, F.lit(i)) for i in range(6)], F.when(F.col("n4") > 0, F.lit(6)), F.lit(7))
    chosen = counts.select("choice", tier.alias("tier"), "n5")
    plan_value = F.coalesce("c_plan", F.lit(3.0))
    z = F.abs(numeric.logit_rank(F.col("rank_mid"), population) - numeric.logit_rank(F.col("c_rank"), population))
    p = F.abs(F.log1p(F.coalesce(F.col("plan_count").cast("double"), plan_value)) - F.log1p(F.greatest(F.lit(0.0), plan_value)))
    weight = numeric.kernel(z, p, F.col("family").eqNullSafe(F.col("c_family")), F.col("region").eqNullSafe(F.col("c_region")))
    # Choices that nothing is near to take all samples: none, where there are samples of all ranks.
    far = chosen.where("tier = 7").select("choice")
    everything = lambda keys: _by_part(samples, c.join(keys, "choice", "left_semi"))
    inside = F.when(F.col("tier") < 6, F.element_at("t", F.col("tier") + 1)).otherwise(F.col("t")[4])
    own = pairs.join(chosen.where("tier < 7"), "choice").where(inside).select("choice", F.col("model_delta_z").alias("delta"), weight.alias("w"))
    if not far.isEmpty():
        own = own.unionByName(everything(far).select("choice", F.col("model_delta_z").alias("delta"), weight.alias("w")))
    own = own.where("w > 0")
    sums = own.groupBy("choice").agg(F.count(F.lit(1)).alias("k"), F.sum("w").alias("total"))
    facts = settle(chosen.join(sums, "choice", "left").na.fill(0, ["k"]).withColumn("shrunk", F.col("k") < SHRINK_ROWS).withColumn("share", F.when(~F.col("shrunk"), 1.0).when(F.col("k") == 0, 0.0).when(F.col("k") >= THIN_ROWS, 0.55).otherwise(0.35)))
    main = own.join(facts.drop("tier"), "choice").select("choice", "delta", (F.col("w") / F.col("total") * F.col("share")).alias("weight"))
    fall = pairs.where(F.col("t")[5]).join(facts.where("shrunk and n5 > 0").select("choice", "share"), "choice").select("choice", "share", F.col("model_delta_z").alias("delta"))
    bare = facts.where("shrunk and n5 = 0").select("choice", "share")
    if not bare.isEmpty():
        fall = fall.unionByName(everything(bare.select("choice")).join(bare, "choice").select("choice", "share", F.col("model_delta_z").alias("delta")))
    sizes = fall.groupBy("choice").agg(F.count(F.lit(1)).alias("m"))
    rest = fall.join(sizes, "choice").select("choice", "delta", ((1 - F.col("share")) / F.col("m")).alias("weight"))
    pool = main.unionByName(rest)
    totals = pool.groupBy("choice").agg(F.count(F.lit(1)).alias("n"), (F.sum("weight") * F.sum("weight") / F.sum(F.col("weight") * F.col("weight"))).alias("effective_n"))
    names = F.element_at(F.array(*[F.lit(t) for t in (*TIERS, "near_rank_fallback", "near_rank_fallback")]), F.col("tier") + 1)
    info = facts.select("choice", F.concat(names, F.when(F.col("shrunk"), F.lit("+rankbin_shrink")).otherwise(F.lit(""))).alias("tier"))
    return pool.join(totals.join(info, "choice"), "choice")


def extra_sigma(history: Column, plan: Column) -> Column:
    """Spread beyond the samples': more with less history and for small plans."""
    return F.when(history == 0, 0.055).when(history == 1, 0.035).otherwise(0.0) + F.when(plan <= 3, 0.020).otherwise(0.0)


def chances(choices: DataFrame, pool: DataFrame, user_rank: float, population: float = POPULATION) -> DataFrame:
    """choices with chance: the probability that the choice is in reach by itself. choices: also history."""
    user = math.log(min(max(user_rank / population, 1e-6), 1 - 1e-6) / (1 - min(max(user_rank / population, 1e-6), 1 - 1e-6)))
    c = choices.select("choice", numeric.logit_rank(F.col("rank").cast("double"), population).alias("z"), extra_sigma(F.col("history"), F.col("plan_count")).alias("sigma"))
    gap = F.col("z") + F.col("delta") / math.sqrt(2) - user
    can = F.when(F.col("sigma") > 0, numeric.normal_cdf(gap / F.col("sigma"))).otherwise((gap >= 0).cast("double"))
    got = pool.join(c, "choice").groupBy("choice").agg(
        F.least(F.lit(1.0), F.sum(F.col("weight") * can)).alias("chance"), F.first("tier").alias("tier"), F.first("n").alias("sample_n"), F.first("effective_n").alias("effective_n")
    )
    return choices.join(got, "choice", "left")


def landing(choices: DataFrame, samples: DataFrame, user_rank: float, population: float = POPULATION) -> DataFrame:
    """choices with chance, reach, admit, total, none, rank_gap, tier, sample_n, effective_n and note; order says which comes first."""
    out = chances(choices, similarity_pool(choices, samples, population), user_rank, population)
    out = ranking.running_chances(out, [], "order", "chance").withColumn("rank_gap", F.col("rank") - F.lit(user_rank))
    return out.withColumn("note", note(F.col("history"), F.col("plan_count"), F.col("tier"), F.col("effective_n")))


def note(history: Column, plan: Column, tier: Column, effective: Column) -> Column:
    years = F.when(history >= 3, "3年历史").when(history == 2, "2年历史").when(history == 1, "1年历史").otherwise("无历史")
    return F.concat_ws(";", years, F.when(plan <= 3, "小计划"), tier, F.format_string("eff_n=%.0f", effective))


def drawn(choices: DataFrame, pool: DataFrame, user_rank: float, draws: int, seed: int = 0, population: float = POPULATION) -> DataFrame:
    """(choice, admit) by drawing: each draw lands on the first choice in reach. A check of landing(), for short lists.

    Uniform numbers come from hashes of seed, draw and choice, so reruns agree.
    """
    user = math.log((user_rank / population) / (1 - user_rank / population))
    runs = ranking.cumulative_share(pool.select("choice", "delta", "weight"), ["choice"], ["delta", "weight"], "weight")
    lists = runs.groupBy("choice").agg(F.array_sort(F.collect_list(F.struct("cumulative", "delta"))).alias("steps"))  # as long as a pool
    c = choices.select("choice", "order", numeric.logit_rank(F.col("rank").cast("double"), population).alias("z"), extra_sigma(F.col("history"), F.col("plan_count")).alias("sigma")).join(lists, "choice")
    grid = choices.sparkSession.range(draws).join(F.broadcast(c))
    uniform = lambda k: (F.shiftrightunsigned(F.xxhash64(F.lit(seed * 7 + k), "id", "order"), 11).cast("double") + 0.5) / float(1 << 53)
    step = F.try_element_at(F.filter("steps", lambda s: s["cumulative"] >= uniform(1)), F.lit(1))
    normal = F.sqrt(-2 * F.ln(uniform(2))) * F.cos(2 * math.pi * uniform(3))
    reached = F.col("z") + step["delta"] / math.sqrt(2) + F.col("sigma") * normal >= user
    first = grid.where(reached).groupBy("id").agg(F.min_by("choice", "order").alias("choice"))
    return first.groupBy("choice").agg((F.count(F.lit(1)) / draws).alias("admit"))


def with_missing(choices: DataFrame, model: DataFrame, policy: str = "accept", overrides: DataFrame | None = None) -> DataFrame:
    """choices with the model's columns and found: matched, no_rank, manual or missing.

    policy accept leaves out choices without a rank; manual takes ranks from overrides (choice, rank) first;
    audit keeps choices that the model does not know; reject fails if any is without a rank.
    """
    out = choices.join(model.withColumn("_known", F.lit(True)), "choice", "left")
    if overrides is not None and policy == "manual":
        out = out.join(overrides.select("choice", F.col("rank").alias("_own")), "choice", "left")
    else:
        out = out.withColumn("_own", F.lit(None).cast("double"))
    found = F.when(F.col("_known").isNull() & F.col("_own").isNull(), "missing").when(F.col("rank").isNull() & F.col("_own").isNotNull(), "manual").when(F.col("rank").isNull(), "no_rank").otherwise("matched")
    out = out.withColumn("found", found).withColumn("rank", F.coalesce("rank", "_own")).drop("_known", "_own")
    if policy == "reject" and not out.where("rank is null").isEmpty():
        raise ValueError("choices without a rank")
    if policy == "audit":
        return out.where("rank is not null or found = 'missing'")
    return out.where("rank is not null")


def report(result: DataFrame) -> dict[str, DataFrame]:
    """Aggregates of a report: by source of samples, by ten choices, and the twenty likeliest."""
    return {
        "by_tier": result.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.sum("admit").alias("admit")),
        "by_ten": result.groupBy((F.floor((F.col("order") - 1) / 10) + 1).cast("long").alias("window")).agg(F.sum("admit").alias("admit"), F.max("total").alias("total")),
        "likeliest": result.orderBy(F.desc("admit"), "order").limit(20),
    }
