"""Prescreen of items: filter, classify, features, imputed ranks, score, order; and labels on top of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import numeric, text
from plumbline.operators import filters, ranking

# Terms of the classification.
LOW_FIT_SCHOOLS = ("民办", "独立学院", "职业", "专科")
EXCLUDED_NAMES = ("师范", "软件工程", "网络安全", "网络空间安全", "信息安全", "密码", "精算", "金融数学", "经济统计", "生物统计", "大气", "气象", "数据科学与大数据", "大数据管理", "大数据技术")
RISKY_REMARKS = ("软件工程", "网络安全", "网络空间安全", "信息安全", "密码", "经济统计", "生物统计", "数据科学", "数据科学与大数据", "大数据管理", "大数据技术", "卓师")
MATH_TERMS = ("信息与计算科学", "数学与应用数学", "数学类", "数理基础科学", "数据计算及应用", "统计学类", "统计学", "应用统计学")
CS_TERMS = ("计算机科学与技术", "人工智能", "智能科学与技术")
CLASS_TERMS = ("计算机类", "数学类", "统计学类")
TRIAL_TERMS = ("试验班", "拔尖", "强基", "元培", "匡亚明")
FAMILIES = (("cs", ("计算机", "软件工程", "网络工程")), ("ai", ("人工智能", "智能科学")), ("info_compute", ("信息与计算科学",)), ("statistics", ("统计",)), ("math", ("数学", "数据计算")))
FIT = {"core_math_stat": 100, "core_cs_ai": 96, "target_class": 74, "trial_class": 66, "target_in_remark": 58}


def first_family(name: Column, families: Sequence[tuple[str, Sequence[str]]] = FAMILIES, other: str = "other") -> Column:
    """The first family one of whose words the name has."""
    out = F.when(F.lit(False), F.lit(other))
    for family, words in families:
        out = out.when(text.has_any(name, words), family)
    return out.otherwise(other)


def classify(name: Column, remark: Column) -> Column:
    """struct<keep, category, fit, risks> of a name and its remark; the first category that applies."""
    both = F.concat_ws(" ", name, remark)
    target = text.has_any(both, (*MATH_TERMS, *CS_TERMS, *CLASS_TERMS))
    barred = text.has_any(name, EXCLUDED_NAMES) | F.contains(both, F.lit("师范"))
    category = (
        F.when(barred, "excluded_major").when(text.has_any(name, MATH_TERMS), "core_math_stat").when(text.has_any(name, CS_TERMS), "core_cs_ai").when(text.has_any(name, CLASS_TERMS), "target_class")
        .when(text.has_any(name, TRIAL_TERMS) & target, "trial_class").when(target, "target_in_remark").otherwise("not_target")
    )
    is_ = lambda *names: category.isin(*names)
    risks = F.array(
        F.when(text.has_any(remark, RISKY_REMARKS), "contains_excluded_major_in_remark"), F.when(text.has_any(both, ("中外合作", "合作办学")), "sino_foreign"),
        F.when(text.has_any(both, ("校企", "产业学院")), "industry_or_enterprise_track"), F.when(is_("target_class", "trial_class"), "class_diversion"),
        F.when(is_("trial_class"), "trial_or_experimental_class"), F.when(is_("target_in_remark"), "target_only_in_remark"),
    )
    keep = ~is_("excluded_major", "not_target")
    return F.struct(keep.alias("keep"), category.alias("category"), numeric.scored(category, FIT).alias("fit"), F.when(keep, F.array_sort(F.array_compact(risks))).otherwise(F.array().cast("array<string>")).alias("risks"))


def impute(df: DataFrame, value: str, near: str, wide: str, share: float = 0.65) -> DataFrame:
    """df with predicted and certainty: the value, else medians of both groups mixed, of one of them, or of all rows."""
    by_near, by_wide, overall = (ranking.medians(df, by, value, name) for by, name in (([near], "_near"), ([wide], "_wide"), ([], "_all")))
    joined = df.join(by_near, near, "left").join(by_wide, wide, "left").join(F.broadcast(overall))  # one row
    both = F.col("_near").isNotNull() & F.col("_wide").isNotNull()
    predicted = F.coalesce(value, F.when(both, share * F.col("_near") + (1 - share) * F.col("_wide")), "_near", "_wide", "_all")
    certainty = F.when(F.col(value).isNotNull(), "history").when(both, "school_category_proxy").when(F.col("_near").isNotNull(), "school_proxy").when(F.col("_wide").isNotNull(), "category_proxy").otherwise("global_proxy")
    return joined.withColumn("predicted", predicted).withColumn("certainty", certainty).select(*df.columns, "predicted", "certainty")


def bonus(years: Column, plan: Column, delta: Column) -> Column:
    """Points for history, plan size and its change."""
    return (
        F.when(years >= 3, 5).when(years == 2, 3).otherwise(0) + F.when(plan >= 10, 4).when(plan >= 5, 2).otherwise(0) + F.when(delta >= 5, 3).when(delta <= -3, -4).otherwise(0)
    )


def prescreen(items: DataFrame, subjects: Sequence[str], degree: str = "本科") -> DataFrame:
    """Items that pass, with category, fit, risks, center, predicted, certainty, band, score, priority and pool_rank.

    items: item_id, college_code, college_name, major_name, remark, degree_level, subject_key, plan_count,
    tuition, history_years, rank_y1, rank_y2, rank_y3 and admitted_y1, admitted_y2, admitted_y3, oldest first.
    """
    ranks = [F.col(f"rank_y{i}").cast("double") for i in (1, 2, 3)]
    have = numeric.present(*ranks)
    rows = items.where((F.trim("degree_level") == degree) & filters.requirement_met(F.col("subject_key"), subjects) & ~text.has_any(F.col("college_name"), LOW_FIT_SCHOOLS))
    rows = rows.withColumn("_c", classify(F.col("major_name"), F.col("remark"))).where("_c.keep")
    plan = F.coalesce(F.col("plan_count").cast("double"), F.lit(0.0))
    latest = F.coalesce("admitted_y3", "admitted_y2", "admitted_y1")
    more = F.array(
        F.when(F.size(have) == 0, "new_no_history"), F.when(numeric.spread(have) >= 30_000, "high_rank_volatility"), F.when(plan <= 2, "small_plan"), F.when(F.col("tuition") >= 20_000, "very_high_tuition")
    )
    rows = rows.select(
        *items.columns, F.col("_c.category").alias("category"), F.col("_c.fit").alias("fit"), F.array_sort(F.concat("_c.risks", F.array_compact(more))).alias("risks"),
        numeric.weighted_mean(ranks, numeric.YEAR_WEIGHTS).alias("center"), numeric.spread(have).alias("volatility"), (plan - latest).alias("plan_delta"),
    )
    rows = impute(rows, "center", "college_code", "category").withColumn("band", numeric.rank_band(F.col("predicted")))
    score = F.col("fit") + numeric.scored(F.col("band"), numeric.BAND_SCORES) - numeric.penalty(F.col("risks")) + bonus(F.col("history_years"), plan, F.col("plan_delta"))
    rows = rows.withColumn("score", score.cast("double")).withColumn("priority", numeric.priority(F.col("score")))
    return ranking.numbered(rows, [F.desc("score"), F.desc("fit"), F.asc("predicted"), F.desc("plan_count"), F.asc("item_id")], "pool_rank")


def normalize_labels(df: DataFrame) -> DataFrame:
    """Labels within bounds: label_fit 0-100, label_priority 1-5, label_risk low, medium or high, label_exclude yes or no."""
    risk = text.lookup(F.lower(F.coalesce("label_risk", F.lit(""))), {"中": "medium", "高": "high", "低": "low"})
    out = text.lookup(F.lower(F.coalesce("label_exclude", F.lit(""))), {"是": "yes", "否": "no", "true": "yes", "false": "no"})
    return df.withColumns({
        "label_fit": numeric.clip(F.coalesce(text.number(F.col("label_fit")), F.lit(0.0)), 0.0, 100.0), "label_priority": numeric.clip(F.coalesce(text.number(F.col("label_priority")), F.lit(0.0)), 1.0, 5.0),
        "label_risk": F.when(risk.isin("low", "medium", "high"), risk).otherwise("medium"), "label_exclude": F.when(out.isin("yes", "no"), out).otherwise("no"),
    })


def fallback_labels(df: DataFrame) -> DataFrame:
    """Labels by rule, for rows of prescreen() that nobody labelled."""
    has = lambda f: F.array_contains("risks", f)
    loose, core = F.col("category").isin("target_class", "trial_class", "target_in_remark"), F.col("category").isin("core_math_stat", "core_cs_ai")
    barred = has("contains_excluded_major_in_remark")
    first = F.when(loose & (barred | has("class_diversion")), "high").when(loose, "medium").otherwise("low")
    risk = F.when((first == "low") & (has("sino_foreign") | has("very_high_tuition") | has("new_no_history")), "medium").otherwise(first)
    keep = F.when(loose & (first == "high"), 2).when(loose, 3).otherwise(4)
    keep = F.when(has("class_diversion") & (F.col("category") != "core_math_stat"), F.least(keep, F.lit(3))).otherwise(keep)
    keep = F.when(core & ~barred, F.when((F.col("fit") >= 96) & (risk == "low"), 5).otherwise(4)).otherwise(keep)
    keep = F.when(F.col("band") == "远保底", F.least(keep, F.lit(3))).otherwise(keep)
    return df.withColumns({"label_category": F.col("category"), "label_fit": F.col("fit").cast("int").cast("double"), "label_priority": keep.cast("double"), "label_risk": risk, "label_exclude": F.when(barred, "yes").otherwise("no")})


def final_score(df: DataFrame, profile: str = "balanced") -> DataFrame:
    """df with final_score: prescreen and labels weighed, less penalties; math_first favours mathematics."""
    score = (
        F.col("score") * 0.62 + F.col("label_fit") * 0.28 + F.col("label_priority") * 6 - numeric.scored(F.col("label_risk"), {"low": 0, "medium": 5, "high": 13}, 5)
        - F.when(F.col("label_exclude") == "yes", 45).otherwise(0) - F.when(F.col("label_category") == "reject", 28).otherwise(0)
    )
    if profile == "math_first":
        far = F.col("band").isin("保", "低优先保底", "远保底")
        score = score + F.when(F.col("category") == "core_math_stat", 9).when((F.col("category") == "core_cs_ai") & far, -12).when(F.col("category") == "core_cs_ai", -6).otherwise(0)
    return df.withColumn("final_score", score)


# Rows to select of each band.
QUOTAS = {"超冲": 35, "冲": 40, "贴合": 60, "稳": 65, "保": 60, "低优先保底": 30, "远保底": 10}


def select(df: DataFrame, profile: str = "balanced", n: int = 300, least: int = 30) -> DataFrame:
    """The n rows chosen by profile, numbered as final_rank: quotas by band, or mathematics first."""
    pool = df.where(~((F.col("label_exclude") == "yes") & (F.col("label_priority") <= 2)))
    order = [F.desc("final_score"), F.desc("label_priority"), F.desc("label_fit"), F.asc("predicted"), F.asc("item_id")]
    new = F.col("history_years") == 0
    if profile != "math_first":
        return ranking.select_by_quota(pool, "item_id", "band", QUOTAS, n, new, least, order)
    parts = [(F.col("category") == "core_math_stat", n * 2 // 3), (F.col("category") == "core_cs_ai", n // 3)]
    return ranking.select_two_parts(pool, "item_id", parts, n, new, least, order, [F.asc("final_score"), F.asc("item_id")])
