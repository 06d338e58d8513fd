"""Tags and score factors from evidence, profile scores, and quality tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import numeric, text, udfs
from plumbline.operators import projection, ranking

# The most that each component counts, and the factors: label, component, weight.
COMPONENTS = {"alignment": 45, "platform": 25, "freedom": 15, "research": 10, "life": 5}
FACTORS = {
    "math_path_bias": ("数学路径偏心", "alignment", 7), "math_clean_path": ("数学主线干净", "alignment", 13), "math_plus_computation": ("数学+计算", "alignment", 11), "strong_math_core": ("数学核心强", "alignment", 9),
    "numerical_scientific_computing": ("数值计算/科学计算", "alignment", 7), "cs_systems_theory": ("CS 系统/理论路径", "alignment", 6), "systems_arch_algorithms": ("OS/体系结构/算法", "alignment", 5),
    "ai_theory_path": ("AI 理论路径", "alignment", 4), "ml_dl_foundation": ("ML/DL 基础", "alignment", 4), "low_off_scope_load": ("低偏离负担", "alignment", 8), "double_first_class": ("双一流", "platform", 6),
    "project_211": ("211工程", "platform", 5), "provincial_key": ("省重点/省部共建", "platform", 2), "doctoral_platform": ("博士点/博士平台", "platform", 9), "postdoctoral_platform": ("博士后平台", "platform", 4),
    "master_platform": ("硕士点/硕士平台", "platform", 4), "math_degree_platform": ("数学硕博平台", "platform", 10), "cs_doctoral_platform": ("计科博士平台", "platform", 8), "cs_master_platform": ("计科硕士平台", "platform", 4),
    "software_master_platform": ("软件工程硕士平台", "platform", 1), "national_first_class_major": ("国家一流专业", "platform", 5), "provincial_first_class_major": ("省一流专业", "platform", 2),
    "engineering_accreditation": ("工程认证", "platform", 1), "esi_cs_top_1pct": ("ESI 计科前1%", "platform", 5), "discipline_eval_a_plus": ("学科评估 A+", "platform", 12), "discipline_eval_a": ("学科评估 A", "platform", 11),
    "discipline_eval_a_minus": ("学科评估 A-", "platform", 10), "discipline_eval_b_plus": ("学科评估 B+", "platform", 7), "discipline_eval_b": ("学科评估 B", "platform", 5), "discipline_eval_b_minus": ("学科评估 B-", "platform", 3),
    "discipline_eval_c_plus": ("学科评估 C+", "platform", 1), "discipline_eval_c_minus": ("学科评估 C-", "platform", -1), "project101_confirmed": ("101计划明确参与", "platform", 3), "honors_innovation": ("拔尖/创新班", "research", 5),
    "research_training": ("科研训练", "research", 5), "postgraduate_signal": ("升学信号", "research", 4), "tutor_system": ("导师制/本科导师信号", "research", 3), "controlled_major_category": ("大类风险已可控", "freedom", 3),
    "low_time_tax_signal": ("低时间税信号", "freedom", 3), "good_dorm_signal": ("住宿正面信号", "life", 2), "sino_foreign_risk": ("中外合作风险", "freedom", -8), "tuition_risk": ("学费风险", "freedom", -10),
    "large_category_risk": ("大类/方向风险", "freedom", -12), "finance_business_load": ("金融/商业负担", "alignment", -14), "application_employment_heavy": ("应用/就业导向重", "alignment", -9),
    "software_job_training_load": ("软件就业训练负担", "alignment", -8), "robotics_control_lockin": ("机器人/控制绑定", "alignment", -12), "agri_med_bio_lockin": ("农医生命方向绑定", "alignment", -12),
    "energy_transport_lockin": ("能源/交通方向绑定", "alignment", -10), "industry_direction_offtarget": ("行业方向偏离", "alignment", -8), "campus_resource_risk": ("校区资源风险", "freedom", -5),
    "time_tax_risk": ("时间税/管理负担风险", "freedom", -5), "dorm_risk": ("住宿风险", "life", -3),
}
# Orders, caps, and words that speak of time taken.
CONFIDENCE_ORDER = {"low": 1, "derived": 1, "mixed": 2, "medium": 2, "high": 3, "user": 4}
STATUS_ORDER = {"not_found": 1, "source_mismatch_fixed": 2, "major_intro_only": 3, "course_grid": 4, "full_plan": 5}
STATUS_CAP = {"full_plan": 1.0, "course_grid": 0.96, "major_intro_only": 0.88, "source_mismatch_fixed": 0.74, "not_found": 0.65, "no_hard_panel": 0.82}
PREFERENCES = {"top": 1000, "like": 18, "unsure": -25, "ban": -10000}
TIME_TAX = (("强制晚自习", "强制早操", "强制查寝", "强制打卡", "强制跑操", "早打卡", "晚归登记", "就寝时间", "日常管理较细", "时间税信号", "高时间税"), ("早操", "晚自习", "早晚自习", "查寝"), ("开展", "要求", "规定", "必须"))
# Fixed values. Factors that words of the evidence, or of its risks, give unless negated: factor, confidence, words.
EVIDENCE_WORDS = (
    ("good_dorm_signal", "medium", ("上床下桌", "四人间", "四人寝", "独立卫浴", "独卫", "空调")), ("dorm_risk", "medium", ("宿舍紧张", "六人间", "八人间", "无独卫", "无空调")),
    ("finance_business_load", "high", ("金融", "证券", "期货", "投资", "保险", "经济预测", "金融量化")),
)
RISK_WORDS = (
    ("robotics_control_lockin", "medium", ("机器人", "自动化", "控制工程", "控制理论")), ("industry_direction_offtarget", "medium", ("制造", "车辆", "建造", "土木", "矿业", "冶金", "石油", "海洋渔业")),
    ("agri_med_bio_lockin", "medium", ("生物", "医学", "农业", "农学", "林学")),
)


def order_of(x: Column, names: dict[str, int]) -> Column:
    return numeric.scored(F.coalesce(x, F.lit("")), names, 0)


def tag_catalog(tags: DataFrame, key: str, aliases: dict[str, str]) -> DataFrame:
    """(key, label, confidence, evidence, sources): a row's tags under their proper labels.

    tags: key, label, confidence, evidence, source. The best confidence counts; at most three evidences,
    sorted, each once.
    """
    rows = tags.withColumn("label", text.lookup(F.col("label"), aliases)).where("label <> ''")
    return rows.groupBy(key, "label").agg(
        F.max_by("confidence", F.struct(order_of(F.col("confidence"), CONFIDENCE_ORDER), "confidence")).alias("confidence"),
        F.slice(F.array_sort(F.collect_set(text.blank_to_null(F.col("evidence")))), 1, 3).alias("evidence"), F.array_sort(F.collect_set("source")).alias("sources"),
    )


def evidence_quality(rows: DataFrame, panels: DataFrame, key: str, major: str) -> DataFrame:
    """(key, training_status, cap, hard_confidence, weak_confidence, project101, gaps) for every row.

    panels: key, kind, training_status, status, confidence, pos. The hard panel with the best status counts, the first of equals.
    """
    hard, weak, project = F.col("kind").isin("hard", "hard_rescue"), F.col("kind").isin("weak", "weak_rescue"), F.col("kind") == "project101"
    row = F.struct("training_status", "confidence")
    rank = F.struct(order_of(F.col("training_status"), STATUS_ORDER), -F.col("pos"))
    got = panels.groupBy(key).agg(
        F.max_by(row, F.when(hard, rank)).alias("h"), F.max_by("confidence", F.when(weak, order_of(F.col("confidence"), CONFIDENCE_ORDER))).alias("weak_confidence"),
        F.count_if(weak).alias("n_weak"), F.min_by("status", F.when(project, F.col("pos"))).alias("project101"), F.count_if(hard).alias("n_hard"),
    )
    out = rows.join(got, key, "left")
    status = F.when(F.coalesce("n_hard", F.lit(0)) > 0, F.coalesce("h.training_status", F.lit(""))).otherwise("no_hard_panel")
    gaps = F.array_compact(F.array(
        F.when(~status.isin("full_plan", "course_grid"), "training_plan"), F.when(F.coalesce("project101", F.lit("")).isin("unclear", "no_evidence", ""), "project101"),
        F.when(F.coalesce("n_weak", F.lit(0)) == 0, "no_weak_evidence").when(F.coalesce("weak_confidence", F.lit("")).isin("", "low", "mixed"), "weak_confidence"),
        F.when(F.contains(F.col(major), F.lit("大类")) | F.endswith(F.col(major), F.lit("类")), "category_rules"),
    ))
    return out.select(key, status.alias("training_status"), numeric.scored(status, STATUS_CAP, 0.82).alias("cap"), F.coalesce("h.confidence", F.lit("")).alias("hard_confidence"), F.coalesce("weak_confidence", F.lit("")).alias("weak_confidence"), F.coalesce("project101", F.lit("")).alias("project101"), gaps.alias("gaps"))


# Fixed values. What the texts say for a factor: the evidence shown and its source.
SAID = {
    "math_path_bias": ("数学/统计/信计路径符合数学优先策略。", "major_group"), "tutor_system": ("证据中出现本科导师或导师制信号。", "evidence_text"), "good_dorm_signal": ("弱证据中出现住宿正面信号。", "weak_evidence"),
    "low_time_tax_signal": ("弱证据中出现自由度正面信号。", "weak_evidence"), "time_tax_risk": ("弱证据中出现时间税或管理负担风险。", "weak_evidence"), "dorm_risk": ("弱证据中出现住宿风险。", "weak_evidence"),
    "finance_business_load": ("培养方向或课程证据中出现金融/证券/投资/经济应用负担。", "evidence_text"), "robotics_control_lockin": ("证据中出现机器人/控制绑定风险。", "evidence_text"),
    "industry_direction_offtarget": ("证据中出现行业方向绑定。", "evidence_text"), "agri_med_bio_lockin": ("证据中出现农医生命方向绑定。", "evidence_text"), "sino_foreign_risk": ("专业名称显示中外合作或中澳项目。", "major_name"),
}
MATH_GROUP, MATH_WORDS = "math_stat_info", ("数学", "信息与计算科学", "统计")


def score_factors(rows: DataFrame, tags: DataFrame, key: str, evidence: str, risk: str, major: str, group: str | None = None, panels: DataFrame | None = None) -> DataFrame:
    """(key, factor, confidence, evidence, sources): of tags whose label is a factor's, of panels, and of what the texts say.

    rows: key, the evidence, risk and major texts, and the code of the major's group. tags: key, label,
    confidence, and evidence and source where there are any. panels: key, kind, status, confidence, summary,
    source_file; those of kind project101 count if the participant is confirmed. The best confidence counts, the
    first of equals; at most three evidences, in order: the group, tags, panels, texts.
    """
    by_label = {label: k for k, (label, _, _) in FACTORS.items()} | {"国家一流本科专业": "national_first_class_major"}
    cell = lambda c: F.col(c) if c in tags.columns else F.lit("")
    named = tags.select(key, text.lookup(F.col("label"), by_label).alias("factor"), F.lit(1).alias("pos"), F.coalesce("confidence", F.lit("medium")).alias("confidence"), cell("evidence").alias("shown"), cell("source").alias("source")).where(F.col("factor").isin(*FACTORS))
    e, r, m = F.col(evidence), F.col(risk), F.col(major)
    # One pass of Python for each of the two texts.
    words = [*EVIDENCE_WORDS, ("low_time_tax_signal", "low", ("自由", "自主", "选课空间", "宽松"))]
    seen = rows.withColumns({"_e": udfs.contains_each(e, [w for _, _, w in words]), "_r": udfs.contains_each(r, [w for _, _, w in RISK_WORDS]), "_t": udfs.contains_asserted(e, *TIME_TAX)})
    bound = ~text.has_any(e, ("不自由", "不宽松", "自由度不足"))
    said = [(F.col("_e")[i] & (bound if k == "low_time_tax_signal" else F.lit(True)), k, c) for i, (k, c, _) in enumerate(words)] + [(F.col("_r")[i], k, c) for i, (k, c, _) in enumerate(RISK_WORDS)]
    grouped = (F.col(group) == MATH_GROUP) if group else F.lit(False)
    said += [
        (text.has_any(e, ("本科导师", "导师制")), "tutor_system", "medium"), (F.col("_t"), "time_tax_risk", "medium"), (text.has_any(m, ("中外合作", "中澳")), "sino_foreign_risk", "high"),
        (F.coalesce(grouped, F.lit(False)) | text.has_any(m, MATH_WORDS), "math_path_bias", "high"),
    ]
    entry = lambda k, c: F.struct(F.lit(k).alias("factor"), F.lit(0 if k == "math_path_bias" else 3).alias("pos"), F.lit(c).alias("confidence"), F.lit(SAID[k][0]).alias("shown"), F.lit(SAID[k][1]).alias("source"))
    found = named.unionByName(seen.select(key, F.explode(F.array_compact(F.array(*[F.when(c, entry(k, conf)) for c, k, conf in said]))).alias("f")).select(key, "f.*"))
    if panels is not None:
        confirmed = panels.where("kind = 'project101' and status = 'confirmed_participant'")
        found = found.unionByName(confirmed.select(key, F.lit("project101_confirmed").alias("factor"), F.lit(2).alias("pos"), F.coalesce("confidence", F.lit("medium")).alias("confidence"), F.col("summary").alias("shown"), F.col("source_file").alias("source")))
    shown = F.array_distinct(F.transform(F.array_sort(F.collect_set(F.when(F.col("shown") != "", F.struct("pos", "shown")))), lambda x: x["shown"]))
    return found.groupBy(key, "factor").agg(
        F.max_by("confidence", F.struct(order_of(F.col("confidence"), CONFIDENCE_ORDER), -F.col("pos"), "confidence")).alias("confidence"), F.slice(shown, 1, 3).alias("evidence"),
        F.array_sort(F.collect_set(text.blank_to_null(F.col("source")))).alias("sources"),
    )


def profile_scores(rows: DataFrame, factors: DataFrame, key: str, weights: dict[str, float], components: dict[str, str], most: dict[str, float] | None = None) -> DataFrame:
    """(key, quality_score): the base alignment and the weighted factors by component, positive sums up to the component's most, penalties whole, 0 to 100.

    rows: key, alignment_score, cap. factors: key, factor, confidence. The cap also scales positive alignment.
    """
    most = COMPONENTS if most is None else most
    weighed = factors.withColumn("w", numeric.scored(F.col("factor"), weights, 0.0)).where("w <> 0").withColumn("component", text.lookup(F.col("factor"), components))
    value = F.col("w") * numeric.confidence_factor(F.col("confidence"))
    each = weighed.join(rows.select(key, "cap"), key).select(key, "component", F.when((value > 0) & (F.col("component") == "alignment"), value * F.coalesce("cap", F.lit(1.0))).otherwise(value).alias("value"))
    base = rows.select(key, F.lit("alignment").alias("component"), (F.coalesce("alignment_score", F.lit(0.0)) / 100 * most.get("alignment", 0) * F.coalesce("cap", F.lit(1.0))).alias("value"))
    sums = each.unionByName(base).groupBy(key, "component").agg(F.sum(F.when(F.col("value") >= 0, F.col("value")).otherwise(0.0)).alias("plus"), F.sum(F.when(F.col("value") < 0, F.col("value")).otherwise(0.0)).alias("minus"))
    part = F.least("plus", numeric.scored(F.col("component"), most, 0).cast("double")) + F.col("minus")
    return sums.groupBy(key).agg(numeric.clip(F.sum(part), 0.0, 100.0).alias("quality_score"))


def final_scores(scores: DataFrame, key: str, region: Column, preference: Column, regions: dict[str, float]) -> DataFrame:
    """scores with score: quality plus region and preference, 0 to 120."""
    total = F.col("quality_score") + (numeric.scored(region, regions, 0.0) if regions else F.lit(0.0)) + numeric.scored(preference, PREFERENCES, 0)
    return scores.withColumn("score", numeric.clip(total.cast("double"), 0.0, 120.0))


def tiers(scores: DataFrame, key: str, rank: str, n: int = 3) -> DataFrame:
    """scores with quality_rank and tier over all rows: by score, then rank, 0 and null as if it were 999999."""
    return ranking.tiers(scores, [F.desc("score"), F.asc(F.coalesce(F.nullif(F.col(rank), F.lit(0)), F.lit(999_999))), F.asc(key)], n)


def merged_tags(base: DataFrame, own: DataFrame, label: str = "label") -> DataFrame:
    """The catalog with the user's own entries over those of the same label."""
    rest = [c for c in base.columns if c != label]
    joined = base.alias("b").join(own.alias("u"), label, "full_outer")
    return joined.select(label, *[F.when(F.col(f"u.{rest[0]}").isNotNull(), F.col(f"u.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in rest])


def evidence_panels(parts: dict[str, DataFrame], key: str, fields: Sequence[str], most: int = 1000) -> DataFrame:
    """(key, part, panels): the panels of all kinds, in order of kind and file, at most most in a part; keys may be lists joined by ;."""
    out = None
    for kind, df in parts.items():
        part = df.select(F.explode(text.split_tags(F.col(key), "listed")).alias(key), F.lit(kind).alias("kind"), *[(F.col(f) if f in df.columns else F.lit("")).alias(f) for f in fields])
        out = part if out is None else out.unionByName(part)
    return projection.in_parts(out, key, ["kind", *fields], "panels", most)
