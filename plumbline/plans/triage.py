"""Triage of rows into keep, borderline and drop, with the reasons for each.

A rule is a condition and a reason; a row's reasons are those of its rules, sorted, each once. Dropping
goes before borderline, and that before keep.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text

KEEP, BORDERLINE, DROP = "keep_for_deep_crawl", "borderline_review", "drop_by_light_crawl"
Rules = Sequence[tuple[Column, str]]


def reasons(rules: Rules) -> Column:
    """Sorted reasons of the rules that hold; a null condition does not."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in rules])))) if rules else F.array().cast("array<string>")


def triage(df: DataFrame, drop: Rules, borderline: Rules, notes: Rules = (), names: Sequence[str] = (KEEP, BORDERLINE, DROP)) -> DataFrame:
    """df with triage_bucket, drop_reasons, borderline_reasons and audit_notes, joined by ;."""
    out = df.withColumns({"_d": reasons(drop), "_b": reasons(borderline), "_n": reasons(notes)})
    bucket = F.when(F.size("_d") > 0, names[2]).when(F.size("_b") > 0, names[1]).otherwise(names[0])
    return out.withColumns({"triage_bucket": bucket, "drop_reasons": F.array_join("_d", ";"), "borderline_reasons": F.array_join("_b", ";"), "audit_notes": F.array_join("_n", ";")}).drop("_d", "_b", "_n")


def reason_counts(df: DataFrame, column: str) -> DataFrame:
    """(reason, n), most frequent first."""
    parts = F.filter(F.split(column, ";"), lambda r: r != "")
    return df.select(F.explode(parts).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason")


# Terms of the domain's rules.
DRIFT_NAMES = ("金融", "经济", "审计", "法学", "治理", "民航", "海事", "海洋", "农业", "林业", "水利", "石油", "电力", "劳动", "就业", "外语", "语言", "财经", "政法")
DRIFT_EVIDENCE = ("finance", "financial", "economics", "economic", "audit", "auditing", "law", "governance", "civil aviation", "aviation", "maritime", "agriculture", "labor", "employment", "foreign-language", "foreign language", "language-plus", "market research", "consulting", "teacher-oriented", "industry-oriented", "application oriented", "applied ai route", "not a pure", "not direct", "not ai-centered", "not ai-native", "not ai-specialized", "moderate ai-path fit only", "weakly evidenced fit")
UNRELATED = ("软件工程", "网络工程", "物联网", "数字媒体", "数据科学与大数据", "数据科学", "大数据", "通信工程", "电子信息", "机器人工程", "机械", "环境", "木材", "风景园林", "食品", "生物", "经济统计", "金融", "法学", "管理")
GUARANTEES = ("任选", "自选专业", "自由选择", "专业任选", "类内专业任选", "分流时上述专业任选", "第四学期末在同一实验班内自选专业")
TARGETS = ("计算机科学与技术", "人工智能", "智能科学与技术", "信息与计算科学", "数学与应用数学", "数理基础科学", "数据计算及应用", "统计学", "应用统计学")
WEAK_RESOURCES = ("not_found", "not found", "under-evidenced", "weak signal", "weakly evidenced", "school-level context", "school-level only", "no program-level", "no project-specific", "no direct research resource", "research depth appears limited", "only weak official signals", "does not support a strong", "too thin for a strong")
JOINT = ("中外合作", "合作办学", "内地与港澳台合作", "高水平大学学生交流", "全英文", "英文教学", "英文授课", "sino_foreign")
OPTIONAL_COST = ("可选择", "自愿", "自由选择", "可在国内学习4年", "可在国内学习四年", "也可", "可申请")
MANDATORY_COST = ("须赴", "必须赴", "第四学年须", "第4学年须", "3+1", "2+2")
EXTERNAL_COST = ("外方学费", "外方收费", "英方收费", "外方高校学费", "学费另计", "国外学习阶段", "赴英期间学费", "赴英期间", "澳元", "新西兰元", "国际学生标准")
LOW_BANDS, STRONG_BANDS = ("低优先保底", "远保底"), ("超冲", "冲", "贴合", "稳", "保")
CORE, LOOSE = ("core_math_stat", "core_cs_ai"), ("target_class", "trial_class", "target_in_remark")
STRONG_SCHOOLS = ("双一流", "2011计划", "省重点建设高校")
WEAK_SCHOOLS = ("学院", "民办", "独立学院", "职业", "商学院", "科技学院", "文理学院")

#: Columns that the domain's triage reads, all strings; those absent count as blank.
COLUMNS = ("college_name", "major_name", "major_category", "remark", "risk_flags", "risk_tags", "prescreen_priority", "prescreen_score", "rank_band", "crawl_status", "agent_confidence", "quality_grade", "source_ids", "source_ref_count", "has_source", "low_information", "has_training_plan_url", "has_recommendation_source", "has_dorm_source", "tuition", "tuition_raw", "core_courses_summary", "ai_path_fit_notes", "math_foundation_notes", "cs_ai_foundation_notes", "research_resources_notes", "recommendation_policy_notes", "learning_freedom_notes", "dorm_campus_notes", "next_deep_questions")


def tuition(raw: Column, value: Column, international: Column) -> Column:
    """struct<rmb, note>: the raw price, in ten thousands where it says so, else the number, whose unit is inferred for joint programmes."""
    squeezed = F.regexp_replace(raw, r"(?U)\s+", "")
    wan = F.regexp_extract(squeezed, r"([0-9]+(?:\.[0-9]+)?)万", 1).try_cast("double")
    plain, n = text.first_number(squeezed), text.number(value, True)
    case = (
        F.when(wan.isNotNull(), F.struct((wan * 10_000).alias("rmb"), F.lit("raw_wan").alias("note"))).when(plain.isNotNull(), F.struct(plain.alias("rmb"), F.lit("raw_number").alias("note")))
        .when(n.isNull(), F.struct(F.lit(None).cast("double").alias("rmb"), F.lit("missing").alias("note"))).when(international & (n > 0) & (n <= 20), F.struct((n * 10_000).alias("rmb"), F.lit("inferred_wan").alias("note")))
        .when(international & (n > 20) & (n < 300), F.struct((n * 1_000).alias("rmb"), F.lit("inferred_thousand").alias("note"))).otherwise(F.struct(n.alias("rmb"), F.lit("number").alias("note")))
    )
    return case


def foreign_cost(found: Column, tags: Column) -> Column:
    """none, possible_optional, required_or_unpriced or possible_unclear, of what a programme abroad costs besides; found: the terms in its words."""
    return (
        F.when(~_has(found, EXTERNAL_COST), "none").when(_has(found, OPTIONAL_COST), "possible_optional")
        .when(_has(found, MANDATORY_COST) | F.array_contains(tags, "mandatory_abroad"), "required_or_unpriced").otherwise("possible_unclear")
    )


def _has(found: Column, terms: Sequence[str]) -> Column:
    return F.arrays_overlap(found, F.array(*map(F.lit, terms)))


def features(df: DataFrame) -> DataFrame:
    """df with the helper columns of the domain's rules, names beginning with t_."""
    df = df.withColumns({c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in df.columns else F.lit("") for c in COLUMNS})
    words = lambda *names: F.concat_ws(" ", *names)
    any_of = lambda array, *names: F.arrays_overlap(array, F.array(*[F.lit(n) for n in names]))
    refs = F.size(text.split_sources(F.col("source_ids")))
    out = df.withColumns({"t_tags": text.tag_set(F.col("risk_tags")), "t_flags": text.tag_set(F.col("risk_flags")), "t_refs": F.coalesce(text.number(F.col("source_ref_count"), True).cast("int"), refs)})
    # Each text that several lists ask of is scanned once for the terms of all of them.
    out = out.withColumns({
        "t_school": text.terms_in(F.col("college_name"), (*STRONG_SCHOOLS, *WEAK_SCHOOLS)), "t_remark": text.terms_in(F.col("remark"), (*TARGETS, *UNRELATED)),
        "t_cost": text.terms_in(words("remark", "risk_tags", "next_deep_questions"), (*EXTERNAL_COST, *OPTIONAL_COST, *MANDATORY_COST)),
    })
    said = lambda c, otherwise: F.when(F.col(c) != "", text.flag(F.col(c))).otherwise(otherwise)
    low_info = said("low_information", (F.col("crawl_status") == "not_found") | (refs == 0))
    out = out.withColumns({"t_low": low_info, "t_source": said("has_source", refs > 0), "t_strong": _has(F.col("t_school"), STRONG_SCHOOLS)})
    absent = sum((F.when((F.col(c) != "") & ~text.flag(F.col(c)), 1).otherwise(0) for c in ("has_training_plan_url", "has_recommendation_source", "has_dorm_source")), F.lit(0))
    missing = (
        F.when(F.col("crawl_status") == "not_found", 2).otherwise(0) + F.col("t_low").cast("int") + F.when(F.col("t_refs") == 0, 1).otherwise(0)
        + F.when(F.col("quality_grade") == "needs_rerun", 2).when(F.col("quality_grade") == "low_coverage", 1).otherwise(0) + absent
    )
    core, p, band = F.col("major_category").isin(*CORE), F.col("prescreen_priority"), F.col("rank_band")
    score = F.coalesce(text.number(F.col("prescreen_score"), True), F.lit(0.0))
    ceiling = (
        F.when(F.col("t_strong") & core & p.isin("A", "B"), "high").when((band == "远保底") | (p == "C") | (score < 88), "low").when(_has(F.col("t_school"), WEAK_SCHOOLS) & band.isin(*LOW_BANDS), "low")
        .when(F.array_contains("t_flags", "very_high_tuition") & p.isin("B", "C"), "low").when((band == "低优先保底") & ((p == "B") | F.array_contains("t_tags", "remote_or_weak_resource")), "low")
        .when(~F.col("t_strong") & ~core & (p != "A"), "low").when(F.col("t_strong") | band.isin("超冲", "冲", "贴合") | (score >= 115), "high").otherwise("medium")
    )
    price = tuition(F.col("tuition_raw"), F.col("tuition"), text.has_any(words("college_name", "major_name", "remark", "risk_flags", "risk_tags"), JOINT))
    cost = foreign_cost(F.col("t_cost"), F.col("t_tags"))
    evidence = F.lower(words("core_courses_summary", "ai_path_fit_notes", "math_foundation_notes", "cs_ai_foundation_notes", "research_resources_notes", "next_deep_questions"))
    drift = reasons([(text.has_any(words("college_name", "major_name", "remark"), DRIFT_NAMES), "domain_name_or_remark_drift"), (text.has_any(evidence, DRIFT_EVIDENCE), "light_crawl_alignment_drift")])
    own_choice = (_has(F.col("t_remark"), TARGETS) & ~_has(F.col("t_remark"), UNRELATED)) | text.has_any(words("remark", "core_courses_summary", "ai_path_fit_notes", "next_deep_questions"), GUARANTEES)
    structural = F.col("major_category").isin(*LOOSE) | any_of("t_flags", "class_diversion", "target_only_in_remark")
    barred = F.array_contains("t_flags", "contains_excluded_major_in_remark")
    diversion = reasons([
        (structural, "class_or_target_only_diversion"), (F.array_contains("t_tags", "major_diversion_risk"), "light_crawl_major_diversion"), (barred, "excluded_major_in_remark"),
        ((structural | barred) & text.has_any(words("major_name", "remark"), UNRELATED), "unrelated_major_in_diversion_pool"), (own_choice, "selection_guarantee_signal"),
    ])
    poor = F.lower(words("research_resources_notes", "recommendation_policy_notes", "learning_freedom_notes", "dorm_campus_notes", "next_deep_questions"))
    resource = reasons([
        (F.array_contains("t_tags", "remote_or_weak_resource"), "remote_or_weak_resource_tag"), (F.array_contains("t_tags", "campus_move"), "campus_move_tag"),
        (text.has_any(poor, WEAK_RESOURCES), "resource_or_policy_evidence_weak"), ((F.col("t_refs") <= 1) & ~text.flag(F.col("has_recommendation_source")), "resource_sources_sparse"),
    ])
    return out.withColumns({"core_missing_count": missing, "ceiling_level": ceiling, "t_price": price, "foreign_extra_cost_status": cost, "alignment_flags": drift, "diversion_flags": diversion, "resource_flags": resource})


def domain_rules(limit: int) -> tuple[Rules, Rules, Rules]:
    """Drop, borderline and note rules over features()."""
    tag = lambda n: F.array_contains("t_tags", n)
    flag = lambda n: F.array_contains("t_flags", n)
    align, divert, poor = (lambda n, c=c: F.array_contains(c, n) for c in ("alignment_flags", "diversion_flags", "resource_flags"))
    p, band, ceiling, missing = F.col("prescreen_priority"), F.col("rank_band"), F.col("ceiling_level"), F.col("core_missing_count")
    low_band, weak_p = band.isin(*LOW_BANDS), p.isin("B", "C")
    price, cost = F.col("t_price.rmb"), F.col("foreign_extra_cost_status")
    off, manual = tag("off_target_courses"), (p == "A") & band.isin(*STRONG_BANDS) & (F.col("t_refs") >= 2)
    diverted = flag("class_diversion") | flag("target_only_in_remark") | F.col("major_category").isin(*LOOSE)
    unsafe = diverted & (tag("major_diversion_risk") | flag("contains_excluded_major_in_remark"))
    free = divert("selection_guarantee_signal")
    remote, managed = tag("remote_or_weak_resource"), tag("management_heavy_signal")
    thin = F.col("t_low") | F.col("quality_grade").isin("needs_rerun", "low_coverage") | (F.col("agent_confidence") == "low")
    managed_out, remote_out = managed & (weak_p | low_band | remote), remote & thin & (weak_p | low_band)
    lost = F.col("crawl_status") == "not_found"
    lost_out = lost & ((p == "C") | low_band)
    hopeless = (missing >= 5) & (ceiling == "low") & ~F.col("t_strong")
    drop = [
        (price > limit, f"tuition_over_{limit}_rmb"),
        (cost == "required_or_unpriced", "required_or_unpriced_foreign_phase_cost"),
        (off & ~manual, "off_target_courses_with_weak_context"),
        ((off | align("light_crawl_alignment_drift")) & ceiling.isin("low", "medium") & ((missing >= 3) | low_band | weak_p) & ~((p == "A") & ~low_band & (missing < 3)), "training_direction_low_alignment"),
        (align("domain_name_or_remark_drift") & align("light_crawl_alignment_drift") & (ceiling != "high"), "domain_drift_with_limited_upside"),
        (unsafe, "unsafe_major_diversion"),
        ((divert("class_or_target_only_diversion") | divert("unrelated_major_in_diversion_pool")) & ~free & (ceiling != "high"), "uncontrolled_diversion_risk"),
        (divert("excluded_major_in_remark") & divert("unrelated_major_in_diversion_pool") & ~free & (ceiling != "high"), "excluded_major_mix_without_selection_guarantee"),
        (managed_out, "management_heavy_or_training_burden_signal"),
        (remote_out, "weak_resource_signal_with_low_evidence"),
        (poor("remote_or_weak_resource_tag") & poor("resource_or_policy_evidence_weak") & ceiling.isin("low", "medium") & (missing >= 2), "campus_resource_obviously_weak"),
        (poor("campus_move_tag") & poor("resource_or_policy_evidence_weak") & (ceiling == "low"), "campus_resource_obviously_weak"),
        (lost_out, "not_found_and_low_prescreen_priority"),
        (hopeless | ((missing >= 3) & (missing < 5) & (ceiling == "low") & (p != "A") & ~F.col("t_strong")), "multiple_core_info_missing_low_ceiling"),
    ]
    borderline = [
        (cost.isin("possible_optional"), "possible_optional"), (cost.isin("possible_unclear"), "possible_unclear"), (F.abs(price - limit) < 1e-6, "tuition_at_limit_check_strictness"),
        (off & manual, "off_target_courses_need_manual_confirmation"), (F.size("alignment_flags") > 0, "possible_training_direction_drift"),
        (~unsafe & (diverted | tag("major_diversion_risk")), "major_diversion_or_department_unclear"),
        (F.size(F.array_remove("diversion_flags", "selection_guarantee_signal")) > 0, "diversion_risk_needs_manual_check"), (managed & ~managed_out, "management_heavy_signal"),
        (remote & ~remote_out, "remote_or_weak_resource_signal"), (F.size("resource_flags") > 0, "campus_or_resource_weak_signal"), (tag("dorm_negative_signal"), "dorm_negative_signal"),
        (~F.col("major_category").isin(*CORE), "non_core_major_category"), (lost & ~lost_out, "crawl_not_found"), (~lost & F.col("t_low"), "low_information_light_crawl"),
        (F.col("quality_grade") == "needs_rerun", "shard_quality_needs_rerun"), (F.col("quality_grade") == "low_coverage", "shard_quality_low_coverage"), (~F.col("t_source"), "no_referenced_source"),
        ((missing >= 5) & ~hopeless, "multiple_core_info_missing"),
    ]
    notes = [(flag(n) | tag(n), n) for n in ("small_plan", "new_no_history")] + [(flag("high_rank_volatility"), "high_rank_volatility"), (flag("sino_foreign") | tag("sino_foreign"), "sino_foreign_not_negative_by_itself")]
    return drop, borderline, notes


def triage_items(df: DataFrame, limit: int = 50_000) -> DataFrame:
    """The domain's triage of rows with COLUMNS: bucket, reasons and notes besides the helper columns, flags joined by ;."""
    out = triage(features(df), *domain_rules(limit))
    joined = {c: F.array_join(c, ";") for c in ("alignment_flags", "diversion_flags", "resource_flags")}
    return out.withColumns(joined | {"tuition_rmb_estimate": F.bround("t_price.rmb", 2), "tuition_parse_note": F.col("t_price.note"), "source_ref_count_triage": F.col("t_refs")}).drop("t_tags", "t_flags", "t_refs", "t_low", "t_source", "t_strong", "t_price", "t_school", "t_remark", "t_cost")
