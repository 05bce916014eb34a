"""Profiles out of the ledger: one row per candidate, however many facts it has.

An ordinary candidate is ranked and collected behind one shuffle. Candidates
with very many facts are dealt to parts by the order of their facts; the lists
of one who lies in several parts are collected in part by every task before
they meet in the row of the candidate, in the same order. A row that
passes what one row can hold (2 GB) fails the job; the ledger itself has no
such bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import EXPERIENCE_TYPE, SECTION_NO
from ..functions import FIXED, Rules, as_ratio, mean_milli
from .ledger import (
    EMAILS,
    EXPERIENCE,
    LINKS,
    PHONES,
    SKILLS,
    WON,
    ledger_in_parts,
    ledger_in_place,
)
from .skew import HOT_LIMIT, Split, split_hot

LOCATION_TYPE = "struct<city:string,region:string,country:string>"
EDUCATION_TYPE = "array<struct<institution:string,degree:string,field:string,end_year:int>>"
PROFILE_COLUMNS = [
    "candidate_id", "full_name", "emails", "phones", "location", "links", "headline",
    "years_experience", "skills", "experience", "education", "provenance", "overall_confidence",
]


def _rows_of(section: int, columns: str, also: str = "true") -> Column:
    """Rows of a section in rank order."""
    return F.expr(
        f"sort_array(collect_list(CASE WHEN section_ord = {section} AND {also} THEN struct(seq, {columns}) END))"
    )


def _value_of(where: str) -> Column:
    return F.expr(f"max(CASE WHEN {where} THEN value END)")


def _with_items(rows: DataFrame) -> DataFrame:
    """What skills are collected by: the first row of an item is its most
    trusted one."""
    return rows.withColumns({"item_seq": F.col("item_r"), "trust": F.col("confidence_milli")})


def _collected(rows: DataFrame, *where: str, with_skills: bool = True) -> DataFrame:
    """One aggregate per candidate, whose rows lie together by the columns
    ``where``. For skills, rows carry in ``item_seq`` the rank of the first row
    of their item, and in ``trust`` its confidence."""
    link = f"section_ord = {LINKS}"
    skill_rows = [F.expr(
        f"sort_array(collect_list(CASE WHEN section_ord = {SKILLS} "
        "THEN struct(item_seq, seq, value, trust, source) END))"
    ).alias("skills")] if with_skills else []
    collected = rows.groupBy(*where, "candidate_id").agg(
        _value_of(f"section_ord = {SECTION_NO['full_name']} AND seq = 1").alias("full_name"),
        _value_of(f"section_ord = {SECTION_NO['headline']} AND seq = 1").alias("headline"),
        _value_of(f"{link} AND slot = 'linkedin'").alias("linkedin"),
        _value_of(f"{link} AND slot = 'github'").alias("github"),
        _rows_of(EMAILS, "value", "is_first").alias("emails"),
        _rows_of(PHONES, "value", "is_first").alias("phones"),
        _rows_of(LINKS, "value", "is_first AND startswith(slot, 'other:')").alias("other"),
        _rows_of(EXPERIENCE, "best_exp", "is_first").alias("experience"),
        *skill_rows,
        F.expr(
            "sort_array(collect_list(CASE WHEN prov_method IS NOT NULL "
            "THEN struct(section_ord, seq, field, source, prov_method, confidence_milli) END))"
        ).alias("provenance"),
        F.expr(f"sum({WON})").alias("won_sum"),
        F.expr(f"count({WON})").alias("won_n"),
    )
    decision = """transform(provenance, d -> struct(
      d.field AS field, d.source AS source, d.prov_method AS method, d.confidence_milli / 1000D AS confidence))"""
    out = collected.withColumns({
        "emails": F.expr("emails.value"),
        "phones": F.expr("phones.value"),
        "other": F.expr("other.value"),
        "experience": F.expr("experience.best_exp"),
        "provenance": F.expr(decision),
    })
    if not with_skills:
        return out
    # skill rows are sorted by skill: every skill is one run of the list
    heads = "filter(transform(skills, (s, i) -> struct(s, i AS at)), h -> h.s.seq = h.s.item_seq)"
    skill = """transform(_heads, (h, i) -> struct(
      h.s.value AS name, h.s.trust / 1000D AS confidence,
      transform(slice(skills, h.at + 1, coalesce(get(_heads, i + 1).at, size(skills)) - h.at), s -> s.source) AS sources))"""
    return out.withColumn("_heads", F.expr(heads)).withColumn("skills", F.expr(skill)).drop("_heads")


def _skills_across(rows: DataFrame) -> DataFrame:
    """Skills of hot candidates: first one row per skill, then one per candidate."""
    per_skill = rows.filter(F.col("section_ord") == SKILLS).groupBy("candidate_id", "slot").agg(
        F.min("seq").alias("item_seq"), F.min_by("value", "seq").alias("name"),
        F.min_by("confidence_milli", "seq").alias("trust"),
        F.expr("sort_array(collect_list(struct(seq, source))).source").alias("sources"))
    return per_skill.groupBy("candidate_id").agg(F.expr(
        "transform(sort_array(collect_list(struct(item_seq, name, trust, sources))), "
        "s -> struct(s.name AS name, s.trust / 1000D AS confidence, s.sources AS sources))").alias("skills"))


def _shape(rows: DataFrame) -> DataFrame:
    """The thirteen attributes; those without a merge rule stay empty."""
    return rows.select(
        "candidate_id",
        "full_name",
        "emails",
        "phones",
        F.lit(None).cast(LOCATION_TYPE).alias("location"),
        F.struct(
            F.col("linkedin"), F.col("github"), F.lit(None).cast("string").alias("portfolio"), F.col("other")
        ).alias("links"),
        "headline",
        F.lit(None).cast("double").alias("years_experience"),
        "skills",
        F.col("experience").cast(f"array<{EXPERIENCE_TYPE}>").alias("experience"),
        F.array().cast(EDUCATION_TYPE).alias("education"),
        "provenance",
        as_ratio(mean_milli(F.coalesce("won_sum", F.lit(0)), F.coalesce("won_n", F.lit(0)))).alias(
            "overall_confidence"
        ),
    )


def profiles_in_place(facts: DataFrame, rules: Rules = FIXED, tasks: int | None = None) -> DataFrame:
    """Profiles of ordinary candidates: one shuffle, shared by the ledger and
    the aggregate. Markers keep candidates without facts."""
    return _shape(_collected(_with_items(ledger_in_place(facts, rules, tasks))))


def profiles_across(hot: DataFrame, rules: Rules = FIXED) -> DataFrame:
    """Profiles of hot candidates: the same rows out of the distributed ledger.
    A candidate who lies in one part is collected there."""
    across = ledger_in_parts(hot, rules)
    merged = _collected(across.cut, with_skills=False).join(_skills_across(across.cut), "candidate_id", "left")
    # candidates whose many rows hold no fact at all still get a profile
    cut = across.ids.join(merged, "candidate_id", "left")
    kinds = dict(cut.dtypes)
    lists = ("emails", "phones", "other", "skills", "experience", "provenance")
    cut = cut.withColumns({n: F.coalesce(n, F.array().cast(kinds[n])) for n in lists})
    return _shape(_collected(_with_items(across.whole), "_part")).unionByName(_shape(cut))


def profiles(
    facts: DataFrame, limit: int = HOT_LIMIT, split: Split | None = None, rules: Rules = FIXED
) -> DataFrame:
    """Merged profiles of all candidates in the facts (and their markers). The
    limit chooses a plan; the rows are the same at any."""
    split = split or split_hot(facts, limit)
    out = profiles_in_place(split.regular, rules, split.tasks)
    if split.hot is not None:
        out = out.unionByName(profiles_across(split.hot, rules))
    return out
