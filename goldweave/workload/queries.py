"""Registered queries: one per operator, each over whole tables.

Results are flat (lists as text or as rows, confidences in thousandths), so
that rows can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ATS
from ..functions import (
    clean_text, email_address, mean_milli, phone_e164, prior_of, rules_from, skill_name, year_month,
)
from ..operators import ledger as led
from ..operators.project import accepted, project, rejected
from ..operators.quarantine import isolate, quarantine
from ..operators.reports import REJECTS, Watch, reject_report
from ..operators.skew import HOT_LIMIT
from ..operators.storage import new_folder
from ..operators.validate import (
    ERRORS, fault_counts, fault_table, validate_custom, validate_documents, validate_profiles,
)
from ..plans import Gathered, Sources, consolidated, gather
from ..sources import ats, code_host, recruiter, without_markers
from ..sources.sinks import write_documents
from . import roles

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(make: Query) -> Query:
    REGISTERED[make.__name__] = make
    return make


def _gathered(spark: SparkSession, folder: str) -> Gathered:
    return gather(roles.sources(spark, folder))


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    return _gathered(spark, folder).ledger()


def _profiles(spark: SparkSession, folder: str, limit: int = HOT_LIMIT) -> DataFrame:
    return consolidated(roles.sources(spark, folder), limit)


def _milli(ratio: Column) -> Column:
    return F.round(ratio * 1000).cast("int")


def _flat(facts: DataFrame) -> DataFrame:
    return without_markers(facts).select(
        "candidate_id", "field", "value", F.col("exp.company").alias("company"),
        F.col("exp.title").alias("title"), F.col("exp.start").alias("start"),
        F.col("exp.summary").alias("summary"), "source", "method", "confidence_milli",
        "source_ord", "record_ord", "emit_ord",
    )


# --- scans --------------------------------------------------------------------

@query
def scan_recruiter(spark: SparkSession, folder: str) -> DataFrame:
    """Recruiter CSV files with two different headers in one folder."""
    table = roles.recruiter(spark, folder)
    target = new_folder(spark, "recruiter")
    even = F.col("record_ord") % 2 == 0
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    first = ["candidate_id", "name", "email", "phone", "current_company", "title"]
    second = ["title", "phone", "record_ord", "candidate_id", "email", "name"]
    table.filter(even).select(first).write.options(**options).csv(f"{target}/a")
    table.filter(~even).select(second).write.options(**options).csv(f"{target}/b")
    rows = recruiter.read_recruiter_csv(spark, [f"{target}/a", f"{target}/b"])
    return rows.select("candidate_id", *[F.coalesce(c, F.lit("")).alias(c) for c in first[1:]])


@query
def scan_ats(spark: SparkSession, folder: str) -> DataFrame:
    """Applicant-tracking JSON lines, attributes picked by alias."""
    target = new_folder(spark, "ats")
    roles.ats(spark, folder).write.json(target)
    return ats.pick_json(ats.read_ats_json(spark, target)).drop("position", "blank")


@query
def scan_profile(spark: SparkSession, folder: str) -> DataFrame:
    target = new_folder(spark, "profiles")
    roles.profile(spark, folder).write.json(target)
    return code_host.read_profiles(spark, target)


def _placed(rows: DataFrame) -> DataFrame:
    """Files that Spark wrote have names of their own; their folder has not."""
    return rows.withColumn("file", F.regexp_extract("file", "part=([0-9]+)", 1))


def _lines_in_folders(lines: DataFrame, target: str) -> str:
    """Lines (part, at, value) as one file per part, in the order of `at`."""
    lines.repartition("part").sortWithinPartitions("part", "at").select("part", "value").write.partitionBy("part").text(target)
    return target


@query
def scan_ats_files(spark: SparkSession, folder: str) -> DataFrame:
    """Facts and quarantine of JSON lines as systems export them: no record
    number, cut off lines, lists, repeated keys, NaN, no id."""
    target = _lines_in_folders(roles.ats_lines(spark, folder), new_folder(spark, "ats-lines"))
    gathered = gather(Sources(ats_json=ats.read_ats_json(spark, target)))
    return _facts_and_quarantine(gathered)


@query
def scan_repos(spark: SparkSession, folder: str) -> DataFrame:
    """Repository lists out of JSON lines: one row per repository."""
    target = _lines_in_folders(roles.repo_lines(spark, folder), new_folder(spark, "repo-lines"))
    return code_host.read_repos(spark, target)


def _host_files(spark: SparkSession, folder: str) -> Gathered:
    profiles = _lines_in_folders(roles.profile_lines(spark, folder), new_folder(spark, "profile-lines"))
    repos = _lines_in_folders(roles.repo_lines(spark, folder), new_folder(spark, "repo-lines"))
    return gather(Sources(profile_json=code_host.read_profile_lines(spark, profiles),
                          repos_json=code_host.read_repo_lists(spark, repos)))


@query
def quarantine_code_host(spark: SparkSession, folder: str) -> DataFrame:
    """Broken profiles, and broken lists of candidates with a profile."""
    return _placed(_host_files(spark, folder).quarantine)


@query
def repo_facts_json(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of code-host files: a broken record takes along all of them."""
    return _flat(_host_files(spark, folder).facts)


def _facts_and_quarantine(gathered: Gathered) -> DataFrame:
    facts = _flat(gathered.facts).select(
        "candidate_id", "field", "value", "company", "title", "record_ord", F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("string").alias("file"), F.lit(None).cast("bigint").alias("line"))
    bad = _placed(gathered.quarantine).select(
        "candidate_id", *[F.lit(None).cast(t).alias(c) for c, t in facts.dtypes[1:6]], "reason", "file", "line")
    return facts.unionByName(bad)


# --- extraction ----------------------------------------------------------------

@query
def recruiter_first_row(spark: SparkSession, folder: str) -> DataFrame:
    return recruiter.first_row(roles.recruiter(spark, folder))


@query
def recruiter_facts(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(recruiter.recruiter_facts(roles.recruiter(spark, folder)))


@query
def ats_alias(spark: SparkSession, folder: str) -> DataFrame:
    return ats.pick_columns(roles.ats(spark, folder))


@query
def ats_facts(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(ats.ats_facts(ats.pick_columns(roles.ats(spark, folder))))


@query
def profile_facts(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(code_host.profile_facts(roles.profile(spark, folder)))


@query
def repo_skills(spark: SparkSession, folder: str) -> DataFrame:
    return code_host.distinct_languages(roles.repos(spark, folder)).withColumn(
        "skill", skill_name(F.col("language"))
    )


@query
def repo_gate(spark: SparkSession, folder: str) -> DataFrame:
    return code_host.repos_with_profile(roles.repos(spark, folder), roles.profile(spark, folder))


@query
def field_value_union(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_gathered(spark, folder).facts)


@query
def prior_lookup(spark: SparkSession, folder: str) -> DataFrame:
    facts = without_markers(_gathered(spark, folder).facts)
    return (
        facts.groupBy("field", "source", "method", "confidence_milli")
        .agg(F.count("*").alias("n_facts"))
        .withColumn("prior_milli", prior_of(F.col("field"), F.col("source")))
    )


@query
def extra_source(spark: SparkSession, folder: str) -> DataFrame:
    """Headlines under rules of a run: a source of its own with a prior and a
    place, another prior for a known source and for all fields of one."""
    priors = spark.createDataFrame(
        [("headline", "crm", 900), ("headline", "resume", 950), (None, "job_board", 910)],
        "field string, source string, prior_milli int")
    places = spark.createDataFrame([("crm", -0.5)], "source string, place double")
    gathered = gather(Sources(facts=roles.unrated_facts(spark, folder)), rules=rules_from(priors, places))
    return gathered.ledger().filter(f"{led.SINGLE} AND seq = 1").select(
        "candidate_id", "field", "value", "source", "confidence_milli")


@query
def run_report(spark: SparkSession, folder: str) -> DataFrame:
    """What normalization dropped, counted while the facts are written."""
    watch = Watch()
    gathered = gather(roles.sources(spark, folder), watch=watch)
    gathered.facts.write.parquet(new_folder(spark, "facts"))
    return spark.createDataFrame(watch.report(), REJECTS)


@query
def quarantine_table(spark: SparkSession, folder: str) -> DataFrame:
    return quarantine(ats.pick_json(roles.ats_json(spark, folder)), ATS)


@query
def quarantine_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts that remain when broken records take their source along."""
    return _flat(ats.ats_facts(isolate(ats.pick_json(roles.ats_json(spark, folder)))))


# --- normalization ---------------------------------------------------------------

@query
def norm_phone(spark: SparkSession, folder: str) -> DataFrame:
    return roles.recruiter(spark, folder).select("record_ord", "phone", phone_e164(F.col("phone")).alias("e164"))


@query
def norm_email(spark: SparkSession, folder: str) -> DataFrame:
    return roles.recruiter(spark, folder).select("record_ord", "email", email_address(F.col("email")).alias("address"))


@query
def norm_skill(spark: SparkSession, folder: str) -> DataFrame:
    return roles.repos(spark, folder).select("repo_pos", "language", skill_name(F.col("language")).alias("skill"))


@query
def norm_date(spark: SparkSession, folder: str) -> DataFrame:
    raw = roles.date_texts(spark, folder)
    return raw.select("record_ord", "raw", year_month(F.col("raw")).alias("year_month"))


@query
def norm_text(spark: SparkSession, folder: str) -> DataFrame:
    """Whole document texts, with the vowels in full width."""
    clean = clean_text(F.col("text"))
    return roles.wide_documents(spark, folder).select("doc_id", F.length(clean).alias("n"), F.md5(clean).alias("digest"))


@query
def norm_report(spark: SparkSession, folder: str) -> DataFrame:
    """Values in, empty and rejected per field; free texts are no addresses."""
    rows = roles.recruiter(spark, folder)
    docs = roles.table(spark, folder, "documents")
    dates = roles.date_texts(spark, folder)
    phone, email, raw, text = (F.col(c) for c in ("phone", "email", "raw", "text"))
    return (
        reject_report(rows, "recruiter_csv", {
            "phones": (phone, phone_e164(phone)), "emails": (email, email_address(email))})
        .unionByName(reject_report(dates, "orders", {"dates": (raw, year_month(raw))}))
        .unionByName(reject_report(docs, "documents", {
            "phones": (text, phone_e164(text)), "emails": (text, email_address(text))}))
    )


# --- merge -------------------------------------------------------------------------

@query
def winner_single(spark: SparkSession, folder: str) -> DataFrame:
    rows = _ledger(spark, folder)
    return rows.filter(f"{led.SINGLE} AND seq = 1").select(
        "candidate_id", "field", "value", "source", "method", "confidence_milli"
    )


def _decisions(rows: DataFrame) -> DataFrame:
    return led.provenance(rows)


@query
def prov_single(spark: SparkSession, folder: str) -> DataFrame:
    return _decisions(_ledger(spark, folder).filter(led.SINGLE))


@query
def prov_exp(spark: SparkSession, folder: str) -> DataFrame:
    return _decisions(_ledger(spark, folder).filter(F.col("section_ord") == led.EXPERIENCE))


@query
def provenance(spark: SparkSession, folder: str) -> DataFrame:
    return _decisions(_ledger(spark, folder))


@query
def overall_conf(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _ledger(spark, folder)
        .groupBy("candidate_id")
        .agg(F.expr(f"coalesce(sum({led.WON}), 0) AS won_sum"), F.expr(f"count({led.WON}) AS won_n"))
        .withColumn("overall_milli", mean_milli(F.col("won_sum"), F.col("won_n")))
    )


@query
def unmerged_fields(spark: SparkSession, folder: str) -> DataFrame:
    return led.unmerged(_gathered(spark, folder).facts)


@query
def multi_union(spark: SparkSession, folder: str) -> DataFrame:
    table = _profiles(spark, folder)
    return table.select(
        "candidate_id",
        F.explode(F.array(
            F.struct(F.lit("emails").alias("field"), F.col("emails").alias("items")),
            F.struct(F.lit("phones").alias("field"), F.col("phones").alias("items")),
        )).alias("f"),
    ).select("candidate_id", "f.field", F.posexplode("f.items").alias("pos", "value"))


@query
def skills_agg(spark: SparkSession, folder: str) -> DataFrame:
    skills = _profiles(spark, folder).select("candidate_id", F.posexplode("skills").alias("pos", "s"))
    return skills.select(
        "candidate_id", "pos", F.col("s.name").alias("name"),
        _milli(F.col("s.confidence")).alias("confidence_milli"),
        F.array_join("s.sources", ",").alias("sources"),
    )


@query
def exp_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = _profiles(spark, folder).select("candidate_id", F.posexplode("experience").alias("pos", "e"))
    return rows.select("candidate_id", "pos", *[F.col(f"e.{c}").alias(c) for c in
                                                      ("company", "title", "start", "summary")])


@query
def links_class(spark: SparkSession, folder: str) -> DataFrame:
    links = F.col("links")
    return _profiles(spark, folder).select(
        "candidate_id", links["github"].alias("github"), links["linkedin"].alias("linkedin"),
        links["portfolio"].alias("portfolio"), F.array_join(links["other"], " ").alias("other"),
    )


# --- profiles -------------------------------------------------------------------------

def _text_of(items: str, entry: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(items, entry), ";")


def flat_profiles(table: DataFrame) -> DataFrame:
    """All attributes of the profile, lists as text."""
    return table.select(
        "candidate_id",
        "full_name",
        F.array_join("emails", ";").alias("emails"),
        F.array_join("phones", ";").alias("phones"),
        F.col("links.linkedin").alias("linkedin"),
        F.col("links.github").alias("github"),
        F.array_join("links.other", ";").alias("other_links"),
        "headline",
        _text_of("skills", lambda s: F.concat_ws(
            ":", s["name"], _milli(s["confidence"]).cast("string"), F.array_join(s["sources"], "+"))).alias("skills"),
        _text_of("experience", lambda e: F.concat_ws(
            "|", e["company"], e["title"], F.coalesce(e["start"], F.lit("-")), e["summary"])).alias("experience"),
        F.size("education").alias("n_education"),
        _text_of("provenance", lambda p: F.concat_ws(
            "|", p["field"], p["source"], p["method"], _milli(p["confidence"]).cast("string"))).alias("provenance"),
        _milli(F.col("overall_confidence")).alias("overall_milli"),
    )


@query
def profile_default(spark: SparkSession, folder: str) -> DataFrame:
    """The full consolidation: all sources, default shape."""
    return flat_profiles(_profiles(spark, folder))


@query
def profile_across(spark: SparkSession, folder: str) -> DataFrame:
    """The same through the plan for candidates with very many facts."""
    return flat_profiles(_profiles(spark, folder, limit=40))


@query
def profile_empty(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates on a list of their own: those without a fact get a profile too."""
    people = roles.table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("candidate_id"))
    table = consolidated(Sources(
        profiles=roles.profile(spark, folder), repos=roles.repos(spark, folder), candidates=people
    ))
    return flat_profiles(table)


@query
def profile_json(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as JSON lines with their errors, and read back."""
    target = new_folder(spark, "documents")
    write_documents(validate_profiles(_profiles(spark, folder)).drop("_faults"), target)
    # all attributes out of one pass over the document
    names = ["candidate_id", "full_name", "provenance", "_validation_errors", "overall_confidence"]
    return spark.read.text(target).select("value", F.json_tuple("value", *names).alias(*names)).select(
        "candidate_id",
        "full_name",
        F.array_join(F.json_object_keys("value"), ",").alias("keys"),
        F.json_array_length("provenance").alias("n_provenance"),
        F.coalesce(F.json_array_length("_validation_errors"), F.lit(0)).alias("n_errors"),
        _milli(F.col("overall_confidence").cast("double")).alias("overall_milli"),
    )


# --- shapes -----------------------------------------------------------------------------

CUSTOM = {
    "on_missing": "null",
    "fields": [
        {"path": "headline"},
        {"path": "contact", "from": "emails[1]", "required": True},
        {"path": "callback", "from": "phones[1]", "normalize": "e164"},
        {"path": "knows", "from": "skills[].name", "normalize": "canonical"},
    ],
    "include_confidence": True,
}
PATHS = {
    "fields": [
        {"path": "headline"},
        {"path": "second_email", "from": "emails[1]"},
        {"path": "far_phone", "from": "phones[5]"},
        {"path": "initial", "from": "full_name[0]"},
        {"path": "late_letter", "from": "full_name[40]"},
        {"path": "companies", "from": "experience[].company"},
        {"path": "no_such_part", "from": "skills[].level"},
        {"path": "dotted", "from": "links.github"},
        {"path": "nested", "from": "skills[0].name"},
        {"path": "unknown"},
        {"path": "letters", "from": "emails[].x"},
    ],
}
NORMALIZE = {
    "fields": [
        {"path": "headline", "normalize": "Canonical"},
        {"path": "name_as_phone", "from": "full_name", "normalize": " e.1.6.4 "},
        {"path": "emails", "normalize": "E164"},
        {"path": "mails_as_skills", "from": "emails", "normalize": "canonical"},
        {"path": "companies", "from": "experience[].company", "normalize": "canonical"},
        {"path": "full_name", "normalize": "other"},
    ],
}
MISSING = {
    "fields": [
        {"path": "phones", "required": True},
        {"path": "headline", "required": True},
        {"path": "overall_confidence"},
        {"path": "links"},
        {"path": "education"},
    ],
    "on_missing": "whatever",
}
OMIT = {
    "fields": [
        {"path": "full_name", "required": True},
        {"path": "phone", "from": "phones[0]", "required": True},
        {"path": "headline"},
        {"path": "emails", "required": True},
        {"path": "headline", "from": "phones[1]"},
        {"path": "jobs", "from": "experience[].end"},
    ],
    "on_missing": "omit",
}
ERROR = {
    "fields": [
        {"path": "full_name", "required": True},
        {"path": "phone", "from": "phones[0]", "required": True},
        {"path": "link", "from": "headline", "required": True},
        {"path": "second", "from": "phones[1]"},
    ],
    "on_missing": "error",
}


@query
def project_custom(spark: SparkSession, folder: str) -> DataFrame:
    out = project(_profiles(spark, folder), CUSTOM)
    return out.select(
        "candidate_id", "headline", "contact", "callback", F.array_join("knows", ";").alias("knows"),
        _milli(F.col("overall_confidence")).alias("overall_milli"), F.size("provenance").alias("n_provenance"),
        F.array_join(F.json_object_keys("_document"), ",").alias("keys"),
    )


@query
def project_paths(spark: SparkSession, folder: str) -> DataFrame:
    out = project(_profiles(spark, folder), PATHS)
    return out.select(
        "candidate_id", "headline", "second_email", "far_phone", "initial", "late_letter",
        F.array_join("companies", ";").alias("companies"), F.size("no_such_part").alias("no_such_part"),
        "dotted", "nested", "unknown", F.array_join("letters", ";").alias("letters"),
    )


@query
def project_normalize(spark: SparkSession, folder: str) -> DataFrame:
    out = project(_profiles(spark, folder), NORMALIZE)
    return out.select(
        "candidate_id", "headline", "name_as_phone", F.array_join("emails", ";").alias("emails"),
        F.array_join("mails_as_skills", ";").alias("mails_as_skills"),
        F.array_join("companies", ";").alias("companies"), "full_name",
    )


@query
def project_missing(spark: SparkSession, folder: str) -> DataFrame:
    out = project(_profiles(spark, folder), MISSING)
    return out.select(
        "candidate_id", F.array_join("phones", ";").alias("phones"), "headline",
        _milli(F.col("overall_confidence")).alias("overall_milli"),
        F.col("links").isNull().alias("no_links"), F.col("education").isNull().alias("no_education"),
        F.size("_projection_errors").alias("n_errors"),
        F.array_join(F.json_object_keys("_document"), ",").alias("keys"),
    )


@query
def project_omit(spark: SparkSession, folder: str) -> DataFrame:
    return project(_profiles(spark, folder), OMIT).select("candidate_id", F.col("_document").alias("document"))


@query
def project_error(spark: SparkSession, folder: str) -> DataFrame:
    return rejected(project(_profiles(spark, folder), ERROR)).select(
        "candidate_id", F.array_join("errors", "; ").alias("errors")
    )


@query
def project_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(project(_profiles(spark, folder), ERROR)).select(
        "candidate_id", "full_name", "phone", "link", "second"
    )


# --- validation ---------------------------------------------------------------------------

@query
def validate_default(spark: SparkSession, folder: str) -> DataFrame:
    checked = validate_documents(roles.foreign_documents(spark, folder), "document")
    return fault_table(checked, "row_id").withColumn("error_no", F.col("error_no") + 1)


@query
def validate_counts(spark: SparkSession, folder: str) -> DataFrame:
    return fault_counts(validate_documents(roles.foreign_documents(spark, folder), "document"))


@query
def validate_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Errors of the merged profiles themselves."""
    return validate_profiles(_profiles(spark, folder)).filter(F.col(ERRORS).isNotNull()).select(
        "candidate_id", F.array_join(ERRORS, "; ").alias("errors")
    )


@query
def validate_shape(spark: SparkSession, folder: str) -> DataFrame:
    checked = validate_custom(project(_profiles(spark, folder), OMIT), OMIT)
    return checked.filter(F.col(ERRORS).isNotNull()).select(
        "candidate_id", F.array_join(ERRORS, "; ").alias("errors")
    )


def registered() -> dict[str, Query]:
    """Queries under the names of the survey."""
    renamed = {"quarantine_table": "quarantine", "validate_shape": "validate_custom"}
    return {renamed.get(name, name): make for name, make in REGISTERED.items()}

