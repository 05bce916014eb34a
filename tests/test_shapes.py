import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F

from goldweave.constants import FACT_SCHEMA
from goldweave.operators import skew
from goldweave.operators.profile import profiles
from goldweave.operators.project import ConfigError, accepted, lint, project, rejected
from goldweave.operators.storage import shared_folder
from goldweave.operators.validate import fault_table, validate_custom, validate_documents, validate_profiles
from goldweave.plans import Sources, consolidated, gather, run, run_to_folder, shaped
from goldweave.sources.sinks import documents

JOB = (("Acme", "Dev", "2022-01", None, ""),)


@pytest.fixture(scope="module")
def merged(spark):
    rows = [
        ("a", "full_name", "Asha", None, "resume", "direct", 800, 0, 0, 0),
        ("a", "phones", "+919876543210", None, "resume", "direct", 600, 0, 1, 0),
        ("a", "phones", "098765 43210", None, "resume", "direct", 600, 0, 2, 0),
        ("a", "emails", "a@x.io", None, "resume", "direct", 700, 0, 3, 0),
        ("a", "skills", "Go", None, "github", "direct", 700, 0, 4, 0),
        ("a", "links", "https://github.com/a", None, "github", "direct", 900, 0, 5, 0),
        ("a", "experience", None, ("Acme", "Dev", "2022/01", None, ""), "ats_json", "direct", 600, 0, 6, 0),
        ("b", "headline", "js", None, "github", "direct", 600, 0, 0, 0),
    ]
    table = profiles(spark.createDataFrame(rows, FACT_SCHEMA)).cache()
    yield table
    table.unpersist()


def docs(table, config, **options):
    rows = project(table, config, **options).collect()
    return {r.candidate_id: json.loads(r["_document"]) for r in rows}


def test_paths(merged):
    names = ["full_name", "emails[0]", "emails[4]", "phones[1]", "skills[].name", "skills[].level", "skills[0].name",
             "links.github", "unknown", "full_name[1]", "full_name[9]", "emails[].x", "location[0]", "links"]
    config = {"fields": [{"path": f"p{i}", "from": p} for i, p in enumerate(names)]}
    assert list(docs(merged, config)["a"].values()) == [
        "Asha", "a@x.io", None, "098765 43210", ["Go"], [None], None, None, None, "s", None, None, None,
        {"github": "https://github.com/a"},
    ]
    assert docs(merged, {"fields": [{"path": "links"}]})["b"] == {"links": {}}
    assert len(lint(merged, {"fields": [{"path": "x", "from": "links.github"}, {"path": "emails[0]"}]})) == 1


@pytest.mark.parametrize("path,rule", [("links[0]", None), ("overall_confidence[1]", None), ("skills", "canonical")])
def test_what_cannot_be_applied_is_a_config_error(merged, path, rule):
    with pytest.raises(ConfigError):
        project(merged, {"fields": [{"path": "x", "from": path, "normalize": rule}]})


def test_normalize(merged):
    config = {"fields": [
        {"path": "phone", "from": "phones[1]", "normalize": "E.164"},
        {"path": "phones", "normalize": "e164"},
        {"path": "name", "from": "full_name", "normalize": "e164"},
        {"path": "skills", "from": "skills[].name", "normalize": "CANONICAL"},
        {"path": "headline", "normalize": "canonical"},
        {"path": "plain", "from": "headline", "normalize": "unknown"},
    ]}
    out = docs(merged, config)
    assert out["a"] == {"phone": "+919876543210", "phones": ["+919876543210", "098765 43210"], "name": None,
                        "skills": ["Go"], "headline": None, "plain": None}
    assert out["b"]["headline"] == "JavaScript" and out["b"]["plain"] == "js"


REQUIRED = [{"path": "full_name", "required": True}, {"path": "headline"}, {"path": "phones", "required": True}]


def test_missing_null_and_unknown_word(merged):
    for word in ("null", "whatever"):
        out = docs(merged, {"fields": REQUIRED, "on_missing": word})
        assert out["b"] == {"full_name": None, "headline": "js", "phones": None}
    # a null value is present
    checked = validate_custom(project(merged, {"fields": REQUIRED}), {"fields": REQUIRED})
    assert checked.filter("_validation_errors IS NOT NULL").count() == 0


def test_missing_omit(merged):
    config = {"fields": REQUIRED, "on_missing": "omit"}
    out = docs(merged, config)
    assert out["b"] == {"headline": "js"}
    checked = validate_custom(project(merged, config), config)
    errors = {r.candidate_id: r["_validation_errors"] for r in checked.collect()}
    assert errors["a"] is None
    assert errors["b"] == ["Required field 'full_name' missing from projected output",
                           "Required field 'phones' missing from projected output"]


def test_missing_error(merged):
    config = {"fields": REQUIRED, "on_missing": "error"}
    out = project(merged, config)
    assert [r.candidate_id for r in accepted(out).collect()] == ["a"]
    (bad,) = rejected(out).collect()
    assert bad.errors == ["Required field 'full_name' is missing (source: 'full_name')",
                          "Required field 'phones' is missing (source: 'phones')"]
    with pytest.raises(PySparkException, match="Projection validation failed: Required field 'full_name'"):
        project(merged, config, strict=True).collect()


def test_later_output_of_one_name_counts_unless_left_out(merged):
    fields = [{"path": "v", "from": "full_name"}, {"path": "v", "from": "headline"}]
    assert {c: d for c, d in docs(merged, {"fields": fields, "on_missing": "omit"}).items()} == {
        "a": {"v": "Asha"}, "b": {"v": "js"}}
    assert docs(merged, {"fields": fields})["a"] == {"v": None}
    mixed = [{"path": "v", "from": "emails"}, {"path": "v", "from": "headline"}]
    assert docs(merged, {"fields": mixed, "on_missing": "omit"}) == {"a": {"v": ["a@x.io"]}, "b": {"v": "js"}}


def test_confidence_block(merged):
    out = docs(merged, {"fields": [{"path": "provenance", "from": "full_name"}], "include_confidence": True})
    assert out["b"] == {"provenance": [{"field": "headline", "source": "github", "method": "direct", "confidence": 0.6}],
                        "overall_confidence": 0.6}


def test_default_document(merged):
    rows = documents(validate_profiles(merged).drop("_faults")).collect()
    out = {d["candidate_id"]: d for d in (json.loads(r.value) for r in rows)}
    assert out["a"]["_validation_errors"] == [
        "phone '098765 43210' is not E.164 normalized",
        "experience date 'start': '2022/01' must be in YYYY-MM format",
    ]
    assert out["b"] == {
        "candidate_id": "b", "full_name": None, "emails": [], "phones": [], "location": None,
        "links": {"linkedin": None, "github": None, "portfolio": None, "other": []}, "headline": "js",
        "years_experience": None, "skills": [], "experience": [], "education": [],
        "provenance": [{"field": "headline", "source": "github", "method": "direct", "confidence": 0.6}],
        "overall_confidence": 0.6,
    }


def test_value_rules_on_typed_profiles(merged):
    odd = merged.filter("candidate_id = 'a'").withColumn("candidate_id", F.lit("")).withColumn(
        "location", F.struct(F.lit("Oslo").alias("city"), F.lit("East").alias("region"), F.lit("Norway").alias("country"))
    ).withColumn("overall_confidence", F.lit(1.5))
    rules = [r.rule for r in fault_table(validate_profiles(odd)).orderBy("error_no").collect()]
    assert rules == ["V1", "V4", "V6", "V11", "V14"]


def faults(spark, **changes):
    base = {
        "candidate_id": "c1", "full_name": "N", "emails": ["a@b.co"], "phones": ["+91"],
        "location": {"city": "B", "region": None, "country": "IN"}, "links": {"github": "g", "other": []},
        "headline": None, "years_experience": 4, "skills": [{"name": "Go", "confidence": 0.5, "sources": []}],
        "experience": [{"company": "C", "title": "T", "start": "2022-01", "end": None, "summary": ""}],
        "education": [{"institution": "I", "degree": None, "field": None, "end_year": 2020}],
        "provenance": [{"field": "f", "source": "s", "method": "m"}], "overall_confidence": 0.5,
    }
    base.update(changes)
    doc = json.dumps({k: v for k, v in base.items() if v != "ABSENT"})
    df = spark.createDataFrame([(doc,)], "d string")
    return [tuple(r) for r in fault_table(validate_documents(df, "d")).orderBy("error_no").select("rule", "message").collect()]


@pytest.mark.parametrize("changes,rules", [
    ({}, []),
    ({"emails": "ABSENT", "links": "ABSENT", "skills": "ABSENT", "overall_confidence": "ABSENT"}, []),
    ({"candidate_id": ""}, ["V1"]), ({"candidate_id": "ABSENT"}, ["V1"]),
    ({"full_name": 5, "headline": []}, ["V2", "V2"]),
    ({"emails": None}, ["V3"]), ({"emails": [1, None]}, ["V3", "V3"]),
    ({"phones": ["", "98"]}, ["V4"]), ({"phones": {}}, ["V4"]), ({"phones": [7]}, ["V4"]),
    ({"location": "x"}, ["V5"]), ({"location": {"zip": 1}}, ["V5"]),
    ({"location": {"country": "india"}}, ["V6"]), ({"location": {"country": "I1"}}, []), ({"location": {"country": "12"}}, ["V6"]),
    ({"location": {"country": 5}}, ["V6"]),
    ({"links": []}, ["V7"]), ({"links": {"blog": "b", "other": None}}, ["V7", "V7"]),
    ({"years_experience": "4"}, ["V8"]), ({"years_experience": True}, []),
    ({"skills": {}}, ["V9"]), ({"skills": ["x", {}]}, ["V9", "V9"]),
    ({"skills": [{"name": 1, "confidence": "x", "sources": "s"}]}, ["V9"] * 3),
    ({"experience": ["x"]}, ["V10"]), ({"experience": [{"company": "C"}]}, ["V10"] * 4),
    ({"experience": [{"company": "C", "title": "T", "start": "2022/01", "end": 5, "summary": ""}]}, ["V11", "V11"]),
    ({"education": [{}]}, ["V12"] * 4), ({"education": 5}, ["V12"]),
    ({"provenance": [{"field": "f"}, 3]}, ["V13"] * 3),
    ({"overall_confidence": 1.01}, ["V14"]), ({"overall_confidence": -1}, ["V14"]), ({"overall_confidence": 1}, []),
])
def test_document_rules(spark, changes, rules):
    assert [f[0] for f in faults(spark, **changes)] == rules


def test_document_messages(spark):
    job = {"company": "Lumen", "title": "Surveyor", "start": "2019-04", "end": "May 2020", "summary": "maps"}
    assert faults(spark, location={"zip": 1, "country": "Nor", "area": 2}, experience=[job], overall_confidence=2.0) == [
        ("V5", "location key 'zip' is invalid; must be city, region, or country"),
        ("V5", "location key 'area' is invalid; must be city, region, or country"),
        ("V6", "location country 'Nor' must be a 2-character ISO-3166 alpha-2 uppercase string"),
        ("V11", "experience date 'end': 'May 2020' must be in YYYY-MM format"),
        ("V14", "overall_confidence out of [0,1] range: 2.0"),
    ]


# --- the whole job --------------------------------------------------------------------

def three_ids(spark):
    """One person in three sources, one with a broken record, one without any."""
    recruiter = spark.createDataFrame(
        [("k7", 0, "Nadia  Petrov", "NADIA@home.test", "0 44556 67788", "Lumen Works", "Cartographer")],
        "candidate_id string, record_ord bigint, name string, email string, phone string, current_company string, title string")
    ats = spark.createDataFrame([
        ("k7", 0, json.dumps({"full_name": "Nadia Petrova", "email": "np@lumen.test", "current_company": "LUMEN WORKS",
                              "title": "cartographer"})),
        ("k7", 1, json.dumps({"name": "", "employer": "Atlas & Co", "currentTitle": "Surveyor"})),
        ("k8", 0, "17"),
    ], "candidate_id string, record_ord bigint, payload string")
    host = spark.createDataFrame([
        ("k7", 0, json.dumps({"login": "npmaps", "bio": "maps and tiles"}),
         json.dumps([{"language": "rust"}, {"name": "no language"}, {"language": "k8s"}, {"language": "rust"}])),
    ], "candidate_id string, record_ord bigint, profile string, repos string")
    people = spark.createDataFrame([("k9",), ("k7",)], "candidate_id string")
    return Sources(recruiter=recruiter, ats_json=ats, code_host_json=host, candidates=people)


def test_end_to_end(spark):
    """Names lose by priority, a job repeated in other case is one job, a broken
    record leaves its candidate with an empty profile."""
    out = {r.candidate_id: r for r in run(three_ids(spark)).output.collect()}
    assert set(out) == {"k7", "k8", "k9"}
    k7 = out["k7"]
    assert (k7.full_name, k7.phones, k7.headline) == ("Nadia Petrov", ["+914455667788"], "maps and tiles")
    assert k7.emails == ["nadia@home.test", "np@lumen.test"]
    assert [s.name for s in k7.skills][0] == "Rust" and len(k7.skills) == 2
    assert [(e.company, e.title) for e in k7.experience] == [("LUMEN WORKS", "cartographer"), ("Atlas & Co", "Surveyor")]
    assert [p.method for p in k7.provenance if p.field == "experience"] == ["direct", "direct", "merged-duplicate:direct"]
    assert k7.links.github.endswith("/npmaps") and k7["_validation_errors"] is None
    for empty in ("k8", "k9"):
        assert out[empty].overall_confidence == 0.0 and out[empty].provenance == []


SHORT = {"on_missing": "error", "fields": [
    {"path": "second", "from": "emails[1]", "required": True}, {"path": "links"}, {"path": "jobs", "from": "experience[].title"}]}


@pytest.mark.parametrize("limit,ids", [(0, 10_000), (3, 10_000), (3, 0), (40, 10_000)])
def test_every_output_is_the_same_at_any_limit(spark, monkeypatch, limit, ids):
    def outputs(at):
        plain, short = run(three_ids(spark), limit=at), run(three_ids(spark), SHORT, limit=at)
        tables = [documents(plain.output), documents(short.output), short.rejects, plain.errors, short.errors,
                  plain.quarantine, consolidated(three_ids(spark), at)]
        return [sorted(map(repr, t.collect())) for t in tables]

    want = outputs(20_000)
    monkeypatch.setattr(skew, "MAX_BROADCAST_IDS", ids)
    assert outputs(limit) == want
    assert want[1] == [repr(Row(value='{"second":"np@lumen.test","links":{"github":"https://github.com/npmaps"},'
                                      '"jobs":["cartographer","Surveyor"]}'))]


def test_paths_meet_the_attributes_only(spark, merged):
    config = {"fields": [{"path": "a", "from": "page"}, {"path": "b", "from": "emails[99999999999]"},
                         {"path": 'c\n"', "from": "full_name"}]}
    result = shaped(merged, config)
    shown = [json.loads(r["_document"]) for r in result.output.filter("candidate_id = 'a'").collect()]
    assert shown == [{"a": None, "b": None, 'c\n"': "Asha"}]
    assert len(result.warnings) == 1
    with pytest.raises(ConfigError):
        project(merged, {"fields": [{"path": "_document"}]})


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Session:
        conf = {}
        sparkContext = type("Context", (), {
            "master": "spark://somewhere:7077", "getConf": staticmethod(lambda: {}),
            "_jsc": type("J", (), {"sc": staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(
                lambda: type("None_", (), {"isEmpty": staticmethod(lambda: True)}))}))})})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(type("F", (), {"conf": type("C", (), {"get": staticmethod(lambda *a: None)}),
                                     "sparkContext": Session.sparkContext}))


def test_rows_without_an_id_are_quarantined(spark):
    ats = spark.createDataFrame([
        (None, 0, json.dumps({"name": "Ann", "email": "ann@x.io"})), (" ", 0, json.dumps({"name": "Bob"})),
        ("z", 0, json.dumps({"name": "Zed"})), (None, 1, json.dumps({"name": 5}))],
        "candidate_id string, record_ord bigint, payload string")
    done = run(Sources(ats_json=ats))
    assert [(r.candidate_id, r.full_name) for r in done.output.collect()] == [("z", "Zed")]
    assert [tuple(r) for r in done.quarantine.collect()] == [(None, "ats_json", "missing id", 3)]


def test_empty_config_is_the_default_shape(spark, merged):
    assert shaped(merged, {}).output.columns == shaped(merged).output.columns


def test_no_source_is_an_error():
    with pytest.raises(ValueError):
        gather(Sources())


def test_job_writes_all_tables(spark, tmp_path):
    at = run_to_folder(three_ids(spark), str(tmp_path / "run"), {
        "short": {"fields": [{"path": "headline", "required": True}], "on_missing": "error"}})
    assert spark.read.parquet(at["profiles"]).count() == 3
    assert spark.read.parquet(at["provenance"]).count() == 12
    assert [r.reason for r in spark.read.parquet(at["quarantine"]).collect()] == ["not an object"]
    assert spark.read.text(at["short"]).collect() == [('{"headline":"maps and tiles"}',)]
    assert {r.candidate_id for r in spark.read.parquet(at["short_rejects"]).collect()} == {"k8", "k9"}
    assert spark.read.text(at["documents"]).count() == 3
    assert spark.read.parquet(at["unmerged"]).count() == 0
    assert spark.read.parquet(at["short_errors"]).count() == 0


def test_a_broken_job_goes_on_after_its_last_table(spark, tmp_path, monkeypatch):
    from goldweave.plans import job

    config = {"short": {"fields": [{"path": "headline"}]}}
    folder, scratch = tmp_path / "run", tmp_path / "scratch"
    monkeypatch.setattr("goldweave.operators.storage.shared_folder", lambda session: str(scratch))
    merges = []
    monkeypatch.setattr(job, "profiles", lambda *a: merges.append(1) or profiles(*a))
    monkeypatch.setattr(job, "validate_profiles", lambda table: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_to_folder(three_ids(spark), str(folder), config, limit=2)
    left = {p.name for p in folder.iterdir()}
    assert {"profiles", "unmerged", "quarantine", "rejects", "_facts", "_manifest"} <= left and "documents" not in left
    monkeypatch.undo()
    monkeypatch.setattr("goldweave.operators.storage.shared_folder", lambda session: str(scratch))
    monkeypatch.setattr(job, "profiles", lambda *a: 1 / 0)
    at = run_to_folder(three_ids(spark), str(folder), config, limit=2)
    assert merges == [1]
    assert {p.name for p in folder.iterdir()} == {
        "profiles", "documents", "provenance", "validation", "unmerged", "quarantine", "rejects", "shape_short",
        "shape_short_errors", "shape_short_rejects", "_manifest"}
    assert not scratch.exists() or not list(scratch.iterdir())
    assert spark.read.text(at["documents"]).count() == 3
    # a finished run is only read, another one is refused
    assert run_to_folder(three_ids(spark), str(folder), config, limit=2) == at
    with pytest.raises(ValueError, match="other sources"):
        run_to_folder(three_ids(spark), str(folder), {"short": {"fields": [{"path": "emails"}]}}, limit=2)


def test_rejects_are_counted_while_the_facts_are_written(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", 1, "Ann", "no address", "123", "", "Dev"), ("a", 2, "later", "x", "x", "x", "x"), ("b", 1, "  ", "b@x.io", None, "Co", "T")],
        "candidate_id string, record_ord bigint, name string, email string, phone string, current_company string, title string")
    more = spark.createDataFrame([("a", "salary", "1", "crm")], "candidate_id string, field string, value string, source string")
    at = run_to_folder(Sources(recruiter=rows, facts=[more]), str(tmp_path / "run"))
    assert {tuple(r) for r in spark.read.parquet(at["rejects"]).collect()} == {
        ("full_name", "recruiter_csv", 2, 0, 1), ("emails", "recruiter_csv", 2, 0, 1), ("phones", "recruiter_csv", 2, 1, 1),
        ("experience.company", "recruiter_csv", 2, 1, 0), ("experience.title", "recruiter_csv", 2, 0, 0)}
    assert [tuple(r) for r in spark.read.parquet(at["unmerged"]).collect()] == [("salary", "crm", 1)]


def test_rules_of_a_run(spark):
    from goldweave.functions import FIXED, rules_from

    def winner(rules, *claims):
        table = spark.createDataFrame(
            [("a", "headline", v, s) for v, s in claims], "candidate_id string, field string, value string, source string")
        (row,) = run(Sources(facts=[table]), rules=rules).output.collect()
        return row.headline, row.provenance[0].confidence

    both = [("of crm", "crm"), ("of resume", "resume")]
    assert winner(FIXED, *both) == ("of resume", 0.5)
    priors = spark.createDataFrame([(None, "crm", 600), ("headline", "resume", 600)], "field string, source string, prior_milli int")
    assert winner(rules_from(priors), *both) == ("of resume", 0.6)
    places = spark.createDataFrame([("crm", 2.5)], "source string, place double")
    assert winner(rules_from(priors, places), *both) == ("of crm", 0.6)
    unknown = spark.createDataFrame([(None, 0)], "source string, place int")
    assert winner(rules_from(priors, unknown), *both) == ("of crm", 0.6)
    base = spark.createDataFrame([(None, None, 700)], "field string, source string, prior_milli int")
    assert winner(rules_from(base), ("x", "nobody")) == ("x", 0.7)
    for rows in ([("headline", "crm", 1001)], [("headline", "crm", 1), ("headline", "crm", 2)], [("headline", None, 5)]):
        with pytest.raises(ValueError):
            rules_from(spark.createDataFrame(rows, "field string, source string, prior_milli int"))


def test_another_source_is_a_fact_table(spark, merged):
    extra = spark.createDataFrame(
        [("a", "headline", "Lead", None, "linkedin", "direct", 900, 5, 0, 0)], FACT_SCHEMA)
    (row,) = consolidated(Sources(facts=[extra])).collect()
    assert (row.headline, row.overall_confidence) == ("Lead", 0.9)
