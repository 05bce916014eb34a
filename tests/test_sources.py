import json

from pyspark.sql import functions as F

from goldweave.operators.quarantine import isolate, quarantine, without_broken
from goldweave.sources import ats, code_host, recruiter, without_markers

TABLE = "candidate_id string, record_ord bigint, name string, email string, phone string, current_company string, title string"


def facts(df):
    rows = without_markers(df).orderBy("candidate_id", "source_ord", "record_ord", "emit_ord").collect()
    return [(r.candidate_id, r.field, r.value if r.exp is None else (r.exp.company, r.exp.title), r.method,
             r.confidence_milli) for r in rows]


def test_recruiter_facts_come_from_the_first_row_only(spark):
    table = spark.createDataFrame([
        ("a", 2, "Second", "s@x.io", "9876543210", "C", "T"),
        ("a", 1, " Asha  Verma ", "A@X.io", "09876543210", "Co", "Dev"),
        ("b", 1, "", "bad", "123", "Co", ""),
    ], TABLE)
    df = recruiter.recruiter_facts(table)
    assert facts(df) == [
        ("a", "full_name", "Asha Verma", "direct", 850),
        ("a", "emails", "a@x.io", "direct", 900),
        ("a", "phones", "+919876543210", "normalized", 900),
        ("a", "experience", ("Co", "Dev"), "direct", 400),
    ]
    # the second candidate has no fact but stays on the list
    assert df.filter("field IS NULL").select("candidate_id").collect() == [("b",)]


def csv_rows(spark, folder, files, **options):
    for name, text in files.items():
        (folder / name).write_text(text)
    df = recruiter.read_recruiter_csv(spark, str(folder), **options)
    return df


def test_csv_columns_are_found_by_name_in_every_file(spark, tmp_path):
    df = csv_rows(spark, tmp_path, {
        "a.csv": "candidate_id,name,email,phone,current_company,title\n1,Ann,a@x.io,1,C,T\n\n2,\"B, \"\"q\"\"\",b@x.io\n",
        "b.csv": "title,candidate_id,extra,name\nBoss,3,zz,Cid,too,many\n",
        "c.csv": "foo,bar\nbaz,qux\n",
        "d.csv": "﻿name,candidate_id,name\nold,4,new\n",
    })
    got = sorted([tuple("" if v is None else v for v in r) for r in df.drop("position").collect()])
    assert got == [
        ("", "", "", "", "", ""),
        ("1", "Ann", "a@x.io", "1", "C", "T"),
        ("2", 'B, "q"', "b@x.io", "", "", ""),
        ("3", "Cid", "", "", "", "Boss"),
        ("4", "new", "", "", "", ""),
    ]


def test_wrong_header_gives_no_facts(spark, tmp_path):
    df = csv_rows(spark, tmp_path, {"c.csv": "foo,bar\nbaz,qux\n"})
    assert facts(recruiter.recruiter_facts(df)) == []


def test_csv_first_row_by_position_and_quoted_newline(spark, tmp_path):
    df = csv_rows(spark, tmp_path, {"a.csv": 'candidate_id,name\n7,"An\nn"\n7,Other\n'}, multi_line=True)
    assert facts(recruiter.recruiter_facts(df)) == [("7", "full_name", "An n", "direct", 850)]


def ats_rows(spark, payloads):
    return spark.createDataFrame([(c, i, p) for i, (c, p) in enumerate(payloads)],
                                 "candidate_id string, record_ord bigint, payload string")


def test_ats_aliases_and_blanks(spark):
    picked = ats.pick_json(ats_rows(spark, [
        ("a", json.dumps({"candidateName": "", "full_name": "Full", "contactEmail": None, "email": "E@x.io",
                          "employer": "Co", "currentTitle": "  ", "title": "unused"})),
        ("b", json.dumps({"candidateName": "   ", "name": "no fallback", "employer": "C", "title": "T x"})),
        ("c", json.dumps({"candidateName": 0, "full_name": [], "name": "Zero \"q\" é"})),
    ]))
    assert [r.reason for r in picked.collect()] == [None, None, None]
    assert facts(ats.ats_facts(picked)) == [
        ("a", "full_name", "Full", "direct", 850),
        ("a", "emails", "e@x.io", "direct", 850),
        ("b", "experience", ("C", "T x"), "direct", 600),
        ("c", "full_name", 'Zero "q" é', "direct", 850),
    ]


def test_typed_ats_equals_json_ats(spark):
    rows = [("a", 0, "", "Full", "E@x.io"), ("b", 1, "  ", "x", None)]
    typed = spark.createDataFrame(rows, "candidate_id string, record_ord bigint, candidateName string, name string, email string")
    body = typed.select("candidate_id", "record_ord", F.to_json(F.struct("candidateName", "name", "email")).alias("payload"))
    assert facts(ats.ats_facts(ats.pick_columns(typed))) == facts(ats.ats_facts(ats.pick_json(body)))


def test_broken_ats_records_take_their_source_along(spark):
    picked = ats.pick_json(ats_rows(spark, [
        ("a", json.dumps({"name": "Good"})), ("a", json.dumps({"name": 5})),
        ("b", "[1]"), ("c", "{oops"), ("d", "{}"), ("e", "[]"), ("f", None), ("g", json.dumps({"name": "Fine"})),
        ("h", '"text"'), ("i", json.dumps({"email": ["x"]})), ("j", " 0.0 "), ("k", "7"),
    ]))
    bad = {(r.candidate_id, r.reason) for r in quarantine(picked, "ats_json").collect()}
    assert bad == {("a", "name is not a text"), ("b", "not an object"), ("c", "malformed json"),
                   ("h", "not an object"), ("i", "email is not a text"), ("k", "not an object")}
    df = ats.ats_facts(isolate(picked))
    assert facts(df) == [("g", "full_name", "Fine", "direct", 850)]
    assert df.select("candidate_id").distinct().count() == 11


def host_rows(spark, rows):
    return spark.createDataFrame([(c, i, p, r) for i, (c, p, r) in enumerate(rows)],
                                 "candidate_id string, record_ord bigint, profile string, repos string")


def test_code_host_json(spark):
    repos = json.dumps([{"name": "x", "language": "go"}, {"name": "y", "language": "golang"},
                        {"language": "go"}, {"language": None}, {"name": "z"}, {"language": ""}])
    typed, listed = code_host.pick_json(host_rows(spark, [
        ("a", json.dumps({"login": "asha", "name": "Asha", "bio": ""}), repos),
        ("b", json.dumps({"login": 12}), None),
        ("c", "{}", repos),
        ("d", json.dumps({"name": "D"}), json.dumps([{"language": 5}])),
        ("e", json.dumps({"name": "E"}), json.dumps(["x"])),
        ("f", json.dumps({"name": "F"}), json.dumps({"language": "go"})),
        ("g", json.dumps({"bio": ["x"]}), None),
        ("h", "null", json.dumps(["ignored"])),
    ]))
    bad = {(r.candidate_id, r.reason) for r in quarantine(typed, "github").collect()}
    assert bad == {("d", "language is not a text"), ("e", "repository is not an object"),
                   ("f", "repositories are not a list"), ("g", "bio is not a text")}
    found = facts(code_host.profile_facts(isolate(typed)))
    assert found == [
        ("a", "full_name", "Asha", "direct", 600),
        ("a", "links", "https://github.com/asha", "direct", 900),
        ("b", "links", "https://github.com/12", "direct", 900),
    ]
    gated = code_host.repos_with_profile(without_broken(listed, typed), typed)
    assert facts(code_host.repo_facts(gated)) == [
        ("a", "skills", "Go", "inferred-from-repos", 700), ("a", "skills", "Go", "inferred-from-repos", 700),
    ]


def test_repo_files(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"candidate_id":"a","repos":[{"name":"n","language":"Go"},{"name":"m"}]}\n')
    rows = code_host.read_repos(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("a", 0, "n", "Go"), ("a", 1, "m", None)]


def test_ats_one_document_per_file(spark, tmp_path):
    (tmp_path / "x.json").write_text('{\n  "candidate_id": "z",\n  "candidateName": "Zed"\n}\n')
    picked = ats.pick_json(ats.read_ats_json(spark, str(tmp_path), multi_line=True))
    assert facts(ats.ats_facts(picked)) == [("z", "full_name", "Zed", "direct", 850)]


def test_csv_file_cut_into_several_splits(spark, tmp_path):
    body = "".join(f"{i // 2},name {i},{i}\n" for i in range(300))
    (tmp_path / "a.csv").write_text("candidate_id,name,phone\n" + body)
    (tmp_path / "b.csv").write_text("phone,candidate_id\n" + "".join(f"9876543{i:03d},x{i}\n" for i in range(100)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = recruiter.read_recruiter_csv(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 4
        first = {r.candidate_id: (r.name, r.phone) for r in recruiter.first_row(df, "position").collect()}
        wanted = {str(i): (f"name {2 * i}", str(2 * i)) for i in range(150)}
        wanted.update({f"x{i}": (None, f"9876543{i:03d}") for i in range(100)})
        assert first == wanted
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
