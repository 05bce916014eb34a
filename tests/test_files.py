"""Sources read from files: places, reasons, isolation, how often files are read."""

import json
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from goldweave.operators import membership
from goldweave.operators.quarantine import isolate
from goldweave.plans import Sources, gather, run
from goldweave.sources import ats, code_host, files, recruiter, without_markers

from conftest import ROOT

LINES = [
    '{"candidate_id":"a","candidateName":"First Name"}',
    "",
    '{"candidate_id":"a","candidateName":"Second Name"}',
    '{"candidate_id":"b","candidateName":"Cut',
    '{"candidateName":"Nobody"}',
    '{"candidate_id":"c","candidateName":"Old","candidateName":"Last One"}',
    '{"candidate_id":"d","candidateName":"Dora","score":NaN}',
    '{"candidate_id":"e","candidateName":7}',
    '{"candidate_id":"f","candidateName":"Fay"} {"more":1',
    "[1]",
    '{"candidate_id":"g","candidateName":"Gus","record_ord":-5}',
]


def bad_rows(gathered):
    return sorted(((r.candidate_id, r.reason, os.path.basename(r.file), r.line, r.n_records)
                   for r in gathered.quarantine.collect()), key=repr)


@pytest.fixture()
def small_splits(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield cut
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_json_lines_keep_their_place_and_reason(spark, tmp_path):
    (tmp_path / "x.json").write_text("\n".join(LINES) + "\n")
    gathered = gather(Sources(ats_json=ats.read_ats_json(spark, str(tmp_path))))
    assert bad_rows(gathered) == sorted([
        (None, "malformed json", "x.json", 4, 1), (None, "missing id", "x.json", 5, 1), ("e", "name is not a text", "x.json", 8, 1),
        ("f", "malformed json", "x.json", 9, 1), (None, "not an object", "x.json", 10, 1)], key=repr)
    names = {r.candidate_id: [] for r in gathered.facts.collect()}
    for r in without_markers(gathered.facts).orderBy("record_ord").collect():
        names[r.candidate_id].append((r.value, r.record_ord))
    assert names == {"a": [("First Name", 0), ("Second Name", 2)], "c": [("Last One", 5)], "d": [("Dora", 6)],
                     "e": [], "f": [], "g": [("Gus", -5)]}
    # of two equally trusted names the first in the file wins
    out = run(Sources(ats_json=ats.read_ats_json(spark, str(tmp_path)))).output
    assert out.filter("candidate_id = 'a'").first().full_name == "First Name"


@pytest.mark.parametrize("size", [40, 700, 1 << 20])
def test_places_do_not_depend_on_the_splits(spark, tmp_path, small_splits, size):
    for name in ("b", "a", "c"):
        lines = [json.dumps({"candidate_id": f"{name}{k % 7}", "candidateName": f"Name {name} {k}"}) for k in range(12)]
        lines[5] = ""
        lines[7] = "{"
        (tmp_path / f"{name}.json").write_text("\n".join(lines))
    small_splits(size)
    lines = ats.read_ats_json(spark, str(tmp_path))
    assert (lines.rdd.getNumPartitions() >= 40) == (size == 40)
    gathered = gather(Sources(ats_json=lines))
    assert bad_rows(gathered) == [(None, "malformed json", f"{n}.json", 8, 1) for n in "abc"]
    got = {r.value: r.record_ord for r in without_markers(gathered.facts).collect()}
    want = {f"Name {n} {k}": 12 * i + k for i, n in enumerate("abc") for k in range(12) if k not in (5, 7)}
    assert got == want


def test_code_host_files(spark, tmp_path):
    profiles, repos = tmp_path / "profiles", tmp_path / "repos"
    profiles.mkdir()
    repos.mkdir()
    (profiles / "p.json").write_text("\n".join([
        '{"candidate_id":"a","login":"ann","name":"Ann","bio":""}', '{"candidate_id":"b","name":5,"bio":["x"]}',
        '{"candidate_id":"c"}', '{"candidate_id":"d","name":"Dan"', '{"name":"No Id"}', '{"candidate_id":"e","name":"Eve"}',
        '{"candidate_id":"f","followers":2}', '{"candidate_id":9,"login":9}', '{"candidate_id":"g","name":"Gil"}']))
    (repos / "r.json").write_text("\n".join([
        '{"candidate_id":"a","repos":[{"name":1,"language":"go"},{"language":null},{"name":"x","language":"golang"}]}',
        '{"candidate_id":"b","repos":[{"language":"go"}]}', '{"candidate_id":"c","repos":{"language":"go"}}',
        '{"candidate_id":"e","repos":[null]}', '{"candidate_id":"f","repos":[{"language":"Rust"}]}', '{"repos":[]}',
        '{"candidate_id":"g","repos":[{"language":"go"}', '{"candidate_id":"9","repos":"none"}']))
    made = gather(Sources(profile_json=code_host.read_profile_lines(spark, str(profiles)),
                          repos_json=code_host.read_repo_lists(spark, str(repos))))
    assert bad_rows(made) == sorted([
        ("b", "name is not a text", "p.json", 2, 1), (None, "malformed json", "p.json", 4, 1),
        (None, "missing id", "p.json", 5, 1), ("e", "repository is not an object", "r.json", 4, 1),
        (None, "missing id", "r.json", 6, 1), (None, "malformed json", "r.json", 7, 1),
        ("9", "repositories are not a list", "r.json", 8, 1)], key=repr)
    got = sorted((r.candidate_id, r.field, r.value) for r in without_markers(made.facts).collect())
    assert got == [("a", "full_name", "Ann"), ("a", "links", "https://github.com/ann"), ("a", "skills", "Go"),
                   ("a", "skills", "Go"), ("f", "skills", "Rust"), ("g", "full_name", "Gil")]
    assert {r.candidate_id for r in made.facts.select("candidate_id").collect()} == set("abcefg9")
    typed = code_host.read_profiles(spark, str(profiles))
    assert typed.columns == ["candidate_id", "record_ord", "login", "name", "bio"]
    assert {(r.candidate_id, r.login) for r in typed.collect() if r.login} == {("a", "ann"), ("9", "9")}


def test_empty_folders_of_files(spark, tmp_path):
    (tmp_path / "x.json").write_text("")
    made = gather(Sources(ats_json=ats.read_ats_json(spark, str(tmp_path))))
    assert made.facts.collect() == [] and made.quarantine.collect() == []
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.csv").write_text("")
    assert recruiter.read_recruiter_csv(spark, str(tmp_path / "c")).collect() == []


def test_csv_header_with_quoted_newline_and_wide_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n\n"candidate_id","odd\nname",name,phone\n1,x,"Ann, A",5,6,7\n2\n')
    (tmp_path / "b.csv").write_text("candidate_id\n3\n4,z\n")
    rows = recruiter.read_recruiter_csv(spark, str(tmp_path), multi_line=True)
    assert sorted((r.candidate_id, r.name, r.phone) for r in rows.collect()) == [
        ("1", "Ann, A", "5"), ("2", None, None), ("3", None, None), ("4", None, None)]
    placed = files.in_order(rows).orderBy("record_ord").collect()
    assert [(r.candidate_id, r.record_ord, r.line) for r in placed] == [("1", 0, 1), ("2", 1, 2), ("3", 2, 1), ("4", 3, 2)]


def test_csv_files_are_read_once(tmp_path):
    """Bytes that tasks read, from Spark's event log of a run of its own."""
    folder, log = tmp_path / "in", tmp_path / "log"
    folder.mkdir()
    log.mkdir()
    for k in range(3):
        head = "candidate_id,name,phone\n" if k % 2 else "name,candidate_id\n"
        (folder / f"{k}.csv").write_text(head + "".join(f"{k}{i},name {i},98765{i:05d}\n" for i in range(60_000)))
    size = sum(f.stat().st_size for f in folder.iterdir())
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        from goldweave.plans import Sources, gather
        from goldweave.sources import recruiter
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
            .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{log}")
            .config("spark.eventLog.compress", "false").config("spark.sql.files.maxPartitionBytes", "1m").getOrCreate())
        rows = recruiter.read_recruiter_csv(spark, "{folder}")
        spark.sparkContext.setJobGroup("after", "")
        made = gather(Sources(recruiter=rows))
        made.facts.write.format("noop").mode("overwrite").save()
        made.quarantine.write.format("noop").mode("overwrite").save()
        spark.stop()
    """)
    subprocess.run([sys.executable, "-c", script], check=True, capture_output=True, timeout=300)
    events = [json.loads(line) for f in log.rglob("*") if f.is_file()
              for line in f.read_text(errors="replace").split("\n") if line.startswith("{")]
    started = [e for e in events if e["Event"] == "SparkListenerJobStart"]
    assert sum("spark.jobGroup.id" not in e["Properties"] for e in started) == 1
    text = {s["Stage ID"] for e in started for s in e["Stage Infos"] for r in s["RDD Info"] if "csv" in json.dumps(r).lower()}
    read = {}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd":
            read[e["Stage ID"]] = read.get(e["Stage ID"], 0) + e["Task Metrics"]["Input Metrics"]["Bytes Read"]
    first = next(s["Stage ID"] for s in started[0]["Stage Infos"])
    assert size <= read[first] <= 1.05 * size
    # what follows reads the kept records, columns of compressed Parquet
    assert text <= {first} or sum(read.values()) < 3 * size


# --- isolation -------------------------------------------------------------------------

def many(spark):
    """A third of the rows have one id, which is broken; so are a few others."""
    rows = [(f"c{k}" if k % 3 else "hot", k, "bad" if k in (3, 700, 701, 1204) else None) for k in range(3000)]
    return rows, spark.createDataFrame(rows, "candidate_id string, record_ord bigint, reason string").repartition(6)


@pytest.mark.parametrize("bits", [1 << 24, 64])
def test_isolation_marks_the_broken_only(spark, monkeypatch, bits):
    monkeypatch.setattr(membership, "BITS", bits)
    rows, table = many(spark)
    bad = {c for c, _, r in rows if r}
    got = {(r.candidate_id, r.record_ord): r.blocked for r in isolate(table).collect()}
    assert got == {(c, n): c in bad for c, n, _ in rows} and "hot" in bad
    ids = table.filter("reason IS NOT NULL").select("candidate_id")
    assert membership.within(table, ids).count() + membership.without(table, ids).count() == len(rows)
    none = table.filter("false")
    assert membership.without(table, none).count() == len(rows) and membership.within(none, ids).count() == 0


def test_isolation_does_not_shuffle_sound_records(spark, tmp_path):
    _, table = many(spark)
    table.write.parquet(str(tmp_path / "t"))
    records = spark.read.parquet(str(tmp_path / "t"))
    text = isolate(records)._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    moved = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    for i in moved:
        # either the distinct broken ids, or rows that the bitmap has let through
        below = "\n".join(lines[i + 1:i + 4])
        assert "HashAggregate" in below or "_bits" in below, below
    assert "Union" in text and "CartesianProduct" not in text
