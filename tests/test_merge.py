import json
import os
import random
import subprocess
import sys
import textwrap

import pytest
from model import expected, found
from pyspark.sql import functions as F

from goldweave.constants import FACT_SCHEMA
from goldweave.operators import skew
from goldweave.operators.ledger import ledger, ledger_in_place, unmerged
from goldweave.operators.profile import profiles, profiles_in_place
from goldweave.operators.skew import ranked, split_hot
from goldweave.plans import Sources, consolidated

JOB = ("company", "title", "start", "end", "summary")


def job(*values):
    return dict(zip(JOB, values))


def table(spark, facts):
    """Facts as a table; the order of the list is the order of arrival."""
    rows = []
    for i, (c, field, value, source, method, milli) in enumerate(facts):
        exp = tuple(value[k] for k in JOB) if isinstance(value, dict) else None
        rows.append((c, field, None if exp else value, exp, source, method, milli, 0, i, 0))
    return spark.createDataFrame(rows, FACT_SCHEMA)


def merged(df, **options):
    rows = profiles(df, **options).collect()
    assert len(rows) == len({r.candidate_id for r in rows})
    return {r.candidate_id: found(r) for r in rows}


CASES = {
    "clear winner": [("c", "full_name", "Tomas K", "resume", "direct", 700),
                     ("c", "full_name", "Tomas Keller", "linkedin", "direct", 910),
                     ("c", "full_name", "T Keller", "board", "direct", 500)],
    "tie by priority": [("c", "full_name", "note", "recruiter_notes", "direct", 620),
                        ("c", "full_name", "code", "github", "direct", 620),
                        ("c", "full_name", "paper", "resume", "direct", 620)],
    "tie in one source": [("c", "headline", "first", "x", "direct", 500), ("c", "headline", "second", "x", "direct", 500),
                          ("c", "headline", "late winner", "linkedin", "direct", 500)],
    "two mails": [("c", "emails", "b@x.com", "ats_json", "direct", 850), ("c", "emails", "a@x.com", "recruiter_csv", "direct", 900),
                  ("c", "emails", "b@x.com", "resume", "direct", 700)],
    "skills": [("c", "skills", "Go", "resume", "direct", 700), ("c", "skills", "Go", "github", "inferred", 700),
               ("c", "skills", "Python", "linkedin", "direct", 900), ("c", "skills", "Go", "resume", "direct", 400)],
    "links": [("c", "links", "https://github.com/a", "github", "direct", 900),
              ("c", "links", "https://github.com/a", "linkedin", "direct", 900),
              ("c", "links", "https://linkedin.com/x?u=github.com", "linkedin", "direct", 950),
              ("c", "links", "https://linkedin.com/in/y", "resume", "direct", 500),
              ("c", "links", "https://linkedin.com/in/z", "resume", "direct", 500),
              ("c", "links", "https://example.org", "resume", "direct", 500),
              ("c", "links", "https://example.org", "resume", "direct", 400)],
    "jobs": [("c", "experience", job("Acme", "Dev", None, None, ""), "ats_json", "direct", 600),
             ("c", "experience", job("ACME", "dev", "2020-01", None, ""), "recruiter_csv", "direct", 400),
             ("c", "experience", job("acme", "DEV", "2021-01", None, ""), "resume", "direct", 400),
             ("c", "experience", job("Acm", "eDev", None, None, ""), "resume", "direct", 300)],
    "kept method name": [("c", "emails", "a@x.com", "x", "discarded-import", 300), ("c", "emails", "b@x.com", "x", "direct", 600)],
    "no merge rule": [("c", "location", "Pune", "resume", "direct", 700), ("c", "full_name", "N", "resume", "direct", 800)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("limit", [20_000, 0])
def test_rules(spark, name, limit):
    facts = CASES[name]
    assert merged(table(spark, facts), limit=limit) == {"c": expected("c", facts)}


def random_facts(seed, candidates, n):
    rng = random.Random(seed)
    sources = ["recruiter_csv", "ats_json", "linkedin", "resume", "github", "recruiter_notes", "board"]
    urls = ["https://github.com/a", "https://github.com/b?linkedin.com", "https://linkedin.com/in/a",
            "https://linkedin.com/in/b", "https://x.org", "https://y.org"]
    out = []
    for _ in range(n):
        field = rng.choice(["full_name", "headline", "emails", "phones", "skills", "experience", "links", "location"])
        if field == "experience":
            value = job(rng.choice(["Acme", "ACME", "Beta"]), rng.choice(["Dev", "dev", "Boss"]),
                        rng.choice([None, "2020-01"]), rng.choice([None, "2021-01"]), rng.choice(["", "s"]))
        elif field == "links":
            value = rng.choice(urls)
        else:
            value = field[0] + str(rng.randrange(5))
        # a third of the facts belong to one candidate
        who = "hot" if rng.random() < 0.4 else f"c{rng.randrange(candidates)}"
        out.append((who, field, value, rng.choice(sources), rng.choice(["direct", "inferred"]), rng.choice([400, 500, 700, 850])))
    return out


def by_candidate(facts):
    return {c: expected(c, [f for f in facts if f[0] == c]) for c in {f[0] for f in facts}}


@pytest.mark.parametrize("limit,ids", [(20_000, 10_000), (40, 10_000), (40, 0), (3, 0), (0, 10_000)])
def test_random_facts_against_the_plain_rules(spark, monkeypatch, limit, ids):
    # with no id to broadcast, hot ids are joined by shuffle
    monkeypatch.setattr(skew, "MAX_BROADCAST_IDS", ids)
    facts = random_facts(7, 12, 400)
    shuffled = table(spark, facts).orderBy("value", "record_ord").repartition(5)
    assert merged(shuffled, limit=limit) == by_candidate(facts)


def test_result_does_not_depend_on_partitions(spark):
    facts = random_facts(11, 6, 150)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(merged(table(spark, facts).repartition(3), limit=30))
        assert results[0] == results[1] == results[2] == by_candidate(facts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ledger_is_the_same_on_both_ways(spark):
    facts = table(spark, random_facts(3, 5, 200))
    columns = ["candidate_id", "section_ord", "seq", "value", "slot", "is_first", "source", "method", "prov_method"]

    def rows(limit):
        return sorted(map(repr, ledger(facts, limit).select(*columns).collect()))

    assert rows(20_000) == rows(0) == rows(40)


def test_every_kept_value_has_a_decision(spark):
    rows = profiles(table(spark, random_facts(5, 8, 200))).collect()
    assert len(rows) == len({r.candidate_id for r in rows})
    for r in rows:
        fields = {p.field for p in r.provenance}
        assert 0 <= r.overall_confidence <= 1
        assert (not r.emails) or "emails" in fields
        assert (r.full_name is None) or "full_name" in fields


def test_ranking_across_partitions(spark):
    rows = [("hot", i) for i in range(500)] + [("cold", 1), ("warm", 5), ("warm", 2)]
    df = spark.createDataFrame(rows, "g string, x int").repartition(4)
    got = sorted((r.g, r.n, r.x) for r in ranked(df, ["g"], ["x"], "n", True).collect())
    assert got == sorted([("hot", i + 1, i) for i in range(500)] + [("cold", 1, 1), ("warm", 1, 2), ("warm", 2, 5)])


def test_hot_candidates_without_facts_get_a_profile(spark):
    rows = [("ghost", None, None, None, None, None, None, None, None, None)] * 5
    df = spark.createDataFrame(rows, FACT_SCHEMA)
    (row,) = profiles(df, limit=2).collect()
    assert (row.candidate_id, row.emails, row.skills, row.provenance, row.overall_confidence) == ("ghost", [], [], [], 0.0)


def test_missing_id_is_the_empty_id(spark):
    rows = [(None, "emails", f"m{i}@x.io", None, "x", "direct", 500, 0, i, 0) for i in range(6)]
    df = spark.createDataFrame(rows, FACT_SCHEMA)
    for limit in (100, 3):
        (row,) = profiles(df, limit=limit).collect()
        assert (row.candidate_id, row.emails) == ("", [f"m{i}@x.io" for i in range(6)])


def test_split_only_when_needed(spark):
    facts = table(spark, random_facts(1, 3, 50))
    assert split_hot(facts, 1000).hot is None
    parted = split_hot(facts, 10)
    assert parted.regular.count() + parted.hot.count() == 50


def test_unmerged_fields_are_counted(spark):
    df = table(spark, CASES["no merge rule"])
    assert [tuple(r) for r in unmerged(df).collect()] == [("location", "resume", 1)]


def test_equal_positions_go_by_value(spark):
    rows = [("c", "full_name", n, None, "x", "direct", 500, 0, 0, 0) for n in ("Zoe", "Abe", "Mia")]
    for parts in (1, 3):
        for limit in (100, 0):
            df = spark.createDataFrame(rows, FACT_SCHEMA).repartition(parts)
            assert [r.full_name for r in profiles(df, limit=limit).collect()] == ["Abe"]


def test_plan_of_the_distributed_way(spark):
    out = profiles(table(spark, random_facts(2, 3, 80)), limit=10)
    text = plan(out)
    assert text.count("Exchange ") < 25
    assert text.count("ExistingRDD") <= 6
    assert "CartesianProduct" not in text


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_exchange_in_the_merge(spark):
    facts = table(spark, random_facts(2, 3, 50))
    for df in (ledger_in_place(facts), profiles_in_place(facts)):
        assert plan(df).count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan(profiles_in_place(facts))


def test_tasks_of_the_merge_grow_with_the_facts(spark, monkeypatch):
    """What one task sorts stays the same however many facts there are."""
    monkeypatch.setattr(skew, "TASK_FACTS", 10)
    facts = table(spark, [(f"c{i % 50}", "skills", f"s{i}", "resume", "direct", 700) for i in range(400)])
    split = split_hot(facts)
    assert split.tasks == 41 and split_hot(facts.limit(30)).tasks is None
    rows = profiles(facts, split=split)
    assert "REPARTITION_BY_NUM" in rows._jdf.queryExecution().executedPlan().toString()
    assert merged(facts, split=split) == merged(facts, split=skew.Split(facts))
    assert ledger(facts, split=split).count() == 400


def test_facts_of_hot_candidates_are_split_once(spark, monkeypatch):
    """Both parts read one table of the split, and rows are kept as Parquet."""
    from goldweave.operators import ledger as led
    labels, whole = [], skew.written
    for module in (skew, led):
        monkeypatch.setattr(module, "written", lambda df, label: labels.append(label) or whole(df, label), raising=False)
    monkeypatch.setattr(skew, "MAX_BROADCAST_IDS", 2)
    facts = table(spark, [(f"c{i % 9}", "skills", f"s{i % 20}", "resume", "direct", 700) for i in range(120)]
                  + [("d", "skills", "Go", "resume", "direct", 700)])
    rows = ledger(facts, limit=3)
    assert labels == ["split", "in-order", "ledger"] and rows.count() == 121


@pytest.mark.parametrize("ids", [10_000, 2])
def test_candidates_in_many_parts(spark, monkeypatch, ids):
    """Parts of a few facts each, ids that are hard to write, equal facts."""
    monkeypatch.setattr(skew, "MAX_BROADCAST_IDS", ids)
    monkeypatch.setattr(skew, "TASK_FACTS", 9)
    odd = {"c0": 'q"\\', "c1": "\n\t", "c2": "\U0001f600", "c3": " ", "hot": "h\u00f6t"}
    facts = [(odd.get(f[0], f[0]), *f[1:]) for f in random_facts(13, 5, 150)]
    facts += [("same", "emails", "a@x.io", "resume", "direct", 700)] * 40
    rows = table(spark, facts)
    marks = spark.createDataFrame([("ghost", *[None] * 9)] * 30, FACT_SCHEMA)
    got = merged(rows.unionByName(marks), limit=3)
    assert got.pop("ghost") == found(profiles(marks, limit=100).first())
    assert got == by_candidate(facts)


def test_parts_follow_the_order_of_the_keys(spark):
    rows = [(g, x, y) for g in ("a", "b", None) for x in (None, *range(40)) for y in ("p", None)]
    df = spark.createDataFrame(rows, "g string, x int, y string").repartition(3)
    keys = ["g", "x", "y"]
    points = skew.cut_points(df, keys, 8, len(rows))
    placed = df.withColumn("p", skew.part_of(F.struct(*keys), points, 8)).orderBy(*keys).collect()
    parts = [r.p for r in placed]
    assert parts == sorted(parts) and set(parts) == set(range(8))
    assert max(parts.count(p) for p in set(parts)) < 2 * len(rows) / 8
    # nothing of the sample is asked of a row: the points are constants
    assert "from_json" not in plan(df.withColumn("p", skew.part_of(F.struct(*keys), points, 8)))
    assert df.select(skew.part_of(F.struct(*keys), skew.cut_points(df, keys, 1, 3), 1).alias("p")).distinct().collect() == [(0,)]


@pytest.mark.parametrize("limit", [20_000, 3])
def test_repositories_alone_make_no_profile(spark, limit):
    """However many there are: they only count beside a profile."""
    repos = spark.createDataFrame(
        [(c, i, f"r{i}", "go") for c in ("lone", "u") for i in range(9)],
        "candidate_id string, repo_pos bigint, name string, language string")
    hosts = spark.createDataFrame(
        [("u", 0, "u", "U", "bio")], "candidate_id string, record_ord bigint, login string, name string, bio string")
    assert [r.candidate_id for r in consolidated(Sources(profiles=hosts, repos=repos), limit).collect()] == ["u"]


def test_facts_of_many_hot_candidates_move_once(tmp_path):
    """Rows that tasks shuffled, from Spark's event log of a run of its own."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {root!r})
        from pyspark.sql import SparkSession
        from goldweave.operators import skew
        from goldweave.operators.profile import profiles
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
            .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{tmp_path}")
            .config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "4")
            # tables as large as on a cluster: the engine broadcasts none by itself
            .config("spark.sql.autoBroadcastJoinThreshold", "-1").getOrCreate())
        skew.MAX_BROADCAST_IDS = 10
        facts = spark.range(20_000).selectExpr(
            "'c' || id % 100 AS candidate_id", "IF(id % 3 = 0, 'emails', 'skills') AS field", "'v' || id % 70 AS value",
            "CAST(NULL AS struct<company:string,title:string,start:string,end:string,summary:string>) AS exp",
            "'resume' AS source", "'direct' AS method", "700 AS confidence_milli", "0 AS source_ord",
            "id AS record_ord", "0 AS emit_ord")
        assert profiles(facts, limit=40).selectExpr("sum(size(provenance))").first()[0] > 0
        spark.stop()
    """)
    subprocess.run([sys.executable, "-c", script], check=True, capture_output=True, timeout=300)
    moved = 0
    for f in tmp_path.rglob("*"):
        for line in f.read_text(errors="replace").split("\n") if f.is_file() else ():
            if line.startswith("{") and (e := json.loads(line))["Event"] == "SparkListenerTaskEnd":
                moved += e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
    # the three candidates between two parts move more often
    assert moved < 1.5 * 20_000
