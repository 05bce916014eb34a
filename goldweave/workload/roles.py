"""Source tables derived from the star-schema test tables.

The test tables hold no people records, so every source is derived from whole
tables by expressions that plain SQL can repeat (see ``oracle.py``). The
variants by key only vary the content of a row; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import EXPERIENCE_TYPE, FACT_COLUMNS
from ..functions import prior_of, skill_name
from ..functions.lookup import sql_literal
from ..plans import Sources

# --- fixed values of the derivation, repeated in the SQL ------------------------
SEGMENTS = ["FURNITURE", "MACHINERY", "BUILDING", "AUTOMOBILE", "HOUSEHOLD"]
LANGUAGES = ["python", "py", "Go", "golang", "scikit-learn", "c++", None, "", "JavaScript", " ml ",
             "html5css", "PHP"]
SKILL_SOURCES = ["resume", "linkedin", "recruiter_notes"]
HISTORY_SOURCES = ["linkedin", "resume", "github"]
HEADLINE_SOURCES = ["linkedin", "resume", "job_board"]
TASKS_PER_CORE = 2


_OPEN: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its schema is read once per application."""
    key = (spark.sparkContext.applicationId, f"{folder}/{name}.parquet")
    if key not in _OPEN:
        _OPEN[key] = spark.read.parquet(key[1])
    return _OPEN[key]


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """The same rows dealt out to all cores. A file with a single row group is
    read by one task, which would do all that follows in its stage alone."""
    return rows.repartition(TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism, *keys)


# column without repeats, by which a table is dealt out
KEYS = {"customer": "c_custkey", "orders": "o_orderkey", "events": "event_id"}


def dealt(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table for costly work row by row. Columns that are not used and
    filters stay below the exchange."""
    return spread(table(spark, folder, name), KEYS[name])


def by_case(number: str, cases: dict[int, str], otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN {n} THEN {value}" for n, value in cases.items())
    return f"CASE {number} {whens} ELSE {otherwise} END"


def one_of(values: list[str | None], place: str) -> str:
    items = ", ".join(f"CAST({sql_literal(v)} AS STRING)" for v in values)
    return f"get(array({items}), CAST({place} AS INT))"


def recruiter(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as recruiter rows; every fifth one is a second row of the
    candidate before it."""
    address = "replace(c_name, '#', '.')"
    customers = dealt(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey")
    )
    return customers.selectExpr(
        "CAST(CASE WHEN c_custkey % 5 = 4 THEN c_custkey - 1 ELSE c_custkey END AS STRING) AS candidate_id",
        "c_custkey AS record_ord",
        by_case("c_custkey % 17", {3: "''", 5: "'  '", 7: "replace(c_name, '#', '   ')", 9: "NULL"}, "c_name")
        + " AS name",
        by_case("c_custkey % 11", {
            0: f"{address} || '.example.com'",
            1: f"'  ' || {address} || '@Mail.Example.COM '",
            2: "NULL",
            3: "''",
            4: f"{address} || '@a@example.com'",
        }, f"{address} || '@example.com'") + " AS email",
        by_case("c_custkey % 7", {
            0: "'0' || (c_custkey + 9000000000)",
            1: "'+1 415 ' || c_custkey",
            2: "'123'",
            3: "'98765 ' || lpad(CAST(c_custkey AS STRING), 5, '0')",
            4: "'0091-' || (c_custkey + 9100000000)",
            5: "NULL",
        }, "'(987) ' || (c_custkey + 6500000)") + " AS phone",
        "CASE WHEN c_custkey % 19 <> 0 THEN c_mktsegment END AS current_company",
        "CASE WHEN c_custkey % 13 = 0 THEN '' ELSE n_name END AS title",
    )


def ats(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as applicant-tracking records under changing attribute names."""
    segment = one_of(SEGMENTS, "o_custkey % 5")
    return dealt(spark, folder, "orders").selectExpr(
        "CAST(o_custkey AS STRING) AS candidate_id",
        "o_orderkey AS record_ord",
        by_case("o_orderkey % 4", {0: "'Customer  ' || o_custkey", 1: "''", 2: "NULL"}, "'   '") + " AS candidateName",
        by_case("o_orderkey % 4", {1: "'CUSTOMER ' || o_custkey || ' '", 2: "''"}, "'unused'") + " AS full_name",
        "'customer ' || o_custkey || ' jr' AS name",
        by_case("o_orderkey % 3", {0: "'C' || o_custkey || '@Work.Example.com'"}, "''") + " AS contactEmail",
        by_case("o_orderkey % 31", {0: "'bad at example'"},
                "'alt' || (o_orderkey % 4) || '.' || o_custkey || '@example.org'") + " AS email",
        by_case("o_orderkey % 4", {0: f"lower({segment})", 2: segment}) + " AS employer",
        f"'  ' || {segment} AS current_company",
        "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS currentTitle",
        "'nation_' || (o_custkey % 25) AS title",
    )


def ats_json(spark: SparkSession, folder: str) -> DataFrame:
    """The same records as JSON text, some of them broken in different ways."""
    typed = ats(spark, folder)
    names = ", ".join(c for c in typed.columns if c not in ("candidate_id", "record_ord"))
    payload = by_case("record_ord % 97", {
        0: "'[1,2]'",
        1: """'{"candidateName": 5}'""",
        2: """'{"candidateName": '""",
        3: "'{}'",
        4: """'{"name": 0, "title": []}'""",
    }, f"to_json(struct({names}))")
    return typed.selectExpr("candidate_id", "record_ord", f"{payload} AS payload")


def profile(spark: SparkSession, folder: str) -> DataFrame:
    """First sign-up event of a user as the code-host profile; every 23rd one
    is an empty object."""
    first = (
        table(spark, folder, "events")
        .filter("event_type = 'signup'")
        .groupBy("user_id")
        .agg(F.expr("min(struct(ts, event_id)).event_id AS event_id"))
    )
    filled = "CASE WHEN user_id % 23 <> 5 THEN"
    empty, login, name = "''", "'user-' || user_id", "'User  ' || user_id"
    bio = "'Signed up as event ' || event_id || ' ' || char(9) || ' since 2024 '"
    return first.selectExpr(
        "CAST(user_id AS STRING) AS candidate_id",
        "event_id AS record_ord",
        f"{filled} {by_case('user_id % 10', {4: 'NULL'}, login)} END AS login",
        f"{filled} {by_case('user_id % 7', {2: empty}, name)} END AS name",
        f"{filled} {by_case('user_id % 5', {1: empty}, bio)} END AS bio",
    )


def repos(spark: SparkSession, folder: str) -> DataFrame:
    """All other events of a user as repositories."""
    language = one_of(LANGUAGES, f"CAST(get_json_object(props, '$.k') AS INT) % {len(LANGUAGES)}")
    return dealt(spark, folder, "events").filter("event_type <> 'signup'").selectExpr(
        "CAST(user_id AS STRING) AS candidate_id",
        "event_id AS repo_pos",
        "'repo-' || event_id AS name",
        f"{language} AS language",
    )


def ats_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as lines of export files, (part, at, value): two records of a
    customer in one file are told apart by their place only, and some lines are
    broken in different ways."""
    body = """'"candidateName":"Order  ' || o_orderkey || '","employer":"' || o_orderstatus || '","title":"T' || (o_orderkey % 3) || '"'"""
    id_ = """'"candidate_id":"' || o_custkey || '",'"""
    value = by_case("o_orderkey % 61", {
        0: f"'{{' || {id_} || {body}",
        1: f"'{{' || {body} || '}}'",
        2: f"'{{' || {id_} || {body} || ',\"candidateName\":\"Last ' || o_orderkey || '\"}}'",
        3: f"'{{' || {id_} || {body} || ',\"score\":NaN}}'",
        4: f"'{{' || {id_} || '\"name\":7}}'",
        5: "'[1, 2]'",
        6: "'  '",
        7: f"'{{' || {body} || '}} {{'",
        8: f"'{{\"candidate_id\":' || o_custkey || ',' || {body} || '}} '",
    }, f"'{{' || {id_} || {body} || '}}'")
    return table(spark, folder, "orders").selectExpr("o_custkey div 500 AS part", "o_orderkey AS at", f"{value} AS value")


def profile_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Users of events as profile lines, (part, at, value)."""
    value = by_case("user_id % 19", {
        0: """'{"candidate_id":"' || user_id || '","login":"u","name":5}'""",
        1: """'{"candidate_id":"' || user_id || '","bio":["x"],"login":"u"}'""",
        2: """'{"candidate_id":"' || user_id || '"}'""",
        3: """'{"candidate_id":"' || user_id || '","followers":3}'""",
        4: """'{"login":"nobody","name":"No Id"}'""",
        5: """'{"candidate_id":"' || user_id || '","login":' || user_id || ',"bio":null}'""",
        6: """'{"candidate_id":"' || user_id || '","name":"cut'""",
        7: """'null'""",
    }, """'{"candidate_id":"' || user_id || '","login":"user-' || user_id || '","name":"User ' || user_id || '","bio":""}'""")
    users = table(spark, folder, "events").select("user_id").distinct()
    return users.selectExpr("user_id div 50 AS part", "user_id AS at", f"{value} AS value")


def repo_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One list of repositories per user, from its events; lists that are
    broken in different ways among them. No record number."""
    language = one_of(["go", "golang", "Python", "c++", "Rust", "py"], "event_id % 6")
    repo = by_case("event_id % 13", {
        0: f"""'{{"name":5,"language":"' || {language} || '"}}'""",
        1: """'{"name":"r' || event_id || '","language":null}'""",
        2: """'{"language":""}'""",
    }, f"""'{{"name":"r' || event_id || '","language":"' || {language} || '"}}'""")
    lists = table(spark, folder, "events").groupBy("user_id").agg(
        F.expr(f"concat('[', array_join(transform(sort_array(collect_list(struct(event_id, {repo} AS repo))), x -> x.repo), ','), ']')")
        .alias("list"))
    value = by_case("user_id % 17", {
        0: """'{"candidate_id":"' || user_id || '","repos":{"language":"go"}}'""",
        1: """'{"candidate_id":"' || user_id || '","repos":[{"language":"go"},null]}'""",
        2: """'{"candidate_id":"' || user_id || '","repos":[{"language":4}]}'""",
        3: """'{"candidate_id":"' || user_id || '","repos":[{"language":"go"}'""",
        4: """'{"candidate_id":"' || user_id || '","repos":[]}'""",
        5: """'{"repos":' || list || '}'""",
    }, """'{"candidate_id":"' || user_id || '","repos":' || list || '}'""")
    return lists.selectExpr("user_id div 40 AS part", "user_id AS at", f"{value} AS value")


def _slot(name: str, value: str, source: str, emit: int, exp: str = "NULL") -> dict[str, str]:
    return {
        "field": f"'{name}'", "value": f"CAST({value} AS STRING)", "exp": f"CAST({exp} AS {EXPERIENCE_TYPE})",
        "source": source, "emit_ord": str(emit),
    }


def _facts(df: DataFrame, candidate: str, record: str, *slots: dict[str, str]) -> DataFrame:
    """One fact per slot and row, with the prior of its field and source. Only
    the number of the slot is generated, so that who counts rows makes no facts."""
    numbered = df.withColumn("slot", F.explode(F.array(*[F.lit(i) for i in range(len(slots))])))
    rows = numbered.selectExpr(
        f"CAST({candidate} AS STRING) AS candidate_id", f"{record} AS record_ord", "'direct' AS method",
        "3 AS source_ord",
        *[f"{by_case('slot', {i: s[c] for i, s in enumerate(slots)})} AS {c}" for c in slots[0]],
    )
    return rows.withColumn("confidence_milli", prior_of(F.col("field"), F.col("source"))).select(*FACT_COLUMNS)


def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as work history of differing richness, with some wrong dates, and
    one declared skill per order in three kinds of sources."""
    segment = one_of(SEGMENTS, "o_orderkey % 2")
    exp = f"""named_struct(
      'company', CASE WHEN o_orderkey % 4 = 0 THEN lower({segment}) ELSE {segment} END,
      'title', o_orderpriority,
      'start', CASE WHEN o_orderkey % 9 = 0 THEN date_format(o_orderdate, 'yyyy/MM')
                    WHEN o_orderkey % 3 = 0 THEN date_format(o_orderdate, 'yyyy-MM') END,
      'end', CAST(NULL AS STRING),
      'summary', CASE WHEN o_orderkey % 5 = 0 THEN 'order ' || o_orderkey ELSE '' END)"""
    raw = f"coalesce({one_of(LANGUAGES, '(o_orderkey + o_custkey) % 6')}, 'py')"
    orders = dealt(spark, folder, "orders").withColumn("skill", skill_name(F.expr(raw)))
    return _facts(
        orders, "o_custkey", "o_orderkey",
        _slot("experience", "NULL", one_of(HISTORY_SOURCES, "o_orderkey % 3"), 0, exp),
        _slot("skills", "skill", one_of(SKILL_SOURCES, "o_orderkey % 3"), 1),
    )


def customer_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Headlines, and facts of a field without a merge rule."""
    return _facts(
        dealt(spark, folder, "customer"), "c_custkey", "c_custkey",
        _slot("headline", "c_mktsegment || ' lead'", one_of(HEADLINE_SOURCES, "c_custkey % 3"), 0),
        _slot("location", "c_nationkey", one_of(HISTORY_SOURCES, "c_custkey % 3"), 1),
    )


def unrated_facts(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Headlines without a confidence, some from a source of its own."""
    own = table(spark, folder, "customer").filter("c_custkey % 2 = 0").selectExpr(
        "CAST(c_custkey AS STRING) AS candidate_id", "'headline' AS field", "'crm ' || c_name AS value", "'crm' AS source")
    return [customer_facts(spark, folder).drop("confidence_milli"), own]


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as links of candidates, six to a candidate, on changing hosts."""
    url = by_case("page_id % 5", {
        0: "'https://github.com/user-' || (page_id div 6)",
        1: "'https://www.linkedin.com/in/u' || (page_id div 2)",
        2: "url",
        3: "'https://github.com/x?via=linkedin.com&n=' || (page_id % 2)",
    }, "'https://www.linkedin.com/in/u' || (page_id div 6)")
    source = "CASE WHEN page_id % 2 = 0 THEN 'linkedin' ELSE 'recruiter_csv' END"
    return _facts(table(spark, folder, "pages"), "page_id div 6", "page_id", _slot("links", url, source, 0))


def extra_facts(spark: SparkSession, folder: str) -> list[DataFrame]:
    return [make(spark, folder) for make in (order_facts, customer_facts, page_links)]


def date_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates in many writings, some of them no dates."""
    year, month = "date_format(o_orderdate, 'yyyy')", "date_format(o_orderdate, 'MMM')"
    raw = by_case("o_orderkey % 10", {
        0: "date_format(o_orderdate, 'yyyy-MM-dd')",
        1: f"'  ' || {month} || ' ' || {year}",
        2: f"date_format(o_orderdate, 'MMMM') || ' ' || {year}",
        3: year,
        4: f"{year} || '-99T'",
        5: "'not a date'",
        6: "NULL",
        7: "''",
        8: f"{month} || '.  ' || {year} || ' '",
    }, f"'Xyz ' || {year}")
    return table(spark, folder, "orders").selectExpr("o_orderkey AS record_ord", f"{raw} AS raw")


def wide_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole document texts with the vowels replaced by their full-width forms."""
    return table(spark, folder, "documents").select(
        "doc_id", F.translate("text", "aeiou", "ａｅｉｏｕ").alias("text")
    )


def foreign_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as JSON profiles of unknown origin, with faults of many kinds."""
    quoted = "'\"' || {} || '\"'".format
    code = "CASE WHEN c_custkey % 2 = 0 THEN left(n_name, 2) ELSE lower(left(n_name, 2)) END"
    text = sql_literal
    parts = {
        "candidate_id": by_case("c_custkey % 29", {0: text('""'), 1: "'7'", 2: "NULL"}, quoted("c_custkey")),
        "full_name": by_case("c_custkey % 7", {1: "'12'", 2: "'null'"}, quoted("c_name")),
        "emails": by_case("c_custkey % 6", {1: text('["a@b.co",5,null]'), 2: text('"a@b.co"'), 3: "'null'"},
                          text('["a@b.co"]')),
        "phones": by_case("c_custkey % 5", {1: text('["98765",""]'), 2: text('["+9198",7]'), 3: "NULL"},
                          text('["+919876543210"]')),
        "location": by_case(
            "c_custkey % 8",
            {1: text('"home"'), 2: "'null'", 3: text('{"city":"X","zip":"1"}'), 4: text('{"country":5}'),
             5: text('{"zip":"1","city":"X","area":"2"}')},
            text('{"city":"X","country":"') + f" || {code} || " + text('"}'),
        ),
        "links": by_case(
            "c_custkey % 9",
            {1: "'[]'", 2: text('{"web":"w","github":"g","blog":"b"}'), 3: text('{"other":"x"}'), 4: "'null'",
             5: text('{"other":null}')},
            text('{"linkedin":null,"other":[]}'),
        ),
        "headline": by_case("c_custkey % 4", {1: "'true'", 2: "NULL"}, text('"lead"')),
        "years_experience": by_case("c_custkey % 10", {1: text('"4"'), 2: "'null'", 3: "'true'"}, "'4.5'"),
        "skills": by_case(
            "c_custkey % 11",
            {1: text('["x"]'), 2: text('[{"confidence":1}]'),
             3: text('[{"name":5,"confidence":"a","sources":{}}]'), 4: "'{}'"},
            text('[{"name":"Go","confidence":0.5,"sources":["a"]}]'),
        ),
        "experience": by_case(
            "c_custkey % 12",
            {
                1: text('[{"company":"C","title":"T","start":"2022/01","end":null,"summary":""}]'),
                2: text('[{"company":"C","start":"2022-01","end":202202}]'),
                3: text('["x",null]'),
                4: "'5'",
            },
            text('[{"company":"C","title":"T","start":"2022-01","end":"2023-02","summary":""}]'),
        ),
        "education": by_case("c_custkey % 3", {1: text('[{"institution":"I","degree":null}]'), 2: "'[1.5]'"}, "'[]'"),
        "provenance": by_case("c_custkey % 13", {1: text('[{"field":"f"}]'), 2: text('["p"]')},
                              text('[{"field":"f","source":"s","method":"m"}]')),
        "overall_confidence": by_case("c_custkey % 15", {1: "'1.5'", 2: "'null'", 3: "'-0.25'", 4: "'true'", 5: "'2.0'", 6: "'2'"}, "'0.75'"),
    }
    entries = ", ".join(text(f'"{name}":') + f" || {value}" for name, value in parts.items())
    # the short rows are dealt out, before the documents are written out
    return (
        dealt(spark, folder, "customer").join(table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"))
        .selectExpr("c_custkey AS row_id", f"'{{' || concat_ws(',', {entries}) || '}}' AS document")
    )


def sources(spark: SparkSession, folder: str) -> Sources:
    """All typed sources and the ready-made facts."""
    return Sources(
        recruiter=recruiter(spark, folder),
        ats=ats(spark, folder),
        profiles=profile(spark, folder),
        repos=repos(spark, folder),
        facts=extra_facts(spark, folder),
    )
