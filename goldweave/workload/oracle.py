"""The registered queries in SQL, over the same tables.

Every statement is put together from named parts, each a common table
expression with the parts it needs.
"""

from __future__ import annotations

from ..constants import (
    COUNTRY_PREFIX, DEFAULT_PRIOR_MILLI, MONTHS, PRIOR_MILLI, SECTION_NO, SKILL_ALIASES, SOURCE_PRIORITY,
    UNKNOWN_PRIORITY,
)
from .roles import HEADLINE_SOURCES, HISTORY_SOURCES, LANGUAGES, SEGMENTS, SKILL_SOURCES


# --- expressions ---------------------------------------------------------------

def lit(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def case(subject: str, cases: dict[object, str], otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in cases.items())
    return f"(CASE {subject} {whens} ELSE {otherwise} END)"


def one_of(values: list, place: str) -> str:
    return case(place, {i: lit(v) for i, v in enumerate(values)})


def clean(x: str) -> str:
    return rf"coalesce(trim(regexp_replace({x}, '\s+', ' ', 'g')), '')"


def email(x: str) -> str:
    address = rf"lower(regexp_replace({x}, '^\s+|\s+$', '', 'g'))"
    return rf"(CASE WHEN regexp_matches({address}, '^[^@\s]+@[^@\s]+\.[^@\s]+$') THEN {address} END)"


def phone(x: str) -> str:
    digits = f"regexp_replace({x}, '[^0-9+]', '', 'g')"
    local = f"ltrim({digits}, '0')"
    return (
        f"(CASE WHEN {digits} LIKE '+%' THEN {digits} "
        f"WHEN length({local}) = 10 THEN '+{COUNTRY_PREFIX}' || {local} "
        f"WHEN length({local}) > 10 THEN '+' || {local} END)"
    )


def title(x: str) -> str:
    runs = f"regexp_extract_all(lower({x}), '([a-z]+|[^a-z]+)')"
    return f"array_to_string(list_transform({runs}, lambda t: upper(t[1]) || t[2:]), '')"


def skill(x: str) -> str:
    names = {alias: lit(name) for alias, name in SKILL_ALIASES.items()}
    return case(f"lower(trim({x}))", names, title(f"trim({x})"))


def year_month(x: str) -> str:
    months = {m: lit(no) for m, no in MONTHS.items()}
    named = rf"'^([A-Za-z]{{3,}})\.?\s+(\d{{4}})$'"
    month = case(f"lower(regexp_extract(trim({x}), {named}, 1)[1:3])", months)
    return (
        rf"(CASE WHEN regexp_matches(trim({x}), '^\d{{4}}-\d{{2}}') THEN trim({x})[1:7] "
        rf"WHEN {month} IS NOT NULL THEN regexp_extract(trim({x}), {named}, 2) || '-' || {month} "
        rf"WHEN regexp_matches(trim({x}), '^\d{{4}}$') THEN trim({x}) || '-01' END)"
    )


def prior(field: str, source: str) -> str:
    cells = " ".join(
        f"WHEN {field} = {lit(f)} AND {source} = {lit(s)} THEN {milli}"
        for f, row in PRIOR_MILLI.items() for s, milli in row.items()
    )
    return f"(CASE {cells} ELSE {DEFAULT_PRIOR_MILLI} END)"


def priority(source: str) -> str:
    return case(source, {s: str(i) for i, s in enumerate(SOURCE_PRIORITY)}, str(UNKNOWN_PRIORITY))


def present(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '')"


# --- parts ------------------------------------------------------------------------

FACT = ("candidate_id, field, value, company, title, start, summary, source, method, confidence_milli, "
        "source_ord, record_ord, emit_ord")


def text_fact(table: str, field: str, value: str, source: str, method: str, milli: int, ord_: int, emit: int,
              record: str = "record_ord") -> str:
    return (
        f"SELECT candidate_id, '{field}' AS field, {value} AS value, NULL::VARCHAR AS company, "
        f"NULL::VARCHAR AS title, NULL::VARCHAR AS start, NULL::VARCHAR AS summary, '{source}' AS source, "
        f"'{method}' AS method, {milli} AS confidence_milli, {ord_} AS source_ord, {record} AS record_ord, "
        f"{emit} AS emit_ord FROM {table} WHERE {present(value)}"
    )


def exp_fact(table: str, source: str, milli: int, ord_: int, emit: int) -> str:
    return (
        f"SELECT candidate_id, 'experience' AS field, NULL AS value, company, title, NULL AS start, "
        f"'' AS summary, '{source}' AS source, 'direct' AS method, {milli} AS confidence_milli, "
        f"{ord_} AS source_ord, record_ord, {emit} AS emit_ord FROM {table} "
        f"WHERE {present('company')} AND {present('title')}"
    )


def made_fact(table: str, where: str, candidate: str, field: str, value: str, source: str, record: str, emit: int,
              exp: tuple[str, str, str, str] = ("NULL", "NULL", "NULL", "NULL")) -> str:
    company, title_, start, summary = exp
    return (
        f"SELECT CAST({candidate} AS VARCHAR) AS candidate_id, '{field}' AS field, {value} AS value, "
        f"{company} AS company, {title_} AS title, {start} AS start, {summary} AS summary, {source} AS source, "
        f"'direct' AS method, {prior(lit(field), source)} AS confidence_milli, 3 AS source_ord, "
        f"{record} AS record_ord, {emit} AS emit_ord FROM {table} {where}"
    )


SEGMENT = one_of(SEGMENTS, "(o_custkey % 5)")
HISTORY_SEGMENT = one_of(SEGMENTS, "(o_orderkey % 2)")

PARTS: dict[str, tuple[list[str], str]] = {}

PARTS["recruiter"] = ([], f"""
SELECT CAST(CASE WHEN c_custkey % 5 = 4 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR) AS candidate_id,
  c_custkey AS record_ord,
  {case('c_custkey % 17', {3: "''", 5: "'  '", 7: "replace(c_name, '#', '   ')", 9: 'NULL'}, 'c_name')} AS name,
  {case('c_custkey % 11', {
      0: "replace(c_name, '#', '.') || '.example.com'",
      1: "'  ' || replace(c_name, '#', '.') || '@Mail.Example.COM '",
      2: 'NULL', 3: "''",
      4: "replace(c_name, '#', '.') || '@a@example.com'"}, "replace(c_name, '#', '.') || '@example.com'")} AS email,
  {case('c_custkey % 7', {
      0: "'0' || CAST(9000000000 + c_custkey AS VARCHAR)",
      1: "'+1 415 ' || CAST(c_custkey AS VARCHAR)",
      2: "'123'",
      3: "'98765 ' || lpad(CAST(c_custkey AS VARCHAR), 5, '0')",
      4: "'0091-' || CAST(9100000000 + c_custkey AS VARCHAR)",
      5: 'NULL'}, "'(987) ' || CAST(6500000 + c_custkey AS VARCHAR)")} AS phone,
  CASE WHEN c_custkey % 19 <> 0 THEN c_mktsegment END AS current_company,
  CASE WHEN c_custkey % 13 = 0 THEN '' ELSE n_name END AS title
FROM customer JOIN nation ON c_nationkey = n_nationkey""")

PARTS["recruiter_first"] = (["recruiter"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY record_ord) AS rn FROM recruiter) WHERE rn = 1""")

PARTS["recruiter_clean"] = (["recruiter_first"], f"""
SELECT candidate_id, record_ord, {clean('name')} AS name, {email('email')} AS email, {phone('phone')} AS phone,
  {clean('current_company')} AS company, {clean('title')} AS title FROM recruiter_first""")

PARTS["recruiter_facts"] = (["recruiter_clean"], " UNION ALL ".join([
    text_fact("recruiter_clean", "full_name", "name", "recruiter_csv", "direct", 850, 0, 0),
    text_fact("recruiter_clean", "emails", "email", "recruiter_csv", "direct", 900, 0, 1),
    text_fact("recruiter_clean", "phones", "phone", "recruiter_csv", "normalized", 900, 0, 2),
    exp_fact("recruiter_clean", "recruiter_csv", 400, 0, 3),
]))

PARTS["ats"] = ([], f"""
SELECT CAST(o_custkey AS VARCHAR) AS candidate_id, o_orderkey AS record_ord,
  {case('o_orderkey % 4', {0: "'Customer  ' || o_custkey", 1: "''", 2: 'NULL'}, "'   '")} AS candidateName,
  {case('o_orderkey % 4', {1: "'CUSTOMER ' || o_custkey || ' '", 2: "''"}, "'unused'")} AS full_name,
  'customer ' || o_custkey || ' jr' AS name,
  {case('o_orderkey % 3', {0: "'C' || o_custkey || '@Work.Example.com'"}, "''")} AS contactEmail,
  {case('o_orderkey % 31', {0: "'bad at example'"},
        "'alt' || (o_orderkey % 4) || '.' || o_custkey || '@example.org'")} AS email,
  {case('o_orderkey % 4', {0: f'lower({SEGMENT})', 2: SEGMENT})} AS employer,
  '  ' || {SEGMENT} AS current_company,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS currentTitle,
  'nation_' || (o_custkey % 25) AS title
FROM orders""")

PARTS["ats_picked"] = (["ats"], """
SELECT candidate_id, record_ord,
  coalesce(nullif(candidateName, ''), nullif(full_name, ''), nullif(name, '')) AS name,
  coalesce(nullif(contactEmail, ''), nullif(email, '')) AS email,
  coalesce(nullif(employer, ''), nullif(current_company, '')) AS company,
  coalesce(nullif(currentTitle, ''), nullif(title, '')) AS title
FROM ats""")


def ats_facts_of(picked: str) -> str:
    return (
        f"WITH c AS (SELECT candidate_id, record_ord, {clean('name')} AS name, {email('email')} AS email, "
        f"{clean('company')} AS company, {clean('title')} AS title FROM {picked}) "
        + " UNION ALL ".join([
            text_fact("c", "full_name", "name", "ats_json", "direct", 850, 1, 0),
            text_fact("c", "emails", "email", "ats_json", "direct", 850, 1, 1),
            exp_fact("c", "ats_json", 600, 1, 2),
        ])
    )


PARTS["ats_facts"] = (["ats_picked"], ats_facts_of("ats_picked"))

# payloads by key: a list, a number as name, cut off, empty, and two empty values
PARTS["ats_reasons"] = (["ats"], f"""
SELECT candidate_id, record_ord,
  {case('record_ord % 97', {0: "'not an object'", 1: "'name is not a text'", 2: "'malformed json'"})} AS reason
FROM ats""")

PARTS["ats_isolated"] = (["ats_picked", "ats_reasons"], """
SELECT p.* FROM ats_picked p WHERE record_ord % 97 NOT IN (0, 1, 2, 3, 4) AND NOT EXISTS (
  SELECT 1 FROM ats_reasons r WHERE r.candidate_id = p.candidate_id AND r.reason IS NOT NULL)""")

PARTS["profile"] = ([], f"""
SELECT CAST(user_id AS VARCHAR) AS candidate_id, event_id AS record_ord,
  CASE WHEN user_id % 23 <> 5 AND user_id % 10 <> 4 THEN 'user-' || user_id END AS login,
  CASE WHEN user_id % 23 <> 5 THEN {case('user_id % 7', {2: "''"}, "'User  ' || user_id")} END AS name,
  CASE WHEN user_id % 23 <> 5 THEN
    {case('user_id % 5', {1: "''"}, "'Signed up as event ' || event_id || ' ' || chr(9) || ' since 2024 '")} END AS bio
FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM events WHERE event_type = 'signup') WHERE rn = 1""")

PARTS["profile_facts"] = (["profile"], (
    f"WITH c AS (SELECT candidate_id, record_ord, {clean('name')} AS name, {clean('bio')} AS bio, "
    f"'https://github.com/' || login AS link FROM profile) "
    + " UNION ALL ".join([
        text_fact("c", "full_name", "name", "github", "direct", 600, 2, 0),
        text_fact("c", "headline", "bio", "github", "direct", 600, 2, 1),
        text_fact("c", "links", "link", "github", "direct", 900, 2, 2),
    ])
))

PARTS["repos"] = ([], f"""
SELECT CAST(user_id AS VARCHAR) AS candidate_id, event_id AS repo_pos, 'repo-' || event_id AS name,
  {one_of(LANGUAGES, f"(CAST(json_extract_string(props, '$.k') AS INTEGER) % {len(LANGUAGES)})")} AS language
FROM events WHERE event_type <> 'signup'""")

PARTS["repos_gated"] = (["repos", "profile"], """
SELECT * FROM repos WHERE candidate_id IN (
  SELECT candidate_id FROM profile WHERE coalesce(login, name, bio) IS NOT NULL)""")


# export files: the place of a line, and the kind of line
PARTS["ats_lines"] = ([], """
SELECT CAST(o_custkey AS VARCHAR) AS customer, o_orderkey, o_orderstatus, o_orderkey % 61 AS kind,
  CAST(o_custkey // 500 AS VARCHAR) AS file, row_number() OVER (PARTITION BY o_custkey // 500 ORDER BY o_orderkey) AS line,
  row_number() OVER (ORDER BY CAST(o_custkey // 500 AS VARCHAR), o_orderkey) - 1 AS record_ord
FROM orders""")

PARTS["ats_line_facts"] = (["ats_lines"], """
SELECT *, CASE WHEN kind = 2 THEN 'Last ' ELSE 'Order ' END || o_orderkey AS name, 'T' || (o_orderkey % 3) AS title
FROM ats_lines a WHERE kind NOT IN (0, 1, 4, 5, 6, 7) AND NOT EXISTS (
  SELECT 1 FROM ats_lines b WHERE b.customer = a.customer AND b.kind = 4)""")

PARTS["profile_lines"] = ([], """
SELECT user_id, CAST(user_id AS VARCHAR) AS candidate_id, user_id % 19 AS kind,
  CAST(user_id // 50 AS VARCHAR) AS file, row_number() OVER (PARTITION BY user_id // 50 ORDER BY user_id) AS line,
  row_number() OVER (ORDER BY CAST(user_id // 50 AS VARCHAR), user_id) - 1 AS record_ord
FROM (SELECT DISTINCT user_id FROM events)""")

PARTS["repo_lines"] = ([], """
SELECT user_id, CAST(user_id AS VARCHAR) AS candidate_id, user_id % 17 AS kind,
  CAST(user_id // 40 AS VARCHAR) AS file, row_number() OVER (PARTITION BY user_id // 40 ORDER BY user_id) AS line,
  row_number() OVER (ORDER BY CAST(user_id // 40 AS VARCHAR), user_id) - 1 AS record_ord
FROM (SELECT DISTINCT user_id FROM events)""")

PARTS["listed"] = (["repo_lines"], f"""
SELECT l.kind, CASE WHEN l.kind <> 5 THEN candidate_id END AS candidate_id, record_ord * 1048576 + place AS repo_pos,
  CASE WHEN event_id % 13 NOT IN (0, 2) THEN 'r' || event_id END AS name,
  CASE WHEN event_id % 13 NOT IN (1, 2) THEN
    {one_of(["go", "golang", "Python", "c++", "Rust", "py"], "(event_id % 6)")} END AS language
FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS place FROM events)
JOIN repo_lines l USING (user_id) WHERE l.kind NOT IN (0, 1, 2, 3, 4)""")

# whose list is read, and whose records are broken
PARTS["host_read"] = (["profile_lines"], "SELECT * FROM profile_lines WHERE kind NOT IN (2, 4, 6, 7)")
PARTS["host_broken"] = (["host_read", "repo_lines"], """
SELECT candidate_id, 'name is not a text' AS reason, file, line FROM host_read WHERE kind = 0
UNION ALL SELECT candidate_id, 'bio is not a text', file, line FROM host_read WHERE kind = 1
UNION ALL SELECT candidate_id, CASE kind WHEN 0 THEN 'repositories are not a list' WHEN 1 THEN
  'repository is not an object' ELSE 'language is not a text' END, file, line
FROM repo_lines WHERE kind < 3 AND candidate_id IN (SELECT candidate_id FROM host_read)""")
PARTS["host_sound"] = (["host_read", "host_broken"], """
SELECT candidate_id, record_ord, CASE WHEN kind > 5 THEN 'User ' || user_id END AS name,
  CASE WHEN kind = 5 THEN 'https://github.com/' || user_id WHEN kind > 5 THEN 'https://github.com/user-' || user_id END AS link
FROM host_read WHERE candidate_id NOT IN (SELECT candidate_id FROM host_broken)""")
PARTS["host_repos"] = (["listed", "host_sound"], """
SELECT * FROM listed WHERE candidate_id IN (SELECT candidate_id FROM host_sound)""")


def languages_of(table: str) -> str:
    return (f"SELECT candidate_id, language, min(repo_pos) AS repo_pos FROM {table} "
            f"WHERE {present('language')} GROUP BY candidate_id, language")


PARTS["repo_facts"] = (["repos_gated"], (
    f"WITH l AS (SELECT *, {skill('language')} AS skill FROM ({languages_of('repos_gated')})) "
    + text_fact("l", "skills", "skill", "github", "inferred-from-repos", 700, 2, 3, "repo_pos")
))

PARTS["extra_facts"] = ([], " UNION ALL ".join([
    made_fact("orders", "", "o_custkey", "experience", "NULL", one_of(HISTORY_SOURCES, "(o_orderkey % 3)"),
              "o_orderkey", 0, (
                  f"CASE WHEN o_orderkey % 4 = 0 THEN lower({HISTORY_SEGMENT}) ELSE {HISTORY_SEGMENT} END",
                  "o_orderpriority",
                  "CASE WHEN o_orderkey % 9 = 0 THEN strftime(o_orderdate, '%Y/%m') "
                  "WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m') END",
                  "CASE WHEN o_orderkey % 5 = 0 THEN 'order ' || o_orderkey ELSE '' END")),
    made_fact("orders", "", "o_custkey", "skills",
              skill(f"coalesce({one_of(LANGUAGES, '((o_orderkey + o_custkey) % 6)')}, 'py')"),
              one_of(SKILL_SOURCES, "(o_orderkey % 3)"), "o_orderkey", 1),
    made_fact("customer", "", "c_custkey", "headline", "c_mktsegment || ' lead'",
              one_of(HEADLINE_SOURCES, "(c_custkey % 3)"), "c_custkey", 0),
    made_fact("customer", "", "c_custkey", "location", "CAST(c_nationkey AS VARCHAR)",
              one_of(HISTORY_SOURCES, "(c_custkey % 3)"), "c_custkey", 1),
    made_fact("pages", "", "page_id // 6", "links", case("page_id % 5", {
        0: "'https://github.com/user-' || (page_id // 6)",
        1: "'https://www.linkedin.com/in/u' || (page_id // 2)",
        2: "url",
        3: "'https://github.com/x?via=linkedin.com&n=' || (page_id % 2)",
    }, "'https://www.linkedin.com/in/u' || (page_id // 6)"),
        "(CASE WHEN page_id % 2 = 0 THEN 'linkedin' ELSE 'recruiter_csv' END)", "page_id", 0),
]))

PARTS["facts"] = (["recruiter_facts", "ats_facts", "profile_facts", "repo_facts", "extra_facts"], " UNION ALL ".join(
    f"SELECT {FACT} FROM {t}" for t in ("recruiter_facts", "ats_facts", "profile_facts", "repo_facts", "extra_facts")
))

PARTS["people"] = (["facts", "recruiter", "ats", "profile"], """
SELECT candidate_id FROM facts UNION SELECT candidate_id FROM recruiter UNION SELECT candidate_id FROM ats
UNION SELECT candidate_id FROM profile""")


def ledger_parts(facts: str, prefix: str = "") -> dict[str, tuple[list[str], str]]:
    """Ledger over a fact table, in the order of arrival of the facts."""
    p = prefix
    section = case("field", {f: str(n) for f, n in SECTION_NO.items()})
    return {
        f"{p}placed": ([facts], f"""
SELECT *, {section} AS section_ord, {priority('source')} AS priority,
  (CASE WHEN field IN ('full_name', 'headline') THEN 0 ELSE -confidence_milli END) AS trust,
  (CASE field WHEN 'experience' THEN lower(company) || chr(1) || lower(title) ELSE value END) AS merge_key,
  (CASE WHEN company <> '' THEN 1 ELSE 0 END + CASE WHEN title <> '' THEN 1 ELSE 0 END
   + CASE WHEN start <> '' THEN 1 ELSE 0 END + CASE WHEN summary <> '' THEN 1 ELSE 0 END) AS richness
FROM {facts} WHERE field IN ({', '.join(lit(f) for f in SECTION_NO)})"""),
        f"{p}ranked": ([f"{p}placed"], f"""
SELECT *, row_number() OVER (PARTITION BY candidate_id, field
    ORDER BY trust, source_ord, record_ord, emit_ord) AS r,
  row_number() OVER (PARTITION BY candidate_id, field
    ORDER BY confidence_milli DESC, priority, source_ord, record_ord, emit_ord) AS place
FROM {p}placed"""),
        f"{p}hosts": ([f"{p}ranked"], f"""
SELECT candidate_id, min(r) AS github_r FROM {p}ranked
WHERE field = 'links' AND value LIKE '%github.com%' GROUP BY candidate_id"""),
        f"{p}networks": ([f"{p}ranked", f"{p}hosts"], f"""
SELECT k.candidate_id, min(k.r) AS linkedin_r FROM {p}ranked k LEFT JOIN {p}hosts h USING (candidate_id)
WHERE k.field = 'links' AND k.value LIKE '%linkedin.com%' AND k.r IS DISTINCT FROM h.github_r
GROUP BY k.candidate_id"""),
        f"{p}keyed": ([f"{p}ranked", f"{p}hosts", f"{p}networks"], f"""
SELECT k.*, CASE WHEN field <> 'links' THEN merge_key
    WHEN r = github_r THEN 'github' WHEN r = linkedin_r THEN 'linkedin' ELSE 'other:' || value END AS slot,
  CASE WHEN field IN ('full_name', 'headline')
    THEN row_number() OVER (PARTITION BY k.candidate_id, field
      ORDER BY (CASE WHEN place = 1 THEN 0 ELSE 1 END), r) ELSE r END AS seq
FROM {p}ranked k LEFT JOIN {p}hosts h ON h.candidate_id = k.candidate_id
LEFT JOIN {p}networks n ON n.candidate_id = k.candidate_id"""),
        f"{p}ledger": ([f"{p}keyed"], f"""
SELECT *, CASE
    WHEN field IN ('full_name', 'headline') AND seq > 1 THEN 'discarded:' || method
    WHEN field IN ('emails', 'phones') AND nth > 1 THEN NULL
    WHEN field = 'experience' AND nth > 1 THEN 'merged-duplicate:' || method
    ELSE method END AS prov_method
FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id, field, slot ORDER BY r) AS nth,
    row_number() OVER (PARTITION BY candidate_id, field, slot ORDER BY richness DESC, r) AS rich_place
  FROM {p}keyed)"""),
        f"{p}confidence": ([f"{p}ledger"], f"""
SELECT candidate_id,
  coalesce(sum(confidence_milli) FILTER (won), 0)::BIGINT AS won_sum, count(*) FILTER (won) AS won_n
FROM (SELECT *, coalesce(prov_method NOT LIKE 'discarded%' AND prov_method NOT LIKE 'merged-duplicate%', false) AS won
      FROM {p}ledger) GROUP BY candidate_id"""),
    }


def profile_parts(people: str, prefix: str = "") -> dict[str, tuple[list[str], str]]:
    p = prefix
    skill_entry = "value || ':' || milli || ':' || sources"
    job = "company || '|' || title || '|' || coalesce(start, '-') || '|' || summary"
    decision = "field || '|' || source || '|' || prov_method || '|' || confidence_milli"
    return {
        f"{p}skill_items": ([f"{p}ledger"], f"""
SELECT candidate_id, value, min(r) AS r, max(confidence_milli) AS milli,
  string_agg(source, '+' ORDER BY r) AS sources FROM {p}ledger WHERE field = 'skills' GROUP BY candidate_id, value"""),
        f"{p}skill_lists": ([f"{p}skill_items"], f"""
SELECT candidate_id, string_agg({skill_entry}, ';' ORDER BY r) AS skills FROM {p}skill_items GROUP BY candidate_id"""),
        f"{p}exp_items": ([f"{p}ledger"], f"""
SELECT candidate_id, min(r) AS r, max(company) FILTER (rich_place = 1) AS company,
  max(title) FILTER (rich_place = 1) AS title, max(start) FILTER (rich_place = 1) AS start,
  max(summary) FILTER (rich_place = 1) AS summary
FROM {p}ledger WHERE field = 'experience' GROUP BY candidate_id, slot"""),
        f"{p}exp_lists": ([f"{p}exp_items"], f"""
SELECT candidate_id, string_agg({job}, ';' ORDER BY r) AS experience FROM {p}exp_items GROUP BY candidate_id"""),
        f"{p}parts": ([f"{p}ledger"], f"""
SELECT candidate_id,
  max(value) FILTER (field = 'full_name' AND seq = 1) AS full_name,
  max(value) FILTER (field = 'headline' AND seq = 1) AS headline,
  string_agg(value, ';' ORDER BY r) FILTER (field = 'emails' AND nth = 1) AS emails,
  string_agg(value, ';' ORDER BY r) FILTER (field = 'phones' AND nth = 1) AS phones,
  list(value ORDER BY r) FILTER (field = 'emails' AND nth = 1) AS email_list,
  list(value ORDER BY r) FILTER (field = 'phones' AND nth = 1) AS phone_list,
  max(value) FILTER (slot = 'github' AND field = 'links') AS github,
  max(value) FILTER (slot = 'linkedin' AND field = 'links') AS linkedin,
  string_agg(value, ';' ORDER BY r) FILTER (field = 'links' AND slot LIKE 'other:%' AND nth = 1) AS other_links,
  string_agg({decision}, ';' ORDER BY section_ord, seq) FILTER (prov_method IS NOT NULL) AS provenance,
  count(prov_method) AS n_provenance
FROM {p}ledger GROUP BY candidate_id"""),
        f"{p}profiles": ([people, f"{p}parts", f"{p}skill_lists", f"{p}exp_lists", f"{p}confidence"], f"""
SELECT e.candidate_id, full_name, coalesce(emails, '') AS emails, coalesce(phones, '') AS phones,
  email_list, phone_list, linkedin, github, coalesce(other_links, '') AS other_links, headline,
  coalesce(skills, '') AS skills, coalesce(experience, '') AS experience, coalesce(provenance, '') AS provenance,
  coalesce(n_provenance, 0) AS n_provenance,
  CAST(CASE WHEN won_n > 0 THEN (2 * won_sum + won_n) // (2 * won_n) ELSE 0 END AS INTEGER) AS overall_milli
FROM {people} e LEFT JOIN {p}parts USING (candidate_id) LEFT JOIN {p}skill_lists USING (candidate_id)
LEFT JOIN {p}exp_lists USING (candidate_id) LEFT JOIN {p}confidence USING (candidate_id)"""),
    }


PARTS.update(ledger_parts("facts"))
PARTS.update(profile_parts("people"))
# a second merge: code-host facts only, for every customer
PARTS["few_facts"] = (["profile_facts", "repo_facts"], f"SELECT {FACT} FROM profile_facts UNION ALL SELECT {FACT} FROM repo_facts")
PARTS["few_people"] = (["profile"], """
SELECT CAST(c_custkey AS VARCHAR) AS candidate_id FROM customer UNION SELECT candidate_id FROM profile""")
PARTS.update(ledger_parts("few_facts", "few_"))
PARTS.update(profile_parts("few_people", "few_"))

PARTS["dates"] = ([], f"""
SELECT o_orderkey AS record_ord, {case('o_orderkey % 10', {
    0: "strftime(o_orderdate, '%Y-%m-%d')", 1: "'  ' || strftime(o_orderdate, '%b %Y')",
    2: "strftime(o_orderdate, '%B %Y')", 3: "strftime(o_orderdate, '%Y')",
    4: "strftime(o_orderdate, '%Y') || '-99T'", 5: "'not a date'", 6: 'NULL', 7: "''",
    8: "strftime(o_orderdate, '%b') || '.  ' || strftime(o_orderdate, '%Y') || ' '"},
    "'Xyz ' || strftime(o_orderdate, '%Y')")} AS raw FROM orders""")

WIDE = "ａｅｉｏｕ"
PARTS["wide"] = ([], f"SELECT doc_id, translate(text, 'aeiou', '{WIDE}') AS text FROM documents")


def with_parts(body: str, *needed: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for other in PARTS[name][0]:
                visit(other)
            order.append(name)

    for name in needed:
        visit(name)
    parts = ",\n".join(f"{name} AS ({PARTS[name][1].strip()})" for name in order)
    return f"WITH {parts}\n{body}" if parts else body


# --- foreign documents ---------------------------------------------------------------

def quoted(x: str) -> str:
    return f"'\"' || {x} || '\"'"


DOCUMENT_PARTS = {
    "candidate_id": case("c_custkey % 29", {0: "'\"\"'", 1: "'7'", 2: "NULL"}, quoted("c_custkey")),
    "full_name": case("c_custkey % 7", {1: "'12'", 2: "'null'"}, quoted("c_name")),
    "emails": case("c_custkey % 6", {1: """'["a@b.co",5,null]'""", 2: "'\"a@b.co\"'", 3: "'null'"}, """'["a@b.co"]'"""),
    "phones": case("c_custkey % 5", {1: """'["98765",""]'""", 2: """'["+9198",7]'""", 3: "NULL"}, """'["+919876543210"]'"""),
    "location": case("c_custkey % 8", {
        1: "'\"home\"'", 2: "'null'", 3: """'{"city":"X","zip":"1"}'""", 4: """'{"country":5}'""",
        5: """'{"zip":"1","city":"X","area":"2"}'"""},
        """'{"city":"X","country":"' || (CASE WHEN c_custkey % 2 = 0 THEN n_name[1:2] ELSE lower(n_name[1:2]) END) || '"}'"""),
    "links": case("c_custkey % 9", {
        1: "'[]'", 2: """'{"web":"w","github":"g","blog":"b"}'""", 3: """'{"other":"x"}'""", 4: "'null'",
        5: """'{"other":null}'"""}, """'{"linkedin":null,"other":[]}'"""),
    "headline": case("c_custkey % 4", {1: "'true'", 2: "NULL"}, "'\"lead\"'"),
    "years_experience": case("c_custkey % 10", {1: "'\"4\"'", 2: "'null'", 3: "'true'"}, "'4.5'"),
    "skills": case("c_custkey % 11", {
        1: """'["x"]'""", 2: """'[{"confidence":1}]'""", 3: """'[{"name":5,"confidence":"a","sources":{}}]'""",
        4: "'{}'"}, """'[{"name":"Go","confidence":0.5,"sources":["a"]}]'"""),
    "experience": case("c_custkey % 12", {
        1: """'[{"company":"C","title":"T","start":"2022/01","end":null,"summary":""}]'""",
        2: """'[{"company":"C","start":"2022-01","end":202202}]'""",
        3: """'["x",null]'""", 4: "'5'"},
        """'[{"company":"C","title":"T","start":"2022-01","end":"2023-02","summary":""}]'"""),
    "education": case("c_custkey % 3", {1: """'[{"institution":"I","degree":null}]'""", 2: "'[1.5]'"}, "'[]'"),
    "provenance": case("c_custkey % 13", {1: """'[{"field":"f"}]'""", 2: """'["p"]'"""},
                       """'[{"field":"f","source":"s","method":"m"}]'"""),
    "overall_confidence": case("c_custkey % 15", {1: "'1.5'", 2: "'null'", 3: "'-0.25'", 4: "'true'", 5: "'2.0'", 6: "'2'"}, "'0.75'"),
}
PARTS["documents_in"] = ([], (
    "SELECT c_custkey AS row_id, CAST('{' || concat_ws(',', "
    + ", ".join(f"'\"{k}\":' || {v}" for k, v in DOCUMENT_PARTS.items())
    + ") || '}' AS JSON) AS d FROM customer JOIN nation ON c_nationkey = n_nationkey"
))


def shown(j: str) -> str:
    """A JSON value as it reads in a message."""
    return (f"(CASE json_type({j}) WHEN 'VARCHAR' THEN {j} ->> '$' WHEN 'NULL' THEN 'None' "
            f"WHEN 'BOOLEAN' THEN (CASE {j} ->> '$' WHEN 'true' THEN 'True' ELSE 'False' END) "
            f"ELSE CAST({j} AS VARCHAR) END)")


def sorted_object(j: str) -> str:
    """Text of an object with its keys in order."""
    fields = f"list_transform(list_sort(json_keys({j})), lambda k: '\"' || k || '\":' || CAST(json_extract({j}, '$.' || k) AS VARCHAR))"
    return f"'{{' || array_to_string({fields}, ',') || '}}'"


def doc_rule(no: int, rule: str, where: str, message: str, source: str = "documents_in", order: str = "0") -> str:
    return (f"SELECT row_id, {no} AS step, {order} AS place, '{rule}' AS rule, {message} AS message "
            f"FROM {source} WHERE {where}")


def elements(name: str) -> str:
    return (f"(SELECT row_id, d, i, json_extract(d, '$.{name}[' || (i - 1) || ']') AS e FROM "
            f"(SELECT row_id, d, unnest(range(1, 1 + CAST(json_array_length(d, '$.{name}') AS BIGINT))) AS i FROM documents_in "
            f"WHERE json_type(d, '$.{name}') = 'ARRAY'))")


def document_rules() -> str:
    kind = lambda path: f"json_type(d, '$.{path}')"
    numbers = "('BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN', 'NULL')"
    rules = [
        doc_rule(1, "V1", f"coalesce({kind('candidate_id')}, '') <> 'VARCHAR' OR d ->> '$.candidate_id' = ''",
                 "'candidate_id must be a non-empty string'"),
        doc_rule(2, "V2", f"{kind('full_name')} NOT IN ('VARCHAR', 'NULL')", "'full_name must be a string or null'"),
    ]
    for no, name, rule in ((3, "emails", "V3"), (4, "phones", "V4"), (9, "skills", "V9"), (10, "experience", "V10"),
                           (11, "education", "V12"), (12, "provenance", "V13")):
        rules.append(doc_rule(no, rule, f"{kind(name)} <> 'ARRAY'", f"'{name} must be a list'"))
    rules += [
        doc_rule(3, "V3", "json_type(e) <> 'VARCHAR'", f"'email ''' || {shown('e')} || ''' must be a string'",
                 elements("emails"), "i * 100"),
        doc_rule(4, "V4", "json_type(e) <> 'VARCHAR'", f"'phone ''' || {shown('e')} || ''' must be a string'",
                 elements("phones"), "i * 100"),
        doc_rule(4, "V4", "json_type(e) = 'VARCHAR' AND e ->> '$' <> '' AND e ->> '$' NOT LIKE '+%'",
                 "'phone ''' || (e ->> '$') || ''' is not E.164 normalized'", elements("phones"), "i * 100"),
        doc_rule(5, "V5", f"{kind('location')} NOT IN ('OBJECT', 'NULL')", "'location must be a dictionary'"),
        doc_rule(5, "V5", "k NOT IN ('city', 'region', 'country')",
                 "'location key ''' || k || ''' is invalid; must be city, region, or country'",
                 "(SELECT row_id, unnest(json_keys(d, '$.location')) AS k, generate_subscripts(json_keys(d, '$.location'), 1) AS i "
                 "FROM documents_in WHERE json_type(d, '$.location') = 'OBJECT')", "1 + i / 100.0"),
        doc_rule(5, "V6",
                 "json_type(c) <> 'NULL' AND (json_type(c) <> 'VARCHAR' OR length(c ->> '$') <> 2 OR "
                 "upper(c ->> '$') <> c ->> '$' OR NOT regexp_matches(c ->> '$', '[A-Z]'))",
                 f"'location country ''' || {shown('c')} || ''' must be a 2-character ISO-3166 alpha-2 uppercase string'",
                 "(SELECT row_id, json_extract(d, '$.location.country') AS c FROM documents_in)", "2"),
        doc_rule(6, "V7", f"{kind('links')} NOT IN ('OBJECT', 'NULL')", "'links must be a dictionary'"),
        doc_rule(6, "V7", "k NOT IN ('linkedin', 'github', 'portfolio', 'other')",
                 "'links key ''' || k || ''' is invalid; must be linkedin, github, portfolio, or other'",
                 "(SELECT row_id, unnest(json_keys(d, '$.links')) AS k, generate_subscripts(json_keys(d, '$.links'), 1) AS i "
                 "FROM documents_in WHERE json_type(d, '$.links') = 'OBJECT')", "1 + i / 100.0"),
        doc_rule(6, "V7", f"{kind('links.other')} <> 'ARRAY'", "'links[''other''] must be a list of strings'",
                 order="2"),
        doc_rule(7, "V2", f"{kind('headline')} NOT IN ('VARCHAR', 'NULL')", "'headline must be a string or null'"),
        doc_rule(8, "V8", f"{kind('years_experience')} NOT IN {numbers}",
                 "'years_experience must be a number or null'"),
    ]
    skills = elements("skills")
    whole = sorted_object("e")
    named = "json_type(e) = 'OBJECT' AND json_type(e, '$.name') IS NOT NULL"
    rules += [
        doc_rule(9, "V9", "json_type(e) <> 'OBJECT' OR json_type(e, '$.name') IS NULL",
                 f"'skill entry malformed: ' || CASE WHEN json_type(e) = 'OBJECT' THEN {whole} ELSE {shown('e')} END",
                 skills, "i * 100"),
        doc_rule(9, "V9", f"{named} AND json_type(e, '$.name') <> 'VARCHAR'",
                 f"'skill name must be a string: ' || {whole}", skills, "i * 100 + 1"),
        doc_rule(9, "V9", f"{named} AND json_type(e, '$.confidence') NOT IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN')",
                 f"'skill confidence must be a number: ' || {whole}", skills, "i * 100 + 2"),
        doc_rule(9, "V9", f"{named} AND json_type(e, '$.sources') <> 'ARRAY'",
                 f"'skill sources must be a list: ' || {whole}", skills, "i * 100 + 3"),
    ]
    for no, name, rule, keys in (
        (10, "experience", "V10", ["company", "title", "start", "end", "summary"]),
        (11, "education", "V12", ["institution", "degree", "field", "end_year"]),
        (12, "provenance", "V13", ["field", "source", "method"]),
    ):
        rows = elements(name)
        rules.append(doc_rule(no, rule, "json_type(e) <> 'OBJECT'",
                              f"'{name} entry must be a dictionary: ' || {shown('e')}", rows, "i * 100"))
        for place, key in enumerate(keys):
            rules.append(doc_rule(
                no, rule, f"json_type(e) = 'OBJECT' AND json_type(e, '$.{key}') IS NULL",
                f"'{name} entry missing required key ''{key}'': ' || {whole}", rows, f"i * 100 + {place + 1}"))
    for place, key in ((50, "start"), (51, "end")):
        value = f"json_extract(e, '$.{key}')"
        rules.append(doc_rule(
            10, "V11",
            f"json_type(e) = 'OBJECT' AND json_type({value}) <> 'NULL' AND (json_type({value}) <> 'VARCHAR' OR "
            rf"NOT regexp_matches({value} ->> '$', '^\d{{4}}-\d{{2}}$'))",
            f"'experience date ''{key}'': ''' || {shown(value)} || ''' must be in YYYY-MM format'",
            elements("experience"), f"i * 100 + {place}"))
    rules.append(doc_rule(
        13, "V14",
        f"{kind('overall_confidence')} NOT IN ('NULL', 'BOOLEAN') AND "
        "CAST(d ->> '$.overall_confidence' AS DOUBLE) NOT BETWEEN 0 AND 1",
        "'overall_confidence out of [0,1] range: ' || (d ->> '$.overall_confidence')"))
    return " UNION ALL ".join(rules)


PARTS["document_faults"] = (["documents_in"], document_rules())


# --- statements ---------------------------------------------------------------------

def fact_rows(part: str) -> str:
    return with_parts(f"SELECT {FACT} FROM {part}", part)


def exploded(items: str) -> str:
    return f"CAST(row_number() OVER (PARTITION BY candidate_id{items} ORDER BY r) - 1 AS INTEGER) AS pos"


PROFILE_OUT = ("candidate_id, full_name, emails, phones, linkedin, github, other_links, headline, skills, experience, "
               "0 AS n_education, provenance, overall_milli")


def decisions(where: str = "true") -> str:
    return with_parts(
        "SELECT candidate_id, section_ord, CAST(seq AS BIGINT) AS seq, field, source, prov_method AS method, "
        f"confidence_milli FROM ledger WHERE prov_method IS NOT NULL AND {where}", "ledger")


def report(field: str, source: str, table: str, raw: str, clean_: str) -> str:
    return (f"SELECT '{field}' AS field, '{source}' AS source, count(*) AS n_in, "
            f"count(*) FILTER (NOT {present(raw)}) AS n_null, "
            f"count(*) FILTER ({present(raw)} AND NOT {present(clean_)}) AS n_rejected FROM {table}")


def json_text(x: str) -> str:
    return f"'\"' || {x} || '\"'"


def statements() -> dict[str, str]:
    full = "profiles"
    names = "(SELECT candidate_id, string_agg(value, ';' ORDER BY r) AS names, count(*) AS n FROM skill_items GROUP BY candidate_id)"
    companies = "(SELECT candidate_id, string_agg(company, ';' ORDER BY r) AS companies, list(company ORDER BY r) AS company_list, count(*) AS n_jobs FROM exp_items GROUP BY candidate_id)"
    first_phone = "phone_list[1]"
    out = {
        "scan_recruiter": with_parts(
            "SELECT candidate_id, coalesce(name, '') AS name, coalesce(email, '') AS email, "
            "coalesce(phone, '') AS phone, CASE WHEN record_ord % 2 = 0 THEN coalesce(current_company, '') ELSE '' END "
            "AS current_company, coalesce(title, '') AS title FROM recruiter", "recruiter"),
        "scan_ats": with_parts("SELECT *, CAST(NULL AS VARCHAR) AS reason FROM ats_picked", "ats_picked"),
        "scan_profile": with_parts("SELECT candidate_id, record_ord, login, name, bio FROM profile", "profile"),
        "scan_ats_files": with_parts(
            "SELECT customer AS candidate_id, 'full_name' AS field, name AS value, NULL AS company, NULL AS title, "
            "record_ord, NULL AS reason, NULL AS file, CAST(NULL AS BIGINT) AS line FROM ats_line_facts "
            "UNION ALL SELECT customer, 'experience', NULL, o_orderstatus, title, record_ord, NULL, NULL, NULL "
            "FROM ats_line_facts UNION ALL SELECT CASE WHEN kind = 4 THEN customer END, NULL, NULL, NULL, NULL, NULL, "
            f"{case('kind', {0: lit('malformed json'), 1: lit('missing id'), 4: lit('name is not a text'), 5: lit('not an object'), 7: lit('malformed json')})}, "
            "file, line FROM ats_lines WHERE kind IN (0, 1, 4, 5, 7)", "ats_line_facts"),
        "scan_repos": with_parts("SELECT candidate_id, repo_pos, name, language FROM listed", "listed"),
        "quarantine_code_host": with_parts(
            "SELECT candidate_id, 'github' AS source, reason, CAST(1 AS BIGINT) AS n_records, file, line FROM ("
            "SELECT * FROM host_broken UNION ALL SELECT NULL, CASE kind WHEN 6 THEN 'malformed json' ELSE 'missing id' END, "
            "file, line FROM profile_lines WHERE kind IN (4, 6, 7) UNION ALL SELECT NULL, "
            "CASE kind WHEN 3 THEN 'malformed json' ELSE 'missing id' END, file, line FROM repo_lines WHERE kind IN (3, 5))",
            "host_broken"),
        "repo_facts_json": with_parts(
            f"SELECT {FACT} FROM (" + " UNION ALL ".join([
                text_fact("host_sound", "full_name", "name", "github", "direct", 600, 2, 0),
                text_fact("host_sound", "links", "link", "github", "direct", 900, 2, 2),
                text_fact(f"(SELECT *, {skill('language')} AS skill FROM ({languages_of('host_repos')}))", "skills",
                          "skill", "github", "inferred-from-repos", 700, 2, 3, "repo_pos")]) + ")",
            "host_repos"),
        "recruiter_first_row": with_parts("SELECT * FROM recruiter_first", "recruiter_first"),
        "recruiter_facts": fact_rows("recruiter_facts"),
        "ats_alias": with_parts("SELECT * FROM ats_picked", "ats_picked"),
        "ats_facts": fact_rows("ats_facts"),
        "profile_facts": fact_rows("profile_facts"),
        "repo_skills": with_parts(f"SELECT *, {skill('language')} AS skill FROM ({languages_of('repos')})", "repos"),
        "repo_gate": with_parts("SELECT * FROM repos_gated", "repos_gated"),
        "field_value_union": fact_rows("facts"),
        "prior_lookup": with_parts(
            f"SELECT *, {prior('field', 'source')} AS prior_milli FROM (SELECT field, source, method, confidence_milli, "
            "count(*) AS n_facts FROM facts GROUP BY ALL)", "facts"),
        "quarantine": with_parts(
            "SELECT candidate_id, 'ats_json' AS source, reason, count(*) AS n_records FROM ats_reasons "
            "WHERE reason IS NOT NULL GROUP BY candidate_id, reason", "ats_reasons"),
        "quarantine_facts": with_parts(
            f"SELECT {FACT} FROM ({ats_facts_of('ats_isolated')})", "ats_isolated"),
        "extra_source": """
            SELECT CAST(c_custkey AS VARCHAR) AS candidate_id, 'headline' AS field,
              CASE WHEN own THEN 'crm ' || c_name ELSE c_mktsegment || ' lead' END AS value,
              CASE WHEN own THEN 'crm' ELSE source END AS source, CASE WHEN own THEN 900 ELSE milli END AS confidence_milli
            FROM (SELECT *, c_custkey % 2 = 0 AND milli <= 900 AS own FROM (
              SELECT *, ['linkedin', 'resume', 'job_board'][c_custkey % 3 + 1] AS source,
                [900, 950, 910][c_custkey % 3 + 1] AS milli FROM customer))""",
        "run_report": with_parts(" UNION ALL ".join([
            *[report(f, "recruiter_csv", "recruiter_first", raw, clean_) for f, raw, clean_ in [
                ("full_name", "name", clean("name")), ("emails", "email", email("email")), ("phones", "phone", phone("phone")),
                ("experience.company", "current_company", clean("current_company")), ("experience.title", "title", clean("title"))]],
            *[report(f, "ats_json", "ats_picked", raw, clean_) for f, raw, clean_ in [
                ("full_name", "name", clean("name")), ("emails", "email", email("email")),
                ("experience.company", "company", clean("company")), ("experience.title", "title", clean("title"))]],
            *[report(f, "github", "profile", raw, clean(raw)) for f, raw in [("full_name", "name"), ("headline", "bio")]],
            report("skills", "github", f"({languages_of('repos_gated')})", "language", skill("language")),
        ]), "recruiter_first", "ats_picked", "profile", "repos_gated"),
        "norm_phone": with_parts(f"SELECT record_ord, phone, {phone('phone')} AS e164 FROM recruiter", "recruiter"),
        "norm_email": with_parts(f"SELECT record_ord, email, {email('email')} AS address FROM recruiter", "recruiter"),
        "norm_skill": with_parts(f"SELECT repo_pos, language, {skill('language')} AS skill FROM repos", "repos"),
        "norm_date": with_parts(f"SELECT record_ord, raw, {year_month('raw')} AS year_month FROM dates", "dates"),
        "norm_text": with_parts(
            "SELECT doc_id, CAST(length(t) AS INTEGER) AS n, md5(t) AS digest FROM (SELECT doc_id, "
            + clean(f"nfc_normalize(translate(text, '{WIDE}', 'aeiou'))") + " AS t FROM wide)", "wide"),
        "norm_report": with_parts(" UNION ALL ".join([
            report("phones", "recruiter_csv", "recruiter", "phone", phone("phone")),
            report("emails", "recruiter_csv", "recruiter", "email", email("email")),
            report("dates", "orders", "dates", "raw", year_month("raw")),
            report("phones", "documents", "documents", "text", phone("text")),
            report("emails", "documents", "documents", "text", email("text")),
        ]), "recruiter", "dates"),
        "winner_single": with_parts(
            "SELECT candidate_id, field, value, source, method, confidence_milli FROM ledger "
            "WHERE field IN ('full_name', 'headline') AND place = 1", "ledger"),
        "prov_single": decisions("field IN ('full_name', 'headline')"),
        "prov_exp": decisions("field = 'experience'"),
        "provenance": decisions(),
        "overall_conf": with_parts(
            "SELECT *, CAST(CASE WHEN won_n > 0 THEN (2 * won_sum + won_n) // (2 * won_n) ELSE 0 END AS INTEGER) "
            "AS overall_milli FROM confidence", "confidence"),
        "unmerged_fields": with_parts(
            "SELECT field, source, count(*) AS n_facts FROM facts WHERE field NOT IN "
            f"({', '.join(lit(f) for f in SECTION_NO)}) GROUP BY field, source", "facts"),
        "multi_union": with_parts(
            f"SELECT candidate_id, field, {exploded(', field')}, value FROM ledger "
            "WHERE field IN ('emails', 'phones') AND nth = 1", "ledger"),
        "skills_agg": with_parts(
            f"SELECT candidate_id, {exploded('')}, value AS name, milli AS confidence_milli, "
            "replace(sources, '+', ',') AS sources FROM skill_items", "skill_items"),
        "exp_dedup": with_parts(
            f"SELECT candidate_id, {exploded('')}, company, title, start, summary "
            "FROM exp_items", "exp_items"),
        "links_class": with_parts(
            "SELECT candidate_id, github, linkedin, CAST(NULL AS VARCHAR) AS portfolio, "
            "replace(other_links, ';', ' ') AS other FROM profiles", full),
        "profile_default": with_parts(f"SELECT {PROFILE_OUT} FROM profiles", full),
        "profile_across": with_parts(f"SELECT {PROFILE_OUT} FROM profiles", full),
        "profile_empty": with_parts(f"SELECT {PROFILE_OUT} FROM few_profiles", "few_profiles"),
        "profile_json": with_parts(
            "SELECT candidate_id, full_name, 'candidate_id,full_name,emails,phones,location,links,headline,"
            "years_experience,skills,experience,education,provenance,overall_confidence' || "
            "CASE WHEN n_bad > 0 THEN ',_validation_errors' ELSE '' END AS keys, "
            "CAST(n_provenance AS INTEGER) AS n_provenance, CAST(coalesce(n_bad, 0) AS INTEGER) AS n_errors, overall_milli "
            "FROM profiles LEFT JOIN (SELECT candidate_id, count(*) FILTER (start LIKE '%/%') AS n_bad FROM exp_items "
            "GROUP BY candidate_id) USING (candidate_id)", full, "exp_items"),
        "project_custom": with_parts(
            f"SELECT candidate_id, headline, email_list[2] AS contact, {phone('phone_list[2]')} AS callback, "
            f"names AS knows, overall_milli, CAST(n_provenance AS INTEGER) AS n_provenance, "
            "'headline,contact,callback,knows,overall_confidence,provenance' AS keys "
            f"FROM profiles LEFT JOIN (SELECT candidate_id, string_agg({skill('value')}, ';' ORDER BY r) AS names "
            "FROM skill_items GROUP BY candidate_id) USING (candidate_id)", full),
        "project_paths": with_parts(
            "SELECT candidate_id, headline, email_list[2] AS second_email, phone_list[6] AS far_phone, "
            "nullif(full_name[1], '') AS initial, nullif(full_name[41], '') AS late_letter, companies, "
            "CAST(n AS INTEGER) AS no_such_part, CAST(NULL AS VARCHAR) AS dotted, CAST(NULL AS VARCHAR) AS nested, "
            "CAST(NULL AS VARCHAR) AS unknown, CAST(NULL AS VARCHAR) AS letters "
            f"FROM profiles LEFT JOIN {names} USING (candidate_id) LEFT JOIN {companies} USING (candidate_id)",
            full, "exp_items", "skill_items"),
        "project_normalize": with_parts(
            f"SELECT candidate_id, nullif({skill('headline')}, '') AS headline, {phone('full_name')} AS name_as_phone, "
            "nullif(emails, '') AS emails, "
            f"array_to_string(list_transform(email_list, lambda e: {title('e')}), ';') AS mails_as_skills, "
            f"array_to_string(list_transform(company_list, lambda c: {title('c')}), ';') AS companies, "
            f"nullif(full_name, '') AS full_name FROM profiles LEFT JOIN {companies} USING (candidate_id)",
            full, "exp_items"),
        "project_missing": with_parts(
            "SELECT candidate_id, nullif(phones, '') AS phones, headline, overall_milli, false AS no_links, "
            "true AS no_education, 0 AS n_errors, 'phones,headline,overall_confidence,links,education' AS keys "
            "FROM profiles", full),
        "project_omit": with_parts(
            "SELECT candidate_id, '{' || concat_ws(',', "
            f"'\"full_name\":' || {json_text('full_name')}, '\"phone\":' || {json_text(first_phone)}, "
            f"'\"headline\":' || {json_text('coalesce(phone_list[2], headline)')}, "
            "'\"emails\":[' || array_to_string(list_transform(email_list, lambda e: '\"' || e || '\"'), ',') || ']', "
            "'\"jobs\":[' || array_to_string(list_transform(company_list, lambda c: 'null'), ',') || ']') || '}' "
            f"AS document FROM profiles LEFT JOIN {companies} USING (candidate_id)", full, "exp_items"),
        "project_error": with_parts(
            "SELECT candidate_id, errors FROM (SELECT candidate_id, concat_ws('; ', "
            "CASE WHEN full_name IS NULL THEN 'Required field ''full_name'' is missing (source: ''full_name'')' END, "
            "CASE WHEN phones = '' THEN 'Required field ''phone'' is missing (source: ''phones[0]'')' END, "
            "CASE WHEN headline IS NULL THEN 'Required field ''link'' is missing (source: ''headline'')' END) AS errors "
            "FROM profiles) WHERE errors <> ''", full),
        "project_accepted": with_parts(
            f"SELECT candidate_id, full_name, {first_phone} AS phone, headline AS link, phone_list[2] AS second "
            "FROM profiles WHERE full_name IS NOT NULL AND phones <> '' AND headline IS NOT NULL", full),
        "validate_default": with_parts(
            "SELECT row_id, CAST(row_number() OVER (PARTITION BY row_id ORDER BY step, place) AS INTEGER) AS error_no, "
            "rule, message FROM document_faults", "document_faults"),
        "validate_counts": with_parts(
            "SELECT rule, count(*) AS n_errors FROM document_faults GROUP BY rule", "document_faults"),
        "validate_merged": with_parts(
            "SELECT candidate_id, string_agg('experience date ''start'': ''' || start || ''' must be in YYYY-MM format', "
            "'; ' ORDER BY r) AS errors FROM exp_items WHERE start LIKE '%/%' GROUP BY candidate_id", "exp_items"),
        "validate_custom": with_parts(
            "SELECT candidate_id, errors FROM (SELECT candidate_id, concat_ws('; ', "
            "CASE WHEN full_name IS NULL THEN 'Required field ''full_name'' missing from projected output' END, "
            "CASE WHEN phones = '' THEN 'Required field ''phone'' missing from projected output' END, "
            "CASE WHEN emails = '' THEN 'Required field ''emails'' missing from projected output' END) AS errors "
            "FROM profiles) WHERE errors <> ''", full),
    }
    return out
