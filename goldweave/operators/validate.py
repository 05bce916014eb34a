"""Data-quality rules over profiles.

Rules report, they do not block: a profile with errors is kept and carries the
list. Typed tables need the value rules only; JSON documents of unknown origin
are checked for types too. The messages are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import untyped
from .project import DOCUMENT

ERRORS = "_validation_errors"

# --- fixed values: allowed and required keys, in the order they are reported --
LOCATION_KEYS = ["city", "region", "country"]
LINK_KEYS = ["linkedin", "github", "portfolio", "other"]
EXPERIENCE_KEYS = ["company", "title", "start", "end", "summary"]
EDUCATION_KEYS = ["institution", "degree", "field", "end_year"]
PROVENANCE_KEYS = ["field", "source", "method"]
YEAR_MONTH = r"(?U)^\d{4}-\d{2}$"

# --- fixed values: messages ----------------------------------------------------
MSG_ID = "candidate_id must be a non-empty string"
MSG_NAME = "full_name must be a string or null"
MSG_HEADLINE = "headline must be a string or null"
MSG_YEARS = "years_experience must be a number or null"
MSG_LIST = "{} must be a list"
MSG_EMAIL = "email '{}' must be a string"
MSG_PHONE = "phone '{}' must be a string"
MSG_PHONE_FORM = "phone '{}' is not E.164 normalized"
MSG_LOCATION = "location must be a dictionary"
MSG_LOCATION_KEY = "location key '{}' is invalid; must be city, region, or country"
MSG_COUNTRY = "location country '{}' must be a 2-character ISO-3166 alpha-2 uppercase string"
MSG_LINKS = "links must be a dictionary"
MSG_LINK_KEY = "links key '{}' is invalid; must be linkedin, github, portfolio, or other"
MSG_OTHER = "links['other'] must be a list of strings"
MSG_SKILL = "skill entry malformed: {}"
MSG_SKILL_NAME = "skill name must be a string: {}"
MSG_SKILL_CONFIDENCE = "skill confidence must be a number: {}"
MSG_SKILL_SOURCES = "skill sources must be a list: {}"
MSG_ENTRY = "{} entry must be a dictionary: {}"
MSG_ENTRY_KEY = "{} entry missing required key '{}': {}"
MSG_DATE = "experience date '{}': '{}' must be in YYYY-MM format"
MSG_CONFIDENCE = "overall_confidence out of [0,1] range: {}"
MSG_REQUIRED = "Required field '{}' missing from projected output"


def _message(template: str, *parts: Column | str) -> Column:
    texts = template.split("{}")
    out = [F.lit(texts[0])]
    for part, text in zip(parts, texts[1:]):
        out += [F.lit(part) if isinstance(part, str) else part, F.lit(text)]
    return F.concat(*out)


def _fault(rule: str, bad: Column, message: Column) -> Column:
    """A list with one error or none."""
    fault = F.struct(F.lit(rule).alias("rule"), message.alias("message"))
    return F.when(F.coalesce(bad, F.lit(False)), F.array(fault)).otherwise(_none())


def _none() -> Column:
    return F.array().cast("array<struct<rule:string,message:string>>")


def _gather(parts: list[Column]) -> Column:
    return F.flatten(F.array(*parts))


def _each(items: Column, check: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.flatten(F.transform(items, check)), _none())


def _country_bad(text: Column) -> Column:
    upper = text.rlike(r"[\p{IsUppercase}]") & ~text.rlike(r"[\p{IsLowercase}\p{Lt}]")
    return (F.length(text) != 2) | ~upper


# --- typed profiles -------------------------------------------------------------

def typed_faults() -> Column:
    """Value rules on the columns of the profile table."""
    dates = _each(
        F.col("experience"),
        lambda e: _gather([
            _fault("V11", ~e[k].rlike(YEAR_MONTH), _message(MSG_DATE, k, e[k])) for k in ("start", "end")
        ]),
    )
    phones = _each(
        F.col("phones"),
        lambda p: _fault("V4", (p != "") & ~p.startswith("+"), _message(MSG_PHONE_FORM, p)),
    )
    country = F.col("location.country")
    confidence = F.col("overall_confidence")
    return _gather([
        _fault("V1", F.col("candidate_id").isNull() | (F.col("candidate_id") == ""), F.lit(MSG_ID)),
        phones,
        _fault("V6", _country_bad(country), _message(MSG_COUNTRY, country)),
        dates,
        _fault("V14", ~confidence.between(0, 1), _message(MSG_CONFIDENCE, confidence.cast("string"))),
    ])


def validate_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles with the list of their errors, null where there are none."""
    return _attach(profiles.withColumn("_faults", typed_faults()))


def _attach(rows: DataFrame) -> DataFrame:
    messages = F.transform("_faults", lambda f: f["message"])
    return rows.withColumn(ERRORS, F.when(F.size("_faults") > 0, messages))


# --- documents of unknown types --------------------------------------------------

def _is_list(json: Column) -> Column:
    return json.startswith("[")


def _is_object(json: Column) -> Column:
    return json.startswith("{")


def _is_null(json: Column) -> Column:
    return json == "null"


def _is_number(json: Column) -> Column:
    """Numbers, and truth values, which count as numbers."""
    return json.rlike(r"^[-0-9tf]")


def _shown(json: Column) -> Column:
    """A value as it reads in a message: texts without quotes."""
    return (
        F.when(untyped.is_text(json), untyped.text_of(json))
        .when(json == "null", "None").when(json == "true", "True").when(json == "false", "False")
        .otherwise(json)
    )


def _part(item: Column, key: str) -> Column:
    """JSON text of one attribute of a variant; null when it is absent."""
    return F.to_json(F.try_variant_get(item, f"$.{key}", "variant"))


def _list_rules(name: str, check: Callable[[Column], Column], rule: str, keys: Sequence[str] = ()) -> Column:
    """A list (or nothing), and a check of every element of it. The JSON texts
    of the element and of its attributes are made once, before the checks."""
    json = F.col(f"j_{name}")
    items = F.transform(
        F.try_variant_get(F.col("_document"), f"$.{name}", "array<variant>"),
        lambda v: F.struct(F.to_json(v).alias("whole"), *[_part(v, k).alias(k) for k in keys]),
    )
    return F.when(
        json.isNotNull() & ~_is_list(json), _fault(rule, F.lit(True), F.lit(MSG_LIST.format(name)))
    ).otherwise(_each(items, check))


def _record_rules(name: str, required: list[str], rule: str, more: Callable[[Column], list[Column]] | None = None) -> Column:
    def check(item: Column) -> Column:
        whole = item["whole"]
        lacking = [
            _fault(rule, item[k].isNull(), _message(MSG_ENTRY_KEY, name, k, whole)) for k in required
        ]
        return F.when(
            ~_is_object(whole), _fault(rule, F.lit(True), _message(MSG_ENTRY, name, _shown(whole)))
        ).otherwise(_gather(lacking + (more(item) if more else [])))

    return _list_rules(name, check, rule, required)


def _email(item: Column) -> Column:
    json = item["whole"]
    return _fault("V3", ~untyped.is_text(json), _message(MSG_EMAIL, _shown(json)))


def _phone(item: Column) -> Column:
    json = item["whole"]
    bad_form = (json != '""') & ~json.startswith('"+')
    return F.when(
        ~untyped.is_text(json), _fault("V4", F.lit(True), _message(MSG_PHONE, _shown(json)))
    ).otherwise(_fault("V4", bad_form, _message(MSG_PHONE_FORM, _shown(json))))


def _skill(item: Column) -> Column:
    whole, name, confidence, sources = (item[k] for k in ("whole", "name", "confidence", "sources"))
    return F.when(
        ~_is_object(whole) | name.isNull(), _fault("V9", F.lit(True), _message(MSG_SKILL, _shown(whole)))
    ).otherwise(_gather([
        _fault("V9", ~untyped.is_text(name), _message(MSG_SKILL_NAME, whole)),
        _fault("V9", confidence.isNotNull() & ~_is_number(confidence), _message(MSG_SKILL_CONFIDENCE, whole)),
        _fault("V9", sources.isNotNull() & ~_is_list(sources), _message(MSG_SKILL_SOURCES, whole)),
    ]))


def _dates(item: Column) -> list[Column]:
    found = []
    for key in ("start", "end"):
        json = item[key]
        bad = ~_is_null(json) & (~untyped.is_text(json) | ~_shown(json).rlike(YEAR_MONTH))
        found.append(_fault("V11", bad, _message(MSG_DATE, key, _shown(json))))
    return found


def _key_rules(name: str, allowed: list[str], rule: str, template: str) -> Column:
    """Wrong keys in the order in which the document has them. A VARIANT sorts
    its keys, so the text is asked again, but only where a key is wrong."""
    wrong = F.exists(F.json_object_keys(F.col(f"j_{name}")), lambda k: ~k.isin(allowed))
    keys = F.json_object_keys(F.get_json_object("_text", f"$.{name}"))
    return F.when(wrong, _each(keys, lambda k: _fault(rule, ~k.isin(allowed), _message(template, k)))).otherwise(_none())


def _object_rules(name: str, rule: str, message: str, inner: list[Column]) -> Column:
    json = F.col(f"j_{name}")
    return F.when(json.isNull() | _is_null(json), _none()).when(
        ~_is_object(json), _fault(rule, F.lit(True), F.lit(message))
    ).otherwise(_gather(inner))


KEYS = ["candidate_id", "full_name", "emails", "phones", "location", "links", "headline",
        "years_experience", "skills", "experience", "education", "provenance", "overall_confidence"]


def document_faults() -> Column:
    """All rules, on the columns ``j_<key>``, ``_document`` and ``_text``."""
    j = {k: F.col(f"j_{k}") for k in KEYS}
    country = F.to_json(F.try_variant_get(F.col("_document"), "$.location.country", "variant"))
    other = F.to_json(F.try_variant_get(F.col("_document"), "$.links.other", "variant"))
    country_bad = ~_is_null(country) & (~untyped.is_text(country) | _country_bad(untyped.text_of(country)))
    confidence = j["overall_confidence"]

    def text_or_null(name: str, message: str) -> Column:
        return _fault("V2", ~_is_null(j[name]) & ~untyped.is_text(j[name]), F.lit(message))

    return _gather([
        _fault("V1", F.coalesce(~untyped.is_text(j["candidate_id"]) | (j["candidate_id"] == '""'), F.lit(True)),
               F.lit(MSG_ID)),
        text_or_null("full_name", MSG_NAME),
        _list_rules("emails", _email, "V3"),
        _list_rules("phones", _phone, "V4"),
        _object_rules("location", "V5", MSG_LOCATION, [
            _key_rules("location", LOCATION_KEYS, "V5", MSG_LOCATION_KEY),
            _fault("V6", country_bad, _message(MSG_COUNTRY, _shown(country))),
        ]),
        _object_rules("links", "V7", MSG_LINKS, [
            _key_rules("links", LINK_KEYS, "V7", MSG_LINK_KEY),
            _fault("V7", ~_is_list(other), F.lit(MSG_OTHER)),
        ]),
        text_or_null("headline", MSG_HEADLINE),
        _fault("V8", ~_is_null(j["years_experience"]) & ~_is_number(j["years_experience"]), F.lit(MSG_YEARS)),
        _list_rules("skills", _skill, "V9", ["name", "confidence", "sources"]),
        _record_rules("experience", EXPERIENCE_KEYS, "V10", _dates),
        _record_rules("education", EDUCATION_KEYS, "V12"),
        _record_rules("provenance", PROVENANCE_KEYS, "V13"),
        _fault(
            "V14",
            ~_is_null(confidence)
            & ~F.coalesce(
                confidence.isin("true", "false") | confidence.try_cast("double").between(0, 1), F.lit(False)
            ),
            # the number as it is written: a VARIANT drops the zeros of 2.0
            _message(MSG_CONFIDENCE, F.coalesce(F.get_json_object("_text", "$.overall_confidence"), _shown(confidence))),
        ),
    ])


def validate_documents(table: DataFrame, column: str) -> DataFrame:
    """JSON profiles with the list of their errors. A document that cannot be
    read as an object has the error of its missing id. The rules stand behind a
    generator: who asks for rows with errors asks the list, not all rules again."""
    parsed = table.withColumns({"_text": F.col(column), "_document": untyped.parse(F.col(column))})
    read = parsed.select("*", *[_part(F.col("_document"), k).alias(f"j_{k}") for k in KEYS])
    checked = read.withColumn("_faults", document_faults()).drop("_document", "_text", *[f"j_{k}" for k in KEYS])
    return _attach(untyped.computed_once(checked))


def fault_table(validated: DataFrame, *keys: str) -> DataFrame:
    """One row per error, numbered in order of the rules."""
    return validated.select(*keys, F.posexplode("_faults").alias("error_no", "fault")).select(
        *keys, "error_no", "fault.rule", "fault.message"
    )


def fault_counts(validated: DataFrame) -> DataFrame:
    return fault_table(validated).groupBy("rule").agg(F.count("*").alias("n_errors"))


def validate_custom(projected: DataFrame, config: dict) -> DataFrame:
    """Required outputs must be in the document; a null value is there."""
    keys = F.json_object_keys(DOCUMENT)
    faults = [
        _fault(
            "V15",
            ~F.array_contains(keys, f["path"]),
            F.lit(MSG_REQUIRED.format(f["path"])),
        )
        for f in config.get("fields", [])
        if f.get("required")
    ]
    return _attach(projected.withColumn("_faults", _gather(faults) if faults else _none()))
