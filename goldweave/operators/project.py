"""Output shapes given by a run-time config.

A config is compiled once, on the driver, to one column expression per output
field; the profile table is only read. Shape of a config::

    {"fields": [{"path": str, "from": str?, "required": bool?, "normalize": str?}],
     "include_confidence": bool?, "on_missing": "null" | "omit" | "error"}
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import ELEMENT_PATH, MSG_FAILED, MSG_MISSING, SUB_VALUES_PATH
from ..functions import phone_e164, skill_name
from .profile import PROFILE_COLUMNS

DOCUMENT = "_document"
ERRORS = "_projection_errors"
RESERVED = (DOCUMENT, ERRORS, "_validation_errors", "_faults")
# no list has more elements
LAST_INDEX = 2**31 - 2
SUB_VALUES, ELEMENT = re.compile(SUB_VALUES_PATH, re.ASCII), re.compile(ELEMENT_PATH)
# attributes without a merge rule: an element of nothing is null, not an error
NEVER_FILLED = {"location", "years_experience"}


class ConfigError(ValueError):
    """A path or rule that cannot be applied to the profile table."""


@dataclass(frozen=True)
class Output:
    name: str
    origin: str
    value: Column
    kind: T.DataType
    required: bool


def resolve(profiles: DataFrame, path: str) -> tuple[Column, T.DataType]:
    """Column and type of a path: a plain name, list[index] or list[].sub.

    Anything else, dotted names too, is an unknown name and gives null.
    """
    kinds = {f.name: f.dataType for f in profiles.schema.fields if f.name in PROFILE_COLUMNS}
    nothing = F.lit(None).cast("string"), T.StringType()

    sub = SUB_VALUES.match(path)
    if sub:
        name, key = sub.groups()
        kind = kinds.get(name)
        if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
            # nothing there holds records to take the value from
            return F.array().cast("array<string>"), T.ArrayType(T.StringType())
        parts = {f.name: f.dataType for f in kind.elementType.fields}
        if key not in parts:
            return (
                F.transform(F.col(name), lambda _: F.lit(None).cast("string")),
                T.ArrayType(T.StringType()),
            )
        return F.transform(F.col(name), lambda x: x[key]), T.ArrayType(parts[key])

    element = ELEMENT.match(path)
    if element:
        name, place = element.group(1), int(element.group(2))
        kind = kinds.get(name)
        if kind is None:
            return nothing
        if place > LAST_INDEX:
            kind = kind.elementType if isinstance(kind, T.ArrayType) else T.StringType()
            return F.lit(None).cast(kind), kind
        if isinstance(kind, T.ArrayType):
            return F.get(F.col(name), F.lit(place)), kind.elementType
        if isinstance(kind, T.StringType):
            letter = F.substring(F.col(name), place + 1, 1)
            return F.nullif(letter, F.lit("")), kind
        if name in NEVER_FILLED:
            return nothing
        raise ConfigError(f"'{path}': {name} is neither a list nor a text")

    if path in kinds:
        return F.col(f"`{path}`"), kinds[path]
    return nothing


def lint(profiles: DataFrame, config: dict) -> list[str]:
    """Paths that give null for every candidate."""
    names = set(profiles.columns) & set(PROFILE_COLUMNS)
    warnings = []
    for field in config.get("fields", []):
        path = field.get("from", field["path"])
        hit = SUB_VALUES.match(path) or ELEMENT.match(path)
        if (hit.group(1) if hit else path) not in names:
            warnings.append(f"'{path}' is no column of the profile and is always null")
    return warnings


def normalized(value: Column, kind: T.DataType, rule: object) -> Column:
    """Phone or skill rule on a value; unknown rules leave it alone."""
    token = str(rule).strip().lower().replace(".", "")
    text = isinstance(kind, T.StringType)
    if token == "e164":
        return phone_e164(value) if text else value
    if token == "canonical":
        if text:
            return skill_name(value)
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            return F.transform(value, skill_name)
        raise ConfigError("the canonical rule works on texts and lists of texts")
    return value


def is_missing(value: Column, kind: T.DataType) -> Column:
    """Null, an empty list or an empty text; zero and records are present."""
    if isinstance(kind, T.ArrayType):
        return value.isNull() | (F.size(value) == 0)
    if isinstance(kind, T.StringType):
        return value.isNull() | (value == "")
    return value.isNull()


def compiled(profiles: DataFrame, config: dict) -> list[Output]:
    outputs = []
    for field in config.get("fields", []):
        name = field["path"]
        if name in RESERVED:
            raise ConfigError(f"'{name}' is the name of a reporting column")
        origin = field.get("from", name)
        value, kind = resolve(profiles, origin)
        if field.get("normalize"):
            value = normalized(value, kind, field["normalize"])
        outputs.append(Output(name, origin, value, kind, bool(field.get("required", False))))
    return outputs


def _json(value: Column, kind: T.DataType, origin: str = "") -> Column:
    """JSON text of one value, nulls written out. Of the links only those that
    are there are written: their keys are open in a document."""
    if origin == "links" and isinstance(kind, T.StructType):
        others = F.when(F.size(value["other"]) > 0, value["other"])
        return F.to_json(F.struct(
            value["linkedin"].alias("linkedin"), value["github"].alias("github"),
            value["portfolio"].alias("portfolio"), others.alias("other"),
        ))
    if isinstance(kind, (T.StructType, T.ArrayType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    wrapped = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    return F.substr(wrapped, F.lit(6), F.length(wrapped) - 6)


def project(profiles: DataFrame, config: dict, strict: bool = False) -> DataFrame:
    """Profiles in the shape of the config.

    Result: candidate_id, one column per output, the JSON document of the row
    (absent keys are really absent there), and the list of projection errors.
    With ``strict`` the first candidate with an error fails the job.
    """
    on_missing = config.get("on_missing", "null")
    outputs = compiled(profiles, config)
    taken = profiles.select(
        F.col("candidate_id").alias("_id"),
        F.col("overall_confidence").alias("_confidence"),
        F.col("provenance").alias("_provenance"),
        *[o.value.alias(f"_v{i}") for i, o in enumerate(outputs)],
    )
    # of two outputs with one name the later counts, unless it is left out
    columns: dict[str, tuple[Column, T.DataType]] = {}
    keys: dict[str, Column] = {}
    errors = []
    for i, o in enumerate(outputs):
        value, kind = F.col(f"_v{i}"), o.kind
        missing = is_missing(value, kind)
        absent = missing if on_missing == "omit" else F.lit(False)
        if on_missing == "error" and o.required:
            absent = missing
            message = F.lit(MSG_MISSING.format(o.name, o.origin))
            errors.append(F.when(missing, message))
        text = F.when(missing, F.lit("null")).otherwise(_json(value, kind, o.origin))
        fragment = F.concat(F.lit(f"{_quoted(o.name)}:"), text)
        shown = F.when(~missing, value)
        if o.name in keys:
            before, before_kind = columns[o.name]
            if before_kind != kind:
                before, shown, kind = _json(before, before_kind), F.when(~missing, text), T.StringType()
            shown = F.when(absent, before).otherwise(shown)
            fragment = F.when(absent, keys[o.name]).otherwise(fragment)
        else:
            fragment = F.when(~absent, fragment)
        columns[o.name], keys[o.name] = (shown, kind), fragment
    if config.get("include_confidence", False):
        extra = {
            "overall_confidence": (F.col("_confidence"), T.DoubleType()),
            "provenance": (F.col("_provenance"), profiles.schema["provenance"].dataType),
        }
        for name, (value, kind) in extra.items():
            columns[name] = (value, kind)
            keys[name] = F.concat(F.lit(f"{_quoted(name)}:"), _json(value, kind))
    fragments = F.array_compact(F.array(*keys.values())) if keys else F.array().cast("array<string>")
    document = F.concat(F.lit("{"), F.array_join(fragments, ","), F.lit("}"))
    found = F.array_compact(F.array(*errors)) if errors else F.array().cast("array<string>")
    if strict:
        whole = F.concat(F.lit(MSG_FAILED), F.array_join(found, "; "))
        found = F.when(F.size(found) > 0, F.raise_error(whole).cast("array<string>")).otherwise(found)
    rest = [c.alias(n) for n, (c, _) in columns.items() if n != "candidate_id"]
    return taken.select(
        F.col("_id").alias("candidate_id"),
        *rest,
        document.alias(DOCUMENT),
        found.alias(ERRORS),
    )


def _quoted(name: str) -> str:
    return json.dumps(name, ensure_ascii=False)


def accepted(projected: DataFrame) -> DataFrame:
    return projected.filter(F.size(ERRORS) == 0).drop(ERRORS)


def rejected(projected: DataFrame) -> DataFrame:
    """Candidates whose projection failed, with all their messages."""
    return projected.filter(F.size(ERRORS) > 0).select("candidate_id", F.col(ERRORS).alias("errors"))
