"""Values of untyped JSON, read from VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# JSON texts that count as nothing given; a zero may be written in many ways
EMPTY_VALUE = r'^(null|false|""|\[\s*\]|\{\s*\}|-?0(\.0+)?([eE].*)?)$'
BLANKS = " \t\n\r"


def computed_once(table: DataFrame) -> DataFrame:
    """The same rows behind a generator. A later filter on a computed column
    would otherwise move below and parse the payload again for every part of
    its condition."""
    return table.select(F.inline(F.array(F.struct(*table.columns))))


def parse(payload: Column) -> Column:
    return F.try_parse_json(payload)


def is_text(json: Column) -> Column:
    return json.startswith('"')


def usable(json: Column) -> Column:
    """Neither absent nor null, false, zero, nor an empty text or container."""
    return F.coalesce(~json.rlike(EMPTY_VALUE), F.lit(False))


def whole(payload: Column) -> Column:
    """The document as it was written, without outer blanks."""
    return F.btrim(payload, F.lit(BLANKS))


def attribute(document: Column, key: str) -> Column:
    """Characters of one attribute and whether it is a text. Null when there
    is nothing usable: no attribute, null, false, zero, empty."""
    return usable_value(F.try_variant_get(document, f"$.{key}", "variant"))


def usable_value(value: Column) -> Column:
    """The same for an attribute at hand."""
    read = F.struct(
        F.try_variant_get(value, "$", "string").alias("chars"), (F.schema_of_variant(value) == "STRING").alias("text"))
    return F.transform(F.array(read), lambda a: F.when(
        a["text"] & (a["chars"] != "") | ~a["text"] & ~a["chars"].rlike(EMPTY_VALUE), a
    ))[0]


def known(payload: Column, keys: list[str]) -> Column:
    """The known attributes of an object as VARIANT each, and `_broken` where
    the text is none. Of a repeated key the last counts; NaN is a number; what
    other attributes hold is skipped."""
    schema = ", ".join(f"{k} variant" for k in keys)
    return F.from_json(payload, f"{schema}, _broken string", {"columnNameOfCorruptRecord": "_broken"})


def malformed(text: Column, broken: Column) -> Column:
    """Whether a text without outer blanks is no JSON. Objects are judged by
    `known`; something behind the closing brace does not belong to one."""
    an_object = text.startswith("{")
    return F.when(an_object, broken.isNotNull() | ~text.endswith("}")).otherwise(
        F.coalesce((text != "") & F.try_parse_json(text).isNull(), F.lit(False)))


def written_text(value: Column) -> Column:
    """A text as it is, an empty one too; nothing else."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def text_value(value: Column) -> Column:
    """A text or a number as text, nothing else."""
    kind = F.schema_of_variant(value)
    return F.when(~kind.rlike("^(OBJECT|ARRAY|VOID|BOOLEAN)"), F.try_variant_get(value, "$", "string"))


def text_of(json: Column) -> Column:
    """The characters of a JSON text (quotes and escapes resolved)."""
    return F.variant_get(F.try_parse_json(json), "$", "string")
