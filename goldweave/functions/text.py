"""Text cleaning as column expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character that Unicode counts as white space, and the separators
# U+001C..U+001F; as a plain class it is quicker than Java's (?U) classes.
WS_CHARS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS = f"[{WS_CHARS}]"
# those of ASCII, one by one: Java looks single characters up in a table, while
# it tries ranges one after the other on every character
ASCII_WS_CHARS = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f "
WS_TEXT = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000"
)


@F.arrow_udf(T.StringType())
def _nfkc(values: pa.Array) -> pa.Array:
    # not pyarrow's own utf8_normalize: it damages texts whose length changes
    if values.null_count == len(values):
        return values
    forms = (None if v is None else unicodedata.normalize("NFKC", v) for v in values.to_pylist())
    return pa.array(forms, pa.string())


# ranges of characters closer than this are one range of the quick check
NEAR = 64


@cache
def open_ranges() -> list[tuple[int, int]]:
    """Ranges that hold every character which NFKC can change, alone or behind
    another one: characters with another form, marks that combine, second
    parts of composed ones. Above the Latin letters, near ranges are joined."""
    def is_open(number: int) -> bool:
        char = chr(number)
        return bool(unicodedata.combining(char)) or unicodedata.normalize("NFKC", char) != char

    found = {n for n in range(0x80, sys.maxunicode + 1) if not 0xD800 <= n < 0xE000 and is_open(n)}
    for n in range(0x80, sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(n)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(int(parts[1], 16))
    # the vowels and final consonants that join a Hangul syllable
    found |= set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))
    out: list[list[int]] = []
    for n in sorted(found):
        if out and n - out[-1][1] <= (NEAR if n > 0x2FF else 1):
            out[-1][1] = n
        else:
            out.append([n, n])
    return [(a, b) for a, b in out]


@cache
def _open_class() -> str:
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in open_ranges()) + "]"


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def nfkc(text: Column) -> Column:
    """NFKC form. Spark has no built-in for it, so this is the one Python hop.
    Texts without a character that it can change, plain ASCII ones first of
    all, are sent as nulls and never leave the JVM."""
    may_change = ~is_ascii(text) & text.rlike(_open_class())
    return F.coalesce(_nfkc(F.when(may_change, text)), text)


def collapse(text: Column) -> Column:
    """Runs of white space to one blank, none at the ends; null becomes ''."""
    single = F.when(is_ascii(text), F.regexp_replace(text, f"[{ASCII_WS_CHARS}]+", " ")).otherwise(
        F.regexp_replace(text, f"{WS}+", " "))
    return F.coalesce(F.trim(single), F.lit(""))


def clean_text(text: Column) -> Column:
    return collapse(nfkc(text))


def strip(text: Column) -> Column:
    """White space off both ends (every kind of it, not only blanks)."""
    return F.btrim(text, F.lit(WS_TEXT))


def title_case(text: Column) -> Column:
    """Upper case after every character without case, lower case elsewhere."""
    cased = r"[\p{IsLowercase}\p{IsUppercase}\p{Lt}]"
    not_cased = r"[^\p{IsLowercase}\p{IsUppercase}\p{Lt}]"
    runs = F.regexp_extract_all(F.lower(text), F.lit(f"({cased}+|{not_cased}+)"), F.lit(1))

    def capital(run: Column) -> Column:
        head = F.upper(F.substring(run, 1, 1))
        # one letter may become two (sharp s): only the first stays upper case
        return F.concat(
            F.substring(head, 1, 1), F.lower(F.substr(head, F.lit(2))), F.substr(run, F.lit(2))
        )

    return F.array_join(F.transform(runs, capital), "")


def present(text: Column) -> Column:
    return text.isNotNull() & (text != "")
