"""Phone numbers and mail addresses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import COUNTRY_PREFIX
from .text import ASCII_WS_CHARS, WS_CHARS, is_ascii, strip


def _reads_as_address(white: str) -> str:
    part = f"[^@{white}]"
    return rf"^{part}+@{part}+\.{part}+$"


def phone_e164(raw: Column) -> Column:
    """Digits and plus signs only; ten digits get the home country prefix.

    Null when nothing usable is left: a short number is never completed.
    """
    digits = F.regexp_replace(raw, r"(?U)[^\d+]", "")
    local = F.regexp_replace(digits, "^0+", "")
    return (
        F.when(digits.startswith("+"), digits)
        .when(F.length(local) == 10, F.concat(F.lit("+" + COUNTRY_PREFIX), local))
        .when(F.length(local) > 10, F.concat(F.lit("+"), local))
    )


def email_address(raw: Column) -> Column:
    """Trimmed lower-case address, null unless it reads name@host.tld."""
    address = F.lower(strip(raw))
    good = F.when(is_ascii(address), address.rlike(_reads_as_address(ASCII_WS_CHARS))).otherwise(
        address.rlike(_reads_as_address(WS_CHARS)))
    return F.when(good, address)
