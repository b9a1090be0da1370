"""Network names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quietband import config as C


def decode_ssid(hex_cell: Column) -> Column:
    """Text of a hex SSID cell, ``<hidden>`` when empty, ``<hex:..>`` when not UTF-8."""
    raw = F.trim(F.coalesce(hex_cell, F.lit("")))
    text = F.try_validate_utf8(F.unhex(F.when(F.length(raw) % 2 == 0, raw)).cast("string"))
    return F.when(raw.isin("", "<MISSING>"), C.HIDDEN).otherwise(
        F.coalesce(text, F.concat(F.lit("<hex:"), raw, F.lit(">")))
    )


def single_line(text: Column) -> Column:
    """Tabs and line breaks become spaces, so that one name stays one cell."""
    return F.translate(text, "\t\n\r", "   ")


def short_ssid(ssid: Column) -> Column:
    """CRC-32 of the UTF-8 bytes, the value neighbor reports carry."""
    return F.crc32(F.encode(ssid, "UTF-8"))


def short_ssid_value(cell: Column) -> Column:
    """Integer value of an advertised short-SSID cell in hex, NULL when it is not hex."""
    digits = F.regexp_extract(cell, "^ *(?:0[xX])?([0-9a-fA-F]+) *$", 1)
    return F.when(F.length(digits).between(1, 16), F.conv(digits, 16, 10).try_cast("bigint"))


def _first_match(text: Column, patterns: tuple[tuple[str, str], ...]) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(patterns):
        out = F.when(text.rlike("(?iu)" + pattern), F.lit(name)).otherwise(out)
    return out


def classify(ssid: Column) -> dict[str, Column]:
    """Name features.  A shared-service match overrides the default-name provider."""
    text = F.coalesce(ssid, F.lit(""))
    default = _first_match(text, C.DEFAULT_SSID_PATTERNS)
    shared = _first_match(text, C.SHARED_SSID_PATTERNS)
    return {
        "hidden": text == "",
        "length": F.length(text).cast("bigint"),
        "isp_default": default.isNotNull(),
        "provider_family": F.coalesce(shared, default),
        "shared_service": shared.isNotNull(),
    }
