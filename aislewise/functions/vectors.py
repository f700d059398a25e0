"""Text form of sparse vectors (``key:value,key:value``) and of names."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# One HTML reference (named, decimal or hexadecimal), or other text.
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});|[^&]+|&"


def entry(rank: Column, text: Column, value: Column | None = None) -> Column:
    """One element for ``packed``: ``text`` or ``text:value`` at a place in the list."""
    if value is not None:
        text = F.concat(text, F.lit(":"), value.cast("string"))
    return F.struct(rank.alias("rank"), text.alias("text"))


def packed(entries: Column) -> Column:
    """Array of ``entry`` structs as comma-joined text in rank order."""
    return F.array_join(F.sort_array(entries)["text"], ",")


def unpack_vector(text: Column) -> Column:
    """Text to an array of structs (position, key, value); explode it with ``inline``."""
    parts = F.filter(F.split(text, ","), lambda s: s.contains(":"))
    return F.transform(
        parts,
        lambda s, i: F.struct(
            (i + 1).cast("int").alias("pos"),
            F.split_part(s, F.lit(":"), F.lit(1)).alias("key"),
            F.split_part(s, F.lit(":"), F.lit(2)).try_cast("bigint").alias("value"),
        ),
    )


def _character(code: Column) -> Column:
    """The character of a code point; null for what is none."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def html_unescaped(text: Column) -> Column:
    """Text with the named references of HTML 4 and numeric ones replaced, each once."""
    named = F.create_map(*[F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (f"&{name};", chr(code))])

    def character(part: Column) -> Column:
        digits = F.substring(part, F.lit(3), F.length(part) - 3)
        decimal = F.when(part.rlike("^&#[0-9]+;$"), _character(digits.try_cast("bigint")))
        hexadecimal = F.when(part.rlike("^&#[xX][0-9a-fA-F]+;$"), _character(
            F.conv(F.substring(digits, F.lit(2), F.length(digits)), 16, 10).try_cast("bigint")))
        found = decimal.isNotNull() | hexadecimal.isNotNull()
        return F.when(found, F.coalesce(decimal, hexadecimal)).otherwise(F.coalesce(named[part], part))

    parts = F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)), character)
    return F.when(text.contains("&"), F.array_join(parts, "")).otherwise(text)


def clean_name(name: Column) -> Column:
    """HTML-unescaped name without TAB."""
    return F.replace(html_unescaped(name), F.lit("\t"), F.lit(""))
