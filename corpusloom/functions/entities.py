"""Character references in text."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import let, replace_each

_NAMES = {name: chr(code) for name, code in name2codepoint.items()}
REFERENCE = r"&#?[A-Za-z0-9_]+;"


def _from_code(code: Column) -> Column:
    """The character of a code point; null where there is none."""
    number = code.cast("long")
    valid = number.between(0, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


def _character(reference: Column) -> Column:
    code = F.regexp_extract(reference, r"^&#?([A-Za-z0-9_]+);$", 1)
    names = F.from_json(F.lit(json.dumps(_NAMES)), "map<string,string>")  # folded into one constant
    digits = F.regexp_extract(code, r"^0*([0-9]{1,9})$", 1)
    hex_digits = F.regexp_extract(code, r"^x0*([0-9A-Fa-f]{1,8})$", 1)
    return (
        F.when(~reference.startswith("&#"), F.element_at(names, code))
        .when(digits != "", _from_code(digits))
        .when(hex_digits != "", _from_code(F.conv(hex_digits, 16, 10)))
    )


_FREQUENT = {name: _NAMES[name] for name in ("lt", "gt", "quot", "nbsp")}
_OTHER = r"&(?!amp;)#?[A-Za-z0-9_]+;"


def unescape(text: Column) -> Column:
    """Decode ``&name;``, ``&#n;`` and ``&#xh;`` once; unknown ones stay as they are.

    Names whose character starts no reference are replaced first as plain strings.
    """
    plain = text
    for name, character in _FREQUENT.items():
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(character))
    decoded = let(
        plain,
        lambda t: F.when(
            t.rlike(_OTHER), replace_each(t, REFERENCE, lambda m: F.coalesce(_character(m), m))
        ).otherwise(F.replace(t, F.lit("&amp;"), F.lit("&"))),
    )
    return F.when(text.contains("&"), decoded).otherwise(text)
