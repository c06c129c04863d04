"""Column-expression helpers for markdown text (all JVM-side, codegen'd).

Regex notes: Spark runs Java regex. ``(?U)`` makes ``\\w \\d \\s \\b`` Unicode
aware (as Python 3 ``re`` is), ``(?d)`` restricts line terminators to LF
(Python's ``re.MULTILINE`` treats only ``\\n`` as a line end).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace (``str.isspace``), generated by rule: ``str.strip()`` and
# ``re``'s ``\s`` use exactly this set. Java's ``(?U)\s`` misses 0x1c-0x1f.
PY_WS = "".join(c for c in map(chr, range(0x110000)) if c.isspace())


def _class(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


WS = _class(PY_WS)  # regex character class (Java and RE2 both accept \x{h})
DIGIT = r"\p{Nd}"  # Python's Unicode \d

# Private-use control characters used as split sentinels inside one row.
SEP = "\u0001"
JOIN = "\u0003"
# Marker inserted after protected abbreviations; it ends in a letter so that
# later abbreviation patterns see a word character right before the next dot.
GUARD = "\u0002Q"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: a character-set trim, no regex."""
    return F.btrim(col_(c), F.lit(PY_WS))


def lstrip_ws(c: Column | str) -> Column:
    return F.ltrim(col_(c), F.lit(PY_WS))


def md5_bucket(c: Column | str) -> Column:
    """First 8 hex digits of md5 as a non-negative bigint (deterministic sampling key)."""
    return F.conv(F.substring(F.md5(col_(c)), 1, 8), 16, 10).cast("bigint")


def drop_last_extension(c: Column | str) -> Column:
    """``os.path.splitext(name)[0]`` for a bare file name (``a.b.md`` -> ``a.b``)."""
    c = col_(c)
    # a leading dot (".md") is not an extension separator for splitext
    return F.when(c.rlike(r"^\.[^.]*$"), c).otherwise(F.regexp_replace(c, r"\.[^./]*$", ""))


def basename(c: Column | str) -> Column:
    return F.element_at(F.split(col_(c), "/"), -1)


def header_title(section: Column, default: str | Column = "Section") -> Column:
    """Text after ``#+ `` on the first line of a section, stripped; else ``default``."""
    dflt = F.lit(default) if isinstance(default, str) else default
    return F.when(
        section.rlike(r"^#+ "), strip_ws(F.regexp_extract(section, r"^#+ ([^\n]*)", 1))
    ).otherwise(dflt)


def header_body(section: Column) -> Column:
    """Section without its first header line, stripped."""
    return strip_ws(F.regexp_replace(section, r"^#+ [^\n]*", ""))
