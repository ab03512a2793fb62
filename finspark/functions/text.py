"""Text helpers with Python string semantics, as JVM regex expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python treats as whitespace (str.strip) and as
# line boundaries (str.splitlines).
WHITESPACE_CLASS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
TOKEN = r"[a-z0-9]+"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# The same whitespace set as literal characters, for trim(BOTH ... FROM ...).
WHITESPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200b))
                    + "\u2028\u2029\u202f\u205f\u3000")


def py_strip(x: Column | str) -> Column:
    """``str.strip()``: drop leading / trailing whitespace (Python's set)."""
    return F.trim(_c(x), F.lit(WHITESPACE_CHARS))


def split_lines(x: Column | str) -> Column:
    """``str.splitlines()``: split on every line boundary; a trailing
    boundary does not produce a final empty line; '' -> []."""
    parts = F.split(_c(x), LINE_BREAK, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def contains_any(text: Column, terms) -> Column:
    cond = None
    for t in terms:
        c = F.instr(text, t) > 0
        cond = c if cond is None else (cond | c)
    return cond if cond is not None else F.lit(False)


def tokens(x: Column | str) -> Column:
    """Lower-cased ASCII word tokens."""
    return F.regexp_extract_all(F.lower(_c(x)), F.lit(TOKEN), 0)


def term_bucket(token: Column, bits: int = 60) -> Column:
    """Stable term hash: the first ``bits / 4`` hex digits of md5(token); 60 bits keep terms apart."""
    return F.conv(F.substring(F.md5(token), 1, bits // 4), 16, 10).cast("bigint")
