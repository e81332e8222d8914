"""Text rules as column expressions: Python's white space, answers as text and as numbers."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The code points that Python's str.strip() and str.split() take for white space.
PY_WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
DIGITS = r"[0-9](?:_?[0-9])*+"
FLOAT = rf"^[+-]?(?:(?:{DIGITS}\.?(?:{DIGITS})?|\.{DIGITS})(?:e[+-]?{DIGITS})?|inf|infinity|nan)$"
FRACTION = rf"^[+-]?{DIGITS}/{DIGITS}$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{PY_WS}+|{PY_WS}+$", "")


def first_filled(*texts: Column) -> Column:
    """The first text that is neither null nor empty, else ''."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts], F.lit(""))


def normalize_answer(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), PY_WS, "")


#: Decimal digits of all scripts, which Python's numbers may be written in.
SCRIPT_DIGITS = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.decimal(chr(c), None) is not None]


def ascii_digits(text: Column) -> Column:
    """Text with digits of other scripts as 0 to 9."""
    return F.when(text.rlike(r"[^\x00-\x7f]"), F.translate(text, "".join(SCRIPT_DIGITS), "".join(str(unicodedata.decimal(c)) for c in SCRIPT_DIGITS))).otherwise(text)


def quotient(over: Column, under: Column) -> Column:
    """Of two texts of whole numbers: as exact as a double is where both have 38 digits at most, else of their doubles; null for a zero below, or beyond doubles."""
    p, q = over.try_cast("decimal(38,0)"), under.try_cast("decimal(38,0)")
    exact = F.try_divide(p - p % q, q).cast("double") + (p % q).cast("double") / q.cast("double")
    rounded = F.try_divide(over.try_cast("double"), under.try_cast("double"))
    return F.coalesce(F.when(q != 0, exact), F.when(F.abs(rounded) < float("inf"), rounded))


def parse_numeric(normal: Column) -> Column:
    """A normalized answer as a number: a decimal, or a fraction of integers with a sign in front. Null for other text."""
    said = ascii_digits(normal)
    plain = F.replace(said, F.lit("_"), F.lit(""))
    fraction = quotient(F.split_part(plain, F.lit("/"), F.lit(1)), F.split_part(plain, F.lit("/"), F.lit(2)))
    return F.when(said.rlike(FRACTION), fraction).when(said.rlike(FLOAT), plain.try_cast("double"))


def equivalent_answer(model: Column, gold: Column) -> Column:
    m, g = normalize_answer(model), normalize_answer(gold)
    near = F.abs(parse_numeric(m) - parse_numeric(g)) <= 1e-9
    return (m != "") & (g != "") & ((m == g) | F.coalesce(near, F.lit(False)))
