"""Text helpers: blanks, JSON payloads, name matching."""

from __future__ import annotations

import unicodedata
from itertools import chain

from pyspark.sql import Column, functions as F

# Characters stripped from both ends of a file cell.
BLANKS = (" \t\r\n\v\f\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
          "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

# Barred and stroked letters, which no rule takes apart, and letter pairs.
STROKED = {"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ħ": "h", "Ħ": "H"}
PAIRS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE"}


def _plain_letters() -> dict[str, str]:
    """Accented Latin letters and the letter each is built on."""
    letters = [chr(c) for c in chain(range(0xC0, 0x250), range(0x1E00, 0x1F00))]
    bases = {x: unicodedata.normalize("NFD", x)[0] for x in letters}
    return {x: base for x, base in bases.items() if base != x and base.isascii()} | STROKED


PLAIN_LETTERS = _plain_letters()


def cell(column: Column) -> Column:
    """A file cell as the loader sees it: missing is empty, ends are stripped."""
    return F.btrim(F.coalesce(column, F.lit("")), F.lit(BLANKS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def whole_number(text: Column, default: int = 0) -> Column:
    """Signed digits as an integer; empty or malformed text gives the default."""
    return F.coalesce(F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("int")),
                      F.lit(default))


def real_number(text: Column, default: float = 0.0) -> Column:
    """Decimal or exponent notation as a double; anything else gives the default."""
    shape = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
    return F.coalesce(F.when(text.rlike(shape), text.try_cast("double")), F.lit(default))


def zero_to_null(number: Column) -> Column:
    return F.when(number != 0, number)


def json_payload(**fields: Column) -> Column:
    """A JSON object that keeps null members."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]),
                     {"ignoreNullFields": "false"})


def channel(prefix: str, *parts: Column) -> Column:
    """``prefix:part:part``; a missing part is left empty."""
    return F.concat_ws(":", F.lit(prefix),
                       *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def unaccent(text: Column) -> Column:
    plain = F.translate(text, "".join(PLAIN_LETTERS), "".join(PLAIN_LETTERS.values()))
    for pair, letters in PAIRS.items():
        plain = F.replace(plain, F.lit(pair), F.lit(letters))
    return plain


# What separates words, and the pieces of a word padded two before, one after.
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"
PIECE = r"(?=(  [^ ]| [^ ]{2}| [^ ] |[^ ]{3}|[^ ]{2} ))"


def tokens(text: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.array_remove(F.split(F.lower(text), BETWEEN_WORDS), ""))


def trigrams(text: Column) -> Column:
    """Distinct three-letter pieces of each word, padded two before and one after.

    Words are set three blanks apart, the padding of both neighbours; the pattern then takes
    every piece that lies within one word's padding.
    """
    spaced = F.concat(F.lit("  "), F.regexp_replace(F.lower(text), BETWEEN_WORDS, "   "), F.lit(" "))
    return F.array_distinct(F.regexp_extract_all(spaced, F.lit(PIECE), F.lit(1)))


def overlap_share(a: Column, b: Column) -> Column:
    """Size of the common part of two sets over the size of their union."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.coalesce(F.try_divide(common, union), F.lit(0.0))
