"""Cleaning, normalising and parsing of text columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    """NULL for the empty string; a text of spaces stays."""
    return F.nullif(_col(value), F.lit(""))


def upper_or_null(value: Column | str) -> Column:
    return blank_to_null(F.upper(_col(value)))


def concat_skip_null(*values: Column | str) -> Column:
    """Concatenate, leaving NULLs out; all NULL gives the empty string."""
    return F.concat_ws("", *[_col(value) for value in values])


# Ten digits in a row become five pairs.
PHONE_DIGITS = "^([0-9]{2})([0-9]{2})([0-9]{2})([0-9]{2})([0-9]{2})$"
PHONE_PAIRS = "$1 $2 $3 $4 $5"


def clean_phone(value: Column | str) -> Column:
    """Trim, blank to NULL, dots to spaces, and ten plain digits to pairs of two."""
    spaced = F.replace(blank_to_null(F.trim(_col(value))), F.lit("."), F.lit(" "))
    return F.regexp_replace(spaced, PHONE_DIGITS, PHONE_PAIRS)


def _accent_pairs() -> tuple[str, str]:
    """Accented Latin letters and their ASCII base, by canonical decomposition.

    Combining marks come last, beyond the length of the replacement, so that
    translate() drops them.
    """
    accented, plain = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)[0]
        if base != letter and base.isascii():
            accented.append(letter)
            plain.append(base)
    marks = [chr(code) for code in range(0x0300, 0x0370) if unicodedata.category(chr(code)) == "Mn"]
    return "".join(accented + marks), "".join(plain)


ACCENTED, UNACCENTED = _accent_pairs()

# Latin letters without a canonical decomposition.
STROKES = ("ØøŁłĐđĦħŦŧı", "OoLlDdHhTti")
LIGATURES = {"Œ": "OE", "œ": "oe", "Æ": "AE", "æ": "ae", "ß": "ss", "ẞ": "SS"}


def unaccent(value: Column | str) -> Column:
    """Latin text without accents, strokes and ligatures."""
    text = plain = _col(value)
    for ligature, letters in LIGATURES.items():
        plain = F.replace(plain, F.lit(ligature), F.lit(letters))
    plain = F.translate(plain, STROKES[0] + ACCENTED, STROKES[1] + UNACCENTED)
    # ASCII text has one byte per character and nothing to replace.
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(plain)


def replace_first(value: Column | str, pattern: str, replacement: str = "") -> Column:
    """Replace the first match only; the pattern must hold no group of its own."""
    return F.regexp_replace(_col(value), f"(?s)^(.*?){pattern}", f"$1{replacement}")


def search_group(value: Column | str, pattern: str, ignore_case: bool = True) -> Column:
    """Group 1 of the first match, NULL without one; a group may match an empty text."""
    pattern = ("(?iu)" if ignore_case else "") + pattern
    return F.when(_col(value).rlike(pattern), F.regexp_extract(_col(value), pattern, 1))


def iso_date(value: Column | str, strict: bool = True) -> Column:
    """A date from yyyy-mm-dd or yyyy/mm/dd; an impossible one raises, or gives NULL."""
    text = F.replace(_col(value), F.lit("/"), F.lit("-"))
    return F.to_date(text, "yyyy-MM-dd") if strict else F.try_to_date(text, "yyyy-MM-dd")


# Fixed value: a parenthesised part without an opening parenthesis inside.
PARENTHESES = r"\([^\(]*\)"


def squash(value: Column | str) -> Column:
    """Lower case, no accents, no whitespace: the key of a name written as one text."""
    return F.lower(unaccent(F.regexp_replace(_col(value), r"\s", "")))


def person_key(first: Column | str, last: Column | str, strip_first: bool = False) -> Column:
    """The key of a name in two columns.

    Whitespace and the first parenthesised part leave the surname only, so first names of
    two words match no squashed text unless ``strip_first`` is set.
    """
    given = squash(first) if strip_first else F.lower(unaccent(first))
    surname = F.regexp_replace(_col(last), r"\s", "")
    family = F.lower(unaccent(replace_first(surname, PARENTHESES)))
    return F.trim(concat_skip_null(given, family))
