"""Text cleaning and folding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that become one plain letter, and those that become several.
ACCENTED = "áàâäãåéèêëíìîïóòôöõøúùûüýñçšžđł"
PLAIN = "aaaaaaeeeeiiiioooooouuuuyncszdl"
SPELLED_OUT = {"æ": "ae", "œ": "oe", "ß": "ss", "&": "and"}
# Characters of plain text in lower case that are dropped.
DROPPED = "".join(c for c in map(chr, range(128))
                  if not ("a" <= c <= "z" or c.isdigit() or c in SPELLED_OUT))

SEPARATOR = "\x01"


def clean_text(text: Column) -> Column:
    """Collapse whitespace runs to one space and trim; blank becomes null."""
    return F.nullif(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


def upper_name(text: Column) -> Column:
    """A controlled value as the tables hold it: cleaned, upper case."""
    return F.upper(clean_text(text))


def _spelled_out(text: Column, letters: dict[str, str]) -> Column:
    return reduce(lambda column, pair: F.replace(column, *map(F.lit, pair)), letters.items(), text)


def _folded(text: Column, keep: str) -> Column:
    one_to_one = F.translate(F.lower(text), ACCENTED, PLAIN)
    left = F.regexp_replace(one_to_one, f"[^a-z0-9{''.join(SPELLED_OUT)}{keep}]+", "")
    return _spelled_out(left, SPELLED_OUT)


def fold(text: Column, *, keep: str = "") -> Column:
    """Lower-case letters and digits only, by which spellings of one name are equal.

    Data and vocabularies are both folded by this function. Characters in ``keep`` stay.
    All letters that become one letter go in one pass; what is dropped is dropped before
    the few others are looked for, in a text that is shorter by then. A text of one byte a
    character has no accented letters, and is cleared without a regular expression. ``text``
    is referred to several times: of what is costly, a column.
    """
    text = text.cast("string")
    dropped = "".join(c for c in DROPPED if c not in keep)
    plain = _spelled_out(F.translate(F.lower(text), dropped, ""),
                         {c: long for c, long in SPELLED_OUT.items() if c.isascii()})
    one_byte = (F.octet_length(text) == F.length(text)) & F.is_valid_utf8(text)
    return F.when(one_byte, plain).otherwise(_folded(text, keep))


def fold_elements(values: Column) -> Column:
    """``fold`` of every element that is not null.

    The elements are folded as one string and split again, so the string functions run
    once per array and not once per element.
    """
    cleared = F.transform(values, lambda v: F.replace(v, F.lit(SEPARATOR), F.lit("")))
    # Within an array expressions are interpreted, so the form that names its text once.
    return F.split(_folded(F.array_join(cleared, SEPARATOR), SEPARATOR), SEPARATOR)
