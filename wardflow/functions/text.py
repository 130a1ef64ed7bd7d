"""Text expressions: white space, label lookup, accents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# The characters that count as white space. Java's Unicode class
# leaves out the four separators U+001C to U+001F, so they are listed.
WHITESPACE = r"(?U)[\s\x1c-\x1f]"

# Cell texts that stand for a missing value in a raw file.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Accented letters and the letters they fold to.
ACCENTED = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿÀÂÄÁÃÅÇÉÈÊËÍÌÎÏÑÓÒÔÖÕÚÙÛÜÝ"
UNACCENTED = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"

# Above this many keys a lookup is a join, not an expression.
MAX_INLINE_KEYS = 50


def squeeze(col: Column) -> Column:
    """Strip the ends and turn every run of white space into one space."""
    return F.trim(F.regexp_replace(col, WHITESPACE + "+", " "))


def strip(col: Column) -> Column:
    """Strip white space of any kind from both ends."""
    return F.regexp_replace(col, f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def normalise(col: Column) -> Column:
    """Lower case, stripped, single spaces; accents are kept."""
    return F.lower(squeeze(col))


def missing_to_null(col: Column, tokens=NULL_TOKENS) -> Column:
    """Null where the text is one of the missing-value tokens."""
    return F.when(~col.isin(*tokens), col)


def fold_accents(col: Column) -> Column:
    """Replace accented letters by their base letter; drop what is left outside ASCII."""
    return F.regexp_replace(F.translate(col, ACCENTED, UNACCENTED), r"[^\x00-\x7F]", "")


def is_normal(text: str) -> bool:
    """Whether a label is already what :func:`normalise` would return."""
    return " ".join(text.split()).lower() == text


def inline_map(mapping: Mapping) -> Column:
    """A constant map column from a Python dictionary."""
    return F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])


def lookup(col: Column, mapping: Mapping) -> Column:
    """Value of ``col`` in a small dictionary, null when it has none."""
    return F.try_element_at(inline_map(mapping), col)


def lookup_label(col: Column, mapping: Mapping[str, str]) -> Column:
    """Official label of a free text, null when the text matches none.

    Only keys in normal form can ever match. Most cells match after a plain
    trim; the regular expression runs for the others alone, and cannot change
    the result of those that matched.
    """
    reachable = {key: value for key, value in mapping.items() if is_normal(key)}
    return F.coalesce(
        lookup(F.lower(F.trim(col)), reachable),
        lookup(normalise(col), reachable),
    )
