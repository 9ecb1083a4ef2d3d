"""Text rules: labels, blanks, delimited lists and names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions._cells import as_column, trimmed_text

# Separators of list cells, noise at the ends of names, and texts that are no name.
LIST_SEPARATOR = r"\s*[,;|]\s*"
EDGE_NOISE = '\\" \t\n\x0b\f\r'
ABSENT_NAMES = ("", "N/A", "n/a", "None")
NUMBER_AS_NAME = r"^-?\d+([.,]\d+)?$"
IMAGE_PATH = r"(?i)^/|\.(jpg|jpeg|png)$"
NAME_LENGTH = (2, 60)


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and spaces-only cells."""
    return F.coalesce(trimmed_text(c) == "", F.lit(True))


def default_blank(c: Column | str, text: str) -> Column:
    """The cell, or ``text`` where the cell is blank."""
    return F.when(is_blank(c), F.lit(text)).otherwise(as_column(c))


def normalize_label(c: Column | str) -> Column:
    """Upper case, no hyphens at the ends, single spaces: ``-Post  production`` -> ``POST PRODUCTION``."""
    label = F.upper(F.trim(as_column(c)))
    return F.regexp_replace(F.regexp_replace(label, r"^-+|-+$", ""), r"\s+", " ")


def map_values(c: Column | str, values: Mapping[str, str], default: str) -> Column:
    """The value a small fixed dictionary gives, or ``default`` (also for NULL)."""
    known = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
    return F.coalesce(known[as_column(c)], F.lit(default))


def split_list(c: Column | str) -> Column:
    """The elements of a delimited cell; comma, semicolon and bar all separate."""
    return F.split(as_column(c), LIST_SEPARATOR)


def strip_edges(c: Column | str) -> Column:
    """The text without white space, quotes and backslashes at its ends."""
    return F.btrim(as_column(c), F.lit(EDGE_NOISE))


def is_name(
    c: Column | str,
    absent: Sequence[str] = ABSENT_NAMES,
    length: tuple[int, int] = NAME_LENGTH,
) -> Column:
    """True for text that can be a name: present, no number, no image path, of plausible length.

    The cheap tests come first, so the patterns only run on texts of plausible length.
    """
    text = as_column(c)
    return (
        text.isNotNull()
        & F.length(text).between(*length)
        & ~text.isin(*absent)
        & ~text.rlike(NUMBER_AS_NAME)
        & ~text.rlike(IMAGE_PATH)
    )


def title_case_words(c: Column | str) -> Column:
    """Title case for words written all upper or all lower; mixed-case words stay as they are.

    A text in one case, or in title case already, gives the same as title case of the whole text.
    Only the rest is taken apart word by word.
    """
    text = as_column(c)

    def word_case(word: Column) -> Column:
        one_case = (word == F.upper(word)) | (word == F.lower(word))
        return F.when(one_case, F.initcap(word)).otherwise(word)

    whole = F.initcap(text)
    uniform = (text == whole) | (text == F.lower(text)) | (text == F.upper(text))
    by_word = F.array_join(F.transform(F.split(text, " "), word_case), " ")
    return F.when(uniform, whole).otherwise(by_word)
