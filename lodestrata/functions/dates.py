"""Date rule: one column, several written forms."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions._cells import trimmed_text

# The date forms tried, in this order, and the text each one needs.
DATE_FORMS = (
    ("yyyy-MM-dd", r"^\d{4}-\d{2}-\d{2}$"),
    ("MM-dd-yyyy", r"^\d{2}-\d{2}-\d{4}$"),
    ("dd/MM/yyyy", r"^\d{2}/\d{2}/\d{4}$"),
)


def _iso_text(text: Column, form: str) -> Column:
    """The year, month and day parts of a text in ``form``, in ISO order."""
    parts = (F.substring(text, form.index(part) + 1, len(part)) for part in ("yyyy", "MM", "dd"))
    return F.concat_ws("-", *parts)


def multi_date(c: Column | str, forms: Iterable[tuple[str, str]] = DATE_FORMS) -> Column:
    """The date of the first form whose pattern matches and whose day exists, else NULL.

    A line end after the date is no part of any form, though ``$`` would pass over it.

    A form places ``yyyy``, ``MM`` and ``dd`` at fixed positions. The parts are put in ISO order and
    cast, which is several times faster than a date parser per form.
    """
    text = trimmed_text(c)
    return F.coalesce(
        *(
            F.when((F.length(text) == len(form)) & text.rlike(p), _iso_text(text, form).try_cast("date"))
            for form, p in forms
        )
    )
