"""Text documents assembled from a star."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _listed(names: Column) -> Column:
    """The distinct names in alphabetical order as one text; no names give NULL."""
    found = F.sort_array(F.collect_set(names))
    return F.when(F.size(found) > 0, F.array_join(found, ", "))


def names_per_key(
    links: DataFrame, members: DataFrame, on: str, key: str, name: str, output: str
) -> DataFrame:
    """The distinct names linked to each key, in alphabetical order, as one text.

    The text is one cell of the result, as long as the list cells the links came from.
    """
    named = links.join(members.select(on, name), on, "inner")
    return named.groupBy(key).agg(_listed(F.col(name)).alias(output))


def names_per_role(
    links: DataFrame,
    members: DataFrame,
    on: str,
    key: str,
    name: str,
    role: str,
    output_of_role: Mapping[str, str],
) -> DataFrame:
    """``names_per_key`` for several roles side by side, in one pass over the links."""
    chosen = members.filter(F.col(role).isin(*output_of_role)).select(on, name, role)
    texts = [
        _listed(F.when(F.col(role) == wanted, F.col(name))).alias(output)
        for wanted, output in output_of_role.items()
    ]
    return links.join(chosen, on, "inner").groupBy(key).agg(*texts)


def money_words(c: Column | str, currency: str) -> Column:
    """``US$ 1,234,567.00``; NULL stays NULL."""
    return F.concat(F.lit(f"{currency} "), F.format_number(c, 2))


def assemble_sentence(parts: Sequence[str | tuple[Column, str]]) -> Column:
    """Fixed words and values in turn; each value brings the words used when it is missing."""
    pieces = []
    for part in parts:
        if isinstance(part, str):
            pieces.append(F.lit(part))
        else:
            value, missing = part
            pieces.append(F.coalesce(value.cast("string"), F.lit(missing)))
    return F.concat(*pieces)
