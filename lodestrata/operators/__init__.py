"""DataFrame -> DataFrame operators on any table; column names are arguments."""

from lodestrata.operators.analytics import (
    count_per_class,
    in_last_months,
    latest_past_date,
    rank_top,
    sum_total,
    top_n,
)
from lodestrata.operators.cleaning import (
    distrust_shifted_rows,
    drop_exact_duplicates,
    flag_shifted_rows,
    keep_members,
    keep_names,
)
from lodestrata.operators.dedup import keep_latest_and_most_complete, keep_latest_rows
from lodestrata.operators.documents import (
    assemble_sentence,
    money_words,
    names_per_key,
    names_per_role,
)
from lodestrata.operators.explode import explode_entities, explode_list
from lodestrata.operators.keys import dense_key
from lodestrata.operators.quality import (
    Measures,
    QualityGateFailed,
    Rule,
    quality_report,
    raise_on_failures,
)
from lodestrata.operators.series import (
    calendar,
    calendar_between,
    fill_forward,
    latest_per_day,
    latest_value,
    require_value,
)
from lodestrata.operators.star import Side, bridge, dimension, fact, orphans, summary_dimension, unmatched

__all__ = [
    "Measures",
    "QualityGateFailed",
    "Rule",
    "Side",
    "assemble_sentence",
    "bridge",
    "calendar",
    "calendar_between",
    "count_per_class",
    "dense_key",
    "dimension",
    "distrust_shifted_rows",
    "drop_exact_duplicates",
    "explode_entities",
    "explode_list",
    "fact",
    "fill_forward",
    "flag_shifted_rows",
    "in_last_months",
    "keep_latest_and_most_complete",
    "keep_latest_rows",
    "keep_members",
    "keep_names",
    "latest_past_date",
    "latest_per_day",
    "latest_value",
    "money_words",
    "names_per_key",
    "names_per_role",
    "orphans",
    "quality_report",
    "raise_on_failures",
    "rank_top",
    "require_value",
    "sum_total",
    "summary_dimension",
    "top_n",
    "unmatched",
]
