"""Clean tables of the movie catalogue from the raw ones.

A parsed cell becomes a column before a rule uses it more than once: Spark keeps such steps apart, so
each cell is parsed once.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lodestrata import functions as rules
from lodestrata.operators import (
    distrust_shifted_rows,
    drop_exact_duplicates,
    explode_entities,
    explode_list,
    fill_forward,
    flag_shifted_rows,
    keep_latest_and_most_complete,
    keep_members,
    keep_names,
    latest_per_day,
    latest_value,
    require_value,
)
from lodestrata.plans import catalogue as c


def movie_info(raw: DataFrame) -> DataFrame:
    """``tb_info_filmes``: one row per movie; completeness counts the raw text of the other cells."""
    status = rules.map_values(
        rules.normalize_label("status_filme"), c.STATUS_LABELS, c.UNKNOWN_STATUS
    )
    named = raw.withColumnsRenamed(c.INFO_NAMES).withColumn("status_filme", status)
    newest = keep_latest_and_most_complete(named, "id_filme")
    typed = newest.withColumns(
        {
            "duracao_minutos": rules.safe_number("duracao_minutos", "int"),
            "data_lancamento": rules.multi_date("release_date"),
        }
    )
    return typed.withColumn("ano_lancamento", F.year("data_lancamento")).select(*c.INFO_COLUMNS)


def movie_financials(raw: DataFrame, rate: Column | float) -> DataFrame:
    """``tb_financeiro_filmes``: amounts in both currencies, profit and margin, one row per movie."""
    amounts = ("orcamento_usd", "receita_usd")
    parsed = raw.withColumnsRenamed(c.FINANCIAL_NAMES).withColumns(
        {a: rules.money(a) for a in amounts}
    )
    positive = parsed.withColumns({a: rules.null_non_positive(a) for a in amounts})

    def derived(rows: DataFrame) -> DataFrame:
        converted = rows.withColumns(
            {
                "orcamento_brl": rules.convert_currency("orcamento_usd", rate),
                "receita_brl": rules.convert_currency("receita_usd", rate),
            }
        )
        return converted.withColumns(
            {
                "lucro_usd": rules.profit("receita_usd", "orcamento_usd"),
                "lucro_brl": rules.profit("receita_brl", "orcamento_brl"),
                "margem_lucro_percentual": rules.margin_percent("receita_usd", "orcamento_usd"),
            }
        )

    return keep_latest_and_most_complete(positive, "id_filme", derive=derived).select(*c.FINANCIAL_COLUMNS)


def movie_metrics(raw: DataFrame) -> DataFrame:
    """``tb_metricas_engajamento``: ratings and counts, one row per movie.

    Slipped rows are told by their raw text, so they are flagged before anything is converted.
    """
    text = raw.withColumnsRenamed(c.METRIC_NAMES).withColumn(
        "popularidade", rules.decimal_comma("popularidade")
    )
    witnesses = {w: c.METRIC_TYPES[w] for w in c.SHIFT_WITNESSES}
    flagged = flag_shifted_rows(text, witnesses, "_slipped")
    numbers = flagged.withColumns(
        {column: rules.safe_number(column, kind) for column, kind in c.METRIC_TYPES.items()}
    )
    valid = numbers.withColumns(
        {column: rules.null_outside(column, *limits) for column, limits in c.METRIC_LIMITS.items()}
    )
    trusted = distrust_shifted_rows(valid, ["popularidade"], "_slipped")
    return keep_latest_and_most_complete(trusted, "id_filme").select(*c.METRIC_COLUMNS)


def user_reviews(raw: DataFrame) -> DataFrame:
    """``tb_avaliacoes_usuarios``: no exact copies, ratings on the scale, no blank comments.

    Readable ratings are compared as numbers, unreadable ones and comments as they came: two reviews that
    differ in an unreadable rating are two reviews.
    """
    named = raw.withColumnsRenamed(c.REVIEW_NAMES).select(*c.REVIEW_COLUMNS)
    is_text = isinstance(named.schema["nota_usuario"].dataType, StringType)
    number = rules.safe_number("_as_came") if is_text else F.col("nota_usuario").cast("double")
    text = named.withColumn("_as_came", F.col("nota_usuario").cast("string"))
    read = text.withColumn("nota_usuario", number)
    compared = read.withColumn("_as_came", F.coalesce(F.col("nota_usuario").cast("string"), "_as_came"))
    return (
        drop_exact_duplicates(compared, [*c.REVIEW_COLUMNS, "_as_came"])
        .withColumns(
            {
                "nota_usuario": rules.null_outside("nota_usuario", *c.RATING_SCALE),
                "comentario_usuario": rules.default_blank("comentario_usuario", c.NO_COMMENT),
            }
        )
        .select(*c.REVIEW_COLUMNS)
    )


def movie_genres(raw: DataFrame) -> DataFrame:
    """``tb_generos``: the valid genres of each movie."""
    genres = keep_members(explode_list(raw, "id", "genres", "nome_genero"), "nome_genero", c.GENRES)
    named = genres.withColumnRenamed("id", "id_filme")
    return drop_exact_duplicates(named, named.columns)


def people_and_companies(raw: DataFrame) -> DataFrame:
    """``tb_pessoas_empresas``: the names in the four credit columns with the role each column gives."""
    found = explode_entities(raw, "id", c.KIND_OF_COLUMN, "nome_entidade", "tipo_entidade", once=True)
    names = keep_names(found, "nome_entidade").withColumn(
        "nome_entidade", rules.title_case_words("nome_entidade")
    )
    named = names.select(F.col("id").alias("id_filme"), "nome_entidade", "tipo_entidade")
    return drop_exact_duplicates(named, named.columns)


def daily_rates(raw: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """``tb_cotacao_dolar``: a rate for every day from the first stored one (or ``start``) to ``end``."""
    per_day = latest_per_day(
        raw, "dataHoraCotacao", "cotacaoCompra", "data_cotacao", "cotacao_dolar"
    )
    return fill_forward(
        per_day, "data_cotacao", "cotacao_dolar", start, end, from_first_value=True
    )


def current_rate(rates: DataFrame) -> Column:
    """The latest known rate, for use inside other plans; no rate at all stops the job."""
    return require_value(latest_value(rates, "data_cotacao", "cotacao_dolar"), c.NO_RATE)
