"""The quality rules of the star schema and the gate that stops a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lodestrata.functions import is_blank
from lodestrata.operators import Measures, Rule, orphans, quality_report, raise_on_failures, unmatched
from lodestrata.operators.quality import count_where
from lodestrata.plans import catalogue as c

# Bridge key checks: label of the check, bridge, dimension, key.
BRIDGE_CHECKS = (
    ("genre->movie", "bridge_genre", "dim_movies", "sk_movie_id"),
    ("genre->genre", "bridge_genre", "dim_genres", "sk_genre_id"),
    ("person->movie", "bridge_person", "dim_movies", "sk_movie_id"),
    ("person->person", "bridge_person", "dim_people", "sk_person_id"),
    ("company->movie", "bridge_company", "dim_movies", "sk_movie_id"),
    ("company->company", "bridge_company", "dim_companies", "sk_company_id"),
)


def _list_orphans(measures: Measures) -> Column:
    """The checks with orphans, written as ``{'check': n, ...}``."""
    checks = F.array(
        *(
            F.when(
                measures[label] > 0,
                F.concat(F.lit(f"'{label}': "), measures[label].cast("string")),
            )
            for label, *_ in BRIDGE_CHECKS
        )
    )
    listed = F.array_join(F.array_compact(checks), ", ")
    return F.concat(F.lit("chaves órfãs: {"), listed, F.lit("}"))


# Wording of the rules: fixed values.
GRAIN = Rule(
    c.RULE_GRAIN,
    ["fact_copies"],
    "{fact_rows} linhas, uma por filme",
    "{fact_rows} linhas para {fact_keys} filmes distintos (grão duplicado)",
)
COVERAGE = Rule(
    c.RULE_COVERAGE,
    ["missing", "extra"],
    "{fact_rows} filmes lançados na fato",
    "{missing} lançados fora da fato e {extra} filmes na fato que não são lançados",
)
CONTEXT = Rule(
    c.RULE_CONTEXT,
    ["blank_documents", "row_difference"],
    "{documents} documentos, um por filme, nenhum vazio",
    "{blank_documents} documentos vazios/nulos e {row_difference} linhas de diferença "
    "para dim_movies",
)
GENRES = Rule(
    c.RULE_GENRES,
    ["strange_genres"],
    "{genres} gêneros, todos do domínio",
    "{strange_genres} gêneros fora do domínio",
)
BRIDGES = Rule(
    c.RULE_BRIDGES,
    [label for label, *_ in BRIDGE_CHECKS],
    "todas as chaves das bridges existem nas dimensões",
    _list_orphans,
)
RATINGS = Rule(
    c.RULE_RATINGS,
    ["movie_ratings_off", "user_ratings_off"],
    "todas as notas estão entre 0 e 10",
    lambda m: F.concat(
        (m["movie_ratings_off"] + m["user_ratings_off"]).cast("string"),
        F.lit(" notas fora do intervalo de 0 a 10"),
    ),
)
MONEY = Rule(
    c.RULE_MONEY,
    ["negative_amounts", "wrong_profits"],
    "sem valores negativos e lucro = receita - orçamento",
    "{negative_amounts} valores negativos e {wrong_profits} lucros incoerentes",
)


def _grain(fact: DataFrame) -> DataFrame:
    per_key = fact.groupBy("sk_movie_id").agg(F.count(F.lit(1)).alias("_rows"))
    rows = F.coalesce(F.sum("_rows"), F.lit(0))
    keys = F.count(F.lit(1))
    return per_key.agg(
        rows.alias("fact_rows"), keys.alias("fact_keys"), (rows - keys).alias("fact_copies")
    )


def _grain_and_coverage(fact: DataFrame, movies: DataFrame) -> DataFrame:
    """The numbers of both rules from one join of the counted keys."""
    released = movies.filter(F.col("status_filme") == c.RELEASED)
    return unmatched(fact, released, "sk_movie_id").select(
        F.col("left_rows").alias("fact_rows"),
        F.col("left_keys").alias("fact_keys"),
        (F.col("left_rows") - F.col("left_keys")).alias("fact_copies"),
        F.col("only_right").alias("missing"),
        F.col("only_left").alias("extra"),
    )


def _context(context: DataFrame, movies: DataFrame) -> DataFrame:
    """Both tables are counted in one pass each; only the two counts meet."""
    documents = context.select(
        F.lit(1).alias("document"),
        F.lit(0).alias("movie"),
        is_blank("llm_context_document").cast("int").alias("blank"),
    )
    rows = documents.unionByName(
        movies.select(F.lit(0).alias("document"), F.lit(1).alias("movie"), F.lit(0).alias("blank"))
    )

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    return rows.agg(
        total("document").alias("documents"),
        total("blank").alias("blank_documents"),
        F.abs(total("document") - total("movie")).alias("row_difference"),
    )


def _genres(genres: DataFrame) -> DataFrame:
    strange = ~F.col("nome_genero").isin(*c.GENRES)
    return genres.agg(F.count(F.lit(1)).alias("genres"), *count_where({"strange_genres": strange}))


def _bridges(tables: dict[str, DataFrame]) -> list[DataFrame]:
    return [
        orphans(tables[links], tables[dim], key, label) for label, links, dim, key in BRIDGE_CHECKS
    ]


def _off_scale(column: str) -> Column:
    low, high = c.RATING_SCALE
    return F.count_if((F.col(column) < low) | (F.col(column) > high))


def _movie_ratings() -> list[Column]:
    off = _off_scale("nota_media_tmdb") + _off_scale("nota_media_imdb")
    return [off.alias("movie_ratings_off")]


def _money() -> list[Column]:
    amounts = ("orcamento_usd", "receita_usd", "orcamento_brl", "receita_brl")
    negative = sum((F.count_if(F.col(a) < 0) for a in amounts[1:]), F.count_if(F.col(amounts[0]) < 0))
    gap = F.col("lucro_usd") - (F.col("receita_usd") - F.col("orcamento_usd"))
    return [
        negative.alias("negative_amounts"),
        F.count_if(F.abs(gap) > c.PROFIT_TOLERANCE).alias("wrong_profits"),
    ]


def _user_ratings(reviews: DataFrame) -> DataFrame:
    return reviews.agg(_off_scale("nota_media_usuarios").alias("user_ratings_off"))


def _on_write() -> dict[str, list[Column]]:
    """What is counted while a table is written, by table."""
    return {
        "fact": [*_movie_ratings(), *_money()],
        "context": [
            F.count(F.lit(1)).alias("documents"),
            F.count_if(is_blank("llm_context_document")).alias("blank_documents"),
        ],
    }


def watched(table: str, df: DataFrame) -> tuple[DataFrame, Observation | None]:
    """``df`` with the counts that its write will give, for ``check_all``; none for tables without such counts."""
    measures = _on_write().get(table)
    if measures is None:
        return df, None
    seen = Observation()
    return df.observe(seen, *measures), seen


def _from_writes(seen: Mapping[str, Observation], movies: DataFrame) -> DataFrame:
    """One row with the numbers that were counted during the writes; the movies are counted where they stand."""
    numbers = {name: n for observation in seen.values() for name, n in observation.get.items()}
    difference = F.abs(F.lit(numbers["documents"]) - F.count(F.lit(1)))
    return movies.agg(
        difference.alias("row_difference"), *(F.lit(n).cast("bigint").alias(name) for name, n in numbers.items())
    )


def _report(measured: Sequence[DataFrame], rules: Sequence[Rule]) -> DataFrame:
    return quality_report(measured, rules).select(
        F.col("rule").alias("regra"), F.col("passed").alias("passou"), F.col("detail").alias("detalhe")
    )


def check_grain(fact: DataFrame) -> DataFrame:
    return _report([_grain(fact)], [GRAIN])


def check_coverage(fact: DataFrame, movies: DataFrame) -> DataFrame:
    return _report([_grain_and_coverage(fact, movies)], [COVERAGE])


def check_context(context: DataFrame, movies: DataFrame) -> DataFrame:
    return _report([_context(context, movies)], [CONTEXT])


def check_genres(genres: DataFrame) -> DataFrame:
    return _report([_genres(genres)], [GENRES])


def check_bridges(**tables: DataFrame) -> DataFrame:
    """Tables by the names in ``BRIDGE_CHECKS``."""
    return _report(_bridges(tables), [BRIDGES])


def check_ratings(fact: DataFrame, reviews: DataFrame) -> DataFrame:
    return _report([fact.agg(*_movie_ratings()), _user_ratings(reviews)], [RATINGS])


def check_money(fact: DataFrame) -> DataFrame:
    return _report([fact.agg(*_money())], [MONEY])


def check_all(
    *,
    dim_movies: DataFrame,
    dim_genres: DataFrame,
    dim_people: DataFrame,
    dim_companies: DataFrame,
    dim_reviews: DataFrame,
    fact: DataFrame,
    bridge_genre: DataFrame,
    bridge_person: DataFrame,
    bridge_company: DataFrame,
    context: DataFrame,
    seen: Mapping[str, Observation] | None = None,
) -> DataFrame:
    """All seven rules, whatever fails, as one lazy report.

    ``seen`` holds what ``watched`` counted while exactly these tables were written; they are not scanned for it
    again. Keys are compared in the stored tables in any case.
    """
    tables = {
        "dim_movies": dim_movies,
        "dim_genres": dim_genres,
        "dim_people": dim_people,
        "dim_companies": dim_companies,
        "bridge_genre": bridge_genre,
        "bridge_person": bridge_person,
        "bridge_company": bridge_company,
    }
    if seen is not None:
        counted = [_from_writes(seen, dim_movies)]
    else:
        counted = [_context(context, dim_movies), fact.agg(*_movie_ratings(), *_money())]
    measured = [
        _grain_and_coverage(fact, dim_movies),
        _genres(dim_genres),
        *_bridges(tables),
        _user_ratings(dim_reviews),
        *counted,
    ]
    return _report(measured, [GRAIN, COVERAGE, CONTEXT, GENRES, BRIDGES, RATINGS, MONEY])


def failed_rules(report: DataFrame) -> DataFrame:
    """The rows of a report whose rule failed."""
    return report.filter(~F.col("passou"))


def require_quality(report: DataFrame) -> None:
    """Stop with one error that names every failed rule."""
    raise_on_failures(
        report.select(
            F.col("regra").alias("rule"),
            F.col("passou").alias("passed"),
            F.col("detalhe").alias("detail"),
        ),
        c.GATE_HEADLINE,
    )
