"""Star schema and context documents of the movie catalogue from the clean tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.operators import (
    Side,
    assemble_sentence,
    bridge,
    dense_key,
    dimension,
    fact,
    keep_members,
    money_words,
    names_per_key,
    names_per_role,
    summary_dimension,
)
from lodestrata.plans import catalogue as c


def dim_movies(info: DataFrame) -> DataFrame:
    """One row per movie of a stored table."""
    keyed = dense_key(info.select(*c.MOVIE_COLUMNS), ["id_filme"], "sk_movie_id", stored=True)
    return keyed.withColumn("id_filme", F.col("id_filme").cast("string"))


def dim_genres(genres: DataFrame) -> DataFrame:
    return dimension(genres, {"nome_genero": "nome_genero"}, "sk_genre_id")


def dim_people(names: DataFrame) -> DataFrame:
    """Name and role together are a person: an actor and a director of one name are two."""
    people = keep_members(names, "tipo_entidade", c.PERSON_KINDS)
    columns = {"nome_entidade": "nome_pessoa", "tipo_entidade": "tipo_pessoa"}
    return dimension(people, columns, "sk_person_id")


def dim_companies(names: DataFrame) -> DataFrame:
    companies = names.filter(F.col("tipo_entidade") == c.COMPANY)
    return dimension(companies, {"nome_entidade": "nome_produtora"}, "sk_company_id")


def _movie_side(movies: DataFrame) -> Side:
    return Side(movies, "sk_movie_id", {"id_filme": "id_filme"})


def bridge_movie_genre(movies: DataFrame, genres: DataFrame, links: DataFrame) -> DataFrame:
    return bridge(
        links, _movie_side(movies), Side(genres, "sk_genre_id", {"nome_genero": "nome_genero"})
    )


def bridge_movie_person(movies: DataFrame, people: DataFrame, names: DataFrame) -> DataFrame:
    person = {"nome_entidade": "nome_pessoa", "tipo_entidade": "tipo_pessoa"}
    links = keep_members(names, "tipo_entidade", c.PERSON_KINDS)
    return bridge(links, _movie_side(movies), Side(people, "sk_person_id", person))


def bridge_movie_company(movies: DataFrame, companies: DataFrame, names: DataFrame) -> DataFrame:
    links = names.filter(F.col("tipo_entidade") == c.COMPANY)
    company = {"nome_entidade": "nome_produtora"}
    return bridge(links, _movie_side(movies), Side(companies, "sk_company_id", company))


def fact_movies_performance(
    movies: DataFrame, financials: DataFrame, metrics: DataFrame, wanted: Sequence[str] | None = None
) -> DataFrame:
    """One row per released movie; with ``wanted`` only these measures, without work for the others."""
    released = movies.filter(F.col("status_filme") == c.RELEASED)
    measures = [(financials, c.FACT_FINANCIALS), (metrics, c.FACT_METRICS)]
    return fact(released, "sk_movie_id", "id_filme", measures, wanted)


def dim_reviews(movies: DataFrame, reviews: DataFrame) -> DataFrame:
    summary = {
        "qtd_avaliacoes_usuarios": F.count(F.lit(1)),
        "nota_media_usuarios": F.round(F.avg("nota_usuario"), 2),
    }
    return summary_dimension(reviews, movies, "id_filme", "sk_movie_id", "sk_review_id", summary)


def people_per_movie(
    links: DataFrame, people: DataFrame, kind: str, output: str | None = None
) -> DataFrame:
    """The people of one role per movie as one text."""
    members = people.filter(F.col("tipo_pessoa") == kind)
    column = output or ("atores_principais" if kind == c.ACTOR else "diretor")
    return names_per_key(links, members, "sk_person_id", "sk_movie_id", "nome_pessoa", column)


def cast_and_directors(links: DataFrame, people: DataFrame) -> DataFrame:
    """Actors and directors per movie, as ``people_per_movie`` gives them, in one pass."""
    columns = {c.ACTOR: "atores_principais", c.DIRECTOR: "diretor"}
    return names_per_role(
        links, people, "sk_person_id", "sk_movie_id", "nome_pessoa", "tipo_pessoa", columns
    )


def movie_context(movies: DataFrame, performance: DataFrame, *people: DataFrame) -> DataFrame:
    """``gold_genai_movies_context``: one sentence per movie, whatever is missing.

    ``people`` holds the columns ``atores_principais`` and ``diretor``, in one frame or two. All are
    keyed by movie, so each frame is shuffled at most once.
    """
    known = movies.join(
        performance.select("sk_movie_id", "receita_usd", "orcamento_usd"), "sk_movie_id", "left"
    )
    for names in people:
        known = known.join(names, "sk_movie_id", "left")
    values = (
        (F.col("titulo"), c.NO_TITLE),
        (F.col("ano_lancamento"), c.NO_YEAR),
        (money_words("receita_usd", "US$"), c.NO_REVENUE),
        (money_words("orcamento_usd", "US$"), c.NO_BUDGET),
        (F.col("atores_principais"), c.NO_CAST),
        (F.col("diretor"), c.NO_DIRECTOR),
        (F.col("sinopse"), c.NO_SYNOPSIS),
    )
    parts: list = [c.SENTENCE[0]]
    for value, words in zip(values, c.SENTENCE[1:], strict=True):
        parts += [value, words]
    return known.select(
        F.col("id_filme").alias("movie_id"),
        F.col("titulo").alias("title"),
        assemble_sentence(parts).alias("llm_context_document"),
    )
