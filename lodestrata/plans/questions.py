"""The six business questions on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators import (
    count_per_class,
    in_last_months,
    latest_past_date,
    rank_top,
    sum_total,
    top_n,
)
from lodestrata.plans import catalogue as c


def total_revenue(performance: DataFrame) -> DataFrame:
    """Revenue of all movies in local currency."""
    return sum_total(performance, "receita_brl", "receita_total_brl")


def most_popular(performance: DataFrame, movies: DataFrame, n: int = 5) -> DataFrame:
    """Title and popularity of the n most popular movies; equal ones by key."""
    titled = performance.select("sk_movie_id", "popularidade").join(
        movies.select("sk_movie_id", "titulo"), "sk_movie_id"
    )
    return top_n(titled, "popularidade", n, ["sk_movie_id"]).select("titulo", "popularidade")


def movies_per_genre(links: DataFrame, genres: DataFrame) -> DataFrame:
    return count_per_class(links, genres, "sk_genre_id", "nome_genero", "qtd_filmes")


def highest_revenue(performance: DataFrame, movies: DataFrame, n: int = 10) -> DataFrame:
    """Title, both revenues and rank of the n movies with the largest revenue."""
    titled = performance.select("sk_movie_id", "receita_usd", "receita_brl").join(
        movies.select("sk_movie_id", "titulo"), "sk_movie_id"
    )
    ranked = rank_top(titled, "receita_usd", n, "posicao_ranking", ["sk_movie_id"])
    return ranked.select("titulo", "receita_usd", "receita_brl", "posicao_ranking")


def cutoff_date(movies: DataFrame, today: Column | None = None) -> Column:
    """The last release of a released movie that has happened, for use inside other plans."""
    released = movies.filter(F.col("status_filme") == c.RELEASED)
    return latest_past_date(released, "data_lancamento", today).scalar()


def _recent_movies(movies: DataFrame, months: int, today: Column | None) -> DataFrame:
    cutoff = cutoff_date(movies, today)
    return movies.filter(in_last_months("data_lancamento", cutoff, months))


def busiest_actor(
    links: DataFrame,
    movies: DataFrame,
    people: DataFrame,
    months: int = 24,
    released_only: bool = False,
    today: Column | None = None,
) -> DataFrame:
    """The actor in most movies of the last months. Unreleased movies count unless left out."""
    recent = _recent_movies(movies, months, today)
    if released_only:
        recent = recent.filter(F.col("status_filme") == c.RELEASED)
    actors = people.filter(F.col("tipo_pessoa") == c.ACTOR)
    parts = links.join(recent.select("sk_movie_id"), "sk_movie_id")
    return count_per_class(
        parts, actors, "sk_person_id", "nome_pessoa", "qtd_participacoes"
    ).limit(1)


def most_profitable_company(
    links: DataFrame,
    movies: DataFrame,
    performance: DataFrame,
    companies: DataFrame,
    months: int = 60,
    today: Column | None = None,
) -> DataFrame:
    """The company with most profit in the last months; a joint movie counts in full for each."""
    recent = _recent_movies(movies, months, today).select("sk_movie_id")
    profits = performance.filter(F.col("lucro_usd").isNotNull()).select("sk_movie_id", "lucro_usd")
    shares = links.join(recent.join(profits, "sk_movie_id"), "sk_movie_id")
    return count_per_class(
        shares, companies, "sk_company_id", "nome_produtora", "lucro_total_usd", "lucro_usd"
    ).limit(1)
