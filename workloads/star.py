"""The movie catalogue on inputs derived from the driver tables."""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import DataFrame, Observation, SparkSession

from lodestrata.plans import gate, gold, silver
from lodestrata.sources import side_by_side, stage
from workloads.tables import Tables

# The range of days asked for, as the parameters of a run. The stored rates start earlier.
RATE_START, RATE_END = "2001-01-01", "2001-12-31"
# The day the questions are asked on: releases after it are in the future.
TODAY = "2001-06-30"
# The range of days read from the landed rate files.
# The two batches of a run from landing to gate: rows shipped before this day come in the first.
SECOND_BATCH = "1998-01-01"
BATCH_DAYS = ("2026-09-20", "2026-09-21")
FEED_START, FEED_END = "2024-01-05", "2024-01-20"


class Silver:
    """The clean tables, each a plan over the driver tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._tables = Tables(spark, folder)

    def info(self) -> DataFrame:
        return silver.movie_info(self._tables.input("raw_info"))

    def rates(self) -> DataFrame:
        return silver.daily_rates(self._tables.input("raw_rates"), RATE_START, RATE_END)

    def financials(self) -> DataFrame:
        raw = self._tables.input("raw_financials")
        return silver.movie_financials(raw, silver.current_rate(self.rates()))

    def metrics(self) -> DataFrame:
        return silver.movie_metrics(self._tables.input("raw_metrics"))

    def reviews(self) -> DataFrame:
        return silver.user_reviews(self._tables.input("raw_reviews"))

    def genres(self) -> DataFrame:
        return silver.movie_genres(self._tables.input("raw_credits"))

    def names(self) -> DataFrame:
        return silver.people_and_companies(self._tables.input("raw_credits"))


class Gold:
    """The star; only what a query uses is built.

    A clean table that several tables of the star read, or that gets keys, is written once and read back, as
    between the layers of a run: keys never run over the long cleaning plans. One that a single table reads
    stays part of its plan. Building a frame therefore runs jobs.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self.silver = Silver(spark, folder)
        self.seen: dict[str, Observation] = {}

    @cached_property
    def genre_links(self) -> DataFrame:
        return stage(self.silver.genres())

    @cached_property
    def names(self) -> DataFrame:
        return stage(self.silver.names())

    @cached_property
    def info(self) -> DataFrame:
        return stage(self.silver.info())

    @cached_property
    def movies(self) -> DataFrame:
        return gold.dim_movies(self.info)

    @cached_property
    def genres(self) -> DataFrame:
        return gold.dim_genres(self.genre_links)

    @cached_property
    def people(self) -> DataFrame:
        return gold.dim_people(self.names)

    @cached_property
    def companies(self) -> DataFrame:
        return gold.dim_companies(self.names)

    @cached_property
    def reviews(self) -> DataFrame:
        return gold.dim_reviews(self.movies, self.silver.reviews())

    @cached_property
    def financials(self) -> DataFrame:
        return self.silver.financials()

    @cached_property
    def metrics(self) -> DataFrame:
        return self.silver.metrics()

    @cached_property
    def fact(self) -> DataFrame:
        return self.fact_of()

    def fact_of(self, *wanted: str) -> DataFrame:
        """The fact with the wanted measures, or all; tables that give none of them are not read."""
        return gold.fact_movies_performance(
            self.movies, self.financials, self.metrics, wanted or None
        )

    @cached_property
    def bridge_genre(self) -> DataFrame:
        return gold.bridge_movie_genre(self.movies, self.genres, self.genre_links)

    @cached_property
    def bridge_person(self) -> DataFrame:
        return gold.bridge_movie_person(self.movies, self.people, self.names)

    @cached_property
    def bridge_company(self) -> DataFrame:
        return gold.bridge_movie_company(self.movies, self.companies, self.names)

    def people_of(self, kind: str, output: str | None = None) -> DataFrame:
        return gold.people_per_movie(self.bridge_person, self.people, kind, output)

    @cached_property
    def context(self) -> DataFrame:
        self.ready("info", "names")
        self.ready("movies", "people")
        names = gold.cast_and_directors(self.bridge_person, self.people)
        stored = vars(self).get("fact")
        amounts = stored if stored is not None else self.fact_of("receita_usd", "orcamento_usd")
        return gold.movie_context(self.movies, amounts, names)

    def ready(self, *names: str) -> None:
        """Build tables that do not need each other, side by side."""
        side_by_side(self._spark, *(partial(getattr, self, name) for name in names))

    def stored(self) -> dict[str, DataFrame]:
        """The star by table name; every table is written once, before the tables that read it.

        What the rules can count while a table is written, they do: ``seen``.
        """
        self.ready("info", "names", "genre_links")
        self._write(dim_movies="movies", dim_genres="genres", dim_people="people", dim_companies="companies")
        self._write(fact="fact", bridge_genre="bridge_genre", bridge_person="bridge_person", bridge_company="bridge_company")
        self._write(context="context", dim_reviews="reviews")
        names = {
            "dim_movies": "movies", "dim_genres": "genres", "dim_people": "people", "dim_companies": "companies",
            "dim_reviews": "reviews", "fact": "fact", "bridge_genre": "bridge_genre",
            "bridge_person": "bridge_person", "bridge_company": "bridge_company", "context": "context",
        }
        return {table: getattr(self, name) for table, name in names.items()}

    def _write(self, **names: str) -> None:
        def write(table: str, name: str) -> None:
            frame, seen = gate.watched(table, getattr(self, name))
            setattr(self, name, stage(frame))
            if seen is not None:
                self.seen[table] = seen

        side_by_side(self._spark, *(partial(write, table, name) for table, name in names.items()))

    def report(self) -> DataFrame:
        """The report on the stored star."""
        return gate.check_all(**self.stored(), seen=self.seen)
