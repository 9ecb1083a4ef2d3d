"""Clean tables of the movie catalogue on small raw frames."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata.plans import catalogue as c
from lodestrata.plans import silver

AT = "2026-09-18 06:00:00"


def test_movie_info(spark):
    ddl = (
        "id string, tconst string, title string, original_title string, original_language string, "
        "release_date string, runtime string, status string, overview string, tagline string, "
        "ingestion_datetime string"
    )
    rows = [
        ("1", "tt1", "A", "A", "en", "04-25-2018", "108", " released-", "text", None, AT),
        ("1", "tt1", "A", "A", "en", "04-25-2018", None, "released", None, None, AT),
        ("2", "tt2", "B", None, "pt", "31/02/2022", "abc", "?", None, None, AT),
    ]
    got = silver.movie_info(spark.createDataFrame(rows, ddl)).orderBy("id_filme")
    assert got.columns == list(c.INFO_COLUMNS)
    assert [tuple(r) for r in got.collect()] == [
        ("1", "A", "A", date(2018, 4, 25), 2018, 108, "en", "Lançado", "text", None),
        ("2", "B", None, None, None, None, "pt", "Não Informado", None, None),
    ]
    assert dict(got.dtypes)["duracao_minutos"] == "int"
    assert dict(got.dtypes)["ano_lancamento"] == "int"


def test_movie_info_completeness_counts_raw_text(spark):
    """A runtime that is no number still counts as a filled cell, as it is parsed afterwards."""
    ddl = "id string, tconst string, title string, original_title string, original_language string, release_date string, runtime string, status string, overview string, tagline string, ingestion_datetime string"
    rows = [
        ("1", "t", "noise", "o", "l", "d", "abc", "released", "s", "g", AT),
        ("1", "t", "clean", "o", "l", "2020-01-01", None, "released", "s", "g", AT),
    ]
    assert silver.movie_info(spark.createDataFrame(rows, ddl)).first()["titulo"] == "noise"


def test_movie_financials(spark):
    rows = [
        ("1", "0", "0", AT), ("1", "100", "300", AT),
        ("2", "$ 97000000", "Unknown", AT), ("3", "9999999999999999B", "34.0M", AT),
    ]
    raw = spark.createDataFrame(rows, "id string, budget string, revenue string, ingestion_datetime string")
    got = silver.movie_financials(raw, 5.0).orderBy("id_filme")
    assert [tuple(r) for r in got.collect()] == [
        ("1", Decimal("100.00"), Decimal("300.00"), Decimal("200.00"), Decimal("200.00"), 500.0, 1500.0, 1000.0),
        ("2", Decimal("97000000.00"), None, None, None, 485000000.0, None, None),
        ("3", None, Decimal("34000000.00"), None, None, None, 170000000.0, None),
    ]
    assert [t for _, t in got.dtypes] == [
        "string", "decimal(18,2)", "decimal(18,2)", "decimal(19,2)", "decimal(26,2)", "double", "double", "double",
    ]
    frame = spark.createDataFrame([(date(2026, 1, 1), 5.0)], "data_cotacao date, cotacao_dolar double")
    same = silver.movie_financials(raw, silver.current_rate(frame)).orderBy("id_filme")
    assert same.collect() == got.collect()


def test_no_rate_is_a_clear_error(spark):
    raw = spark.createDataFrame([("1", "1", "1", AT)], "id string, budget string, revenue string, ingestion_datetime string")
    frame = spark.createDataFrame([], "data_cotacao date, cotacao_dolar double")
    with pytest.raises(Exception, match="Sem taxa de câmbio"):
        silver.movie_financials(raw, silver.current_rate(frame)).collect()


METRIC_DDL = (
    "id string, popularity string, vote_average string, vote_count string, averageRating string, "
    "numVotes string, ingestion_datetime string"
)


def test_movie_metrics(spark):
    rows = [
        ("1", "told in 1987, 1994 and 2003.7", "7.5", "100", "6.0", "50", AT),
        ("2", "41,562", "58.25", "-5", "8.1", "5000", AT),
        ("3", '28"', "", None, None, None, AT),
        ("4", "1954", "9.5", None, "Danish", None, AT),
        ("5", "31.842", "7.5", "100", None, "99999999999", AT),
        ("6", "-1", "7", "100.0", None, None, AT),
    ]
    got = silver.movie_metrics(spark.createDataFrame(rows, METRIC_DDL)).orderBy("id_filme")
    assert [tuple(r) for r in got.collect()] == [
        ("1", None, 7.5, 100, 6.0, 50),
        ("2", 41.562, None, None, 8.1, 5000),
        ("3", None, None, None, None, None),
        ("4", None, 9.5, None, None, None),
        ("5", 31.842, 7.5, 100, None, None),
        ("6", None, 7.0, None, None, None),
    ]
    assert [t for _, t in got.dtypes] == ["string", "double", "double", "int", "double", "int"]


def test_movie_metrics_dedup_counts_valid_numbers(spark):
    rows = [("1", "x", "y", "z", "w", "v", AT), ("1", "1.0", "7.0", "10", None, "6181", AT)]
    got = silver.movie_metrics(spark.createDataFrame(rows, METRIC_DDL)).collect()
    assert [r["qtd_votos_imdb"] for r in got] == [6181]


def test_user_reviews(spark):
    rows = [
        ("1", "ana", "8.0", "bom"), ("1", "ana", "8.0", "bom"), ("1", "ana", "8.0", "outro"),
        ("2", "bia", "15.0", "   "), ("2", "bia", "15.0", None), ("3", "caio", "-3.0", "x"), ("4", "dan", "ruim", "y"),
    ]
    got = silver.user_reviews(spark.createDataFrame(rows, "id string, nome string, nota string, comentario string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [
            ("1", "ana", 8.0, "bom"), ("1", "ana", 8.0, "outro"),
            ("2", "bia", None, "Sem comentário"), ("2", "bia", None, "Sem comentário"),
            ("3", "caio", None, "x"), ("4", "dan", None, "y"),
        ],
        key=str,
    )


def test_user_reviews_compare_ratings_as_numbers(spark):
    rows = [(1, "ana", 0.0001, "bom"), (1, "ana", 0.0001, "bom")]
    numbers = spark.createDataFrame(rows, "id int, nome string, nota double, comentario string")
    assert [r["nota_usuario"] for r in silver.user_reviews(numbers).collect()] == [0.0001]
    texts = spark.createDataFrame([("1", "a", "8", "b"), ("1", "a", "8.0", "b")], "id string, nome string, nota string, comentario string")
    assert silver.user_reviews(texts).count() == 1


@pytest.mark.parametrize(
    ("cell", "genres"),
    [
        ("Comedy|Drama", {"Comedy", "Drama"}),
        ("Drama, A night of storms., /pic.jpg", {"Drama"}),
        ("Science Fiction, TV Movie, 2013", {"Science Fiction", "TV Movie"}),
        ("Action, Action; Comedy", {"Action", "Comedy"}),
        (None, set()),
    ],
)
def test_movie_genres(spark, cell, genres):
    got = silver.movie_genres(spark.createDataFrame([(7, cell)], "id int, genres string")).collect()
    assert len(got) == len(genres)
    assert {(r["id_filme"], r["nome_genero"]) for r in got} == {(7, g) for g in genres}


def test_people_and_companies(spark):
    ddl = "id int, genres string, production_companies string, directors string, writers string, cast string"
    phrase = "uma frase longa demais para ser o nome de uma pessoa ou de uma empresa"
    rows = [
        (1, "Drama", "LANTERN works", "rui SALDO", "Ann Lee|ANN LEE", "olga farias; Nuno Prado"),
        (2, None, None, None, None, f"6.1, 766, /pic77.jpg, poster.png, X, {phrase}, Tom Hollis"),
    ]
    got = silver.people_and_companies(spark.createDataFrame(rows, ddl))
    assert sorted(map(tuple, got.collect())) == sorted([
        (1, "Ann Lee", "Roteirista"), (1, "Nuno Prado", "Ator"), (1, "Rui Saldo", "Diretor"),
        (1, "Lantern Works", "Produtora"), (1, "Olga Farias", "Ator"), (2, "Tom Hollis", "Ator"),
    ])


def test_daily_rates(spark):
    rows = [("2026-09-11 13:00:00.0", 5.30), ("2026-09-14 13:00:00.0", 5.40), ("2026-09-14 10:00:00.0", 9.0)]
    raw = spark.createDataFrame(rows, "dataHoraCotacao string, cotacaoCompra double")
    got = silver.daily_rates(raw, "2026-09-13", "2026-09-15").orderBy("data_cotacao")
    assert [(str(r[0]), r[1]) for r in got.collect()] == [
        ("2026-09-11", 5.30), ("2026-09-12", 5.30), ("2026-09-13", 5.30), ("2026-09-14", 5.40), ("2026-09-15", 5.40),
    ]
    latest = spark.range(1).select(silver.current_rate(got).alias("r")).first()["r"]
    assert latest == 5.40
    assert got.agg(F.count("*")).first()[0] == 5


def test_reviews_that_differ_in_an_unreadable_rating_stay_apart(spark):
    rows = [(1, "ann", "ruim", "x"), (1, "ann", "N/A", "x"), (1, "ann", "N/A", "x"), (1, "ann", "7", "x"), (1, "ann", "7.0", "x"), (1, "ann", None, "x")]
    text = silver.user_reviews(spark.createDataFrame(rows, "id int, nome string, nota string, comentario string"))
    assert sorted((r["nota_usuario"] is None, r["nota_usuario"]) for r in text.collect())[0] == (False, 7.0)
    assert text.count() == 4
    whole = silver.user_reviews(spark.createDataFrame([(1, "ann", 7, "x")], "id int, nome string, nota int, comentario string"))
    assert whole.schema["nota_usuario"].dataType == text.schema["nota_usuario"].dataType


def test_a_null_or_undated_reading_hides_no_other(spark):
    rows = [("2026-09-11 10:00:00.0", 5.1), ("2026-09-11 13:00:00.0", None), ("bad", 1.0)]
    raw = spark.createDataFrame(rows, "dataHoraCotacao string, cotacaoCompra double")
    got = silver.daily_rates(raw, "2026-09-11", "2026-09-12").orderBy("data_cotacao").collect()
    assert [r["cotacao_dolar"] for r in got] == [5.1, 5.1]
