"""From landed files to the gate, twice, as a daily run does."""

import json
import random
import re
from datetime import UTC, date, datetime
from pathlib import Path
from urllib.parse import urlparse

import pytest

from lodestrata.operators import QualityGateFailed
from lodestrata.plans import incremental, questions, run
from lodestrata.sources import batches_of, overwrite_table, read_rate_json, tables
from workloads import queries

INFO = """id,tconst,title,original_title,original_language,release_date,runtime,status,overview,tagline
1,tt1,Alpha,Alpha,en,2024-05-01,108, released-,"He said ""go"", she went",tag
1,tt1,Alpha,,en,2024-05-01,,released,,
2,tt2,Beta,Beta,pt,12-25-2025,95,Released,,
3,tt3,Gamma,Gamma,fr,31/02/2022,abc,Planned,"broken quote,x
4,tt4,Delta,Delta,en,01/01/2029,80,released,,
"""
FINANCIALS = """id,budget,revenue
1,$ 1000000,2.5M
1,0,Unknown
2,USD 100,"$1,200,000.50"
3,N/A,5
4,0,0
"""
METRICS = """id,popularity,vote_average,vote_count,averageRating,numVotes
1,"41,562",7.5,100,6.5,5000
2,1969,10.0,,Italian,
3,5.5,76.06,10,,
4,3,0,0,0,0
"""
CREDITS = """id,genres,production_companies,production_countries,spoken_languages,keywords,directors,writers,cast
1,Drama|War,"Acme; BEST films",,,,rui SALDO,,"Ana, Zoe, /x.jpg"
2,"Drama, 2013",Acme,,,,,N/A,ana
3,War,,,,,,,Zoe
4,Comedy,Acme,,,,,,Zoe
"""
REVIEWS = """id,nome,nota,comentario
1,u,8.0,good
1,u,8.0,good
1,v,6,
2,w,15.0,bad
"""
LANDED = {
    "movies_info_TMDB_IMDB.csv": INFO,
    "movies_financials_IMDB_TMDB.csv": FINANCIALS,
    "movies_metrics_IMDB_TMDB.csv": METRICS,
    "credits_and_tags_IMDB_TMDB.csv": CREDITS,
    "movies_reviews.csv": REVIEWS,
}
STAR = (
    "dim_movies", "dim_genres", "dim_people", "dim_companies", "dim_reviews", "fact_movies_performance",
    "bridge_movie_genre", "bridge_movie_person", "bridge_movie_company", "gold_genai_movies_context",
)


def land(folder, seed):
    """The landed files with their records in another order."""
    folder.mkdir()
    for name, text in LANDED.items():
        header, *records = text.rstrip("\n").split("\n")
        random.Random(seed).shuffle(records)
        (folder / name).write_text("\n".join([header, *records]) + "\n")
    feed = {"value": [{"dataHoraCotacao": "2026-09-18 13:09:02.5", "cotacaoCompra": 5.0}]}
    (folder / "rates.json").write_text(json.dumps(feed))
    return str(folder)


def content(spark):
    return {t: sorted(map(str, spark.table(f"gold.{t}").collect())) for t in STAR}


MOVIES = ("tb_movies_info", "tb_movies_financials", "tb_movies_metrics")
CLEAN = ("tb_info_filmes", "tb_financeiro_filmes", "tb_metricas_engajamento", "tb_pessoas_empresas")


def clean(spark, prefix):
    return {t: sorted(map(str, spark.table(f"{prefix}silver.{t}").collect())) for t in CLEAN}


def test_merged_batches_equal_the_whole_run(spark, tmp_path):
    """Batches in any order, one of them twice, and changing rates: the same tables as from all of bronze."""
    prefix = "merged_"
    for n, day in enumerate((20, 22, 21)):
        folder = tmp_path / f"d{n}"
        land(folder, n)
        text = (folder / "movies_info_TMDB_IMDB.csv").read_text()
        (folder / "movies_info_TMDB_IMDB.csv").write_text(text.replace("Alpha", f"Alpha {day}").replace("4,tt4", f"{day},tt4"))
        text = (folder / "movies_financials_IMDB_TMDB.csv").read_text()
        (folder / "movies_financials_IMDB_TMDB.csv").write_text(text + f"1,{day},{day}\n1,,{day + 1}\n{day},5,7\n")
        feed = {"value": [{"dataHoraCotacao": f"2026-09-{day} 13:09:02.5", "cotacaoCompra": 5.0 + n}]}
        (folder / "rates.json").write_text(json.dumps(feed))
        rates = read_rate_json(spark, f"{folder}/rates.json")
        for _ in range(1 + n % 2):
            run.run_bronze(spark, str(folder), rates, datetime(2026, 9, day, tzinfo=UTC), prefix=prefix)
        run.run_silver(spark, "2026-09-13", "2026-09-25", prefix=prefix)
        merged = clean(spark, prefix)
        run.run_silver(spark, "2026-09-13", "2026-09-25", prefix=prefix, whole=True)
        assert clean(spark, prefix) == merged
    assert spark.table(f"{prefix}bronze.tb_movies_info").count() == 15
    for table in MOVIES:  # nothing is new: the states stay as they are
        assert incremental.new_batches(spark, f"{prefix}bronze.{table}", f"{prefix}silver.latest_{table}") == []
    batches = batches_of(spark, f"{prefix}bronze.tb_movies_info")
    frame = incremental.with_new_batches(
        spark, f"{prefix}bronze.tb_movies_info", f"{prefix}silver.none", batches[-1:], "id", "ingestion_datetime"
    )
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", frame._jdf.queryExecution().executedPlan().toString())
    assert scans and all(batches[-1] in scan for scan in scans) and len({f for f in frame.inputFiles()}) == 1
    run.drop_layers(spark, prefix)
    assert not spark.catalog.databaseExists(f"{prefix}silver")
    with pytest.raises(ValueError):
        run.drop_layers(spark, "")


def test_last_week():
    assert run.last_week(date(2026, 9, 20)) == (date(2026, 9, 13), date(2026, 9, 20))
    start, end = run.last_week()
    assert (end - start).days == 7


def test_daily_runs(spark, tmp_path):
    first = land(tmp_path / "one", 1)
    rates = read_rate_json(spark, f"{first}/rates.json", "2026-09-13", "2026-09-20")
    written = run.run_bronze(spark, first, rates, datetime(2026, 9, 20, tzinfo=UTC))
    assert written["bronze.tb_movies_info"] == 5
    assert written["bronze.tb_movies_reviews"] == 4
    run.run_silver(spark, "2026-09-13", "2026-09-20")
    run.run_gold(spark)
    report = run.run_gate(spark)
    assert [r["passou"] for r in report.collect()] == [True] * 7
    before = content(spark)

    movies, fact = spark.table("gold.dim_movies"), spark.table("gold.fact_movies_performance")
    assert spark.table("silver.tb_cotacao_dolar").count() == 8
    assert [str(r["data_lancamento"]) for r in movies.orderBy("sk_movie_id").collect()] == ["2024-05-01", "2025-12-25", "None", "2029-01-01"]
    assert str(questions.total_revenue(fact).first()[0]) == "18500002.50"
    assert [r[0] for r in questions.most_popular(fact, movies, 1).collect()] == ["Alpha"]
    actor = questions.busiest_actor(spark.table("gold.bridge_movie_person"), movies, spark.table("gold.dim_people"))
    assert tuple(actor.first()) == ("Ana", 2)
    company = questions.most_profitable_company(spark.table("gold.bridge_movie_company"), movies, fact, spark.table("gold.dim_companies"))
    assert [str(v) for v in company.first()] == ["Acme", "2699900.50"]
    document = spark.table("gold.gold_genai_movies_context").filter("movie_id = '1'").first()[2]
    assert document == (
        "O filme Alpha, lançado no ano de 2024, faturou US$ 2,500,000.00 e teve um custo de US$ 1,000,000.00. "
        'Estrelado por Ana, Zoe e dirigido por Rui Saldo, o filme possui a seguinte sinopse: He said "go", she went.'
    )

    second = land(tmp_path / "two", 2)
    run.run_bronze(spark, second, rates, datetime(2026, 9, 21, tzinfo=UTC))
    assert spark.table("bronze.tb_movies_info").count() == 10
    run.run_silver(spark, "2026-09-14", "2026-09-20")
    run.run_gold(spark)
    assert content(spark) == before

    overwrite_table(spark.range(3).selectExpr("id + 100 as sk_movie_id", "1L as sk_genre_id"), "gold.bridge_movie_genre")
    assert [r["passou"] for r in run.gold_report(spark).collect()].count(False) == 1
    with pytest.raises(QualityGateFailed, match="'genre->movie': 3"):
        run.run_gate(spark)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {file for file in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in file}


def versions_of(spark, table):
    return list(Path(urlparse(tables._versions(spark, table)).path).iterdir())


def test_a_run_leaves_no_shuffles_and_no_old_states_on_disk(spark, tmp_path):
    prefix, before = "lean_", spark.conf.get(CLEANUP, None)
    for n, day in enumerate((20, 21)):
        folder = land(tmp_path / f"d{n}", n)
        rates = read_rate_json(spark, f"{folder}/rates.json")
        run.run_bronze(spark, folder, rates, datetime(2026, 9, day, tzinfo=UTC), prefix=prefix)
        old = shuffle_files(spark)
        run.run_silver(spark, "2026-09-13", "2026-09-25", prefix=prefix)
        assert shuffle_files(spark) <= old
    run.run_gold(spark, prefix=prefix)
    assert shuffle_files(spark) <= old and spark.conf.get(CLEANUP, None) == before
    for table in MOVIES:
        assert len(versions_of(spark, f"{prefix}silver.latest_{table}")) == 1
    assert len(versions_of(spark, f"{prefix}silver.tb_info_filmes")) == 2
    run.drop_layers(spark, prefix)


def test_landed_files_are_dropped_once_the_raw_tables_hold_them(spark, sf_dir, monkeypatch):
    """A query from landing to gate has one batch of landed files on disk at a time, in short compressed files."""
    folders, seen, ingest, folder_of = [], [], run.run_bronze, queries._folder

    def folder(t):
        folders.append(folder_of(t))
        return folders[-1]

    monkeypatch.setattr(queries, "_folder", folder)

    def watched(spark, folder, *args, **named):
        seen.append([sum(1 for f in Path(urlparse(path).path).rglob("*.csv.gz")) for path in folders])
        return ingest(spark, folder, *args, **named)

    monkeypatch.setattr(run, "run_bronze", watched)
    report = queries.QUERIES["landing_to_gate"](spark, sf_dir)
    assert [r["passou"] for r in report.collect()] == [True] * 7
    assert len(folders) == 2 and seen[0][0] > 0 and seen[1][0] == 0 < seen[1][1]
    assert not any(Path(urlparse(path).path).exists() for path in folders)
