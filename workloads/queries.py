"""One query per operator, over whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import suppress
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata import functions as rules
from lodestrata import operators as ops
from lodestrata.plans import catalogue as c
from lodestrata.plans import gate, gold, incremental, questions, run
from lodestrata.sources import (
    BATCH,
    append_batch,
    append_table,
    batches_of,
    drop_folder,
    drop_table,
    ensure_layers,
    ingest_files,
    overwrite_table,
    rate_records,
    read_landing_csv,
    read_rate_json,
    records_to_df,
    stage,
    staging_folder,
    stamp_ingestion,
    wide_lines,
)
from workloads.star import BATCH_DAYS, FEED_END, FEED_START, RATE_END, RATE_START, SECOND_BATCH, TODAY, Gold, Silver
from workloads.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MONEY = "decimal(18,2)"
#: Landed file: the input it holds, and the condition of its rows in the second batch.
LANDED = {
    "movies_info_TMDB_IMDB.csv": ("raw_info", "ingestion_datetime >= '{day}'"),
    "movies_financials_IMDB_TMDB.csv": ("raw_financials", "ingestion_datetime >= '{day}'"),
    "movies_metrics_IMDB_TMDB.csv": ("raw_metrics", "ingestion_datetime >= '{day}'"),
    "credits_and_tags_IMDB_TMDB.csv": ("raw_credits", "id % 2 = 1"),
    "movies_reviews.csv": ("raw_reviews", "id % 2 = 1"),
}

#: Landed files of a run over all layers: a sixth of plain ones, and short, as one task reads a compressed file.
PACKED = {"compression": "gzip", "maxRecordsPerFile": 100_000}


def on_tables(build: Callable[[Tables], DataFrame]) -> Callable:
    """Register a query that reads the driver tables, under its function name."""
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


def on_silver(build: Callable[[Silver], DataFrame]) -> Callable:
    QUERIES[build.__name__] = lambda spark, folder: build(Silver(spark, folder))
    return build


def on_gold(build: Callable[[Gold], DataFrame]) -> Callable:
    QUERIES[build.__name__] = lambda spark, folder: build(Gold(spark, folder))
    return build


# --- column rules ---------------------------------------------------------------------------------


@on_tables
def safe_number_int(t):
    return t.input("metric_txt").select("event_id", rules.safe_number("metric_txt", "int").alias("n"))


@on_tables
def safe_number_double(t):
    return t.input("metric_txt").select("event_id", rules.safe_number("metric_txt").alias("x"))


@on_tables
def decimal_comma(t):
    return t.input("metric_txt").select("event_id", rules.decimal_comma("metric_txt").alias("cell"))


@on_tables
def money_parse(t):
    return t.input("money_txt").select("o_orderkey", rules.money("money_txt").alias("amount"))


@on_tables
def multi_date(t):
    day = rules.multi_date("date_txt")
    return t.input("date_txt").select("o_orderkey", day.alias("day"), F.year(day).alias("year"))


@on_tables
def normalize_status(t):
    return t.input("status_txt").select("o_orderkey", rules.normalize_label("status_txt").alias("label"))


@on_tables
def translate_status(t):
    label = rules.normalize_label("status_txt")
    status = rules.map_values(label, c.STATUS_LABELS, c.UNKNOWN_STATUS)
    return t.input("status_txt").select("o_orderkey", status.alias("status"))


@on_tables
def null_outside(t):
    return t["events"].select("event_id", rules.null_outside("value", 0.0, 10.0).alias("rating"))


@on_tables
def null_negative(t):
    return t["customer"].select("c_custkey", rules.null_outside("c_acctbal", 0).alias("balance"))


@on_tables
def null_non_positive(t):
    shifted = F.round(F.col("value") - 100.0, 2)
    return t["events"].select("event_id", rules.null_non_positive(shifted).alias("gain"))


@on_tables
def column_shift(t):
    cells = t.input("metric_txt").select("event_id", F.col("v").alias("popularity"), "metric_txt")
    flagged = ops.flag_shifted_rows(cells, {"metric_txt": "double"}, "_slipped")
    marked = flagged.withColumn("slipped", F.col("_slipped"))
    clean = ops.distrust_shifted_rows(marked, ["popularity"], "_slipped")
    return clean.select("event_id", "slipped", rules.safe_number("popularity").alias("popularity"))


@on_tables
def default_blank(t):
    comment = rules.default_blank("comment_txt", c.NO_COMMENT)
    return t.input("comment_txt").select("event_id", comment.alias("comment"))


@on_tables
def title_case(t):
    names = t.input("credit_txt").select(
        "p_partkey", F.concat_ws(" ", "directors", "writers", "companies").alias("text")
    )
    return names.select("p_partkey", rules.title_case_words("text").alias("text"))


@on_tables
def currency_margin(t):
    amounts = t["orders"].select(
        "o_orderkey",
        F.col("o_totalprice").cast(MONEY).alias("revenue"),
        (F.col("o_custkey") + 1).cast(MONEY).alias("cost"),
    )
    return amounts.select(
        "o_orderkey",
        rules.convert_currency("revenue", 5.2).alias("converted"),
        rules.profit("revenue", "cost").alias("profit"),
        rules.margin_percent("revenue", "cost").alias("margin"),
    )


# --- generators -----------------------------------------------------------------------------------


@on_tables
def explode_list(t):
    rows = ops.explode_list(t.input("list_txt"), "p_partkey", "list_txt", "element")
    kept = ops.keep_members(rows, "element", ("small", "red", "hot", "ring", "gear", "123"))
    return ops.drop_exact_duplicates(kept, kept.columns)


@on_tables
def entity_unpivot(t):
    kinds = {"actors": c.ACTOR, "directors": c.DIRECTOR, "writers": c.WRITER, "companies": c.COMPANY}
    rows = ops.explode_entities(t.input("credit_txt"), "p_partkey", kinds, "name", "kind")
    return ops.keep_names(rows, "name")


# --- duplicates -----------------------------------------------------------------------------------


@on_tables
def dedup_latest_complete(t):
    rows = t.input("rows_with_gaps")
    return ops.keep_latest_and_most_complete(rows, ["l_orderkey", "l_linenumber"], "loaded")


@on_tables
def dedup_merged_batches(t):
    """The latest rows of all batches but the last, kept as a state, then the last batch merged into it."""
    spark, mark = t.spark, uuid.uuid4().hex
    ensure_layers(spark, ["bronze", "silver"])
    table, state, key = f"bronze.d_{mark}", f"silver.e_{mark}", ["l_orderkey", "l_linenumber"]
    batch = F.date_format("loaded", "yyyy").alias(BATCH)
    t.input("rows_with_gaps").select("*", batch).write.partitionBy(BATCH).saveAsTable(table)
    batches = batches_of(spark, table)
    for some in (batches[:-1], batches[-1:]):
        overwrite_table(incremental.with_new_batches(spark, table, state, some, key, "loaded"), state)
    result = stage(ops.keep_latest_and_most_complete(spark.table(state).drop(BATCH), key, "loaded"))
    for name in (table, state):
        drop_table(spark, name)
    return result


@on_tables
def drop_exact_duplicates(t):
    return ops.drop_exact_duplicates(t["conversations"].select("role", "text"), ["role", "text"])


# --- sources --------------------------------------------------------------------------------------


@on_tables
def ingest_stamp(t):
    return stamp_ingestion(t["customer"], datetime(2026, 9, 20, 6, 0, 18, tzinfo=UTC))


@on_tables
def rate_json(t):
    return rate_records(t.input("rate_payload"), "payload")


def _folder(t) -> str:
    return f"{staging_folder(t.spark)}/landed-{uuid.uuid4().hex}"


def _as_csv(rows, path, **options) -> None:
    kept = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(**kept, **options).csv(path)


@on_tables
def landing_csv(t):
    """The raw movies as landed files, read back."""
    rows, path = t.input("raw_info"), _folder(t)
    _as_csv(rows.withColumn("ingestion_datetime", F.col("ingestion_datetime").cast("string")), path)
    return read_landing_csv(t.spark, path, rows.columns)


@on_tables
def landing_wide_lines(t):
    """Landed files of up to 500 lines, some with more fields than the header: what is kept of each line, and the
    whole lines that lost fields, with their numbers."""
    cells, path = t.input("wide_cells"), _folder(t)
    line = F.struct("key", F.concat_ws(",", F.col("key").cast("string"), "name", "cell").alias("line"))
    files = cells.groupBy(F.floor(F.col("key") / 500).alias("part")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    whole = F.concat_ws("\n", F.lit("id,name,cell"), F.col("lines.line"))
    files.select("part", whole.alias("value")).write.partitionBy("part").text(path)
    kept = read_landing_csv(t.spark, path).drop("part")
    lost = wide_lines(t.spark, path, len(kept.columns))
    return kept.join(lost.select(F.split("line", ",")[0].alias("id"), "line_number", "fields", "line"), "id", "left")


@on_tables
def rate_files(t):
    """Responses of up to 500 records as files of their own, read for a range of days."""
    path = _folder(t)
    record = F.struct(
        F.concat(F.col("ts").cast("date").cast("string"), F.lit(" 13:09:02.5")).alias("dataHoraCotacao"),
        F.col("value").alias("cotacaoCompra"),
    )
    responses = t["events"].groupBy(F.floor(F.col("event_id") / 500).alias("part")).agg(
        F.to_json(F.struct(F.collect_list(record).alias("value"))).alias("response")
    )
    responses.write.partitionBy("part").text(path)
    return read_rate_json(t.spark, path, FEED_START, FEED_END)


@on_tables
def table_writes(t):
    """What tables hold after two appends, an overwrite and one that fails, two ingestions of landed files, and a
    batch that is ingested again."""
    spark, mark = t.spark, uuid.uuid4().hex
    ensure_layers(spark)
    appended, replaced, ingested, batched = (f"{layer}_{mark}" for layer in ("bronze.a", "silver.b", "bronze.c", "bronze.f"))
    customers = t["customer"].select(F.col("c_custkey").alias("key"))
    suppliers = t["supplier"].select(F.col("s_suppkey").alias("key"))
    landed = _folder(t)
    _as_csv(customers, f"{landed}/customers.csv")
    for _ in range(2):
        append_table(customers, appended)
        ingest_files(spark, landed, {"customers.csv": ingested})
        ingest_files(spark, landed, {"customers.csv": batched}, batch="first")
    append_batch(stamp_ingestion(suppliers.select(F.col("key").cast("string"))), batched, "second")
    for rows in (customers, suppliers):
        overwrite_table(rows, replaced)
    with suppress(Exception):
        overwrite_table(customers.select(F.raise_error(F.lit("no such row")).cast("bigint").alias("key")), replaced)

    def held(write, table):
        key = F.col("key").cast("bigint")
        return spark.table(table).agg(F.lit(write).alias("write"), F.count("*").alias("row_count"), F.sum(key).alias("key_sum"))

    tables = {"append": appended, "overwrite": replaced, "ingest": ingested, "batches": batched}
    result = stage(reduce(DataFrame.unionByName, (held(write, table) for write, table in tables.items())))
    for table in tables.values():
        drop_table(spark, table)
    return result


@on_tables
def records_frame(t):
    """The nations as the records of one response, and the customers of each."""
    rows = t["nation"].select(F.col("n_name").alias("dataHoraCotacao"), F.col("n_nationkey").cast("double").alias("cotacaoCompra"))
    records = records_to_df(t.spark, [r.asDict() for r in rows.collect()])
    counted = t["customer"].groupBy(F.col("c_nationkey").cast("double").alias("cotacaoCompra")).agg(F.count("*").alias("customers"))
    return records.join(counted, "cotacaoCompra", "left")


@on_tables
def calendar_days(t):
    day = F.col("o_orderdate").cast("date")
    return ops.calendar_between(t["orders"].agg(F.min(day).alias("first"), F.max(day).alias("last")), "first", "last")


@on_tables
def landing_to_gate(t):
    """Two daily runs over all layers, from landed files to the report on the star.

    The layers have names of their own and are dropped at the end; landed files are, once the raw tables hold them.
    """
    spark, prefix = t.spark, f"run_{uuid.uuid4().hex}_"
    for nth, day in enumerate(BATCH_DAYS):
        folder = _folder(t)
        for file_name, (source, part) in LANDED.items():
            rows = t.input(source)
            second = F.expr(part.format(day=SECOND_BATCH))
            _as_csv(rows.filter(second == F.lit(bool(nth))).drop("ingestion_datetime"), f"{folder}/{file_name}", **PACKED)
        rates = t.input("raw_rates").filter(F.expr("dataHoraCotacao >= '1996'") == F.lit(bool(nth)))
        run.run_bronze(spark, folder, rates, datetime.fromisoformat(day), prefix=prefix)
        drop_folder(spark, folder)
        run.run_silver(spark, RATE_START, RATE_END, prefix=prefix)
    run.run_gold(spark, prefix=prefix)
    report = stage(run.gold_report(spark, prefix))
    run.drop_layers(spark, prefix)
    return report


# --- series ---------------------------------------------------------------------------------------


@on_tables
def calendar_ffill(t):
    days = ops.latest_per_day(t.input("week_values"), "read_at", "o_totalprice", "day", "price")
    return ops.fill_forward(days, "day", "price", "1999-01-01", "2001-12-31", from_first_value=True)


@on_tables
def calendar_ffill_by_series(t):
    by = ["o_orderpriority"]
    days = ops.latest_per_day(t.input("week_values"), "read_at", "o_totalprice", "day", "price", by)
    return ops.fill_forward(days, "day", "price", "1994-12-01", "2001-12-31", by)


@on_tables
def latest_rate(t):
    days = ops.latest_per_day(t.input("week_values"), "read_at", "o_totalprice", "day", "price")
    return ops.latest_value(days, "day", "price", "rate")


# --- star -----------------------------------------------------------------------------------------


def _orders_dim(t):
    return ops.dense_key(t["orders"].select("o_orderkey", "o_orderstatus"), ["o_orderkey"], "sk_movie_id")


def _part_links(t):
    lines = t["lineitem"].select("l_orderkey", "l_partkey")
    parts = t["part"].select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type")
    return lines.join(parts, "l_partkey")


@on_tables
def dim_key(t):
    return ops.dimension(t["customer"], {"c_name": "name"}, "sk_customer")


@on_tables
def dim_two_col_key(t):
    return ops.dimension(t["part"], {"p_name": "name", "p_brand": "brand"}, "sk_person_id")


@on_tables
def bridge_using(t):
    types = ops.dimension(t["part"], {"p_type": "p_type"}, "sk_genre_id")
    movie = ops.Side(_orders_dim(t), "sk_movie_id", {"l_orderkey": "o_orderkey"})
    return ops.bridge(_part_links(t), movie, ops.Side(types, "sk_genre_id", {"p_type": "p_type"}))


@on_tables
def bridge_two_cond(t):
    people = ops.dimension(t["part"], {"p_name": "name", "p_brand": "brand"}, "sk_person_id")
    movie = ops.Side(_orders_dim(t), "sk_movie_id", {"l_orderkey": "o_orderkey"})
    person = ops.Side(people, "sk_person_id", {"p_name": "name", "p_brand": "brand"})
    return ops.bridge(_part_links(t), movie, person)


@on_tables
def fact_left(t):
    released = t["orders"].filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("sk_movie_id"), F.col("o_orderkey").cast("string").alias("id")
    )
    price = F.col("l_extendedprice").cast(MONEY)
    sums = t["lineitem"].groupBy(F.col("l_orderkey").cast("string").alias("id")).agg(
        F.sum(price).alias("revenue")
    )
    visits = t["events"].groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("visits"))
    return ops.fact(released, "sk_movie_id", "id", [(sums, {"revenue": MONEY}), (visits, {"visits": "int"})])


@on_tables
def summary_dim(t):
    customers = t["customer"].select(F.col("c_custkey").alias("sk_movie_id"), F.col("c_custkey").alias("user_id"))
    tenths = F.col("event_id") % 101
    summary = {"n": F.count(F.lit(1)), "mean": F.round(F.avg(tenths), 2)}
    return ops.summary_dimension(t["events"], customers, "user_id", "sk_movie_id", "sk_review_id", summary)


@on_tables
def collect_names(t):
    links = t["lineitem"].select("l_orderkey", F.col("l_suppkey").alias("s_suppkey"))
    return ops.names_per_key(links, t["supplier"], "s_suppkey", "l_orderkey", "s_name", "names")


@on_tables
def context_document(t):
    price = F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY)
    lines = t["lineitem"].filter(F.col("l_returnflag") == "R")
    fact = lines.groupBy(F.col("l_orderkey").alias("sk_movie_id")).agg(
        price.alias("receita_usd"), F.max(F.when(F.col("l_tax") > 0.05, F.col("l_tax")).cast(MONEY)).alias("orcamento_usd")
    )
    links = t["lineitem"].select(F.col("l_orderkey").alias("sk_movie_id"), F.col("l_suppkey").alias("s_suppkey"))
    actors = ops.names_per_key(links, t["supplier"], "s_suppkey", "sk_movie_id", "s_name", "atores_principais")
    urgent = t["orders"].filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("sk_movie_id"), F.col("o_custkey").cast("string").alias("diretor")
    )
    day = F.col("o_orderdate").cast("date")
    movies = t["orders"].select(
        F.col("o_orderkey").alias("sk_movie_id"),
        F.col("o_orderkey").cast("string").alias("id_filme"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Order "), F.col("o_orderkey"))).alias("titulo"),
        F.year(F.when(F.col("o_orderstatus") != "O", day)).alias("ano_lancamento"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("sinopse"),
    )
    return gold.movie_context(movies, fact, actors, urgent)


# --- analytics on the driver tables ---------------------------------------------------------------


def _priced_orders(t):
    return t["orders"].withColumn("price", F.col("o_totalprice").cast(MONEY))


@on_tables
def q_total(t):
    return ops.sum_total(_priced_orders(t), "price", "total")


@on_tables
def q_top5(t):
    named = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice").join(
        t["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey"
    )
    best = ops.top_n(named, "o_totalprice", 5, ["o_orderkey"])
    return best.select("c_name", "o_totalprice")


@on_tables
def q_count_by_class(t):
    links = t["lineitem"].select(F.col("l_partkey").alias("p_partkey"))
    return ops.count_per_class(links, t["part"], "p_partkey", "p_type", "n")


@on_tables
def q_rank10(t):
    orders = _priced_orders(t).select("o_orderkey", "o_custkey", "price")
    named = orders.join(t["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    ranked = ops.rank_top(named, "price", 10, "place", ["o_orderkey"])
    return ranked.select("o_orderkey", "c_name", "price", "place")


def _recent_orders(t, months):
    orders = t["orders"].select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    cutoff = ops.latest_past_date(orders, "day", F.lit(TODAY).cast("date")).scalar()
    return orders.filter(ops.in_last_months("day", cutoff, months))


@on_tables
def q_top_person_window(t):
    links = _recent_orders(t, 24).select(F.col("o_custkey").alias("c_custkey"))
    return ops.count_per_class(links, t["customer"], "c_custkey", "c_name", "n").limit(1)


@on_tables
def q_top_company_window(t):
    lines = t["lineitem"].select(
        "l_orderkey", F.col("l_suppkey").alias("s_suppkey"), F.col("l_extendedprice").cast(MONEY).alias("price")
    )
    recent = _recent_orders(t, 60).select(F.col("o_orderkey").alias("l_orderkey"))
    shares = lines.join(recent, "l_orderkey")
    return ops.count_per_class(shares, t["supplier"], "s_suppkey", "s_name", "total", "price").limit(1)


# --- keys that do not match -----------------------------------------------------------------------


@on_tables
def anti_both_ways(t):
    finished = t["orders"].filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("k"))
    returned = t["lineitem"].filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("k"))
    return ops.unmatched(returned, finished, "k")


@on_tables
def orphans(t):
    links = t["lineitem"].select(F.col("l_partkey").alias("p_partkey"))
    return ops.orphans(links, t["part"].filter(F.col("p_size") <= 25), "p_partkey")


# --- quality rules on faulty tables ---------------------------------------------------------------


def _line_fact(t):
    return t["lineitem"].select(F.col("l_orderkey").alias("sk_movie_id"))


def _order_movies(t):
    status = F.when(F.col("o_orderstatus") == "F", c.RELEASED).otherwise(c.UNKNOWN_STATUS)
    return t["orders"].select(F.col("o_orderkey").alias("sk_movie_id"), status.alias("status_filme"))


def _comment_context(t):
    return t.input("comment_txt").select(F.col("comment_txt").alias("llm_context_document"))


def _part_genres(t):
    genre = F.when(F.col("p_size") <= 25, F.lit("Drama")).otherwise(F.col("p_type"))
    return t["part"].select(genre.alias("nome_genero"))


def _bridge_tables(t):
    lines = t["lineitem"].select(
        F.col("l_orderkey").alias("sk_movie_id"),
        F.col("l_partkey").alias("sk_genre_id"),
        F.col("l_suppkey").alias("sk_person_id"),
        (F.col("l_suppkey") % 30).alias("sk_company_id"),
    )
    return {
        "bridge_genre": lines.select("sk_movie_id", "sk_genre_id"),
        "bridge_person": lines.select("sk_movie_id", "sk_person_id"),
        "bridge_company": lines.select("sk_movie_id", "sk_company_id"),
        "dim_movies": t["orders"].filter(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("sk_movie_id")),
        "dim_genres": t["part"].filter(F.col("p_size") <= 25).select(F.col("p_partkey").alias("sk_genre_id")),
        "dim_people": t["supplier"].select(F.col("s_suppkey").alias("sk_person_id")),
        "dim_companies": t["nation"].select(F.col("n_nationkey").cast("bigint").alias("sk_company_id")),
    }


def _rating_fact(t):
    return t["events"].select(
        F.col("value").alias("nota_media_tmdb"), (F.col("value") / 10).alias("nota_media_imdb")
    )


def _rating_reviews(t):
    return t["customer"].select((F.col("c_acctbal") / 1000).alias("nota_media_usuarios"))


def _money_fact(t):
    price, key = F.col("o_totalprice").cast(MONEY), F.col("o_custkey").cast(MONEY)
    profit = F.when(F.col("o_orderstatus") == "F", price - key).otherwise(price)
    return t["orders"].select(
        key.alias("orcamento_usd"),
        F.when(F.col("o_orderpriority") != "5-LOW", price).alias("receita_usd"),
        profit.cast(MONEY).alias("lucro_usd"),
        (key - 100).cast(MONEY).alias("orcamento_brl"),
        (price - 50000).cast(MONEY).alias("receita_brl"),
    )


@on_tables
def rule_grain(t):
    return gate.check_grain(_line_fact(t))


@on_tables
def rule_coverage(t):
    return gate.check_coverage(_line_fact(t), _order_movies(t))


@on_tables
def rule_document(t):
    return gate.check_context(_comment_context(t), _order_movies(t))


@on_tables
def rule_domain(t):
    return gate.check_genres(_part_genres(t))


@on_tables
def rule_bridges(t):
    return gate.check_bridges(**_bridge_tables(t))


@on_tables
def rule_range(t):
    return gate.check_ratings(_rating_fact(t), _rating_reviews(t))


@on_tables
def rule_money(t):
    return gate.check_money(_money_fact(t))


@on_tables
def gate_failures(t):
    """The failed rules of a faulty star, as the gate reports them."""
    checks = (rule_grain, rule_coverage, rule_document, rule_domain, rule_bridges, rule_range, rule_money)
    reports = [check(t) for check in checks]
    return gate.failed_rules(reduce(DataFrame.unionByName, reports)).select("regra", "detalhe")


# --- the movie catalogue: clean tables ------------------------------------------------------------


@on_silver
def silver_info(s):
    return s.info()


@on_silver
def silver_financials(s):
    return s.financials()


@on_silver
def silver_metrics(s):
    return s.metrics()


@on_silver
def silver_reviews(s):
    return s.reviews()


@on_silver
def silver_genres(s):
    return s.genres()


@on_silver
def silver_people(s):
    return s.names()


@on_silver
def silver_rates(s):
    return s.rates()


# --- the movie catalogue: star --------------------------------------------------------------------


@on_gold
def gold_dim_movies(g):
    return g.movies


@on_gold
def gold_dim_genres(g):
    return g.genres


@on_gold
def gold_dim_people(g):
    return g.people


@on_gold
def gold_dim_companies(g):
    return g.companies


@on_gold
def gold_dim_reviews(g):
    return g.reviews


@on_gold
def gold_fact(g):
    return g.fact


@on_gold
def gold_bridge_genre(g):
    return g.bridge_genre


@on_gold
def gold_bridge_person(g):
    return g.bridge_person


@on_gold
def gold_bridge_company(g):
    return g.bridge_company


@on_gold
def gold_people_per_movie(g):
    return g.people_of(c.ACTOR)


@on_gold
def gold_context(g):
    return g.context


@on_gold
def quality_report(g):
    return g.report()


# --- the movie catalogue: questions ---------------------------------------------------------------


def _today():
    return F.lit(TODAY).cast("date")


@on_gold
def question_total_revenue(g):
    return questions.total_revenue(g.fact_of("receita_brl"))


@on_gold
def question_most_popular(g):
    return questions.most_popular(g.fact_of("popularidade"), g.movies)


@on_gold
def question_movies_per_genre(g):
    return questions.movies_per_genre(g.bridge_genre, g.genres)


@on_gold
def question_highest_revenue(g):
    return questions.highest_revenue(g.fact_of("receita_usd", "receita_brl"), g.movies)


@on_gold
def question_busiest_actor(g):
    g.ready("info", "names")
    g.ready("movies", "people")
    return questions.busiest_actor(g.bridge_person, g.movies, g.people, today=_today())


@on_gold
def question_most_profitable_company(g):
    g.ready("info", "names")
    g.ready("movies", "companies")
    return questions.most_profitable_company(
        g.bridge_company, g.movies, g.fact_of("lucro_usd"), g.companies, today=_today()
    )
