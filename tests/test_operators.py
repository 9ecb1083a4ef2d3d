"""Table operators on small frames, with shuffled input where order must not matter."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata import operators as ops


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- duplicates -----------------------------------------------------------------------------------


def test_latest_row_wins(spark):
    rows = [(1, "old", "2026-01-01 00:00:00"), (1, "new", "2026-02-01 00:00:00"), (2, "x", "2026-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "k int, v string, ingestion_datetime string")
    got = ops.keep_latest_and_most_complete(df, "k").orderBy("k").collect()
    assert [(r["k"], r["v"]) for r in got] == [(1, "new"), (2, "x")]


def test_most_complete_row_wins_a_tie(spark):
    rows = [(1, None, "a", 5), (1, "b", "c", 5), (1, "d", None, 5)]
    df = spark.createDataFrame(rows, "k int, v string, w string, at int")
    got = ops.keep_latest_and_most_complete(df, "k", "at").collect()
    assert [(r["v"], r["w"]) for r in got] == [("b", "c")]


def test_completeness_of_named_columns_only(spark):
    rows = [(1, None, "a", "b", 5), (1, "v", None, None, 5)]
    df = spark.createDataFrame(rows, "k int, v string, w string, x string, at int")
    assert ops.keep_latest_and_most_complete(df, "k", "at").first()["w"] == "a"
    assert ops.keep_latest_and_most_complete(df, "k", "at", ["v"]).first()["v"] == "v"


def test_full_tie_does_not_depend_on_input_order(spark):
    rows = [(k, f"v{i}", f"w{i % 3}", 1) for k in range(20) for i in range(9)]
    rows += [(k, a, b, 1) for k in range(20, 40) for a, b in (("a", None), (None, "a"))]
    answers = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, v string, w string, at int").repartition(5)
        got = ops.keep_latest_and_most_complete(df, "k", "at").orderBy("k").collect()
        assert len(got) == 40
        answers.add(tuple((r["k"], r["v"], r["w"]) for r in got))
    assert len(answers) == 1


def test_dedup_keeps_one_row_per_key_and_task_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"), F.lit(1).alias("at"))
    plan = plan_of(ops.keep_latest_and_most_complete(df, "k", "at"))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(k") < plan.index("Partial")


def test_drop_exact_duplicates(spark):
    rows = [(1, "u", 8.0, "a"), (1, "u", 8.0, "a"), (1, "u", 8.0, "b")]
    df = spark.createDataFrame(rows, "i int, n string, r double, t string")
    assert ops.drop_exact_duplicates(df, df.columns).count() == 2


# --- slipped rows ---------------------------------------------------------------------------------


def test_slipped_rows_lose_their_popularity(spark):
    rows = [(1, "1954", "10.0", None, "Danish", None), (2, "31.842", "7.5", "100", None, "5000"), (3, "5", "", "1.0", "", "")]
    df = spark.createDataFrame(rows, "k int, pop string, a string, b string, c string, d string")
    flagged = ops.flag_shifted_rows(df, {"a": "double", "b": "int", "c": "double", "d": "int"}, "slipped")
    assert [r["slipped"] for r in flagged.orderBy("k").collect()] == [True, False, True]
    clean = ops.distrust_shifted_rows(flagged, ["pop"], "slipped").orderBy("k")
    assert clean.columns == df.columns
    assert [r["pop"] for r in clean.collect()] == [None, "31.842", None]


# --- exploding ------------------------------------------------------------------------------------


def test_explode_list(spark):
    rows = [(1, "Comedy|Drama"), (2, "A , B;C"), (3, None)]
    df = spark.createDataFrame(rows, "k int, cell string")
    got = {(r["k"], r["e"]) for r in ops.explode_list(df, "k", "cell", "e").collect()}
    assert got == {(1, "Comedy"), (1, "Drama"), (2, "A"), (2, "B"), (2, "C")}


def test_explode_entities_in_one_scan(spark, sf_dir):
    rows = [(1, '\\petra Lindqvist, Ivo Brandt"', "D", None), (2, "N/A", None, "P, Inc.")]
    df = spark.createDataFrame(rows, "k int, a string, b string, c string")
    kinds = {"a": "A", "b": "B", "c": "C"}
    got = ops.keep_names(ops.explode_entities(df, "k", kinds, "n", "t"), "n").collect()
    assert {(r["k"], r["n"], r["t"]) for r in got} == {
        (1, "petra Lindqvist", "A"), (1, "Ivo Brandt", "A"), (2, "Inc.", "C"),
    }
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    tall = ops.explode_entities(part, "p_partkey", {"p_name": "N", "p_type": "T"}, "n", "t")
    assert plan_of(tall).count("FileScan") == 1


# --- daily series ---------------------------------------------------------------------------------


def rates(spark, rows):
    return spark.createDataFrame([(date.fromisoformat(d), v) for d, v in rows], "d date, v double")


def pairs(df):
    return [(r["d"].isoformat(), r["v"]) for r in df.orderBy("d").collect()]


def test_calendar_is_closed_and_may_be_empty(spark):
    days = ops.calendar(spark, "2026-02-27", "2026-03-01").collect()
    assert [r["day"].isoformat() for r in days] == ["2026-02-27", "2026-02-28", "2026-03-01"]
    assert ops.calendar(spark, "2026-03-02", "2026-03-01").count() == 0


def test_fill_forward(spark):
    df = rates(spark, [("2026-09-11", 5.30), ("2026-09-14", 5.40)])
    assert pairs(ops.fill_forward(df, "d", "v", "2026-09-10", "2026-09-15")) == [
        ("2026-09-10", None), ("2026-09-11", 5.30), ("2026-09-12", 5.30), ("2026-09-13", 5.30),
        ("2026-09-14", 5.40), ("2026-09-15", 5.40),
    ]


def test_fill_forward_from_the_first_stored_day(spark):
    df = rates(spark, [("2026-09-10", 5.10)])
    got = pairs(ops.fill_forward(df, "d", "v", "2026-09-12", "2026-09-13", from_first_value=True))
    assert got == [(f"2026-09-{d}", 5.10) for d in (10, 11, 12, 13)]
    late = pairs(ops.fill_forward(df, "d", "v", "2026-09-09", "2026-09-10", from_first_value=True))
    assert late == [("2026-09-09", None), ("2026-09-10", 5.10)]
    none = pairs(ops.fill_forward(rates(spark, []), "d", "v", "2026-09-09", "2026-09-10", from_first_value=True))
    assert none == [("2026-09-09", None), ("2026-09-10", None)]
    assert ops.fill_forward(df, "d", "v", "2026-09-12", "2026-09-01").count() == 0


def test_fill_forward_of_many_series(spark):
    rows = [("x", date(2026, 1, 1), 1.0), ("y", date(2026, 1, 2), 2.0)]
    df = spark.createDataFrame(rows, "s string, d date, v double")
    got = ops.fill_forward(df, "d", "v", "2026-01-01", "2026-01-03", by=["s"]).orderBy("s", "d").collect()
    assert [(r["s"], r["d"].day, r["v"]) for r in got] == [
        ("x", 1, 1.0), ("x", 2, 1.0), ("x", 3, 1.0), ("y", 1, None), ("y", 2, 2.0), ("y", 3, 2.0),
    ]


def test_latest_per_day(spark):
    rows = [
        ("2026-09-17 10:00:00.0", 5.0), ("2026-09-17 13:09:02.5", 5.35), ("2026-09-17 13:09:02.5", 5.30),
        ("2026-09-18 09:00:00", 6.0), ("bad", 9.0), (None, 8.0),
    ]
    df = spark.createDataFrame(rows, "at string, r double")
    got = ops.latest_per_day(df, "at", "r", "d", "v").filter(F.col("d").isNotNull())
    assert pairs(got) == [("2026-09-17", 5.35), ("2026-09-18", 6.0)]


def test_latest_value_and_clear_error(spark):
    df = rates(spark, [("2026-09-11", 5.30), ("2026-09-14", 5.40), ("2026-09-13", 5.20)])
    assert ops.latest_value(df, "d", "v").first()[0] == 5.40
    gap = spark.createDataFrame([(date(2026, 9, 11), 5.30), (date(2026, 9, 12), None)], "d date, v double")
    rate = ops.require_value(ops.latest_value(gap, "d", "v"), "no rate")
    assert spark.range(2).select((F.col("id") * rate).alias("x")).collect()[1]["x"] == 5.30
    missing = ops.require_value(ops.latest_value(rates(spark, []), "d", "v"), "no rate at all")
    with pytest.raises(Exception, match="no rate at all"):
        spark.range(2).select(F.col("id") * missing).collect()


# --- keys -----------------------------------------------------------------------------------------


def test_dense_key_equals_global_row_number(spark):
    values = [f"n{i * 7919 % 5003:05d}" for i in range(5003)] + [None]
    for seed in (1, 2):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v string").repartition(6)
        got = {r["v"]: r["k"] for r in ops.dense_key(df, ["v"], "k").collect()}
        ordered = [None, *sorted(v for v in values if v is not None)]
        assert got == {v: i + 1 for i, v in enumerate(ordered)}


def test_dense_key_over_many_partitions_and_two_columns(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(20000).select((F.col("id") % 10).cast("string").alias("a"), (-F.col("id")).alias("b"))
        keyed = ops.dense_key(df, ["a", "b"], "k")
        assert keyed.columns == ["k", "a", "b"]
        rows = keyed.orderBy("k").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [r["k"] for r in rows] == list(range(1, 20001))
    assert [(r["a"], r["b"]) for r in rows] == sorted((str(i % 10), -i) for i in range(20000))


def test_dense_key_of_equal_rows_and_of_nothing(spark):
    df = spark.createDataFrame([("x",)] * 500 + [("y",)] * 3, "v string").repartition(4)
    assert sorted(r["k"] for r in ops.dense_key(df, ["v"], "k").collect()) == list(range(1, 504))
    assert ops.dense_key(df.limit(0), ["v"], "k").count() == 0


# --- star -----------------------------------------------------------------------------------------


def test_bridge_on_two_columns_and_mixed_key_types(spark):
    movies = spark.createDataFrame([(10, "1"), (20, "2")], "mk bigint, movie string")
    people = spark.createDataFrame([(1, "Ann", "A"), (2, "Ann", "D"), (3, "Bob", "A")], "pk bigint, name string, role string")
    links = spark.createDataFrame(
        [(1, "Ann", "A"), (1, "Ann", "A"), (1, "Ann", "D"), (2, "Bob", "A"), (9, "Bob", "A"), (2, "Zed", "A")],
        "m int, n string, r string",
    )
    got = ops.bridge(links, ops.Side(movies, "mk", {"m": "movie"}), ops.Side(people, "pk", {"n": "name", "r": "role"}))
    assert got.columns == ["mk", "pk"]
    assert sorted(map(tuple, got.collect())) == [(10, 1), (10, 2), (20, 3)]


def test_fact_keeps_every_base_row_and_nulls_what_does_not_fit(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k bigint, id string")
    money = spark.createDataFrame([("a", 1.25), ("b", 1e17)], "id string, m double")
    votes = spark.createDataFrame([("c", "7"), ("a", "x")], "id string, v string")
    got = ops.fact(base, "k", "id", [(money, {"m": "decimal(18,2)"}), (votes, {"v": "int"})])
    assert sorted(map(tuple, got.collect())) == [(1, Decimal("1.25"), None), (2, None, None), (3, None, 7)]


def test_summary_dimension(spark):
    dim = spark.createDataFrame([(5, "a"), (6, "b")], "mk bigint, id string")
    details = spark.createDataFrame([("a", 8.0), ("a", 6.0), ("a", None), ("z", 1.0)], "id string, r double")
    summary = {"n": F.count(F.lit(1)), "mean": F.round(F.avg("r"), 2)}
    got = ops.summary_dimension(details, dim, "id", "mk", "sk", summary)
    assert got.columns == ["sk", "mk", "n", "mean"]
    assert [tuple(r) for r in got.collect()] == [(1, 5, 3, 7.0)]


def test_orphans_and_unmatched_count_rows_and_nulls(spark):
    links = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    assert ops.orphans(links, dim, "k").first()[0] == 3
    assert ops.orphans(links.limit(0), dim, "k").first()[0] == 0
    row = ops.unmatched(links, dim, "k").first().asDict()
    assert row == {
        "left_rows": 6, "left_keys": 4, "right_rows": 4, "right_keys": 4, "only_left": 3, "only_right": 2,
    }
    empty = ops.unmatched(links.limit(0), dim.limit(0), "k").first()
    assert list(empty) == [0, 0, 0, 0, 0, 0]


# --- documents ------------------------------------------------------------------------------------


def test_names_per_key_are_distinct_and_sorted(spark):
    links = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 9), (1, 4)], "m int, p int")
    members = spark.createDataFrame([(1, "Zoe"), (2, "Ana"), (3, "Bia"), (4, "Ana")], "p int, n string")
    got = ops.names_per_key(links, members, "p", "m", "n", "names").collect()
    assert [tuple(r) for r in got] == [(1, "Ana, Bia, Zoe")]


def test_assemble_sentence(spark):
    df = spark.createDataFrame([("T", Decimal("1234567.5")), (None, None)], "t string, m decimal(18,2)")
    parts = ["Film ", (F.col("t"), "?"), " made ", (ops.money_words("m", "US$"), "nothing known"), "."]
    got = [r[0] for r in df.select(ops.assemble_sentence(parts)).collect()]
    assert got == ["Film T made US$ 1,234,567.50.", "Film ? made nothing known."]


# --- analytics ------------------------------------------------------------------------------------


def test_rank_top_equals_rank_over_everything(spark):
    rows = [(i, float(v)) for i, v in enumerate([5, 9, 9, 1, 7, 7, 7, 2])] + [(8, None)]
    df = spark.createDataFrame(rows, "i int, v double")
    got = ops.rank_top(df, "v", 4, "place", ["i"]).collect()
    assert sorted((r["i"], r["place"]) for r in got) == [(1, 1), (2, 1), (4, 3), (5, 3)]
    everything = ops.rank_top(df, "v", 20, "place", ["i"]).collect()
    assert {r["i"]: r["place"] for r in everything}[8] == 9


def test_top_n_and_count_per_class(spark):
    links = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (9,)], "g int")
    classes = spark.createDataFrame([(1, "Z"), (2, "B"), (3, "A"), (4, "C")], "g int, name string")
    got = ops.count_per_class(links, classes, "g", "name", "n").collect()
    assert [tuple(r) for r in got] == [("A", 2), ("Z", 2), ("B", 1)]
    best = ops.top_n(links.withColumn("i", F.monotonically_increasing_id()), "g", 2, ["i"])
    assert [r["g"] for r in best.collect()] == [9, 3]


def test_count_per_class_sums_exact_money(spark):
    links = spark.createDataFrame([(1, Decimal("0.10")), (1, Decimal("0.20")), (2, None)], "g int, m decimal(18,2)")
    classes = spark.createDataFrame([(1, "A"), (2, "B")], "g int, name string")
    got = ops.count_per_class(links, classes, "g", "name", "s", "m")
    assert got.schema["s"].dataType.simpleString() == "decimal(28,2)"
    assert [tuple(r) for r in got.collect()] == [("A", Decimal("0.30")), ("B", None)]


def test_recent_window_is_closed_and_ignores_the_future(spark):
    days = ["2024-02-28", "2024-02-29", "2026-02-28", "2029-01-01"]
    df = spark.createDataFrame([(date.fromisoformat(d),) for d in days], "d date")
    cutoff = ops.latest_past_date(df, "d", F.lit("2026-06-01").cast("date")).scalar()
    got = df.filter(ops.in_last_months("d", cutoff, 24)).collect()
    assert sorted(r["d"].isoformat() for r in got) == ["2024-02-28", "2024-02-29", "2026-02-28"]


# --- quality --------------------------------------------------------------------------------------


def test_quality_report_and_gate(spark):
    first = spark.createDataFrame([(3, 0)], "total int, bad int")
    second = spark.createDataFrame([(2,)], "worse int")
    rules = [
        ops.Rule("fine", ["bad"], "{total} rows fine", "{bad} bad"),
        ops.Rule("broken", ["bad", "worse"], "ok", "{bad} bad and {worse} worse of {total}"),
    ]
    report = ops.quality_report([first, second], rules)
    assert [tuple(r) for r in report.collect()] == [
        ("fine", True, 0, "3 rows fine"), ("broken", False, 2, "0 bad and 2 worse of 3"),
    ]
    with pytest.raises(ops.QualityGateFailed) as failure:
        ops.raise_on_failures(report, "{n} failed:")
    assert str(failure.value) == "1 failed:\n- broken: 0 bad and 2 worse of 3"
    ops.raise_on_failures(ops.quality_report([first], rules[:1]), "{n} failed:")


def test_session_clock_is_utc(spark):
    assert spark.sql("select timestamp'2026-01-01 00:00:00' t").first()["t"] == datetime(2026, 1, 1)
