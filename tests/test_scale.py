"""What must hold at any size: skew, shuffles and columns read."""

import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodestrata import operators as ops
from lodestrata.plans import gate, silver
from lodestrata.session import tune
from workloads.star import Gold
from workloads.tables import Tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tiny_skew_limits(spark):
    """Sizes at which a local table is split as a big one is on a cluster."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def test_bridge_splits_a_hot_movie_and_a_hot_name(spark, tiny_skew_limits):
    links = spark.range(0, 60000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.xxhash64("id") % 9973 + 9973).cast("string").alias("m"),
        F.when(F.col("id") % 3 == 1, "hot").otherwise(F.concat(F.lit("n"), F.col("id"))).alias("n"),
    )
    movies = spark.range(20000).select((F.col("id") + 1).alias("mk"), F.col("id").cast("string").alias("movie"))
    people = ops.dimension(links, {"n": "name"}, "pk")
    got = ops.bridge(links, ops.Side(movies, "mk", {"m": "movie"}), ops.Side(people, "pk", {"n": "name"}))
    rows = got.collect()
    assert len(rows) == links.distinct().count() == len(set(rows))
    assert plan_of(got).count("skew=true") >= 2


def test_hot_keys_are_counted_before_the_join(spark, tiny_skew_limits):
    """A class with a third of all links leaves each task as one row, and joins as one row."""
    links = spark.range(0, 30000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    classes = spark.range(30000).select(F.col("id").alias("k"), F.concat(F.lit("c"), F.col("id")).alias("label"))
    for df in (ops.count_per_class(links, classes, "k", "label", "n"), ops.orphans(links, classes, "k"), ops.unmatched(links, classes, "k")):
        below = plan_of(df).split("Join", 1)[1]
        assert re.search(r"functions=\[count[\s\S]*Exchange hashpartitioning\([\s\S]*functions=\[partial_count", below)


def test_fact_shuffles_each_table_once(spark, tiny_skew_limits):
    base = spark.range(100).select("id", F.col("id").cast("string").alias("m"))
    table = spark.range(100).select(F.col("id").cast("string").alias("m"), F.lit(1.0).alias("a"))
    other = table.withColumnRenamed("a", "b")
    df = ops.fact(base, "id", "m", [(table, {"a": "double"}), (other, {"b": "double"})])
    assert plan_of(df).count("Exchange hashpartitioning") == 3


def test_whole_table_window_never_runs_for_keys(spark, sf_dir):
    customer = Tables(spark, sf_dir)["customer"]
    plan = plan_of(ops.dense_key(customer.select("c_custkey", "c_name"), ["c_name"], "k"))
    # The only single-partition window is over one number per partition.
    assert plan.count("Window ") == 1
    assert "sum(_rows" in plan[plan.index("Window ") :]
    assert "BroadcastHashJoin" in plan


def test_keys_compute_their_input_once(spark):
    """The sort samples and sorts; the rows it does both with are computed once."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(5000, numPartitions=6).mapInArrow(counted, "id long")
    assert ops.dense_key(rows, ["id"], "k").filter("k <> id + 1").count() == 0
    assert seen.value == 5000
    values = spark.range(5000, numPartitions=6).mapInArrow(counted, "id long")
    assert ops.dimension(values, {"id": "name"}, "k").filter("k <> name + 1").count() == 0
    assert seen.value == 10_000


def test_a_task_reads_a_bounded_part_of_a_large_file(spark, tmp_path):
    """What a map task sorts or sums up does not grow with the table."""
    rows = 6_000_000
    lines = pa.table({"l_orderkey": pa.array(np.random.default_rng(1).integers(0, 1 << 62, rows))})
    pq.write_table(lines, tmp_path / "lineitem.parquet", row_group_size=rows // 24, use_dictionary=False, compression="none")
    scan = Tables(spark, str(tmp_path))["lineitem"]
    assert scan.rdd.getNumPartitions() >= rows * 8 / (4 << 20) and scan.count() == rows


def test_top_n_keeps_n_rows_per_task(spark, sf_dir):
    orders = Tables(spark, sf_dir)["orders"].select("o_orderkey", "o_totalprice")
    plan = plan_of(ops.rank_top(orders, "o_totalprice", 10, "place", ["o_orderkey"]))
    assert plan.index("Window") < plan.index("TakeOrderedAndProject(limit=10")
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_scans_read_only_what_is_used(spark, sf_dir):
    t = Tables(spark, sf_dir)
    plan = plan_of(silver.movie_genres(t.input("raw_credits")))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    finished = t["orders"].filter(F.col("o_orderstatus") == "F").select("o_orderkey")
    plan = plan_of(ops.dense_key(finished, ["o_orderkey"], "k").select("k"))
    assert "_part" in plan and "o_orderkey" not in re.findall(r"ReadSchema: struct<([^>]*)>", plan)[0]


def test_dedup_sends_one_row_per_task_for_a_hot_key(spark):
    rows = spark.range(0, 40000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"), F.lit(1).alias("at")
    )
    df = ops.keep_latest_and_most_complete(rows, "k", "at")
    assert df.count() == 40000 - 13334 + 1
    plan = plan_of(df)
    assert re.search(r"row_number\(\), 1, Final[\s\S]*Exchange[\s\S]*row_number\(\), 1, Partial", plan)


def test_dedup_shuffles_no_derived_cells_and_32_bytes_of_hash(spark):
    """Derived cells count and decide as all others do, but only the rows that are kept get them after the shuffle."""

    def derive(rows):
        return rows.withColumn("third", F.when(F.col("v") % 3 == 0, F.col("w") * 2)).withColumn("more", F.col("third") + F.col("v"))

    v = F.when(F.col("id") % 5 > 0, F.col("id") % 11)
    rows = spark.range(3000).select((F.col("id") % 400).alias("k"), v.alias("v"), (F.col("id") % 7).alias("w"), F.lit(1).alias("at"))
    short = ops.keep_latest_and_most_complete(rows, "k", "at", derive=derive)
    whole = ops.keep_latest_and_most_complete(derive(rows), "k", "at").select(*short.columns)
    assert short.count() == 400 and short.exceptAll(whole).isEmpty()
    sent = re.findall(r"WindowGroupLimit .*Partial", plan_of(short))[0]
    assert "third" not in sent and "more" not in sent and "w#" in sent
    assert "unhex(sha2(" in plan_of(short)


def test_dedup_shuffles_8_bytes_of_hash(spark):
    """They decide as the whole hash does, in unsigned order."""
    rows = spark.range(4000).select((F.col("id") % 300).alias("k"), F.md5(F.col("id").cast("string")).alias("v"), F.lit(1).alias("at"))
    got = ops.keep_latest_and_most_complete(rows, "k", "at")
    assert "substring(unhex(sha2(" in plan_of(got)
    whole = rows.groupBy("k").agg(F.min_by("v", F.sha2("v", 256)).alias("v"))
    assert got.count() == 300 and got.select("k", "v").exceptAll(whole).isEmpty()


def test_rows_of_the_latest_instant_are_not_shuffled(spark, tiny_skew_limits):
    """Only older rows meet the latest instants of their keys; a batch of one instant is kept as it is."""

    def latest(k, at):
        return [(k[i], at[i], i) for i in range(len(k)) if at[i] == max((at[j] for j in range(len(k)) if k[j] == k[i] and at[j]), default=None)]

    def kept(k, at):
        rows = spark.createDataFrame([*zip(k, at, range(len(k)), strict=True)], "k string, at int, n int")
        frame = ops.keep_latest_rows(rows, "k", "at")
        assert sorted(map(tuple, frame.collect()), key=str) == sorted(latest(k, at), key=str)
        return frame

    k = ["a", "b", None, "a", "b", "c", None, "d", "d", "e", "a"]
    assert "Exchange" not in plan_of(kept(k, [3] * 11)) + plan_of(kept(k, [None] * 11)) + plan_of(kept([], []))
    plan = plan_of(kept(k, [3, 2, 3, 1, 2, 2, 1, None, 1, None, 3]))
    final = plan.split("Initial Plan")[0]
    first = final[final.index("Union") : final.index("Join")]
    assert "Scan" in first and not re.search("Exchange|ShuffleQueryStage", first)
    kept(k, [None, 2, 2, 1, 2, 2, 1, None, 1, None, None])


def test_what_a_task_reads_from_a_shuffle_is_bounded(spark):
    """Partitions of a shuffle are merged up to a few megabytes only."""
    named = spark.range(2_000_000).select(F.md5(F.col("id").cast("string")).alias("name"))
    settings = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.parallelismFirst")
    before = {name: spark.conf.get(name) for name in settings}
    try:
        tune(spark)
        spark.conf.set(settings[0], "64")
        spark.conf.set(settings[1], "false")
        shuffled = named.distinct()
        assert 64 > shuffled.rdd.getNumPartitions() >= 6
        assert shuffled.count() == 2_000_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_measure_that_is_not_wanted_costs_nothing(spark, sf_dir):
    star = Gold(spark, sf_dir)
    optimized = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for wanted in ("receita_brl", "lucro_usd"):
        assert "nota_media_imdb" not in optimized(star.fact_of(wanted))
    assert "receita_usd" not in optimized(star.fact_of("popularidade"))
    assert "nota_media_imdb" in optimized(star.fact) and "receita_usd" in optimized(star.fact)


def test_the_report_on_a_stored_star_is_one_lazy_plan(spark, sf_dir):
    """Jobs run when the star is stored; building the report runs none, and reading it a few."""
    star = Gold(spark, sf_dir)
    tables = {}
    stored = jobs_of(spark, "store", lambda: tables.update(star.stored()))
    built = []
    assert jobs_of(spark, "build", lambda: built.append(gate.check_all(**tables))) == 0
    assert jobs_of(spark, "read", built[0].collect) <= 30
    assert stored <= 110
