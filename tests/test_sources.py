"""Landed files, records, stamps, tables and the staging folder."""

import json
from datetime import UTC, datetime

import pytest

from lodestrata import sources

MOMENT = datetime(2026, 9, 20, 6, 0, tzinfo=UTC)


def test_csv_is_one_record_per_physical_line(spark, tmp_path):
    file = tmp_path / "m.csv"
    file.write_text(
        'id,title,score\n'
        '1,"say ""hi"", now",7\n'
        '2,"broken quote,8\n'
        '3,ok,9,extra,fields\n'
        '4,short\n'
    )
    df = sources.read_landing_csv(spark, str(file))
    assert [t for _, t in df.dtypes] == ["string"] * 3
    rows = {r["id"]: r for r in df.collect()}
    assert set(rows) == {"1", "2", "3", "4"}
    assert rows["1"]["title"] == 'say "hi", now'
    assert rows["3"]["score"] == "9"
    assert rows["4"]["score"] is None
    named = sources.read_landing_csv(spark, str(file), columns=["id", "title", "score"])
    assert {tuple(r) for r in named.collect()} == {tuple(r) for r in df.collect()}
    typed = sources.read_landing_csv(spark, str(file), infer_types=True)
    assert dict(typed.dtypes)["id"] == "int"


def test_rate_feed(spark, tmp_path):
    for i, day in enumerate(("2026-09-16", "2026-09-17")):
        records = [{"dataHoraCotacao": f"{day} 13:09:02.5", "cotacaoCompra": 5.35 + i}]
        (tmp_path / f"r{i}.json").write_text(json.dumps({"value": records}, indent=1))
    (tmp_path / "empty.json").write_text('{"value": []}')
    df = sources.read_rate_json(spark, str(tmp_path))
    assert df.columns == ["dataHoraCotacao", "cotacaoCompra"]
    assert df.count() == 2
    some = sources.read_rate_json(spark, str(tmp_path), "2026-09-17", "2026-09-17").collect()
    assert [tuple(r) for r in some] == [("2026-09-17 13:09:02.5", 6.35)]


@pytest.mark.parametrize(
    "text", ['{"error": "boom"}', '{"value": [{"dataHoraCotacao": "2026-09-16 13:09:02.5", "cotaca', "<html>", "", '{"value": null}']
)
def test_a_broken_response_stops_the_run(spark, tmp_path, text):
    (tmp_path / "good.json").write_text('{"value": []}')
    (tmp_path / "broken.json").write_text(text or " ")
    with pytest.raises(Exception, match="response without a list of rates.*broken.json"):
        sources.read_rate_json(spark, str(tmp_path)).collect()


def test_a_header_in_another_order_stops_the_run(spark, tmp_path):
    file = tmp_path / "swapped.csv"
    file.write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_landing_csv(spark, str(file), columns=["a", "b"]).collect()


def test_records(spark):
    two = [{"dataHoraCotacao": "a", "cotacaoCompra": 1.0}, {"dataHoraCotacao": "b", "cotacaoCompra": 2.0}]
    assert sources.records_to_df(spark, two).count() == 2
    none = sources.records_to_df(spark, [])
    assert none.count() == 0
    assert none.columns == ["dataHoraCotacao", "cotacaoCompra"]


def test_stamp(spark):
    df = sources.stamp_ingestion(spark.createDataFrame([(1, "a")], "i int, s string"), MOMENT)
    assert [tuple(r) for r in df.collect()] == [(1, "a", datetime(2026, 9, 20, 6, 0))]
    assert dict(df.dtypes)["ingestion_datetime"] == "timestamp"
    assert sources.stamp_ingestion(spark.range(1)).first()["ingestion_datetime"] is not None


def test_tables_and_ingest(spark, tmp_path):
    sources.ensure_layers(spark, ["shelf"])
    sources.ensure_layers(spark, ["shelf"])
    (tmp_path / "a.csv").write_text("id,v\n1,x\n2,y\n")
    (tmp_path / "b.csv").write_text("id\n7\n")
    files = {"a.csv": "shelf.a", "b.csv": "shelf.b"}
    assert sources.ingest_files(spark, str(tmp_path), files, MOMENT) == {"shelf.a": 2, "shelf.b": 1}
    sources.ingest_files(spark, str(tmp_path), files, MOMENT)
    table = spark.table("shelf.a")
    assert table.count() == 4
    assert table.columns == ["id", "v", "ingestion_datetime"]
    for n in (3, 5):
        sources.overwrite_table(spark.range(n), "shelf.c", "orc")
    assert spark.table("shelf.c").count() == 5


def test_staged_tables_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert sources.staging_folder(spark).startswith(shared)
    staged = sources.stage(spark.range(10))
    assert staged.count() == 10
    assert all(shared in f for f in staged.inputFiles())


class _Session:
    """A session on a given master, with the warehouse as its only shared folder."""

    def __init__(self, master):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.applicationId = "app"

    def get(self, name, default=None):
        return "/shared/warehouse" if name == "spark.sql.warehouse.dir" else default


@pytest.mark.parametrize("master", ["local[2]", "local-cluster[2,1,1024]", "yarn"])
def test_without_a_checkpoint_folder_the_warehouse_holds_staged_tables(master):
    assert sources.staging_folder(_Session(master)) == "/shared/warehouse/lodestrata/app"


def _files(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(f.getPath()) for f in system.listStatus(path)] if system.exists(path) else []


def test_tables_that_a_result_does_not_read_are_dropped(spark):
    with sources.staging_into(spark) as folder:
        first, second = sources.stage(spark.range(3)), sources.stage(spark.range(5))
        result = sources.stage(first.join(second, "id")).join(second, "id", "right")
    sources.drop_unread(result, folder)
    assert len(_files(spark, folder)) == 2 and result.count() == 5
    sources.drop_folder(spark, folder)
    sources.drop_unread(spark.range(1), folder)


def test_a_run_drops_what_it_staged(spark):
    with sources.staged_run(spark) as folder:
        assert sources.stage(spark.range(3)).count() == 3
        assert len(_files(spark, folder)) == 1
    assert _files(spark, folder) == []
    with sources.staged_run(spark) as folder:
        with sources.staging_into(spark) as inner:
            sources.stage(spark.range(3))
        assert len(_files(spark, inner)) == 1
    assert _files(spark, inner) == []
    with pytest.raises(ValueError), sources.staged_run(spark) as folder:
        sources.stage(spark.range(3))
        raise ValueError
    assert _files(spark, folder) == []


def _files_of(spark, table):
    return set(spark.table(table).inputFiles())


def test_a_failed_overwrite_leaves_the_old_rows(spark):
    sources.ensure_layers(spark, ["shelf"])
    table = "shelf.replaced"
    sources.overwrite_table(spark.range(5), table)
    broken = spark.range(1000, numPartitions=4).selectExpr("IF(id = 999, raise_error('killed'), id) AS id")
    with pytest.raises(Exception, match="killed"):
        sources.overwrite_table(broken, table)
    assert sorted(r[0] for r in spark.table(table).collect()) == [0, 1, 2, 3, 4]
    sources.overwrite_table(spark.table(table).selectExpr("id + 10 AS id"), table)
    assert sorted(r[0] for r in spark.table(table).collect()) == [10, 11, 12, 13, 14]


def test_a_reader_that_has_begun_keeps_its_version(spark):
    sources.ensure_layers(spark, ["shelf"])
    table = "shelf.read"
    sources.overwrite_table(spark.range(3), table)
    begun, first = spark.read.parquet(*_files_of(spark, table)), _files_of(spark, table)
    sources.overwrite_table(spark.range(4), table)
    assert begun.count() == 3 and spark.table(table).count() == 4
    sources.overwrite_table(spark.range(6), table)
    folders = _files(spark, sources.tables._versions(spark, table))
    assert len(folders) == 2 and not any(f.rsplit("/", 1)[0] in folders for f in first)


def test_a_version_that_nobody_reads_is_deleted_at_once(spark):
    sources.ensure_layers(spark, ["shelf"])
    table = "shelf.alone"
    sources.overwrite_table(spark.range(3), table)
    sources.overwrite_table(spark.table(table).selectExpr("id + 1 AS id"), table, keep_before=False)
    assert sorted(r[0] for r in spark.table(table).collect()) == [1, 2, 3]
    assert len(_files(spark, sources.tables._versions(spark, table))) == 1


def test_tables_are_packed(spark):
    sources.ensure_layers(spark, ["shelf"])
    sources.overwrite_table(spark.range(3), "shelf.packed")
    sources.append_batch(spark.range(3), "shelf.packed_batches", "one")
    for table in ("shelf.packed", "shelf.packed_batches"):
        assert all(file.endswith(".zstd.parquet") for file in _files_of(spark, table)) and spark.table(table).count() == 3


def test_other_columns_another_format_and_a_managed_table(spark):
    sources.ensure_layers(spark, ["shelf"])
    table = "shelf.changed"
    spark.range(2).write.saveAsTable(table)
    sources.overwrite_table(spark.table(table).selectExpr("id", "'x' AS s"), table)
    assert spark.table(table).columns == ["id", "s"] and spark.table(table).count() == 2
    sources.overwrite_table(spark.range(7), table, "orc")
    assert spark.table(table).count() == 7 and _files_of(spark, table).pop().endswith(".orc")
    sources.append_table(spark.range(1), table, "orc")
    assert spark.table(table).count() == 8
    sources.drop_table(spark, table)
    assert not spark.catalog.tableExists(table) and not _files(spark, sources.tables._versions(spark, table))


def test_a_batch_that_comes_again_replaces_itself(spark):
    sources.ensure_layers(spark, ["shelf"])
    table = "shelf.batches"
    days = [datetime(2026, 9, d, 6, 0, tzinfo=UTC) for d in (20, 21)]
    names = [sources.batch_name(day) for day in days]
    assert names == sorted(names) and sources.batch_name(datetime(2026, 9, 20, 6, 0)) == names[0]
    for name, n in zip(names, (3, 4), strict=True):
        for _ in range(2):
            assert sources.append_batch(spark.range(n), table, name) == n
    assert spark.table(table).count() == 7 and sources.batches_of(spark, table) == names
    broken = spark.range(100, numPartitions=4).selectExpr("IF(id = 99, raise_error('killed'), id) AS id")
    with pytest.raises(Exception, match="killed"):
        sources.append_batch(broken, table, names[1])
    assert spark.table(table).count() == 7
    assert sources.append_batch(spark.range(0), table, names[0]) == 0
    assert spark.table(table).count() == 4 and sources.batches_of(spark, table) == names[1:]
    with pytest.raises(ValueError, match="extra"):
        sources.append_batch(spark.range(1).selectExpr("id", "1 AS extra"), table, names[1])


def test_a_rerun_of_an_ingestion_changes_nothing(spark, tmp_path):
    sources.ensure_layers(spark, ["shelf"])
    (tmp_path / "r.csv").write_text("id,v\n1,x\n2,y\n")
    for _ in range(2):
        assert sources.ingest_files(spark, str(tmp_path), {"r.csv": "shelf.rerun"}, MOMENT, batch=sources.batch_name(MOMENT)) == {"shelf.rerun": 2}
    rows = spark.table("shelf.rerun")
    assert rows.count() == 2 and rows.columns == ["id", "v", "ingestion_datetime", sources.BATCH]


@pytest.mark.parametrize("block", ["128", "64m"])
def test_lines_that_lose_fields_are_shown_with_their_numbers(spark, tmp_path, block):
    """Small blocks split a file over tasks; numbers go on across them."""
    files = {"a.csv": [], "b.csv": []}
    for name, lines in files.items():
        lines.append("id,title,score")
        for i in range(60):
            kinds = ['{0},"say ""a, b""",7', '{0},"broken, quote,8', "{0},ok,9,extra,,x", "{0},short", "", '{0},a,"x,y",', "{0},é ,"]
            lines.append(kinds[(i + len(name) + (name == "b.csv")) % 7].format(i))
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        found = sources.wide_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    wanted = set()
    for name, lines in files.items():
        for number, line in enumerate(lines, 1):
            fields = {"ex": 6, "br": 4, '"x': 4}.get(next((m for m in ("ex", "br", '"x') if m in line), ""), 0)
            if fields:
                wanted.add((name, number, fields, line))
    assert {(r["file"].rsplit("/", 1)[1], r["line_number"], r["fields"], r["line"]) for r in found} == wanted
    assert len(found) == len(wanted) > 40
    assert sources.wide_lines(spark, str(tmp_path), 6).count() == 0


def test_steps_side_by_side(spark):
    spark.sparkContext.setLocalProperty("lodestrata.test", "seen")
    steps = [lambda n=n: (spark.range(n).count(), spark.sparkContext.getLocalProperty("lodestrata.test")) for n in (3, 5, 7)]
    assert sources.side_by_side(spark, *steps) == [(3, "seen"), (5, "seen"), (7, "seen")]
    assert sources.side_by_side(spark) == []
    spark.sparkContext.setLocalProperty("lodestrata.test", None)
    done = []

    def fails():
        raise ValueError("one step")

    with pytest.raises(ValueError, match="one step"):
        sources.side_by_side(spark, fails, lambda: done.append(spark.range(2).count()))
    assert done == [2]


def test_few_files_are_spread_over_all_tasks(spark, tmp_path):
    path = str(tmp_path / "few")
    spark.range(1000, numPartitions=1).write.parquet(path)
    scan = spark.read.parquet(path)
    wide = sources.spread(scan)
    assert wide.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and wide.count() == 1000
    many = spark.range(1000, numPartitions=64)
    assert sources.spread(many) is many


def test_no_more_steps_run_at_once_than_asked_for(spark):
    running, most = [], []

    def step():
        running.append(1)
        most.append(len(running))
        spark.range(10).count()
        running.pop()

    sources.side_by_side(spark, *[step] * 6, at_once=2)
    assert len(most) == 6 and max(most) <= 2
