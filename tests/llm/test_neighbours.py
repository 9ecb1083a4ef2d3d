import numpy as np
import pytest

from lodestrata.llm import neighbours


def brute_force(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for q in sorted({i for i, _ in rows if i % 20 == 0}):
        for place in np.flatnonzero(ids == q):
            score = (x * x[place]).sum(axis=1)
            keep = ids != q
            order = np.lexsort((ids[keep], -score[keep]))[:k]
            out[q] = list(zip(ids[keep][order].tolist(), score[keep][order].tolist(), strict=True))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, rank string, list int")


def result_of(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(got) + 1
        got.append((r["vec_id"], r["score"]))
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 24)).astype(np.float32) * rng.uniform(0.2, 3, (3000, 1)).astype(np.float32)
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(100_000)[:3000], x, strict=True)]
    found, exact = result_of(neighbours.nearest_neighbours(table(spark, rows))), brute_force(rows, 20)
    assert found.keys() == exact.keys()
    hit = 0
    vectors = {i: np.array(v, dtype=np.float32).astype(np.float64) for i, v in rows}
    for q, got in found.items():
        assert len(got) == 20 and q not in {i for i, _ in got}
        assert [s for _, s in got] == sorted((s for _, s in got), reverse=True)
        for i, s in got:
            assert s == pytest.approx(float((vectors[q] * vectors[i]).sum()), rel=1e-12)
        hit += len({i for i, _ in got} & {i for i, _ in exact[q]})
    assert hit / (20 * len(found)) >= 0.9


def test_ties_copies_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    same = rng.normal(size=6).astype(np.float32).tolist()
    rows = [(i, same) for i in range(0, 600, 3)]
    rows += [(10_000 + i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(60)]
    odd = [
        (1, None), (2, []), (3, [0.0] * 6), (4, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (5, [float("nan")] + [1.0] * 5),
        (7, [float("inf")] + [1.0] * 5), (8, [1.0] * 5), (None, same), (20, [0.0] * 6), (60, same), (60, same),
    ]
    found = result_of(neighbours.nearest_neighbours(table(spark, rows + odd)))
    exact = brute_force(rows, 20)
    assert found.keys() == exact.keys()
    for q in exact:
        assert [i for i, _ in found[q]] == [i for i, _ in exact[q]]


def test_few_and_no_rows(spark):
    assert neighbours.nearest_neighbours(table(spark, [])).collect() == []
    assert neighbours.nearest_neighbours(table(spark, [(20, [1.0, 2.0])])).collect() == []
    assert neighbours.nearest_neighbours(table(spark, [(3, [1.0, 2.0]), (5, [1.0, 1.0])])).collect() == []
    few = result_of(neighbours.nearest_neighbours(table(spark, [(20, [1.0, 2.0]), (3, [1.0, 0.0]), (4, [-1.0, 0.0])])))
    assert few == {20: [(3, 1.0), (4, -1.0)]}


def test_a_list_cut_into_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 16)
    monkeypatch.setattr(neighbours, "QUERIES", 2)
    rng = np.random.default_rng(3)
    rows = [(i * 5, rng.normal(size=8).astype(np.float32).tolist()) for i in range(200)]
    found = result_of(neighbours.nearest_neighbours(table(spark, rows), recall=1.0))
    exact = brute_force(rows, 20)
    hit = sum(len({i for i, _ in found[q]} & {i for i, _ in exact[q]}) for q in exact)
    assert found.keys() == exact.keys() and hit / (20 * len(exact)) >= 0.95


def test_query_recall(spark):
    from lodestrata.llm.queries import QUERIES

    folder = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found, exact = result_of(QUERIES["op10_neighbours"](spark, folder)), brute_force(rows, 20)
    hit = sum(len({i for i, _ in found[q]} & {i for i, _ in exact[q]}) for q in exact)
    assert hit / (20 * len(exact)) >= 0.9
