import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import labelled, line_crf, toxicity
from lodestrata.llm.words import LETTERS, words_of

INSULTS = ["vrednak", "glupson", "trashling"]


def clean_text(rng, n):
    return " ".join(f"w{rng.randrange(300)}{rng.choice(['', '', '.', ','])}" for _ in range(n))


def toxic_text(rng, n):
    words = clean_text(rng, n).split()
    for _ in range(2):
        words.insert(rng.randrange(len(words) + 1), rng.choice(INSULTS) + rng.choice(["", "en", "ig", "."]))
    return " ".join(words)


@pytest.fixture(scope="module")
def toxic_rows():
    rng = random.Random(6)
    return [(i, (toxic_text if i % 3 == 0 else clean_text)(rng, rng.randrange(3, 200)), int(i % 3 == 0)) for i in range(900)]


def test_toxicity_is_found_in_texts_not_learned_from(documents, spark, toxic_rows):
    rows = toxic_rows + [(2000, None, None), (2001, "", None), (2001, "", None), (None, "w1 vrednak", None), (2002, "w5 " * 60_000 + "glupson", None)]
    docs = documents([(i, t, "s") for i, t, _ in rows])
    labels = spark.createDataFrame(
        [(i, y) for i, _, y in toxic_rows] + [(2000, None), (None, 1), (2001, 0)], "doc_id long, toxic int"
    )
    result = toxicity.classify(docs, labels)
    assert set(docs.columns) <= set(result.columns)
    found = result.collect()
    assert len(found) == len(rows)
    truth = {i: y for i, _, y in toxic_rows}
    for r in found:
        expected = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == expected and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.3)
    held = [(truth[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([p for y, p in held if y]) > 0.95
    assert np.mean([p for y, p in held if not y]) < 0.05
    by = {r["doc_id"]: r["score"] for r in found}
    assert by[2002] >= 0.3 and by[2000] == by[2001] < 0.3


def test_without_labels_the_score_is_a_constant(documents, spark):
    docs = documents([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert len({r["score"] for r in toxicity.classify(docs, none).collect()}) == 1
    assert len({r["score"] for r in line_crf.classify(docs, none).collect()}) == 1
    assert toxicity.classify(documents([]), none).collect() == line_crf.classify(documents([]), none).collect() == []


def test_windows_cover_every_word():
    firsts = np.array([0, 0, 1, 16, 33, 90])
    start, end, of = toxicity.windows(firsts)
    for text in range(5):
        covered = {k for a, b, o in zip(start, end, of, strict=True) if o == text for k in range(a, b)}
        assert covered == set(range(firsts[text], firsts[text + 1]))
    assert (end - start <= toxicity.LENGTH).all() and (np.bincount(of) >= 1).all()


def test_gradients_against_differences():
    net = toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    f = rng.normal(size=(9, 2 * (toxicity.VECTOR + 1)))
    index = rng.integers(0, 9, (toxicity.LENGTH, 5))
    present = np.arange(toxicity.LENGTH)[:, None] < np.array([16, 7, 1, 16, 10])
    y, importance = np.array([1.0, 0, 1, 0, 1]), np.array([1.0, 1, 0.5, 1, 2])

    def loss():
        logit = net.forward(f, index, present)
        return (importance * (np.log1p(np.exp(logit)) - y * logit)).mean()

    g, d_f = net.gradients(f, index, present, y, importance)
    for name in ("score", "look", "pick", "inf", "recb", "in0f", "recf"):
        values = net.p[name].reshape(-1)
        for k in range(0, len(values), max(1, len(values) // 4)):
            old = values[k]
            values[k] = old + 1e-3
            up = loss()
            values[k] = old - 1e-3
            down = loss()
            values[k] = old
            assert g[name].reshape(-1)[k] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-4), name
    old = f[2, 3]
    f[2, 3] = old + 1e-3
    up = loss()
    f[2, 3] = old - 1e-3
    assert d_f[2, 3] == pytest.approx((up - loss()) / 2e-3, rel=0.05, abs=2e-4)


def test_scores_do_not_depend_on_the_slice(toxic_rows):
    net = toxicity.train([t for _, t, _ in toxic_rows[:200]], [y for _, _, y in toxic_rows[:200]], 0.3, epochs=2)
    texts = pa.array([t for _, t, _ in toxic_rows[:40]] + [None, ""])
    together = net.probabilities(texts)
    alone = [net.probabilities(texts.slice(k, 1))[0] for k in range(len(texts))]
    assert together == pytest.approx(alone, abs=1e-4)


def test_words():
    texts = ["a b  c", None, "", "  x", "y ", "ABC abc\tq", "é à", "z"]
    found = words_of(pa.array(texts))
    words = [bytes(found.data[a:b]) for a, b in zip(found.starts, found.ends, strict=True)]
    assert words == [w for t in texts for w in (t or "").encode().lower().split()]
    assert np.diff(found.firsts).tolist() == [len((t or "").split()) for t in texts]
    assert len(set(found.hashes.tolist())) == len(set(words))
    assert len(words_of(pa.array(["it's, né-e 5"]), LETTERS).starts) == 5


# --- quality ------------------------------------------------------------------------------------------


def quality_text(rng, good, lines):
    if good:
        return "\n".join(" ".join(f"The{rng.randrange(99)} of and word{rng.randrange(99)}".split()) + "." for _ in range(lines))
    kind = rng.choice(["menu", "shout", "again"])
    if kind == "menu":
        return "\n".join(" | ".join(f"Item{rng.randrange(99)}" for _ in range(8)) for _ in range(lines))
    if kind == "shout":
        return "\n".join(" ".join(f"BUY{rng.randrange(99)}!!" for _ in range(8)) for _ in range(lines))
    return "\n".join(f"spam{rng.randrange(99)} " * 12 for _ in range(lines))


def test_quality_of_texts_not_learned_from(documents, spark):
    rng = random.Random(8)
    truth = {i: int(i % 4 != 0) for i in range(700)}
    rows = [(i, quality_text(rng, y, rng.randrange(1, 20)), "s") for i, y in truth.items()]
    rows += [(2000, None), (2001, ""), (2002, "\n\n\n"), (2002, "\n\n\n"), (None, "x"), (2003, quality_text(rng, 1, 20_000))]
    labels = spark.createDataFrame(list(truth.items()), "doc_id long, quality int")
    found = line_crf.classify(documents(rows), labels).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [truth[r["doc_id"]] == r["predicted"] for r in found if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 150 and np.mean(held) > 0.97
    by = {r["doc_id"]: r["score"] for r in found}
    assert by[2000] == by[2001] and by[2003] > 0.5


def test_marginals_against_all_labelings():
    rng = np.random.default_rng(1)
    field = line_crf.Field(np.zeros(line_crf.FEATURES), np.ones(line_crf.FEATURES), np.zeros(line_crf.FEATURES), rng.normal(size=(2, 2)))
    good, firsts = rng.normal(size=11), np.array([0, 4, 5, 11])
    forward, backward = field.messages(good, firsts)
    both = forward + backward
    found = 1 / (1 + np.exp(both[:, 0] - both[:, 1]))
    for a, b in zip(firsts, firsts[1:], strict=False):
        n = b - a
        total, ones = 0.0, np.zeros(n)
        for code in range(1 << n):
            y = [code >> k & 1 for k in range(n)]
            weight = np.exp(sum(good[a + k] * y[k] for k in range(n)) + sum(field.moves[y[k], y[k + 1]] for k in range(n - 1)))
            total += weight
            ones += weight * np.array(y)
        assert found[a:b] == pytest.approx(ones / total)


def test_lines_and_their_features():
    lines = line_crf.lines_of(pa.array(["a b\nA! A!\n", None, "", "x"]))
    assert np.diff(lines.firsts).tolist() == [3, 1, 1, 1]
    assert lines.weight.tolist() == [4, 6, 1, 1, 1, 2]
    own = {name: lines.features[:, k].tolist() for k, name in enumerate(line_crf.OWN)}
    assert own["upper"][:2] == [0, 2 / 5] and own["same_as_before"][:3] == [0, 0.5, 0] and own["distinct"][1] == 0.5
    assert own["common"][0] == 0.5 and own["odd_last"][1] == 1 and own["upper_first"][1] == 1
    again = line_crf.lines_of(pa.array(["one two\nother\nONE two", "one two"])).features[:, line_crf.OWN.index("again_in_text")]
    assert again.tolist() == [1, 0, 1, 0]


@pytest.mark.parametrize(("query", "label", "good"), [("op7_toxicity", "toxic", 0.8), ("op9_line_crf", "quality", 0.9)])
def test_queries_on_held_out_rows(spark, query, label, good):
    from lodestrata.llm.queries import QUERIES

    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(truth[r["doc_id"]], r["predicted"]) for r in QUERIES[query](spark, folder).collect() if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([p == y for y, p in held]) > 0.95
    assert np.mean([p for y, p in held if y]) > good


def test_rows_that_repeat_an_id_push_out_no_others(documents, spark, toxic_rows):
    """A third of all rows under one id: the same sample, the same model."""
    some = toxic_rows[:120]
    labels = spark.createDataFrame([(i, y, y) for i, _, y in some], "doc_id long, toxic int, quality int")
    rows = [(i, t, "s") for i, t, _ in some]
    repeated = rows + [(1, rows[1][1] + " zz", "s")] * 60
    for model in (toxicity, line_crf):
        plain, again = (model.fit(documents(r), labels, sample=40) for r in (rows, repeated))
        assert plain.slope == again.slope and plain.offset == again.offset
    sample, share = labelled.labelled_sample(documents(repeated), labels, "doc_id", "text", "toxic", 40, toxicity.held_out)
    found = sample.collect()
    assert len(found) == len({r["_id"] for r in found}) <= 80 and {r["_label"] for r in found} == {0, 1}
    assert 0 < share < 1


def test_training_sees_a_bounded_part_of_a_long_text(documents, spark, monkeypatch):
    monkeypatch.setattr(labelled, "LONGEST", 10)
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    sample, _ = labelled.labelled_sample(documents([(1, "x" * 50, "s")]), labels, "doc_id", "text", "toxic", 5, lambda _: F.lit(False))
    assert [r["_text"] for r in sample.collect()] == ["x" * 10]


@pytest.mark.parametrize("model", [toxicity, line_crf])
def test_training_sees_whole_texts(documents, spark, monkeypatch, model):
    """What tells the labels apart stands after more characters than a bounded sample holds."""
    monkeypatch.setattr(labelled, "LONGEST", 10)
    seen = []
    monkeypatch.setattr(model, "trained_in_task", lambda rows, train: seen.extend(rows.collect()))
    tail = "\n".join(f"line {k}" for k in range(60_000))
    rows = [(i, f"same {tail} end of {i}", "s") for i in range(4)]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(4)], "doc_id long, toxic int, quality int")
    model.fit(documents(rows), labels)
    held = {r["doc_id"] for r in documents(rows).filter(model.held_out("doc_id")).collect()}
    texts = {r["_id"]: r["_text"] for r in seen}
    assert len(tail) > 200_000 and texts == {i: t for i, t, _ in rows if i not in held} and texts
