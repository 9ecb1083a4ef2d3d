import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lodestrata.llm import jaccard_join
from lodestrata.llm.components import components


def sets_by_hand(text, words=3):
    w = (text or "").encode().lower().split()
    if len(w) >= words:
        return frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def components_by_hand(rows, percent=90):
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = sorted({(i, sets_by_hand(t)) for i, t in rows if i is not None}, key=lambda x: x[0])
    for k, _ in enumerate(nodes):
        parent[k] = k
    for k, (_, a) in enumerate(nodes):
        for j in range(k):
            b = nodes[j][1]
            common = len(a & b)
            if a and b and 100 * common >= percent * (len(a) + len(b) - common):
                x, y = find(k), find(j)
                parent[max(x, y)] = min(x, y)
    out = defaultdict(list)
    for k, (i, s) in enumerate(nodes):
        out[i, len(s)].append(nodes[find(k)][0])
    return out


def check(documents, rows):
    found = jaccard_join.jaccard_components(documents(rows)).collect()
    assert len(found) == len(rows)
    expected = components_by_hand(rows)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert r["component_id"] in expected[r["doc_id"], r["n_shingles"]]
    return found


def near_copies(rng, groups=6, size=25, words=120):
    rows, i = [], 0
    passage = " ".join(f"p{k}" for k in range(60))
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(60)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, 9)):
                at = rng.randrange(len(text))
                action = rng.randrange(3)
                if action == 0:
                    text[at] = f"n{rng.randrange(10**6)}"
                elif action == 1:
                    text.insert(at, f"n{rng.randrange(10**6)}")
                else:
                    del text[at]
            rows.append((i * 3 + 1, " ".join(text) + (f" {passage}" if rng.random() < 0.3 else "")))
            i += 1
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_components_against_all_pairs(documents, seed):
    rng = random.Random(seed)
    rows = near_copies(rng)
    rows += [(5000 + i, rows[3][1].upper()) for i in range(40)]
    rng.shuffle(rows)
    found = check(documents, rows)
    assert len({r["component_id"] for r in found}) < len(rows) - 40


def test_odd_rows(documents):
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two three"), (None, "one"),
        (None, None), (8, "É é"), (9, "é É"), (10, long), (11, long + " more"), (11, long + " more"), (12, "one two"),
        (4, "another text of the same id"), (13, "another text of the same id"), (-5, "one two three"),
    ]
    by = defaultdict(set)
    for r in check(documents, rows):
        by[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert by[1] == {(0, 1)} and by[2] == {(0, 2)} and by[7] == {(1, -5)} and by[5] == {(1, 4)} and by[11] == {(5001, 10)}
    assert by[None] == {(1, None), (0, None)}


def test_an_empty_table(documents):
    assert jaccard_join.jaccard_components(documents([])).collect() == []
    assert jaccard_join.one_of_each(documents([])).collect() == []


def test_one_of_each(documents):
    rows = [(3, "a b c d"), (1, "A b c d"), (1, "A b c d"), (2, ""), (4, None), (None, "a b c d"), (7, "other words stand here")]
    docs = documents(rows)
    kept = jaccard_join.one_of_each(docs)
    assert kept.schema == docs.schema
    assert sorted(((r["doc_id"] or 0), r["text"] or "") for r in kept.collect()) == [
        (0, "a b c d"), (1, "A b c d"), (2, ""), (4, ""), (7, "other words stand here"),
    ]


def test_possible_pairs_hold_every_link():
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in range(150)]
    texts = []
    for _ in range(60):
        words = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 6)):
            words[at] = f"x{rng.integers(10**6)}"
        texts.append(" ".join(words[: rng.integers(135, 151)]))
    shingles, firsts = jaccard_join.shingle_sets(pa.array(texts), 3, np.zeros(1 << jaccard_join.COUNTER_BITS, dtype=np.uint8))
    sets = [set(shingles[a:b].tolist()) for a, b in zip(firsts, firsts[1:], strict=False)]
    shapes = jaccard_join.small_shapes(shingles, firsts)
    entries = []
    for k, s in enumerate(sets):
        prefix = len(s) + (-90 * len(s)) // 100 + 1
        entries += [(int(shingles[firsts[k] + p]), len(s), p, k) for p in range(prefix)]
    entries.sort()
    token, n, pos, of = (np.array(x) for x in zip(*entries, strict=True))
    found = set()
    for k, j in jaccard_join._possible_pairs(token, n, pos, shapes[of], 90):
        found |= {tuple(sorted(p)) for p in zip(of[k].tolist(), of[j].tolist(), strict=True)}
    links = {
        (a, b) for a in range(60) for b in range(a + 1, 60)
        if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]) and sets[a] != sets[b]
    }
    assert links and links <= {p for p in found} | {p for p in links if sets[p[0]] == sets[p[1]]}


def test_shapes_never_differ_more_than_their_sets():
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 700))) for _ in range(60)]
    texts += [t + f" tail{k}" for k, t in enumerate(texts)]
    shingles, firsts = jaccard_join.shingle_sets(pa.array(texts), 3)
    sets = [set(shingles[a:b].tolist()) for a, b in zip(firsts, firsts[1:], strict=False)]
    n, small, large = np.diff(firsts), jaccard_join.small_shapes(shingles, firsts), jaccard_join.large_shapes(shingles, firsts).astype(int)
    k, j = (x.ravel() for x in np.meshgrid(np.arange(120), np.arange(120)))
    differ = jaccard_join._small_difference(n[k], n[j], small[k], small[j])
    for a, b, d in zip(k.tolist(), j.tolist(), differ.tolist(), strict=True):
        assert max(d, np.abs(large[a] - large[b]).sum()) <= len(sets[a] ^ sets[b])
    assert differ.max() > 20


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 99), (99, 98), (200, 201), (200, 202), (5, 5)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    by = {r["node"]: r["component"] for r in found}
    assert len(found) == len(by)
    assert all(by[i] == 0 for i in range(61)) and by[100] == by[99] == by[98] == 98 and by[202] == 200


def test_query_against_all_pairs(spark, sf_dir):
    from lodestrata.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = components_by_hand(rows)
    found = QUERIES["op5_jaccard_join"](spark, sf_dir).collect()
    assert len(found) == len(rows)
    assert all(r["component_id"] in expected[r["doc_id"], r["n_shingles"]] for r in found)
