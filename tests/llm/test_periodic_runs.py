import hashlib
import random
import zlib

import numpy as np
import pytest

from lodestrata.llm import periodic_runs

SPACE = " \t\n\r\x0b\x0c"


def words_in(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in SPACE:
            words += [word] if word else []
            word = ""
        else:
            word += c
    return words


def brute_runs(words, least=24, repeats=3):
    found = set()
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, repeats * q):
                smaller = (d for d in range(1, q) if all(words[k] == words[k + d] for k in range(i, i + length - d)))
                if next(smaller, None) is None:
                    found.add((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_digest(id, text):
    words = words_in(text)
    h, n = (zlib.crc32(str(id).encode()) if id is not None else 1), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (id, len(runs), *four, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())



def periodic_text(rng):
    words = [f"w{rng.randrange(rng.choice([2, 9, 500]))}" for _ in range(rng.randrange(0, 90))]
    for _ in range(rng.randrange(0, 4)):
        unit = [f"w{rng.randrange(rng.choice([1, 2, 3, 50]))}" for _ in range(rng.randrange(1, 30))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (unit * rng.randrange(2, 9))[: rng.randrange(10, 160)]
    return "".join(w + rng.choice([" ", "\n", "\t ", "  "]) for w in words)


@pytest.mark.parametrize("least, repeats", [(24, 3), (6, 2), (10, 2), (5, 4), (1, 2)])
def test_runs_equal_brute_force(least, repeats):
    rng = random.Random(least * 10 + repeats)
    total = 0
    for _ in range(400):
        words = words_in(periodic_text(rng))
        numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
        got = periodic_runs.runs_of(np.array([numbers[w] for w in words], dtype=np.int64), least, repeats)
        assert got == brute_runs(words, least, repeats)
        total += len(got)
    assert total > 200


def test_digest_equals_brute_force_with_odd_rows(documents):
    rng = random.Random(4)
    rows = [(i, periodic_text(rng), "s") for i in range(300)]
    rows += [(300, None, None), (301, "", None), (302, " \n ", None), (7, "a b", None), (7, "a b", None)]
    rows += [(400 + i, "x " * n, None) for i, n in enumerate((23, 24, 25))]
    rows += [(500, " ".join(f"é{k % 8}" for k in range(24)), None), (501, "a b " * 30, None)]
    rows += [(600, " ".join(f"w{rng.randrange(3)}" for _ in range(3000)), None)]
    found = [tuple(r) for r in periodic_runs.digest(documents(rows)).collect()]
    assert sorted(found, key=str) == sorted((brute_digest(i, t) for i, t, _ in rows), key=str)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and t for i, t, _ in rows)
    assert periodic_runs.digest(documents([(None, "b " * 24, None)])).first()["n_runs"] == 1
    assert periodic_runs.digest(documents([])).collect() == []


def test_ties_of_the_strongest_run():
    assert periodic_runs.strongest([(0, 30, 10), (5, 24, 8), (50, 30, 10)]) == (0, 30, 10)
    assert periodic_runs.strongest([(0, 30, 10), (0, 60, 20), (90, 31, 10)]) == (90, 31, 10)
    assert periodic_runs.strongest([]) is None


def test_runs_and_collapsed_texts_beside_other_columns(documents):
    rows = [(1, "  start " + "ha " * 40 + "end\n"), (2, "as it\n is "), (3, None), (4, ""), (2, "as it\n is ")]
    docs = documents(rows).selectExpr("*", "5 AS _text", "6 AS start", "text AS original")
    out = periodic_runs.collapse_runs(docs)
    assert out.schema == docs.schema
    assert sorted((r["doc_id"], r["text"]) for r in out.collect() if r["text"] is not None) == [
        (1, "start ha end"), (2, "as it\n is "), (2, "as it\n is "), (4, ""),
    ]
    assert all(r["text"] == r["original"] or r["doc_id"] == 1 for r in out.collect())
    marked = {r["doc_id"]: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert [tuple(x) for x in marked[1]["runs"]] == [(1, 40, 1)] and marked[3]["runs"] == [] == marked[2]["runs"]
    assert marked[1]["_text"] == 5 and marked[1]["start"] == 6


@pytest.mark.parametrize("unit", [1, 7, 60_000])
def test_a_long_text_of_one_run(documents, unit):
    n = 200_000
    text = " ".join(f"w{k % unit}" for k in range(n))
    row = periodic_runs.periodic_runs(documents([(1, text)])).first()
    assert [tuple(x) for x in row["runs"]] == [(0, n, unit)]


def test_query_equals_brute_force(spark, sf_dir):
    from lodestrata.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, sf_dir).collect()]
    short = {r["doc_id"]: r["text"] for r in docs if len(words_in(r["text"])) < 600}
    assert len(found) == len(docs) and len(short) > 100
    assert {f for f in found if f[0] in short} == {brute_digest(i, t) for i, t in short.items()}
