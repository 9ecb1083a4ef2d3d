import hashlib
import random
import re

import pytest

from lodestrata.llm import spotsigs
from lodestrata.llm.spotsigs import ANCHORS, CHAIN, COMMON, PASSED


def signatures_by_hand(text):
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()) if w]
    common, out = set(ANCHORS) | set(COMMON), set()
    for i, word in enumerate(words):
        chain, passed = [], 0
        for other in words[i + 1 :] if word in ANCHORS else []:
            if other in common:
                passed += 1
                if passed > PASSED:
                    break
            else:
                chain.append(other)
                passed = 0
                if len(chain) == CHAIN:
                    out.add((word, *chain))
                    break
    if out or not text:
        return out
    if len(words) >= 3:
        return {tuple(words[k : k + 3]) for k in range(len(words) - 2)}
    return {tuple(words) or (text,)}


def like(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def prose(rng, n):
    return " ".join(rng.choice([rng.choice(ANCHORS), rng.choice(COMMON), f"Word{rng.randrange(40)}", f"é{rng.randrange(9)}."]) for _ in range(n))


def check(result, rows):
    ordered = sorted(((i is not None, i or 0, t or "") for i, t in rows))
    expected = []
    for k, (known, i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][2]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = map(signatures_by_hand, (text, edited, following))
        expected.append((known, i, len(text), hashlib.sha256(edited.encode()).hexdigest(), len(a), len(b), round(like(a, b), 9), round(like(a, c), 9)))
    found = [
        (r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"], len(r["fingerprint"].split()),
         len(r["edited_fingerprint"].split()), round(r["near_edited"], 9), round(r["near_next"], 9))
        for r in result
    ]
    assert sorted(found) == sorted(expected)


@pytest.mark.parametrize("seed", range(2))
def test_against_plain_sets(documents, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(-500, 5000), 150) + [2**62, -(2**62)]
    rows = [(i, prose(rng, rng.randrange(0, 80))) for i in ids]
    rows += [(6000, None), (6001, ""), (6002, "!!! ..."), (6003, "one two"), (6004, "plain words without any"), (None, "the one thing"), (None, None)]
    rows += [(7000, rows[3][1]), (7001, rows[3][1]), (7001, rows[3][1]), (7001, "the other text of an id here"), (8000, prose(rng, 30_000) + "😀")]
    result = spotsigs.fingerprint_edits(documents(rows)).collect()
    check(result, rows)
    by = {}
    for r in result:
        by.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by[7000] <= by[7001] and by[6001] == {""} and all(0 <= r["near_next"] <= 1 for r in result)


def test_one_and_no_document(documents):
    text = "the first thing and the second thing"
    check(spotsigs.fingerprint_edits(documents([(4, text)])).collect(), [(4, text)])
    assert spotsigs.fingerprint_edits(documents([])).collect() == []


def test_near_pairs_against_all_pairs(documents):
    rng = random.Random(9)
    rows = []
    for g in range(12):
        base = prose(rng, 150).split()
        for k in range(5):
            words = list(base)
            for _ in range(k * 2):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            rows.append((g * 10 + k, " ".join(words)))
    rows += [(1000, rows[0][1]), (1001, ""), (1002, None), (None, "the x y")]
    sets, first = {}, {}
    for i, t in rows:
        s = frozenset(signatures_by_hand(t or ""))
        if i is not None and s:
            first[s] = min(first.get(s, i), i)
    for s, i in first.items():
        sets[i] = s
    expected = {
        (a, b): like(sets[a], sets[b]) for a in sets for b in sets if a < b and like(sets[a], sets[b]) >= 0.8
    }
    found = {(r["a"], r["b"]): r["likeness"] for r in spotsigs.near_pairs(documents(rows)).collect()}
    assert expected and found == pytest.approx(expected)


def test_native(documents):
    plan = spotsigs.fingerprint_edits(documents([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_query_against_plain_sets(spark, sf_dir):
    from lodestrata.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(QUERIES["op2_spotsigs"](spark, sf_dir).collect(), rows)
