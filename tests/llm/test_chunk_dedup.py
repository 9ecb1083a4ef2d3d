import random

import numpy as np
import pyarrow as pa

from lodestrata.llm import chunk_dedup
from lodestrata.llm.words import text_bytes


def gear_by_hand(data):
    h, out = 0, []
    for byte in bytes(chunk_dedup.SEEN) + bytes(data):
        h = ((h << 1) + int(chunk_dedup._GEAR[byte])) & 0xFFFFFFFF
        out.append(h)
    return out[chunk_dedup.SEEN :]


def ends_by_hand(text):
    data = text.encode()
    hashes, ends, start = gear_by_hand(data), [], 0
    whole = lambda k: k == len(data) or (data[k] & 0xC0) != 0x80
    while len(data) - start > chunk_dedup.SMALLEST:
        end = start + chunk_dedup.SMALLEST
        while end < min(start + chunk_dedup.LARGEST, len(data)) and not (hashes[end - 1] >> (32 - chunk_dedup.BITS) == 0 and whole(end)):
            end += 1
        while not whole(end):
            end += 1
        ends.append(end)
        start = end
    return ends + ([len(data)] if start < len(data) else [])


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghiéßz日", k=rng.randint(2, 9))) for _ in range(n))


def test_cuts_against_one_byte_at_a_time():
    rng = random.Random(2)
    texts = [prose(rng, rng.randrange(0, 300)) for _ in range(40)] + ["", "a", "é" * 600, "x" * 1000, "日" * 8]
    data, firsts = text_bytes(pa.array(texts))
    for k, ends in enumerate(chunk_dedup.chunk_ends(data, firsts)):
        assert [e - firsts[k] for e in ends] == ends_by_hand(texts[k])


def test_cuts_resist_shifts():
    rng = random.Random(3)
    text = prose(rng, 400)
    data, firsts = text_bytes(pa.array([text, "inserted words " + text]))
    one, two = chunk_dedup.chunk_ends(data, firsts)
    raw = data.tobytes()
    pieces = [{raw[a:b] for a, b in zip([f, *own], own, strict=False)} for f, own in zip(firsts[:-1], (one, two), strict=True)]
    assert len(pieces[0] & pieces[1]) >= 0.9 * len(pieces[0])


def expected_places(rows):
    """Chunks by brute force: bytes of each to the places it stands in."""
    places = {}
    for row, (i, text) in enumerate(rows):
        start = 0
        raw = (text or "").encode()
        for nth, end in enumerate(ends_by_hand(text or "")):
            if end - start >= chunk_dedup.SMALLEST:
                places.setdefault(raw[start:end], []).append((i, row, nth, len(raw[:start].decode()), len(raw[:end].decode())))
            start = end
    return places


def test_passages_against_a_table_of_all_chunks(documents):
    rng = random.Random(5)
    passage, common = prose(rng, 70), prose(rng, 90)
    rows = [(i, f"{prose(rng, 40)} {passage if i % 5 == 0 else ''} {prose(rng, 60)} {common if i % 2 else ''}") for i in range(60)]
    rows += [(100, rows[3][1]), (101, passage + " " + passage), (102, None), (103, ""), (104, "short"), (104, "short"), (None, rows[8][1])]
    found = chunk_dedup.repeated_passages(documents(rows)).collect()
    repeated = {}
    for where in expected_places(rows).values():
        if len({p[1] for p in where}) > 1:
            for i, row, nth, start, end in where:
                repeated[row, nth] = (i, start, end, min((p[0] for p in where if p[0] is not None), default=None), len(where))
    runs = []
    for (row, nth), (i, start, end, first, places) in sorted(repeated.items()):
        if runs and runs[-1]["key"] == (row, nth - 1):
            runs[-1] |= {"key": (row, nth), "end": end, "n": runs[-1]["n"] + 1, "places": max(places, runs[-1]["places"])}
        else:
            runs.append({"key": (row, nth), "id": i, "start": start, "end": end, "first": first, "n": 1, "places": places})
    expected = [(r["id"], r["start"], r["end"], r["n"], r["first"], r["places"]) for r in runs if r["end"] - r["start"] >= chunk_dedup.LEAST_RUN]
    got = [(r["doc_id"], r["start"], r["end"], r["n_chunks"], r["first_doc_id"], r["places"]) for r in found]
    order = lambda rows: sorted(map(str, rows))
    assert order(got) == order(expected)
    ids = {r["doc_id"] for r in found}
    assert {i for i in range(0, 60, 5)} | {i for i in range(1, 60, 2)} | {100, 101, None, 3, 8} == ids
    by = {r["doc_id"]: r for r in found if r["doc_id"] == 100}
    assert by[100]["n_later"] == by[100]["end"] - by[100]["start"]
    assert all(r["n_later"] == 0 for r in found if r["doc_id"] == 0)


def test_texts_without_their_repeats(documents):
    rng = random.Random(7)
    passage = prose(rng, 80)
    rows = [(1, passage), (2, f"own start {passage} own end"), (3, "é unlike all others"), (4, None), (5, passage)]
    docs = documents(rows)
    out = chunk_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[1] == passage and texts[3] == "é unlike all others" and texts[4] is None
    assert texts[2].startswith("own start ") and texts[2].endswith(" own end") and len(texts[2]) < 0.6 * len(rows[1][1])
    assert len(texts[5]) < 30


def test_repeats_inside_one_text(documents):
    rng = random.Random(11)
    block = prose(rng, 60)
    docs = documents([(1, " ".join([block] * 4)), (2, prose(rng, 80))])
    assert chunk_dedup.repeated_passages(docs).collect() == []
    assert {r["doc_id"] for r in chunk_dedup.repeated_passages(docs, within=True).collect()} == {1}


def test_long_and_no_texts(documents):
    rng = random.Random(1)
    long = prose(rng, 60_000)
    found = chunk_dedup.repeated_passages(documents([(1, long), (2, long)])).collect()
    assert len(found) == 2 and all(len(long) - r["end"] < 40 and r["start"] == 0 for r in found)
    assert chunk_dedup.repeated_passages(documents([])).collect() == []
    assert np.array_equal(chunk_dedup.gear_hashes(np.zeros(0, dtype=np.uint8)), np.zeros(0, dtype=np.uint32))


def test_query_finds_copies(spark, sf_dir):
    from lodestrata.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    flagged = {r["doc_id"] for r in QUERIES["op6_chunk_dedup"](spark, sf_dir).collect()}
    seen = {}
    for i, text in rows:
        if len(text) >= 300:
            if text in seen:
                assert {i, seen[text]} <= flagged
            seen.setdefault(text, i)
