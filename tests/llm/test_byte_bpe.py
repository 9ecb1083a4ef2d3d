import base64
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from lodestrata.llm import byte_bpe, worker

PATH = public_tokenizers.path(byte_bpe.VOCABULARY)
PARTS = [
    "a", "b", "ab", " ", "  ", "\n", "\t", "é", "ß", "日本", "語", "😀", "'s", "'ll", "1", "22", "_", "!", "\x1c", "\x85",
    "　", " ", "​", "<|endoftext|>", "the", "ing", "Ö", "́", "Ⅷ", "²", "A", "====", "\r\n", "\x00", "٣",
]


@pytest.fixture(scope="module")
def library():
    pairs = (line.split() for line in open(PATH, "rb"))
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def mixed_texts(n=1500):
    rng = random.Random(3)
    return ["".join(rng.choices(PARTS, k=rng.randint(1, 60))) for _ in range(n)]


LONG = [" " * 500, "a" * 3000, "ab" * 1500, "日本語" * 400, "=" * 2000, "x" * 47, "y" * 48, "word " * 60_000]


def test_ids_as_the_library_gives_them(library):
    codec = byte_bpe.codec(PATH)
    texts = ["", None, *mixed_texts(), *LONG]
    ids = codec.encode(texts)
    assert ids.to_pylist() == [library.encode_ordinary(t or "") for t in texts]
    assert codec.decode(ids) == [(t or "").encode() for t in texts]


def test_words_are_forgotten_and_learned_again(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 20)
    codec = byte_bpe.Codec(PATH)
    for text in mixed_texts(60):
        assert codec.encode([text]).to_pylist() == [library.encode_ordinary(text)]


def test_lists_longer_than_a_decoding_slice(monkeypatch):
    codec = byte_bpe.codec(PATH)
    texts = ["one two three " * 50, "", "é" * 100, "tail"]
    ids = codec.encode(texts)
    monkeypatch.setattr(byte_bpe, "IDS", 7)
    assert codec.decode(ids) == [t.encode() for t in texts]


def test_rows(documents, library):
    texts = [None, "", "Hello  world's\n", "<|endoftext|> é😀", LONG[3], "same", "same"]
    docs = documents([(i if i else None, t) for i, t in enumerate(texts)])
    encoded = byte_bpe.encode(docs, PATH)
    assert sorted(encoded.columns) == sorted(docs.columns)
    by_text = {r["text"]: list(r["ids"]) for r in encoded.collect()}
    assert by_text == {t: library.encode_ordinary(t or "") for t in texts}
    decoded = byte_bpe.decode(encoded, PATH).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in decoded)
    rows = byte_bpe.round_trip(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"] or 0] or ""
        ids = library.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert byte_bpe.round_trip(documents([])).collect() == []


def test_query_against_the_library(spark, sf_dir, library):
    from lodestrata.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op4_byte_bpe"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_words_of_many_lengths_side_by_side_are_as_the_library_has_them(library):
    """Words of one query contract each at its own lowest pair: neighbours, first and last pairs included."""
    words = ["ab" * n + "c" * (n % 5) for n in range(1, 20)] + [f"x{n * 7919}y{n}" for n in range(300)] + ["aaa", "aaaa", "zzzzz"]
    codec = byte_bpe.Codec(PATH)
    assert codec.encode([" ".join(words), None, "", words[-1]]).to_pylist() == [
        library.encode_ordinary(" ".join(words)), [], [], library.encode_ordinary(words[-1])
    ]


def test_a_worker_lets_go_of_the_codec_for_other_operators():
    """Spark hands workers on: the vocabulary and its database must not stay beside what other operators need."""
    before = byte_bpe.codec(PATH)
    assert byte_bpe.codec(PATH) is before
    worker.let_go()
    assert not worker._kept
    assert byte_bpe.codec(PATH) is not before


def test_decoding_neither_joins_nor_sorts_ids():
    """An id finds its token by place; ids outside the vocabulary, negative ones too, give no bytes."""
    codec = byte_bpe.Codec(PATH)
    token = {rank: raw for raw, rank in codec.ranks.items()}
    lists = [[5, 300, 5], None, [], [99_999_999, 7, -1, -9], [50_000 % len(token)] * 400]
    expected = [b"".join(token.get(i, b"") for i in of_row or []) for of_row in lists]
    for most in (3, 1 << 18):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(byte_bpe, "IDS", most)
            assert codec.decode(pa.array(lists, pa.list_(pa.int32()))) == expected
    codec.db.register("ids", pa.table({"row": [0], "pos": [0], "id": [5], "places": [[6]]}))
    plan = codec.db.execute("EXPLAIN " + byte_bpe._DECODE).fetchall()[0][1].lower().replace("_", " ")
    assert "hash join" not in plan and "group by" not in plan, plan
