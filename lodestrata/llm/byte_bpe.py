"""Byte-level BPE encoding and decoding by relational steps.

Each task splits its texts into words by the vocabulary's pattern. Words it does not remember are encoded
by a recursive DuckDB query: rows of (word, position, token) join the table of merges, and each step
contracts the leftmost pair of lowest rank of every word, until no word has a pair that merges. Ids are
decoded by picking their tokens from the vocabulary as a list, strung together in the order of the ids.

A long word (a run of one character, a text without spaces) has as many steps as merges. There a step
contracts all places of the word's lowest pair, from the left, without overlaps. That equals one place at a
time as long as the new token cannot at once be part of a pair of lower rank; for the tokens that could,
only the leftmost place is contracted.

The queries run inside a task, in memory, on bounded slices: new words of a batch of rows for encoding, a
fixed number of ids for decoding. A text is never cut.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.llm.names import own_names
from lodestrata.llm.worker import kept

VOCABULARY = "byte_bpe_50k.tiktoken"
#: White space of the splitting pattern by code point: the Unicode property, whatever the regex library adds.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Bytes of text encoded at once, bytes of new words in one recursive query, encoded words a worker
#: remembers, ids in one decoding query.
SLICE_BYTES, WORD_BYTES, REMEMBERED, IDS = 1 << 21, 1 << 18, 150_000, 1 << 18

#: From this many bytes on a word is long.
LONG = 48

_WORDS = """
WITH RECURSIVE parts(word, pos, token, done) AS (
    SELECT word, pos, token, false FROM start
    UNION ALL
    SELECT * FROM (
        WITH pairs AS (
            SELECT word, pos, token, lead(token) OVER w AS following, lead(word) OVER w AS of_word,
                lag(pos) OVER w AS previous
            FROM parts WHERE NOT done WINDOW w AS (ORDER BY pos)
        ),
        lowest AS (
            SELECT p.word, min(m.high | p.pos) AS best
            FROM pairs p JOIN merges m ON m.pair = (p.token::BIGINT << 32 | p.following)
            WHERE p.word = p.of_word
            GROUP BY p.word
        )
        SELECT p.word, p.pos,
            CASE WHEN p.pos = l.best & 4294967295 THEN (l.best >> 32)::INTEGER ELSE p.token END,
            l.best IS NULL
        FROM pairs p LEFT JOIN lowest l ON l.word = p.word
        WHERE l.best IS NULL OR p.previous IS NULL OR p.previous <> l.best & 4294967295
    )
)
SELECT word, token FROM parts WHERE done ORDER BY pos
"""

_LONG_WORDS = """
WITH RECURSIVE parts(word, pos, token, done) AS (
    SELECT word, pos, token, false FROM start
    UNION ALL
    SELECT word, pos, CASE WHEN chosen THEN merged ELSE token END, low IS NULL
    FROM (
        SELECT *, coalesce(lag(chosen) OVER (PARTITION BY word ORDER BY pos), false) AS swallowed
        FROM (
            SELECT *, coalesce(merged = low AND (nth = 1 OR NOT careful) AND (
                row_number() OVER (PARTITION BY word, place - nth, merged = low ORDER BY pos)) % 2 = 1, false)
                AS chosen
            FROM (
                SELECT *, row_number() OVER (PARTITION BY word, merged = low ORDER BY pos) AS nth
                FROM (
                    SELECT p.*, m.merged, m.careful, min(m.merged) OVER (PARTITION BY word) AS low
                    FROM (
                        SELECT word, pos, token, lead(token) OVER w AS following, row_number() OVER w AS place
                        FROM parts WHERE NOT done WINDOW w AS (PARTITION BY word ORDER BY pos)
                    ) p LEFT JOIN merges m ON m.pair = (p.token::BIGINT << 32 | p.following)
                )
            )
        )
    )
    WHERE NOT swallowed
)
SELECT word, token FROM parts WHERE done ORDER BY pos
"""

# Bytes are held as the characters of the same number. The vocabulary is one row, so an id finds its token by its
# place in a list, and the tokens of a row are strung together in the order of its ids, without a join or a sort.
_DECODE = """
SELECT i.row, array_to_string(list_select(v.tokens, i.places), '')
FROM ids i CROSS JOIN vocabulary v
ORDER BY i.row
"""


def splitting_pattern(pattern: str = public_tokenizers.PATTERN) -> regex.Pattern:
    """The vocabulary's pattern with its white space spelled out."""
    inside = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]")
    return regex.compile(inside.replace(r"\s", f"[{SPACE}]"))


def latin_pattern(pattern: str = public_tokenizers.PATTERN) -> re.Pattern:
    """The same for texts of the first 256 characters, for the faster library."""

    def members(classes: str) -> str:
        found = [chr(i) for i in range(256) if unicodedata.category(chr(i))[0] == classes]
        return "".join(map(re.escape, found))

    spelled = splitting_pattern(pattern).pattern
    for name, classes in ((r"\p{L}", "L"), (r"\p{N}", "N")):
        spelled = spelled.replace(rf" ?{name}+", f" ?[{members(classes)}]+").replace(name, members(classes))
    return re.compile(spelled.replace(SPACE, r"\t-\r \x85\xa0"))


class Codec:
    """One vocabulary, and an in-memory database with its merges; lives in one worker process."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.find, self.find_latin = splitting_pattern().findall, latin_pattern().findall
        self.known: dict[str, bytes] = {}  # the ids of a word, four bytes each
        self.older: dict[str, bytes] = {}
        merges = [
            (self.ranks[token[:i]], self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items()
            for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        a, b, merged = (np.array(x, dtype=np.int32) for x in zip(*merges, strict=True))
        careful = np.isin(merged, np.concatenate([a[merged < a], b[merged < b]]))
        characters: list[str | None] = [None] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            characters[rank] = token.decode("latin-1")
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        tables = {
            "merges": pa.table(
                {
                    "pair": a.astype(np.int64) << 32 | b,
                    "merged": merged,
                    "high": merged.astype(np.int64) << 32,
                    "careful": careful,
                }
            ),
            "vocabulary": pa.table({"tokens": pa.array([characters])}),
        }
        for name, rows in tables.items():
            self.db.register("incoming", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM incoming")
            self.db.unregister("incoming")

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.find(text)
        return self.find_latin(text)

    def learn(self, words: Iterable[str]) -> None:
        """Encode words that are not remembered; one query for about ``WORD_BYTES`` bytes of words."""
        waiting: dict[bool, list[tuple[str, bytes]]] = {False: [], True: []}
        sizes = {False: 0, True: 0}
        for word in words:
            raw = word.encode()
            if raw in self.ranks:
                self.known[word] = self.ranks[raw].to_bytes(4, "little")
                continue
            long = len(raw) >= LONG
            waiting[long].append((word, raw))
            sizes[long] += len(raw)
            if sizes[long] >= WORD_BYTES:
                self._contract(waiting[long], long)
                waiting[long], sizes[long] = [], 0
        for long, new in waiting.items():
            if new:
                self._contract(new, long)

    def _contract(self, new: list[tuple[str, bytes]], long: bool) -> None:
        lengths = np.array([len(raw) for _, raw in new])
        data = np.frombuffer(b"".join(raw for _, raw in new), dtype=np.uint8)
        word = np.repeat(np.arange(len(new), dtype=np.int32), lengths)
        pos = np.arange(len(data), dtype=np.int32)
        self.db.register("start", pa.table({"word": word, "pos": pos, "token": self.single[data]}))
        answer = self.db.execute(_LONG_WORDS if long else _WORDS).fetchnumpy()
        self.db.unregister("start")
        ids = answer["token"].astype("<i4").tobytes()
        ends = np.cumsum(np.bincount(answer["word"], minlength=len(new))) * 4
        for (name, _), start, end in zip(new, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            self.known[name] = ids[start:end]

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        """The ids of each text; a missing text has none."""
        words = [self.split(text) if text else [] for text in texts]
        if len(self.known) > REMEMBERED:  # words not met again since the last time are forgotten
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missed = set().union(*words).difference(known)
        known.update((word, older[word]) for word in missed if word in older)
        self.learn(word for word in missed if word not in older)
        found = [b"".join(map(known.__getitem__, of_text)) for of_text in words]
        ends = np.cumsum([0, *map(len, found)]) // 4
        ids = np.frombuffer(b"".join(found), dtype="<i4")
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))

    def decode(self, ids: pa.ListArray) -> list[bytes]:
        """The bytes of each list of ids; a missing list gives no bytes."""
        lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        places = np.maximum(ids.flatten().to_numpy() + 1, 0)  # counted from 1; no token has the place 0
        out = [b""] * len(ids)
        for start in range(0, len(places), IDS):
            part = places[start : start + IDS]
            # Rows with ids in this part; of the first and the last one perhaps only some.
            first, last = np.searchsorted(ends, [start, start + len(part) - 1], side="right")
            bounds = np.concatenate([[0], np.minimum(ends[first : last + 1] - start, len(part))])
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(part))
            self.db.register("ids", pa.table({"row": np.arange(first, last + 1), "places": lists}))
            for place, text in self.db.execute(_DECODE).fetchall():
                out[place] += (text or "").encode("latin-1")  # a list that began in the part before goes on
            self.db.unregister("ids")
        return out


def codec(path: str) -> Codec:
    return kept(("byte_bpe", path), lambda: Codec(path))


def _slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``most`` bytes or ids in a column, or of one row that has more."""
    values = batch.column(column)
    length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    ends = np.cumsum(pc.fill_null(length(values), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, before = 0, 0
    while start < len(values):
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, end - start)
        start, before = end, int(ends[end - 1])


def _added(docs: DataFrame, added: dict[str, T.DataType], column: str, make, most: int) -> DataFrame:
    """``docs`` with columns that ``make(array)`` gives for another one, a slice of rows at a time.

    The other one is taken out if it is named ``_from``.
    """
    plain = docs.drop(*added, "_from")
    frame = docs.select(*plain.columns, F.col(column).alias("_from"))
    names = [*plain.columns, *added]
    place = len(plain.columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, place, most):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *make(part.column(place))], names)

    fields = [T.StructField(name, kind) for name, kind in added.items()]
    return frame.mapInArrow(task, T.StructType([*plain.schema.fields, *fields]))


IDS_TYPE = T.ArrayType(T.IntegerType())


@own_names
def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with the ids of the whole text (``array<int>``), as ranks of the vocabulary file ``path``.

    ``path`` must be readable on every executor. A missing or empty text has an empty array. Text that looks
    like a special token is ordinary text. A column that is already named ``ids`` is replaced.
    """
    make = lambda texts: [codec(path).encode(texts.to_pylist())]
    return _added(docs, {ids: IDS_TYPE}, text, make, SLICE_BYTES)


@own_names
def decode(rows: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The rows with the bytes of their ids (``binary``); missing or empty ids give no bytes."""
    make = lambda lists: [pa.array(codec(path).decode(lists), pa.binary())]
    return _added(rows, {decoded: T.BinaryType()}, ids, make, IDS)


@own_names
def encode_decode(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``decode(encode(docs))`` with one worker, and so one database, per task instead of two."""

    def make(texts: pa.Array) -> list[pa.Array]:
        encoded = codec(path).encode(texts.to_pylist())
        return [encoded, pa.array(codec(path).decode(encoded), pa.binary())]

    return _added(docs, {ids: IDS_TYPE, decoded: T.BinaryType()}, text, make, SLICE_BYTES)


def round_trip(docs: DataFrame, path: str | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of the decoded bytes."""
    path = path or public_tokenizers.path(VOCABULARY)
    both = encode_decode(docs.select(F.col(id).alias("doc_id"), F.col(text).alias("_from")), path, "_from")
    return both.select(
        F.col("doc_id").alias(id),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
