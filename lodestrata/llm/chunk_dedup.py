"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of every whole text; a chunk ends where its top bits are zero, so cuts
follow the content: after an insertion the same chunks come again. Chunks are known by a 128-bit digest. A
digest that stands in more than one text is a repeated chunk; runs of repeated chunks in a text of at least
``LEAST_RUN`` characters are repeated passages.

Chunks are a table without text. Counting sums up per task before it is shuffled, and the repeated digests
(not the groups) return to their places by a join that Spark may split where a digest is frequent. Runs are
found per text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.names import own_names
from lodestrata.llm.words import pieces, text_bytes
from lodestrata.sources.staging import stage

#: Bytes of a chunk: smallest, largest; a cut comes about every 2 ** BITS bytes after the smallest.
SMALLEST, LARGEST, BITS = 24, 256, 5
#: Bytes that the rolling hash sees (its width in bits).
SEEN = 32
#: Characters of a run of repeated chunks that counts as a passage.
LEAST_RUN = 100

_GEAR = np.random.default_rng(97).integers(0, 1 << 32, 256, dtype=np.uint32)
_CHUNKS = "row long, id long, nth int, start int, end int, digest_a long, digest_b long"


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the hash ``h = (h << 1) + gear[byte]`` in 32 bits, which holds the last 32 bytes."""
    h = _GEAR[data]
    step = 1
    while step < SEEN:
        shifted = h.copy()
        shifted[step:] += h[:-step] << np.uint32(step)
        h, step = shifted, step * 2
    return h


def chunk_ends(data: np.ndarray, firsts: np.ndarray) -> list[list[int]]:
    """For each text its chunk ends, as places in ``data``. Cuts never part the bytes of a character.

    A text sees zero bytes before its start, so equal texts have equal chunks wherever they stand.
    """
    count = len(firsts) - 1
    sizes = np.diff(firsts)
    shift = np.repeat(np.arange(1, count + 1) * SEEN, sizes)
    padded = np.zeros(len(data) + (count + 1) * SEEN, dtype=np.uint8)
    padded[np.arange(len(data)) + shift] = data
    hashes = gear_hashes(padded)[np.arange(len(data)) + shift]
    starts_character = np.append((data & 0xC0) != 0x80, True)
    cuts = (np.flatnonzero(((hashes >> np.uint32(32 - BITS)) == 0) & starts_character[1:]) + 1).tolist()
    ends: list[list[int]] = []
    at = 0
    for first, last in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        own, start = [], first
        while last - start > SMALLEST:
            at = bisect_left(cuts, start + SMALLEST, at)
            end = min(start + LARGEST, last)
            if at < len(cuts) and cuts[at] < end:
                end = cuts[at]
            while not starts_character[end]:
                end += 1
            own.append(end)
            start = end
        if start < last:
            own.append(last)
        ends.append(own)
    return ends


def chunks(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per chunk ``row`` (a number of the text), ``id, nth, start, end`` (code points) and its digest.

    Chunks below the smallest size (what is left at the end of a text) are left out. To be staged, as row
    numbers come from the task.
    """
    frame = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    names = [column.split()[0] for column in _CHUNKS.split(", ")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, done = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            for first, texts in pieces(batch.column(1)):
                data, firsts = text_bytes(texts)
                ends = chunk_ends(data, firsts)
                counts = np.array([len(x) for x in ends], dtype=np.int64)
                end = np.array([x for own in ends for x in own], dtype=np.int64)
                row = np.repeat(np.arange(len(ends)), counts)
                nth = np.arange(len(end)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = np.where(nth == 0, firsts[:-1][row], np.append(0, end[:-1])[: len(end)])
                raw = data.tobytes()
                found = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                digests = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
                characters = np.append(0, np.cumsum((data & 0xC0) != 0x80))
                origin = characters[firsts[:-1]][row]
                big = (end - start) >= SMALLEST
                ids = batch.column(0).slice(first, len(texts)).take(pa.array(row[big]))
                columns = [
                    base + done + row, None, nth.astype(np.int32), (characters[start] - origin).astype(np.int32),
                    (characters[end] - origin).astype(np.int32), digests[:, 0], digests[:, 1],
                ]
                arrays = [ids if c is None else pa.array(c[big]) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names)
                done += len(texts)

    return frame.mapInArrow(task, _CHUNKS)


def repeated_passages(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST_RUN, within: bool = False
) -> DataFrame:
    """One row per repeated passage of a text: ``id, start, end`` (code points, end exclusive), ``n_chunks``,
    ``first_doc_id`` (the smallest id that holds its first chunk), ``places`` (the most places that one of its
    chunks stands in) and ``n_later`` (its characters that also stand in a text of smaller id, or earlier in
    the same text). A text without repeated passages gives no row. A chunk is repeated if it stands in more than
    one text, and with ``within`` also if it stands in one text several times.

    Missing and empty texts have no chunks. A row without id takes part, after all others. Rows that repeat
    are copies of each other. Other columns do not matter.
    """
    table = stage(chunks(docs, id, text))
    digest = ["digest_a", "digest_b"]
    repeated = (
        table.groupBy(*digest)
        .agg(
            F.count(F.lit(1)).alias("places"),
            F.min("id").alias("first_doc_id"),
            F.min("row").alias("_first_row"),
            F.max("row").alias("_last_row"),
        )
        .filter((F.col("places") > 1) & (F.lit(within) | (F.col("_first_row") != F.col("_last_row"))))
        .drop("_last_row")
    )
    of_text = Window.partitionBy("row").orderBy("nth")
    again = Window.partitionBy("row", *digest).orderBy("nth")
    length = F.col("end") - F.col("start")
    own = F.coalesce(F.col("id") == F.col("first_doc_id"), F.col("row") == F.col("_first_row"))
    placed = (
        table.join(repeated, digest)
        .withColumn("_later", ~own | (F.row_number().over(again) > 1))
        .withColumn("_run", F.col("nth") - F.row_number().over(of_text))
    )
    return (
        placed.groupBy("row", "_run")
        .agg(
            F.first("id").alias(id),
            F.min("start").cast("long").alias("start"),
            F.max("end").cast("long").alias("end"),
            F.count(F.lit(1)).alias("n_chunks"),
            F.min_by("first_doc_id", "nth").alias("first_doc_id"),
            F.max("places").alias("places"),
            F.sum(F.when(F.col("_later"), length).otherwise(0)).cast("long").alias("n_later"),
        )
        .filter(F.col("end") - F.col("start") >= least)
        .drop("row", "_run")
    )


@own_names
def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST_RUN, within: bool = False
) -> DataFrame:
    """The rows of ``docs`` with repeated passages cut out of the text where all of them stands in a text of
    smaller id or earlier in the same one. Ids must be distinct; a row without id stays as it is."""
    spans = (
        repeated_passages(docs, id, text, least, within)
        .filter(F.col("n_later") == F.col("end") - F.col("start"))
        .groupBy(F.col(id).alias("_id"))
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    )
    size = F.length(text)
    begins = F.concat(F.array(F.lit(0).cast("long")), F.col("_spans")["end"])
    ends = F.concat(F.col("_spans")["start"], F.array(size.cast("long")))
    kept = F.transform(
        F.arrays_zip(begins.alias("b"), ends.alias("e")),
        lambda s: F.substr(F.col(text), (s["b"] + 1).cast("int"), F.greatest(s["e"] - s["b"], F.lit(0)).cast("int")),
    )
    joined = docs.join(spans, F.col(id) == F.col("_id"), "left")
    cut = F.when(F.col("_spans").isNull(), F.col(text)).otherwise(F.array_join(kept, ""))
    return joined.withColumn(text, cut).select(*docs.columns)
