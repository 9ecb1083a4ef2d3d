"""Document fingerprints by SpotSigs, as DataFrame expressions only.

A spot is a common word (an anchor). Its signature is the anchor followed by the next ``CHAIN`` content
words, passing over other common words. A fingerprint is the set of a text's distinct signatures, each as a
32-bit hash, in order. Common words carry the prose of a text, so menus, tables and notices hardly count; a
text with no anchor at all takes every run of three words instead, and a shorter one itself.

Two fingerprints are compared by Jaccard likeness. The smaller size over the larger one bounds it from
above, so ``likeness`` with a least value leaves out pairs that cannot reach it, and ``near_pairs`` deals
fingerprints to partitions by length such that only neighbouring partitions can match.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.operators.keys import dense_key

# Anchors and further common words of four languages.
ANCHORS = (
    "the a an is was that of to and "
    "der die das ein eine ist und zu "
    "le la les un une est de et "
    "el los las una es que con por"
).split()
COMMON = (
    "are be been as at by for from has have he her his in it its not on or she their they this were which with you "
    "auf aus bei dem den des er für im in mit nicht sich sie von wie "
    "au avec ce dans des du elle en il ne pas pour qui se son sur "
    "al como del en la lo más no para se su sus y"
).split()

#: Content words of a signature, common words that may be passed over before each of them.
CHAIN, PASSED = 2, 6
#: Documents whose ids have the same quotient by this number look for their next document together.
BLOCK = 64

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPOT, _PASS = "\x01", "\x02"
_SKIP = rf"(?: [{_SPOT}{_PASS}][^ ]+){{0,{PASSED}}}"
_CONTENT = rf" [^{_SPOT}{_PASS} ][^ ]*"
_SIGNATURE = rf"{_SPOT}(?=([^ ]+{(_SKIP + _CONTENT) * CHAIN}))"
_THREE_WORDS = r"(?<= )(?=([^ ]+ [^ ]+ [^ ]+))"


def marked_words(text: Column) -> Column:
    """The words of a text between single spaces, with a mark before anchors and before other common words."""
    words = F.filter(F.split(F.lower(text), NO_WORD), lambda w: w != "")
    mark = lambda w: (
        F.when(w.isin(ANCHORS), F.concat(F.lit(_SPOT), w)).when(w.isin(COMMON), F.concat(F.lit(_PASS), w)).otherwise(w)
    )
    return F.concat(F.lit(" "), F.array_join(F.transform(words, mark), " "))


def _hashed(chains: Column) -> Column:
    """Distinct 32-bit hashes in order; marked words inside a chain were passed over and do not count."""
    content = lambda chain: F.regexp_replace(chain, f" [{_SPOT}{_PASS}][^ ]+", "")
    return F.array_sort(
        F.array_distinct(F.transform(chains, lambda c: F.shiftright(F.xxhash64(content(c)), 32).cast("int")))
    )


def with_signatures(df: DataFrame, text: str, output: str) -> DataFrame:
    """``df`` with the signatures of a text column (``array<int>``). A missing text counts as empty and has none."""
    whole = F.coalesce(F.col(text), F.lit(""))
    marked = df.withColumn("_marked", marked_words(whole))
    spots = marked.withColumn("_chains", F.regexp_extract_all("_marked", F.lit(_SIGNATURE), F.lit(1)))
    runs = F.regexp_extract_all("_marked", F.lit(_THREE_WORDS), F.lit(1))
    unmarked = F.translate("_marked", _SPOT + _PASS, "")
    chains = (
        F.when(F.size("_chains") > 0, F.col("_chains"))
        .when(unmarked.rlike(r"^ [^ ]+ [^ ]+ [^ ]+"), F.transform(runs, lambda c: F.translate(c, _SPOT + _PASS, "")))
        .when(whole != "", F.array(F.concat(unmarked, F.when(F.length(unmarked) < 2, whole).otherwise(""))))
        .otherwise(F.array().cast("array<string>"))
    )
    return spots.withColumn("_chains", chains).withColumn(output, _hashed(F.col("_chains"))).drop("_marked", "_chains")


def as_text(signatures: str) -> Column:
    """A fingerprint as text: its signatures in eight hexadecimal digits each."""
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")), " ")


def likeness(a: str, b: str, least: float = 0.0) -> Column:
    """Jaccard likeness of two sets; 0 without a look at them if their sizes cannot reach ``least``.

    Two empty sets are alike (1), an empty and a full one are not (0).
    """
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, 1.0)
        .when((small == 0) | (small < F.lit(least) * large), 0.0)
        .otherwise(common / (small + large - common))
    )


def _with_next(rows: DataFrame) -> DataFrame:
    """``_id, _text, _signatures`` with the text and signatures of the next row by id, the last with the first's.

    Neighbours lie in one block but for the last of a block, which gets the first of the next block: a
    fraction of the rows is looked up, and texts are shuffled once. Rows without id come first; rows of one
    id are ordered by text.
    """
    first_block = -(1 << 63)
    blocked = rows.withColumn("_block", F.coalesce(F.floor(F.col("_id") / BLOCK).cast("long"), F.lit(first_block)))
    ranks = dense_key(blocked.select("_block").distinct(), ["_block"], "_rank", stored=True)
    blocks = ranks.count()
    before = ranks.select(
        F.col("_block").alias("_first_of"),
        F.when(F.col("_rank") == 1, blocks).otherwise(F.col("_rank") - 1).alias("_rank"),
    ).join(ranks, "_rank")
    order = Window.partitionBy("_block").orderBy("_id", "_text")
    columns = ["_text", "_signatures"]
    near = blocked.select(
        "*",
        F.lead(F.lit(True)).over(order).alias("_inside"),
        F.lag(F.lit(True)).over(order).alias("_after"),
        *(F.lead(c).over(order).alias(f"_next{c}") for c in columns),
    )
    firsts = (
        near.filter(F.col("_after").isNull())
        .select(F.col("_block").alias("_first_of"), *(F.col(c).alias(f"_first{c}") for c in columns))
        .join(before, "_first_of")
        .drop("_first_of", "_rank")
    )
    joined = near.join(firsts, "_block", "left")
    return joined.select(
        "_id", *columns,
        *(F.when(F.col("_inside"), F.col(f"_next{c}")).otherwise(F.col(f"_first{c}")).alias(f"_next{c}") for c in columns),
    )


def fingerprint_edits(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_signatures``.

    The edited text has its last half (rounded down) replaced by as many first characters of the next
    document by id, after the last one the first. A missing text is empty; empty texts have empty
    fingerprints. Rows without id come first, rows of one id are ordered by text. An empty table gives an
    empty result; other columns do not matter.
    """
    rows = docs.select(F.col(id).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    near = _with_next(with_signatures(rows, "_text", "_signatures"))
    n = F.length("_text")
    half = F.floor(n / 2).cast("int")
    edited = near.select(
        "_id", "_signatures", "_next_signatures", n.cast("long").alias("n_chars"),
        F.concat(F.substr("_text", F.lit(1), n - half), F.substr("_next_text", F.lit(1), half)).alias("_edited"),
    )
    both = with_signatures(edited, "_edited", "_edited_signatures")
    return both.select(
        F.col("_id").alias(id),
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        as_text("_signatures").alias("fingerprint"),
        as_text("_edited_signatures").alias("edited_fingerprint"),
        likeness("_signatures", "_edited_signatures").alias("near_edited"),
        likeness("_signatures", "_next_signatures").alias("near_next"),
        F.size("_signatures").cast("long").alias("n_signatures"),
    )


def near_pairs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """``a, b, likeness`` of all pairs of different fingerprints with a likeness of at least ``least``, each
    by its smallest id; equal fingerprints are one class and make no pairs.

    Partition k holds the sizes from ``least ** -k`` to ``least ** -(k + 1)``, so a set can only be like one
    of its own partition or of the one below. Inside, two sets that are alike share one of their rarest
    ``n - ceil(least * n) + 1`` signatures; only these are joined.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("_text")).filter("id IS NOT NULL")
    classes = (
        with_signatures(rows, "_text", "s").filter(F.size("s") > 0).groupBy("s").agg(F.min("id").alias("id"))
        .withColumn("n", F.size("s")).withColumn("part", F.floor(F.log("n") / -math.log(least) + 1e-9))
    )
    single = classes.select("id", "n", "part", F.explode("s").alias("sig"))
    counted = single.join(single.groupBy("sig").agg(F.count("*").alias("df")), "sig")
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "sig"))
    rare = (
        counted.withColumn("place", place)
        .filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)
        .select("sig", "part", "id", "n")
    )
    below = rare.select("sig", F.explode(F.array("part", F.col("part") - 1)).alias("part"), F.col("id").alias("b"),
                        F.col("n").alias("m"), F.col("part").alias("own"))
    a, b = rare.withColumnRenamed("id", "a"), below
    alike = (F.col("n") >= F.col("m") * least - 1e-9) & (F.col("m") >= F.col("n") * least - 1e-9)
    ordered = (F.col("own") != F.col("part")) | (F.col("a") < F.col("b"))
    pairs = a.join(b, ["sig", "part"]).filter(alike & ordered).select("a", "b").distinct()
    sets = classes.select("id", "s")
    known = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("s").alias("y")), "b"
    )
    like = known.withColumn("likeness", likeness("x", "y", least)).filter(F.col("likeness") >= least)
    return like.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")
