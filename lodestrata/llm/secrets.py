"""Secret scans with corpus-wide ownership frequency.

Every whole text is scanned once for candidates. A candidate is known by a hash of its value, never by
the value itself. Over the whole corpus each hash is counted by distinct repositories and distinct
owners: a value that many owners hold is a copied example (documentation, a test fixture), a value that
stays with one or two and looks random is a credential that is probably live.

Counting goes in three steps, (hash, owner, repository) -> (hash, owner) -> hash, so a value that a third
of all rows hold is summed by many tasks first. The class of a value returns to its places by a join that
Spark may split where a value is frequent.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.names import own_names
from lodestrata.sources.staging import stage

# The base kinds, in the order in which equal starts are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
ASSIGN_LEAST = 6
# Runs of the same characters: the leftmost long enough one starts where the run starts.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Further kinds: (kind, text that must occur, pattern). They follow the base kinds in the order of kinds.
FURTHER = (
    ("github", "gh", re.compile(r"\bgh[opsur]_[A-Za-z0-9]{30,}")),
    ("slack", "xox", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
    ("google", "AIza", re.compile(r"\bAIza[A-Za-z0-9_-]{30,}")),
    ("payment", "k_", re.compile(r"\b[rs]k_(?:live|test)_[A-Za-z0-9]{16,}")),
    ("jwt", "eyJ", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("key_block", "PRIVATE KEY", re.compile(r"-----BEGIN ((?:[A-Z]{2,12} ){0,3}PRIVATE KEY)-----")),
    ("url_login", "://", re.compile(r"(?<=://)[A-Za-z0-9._%+-]{1,64}:[^\s/:@\"']{6,128}(?=@)")),
)
KINDS = ("assign", "access", "hex", *(kind for kind, _, _ in FURTHER))
# Key material without an END line: header lines, then words of base64. Line ends may be written out, and quotes
# or comment signs stand at the start of a line.
KEY_WORD = re.compile(
    r"""((?:[\s"',>#*]|\\[nrt])+)(?:((?:[A-Za-z0-9+/]+={0,2}|={1,2})(?![^\s"',\\]))|[A-Z][A-Za-z]*-[A-Z][A-Za-z]*:\x20[^\r\n\\]*)"""
)
LINE_ENDS = re.compile(r"""[\x20\t"',]*(?:[\r\n]|\\[nr]|\Z)""")
#: Characters from which on a word of base64 is key material wherever it stands; a line of its own may be shorter.
LONG_WORD = 16
NO_KEY = re.compile(r"\\[nrt]|[^A-Za-z0-9+/=]")
#: A key of this many characters holds a placeholder's word by chance only.
LONG_KEY = 64

#: Words that mark a value as a placeholder.
PLACEHOLDERS = ("example", "sample", "changeme", "placeholder", "your", "dummy", "xxxx", "1234567")
#: Bits per character that a value needs to look random, or this share of what its length and alphabet can reach.
LEAST_ENTROPY, LEAST_SHARE = 2.5, 0.4
#: Characters to choose from; a value with others may hold any of 95.
ALPHABETS = ((string.digits, 10), (string.ascii_lowercase, 26), (string.ascii_uppercase, 26))
#: Owners from which on a value counts as copied.
COPIED_OWNERS = 3
#: Repositories from which a value of several owners is a copied example, too.
COPIED_REPOSITORIES = 20

_SPAN = "struct<kind:string,start:int,end:int,value:string,random:boolean>"
SCAN_COLUMNS = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    f"candidates array<{_SPAN}>"
)
_SPAN_TYPE = pa.struct(
    [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("random", pa.bool_())]
)


def looks_random(value: str, kind: str = "") -> bool:
    low = value.lower()
    if (kind != "key_block" or len(value) < LONG_KEY) and any(word in low for word in PLACEHOLDERS):
        return False
    used = Counter(value)
    alphabet = sum(size for characters, size in ALPHABETS if not used.keys().isdisjoint(characters))
    alphabet = alphabet if all(c.isascii() and c.isalnum() for c in used) else 95
    reachable = math.log2(max(2, min(len(value), alphabet)))
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in used.values())
    return entropy >= min(LEAST_ENTROPY, LEAST_SHARE * reachable)


def _key_words_end(text: str, start: int, limit: int) -> int:
    """Where the base64 that follows ``start`` ends; ``start`` if there is none."""
    end = at = start
    while word := KEY_WORD.match(text, at, limit):
        at = word.end()
        if word[2] is None:
            if end > start:
                break
            continue
        own_line = re.search(r"[\r\n]|\\[nr]", word[1]) and LINE_ENDS.match(text, at, limit)
        if own_line or len(word[2]) >= LONG_WORD:
            end = at
        else:
            # The last piece of a key on one line; words of prose have no digits or capitals inside.
            if end > start and not re.fullmatch("[A-Z]?[a-z]*", word[2]):
                end = at
            break
    return end


def key_blocks(text: str, header: re.Pattern) -> list[tuple[str, int, int, str]]:
    """Private keys with all of their key material; the value is what stands between BEGIN and END.

    A key ends with the END line of its BEGIN line, if one comes before the next BEGIN line, and else with its
    lines of base64. A header alone is its own value.
    """
    found = []
    headers = list(header.finditer(text))
    for m, following in zip(headers, [*(h.start() for h in headers[1:]), len(text)], strict=True):
        closing = f"-----END {m[1]}-----"
        last = text.find(closing, m.end(), following)
        if last >= 0:
            end = last + len(closing)
        else:
            last = end = _key_words_end(text, m.end(), following)
        found.append(("key_block", m.start(), end, NO_KEY.sub("", text[m.end() : last]) or m[0]))
    return found


def find_secrets(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, secret value) by start, then kind; places in code points, end exclusive."""
    found = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LEAST:
                found.append(("assign", m.start(), m.end(), m[2]))
    found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    for kind, needed, pattern in FURTHER:
        if needed in text and kind == "key_block":
            found += key_blocks(text, pattern)
        elif needed in text:
            found += [(kind, m.start(), m.end(), m[0]) for m in pattern.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _listed(found: list[tuple[str, int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in found)


def _scan(text: str) -> tuple:
    found = find_secrets(text)
    base = [x for x in found if x[0] in KINDS[:3]]
    counts = Counter(x[0] for x in base)
    spans = [
        (kind, start, end, hashlib.sha256(value.encode()).hexdigest()[:32], looks_random(value, kind))
        for kind, start, end, value in found
    ]
    digest = hashlib.sha256(_listed(base).encode()).hexdigest()
    return (*(counts[k] for k in KINDS[:3]), digest, _listed(found), spans)


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with the candidates of each text; a missing text is empty."""
    keep = list(docs.columns) if keep is None else keep
    frame = docs.select(*keep, F.col(text).alias("_text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_scan(t or "") for t in batch.column(len(keep)).to_pylist()]
            lists = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64()] * 3 + [pa.string()] * 2
            added = [pa.array(x, t) for x, t in zip(lists, types, strict=False)]
            spans = [[dict(zip(_SPAN_TYPE.names, s, strict=True)) for s in row] for row in lists[5]]
            added.append(pa.array(spans, pa.list_(_SPAN_TYPE)))
            names = [*keep, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "candidates"]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *added], names)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1])
    return frame.mapInArrow(task, ", ".join(filter(None, [kept, SCAN_COLUMNS])))


def ownership(candidates: DataFrame) -> DataFrame:
    """``value, owners, repositories`` from rows of (value, owner, repository); missing ones count as one."""
    triples = candidates.groupBy("value", "owner", "repository").agg(F.lit(1).alias("_one"))
    of_owner = triples.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("_repositories"))
    return of_owner.groupBy("value").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("_repositories").alias("repositories")
    )


def judge(
    scanned: DataFrame,
    row: str,
    owner: str,
    repository: str,
    copied_owners: int = COPIED_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES,
):
    """Per ``row`` with candidates: ``live`` (the different ones as kind, start, end) and ``n_copied``.

    A candidate is copied if at least ``copied_owners`` owners hold its value, or several owners and at least
    ``copied_repositories`` repositories. It is live if it is not copied and looks random: one owner's value
    stays live in however many repositories it stands.
    """
    places = scanned.select(
        F.col(row).alias("_row"),
        F.col(owner).alias("owner"),
        F.col(repository).alias("repository"),
        F.inline("candidates"),
    )
    owned = ownership(places.select("value", "owner", "repository"))
    widely = (F.col("owners") > 1) & (F.col("repositories") >= copied_repositories)
    copied = (F.col("owners") >= copied_owners) | widely
    live = F.when(~copied & F.col("random"), F.struct("start", "end", "kind"))
    return (
        places.join(owned, "value")
        .groupBy("_row")
        .agg(
            F.array_sort(F.collect_set(live)).alias("live"),
            F.sum(copied.cast("long")).alias("n_copied"),
        )
    )


def scan_secrets(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    copied_owners: int = COPIED_OWNERS,
) -> DataFrame:
    """Per row of ``docs``: ``id, n_assign, n_access, n_hex, base_sha256, spans``, and by ownership
    ``n_copied`` (candidates that are copied examples), ``n_live`` and ``live_spans``.

    By default a document is a repository and its source the owner. A missing text has no spans; a missing
    owner or repository is one of its own. Repeated rows give repeated results, and count once for a value.
    An empty table gives an empty result. Other columns do not matter.
    """
    plain = docs.select(
        F.col(id).alias("doc_id"), F.col(owner).alias("_owner"),
        F.col(repository).alias("_repository"), F.col(text).alias("_whole"),
    )
    found = scan(plain, "_whole", ["doc_id", "_owner", "_repository"])
    found = stage(found.withColumn("_row", F.monotonically_increasing_id()))
    judged = judge(found.filter(F.size("candidates") > 0), "_row", "_owner", "_repository", copied_owners)
    listed = F.concat_ws(",", F.transform("live", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    return found.join(judged, "_row", "left").select(
        F.col("doc_id").alias(id), "n_assign", "n_access", "n_hex", "base_sha256", "spans",
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
        F.coalesce(F.size("live"), F.lit(0)).cast("long").alias("n_live"),
        F.coalesce(listed, F.lit("")).alias("live_spans"),
    )


def mask(text: str, spans, cover: str = "*") -> str:
    """``text`` with every character of the spans covered."""
    marks = list(text)
    for span in spans:
        marks[span["start"] : span["end"]] = cover * (span["end"] - span["start"])
    return "".join(marks)


@own_names
def redact(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    copied_owners: int = COPIED_OWNERS,
) -> DataFrame:
    """All rows and columns of ``docs``; live credentials in ``text`` are covered by as many asterisks.

    Rows meet their verdicts by a hash of id and text, so equal rows get the same one; the verdicts are
    few, and the texts are shuffled once unless Spark measures that the verdicts fit a broadcast. Copied
    examples and values that do not look random stay.
    """
    keyed = docs.withColumn("_mark", F.xxhash64(F.col(id), F.col(text)))
    slim = keyed.select("_mark", F.col(owner).alias("_owner"), F.col(repository).alias("_repository"),
                        F.col(text).alias("_whole"))
    found = stage(scan(slim, "_whole", ["_mark", "_owner", "_repository"]).filter(F.size("candidates") > 0))
    judged = stage(
        judge(found, "_mark", "_owner", "_repository", copied_owners)
        .filter(F.size("live") > 0)
        .select(F.col("_row").alias("_mark"), F.col("live").alias("_live"))
    )
    names = docs.columns
    frame = keyed.join(judged, "_mark", "left").select(*names, "_live")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = names.index(text)
        for batch in batches:
            columns = list(batch.columns)
            texts, lives = columns[place].to_pylist(), columns.pop().to_pylist()
            covered = [mask(t, s) if s else t for t, s in zip(texts, lives, strict=True)]
            columns[place] = pa.array(covered, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return frame.mapInArrow(task, docs.schema)
