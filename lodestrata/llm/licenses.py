"""License scans by ordered signature rules, as DataFrame expressions only.

A text is a list of words (lower-cased ASCII letters and digits, and all that is not ASCII). A rule is a
regex over the words around one keyword, with a label, a priority and a confidence. A text's words are
looked up in the set of keywords first; only around a keyword the rules of that keyword run, each on the
stretch of ``WINDOW`` words before and after it. So a text without a keyword meets no regex, and a long text
costs its words plus its keywords.

A match is an interval of words. It is suppressed if a match of the same or a higher priority contains it;
of equal intervals the one of higher priority stays, then the rule that stands first. All of it happens in
the row of the text: there is no shuffle, and no row meets another one.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What is no part of a word, and the base phrases with their labels.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Words before and after a keyword that a rule can see.
WINDOW = 40
#: Stands before the keyword that a rule is tried at.
MARK = "\x01"

# One line per license: label; its names in words as regexes, with ^ before the keyword of each.
LICENSES = (
    ("gpl", "gnu ^general public licen[cs]e|gnu ^gpl|^gpl|gnu ^public licen[cs]e"),
    ("lgpl", "gnu (?:lesser|library) ^general public licen[cs]e|gnu ^lgpl|^lgpl"),
    ("agpl", "gnu ^affero general public licen[cs]e|^affero gpl|^agpl"),
    ("gfdl", "gnu free ^documentation licen[cs]e|^gfdl"),
    ("apache", "^apache(?: software)? licen[cs]e|^apache"),
    ("mit", "^mit(?: x11| expat)? licen[cs]e|^expat licen[cs]e"),
    ("bsd", "(?:(?:2|3|4|two|three|four) clause )?(?:original |modified |simplified |new |revised )?^bsd licen[cs]e"),
    ("bsd-2-clause", "^bsd 2 clause|2 clause ^bsd|simplified ^bsd|^freebsd licen[cs]e"),
    ("bsd-3-clause", "^bsd 3 clause|3 clause ^bsd|new ^bsd|modified ^bsd"),
    ("bsd-4-clause", "^bsd 4 clause|4 clause ^bsd|original ^bsd"),
    ("mpl", "^mozilla public licen[cs]e|^mpl"),
    ("epl", "^eclipse public licen[cs]e|^epl"),
    ("edl", "^eclipse distribution licen[cs]e"),
    ("cddl", "common ^development and distribution licen[cs]e|^cddl"),
    ("cpl", "^common public licen[cs]e"),
    ("ipl", "^ibm public licen[cs]e"),
    ("eupl", "^european union public licen[cs]e|^eupl"),
    ("isc", "^isc licen[cs]e"),
    ("zlib", "^zlib(?: libpng)? licen[cs]e"),
    ("libpng", "^libpng licen[cs]e"),
    ("boost", "^boost software licen[cs]e"),
    ("artistic", "^artistic licen[cs]e"),
    ("perl", "same terms as ^perl(?: itself)?"),
    ("python", "^python software foundation licen[cs]e|^psf licen[cs]e"),
    ("ruby", "^ruby licen[cs]e"),
    ("php", "^php licen[cs]e"),
    ("zope", "^zope public licen[cs]e|^zpl"),
    ("unlicense", "^unlicen[cs]e"),
    ("wtfpl", "^wtfpl|do what the fuck you want to ^public licen[cs]e"),
    ("ms-pl", "^microsoft public licen[cs]e"),
    ("ms-rl", "^microsoft reciprocal licen[cs]e"),
    ("osl", "^open software licen[cs]e|^osl"),
    ("afl", "^academic free licen[cs]e|^afl"),
    ("ofl", "^sil open font licen[cs]e|^ofl"),
    ("qpl", "^qt public licen[cs]e|^qpl"),
    ("sspl", "server ^side public licen[cs]e|^sspl"),
    ("busl", "^business source licen[cs]e"),
    ("elastic", "^elastic licen[cs]e"),
    ("postgresql", "^postgresql licen[cs]e"),
    ("openssl", "^openssl licen[cs]e"),
    ("ncsa", "illinois ^ncsa open source licen[cs]e|^ncsa licen[cs]e"),
    ("w3c", "^w3c software notice and licen[cs]e|^w3c licen[cs]e"),
    ("unicode", "^unicode licen[cs]e"),
    ("curl", "^curl licen[cs]e"),
    ("beerware", "^beerware licen[cs]e|^beer ware licen[cs]e"),
    ("vim", "^vim licen[cs]e"),
    ("odbl", "open ^database licen[cs]e|^odbl"),
    ("odc-by", "open data commons ^attribution licen[cs]e|^odc by"),
    ("pddl", "^pddl|public ^domain dedication and licen[cs]e"),
    ("cc0", "^cc0|creative ^commons zero"),
    ("cc-by", "^cc by|creative ^commons attribution"),
    ("cc-by-sa", "^cc by sa|creative ^commons attribution share ?alike"),
    ("cc-by-nc", "^cc by nc|creative ^commons attribution non ?commercial"),
    ("cc-by-nd", "^cc by nd|creative ^commons attribution no ?deriv(?:s|atives)"),
    ("cc-by-nc-sa", "^cc by nc sa|creative ^commons attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "^cc by nc nd|creative ^commons attribution non ?commercial no ?deriv(?:s|atives)"),
)

# Notices without a license's name: label; regex with ^ before the keyword; priority; confidence.
NOTICES = (
    ("mit", "^permission is hereby granted free of charge to any person obtaining a copy", 2, 0.95),
    ("isc", "^permission to use copy modify and (?:or )?distribute this software for any purpose", 2, 0.95),
    ("bsd", "^redistribution and use in source and binary forms with or without modification", 2, 0.95),
    ("bsd-3-clause", r"neither the names? of (?:\S+ ){1,36}?^endorse or promote products derived", 2, 0.9),
    ("zlib", "provided as is without any express or implied ^warranty", 2, 0.8),
    ("unlicense", "this is free and ^unencumbered software released into the public domain", 2, 0.95),
    ("public-domain", "(?:released|dedicated|placed) (?:in|into|to) the public ^domain", 2, 0.8),
    ("public-domain", "public ^domain", 3, 0.5),
    ("proprietary", "all rights ^reserved", 3, 0.4),
    ("proprietary", "^confidential and proprietary|^proprietary and confidential", 2, 0.8),
    ("proprietary", "unauthori[sz]ed (?:copying|distribution|use) (?:\\S+ ){0,30}?strictly ^prohibited", 2, 0.8),
    ("creative-commons", "creative ^commons(?: licen[cs]e)?", 3, 0.5),
    ("open-source", "open ^source licen[cs]e", 3, 0.4),
    ("unknown-license", "(?:licensed|released|distributed|available) under (?:the )?terms of (?:the )?(?:\\S+ ){0,3}^licen[cs]e", 4, 0.3),
    ("unknown-license", "see (?:the )?(?:accompanying )?^licen[cs]e (?:file|txt|md)", 4, 0.3),
    ("copyright", "^copyright (?:c )?(?:19|20)[0-9][0-9]", 4, 0.2),
)

# Ways to name a license, strongest first: words before the name, words after it, priority, confidence.
FORMS = (
    (r"spdx license identifier ", r"(?: only| or later)?", 1, 1.0),
    (r"(?:licensed|released|distributed|available|published|redistribute .{0,30}?) under (?:the )?(?:terms of (?:the )?)?", r"(?: or (?:any )?later(?: version)?)?", 1, 0.95),
    (r"", r"(?: or (?:any )?later(?: version)?)?", 2, 0.8),
)
# A version may follow a name; the official wording may stand between them.
VERSION = (
    "(?: as published by the free software foundation)?(?: either)?"
    "(?:(?: licen[cs]e| international)? (?:version |v ?)?[0-9](?: [0-9]{1,2})?)?"
)


@dataclass(frozen=True)
class Rule:
    keyword: str
    pattern: str
    label: str
    priority: int
    confidence: float


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in order: every name of a license in every form, then the notices."""
    texts = [
        (f"{before}{name}{VERSION}{after}", label, priority, confidence)
        for label, names in LICENSES
        for name in _alternatives(names)
        for before, after, priority, confidence in FORMS
    ]
    texts += [(name, label, p, confidence) for label, names, p, confidence in NOTICES for name in _alternatives(names)]
    return tuple(
        Rule(keyword, f"(?<= ){text.replace('^', MARK)}(?= )", label, priority, confidence)
        for text, label, priority, confidence in texts
        for keyword in _keywords(text)
    )


def _alternatives(names: str) -> list[str]:
    """The names between bars that stand in no bracket."""
    return re.split(r"\|(?![^(]*\))", names)


def _keywords(text: str) -> list[str]:
    """What the word after ^ stands for: itself, or both spellings of it."""
    word = re.search(r"\^([^ (]+)", text)[1]
    return [word.replace("[cs]", c) for c in "cs"] if "[cs]" in word else [word]


def _rules_of_keyword() -> Column:
    """A map from keyword to its rules in order, as one literal."""
    by: dict[str, list[dict]] = {}
    for order, rule in enumerate(rules()):
        facts = {"pattern": rule.pattern, "label": rule.label, "priority": rule.priority, "confidence": rule.confidence}
        by.setdefault(rule.keyword, []).append(facts | {"order": order})
    kind = "map<string,array<struct<pattern:string,label:string,priority:int,confidence:double,order:int>>>"
    return F.from_json(F.lit(json.dumps(by)), kind)


def _stretch(words: Column, at: Column) -> Column:
    """The words around place ``at`` between spaces, with a mark before the word there."""
    before = F.array_join(F.slice(words, F.greatest(at - WINDOW, F.lit(0)) + 1, F.least(at, F.lit(WINDOW))), " ")
    after = F.array_join(F.slice(words, at + 1, F.lit(WINDOW + 1)), " ")
    return F.concat(F.lit(" "), before, F.when(at > 0, " ").otherwise(""), F.lit(MARK), after, F.lit(" "))


def _detections(words: Column, places: Column, keyword: Column, rules_of: Column) -> Column:
    """The matches of the rules of a keyword at its places; no match is NULL.

    Each rule is tried at all places before the next one is, so its pattern is compiled once for a text.
    """

    def tried(rule: Column, place: Column) -> Column:
        match, at = F.call_function("regexp_extract", place["stretch"], rule["pattern"], F.lit(0)), place["at"]
        start = at - (F.size(F.split(F.substring_index(match, MARK, 1), " ")) - 1)
        end = start + F.size(F.split(match, " "))
        return F.when(
            match != "",
            F.struct(
                start.alias("start"), (-end).alias("minus_end"), rule["priority"].alias("priority"),
                rule["order"].alias("order"), rule["label"].alias("label"), rule["confidence"].alias("confidence"),
            ),
        )

    own = F.filter(places, lambda i: F.get(words, i) == keyword)
    stretches = F.transform(own, lambda i: F.struct(i.alias("at"), _stretch(words, i).alias("stretch")))
    by_rule = lambda known: F.transform(
        F.element_at(rules_of, keyword), lambda rule: F.transform(known, lambda place: tried(rule, place))
    )
    # The stretches are made once, in an array of one element that all rules look at.
    return F.flatten(F.get(F.transform(F.array(stretches), by_rule), 0))


def _lowered(text: Column) -> Column:
    """A to Z in lower case. Letters beyond ASCII may change with them, but never to an ASCII one: the one letter
    that would, the sign of the kelvin, is kept apart."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.contains(text, F.lit("\u212a")), F.translate(text, letters, letters.lower())).otherwise(F.lower(text))


_KEPT = "array<struct<start:int,end:int,label:string,confidence:double>>"


def _unsuppressed(found: Column) -> Column:
    """Matches that none of the same or a higher priority contains. ``found`` is in order of start, longest first.

    The state holds, for each priority, how far the matches so far of that or a higher one reach.
    """
    levels = max(rule.priority for rule in rules())

    def step(state: Column, match: Column) -> Column:
        end = -match["minus_end"]
        kept = F.struct(match["start"].alias("start"), end.alias("end"), match["label"].alias("label"),
                        match["confidence"].alias("confidence"))
        return F.struct(
            F.transform(
                state["reach"], lambda x, p: F.when(p + 1 >= match["priority"], F.greatest(x, end)).otherwise(x)
            ).alias("reach"),
            F.when(F.get(state["reach"], match["priority"] - 1) >= end, state["kept"])
            .otherwise(F.array_append(state["kept"], kept))
            .alias("kept"),
        )

    start = F.struct(
        F.array(*[F.lit(-1)] * levels).alias("reach"), F.array().cast(_KEPT).alias("kept")
    )
    return F.aggregate(found, start, step, lambda state: state["kept"])


def scan_licenses(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id, n_words, n_base, first_word, last_word, base_labels, labels, score`` and
    ``matches`` (array of start, end, label, confidence of the rules' matches that stay).

    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word`` are the smallest and
    largest of their starts. ``score`` is the highest confidence of a match (0.8 for a base phrase), 0 without
    any. A missing text is empty. Repeated rows give repeated results; other columns do not matter.
    """
    keywords = sorted({rule.keyword for rule in rules()})
    openers = sorted({phrase.split()[0] for phrase in BASE})
    words = F.filter(F.split(_lowered(F.coalesce(F.col(text), F.lit(""))), NO_WORD), lambda w: w != "")
    listed = docs.select(F.col(id).alias("_id"), words.alias("_words"))
    words = F.col("_words")
    places = F.sequence(F.lit(0), F.size(words) - 1)
    none = F.array().cast("array<int>")

    def where(known: list[str], column: Column) -> Column:
        """Places of known words; a text without any is not gone through."""
        hit = F.arrays_overlap(column, F.array(*map(F.lit, known)))
        return F.when(hit, F.filter(places, lambda i: F.get(column, i).isin(known))).otherwise(none)

    def stands(phrase: str, i: Column) -> Column:
        parts = phrase.split()
        same = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            same &= F.get(words, i + k) == part
        return F.coalesce(same, F.lit(False))

    def phrase_at(i: Column) -> Column:
        found = F.lit(None).cast("string")
        for phrase, label in BASE.items():
            found = F.when(stands(phrase, i), label).otherwise(found)
        return found

    base = F.filter(
        F.transform(where(openers, words), lambda i: F.struct(i.alias("at"), phrase_at(i).alias("label"))),
        lambda b: b["label"].isNotNull(),
    )
    marked = listed.select("*", base.alias("_base"), where(keywords, words).alias("_at"))
    rules_of = _rules_of_keyword()
    present = F.array_distinct(F.transform("_at", lambda i: F.get(words, i)))
    found = F.flatten(F.transform(present, lambda keyword: _detections(words, F.col("_at"), keyword, rules_of)))
    found = F.when(F.size("_at") > 0, F.array_sort(F.filter(found, lambda d: d.isNotNull())))
    detected = marked.select("_id", F.size("_words").alias("_n"), "_base", found.alias("_found"))
    kept = detected.withColumn(
        "matches", F.when(F.size("_found") > 0, _unsuppressed(F.col("_found"))).otherwise(F.array().cast(_KEPT))
    )
    starts, base_labels = F.col("_base")["at"], F.col("_base")["label"]
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    sure = F.when(F.size("_base") > 0, 0.8).otherwise(0.0)
    return kept.select(
        F.col("_id").alias(id),
        F.col("_n").cast("long").alias("n_words"),
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, F.col("matches")["label"])).alias("labels"),
        F.greatest(sure, F.coalesce(F.array_max(F.col("matches")["confidence"]), F.lit(0.0))).alias("score"),
        "matches",
    )
