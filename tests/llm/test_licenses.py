import random
import re

import pytest

from lodestrata.llm import licenses

FILLER = ["word", "GNU", "general", "public", "license", "apache", "mit", "cc", "by", "é", "x1", "LICENSE", "copyright", "the"]


def words_by_hand(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base_by_hand(words):
    return [
        (k, label)
        for phrase, label in licenses.BASE.items()
        for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]


def matches_by_hand(words):
    """Every rule at every keyword, then suppression by comparing all pairs."""
    found = []
    for i, word in enumerate(words):
        before = words[max(0, i - licenses.WINDOW) : i]
        stretch = " " + " ".join(before) + (" " if i else "") + licenses.MARK + " ".join(words[i : i + licenses.WINDOW + 1]) + " "
        for order, rule in enumerate(licenses.rules()):
            if rule.keyword == word and (m := re.search(rule.pattern, stretch)):
                start = i - (m[0].split(licenses.MARK)[0].count(" "))
                found.append((start, start + m[0].count(" ") + 1, rule.priority, order, rule.label))
    kept = []
    for a in found:
        rank = (a[0], -a[1], a[2], a[3])
        if not any(
            b[0] <= a[0] and a[1] <= b[1] and b[2] <= a[2] and (b[0], -b[1], b[2], b[3]) < rank for b in found
        ):
            kept.append((a[0], a[1], a[4]))
    return sorted(kept)


TEXTS = [
    None, "", "...", "no notice in here",
    "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.",
    "MIT License", "SPDX-License-Identifier: GPL-2.0-or-later", "cc by-sa 4.0 and CC BY", "gnu gnu general public license license",
    "mit license mit license MIT-LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "All rights reserved. Copyright (c) 2019", "released under the terms of the GNU Lesser General Public License version 2.1 or later",
    "dedicated to the public domain; public domain", "MİT license", "the new BSD license or 3-clause BSD", "é license ",
]


def random_texts(n=150):
    rng = random.Random(4)
    return [" ".join(rng.choices(FILLER, k=rng.randint(1, 40))) for _ in range(n)]


def test_against_plain_rules(documents):
    texts = TEXTS + random_texts() + ["licensed under the mit license " * 400 + "end"]
    rows = licenses.scan_licenses(documents(list(enumerate(texts)) + [(0, TEXTS[0]), (None, TEXTS[4])])).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        words = words_by_hand(texts[4 if r["doc_id"] is None else r["doc_id"]])
        base = base_by_hand(words)
        starts = [k for k, _ in base]
        assert (r["n_words"], r["n_base"]) == (len(words), len(base))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in base}))
        matches = matches_by_hand(words)
        assert sorted((m["start"], m["end"], m["label"]) for m in r["matches"]) == matches
        assert r["labels"] == ",".join(sorted({label for _, label in base} | {m[2] for m in matches}))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(base or matches)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        (TEXTS[4], "apache"), (TEXTS[5], "gpl"), (TEXTS[7], "gpl"), (TEXTS[8], "cc-by,cc-by-sa"), (TEXTS[11], "mit"),
        (TEXTS[12], "copyright,proprietary"), (TEXTS[14], "public-domain"),
    ],
)
def test_labels(documents, text, labels):
    assert licenses.scan_licenses(documents([(1, text)])).first()["labels"] == labels


def test_rules_are_many_and_sound():
    found = licenses.rules()
    assert len(found) >= 300
    assert all(re.compile(rule.pattern) and 0 < rule.confidence <= 1 for rule in found)


def test_no_shuffle_and_no_python(documents):
    plan = licenses.scan_licenses(documents([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow", plan)
    assert licenses.scan_licenses(documents([])).collect() == []


def test_query_against_plain_search(spark, sf_dir):
    from lodestrata.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op3_licenses"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        words = words_by_hand(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (len(words), len(base_by_hand(words)))


BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", BSD_START),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable"),
    ("public-domain,unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "Unauthorized copying of this file, via any medium is strictly prohibited"),
    ("proprietary", "Unauthorized copying, distribution, or use of this file, or of parts of it, via any medium, is strictly prohibited"),
    ("proprietary", "Confidential and proprietary. All rights reserved."),
    ("unknown-license", "see the accompanying LICENSE file"),
]
HOLDERS = ["Foo", "the copyright holder", "the University", "<ORG>", "the Regents of the University of California at Berkeley and its Laboratories"]
NOTICES += [
    ("bsd,bsd-3-clause", f"{BSD_START} the following conditions are met: 3. {opening} of {holder}{rest} may be used to endorse or promote products derived from this software")
    for opening in ("Neither the name", "Neither the names")
    for holder in HOLDERS
    for rest in ("", " nor the names of its contributors")
]


def test_notices_in_their_official_wording(documents):
    rows = licenses.scan_licenses(documents([(k, text) for k, (_, text) in enumerate(NOTICES)])).collect()
    found = {r["doc_id"]: set(r["labels"].split(",")) for r in rows}
    for k, (labels, text) in enumerate(NOTICES):
        wanted = set(labels.split(",")) - {"public-domain"}
        assert wanted <= found[k], (text, found[k])


def test_only_ascii_letters_change_their_case(documents):
    rows = [(1, "MIT LiCENSE K CC BY"), (2, "maKe MIT license"), (3, "İ APACHE LICENSE")]
    by = {r["doc_id"]: r for r in licenses.scan_licenses(documents(rows)).collect()}
    assert (by[1]["n_words"], by[1]["first_word"], by[1]["last_word"], by[1]["base_labels"]) == (5, 0, 3, "cc-by,mit")
    assert by[2]["first_word"] == 1 and by[3]["first_word"] == 1


def test_many_places_in_one_text(documents):
    text = "licensed under the mit license version 2 and more " * 8000
    row = licenses.scan_licenses(documents([(1, text)])).first()
    assert row["n_base"] == 8000 and len(row["matches"]) == 8000 and row["labels"] == "mit"
