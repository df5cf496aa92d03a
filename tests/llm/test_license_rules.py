"""Written signatures: each finds its own words, and not with a word changed; suppression by brute force."""

import random
import re

import regex

from meterline.llm import licenses
from meterline.llm.license_rules import KINDS

SIGNATURES = [(label, key, pattern) for _, _, rules in KINDS for label, key, pattern in rules]
TEXTS = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "mit",
    "Permission is granted, free of charge, to any person who asks": "",
    "Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions are met:": "bsd",
    "Redistribution and use in binary forms only are permitted": "",
    "Neither the name of the Example University nor the names of its contributors may be used to endorse or promote products derived from this software without permission": "bsd-3",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": "gpl-2",
    "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3": "gpl-3",
    "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License": "lgpl-2.1",
    "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License": "agpl-3",
    "as published by the Free Software Foundation": "",
    "https://www.apache.org/licenses/LICENSE-2.0": "apache-2",
    "https://www.apache.org/foundation/": "",
    "you may not use this file except in compliance with the License": "",
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.': "apache-2",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2",
    "https://creativecommons.org/licenses/by-nc-sa/4.0/": "cc-by-nc-sa",
    "https://creativecommons.org/licenses/": "",
    "This is free and unencumbered software released into the public domain.": "unlicense",
    "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.": "zlib",
    "SPDX-License-Identifier: MIT OR Apache-2.0": "apache-2,mit",
    "SPDX-License-Identifier: (MIT AND BSD-3-Clause) OR GPL-2.0-or-later": "bsd-3,gpl-2,mit",
    "SPDX-License-Identifier: MIT or maybe something else, ask Apache-2 people": "apache-2,mit",
    "Neither Apache nor Mozilla published this; no permission was granted to anybody.": "",
}


def labels_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.label_digests(df).collect()}
    return [got[k] for k in range(len(texts))]


def words_of(pattern):
    """Words that a signature matches: options left out, first alternatives taken, gaps at their least."""
    s = pattern
    while True:
        m = re.search(r"\(\?:((?:[^()]|\[[^\]]*\])*)\)(\?|\{(\d+),\d+\})?", s)
        if not m:
            break
        body, times = m[1].split("|")[0], 1
        if m[2]:
            times = 0 if m[2] == "?" else int(m[3])
        s = s[: m.start()] + body.replace("[^ ]+", "filler") * times + s[m.end() :]
    s = re.sub(r"\[([0-9])[^\]]*\]", r"\1", s)
    s = re.sub(r"(.)\?", "", s)
    return s.split()


def test_there_are_hundreds():
    assert len(SIGNATURES) >= 190 and len(licenses.rule_table()) >= 500
    assert len({p for *_, p in SIGNATURES}) == len(SIGNATURES)


def test_each_signature_finds_its_words_and_no_others():
    for label, key, pattern in SIGNATURES:
        words = words_of(pattern)
        rule = re.compile(f"(?<= )(?:{pattern})(?= )")
        assert key in words, (label, words)
        assert rule.search(f" {' '.join(words)} "), (label, words)
        least = [i for i, w in enumerate(words) if w != "filler"]
        for i in least:
            changed = [*words[:i], "zzz", *words[i + 1 :]]
            assert not rule.search(f" {' '.join(changed)} "), (label, words[i])


def test_each_signature_gives_its_label(spark):
    """In Spark, alone in a text; a longer signature of the same words may add none of its own."""
    found = labels_of(spark, [" ".join(words_of(p)) for *_, p in SIGNATURES])
    for (label, _, pattern), got in zip(SIGNATURES, found, strict=True):
        assert label in got.split(","), (label, got, pattern)


def test_texts(spark):
    assert labels_of(spark, list(TEXTS)) == list(TEXTS.values())


def brute_found(text):
    """Intervals of all rules, and those left when each is compared with every other."""
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) if w]
    norm = " " + " ".join(words) + " "
    every = []
    for r in licenses.rule_table():
        if r["base"] or r["keyword"] not in words:
            continue
        for m in regex.finditer(r["pattern"], norm):
            start = norm[: m.start()].count(" ") - 1
            every.append((start, start + len(m[0].split()), r["priority"], r["rank"], r["label"]))
    left = []
    for a in every:
        for b in every:
            inside = b[0] <= a[0] and a[1] <= b[1] and a is not b
            longer = (b[1] - b[0]) > (a[1] - a[0])
            if inside and (b[2] > a[2] or b[2] == a[2] and (longer or b[3] < a[3])):
                break
        else:
            left.append((a[0], a[1], a[3], a[4]))
    return sorted(left)


def test_suppression_against_all_pairs(spark):
    rng = random.Random(4)
    pieces = [*TEXTS, *(" ".join(words_of(p)) for *_, p in SIGNATURES), "MIT license", "GNU GPL v3", "Apache 2.0", "some words", "under the MIT license"]
    texts = [". ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12))) for _ in range(60)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.detect(df).collect():
        got = sorted((d["start"], d["end"], d["rank"], d["label"]) for d in r["found"])
        assert got == brute_found(texts[r["doc_id"]]), texts[r["doc_id"]]
