from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from stratalake.llm import license_scan
from stratalake.llm.license_scan import ancestors, directory, scan_licences


@pytest.fixture(scope="module")
def tree(spark):
    mit = dict(license_scan.TEMPLATES[::-1])["MIT"]
    rows = [
        (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0."),
        (2, "a/b/x.txt", "nothing of the kind here"),
        (3, "a/b/c/y.txt", "prose first\nReleased under the MIT License.\nprose after"),
        (4, "a/b/c/d/z.txt", "more prose, not a word of rights"),
        (5, "a/b/c/COPYING", "\n".join(mit.split(" "))),
        (6, "top.txt", "plain"),
        (7, "e/f.txt", None),
        (8, None, ""),
        (None, "a/q.txt", "All rights reserved. " * 3),
        (9, "ab/x.txt", "the directory only begins alike"),
        (2, "a/b/x.txt", "nothing of the kind here"),
    ]
    return spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, path string, text string, own string")


def test_nearest_directory_grants(tree):
    rows = scan_licences(tree, F.col("path")).collect()
    got = {(r["doc_id"], r["path"]): (r["own"], r["licence"], r["inherited_from"]) for r in rows}
    assert len(rows) == 11
    assert got[(1, "a/LICENSE")] == ("Apache-2.0", "Apache-2.0", None)
    assert got[(2, "a/b/x.txt")] == (None, "Apache-2.0", "a")
    assert got[(3, "a/b/c/y.txt")] == ("MIT", "MIT", None)
    assert got[(4, "a/b/c/d/z.txt")] == (None, "MIT", "a/b/c")
    assert got[(5, "a/b/c/COPYING")][0] == "MIT"
    assert got[(6, "top.txt")] == (None, None, None) == got[(7, "e/f.txt")] == got[(8, "")]
    assert got[(None, "a/q.txt")][0] == "proprietary"
    assert got[(9, "ab/x.txt")] == (None, None, None)


def test_paths(spark):
    df = spark.createDataFrame([("a/b/c.txt",), ("c.txt",), ("a/",), ("",)], "path string").withColumn("folder", directory(F.col("path")))
    assert [r["folder"] for r in df.collect()] == ["a/b", "", "a", ""]
    up = df.filter("path = 'a/b/c.txt'").select(ancestors("folder")).collect()
    assert [tuple(r) for r in up] == [(0, ""), (1, "a"), (2, "a/b")]


def test_words_outside_the_templates_weaken_a_match():
    weights = license_scan.Weights(dict.fromkeys(license_scan.VOCABULARY, 1.0), 2.0)
    templates = license_scan.Templates(weights)
    name, score = templates.best("Licensed under the MIT License.")
    assert name == "MIT" and score == pytest.approx(1.0)
    assert templates.best("Licensed under the MIT License, says a long line of other things")[1] < 0.7
    assert templates.best("") == (None, 0.0)


def test_notices_inside_longer_lines(spark):
    """A notice counts wherever lines break: in a long line, in prose, in a comment block and in a minified file."""
    prose = "Some words come before that have nothing to do with it, as they do in any readme of this kind."
    mit = license_scan.TEMPLATES[4][1]
    gpl = license_scan.TEMPLATES[7][1].split(" ")
    texts = [
        ("MIT", "Copyright (c) Microsoft Corporation. All rights reserved. Licensed under the MIT License."),
        ("MIT", f"{prose} {mit}. {prose} {prose}"),
        ("MIT", "/*! x.js v1 | Released under the MIT License. | x.org */" + "var a=function(b){return b+1};" * 200),
        ("GPL-3.0", f"{prose}\n" + "\n".join(f"# {' '.join(gpl[i : i + 3])}" for i in range(0, len(gpl), 3)) + f"\n{prose * 3}"),
        ("CC-BY-NC-4.0", f"{prose} Licensed under CC BY-NC 4.0. {prose}"),
        (None, f"{prose} {prose}"),
        (None, f"{prose} license license license license license license rights {prose}"),
    ]
    docs = spark.createDataFrame([(i, f"d{i}/x.txt", t) for i, (_, t) in enumerate(texts)], "doc_id long, path string, text string")
    got = {r["doc_id"]: (r["own"], r["cosine"]) for r in scan_licences(docs, F.col("path")).collect()}
    assert [got[i][0] for i in range(len(texts))] == [name for name, _ in texts]
    assert got[0][1] == pytest.approx(1.0)


NOTICES = {
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License version 3.0",
    "Apache-1.1": 'Licensed under the Apache License, Version 1.1 (the "License")',
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "BSD-2-Clause": dict(license_scan.TEMPLATES)["BSD-2-Clause"],
    "BSD-3-Clause": dict(license_scan.TEMPLATES)["BSD-3-Clause"],
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-3.0": "Licensed under CC BY 3.0",
    "MPL-1.1": "are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance "
    "with the License. The contents of this file",
    "ISC": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# No template has these, though they are like one.
UNKNOWN = ["Licensed under the Apache License, Version 1.0", "Licensed under CC BY 2.0", "Licensed under CC BY-NC-SA 3.0", "GNU General Public License, version 1"]


LONG_BSD = dict(t for t in license_scan.TEMPLATES if len(t[1]) > 600 or t[0] == "BSD-2-Clause" and len(t[1]) > 300)
BSD_TAILS = [
    LONG_BSD["BSD-2-Clause"] + " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS",
    LONG_BSD["BSD-3-Clause"] + " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS",
]


@pytest.mark.parametrize("around", ["{}", "Some prose comes first.\n// {}\nand code after it", "x " * 60 + "{} " + "y " * 60])
def test_versions_and_variants_are_told_apart(spark, around):
    texts = [*NOTICES.values(), *(t for t in BSD_TAILS), *UNKNOWN]
    want = [*NOTICES, "BSD-2-Clause", "BSD-3-Clause", *[None] * len(UNKNOWN)]
    docs = spark.createDataFrame([(i, f"d{i}/x", around.format(t)) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    got = {r["doc_id"]: r["own"] for r in scan_licences(docs, F.col("path")).collect()}
    assert [got[i] for i in range(len(texts))] == want


def brute_scan(text, weights, least):
    """Every line, the whole text and every run of words against every template."""
    words = license_scan.terms(text)
    best = (0.0, 0, "")
    for name, template in license_scan.TEMPLATES:
        own = license_scan.terms(template)
        vector, norm = weights.vector_of(own)
        runs = [words[i : i + len(own)] for i in range(len(words) - len(own) + 1)]
        for run in [*map(license_scan.terms, text.split("\n")), words, *runs]:
            other, length = weights.vector_of(run)
            dot = sum(v * vector.get(t, 0.0) for t, v in other.items())
            if dot and license_scan.signs(run) == license_scan.signs(own):
                best = max(best, (round(min(dot / (length * norm), 1.0), 9), len(own), name))
    return (best[2], best[0]) if best[0] >= least - 1e-9 else (None, None)


def test_scan_equals_brute_force(spark):
    rng = random.Random(5)
    parts = [t for _, t in license_scan.TEMPLATES] + ["plain words here", "license of the work", "by the terms of", "version 2", "3", "GNU"]
    texts = ["", None, "license", "MIT", " ".join(license_scan.VOCABULARY)]
    for _ in range(60):
        words = " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))).split(" ")
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = rng.choice(["of", "2", "license", "x", "work\n", "\n"])
        texts.append(" ".join(words))
    texts.append("prose without any rights " * 20_000 + "Licensed under CC BY-NC 4.0. " + "and more of it " * 20_000)
    docs = spark.createDataFrame([(i, f"d{i}/x", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    rows = {r["doc_id"]: (r["own"], r["cosine"]) for r in scan_licences(docs, F.col("path")).collect()}
    held = docs.selectExpr("0L AS _id", "0L AS _hash", "path AS _path", "coalesce(text, '') AS _text")
    weights = license_scan.corpus_weights(held)
    for i, text in enumerate(texts[:-1]):
        name, score = brute_scan(text or "", weights, license_scan.LEAST_COSINE)
        assert rows[i][0] == name, text
        assert rows[i][1] == (None if score is None else pytest.approx(score, abs=1e-8))
    assert rows[len(texts) - 1][0] == "CC-BY-NC-4.0"


def test_nearest_ancestor_equals_brute_force(spark):
    rng = random.Random(6)
    grants = ["Licensed under the MIT License.", "Licensed under CC BY 4.0.", "Licensed under the Apache License, Version 2.0."]
    rows = []
    for i in range(300):
        folder = "/".join(rng.choice("abc") for _ in range(rng.randrange(5)))
        name = rng.choice(["LICENSE", "COPYING", "x.txt", "y.txt", "z.txt"])
        rows.append((i, f"{folder}/{name}".lstrip("/"), rng.choice([*grants, "nothing", "nothing"])))
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string")
    names = dict(zip([*grants, "nothing"], ["MIT", "CC-BY-4.0", "Apache-2.0", None], strict=True))
    votes = {}
    for _, path, text in rows:
        folder, _, name = path.rpartition("/")
        if names[text] and name in ("LICENSE", "COPYING"):
            votes.setdefault(folder, []).append(names[text])
    granted = {f: min(set(v), key=lambda n: (-v.count(n), n)) for f, v in votes.items()}
    for r in scan_licences(docs, F.col("path")).collect():
        own, folder = names[rows[r["doc_id"]][2]], r["path"].rpartition("/")[0]
        above = [folder]
        while above[-1]:
            above.append(above[-1].rpartition("/")[0])
        nearest = next((f for f in above if f in granted), None)
        want = (own, own or granted.get(nearest), None if own else nearest)
        assert (r["own"], r["licence"], r["inherited_from"]) == want


def test_empty_table(tree):
    assert scan_licences(tree.limit(0), F.col("path")).collect() == []
