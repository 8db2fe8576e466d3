"""Licence scans: sparse TF-IDF cosine of notices to templates, then inheritance from the nearest licensed directory.

Every line of a text is compared with every template, and so are the text as a whole and all runs of as many words as
the template has, wherever lines break; these find notices in running prose, long lines and comment blocks. Words weigh
by how few documents of the corpus have them. Notices of one family differ in a word or a number, which hardly moves a
cosine, so a match must also agree with its template in the words and versions that tell licences apart. A file without
a notice takes the licence of the nearest directory above it in which a licence file lies.

A cosine of ``least`` or more needs one of the template's heavy words, its anchors, so texts without any are done after
one look at their words, and others are compared around their anchors only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import KEY, NULL_ID, public_id, written

LEAST_COSINE = 0.7

# Licence notices as their publishers word them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE"),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("Apache-1.1", "The Apache Software License, Version 1.1"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version.",
    ),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    (
        "MPL-1.1",
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not "
        "use this file except in compliance with the License.",
    ),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    (
        "EPL-1.0",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v1.0 which accompanies this distribution",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Artistic-2.0", "Licensed under the Artistic License 2.0."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("CC-BY-3.0", "Licensed under CC BY 3.0."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("CC-BY-SA-3.0", "Licensed under CC BY-SA 3.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    (
        "CC-BY-NC-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
)
# Words that tell one licence from another, and words after which a number is a version.
TELLING = frozenset(
    "apache mit isc bsd gnu lesser library affero mozilla eclipse boost artistic sil font creative cc cc0 nc sa nd "
    "noncommercial sharealike noderivatives neither endorse fee merge unencumbered waived neighboring clause".split()
)
VERSION_AFTER = frozenset(
    "version v license licence bsd by nc sa nd cc0 attribution noncommercial sharealike noderivatives".split()
)
NUMBER = re.compile(r"v?(\d{1,2})$")
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|copyright|notice)(\.[a-z]+)?$"
TERM = re.compile(r"[^\W_]+")


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


def signs(words: Sequence[str]) -> tuple[frozenset[str], frozenset[tuple[str, ...]]]:
    """What tells a notice from others of its kind: its telling words, and its versions as numbers without a last 0."""
    versions = set()
    for i, word in enumerate(words):
        number = NUMBER.match(word)
        if number and (word[0] == "v" or (i and words[i - 1] in VERSION_AFTER)):
            minor = words[i + 1] if i + 1 < len(words) and words[i + 1].isdigit() and len(words[i + 1]) == 1 else "0"
            versions.add((number[1],) if minor == "0" else (number[1], minor))
    return TELLING.intersection(words), frozenset(versions)


VOCABULARY = sorted({t for _, text in TEMPLATES for t in terms(text)})


@dataclass(frozen=True)
class Weights:
    """Inverse document frequencies of the templates' words. Any other word weighs as one that no document has."""

    idf: dict[str, float]
    other: float

    def vector(self, text: str) -> tuple[dict[str, float], float]:
        """Weights of the vocabulary's words in a text, and the length of the whole vector."""
        return self.vector_of(terms(text))

    def vector_of(self, words: list[str]) -> tuple[dict[str, float], float]:
        counts = Counter(words)
        known = {t: n * self.idf[t] for t, n in counts.items() if t in self.idf}
        rest = sum(n * n for t, n in counts.items() if t not in self.idf) * self.other**2
        return known, float(np.sqrt(sum(v * v for v in known.values()) + rest))


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wanted, counts = set(VOCABULARY), Counter()
    for batch in batches:
        for text in batch.column("_text"):
            counts.update(wanted.intersection(terms(text.as_py())))
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])


def corpus_weights(texts: DataFrame) -> Weights:
    """Over all documents; the vocabulary is as small as the templates."""
    total = texts.count()
    counted = texts.select("_text").mapInArrow(_document_counts, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counted.collect()}
    weigh = lambda n: float(np.log((1 + total) / (1 + n)) + 1)
    return Weights({t: weigh(found.get(t, 0)) for t in VOCABULARY}, weigh(0))


#: Score, number of words and name of a template.
Match = tuple[float, int, str | None]
NO_MATCH: Match = (0.0, 0, None)


def _rank(match: Match) -> tuple[float, int, str]:
    """The better score counts, of equal ones the longer template: other licences' notices end in "all rights reserved"."""
    score, size, name = match
    return round(score, 9), size, name or ""


class Templates:
    def __init__(self, weights: Weights, least: float = LEAST_COSINE) -> None:
        self.weights, self.least = weights, least
        self.entries = [(name, *weights.vector(text), len(terms(text)), signs(terms(text))) for name, text in TEMPLATES]
        self.code = {t: i for i, t in enumerate(VOCABULARY)}
        # By code; the last place is that of all other words.
        weight = np.array([*(weights.idf[t] for t in VOCABULARY), weights.other])
        self.square = weight * weight
        self.gain = [weight * [*(other.get(t, 0.0) for t in VOCABULARY), 0.0] for _, other, _, _, _ in self.entries]
        self.anchors = [self._anchors(other, norm) for _, other, norm, _, _ in self.entries]
        self.any_anchor = frozenset().union(*self.anchors)

    def _anchors(self, other: dict[str, float], norm: float) -> frozenset[str]:
        """Words of a template of which a match has one at least: the others together cannot reach the cosine."""
        rest, light = 0.0, set()
        # The words that most documents have are left out first, so that anchors are rare.
        for term, value in sorted(other.items(), key=lambda item: (self.weights.idf[item[0]], item[0])):
            if np.sqrt(rest + value * value) < self.least * norm - 1e-9:
                rest += value * value
                light.add(term)
        return frozenset(other) - light

    def match(self, words: list[str]) -> Match:
        """The best template for these words as a whole that agrees in what tells licences apart."""
        vector, length = self.weights.vector_of(words)
        if not vector:
            return NO_MATCH
        told = signs(words)
        scores = (
            (min(sum(v * other.get(t, 0.0) for t, v in vector.items()) / (length * norm), 1.0), n, name)
            for name, other, norm, n, own in self.entries
            if own == told
        )
        return max(scores, key=_rank, default=NO_MATCH)

    def best(self, text: str) -> tuple[str | None, float]:
        score, _, name = self.match(terms(text))
        return name, score

    def window(self, words: list[str]) -> Match:
        """The best run of as many words as its template has.

        Were all words of a run different its vector would be shortest, which bounds the cosine from above by running
        sums; runs are scored where they have an anchor and the bound leaves them a chance.
        """
        found = NO_MATCH
        places: dict[str, list[int]] = {}
        for i, word in enumerate(words):
            if word in self.any_anchor:
                places.setdefault(word, []).append(i)
        if not places:
            return found
        codes = np.fromiter((self.code.get(w, -1) for w in words), np.int64, len(words))
        squares = np.r_[0.0, np.cumsum(self.square[codes])]
        for (name, other, norm, n, own), gain, anchors in zip(self.entries, self.gain, self.anchors, strict=True):
            starts = self._starts([places[w] for w in anchors if w in places], n, len(words))
            if not len(starts):
                continue
            sums = np.r_[0.0, np.cumsum(gain[codes])]
            bound = (sums[starts + n] - sums[starts]) / (np.sqrt(squares[starts + n] - squares[starts]) * norm)
            chance = np.flatnonzero(bound >= self.least - 1e-6)
            seen = set()
            for i in chance[np.argsort(-bound[chance], kind="stable")].tolist():
                if bound[i] < found[0] - 1e-6:
                    break
                run = tuple(words[starts[i] : starts[i] + n])
                if run in seen:
                    continue
                seen.add(run)
                if signs(run) != own:
                    continue
                vector, length = self.weights.vector_of(run)
                score = min(sum(v * other.get(t, 0.0) for t, v in vector.items()) / (length * norm), 1.0)
                if score >= self.least:
                    found = max(found, (score, n, name), key=_rank)
        return found

    @staticmethod
    def _starts(places: list[list[int]], n: int, size: int) -> np.ndarray:
        """Where runs of ``n`` words begin that hold one of the places."""
        if not places or n > size:
            return np.zeros(0, np.int64)
        change = np.zeros(size + 1, np.int64)
        for p in places:
            at = np.array(p)
            np.add.at(change, np.maximum(at - n + 1, 0), 1)
            np.add.at(change, at + 1, -1)
        return np.flatnonzero(np.cumsum(change)[: size - n + 1] > 0)

    def scan(self, text: str) -> Match:
        """The best match of a text: of its lines, of the whole, and of all runs of words."""
        words = terms(text)
        if self.any_anchor.isdisjoint(words):
            return NO_MATCH
        lines = [terms(line) for line in text.split("\n")]
        parts = [*(line for line in lines if not self.any_anchor.isdisjoint(line)), words]
        best = max(*map(self.match, parts), self.window(words), key=_rank)
        return best if best[0] >= self.least else NO_MATCH


def _scan(weights: Weights, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(weights, least)
        for batch in batches:
            found = [templates.scan(text.as_py()) for text in batch.column("_text")]
            names = pa.array([name for _, _, name in found], pa.string())
            scores = pa.array([score if name else None for score, _, name in found], pa.float64())
            columns = [batch.column(c) for c in ("_id", "_hash", "_path")]
            yield pa.RecordBatch.from_arrays([*columns, names, scores], [*KEY, "path", "own", "cosine"])

    return run


def directory(path: Column) -> Column:
    """Everything before the last slash; a path without one lies in the root, whose name is empty."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(folder: str) -> Column:
    """The folder and all above it, the root last, each with its depth."""
    parts = F.when(F.col(folder) == "", F.array().cast("array<string>")).otherwise(F.split(folder, "/"))
    up = F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")),
    )
    return F.inline(up)


def scan_licences(docs: DataFrame, path: Column, is_licence_file: Column | None = None, least: float = LEAST_COSINE) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, path, own, cosine, licence, inherited_from.

    ``own`` is the licence of the best match, over all lines, the whole text and all runs of as many words as a notice
    has, with a cosine of ``least`` or more and the notice's own telling words and versions; of equal ones the longer
    notice counts. Where nothing matches, both are null.
    ``licence`` is that, or else the one of the nearest directory at or above the file's with a licence file that has
    one; ``inherited_from`` names that directory (the root is empty). Of several licence files in a directory the
    licence that most of them have counts, ties by name. By default a file's name makes it a licence file; a condition
    over ``path`` and ``own`` may replace that. Null and empty texts match nothing; a null path lies in the root. Rows
    that repeat are all kept. An empty table gives no rows; columns not named are not read.
    """
    is_licence_file = F.col("path").rlike(LICENCE_FILE) if is_licence_file is None else is_licence_file
    texts = docs.select(
        F.coalesce("doc_id", F.lit(NULL_ID)).alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"),
        F.coalesce(path, F.lit("")).alias("_path"), F.coalesce("text", F.lit("")).alias("_text"),
    )
    weights = corpus_weights(texts)
    found = written(texts.mapInArrow(_scan(weights, least), "_id long, _hash long, path string, own string, cosine double"))

    per_name = found.filter(F.col("own").isNotNull() & is_licence_file).groupBy(directory(F.col("path")).alias("above"), "own").count()
    licensed = per_name.groupBy("above").agg(F.min(F.struct((-F.col("count")).alias("n"), F.col("own").alias("name")))["name"].alias("granted"))
    licensed = written(licensed)
    folders = found.filter("own IS NULL").select(directory(F.col("path")).alias("folder")).distinct()
    nearest = folders.select("folder", ancestors("folder")).join(licensed, "above")
    nearest = nearest.groupBy("folder").agg(F.max(F.struct("depth", "above", "granted")).alias("best"))
    nearest = written(nearest.select("folder", F.col("best.above").alias("from"), F.col("best.granted").alias("granted")))
    out = found.withColumn("_folder", F.when(F.col("own").isNull(), directory(F.col("path"))))
    out = out.join(nearest, F.col("_folder") == F.col("folder"), "left")
    return out.select(
        public_id().alias("doc_id"), "path", "own", "cosine", F.coalesce("own", "granted").alias("licence"), F.col("from").alias("inherited_from")
    )
