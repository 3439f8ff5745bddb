"""Licence scans: sparse TF-IDF cosine of sentences to templates, then inheritance from the nearest directory.

Sentences with a trigger word are compared with short templates of notices. Document frequencies of all
their terms are counted over the sentences of the corpus that have a trigger; a term in fewer than one of
``RARE`` sentences weighs as one in ``RARE``, so weights follow shares of sentences, not the size of the corpus. A file whose
words are mostly notices, or that is named like a licence file, licenses its directory; a file
without a notice of its own takes the licence of its nearest ancestor directory that has one.

A sentence may run over line breaks, so runs of lines are compared as well as single ones. Whole texts and
leading comment blocks are compared with full licence texts (``licenses/``, with logarithmic term counts); a match of those goes before one
of a sentence. The Affero text is made from that of the GPL by its name.

Ancestors are resolved for distinct directories, not for files, so the path joins see each
directory once; files then look up their own directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from importlib import resources

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.common import lookup, stored, word_count

THRESHOLD = 0.8
FILE_SHARE = 50
RARE = 16
TRIGGER = r"(?i)licen[sc]|copyright|spdx|public domain|creative commons|\bcc[ -]by|\bcc0|\bgpl|permission is hereby granted|redistribution and use"
FILE_NAME = r"(?i)^(un)?licen[sc]e|^copying"
#: The same over line breaks and comment marks.
WRAPPED = TRIGGER.replace("[ -]", " ").replace(" ", "[^A-Za-z0-9]+")
LEAD = r"^[ \t]*(?:/?\*+/?|//+!?|#+!?|;+|--+|%+|<!--|-->)?[ \t]*"
#: Possessive, so that terms of any length are matched without recursion.
TERM = r"[a-z0-9]++(?:[.+-][a-z0-9]++)*+"
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3 of the License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Released under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    *((f"CC-BY{short}-4.0", f"This work is licensed under a Creative Commons Attribution{long} 4.0 International License.")
      for short, long in (("", ""), ("-SA", "-ShareAlike"), ("-NC", "-NonCommercial"), ("-ND", "-NoDerivatives"), ("-NC-SA", "-NonCommercial-ShareAlike"), ("-NC-ND", "-NonCommercial-NoDerivatives"))),
    *((f"CC-BY-{x}-4.0", f"Licensed under CC BY-{x} 4.0.") for x in ("ND", "NC-SA", "NC-ND")),
    ("CC0-1.0", "Released under CC0 1.0 into the public domain."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    *((name, f"This program is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation{tail}")
      for name, mark, kind, v in (("GPL-2.0", ";", "", "2"), ("GPL-3.0", ":", "", "3"), ("LGPL-2.1", ";", "Lesser ", "2.1"), ("LGPL-3.0", ":", "Lesser ", "3"), ("AGPL-3.0", ":", "Affero ", "3"))
      for tail in (f"; either version {v} of the License, or (at your option) any later version.", f", version {v} of the License.")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    *((name, f"SPDX-License-Identifier: {name}") for name in ("MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "ISC", "CC0-1.0")),
]


def sentences(text: Column) -> Column:
    """The sentences (ended by a line, or by . ! ? and white space) that have a trigger; none for most texts."""
    some = F.filter(F.split(text, r"(?<=[.!?])[ \t]+|[\r\n]+"), lambda s: s.rlike(TRIGGER))
    return F.when(text.rlike(TRIGGER), some).otherwise(F.array().cast("array<string>"))


def terms(sentence: Column) -> Column:
    return F.regexp_extract_all(F.lower(sentence), F.lit(TERM), F.lit(0))


def full_texts() -> list[tuple[str, str]]:
    """Name and text of the full licences."""
    files = sorted((f for f in resources.files(__package__).joinpath("licenses").iterdir() if f.name.endswith(".txt")), key=lambda f: f.name)
    texts = {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8") for f in files}
    affero = re.sub(r"(?i)(GNU)(\s+)(General)", r"\1 Affero\2\3", texts["GPL-3.0"])
    affero = affero.replace("Use with the GNU Affero Affero", "Remote Network Interaction; Use with the GNU").replace("29 June", "19 November")
    return sorted((texts | {"AGPL-3.0": affero}).items())


def fragments(text: str) -> list[tuple[str, bool]]:
    """Sentences cut at line breaks, and whether each goes on in the next line."""
    lines = re.split(r"\r\n|\r|\n", text)
    out = []
    for line, after in zip(lines, [*lines[1:], ""]):
        parts = re.split(r"(?<=[.!?])[ \t]+", line)
        out += [(x, False) for x in parts[:-1]]
        out.append((parts[-1], not parts[-1].endswith((".", "!", "?")) and re.search(r"\w", line) is not None and re.search(r"\w", after) is not None))
    return out


def runs(parts: list[tuple[str, bool]], most: int) -> Iterator[tuple[int, int, str]]:
    """First and last fragment, and text, of every run with a trigger: single fragments, and those joined over line breaks up to ``most`` words."""
    trigger = re.compile(TRIGGER)
    for i in range(len(parts)):
        held, size = "", 0
        for j in range(i, len(parts)):
            size += len(parts[j][0].split())
            if j > i and size > most:
                break
            held = f"{held} {re.sub(LEAD, '', parts[j][0])}" if j > i else parts[j][0]
            if trigger.search(held):
                yield i, j, held
            if not parts[j][1]:
                break


def header(text: str) -> str:
    """The leading block of comment lines, without their marks."""
    lines, inside = [], False
    for line in re.split(r"\r\n|\r|\n", text):
        inside = inside or line.lstrip().startswith(("/*", "<!--"))
        if not inside and line.strip() and not re.match(LEAD, line).group().strip():
            break
        lines.append(re.sub(LEAD, "", line))
        inside = inside and "*/" not in line and "-->" not in line
    return "\n".join(lines)


class Notices:
    """The notices of a text under given document frequencies."""

    def __init__(self, frequency: dict[str, int], n: int, full: list[tuple[str, str]], threshold: float) -> None:
        self.short, self.full, self.threshold = Scorer(frequency, n), Scorer(frequency, n, full, True), threshold
        self.most = 2 * max(len(x.split()) for _, x in TEMPLATES)

    def of(self, text: str) -> tuple[str | None, float | None, int]:
        """Licence and cosine of the best match, and the number of words in notices."""
        hits, covered, whole = [], set(), 0
        for t in {text, header(text)}:
            k, c = self.full.best(t)
            if k is not None and c >= self.threshold:
                hits.append((0, -round(c, 9), k, c))
                whole = max(whole, len(t.split()))
        parts = fragments(text)
        for i, j, s in runs(parts, self.most):
            k, c = self.short.best(s)
            if k is not None and c >= self.threshold:
                hits.append((1, -round(c, 9), k, c))
                covered.update(range(i, j + 1))
        top = min(hits, default=(1, 0.0, None, None))
        return top[2], top[3], max(whole, sum(len(parts[i][0].split()) for i in covered))


class Scorer:
    """Cosines of sentences to all templates under given document frequencies."""

    def __init__(self, frequency: dict[str, int], n: int, texts: list[tuple[str, str]] = TEMPLATES, log_counts: bool = False) -> None:
        self.find = re.compile(TERM).findall
        self.names = [name for name, _ in texts]
        self.n, self.frequency, self.log_counts = n, frequency, log_counts
        self.inverted: dict[str, list[tuple[int, float]]] = {}
        for k, (_, text) in enumerate(texts):
            for term, w in self._vector(text).items():
                self.inverted.setdefault(term, []).append((k, w))

    def _vector(self, text: str) -> dict[str, float]:
        tf = Counter(self.find(text.lower()))
        w = {t: (1 + math.log(c) if self.log_counts else c) * (1 + math.log((1 + self.n) / (1 + max(self.frequency.get(t, 0), self.n / RARE)))) for t, c in tf.items()}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        return {t: x / norm for t, x in w.items()}

    def best(self, sentence: str) -> tuple[str | None, float]:
        """The template's licence of the highest cosine; the first name in order at a tie."""
        got: dict[int, float] = {}
        for t, x in self._vector(sentence).items():
            for k, w in self.inverted.get(t, ()):
                got[k] = got.get(k, 0.0) + x * w
        if not got:
            return None, 0.0
        k = min(got, key=lambda k: (-round(got[k], 9), self.names[k]))
        return self.names[k], min(1.0, got[k])


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(id, path, text)`` to ``id, path, own_license, own_score, license, origin, license_dir``; a row each.

    ``origin`` is ``own``, ``inherited`` or ``none``. A sentence or text under ``threshold`` is no notice.
    Several notices in a file: full licence texts before sentences, then the highest cosine, then the first name. Several licence files in a
    directory: the highest cosine, then the first path. Null texts have no notice; a null path lies in
    the root directory, whose name is empty. Repeated rows come out alike. An empty table gives no rows.
    """
    path = F.coalesce("path", F.lit(""))
    found = files.select(F.col("id").cast("long").alias("id"), "path", word_count(F.col("text")).alias("n_words"), sentences(F.coalesce("text", F.lit(""))).alias("said"), F.when(F.col("text").rlike(WRAPPED), F.col("text")).alias("text"))
    found = stored(found.withColumn("dir", F.regexp_replace(path, "/?[^/]*$", "")), "notices")
    said = found.where(F.size("said") > 0).select(F.explode("said").alias("s"))
    n = said.count()
    # All terms are counted; those at or under the floor weigh the same, so only terms of more than one in RARE
    # sentences reach the driver: at most RARE times the mean number of terms of a sentence.
    terms_of = said.select(F.explode(F.array_distinct(terms(F.col("s")))).alias("t"))
    frequency = {r["t"]: r["count"] for r in terms_of.groupBy("t").count().where(F.col("count") * RARE > n).collect()}

    full = full_texts()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notices = Notices(frequency, n, full, threshold)
        for b in batches:
            got = list(zip(*map(notices.of, b.column(4).to_pylist()))) or [(), (), ()]
            columns = [*b.columns[:4], *(pa.array(x, t) for x, t in zip(got, (pa.string(), pa.float64(), pa.int64())))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "path", "dir", "n_words", "own_license", "own_score", "notice_words"])

    noticed = found.where("text IS NOT NULL").select("id", "path", "dir", "n_words", "text")
    with_notice = noticed.mapInArrow(run, "id long, path string, dir string, n_words long, own_license string, own_score double, notice_words long")
    without = found.where("text IS NULL").select("id", "path", "dir", "n_words", F.lit(None).cast("string").alias("own_license"), F.lit(None).cast("double").alias("own_score"), F.lit(0).cast("long").alias("notice_words"))
    own = stored(with_notice.unionByName(without), "own")
    is_file = F.element_at(F.split(F.coalesce("path", F.lit("")), "/"), -1).rlike(FILE_NAME) | (F.col("notice_words") * 100 >= F.col("n_words") * FILE_SHARE)
    licensed = own.where(F.col("own_license").isNotNull() & is_file).groupBy(F.col("dir").alias("at")).agg(F.min_by("own_license", F.struct(-F.round("own_score", 9), "path", "own_license")).alias("dir_license"))
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, F.lit(1), i), "/").alias("at")))
    dirs = own.select("dir").distinct().select("dir", F.explode(ancestors).alias("a")).select("dir", F.col("a.depth").alias("depth"), F.col("a.at").alias("at"))
    # The root is an ancestor of every directory, and one directory may hold a third of all files.
    licensed = stored(licensed, "licensed")
    near = lookup(dirs, licensed, "at", F.col("dir"), "inner").groupBy("dir").agg(F.max_by(F.struct("dir_license", "at"), "depth").alias("near"))
    out = lookup(own, stored(near, "near"), "dir", F.concat_ws(" ", "path", F.col("id").cast("string")))
    mine = F.col("own_license").isNotNull()
    return out.select(
        "id", "path", "own_license", "own_score",
        F.when(mine, F.col("own_license")).otherwise(F.col("near.dir_license")).alias("license"),
        F.when(mine, "own").when(F.col("near").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~mine, F.col("near.at")).alias("license_dir"),
    )
