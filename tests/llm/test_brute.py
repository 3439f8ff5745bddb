"""Operators with no SQL form against their definitions written out in plain Python, and hard texts for all of them."""

import datetime
import hashlib
import math
import random
import re
import struct
import time
import zlib

import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from loomtext.llm import bpe, embed_dedup, license_scan, mixing, pii, quality, simhash, suffix_dedup, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _xx(*parts, seed=42):
    """Spark's xxhash64 of texts, longs and ints (ints come as a tuple)."""
    h = seed
    for p in parts:
        data = p.encode() if isinstance(p, str) else struct.pack("<i", p[0]) if isinstance(p, tuple) else struct.pack("<q", p)
        h = xxhash.xxh64_intdigest(data, h & (2**64 - 1))
    return h - 2**64 if h >> 63 else h


# --- 6 personal data ---


def _hex(key, *parts):
    return hashlib.sha256(":".join((key, *map(str, parts))).encode()).hexdigest()


def _permuted(left, right, lsize, rsize, kind, key):
    for i in range(pii.ROUNDS):
        if i % 2 == 0:
            left = (left + int(_hex(key, kind, i, right)[:12], 16) % lsize) % lsize
        else:
            right = (right + int(_hex(key, kind, i, left)[:12], 16) % rsize) % rsize
    return left, right


def _luhn(s):
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(int(c) for c in reversed(s))) % 10


def _fill(m, digits):
    it = iter(digits)
    return "".join(next(it) if c in "0123456789" else c for c in m)


def _card(m, key):
    def one(x):
        d = re.sub(r"\D", "", x)
        if _luhn(d):
            return None
        u = (len(d) - 2) // 2
        v = len(d) - 2 - u
        a, b = _permuted(int(d[1 : 1 + u]), int(d[1 + u : 1 + u + v]), 10**u, 10**v, "card", key)
        head = f"{d[0]}{a:0{u}}{b:0{v}}"
        return _fill(x, head + str((10 - _luhn(head + "0")) % 10))

    if re.fullmatch(r"[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{3}", m):
        return (one(m[:19]) + m[19:]) if one(m[:19]) else one(m) or m
    return one(m) or m


def _pseudonym(m, key):
    full = lambda p: re.fullmatch(p, m)
    if "@" in m:
        return f"u{_hex(key, 'mail', m.lower())[:12]}@mail.invalid"
    if full(pii.IPV4):
        o = list(map(int, m.split(".")))
        a, b = _permuted(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ip", key)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    for p, f in ((pii.ISO_DATE, "%Y-%m-%d"), (pii.US_DATE, "%m/%d/%Y"), (pii.DOT_DATE, "%d.%m.%Y")):
        if full(p):
            try:
                n = (datetime.datetime.strptime(m, f).date() - datetime.date(1800, 1, 1)).days
            except ValueError:
                return m
            if not 0 <= n < pii.DAYS:
                return m
            a, b = _permuted(n // pii.DAY_RIGHT, n % pii.DAY_RIGHT, pii.DAY_LEFT, pii.DAY_RIGHT, "date", key)
            return (datetime.date(1800, 1, 1) + datetime.timedelta(a * pii.DAY_RIGHT + b)).strftime(f)
    if full(pii.SSN):
        area, group, serial = map(int, m.split("-"))
        if not (1 <= area <= 899 and area != 666 and group and serial):
            return m
        a, b = _permuted(area - (1 if area < 666 else 2), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn", key)
        a += 1 if a + 1 < 666 else 2
        return f"{a:03}-{b // 9999 + 1:02}-{b % 9999 + 1:04}"
    if full(pii.PHONE):
        d = re.sub(r"\D", "", m)
        area, exchange, line = int(d[-10:-7]), int(d[-7:-4]), int(d[-4:])
        lo = [0 if x < 200 else 200 for x in (area, exchange)]
        size = [200 if x < 200 else 800 for x in (area, exchange)]
        a, b = _permuted((area - lo[0]) * size[1] + exchange - lo[1], line, size[0] * size[1], 10000, f"phone{lo[0]}-{lo[1]}", key)
        return _fill(m, f"{d[:-10]}{a // size[1] + lo[0]:03}{a % size[1] + lo[1]:03}{b:04}")
    if full(pii.CARD):
        return _card(m, key)
    out = _hex(key, "secret", m.lower())[: len(m)]
    return out.upper() if m == m.upper() else out


def _pii_texts():
    rng = random.Random(12)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        body = rng.choice("3456") + d(rng.choice([13, 14, 14, 14]))
        return body + next(c for c in "0123456789" if _luhn(body + c) == 0)

    kinds = [
        card, lambda: (lambda c: f"{c[:4]} {c[4:8]} {c[8:12]} {c[12:]}")(card()), lambda: d(16), lambda: f"{d(4)}-{d(4)}-{d(4)}-{d(4)}",
        lambda: f"+1 ({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"{d(3)}.{d(3)}.{d(4)}", lambda: ".".join(str(rng.randint(0, 300)) for _ in range(4)),
        lambda: f"{rng.randint(1700, 2300)}-{rng.randint(0, 13):02}-{rng.randint(0, 32):02}", lambda: f"{rng.randint(1, 13):02}/{rng.randint(1, 31):02}/{rng.randint(1790, 2210)}", lambda: f"{rng.randint(1, 31):02}.{rng.randint(1, 12):02}.1999",
        lambda: f"{rng.choice(['000', '666', '901', d(3)])}-{d(2)}-{d(4)}", lambda: f"{rng.choice('abc')}.x@{rng.choice(['Ex', 'b-c'])}.example.com", lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40)),
        lambda: "".join(rng.choice("0123456789ABCDEF") for _ in range(32)), lambda: rng.choice(["word", "É", "2024", "12", "v1.2.3", "x@", "-", "(", "1 2 3"]),
    ]
    return ["".join(rng.choice(kinds)() + rng.choice([" ", ", ", "\n", " / ", ".", " - "]) for _ in range(rng.randint(0, 9))) for _ in range(400)]


def test_pii_by_definition(spark):
    texts = _pii_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("a.b", F.lit(1))
    find = re.compile(pii.ANY)
    want = {}
    for i, t in enumerate(texts):
        pairs = [(m.group(), _pseudonym(m.group(), "k1")) for m in find.finditer(t)]
        want[i] = (find.sub(lambda m: _pseudonym(m.group(), "k1"), t), sum(a != b for a, b in pairs))
    got = {r.doc_id: (r.text, r.n_pii) for r in pii.pseudonymise(df, key="k1").collect()}
    assert {i: (got[i], texts[i]) for i in got if got[i] != want[i]} == {} and len(got) == len(texts)
    assert sum(n for _, n in want.values()) > 500
    other = {r.doc_id: r.text for r in pii.pseudonymise(df, key="k2").collect()}
    assert sum(other[i] != got[i][0] for i in got) > 200


def test_pii_key_of_the_session(spark):
    df = spark.createDataFrame([(1, "2020-02-29")], "doc_id long, text string")
    one = pii.pseudonymise(df).first().text
    spark.conf.set(pii.KEY_SETTING, "mine")
    try:
        assert pii.pseudonymise(df).first().text == pii.pseudonymise(df, key="mine").first().text != one
    finally:
        spark.conf.unset(pii.KEY_SETTING)


def test_phones_stay_valid(spark):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.format_string("%03d-%03d-1234", (F.col("id") * 37) % 1000, (F.col("id") * 91) % 1000).alias("text"))
    both = {r.text for r in df.collect()}, pii.pseudonymise(df, count=None).collect()
    assert len({r.text for r in both[1]}) == len(both[0])
    for old, new in zip(sorted(df.collect()), sorted(both[1], key=lambda r: r.doc_id)):
        assert [x >= "200" for x in old.text.split("-")[:2]] == [x >= "200" for x in new.text.split("-")[:2]]


# --- 7 quality ---


def test_quality_by_definition(spark):
    rng = random.Random(4)
    good, bad = ["alpha", "beta", "Gamma", "delta", "É"], ["zig", "zag", "beta", "noise"]
    rows = [(i, " ".join(rng.choice(good if i % 3 else bad) + str(rng.randint(0, 99)) for _ in range(rng.choice([10, 60, 200])))) for i in range(90)]
    rows += [(90, None), (91, ""), (None, rows[0][1]), (1, rows[1][1])]
    labels = [(i, int(i % 3 > 0)) for i in range(0, 90, 2)] + [(2, 1), (None, 1), (5, None)]

    def grams(t):
        h = [_xx(w.lower()) for w in WORD.findall(t or "")]
        return [x % quality.BUCKETS for x in h] + [_xx(a, b) % quality.BUCKETS for a, b in zip(h, h[1:])]

    trusted = {i for i, q in labels if i is not None and q == 1}
    counts = lambda some: __import__("collections").Counter(b for t in some for b in grams(t))
    target, raw = counts(t for i, t in rows if i in trusted), counts(t for _, t in rows)
    sums = sum(target.values()) + quality.BUCKETS, sum(raw.values()) + quality.BUCKETS
    weight = [math.log((target[b] + 1) / sums[0]) - math.log((raw[b] + 1) / sums[1]) for b in range(quality.BUCKETS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(quality.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.n_words))
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    kept = 0
    for r, (i, t) in zip(got, want):
        g = grams(t)
        score = sum(weight[b] for b in g) / len(g) if g else None
        assert r.doc_id == i and (r.score is None) == (score is None) and (score is None or abs(r.score - score) < 1e-9)
        assert r.kept == (not r.base_failed and score >= quality.THRESHOLD)
        kept += r.kept
    assert 10 < kept < 70


# --- 8 licences ---


def _scan_brute(files, threshold):
    """TF-IDF cosines of single lines' sentences to the sentence templates, over dictionaries."""
    trigger, term = re.compile(license_scan.TRIGGER), re.compile(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*")
    said = [s for _, _, t in files for s in re.split(r"(?<=[.!?])[ \t]+|[\r\n]+", t or "") if trigger.search(s)]
    df = {}
    for s in said:
        for x in set(term.findall(s.lower())):
            df[x] = df.get(x, 0) + 1

    def vector(s):
        words = term.findall(s.lower())
        v = {x: words.count(x) * (1 + math.log((1 + len(said)) / (1 + max(df.get(x, 0), len(said) / license_scan.RARE)))) for x in words}
        norm = math.sqrt(sum(y * y for y in v.values()))
        return {x: y / norm for x, y in v.items()}

    out = {}
    for i, _, t in files:
        best = (0.0, None)
        for s in re.split(r"(?<=[.!?])[ \t]+|[\r\n]+", t or ""):
            if trigger.search(s):
                v = vector(s)
                for name, template in license_scan.TEMPLATES:
                    w = vector(template)
                    c = round(sum(y * w.get(x, 0.0) for x, y in v.items()), 9)
                    if c >= threshold and (-c, name) < (-best[0], best[1] or ""):
                        best = (c, name)
        out[i] = best
    return out


def test_license_cosines_by_definition(spark):
    rng = random.Random(1)
    pool = [t for _, t in license_scan.TEMPLATES if len(t) < 150]

    def damaged(t):
        w = t.split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(["module", "our", "work", "version", "2.0", "license"])
        return " ".join(w)

    files = [(i, f"d{i}/x.txt", f"some text here.\n\n{damaged(rng.choice(pool))}\n\nmore words follow") for i in range(120)]
    want = _scan_brute(files, license_scan.THRESHOLD)
    df = spark.createDataFrame(files, "id long, path string, text string").repartition(3)
    got = {r.id: (round(r.own_score or 0.0, 9), r.own_license) for r in license_scan.scan(df).collect()}
    assert got == want and 20 < sum(k is not None for _, k in want.values()) < 120


REAL = [
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("Apache-2.0", 'Copyright 2020 Jane Doe\n\nLicensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software'),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or\nmodify it under the terms of the GNU General Public License\nas published by the Free Software Foundation; either version 2\nof the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This file is part of Foo. Foo is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software."),
    (None, "Our terms of service changed; the licence fee for the driver is paid each year."),
    (None, "The copyright office opened at nine, and the license plates were handed out free of charge to any person."),
]


def test_real_notices(spark):
    df = spark.createDataFrame([(i, f"d{i}/LICENSE", t) for i, (_, t) in enumerate(REAL)], "id long, path string, text string")
    got = {r.id: r.own_license for r in license_scan.scan(df).collect()}
    assert [got[i] for i in range(len(REAL))] == [k for k, _ in REAL]


# --- 10 toxicity ---


def _tox_features(text):
    table = {c: 32 for c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"}
    words = (text or "").lower().encode().translate(bytes(table.get(c, c) for c in range(256))).split()
    m64, k = 2**64 - 1, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
    h = list(map(zlib.crc32, words))
    found = [x * k[0] for x in h]
    found += [zlib.crc32(w[:n], n) * k[0] for w in words for n in (4, 5) if len(w) > n]
    found += [(a * k[1] + b) * k[0] for a, b in zip(h, h[1:])] + [(a * k[2] + b) * k[0] for a, b in zip(h, h[2:])]
    return sorted({max(1, (x & m64) >> (64 - toxicity.BITS)) for x in found})


def _ftrl_brute(rows):
    z, n = {}, {}

    def weight(i):
        zi, l1 = z.get(i, 0.0), 0.0 if i == toxicity.BIAS else toxicity.L1
        return 0.0 if abs(zi) <= l1 else -math.copysign(abs(zi) - l1, zi) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for x, y in rows:
            w = {i: weight(i) for i in [toxicity.BIAS, *x]}
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values()))))) - y
            for i, wi in w.items():
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / toxicity.ALPHA * wi
                n[i] = old + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_toxicity_by_definition(spark):
    rng = random.Random(2)
    clean, foul = ["plain", "Words", "here", "today", "café"], ["IDIOT!", "clownish", "lowlife"]
    rows = [(i, " ".join(rng.choice(clean + foul * (i % 4 == 0)) for _ in range(rng.randint(1, 25)))) for i in range(300)]
    labels = [(i, int(i % 4 == 0)) for i in range(240)]
    docs = spark.createDataFrame(rows + [(900, None), (None, "you clownish")], "doc_id long, text string").repartition(3)
    seen = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    text = dict(rows)
    train = sorted((_xx(i, (7,)), y, _tox_features(text[i])) for i, y in seen)
    w = _ftrl_brute([(x, y) for _, y, x in train])
    got = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    text |= {900: None, None: "you clownish"}
    for r in got:
        s = w.get(toxicity.BIAS, 0.0) + sum(w.get(i, 0.0) for i in _tox_features(text[r.doc_id]))
        assert abs(r.score - 1 / (1 + math.exp(-s))) < 1e-9 and r.predicted == int(r.score >= 0.7)
    assert len(w) > 5 and len(got) == 302 and {r.predicted for r in got} == {0, 1}


# --- hard texts ---

HARD = [
    "mail x@" + "a." * 100_000 + "com", "license " + "a-" * 100_000 + "b", " " * 200_000, "a" * 200_000, "1 " * 100_000, "1" * 200_000, "x " + " " * 200_000 + " y", "\n" * 200_000,
    "a.b@" * 50_000, "4111 " * 40_000, "GNU license " * 17_000, "copyright\n" * 20_000, "(((" * 60_000, "é" * 100_000, "- " * 100_000, "a b c " * 33_000 + "license.", ". " * 100_000,
]


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(HARD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)


@pytest.mark.parametrize("name", ["mix", "repeats", "warc", "bpe", "pii", "quality", "licenses", "simhash", "toxicity"])
def test_hard_texts(spark, hard, name):
    """Texts of 200,000 characters that make naive patterns recurse or go back: no crash, a bounded time, a row each."""
    labels = spark.createDataFrame([(0, 1, 1), (2, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
    run = {
        "mix": lambda: mixing.mix_documents(hard).agg(F.count("*")).collect() and hard,
        "repeats": lambda: suffix_dedup.digests(hard),
        "warc": lambda: warc.archive(hard.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"), F.col("text").alias("html")))[1],
        "bpe": lambda: bpe.digests(hard, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
        "pii": lambda: pii.pseudonymise(hard),
        "quality": lambda: quality.quality(hard, labels),
        "licenses": lambda: license_scan.scan(hard.select(F.col("doc_id").alias("id"), F.lit("p").alias("path"), "text")),
        "simhash": lambda: simhash.near_duplicates(hard),
        "toxicity": lambda: toxicity.toxicity(hard, labels),
    }[name]
    began = time.monotonic()
    assert len(run().collect()) == len(HARD)
    assert time.monotonic() - began < 120


def test_long_odd_words_encode_in_bounded_time():
    rng = random.Random(3)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    exact = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    word = bytes(rng.randrange(256) for _ in range(40_000))
    began = time.monotonic()
    assert bpe.Merges(ranks).word(word) == exact._encode_bytes(word)
    assert time.monotonic() - began < 10


def test_embeddings_with_extra_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "x"), (2, [1.0, 0.01], "y")], "vec_id long, embedding array<float>, same string").withColumn("a.b", F.lit(1))
    assert sorted(tuple(r) for r in embed_dedup.near_duplicates(df, recall=0.9999).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_columns_with_dots(spark):
    docs = spark.createDataFrame([(1, "one two 2020-02-29", "s"), (2, "one two 2020-02-29", "s")], "doc_id long, text string, source string").withColumn("a.b`c", F.lit(1)).withColumn("a.b", F.lit(2))
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    for out in (simhash.keep_one(docs), pii.pseudonymise(docs, count=None), mixing.mix_documents(docs), toxicity.reject_toxic(docs, labels)):
        assert out.columns == docs.columns and out.collect()
    assert simhash.keep_one(docs).count() == 1


def test_mix_of_null_and_repeated_ids(spark):
    rows = [(None, "s", i % 5) for i in range(400)] + [(7, "s", 3)] * 300 + [(i, "t", 10) for i in range(50)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(3)
    got = mixing.mix(sizes).collect()
    assert len(got) == len(rows)
    for s in "st":
        mine = [r for r in got if r.source == s]
        assert sum(r.taken for r in mine) == round(mine[0].target) and all(0 <= r.taken <= 2 * r.size for r in mine)
