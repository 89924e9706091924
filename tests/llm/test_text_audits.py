"""License scan, spelling variants and filter audit against their plain versions: a small table, and hand-made rows with
nulls, empty and long texts, repeated rows, ties, hot groups and columns with clashing names."""

import random
import re

import numpy as np
import pytest

import brute
from brute import SF_SMALL
from riskframe.llm import filter_audit, license_rules, license_scan, queries, spelling
from test_operators import DOCS, edge_texts, same

RULES = license_rules.rules()


def licence(docs):
    return brute.op11(docs, RULES, license_scan.PHRASES, license_rules.STRENGTH, license_scan.NAME_TIER, license_rules.SIDE)


def licence_texts():
    return ["Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "THE MIT LICENSE (MIT)\nmit\x00license",
            "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
            "This work is licensed under the GNU General Public License, version 3.", "general public license general public license",
            "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: Apache-2.0 OR MIT", "gnu lgplv3, agplv3; GPLv2 or later",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation",
            "Copyright (c) 2019 2020 A. B. Inc. All rights reserved. Unauthorized copying", "license", "License license LICENCE licensed",
            "Neither the name of X nor Y may be used to endorse or promote products derived from this software without prior copyright",
            "the MİT license, Kopyright, dedicated to the public domain", "mit license " * 700, "the mit license apache license " * 300,
            "do what the fuck you want to public license; Creative Commons Attribution-ShareAlike 4.0 dual licensed under the BSD 3-Clause License",
            "European Union Public Licence v1.2, open government licence 3.0, licence ouverte", "word " * 3000 + "mit license",
            "licensed under the elastic license 2.0 or the server side public license"]


@pytest.fixture(scope="module", params=["edge", "small", "none"])
def corpus(request, spark):
    if request.param == "small":
        df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
        return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], df
    if request.param == "none":
        return [], spark.createDataFrame([], DOCS)
    texts = edge_texts() + licence_texts()
    rows = [*enumerate(texts), (6, texts[6]), (None, texts[9]), (None, None), (40, texts[10]), (None, "mit license"), (None, "mit license")]
    return rows, spark.createDataFrame([(d, t, "s", 1, "h", "dk", 1, 2, "id", 3) for d, t in rows], DOCS).repartition(5)


def test_license_scan(corpus):
    rows, df = corpus
    same(license_scan.license_labels(df), licence(rows))


def test_license_scan_uses_no_python_and_no_shuffle(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = license_scan.license_labels(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_signatures_are_sound():
    assert len(RULES) >= 200 and [r[0] for r in RULES] == list(range(len(RULES)))
    for _, tier, label, anchor, keyword, pattern in RULES:
        assert 0 <= tier < len(license_rules.STRENGTH) and label and pattern.count("@" + anchor) == pattern.count("@") == 1
        assert any(s in anchor for s in license_rules.STEMS) and f" {anchor}" not in keyword
        assert not re.search(r"[*+]|\(\?[^:]|,\}", pattern.replace("[^ ]+", "word"))  # bounded


@pytest.mark.parametrize("text, labels", [
    ("Released under the MIT License.", "mit"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"), ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("the GNU Lesser General Public License v2.1", "gpl,lgpl-2.1"), ("Mozilla Public License, v. 2.0", "mpl-2.0"),
    ("under the terms of the GNU Affero General Public License version 3", "agpl-3.0,gpl"), ("a plain sentence", "")])
def test_license_labels(text, labels):
    assert licence([(1, text)])[0][6] == labels


def test_containment_fold_over_many_detections(spark):
    """More detections than a block, nested and crossing, of all tiers."""
    from pyspark.sql import functions as F

    rnd = random.Random(8)
    found = []
    for rule in range(1_500):
        first = rnd.randrange(2_000)
        found.append((first, first + rnd.choice((0, 1, 2, 5, 30)), rnd.randrange(5), rule, f"l{rule % 7}"))
    df = spark.createDataFrame([([(*d, False) for d in found],), ([],)], f"found array<{license_scan.SPAN}>")
    got = [[tuple(d) for d in r.k] for r in df.select(license_scan.resolved(F.col("found")).alias("k")).collect()]
    expected = []
    for e in found:
        inside = any(o != e and o[0] <= e[0] and o[1] >= e[1] and o[2] <= e[2] and (o[:2] != e[:2] or o[2:4] < e[2:4]) for o in found)
        if not inside and not any(o[2] < e[2] and (o[0] <= e[0] <= o[1] or o[0] <= e[1] <= o[1]) for o in found):
            expected.append(e)
    assert sorted(got, key=len) == [[], sorted(expected)] and len(expected) > 100


def test_spelling_variants(corpus):
    rows, df = corpus
    same(spelling.variants(df), brute.op12(rows))


def test_spelling_variants_of_many_occurrences(spark):
    """Words near each other in every way, chains of forms, ties, one hot half, cut into several groups as well."""
    rnd = random.Random(5)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(6, 9))) for _ in range(700)}
    words |= {"internat" + "".join(rnd.choice("xyz") for _ in range(rnd.randint(4, 7))) for _ in range(300)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "z" * 3_000, "z" * 2_999, "z" * 1_500 + "y" + "z" * 1_500, "ÀÉÎõü÷×"}
    words = sorted(words)
    rows = [(i, " ".join([w] * (5 * 5 ** (i % 4)) + [w[:3] + "-"])) for i, w in enumerate(words) if len(w) < 100]
    rows += [(10_000 + i, " ".join([w] * 5)) for i, w in enumerate(words) if len(w) >= 100]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    expected = brute.op12(rows)
    assert max(e[4] for e in expected) > 5 and any(e[2] not in (e[0], e[1]) for e in expected)
    for symbols in (1 << 18, 2_000):
        same(spelling.variants(df, symbols), expected)


def test_bidirectional_intervals_stay_in_step():
    rnd = random.Random(6)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 7))) for _ in range(120)})
    index, text = spelling.Index(words), "\x00" + "\x00".join(words) + "\x00"
    for _ in range(200):
        at = rnd.randrange(len(text) - 4)
        pattern, lo, hi, rlo = text[at], np.zeros(1, np.int64), np.full(1, index.n, np.int64), np.zeros(1, np.int64)
        code = lambda c: np.array([int(np.searchsorted(index.alphabet, ord(c)))])
        lo, hi, rlo = index.to_left(lo, hi, rlo, code(pattern))
        a = b = at
        while len(pattern) < 4 and a > 0 and b < len(text) - 1:
            if rnd.random() < 0.5:
                a -= 1
                lo, hi, rlo = index.to_left(lo, hi, rlo, code(text[a]))
            else:
                b += 1
                lo, hi, rlo = index.to_right(lo, hi, rlo, code(text[b]))
            pattern = text[a:b + 1]
        suffixes = sorted(text[i:] for i in range(len(text)))
        mirrored = sorted(text[::-1][i:] for i in range(len(text)))
        assert [i for i, s in enumerate(suffixes) if s.startswith(pattern)] == list(range(lo[0], hi[0]))
        assert next(i for i, s in enumerate(mirrored) if s.startswith(pattern[::-1])) == rlo[0]


def audit_rows():
    rnd = random.Random(9)
    base = " ".join(f"w{rnd.randrange(900)}" for _ in range(260))
    texts = [None, "", "short", base, base, base.upper(), base + " # $", "same " * 300, "A B " * 150, base + " x", "\x0b\x1c" + base, "  " + base]
    rows = [(i, t, ("en", "de", None, "")[i % 4]) for i, t in enumerate(texts)]
    rows += [(3, base, "en"), (3, base, "en"), (None, base, "en"), (None, base + " only null", "fr"), (None, base + " only null", "fr"),
             (None, None, None), (70, base + " # $", "fr"), (71, base + " x", "fr"), (2, "other " + base, "de")]
    labels = [(3, 1, 0), (4, 1, 1), (4, 0, 0), (7, 0, 1), (None, 1, 1), (8, None, 1), (70, 1, None), (2, 1, 0), (500, 1, 1)]
    return rows, labels


def test_filter_audit(spark):
    rows, labels = audit_rows()
    docs = spark.createDataFrame([(*r, "m", 1, 2) for r in rows], "doc_id long, text string, lang string, mask string, n int, first int").repartition(5)
    marks = spark.createDataFrame([(*x, "p") for x in labels], "doc_id long, quality int, toxic int, part string")
    same(filter_audit.audit(docs, marks), brute.op13(rows, labels))
    same(filter_audit.audit(docs, marks.limit(0)), brute.op13(rows, []))
    same(filter_audit.audit(docs.limit(0), marks), [])


def test_filter_audit_of_a_table(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    expected = brute.op13([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()],
                          [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    same(filter_audit.audit(docs, labels), expected)


def test_filter_audit_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "HELD_PARTS", 2)
    rows = [(i, "t " * (i % 5), f"p{i % 40}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 300, 2)]
    marks = spark.createDataFrame([(a, b, int(c)) for a, b, c in labels], "doc_id long, quality int, toxic int")
    same(filter_audit.audit(docs, marks), brute.op13(rows, labels))


def test_positional_counts():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 4, 1000, 65_536):
        words = rnd.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        assert filter_audit.positional_counts(words).tolist() == [int((words >> np.uint32(b) & 1).sum()) for b in range(32)]
    assert all(w & 1 for w in filter_audit.truth_words().tolist())


def test_queries_are_registered():
    assert {"op11_license_scan", "op12_spelling_variants", "op13_filter_audit"} <= set(queries.QUERIES)
