"""Scans, rules, archives, mixing, the classifier and the pipeline."""

import base64
import hashlib
import re
import zipfile
from collections import Counter
from functools import cache

import numpy as np
import pyarrow.fs as pafs
import regex

from fundlake.llm import warc
from fundlake.llm.licenses import BASE, listed, rules, scan_licenses
from fundlake.llm.mixing import apply_mix, demand_time, mix, mix_copies, targets
from fundlake.llm.quality import OrdinalModel, classify, features, graded, train
from fundlake.llm.rules import quality_rules
from fundlake.llm.secrets import EXAMPLES, scan_secrets
from tests.llm.test_texts import alnum, rows, spaced


# ---- licenses ----

def test_license_base_columns(edge, empty, sample):
    for docs in (edge, sample):
        want = []
        for r in docs.select("doc_id", "text").collect():
            w, at, labels = alnum(r.text), [], set()
            for phrase, label in BASE:
                p = phrase.split()
                found = [k for k in range(len(w) - len(p) + 1) if w[k:k + len(p)] == p]
                at += found
                labels |= {label} if found else set()
            want.append((r.doc_id, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))))
        got = scan_licenses(docs)
        assert rows(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want, key=repr)
    assert scan_licenses(empty).count() == 0


def test_license_rules_and_suppression(spark):
    texts = ["Licensed under the Apache License, Version 2.0.", "see the MIT\n# License and the CC BY-SA 4.0", "an apache helicopter", "All rights reserved."]
    got = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.labels for r in got] == ["apache,apache-2.0", "cc-by,cc-by-sa-4.0,mit", "", "proprietary"]
    assert [(d.at, d.till, d.label) for d in got[0].detections] == [(0, 8, "apache-2.0")], "the name inside the notice is suppressed"
    assert got[0].score == 1.0 and got[2].score == 0.0
    assert len(rules()) > 300


CASES = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
     "(the \"Software\"), to deal in the Software without restriction, including", "mit"),
    ("Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that:\n * 3. Neither the name of X "
     "nor the names of its contributors may be used to endorse or promote products\n * derived from this software", "bsd,bsd-3-clause"),
    ("// SPDX-License-Identifier: MIT OR Apache-2.0\n// or BSD-3-Clause", "spdx-apache-2-0,spdx-mit"),
    ("SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0) AND ISC", "spdx-classpath-exception-2-0,spdx-gpl-2-0-only,spdx-isc"),
    ("SPDX-License-Identifier: BSL-1.1", "spdx-bsl-1-1"),
    ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
     "Foundation, either version 3 of the License, or (at your option) any later version.", "gpl,gpl-3-or-later"),  # gpl: the base label
    ("modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; version 2.1", "lgpl-2.1"),
    ("licensed under GPLv3", "gpl-3"), ("see https://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"), ("GPL v2 code", "gpl-2"),
    ("the SPDX list, MIT or Apache 2.0", ""), ("obtaining a copy of this software", ""), ("a gpl sign", ""), ("everyone is permitted to copy", ""),
]


@cache
def plain_rules():
    return [(regex.compile(rx.replace(r"\x{80}", "\x80").replace(r"\x{10FFFF}", "\U0010FFFF")), label, priority)
            for _, rx, label, priority in rules()]


def plain_detections(text):
    """Every match of every rule, without keywords and prefilter, and of them
    those that no other of equal or higher priority contains."""
    hits = []
    for number, (rx, label, priority) in enumerate(plain_rules()):
        for m in rx.finditer(text):
            at = len(alnum(text[:m.start()]))
            hits.append((at, -at - len(alnum(m.group())), -priority, number, label))
    hits.sort()
    return [(at, -back, label) for k, (at, back, low, _, label) in enumerate(hits)
            if not any(a <= at and b <= back and p <= low for a, b, p, _, _ in hits[:k])]


def test_license_detections_against_plain(spark):
    rng = np.random.default_rng(4)
    phrases = [sorted(examples(p))[0] for _, p, _, _ in listed()]
    mixed = [" ".join(str(x) for k in rng.integers(0, len(phrases), 6) for x in (phrases[k], rng.choice(["and", "v2", "or later", "\n//", "the"]))) for _ in range(60)]
    texts = [t for t, _ in CASES] + mixed
    got = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.labels for r in got[:len(CASES)]] == [x for _, x in CASES]
    for r, text in zip(got, texts, strict=True):
        assert [(d.at, d.till, d.label) for d in r.detections] == plain_detections(text), text


def test_license_detections_of_many_matches(spark):
    text = "copyright x and cc by 4.0, " * 3000
    got = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (got.n_base, got.first_word, got.last_word, len(got.detections)) == (3000, 3, 2999 * 7 + 3, 6000)
    assert [(d.at, d.till) for d in got.detections[-2:]] == [(2999 * 7, 2999 * 7 + 1), (2999 * 7 + 3, 2999 * 7 + 7)]


def examples(phrase):
    """Word sequences that the phrase stands for: each alternative and each optional word at least once."""
    choices = [(t.rstrip("?").split("|"), t.endswith("?")) for t in phrase.split()]
    full, least = [c[0] for c, _ in choices], [None if optional else c[0] for c, optional in choices]
    out = [full, least]
    for k, (c, _) in enumerate(choices):
        out += [[*full[:k], w, *full[k + 1:]] for w in c[1:]]
    return {" ".join(w for w in words if w) for words in out}


def test_license_rules_all_fire(spark):
    wanted = sorted({(text, label) for _, phrase, label, _ in listed() for text in examples(phrase)})
    texts = ["Do What The F*ck You Want To Public License", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE, version 2",
             "This is under the GNU Library\n * General Public Licence", "see the COPYING file, for details", "the Expat License"]
    wanted += list(zip(texts, ["wtfpl", "wtfpl-2", "lgpl", "see-license", "mit"], strict=True))
    given = spark.createDataFrame([(i, f"So: {t}.") for i, (t, _) in enumerate(wanted)], "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.labels.split(",") for r in scan_licenses(given).select("doc_id", "labels").collect()}
    assert [x for i, x in enumerate(wanted) if x[1] not in got[i]] == []


# ---- quality rules ----

def test_quality_rules_against_plain(edge, empty, sample):
    for docs in (edge, sample):
        want = []
        for r in docs.select("doc_id", "text").collect():
            t, w, seen, dup = r.text or "", spaced(r.text), set(), 0
            for line in t.split("\n"):
                if spaced(line):
                    dup += line in seen
                    seen.add(line)
            c = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
            cov = {j for k in range(len(w) - 4) if c[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
            want.append((r.doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cov), len(w) < 10 or 100 * len(cov) > 20 * len(w)))
        got = quality_rules(docs)
        assert rows(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want, key=repr)
        assert not [r for r in got.collect() if r.base_failed and r.kept]
    assert quality_rules(empty).count() == 0


def test_quality_rules_tell_junk_from_prose(spark, sample):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = quality_rules(sample).join(labels, "doc_id").collect()
    clean = [r.kept for r in got if r.quality == 1 and not r.base_failed]
    assert sum(clean) >= 0.95 * len(clean)


# ---- secrets ----

def test_secrets(edge, empty, spark):
    got = scan_secrets(edge).where("doc_id = 8").orderBy("position").collect()
    assert [(r.n_chars, r.is_secret) for r in got] == [(18, True), (16, False), (20, True)]
    text = [r for r in edge.collect() if r.doc_id == 8][0].text
    assert [hashlib.sha256(text[r.position:r.position + r.n_chars].encode()).hexdigest() for r in got] == [r.sha256 for r in got]
    assert scan_secrets(empty).count() == 0
    labelled = spark.createDataFrame([(i, 0, *x[:4], float(x[4])) for i, x in enumerate(EXAMPLES)],
                                     "doc_id long, position long, before string, candidate string, after string, path string, label double")
    assert scan_secrets(edge, findings=labelled).where("doc_id = 8 and is_secret").count() >= 1


# ---- archives ----

def test_packages_round_trip(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "http://a/x y", "<p>same</p>", 1), (5, "http://b/", "<p>same</p>", 1), (3, None, "<p>same</p>", 1), (4, "u", None, 1), (9, "u", "", 1),
                                   (7, "http://l/", "é" * 300_000, 1), (None, "n", "<p>same</p>", 1)], "page_id long, url string, html string, record_type int")
    manifest = warc.write_packages(pages)

    def digest(t):
        return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    last = {"<p>same</p>": 5, "": 9, "é" * 300_000: 7}
    want = [(r.page_id, len((r.html or "").encode()), digest(r.html), "response" if last[r.html or ""] == r.page_id else "revisit",
             None if last[r.html or ""] == r.page_id else last[r.html or ""]) for r in pages.collect()]
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows(warc.read_packages(manifest), *cols) == sorted(want, key=repr)
    assert warc.read_packages(warc.write_packages(pages.where("false"))).count() == 0
    small = warc.write_packages(pages, least_payload=5)
    assert {r.record_type for r in warc.read_packages(small).where("payload_bytes = 0").collect()} == {"response"}


def test_zip64_directory(tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 64)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    path = str(tmp_path / "z.zip")
    body = {f"m{k}.bin": bytes([k]) * (k * 50 + 1) for k in range(6)}
    with zipfile.ZipFile(path, "w") as z:
        for name, data in body.items():
            z.writestr(name, data)
        z.comment = b"a comment PK\5\6 inside"
    with pafs.LocalFileSystem().open_input_file(path) as f:
        members = warc.directory(f)
        assert {m.name: f.read_at(m.size, warc.data_start(f, m)) for m in members} == body


# ---- mixing ----

def test_mix_meets_targets(edge, empty, sample):
    for docs in (edge, sample):
        got = mix(docs).collect()
        assert len(got) == docs.count() and all(0 <= r.taken <= 2 * r.size for r in got)
        by = {}
        for r in got:
            by.setdefault((r.source_size, r.target), []).append(r.taken)
        assert sum(r.size for r in got) * 1.5 - sum(t for _, t in by) <= 1e-6 * sum(r.size for r in got) + 1
        at = sorted((r.position, r.train_time) for r in got if r.position is not None)
        assert [t for _, t in at] == sorted(t for _, t in at), "positions follow the training time"
        assert rows(mix(docs), "doc_id", "taken", "position") == sorted(((r.doc_id, r.taken, r.position) for r in got), key=repr)
    assert mix(empty).count() == 0


def test_targets_reshare_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 0)], "source string, size long")
    got = {r.source: r.target for r in targets(sizes).collect()}
    assert got["a"] == 20 and got["b"] == 200 and abs(got["c"] - (1.5 * 1110 - 220)) < 1e-6 and got[None] == 0


def test_demand_time_inverts_the_integral(spark):
    from pyspark.sql import functions as F
    schedule = ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0))
    xs = spark.range(0, 101).select((F.col("id") / 100).alias("x"))
    for r in xs.withColumn("t", demand_time(F.col("x"), F.lit(1.0), schedule)).collect():
        ts = np.linspace(0, r.t, 2001)
        area = np.trapezoid(np.interp(ts, *zip(*schedule)), ts) / 0.875
        assert abs(area - r.x) < 1e-5


def test_apply_mix_cuts_and_repeats(edge):
    mixed = mix(edge)
    out = apply_mix(edge, mixed)
    assert out.schema == edge.schema
    taken = {r.doc_id: r.taken for r in mixed.collect()}
    words = Counter()
    for r in out.where("doc_id in (1, 5, 7, 8)").collect():
        words[r.doc_id] += len(spaced(r.text))
    assert all(words[i] == taken[i] for i in (1, 5, 7, 8))


def test_apply_mix_takes_each_row_on_its_own(spark):
    def text(tag, n):
        return " ".join(f"{tag}{k}" for k in range(n))
    given = [(None, text("huge", 3000), "a"), (9, text("nine", 400), "a"), (9, text("neun", 30), "a"), (9, text("short", 5), "c"), (None, None, "b"), (None, "", None)]
    given += [(None, text(f"n{i}x", 10), "abc"[i % 3]) for i in range(90)] + [(None, "one text that is the same", "b")] * 7
    given += [(i, text(f"d{i}x", 40 + i), "abc"[i % 3]) for i in range(60)]
    docs = spark.createDataFrame(given, "doc_id long, text string, source string")
    for mixed in (mix(docs), mix_copies(docs)):
        out = apply_mix(docs, mixed).collect()
        got, want = Counter(), {}
        for r in out:
            got[r.source] += len(spaced(r.text))
        for r in targets(docs.selectExpr("source", "cast(size(filter(split(coalesce(text, ''), ' '), x -> x <> '')) as long) as size")).collect():
            want[r.source] = int(r.target + 0.5)
        assert dict(got) == {s: n for s, n in want.items() if n}, "every source meets its target"
        first = Counter((r.doc_id, r.source, spaced(r.text)[0]) for r in out)
        there = Counter((i, s, spaced(t)[0]) for i, t, s in given if t)
        assert all(n <= 2 * there[k] for k, n in first.items()), "no row comes more than twice"
        assert all(any((t or "").startswith(r.text) for i, t, s in given if (i, s) == (r.doc_id, r.source)) for r in out)


def test_mixed_rows_are_written_in_training_order(spark, sample):
    from corpus_pipeline import mix_sources
    from fundlake.llm.common import write_once
    docs = sample.where("length(text) > 0").dropDuplicates(["doc_id"])
    want = [r.doc_id for r in mix_copies(docs).where("words > 0").orderBy("position").collect()]
    assert [r.doc_id for r in write_once(mix_sources(spark, docs, ""), "ordered").collect()] != sorted(want)
    assert [r.doc_id for r in mix_sources(spark, docs, "").collect()] == want


# ---- classifier ----

def test_classifier_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = graded(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    even, odd = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    model = train(docs, even)
    assert (np.diff(model.cuts) > 0).all()
    got = classify(docs, model, ["doc_id"]).select("row.doc_id", "expected_grade", "tail", "kept").join(odd, "doc_id").collect()
    kept = {g: np.mean([r.kept for r in got if r.grade == g]) for g in (0, 1, 2)}
    assert kept[2] > 0.95 and kept[0] < 0.3 and kept[1] < 0.2


def test_classifier_edges(spark, edge, empty):
    model = OrdinalModel(np.zeros(1 << 18), np.array([-30.0, -29.0]))
    got = classify(edge, model, edge.columns)
    assert got.count() == edge.count() and got.where("kept").select("row.*").schema == edge.schema
    none = graded(spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int"))
    assert classify(empty, train(edge, none), ["doc_id"]).count() == 0
    assert len(features(np.array([0, 0]), b"")[0]) == 0


# ---- pipeline ----

def test_pipeline_stages(spark, sample):
    import corpus_pipeline as P
    sf, docs = "/root/testdata/sf0.001", sample
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.schema == docs.schema, name
        docs = P.write_once(out, "stage")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert ids <= {r.doc_id for r in sample.select("doc_id").collect()} and len(ids) > 50
    final = P.STAGES[-1][1](spark, docs, sf)
    assert final.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and final.count() == docs.count()
