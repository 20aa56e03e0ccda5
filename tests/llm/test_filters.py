import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from bloomline.llm import decontamination as dec, licenses, quality_classifier as qc, quality_rules as rules, url_filters as urls
from bloomline.llm.queries import LISTED_HOSTS, URL_RULES, url_rules, url_sql

BLANK = "[\x20\x09-\x0d]"


def plain_rules(text):
    text = text or ""
    words = [w for w in re.split(BLANK, text) if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [s for s in text.split("\n") if re.search("[^\x20\x09-\x0d]", s)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def plain_grams(text):
    runs, kind = [], lambda c: "L" if c.isalpha() else "N" if c.isnumeric() else "S"
    for chunk in re.split(BLANK, text or ""):
        for c in chunk:
            runs.append((c, kind(c))) if not runs or runs[-1] is None or runs[-1][1] != kind(c) else runs.__setitem__(-1, (runs[-1][0] + c, kind(c)))
        runs.append(None)
    words = [r[0] for r in runs if r]
    return words, [("=", "=") if a == b else (a, b) for a, b in zip(["^", *words], words)]


def test_base_rules(docs, texts, labels, empty):
    rows = rules.judge_quality(docs, labels).collect()
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = []
    for key, text in texts:
        n = plain_rules(text)
        want.append((key, *n, n[0] < 50 or 100 * n[4] > 50 * n[0]))
    assert sorted(repr(tuple(r[c] for c in columns)) for r in rows) == sorted(map(repr, want))
    assert all(r["kept"] == (not r["base_failed"] and r["ratio"] >= -0.25) for r in rows)
    assert rules.judge_quality(empty, labels).collect() == []


def test_ratio_against_counts(spark):
    """The mean log ratio of the hashed shares, counted plainly; buckets come from the same hash."""
    rows = [(1, "good words here good"), (2, "bad### bad### bad###"), (3, "good here"), (4, None), (5, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r["ratio"] for r in rules.judge_quality(frame, labels, bits=20).collect()}
    bucket_of = {}
    for key, text in rows:
        words, pairs = plain_grams(text)
        row = frame.where(frame.doc_id == key).select(rules.hashed_ngrams("text", 20).alias("b")).first()["b"]
        assert len(row) == len(words) + len(pairs)
        bucket_of.update(zip([*words, *pairs], row))
    grams = {key: [bucket_of[g] for part in plain_grams(text) for g in part] for key, text in rows}
    raw, target = Counter(b for g in grams.values() for b in g), Counter(b for k in (1, 3) for b in grams[k])
    size = 2 ** 20
    for key, found in grams.items():
        ratios = [np.log((target[b] + 1) / (sum(target.values()) + size)) - np.log((raw[b] + 1) / (sum(raw.values()) + size)) for b in found]
        assert got[key] == pytest.approx(np.mean(ratios) if ratios else 0.0)
    assert got[2] < got[1]


def test_all_trusted_texts_count(spark):
    """If every text is trusted, both multinomials are the same and all ratios are 0, however many ids there are."""
    frame = spark.range(20_200).selectExpr("id AS doc_id", "concat('w', char(97 + id % 26), ' x', id) AS text")
    found = rules.judge_quality(frame, frame.selectExpr("doc_id", "1 AS quality")).where("abs(ratio) > 1e-12")
    assert found.count() == 0


def test_rules_without_labels(docs, labels):
    assert len(rules.judge_quality(docs, labels.limit(0)).collect()) == docs.count()


def test_ngrams_are_hashed_as_rows(docs, labels):
    """Lambdas over arrays are interpreted, at several times the cost: no n-gram is hashed, and no row made, by one."""
    plan = rules.judge_quality(docs, labels)._jdf.queryExecution().executedPlan().toString()
    made = [line for line in plan.splitlines() if "Generate " in line]
    assert any("xxhash64" in line for line in made) and not any("lambdafunction" in line for line in made)


def test_ngram_rows_are_the_array(spark):
    data = [(0, "a a a"), (1, None), (2, ""), (3, " \n"), (4, "^ ^ x1y\u00e9 \u4e2d\u6587##  ^"), (5, "= ="), (5, "b"), (6, "\U0001d400b 12 a\u0301")]
    frame = spark.createDataFrame(data, "n int, text string").withColumn("wanted", rules.hashed_ngrams("text", 16))
    got = {i: [] for i in range(7)}
    for r in rules.ngram_rows(frame, "text", 16, "n").collect():
        got[r["n"]].append(r["bucket"])
    want = {i: sorted(b for r in frame.collect() if r["n"] == i for b in r["wanted"]) for i in range(7)}
    assert {i: sorted(b for b in found if b is not None) for i, found in got.items()} == want
    assert [got[i] for i in (1, 2, 3)] == [[None, None]] * 3


def test_repeated_windows_at_edges(spark, labels):
    texts = ["a b", "a b c", "a a a a", "a b c a b c", "a b a b a", "x a b c y a b c", "a b c d a b c e b c d", "a b c " * 40 + "z", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_repeat_words"] for r in rules.judge_quality(frame, labels).collect()}
    assert got == {i: plain_rules(t)[4] for i, t in enumerate(texts)}


def test_features_are_the_words_ngrams():
    settings = qc.Settings()
    bucket, offsets = qc.features(pa.array(["ab", "ab", "xyz", "é"]), settings)
    sizes = np.diff(offsets)
    # <ab>: 4 + 3 + 2 + 1 n-grams and the word.
    assert sizes.tolist() == [11, 11, 15, 11]
    assert bucket[:11].tolist() == bucket[11:22].tolist()
    assert bucket.min() >= 2 and bucket.max() < 1 << settings.bits


def test_training_separates():
    settings = qc.Settings(bits=10, steps=60)
    good, bad = ["the cat sat on the mat", "a dog ran to the cat"], ["b@d!! w0rd!! x!!", "q!! z!! the!!"]
    rows = qc.bags(pa.array(good * 8 + bad * 8), settings)
    weights = qc.train(rows, np.array([1] * 16 + [0] * 16), settings)
    logit = [float((weights[b] * s).sum()) for b, s in rows]
    assert min(logit[:16]) > max(logit[16:])


def test_classifier(docs, texts, labels, empty):
    rows = qc.score_quality(docs, labels).collect()
    assert sorted(repr(r["doc_id"]) for r in rows) == sorted(repr(k) for k, _ in texts)
    by_text = {}
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        by_text.setdefault(r["doc_id"], set()).add(round(r["score"], 9))
    assert len(by_text[3]) == 1 and by_text[100] == by_text[101] == by_text[102] and by_text[0] == by_text[105]
    kept = qc.score_quality(docs, labels, keep=True)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in rows)
    assert qc.score_quality(empty, labels).collect() == []
    assert {r["score"] for r in qc.score_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_classifier_learns_outside_the_fold(spark):
    """Held-out rows get the right label, and changing their labels changes nothing."""
    path = "/root/testdata/sf0.01"
    frame, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    rows = {r["doc_id"]: r for r in qc.score_quality(frame, labels).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [k for k in truth if rows[k]["held_out"]]
    assert sum(rows[k]["predicted"] == truth[k] for k in held) >= 0.95 * len(held)
    flipped = labels.withColumn("quality", rules.F.when(qc.held_out("doc_id", 5), 1 - labels["quality"]).otherwise(labels["quality"]))
    again = {r["doc_id"]: r["score"] for r in qc.score_quality(frame, flipped).collect()}
    assert all(again[k] == rows[k]["score"] for k in rows)


def test_licenses(spark):
    grant = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
             "files (the \"Software\"), to deal in the Software without restriction.")
    notice = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    warranty = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.'
    cases = [
        ("Licensed under the Apache License, Version 2.0.", "apache2", "Apache-2.0", 0, True),
        ("Words. Released under the MIT License.\nAll rights reserved.", "mit,reserved", "MIT,All-rights-reserved", 0, False),
        (f"{grant} {notice}\n{warranty}", "mitgrant,mitnotice,aswarranty", "MIT", 0, True),
        (f"{notice} {grant}", "mitnotice,mitgrant", "", 2, True),
        ("licensed under cc by-nc 4.0. Licensed under CC BY-NC 4.0!", "ccbync4,ccbync4", "CC-BY-NC-4.0", 0, False),
        ("We licensed under the Apache License, Version 2.0 once.", "", "", 0, True), (None, "", "", 0, True), ("", "", "", 0, True),
    ]
    frame = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.scan_licenses(frame).collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    assert {r[0]: r[1:] for r in con.execute(licenses.oracle()).fetchall()} == got


MIT = """MIT License

Copyright (c) 2024 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD2 = """Copyright 2024 Someone

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission.
"""
APACHE = """Copyright 2024 Someone
Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""


def test_wrapped_licenses(spark):
    """The standard texts, wrapped as they are handed out, on one line, and as comments of several languages."""
    block = lambda start, mark, end: lambda t: start + "".join(f"{mark}{' ' if x else ''}{x}\n" for x in t.split("\n")) + end
    forms = [lambda t: t, lambda t: t.replace("\n", "\r\n"), block("", "#", ""), block("", "//", ""), block("/*\n", " *", " */\n"), block("", "--", ""),
             block("<!--\n", "", "-->\n"), lambda t: re.sub(r"(?<!\n)\n(?!\n)", " ", t), lambda t: t.replace("\n\n", "\n")]
    texts = {"MIT": MIT, "BSD-2-Clause": BSD2, "BSD-3-Clause": BSD3, "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL}
    # A copyright notice ends with its line.
    texts["Apache-2.0"], head = APACHE.split("\n", 1)[1], APACHE
    cases = [(name, form(text)) for name, text in texts.items() for form in forms] + [("Apache-2.0", form(head)) for form in forms[:7]]
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: (r["licenses"], r["n_unmatched"]) for r in licenses.scan_licenses(frame).collect()}
    assert got == {i: (name, 0) for i, (name, _) in enumerate(cases)}


def test_license_rows(docs, texts, empty):
    assert docs.count() == licenses.scan_licenses(docs).count() and licenses.scan_licenses(empty).collect() == []
    assert all(any(c in s for c in licenses.CLUES.split("|")) for s in licenses.SENTENCES if "copyright" not in s and "license" in s)


def test_clues_cover_sentences():
    for sentence in licenses.SENTENCES:
        assert re.search(licenses.CLUES, sentence), sentence


PAGES = [
    "http://a.example.com/en/1", "https://www.example.com/en/x", "https://EXAMPLE.com/en/?q", "https://example.com/en", "http://x.net/es/a#b",
    "http://net/fr/", "http://net.org/fr/", "http://com", "http://com/", "http://notcom/", "ftp://b.com?x/://c.net/es/", "no scheme", "", None,
    "http://www.example.com/en/1", "http://deep.www.example.com/en/", "x://http://a.net/es/", "http://cheap-pills.example.net/es/1",
    "http://m.spam-farm.example.org/", "http://spam-farm.example.org", "http://ex.net/ES/", "http://a..com/", "http://.com/", "://com/", "http://user@a.com:80/en/",
    "http://É.com/\nx?y", "http://a.com/en/1", "http://a.com/en/1",
]


def plain_verdict(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = lambda h, p: (host == h or host.endswith("." + h)) and path.startswith(p)
    found = sorted(((h + p, v) for h, p, v in URL_RULES if fits(h, p)), key=lambda r: -len(r[0]))
    if found:
        return host, path, *found[0]
    return host, path, None, "block" if any(fits(h, "/") for h in LISTED_HOSTS) else "allow"


def test_urls(spark):
    frame = spark.createDataFrame([(i, u, None) for i, u in enumerate(PAGES)], "page_id long, url string, hits string")
    got = {r["page_id"]: tuple(r)[1:] for r in urls.judge_urls(frame, url_rules(spark)).collect()}
    assert got == {i: plain_verdict(u) for i, u in enumerate(PAGES)}
    con = duckdb.connect()
    con.register("pages", frame.toPandas())
    assert {r[0]: r[1:] for r in con.execute(url_sql()).fetchall()} == got
    assert urls.judge_urls(frame.limit(0), url_rules(spark)).collect() == []
    assert {r["verdict"] for r in urls.judge_urls(frame, url_rules(spark).limit(0)).collect()} == {"allow"}


def test_bloom_filter(spark):
    keys = [f"key{i}" for i in range(3000)]
    table = urls.build_filter(spark.createDataFrame([(k,) for k in keys] + [(None,)], "k string"), "k")
    test = lambda names: urls.may_hold(table, urls.ragged.hash_values(pa.array(names)))
    assert test(keys).all()
    assert test([f"other{i}" for i in range(3000)]).mean() < 0.02
    tiny = urls.build_filter(spark.createDataFrame([(k,) for k in keys], "k string"), "k", most_blocks=2)
    assert tiny.shape == (2, urls.WORDS)


def plain_hits(rows, items, window):
    found = {}
    for name, text in items:
        words = plain_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(tuple(words[i:i + window]), set()).add(str(name))
    out = []
    for key, text in rows:
        words, hit, names = plain_words(text), set(), set()
        for phrase, ids in found.items():
            for i in range(len(words) - len(phrase) + 1):
                if tuple(words[i:i + len(phrase)]) == phrase:
                    hit |= set(range(i, i + len(phrase)))
                    names |= ids
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((key, len(words), len(hit), len(names), digest, bool(hit)))
    return out


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


@pytest.mark.parametrize("block_bytes", [4 << 20, 300])
def test_benchmark_hits(spark, docs, texts, block_bytes):
    long = texts[10][1].split()
    items = [(1, " ".join(long[5:30])), (2, " ".join(long[20:45]).upper()), (3, "the the the"), (4, "x"), (5, ""), (6, None), (7, "not there at all"),
             (10, " ".join(long[5:30])), (11, "Éa ß; 漢字"), (12, " ".join(texts[20][1].split()[:9]))]
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = dec.benchmark_hits(docs, frame, block_bytes=block_bytes)
    rows = found.select("doc_id", "n_words", "n_hit", "n_items", dec.items_digest(found["items"]).alias("d"), "contaminated").collect()
    want = plain_hits(texts, items, 10)
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    kept = dec.keep_clean(docs, frame)
    assert kept.columns == docs.columns
    assert sorted(repr((r["doc_id"], r["text"])) for r in kept.collect()) == sorted(repr(t) for t, w in zip(texts, want) if not w[5])


def test_hits_of_nothing(spark, docs, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["contaminated"] for r in dec.benchmark_hits(docs, none).collect()} == {False}
    assert dec.benchmark_hits(empty, spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []


def test_proximity(spark):
    frame = spark.createDataFrame([(1, "one two three"), (2, "one x two y three"), (3, "one x x x two three"), (4, "three two one")], "doc_id long, text string")
    items = spark.createDataFrame([("q", "one two three")], "item_id string, text string")
    got = {r["doc_id"]: (r["items"], r["near_items"]) for r in dec.benchmark_hits(frame, items, slop=1).collect()}
    assert got == {1: (["q"], ["q"]), 2: ([], ["q"]), 3: ([], []), 4: ([], [])}
