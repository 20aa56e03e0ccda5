"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from bloomline.llm import periodic_runs as pr
from bloomline.llm import queries

BLANKS = b" \t\n\x0b\x0c\r"


def words_of(text):
    return [w.decode() for w in (text or "").encode().translate(bytes(32 if b in BLANKS else b for b in range(256))).split(b" ") if w]


def plain_runs(words, limits=pr.Limits()):
    """Maximal stretches of every period, without those that have a smaller one."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            if size >= max(limits.words, limits.periods * q):
                if not any(words[i:i + size - p] == words[i + p:i + size] for p in range(1, q)):
                    found.append((i, size, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, found):
    gone = {i for start, size, q in found for i in range(start + q, start + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_loop(key, words):
    h, n = zlib.crc32(str(key).encode()), len(words)
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


@pytest.mark.parametrize("limits", [pr.Limits(), pr.Limits(4, 2), pr.Limits(2, 2), pr.Limits(3, 3)])
def test_runs_of_random_sequences(limits):
    rng = random.Random(3)
    for _ in range(300):
        docs = []
        for _ in range(rng.randint(1, 4)):
            unit = [rng.randint(0, 3) for _ in range(rng.randint(1, 6))]
            noise = [rng.randint(0, 1) for _ in range(rng.randint(0, 30))]
            docs.append(noise + unit * rng.randint(0, 7) + unit[:rng.randint(0, 3)] + noise[:5])
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        got = pr.runs_of(np.array([x for d in docs for x in d], np.int64), offsets, limits)
        assert [tuple(r) for r in got.tolist()] == [(k, *r) for k, d in enumerate(docs) for r in plain_runs(d, limits)]


def test_one_word_a_hundred_thousand_times():
    got = pr.runs_of(np.zeros(100_000, np.int64), np.array([0, 100_000]), pr.Limits())
    assert got.tolist() == [[0, 0, 100_000, 1]]


def test_prefix_bounds_every_run():
    for limits in (pr.Limits(), pr.Limits(10, 3), pr.Limits(2, 2)):
        assert all(max(limits.words, limits.periods * q) - q >= limits.prefix for q in range(1, 50))


def test_documents(spark, docs, texts, empty):
    got = sorted(((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in pr.periodic_runs(docs).collect()),
                 key=repr)
    want = []
    for key, text in texts:
        words = words_of(text)
        found = plain_runs(words)
        want.append((key, len(words), tuple(found), plain_collapsed(words, found)))
    assert got == sorted(want, key=repr)
    assert pr.periodic_runs(empty).collect() == []


def test_loops(spark, docs, texts):
    got = sorted(((r["doc_id"], tuple(words_of(r["text"]))) for r in pr.looped(docs).collect()), key=repr)
    assert got == sorted(((key, tuple(plain_loop(key, words_of(text)))) for key, text in texts), key=repr)
    assert any(plain_loop(key, words_of(text)) != words_of(text) for key, text in texts)


def test_op12(spark):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_periodic_runs"](spark, path).collect()}
    assert len(got) == len(rows)
    for key, text in ((r["doc_id"], r["text"]) for r in rows):
        words = plain_loop(key, words_of(text))
        if len(words) > 3000:
            continue  # the plain search takes the square of the words
        found, r = plain_runs(words), got[key]
        best = None
        for run in found:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *(best or (None,) * 3))
        assert r["exponent_milli"] == (best and 1000 * best[1] // best[2])
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, found).encode()).hexdigest()
