import random
import re
from collections import defaultdict

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st

from bloomline.llm import ragged, simhash, substring_dedup as sub
from bloomline.llm.components import components
from tests.llm.conftest import prose


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, links):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_spanning_stars(links):
    a, b = (np.array([x[i] for x in links], dtype=np.int64) for i in (0, 1))
    u, v = ragged.spanning_stars(a, b)
    assert groups(31, zip(u.tolist(), v.tolist())) == groups(31, links)
    assert len(u) == 31 - len(set(groups(31, links)))


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 480)] + [(500, 500)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links + [(None, 4)], "x long, y long").repartition(5)).collect()}
    want = groups(501, links)
    assert {i: got.get(i, i) for i in range(501)} == dict(enumerate(want))
    assert components(spark.createDataFrame([], "x long, y long")).collect() == []


def test_fingerprints(texts):
    for _, text in texts:
        assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)


def test_near_duplicates(docs, texts, empty):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts)
    prints = [plain_fingerprint(t) for _, t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    roots = groups(len(texts), links)
    least = defaultdict(list)
    for (key, _), r in zip(texts, roots):
        least[r].append(key)
    want = [(key, f"{p:016x}", min((k for k in least[r] if k is not None), default=None)) for (key, _), p, r in zip(texts, prints, roots)]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    assert simhash.near_duplicates(empty).collect() == []


def test_hot_groups_lose_no_link(spark):
    """Near copies of one fingerprint and many others, with groups far above the cell size."""
    rng = random.Random(4)
    base = rng.getrandbits(64)
    near = {base}
    while len(near) < 150:
        near.add(rng.choice(sorted(near)) ^ (1 << rng.randrange(64)))
    shared = {(base & 0xFFFF) | (rng.getrandbits(48) << 16) for _ in range(200)}
    prints = sorted(near | shared | {rng.getrandbits(64) for _ in range(200)})
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    want = groups(len(prints), links)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    for most in (7, 64, 4096):
        found = [(r["a"], r["b"]) for r in simhash.link_fingerprints(frame, 3, most).collect()]
        at = {p: i for i, p in enumerate(signed)}
        assert groups(len(prints), [(at[a], at[b]) for a, b in found]) == want


def test_bands_lose_no_pair():
    rng = random.Random(6)
    for count in (10, 10**6, 10**9, 10**11):
        masks = simhash.band_masks(3, count)
        for _ in range(300):
            flips = 0
            for b in rng.sample(range(64), 3):
                flips |= 1 << b
            assert any(flips & m == 0 for m in masks)


def test_keep_one(docs, texts, empty):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    names = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == sorted(repr(k) for k, _ in texts if k in names)
    assert simhash.keep_one(empty).collect() == []


def plain_paragraphs(text):
    """(start, end, words) in bytes, sentence by sentence, five words at least."""
    out = []
    raw = (text or "").encode()
    sentence = []
    for m in re.finditer(rb"[^\x20\x09-\x0d]+", raw):
        if sentence and b"\n" in raw[sentence[-1].end():m.start()]:
            out.append(sentence)
            sentence = []
        sentence.append(m)
        if m[0][-1:] in b".!?":
            out.append(sentence)
            sentence = []
    out.append(sentence)
    return [(s[0].start(), s[-1].end(), [w[0].lower() for w in s]) for s in out if len(s) >= 5]


def plain_passages(rows, least=20, similarity=0.8):
    docs = {}
    for key, text in rows:
        docs[(key, text)] = plain_paragraphs(text)
    units = sorted({tuple(w) for found in docs.values() for _, _, w in found})
    sets = [{u[i:i + 5] for i in range(len(u) - 4)} for u in units]
    holders = defaultdict(list)
    for i, shingles in enumerate(sets):
        for s in shingles:
            holders[s].append(i)
    pairs = {(i, j) for found in holders.values() for i in found for j in found if j < i}
    near = [(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])]
    root = dict(zip(units, groups(len(units), near)))
    last = 2**63 - 1
    order = lambda k: last if k is None else k
    keeper = {}
    for (key, _), found in docs.items():
        for _, _, w in found:
            r = root[tuple(w)]
            keeper[r] = min(keeper.get(r, last), order(key))
    out = set()
    for (key, text), found in docs.items():
        run = []
        for item in [*found, None]:
            k = keeper[root[tuple(item[2])]] if item else None
            if item and k != order(key):
                run.append((*item, k))
                continue
            if sum(len(w) for _, _, w, _ in run) >= least:
                for k in {x[3] for x in run}:
                    own = [x for x in run if x[3] == k]
                    out.add((key, min(x[0] for x in own), max(x[1] for x in own), sum(len(x[2]) for x in own), None if k == last else k))
            run = []
    return out


def test_repeated_passages(spark, docs, texts, empty):
    got = {(r["doc_id"], r["start"], r["end"], r["n_words"], r["source_id"]) for r in sub.repeated_passages(docs).collect()}
    assert got == plain_passages(texts)
    assert sub.repeated_passages(empty).collect() == []


def test_planted_passages(spark):
    """Passages of over 50 words in the middle of other texts are found, texts without any are left alone."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 7))) for _ in range(3000)]
    make = lambda n: " ".join(" ".join(rng.choice(words) for _ in range(rng.randint(5, 14))) + "." for _ in range(n))
    passages = [make(8) for _ in range(4)]
    rows, planted = [], {}
    for i in range(60):
        text = make(15)
        if i % 3 == 0:
            at = text.index(" ", rng.randint(0, len(text) - 20))
            text, planted[i] = text[:at] + " " + passages[i % 4] + text[at:], i % 4
        rows.append((i, text))
    near = rows[1][1].split(" ")
    near[40] = "changed"
    rows.append((60, " ".join(near)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sub.repeated_passages(frame).collect()
    first = {p: min(i for i in planted if planted[i] == p) for p in range(4)}
    pairs = {(r["doc_id"], r["source_id"]) for r in found}
    assert {(i, first[p]) for i, p in planted.items() if i != first[p]} | {(60, 1)} == pairs
    left = {r["doc_id"]: r["text"] for r in sub.remove_passages(frame).collect()}
    for i, text in rows[:60]:
        if i in planted and i != first[planted[i]]:
            assert passages[planted[i]][120:200] not in left[i] and len(left[i]) < len(text)
        else:
            assert left[i] == text


def test_tiles_of_verification(spark):
    """A group above the tile size is verified in pairs of tiles, with the same links."""
    rng = random.Random(12)
    sets = {i: {rng.randrange(40) for _ in range(30)} for i in range(80)}
    groups_ = spark.createDataFrame([(1, i) for i in sets], "bucket long, uid long")
    frame = spark.createDataFrame([(i, bytearray(np.array(sorted(s), dtype="<u8").tobytes())) for i, s in sets.items()], "uid long, shingles binary")
    want = groups(80, [(i, j) for i in sets for j in range(i) if len(sets[i] & sets[j]) >= 0.5 * len(sets[i] | sets[j])])
    for most in (9, 1000):
        links = sub.verified_links(groups_, frame, sub.Settings(similarity=0.5, most=most)).collect()
        assert groups(80, [(r["a"], r["b"]) for r in links]) == want


def test_band_recall():
    chosen = sub.Settings()
    assert 1 - (1 - chosen.similarity ** chosen.rows) ** chosen.bands >= chosen.recall
    assert chosen.least_shingles == 4


def test_remove_passages(docs, texts, empty):
    out = sub.remove_passages(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    spans = defaultdict(list)
    for key, a, b, _, _ in plain_passages(texts):
        spans[key].append((a, b))
    want = []
    for key, text in texts:
        raw = (text or "").encode()
        for a, b in sorted(spans.get(key, []), reverse=True):
            raw = raw[:a] + raw[b:]
        if key not in spans or text is None:
            want.append(repr((key, text)))
        elif raw.split():
            want.append(repr((key, raw.decode())))
    assert sorted(repr((r["doc_id"], r["text"])) for r in rows) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] is not None)
    assert sub.remove_passages(empty).collect() == []
