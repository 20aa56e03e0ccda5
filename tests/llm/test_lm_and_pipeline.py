import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from bloomline.llm import lm_scoring as lm, queries
from tests.llm.test_counts_and_packing import check_packing

SMALL = lm.Settings(head_bits=10, tail_bits=12)


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 10 == 0


def plain_base(rows):
    counts = Counter(w for key, text in rows if not held(key) for w in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for key, text in rows:
        words = tokens(text)
        out.append((key, held(key), len(words), sum(counts[w] > 0 for w in words), n,
                    sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)))
    return out


def test_scores(docs, texts, empty):
    rows = lm.score_texts(docs, settings=SMALL).collect()
    order = lambda r: (repr(r[0]), r[2], round(r[5], 6))
    for got, want in zip(sorted(map(tuple, rows), key=order), sorted(plain_base(texts), key=order), strict=True):
        assert got[:5] == want[:5] and got[5] == pytest.approx(want[5], abs=1e-6)
        assert math.isfinite(got[6]) and got[6] < 0
    assert lm.score_texts(empty, settings=SMALL).collect() == []


def test_scores_do_not_depend_on_partitions(docs):
    first, second = ({(r["doc_id"], r["n_tokens"], round(r["score"], 3)) for r in lm.score_texts(d, settings=SMALL).collect()}
                     for d in (docs, docs.coalesce(1)))
    assert first == second


def test_held_out_rows_teach_nothing(spark):
    """The score of a text is the same whatever other held-out texts there are."""
    keys = [k for k in range(200) if held(k)][:2]
    rows = [(k, f"some words of text number {k % 7} here. And more.") for k in range(200) if not held(k)]
    score = lambda extra: {r["doc_id"]: r["score"] for r in lm.score_texts(spark.createDataFrame(
        rows + extra, "doc_id long, text string"), settings=SMALL).collect()}[keys[0]]
    assert score([(keys[0], "words of text")]) == pytest.approx(score([(keys[0], "words of text"), (keys[1], "words " * 500)]), abs=1e-9)


def test_first_bytes_keep_the_final_table(spark, monkeypatch):
    """The first bytes' final table holds all of their training bits, over all shards, and changes what it refines."""
    kept = []
    scores = lm._shard_scores
    monkeypatch.setattr(lm, "_shard_scores", lambda shards, head, opening, settings: kept.append(opening) or scores(shards, head, opening, settings))
    rows = [(k, "one two three four five six " * 3 + f"w{k}") for k in range(300)]
    lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), settings=SMALL)
    bits = 8 * sum(min(len(w) + 1, SMALL.head) for key, text in rows if not held(key) for w in tokens(text))
    assert kept[0].seen.sum() == bits
    gate, step = divmod(int(kept[0].seen.sum(axis=1).argmax()), kept[0].steps)
    x = np.array([step - 11.5]), np.array([gate])
    assert kept[0].refine(*x) != lm.Mixer(len(SMALL.head_orders) + 1, SMALL).refine(*x)


def test_probabilities_sum_to_one():
    """After any prefix the 256 bytes that can follow share the probability."""
    words = sorted([b"Athe ", b"Athere ", b"Athen ", b"Bthe ", b"Aother "])
    known = np.array([5, 2, 1, 3, 1])
    every = sorted({w[:4] + bytes([b]) + END for w in (b"Athe", b"Both") for b in range(256) for END in (b" ",)})
    def trie(ws, counts):
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in ws])])
        return lm.Trie(np.frombuffer(b"".join(ws), np.uint8), offsets, counts)
    learned = trie(words, known.astype(float))
    edges = np.flatnonzero(learned.place > 0)
    counts = lm.count_bits(learned, edges, SMALL.tail_orders, SMALL.tail_bits, 100)
    assert counts.sum() == 8 * (len(SMALL.tail_orders) + 1) * learned.count[edges].sum()
    mixer = lm.Mixer(len(SMALL.tail_orders) + 1, SMALL)
    lm.train(mixer, learned, edges, counts, SMALL.tail_orders, SMALL.tail_bits, SMALL)
    asked = trie(every, np.zeros(len(every)))
    at = np.flatnonzero(asked.place == 4)
    logs = lm.edge_logs(mixer, asked, at, counts, SMALL.tail_orders, SMALL.tail_bits, 100)
    sums = defaultdict(float)
    for e in at.tolist():
        sums[int(asked.prefix[e])] += 10 ** logs[e]
    assert len(at) == 512 and len(sums) == 2 and list(sums.values()) == pytest.approx([1, 1], abs=1e-6)


def test_trie_takes_little_memory():
    """A shard's trie is what a task's memory goes to: building it takes a bounded number of bytes for each of its bytes."""
    random = np.random.default_rng(1)
    words = sorted({bytes([65 + k % 9]) + random.integers(97, 101, k % 14).astype(np.uint8).tobytes() + b" " for k in range(50_000)})
    data, offsets = np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in words])])
    tracemalloc.start()
    trie = lm.Trie(data, offsets, np.ones(len(words)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 55 * len(data)
    spelled = {w[:n + 1] for w in words for n in range(len(w))}
    assert len(trie.byte) == len(spelled) and trie.count[trie.place == 0].sum() == len(words)


def test_model_beats_the_base(spark):
    path = "/root/testdata/sf0.1"
    rows = [r for r in queries.QUERIES["op2_lm_scoring"](spark, path).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_pipeline(spark):
    """Each stage on the rows its predecessor kept: columns stay, decisions take effect, clean documents too."""
    path = "/root/testdata/sf0.001"
    docs = first = spark.read.parquet(f"{path}/documents.parquet")
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, path), "test")
        assert docs.columns == first.columns, name
        sizes.append(docs.count())
        if name == "quality classifier":
            kept = {r["doc_id"] for r in docs.collect()}
            assert sum((k in kept) == bool(q) for k, q in quality.items()) >= 0.95 * len(quality)
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    rows = corpus_pipeline.run(spark, path).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    bins, least = check_packing(rows, texts, Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json")), 2048)
    assert bins <= 1.1 * least + 1


def test_entry_registers_all():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert [k for k in names if k.startswith(f"op{n}_")], n
    assert "pipeline" in names
