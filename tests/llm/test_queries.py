"""The registered queries over the whole smallest tables, against plain versions."""

import pytest
from tokenizers import Tokenizer

from bloomline.llm import queries
from tests.llm.test_counts_and_packing import check_packing
from tests.llm.test_dedup import groups, plain_fingerprint, plain_passages
from tests.llm.test_filters import plain_hits, plain_rules

PATH = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{PATH}/documents.parquet").orderBy("doc_id").collect()]


def run(spark, name):
    return queries.QUERIES[name](spark, PATH)


def test_op1(spark, rows):
    library = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    sizes = [len(e.ids) for e in library.encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    want = [(key, len((text or "").encode()), n, n > 1024) for (key, text), n in zip(rows, sizes)]
    assert sorted(map(tuple, run(spark, "op1_token_counts").collect())) == want


def test_op3(spark, rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    want = [(key, f"{p:016x}", rows[r][0]) for (key, _), p, r in zip(rows, prints, roots)]
    assert sorted(map(tuple, run(spark, "op3_simhash").collect())) == want


def test_op4(spark, rows):
    found = {r["doc_id"]: r for r in run(spark, "op4_quality_rules").collect()}
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{PATH}/labels.parquet").collect()}
    for key, text in rows:
        n, r = plain_rules(text), found[key]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
    judged = [k for k in quality if not found[k]["base_failed"]]
    assert sum(found[k]["kept"] == bool(quality[k]) for k in judged) >= 0.95 * len(judged)


def test_op8(spark, rows):
    got = {(r["doc_id"], r["start"], r["end"], r["n_words"], r["source_id"]) for r in run(spark, "op8_substring_dedup").collect()}
    want = plain_passages(rows)
    assert len(got ^ want) <= 0.02 * len(want)


def test_op9(spark, rows):
    found = run(spark, "op9_best_fit_packing").collect()
    bins, least = check_packing(found, rows, Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json")), 2048)
    assert bins <= 1.02 * least + 1


def test_op10(spark, rows):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{PATH}/benchmark.parquet").collect()]
    assert sorted(map(tuple, run(spark, "op10_decontamination").collect())) == plain_hits(rows, items, 10)
