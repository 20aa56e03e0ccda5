import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from bloomline.llm import packing
from bloomline.llm.packing import best_fit, encoder, pack_sequences
from bloomline.llm.queries import vocabulary
from bloomline.llm.token_counts import counter, token_counts

LETTERS = st.text(alphabet=" \n\t\x0b\x1c\x85\xa0　aabé'strelmdvA1²½.!?,漢😀́\x00<|endoftext>", max_size=40)


@pytest.fixture(scope="module")
def byte_bpe():
    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_bpe():
    return Tokenizer.from_file(vocabulary("word_bpe_49k.json"))


@settings(max_examples=300, deadline=None)
@given(st.lists(LETTERS, max_size=8))
def test_counts_equal_the_library(byte_bpe, found):
    got = counter(vocabulary("byte_bpe_50k.json"), "<|endoftext|>").batch(pa.array(found, pa.string()))
    assert got.tolist() == [len(e.ids) for e in byte_bpe.encode_batch(found, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(LETTERS, max_size=8))
def test_ids_equal_the_library(word_bpe, found):
    ids, offsets = encoder(vocabulary("word_bpe_49k.json")).batch(pa.array(found, pa.string()))
    want = [e.ids for e in word_bpe.encode_batch(found, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == want


def test_token_counts(docs, texts, empty, byte_bpe):
    got = sorted(map(repr, (tuple(r) for r in token_counts(docs, vocabulary("byte_bpe_50k.json"), limit=50).collect())))
    want = []
    for key, text in texts:
        n = len(byte_bpe.encode(text or "", add_special_tokens=False).ids)
        want.append(repr((key, len((text or "").encode()), n, n > 50)))
    assert got == sorted(want)
    assert token_counts(empty, vocabulary("byte_bpe_50k.json")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60), st.integers(1, 10))
def test_best_fit_is_tightest(lengths, open_bins):
    where, offset = best_fit(lengths, 64, open_bins)
    used, opened = {}, set()
    for n, b, o in zip(lengths, where, offset):
        fits = [64 - used[x] for x in opened if 64 - used[x] >= n]
        if fits:
            assert 64 - used[b] == min(fits) and o == used[b]
        else:
            assert b not in used and o == 0
            if len(opened) == open_bins:
                fullest = max(used[x] for x in opened)
                # Which of equally full bins closes is free: learn it from what follows.
                candidates = [x for x in opened if used[x] == fullest]
                later = {y for y in where[len(used):]}
                opened.discard(next((x for x in candidates if x not in later), candidates[-1]) if len(candidates) > 1 else candidates[0])
        used[b] = used.get(b, 0) + n
        assert used[b] <= 64
        opened.discard(b)
        if used[b] < 64:
            opened.add(b)


def check_packing(rows, texts, word_bpe, capacity):
    pieces = defaultdict(list)
    for key, text in texts:
        ids = word_bpe.encode(text or "", add_special_tokens=False).ids + [0]
        for n, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start:start + capacity], dtype="<u4")
            pieces[key].append((n, start, len(part), zlib.crc32(part.tobytes())))
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in pieces.items()}
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for found in bins.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins), -(-sum(r["length"] for r in rows) // capacity)


@pytest.mark.parametrize("group_items", [4, 4096])
def test_pack_sequences(docs, texts, word_bpe, group_items):
    rows = pack_sequences(docs, vocabulary("word_bpe_49k.json"), 256, group_items=group_items).collect()
    bins, least = check_packing(rows, texts, word_bpe, 256)
    assert bins <= 1.25 * least + 1


def test_pack_nothing(empty):
    assert pack_sequences(empty, vocabulary("word_bpe_49k.json")).collect() == []


def test_bins_over_half_full_end_the_rounds(spark, word_bpe, monkeypatch):
    """Documents of which no two fit together stay in groups of the same size; small ones still fill them up."""
    sizes = []
    best = packing._pack_once

    def counted(items, groups, *rest):
        sizes.append((groups, items.count()))
        return best(items, groups, *rest)

    monkeypatch.setattr(packing, "_pack_once", counted)
    large = [(i, "the " * 40) for i in range(400)]
    rows = pack_sequences(spark.createDataFrame(large, "doc_id long, text string"), vocabulary("word_bpe_49k.json"), 64,
                          group_items=20).collect()
    assert check_packing(rows, large, word_bpe, 64)[0] == 400
    assert sizes == [(20, 400)]  # no second round: none fits with another

    sizes.clear()
    mixed = large + [(400 + i, "the " * 20) for i in range(400)]
    rows = pack_sequences(spark.createDataFrame(mixed, "doc_id long, text string"), vocabulary("word_bpe_49k.json"), 64,
                          group_items=20).collect()
    # Groups with more small ones than large ones put three of them (63 tokens) into a bin; that stays.
    assert check_packing(rows, mixed, word_bpe, 64)[0] <= 1.1 * 400
    assert all(count <= 20 * groups for groups, count in sizes)


def test_groups_have_a_largest_size(empty):
    with pytest.raises(ValueError, match="group_items"):
        pack_sequences(empty, vocabulary("word_bpe_49k.json"), group_items=packing.LARGEST_GROUP + 1)
