"""Exchanges in two levels: results equal those of one, rows stay few."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import brute
import fixture
from fieldwatch.llm import blocks
from fieldwatch.llm.bpe_codec import codec_digests
from fieldwatch.llm.substring_dedup import remove_windows, window_report
from fieldwatch.llm.suffix_dedup import repeat_digests

ROWS = fixture.documents()
WORD = public_tokenizers.path("word_bpe_49k.json")


def bag(rows):
    return Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def docs(spark):
    return fixture.frame(spark, ROWS).cache()


@pytest.mark.parametrize("judge, kinds", [(blocks.repeated, (np.uint8,)), (blocks.called, (np.uint8,)),
                                          (blocks.repeated_checked, (np.uint32, np.uint8)),
                                          (blocks.has_smaller, (np.uint32, np.int64))])
def test_two_levels_judge_as_one(spark, judge, kinds):
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 64, 60, np.uint64)  # one of them in every block
    sent = {}
    for number in range(25):
        keys = np.unique(np.concatenate([rng.choice(common, 20), common[:1], rng.integers(0, 1 << 64, 30, np.uint64)]))
        extras = {np.uint8: rng.integers(0, 8, len(keys)) == 0, np.uint32: rng.integers(0, 2, len(keys)),
                  np.int64: rng.integers(0, 9, len(keys))}
        sent[number] = keys, tuple(extras[k].astype(k) for k in kinds)
    out = {}
    for to in (blocks.Ranges(1), blocks.Ranges(7), blocks.Ranges(3, 4, 5), blocks.Ranges(2, 9, 1)):
        tables = [blocks.key_rows(n, keys, to, extras) for n, (keys, extras) in sent.items()]
        rows = [tuple(r.values()) for t in tables for r in t.to_pylist()]
        frame = spark.createDataFrame(rows, blocks.KEY_SCHEMA).repartition(3)
        got = {r.block: r.answers for r in blocks.exchange(frame, to, judge, kinds).collect()}
        out[to] = [blocks.answer_bits(keys, to, [a.asDict() for a in got[n]]).tolist()
                   for n, (keys, _) in sent.items()]
    first, *others = out.values()
    assert any(map(any, first)) and not all(map(all, first)) and all(o == first for o in others)


def test_rows_of_a_block_stay_few():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 160_000, np.uint64))
    size = {}
    for corpus in (30 << 30, 3 << 40, 100 << 40):
        to = blocks.ranges(corpus // 10, corpus // blocks.BLOCK_BYTES)
        assert to.first * to.second * blocks.PART_KEYS >= corpus // 10
        up = blocks.key_rows(0, keys, to)
        assert up.num_rows <= 2000 and to.second <= 2000
        # a cell holds about as many keys as a block, whatever the corpus
        cells = to.first * to.groups
        assert 0.5 < corpus // blocks.BLOCK_BYTES / cells * (to.second > 1) + (to.second == 1) < 2
        size[corpus] = up.nbytes / len(keys)
    assert max(size.values()) < 1.5 * size[30 << 30]


def test_windows(docs):
    got = window_report(docs, block_bytes=300, part_keys=400, fan=3)
    assert bag(got.collect()) == bag(brute.windows_removed(ROWS))


def test_suffixes(docs):
    got = repeat_digests(docs, block_bytes=2000, part_keys=2000, fan=3)
    assert bag(got.collect()) == bag(brute.bytes_removed(ROWS))


def test_codec(docs):
    want = bag(codec_digests(docs, WORD).collect())
    assert bag(codec_digests(docs, WORD, block_bytes=2000, part_words=500, fan=3).collect()) == want


def test_ids_of_any_type(spark, docs):
    """Strings in the order of their bytes, null ids last, all columns kept."""
    rng = random.Random(2)
    name = {i: f"é{rng.randrange(1000)}-{i}" for i, _ in ROWS if i is not None}
    rank = {n: k for k, n in enumerate(sorted(name.values(), key=str.encode))}
    named = [(name.get(i), t) for i, t in ROWS]
    back = {k: n for n, k in rank.items()}
    want = bag((back.get(i), *rest) for i, *rest in brute.windows_removed([(rank.get(i), t) for i, t in named]))
    frame = spark.createDataFrame(named, "doc_id string, text string").repartition(3)
    assert bag(window_report(frame).collect()) == want
    out = remove_windows(frame)
    assert out.schema == frame.schema
    assert bag((r.doc_id, brute.sha(" ".join(brute.words(r.text)))) for r in out.collect()) == bag(
        (i, s) for i, _, _, s in want.elements())
    assert window_report(frame.limit(0)).count() == 0
