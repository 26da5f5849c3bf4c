"""Each operator against its brute-force version on the small table."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import brute
import fixture
from fieldwatch.llm import tokenizer as tz
from fieldwatch.llm.bpe_codec import codec_digests, encode_decode
from fieldwatch.llm.exact_dedup import drop_duplicates, exact_groups
from fieldwatch.llm.packing import TIERS, pack_documents
from fieldwatch.llm.quality_rules import STATS, judge, keep_good
from fieldwatch.llm.simhash_dedup import drop_near_duplicates, simhash_components
from fieldwatch.llm.substring_dedup import remove_windows, window_report
from fieldwatch.llm.suffix_dedup import COVER, PERIOD, remove_repeats, repeat_digests

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ROWS = fixture.documents()


def bag(rows):
    return Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def docs(spark):
    return fixture.frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return fixture.frame(spark, [], extra=False)


def test_windows(docs, empty):
    for block_bytes in (300, 2_000_000):
        got = window_report(docs, block_bytes=block_bytes)
        assert bag(got.collect()) == bag(brute.windows_removed(ROWS))
    assert window_report(empty).count() == 0


def test_windows_many_shapes(spark):
    for seed in range(3):  # few distinct words: runs, periods, dense repeats
        import random

        rng = random.Random(seed)
        rows = [(rng.randrange(40), " ".join(rng.choices("ab", weights=[4, 1], k=rng.randint(0, 60))))
                for _ in range(50)]
        got = window_report(fixture.frame(spark, rows, extra=False))
        assert bag(got.collect()) == bag(brute.windows_removed(rows))


def test_remove_windows_keeps_columns(docs):
    out = remove_windows(docs)
    assert out.schema == docs.schema and out.count() == docs.count()
    want = {(i, s) for i, _, _, s in brute.windows_removed(ROWS)}
    assert {(r.doc_id, brute.sha(" ".join(brute.words(r.text)))) for r in out.collect()} == want


def test_suffixes(docs, empty):
    assert bag(repeat_digests(docs).collect()) == bag(brute.bytes_removed(ROWS))
    assert bag(repeat_digests(docs, length=140).collect()) == bag(brute.bytes_removed(ROWS, 140))
    assert remove_repeats(empty).count() == 0


def test_suffixes_inside_longer_repeats(spark):
    """Short repeats that equal the inside of long ones, across and within blocks."""
    import random

    for seed in range(4):
        rng = random.Random(seed)
        say = lambda n: "".join(rng.choices("abcdé \n", k=n))
        long, other = say(2500), say(700)
        rows = [(0, say(300) + long), (1, long + say(200)), (2, say(150) + long[900:1105] + say(150)),
                (3, say(10) + long[1000:1201] + say(3)), (4, long[1300:1499]), (5, other + "x" + other),
                (6, say(90) + long[2000:] + other[:400]), (7, "ab" * 300), (8, "ab" * 110), (9, "b" + "ab" * 90),
                (10, "z" * 1000), (11, "z" * 200), (12, "z" * 199), (13, say(5000)), (14, other[350:] + long[:260])]
        for block_bytes in (100, 2_000_000):
            got = repeat_digests(fixture.frame(spark, rows, extra=False), block_bytes=block_bytes)
            assert bag(got.collect()) == bag(brute.bytes_removed(rows))


def test_cover_is_a_difference_cover():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_exact(docs, empty):
    got = bag(exact_groups(docs).collect())
    assert got == bag(brute.exact_rows(ROWS))
    assert exact_groups(empty).count() == 0


def test_drop_duplicates(docs):
    out = drop_duplicates(docs)
    assert out.schema == docs.schema
    want = bag((i, s) for i, _, _, kept, s in brute.exact_rows(ROWS) if kept)
    import re

    assert bag((r.doc_id, brute.sha(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""))) for r in out.collect()) == want


@pytest.mark.parametrize("bucket", [64, 2])
def test_simhash(docs, empty, bucket):
    assert bag(simhash_components(docs, bucket=bucket).collect()) == bag(brute.simhash_rows(ROWS))
    assert simhash_components(empty).count() == 0


@pytest.mark.parametrize("bucket", [64, 3])
def test_simhash_links_dense_prints(spark, bucket):
    """Chains and clusters of prints, more to a signature than a bucket takes."""
    import random

    from fieldwatch.llm.components import components
    from fieldwatch.llm.simhash_dedup import links

    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(50)}
    for start in list(prints)[:6]:
        p = start
        for _ in range(60):
            p ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            prints.add(p)
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    found = components(links(spark.createDataFrame(signed, "print long").repartition(4), bucket)).collect()
    want = brute.linked(prints)
    groups = Counter(want.values())
    alone = {p for p, r in want.items() if groups[r] == 1}
    by_root = {}
    for node, root in found:
        by_root.setdefault(root, set()).add(node % (1 << 64))
    assert {frozenset(v) for v in by_root.values()} == {
        frozenset(p for p in want if want[p] == r) for r, n in groups.items() if n > 1}
    assert not alone & {n % (1 << 64) for n, _ in found}


def test_drop_near_duplicates(docs):
    out = drop_near_duplicates(docs)
    assert out.schema == docs.schema
    rows = brute.simhash_rows(ROWS)
    root = brute.linked([int(f, 16) for _, f, _ in rows])
    kept = [root[brute.fingerprint(r.text)] for r in out.collect()]
    assert sorted(kept) == sorted(set(root.values()))  # one of each group
    smallest = {root[int(f, 16)]: c for _, f, c in rows}
    assert all(r.doc_id == smallest[root[brute.fingerprint(r.text)]] for r in out.collect())


def test_quality_statistics(spark, docs, empty):
    labels = spark.createDataFrame([(i, n % 2, 0) for n, (i, _) in enumerate(ROWS) if i is not None and n < 40],
                                   "doc_id long, quality int, toxic int")
    got = judge(docs, labels, fit_rows=30, trees=20)
    want = bag((i, *brute.rule_statistics(t)[0], brute.rule_statistics(t)[1]) for i, t in ROWS)
    assert bag(got.select("doc_id", *STATS, "base_failed").collect()) == want
    assert got.filter("kept and base_failed").count() == 0
    assert judge(empty, labels).count() == 0
    assert judge(docs, labels.limit(0)).filter("kept = base_failed").count() == 0  # no labels: base rules alone
    kept = keep_good(docs, labels, fit_rows=30, trees=20)
    assert kept.schema == docs.schema and 0 < kept.count() < docs.count()
    # the filter and the report judge alike
    assert bag(kept.select("doc_id").collect()) == bag(got.filter("kept").select("doc_id").collect())


def test_packing(docs, empty):
    library = tz.load_tokenizer(tz.tokenizer_text(BYTE))
    ids = Counter()
    for i, t in ROWS:
        ids[(i, tuple(library.encode(t or "", add_special_tokens=False).ids + [1]))] += 1
    for block in (2_000_000, 3000):
        pieces = pack_documents(docs, BYTE, block=block).collect()
        check_pieces(pieces, ids)
    assert pack_documents(empty, BYTE).count() == 0


def check_pieces(pieces, ids):
    """Every id of every document in one piece, sequences gapless, little padding."""
    sequences, by_doc = {}, {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    padding = 0
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= TIERS[0] and own[0].window in (at, TIERS[0])
        assert own[0].window == TIERS[0] or at & (at - 1) == 0
        padding += own[0].window - at
    assert padding < TIERS[0] * 2
    want = {}
    for (i, t), n in ids.items():
        want.setdefault((i, len(t)), []).extend([t] * n)
    assert {k: len(v) for k, v in want.items()}.keys() == by_doc.keys()
    for key, own in by_doc.items():
        texts = want[key]
        got = Counter((p.start, p.length) for p in own)
        starts = sorted(p.start for p in own)
        assert sum(n * length for (_, length), n in got.items()) == key[1] * len(texts) and starts[0] == 0
        for p in own:
            crcs = {zlib.crc32(np.array(t[p.start:p.start + p.length], "<u4").tobytes()) for t in texts}
            assert p.ids_crc32 in crcs


def test_step_groups_are_balanced():
    from fieldwatch.llm.packing import step_groups

    sizes = [2048] * 37 + [1024] * 11 + [512] * 5 + [256] * 9
    tokens = Counter()
    for size, step in zip(sizes, step_groups(sizes, 16384)):
        tokens[step] += size
    assert max(tokens.values()) - min(tokens.values()) <= 2048


def test_codec(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD)
    want = Counter()
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[(i, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(decoded))] += 1
    assert bag(codec_digests(docs, WORD).collect()) == want
    full = encode_decode(docs, WORD).collect()
    assert Counter((r.doc_id, r.n_tokens, brute.sha(np.array(r.ids, "<u4").tobytes()), brute.sha(r.decoded))
                   for r in full) == want
    assert codec_digests(empty, WORD).count() == 0


def test_word_split_agrees_with_the_library_on_every_plain_character():
    import re

    from fieldwatch.llm.bpe_codec import PLAIN, WordEncoder, WordSplitter

    spec = tz.tokenizer_text(WORD)
    split, encode = WordSplitter(spec), WordEncoder(spec).encode
    plain = re.compile(f"[{PLAIN}]").match
    for c in map(chr, (*range(0x300), *range(0x370, 0x400), *range(0x1E00, 0x2100), *range(0xFB00, 0xFB10))):
        for text in (f"a{c}1{c}!{c} {c}{c}\n{c}a'S", f"{c}́x"):
            want = split.library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(b"".join(encode(split.words(text))), "<u4").tolist() == want, hex(ord(c))
    assert plain("a")
