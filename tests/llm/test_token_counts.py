import public_tokenizers
import pytest

from fieldwatch.llm import tokenizer as tz
from fieldwatch.llm.token_counts import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "a", "It's  a test\n\n\tof 123 words… naïve ß ½ ²x", "x<|endoftext|>y <|endoftext|>",
         "日本語 テスト 한국어", "؀ࢠꟀ \x1c\x1d odd", "word " * 5000, "z" * 3000, "é 👩‍👩‍👧"]


@pytest.fixture(scope="module")
def library():
    return tz.load_tokenizer(tz.tokenizer_text(PATH))


def test_split_agrees_with_the_library_on_every_plain_character(library):
    import re

    split = tz.Pretokens(tz.tokenizer_text(PATH)).split
    plain = re.compile(f"[{tz.SAME_TABLES}]").match
    for c in map(chr, (*range(0xD800), *range(0xE000, 0x10000))):
        if plain(c):
            text = f"a{c}1{c}!{c} {c}{c}\n{c}a"
            ends = [b for _, (_, b) in library.pre_tokenizer.pre_tokenize_str(text)]
            got, at = [], 0
            for piece in split(text):
                got.append(at := at + len(piece))
            assert got == ends, hex(ord(c))


def test_ranked_encoder_equals_the_library(library):
    enc = tz.ranked_encoder(tz.tokenizer_text(PATH))
    split = tz.Pretokens(tz.tokenizer_text(PATH)).split
    for text in filter(None, TEXTS):
        if split(text) is not None:
            assert enc.encode_ordinary(text) == library.encode(text, add_special_tokens=False).ids


def test_counts_equal_the_library(spark, library):
    rows = [(i, t, "clash", i) for i, t in enumerate(TEXTS)] + [(None, "no id", "x", 1), (3, "a", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, id int")
    for frequent in (1, 1000):
        got = token_counts(docs, PATH, frequent=frequent, cache=50).collect()
        key = lambda r: (r[0] is None, r[0], r[1])
        want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024)
                for i, t, _, _ in rows]
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts(docs, PATH).collect() == []
