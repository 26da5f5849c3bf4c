import random
import re
import zlib
from collections import Counter

import pytest

import fixture
from fieldwatch.llm.spelling_variants import near_words, variants, word_counts


def counts(rows, min_letters=6, min_count=5, one_in=199):
    out = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            out[run[:h % len(run)] + run[h % len(run) + 1:] if h % one_in == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= min_letters and n >= min_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def want(words, factor=5):
    rows = {}
    for w, n in words.items():
        own = sorted((v for v in words if near(w, v)), key=lambda v: (-words[v], v))
        form = own[0] if own and words[own[0]] >= factor * n else None
        rows[w] = [n, len(own), form, words.get(form)]
    out = {}
    for w, r in rows.items():
        root = w
        while rows[root][2]:
            root = rows[root][2]
        out[w] = (*r, root)
    return out


def lexicon(seed):
    """Words over few letters, so that many are near; rows of equal letters, long words, letters
    beyond a-z; counts that make chains of forms."""
    rng = random.Random(seed)
    words = {"".join(rng.choices("abÿ", k=rng.randint(1, 9))) for _ in range(400)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "a" * 300, "a" * 299 + "b", "a" * 301, "x" + "a" * 299, "straße", "strasse", "strase"}
    words |= {"".join(rng.choices("abc", k=70)) for _ in range(3)} | {"", "a", "b", "ab"}
    return {w: rng.choice([5, 6, 24, 25, 124, 130, 700, 3600, 20000]) for w in words}


def seen(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_variants(spark, seed):
    words = lexicon(seed)
    got = variants(spark.createDataFrame(list(words.items()), "word string, n long").repartition(4))
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert seen(got) == want(words)


def test_every_link_once(spark):
    words = lexicon(3)
    links = near_words(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    pairs = [tuple(sorted((r.word, r.near))) for r in links]
    assert len(pairs) == len(set(pairs))
    known = sorted(words)
    assert set(pairs) == {(a, b) for k, a in enumerate(known) for b in known[k + 1:] if near(a, b)}


def test_words_of_texts(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdé", k=rng.randint(5, 9))).title() for _ in range(60)]
    rows = [(i, rng.choice([" ", ",", "1", "×", "ā", "\n"]).join(rng.choices(vocabulary, k=300))) for i in range(40)]
    rows += [(i, t) for i, t in fixture.documents() if i is None or i > 900] + [(None, "Straße÷" * 9), (3, rows[3][1])]
    docs = fixture.frame(spark, rows)
    for one_in in (199, 3):
        got = word_counts(docs, one_in=one_in)
        assert {r.word: r.n for r in got.collect()} == counts(rows, one_in=one_in)
    assert seen(variants(word_counts(docs, one_in=3))) == want(counts(rows, one_in=3))


def test_empty(spark):
    assert variants(word_counts(fixture.frame(spark, [], extra=False))).count() == 0
