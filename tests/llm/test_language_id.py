import math
import random
import zlib
from collections import Counter

from fieldwatch.llm.language_id import identify

SYLLABLES = {"aa": ["ka", "ro", "mi"], "bb": ["sch", "über", "ein"], "cc": ["что", "это", "на"]}


def say(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def rows():
    rng = random.Random(5)
    out = [(i, say(rng, lang := rng.choice(list(SYLLABLES)), rng.randint(5, 60)), lang, "s") for i in range(300)]
    odd = [None, "", "123 456", "!!!", "x", " \n", "ka" * 5000, "مرحبا"]
    return out + [(1000 + k, t, None, "s") for k, t in enumerate(odd)] + [out[3], (None, "ka ro", "aa", "s")]


def frame(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, lang string, held_out string").repartition(3)


def test_predictions(spark):
    data = rows()
    got = identify(frame(spark, data), fit_rows=50).collect()
    assert len(got) == len(data)
    right = [r.lang_pred == l for r in got for i, _, l, _ in data[:300] if r.doc_id == i and held_out(i)]
    assert len(right) > 40 and sum(right) / len(right) > 0.98
    by_id = {r.doc_id: r for r in got}
    for k in (0, 1, 2, 3, 5):
        assert (by_id[1000 + k].lang_pred, by_id[1000 + k].score) == ("und", 0.0)
    for k in (4, 6, 7):
        assert by_id[1000 + k].lang_pred in SYLLABLES
    assert by_id[1007].rejected
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == held_out(r.doc_id) for r in got if r.doc_id is not None)
    assert by_id[None].held_out  # its text for crc32 is empty


def test_held_out_rows_teach_nothing(spark):
    data = [r for r in rows() if r[0] is not None]
    lied = [(i, t, "zz" if held_out(i) else lang, s) for i, t, lang, s in data]
    a, b = (sorted(map(tuple, identify(frame(spark, d), fit_rows=50).collect())) for d in (data, lied))
    assert a == b


def test_without_training_rows(spark):
    got = identify(frame(spark, [(1, "some text", None, "s"), (2, None, None, "s")])).collect()
    assert {r.lang_pred for r in got} == {"und"}
    assert identify(frame(spark, [])).count() == 0


def test_threshold_covers_all_training_rows(spark):
    """A small fit sample must not set the threshold: of all training rows of a language
    hardly any are rejected."""
    data = [r for r in rows() if r[0] is not None and r[2]]
    got = {r.doc_id: r for r in identify(frame(spark, data), fit_rows=10).collect()}
    for lang in SYLLABLES:
        own = [got[i] for i, _, kind, _ in data if kind == lang and not held_out(i)]
        assert len(own) > 50 and sum(r.rejected for r in own if r.lang_pred == lang) <= 0.002 * len(own)


def test_one_id_for_many_rows(spark):
    """A language all of whose rows share an id, or are one row many times, has a model."""
    rng = random.Random(9)
    own = [i for i in range(1, 60) if not held_out(i)]
    many = [(own[0], say(rng, "aa", 12), "aa", "s") for _ in range(3000)]
    same = [(own[1], "schein übersch einein", "bb", "s")] * 3000
    few = [(i, say(rng, "cc", 12), "cc", "s") for i in own]
    for data, langs in ((many, {"aa"}), (same, {"bb"}), (many + few, {"aa", "cc"}), (same + few + many, set(SYLLABLES))):
        got = identify(frame(spark, data), fit_rows=20).collect()
        assert len(got) == len(data) and {r.lang_pred for r in got} == langs


def trigrams(text):
    """bucket -> count of hashed byte trigrams, one by one"""
    folded = [b if b > 127 or chr(b).isalpha() else 32 for b in text.lower().encode()]
    single = [b for k, b in enumerate(folded) if b != 32 or k == 0 or folded[k - 1] != 32]
    return Counter(((a << 16 | b << 8 | c) * 0x9E3779B1 % 2**32) >> 20 for a, b, c in zip(single, single[1:], single[2:]))


def scaled(v):
    size = math.sqrt(sum(x * x for x in v.values()))
    return {k: x / size for k, x in v.items()} if size else {}


def test_against_brute_force(spark):
    """TF-IDF vectors, one centroid a language, cosines and thresholds, term by term."""
    data = [r for r in rows() if r[0] is not None]
    train = [(t, lang) for i, t, lang, _ in data if lang and t and not held_out(i)]
    seen = Counter(b for t, _ in train for b in trigrams(t))
    idf = lambda b: math.log((1 + len(train)) / (1 + seen[b])) + 1
    vector = lambda t: scaled({b: math.sqrt(n) * idf(b) for b, n in trigrams(t).items()})
    centre = {}
    for lang in SYLLABLES:
        total = Counter()
        for t, own in train:
            if own == lang:
                total.update(vector(t))
        centre[lang] = scaled(total)
    cosine = lambda t, lang: sum(x * centre[lang].get(b, 0) for b, x in vector(t).items())
    own = {lang: sorted(cosine(t, lang) for t, k in train if k == lang) for lang in SYLLABLES}
    floor = {k: math.floor(v[math.floor(0.002 * (len(v) - 1))] * 4000) / 4000 for k, v in own.items()}
    got = identify(frame(spark, data), fit_rows=1000, centroids=1).collect()
    texts = {i: t for i, t, _, _ in data}
    assert len(got) == len(data)
    for r in got:
        text = texts[r.doc_id]
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, False)
            continue
        best = {k: cosine(text, k) for k in SYLLABLES}
        assert abs(best[r.lang_pred] - max(best.values())) < 1e-5
        assert abs(r.score - min(max(best[r.lang_pred], 0), 1)) < 1e-4
        if abs(r.score - floor[r.lang_pred]) > 1e-3:
            assert r.rejected == (r.score < floor[r.lang_pred])
