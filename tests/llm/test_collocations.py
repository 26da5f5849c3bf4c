import random
import re
from collections import Counter

import numpy as np
import pytest

from fieldwatch.llm.blocks import _from_planes
from fieldwatch.llm.collocations import Summary, collocations, frequent_phrases, survivors

SCHEMA = "lang string, text string"


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def count(rows, longest=5):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return f, n


def want(rows, least, longest=5, top=2000, absorb=100):
    f, n = count(rows, longest)
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, w), a in found.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inside[lang, w[i:i + m]] = max(inside[lang, w[i:i + m]], a)
    out = {}
    for (lang, w), a in found.items():
        if inside[lang, w] and 100 * inside[lang, w] >= absorb * a:
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                             for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, k + 1, p.decode(), -a, l, r, n[lang], -s)
                  for lang, own in out.items() for k, (s, a, p, l, r) in enumerate(sorted(own)[:top]))


def table(seed=5):
    rng = random.Random(seed)
    words = ["The", "the", "of", "é", "日本", "x y", "a-b", "Zz", "<s>", "", "end.", "and,", "no\tgap", "line\n", "cr\r\x0b"] \
        + [f"w{k}" for k in range(25)]
    rows = [(rng.choice(["en", "de", None, "und", ""]), " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randint(0, 120))))
            for _ in range(200)]
    rows += [("en", "New York City hall ! new  york\tcity hall; NEW YORK CITY HALL\n" * 20), ("en", "one two three four five six " * 40),
             (None, None), ("en", None), ("de", ""), ("fr", "  \t "), ("fr", "solo"), ("de", "a " * 500), rows[0], rows[0]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA + ", phrase string, words int, n long").repartition(3)


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("least, longest, top, absorb", [(8, 5, 2000, 100), (3, 4, 7, 60), (20, 2, 50, 100)])
def test_collocations(spark, least, longest, top, absorb):
    rows = table()
    got = collocations(frame(spark, rows), least, longest, top, absorb)
    assert rows_of(got) == want(rows, least, longest, top, absorb) and got.columns == [
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_many_passes_and_crowded_bitmaps_change_nothing(spark):
    rows = table(6)
    assert rows_of(collocations(frame(spark, rows), 5, served=40, bitmap=1 << 6)) == want(rows, 5)


def test_counts_of_frequent_phrases(spark):
    rows = table(7)
    f, n = count(rows)
    got = {(r.lang, r.phrase): r.f for r in frequent_phrases(frame(spark, rows), 6).collect()}
    assert got == {(lang, " ".join(w)): a for (lang, w), a in f.items() if a >= 6} | {(k, ""): v for k, v in n.items() if v or k in got}


@pytest.mark.parametrize("seed", range(6))
def test_every_frequent_name_survives_with_few_counters(seed):
    """Counters of mass / least, folded in any order, lose no name of ``least`` occurrences."""
    rng = np.random.default_rng(seed)
    least, names = 50, rng.zipf(1.3, 60_000).astype(np.uint64) % np.uint64(1 << 30)
    summary = Summary(len(names) // least + 1)
    for part in np.array_split(names, 23):
        own, counts = np.unique(part, return_counts=True)
        summary.add(own, counts.astype(np.uint32))
        summary.fold()
    own, counts = np.unique(names, return_counts=True)
    assert len(summary.names) <= len(names) // least + 1 and 0 < summary.taken < least
    kept = summary.names[summary.counts + summary.taken >= least]
    assert set(own[counts >= least]) <= set(kept)
    exact = dict(zip(own, counts))
    assert all(exact[k] - summary.taken <= c <= exact[k] for k, c in zip(summary.names, summary.counts))


def test_summaries_leave_few_names(spark):
    rows = table(8)
    f, _ = count(rows)
    left = survivors(frame(spark, rows).select("lang", "text"), 4, 10, 5).collect()
    assert sum(r.n for r in left) == sum(a >= 10 for a in f.values())
    assert all(len(_from_planes(r.names, r.n, np.uint64)) == r.n for r in left)


def test_empty(spark):
    assert collocations(frame(spark, [])).count() == 0
    assert collocations(frame(spark, [(None, None), ("en", "")])).count() == 0
