from collections import Counter

import pytest

import brute
import fixture
from fieldwatch.llm.line_dedup import RUN, WORDS, drop_repeated_lines, line_report


def table(seed=2):
    import random

    rng = random.Random(seed)
    lines = [f"line {k} {'x' * (k % 7)}" for k in range(30)] + ["", " ", "the"]
    rows = [(i * 7 % 101, "\n".join(rng.choices(lines, weights=[1] * 30 + [6, 2, 9], k=rng.randint(1, 12))))
            for i in range(80)]
    passage = "\n".join(lines[:8])
    rows += [(200 + k, f"head {k}\n{passage}\ntail {k}") for k in range(6)]
    rows += [(300, None), (301, ""), (302, "\n\n\n\n\n"), (303, " \n\t\n\n \n"), (304, "a\nb\nc\na\nb\nc\na\nb\nc"),
             (305, "\n".join(["same"] * 9)), (306, "\n".join(f"long {k}" for k in range(3000))), (307, passage),
             (None, passage), (308, "x\r\ny\r\nz\r"), (309, "x\r\ny\r\nz\r")]
    return rows


def want(rows):
    """The brute-force version, windows without a word left alone."""
    out = []
    for (i, n, gone, kept), (_, text) in zip(brute.lines_removed(rows, RUN), rows):
        out.append((i, n, gone, brute.sha(kept)))
    return Counter(out)


@pytest.mark.parametrize("seed", [2, 3])
def test_lines(spark, seed):
    rows = table(seed)
    got = line_report(fixture.frame(spark, rows))
    assert Counter((r.doc_id, r.n_lines, r.n_removed, r.kept_sha256) for r in got.collect()) == want(rows)
    one = {r.doc_id: r for r in got.collect()}
    assert one[302].n_removed == 0 and one[303].n_removed == 0  # runs without a word do not count
    assert one[304].n_runs == 1 and one[305].n_runs == 1


def test_drop_repeated_lines(spark):
    rows = table()
    docs = fixture.frame(spark, rows)
    out = drop_repeated_lines(docs)
    assert out.schema == docs.schema
    assert {r.doc_id: r.text for r in out.collect() if r.doc_id == 300} == {300: None}
    kept = Counter((i, brute.sha(k)) for i, _, _, k in brute.lines_removed(rows, RUN))
    assert Counter((r.doc_id, brute.sha(r.text or "")) for r in out.collect()) == kept


def test_empty(spark):
    assert line_report(fixture.frame(spark, [], extra=False)).count() == 0


def test_repeated_rows(spark):
    """Of rows with one id and text, one keeps its lines."""
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc")]
    got = line_report(fixture.frame(spark, rows, extra=False)).collect()
    assert sorted(r.n_removed for r in got) == [0, 3, 3]


def short_and_long(rows):
    """What windows of RUN lines, and shorter ones of at least WORDS words, remove by brute force."""
    lines = [(t or "").split("\n") for _, t in rows]
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, n))
    gone = [set() for _ in rows]
    for width in range(1, RUN + 1):
        seen = set()
        for n in order:
            for k in range(len(lines[n]) - width + 1):
                own = tuple(lines[n][k:k + width])
                if len(brute.words(" ".join(own))) < (1 if width == RUN else WORDS):
                    continue
                if own in seen:
                    gone[n].update(range(k, k + width))
                seen.add(own)
    return Counter((i, len(ls), len(g), brute.sha("\n".join(x for k, x in enumerate(ls) if k not in g)))
                   for (i, _), ls, g in zip(rows, lines, gone))


def test_short_runs_of_many_words(spark):
    """One and two repeated lines go if they have words enough, whole texts included."""
    licence = "this line of a licence has words enough for itself"
    first, second = "five words in this half", "and four in that"
    rows = [(401, f"a\n{licence}\nb"), (402, f"c\n{licence}\nd"), (403, licence), (404, f"e\n{first}\n{second}\nf"),
            (405, f"g\n{first}\n{second}\nh"), (406, f"{first}\n{second}"), (407, f"i\n{first}\nj\n{second}"),
            (408, "seven words are too few for this"), (409, "seven words are too few for this"),
            (410, f"{licence}\n{licence}\nk"), (None, licence), (411, None), *table()]
    docs = fixture.frame(spark, rows, extra=False)
    report = line_report(docs).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_removed, r.kept_sha256) for r in report) == short_and_long(rows)
    removed = {r.doc_id: (r.n_removed, r.n_runs) for r in report}
    assert removed[401] == (0, 0) and removed[402] == (1, 1) and removed[403] == (1, 1) and removed[410] == (2, 1)
    assert removed[404] == (0, 0) and removed[405] == (2, 1) and removed[406] == (2, 1) and removed[407] == (0, 0)
    texts = {r.doc_id: r.text for r in drop_repeated_lines(docs).collect()}
    assert texts[402] == "c\nd" and texts[403] == "" and texts[405] == "g\nh" and texts[411] is None
    assert {r.n_removed for r in line_report(docs, words=None).collect() if r.doc_id in (402, 405)} == {0}
