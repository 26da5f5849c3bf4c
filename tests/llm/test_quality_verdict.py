"""The verdict of the quality rules against a walk through every tree, row by row."""

import math

import brute
import fixture
from fieldwatch.llm.quality_rules import BINS, LOSS, MORE, STATS, fit_forest, judge

ROWS = fixture.documents()


def more(text):
    text = text or ""
    punct = sum(33 <= ord(c) < 127 and not c.isalnum() and c not in "#*$%&|<>" for c in text)
    return sum("A" <= c <= "Z" for c in text), punct, len(set(brute.words(text)))


def ratios(s):
    n = max(s["n_words"], 1)
    return [s["n_symbols"] / n, s["n_upper"] / n, s["n_punct"] / n, s["word_chars"] / n, s["n_repeat_words"] / n,
            math.log1p(s["n_distinct_words"]) / math.log1p(n)]


def path(n):
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def walked(forest, row):
    total = 0.0
    for axis, cut, length in zip(forest.axis, forest.cut, forest.length):
        node = 0
        while math.isfinite(cut[node]):
            node = 2 * node + (1 if row[axis[node]] < cut[node] else 2)
        total += length[node]
    return 2 ** (-total / len(forest.axis) / path(forest.rows))


def best_cut(scored):
    """scored: (score, quality); the cut among the edges of all bins"""
    good = [min(int(s * BINS), BINS - 1) for s, q in scored if q]
    bad = [min(int(s * BINS), BINS - 1) for s, q in scored if not q]
    gain = []
    for b in range(BINS):
        lost = sum(x > b for x in good) / len(good)
        gain.append(sum(x > b for x in bad) / len(bad) - lost if lost <= LOSS + 1e-12 else -1.0)
    best = [b for b, g in enumerate(gain) if abs(g - max(gain)) < 1e-9]
    return (best[len(best) // 2] + 1) / BINS if max(gain) > 0 else 1.0


def test_scores_and_verdicts(spark):
    rows = ROWS + [(5000 + k, "## $$ | " + " ".join(f"%%{j}$ &<{j * k}>#" for j in range(6 + k))) for k in range(12)]
    quality = {i: int(i < 5000) for i, _ in rows if i is not None and i % 2 == 0}
    stats = []
    for i, t in rows:
        own, failed = brute.rule_statistics(t)
        stats.append((i, failed, dict(zip(STATS + MORE, own + more(t)))))
    labelled = [(i, quality[i], *s.values()) for i, failed, s in stats if not failed and i in quality]
    schema = "id long, quality int, " + ", ".join(f"{n} long" for n in STATS + MORE)
    forest = fit_forest(spark.createDataFrame(labelled, schema), fit_rows=1000, trees=20)
    score = [walked(forest, ratios(s)) for _, _, s in stats]
    cut = best_cut([(x, quality[i]) for x, (i, failed, _) in zip(score, stats) if not failed and i in quality])
    want = sorted((str(i), *list(s.values())[:5], failed, not failed and x < cut, x)
                  for x, (i, failed, s) in zip(score, stats))
    labels = spark.createDataFrame(list(quality.items()), "doc_id long, quality int")
    frame = fixture.frame(spark, rows, extra=False)
    got = sorted((str(r.doc_id), *[r[n] for n in STATS], r.base_failed, r.kept, r.score)
                 for r in judge(frame, labels, fit_rows=1000, trees=20).collect())
    assert [g[:-1] for g in got] == [w[:-1] for w in want]
    assert all(abs(g[-1] - w[-1]) < 1e-9 for g, w in zip(got, want))
    assert cut < 1 and any(not failed and x >= cut for x, (_, failed, _) in zip(score, stats))
