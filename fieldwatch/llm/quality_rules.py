"""Operator 4: quality rules judged by an isolation forest.

Each document gets rule statistics (numpy over whole Arrow batches). The base
rules reject short and repetitive texts outright. An isolation forest over
ratios of the statistics judges the rest: random axis-parallel splits isolate
odd documents after few steps, so a short mean path means an anomaly.

* Fit: a bounded sample of labelled rows that pass the base rules (at most
  ``fit_rows``, those with the smallest hash of their id; the bound is a
  parameter of the method). Each of ``trees`` trees splits the box that the
  sample spans at random, down to ``DEPTH`` levels, and counts ``tree_rows`` of
  the sample's good rows in the parts. Cuts fall anywhere in the box, not only
  between good rows, so what lies beside them is cut off after few steps.
* Threshold: calibrated on *all* labelled rows that pass the base rules. A
  histogram of their scores (``bins`` bins, aggregated by Spark) gives the cut
  that best separates good from bad while it rejects at most ``loss`` of the
  good rows. Without rows of both kinds nothing is rejected by the forest.
* Verdict: every document is scored; ``kept`` is false if a base rule failed or
  its score lies above the cut.

The statistics are written once to the shared folder; fitting and calibration
read that narrow table, not the texts.

Cases: a null text has no words (all statistics 0, base_failed true); empty
texts likewise; rows with a null id are scored but never used as labelled rows;
repeated ids are scored row by row, and labels that contradict each other for
an id are not used; an empty table gives no rows; other columns are carried by
``keep_good`` untouched. Memory follows the Arrow batch: documents are worked
through in slices of ``SLICE`` bytes, a longer text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import materialise, with_columns
from fieldwatch.llm.textarrays import mix, slices, word_hashes, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20

TREES, TREE_ROWS, DEPTH, FIT_ROWS, BINS, LOSS, SEED = 200, 1024, 10, 20_000, 2_000, 0.005, 17
ID, TEXT = "id", "text"
BOX = 0.002  # share of the sample left outside the box on each side of an axis

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_upper", "n_punct", "n_distinct_words"]

_KIND = np.zeros(256, np.uint8)  # 1 symbol, 2 upper case, 3 other ASCII punctuation
for _c in range(33, 127):
    _s = chr(_c)
    _KIND[_c] = 1 if _s in SYMBOLS else 2 if _s.isupper() else 0 if _s.isalnum() else 3


def _per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(names: np.ndarray, first: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Per word: does a window of ``width`` words that occurs twice or more in its
    document cover it? ``first`` are the documents' offsets into ``names``."""
    n = len(names)
    covered = np.zeros(n, bool)
    if n < width:
        return covered
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts = np.flatnonzero(doc[: n - width + 1] == doc[width - 1:])
    if not len(starts):
        return covered
    key = mix(doc[starts].astype(np.uint64) + np.uint64(1))
    for k in range(width):
        key = mix(key ^ names[starts + k])
    order = np.argsort(key)
    equal = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(starts), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts[twice], 1)
    np.add.at(edge, starts[twice] + width, -1)
    return np.cumsum(edge[:-1]) > 0


def _duplicate_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def text_statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of a slice of texts (nulls filled with empty texts)."""
    w = words_of(texts)
    names = word_hashes(w)
    lead = (w.data & 0xC0) != 0x80  # first bytes of code points
    kind = _KIND[w.data]
    distinct = np.zeros(len(texts), np.int64)
    if len(names):
        doc = np.repeat(np.arange(len(texts)), np.diff(w.first))
        _, at = np.unique(mix(names ^ mix(doc.astype(np.uint64) + np.uint64(7))), return_index=True)
        distinct = np.bincount(doc[at], minlength=len(texts)).astype(np.int64)
    return {
        "n_words": np.diff(w.first),
        "word_chars": _per_doc(lead & w.inside, w.offsets),
        "n_symbols": _per_doc(kind == 1, w.offsets),
        "n_dup_lines": np.array([_duplicate_lines(t) for t in texts.to_pylist()], np.int64),
        "n_repeat_words": _per_doc(repeated_words(names, w.first), w.first),
        "n_upper": _per_doc(kind == 2, w.offsets),
        "n_punct": _per_doc(kind == 3, w.offsets),
        "n_distinct_words": distinct,
    }


def _with_statistics(text_at: int, names: list[str]):
    def run(batches):
        for batch in batches:
            for part in slices(batch, text_at):
                stats = text_statistics(pc.fill_null(part.column(text_at), ""))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *[pa.array(stats[n].astype(np.int64)) for n in STATS + MORE]], names)

    return run


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """What does not depend on a document's length, one row per document: symbols,
    upper case, punctuation and characters to a word, share of repeated words,
    and variety of words."""
    f = {k: np.asarray(v, np.float64) for k, v in stats.items()}
    words = np.maximum(f["n_words"], 1)
    return np.column_stack([f["n_symbols"] / words, f["n_upper"] / words, f["n_punct"] / words,
                            f["word_chars"] / words, f["n_repeat_words"] / words,
                            np.log1p(f["n_distinct_words"]) / np.log1p(words)])


def path_norm(n) -> np.ndarray:
    """Mean path length of an unsuccessful search in a random tree of n rows."""
    n = np.asarray(n, np.float64)
    big = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(big - 1) + 0.5772156649015329) - 2 * (big - 1) / big, np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Random axis-parallel splits of a box; all trees as flat arrays of one depth."""

    def __init__(self, good: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES,
                 tree_rows: int = TREE_ROWS, depth: int = DEPTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.rows, self.depth = min(tree_rows, len(good)), depth
        nodes = 2 ** (depth + 1) - 1
        self.axis = np.zeros((trees, nodes), np.int64)
        self.cut = np.full((trees, nodes), np.inf)
        self.length = np.zeros((trees, nodes))
        for t in range(trees):
            own = good[rng.choice(len(good), self.rows, replace=False)]
            self._grow(rng, t, 0, 0, own, low, high)

    def _grow(self, rng, t: int, node: int, depth: int, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        wide = np.flatnonzero(high > low)
        if depth == self.depth or len(rows) <= 1 or not len(wide):
            self._leaf(t, node, depth, depth + float(path_norm(len(rows))))
            return
        axis = int(rng.choice(wide))
        cut = rng.uniform(low[axis], high[axis])
        self.axis[t, node], self.cut[t, node] = axis, cut
        left, edge = rows[:, axis] < cut, np.arange(len(low)) == axis
        self._grow(rng, t, 2 * node + 1, depth + 1, rows[left], low, np.where(edge, cut, high))
        self._grow(rng, t, 2 * node + 2, depth + 1, rows[~left], np.where(edge, cut, low), high)

    def _leaf(self, t: int, node: int, depth: int, length: float) -> None:
        """A leaf above full depth hands its path length down its left spine."""
        self.length[t, node] = length
        while depth < self.depth:
            node, depth = 2 * node + 1, depth + 1
            self.length[t, node] = length

    def arrays(self) -> dict:
        """The forest as plain arrays, which workers read without this class."""
        return {"axis": self.axis, "cut": self.cut, "length": self.length, "depth": self.depth, "rows": self.rows}


def anomaly(forest: dict, rows: np.ndarray) -> np.ndarray:
    """Anomaly score in (0, 1): 2 ** (-mean path / expected path)."""
    total = np.zeros(len(rows))
    at_row = np.arange(len(rows))
    for axis, cut, length in zip(forest["axis"], forest["cut"], forest["length"]):
        node = np.zeros(len(rows), np.int64)
        for _ in range(forest["depth"]):
            node = 2 * node + 1 + (rows[at_row, axis[node]] >= cut[node])
        total += length[node]
    expected = max(float(path_norm(forest["rows"])), 1e-9)
    return 2.0 ** (-(total / len(forest["axis"])) / expected)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def _scored(forest, names: list[str], at: list[int]):
    def run(batches):
        trees = forest.value
        for batch in batches:
            stats = {n: batch.column(i).to_numpy() for n, i in zip(STATS + MORE, at)}
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(anomaly(trees, features(stats)))], names)

    return run


def _with_score(stats: DataFrame, forest, score: str) -> DataFrame:
    names = [*stats.columns, score]
    at = [stats.columns.index(n) for n in STATS + MORE]
    return stats.mapInArrow(_scored(forest, names, at), with_columns(stats, [score], "double"))


def fit_forest(labelled: DataFrame, fit_rows: int = FIT_ROWS, trees: int = TREES, tree_rows: int = TREE_ROWS,
               depth: int = DEPTH, seed: int = SEED) -> IsolationForest | None:
    """A forest on at most ``fit_rows`` labelled rows (columns ``id``, ``quality``
    and the statistics), those with the smallest hash of their id."""
    rows = (labelled.orderBy(F.xxhash64(F.col("id"), F.lit(seed)), "id", *STATS, *MORE).limit(fit_rows)
            .select("quality", *STATS, *MORE).toArrow())
    values = features({n: rows.column(n).to_numpy() for n in STATS + MORE})
    good = values[rows.column("quality").to_numpy() == 1]
    if len(good) < 2:
        return None
    low, high = np.quantile(values, BOX, axis=0), np.quantile(values, 1 - BOX, axis=0)
    return IsolationForest(good, low, high, trees, tree_rows, depth, seed)


def calibrate(scored: DataFrame, bins: int = BINS, loss: float = LOSS) -> float:
    """The cut on the score: of the cuts that reject at most ``loss`` of the good
    rows, the one with the largest share of bad minus share of good rows above
    it. 1.0 (nothing rejected) without rows of both kinds."""
    bin_of = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).alias("bin")
    rows = scored.groupBy(bin_of).agg(F.sum(F.col("quality")).alias("good"),
                                      F.sum(1 - F.col("quality")).alias("bad")).collect()
    good, bad = np.zeros(bins), np.zeros(bins)
    for r in rows:
        good[r["bin"]], bad[r["bin"]] = r["good"], r["bad"]
    if not good.sum() or not bad.sum():
        return 1.0
    above_good = 1 - np.cumsum(good) / good.sum()  # share above the upper edge of each bin
    above_bad = 1 - np.cumsum(bad) / bad.sum()
    gain = np.where(above_good <= loss + 1e-12, above_bad - above_good, -1.0)
    best = np.flatnonzero(gain == gain.max())
    # of equally good cuts the middle one: it lies between the kinds
    return float((best[len(best) // 2] + 1) / bins) if gain.max() > 0 else 1.0


def _measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, statistics), written: all later steps but the last read this table."""
    source = docs.select(F.col(id_col).alias(ID), F.col(text_col).alias(TEXT))
    rows = source.mapInArrow(_with_statistics(1, [ID, TEXT, *STATS, *MORE]),
                             with_columns(source, STATS + MORE, "long"))
    return materialise(rows.drop(TEXT), "quality-statistics")


def _model(stats: DataFrame, labels: DataFrame, id_col: str, params: dict):
    """(broadcast forest or None, cut) from the labelled rows of the statistics."""
    known = (labels.select(F.col(id_col).alias(ID), F.col("quality").cast("int").alias("quality"))
             .filter(F.col("quality").isin(0, 1))
             .groupBy(ID).agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
             .filter(F.col("quality") == F.col("other")).drop("other"))
    labelled = materialise(stats.filter(~base_failed()).join(known, ID), "quality-labelled")
    forest = fit_forest(labelled, **{k: v for k, v in params.items() if k not in ("bins", "loss")})
    if forest is None:
        return None, 1.0
    # trees x 2^(depth + 1) nodes: fixed size
    shipped = stats.sparkSession.sparkContext.broadcast(forest.arrays())
    to_cut = {k: v for k, v in params.items() if k in ("bins", "loss")}
    return shipped, calibrate(_with_score(labelled, shipped, "score"), **to_cut)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row per row of ``docs``: the id, the statistics, ``base_failed``, ``score``
    and ``kept``. ``labels``: the id and ``quality`` (1 good, 0 bad)."""
    stats = _measured(docs, id_col, text_col)
    forest, cut = _model(stats, labels, id_col, params)
    scored = stats.withColumn("score", F.lit(0.0)) if forest is None else _with_score(stats, forest, "score")
    return scored.select(F.col(ID).alias(id_col), *STATS, base_failed().alias("base_failed"), "score",
                         (~base_failed() & (F.col("score") < cut)).alias("kept"))


def _kept_rows(forest, cut: float, text_at: int):
    """Task function: the rows that pass the base rules and the forest."""

    def run(batches):
        trees = forest.value if forest is not None else None
        for batch in batches:
            for part in slices(batch, text_at):
                stats = text_statistics(pc.fill_null(part.column(text_at), ""))
                keep = ~((stats["n_words"] < MIN_WORDS)
                         | (100 * stats["n_repeat_words"] > REPEAT_PERCENT * stats["n_words"]))
                if trees is not None:
                    keep &= anomaly(trees, features(stats)) < cut
                yield part.filter(pa.array(keep))

    return run


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              **params) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns. Each row is
    judged by its own text in one pass, so rows that share an id are judged apart."""
    forest, cut = _model(_measured(docs, id_col, text_col), labels, id_col, params)
    return docs.mapInArrow(_kept_rows(forest, cut, docs.columns.index(text_col)), docs.schema)
