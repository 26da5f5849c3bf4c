"""Operator 7: language identification by the nearest centroid.

A text becomes a TF-IDF vector of hashed byte trigrams (Unicode lower case;
ASCII characters other than letters count as one space), scaled to length one.
Each language has up to ``centroids`` centroids, found by spherical k-means over
its own training vectors; the prediction is the language of the centroid with
the largest cosine. ``rejected`` marks texts farther from it than almost all
training texts of that language were from theirs.

Training uses only the text and the non-null language of rows whose
crc32(id as text) is not divisible by 5. Document frequencies are counted over
all of them. The centroids are fitted on a bounded sample: at most ``fit_rows``
rows a language, those with the smallest hash of their id. The threshold of
``rejected`` covers all training rows: Spark adds up a histogram of their cosines
to the nearest centroid of their own language, and the lower edge of the bin with
the ``REJECT_SHARE`` quantile is the language's floor.

The model is languages x centroids vectors of ``DIMS`` floats; more than
``MAX_LANGUAGES`` languages raise an error, so the broadcast has a known bound.

Cases: a null text, or one without a letter, is ``und`` with score 0; a null id
counts as held out and is never learned from; rows that repeat an id are
predicted one by one; without a training row every text is ``und``; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldwatch.llm.textarrays import bytes_of, slices

DIMS = 4096
FIT_ROWS, CENTROIDS, ROUNDS, SEED = 1000, 4, 12, 11
REJECT_SHARE = 0.002
BINS = 4000  # of the cosines from 0 to 1
MAX_LANGUAGES = 1000
_ROWS = 256  # texts in one dense block

_FOLD = np.arange(256, dtype=np.uint32)
for _b in range(128):
    if not (97 <= _b <= 122 or 65 <= _b <= 90):
        _FOLD[_b] = 32


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """(texts x DIMS) counts of hashed trigrams. Nulls must be filled."""
    n = len(texts)
    data, offsets = bytes_of(pc.utf8_lower(texts))
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    folded = _FOLD[data]
    # runs of spaces count as one; a text ends like a word
    single = np.ones(len(folded), bool)
    single[1:] = (folded[1:] != 32) | (folded[:-1] != 32) | (doc[1:] != doc[:-1])
    folded, doc = folded[single], doc[single]
    if len(folded) < 3:
        return np.zeros((n, DIMS), np.float32)
    same = doc[2:] == doc[:-2]
    code = (folded[:-2] << 16 | folded[1:-1] << 8 | folded[2:])[same]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(20)
    counts = np.bincount(doc[2:][same] * DIMS + bucket.astype(np.int64), minlength=n * DIMS)
    return counts.reshape(n, DIMS).astype(np.float32)


def vectors(texts: pa.Array, idf: np.ndarray) -> np.ndarray:
    v = np.sqrt(trigram_counts(texts)) * idf
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.maximum(length, 1e-12)


def _blocks(batch: pa.RecordBatch, text_at: int):
    for part in slices(batch, text_at):
        for at in range(0, part.num_rows, _ROWS):
            yield part.slice(at, _ROWS)


def _document_frequencies(batches):
    total, rows = np.zeros(DIMS, np.int64), 0
    for batch in batches:
        for part in _blocks(batch, 0):
            total += (trigram_counts(part.column(0)) > 0).sum(0)
            rows += part.num_rows
    yield pa.RecordBatch.from_arrays([pa.array([*range(DIMS), -1], pa.int32()), pa.array([*total.tolist(), rows])],
                                     ["bucket", "n"])


def _sample_vectors(idf):
    def run(batches):
        for batch in batches:
            for part in _blocks(batch, 1):
                v = vectors(part.column(1), idf.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.astype("<f4").tobytes() for x in v], pa.binary())], ["lang", "v"])

    return run


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """At most ``k`` unit centroids; starts from rows far apart."""
    rng = np.random.default_rng(seed)
    k = min(k, len(rows))
    picked = [int(rng.integers(len(rows)))]
    nearest = rows @ rows[picked[0]]
    while len(picked) < k:
        picked.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, rows @ rows[picked[-1]])
    centres = rows[picked].copy()
    for _ in range(rounds):
        own = np.argmax(rows @ centres.T, axis=1)
        for c in range(k):
            if (own == c).any():
                mean = rows[own == c].mean(0)
                centres[c] = mean / max(float(np.linalg.norm(mean)), 1e-12)
    return centres


def _centroids(centroids: int, rounds: int, seed: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("v")  # the order of arrival must not matter
        rows = np.stack([np.frombuffer(v, "<f4") for v in group["v"]])
        centres = spherical_kmeans(rows, centroids, rounds, seed)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "v": [c.astype("<f4").tobytes() for c in centres]})

    return run


def _own_cosines(model):
    """Task function: a task's counts of rows (lang, text) by language and cosine bin."""

    def run(batches):
        m = model.value
        kinds = sorted(set(m["langs"]))
        code = {k: n for n, k in enumerate(kinds)}
        of = np.array([code[k] for k in m["langs"]])
        counts = np.zeros((len(kinds), BINS), np.int64)
        for batch in batches:
            for part in _blocks(batch, 1):
                own = np.array([code[k] for k in part.column(0).to_pylist()])
                similar = (vectors(part.column(1), m["idf"]) @ m["centres"].T).astype(np.float64)
                cosine = np.where(own[:, None] == of, similar, 0).max(1)
                np.add.at(counts, (own, np.clip((cosine * BINS).astype(np.int64), 0, BINS - 1)), 1)
        lang, at = counts.nonzero()
        yield pa.RecordBatch.from_arrays(
            [pa.array([kinds[k] for k in lang], pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[lang, at])],
            ["lang", "bin", "n"])

    return run


def _floors(train: DataFrame, model: dict) -> dict[str, float]:
    """Per language the cosine below which at most ``REJECT_SHARE`` of all its training rows lie."""
    shipped = train.sparkSession.sparkContext.broadcast(model)
    bins = (train.select("lang", "text").mapInArrow(_own_cosines(shipped), "lang string, bin int, n long")
            .groupBy("lang", "bin").agg(F.sum("n").alias("n")))
    # at most BINS rows a language
    own = Window.partitionBy("lang")
    ranked = (bins.withColumn("upto", F.sum("n").over(own.orderBy("bin")))
              .withColumn("all", F.sum("n").over(own)))
    found = (ranked.filter(F.col("upto") > REJECT_SHARE * (F.col("all") - 1))
             .groupBy("lang").agg(F.min("bin").alias("bin")).collect())
    return {r["lang"]: r["bin"] / BINS for r in found}


def fit(train: DataFrame, fit_rows: int = FIT_ROWS, centroids: int = CENTROIDS, rounds: int = ROUNDS,
        seed: int = SEED) -> dict | None:
    """The model for rows (id, lang, text) without nulls in lang and text."""
    spark = train.sparkSession
    # rows of one id differ by their text; equal rows fall together, which the lowest makes good
    train = train.withColumn("hash", F.xxhash64(F.col("id").cast("string"), "text", F.lit(seed)))
    bucket = F.pmod("hash", F.lit(1 << 30))
    counts = {r["lang"]: (r["n"], r["low"]) for r in train.groupBy("lang")
              .agg(F.count(F.lit(1)).alias("n"), F.min(bucket).alias("low")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return None
    df = (train.select("text").mapInArrow(_document_frequencies, "bucket int, n long")
          .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    seen = np.zeros(DIMS)
    n_rows = 0
    for r in df:
        if r["bucket"] < 0:
            n_rows = r["n"]
        else:
            seen[r["bucket"]] = r["n"]
    idf = (np.log((1 + n_rows) / (1 + seen)) + 1).astype(np.float32)
    # a first cut by hash leaves about twice the wanted rows of any language, and the lowest always
    share = spark.createDataFrame([(k, min(1.0, (2 * fit_rows + 100) / n), low) for k, (n, low) in counts.items()],
                                  "lang string, share double, low long")
    near = (train.join(F.broadcast(share), "lang")
            .filter((bucket < F.col("share") * (1 << 30)) | (bucket == F.col("low"))))
    ranked = near.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(bucket, "hash", "text")))
    sample = ranked.filter(F.col("rank") <= fit_rows).select("lang", "text")
    shipped = spark.sparkContext.broadcast(idf)
    rows = (sample.mapInArrow(_sample_vectors(shipped), "lang string, v binary").groupBy("lang")
            .applyInPandas(_centroids(centroids, rounds, seed), "lang string, v binary")
            .orderBy("lang", "v").collect())
    model = {"idf": idf, "langs": [r["lang"] for r in rows],
             "centres": np.stack([np.frombuffer(r["v"], "<f4") for r in rows])}
    floors = _floors(train, model)
    return {**model, "floors": np.array([floors[k] for k in model["langs"]])}


def _predicted(model):
    def run(batches):
        m = model.value
        for batch in batches:
            for part in _blocks(batch, 2):
                texts = pc.fill_null(part.column(2), "")
                letters = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
                if m is None:
                    letters = np.zeros(len(texts), bool)
                    best = np.zeros(len(texts), int)
                    cosine = np.zeros(len(texts))
                    langs, floors = [""], np.zeros(1)
                else:
                    similar = vectors(texts, m["idf"]) @ m["centres"].T
                    best = similar.argmax(1)
                    cosine = np.clip(similar[np.arange(len(best)), best], 0, 1).astype(np.float64)
                    langs, floors = m["langs"], m["floors"]
                lang = [langs[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(lang, pa.string()),
                     pa.array(np.where(letters, cosine, 0.0)), pa.array(letters & (cosine < floors[best]))],
                    ["id", "held_out", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             **params) -> DataFrame:
    """One row per row of ``docs``: the id, ``held_out``, ``lang_pred``, ``score``
    (cosine to the nearest centroid) and ``rejected``."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang"), (F.crc32(key) % 5 == 0).alias("held_out"))
    train = rows.filter(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = docs.sparkSession.sparkContext.broadcast(fit(train.select("id", "lang", "text"), **params))
    id_type = rows.schema["id"].dataType.simpleString()
    out = rows.select("id", "held_out", "text").mapInArrow(
        _predicted(model), f"id {id_type}, held_out boolean, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("id", id_col)
