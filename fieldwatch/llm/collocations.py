"""Operator 13: frequent phrases that stick together, by Misra-Gries summaries.

A phrase is 1 to ``longest`` consecutive words of one piece of a text; everything is
counted per language.

1. Summaries. A task names the phrases of some megabytes of text by 64-bit
   fingerprints of language and words and counts the distinct names. What falls into
   one hash partition (a range of the names' upper ``BITS`` bits) is a summary of that
   partition, packed into one row, whatever the number of its phrases.
2. Merge. One task a hash partition first learns the partition's mass (all phrase
   occurrences there: small rows that sort first) and takes ``mass // least + 1``
   counters. It folds the summaries into them: counts of equal names add up, and
   whenever more names than counters are left, the largest count beyond the counters
   is taken off all. Every unit taken off goes with one off each counter, so the total
   taken off any name stays below mass / counters < ``least``: every phrase with
   ``least`` occurrences survives. Memory is a hundredth (1 / ``least``) of the
   partition's mass, however many distinct phrases there are.
3. Count. The survivors' names become a bitmap of fixed size (``BITMAP`` bits, the only
   thing that is broadcast). A second pass over all texts counts the phrases whose
   name has its bit; names decide nothing any more, the phrases themselves are summed
   up by Spark. A wrong name can only cost a row. If there are more survivors than one
   bitmap serves well, the pass is made once for each share of the names.
4. Score. Parts of a frequent phrase are frequent too, so the counts of both halves of
   each cut come from the same table by equality joins, products as decimals of 38
   digits. The best ``top`` of each language are cut per task before they meet.

A phrase in a third of all texts is one row for each summary and one counter.

Cases: a null text counts as empty, which has no words; a null language is ``und``, with
the documents that say so; rows that repeat an id are counted like others; texts are
taken whole; an empty table gives no rows; further columns, whatever their names, are
not looked at. Counts below 10^18 are exact, products to 38 digits.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.llm.blocks import _from_planes, _planes
from fieldwatch.llm.common import materialise, total_bytes
from fieldwatch.llm.textarrays import Fingerprints, bytes_of, slices

LEAST, LONGEST, TOP, ABSORB = 100, 5, 2000, 100
#: bits of a phrase's name that the summaries keep
BITS = 40
#: names a task counts before it sends a summary, and bytes of text it takes at a time
SUMMARY, SLICE = 3_000_000, 1_000_000
#: bytes of text whose phrases one hash partition takes; its counters are about a hundredth of them
PART_BYTES = 100_000_000
#: bits of the survivors' bitmap (16 MB), and survivors that one serves
BITMAP, SERVED = 1 << 27, 1 << 23
COUNT_BITS = np.uint64(64 - BITS)

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_SPACE = _BREAK.copy()
_SPACE[[0x20, 9]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ONE = pa.scalar(" ", pa.large_string())


class Phrases(NamedTuple):
    """The words of some texts, ready to name phrases."""

    words: pa.Array
    lang: np.ndarray  # of each word, a number in langs
    langs: list
    piece: np.ndarray  # of each word
    hashes: np.ndarray  # of each word with its language

    def places(self, k: int) -> np.ndarray:
        """Words that begin a phrase of k words."""
        if len(self.piece) < k:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[: len(self.piece) - k + 1] == self.piece[k - 1:])


def phrases_of(batch: pa.RecordBatch) -> Phrases:
    """Words of a batch (lang, text)."""
    lang = pc.fill_null(batch.column(0), "und").dictionary_encode()
    data, offsets = bytes_of(pc.fill_null(batch.column(1), ""))
    inside = ~_SPACE[data]
    data = _LOWER[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(offsets, starts, side="right") - 1
    piece = np.cumsum(_BREAK[data], dtype=np.int64)[starts] + text if len(starts) else np.zeros(0, np.int64)
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(data[inside]))
    langs = lang.dictionary.to_pylist()
    code = lang.indices.to_numpy(zero_copy_only=False)[text].astype(np.int64)
    name, where = bytes_of(pa.array(langs, pa.large_string()))
    salt = Fingerprints(name, 11).of(where[:-1], where[1:]) if len(langs) else np.zeros(0, np.uint64)
    hashes = Fingerprints(data, 12).of(starts, ends) ^ salt[code] if len(starts) else np.zeros(0, np.uint64)
    return Phrases(words, code, langs, piece, hashes)


# ---- first pass ---------------------------------------------------------------------

#: kind 0: the mass that a summary adds to a partition; kind 1: the summary
SUMMARY_SCHEMA = "part int, kind int, mass long, n int, names binary, counts binary"
_SUMMARY_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
_SUMMARY_NAMES = ["part", "kind", "mass", "n", "names", "counts"]


def _summaries(parts: int, longest: int):
    """Task function: (lang, text) -> summaries."""

    def run(batches):
        held, have = [], 0
        for batch in batches:
            for piece in slices(batch, 1, SLICE):
                p = phrases_of(piece)
                names = Fingerprints(p.hashes, 13)
                for k in range(1, longest + 1):
                    at = p.places(k)
                    held.append(names.of(at, at + k) >> COUNT_BITS)
                    have += len(at)
                if have >= SUMMARY:
                    yield _summary_rows(held, parts)
                    held, have = [], 0
        if have:
            yield _summary_rows(held, parts)

    return run


def _summary_rows(held: list, parts: int) -> pa.RecordBatch:
    names = np.sort(np.concatenate(held))
    held.clear()
    at = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    counts = np.diff(at, append=len(names)).astype(np.uint32)
    names = names[at]
    rows = []
    edges = np.searchsorted(names, np.array([_edge(p, parts) for p in range(parts + 1)], np.uint64))
    for p in np.flatnonzero(np.diff(edges)):
        a, b = edges[p], edges[p + 1]
        mass = int(counts[a:b].sum(dtype=np.int64))
        rows.append((p, 0, mass, 0, None, None))
        rows.append((p, 1, 0, b - a, _planes(np.diff(names[a:b], prepend=np.uint64(0))), _planes(counts[a:b])))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SUMMARY_TYPES)], _SUMMARY_NAMES)


def _edge(part: int, parts: int) -> int:
    """The first name of a hash partition."""
    return -(-(part << BITS) // parts)


class Summary:
    """Misra-Gries counters of one hash partition. Names and counts travel as one number
    each while they are sorted; a count stops at what its bits hold, far over any
    ``least``."""

    most = (1 << int(COUNT_BITS)) - 1

    def __init__(self, counters: int):
        self.counters, self.taken = counters, 0
        self.names, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting, self.have = [], 0

    def add(self, names: np.ndarray, counts: np.ndarray):
        self.waiting.append((names << COUNT_BITS) | np.minimum(counts, self.most).astype(np.uint64))
        self.have += len(names)
        if self.have >= max(self.counters, 1_000_000):
            self.fold()

    def fold(self):
        self.waiting.append((self.names << COUNT_BITS) | np.minimum(self.counts, self.most).astype(np.uint64))
        packed = np.concatenate(self.waiting)
        self.waiting, self.have = [], 0
        packed.sort()
        names = packed >> COUNT_BITS
        at = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.zeros(0, np.int64)
        counts = np.add.reduceat((packed & np.uint64(self.most)).astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
        names = names[at]
        beyond = len(names) - self.counters
        if beyond > 0:
            off = int(np.partition(counts, beyond - 1)[beyond - 1])
            self.taken += off
            left = counts > off
            names, counts = names[left], counts[left] - off
        self.names, self.counts = names, counts


def _merge(least: int):
    """Task function: the summaries of a hash partition, masses first -> its survivors."""

    def run(batches):
        part, mass, summary = None, 0, None
        for batch in batches:
            for p, kind, m, n, names, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    if summary:
                        yield _survivors(part, summary, least)
                    part, mass, summary = p, 0, None
                if kind == 0:
                    mass += m
                    continue
                summary = summary or Summary(mass // least + 1)
                summary.add(np.cumsum(_from_planes(names, n, np.uint64)), _from_planes(counts, n, np.uint32))
        if summary:
            yield _survivors(part, summary, least)

    return run


def _survivors(part: int, summary: Summary, least: int) -> pa.RecordBatch:
    summary.fold()
    if summary.taken >= least:
        raise AssertionError("more taken off than mass / counters")
    names = summary.names[summary.counts + summary.taken >= least]
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([len(names)], pa.int64()),
         pa.array([_planes(np.diff(names, prepend=np.uint64(0)))], pa.binary())], ["part", "n", "names"])


# ---- second pass --------------------------------------------------------------------

def _bit(names: np.ndarray, low: int, high: int, bits: int) -> np.ndarray:
    """The bit of each name between ``low`` and ``high``."""
    shift = max((high - low - 1).bit_length() - (bits.bit_length() - 1), 0)
    return (names - np.uint64(low)) >> np.uint64(shift)


def _bitmap(survivors: DataFrame, low: int, high: int, bits: int) -> bytes:
    """``bits`` bits, set for the survivors among the names from ``low`` to ``high``. Each
    hash partition sends its stretch of it."""

    def run(batches):
        for batch in batches:
            for n, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                names = np.cumsum(_from_planes(blob, n, np.uint64)) if n else np.zeros(0, np.uint64)
                names = names[(names >= np.uint64(low)) & (names < np.uint64(high))]
                if len(names):
                    at = _bit(names, low, high, bits)
                    first = int(at[0]) // 8
                    own = np.zeros(int(at[-1]) // 8 + 1 - first, np.uint8)
                    np.bitwise_or.at(own, (at // np.uint64(8)).astype(np.int64) - first,
                                     np.uint8(1) << (at % np.uint64(8)).astype(np.uint8))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([first], pa.int64()), pa.array([own.tobytes()], pa.binary())], ["first", "own"])

    out = np.zeros(bits // 8, np.uint8)
    for first, own in survivors.mapInArrow(run, "first long, own binary").collect():  # bits / 8 bytes in all
        own = np.frombuffer(bytes(own), np.uint8)
        out[first: first + len(own)] |= own
    return out.tobytes()


COUNT_SCHEMA = "lang string, words int, phrase string, f long"


def _counts(shared, low: int, high: int, bits: int, longest: int, totals: bool):
    """Task function: (lang, text) -> counts of the phrases whose bit is set, and of all
    words (as the empty phrase of no words)."""

    def run(batches):
        bitmap = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for piece in slices(batch, 1, SLICE):
                p = phrases_of(piece)
                if totals:
                    n = np.bincount(p.lang, minlength=len(p.langs))
                    yield _count_rows(p.langs, 0, pa.array([""] * len(n), pa.large_string()), n)
                names, checks = Fingerprints(p.hashes, 13), Fingerprints(p.hashes, 14)
                for k in range(1, longest + 1):
                    at = p.places(k)
                    full = names.of(at, at + k)
                    short = full >> COUNT_BITS
                    own = (short >= np.uint64(low)) & (short < np.uint64(high))
                    bit = _bit(short[own], low, high, bits)
                    kept = np.flatnonzero(own)[(bitmap[(bit >> np.uint64(3)).astype(np.int64)]
                                                >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                    if not len(kept):
                        continue
                    at, full = at[kept], full[kept]
                    first, n = _grouped(full, checks.of(at, at + k))
                    first = at[first]
                    phrase = pc.binary_join_element_wise(*(p.words.take(pa.array(first + j)) for j in range(k)), _ONE) \
                        if k > 1 else p.words.take(pa.array(first))
                    yield _count_rows(pa.array(p.langs, pa.string()).take(pa.array(p.lang[first])), k, phrase, n)

    return run


def _grouped(full: np.ndarray, check: np.ndarray):
    """(a position, count) of each distinct pair of a name and a check."""
    number = pa.array(full).dictionary_encode().indices.to_numpy()
    first = np.empty(int(number.max()) + 1, np.int64)
    first[number[::-1]] = np.arange(len(number))[::-1]
    if not np.array_equal(check[first][number], check):  # two phrases of one name
        order = np.lexsort((check, full))
        new = np.ones(len(order), bool)
        new[1:] = (full[order][1:] != full[order][:-1]) | (check[order][1:] != check[order][:-1])
        at = np.flatnonzero(new)
        return order[at], np.diff(at, append=len(order))
    return first, np.bincount(number)


def _count_rows(lang, k: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [lang if isinstance(lang, pa.Array) else pa.array(lang, pa.string()),
         pa.array(np.full(len(n), k, np.int32)), phrase.cast(pa.string()), pa.array(n.astype(np.int64))],
        ["lang", "words", "phrase", "f"])


def survivors(docs: DataFrame, parts: int, least: int, longest: int) -> DataFrame:
    """What the summaries of (lang, text) leave: (part, n, names)."""
    dealt = docs.mapInArrow(_summaries(parts, longest), SUMMARY_SCHEMA).repartitionById(parts, F.col("part"))
    return dealt.sortWithinPartitions("part", "kind").mapInArrow(_merge(least), "part int, n long, names binary")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_col: str = "text",
                     lang_col: str = "lang", part_bytes: int = PART_BYTES, served: int = SERVED,
                     bitmap: int = BITMAP) -> DataFrame:
    """(lang, words, phrase, f): every phrase of up to ``longest`` words with ``least``
    occurrences in its language, and of each language the empty phrase of no words with
    the count of all words."""
    spark = docs.sparkSession
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    size, _ = total_bytes(texts, "text")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))
    found = materialise(survivors(texts, parts, least, longest), "phrase-survivors")
    total = found.agg(F.sum("n")).first()[0] or 0
    rounds = max(1, -(-total // served))
    counted = None
    for r in range(rounds):
        low, high = _edge(r, rounds), _edge(r + 1, rounds)
        bits = min(bitmap, max(1 << 10, 1 << (16 * min(total, served)).bit_length()))
        shared = spark.sparkContext.broadcast(_bitmap(found, low, high, bits))
        own = texts.mapInArrow(_counts(shared, low, high, bits, longest, r == 0), COUNT_SCHEMA)
        counted = own if counted is None else counted.unionByName(own)
    return materialise(counted.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
                       .where((F.col("f") >= least) | (F.col("words") == 0)), "phrases")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, absorb: int = ABSORB,
                 text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: ``lang``, ``rank``,
    ``phrase``, ``a`` (occurrences), ``l``, ``r`` (those of the two parts of the cut that
    scores lowest), ``n`` (all words of the language), ``score`` (1000 a n / (l r)).
    Phrases inside a longer one with ``absorb`` hundredths of their occurrences go."""
    f = frequent_phrases(docs, least, longest, text_col, lang_col, **options)
    phrases = f.where(F.col("words") > 0).select("lang", "phrase", "f")
    many = f.where(F.col("words") > 1).select("lang", "words", "phrase", F.col("f").alias("a"))

    longer = many.where(F.col("words") > 2).select("lang", "a", F.explode(F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1),"
        " s -> array_join(slice(split(phrase, ' '), s, m), ' '))))")).alias("phrase"))
    around = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    left = many.join(around, ["lang", "phrase"], "left").where(
        F.coalesce(F.col("around") * 100 < F.col("a") * absorb, F.lit(True))).drop("around")

    cut = left.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "cut", F.expr("array_join(slice(split(phrase, ' '), 1, cut), ' ')").alias("head"),
        F.expr("array_join(slice(split(phrase, ' '), cut + 1, words), ' ')").alias("tail"))
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    n = f.where(F.col("words") == 0).select("lang", F.col("f").alias("n"))
    exact = [F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")]
    scored = (cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(n, "lang")
              .withColumn("over", (exact[0] * exact[1]).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)"))
              .withColumn("under", exact[2] * exact[3])
              .withColumn("score", F.expr("`over` div `under`")))
    lowest = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("x")).select("lang", "phrase", "x.*")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return lowest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
