"""Blocks of documents, and exchanges of 64-bit keys between them.

Operators that compare every stretch of every text with all others cannot give
each stretch a row of its own. Here documents travel in blocks (one row holds a
few megabytes of whole documents), and a block sends its stretches as sorted,
unique 64-bit keys, packed into one binary for each key range. One task per range
compares what all blocks sent and answers each of them with one bit a key.

A range holds about ``PART_KEYS`` keys, so ranges grow with the corpus, and so do
blocks. Where a block would have more than ``FAN`` ranges to send to, the exchange
takes two levels: a block sends to about the square root of their number, and the
rows of a group of blocks for one such range meet in a *cell*, about as many keys as
a block has. The cell judges them among themselves, merges them into one sorted run
and sends that on to the ranges proper; their answers return the same way. Rows then
grow with the corpus to the power 1.5, still hold hundreds of keys each at 100 TB,
and a key that every block holds is merged on the way.

``BlockTable`` writes the blocks once to the shared folder, bucketed by block
number: each later pass joins the (much smaller) answers to it without moving
the texts again, and sees the same blocks even when executors are lost.
"""

from __future__ import annotations

import math
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import materialise, scratch, total_bytes
from fieldwatch.llm.textarrays import slices

BLOCK_BYTES = 2_000_000
BUCKET_BYTES = 32_000_000
PART_KEYS = 4_000_000
FAN = 1000


class Ranges(NamedTuple):
    """Key ranges: blocks send to ``first`` of them; with two levels each has
    ``second`` parts, and blocks meet in ``groups`` groups on the way."""

    first: int
    second: int = 1
    groups: int = 1


def to_bytes(batches: list[pa.RecordBatch]) -> bytes:
    """Batches of one schema as compressed bytes; ``rows_of`` reads them."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for b in batches:
            out.write_batch(b)
    return sink.getvalue().to_pybytes()


def rows_of(block: bytes) -> pa.RecordBatch:
    """What ``to_bytes`` wrote, as one batch."""
    table = pa.ipc.open_stream(block).read_all().combine_chunks()
    return table.to_batches()[0]


def _bundle(text_at: int, size: int):
    def run(batches):
        task, count, held, have = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for part in slices(batch, text_at, max(size // 4, 1)):
                n = pc.sum(pc.binary_length(part.column(text_at))).as_py() or 0
                if held and have + n > size:
                    yield _block_row(task, count, held)
                    count, held, have = count + 1, [], 0
                held.append(part)
                have += n
        if held:
            yield _block_row(task, count, held)

    return run


def _block_row(task: int, count: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([(task << 32) + count], pa.int64()),
                                       pa.array([to_bytes(held)], pa.binary())],
                                      ["block", "rows"])


class BlockTable:
    """The written blocks, and the sizes of what they hold."""

    def __init__(self, docs: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES,
                 part_keys: int = PART_KEYS, fan: int = FAN):
        spark = docs.sparkSession
        self.block_bytes, self.part_keys, self.fan = block_bytes, part_keys, fan
        self.bytes, self.n_rows = total_bytes(docs, text_col)
        self.buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-self.bytes // BUCKET_BYTES))
        name = f"blocks_{uuid.uuid4().hex}"
        bundles = docs.mapInArrow(_bundle(docs.columns.index(text_col), block_bytes), "block long, rows binary")
        (bundles.write.format("parquet").bucketBy(self.buckets, "block")
         .option("path", scratch(spark, name)).saveAsTable(name))
        self.table = spark.table(name)
        # the plan holds the files and their buckets; the name was only needed to get there
        spark.sql(f"DROP TABLE {name}")

    def ranges(self, keys: int) -> Ranges:
        """Key ranges for about so many keys."""
        return ranges(keys, -(-self.bytes // self.block_bytes), self.part_keys, self.fan)

    def with_answers(self, *answers: DataFrame) -> DataFrame:
        """The blocks with columns ``a0``, ``a1``, ...: what was answered to them
        (null where a block sent nothing)."""
        out = self.table
        for k, a in enumerate(answers):
            # dealt like the buckets, so the blocks stay where they are
            dealt = a.select("block", F.col("answers").alias(f"a{k}")).repartition(self.buckets, "block")
            out = out.join(dealt, "block", "left")
        return out


def ranges(keys: int, blocks: int, part_keys: int = PART_KEYS, fan: int = FAN) -> Ranges:
    """Ranges of ``part_keys`` keys, in two levels where a block would meet more than ``fan``."""
    parts = max(1, -(-keys // part_keys))
    if parts <= fan:
        return Ranges(parts)
    first = math.isqrt(parts - 1) + 1
    return Ranges(first, -(-parts // first), max(1, -(-blocks // first)))


def distinct(values: np.ndarray):
    """(sorted distinct values, a position of each, each value's number among them,
    how often each occurs)"""
    order = np.argsort(values)
    ranked = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.flatnonzero(new)
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(new) - 1
    return ranked[at], order[at], number, np.diff(at, append=len(values))


# ---- keys --------------------------------------------------------------------------

KEY_SCHEMA = "part int, block long, n int, keys binary, extra binary"
_NAMES = ["part", "block", "n", "keys", "extra"]
_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]


def bounds(keys: np.ndarray, begin: int, end: int, total: int) -> np.ndarray:
    """Positions at which sorted ``keys`` of the ranges ``begin`` to ``end``, of
    ``total`` in all, pass from one to the next."""
    edges = np.array([(k << 64) // total for k in range(begin + 1, end)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, compressed."""
    width = values.dtype.itemsize
    flat = np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()
    return pa.compress(flat, codec="zstd", asbytes=True)


def _from_planes(blob: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = pa.decompress(blob, decompressed_size=n * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(width, n).T).view(kind).ravel()


def key_rows(block: int, keys: np.ndarray, to: Ranges, extras: tuple = ()) -> pa.RecordBatch:
    """Rows that send sorted unique ``keys``, one for each range that has some.
    ``extras``: arrays of the same length that go along."""
    return _rows(block, keys, 0, to.first, to.first, extras)


def _rows(sender: int, keys: np.ndarray, begin: int, end: int, total: int, extras: tuple) -> pa.RecordBatch:
    at = bounds(keys, begin, end, total)
    out = []
    for p, (a, b) in enumerate(zip(at[:-1], at[1:]), begin):
        if b > a:
            part = keys[a:b]
            blob = b"".join(len(x).to_bytes(4, "little") + x for x in (_planes(e[a:b]) for e in extras))
            out.append((p, sender, int(b - a), _planes(np.diff(part, prepend=np.uint64(0))), blob))
    columns = list(zip(*out)) if out else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)


def _unpacked(rows: list[tuple], kinds: tuple):
    """(keys, extras, offsets of the rows) of rows (n, keys, extra), one after another."""
    keys = np.concatenate([np.cumsum(_from_planes(k, n, np.uint64)) for n, k, _ in rows])
    extras = []
    for k, kind in enumerate(kinds):
        parts = []
        for n, _, extra in rows:
            at = 0
            for _ in range(k):
                at += 4 + int.from_bytes(extra[at: at + 4], "little")
            size = int.from_bytes(extra[at: at + 4], "little")
            parts.append(_from_planes(extra[at + 4: at + 4 + size], n, kind))
        extras.append(np.concatenate(parts))
    return keys, tuple(extras), np.cumsum([0] + [n for n, _, _ in rows])


_ANSWERS = "block long, part int, bits binary"


def _answer_rows(blocks: list[int], part: int, bits: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int64()), pa.array([part] * len(blocks), pa.int32()),
         pa.array([np.packbits(bits[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
        ["block", "part", "bits"])


def _answered(kinds: tuple, judge):
    """Task function: all rows of one key range -> one answer for each row."""

    def run(batches):
        rows = [r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns])]
        for part in sorted({r[0] for r in rows}):
            own = sorted((r for r in rows if r[0] == part), key=lambda r: r[1])
            keys, extras, at = _unpacked([r[2:] for r in own], kinds)
            yield _answer_rows([r[1] for r in own], part, judge(keys, *extras), at)

    return run


def _gathered(bits: DataFrame) -> DataFrame:
    return materialise(bits.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("part", "bits"))).alias("answers")), "key-answers")


def _asked(keys: DataFrame, parts: int, judge, kinds: tuple) -> DataFrame:
    return _gathered(keys.repartitionById(parts, F.col("part")).mapInArrow(_answered(kinds, judge), _ANSWERS))


def exchange(keys: DataFrame, to: Ranges, judge, kinds: tuple = ()) -> DataFrame:
    """(block, answers) for the rows of ``key_rows``; ``answers`` holds one entry a
    range, in order. ``judge(keys, *extras)`` gets all keys of a range, each
    block's after another's, and returns a bit for each. With two levels the last of
    the extras must be a flag (8 bits) that the judge answers with true, or a value
    that it compares with the smallest; keys are equal if those before it are too."""
    if to.second == 1:
        return _asked(keys, to.first, judge, kinds)
    cell = F.col("part").cast("long") * to.groups + F.pmod(F.xxhash64("block"), F.lit(to.groups))
    cells = materialise(keys.groupBy(cell.alias("cell"), "part").agg(
        F.collect_list(F.struct("block", "n", "keys", "extra")).alias("rows")), "key-cells")
    answers = _asked(cells.mapInArrow(_sent_on(to, kinds, judge), KEY_SCHEMA), to.first * to.second, judge, kinds)
    told = cells.join(answers.withColumnRenamed("block", "cell"), "cell", "left").select(*cells.columns, "answers")
    return _gathered(told.mapInArrow(_passed_back(to, kinds, judge), _ANSWERS))


class _Cell:
    """The rows of a group of blocks for one range of the first level."""

    def __init__(self, rows: list[dict], kinds: tuple, judge):
        self.blocks = [r["block"] for r in rows]
        keys, extras, self.at = _unpacked([(r["n"], r["keys"], r["extra"]) for r in rows], kinds)
        self.bits = judge(keys, *extras)  # among themselves
        *same, last = extras
        order = np.lexsort((*same[::-1], keys))
        new = np.ones(len(keys), bool)
        new[1:] = False
        for values in (keys, *same):
            new[1:] |= values[order][1:] != values[order][:-1]
        first = np.flatnonzero(new)
        self.index = np.empty(len(keys), np.int64)
        self.index[order] = np.cumsum(new) - 1
        if last.dtype == np.uint8:
            folded = np.maximum.reduceat(self.bits.astype(np.uint8)[order], first)
        else:
            folded = np.minimum.reduceat(last[order], first)
        self.keys = keys[order][first]
        self.extras = (*(e[order][first] for e in same), folded)


def _cells(batches, kinds: tuple, judge):
    for batch in batches:
        for k in range(batch.num_rows):
            own = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
            yield own, _Cell(own["rows"], kinds, judge)


def _sent_on(to: Ranges, kinds: tuple, judge):
    def run(batches):
        for own, c in _cells(batches, kinds, judge):
            begin = own["part"] * to.second
            yield _rows(own["cell"], c.keys, begin, begin + to.second, to.first * to.second, c.extras)

    return run


def _passed_back(to: Ranges, kinds: tuple, judge):
    def run(batches):
        for own, c in _cells(batches, kinds, judge):
            begin = own["part"] * to.second
            elsewhere = _bits(c.keys, begin, begin + to.second, to.first * to.second, own["answers"])
            yield _answer_rows(c.blocks, own["part"], c.bits | elsewhere[c.index], c.at)

    return run


def answer_bits(keys: np.ndarray, to: Ranges, answers) -> np.ndarray:
    """The answers of ``exchange`` to sorted unique ``keys``, as booleans."""
    if answers is None:
        return np.zeros(len(keys), bool)
    return _bits(keys, 0, to.first, to.first, answers)


def _bits(keys: np.ndarray, begin: int, end: int, total: int, answers) -> np.ndarray:
    at = bounds(keys, begin, end, total)
    sizes = [int(b - a) for a, b in zip(at[:-1], at[1:])]
    got = {a["part"]: a["bits"] for a in answers}
    out = [np.unpackbits(np.frombuffer(got[p], np.uint8), count=n) for p, n in enumerate(sizes, begin) if n]
    return np.concatenate(out).astype(bool) if out else np.zeros(0, bool)


# ---- judges ------------------------------------------------------------------------

def repeated(keys: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Keys that several blocks sent, or that one marked as many."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys), bool)
    equal = ranked[1:] == ranked[:-1]
    same[1:] |= equal
    same[:-1] |= equal
    out = many.astype(bool)
    out[order] |= same
    return out


def repeated_checked(keys: np.ndarray, check: np.ndarray, many: np.ndarray) -> np.ndarray:
    """As ``repeated``, where ``check`` must be equal too."""
    order = np.lexsort((check, keys))
    equal = (keys[order][1:] == keys[order][:-1]) & (check[order][1:] == check[order][:-1])
    same = np.zeros(len(keys), bool)
    same[1:] |= equal
    same[:-1] |= equal
    out = many.astype(bool)
    out[order] |= same
    return out


def called(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Keys that any block wants."""
    values, index = np.unique(keys, return_inverse=True)
    out = np.zeros(len(values), bool)
    out[index[wanted.astype(bool)]] = True
    return out[index]


def has_smaller(keys: np.ndarray, check: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Is there an equal key (and check) with a smaller value?"""
    if not len(keys):
        return np.zeros(0, bool)
    order = np.lexsort((value, check, keys))
    k, c, v = keys[order], check[order], value[order]
    first = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])])
    lowest = v[np.flatnonzero(first)][np.cumsum(first) - 1]
    out = np.zeros(len(keys), bool)
    out[order] = v > lowest
    return out
