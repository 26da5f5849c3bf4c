"""Operator 9: removal of repeated byte strings by a difference-cover sample and
suffix buckets.

Every byte covered by a ``length``-byte string that also starts anywhere else is
removed, all occurrences alike. A suffix matters up to ``length`` bytes, and
only whether another suffix agrees with it so far, so suffixes are ordered by
64-bit fingerprints of their bytes instead of by the bytes.

1. Cover sample. Positions p (in their document) with p modulo ``PERIOD`` in
   ``COVER`` form the sample: for any two positions i and j there is a shift
   d < PERIOD that takes both into it. Each sample position is ranked by its
   next length - PERIOD + 1 bytes; one exchange tells which ranks are shared.
2. Candidates. Two equal strings agree at a common sample position, so a
   suffix none of whose next PERIOD positions is a sample with a shared rank is
   unique. Such suffixes, most of a clean corpus, go no further.
3. Long ties. Inside long repeats most suffixes need not be sorted one by one:
   between neighbouring marks (positions picked by their next four bytes, so
   equal texts have equal marks) one key stands for the whole stretch, and a
   second exchange settles all suffixes of a stretch that occurs elsewhere.
4. Suffixes that are still open, at the ends of repeats, call for their possible
   partners through the ranks of the sample positions they hold; a third
   exchange passes the calls on to all suffixes with the same ranks.
5. Buckets. The suffixes called are dealt into buckets by their fingerprint; a
   task sorts one bucket at a time, and neighbours that agree in the 64-bit key
   and in a 32-bit check (of their first half) are repeats.
6. The bytes that repeats cover are cut out.

Texts are written once in blocks (``blocks.py``); only keys and bits move
afterwards. A bucket holds a key once for each block, however often the block
repeats it, so a passage in a third of all documents does not fill a task.

Cases: a null text counts as empty; texts shorter than ``length`` lose nothing;
rows that repeat an id are documents of their own (their equal texts remove each
other); a null id is carried through; an empty table gives no rows. Kept bytes
may end inside a character; ``remove_repeats`` returns them as binary.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.blocks import (BLOCK_BYTES, FAN, KEY_SCHEMA, PART_KEYS, BlockTable, Ranges, answer_bits, called,
                                   distinct, exchange, key_rows, repeated, repeated_checked, rows_of)
from fieldwatch.llm.textarrays import Fingerprints, bytes_of

LENGTH = 200
# fixed values: a perfect difference set modulo 133 (each other residue is one difference)
PERIOD = 133
COVER = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)


def runs(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [from, to) covered by strings of ``length`` at sorted starts."""
    if not len(starts):
        return starts, starts
    new = np.concatenate([[True], np.diff(starts) > length])
    first = starts[new]
    last = starts[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])] + length
    return first, last


class _Sample(NamedTuple):
    """Sample positions of a block and the ranks they have."""

    at: np.ndarray
    keys: np.ndarray  # sorted and unique
    many: np.ndarray  # per key: several positions in this block
    index: np.ndarray  # per position: its key


class _Plan(NamedTuple):
    """Key ranges of the exchanges."""

    length: int
    samples: Ranges
    stretches: Ranges
    calls: Ranges
    strings: Ranges


class _Block:
    """A block's bytes, and what the exchanges have told about them so far."""

    def __init__(self, block: bytes, plan: _Plan):
        self.rows = rows_of(block)
        self.data, self.offsets = bytes_of(pc.fill_null(self.rows.column("text"), ""))
        self.plan = plan
        self.prints = Fingerprints(self.data, 1)
        # per byte: does a string of the full length that starts here end in its document?
        ends = np.repeat(self.offsets[1:], np.diff(self.offsets))
        self.fits = ends - np.arange(len(self.data)) >= plan.length

    def _filled(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Per byte: does a range [begin, end) hold it? Both sorted; few ranges remain
        once those that touch are joined."""
        out = np.zeros(len(self.data), bool)
        if len(begin):
            new = np.ones(len(begin), bool)
            new[1:] = begin[1:] > end[:-1]
            last = np.append(np.flatnonzero(new)[1:] - 1, len(begin) - 1)
            for x, y in zip(begin[new].tolist(), end[last].tolist()):
                out[x:y] = True
        return out

    def check(self, begin: np.ndarray) -> np.ndarray:
        """32 bits of the fingerprint of the first half of the strings at ``begin``:
        strings that differ and yet agree in the whole fingerprint differ in their
        halves'."""
        return self.prints.of(begin, begin + self.plan.length // 2).astype(np.uint32)

    def sample(self) -> _Sample:
        width = self.plan.length - PERIOD + 1
        sizes = np.maximum(np.diff(self.offsets) - width + 1, 0)  # starts with ``width`` bytes to go
        periods = -(-sizes // PERIOD)
        first = np.repeat(self.offsets[:-1], periods)
        nth = np.arange(len(first)) - np.repeat(np.cumsum(periods) - periods, periods)
        at = ((first + nth * PERIOD)[:, None] + np.array(COVER)[None, :]).ravel()
        at = at[at < np.repeat(first + np.repeat(sizes, periods), len(COVER))]
        keys, _, index, counts = distinct(self.prints.of(at, at + width))
        return _Sample(at, keys, counts > 1, index)

    def shared_sample(self, answers) -> _Sample:
        """The sample positions with shared ranks."""
        s = self.sample()
        shared = answer_bits(s.keys, self.plan.samples, answers)
        own = shared[s.index] if len(s.index) else np.zeros(0, bool)
        number = np.cumsum(shared) - 1
        return _Sample(s.at[own], s.keys[shared], s.many[shared], number[s.index[own]])

    def before(self, at: np.ndarray) -> np.ndarray:
        """Per byte: may a string that starts here be told by one of the sorted sample
        positions ``at`` in its first PERIOD bytes?"""
        return self._filled(np.maximum(at - PERIOD + 1, 0), at + 1) & self.fits

    def stretches(self, candidate: np.ndarray):
        """(first, last) neighbouring marks with candidates alone from one to the other."""
        at = np.flatnonzero(candidate)  # a candidate has ``length`` bytes to go
        four = self.data[at].astype(np.uint32)
        for k in (1, 2, 3):
            four = four << np.uint32(8) | self.data[at + k]
        marks = np.flatnonzero(four * np.uint32(0x9E3779B1) >> np.uint32(27) == 0)
        place = at[marks]
        # candidates end before their document does, so a stretch lies in one document
        joined = np.diff(place) == np.diff(marks)
        return place[:-1][joined], place[1:][joined]

    def stretch_keys(self, candidate: np.ndarray):
        """(sorted unique keys, check, many flags, index, first, last) of the stretches"""
        first, last = self.stretches(candidate)
        end = last + self.plan.length
        keys, some, index, counts = distinct(self.prints.of(first, end))
        return keys, self.check(first[some]), counts > 1, index, first, last

    def settled(self, candidate: np.ndarray, answers) -> np.ndarray:
        """Per byte: does a string start here that a shared stretch proves repeated?"""
        keys, _, _, index, first, last = self.stretch_keys(candidate)
        hit = answer_bits(keys, self.plan.stretches, answers)[index] if len(index) else np.zeros(0, bool)
        return self._filled(first[hit], last[hit] + 1)

    def calls(self, sample: _Sample, open_: np.ndarray) -> np.ndarray:
        """Per key of the shared sample: does an open string hold one of its positions
        in its first PERIOD bytes?"""
        starts = np.concatenate([[0], np.cumsum(open_)])
        near = starts[sample.at + 1] > starts[np.maximum(sample.at - PERIOD + 1, 0)]
        out = np.zeros(len(sample.keys), bool)
        out[sample.index[near]] = True
        return out

    def strings(self, at: np.ndarray):
        """(sorted unique keys, check, many flags, index) of the strings at ``at``"""
        end = at + self.plan.length
        keys, some, index, counts = distinct(self.prints.of(at, end))
        return keys, self.check(at[some]), counts > 1, index

    def called_strings(self, sample: _Sample, answers) -> np.ndarray:
        wanted = answer_bits(sample.keys, self.plan.calls, answers)
        return np.flatnonzero(self.before(sample.at[wanted[sample.index]] if len(sample.at) else sample.at))


def _step(plan: _Plan, answers: int, work):
    """Task function: ``work(number, block, answers so far)`` for every block."""

    def run(batches):
        names = ["block", "rows", *[f"a{k}" for k in range(answers)]]
        for batch in batches:
            for k in range(batch.num_rows):
                number, block, *told = (batch.column(n)[k].as_py() for n in names)
                yield work(number, _Block(block, plan), told)

    return run


def _send_samples(number, b: _Block, told):
    s = b.sample()
    return key_rows(number, s.keys, b.plan.samples, (s.many.astype(np.uint8),))


def _send_stretches(number, b: _Block, told):
    keys, check, many, *_ = b.stretch_keys(b.before(b.shared_sample(told[0]).at))
    return key_rows(number, keys, b.plan.stretches, (check, many.astype(np.uint8)))


def _send_calls(number, b: _Block, told):
    sample = b.shared_sample(told[0])
    candidate = b.before(sample.at)
    wanted = b.calls(sample, candidate & ~b.settled(candidate, told[1]))
    return key_rows(number, sample.keys, b.plan.calls, (wanted.astype(np.uint8),))


def _send_strings(number, b: _Block, told):
    keys, check, many, _ = b.strings(b.called_strings(b.shared_sample(told[0]), told[2]))
    return key_rows(number, keys, b.plan.strings, (check, many.astype(np.uint8)))


def _cut(number, b: _Block, told):
    sample = b.shared_sample(told[0])
    repeats = b.settled(b.before(sample.at), told[1])
    at = b.called_strings(sample, told[2])
    keys, _, _, index = b.strings(at)
    if len(at):
        repeats[at[answer_bits(keys, b.plan.strings, told[3])[index]]] = True
    return _kept(b, np.flatnonzero(repeats))


def _kept(b: _Block, hit: np.ndarray) -> pa.RecordBatch:
    """The block's documents with what is left of their texts."""
    buffer = b.data.tobytes()
    doc = np.searchsorted(b.offsets, hit, side="right") - 1
    ids, at = np.unique(doc, return_index=True)
    own = dict(zip(ids.tolist(), np.split(hit, at[1:]))) if len(hit) else {}
    kept, removed, spans = [], [], []
    for d, (begin, end) in enumerate(zip(b.offsets[:-1].tolist(), b.offsets[1:].tolist())):
        if d not in own:
            kept.append(buffer[begin:end])
            removed.append(0)
            spans.append(0)
            continue
        first, last = runs(own[d], b.plan.length)
        pieces, at_byte = [], begin
        for x, y in zip(first.tolist(), last.tolist()):
            pieces.append(buffer[at_byte:x])
            at_byte = y
        kept.append(b"".join([*pieces, buffer[at_byte:end]]))
        removed.append(int((last - first).sum()))
        spans.append(len(first))
    return pa.RecordBatch.from_arrays(
        [b.rows.column("id"), pa.array(np.diff(b.offsets), pa.int64()), pa.array(removed, pa.int64()),
         pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   block_bytes: int = BLOCK_BYTES, part_keys: int = PART_KEYS, fan: int = FAN) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs) and ``kept``, the remaining bytes. ``part_keys`` keys make a
    range; a block sends to at most ``fan``, or in two levels."""
    if length < PERIOD:
        raise ValueError(f"length must be at least {PERIOD}")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    blocks = BlockTable(source, "text", block_bytes, part_keys, fan)
    plan = _Plan(length, blocks.ranges(blocks.bytes * len(COVER) // PERIOD), blocks.ranges(blocks.bytes // 32),
                 blocks.ranges(blocks.bytes // 16), blocks.ranges(blocks.bytes // 3))

    def told(work, to, judge, kinds, *answers):
        keys = blocks.with_answers(*answers).mapInArrow(_step(plan, len(answers), work), KEY_SCHEMA)
        return exchange(keys, to, judge, kinds)

    flag, checked = (np.uint8,), (np.uint32, np.uint8)
    shared = told(_send_samples, plan.samples, repeated, flag)
    long_ties = told(_send_stretches, plan.stretches, repeated_checked, checked, shared)
    calls = told(_send_calls, plan.calls, called, flag, shared, long_ties)
    repeats = told(_send_strings, plan.strings, repeated_checked, checked, shared, long_ties, calls)
    id_type = source.schema["id"].dataType.simpleString()
    out = blocks.with_answers(shared, long_ties, calls, repeats).mapInArrow(
        _step(plan, 4, _cut), f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("id", id_col)


def repeat_digests(docs: DataFrame, **params) -> DataFrame:
    """``remove_repeats`` with the SHA-256 of the kept bytes in their place."""
    out = remove_repeats(docs, **params)
    return out.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
