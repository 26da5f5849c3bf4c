"""Operator 3: hierarchical multi-length packing into training sequences.

Context sizes are ``TIERS`` (2048, 1024, 512, 256 tokens). A document longer than
the largest window is cut into whole windows first; what remains, and every
shorter document, is routed to the smallest tier that holds it. The tiers are
packed from the longest to the shortest. A window starts with the longest piece
of its tier, and its gap is filled from the shorter tiers, always with the
longest piece that still fits. When no piece fits, the next one is cut so that
the window is exactly full. So every window is a whole power of two; only what
is left when the pieces run out can fall short of the smallest tier.

Packing runs where the documents are read, block by block (``BLOCK`` tokens), and
each block's remainder (under 256 tokens) joins the next block. The remainders
of ``FAN_IN`` tasks meet in a second round of the same packing, whose own last
remainder is the only sequence that is padded: one for ``FAN_IN`` tasks.

The sequences of a block are dealt into step groups of about ``STEP`` tokens:
longest first, each to the group with the fewest tokens so far, so the groups of
a block differ by less than a window.

Ids come from tiktoken over the tokenizer file's own vocabulary and merge order;
the tokenizers library itself encodes texts on which the two may differ (see
``tokenizer.py``), and all texts if the file is of another kind.

Cases: a null text counts as empty, and an empty document is its closing id
alone; a null or repeated id is carried through, each row being a document of
its own; a very long text is cut freely; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import materialise
from fieldwatch.llm.tokenizer import Pretokens, load_tokenizer, ranked_encoder, tokenizer_text

TIERS = (2048, 1024, 512, 256)
BLOCK = 2_000_000
STEP = 16 * 2048
FAN_IN = 256
END_ID = 1


class Pool:
    """Pieces by length, with the set of lengths at hand as the bits of a number."""

    def __init__(self):
        self.by_length: dict[int, list] = {}
        self.lengths = 0

    def add(self, piece: tuple, length: int) -> None:
        self.by_length.setdefault(length, []).append(piece)
        self.lengths |= 1 << length

    def _take(self, length: int) -> tuple[tuple, int]:
        pieces = self.by_length[length]
        piece = pieces.pop()
        if not pieces:
            self.lengths ^= 1 << length
        return piece, length

    def longest(self, at_most: int):
        fits = self.lengths & ((2 << at_most) - 1)
        return self._take(fits.bit_length() - 1) if fits else None

    def shortest(self):
        return self._take((self.lengths & -self.lengths).bit_length() - 1) if self.lengths else None


def pack(pieces: list[tuple], tiers=TIERS) -> tuple[list[list[tuple]], list[tuple]]:
    """(sequences, remainder) for pieces (document, start, length). A sequence is a
    list of pieces that fill a power of two; the remainder has fewer tokens than
    the smallest tier."""
    window, out, pool = tiers[0], [], Pool()
    for doc, start, length in pieces:
        while length >= window:
            out.append([(doc, start, window)])
            start, length = start + window, length - window
        if length:
            pool.add((doc, start), length)
    for k, size in enumerate(tiers):
        floor = tiers[k + 1] if k + 1 < len(tiers) else 0
        while pool.lengths >> (floor + 1) & ((1 << (size - floor)) - 1):  # a piece of this tier is left
            (doc, start), length = pool.longest(size)
            sequence, gap = [(doc, start, length)], size - length
            while gap and pool.lengths:
                found = pool.longest(gap)
                if found:
                    (doc, start), length = found
                else:
                    (doc, start), whole = pool.shortest()
                    length = gap
                    pool.add((doc, start + gap), whole - gap)
                sequence.append((doc, start, length))
                gap -= length
            if not gap:
                out.append(sequence)
            else:  # the pieces ran out: cut what there is into shorter windows
                shorter, rest = _cut(sequence, tiers[k + 1:])
                out += shorter
                return out, rest
    return out, []


def _cut(pieces: list[tuple], tiers) -> tuple[list[list[tuple]], list[tuple]]:
    out = []
    for size in tiers:
        while sum(p[2] for p in pieces) >= size:
            sequence, gap = [], size
            while gap:
                doc, start, length = pieces.pop(0)
                used = min(length, gap)
                sequence.append((doc, start, used))
                if used < length:
                    pieces.insert(0, (doc, start + used, length - used))
                gap -= used
            out.append(sequence)
    return out, pieces


def step_groups(sizes: list[int], step: int = STEP) -> list[int]:
    """The step group of each sequence: longest first to the emptiest group."""
    groups = max(1, round(sum(sizes) / step))
    heap = [(0, g) for g in range(groups)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        tokens, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (tokens + sizes[i], g))
    return out


_COLUMNS = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_group"]
_REST = ["task", "rest"]  # of remainders: the task they come from, and their ids


class _Rows:
    """Output rows of one task; sequence and step ids count up from ``first``."""

    def __init__(self, task: int, first: int, id_type: pa.DataType):
        self.task, self.sequence, self.step = task, first, first
        self.id_type = id_type
        self.rows: list[tuple] = []

    def sequences(self, sequences: list[list[tuple]], docs: list[tuple]) -> None:
        sizes = [sum(p[2] for p in s) for s in sequences]
        steps = step_groups(sizes) if sizes else []
        for sequence, size, step in zip(sequences, sizes, steps):
            window = size if size & (size - 1) == 0 else TIERS[0]
            at = 0
            for doc, start, length in sequence:
                id_, ids, base, total = docs[doc]
                own = ids[4 * (start - base): 4 * (start - base + length)]
                self.rows.append((id_, start, length, zlib.crc32(own), total, self.sequence, at, window,
                                  self.step + step, self.task, None))
                at += length
            self.sequence += 1
        self.step += max(steps, default=-1) + 1

    def rest(self, pieces: list[tuple], docs: list[tuple]) -> None:
        for doc, start, length in pieces:
            id_, ids, base, total = docs[doc]
            self.rows.append((id_, start, length, None, total, None, None, None, None, self.task,
                              ids[4 * (start - base): 4 * (start - base + length)]))

    def batch(self) -> pa.RecordBatch:
        names = _COLUMNS + _REST
        columns = list(zip(*self.rows)) if self.rows else [()] * len(names)
        types = [self.id_type, *[pa.int64()] * (len(names) - 2), pa.binary()]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


_LONG_GAP = re.compile(r"\s{1000}").search  # look-ahead over such gaps is slow in the fast encoder


def encoder(spec: str):
    """text -> ids as little-endian 32-bit bytes."""
    library, fast, split = load_tokenizer(spec), ranked_encoder(spec), Pretokens(spec)

    def encode(text: str) -> bytes:
        if fast is not None and split.usable and not split.odd(text) and not split.special(text) and not _LONG_GAP(text):
            return fast.encode_to_numpy(text).astype("<u4", copy=False).tobytes()
        return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    return encode


def _packed(spec: str, end_id: int, block: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode = encoder(spec)
        task = TaskContext.get().partitionId()
        rows, docs, pieces, held = None, [], [], 0
        for batch in batches:
            rows = rows or _Rows(task, task << 32, batch.column(0).type)
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1)
            for k, id_ in enumerate(ids_of):
                text = texts[k].as_py()
                ids = (encode(text) if text else b"") + end
                docs.append((id_, ids, 0, len(ids) // 4))
                pieces.append((len(docs) - 1, 0, len(ids) // 4))
                held += len(ids) // 4
                if held >= block:
                    sequences, rest = pack(pieces)
                    rows.sequences(sequences, docs)
                    yield rows.batch()
                    # the remainder opens the next block, with the ids it needs
                    docs = [(docs[d][0], docs[d][1][4 * (s - docs[d][2]): 4 * (s - docs[d][2] + n)], s, docs[d][3])
                            for d, s, n in rest]
                    pieces = [(i, s, n) for i, (_, s, n) in enumerate(rest)]
                    held = sum(n for _, _, n in pieces)
        if rows is not None:
            sequences, rest = pack(pieces)
            rows.sequences(sequences, docs)
            rows.rest(rest, docs)
            yield rows.batch()

    return run


def _packed_rest(key: tuple, table: pa.Table) -> pa.Table:
    """Group function: the remainders of a group of tasks, packed once more."""
    table = table.sort_by([("task", "ascending"), ("position", "ascending")])
    docs = [(r["id"], r["rest"], r["start"], r["doc_tokens"]) for r in table.to_pylist()]
    pieces = [(k, start, len(ids) // 4) for k, (_, ids, start, _) in enumerate(docs)]
    group = key[0].as_py()
    rows = _Rows(group, (1 << 62) + (group << 32), table.schema.field("id").type)
    sequences, rest = pack(pieces)
    rows.sequences(sequences + ([rest] if rest else []), docs)
    return pa.Table.from_batches([rows.batch()]).select(_COLUMNS)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """One row per piece: the id, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``, ``window`` (padded length of the
    sequence) and ``step_group``."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, " + ", ".join(f"{c} long" for c in _COLUMNS[1:])
    first = materialise(
        source.mapInArrow(_packed(tokenizer_text(tokenizer_path), end_id, block), f"{schema}, task long, rest binary"),
        "packed")
    rest = first.filter(F.col("rest").isNotNull()).withColumn("position", F.monotonically_increasing_id())
    second = (rest.withColumn("fan", F.floor(F.col("task") / FAN_IN).cast("long")).groupBy("fan")
              .applyInArrow(_packed_rest, schema))  # under FAN_IN x 256 tokens a group
    packed = first.filter(F.col("rest").isNull()).select(_COLUMNS).unionByName(second)
    return packed.withColumnRenamed("id", id_col)
