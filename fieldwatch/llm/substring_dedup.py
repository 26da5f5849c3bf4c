"""Operator 2: removal of repeated word windows by recompression.

Words are ``[^\\x20\\x09-\\x0D]+``. A word covered by a window of ``WINDOW``
consecutive words whose sequence also starts in a document with a smaller id is
removed; windows are judged on the input.

1. Recompression. Each text starts as a row of word symbols and goes through
   ``ROUNDS`` rounds that shorten it. A round first names maximal runs of one
   symbol, then pairs of a left and a right symbol (a bit of the symbol's name
   says which it is). The name of a run or pair is a 64-bit hash of its parts,
   so every task gives equal strings equal names without asking others.
2. With each symbol goes its context: the words that must be seen for it to be
   formed as it was. A window that holds the context of a symbol holds the same
   symbol wherever the window's words occur.
3. Shared symbols. One exchange tells which symbols occur in several documents.
   A window that holds the context of a symbol without a second document is
   unique and goes no further. Windows that hold no whole context pass on.
4. Verification. The remaining windows are compared by a 64-bit fingerprint and
   a 32-bit check (of their first half), with the smallest id
   of each block; a second exchange tells which have a smaller id elsewhere.

Texts are written once in blocks (``blocks.py``); only symbols, windows and
answer bits move. A block sends a symbol or window once, so a passage in a third
of all documents does not fill a task.

Ids are integers, or of any other type that can be ordered; those are replaced by their
rank among all ids (strings by their bytes), which costs a shuffle of the texts.

Cases: a null text has no words; a null id counts as larger than all others (it
takes nothing from another document, and loses to every other id); rows that
repeat an id are documents of their own that do not take words from each other;
an empty table gives no rows. ``remove_windows`` carries all columns, whatever
their names; a text that loses nothing stays as it is, another becomes its
remaining words joined by one space.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldwatch.llm.blocks import (BLOCK_BYTES, FAN, KEY_SCHEMA, PART_KEYS, BlockTable, Ranges, answer_bits, distinct,
                                   exchange, has_smaller, key_rows, repeated, rows_of)
from fieldwatch.llm.common import materialise
from fieldwatch.llm.textarrays import Fingerprints, mix, word_hashes, words_of
from fieldwatch.operators.ranks import count_below

WINDOW = 13
ROUNDS = 2
_PLACE = "place"  # of an id in the order of ids
NO_ID = np.iinfo(np.int64).max  # of rows without an id
_RUN, _PAIR = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


class Symbols:
    """Symbols of a block's texts: name, document, and the context [low, high) of
    each in words. A context that would reach past its text is unusable and set
    to the whole range of positions."""

    def __init__(self, names: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.names, self.doc, self.low, self.high = names, doc, low, high

    def _next_to(self):
        """Context bounds of each symbol's neighbours; past the text: unusable."""
        far = np.iinfo(np.int64).max // 4
        same = self.doc[1:] == self.doc[:-1]
        low_before = np.full(len(self.names), -far)
        high_before = np.full(len(self.names), far)
        low_after, high_after = low_before.copy(), high_before.copy()
        low_before[1:][same], high_before[1:][same] = self.low[:-1][same], self.high[:-1][same]
        low_after[:-1][same], high_after[:-1][same] = self.low[1:][same], self.high[1:][same]
        return same, low_before, high_before, low_after, high_after

    def name_runs(self) -> "Symbols":
        """Maximal runs become one symbol; to be maximal is seen at both neighbours."""
        same, low_b, high_b, low_a, high_a = self._next_to()
        goes_on = same & (self.names[1:] == self.names[:-1])
        first = np.flatnonzero(np.concatenate([[True], ~goes_on]))
        last = np.concatenate([first[1:] - 1, [len(self.names) - 1]])
        size = (last - first + 1).astype(np.uint64)
        names = self.names[first]
        names = np.where(size > 1, mix(mix(names ^ _RUN) + size), names)
        low = np.minimum(np.minimum.reduceat(self.low, first), np.minimum(low_b[first], low_a[last]))
        high = np.maximum(np.maximum.reduceat(self.high, first), np.maximum(high_b[first], high_a[last]))
        return Symbols(names, self.doc[first], low, high)

    def name_pairs(self, level: int) -> "Symbols":
        """A left symbol and the right symbol after it become one. A left symbol
        stays alone because of the one after it, a right one of the one before."""
        same, low_b, high_b, low_a, high_a = self._next_to()
        right = (mix(self.names + np.uint64(level + 1)) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(self.names), bool)  # with the next symbol
        joins[:-1] = same & ~right[:-1] & right[1:]
        joined = np.zeros(len(self.names), bool)  # with the symbol before
        joined[1:] = joins[:-1]
        low = np.where(right, np.minimum(self.low, low_b), np.minimum(self.low, low_a))
        high = np.where(right, np.maximum(self.high, high_b), np.maximum(self.high, high_a))
        names = self.names.copy()
        at = np.flatnonzero(joins)
        names[at] = mix(mix(self.names[at] ^ _PAIR) + self.names[at + 1])
        low[at] = np.minimum(self.low[at], self.low[at + 1])
        high[at] = np.maximum(self.high[at], self.high[at + 1])
        keep = ~joined
        return Symbols(names[keep], self.doc[keep], low[keep], high[keep])


def recompress(names: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    """The symbols of texts after ``rounds`` rounds. ``names``: of all words;
    ``first``: the texts' offsets into them."""
    at = np.arange(len(names), dtype=np.int64)
    symbols = Symbols(names, np.repeat(np.arange(len(first) - 1), np.diff(first)), at, at + 1)
    for level in range(rounds):
        if len(symbols.names):
            symbols = symbols.name_runs().name_pairs(level)
    return symbols


class _Block:
    """A block's words with their names, the ids of their documents, and windows."""

    def __init__(self, block: bytes, text_col: str):
        self.rows = rows_of(block)
        self.texts = pc.fill_null(self.rows.column(text_col), "")
        self.words = words_of(self.texts)
        self.first = self.words.first
        self.names = word_hashes(self.words)
        self.ids = pc.fill_null(self.rows.column(_PLACE), NO_ID).to_numpy()

    def symbols(self):
        """(symbols, sorted unique names, flags: in several documents, index)"""
        s = recompress(self.names, self.first)
        if not len(s.names):
            none = np.zeros(0, np.int64)
            return s, s.names, none.astype(np.uint8), none
        order = np.argsort(s.names)
        names, ids = s.names[order], self.ids[s.doc[order]]
        new = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        several = np.minimum.reduceat(ids, new) < np.maximum.reduceat(ids, new)
        index = np.empty(len(order), np.int64)
        index[order] = np.cumsum(np.concatenate([[False], names[1:] != names[:-1]]))
        return s, names[new], several.astype(np.uint8), index

    def window_starts(self, parts: Ranges, answers) -> np.ndarray:
        """Starts of windows without a symbol that stands in one document alone."""
        n = len(self.names)
        doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        if n < WINDOW:
            return np.zeros(0, np.int64)
        s, keys, _, index = self.symbols()
        alone = ~answer_bits(keys, parts, answers)[index]
        low, high = s.low[alone], s.high[alone]
        fits = (high - low <= WINDOW) & (low >= 0)
        # the windows [i, i + WINDOW) that hold [low, high): high - WINDOW <= i <= low
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, np.maximum(high[fits] - WINDOW, 0), 1)
        np.add.at(edge, low[fits] + 1, -1)
        unique = np.cumsum(edge[:n]) > 0
        return np.flatnonzero((doc[: n - WINDOW + 1] == doc[WINDOW - 1:]) & ~unique[: n - WINDOW + 1])

    def windows(self, at: np.ndarray):
        """(sorted unique keys, check, smallest id, index) of the windows at ``at``"""
        prints = Fingerprints(self.names, 3)
        keys, first, index, _ = distinct(prints.of(at, at + WINDOW))
        # windows that differ and yet agree in the whole fingerprint differ in their halves'
        check = prints.of(at[first], at[first] + WINDOW // 2).astype(np.uint32)
        smallest = np.full(len(keys), NO_ID, np.int64)
        np.minimum.at(smallest, index, self.id_at(at))
        return keys, check, smallest, index

    def id_at(self, at: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.first, at, side="right") - 1]


def _each(batch: pa.RecordBatch, *names: str):
    for k in range(batch.num_rows):
        yield tuple(batch.column(n)[k].as_py() for n in names)


def _symbol_keys(text_col: str, parts: Ranges):
    def run(batches):
        for batch in batches:
            for number, block in _each(batch, "block", "rows"):
                _, keys, several, _ = _Block(block, text_col).symbols()
                yield key_rows(number, keys, parts, (several,))

    return run


def _window_keys(text_col: str, symbol_parts: Ranges, parts: Ranges):
    def run(batches):
        for batch in batches:
            for number, block, first in _each(batch, "block", "rows", "a0"):
                b = _Block(block, text_col)
                keys, check, smallest, _ = b.windows(b.window_starts(symbol_parts, first))
                yield key_rows(number, keys, parts, (check, smallest))

    return run


def _removed_words(b: _Block, symbol_parts: Ranges, parts: Ranges, first, second) -> np.ndarray:
    """Per word of the block: is it removed?"""
    at = b.window_starts(symbol_parts, first)
    edge = np.zeros(len(b.names) + 1, np.int32)
    if len(at):
        keys, _, smallest, index = b.windows(at)
        elsewhere = answer_bits(keys, parts, second)
        hit = at[elsewhere[index] | (b.id_at(at) > smallest[index])]
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def _results(id_col: str, text_col: str, symbol_parts: Ranges, parts: Ranges, report: bool):
    def run(batches):
        for batch in batches:
            for block, first, second in _each(batch, "rows", "a0", "a1"):
                b = _Block(block, text_col)
                removed = _removed_words(b, symbol_parts, parts, first, second)
                counts = np.concatenate([[0], np.cumsum(removed)])
                lost = counts[b.first[1:]] - counts[b.first[:-1]]
                texts = b.texts.to_pylist()
                kept = []
                for d, text in enumerate(texts):
                    if not lost[d] and not report:
                        kept.append(text)
                        continue
                    words = text.encode().split()
                    if lost[d]:
                        words = compress(words, ~removed[b.first[d]: b.first[d + 1]])
                    kept.append(b" ".join(words))
                if report:
                    yield pa.RecordBatch.from_arrays(
                        [b.rows.column(id_col), pa.array(np.diff(b.first), pa.int64()), pa.array(lost, pa.int64()),
                         pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                        ["id", "n_words", "n_removed", "kept_sha256"])
                else:
                    column = b.rows.column(text_col)
                    changed = [None if column[d].as_py() is None else k if isinstance(k, str) else k.decode()
                               for d, k in enumerate(kept)]
                    at = b.rows.schema.get_field_index(text_col)
                    out = b.rows.set_column(at, b.rows.schema.field(at), pa.array(changed, column.type))
                    yield out.drop_columns([_PLACE])

    return run


def _placed(docs: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with the place of each id in the order of ids; a null id has none."""
    if isinstance(docs.schema[id_col].dataType, T.IntegralType):
        return docs.withColumn(_PLACE, F.col(id_col).cast("long"))
    ranks = materialise(count_below(docs.select(id_col)).select("value", F.col("below").alias(_PLACE)), "id-places")
    return docs.join(ranks, docs[id_col] == ranks["value"], "left").drop("value")


def _passes(docs: DataFrame, id_col: str, text_col: str, report: bool, schema, block_bytes: int, part_keys: int,
            fan: int) -> DataFrame:
    blocks = BlockTable(_placed(docs, id_col), text_col, block_bytes, part_keys, fan)
    words = blocks.bytes // 5
    symbol_parts, parts = blocks.ranges(words // 2), blocks.ranges(words // 2)
    shared = exchange(blocks.table.select("block", "rows")
                      .mapInArrow(_symbol_keys(text_col, symbol_parts), KEY_SCHEMA),
                      symbol_parts, repeated, (np.uint8,))
    smaller = exchange(blocks.with_answers(shared)
                       .mapInArrow(_window_keys(text_col, symbol_parts, parts), KEY_SCHEMA),
                       parts, has_smaller, (np.uint32, np.int64))
    return blocks.with_answers(shared, smaller).mapInArrow(
        _results(id_col, text_col, symbol_parts, parts, report), schema)


def window_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
                  part_keys: int = PART_KEYS, fan: int = FAN) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``n_removed`` and
    ``kept_sha256`` (of the kept words joined by one space). ``part_keys`` keys make a
    range; a block sends to at most ``fan``, or in two levels."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    out = _passes(source, "id", "text", True, f"id {kind}, n_words long, n_removed long, kept_sha256 string",
                  block_bytes, part_keys, fan)
    return out.withColumnRenamed("id", id_col)


def remove_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
                   part_keys: int = PART_KEYS, fan: int = FAN) -> DataFrame:
    """The rows of ``docs`` without the repeated words, all columns kept."""
    inner = {c: f"c{k}" for k, c in enumerate(docs.columns)}  # free of clashes with block columns
    copy = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    out = _passes(copy, inner[id_col], inner[text_col], False, copy.schema, block_bytes, part_keys, fan)
    return out.select(*[F.col(n).alias(c) for c, n in inner.items()])
