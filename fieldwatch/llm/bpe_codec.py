"""Operator 8: BPE encoding and decoding over a distinct-word table.

1. Split. Documents travel in blocks (``blocks.py``); each block splits its texts
   into words as the tokenizer file says (normaliser, pre-tokenizer, special
   strings) and sends every distinct word once, sorted, in one packed row for
   each range of words.
2. Encode. The words of all blocks are dealt by word, so each distinct word
   meets in one place and the library encodes it once for the whole corpus.
3. Join back by position. A block gets the ids of its words back in the order
   of its word list, and its texts, rows of words, become rows of ids.
4. Decode. Ids are joined to their pieces (the vocabulary, a table of fixed size
   that every task holds) and the pieces are put together as the file's decoder
   says.

A frequent word is one row for each block, never one for each occurrence, so no
word fills a task. Where a block would have too many ranges to send to, a group of
blocks merges its words first (two levels, as ``blocks.py`` has them for keys).

Words are split by a regular expression where the installed Unicode tables agree
with the library's (see ``PLAIN``); the library's own normaliser and
pre-tokenizer split all other texts.

Cases: a null text counts as empty (no ids, empty decoding); rows that repeat an
id, or have none, are coded row by row; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.blocks import FAN, PART_KEYS, BlockTable, Ranges, rows_of, to_bytes
from fieldwatch.llm.common import materialise, worker_store
from fieldwatch.llm.textarrays import Fingerprints, bytes_of
from fieldwatch.llm.tokenizer import load_tokenizer, special_strings, tokenizer_text

BLOCK_BYTES = 8_000_000
# Latin letters and signs up to U+024F: unchanged by NFC, one lower-case character
# each but for U+0130, the same classes in all Unicode versions
PLAIN = "\x00-\x1b\x20-\u012f\u0131-\u024f"


class WordSplitter:
    """text -> words of the tokenizer file, special strings as words of their own."""

    def __init__(self, spec: str):
        kind = json.loads(spec)
        self.library = load_tokenizer(spec)
        self.specials = special_strings(spec)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.odd = re.compile(f"[^{PLAIN}]").search
        steps = (kind.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = steps[0] if steps and steps[0].get("type") == "Split" else {}
        normal = [n.get("type") for n in (kind.get("normalizer") or {}).get("normalizers", [])]
        self.find = None
        if split.get("invert") and split.get("behavior") == "Removed" and normal == ["NFC", "Replace", "Lowercase"]:
            import regex

            self.find = regex.compile(split["pattern"]["Regex"]).findall

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        if self.cut is None or not any(s in text for s in self.specials):
            return self._plain(text)
        out = []
        for piece in self.cut.split(text):
            out += [piece] if piece in self.specials else self._plain(piece) if piece else []
        return out

    def _plain(self, text: str) -> list[str]:
        if self.find is not None and not self.odd(text):
            return self.find(text.lower())
        lowered = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        return [lowered[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(lowered)]


class WordEncoder:
    """word -> ids as little-endian 32-bit bytes, by the library's model alone."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.bare = Tokenizer(Tokenizer.from_str(spec).model)
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = {t["content"]: t["id"] for t in json.loads(spec).get("added_tokens", [])}

    def encode(self, words: list[str]) -> list[bytes]:
        return [np.array([self.special[w]] if w in self.special else e.ids, "<u4").tobytes()
                for w, e in zip(words, self.bare.encode_batch(words, add_special_tokens=False))]


def pieces_of(spec: str) -> tuple[list[bytes], bool]:
    """(piece of every id in bytes, put a space between pieces?). Files without a
    decoder join their pieces by a space; others are left to the library."""
    kind = json.loads(spec)
    vocab = dict(kind["model"]["vocab"]) | {t["content"]: t["id"] for t in kind.get("added_tokens", [])}
    pieces = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        pieces[i] = piece.encode()
    return pieces, kind.get("decoder") is None


def _parts_of(words: pa.Array, parts: int) -> np.ndarray:
    """Which of ``parts`` ranges each word falls into, by its fingerprint."""
    data, offsets = bytes_of(words)
    prints = Fingerprints(data, 1).of(offsets[:-1], offsets[1:])
    return ((prints >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def _ranged(words: pa.Array, part: np.ndarray):
    """(range, positions of its words) for each range that has some."""
    order = np.argsort(part, kind="stable")
    ranked = part[order]
    edges = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]])) if len(words) else [0]
    for x, y in zip(edges[:-1], edges[1:]):
        yield int(ranked[x]), order[x:y]


def _by_range(known, to: Ranges):
    """Distinct words as (range, words in order) for each range that has some. Both
    sides of the exchange derive the same order, so positions need not travel."""
    words = pa.array(sorted(known), pa.string())
    for p, at in _ranged(words, _parts_of(words, to.first * to.second) // to.second):
        yield p, words.take(pa.array(at))


def _packed(column: pa.Array, name: str) -> bytes:
    return to_bytes([pa.RecordBatch.from_arrays([column], [name])])


def _word_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
                                       pa.array(columns[2], pa.binary())], ["part", "block", "words"])


def _id_row(block: int, part: int, ids: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([part], pa.int32()),
                                       pa.array([_packed(ids, "ids")], pa.binary())], ["block", "part", "ids"])


def _distinct_words(spec: str, to: Ranges):
    """Task function: the distinct words of every block, one row for each range."""

    def run(batches):
        splitter = WordSplitter(spec)
        for batch in batches:
            for number, block in zip(*[c.to_pylist() for c in batch.columns]):
                known: set[str] = set()
                for text in rows_of(block).column("text").to_pylist():
                    known.update(splitter.words(text or ""))
                yield _word_rows([(p, number, _packed(words, "word")) for p, words in _by_range(known, to)])

    return run


def _encoded(spec: str):
    """Task function over all rows of a range: each distinct word is encoded once,
    and every block is answered with its words' ids in the order it sent them."""

    def run(batches):
        rows = [r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns])]
        encoder = WordEncoder(spec)
        for part in sorted({r[0] for r in rows}):
            own = [(r[1], rows_of(r[2])) for r in rows if r[0] == part]
            table = pa.chunked_array([b.column("word") for _, b in own]).combine_chunks().dictionary_encode()
            ids: list[bytes] = []
            for at in range(0, len(table.dictionary), 20_000):
                ids += encoder.encode(table.dictionary.slice(at, 20_000).to_pylist())
            encoded = pa.array(ids, pa.binary())
            at = 0
            for number, batch in own:
                answer = encoded.take(table.indices.slice(at, batch.num_rows))
                at += batch.num_rows
                yield _id_row(number, part, answer)

    return run


class _Cell:
    """The words of a group of blocks for one range of the first level, each once."""

    def __init__(self, row: dict, to: Ranges):
        self.number, self.part, self.blocks = row["cell"], row["part"], [r["block"] for r in row["rows"]]
        own = [rows_of(r["words"]).column("word") for r in row["rows"]]
        self.sizes = [len(w) for w in own]
        table = pa.chunked_array(own).combine_chunks().dictionary_encode()
        self.words, self.index = table.dictionary, table.indices
        self.ranges = list(_ranged(self.words, _parts_of(self.words, to.first * to.second)))


def _cell_rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def _sent_on(to: Ranges):
    def run(batches):
        for row in _cell_rows(batches):
            c = _Cell(row, to)
            yield _word_rows([(p, c.number, _packed(c.words.take(pa.array(at)), "word")) for p, at in c.ranges])

    return run


def _passed_back(to: Ranges):
    def run(batches):
        for row in _cell_rows(batches):
            c = _Cell(row, to)
            told = {a["part"]: rows_of(a["ids"]).column("ids") for a in row["answers"]}
            place = np.empty(len(c.words), np.int64)
            place[np.concatenate([at for _, at in c.ranges])] = np.arange(len(c.words))
            ids = pa.chunked_array([told[p] for p, _ in c.ranges]).combine_chunks().take(pa.array(place)).take(c.index)
            at = 0
            for block, size in zip(c.blocks, c.sizes):
                yield _id_row(block, c.part, ids.slice(at, size))
                at += size

    return run


_IDS = "block long, part int, ids binary"


def _asked(words: DataFrame, parts: int, spec: str) -> DataFrame:
    return words.repartitionById(parts, F.col("part")).mapInArrow(_encoded(spec), _IDS)


def _ids_of_words(words: DataFrame, to: Ranges, spec: str) -> DataFrame:
    """(block, part, ids) for the rows of ``_distinct_words``."""
    if to.second == 1:
        return _asked(words, to.first, spec)
    cell = F.col("part").cast("long") * to.groups + F.pmod(F.xxhash64("block"), F.lit(to.groups))
    cells = materialise(words.groupBy(cell.alias("cell"), "part").agg(
        F.collect_list(F.struct("block", "words")).alias("rows")), "word-cells")
    answers = (_asked(cells.mapInArrow(_sent_on(to), "part int, block long, words binary"), to.first * to.second, spec)
               .groupBy(F.col("block").alias("cell")).agg(F.collect_list(F.struct("part", "ids")).alias("answers")))
    return cells.join(answers, "cell").select(*cells.columns, "answers").mapInArrow(_passed_back(to), _IDS)


def _coded(spec: str, to: Ranges, texts_out: bool):
    def run(batches):
        store = worker_store("pieces")
        if store.get("spec") != spec:
            pieces, spaced = pieces_of(spec)
            store.update(spec=spec, spaced=spaced,
                         pieces=pa.array([p + b" " * spaced for p in pieces], pa.large_binary()))
        pieces, spaced = store["pieces"], store["spaced"]
        splitter, library = WordSplitter(spec), load_tokenizer(spec)

        def decode(ids: np.ndarray) -> bytes:
            if not spaced:
                return library.decode(ids.tolist(), skip_special_tokens=False).encode()
            return bytes(memoryview(pieces.take(pa.array(ids)).buffers()[2] or b""))[:-1]

        for batch in batches:
            for k in range(batch.num_rows):
                rows = rows_of(batch.column("rows")[k].as_py())
                lists = [splitter.words(t or "") for t in rows.column("text").to_pylist()]
                answers = {a["part"]: rows_of(a["ids"]) for a in batch.column("answers")[k].as_py() or ()}
                ids_of: dict[str, bytes] = {}
                for part, words in _by_range(set().union(*lists), to):
                    ids_of.update(zip(words.to_pylist(), answers[part].column("ids").to_pylist()))
                n, ids_out, texts = [], [], []
                for own in lists:
                    ids = b"".join(map(ids_of.__getitem__, own))
                    n.append(len(ids) // 4)
                    ids_out.append(ids)
                    texts.append(decode(np.frombuffer(ids, "<u4")) if ids else b"")
                if texts_out:
                    flat = np.frombuffer(b"".join(ids_out), "<u4").astype(np.int64)
                    arrays = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), pa.array(flat))
                    second = [arrays, pa.array([t.decode() for t in texts], pa.string())]
                else:
                    second = [pa.array([hashlib.sha256(x).hexdigest() for x in col]) for col in (ids_out, texts)]
                yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(n, pa.int64()), *second],
                                                 ["id", "n_tokens", "ids", "decoded"])

    return run


def _run(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, texts_out: bool, block_bytes: int,
         part_words: int, fan: int) -> DataFrame:
    spec = tokenizer_text(tokenizer_path)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    blocks = BlockTable(source, "text", block_bytes, part_words, fan)
    # blocks repeat words: there are never more rows than words, of 12 bytes or so
    to = blocks.ranges(blocks.bytes // 12)
    words = blocks.table.select("block", "rows").mapInArrow(
        _distinct_words(spec, to), "part int, block long, words binary")
    answers = (_ids_of_words(words, to, spec).repartition(blocks.buckets, "block").groupBy("block")
               .agg(F.collect_list(F.struct("part", "ids")).alias("answers")))
    id_type = source.schema["id"].dataType.simpleString()
    kinds = "ids array<long>, decoded string" if texts_out else "ids string, decoded string"
    return blocks.table.join(answers, "block", "left").select("rows", "answers").mapInArrow(
        _coded(spec, to, texts_out), f"id {id_type}, n_tokens long, {kinds}").withColumnRenamed("id", id_col)


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES, part_words: int = PART_KEYS, fan: int = FAN) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_tokens``, ``ids`` and the text
    ``decoded`` from them. ``part_words`` words make a range; a block sends to at most
    ``fan``, or in two levels."""
    return _run(docs, tokenizer_path, id_col, text_col, True, block_bytes, part_words, fan)


def codec_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES, part_words: int = PART_KEYS, fan: int = FAN) -> DataFrame:
    """As ``encode_decode``, with SHA-256 digests ``ids_sha256`` (ids as 32-bit
    little-endian integers) and ``decoded_sha256`` in place of the values."""
    return (_run(docs, tokenizer_path, id_col, text_col, False, block_bytes, part_words, fan)
            .withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"}))
