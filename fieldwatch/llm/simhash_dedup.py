"""Operator 5: SimHash near-deduplication over deletion-variant signatures.

Fingerprints (64 bits, over XXH64 values of word shingles) link when at most
``MAX_BITS`` = 2 bits differ. Cut into two halves, one half then differs in at
most one bit. So each distinct fingerprint is indexed under 64 signatures: for
both halves and each of its 32 bits, the half without that bit. Fingerprints
that link share a signature; an equality join on the signature finds the
candidates and the full bit distance verifies them.

Copies share a fingerprint and are one entry of the index. A signature with more
than ``BUCKET`` fingerprints is not expanded into pairs: its members are linked
through their neighbours instead. Each member is entered under itself and the 64
fingerprints one bit away; members under the same entry are at most two bits
apart, and any two that are so share an entry. An entry has at most 65 members,
so a star to its smallest member says the same as all pairs.

Links are reduced to components by repeated contraction (``components.py``).

Cases: a null text has no words; texts without words have fingerprint zero and
link like any other; a text of fewer words than a shingle is one shingle; a null
id is never the smallest (component_id is null only where no member has an id);
rows that repeat an id are linked by their own texts; an empty table gives no
rows; other columns are carried by ``drop_near_duplicates`` untouched, whatever
their names.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import free_name, materialise, with_columns
from fieldwatch.llm.components import components

SHINGLE = 3
MAX_BITS = 2
BUCKET = 64
_BLOCK = 1 << 18  # shingles whose bits are counted at once


def _fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    import xxhash

    hashes, counts = [], []
    for text in texts:
        words = text.lower().split()  # ASCII case and white space only, for bytes
        if len(words) > shingle:
            grams = map(b" ".join, zip(*[words[k:] for k in range(shingle)]))
            own = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64, len(words) - shingle + 1)
        elif words:
            own = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
        else:
            own = np.zeros(0, np.uint64)
        hashes.append(own)
        counts.append(len(own))
    out = np.zeros(len(texts), np.uint64)
    if not sum(counts):
        return out
    flat, counts = np.concatenate(hashes), np.array(counts)
    doc = np.repeat(np.arange(len(texts)), counts)
    votes = np.zeros((len(texts), 64), np.int64)
    for at in range(0, len(flat), _BLOCK):
        part, own = flat[at: at + _BLOCK], doc[at: at + _BLOCK]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        edge = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        votes[own[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int32)
    majority = 2 * votes > counts[:, None]
    packed = np.packbits(majority, axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8").ravel().astype(np.uint64)


def _with_fingerprint(text_at: int, names: list[str], shingle: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = pc.fill_null(part.column(text_at), "").cast(pa.binary())
                prints = _fingerprints(texts.to_pylist(), shingle)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(prints.view(np.int64))], names)

    return run


def _signatures():
    """Task function, vectorised: print -> 64 rows (signature, print)."""
    wild = np.arange(32, dtype=np.uint64)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                prints = batch.column(0).slice(at, 4096).to_numpy().view(np.uint64)
                low, high = prints & np.uint64(0xFFFFFFFF), prints >> np.uint64(32)
                keys = []
                for side, half in enumerate((low, high)):
                    rest = half[:, None] & ~(np.uint64(1) << wild)[None, :]
                    keys.append(rest | ((np.uint64(32 * side) + wild) << np.uint64(32))[None, :])
                key = np.concatenate(keys, axis=1).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.repeat(prints.view(np.int64), 64))],
                    ["signature", "print"])

    return run


def _bucket_links(bucket: int, max_bits: int):
    """Task function over rows sorted by signature: verified links (a, b) of the
    signatures with at most ``bucket`` prints; (a, null) for members of larger ones.
    Holds one batch and the open signature's first ``bucket`` + 1 prints."""

    def links(key: np.ndarray, value: np.ndarray):
        """Links of complete runs, and members of runs that are too long."""
        new = np.concatenate([[True], key[1:] != key[:-1]])
        run = np.cumsum(new) - 1
        size = np.bincount(run)[run]
        large = size > bucket
        a, b = [], []
        small_key, small = key[~large], value[~large]
        for step in range(1, min(bucket, int(size[~large].max(initial=0)))):
            same = small_key[step:] == small_key[:-step]
            left, right = small[:-step][same], small[step:][same]
            near = np.bitwise_count((left ^ right).view(np.uint64)) <= max_bits
            a.append(left[near])
            b.append(right[near])
        return (np.concatenate(a) if a else value[:0]), (np.concatenate(b) if b else value[:0]), value[large]

    def batch_of(a, b, members):
        first, second = np.minimum(a, b), np.maximum(a, b)
        both = np.unique(np.stack([first, second], axis=1), axis=0) if len(first) else np.zeros((0, 2), np.int64)
        members = np.unique(members)
        left = pa.array(np.concatenate([both[:, 0], members]))
        right = pa.array(np.concatenate([both[:, 1], members]),
                         mask=np.concatenate([np.zeros(len(both), bool), np.ones(len(members), bool)]))
        return pa.RecordBatch.from_arrays([left, right], ["a", "b"])

    def run(batches):
        key, value, long_key = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            k, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if long_key is not None:  # rest of a run already known to be long
                rest = int(np.searchsorted(k != long_key, True)) if (k != long_key).any() else len(k)
                yield batch_of(v[:0], v[:0], v[:rest])
                k, v = k[rest:], v[rest:]
                if not len(k):
                    continue
                long_key = None
            key, value = np.concatenate([key, k]), np.concatenate([value, v])
            if not len(key):
                continue
            open_at = int(np.searchsorted(key, key[-1]))  # the last run may go on
            done = links(key[:open_at], value[:open_at]) if open_at else (value[:0],) * 3
            key, value = key[open_at:], value[open_at:]
            if len(key) > bucket:
                long_key = key[-1]
                done = (done[0], done[1], np.concatenate([done[2], value]))
                key, value = key[:0], value[:0]
            yield batch_of(*done)
        if len(key):
            yield batch_of(*links(key, value))

    return run


def _neighbours():
    """Task function: print -> itself and the 64 prints one bit away (65 rows)."""
    flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                prints = batch.column(0).slice(at, 4096).to_numpy().view(np.uint64)
                key = (prints[:, None] ^ flips[None, :]).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.repeat(prints.view(np.int64), 65))], ["entry", "print"])

    return run


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``print``) that connect
    exactly those at most two bits apart, directly or through shared entries."""
    signed = prints.mapInArrow(_signatures(), "signature long, print long")
    found = (signed.repartition("signature").sortWithinPartitions("signature")
             .mapInArrow(_bucket_links(bucket, MAX_BITS), "a long, b long"))
    found = materialise(found.distinct(), "simhash-links")
    crowded = found.filter(F.col("b").isNull()).select(F.col("a").alias("print"))
    entered = crowded.mapInArrow(_neighbours(), "entry long, print long")
    stars = (entered.groupBy("entry").agg(F.collect_list("print").alias("prints"))  # at most 65 each
             .filter(F.size("prints") > 1)
             .select(F.array_min("prints").alias("a"), F.explode("prints").alias("b")).filter("a <> b"))
    return found.filter(F.col("b").isNotNull()).unionByName(stars).distinct()


def _rows(docs: DataFrame, text_col: str, shingle: int, print_col: str) -> DataFrame:
    names = [*docs.columns, print_col]
    return docs.mapInArrow(_with_fingerprint(docs.columns.index(text_col), names, shingle),
                           with_columns(docs, [print_col], "long"))


def _groups(rows: DataFrame, bucket: int) -> DataFrame:
    """(print, component_id, keep_row) for rows (id, print, row)."""
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row"))
    prints = materialise(rows.groupBy("print").agg(F.min(order).alias("first")), "simhash-prints")
    member = components(links(prints.select("print"), bucket))  # node, root; linked prints only
    rooted = prints.join(member.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first", F.coalesce("root", "print").alias("root"))
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    return materialise(rooted.join(best, "root").select(
        "print", F.col("best.id").alias("component_id"), F.col("best.row").alias("keep_row")), "simhash-groups")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (hex) and
    ``component_id``, the smallest id reachable over links."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = materialise(_rows(source, "text", shingle, "print").drop("text")
                       .withColumn("row", F.monotonically_increasing_id()), "simhash-rows")
    groups = _groups(rows, bucket).drop("keep_row")
    # both sides are plain scans, so a fingerprint with a third of the rows is split
    return rows.join(groups, "print").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         bucket: int = BUCKET) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component (the smallest id;
    of rows that repeat it the first in the written copy), with all columns."""
    print_col, row_col = free_name(docs, "_print"), free_name(docs, "_row")
    rows = materialise(_rows(docs, text_col, shingle, print_col)
                       .withColumn(row_col, F.monotonically_increasing_id()), "simhash-documents")
    groups = _groups(rows.select(F.col(id_col).alias("id"), F.col(print_col).alias("print"),
                                 F.col(row_col).alias("row")), bucket)
    keep = groups.select(F.col("keep_row").alias(row_col)).distinct()
    return rows.join(keep, row_col, "left_semi").select(*docs.columns)
