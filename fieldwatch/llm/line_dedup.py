"""Operator 10: removal of repeated runs of lines by winnowing, native DataFrame code.

Lines are the parts of a text between line feeds. A run of at least ``RUN``
consecutive lines that has occurred before (in a document with a smaller id, or
further up in the same one) is deleted; the first occurrence stays. Runs without
a word do not count. A shorter run, down to a single line, is deleted alike if it
has at least ``WORDS`` words; ``words=None`` leaves shorter runs alone. Runs are
judged on the input.

1. Winnow. Every window of ``RUN`` lines selects the line with the smallest hash
   (of equal ones the first) as its fingerprint. Equal windows select the same
   line, so a repeated run is guaranteed to show as a repeated fingerprint. A
   shorter window is its own fingerprint, by the hash of its whole text.
2. A fingerprint at one position of the corpus alone proves its windows unique;
   only windows whose fingerprint occurs again go on.
3. Join positions and extend. Those windows are the lines around a repeated
   fingerprint, extended both ways; they are compared by the SHA-256 digest of
   their whole text. The first position of each digest is its origin.
4. Windows at other positions are deleted. Overlapping ones add up to maximal
   runs.

Counts and first positions are aggregates with a map-side half. The joins that
bring them back never broadcast (what they join grows with the corpus) and have
plain scans on both sides, so a line or passage in a third of all documents is
split, and plans are alike at every size.

Cases: a null text counts as empty, which is one empty line; a null id comes
after all others; of rows that repeat an id, the first in the written copy comes
first; an empty table gives no rows; ``drop_repeated_lines`` carries all columns,
whatever their names, and leaves null texts null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import materialise, text_of

RUN = 3
WORDS = 8  # fewest words of a run shorter than RUN

_WORD = "[^\\x20\\x09-\\x0D]"


def _windows(rows: DataFrame, run: int, words: int | None) -> DataFrame:
    """(id, row, start, width, print, fresh, digest): all windows with their
    fingerprints. ``row`` numbers the documents; ``fresh`` marks the first window that
    selects a position; the digest is null for a window without a word. Of windows
    of fewer than ``run`` lines there are those of at least ``words`` words."""
    hashes = rows.select("id", "row", F.split(text_of("text"), "\n", -1).alias("lines")).withColumn(
        "hashes", F.transform("lines", lambda x: F.xxhash64(x)))
    starts = F.when(F.size("lines") >= run, F.sequence(F.lit(0), F.size("lines") - run))

    def position(i):
        own = F.slice("hashes", i + 1, run)
        return i + F.array_position(own, F.array_min(own))

    def window(i):
        text = F.array_join(F.slice("lines", i + 1, run), "\n")
        # selected positions never move back, so a position is new or that of the window before
        fresh = (i == 0) | (position(F.greatest(i - 1, F.lit(0))) != position(i))
        return F.struct(i.alias("start"), F.lit(run).alias("width"),
                        F.array_min(F.slice("hashes", i + 1, run)).alias("print"), fresh.alias("fresh"),
                        F.when(text.rlike(_WORD), F.unhex(F.sha2(text, 256))).alias("digest"))

    def short(width):
        def of(i):
            text = F.array_join(F.slice("lines", i + 1, width), "\n")
            return F.struct(i.alias("start"), F.lit(width).alias("width"),
                            F.xxhash64(text, F.lit(width)).alias("print"), F.lit(True).alias("fresh"),
                            F.unhex(F.sha2(text, 256)).alias("digest"))

        enough = lambda i: F.aggregate(F.slice("counts", i + 1, width), F.lit(0), lambda n, c: n + c) >= words
        at = F.when(F.size("lines") >= width, F.sequence(F.lit(0), F.size("lines") - width))
        return F.transform(F.filter(F.coalesce(at, F.array().cast("array<int>")), enough), of)

    found = F.transform(F.coalesce(starts, F.array().cast("array<int>")), window)
    if words is not None:
        hashes = hashes.withColumn("counts", F.transform("lines", lambda x: F.regexp_count(x, F.lit(f"{_WORD}+"))))
        found = F.concat(found, *[short(width) for width in range(1, run)])
    return (hashes.select("id", "row", F.explode(found).alias("w"))
            .select("id", "row", "w.start", "w.width", "w.print", "w.fresh", "w.digest"))


def repeated_windows(rows: DataFrame, run: int = RUN, words: int | None = WORDS) -> DataFrame:
    """(row, found): start and width of the windows of each document that have
    occurred before."""
    windows = materialise(_windows(rows, run, words), "line-windows")
    prints = (windows.filter("fresh").groupBy("print").agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1).select("print"))
    near = materialise(windows.filter(F.col("digest").isNotNull())
                       .join(materialise(prints, "line-prints").hint("merge"), "print", "left_semi")
                       .select("id", "row", "start", "width", "digest"), "line-matches")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "row", "start")
    origin = (near.groupBy("digest").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1).select("digest", "origin"))
    later = near.join(materialise(origin, "line-origins").hint("merge"), "digest").filter(
        (F.col("row") != F.col("origin.row")) | (F.col("start") != F.col("origin.start")))
    return later.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "width"))).alias("found"))


def _kept(rows: DataFrame, run: int, words: int | None) -> DataFrame:
    """``rows`` with n_lines, n_removed, n_runs and ``kept`` (what is left of the text)."""
    found = rows.join(materialise(repeated_windows(rows, run, words), "line-repeats").hint("merge"), "row", "left")
    lines = F.split(text_of("text"), "\n", -1)
    gone = F.coalesce(F.array_distinct(F.flatten(F.transform(
        "found", lambda w: F.sequence(w["start"], w["start"] + w["width"] - 1)))), F.array().cast("array<int>"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    # a maximal run begins at a removed line whose line before stays
    runs = F.size(F.array_except("gone", F.transform("gone", lambda p: p + 1)))
    return (found.withColumn("lines", lines).withColumn("gone", gone)
            .withColumn("n_lines", F.size("lines").cast("long"))
            .withColumn("n_removed", F.size("gone").cast("long"))
            .withColumn("n_runs", runs.cast("long"))
            .withColumn("kept", F.when(F.size("gone") == 0, text_of("text")).otherwise(
                F.array_join(F.transform(left, lambda p: F.get("lines", p)), "\n")))
            .drop("lines", "gone", "found"))


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
                words: int | None = WORDS) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_lines``, ``n_removed``, ``n_runs``
    (maximal deleted runs) and ``kept_sha256`` (of the kept lines joined by line feeds)."""
    rows = materialise(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                   F.monotonically_increasing_id().alias("row")), "line-documents")
    return _kept(rows, run, words).select(F.col("id").alias(id_col), "n_lines", "n_removed", "n_runs",
                                          F.sha2("kept", 256).alias("kept_sha256"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
                        words: int | None = WORDS) -> DataFrame:
    """The rows of ``docs`` without the repeated runs, all columns kept."""
    inner = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    copy = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    rows = materialise(copy.withColumns({"id": F.col(inner[id_col]), "text": F.col(inner[text_col]),
                                         "row": F.monotonically_increasing_id()}), "line-documents")
    text = F.when(F.col("text").isNotNull(), F.col("kept"))
    return _kept(rows, run, words).select(*[(text if c == text_col else F.col(n)).alias(c) for c, n in inner.items()])
