"""Operator 12: spelling variants of the corpus's words, by a relational trie frontier.

``word_counts`` counts the words of all texts. ``variants`` then finds, for every
frequent word, the frequent words at exactly one inserted, deleted or replaced code
point, its *form* (the near word that is most frequent, if it is frequent enough
against the word) and its *root* (the last of the forms that follow).

The trie of all words is an edge table, spread over the cluster: (node, label,
child), where a node is the 64-bit hash of the letters that lead to it. A frontier of
states (word, node, rest), the position being what is left of the word, walks
through it by joins:

* The trie is kept twice, of the words and of the words read backwards, and a word is
  edited only in its second half of either. So a state starts at the node half-way
  down its word, where few words share a node, and no join passes the crowded root.
* The edit comes first: a letter is left out (the state stays at its node), or the
  state takes an edge whose letter is greater than the word's own. Insertions and
  smaller letters are the same links seen from the other word. A letter in a row of
  equal ones is left out once. So every link is found exactly once.
* With the edit spent, the rest must match. Levels are passed 1, 2, 4, ... letters at
  a time, by the binary digits of the number of letters left: a state leaves node and
  next letters by one equality join, and has at most one edge there. States without
  one are dropped; a state without letters left at a node where a word ends is a link.
* Links are checked against the words themselves (edit distance of exactly one), so
  that equal hashes of different prefixes cannot make one.

A state has as many edges to take at its edit as there are letters; nothing pairs the
words of a group. Each level is written to the shared folder, and the number of
levels is the number of binary digits of the longest rest, 17 for a word of 100,000
letters. Forms grow at least ``factor`` times a step, so the chains that give the
roots have at most log(2^63) / log(factor) links; they are followed by doubling.

Cases: a null text has no words; a null id counts as empty where it is hashed; rows
that repeat an id are counted like others; texts are taken whole; an empty table
gives no rows; further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.llm.common import materialise

LETTERS = "[A-Za-zÀ-ÿ]+"
#: a run loses a letter if this divides its hash
ONE_IN = 199
MIN_LETTERS, MIN_COUNT, FACTOR = 6, 5, 5


def word_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, one_in: int = ONE_IN) -> DataFrame:
    """(word, n): the words of at least ``min_letters`` code points and ``min_count``
    occurrences. ``one_in``: of so many (document, run) pairs one loses a letter."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= min_letters)  # a deletion makes none longer
    h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    at = (h % F.char_length("run")).cast("int")
    word = F.when(h % one_in == 0, _without(F.col("run"), at)).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).where(F.char_length("word") >= min_letters)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def _without(word: Column, at: Column) -> Column:
    """The word without its code point at a place counted from 0."""
    return F.concat(F.substring(word, F.lit(1), at), _from(word, at + 1))


def _from(word: Column, at: Column) -> Column:
    """The word from a place counted from 0 on."""
    return F.substring(word, at + 1, F.lit(1 << 30))


def _node(backwards: Column, word: Column, depth: Column) -> Column:
    return F.xxhash64(backwards, F.substring(word, F.lit(1), depth))


def _stride(left: Column) -> Column:
    """The lowest binary digit of a number of letters."""
    return left.bitwiseAND(-left)


def trie(words: DataFrame) -> DataFrame:
    """One row for each word, direction and place of the word's second half there:
    ``node`` before the place, ``letter`` at it, ``child`` after it, ``rest`` after the
    letter, the next ``label`` of 1, 2, 4, ... letters and the node it leads ``to``."""
    both = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    both = both.select("word", "n", "back", F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")).alias("w"),
                       F.char_length("word").alias("size"))
    half = F.expr("size div 2").cast("int")
    # places before the half forwards are those from size - half on backwards
    start = F.when(F.col("back"), F.col("size") - half).otherwise(half)
    at = both.withColumn("at", F.explode(F.when(start < F.col("size"), F.sequence(start, F.col("size") - 1))))
    step = _stride(F.col("size") - F.col("at"))
    letter = F.substring("w", F.col("at") + 1, F.lit(1))
    # in a row of equal letters, the first as the word is read forwards
    first = F.when(F.col("back"), letter != F.substring("w", F.col("at") + 2, F.lit(1))).otherwise(
        (F.col("at") == 0) | (letter != F.substring("w", F.greatest(F.col("at"), F.lit(1)), F.lit(1))))
    return at.select("word", "n", _node(F.col("back"), F.col("w"), F.col("at")).alias("node"),
                     letter.alias("letter"), _node(F.col("back"), F.col("w"), F.col("at") + 1).alias("child"),
                     _from(F.col("w"), F.col("at") + 1).alias("rest"), first.alias("first"),
                     F.substring("w", F.col("at") + 1, step).alias("label"),
                     _node(F.col("back"), F.col("w"), F.col("at") + step).alias("to"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of ``words`` (word, n; distinct words) at exactly
    one edit, once."""
    places = materialise(trie(words), "trie")
    letters = places.select("node", F.col("letter").alias("other"), "child").distinct()
    edges = materialise(places.select("node", "label", F.col("to").alias("child")).distinct(), "trie-edges")
    ends = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"),
                        F.explode(F.array(F.xxhash64(F.lit(False), F.col("word")),
                                          F.xxhash64(F.lit(True), F.reverse("word")))).alias("node"))
    left_out = places.where("first").select("word", "n", "node", "rest")
    replaced = (places.select("word", "n", "node", "letter", "rest").join(letters, "node")
                .where(F.col("other") > F.col("letter")).select("word", "n", F.col("child").alias("node"), "rest"))
    states = materialise(left_out.unionByName(replaced), "frontier-0")
    longest = states.agg(F.max(F.char_length("rest"))).first()[0] or 0
    links = [_ended(states, ends)]
    for level in range(1, int(longest).bit_length() + 1):
        step = _stride(F.char_length("rest"))
        moving = states.where(F.col("rest") != "").select(
            "word", "n", "node", F.substring("rest", F.lit(1), step).alias("label"), _from(F.col("rest"), step).alias("rest"))
        states = materialise(moving.join(edges, ["node", "label"]).select("word", "n", F.col("child").alias("node"), "rest"),
                             f"frontier-{level}")
        links.append(_ended(states, ends))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def _ended(states: DataFrame, ends: DataFrame) -> DataFrame:
    """Links of the states that have no letters left."""
    return (states.where(F.col("rest") == "").select("word", "n", "node").join(ends, "node")
            .where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n"))


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of ``words`` (word, n; distinct words)."""
    words = materialise(words, "words")
    once = materialise(near_words(words), "near-words")
    links = once.unionByName(once.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                         F.col("word").alias("near"), F.col("n").alias("near_n")))
    near = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"))
    # the most frequent near word is frequent enough if any is
    forms = (links.where(F.col("near_n") >= F.lit(factor) * F.col("n"))
             .groupBy("word").agg(F.min(F.struct((-F.col("near_n")).alias("key"), "near")).alias("best"))
             .select("word", F.col("best.near").alias("form"), (-F.col("best.key")).alias("form_n")))
    forms = materialise(forms, "forms")
    return (words.join(near, "word", "left").join(forms, "word", "left")
            .join(_roots(forms, factor), "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n",
                    F.coalesce("root", "word").alias("root")))


def _roots(forms: DataFrame, factor: int) -> DataFrame:
    """(word, root) for every word with a form: each round doubles the steps taken."""
    longest = math.ceil(63 / math.log2(factor)) if factor > 1 else None
    if longest is None:
        raise ValueError("forms must be more frequent than their words")
    up = forms.select("word", F.col("form").alias("root"))
    for k in range(longest.bit_length()):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = materialise(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")),
                         f"roots-{k}")
    return up
