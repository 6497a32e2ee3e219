"""Spelling variants by a dictionary of trie-node pairs.

The vocabulary is sorted forwards and, reversed, backwards.  A task walks its part of a sorted list and numbers the nodes
of the trie: a word shares the nodes of the prefix that it has in common with the word before, and gets new ones for the
rest.  Where a prefix goes on from one part to the next, the later numbers are replaced by the earlier ones; that takes the
first and last word of each part.  So equal prefixes (and suffixes) have equal integers, and no prefix is ever written out.

A word of L letters has L + 1 pairs (prefix node, suffix node) that meet at a position, and L pairs that skip a letter.
Words whose skipping pairs agree differ by one replaced letter; a skipping pair that agrees with a meeting pair is a
deleted or, seen from the other side, an inserted letter.  A pair determines all letters but one, so a group holds at most
one word for each letter of the alphabet and one without, and each member sees the others in it; no pairs of words are
emitted.  Only the last of a run of equal letters counts as the deleted one, so that no neighbour is counted twice.

Defined results: a null or empty text has no words.  A null ``doc_id`` is the empty id in the hash that drops letters.  Rows
that repeat count each time.  An empty table gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltide.llm.common import pieces_of, staged, staged_at, workers_import
from celltide.storage import delete_path

LEAST_LETTERS, LEAST_COUNT, RATIO, DROP_ONE_IN = 6, 5, 5, 199
#: Distinct words that a task counts before it passes them on, and pairs that it emits at a time.
HELD, STEP = 1 << 17, 1 << 16


def _word_counts(least: int, drop_one_in: int):
    """(word, n) of a task's texts, combined as far as ``HELD`` allows."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def out(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for rows, values in pieces_of(batch, "text"):
                for doc_id, value in zip(rows.column("doc_id").to_pylist(), values):
                    begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for m in runs.finditer(value.as_py().lower().decode()):  # lower() of bytes: A-Z only
                        word = m.group()
                        if drop_one_in:
                            h = zlib.crc32(word.encode(), begin)
                            if h % drop_one_in == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1:]
                        counts[word] = counts.get(word, 0) + 1
                    if len(counts) >= HELD:
                        yield out(counts)
                        counts = {}
        yield out(counts)

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, word, n, part, nodes): the trie node of each prefix of each word, from the empty one on.

    Words come sorted; ``place`` is the partition's number << 33 and the row's place in it.
    """
    before, nodes, used = "", [], 0
    for batch in batches:
        own = []
        for word, place in zip(batch.column("word").to_pylist(), batch.column("place").to_pylist()):
            part = place >> 33 << 33
            shared = len(commonprefix((before, word))) + 1 if nodes else 0
            nodes = nodes[:shared] + list(range(part + used, part + used + len(word) + 1 - shared))
            used += len(word) + 1 - shared
            before = word
            own.append(nodes)
        parts = pa.array([p >> 33 for p in batch.column("place").to_pylist()], pa.int64())
        yield pa.record_batch([batch.column("id"), batch.column("word"), batch.column("n"), parts, pa.array(own, pa.list_(pa.int64()))],
                              names=["id", "word", "n", "part", "nodes"])


def _trie(words: DataFrame, kind: str) -> tuple[DataFrame, dict[int, int], str]:
    """The nodes of sorted ``words`` (``id``, ``word``, ``n``), which numbers to replace by which, and the table's folder."""
    sorted_words = words.repartitionByRange("word").sortWithinPartitions("word").withColumn("place", F.monotonically_increasing_id())
    id_ = F.coalesce("id", "place") if "id" in words.columns else F.col("place")
    numbered, path = staged_at(sorted_words.withColumn("id", id_).mapInArrow(_numbered, "id long, word string, n long, part long, nodes array<long>"), kind)
    edge = F.struct("word", "nodes")
    parts = numbered.groupBy("part").agg(F.min_by(edge, "word").alias("first"), F.max_by(edge, "word").alias("last")).orderBy("part")
    replaced: dict[int, int] = {}
    before = None
    for row in parts.toLocalIterator():  # one row for each partition of the sort
        if before is not None:
            shared = len(commonprefix((before.word, row.first.word))) + 1
            replaced |= {b: replaced.get(a, a) for a, b in zip(before.nodes[:shared], row.first.nodes[:shared])}
        before = row.last
    return numbered, replaced, path


def _pairs(sent):
    """(p, s, id, n, kind): ``kind`` 0 for pairs that meet, 1 for pairs that skip a letter, 2 if the next letter is the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forward, backward = sent.value

        def out(found: list[tuple]) -> pa.RecordBatch:
            sizes = [len(x[0]) for x in found]
            columns = [np.concatenate([x[i] for x in found]) for i in range(3)]
            ids, counts = (pa.array(np.repeat([x[i] for x in found], sizes)) for i in (3, 4))
            return pa.record_batch([pa.array(columns[0]), pa.array(columns[1]), ids, counts, pa.array(columns[2])], names=["p", "s", "id", "n", "kind"])

        found, held = [], 0
        for batch in batches:
            for id_, word, n, nodes, reverse in zip(*(batch.column(c).to_pylist() for c in ("id", "word", "n", "nodes", "reverse"))):
                p = np.array([forward.get(x, x) for x in nodes])
                s = np.array([backward.get(x, x) for x in reverse])[::-1]
                letters = np.frombuffer(word.encode("utf-32-le"), np.uint32)
                kind = np.ones(2 * len(letters) + 1, np.int32)
                kind[:len(p)] = 0
                kind[len(p):-1][letters[1:] == letters[:-1]] = 2
                found.append((np.concatenate((p, p[:-1])), np.concatenate((s, s[1:])), kind, id_, n))
                held += len(kind)
                if held >= STEP:
                    yield out(found)
                    found, held = [], 0
        if found:
            yield out(found)

    return run


#: What a member x of a group sees of the others, largest count first.
_NEAR = """filter(members, y -> y.id != x.id AND CASE x.kind WHEN 0 THEN y.kind = 1 WHEN 1 THEN true ELSE y.kind != 0 END)"""


def _neighbours(words: DataFrame, forward: tuple, backward: tuple) -> DataFrame:
    """(id, n_near, best): the number of near words, and the one of largest count as (-n, id)."""
    sent = words.sparkSession.sparkContext.broadcast((forward[1], backward[1]))
    both = forward[0].select("id", "word", "n", "nodes").join(backward[0].select("id", F.col("nodes").alias("reverse")), "id")
    pairs = both.mapInArrow(_pairs(sent), "p long, s long, id long, n long, kind int")
    groups = pairs.groupBy("p", "s").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("neg"), "id", "kind"))).alias("members"))
    seen = groups.filter("size(members) > 1").select("members", F.explode("members").alias("x")).select("x.id", F.expr(_NEAR).alias("near"))
    return seen.filter("size(near) > 0").groupBy("id").agg(F.sum(F.size("near")).alias("n_near"), F.min(F.col("near")[0]).alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """(id, root) from (id, to): where each chain ends; each round doubles the steps taken.

    Chains have no cycles and at most a few dozen steps, as a form's count is ``RATIO`` times the word's.
    """
    at, path = staged_at(links, "roots")
    while True:
        further = at.select(F.col("id").alias("to"), F.col("to").alias("far"))
        after, path_after = staged_at(at.join(further, "to", "left").select("id", F.coalesce("far", "to").alias("to"), F.col("far").isNotNull().alias("moved")), "roots")
        delete_path(links.sparkSession, path)
        if after.filter("moved").isEmpty():
            return after.select("id", F.col("to").alias("root"))
        at, path = after.drop("moved"), path_after


def spelling_variants(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, ratio: int = RATIO, drop_one_in: int = 0) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of ``docs`` (``doc_id``, ``text``).

    Words are runs of Latin letters (A-Z as a-z, and U+00C0 to U+00FF) with ``least_letters`` letters and ``least_count``
    occurrences or more.  ``n_near`` counts the words that differ by one inserted, deleted or replaced letter; ``form`` is the most
    frequent of them (ties to the smaller word) if it occurs ``ratio`` times as often; ``root`` follows forms to the last.
    ``drop_one_in`` drops a letter of about one run in so many, chosen by the CRC-32 of ``doc_id:run``, as a made-up typist.
    """
    if ratio < 2:
        raise ValueError(f"ratio is 2 or more, not {ratio}")  # else forms could go round
    spark = docs.sparkSession
    workers_import(spark)
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = table.mapInArrow(_word_counts(least_letters, drop_one_in), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # sorting samples its input, so the counts are written first
    vocabulary, path = staged_at(counts.filter((F.col("n") >= least_count) & (F.length("word") >= least_letters)), "vocabulary")
    forward = _trie(vocabulary, "forward-trie")
    words = forward[0].select("id", "word", "n")  # ids follow the words' order
    backward = _trie(words.withColumn("word", F.reverse("word")), "backward-trie")
    near = staged(_neighbours(words, forward, backward), "neighbours")
    for used in (path, backward[2]):
        delete_path(spark, used)

    known = words.join(near, "id", "left").select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                                  F.when(-F.col("best.neg") >= ratio * F.col("n"), F.col("best")).alias("form"))
    roots = _roots(known.filter("form is not null").select("id", F.col("form.id").alias("to")))
    name = lambda c: words.select(F.col("id").alias(c), F.col("word").alias(f"{c}_word"))
    out = known.withColumn("form_n", -F.col("form.neg")).withColumn("form", F.col("form.id")).join(roots, "id", "left").join(name("form"), "form", "left").join(name("root"), "root", "left")
    return out.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
