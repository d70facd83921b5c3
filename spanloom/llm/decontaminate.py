"""Benchmark decontamination: word n-grams of the test items lead to passages of the corpus, and a local alignment of
passage and item tells copies, also edited ones, from chance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing

SEED_WORDS = 3
# Alignment: points for equal words, and what a different or a missing word costs. A passage counts from this share of
# the points that the whole item would give, or from the points of so many words copied in a row, whichever is less.
MATCH, OTHER, GAP = 2, 1, 1
LEAST_SHARE = 0.5
LEAST_WORDS = 13
# Benchmark words that are held in memory at a time; a larger benchmark is taken in as many rounds as it needs.
WORDS_PER_ROUND = 2_000_000

_U = np.uint64
_FOUND = "doc_id bigint, item_id bigint, score double, start bigint, `end` bigint, passage string"


@dataclass
class Items:
    """Test items: their words, and their seeds as sorted hashes with the item and the place of each."""

    ids: list[int]
    words: list[np.ndarray]
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, ids: list[int], words: list[np.ndarray]) -> Items:
        parts = [hashing.ngrams(w, min(SEED_WORDS, len(w))) for w in words]
        seeds = np.concatenate([np.zeros(0, _U), *parts])
        item = np.repeat(np.arange(len(ids)), [len(p) for p in parts])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(p)) for p in parts]])
        order = np.argsort(seeds, kind="stable")
        return cls(ids, words, seeds[order], item[order], place[order])

    def lengths(self) -> list[int]:
        """The seed lengths in use: items of fewer words are one seed."""
        return sorted({min(SEED_WORDS, len(w)) for w in self.words})


def _texts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per text, in lower case, its words and the bytes where they start and end."""
    data, offsets = hashing.text_bytes(column)
    for first, last in hashing.blocks(offsets):
        hashed, at, starts, ends = hashing.words(data, offsets[first : last + 1], hashing.LETTERS_DIGITS)
        for row, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
            base = offsets[first + row]
            yield hashed[a:b], starts[a:b] - base, ends[a:b] - base


def _lower(column: pa.Array) -> pa.Array:
    """Letter by letter, so that places in code points stay."""
    return pc.utf8_lower(column)


def least_points(length: int) -> float:
    """The points from which a passage counts as a copy of an item of so many words, or of a part of it."""
    return MATCH * min(LEAST_SHARE * length, LEAST_WORDS)


def align(words: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: the best local score of `item` in `words`, and where the item and the passage end."""
    step = GAP * np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(item):
        diagonal = row[:-1] + np.where(words == word, MATCH, -OTHER)
        new = np.maximum(0, row - GAP)
        new[1:] = np.maximum(new[1:], diagonal)
        # A gap in the item costs GAP for each word skipped: a running maximum along the row.
        row = np.maximum(new, np.maximum.accumulate(new + step) - step)
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (int(row[top]), i + 1, top)
    return best


def _stretches(hashed: np.ndarray, items: Items) -> Iterator[tuple[int, int, int]]:
    """(item, first word, last word) of stretches around seeds, however common these are, that hold enough of the item's words
    for a copy. Stretches of an item do not overlap."""
    rows, places = [], []
    for n in items.lengths():
        grams = hashing.ngrams(hashed, n)
        low = np.searchsorted(items.seeds, grams, "left")
        hit = np.flatnonzero((low < len(items.seeds)) & (items.seeds[np.minimum(low, len(items.seeds) - 1)] == grams)) if len(items.seeds) else np.zeros(0, int)
        if len(hit):
            high = np.searchsorted(items.seeds, grams[hit], "right")
            many = high - low[hit]
            places.append(np.repeat(hit, many))
            rows.append(np.repeat(low[hit], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
    if not rows:
        return
    row, at = np.concatenate(rows), np.concatenate(places)
    item, start = items.item[row], at - items.place[row]
    order = np.lexsort((start, item))
    item, start = item[order], start[order]
    lengths = np.asarray([len(w) for w in items.words])
    new = np.concatenate([[True], (item[1:] != item[:-1]) | (np.diff(start) > np.maximum(lengths[item[1:]] // 2, 1))])
    cut = np.append(np.flatnonzero(new), len(item))
    open_: tuple[int, int, int] | None = None
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        i, n = int(item[a]), int(lengths[item[a]])
        # A different or skipped word costs a point, so a passage that counts holds at most `beside` words not the item's own.
        beside = int(MATCH * n - least_points(n))
        first, last = max(0, int(start[a]) - beside), min(len(hashed), int(start[b - 1]) + n + beside)
        if MATCH * np.isin(items.words[i], hashed[first:last]).sum() < least_points(n):
            continue
        if open_ and open_[0] == i and first < open_[2]:
            open_ = i, open_[1], max(open_[2], last)
        else:
            if open_:
                yield open_
            open_ = i, first, last
    if open_:
        yield open_


def copies(words: np.ndarray, item: np.ndarray) -> list[tuple[int, int, int]]:
    """(points, first word, end) of the passages of `words` that are copies of `item` or of enough of it: the best one, then
    the best ones of what is before and after it, and so on."""
    found, left = [], [(0, len(words))]
    while left:
        first, last = left.pop()
        points, item_end, end = align(words[first:last], item)
        if points < least_points(len(item)):
            continue
        # The same alignment read backwards ends where the passage begins.
        _, _, back = align(words[first : first + end][::-1], item[:item_end][::-1])
        begin, end = first + end - back, first + end
        found.append((points, begin, end))
        left += [(first, begin), (end, last)]
    return sorted(found, key=lambda x: x[1])


def _benchmark(benchmark: DataFrame) -> Iterator[Items]:
    """The test items in rounds of at most WORDS_PER_ROUND words; null and wordless items are left out."""
    ids, words, size = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("bigint").alias("i"), "text").where("i IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        (own, _, _), = _texts(_lower(pa.array([row.text])))
        if len(own):
            ids.append(row.i)
            words.append(own)
            size += len(own)
        if size >= WORDS_PER_ROUND:
            yield Items.of(ids, words)
            ids, words, size = [], [], 0
    if ids:
        yield Items.of(ids, words)


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, start, end, passage): the passages of `docs` (doc_id, text) that are copies of test items of
    `benchmark` (item_id, text), or of a part of them: per document row and item the best one and all that do not overlap a
    better one.

    Seeds are hashes of SEED_WORDS words of letters and digits, without case. Every stretch that shares one with an item and
    has words enough is aligned word by word, however often the seed occurs; a passage that shares none is not found. `score`
    is the alignment's points as a share of a whole perfect copy's. A passage counts from LEAST_SHARE of them on, or from the
    points of LEAST_WORDS words in a row. `start` and `end` are code points.

    The one pass over the texts is map-only; a round's items (at most WORDS_PER_ROUND words) are broadcast. Null and empty
    texts contain nothing; items of one or two words are one seed; an item_id that repeats is reported for each of its
    texts; rows of a repeated or null doc_id are reported row by row; an empty table on either side gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = [_round(texts, items) for items in _benchmark(benchmark)]
    out = docs.sparkSession.createDataFrame([], _FOUND)
    for part in found:
        out = part if len(found) == 1 else out.union(part)
    return out


def _round(texts: DataFrame, items: Items) -> DataFrame:
    context = texts.sparkSession.sparkContext
    every = context.broadcast(items)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = every.value
        for batch in batches:
            found = []
            lower = _lower(batch.column(1))
            for row, (hashed, starts, ends) in enumerate(_texts(lower)):
                passages = [
                    (own.ids[i], points / (MATCH * len(own.words[i])), int(starts[first + begin]), int(ends[first + end - 1]))
                    for i, first, last in _stretches(hashed, own)
                    for points, begin, end in copies(hashed[first:last], own.words[i])
                ]
                if passages:
                    raw, text = lower[row].as_py().encode(), batch.column(1)[row].as_py()
                    for item, share, start, end in passages:
                        start, end = (len(raw[:at].decode()) for at in (start, end))
                        found.append((row, item, share, start, end, text[start:end]))
            rows, *rest = zip(*found, strict=True) if found else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(v, t) for v, t in zip(rest, (pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.string()), strict=True)]],
                names=["doc_id", "item_id", "score", "start", "end", "passage"],
            )

    return texts.mapInArrow(search, _FOUND)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` without a copy of a test item, with all their columns. Rows that share a doc_id go together;
    rows without doc_id stay."""
    leaked = contaminations(docs, benchmark).select(F.col("doc_id").alias("leaked_id")).where("leaked_id IS NOT NULL").distinct()
    return docs.join(leaked, docs["doc_id"].cast("bigint") == leaked["leaked_id"], "left_anti")
