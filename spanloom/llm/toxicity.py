"""Toxicity by two language models: one of toxic, one of ordinary documents. A document's score says how much likelier
its words are, one by one, under the toxic model.

Both are Kneser-Ney models over words and bigrams. A class's counts are discounted and fall back on the counts of the same
expression in both classes together, which weigh more than its own; those fall back on the number of contexts that a word
has. Every word and bigram of the labelled texts is in the models, however seldom it was seen.

Beside them stand the beginnings of words. Inflected and compound forms that the labelled texts do not have, or have once, are
known by what they begin with: a beginning's ratio is that of the shares of both classes' texts that hold it.

Counts and models are tables that grow with the labelled texts. What scoring looks up is one number an entry, the log of
the two models' ratio, taken in rounds of words whose size is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_scratch, remove_scratch
from . import hashing
from .common import limited, written

# A word is a hash of WORD_BITS bits, a bigram the word's and that of the word before. Three numbers are no words: START
# stands before a text's first word, ALONE marks a word's own entry in the model, BEGINS that of a word's beginning.
WORD_BITS = 31
ALONE, START, BEGINS = 0, 1, 2
# Letters of a beginning, and the texts, of both classes as they are, by which the counts of its texts are smoothed. Chosen on the
# calibration fold.
BEGINNING = 4
SMOOTHED_BY = 20.0
DISCOUNT = 0.75
# The weight of what a model falls back on, for each unit of its own counts. A large one leaves ordinary words, whose
# counts differ by chance, near a ratio of 1, and still lets through words that are many times likelier in one class.
SHARED_WEIGHT = 100.0
# Words or different bigrams that a counting task holds before it hands them on.
HELD_COUNTS = 2_000_000
# Model entries (12 bytes each) that are broadcast at a time, in parts that pass the driver one by one; a larger model takes as
# many rounds over the texts as it needs.
ENTRIES_PER_ROUND = 8_000_000
PARTS_PER_ROUND = 8
# Labelled rows are dealt to five folds by the CRC of doc_id: 0 is held out, 1 calibrates the score, 2 to 4 are counted.
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
# At most so many rows fit the four numbers of the calibration, those with the smallest hashes of doc_id.
CALIBRATION_ROWS = 50_000
TOXIC, ORDINARY = 1, 0

_U = np.uint64


def fold(doc_id: str = "doc_id") -> str:
    return f"CAST(crc32(CAST(coalesce(CAST({doc_id} AS STRING), '') AS BINARY)) % {FOLDS} AS INT)"


def _number(hashed: np.ndarray) -> np.ndarray:
    return hashed % _U((1 << WORD_BITS) - 1 - BEGINS) + _U(BEGINS + 1)


def _bigrams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block of texts, its word numbers, the word number before each, the number of each word's beginning, and the n + 1
    word offsets of the texts."""
    data, offsets = hashing.text_bytes(pc.utf8_lower(column))
    for first, last in hashing.blocks(offsets):
        hashed, at, starts, ends = hashing.words(data, offsets[first : last + 1], hashing.LETTERS)
        own = _number(hashed)
        before = np.concatenate([np.full(min(len(own), 1), START, _U), own[:-1]])
        before[at[:-1][at[:-1] < len(own)]] = START
        yield own, before, _number(hashing.beginnings(data, starts, ends, BEGINNING, hashing.LETTERS)), at


def _pairs(own: np.ndarray, before: np.ndarray) -> np.ndarray:
    return (own << _U(WORD_BITS)) | before


def _sum_by(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count_bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) to (pair, ordinary, toxic): how often each bigram occurs, summed over what a task holds. A pair with
    BEGINS counts the texts that have a word with this beginning; that of ALONE and BEGINS counts all texts."""

    def handed(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        toxic = (keys & _U(1)).astype(np.int64)
        columns = [(keys >> _U(1)).astype(np.int64), counts * (1 - toxic), counts * toxic]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["pair", "ordinary", "toxic"])

    keys, counts, new, size = np.zeros(0, _U), np.zeros(0, np.int64), [], 0
    for batch in batches:
        toxic, row = batch.column(1).to_numpy(zero_copy_only=False).astype(_U), 0
        for own, before, begins, at in _bigrams(batch.column(0)):
            many = np.diff(at)
            labels = toxic[row : row + len(many)]
            row += len(many)
            held = np.unique((np.repeat(np.arange(len(many), dtype=_U), many) << _U(WORD_BITS)) | begins)
            begun = _pairs(held & _U((1 << WORD_BITS) - 1), np.full(1, BEGINS, _U))
            texts = _pairs(np.full(len(many), ALONE, _U), np.full(1, BEGINS, _U))
            new += [
                (_pairs(own, before) << _U(1)) | np.repeat(labels, many),
                (begun << _U(1)) | labels[(held >> _U(WORD_BITS)).astype(np.int64)],
                (texts << _U(1)) | labels,
            ]
            size += len(own) + len(begun) + len(texts)
            if size > HELD_COUNTS:
                keys, counts = _sum_by(np.concatenate([keys, *new]), np.concatenate([counts, np.ones(size, np.int64)]))
                new, size = [], 0
                if len(keys) > HELD_COUNTS:
                    yield handed(keys, counts)
                    keys, counts = keys[:0], counts[:0]
    keys, counts = _sum_by(np.concatenate([keys, *new]), np.concatenate([counts, np.ones(size, np.int64)]))
    if len(keys):
        yield handed(keys, counts)


def train(labelled: DataFrame) -> DataFrame:
    """(entry, ratio): log P(toxic) - log P(ordinary) of each word, of each bigram and of each word's beginning of `labelled`
    (text, toxic 0 or 1), all of whose rows are counted.

    Tasks count their own bigrams first, so a frequent one is a row a task in the shuffle. No table reaches the driver.
    """
    counted = labelled.select("text", F.col("toxic").cast("int")).mapInArrow(_count_bigrams, "pair bigint, ordinary bigint, toxic bigint")
    with _shuffles_removed(labelled.sparkSession):
        pairs, pairs_at = _stored(counted.groupBy("pair").agg(F.sum("ordinary").alias("n0"), F.sum("toxic").alias("n1")), "toxicity-bigrams")
        # The pair itself is left behind: together with its two words it would go through the joins twice.
        pairs = pairs.selectExpr(f"CAST(shiftright(pair, {WORD_BITS}) AS INT) AS word", f"CAST(pair & {(1 << WORD_BITS) - 1}L AS INT) AS before", "n0", "n1")
        begun, pairs = pairs.where(f"before = {BEGINS}"), pairs.where(f"before <> {BEGINS}")
        beginnings = written(_beginnings(begun), "toxicity-beginnings")
        words, words_at = _stored(pairs.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.count("*").alias("contexts")), "toxicity-words")
        unigrams = written(_unigrams(words), "toxicity-unigrams")
        contexts = pairs.groupBy("before").agg(
            F.sum("n0").alias("total0"), F.sum("n1").alias("total1"), F.count_if(F.col("n0") > 0).alias("types0"), F.count_if(F.col("n1") > 0).alias("types1")
        )
        # One join at a time: the shuffles of the first are gone when those of the second begin.
        known, known_at = _stored(pairs.join(contexts, "before"), "toxicity-contexts")
        remove_scratch(labelled.sparkSession, pairs_at)
        ratio = f"ln({_after(TOXIC)}) - ln({_after(ORDINARY)})"
        entries = known.join(unigrams, "word").selectExpr(f"{_entry('before')} AS entry", f"CAST({ratio} AS FLOAT) AS ratio")
        alone = unigrams.selectExpr(f"{_entry(ALONE)} AS entry", "CAST(ln(p1) - ln(p0) AS FLOAT) AS ratio")
        model = written(alone.union(entries).union(beginnings), "toxicity-model")
        for path in (words_at, known_at):
            remove_scratch(labelled.sparkSession, path)
    return model


def _stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A table that several steps read and that is removed after them: written, read again, and its path."""
    path = new_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Let each query remove its shuffle files when it ends, instead of whenever the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _entry(before: str | int) -> str:
    return f"(shiftleft(CAST(word AS BIGINT), {WORD_BITS}) + {before})"


def _unigrams(words: DataFrame) -> DataFrame:
    """(word, p0, p1): both classes' probabilities, from their counts and from the contexts in both together."""

    def kept(n: str) -> str:
        return f"greatest({n} - {DISCOUNT}D, 0D)"

    sums = words.selectExpr(
        "sum(contexts) AS all_contexts", *[f"sum({n}) AS t{i}" for i, n in enumerate(("n0", "n1", "n0 + n1"))],
        *[f"sum({kept(n)}) AS k{i}" for i, n in enumerate(("n0", "n1", "n0 + n1"))],
    ).first().asDict()
    number = {name: float(value or 0) for name, value in sums.items()}
    shared = f"({kept('n0 + n1')} + {number['t2'] - number['k2']!r}D * contexts / {number['all_contexts']!r}D) / {number['t2']!r}D"

    def own(c: int) -> str:
        total, left = number[f"t{c}"], number[f"t{c}"] - number[f"k{c}"]
        if not total:
            return "shared"
        return f"({kept(f'n{c}')} + {left + SHARED_WEIGHT * total!r}D * shared) / {(1 + SHARED_WEIGHT) * total!r}D"

    return words.selectExpr("*", f"{shared} AS shared").selectExpr("word", f"{own(ORDINARY)} AS p0", f"{own(TOXIC)} AS p1")


def _beginnings(begun: DataFrame) -> DataFrame:
    """(entry, ratio) of the beginnings `begun` (word, before, n0, n1), from the texts of each class that have them."""
    texts = begun.where(f"word = {ALONE}").select("n0", "n1").first() or (0, 0)
    if not all(texts):
        return begun.selectExpr(f"{_entry(BEGINS)} AS entry", "CAST(0 AS FLOAT) AS ratio").limit(0)

    def share(c: int) -> str:
        return f"((n{c} / {float(texts[c])!r}D) + {SMOOTHED_BY / sum(texts)!r}D)"

    return begun.where(f"word <> {ALONE}").selectExpr(f"{_entry(BEGINS)} AS entry", f"CAST(ln({share(TOXIC)}) - ln({share(ORDINARY)}) AS FLOAT) AS ratio")


def _after(c: int) -> str:
    """SQL for P(word | word before, class): the class's bigrams, then those of both classes, then the class's words.
    Where the class has not seen the word before, its words alone tell."""
    own = f"CASE WHEN total{c} > 0 THEN (greatest(n{c} - {DISCOUNT}D, 0D) + {DISCOUNT}D * types{c} * p{c}) / total{c} ELSE p{c} END"
    return f"(({own}) + {SHARED_WEIGHT}D * (n0 + n1) / (total0 + total1)) / {1 + SHARED_WEIGHT}D"


def _found(entries: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of `wanted` are in the ascending `entries`, and where."""
    if not len(entries):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(entries, wanted), len(entries) - 1)
    hit = np.flatnonzero(entries[at] == wanted)
    return hit, at[hit]


def _log_ratios(column: pa.Array, parts: list[tuple[int, int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text, the sum over its words of the bigram's ratio, or else the word's, or else 0; the largest of these, 0 at
    least; the largest ratio of its words' beginnings, 0 at least; and the number of words. A part is the model of the words and
    beginnings from a first to before a last one."""
    sums, tops, begun, words = [np.zeros(0)], [np.zeros(0)], [np.zeros(0)], [np.zeros(0, np.int64)]
    for own, before, begins, at in _bigrams(column):
        ratio, start = np.zeros(len(own)), np.zeros(len(own))
        for first, last, entries, ratios in parts:
            here = np.flatnonzero((begins >= _U(first)) & (begins < _U(last)))
            hit, where = _found(entries, _pairs(begins[here], np.full(1, BEGINS, _U)))
            start[here[hit]] = ratios[where]
            here = np.flatnonzero((own >= _U(first)) & (own < _U(last)))
            for wanted in (_pairs(own[here], np.full(1, ALONE, _U)), _pairs(own[here], before[here])):
                hit, where = _found(entries, wanted)
                ratio[here[hit]] = ratios[where]
        many = np.diff(at)
        text = np.repeat(np.arange(len(many)), many)
        sums.append(np.bincount(text, ratio, len(many)))
        for each, largest in ((ratio, tops), (start, begun)):
            top = np.zeros(len(many))
            np.maximum.at(top, text, each)
            largest.append(top)
        words.append(many)
    return np.concatenate(sums), np.concatenate(tops), np.concatenate(begun), np.concatenate(words)


def _parts(model: DataFrame, first: int, last: int, n: int) -> list:
    """The model of the words from `first` to before `last` as n broadcasts (first word, last word, entries, ratios); one part
    at a time is on the driver."""
    shared = []
    for p in range(n):
        low, high = first + (last - first) * p // n, first + (last - first) * (p + 1) // n
        part = model.where(f"entry >= {low << WORD_BITS}L AND entry < {high << WORD_BITS}L").toArrow()
        entries, ratio = part.column("entry").to_numpy().astype(_U), part.column("ratio").to_numpy()
        order = np.argsort(entries)
        shared.append(model.sparkSession.sparkContext.broadcast((low, high, entries[order], ratio[order])))
        # Arrow keeps what it has freed, and the driver would hold a part's memory until its end.
        del part, entries, ratio, order
        pa.default_memory_pool().release_unused()
    return shared


def ratios(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, ratio, strongest, beginning, words): the length-normalised log-likelihood ratio of each text, and the largest
    log ratios of its words and of their beginnings.

    The model is taken in rounds of about ENTRIES_PER_ROUND entries, each a range of word numbers, which are hashes and so
    evenly spread. A round is map-only over the texts as they are stored and writes its share of each text's sum. Several
    rounds are added up by doc_id and text digest; equal rows, which have equal sums, are counted and dealt out again.
    """
    rounds = max(1, -(-model.count() // ENTRIES_PER_ROUND))
    shares = []
    for r in range(rounds):
        shared = _parts(model, (r << WORD_BITS) // rounds, ((r + 1) << WORD_BITS) // rounds, PARTS_PER_ROUND)

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            parts = [s.value for s in shared]
            for batch in batches:
                columns = [batch.column(0), batch.column(2), *map(pa.array, _log_ratios(batch.column(1), parts))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "total", "strongest", "beginning", "words"])

        digest = "sha2(text, 256)" if rounds > 1 else "''"
        rows = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text", f"coalesce({digest}, '') AS digest")
        shares.append(written(rows.mapInArrow(score, "doc_id bigint, digest string, total double, strongest double, beginning double, words bigint"), "toxicity-sums"))
        for s in shared:
            s.destroy()
    scored = shares[0]
    if rounds > 1:
        for share in shares[1:]:
            scored = scored.union(share)
        added = scored.groupBy("doc_id", "digest", "words").agg(F.expr(f"count(*) div {rounds}").alias("copies"), F.sum("total").alias("total"), F.max("strongest").alias("strongest"), F.max("beginning").alias("beginning"))
        scored = written(added.selectExpr("doc_id", "total / copies AS total", "strongest", "beginning", "words", "explode(sequence(1L, copies)) AS copy"), "toxicity-ratios")
    return scored.selectExpr("doc_id", "CASE WHEN words > 0 THEN total / words ELSE 0D END AS ratio", "strongest", "beginning", "words")


def _calibrated(inputs: list[np.ndarray], toxic: np.ndarray) -> tuple[float, ...]:
    """Intercept and slopes of a logistic regression of the label on the inputs, held slightly towards 0 and 1."""
    spread = np.array([1.0, *[float(np.std(v)) or 1.0 for v in inputs]])
    x = np.stack([np.ones(len(toxic)), *inputs], 1) / spread
    prior = np.array([0.0, *[0.5] * len(inputs)])

    def loss(w: np.ndarray) -> float:
        return float(np.sum(np.logaddexp(0, x @ w) - toxic * (x @ w)) + 0.005 * np.sum((w - prior) ** 2))

    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - toxic) + 0.01 * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w)), gradient)
        # A step that goes too far is halved.
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-8:
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w / spread)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, ratio) of `docs` (doc_id, text), learnt from `labels` (doc_id, toxic).

    The score is calibrated on a fold that the models have not counted, from the ratio, its strength and the strongest
    word's and beginning's ratios. The strength is the ratio times the root of the number of words: chance alone gives short texts larger
    ratios. The strongest word tells a text in which one expression gives the class away, the strongest beginning one whose
    telling words have forms that were not seen before.

    Labels of the held-out fold are never read, and a label is never an input of a score. Labels that are null or name no
    document are ignored; a doc_id with several labels counts with each. Null and empty texts and texts without letters
    have ratio 0. Without any label all scores are 0.5 or near it. Each row of a repeated doc_id gets its own score; a
    null doc_id counts as an empty text in the choice of fold. Other columns are ignored; an empty table gives no rows.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("labelled_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(f"toxic IN (0, 1) AND {fold('labelled_id')} <> {HELD_OUT}").withColumn("fold", F.expr(fold("labelled_id")))
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    counted = known.where(f"fold <> {CALIBRATION}")
    model = train(texts.where(f"{fold()} NOT IN ({HELD_OUT}, {CALIBRATION})").join(limited(counted), F.col("doc_id") == F.col("labelled_id")))
    scored = ratios(texts, model)
    sample = scored.join(known.where(f"fold = {CALIBRATION}"), F.col("doc_id") == F.col("labelled_id"))
    sample = sample.selectExpr("ratio", "ratio * sqrt(words) AS strength", "strongest", "beginning", "toxic", "xxhash64(doc_id) AS h", "doc_id")
    sample = sample.orderBy("h", "doc_id", "ratio", "strongest", "beginning", "toxic").limit(CALIBRATION_ROWS).toPandas()
    fitted = (0.0, 1.0, 0.0, 0.0, 0.0)
    if len(sample):
        fitted = _calibrated([sample[c].to_numpy(float) for c in ("ratio", "strength", "strongest", "beginning")], sample["toxic"].to_numpy(float))
    logit = "{!r}D + {!r}D * ratio + {!r}D * ratio * sqrt(words) + {!r}D * strongest + {!r}D * beginning".format(*fitted)
    return scored.selectExpr("doc_id", f"{fold()} = {HELD_OUT} AS held_out", f"1 / (1 + exp(-({logit}))) AS score", "ratio").selectExpr(
        "doc_id", "held_out", "score", "CAST(score >= 0.5 AS INT) AS predicted", "ratio"
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with all their columns. Of rows that share a doc_id all go if one
    is; rows without doc_id cannot be named by a verdict and stay."""
    rejected = scores(docs, labels).where("predicted = 1").select(F.col("doc_id").alias("rejected_id")).where("rejected_id IS NOT NULL").distinct()
    return docs.join(rejected, docs["doc_id"].cast("bigint") == rejected["rejected_id"], "left_anti")
