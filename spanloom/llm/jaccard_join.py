"""Near-duplicate documents: all pairs of word-shingle sets with a Jaccard similarity of at least 3/4, as components.

Adaptive multi-match prefixes. Shingles have one global order: those in few documents by hash, then the costly ones, which many
documents have, by frequency. Of two similar sets the first |r| - 3/4 |r| + l shingles of each (its l-prefix) share
at least l. Costly shingles come last, so each one that a prefix would have held lengthens it by a cheaper one; a document
that has any is expected to meet many candidates and takes EXTRA_MATCHES more, which its candidates have to share.

What the postings give is verified exactly: by sizes, by bitmaps that bound the overlap from above, then on the sets.
A shingle that still has a long list (documents made of common passages, large groups of near copies) gives no pairs.
Its documents are a family, each linked to one of them at first; pairs of a family that are not yet in one component are
compared in blocks, by bitmaps and then by sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import components, limited, whole_text, written

# Similar: OF times the intersection is at least PART times the union.
PART, OF = 75, 100
# Documents that a shingle may have before it counts as costly or its list as long.
LIST = 16
EXTRA_MATCHES = 3
# Costly shingles held by each task: of more, the most frequent ones.
COSTLY = 1 << 20
SHINGLES_PER_BUCKET = 1_000_000
# Sets, or bitmaps, of a family that are compared in one group, a side.
BLOCK = 256
BITMAP_BLOCK = 1024

_U = np.uint64
_CLASS = "doc_id bigint, n int, class bigint, bitmap binary"


def _class(tokens: np.ndarray) -> int:
    """A number for a set of shingles, the same for equal sets."""
    with np.errstate(over="ignore"):
        return int(hashing.mix(hashing.mix(tokens ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) + _U(len(tokens))).astype(np.int64))


def _bitmap(tokens: np.ndarray) -> bytes:
    """Which of about 2 n places hold an odd number of shingles."""
    size = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    return np.packbits(np.bincount((tokens & _U(size - 1)).astype(np.int64), minlength=size).astype(np.uint8) & 1, bitorder="little").tobytes()


def _may_be_similar(a: bytes, n_a: int, b: bytes, n_b: int) -> bool:
    """Whether sizes and bitmaps allow it: each odd place of one only is a shingle of one only."""
    x, y = (np.frombuffer(v, np.uint8) for v in ((a, b) if len(a) <= len(b) else (b, a)))
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    only_one = int(np.bitwise_count(x ^ y).sum())
    return _enough((n_a + n_b - only_one) // 2, n_a, n_b)


def _enough(shared: int, n_a: int, n_b: int) -> bool:
    return OF * shared >= PART * (n_a + n_b - shared)


def _prefix(n: int) -> int:
    """The length of a 1-prefix: what may be missing from a similar set, and one."""
    return n - -(-n * PART // OF) + 1


def classes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, n, class, bitmap): each document's set size, and a number that equal sets share."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, numbers, bitmaps = [], [], []
            for tokens in hashing.shingle_sets(batch.column(1)):
                sizes.append(len(tokens))
                numbers.append(_class(tokens))
                bitmaps.append(_bitmap(tokens) if len(tokens) else b"")
            columns = [batch.column(0), pa.array(sizes, pa.int32()), pa.array(numbers, pa.int64()), pa.array(bitmaps, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "class", "bitmap"])

    return docs.mapInArrow(describe, _CLASS)


def _new_sets(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Per batch, the sets that this task has not seen before, with their class."""
    seen: set[int] = set()
    for batch in batches:
        new = []
        for tokens in hashing.shingle_sets(batch.column(at)):
            if len(tokens) and (number := _class(tokens)) not in seen:
                seen.add(number)
                new.append((number, tokens))
        yield new


def _costly(texts: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle numbers (the first 32 + bits bits after the leading one) and in how many documents they are, if more than
    LIST; of more than COSTLY of them, those above a higher limit.

    Counted over all documents for the lower half of the hashes, where prefixes begin and, unless half of a document is
    costly, end. A shingle beyond counts as cheap.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for new in _new_sets(batches, 0):
            low = np.concatenate([np.zeros(0, _U), *[t[: np.searchsorted(t, _U(1 << 63))] for _, t in new]])
            low.sort()
            bucket = (low >> _U(63 - bits)).astype(np.int64)
            cut = np.flatnonzero(np.diff(bucket, prepend=-1))
            rest = (low >> _U(31 - bits)).astype("<u4")
            rows = [rest[a:b].tobytes() for a, b in zip(cut, np.append(cut, len(low))[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut].astype(np.int32)), pa.array(rows, pa.binary())], names=["bucket", "shingles"])

    def count(table: pa.Table) -> pa.Table:
        every = np.sort(np.concatenate([np.frombuffer(x, "<u4") for x in table.column("shingles").to_pylist()]))
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        many = np.diff(np.append(first, len(every)))
        kept = many > LIST
        number = (table.column("bucket")[0].as_py() << 32) + every[first[kept]].astype(np.int64)
        return pa.table({"shingle": pa.array(number, pa.int64()), "many": pa.array(many[kept], pa.int64())})

    dealt = texts.mapInArrow(deal, "bucket int, shingles binary")
    counted = written(dealt.groupBy("bucket").applyInArrow(count, "shingle bigint, many bigint"), "jaccard-costly")
    steps = [LIST << k for k in range(48)]
    above = counted.agg(*[F.count(F.when(F.col("many") > s, 1)).alias(f"s{s}") for s in steps]).first()
    limit = next(s for s, n in zip(steps, above, strict=True) if n <= COSTLY)
    rows = counted.where(F.col("many") > limit).toPandas().sort_values("shingle")
    return rows["shingle"].to_numpy(np.int64), rows["many"].to_numpy(np.int64)


def _chosen(tokens: np.ndarray, bits: int, costly: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """A set's prefix, and how many shingles more than one a similar set has to share in it."""
    numbers, many = costly
    cheap = np.ones(len(tokens), bool)
    seen = np.zeros(len(tokens), np.int64)
    low = int(np.searchsorted(tokens, _U(1 << 63)))
    if len(numbers):
        own = (tokens[:low] >> _U(31 - bits)).astype(np.int64)
        at = np.minimum(np.searchsorted(numbers, own), len(numbers) - 1)
        hit = numbers[at] == own
        cheap[:low] = ~hit
        seen[:low][hit] = many[at[hit]]
    one = _prefix(len(tokens))
    extra = 0 if cheap[:one].all() else min(EXTRA_MATCHES, len(tokens) - one)
    first = tokens[cheap][: one + extra]
    if len(first) < one + extra:
        rest = tokens[~cheap]
        first = np.concatenate([first, rest[np.argsort(seen[~cheap], kind="stable")][: one + extra - len(first)]])
    return first, extra


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


_POSTED = "bucket int, classes binary, sizes binary, extras binary, counts binary, shingles binary"
_FOUND = "kind int, a bigint, b bigint, shared int, needed int"


def _candidates(texts: DataFrame, bits: int, costly: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(kind, a, b, shared, needed), a < b: kind 0 are pairs of classes of a short list, with the number of shingles of
    this bucket that they share; kind 1 links each class of a long list with the list's first."""
    known = texts.sparkSession.sparkContext.broadcast(costly)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for new in _new_sets(batches, 0):
            chosen = [_chosen(tokens, bits, known.value) for _, tokens in new]
            number = np.asarray([c for c, _ in new], np.int64)
            size = np.asarray([len(t) for _, t in new], np.int32)
            extra = np.asarray([x for _, x in chosen], np.int8)
            every = np.concatenate([np.zeros(0, _U), *[p for p, _ in chosen]])
            owner = np.repeat(np.arange(len(new)), [len(p) for p, _ in chosen])
            bucket = (every >> _U(63 - bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, owner, rest = bucket[order], owner[order], (every[order] >> _U(31 - bits)).astype("<u4")
            cut = np.flatnonzero(np.diff(bucket, prepend=-1))
            rows = []
            for a, b in zip(cut, np.append(cut, len(bucket))[1:], strict=True):
                run = np.flatnonzero(np.diff(owner[a:b], prepend=-1))
                who = owner[a:b][run]
                rows.append((bucket[a], number[who].tobytes(), size[who].tobytes(), extra[who].tobytes(), np.diff(run, append=b - a).astype(np.int32).tobytes(), rest[a:b].tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int32(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in _POSTED.split(", ")])

    def pair(table: pa.Table) -> pa.Table:
        def all_of(name: str, kind) -> np.ndarray:
            return np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])

        # Classes by their place among the bucket's, so that a pair of them, or a shingle and a class, is one number.
        number, at, place = np.unique(all_of("classes", np.int64), return_index=True, return_inverse=True)
        size, extra = all_of("sizes", np.int32)[at].astype(np.int64), all_of("extras", np.int8)[at].astype(np.int32)
        owner = np.repeat(place.astype(_U), all_of("counts", np.int32))
        # A class that several tasks have posted counts once.
        entries = np.unique((all_of("shingles", "<u4").astype(_U) << _U(32)) | owner)
        owner = (entries & _U(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.diff((entries >> _U(32)).astype(np.int64), prepend=-1))
        many = np.diff(np.append(first, len(entries)))
        pairs, shared = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for length in range(2, LIST + 1):
            # All lists of one length at once.
            own = owner[first[many == length][:, None] + np.arange(length)]
            for i in range(length - 1):
                a, b = np.repeat(own[:, i], length - i - 1), own[:, i + 1 :].ravel()
                fit = OF * np.minimum(size[a], size[b]) >= PART * np.maximum(size[a], size[b])
                found, often = np.unique((a[fit] << 32) | b[fit], return_counts=True)
                pairs.append(found)
                shared.append(often)
        pairs, shared = _summed(np.concatenate(pairs), np.concatenate(shared))
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        long = many > LIST
        heads = np.repeat(owner[first[long]], many[long] - 1)
        others = np.delete(owner[np.repeat(long, many)], np.cumsum(many[long]) - many[long])
        linked = np.unique((heads << 32) | others)
        none = np.zeros(len(linked), np.int32)
        return pa.table(
            {
                "kind": pa.array(np.concatenate([np.zeros(len(pairs), np.int32), none + 1])),
                "a": pa.array(number[np.concatenate([a, linked >> 32])]),
                "b": pa.array(number[np.concatenate([b, linked & 0xFFFFFFFF])]),
                "shared": pa.array(np.concatenate([shared.astype(np.int32), none])),
                "needed": pa.array(np.concatenate([1 + np.minimum(extra[a], extra[b]), none])),
            }
        )

    return texts.mapInArrow(post, _POSTED).groupBy("bucket").applyInArrow(pair, _FOUND)


def _filtered(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sizes and bitmaps allow similarity."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(2, 6)]
            yield batch.select(["a", "b"]).filter(pa.array([_may_be_similar(x, n, y, m) for x, n, y, m in zip(*columns, strict=True)], pa.bool_()))

    left = classes.selectExpr("class AS a", "bitmap AS bitmap_a", "n AS n_a")
    right = classes.selectExpr("class AS b", "bitmap AS bitmap_b", "n AS n_b")
    joined = pairs.join(left, "a").join(right, "b").where(f"{OF} * least(n_a, n_b) >= {PART} * greatest(n_a, n_b)")
    return joined.select("a", "b", "bitmap_a", "n_a", "bitmap_b", "n_b").mapInArrow(keep, "a bigint, b bigint")


def _sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, tokens) of the `wanted` (class, rep) classes, read again from their first documents."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(hashing.shingle_sets(batch.column(1)))
            columns = [pa.array([_class(t) for t in sets], pa.int64()), pa.array([t.tobytes() for t in sets], pa.binary()), batch.column(0)]
            yield pa.RecordBatch.from_arrays(columns, names=["class", "tokens", "rep"])

    found = texts.join(limited(wanted.select("rep").distinct()), texts["doc_id"] == F.col("rep")).select("rep", "text")
    built = found.mapInArrow(build, "class bigint, tokens binary, rep bigint")
    # Of a repeated doc_id only the texts of the class count; where these repeat, links come twice, to no effect.
    return built.join(limited(wanted.select("class")), "class", "left_semi").select("class", "tokens")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), _U) for v in (x, y))
                similar.append(_enough(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)))
            yield batch.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

    left, right = sets.selectExpr("class AS a", "tokens AS x"), sets.selectExpr("class AS b", "tokens AS y")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(keep, "a bigint, b bigint")


def _with_main(members: DataFrame) -> DataFrame:
    """`members` (class, family, part) with `main`, the family's largest part; only families of several parts."""
    parts = members.groupBy("family", "part").agg(F.count("*").alias("size"))
    largest = parts.groupBy("family").agg(F.max(F.struct("size", "part")).alias("top"), F.count("*").alias("parts"))
    return members.join(largest.where("parts > 1").selectExpr("family", "top.part AS main"), "family")


def _in_blocks(members: DataFrame, data: DataFrame, block: int):
    """`members` (class, family, part, main) with their `data`, grouped so that each one outside a family's main part (`asks`)
    meets every member of the family once, in groups of about `block` rows a side."""
    blocks = members.groupBy("family").agg(F.count("*").alias("total"), F.count_if(F.col("part") != F.col("main")).alias("rest")).where("rest > 0")
    blocks = blocks.selectExpr("family", f"CAST(ceil(total / {block}) AS INT) AS in_all", f"CAST(ceil(rest / {block}) AS INT) AS in_rest")
    placed = members.join(blocks, "family").join(data, "class")
    key, carried = ("family", "rest_block", "all_block"), ["class", "part", *(c for c in data.columns if c != "class")]
    rest = placed.where("part <> main").selectExpr(
        "family", "CAST(pmod(xxhash64(class), in_rest) AS INT) AS rest_block", "explode(sequence(0, in_all - 1)) AS all_block", *carried, "true AS asks"
    )
    every = placed.selectExpr(
        "family", "explode(sequence(0, in_rest - 1)) AS rest_block", "CAST(pmod(xxhash64(class, 1), in_all) AS INT) AS all_block", *carried, "false AS asks"
    )
    return rest.union(every).groupBy(*key)


def _within_families(members: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): similar pairs of `members` (class, family, part, main) of one family and different parts.

    Everything outside a family's main part is compared with the whole family, first by sizes and bitmaps. Only those that
    these allow to be similar to another are compared by their sets, which are many times larger.
    """
    described = classes.select("class", "n", "bitmap")
    possible = _in_blocks(members, described, BITMAP_BLOCK).applyInArrow(_possible_in_blocks, "class bigint").distinct()
    possible = written(possible, "jaccard-possible")
    left = members.join(possible, "class", "left_semi")
    return _in_blocks(left, sets, BLOCK).applyInArrow(_similar_in_blocks, "a bigint, b bigint")


def _folded(bitmaps: np.ndarray, length: int) -> np.ndarray:
    return np.bitwise_xor.reduce(bitmaps.reshape(len(bitmaps), -1, length), axis=1)


def _possible_in_blocks(block: pa.Table) -> pa.Table:
    """The classes of a block that sizes and bitmaps allow to be similar to one of another part."""
    rest, every = block.filter(block.column("asks")), block.filter(pc.invert(block.column("asks")))
    kept = [np.zeros(0, np.int64)]
    if rest.num_rows and every.num_rows:
        bitmaps = every.column("bitmap").to_pylist()
        numbers, parts, sizes = (every.column(c).to_numpy().astype(np.int64) for c in ("class", "part", "n"))
        lengths = np.asarray([len(b) for b in bitmaps])
        stacks = []
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            stacks.append((at, np.stack([np.frombuffer(bitmaps[i], np.uint8) for i in at])))
        for number, part, n, bitmap in zip(*(rest.column(c).to_pylist() for c in ("class", "part", "n", "bitmap")), strict=True):
            own = np.frombuffer(bitmap, np.uint8)[None]
            for at, stack in stacks:
                fit = (parts[at] != part) & (OF * np.minimum(sizes[at], n) >= PART * np.maximum(sizes[at], n))
                if not fit.any():
                    continue
                at, short = at[fit], min(stack.shape[1], own.shape[1])
                only_one = np.bitwise_count(_folded(stack[fit], short) ^ _folded(own, short)).sum(axis=1, dtype=np.int64)
                shared = (sizes[at] + n - only_one) // 2
                near = numbers[at[OF * shared >= PART * (sizes[at] + n - shared)]]
                if len(near):
                    kept += [near, np.asarray([number], np.int64)]
    return pa.table({"class": pa.array(np.unique(np.concatenate(kept)), pa.int64())})


def _similar_in_blocks(block: pa.Table) -> pa.Table:
    rest, every = block.filter(block.column("asks")), block.filter(pc.invert(block.column("asks")))
    out: list[tuple[int, int]] = []
    if rest.num_rows and every.num_rows:
        sets = [np.frombuffer(t, _U) for t in every.column("tokens").to_pylist()]
        numbers, parts = every.column("class").to_pylist(), np.asarray(every.column("part").to_pylist())
        sizes = np.asarray([len(s) for s in sets])
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        for number, part, own in zip(*(rest.column(c).to_pylist() for c in ("class", "part", "tokens")), strict=True):
            own = np.frombuffer(own, _U)
            low, high = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
            many = high - low
            at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            shared = np.bincount(owner[at], minlength=len(sets))
            similar = (OF * shared >= PART * (sizes + len(own) - shared)) & (parts != part)
            out += [(number, numbers[i]) for i in np.flatnonzero(similar)]
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of `docs` (doc_id, text): the size of each document's set of 5-word shingles, and the
    smallest doc_id reachable over links between documents whose sets are similar.

    Words are what stands between white space, A to Z lower-cased. A document of fewer than five words has one shingle, all its
    words; one without words, or whose text is null, has none and is linked with nothing. Equal sets are one class
    throughout, so copies cost what one document costs. No pair of classes above the threshold is missed, and none
    below it is linked. Rows without doc_id cannot be named: their component_id is null. A doc_id that repeats stands for
    all its rows: each row has its own set size and its component. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.expr(whole_text()).alias("text"))
    described = written(classes_of(rows), "jaccard-documents")
    named = described.where("doc_id IS NOT NULL AND n > 0")
    classes = written(named.groupBy("class", "n").agg(F.min("doc_id").alias("rep"), F.first("bitmap").alias("bitmap")), "jaccard-classes")
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    bits = max(6, (shingles // SHINGLES_PER_BUCKET).bit_length())
    texts = rows.where("doc_id IS NOT NULL").select("text")

    found = written(_candidates(texts, bits, _costly(texts, bits)), "jaccard-candidates")
    pairs = found.where("kind = 0").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("needed").alias("needed")).where("shared >= needed")
    star = written(found.where("kind = 1").select("a", "b").distinct(), "jaccard-families")
    likely = written(_filtered(pairs.select("a", "b").union(star).distinct(), classes), "jaccard-likely")
    wanted = likely.select("a").union(likely.select("b")).union(star.select("a")).union(star.select("b")).distinct()
    wanted = written(classes.join(wanted.withColumnRenamed("a", "class"), "class", "left_semi").select("class", "rep"), "jaccard-wanted")
    sets = written(_sets(rows, wanted), "jaccard-sets")
    links = written(_verified(likely, sets), "jaccard-links")
    parts = components(links, "jaccard-parts")
    families = components(star, "jaccard-family")
    members = families.join(parts.withColumnRenamed("component", "part"), "node", "left").selectExpr(
        "node AS class", "component AS family", "coalesce(part, node) AS part"
    )
    members = written(_with_main(members), "jaccard-members")
    more = written(_within_families(members, classes, sets), "jaccard-more")
    if more.limit(1).count():
        parts = components(links.union(more), "jaccard-parts")
    joined = classes.join(parts, F.col("class") == F.col("node"), "left").selectExpr("class", "n", "rep", "coalesce(component, class) AS component")
    smallest = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    answer = joined.join(smallest, "component").selectExpr("class", "n AS class_n", "component_id")
    same = (described["class"] == answer["class"]) & (described["n"] == answer["class_n"])
    return described.join(answer, same, "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.expr("CASE WHEN doc_id IS NULL THEN NULL WHEN n = 0 THEN doc_id ELSE component_id END AS component_id"),
    )


def without_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, of the smallest doc_id of each component, and the rows without
    doc_id. Of rows that share a doc_id and a text one stays."""
    dropped = written(near_duplicates(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("dropped_id")).distinct(), "jaccard-dropped")
    kept = docs.join(dropped, docs["doc_id"].cast("bigint") == dropped["dropped_id"], "left_anti")
    return kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]).union(kept.where("doc_id IS NULL"))
