"""Document fingerprints: a Merkle tree over sections, paragraphs and phrases. Equal roots mean equal texts; where two
trees differ, the branches that differ say where the edit is."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import successors, whole_text

# A paragraph is a line. Phrases end at a space after one of these marks; a section ends after a paragraph whose
# hash begins with one of these digits, so that an insertion moves no later section's borders.
PHRASE_END = "(?<=[.!?,;:#$%&*]) "
SECTION_END = "(?<= [0-3][0-9a-f]{63}) "
SHOWN_DIGITS = 16
# Documents per window of neighbours, about.
NEIGHBOURS = 64
# Slices of ids of about as many documents each, whose bounds pass the driver.
MOST_SLICES = 1024


def fingerprint(text: str) -> str:
    """SQL for the fingerprint of a text: root/sections/paragraphs/phrases.

    Paragraph hashes are SHA-256 of the paragraphs, a section's of its paragraphs' hashes, the root's of the sections'.
    The root is written in full, the others in SHOWN_DIGITS digits; under each paragraph are short hashes of its phrases,
    which serve to measure likeness. A null text has the fingerprint of the empty one.
    """
    paragraphs = f"transform(array(split({whole_text(text)}, '\n')), ps -> named_struct('ps', ps, 'hs', transform(ps, p -> sha2(p, 256))))"
    sections = f"transform(split(concat(' ', array_join(t.hs, ' ')), '{SECTION_END}'), s -> sha2(trim(s), 256))"
    tree = f"transform({paragraphs}, t -> named_struct('ps', t.ps, 'hs', t.hs, 'ss', {sections}))"
    shown = f"array_join(transform({{}}, h -> substr(h, 1, {SHOWN_DIGITS})), '.')"
    leaves = f"array_join(transform(t.ps, p -> array_join(transform(split(p, '{PHRASE_END}'), q -> right(hex(xxhash64(q)), 8)), ',')), '.')"
    return (
        f"transform({tree}, t -> concat_ws('/', sha2(array_join(t.ss, ' '), 256), {shown.format('t.ss')}, {shown.format('t.hs')}, {leaves}))[0]"
    )


def phrases(print_: str) -> str:
    """SQL for the set of phrase hashes in a fingerprint."""
    return f"array_distinct(split(split({print_}, '/')[3], '[.,]'))"


def likeness(a: str, b: str) -> str:
    """SQL for the share of phrases that two fingerprints have in common: 1 for equal ones, 0 for nothing shared."""
    return (
        f"CASE WHEN split({a}, '/')[0] = split({b}, '/')[0] THEN 1D ELSE 2D * size(array_intersect({phrases(a)}, {phrases(b)}))"
        f" / (size({phrases(a)}) + size({phrases(b)})) END"
    )


def _count_below(ordered: str, x: str, or_equal: bool = False) -> str:
    """SQL for the number of entries of an ascending array that are less than x (or equal), by halving steps."""
    steps = ", ".join(f"{1 << e}" for e in range(30, -1, -1))
    less = "<=" if or_equal else "<"
    needed = f"filter(array({steps}), e -> e <= size({ordered}))"
    return f"aggregate({needed}, 0, (p, e) -> if(p + e <= size({ordered}) AND get({ordered}, p + e - 1) {less} {x}, p + e, p))"


def differing(a: str, b: str, level: str) -> str:
    """SQL for the positions (from 0) of a's sections or paragraphs that b does not have; equal roots have none.

    What b lacks is one set difference; each position is then looked up in it, in order, by halving."""
    at = {"section": 1, "paragraph": 2}[level]
    own, other = f"split(split({a}, '/')[{at}], '\\\\.')", f"split(split({b}, '/')[{at}], '\\\\.')"
    both = f"transform(array(named_struct('own', {own}, 'other', {other})), t -> named_struct('own', t.own, 'new', array_sort(array_except(t.own, t.other))))"
    lacking = f"get(t.new, {_count_below('t.new', 't.own[i]')}) <=> t.own[i]"
    return (
        f"CASE WHEN split({a}, '/')[0] = split({b}, '/')[0] THEN array() ELSE "
        f"transform({both}, t -> filter(sequence(0, size(t.own) - 1), i -> {lacking}))[0] END"
    )


def windows(rows: DataFrame) -> DataFrame:
    """`rows` with w, a number that grows with doc_id and is shared by about NEIGHBOURS of them.

    Ids are cut at approximate quantiles, and each slice evenly by its own range, so that ids far from all others
    widen the windows of their slice alone. A null doc_id has a null w.
    """
    n = rows.where("doc_id IS NOT NULL").count()
    slices = min(MOST_SLICES, n // (4 * NEIGHBOURS) + 1)
    shares = ", ".join(f"{i / slices}D" for i in range(slices))
    low, high, cuts = rows.selectExpr("min(doc_id)", "max(doc_id)", f"percentile_approx(doc_id, array({shares}), {10 * MOST_SLICES})").first()
    starts = sorted({low, *cuts}) if n else [0]
    ends = [*starts[1:], (high or 0) + 1]
    each = max(1, n // slices // NEIGHBOURS)
    counts = [min(each, end - start) for start, end in zip(starts, ends, strict=True)]
    offsets = [0, *itertools.accumulate(counts)]
    table = ", ".join(
        f"named_struct('low', {float(s)!r}D, 'width', {(e - s) / c!r}D, 'first', {o}L, 'last', {o + c - 1}L)"
        for s, e, c, o in zip(starts, ends, counts, offsets, strict=False)
    )
    at = f"greatest({_count_below(f'array({', '.join(f'{s}L' for s in starts)})', 'doc_id', True)} - 1, 0)"
    sliced = rows.withColumn("slice", F.expr(f"array({table})[{at}]"))
    w = "CASE WHEN doc_id IS NOT NULL THEN least(slice.last, slice.first + floor((CAST(doc_id AS DOUBLE) - slice.low) / slice.width)) END"
    return sliced.withColumn("w", F.expr(w)).drop("slice")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, print, next_text, next_print): every document beside the one that follows in ascending doc_id;
    after the last comes the first. Rows with one doc_id follow each other by text. A null doc_id has no next one.

    Texts are shuffled once, to windows of about NEIGHBOURS documents. Only the last document of a window takes its
    next from elsewhere, the first document of the next window.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.expr(whole_text()).alias("text"))
    rows = windows(rows)
    named = rows.where("doc_id IS NOT NULL")
    order = Window.partitionBy("w").orderBy("doc_id", "text")
    inside = named.withColumn("print", F.expr(fingerprint("text"))).select(
        "doc_id", "text", "print", F.lead("text").over(order).alias("next_text"), F.lead("print").over(order).alias("next_print")
    )
    # The first and last of each window by rank, so that the others are not shuffled again.
    backwards = Window.partitionBy("w").orderBy(F.desc("doc_id"), F.desc("text"))
    firsts = named.withColumn("n", F.row_number().over(order)).where("n = 1").selectExpr("w AS next", "text AS next_text")
    lasts = named.withColumn("n", F.row_number().over(backwards)).where("n = 1").select("w", "doc_id", "text")
    blocks = named.select("w").distinct()
    across = lasts.join(successors(blocks, "w"), "w").join(firsts, "next").select("doc_id", "text", "next_text")
    across = across.union(rows.where("doc_id IS NULL").selectExpr("doc_id", "text", "''"))
    return inside.where("next_text IS NOT NULL").union(
        across.selectExpr("doc_id", "text", fingerprint("text"), "next_text", fingerprint("next_text"))
    )


def edited_text(text: str, other: str) -> str:
    """SQL: the text with its last half replaced by as much of another text's beginning, or all of it."""
    return f"concat(substring({text}, 1, length({text}) - length({text}) div 2), substring({other}, 1, length({text}) div 2))"


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and their likeness. Empty tables give no rows."""
    pairs = with_next(docs).withColumn("edited", F.expr(edited_text("text", "next_text")))
    seen = pairs.withColumn("edited_fingerprint", F.expr(fingerprint("edited")))
    return seen.selectExpr(
        "doc_id",
        "CAST(length(text) AS BIGINT) AS n_chars",
        "sha2(edited, 256) AS edited_sha256",
        "print AS fingerprint",
        "edited_fingerprint",
        f"{likeness('print', 'edited_fingerprint')} AS near_edited",
        f"{likeness('print', 'next_print')} AS near_next",
        f"{differing('print', 'edited_fingerprint', 'paragraph')} AS edited_paragraphs",
    )

