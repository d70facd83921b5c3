"""Packing by powers of two: a document's tokens are cut into pieces of binary lengths, so every training sequence
holds tokens of one document, needs no padding, and sequences of one length form a bucket."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQUENCE_TOKENS = 1024
END_OF_DOCUMENT = 0
# Texts whose ids a task holds at a time.
TEXTS_AT_ONCE = 256

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


class _Encoder:
    """Text to little-endian 32-bit ids.

    The vocabulary comes in two forms, which give the same ids: as ranks for a faster library, and as a tokenizer file,
    which alone knows special tokens. Texts that hold the string of one take the tokenizer.
    """

    def __init__(self, vocabulary: str, ranks: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(word): int(number) for word, number in map(bytes.split, lines)}
        self.ordinary = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        self.whole = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.ordinary.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def cuts(tokens: int, longest: int = SEQUENCE_TOKENS) -> list[int]:
    """The lengths of a document's pieces: as many of the longest as fit, then its remainder's binary digits."""
    whole, rest = divmod(tokens, longest)
    return [longest] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None, longest: int = SEQUENCE_TOKENS) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, bucket, ids) of `docs` (doc_id, text), and sequence_id and offset.

    `ids` are little-endian unsigned 32-bit numbers; each document ends with id 0. `bucket` is the logarithm of the
    length: write with partitionBy("bucket") to train on batches of one length. A piece is a sequence of its own, so
    offset is 0 and nothing is padded. Null text is empty (one piece, the end id); a null or repeated doc_id is kept
    as it is, each row having its own pieces; other columns are ignored; an empty table gives no pieces. One pass over
    the texts, no shuffle. `longest` must be a power of two, `vocabulary` and `ranks` paths that every executor has.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"the longest sequence must be a power of two, not {longest}")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        path = public_tokenizers.path
        encoder = _Encoder(vocabulary or path("byte_bpe_50k.json"), ranks or path("byte_bpe_50k.tiktoken"))
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                yield _pieces(batch.slice(at, TEXTS_AT_ONCE), encoder, longest)

    pieces = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(encode, PIECES)
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint"))


def _pieces(batch: pa.RecordBatch, encoder: _Encoder, longest: int) -> pa.RecordBatch:
    end = np.asarray([END_OF_DOCUMENT], "<u4").tobytes()
    which, starts, lengths, totals, ids = [], [], [], [], []
    for row, text in enumerate(batch.column(1).to_pylist()):
        own = encoder(text or "") + end
        total, start = len(own) // 4, 0
        for length in cuts(total, longest):
            which.append(row)
            starts.append(start)
            lengths.append(length)
            totals.append(total)
            ids.append(own[4 * start : 4 * (start + length)])
            start += length
    numbers = np.asarray(lengths, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(pa.array(which, pa.int64())),
            pa.array(starts, pa.int64()),
            pa.array(numbers),
            pa.array(totals, pa.int64()),
            pa.array(np.log2(np.maximum(numbers, 1)).astype(np.int32)),
            pa.array(ids, pa.binary()),
        ],
        names=PIECES.names,
    )


def packed_pieces(docs: DataFrame) -> DataFrame:
    """The digest of `pack`: each piece's ids as their CRC."""
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )
