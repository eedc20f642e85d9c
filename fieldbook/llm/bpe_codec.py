"""Byte-level BPE encoding and decoding by a local rank file (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import codec, slices
from .shared import doc_text

#: Longer texts are encoded in slices, so that the library's work memory stays small.
SLICE_CHARS = 1 << 16


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) for every row of ``docs``.

    Every match of ``pattern`` is merged by the ranks on its own; special tokens have no meaning.
    Long texts are cut before a single space between two other characters, where no match of the
    pattern can continue; a text without such a place is encoded whole.  A null text counts as
    empty and gives no ids; null and repeated ids are kept, row by row; an empty table gives an
    empty result; further columns are ignored.  There is no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [np.concatenate([np.asarray(c.encode_ordinary(s), dtype=np.int32) for s in slices(t, SLICE_CHARS)]) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, np.concatenate(ids))], ["doc_id", "ids"])

    return doc_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, ids, bytes`` for rows of ``doc_id, ids``: the raw bytes that the ids stand for,
    which need not be valid text.  Null or empty ids give no bytes; an id without a rank fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                raw = [c.decode_bytes(i or []) for i in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(raw, pa.binary())], ["doc_id", "ids", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, bytes binary")


def with_digests(decoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` from decoded rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            offsets = batch.column(1).offsets.to_numpy()
            flat = batch.column(1).values.to_numpy(zero_copy_only=False).astype("<u4")
            n = np.diff(offsets).astype(np.int64)
            sha = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(offsets, offsets[1:])]
            raw = [hashlib.sha256(b.as_buffer()).hexdigest() for b in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(sha), pa.array(raw)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return decoded.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
