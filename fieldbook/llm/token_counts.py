"""Token counts of sections by offset-mapped attribution (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import byte_lengths, encoder, parts
from .shared import doc_text

#: How a token that crosses a section boundary is allotted.
FIRST, LAST = "first", "last"


def line_sections(raw: np.ndarray) -> np.ndarray:
    """First bytes of the sections of a text: every line with its line feed, at least one section."""
    return np.concatenate(([0], np.flatnonzero(raw[:-1] == 10) + 1)).astype(np.int64) if len(raw) else np.zeros(1, np.int64)


def char_spans(raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First characters, and characters after the last, of tokens that tile the bytes of a text.
    Tokens that share a character both have it in their span."""
    chars = np.cumsum((raw & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths)
    return chars[ends - lengths], chars[ends - 1] + 1


def section_counts(docs: DataFrame, vocabulary: str, rule: str = FIRST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, section, char_start, char_end, n_tokens, n_crossing`` for every section (line)
    of every text.

    A document is encoded once, as a whole.  The character spans of its tokens are joined to the
    character intervals of its sections by binary search.  A token that reaches over a boundary
    goes, whole, to the section of its first character (rule ``first``) or of its last one
    (``last``) and counts as crossing there; so the counts of a document always add up to the
    count of the whole text.  A line feed belongs to the line that it ends.  A null or empty text
    has one empty section without tokens; null and repeated ids are kept row by row; an empty
    table gives an empty result; further columns are ignored.  There is no shuffle."""
    if rule not in (FIRST, LAST):
        raise ValueError(f"no such rule: {rule}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, size = encoder(vocabulary), byte_lengths(vocabulary)
        for batch in batches:
            for part in parts(batch, 1):
                texts = part.column(1).to_pylist()
                cols: list[list[np.ndarray]] = [[] for _ in range(6)]
                for row, (text, ids) in enumerate(zip(texts, enc.encode_all(part.column(1)))):
                    raw = np.frombuffer(text.encode(), np.uint8)
                    starts = line_sections(raw)
                    chars = np.append(np.cumsum((raw & 0xC0) != 0x80), 0)[starts - 1] if len(raw) else np.zeros(1, np.int64)
                    chars[0] = 0
                    m = len(starts)
                    first, after = char_spans(raw, size[np.frombuffer(ids, "<u4")])
                    a = np.searchsorted(chars, first, "right") - 1
                    b = np.searchsorted(chars, after - 1, "right") - 1
                    own = a if rule == FIRST else b
                    cols[0].append(np.full(m, row))
                    cols[1].append(np.arange(m))
                    cols[2].append(chars)
                    cols[3].append(np.append(chars[1:], len(text)))
                    cols[4].append(np.bincount(own, minlength=m))
                    cols[5].append(np.bincount(own[a != b], minlength=m))
                row, *rest = [np.concatenate(c).astype(np.int64) for c in cols]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), *map(pa.array, rest)], ["doc_id", "section", "char_start", "char_end", "n_tokens", "n_crossing"])

    return doc_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, section bigint, char_start bigint, char_end bigint, n_tokens bigint, n_crossing bigint")
