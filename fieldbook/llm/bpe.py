"""Byte-level BPE in tasks: whole texts, with bounded work memory for the very long ones."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space as the vocabularies' split pattern has it; Python's own ``\s`` has more.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Pieces that are encoded on their own, with the same ids, since a match of the split pattern
#: never crosses their ends: a run without white space with the space before it, of which a word of
#: Latin letters is cut off before a sign that can only start another match.
PIECE = re.compile(f" ?[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[.,;:!?{SPACE}]|$)| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")

WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def byte_chars() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes with: printable ones stand for
    themselves, the others get those from 256 on, in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_CHARS = byte_chars()

#: Texts that are not cut all at once: white space beside white space, or the mark itself.
ODD = "[\\t\\n\\x0b\\x0c\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]{2}|\\x00"

#: A letter, after which a full stop, a comma or the like starts another match.
LETTER = "([A-Za-zÀ-ÖØ-öø-ÿ])"

#: Before a single space between two other characters a match always ends.
SAFE = re.compile(f"(?<=[^{SPACE}])(?= [^{SPACE}])")


def slices(text: str, size: int) -> Iterator[str]:
    """The text in slices of about ``size`` characters, cut only at safe boundaries; a text with
    none comes in one slice."""
    at = 0
    while len(text) - at > 2 * size:
        cut = SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class PieceEncoder:
    """Ids of the ``tokenizers`` library, remembered by piece.  Two generations of at most about
    ``limit`` pieces each are kept: what was not met during a generation is forgotten."""

    def __init__(self, path: str, limit: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.limit, self.young, self.old = limit, {}, {}

    def _learn(self, pieces: set[str]) -> None:
        known = pieces & self.old.keys()
        self.young.update(zip(known, map(self.old.__getitem__, known)))
        missing = []
        for p in pieces - known:
            if WORD.fullmatch(p):  # one match of the pattern: straight to the merges
                self.young[p] = np.array([t.id for t in self.tokenizer.model.tokenize(p.encode().decode("latin-1").translate(BYTE_CHARS))], "<u4").tobytes()
            else:
                missing.append(p)
        for at in range(0, len(missing), 4096):
            part = missing[at : at + 4096]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            flat = np.array([i for e in ids for i in e], dtype="<u4").tobytes()
            ends = np.cumsum([4 * len(e) for e in ids]).tolist()
            self.young.update(zip(part, [flat[a:b] for a, b in zip([0, *ends], ends)]))

    def _know(self, pieces: set[str]) -> None:
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        new = pieces - self.young.keys()
        if new:
            self._learn(new)

    def encode_text(self, text: str) -> bytes:
        """The ids of one text as little-endian unsigned 32-bit integers; any text, piece by piece."""
        out = []
        for part in slices(text, 1 << 18):
            pieces = PIECE.findall(part)
            self._know(set(pieces))
            out.append(b"".join(map(self.young.__getitem__, pieces)))
        return b"".join(out)

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of every text.  Texts in which white space always stands alone are cut before
        spaces and signs and around line feeds all at once, and each distinct piece is looked up
        once."""
        odd = pc.match_substring_regex(texts, ODD)
        plain = pc.if_else(odd, "", texts)
        marked = pc.replace_substring(pc.replace_substring(plain, " ", "\0 "), "\n", "\0\n\0")
        for sign in ".,!":
            marked = pc.replace_substring_regex(marked, LETTER + re.escape(sign), "\\1\0" + sign)
        lists = pc.split_pattern(marked, "\0")
        coded = pc.dictionary_encode(lists.flatten())
        pieces, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self._know(set(pieces))
        ids = list(map(self.young.__getitem__, pieces))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        n = size[which]
        start = (np.cumsum(size) - size)[which]
        before = np.concatenate(([0], np.cumsum(n)))
        flat = np.frombuffer(b"".join(ids), "<u4")[np.repeat(start - before[:-1], n) + np.arange(before[-1])].tobytes()
        ends = (4 * before[lists.offsets.to_numpy() - lists.offsets[0].as_py()]).tolist()
        return [self.encode_text(texts[k].as_py()) if x else flat[a:b] for k, (x, a, b) in enumerate(zip(odd.to_pylist(), ends, ends[1:]))]


def parts(batch: pa.RecordBatch, column: int, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts have about ``most`` bytes; a longer text is a part alone."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = int(size[at - 1]) if at else 0
        end = max(int(np.searchsorted(size, done + most, "right")), at + 1)
        yield batch.slice(at, end - at)
        at = end


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per file and worker process."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def byte_lengths(path: str) -> np.ndarray:
    """Bytes of every id of a byte-level vocabulary: its token strings have one character a byte;
    special tokens stand for themselves."""
    from tokenizers import Tokenizer

    vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    out = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
    for token, i in vocab.items():
        out[i] = len(token)
    return out


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


_codecs: dict = {}


def codec(path: str, pattern: str):
    """The ``tiktoken`` encoding of a local rank file, one per worker process."""
    import tiktoken

    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})
    return _codecs[path, pattern]
