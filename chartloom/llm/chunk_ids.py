"""Token ids of Arrow batches, each distinct chunk of text encoded once by a worker.

Texts are cut where no token of a byte-level tokenizer can span the cut: before white
space that follows something else, and before closing punctuation after a Latin
letter.  Chunks are known by 64-bit hashes of their bytes; the tokenizers library
encodes those a worker has not met, and the ids of a batch are gathered from its
table.  Beyond `KEPT` chunks new ones are forgotten after their batch.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from chartloom.llm.phrases import ByteHasher

KEPT = 1_500_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b".,!?;:")] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def cuts(data: np.ndarray) -> np.ndarray:
    """Where a chunk begins, apart from the first byte."""
    out = np.zeros(len(data), bool)
    if len(data) < 2:
        return out
    space = _SPACE[data]
    out[1:] = space[1:] & ~space[:-1]
    out[1:] |= _CLOSING[data[1:]] & _LETTER[data[:-1]]
    # White space beyond ASCII: no cut after a character that may be one.
    out[2:] &= ~((data[:-2] == 0xC2) & ((data[1:-1] == 0x85) | (data[1:-1] == 0xA0)))
    lead, middle = data[:-3], data[1:-2]
    maybe = (lead == 0xE1) & (middle == 0x9A) | (lead == 0xE2) & ((middle == 0x80) | (middle == 0x81)) | (lead == 0xE3) & (middle == 0x80)
    out[3:] &= ~maybe
    return out


class ChunkEncoder:
    """Ids by the tokenizers library; spec is a tokenizer's JSON."""

    def __init__(self, spec: str, kept: int = KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.hash, self.kept = Tokenizer.from_str(spec), ByteHasher(), kept
        self.row: dict[int, int] = {}
        # Ids of the chunk in row i: pool[first[i]:first[i + 1]].
        self.pool, self.first, self.rows = np.empty(1 << 16, np.int32), np.zeros(1 << 14, np.int64), 0

    def _learn(self, chunks: list[str]) -> None:
        for i in range(0, len(chunks), 256):
            part = chunks[i : i + 256]
            got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(got.ids, np.int32)
            sizes = np.bincount(np.array(got.word_ids, np.int64), minlength=len(part)) if len(ids) else np.zeros(len(part), np.int64)
            begin, end = self.first[self.rows], self.first[self.rows] + len(ids)
            while end > len(self.pool):
                self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
            while self.rows + len(part) + 1 > len(self.first):
                self.first = np.concatenate([self.first, np.empty_like(self.first)])
            self.pool[begin:end] = ids
            self.first[self.rows + 1 : self.rows + len(part) + 1] = begin + np.cumsum(sizes)
            self.rows += len(part)

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): ids of all texts, and where those of each text begin and end; NULL is empty."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        if not len(texts):
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        binary = texts.fill_null("").cast(pa.large_binary())
        edges = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset : binary.offset + len(binary) + 1]
        raw = binary.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[edges[0] : edges[-1]] if raw is not None else np.empty(0, np.uint8)
        edges = edges - edges[0]
        begins = cuts(data)
        begins[edges[:-1][edges[:-1] < edges[1:]]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(data))[: len(start)]
        keys, at, of = np.unique(self.hash(data, start, end), return_index=True, return_inverse=True)
        rows = np.array([self.row.get(k, -1) for k in keys.tolist()], np.int64)
        lacking = np.flatnonzero(rows < 0)
        kept_rows, kept = self.rows, len(self.row) + len(lacking) <= self.kept
        if len(lacking):
            whole = data.tobytes()
            a, b = start[at[lacking]].tolist(), end[at[lacking]].tolist()
            rows[lacking] = self.rows + np.arange(len(lacking))
            self._learn([whole[x:y].decode() for x, y in zip(a, b)])
            if kept:
                self.row.update(zip(keys[lacking].tolist(), rows[lacking].tolist()))
        rows = rows[of]
        size = (self.first[1:] - self.first[:-1])[rows]
        ends = np.cumsum(size)
        take = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.first[rows] - ends + size, size)
        ids = self.pool[take]
        if not kept:
            self.rows = kept_rows
        bounds = np.concatenate([[0], ends])[np.searchsorted(start, edges)]
        return ids, bounds
