"""Byte-level BPE encoding and decoding.

The tokenizers library encodes Arrow batches.  Its model is made on the driver
from a rank file: each token may be joined from any two tokens that make it up,
in the order of the ranks, and a piece that is a token stays whole.  Bytes travel
as printable characters (the byte table); offsets count code points, and a token
that holds part of a character spans that character.

Texts are cut into chunks where no token can span the cut (before white space,
and before closing punctuation after a Latin word).  A worker keeps the ids of
the chunks it met first; the other chunks of a batch are encoded once per batch.

NULL texts are empty.  Empty texts give no ids.  Repeated rows are encoded
alike; other columns pass unchanged, so the new columns need free names.
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT_CHUNKS = 300_000
SECTION = 1 << 20

# White space of the split pattern, as a character class.
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_CHUNK = re.compile(
    f"[{_WS}]*[{_LETTERS}]+(?=[.,!?;:{_WS}]|$)|[.,!?;:]+(?=[{_WS}]|$)|[{_WS}]*[^{_WS}]+|[{_WS}]+"
)
_GAP = re.compile(f"(?<=[^{_WS}])(?=[{_WS}])")


def byte_table() -> list[str]:
    """The printable character of each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """A tokenizer of the library, with merges derived from the ranks."""
    table = byte_table()

    def shown(token: bytes) -> str:
        return "".join(table[b] for b in token)

    merges = [
        [shown(token[:i]), shown(token[i:])]
        for token, _ in sorted(ranks.items(), key=lambda x: x[1])
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": True}
    return json.dumps(
        {
            "version": "1.0",
            "added_tokens": [],
            "normalizer": None,
            "pre_tokenizer": level,
            "post_processor": None,
            "decoder": level,
            "model": {
                "type": "BPE",
                "ignore_merges": True,
                "vocab": {shown(token): rank for token, rank in ranks.items()},
                "merges": merges,
            },
        }
    )


class _Encoder:
    def __init__(self, spec: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.kept: dict[str, bytes] = {}
        self.kept_spans: dict[str, tuple[bytes, bytes]] = {}

    def _learn(self, chunks: list[str], spans: bool) -> dict[str, bytes]:
        """Ids of chunks, packed; with spans also the offsets within the chunk."""
        out = {}
        for i in range(0, len(chunks), 256):
            part = chunks[i : i + 256]
            got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids, of = np.array(got.ids, np.int32), np.array(got.word_ids, np.int64)
            at = np.searchsorted(of, np.arange(len(part) + 1))
            packed = ids.tobytes()
            out.update({c: packed[4 * a : 4 * b] for c, a, b in zip(part, at[:-1].tolist(), at[1:].tolist())})
            if spans:
                both = np.array(got.offsets, np.int32).reshape(-1, 2)
                for c, a, b in zip(part, at[:-1].tolist(), at[1:].tolist()):
                    self.kept_spans[c] = (both[a:b, 0].tobytes(), both[a:b, 1].tobytes())
        return out

    def batch(self, texts: list[str], spans: bool):
        """Per text: ids, starts and ends (the last two only with spans)."""
        sections = [s for text in texts for s in _sections(text)]
        counts = [sum(1 for _ in _sections(text)) if len(text) > SECTION else 1 for text in texts]
        parts = []
        for group in _by_size(sections):
            pieces = [_CHUNK.findall(s) for s in group]
            met = set().union(*pieces)
            if spans and len(self.kept_spans) > KEPT_CHUNKS:
                self.kept_spans.clear()
            new = [c for c in met if c not in self.kept or (spans and c not in self.kept_spans)]
            learned = self._learn(new, spans)
            if len(self.kept) + len(learned) <= KEPT_CHUNKS:
                self.kept.update(learned)
                known = self.kept
            else:
                known = {c: self.kept.get(c) for c in met}
                known.update(learned)
            for p in pieces:
                ids = np.frombuffer(b"".join(map(known.__getitem__, p)), np.int32)
                parts.append((ids, *self._spans(p)) if spans else (ids,))
        out, k = [], 0
        for text, n in zip(texts, counts):
            shift = 0
            for i, s in enumerate(_sections(text)):
                if spans and i:
                    ids, a, b = parts[k + i]
                    parts[k + i] = (ids, a + shift, b + shift)
                shift += len(s)
            out.append(tuple(np.concatenate(x) for x in zip(*parts[k : k + n])) if n > 1 else parts[k])
            k += n
        return out

    def _spans(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        first = np.cumsum([0, *map(len, pieces)], dtype=np.int32)[:-1]
        got = [self.kept_spans[p] for p in pieces]
        shift = np.repeat(first, [len(a) // 4 for a, _ in got])
        return tuple(np.frombuffer(b"".join(x), np.int32) + shift for x in zip(*got)) if got else (shift, shift)


def _sections(text: str):
    """The text in sections, cut before white space only."""
    if len(text) <= SECTION:
        yield text
        return
    at = 0
    while len(text) - at > SECTION and (gap := _GAP.search(text, at + SECTION)):
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:]


def _by_size(sections: list[str]):
    group, size = [], 0
    for s in sections:
        group.append(s)
        size += len(s)
        if size >= SECTION:
            yield group
            group, size = [], 0
    if group:
        yield group


@lru_cache(maxsize=2)
def _encoder(spec: str) -> _Encoder:
    return _Encoder(spec)


def _appended(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], [*batch.schema.names, *columns])


def _list_array(rows: list[np.ndarray]) -> pa.Array:
    bounds = np.cumsum([0, *map(len, rows)])
    flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", offsets: bool = True) -> DataFrame:
    """docs with ids, and with starts and ends of each token in code points; columns of these names are replaced."""
    docs = docs.drop(*(("ids", "starts", "ends") if offsets else ("ids",)))
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_json(ranks))

    def run(batches):
        encoder = _encoder(spec.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            rows = encoder.batch(texts, offsets)
            names = ("ids", "starts", "ends") if offsets else ("ids",)
            yield _appended(batch, **{name: _list_array([r[i] for r in rows]) for i, name in enumerate(names)})

    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, ints) for n in (("ids", "starts", "ends") if offsets else ("ids",)))])
    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """encoded with the bytes of the ids, `decoded`, which replaces a column of that name.

    The bytes are those that the reversed byte table gives; a character split
    over tokens is whole again once their bytes are joined.  NULL ids are empty.
    """
    encoded = encoded.drop("decoded")
    shown = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        shown[rank] = token
    tokens = encoded.sparkSession.sparkContext.broadcast(shown)

    def run(batches):
        of = tokens.value.__getitem__
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            rows = [b"".join(map(of, x.values.to_numpy().tolist())) if x.is_valid else b"" for x in column]
            yield _appended(batch, decoded=pa.array(rows, pa.binary()))

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))


def text_of(decoded: str = "decoded") -> F.Column:
    """Decoded bytes as text; bytes that end in mid-character show as U+FFFD."""
    return F.decode(decoded, "UTF-8") if isinstance(decoded, str) else decoded


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and fingerprints of ids and decoded bytes."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
