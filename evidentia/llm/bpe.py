"""Byte-level BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The root of the tree is the leftmost pair of the lowest rank; a merge updates the leaves of the merged pair and of its
two neighbours, each in logarithmic time, until the root holds no mergeable pair. A word of n bytes takes
O(n log n), also where a whole document is one word. Words seen before come from a bounded cache of the worker.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Fixed value: the public pre-tokenizing pattern of byte-level BPE.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_WORDS = 350_000
SLICE = 256


class Tokenizer:
    """The vocabulary of one tokenizer file, and what was encoded with it so far."""

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        vocab = parsed["model"]["vocab"]
        self.split = regex.compile(WORDS)
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        letters = byte_letters()
        self.byte_ids = [vocab[letters[b]] for b in range(256)]
        back = {c: b for b, c in letters.items()}
        bytes_of = {i: bytes(back[c] for c in token) for token, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        table = [bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)]
        self.letters = np.frombuffer(b"".join(table), np.uint8)
        self.lengths = np.array([len(x) for x in table])
        self.starts = np.cumsum(self.lengths) - self.lengths
        merges = [tuple(m.split(" ")) if isinstance(m, str) else m for m in parsed["model"]["merges"]]
        self.merged = [vocab[a + b] for a, b in merges]
        self.none = len(merges)
        self.pairs: dict[int, int] = {}
        for rank, (a, b) in enumerate(merges):
            self.pairs.setdefault(vocab[a] << 20 | vocab[b], rank)
        self.words = Words(self)

    def merge(self, word: bytes) -> list[int]:
        ids = [self.byte_ids[b] for b in word]
        n, pairs = len(ids), self.pairs
        if n < 2:
            return ids
        size = 1 << (n - 2).bit_length()
        bits, none = n.bit_length(), self.none
        at = (1 << bits) - 1
        # a node is the lowest rank beneath it, then the leftmost position; leaf i is the pair that begins at i
        tree = [none] * size + [pairs.get(a << 20 | b, none) << bits | i for i, (a, b) in enumerate(zip(ids, ids[1:]))]
        worst = none << bits
        tree += [worst] * (2 * size - len(tree))
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (root := tree[1]) < worst:
            i = root & at
            j = after[i]
            merged = ids[i] = self.merged[root >> bits]
            ids[j] = -1
            k = after[i] = after[j]
            changed = [(j, worst)]
            if k < n:
                before[k] = i
                changed.append((i, pairs.get(merged << 20 | ids[k], none) << bits | i))
            else:
                changed.append((i, worst))
            h = before[i]
            if h >= 0:
                changed.append((h, pairs.get(ids[h] << 20 | merged, none) << bits | h))
            for x, value in changed:
                x += size
                if x < len(tree):
                    tree[x] = value
                    while x > 1:
                        other = tree[x ^ 1]
                        if other < value:
                            value = other
                        x >>= 1
                        if tree[x] == value:
                            break
                        tree[x] = value
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> np.ndarray:
        """Token ids; special tokens in the text are themselves, as the file's own settings have it."""
        if len(self.words) > CACHE_WORDS:
            self.words = Words(self, self.words)
        words = self.words
        if self.special_split is None or not any(t in text for t in self.special):
            return np.frombuffer(b"".join(map(words.__getitem__, self.split.findall(text))), np.int32)
        parts = []
        for k, part in enumerate(self.special_split.split(text)):
            parts += [np.int32(self.special[part]).tobytes()] if k % 2 else map(words.__getitem__, self.split.findall(part))
        return np.frombuffer(b"".join(parts), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ends):
            return ""
        return self.letters[np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + lengths, lengths)].tobytes().decode("utf-8", "replace")


class Words(dict):
    """Ids of a word, as int32 bytes. ``older`` is the full cache before; its words come over when they are met again."""

    def __init__(self, tokenizer: Tokenizer, older: dict[str, bytes] | None = None):
        super().__init__()
        self.tokenizer, self.older = tokenizer, dict(older or {})

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            ids = self.tokenizer.merge(word.encode())
            out = struct.pack(f"{len(ids)}i", *ids)
        if len(word) < 64:
            self[word] = out
        return out


def byte_letters() -> dict[int, str]:
    """The printable letter by which byte-level vocabularies write each byte: Latin-1's own, or the next above U+00FF."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def tokenizer(spec: str) -> Tokenizer:
    return Tokenizer(spec)


def ship(df: DataFrame, path: str) -> Broadcast:
    """The tokenizer file as the driver reads it: executors need no copy, and its size is that of a vocabulary."""
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, name])


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text`` in a new column ``ids`` (array of int).

    A null or empty text has no ids. Rows are encoded one by one, whole, whatever their length; equal rows give equal
    ids; an empty table gives none. A column ``ids`` that ``df`` has already is replaced.
    """
    df, spec = df.drop(ids), ship(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = [tok.encode(t) if t else np.empty(0, np.int32) for t in part.column(text).to_pylist()]
                offsets = np.cumsum([0, *(len(x) for x in found)], dtype=np.int32)
                yield with_column(part, ids, pa.ListArray.from_arrays(offsets, np.concatenate(found) if found else np.empty(0, np.int32)))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids`` in a new column ``decoded``; bytes that are no UTF-8 become U+FFFD, null ids ''.

    A column ``decoded`` that ``df`` has already is replaced.
    """
    df, spec = df.drop(decoded), ship(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                lists = part.column(ids)
                flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
                texts = [tok.decode(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
                yield with_column(part, decoded, pa.array(texts, pa.string()))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(decoded, T.StringType())]))
