"""Byte-level BPE with a segment tree over the ranks of adjacent pairs.

A leaf holds the rank of the pair that starts at its symbol together with the position, an inner node the smaller of
its children: the root is the leftmost pair of lowest rank. A merge changes three leaves (the merged symbol, the one
it swallowed and the one before), each in logarithmic time, until the root holds no mergeable pair. Pieces (the words
of the byte-level pattern) are encoded once and kept in a bounded cache of the Python worker; texts are encoded whole.
The trees of all new short pieces of a batch are worked on together, one merge of each at a time, as NumPy arrays
with a column for each piece; a long piece has a tree of its own.

Null texts count as empty: no ids, an empty decoded text. The string of a special token in a text is that token, as
the tokenizer file says. Extra columns pass through; a column called like an output is replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daybook.llm.byteops import flat, slices

_NONE = 1 << 62
_CACHE_ENTRIES = 300_000
_TOGETHER_BYTES = 64

# The split of byte-level BPE, with white space as Unicode defines it.
_SPACE = r"\p{White_Space}"
_PIECES = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# The same for texts up to U+024F, where the classes are short lists: the standard library is several times faster.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte: itself where printable, else the next free letter from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairTree:
    """Merges the symbols of one piece."""

    def __init__(self, symbols: list[int], ranks: dict[int, int], merged: list[int]):
        self.symbols, self.ranks, self.merged = symbols, ranks, merged
        n = self.n = len(symbols)
        self.after, self.before = list(range(1, n + 1)), list(range(-1, n - 1))
        size = self.size = 1 << max(0, n - 2).bit_length()
        tree = self.tree = [_NONE] * (2 * size)
        get = ranks.get
        for i in range(n - 1):
            rank = get(symbols[i] << 20 | symbols[i + 1])
            if rank is not None:
                tree[size + i] = rank << 32 | i
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b

    def put(self, i: int, value: int) -> None:
        tree, k = self.tree, self.size + i
        tree[k] = value
        while k > 1:
            other, k = tree[k ^ 1], k >> 1
            low = value if value < other else other
            if tree[k] == low:
                return
            tree[k] = value = low

    def pair(self, i: int) -> int:
        j = self.after[i]
        if j >= self.n:
            return _NONE
        rank = self.ranks.get(self.symbols[i] << 20 | self.symbols[j])
        return _NONE if rank is None else rank << 32 | i

    def run(self) -> list[int]:
        if self.n < 2:
            return self.symbols
        tree, symbols, after, before, n = self.tree, self.symbols, self.after, self.before, self.n
        while tree[1] != _NONE:
            rank, i = tree[1] >> 32, tree[1] & 0xFFFFFFFF
            j = after[i]
            symbols[i] = self.merged[rank]
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            if j < n - 1:
                self.put(j, _NONE)
            self.put(i, self.pair(i))
            if before[i] >= 0:
                self.put(before[i], self.pair(before[i]))
        out, i = [], 0
        while i < n:
            out.append(symbols[i])
            i = after[i]
        return out


def merge_together(symbols: np.ndarray, lengths: np.ndarray, keys: np.ndarray, merged: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """PairTree.run() for every column of `symbols` (a power of two of rows, -1 below a piece's end).

    keys: sorted pairs with their ranks, as (pair, rank) rows. Returns all ids, piece by piece, and their counts.
    """
    size, n = symbols.shape
    pairs, ranks = keys

    def rank_of(a: np.ndarray, b: np.ndarray, i: np.ndarray) -> np.ndarray:
        pair = a << 20 | b
        at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
        return np.where((b >= 0) & (pairs[at] == pair), ranks[at] << 8 | i, _NONE)

    tree = np.full((2 * size, n), _NONE, np.int64)
    if size > 1:
        rows = np.broadcast_to(np.arange(size - 1)[:, None], (size - 1, n))
        tree[size : 2 * size - 1] = rank_of(symbols[:-1], symbols[1:], rows)
    for k in range(size - 1, 0, -1):
        np.minimum(tree[2 * k], tree[2 * k + 1], out=tree[k])
    after = np.repeat(np.arange(1, size + 1)[:, None], n, axis=1)
    before = np.repeat(np.arange(-1, size - 1)[:, None], n, axis=1)
    alive = np.arange(size)[:, None] < lengths[None, :]
    symbols = np.vstack([symbols, np.full((1, n), -1, np.int64)])
    before = np.vstack([before, np.zeros((1, n), np.int64)])
    tree, after, before, symbols = (x.ravel() for x in (tree, after, before, symbols))
    dead = alive.ravel()
    active = np.flatnonzero(tree[n : 2 * n] != _NONE)
    while len(active):
        root = tree[n + active]
        i, rank = root & 0xFF, root >> 8
        j = after[i * n + active]
        symbols[i * n + active] = merged[rank]
        symbols[j * n + active] = -1
        dead[j * n + active] = False
        k = after[j * n + active]
        after[i * n + active] = k
        before[k * n + active] = i
        p = before[i * n + active]
        left = np.maximum(p, 0)
        tree[(size + j) * n + active] = _NONE
        tree[(size + i) * n + active] = rank_of(symbols[i * n + active], symbols[k * n + active], i)
        fresh = rank_of(symbols[left * n + active], symbols[i * n + active], left)
        tree[(size + left) * n + active] = np.where(p >= 0, fresh, tree[(size + left) * n + active])
        for leaf in (j, i, left):
            node = (size + leaf) >> 1
            while node[0]:
                at = 2 * node * n + active
                tree[node * n + active] = np.minimum(tree[at], tree[at + n])
                node = node >> 1
        active = active[tree[n + active] != _NONE]
    alive = dead.reshape(size, n)
    return symbols.reshape(size + 1, n)[:size].T[alive.T].astype(np.int32), alive.sum(axis=0)


class Codec:
    """Encodes and decodes by the contents of a tokenizer file."""

    def __init__(self, contents: bytes):
        spec = json.loads(contents)
        letters, vocab = _byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        pieces: list[bytes] = [b""] * size
        for text, k in vocab.items():
            pieces[k] = text.encode() if text in self.special else bytes(letters[c] for c in text)
        for text, k in self.special.items():
            pieces[k] = text.encode()
        self.single = [vocab[c] for c in sorted(letters, key=letters.get)]
        self.ranks, self.merged = {}, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a] << 20 | vocab[b]] = rank
            self.merged.append(vocab[a + b])
        order = sorted(self.ranks)
        self.keys = np.array([order, [self.ranks[k] for k in order]], np.int64)
        self.merged_array, self.single_array = np.array(self.merged, np.int64), np.array(self.single, np.int64)
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.table = np.frombuffer(b"".join(pieces), np.uint8)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}

    def alone(self, piece: bytes) -> bytes:
        return array("i", PairTree([self.single[b] for b in piece], self.ranks, self.merged).run()).tobytes()

    def learn(self, texts: set[str]) -> dict[str, bytes]:
        """Ids of new pieces, as int32 bytes. Short ones go to the cache."""
        long, by_size = {}, {}
        for text in texts:
            piece = text.encode()
            if len(piece) > _TOGETHER_BYTES:
                long[text] = self.alone(piece)
            else:
                by_size.setdefault(1 << (len(piece) - 1).bit_length(), []).append((text, piece))
        if len(self.cache) + len(texts) > _CACHE_ENTRIES:
            self.cache.clear()
        new = {}
        for size, group in by_size.items():
            lengths = np.array([len(p) for _, p in group])
            raw = np.frombuffer(b"".join(p for _, p in group), np.uint8)
            symbols = np.full((len(group), size), -1, np.int64)
            symbols[np.arange(size)[None, :] < lengths[:, None]] = self.single_array[raw]
            ids, counts = merge_together(np.ascontiguousarray(symbols.T), lengths, self.keys, self.merged_array)
            data, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
            for (text, _), a, b in zip(group, [0, *ends], ends):
                new[text] = data[a:b]
        self.cache.update(new)
        return new | long

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts."""
        cut = [self.cut.split(t) if self.cut is not None and any(s in t for s in self.special) else [t] for t in texts]
        found = [[(_PIECES if _BEYOND_LATIN.search(p) else _LATIN).findall(p) for p in parts[::2]] for parts in cut]
        new = self.learn({p for parts in found for part in parts for p in part if p not in self.cache})
        out = []
        for parts, pieces in zip(cut, found):
            ids = []
            for k, part in enumerate(pieces):
                got = list(map(self.cache.get, part))
                if None in got:
                    got = [x if x is not None else new.get(p) or self.alone(p.encode()) for x, p in zip(got, part)]
                ids += got
                if 2 * k + 1 < len(parts):
                    ids.append(array("i", [self.special[parts[2 * k + 1]]]).tobytes())
            out.append(np.frombuffer(b"".join(ids), np.int32))
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, one after another."""
        lengths = self.lengths[ids]
        shift = self.first[ids] - (np.cumsum(lengths) - lengths)
        return self.table[np.arange(int(lengths.sum())) + np.repeat(shift, lengths)]


_CODECS: dict[str, Codec] = {}


def _codec(shared: Broadcast, digest: str) -> Codec:
    if digest not in _CODECS:
        _CODECS[digest] = Codec(shared.value)
    return _CODECS[digest]


def _shared(spark: SparkSession, path: str) -> tuple[Broadcast, str]:
    with open(path, "rb") as file:
        contents = file.read()
    return spark.sparkContext.broadcast(contents), hashlib.sha256(contents).hexdigest()


def _schema(df: DataFrame, **more: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name not in more] + [T.StructField(n, t) for n, t in more.items()])


def _with(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + list(columns.values()), names=kept + list(columns))


def _lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32)))


def _decoded(codec: Codec, ids: list[np.ndarray]) -> pa.Array:
    """Bytes that are no UTF-8 become U+FFFD."""
    return pa.array([codec.decode(x).tobytes().decode("utf-8", "replace") for x in ids], pa.string())


def _over(df: DataFrame, column: str, more: dict[str, T.DataType], work: Callable) -> DataFrame:
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            at = batch.column(batch.schema.get_field_index(column))
            bounds = flat(at)[1] if pa.types.is_string(at.type) or pa.types.is_large_string(at.type) else np.arange(len(at) + 1) * 65536
            for lo, hi in slices(bounds):
                yield _with(batch.slice(lo, hi - lo), work(at.slice(lo, hi - lo)))

    return df.mapInArrow(batches, _schema(df, **more))


_IDS, _TEXT = T.ArrayType(T.IntegerType()), T.StringType()


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the token ids of each whole text."""
    shared, digest = _shared(df.sparkSession, path)

    def work(at: pa.Array) -> dict[str, pa.Array]:
        codec = _codec(shared, digest)
        return {ids: _lists(codec.encode_all([t or "" for t in at.to_pylist()]))}

    return _over(df, text, {ids: _IDS}, work)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`df` with the text of each list of ids; a null list is an empty text."""
    shared, digest = _shared(df.sparkSession, path)

    def work(at: pa.Array) -> dict[str, pa.Array]:
        return {text: _decoded(_codec(shared, digest), [np.array(x or [], np.int64) for x in at.to_pylist()])}

    return _over(df, ids, {text: _TEXT}, work)


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """encode() and then decode() in one pass over the texts."""
    shared, digest = _shared(df.sparkSession, path)

    def work(at: pa.Array) -> dict[str, pa.Array]:
        codec = _codec(shared, digest)
        found = codec.encode_all([t or "" for t in at.to_pylist()])
        return {ids: _lists(found), decoded: _decoded(codec, found)}

    return _over(df, text, {ids: _IDS, decoded: _TEXT}, work)
