"""Repeated passages, by suffix arrays over shards of the text.

A window (`length` bytes) is repeated if the same bytes start anywhere else. Each window has an anchor, the least hash of
the strings of 64 bytes in it, so equal windows have equal anchors. Neighbouring windows with one anchor form a run; runs whose anchor is
alone in the corpus have no repeated window. The others meet by anchor: equal runs are counted as one with a
multiplicity, and the different runs of an anchor lie in one shard, where a suffix array is built by induced sorting and the
permuted common prefixes tell which windows share `length` bytes with a neighbour in it. Repeated windows go back to all places
of their runs, and a text's repeated windows are merged into byte spans.

Equal texts are one text with a multiplicity throughout. A shard is about 64 KB, whose arrays stay in the processor's cache, cut between anchors. An anchor with more than
`crowd` different runs would outgrow its shard: such runs are texts in their turn, each different one once, and are cut again by
longer anchors. Texts that share less than that anchor part ways. At the last level the anchor is the window itself:
the runs of a crowd there are stretches of one repeated byte that differ only in their number of windows, all of them
the same window, so each such run is repeated whole. Equal runs are told by anchor and a 64-bit digest, 128 bits in
all. Matches never cross documents.

`remove_repeats` can also take passages by number of words (runs of ASCII letters and digits and of other characters): a
text's words and what parts them become codes of fixed length, and windows of those codes are looked for in the same way, so a
passage of that many words goes however few bytes it has.

Null texts count as empty. Rows are matched by the digest of their text, so ids may be null or repeat. Extra columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.arrowmap import lists, over_texts, release
from daybook.llm.byteops import SLICE_BYTES, flat, mix, prefix, ranges, slices
from daybook.llm.registry import in_passing, staged
from daybook.llm.sais import permuted_prefixes, suffix_array

LENGTH = 400
ANCHORS = (64, 336, 392, 400)  # bytes; each next one for the crowds of the one before
CROWD = 200
SHARD_BYTES = 1 << 16
RUN_BYTES = 1 << 18  # of text whose runs are looked for at once

_RUNS = T.ArrayType(
    T.StructType(
        [
            T.StructField("anchor", T.LongType()),
            T.StructField("digest", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("windows", T.LongType()),
            T.StructField("own", T.BooleanType()),
        ]
    )
)
_LOW = np.uint64(0xFFFFFFFF)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def _whole(raw: np.ndarray, start: np.ndarray, end: np.ndarray, p: np.ndarray) -> np.ndarray:
    return mix(ranges(p, start, end) + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def anchored_runs(column: pa.Array, length: int, anchor: int) -> pa.Array:
    """The runs of each text. `own`: its anchor is not at one place in all windows, so that the run may repeat itself.

    Equal windows have their leftmost anchor equally far from their start, and within a run that place only moves on.
    """
    raw, bounds = flat(column)
    n, sizes = len(column), np.diff(bounds)
    if len(raw) < length or not (sizes >= length).any():
        empty = pa.array([], _arrow_run())
        return lists(empty, np.zeros(n, np.int64))
    p = prefix(raw.astype(np.uint64) + np.uint64(1))
    at = np.arange(len(raw) - anchor + 1)
    hashes = mix(ranges(p, at, at + anchor))
    high, place, width = hashes & ~_LOW, at.astype(np.uint64), length - anchor + 1
    first = (_least(high | place, width) & _LOW).astype(np.int64)
    valid = np.zeros(len(first) + 1, bool)
    row = np.repeat(np.arange(n), sizes)[: len(first)]
    valid[:-1] = np.arange(len(first)) + length <= bounds[row + 1]
    least = hashes[first]
    fresh = valid[:-1].copy()
    fresh[1:] &= (least[1:] != least[:-1]) | (row[1:] != row[:-1]) | ~valid[:-2]
    start = np.flatnonzero(fresh)
    # A run ends before the next one, or with the last window of its text.
    end = np.minimum(np.append(start[1:], len(first)), bounds[row[start] + 1] - length + 1)
    own = first[end - 1] != first[start]
    digest = _whole(raw, start, end - 1 + length, p)
    struct = pa.StructArray.from_arrays(
        [
            pa.array(least[start].view(np.int64)),
            pa.array(digest.view(np.int64)),
            pa.array(start - bounds[row[start]]),
            pa.array(end - start),
            pa.array(own),
        ],
        fields=list(_arrow_run()),
    )
    return lists(struct, np.bincount(row[start], minlength=n))


def _arrow_run() -> pa.StructType:
    return pa.struct(
        [("anchor", pa.int64()), ("digest", pa.int64()), ("start", pa.int64()), ("windows", pa.int64()), ("own", pa.bool_())]
    )


_PIECE = "anchor long, digest long, piece binary, crowded boolean"


def _cut(length: int):
    """(text, wanted runs) -> the bytes of each wanted run."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "digest", "piece", "crowded"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
        for batch in batches:
            for i in range(len(batch)):
                text = batch.column(0)[i].as_py()
                data = text.encode() if isinstance(text, str) else text
                rows, size = [], 0
                for r in batch.column(1)[i].as_py():
                    rows.append((r["anchor"], r["digest"], data[r["start"] : r["start"] + r["windows"] - 1 + length], r["crowded"]))
                    size += len(rows[-1][2])
                    if size >= SLICE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    return work


def repeated_windows(pieces: list[bytes], length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each piece the runs [from, to) of windows that also start elsewhere in the pieces, by their suffix array."""
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    values, coded = np.unique(raw, return_inverse=True)
    kind = np.uint8 if len(values) < 254 else np.uint16
    s = np.ones(len(raw) + len(pieces) + 1, kind)  # 1 after each piece, 0 at the end
    s[np.arange(len(raw)) + np.repeat(np.arange(len(pieces)), sizes)] = coded.astype(kind) + 2
    s[-1] = 0
    array = suffix_array(s)
    shared = permuted_prefixes(s, array)
    most = shared.copy()  # with the suffix before and with the one after
    most[array[:-1]] = np.maximum(most[array[:-1]], shared[array[1:]])
    out = []
    for k, end in enumerate(ends.tolist()):
        size = int(sizes[k])
        start = end - size + k
        hit = most[start : start + max(0, size - length + 1)] >= length
        edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
        out.append((np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)))
    return out


_FOUND = "anchor long, digest long, from long, to long"


def _shards(length: int, shard_bytes: int):
    """Pieces sorted by anchor -> their repeated windows, shard by shard; an anchor's pieces stay together."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        anchors, digests, begin, end = [], [], [], []
        for (anchor, digest, _), (a, b) in zip(rows, repeated_windows([r[2] for r in rows], length)):
            anchors += [anchor] * len(a)
            digests += [digest] * len(a)
            begin.append(a)
            end.append(b)
        if anchors:
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors), pa.array(digests), pa.array(np.concatenate(begin)), pa.array(np.concatenate(end))],
                names=["anchor", "digest", "from", "to"],
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if size >= shard_bytes and row[0] != rows[-1][0]:
                    yield from solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[2])
        if rows:
            yield from solve(rows)
        release()

    return work


def _runs(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """(key, runs) of the rows (key, text)."""
    return over_texts(texts, "text", {"runs": _RUNS}, lambda c: {"runs": anchored_runs(c, length, anchor)}, RUN_BYTES).select("key", "runs")


def _repeated(runs: DataFrame, texts: DataFrame, length: int, anchors: tuple[int, ...], crowd: int, shard_bytes: int) -> DataFrame:
    """(key, spans) of repeated windows, a row for each run. runs: (key, anchor, digest, start, windows, own), texts: (key, text); keys are different texts."""
    # Different runs with their number and one place; and how many each anchor has.
    place = F.struct("key", "start", "windows", "own")
    different = runs.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("at"))
    different = staged(different.select("anchor", "digest", "n", "at.*"), "different")
    totals = different.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total"), F.max("own").alias("any_own")
    ).where("total > 1 or any_own")
    shared = staged(different.join(totals, "anchor").withColumn("crowded", F.col("kinds") > crowd), "shared")
    found = shared.where("n > 1").select("anchor", "digest", F.lit(0).cast("long").alias("from"), F.col("windows").alias("to"))
    if len(anchors) == 1:
        # The windows of an anchor are all the same one: a crowd is repeated whole, without its bytes.
        whole = shared.where("crowded and n = 1").select("anchor", "digest", F.lit(0).cast("long").alias("from"), F.col("windows").alias("to"))
        found = found.unionByName(whole)
        shared = shared.where("not crowded")
    # Bytes are needed where an anchor has different runs or a run that may repeat itself.
    wanted = F.collect_list(F.struct("anchor", "digest", "start", "windows", "crowded")).alias("wanted")
    wanted = shared.where("kinds > 1 or own").groupBy("key").agg(wanted)
    pieces = staged(texts.join(wanted, "key").select("text", "wanted").mapInArrow(_cut(length), _PIECE), "pieces")
    few = pieces.where("not crowded").select("anchor", "digest", "piece")
    few = few.repartition("anchor").sortWithinPartitions("anchor", "digest").mapInArrow(_shards(length, shard_bytes), _FOUND)
    found = found.unionByName(few)
    many = pieces.where("crowded")
    if len(anchors) > 1 and not many.isEmpty():
        many = many.select(F.concat_ws("/", "anchor", "digest").cast("binary").alias("key"), F.col("piece").alias("text"))
        finer = staged(_runs(many, length, anchors[1]), "runs").select("key", F.inline("runs"))
        finer = _repeated(finer, many, length, anchors[1:], crowd, shard_bytes).select("key", F.inline("spans"))
        parts = F.split(F.col("key").cast("string"), "/")
        found = found.unionByName(finer.select(parts[0].cast("long").alias("anchor"), parts[1].cast("long").alias("digest"), "from", "to"))
    # One row for each run, however many places of it were found, before it goes back to all the places of the run.
    found = found.groupBy("anchor", "digest").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    found = staged(found.mapInArrow(_merged_spans, "anchor long, digest long, spans array<struct<from:long,to:long>>"), "repeated")
    back = runs.select("key", "anchor", "digest", "start").join(found, ["anchor", "digest"])
    moved = F.transform("spans", lambda x: F.struct((F.col("start") + x["from"]).alias("from"), (F.col("start") + x["to"]).alias("to")))
    return back.select("key", moved.alias("spans"))


def union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals [start, end) merged where they meet or overlap."""
    if len(starts) < 2:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[first], reach[np.append(np.flatnonzero(first)[1:] - 1, len(reach) - 1)]


def _merged_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(2)
        bounds, flat_ = np.asarray(column.offsets), column.values
        begin, end = (flat_.field(k).to_numpy() for k in (0, 1))
        merged = [union(begin[lo:hi], end[lo:hi]) for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        struct = pa.StructArray.from_arrays([pa.array(np.concatenate([m[k] for m in merged] or [begin[:0]])) for k in (0, 1)], ["from", "to"])
        counts = np.array([len(m[0]) for m in merged], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists(struct, counts)], names=["anchor", "digest", "spans"])


def spans(
    df: DataFrame, text: str, length: int = LENGTH, anchors: tuple[int, ...] = ANCHORS, crowd: int = CROWD, shard_bytes: int = SHARD_BYTES,
    code: Callable[[pa.Array], pa.Array] | None = None,
) -> DataFrame:
    """(key, copies, spans): for each different text its number of rows and the runs of repeated windows, unmerged.

    Texts without any have no row; key is the MD5 digest of the text. The last of `anchors` is the length itself.
    code: the bytes to search in place of each text; they are made in the task that looks for their runs.
    """
    if anchors[-1] != length or sorted(anchors) != list(anchors):
        raise ValueError("anchors must grow up to the length")
    texts = df.select(F.coalesce(F.col(text), F.lit("").cast(df.schema[text].dataType)).alias("text"))
    digest = F.unhex(F.md5("text")).alias("key")
    if code is None:
        rows = _runs(texts.select("text", digest), length, anchors[0])
    else:

        def coded_runs(column: pa.Array) -> dict[str, pa.Array]:
            codes = code(column)
            return {"text": codes, "runs": anchored_runs(codes, length, anchors[0])}

        rows = over_texts(texts, "text", {"text": T.BinaryType(), "runs": _RUNS}, coded_runs, RUN_BYTES).select(digest, "runs")
        texts = over_texts(texts, "text", {"text": T.BinaryType()}, lambda c: {"text": code(c)}, RUN_BYTES)
    rows = staged(rows, "runs")
    counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.any_value("runs").alias("runs"))
    distinct = staged(counted.where("size(runs) > 0"), "texts")
    # Copies of a text are one row per map task before the exchange, which the join with the wanted runs then shares.
    holders = texts.groupBy(digest).agg(F.any_value("text").alias("text"))
    windows = _repeated(distinct.select("key", F.inline("runs")), holders, length, anchors, crowd, shard_bytes)
    by_text = windows.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    copied = distinct.where("copies > 1").select("key", "copies")
    return by_text.join(copied, "key", "full").select("key", F.coalesce("copies", F.lit(1).cast("long")).alias("copies"), "spans")


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_IN_WORD = np.array([bool(_WORD.match(bytes([b]))) for b in range(256)])
_CODE = 6  # bytes: four for a word, two for what stands between it and the next


def word_codes(column: pa.Array) -> pa.Array:
    """Each text's words in order, as codes of `_CODE` bytes."""
    raw, bounds = flat(column)
    n = len(column)
    inside = np.concatenate([[False], _IN_WORD[raw], [False]])
    cut = np.zeros(len(raw) + 1, bool)
    cut[bounds] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    row = np.searchsorted(bounds, start, side="right") - 1
    following = np.minimum(np.append(start[1:], len(raw)), bounds[row + 1])
    p = prefix(raw.astype(np.uint64) + np.uint64(1))
    codes = np.empty((len(start), _CODE), np.uint8)
    codes[:, :4] = (_whole(raw, start, end, p) >> np.uint64(32)).astype(np.uint32).view(np.uint8).reshape(-1, 4)
    codes[:, 4:] = (_whole(raw, end, following, p) >> np.uint64(48)).astype(np.uint16).view(np.uint8).reshape(-1, 2)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]) * _CODE
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(codes.tobytes())]).cast(pa.binary())


_REMOVED = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _word_spans(whole: bytes, copies: int, windows: list[dict] | None, words: int) -> list[tuple[int, int]]:
    """The bytes of the repeated windows of `words` words; windows are places in the text's codes."""
    if copies == 1 and not windows:
        return []
    at = np.array([m.span() for m in _WORD.finditer(whole)], np.int64).reshape(-1, 2)
    last, out = len(at) - words, []  # the last window's first word
    for w in [{"from": 0, "to": last * _CODE + 1}] if copies > 1 else windows:
        first, end = -(-w["from"] // _CODE), -(-w["to"] // _CODE)
        if first < end <= last + 1:
            out.append((int(at[first, 0]), int(at[end - 1 + words - 1, 1])))
    return out


def _remove(length: int, text: str, as_text: bool, words: int | None):
    def one(whole: bytes, copies: int | None, windows: list[dict] | None, word_copies: int | None, word_windows: list[dict] | None):
        if (copies or 1) > 1 and len(whole) >= length:
            found = [(0, len(whole))]
        else:
            found = [(w["from"], w["to"] - 1 + length) for w in windows or []]
        if words:
            found += _word_spans(whole, word_copies or 1, word_windows, words)
        if not found:
            none = np.empty(0, np.int64)
            return none, none, whole
        starts, ends = union(*np.array(found, np.int64).T)
        edges = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(whole)]
        return starts, ends, b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for wide in batches:
            bounds = flat(wide.column(wide.schema.get_field_index(text)))[1]
            for lo, hi in slices(bounds):
                batch = wide.slice(lo, hi - lo)
                data = [(t or "").encode() for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
                none = [None] * len(data)
                told = [batch.column(c).to_pylist() for c in ("_copies", "_spans")]
                told += [batch.column(c).to_pylist() for c in ("_word_copies", "_word_spans")] if words else [none, none]
                made = [one(*row) for row in zip(data, *told)]
                names = [n for n in batch.schema.names if n not in ("_copies", "_spans", "_word_copies", "_word_spans")]
                ends = [pa.array(np.concatenate([m[k] for m in made] or [np.empty(0, np.int64)])) for k in (0, 1)]
                counts, kept = np.array([len(m[0]) for m in made], np.int64), [m[2] for m in made]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(n) for n in names]
                    + [pa.array([len(d) for d in data], pa.int64()), lists(pa.StructArray.from_arrays(ends, ["start", "end"]), counts), pa.array(kept, pa.binary())]
                    + [pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())] * as_text,
                    names=[*names, "n_bytes", "removed", "kept"] + ["kept_text"] * as_text,
                )
        release()

    return work


def remove_repeats(df: DataFrame, text: str = "text", length: int = LENGTH, as_text: bool = False, words: int | None = None, **settings) -> DataFrame:
    """`df` with n_bytes, removed (maximal byte runs) and kept (the other bytes); columns of these names are replaced.

    as_text: kept_text as well, without the characters that a removal has cut in two. words: passages of that many words
    (12 at least) that start elsewhere too go as well.
    """
    found = in_passing(lambda: spans(df, text, length, **settings), "spans")
    made = ["n_bytes", "removed", "kept"] + ["kept_text"] * as_text
    own = [c for c in df.columns if c not in made]
    rows = df.select(own).withColumn("_key", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))))
    rows = rows.join(found.select(F.col("key").alias("_key"), F.col("copies").alias("_copies"), F.col("spans").alias("_spans")), "_key", "left")
    if words:
        codes = lambda d: over_texts(d, text, {"_codes": T.BinaryType()}, lambda c: {"_codes": word_codes(c)}, RUN_BYTES)
        # The last word of a window goes without what follows it.
        size = words * _CODE - 2
        anchors = (64, size - 64, size - 8, size) if size > 136 else (size - 8, size)
        found = in_passing(lambda: spans(df, text, size, anchors, code=word_codes), "word_spans")
        rows = codes(rows).withColumn("_word_key", F.unhex(F.md5("_codes"))).drop("_codes")
        found = found.select(F.col("key").alias("_word_key"), F.col("copies").alias("_word_copies"), F.col("spans").alias("_word_spans"))
        rows = rows.join(found, "_word_key", "left").drop("_word_key")
    schema = T.StructType(
        [df.schema[c] for c in own]
        + [T.StructField(n, k) for n, k in zip(made, (T.LongType(), _REMOVED, T.BinaryType(), T.StringType()))]
    )
    return rows.drop("_key").mapInArrow(_remove(length, text, as_text, words), schema)
