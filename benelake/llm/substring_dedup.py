"""Exact substring dedup by hashed windows in prefix-partitioned groups.

Every repeat of at least ``window`` words is a chain of repeated windows, so no
suffix tree is built: equal windows, with the smallest document id of each, say
all that the result needs. The windows of all texts are split by variable-length
prefixes: a window belongs to the group of its first word; where that prefix
heads more of them than a group may hold, of its first two words, and so on, so
that each group fits in a task's memory. A window is kept as a 64-bit hash,
called its path below; equal hashes count as equal windows, and are only ever
compared inside one group.

Documents are dealt into slices by a hash. A slice sends each distinct path
once, with the smallest id in the slice, so a passage that a third of all rows
hold costs one entry a slice, and learns one bit for it: whether a smaller id
exists elsewhere.

Edge cases: a null or empty text has no words; a text of fewer than ``window``
words has no window and is kept whole; rows with equal ids do not precede each
other; a row with a null id loses nothing and precedes none; other columns are
kept, helper columns get names that the input does not use.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benelake.llm import packed, text
from benelake.llm.tables import free_name, partitions, text_bytes, written

SLICE_BYTES = 4 << 20  # text of a slice of documents
GROUP_SUFFIXES = 1 << 20  # suffixes that a group should hold at most
WORD_BYTES = 6  # a low estimate, for the number of groups


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _windows(words: text.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Path fingerprint, first word and row of each window."""
    paths, first = text.ngrams(words, window)
    return paths, first, np.repeat(np.arange(len(words.rows) - 1), np.maximum(np.diff(words.rows) - window + 1, 0))


def _heavy_prefixes(docs: DataFrame, column: str, window: int, groups: int) -> np.ndarray:
    """Fingerprints of the prefixes that head more than a quarter of a group's
    share of all suffixes. There are at most 4 * groups * window of them."""

    def count(stream):
        for _, data, offsets in text.batches(stream, column):
            words = text.Words(data, offsets, text.SPACED)
            _, first, _ = _windows(words, window)
            least = max(32, len(first) // (4 * groups))
            found, counts = [np.zeros(1, text.U64)], [np.array([len(first)])]
            for depth in range(1, window):
                codes = text.runs(words.hashes, first, depth)
                ordered = np.sort(codes)
                at = np.flatnonzero(np.concatenate((ordered[:1] == ordered[:1], ordered[1:] != ordered[:-1])))
                n = np.diff(np.append(at, len(ordered)))
                found.append(ordered[at][n >= least])
                counts.append(n[n >= least])
                first = first[_is_in(codes, found[-1])]
                if not len(first):
                    break
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(counts))], ["prefix", "n"])

    counted = written(docs.select(column).mapInArrow(count, "prefix long, n long").groupBy("prefix").agg(F.sum("n").alias("n")))
    total = counted.where("prefix = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = counted.where((F.col("prefix") != 0) & (F.col("n") * 4 * groups >= total)).select("prefix").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(text.U64))


def _groups(words: text.Words, first: np.ndarray, window: int, heavy: np.ndarray, groups: int) -> np.ndarray:
    """Group of each suffix: by its shortest prefix that is not heavy."""
    codes = text.runs(words.hashes, first, 1)
    rest = np.flatnonzero(_is_in(codes, heavy))
    for depth in range(2, window + 1):
        if not len(rest):
            break
        codes[rest] = text.runs(words.hashes, first[rest], depth)
        rest = rest[_is_in(codes[rest], heavy)]
    return (codes % text.U64(groups)).astype(np.int32)


class _Slice:
    """The distinct paths of a slice, by group and path, with the smallest id
    of each; recomputed alike from the same rows in any order."""

    def __init__(self, table: pa.Table, id_column: str, column: str, window: int, heavy: np.ndarray, groups: int):
        self.data, self.offsets = text.utf8(table.column(column))
        self.words = text.Words(self.data, self.offsets, text.SPACED)
        paths, first, rows = _windows(self.words, window)
        ids = table.column(id_column).combine_chunks().cast(pa.int64())
        known = np.asarray(ids.is_valid())[rows]
        self.first = first = first[known]
        paths = paths[known]
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)[rows[known]]
        order = np.argsort(paths)
        paths = paths[order]
        new = np.concatenate((paths[:1] == paths[:1], paths[1:] != paths[:-1]))
        at = np.flatnonzero(new)
        self.smallest = np.minimum.reduceat(self.ids[order], at) if len(at) else np.zeros(0, np.int64)
        self.node = np.empty(len(order), np.int64)
        self.node[order] = np.cumsum(new) - 1
        self.paths = paths[at]
        inside = np.empty(len(order), np.int32)
        inside[:] = _groups(self.words, first, window, heavy, groups)
        group = inside[order[at]]
        self.by_group = np.argsort(group, kind="stable")
        group = group[self.by_group]
        cuts = np.flatnonzero(np.concatenate((group[:1] == group[:1], group[1:] != group[:-1])))
        self.parts = [(int(group[a]), self.by_group[a:b]) for a, b in zip(cuts, [*cuts[1:], len(group)], strict=False)]


def _compare(table: pa.Table) -> pa.Table:
    """One group: for each slice, which of its paths have a smaller id in
    another slice."""
    blobs = list(zip(table.column("paths").to_pylist(), table.column("smallest").to_pylist(), strict=True))
    paths = np.concatenate([packed.unpack(p) for p, _ in blobs])
    ids = [packed.unpack(s) for _, s in blobs]
    sizes = [len(x) for x in ids]
    ids = np.concatenate(ids)
    order = np.argsort(paths)
    paths = paths[order]
    at = np.flatnonzero(np.concatenate((paths[:1] == paths[:1], paths[1:] != paths[:-1])))
    least = np.minimum.reduceat(ids[order], at)
    later = np.empty(len(ids), bool)
    later[order] = ids[order] > np.repeat(least, np.diff(np.append(at, len(order))))
    bits = [np.packbits(x).tobytes() if x.any() else None for x in np.split(later, np.cumsum(sizes)[:-1])]
    return pa.table({"slice": table.column("slice").cast(pa.int32()), "part": table.column("part").cast(pa.int32()), "bits": pa.array(bits, pa.binary())}).filter(pa.array([b is not None for b in bits]))


def _kept_text(data: np.ndarray, offsets: np.ndarray, words: text.Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the kept words of each row, joined by a space."""
    rows = words.row_of()[kept]
    starts, ends = words.starts[kept], words.ends[kept].copy()
    more = np.zeros(len(rows), bool)
    more[:-1] = rows[1:] == rows[:-1]
    out = data.copy()
    out[ends[more]] = 0x20  # a separator stands there, since another word of the row follows
    ends[more] += 1
    change = np.zeros(len(data) + 1, np.int8)
    change[starts] += 1
    change[ends] -= 1
    lengths = np.bincount(rows, ends - starts, len(offsets) - 1).astype(np.int64)
    return out[np.cumsum(change[:-1], dtype=np.int8).astype(bool)], np.concatenate(([0], np.cumsum(lengths)))


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    column: str = "text",
    window: int = 13,
    kept_text: str | None = "kept_text",
    kept_sha256: str | None = None,
    slice_bytes: int = SLICE_BYTES,
    group_suffixes: int = GROUP_SUFFIXES,
) -> DataFrame:
    """All rows of ``docs`` with ``n_words``, ``n_removed`` and what is left.

    A word is removed if a window of ``window`` words around it also starts in
    a document with a smaller id, as the input stands. ``kept_text`` and
    ``kept_sha256`` name the columns for the words left, joined by one space,
    and for the hex digest of that; None leaves a column out. An input column
    of such a name is replaced. Ids are integers."""
    spark = docs.sparkSession
    size = text_bytes(docs, column)
    slices = max(partitions(spark), -(-size // slice_bytes))
    groups = max(partitions(spark), -(-size // (WORD_BYTES * group_suffixes)))
    heavy = _heavy_prefixes(docs, column, window, groups)
    at = free_name(docs, "slice")
    dealt = docs.withColumn(at, F.pmod(F.xxhash64(id_column, column), F.lit(slices)).cast("int"))

    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    added += [T.StructField(name, T.StringType()) for name in (kept_text, kept_sha256) if name]
    names = [f.name.lower() for f in added]
    carried = [f for f in docs.schema.fields if f.name.lower() not in names]
    body = free_name(docs, "body") if column.lower() in names else column
    carry = dealt.select(at, *[F.col(f"`{f.name}`") for f in carried], *([F.col(column).alias(body)] if body != column else []))
    if id_column.lower() in names:
        raise ValueError(f"{id_column} can't be replaced")

    def send(table: pa.Table) -> pa.Table:
        own = _Slice(table, id_column, body, window, heavy, groups)
        number = table.column(at)[0].as_py()
        return pa.table({
            "part": pa.array([g for g, _ in own.parts], pa.int32()),
            "slice": pa.array([number] * len(own.parts), pa.int32()),
            "paths": pa.array([packed.pack(own.paths[i], True) for _, i in own.parts], pa.binary()),
            "smallest": pa.array([packed.pack(own.smallest[i]) for _, i in own.parts], pa.binary()),
        })

    # the same exchange of the texts serves both uses of ``carry``
    sent = carry.groupBy(at).applyInArrow(send, "part int, slice int, paths binary, smallest binary")
    told = sent.groupBy("part").applyInArrow(_compare, "slice int, part int, bits binary")

    def strip(table: pa.Table, bits: pa.Table) -> pa.Table:
        own = _Slice(table, id_column, body, window, heavy, groups)
        earlier = np.zeros(len(own.paths), bool)
        answers = dict(zip(bits.column("part").to_pylist(), bits.column("bits").to_pylist(), strict=True))
        for part, i in own.parts:
            if part in answers:
                earlier[i] = np.unpackbits(np.frombuffer(answers[part], np.uint8), count=len(i)).astype(bool)
        repeated = own.first[earlier[own.node] | (own.ids > own.smallest[own.node])]
        change = np.zeros(len(own.words.hashes) + 1, np.int32)
        change[repeated] += 1
        change[repeated + window] -= 1
        gone = np.cumsum(change[:-1]) > 0
        rows = own.words.rows
        removed = np.concatenate(([0], np.cumsum(gone)))
        out = {f.name: table.column(f.name) for f in carried}
        out["n_words"] = pa.array(np.diff(rows))
        out["n_removed"] = pa.array(removed[rows[1:]] - removed[rows[:-1]])
        left, ends = _kept_text(own.data, own.offsets, own.words, ~gone)
        if kept_text:
            out[kept_text] = text.to_strings(left, ends).cast(pa.string())
        if kept_sha256:
            view = memoryview(np.ascontiguousarray(left))
            out[kept_sha256] = pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.string())
        return pa.table(out)

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in carried] + added)
    return carry.groupBy(at).cogroup(told.groupBy("slice")).applyInArrow(strip, schema)
