"""Benchmark decontamination by winnowing.

Of every run of ``window`` words, the smallest hash of its ``gram``-word grams
is its fingerprint, so two runs that are equal have the same one: every span of
at least ``window`` shared words is found. Fingerprints of documents are joined
with those of the benchmark, and only runs whose fingerprint joins are extended
to the whole run and compared over all its words (64-bit hash of the run). An
item of fewer words than ``window`` is one run of its own length, compared
directly.

Benchmark items are few next to the documents. They are read in blocks of at
most ``block_bytes`` of text (or one longer item); each block is sent to the
tasks, which scan all documents against it. One block needs no shuffle; of
several, each pass writes what it found so far in the shared folder, so memory
stays bounded however large the benchmark is.

Edge cases: a null or empty text has no words and no hits; an item without
words or without an id is left out; items of one id count once; other columns
are kept; an input column with the name of a result is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benelake.llm import text
from benelake.llm.tables import free_name, text_bytes, written

WINDOW, GRAM = 10, 5
BLOCK_BYTES = 8 << 20


class _Keys:
    """A set of 64-bit keys with the items of each."""

    def __init__(self, keys: np.ndarray, items: np.ndarray):
        order = np.lexsort((items, keys))
        keys, items = keys[order], items[order]
        new = np.concatenate((keys[:1] == keys[:1], keys[1:] != keys[:-1]))
        self.keys = keys[new]
        self.at = np.append(np.flatnonzero(new), len(keys))
        self.items = items
        self.seen = np.zeros(1 << 20, bool)  # by the low bits: most lookups end here
        self.seen[(self.keys & text.U64((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the keys that are there, and their places."""
        maybe = np.flatnonzero(self.seen[(keys & text.U64((1 << 20) - 1)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        there = self.keys[place] == keys[maybe]
        return maybe[there], place[there]


def _fingerprints(words: text.Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest gram hash of each run of ``window`` words, and the run's
    first word."""
    counts = np.diff(words.rows)
    room = np.maximum(counts - window + 1, 0)
    first = np.repeat(words.rows[:-1] - np.concatenate(([0], np.cumsum(room)[:-1])), room) + np.arange(room.sum())
    if not len(first):
        return np.zeros(0, text.U64), first
    grams = np.full(len(words.hashes), ~text.U64(0))
    grams[: len(grams) - gram + 1] = text.runs(words.hashes, np.arange(len(grams) - gram + 1), gram)
    least = grams[first]
    for i in range(1, window - gram + 1):
        np.minimum(least, grams[first + i], out=least)
    return least, first


class _Items:
    """One block of benchmark items, ready for lookups."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int, gram: int):
        self.ids, self.window, self.gram = ids, window, gram
        data, offsets = text.utf8(pa.array(texts, pa.large_string()))
        words = text.Words(data, offsets, text.ALNUM, text.LOWER)
        counts = np.diff(words.rows)
        self.runs: dict[int, _Keys] = {}
        for n in [int(x) for x in np.unique(counts[(counts > 0) & (counts < window)])]:
            row = np.flatnonzero(counts == n)
            self.runs[n] = _Keys(text.runs(words.hashes, words.rows[row], n), row)
        least, first = _fingerprints(words, window, gram)
        if len(first):
            row = words.row_of()[first]
            self.runs[window] = _Keys(text.runs(words.hashes, first, window), row)
            self.marks = _Keys(least, row)

    def scan(self, words: text.Words) -> tuple[np.ndarray, list[set[int]]]:
        """Which words are hit, and the items of each row."""
        change = np.zeros(len(words.hashes) + 1, np.int32)
        found: list[set[int]] = [set() for _ in range(len(words.rows) - 1)]
        for n, keys in self.runs.items():
            if n == self.window:
                least, first = _fingerprints(words, n, self.gram)
                first = first[self.marks.find(least)[0]]
                codes = text.runs(words.hashes, first, n)
            else:
                codes, first = text.ngrams(words, n)
            at, place = keys.find(codes)
            first = first[at]
            change[first] += 1
            change[first + n] -= 1
            row = np.searchsorted(words.rows, first, "right") - 1
            for r, k in {(r, k) for r, k in zip(row.tolist(), place.tolist(), strict=True)}:
                found[r].update(keys.items[keys.at[k] : keys.at[k + 1]].tolist())
        return np.cumsum(change[:-1]) > 0, found


def find_contamination(docs: DataFrame, benchmark: DataFrame, column: str = "text", item_id: str = "item_id", item_column: str = "text", window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All rows of ``docs`` with ``n_words``, ``hit_spans`` (first word and
    number of words of each stretch of hit words), ``n_hit``, ``item_ids``
    (strings, sorted), ``n_items`` and ``contaminated``. Words in windows of an
    item without an id are hit too; such an item is in no list and count."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_column).alias("text")).where("text is not null").distinct()
    blocks = max(1, -(-text_bytes(items) // block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    results = {"n_words": T.LongType(), "hit_spans": T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("n", T.LongType())])), "n_hit": T.LongType(), "item_ids": T.ArrayType(T.StringType()), "n_items": T.LongType(), "contaminated": T.BooleanType()}
    if column.lower() in results:
        raise ValueError(f"{column} can't be replaced")
    carried = [f for f in docs.schema.fields if f.name.lower() not in results]
    frame = docs.select(*[F.col(f"`{f.name}`") for f in carried])
    bits, names = free_name(docs, "hit_bits"), free_name(docs, "hit_items")
    between = T.StructType([*carried, T.StructField(bits, T.BinaryType()), T.StructField(names, T.ArrayType(T.StringType()))])
    last = T.StructType([*carried, *[T.StructField(k, v) for k, v in results.items()]])
    span = pa.struct([("first", pa.int64()), ("n", pa.int64())])

    def scan_with(block, is_first: bool, is_last: bool):
        def scan(stream):
            known = _Items(*block.value, window, gram)
            for batch, data, offsets in text.batches(stream, column):
                words = text.Words(data, offsets, text.ALNUM, text.LOWER)
                hit, found = known.scan(words)
                rows = words.rows
                ids = [{known.ids[i] for i in row} - {None} for row in found]
                if not is_first:
                    old = batch.column(batch.schema.get_field_index(bits)).to_pylist()
                    hit |= np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=b - a) for x, a, b in zip(old, rows[:-1], rows[1:], strict=True)] or [np.zeros(0, np.uint8)]).astype(bool)
                    ids = [a.union(b) for a, b in zip(ids, batch.column(batch.schema.get_field_index(names)).to_pylist(), strict=True)]
                ids = pa.array([sorted(x) for x in ids], pa.list_(pa.string()))
                out = [batch.column(batch.schema.get_field_index(f.name)) for f in carried]
                if not is_last:
                    packed = [np.packbits(hit[a:b]).tobytes() for a, b in zip(rows[:-1], rows[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([*out, pa.array(packed, pa.binary()), ids], between.names)
                    continue
                edge = np.zeros(len(hit) + 1, bool)
                edge[rows[:-1]] = True
                start = np.flatnonzero(hit & (edge[:-1] | ~np.concatenate(([False], hit[:-1]))))
                end = np.flatnonzero(hit & (np.concatenate((edge[1:-1], [True])) | ~np.concatenate((hit[1:], [False])))) + 1 if len(hit) else start
                row = np.searchsorted(rows, start, "right") - 1
                spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(start, rows), pa.int32()), pa.StructArray.from_arrays([pa.array(start - rows[row]), pa.array(end - start)], fields=list(span)))
                total = np.concatenate(([0], np.cumsum(hit)))
                n_hit = total[rows[1:]] - total[rows[:-1]]
                yield pa.RecordBatch.from_arrays([*out, pa.array(np.diff(rows)), spans, pa.array(n_hit), ids, pa.array([len(x) for x in ids], pa.int64()), pa.array(n_hit > 0)], last.names)

        return scan

    for b in range(blocks):
        rows = items.where(F.col("block") == b).collect()
        block = spark.sparkContext.broadcast(([r["id"] for r in rows], [r["text"] for r in rows]))
        end = b == blocks - 1
        frame = frame.mapInArrow(scan_with(block, b == 0, end), last if end else between)
        if not end:
            frame = written(frame)
    return frame
