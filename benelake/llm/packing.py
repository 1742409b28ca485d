"""Best-fit packing of token sequences by patterns.

Documents become pieces of at most ``most`` tokens. Packing works on the
histogram of piece lengths alone, which is no larger than ``most`` however many
pieces there are: all patterns of one to three lengths that fill a sequence
exactly are enumerated, non-negative least squares fits how often each is used
so that the patterns' lengths add up to the histogram (coordinate descent on
many disjoint patterns at a time), the counts are rounded down to what the
histogram holds, and the pieces left over are packed best-fit, longest first,
again by counts; of several roundings the one with the fewest sequences stays. The result is a list of patterns with repeat counts; Spark
numbers the pieces of each length and gives the k-th piece the k-th slot.

Edge cases: a null or empty text is its end token alone; only documents longer
than ``most`` are cut, the first piece takes the remainder; rows of equal ids
are packed each for itself; no rows give no sequences.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from benelake.llm import text
from benelake.llm.tables import partitions, written
from benelake.llm.tokens import BLOCK, Encoder

MOST = 1024
SWEEPS = 150
SCALES = (1.0, 0.95, 0.9, 0.8, 0.7, 0.5, 0.0)
BUCKET_ROWS = 50_000
PIECES = 1_000_000  # distinct pieces of text that a worker remembers

Pattern = tuple[int, ...]


def token_pieces(docs: DataFrame, path: str, end: int, most: int = MOST, id_column: str = "doc_id", column: str = "text", with_ids: bool = False) -> DataFrame:
    """One row for each piece: ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32`` and, on demand, ``ids``."""

    def run(stream):
        coder = Encoder.of(path, PIECES)
        for batch, data, offsets in text.batches(stream, "text", BLOCK):
            ids, rows = coder.encode(data, offsets, end)
            n = np.diff(rows)
            pieces = -(-n // most)
            owner = np.repeat(np.arange(len(n)), pieces)
            number = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(pieces)[:-1])), pieces)
            first = n - most * (pieces - 1)
            start = np.where(number > 0, first[owner] + (number - 1) * most, 0)
            length = np.where(number > 0, most, first[owner])
            view = memoryview(ids).cast("B")
            at = rows[owner] + start
            crc = [zlib.crc32(view[4 * a : 4 * (a + b)]) for a, b in zip(at.tolist(), length.tolist(), strict=True)]
            out = [batch.column(0).take(pa.array(owner)), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.ListArray.from_arrays(pa.array(np.concatenate((at, rows[-1:])), pa.int32()), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_column).alias("doc_id"), F.col(column).alias("text")).mapInArrow(run, schema)


def _patterns(lengths: np.ndarray, most: int) -> np.ndarray:
    """All of one to three of the given lengths that add up to ``most``: three
    columns in ascending order, 0 for none."""
    have = np.zeros(most + 1, bool)
    have[lengths] = True
    have[0] = True
    a, b = np.meshgrid(np.flatnonzero(have), np.flatnonzero(have), indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = most - a - b
    keep = (a <= b) & (b <= c)
    a, b, c = a[keep], b[keep], c[keep]
    keep = have[c]
    return np.stack((a[keep], b[keep], c[keep]), 1)


def _nnls(patterns: np.ndarray, histogram: np.ndarray, sweeps: int) -> np.ndarray:
    """How often to use each pattern: min |histogram - uses|**2, uses >= 0."""
    x = np.zeros(len(patterns))
    left = histogram.astype(float).copy()
    left[0] = 0
    a, b, c = patterns.T
    ones = [(p > 0).astype(float) for p in (a, b, c)]
    # a length that stands k times in a pattern has k in its column
    norm = sum(o * o for o in ones) + 2 * ((a == b) * ones[0] + (b == c) * ones[1] + (a == c) * ones[0])
    for _ in range(sweeps):
        slope = left[a] * ones[0] + left[b] * ones[1] + left[c] * ones[2]
        step = np.maximum(slope / norm, -x)
        gain = step * (2 * slope - step * norm)
        order = np.argsort(-gain)[: 8 * len(histogram)]
        used = np.zeros(len(histogram), bool)
        chosen = []
        for j in order.tolist():
            if gain[j] < 0.5:
                break
            p = patterns[j]
            if used[p[2]] or used[p[1]] and p[1] or used[p[0]] and p[0]:
                continue
            used[p] = True
            chosen.append(j)
        if not chosen:
            break
        x[chosen] += step[chosen]
        for k in range(3):
            np.subtract.at(left, patterns[chosen, k], step[chosen] * ones[k][chosen])
        left[0] = 0
    return x


def _best_fit(histogram: np.ndarray, most: int) -> list[tuple[Pattern, int]]:
    """Longest first, each into the fullest open sequence that has room; equal
    sequences and equal pieces are handled together."""
    room: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)
    for length in range(most, 0, -1):
        n = int(histogram[length])
        space = length
        while n and space <= most:
            if not room.get(space):
                space += 1
                continue
            pattern, count = room[space].pop()
            if count > n:
                room[space].append((pattern, count - n))
                count = n
            room[space - length].append(((*pattern, length), count))
            n -= count
            if space - length >= length:
                space = length
        if n:
            each = most // length
            if n >= each:
                room[most - each * length].append(((length,) * each, n // each))
            if n % each:
                room[most - n % each * length].append(((length,) * (n % each), 1))
    return [x for group in room.values() for x in group]


def pack_histogram(histogram: np.ndarray, most: int = MOST, sweeps: int = SWEEPS) -> list[tuple[Pattern, int]]:
    """Patterns with repeat counts that use exactly the pieces of the histogram
    (index: length). The fitted counts are rounded down after scaling by each
    of ``SCALES``: the less they take, the better the rest mixes; the rounding
    that needs the fewest sequences is kept. With 0 all are packed best-fit."""
    whole = histogram.astype(np.int64).copy()
    whole[0] = 0
    patterns = _patterns(np.flatnonzero(whole), most)
    uses = _nnls(patterns, whole, sweeps) if len(patterns) else np.zeros(0)
    plans = []
    for scale in SCALES:
        left, plan = whole.copy(), []
        counts = np.floor(uses * scale + 1e-6).astype(np.int64)
        for j in np.argsort(-counts, kind="stable"):
            if not counts[j]:
                break
            own = [int(p) for p in patterns[j] if p]
            n = min(int(counts[j]), *(int(left[p]) // own.count(p) for p in own))
            if n:
                plan.append((tuple(own), n))
                for p in own:
                    left[p] -= n
        plans.append(plan + _best_fit(left, most))
    return min(plans, key=lambda plan: sum(n for _, n in plan))


def _slots(plan: list[tuple[Pattern, int]]) -> tuple[np.ndarray, ...]:
    """Slots by length: for the slots from number ``rank`` on, the sequence of
    the first and the offset; sorted by length and rank."""
    given: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, n in plan:
        offset = 0
        for length in pattern:
            rows.append((length, given[length], sequence, offset))
            given[length] += n
            offset += length
        sequence += n
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 4


def pack_pieces(pieces: DataFrame, most: int = MOST) -> DataFrame:
    """``pieces`` (with ``doc_id``, ``piece``, ``length``; read several times,
    so a written table) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    histogram = np.zeros(most + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most ``most`` rows
        histogram[r["length"]] = r["count"]
    slots = spark.sparkContext.broadcast(_slots(pack_histogram(histogram, most)))

    # the number of a piece among those of its length: buckets are counted
    # first, so no task sorts all pieces of a length
    buckets = max(partitions(spark), -(-int(histogram.sum()) // BUCKET_ROWS))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("inside", inside).join(base, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("inside"))
    rows = ranked.select(*pieces.columns, "rank")
    names = pieces.columns
    at = names.index("length")

    def place(stream):
        lengths, ranks, sequences, offsets = slots.value
        for batch in stream:
            length, rank = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in (batch.column(at), batch.column(len(batch.columns) - 1)))
            # both sorted by length, then rank; a rank is below 2**40
            i = np.searchsorted(lengths << 40 | ranks, length << 40 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequences[i] + rank - ranks[i]), pa.array(offsets[i])], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"
    return rows.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str, end: int, most: int = MOST, id_column: str = "doc_id", column: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``: a row for each piece with its place."""
    return pack_pieces(written(token_pieces(docs, path, end, most, id_column, column, with_ids)), most)
