"""Exact n-gram Jaccard self-join over size-banded tiles.

A document is the set of its word shingles; two link when
Jaccard >= ``share`` / 100. In order:

1. Documents with equal sets fall into one class (a 128-bit code of the set);
   its smallest id stands for it from here on, so groups of exact copies cost
   one row each.
2. A census counts in how many classes each shingle occurs. Documents are dealt
   into slices; a slice sends its sorted distinct shingles (shortened hashes,
   delta-coded) once and gets the magnitude of each count back.
3. Shingles are ordered by that magnitude and hash, alike everywhere. Two sets
   that link share a shingle among the first n - ceil(share * n) + 1 of either
   (prefix filter), and only shingles of two classes or more can be shared, so
   all other documents leave here. Those left are dealt into tiles: by prefix
   shingle and band of sizes (a band spans sizes that can link; each set is at
   home in its own band and visits the next).
4. In a tile, hashed bitmap signatures bound each overlap from above: a bit set
   in one and not in the other is a shingle that the other lacks. Pairs that
   pass are verified on the sorted shingle arrays themselves.

Only components are wanted, so before step 4 a few rounds link every member of
a tile with one leader, and step 4 leaves out pairs that are connected already:
a group of thousands of near copies costs links in proportion to its size, not
to its square, and no link between different components is lost.

Edge cases: a text without words (or null) has the empty set and links with
nothing; with fewer words than a shingle has, the whole sequence is its one
shingle; rows of one id count as one document; a row without an id links with
nothing and has a null component; other columns are kept, an input column with
the name of a result is replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benelake.llm import packed, text
from benelake.llm.components import components
from benelake.llm.tables import free_name, partitions, text_bytes, written

SLICE_BYTES = 4 << 20
BITMAP = 32  # 64-bit words of a signature
LEADER_ROUNDS = 2
TILE_ROWS = 200_000  # rows of the tiles that one task takes


def _sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    words = text.Words(data, offsets, text.SPACED, text.LOWER)
    codes, first = text.ngrams(words, shingle)
    at = np.searchsorted(first, words.rows)
    out = []
    for i in range(len(offsets) - 1):
        own = np.sort(codes[at[i] : at[i + 1]])
        if not len(own) and words.rows[i + 1] > words.rows[i]:
            own = text.runs(words.hashes, words.rows[i : i + 1], int(words.rows[i + 1] - words.rows[i]))
        out.append(own[np.concatenate((own[:1] == own[:1], own[1:] != own[:-1]))])
    return out


def _code(own: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    return tuple(int(text.mix(own ^ text.U64(k)).sum().view(np.int64)) for k in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179))


def _needed(a, b, share: int):
    """Least overlap times (100 + share) at which sizes a and b link."""
    return share * (a + b)


class _Reps:
    """The class representatives among the rows of a slice."""

    def __init__(self, table: pa.Table, reps: pa.Table, shingle: int):
        wanted = set(zip(reps.column("id").to_pylist(), reps.column("c1").to_pylist(), reps.column("c2").to_pylist(), strict=True))
        table = table.filter(pc.is_in(table.column("id"), reps.column("id")))
        data, offsets = text.utf8(table.column("text"))
        self.ids, self.sets = [], []
        ids = table.column("id").to_pylist()
        for a, b in text.row_blocks(offsets, text.BLOCK):
            for i, own in zip(ids[a:b], _sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], shingle), strict=True):
                if (key := (i, *_code(own))) in wanted:
                    wanted.remove(key)
                    self.ids.append(i)
                    self.sets.append(own)

    def short(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shortened hashes, and in how many sets they are."""
        every = np.sort(np.concatenate([s >> text.U64(64 - bits) for s in self.sets]) if self.sets else np.zeros(0, text.U64))
        at = np.flatnonzero(np.concatenate((every[:1] == every[:1], every[1:] != every[:-1])))
        return every[at], np.diff(np.append(at, len(every)))


def _cuts(keys: np.ndarray, parts: int, bits: int) -> np.ndarray:
    """Where sorted shortened hashes pass from one part to the next."""
    edges = [(p << bits) // parts for p in range(1, parts)]
    return np.concatenate(([0], np.searchsorted(keys, np.array(edges, text.U64)), [len(keys)])).astype(np.int64)


def _count(table: pa.Table) -> pa.Table:
    """One part of the census: magnitudes of the counts, back to each slice."""
    keys = [packed.unpack(x) for x in table.column("keys").to_pylist()]
    sizes = [len(k) for k in keys]
    counts = np.concatenate([packed.unpack(x) for x in table.column("counts").to_pylist()]).astype(np.int64)
    keys = np.concatenate(keys)
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(np.concatenate((keys[:1] == keys[:1], keys[1:] != keys[:-1])))
    total = np.add.reduceat(counts[order], at)
    size = np.empty(len(counts), np.uint8)
    size[order] = np.repeat(np.floor(np.log2(total)).astype(np.uint8), np.diff(np.append(at, len(order))))
    out = [packed.pack(x) if x.any() else None for x in np.split(size, np.cumsum(sizes)[:-1])]
    back = pa.table({"slice": table.column("slice").cast(pa.int32()), "part": table.column("part").cast(pa.int32()), "sizes": pa.array(out, pa.binary())})
    return back.filter(pa.array([x is not None for x in out]))


def _bitmap(own: np.ndarray, band: int, band_size) -> np.ndarray:
    """Signature for a tile of ``band``: of the shingles below a hash limit,
    alike for all sets in the tile, so that about as many stay as fit."""
    room = BITMAP * 32
    part = text.mix(own)
    if band_size(band) > room:
        part = part[part < text.U64(int(room / band_size(band) * 2**64))]
    bits = np.zeros(BITMAP, text.U64)
    place = part % text.U64(BITMAP * 64)
    np.bitwise_or.at(bits, (place >> text.U64(6)).astype(np.int64), text.U64(1) << (place & text.U64(63)))
    return bits


def _leaders(table: pa.Table, seed: int, share: int) -> tuple[np.ndarray, np.ndarray]:
    tile, ids, size, label = (table.column(c).to_numpy() for c in ("tile", "id", "n", "label"))
    rank = text.mix(ids.view(text.U64) ^ text.U64(seed * 0x9E3779B9 + 1))
    order = np.lexsort((rank, tile))
    tile, ids, size, label = tile[order], ids[order], size[order], label[order]
    new = np.concatenate(([True], tile[1:] != tile[:-1]))
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    small, large = np.minimum(size, size[lead]), np.maximum(size, size[lead])
    keep = (label != label[lead]) & (small * 100 >= large * share)
    return ids[keep], ids[lead[keep]]


def _pairs(table: pa.Table, share: int):
    """All pairs of each tile that may link and aren't connected yet, a bounded
    number at a time."""
    tile, ids, size, label, home = (table.column(c).to_numpy(zero_copy_only=False) for c in ("tile", "id", "n", "label", "home"))
    data, _ = text.utf8(table.column("bitmap"))
    bits = data.view(text.U64).reshape(-1, BITMAP)
    order = np.lexsort((ids, size, tile))
    tile, ids, size, label, home, bits = tile[order], ids[order], size[order], label[order], home[order], bits[order]
    i, step = np.arange(len(tile)), 0
    while len(i):
        step += 1
        i = i[i + step < len(tile)]
        j = i + step
        # rows of a tile are sorted by size: a row too large now stays too large
        alive = (tile[i] == tile[j]) & (size[i] * 100 >= size[j] * share)
        i, j = i[alive], j[alive]
        ask = (label[i] != label[j]) & (home[i] | home[j])
        a, b = i[ask], j[ask]
        lost_a = np.bitwise_count(bits[a] & ~bits[b]).sum(1, dtype=np.int64)
        lost_b = np.bitwise_count(bits[b] & ~bits[a]).sum(1, dtype=np.int64)
        most = np.minimum(size[a] - lost_a, size[b] - lost_b)
        ok = most * (100 + share) >= _needed(size[a], size[b], share)
        if ok.any():
            yield ids[a[ok]], ids[b[ok]]


def _verify(stream, share: int):
    """The pairs that link, by exact intersection of their sorted arrays."""
    for batch in stream:
        hits = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), text.U64) for v in (x, y))
            both = np.sort(np.concatenate((x, y)))
            n = int((both[1:] == both[:-1]).sum())
            hits.append(n * (100 + share) >= _needed(len(x), len(y), share))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(hits, pa.bool_()))


def near_duplicate_components(docs: DataFrame, id_column: str = "doc_id", column: str = "text", shingle: int = 5, share: int = 80, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """All rows of ``docs`` with ``n_shingles`` (size of the set) and
    ``component_id`` (smallest id that links reach). ``share``: the least
    Jaccard similarity in percent. Ids are integers."""
    spark = docs.sparkSession
    size = text_bytes(docs, column)
    slices = max(partitions(spark), -(-size // slice_bytes))
    bits = min(64, int(size).bit_length() + 18)
    parts = max(partitions(spark), -(-size // (6 << 20)))
    results = {"n_shingles": T.LongType(), "component_id": T.LongType()}
    carried = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name.lower() not in results]

    # 1. classes of equal sets
    def summary(stream):
        for batch, data, offsets in text.batches(stream, "text"):
            sets = _sets(data, offsets, shingle)
            codes = np.array([_code(s) for s in sets], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(codes[:, 0]), pa.array(codes[:, 1])], ["id", "key", "n", "c1", "c2"])

    own_key = F.xxhash64(id_column, column)  # finds a row again
    bare = docs.select(F.col(id_column).cast("long").alias("id"), own_key.alias("key"), F.col(column).alias("text"))
    sets = written(bare.mapInArrow(summary, "id long, key long, n long, c1 long, c2 long"))
    at = F.pmod("key", F.lit(slices)).cast("int").alias("slice")
    reps = written(sets.where("n > 0 and id is not null").groupBy("c1", "c2", "n").agg(F.min(F.struct("id", "key")).alias("rep")).select("rep.id", "c1", "c2", F.pmod("rep.key", F.lit(slices)).cast("int").alias("slice")))

    # 2. census of the shingles of the representatives
    texts = bare.where("id is not null").select(at, "id", "text")

    def send(table: pa.Table, reps_here: pa.Table) -> pa.Table:
        number = (reps_here if reps_here.num_rows else table).column("slice")[0].as_py()
        keys, counts = _Reps(table, reps_here, shingle).short(bits)
        cuts = _cuts(keys, parts, bits)
        full = [(p, a, b) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pa.table({
            "part": pa.array([p for p, _, _ in full], pa.int32()),
            "slice": pa.array([number] * len(full), pa.int32()),
            "keys": pa.array([packed.pack(keys[a:b], True) for _, a, b in full], pa.binary()),
            "counts": pa.array([packed.pack(counts[a:b].astype(np.uint32)) for _, a, b in full], pa.binary()),
        })

    grouped = texts.groupBy("slice")
    sent = grouped.cogroup(reps.groupBy("slice")).applyInArrow(send, "part int, slice int, keys binary, counts binary")
    told = sent.groupBy("part").applyInArrow(_count, "slice int, part int, sizes binary")

    # 3. candidates: their arrays and the prefix shingles that others have too
    def prefix(table: pa.Table, right: pa.Table) -> pa.Table:
        is_rep = pc.is_null(right.column("part"))
        here = _Reps(table, right.filter(is_rep), shingle)
        keys, _ = here.short(bits)
        cuts = _cuts(keys, parts, bits)
        magnitude = np.zeros(len(keys), np.uint8)
        answers = right.filter(pc.invert(is_rep))
        for p, blob in zip(answers.column("part").to_pylist(), answers.column("sizes").to_pylist(), strict=True):
            magnitude[cuts[p] : cuts[p + 1]] = packed.unpack(blob)
        rows = []
        for i, own in zip(here.ids, here.sets, strict=True):
            count = magnitude[np.searchsorted(keys, own >> text.U64(64 - bits))]
            least = -(-share * len(own) // 100)
            if (count > 0).sum() < max(1, least):
                continue
            order = np.lexsort((own, count))[: len(own) - least + 1]
            chosen = own[order[count[order] > 0]]
            if len(chosen):
                rows.append((i, len(own), own.tobytes(), chosen.tobytes()))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("id", "n", "own", "prefix"), columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)})

    none = F.lit(None)
    right = reps.select("slice", "id", "c1", "c2", none.cast("int").alias("part"), none.cast("binary").alias("sizes")).union(told.select("slice", none.cast("long").alias("id"), none.cast("long").alias("c1"), none.cast("long").alias("c2"), "part", "sizes"))
    candidates = written(grouped.cogroup(right.groupBy("slice")).applyInArrow(prefix, "id long, n long, own binary, prefix binary"))

    # 4. tiles
    width = math.log(100 / share) if share < 100 else 1e-9
    band_of = lambda n: int(math.log(n) / width + 1e-9)
    band_size = lambda band: math.exp(band * width)

    def deal(with_bitmaps: bool):
        def run(stream):
            for batch in stream:
                for i, n, own, keys, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    keys, own = np.frombuffer(keys, text.U64), np.frombuffer(own, text.U64)
                    tiles, maps, homes = [], [], []
                    for home, band in ((True, band_of(n)), (False, band_of(n) + 1)):
                        tiles.append(text.mix(keys + text.U64(band * 0x9E3779B97F4A7C15 % 2**64)).view(np.int64))
                        homes.append(np.full(len(keys), home))
                        if with_bitmaps:
                            maps += [_bitmap(own, band, band_size).tobytes()] * len(keys)
                    m = 2 * len(keys)
                    columns = [pa.array(np.concatenate(tiles)), pa.array(np.full(m, i)), pa.array(np.full(m, n)), pa.array(np.full(m, label)), pa.array(np.concatenate(homes))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(maps if with_bitmaps else [None] * m, pa.binary())], ["tile", "id", "n", "label", "home", "bitmap"])

        return run

    buckets = max(partitions(spark), -(-(candidates.agg(F.coalesce(F.sum(F.octet_length("prefix")), F.lit(0))).first()[0] // 4) // TILE_ROWS))
    pair = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def tiles(labels: DataFrame | None, with_bitmaps: bool) -> DataFrame:
        own = F.col("own") if with_bitmaps else F.lit(b"").alias("own")
        if labels is None:
            rows = candidates.select("id", "n", own, "prefix", F.col("id").alias("label"))
        else:
            rows = candidates.join(labels, "id", "left").select("id", "n", own, "prefix", F.coalesce("label", "id").alias("label"))
        dealt = rows.mapInArrow(deal(with_bitmaps), "tile long, id long, n long, label long, home boolean, bitmap binary")
        return dealt.groupBy(F.pmod("tile", F.lit(buckets)).alias("bucket"))

    def linked(pairs: DataFrame) -> DataFrame:
        arrays = candidates.select("id", "own")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        both = pairs.join(arrays.select(F.col("id").alias("a"), F.col("own").alias("x")), "a").join(arrays.select(F.col("id").alias("b"), F.col("own").alias("y")), "b")
        return both.select("a", "b", "x", "y").mapInArrow(lambda stream: _verify(stream, share), "a long, b long")

    def leaders(seed: int):
        return lambda table: pa.table(_leaders(table, seed, share), schema=pair)

    def pairs(table: pa.Table) -> pa.Table:
        found = list(_pairs(table, share))
        a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        key = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        return pa.table([pa.array(key[:, 0]), pa.array(key[:, 1])], schema=pair)

    links, labels = None, None
    for seed in range(LEADER_ROUNDS + 1):
        last = seed == LEADER_ROUNDS
        found = written(linked(tiles(labels, last).applyInArrow(pairs if last else leaders(seed), "a long, b long")))
        links = found if links is None else links.union(found)
        labels = components(links)

    # every row gets its class's component
    named = reps.select("c1", "c2", F.col("id").alias("rep")).join(labels, F.col("rep") == labels["id"], "left").select("c1", "c2", F.coalesce("label", "rep").alias("component"))
    own, key, size, component = (free_name(docs, x) for x in ("own_id", "own_key", "own_size", "own_component"))
    known = sets.join(named, ["c1", "c2"], "left").select(F.col("id").alias(own), F.col("key").alias(key), F.col("n").alias(size), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias(component)).distinct()
    joined = docs.join(known, (own_key == F.col(key)) & F.col(id_column).cast("long").eqNullSafe(F.col(own)))
    return joined.select(*carried, F.col(size).alias("n_shingles"), F.col(component).alias("component_id"))
