"""Token groups that two tokenizers share, and how often their ids meet.

A byte-level BPE file of the tokenizers library (A) and a sentencepiece model
(B) encode a blank and the text. Where a token of each ends at the same byte,
the text is cut; what lies between two cuts is a group. A and B tokens whose
byte ranges overlap are linked.

Work on byte ranges is a monoid. A ``Fragment`` is what a range of a text says
on its own: tokens up to its first cut (an open prefix), the groups closed
between its cuts, and tokens after its last (an open suffix). Two neighbours
compose by closing the group that spans their border, whatever order pairs of
neighbours are composed in. A text over ``CHUNK`` bytes is dealt over the tasks
in ranges, and rounds of grouping by document and range compose their fragments
as a tree; shorter texts are closed fragments that a task makes many at a time.

Links are kept by blocks of rows. Their ids are counted over all documents by a
plain aggregate; each slice of blocks then asks for the counts of just its own
pairs of ids, so no table of pairs is held whole anywhere.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benelake.llm import text
from benelake.llm.byte_bpe import Vocabulary
from benelake.llm.packed import pack, unpack
from benelake.llm.pieces import PieceStore
from benelake.llm.tables import free_name, written
from benelake.llm.tokens import _cuts

#: Bytes of a range of a long text.
CHUNK = 1 << 16
#: Text of a block of rows.
BLOCK = 1 << 20
#: Pieces that a worker stores of each tokenizer.
STORED = 1_000_000
#: Neighbouring fragments that one task composes.
FAN = 16
#: Bytes of text whose links look up their counts together.
SLICE = 32 << 20
#: Pairs of ids that a task counts before it hands them on.
PAIRS = 1_000_000

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _spelled(pieces: list[bytes], ids: list[list[int]], names: dict[int, bytes]) -> list[list[int]]:
    """The ids of each piece that they spell byte for byte, of others none: the
    tokens of a text with such a piece are shorter than the text."""
    return [x if b"".join([names[i] for i in x]) == p else [] for p, x in zip(pieces, ids, strict=True)]


class ByteLevel:
    """Tokenizer A: a file of the tokenizers library with a byte-level vocabulary."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        letters = _byte_letters()
        names = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items()}
        self.vocabulary = Vocabulary(names)
        self.store = PieceStore(lambda pieces: _spelled(pieces, [x.ids for x in tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)], names), STORED)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows that begin with a blank, and the offsets of each row's."""
        starts = _cuts(data, offsets)
        ids, before = self.store.ids(data, starts)
        return ids, before[np.searchsorted(starts, offsets)]


class Pieces:
    """Tokenizer B: a sentencepiece model, which puts a blank before the text.
    Rows are cut before each first blank of a run where no piece of the model
    holds a blank after other text and blanks are left as they are."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        blank = "▁"
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        names = {i: bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(blank, " ").encode() for i, p in enumerate(pieces)}
        self.vocabulary = Vocabulary(names)
        probe = " a  b c "
        kept = self.vocabulary.join(np.array(model.encode(probe[1:]))).tobytes().decode() == probe
        self.cut = kept and not any(blank in p.lstrip(blank) for p in pieces)
        alone = [model.piece_to_id(blank)]

        def encode(parts: list[bytes]) -> list[list[int]]:
            found = model.encode([p[1:].decode() for p in parts], num_threads=1)
            return _spelled(parts, [x if p != b" " else alone for p, x in zip(parts, found, strict=True)], names)

        self.store = PieceStore(encode, STORED)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.zeros(len(data), bool)
        if self.cut:
            starts[1:] = (data[1:] == 0x20) & (data[:-1] != 0x20)
        starts[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(starts)
        ids, before = self.store.ids(data, starts)
        return ids, before[np.searchsorted(starts, offsets)]


@cache
def _tokenizers(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(path_a), Pieces(path_b)


@cache
def _decimals(digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of up to so many digits in decimal, right-aligned with room for
    a sign after them, and which of these bytes are in use."""
    n = np.arange(10**digits)
    places = 10 ** np.arange(digits - 1, -1, -1)
    signs = np.full((len(n), digits + 1), 0x2C, np.uint8)
    signs[:, :-1] = n[:, None] // places % 10 + 0x30
    used = np.ones(signs.shape, bool)
    used[:, : digits - 1] = n[:, None] >= places[:-1]
    return signs, used


@dataclass
class Tokens:
    """Tokens of both tokenizers in order, with their ends in the text's bytes."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def part(self, after: int, to: int) -> Tokens:
        """Those that end beyond ``after``, up to ``to``."""
        i, j = np.searchsorted(self.a_ends, (after, to), "right")
        k, m = np.searchsorted(self.b_ends, (after, to), "right")
        return Tokens(self.a[i:j], self.a_ends[i:j], self.b[k:m], self.b_ends[k:m])

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*[np.concatenate(x) for x in zip(self.fields(), other.fields(), strict=True)])

    def fields(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_ends, self.b, self.b_ends

    def marks(self) -> tuple[int, np.ndarray, np.ndarray]:
        """Where tokens of either end, as flags over the bytes from a first one."""
        low = int(min(x[0] for x in (self.a_ends, self.b_ends) if len(x))) if len(self.a) or len(self.b) else 0
        high = int(max(x[-1] for x in (self.a_ends, self.b_ends) if len(x))) if len(self.a) or len(self.b) else -1
        flags = np.zeros((2, high - low + 1), bool)
        flags[0, self.a_ends - low] = True
        flags[1, self.b_ends - low] = True
        return low, flags[0], flags[1]

    def cuts(self) -> np.ndarray:
        low, in_a, in_b = self.marks()
        return np.flatnonzero(in_a & in_b) + low


def _no_tokens() -> Tokens:
    return Tokens(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))


def links(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of tokens between cuts: where each link ends, and its A and B id. Every
    end of either tokenizer closes exactly one link."""
    low, in_a, in_b = tokens.marks()
    ends = np.flatnonzero(in_a | in_b)
    a, b = (ids[(np.cumsum(flags, dtype=np.int32) - flags)[ends]] for ids, flags in ((tokens.a, in_a), (tokens.b, in_b)))
    return ends + low, a, b


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)


def group_text(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of tokens between cuts, as bytes; the cuts, and
    where the text of the group before each ends (with its sign)."""
    low, in_a, in_b = tokens.marks()
    cut = in_a & in_b
    cuts = np.flatnonzero(cut)
    if not len(cuts):
        return np.zeros(0, np.uint8), cuts, cuts
    upto_a, upto_b = (np.cumsum(x, dtype=np.int32)[cuts] for x in (in_a, in_b))
    group = np.cumsum(cut, dtype=np.int32) - cut  # cuts before each byte
    ids = np.empty(len(tokens.a) + len(tokens.b), np.int32)
    before_b = np.concatenate((upto_b[:1] * 0, upto_b))
    ids[np.arange(len(tokens.a), dtype=np.int32) + before_b[group[tokens.a_ends - low]]] = tokens.a
    ids[np.arange(len(tokens.b), dtype=np.int32) + upto_a[group[tokens.b_ends - low]]] = tokens.b
    digits, used = _decimals(max(5, len(str(int(ids.max())))))
    spelled = digits[ids]
    spelled[upto_a + before_b[:-1] - 1, -1] = ord("|")
    last = upto_a + upto_b - 1
    spelled[last, -1] = ord(";")
    kept = used[ids]
    return spelled[kept], cuts + low, np.cumsum(kept.sum(axis=1))[last]


@dataclass
class Fragment:
    """What a byte range of a text says. ``open`` are tokens before its first
    cut, or all if it has none; ``after`` those beyond its last. The closed
    groups are held as their counts, text, and distinct links with how often
    each occurs. A ``broken`` fragment, whose tokens don't spell its bytes,
    breaks whatever it is composed with."""

    cut: bool = False
    open: Tokens = field(default_factory=_no_tokens)
    after: Tokens = field(default_factory=_no_tokens)
    counts: np.ndarray = field(default_factory=lambda: np.zeros(4, np.int64))
    text: bytes = b""
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    broken: bool = False

    @classmethod
    def of(cls, tokens: Tokens) -> Fragment:
        """The fragment of a range that these tokens end in."""
        cuts = tokens.cuts()
        if not len(cuts):
            return cls(open=tokens)
        end = np.iinfo(np.int64).max
        return cls(cut=True, open=tokens.part(-1, cuts[0]), after=tokens.part(cuts[-1], end)).closing(tokens.part(cuts[0], cuts[-1]))

    def closing(self, tokens: Tokens) -> Fragment:
        """With the groups of ``tokens``, which begin and end at cuts, added."""
        if not len(tokens.a):
            return self
        spelled, cuts, _ = group_text(tokens)
        _, a, b = links(tokens)
        pairs, times = _counted(_pairs(a, b))
        self.counts = self.counts + (len(tokens.a), len(tokens.b), len(cuts), len(a))
        self.text += spelled.tobytes()
        self.pairs, self.times = _merged([(self.pairs, self.times), (pairs, times)])
        return self

    def __mul__(self, other: Fragment) -> Fragment:
        if self.broken or other.broken:
            return Fragment(broken=True)
        if not other.cut:
            if not self.cut:
                return Fragment(open=self.open + other.open)
            return Fragment(True, self.open, self.after + other.open, self.counts, self.text, self.pairs, self.times)
        if not self.cut:
            return Fragment(True, self.open + other.open, other.after, other.counts, other.text, other.pairs, other.times)
        between = Fragment().closing(self.after + other.open)
        pairs, times = _merged([(f.pairs, f.times) for f in (self, between, other)])
        return Fragment(True, self.open, other.after, self.counts + between.counts + other.counts, self.text + between.text + other.text, pairs, times)

    def pack(self) -> bytes:
        parts = [pack(x) for x in (*self.open.fields(), *self.after.fields(), self.counts)]
        parts += [pack(self.pairs, ordered=True), pack(self.times), zstandard.ZstdCompressor(level=1).compress(self.text)]
        return struct.pack(f"<??{len(parts)}Q", self.cut, self.broken, *map(len, parts)) + b"".join(parts)

    @classmethod
    def unpack(cls, blob: bytes) -> Fragment:
        cut, broken, *sizes = struct.unpack_from("<??12Q", blob)
        parts, at = [], struct.calcsize("<??12Q")
        for size in sizes:
            parts.append(blob[at : at + size])
            at += size
        arrays = [unpack(p) for p in parts[:11]]
        return cls(cut, Tokens(*arrays[:4]), Tokens(*arrays[4:8]), arrays[8], zstandard.ZstdDecompressor().decompress(parts[11]), arrays[9], arrays[10], broken)


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and how often each occurs."""
    values = np.sort(values)
    new = np.flatnonzero(np.concatenate((values[:1] == values[:1], values[1:] != values[:-1])))
    return values[new], np.diff(np.append(new, len(values)))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and their times, equal numbers added up."""
    parts = [p for p in parts if len(p[0])]
    if len(parts) < 2:
        return parts[0] if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    keys, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


#: The beginning of a text is a cut.
START = Fragment(cut=True)


def _tokens(data: np.ndarray, offsets: np.ndarray, path_a: str, path_b: str) -> tuple[Tokens, np.ndarray]:
    """Tokens of the rows that both tokenizers spell byte for byte, with ends in
    the bytes of those rows alone, and which rows they are."""
    sides = []
    for tokenizer in _tokenizers(path_a, path_b):
        ids, rows = tokenizer.encode(data, offsets)
        lengths = tokenizer.vocabulary.lengths(ids)
        sides.append((ids, rows, lengths, np.diff(np.concatenate(([0], np.cumsum(lengths)))[rows])))
    size = np.diff(offsets)
    good = (size > 0) & (sides[0][3] == size) & (sides[1][3] == size)
    fields = []
    for ids, rows, lengths, _ in sides:
        kept = np.repeat(good, np.diff(rows)) if not good.all() else slice(None)
        fields += [ids[kept], np.cumsum(lengths[kept])]
    return Tokens(*fields), good


def _with_blank(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A blank before the text of each row that isn't empty."""
    some = np.diff(offsets) > 0
    return np.insert(data, offsets[:-1][some], 0x20), offsets + np.concatenate(([0], np.cumsum(some)))


@dataclass
class Block:
    """Rows of results: counts (rows x 4), the groups' text, and for the rows'
    distinct links the row, the pair's place in ``pairs`` and how often."""

    counts: np.ndarray
    texts: list[bytes]
    pairs: np.ndarray
    rows: np.ndarray
    place: np.ndarray
    times: np.ndarray

    def pack(self) -> bytes:
        parts = [pack(np.bincount(self.rows, minlength=len(self.texts)).astype(np.uint32)), pack(self.pairs, ordered=True), pack(self.place.astype(np.uint32)), pack(self.times.astype(np.uint32))]
        return struct.pack("<4Q", *map(len, parts)) + b"".join(parts)


def _unpack_block(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links of each row, distinct pairs, and of each link its pair's place and
    how often it occurs."""
    sizes, at, parts = struct.unpack_from("<4Q", blob), 32, []
    for size in sizes:
        parts.append(unpack(blob[at : at + size]))
        at += size
    return tuple(parts)


def _aligned(data: np.ndarray, offsets: np.ndarray, path_a: str, path_b: str) -> Block:
    """Whole rows, each a closed fragment."""
    data, offsets = _with_blank(data, offsets)
    tokens, good = _tokens(data, offsets, path_a, path_b)
    n = len(good)
    edges = np.cumsum(np.where(good, np.diff(offsets), 0))  # ends of the rows in the bytes of good rows
    spelled, cuts, stops = group_text(tokens)
    ends, a, b = links(tokens)
    upto = lambda x: np.searchsorted(x, edges, "right")
    counts = np.diff([upto(x) for x in (tokens.a_ends, tokens.b_ends, cuts, ends)], axis=1, prepend=0).T.reshape(n, 4)
    at = np.concatenate(([0], stops))[np.concatenate(([0], upto(cuts)))]
    view = spelled.tobytes()
    texts = [view[x : max(x, y - 1)] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    # row, A and B id in one number, so that one sort counts the links
    width_a, width_b = (max(1, int(x.max(initial=0)).bit_length()) for x in (a, b))
    if n.bit_length() + width_a + width_b > 63:
        raise ValueError("ids too large")
    row = np.repeat(np.arange(n), counts[:, 3])
    keys, times = _counted((row << width_a | a) << width_b | b)
    rows, pairs = keys >> (width_a + width_b), _pairs(keys >> width_b & (1 << width_a) - 1, keys & (1 << width_b) - 1)
    pairs, place = np.unique(pairs, return_inverse=True)
    return Block(counts, texts, pairs, rows, place, times)


def _closed(fragments: list[Fragment]) -> Block:
    """Whole texts, composed from their fragments."""
    fragments = [START * f for f in fragments]
    whole = [f if not f.broken and not len(f.after.a) and not len(f.after.b) else Fragment() for f in fragments]
    pairs = np.unique(np.concatenate([f.pairs for f in whole])) if whole else np.zeros(0, np.uint64)
    rows = np.repeat(np.arange(len(whole)), [len(f.pairs) for f in whole])
    place = np.searchsorted(pairs, np.concatenate([f.pairs for f in whole]))
    return Block(np.array([f.counts for f in whole]).reshape(len(whole), 4), [f.text[:-1] for f in whole], pairs, rows, place, np.concatenate([f.times for f in whole]))


def _number() -> int:
    return uuid.uuid4().int >> 65  # a long


class _Results:
    """Result columns of blocks: the links go with a block's first row; blocks
    of about ``SLICE`` bytes of text have a slice in common."""

    def __init__(self, groups: bool):
        self.groups, self.slice, self.room = groups, _number(), SLICE

    def columns(self, block: Block, size: int) -> list[pa.Array]:
        if self.room <= 0:
            self.slice, self.room = _number(), SLICE
        self.room -= size
        n = len(block.texts)
        out = [pa.array(block.counts[:, i]) for i in range(4)]
        out.append(pa.array([hashlib.sha256(t).hexdigest() if c else "" for t, c in zip(block.texts, block.counts[:, 0].tolist(), strict=True)], pa.string()))
        if self.groups:
            out.append(pa.array([t.decode() for t in block.texts], pa.string()))
        out += [pa.array([self.slice] * n, pa.int64()), pa.array([_number()] * n, pa.int64()), pa.array(np.arange(n), pa.int32())]
        return [*out, pa.array([block.pack(), *[None] * (n - 1)], pa.binary())]


def _result_fields(names: dict[str, str], groups: bool) -> list[T.StructField]:
    kinds = dict.fromkeys(_COUNTS, T.LongType()) | {"groups_sha256": T.StringType()} | ({"groups": T.StringType()} if groups else {})
    kinds |= {"slice": T.LongType(), "block": T.LongType(), "position": T.IntegerType(), "links": T.BinaryType()}
    return [T.StructField(names.get(k, k), kind) for k, kind in kinds.items()]


def borders(data: np.ndarray, chunk: int) -> list[tuple[int, int, int, int]]:
    """Ranges (from, to) of a long text of about ``chunk`` bytes, each with the
    bytes (start, stop) that its tokens lie in: up to the next place on either
    side where both tokenizers begin a token, a blank after an ASCII letter. A
    stretch without such places stays in one range."""
    folded = data[:-1] | 0x20
    safe = np.flatnonzero((data[1:] == 0x20) & (folded >= 0x61) & (folded <= 0x7A)) + 1
    ends = np.arange(chunk, len(data) - 1, chunk)
    before = np.searchsorted(safe, ends, "right") - 1
    after = np.searchsorted(safe, ends)
    fine = (before >= 0) & (after < len(safe))
    fine[fine] &= (safe[before[fine]] > ends[fine] - chunk) & (safe[after[fine]] < ends[fine] + chunk)
    ends, starts, stops = ends[fine], safe[before[fine]], safe[after[fine]]
    return list(zip([0, *ends.tolist()], [*ends.tolist(), len(data)], [0, *starts.tolist()], [*stops.tolist(), len(data)], strict=True))


def _long_texts(long: DataFrame, number: str, column: str, path_a: str, path_b: str, chunk: int, most: int) -> DataFrame:
    """(number, fragment) of each text of ``long``, composed in a tree."""
    plain = long.select(F.col(number).alias("number"), F.col(f"`{column}`").cast("string").alias("text"))
    kinds = "number long, node long, low long, high long, start long, bytes binary"

    def split(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text.batches(stream, "text", 1):
            whole, _ = _with_blank(data, offsets)
            for i, (low, high, start, stop) in enumerate(borders(whole, chunk)):
                yield pa.RecordBatch.from_pydict({"number": batch.column(0), "node": pa.array([i], pa.int64()), "low": pa.array([low]), "high": pa.array([high]), "start": pa.array([start]), "bytes": pa.array([whole[start:stop].tobytes()], pa.binary())})

    def fragments(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            blobs = []
            for low, high, start, raw in zip(*[batch.column(i).to_pylist() for i in range(2, 6)], strict=True):
                data = np.frombuffer(raw, np.uint8)
                tokens, good = _tokens(data, np.array([0, len(data)]), path_a, path_b)
                tokens = Tokens(tokens.a, tokens.a_ends + start, tokens.b, tokens.b_ends + start)
                blobs.append((Fragment.of(tokens.part(low, high)) if good.all() else Fragment(broken=True)).pack())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(blobs, pa.binary())], names=["number", "node", "fragment"])

    def compose(key, part):
        part = part.sort_by("node")
        whole = reduce(lambda f, g: f * g, [Fragment.unpack(x) for x in part["fragment"].to_pylist()])
        return pa.table({"number": [key[0].as_py()], "node": [key[1].as_py()], "fragment": pa.array([whole.pack()], pa.binary())})

    ranges = plain.mapInArrow(split, kinds).repartition("number", "node")
    found = ranges.mapInArrow(fragments, "number long, node long, fragment binary")
    ranges_left = most // chunk + 2
    while ranges_left > 1:
        found = found.withColumn("parent", F.floor(F.col("node") / FAN)).groupBy("number", "parent").applyInArrow(compose, "number long, node long, fragment binary")
        ranges_left = -(-ranges_left // FAN)
    return found.select("number", "fragment")


def align(df: DataFrame, path_a: str, path_b: str, column: str = "text", groups: bool = False, chunk: int = CHUNK) -> tuple[DataFrame, dict[str, str]]:
    """The rows of ``df``, without the text, with n_a, n_b, n_groups, n_links,
    groups_sha256 and with ``groups`` the groups' text, written in the shared
    folder; and the names of the columns that hold their links (slice, block,
    position, links), for ``score_links``.

    A text that is null, empty or not spelled byte for byte by both tokenizers
    has zeros and empty strings. Rows are documents each, repeated ones too.
    Other columns are carried; one of a result's name is replaced."""
    results = {*_COUNTS, "groups_sha256", *(["groups"] if groups else [])}
    carried = [c for c in df.columns if c.lower() != column.lower() and c.lower() not in results]
    base = df.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{column}`").cast("string").alias(free := free_name(df, "aligned_text")))
    names = {k: free_name(df, k) for k in ("slice", "block", "position", "links")}
    fields = _result_fields(names, groups)
    short = base.where(F.coalesce(F.octet_length(free), F.lit(0)) <= chunk)

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = _Results(groups)
        for batch, data, offsets in text.batches(stream, free, BLOCK):
            columns = to.columns(_aligned(data, offsets, path_a, path_b), len(data))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*carried, *[f.name for f in fields]])

    of_short = short.mapInArrow(rows, T.StructType([*[base.schema[c] for c in carried], *fields]))
    most = base.agg(F.max(F.octet_length(free))).first()[0] or 0
    if most <= chunk:
        return written(of_short), names
    number = free_name(df, "number")
    long = written(base.where(F.octet_length(free) > chunk).withColumn(number, F.monotonically_increasing_id()))
    composed = _long_texts(long, number, free, path_a, path_b, chunk, most)

    def whole(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = _Results(groups)
        for batch in stream:
            for i in range(batch.num_rows):
                fragment = Fragment.unpack(batch.column(1)[i].as_py())
                columns = to.columns(_closed([fragment]), len(fragment.text))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), *columns], names=[number, *[f.name for f in fields]])

    of_long = composed.mapInArrow(whole, T.StructType([T.StructField(number, T.LongType()), *fields]))
    of_long = long.drop(free).join(of_long, number).select(*[F.col(f"`{f.name}`") for f in of_short.schema.fields])
    return written(of_short.unionByName(of_long)), names


def _task_pairs(stream: Iterator[pa.RecordBatch], by_slice: bool) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of blocks, with their number of rows, added up over the
    blocks of a task (and slice) until there are ``PAIRS`` of them."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def out():
        for key, (pairs, times) in held.items():
            for a in range(0, len(pairs), 100_000):
                part = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs[part]), key)), pa.array(pairs[part].astype(np.int64)), pa.array(times[part])], names=["slice", "pair", "n_docs"])

    for batch in stream:
        for key, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            _, pairs, place, _ = _unpack_block(blob)
            key = key if by_slice else 0
            held[key] = _merged([held.get(key, (pairs[:0], np.zeros(0, np.int64))), (pairs, np.bincount(place, minlength=len(pairs)))])
            if sum(len(p) for p, _ in held.values()) > PAIRS:
                yield from out()
                held.clear()
    yield from out()


def link_counts(aligned: DataFrame, names: dict[str, str]) -> DataFrame:
    """(a_id, b_id, n_docs, best): the documents that hold each pair of ids
    linked; ``best``: no pair of the same A id is held by more."""
    blobs = aligned.where(F.col(names["links"]).isNotNull()).select(names["slice"], names["links"])
    partial = blobs.mapInArrow(lambda s: _task_pairs(s, False), "slice long, pair long, n_docs long")
    counts = partial.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"))
    counts = written(counts.select(F.shiftright("pair", 32).cast("int").alias("a_id"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"), "n_docs"))
    most = counts.groupBy("a_id").agg(F.max("n_docs").alias("most"))
    return counts.join(most, "a_id").select("a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def score_links(aligned: DataFrame, names: dict[str, str], counts: DataFrame) -> DataFrame:
    """``aligned`` with n_best (links whose pair is a best one of its A id) and
    count_sum (the pairs' counts, added over the links), without its links."""
    slice_, block, position, links_ = (names[k] for k in ("slice", "block", "position", "links"))
    blobs = aligned.where(F.col(links_).isNotNull()).select(F.col(slice_).alias("slice"), F.col(block).alias("block"), F.col(links_).alias("links"))
    asked = blobs.select("slice", "links").mapInArrow(lambda s: _task_pairs(s, True), "slice long, pair long, n_docs long").select("slice", "pair")
    pair = F.shiftleft(F.col("a_id").cast("long"), 32).bitwiseOR(F.col("b_id").cast("long"))
    answers = asked.join(counts.select(pair.alias("pair"), "n_docs", "best"), "pair").select("slice", "pair", "n_docs", "best")

    def look_up(key, own, found):
        pairs = found["pair"].to_numpy().astype(np.uint64)
        order = np.argsort(pairs)
        pairs, n_docs, best = pairs[order], found["n_docs"].to_numpy()[order], found["best"].to_numpy()[order]
        out = []
        for number, blob in zip(own["block"].to_pylist(), own["links"].to_pylist(), strict=True):
            of_row, of_block, place, times = _unpack_block(blob)
            at = np.searchsorted(pairs, of_block)[place]
            upto = np.concatenate(([0], np.cumsum(of_row, dtype=np.int64)))
            sums = [np.concatenate(([0], np.cumsum(times.astype(np.int64) * x[at])))[upto] for x in (best, n_docs)]
            out.append(pa.table({"block": np.full(len(of_row), number), "position": np.arange(len(of_row), dtype=np.int32), "n_best": np.diff(sums[0]), "count_sum": np.diff(sums[1])}))
        return pa.concat_tables(out) if out else pa.table({"block": pa.array([], pa.int64()), "position": pa.array([], pa.int32()), "n_best": pa.array([], pa.int64()), "count_sum": pa.array([], pa.int64())})

    scored = blobs.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(look_up, "block long, position int, n_best long, count_sum long")
    rest = aligned.drop(links_, slice_, *[c for c in aligned.columns if c.lower() in ("n_best", "count_sum")])
    of_block, of_position = free_name(rest, "of_block"), free_name(rest, "of_position")
    scored = scored.withColumnsRenamed({"block": of_block, "position": of_position})
    same = (F.col(block) == F.col(of_block)) & (F.col(position) == F.col(of_position))
    return rest.join(scored, same).drop(block, position, of_block, of_position)


def align_tokenizers(df: DataFrame, path_a: str, path_b: str, column: str = "text", groups: bool = False, chunk: int = CHUNK) -> DataFrame:
    """``align`` and ``score_links`` in one: the rows of ``df``, without the
    text, with n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256
    (and ``groups``)."""
    aligned, names = align(df, path_a, path_b, column, groups, chunk)
    return score_links(aligned, names, written(link_counts(aligned, names)))
