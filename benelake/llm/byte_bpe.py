"""Byte-level BPE: texts to token ids and back, with a file of merge ranks.

A text is first cut by the public pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

but without a regex engine. Codepoints become an array of classes (letter,
number, blank, other white space, the rest, and the letters of contractions).
A right-to-left automaton says of each position what follows it, a
left-to-right one whether a slice begins there; both run as scans of composed
transition functions (``scans``). Each distinct slice is merged once per
worker, by rank, leftmost first (``pieces``). Where every token ends in the
text's bytes is kept, so any token's bytes can be cut from the text, and ids
turn back into bytes by one gather from the table of token bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benelake.llm import text
from benelake.llm.pieces import PieceStore
from benelake.llm.scans import Automaton

#: Text that is cut and encoded at once.
PORTION = 1 << 20
#: Bytes from which a slice's pairs are kept in a heap.
SHORT = 64

# symbols: what a codepoint is to the automata
_LETTER, _NUMBER, _BLANK, _SPACE, _REST, _QUOTE, _ONE, _E, _L, _R, _V = range(11)
_ONE_LETTERS = "stmd"  # 's 't 'm 'd

# what stands to the right: its first letters, as far as contractions need them
_RIGHT = ("end", "visible", "one", "e", "l", "ll", "re")


def _look(state: str, symbol: int) -> str:
    if symbol in (_BLANK, _SPACE):
        return "end"
    if symbol == _ONE:
        return "one"
    if symbol == _E:
        return "e"
    if symbol == _L:
        return "ll" if state in ("l", "ll") else "l"
    if symbol in (_R, _V):
        return "re" if state == "e" else "visible"
    return "visible"


# symbols of the left-to-right automaton: class, and contractions of one and two letters
_A, _N, _B, _W, _O, _C1, _C2 = range(7)
_LEFT = ("start", "letter", "number", "blank", "space", "rest", "two left", "one left", "contracted")


def _cut(state: str, symbol: int) -> str:
    if symbol == _A:
        return {"two left": "one left", "one left": "contracted"}.get(state, "letter")
    if symbol in (_C1, _C2):
        return "rest" if state in ("rest", "blank") else ("one left" if symbol == _C1 else "two left")
    return {_N: "number", _B: "blank", _W: "space", _O: "rest"}[symbol]


def _begins(state: str, symbol: int, followed: bool) -> bool:
    """Whether a slice begins at ``symbol`` after ``state``; ``followed``: by
    visible text."""
    if symbol in (_B, _W):
        return followed or state not in ("blank", "space")
    if symbol == _A:
        return state not in ("letter", "blank", "two left", "one left")
    if symbol == _N:
        return state not in ("number", "blank")
    return state not in ("rest", "blank")


@cache
def _automata() -> tuple[Automaton, Automaton, np.ndarray]:
    begins = [[[_begins(s, x, f) for f in (False, True)] for x in range(7)] for s in _LEFT]
    return Automaton(_RIGHT, range(11), _look), Automaton(_LEFT, range(7), _cut), np.array(begins).ravel()


_TO_LEFT = np.array([_A, _N, _B, _W, _O, _O, _A, _A, _A, _A, _A])


@cache
def class_table() -> bytes:
    """The class of every codepoint, compressed. It is asked of the tiktoken
    library, so letters, numbers and white space are those of its Unicode
    version; one byte per codepoint, computed once on the driver."""
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    valid = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    table = np.full(0x110000, _REST, np.uint8)
    for pattern, kind in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\s", _SPACE)):
        library = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        for a in range(0, len(valid), 1 << 16):
            found = bytes(library.encode_ordinary("".join(map(chr, valid[a : a + (1 << 16)])))).decode()
            table[np.fromiter(map(ord, found), np.int64, len(found))] = kind
    table[0x20] = _BLANK
    for letters, kind in (("'", _QUOTE), (_ONE_LETTERS, _ONE), ("e", _E), ("l", _L), ("r", _R), ("v", _V)):
        table[[ord(c) for c in letters]] = kind
    return zlib.compress(table.tobytes())


@cache
def _classes(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), np.uint8)


def _codepoints(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offset and class of every codepoint. Row starts count as such."""
    lead = (data & 0xC0) != 0x80
    lead[offsets[:-1][np.diff(offsets) > 0]] = True
    at = np.flatnonzero(lead)
    first = data[at]
    kind = classes[first & 0x7F]
    wide = np.flatnonzero(first >= 0x80)
    if len(wide):
        padded = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.int32)
        a = at[wide]
        b0, b1, b2, b3 = (padded[a + i] & (0x3F if i else 0xFF) for i in range(4))
        code = np.where(b0 < 0xE0, (b0 & 0x1F) << 6 | b1, np.where(b0 < 0xF0, (b0 & 0x0F) << 12 | b1 << 6 | b2, (b0 & 0x07) << 18 | b1 << 12 | b2 << 6 | b3))
        kind[wide] = classes[np.minimum(code, 0x10FFFF)]
    return at, kind


def boundaries(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte offsets at which the pattern's matches begin, in all rows."""
    if not len(data):
        return np.zeros(0, np.int64)
    right, left, begins = _automata()
    at, kind = _codepoints(data, offsets, classes)
    first = np.zeros(len(at) + 1, bool)
    first[np.searchsorted(at, offsets)] = True
    # what follows each position: the state after all symbols to the right of it
    last = first[1:]
    seen = right.states((kind + right.reset * last)[::-1])[::-1]
    follows = np.zeros(len(at), np.uint8)
    follows[:-1] = seen[1:]
    follows[last] = 0
    symbol = _TO_LEFT[kind]
    quote = kind == _QUOTE
    symbol[quote & (follows == _RIGHT.index("one"))] = _C1
    symbol[quote & ((follows == _RIGHT.index("ll")) | (follows == _RIGHT.index("re")))] = _C2
    before = np.zeros(len(at), np.int64)
    before[1:] = left.states(symbol + left.reset * first[:-1])[:-1]
    before[first[:-1]] = 0
    return at[begins[(before * 7 + symbol) * 2 + (follows != 0)]]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the adjacent pair of least rank is merged, leftmost
    first, until none has a rank."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    if len(piece) > SHORT:
        return _merge_long(piece, ranks)
    none, get = len(ranks), ranks.get
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (least := min(pairs)) < none:
        i = pairs.index(least)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """``merge`` with the pairs in a heap: n log n steps for n bytes."""
    n = len(piece)
    ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # a part's end, the part before it

    def pair(i: int) -> tuple[int, int, int] | None:
        if ends[i] < n and (rank := ranks.get(piece[i : (e := ends[ends[i]])])) is not None:
            return rank, i, e
        return None

    heap = [p for i in range(n - 1) if (p := pair(i))]
    heapq.heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, e = heapq.heappop(heap)
        if gone[i] or ends[i] >= n or ends[ends[i]] != e:
            continue  # one of its parts has been merged since
        gone[ends[i]] = 1
        ends[i] = e
        if e < n:
            before[e] = i
            if p := pair(i):
                heapq.heappush(heap, p)
        if i and (p := pair(before[i])):
            heapq.heappush(heap, p)
    return [ranks[piece[i : ends[i]]] for i in range(n) if not gone[i]]


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Vocabulary:
    """Bytes of each id, as one array with offsets."""

    def __init__(self, tokens: dict[int, bytes]):
        top = max(tokens, default=-1) + 1
        self.sizes = np.full(top, -1, np.int64)
        for i, token in tokens.items():
            self.sizes[i] = len(token)
        self.starts = np.concatenate(([0], np.cumsum(np.maximum(self.sizes, 0))))
        self.data = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(top)), np.uint8)

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes) or self.sizes[ids].min() < 0):
            raise ValueError("an id is not in the vocabulary")
        return self.sizes[ids]

    def join(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of all ids, one after the other."""
        sizes = self.lengths(ids)
        before = np.cumsum(sizes) - sizes
        return self.data[np.repeat(self.starts[ids] - before, sizes) + np.arange(sizes.sum())]


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary({i: token for token, i in read_ranks(path).items()})


@cache
def _store(path: str) -> PieceStore:
    ranks = read_ranks(path)
    return PieceStore(lambda pieces: [merge(p, ranks) for p in pieces])


def portions(data: np.ndarray, offsets: np.ndarray, most: int = PORTION) -> np.ndarray:
    """``offsets`` with cuts inside longer rows: after an ASCII letter and
    before a blank, where a match of the pattern always begins."""
    long = np.flatnonzero(np.diff(offsets) > most)
    cuts = [offsets]
    for i in long.tolist():
        a, end = int(offsets[i]), int(offsets[i + 1])
        while end - a > most:
            part = data[a + most - 1 : end]
            found = None
            for b in range(0, len(part) - 1, most):
                window = part[b : b + most + 1]
                hit = np.flatnonzero((window[1:] == 0x20) & (((window[:-1] | 0x20) >= 0x61) & ((window[:-1] | 0x20) <= 0x7A)))
                if len(hit):
                    found = a + most - 1 + b + int(hit[0]) + 1
                    break
            if found is None:
                break
            cuts.append(np.array([found]))
            a = found
    return np.unique(np.concatenate(cuts)) if len(cuts) > 1 else offsets


def encode_block(data: np.ndarray, offsets: np.ndarray, path: str, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows, and the offsets of each row's ids."""
    store = _store(path)
    ids, rows = [], [np.zeros(1, np.int64)]
    cut = portions(data, offsets, PORTION)
    total = 0
    for a, b in text.row_blocks(cut, PORTION):
        lo, hi = cut[a], cut[b]
        part, inner = data[lo:hi], cut[a : b + 1] - lo
        starts = boundaries(part, inner, classes)
        found, before = store.ids(part, starts)
        ids.append(found)
        rows.append(total + before[np.searchsorted(starts, inner[1:])])
        total += len(found)
    joined = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    if cut is offsets:
        return joined, np.concatenate(rows)
    return joined, np.concatenate(rows)[np.searchsorted(cut, offsets, "right") - 1]


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def encode_texts(df: DataFrame, path: str, column: str = "text", ids: str | None = "ids", ends: str | None = "token_ends", n_tokens: str | None = "n_tokens", ids_sha256: str | None = None, keep_text: bool = True) -> DataFrame:
    """Token ids of ``column`` by the rank file at ``path``. Adds ``ids`` (array
    of int), ``ends`` (array of int: where each token ends in the text's UTF-8
    bytes), ``n_tokens`` (long) and ``ids_sha256`` (lowercase hex of the ids as
    little-endian unsigned 32-bit integers); a name of None leaves one out.

    A null or empty text has no tokens: empty arrays, 0, the digest of nothing.
    A text is encoded whole, in portions that no token crosses. Equal rows get
    equal results; other columns are carried (the text only with ``keep_text``),
    and a column of an added name is replaced, names compared as Spark does."""
    added = {ids: T.ArrayType(T.IntegerType()), ends: T.ArrayType(T.IntegerType()), n_tokens: T.LongType(), ids_sha256: T.StringType()}
    added = {name: kind for name, kind in added.items() if name is not None}
    taken = {name.lower() for name in added}
    carried = [f for f in df.schema.fields if f.name.lower() not in taken and (keep_text or f.name.lower() != column.lower())]
    helper = "text_"
    while helper.lower() in taken | {f.name.lower() for f in carried}:
        helper += "_"
    source = df.select(*[F.col(f"`{f.name}`") for f in carried], F.col(f"`{column}`").cast("string").alias(helper))
    packed = class_table()

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, lengths = _classes(packed), vocabulary(path)
        for batch, data, offsets in text.batches(stream, helper):
            found, rows = encode_block(data, offsets, path, classes)
            columns = batch.columns[:-1]
            for name in added:
                if name == ids:
                    columns.append(_lists(found, rows, pa.int32()))
                elif name == ends:
                    after = np.cumsum(lengths.lengths(found))
                    start = np.concatenate(([0], after))[rows[:-1]]
                    columns.append(_lists(after - np.repeat(start, np.diff(rows)), rows, pa.int32()))
                elif name == n_tokens:
                    columns.append(pa.array(np.diff(rows)))
                else:
                    raw = memoryview(found.astype("<u4").view(np.uint8))
                    columns.append(pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*[f.name for f in carried], *added])

    return source.mapInArrow(encode, T.StructType([*carried, *[T.StructField(n, k) for n, k in added.items()]]))


def decode_ids(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The bytes of the ``ids`` of each row, as the binary column ``out``, by
    the rank file at ``path``. A null list decodes to no bytes; an id without a
    rank raises. Other columns are carried; the list itself is dropped."""
    carried = [f for f in df.schema.fields if f.name.lower() not in (ids.lower(), out.lower())]
    helper = "ids_"
    while helper.lower() in {f.name.lower() for f in carried} | {out.lower()}:
        helper += "_"
    source = df.select(*[F.col(f"`{f.name}`") for f in carried], F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>")).alias(helper))

    def decode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(path)
        for batch in stream:
            lists = batch.column(len(carried))
            rows = lists.offsets.to_numpy().astype(np.int64)
            for a, b in text.row_blocks(rows, PORTION):
                found = lists.values.slice(rows[a], rows[b] - rows[a]).to_numpy(zero_copy_only=False)
                after = np.concatenate(([0], np.cumsum(table.lengths(found))))
                at = np.ascontiguousarray(after[rows[a : b + 1] - rows[a]])
                data = np.concatenate([table.join(found[i : i + PORTION]) for i in range(0, len(found), PORTION)]) if len(found) else np.zeros(0, np.uint8)
                decoded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(at), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns[:-1], decoded.cast(pa.binary())], names=[*[f.name for f in carried], out])

    return source.mapInArrow(decode, T.StructType([*carried, T.StructField(out, T.BinaryType())]))


def token_bytes(text_column: Column, ends: Column, number: Column | int) -> Column:
    """The bytes of token ``number`` (from 0) of a text, cut from the text by
    the retained ends; null where there is no such token."""
    number = F.lit(number) if isinstance(number, int) else number
    end = F.get(ends, number)
    start = F.when(number == 0, F.lit(0)).otherwise(F.get(ends, number - 1))
    return F.when(end.isNotNull(), F.substring(text_column.cast("binary"), start + 1, end - start))
