"""Language identification with language-bitmask n-gram filters.

Every language has a Bloom filter of its byte 4-grams (lower-cased letters, any
other run of bytes as one blank). The filters lie bit-sliced: one table of
slots whose bit l belongs to language l, so that the AND of a gram's few slots
gives all languages that contain it at once. A text's grams are counted per
language, the count is corrected for the filter's own rate of false positives,
and the largest corrected count decides; the score is its share of all.

A gram belongs to a language if it makes up at least ``least_share`` of the
language's grams (so a language has at most 1 / least_share of them) and at
least ``1 / contrast`` of the largest share that it has in any language. Gram
counts come from all labelled rows, summed by Spark; only the chosen grams
reach the driver, and the table's size is a parameter.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; a
text none of whose grams is known gets the language with the most training
grams and score 0; ties go to the first name; without labelled rows every text
is ``und``; rows with equal ids are scored each for itself; other columns are
kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benelake.llm import text
from benelake.llm.tables import written

SLOT_BITS = 20
HASHES = 3
LEAST_SHARE = 1e-5
CONTRAST = 6.0

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _grams(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The 4-grams of a block of rows as uint32, and the offsets of each row's."""
    data, offsets = text.utf8(pc.utf8_lower(batch.column(batch.schema.get_field_index(column))))
    n = len(offsets) - 1
    padded = np.empty(len(data) + 2 * n, np.uint8)  # a blank before and after each row
    row = np.repeat(np.arange(n), np.diff(offsets))
    padded[offsets[:-1] + 2 * np.arange(n)] = 0x20
    padded[offsets[1:] + 2 * np.arange(n) + 1] = 0x20
    padded[np.arange(len(data)) + 2 * row + 1] = np.where(_LETTER[data], data, np.uint8(0x20))
    blank = padded == 0x20
    keep = np.ones(len(padded), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    edges = offsets + 2 * np.arange(n + 1)
    if n:
        keep[edges[:-1]] = True
    padded = padded[keep].astype(np.uint32)
    edges = np.concatenate(([0], np.cumsum(keep)))[edges]
    if len(padded) < 4:
        return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
    keys = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
    room = np.maximum(np.diff(edges) - 3, 0)
    inside = np.zeros(len(keys) + 1, np.int32)
    inside[np.minimum(edges[:-1], len(keys))[room > 0]] += 1
    ends = (edges[:-1] + room)[room > 0]
    inside[ends] -= 1
    return keys[np.cumsum(inside[:-1]) > 0], np.concatenate(([0], np.cumsum(room)))


def _slots(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    h = text.mix(keys.astype(text.U64) + text.U64(0x5851F42D4C957F2D))
    return [((h >> text.U64(bits * i)) & text.U64((1 << bits) - 1)).astype(np.int64) for i in range(HASHES)]


class LanguageFilters:
    """The bit-sliced table for sorted ``languages``."""

    def __init__(self, languages: list[str], rows: list[tuple[str, int]], default: str | None, bits: int = SLOT_BITS):
        self.languages, self.default, self.bits = languages, default, bits
        self.layers = [np.zeros(1 << bits, text.U64) for _ in range(-(-len(languages) // 64))]
        place = {name: i for i, name in enumerate(languages)}
        owner = np.array([place[name] for name, _ in rows], np.int64)
        slots = _slots(np.array([g for _, g in rows], np.int64).astype(np.uint32), bits)
        self.false_rate = np.zeros(len(languages))
        for i in range(len(languages)):
            for s in slots:
                self.layers[i // 64][s[owner == i]] |= text.U64(1 << (i % 64))
            filled = np.count_nonzero(self.layers[i // 64] & text.U64(1 << (i % 64))) / (1 << bits)
            self.false_rate[i] = filled**HASHES

    def counts(self, keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Corrected number of each row's grams that each language contains."""
        slots = _slots(keys, self.bits)
        total = np.diff(rows)
        out = np.zeros((len(total), len(self.languages)))
        for k, layer in enumerate(self.layers):
            mask = layer[slots[0]]
            for s in slots[1:]:
                mask &= layer[s]
            for i in range(64 * k, min(64 * k + 64, len(self.languages))):
                hits = np.concatenate(([0], np.cumsum((mask >> text.U64(i % 64)) & text.U64(1), dtype=np.int64)))
                found = hits[rows[1:]] - hits[rows[:-1]]
                out[:, i] = np.maximum(0, (found - total * self.false_rate[i]) / (1 - self.false_rate[i]))
        return out


def fit_languages(labelled: DataFrame, column: str = "text", language: str = "lang", least_share: float = LEAST_SHARE, contrast: float = CONTRAST, bits: int = SLOT_BITS) -> LanguageFilters:
    """Filters from all rows with a text and a language."""

    def count(stream):
        kept: dict[str, list] = {}

        def merged(parts):
            keys, n = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            at = np.flatnonzero(np.concatenate((keys[:1] == keys[:1], keys[1:] != keys[:-1])))
            return keys[at], np.add.reduceat(n[order], at) if len(at) else n

        for batch, _, _ in text.batches(stream, column):
            names = batch.column(batch.schema.get_field_index(language))
            for name in names.unique().to_pylist():
                keys, _ = _grams(batch.filter(pc.equal(names, name)), column)
                keys = np.sort(keys)
                at = np.flatnonzero(np.concatenate((keys[:1] == keys[:1], keys[1:] != keys[:-1])))
                parts = kept.setdefault(name, [])
                parts.append((keys[at], np.diff(np.append(at, len(keys)))))
                if len(parts) > 8:
                    kept[name] = [merged(parts)]
        for name, parts in kept.items():
            keys, n = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["language", "gram", "n"])

    rows = labelled.select(F.col(column), F.col(language)).where(F.col(column).isNotNull() & F.col(language).isNotNull())
    counts = written(rows.mapInArrow(count, "language string, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n")))
    sums = counts.groupBy("language").agg(F.sum("n").alias("total"))  # one row a language
    share = counts.join(F.broadcast(sums), "language").withColumn("share", F.col("n") / F.col("total"))
    best = F.max("share").over(Window.partitionBy("gram"))
    totals = share.withColumn("best", best).where((F.col("share") >= least_share) & (F.col("share") * contrast >= F.col("best")))
    chosen = [(r["language"], r["gram"], r["n"]) for r in totals.select("language", "gram", "n").collect()]
    languages = sorted({name for name, _, _ in chosen})
    weight = {name: sum(n for x, _, n in chosen if x == name) for name in languages}
    default = max(languages, key=lambda x: (weight[x], x), default=None)
    return LanguageFilters(languages, [(name, g) for name, g, _ in chosen], default, bits)


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    plain = np.concatenate(([0], np.cumsum(_LETTER[data] & (data < 0x80))))
    found = plain[offsets[1:]] > plain[offsets[:-1]]
    for i in np.flatnonzero(~found):  # no ASCII letter: look at the characters
        found[i] = any(map(str.isalpha, data[offsets[i] : offsets[i + 1]].tobytes().decode()))
    return found


def predict_languages(docs: DataFrame, filters: LanguageFilters, column: str = "text", predicted: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows of ``docs`` with the language and its score in 0 to 1. An input
    column of such a name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    taken = {predicted.lower(), score.lower()}
    if column.lower() in taken:
        raise ValueError(f"{column} can't be replaced")
    carried = [f for f in docs.schema.fields if f.name.lower() not in taken]
    schema = T.StructType([*carried, T.StructField(predicted, T.StringType()), T.StructField(score, T.DoubleType())])

    def predict(stream):
        own = shared.value
        for batch, data, offsets in text.batches(stream, column):
            names, scores = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            if own.languages:
                keys, rows = _grams(batch, column)
                counts = own.counts(keys, rows)
                best, total = counts.argmax(1), counts.sum(1)
                names = np.array(own.languages, object)[best]
                names[total == 0] = own.default
                scores = np.where(total > 0, counts.max(1) / np.maximum(total, 1e-9), 0.0)
                none = ~_has_letter(data, offsets)
                names[none], scores[none] = "und", 0.0
            out = [batch.column(batch.schema.get_field_index(f.name)) for f in carried]
            yield pa.RecordBatch.from_arrays([*out, pa.array(names, pa.string()), pa.array(scores)], schema.names)

    return docs.select(*[F.col(f"`{f.name}`") for f in carried]).mapInArrow(predict, schema)
