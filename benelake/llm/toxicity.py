"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of
the distinct hashed words in it (each word and its first few bytes, so that
inflected forms share evidence), and 0 if none of them is evidence; a document
is toxic unless every sentence is clean: P = 1 - product of (1 - P(sentence)),
the noisy-or. Only documents carry
labels; the gradient of the noisy-or likelihood deals the blame out to the
sentences, and scoring names those that offend.

The model is fitted on about ``sample_rows`` labelled texts of ``sample_bytes``
in all (half of it for each label, chosen by a hash of the id; all there are if
there are fewer), a bound that holds for the driver's memory too, and only
their ids are broadcast. Everything is scored.

Edge cases: a null or empty text has no sentence and gets score 0; without
labels of both kinds every score is 0; a row labelled more than once counts
as often; rows with equal ids are scored each for itself; other columns are
kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benelake.llm import packed, text

SAMPLE_ROWS = 8000
SAMPLE_BYTES = 8 << 20
FEATURE_BITS = 18
PREFIXES = (4, 5, 6)
ROUNDS = 80
CERTAINTY = 12.0  # -log of the chance at which a feature counts as evidence
OFFENDING = 0.5

_STOP = np.zeros(256, bool)
_STOP[[0x0A, 0x21, 0x2E, 0x3F]] = True  # line feed, !, ., ?


class _Bags:
    """Hashed features of the words of a block of rows, with the sentence of
    each word and the row of each sentence."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = words = text.Words(data, offsets, text.ALNUM, text.LOWER, PREFIXES)
        stops = np.concatenate(([0], np.cumsum(_STOP[data])))
        self.word_rows = words.row_of()
        where = stops[words.starts]
        new = np.ones(len(where), bool)
        new[1:] = (where[1:] != where[:-1]) | (self.word_rows[1:] != self.word_rows[:-1])
        self.sentence = np.cumsum(new) - 1
        self.first = np.flatnonzero(new)
        self.rows = self.word_rows[self.first]
        self.codes = np.add.reduceat(text.mix(words.hashes), self.first) if len(where) else np.zeros(0, text.U64)
        kinds = [words.hashes, *words.heads]
        self.features = np.stack([(text.mix(h + text.U64(0x632BE59BD9B4E019 * (k + 1) % 2**64)) >> text.U64(64 - FEATURE_BITS)).astype(np.int32) for k, h in enumerate(kinds)], 1) if len(where) else np.zeros((0, len(kinds)), np.int32)


def _log_clean(z: np.ndarray) -> np.ndarray:
    """log(1 - P) of logistic scores."""
    return -np.logaddexp(0, z)


class ToxicityModel:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def sentences(self, bags: _Bags) -> tuple[np.ndarray, np.ndarray]:
        """The sentences with evidence, and their logistic scores."""
        weights = self.weights[bags.features]
        at, _ = np.nonzero(weights)
        pairs = np.unique(bags.sentence[at].astype(np.int64) << FEATURE_BITS | bags.features[weights != 0])
        owner = pairs >> FEATURE_BITS
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        if not len(first):
            return np.zeros(0, np.int64), np.zeros(0)
        return owner[first], np.add.reduceat(self.weights[pairs & ((1 << FEATURE_BITS) - 1)].astype(float), first) + self.bias


def _evidence(bags_features: np.ndarray, sentence: np.ndarray, codes: np.ndarray, toxic: np.ndarray, certainty: float) -> tuple[np.ndarray, np.ndarray]:
    """Features that stand out in the sentences of toxic documents, and their
    log odds ratios. Equal sentences count once, so copies of a document lend
    its rare words no weight."""
    order = np.lexsort((codes, toxic))
    same = np.ones(len(order), bool)
    same[1:] = (codes[order][1:] != codes[order][:-1]) | (toxic[order][1:] != toxic[order][:-1])
    counted = np.zeros(len(codes), bool)
    counted[order[same]] = True
    size = 1 << FEATURE_BITS
    words = counted[sentence]
    owner = sentence[words].astype(np.int64) << FEATURE_BITS
    n1, n0 = np.zeros(size), np.zeros(size)
    for k in range(bags_features.shape[1]):  # features of different kinds do not meet but by chance
        pairs = np.sort(owner | bags_features[words, k])
        pairs = pairs[np.concatenate((pairs[:1] == pairs[:1], pairs[1:] != pairs[:-1]))]
        feature, kind = pairs & (size - 1), toxic[pairs >> FEATURE_BITS]
        n1 += np.bincount(feature[kind == 1], minlength=size)
        n0 += np.bincount(feature[kind == 0], minlength=size)
    m1, m0 = (int((counted & (toxic == k)).sum()) for k in (1, 0))
    ratio = np.log((n1 + 0.5) / np.maximum(m1 - n1 + 0.5, 0.5)) - np.log((n0 + 0.5) / np.maximum(m0 - n0 + 0.5, 0.5))
    # Chernoff bound of the chance that a word dealt at random over all
    # sentences falls so often into those of toxic documents
    base, own = m1 / (m1 + m0), n1 / np.maximum(n1 + n0, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.nan_to_num(own * np.log(own / base)) + np.nan_to_num((1 - own) * np.log((1 - own) / (1 - base)))
    used = np.flatnonzero(((n1 + n0) * gain >= certainty) & (ratio > 1))
    return used, ratio[used]


def _fit(features: np.ndarray, sentence: np.ndarray, codes: np.ndarray, rows: np.ndarray, labels: np.ndarray, rounds: int, certainty: float = CERTAINTY) -> ToxicityModel:
    """Gradient descent with per-weight steps on the noisy-or likelihood, over
    the features with evidence, from their log odds ratios."""
    size, n = 1 << FEATURE_BITS, len(labels)
    out = np.zeros(size, np.float32)
    used, ratio = _evidence(features, sentence, codes, labels[rows], certainty)
    if not len(used):
        return ToxicityModel(out, -60.0)
    place = np.full(size, -1, np.int32)
    place[used] = np.arange(len(used))
    place = place[features]
    at, _ = np.nonzero(place >= 0)
    pairs = np.unique(sentence[at].astype(np.int64) * len(used) + place[place >= 0])
    index, owner = pairs % len(used), pairs // len(used)
    with_evidence, owner = np.unique(owner, return_inverse=True)  # other sentences score 0
    rows = rows[with_evidence]
    kinds = features.shape[1]
    weights, bias = ratio / kinds, -3.0
    pull = weights.copy()
    squares, bias_squares = np.full(len(used), 1e-6), 1e-6
    cost = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / n
    for _ in range(rounds):
        z = np.bincount(owner, weights[index], len(rows)) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        toxic = -np.expm1(np.bincount(rows, _log_clean(z), n))
        blame = np.where(labels == 1, -(1 - toxic) / np.maximum(toxic, 1e-9), 1.0) * cost
        per_sentence = blame[rows] * p
        gradient = np.bincount(index, per_sentence[owner], len(used)) + 1e-4 * (weights - pull)
        slope = per_sentence.sum()
        squares += gradient**2
        bias_squares += slope**2
        weights = weights - 0.2 * gradient / np.sqrt(squares)
        bias -= 0.2 * slope / np.sqrt(bias_squares)
    out[used] = weights
    return ToxicityModel(out, float(bias))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", column: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES, rounds: int = ROUNDS) -> ToxicityModel:
    """Model from the texts of ``docs`` that have a 0/1 label in ``labels``."""
    known = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    # the share of each label's rows that is expected to give half the sample
    shares = {r["label"]: min(1.0, sample_rows / 2 / r["count"]) for r in known.groupBy("label").count().collect()}
    if len(shares) < 2:
        return ToxicityModel(np.zeros(1 << FEATURE_BITS, np.float32), -60.0)
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / float(1 << 20)
    texts = docs.select(F.col(id_column).alias("id"), F.col(column).alias("text")).where("text is not null")

    def sample():
        ids = known.where(((F.col("label") == 1) & (place < shares[1])) | ((F.col("label") == 0) & (place < shares[0])))
        return texts.join(F.broadcast(ids), "id").select("id", "text", "label")  # about sample_rows ids

    for r in sample().groupBy("label").agg(F.sum(F.octet_length("text")).alias("n")).collect():
        shares[r["label"]] *= min(1.0, sample_bytes / 2 / max(r["n"], 1))  # long texts: fewer of them
    chosen = sample()

    def extract(stream):
        for batch, data, offsets in text.batches(stream, "text"):
            bags = _Bags(data, offsets)
            yield pa.RecordBatch.from_arrays([
                pa.array([packed.pack(bags.features.ravel())]),
                pa.array([packed.pack(bags.sentence, True)]),
                pa.array([packed.pack(bags.rows, True)]),
                pa.array([packed.pack(bags.codes)]),
                pa.array([packed.pack(batch.column(2).to_numpy(zero_copy_only=False).astype(np.int8))]),
            ], ["features", "sentence", "rows", "codes", "labels"])

    found = chosen.mapInArrow(extract, "features binary, sentence binary, rows binary, codes binary, labels binary").collect()
    found = sorted(map(tuple, found), key=lambda r: bytes(r[0]))  # the fit does not depend on the order of tasks
    parts = [tuple(map(packed.unpack, r)) for r in found]
    if not parts:
        return ToxicityModel(np.zeros(1 << FEATURE_BITS, np.float32), -60.0)
    features = np.concatenate([p[0].reshape(-1, 1 + len(PREFIXES)) for p in parts])
    before = np.cumsum([[0, 0], *[[len(p[2]), len(p[4])] for p in parts]], axis=0)
    sentence = np.concatenate([p[1] + n for p, (n, _) in zip(parts, before, strict=False)])
    owner = np.concatenate([p[2] + n for p, (_, n) in zip(parts, before, strict=False)])
    codes = np.concatenate([p[3] for p in parts])
    labels = np.concatenate([p[4] for p in parts]).astype(np.int64)
    if not len(sentence) or labels.min() == labels.max():
        return ToxicityModel(np.zeros(1 << FEATURE_BITS, np.float32), -60.0)
    return _fit(features, sentence, codes, owner, labels, rounds)


def score_toxicity(docs: DataFrame, model: ToxicityModel, column: str = "text", score: str = "score", sentences: str | None = "offending") -> DataFrame:
    """All rows of ``docs`` with the score in 0 to 1 and, in ``sentences``, the
    offending ones (first and end byte in the UTF-8 text, score). An input
    column of such a name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    taken = {score.lower(), (sentences or score).lower()}
    if column.lower() in taken:
        raise ValueError(f"{column} can't be replaced")
    carried = [f for f in docs.schema.fields if f.name.lower() not in taken]
    span = T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
    added = [T.StructField(score, T.DoubleType())] + ([T.StructField(sentences, T.ArrayType(span))] if sentences else [])
    schema = T.StructType([*carried, *added])

    def apply(stream):
        own = shared.value
        for batch, data, offsets in text.batches(stream, column):
            bags = _Bags(data, offsets)
            sentence, z = own.sentences(bags)
            rows = bags.rows[sentence]
            out = [batch.column(batch.schema.get_field_index(f.name)) for f in carried]
            out.append(pa.array(-np.expm1(np.bincount(rows, _log_clean(z), batch.num_rows)) + 0.0))
            if sentences:
                p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                bad, p = sentence[p >= OFFENDING], p[p >= OFFENDING]
                last = np.append(bags.first[1:], len(bags.sentence))[bad] - 1
                base = offsets[bags.rows[bad]]
                items = pa.StructArray.from_arrays([pa.array(bags.words.starts[bags.first[bad]] - base), pa.array(bags.words.ends[last] - base), pa.array(p)], ["first", "end", "score"])
                out.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(bags.rows[bad], np.arange(batch.num_rows + 1)), pa.int32()), items))
            yield pa.RecordBatch.from_arrays(out, schema.names)

    return docs.select(*[F.col(f"`{f.name}`") for f in carried]).mapInArrow(apply, schema)
