import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from benelake.llm import queries
from benelake.llm.language_id import fit_languages, predict_languages
from benelake.llm.quality import STATISTICS, fit_quality, score_quality, statistics, with_statistics
from benelake.llm.toxicity import fit_toxicity, score_toxicity

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n "), (4, "1234 !?"), (5, "x" * 200000), (6, "word " * 40000), (6, "word " * 40000), (None, "one two")]


def test_toxicity_on_held_out_documents(spark):
    rows = queries.op7_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_toxicity_names_the_offending_sentence(docs, spark):
    chance = random.Random(4)
    sentence = lambda: " ".join(chance.choice("abcdefghij") * 3 for _ in range(6)) + ". "
    rows, labels = [], []
    for i in range(200):
        parts = [sentence() for _ in range(8)]
        if i % 4 == 0:
            parts[chance.randrange(8)] = f"You are a nasty{chance.choice(['', 's', 'ly'])} {chance.choice('abc') * 3}. "
        rows.append((i, "".join(parts)))
        labels.append((i, int(i % 4 == 0)))
    model = fit_toxicity(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    for r in score_toxicity(docs(rows), model).collect():
        assert (r["score"] >= 0.7) == (r["doc_id"] % 4 == 0)
        found = [r["text"].encode()[s["first"] : s["end"]].decode() for s in r["offending"]]
        assert all("nasty" in s for s in found) and len(found) == (r["doc_id"] % 4 == 0)


def test_toxicity_edge_cases(docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = fit_toxicity(docs(ODD), none)
    assert {r["score"] for r in score_toxicity(docs(ODD), model).collect()} == {0.0}
    one_kind = spark.createDataFrame([(6, 1), (2, 1), (None, 0)], "doc_id long, toxic int")
    assert {r["score"] for r in score_toxicity(docs(ODD), fit_toxicity(docs(ODD), one_kind)).collect()} == {0.0}
    assert score_toxicity(docs([]), model).collect() == []
    frame = docs([(1, "a", "s", 3)], "doc_id long, text string, score string, label int")
    assert [tuple(r) for r in score_toxicity(frame, model, sentences=None).collect()] == [(1, "a", 3, 0.0)]


def test_quality_on_held_out_documents(spark):
    rows = queries.op4_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95
    good, bad = ([r["score"] for r in rows if r["quality"] == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_quality_edge_cases(docs, spark):
    stats = with_statistics(docs(ODD))
    assert all(len(r["statistics"]) == STATISTICS and np.isfinite(r["statistics"]).all() for r in stats.collect())
    empty = fit_quality(stats.withColumn("quality", F.lit(None).cast("int")))
    assert {r["score"] for r in score_quality(stats, empty).collect()} == {0.5}
    model = fit_quality(stats.withColumn("quality", (F.coalesce("doc_id", F.lit(0)) % 2).cast("int")))
    assert all(0 <= r["score"] <= 1 for r in score_quality(stats, model).collect())
    assert score_quality(with_statistics(docs([])), model).collect() == []
    frame = with_statistics(docs([(1, "a b", "z", 2)], "doc_id long, text string, statistics string, y int"))
    assert score_quality(frame, model).columns == ["doc_id", "y", "score"]


def test_statistics_do_not_depend_on_neighbours():
    data, offsets = np.frombuffer("ab Cd!\nxaaa bbb aaa".encode(), np.uint8), np.array([0, 7, 7, 19])
    alone = [statistics(data[a:b], np.array([0, b - a])) for a, b in ((0, 7), (7, 7), (7, 19))]
    assert np.allclose(statistics(data, offsets), np.concatenate(alone))


def test_language_on_held_out_documents(spark):
    rows = queries.op10_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97


def test_language_edge_cases(docs):
    train = docs([(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, "кот и собака", "ru"), (4, None, "en"), (5, "x", None)], "doc_id long, text string, lang string")
    filters = fit_languages(train)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict_languages(docs([*ODD, (10, "THE DOG"), (11, "Собака"), (12, "日本"), (13, "…")]), filters).collect()}
    assert [got[i] for i in (1, 2, 3, 4, 13)] == [("und", 0.0)] * 5
    assert (got[10][0], got[11][0]) == ("en", "ru")
    assert got[12][0] in ("de", "en", "ru") and got[12][1] == 0.0
    assert predict_languages(docs([]), filters).collect() == []
    nothing = fit_languages(train.where("false"))
    assert {r["lang_pred"] for r in predict_languages(docs(ODD), nothing).collect()} == {"und"}


def test_filters_of_more_languages_than_a_word_has_bits(docs):
    train = docs([(i, " ".join(chr(0x4E00 + 40 * i + k) * 3 for k in range(20)), f"l{i:02d}") for i in range(70)], "doc_id long, text string, lang string")
    filters = fit_languages(train)
    assert len(filters.layers) == 2
    rows = predict_languages(train, filters).collect()
    assert all(r["lang"] == r["lang_pred"] for r in rows)


@pytest.mark.parametrize("name", ["op4_quality_classifier", "op7_toxicity", "op10_language_id"])
def test_every_document_gets_one_row(spark, name):
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() == 200


def test_toxicity_query_locates_sentences(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op7_toxicity(spark, SF).collect()
    toxic = [r for r in rows if r["predicted"] == 1]
    assert sum(bool(r["offending"]) for r in toxic) >= 0.9 * len(toxic) > 0
    for r in rows:
        size = len((docs[r["doc_id"]] or "").encode())
        assert all(0 <= s["first"] < s["end"] <= size and 0.5 <= s["score"] <= 1 for s in r["offending"])
