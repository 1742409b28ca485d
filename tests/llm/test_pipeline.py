import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from benelake.llm import queries
from benelake.llm.tables import table, written
from test_decontaminate import plain as plain_hits
from test_jaccard_join import plain as plain_components
from test_substring_dedup import plain as plain_kept

SF = "/root/testdata/sf0.001"


def test_registered():
    names = __spark_entry__.queries()
    assert {re.match(r"op\d+_", n)[0] for n in queries.QUERIES} == {f"op{n}_" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(__spark_entry__.oracle_sql()) <= set(names)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.fixture(scope="module")
def kept(spark):
    """The documents before each stage and after the last but one."""
    out = [table(spark, SF, "documents")]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out.append(written(stage(spark, out[-1], SF)))
    return out


def rows(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_stages_keep_the_columns_of_documents(kept):
    assert all(f.schema == kept[0].schema for f in kept)


def test_toxic_documents_go(kept, spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    before, after = ({i for i, _ in rows(f)} for f in kept[:2])
    gone = before - after
    toxic = {i for i in before if labels.get(i) == 1}
    assert after < before and len(gone & toxic) >= 0.6 * len(toxic)
    assert not {i for i in gone if labels.get(i) == 0}


def test_one_document_of_each_group_stays(kept):
    groups = plain_components(rows(kept[1]), 5, 80)
    assert sorted(i for i, _ in rows(kept[2])) == sorted(i for i, _, c in groups if i == c)


def test_long_repeats_are_cut(kept):
    expected = []
    for (i, t), (_, n, removed, left) in zip(rows(kept[2]), plain_kept(rows(kept[2]), 50), strict=True):
        if removed < n or not removed:
            expected.append((i, left if removed else t))
    assert sorted(rows(kept[3])) == sorted(expected)
    assert all(r["n_chars"] == len(r["text"]) for r in kept[3].collect())


def test_contaminated_documents_go(kept, spark):
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    clean = [i for i, _, hit, _ in plain_hits(rows(kept[3]), items) if not hit]
    assert sorted(i for i, _ in rows(kept[4])) == sorted(clean)


def test_all_that_is_left_is_packed(kept, spark):
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == {i for i, _ in rows(kept[4])}


def test_stages_on_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "no id", "en", "s", 5), (3, "x " * 30000, None, "s", 60000), (4, "same words here", "en", None, 15), (4, "same words here", "en", None, 15)]
    for given in ([], odd):
        frame = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, frame, SF)
            if name != "packing":
                assert got.columns == frame.columns
            n = got.count()
            assert n >= len(given) - (name == "near_duplicates") and (given or not n)


def test_texts_of_one_id_go_only_for_texts_like_their_own(spark):
    words = lambda k, n=40: " ".join(f"{k}{i}" for i in range(n))
    given = [(1, words("a")), (1, words("b")), (2, words("b")), (5, words("c")), (5, words("a") + " more"), (6, words("d")), (6, words("d")), (7, ""), (7, ""), (7, None), (None, words("d"))]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows_ = [(i, t, "en", "s", len(t or "")) for i, t in given]
    wanted = [(1, words("a")), (1, words("b")), (5, words("c")), (6, words("d")), (7, ""), (7, None), (None, words("d"))]
    for order in (rows_, rows_[::-1]):
        got = rows(corpus_pipeline.near_duplicates(spark, spark.createDataFrame(order, schema).repartition(3), SF))
        assert sorted(got, key=str) == sorted(wanted, key=str)


RESULTS = ["toxic_score", "N_Shingles", "component_id", "n_words", "n_removed", "kept_text", "n_hit", "hit_spans", "item_ids", "n_items", "contaminated", "slice", "row_number"]


def test_a_users_columns_survive_every_stage(spark):
    frame = table(spark, SF, "documents").limit(60).drop("n_chars").withColumns({c: F.lit(42) for c in RESULTS})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, frame, SF))
        assert after.columns == frame.columns and after.count() > 10
        assert after.select(*RESULTS).distinct().collect() == [(42,) * len(RESULTS)]
        frame = after
