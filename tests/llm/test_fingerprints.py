import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from benelake.llm.fingerprints import compare_edited, fingerprint, likeness, signature, with_next


def weights(text):
    w = text.split()
    return Counter(zip([None, *w], w, strict=False))


def jaccard(a, b):
    a, b = weights(a), weights(b)
    return sum((a & b).values()) / sum((a | b).values())


def test_collisions_estimate_the_generalised_jaccard_similarity(spark):
    chance = np.random.default_rng(5)
    rows, exact = [], []
    for k in range(150):
        a = [f"w{x}" for x in chance.integers(0, 400, 600)] + ["the", "of"] * int(chance.integers(0, 80))
        b = list(a)
        for i in chance.integers(0, len(b), int(chance.integers(0, 500))):
            b[i] = f"v{chance.integers(0, 400)}"
        rows.append((k, " ".join(a), " ".join(b)))
        exact.append(jaccard(rows[-1][1], rows[-1][2]))
    frame = spark.createDataFrame(rows, "k int, a string, b string").select("k", signature("a").alias("x"), signature("b").alias("y"))
    got = [r[1] for r in frame.select("k", likeness("x", "y")).orderBy("k").collect()]
    error = np.array(got) - np.array(exact)
    assert abs(error.mean()) < 0.015 and np.sqrt((error**2).mean()) < 0.06


def test_repeated_passages_weigh_what_they_hold(docs, spark):
    def repeated(own, of, times, line):
        return " ".join([f"{own}{i}" for i in range(of)] + [f"line{i}" for i in range(line)] * times)

    pairs = [(repeated(f"a{k}x", 500, 200, 20), repeated(f"b{k}x", 500, 200, 20)) for k in range(6)]
    pairs += [(repeated(f"a{k}y", 300, 100, 10), repeated(f"b{k}y", 300, 100, 10)) for k in range(6)]
    pairs += [(repeated(f"c{k}", 300, 0, 10), repeated(f"c{k}", 300, 100, 10)) for k in range(6)]
    frame = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string").select("k", signature("a").alias("x"), signature("b").alias("y"))
    got = [r[1] for r in frame.select("k", likeness("x", "y")).orderBy("k").collect()]
    exact = [jaccard(a, b) for a, b in pairs]
    for at in (0, 6, 12):
        assert abs(np.mean(got[at : at + 6]) - np.mean(exact[at : at + 6])) < 0.06


def test_compared_texts_have_the_samples_of_their_signatures(docs, spark):
    chance = np.random.default_rng(3)
    rows = [(k, " ".join(f"w{x}" for x in chance.integers(0, 30, k))) for k in range(60)]
    texts = dict(rows)
    got = {r["doc_id"]: r for r in compare_edited(docs(rows)).collect()}
    edited = {k: t[: len(t) - len(t) // 3] + texts[(k - 1) % 60][: len(t) // 3] for k, t in rows}
    frame = spark.createDataFrame([(k, t, edited[k], texts[(k - 1) % 60]) for k, t in rows], "k int, a string, b string, c string")
    signed = frame.select("k", signature("a").alias("a"), signature("b").alias("b"), signature("c").alias("c"))
    for k, x, y, near, after in signed.select("k", fingerprint("a"), fingerprint("b"), likeness("a", "b"), likeness("a", "c")).collect():
        assert (x, y, near, after) == (got[k]["fingerprint"], got[k]["edited_fingerprint"], got[k]["near_edited"], got[k]["near_next"])


def plain(rows):
    order = sorted(((i if i is not None else -(2**63), t or "") for i, t in rows), reverse=True)
    out = {}
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        n = len(t) // 3
        out.setdefault(i, []).append((len(t), hashlib.sha256((t[: len(t) - n] + following[:n]).encode()).hexdigest()))
    return {k: sorted(v) for k, v in out.items()}


def test_edited_texts_follow_the_order(docs):
    rows = [(i * 7 % 101, f"word{i} " * (i % 9) + "é日本x" * (i % 4)) for i in range(101)] + [(200, None), (201, ""), (202, "\n"), (None, "lost and found"), (5, "again here"), (5, "again here")]
    got = {}
    for r in compare_edited(docs(rows)).collect():
        got.setdefault(r["doc_id"] if r["doc_id"] is not None else -(2**63), []).append((r["n_chars"], r["edited_sha256"]))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert {k: sorted(v) for k, v in got.items()} == plain(rows)


def test_edge_cases(docs, spark):
    assert compare_edited(docs([])).collect() == []
    (one,) = compare_edited(docs([(1, "a b c d e f g h i")])).collect()
    assert one["near_next"] == 1.0 and one["n_chars"] == 17
    blank = sorted(compare_edited(docs([(1, None), (2, " \n"), (3, "x y z")])).collect())
    assert [r["fingerprint"] == "" for r in blank] == [True, True, False]
    assert blank[1]["near_next"] == 1.0 and blank[2]["near_next"] == 0.0
    same = compare_edited(docs([(i, "one two three two") for i in range(30)])).select("fingerprint").distinct()
    assert same.count() == 1


def test_no_python_and_no_single_task_in_the_plan(docs):
    plan = compare_edited(docs([(i, f"t {i}") for i in range(50)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "SinglePartition" not in plan


def test_next_of_any_column(spark):
    frame = spark.range(20).withColumn("name", F.concat(F.lit("n"), F.col("id")))
    got = {r["id"]: r["next_name"] for r in with_next(frame, ["name"], "id").collect()}
    assert got == {i: f"n{(i - 1) % 20}" for i in range(20)}
