import numpy as np
import pytest
from pyspark.sql import functions as F

from benelake.llm import hard_negatives
from benelake.llm.hard_negatives import Tree, mine_hard_negatives
from benelake.llm.queries import op11_hard_negatives


def brute_force(rows, is_anchor, positives=5, negatives=5):
    """rows: (id, vector, label), those that take part."""
    rows = sorted({(i, int(y), tuple(int(np.floor(256 * np.float64(x))) for x in v)) for i, v, y in rows})
    width = max((len(v) for _, _, v in rows), default=0)
    rows = [(i, y, v + (0,) * (width - len(v))) for i, y, v in rows]
    out = []
    for i, y, v in rows:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for j, z, w in rows if j != i)
        same = [(s, j) for s, j, z in scored if z == y][:positives]
        for p, j in same:
            fit = [(s, k) for s, k, z in scored if z != y and 80 * -p <= 100 * -s <= 100 * -p][:negatives]
            out += [(i, j, n, k, -p, -s) for n, (s, k) in enumerate(fit, 1)]
    return sorted(out)


def mined(frame, anchors=10, **options):
    found = mine_hard_negatives(frame, "vec_id", F.col("label"), "embedding", F.col("vec_id") % anchors == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def frame_of(spark, rows, extra=""):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int" + extra)


def random_rows(n, seed, centers=6, width=5, spread=0.15):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(centers, width))
    at = middle[r.integers(0, centers, n)] + spread * r.normal(size=(n, width))
    return [(i, [float(np.float32(x)) for x in v], int(r.integers(0, 3))) for i, v in enumerate(at)]


@pytest.mark.parametrize("seed", [1, 2])
def test_deep_tree_many_blocks(spark, monkeypatch, seed):
    for name, value in (("FANOUT", 4), ("LEAF", 10), ("SAMPLE", 100), ("BLOCK_ROWS", 7), ("BATCH", 5)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = random_rows(400, seed)
    assert mined(frame_of(spark, rows).repartition(5)) == brute_force(rows, lambda i: i % 10 == 0)


def test_siblings_are_left_out():
    rows = np.floor(256 * np.array([v for _, v, _ in random_rows(3000, 3, centers=40, spread=0.02)])).astype(np.int64)
    square = float(np.square(rows).sum(axis=1).max())
    tree = Tree(rows[:500], square, 2)
    leaf = tree.leaves(rows, ranges=True)
    score = rows[:50] @ rows.T
    high = np.sort(score, axis=1)[:, -5][:, None]
    low = np.floor(0.98 * high).astype(np.int64)
    who, visited = tree.visits(rows[:50], low, high)
    pairs = set(zip(who.tolist(), visited.tolist(), strict=True))
    assert {(q, int(leaf[x])) for q, x in zip(*np.nonzero((score >= low) & (score <= high)), strict=True)} <= pairs
    assert len(pairs) < 0.5 * 50 * len(np.unique(leaf))


def test_ties_repeats_and_hot_vector(spark):
    same = [0.5, 0.5]
    rows = [(i, same, i % 2) for i in range(300)] + [(i, [0.5, 0.25 * (i % 4)], i % 3) for i in range(300, 340)]
    rows += rows[:3] + [(10, [0.25, 0.5], 0), (330, [0.5], 1), (331, [], 1)]
    assert mined(frame_of(spark, rows).repartition(4)) == brute_force(rows, lambda i: i % 10 == 0)


def test_rows_that_take_no_part(spark):
    fine = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.8, 0.3], 2), (3, [-1.0, 0.0], 2), (20, [0.0, 0.0], 1)]
    odd = [(None, [1.0, 0.0], 2), (4, None, 2), (5, [0.9, None], 2), (6, [0.9, float("nan")], 2), (7, [float("inf"), 0.0], 2), (8, [0.9, 0.0], None), (9, [3e7, 0.0], 2)]
    frame = frame_of(spark, [(*r, 1, "x") for r in fine + odd], ", score int, anchor string")
    assert mined(frame) == brute_force(fine, lambda i: i % 10 == 0)
    assert mined(frame.where("vec_id = 1")) == [] and mined(frame.limit(0)) == []


def test_large_components_are_exact(spark):
    rows = [(i, [float(2**22 - i), float(i)], i % 2) for i in range(30)]
    assert mined(frame_of(spark, rows)) == brute_force(rows, lambda i: i % 10 == 0)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = sorted(map(tuple, op11_hard_negatives(spark, folder).collect()))
    assert got == brute_force(rows, lambda i: i % 100 == 0) and got
