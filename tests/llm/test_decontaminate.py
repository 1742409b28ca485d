import random
import re

from benelake.llm.decontaminate import find_contamination

PATTERN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, items, window=10):
    words = lambda t: PATTERN.findall((t or "").translate(LOWER))
    runs = {}
    for i, t in items:
        w = words(t)
        for j in range(max(1, len(w) - window + 1) if w else 0):
            runs.setdefault(tuple(w[j : j + window]), set()).update([str(i)] if i is not None else [])
    out = []
    for i, t in rows:
        w, ids = words(t), set()
        hit = [False] * len(w)
        for n in {len(r) for r in runs}:
            for j in range(len(w) - n + 1):
                if (key := tuple(w[j : j + n])) in runs:
                    ids |= runs[key]
                    hit[j : j + n] = [True] * n
        out.append((i, len(w), sum(hit), sorted(ids)))
    return out


def found(frame):
    out = []
    for r in frame.collect():
        assert r["n_hit"] == sum(s["n"] for s in r["hit_spans"]) and r["n_items"] == len(r["item_ids"]) and r["contaminated"] == (r["n_hit"] > 0)
        out.append((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]))
    return out


def case(seed):
    chance = random.Random(seed)
    items = [(i, " ".join(chance.choice("abcdefgh") + str(chance.randrange(3)) for _ in range(chance.choice([1, 4, 9, 10, 14, 25])))) for i in range(15)]
    items += [(3, "Shared Item"), (None, "b0 b1"), (90, None), (91, "..."), (92, "a0")]
    rows = [(0, None), (1, ""), (2, "?!"), (3, "shared-ITEM é")]
    for i in range(4, 60):
        words = [chance.choice("abcdefghxyz") + str(chance.randrange(3)) for _ in range(chance.randrange(40))]
        if chance.random() < 0.7:
            w = (chance.choice(items)[1] or "").split()
            words[5:5] = w[chance.randrange(3) :]
        rows.append((i, chance.choice([" ", "--", "\n"]).join(words)))
    return rows, items


def test_matches_brute_force(docs, spark):
    for seed, block in ((1, 1 << 20), (2, 200)):  # the second needs several blocks
        rows, items = case(seed)
        bench = spark.createDataFrame(items, "item_id long, text string")
        got = found(find_contamination(docs(rows), bench, block_bytes=block))
        assert sorted(got) == sorted(plain(rows, items))


def test_empty_tables_and_clashing_columns(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_contamination(docs([]), none).collect() == []
    assert found(find_contamination(docs([(1, "a b")]), none)) == [(1, 2, 0, [])]
    frame = docs([(1, "a b", 5, b"z", 3)], "doc_id long, text string, n_hit int, hit_bits binary, block int")
    (row,) = find_contamination(frame, spark.createDataFrame([(7, "b")], "item_id long, text string"), block_bytes=1).collect()
    assert (row["n_hit"], bytes(row["hit_bits"]), row["block"], row["item_ids"]) == (1, b"z", 3, ["7"])
