import random
import re

import pytest

from benelake.llm.components import components
from benelake.llm.jaccard_join import near_duplicate_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(rows, n):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        out[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    return out


def plain(rows, n, share):
    sets = sets_of(rows, n)
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return sorted((i, len(sets[i]), top(i)) for i in ids)


def found(frame):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in frame.collect())


@pytest.mark.parametrize(("seed", "n", "share"), [(1, 3, 90), (2, 5, 80), (3, 1, 60)])
def test_matches_brute_force(docs, seed, n, share):
    chance = random.Random(seed)
    base = [[chance.choice("abcdefghij") + str(chance.randrange(30)) for _ in range(chance.randrange(5, 120))] for _ in range(8)]
    rows = [(0, None), (1, ""), (2, " "), (3, "One"), (4, "one"), (5, "one two"), (6, "ONE  two")]
    for i in range(7, 90):
        words = list(chance.choice(base))
        for _ in range(chance.choice([0, 0, 1, 1, 2, 4, 8])):
            words[chance.randrange(len(words))] = "new" + str(chance.randrange(9))
        rows.append((i, " ".join(words[: len(words) - chance.choice([0, 0, 1, 3])])))
    assert found(near_duplicate_components(docs(rows), shingle=n, share=share, slice_bytes=2000)) == plain(rows, n, share)


def test_edge_cases(docs):
    assert near_duplicate_components(docs([])).collect() == []
    text = " ".join(f"w{k}" for k in range(40))
    frame = docs([(9, text, 1, "a"), (9, text, 2, "b"), (5, text + " x", 3, "c"), (None, text, 4, "d"), (7, None, 5, "e")], "doc_id long, text string, component_id int, n string")
    rows = sorted((r["doc_id"] or 0, r["n"], r["component_id"]) for r in near_duplicate_components(frame).collect())
    assert rows == [(0, "d", None), (5, "c", 5), (7, "e", 7), (9, "a", 5), (9, "b", 5)]


def test_components(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(3, 9), (9, 3), (4, 4), (None, 3), (8, 100), (100, 7)]
    got = {r["id"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 20 for i in range(20, 61)}, 3: 3, 9: 3, 8: 7, 100: 7, 7: 7}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
