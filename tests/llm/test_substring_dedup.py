import hashlib
import random
import re

import pytest

from benelake.llm.substring_dedup import remove_repeats


def plain(rows, window):
    """Brute force: (n_words, n_removed, kept words) of each row, in order."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words, strict=True):
        for j in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[j : j + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if i is not None and first[tuple(w[j : j + window])] < i:
                gone[j : j + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def found(frame):
    return [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in frame.collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(docs, seed):
    chance = random.Random(seed)
    passages = [[chance.choice("abcdefg") + str(chance.randrange(9)) for _ in range(30)] for _ in range(4)]
    rows = []
    for i in range(60):
        words = [chance.choice("abc") for _ in range(chance.randrange(30))]
        if chance.random() < 0.6:
            p = chance.choice(passages)
            a = chance.randrange(20)
            words[len(words) // 2 : len(words) // 2] = p[a : a + chance.randrange(31)]
        rows.append((i * 3, chance.choice([" ", "\n ", "\t"]).join(words)))
    assert sorted(found(remove_repeats(docs(rows), window=5, slice_bytes=400, group_suffixes=20))) == sorted(plain(rows, 5))


def test_edge_cases(docs):
    same = "a b c d e f"
    rows = [(1, None), (2, ""), (3, " \n"), (4, same), (4, same), (5, same + " g"), (None, same), (6, "a b"), (7, "x" * 300000), (8, "y " * 3000)]
    assert sorted(found(remove_repeats(docs(rows), window=3)), key=str) == sorted(plain(rows, 3), key=str)


def test_empty_table_and_clashing_columns(docs):
    assert remove_repeats(docs([])).collect() == []
    frame = docs([(1, "a b c d", 7, "s", 1), (2, "z a b c d", 8, None, 2)], "doc_id long, text string, slice int, body string, n_words int")
    rows = {r["doc_id"]: r for r in remove_repeats(frame, window=4, kept_text="text", kept_sha256="digest").collect()}
    assert (rows[2]["text"], rows[2]["slice"], rows[2]["body"], rows[2]["n_words"]) == ("z", 8, None, 5)
    assert rows[1]["digest"] == hashlib.sha256(b"a b c d").hexdigest()


def test_a_passage_in_most_rows_goes_to_one_owner(docs):
    rows = [(i, f"w{i} " + " ".join(f"p{k}" for k in range(20)) + f" v{i}") for i in range(300)]
    assert sorted(found(remove_repeats(docs(rows), window=13))) == sorted(plain(rows, 13))
