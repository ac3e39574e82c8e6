"""The pivot join against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from costcurves.llm import pivot_join, shingles


def brute(rows):
    """{doc_id: (n_shingles, component_id)} of (doc_id, text) rows by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        few = frozenset([tuple(words)]) if words else frozenset()
        sets.append(few if len(words) < 5 else frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {r[0]: (len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets))}


def family(rng, base, copies, most):
    """Copies of a word list with up to ``most`` words replaced, some from a small set of replacements."""
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = rng.choice([f"x{rng.randrange(3)}", f"y{rng.randrange(10**6)}"])
        if rng.random() < 0.3:
            words = words[:rng.randint(len(words) * 3 // 4, len(words))]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("small, few", [(64, 256), (2, 1), (4, 3)])
def test_against_all_pairs(spark, monkeypatch, small, few):
    monkeypatch.setattr(pivot_join, "SMALL", small)
    monkeypatch.setattr(pivot_join, "FEW", few)
    rng = random.Random(small)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=25))
    texts = []
    for copies, length, most in ((40, 60, 6), (25, 30, 3), (12, 12, 2)):
        texts += family(rng, rng.choices(words, k=length), copies, most)
    texts += [passage + " " + " ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(40)]
    texts += [None, "", " \n", "A b", "a  B", "a b c d", "a b c d e", "A B C D E"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    found = pivot_join.linked_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows)


def test_pieces_of_long_texts(monkeypatch):
    """Sets don't depend on where a long text is cut for hashing."""
    rng = random.Random(3)
    long = " ".join(rng.choice(["abc", "De", "é", "k" * rng.randint(1, 40)]) for _ in range(5000)).encode()
    texts = [long, b"a b c d e f", None, b"", b"z" * 3000, long[::2]]
    want = [s.tolist() for s in shingles.shingle_sets(texts)]
    for size in (64, 1000, 4096):
        monkeypatch.setattr(shingles, "PIECE", size)
        assert [s.tolist() for s in shingles.shingle_sets(texts)] == want


def test_edge_rows(spark):
    """Empty tables, null ids, repeated rows, extra columns with names used inside."""
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pivot_join.linked_documents(empty).collect() == []
    rows = [(3, "one two three four five six", 1), (3, "one two three four five six", 1), (7, "one two three four five six", 2),
            (None, "one two three four five six", 3), (9, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, region long").withColumns(
        {"id": F.lit(1), "set": F.lit("x"), "n": F.lit(2), "digest": F.lit(b"1"), "component_id": F.lit(5)})
    found = sorted((tuple(r) for r in pivot_join.linked_documents(df).collect()), key=str)
    assert found == sorted([(3, 2, 3), (3, 2, 3), (7, 2, 3), (None, 2, None), (9, 0, 9)], key=str)
