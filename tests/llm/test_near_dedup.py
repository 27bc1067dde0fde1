"""Near-dedup against brute force: recall, repeated and null ids, clashing names, hot keys."""

import random
from itertools import combinations

import pytest

from crestline.llm import common, near_dedup
from crestline.llm.common import read

SF = "/root/testdata/sf0.01"


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def classes(sets, percent=80):
    """The least index reachable from each set by links of Jaccard similarity percent / 100."""
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    for i, j in {p for v in by.values() for p in combinations(v, 2)}:
        if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("width", [2, 5])
def test_every_link_is_found(spark, width):
    docs = sorted((r["doc_id"], r["text"]) for r in read(spark, SF, "documents").collect())
    want = [docs[c][0] for c in classes([shingles(t, width) for _, t in docs])]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.linked(read(spark, SF, "documents"), width).collect()}
    assert [got[k] for k, _ in docs] == want and len(set(want)) < len(want)


def awkward():
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(900)) for _ in range(n))
    base = [text(60) for _ in range(8)]
    rows = [(1, base[0]), (5, base[0]), (5, base[1]), (7, base[2]), (7, base[2] + " " + base[1]), (7, base[2])]
    for i in range(40):
        t = rng.choice(base).split()
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = "x" + str(rng.randrange(99))
        rows.append((rng.choice([None, 5, 7, 100 + i, 200 + i % 5]), rng.choice([" ", "\n"]).join(t)))
    return rows + [(None, base[3]), (None, base[3]), (None, None), (9, None), (9, ""), (9, ""), (11, "two words"), (12, "TWO words"), (13, "two")]


def test_dedup_keeps_the_brute_force_rows(spark):
    rows = [(i, t, None if n % 3 == 0 else "en", str(n % 2), n % 2, "z") for n, (i, t) in enumerate(awkward())]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, _x string, m int, `k.d` string")
    out = near_dedup.dedup(table)
    assert out.columns == table.columns
    got = sorted(map(tuple, out.collect()), key=repr)
    whole = sorted(set(rows), key=repr)
    judged = [r for r in whole if r[0] is not None and shingles(r[1], 5)]
    found = classes([shingles(r[1], 5) for r in judged])
    free = [r for r in whole if r not in judged]
    assert [r for r in got if r not in judged] == free
    kept = [r for r in got if r in judged]
    assert len(kept) == len(set(found))
    for c in set(found):
        group = [r for r, d in zip(judged, found) if d == c]
        assert sum(r in kept for r in group) == 1
        assert next(r for r in kept if r in group)[0] == min(r[0] for r in group)


def test_the_probe_loses_no_text(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    table = spark.createDataFrame([(1, a), (5, a), (5, b), (7, c), (7, c + " " + b)], "doc_id long, text string")
    assert sorted(map(tuple, near_dedup.dedup(table).collect())) == sorted([(1, a), (5, b), (7, c), (7, c + " " + b)])


def test_hot_keys_are_split_without_other_results(spark, monkeypatch):
    monkeypatch.setattr(common, "LEAST_HOT", 2)
    rows = awkward()
    for k in range(30):
        rows.append((300 + k, " ".join(f"w{i}" if i != k else f"u{k}" for i in range(90))))
    table = spark.createDataFrame([r for r in rows if r[0] is not None], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in near_dedup.linked(table, 2).collect()}
    table = [r for r in rows if r[0] is not None]
    sets = [shingles(t, 2) for _, t in table]
    found = classes(sets)
    low = {c: min(table[i][0] for i, d in enumerate(found) if d == c) for c in found}
    assert got == {(table[i][0], low[found[i]] if sets[i] else table[i][0], len(sets[i])) for i in range(len(table))}


def test_components_of_a_hub_and_a_chain(spark, monkeypatch):
    monkeypatch.setattr(common, "LEAST_HOT", 5)
    edges = [(50, i) for i in range(100, 200)] + [(i, i + 1) for i in range(300, 340)] + [(199, 320)]
    got = {r["node"]: r["component"] for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 50 for k in [*range(100, 200), *range(300, 341)])
