from __future__ import annotations

import random
import re

import numpy as np
import pytest

from fleetspark.llm import shingle_join
from fleetspark.llm.arrow_text import flat, word_hashes
from fleetspark.llm.components import merge
from fleetspark.llm.shingle_join import _NO_BOX, CountTree, SizeClasses, _first_common, _may_link, _Points, boxes, shingles, similar_components


def brute(texts, width, percent):
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [None, "", " \n", "One", "one", "one two", "ONE two", "one two three"]
    for length in (8, 30, 90, 250):
        base = rng.choices(vocabulary, k=length)
        for _ in range(n // 4):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, length // 25))):
                copy[rng.randrange(length)] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(20)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_components_equal_brute_force(docs, width, percent):
    texts = corpus(percent)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in similar_components(docs(texts), percent, width).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, width, percent)


def test_empty_table_and_null_ids(spark, docs):
    assert similar_components(docs([]).limit(0)).count() == 0
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f")]
    got = similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["id"], r["component_id"]) for r in got) == [(2, 2), (2, 2), (4, 2)]


@pytest.mark.parametrize("percent", [50, 80, 90, 97])
def test_linked_sets_share_an_upper_box(percent):
    rng, classes = np.random.default_rng(percent), SizeClasses(percent)
    for _ in range(150):
        n = int(rng.integers(2, 300))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        cut = int(rng.integers(0, max(1, n * (100 - percent) // 100 + 1)))
        b = np.unique(np.concatenate((a[cut:], rng.integers(0, 1 << 62, int(rng.integers(0, cut + 1))).astype(np.uint64))))
        same = len(np.intersect1d(a, b))
        if not len(b) or 100 * same < percent * (len(a) + len(b) - same) or np.array_equal(a, b):
            continue
        found = []
        for s in (a, b):
            own = classes.of(len(s))
            found.append({x for c in (own, own - 1) if c >= 0 and classes.differing(c) for x in boxes(s, c, classes.differing(c), classes.spare(c)).tolist()})
        assert found[0] & found[1]


def test_tree_finds_what_the_bound_allows():
    rng = np.random.default_rng(5)
    counts = rng.poisson(2, (300, 16)).astype(np.int32)
    sizes = counts.sum(axis=1)
    q, p = CountTree(counts, sizes).search(counts, sizes, 70)
    bound = np.minimum(counts[:, None], counts[None]).sum(axis=2)
    assert set(zip(q.tolist(), p.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(170 * bound >= 70 * (sizes[:, None] + sizes[None]))), strict=True))


def test_texts_that_nearly_link_are_not_offered_from_every_box(docs, monkeypatch):
    rng, found = random.Random(3), []
    base = [f"w{k}" for k in range(300)]
    texts = []
    for _ in range(40):  # pairs of copies share about two thirds of their shingles
        copy = list(base)
        for at in rng.sample(range(300), 7):
            copy[at] = f"x{rng.random()}"
        texts.append(" ".join(copy))
    searched = shingle_join.map_batches

    def spy(df, run, schema):
        out = searched(df, run, schema)
        if schema == "a long, b long":
            found.extend((r["a"], r["b"]) for r in out.collect())
        return out

    monkeypatch.setattr(shingle_join, "map_batches", spy)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in similar_components(docs(texts), 80, 5).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 5, 80)
    assert len(found) == len(set(found)) < 40


@pytest.mark.parametrize("percent", [50, 80, 97])
def test_parities_rule_out_no_link(percent):
    rng = np.random.default_rng(percent)
    for n in (3, 40, 900, 20_000):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        for share in (0, 0.2, 0.5, 1):
            cut = int(share * len(a) * 2 * (100 - percent) / (100 + percent) / 2)
            b = np.unique(np.concatenate((a[cut:], rng.integers(0, 1 << 62, cut).astype(np.uint64))))
            same, sizes = len(np.intersect1d(a, b)), len(a) + len(b)
            parities = tuple(np.array([_Points().of(s)[3]]) for s in (a, b))
            if (100 + percent) * same >= percent * sizes:
                assert _may_link(parities, np.array([sizes]), percent).all()


def test_first_common_box():
    a = np.array([[1, 5, 9], [1, 2, 3], [4, 7, _NO_BOX]])
    b = np.array([[2, 5, 9], [4, 5, 6], [7, _NO_BOX, _NO_BOX]])
    assert _first_common(a, b).tolist() == [5, _NO_BOX, 7]


def test_words_do_not_depend_on_windows_or_rows(monkeypatch):
    import pyarrow as pa

    from fleetspark.llm import arrow_text

    column = pa.array(["ab cd", None, "cd\tAB  é", "", "x" * 50, "ab"])
    whole = word_hashes(*flat(column), fold_case=True)
    monkeypatch.setattr(arrow_text, "WINDOW", 7)
    cut = word_hashes(*flat(column), fold_case=True)
    assert np.array_equal(whole[0], cut[0]) and np.array_equal(whole[1], cut[1])
    assert whole[1].tolist() == [0, 2, 2, 5, 5, 6, 7] and whole[0][0] == whole[0][3] == whole[0][6]
    assert len(shingles(whole[0][:2], 3)) == 1


def test_chain_is_one_component(spark):
    labels = spark.range(40).selectExpr("id", "id AS label")
    links = spark.range(30).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(35, 33), (99, 1)], "a long, b long"))
    got = {r["id"]: r["label"] for r in merge(labels, links).collect()}
    assert got == {i: 0 if i <= 30 else 33 if i in (33, 35) else i for i in range(40)}
