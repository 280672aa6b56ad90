from __future__ import annotations

import random
from collections import Counter, defaultdict
from math import log

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from fleetspark.llm.bpe_transducer import read_ranks
from fleetspark.llm.mixing import Settings, mixed, schedule, solve, weights
from fleetspark.llm.queries.bpe import RANKS


def test_exponent():
    words = [10_000, 3_000, 500, 500]
    a = solve(words, Settings(entropy=0.9, passes=100))
    assert abs(-sum(w * log(w) for w in weights(words, a)) - 0.9 * log(4)) < 1e-6
    b = solve(words, Settings(entropy=1.0, passes=3))
    each = [w / t for w, t in zip(weights(words, b), words, strict=True)]
    assert abs(max(each) / min(each) - 3) < 1e-6
    assert solve([5, 5]) == 1.0 and solve([7]) == 1.0


@pytest.fixture(scope="module")
def sources(spark):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(1, 50), "big" if i % 3 else "small" if i % 2 else None) for i in range(900)]
    return spark.createDataFrame([*rows, (1000, None, "bare"), (1001, "", "bare")], "doc_id long, text string, source string"), rows


def test_schedule(sources):
    df, rows = sources
    s = Settings(entropy=1.0, passes=4, block_words=2_000, range_rows=50)
    got = schedule(df, settings=s).collect()
    copies = Counter(r["id"] for r in got)
    assert set(copies) == {r[0] for r in rows} | {1000, 1001} and max(copies.values()) <= 4
    own, total = defaultdict(int), defaultdict(int)
    for i, t, source in rows:
        total[source] += len(t.split())
        own[source] += len(t.split()) * copies[i]
    goal = dict(zip(total, weights(list(total.values()), solve(list(total.values()), s)), strict=True))
    for source in total:
        assert abs(own[source] / sum(own.values()) - goal[source]) < 0.01
    # Every block but the last holds each source by its weight, within a document on either side.
    last, held = max(r["block"] for r in got), defaultdict(int)
    for r in got:
        held[r["block"], r["source"]] += r["n_words"]
    for b in range(last - 1):
        for source in total:
            assert abs(held[b, source] - goal[source] * 2_000) <= 100
    orders = [[r["id"] for r in sorted((x for x in got if x["pass"] == k and x["source"] == "small"), key=lambda x: (x["block"], x["order"]))] for k in (0, 1)]
    assert orders[0] != orders[1] and orders[0] != sorted(orders[0])


def test_mixed_keeps_columns_and_repeats(spark, sources):
    df, _ = sources
    out = mixed(df.withColumnRenamed("source", "s").withColumn("order", F.lit("x")), source="s")
    assert out.columns == ["doc_id", "text", "s", "pass", "block", "order"] and out.select("doc_id").distinct().count() == 902
    assert mixed(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, "c", "x")], "doc_id long, text string, source string")
    assert sorted(r["doc_id"] for r in mixed(twice).collect()) == [1, 1, 2]


def test_pipeline_on_planted_documents(spark, tmp_path):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(800)]

    def clean(n):
        return rng.choices(vocabulary, k=n)

    rows, labels, gone, kept, near = [], [], set(), set(), []

    def add(words, quality=1, toxic=0, labelled=True):
        i = len(rows)
        rows.append((i, " ".join(words), "en", "src0" if i % 3 else f"src{i % 7}", 0))
        if labelled:
            labels.append((i, quality, toxic))
        return i

    for k in range(360):
        kept.add(add(clean(rng.randint(60, 120)), labelled=k % 2 == 0))
    for k in range(60):
        gone.add(add([w + "##" for w in clean(80)], quality=0, labelled=k % 2 == 0))
    for k in range(90):
        words = clean(80)
        words[7], words[30] = rng.choice(["vilest", "nastiest"]), "rotten"
        gone.add(add(words, toxic=1, labelled=k % 3 > 0))
    gone.add(add(clean(5)))
    for _ in range(5):
        base = clean(100)
        first = add(base)
        copy = list(base)
        copy[50] = "changed"
        near.append((first, add(copy), add(base)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r["doc_id"] for r in got}
    assert not ids & gone
    assert len(kept - ids) <= 0.01 * len(kept)
    for first, *copies in near:
        assert first in ids and not ids & set(copies)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path(RANKS)), special_tokens={})
    assert all(r["n_tokens"] == len(own.encode_ordinary(rows[r["doc_id"]][1])) for r in got)
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None] and np.all([callable(f) for _, f in corpus_pipeline.STAGES])
