from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetspark.functions.staging import shared_dir
from fleetspark.llm.prefix_trie import prefix_trie, turn_lists
from fleetspark.llm.queries.conversations import op11
from fleetspark.llm.queries.runs import digest, looped, op13
from fleetspark.llm.queries.token_ids import END, TOKENIZER, op12
from fleetspark.llm.token_files import TokenFiles, read_token_files, write_token_files
from fleetspark.llm.word_encoder import WordEncoder
from fleetspark.llm.word_runs import runs, with_runs

SF = "/root/testdata/sf0.001"
EMPTY = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- prefix trie


def trie(conversations: dict[int, list[tuple[str, str]]]) -> set[tuple]:
    """The nodes of a trie from its definition."""
    members: dict[tuple, list[int]] = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for path, ids in members.items():
        below = [q for q in members if q[: len(path)] == path]
        children = [q for q in below if len(q) == len(path) + 1]
        leaves = [q for q in below if not any(r[: len(q)] == q and len(r) > len(q) for r in below)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(conversations[c]) == len(path)))
        parent = min(members[path[:-1]]) if path else None
        out.add((min(ids), len(path), parent, len(ids), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def nodes(df) -> set[tuple]:
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_trie_equals_its_definition(spark):
    rng = random.Random(1)
    spoken = {}
    for c in range(60):
        first = spoken[rng.randrange(c)][: rng.randint(0, 30)] if c and rng.random() < 0.7 else []
        spoken[c * 3 - 20] = first + [(rng.choice(["user", "bot"]), rng.choice(["a", "bé", "", "ccc"])) for _ in range(rng.choice([0, 1, 3, 45]))]
        spoken[c] = spoken[c * 3 - 20]
    rows = [(c, t, r, x, "clash") for c, turns in spoken.items() for t, (r, x) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth string")
    spoken = {c: turns for c, turns in spoken.items() if turns}
    assert nodes(prefix_trie(turn_lists(df))) == trie(spoken)


def test_trie_of_nulls_ties_repeats_and_no_rows(spark):
    rows = [(1, 2, "u", "b"), (1, None, None, None), (1, 2, "u", "a"), (1, 2, "u", "a"), (2, 0, "", ""), (None, 0, "u", "x"), (3, 0, "", "long " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spoken = {1: [("", ""), ("u", "a"), ("u", "a"), ("u", "b")], 2: [("", "")], 3: [("", "long " * 50_000)]}
    assert nodes(prefix_trie(turn_lists(df))) == trie(spoken)
    assert prefix_trie(turn_lists(df.limit(0))).count() == 0


def test_trie_of_very_many_copies_and_one_long_conversation(spark):
    """Joined ids of a hot node are digested in pieces; 300 turns that nobody shares are one step."""
    same = spark.range(20_000).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("u").alias("role"), F.lit("hi").alias("text"))
    long = spark.range(300).select(F.lit(50_000).cast("long").alias("conv_id"), F.col("id").cast("int").alias("turn"), F.lit("u").alias("role"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    got = {(r["depth"], r["conv_id"]): r for r in prefix_trie(turn_lists(same.unionByName(long))).collect()}
    assert len(got) == 302
    hot = got[1, 0]
    assert (hot["n_convs"], hot["saved_tokens"]) == (20_000, 2 * 19_999)
    assert hot["ends_sha256"] == hashlib.sha256(",".join(map(str, range(20_000))).encode()).hexdigest()
    assert (got[0, 0]["n_convs"], got[0, 0]["n_children"], got[0, 0]["n_leaves"]) == (20_001, 2, 2)
    assert got[300, 50_000]["n_children"] == 0 and got[299, 50_000]["parent_conv_id"] == 50_000


def test_op11_equals_its_definition_on_a_whole_table(spark):
    original: dict[int, list] = {}
    for r in sorted(spark.read.parquet(f"{SF}/conversations.parquet").collect(), key=lambda r: (r["conv_id"], r["turn"])):
        original.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = original.get(c - c % 5, [])[:h] + own[h:]
    assert nodes(op11(spark, SF)) == trie(rebuilt)


# ---------------------------------------------------------------- token files


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path(TOKENIZER))


ODD = ["it's. A dog,", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|>", "É é ß İ K", "́a b́,", "x" * 3000, "1,2.", "\xa0a b", "日本。", "a.\n\tB,", "don't we'll", "", "  ", "'s", "!!.", "a<|b"]


def test_word_ids_equal_the_library(library):
    import pyarrow as pa

    rng = random.Random(2)
    sample = [*ODD, *[rng.choice(["", " ", "\n"]).join(rng.choice(ODD) for _ in range(rng.randint(0, 9))) for _ in range(400)]]
    expected = [library.encode(t, add_special_tokens=False).ids for t in sample]
    for remembered in (1 << 20, 300):
        encoder = WordEncoder(P.path(TOKENIZER), remembered)
        for at in range(0, len(sample), 50):
            ids, lengths = encoder.encode(pa.array([*sample[at : at + 50], None]))
            assert [x.tolist() for x in np.split(ids, np.cumsum(lengths))[:-1]] == [*expected[at : at + 50], []]


def test_token_files_there_and_back(spark, library):
    rows = [(5, "b c"), (3, None), (5, "a"), (None, "null id"), (9, ""), (7, "long word " * 40_000), (5, "a"), (-4, "first")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("name", F.lit("clash")).withColumn("n_tokens", F.lit(1))
    folder = f"{shared_dir(spark)}/test-token-files"
    write_token_files(df.repartition(3), folder, P.path(TOKENIZER), END)
    ids = {t: [*library.encode(t or "", add_special_tokens=False).ids, END] for _, t in rows}
    got = sorted(map(tuple, read_token_files(spark, folder).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, -4, 3, 5, 5, 5, 7, 9]
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got[:-1]]]).tolist()
    expected = sorted((d is not None, d or 0, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for d, t in rows)
    assert sorted((r[0] is not None, r[0] or 0, *r[2:]) for r in got) == expected
    files = TokenFiles(spark, folder)
    assert len(files) == 8
    assert files.document(0).tolist() == ids["null id"] and files.document(6).tolist() == ids["long word " * 40_000]
    stream = np.concatenate([files.document(n) for n in range(8)])
    assert files.window(2, len(stream)).tolist() == stream[2:].tolist() and files.window(1, 4).tolist() == stream[1:5].tolist()


def test_token_files_of_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    folder = f"{shared_dir(spark)}/test-no-token-files"
    write_token_files(df, folder, P.path(TOKENIZER), END)
    assert read_token_files(spark, folder).count() == 0 and len(TokenFiles(spark, folder)) == 0


def test_op12_equals_the_library_on_a_whole_table(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got, start = {r["doc_id"]: r for r in op12(spark, SF).collect()}, 0
    assert len(got) == len(texts)
    for d in sorted(texts):
        ids = [*library.encode(texts[d], add_special_tokens=False).ids, END]
        assert tuple(got[d]) == (d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


# ---------------------------------------------------------------- word runs


def brute(words: list) -> list[tuple[int, int, int]]:
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_runs_equal_brute_force():
    rng = random.Random(3)
    texts = [[], [1] * 23, [1] * 24, [0, 1] * 800, [1] * 2000]
    for _ in range(250):
        text = []
        for _ in range(rng.randint(0, 6)):
            unit = [rng.randrange(rng.choice([1, 2, 2, 3, 8])) for _ in range(rng.randint(1, 40))]
            text += (unit * rng.randint(1, 9))[: rng.randint(1, 200)]
        texts.append(text)
    a, b = [0], [0, 1]
    while len(b) < 1000:  # Fibonacci words are full of runs
        a, b = b, b + a
    texts.append(b)
    ids, bounds = np.array([w for t in texts for w in t]), np.cumsum([0, *map(len, texts)])
    got = [[] for _ in texts]
    for text, *run in zip(*(c.tolist() for c in runs(ids, bounds)), strict=True):
        got[text].append(tuple(run))
    assert got == [brute(t) for t in texts]


def test_runs_of_rows_of_every_kind(spark):
    texts = [None, "", " \t\n", "a " * 30 + "b", "x " + "a b " * 20, "x " + "a b " * 20, "w\x0b" * 30, "é\xa0é " * 40_000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, runs int")
    out = with_runs(df)
    assert out.columns == ["doc_id", "text", "runs", "collapsed"] and with_runs(df.limit(0)).count() == 0
    for r in out.collect():
        w = words(texts[r["doc_id"]])
        expected = brute(w) if len(w) < 1000 else [(0, len(w), 1)]
        assert [tuple(x) for x in r["runs"]] == expected
        drop = {k for s, n, q in expected for k in range(s + q, s + n)}
        assert r["collapsed"] == " ".join(x for k, x in enumerate(w) if k not in drop)


def test_loops_of_texts_without_words_or_id(spark):
    df = spark.createDataFrame([(i, t) for i in [None, *range(200)] for t in (None, " ", "one", "a b c")], "doc_id long, text string")
    for r in df.select("*", looped("text", "doc_id").alias("looped")).collect():
        assert r["doc_id"] is not None or r["looped"] == r["text"]
        assert len(words(r["looped"])) == len(words(r["text"]))
    assert digest(df).count() == df.count()


def test_op13_equals_brute_force_on_a_whole_table(spark):
    got = {r["doc_id"]: r for r in op13(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d, text in docs:
        w = words(text)
        h = zlib.crc32(str(d).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if len(w) > 3000:
            continue  # brute force takes the square of the length
        found = brute(w)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
        drop = {k for s, n, q in found for k in range(s + q, s + n)}
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert tuple(got[d]) == (
            d, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in drop).encode()).hexdigest(),
        )
