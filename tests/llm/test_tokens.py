from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from fleetspark.llm.bpe_transducer import ByteBpe, Utf8Machine, encode_decode, read_ranks
from fleetspark.llm.queries.bpe import RANKS, digest
from fleetspark.llm.token_counts import TokenCounter, with_token_counts

PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "1", "23", "é", "ß", "日本", "🙂", "!!", "\xa0", "the", "ing", "aaaaaaa", "ththth", "zq", "<|endoftext|>", "|>"]


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def encoding():
    ranks = read_ranks(P.path(RANKS))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_transducer_equals_the_library(encoding):
    codec = ByteBpe(P.path(RANKS), P.PATTERN)
    for t in [*texts(1500), "abcxyzzy" * 20_000, " " * 5000]:
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == encoding.encode_ordinary(t)
        assert b"".join(codec.decode(ids)) == t.encode()


def test_transducer_with_few_states_gives_the_same(encoding):
    codec = ByteBpe(P.path(RANKS), P.PATTERN, max_states=20)
    for t in [*texts(200, 2), "qwertzuiopasdfghjklyxcvbnm" * 30]:
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == encoding.encode_ordinary(t)


def test_pieces_met_again_go_through_the_states(encoding):
    rng = random.Random(8)
    pieces = ["".join(rng.choice(PARTS[:2] + PARTS[8:]) for _ in range(n)).encode() for n in [*range(1, 60), 200] * 3]
    for states in (20, 100_000):
        transducer = ByteBpe(P.path(RANKS), P.PATTERN, max_states=states)._transducer
        for piece in pieces * 4:
            assert transducer.encode(piece) == encoding._core_bpe.encode_single_piece(piece)


def test_machine_holds_back_open_characters():
    text = "aé日🙂b".encode()
    for cut in range(len(text) + 1):
        machine = Utf8Machine()
        first = machine.feed(text[:cut])
        first.decode()  # whole characters only
        assert first + machine.feed(text[cut:]) + machine.end() == text


def test_digest_of_null_empty_and_repeated_rows(spark, docs, encoding):
    rows = {r["doc_id"]: r for r in digest(docs(["the thing", None, "", "the thing"])).collect()}
    ids = encoding.encode_ordinary("the thing")
    assert rows[0]["n_tokens"] == len(ids) and rows[1]["n_tokens"] == rows[2]["n_tokens"] == 0
    assert rows[0]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() == rows[3]["ids_sha256"]
    assert rows[1]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert digest(docs([]).limit(0)).count() == 0
    clash = docs(["a"]).withColumnRenamed("n_tokens", "ids")
    assert encode_decode(clash, P.path(RANKS), P.PATTERN).columns == ["doc_id", "text", "ids", "decoded"]


def test_counts_equal_the_library(spark, docs):
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    sample = [*texts(1500, 3), "xyzzyabc" * 9000]
    expected = [len(e.ids) for e in own.encode_batch(sample, add_special_tokens=False)]
    assert TokenCounter(P.path("byte_bpe_50k.json"), P.PATTERN).count(sample) == expected
    assert TokenCounter(P.path("byte_bpe_50k.json"), P.PATTERN, most=10).count(sample[:300]) == expected[:300]
    counted = with_token_counts(docs(["the <|endoftext|> thing", None, ""]), P.path("byte_bpe_50k.json"), P.PATTERN)
    assert counted.columns == ["doc_id", "text", "n_tokens"]
    got = {r["doc_id"]: r["n_tokens"] for r in counted.collect()}
    assert got == {0: len(own.encode("the <|endoftext|> thing", add_special_tokens=False).ids), 1: 0, 2: 0}
