import base64
import random

import pytest

from tallyspark.llm import tokens as t

tiktoken = pytest.importorskip("tiktoken")
PATH = t.vocabulary("byte_bpe_50k")
TEXTS = [
    "Plain words, don't they're 12345 x!!  \n\n\tend  ", "naïve café 数据提交 🇺🇳 تقرير ﻿  nbsp", "<|endoftext|> is ordinary", "a" * 3000, "ab" * 700 + " " * 900, "é" * 400, "x\x00y", "   ", "\r\n\r\n",
    "".join(chr(random.Random(4).randrange(32, 0x3000)) for _ in range(500)),
]


@pytest.fixture(scope="module")
def public():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=t.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_public_library(public):
    for text in TEXTS:
        assert t.encoder(PATH).encode(text) == public.encode_ordinary(text), text[:40]


def test_short_and_long_merges_agree():
    ranks = t.encoder(PATH).words.ranks
    r = random.Random(2)
    for _ in range(300):
        word = bytes(r.choice(b"aeinrst the\xc3\xa9") for _ in range(r.randrange(1, 60)))
        assert t.merge_short(word, ranks) == t.merge_long(word, ranks)


def test_remembered_words_are_bounded():
    w = t.Words(t.encoder(PATH).words.ranks, most=10)
    for i in range(100):
        w[f"word{i}"]
    assert len(w) <= 10


def test_frame(spark, public):
    rows = [(i, x, 5) for i, x in enumerate(TEXTS)] + [(100, "", 1), (101, None, 1), (100, "again", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = [(r.id, list(r.ids)) for r in t.encode_texts(df, PATH).collect()]
    assert sorted(out) == sorted((i, public.encode_ordinary(x) if x else []) for i, x, _ in rows)
    back = {i: public.decode(ids) for i, ids in out if i < 100}
    assert all(back[i] == x for i, x in enumerate(TEXTS))
    assert t.encode_texts(df.limit(0), PATH).count() == 0
    assert {r.id: r.n_tokens for r in t.count_tokens(df.where("doc_id >= 100 and ids = 1"), PATH, keep=("ids",)).collect()}[101] == 0
