"""Token files: the coding, the cut at white space, and whole round trips."""

import json
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staylink.llm import token_files as tf

public = pytest.importorskip("public_tokenizers")
WORDS = "word_bpe_49k.json"
ODD = ["", " ", "one", "One ONE  oNe", "a b c　d", "é ́x ñ", "don't DON'T 'll it's'", "12345 1a2b", "\x1c\x1dab\x85",
       "<|endoftext|> a<|startoftext|>b", "İstanbul ΣΑΣ ς", "日本語 テキスト", "🙂🙃 a🙂b", "x" * 3000, "?!.,;:- --- a.b,c", "​‍ a​b",
       "tab\tline\nfeed\r\n\v\f end ", "ﬁ Å K"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public.path(WORDS))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 4096, 10_001])
def test_coding_round_trip(n):
    r = np.random.default_rng(n)
    numbers = (r.integers(0, 1 << 32, n, dtype=np.uint64) >> r.integers(0, 33, n, dtype=np.uint64)).astype(np.uint32)
    control, data = tf.pack(numbers)
    assert len(control) == -(-n // 4)
    assert len(data) == sum(max(1, (int(x).bit_length() + 7) // 8) for x in numbers)
    assert (tf.unpack(control, data, n) == numbers).all()


def test_lengths_at_the_limits():
    numbers = np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], np.uint32)
    control, data = tf.pack(numbers)
    assert [int(c) >> s & 3 for c in control for s in (0, 2, 4, 6)] == [0, 0, 1, 1, 2, 2, 3, 3]
    assert (tf.unpack(control, data, 8) == numbers).all()
    with pytest.raises(ValueError):
        tf.unpack(control, data[:-1], 8)


def test_which_tokenizers_are_cut_at_space():
    assert tf.cuts_at_space(json.load(open(public.path(WORDS))))
    assert not tf.cuts_at_space(json.load(open(public.path("byte_bpe_50k.json"))))


@pytest.mark.parametrize("name", [WORDS, "byte_bpe_50k.json"])
def test_ids_are_those_of_whole_texts(name):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(public.path(name))
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(" \n\t'sS.,ab1é́Σ <|>?🙂") for _ in range(rng.randrange(60))) for _ in range(800)]
    model = tf.Ids(open(public.path(name)).read(), 2)
    for part in (texts, texts[::-1]):  # the second time from memory
        ids, counts = model.of(pa.array(part, pa.large_string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [[*e.ids, 2] for e in whole.encode_batch(part, add_special_tokens=False)]


def test_forgetting_keeps_ids_right(monkeypatch, tokenizer):
    monkeypatch.setattr(tf, "WORDS", 40)
    rng = random.Random(9)
    model = tf.Ids(open(public.path(WORDS)).read(), 2)
    for _ in range(60):
        texts = [" ".join(f"{rng.choice('ab')}{min(rng.randrange(400), rng.randrange(400))}X" for _ in range(30)), ""]
        ids, counts = model.of(pa.array(texts, pa.large_string()))
        assert ids.tolist() == [*tokenizer.encode(texts[0], add_special_tokens=False).ids, 2, 2] and counts[1] == 1
    assert len(model.index) < 100


def expected(tokenizer, rows):
    out, at = [], 0
    ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in rows]
    for (doc_id, _), one in zip(rows, ids):
        out.append((doc_id, at, len(one), zlib.crc32(np.array(one, "<u4").tobytes())))
        at += len(one)
    return out


def test_query_against_the_library(spark, tokenizer, tmp_path):
    rng = random.Random(7)
    rows = [(i * 3 - 60, rng.choice(ODD + [None])) for i in range(200)] + [(9_000, " ".join(f"w{rng.randrange(999)}" for _ in range(20_000)))]
    docs = spark.createDataFrame([(*r, "x", 1, b"z") for r in rows], "doc_id long, text string, ids string, start int, _hash binary")
    docs.repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = tf.op12_token_files(spark, str(tmp_path))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == expected(tokenizer, rows)


def test_ties_nulls_and_small_files(spark, tokenizer, tmp_path):
    """Null ids first, rows of one id together, equal rows spread over ranges;
    files of a block each."""
    rows = [(None, "no id"), (4, "b a"), (4, "a b c"), (5, "z")] + [(7, "copy of one text")] * 60 + [(8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = str(tmp_path / "files")
    got = sorted(tf.token_files(docs, path, public.path(WORDS), block=8, file=40).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 4, 4, 5] + [7] * 60 + [8]
    at = 0
    for r in got:
        assert (r.start, 4 * r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens
    ids = lambda t: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()
    assert sorted(bytes(r.ids) for r in got) == sorted(ids(t or "") for _, t in rows)
    listed = json.load(open(f"{path}/files.json"))
    assert len(listed) > 10 and sum(x["docs"] for x in listed) == len(rows)
    # what no commit lists is not read
    open(f"{path}/part-000000-left-00000.rids", "wb").write(b"torn")
    assert tf.read_ids(spark, path).count() == len(rows)


def test_frequent_ids_come_first(spark, tmp_path):
    docs = spark.createDataFrame([(1, "b b b a"), (2, "b")], "doc_id long, text string")
    rows, size, width = tf.encoded(docs, public.path(WORDS))
    by_rank = tf.by_frequency(rows.withColumn("n", F.lit(0)), size)
    assert sorted(by_rank.tolist()) == list(range(size)) and by_rank[1] == 2  # "b" four times, the end twice


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tf.token_files(docs, str(tmp_path / "none"), public.path(WORDS)).count() == 0
    assert os.path.exists(tmp_path / "none" / "files.json")
