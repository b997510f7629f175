"""The Merkle manifest against a plain tree, its states, and odd rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from staylink.llm import merkle
from staylink.llm.merkle import Block, levels_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root string, tree long"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(row):
    rows = [row]
    while len(rows[-1]) > 1:
        rows.append([H("".join(rows[-1][i:i + 3])) for i in range(0, len(rows[-1]), 3)])
    return rows


def siblings(rows, k):
    for row in rows[:-1]:
        first = k - k % 3
        yield row[first:k], row[k + 1:first + 3]
        k //= 3


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        own = H("".join(map(field, (doc_id, source, lang, n_chars, text))))
        changed = own
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            changed = H("".join(map(field, (doc_id, source, lang, n_chars, text.replace("\n", "")))))
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, own, changed, doc_id))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([r[2] for r in sorted(groups[s])]) for s in order}
    top = plain_tree([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for k, (_, _, own, changed, doc_id) in enumerate(sorted(groups[s])):
            path = [*siblings(trees[s], k), *siblings(top, at)]
            digest = changed
            for left, right in path:
                digest = H("".join([*left, digest, *right]))
            proof = H("".join(d for level in path for side in level for d in side))
            out.append((doc_id, own, trees[s][-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return out


def check(spark, rows, tmp_path, levels=merkle.LEVELS):
    docs = spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))
           for r in merkle.op13_merkle(spark, str(tmp_path), levels).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    return got


@pytest.mark.parametrize("levels", [1, 2])
def test_against_a_plain_tree(spark, tmp_path, levels):
    """Small blocks, so that every kind of round occurs; nulls, ties, repeated
    rows, a hot source, very long texts, clashing extra columns."""
    rng = random.Random(levels)
    rows = [(i, rng.choice(["a\nb", "plain", "", None, "é\n\nü\n"]), rng.choice(["en", None]),
             rng.choice(["hot"] * 12 + ["a", "", None, "é", "z", "Z", "ab", "b", "c", "d", "e"]), rng.choice([None, i])) for i in range(120)]
    rows += [rows[3]] * 5 + [(None, "x\ny", "en", "hot", 1), (None, None, None, None, None), (7, "other\n", "en", "hot", 1),
                             (500, "line\n" * 200_000, "en", "alone", 1)]
    got = check(spark, rows, tmp_path, levels)
    assert {v for *_, v in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_few_rows(spark, tmp_path, n):
    check(spark, [(i, "a\nb", "en", "s", 3) for i in range(n)], tmp_path)


def test_null_ids_are_not_tampered_with(spark):
    docs = spark.createDataFrame([(None, "a\nb", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    assert merkle.leaves(docs, F.when(even, F.lit("z"))).first().tampered is None


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 100])
def test_fold_resumes_the_state_before_the_slot(n):
    row = [H(str(i)) for i in range(n)]
    block = Block(row, levels_of(n))
    assert block.root == plain_tree(row)[-1][0]
    for k in range(n):
        changed = [*row[:k], H("other"), *row[k + 1:]]
        assert block.fold(k, H("other")) == plain_tree(changed)[-1][0]
        assert block.fold(k, row[k]) == block.root
        assert list(block.siblings(k)) == list(siblings(plain_tree(row), k))
