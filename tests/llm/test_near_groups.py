"""Groups of near copies that share many signatures cost no more than their members."""

import random

import numpy as np
import pytest

from staylink.llm import jaccard


def near_copies(rng, copies, edits, words=300):
    base = [f"w{rng.randrange(9000)}" for _ in range(words)]
    return [" ".join(f"x{rng.randrange(10 ** 9)}" if k in at else w for k, w in enumerate(base))
            for at in (set(rng.sample(range(words), edits)) for _ in range(copies))]


def test_members_of_many_signatures_are_compared_once(spark):
    """60 signatures of the same 40 near copies are one group of 40; two signatures
    that have but their least member in common stay apart, as they have fewer pairs."""
    near = [(sig, cls, 0, 40, cls) for sig in range(1000, 1060) for cls in range(40)]
    far = [(2000 + k, cls, 100, 30, cls) for k in (0, 1) for cls in (100, *range(101 + 29 * k, 130 + 29 * k))]
    one, apart = jaccard._together(spark.createDataFrame(near + far, "sig long, cls long, least long, members long, component long"))
    assert sorted(map(tuple, one.collect())) == [(0, 40, cls, cls) for cls in range(40)]
    assert sorted(map(tuple, apart.collect())) == sorted((sig, m, cls, part) for sig, cls, _, m, part in far)


@pytest.mark.parametrize("percent, hot", [(90, 2), (80, 2)])
def test_refined_signatures_against_all_pairs(spark, percent, hot, monkeypatch):
    """Every signature apart, nearly all of them refined: no link is lost."""
    rng = random.Random(percent + hot)
    monkeypatch.setattr(jaccard, "_together", lambda o: (o.select("sig", "members", "cls", "component").where("false"),
                                                         o.select("sig", "members", "cls", "component")))
    texts = [t for words in (12, 30, 120) for _ in range(4)
             for edits in (1, max(1, words // 30)) for t in near_copies(rng, 4, edits, words)]
    sets = [{tuple(t.split()[k:k + 3]) for k in range(len(t.split()) - 2)} for t in texts]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((label[i], label[j]))
                label = [lo if v == hi else v for v in label]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(jaccard.jaccard_components(rows, percent=percent, hot=hot).select("doc_id", "component_id").collect())
    assert [got[i] for i in range(len(texts))] == label and len(set(label)) < len(texts)


def test_parities_are_sized_by_the_differences_of_a_link():
    s = np.random.default_rng(4).integers(0, 1 << 63, 300, dtype=np.uint64)
    assert len(jaccard.parities(s)) == 32 and len(jaccard.parities(s, 80)) == 128


def test_refined_keys_of_hot_segments_only_meet():
    """Linked sets whose common signatures are all hot share a key."""
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        for n in (12, 40, 160):
            for _ in range(30):
                a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
                most = 2 * len(a) * (100 - percent) // (100 + percent) // 2
                b = np.unique(np.concatenate([a[most:], rng.integers(0, 1 << 63, most, dtype=np.uint64)]))
                common = len(np.intersect1d(a, b))
                if common * 100 < percent * (len(a) + len(b) - common) or np.array_equal(a, b):
                    continue
                hot = set(jaccard.signatures(a, percent).tolist()) & set(jaccard.signatures(b, percent).tolist())
                x, y = (set(jaccard.refined(v, hot, percent, others_too=False).tolist()) for v in (a, b))
                assert hot and x & y
