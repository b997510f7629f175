"""The Elias-Fano levels: values by place, search between places, a context with very many successors."""

import time

import numpy as np
import pytest

from staylink.llm import ngram_lm
from staylink.llm.ngram_lm import EliasFano


@pytest.mark.parametrize("n,u", [(1, 5), (7, 100), (1000, 1 << 62), (5000, 6000), (64, 64), (3000, 1 << 40)])
def test_values_and_bounded_search(n, u):
    rng = np.random.default_rng(n)
    v = np.unique(rng.integers(0, u, n)).astype(np.uint64)
    ef = EliasFano(EliasFano.pack(v))
    places = np.arange(len(v))
    assert (ef.value(places) == v).all()
    begin = rng.integers(0, len(v) + 1, len(v))
    end = rng.integers(0, len(v) + 1, len(v))
    want = np.where((begin <= places) & (places < end), places, -1)
    assert (ef.find(v, begin, end) == want).all()
    assert (ef.find(v + np.uint64(1)) == np.where(np.isin(v + np.uint64(1), v), places + 1, -1)).all()


def level(tmp_path, successors):
    """A shard of the second level whose context k has ``successors[k]``."""
    first = np.cumsum([0] + [len(s) for s in successors])
    final = np.array([s[-1] + 1 for s in successors], np.uint64)
    base = np.cumsum(final) - final
    folder = str(tmp_path / "b0")
    ngram_lm.save(folder, "context", EliasFano.pack(np.arange(len(successors))))
    ngram_lm.save(folder, "pointer", EliasFano.pack(first))
    ngram_lm.save(folder, "next", EliasFano.pack(np.concatenate([s + b for s, b in zip(successors, base.astype(np.int64))])))
    ngram_lm.save(folder, "backoff", ngram_lm.quantise(np.full(len(successors), -1.0)))
    ngram_lm.save(folder, "prob", ngram_lm.quantise(np.full(first[-1], -2.0)))
    return ngram_lm.Level2(str(tmp_path), 1, {0})


def test_a_context_of_100000_successors(tmp_path):
    rng = np.random.default_rng(3)
    words = 1_000_000
    successors = [np.sort(rng.choice(words, k, replace=False)) for k in (3, 100_000, 1, 20_000, 5)]
    found = level(tmp_path, successors)
    context = np.sort(rng.integers(0, 7, 20_000))
    word = rng.integers(0, words, 20_000)
    pick = rng.random(20_000) < 0.5
    word[pick] = [rng.choice(successors[c]) if c < 5 else w for c, w in zip(context[pick], word[pick])]
    part, backoff = found.find(context, word)
    sets = [set(s.tolist()) for s in successors] + [set(), set()]
    has = np.array([w in sets[c] for c, w in zip(context.tolist(), word.tolist())])
    assert np.allclose(part, np.where(has, 0.01, 0.0), rtol=1e-3)
    assert np.allclose(backoff, np.where(context < 5, 0.1, 1.0), rtol=1e-3)
    began = time.process_time()
    found.find(np.full(5000, 1), rng.choice(successors[1], 5000))
    assert time.process_time() - began < 0.5  # 15 s by walking through the values that share the high bits


def test_missing_shard_is_an_error(tmp_path):
    with pytest.raises(FileNotFoundError):
        ngram_lm.Level2(str(tmp_path), 2, {1}).find(np.array([1]), np.array([4]))
