"""The training-data operators on small tables: brute force, nulls, empties."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from staylink.llm import (byte_bpe, embeddings, extract, jaccard, merges, mixing, ngram_lm, quality, token_counts,
                          toxicity, urls)

public = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = words(rng, 120)
    near = base.split()
    near[50] = "changed"
    rows = [None, "", " \n\t", "one", "One", "a b", base, base.upper(), " ".join(near), base + " tail end",
            words(rng, 60), "x" * 5000, words(rng, 3000), "é ü  ▁ <s> \x00 end\n\n", "don't  stop now 12345"]
    rows += [words(rng, rng.randrange(1, 40)) for _ in range(12)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", [None, "a", "b", "é"][i % 4], 0, 0.5, True) for i, t in enumerate(texts)]
    rows.append(rows[6])  # a repeated row
    return spark.createDataFrame(rows, DOCS).cache()


def empty(df):
    return df.where("false")


def test_jaccard_against_all_pairs(docs):
    got = {}
    for r in jaccard.jaccard_components(docs).collect():
        got.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    sets = {}
    for r in docs.select("doc_id", "text").collect():
        w = (r.text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        sets[r.doc_id] = ({tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set())
    comp = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
            lo, hi = sorted((comp[a], comp[b]))
            comp = {i: lo if c == hi else c for i, c in comp.items()}
    assert got == {i: {(len(s), comp[i])} for i, s in sets.items()}
    assert jaccard.jaccard_components(empty(docs)).count() == 0


def test_pigeonhole_and_refined_keys_meet():
    """Linked sets share a signature, and below any hot one a refined key."""
    rng = np.random.default_rng(1)
    for n in (5, 12, 40, 160, 700):
        for _ in range(15):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            most = (2 * len(a)) // 19 // 2
            b = np.unique(np.concatenate([a[most:], rng.integers(0, 1 << 63, most, dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if common * 100 < 90 * (len(a) + len(b) - common) or np.array_equal(a, b):
                continue
            shared = set(jaccard.signatures(a).tolist()) & set(jaccard.signatures(b).tolist())
            assert shared
            for hot in list(shared)[:3]:
                assert set(jaccard.refined(a, {hot}).tolist()) & set(jaccard.refined(b, {hot}).tolist())


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((6, 16))
    rows = [(i, [float(x) for x in centre[i % 6] + rng.standard_normal(16) * 0.08], i % 2) for i in range(120)]
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [None] * 16, 1), (203, [float("nan")] * 16, 1), (204, rows[0][1], None),
             (205, rows[0][1], 0), (206, [], 0), (207, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df, block=10).collect()}
    fine = {i: np.array(v) / np.linalg.norm(v) for i, v, lab in rows
            if v and lab is not None and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: lab for i, _, lab in rows}
    links = [(a, b) for a, b in itertools.combinations(fine, 2)
             if label[a] == label[b] and len(fine[a]) == len(fine[b]) and fine[a] @ fine[b] >= 0.98]
    comp = {i: i for i, _, _ in rows}
    for a, b in links:
        lo, hi = sorted((comp[a], comp[b]))
        comp = {i: lo if c == hi else c for i, c in comp.items()}
    assert links and got == {i: (sum(i in p for p in links), comp[i], comp[i] == i) for i in comp}
    assert embeddings.near_duplicates(empty(df)).count() == 0


def test_forest_recall_when_leaves_split():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 32))
    x = np.vstack([x, x + rng.standard_normal(x.shape) * 0.06])
    x /= np.linalg.norm(x, axis=1)[:, None]
    pairs = [(i, i + 1500) for i in range(1500) if x[i] @ x[i + 1500] >= 0.98]
    met = set()
    for _ in range(embeddings.TREES):
        for _, rows in embeddings.leaves(embeddings.grow_tree(x, rng), x):
            inside = set(rows.tolist())
            met |= {p for p in pairs if p[0] in inside and p[1] in inside}
    assert len(pairs) > 300 and len(met) >= 0.95 * len(pairs)


def test_url_rules_and_propagation(spark):
    rows = [(1, "http://A.example.com/en/x", None), (2, "http://www.example.com/en/", ""), (3, "no url", "<a href='//b.org/'>"),
            (4, None, None), (5, "https://x.net/fr/1?q", '<a href="http://bad.org/a">'), (6, "https://bad.org/y", '<a href="http://x.net/fr/">'),
            (7, "http://good.com/", '<a href=https://Fine.org/z>'), (8, "http://fine.org", "<a href='/own'>"), (8, "http://fine.org", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(df).collect()}
    assert got == {1: ("a.example.com", "/en/x", "example.com/en/", "block"), 2: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
                   3: ("", "", None, "allow"), 4: ("", "", None, "allow"), 5: ("x.net", "/fr/1", "net/fr/", "block"),
                   6: ("bad.org", "/y", None, "block"), 7: ("good.com", "/", "com/", "allow"), 8: ("fine.org", "", None, "allow")}
    assert urls.filter_urls(empty(df)).count() == 0


def test_repeated_words_against_windows():
    rng = random.Random(3)
    for _ in range(40):
        w = [b"%d" % rng.randrange(4) for _ in range(rng.randrange(0, 40))]
        at = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        inside = {i + k for i, x in enumerate(at) if at.count(x) > 1 for k in range(5)}
        assert quality.repeated_words(w) == len(inside)
    many = [b"%d" % i for i in range(8000)]  # too many words for one number
    assert quality.repeated_words(many + many[:7]) == 14


def test_quality_rules(spark, docs):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(None, None, None)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in quality.quality_rules(docs, labels).collect()}
    assert rows[0].n_words == 0 and rows[0].base_failed and not rows[0].kept
    assert rows[6].n_words == 120 and rows[6].kept and rows[11].word_chars == 5000
    assert quality.quality_rules(empty(docs), empty(labels)).count() == 0


def test_extraction(spark):
    page = ("<html><head><title>t</title></head><body><nav><a href=/>menu</a></nav><div class='ad'>buy {i}</div><article><h1>Title {i}</h1>"
            "<p><b>One &amp; {i}\n two<br><p>three {i}</p><p class=note>Same words</p><form>x</form><!-- c --><script>var a='</p>'</script>"
            "<div class=comments><p>reader</p></div></article><footer>&copy; end {i}</footer>")
    rows = [(i, "http://h.org/%d" % i, page.replace("{i}", str(i))) for i in range(8)]
    rows += [(20, None, None), (21, "u", ""), (22, "u", "plain <p>text"), (23, "u", "<article><p>cut of"), (1, rows[1][1], rows[1][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in extract.extract(df).collect()}
    for i in range(8):
        assert got[i][0] == f"Title {i} One & {i} two three {i}"  # "Same words" is on every page of the host: template
    assert got[20] == ("", 0) and got[21] == ("", 0) and got[22][0] == "plain text" and got[23][0] == "cut of"
    assert extract.extract(empty(df)).count() == 0


def test_toxicity(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(300):
        w = words(rng, 40).split()
        toxic = i % 5 == 0
        if toxic:
            for x in rng.sample(toxicity.LEXICON[:10], 3) if i % 2 else ["zorgu" + rng.choice("abcdefg") + rng.choice("klmnop") for _ in range(3)]:
                w.insert(rng.randrange(40), x)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    df = spark.createDataFrame(rows + [(900, None), (901, ""), (None, "idiot")], "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(df, lab).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(300))
    assert sum(got[i].predicted == t for i, _, t in labels if got[i].held_out) >= 0.95 * sum(got[i].held_out for i in range(300))
    assert got[900].score == got[901].score < 0.5
    assert toxicity.toxicity(empty(df), empty(lab)).count() == 0


def test_toxicity_mines_rare_and_fixed_insults(spark):
    """One word form in one phrase, and insults of which each is rare, at two sizes."""
    rng = random.Random(9)
    insults = [f"{a}{b}uxq" for a in "bdfgklmnpr" for b in "aeio"]
    for times in (2, 6):
        rows = []
        for i in range(2000 * times):
            w, toxic, at = words(rng, 30).split(), int(i % 5 == 0), rng.randrange(30)
            said = ["you", "are", "a", "zorgumak"] if i % 2 else ["hey", insults[i // 10 % 40]]
            w[at:at] = said if toxic else said[:-1] if i % 2 else said[:1]
            rows.append((i, " ".join(w), toxic))
        rows += [(10 ** 6 + i, "solitary copied qwertyish " + rows[0][1].split("hey")[0], 1) for i in range(50)]  # one text, copied
        stems = toxicity.mined_stems(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
        assert any("zorgumak".startswith(s) for s in stems)
        assert all(any(x.startswith(s) for s in stems) for x in insults)
        assert not any(x.startswith(s) for s in stems for x in ("solitary", "copied", "qwertyish"))


def test_lm_scores(spark, docs, texts):
    got = {r.doc_id: r for r in ngram_lm.lm_scores(docs, shard_chars=4000).collect()}
    rows = docs.select("doc_id", "text").collect()
    tok = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split() + [b"\n"]
    train = [tok(r.text) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    c = {}
    for t in train:
        for w in t:
            c[w] = c.get(w, 0) + 1
    n, v = sum(c.values()), len(c)
    pairs, left = {}, {}
    for t in train:
        for p in zip([None] + t, t):
            pairs[p] = pairs.get(p, 0) + 1
    total = lambda x: len(train) if x is None else c[x]
    pairs = {p: k for p, k in pairs.items() if k >= 2}
    for (a, _), k in pairs.items():
        left[a] = left.get(a, 0) + (k - 0.75) / total(a)
    for i, t in enumerate(texts):
        t = tok(t)
        p1 = {w: (c.get(w, 0) + 1) / (n + v + 1) for w in t}
        score = sum(math.log10((pairs[p] - 0.75) / total(p[0]) * (p in pairs) + max(1e-9, 1 - left.get(p[0], 0)) * p1[p[1]]
                               if p in pairs else max(1e-9, 1 - left.get(p[0], 0)) * p1[p[1]]) for p in zip([None] + t, t))
        assert got[i].n_tokens == len(t) and got[i].train_tokens == n and got[i].n_known == sum(w in c for w in t)
        assert got[i].base_score == pytest.approx(sum(math.log10(p1[w]) for w in t), abs=1e-9 * len(t) + 1e-9)
        assert got[i].score == pytest.approx(score, abs=1e-3 * len(t))
    assert ngram_lm.lm_scores(empty(docs)).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, u in ((1, 5), (7, 100), (1000, 1 << 62), (5000, 6000), (0, 9)):
        v = np.unique(rng.integers(0, u, n)) if n else np.zeros(0, np.int64)
        ask = np.unique(np.concatenate([v, v + 1, [0]])).astype(np.uint64)
        where = {int(x): i for i, x in enumerate(v)}
        assert ngram_lm.EliasFano(ngram_lm.EliasFano.pack(v)).find(ask).tolist() == [where.get(int(x), -1) for x in ask]


def test_token_counts(docs, texts):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in token_counts.count_tokens(docs, public.path("piece_bpe_32k.model")).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n_tokens, got[i].n_bytes) == (len(sp.encode(t or "")), len((t or "").encode()))
    assert token_counts.count_tokens(empty(docs), public.path("piece_bpe_32k.model")).count() == 0


def test_heap_merges_like_the_scan():
    rng = random.Random(2)
    ranks = {"".join(p): r for r, p in enumerate(itertools.chain(itertools.product("ab", repeat=2), itertools.product("ab", repeat=3),
                                                                 itertools.product("ab", repeat=4)))}
    for _ in range(30):
        w = [rng.choice("abc") for _ in range(rng.randrange(1, 47))]
        assert merges.merged(w, ranks) == merges._merged_heap(w, ranks)


def test_byte_bpe_round_trip(docs, texts):
    tiktoken = pytest.importorskip("tiktoken")
    path = public.path("byte_bpe_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    enc = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids_of = lambda t: np.array(enc.encode_ordinary(t), "<u4").tobytes()
    known = byte_bpe.dictionary(docs, ranks, public.PATTERN, frequent=200)
    assert known and all(v == ids_of(w) for w, v in known.items())
    got = {r.doc_id: r for r in byte_bpe.round_trip(docs, path, public.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = ids_of(t or "")
        assert got[i].n_tokens == len(ids) // 4 and got[i].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert byte_bpe.round_trip(empty(docs), path, public.PATTERN).count() == 0


def test_mixing_meets_targets(spark, docs):
    rng = random.Random(9)
    rows = [(i, words(rng, rng.randrange(0, 30)), "hot" if i % 3 else f"s{i % 5}") for i in range(600)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in got.groupBy("target").agg(F.sum("taken").alias("t"), F.max("size").alias("m")).collect():
        assert abs(r.t - r.target) <= r.m
    assert got.where("taken > 2 * size").count() == 0
    null = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert null[0].size == 0 and null[0].taken == 0 and len(null) == docs.select("doc_id").distinct().count()
    assert mixing.mix(empty(docs)).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, str(tmp_path))
        assert out.columns == list(corpus_pipeline.COLUMNS)
        if name == "ngram_jaccard":
            kept = sorted(r.doc_id for r in out.collect())
            assert 6 in kept and 7 not in kept and 8 not in kept and kept.count(6) == 1
    assert set(out.columns) == set(corpus_pipeline.COLUMNS)


def test_pipeline_near_copies_against_all_pairs(spark):
    """Copies of a five-word similarity of 0.8 or more go, also those below op9's own limit."""
    rng = random.Random(11)
    texts, between = [], 0
    for _ in range(12):
        base = words(rng, 200, 4000).split()
        texts.append(base)
        texts += [base + words(rng, extra, 4000).split() for extra in (10, 30, 38, 60)]
        texts.append([w if i % 60 != 30 else f"new{rng.randrange(10 ** 6)}" for i, w in enumerate(base)])
        texts.append([w if i % 25 != 12 else f"new{rng.randrange(10 ** 6)}" for i, w in enumerate(base)])
    texts += [words(rng, rng.randrange(1, 12), 30).split() for _ in range(40)]
    sets = {n: [{tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or {tuple(w)} for w in texts] for n in (3, 5)}
    comp = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        (x3, y3), (x, y) = (sets[3][a], sets[3][b]), (sets[5][a], sets[5][b])
        if 100 * len(x & y) >= 80 * len(x | y):
            between += 100 * len(x3 & y3) < 90 * len(x3 | y3)
            lo, hi = sorted((comp[a], comp[b]))
            comp = [lo if c == hi else c for c in comp]
    df = spark.createDataFrame([(i, " ".join(w), "en", "a", 0, 0.5, True) for i, w in enumerate(texts)], DOCS)
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect())
    assert between >= 12 and kept == sorted(set(comp))
