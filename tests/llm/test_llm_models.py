"""Methods: held-out accuracy, exactness of the searches, patterns, components."""

import zlib

import numpy as np
import pytest
from llm_fixtures import *  # noqa: F403

from rollcall.llm import golay, language_id, packing, queries, secrets_crf, simhash, toxicity_knn, url_filter
from rollcall.llm.components import components

MID = "/root/testdata/sf0.01"


def held(folds, fold):
    return lambda i: zlib.crc32(str(i).encode()) % folds == fold


def area(y, score):
    from pandas import Series

    rank = Series(score).rank().to_numpy()
    y = np.array(y)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_quality_held_out(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    rows = queries.op2_quality(spark, MID).collect()
    assert all(r.held_out == held(3, 1)(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id in truth]
    assert area([truth[r.doc_id] for r in test], [r.score for r in test]) > 0.97


def test_language_held_out(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    rows = queries.op4_language_id(spark, MID).collect()
    test = [r for r in rows if r.held_out]
    assert all(r.held_out == held(4, 2)(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in test]) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.01


def test_language_rejects_the_unlike(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    from pyspark.sql import functions as F

    model = language_id.fit(docs, F.lit(True))
    _, score, rejected = language_id.judged(["漢字仮名交じり文" * 20, "ταυτα λεγει κυριος", "12 34", None], model)
    assert rejected.all() and score.max() < 0.2


def test_language_rejects_the_unlike_at_any_length(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    from pyspark.sql import functions as F

    model = language_id.fit(docs, F.lit(True))
    rng = np.random.default_rng(8)
    scripts = {"Greek": (0x3B1, 25), "Cyrillic": (0x430, 32), "Arabic": (0x628, 35), "Chinese": (0x4E00, 3000), "letters": (ord("a"), 26)}
    salads = {(name, n): " ".join("".join(chr(x) for x in rng.integers(first, first + size, rng.integers(2, 10))) for _ in range(n)) for name, (first, size) in scripts.items() for n in (10, 60, 150, 400, 2000, 10_000)}
    _, _, rejected = language_id.judged(list(salads.values()), model)
    assert [key for key, gone in zip(salads, rejected, strict=True) if not gone] == []
    texts = [r.text for r in docs.collect()]
    assert np.mean(language_id.judged(texts, model)[2]) < 0.01


def test_language_distance_is_stable_over_lengths(spark):
    """Pieces of 5 to 2,000 words of known languages are nearer than the bound
    of their centroid, texts in no known language of any length farther, by
    distance alone."""
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    from pyspark.sql import functions as F

    model = language_id.fit(docs, F.lit(True))
    grams, idf, centres, bounds = model["exact"]

    def near(text):
        found = language_id.weighed(*language_id.counted(np.concatenate(language_id.pairs_and_triples(text))), grams, idf)
        return np.array([language_id.nearness(found, c) for c in centres])

    words = " ".join(r.text for r in docs.filter("lang = 'en'").orderBy("doc_id").limit(200).collect()).split()
    known = {n: np.mean([(near(" ".join(words[a : a + n])) >= bounds).any() for a in range(0, 40 * n, n) if a + n <= len(words)]) for n in (5, 20, 100, 2000)}
    assert min(known.values()) > 0.97, known
    rng = np.random.default_rng(8)
    for first, size in ((0x3B1, 25), (0x430, 32), (0x4E00, 3000), (ord("a"), 26)):
        for n in (5, 100, 10_000):
            text = " ".join("".join(chr(x) for x in rng.integers(first, first + size, rng.integers(2, 10))) for _ in range(n))
            assert (near(text) < bounds).all(), (chr(first), n)


def test_language_vectors_and_centres_by_hand():
    """Weights, centres and nearness on exact grams against plain arithmetic."""
    from collections import Counter
    from math import log, log1p, sqrt

    texts = ["abab cd", "abab ce", "xyz xyz xy", "xyz w", "abab cd cd"]
    belongs, langs = np.array([0, 0, 1, 1, 0]), np.array(["a", "a", "b", "b", "a"], dtype=object)
    pairs = [language_id.pairs_and_triples(t) for t in texts]
    own = [language_id.counted(np.concatenate(p)) for p in pairs]
    grams, idf, centres, bounds = language_id.exact_centres(own, belongs, langs, 2)
    bags = [Counter(language_id.short_hashes(np.concatenate(p)).tolist()) for p in pairs]
    held = Counter(g for b in bags for g in b)
    often = {g for lang in "ab" for g, n in Counter(g for b, x in zip(bags, langs, strict=True) if x == lang for g in b).items() if n >= 2}
    assert often == set(grams.tolist())

    def vector(bag):
        v = {g: log1p(c) * (log(6 / (1 + held[g])) + 1 if g in often else log(6) + 1) for g, c in bag.items()}
        size = sqrt(sum(x * x for x in v.values()))
        return {g: x / size for g, x in v.items()}

    centre = [Counter(), Counter()]
    for b, k in zip(bags, belongs, strict=True):
        for g, x in vector(b).items():
            if g in often:
                centre[k][g] += x
    for k in (0, 1):
        size = sqrt(sum(x * x for x in centre[k].values()))
        assert np.allclose(centres[k], [centre[k][g] / size for g in grams.tolist()])
    for text in (*texts, "abab zz", "q"):
        p = language_id.pairs_and_triples(text)
        v = vector(Counter(language_id.short_hashes(np.concatenate(p)).tolist()))
        for k in (0, 1):
            c = {g: centre[k][g] for g in v if centre[k][g]}
            want = sum(v[g] * x for g, x in c.items()) / sqrt(sum(x * x for x in c.values())) if c else 0.0
            got = language_id.nearness(language_id.weighed(*language_id.counted(np.concatenate(p)), grams, idf), centres[k])
            assert abs(got - want) < 1e-5


def test_language_noise_in_the_sample_keeps_the_bound():
    rng = np.random.default_rng(9)
    words = ["".join(chr(97 + x) for x in rng.integers(0, 26, 5)) for _ in range(80)]
    ordinary = [" ".join(rng.choice(words, 60)) for _ in range(990)]
    noise = ["".join(chr(0x400 + x) for x in rng.integers(0, 200, 30)) for _ in range(10)]
    counted = [np.unique(language_id.short_hashes(language_id.pairs_and_triples(t)[1]), return_counts=True) for t in ordinary + noise]
    _, least = language_id.known_triples(counted)
    assert least >= 0.4


def test_toxicity_held_out(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    rows = queries.op8_toxicity(spark, MID).collect()
    test = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == held(4, 2)(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    clean = [r for r in test if not truth[r.doc_id]]
    assert np.mean([r.predicted for r in clean]) < 0.03
    assert area([truth[r.doc_id] for r in test], [r.score for r in test]) > 0.8


def test_toxicity_recall_and_calibration():
    """Held-out documents of the larger tables: nine toxic ones in ten are
    found, and scores are near the share of toxic documents that get them."""
    import pandas as pd

    big = "/root/testdata/sf0.1"
    labels = pd.read_parquet(f"{big}/labels.parquet").dropna(subset=["toxic"])
    rows = pd.read_parquet(f"{big}/documents.parquet", columns=["doc_id", "text"]).merge(labels, on="doc_id")
    out = rows["doc_id"].map(held(4, 2))
    train, test = rows[~out], rows[out]
    index = toxicity_knn.indexed([(int(d), t or "", int(y)) for d, t, y in zip(train["doc_id"], train["text"], train["toxic"], strict=True)]).build()
    memo = toxicity_knn.known(index.vocabulary)
    score = np.array([toxicity_knn.voted(index, toxicity_knn.coded(t, memo), 15)[0] for t in test["text"]])
    toxic = test["toxic"].to_numpy() == 1
    assert np.mean(score[toxic] >= 0.3) >= 0.9 and np.mean(score[~toxic] >= 0.3) < 0.02
    for low, high in ((0.0, 0.3), (0.3, 0.7), (0.7, 1.01)):
        part = (score >= low) & (score < high)
        assert abs(score[part].mean() - toxic[part].mean()) < 0.25


def test_nearest_of_texts_together():
    """As found one by one, whichever terms are kept as dense rows, and by sums over all examples."""
    rng = np.random.default_rng(5)
    words = ["a", "Ab_cd", "four4", "fivesix-sevens", "ŒUVRES", "İstanbul", "x٣y²", "ﬁnding", *(f"wo{i * 7919 % 1000}rd{i}" for i in range(200))]
    share = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(rng.choice(words, int(n), p=share / share.sum())) for n in rng.integers(1, 60, 700)]
    index = toxicity_knn.indexed([(i, x, int(rng.random() < 0.3)) for i, x in enumerate(texts[:500])]).build()
    memo = toxicity_knn.known(index.vocabulary)
    for x in {c for t in texts for c in t.split()}:
        assert sorted(np.frombuffer(memo[x], np.int32)) == sorted(index.vocabulary[t] for t in toxicity_knn.terms(x) if t in index.vocabulary)
    vectors = [index.vector(toxicity_knn.coded(x, memo)) for x in [*texts[450:], "", "unknown"]]
    whole = np.zeros((len(index), len(index.weight)))
    whole[np.repeat(np.arange(len(index)), np.diff(index.starts)), index.terms] = index.values
    for cells in (toxicity_knn.CELLS, 0, 20 * len(index)):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(toxicity_knn, "CELLS", cells)
            index.build()
        for (at, w), (rows, near) in zip(vectors, index.nearest_of(vectors, 9), strict=True):
            cosines = np.round(whole[:, at] @ w, 9)
            want = sorted((-c, e) for c, e in zip(cosines, index.example, strict=True) if c > 0)[:9]
            assert [(-c, e) for c, e in zip(np.round(near, 9), index.example[rows], strict=True)] == want


def test_nearest_is_exact():
    """The k nearest, their cosines and the votes against all examples, with
    equal vectors, ties and words that no example holds."""
    from collections import Counter

    rng = np.random.default_rng(1)
    words = [f"w{i}x{i * 7919 % 1000}" for i in range(300)]
    share = 1 / np.arange(1, 301)
    text = lambda n: " ".join(rng.choice(words, n, p=share / share.sum()))
    rows = [(i, text(int(rng.integers(1, 60))), int(rng.random() < 0.2)) for i in range(500)]
    rows += [(500 + i, rows[i % 20][1], 1) for i in range(60)] + [(900, "", 0), (901, "", 1)]
    index = toxicity_knn.indexed(rows).build()
    holding = Counter(t for _, x, _ in rows for t in {t for c in x.split() for t in toxicity_knn.terms(c)})
    yes = Counter(t for _, x, y in rows if y for t in {t for c in x.split() for t in toxicity_knn.terms(c)})
    n, p = len(rows), sum(y for *_, y in rows)

    def weight(t):
        b, a = holding[t], yes[t]
        phi = abs(a * (n - p) - (b - a) * p) / np.sqrt(b * (n - b) * p * (n - p)) if 0 < b < n else 0.0
        return (np.log((1 + n) / (1 + b)) + 1) * phi

    def vector(x):
        counts = Counter(t for c in x.split() for t in toxicity_knn.terms(c))
        v = {t: (1 + np.log(c)) * weight(t) for t, c in counts.items() if weight(t) > 0}
        size = np.sqrt(sum(a * a for a in v.values()))
        return {t: a / size for t, a in v.items()}

    vectors = {}
    for i, x, y in rows:
        one = vectors.setdefault(tuple(sorted((t, round(a, 12)) for t, a in vector(x).items())), [i, 0, 0])
        one[1:] = [one[1] + y, one[2] + 1]
    assert len(index) == len([v for v in vectors if v]) and index.none == (1, 2)
    base, memo = p / n, toxicity_knn.known(index.vocabulary)
    for q in [text(int(rng.integers(1, 40))) + " unheard" for _ in range(100)] + [rows[3][1], "unheard", ""]:
        v = vector(q)
        every = sorted(((-round(sum(a * v.get(t, 0) for t, a in u), 6), *own) for u, own in vectors.items() if u))
        every = [e for e in every if e[0] < 0]
        ids = toxicity_knn.coded(q, memo)
        found, near = index.nearest(*index.vector(ids), 7)
        assert np.allclose(near, [-e[0] for e in every[:7]], atol=1e-5)
        votes = [(e[0] ** 2, e[2] / e[3]) for e in every[:15]]
        edge = every[14][0] - every[15][0] if len(every) > 15 else -1.0
        if v and abs(edge) > 1e-5:
            assert abs(toxicity_knn.voted(index, ids, 15)[0] - (sum(a * b for a, b in votes) + base) / (sum(a for a, _ in votes) + 1)) < 1e-4
        if not v:
            assert abs(toxicity_knn.voted(index, ids, 15)[0] - (1 + base) / 3) < 1e-9


def test_viterbi_of_runs_is_that_of_whole_texts(spark):
    documents = spark.read.parquet(f"{MID}/documents.parquet")
    w = secrets_crf.fit(documents)
    tagger = secrets_crf.Tagger(w)
    texts = [r.text for r in documents.collect()] + ["password: hunter2hunter2", "x", "key AbC123dEf456GhI789 = 'Zz9Zz9Zz9Zz9Zz9Zz9'", "a = b1c2d3e4f5a6b7c8d9e0f1a2b3c4 " * 4]
    for text in texts:
        arrays = secrets_crf.looked_up(text, tagger.memo)
        n = len(arrays[0]) - secrets_crf.BEFORE - secrets_crf.AFTER
        if n > 0:
            whole = secrets_crf.viterbi(secrets_crf.emissions(arrays, 0, n, secrets_crf.text_kind(text), w), w["step"], None, None)
            found = tagger.tags(text)
            assert (whole == (np.zeros(len(whole)) if found is None else found)).all()


def test_crf_finds_the_patterns(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    tagger = secrets_crf.Tagger(secrets_crf.fit(docs))
    met = total = 0
    for r in docs.collect():
        base = secrets_crf.base_spans(r.text)
        if base:
            spans = tagger.spans(r.text)
            total += len(base)
            met += sum(any(a < e and b < z for a, _, z in spans) for _, _, e, b in base)
    assert total and met / total > 0.9


def planted_secrets(rng):
    """Ten kinds of secrets that no pattern finds: the text around each, and the secret."""
    signs = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    some = lambda n, of=signs: "".join(rng.choice(list(of), n))
    hexes = "0123456789abcdef"
    return {
        "bearer": lambda: ("Authorization: Bearer {}", f"eyJ{some(18)}.eyJ{some(24)}.{some(20)}"),
        "pwd": lambda: ("pwd = {}", some(14)),
        "code": lambda: ("auth_code={}", some(18)),
        "private": lambda: ("private: {}", f"ghp_{some(36)}"),
        "cloud": lambda: ("aws_key: {}", some(40, signs + "+/")),
        "quoted": lambda: ('credential "{}"', some(16)),
        "sentence": lambda: ("token is {}", some(20)),
        "prefixed": lambda: ("use {} for it", f"sk-{some(32)}"),
        "groups": lambda: ("key {}", "-".join(some(n, hexes) for n in (8, 4, 4, 12))),
        "address": lambda: ("postgres://admin:{}@db/main", some(16)),
    }


def test_crf_finds_secrets_of_kinds_that_no_pattern_finds(spark):
    """Of 200 planted secrets of ten kinds it finds more than half (0.7 when
    written; none after `sk-` and few in addresses), and it adds nothing to
    the documents themselves, in which the patterns find what there is."""
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    tagger = secrets_crf.Tagger(secrets_crf.fit(docs))
    texts = [r.text for r in docs.orderBy("doc_id").collect() if r.text]
    added = [s for t in texts for s in secrets_crf.all_spans(t, tagger)[1] if s[1] == 3]
    assert len(added) <= len(texts) // 200
    clean = [t for t in texts if len(t) > 300 and not secrets_crf.base_spans(t)]
    rng, found = np.random.default_rng(11), {}
    for kind, make in planted_secrets(rng).items():
        for i in range(20):
            around, secret = make()
            words = clean[i * 37 % len(clean)].split(" ")
            text = " ".join([*words[: len(words) // 2], around.format(secret), *words[len(words) // 2 :]])
            a = text.index(secret)
            met = [s for s in secrets_crf.all_spans(text, tagger)[1] if s[0] < a + len(secret) and a < s[2]]
            assert all(s[1] == 3 for s in met)
            found.setdefault(kind, []).append(bool(met))
    assert np.mean([x for v in found.values() for x in v]) > 0.6, {k: np.mean(v) for k, v in found.items()}
    assert sum(np.mean(v) > 0.5 for v in found.values()) >= 7


def test_crf_windows_mask_the_cue(spark):
    """Of a find four windows: as it is, masked, cut, cut with only the naming word left."""
    memo = secrets_crf.Memo(secrets_crf.encoded)
    text = " ".join(["word"] * 20 + ['token = "' + "0a1b2c3d" * 5 + '"'] + ["word"] * 20)
    found = [w for w in secrets_crf.windows(text, memo, 400) if (w[2] == secrets_crf.B).any()]
    assert len(found) == 4
    at = [int(np.nonzero(w[2] == secrets_crf.B)[0][0]) + secrets_crf.BEFORE for w in found]
    cues = [list(w[0][a - 3 : a]) for w, a in zip(found, at, strict=True)]
    plain, naming = secrets_crf.PLAIN, secrets_crf.NAMING
    assert cues == [[naming, 1, 3], [plain] * 3, [naming, 1, 3], [naming, plain, plain]]
    own = [w[0][a] for w, a in zip(found, at, strict=True)]
    assert own[0] == own[1] != own[2] == own[3]
    # A value after a naming word that no pattern finds: no window says it is none.
    unsure = " ".join(["word"] * 10 + ["pwd = Xk29dLq8Pz1mNv"] + ["word"] * 20)
    assert secrets_crf.windows(unsure, memo, 400) == []
    assert len(secrets_crf.windows(" ".join(["word"] * 40), memo, 400)) == 1


def test_crf_learns_from_rare_finds_in_short_texts(spark):
    plain = [(i, f"some plain words number {i} of the text", "en", "a", None) for i in range(1500)]
    rare = [(2000 + i, f"token = Zz9Zz9Zz9Zz9Zz{i}", "en", "a", None) for i in range(2)]
    docs = spark.createDataFrame(plain + rare, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    # Two in 1,500, far more than fit in the sample.
    assert secrets_crf.fit(docs, limit=40, most_windows=60) is not None


def test_crf_spans_keep_what_no_pattern_covers():
    class Fixed:
        def __init__(self, *found):
            self.found = list(found)

        def spans(self, text):
            return self.found

    text = "x password=abcdefgh12 Zz9Zz9Zz9Zz9 ; end"
    a, b = text.index("abcd"), text.index(" ; end")
    base, every = secrets_crf.all_spans(text, Fixed((a, 3, b)))
    assert [s[:3] for s in every if s not in base] == [(text.index("Zz9"), 3, b)]
    assert secrets_crf.redacted(text, every) == "x <SECRET> <SECRET> ; end"
    assert secrets_crf.all_spans(text, Fixed((a, 3, text.index(" Zz9"))))[1] == base  # nothing left
    assert secrets_crf.all_spans("a Zz9 b", Fixed((2, 3, 5)))[1] == [(2, 3, 5)]


def test_redaction():
    text = "say password=abcdefgh12 and 0f0f0f0f0f0f0f0f0f0f0f0f0f0f0f0f now"
    spans = secrets_crf.all_spans(text, None)[1]
    assert secrets_crf.redacted(text, spans) == "say <SECRET> and <SECRET> now"
    assert secrets_crf.redacted("abcdef", [(1, 0, 4), (2, 2, 5)]) == "a<SECRET>f"


def test_golay_keys_meet():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 23, 20_000)
    for flips in range(3):
        other = words.copy()
        for row in range(len(words)) if flips else ():
            for bit in rng.choice(23, flips, replace=False):
                other[row] ^= 1 << int(bit)
        a, b = golay.keys(words), golay.keys(other)
        assert ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any(axis=(1, 2)).all()
    assert len(np.unique(golay.ERRORS)) == 2048


def near(rng, n, most):
    """Fingerprints within up to ``most`` bits of few centres."""
    centres = rng.integers(-(1 << 62), 1 << 62, 5)
    out = centres[rng.integers(0, 5, n)]
    for k in range(n):
        for bit in rng.choice(64, int(rng.integers(0, most + 1)), replace=False):
            out[k] ^= np.int64(np.uint64(1 << int(bit)).astype(np.int64))
    return np.unique(out)


@pytest.mark.parametrize("most", [4000, 20])  # the second puts crowded keys on the other path
def test_links_as_brute_force(spark, most):
    import brute

    fps = near(np.random.default_rng(4), 400, 6)
    edges = simhash.links(spark.createDataFrame([(int(x),) for x in fps], "fp bigint"), most=most).collect()
    for e in edges:
        assert int(e.a ^ e.b & ((1 << 64) - 1)).bit_count() <= 64 and bin((e.a ^ e.b) & ((1 << 64) - 1)).count("1") <= 3
    want = brute.components(fps.view(np.uint64))
    parent = {int(x): int(x) for x in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in edges:
        parent[root(e.a)] = root(e.b)
    groups = lambda f: {frozenset(int(x) for x in fps if f(int(x)) == r) for r in {f(int(x)) for x in fps}}
    assert groups(root) == groups(lambda x: want[x % (1 << 64)])


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(1000, 1000 + i) for i in range(1, 30)]
    found = {r.node: r.component for r in components(spark.createDataFrame(path + star + [(7, 7)], "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(1000, 1030), 1000)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_patterns_hold_the_histogram():
    rng = np.random.default_rng(6)
    for size, most in ((10, 5), (100, 1000), (4096, 100_000)):
        for _ in range(20):
            histogram = {int(x): int(rng.integers(1, most)) for x in rng.integers(1, size + 1, int(rng.integers(1, 60)))}
            found = packing.patterns(histogram, size)
            counts = {}
            for kind, n in found:
                assert sum(kind) <= size and n > 0
                for x in kind:
                    counts[x] = counts.get(x, 0) + n
            assert counts == histogram
            for length, (first, _, _) in packing.places(found).items():
                assert first[0] == 0 and (np.diff(first) > 0).all() and first[-1] < histogram[length]
    assert packing.patterns({}) == []


def test_urls_by_their_lexical_features(spark):
    """Urls of one unruled host get different verdicts where the labelled ones
    differ by digits, length, entropy and parameters, not by names."""
    rng = np.random.default_rng(3)
    words = ["garden", "music", "river", "winter", "market", "story"]
    junk = lambda: "/" + rng.bytes(12).hex() + f"?id={rng.integers(10**9)}&s={rng.integers(10**9)}"
    plain = lambda: "/" + "-".join(rng.choice(words, 2)) + "/"
    rows = [f"https://shop{i % 7}.net{junk()}" for i in range(200)] + [f"https://example.net/en{plain()}" for _ in range(200)]
    asked = [f"https://other.info{junk()}" for _ in range(40)] + [f"https://other.info{plain()}" for _ in range(40)]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(rows + asked)], "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.query(pages).collect()}
    assert len(got) == 480 and all(got[i].rule is None for i in range(400, 480))
    assert np.mean([got[i].verdict == "block" for i in range(400, 440)]) > 0.9
    assert np.mean([got[i].verdict == "allow" for i in range(440, 480)]) > 0.9


def test_url_rates_hold_no_rows_own_label(spark):
    rows = spark.createDataFrame([(i, f"u{i}", "a.b", "s", r, v) for i, (r, v) in enumerate([("x/", "block")] * 30 + [("y/", "allow")] * 10 + [(None, None)])] + [(99, "u", "one.rule", "t", "x/", "block")], "page_id long, url string, suffix string, segment string, rule string, ruled string")
    stats = {r.name: r for r in url_filter.statistics(rows).filter("kind = 'suffix'").collect()}
    joined = rows.join(url_filter.statistics(rows).filter("kind = 'suffix'").withColumnRenamed("name", "suffix"), "suffix").select("page_id", url_filter.fold().alias("fold"), "ruled", url_filter.rate().alias("rate"))
    for r in joined.collect():
        one = stats["a.b"]
        block, known = sum(one.block), sum(one.known)
        if r.page_id == 99:
            assert r.rate == 0.5
        elif r.ruled is None:
            assert abs(r.rate - (block + 2) / (known + 4)) < 1e-12
        else:
            assert abs(r.rate - (block - one.block[r.fold] + 2) / (known - one.known[r.fold] + 4)) < 1e-12


def test_a_language_of_one_document_is_no_reference(spark):
    """Symbols under a language name of their own are judged like those
    without one; clean words of a rare language stay."""
    from rollcall.llm import quality_rules

    rng = np.random.default_rng(5)
    junk = " ".join("".join(rng.choice(list("#*$%&|<>{}~^"), 6)) for _ in range(400))
    rare = " ".join("".join(rng.choice(list("abcdefghijklmnoprstuvz"), int(n))) for n in rng.integers(2, 9, 300))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(-1, junk, "zz", "s", 0), (-2, junk, None, "s", 0), (-3, rare, "yy", "s", 0)], docs.schema.simpleString()[7:-1].replace(":", " "))
    got = {r.doc_id: r for r in quality_rules.query(docs.unionByName(odd)).filter("doc_id < 0").collect()}
    assert not any(got[i].base_failed for i in got) and not got[-1].kept and not got[-2].kept and got[-3].kept
    assert got[-1].class_distance > 0.28
