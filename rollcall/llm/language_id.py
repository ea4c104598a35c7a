"""Language identification by nearest centroid.

Every document becomes a normalised TF-IDF vector of hashed character pairs
and triples. Each language is described by several centroids (spherical
k-means over its training documents); a document gets the language of the
centroid with the largest cosine.

Rejection is by distance: that of the text to its centroid, 1 minus their cosine
on the grams of the text. For it grams are told apart by 32 bits, for hashed bins
collide, and the cosine of a text in no known language would grow with its
length. Grams that the language doesn't know count in the text's vector with the
largest weight and meet nothing. Only the text's own grams count in the centroid,
so that short texts are as near as long ones. Each centroid has its own bound,
learned from the documents it was made of. A second guard is the share of the
text's character triples that the training documents of its language hold, which
doesn't depend on the length either: random letters make known pairs.

Defined results: null text, or a text without any letter: ``und``, score 0,
rejected. No training documents: every text is ``und``. Whole texts are used,
however long. A text that shares no triple with its language is always rejected.
Rows without an id, or with another's, are judged like any other; none without an
id is learned from. Of centroids at equal cosine the first in the order of the
languages' names counts; equal texts get equal results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import bounded_examples, documents, fold_is, learned, pick, small

UNDETERMINED = "und"
SCHEMA = "doc_id bigint, lang_pred string, score double, rejected boolean"

_SPACED = np.arange(128, dtype=np.uint32)
_SPACED[[c for c in range(128) if not chr(c).isalpha()]] = 32


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def pairs_and_triples(text: str) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the pairs and triples of the lower-cased text; what is no
    ASCII letter below 128 counts as a space, runs of which are one."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(codes < 128, _SPACED[np.minimum(codes, 127)], codes)
    space = codes == 32
    codes = codes[~(space & np.concatenate(([False], space[:-1])))].astype(np.uint64)
    two = codes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    three = two[:-1] * np.uint64(0x165667B19E3779F9) + codes[2:] * np.uint64(0x27D4EB2F165667C5)
    return two, three


def vectors(batch: list[tuple], bins: int, idf: np.ndarray | None) -> np.ndarray:
    """One row per text, given as its pairs and triples: log(1 + count), weighted by idf, of length 1."""
    parts = [(np.concatenate(both) >> np.uint64(40)).astype(np.int64) & (bins - 1) for both in batch]
    at = np.concatenate(parts) + np.repeat(np.arange(len(parts)) * bins, [len(p) for p in parts])
    counts = np.bincount(at, minlength=len(parts) * bins).reshape(len(parts), bins).astype(np.float32)
    out = np.log1p(counts)
    return out if idf is None else unit(out * idf)


def unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def clustered(rows: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means; starts from the row farthest from those chosen so far."""
    chosen = [unit(rows.mean(axis=0, keepdims=True))[0]]
    while len(chosen) < min(clusters, len(rows)):
        chosen.append(rows[np.argmin((rows @ np.array(chosen).T).max(axis=1))])
    centres = np.array(chosen)
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        centres = unit(np.array([rows[own == k].sum(axis=0) if (own == k).any() else c for k, c in enumerate(centres)]))
    return centres


def short_hashes(triples: np.ndarray) -> np.ndarray:
    return (triples >> np.uint64(32)).astype(np.uint32)


def share_in(known: np.ndarray, triples: np.ndarray) -> float:
    """The share of the triples that is in ``known`` (sorted hashes)."""
    if not len(known) or not len(triples):
        return 0.0
    at = np.minimum(np.searchsorted(known, triples), len(known) - 1)
    return float((known[at] == triples).mean())


def known_triples(own: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """The triples of a language and the least share of them that it accepts,
    from the distinct triples and their counts of each training document.

    One in a hundred documents holds a known triple, so that a few noisy ones
    teach nothing; fewer where that leaves much of the ordinary texts unknown.
    """
    values, held = np.unique(np.concatenate([v for v, _ in own]), return_counts=True)
    for least in (max(2, len(own) // 100), 2, 1):
        # Against the other documents only: its own doesn't count.
        others = values[held > least]
        shares = [np.average(np.isin(v, others), weights=n) for v, n in own]
        if np.median(shares) >= 0.8:
            break
    # Noisy documents in the sample don't lower the bound below half of what is usual.
    bound = max(float(np.quantile(shares, 0.001)), float(np.median(shares)) / 2, 1e-9)
    return values[held >= least], bound


def weighed(values: np.ndarray, counts: np.ndarray, grams: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """A text's known grams (their places in ``grams``), their TF-IDF, and the
    length of its vector with all others, which weigh most."""
    tf = np.log1p(counts)
    at = np.minimum(np.searchsorted(grams, values), len(grams) - 1)
    there = grams[at] == values
    x = tf[there] * idf[at[there]]
    return at[there], x, float(np.sqrt((x**2).sum() + ((tf[~there] * idf[-1]) ** 2).sum()))


def nearness(found: tuple[np.ndarray, np.ndarray, float], centre: np.ndarray) -> float:
    """1 - distance: the cosine on the text's grams; 0 for a text without any."""
    at, x, size = found
    c = centre[at]
    length = size * float(np.sqrt((c**2).sum()))
    return float(x @ c) / length if length > 0 else 0.0


def exact_centres(own_grams: list[tuple[np.ndarray, np.ndarray]], belongs: np.ndarray, langs: np.ndarray, n_centres: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(grams, idf with that of all others at its end, centres on them, the least
    nearness that each centre accepts) of the training documents' grams and centres.

    A gram counts if one in a hundred documents of some language holds it."""
    kept = [np.zeros(0, np.uint32)]
    for lang in sorted(set(langs)):
        own = [own_grams[i][0] for i in np.nonzero(langs == lang)[0]]
        values, held = np.unique(np.concatenate(own), return_counts=True)
        for least in (max(2, len(own) // 100), 2, 1):
            if (held >= least).any():
                break
        kept.append(values[held >= least])
    grams = np.unique(np.concatenate(kept))
    if not len(grams):
        return grams, np.ones(1), np.zeros((n_centres, 0), np.float32), np.full(n_centres, 2.0)
    df = np.zeros(len(grams))
    for values, _ in own_grams:
        at = np.minimum(np.searchsorted(grams, values), len(grams) - 1)
        df[at[grams[at] == values]] += 1
    idf = np.append(np.log((1 + len(own_grams)) / (1 + df)) + 1, np.log(1 + len(own_grams)) + 1)
    found = [weighed(v, n, grams, idf) for v, n in own_grams]
    centres = np.zeros((n_centres, len(grams)))
    for (at, x, size), k in zip(found, belongs, strict=True):
        centres[k, at] += x / max(size, 1e-12)
    near = np.array([nearness(f, centres[k]) for f, k in zip(found, belongs, strict=True)])
    bounds = np.full(n_centres, 2.0)
    for k in set(belongs.tolist()):
        # Half of what is usual: noisy documents don't lower it, a centre of few documents isn't stricter.
        bounds[k] = max(float(np.median(near[belongs == k])) / 2, 1e-9)
    return grams, idf, unit(centres).astype(np.float32), bounds


def counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, counts = np.unique(short_hashes(hashes), return_counts=True)
    return values, counts.astype(np.uint32)


def fit(docs: DataFrame, may_learn, *, per_language: int = 1500, limit: int = 8000, clusters: int = 4, bins: int = 4096) -> dict:
    """Centroids learned from at most ``per_language`` documents of each
    language, ``limit`` in all (the documented bounds of the fit).

    Returns a small dict: idf, centres, the language of each centre, by
    language its known triples and the least share of them that it accepts, and
    the centres on exact grams with the least nearness that each accepts.
    """
    named = pick(docs, doc_id="bigint", lang="string").filter(may_learn & F.col("lang").isNotNull())
    # A language may hold most rows: the smallest hashes of each of its 64 parts, then of those.
    chosen = named.withColumn("_part", F.pmod(F.hash("doc_id"), F.lit(64)))
    for within in (["lang", "_part"], ["lang"]):
        smallest = Window.partitionBy(*within).orderBy(F.xxhash64("doc_id"), "doc_id")
        chosen = chosen.withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= -(-per_language // (16 if len(within) > 1 else 1)))
    rows = bounded_examples(docs, chosen, "doc_id", "lang", limit)

    def learn(batches):
        raw, langs, ids, triples, grams = [], [], [], [], []
        for pdf in batches:
            pdf = pdf[[has_letter(t) for t in pdf["text"]]]
            for at in range(0, len(pdf), 64):
                part = pdf.iloc[at : at + 64]
                both = [pairs_and_triples(t) for t in part["text"]]
                raw.append(vectors(both, bins, None).astype(np.float16))
                triples += [counted(three) for _, three in both]
                grams += [counted(np.concatenate(b)) for b in both]
                langs += part["label"].tolist()
                ids += part["doc_id"].tolist()
        if not ids:
            return {}
        order = np.argsort(np.array(ids))
        m, langs = np.concatenate(raw)[order].astype(np.float32), np.array(langs, dtype=object)[order]
        idf = (np.log((1 + len(m)) / (1 + (m > 0).sum(axis=0))) + 1).astype(np.float32)
        m = unit(m * idf)
        triples, grams = ([x[i] for i in order] for x in (triples, grams))
        centres, names, known = [], [], {}
        belongs = np.zeros(len(m), dtype=np.int64)
        for lang in sorted(set(langs)):
            own = m[langs == lang]
            c = clustered(own, clusters)
            belongs[langs == lang] = len(names) + (own @ c.T).argmax(axis=1)
            centres.append(c)
            names += [lang] * len(c)
            known[lang] = known_triples([triples[i] for i in np.nonzero(langs == lang)[0]])
        return {"bins": bins, "idf": idf, "centres": np.concatenate(centres).astype(np.float32), "langs": names, "known": known, "exact": exact_centres(grams, belongs, langs, len(names))}

    return learned(rows, learn, {})


def judged(whole: list, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, cosine and rejection of each text."""
    pred = np.full(len(whole), UNDETERMINED, dtype=object)
    score, rejected = np.zeros(len(whole)), np.ones(len(whole), dtype=bool)
    usable = [i for i, t in enumerate(whole) if model and t is not None and has_letter(t)]
    for at in range(0, len(usable), 64):
        rows = usable[at : at + 64]
        both = [pairs_and_triples(whole[i]) for i in rows]
        cosine = vectors(both, model["bins"], model["idf"]) @ model["centres"].T
        best = cosine.argmax(axis=1)
        score[rows] = np.clip(cosine[np.arange(len(rows)), best], 0, 1)
        pred[rows] = [model["langs"][b] for b in best]
        grams, gram_idf, centres, bounds = model["exact"]
        for i, (two, three), k in zip(rows, both, best, strict=True):
            known, least = model["known"][pred[i]]
            far = share_in(known, short_hashes(three)) < least
            rejected[i] = far or nearness(weighed(*counted(np.concatenate((two, three))), grams, gram_idf), centres[k]) < bounds[k]
    return pred, score, rejected


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score (cosine), rejected: one row per document."""

    def work(batches):
        for b in small(batches):
            pred, score, rejected = judged(b.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)], ["doc_id", "lang_pred", "score", "rejected"])

    return pick(docs, doc_id="bigint", text="string").mapInArrow(work, SCHEMA)


def known(docs: DataFrame, model: dict) -> DataFrame:
    """The documents (their five columns) that the model doesn't reject."""
    plain = documents(docs)

    def work(batches):
        for b in small(batches):
            yield b.filter(pa.array(~judged(b.column("text").to_pylist(), model)[2]))

    return plain.mapInArrow(work, plain.schema)


def query(docs: DataFrame) -> DataFrame:
    held_out = fold_is("doc_id", 4, 2)
    model = fit(docs, ~held_out)
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; the rejected ones go."""
    return known(docs, fit(docs, F.lit(True)))
