"""The pipeline, stage by stage, against plain versions of its decisions."""

import brute
import numpy as np
from llm_fixtures import *  # noqa: F403
from llm_fixtures import SF
from tokenizers import Tokenizer

import corpus_pipeline
from rollcall.llm import packing, secrets_crf
from rollcall.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "test-stage")
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        before, after = docs.collect(), out.collect()
        seen[name] = len(after)
        if name != "packing":
            assert out.columns == COLUMNS
            kept = {r.doc_id for r in after}
        if name == "language":
            assert len(after) >= 0.99 * len(before) and set(after) <= set(before)
        elif name == "near-duplicates":
            fps = {r.doc_id: brute.fingerprint(r.text) for r in before}
            roots = brute.components(list(fps.values()))
            least = {}
            for i, fp in fps.items():
                least[roots[fp]] = min(i, least.get(roots[fp], i))
            assert kept == set(least.values()) and len(after) == len(kept) and set(after) <= set(before)
        elif name == "decontamination":
            assert kept == {r.doc_id for r in before if not brute.contamination(r.text, items)[4]} and set(after) <= set(before)
        elif name == "secrets":
            old = {r.doc_id: r for r in before}
            assert kept == old.keys()
            for r in after:
                if brute.base_spans(old[r.doc_id].text):
                    assert not brute.base_spans(r.text) and secrets_crf.REDACTED in r.text and r.n_chars == len(r.text)
        else:
            tokenizer = Tokenizer.from_file(packing.vocabulary_path())
            for r in before:
                assert sum(p.length for p in after if p.doc_id == r.doc_id) == 1 + len(tokenizer.encode(r.text, add_special_tokens=False).ids)
            assert np.bincount([p.sequence_id for p in after], [p.length for p in after]).max() <= 4096
        docs = out
    whole = corpus_pipeline.run(spark, SF).collect()
    assert len(whole) == seen["packing"]
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in docs.collect())


def test_odd_rows_pass(spark, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            path = scratch_path(spark, "test-odd")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
        assert name == "packing"
