"""Token alignment and hard negatives against plain statements of their contracts."""

import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import *  # noqa: F403
from llm_fixtures import SF, clash
from tokenizers import Tokenizer

from rollcall.llm import hard_negatives as H
from rollcall.llm import queries
from rollcall.llm import token_alignment as T
from rollcall.session import conf_scope

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
SPELLED = {i: bytes(T.byte_alphabet()[c] for c in t) for t, i in A.get_vocab().items() if i != 50256}


def tokens(text):
    """[(id, start, end)] of A and of B by the tokenizers themselves."""
    if not text:
        return [], []
    spell = lambda i: bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()
    out = []
    for ids, bytes_of in ((A.encode(" " + text, add_special_tokens=False).ids, SPELLED.get), (B.encode(text), spell)):
        at, spans = 0, []
        for i in ids:
            spans.append((i, at, at + len(bytes_of(i))))
            at = spans[-1][2]
        if b"".join(bytes_of(i) for i in ids) != (" " + text).encode():
            return [], []
        out.append(spans)
    return out


def plain_alignment(texts):
    """The contract, document by document and byte by byte."""
    found, count = [], Counter()
    for text in texts:
        a, b = tokens(text)
        at = defaultdict(set)
        for side, spans in enumerate((a, b)):
            for k, (_, s, e) in enumerate(spans):
                for x in range(s, e):
                    at[x].add((side, k))
        links = {tuple(k for _, k in sorted(v)) for v in at.values()}
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in spans if low <= s and e <= cut) for spans in (a, b)))
            low = cut
        pairs = [(a[i][0], b[j][0]) for i, j in links]
        count.update(pairs)
        found.append((len(a), len(b), len(cuts), pairs, ";".join(groups)))
    top = defaultdict(int)
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    return [(n_a, n_b, n, len(p), sum(count[x] == top[x[1]] for x in p), sum(count[x] for x in p), hashlib.sha256(g.encode()).hexdigest() if n_a else "") for n_a, n_b, n, p, g in found]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
TEXTS = ["Hello wörld, 12345 tokens!", "a  b\n\n c \t d", " ", "x ", "  two", "<|endoftext|> and </s>", "日本語のテキスト🙂 é", "has ▁ inside", "\x00\x01 \r\n;\r x", "a" * 300, "an an an an", "Straße   no break　wide", "\n b", None, "", "the same", "the same"]


@pytest.mark.parametrize("frequent", [1 << 20, 40, 0])
def test_alignment_of_texts(spark, frequent):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    rows = T.align_documents(df, *PATHS, frequent=frequent).collect()
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert [found[i] for i in range(len(TEXTS))] == plain_alignment(TEXTS)
    assert found[7] == (0, 0, 0, 0, 0, 0, "")


def test_alignment_of_the_table(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    want = dict(zip(texts, plain_alignment(texts.values()), strict=True))
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op12_token_alignment(spark, SF).collect()} == want


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab .,'\n\t é日1 ▁<s>\x1c"), max_size=25))
def test_ids_of_long_texts_in_parts(text):
    found = PAIR.ids([text, text + ' x', text])[2]
    a, b = tokens(text)
    assert np.frombuffer(found[0], "<u2").tolist() == [x[0] for x in a]
    assert np.frombuffer(found[1], "<u2").tolist() == [x[0] for x in b]


with open(PATHS[0], encoding="utf-8") as _a, open(PATHS[1], "rb") as _b:
    PAIR = T.Pair(_a.read(), _b.read(), part=4)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.lists(st.integers(1, 4), min_size=1, max_size=30), st.integers(1, 6))
def test_groups_and_links_of_intervals(a, b, size):
    total = min(sum(a), sum(b))
    cut = lambda xs: np.array(sorted({x for x in np.cumsum(xs).tolist() if x < total} | {total}))
    ea, eb = cut(a), cut(b)
    sa, sb = np.r_[0, ea[:-1]], np.r_[0, eb[:-1]]
    ga, gb, la, lb = T.aligned(sa, ea, sb, eb)
    assert {(i, j) for i in range(len(ea)) for j in range(len(eb)) if sa[i] < eb[j] and sb[j] < ea[i]} == set(zip(la.tolist(), lb.tolist(), strict=True))
    common = set(ea.tolist()) & set(eb.tolist())
    assert len(common) == ga[-1] + 1 == gb[-1] + 1 and len(la) == len(ea) + len(eb) - len(common)
    parts = list(T.stretches(ea, eb, size))
    assert [p[0] for p in parts] == [0, *(p[1] for p in parts[:-1])] and parts[-1][1::2] == (len(ea), len(eb))
    assert all(ea[p[1] - 1] == eb[p[3] - 1] for p in parts)


def test_alignment_of_odd_tables(spark, odd, nothing):
    found = T.query(odd)
    rows = sorted(map(str, found.collect()))
    assert len(rows) == odd.count() and sorted(map(str, T.query(clash(odd)).collect())) == rows
    for r in found.collect():
        if r.doc_id in (1, 2) or r.doc_id is None and r.n_a == 0:
            assert tuple(r[c] for c in COLUMNS) == (0, 0, 0, 0, 0, 0, "")
    assert T.query(nothing).count() == 0
    long = [r for r in found.collect() if r.doc_id in (4, 9)]
    assert len(long) == 2 and long[0][1:] == long[1][1:] and long[0].n_links == long[0].n_a + long[0].n_b - long[0].n_groups


VECTORS = "vec_id bigint, embedding array<float>, label int"
MINED = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def duck_mined(spark, df, tmp_path):
    path = str(tmp_path / "embeddings")
    df.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{path}/*.parquet'")
    return sorted(con.execute(H.SQL).fetchall())


def test_mined_table(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = sorted(con.execute(H.SQL).fetchall())
    assert sorted(tuple(r[c] for c in MINED) for r in queries.op13_hard_negatives(spark, SF).collect()) == want and want


def test_mined_with_ties_and_hot_vectors(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(int(i) - 300, [float(x) for x in rng.integers(-2, 4, 6) / 256], int(rng.integers(0, 3))) for i in range(900)]
    rows += [(10_000 + i, [0.01, 0.02, 0.0, 0.01, 0.02, 0.0], 1 + i % 2) for i in range(400)]  # one vector, many rows
    rows += [(50_000, None, 1), (50_050, [float("nan")] * 6, 1), (50_100, [0.5, None, 0.0, 0.0, 0.0, 0.0], 1), (50_150, [0.5] * 6, None), (50_200, [float("inf")] * 6, 2), (None, [0.5] * 6, 1)]
    df = spark.createDataFrame(rows, VECTORS)
    want = duck_mined(spark, df, tmp_path)
    assert sorted(tuple(r[c] for c in MINED) for r in H.query(df).collect()) == want and len(want) > 100
    with conf_scope(spark, spark__sql__shuffle__partitions=3):
        again = H.mine(df.union(df).repartition(7))  # repeated rows count once
        assert sorted(tuple(r[c] for c in MINED) for r in again.collect()) == want
    wider = H.query(clash(df.withColumnRenamed("label", "LABEL").selectExpr("*", "LABEL as label")))
    assert wider.columns == list(MINED) and sorted(tuple(r[c] for c in MINED) for r in wider.collect()) == want


def test_mined_in_blocks_of_several_tasks(spark, tmp_path):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(int(i), [float(x) for x in rng.integers(-40, 90, 8) / 256], int(rng.integers(0, 4))) for i in range(4000)], VECTORS)
    want = duck_mined(spark, df, tmp_path)
    with conf_scope(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        assert sorted(tuple(r[c] for c in MINED) for r in H.query(df).collect()) == want and len(want) > 1000


@pytest.mark.parametrize(("kind", "factor"), [("float", 2.0**70), ("float", 2.0**117), ("double", 2.0**900)])
def test_mined_huge_components(spark, kind, factor):
    rows = [(50, [3.0, 1.0], 1), (1, [2.0, 1.0], 1), (2, [1.0, 1.0], 2), (3, [1.5, 1.5], 2), (4, [9.0, 9.0], 2), (5, [2.0, -1.0], 2)]
    huge = spark.createDataFrame([(i, [x * factor for x in e], label) for i, e, label in rows], f"vec_id bigint, embedding array<{kind}>, label int")
    found = H.query(huge).collect()
    assert sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id) for r in found) == [(50, 1, 1, 3), (50, 1, 2, 5), (50, 1, 3, 2)]
    one = spark.createDataFrame([(i, e, label) for i, e, label in rows] + [(6, [factor, factor], 2), (7, [-factor, 0.0], 1)], huge.schema)
    got = sorted((r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in H.query(one).collect() if r.positive_id == 1)
    assert got == [(1, 3, 7 << 16, 6 << 16), (2, 5, 7 << 16, 5 << 16), (3, 2, 7 << 16, 4 << 16)]


def test_mined_odd_tables(spark):
    assert H.query(spark.createDataFrame([], VECTORS)).count() == 0
    assert H.query(spark.createDataFrame([(50, [0.1], 1)], VECTORS)).count() == 0
    short = [(50, [1.0, 1.0, 1.0], 1), (1, [1.0], 1), (2, [0.7], 2), (3, [], 2), (50, [1.0, 1.0, 1.0], 1)]
    assert [tuple(r) for r in H.query(spark.createDataFrame(short, VECTORS)).collect()] == [(50, 1, 1, 2, 65536, 45824)]
    huge = float(1 << 44)  # scores beyond 64 bits
    rows = [(50, [huge], 1), (1, [huge], 1), (2, [huge * 0.75], 2), (3, [huge * 0.5], 2), (4, [huge * 0.99], 2), (5, [float(1 << 60)], 2)]
    found = H.query(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    assert sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found) == [(50, 1, 1, 2, None, None), (50, 1, 2, 3, None, None)]


@pytest.mark.parametrize(("size", "most"), [(64, 150), (64, 10**6), (1, 5), (5000, 1000), (0, 1), (300, 10**8), (2, 1 << 52)])
def test_scores_are_exact(size, most):
    rng = np.random.default_rng(size)
    a, b = rng.integers(-most, most + 1, (5, size)), rng.integers(-most, most + 1, (8, size))
    a[0], b[0] = most, most
    a[1] = -most
    want = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
    assert H.scores(a, b, max(1, size * most * most)).tolist() == want
    for p in H.primes(size, max(1, size * most * most)):
        assert min(max(size, 1), H.AT_ONCE) * (p // 2) ** 2 <= H.EXACT
