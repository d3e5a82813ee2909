"""Periodic runs, embedding whitening and byte-level BPE against brute force and the public library."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm_helpers import SF001, clashing, make_docs, odd_docs, prose  # noqa: F401
from quire.llm import byte_bpe, periodic_runs, queries, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# periodic runs ----------------------------------------------------------------
def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length, root = i - s + q, w[s: s + q]
            if length >= max(24, 3 * q) and not any(q % d == 0 and root == root[:d] * (q // d) for d in range(1, q)):
                out.append((s, length, q))
    return sorted(out)


def collapsed(words, runs):
    dead = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dead)


def repetitive(rng):
    words = []
    for _ in range(rng.randint(1, 5)):
        kinds = rng.choice([1, 2, 3, 60])
        root = [f"w{rng.randrange(kinds)}" for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 16, 17, 33, 64, 130]))]
        words += (root * rng.randint(1, 40))[: rng.randint(1, 700)]
        if rng.random() < 0.3:
            words[rng.randrange(len(words))] = "odd"
    return words[:1500]


def test_runs_match_brute_force(spark, make_docs, odd_docs):
    rng = random.Random(5)
    texts = ["\n ".join(repetitive(rng)) for _ in range(120)]
    docs = make_docs([(100 + i, t) for i, t in enumerate(texts)] + [(900 + i, texts[0]) for i in range(5)])
    docs = docs.union(odd_docs)
    rows = periodic_runs.find_runs(docs).collect()
    text_of = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == docs.count()
    found = 0
    for r in rows:
        if r["doc_id"] in (None, 7):
            continue
        words = WORD.findall(text_of[r["doc_id"]] or "")
        want = brute_runs(words)
        assert [tuple(x) for x in r["runs"]] == want, r["doc_id"]
        assert r["n_words"] == len(words) and r["collapsed"] == collapsed(words, want)
        found += len(want)
    assert found > 150
    long = next(r for r in rows if r["doc_id"] == 7)  # one word 50,000 times
    assert [tuple(x) for x in long["runs"]] == [(0, 50_000, 1)] and long["collapsed"] == "x"


def test_runs_over_many_tiles_and_octaves():
    rng = random.Random(9)
    words = [rng.randrange(50) for _ in range(3000)] * 4
    words[9_000] = 99
    fragments = {}
    for t in periodic_runs.document_tiles(np.array(words, np.int32)):
        for q, s, e in periodic_runs.solve_tile(*t):
            fragments.setdefault(q, []).append((s, e))
    assert list(fragments) == [3000]
    found = fragments[3000]  # word 6000 differs from word 9000
    assert min(s for s, _ in found) == 0 and max(e for s, e in found if s < 6000) == 6000
    assert min(s for s, e in found if e > 6000) == 6001 and max(e for _, e in found) == 9000


def test_run_of_greatest_exponent(spark):
    kind = "array<struct<start:bigint,length:bigint,period:bigint>>"
    rows = spark.createDataFrame([(1, [(0, 30, 10), (5, 60, 20), (9, 31, 10)]), (2, [(4, 60, 20), (4, 30, 10)]), (3, [])],
                                 f"i int, runs {kind}")
    best = {r["i"]: r["b"] and tuple(r["b"]) for r in rows.select("i", periodic_runs.best_run(F.col("runs")).alias("b")).collect()}
    assert best == {1: (9, 31, 10), 2: (4, 60, 20), 3: None}
    swapped = rows.select("i", periodic_runs.best_run(F.sort_array("runs")).alias("b")).where("i = 2").first()["b"]
    assert tuple(swapped) == (4, 30, 10)


def test_runs_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    rows = {r["doc_id"]: r for r in queries.QUERIES["op11_periodic_runs"](spark, SF001).collect()}
    assert len(rows) == len(docs)
    planted = 0
    for d in docs:
        words, h = WORD.findall(d["text"] or ""), zlib.crc32(str(d["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs, r = brute_runs(words), rows[d["doc_id"]]
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert r["n_runs"] == len(runs) and r["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        if runs:
            s, m, q = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]))
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (s, m, q, 1000 * m // q)
        else:
            assert r["start"] is r["length"] is r["period"] is r["exponent_milli"] is None
    assert planted > 5


def test_runs_odd_rows(spark, make_docs, odd_docs, clashing):
    out = periodic_runs.find_runs(clashing(odd_docs)).collect()
    assert len(out) == odd_docs.count()
    assert [(r["n_words"], r["runs"], r["collapsed"]) for r in out if r["doc_id"] in (0, 1, 2)] == [(0, [], "")] * 3
    assert periodic_runs.find_runs(odd_docs.limit(0)).count() == 0
    planted = periodic_runs.with_planted_period(odd_docs).collect()
    assert len(planted) == odd_docs.count()


# whitening --------------------------------------------------------------------
def levels(matrix):
    return np.floor(1024 * np.asarray(matrix, np.float64)).astype(np.int64) + 100_000


@pytest.mark.parametrize("case", ["random", "graded", "few rows", "equal columns", "clusters", "binary", "one column", "identity"])
def test_directions_match_svd(case):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((400, 24))
    r = {"random": base, "graded": base * np.logspace(0, -7, 24), "few rows": base[:5], "one column": base[:, :1],
         "equal columns": np.repeat(base[:, :6], 4, axis=1), "identity": np.eye(24),
         "clusters": np.repeat([5.0, 3.0, 1.0], 8)[:, None] * np.linalg.qr(base[:24])[0],
         "binary": rng.integers(0, 2, (300, 16)) - 0.5}[case]
    r = r if case in ("few rows", "clusters", "identity") else np.linalg.qr(r, mode="r")
    values, axes, square = whitening.directions(r, 24)
    want = np.linalg.svd(r, compute_uv=False)
    rank = int((want > want[0] * 1e-10).sum())
    assert len(values) == rank and np.allclose(values, want[:rank], rtol=1e-7 if case == "graded" else 1e-12)
    assert np.abs(axes.T @ axes - np.eye(rank)).max() < 1e-11
    assert np.abs(r.T @ (r @ axes) - axes * values ** 2).max() < 1e-11 * values[0] ** 2
    assert square == pytest.approx((want ** 2).sum(), rel=1e-12)


def test_no_direction_without_variance():
    for r in (np.zeros((0, 4)), np.zeros((3, 4))):
        values, axes, square = whitening.directions(r)
        assert len(values) == 0 and axes.shape == (4, 0) and square == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("n", T.StringType())]))


def test_whitening_matches_numpy(spark):
    table = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = queries.QUERIES["op12_embedding_whitening"](spark, SF001).collect()
    data = table.collect()
    x = levels([r["embedding"] for r in data])
    n, sums = len(x), x.sum(axis=0)
    z = (x * n - sums) / n
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1], u[:, ::-1]
    assert len(rows) == 8 * n
    row_of = {r["vec_id"]: i for i, r in enumerate(data)}
    white = np.zeros((n, 8))
    for r in rows:
        i = row_of[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == int(((n * x[i] - sums) ** 2).sum())
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
        white[i, r["component"] - 1] = r["whitened"]
    want = z @ u[:, :8] / np.sqrt(e[:8])
    signs = np.sign((white * want).sum(axis=0))
    assert np.abs(white * signs - want).max() < 1e-8
    assert rows[0]["identity_error"] < 1e-10


def test_whitening_over_many_parts(spark):
    rng = np.random.default_rng(1)
    data = rng.standard_normal((900, 6)) * [5, 4, 3, 2, 1, 0.5]
    df = vectors(spark, [(i, v.tolist(), "x") for i, v in enumerate(data)]).repartition(40)
    rows = whitening.whiten(df, 3).collect()
    white = np.array([r["whitened"] for r in rows])
    cov = np.cov(white.T, bias=True)
    assert len(rows) == 900 and np.abs(cov - np.eye(3)).max() < 1e-10 and np.abs(white.mean(axis=0)).max() < 1e-10


def test_whitening_odd_rows(spark):
    good = [(i, [float(i), 1.0, float(i * i % 7)], "x") for i in range(9)]
    odd = [(20, None, None), (21, [], "x"), (22, [1.0, None, 2.0], "x"), (23, [1.0, math.nan, 2.0], "x"),
           (24, [math.inf, 1.0, 2.0], "x"), (25, [1.0, 2.0], "x")]
    df = vectors(spark, good + [good[3], (None, [4.0, 1.0, 2.0], None)] + odd)
    rows = whitening.whiten(df).collect()
    assert sorted(str(r["vec_id"]) for r in rows) == sorted([*map(str, range(9)), "3", "None"])
    assert {len(r["whitened"]) for r in rows} == {2} and {r["n"] for r in rows} == {11}  # one dimension is constant
    assert rows[0]["identity_error"] < 1e-12
    equal = whitening.whiten(vectors(spark, [(1, [2.0, 3.0], "x")] * 3)).collect()
    assert [(r["deviation"], r["whitened"], r["identity_error"]) for r in equal] == [(0, [], 0.0)] * 3
    assert whitening.whiten(vectors(spark, odd)).where("vec_id <> 25").count() == 0
    assert whitening.whiten(df.limit(0)).count() == 0


def test_deviations_beyond_a_long():
    x = levels([[3e8, -3e8], [0.0, 1.0]])
    n, sums = 3_000_000, [int(x[:, 0].sum()), int(x[:, 1].sum())]
    want = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, n, sums).tolist() == want and max(want) > 1 << 63


# byte-level BPE ------------------------------------------------------------------
@pytest.fixture(scope="module")
def reference():
    import tiktoken
    ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_match_the_public_library(spark, make_docs, odd_docs, reference):
    rng = random.Random(2)
    letters = [chr(c) for a, b in ((32, 127), (0xA0, 0x250), (0x400, 0x460), (0x4E00, 0x4E40), (0x1F600, 0x1F640),
                                   (0, 32), (0x2580, 0x2585)) for c in range(a, b)]
    tokens = byte_bpe.read_ranks(RANKS)
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 80))) for _ in range(1500)]
    texts += [b"".join(rng.choices(tokens, k=rng.randint(1, 9))).decode("utf8", "replace") for _ in range(1500)]
    texts += ["<|endoftext|> it's   x", "⁇ ▁ <unk> <s>", "y" * 100_000, "日本" * 30_000, "a-b" * 40_000]
    docs = make_docs(list(enumerate(texts))).union(odd_docs.withColumn("doc_id", F.col("doc_id") + 10_000))
    rows = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    text_of = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] is not None:
            text = text_of[r["doc_id"]] or ""
            assert r["ids"] == reference.encode_ordinary(text), text[:60]
            assert bytes(r["decoded"]) == text.encode()


def test_bpe_query_matches_the_public_library(spark, reference):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    rows = {r["doc_id"]: r for r in queries.QUERIES["op13_byte_bpe"](spark, SF001).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        ids, r = reference.encode_ordinary(d["text"] or ""), rows[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_bpe_remembers_a_bounded_number_of_tokens(monkeypatch, reference):
    monkeypatch.setattr(byte_bpe, "MEMO_TOKENS", 5)
    ids = byte_bpe.TokenIds(byte_bpe.build_model(byte_bpe.read_ranks(RANKS)))
    for text in ("one", "tokenization", "qzxv", "one", "another", "thing", "qzxv", "unbelievably"):
        ids.learn({text})
        assert np.frombuffer(ids([text]), np.int32).tolist() == reference.encode_ordinary(text)
        assert len(ids.known) <= 5


def test_bpe_vocabularies_that_are_refused(tmp_path):
    import base64
    def write(tokens):
        path = tmp_path / f"{len(tokens)}.ranks"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in tokens))
        return str(path)
    single = [(i, bytes([i])) for i in range(256)]
    assert len(byte_bpe.read_ranks(write(single))) == 256
    for bad in (single[:200], single + [(300, b"ab")]):
        with pytest.raises(ValueError):
            byte_bpe.read_ranks(write(bad))


def test_bpe_odd_rows(spark, odd_docs, clashing):
    out = byte_bpe.encode(clashing(odd_docs), RANKS, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "ids"] and out.count() == odd_docs.count()
    assert byte_bpe.encode(odd_docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    some = spark.createDataFrame([(1, None, "old"), (2, [], "old"), (3, [72, 73], "old")], "i int, ids array<int>, decoded string")
    assert {r["i"]: r["decoded"] and bytes(r["decoded"]) for r in byte_bpe.decode(some, RANKS).collect()} == {
        1: None, 2: b"", 3: b"ij"}
