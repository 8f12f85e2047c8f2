"""Whitening, ring sharding and periodic runs against brute force and their contracts on small tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_SMALL

from tessera.llm import periodic_runs, sharding, whitening
from tessera.llm import queries as Q

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ------------------------------------------------------------------ op 11
def dense(rows):
    """n, S, V's eigenvalues, eigenvectors and trace of the distinct integer vectors."""
    x = np.unique(np.floor(64 * np.array(rows, float)).astype(np.int64) + 1_000_000, axis=0)
    n, s = len(x), x.sum(axis=0)
    c = (x * n - s) / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    return n, s, e[::-1], q[:, ::-1], np.trace(v)


def test_whitening_equals_the_dense_eigenvectors(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in emb.collect()}
    n, s, e, q, trace = dense(list(rows.values()))
    got = Q.op11_jacobi_davidson_whitening(spark, SF_SMALL).toPandas()
    assert len(got) == 16 * len(rows) and (got.n == n).all() and got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    w = got.pivot(index="vec_id", columns="component", values="whitened")
    x = np.array([np.floor(64 * np.array(rows[i], float)).astype(np.int64) + 1_000_000 for i in w.index])
    want = (x - s / n) @ q[:, :16] / np.sqrt(e[:16])
    sign = np.sign((w.to_numpy() * want).sum(axis=0))
    assert np.abs(w.to_numpy() - want * sign).max() < 1e-7
    each = got.drop_duplicates("component").sort_values("component")
    assert np.allclose(each.explained, e[:16] / trace, rtol=1e-9) and (np.diff(each.explained) <= 0).all()
    far = got.drop_duplicates("vec_id").set_index("vec_id").deviation
    assert all(int(far[i]) == sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for i, r in zip(w.index, x))


@pytest.mark.parametrize("d,k", [(120, 5), (40, 16), (7, 16)])
def test_jacobi_davidson_pairs_are_those_of_a_dense_solver(d, k):
    rng = np.random.default_rng(d)
    u = np.linalg.qr(rng.standard_normal((d, d)))[0]
    for spectrum in (rng.random(d), 0.8 ** np.arange(d), np.r_[np.ones(d // 2 + 1), np.zeros(d - d // 2 - 1)]):
        a = u @ np.diag(spectrum) @ u.T
        passes = []
        values, q = whitening.jacobi_davidson(lambda v: passes.append(v.shape[1]) or a @ v, d, k)
        want = np.sort(spectrum)[::-1][:k]
        assert np.abs(values - want).max() < 1e-13
        assert np.linalg.norm(a @ q - q * values, axis=0).max() < 1e-12
        assert np.abs(q.T @ q - np.eye(len(values))).max() < 1e-13
        assert max(passes) <= k + 4  # products with a few vectors only


def test_minres_solves_the_projected_equations():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((30, 30))
    a = a @ a.T
    away = np.linalg.qr(rng.standard_normal((30, 3)))[0]
    p = np.eye(30) - away @ away.T
    theta, rhs = np.array([1.0, 40.0]), p @ rng.standard_normal((30, 2))
    t = whitening.minres(lambda v: a @ v, theta, away, rhs, 60, 1e-12)
    for j in range(2):
        assert np.linalg.norm(p @ (a - theta[j] * np.eye(30)) @ p @ t[:, j] - rhs[:, j]) < 1e-8 * np.linalg.norm(rhs[:, j])


def test_vectors_survive_packing_in_every_width():
    rng = np.random.default_rng(2)
    y = np.concatenate([rng.integers(-b, b, (5, 4)) for b in (100, 128, 129, 30_000, 32_769, 2 ** 31, 2 ** 33, 2 ** 50)])
    y = np.concatenate([y, [[-128, 0, 0, 127], [128, 0, 0, 0], [-32768, 0, 0, 0], [2 ** 31, 0, 0, -2 ** 31]]])
    packed = whitening.pack_rows(y)
    assert (whitening.unpack_rows(pa.array(packed, pa.binary()), 4) == y).all()
    assert (whitening.unpack_rows(pa.array(packed, pa.binary()).slice(7, 9), 4) == y[7:16]).all()
    assert len(packed[-4]) == 5  # a byte an entry, and one for the width


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(8)
    plain = [[float(v) for v in r] for r in rng.standard_normal((30, 3))]
    nan, inf = float("nan"), float("inf")
    rows = [(i, v, "x", 1.0) for i, v in enumerate(plain)] + [(0, plain[0], "x", None), (None, plain[1], None, 2.0), (50, None, "x", 0.0), (51, [1.0, None, 2.0], "", 0.0),
            (52, [nan, 1.0, 1.0], "", 0.0), (53, [1.0, inf, 1.0], "", 0.0), (54, [-inf, 0.0, 0.0], "", 0.0), (55, [], "", 0.0), (56, [1.0, 2.0], "", 0.0)]
    emb = spark.createDataFrame(rows, "vec_id long, embedding array<double>, y string, v double")
    got = whitening.whiten(emb).collect()
    count = collections.Counter(r.vec_id for r in got)
    assert count == {**{i: 3 for i in range(1, 30)}, 0: 6, None: 3}
    n, s, e, q, trace = dense(plain)
    assert {r.n for r in got} == {n}
    assert [r.explained for r in sorted((r for r in got if r.vec_id == 5), key=lambda r: r.component)] == pytest.approx(list(e / trace))
    one = {(r.component, r.whitened) for r in got if r.vec_id == 0}
    assert len(one) == 3  # repeated rows alike
    flat = spark.createDataFrame([(i, [float(i), 5.0]) for i in range(4)], "vec_id long, embedding array<double>")
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}  # a flat direction has no whitened value
    assert whitening.whiten(emb.limit(0)).collect() == []
    assert whitening.whiten(flat.where("vec_id = 1")).collect() == []
    huge = spark.createDataFrame([(0, [2.0 ** 40]), (1, [0.0]), (2, [1.0])], "vec_id long, embedding array<double>")
    far = {r.vec_id: r.deviation for r in whitening.whiten(huge).collect()}
    assert far[0] is None and far[1] is None  # (3 x - S)^2 does not fit a long


# ------------------------------------------------------------------ op 12
def plain_ring(places, points, owner, room):
    """Shards of keys, by walking the ring key by key, one round of the walk after another."""
    left, out = dict(enumerate(room)), [None] * len(places)
    path = {}
    for i, p in enumerate(places):
        a = int(np.searchsorted(points, p)) % len(points)
        path[i] = (a, list(dict.fromkeys([*owner[a:], *owner[:a]])))
    order = sorted(range(len(places)), key=lambda i: (path[i][0], places[i], i))
    for turn in range(len(room)):
        for i in order:
            if out[i] is None:
                s = path[i][1][turn]
                if left[s]:
                    out[i], left[s] = s, left[s] - 1
    return out


def test_ring_equals_walking_key_by_key(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(500)], "doc_id long, text string")
    points, owner = sharding.ring(5, 6)
    places = {r.doc_id: r.place for r in sharding.placed(docs, points).collect()}
    for slack in (0.0, 0.25):
        got = {r.doc_id: r for r in sharding.shard(docs, 5, 6, slack).collect()}
        keys = list(places)
        want = plain_ring([places[i] for i in keys], points, owner.tolist(), sharding.bounds(500, 5, slack))
        assert [got[i].shard for i in keys] == want
        for s in range(5):
            assert sorted(r.slot for r in got.values() if r.shard == s) == list(range(want.count(s)))


def test_ring_keeps_the_law_on_a_hot_id(spark):
    rows = [(7 if i % 3 == 0 else i, f"text {i % 2}") for i in range(3001)] + [(None, None), (None, ""), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS arc", "2 AS tie", "3 AS rank", "4 AS place")
    got = sharding.shard(docs).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    sizes = collections.Counter(r.shard for r in got)
    assert sorted(sizes) == list(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    assert sharding.shard(docs.limit(0)).collect() == []
    few = sharding.shard(docs.limit(3)).collect()
    assert sorted((r.shard, r.slot) for r in few) == [(0, 0), (1, 0), (2, 0)]


def test_few_rows_move_when_a_shard_is_added(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text")
    for slack, most in ((0.0, 0.30), (0.25, 0.16)):  # modulo would move 0.89
        before = {r.doc_id: r.shard for r in sharding.shard(docs, 8, slack=slack).collect()}
        after = {r.doc_id: r.shard for r in sharding.shard(docs, 9, slack=slack).collect()}
        assert np.mean([before[i] != after[i] for i in before]) < most


# ------------------------------------------------------------------ op 13
def plain_runs(words):
    n, runs = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and not any(all(words[x] == words[x + p] for x in range(i, j + q - p)) for p in range(1, q)):
                runs.add((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def split(text):
    return re.findall("[^\\x20\\x09-\\x0D]+", text or "")


def plain_row(doc_id, text, rule):
    words = split(text)
    tail = rule(doc_id, len(words)) if rule else None
    if tail:
        a, p = tail
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    drop = {x for a, n, q in runs for x in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(words), len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest())


def looping_texts(count):
    rng = np.random.default_rng(13)
    for _ in range(count):
        parts = []
        for _ in range(rng.integers(0, 6)):
            unit = rng.choice(["a", "bb", "é", "d\xa0d"][:rng.integers(1, 5)], rng.integers(1, 7)).tolist()
            parts += unit * int(rng.integers(1, 9)) + unit[:rng.integers(0, len(unit) + 1)]
            if rng.random() < 0.3:
                parts.append(f"u{rng.integers(9)}")
        yield rng.choice([" ", "\n", "\t\x0b "]).join(parts)


def test_runs_equal_brute_force(spark):
    texts = [*looping_texts(400), None, "", " \n", "a", "x " * 6, "x " * 5, "a b " * 4, "a b " * 3 + "a", "a b c " * 4 + "a b"]
    rows = [(i if i % 50 else None, t, "l", "s", 1) for i, t in enumerate(texts)] + [(3, texts[3], None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    for rule in (None, periodic_runs.repeat_tails):
        got = collections.Counter(tuple(r) for r in periodic_runs.periodic_runs(docs, rule).collect())
        assert got == collections.Counter(plain_row(r[0], r[1], rule) for r in rows)
    full = {r.doc_id: r for r in periodic_runs.collapse_runs(docs.where("doc_id > 0")).collect()}
    for i, t in enumerate(texts):
        if i % 50 and i != 3:
            runs = plain_runs(split(t))
            drop = {x for a, n, q in runs for x in range(a + q, a + n)}
            assert [tuple(x) for x in full[i].runs] == runs and full[i].collapsed == " ".join(w for k, w in enumerate(split(t)) if k not in drop)
    assert periodic_runs.periodic_runs(docs.limit(0), periodic_runs.repeat_tails).collect() == []


def test_runs_of_the_registered_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = collections.Counter(tuple(r) for r in Q.op13_periodic_runs(spark, SF_SMALL).collect())
    want = collections.Counter(plain_row(r.doc_id, r.text, periodic_runs.repeat_tails) for r in docs if len(r.text or "") < 6_000)
    assert not want - got and sum(got.values()) == len(docs)
    assert sum(r[2] for r in got) > 5


def test_splitting_loses_no_run_and_ordinary_words():
    rng = np.random.default_rng(4)
    word = np.concatenate([rng.zipf(1.2, 3000) % 5000, np.tile([1, 2, 3], 5), rng.zipf(1.2, 3000) % 5000])
    start, end = periodic_runs.split_by_frequency(word, np.array([0, len(word)]))
    assert (end - start).sum() < 60 and any(a <= 3000 and b >= 3015 for a, b in zip(start, end))
    for a, b in zip(start, end):
        assert min(collections.Counter(word[a:b].tolist()).values()) >= 4


def test_runs_of_texts_that_defeat_polynomial_hashes_and_of_long_ones():
    thue = "a"
    while len(thue) < 4096:
        thue += thue.translate(str.maketrans("ab", "ba"))
    flip = thue.translate(str.maketrans("ab", "ba"))
    words = [thue, flip] * 8  # one word each: different bytes
    s = periodic_runs.Slice([1, 2], pa.array([" ".join(words), " ".join(thue[:2048])]), None)
    assert s.runs.tolist() == [[0, 16, 2]]  # Thue-Morse letters hold no cube
    long = "ab " * 150_000
    assert periodic_runs.Slice([1], pa.array([long + "x " + " ".join(f"w{i % 70_000}" for i in range(290_000))]), None).runs.tolist() == [
        [0, 150_000, 1], [150_001, 290_000, 70_000]]
