"""Equality is that of bytes: strings on which polynomial hashes collide, and ids with several texts."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

import public_tokenizers
from tessera.llm import components, kernels, near_duplicates, packing, quality, repeats, token_counts

TOK = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def thue_morse(n, a="t", b="h"):
    s = a
    while len(s) < n:
        s += s.translate(str.maketrans(a + b, b + a))
    return s[:n], s.translate(str.maketrans(a + b, b + a))[:n]


def test_hashes_of_long_strings_differ():
    for n in (256, 1024, 4096):
        one, two = thue_morse(n)
        buf = np.frombuffer((one + two).encode(), np.uint8)
        h = kernels.Prefix(buf).hash(np.array([0, n]), np.array([n, 2 * n]))
        assert h[0] != h[1]


def test_token_counts_and_pieces_of_colliding_texts(spark):
    texts = [t for n in (1024, 2048, 8192) for t in thue_morse(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    want = {i: TOK.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs).collect()} == {i: len(x) for i, x in want.items()}
    for r in packing.pack(docs).collect():
        ids = [*want[r.doc_id], 1][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_colliding_lines_and_words_are_not_repeats():
    one, two = thue_morse(4096)
    words = [f"{w} a b c d" for w in (one, two)]
    found = quality.base(*kernels.utf8(pa.array([f"{one}\n{two}\n", f"{one}\n{one}\n{two}", "\n".join(words), f"{words[0]} {words[0]}"])))
    assert found["n_dup_lines"].tolist() == [0, 1, 0, 0]
    assert found["n_repeat_words"].tolist() == [0, 0, 0, 10]


def test_equal_rows_compares_the_columns():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, 3, 500) for _ in range(3)]
    order, same = kernels.equal_rows(columns)
    rows = list(zip(*columns))
    assert sorted(order.tolist()) == list(range(500))
    assert [rows[i] == rows[j] for i, j in zip(order, order[1:])] == same.tolist()
    assert same.sum() == 500 - len(set(rows))
    assert all(i < j for i, j, s in zip(order, order[1:], same) if s)


def test_texts_that_collide_are_not_copies(spark):
    one, two = thue_morse(4096)
    rows = [(1, one), (2, two), (3, one), (4, f"{one}."), (5, two.upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1, 4: 1, 5: 2}
    assert near_duplicates.digests(pa.array(["A b", "a  b!", "a", "ab", "", " .", "b.", None])) == [
        hashlib.sha256(x).digest() for x in (b"a b", b"a b", b"a", b"ab", b"", b"", b"b", b"")]


def test_late_copies_are_rows_not_ids(spark):
    a, b = "first text, " * 8, "other words entirely; " * 7
    rows = [(1, a), (2, a), (2, b), (3, b), (3, "short")]
    for block in (1 << 10, 1 << 20):
        got = {(r.doc_id, r.n_bytes): r.n_removed for r in repeats.repeats(spark.createDataFrame(rows, "doc_id long, text string"), block).collect()}
        assert got == {(1, len(a)): 0, (2, len(a)): len(a), (2, len(b)): 0, (3, len(b)): len(b), (3, 5): 0}


def test_contraction_keeps_components(spark):
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 900, 700), rng.integers(0, 900, 700)
    node, least = components.contract(a, b)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)
    want = {x: find(x) for x in {*a.tolist(), *b.tolist()}}
    assert dict(zip(node.tolist(), least.tolist())) == {x: m for x, m in want.items() if x != m}
    edges = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long").repartition(5)
    alone = {x for x in want if all(x != p or x == q for p, q in [*zip(a.tolist(), b.tolist()), *zip(b.tolist(), a.tolist())])}
    assert {r.node: r["class"] for r in components.components(edges).collect()} == {x: m for x, m in want.items() if x not in alone}
