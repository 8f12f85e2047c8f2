"""PCK1-6: hand-worked chunks (FIXTURES 3.3), exact equality with the sequential rule, conservation."""

import random

import pytest

from tessera.config import SpecialIds
from tessera.operators import packing

IDS = SpecialIds(pad=0, bos=1, eos=9, unk=3)
SCHEMA = "split string, shuffle_rank long, input_ids array<int>"

HAND = [
    ([[1, 2], [3], [4, 5, 6]], [[1, 2, 9, 3], [4, 5, 6, 9]], 1),
    ([[1], [2]], [[1, 9, 2, 9]], 0),
    ([[1]], [[1, 9, 0, 0]], 0),
    ([[1, 2, 3, 4]], [[1, 2, 3, 4]], 1),
    ([[1, 2], [3, 4, 5], [6]], [[1, 2, 9, 3], [6, 9, 0, 0]], 3),
    ([[1, 9, 2], [3]], [[1, 9, 2, 9], [3, 9, 0, 0]], 0),
]


def sequential(docs, M, eos, pad):
    """The reference rule on one flat list."""
    flat = []
    for d in docs:
        flat.extend(d)
        flat.append(eos)
    chunks, cur = [], []
    for t in flat:
        cur.append(t)
        if t == eos and len(cur) >= M:
            chunks.append(cur[:M])
            cur = []
    if cur:
        chunks.append((cur + [pad] * M)[:M])
    return chunks


@pytest.mark.parametrize("docs,want,lost", HAND)
def test_hand_cases(spark, docs, want, lost):
    df = spark.createDataFrame([("train", i, d) for i, d in enumerate(docs)], SCHEMA)
    segs = packing.segments(df, eos=IDS.eos)
    plan = packing.greedy_plan(segs, 4, num_partitions=3)
    got = [list(r.input_ids) for r in packing.greedy_chunks(segs, plan, 4, IDS).orderBy("chunk_id").collect()]
    assert got == want == sequential(docs, 4, 9, 0)
    assert sum(r.lost for r in plan.collect()) == lost


def test_lossless_first_case(spark):
    df = spark.createDataFrame([("train", i, d) for i, d in enumerate([[1, 2], [3], [4, 5, 6]])], SCHEMA)
    got = [list(r.input_ids) for r in packing.pack_concat(df, 4, IDS).orderBy("chunk_id").collect()]
    assert got == [[1, 2, 9, 3], [9, 4, 5, 6], [9, 0, 0, 0]]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_streams_equal_sequential(spark, seed):
    rnd = random.Random(seed)
    M = rnd.choice([5, 8, 13])
    rows, expect = [], {}
    for split in ("train", "test"):
        docs = [[rnd.randint(10, 20) for _ in range(rnd.randint(0, 3 * M))] for _ in range(rnd.randint(1, 60))]
        rows += [(split, i, d) for i, d in enumerate(docs)]
        expect[split] = sequential(docs, M, 9, 0)
    df = spark.createDataFrame(rows, SCHEMA)
    segs = packing.segments(df, eos=IDS.eos)
    plan = packing.greedy_plan(segs, M, num_partitions=rnd.randint(2, 9))
    chunks = packing.greedy_chunks(segs, plan, M, IDS).collect()
    for split in ("train", "test"):
        got = [list(r.input_ids) for r in sorted((c for c in chunks if c.split == split), key=lambda c: c.chunk_id)]
        assert got == expect[split]
    # conservation: kept + lost = sum of segment lengths, every chunk exactly M
    p = plan.collect()
    assert sum(r.take + r.lost for r in p) == sum(r.n for r in p)
    assert all(len(c.input_ids) == M for c in chunks)


def test_lossless_keeps_every_token(spark):
    rnd = random.Random(7)
    docs = [[rnd.randint(10, 20) for _ in range(rnd.randint(0, 9))] for _ in range(40)]
    df = spark.createDataFrame([("train", i, d) for i, d in enumerate(docs)], SCHEMA)
    chunks = packing.pack_concat(df, 6, IDS).orderBy("chunk_id").collect()
    flat = [t for c in chunks for t in c.input_ids]
    want = [t for d in docs for t in d + [9]]
    assert flat[:len(want)] == want and set(flat[len(want):]) <= {0}
