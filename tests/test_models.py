"""Word models, bootstrap and sketches against plain Python on small inputs."""

import collections
import math
import random
import re

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tessera.operators import evaluation, language_model, next_words, profile
from tessera.plans import catalog_models
from tessera.sources.tables import table

TEXTS = ["a b c a b d", "a b c a b c", "", None, "x", "a b", "c a b e  f\n", "the end of a b c"]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("lang", F.lit("id"))


def plain_triples(texts, end):
    out = collections.Counter()
    for t in texts:
        ws = ["<s>", "<s>", *(t or "").split(), *(["</s>"] if end else [])]
        out.update(zip(ws, ws[1:], ws[2:]))
    return out


def plain_greedy(texts, prompt, steps):
    tri = plain_triples(texts, True)
    two, one, top = (collections.defaultdict(collections.Counter) for _ in range(3))
    for (u, v, w), c in tri.items():
        two[u, v][w] += c
        one[v][w] += c
        if w != "</s>":
            top[()][w] += c
    best = lambda c: min(c, key=lambda w: (-c[w], w))
    ws, out = ["<s>", "<s>", *(prompt or "").split()], []
    for _ in range(steps):
        counts = two.get((ws[-2], ws[-1])) or one.get(ws[-1]) or top[()]
        w = best(counts)
        if w == "</s>":
            break
        ws.append(w)
        out.append(w)
    return " ".join(out)


def test_generation_equals_a_word_by_word_loop(spark, texts):
    prompts = ["a", "a b", "c a", "", None, "zzz", "unknown a", "of a b c", "e  f"] * 3
    df = spark.createDataFrame([(i, p, "x") for i, p in enumerate(prompts)], "item_id long, prompt string, u0 string")
    model = language_model.train_generator(texts, partitions=3)
    for steps, every in ((1, 4), (7, 2), (7, 4)):
        got = {r.item_id: r for r in language_model.generate_greedy(df.drop("u0"), model, steps, every=every).collect()}
        assert len(got) == len(prompts)
        for i, p in enumerate(prompts):
            want = plain_greedy(TEXTS, p, steps)
            assert (got[i].continuation, got[i].n_new) == (want, len(want.split()))
    model.drop()
    empty = language_model.train_generator(texts.limit(0))
    assert {r.continuation for r in language_model.generate_greedy(df.drop("u0"), empty, 3).collect()} == {""}


def test_frontier_holds_each_context_once(spark, texts):
    prompts = spark.range(500).select("id", F.lit("long prompt that ends in a b").alias("prompt"))
    assert language_model.contexts(prompts).select("u", "v").distinct().count() == 1


def test_packed_words_and_columns_come_back():
    import pyarrow as pa
    rnd = random.Random(5)
    for words in ([b"a"], [b"", b"a", b"ab", b"abc" * 200, b"abc" * 200 + b"d"], sorted({bytes(rnd.choices(b"ab\xc3\xa9", k=rnd.randint(1, 40))) for _ in range(500)})):
        assert next_words.unpack_words(*next_words.pack_words(pa.array([b"z", *words], pa.large_binary()).slice(1))).to_pylist() == words
    for n in (0, 1, 1000):
        cols = [np.sort(np.array([rnd.randrange(70_000) for _ in range(n)], np.int32)), np.array([rnd.randrange(1 << 30) for _ in range(n)], np.int32),
                np.array([rnd.randrange(1 << 40) for _ in range(n)], np.int64)]
        for want, got in zip(cols, next_words.unpack_columns(*next_words.pack_columns(cols), 2)):
            assert want.tolist() == got.tolist()


@pytest.mark.parametrize("small", [False, True])
def test_tables_hold_a_packed_row_a_bucket(monkeypatch, small):
    import pyarrow as pa
    if small:  # many slices, merges in between, keys by columns
        for name, value in (("SLICE_WORDS", 40), ("SLICE_BYTES", 100), ("MERGE_ROWS", 30), ("NARROW", 2)):
            monkeypatch.setattr(next_words, name, value)
    rnd = random.Random(11)
    names = ["a", "b", "</s>", "<s>", "é", "\x0bx\xa0", "long" * 30, *(f"w{i}" for i in range(40))]
    texts = ["", None, " \n a\tb\r\f", *(rnd.choice(" \t\n").join(rnd.choices(names, k=rnd.randint(0, 30))) for _ in range(120))]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k::2])], names=["text"]) for k in range(2)]
    want = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for t in texts:
        ws = ["<s>", "<s>", *(w for w in re.split(r"[ \t\n\r\f]+", t or "") if w), "</s>"]
        for u, v, w in zip(ws, ws[1:], ws[2:]):
            want[1][u, v][w] += 1
            want[0][v,][w] += 1
    for order, n in ((1, 3), (2, 3), (2, 130)):
        model = pa.Table.from_batches(next_words.chosen(next_words.counted(batches, order, n), order, n))
        assert model.num_rows == len(set(model.column("bucket").to_pylist())) <= n
        found = {}
        for k, row in enumerate(model.to_pylist()):
            words = next_words.unpack_words(row["size"], row["words"]).to_pylist()
            *context, nxt, count = next_words.unpack_columns(row["n"], row["codes"], order + 1)
            named = [[words[i].decode() for i in x] for x in (*context, nxt)]
            found |= {tuple(c): (w, int(m)) for *c, w, m in zip(*named, count)}
            asked = [pa.array([*x, "nowhere"]) for x in named[:-1]]
            assert next_words.lookup(model.slice(k, 1), asked).to_pylist() == [*named[-1], None]
            assert set(next_words._buckets(n, *(x.slice(0, len(x) - 1) for x in asked)).to_pylist()) == {row["bucket"]}
        assert found == {c: (min(x, key=lambda w: (-x[w], w.encode())), sum(x.values())) for c, x in want[order - 1].items()}


def test_kneser_ney_sums_to_one_and_backs_off(spark, texts):
    model = language_model.kneser_ney(texts)
    vocab = sorted({w for t in TEXTS for w in (t or "").split()})
    for u, v in (("a", "b"), ("<s>", "<s>"), ("zz", "b"), ("zz", "zz"), ("c", "a")):
        grams = spark.createDataFrame([(u, v, w) for w in [*vocab, "never seen"]], "u string, v string, w string")
        p = {r.w: r.p for r in language_model.kn_probabilities(grams, model).collect()}
        assert sum(p.values()) == pytest.approx(1, abs=1e-9) and min(p.values()) > 0
    got = {r.doc_id: r for r in language_model.kn_nll(texts, model).collect()}
    assert set(got) == {i for i, t in enumerate(TEXTS) if (t or "").split()}
    tri = plain_triples([TEXTS[0]], False)
    rows = spark.createDataFrame(list(tri), "u string, v string, w string")
    p = {(r.u, r.v, r.w): r.p for r in language_model.kn_probabilities(rows, model).collect()}
    assert got[0].nll == pytest.approx(-sum(c * math.log(p[g]) for g, c in tri.items()) / 6, abs=1e-6) and got[0].n == 6
    nothing = language_model.kneser_ney(texts.limit(0))
    assert {r.nll for r in language_model.kn_nll(texts.where("doc_id = 0"), nothing).collect()} == {0.0}  # one unseen word holds all


def test_kneser_ney_counts_ids_and_moves_asked_grams_only(spark):
    # "<s>" as a word, one word in most places, words that the training rows lack
    train = spark.createDataFrame([("<s> a b <s> a",), ("a a a a b c",), (None,), ("b <s> c a b",)], "text string")
    held = spark.createDataFrame([(1, "id", "a b zz <s> <s> a"), (1, "id", "a b"), (None, None, "yy zz a a"), (4, "id", None)], "doc_id long, lang string, text string")
    model = language_model.kneser_ney(train, partitions=3)
    assert [t for _, t in model.three.dtypes] == ["int", "int", "int", "bigint"]  # counted by ids, not by words
    tri = plain_triples([r.text for r in train.collect()], False)

    def discount(counts):
        ones, twos = (sum(c == k for c in counts.values()) for k in (1, 2))
        return ones / (ones + 2 * twos) if ones else 0.5

    bi = collections.Counter((v, w) for _, v, w in tri)
    uni = collections.Counter(w for _, w in bi)
    d3, d2, d1 = map(discount, (tri, bi, uni))

    def p(u, v, w):
        n = sum(uni.values())
        low = max(uni[w] - d1, 0) / n + d1 * len(uni) / n / (len(uni) + 1)
        for counts, d, before in ((bi, d2, (v,)), (tri, d3, (u, v))):
            after = [c for g, c in counts.items() if g[:-1] == before]
            low = (max(counts[(*before, w)] - d, 0) + d * len(after) * low) / sum(after) if after else low
        return low

    got = {r.doc_id: (r.nll, r.n) for r in language_model.kn_nll(held, model).collect()}
    want = {i: plain_triples([r.text for r in held.collect() if r.doc_id == i], False) for i in (1, None)}
    assert got == {i: (pytest.approx(-sum(c * math.log(p(*g)) for g, c in t.items()) / t.total(), abs=1e-6), t.total()) for i, t in want.items()}
    model.drop()


def test_kneser_ney_beats_add_k(spark):
    docs = table(spark, SF_SMALL, "documents")
    train, held = docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0")
    kn = evaluation.perplexity(language_model.kn_nll(held, language_model.kneser_ney(train))).first()
    add = evaluation.perplexity(evaluation.ngram_nll(held, *evaluation.bigram_model(train))).first()
    assert kn.n_tokens == add.n_tokens and kn.avg_loss < add.avg_loss


def test_answers_are_generated(spark):
    from tessera.plans import derived
    items, responses = derived.mcq_answers(table(spark, SF_SMALL, "benchmark"))
    got = responses.collect()
    assert {r.item_id for r in got} == {r.item_id for r in items.collect()} and all(r.response[:1] in "ABCD" for r in got)


def test_poisson_bootstrap(spark):
    rng = np.random.default_rng(3)
    values = rng.random(400)
    scores = spark.createDataFrame([("m", i, float(v)) for i, v in enumerate(values)] + [("one", 1, 0.5)], "metric string, item_id long, fmeasure double")
    weights = [r.weight for r in evaluation.poisson_weights(scores.where("metric = 'm'"), "item_id", 100).collect()]
    assert len(weights) == 40_000 and np.mean(weights) == pytest.approx(1, abs=0.03) and np.var(weights) == pytest.approx(1, abs=0.05)
    got = {r.metric: r for r in evaluation.bootstrap(scores).collect()}
    draws = [rng.choice(values, 400).mean() for _ in range(2000)]
    for name, q in (("low", 0.025), ("mid", 0.5), ("high", 0.975)):
        assert got["m"][name] == pytest.approx(np.quantile(draws, q), abs=0.006)
    assert got["one"].low == got["one"].high == 0.5 and got["one"].replicates < 1000  # some replicates drew nothing
    assert evaluation.bootstrap(scores.limit(0)).collect() == []


def test_sketches_merge_within_their_rank_error(spark):
    rng = np.random.default_rng(9)
    rows = [(f"s{i % 3}", "train" if i % 7 else "test", int(v)) for i, v in enumerate(rng.zipf(1.4, 30_000) % 20_000)]
    df = spark.createDataFrame(rows, "source string, split string, n_tokens long")
    fine = profile.length_sketches(df)
    assert {(r.source, r.split): r.samples for r in fine.collect()} == collections.Counter((s, p) for s, p, _ in rows)
    for by in (["source", "split"], ["split"], []):
        sketches = fine if len(by) == 2 else profile.merged_sketches(fine, by)
        found = profile.sketch_quantiles(sketches, (0.1, 0.5, 0.99))
        errors = [r.rank_error for r in profile.rank_errors(df, found, by).collect()]
        assert len(errors) == 3 * max(1, sketches.count()) and max(errors) < 0.02


def test_model_queries_registered():
    assert {"generate_greedy", "kn_nll", "kn_perplexity", "rouge_bootstrap"} <= set(catalog_models.catalog.oracle())
