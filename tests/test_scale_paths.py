"""The paths taken when a side is too large to broadcast give the same answers as the broadcast paths."""

import random
import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import encoding, evaluation, ordinal
from tessera.sources.tables import table


def test_encode_shuffle_join_equals_broadcast(spark):
    docs = table(spark, SF_SMALL, "documents").where(F.col("doc_id") < 60)
    vocab = encoding.build_vocab(docs)
    a = {r.doc_id: list(r.input_ids) for r in encoding.encode(docs, vocab, max_length=50).collect()}
    plan = encoding.encode(docs, vocab, max_length=50, broadcast_limit=0)
    b = {r.doc_id: list(r.input_ids) for r in plan.collect()}
    assert a == b


def test_decode_roundtrip(spark):
    docs = table(spark, SF_SMALL, "documents").where(F.col("doc_id") < 30)
    vocab = encoding.build_vocab(docs)
    enc = encoding.encode(docs, vocab, max_length=20)
    got = {r.doc_id: r.text for r in encoding.decode(enc, vocab, broadcast_limit=0).collect()}
    from tessera.functions.text import words
    want = {r.doc_id: " ".join(r.w[:20]) for r in docs.select("doc_id", words(F.col("text")).alias("w")).collect()}
    assert got == want


def test_bigram_nll_against_python(spark):
    import math
    from collections import Counter
    from tessera.functions.text import words
    docs = table(spark, SF_SMALL, "documents")
    train, held = docs.where(F.col("doc_id") % 2 == 0), docs.where(F.col("doc_id") % 2 == 1).where(F.col("doc_id") < 40)
    bi, ctx, v = evaluation.bigram_model(train)
    got = {r.doc_id: r.nll for r in evaluation.ngram_nll(held, bi, ctx, v).collect()}

    def pairs(ws):
        return [("<s>" if i == 0 else ws[i - 1], w) for i, w in enumerate(ws)]
    tw = [r.w for r in train.select(words(F.col("text")).alias("w")).collect()]
    cb = Counter(p for ws in tw for p in pairs(ws))
    cc = Counter(p[0] for ws in tw for p in pairs(ws))
    vocab = len({p[1] for p in cb}) + 1
    assert v == vocab
    for r in held.select("doc_id", words(F.col("text")).alias("w")).collect():
        ps = pairs(r.w)
        if not ps:
            assert r.doc_id not in got
            continue
        nll = sum(-math.log((cb[p] + 0.5) / (cc[p[0]] + 0.5 * vocab)) for p in ps) / len(ps)
        assert abs(got[r.doc_id] - nll) < 1e-5


def test_running_sum_and_min_with_groups(spark):
    rnd = random.Random(3)
    rows = [(g, i, float(rnd.randint(1, 50))) for g in ("a", "b", "c") for i in range(rnd.randint(1, 80))]
    df = spark.createDataFrame(rows, "g string, i long, v double")
    s = {(r.g, r.i): r.running for r in ordinal.with_running(df, ["i"], "v", ["g"], "sum", num_partitions=5).collect()}
    m = {(r.g, r.i): r.running for r in ordinal.with_running(df, ["i"], "v", ["g"], "min", num_partitions=5).collect()}
    for g in ("a", "b", "c"):
        vals = [v for gg, _, v in rows if gg == g]
        for i in range(len(vals)):
            assert s[(g, i)] == sum(vals[:i])
            assert m[(g, i)] == (min(vals[:i]) if i else None)


def test_arrow_and_join_encoders_agree_on_edges(spark):
    rows = [(1, "  a b\tc\n"), (2, None), (3, "   \n\t "), (4, "b b b b b b"), (5, ""), (6, "x\fy\rz a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vocab = encoding.build_vocab(docs.where(F.col("doc_id") != 6))
    a = {r.doc_id: list(r.input_ids) for r in encoding.encode(docs, vocab, max_length=4, strategy="join").collect()}
    b = {r.doc_id: list(r.input_ids) for r in encoding.encode(docs, vocab, max_length=4, strategy="arrow").collect()}
    assert a == b
    assert a[2] == [] and a[3] == [] and a[5] == [] and len(a[4]) == 4 and a[6][:3] == [3, 3, 3]


def test_arrow_and_join_decoders_agree(spark):
    docs = table(spark, SF_SMALL, "documents").where(F.col("doc_id") < 40)
    vocab = encoding.build_vocab(docs.where(F.col("doc_id") < 30))
    enc = encoding.encode(docs, vocab, max_length=30)
    extra = spark.createDataFrame([(9999, [0, 1, 2, 3, 10**6])], "doc_id long, input_ids array<int>")
    enc = enc.select("doc_id", "input_ids").unionByName(extra)
    a = {r.doc_id: r.text for r in encoding.decode(enc, vocab, strategy="join").collect()}
    b = {r.doc_id: r.text for r in encoding.decode(enc, vocab, strategy="arrow").collect()}
    assert a == b and a[9999] == ""


def test_bigram_scorer_paths_agree(spark):
    docs = table(spark, SF_SMALL, "documents")
    train, held = docs.where(F.col("doc_id") % 3 != 0), docs.where(F.col("doc_id") % 3 == 0)
    bi, ctx, v = evaluation.bigram_model(train)
    a = {r.doc_id: (r.nll, r.n) for r in evaluation.ngram_nll(held, bi, ctx, v, strategy="join").collect()}
    b = {r.doc_id: (r.nll, r.n) for r in evaluation.ngram_nll(held, bi, ctx, v, strategy="arrow").collect()}
    assert a.keys() == b.keys() and all(abs(a[i][0] - b[i][0]) <= 2e-6 and a[i][1] == b[i][1] for i in a)


def test_arrow_encoder_is_one_narrow_stage(spark):
    docs = table(spark, SF_SMALL, "documents").where(F.col("doc_id") < 50)
    vocab = encoding.build_vocab(docs)
    plan = encoding.encode(docs, vocab, strategy="arrow")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan
    joined = encoding.encode(docs, vocab, strategy="join")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in joined  # the regroup after the join


def test_words_beyond_the_head_are_joined(spark):
    # a null id, a row that comes twice, a null text, words that no vocabulary has
    rows = [(1, "a b a c d a b\u00a0"), (1, "a b a c d a b\u00a0"), (None, "d zz c b a zz"), (3, None), (4, " \n"), (5, "zz"), (6, "a a a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vocab = encoding.build_vocab(docs.where("text is not null")).where("word <> 'zz'")
    for limit in (None, 3):
        want = sorted(((r.doc_id, r.input_ids, r.n_tokens) for r in encoding.encode(docs, vocab, max_length=limit, strategy="arrow").collect()), key=str)
        for head in (0, 1, 2, 3, 100):
            enc = encoding.encode_split(docs, vocab, max_length=limit, head_rows=head)
            assert sorted(((r.doc_id, r.input_ids, r.n_tokens) for r in enc.collect()), key=str) == want
            texts = sorted(((r.doc_id, r.text) for r in encoding.decode_arrow(enc, vocab).collect()), key=str)
            got = encoding.decode_split(enc, vocab, head_rows=head).collect()
            assert sorted(((r.doc_id, r.text) for r in got), key=str) == texts and len(got) == len(rows)


def test_large_vocabulary_shuffles_few_words(spark):
    """Beyond the broadcast bound a document's frequent words are not exploded: only one row a document and one a rare word move."""
    docs = spark.createDataFrame([(i, "often " * 200 + f"rare{i}") for i in range(100)], "doc_id long, text string")
    vocab = encoding.build_vocab(docs)
    enc = encoding.encode(docs, vocab, broadcast_limit=1)
    plan = enc._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Scan parquet" in plan  # written once, not encoded again by each reader
    assert {(r.n_tokens, len(set(r.input_ids))) for r in enc.collect()} == {(201, 2)}


def test_rank_of_a_source_moves_no_text(spark):
    from tessera.plans.prepare import ranked_documents

    rows = [(1, "a", "x", "s"), (1, "a", "x", "s"), (2, "b", None, "t"), (3, None, "y", None), (4, "c", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a size estimate decides nothing
    try:
        ranked = ranked_documents(docs)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        many = ranked_documents(docs, limit=3)  # four sources: joined by shuffle
        assert "Exchange hashpartitioning" in many._jdf.queryExecution().executedPlan().toString()
        got = sorted(((r.doc_id, r.text, r.lang, r.source, r.source_rank) for r in ranked.collect()), key=str)
        assert got == sorted(((r.doc_id, r.text, r.lang, r.source, r.source_rank) for r in many.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    order = [(None, None), (None, "t"), ("x", "s"), ("y", None)]
    assert got == sorted(((i, t, g, s, order.index((g, s))) for i, t, g, s in rows), key=str)


def test_staged_file_is_read_by_several_tasks(spark, monkeypatch):
    import pyarrow.parquet as pq

    from tessera import session

    monkeypatch.setattr(session, "STAGED_GROUP_BYTES", 1 << 20)
    text = F.concat(*[F.md5(F.concat("id", F.lit(k)).cast("string")) for k in range(8)])
    staged = session.staged_parquet(spark.range(0, 20_000, 1, 1).select("id", text.alias("text")), "groups-test")
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in staged.inputFiles()]
    assert min(f.num_row_groups for f in files) > 1 and files[0].row_group(0).column(0).compression == "ZSTD"
    assert staged.count() == 20_000


def test_vocabulary_of_odd_texts(spark):
    from collections import Counter

    texts = [" a  b\ta\n", "", None, " \n ", "b  b\x0bc\rd\fe", "\na", "zz"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    vocab = encoding.build_vocab(docs)
    want = Counter(w for t in texts if t for w in re.split(r"[ \t\n\r\f]+", t) if w)
    assert {r.word: r.n for r in vocab.collect()} == dict(want)
    ranks = sorted(want, key=lambda w: (-want[w], w))
    assert [r.word for r in vocab.orderBy("token_id").collect()] == ranks


def _three_columns(rows):
    return [(i, t, "en", "s") for i, t in rows]


def test_ranks_apart_equal_ranked_documents(spark):
    """The rank in its own table is the rank that the shuffled documents carry; a repeated row counts once."""
    from tessera.config import QualityParams
    from tessera.plans.prepare import PrepareParams, prepare

    rows = _three_columns([(i, f"text number {i} " * (i % 7 + 1)) for i in range(60)] + [(3, "text number 3 " * 4), (70, "text number 5 " * 6)])
    docs = spark.createDataFrame([*rows, (80, None, None, None)], "doc_id long, text string, lang string, source string")
    anything = QualityParams(min_chars=0, repetition_min=0, printable_min=0)

    def both(docs):
        want = prepare(docs, PrepareParams(quality=anything)).encoded
        prep = prepare(docs, PrepareParams(quality=anything, ranked=False, ranks_apart=True))
        assert prep.documents.count() == prep.encoded.count()
        return prep.encoded.join(prep.ranks, "ord"), want

    cols = ("shuffle_rank", "doc_id", "split", "input_ids")
    got, want = both(docs)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert got.count() == 61
    # one id with two texts of equal words: one row stays, the others' ranks are as before
    got, want = both(docs.unionByName(spark.createDataFrame(_three_columns([(9, "9 number text " * 3)]), docs.schema.simpleString()[7:-1].replace(":", " "))))
    got, want = ({r.doc_id: r for r in df.select(*cols).collect()} for df in (got, want))
    assert len(got) == 61 and got.keys() == want.keys()
    assert all(got[i] == want[i] for i in got if i != 9) and sorted(got[9].input_ids) == sorted(want[9].input_ids)
    assert abs(got[9].shuffle_rank - want[9].shuffle_rank) <= 1


def test_packing_shuffles_no_text(spark, tmp_path, monkeypatch):
    """pack_report, pack_concat and their kin read ids by row: the text is never exchanged, and it is encoded once."""
    from tessera.operators import encoding as enc
    from tessera.plans import catalog, prepare as P

    rows = _three_columns([(i, f"A sentence of document {i} that says something else each time, {i * i} words or so. " * (i % 5 + 2)) for i in range(40)])
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(P, "prepared_documents", None)  # the path that shuffles the text
    passes = spark.sparkContext.accumulator(0)
    encode_arrow = enc.encode_arrow

    def counted(docs, *a, **kw):
        out = encode_arrow(docs, *a, **kw)

        def run(batches):
            for b in batches:
                passes.add(b.num_rows)
                yield b
        return out.mapInArrow(run, out.schema)

    monkeypatch.setattr(enc, "encode_arrow", counted)
    chunks = {(r.split, r.chunk_id): r.input_ids for r in catalog.q_pack_concat(spark, str(tmp_path)).collect()}
    assert passes.value == 40 and chunks
    report = {r.split: r for r in catalog.q_pack_report(spark, str(tmp_path)).collect()}
    assert report["train"].tokens_in == sum(t != 0 for k, ids in chunks.items() if k[0] == "train" for t in ids)
