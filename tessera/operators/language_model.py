"""EV10 models trained and applied in Spark: greedy generation, and interpolated Kneser-Ney of orders 1 to 3.

A model is a set of count tables over the words of documents; equal triples
collapse map-side.  Nothing is collected but a few totals.

*Generation* is a frontier iteration.  The greedy continuation of a prompt depends on
its last two words only, so the frontier holds each distinct context once, however
many prompts end in it.  A step looks the frontier up in the (context -> best next word)
table, by buckets of contexts; contexts that end leave; the state is written every few steps.

*Kneser-Ney* replaces the lower-order counts by continuation counts (in how many
distinct contexts a word was seen) and chains the orders: a back-off weight a context,
one probability an asked n-gram.  It counts triples of vocabulary ids, not of words.
Documents to be scored are reduced to their distinct triples, each of which is looked
up once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_IDS, MCQ_NEW_TOKENS
from ..functions.text import words
from ..session import release, reliable_checkpoint, shuffle_partitions, staged_parquet
from . import encoding, next_words
from .next_words import BEGIN, END


def _r6(c: Column) -> Column:
    return F.round(c, 6)


def triples(ws: Column, end: bool, begin: Column | None = None) -> Column:
    """array<struct<u, v, w>> of a word-array *column*: each word with the two before it (``begin``, else ``<s>``, before the first)."""
    begin = F.lit(BEGIN) if begin is None else begin

    def before(i, k):
        return F.when(i < k, begin).otherwise(F.get(ws, i - k))

    rows = F.transform(ws, lambda w, i: F.struct(before(i, 2).alias("u"), before(i, 1).alias("v"), w.alias("w")))
    if not end:
        return rows
    n = F.size(ws)
    last = F.struct(before(n, 2).alias("u"), before(n, 1).alias("v"), F.lit(END).alias("w"))
    return F.concat(rows, F.array(last))


# ------------------------------------------------------------- generation --
@dataclass
class Generator:
    """Best next words by two words, by one word, and over all.

    The tables hold a packed piece a bucket of contexts (``next_words``), dealt out by bucket.
    """

    by_two: DataFrame
    by_one: DataFrame
    overall: str | None
    buckets: int

    def drop(self) -> None:
        self.by_two.unpersist()
        self.by_one.unpersist()


def train_generator(docs: DataFrame, text_col: str = "text", partitions: int | None = None) -> Generator:
    """The greedy model of the documents' words; contexts never seen back off to one word, then to none.

    Triples and then pairs of words are counted, each in a pass over the texts and one shuffle of packed pieces, which
    is let go before the next.  The tables are dealt out by bucket once, so a generation step shuffles only the frontier.
    """
    spark = docs.sparkSession
    n = partitions or shuffle_partitions(spark)
    two, one = (_best_next(docs.select(text_col), order, n) for order in (2, 1))
    texts = docs.count()  # each starts with <s>, which is not one of its words
    times = F.col("n") - F.when(F.col("word") == BEGIN, F.lit(texts)).otherwise(F.lit(0))
    seen = one.mapInArrow(next_words.frequent, "word string, n long").select("word", times.alias("n")).where((F.col("word") != END) & (F.col("n") > 0))
    top = seen.agg(F.min(F.struct((-F.col("n")).alias("n"), "word")).alias("t")).first()["t"]
    two, one = (x.repartition(n, "bucket").persist() for x in (two, one))
    return Generator(two, one, top["word"] if top else None, n)


def _best_next(texts: DataFrame, order: int, n: int) -> DataFrame:
    """The best next word of every context of ``order`` words: a packed piece for each of ``n`` buckets, written."""
    pieces = texts.mapInArrow(lambda batches: next_words.counted(batches, order, n), next_words.PIECES)
    model = staged_parquet(pieces.repartition(n, "part").mapInArrow(lambda batches: next_words.chosen(batches, order, n), next_words.MODEL), "next-words")
    del pieces
    release(texts.sparkSession)  # the shuffled pieces are not needed any more
    return model


def contexts(prompts: DataFrame, prompt_col: str = "prompt") -> DataFrame:
    """The prompts with their last two words as ``u`` and ``v`` (``<s>`` where there are fewer)."""
    def last(k):
        return F.coalesce(F.get(F.col("_w"), F.size("_w") - k), F.lit(BEGIN))

    keyed = prompts.withColumn("_w", words(F.coalesce(F.col(prompt_col), F.lit(""))))
    return keyed.withColumn("u", last(2)).withColumn("v", last(1)).drop("_w")


def generate_greedy(prompts: DataFrame, model: Generator, max_new: int = MCQ_NEW_TOKENS, prompt_col: str = "prompt", every: int = 4) -> DataFrame:
    """EV10: the prompts with ``continuation`` (up to ``max_new`` words, joined by a space) and ``n_new``.

    A step takes the best word after the last two words, else after the last one, else the most frequent
    word; ``</s>`` ends a continuation and is not part of it.  Null prompts count as empty.
    """
    keyed = contexts(prompts, prompt_col)
    spark = prompts.sparkSession
    n, overall = model.buckets, END if model.overall is None else model.overall
    fields = "bucket int, u0 string, v0 string, u string, v string, out string, made bigint, done boolean"
    state = keyed.select(F.lit(0).alias("bucket"), F.col("u").alias("u0"), F.col("v").alias("v0")).distinct().select(
        "bucket", "u0", "v0", F.col("u0").alias("u"), F.col("v0").alias("v"), F.lit("").alias("out"),
        F.lit(0).cast("bigint").alias("made"), F.lit(False).alias("done"))
    state = state.mapInArrow(lambda batches: next_words.placed(batches, n), fields)
    finished = []
    for step in range(1, max_new + 1):
        known = state.groupBy("bucket").cogroup(model.by_two.groupBy("bucket"))
        if step > 2:  # the model has followed (u, v): by two words or one in step 2, as even ``overall`` has a next word
            state = known.applyInArrow(lambda rows, piece: next_words.seen(rows, piece, n), fields)
        else:
            asked = known.applyInArrow(lambda rows, piece: next_words.by_two(rows, piece, n), fields + ", word string")
            state = asked.groupBy("bucket").cogroup(model.by_one.groupBy("bucket")).applyInArrow(lambda rows, piece: next_words.by_one(rows, piece, n, overall), fields)
        if step % every == 0 or step == max_new:
            state = reliable_checkpoint(state)
            finished.append(state if step == max_new else state.where("done"))
            state = state.where(~F.col("done"))
            if step < max_new and state.isEmpty():
                break
    out = spark.createDataFrame([], "u0 string, v0 string, out string, made bigint")
    for part in finished:
        out = out.unionByName(part.select("u0", "v0", "out", "made"))
    joined = keyed.join(out, (F.col("u") == F.col("u0")) & (F.col("v") == F.col("v0")), "left")
    return joined.select(*prompts.columns, F.coalesce("out", F.lit("")).alias("continuation"), F.coalesce("made", F.lit(0)).cast("bigint").alias("n_new"))


# ------------------------------------------------------------- Kneser-Ney --
@dataclass
class KneserNey:
    """Counts over word ids and the discounts; ``unseen``: the probability of a word never seen."""

    vocab: DataFrame     # word, token_id; holds ``<s>``
    begin: int           # the id of ``<s>``
    three: DataFrame     # u, v, w, c: dealt out by (u, v)
    two: DataFrame       # v, w, n: distinct words before (v, w)
    back_two: DataFrame  # v, s, t
    one: DataFrame       # w, p1
    d3: float
    d2: float
    unseen: float

    def drop(self) -> None:
        self.three.unpersist()


def _discount(counts: DataFrame, col: str) -> float:
    """n1 / (n1 + 2 n2) from the counts of counts; 0.5 where nothing was seen once."""
    r = counts.agg(F.count_if(F.col(col) == 1).alias("n1"), F.count_if(F.col(col) == 2).alias("n2")).first()
    return r["n1"] / (r["n1"] + 2 * r["n2"]) if r["n1"] else 0.5


def _id_triples(encoded: DataFrame, keys: Sequence[str], begin: int) -> DataFrame:
    """keys, u, v, w: one row a word of the encoded documents."""
    return encoded.select(*keys, F.explode(triples(F.col("input_ids"), False, F.lit(begin))).alias("t")).select(*keys, "t.u", "t.v", "t.w")


def kneser_ney(docs: DataFrame, text_col: str = "text", partitions: int | None = None) -> KneserNey:
    """Interpolated Kneser-Ney of order 3 with one discount an order, down to a uniform share of unseen words.

    p1(w) = max(N(.w) - D1, 0) / N(..) + D1 * types / N(..) / (types + 1)
    p2(w | v) = max(N(.vw) - D2, 0) / N(.v.) + D2 * N(v.) / N(.v.) * p1(w)
    p3(w | u, v) = max(c(uvw) - D3, 0) / c(uv.) + D3 * N(uv.) / c(uv.) * p2(w | v)

    Words are counted by their vocabulary ids.  The triples are shuffled once, by (u, v), and kept dealt out so: the
    sums of a context and the look-ups of ``kn_probabilities`` move the asked n-grams only.
    """
    words_of = encoding.build_vocab(docs, text_col).select("word", "token_id")
    known = words_of.where(F.col("word") == BEGIN).first()
    begin = known["token_id"] if known else DEFAULT_IDS.bos
    if not known:
        words_of = words_of.unionByName(words_of.sparkSession.createDataFrame([(BEGIN, begin)], words_of.schema))
    n_parts = partitions or shuffle_partitions(docs.sparkSession)
    rows = _id_triples(encoding.encode(docs, words_of, keys=(), text_col=text_col), [], begin)
    tri = rows.repartition(n_parts, "u", "v").groupBy("u", "v", "w").agg(F.count(F.lit(1)).alias("c")).persist()
    bi = staged_parquet(tri.groupBy("v", "w").agg(F.count(F.lit(1)).alias("n")), "pairs")
    uni = staged_parquet(bi.groupBy("w").agg(F.count(F.lit(1)).alias("n")), "singles")  # distinct v before w
    d3, d2, d1 = _discount(tri, "c"), _discount(bi, "n"), _discount(uni, "n")
    total = uni.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("types")).first()
    n, types = total["n"], total["types"]
    spare = (d1 * types / n if n else 1.0) / (types + 1)
    one = uni.select("w", (F.greatest(F.col("n") - d1, F.lit(0.0)) / F.lit(float(max(n, 1))) + F.lit(spare)).alias("p1"))
    back2 = staged_parquet(bi.groupBy("v").agg(F.sum("n").alias("s"), F.count(F.lit(1)).alias("t")), "contexts")
    return KneserNey(words_of, begin, tri, bi, back2, one, d3, d2, spare)


def _id_probabilities(grams: DataFrame, model: KneserNey) -> DataFrame:
    """Distinct (u, v, w) of ids with ``p``: discounted counts plus the context's weight times the lower order."""
    seen = model.three.join(grams.select("u", "v").distinct().hint("shuffle_hash"), ["u", "v"], "left_semi")  # the triples are neither moved nor sorted
    sums3 = seen.groupBy("u", "v").agg(F.sum("c").alias("s3"), F.count(F.lit(1)).alias("t3"))
    j = (grams.join(sums3, ["u", "v"], "left").join(seen, ["u", "v", "w"], "left").join(model.two, ["v", "w"], "left")
         .join(model.back_two, "v", "left").join(model.one, "w", "left"))

    def level(count, discount, total, types, lower):
        own = F.coalesce(F.greatest(F.col(count) - discount, F.lit(0.0)) / F.col(total), F.lit(0.0))
        return own + F.coalesce(F.lit(discount) * F.col(types) / F.col(total), F.lit(1.0)) * lower

    p2 = level("n", model.d2, "s", "t", F.coalesce("p1", F.lit(model.unseen)))
    return j.select("u", "v", "w", level("c", model.d3, "s3", "t3", p2).alias("p"))


def kn_probabilities(grams: DataFrame, model: KneserNey) -> DataFrame:
    """Distinct (u, v, w) of words with ``p``; words the model has not seen are all alike."""
    for c in "uvw":
        ids = model.vocab.select(F.col("word").alias(c), F.col("token_id").alias(f"_{c}"))
        grams = grams.join(ids, c, "left").withColumn(f"_{c}", F.coalesce(f"_{c}", F.lit(DEFAULT_IDS.unk)))
    found = _id_probabilities(grams.select(*(F.col(f"_{c}").alias(c) for c in "uvw")).distinct(), model)
    return grams.join(found.select(*(F.col(c).alias(f"_{c}") for c in "uvw"), "p"), ["_u", "_v", "_w"]).select("u", "v", "w", "p")


def kn_nll(docs: DataFrame, model: KneserNey, keys: Sequence[str] = ("doc_id", "lang"), text_col: str = "text") -> DataFrame:
    """EV10: mean negative log-likelihood a word of each document with words, and its number of words ``n``."""
    keys = list(keys)
    encoded = encoding.encode(docs, model.vocab, keys=keys, text_col=text_col)
    per = staged_parquet(_id_triples(encoded, keys, model.begin).groupBy(*keys, "u", "v", "w").agg(F.count(F.lit(1)).alias("_n")), "asked")
    known = staged_parquet(_id_probabilities(per.select("u", "v", "w").distinct(), model), "probabilities")
    scored = per.join(known, ["u", "v", "w"])
    agg = scored.groupBy(*keys).agg(F.sum(-F.log("p") * F.col("_n")).alias("_s"), F.sum("_n").cast("bigint").alias("n"))
    return agg.select(*keys, _r6(F.col("_s") / F.col("n")).alias("nll"), "n")
