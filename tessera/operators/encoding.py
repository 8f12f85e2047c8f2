"""Encoding text to token ids and back.

TOK1 TOK2 TOK3 TOK4 PRJ2

A word vocabulary is trained in Spark (``explode`` + partial/final aggregate, so
hot words collapse before the shuffle) and ranked by (count desc, word) with the
distributed ordinal.  Encoding looks the words of each document up, whole texts by
default, in vectorised Arrow kernels against a broadcast vocabulary of bounded
row count.  Beyond that the most frequent words are broadcast and looked up in the
same way; only the few words left (rare by the ranking) go through a join.

Source columns other than the keys are dropped (PRJ2), but ``doc_id``,
``lang`` and ``source`` may be kept as keys so later reports can group by them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_IDS, SpecialIds
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.text import WORD_SPLIT, py_strip, words
from ..session import reliable_checkpoint, staged_parquet
from .ordinal import with_ordinal

# Vocabularies up to this many rows are broadcast (about 40 bytes a row).
BROADCAST_VOCAB_ROWS = 2_000_000
# Of a larger vocabulary this many of the most frequent words are broadcast; the others are joined.
HEAD_ROWS = 1_000_000


def build_vocab(docs: DataFrame, text_col: str = "text", ids: SpecialIds = DEFAULT_IDS,
                vocab_size: int | None = None) -> DataFrame:
    """TOK1(a): (word, n, token_id); ids start after the special ids, most frequent first."""
    counts = reliable_checkpoint(  # counted once; ranking samples and reads this table
        docs.select(F.explode(F.split(F.col(text_col), WORD_SPLIT)).alias("word")).where("word <> ''")
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    ranked = with_ordinal(counts, [F.col("n").desc(), F.col("word")], out="_rank")
    if vocab_size:
        ranked = ranked.where(F.col("_rank") < F.lit(vocab_size))
    return ranked.select("word", "n", (F.col("_rank") + F.lit(ids.first_word_id)).cast("int").alias("token_id"))  # the ANSI cast raises beyond 2**31 words: pass vocab_size


def vocab_size(vocab: DataFrame, ids: SpecialIds = DEFAULT_IDS) -> int:
    """TOK3: words + special ids."""
    return vocab.count() + ids.count


def _sized(vocab: DataFrame, limit: int = BROADCAST_VOCAB_ROWS) -> DataFrame:
    """Broadcast the vocabulary only after checking its row count."""
    return F.broadcast(vocab) if vocab.count() <= limit else vocab


def encode(docs: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("doc_id",),
           text_col: str = "text", max_length: int | None = None,
           ids: SpecialIds = DEFAULT_IDS, broadcast_limit: int = BROADCAST_VOCAB_ROWS,
           strategy: str = "auto") -> DataFrame:
    """TOK1: keys + ``input_ids array<int>`` (the first ``max_length`` words; None: all) + ``n_tokens``.

    ``strategy``: ``"arrow"`` — vectorised lookup in each task against the
    broadcast vocabulary (no explode, no shuffle); ``"split"`` — the same against
    the most frequent words, a join for the words left (any vocabulary size);
    ``"join"`` — explode, join, regroup every word; ``"auto"`` — arrow when the
    vocabulary's row count is within ``broadcast_limit``, else split.
    """
    if strategy == "auto":
        strategy = "arrow" if vocab.count() <= broadcast_limit else "split"
    if strategy == "arrow":
        return encode_arrow(docs, vocab, keys, text_col, max_length, ids)
    if strategy == "split":
        return encode_split(docs, vocab, keys, text_col, max_length, ids, min(broadcast_limit, HEAD_ROWS))
    return encode_join(docs, vocab, keys, text_col, max_length, ids, broadcast_limit)


def encode_join(docs: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("doc_id",),
                text_col: str = "text", max_length: int | None = None,
                ids: SpecialIds = DEFAULT_IDS, broadcast_limit: int = BROADCAST_VOCAB_ROWS) -> DataFrame:
    """TOK1, any vocabulary size: explode words, join the vocabulary, regroup per document."""
    keys = list(keys)
    found = words(F.col(text_col))
    found = F.slice(found, 1, max_length) if max_length else found
    exploded = docs.select(*keys, F.posexplode_outer(found).alias("pos", "word"))
    vocab_side = _sized(vocab.select("word", "token_id"), broadcast_limit)
    joined = exploded.join(vocab_side, on="word", how="left")
    entry = F.when(F.col("pos").isNotNull(),
                   F.struct(F.col("pos"), F.coalesce(F.col("token_id"), F.lit(ids.unk)).alias("id")))
    grouped = joined.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_pairs"))
    input_ids = F.transform(F.col("_pairs"), lambda p: p["id"]).cast("array<int>")
    return grouped.select(*keys, input_ids.alias("input_ids"),
                          F.size(input_ids).cast("bigint").alias("n_tokens"))


def encode_arrow(docs: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("doc_id",),
                 text_col: str = "text", max_length: int | None = None,
                 ids: SpecialIds = DEFAULT_IDS, rest: bool = False) -> DataFrame:
    """TOK1 for a bounded vocabulary: one narrow map stage, no shuffle.

    The vocabulary (checked against the broadcast bound by the caller) is
    shipped once to every executor, as Spark's broadcast join would do; each
    Arrow batch is split, truncated and looked up with vectorised Arrow kernels
    (regex split, hash ``index_in``, ``take``), with no per-token Python.

    ``rest``: a word that is not found becomes -1 - k, k being its place in the
    document's list of such words, which is added as ``_words``.
    """
    import pyarrow as pa

    table = vocab.select("word", "token_id").toArrow()
    shipped = docs.sparkSession.sparkContext.broadcast(
        (table.column("word").combine_chunks(), table.column("token_id").combine_chunks().cast(pa.int32())))
    keys = list(keys)
    unk, limit = int(ids.unk), max_length or (1 << 62)
    schema = StructType([*(docs.schema[k] for k in keys),
                         StructField("input_ids", ArrayType(IntegerType())), StructField("n_tokens", LongType()),
                         *([StructField("_words", ArrayType(StringType()))] if rest else [])])

    def run(batches):
        import numpy as np
        import pyarrow.compute as pc
        words_arr, ids_arr = shipped.value
        lookup = pc.SetLookupOptions(value_set=words_arr)
        for rb in batches:
            text = rb.column(rb.schema.get_field_index(text_col))
            parts = pc.split_pattern_regex(text, pattern=WORD_SPLIT)
            flat = pc.list_flatten(parts)
            parent = pc.list_parent_indices(parts)
            nonempty = pc.not_equal(flat, "")
            flat, parent = pc.filter(flat, nonempty), pc.filter(parent, nonempty).to_numpy()
            counts = np.bincount(parent, minlength=rb.num_rows) if len(parent) else np.zeros(rb.num_rows, np.int64)
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
            pos = np.arange(len(parent), dtype=np.int64) - starts[parent]
            keep = pos < limit
            flat = pc.filter(flat, pa.array(keep))
            counts = np.minimum(counts, limit)
            token = pc.take(ids_arr, pc.index_in(flat, options=lookup))
            borders = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            more = []
            if rest:
                missing = pc.is_null(token)
                before = np.concatenate([[0], np.cumsum(missing.to_numpy(zero_copy_only=False))]).astype(np.int32)
                place = before[:-1] - before[borders[:-1]][parent[keep]]
                token = pc.if_else(missing, pa.array(-1 - place, pa.int32()), token)
                more = [pa.ListArray.from_arrays(pa.array(before[borders]), pc.filter(flat, missing))]
            lists = pa.ListArray.from_arrays(pa.array(borders), pc.fill_null(token, unk).cast(pa.int32()))
            cols = [rb.column(rb.schema.get_field_index(k)) for k in keys]
            yield pa.RecordBatch.from_arrays([*cols, lists, pa.array(counts.astype(np.int64)), *more], names=schema.names)

    return docs.select(*keys, text_col).mapInArrow(run, schema)


def encode_split(docs: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("doc_id",),
                 text_col: str = "text", max_length: int | None = None,
                 ids: SpecialIds = DEFAULT_IDS, head_rows: int = HEAD_ROWS) -> DataFrame:
    """TOK1, any vocabulary size: the first ``head_rows`` ids by ``encode_arrow``, a join for the words left.

    Only the words left are exploded, with the number of their row; their ids are
    put in their places by one join of id lists.  Both steps are written, so that no
    reader of the result encodes again.
    """
    keys = list(keys)
    in_head = F.col("token_id") < F.lit(ids.first_word_id + head_rows)
    part = staged_parquet(encode_arrow(docs, vocab.where(in_head), keys, text_col, max_length, ids, rest=True)
                          .withColumn("_row", F.monotonically_increasing_id()), "part-encoded")
    asked = part.select("_row", F.posexplode("_words").alias("_k", "word"))
    entry = F.struct("_k", F.coalesce("token_id", F.lit(ids.unk)).alias("id"))
    found = (asked.join(vocab.where(~in_head).select("word", "token_id"), "word", "left")
             .groupBy("_row").agg(F.array_sort(F.collect_list(entry)).alias("_found"))
             .select("_row", F.col("_found.id").alias("_ids")))
    filled = F.transform("input_ids", lambda x: F.when(x < 0, F.get(F.col("_ids"), -1 - x)).otherwise(x))
    return staged_parquet(part.join(found, "_row", "left").select(*keys, filled.cast("array<int>").alias("input_ids"), "n_tokens"), "encoded")


def decode(encoded: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("doc_id",),
           ids_col: str = "input_ids", broadcast_limit: int = BROADCAST_VOCAB_ROWS,
           strategy: str = "auto") -> DataFrame:
    """TOK4: ids -> text; special and unknown ids are skipped, words joined by a space, stripped.

    ``strategy`` as in ``encode``: a vectorised Arrow lookup for a bounded
    vocabulary or the head of a larger one, whose other words are joined.
    """
    if strategy == "auto":
        strategy = "arrow" if vocab.count() <= broadcast_limit else "split"
    if strategy == "arrow":
        return decode_arrow(encoded, vocab, keys, ids_col)
    if strategy == "split":
        return decode_split(encoded, vocab, keys, ids_col, min(broadcast_limit, HEAD_ROWS))
    keys = list(keys)
    exploded = encoded.select(*keys, F.posexplode_outer(F.col(ids_col)).alias("pos", "token_id"))
    vocab_side = _sized(vocab.select("token_id", "word"), broadcast_limit)
    joined = exploded.join(vocab_side, on="token_id", how="left")
    entry = F.when(F.col("word").isNotNull(), F.struct("pos", "word"))
    grouped = joined.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("_pairs"))
    text = F.array_join(F.transform(F.col("_pairs"), lambda p: p["word"]), " ")
    return grouped.select(*keys, py_strip(text).alias("text"))


def decode_split(encoded: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("doc_id",),
                 ids_col: str = "input_ids", head_rows: int = HEAD_ROWS, ids: SpecialIds = DEFAULT_IDS) -> DataFrame:
    """TOK4, any vocabulary size: ids of the head index a broadcast word array, a join gives the words left."""
    keys = list(keys)
    first = ids.first_word_id + head_rows
    rows = staged_parquet(encoded.select(*keys, ids_col, F.monotonically_increasing_id().alias("_row")), "ids")
    asked = rows.select("_row", F.posexplode(F.filter(ids_col, lambda x: x >= F.lit(first))).alias("_k", "token_id"))
    found = (asked.join(vocab.where(F.col("token_id") >= F.lit(first)).select("token_id", "word"), "token_id", "left")
             .groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_k", "word"))).alias("_found"))
             .select("_row", F.col("_found.word").alias("_words")))
    joined = rows.join(found, "_row", "left").select(*keys, ids_col, F.coalesce("_words", F.array().cast("array<string>")).alias("_words"))
    return decode_arrow(joined, vocab.where(F.col("token_id") < F.lit(first)), keys, ids_col, first)


def decode_arrow(encoded: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("doc_id",),
                 ids_col: str = "input_ids", rest_from: int | None = None) -> DataFrame:
    """TOK4 for a bounded vocabulary: ids index a broadcast word array (``take``); no shuffle.

    ``rest_from``: the words of the ids from this one on are in each row's ``_words``, in order.
    """
    import pyarrow as pa

    table = vocab.select("token_id", "word").toArrow()
    token_ids = table.column("token_id").combine_chunks().to_numpy()
    lo = int(token_ids.min()) if len(token_ids) else 0
    size = int(token_ids.max()) - lo + 1 if len(token_ids) else 0
    words_by_id = [None] * size
    for tid, w in zip(token_ids.tolist(), table.column("word").to_pylist()):
        words_by_id[tid - lo] = w
    shipped = encoded.sparkSession.sparkContext.broadcast((lo, pa.array(words_by_id, pa.string())))
    keys = list(keys)
    schema = StructType([*(encoded.schema[k] for k in keys), StructField("text", StringType())])

    def run(batches):
        import numpy as np
        import pyarrow.compute as pc
        first, words = shipped.value
        for rb in batches:
            lists = rb.column(rb.schema.get_field_index(ids_col))
            flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            parent = pc.list_parent_indices(lists).to_numpy()
            idx = flat - first
            ok = (idx >= 0) & (idx < len(words))
            picked = pc.take(words, pa.array(idx, mask=~ok))
            if rest_from is not None:
                picked = pc.replace_with_mask(picked, pa.array(flat >= rest_from), pc.list_flatten(rb.column(rb.schema.get_field_index("_words"))))
            valid = pc.is_valid(picked).to_numpy(zero_copy_only=False)
            kept, kept_parent = pc.filter(picked, pa.array(valid)), parent[valid]
            counts = np.bincount(kept_parent, minlength=rb.num_rows) if len(kept_parent) else \
                np.zeros(rb.num_rows, np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            text = pc.binary_join(pa.ListArray.from_arrays(offsets, kept), " ")
            cols = [rb.column(rb.schema.get_field_index(k)) for k in keys]
            yield pa.RecordBatch.from_arrays([*cols, text], names=[*keys, "text"])

    return encoded.select(*keys, ids_col, *([] if rest_from is None else ["_words"])).mapInArrow(run, schema)
