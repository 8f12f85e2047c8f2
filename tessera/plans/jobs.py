"""End-to-end batch jobs: prepare -> pack -> stats, each reading and writing split datasets.

These are the user-facing steps: the prepared corpus and its tokens are
written once (split folders, SNK1) with a stats document next to them (SNK2);
a step whose output already exists is skipped (SNK3); reading a missing
dataset raises ``MissingDatasetError`` (SRC7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_IDS, MAX_LENGTH, SpecialIds
from ..operators import packing, profile
from ..sources import sinks
from ..sources.tables import read_splits
from .prepare import PrepareParams, prepare


def stats_path(output: str) -> str:
    return output.rstrip("/") + "_stats"


def prepare_job(spark: SparkSession, docs: DataFrame, output: str, p: PrepareParams = PrepareParams(),
                keep_text: bool = True) -> bool:
    """Filter, dedup, cap, split, encode; write ``output/tokens`` (and ``output/text``) by split.

    Returns False when ``output`` already holds the data and its stats (nothing is recomputed); a run that
    ended before its stats were written is completed.
    """
    tokens_out = output.rstrip("/") + "/tokens"
    if sinks.dataset_exists(spark, tokens_out) and sinks.stats_exist(spark, stats_path(output)):
        return False
    prep = prepare(docs, p)
    if keep_text:
        sinks.write_splits(prep.documents, output.rstrip("/") + "/text")
    sinks.write_splits(prep.encoded, tokens_out)
    written = read_splits(spark, tokens_out)
    sinks.write_stats(profile.prepare_stats(written, prep.vocab_size, prep.max_length), stats_path(output))
    return True


def pack_job(spark: SparkSession, tokens: str, output: str, max_length: int = MAX_LENGTH,
             ids: SpecialIds = DEFAULT_IDS, pack: bool = True, lossless: bool = True) -> bool:
    """Pack every split of a token dataset into fixed-length chunks (or keep one row per doc).

    Lossless by default; ``lossless=False`` packs greedily, which loses what overflows a chunk (and reports it).
    """
    if sinks.dataset_exists(spark, output) and sinks.stats_exist(spark, stats_path(output)):
        return False
    encoded = read_splits(spark, tokens)
    if not pack:
        chunks = packing.no_pack(encoded)
        report = profile.length_profile(chunks)
    elif lossless:
        chunks = packing.pack_concat(encoded, max_length, ids)
        report = packing.concat_report(encoded, max_length)
    else:
        segs = packing.materialized_segments(encoded, ("split", "shuffle_rank"), eos=ids.eos)
        plan = packing.greedy_plan(segs, max_length)
        chunks = packing.greedy_chunks(segs, plan, max_length, ids)
        report = packing.pack_report(plan, max_length)
    sinks.write_splits(chunks, output)
    sinks.write_stats(report, stats_path(output))
    return True


def stats_job(spark: SparkSession, dataset: str, output: str | None = None) -> DataFrame:
    """Per-split length profile with the all-splits row, plus totals; written as JSON next to the data."""
    df = read_splits(spark, dataset)
    if "n_tokens" not in df.columns:
        df = df.withColumn("n_tokens", F.size("input_ids").cast("bigint"))
    prof = profile.length_profile_with_totals(df)
    sinks.write_stats(prof, output or stats_path(dataset))
    sinks.write_stats(profile.corpus_totals(df), (output or stats_path(dataset)) + "_totals")
    return prof


def evaluate_job(spark: SparkSession, runs: dict, names, output: str | None = None,
                 losses: DataFrame | None = None, root: str | None = None, answer=None) -> DataFrame:
    """EV8/EV9: score the selected benchmarks and collate one long result table.

    ``runs`` maps a benchmark name to ``(items, responses)`` DataFrames (for a
    ROUGE benchmark: ``(pairs, None)`` with item_id, prediction, reference).
    Names not in the registry are ignored; a registered benchmark without
    inputs gets an error row; ``losses`` (nll, n) adds the perplexity rows.
    ``root``: a folder of benchmark data sets, from which the names without a run are loaded
    by their registered data set and split; ``answer`` gives the responses to their items
    (a failure to load is that benchmark's error row).
    """
    from ..operators import evaluation
    errors: dict = {}
    if root and answer:
        found, errors = evaluation.load_benchmarks(spark, [n for n in names if n not in runs], root)
        runs = {**runs, **{name: answer(items) for name, items in found.items()}}
    chosen = {r["name"]: r for r in evaluation.select_benchmarks(
        evaluation.benchmark_registry(spark), list(names)).collect()}  # registry rows: a handful
    parts = []
    for name, row in chosen.items():
        if name not in runs:
            parts.append(evaluation.error_row(spark, name, errors.get(name) or f"dataset not available: {row['dataset']}"))
        elif row["metric"] == "accuracy":
            items, responses = runs[name]
            acc = evaluation.accuracy(items, responses, name)
            parts.append(evaluation.result_rows(name, acc.select("accuracy", "correct", "total")))
        elif row["metric"] == "rouge":
            pairs, _ = runs[name]
            r = evaluation.rouge_n(pairs)
            parts.append(r.select(F.lit(name).alias("benchmark"), "metric", "value",
                                  F.lit(None).cast("string").alias("error")))
        else:
            parts.append(evaluation.error_row(spark, name, f"Unknown metric: {row['metric']}"))
    if losses is not None:
        ppl = evaluation.perplexity(losses)
        parts.append(evaluation.result_rows("perplexity", ppl.select("perplexity", "avg_loss")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    if output:
        sinks.write_stats(out, output)
    return out
