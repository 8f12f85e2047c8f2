"""Registered queries vs their SQL (DuckDB) on sf0.001 — the same check the driver runs at sf0.01."""

import json

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E

FAST = ["quality_measures", "filter_report", "dedup_prefix", "lang_cap", "three_way_split", "vocab",
        "encode_truncate", "length_profile", "synthetic_corpus", "pack_greedy", "pack_concat", "batch_assign",
        "mcq_prompt", "answer_accuracy", "rouge_n", "chat_prompt", "request_payloads", "stream_reassembly",
        "running_best", "retention_topk", "ngram_nll", "approx_split", "union_sources", "decode",
        "eval_results", "pad_to_batch_max", "prepare_union", "length_grouped_assignment", "pack_concat_report",
        "split_round_trip", "stats_round_trip", "text_lines", "rouge_lcs", "pack_interior_eos", "step_plan", "dedup_report", "language_distribution", "length_histogram",
        "generate_greedy", "kn_nll", "rouge_bootstrap", "select_split", "epoch_batches", "length_sketches", "observed_filter_report", "committed_round_trip",
        "eval_prompts", "empty_corpus_fallback", "failed_source_replaced", "missing_input", "no_pack", "benchmark_scan", "synthetic_source"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(dcols, cur.fetchall())


def test_every_query_has_sql_or_is_listed():
    missing = {n for n in set(E.queries()) - set(E.oracle_sql()) if not n.startswith("op") and n != "pipeline"}
    assert missing == {"rouge_l"}


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert {r.split for r in rows} >= {"train", "ALL"}
