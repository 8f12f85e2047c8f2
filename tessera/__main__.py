"""Command line: ``python -m tessera {prepare,synthetic,pack,stats,evaluate} ...`` (runs on the active Spark master)."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .config import MAX_LENGTH
from .plans import jobs
from .plans.prepare import PrepareParams, synthetic_only
from .session import ensure_checkpoint_dir, ship_package
from .sources import registry, sinks
from .sources.tables import spread


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tessera")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("prepare", help="filter, dedup, cap, split and encode a document table")
    one = p.add_mutually_exclusive_group(required=True)
    one.add_argument("--input", help="Parquet documents (doc_id, text, lang, source)")
    one.add_argument("--registry", help="JSON list of sources: lang, source, path and optionally fmt, where, options, expected_size, max_samples")
    p.add_argument("--use-registry-caps", action="store_true", help="keep at most max_samples rows per language (the least of its sources')")
    p.add_argument("--output", required=True)
    p.add_argument("--max-length", type=int, default=0, help="words per document (0 = all)")
    p.add_argument("--max-samples", type=int, default=0, help="rows per language (0 = no cap)")
    k = sub.add_parser("pack", help="pack a token dataset into fixed-length chunks")
    k.add_argument("--input", required=True)
    k.add_argument("--output", required=True)
    k.add_argument("--max-length", type=int, default=MAX_LENGTH)
    k.add_argument("--no-pack", action="store_true")
    k.add_argument("--greedy", action="store_true", help="drop what overflows a chunk (reported) instead of packing losslessly")
    y = sub.add_parser("synthetic", help="synthetic text only, split and written")
    y.add_argument("--rows", type=int, required=True)
    y.add_argument("--output", required=True)
    e = sub.add_parser("evaluate", help="score benchmarks and collate one table")
    e.add_argument("--benchmark", action="append", default=[], metavar="NAME[=ITEMS[,RESPONSES]]",
                   help="Parquet items and responses (ROUGE: pairs); without items the benchmark gets an error row")
    e.add_argument("--losses", help="Parquet (nll, n) for the perplexity rows")
    e.add_argument("--output", required=True)
    s = sub.add_parser("stats", help="length profile of a split dataset")
    s.add_argument("--dataset", required=True)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"tessera-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    if args.cmd == "prepare":
        caps = None
        if args.registry:
            sources = registry.read_registry(spark, args.registry)
            docs, caps = registry.load_sources(spark, sources), registry.language_caps(spark, sources)
        else:
            docs = spread(spark.read.parquet(args.input))
        params = PrepareParams(lang_cap=args.max_samples or None, max_length=args.max_length or None,
                               caps=caps if args.use_registry_caps else None)
        print("written" if jobs.prepare_job(spark, docs, args.output, params) else "skipped: output exists")
    elif args.cmd == "pack":
        done = jobs.pack_job(spark, args.input, args.output, args.max_length, pack=not args.no_pack,
                             lossless=not args.greedy)
        print("written" if done else "skipped: output exists")
    elif args.cmd == "synthetic":
        rows = synthetic_only(spark.range(args.rows).selectExpr("id AS doc_id", "'id' AS lang"))
        print("written" if sinks.write_if_absent(rows, args.output) else "skipped: output exists")
    elif args.cmd == "evaluate":
        runs, names = {}, []
        for given in args.benchmark:
            name, _, paths = given.partition("=")
            names.append(name)
            if paths:
                items, _, responses = paths.partition(",")
                runs[name] = (spark.read.parquet(items), spark.read.parquet(responses) if responses else None)
        losses = spark.read.parquet(args.losses) if args.losses else None
        jobs.evaluate_job(spark, runs, names, args.output, losses).show(truncate=False)
    else:
        jobs.stats_job(spark, args.dataset).show(truncate=False)


if __name__ == "__main__":
    main()
