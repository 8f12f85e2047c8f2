"""Registered queries of the word models: greedy generation, Kneser-Ney scoring, bootstrap intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import MCQ_NEW_TOKENS
from ..functions.text import words
from ..operators import evaluation, language_model
from ..sources.tables import table
from . import catalog, derived
from . import oracle_sql as sql
from .catalog import register
from .prepare import split_documents

PROMPT_WORDS = 8


def _prepared(spark, d):
    return split_documents(catalog._docs(spark, d)).select("doc_id", "lang", "text", "split")


@register("generate_greedy", f"""
WITH RECURSIVE {sql.prepared_ctes()},
{sql.generator_ctes("(SELECT text FROM prepared WHERE split = 'train')", 'gr')},
prompts AS (SELECT doc_id, array_to_string({sql.words_sql('text')}[1:{PROMPT_WORDS}], ' ') AS prompt FROM prepared),
{sql.generate_ctes('prompts', 'doc_id', 'gr', MCQ_NEW_TOKENS)}
SELECT p.doc_id, p.prompt, array_to_string(g.out, ' ') AS continuation, CAST(len(g.out) AS BIGINT) AS n_new
FROM prompts p JOIN gr_gen g ON p.doc_id = g.doc_id WHERE g.done OR g.step = {MCQ_NEW_TOKENS}""")
def q_generate_greedy(spark, d):
    # EV10: every document's first words are continued by a model of the train split
    prepared = _prepared(spark, d)
    model = language_model.train_generator(prepared.where(F.col("split") == "train"))
    prompts = prepared.select("doc_id", F.array_join(F.slice(words(F.col("text")), 1, PROMPT_WORDS), " ").alias("prompt"))
    out = language_model.generate_greedy(prompts, model, MCQ_NEW_TOKENS)
    model.drop()
    return out


_KN_SQL = f"""WITH {sql.prepared_ctes()},
{sql.kneser_ney_ctes("(SELECT text FROM prepared WHERE split = 'train')")},
{sql.triples_sql("(SELECT doc_id, lang, text FROM prepared WHERE split <> 'train')", 'ke', 'doc_id, lang,')},
knll AS (
  SELECT e.doc_id, e.lang, round(sum(-ln(coalesce(p3.p, coalesce(g3.g, 1) * coalesce(p2.p, coalesce(g2.g, 1)
           * coalesce(p1.p, (SELECT CASE WHEN n > 0 THEN d1 * types / n ELSE 1 END / (types + 1) FROM z)))))) / count(*), 6) AS nll, count(*) AS n
  FROM ke e LEFT JOIN p3 ON e.u = p3.u AND e.v = p3.v AND e.w = p3.w LEFT JOIN g3 ON e.u = g3.u AND e.v = g3.v
  LEFT JOIN p2 ON e.v = p2.v AND e.w = p2.w LEFT JOIN g2 ON e.v = g2.v LEFT JOIN p1 ON e.w = p1.w
  GROUP BY e.doc_id, e.lang
)
"""


def _kn_losses(spark, d):
    prepared = _prepared(spark, d)
    model = language_model.kneser_ney(prepared.where(F.col("split") == "train"))
    out = language_model.kn_nll(prepared.where(F.col("split") != "train"), model)
    model.drop()
    return out


@register("kn_nll", _KN_SQL + "SELECT doc_id, lang, nll, n FROM knll")
def q_kn_nll(spark, d):
    return _kn_losses(spark, d)


@register("kn_perplexity", _KN_SQL + f"SELECT coalesce(lang, 'ALL') AS lang, {catalog._PPL} FROM knll GROUP BY ROLLUP (lang)")
def q_kn_perplexity(spark, d):
    return evaluation.perplexity_by(_kn_losses(spark, d))


_LCS_DP = catalog._PAIRS_SQL + catalog.LCS_CTES
_STEPS = " + ".join(f"(u >= {x})::INT" for x in evaluation.poisson_steps())
_F = "CASE WHEN pr + rc > 0 THEN 2.0 * pr * rc / (pr + rc) ELSE 0.0 END"


@register("rouge_bootstrap", f"""
WITH RECURSIVE {_LCS_DP},
{catalog._rouge_sql(1)},{catalog._rouge_sql(2)},
scores AS (SELECT item_id, 'rouge1' AS metric, {_F} AS f FROM f1 UNION ALL SELECT item_id, 'rouge2', {_F} FROM f2
           UNION ALL SELECT item_id, 'rougeL', round({_F}, 6) FROM l),
drawn AS (SELECT item_id, metric, f, rep, CAST('0x' || substr(md5('42:' || CAST(item_id AS VARCHAR) || ':' || CAST(rep // 8 AS VARCHAR)), rep % 8 * 4 + 1, 4) AS INTEGER) AS u
          FROM scores, (SELECT CAST(unnest(range({evaluation.BOOTSTRAP_REPLICATES})) AS INTEGER) AS rep)),
means AS (SELECT metric, rep, sum(({_STEPS}) * f) / sum({_STEPS}) AS m FROM drawn GROUP BY metric, rep HAVING sum({_STEPS}) > 0)
SELECT metric, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.5), 6) AS mid, round(quantile_cont(m, 0.975), 6) AS high,
       count(*) AS replicates
FROM means GROUP BY metric""")
def q_rouge_bootstrap(spark, d):
    pairs = derived.summary_pairs(table(spark, d, "benchmark"))
    scores = evaluation.rouge_scores(pairs)
    return evaluation.bootstrap(scores.where("metric <> 'rougeLsum'"))
