"""EV3-6, ROUGE-L, CHT1/CHT4 and the run log (FIXTURES 3.6-3.8)."""

import math
import random

from pyspark.sql import functions as F

from tessera.operators import evaluation, prompts, runlog


def test_answer_matching(spark):
    df = spark.createDataFrame([("b", None, " B. yes"), (None, 0, "A"), ("", None, "A")],
                               "answer string, label long, response string")
    rows = df.select(evaluation.is_hit(evaluation.answer_key(F.col("answer"), F.col("label")),
                                       F.col("response")).alias("h")).collect()
    assert [r.h for r in rows] == [True, False, False]


def test_skipped_items_not_counted(spark):
    items = spark.createDataFrame([(1, "q", ["x", "y"], None, "A", None), (2, None, None, None, "A", None)],
                                  "item_id long, question string, choices array<string>, text string, "
                                  "answer string, label long")
    resp = spark.createDataFrame([(1, "a"), (2, "a")], "item_id long, response string")
    r = evaluation.accuracy(items, resp, "b").collect()[0]
    assert (r.correct, r.total, r.accuracy) == (1, 1, 1.0)


def test_weighted_perplexity(spark):
    df = spark.createDataFrame([(1.0, 1), (3.0, 3)], "nll double, n long")
    r = evaluation.perplexity(df).collect()[0]
    assert r.avg_loss == 2.5 and abs(r.perplexity - math.exp(2.5)) < 1e-5
    r = evaluation.perplexity(spark.createDataFrame([(25.0, 2)], "nll double, n long")).collect()[0]
    assert abs(r.perplexity - round(math.exp(20), 6)) < 1e-3


def _lcs_dp(a, b):
    dp = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            cur = dp[j]
            dp[j] = prev + 1 if x == y else max(dp[j], dp[j - 1])
            prev = cur
    return dp[-1]


def test_bit_parallel_lcs():
    rnd = random.Random(0)
    for _ in range(300):
        a = [rnd.choice("abcd") for _ in range(rnd.randint(0, 30))]
        b = [rnd.choice("abcd") for _ in range(rnd.randint(0, 30))]
        assert evaluation.lcs_length(a, b) == _lcs_dp(a, b)


def test_rouge_l_against_python(spark):
    pairs = spark.createDataFrame([(1, "the cat sat on the mat", "the cat is on the mat"), (2, "a b", "c d")],
                                  "item_id long, prediction string, reference string")
    got = {r.item_id: r.rougeL for r in evaluation.rouge_l_scores(pairs).collect()}
    lcs = 5
    p, r = lcs / 6, lcs / 6
    assert abs(got[1] - 2 * p * r / (p + r)) < 1e-6 and got[2] == 0.0


def test_chat_prompt(spark):
    df = spark.createDataFrame([(1, 0, "sYSTEM", "s"), (1, 1, "user", "u")],
                               "conv_id long, turn long, role string, text string")
    assert prompts.chat_prompt(df).collect()[0].prompt == "<|System|>\ns\n<|User|>\nu\n<|Assistant|>\n"


def test_stream_reassembly(spark):
    lines = ['data: {"choices":[{"text":"a"}]}', "", 'data: {"choices":[{}]}', 'data: {"choices":[{"text":"b"}]}',
             "data: [DONE]"]
    df = spark.createDataFrame([(7, i, x) for i, x in enumerate(lines)], "request_id long, seq long, line string")
    assert prompts.reassemble(df).collect()[0].text == "ab"


def _log(spark, losses, evals=None):
    rows = [(1, i + 1, None, float(v), (evals or {}).get(i + 1)) for i, v in enumerate(losses)]
    return spark.createDataFrame(rows, "run_id long, step long, ts timestamp, loss double, eval_loss double")


def test_loss_every_n(spark):
    got = runlog.loss_every_n(_log(spark, list(range(1, 16)))).collect()
    assert [(r.step, r.mean_loss) for r in got] == [(10, 5.5)]


def test_running_best(spark):
    log = _log(spark, [0] * 4, {1: 3.0, 2: 2.0, 3: 2.0, 4: 1.0})
    got = sorted((r.step, r.new_best) for r in runlog.running_best(log).collect())
    assert [b for _, b in got] == [True, True, False, True]


def test_retention(spark):
    log = _log(spark, [0.0] * 3500)
    got = sorted(r.step for r in runlog.retention(log, 500, 5).collect())
    assert got == [1500, 2000, 2500, 3000, 3500]


def test_scorer_hook_built_once_per_partition(spark):
    import pandas as pd
    built = spark.sparkContext.accumulator(0)

    def factory():
        built.add(1)
        return lambda pdf: pd.DataFrame({"item_id": pdf["item_id"], "score": pdf["item_id"] * 2.0})

    items = spark.range(100).withColumnRenamed("id", "item_id").repartition(4)
    out = evaluation.score_partitions(items, factory, "item_id long, score double")
    rows = out.collect()
    assert sorted(r.score for r in rows) == [i * 2.0 for i in range(100)]
    assert built.value == 4


def test_label_to_letter_option(spark):
    df = spark.createDataFrame([(None, 1, "B. yes")], "answer string, label long, response string")
    plain = df.select(evaluation.is_hit(evaluation.answer_key(F.col("answer"), F.col("label")), F.col("response")))
    mapped = df.select(evaluation.is_hit(evaluation.answer_key(F.col("answer"), F.col("label"), True), F.col("response")))
    assert plain.first()[0] is False and mapped.first()[0] is True
