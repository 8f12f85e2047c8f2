"""Run-log analytics (re-aimed from the training loop).  RUN1 … RUN7

Input: ``run_log(run_id, step, ts, loss, eval_loss)``.  Aggregates are
partial/final; order-dependent rules (running best, newest-k) use the
distributed ordinal / prefix scan instead of a per-run single-task window, so
one run holding a third of all rows still spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BATCH_SIZE, EVAL_STEPS, GRAD_ACCUM, LOGGING_STEPS, PERPLEXITY_CAP, SAVE_STEPS, SAVE_TOTAL_LIMIT
from .ordinal import with_ordinal, with_running


def _r6(c):
    return F.round(c, 6)


def loss_every_n(log: DataFrame, n: int = LOGGING_STEPS) -> DataFrame:
    """RUN1: mean loss of each complete block of ``n`` steps, reported at the block's last step."""
    bucket = F.floor((F.col("step") - 1) / F.lit(n)).cast("bigint")
    agg = log.groupBy("run_id", bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_c"), F.sum("loss").alias("_s"))
    return agg.where(F.col("_c") == n).select(
        "run_id", ((F.col("_b") + 1) * F.lit(n)).cast("bigint").alias("step"),
        _r6(F.col("_s") / F.lit(n)).alias("mean_loss"))


def running_best(log: DataFrame) -> DataFrame:
    """RUN2: for each evaluation, whether ``eval_loss`` beats every earlier one (strictly)."""
    evals = log.where(F.col("eval_loss").isNotNull()).select("run_id", "step", "eval_loss")
    prev = with_running(evals, ["step"], "eval_loss", ["run_id"], op="min", out="prev_best")
    return prev.select("run_id", "step", "eval_loss",
                       (F.col("prev_best").isNull() | (F.col("eval_loss") < F.col("prev_best"))).alias("new_best"))


def throughput(log: DataFrame, batch_size: int = BATCH_SIZE, grad_accum: int = GRAD_ACCUM,
               every: int = LOGGING_STEPS) -> DataFrame:
    """RUN3: samples/sec = step × batch × accumulation / seconds since the run's first record."""
    start = log.groupBy("run_id").agg(F.min("ts").alias("_t0"))
    logged = log.where(F.col("step") % every == 0).join(start, "run_id")
    elapsed = F.timestamp_diff("MICROSECOND", F.col("_t0"), F.col("ts"))
    secs = elapsed.cast("double") / F.lit(1e6)
    rate = F.when(secs > 0, F.col("step") * F.lit(batch_size * grad_accum) / secs)
    return logged.select("run_id", "step", _r6(secs).alias("elapsed_sec"), _r6(rate).alias("samples_per_sec"))


def cadence(log: DataFrame, eval_steps: int = EVAL_STEPS, save_steps: int = SAVE_STEPS) -> DataFrame:
    """RUN4: steps where an evaluation or a checkpoint happens."""
    is_eval = (F.col("step") % eval_steps) == 0
    is_save = (F.col("step") % save_steps) == 0
    return log.where(is_eval | is_save).select("run_id", "step", is_eval.alias("is_eval"), is_save.alias("is_save"))


def retention(log: DataFrame, save_steps: int = SAVE_STEPS, limit: int = SAVE_TOTAL_LIMIT) -> DataFrame:
    """RUN5: the newest ``limit`` checkpoints per run, in numeric step order (not name order)."""
    ckpt = log.where(F.col("step") % save_steps == 0).select("run_id", "step")
    ranked = with_ordinal(ckpt, [F.col("step").desc()], ["run_id"], out="newest_rank")
    return ranked.where(F.col("newest_rank") < limit).select("run_id", "step", "newest_rank")


def validation_perplexity(batch_losses: DataFrame, by=("run_id", "eval_step")) -> DataFrame:
    """RUN6: unweighted mean of batch losses and ``exp(min(mean, 20))``."""
    avg = F.avg("loss")
    return batch_losses.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("batches"), _r6(avg).alias("eval_loss"),
        _r6(F.exp(F.least(avg, F.lit(PERPLEXITY_CAP)))).alias("eval_perplexity"))


def eval_batches(log: DataFrame, every: int = 5) -> DataFrame:
    """Batch losses of each evaluation: the ``every`` steps ending at an eval step."""
    return log.select("run_id", (F.ceil(F.col("step") / F.lit(every)) * every).cast("bigint").alias("eval_step"),
                      "loss")


def run_summary(log: DataFrame) -> DataFrame:
    """RUN7: total steps, hours between first and last record, best eval loss (null if none)."""
    span = F.timestamp_diff("MICROSECOND", F.min("ts"), F.max("ts")).cast("double") / F.lit(3.6e9)
    return log.groupBy("run_id").agg(
        F.max("step").cast("bigint").alias("total_steps"), _r6(span).alias("total_time_hours"),
        F.min("eval_loss").alias("best_eval_loss"))
