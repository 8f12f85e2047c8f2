"""Operator 8: URL filter by rules and a character language-model ratio, in DataFrame functions.

Rules (verdict, host, path) fit a host and its subdomains if the URL's path starts
with theirs; the longest wins.  URLs without a rule are judged by two smoothed
variable-order Markov models over characters, one of URLs that rules allow and one
of URLs that rules block: contexts of up to four characters, each order interpolated
with the next lower one (Witten-Bell).  A URL's score is the mean over its
characters of log(allowed / blocked); it is allowed at or above a threshold.

Half of the distinct URLs with a rule (by hash) train the models; the other half
calibrates the threshold, which minimises the shares of wrongly blocked and wrongly
allowed URLs, from a histogram of scores (``BIN`` wide).  Without URLs of both kinds every score
is 0 and URLs without a rule are allowed.

Counts are aggregated by five-character strings before anything is joined; the
lower orders come from those.  Scores are summed by distinct URL.  Hot strings meet
in joins that adaptive execution can split.  No side is broadcast: a written copy of short
strings is many times larger in the driver's memory than its files, by which Spark judges it.

Null URLs and those without ``://`` have an empty host and path and no rule; they
are judged as an empty text, score 0.  Repeated rows are judged alike; an empty table gives an
empty one; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER = 4
BIN = 0.01
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column, Column]:
    """(text after the scheme, host, path)."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"\A[^?#]*", 0)
    return rest, F.translate(raw, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (name, verdict); null if none does."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("name"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<name:string,verdict:string>")


def grams(text: Column) -> Column:
    """Every character with the four before it; the text is preceded by four marks and followed by one."""
    mark = F.lit("\u0001")
    chars = F.concat(F.array_repeat(mark, ORDER), F.filter(F.split(text, ""), lambda c: c != ""), F.array(mark))
    return F.transform(F.sequence(F.lit(1), F.size(chars) - ORDER), lambda i: F.array_join(F.slice(chars, i, ORDER + 1), ""))


def gram_scores(counts: DataFrame) -> DataFrame:
    """(gram, score): log(allowed / blocked) of each gram, from its counts in allowed (a) and blocked (b) URLs."""
    lower = None
    for k in range(ORDER + 1):
        mine = counts.withColumn("g", F.expr(f"right(gram, {k + 1})")).groupBy("g").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        mine = mine.withColumn("context", F.expr(f"left(g, {k})"))
        context = mine.groupBy("context").agg(*(x for c in "ab" for x in (F.sum(c).alias(f"n{c}"), F.sum((F.col(c) > 0).cast("long")).alias(f"t{c}"))))
        rows = mine.join(context.hint("merge"), "context")
        if lower is None:
            rows = rows.withColumns({"pa": F.lit(1e-3), "pb": F.lit(1e-3)})
        else:
            rows = rows.withColumn("h", F.expr(f"right(g, {k})")).join(lower.select(F.col("g").alias("h"), "pa", "pb").hint("merge"), "h")
        lower = rows.select("g", *(((F.col(c) + (F.col(f"t{c}") + 1) * F.col(f"p{c}")) / (F.col(f"n{c}") + F.col(f"t{c}") + 1)).alias(f"p{c}") for c in "ab"))
    return lower.select(F.col("g").alias("gram"), (F.log("pa") - F.log("pb")).alias("score"))


def best_cut(rows: list, width: float = BIN) -> float:
    """Lower border of the histogram bin from which on URLs are allowed; rows: (bin, allowed, blocked)."""
    a, b = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not a or not b:
        return float("-inf")
    best, cut, wrong_a, wrong_b = 2.0, 0.0, 0, b
    for at, x, y in sorted(map(tuple, rows)):
        if wrong_a / a + wrong_b / b < best:
            best, cut = wrong_a / a + wrong_b / b, at * width
        wrong_a, wrong_b = wrong_a + x, wrong_b - y
    return cut


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, llr and verdict of every page."""
    rest, host, path = parts(F.col("url"))
    rows = pages.select("page_id", "url", rest.alias("rest"), host.alias("host"), path.alias("path")).withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    texts = rows.where("rest <> ''").groupBy("rest").agg(F.first("found.verdict").alias("known"))  # the text after the scheme fixes host, path and rule
    train = F.pmod(F.xxhash64("rest"), F.lit(2)) == 0
    # dealt out, as every row becomes many
    n = max(pages.sparkSession.sparkContext.defaultParallelism, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = written(texts.withColumn("train", train).repartition(n, "rest"), "urls")
    each = texts.select("rest", "known", "train", F.explode(grams(F.col("rest"))).alias("gram"))
    used = [((F.col("known") == v) & F.col("train")).cast("long") for v in ("allow", "block")]
    counts = each.groupBy("gram").agg(*(F.coalesce(F.sum(u), F.lit(0)).alias(c) for u, c in zip(used, "ab")))
    scores = gram_scores(written(counts, "grams"))
    llr = each.join(scores.hint("merge"), "gram").groupBy("rest").agg(F.round(F.avg("score"), 9).alias("llr"))  # rounded: sums depend on the order of rows
    llr = written(texts.join(llr.hint("merge"), "rest").select("rest", "known", "train", "llr"), "scores")
    known = llr.where("known is not null")
    both = known.where("train").agg(*(F.coalesce(F.sum((F.col("known") == v).cast("long")), F.lit(0)) for v in ("allow", "block"))).first()
    held = known.where("not train").groupBy(F.floor(F.col("llr") / BIN).alias("at")).agg(
        *(F.sum((F.col("known") == v).cast("long")).alias(v) for v in ("allow", "block"))).collect()  # one row per bin; scores are bounded by the smoothing
    cut = best_cut(held) if both[0] and both[1] else float("-inf")
    out = rows.join(llr.select("rest", "llr").hint("merge"), "rest", "left").withColumn("llr", F.coalesce("llr", F.lit(0.0)) if both[0] and both[1] else F.lit(0.0))
    verdict = F.coalesce(F.col("found.verdict"), F.when(F.col("llr") >= F.lit(cut), "allow").otherwise("block"))
    return out.select("page_id", "host", "path", F.col("found.name").alias("rule"), "llr", verdict.alias("verdict"))
