"""Operator 10: secret scan with a random forest that removes false findings, in DataFrame functions.

Candidates are quoted strings of eight characters or more, and runs of 16 or more
letters, digits and ``+/=_-``, with a digit; values of eight characters or more, of any
kind, that are assigned to a secret-like name; and private keys, from BEGIN to END (to
the end of the key lines if END is missing).  Each has these
features: length; shares of digits, upper-case letters and other signs; entropy; changes of
character class; mean log probability of its letter pairs in the corpus's words; the share
of it that dictionary words cover (words of three letters or more in ``MIN_DOCS``
documents, counted over all documents); whether it looks like a path, or follows one; whether it is
assigned or quoted; and neighbouring words that speak for or against a secret.

Findings with a label train the forest: a given table (value, label), or else
findings that fixed formats and rules decide: known key formats, and
random-looking values assigned to a name such as ``token``, are secrets;
placeholders, references, plain numbers, UUIDs and dictionary words are not.  At most
``LABELLED`` labelled values (smallest hashes) are used.  The forest then judges every candidate,
labelled or not, but a private key with its key lines, which is a secret by its form.  If labelled findings are all of one kind, the rules alone decide.

Null and empty texts have no candidates.  Repeated rows are reported each; an
empty table gives no rows.  Other columns are kept by ``redact`` only.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_text, written
from .privacy import cut_out, free_name, with_starts

LABELLED = 20_000
MIN_DOCS = 5
TREES, DEPTH = 20, 6
CUT = 0.5
CONTEXT = 40
_RUN = "[A-Za-z0-9+/=_-]"
_KEY = "[A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
_GAP = r"(?:\s|\\[nr])++"
_LINE_END = r"(?=[\x20\t]*+(?:[\r\n]|\\[nr]))|(?![\s\S])"
_KEY_LINES = (rf"(?:{_GAP}(?:(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset): [^\r\n\\]*+|[A-Za-z0-9+/=]{{16,}}+))++"
              rf"(?:{_GAP}[A-Za-z0-9+/]{{1,15}}+(?:=++|{_LINE_END}))?+")
_PRIVATE = rf"-----BEGIN {_KEY}(?:(?:[^-]++|-(?!----))*+-----END {_KEY}|{_KEY_LINES})?+"
_QUOTED = r"(?<=[\"'])[^\s\"']{8,}+(?=[\"'])"
#: Private keys, quoted strings and runs.
PATTERN = rf"{_PRIVATE}|{_QUOTED}|(?<!{_RUN}){_RUN}{{16,}}+"
#: A secret-like name with = or : after it, up to the value.
_TO_VALUE = r"(?i:token|secret|passw|pwd|api[_-]?key|access|auth(?!or)|bearer|credential|private)[A-Za-z0-9_-]{0,20}[\"']?[\x20\t]{0,16}(?::=|=>|[=:])[\x20\t]{0,16}[\"'`]?"
_ASSIGNED = rf"(?<=[=:>][\x20\t]{{0,16}}[\"'`]?)(?<={_TO_VALUE})(?:(?<=\")[^\s\"]{{8,}}+|(?<=')[^\s']{{8,}}+|(?<=`)[^\s`]{{8,}}+|(?<![\"'`])[^\s\"'`=:>]\S{{7,}}+)"
#: All candidates; a run ends before a private key and does not take in the name that a value is assigned to.
SCAN = rf"{_PRIVATE}|{_ASSIGNED}|{_QUOTED}|(?<!{_RUN})(?![A-Za-z0-9_-]{{0,64}}?{_TO_VALUE}[^\s\"'`=:>]\S{{7}})(?:(?!-----BEGIN ){_RUN}){{16,}}+"
#: Public formats of keys.
FORMATS = r"\A(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}|sk_live_[0-9A-Za-z]{24,}|-----BEGIN .*)"
FOR = r"(?i)token|secret|passw|pwd|api[_-]?key|access|auth|bearer|credential|private"
AGAINST = r"(?i)example|sample|dummy|test|placeholder|sha(?:1|256|sum)?\b|md5|commit|checksum|digest|uuid|isbn"
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|(.)\1{7,}"
#: Calls, items, variables to fill in, and addresses without a login.
REFERENCE = r"\A(?:[A-Za-z_][A-Za-z0-9_.]*[(\[]|\$[{(]|<|\{\{|%\(|[a-z][a-z0-9+.-]*://[^@]*\z)"
UUID = r"(?i)\A[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
FEATURES = ["n", "digits", "upper", "signs", "entropy", "changes", "pairs", "covered", "path", "after_path", "assigned", "quoted", "for", "against"]


def _guard(text: Column) -> Column:
    return text.rlike(rf"[0-9]|PRIVATE KEY|{_TO_VALUE}")


def candidates(texts: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, start, end, value, before and after of every candidate in ``text``."""
    df = texts.where(_guard(F.col("text"))).withColumn("_found", F.regexp_extract_all("text", F.lit(SCAN), F.lit(0))).where(F.size("_found") > 0)
    df = with_starts(df.withColumn("_pieces", F.split("text", SCAN, -1)), "_pieces", "_found", "_starts")

    def one(m: Column, i: Column) -> Column:
        start = F.get("_starts", i)
        ahead = F.concat(F.coalesce(F.right(F.get("_found", i - 1), F.lit(2 * CONTEXT)), F.lit("")), F.right(F.get("_pieces", i), F.lit(2 * CONTEXT)))
        return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value"), F.right(ahead, F.lit(CONTEXT)).alias("before"),
                        F.left(F.get("_pieces", i + 1), F.lit(CONTEXT)).alias("after"), ahead.rlike(rf"{_TO_VALUE}\z").alias("named"))

    real = F.filter(F.transform("_found", one), lambda x: x["value"].rlike("[0-9]") | x["value"].startswith("-----BEGIN") | x["named"])
    return df.select(*keep, F.explode(real).alias("x")).select(*keep, "x.*").drop("named")


def _share(value: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(value, pattern, "")) / F.length(value)


def _entropy(value: Column) -> Column:
    n = F.length(value)

    def add(total: Column, c: Column) -> Column:
        p = (n - F.length(F.replace(value, c, F.lit("")))) / n
        return total - p * F.log2(p)

    return F.aggregate(F.array_distinct(F.split(value, "")), F.lit(0.0), lambda t, c: F.when(c == "", t).otherwise(add(t, c)))


def dictionary(docs: DataFrame) -> DataFrame:
    """(word, n): words of three letters or more in ``MIN_DOCS`` documents or more."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}+"), F.lit(0)))
    return doc_text(docs).select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCS)


def _pairs(word: Column) -> Column:
    plain = F.regexp_replace(F.lower(word), "[^a-z]", "#")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(plain) - 1, F.lit(1))), lambda i: F.substring(plain, i, F.lit(2)))


def value_features(values: DataFrame, words: DataFrame) -> DataFrame:
    """Adds covered and pairs, which need the corpus, to distinct values."""
    runs = values.select("value", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("value"), F.lit(r"\p{L}{3,}+"), F.lit(0)))).alias("word"))
    size = (F.length("value") - F.length(F.replace(F.lower("value"), F.col("word"), F.lit("")))) / F.length("value")
    covered = runs.join(words, "word").groupBy("value").agg(F.least(F.sum(size), F.lit(1.0)).alias("covered"))
    table = words.select("n", F.explode(_pairs(F.col("word"))).alias("pair")).where(F.length("pair") == 2).groupBy("pair").agg(F.sum("n").alias("n"))
    first = table.groupBy(F.left("pair", F.lit(1)).alias("one")).agg(F.sum("n").alias("all"))
    table = table.withColumn("one", F.left("pair", F.lit(1))).join(first, "one").select("pair", F.log((F.col("n") + 1) / (F.col("all") + 27)).alias("p"))
    # at most 27 * 27 pairs, by construction
    seen = values.select("value", F.explode(_pairs(F.col("value"))).alias("pair")).join(F.broadcast(table), "pair", "left")
    pairs = seen.groupBy("value").agg(F.avg(F.coalesce("p", F.lit(-7.0))).alias("pairs"))
    return values.join(covered, "value", "left").join(pairs, "value", "left").withColumns({"covered": F.coalesce("covered", F.lit(0.0)), "pairs": F.coalesce("pairs", F.lit(-7.0))})


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    v, before = F.col("value"), F.col("before")
    more = written(value_features(found.select("value").distinct(), words), "values")
    flag = lambda c: c.cast("double")
    return found.join(more, "value").withColumns({
        "n": F.length(v).cast("double"), "digits": _share(v, "[^0-9]"), "upper": _share(v, "[^A-Z]"), "signs": _share(v, "[A-Za-z0-9]"), "entropy": _entropy(v),
        "changes": (F.size(F.regexp_extract_all(v, F.lit("[a-z]++|[A-Z]++|[0-9]++|[^A-Za-z0-9]++"), F.lit(0))) - 1) / F.length(v),
        "path": flag(v.rlike(r"/[^/]*/|\.[a-z]{2,4}\z")), "after_path": flag(before.rlike(r"[/\\]\z|://")), "assigned": flag(before.rlike(r"[=:]\s*[\"']?\z")),
        "quoted": flag(before.rlike("[\"']\\z") & F.col("after").rlike("\\A[\"']")), "for": flag(before.rlike(FOR)), "against": flag(F.concat_ws(" ", before, F.col("after")).rlike(AGAINST))})


def _whole_key(value: Column) -> Column:
    """Whether it is a private key with its key lines, not a header only."""
    return value.startswith("-----BEGIN") & value.rlike("[A-Za-z0-9+/=]{32}")


def rules(found: DataFrame) -> Column:
    """1 or 0 for findings that formats and rules decide, else null."""
    v = F.col("value")
    plain = v.rlike(PLACEHOLDER) | v.rlike(REFERENCE) | v.rlike(UUID) | v.rlike(r"\A[0-9 _/=+-]+\z") | (F.col("covered") > 0.6) | ((F.col("against") == 1) & (F.col("for") == 0))
    return (F.when(_whole_key(v), 1).when(plain, 0).when(v.rlike(FORMATS), 1)
            .when((F.col("for") == 1) & (F.col("assigned") == 1) & (F.col("entropy") >= 3) & v.rlike("[0-9]"), 1)
            .when((F.col("for") == 0) & (F.col("assigned") == 0), 0))


def judged(found: DataFrame, words: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The candidates with probability and secret (boolean)."""
    rows = written(features(found, written(words, "dictionary")), "findings")
    label = rows.withColumn("label", rules(rows)) if labelled is None else rows.join(labelled.select("value", F.col("label").cast("int").alias("label")).dropna().groupBy("value").agg(F.max("label").alias("label")), "value")
    once = label.where("label is not null").groupBy("value").agg(F.max("label").alias("label"), *(F.first(c).alias(c) for c in FEATURES))
    train = written(once.orderBy(F.xxhash64("value"), "value").limit(LABELLED), "labelled")
    kinds = train.agg(F.min("label"), F.max("label")).first()
    if kinds[0] == kinds[1]:  # none, or of one kind
        p = F.coalesce(rules(rows), F.lit(0)).cast("double")
        return rows.withColumn("probability", p).withColumn("secret", p >= CUT)
    to_vector = VectorAssembler(inputCols=FEATURES, outputCol="_vector")
    forest = RandomForestClassifier(featuresCol="_vector", labelCol="label", rawPredictionCol="_raw", probabilityCol="_probability", predictionCol="_prediction", numTrees=TREES, maxDepth=DEPTH, seed=7)
    scored = forest.fit(to_vector.transform(train)).transform(to_vector.transform(rows))
    p = F.when(_whole_key(F.col("value")), 1.0).otherwise(vector_to_array("_probability")[1])
    return scored.withColumn("probability", p).withColumn("secret", p >= CUT)


def secrets(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, start, end, probability, secret and a hash of the value of every candidate."""
    found = written(candidates(doc_text(docs), ["doc_id"]), "candidates")
    out = judged(found, dictionary(docs), labelled)
    return out.select("doc_id", "start", "end", F.sha2("value", 256).alias("value_sha256"), "probability", "secret")


def redact(docs: DataFrame, labelled: DataFrame | None = None, put: str = "[secret]") -> DataFrame:
    """The documents, all columns, with secrets replaced in ``text`` (and ``n_chars`` counted anew).

    Texts that cannot hold a candidate pass by in place; only the others are joined with the findings, by text.
    """
    key, new = free_name(docs, "_key"), free_name(docs, "_new")
    texts = docs.select("text", F.sha2("text", 256).alias("key"))
    found = written(candidates(texts, ["key"]), "candidates")
    spans = written(judged(found, dictionary(docs), labelled).where("secret").select("key", "start", "end", F.lit(put).alias("put")).distinct(), "spans")
    changed = cut_out(texts, spans).select(F.col("key").alias(key), F.col("text").alias(new))
    maybe = F.coalesce(_guard(F.col("text")), F.lit(False))
    rows = docs.where(maybe)
    rows = rows.join(changed, F.sha2(rows["text"], 256) == changed[key], "left")
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col(key).isNull(), F.col("n_chars")).otherwise(F.length(new).cast(docs.schema["n_chars"].dataType)))
    rows = rows.withColumn("text", F.when(F.col(key).isNull(), F.col("text")).otherwise(F.col(new)))
    return docs.where(~maybe).unionByName(rows.select(docs.columns))
