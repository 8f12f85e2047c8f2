"""Operator 4: personal data, and terms that reveal it, in DataFrame functions.

Emails, IP addresses, card and phone numbers are found by their patterns in whole texts, leftmost and
not overlapping within a kind; matches that fail their check (address parts, Luhn,
digit counts) are dropped.  The patterns are written so that each scan is linear.

Each distinct value found is a protected entity e.  Terms t are words of three
letters or more outside the mentions.  Over all N documents, with n(e) documents that
hold e, n(t) that hold t and n(t, e) that hold both: IC(e) = log2(N / n(e)) is what e
tells, PMI(t; e) = log2(N n(t, e) / (n(t) n(e))) what t tells of it.  A term with
PMI / IC of ``GENERALISE`` or more, together with e in ``MIN_DOCS`` documents at least,
discloses e: all its occurrences in documents that hold e are generalised, from
``REMOVE`` on removed.  (With fewer documents there is no estimate.)  As n(t, e) <= n(e),
only terms with n(t) <= N (n(e) / N) ** ``GENERALISE`` can do so; others are not
paired, which loses nothing.  An entity in all documents
tells nothing and has no such terms.

Null and empty texts hold nothing.  Each row counts as a document, repeated ones
too.  An empty table gives an empty one.  Other columns are kept by ``sanitise`` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_text, written

#: Elements of an array that are summed up in one go.
BLOCK = 128
#: Characters of a text that meet their spans in one row.
CHUNK = 1_000
MIN_DOCS = 3
GENERALISE = 0.8
REMOVE = 0.95
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: The start conditions and possessive quantifiers change no match; they only spare restarts within a run.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_WORD = r"\p{L}{3,}+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    turned = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(turned, i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"\A{_BYTE}(?:\.{_BYTE}){{3}}\z")
    if kind == "card":
        return F.when(F.length(_digits(value)).between(12, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _guard(kind: str, text: Column) -> Column:
    """A cheap condition that any text with a match fulfils."""
    return {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}.get(kind, text.rlike("[0-9]"))


def with_starts(df: DataFrame, pieces: str, found: str, out: str) -> DataFrame:
    """Adds the start of each match, from the array of pieces around the matches and that of the matches.

    Running sums in three levels of blocks: no array grows beyond a block, so the work is linear in the matches.
    """
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), lambda t, v: t + v)

    def part(x: str, i: Column) -> Column:
        return F.slice(x, i * BLOCK + 1, F.lit(BLOCK))

    def numbers(x: str) -> Column:
        return F.filter(F.sequence(F.lit(0), F.ceil(F.size(x) / F.lit(float(BLOCK))).cast("int") - 1, F.lit(1)), lambda i: i >= 0)

    def before(x: Column, first: Column) -> Column:
        """First, first + x[0], ...: as long as x, which is a block."""
        zero = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(x, zero, lambda s, v: F.struct((s["at"] + v).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    def blocks(x: str) -> Column:
        return F.when(F.size(x) > 0, F.transform(numbers(x), lambda i: total(part(x, i)))).otherwise(F.array().cast("array<int>"))

    def spread(x: str, first: str) -> Column:
        return F.when(F.size(x) > 0, F.flatten(F.transform(numbers(x), lambda i: before(part(x, i), F.get(first, i))))).otherwise(F.array().cast("array<int>"))

    # one length a match: its own and that of the piece after it
    df = df.withColumn("_l0", F.transform(found, lambda m, i: F.length(m) + F.length(F.get(pieces, i + 1))))
    df = df.withColumn("_l1", blocks("_l0")).withColumn("_l2", blocks("_l1"))
    df = df.withColumn("_s2", before(F.col("_l2"), F.coalesce(F.length(F.get(pieces, F.lit(0))), F.lit(0))))
    df = df.withColumn("_s1", spread("_l1", "_s2"))
    return df.withColumn(out, spread("_l0", "_s1")).drop("_l0", "_l1", "_l2", "_s1", "_s2")


def free_name(df: DataFrame, name: str) -> str:
    """The name, or one like it that is not a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut_out(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(key, text) of the ``texts`` (key, text) that have ``spans`` (key, start, end, put): each span replaced by its
    ``put``; of spans that overlap, the first one's.

    Texts are cut into chunks of ``CHUNK`` characters, each of which meets its own spans; chunks are joined again at the end.
    """
    chunk = F.col("start") - F.pmod("start", F.lit(CHUNK))
    cut = spans.withColumn("c", F.explode(F.sequence((chunk / CHUNK).cast("int"), F.floor((F.greatest(F.col("end"), F.col("start") + 1) - 1) / CHUNK).cast("int"))))
    at = F.col("c") * CHUNK
    entry = F.struct(F.greatest(F.col("start") - at, F.lit(0)).alias("start"), F.col("start").alias("whole"), F.least(F.col("end") - at, F.lit(CHUNK)).alias("end"),
                     F.when(F.col("start") >= at, F.col("put")).otherwise("").alias("put"))
    cut = cut.groupBy("key", "c").agg(F.array_sort(F.collect_list(entry)).alias("spans"))  # at most one span a start and put in a chunk
    some = texts.join(spans.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    rows = some.select("key", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))).alias("c", "chunk")).join(cut, ["key", "c"], "left")

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(F.col("chunk"), state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["out"], gap, F.when(fresh, s["put"]).otherwise("")).alias("out"))

    new = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(F.col("chunk"), s["at"] + 1, F.lit(CHUNK))))
    rows = rows.select("key", F.struct("c", F.coalesce(F.when(F.col("spans").isNotNull(), new), F.col("chunk")).alias("t")).alias("x"))
    return rows.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "").alias("text"))


def _matches(df: DataFrame, kind: str) -> DataFrame:
    """Adds the column ``kind``: array of (start, rank, end, kind, value)."""
    pattern, some = F.lit(PATTERNS[kind]), _guard(kind, F.col("text"))
    df = df.withColumn("_found", F.when(some, F.regexp_extract_all("text", pattern, F.lit(0))))
    df = df.withColumn("_found", F.when(F.size("_found") > 0, F.col("_found")))
    df = df.withColumn("_pieces", F.when(F.col("_found").isNotNull(), F.split("text", PATTERNS[kind], -1)))
    df = with_starts(df, "_pieces", "_found", "_starts")

    def one(m: Column, i: Column) -> Column:
        start = F.get("_starts", i)
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + F.length(m)).alias("end"), F.lit(kind).alias("kind"), m.alias("value"))

    kept = F.filter(F.transform("_found", one), lambda x: passes(kind, x["value"]))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")
    return df.withColumn(kind, F.coalesce(kept, none)).drop("_found", "_pieces", "_starts")


def base_spans(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_<kind>, spans (by start, then kind) and, if there are any, text of every document row."""
    df = doc_text(docs).withColumn("row", F.monotonically_increasing_id())
    for kind in KINDS:
        df = _matches(df, kind)
    return df.select("row", "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.array_sort(F.concat(*KINDS)).alias("spans"),
                     F.when(F.greatest(*(F.size(k) for k in KINDS)) > 0, F.col("text")).alias("text"))


def _terms(text: Column) -> Column:
    """Distinct words, lower-cased."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.lower))


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """row, start, end and level (ratio PMI / IC) of terms in documents that hold an entity that they disclose."""
    total = float(found.count())
    holds = found.where(F.size("spans") > 0).select("row", F.explode(F.array_distinct(F.transform("spans", lambda s: F.struct(s["kind"], s["value"])))).alias("e")).select("row", "e.*")
    entity = holds.groupBy("kind", "value").agg(F.count("*").alias("n_e")).where(F.col("n_e").between(MIN_DOCS, int(total) - 1))
    holds = written(holds.join(entity, ["kind", "value"]), "entities")

    def most(n_e: Column) -> Column:  # rounded up
        return F.lit(total * (1 + 1e-9)) * F.pow(n_e / F.lit(max(total, 1.0)), F.lit(GENERALISE))

    largest = holds.agg(F.max("n_e")).first()[0] or 0
    held = doc_text(docs).select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    held = held.where((F.col("n_t") >= MIN_DOCS) & (F.col("n_t") <= most(F.lit(largest))))
    rows = found.where("text is not null").join(holds.groupBy("row").agg(F.max("n_e").alias("n_max")), "row")
    # of all mentions, only emails have letters
    terms = rows.select("row", "n_max", F.explode(_terms(F.regexp_replace("text", PATTERNS["email"], " "))).alias("term"))
    terms = written(terms.join(held, "term").where(F.col("n_t") <= most(F.col("n_max"))).select("row", "term", "n_t"), "terms")
    pair = terms.join(holds, "row").where(F.col("n_t") <= most(F.col("n_e"))).groupBy("kind", "value", "term", "n_t", "n_e").agg(F.count("*").alias("n_te"))
    ic, pmi = F.log2(F.lit(total) / F.col("n_e")), F.log2(F.lit(total) * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    telling = pair.where(F.col("n_te") >= MIN_DOCS).withColumn("level", pmi / ic).where(F.col("level") >= GENERALISE)
    levels = holds.select("row", "kind", "value").join(written(telling.select("kind", "value", "term", "level"), "telling"), ["kind", "value"])
    levels = levels.groupBy("row", "term").agg(F.max("level").alias("level")).join(terms.select("row", "term"), ["row", "term"])
    levels = levels.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "level"))).alias("levels"))
    texts = found.where("text is not null").join(levels, "row").withColumns({"words": F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)), "pieces": F.split("text", _WORD, -1)})
    texts = with_starts(texts, "pieces", "words", "starts")

    def one(word: Column, i: Column) -> Column:
        start = F.get("starts", i)
        return F.struct(start.alias("start"), (start + F.length(word)).alias("end"), F.try_element_at("levels", F.lower(word)).alias("level"))

    hits = F.filter(F.transform("words", one), lambda w: w["level"].isNotNull())
    out = texts.select("row", "spans", F.explode(hits).alias("w"))
    return out.where(~F.exists("spans", lambda s: (s["start"] < F.col("w.end")) & (F.col("w.start") < s["end"]))).select("row", "w.*")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_<kind>, n_term, base_sha256, spans and actions of every document row."""
    found = written(base_spans(docs), "base-spans")
    terms = disclosing_terms(docs, found).groupBy("row").agg(F.collect_list(F.struct("start", F.lit(len(KINDS)).alias("rank"), "end", F.lit("term").alias("kind"), "level")).alias("terms"))
    rows = found.join(terms, "row", "left")
    base = F.transform("spans", lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], F.lit(1.0).alias("level")))
    rows = rows.withColumn("all", F.array_sort(F.concat(base, F.coalesce("terms", F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,level:double>>")))))
    return rows.select("doc_id", *(f"n_{k}" for k in KINDS), F.coalesce(F.size("terms"), F.lit(0)).cast("long").alias("n_term"),
                       F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"),
                       F.transform("all", lambda s: F.struct(s["start"], s["end"], F.when(s["kind"] != "term", F.concat(F.lit("["), s["kind"], F.lit("]")))
                                                             .when(s["level"] >= REMOVE, "").otherwise("[term]").alias("put"))).alias("actions"))


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with entities replaced by their kind and disclosing terms removed or
    generalised; overlapping spans are cut out together.  ``doc_id`` must be unique; rows with a null id stay as they are."""
    key, new = free_name(docs, "_key"), free_name(docs, "_new")
    actions = personal_data(docs).where(F.size("actions") > 0).select(F.col("doc_id").alias("key"), F.explode("actions").alias("a")).select("key", "a.*")
    changed = cut_out(docs.select(F.col("doc_id").cast("long").alias("key"), "text"), written(actions.dropna(subset=["key"]), "actions"))
    changed = changed.select(F.col("key").alias(key), F.col("text").alias(new))
    rows = docs.join(changed, docs["doc_id"] == changed[key], "left")
    return rows.withColumn("text", F.when(F.col(key).isNull(), F.col("text")).otherwise(F.col(new))).select(docs.columns)
