"""FLT1-5: hand-worked cases (FIXTURES 3.1) and agreement with plain Python rules."""

from tessera.config import QualityParams
from tessera.operators import quality


def py_reason(text, p=QualityParams()):
    t = text or ""
    n = len(t)
    if n < p.min_chars or n > p.max_chars:
        return "length"
    if len(set(t)) / max(n, 1) < p.repetition_min:
        return "repetition"
    if sum(c.isprintable() for c in t) / max(n, 1) < p.printable_min:
        return "printable"
    return None


DISTINCT = "".join(chr(c) for c in range(0x21, 0x7F))  # 94 distinct printable ASCII

CASES = [
    (None, "length"),
    ("", "length"),
    (DISTINCT[:49], "length"),
    (DISTINCT[:50], None),
    ("ab" * 16384 + "c", "length"),  # 32,769 chars
    ("a" * 60, "repetition"),
    ((DISTINCT[:15] * 4)[:50], None),          # ratio exactly 0.3
    ((DISTINCT[:14] * 4)[:50], "repetition"),  # 0.28
    (DISTINCT[:45] + "\n" * 5, None),          # printable exactly 0.9
    (DISTINCT[:44] + "\n" * 6, "printable"),   # 0.88
    ("".join(chr(0x1F600 + i) for i in range(50)), None),  # code points, not UTF-16 units
    (DISTINCT[:44] + "\u00a0" * 3 + "\u200b" * 3, "printable"),  # no-break and zero-width space
    (DISTINCT[:44] + " " * 6, None),           # ASCII space is printable
]


def test_hand_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    got = {r.doc_id: r.quality_reason for r in quality.with_quality(df).collect()}
    for i, (t, want) in enumerate(CASES):
        assert got[i] == want, (i, want, got[i])
        assert py_reason(t) == want, i


def test_agrees_with_python_on_documents(spark):
    from conftest import SF_SMALL
    from tessera.sources.tables import table
    docs = table(spark, SF_SMALL, "documents")
    for p in (QualityParams(), QualityParams(repetition_min=0.01)):
        rows = quality.with_quality(docs, p).select("text", "quality_reason").collect()
        assert all(py_reason(r.text, p) == r.quality_reason for r in rows)


def test_text_fallback(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "b"), (3, None, None)],
                               "doc_id long, text string, content string")
    got = dict(quality.text_fallback(df, out="t").select("doc_id", "t").collect())
    assert got == {1: "a", 2: "b", 3: ""}


def test_filter_is_one_narrow_stage(spark):
    from conftest import SF_SMALL
    from tessera.sources.tables import table
    plan = quality.quality_filter(table(spark, SF_SMALL, "documents")).select("doc_id")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Exchange" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan
