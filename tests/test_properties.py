"""Property tests: Spark quality rules vs plain Python on generated text; split/shuffle invariants."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.config import QualityParams
from tessera.operators import ordinal, quality
from test_quality import py_reason

# Characters whose printability agrees between Java's and Python's Unicode tables
# (ASCII, Latin-1, Greek, CJK, emoji outside the BMP, and the usual invisible ones).
ALPHABET = st.sampled_from(
    [chr(c) for c in range(0x20, 0x7F)] + [chr(c) for c in range(0xC0, 0x100)] + [chr(c) for c in range(0x3B1, 0x3CA)]
    + ["\u4e2d", "\u6587", "\u5b57", "\U0001F600", "\U0001F680", "\n", "\t", "\r", " ", "\u00a0", "\u200b", "\u2028", "\x00", "\x7f"])
TEXTS = st.lists(st.text(alphabet=ALPHABET, min_size=0, max_size=120), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=TEXTS, rep=st.sampled_from([0.01, 0.3, 0.6]), pr=st.sampled_from([0.5, 0.9, 1.0]))
def test_quality_rules_match_python(spark, texts, rep, pr):
    p = QualityParams(min_chars=5, max_length=25, repetition_min=rep, printable_min=pr)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.quality_reason for r in quality.with_quality(df, p).collect()}
    assert got == {i: py_reason(t, p) for i, t in enumerate(texts)}
    kept = {r.doc_id for r in quality.quality_filter(df, p).collect()}
    assert kept == {i for i, t in enumerate(texts) if py_reason(t, p) is None}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(min_value=1, max_value=400), parts=st.integers(min_value=1, max_value=9))
def test_split_sizes_exact_and_disjoint(spark, n, parts):
    df = spark.range(n).withColumnRenamed("id", "doc_id").repartition(parts)
    rows = ordinal.three_way_split(df).collect()
    sizes = {s: sum(1 for r in rows if r.split == s) for s in ("train", "validation", "test")}
    assert (sizes["train"], sizes["validation"], sizes["test"]) == ordinal.split_sizes(n)
    assert sorted(r.shuffle_rank for r in rows) == list(range(n)) and len({r.doc_id for r in rows}) == n
