"""SQL text of the independent checks (DuckDB dialect), built from shared CTEs.

These strings are the correctness oracle: the same computation written
declaratively for another engine.  Fixed patterns are the DuckDB (RE2) forms
of the Spark (Java) patterns in ``functions.text``.
"""

from __future__ import annotations

from ..config import DEFAULT_IDS, MAX_LENGTH, PLAN_QUALITY, SEED, QualityParams
from ..operators.dedup import ORDER_SHIFT

SHIFT = 1 << ORDER_SHIFT
# RE2 forms of the printable and word-split patterns.
NON_PRINTABLE_RE2 = r"[\p{C}\p{Zl}\p{Zp}]|[^\P{Zs} ]"
WORD_SPLIT_RE2 = r"[ \t\n\r\f]+"
DEFAULT_Q = QualityParams()


def length_sql(t: str) -> str:
    return f"length(coalesce({t}, ''))"


def rep_sql(t: str) -> str:
    return f"(len(list_distinct(string_split(coalesce({t}, ''), ''))) / greatest({length_sql(t)}, 1))"


def printable_sql(t: str) -> str:
    return (f"(length(regexp_replace(coalesce({t}, ''), '{NON_PRINTABLE_RE2}', '', 'g')) "
            f"/ greatest({length_sql(t)}, 1))")


def reason_sql(t: str, q: QualityParams = DEFAULT_Q) -> str:
    upper = "" if q.max_chars is None else f" AND {length_sql(t)} <= {q.max_chars}"
    return (f"CASE WHEN NOT ({length_sql(t)} >= {q.min_chars}{upper}) THEN 'length' "
            f"WHEN {rep_sql(t)} < {q.repetition_min} THEN 'repetition' "
            f"WHEN {printable_sql(t)} < {q.printable_min} THEN 'printable' END")


def words_sql(t: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({t}, ''), '{WORD_SPLIT_RE2}'), lambda w: w <> '')"


def ranked_cte(docs: str = "documents") -> str:
    """reg, ranked: registry rank by lang and source name; packed order key."""
    return f"""reg AS (
  SELECT lang, source, CAST(row_number() OVER (ORDER BY lang NULLS FIRST, source NULLS FIRST) - 1 AS INTEGER) AS source_rank
  FROM (SELECT DISTINCT lang, source FROM {docs})
),
ranked AS (
  SELECT d.doc_id, d.text, d.lang, d.source, r.source_rank,
         CAST(r.source_rank AS BIGINT) * {SHIFT} + d.doc_id AS ord
  FROM {docs} d JOIN reg r ON d.lang IS NOT DISTINCT FROM r.lang AND d.source IS NOT DISTINCT FROM r.source
)"""


def key_sql(t: str, prefix: int | None) -> str:
    return f"sha256({t})" if prefix is None else f"sha256(substr({t}, 1, {prefix}))"


def prepared_ctes(q: QualityParams = PLAN_QUALITY, prefix: int | None = None,
                  cap: int | None = None, seed: int = SEED, docs: str = "documents") -> str:
    """... -> prepared(doc_id, lang, source, text, split, shuffle_rank, lang_rank)."""
    cap_where = "" if not cap else f"WHERE lang_rank < {cap}"
    return f"""{ranked_cte(docs)},
filtered AS (
  SELECT * FROM ranked WHERE ({reason_sql('text', q)}) IS NULL
),
winners AS (
  SELECT lang, min(ord) AS ord FROM filtered GROUP BY lang, {key_sql('text', prefix)}
),
capped AS (
  SELECT * FROM (
    SELECT lang, ord, row_number() OVER (PARTITION BY lang ORDER BY ord) - 1 AS lang_rank FROM winners
  ) {cap_where}
),
shuf AS (
  SELECT *, row_number() OVER (ORDER BY md5('{seed}:' || CAST(ord AS VARCHAR)), ord) - 1 AS shuffle_rank,
         count(*) OVER () AS _n
  FROM capped
),
decided AS (
  SELECT ord, lang_rank, shuffle_rank,
         CASE WHEN shuffle_rank < ((_n + 99) // 100 + 1) // 2 THEN 'test'
              WHEN shuffle_rank < (_n + 99) // 100 THEN 'validation' ELSE 'train' END AS split
  FROM shuf
),
prepared AS (
  SELECT f.doc_id, f.lang, f.source, f.text, d.split, d.shuffle_rank, d.lang_rank
  FROM filtered f JOIN decided d ON f.ord = d.ord
)"""


def vocab_ctes(first_id: int = DEFAULT_IDS.first_word_id) -> str:
    """vocab(word, n, token_id) over ``prepared``."""
    return f"""vocab AS (
  SELECT word, n, CAST(row_number() OVER (ORDER BY n DESC, word) - 1 + {first_id} AS INTEGER) AS token_id
  FROM (SELECT word, count(*) AS n FROM (SELECT unnest({words_sql('text')}) AS word FROM prepared) GROUP BY word)
)"""


def encoded_ctes(max_length: int | None = None, unk: int = DEFAULT_IDS.unk) -> str:
    """encoded(doc_id, lang, source, split, shuffle_rank, input_ids, n_tokens)."""
    return f"""ws AS (
  SELECT doc_id, {words_sql('text')}{f"[1:{max_length}]" if max_length else ""} AS w FROM prepared
),
toks AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM ws
),
enc AS (
  SELECT t.doc_id, list(coalesce(v.token_id, {unk}) ORDER BY t.pos) AS input_ids
  FROM toks t LEFT JOIN vocab v ON t.word = v.word GROUP BY t.doc_id
),
encoded AS (
  SELECT p.doc_id, p.lang, p.source, p.split, p.shuffle_rank,
         CAST(coalesce(e.input_ids, []) AS INTEGER[]) AS input_ids,
         CAST(len(coalesce(e.input_ids, [])) AS BIGINT) AS n_tokens
  FROM prepared p LEFT JOIN enc e ON p.doc_id = e.doc_id
)"""


def with_encoded(max_length: int | None = None, recursive: bool = False, **kw) -> str:
    head = "WITH RECURSIVE" if recursive else "WITH"
    return f"{head} {prepared_ctes(**kw)},\n{vocab_ctes()},\n{encoded_ctes(max_length)}\n"


def greedy_walk_ctes(M: int = MAX_LENGTH, eos: int = DEFAULT_IDS.eos) -> str:
    """walk(split, shuffle_rank, n, start, chunk_id, take): the greedy packer as a recursive walk per split."""
    return f"""segs AS (
  SELECT split, shuffle_rank, n_tokens + 1 AS n,
         row_number() OVER (PARTITION BY split ORDER BY shuffle_rank) AS rn FROM encoded
),
walk AS (
  SELECT split, rn, shuffle_rank, n, CAST(0 AS BIGINT) AS start, CAST(0 AS BIGINT) AS chunk_id,
         CAST(CASE WHEN n >= {M} THEN 0 ELSE n END AS BIGINT) AS cur,
         CAST(CASE WHEN n >= {M} THEN 1 ELSE 0 END AS BIGINT) AS flushes,
         CAST(least(n, {M}) AS BIGINT) AS take
  FROM segs WHERE rn = 1
  UNION ALL
  SELECT s.split, s.rn, s.shuffle_rank, s.n, w.cur, w.flushes,
         CASE WHEN w.cur + s.n >= {M} THEN 0 ELSE w.cur + s.n END,
         w.flushes + CASE WHEN w.cur + s.n >= {M} THEN 1 ELSE 0 END,
         CASE WHEN w.cur + s.n >= {M} THEN {M} - w.cur ELSE s.n END
  FROM walk w JOIN segs s ON s.split = w.split AND s.rn = w.rn + 1
),
greedy AS (
  SELECT w.split, w.chunk_id, flatten(list(list_concat(e.input_ids, [{eos}])[1:w.take] ORDER BY w.start)) AS ids
  FROM walk w JOIN encoded e ON e.split = w.split AND e.shuffle_rank = w.shuffle_rank
  GROUP BY w.split, w.chunk_id
),
chunks AS (
  SELECT split, chunk_id, CAST(list_resize(ids, {M}, {DEFAULT_IDS.pad_id}) AS INTEGER[]) AS input_ids FROM greedy
)"""


def generator_ctes(src: str, a: str) -> str:
    """{a}_two, {a}_one, {a}_top: best next words of the word triples of ``src`` (text)."""
    return f"""{a}_t AS (
  SELECT CASE WHEN i < 3 THEN '<s>' ELSE w[i - 2] END AS u, CASE WHEN i < 2 THEN '<s>' ELSE w[i - 1] END AS v,
         CASE WHEN i > len(w) THEN '</s>' ELSE w[i] END AS w
  FROM (SELECT w, unnest(range(1, len(w) + 2)) AS i FROM (SELECT {words_sql('text')} AS w FROM {src}))
),
{a}_two AS (SELECT u, v, w AS next FROM (
  SELECT u, v, w, row_number() OVER (PARTITION BY u, v ORDER BY count(*) DESC, w) AS rn FROM {a}_t GROUP BY u, v, w) WHERE rn = 1),
{a}_one AS (SELECT v, w AS next FROM (
  SELECT v, w, row_number() OVER (PARTITION BY v ORDER BY count(*) DESC, w) AS rn FROM {a}_t GROUP BY v, w) WHERE rn = 1),
{a}_top AS (SELECT w AS next FROM {a}_t WHERE w <> '</s>' GROUP BY w ORDER BY count(*) DESC, w LIMIT 1)"""


def generate_ctes(prompts: str, key: str, a: str, max_new: int) -> str:
    """{a}_gen({key}, out, done, step): the greedy continuation of each prompt, word by word."""
    word = f"coalesce(t.next, o.next, (SELECT next FROM {a}_top), '</s>')"
    return f"""{a}_gen AS (
  SELECT {key}, coalesce(w[len(w) - 1], '<s>') AS u, coalesce(w[len(w)], '<s>') AS v, CAST([] AS VARCHAR[]) AS out, false AS done, 0 AS step
  FROM (SELECT {key}, {words_sql('prompt')} AS w FROM {prompts})
  UNION ALL
  SELECT g.{key}, g.v, {word}, CASE WHEN {word} = '</s>' THEN g.out ELSE list_append(g.out, {word}) END, {word} = '</s>', g.step + 1
  FROM {a}_gen g LEFT JOIN {a}_two t ON g.u = t.u AND g.v = t.v LEFT JOIN {a}_one o ON g.v = o.v
  WHERE NOT g.done AND g.step < {max_new}
)"""


def triples_sql(src: str, alias: str, extra: str = "") -> str:
    """{alias}({extra}, u, v, w): each word of ``src`` with the two before it."""
    return f"""{alias} AS (
  SELECT {extra} CASE WHEN i < 3 THEN '<s>' ELSE w[i - 2] END AS u, CASE WHEN i < 2 THEN '<s>' ELSE w[i - 1] END AS v, w[i] AS w
  FROM (SELECT {extra} w, generate_subscripts(w, 1) AS i FROM (SELECT {extra} {words_sql('text')} AS w FROM {src}))
)"""


def kneser_ney_ctes(src: str) -> str:
    """p3, p2, p1, g3, g2, z: probabilities, back-off weights and constants of interpolated Kneser-Ney."""
    def discount(t: str, c: str) -> str:
        return (f"(SELECT CASE WHEN count(*) FILTER (WHERE {c} = 1) > 0 THEN count(*) FILTER (WHERE {c} = 1) / "
                f"(count(*) FILTER (WHERE {c} = 1) + 2 * count(*) FILTER (WHERE {c} = 2)) ELSE 0.5 END FROM {t})")

    return f"""{triples_sql(src, 'kt')},
k3 AS (SELECT u, v, w, count(*) AS c FROM kt GROUP BY u, v, w),
k2 AS (SELECT v, w, count(*) AS n FROM k3 GROUP BY v, w),
k1 AS (SELECT w, count(*) AS n FROM k2 GROUP BY w),
z AS (SELECT CAST({discount('k3', 'c')} AS DOUBLE) AS d3, CAST({discount('k2', 'n')} AS DOUBLE) AS d2, CAST({discount('k1', 'n')} AS DOUBLE) AS d1,
             CAST((SELECT sum(n) FROM k1) AS DOUBLE) AS n, (SELECT count(*) FROM k1) AS types),
p1 AS (SELECT w, greatest(k1.n - d1, 0) / z.n + d1 * types / z.n / (types + 1) AS p FROM k1, z),
s2 AS (SELECT v, CAST(sum(n) AS DOUBLE) AS s, count(*) AS t FROM k2 GROUP BY v),
g2 AS (SELECT v, d2 * t / s AS g FROM s2, z),
p2 AS (SELECT k2.v, k2.w, greatest(k2.n - d2, 0) / s2.s + d2 * s2.t / s2.s * p1.p AS p FROM k2 JOIN s2 ON k2.v = s2.v JOIN p1 ON k2.w = p1.w, z),
s3 AS (SELECT u, v, CAST(sum(c) AS DOUBLE) AS s, count(*) AS t FROM k3 GROUP BY u, v),
g3 AS (SELECT u, v, d3 * t / s AS g FROM s3, z),
p3 AS (SELECT k3.u, k3.v, k3.w, greatest(k3.c - d3, 0) / s3.s + d3 * s3.t / s3.s * p2.p AS p
       FROM k3 JOIN s3 ON k3.u = s3.u AND k3.v = s3.v JOIN p2 ON k3.v = p2.v AND k3.w = p2.w, z)"""
