"""Operator 9: toxicity of texts restored by a noisy-channel decoder.

Obfuscated tokens are found for many texts at once: letters mixed with digits or
symbols, three equal letters in a row, separators between letters, and three or more single
letters in a row.  Each spans a character lattice: a confusable character may stand
for letters, a separator may be dropped, a repeated letter may stand for one or two.
Viterbi search finds its best reading under costs of the channel and a character
trigram language model (interpolated, words apart), counted over all documents.
All other tokens have one reading, themselves.

The restored text is scored by logistic regression on the presence of words and
word beginnings (4 to 6 bytes).  Labelled rows are a bounded sample (``LABELLED`` ids
with the smallest hashes), without held-out ids (crc32 of the id as text, mod 3, is
1); features are counted on it in Spark, the strongest ``FEATURES`` that chance does not explain are kept, and
the regression is fitted on their presence alone.  The words kept also strengthen
the language model, so that doubtful letters lean toward them.  Labels, language, source and id are
no inputs of a score.

Null, empty and wordless texts get the score of a text without features.  Repeated rows
are scored each alike; an empty table gives an empty one; without labels of both
kinds every score is 0.  Other columns are read by ``filter_toxic`` only, which
keeps them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import doc_text, label_sample, text_slices

LABELLED = 12_000
FEATURES = 2_000
#: Least log-likelihood ratio statistic of a feature (chance reaches 20 once in 130,000 features).
MIN_G2 = 20.0
PREFIXES = (4, 5, 6)
CUT = 0.7
SYMBOLS = 96
MEMO = 200_000

LETTER = K.byte_table(range(128, 256)) | K.byte_table(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGIT = K.byte_table(b"0123456789")
#: Symbols read as letters, and those that only separate.
LEET = K.byte_table(b"@$!|+*")
READS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
         "!": "i", "|": "il", "+": "t", "*": "aeiou"}
SUBSTITUTE, DROP, BREAK, KEEP, SHORTEN = 1.0, 1.0, 3.0, 6.0, 0.7

_CODE = np.zeros(256, np.int64)
_CODE[97:123] = np.arange(1, 27)
_CODE[128:] = 27 + (np.arange(128) & 63)


# ------------------------------------------------------------ language model
def trigrams(column: pa.Array) -> np.ndarray:
    """Trigram numbers of all words; a word is preceded by two border symbols and followed by one."""
    buf, off = K.utf8(column)
    code = _CODE[K.LOWER[buf]]
    start, end, _ = K.runs(code > 0, off)
    if not len(start):
        return np.zeros(0, np.int64)
    one = np.concatenate([[0], code[:-1]])
    two = np.concatenate([[0, 0], code[:-2]])[:len(code)]
    one[start] = two[start] = 0
    second = start[end - start > 1] + 1
    two[second] = 0
    inside = np.flatnonzero(code)
    last = np.where(end - start > 1, code[np.maximum(end - 2, 0)], 0)
    return np.concatenate([((two * SYMBOLS + one) * SYMBOLS + code)[inside], (last * SYMBOLS + code[end - 1]) * SYMBOLS])


def _count_trigrams(batches):
    total = np.zeros(SYMBOLS ** 3, np.int64)
    for batch in batches:
        for part in text_slices(batch):
            total += np.bincount(trigrams(part.column("text")), minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["gram", "n"])


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts over all documents (at most ``SYMBOLS`` ** 3 rows reach the driver)."""
    rows = doc_text(docs).select("text").mapInArrow(_count_trigrams, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(SYMBOLS ** 3, np.float64)
    total[rows.gram.to_numpy(np.int64)] = rows.n
    return total


def costs(counts: np.ndarray, words: list[str] = ()) -> np.ndarray:
    """-log p(c | a, b), trigrams interpolated with bigrams and unigrams; ``words`` add a thousandth of all counts each."""
    c = counts.reshape((SYMBOLS,) * 3).copy()
    extra = max(1.0, c.sum() / 1000)
    for w in words:
        for g in trigrams(pa.array([w])).tolist()[:len(w.encode()) + (not w.endswith("*"))]:
            c[g // SYMBOLS ** 2, g // SYMBOLS % SYMBOLS, g % SYMBOLS] += extra
    p = (c.sum(axis=(0, 1)) + 0.5) / (c.sum() + 0.5 * SYMBOLS)
    for table in (c.sum(axis=0), c):
        n, kinds = table.sum(axis=-1, keepdims=True), (table > 0).sum(axis=-1, keepdims=True)
        p = (table + (kinds + 1) * p) / (n + kinds + 1)
    return -np.log(p).astype(np.float32)


# ------------------------------------------------------------------- decoder
class Decoder:
    """Best reading of a token under the channel and the language model."""

    def __init__(self, cost: np.ndarray):
        self.cost = cost.reshape(-1).tolist()
        self.memo: dict[bytes, bytes] = {}

    def lattice(self, token: bytes) -> list[list[tuple[bytes, float]]]:
        out, i, t = [], 0, token.lower()
        while i < len(t):
            c = t[i]
            if _CODE[c]:
                j = i
                while j < len(t) and t[j] == c:
                    j += 1
                run, one = t[i:j], t[i:i + 1]
                if len(run) == 1 or c >= 128:
                    out.append([(run, 0.0)])
                elif len(run) == 2:
                    out.append([(run, 0.0), (one, SHORTEN * 3)])
                else:
                    out.append([(one, SHORTEN), (one * 2, SHORTEN)])
                i = j
                continue
            reads = [(x.encode(), SUBSTITUTE) for x in READS.get(chr(c), "")]
            if not DIGIT[c]:
                reads += [(b"", DROP if c != 32 else 0.1), (b" ", BREAK if c != 32 else 0.1)]
            else:
                reads.append((b" ", KEEP))
            out.append(reads)
            i += 1
        return out

    def decode(self, token: bytes) -> bytes:
        found = self.memo.get(token)
        if found is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            found = self.memo[token] = self._viterbi(token)
        return found

    def _viterbi(self, token: bytes) -> bytes:
        best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}  # readings as linked tuples
        cost, n = self.cost, SYMBOLS
        for reads in self.lattice(token):
            nxt: dict = {}
            for (a, b), (total, path) in best.items():
                for text, price in reads:
                    x, y, s = a, b, total + price
                    for ch in text:
                        z = int(_CODE[ch])
                        if z:
                            s += cost[(x * n + y) * n + z]
                            x, y = y, z
                        elif y:
                            s += cost[(x * n + y) * n]
                            x = y = 0
                    old = nxt.get((x, y))
                    if old is None or s < old[0]:
                        nxt[x, y] = (s, (path, text))
            best = nxt
        total, path = min(((s + (cost[(a * n + b) * n] if b else 0.0), p) for (a, b), (s, p) in best.items()), key=lambda v: v[0])
        parts = []
        while path:
            path, text = path
            parts.append(text)
        return b"".join(reversed(parts))


def suspicious(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that may be obfuscated words."""
    start, end, borders = K.runs(K.NON_SPACE[buf], off)
    if not len(start):
        return start, end
    letter, digit = LETTER[buf], DIGIT[buf]
    solid = letter | digit
    ws, we, _ = K.runs(solid, off)
    first, last = np.searchsorted(ws, start), np.searchsorted(ws, end)  # runs of letters and digits in each token
    runs = last - first

    def total(flag: np.ndarray) -> np.ndarray:
        t = np.zeros(len(flag) + 1, np.int32)
        np.cumsum(flag, out=t[1:])
        return t[end] - t[start]

    def shift(flag: np.ndarray, k: int) -> np.ndarray:
        return np.concatenate([flag[k:], np.zeros(min(k, len(flag)), flag.dtype)])

    letters, digits = total(letter), total(digit)
    low = K.LOWER[buf]
    same = (low == shift(low, 1)) & (low == shift(low, 2)) & letter & (buf < 128)
    leet = LEET[buf] & shift(letter, 1)
    has = runs > 0
    tail = np.zeros(len(start), np.int64)
    tail[has] = end[has] - we[last[has] - 1]
    odd_tail = has & (tail > 0) & (tail < 3) & K.byte_table(b"@$+")[buf[np.minimum(end - np.maximum(tail, 1), len(buf) - 1)]]
    spread = (runs > 2) & (letters + digits <= 2 * runs)
    odd = (letters > 1) & ((digits > 0) | (total(same) > 0) | (total(leet) > 0) | odd_tail | spread)
    # three or more single letters in a row
    single = (letters == 1) & (digits == 0) & (end - start <= 2) | (digits == 1) & (letters == 0) & (end - start == 1)
    a, b, _ = K.runs(single, borders)
    long = b - a > 2
    a, b = a[long], b[long]
    inside = np.zeros(len(start) + 1, np.int64)
    np.add.at(inside, a, 1)
    np.add.at(inside, b, -1)
    odd &= np.cumsum(inside)[:-1] == 0
    s, e = np.concatenate([start[odd], start[a]]), np.concatenate([end[odd], end[b - 1]])
    order = np.argsort(s)
    return s[order], e[order]


def restored(column: pa.Array, decoder: Decoder) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts with obfuscated stretches read."""
    buf, off = K.utf8(column)
    start, end = suspicious(buf, off)
    if not len(start):
        return buf, off
    raw, out, at = buf.tobytes(), [], 0
    grown = np.zeros(len(start) + 1, np.int64)
    for i, (a, b) in enumerate(zip(start.tolist(), end.tolist())):
        text = decoder.decode(raw[a:b])
        out += (raw[at:a], text)
        at = b
        grown[i + 1] = grown[i] + len(text) - (b - a)
    out.append(raw[at:])
    return np.frombuffer(b"".join(out), np.uint8), off + grown[np.searchsorted(start, off)]


# ------------------------------------------------------------------ features
def features(buf: np.ndarray, off: np.ndarray):
    """Hash, text, start and end of each word and word beginning."""
    low = K.LOWER[buf]
    start, end, borders = K.runs(LETTER[low], off)
    text = K.owner(borders)
    prefix = K.Prefix(low)
    out = [(prefix.hash(start, end), text, start, end)]
    for k in PREFIXES:
        long = end - start > k
        s = start[long]
        out.append((K.mix(prefix.hash(s, s + k) + np.uint64(1)), text[long], s, s + k))
    return [np.concatenate(x) for x in zip(*out)], low, len(start)


def _presence(h: np.ndarray, text: np.ndarray):
    """Distinct (feature, text): places of one example each, ordered by feature."""
    order = np.lexsort((text, h))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(h[order]) != 0) | (np.diff(text[order]) != 0)
    return order[new]


class Model:
    def __init__(self, names: list[str], weights: np.ndarray, bias: float, cost: np.ndarray):
        self.cost, self.bias = cost, bias
        h = _name_hashes(names)
        order = np.argsort(h)
        self.keys, self.weights = h[order], np.asarray(weights, np.float64)[order]
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[(h >> np.uint64(48)).astype(np.int64)] = True
        self.decoder = None

    def active(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature) pairs, each once."""
        self.decoder = self.decoder or Decoder(self.cost)
        (h, text, _, _), _, _ = features(*restored(column, self.decoder))
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.sieve[(h >> np.uint64(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == h[maybe]
        pair = np.unique(text[maybe][hit] * len(self.keys) + at[hit])
        return pair // len(self.keys), pair % len(self.keys)

    def scores(self, column: pa.Array) -> np.ndarray:
        text, at = self.active(column)
        z = np.bincount(text, weights=self.weights[at], minlength=len(column)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _name_hashes(names: list[str]) -> np.ndarray:
    """Hashes of feature names as ``features`` gives them; a beginning ends in ``*``."""
    out = np.zeros(len(names), np.uint64)
    for i, name in enumerate(names):
        b = np.frombuffer(name.rstrip("*").encode("latin-1"), np.uint8)
        h = K.Prefix(b).hash(np.array([0]), np.array([len(b)]))
        out[i] = (K.mix(h + np.uint64(1)) if name.endswith("*") else h)[0]
    return out


def _count_features(cost: np.ndarray):
    def run(batches):
        decoder = Decoder(cost)
        for batch in batches:
            for part in text_slices(batch):
                (h, text, start, end), low, n_words = features(*restored(part.column("text"), decoder))
                label = part.column("label").to_numpy()
                at = _presence(h, text)
                first = np.flatnonzero(np.diff(h[at], prepend=~h[at][:1]) != 0)
                toxic = np.add.reduceat(label[text[at]] == 1, first, dtype=np.int64) if len(first) else first
                n = np.diff(np.append(first, len(at)))
                raw, at = low.tobytes(), at[first]
                names = [raw[a:b].decode("latin-1") + "*" * (i >= n_words) for i, a, b in zip(at.tolist(), start[at].tolist(), end[at].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(toxic, pa.int64()), pa.array(n - toxic, pa.int64())], names=["name", "toxic", "clean"])
    return run


def _regression(text: np.ndarray, at: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, float]:
    """Logistic regression on feature presence (pairs text, at), classes of equal weight, by gradient steps with a
    quadratic penalty."""
    w, bias, n = np.zeros(k), 0.0, max(1, len(y))
    each = np.where(y == 1, (1 - y).sum() / max(1.0, y.sum()), 1.0)  # the rarer class counts as much as the other
    seen = np.maximum(np.bincount(at, weights=each[text], minlength=k), 1)
    for _ in range(1000):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(text, weights=w[at], minlength=n) + bias, -500, 500)))
        g = each * (y - p)
        w += (np.bincount(at, weights=g[text], minlength=k) - 0.02 * w) / (seen + 4)
        bias += 2 * g.sum() / each.sum()
    return w, float(bias)


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, held_out: bool = True) -> Model:
    """A model from the bounded sample of labelled rows (``held_out``: without held-out ids)."""
    spark = docs.sparkSession
    counts = trigram_counts(docs)
    sample = label_sample(labels, "toxic", labelled, held_out)
    train = doc_text(docs).join(F.broadcast(sample), "doc_id").select("text", "label")
    rows = train.mapInArrow(_count_features(costs(counts)), "name string, toxic long, clean long").groupBy("name").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    size = train.agg(F.count("*"), F.coalesce(F.sum((F.col("label") == 1).cast("long")), F.lit(0))).first()
    bad, good = size[1], size[0] - size[1]
    if not bad or not good:
        return Model([], np.zeros(0), -1000.0, costs(counts))
    odds = F.log((F.col("toxic") + 0.5) / (bad + 1.0)) - F.log((F.col("clean") + 0.5) / (good + 1.0))
    n, share = F.col("toxic") + F.col("clean"), bad / (bad + good)
    part = lambda c, p: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) / (n * p))).otherwise(0.0)
    g2 = 2 * (part("toxic", share) + part("clean", 1 - share))
    kept = rows.withColumn("odds", odds).where("odds > 2").withColumn("rank", g2).where(F.col("rank") >= MIN_G2)
    names = [r["name"] for r in kept.orderBy(F.desc("rank"), "name").limit(FEATURES).collect()]
    words = [w.encode("latin-1").decode("utf-8", "ignore") for w in names]
    cost = costs(counts, words[:200])
    blank = Model(names, np.zeros(len(names)), 0.0, cost)
    shared = spark.sparkContext.broadcast(blank)

    def active(batches):
        for batch in batches:
            for part in text_slices(batch):
                text, at = shared.value.active(part.column("text"))
                lists = np.split(at, np.searchsorted(text, np.arange(1, part.num_rows)))
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.array([x.tolist() for x in lists], pa.list_(pa.int32()))], names=["label", "at"])

    found = train.mapInArrow(active, "label int, at array<int>").toPandas()  # bounded by ``labelled``
    at = np.concatenate([*found["at"], np.zeros(0)]).astype(np.int64)
    text = np.repeat(np.arange(len(found)), found["at"].map(len))
    weights, bias = _regression(text, at, found.label.to_numpy(np.float64), len(names))
    model = Model(names, np.zeros(len(names)), bias, cost)
    model.weights = weights  # in the order of ``keys``, as ``active`` numbers them
    return model


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(shared.value.scores(part.column("text")))], names=["doc_id", "score"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return doc_text(docs).mapInArrow(run, "doc_id long, score double").select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def filter_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, that are not predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                yield part.filter(pa.array(shared.value.scores(part.column("text")) < CUT))

    return docs.mapInArrow(run, docs.schema)
