"""Toxicity: a support vector machine on a gap-weighted subsequence kernel, with Nystroem landmarks.

The kernel of two words is the sum over common subsequences of ORDER letters, within SPAN letters, of DECAY for each gap
in either word, normed by length. So an insult with letters put between its own, or with other endings, stays near
it. Letters are folded (accents, digits that look like letters), punctuation inside a word goes, and letters that stand alone in
a row are one word.

Labels mark documents, so training finds the words that mark them: those with a piece that many toxic documents have and (almost) no clean
one. The machine learns those against all words of clean sentences, in the space of the landmarks. As the kernel is a dot product over subsequences, landmarks and weights
collapse to one weight for each subsequence: scoring a text is a few table lookups for each letter. A document
scores by its most toxic words and its length, through a logistic curve fitted to training documents that the machine had not seen.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import give_back, packed, prepare, table

ORDER, SPAN, DECAY, LANDMARKS, PENALTY = 4, 7, 0.6, 256, 10.0
#: Letters of the pieces that mark words, the chance of one that marks none, and the share of clean documents that may have one, in that of toxic ones.
GRAM, CHANCE, RARER = 5, 0.05, 0.005
#: Folds that the curve is fitted on, and clean words that a fit starts with (twice that many at most).
FOLDS, WORKING = 3, 2000
#: Bounds of the training sample: labelled documents, and characters in them.
TRAIN_ROWS, TRAIN_CHARS = 4000, 16_000_000
LETTERS = 32
_DROPPED = 255


def _classes() -> np.ndarray:
    """Code point (below 65536) to class: 0 white space, 1-26 letters, 27 other digits, 28-31 other letters, 255 dropped."""
    out = np.full(65536, _DROPPED, np.uint8)
    like = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "ß": "s", "ø": "o", "æ": "a", "œ": "o"}
    for k in range(65536):
        if 0xD800 <= k < 0xE000:
            continue
        c = like.get(chr(k).lower(), unicodedata.normalize("NFKD", chr(k).lower())[:1])
        if "a" <= c <= "z" and len(c) == 1:
            out[k] = ord(c) - 96
        elif chr(k).isspace():
            out[k] = 0
        elif c.isdigit():
            out[k] = 27
        elif c.isalpha():
            out[k] = 28 + k % 4
    return out


_TABLE: list[np.ndarray] = []


def encode(text: str) -> np.ndarray:
    """The text's letters as classes, words apart by single zeros, a zero at the end; letters that stand alone in a row are joined."""
    if not _TABLE:
        _TABLE.append(_classes())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    x = np.where(points < 65536, _TABLE[0][np.minimum(points, 65535)], 28 + points % 4).astype(np.uint8)
    x = np.append(x[x != _DROPPED], 0).astype(np.uint8)
    x = x[(x != 0) | (np.append(1, x[:-1]) != 0)]  # single zeros
    x = x[1:] if len(x) and x[0] == 0 else x
    zeros = np.flatnonzero(x == 0)
    if len(zeros) > 2:
        alone = np.diff(zeros, prepend=-1) == 2
        x = np.delete(x, zeros[:-1][alone[:-1] & alone[1:]])
    return x


def norm_of(n: np.ndarray, span: int = SPAN, decay: float = DECAY) -> np.ndarray:
    """Square root of the self-kernel of n different letters."""
    total = sum(np.maximum(n - s + 1, 0) * comb(s - 2, ORDER - 2) * decay ** (2 * (s - ORDER)) for s in range(ORDER, span + 1))
    return np.sqrt(np.maximum(total, 1e-12))


def subsequences(x: np.ndarray, span: int = SPAN) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each width: (gaps, start positions' codes of subsequences, whether they stay inside a word)."""
    word = np.cumsum(x == 0, dtype=np.int32)
    c = np.concatenate([x, np.zeros(span, np.uint8)]).astype(np.int32)
    word = np.concatenate([word, np.full(span, -1, np.int32)])
    n = len(x)
    for width in range(ORDER - 1, span):
        inside = (word[:n] == word[width : n + width]) & (x != 0)
        for mid in combinations(range(1, width), ORDER - 2):
            code = c[:n]
            for k in (*mid, width):
                code = code * LETTERS + c[k : n + k]
            yield width - ORDER + 1, code, inside


def features(words: list[bytes], decay: float = DECAY) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each word: subsequence codes and their normed values."""
    x = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
    of = np.cumsum(x == 0) - (x == 0)
    codes, values, owner = [], [], []
    for gaps, code, inside in subsequences(x):
        at = np.flatnonzero(inside)
        codes.append(code[at])
        values.append(np.full(len(at), decay**gaps))
        owner.append(of[at])
    code, value, own = np.concatenate(codes), np.concatenate(values), np.concatenate(owner)
    order = np.argsort(own, kind="stable")
    cut = np.cumsum(np.bincount(own, minlength=len(words)))[:-1]
    norm = norm_of(np.array([len(w) for w in words]))
    return [(c, v / n) for c, v, n in zip(np.split(code[order], cut), np.split(value[order], cut), norm, strict=True)]


def kernel(a: list, b: list) -> np.ndarray:
    """Kernel matrix of two lists of features, through one dense row at a time."""
    out, dense = np.zeros((len(b), len(a))), np.zeros(LETTERS**ORDER)
    codes, values = np.concatenate([c for c, _ in a]), np.concatenate([v for _, v in a])
    met = np.zeros(LETTERS**ORDER, bool)
    for c, _ in b:
        met[c] = True
    on = met[codes]  # the rest adds nothing
    sizes = np.bincount(np.repeat(np.arange(len(a)), [len(c) for c, _ in a])[on], minlength=len(a))
    codes, values = codes[on], values[on]
    starts = np.cumsum(sizes) - sizes
    some = sizes > 0
    for k, (c, v) in enumerate(b):
        np.add.at(dense, c, v)
        if some.any():
            out[k, some] = np.add.reduceat(dense[codes] * values, starts[some])
        dense[c] = 0
    return out.T


TOP = 3


class Model:
    """weights: of each subsequence; bias; curve: weights of a text's TOP highest margins of different words, of the logarithm of its words, and an offset."""

    def __init__(self, weights: np.ndarray, bias: float, curve: np.ndarray):
        self.weights, self.bias, self.curve = weights, bias, np.asarray(curve, float)

    def traits(self, texts: list[str]) -> np.ndarray:
        """What the curve reads, a row for each text; texts without words have the margins of an empty word."""
        parts = [encode(t) for t in texts]
        parts = [p if len(p) else np.zeros(1, np.uint8) for p in parts]
        score, zeros = self._words(np.concatenate(parts))
        ends = np.searchsorted(zeros, np.cumsum([len(p) for p in parts]) - 1, side="right")
        return np.array([self.trait(score[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)])

    def trait(self, margins: np.ndarray) -> np.ndarray:
        """Equal margins are those of one word."""
        top = np.unique(np.round(margins, 3))[::-1][:TOP]
        return np.concatenate([top, np.full(TOP - len(top), self.bias), [np.log1p(len(margins)), 1.0]])

    def word_margins(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0)
        x = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        return self._words(x)[0]

    def _words(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margin and end of each word of encoded text."""
        total = np.zeros(len(x), np.float32)
        for gaps, code, inside in subsequences(x):
            total += self.weights[code] * (inside * np.float32(DECAY**gaps))
        zeros = np.flatnonzero(x == 0)
        starts = np.concatenate([[0], zeros[:-1] + 1])
        return np.add.reduceat(total, starts) / norm_of(zeros - starts) + self.bias, zeros

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.traits(texts) @ self.curve, -40, 40)))


def grams(words: list[bytes], size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(word number, code) of the pieces of ``size`` letters of each word, its beginning and end counted as letters."""
    x = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8).astype(np.int64)
    of = np.cumsum(x == 0) - 1
    n = len(x) - size + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code, inner = np.zeros(n, np.int64), np.zeros(n, bool)
    for k in range(size):
        code = code * LETTERS + x[k : n + k]
        inner |= (x[k : n + k] == 0) & (0 < k < size - 1)
    at = np.flatnonzero(~inner)
    return of[at], code[at]


def _marking_words(toxic: np.ndarray, doc: np.ndarray, word: np.ndarray, words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Words that mark toxic documents, by falling frequency there, and clean documents' other words by falling frequency; (doc, word) are the distinct pairs that occur.

    A word marks if it holds a piece that is in so many toxic documents, and in (almost) no clean one, that chance would not bring about one
    such piece among all (CHANCE). Near copies are one witness.
    """
    number = np.cumsum(toxic) - 1
    own = families(number[doc[toxic[doc]]], word[toxic[doc]], int(toxic.sum()))
    witness, clean = toxic.copy(), ~toxic
    witness[np.flatnonzero(toxic)[own != np.arange(len(own))]] = False
    n_toxic, n_clean = int(witness.sum()), int(clean.sum())
    of, code = grams(words)
    kinds, code = np.unique(code, return_inverse=True)
    order = np.argsort(of, kind="stable")
    of, code = of[order], code[order]
    first, size = np.searchsorted(of, np.arange(len(words))), np.bincount(of, minlength=len(words))

    begin = np.searchsorted(doc, np.arange(len(toxic) + 1))

    def spread(on: np.ndarray) -> np.ndarray:
        """In how many of these documents each piece is; a few documents at a time."""
        total, chosen = np.zeros(len(kinds), np.int64), np.flatnonzero(on)
        for part in np.array_split(chosen, max(1, len(chosen) // 200)):
            pairs = np.concatenate([np.arange(begin[d], begin[d + 1]) for d in part] + [np.empty(0, np.int64)])
            w = word[pairs]
            n = size[w]
            at = np.repeat(first[w], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            total += np.bincount(np.unique(np.repeat(doc[pairs], n) * len(kinds) + code[at]) % len(kinds), minlength=len(kinds))
        return total

    rate = n_toxic / (n_toxic + n_clean)
    least = max(3, np.ceil(np.log(CHANCE / len(kinds)) / np.log(rate))) if n_toxic else np.inf
    in_toxic, in_clean = spread(witness), spread(clean)
    marking = (in_toxic >= least) & (in_clean / max(1, n_clean) < RARER * in_toxic / max(1, n_toxic))
    marked = np.zeros(len(words), bool)
    marked[of[marking[code]]] = True
    long = np.array([len(w) >= ORDER for w in words], bool)
    toxic_words, clean_words = np.bincount(word[toxic[doc]], minlength=len(words)), np.bincount(word[clean[doc]], minlength=len(words))
    by = lambda n, on: [words[w] for w in sorted(np.flatnonzero(on & long & (n > 0)).tolist(), key=lambda w: (-n[w], words[w]))]
    return by(toxic_words, marked & (clean_words == 0)), by(clean_words, ~marked | (clean_words > 0))


def _svm(blocks: list[tuple[np.ndarray, float, float]], penalty: float) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton steps; blocks: (rows, label, weight of a row), rows in single precision and without a bias, the result with one."""
    width = blocks[0][0].shape[1]
    w, ridge = np.zeros(width + 1), np.eye(width + 1)
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        left, right = ridge.copy(), np.zeros(width + 1)
        for x, y, weight in blocks:
            for k in range(0, len(x), 8192):
                z = np.hstack([x[k : k + 8192], np.ones((len(x[k : k + 8192]), 1), np.float32)]).astype(np.float64)
                z = z[y * (z @ w) < 1]
                left += penalty * weight * (z.T @ z)
                right += penalty * weight * y * z.sum(axis=0)
        new = np.linalg.solve(left, right)
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], float(w[-1])


def fit(docs: list[tuple[int, set[bytes]]], landmarks: int = LANDMARKS, penalty: float = PENALTY) -> Model:
    """Fits on (label, set of encoded words)."""
    words = sorted({w for _, s in docs for w in s})
    at = {w: k for k, w in enumerate(words)}
    word = [at[w] for _, s in docs for w in sorted(s)]
    return fit_words(np.array([y == 1 for y, _ in docs], bool), np.repeat(np.arange(len(docs)), [len(s) for _, s in docs]), np.array(word, np.int64), words, landmarks, penalty)


def _gapped(word: bytes) -> bytes:
    """word with a letter put into it, in the middle; which one depends on the word."""
    k = len(word) // 2
    return word[:k] + bytes([1 + sum(word) * 7 % 26]) + word[k:]


def families(doc: np.ndarray, word: np.ndarray, n: int, prints: int = 6) -> np.ndarray:
    """Of each of n documents the first one that is its near copy: most of ``prints`` least hashes of their words agree."""
    least = np.full((n, prints), np.iinfo(np.uint64).max, np.uint64)
    for k in range(prints):
        h = (word.astype(np.uint64) + np.uint64(k * 0x9E3779B1 + 1)) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        np.minimum.at(least[:, k], doc, h)
    out = np.arange(n)
    for i in range(1, n):
        alike = np.flatnonzero((least[:i] == least[i]).sum(axis=1) >= prints * 2 // 3)
        if len(alike):
            out[i] = out[alike[0]]
    return out


def fit_words(toxic: np.ndarray, doc: np.ndarray, word: np.ndarray, words: list[bytes], landmarks: int = LANDMARKS, penalty: float = PENALTY, parts: int = FOLDS) -> Model:
    """Fits on documents (toxic or not) and the distinct pairs (doc, word) of their words. Without toxic documents, or without a word that marks them, all texts score the share of toxic ones.

    The curve is fitted on documents that the machine has not seen: each of ``parts`` folds is judged by a machine fitted on the others. Toxic
    documents stand there twice, as they are and with a letter put into each word that the machine knows, so that such forms count too.
    """
    n_toxic, n = int(toxic.sum()), len(toxic)
    rate = min((n_toxic + 0.5) / (n + 1), 0.49) if n else 1e-3
    none = Model(np.zeros(LETTERS**ORDER, np.float32), 0.0, [0.0] * (TOP + 1) + [float(np.log(max(rate, 1e-3) / (1 - rate)))])
    if not n_toxic or n_toxic == n:
        return none
    model = _machine(toxic, doc, word, words, landmarks, penalty)
    if model is None:
        return none
    fold, seen, label = families(doc, word, n) % parts, [], []
    ends = np.searchsorted(doc, np.arange(n + 1))
    for f in range(parts):
        on = fold != f
        kept = on[doc]
        number = np.cumsum(on) - 1
        part = _machine(toxic[on], number[doc[kept]], word[kept], words, landmarks, penalty) if toxic[on].any() and not toxic[on].all() else None
        part = part or model
        here = np.unique(word[~kept])
        margin = np.full(len(words), part.bias)
        for k in range(0, len(here), 20_000):
            margin[here[k : k + 20_000]] = part.word_margins([words[w] for w in here[k : k + 20_000]])
        gapped = margin.copy()
        hit = here[margin[here] > 0]
        gapped[hit] = part.word_margins([_gapped(words[w]) for w in hit])
        for d in np.flatnonzero(~on).tolist():
            mine = word[ends[d] : ends[d + 1]]
            for m in (margin, gapped) if toxic[d] else (margin,):
                seen.append(part.trait(np.append(m[mine], part.bias)))
                label.append(toxic[d])
    model.curve = _logistic(np.array(seen), np.array(label, float))
    return model


def _machine(toxic: np.ndarray, doc: np.ndarray, word: np.ndarray, words: list[bytes], landmarks: int, penalty: float) -> Model | None:
    """The machine over words, its curve not yet fitted; None if no word marks toxic documents."""
    marks, clean = _marking_words(toxic, doc, word, words)
    if not marks or not clean:
        return None
    fm, step = features(marks), max(1, len(clean) // WORKING)
    held = np.zeros(len(clean), bool)
    held[:WORKING] = True
    held[::step] = True
    some = np.flatnonzero(held)
    fc = features([clean[k] for k in some])
    near = kernel(fc, fm[:landmarks]).max(axis=1)
    hard = np.argsort(-near, kind="stable")[: landmarks // 2]
    z = fm[: landmarks // 2] + [fc[k] for k in hard]
    kz = kernel(z, z)
    values, vectors = np.linalg.eigh(kz)
    keep = values > 1e-6 * values.max()
    half = vectors[:, keep] / np.sqrt(values[keep])
    rows = lambda f: (kernel(f, z) @ half).astype(np.float32)
    xm, xc = rows(fm), [rows(fc)]
    while True:  # the machine of all clean words: those outside have no loss in the end
        w, bias = _svm([(xm, 1.0, 500.0 / len(xm)), *((x, -1.0, 500.0 / len(clean)) for x in xc)], penalty)
        weights = np.zeros(LETTERS**ORDER)
        for a, (c, v) in zip(half @ w, z, strict=True):
            np.add.at(weights, c, a * v)
        model = Model(weights.astype(np.float32), bias, np.zeros(TOP + 2))
        rest = np.flatnonzero(~held)
        margin = np.concatenate([np.empty(0), *(model.word_margins([clean[j] for j in rest[k : k + 10_000]]) for k in range(0, len(rest), 10_000))])
        wrong = rest[margin > -1 + 1e-3]
        if not len(wrong):
            return model
        held[wrong] = True
        xc += [rows(features([clean[j] for j in wrong[k : k + 10_000]])) for k in range(0, len(wrong), 10_000)]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic curve, by Newton steps; the last column, of ones, is not held small. No margin weighs below zero: columns that would are left out."""
    free = np.ones(x.shape[1], bool)
    while True:
        z, w = x[:, free], np.zeros(int(free.sum()))
        hold = ridge * np.eye(len(w))
        hold[-1, -1] = 1e-6
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            h = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + hold
            d = np.linalg.solve(h, z.T @ (p - y) + hold @ w)
            w -= d * min(1, 4 / max(1e-9, np.abs(d).max()))
            if np.abs(d).max() < 1e-8:
                break
        out = np.zeros(x.shape[1])
        out[free] = w
        if (out[:TOP] >= 0).all():
            return out
        free[:TOP] &= out[:TOP] >= 0


def held_out() -> F.Column:
    return F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Model:
    """Fits on a sample of the labelled documents that are not held out: the first ``rows`` by hash of doc_id, less each whose text would bring the sample over ``chars`` characters. Rows with a null id or label are left out.

    The fit runs in one task of an executor, as the sample is bounded; the driver receives the weights (4 MB) only.
    """
    spark = docs.sparkSession
    prepare(spark)
    labelled = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    picked = labelled.orderBy(F.xxhash64("_id"), "_id", "toxic").limit(rows)
    picked = spark.createDataFrame([tuple(r) for r in picked.collect()], "_id long, toxic int")
    sample = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "_id")
    sizes = sample.groupBy("_id").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("n")).select(F.xxhash64("_id").alias("h"), "_id", "n").orderBy("h", "_id").collect()
    some, total = [], 0
    for r in sizes:
        if total + r.n <= chars:
            some.append((r["_id"],))
            total += r.n
    some = spark.createDataFrame(some, "_id long")

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            sets = [sorted(set(encode(t or "").tobytes().split(b"\0")) - {b""}) for t in x.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(sets, pa.list_(pa.binary()))], names=["_id", "toxic", "words"])

    coded = sample.join(F.broadcast(some), "_id").select("_id", "toxic", "text").mapInArrow(words, "_id long, toxic int, words array<binary>")
    got = coded.groupBy().applyInArrow(_fit_sample, "weights binary, bias double, curve array<double>").collect()
    if not got:
        return fit([])
    return Model(np.frombuffer(got[0].weights, np.float32), got[0].bias, got[0].curve)


def _fit_sample(sample: pa.Table) -> pa.Table:
    """The model of the whole sample (_id, toxic, words), as one row."""
    sample = sample.sort_by([("_id", "ascending"), ("toxic", "ascending")])
    flat = sample.column("words").combine_chunks()
    coded = flat.flatten().dictionary_encode()
    sizes = np.asarray(flat.value_lengths().fill_null(0))
    word = np.asarray(coded.indices, np.int64)
    names = coded.dictionary.to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    word = rank[word]
    toxic = np.asarray(sample.column("toxic").combine_chunks()) == 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    keys = [(bool(y), np.sort(word[a:b]).tobytes()) for y, a, b in zip(toxic, starts, starts[1:], strict=False)]
    first = {k: i for i, k in reversed(list(enumerate(keys)))}
    kept = np.array([first[k] == i for i, k in enumerate(keys)], bool)  # copies count once
    doc = np.repeat(np.cumsum(kept) - 1, sizes)
    on = np.repeat(kept, sizes)
    m = fit_words(toxic[kept], doc[on], word[on], [names[k] for k in order])
    del sample, flat, coded, word, names, doc, keys, first
    give_back()
    return pa.table({"weights": pa.array([m.weights.tobytes()], pa.binary()), "bias": [float(m.bias)], "curve": pa.array([m.curve.tolist()], pa.list_(pa.float64()))})


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(_doc, _score): rows of docs as structs, and the toxicity (0 to 1) of the whole text. Null and empty texts score as texts without words."""
    prepare(docs.sparkSession)
    spark, rows = docs.sparkSession, packed(docs)
    shared = spark.sparkContext.broadcast(model)  # LETTERS ** ORDER floats, 4 MB

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for x in batches:
            texts, done, out = [t or "" for t in x.column(0).field("text").to_pylist()], 0, []
            while done < len(texts):  # a few million letters at a time
                k, n = done, 0
                while k < len(texts) and (k == done or n + len(texts[k]) <= 1 << 20):
                    n, k = n + len(texts[k]), k + 1
                out.append(m.scores(texts[done:k]))
                done = k
            yield pa.RecordBatch.from_arrays([*x.columns, pa.array(np.concatenate(out) if out else [], pa.float64())], names=["_doc", "_score"])
        give_back()

    return rows.mapInArrow(run, rows.withColumn("_score", F.lit(0.0)).schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with toxicity, in the place of a column of that name if there is one; other columns stay."""
    rest = [F.col("_doc")[c].alias(c) for c in docs.columns if c != "toxicity"]
    return scored(docs, model).select(*rest, F.col("_score").alias("toxicity"))


def clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """docs without those that score ``threshold`` or more; all columns stay, whatever their names."""
    return scored(docs, model).where(F.col("_score") < threshold).select("_doc.*")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
