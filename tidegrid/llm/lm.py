"""Language-model scoring by cross-entropy difference.

A target and a background bigram model share one vocabulary (all words of both), one order and one smoothing; counts
come from all rows of the target and of the background, without limits, so that the model grows with the input. The score
of a document is its mean loss per word under the target model less that under the background model: the
lower, the more like the target. Where the documents themselves are the background, each is scored by the counts of all others (its own are taken off first):
a text that occurs twice stays cheap under the background, one that occurs once does not vouch for itself.

No task and not the driver ever holds the model. Words and bigrams are 64-bit codes. Rows are taken in chunks of ``CHUNK``
characters; a chunk sends each of its different codes once, with its count, to the bucket that the code's leading bits name.
A bucket sums the counts and answers each chunk in the order of its codes; then the chunk scores its documents. A code that is in every
document reaches its bucket once for each chunk, so there are no hot keys.

A word's probability is (c + PRIOR q) / (N + PRIOR), q being its share of target and background together (a word in
neither counts half an occurrence there); after a word v with count c(v) it is WEIGHT c(v, w) / c(v) + (1 - WEIGHT) times that, or that alone if the model lacks v.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import give_back, prepare, table, words_of, written

WEIGHT, PRIOR = 0.7, 1000.0
#: Characters of a chunk, and of the texts for each bucket.
CHUNK, BUCKET = 16_000_000, 4_000_000
_CACHE = 1 << 19
BEGIN = np.uint64(1)
#: What a chunk is: bits of kind.
TARGET, COUNTED, SCORES = 1, 2, 4
SENT = "chunk string, bucket long, kind int, codes binary, counts binary, ids array<long>, sizes array<long>, n long"
SCORED = "doc_id long, n_words long, loss_target double, loss_background double, score double"
_ARROW = pa.schema([("chunk", pa.string()), ("bucket", pa.int64()), ("kind", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("n", pa.int64())])


class _Codes(dict):
    """Code of each word, kept for the words met so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHE:
            self.clear()
        self[word] = code = xxhash.xxh64_intdigest(word, seed=7)
        return code


def codes_of(text: str | None, known: dict[bytes, int]) -> np.ndarray:
    words = words_of(text and text.lower())
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def pairs_of(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Codes of bigrams."""
    x = before * np.uint64(0x9E3779B97F4A7C15) + after
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def pack(x: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes as the largest needs, the same byte of all together, compressed."""
    if not len(x):
        return b""
    x = x.astype(np.min_scalar_type(int(x.max())))
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T))


def unpack(blob: bytes, n: int) -> np.ndarray:
    """What pack() made from n numbers."""
    if not n:
        return np.empty(0, np.uint64)
    raw = zstandard.ZstdDecompressor().decompress(blob)
    width = len(raw) // n
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(f"<u{width}").ravel().astype(np.uint64)


def steps(codes: np.ndarray) -> np.ndarray:
    """Differences, modulo 2^64: small for sorted codes; their running sum is codes again."""
    return np.diff(codes, prepend=np.uint64(0))


class Chunk:
    """Words of some documents: ``words`` are the different codes, BEGIN first, then frequent ones; ``at`` places all words in them, document after document."""

    def __init__(self, words: np.ndarray, at: np.ndarray, sizes: np.ndarray):
        self.words, self.at, self.sizes = words, at, sizes

    def pair(self) -> None:
        """Finds the bigrams: ``pairs`` and where each stands; ``codes``: words and bigrams sorted, from ``order``."""
        words, at, sizes = self.words, self.at, self.sizes
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        self.starts = starts
        self.before = np.concatenate([np.zeros(1, np.int32), at[:-1]]) if len(at) else at.copy()
        self.before[starts] = 0
        self.pairs, self.pair_at = np.unique(pairs_of(words[self.before], words[at]), return_inverse=True)
        self.pair_at = self.pair_at.astype(np.int32)
        codes = np.concatenate([words, self.pairs])
        self.order = np.argsort(codes, kind="stable")
        self.codes = codes[self.order]

    @classmethod
    def of(cls, texts: list[np.ndarray]) -> Chunk:
        sizes = np.array([len(t) for t in texts], np.int64)
        words, at, n = np.unique(np.concatenate([*texts, np.empty(0, np.uint64)]), return_inverse=True, return_counts=True)
        order = np.lexsort((words, -np.minimum(n, 64)))
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(1, len(order) + 1)
        return cls(np.concatenate([[BEGIN], words[order]]), rank[at], sizes)

    def head(self) -> dict:
        return {"codes": pack(steps(self.words)), "counts": pack(self.at), "sizes": self.sizes.tolist(), "n": len(self.words)}

    @classmethod
    def read(cls, codes: bytes, at: bytes, sizes: list[int], n: int) -> Chunk:
        """From what head() gives."""
        return cls(np.cumsum(unpack(codes, n), dtype=np.uint64), unpack(at, sum(sizes)).astype(np.int32), np.array(sizes, np.int64))

    def counts(self) -> np.ndarray:
        """Of ``codes``."""
        single = np.bincount(self.at, minlength=len(self.words))
        single[0] = len(self.starts)
        return np.concatenate([single, np.bincount(self.pair_at, minlength=len(self.pairs))])[self.order]

    def own(self, at: np.ndarray, kinds: int) -> np.ndarray:
        """How often the document of each place has what stands there (``at``, numbers below ``kinds``)."""
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        _, where, n = np.unique(doc * kinds + at, return_inverse=True, return_counts=True)
        return n.astype(np.int32)[where]

    def losses(self, told: np.ndarray, totals: tuple[float, float], apart: bool = False) -> np.ndarray:
        """Mean loss of each document that has words, under target (row 0) and background (1); told: counts of ``codes`` in both, totals: words in both; ``apart``: the background has these documents, whose own counts are taken off."""
        if not len(self.starts):
            return np.zeros((2, 0))
        n, out = np.empty(told.shape), []
        n[:, self.order] = told
        single, pair = n[:, : len(self.words)], n[:, len(self.words) :]
        off = dict.fromkeys(("word", "history", "pair", "words"), 0)
        if apart:
            mine = self.own(self.at, len(self.words))
            behind = np.concatenate([[1], mine[:-1]])  # a history is the word one place before, or a beginning
            behind[self.starts] = 1
            off = {"word": mine, "history": behind, "pair": self.own(self.pair_at, len(self.pairs)), "words": np.repeat(self.sizes, self.sizes)}
        share = np.maximum((single[0] + single[1])[self.at] - off["word"], 0.5) / np.maximum(sum(totals) - off["words"], 0.5)
        for k in (0, 1):  # one model after the other: a chunk has millions of places
            less = off if k else dict.fromkeys(off, 0)
            p = (single[k][self.at] - less["word"] + PRIOR * share) / (totals[k] - less["words"] + PRIOR)
            history = single[k][self.before] - less["history"]
            p = np.where(history > 0, WEIGHT * (pair[k][self.pair_at] - less["pair"]) / np.maximum(history, 1) + (1 - WEIGHT) * p, p)
            out.append(np.add.reduceat(-np.log(p), self.starts) / self.sizes[self.sizes > 0])
        return np.stack(out)


def _table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_ARROW)


def _chunks(df: DataFrame, kind: int) -> DataFrame:
    """Rows SENT, one for each chunk of df(doc_id, text) (bucket -1); doc_id is read if kind has SCORES."""

    def row(ids: list, texts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        head = Chunk.of(texts).head() | {"chunk": uuid.uuid4().hex, "bucket": -1, "kind": kind, "ids": ids if kind & SCORES else None}
        yield from _table([head]).to_batches()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ids, texts, size = _Codes(), [], [], 0
        for x in batches:
            for d, t in zip(x.column(0), x.column(1), strict=True):
                t = t.as_py()
                ids.append(d.as_py())
                texts.append(codes_of(t, known))
                size += len(t or "")
                if size >= CHUNK:
                    yield from row(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield from row(ids, texts)
        ids, texts = [], []
        known.clear()
        give_back()

    key = F.col("doc_id").cast("long") if kind & SCORES else F.lit(None).cast("long")
    return df.select(key.alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SENT)


def _codes(chunks: DataFrame, buckets: int) -> DataFrame:
    """Rows SENT of chunks: one for each bucket that a chunk has codes for."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for k in range(x.num_rows):
                chunk, _, kind, codes, at, _, sizes, n = (c[k].as_py() for c in x.columns)
                c = Chunk.read(codes, at, sizes, n)
                c.pair()
                n = c.counts() if kind & COUNTED else np.zeros(len(c.codes), np.int64)
                of = (c.codes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                ends = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
                for a, b in zip(ends, ends[1:], strict=False):
                    row = {"chunk": chunk, "bucket": int(of[a]), "kind": kind, "codes": pack(steps(c.codes[a:b])), "counts": pack(n[a:b]), "n": b - a}
                    yield from _table([row]).to_batches()
                del c, n, of
                give_back()

    return chunks.mapInArrow(run, SENT)


def _answer(rows: pa.Table) -> pa.Table:
    """One bucket: for each chunk that scores, the counts in target (codes) and background (counts) of what it sent."""
    size = np.asarray(rows.column("n")).astype(np.int64)
    ends, kind = np.cumsum(size), np.asarray(rows.column("kind"))
    codes = np.concatenate([np.cumsum(unpack(b.as_py(), n), dtype=np.uint64) for b, n in zip(rows.column("codes"), size.tolist(), strict=True)])
    n = np.concatenate([unpack(b.as_py(), k) for b, k in zip(rows.column("counts"), size.tolist(), strict=True)]).astype(float)
    known, at = np.unique(codes, return_inverse=True)
    mine = np.repeat(kind & TARGET != 0, size)
    t, b = (np.bincount(at, n * on, len(known)).astype(np.int64)[at] for on in (mine, ~mine))
    out = []
    for k in np.flatnonzero(kind & SCORES).tolist():
        part = slice(ends[k] - size[k], ends[k])
        out.append({"chunk": rows.column("chunk")[k].as_py(), "bucket": rows.column("bucket")[k].as_py(), "codes": pack(t[part]), "counts": pack(b[part]), "n": int(size[k])})
    return _table(out)


def score(docs: DataFrame, target: DataFrame, background: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_words, loss_target, loss_background, score) for each row of docs(doc_id, text).

    The background model comes from ``background(text)``, or from docs themselves, each document's own counts taken off. Null and empty texts have no words: score 0, no losses. Repeated
    rows count and are scored each time; a null doc_id stays null. Without target rows its model is the shared vocabulary's. Empty docs give no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    frames = [docs, target] + ([background] if background is not None else [])
    chars = sum(f.agg(F.sum(F.length(F.col("text").cast("string")).cast("long"))).first()[0] or 0 for f in frames)
    buckets, apart = min(-(-chars // BUCKET) or 1, 1 << 31), background is None
    own = SCORES | (COUNTED if background is None else 0)
    chunks = _chunks(docs, own).union(_chunks(target, TARGET | COUNTED))
    if background is not None:
        chunks = chunks.union(_chunks(background, COUNTED))
    chunks = written(chunks)  # their names are made once, whatever tasks run again
    words = chunks.where(F.col("kind").bitwiseAND(COUNTED) != 0).groupBy(F.col("kind").bitwiseAND(TARGET).alias("target"))
    words = {r.target: float(r.n or 0) for r in words.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n")).collect()}  # two rows
    totals = words.get(TARGET, 0.0), words.get(0, 0.0)

    def scored(rows: pa.Table) -> pa.Table:
        told = sorted(zip(rows.column("bucket").to_pylist(), range(rows.num_rows), strict=True))
        get = lambda c, k: rows.column(c)[k].as_py()
        head, sizes = told[0][1], np.array(get("sizes", told[0][1]), np.int64)
        c = Chunk.read(get("codes", head), get("counts", head), sizes.tolist(), get("n", head))
        c.pair()
        n = np.stack([np.concatenate([unpack(get(col, k), get("n", k)) for _, k in told[1:]]).astype(float) for col in ("codes", "counts")])
        loss, some = np.zeros((2, len(sizes))), sizes > 0
        loss[:, some] = c.losses(n, totals, apart)
        del c, n
        give_back()
        return pa.table([pa.array(get("ids", head), pa.int64()), pa.array(sizes), *(pa.array(x, pa.float64(), mask=~some) for x in loss), pa.array(loss[0] - loss[1])], names=["doc_id", "n_words", "loss_target", "loss_background", "score"])

    # partitions in step with buckets and chunks, so that no task's share grows with the input
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = _codes(chunks, buckets).repartition(max(parts, buckets // 16), "bucket").groupBy("bucket").applyInArrow(_answer, SENT)
    mine = chunks.where("ids IS NOT NULL").union(told).repartition(max(parts, chars // (4 * CHUNK)), "chunk")
    return mine.groupBy("chunk").applyInArrow(scored, SCORED)


def op6_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
