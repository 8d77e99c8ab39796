"""SimHash near-duplicates: 64-bit fingerprints of word shingles, compared exactly, tile by tile.

Fingerprints are grouped first (copies of a text are one fingerprint). Distinct fingerprints are sorted into
cells by the population counts of their two 32-bit halves. Two fingerprints within the radius lie in cells whose
counts differ by the radius at most in sum, so other pairs of cells are skipped. A cell over ``tile`` fingerprints
is cut by hash, which bounds each task. Inside a pair of tiles the same test is made again on the
counts of 16-bit quarters; what remains is compared with exclusive-or and bit counts. A pair of tiles
returns a spanning forest of its links, never all pairs; the forests are joined in Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidegrid.llm.common import components, forest, give_back, packed, prepare, written

RADIUS, SHINGLE, SEED, TILE = 4, 4, 42, 32768


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of the whole text: A-Z lower-cased, words as in common.WORD, shingles with repeats; a bit is 1 if set in over half of the hashes. No word: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: n - shingle + 1].tolist()
    ends = (ends[shingle - 1 :] - 1).tolist()
    h = np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends, strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 65536):
        ones += np.unpackbits(h[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def _hashed(rows: DataFrame, kept: str, shingle: int) -> DataFrame:
    """rows (columns ``kept``, then text) with the text replaced by fp, the fingerprint's bits as a signed long."""
    prepare(rows.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            fp = np.array([simhash(t, shingle) for t in x.column(x.num_columns - 1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*x.columns[:-1], pa.array(fp)], names=[*x.schema.names[:-1], "fp"])
        give_back()

    return rows.mapInArrow(run, f"{kept}, fp long")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's bits as a signed long. A null text counts as empty."""
    return _hashed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "doc_id long", shingle)


def _near(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes of all pairs within the radius, a slab at a time."""
    step = max(1, (1 << 20) // max(1, len(b)))
    for k in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(a[k : k + step, None] ^ b[None, :]) <= radius)
        yield i + k, j


def _quarters(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Population counts of the four quarters that occur, and the fingerprints that have each."""
    counts = np.bitwise_count(x.view(np.uint16).reshape(-1, 4)).astype(np.int16)
    kinds, at = np.unique(counts, axis=0, return_inverse=True)
    order = np.argsort(at.ravel(), kind="stable")
    return kinds, np.split(x[order], np.cumsum(np.bincount(at.ravel()))[:-1])


def near_forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between fingerprints a and b (uint64), as signed longs. It is reduced as slabs come, so a dense tile never holds all its pairs."""
    if len(a) * len(b) < 1 << 20:
        groups = [(a, b)]
    else:
        (ka, ga), (kb, gb) = _quarters(a), _quarters(b)
        near = (np.flatnonzero(np.abs(kb - k).sum(axis=1) <= radius) for k in ka)
        groups = [(x, np.concatenate([gb[t] for t in n])) for x, n in zip(ga, near, strict=True) if len(n)]
    held, size = [np.empty((2, 0), np.int64)], 0
    for x, y in groups:
        for i, j in _near(x, y, radius):
            e = np.stack([x[i], y[j]]).view(np.int64)
            held.append(e[:, e[0] != e[1]])
            size += held[-1].shape[1]
            if size > 1 << 20:
                held = [np.stack(forest(*np.concatenate(held, axis=1)))]
                size = 0
    return forest(*np.concatenate(held, axis=1))


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that join all distinct fingerprints (column fp) within the radius of each other, directly or in steps."""
    spark = fps.sparkSession
    half = lambda low: F.bit_count(F.shiftrightunsigned("fp", low).bitwiseAND(F.lit(0xFFFFFFFF)))
    cells = fps.select("fp").withColumn("c0", half(0).cast("int")).withColumn("c1", half(32).cast("int"))
    #: 33 x 33 cells at most, whatever the size of the input
    sizes = {(r.c0, r.c1): r.n for r in cells.groupBy("c0", "c1").agg(F.count("*").alias("n")).collect()}
    parts = {k: -(-n // tile) for k, n in sizes.items()}
    cut = F.create_map(*[F.lit(v) for (p, q), n in parts.items() for v in (p * 64 + q, n)]) if parts else F.create_map(F.lit(0), F.lit(1))
    cells = cells.withColumn("cell", F.col("c0") * 64 + F.col("c1")).withColumn("part", F.pmod(F.xxhash64("fp"), F.element_at(cut, F.col("cell"))).cast("int"))
    packed = written(cells.groupBy("cell", "part").agg(F.collect_list("fp").alias("fps")))
    near = {p * 64 + q: [r * 64 + s for r, s in parts if (r, s) >= (p, q) and abs(p - r) + abs(q - s) <= radius] for p, q in parts}
    count = {p * 64 + q: n for (p, q), n in parts.items()}

    def partners(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            rows = [(c, k, d, j) for c, k in zip(*(x.column(i).to_pylist() for i in (0, 1)), strict=True) for d in near[c] for j in range(k if d == c else 0, count[d])]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int32()) for i in range(4)], names=["cell", "part", "cell2", "part2"])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [np.empty((2, 0), np.int64)]
        for x in batches:
            for i in range(x.num_rows):
                a, b = (np.asarray(x.column(k)[i].values).view(np.uint64) for k in (0, 1))
                got.append(np.stack(near_forest(a, b, radius)))
            e = np.concatenate(got, axis=1)
            got = [np.stack(forest(e[0], e[1]))]
        yield pa.RecordBatch.from_arrays([pa.array(got[0][k]) for k in (0, 1)], names=["a", "b"])

    pairs = packed.select("cell", "part").mapInArrow(partners, "cell int, part int, cell2 int, part2 int")
    other = packed.select(F.col("cell").alias("cell2"), F.col("part").alias("part2"), F.col("fps").alias("fps2"))
    n = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = pairs.join(packed, ["cell", "part"]).join(other, ["cell2", "part2"]).select("fps", "fps2")
    return joined.repartition(n).mapInArrow(compare, "a long, b long")


def simhash_components(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One row for each row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links, itself included).

    Texts without words have fingerprint zero and link like any other. Repeated rows stay repeated; a null doc_id keeps its
    row and never is the smallest, unless its component has no other. An empty table gives no rows.
    """
    rows = written(fingerprints(docs, shingle))
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = written(components(links(fps, radius)))
    named = fps.join(roots, fps.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = written(named.groupBy("root").agg(F.min("low").alias("component_id")))
    of = written(named.join(least, "root").select("fp", "component_id"))
    return rows.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """docs with one row of each component: the one with the smallest doc_id (null last), of repeated rows one. All columns stay, whatever their names."""
    rows = written(packed(docs).withColumn("_row", F.monotonically_increasing_id()))
    prints = written(_hashed(rows.select(F.col("_row"), F.col("_doc")["doc_id"].cast("long").alias("doc_id"), F.col("_doc")["text"].cast("string").alias("text")), "_row long, doc_id long", shingle))
    fps = written(prints.select("fp").distinct())
    roots = written(components(links(fps, radius)))
    named = prints.join(roots, prints.fp == roots.node, "left").select("_row", "doc_id", F.coalesce("root", "fp").alias("root"))
    best = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "_row")).alias("b"))
    gone = written(named.join(written(best), "root").where(F.col("_row") != F.col("b._row")).select(F.col("_row").alias("_gone")))
    return rows.join(gone, F.col("_row") == F.col("_gone"), "left_anti").select("_doc.*")
