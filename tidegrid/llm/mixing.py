"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets come from the weights, each at most ``most`` times its source's size. The budget in blocks goes to the sources by
highest quotients target / (2k + 1), then within a source to its shards by their sizes. In a shard the documents stand
in seeded order as one stream of words cut into blocks; a quota takes whole passes and, for the rest, the blocks
with the lowest seeded random keys. Only (row, source, size) moves; a shard holds 1/4096 of its source or 1000 rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import prepare, word_count, written

WEIGHTS, BUDGET, MOST, BLOCK, SEED = (5, 2, 1), 1.5, 2, 64, 17
SHARD_ROWS, MOST_SHARDS = 1000, 4096


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST) -> dict[str | None, float]:
    """Sources by code point, null last, weigh ``weights`` in turn and share ``budget`` times all sizes; none gets over ``most`` times its own, the excess is shared again by weight until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    out: dict[str | None, float] = {}
    left = budget * sum(sizes.values())
    free = list(order)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: float(most * sizes[s]) for s in over}
        left -= sum(most * sizes[s] for s in over)
        free = [s for s in free if s not in over]
    return out


def sainte_lague(claims: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """Seats by highest quotients claim / (2k + 1); ties to the earlier claim; ``most`` bounds what each can hold.

    The common divisor is found by bisection, so that billions of seats cost no more than a few; the last ones go one by one.
    """
    most = most or [seats] * len(claims)
    held = lambda d: [min(m, int((c / d + 1) / 2)) for c, m in zip(claims, most, strict=True)]
    out = [0] * len(claims)
    seats = min(seats, sum(m for c, m in zip(claims, most, strict=True) if c > 0))
    if seats <= 0:
        return out
    low, high = 0.0, 2.0 * max(claims)
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high) or mid == 0:
            break
        low, high = (mid, high) if sum(held(mid)) > seats else (low, mid)
    out = held(high)
    heap = [(-c / (2 * n + 1), k) for k, (c, n, m) in enumerate(zip(claims, out, most, strict=True)) if n < m and c > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, k = heapq.heappop(heap)
        out[k] += 1
        if out[k] < most[k]:
            heapq.heappush(heap, (-claims[k] / (2 * out[k] + 1), k))
    return out


def blocks_of(tokens: int, block: int) -> int:
    """Blocks in a stream: the last one holds the rest too; fewer tokens than a block are one."""
    return max(1, tokens // block) if tokens else 0


def choose(size: np.ndarray, quota: int, block: int, seed: int) -> tuple[int, np.ndarray, np.ndarray]:
    """For documents in stream order: whole passes, and the streams' [start, end) ranges that a last, partial pass takes."""
    total = int(size.sum())
    n = blocks_of(total, block)
    passes, rest = divmod(quota, n) if n else (0, 0)
    if not rest:
        return passes, np.empty(0, np.int64), np.empty(0, np.int64)
    picked = np.sort(np.argsort(np.random.default_rng(seed).random(n), kind="stable")[:rest])
    start, end = picked * block, (picked + 1) * block
    end[picked == n - 1] = total
    return passes, start, end


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """rows(_row long, doc_id long, source string, size long, key long, a hash of the text) with source_size, target, taken, passes, spans (array of word ranges [start, end) of the partial pass).

    Blocks have ``block`` words, fewer where the smallest source that has words holds less than 32 such blocks. Sizes of 0 take nothing. Equal input gives equal output.
    """
    spark = rows.sparkSession
    per = [(r.source, r.size or 0, r.n) for r in rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()]
    sizes = {s: n for s, n, _ in per}
    target = targets(sizes, weights, budget, most)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    block = max(1, min([block, *(n // 32 for n in sizes.values() if n)]))
    quota = dict(zip(order, sainte_lague([target[s] for s in order], int(sum(target.values()) // block), [most * sizes[s] // block for s in order]), strict=True))
    info = spark.createDataFrame([(s, sizes[s], target[s], min(MOST_SHARDS, -(-n // SHARD_ROWS))) for s, _, n in per], "_source string, source_size long, target double, _shards long")
    dealt = rows.join(F.broadcast(info), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")  # a row for each source
    dealt = dealt.withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "size", "key")).withColumn("_shard", F.expr("pmod(_order, _shards)"))
    shards: dict[str | None, list[tuple[int, int]]] = {}
    for r in dealt.groupBy("source", "_shard").agg(F.sum("size").alias("n")).collect():  # at most MOST_SHARDS for each source
        shards.setdefault(r.source, []).append((r["_shard"], r.n or 0))
    quotas = {}
    for s, parts in shards.items():
        parts.sort()
        for (k, _), q in zip(parts, sainte_lague([float(n) for _, n in parts], quota[s], [most * blocks_of(n, block) for _, n in parts]), strict=True):
            quotas[s, k] = q

    def take(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        s, k = (None if pd.isna(key[0]) else key[0]), int(key[1])
        x = x.sort_values(["_order", "doc_id", "size", "_row"], kind="stable")
        size = x["size"].to_numpy(np.int64)
        passes, start, end = choose(size, quotas[s, k], block, seed + k)
        edge = np.concatenate([[0], np.cumsum(size)])
        spans: list[list[dict]] = [[] for _ in size]
        taken = passes * size
        first, last = np.searchsorted(edge, start, side="right") - 1, np.searchsorted(edge, end, side="left") - 1
        for a, b, i, j in zip(start.tolist(), end.tolist(), first.tolist(), last.tolist(), strict=True):
            for d in range(i, j + 1):
                u, v = max(a - int(edge[d]), 0), min(b - int(edge[d]), int(size[d]))
                if v > u:
                    taken[d] += v - u
                    if spans[d] and spans[d][-1]["end"] == u:
                        spans[d][-1]["end"] = v
                    else:
                        spans[d].append({"start": u, "end": v})
        return pd.DataFrame({"_row": x["_row"].to_numpy(), "doc_id": x["doc_id"].astype("Int64"), "source": x["source"], "size": size, "source_size": x["source_size"].to_numpy(), "target": x["target"].to_numpy(), "taken": taken, "passes": np.full(len(size), passes), "spans": spans})

    schema = "_row long, doc_id long, source string, size long, source_size long, target double, taken long, passes long, spans array<struct<start: long, end: long>>"
    return dealt.groupBy("source", "_shard").applyInPandas(take, schema)


def sized(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, source, size, key) of docs; null texts have size 0."""
    prepare(docs.sparkSession)
    return docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count("text").alias("size"), F.xxhash64(F.col("text").cast("string")).alias("key"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """docs as mixed: a row for each whole pass over a document and one with the taken words of a partial pass; n_chars follows the text.

    Documents of which nothing is taken go; a null source is a source. Other columns stay, whatever their names. Texts move in one join, which sorts and merges at every size.
    """
    names, schema = docs.columns, docs.schema
    rows = written(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*(F.col(f"`{c}`") for c in names)).alias("_doc")))
    part = F.col("_doc")
    sizes = rows.select("_row", part["doc_id"].cast("long").alias("doc_id"), part["source"].cast("string").alias("source"), part["text"].cast("string").alias("text"))
    sizes = sizes.withColumns({"size": word_count("text"), "key": F.xxhash64("text")}).drop("text")
    chosen = written(plan(written(sizes), **options).where("taken > 0").select("_row", "passes", "spans"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+")

        def taken(docs: pa.StructArray, at: list[int], texts: list[str], partial: list[bool]) -> pa.RecordBatch:
            columns = dict(zip(names, docs.take(pa.array(at, pa.int64())).flatten(), strict=True))
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                given = columns["n_chars"]
                columns["n_chars"] = pa.array([len(t) if p else n for t, p, n in zip(texts, partial, given.to_pylist(), strict=True)], given.type)
            return pa.RecordBatch.from_arrays(list(columns.values()), names=names)

        for x in batches:
            docs, at, texts, partial, n = x.column(0), [], [], [], 0
            for i, (t, passes, spans) in enumerate(zip(docs.field("text").to_pylist(), x.column(1).to_pylist(), x.column(2).to_pylist(), strict=True)):
                at += [i] * passes
                texts += [t] * passes
                partial += [False] * passes
                if spans:
                    words = [m.span() for m in word.finditer(t)]
                    at.append(i)
                    texts.append("\n".join(t[words[s["start"]][0] : words[s["end"] - 1][1]] for s in spans))
                    partial.append(True)
                n += len(t) * (passes + 1)
                if n > 1 << 24:  # a few million letters at a time
                    yield taken(docs, at, texts, partial)
                    at, texts, partial, n = [], [], [], 0
            yield taken(docs, at, texts, partial)

    return rows.join(chosen.hint("merge"), "_row").select("_doc", "passes", "spans").mapInArrow(cut, schema)
