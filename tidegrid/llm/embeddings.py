"""Embedding near-duplicates by cosine: a subspace pigeonhole join.

Unit vectors at cosine c are sqrt(2 - 2c) apart. They are turned by a seeded rotation and split into blocks. Each block
gets the share of the squared distance that its dimensions are of all (proportional budget): a pair within the whole
distance is within the budget of one block at least. Rows are dealt to tiles by nearest pivot; of each
tile and block the centre and radius are kept, and a pair of tiles is joined only in the blocks whose balls come within
budget. Candidates of any block are verified by cosine in double precision, each pair once.

A pair of tiles costs the move of both, so tiles are large: what moves grows with rows x tiles. Equal vectors are one node with a count. A pair of tiles returns link counts and a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import components, forest, prepare, table, written

COSINE, BLOCK_DIMS, TILE, PIVOTS, SEED = 0.9, 16, 8192, 64, 11
_STEP = 1024


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def blocks_of(dims: int, width: int = BLOCK_DIMS) -> list[slice]:
    n = max(1, dims // width)
    cuts = [k * dims // n for k in range(n + 1)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


def budgets(blocks: list[slice], cosine: float) -> np.ndarray:
    width = np.array([b.stop - b.start for b in blocks], float)
    return (2 - 2 * cosine) * width / width.sum()


def join_tiles(a: np.ndarray, b: np.ndarray, blocks: list[slice], budget: np.ndarray, live: list[int], cosine: float, turn: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of unit vectors in a and b with cosine >= ``cosine``; only i < j within a tile."""
    ra, rb = (a @ turn).astype(np.float32), (b @ turn).astype(np.float32)
    na, nb = ({k: (r[:, blocks[k]] ** 2).sum(axis=1) for k in live} for r in (ra, rb))
    slack = 1e-4  # single precision may err by less
    for s in range(0, len(a), _STEP):
        near = np.zeros((min(_STEP, len(a) - s), len(b)), bool)
        for k in live:
            p = blocks[k]
            near |= na[k][s : s + _STEP, None] + nb[k][None, :] - 2 * (ra[s : s + _STEP, p] @ rb[:, p].T) <= budget[k] + slack
        i, j = np.nonzero(near)
        i += s
        if same:
            i, j = i[i < j], j[i < j]
        for t in range(0, len(i), 1 << 18):
            u, v = i[t : t + (1 << 18)], j[t : t + (1 << 18)]
            hit = np.einsum("ij,ij->i", a[u], b[v]) >= cosine
            yield u[hit], v[hit]


def link(vectors: DataFrame, cosine: float = COSINE, tile: int = TILE, width: int = BLOCK_DIMS, seed: int = SEED) -> DataFrame:
    """vectors(vec_id, embedding) as rows (vec_id, n_links, component_id, kept): see op1 in the README.

    Null, zero, empty and non-finite vectors, and those with null components, link with nothing and are their own component.
    Repeated rows count as vectors of their own. Vectors of another length link only among themselves.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    good = F.coalesce(F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("embedding", lambda e: e != 0), F.lit(False))
    rows = rows.withColumn("good", good)
    valid = rows.where("good").groupBy("embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"))
    nodes = written(valid)
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()))
    dims = [(r[0], r[1]) for r in nodes.groupBy(F.size("embedding").alias("d")).count().collect()]
    counts, edges = [], []
    for d, n in sorted(dims):
        c, e = _links(nodes.where(F.size("embedding") == d), d, n, cosine, tile, width, seed)
        counts.append(c)
        edges.append(e)
    if not dims:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    count, edge = counts[0], edges[0]
    for c, e in zip(counts[1:], edges[1:], strict=True):
        count, edge = count.unionByName(c), edge.unionByName(e)
    roots = written(components(edge))
    light = nodes.select("node", "low", "n")
    named = light.join(roots, "node", "left").select("node", "low", "n", F.coalesce("root", "node").alias("root"))
    least = written(named.groupBy("root").agg(F.min("low").alias("component_id")))
    linked = count.groupBy("node").agg(F.sum("linked").alias("linked"))
    known = written(named.join(least, "root").join(linked, "node", "left").select("node", "component_id", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).cast("long").alias("n_links")))
    by_vector = written(nodes.select("node", F.col("embedding").alias("_v")).join(known, "node").drop("node"))
    out = rows.where("good").join(by_vector, F.col("embedding") == F.col("_v")).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(nodes: DataFrame, dims: int, count: int, cosine: float, tile: int, width: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(node, linked): rows linked to each node, counted by their copies, in parts; and edges (a, b) of a forest."""
    spark = nodes.sparkSession
    blocks, turn = blocks_of(dims, width), rotation(dims, seed)
    budget = budgets(blocks, cosine)
    size, n_pivots = tile, max(1, min(PIVOTS, count // tile))
    picked = nodes.orderBy(F.xxhash64(F.lit(seed), "node")).limit(n_pivots).select("embedding").collect()  # bounded by PIVOTS
    pivots = unit(np.array([r[0] for r in picked], np.float64))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            v = np.asarray(x.column("embedding").flatten()).reshape(-1, dims)
            cell = (unit(v) @ pivots.T).argmax(axis=1) if len(v) else np.empty(0, np.int64)
            raw = [r.tobytes() for r in v]
            yield pa.RecordBatch.from_arrays([x.column("node"), x.column("n"), pa.array(cell, pa.int32()), pa.array(raw, pa.binary())], names=["node", "n", "cell", "raw"])

    dealt = written(nodes.select("node", "n", "embedding").mapInArrow(deal, "node long, n long, cell int, raw binary"))
    sizes = {r[0]: -(-r[1] // size) for r in dealt.groupBy("cell").count().collect()}
    parts = F.element_at(F.create_map(*[F.lit(v) for kv in sizes.items() for v in kv]), F.col("cell"))
    tiles = dealt.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).groupBy("cell", "part").agg(F.collect_list(F.struct("node", "n", "raw")).alias("rows"))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for i in range(x.num_rows):
                rows = x.column("rows")[i].values
                raw = b"".join(rows.field("raw").to_pylist())
                r = unit(np.frombuffer(raw).reshape(-1, dims)) @ turn
                centre = r.mean(axis=0)
                radius = [float(np.sqrt(((r[:, b] - centre[b]) ** 2).sum(axis=1).max())) for b in blocks]
                one = [x.column("cell")[i].as_py(), x.column("part")[i].as_py(), np.asarray(rows.field("node"), np.int64).tobytes(), np.asarray(rows.field("n"), np.int64).tobytes(), raw, centre.tolist(), radius]
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(one, kinds, strict=True)], names=["cell", "part", "nodes", "counts", "raw", "centre", "radius"])

    tiles = written(tiles.mapInArrow(pack, "cell int, part int, nodes binary, counts binary, raw binary, centre array<double>, radius array<double>"))
    balls = tiles.select("cell", "part", "centre", "radius").orderBy("cell", "part").collect()  # a row for each ``tile`` vectors
    centre, radius = np.array([b.centre for b in balls]), np.array([b.radius for b in balls])

    def partners(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            rows = []
            for k in x.column(0).to_pylist():
                live = np.stack([np.sqrt(((centre[k:, b] - centre[k, b]) ** 2).sum(axis=1)) - radius[k:, t] - radius[k, t] <= np.sqrt(budget[t]) + 1e-6 for t, b in enumerate(blocks)], axis=1)
                rows += [(balls[k].cell, balls[k].part, balls[k + j].cell, balls[k + j].part, np.flatnonzero(live[j]).tolist()) for j in np.flatnonzero(live.any(axis=1)).tolist()]
            yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows], pa.int32()) for i in range(4)), pa.array([r[4] for r in rows], pa.list_(pa.int32()))], names=["cell", "part", "cell2", "part2", "live"])

    pairs = spark.range(len(balls)).mapInArrow(partners, "cell int, part int, cell2 int, part2 int, live array<int>")
    first = tiles.select("cell", "part", "nodes", "counts", "raw")
    second = tiles.select(F.col("cell").alias("cell2"), F.col("part").alias("part2"), F.col("nodes").alias("nodes2"), F.col("counts").alias("counts2"), F.col("raw").alias("raw2"))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for i in range(x.num_rows):
                get = lambda c, t: np.frombuffer(x.column(c)[i].as_py(), t)  # noqa: B023, E731
                ia, ib, ca, cb = get("nodes", np.int64), get("nodes2", np.int64), get("counts", np.int64), get("counts2", np.int64)
                same = ia[0] == ib[0]
                a = unit(get("raw", np.float64).reshape(-1, dims))
                b = a if same else unit(get("raw2", np.float64).reshape(-1, dims))
                la, lb = np.zeros(len(ia), np.int64), np.zeros(len(ib), np.int64)
                e = [np.empty(0, np.int64), np.empty(0, np.int64)]
                for u, v in join_tiles(a, b, blocks, budget, x.column("live")[i].as_py(), cosine, turn, same):
                    np.add.at(la, u, cb[v])
                    np.add.at(lb, v, ca[u])
                    e = list(forest(np.concatenate([e[0], ia[u]]), np.concatenate([e[1], ib[v]])))
                node = np.concatenate([ia[la > 0], ib[lb > 0]])
                linked = np.concatenate([la[la > 0], lb[lb > 0]])
                pad = [None] * len(node), [None] * len(e[0])
                yield pa.RecordBatch.from_arrays([pa.array([*node.tolist(), *pad[1]], pa.int64()), pa.array([*linked.tolist(), *pad[1]], pa.int64()), pa.array([*pad[0], *e[0].tolist()], pa.int64()), pa.array([*pad[0], *e[1].tolist()], pa.int64())], names=["node", "linked", "a", "b"])

    joined = pairs.join(first, ["cell", "part"]).join(second, ["cell2", "part2"]).repartition(3 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = written(joined.select("nodes", "counts", "raw", "nodes2", "counts2", "raw2", "live").mapInArrow(compare, "node long, linked long, a long, b long"))
    return found.where("node IS NOT NULL").select("node", "linked"), found.where("a IS NOT NULL").select("a", "b")


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(c.low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(c.low, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""
