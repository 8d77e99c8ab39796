"""SpotSigs fingerprints: chains of content words that follow common words, as a set of hashes.

An anchor is a common word (ANCHORS, in four languages). Its signature is the anchor and the next ``chain`` words that are no
anchors, each ``step`` content words apart; at the end of a text the chain may be shorter, but holds one content word. A
text without any signature takes each of its words as an anchor, so that texts in other languages have one too.
The fingerprint is the sorted set of 32-bit hashes in hex.

Near-duplicates are sets at Jaccard ``least`` or more. Equal sets are one node. A set is filed under its rarest signatures, as many as two
such sets must share one of, in partitions by set length: its own (lengths within a factor ``least``) and, as a guest, the next. Sets that share a
file are compared exactly, less what lengths and the triangle inequality rule out. First under the rarest few signatures only;
then under all, but only in files that still hold sets of different components. A file returns a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest, xxh64_intdigest

from tidegrid.llm.common import components, discard, forest, prepare, shared_dir, table, words_of, written

CHAIN, STEP, BUCKET_ROWS, MOST_BUCKETS = 3, 1, 1000, 20_000
LIKE, FIRST, FILE, COMMON, COUNTERS = 0.8, 3, 2048, 100_000, 1024
#: Common words: English, French, German, Spanish. Fixed values.
ANCHORS = frozenset(
    "a an and are as at be but by for from had has have he her his in is it not of on or she that the this to was were will with you "
    "au aux ce dans des du elle en est et il je la le les mais ne nous ou par pas pour que qui se sur un une vous "
    "auch auf aus bei das dem den der die ein eine er es für ich im ist mit nicht sich sie und von wir zu "
    "al como con de del el ella ellos era ha las lo los más no para pero por su sus una y".split()
)
_ANCHORS = frozenset(w.encode() for w in ANCHORS)
_EDGE = b".,;:!?\"'()[]{}*#$%&-_/"


def signatures(text: str | None, chain: int = CHAIN, step: int = STEP) -> np.ndarray:
    """The text's set of signature hashes (sorted uint32). Letters are lower-cased and punctuation around words goes. No words: empty."""
    words = [w for w in (x.strip(_EDGE) for x in words_of(text and text.lower())) if w]
    if not words:
        return np.empty(0, np.uint32)
    content = [w for w in words if w not in _ANCHORS]
    out, seen, n = set(), 0, len(content)
    for w in words:
        if w in _ANCHORS:
            if seen < n:
                out.add(b" ".join([w, *content[seen : seen + chain * step : step]]))
        else:
            seen += 1
    if not out:
        out = {b" ".join(words[k : k + chain + 1]) for k in range(max(1, len(words) - chain))}
    return np.unique(np.fromiter((xxh32_intdigest(s) for s in out), np.uint32, len(out)))


def fingerprint(sigs: np.ndarray) -> str:
    return sigs.astype(">u4").tobytes().hex()


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard likeness of two sorted sets; 0 without comparison if their lengths rule ``least`` out. Two empty sets: 1."""
    if not len(a) and not len(b):
        return 1.0
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(a) + len(b) - common)


def edited(text: str, after: str) -> str:
    """text with its last floor(n / 4) code points replaced by the first as many (or all) of ``after``."""
    k = len(text) // 4
    return text[: len(text) - k] + after[:k]


def with_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, classes: DataFrame | None = None) -> DataFrame:
    """(bucket, doc_id, text, ahead, key, component_id) so that each bucket, sorted by ahead, doc_id and text, holds consecutive rows and then the first of the next bucket (ahead).

    Rows of classes(doc_id, key, component_id) have a null text and stand before those of their doc_id. Buckets are ranges of doc_id between approximate quantiles, at most MOST_BUCKETS; after the last comes the first. Null ids stand last.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = max(1, min(MOST_BUCKETS, -(-rows.count() // bucket_rows)))
    cuts = rows.where("doc_id IS NOT NULL").select(F.percentile_approx("doc_id", F.array(*[F.lit(k / n) for k in range(1, n)]), 20 * n)).first()[0] if n > 1 else []
    edges = np.array(sorted(set(cuts or [])), np.int64)

    def bucket_of(ids: pa.Array) -> np.ndarray:
        return np.where(np.asarray(ids.is_null()), len(edges) + 1, np.searchsorted(edges, np.asarray(ids.fill_null(0)), side="left"))

    def buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(x.column(0)), pa.int32()), x.column(0)], names=["bucket", "doc_id"])

    firsts = rows.select("doc_id").mapInArrow(buckets, "bucket int, doc_id long").groupBy("bucket").agg(F.min("doc_id").alias("low")).orderBy("bucket").collect()
    before = {(r.bucket, r.low): firsts[k - 1].bucket for k, r in enumerate(firsts)}

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "doc_id", "text", "ahead"]
        for x in batches:
            at = bucket_of(x.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *x.columns, pa.array(np.zeros(len(at), bool))], names=names)
            to = [(k, before[key]) for k, key in enumerate(zip(at.tolist(), x.column(0).to_pylist(), strict=True)) if key in before]
            if to:
                also = x.take(pa.array([k for k, _ in to]))
                yield pa.RecordBatch.from_arrays([pa.array([b for _, b in to], pa.int32()), *also.columns, pa.array(np.ones(len(to), bool))], names=names)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    none = F.lit(None).cast("long")
    dealt = rows.mapInArrow(deal, "bucket int, doc_id long, text string, ahead boolean").withColumns({"key": none, "component_id": none})
    if classes is not None:

        def file(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in batches:
                at, n = bucket_of(x.column(0)), x.num_rows
                columns = [pa.array(at, pa.int32()), x.column(0), pa.nulls(n, pa.string()), pa.array(np.zeros(n, bool)), x.column(1), x.column(2)]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "doc_id", "text", "ahead", "key", "component_id"])

        dealt = dealt.unionByName(classes.select("doc_id", "key", "component_id").mapInArrow(file, dealt.schema))
    dealt = dealt.repartition(parts, "bucket")
    return dealt.sortWithinPartitions("bucket", "ahead", F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_first())


def key_of(sigs: np.ndarray) -> int:
    """A set's name, a signed long."""
    return int(np.uint64(xxh64_intdigest(sigs.tobytes())).view(np.int64))


def compare_edits(docs: DataFrame, chain: int = CHAIN, step: int = STEP, least: float = LIKE) -> DataFrame:
    """A row for each row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, component_id.

    component_id is the smallest doc_id reachable over near-duplicates, itself included. A null text is empty; texts without words are near each other only. Ties of doc_id are
    ordered by text; a null doc_id stands last and names no component. With one row, the next document is itself. Empty: no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("doc_id", "text")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, component_id long"
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    classes = near_duplicates(docs, least, chain, step).where("doc_id IS NOT NULL AND component_id <> doc_id")

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, out, held = None, [], 0
        of: dict = {}
        for x in batches:
            for bucket, doc_id, text, ahead, key, component in zip(*(c.to_pylist() for c in x.columns), strict=True):
                if text is None:
                    of = of if of.get("doc_id") == doc_id else {"doc_id": doc_id}
                    of[key] = component
                    continue
                sigs = signatures(text, chain, step)
                if last and last[0] == bucket:
                    new = edited(last[2], text)
                    e = last[3] if new == last[2] else signatures(new, chain, step)
                    f = fingerprint(last[3])
                    out.append((last[1], len(last[2]), sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), f, fingerprint(e), jaccard(last[3], e), jaccard(last[3], sigs), last[4]))
                    held += len(f)
                mine = of.get(key_of(sigs), doc_id) if of.get("doc_id") == doc_id and doc_id is not None else doc_id
                last = None if ahead else (bucket, doc_id, text, sigs, mine)
                if held > 4 << 20:
                    yield batch(out)
                    out, held = [], 0
        if out:
            yield batch(out)

    return with_next(docs, classes=classes).select("bucket", "doc_id", "text", "ahead", "key", "component_id").mapInArrow(run, schema)


def linked(sets: list[np.ndarray], least: float = LIKE) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (i, j) of the links among sorted sets of ``least`` Jaccard or more.

    Sets are compared with one centre after another. Jaccard distance is a metric: a set at distance r of the centre cannot be
    linked to what lies beyond r + 1 - least, so the members of a tight group are not compared again.
    """
    m, far = len(sets), 1 - least + 1e-9
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), size)
    kinds, at = np.unique(flat, return_inverse=True)
    order = np.argsort(at, kind="stable")
    member, first = owner[order], np.searchsorted(at[order], np.arange(len(kinds) + 1))
    ends = np.concatenate([[0], np.cumsum(size)])
    free, a, b = np.ones(m, bool), [], []

    def distance(i: int) -> np.ndarray:
        mine = at[ends[i] : ends[i + 1]]
        n = first[mine + 1] - first[mine]
        rows = member[np.repeat(first[mine], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        common = np.bincount(rows, minlength=m)
        return 1 - common / (size + size[i] - common)

    for c in range(m):
        if not free[c]:
            continue
        free[c] = False
        from_centre, waiting = distance(c), [c]
        while waiting:
            y = waiting.pop()
            outside = np.flatnonzero(free)
            if not len(outside) or from_centre[outside].min() - from_centre[y] > far:
                continue
            d = from_centre if y == c else distance(y)
            near = outside[d[outside] <= far]
            free[near] = False
            a += [y] * len(near)
            b += near.tolist()
            waiting += near.tolist()
    return np.array(a, np.int64), np.array(b, np.int64)


def _part(n: int, least: float) -> int:
    """The partition of a set length: two lengths within a factor ``least`` lie in one partition or in two neighbours."""
    return int(np.floor(np.log(n) / -np.log(least) + 1e-9))


def near_duplicates(docs: DataFrame, least: float = LIKE, chain: int = CHAIN, step: int = STEP, file: int = FILE) -> DataFrame:
    """(doc_id, key, component_id) for each row of docs: key names its set of signatures, component_id is the smallest doc_id reachable over sets of Jaccard >= least.

    Texts without signatures are near each other only. Files of more than ``file`` sets are cut into tiles by hash, and their pairs compared.
    """
    spark = docs.sparkSession
    prepare(spark)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            sigs = [signatures(t, chain, step) for t in x.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([x.column(0), pa.array([key_of(s) for s in sigs], pa.int64()), pa.array([s.tobytes() for s in sigs], pa.binary())], names=["doc_id", "key", "sigs"])

    folder = shared_dir(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(read, "doc_id long, key long, sigs binary")
    read_once = written(rows, f"{folder}/read")
    sets = written(read_once.where(F.octet_length("sigs") > 0).groupBy("key").agg(F.min("sigs").alias("sigs")), f"{folder}/sets")
    rows = written(read_once.select("doc_id", "key"), f"{folder}/rows")
    discard(spark, f"{folder}/read")
    common = _common(sets)

    def filed(some: int | None, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            sig, key, part = [], [], []
            for k, raw in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True):
                s = np.frombuffer(raw, np.uint32)
                n = len(s) - int(np.ceil(least * len(s) - 1e-9)) + 1
                at = np.searchsorted(common[0], s)
                often = np.where(common[0][np.minimum(at, len(common[0]) - 1)] == s, common[1][np.minimum(at, len(common[0]) - 1)], 0) if len(common[0]) else np.zeros(len(s), np.int64)
                chosen = s[np.lexsort((s, often))[: n if some is None else min(n, some)]].view(np.int32)
                sig.append(chosen)
                key.append(np.full(len(chosen), k, np.int64))
                part.append(np.full(len(chosen), _part(len(s), least), np.int32))
            cat = lambda parts, t: pa.array(np.concatenate(parts) if parts else [], t)
            yield pa.RecordBatch.from_arrays([cat(sig, pa.int32()), cat(part, pa.int32()), cat(key, pa.int64())], names=["sig", "part", "key"])

    schema = "sig int, part int, key long"
    edges = written(_compared(sets, sets.mapInArrow(partial(filed, FIRST), schema), None, least, file))
    roots = written(components(edges))
    more = written(_compared(sets, sets.mapInArrow(partial(filed, None), schema), roots, least, file))
    roots = written(components(edges.unionByName(more)))
    named = rows.select("doc_id", "key").join(roots, F.col("key") == F.col("node"), "left").select("doc_id", "key", F.coalesce("root", "key").alias("root"))
    low = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = written(named.join(written(low), "root").select("doc_id", "key", "component_id"))
    discard(spark, folder)
    return out


def _common(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, how often) of the COMMON most frequent ones, counted over all sets. Any order of signatures is right, if it is one for all sets; this one keeps files small. The rest come first in it, being rarer.

    Counts move as arrays, one for each of COUNTERS ranges of signatures, and each range returns its most frequent ones: no others can be among those of all.
    """
    names = ["bucket", "sigs", "n"]
    edges = np.arange(1, COUNTERS, dtype=np.uint64) * np.uint64((1 << 32) // COUNTERS)

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        sig, n = np.unique(np.concatenate([*held, np.empty(0, np.uint32)]), return_counts=True)
        ends = [0, *np.searchsorted(sig, edges).tolist(), len(sig)]
        rows = [(k, sig[i:j].tobytes(), n[i:j].astype(np.int64).tobytes()) for k, (i, j) in enumerate(zip(ends, ends[1:], strict=False)) if j > i]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=names)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for x in batches:
            held.append(np.frombuffer(b"".join(x.column(0).to_pylist()), np.uint32))
            size += len(held[-1])
            if size > 1 << 22:
                yield counted(held)
                held, size = [], 0
        yield counted(held)

    def top(x: pa.Table) -> pa.Table:
        sig, n = (np.frombuffer(b"".join(x.column(c).to_pylist()), t) for c, t in (("sigs", np.uint32), ("n", np.int64)))
        kinds, at = np.unique(sig, return_inverse=True)
        total = np.zeros(len(kinds), np.int64)
        np.add.at(total, at, n)
        most = np.lexsort((kinds.view(np.int32), -total))[:COMMON]
        most = most[total[most] > 1]
        return pa.table({"sig": pa.array(kinds[most].view(np.int32)), "n": pa.array(total[most])})

    seen = written(sets.select("sigs").mapInArrow(count, "bucket int, sigs binary, n binary").groupBy("bucket").applyInArrow(top, "sig int, n long"))
    listed = seen.orderBy(F.desc("n"), "sig").limit(COMMON).toArrow()
    sig, n = np.asarray(listed.column(0).combine_chunks(), np.int32).view(np.uint32), np.asarray(listed.column(1).combine_chunks(), np.int64)
    order = np.argsort(sig)
    return sig[order], n[order]


def _compared(sets: DataFrame, index: DataFrame, roots: DataFrame | None, least: float, file: int) -> DataFrame:
    """Edges (a, b) of forests of the links in the files of index(sig, part, key); with roots(node, root), only in files that hold sets of different components."""
    at, folder = ["sig", "part"], shared_dir(sets.sparkSession)
    # no side of these joins has a bound: they sort and merge at every size
    index = written(index, f"{folder}/all")
    if roots is not None:
        index = index.join(roots.hint("merge"), F.col("key") == F.col("node"), "left").select("sig", "part", "key", F.coalesce("root", "key").alias("root"))
    else:
        index = index.withColumn("root", F.col("key"))
    shared = index.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("sig")
    index = written(index.join(shared.hint("merge"), "sig"), f"{folder}/shared")  # most signatures are one set's own
    discard(sets.sparkSession, f"{folder}/all")
    filed = index.select("sig", "key", "root", F.explode(F.array(F.struct("part", F.lit(True).alias("home")), F.struct((F.col("part") + 1).alias("part"), F.lit(False).alias("home")))).alias("p")).select("sig", "p.part", "key", "root", "p.home")
    files = filed.groupBy(*at).agg(F.max("home").alias("own"), F.min("root").alias("low"), F.max("root").alias("high"), F.min("key").alias("owner")).where("own AND low <> high")
    # files with the same least member go together, so that a set moves once for each of them
    mine = written(filed.join(files.select(*at, "owner"), at).select("owner", "key").distinct(), f"{folder}/mine")
    tiles = mine.groupBy("owner").agg(F.ceil(F.count("*") / file).cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int")
    mine = mine.join(tiles, "owner").withColumn("tile", tile).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    group = ["owner", "x", "y"]
    mine = mine.select("owner", F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"), "key").join(sets.hint("merge"), "key")
    mine = mine.repartition(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), *group).sortWithinPartitions(*group, "key")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        last = None
        e: list[list[np.ndarray]] = [[], []]

        def close() -> None:
            if len(held) > 1:
                keys = np.array([k for k, _ in held], np.int64)
                i, j = linked([np.frombuffer(raw, np.uint32) for _, raw in held], least)
                e[0].append(keys[i])
                e[1].append(keys[j])

        for x in batches:
            for owner, p, q, key, raw in zip(*(x.column(c).to_pylist() for c in (*group, "key", "sigs")), strict=True):
                if (owner, p, q) != last:
                    close()
                    held, last = [], (owner, p, q)
                held.append((key, raw))
            if sum(map(len, e[0])) > 1 << 18:
                e = [[k] for k in forest(np.concatenate(e[0]), np.concatenate(e[1]))]
        close()
        a, b = forest(np.concatenate([*e[0], np.empty(0, np.int64)]), np.concatenate([*e[1], np.empty(0, np.int64)]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return mine.select(*group, "key", "sigs").mapInArrow(compare, "a long, b long")


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(table(spark, sf_dir, "documents"))
