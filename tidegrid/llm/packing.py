"""Packing of token sequences: shortest-pack-first over the histogram of lengths.

1. Each document is tokenized and cut into pieces of ``length`` tokens and one shorter rest.
2. The histogram of piece lengths has at most ``length`` rows, whatever the input; the driver packs it, longest
   length first, each into the pattern with the most room left (the shortest pack), and keeps counts of patterns, not packs.
3. Pieces get their rank within their length: a rank inside their partition plus the counts of that length in
   earlier partitions (joined by partition and length). Ranges of ranks map to patterns, hence to sequence and offset.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidegrid.llm.common import packed, prepare, written

LENGTH, END = 2048, 1


class Ids:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    The ids are those of the tokenizer's own call. A text without strings of its special tokens goes through its vocabulary read as ranks, by a faster
    encoder with the same pattern and merges; all others, and what that one refuses, go through the tokenizer itself. Tests compare both.
    """

    def __init__(self, path: str | None = None, ranks: str | None = None):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.encoding = None
        if ranks or not path:  # another tokenizer's ranks aren't known
            with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def exact(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, texts: list[str]) -> list[bytes]:
        out = []
        for t in texts:
            if self.encoding is None or any(s in t for s in self.special):
                out.append(self.exact(t))
                continue
            try:
                out.append(self.encoding.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes())
            except Exception:  # the pattern's backtracking limit, in texts of endless white space
                out.append(self.exact(t))
        return out


def pieces(docs: DataFrame, length: int = LENGTH, end: int | None = END, path: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): the tokens of each document, ``end`` after them, cut every ``length``. A null text is empty. Rows are as many as ceil(tokens / length)."""
    prepare(docs.sparkSession)
    tail = b"" if end is None else np.array([end], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids = Ids(path)
        for x in batches:
            out: list[tuple] = []
            for d, b in zip(x.column(0).to_pylist(), ids.of([t or "" for t in x.column(1).to_pylist()]), strict=True):
                b += tail
                out += [(d, k // 4, min(length, (len(b) - k) // 4), zlib.crc32(b[k : k + 4 * length]), len(b) // 4) for k in range(0, len(b), 4 * length)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(5)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def shortest_pack_first(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, list[int]]]:
    """Patterns (count, lengths in order) that hold histogram[l] pieces of each length l, each pattern at most ``length`` long in sum.

    Longest lengths first; pieces go to the patterns with the most room, as many at once as those patterns
    count, else to new packs.
    """
    room: dict[int, list[list]] = {}
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            most = max((r for r in room if room[r]), default=-1)
            if most < size:
                room.setdefault(length - size, []).append([left, [size]])
                left = 0
                continue
            count, lengths = room[most].pop()
            use = min(count, left)
            if count > use:
                room[most].append([count - use, lengths])
            room.setdefault(most - size, []).append([use, [*lengths, size]])
            left -= use
    return [(c, lengths) for r in sorted(room) for c, lengths in room[r]]


def padding(patterns: list[tuple[int, list[int]]], length: int = LENGTH) -> int:
    """Padded tokens: up to ``length``, none at a power of two."""
    return sum(c * (length - s) for c, x in patterns if (s := sum(x)) & (s - 1))


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """cut (columns ``length`` and others) with sequence_id, offset: gapless from 0 in each sequence.

    Other columns stay, whatever their names, repeated rows included; sequence_id and offset take the place of columns of those names. Empty: no rows.
    """
    keep, rows = cut.columns, packed(cut, "_piece")
    piece = rows.schema.fields[0]
    long = lambda name: T.StructField(name, T.LongType())

    def ranks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(length + 1, np.int64)
        for x in batches:
            sizes = np.asarray(x.column(0).field("length"), np.int64)
            order = np.argsort(sizes, kind="stable")
            kinds, first, n = np.unique(sizes[order], return_index=True, return_counts=True)
            rank = np.empty(len(sizes), np.int64)
            rank[order] = np.arange(len(sizes)) - np.repeat(first - seen[kinds], n)
            seen[kinds] += n
            yield pa.RecordBatch.from_arrays([x.column(0), pa.array(sizes), pa.array(np.full(len(sizes), part, np.int64)), pa.array(rank)], names=["_piece", "_size", "_part", "_rank"])

    ranked = written(rows.mapInArrow(ranks, T.StructType([piece, long("_size"), long("_part"), long("_rank")])))
    counts = written(ranked.groupBy("_part", "_size").agg(F.count("*").alias("_n")))
    patterns = shortest_pack_first({r[0]: r[1] for r in counts.groupBy("_size").agg(F.sum("_n")).collect()}, length)  # at most ``length`` rows
    slots: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for count, lengths in patterns:
        offset = 0
        for size in lengths:
            slots.setdefault(size, []).append((used.get(size, 0), sequence, offset))
            used[size] = used.get(size, 0) + count
            offset += size
        sequence += count
    at = {size: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for size, rows in slots.items()}

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            sizes, rank = np.asarray(x.column("_size")), np.asarray(x.column("_rank")) + np.asarray(x.column("_before"))
            sequence_id, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                begin, seq, off = at[size]
                k = np.searchsorted(begin, rank[rows], side="right") - 1
                sequence_id[rows], offset[rows] = seq[k] + rank[rows] - begin[k], off[k]
            yield pa.RecordBatch.from_arrays([x.column("_piece"), pa.array(sequence_id), pa.array(offset)], names=["_piece", "_sequence", "_offset"])

    before = F.sum("_n").over(Window.partitionBy("_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    first = written(counts.select("_part", "_size", F.coalesce(before, F.lit(0)).alias("_before")))
    # (partition, length) rows grow with the partitions: a merge join, never a broadcast
    placed = ranked.join(first.hint("merge"), ["_part", "_size"]).select("_piece", "_size", "_rank", "_before").mapInArrow(place, T.StructType([piece, long("_sequence"), long("_offset")]))
    rest = [F.col("_piece")[c].alias(c) for c in keep if c not in ("sequence_id", "offset")]
    return placed.select(*rest, F.col("_sequence").alias("sequence_id"), F.col("_offset").alias("offset"))
