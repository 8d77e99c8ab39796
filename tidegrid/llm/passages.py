"""Substring dedup by collinear chaining: fuzzy passages that repeat across documents.

1. Seeds: hashes of k words, those that ``every`` divides: what is chosen does not depend on the words around, so that
   equal words have equal seeds right up to an edit.
2. Each seed that more than one document has is tied to its first holder (least doc_id), never to all others: matches
   stay as many as seeds, whatever the number of holders. The n-th copy in a document is tied to the n-th that the
   holder has, counted from the front and from the back, or to its last or first one where it has fewer.
   Two seeds in a row (of those that others have) are tied in the same way to the first document that has both in a row, so that a
   passage whose seeds have other first holders one by one is tied to a document that has it.
   Texts are taken in chunks of ``CHUNK`` words. A chunk sends each of its different seeds once, with its own first holder, to the bucket that
   the seed's leading bits name; the bucket answers with the first holder of all. So there are no hot keys, and the chunk ties its documents by itself.
3. Of each pair (document, holder) the seed matches are chained in order with costs for gaps, by a Fenwick tree of prefix maxima.
4. Chains are aligned: exactly between seeds, by X-drop with gaps beyond the ends; one that is not like enough is cut at its worst gaps. A passage has ``least`` words or more and a likeness of ``like`` or more.
   Both texts come cut to MARGIN words around the chain; a chain whose alignment reaches such a cut is aligned again with whole texts.
5. Exact runs of ``least`` words don't depend on any of that. Halves (``least`` // 2 words) are seeds too, each window's least
   one; each window whose least half another document has is hashed whole and tied to its own first holder. So a passage
   whose parts have different holders is found in parts that overlap. What passages of step 4 cover between the same two documents is not repeated.
Only codes of words (32 bits) of documents that have a chain move, not their texts. Joins sort and merge at every size, as no side has a bound.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Generator, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidegrid.llm.common import discard, give_back, packed, prepare, shared_dir, table, words_of, written
from tidegrid.llm.lm import pack, steps, unpack

K, EVERY, LEAST, LIKE = 5, 2, 50, 0.8
GAP, MARGIN, DROP, PENALTY, BAND, FAR, BLOCK = 0.1, 64, 12, 3, 8, 4096, 1 << 16
FILTER_BITS, REMEMBERED = 23, 200_000
#: Words of a chunk, and of the texts for each bucket.
CHUNK, BUCKET = 1_000_000, 2_000_000
SENT = "chunk string, bucket long, n long, parts array<binary>"
_ARROW = pa.schema([("chunk", pa.string()), ("bucket", pa.int64()), ("n", pa.int64()), ("parts", pa.list_(pa.binary()))])
_BASE = 0x9E3779B97F4A7C15
PASSAGE = "doc_id long, text_key long, start int, end int, other_id long, other_start int, other_end int, likeness double"
_MIX = [np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) | 1) for j in range(64)]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        h = self[word] = xxh64_intdigest(word)
        return h


def codes(words: list[bytes], known: dict) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def seeds(h: np.ndarray, k: int = K, every: int = EVERY) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of those k-word hashes of word hashes h that ``every`` divides."""
    n = len(h) - k + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    x = np.zeros(n, np.uint64)
    for j in range(k):
        x += h[j : n + j] * _MIX[j]
    x = _mixed(x)
    at = np.flatnonzero(x % np.uint64(every) == 0)
    return x[at], at


def _powers(base: int, n: int, known: dict = {}) -> np.ndarray:  # noqa: B006
    """base ** 0, 1, ... n - 1 in 64 bits."""
    if len(known.get(base, ())) < n:
        known[base] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(max(n, 4096) * 2, base, np.uint64)]))
    return known[base][:n]


def runs_of(codes32: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each n codes in a row, at a cost that does not grow with n."""
    if len(codes32) < n:
        return np.empty(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes32.astype(np.uint64) * _powers(_BASE, len(codes32)), dtype=np.uint64)])
    x = (total[n:] - total[:-n]) * _powers(pow(_BASE, -1, 1 << 64), len(codes32) - n + 1)
    return _mixed(x)


def _slide(x: np.ndarray, n: int, least: np.ufunc) -> np.ndarray:
    """np.minimum or np.maximum of each n values in a row."""
    wide = 1
    while wide * 2 <= n:
        x, wide = least(x[:-wide], x[wide:]), wide * 2
    return least(x[: len(x) - (n - wide)], x[n - wide :]) if n > wide else x


def halves_of(codes32: np.ndarray, least: int, left: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the halves, the least of each window of ``least`` words, positions of halves that are the least of a window).

    ``left``: words from each place to the end of its text, where several texts follow each other.
    """
    half = least // 2
    x, n = runs_of(codes32, half), least - half + 1
    if len(x) < n:
        return x, np.empty(0, np.uint64), np.empty(0, np.int64)
    m = _slide(x, n, np.minimum)
    if left is not None:
        m[left[: len(m)] < least] = 0
    edge = np.zeros(n - 1, np.uint64)
    return x, m, np.flatnonzero(_slide(np.concatenate([edge, m, edge]), n, np.maximum) == x)


def chains(pos: list[int], other: list[int], weight: float = K, gap: float = GAP) -> list[list[int]]:
    """Indexes of matches (pos, other) in chains of two or more, both rising; each match is in one chain at most, the best chains first.

    The score of a chain is ``weight`` for each match less ``gap`` for each word stepped over in either text; as that cost is a
    difference of sums, the best predecessor is a prefix maximum, kept in a Fenwick tree over ``other``.
    """
    p, o = np.array(pos, np.int64), np.array(other, np.int64)
    if len(p) > 1 and (np.diff(p) > 0).all() and (np.diff(o) > 0).all() and (weight * np.arange(1, len(p)) > gap * (p + o - p[0] - o[0])[1:]).all():
        return [list(range(len(pos)))]  # all rise together: each follows the one before
    order = sorted(range(len(pos)), key=lambda i: (pos[i], -other[i]))
    rank = {v: r + 1 for r, v in enumerate(sorted(set(other)))}
    size = len(rank)
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)
    score, back = [0.0] * len(pos), [-1] * len(pos)
    for i in order:
        r, best = rank[other[i]] - 1, (-1e18, -1)
        while r:
            if tree[r] > best:
                best = tree[r]
            r -= r & -r
        carried = best[0] - gap * (pos[i] + other[i])
        score[i] = weight
        if best[1] >= 0 and carried > 0:
            score[i] += carried
            back[i] = best[1]
        entry, r = (score[i] + gap * (pos[i] + other[i]), i), rank[other[i]]
        while r <= size:
            if entry > tree[r]:
                tree[r] = entry
            r += r & -r
    used, out = set(), []
    for i in sorted(range(len(pos)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and i not in used:
            used.add(i)
            chain.append(i)
            i = back[i]
        if len(chain) > 1:
            out.append(chain[::-1])
    return out


def _matches(a: np.ndarray, b: np.ndarray, far: int | None = FAR) -> int:
    """Most words of a and b that agree in order (longest common subsequence), by rows of bits: a long integer holds a row of BLOCK words of the shorter one; what a row carries goes to the next block.

    0 where both have more than ``far`` words; None: no bound.
    """
    if len(a) == len(b) and (a == b).all():
        return len(a)
    if far is not None and min(len(a), len(b)) > far:
        return 0
    if len(b) > len(a):
        a, b = b, a
    words, carry, out = a.tolist(), bytearray(len(a)), 0
    both = set(words)
    for start in range(0, len(b), BLOCK):
        part = b[start : start + BLOCK].tolist()
        at: dict[int, int] = {}
        for k, x in enumerate(part):
            if x in both:
                at[x] = at.get(x, 0) | 1 << k
        full = (1 << len(part)) - 1
        row = full
        for i, x in enumerate(words):
            m = at.get(x)
            if m or carry[i]:
                u = row & (m or 0)
                total = row + u + carry[i]
                carry[i] = total >> len(part)
                row = (total | (row - u)) & full
        out += len(part) - row.bit_count()
    return out


def _run(a: np.ndarray, b: np.ndarray) -> int:
    """Equal words at the start of a and b."""
    n, k, step = min(len(a), len(b)), 0, 64
    while k < n:
        differ = np.flatnonzero(a[k : min(n, k + step)] != b[k : min(n, k + step)])
        if len(differ):
            return k + int(differ[0])
        k, step = k + step, step * 4
    return n


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(words of a, words of b, matches) of the best common start of a and b: see ``_extensions``."""
    return _extensions([(a, b)])[0]


def _extensions(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int]]:
    """(words of a, words of b, matches) of the best common start of each pair a, b: +1 a match, -PENALTY a word changed, added or left out, at most BAND words apart, until the score drops by DROP.

    Equal words are run over at once; where 2 BAND of them follow a new best place, the alignment starts anew from there.
    """
    out, on = [(0, 0, 0)] * len(pairs), range(len(pairs))
    while on:
        differ = []
        for x in on:
            (a, b), (i, j, m) = pairs[x], out[x]
            n = _run(a[i:], b[j:])
            out[x] = i + n, j + n, m + n
            if i + n < len(a) and j + n < len(b):
                differ.append(x)
        on = []
        for x, (i, j, m, more) in zip(differ, _bridges([(pairs[x][0][out[x][0] :], pairs[x][1][out[x][1] :]) for x in differ]), strict=True):
            out[x] = out[x][0] + i, out[x][1] + j, out[x][2] + m
            if more:
                on.append(x)
    return out


def _bridges(pairs: list[tuple[np.ndarray, np.ndarray]], most: int = 512, block: int = 32) -> list[tuple[int, int, int, bool]]:
    """(words of a, words of b, matches, whether equal words follow) of the best common start of each pair, which begins with a difference; all pairs go word by word together."""
    one, wide = 1 << 32, 2 * BAND + 1  # scores in the high half, matches in the low one
    fall, lost = PENALTY * one * np.arange(wide), PENALTY * one
    out = [(0, 0, 0, False)] * len(pairs)
    ids = np.arange(len(pairs))
    # each line is kept with ``fall`` added, so that words added are a running maximum
    line = np.tile(np.where(np.arange(wide) >= BAND, BAND * lost, -(one << 28)), (len(pairs), 1))
    best, at_a, at_b = (np.zeros(len(pairs), np.int64) for _ in range(3))
    for start in range(0, most, block):
        ends = np.array([min(most, len(pairs[x][0])) for x in ids.tolist()], np.int64)
        mine = np.full((len(ids), block + 2 * BAND), -3, np.int64)
        others = np.full((len(ids), block + 4 * BAND), -1, np.int64)
        for r, x in enumerate(ids.tolist()):
            part = pairs[x][0][start : start + mine.shape[1]]
            mine[r, : len(part)] = part
            low = start - BAND
            part = pairs[x][1][max(low, 0) : low + others.shape[1]]
            others[r, max(-low, 0) : max(-low, 0) + len(part)] = part
            others[r, : max(-low, 0)] = -2
        equal = np.lib.stride_tricks.sliding_window_view(others, wide, axis=1) == mine[:, :, None]
        gains = np.where(equal[:, :block], one + 1, -lost)
        total = np.cumsum(equal, axis=1, dtype=np.int16)
        live = np.ones(len(ids), bool)
        for i in range(block):
            new = line + gains[:, i]
            np.maximum(new[:, :-1], line[:, 1:] - 2 * lost, out=new[:, :-1])
            line = np.maximum.accumulate(new, axis=1)
            scores = line - fall
            j = scores.argmax(axis=1)
            rows = np.arange(len(ids))
            top = scores[rows, j]
            better = live & (top >> 32 > best >> 32)
            over = live & ~better & ((best >> 32) - (top >> 32) > DROP)
            best[better] = top[better]
            at_a[better], at_b[better] = start + i + 1, start + i + 1 + j[better] - BAND
            goes_on = better & (at_b > 0) & (total[rows, i + 2 * BAND, j] - total[rows, i, j] == 2 * BAND)
            over |= goes_on | live & (start + i + 1 >= ends)
            if over.any():
                for r in np.flatnonzero(over).tolist():
                    out[ids[r]] = int(at_a[r]), int(at_b[r]), int(best[r]) & (one - 1), bool(goes_on[r])
                live &= ~over
                if 2 * live.sum() <= len(live):
                    if not live.any():
                        return out
                    ids, line, best, at_a, at_b, ends, gains, total, live = (x[live] for x in (ids, line, best, at_a, at_b, ends, gains, total, live))
        ids, line, best, at_a, at_b = (x[live] for x in (ids, line, best, at_a, at_b))
        if not len(ids):
            break
    return out


def align(a: np.ndarray, b: np.ndarray, pos: list[int], other: list[int], least: int = LEAST, like: float = LIKE, k: int = K, edges: tuple[bool, ...] = (False,) * 4) -> list[tuple[int, int, int, int, float]] | None:
    """(start, end, other start, other end, likeness) of the passages that a chain of matches holds in the word codes a and b: see ``_aligned``."""
    return align_all([(a, b, pos, other, edges)], least, like, k)[0]


def align_all(chains: list[tuple], least: int = LEAST, like: float = LIKE, k: int = K) -> list[list[tuple[int, int, int, int, float]] | None]:
    """What ``align`` gives for each (a, b, pos, other, edges), their extensions made together."""
    out: list = [None] * len(chains)
    on = [(i, _aligned(*c[:4], least, like, k, c[4])) for i, c in enumerate(chains)]
    wanted = [next(x) for _, x in on]
    while on:
        done = iter(_extensions([p for w in wanted for p in w]))
        again, wants = [], []
        for (i, x), w in zip(on, wanted, strict=True):
            try:
                wants.append(x.send([next(done) for _ in w]))
                again.append((i, x))
            except StopIteration as end:
                out[i] = end.value
        on, wanted = again, wants
    return out


def _aligned(a: np.ndarray, b: np.ndarray, pos: list[int], other: list[int], least: int, like: float, k: int, edges: tuple[bool, ...]) -> Generator[list, list, list | None]:
    """Alignment of a chain of matches; yields pairs to extend and is sent their extensions.

    A chain that is not like enough as a whole, with or without its extended ends, is cut at the link that leaves most words
    unmatched; both parts are judged in the same way. A part has two matches or more and extends no further than its neighbours.
    ``edges``: whether a was cut before and behind, and b; None if an alignment comes so near to such a cut that it might go on.
    """
    same = []
    for i in range(len(pos) - 1):
        d, o = pos[i + 1] - pos[i], other[i + 1] - other[i]
        step = min(k, d, o)
        same.append(d if d == o and d <= k else step + _matches(a[pos[i] + step : pos[i + 1]], b[other[i] + step : other[i + 1]], None))
    lost = np.maximum(np.diff(pos), np.diff(other)) - np.array(same, np.int64)
    before, out, parts = np.concatenate([[0], np.cumsum(same)]), [], [(0, len(pos) - 1)]
    close = DROP + BAND
    while parts:
        pairs = []
        for i, j in parts:
            s, t, e, f = pos[i], other[i], pos[j] + k, other[j] + k
            pairs.append((a[pos[i - 1] + k if i else 0 : s][::-1], b[other[i - 1] + k if i else 0 : t][::-1]))
            pairs.append((a[e : pos[j + 1] if j + 1 < len(pos) else None], b[f : other[j + 1] if j + 1 < len(pos) else None]))
        found, now, parts = iter((yield pairs)), parts, []
        for i, j in now:
            s, t, e, f, m = pos[i], other[i], pos[j] + k, other[j] + k, int(before[j] - before[i]) + k
            (left, back, ml), (right, ahead, mr) = next(found), next(found)
            if not i and (edges[0] and s - left < close or edges[2] and t - back < close):
                return None
            if j + 1 == len(pos) and (edges[1] and len(a) - e - right < close or edges[3] and len(b) - f - ahead < close):
                return None
            tries = ((s - left, e + right, t - back, f + ahead, m + ml + mr), (s, e, t, f, m))
            good = [(*x[:4], x[4] / max(x[1] - x[0], x[3] - x[2])) for x in tries if x[4] >= like * max(x[1] - x[0], x[3] - x[2])]
            if good:
                out += [x for x in good if x[1] - x[0] >= least][:1]
            elif j - i > 1 and lost[i:j].max() > 0:
                cut = i + int(lost[i:j].argmax())
                parts += [p for p in ((i, cut), (cut + 1, j)) if p[1] > p[0]]
    return sorted(out)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each of the stretches (start, size), one after the other."""
    sizes = sizes.astype(np.int64)
    return np.repeat(starts.astype(np.int64) - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)


class Sorted:
    """Keys in order, equal ones in the order that they came in: ``order`` sorts them, a run of equal ones begins at each of ``starts``, ``run`` is each key's."""

    def __init__(self, x: np.ndarray):
        self.order = np.argsort(x, kind="stable")
        self.x = x[self.order]
        fresh = np.ones(len(x), bool)
        fresh[1:] = self.x[1:] != self.x[:-1]
        self.starts = np.flatnonzero(fresh)
        self.ends = np.append(self.starts[1:], len(x))
        self.run = np.cumsum(fresh) - 1

    def sent(self, chunk: str, ids: np.ndarray, places: np.ndarray, buckets: int) -> Iterator[tuple]:
        """Rows SENT for the buckets: each different key once, with the first of the documents ``ids`` (of each key as it came, rising within equal ones), whether there is another, and the places it has there."""
        x, ids = self.x[self.starts], ids[self.order]
        first = ids[self.starts]
        several, holds = ids[self.ends - 1] != first, ids == first[self.run]
        n = np.bincount(self.run[holds], minlength=len(x))
        places, ends = places[self.order][holds], np.concatenate([[0], np.cumsum(n)])
        of = (x >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                yield chunk, int(of[a]), b - a, [pack(steps(x[a:b])), pack(first[a:b].view(np.uint64)), np.packbits(several[a:b]).tobytes(), pack(n[a:b]), pack(places[ends[a] : ends[b]])]


def _answer(rows: pa.Table) -> pa.Table:
    """One bucket: for each chunk, of the keys it sent, which two documents have, the first of them, and the places it has there."""
    size, parts = rows.column("n").to_pylist(), rows.column("parts").to_pylist()
    x = np.concatenate([np.cumsum(unpack(p[0], n), dtype=np.uint64) for p, n in zip(parts, size, strict=True)])
    ids = np.concatenate([unpack(p[1], n) for p, n in zip(parts, size, strict=True)]).view(np.int64)
    several = np.concatenate([np.unpackbits(np.frombuffer(p[2], np.uint8), count=n) for p, n in zip(parts, size, strict=True)])
    n = [unpack(p[3], n).astype(np.int64) for p, n in zip(parts, size, strict=True)]
    places = np.concatenate([unpack(p[4], int(m.sum())) for p, m in zip(parts, n, strict=True)])
    n = np.concatenate(n)
    s = Sorted(x)
    first = np.minimum.reduceat(ids[s.order], s.starts)
    shared = (np.maximum.reduceat(ids[s.order], s.starts) != first) | (np.maximum.reduceat(several[s.order], s.starts) > 0)
    on = shared[s.run] & (ids[s.order] == first[s.run])
    held, run = s.order[on], s.run[on]
    at, run = places[_spread((np.cumsum(n) - n)[held], n[held])], np.repeat(run, n[held])
    at = at[np.lexsort((at, run))]
    many = np.bincount(run, minlength=len(first))
    begin, mine, out = np.cumsum(many) - many, np.empty(len(x), np.int64), []
    mine[s.order] = s.run
    chunks, bucket, end = rows.column("chunk").to_pylist(), rows.column("bucket")[0].as_py(), 0
    for chunk, k in zip(chunks, size, strict=True):
        u = mine[end : end + k]
        end += k
        there = shared[u]
        u = u[there]
        out.append((chunk, bucket, k, [np.packbits(there).tobytes(), pack(first[u].view(np.uint64)), pack(many[u]), pack(at[_spread(begin[u], many[u])])]))
    return _rows(out)


def _told(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all answers to a chunk, in the order of its keys: which are shared; of each key the first holder, its number of places there and where they begin in the last: the places."""
    told = sorted((b, n, p) for b, n, p in zip(*(rows.column(c).to_pylist() for c in ("bucket", "n", "parts")), strict=True) if b >= 0)
    there = [np.unpackbits(np.frombuffer(p[0], np.uint8), count=n).astype(bool) for _, n, p in told]
    size = [int(t.sum()) for t in there]
    many = [unpack(p[2], n).astype(np.int64) for (_, _, p), n in zip(told, size, strict=True)]
    places = np.concatenate([np.empty(0, np.uint64), *(unpack(p[3], int(m.sum())) for (_, _, p), m in zip(told, many, strict=True))])
    shared = np.concatenate([np.empty(0, bool), *there])
    first, n = np.zeros(len(shared), np.int64), np.zeros(len(shared), np.int64)
    first[shared] = np.concatenate([np.empty(0, np.uint64), *(unpack(p[1], n) for (_, _, p), n in zip(told, size, strict=True))]).view(np.int64)
    n[shared] = np.concatenate([np.empty(0, np.int64), *many])
    return shared, first, n, np.cumsum(n) - n, places


class Chunk:
    """Documents in order of id: ids, keys of their texts, numbers of words, and the codes of all words."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, sizes: np.ndarray, codes32: np.ndarray):
        self.ids, self.keys, self.sizes, self.codes = ids, keys, sizes, codes32

    @classmethod
    def of(cls, docs: list[tuple[int, int, np.ndarray]]) -> Chunk:
        docs = sorted(docs, key=lambda d: d[:2])
        return cls(np.array([d[0] for d in docs], np.int64), np.array([d[1] for d in docs], np.int64), np.array([len(d[2]) for d in docs], np.int64), np.concatenate([d[2] for d in docs]))

    def head(self) -> list[bytes]:
        words, at, n = np.unique(self.codes, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return [self.ids.tobytes(), self.keys.tobytes(), self.sizes.tobytes(), words[order].tobytes(), pack(rank[at])]

    @classmethod
    def read(cls, parts: list[bytes]) -> Chunk:
        """From what head() gives."""
        ids, keys, sizes = (np.frombuffer(p, np.int64) for p in parts[:3])
        return cls(ids, keys, sizes, np.frombuffer(parts[3], np.uint32)[unpack(parts[4], int(sizes.sum())).astype(np.int64)])

    def sow(self, k: int, every: int, least: int) -> None:
        """``keys_of``: seeds, then halves; ``doc`` (number) and ``pos`` of each, ``seeds`` of them are seeds."""
        begin = np.cumsum(self.sizes) - self.sizes
        doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        left = (begin + self.sizes)[doc] - np.arange(len(doc))
        x, at = seeds(self.codes.astype(np.uint64), k, every)
        whole = left[at] >= k
        y, _, of = halves_of(self.codes, least, left)
        of = of[left[of] >= least // 2]
        self.seeds, at = int(whole.sum()), np.concatenate([at[whole], of])
        self.keys_of, self.doc = np.concatenate([x[whole], y[of]]), doc[at]
        self.pos = at - begin[self.doc]


def _sieve(bits: DataFrame, size: int):
    """Broadcast filter of 2 ** size bits, those of the column ``bit`` set: fixed in size, whatever the data."""
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (size - 6), np.int64)
    out[np.asarray(words.column(0).combine_chunks(), np.int64)] = np.asarray(words.column(1).combine_chunks(), np.int64)
    return bits.sparkSession.sparkContext.broadcast(out)


def _passes(sieve: np.ndarray, bit: np.ndarray) -> np.ndarray:
    bit = bit.astype(np.int64)
    return (sieve[bit >> 6] >> (bit & 63)) & 1 == 1


def _twos(doc: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first, hash) of seeds two in a row of the same document."""
    at = np.flatnonzero(doc[1:] == doc[:-1])
    return at, _mixed(seed[at] * _MIX[0] + seed[at + 1] * _MIX[1])


def _chained(doc: np.ndarray, holder: np.ndarray, pos: np.ndarray, other: np.ndarray, k: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """(place of a match, pos, other) of the chains of sorted matches (doc, holder, pos, other), each counted once.

    Where all matches of two documents rise together and each follows the one before, as chains() has it, that is the chain.
    """
    if not len(doc):
        return
    same = (doc[1:] == doc[:-1]) & (holder[1:] == holder[:-1])
    once = np.concatenate([[True], ~(same & (pos[1:] == pos[:-1]) & (other[1:] == other[:-1]))])
    place = np.flatnonzero(once)
    pos, other = pos[once], other[once]
    fresh = np.concatenate([[True], ~same])[once]
    starts = np.flatnonzero(fresh)
    ends = np.append(starts[1:], len(pos))
    begin = starts[np.cumsum(fresh) - 1]
    n = np.arange(len(pos)) - begin
    rises = fresh.copy()
    rises[1:] |= (pos[1:] > pos[:-1]) & (other[1:] > other[:-1])
    rises &= fresh | (k * n > GAP * (pos + other - pos[begin] - other[begin]))
    straight = np.logical_and.reduceat(rises, starts)
    for s, e, line in zip(starts.tolist(), ends.tolist(), straight.tolist(), strict=True):
        if e - s > 1:
            p, o = pos[s:e].tolist(), other[s:e].tolist()
            if line:
                yield int(place[s]), p, o
            else:
                for c in chains(p, o, k):
                    yield int(place[s]), [p[i] for i in c], [o[i] for i in c]


def find(docs: DataFrame, k: int = K, every: int = EVERY, least: int = LEAST, like: float = LIKE) -> DataFrame:
    """(doc_id, text_key, start, end, other_id, other_start, other_end, likeness): passages, in words, that doc_id shares with an earlier document.

    Words are lower-cased. Null and shorter texts and null ids hold no passages. Rows with an equal doc_id are never compared with
    each other; text_key (xxhash64 of the text) tells to which of them a row belongs.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, size = _Hashes(), [], 0
        for x in batches:
            for d, key, t in zip(*(x.column(i).to_pylist() for i in range(3)), strict=True):
                w = words_of(t.lower())
                if len(w) >= least * like:
                    docs.append((d, key, codes(w, known).astype(np.uint32)))
                    size += len(w)
                if size >= CHUNK:
                    yield from _rows([(uuid.uuid4().hex, -1, size, Chunk.of(docs).head())]).to_batches()
                    docs, size = [], 0
        if docs:
            yield from _rows([(uuid.uuid4().hex, -1, size, Chunk.of(docs).head())]).to_batches()
        docs = []
        known.clear()
        give_back()

    passing = shared_dir(spark)
    chunks = written(rows.select("doc_id", F.xxhash64("text").alias("key"), "text").mapInArrow(encode, SENT), f"{passing}/chunks")
    count, words = chunks.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets, parts = min(words // BUCKET + 1, 1 << 31), int(spark.conf.get("spark.sql.shuffle.partitions"))

    def answered(sent: DataFrame) -> DataFrame:
        return sent.repartition(max(parts, buckets // 2), "bucket").groupBy("bucket").applyInArrow(_answer, SENT)

    def by_chunk(heads: DataFrame, told: DataFrame):
        return heads.unionByName(told).repartition(max(parts, count // 2), "chunk").groupBy("chunk")

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for chunk, head in zip(x.column(0).to_pylist(), x.column(3).to_pylist(), strict=True):
                c = Chunk.read(head)
                c.sow(k, every, least)
                yield from _rows(list(Sorted(c.keys_of).sent(chunk, c.ids[c.doc], c.pos, buckets))).to_batches()
        give_back()

    def match(rows: pa.Table) -> pa.Table:
        """Of a chunk: the matches of its seeds and the line of its shared seeds (bucket -1), its shared halves (-2), and seeds two in a row for the buckets."""
        at = rows.column("bucket").to_pylist().index(-1)
        chunk, c = rows.column("chunk")[at].as_py(), Chunk.read(rows.column("parts")[at].as_py())
        c.sow(k, every, least)
        s, (shared, first, n, begin, places) = Sorted(c.keys_of), _told(rows)
        on = shared[s.run]
        i, run = s.order[on], s.run[on]
        half = i >= c.seeds
        out = [(chunk, -2, int(half.sum()), [c.ids[c.doc[i[half]]].tobytes(), c.keys_of[i[half]].tobytes()])]
        i, run = i[~half], run[~half]
        doc, pos, holder = c.doc[i], c.pos[i], first[run]
        # equal seeds of a document before and after each
        fresh = np.ones(len(i), bool)
        fresh[1:] = (run[1:] != run[:-1]) | (doc[1:] != doc[:-1])
        starts, copy = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        before = np.arange(len(i)) - starts[copy]
        after = np.append(starts[1:], len(i))[copy] - 1 - np.arange(len(i))
        m = np.flatnonzero(c.ids[doc] != holder)
        last, begin = n[run[m]] - 1, begin[run[m]]
        others = places[begin + np.minimum(before[m], last)], places[begin + np.maximum(last - after[m], 0)]
        two = m[others[0] != others[1]]
        rows_of = np.concatenate([m, two])
        matches = doc[rows_of], holder[rows_of].view(np.uint64), pos[rows_of], np.concatenate([others[0], others[1][others[0] != others[1]]])
        line = np.lexsort((c.keys_of[i], pos, doc))
        line = doc[line], holder[line].view(np.uint64), pos[line], c.keys_of[i][line]
        out.append((chunk, -1, len(rows_of), [np.int64(len(i)).tobytes(), c.ids.tobytes(), *map(pack, matches), *map(pack, line)]))
        i, x = _twos(line[0], line[3])
        out += Sorted(x).sent(chunk, c.ids[line[0][i]], line[2][i] << 32 | line[2][i + 1], buckets)
        give_back()
        return _rows(out)

    def chain(rows: pa.Table) -> pa.Table:
        at = rows.column("bucket").to_pylist().index(-1)
        n, head = rows.column("n")[at].as_py(), rows.column("parts")[at].as_py()
        lines, ids = int.from_bytes(head[0], "little"), np.frombuffer(head[1], np.int64)
        doc, holder, pos, other = (unpack(p, n).view(np.int64) for p in head[2:6])
        line, held, place, seed = (unpack(p, lines).view(np.int64) for p in head[6:])
        i, x = _twos(line, seed.view(np.uint64))
        s, (shared, first, _, begin, places) = Sorted(x), _told(rows)
        on = shared[s.run]
        i, run = i[s.order[on]], s.run[on]
        new = (ids[line[i]] != first[run]) & ((held[i] != first[run]) | (held[i + 1] != first[run]))
        i, run = i[new], run[new]
        there = places[begin[run]].view(np.int64)
        doc, holder = np.concatenate([doc, line[i], line[i]]), np.concatenate([holder, first[run], first[run]])
        pos, other = np.concatenate([pos, place[i], place[i + 1]]), np.concatenate([other, there >> 32, there & 0xFFFFFFFF])
        order = np.lexsort((other, pos, holder, doc))
        doc, holder, pos, other = (x[order] for x in (doc, holder, pos, other))
        out = list(_chained(doc, holder, pos, other, k))
        give_back()
        ints = pa.list_(pa.int32())
        return pa.table([pa.array(ids[doc[[o[0] for o in out]]]), pa.array(holder[[o[0] for o in out]]), pa.array([o[1] for o in out], ints), pa.array([o[2] for o in out], ints)], names=["doc", "first", "pos", "other"])

    def halved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for docs, halves in x.column(3).to_pylist():
                docs, halves = np.frombuffer(docs, np.int64), np.frombuffer(halves, np.int64)
                order = np.lexsort((halves, docs))
                size = len(docs)
                docs, starts = np.unique(docs[order], return_index=True)
                lists = pa.ListArray.from_arrays(np.append(starts, size).astype(np.int32), halves[order])
                yield pa.RecordBatch.from_arrays([pa.array(docs), lists], names=["doc", "halves"])

    told = written(answered(chunks.mapInArrow(send, SENT)), f"{passing}/told")
    matched = written(by_chunk(chunks, told).applyInArrow(match, SENT), f"{passing}/matched")
    discard(spark, f"{passing}/told")
    halves = written(matched.where("bucket = -2").mapInArrow(halved, "doc long, halves array<long>"))
    told = written(answered(matched.where("bucket >= 0")), f"{passing}/told_twos")
    found = by_chunk(matched.where("bucket = -1"), told)
    found = written(found.applyInArrow(chain, "doc long, first long, pos array<int>, other array<int>"))
    needed = found.select(F.explode(F.array("doc", "first")).alias("d")).union(halves.select("doc")).select(F.shiftrightunsigned(F.xxhash64("d"), 64 - FILTER_BITS).alias("bit"))
    needed = _sieve(needed, FILTER_BITS)

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for head in x.column(3).to_pylist():
                c = Chunk.read(head)
                ends = np.cumsum(c.sizes)
                bit = np.array([xxh64_intdigest(d.tobytes(), 42) >> (64 - FILTER_BITS) for d in c.ids], np.int64)  # Spark's xxhash64
                keep = np.flatnonzero(_passes(needed.value, bit))
                texts = [c.codes[ends[i] - c.sizes[i] : ends[i]].tobytes() for i in keep.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(c.ids[keep]), pa.array(c.keys[keep]), pa.array(texts, pa.binary())], names=["id", "key", "codes"])
        give_back()

    codes_of = written(chunks.mapInArrow(split, "id long, key long, codes binary"))
    discard(spark, passing)

    def aligned(chosen: DataFrame, margin: int | None) -> DataFrame:
        """Passages of chains (doc, first, pos, other); with a margin, chains that reach a cut come back with doc_id null and their pos and other."""
        mine = chosen.join(codes_of.select(F.col("id").alias("doc"), F.col("key").alias("text_key"), "codes").hint("merge"), "doc")
        both = mine.select("doc", "text_key", "first", "pos", "other", *_cut("pos", "low", "a", "before", k, margin))
        both = both.join(codes_of.select(F.col("id").alias("first"), "codes").hint("merge"), "first")
        both = both.select("doc", "text_key", "first", "pos", "other", "low", "a", "before", "behind_a", *_cut("other", "other_low", "b", "before_b", k, margin))
        return both.mapInArrow(partial(compare, margin is not None), f"{PASSAGE}, runs array<int>, doc long, first long, pos array<int>, other array<int>")

    enough = int(like * like * least)  # a passage's share within the margins may be less like than the whole

    def compare(again: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            out, of, tried = [], [], []
            names = ("doc", "text_key", "first", "pos", "other", "low", "a", "before", "behind_a", "other_low", "b", "before_b", "behind_b")
            for d, key, f, pos, other, base, a, cut, cut_end, low, b, cut_b, cut_b_end in zip(*(x.column(c).to_pylist() for c in names), strict=True):
                a, b = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
                p, o = np.array(pos) - base, np.array(other) - low
                if p[-1] + k > len(a) or o[-1] + k > len(b):
                    continue  # the match is of another row with this doc_id
                if (a[np.add.outer(p, np.arange(k))] != b[np.add.outer(o, np.arange(k))]).any():
                    continue  # so is this one
                if sum(map(set(b.tolist()).__contains__, a.tolist())) < enough:
                    continue  # no passage here, however the words are ordered
                of.append((d, key, f, pos, other, base, low, p, o))
                tried.append((a, b, p.tolist(), o.tolist(), (cut, cut_end, cut_b, cut_b_end) if again else (False,) * 4))
            for (d, key, f, pos, other, base, low, p, o), (a, b, *_), found in zip(of, tried, align_all(tried, least, like, k), strict=True):
                if found is None:
                    out.append((None,) * 9 + (d, f, pos, other))
                elif found:
                    runs = [x + base for x in _equal(a, b, p, o, least)]
                    out += [(d, key, s + base, e + base, f, t + low, u + low, likeness, runs) + (None,) * 4 for s, e, t, u, likeness in found]
            ints = pa.list_(pa.int32())
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), ints, pa.int64(), pa.int64(), ints, ints)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["doc_id", "text_key", "start", "end", "other_id", "other_start", "other_end", "likeness", "runs", "doc", "first", "pos", "other"])
        give_back()

    near = written(aligned(found, MARGIN))
    columns = [c.split()[0] for c in PASSAGE.split(", ")]
    wider = aligned(near.where("doc IS NOT NULL").select("doc", "first", "pos", "other").distinct(), None).select(*columns, "runs")
    chained = written(near.where("doc_id IS NOT NULL").select(*columns, "runs").unionByName(wider).distinct())
    done = chained.select(*columns).distinct()
    return done.unionByName(exact(codes_of.join(halves.hint("merge"), F.col("id") == F.col("doc")), chained, least))


def _equal(a: np.ndarray, b: np.ndarray, p: np.ndarray, o: np.ndarray, least: int) -> list[int]:
    """[start, end, start, end, ...] in a of the runs of ``least`` words or more that a chain's matches (p, o) have word for word in b."""
    out: list[tuple[int, int]] = []
    for d in np.unique(p - o).tolist():
        lo, hi = max(0, d), min(len(a), len(b) + d)
        if hi - lo < least:
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[False], a[lo:hi] == b[lo - d : hi - d], [False]]).astype(np.int8)))
        out += [(lo + s, lo + e) for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True) if e - s >= least]
    return [x for span in sorted(set(out)) for x in span]


def _cut(places: str, low: str, codes: str, before: str, k: int, margin: int | None) -> list[F.Column]:
    """The words of ``codes`` around a chain's places, the first one's number, and whether words are left out before and behind."""
    at = F.greatest(F.element_at(places, 1) - margin, F.lit(0)) if margin is not None else F.lit(0)
    words = F.octet_length("codes") / 4
    end = F.least(F.element_at(places, -1) + k + margin, words) if margin is not None else words
    part = F.substring("codes", (4 * at + 1).cast("int"), (4 * (end - at)).cast("int"))
    return [at.alias(low), part.alias(codes), (at > 0).alias(before), (end < words).alias(f"behind_{codes}")]


def exact(shared: DataFrame, chained: DataFrame, least: int) -> DataFrame:
    """Runs of ``least`` words or more that an earlier document has word for word, less those within passages ``chained`` of the same two documents; shared(id, key, codes, halves) has the hashes of halves that other documents have too.

    Windows within a run that the document is known to have of an earlier one (``runs`` of chained) are left out: that document has them too, or
    has them in turn of a still earlier one, and the first holder of all leaves none out. So no class of holders falls apart.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for d, key, c, h, spans in zip(*(x.column(n).to_pylist() for n in ("id", "key", "codes", "halves", "known")), strict=True):
                c = np.frombuffer(c, np.uint32)
                x_least = halves_of(c, least)[1]
                on = np.isin(x_least.view(np.int64), np.array(h, np.int64))
                for runs in spans or ():
                    for s, e in zip(runs[::2], runs[1::2], strict=True):
                        on[s : e - least + 1] = False
                at = np.flatnonzero(on)
                run = runs_of(c, least)[at] if len(at) else np.empty(0, np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(run.view(np.int64)), pa.array(np.full(len(at), d, np.int64)), pa.array(np.full(len(at), key, np.int64)), pa.array(at.astype(np.int32))], names=["run", "doc", "key", "pos"])

    known = chained.where(F.size("runs") > 0).groupBy(F.col("doc_id").alias("of"), F.col("text_key").alias("text")).agg(F.collect_set("runs").alias("known"))
    shared = shared.join(known.hint("merge"), (F.col("id") == F.col("of")) & (F.col("key") == F.col("text")), "left").select("id", "key", "codes", "halves", "known")
    windows = written(shared.mapInArrow(cut, "run long, doc long, key long, pos int"))
    held = windows.groupBy("run").agg(F.min(F.struct("doc", "pos")).alias("first"), F.max("doc").alias("last")).where("first.doc <> last")
    later = windows.join(held.hint("merge"), "run").where("doc <> first.doc")
    later = later.groupBy("doc", "key").agg(F.collect_set(F.struct("pos", F.col("first.doc").alias("first"), F.col("first.pos").alias("other"))).alias("at"))
    spans = chained.groupBy(F.col("doc_id").alias("doc"), F.col("text_key").alias("key")).agg(F.collect_set(F.struct(F.col("other_id").alias("other"), "start", "end")).alias("spans"))

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            out = []
            for d, key, at, spans in zip(*(x.column(n).to_pylist() for n in ("doc", "key", "at", "spans")), strict=True):
                covered: dict[int, list[list[int]]] = {}
                for o, s, e in sorted((v["other"], v["start"], v["end"]) for v in spans or ()):
                    mine = covered.setdefault(o, [])
                    if mine and s <= mine[-1][1]:
                        mine[-1][1] = max(e, mine[-1][1])
                    else:
                        mine.append([s, e])
                joined: list[list[int]] = []
                for pos, first, other in sorted((v["pos"], v["first"], v["other"]) for v in at):
                    if joined and joined[-1][1:] == [pos - 1 + least, first, other - 1 + least]:
                        joined[-1][1], joined[-1][3] = pos + least, other + least
                    else:
                        joined.append([pos, pos + least, first, other + least])
                for s, e, first, f in joined:
                    mine = covered.get(first, [])
                    i = bisect_right(mine, s, key=lambda x: x[0]) - 1
                    if i < 0 or mine[i][1] < e:
                        out.append((d, key, s, e, first, f - (e - s), f, 1.0))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["doc_id", "text_key", "start", "end", "other_id", "other_start", "other_end", "likeness"])

    return later.join(spans.hint("merge"), ["doc", "key"], "left").mapInArrow(merge, PASSAGE)


def remove(docs: DataFrame, **options) -> DataFrame:
    """docs without the passages that an earlier document has; n_chars follows the text. All rows and columns stay, whatever their names; a text that is one passage becomes empty."""
    spans = find(docs.select("doc_id", "text"), **options)
    spans = written(spans.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    rows, doc = packed(docs), F.col("_doc")
    here = (doc["doc_id"].cast("long") == F.col("doc_id")) & (F.xxhash64(doc["text"].cast("string")) == F.col("text_key"))
    joined = rows.join(spans.hint("merge"), here, "left").select("_doc", "spans")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        word = re.compile(r"[^\x20\x09-\x0D]+")
        for x in batches:
            cols = dict(zip((f.name for f in x.column(0).type), x.column(0).flatten(), strict=True))
            texts = cols["text"].to_pylist()
            for i, spans in enumerate(x.column(1).to_pylist()):
                if spans:
                    at, out, k = [m.span() for m in word.finditer(texts[i])], [], 0
                    for s in sorted(spans, key=lambda s: (s["start"], s["end"])):
                        s, e = at[s["start"]][0], at[s["end"] - 1][1]
                        out.append(texts[i][k : max(k, s)])
                        k = max(k, e)
                    texts[i] = "".join([*out, texts[i][k:]]).strip(" \t\n\x0b\x0c\r")
            cols["text"] = pa.array(texts, cols["text"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    out = joined.mapInArrow(cut, docs.schema)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))


def op7_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
