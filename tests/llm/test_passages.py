"""Passages that a chain, a first holder or sparse seeds would lose."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidegrid.llm import passages
from tidegrid.llm.passages import _matches


@pytest.fixture
def prose():
    """Words at random, none twice in a row of texts: no two passages agree by chance."""
    r = random.Random(11)
    return lambda n: " ".join(f"w{r.randrange(10**9)}" for _ in range(n))


def found(spark, texts):
    return passages.find(spark.createDataFrame([(k + 1, t) for k, t in enumerate(texts)], "doc_id long, text string")).collect()


def covered(rows, doc):
    return {w for r in rows if r.doc_id == doc for w in range(r.start, r.end)}


def test_a_chain_is_cut_at_its_gaps(spark, prose):
    head, foot = prose(60), prose(60)
    for gap in (40, 100):
        texts = [f"{head} {prose(gap)} {foot}", f"{prose(20)} {head} {prose(gap)} {foot} {prose(20)}"]
        rows = found(spark, texts)
        assert covered(rows, 2) == {*range(20, 80), *range(80 + gap, 140 + gap)}


def test_halves_with_different_first_holders(spark, prose):
    p = prose(60).split()
    texts = [" ".join(p[:30]) + " " + prose(40), prose(40) + " " + " ".join(p[30:]), prose(10) + " " + " ".join(p), prose(25) + " " + " ".join(p) + " " + prose(25)]
    assert covered(found(spark, texts), 4) == set(range(25, 85))


def test_windows_hash_alike_wherever_they_are():
    c = np.random.default_rng(0).integers(0, 2**32, 300).astype(np.uint32)
    x, m, at = passages.halves_of(c, 50)
    assert (passages.runs_of(c[100:], 50) == passages.runs_of(c, 50)[100:]).all()
    assert (m == np.lib.stride_tricks.sliding_window_view(x, 26).min(axis=1)).all() and set(m) == set(x[at])


def test_every_copy_of_a_passage_is_found(spark, prose):
    w = prose(120).split()
    other = w.copy()
    for k in range(20, 120, 20):
        other[k] = "edited"  # no 50 words in a row agree
    texts = [prose(30) + " " + " ".join(w), " ".join([prose(40), *other, prose(40), *other, prose(40), *other, prose(40)])]
    want = {*range(40, 160), *range(200, 320), *range(360, 480)}
    assert covered(found(spark, texts), 2) == want


def test_extends_over_added_and_lost_words():
    a = np.arange(100, 160, dtype=np.uint32)
    b = np.delete(np.insert(a, [8, 30], [1, 2]), 50)
    assert passages._extend(a, b) == (60, 61, 59) and passages._extend(b, a) == (61, 60, 59)
    assert passages._extend(a, a + np.uint32(500)) == (0, 0, 0) and passages._extend(a, a) == (60, 60, 60)


def test_fuzzy_passages_are_found(spark, prose):
    texts, n = [], 40
    for k in range(n):
        w = prose(60).split()
        texts.append(" ".join(w))
        for i in range(48, 0, -8) if k % 2 else ():
            w.insert(i, f"new{i}")
        for i in range(6, 60, 7) if k % 2 == 0 else ():
            w[i] = "edited"
        texts.append(prose(30) + " " + " ".join(w) + " " + prose(30))
    rows = found(spark, texts)
    assert sum(len(covered(rows, 2 * k + 2)) >= 50 for k in range(n)) >= 0.95 * n


def test_parts_with_four_earlier_holders(spark, prose):
    texts, want = [], []
    for k in range(5):
        p = prose(100).split()
        for i in range(4):
            texts.append(f"{prose(30)} {' '.join(p[25 * i : 25 * i + 25])} {prose(30)}")
        texts.append(f"{prose(40)} {' '.join(p)} {prose(40)}")
        texts.append(f"{prose(40)} {' '.join(p)} {prose(40)}")
        want.append((len(texts), len(texts) - 1))
    got = found(spark, texts)
    for doc, other in want:
        mine = [r for r in got if (r.doc_id, r.other_id) == (doc, other)]
        assert {w for r in mine for w in range(r.start, r.end)} >= set(range(40, 140))


def test_alignment_goes_beyond_the_margin(spark, prose):
    """Only the first words of a passage have seeds of their own: all that follows stands in two earlier documents, piece by piece."""
    p = prose(400).split()
    pieces = [" ".join(p[i : i + 12]) for i in range(20, 400, 12)]
    texts = [" ".join(f"{x} {prose(15)}" for x in pieces[k:] + pieces[:k]) for k in (0, 1)]
    texts += [f"{prose(20)} {' '.join(p)}", f"{prose(35)} {' '.join(p)}"]
    mine = [r for r in found(spark, texts) if (r.doc_id, r.other_id) == (4, 3)]
    assert {w for r in mine for w in range(r.start, r.end)} >= set(range(35, 435))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def test_matches_are_the_longest_common_subsequence():
    g = np.random.default_rng(5)
    for n, m in ((0, 5), (5, 0), (1, 1), (30, 70), (200, 130)):
        a, b = g.integers(0, 9, n).astype(np.uint32), g.integers(0, 9, m).astype(np.uint32)
        assert _matches(a, b) == lcs(a.tolist(), b.tolist())
    a = g.integers(0, 2**32, 4_000).astype(np.uint32)
    assert _matches(a, np.delete(a, [5, 3_000])) == len(a) - 2
    far = g.integers(0, 2**32, 30_000).astype(np.uint32)
    assert _matches(far, far[1:]) == 0 and _matches(far, far[7:9]) == 2


def test_recall_against_all_pairs(spark, prose):
    """Fuzzy passages in documents full of phrases that many share, against a comparison of every pair."""
    r = random.Random(8)
    phrases = [prose(7) for _ in range(60)]
    filler = lambda n: " ".join(r.choice(phrases) if r.random() < 0.3 else prose(6) for _ in range(n))
    texts = [filler(20) for _ in range(20)]
    for _ in range(24):
        p = []
        while len(p) < 80:
            p += (r.choice(phrases) if r.random() < 0.4 else prose(9)).split()
        for _ in range(r.choice([2, 3])):
            w = p.copy()
            for i in range(r.randrange(9), len(w), r.choice([9, 12, 20])):
                w[i] = f"edit{r.randrange(10**6)}"
            texts.append(f"{filler(6)} {' '.join(w)} {filler(6)}")
    known = passages._Hashes()
    c = [passages.codes(passages.words_of(t), known).astype(np.uint32) for t in texts]
    pairs = set()
    for i in range(len(texts)):
        for j in range(i):
            at: dict = {}
            for k in range(len(c[j]) - 4):
                at.setdefault(c[j][k : k + 5].tobytes(), []).append(k)
            hits = [(k, o) for k in range(len(c[i]) - 4) for o in at.get(c[i][k : k + 5].tobytes(), ())]
            pos, other = [p for p, _ in hits], [o for _, o in hits]
            for chain in passages.chains(pos, other) if hits else ():
                if passages.align(c[i], c[j], [pos[x] for x in chain], [other[x] for x in chain]):
                    pairs.add((i + 1, j + 1))
    got = {(x.doc_id, x.other_id) for x in found(spark, texts)}
    root = list(range(len(texts) + 1))
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in got:
        root[find(a)] = find(b)
    assert len(pairs) >= 40 and got <= pairs
    assert sum(find(a) == find(b) for a, b in pairs) >= 0.95 * len(pairs)
    print("pairs", len(pairs), "tied", sum(find(a) == find(b) for a, b in pairs), "directly", sum(p in got for p in pairs))
    assert sum(p in got for p in pairs) >= 0.7 * len(pairs)  # the rest are tied through their class's first holders


def test_a_very_long_text(spark, prose):
    p = prose(80)
    texts = [f"{prose(60_000)} {p} {prose(60_000)}", f"{p} " * 3, prose(30)]
    rows = found(spark, texts)
    assert covered(rows, 2) == set(range(240))


def test_seeds_with_ten_first_holders_tie_a_passage(spark, prose):
    """No earlier document has more than one phrase of the passage, no two phrases are joined by the same word."""
    phrases = [prose(8) for _ in range(10)]
    passage = lambda: " ".join(f"{p} {prose(1)}" for p in phrases)
    texts = [f"{prose(30)} {p} {prose(30)}" for p in phrases] + [f"{prose(20)} {passage()} {prose(20)}", f"{prose(40)} {passage()} {prose(40)}"]
    assert covered(found(spark, texts), 12) >= set(range(45, 120))


def test_likeness_of_a_long_stretch_without_seeds():
    g = np.random.default_rng(6)
    a = g.integers(0, 2**32, 9_000).astype(np.uint32)
    b = a.copy()
    b[2_000:7_000:4] += np.uint32(1)  # three of four words agree
    pos = [*range(0, 1_990, 5), *range(7_000, 8_990, 5)]
    (start, end, *_, likeness), *more = passages.align(a, b, pos, pos)
    assert (start, end, more) == (0, 9_000, []) and abs(likeness - (9_000 - 1_250) / 9_000) < 1e-9


def test_matches_carry_from_block_to_block(monkeypatch):
    monkeypatch.setattr(passages, "BLOCK", 16)
    g = np.random.default_rng(7)
    for n, m, kinds in ((90, 70, 9), (200, 130, 3), (64, 33, 40)):
        a, b = g.integers(0, kinds, n).astype(np.uint32), g.integers(0, kinds, m).astype(np.uint32)
        assert _matches(a, b, None) == lcs(a.tolist(), b.tolist())


def test_chunks_and_buckets_change_nothing(spark, prose, monkeypatch):
    common = [prose(12) for _ in range(5)]
    p = prose(70).split()
    texts = [f"{prose(20)} {common[k % 5]} {' '.join(p[k % 3 * 10 :])} {prose(30)} {common[(k + 1) % 5]}" for k in range(40)] + [f"{prose(30)} " + " ".join([*p[:33], "edited", *p[34:], *p])]
    whole = sorted(found(spark, texts))
    assert covered(whole, 41) == set(range(30, 170))
    monkeypatch.setattr(passages, "CHUNK", 300)
    monkeypatch.setattr(passages, "BUCKET", 500)
    assert sorted(found(spark, texts)) == whole


def test_a_seed_of_every_document_is_sent_once_a_chunk():
    g = np.random.default_rng(8)
    common = g.integers(0, 2**32, 30).astype(np.uint32)
    docs = [(int(d), 0, np.concatenate([g.integers(0, 2**32, 20).astype(np.uint32), common, common])) for d in g.permutation(200)]
    c = passages.Chunk.read(passages.Chunk.of(docs).head())
    assert c.ids.tolist() == list(range(200)) and all((c.codes[80 * d : 80 * d + 80] == t).all() for d, _, t in docs)
    c.sow(5, 1, 50)
    x = np.concatenate([c.keys_of[: c.seeds][c.doc[: c.seeds] == d] for d in range(200)])
    assert len(x) == 200 * 76 and len(np.unique(x)) < 200 * 24 + 60
    sent = list(passages.Sorted(c.keys_of).sent("a", c.ids[c.doc], c.pos, 7))
    assert sum(r[2] for r in sent) == len(np.unique(c.keys_of)) and len({r[1] for r in sent}) == 7
    shared, first, n, begin, places = passages._told(pa.concat_tables(passages._answer(passages._rows([r])) for r in sent))
    keys = np.unique(c.keys_of)
    at = np.searchsorted(keys, passages.seeds(common.astype(np.uint64), 5, 1)[0])
    assert shared[at].all() and (first[at] == 0).all() and (n[at] == 2).all()
    assert [places[b : b + 2].tolist() for b in begin[at]] == [[20 + i, 50 + i] for i in range(26)]
    assert not shared[np.searchsorted(keys, passages.seeds(c.codes[:20].astype(np.uint64), 5, 1)[0])].any()


def test_extensions_made_together_are_those_made_alone():
    g = np.random.default_rng(9)
    pairs = []
    for k in range(120):
        a = g.integers(0, 2**32, int(g.integers(1, 900))).astype(np.uint32)
        b = a.copy()
        b[g.random(len(b)) < g.choice([0.01, 0.05, 0.1, 0.3])] += np.uint32(1)
        b = np.delete(b, g.integers(0, len(b), k % 4))
        pairs.append((a, b))
    pairs.append((np.empty(0, np.uint32), pairs[0][0]))
    assert passages._extensions(pairs) == [passages._extend(a, b) for a, b in pairs]
    together = [(a, b, [0, 5], [0, 5], (False,) * 4) for a in (np.arange(80, dtype=np.uint32),) for b in (a, np.delete(a, 40), np.roll(a, 7))]
    assert passages.align_all(together) == [passages.align(*c[:4]) for c in together]
