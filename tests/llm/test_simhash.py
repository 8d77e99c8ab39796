import random

import xxhash

from tidegrid.llm.simhash import near_dedup, near_forest, simhash, simhash_components


def brute(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def texts():
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    base = [" ".join(word() for _ in range(n)) for n in (3, 4, 5, 60, 300, 900)]
    out = [None, "", " \t\n", "One\x0btwo\x0cthree", *base, *base]
    for t in base:
        w = t.split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    return out + [base[-1].upper().replace("É", "é")]


def test_components_match_brute_force(spark):
    rows = [(i + 10, t, "x") for i, t in enumerate(texts())]
    rows += [(10, None, "x"), (None, rows[-1][1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    fps = [brute(t) for _, t, _ in rows]
    comp = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= 4:
                    comp[j] = comp[i] = min(comp[i], comp[j])
    low = {c: min((rows[i][0] for i in range(len(rows)) if comp[i] == c and rows[i][0] is not None), default=None) for c in comp}
    want = sorted((str(r[0]), f"{f:016x}", low[c]) for r, f, c in zip(rows, fps, comp, strict=True))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash_components(df).collect())
    assert got == want
    kept = near_dedup(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(low.values()))  # one row of each component, of repeated rows one


def test_quarters_lose_no_link():
    import numpy as np

    g = np.random.default_rng(3)
    a = g.integers(0, 1 << 63, 1500).astype(np.uint64)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << g.integers(0, 64, len(a)).astype(np.uint64)
    x, root = near_forest(np.concatenate([a, b]), np.concatenate([a, b]), 4)
    of = dict(zip(x.tolist(), root.tolist(), strict=True))
    assert all(of.get(p, p) == of.get(q, q) for p, q in zip(a.view(np.int64).tolist(), b.view(np.int64).tolist(), strict=True))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_components(df).collect() == []
    assert simhash("A b") == simhash("a B")


def test_a_dense_tile_keeps_a_forest():
    import numpy as np

    from tidegrid.llm.simhash import _near

    g = np.random.default_rng(4)
    x = np.unique(np.bitwise_xor.reduce(np.uint64(1) << g.integers(0, 64, (6000, 2)).astype(np.uint64), axis=1))
    a, b = near_forest(x, x, 4)
    assert len(a) == len(x) - 1 and len(set(b.tolist())) == 1
    assert sum(len(i) for i, _ in _near(x, x, 4)) > 100 * len(x)
