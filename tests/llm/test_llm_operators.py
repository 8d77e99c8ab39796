"""The operators against brute force, round trips and held-out labels, with odd rows in each."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import embeddings, lm, mixing, packing, passages, spotsigs, toxicity, urls, warc


@pytest.fixture
def prose():
    """The same words in every test, whichever ran before."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(4000)]
    return lambda n: " ".join(r.choice(["the", "of", "and"]) if r.random() < 0.3 else r.choice(words) for _ in range(n))


def test_embeddings_match_brute_force(spark):
    g = np.random.default_rng(2)
    x = g.normal(size=(120, 64))
    x[60:90] = x[:30] + 0.2 * g.normal(size=(30, 64))
    x[90:100] = x[0]
    rows = [(int(k), [float(e) for e in v]) for k, v in enumerate(x)] + [(500, None), (501, [0.0] * 64), (502, [float("nan")] + [1.0] * 63), (503, []), (504, [1.0, None])]
    rows.append((500, None))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.9
    comp = list(range(len(x)))
    for _ in range(4):
        comp = [min(comp[j] for j in np.flatnonzero(near[i])) for i in range(len(x))]
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.link(df, tile=16).collect()}
    want = {(i, int(near[i].sum()) - 1, comp[i], comp[i] == i) for i in range(len(x))} | {(k, 0, k, True) for k in range(500, 505)}
    assert got == want
    assert embeddings.link(df.limit(0)).collect() == []


def test_spotsigs(spark, prose):
    texts = [prose(80), None, "", "one", prose(300)]
    texts += [texts[0], "日本語 の テキスト", texts[-1].replace("the", "The")]
    rows = [(10 * k, t) for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in spotsigs.compare_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert len(got) == len(rows)
    for k, (d, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 4
        new = t[: len(t) - cut] + after[:cut]
        a, b = set(spotsigs.signatures(t).tolist()), set(spotsigs.signatures(new).tolist())
        assert got[d].n_chars == len(t)
        assert got[d].near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert got[0].fingerprint == got[50].fingerprint
    assert got[0].near_edited > 0.4 > 0.05 > got[0].near_next
    small = spotsigs.with_next(spark.createDataFrame(rows, "doc_id long, text string"), bucket_rows=2).collect()
    assert sum(not r.ahead for r in small) == len(rows)
    assert spotsigs.compare_edits(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_spotsigs_components_match_brute_force(spark, prose):
    r = random.Random(12)
    texts = []
    for n in (30, 200, 200, 400, 900):
        base = prose(n).split()
        for _ in range(9):
            w = base.copy()
            for _ in range(r.choice([0, 1, 2, n // 40, n // 15])):
                w[r.randrange(len(w))] = r.choice(["changed", "other", "the"])
            texts.append(" ".join(w[: len(w) - r.choice([0, 0, n // 12])]))
    texts += [None, "", " ", "solo", "Solo!", *[prose(60) for _ in range(20)], "long " * 40_000, texts[0]]
    rows = [(100 - k, t, "x", "y") for k, t in enumerate(texts)] + [(None, texts[3], "x", "y"), (7, texts[3], "x", "y"), (7, prose(70), "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, component_id string").repartition(4)
    sets = [spotsigs.signatures(t) for _, t, _, _ in rows]
    comp = list(range(len(rows)))
    for _ in range(8):
        for i in range(len(rows)):
            for j in range(i):
                if spotsigs.jaccard(sets[i], sets[j]) >= 0.8:
                    comp[i] = comp[j] = min(comp[i], comp[j])
    low = {c: min((rows[i][0] for i in range(len(rows)) if comp[i] == c and rows[i][0] is not None), default=None) for c in comp}
    want = sorted((d, spotsigs.fingerprint(s), low[c]) for (d, *_), s, c in zip(rows, sets, comp, strict=True) if d is not None)
    for file in (3, 2048):
        got = spotsigs.near_duplicates(df, file=file).collect()
        keys = {spotsigs.key_of(s): spotsigs.fingerprint(s) for s in sets}
        assert sorted((x.doc_id, keys[x.key], x.component_id) for x in got if x.doc_id is not None) == want
    got = spotsigs.compare_edits(df).collect()
    assert len(got) == len(rows)
    assert sorted((x.doc_id, x.fingerprint, x.component_id) for x in got if x.doc_id is not None) == want


def test_spotsigs_counts_signatures_of_all_sets(spark):
    g = np.random.default_rng(3)
    n = 50_000  # one signature in all sets, one in each third, the others rare
    sets = [np.unique(np.array([7, *([3 << 30] if k % 3 == 0 else []), *g.integers(100, 1 << 32, 2)], np.uint32)) for k in range(n)]
    kinds, want = np.unique(np.concatenate(sets), return_counts=True)
    table = spark.createDataFrame([(k, s.tobytes()) for k, s in enumerate(sets)], "key long, sigs binary")
    sig, often = spotsigs._common(table)
    assert sig.tolist() == kinds[want > 1].tolist() and often.tolist() == want[want > 1].tolist()
    assert len(spotsigs._common(table.limit(0))[0]) == 0


def test_toxicity_learns_gapped_insults(prose):
    r = random.Random(3)
    docs = []
    for k in range(600):
        words = prose(60).split()
        y = int(k % 6 == 0)
        if y:
            words[r.randrange(60)] = r.choice(["zimbolt", "krunkfy", "vexhorn"])
        docs.append((y, set(toxicity.encode(" ".join(words)).tobytes().split(b"\0")) - {b""}))
    model = toxicity.fit(docs)
    clean = [prose(60) for _ in range(40)]
    for insult in ("zimbolt", "Zim-bolt!", "z i m b o l t", "zimxbolt", "z1mb0lt", "krunkfying"):
        assert model.scores([clean[0] + " " + insult + " " + clean[1]])[0] >= 0.5, insult
    assert (model.scores(clean) < 0.5).all()
    assert (model.scores(["", " ", "...", "a b", "clean " * 30_000]) < 0.5).all()
    assert (toxicity.fit([]).scores(["x"]) < 0.5).all()


def test_toxicity_trains_on_tables_with_odd_rows(spark, prose):
    r = random.Random(4)
    rows, labels = [], []
    for k in range(300):
        y = int(k % 5 == 0)
        rows.append((k, prose(30) + (f" {r.choice(['zimbolt', 'krunkfy'])} " if y else " ") + prose(10), "x"))
        labels.append((k, y))
    rows += [(400, None, None), (401, "", ""), (None, "zimbolt", ""), rows[0], rows[0], (402, "zimbolt " * 30000, "")]
    labels += [(400, 0), (401, None), (None, 1), (999, 1), labels[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string").withColumn("_id", F.lit("clash")).repartition(5)
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, given)
    assert (toxicity.train(docs, given).weights == model.weights).all()
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "words", "_id", "toxicity"}
    assert all((x.toxicity >= 0.5) == ("zimbolt" in (x.text or "") or "krunkfy" in (x.text or "")) for x in got)
    for d, n in ((docs.limit(0), given), (docs, given.limit(0)), (docs, given.where("toxic = 0"))):
        assert all(x.toxicity < 0.5 for x in toxicity.score(docs, toxicity.train(d, n)).collect())


def test_kernel_matches_brute_force():
    """Common subsequences of four letters within seven, a gap in either word costing DECAY."""
    from itertools import combinations

    r = random.Random(9)
    words = [bytes(r.randint(1, 4) for _ in range(r.randint(1, 9))) for _ in range(12)] + [b"\x01" * 8]

    def spelled(w):
        out = {}
        for at in combinations(range(len(w)), toxicity.ORDER):
            if at[-1] - at[0] < toxicity.SPAN:
                key = bytes(w[k] for k in at)
                out[key] = out.get(key, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1 - toxicity.ORDER)
        return out

    f = toxicity.features(words)
    got = toxicity.kernel(f, f)
    norm = toxicity.norm_of(np.array([len(w) for w in words]))
    for i, a in enumerate(map(spelled, words)):
        for j, b in enumerate(map(spelled, words)):
            assert got[i, j] == pytest.approx(sum(v * b.get(k, 0) for k, v in a.items()) / norm[i] / norm[j])


def test_machine_has_no_loss_outside_its_working_set(prose, monkeypatch):
    r = random.Random(6)
    words = sorted({w.encode() for w in prose(9000).split() if len(w) > 3} | {b"zimbolt", b"krunkfy"})
    code = [toxicity.encode(w.decode()).tobytes()[:-1] for w in words]
    doc = np.repeat(np.arange(400), 30)
    word = np.array([r.randrange(len(words)) for _ in doc])
    toxic = np.arange(400) % 5 == 0
    bad = [words.index(b"zimbolt"), words.index(b"krunkfy")]
    word[np.isin(word, bad)] = 0 if 0 not in bad else 1
    word[np.flatnonzero(toxic) * 30] = [bad[k % 2] for k in range(80)]
    pairs = sorted(set(zip(doc.tolist(), word.tolist(), strict=True)))
    args = (toxic, np.array([d for d, _ in pairs]), np.array([w for _, w in pairs]), code)
    some = toxicity._machine(*args, 64, 10.0)
    monkeypatch.setattr(toxicity, "WORKING", 100)
    few = toxicity._machine(*args, 64, 10.0)
    for m in (some, few):
        margin = m.word_margins([code[k] for k in bad])
        assert (margin > 0).all() and margin.min() > np.quantile(m.word_margins(code), 0.99)


def test_near_copies_are_one_family():
    g = np.random.default_rng(1)
    sets = [g.choice(5000, 200, replace=False) for _ in range(20)]
    sets += [np.unique(np.concatenate([s[:-6], g.choice(5000, 6)])) for s in sets[:10]]
    doc = np.repeat(np.arange(30), [len(s) for s in sets])
    assert toxicity.families(doc, np.concatenate(sets), 30).tolist() == [*range(20), *range(10)]


def test_targets_and_apportionment():
    assert mixing.targets({"a": 10, "b": 10, None: 10}) == {"a": 20.0, "b": pytest.approx(50 / 3), None: pytest.approx(25 / 3)}
    claims, seats = [53.0, 24.0, 23.0, 0.0], 7
    want, heap = [0] * 4, None
    for _ in range(seats):
        heap = max(range(4), key=lambda k: (claims[k] / (2 * want[k] + 1), -k))
        want[heap] += 1
    assert mixing.sainte_lague(claims, seats) == want
    assert sum(mixing.sainte_lague([1e12, 3e12, 7.0], 10**9)) == 10**9
    assert mixing.sainte_lague([], 3) == []


def test_mixing(spark, prose):
    rows = [(k, prose(5 + k % 90), f"s{k % 4}", 0) for k in range(400)] + [(900, None, "s0", None), (901, "", None, 0), (None, prose(50), None, 1), (5, prose(5), "s1", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    plan = mixing.plan(mixing.sized(df)).collect()
    assert len(plan) == len(rows)
    assert all(0 <= r.taken <= 2 * r.size and r.taken == r.passes * r.size + sum(s.end - s.start for s in r.spans) for r in plan)
    for s in {r.source for r in plan}:
        mine = [r for r in plan if r.source == s]
        assert sum(r.taken for r in mine) == pytest.approx(mine[0].target, abs=130, rel=0.02)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert sum(len(r.text.split()) for r in mixed.collect()) == sum(r.taken for r in plan)
    assert mixing.plan(mixing.sized(df.limit(0))).collect() == []
    odd = df.withColumns({"_row": F.lit("r"), "spans": F.lit(None).cast("int"), "a.b": F.array(F.lit(1))})
    got = mixing.mix(odd)
    assert got.columns == odd.columns and mixing.mix(odd.limit(0)).collect() == []
    assert sorted((r.text, r.n_chars) for r in got.collect()) == sorted((r.text, r.n_chars) for r in mixed.collect())
    assert all(r["_row"] == "r" and r["spans"] is None and r["a.b"] == [1] for r in got.collect())


def test_packing_is_a_round_trip(spark, prose):
    from tokenizers import Tokenizer

    texts = [None, "", " ", "a  b\n c \n", prose(3000), "x<|endoftext|>y", "\0 nul \0", "it's 12  3", "  lead", "tab\t x", "é\u00a0 ü\u2003 z", prose(20)] + [prose(k % 700) for k in range(60)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(1, ""), (None, "z")]
    got = packing.pack(packing.pieces(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))).collect()
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert t.encode("x<|endoftext|>y", add_special_tokens=False).ids == [87, 50256, 88]
    for d, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        mine = sorted((r for r in got if r.doc_id == d), key=lambda r: r.start)
        if d == 1:
            mine = mine[:1]
        assert [r.doc_tokens for r in mine] == [len(ids)] * len(mine)
        assert sum(r.length for r in mine) == len(ids)
        for r in mine:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    by: dict = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    assert packing.pack(packing.pieces(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def test_warc_round_trip(spark):
    r = random.Random(4)
    big = "".join(chr(r.randrange(32, 1000)) for _ in range(3000))
    rows = [(k, f"http://h/{k}", big if k % 5 == 0 else big[: 10 * k]) for k in range(200)] + [(None, None, big), (300, "u v", None), (300, "u v", None), (301, "x", "y" * 1000), (302, "x", "y" * 1000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    from hashlib import sha1

    size = lambda h: len((h or "").encode())
    top = lambda h: max((p for p, _, g in rows if (g or "") == (h or "") and p is not None), default=None)
    want = sorted((str(p), size(h), sha1((h or "").encode()).hexdigest(), *(("revisit", top(h)) if size(h) >= 1000 and top(h) != p else ("response", None))) for p, _, h in rows)
    for split in (100, 1 << 20):
        got = warc.round_trip(spark, df.repartition(3), split=split).collect()
        assert sorted((str(x.page_id), x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in got) == want
        assert all(sha1(bytes(x.payload)).hexdigest() == x.payload_digest for x in got if x.record_type == "response")
    assert warc.round_trip(spark, df.limit(0)).collect() == []
    odd = df.where("page_id < 5").withColumns({"owner": F.lit("x"), "payload": F.lit(1), "_digest": F.lit(2)})
    assert warc.round_trip(spark, odd).count() == 5


def test_archived_archives_and_other_writers(spark, tmp_path):
    import gzip

    head = lambda kind, urn, n: f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {urn}\r\nContent-Length: {n}\r\n\r\n".encode()
    member = lambda urn, body, level=6: gzip.compress(head("response", urn, len(body)) + body + b"\r\n\r\n", level)
    inner = b"".join(member(f"<urn:page:{k}>", b"inner" * 50) for k in range(900, 903)) + b"x" * 500
    whole = [member("<urn:uuid:1-2>", b"a" * 3000), member("<urn:page:7>", inner, 0), member("<urn:page:x>", b"b"), member("<urn:page:8>", b"")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(whole))
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    for split in (64, 1000, 1 << 20):
        got = warc.read_archives(spark, str(tmp_path), split).orderBy("record_offset").collect()
        assert [(r.page_id, bytes(r.payload)) for r in got] == [(None, b"a" * 3000), (7, inner), (None, b"b"), (8, b"")], split


def test_urls(spark):
    link = '<a href="http://bad.example.org/x">x</a><a href="/own">y</a>'
    rows = [(k, f"http://bad.Example.org/es/{k}", "") for k in range(9)] + [(9, "https://bad.example.org/fr/1", None)]
    rows += [(20, "http://friend.example.net/x", link), (21, None, link), (22, "no host", None), (23, "x://a.com?q#z", None), (24, "x://a.com/en/1#z", None), (25, "x://example.com/en/7", None), (26, "x://notexample.com/en/7", None), (27, "x://q.example.net/de/8/?/de", None), (28, "x://net/de/8", None)]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    say = lambda k: (got[k].host, got[k].path, got[k].rule, got[k].verdict)
    assert say(9) == ("bad.example.org", "/fr/1", None, "block")
    assert say(20)[3] == "block" and got[20].distrust > 0.5
    assert say(21) == ("", "", None, "allow") and say(22) == ("", "", None, "allow")
    assert say(23) == ("a.com", "", None, "allow") and say(24)[2:] == ("com/en/", "block")
    assert say(25)[2:] == ("example.com/en/7", "allow") and say(26)[2:] == ("com/en/", "block")
    assert say(27)[2:] == ("example.net/de/8", "block") and say(28)[2:] == ("net/de/", "allow")
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def brute_losses(docs, target, background=None):
    """Losses in plain Python; without a background, each document's is all the others."""
    from collections import Counter
    from math import log

    split = lambda t: (t or "").lower().split()

    def model(texts):
        one, two = Counter(), Counter()
        for t in texts:
            w = split(t)
            one.update(w)
            one.update([None] if w else [])
            two.update(zip([None, *w], w))
        return one, two, sum(len(split(t)) for t in texts)

    goal, out = model(target), {}
    given = background and model(background)
    for i, (d, t) in enumerate(docs):
        models = (goal, given or model([x for k, (_, x) in enumerate(docs) if k != i]))
        w, loss = split(t), []
        share = lambda x: max(sum(m[0][x] for m in models), 0.5) / max(sum(m[2] for m in models), 0.5)  # noqa: B023, E731
        for one, two, n in models:
            total = 0.0
            for v, x in zip([None, *w], w):
                p = (one[x] + lm.PRIOR * share(x)) / (n + lm.PRIOR)
                total -= log(lm.WEIGHT * two[v, x] / one[v] + (1 - lm.WEIGHT) * p if one[v] else p)
            loss.append(total / len(w) if w else None)
        out[d] = (len(w), *loss)
    return out


def test_lm_prefers_the_target(spark, prose, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET", 5000)
    background = [(k, prose(100)) for k in range(60)]
    target = [(k, " ".join(["rate", "of", "change", "in", "the", "field"] * 10)) for k in range(10)]
    docs = background + [(100, target[0][1]), (101, None), (102, ""), (103, "unseen " * 400), (104, "Solo"), (105, "solo")]
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, score string")
    goal = spark.createDataFrame(target, "item_id long, text string")
    other = spark.createDataFrame([(prose(50),)], "text string")
    for given, texts in ((None, None), (other, [r.text for r in other.collect()])):
        got = {r.doc_id: r for r in lm.score(frame, goal, given).collect()}
        want = brute_losses(docs, [t for _, t in target], texts)
        assert got.keys() == want.keys()
        for d, (n, a, b) in want.items():
            assert got[d].n_words == n
            if n:
                assert np.allclose([got[d].loss_target, got[d].loss_background, got[d].score], [a, b, a - b], rtol=1e-9)
            else:
                assert got[d].score == 0 and got[d].loss_target is None and got[d].loss_background is None
        assert got[100].score < min(got[k].score for k, _ in background)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(empty, empty).collect() == [] and lm.score(empty, goal).collect() == []
    twice = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert len({r.score for r in lm.score(twice, empty).collect()}) == 1 and lm.score(twice, empty).count() == 3


def test_lm_packs_numbers():
    for x in ([], [0], [255, 256], [2**64 - 1, 1, 0]):
        assert lm.unpack(lm.pack(np.array(x, np.uint64)), len(x)).tolist() == x


def test_passages(spark, prose):
    p, q = prose(60), prose(200)
    w = q.split()
    for k in (40, 90, 150):
        w[k] = "edited"
    del w[120]
    fuzzy = " ".join(w)
    # words of their own beside the passage, so that it ends where it was put
    rows = [(1, prose(99) + " alpha " + p + " gamma " + prose(49)), (2, prose(29) + " beta " + p), (3, q), (4, prose(80) + "\n" + fuzzy + "\n" + prose(80)), (5, prose(300)), (6, prose(20)), (7, None), (8, ""), (None, q), (9, "line " * 400), (10, "line " * 400), (5, q)]
    df = spark.createDataFrame([(d, t, "en", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, n_chars long")
    got = {(r.doc_id, r.other_id): r for r in passages.find(df).collect()}
    assert set(got) == {(2, 1), (4, 3), (5, 3), (10, 9)}
    assert (got[2, 1].start, got[2, 1].end, got[2, 1].other_start) == (30, 90, 100)
    assert abs(got[4, 3].start - 80) <= 1 and abs(got[4, 3].end - 279) <= 1 and got[4, 3].likeness > 0.97
    left = [(r.doc_id, r.text) for r in passages.remove(df).collect()]
    assert len(left) == len(rows)
    text = {d: t for d, t in left if d not in (None, 5)}
    assert text[1] == rows[0][1] and text[3] == q and text[7] is None and p not in text[2] and len(text[2].split()) == 30
    assert (None, q) in left and (5, rows[4][1]) in left and (5, "") in left
    assert passages.find(df.limit(0)).collect() == []
    again = df.unionByName(df.withColumns({"doc_id": F.col("doc_id") + 100, "text": F.concat_ws(" ", "text", "text")}))
    runs = [sorted(map(tuple, passages.find(again.repartition(n, F.xxhash64("text", F.lit(n)))).collect())) for n in (1, 7)]
    assert runs[0] == runs[1] and len(runs[0]) > 4


def test_chains_match_brute_force():
    r = random.Random(6)
    for _ in range(30):
        n = r.randint(2, 9)
        pos, other = [r.randrange(60) for _ in range(n)], [r.randrange(60) for _ in range(n)]
        best, order = {}, sorted(range(n), key=lambda i: (pos[i], -other[i]))
        for i in order:
            before = [best[j] - 0.1 * (pos[i] - pos[j] + other[i] - other[j]) for j in order if j in best and pos[j] < pos[i] and other[j] < other[i]]
            best[i] = 5 + max([0, *before])
        total = lambda c: 5 * len(c) - 0.1 * (pos[c[-1]] - pos[c[0]] + other[c[-1]] - other[c[0]])  # noqa: B023, E731
        got = passages.chains(pos, other)
        assert all(pos[a] < pos[b] and other[a] < other[b] for c in got for a, b in zip(c, c[1:], strict=False))
        if max(best.values()) > 5 + 1e-9:
            assert total(got[0]) == pytest.approx(max(best.values()))
