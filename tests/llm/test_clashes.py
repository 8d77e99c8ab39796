"""Extra columns whose names clash with those of the operators, in every stage."""

import random

import pytest
from pyspark.sql import functions as F

from tidegrid.llm import mixing, packing, passages, simhash, toxicity

NAMES = ["_doc", "_row", "_gone", "_id", "_key", "_spans", "spans", "text_key", "doc", "first", "toxicity", "_score", "_part", "_rank", "_before", "_size", "_piece", "sequence_id", "offset", "fp", "root", "size", "passes", "_order", "component_id", "node", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(2)
    prose = lambda n: " ".join(f"w{r.randrange(500)}" for _ in range(n))
    p, copy = prose(70), prose(90)
    rows = [(k, f"{prose(80)} {p if k % 3 == 0 else ''}", f"s{k % 3}", 0) for k in range(30)]
    rows += [(40, copy, "s0", 0), (41, copy, "s1", 0), (41, copy, "s1", 0), (None, None, None, None), (50, "", "s0", 0), (51, "damnbadword " + prose(20), "s2", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(3)


def clashing(df):
    return df.withColumns({n: F.lit(f"kept {n}") for n in NAMES})


def stages(docs, spark):
    model = toxicity.fit([(int(k % 4 == 0), {b"\x01\x02\x03\x04\x05", b"\x06\x07\x08\x09"} if k % 4 == 0 else {b"\x0a\x0b\x0c\x0d"}) for k in range(40)])
    yield "toxicity", lambda d: toxicity.clean(d, model)
    yield "simhash", simhash.near_dedup
    yield "passages", passages.remove
    yield "mixing", mixing.mix


def test_stages_keep_clashing_columns(spark, docs):
    key = lambda r: (str(r["doc_id"]), str(r["text"]), str(r["source"]))
    for name, stage in stages(docs, spark):
        plain, odd = stage(docs), stage(clashing(docs))
        assert odd.columns == [*docs.columns, *NAMES], name
        got = odd.collect()
        assert sorted(map(key, got)) == sorted(map(key, plain.collect())), name
        assert all(r[n] == f"kept {n}" for r in got for n in NAMES), name
        assert stage(clashing(docs).limit(0)).collect() == [], name


def test_packing_keeps_clashing_columns(spark, docs):
    cut = packing.pieces(clashing(docs))
    odd = packing.pack(cut.withColumns({n: F.lit(f"kept {n}") for n in NAMES}))
    rest = [n for n in NAMES if n not in ("sequence_id", "offset")]
    assert odd.columns == [*cut.columns, *rest, "sequence_id", "offset"]
    got = odd.collect()
    assert all(r[n] == f"kept {n}" for r in got for n in rest) and all(isinstance(r.offset, int) for r in got)
    assert len(got) == cut.count()


def test_toxicity_takes_the_place_of_its_column(spark, docs):
    scored = toxicity.score(docs.withColumn("toxicity", F.lit("x")), toxicity.fit([]))
    assert dict(scored.dtypes)["toxicity"] == "double" and scored.columns == [*docs.columns, "toxicity"]
