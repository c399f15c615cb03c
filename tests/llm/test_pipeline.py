"""The pipeline against a plain version of its stages, and its contract."""

import os

import pytest

from lodestone.llm import leaks, quality
from lodestone.llm.common import table

from .test_pairs_and_repeats import line_reference, linked_components

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_stages_are_those_of_a_plain_pipeline(spark):
    docs = table(spark, SF, "documents")
    model = quality.fit(docs.select("doc_id", "text"), table(spark, SF, "labels"))
    scored = quality.score_quality(docs, model).collect()
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in scored if r["predicted"] == 1]
    assert 0 < len(rows) < len(scored)
    text = {d: t for d, _, _, t in line_reference(rows)}
    rows = [(d, text[d], *rest) for d, _, *rest in rows]
    keep = {d for d, _, c in linked_components(rows, corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT) if d == c}
    rows = [r for r in rows if r[0] in keep]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    short = [(d, t) for d, t, *_ in rows if len(t) < 4000]
    bad = {d for d, *_ in leaks.brute_force(short, items)}
    got = corpus_pipeline.run(spark, SF).collect()
    ids = {r["doc_id"] for r in got}
    looked_at = {d for d, _ in short}
    assert ids & looked_at == looked_at - bad and ids <= keep
    assert all(r["text"] == text[r["doc_id"]] and r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)
    assert all(r["n_chars"] == len(r["text"]) for r in got if r["text"] != next(t for d, t, *_ in [(x["doc_id"], x["text"]) for x in scored] if d == r["doc_id"]))


def test_stages_take_odd_rows_and_extra_columns(spark, docs, empty):
    """Other columns, among them all that a stage uses itself, come through each stage with type and value."""
    from pyspark.sql import functions as F

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "SentencePiece encoding and decoding"]
    own = ["score", "predicted", "held_out", "n_lines", "n_dropped", "__row", "__id", "__null", "__text", "__own_0", "component_id", "decoded", "ids", "N_Tokens", "round_trip", "a.b", "a`b"]
    value = lambda i: F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
    given = docs.select("*", *[value(i).alias(c) for i, c in enumerate(own)])
    frame = given
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frame, SF)
        if i < 4:
            assert out.schema.simpleString() == given.schema.simpleString()
        else:
            assert out.columns == [*given.columns, "ids_", "n_tokens_", "round_trip_"]
        got = out.collect()
        assert 0 < len(got) <= frame.count()
        for r in got:
            at = "none" if r["doc_id"] is None else r["doc_id"]
            assert [r[5 + k] for k in range(len(own))] == [f"{k}:{at}" for k in range(len(own))]
        frame = out
    assert all(r["round_trip_"] and r["n_tokens_"] == len(r["ids_"]) for r in got)


def test_stages_take_an_empty_table(spark, empty):
    frame = empty
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, frame, SF)
        assert frame.count() == 0 and frame.columns[:5] == empty.columns and (i == 4 or len(frame.columns) == 5)


def test_near_duplicates_with_null_and_reused_ids(spark):
    import random

    from .conftest import SCHEMA, prose

    rng = random.Random(8)
    a, b, c, d, e, f, g = (prose(rng, 80) for _ in range(7))
    near = lambda t: " ".join(t.split()[:-1]) + " changed"
    rows = [
        (None, a), (None, b), (None, b), (None, ""), (None, None),  # null ids: one of each text
        (1, c), (None, c),  # a copy of a document with an id
        (2, d), (3, near(d)), (3, e),  # one text of a reused id is a near copy
        (4, f), (4, near(f)), (4, g), (4, g),  # a reused id: near copies of each other, and a text of its own
        (5, ""), (5, " "), (5, ""),
    ]
    frame = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], SCHEMA).repartition(3)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates_stage(spark, frame, SF).collect()]
    want = [(None, a), (None, b), (None, ""), (None, None), (1, c), (2, d), (3, e), (4, g), (5, ""), (5, " ")]
    assert [x for x in got if x[1] in (f, near(f))] in ([(4, f)], [(4, near(f))])
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "", x[1] is None)
    assert sorted((x for x in got if x[1] not in (f, near(f))), key=key) == sorted(want, key=key)
