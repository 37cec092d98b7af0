"""The pipeline's stages on planted cases and awkward rows."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from test_documents import awkward, prose


@pytest.fixture
def labelled(spark, tmp_path):
    """A folder whose labels mark insults as toxic."""
    rows = [(1000 + i, int(i % 4 == 0)) for i in range(200)]
    spark.createDataFrame(rows, "doc_id LONG, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def corpus():
    draw = random.Random(8)
    insults = ["zorbish", "blatherskite", "idiot", "moron"]
    rows = []
    for i in range(200):
        words = prose(500 + i, 60).split()
        if i % 4 == 0:
            for at in range(0, 60, 12):
                words[at] = draw.choice(insults)
        rows.append((1000 + i, " ".join(words)))
    return rows


def stages(spark, docs, labelled):
    for name, stage in p.STAGES:
        before, docs = docs, stage(spark, docs, labelled)
        docs = docs.persist()
        yield name, before, docs


def test_planted_cases(spark, docs, labelled):
    copy = corpus()[1][1]
    near = copy.replace(copy.split()[30], "changed", 1)
    passage = prose(77, 60)
    secret = "token=0123456789abcdefABCDEF"
    planted = [
        (1, copy), (2, near), (3, prose(91, 50) + " " + passage),
        (4, prose(92, 50) + " " + passage), (5, prose(93, 40) + " " + secret + " " + prose(94, 40)),
    ]
    frame = docs(corpus() + planted).withColumn("extra", F.col("doc_id"))
    after = {name: rows for name, _, rows in stages(spark, frame, labelled)}
    toxic = {1000 + i for i in range(0, 200, 4)}
    left = {r.doc_id for r in after["toxicity"].collect()}
    assert not left & toxic and left == {r.doc_id for r in frame.collect()} - toxic
    left = {r.doc_id for r in after["near_copies"].collect()}
    assert {1, 3, 4, 5} <= left and not left & {2, 1001}
    texts = {r.doc_id: r.text for r in after["repeats"].collect()}
    assert passage in texts[3] and passage not in texts[4] and prose(92, 50) in texts[4]
    texts = {r.doc_id: r.text for r in after["secrets"].collect()}
    assert secret not in texts[5] and "[secret]" in texts[5]
    assert after["secrets"].columns == frame.columns
    assert {r.doc_id for r in after["packing"].collect()} == set(texts)


def test_awkward_rows_pass_through(spark, docs, labelled):
    frame = docs(awkward()).withColumns({n: F.lit(1) for n in ("id", "version", "rest", "group")})
    for name, before, after in stages(spark, frame, labelled):
        if name != "packing":
            assert after.columns == before.columns
            assert after.count() <= before.count()
        if name == "near_copies":
            kept = [(r.doc_id, r.text) for r in after.collect()]
            assert kept.count((1, None)) == 1 and kept.count((2, "")) == 1
            assert (4, dict(r for r in awkward() if r[0] == 4)[4]) in kept
            assert not {i for i, _ in kept} & {6, 7, 9}
    assert after.count() > 0


def test_a_text_keeps_its_own_replacement_characters(spark, docs):
    passage = "Ein Satz mit é und 漢字, der in beiden Texten steht und länger als fünfzig Bytes ist. "
    rows = [(1, passage), (2, "a\ufffdb " + passage + "c\ufffd"), (3, "字" * 30), (4, "漢\ufffd" + "字" * 30 + "学")]
    got = {r.doc_id: r.text for r in p.cut_repeats(spark, docs(rows), "").collect()}
    assert got[1] == passage and got[2] == "a\ufffdb c\ufffd"
    # of the last character two bytes are repeated ones, and the third is none by itself
    assert got[4] == "漢\ufffd"


def test_no_documents(spark, docs, labelled):
    for _, _, after in stages(spark, docs([]), labelled):
        assert after.count() == 0
