"""The pipeline's stages, each against brute force on what it was given."""

from __future__ import annotations

import collections

import corpus_pipeline
from rowtide.llm import toxicity

from tests.llm.test_jaccard import brute as components_of
from tests.llm.test_repeats import brute as kept_of

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    seen = [{r["doc_id"]: r for r in docs.collect()}]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        if n < 4:
            assert docs.columns == columns
        seen.append(collections.defaultdict(list))
        for r in docs.collect():
            seen[-1][r["doc_id"]].append(r)
    everything, clean, single, cut, mixed, packed = seen
    assert set(clean) <= set(everything) and len(clean) >= 0.8 * len(everything)
    assert all(r[0] == everything[i] for i, r in clean.items())
    component = components_of([(i, r[0]["text"]) for i, r in clean.items()])
    assert set(single) == {i for i, (_, c) in component.items() if c == i}
    want = kept_of([(i, r[0]["text"]) for i, r in single.items()])
    assert {i: r[0]["text"] for i, r in cut.items()} == {i: b.decode("utf-8", "ignore") for i, b in want.items()}
    assert all(r[0]["n_chars"] == len(r[0]["text"]) for r in cut.values())
    assert all(r == cut[i] * len(r) for i, r in mixed.items())
    assert set(packed) == set(mixed)
    assert all(sum(p["length"] for p in ps) == len(mixed[i]) * ps[0]["doc_tokens"] for i, ps in packed.items())


def test_toxic_stage_takes_what_scores(spark):
    network = toxicity.Network.fresh(0)
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    network.prior = 0.1
    assert [r["doc_id"] for r in toxicity.kept(df.where("doc_id > 1"), network, 0.5).collect()] == [2, 3]


def test_copies_are_rows(spark):
    x, y = ("one two three four five six seven " + w for w in ("ate", "eight nine ten eleven twelve"))
    z = "quite another text of more than five words"
    rows = [(3, x), (7, x), (7, y), (8, z), (8, z), (9, z), (None, z), (None, z), (5, ""), (5, ""), (6, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = collections.Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each(spark, df, SF_DIR).collect())
    assert got == {(3, x): 1, (7, y): 1, (8, z): 1, (None, z): 2, (5, ""): 2, (6, None): 1}
