"""Toxicity, language, packing, chat, licences and mixing: brute force, round trips, held-out accuracy, defined cases."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowtide.llm import chat, language, licenses, mixing, packing, template, tokens, toxicity
from rowtide.llm.queries import QUERIES, packed

SF = "/root/testdata/sf0.01"
FILES = (
    public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
)
ODD = [
    (1, "", "x"), (2, None, "x"), (3, "¡ña! \x1c\x85 日本語    it's  ''s\r\n\t end  ", "y"), (3, "<|endoftext|> a", "y"),
    (4, "word " * 30_000, "z"), (None, "no id", "z"), (5, "!!! 123", "z"),
]
ODD_SCHEMA = "doc_id long, text string, score string"


# ---------------------------------------------------------------- toxicity


def test_gradients_are_those_of_the_loss():
    network = toxicity.Network.fresh(1)
    words = toxicity.Features.of(["ab", "c", "déf", "ghij"])
    at = np.array([[0, 1, 2, 4], [3, 2, 4, 4], [1, 1, 0, 3]])
    labels = np.array([1.0, 0.0, 1.0])
    seen = {}
    network.step = lambda g, rate: seen.update(g)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    network.learn(words, at, labels, 0.0)

    def loss():
        p = toxicity.sigmoid(network.forward(network.gates_of(network.inputs(words)), at)[0].astype(np.float64))
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    rng = np.random.default_rng(0)
    for name, g in seen.items():
        flat, values = g.ravel(), network.p[name].ravel()
        touched = np.flatnonzero(flat)
        for i in rng.choice(touched, min(6, len(touched)), replace=False):
            before = values[i]
            steps = []
            for d in (1e-2, -1e-2):
                network.p[name].ravel()[i] = before + d
                steps.append(loss())
            network.p[name].ravel()[i] = before
            assert (steps[0] - steps[1]) / 2e-2 == pytest.approx(flat[i], rel=0.05, abs=2e-4), name


def test_windows_cover_every_word():
    starts = np.array([0, 0, 5, 5 + 32, 37 + 33, 70 + 100])
    owner, first, last = toxicity.windows_of(starts)
    assert not (owner == 0).any()
    for text in range(1, 5):
        a, b = first[owner == text], last[owner == text]
        assert a[0] == starts[text] and b[-1] == starts[text + 1]
        assert (a[1:] <= b[:-1]).all() and (b - a <= toxicity.WINDOW).all()


def test_toxicity_held_out_and_defined_cases(spark):
    clean = ["the quiet river runs past a green hill and a mill %d" % n for n in range(150)]
    toxic = ["the quiet river runs past you vile %s and a hill %d" % (w, n) for n, w in enumerate(["skunk", "toad"] * 20)]
    network = toxicity.trained(clean + toxic, [0] * 150 + [1] * 40)
    texts = [(n, t, "x") for n, t in enumerate(["a mill by the river"] * 3 + ["you vile toad"] * 2 + ["hill " * 40_000 + "you vile skunk"])]
    df = spark.createDataFrame(texts + [(90 + i, t, s) for i, (_, t, s) in enumerate(ODD)] + [(None, "x", "x")], ODD_SCHEMA)
    got = toxicity.score(df, network).collect()
    scores = {r["doc_id"]: r["score"] for r in got}
    assert [scores[i] >= 0.5 for i in range(6)] == [False] * 3 + [True] * 3
    assert len(got) == len(texts) + len(ODD) + 1 and all(0 <= r["score"] <= 1 for r in got)
    assert scores[90] == scores[91] == network.prior
    assert [r["worst"] for r in got if r["doc_id"] == 5][0] >= 39_900
    assert toxicity.kept(df, network, 0.5).columns == df.columns
    assert toxicity.score(df.where("false"), network).count() == 0


def test_toxicity_learns_nothing_from_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.learned(docs, labels).prior == 0.0


# ---------------------------------------------------------------- language


def test_language_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = [r for r in QUERIES["op5_language"](spark, SF).collect()]
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97


def test_language_defined_cases(spark):
    docs = spark.createDataFrame(
        [(n, t, l) for n, (t, l) in enumerate([("the house and the tree", "en"), ("das haus und der baum", "de")] * 20)]
        + [(None, "x", "en"), (99, None, "de"), (98, "y", None)], "doc_id long, text string, lang string")
    known = language.learned(docs)
    assert set(known) == {"en", "de"}
    rows = language.identify(spark.createDataFrame(ODD, ODD_SCHEMA), known).collect()
    assert [r["best"] for r in rows if r["doc_id"] in (1, 2, 5)] == ["und"] * 3
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    narrow = language.identify(spark.createDataFrame([(1, "zzz")], "doc_id long, text string"), known, margin=0.5).first()
    assert narrow["rejected"] and narrow["lang"] is None and narrow["best"] in known
    assert language.identify(docs.where("false"), known).count() == 0
    assert language.learned(docs.where("false")) == {}


# ---------------------------------------------------------------- packing


def test_ids_equal_the_tokenizer(spark):
    whole = Tokenizer.from_file(FILES[0])
    encode = tokens.Encoder(*FILES)
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect()]
    for text in texts + [t or "" for _, t, _ in ODD]:
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_added_tokens_inside_texts_get_their_ids():
    whole = Tokenizer.from_file(FILES[0])
    encode = tokens.Encoder(*FILES)
    end = "<|endoftext|>"
    for text in (end, f"{end} a", f"a{end}b", f"日本 {end}{end} x", "<|endoftext", f"plain text\n{end}\n", "no such token"):
        ids = np.frombuffer(encode(text), "<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids
        assert ids.count(whole.token_to_id(end)) == text.count(end)


@pytest.mark.parametrize("parts", [1, 3])
def test_packing_round_trip(spark, parts):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300)
    docs = docs.union(spark.createDataFrame([(10**6 + n, t) for n, (_, t, _) in enumerate(ODD)], "doc_id long, text string"))
    rows = packed(docs.repartition(parts)).collect()
    encode = tokens.Encoder(*FILES)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        assert len(r["ids"]) == 4 * r["length"]
    for doc_id, text in docs.collect():
        pieces = sorted(by_doc[doc_id], key=lambda r: r["start"])
        ids = b"".join(bytes(p["ids"]) for p in pieces)
        assert ids == encode(text or "") + (1).to_bytes(4, "little")
        assert [p["start"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces)]).tolist()[:-1]
        assert {p["doc_tokens"] for p in pieces} == {len(ids) // 4}
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in pieces] == np.cumsum([0, *(p["length"] for p in pieces)]).tolist()[:-1]
        used = sum(p["length"] for p in pieces)
        padding += 0 if used & (used - 1) == 0 else 2048 - used
    assert padding == 0


def test_neighbours_fill_the_seed_window(spark):
    vocabulary = np.arange(1000, 3000)
    rng = np.random.default_rng(0)
    topic = [rng.choice(vocabulary[n * 500:(n + 1) * 500], 100) for n in (0, 1, 2, 0, 1, 2)]
    packer = packing.Packer(200, 0)
    rows = list(packer.shard([(n, t.astype("<u4")) for n, t in enumerate(topic)]))
    together = collections.defaultdict(set)
    for row in rows:
        together[row[5]].add(row[0])
    assert list(together.values()) == [{0, 3}, {1, 4}, {2, 5}]


def test_neighbours_come_from_all_partitions(spark):
    rng = np.random.default_rng(0)
    topics = [rng.integers(0, 10**6, 40) for _ in range(48)]
    # Copy n of each topic, far from the other one: in other input partitions and shards.
    rows = [(100 * copy + n, " ".join(f"w{w}" for w in rng.permutation(t))) for copy in range(2) for n, t in enumerate(topics)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(8, "doc_id")
    together = collections.defaultdict(set)
    for r in packing.pack(docs, *FILES, window=400, shard_docs=12).collect():
        together[r["sequence_id"]].add(r["doc_id"])
    met = sum(any({n, 100 + n} <= docs for docs in together.values()) for n in range(48))
    assert met >= 36


def test_neighbours_by_all_terms_and_the_collections_idf():
    # Terms 10 to 19 are rarer than 20 to 39, which document 2 shares with the seed.
    documents = [np.arange(10, 40), np.r_[10:19, 50:71], np.r_[20:40, 80:90]]
    df = np.full(100, 9)
    df[10:20] = 8
    index = packing.Index(documents, packing.Statistics(1000, 30.0, df))
    assert index.neighbours(0, np.array([False, True, True])).tolist() == [2, 1]
    df[10:20] = 1000
    df[20:40] = 1000
    df[12] = 2
    index = packing.Index(documents, packing.Statistics(1000, 30.0, df))
    assert index.neighbours(0, np.array([False, True, True])).tolist() == [1, 2]


def test_key_terms_of_many_documents_at_once():
    rng = np.random.default_rng(4)
    documents = [rng.integers(2, 300, rng.integers(0, 40)).astype("<u2") for _ in range(200)]
    documents = [np.append(d, packing.END_ID).astype("<u2") for d in documents]
    statistics = packing.Statistics.of(documents)

    def wanted(ids):
        terms = sorted({int(t) for t in ids if statistics.df[t] > 1}, key=lambda t: (statistics.df[t] <= packing.NEIGHBOURS, statistics.df[t], t))
        return (terms + [-1] * packing.KEY_TERMS)[:packing.KEY_TERMS]

    assert statistics.keys(documents).tolist() == [wanted(d) for d in documents]


def test_neighbours_while_documents_are_used_up():
    rng = np.random.default_rng(5)
    documents = [rng.integers(2, 60, 30).astype("<u2") for _ in range(80)]
    statistics = packing.Statistics.of(documents)
    index, unused = packing.Index(documents, statistics), np.ones(80, bool)
    for seed in range(79):
        unused[seed] = False
        fresh = packing.Index(documents, statistics)
        assert index.neighbours(seed, unused).tolist() == fresh.neighbours(seed, unused).tolist()
    assert len(index.live) < 20


def test_packing_no_rows(spark):
    assert packed(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---------------------------------------------------------------- chat


def test_template_language():
    def render(source, **context):
        return "".join(text for text, _ in template.compiled(source)(context))

    assert render("a{# note #}b{{ 1 ~ '2' }}{{ x }}{{ m.y['z'] }}", x=None, m={"y": {"z": 3}}) == "ab123"
    source = "{% for m in ms %}{% if m == 1 %}one{% elif m in (x) and not m == 3 %}some{% else %}{{ m | upper | trim }}{% endif %},{% endfor %}"
    assert render(source, ms=[1, 2, " q "], x=[2, 3]) == "one,some,Q,"
    assert template.fold(template.parse("a{% if 1 < 2 %}{{ 'b' ~ 'c' }}{% else %}d{% endif %}")) == (template.Emit(template.Const("abc")),)
    marked = list(template.compiled("u{% generation %}{{ t }}{% endgeneration %}")({"t": "r"}))
    assert marked == [("u", False), ("r", True)]
    assert render("{{ m.__class__ }}{{ m.keys }}", m={}) == ""
    for bad in ("{% for x %}", "{{ a( }}", "{% import os %}", "{{ a | eval }}", "{% if a %}", "{{ 'a' 'b' }}"):
        with pytest.raises(template.TemplateError):
            template.compiled(bad)


def test_chat_round_trip(spark):
    rows = [
        (1, 1, "assistant", "b <|im_end|>\n\\ \\n <\\|"), (1, 0, "user", "a\n<|im_start|>user\nx"), (1, None, None, None),
        (2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (2, 1, "us\ner", "z" * 300_000), (None, 0, "user", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(1))
    pieces = chat.formatted(df)
    text = collections.defaultdict(str)
    loss = collections.defaultdict(str)
    for r in sorted(pieces.collect(), key=lambda r: (str(r["conv_id"]), r["piece"])):
        text[r["conv_id"]] += r["text"]
        loss[r["conv_id"]] += chat.unescaped(r["text"]) if r["generated"] else ""
    turns = {c: [t[:2] for t in chat.read_turns([t])] for c, t in text.items()}
    assert turns == {
        1: [("", ""), ("user", "a\n<|im_start|>user\nx"), ("assistant", rows[0][3])],
        2: [("assistant", "same"), ("assistant", "same"), ("us\ner", "z" * 300_000)], None: [("user", "")],
    }
    assert loss == {1: rows[0][3], 2: "samesame", None: ""}
    digests = {r["conv_id"]: r for r in chat.read_back(pieces).collect()}
    assert {c: (d["n_turns"], d["formatted_chars"]) for c, d in digests.items()} == {c: (len(turns[c]), len(t)) for c, t in text.items()}
    assert chat.read_back(chat.formatted(df.where("false"))).count() == 0


# ---------------------------------------------------------------- licences


def test_licences(spark):
    lines = [
        "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "All rights reserved.",
        "The licence of a driver is checked at borders.", "no words of that kind here",
    ]
    docs = [(n, f"some text {n}\n{line}\nmore text", "x") for n, line in enumerate(lines)]
    docs += [(10, None, "x"), (11, "", "x"), (None, lines[0], "x"), (12, "filler " * 30_000 + lines[2], "x"), (0, docs[0][1], "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, words string")
    found = licenses.scan(df, licenses.trained(df)).collect()
    named = collections.Counter((r["doc_id"], r["paragraph"], r["family"]) for r in found if r["confirmed"])
    assert named[0, 1, "mit"] == 2 and named[None, 0, "mit"] == 1
    assert {n: f for n, p, f in named if n in range(1, 5)} == {1: "gpl", 2: "apache", 3: "cc-by-nc", 4: "proprietary"}
    assert not any(n in (5, 6, 10, 11) for n, _, _ in named)
    assert licenses.scan(df.where("false"), licenses.trained(df)).count() == 0
    assert licenses.trained(df.where("false")).bar >= 0.5


def test_licences_without_signal_words_and_wrapped(spark):
    texts = {
        1: 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND', 2: "SPDX: Apache-2.0", 3: "GPL-3.0-or-later",
        4: "Released under GPLv3", 5: "CC BY 4.0", 6: "CC0 / public domain",
        7: "This program is free software: you can\nredistribute it and/or modify it under the\nterms of the GNU General Public\n"
           "License as published by the Free Software\nFoundation, either version 3",
        8: "a quiet mill by the river\nand nothing of that kind", 9: "\n \n--\n",
    }
    plain = [(100 + n, f"the quiet river {n} runs past a green hill\nand a mill {n} stands there\n\nuntil the road ends") for n in range(60)]
    df = spark.createDataFrame([(n, f"intro words {n}\n\n{t}\r\n\r\nan end") for n, t in texts.items()] + plain, "doc_id long, text string")
    found = licenses.scan(df, licenses.trained(df)).collect()
    named = {(r["doc_id"], r["paragraph"], r["lines"]): r["family"] for r in found if r["confirmed"]}
    want = {1: "mit", 2: "apache", 3: "gpl", 4: "gpl", 5: "cc-by", 6: "cc0"}
    assert {n: named.get((n, 2, 1)) for n in want} == want
    assert named[7, 2, 5] == "gpl"
    assert {n for n, _, _ in named} == set(range(1, 8))


def test_every_template_is_looked_at(spark):
    texts = [t for family in licenses.TEMPLATES.values() for t in family]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert licenses.paragraphs(df, "doc_id", "text").count() == len(texts)


def test_licence_scores_and_the_pattern_before_them(spark):
    """Probabilities are those of the weights, and the pattern leaves out no paragraph that reaches the bar."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    classifier = licenses.trained(docs, sample=100)
    weights, start = classifier.model.coefficientMatrix.toArray(), classifier.model.interceptVector.toArray()
    place = {run: i for i, run in enumerate(classifier.runs.vocabulary)}
    every = classifier.probabilities(licenses.paragraphs(docs, "doc_id", "text")).collect()
    pattern, told = re.compile(classifier.told()), 0
    assert pattern.pattern != "[a-z0-9]"
    for row in every:
        words = row["words"]
        runs = {" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}
        z = start + weights[:, [place[r] for r in runs if r in place]].sum(axis=1)
        chances = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert row["probability"] == pytest.approx(chances.max(), abs=2e-6)
        if row["likeliest"] != licenses.UNKNOWN and row["probability"] >= classifier.bar:
            told += 1
            assert pattern.search(row["line"].lower())
    assert 0 < told < len(every) / 2
    found = licenses.scan(docs, classifier)
    classifier.told = lambda: "[a-z0-9]"
    whole = licenses.scan(docs, classifier)
    assert found.exceptAll(whole).count() == 0 and whole.exceptAll(found).count() == 0


def test_telling_words_leave_too_little_weight():
    runs = ["licence", "mit", "mit licence", "of", "of the", "the"]
    gaps = np.array([[1.0, 3.0, 2.0, 0.2, 0.1, -1.0], [0.5, -2.0, 0.0, 0.1, 0.0, 0.2]])
    start = np.array([-1.0, -1.0])
    assert licenses.telling_words(gaps, start, runs, {"licence": 1}, 0.0) == ["mit", "licence"]
    assert licenses.telling_words(gaps, start, runs, {}, 9.0) == []
    assert licenses.telling_words(gaps, start + 3, runs, {}, 0.0) is None


def test_the_licence_sample_is_bounded(spark):
    rows = [(1, "same text")] * 500 + [(2, f"other {n}") for n in range(50)] + [(3, "x" * 2000), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    some = licenses.drawn(df, 20, 1000, "doc_id", "text", 5).collect()
    assert len(some) == 20 and len({r["_text"] for r in some}) == 20
    assert all(len(r["_text"]) <= 1000 for r in licenses.drawn(df, 500, 1000, "doc_id", "text", 5).collect())


# ---------------------------------------------------------------- mixing


def poisson(rate, u):
    k, p = 0, math.exp(-rate)
    reached = p
    while reached <= u and k < rate + 12 * math.sqrt(rate) + 30:
        k += 1
        p *= rate / k
        reached += p
    return k


def test_mixing_counts_and_weights(spark):
    rows = [(n, f"t{n}", "big" if n % 4 else "small", n) for n in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int")
    got = mixing.mix(df, {"big": 1.0, "small": 3.0}, epochs=2.0).collect()
    counts = collections.Counter(r["source"] for r in got)
    assert counts["small"] == pytest.approx(6000, rel=0.05) and counts["big"] == pytest.approx(2000, rel=0.08)
    import hashlib

    each = collections.Counter(r["doc_id"] for r in got)
    for n in range(0, 4000, 97):
        u = int(hashlib.md5(f"{n}#17".encode()).hexdigest()[:13], 16) / 2**52
        assert each[n] == poisson(6.0 if n % 4 == 0 else 2000 / 3000, u)


def test_mixing_keeps_columns_of_any_name(spark):
    names = ["_rate", "_source", "_sums", "_chunks", "_weight", "_deal", "_salt", "_row", "_of", "_key", "copy"]
    df = spark.createDataFrame([(n, "s", *names) for n in range(50)], ["doc_id", "source", *names])
    plain = mixing.mix(df.select("doc_id", "source")).collect()
    got = mixing.mix(df)
    assert got.columns == ["doc_id", "source", *names[:-1], "copy", "repeats", "shuffle_key"]
    assert collections.Counter((r["doc_id"], r["copy"]) for r in got.collect()) == collections.Counter(
        (r["doc_id"], r["copy"]) for r in plain
    )
    assert {r["_rate"] for r in got.collect()} == {"_rate"}


def test_samples_stay_bounded_where_an_id_repeats(spark):
    docs = spark.createDataFrame(
        [(7, f"text number {n}", "xx") for n in range(300)] + [(n, "some other words", "yy") for n in range(100, 140)],
        "doc_id long, text string, lang string",
    )
    labels = spark.createDataFrame([(7, 1)] * 20 + [(n, 0) for n in range(100, 140)], "doc_id long, toxic int")
    seen = []

    def trained(texts, marks, **options):
        seen.extend(zip(texts, marks))

    before, toxicity.trained = toxicity.trained, trained
    try:
        toxicity.learned(docs, labels, sample=5)
    finally:
        toxicity.trained = before
    assert sorted(seen) == [("some other words", 0)] * 10 + [("text number 0", 1)]
    assert set(language.learned(docs, samples=4)) == {"xx", "yy"}


def test_mixing_defined_cases(spark, monkeypatch):
    rows = [(1, "a", None), (2, None, "s"), (None, "", "s"), (3, "b", "t"), (3, "b", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, {"s": 1.0, "t": 1.0}, epochs=2000.0)
    counts = collections.Counter(r["doc_id"] for r in got.collect())
    # Rates far above what one draw holds, drawn as sums.
    assert counts[1] == 0 and all(abs(counts[i] - m) < 6 * m**0.5 for i, m in ((2, 2500), (None, 2500)))
    assert counts[3] == 2 * (counts[3] // 2) and abs(counts[3] - 5000) < 12 * 2500**0.5
    same = collections.Counter(map(tuple, mixing.mix(df).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert collections.Counter(map(tuple, mixing.mix(df).collect())) == same
    assert mixing.mix(df.where("false")).count() == 0


def test_licences_are_learned_from_all_documents(spark):
    """Not from a sample: texts of any length count, and what only one of many documents has too."""
    plain = [(n, f"the quiet river {n} runs past a green hill\nand a mill stands there") for n in range(1500)]
    long = "a quiet mill by the river\n" * 5000 + "software that was published"
    df = spark.createDataFrame([*plain, (5000, long), (None, None)], "doc_id long, text string")
    common = licenses.trained(df).common
    # Each line, and each run of lines, of every document.
    assert common["software"] == common["published"] == 2
    assert common["the"] == 2 * 1500 + 5000 + 1
    assert common["a"] == 3 * 1500 + 5000 + 1


def test_known_runs_are_the_runs_of_the_vocabulary(spark):
    texts = ["the mit licence of the mit licence", "of", "", "mit x licence of the", "the of the mit", "x y z", "licence of the"]
    vocabulary = ["licence", "licence of the", "mit", "mit licence", "of", "of the", "the", "the mit licence"]
    df = spark.createDataFrame([(n, t.split()) for n, t in enumerate(texts)], "n long, words array<string>")
    found = {r["n"]: r["runs"] for r in licenses.known_runs(df, vocabulary).collect()}
    for n, text in enumerate(texts):
        words = text.split()
        every = {" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)}
        assert found[n] == sorted(every & set(vocabulary))


def test_every_paragraph_with_a_name_or_signal_holds_a_stem():
    rng = random.Random(3)
    parts = [*licenses.STEMS, "licen", "ce", "se", "a", "l", "AGPL", "LGPL", "MIT", "cc by", "CC-BY", "cc0", " ", "-", "x", "as is", "s"]
    pattern = re.compile(f"{licenses.SIGNALS}|{licenses.NAMES}", re.I | re.A)
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(4))
        assert not pattern.search(text) or any(stem in text.lower() for stem in licenses.STEMS)
