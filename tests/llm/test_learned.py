"""Learned operators by their held-out accuracy, and the pipeline by its stages."""

import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from learnlog.llm import language_kn, quality_crf, queries
from learnlog.llm.shared import documents, table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def held_out(spark, name, other, column):
    rows = queries.queries()[name](spark, SF)
    assert rows.count() == documents(spark, SF).count()
    joined = rows.where("held_out").join(table(spark, SF, other).select("doc_id", column), "doc_id")
    return joined.collect()


def test_quality(spark):
    rows = held_out(spark, "op2_quality_crf", "labels", "quality")
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def test_toxicity(spark):
    rows = held_out(spark, "op4_toxicity", "labels", "toxic")
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.93
    assert np.mean([r.predicted for r in rows if not r.toxic]) < 0.03


def test_language(spark):
    rows = held_out(spark, "op3_language_kn", "documents", "lang")
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98
    assert np.mean([r.rejected for r in rows]) < 0.01


def test_language_rejects_what_it_has_not_seen(spark):
    model = language_kn.fit(documents(spark, SF))
    texts = ["qwrtzp xkcd vvvv " * 20, "это русский текст", "12 34", None, "The of and that was in the"]
    best, sure, rejected = model.judge(texts)
    assert rejected.tolist() == [True, True, True, True, False]
    assert best.tolist()[2:4] == [-1, -1] and sure.tolist()[2:4] == [0, 0]


def kneser_ney(texts, order, floor):
    """Interpolated Kneser-Ney of one language, n-gram by n-gram, as a function of a tuple."""
    counts = [Counter() for _ in range(order + 1)]
    for text in texts:
        symbols = language_kn.symbols_of(text).tolist()
        counts[order].update(tuple(symbols[i : i + order]) for i in range(len(symbols) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k].update(gram[1:] for gram in counts[k + 1])

    totals = [Counter() for _ in counts]
    kinds = [Counter() for _ in counts]
    for k in range(1, order + 1):
        for gram, n in counts[k].items():
            totals[k][gram[:-1]] += n
            kinds[k][gram[:-1]] += 1

    def p(gram):
        k = len(gram)
        if not k:
            return floor
        lower, context = p(gram[1:]), gram[:-1]
        if not totals[k][context]:
            return lower
        ones, twos = (sum(n == i for n in counts[k].values()) for i in (1, 2))
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        own = max(counts[k][gram] - d, 0) / totals[k][context]
        return own + d * kinds[k][context] / totals[k][context] * lower

    return p


def packed_of(grams):
    return np.array([sum(c << (16 * (len(g) - 1 - i)) for i, c in enumerate(g)) for g in grams], np.uint64)


def test_language_model_against_brute_force(spark):
    rows = [
        (1, "the cat sat on the mat", "en"), (2, "the dog and the cat", "en"), (3, "that that", "en"),
        (5, "der hund und die katze", "de"), (6, "die matte der katze", "de"), (8, "und und", "de"),
    ]
    model = language_kn.fit(spark.createDataFrame(rows, "doc_id int, text string, lang string"), modulus=1, held_out=1)
    texts = {lang: [t for _, t, other in rows if other == lang] for lang in ("de", "en")}
    symbols = sorted({int(c) for _, t, _ in rows for c in language_kn.symbols_of(t)})
    draw = random.Random(3)
    grams = [tuple(draw.choice(symbols) for _ in range(language_kn.ORDER)) for _ in range(100)]
    for text in ("the cat", "die katze", "that dog"):
        own = language_kn.symbols_of(text).tolist()
        grams += [tuple(own[i : i + 4]) for i in range(len(own) - 3)]
    found = np.exp(model.log_p(packed_of(grams)))
    floor = float(np.exp(model.unseen[0]))
    for column, lang in enumerate(model.languages):
        p = kneser_ney(texts[lang], language_kn.ORDER, floor)
        assert np.allclose(found[:, column], [p(g) for g in grams], rtol=1e-4)


@pytest.mark.parametrize("cells", [8_000_000, 32_000])
def test_language_probabilities_sum_to_one(spark, monkeypatch, cells):
    """Over all characters that may follow a context, each interpolated model sums to one."""
    monkeypatch.setattr(language_kn, "MOST_CELLS", cells)  # the smaller leaves n-grams out
    model = language_kn.fit(documents(spark, "/root/testdata/sf0.001"))
    everything = np.unique(language_kn.symbols_of("".join(
        r.text for r in documents(spark, "/root/testdata/sf0.001").select("text").collect()
    )))
    context = language_kn.symbols_of("the")[-4:-1]
    packed = np.array(
        [int(context[0]) << 48 | int(context[1]) << 32 | int(context[2]) << 16 | int(c) for c in everything],
        np.uint64,
    )
    total = np.exp(model.log_p(packed).astype(float)).sum(axis=0)
    assert ((total > 0.97) & (total < 1.001)).all(), total


@pytest.mark.parametrize("cells", [32_000, 0])
def test_language_without_room_for_its_ngrams(spark, monkeypatch, odd, cells):
    """What a text gets does not depend on how many n-grams the tasks hold."""
    docs = documents(spark, "/root/testdata/sf0.001")
    both = docs.select("doc_id", "text", "lang").unionByName(odd.select("doc_id", "text", "lang"))

    def judged():
        model = language_kn.fit(docs)
        rows = language_kn.identify(both, model).collect()
        key = lambda r: (r.doc_id is None, r.doc_id or 0, r.score)
        return model, sorted(rows, key=key)

    whole, expected = judged()
    monkeypatch.setattr(language_kn, "MOST_CELLS", cells)
    model, rows = judged()
    assert whole.rest is None and len(model.levels[-1].grams.hashes) < len(whole.levels[-1].grams.hashes)
    assert [(r.doc_id, r.lang_pred, r.rejected) for r in rows] == [
        (r.doc_id, r.lang_pred, r.rejected) for r in expected
    ]
    assert np.allclose([r.score for r in rows], [r.score for r in expected], atol=1e-5)
    for fitted in ("curve", "expected", "spread", "limit"):
        assert np.allclose(getattr(model, fitted), getattr(whole, fitted), rtol=1e-3), fitted


def test_pipeline_keeps_the_same_languages_without_room(spark, monkeypatch, odd):
    """The language stage keeps the same rows, with copies and all columns, whatever tasks hold."""
    docs = documents(spark, "/root/testdata/sf0.001").select("doc_id", "text", "lang")
    strange = [(-i, text, "en") for i, text in enumerate(["qwrtzp xkcd vvvv " * 20, "это русский текст", "12"], 1)]
    docs = docs.unionByName(odd.select("doc_id", "text", "lang"))
    docs = docs.unionByName(spark.createDataFrame(strange, docs.schema)).withColumn("rejected", F.lit(7))

    def kept():
        rows = corpus_pipeline.language(spark, docs, SF)
        assert rows.columns == docs.columns
        return sorted(map(repr, rows.collect()))

    expected = kept()
    assert 0 < len(expected) < docs.count()
    asked = []
    single = language_kn._values
    monkeypatch.setattr(language_kn, "MOST_CELLS", 0)
    monkeypatch.setattr(language_kn, "_values", lambda m, w: asked.append(w) or single(m, w))
    assert kept() == expected
    assert len(asked) == 3  # the n-grams that tasks hold, the calibration, and the stage itself


def test_language_tables_against_brute_force(spark, monkeypatch):
    """The joined values of n-grams, seen or not, in languages that lack some or all of them."""
    texts = {"de": ["der hund und die katze", "und und"], "en": ["the cat sat on the mat", "the dog"]}
    rows = [(i, text, lang) for lang, own in texts.items() for i, text in enumerate(own)]
    monkeypatch.setattr(language_kn, "_kept", lambda level, most, kept=language_kn._kept: kept(level, 3))
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = language_kn.fit(docs, modulus=1, held_out=1)
    symbols = sorted({int(c) for own in texts.values() for t in own for c in language_kn.symbols_of(t)})
    draw = random.Random(4)
    grams = [tuple(draw.choice(symbols) for _ in range(language_kn.ORDER)) for _ in range(50)]
    own = language_kn.symbols_of("the cat und der hund").tolist()
    grams = sorted({*grams, *(tuple(own[i : i + 4]) for i in range(len(own) - 3))})
    packed = packed_of(grams).view(np.int64).tolist()
    wanted = spark.createDataFrame([(g,) for g in packed], "gram bigint")
    found = {r.gram: r.value for r in language_kn._values(model, wanted).collect()}
    floor = 1 / (len(symbols) + 1)
    p = np.array([[kneser_ney(own, language_kn.ORDER, floor)(g) for own in texts.values()] for g in grams])
    p = np.column_stack([p, p.mean(axis=1)])
    assert np.allclose(np.exp([found[g] for g in packed]), p, rtol=1e-9)


def test_marginals_by_enumeration():
    """Forward-backward of short chains against the sum over all label sequences."""
    from itertools import product

    draw = np.random.default_rng(1)
    lengths = [3, 1, 4]
    emission, chain = draw.normal(size=8), draw.normal(size=(2, 2))
    p, pairs = quality_crf._Chains(lengths).marginals(emission, chain)
    at, expected, counts = 0, [], np.zeros((2, 2))
    for n in lengths:
        weight = {
            y: np.exp(emission[at : at + n] @ y + sum(chain[a, b] for a, b in zip(y, y[1:])))
            for y in product((0, 1), repeat=n)
        }
        total = sum(weight.values())
        expected += [sum(w for y, w in weight.items() if y[i]) / total for i in range(n)]
        for y, w in weight.items():
            for a, b in zip(y, y[1:]):
                counts[a, b] += w / total
        at += n
    assert np.allclose(p, expected) and np.allclose(pairs, counts)


def test_pipeline_stages(spark):
    docs = documents(spark, SF)
    labels = table(spark, SF, "labels")
    before = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        if name != "encoding":
            assert after.columns == docs.columns
        after = corpus_pipeline.materialize(after, f"test-{name}")
        gone = before.join(after.select("doc_id"), "doc_id", "left_anti")
        kept[name] = (after.count(), gone.join(labels, "doc_id", "left").collect())
        before = after
    good = [r.quality for r in kept["quality"][1] if r.quality is not None]
    assert np.mean(good) < 0.1  # few documents with a good label go
    assert len(kept["language"][1]) <= 3
    assert kept["near_duplicates"][0] < kept["language"][0]
    assert kept["contamination"][0] < kept["near_duplicates"][0]
    assert kept["encoding"][0] == kept["contamination"][0]
    assert before.where(F.col("n_tokens") * 4 != F.octet_length("ids")).count() == 0
    ids = {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()}
    assert ids == {r.doc_id for r in before.select("doc_id").collect()}
