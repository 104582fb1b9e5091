"""Every operator on odd rows and on empty tables: defined results, no crash."""

import public_tokenizers
import pytest
from learnlog.llm import (
    decontaminate, html_blocks, language_kn, licenses, pieces, quality_crf, simhash, sketches,
    token_records, toxicity,
)
from learnlog.llm.shared import new_folder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def run_records(docs):
    folder = new_folder(docs.sparkSession, "records")
    token_records.write(docs, folder, WORDS, end_id=2)
    return token_records.read(docs.sparkSession, folder)


def operators(labels, benchmark):
    return {
        "records": run_records,
        "quality": lambda d: quality_crf.score(d, quality_crf.fit(d, labels)),
        "language": lambda d: language_kn.identify(d, language_kn.fit(d)),
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels)),
        "sketches": sketches.with_next,
        "licenses": licenses.summary,
        "simhash": simhash.groups,
        "pieces": lambda d: pieces.round_trip(d, PIECES),
        "decontaminate": lambda d: decontaminate.scan(d, benchmark),
        "decontaminate in blocks": lambda d: decontaminate.scan(d, benchmark, block_words=8),
    }


NAMES = list(operators(None, None))


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(odd, labels, benchmark, name):
    rows = operators(labels, benchmark)[name](odd).collect()
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)
    assert ids == sorted((i is None, i or 0) for i in [1, 2, None, 3, 4, 5, 5, 6, 7, None, 8, 9])
    fives = [r for r in rows if r["doc_id"] == 5]
    same = {k: v for k, v in fives[0].asDict().items() if k not in ("start", "record", "next_text", "next_sketch")}
    assert all(fives[1][k] == v for k, v in same.items())
    if name in ("quality", "language", "toxicity"):
        assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(odd, labels, benchmark, name):
    assert operators(labels, benchmark)[name](odd.where("false")).collect() == []


def test_no_labels(odd, labels):
    none = labels.where("false")
    assert {r["score"] for r in quality_crf.score(odd, quality_crf.fit(odd, none)).collect()} == {0.5}
    assert {r["score"] for r in toxicity.score(odd, toxicity.fit(odd, none)).collect()} == {0.5}


def test_no_benchmark(odd, benchmark):
    rows = decontaminate.scan(odd, benchmark.where("false")).collect()
    assert len(rows) == 12 and not any(r["spans"] or r["items"] for r in rows)


def test_blocks_agree(odd, benchmark):
    def rows(block_words):
        found = decontaminate.scan(odd, benchmark, block_words=block_words).collect()
        return sorted(map(str, found))

    assert rows(8) == rows(500_000)


def test_filters_keep_columns(odd, labels, benchmark):
    kept = decontaminate.remove_documents(odd, benchmark)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 2, 3, 4, 8, 9]
    one = simhash.keep_one(odd)
    assert one.columns == odd.columns
    # 1 and 5 are copies; 2, 3 and 4 have no word and share fingerprint zero.
    assert sorted(r["doc_id"] or 0 for r in one.collect()) == [0, 0, 1, 2, 6, 7, 8, 9]
    known = language_kn.keep_known(odd, language_kn.fit(odd))
    assert known.columns == odd.columns
    assert quality_crf.keep_good(odd, quality_crf.fit(odd, labels)).columns == odd.columns


def test_texts_under_one_id_are_not_lost(spark):
    one, other = "a b c d e f g h i j k l", "quite another text with words of its own in it"
    rows = [(5, one, 1), (5, other, 2), (5, one, 1), (6, one, 3), (7, other, 4), (8, "third one here", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, text_key int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(5, one, 1), (5, other, 2), (8, "third one here", 5)]


def test_pages(spark):
    rows = [(1, "u", None, 1), (None, None, "<p>a</p>", 1), (2, "v", "", 1), (2, "v", "<p>x<br>y", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    found = html_blocks.extract(pages)
    assert sorted((r["page_id"] or 0, r["text"]) for r in found.collect()) == [
        (0, "a"), (1, ""), (2, ""), (2, "x y"),
    ]
    assert html_blocks.extract(pages.where("false")).collect() == []
