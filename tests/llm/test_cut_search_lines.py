"""Fill-in-middle, lexical search and line deduplication against brute force and SQL."""

import gc
import hashlib
import math
import random
import re
import weakref
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from compare import connect, mismatch
from learnlog.llm import fill_in_middle, lexical, line_dedup, oracle, queries
from learnlog.llm.shared import new_folder

NAMES = ["op11_fill_in_middle", "op12_lexical_search", "op13_line_dedup"]
IDS = [1, 2, None, 3, 4, 5, 5, 6, 7, None, 8, 9]  # of the odd rows


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, sf_dir, name):
    df = queries.queries()[name](spark, sf_dir)
    assert mismatch(df, connect(sf_dir), oracle.statements()[name]) is None


def by_null(rows, key="doc_id"):
    return sorted((r[key] is None, r[key] or 0) for r in rows)


# --- fill-in-middle ---------------------------------------------------------------


def sorted_values(kind, draw):
    if kind == "array":
        return np.array(sorted(draw.sample(range(65536), 300)))
    if kind == "bitmap":
        return np.array(sorted(draw.sample(range(65536), 30000)))
    starts = sorted(draw.sample(range(0, 65536, 400), 40))
    return np.concatenate([np.arange(s, s + draw.randint(1, 300)) for s in starts])


@pytest.mark.parametrize("kind", ["array", "bitmap", "runs"])
def test_containers_select(kind):
    values = sorted_values(kind, random.Random(3))
    found = fill_in_middle.container(values)
    assert type(found).__name__.lower().startswith(kind.rstrip("s"))
    assert [found.select(i) for i in range(len(values))] == values.tolist()
    whole = fill_in_middle.container(np.arange(65536))
    assert isinstance(whole, fill_in_middle.RunContainer) and whole.select(65535) == 65535


def test_boundary_set_over_containers():
    draw, found, values = random.Random(4), fill_in_middle.BoundarySet(), []
    for high, kind in ((0, "runs"), (2, "bitmap"), (3, "array"), (70_000, "array")):
        part = sorted_values(kind, draw)
        found.append(high, part)
        values += (part + high * 65536).tolist()
    found.append(70_001, np.array([], int))
    assert len(found) == len(values)
    assert [found.select(i) for i in range(0, len(values), 7)] == values[::7]
    for rank in (-1, len(values)):
        with pytest.raises(IndexError):
            found.select(rank)


@pytest.mark.parametrize(
    "text",
    ["", "a", "\n", "a\n", "a\n\nb", "é中\n😀\n", "\n" * 70_000, "x" * 65_535 + "\n" + "y" * 65_536 + "\nz",
     "ab\n" * 60_000, "中\n" * 40_000 + "end"],
)
def test_line_ends(text):
    ends = fill_in_middle.line_ends(text)
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    assert len(ends) == len(lines)
    upto = np.cumsum([len(x) for x in lines])
    picks = range(0, len(lines), max(1, len(lines) // 50))
    assert [ends.select(i) + 1 for i in picks] == [int(upto[i]) for i in picks]


def expected_fim(doc_id, text, rate=100, spm=50, salt="7"):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(lines)
    if not n or h[2] % 100 >= rate or any(m in text for m in fill_in_middle.MARKERS):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    form = "spm" if h[3] % 100 < spm else "psm"
    output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return n, form, len(p), len(m), output


def test_fill_in_middle_on_odd_texts(spark, odd):
    draw = random.Random(5)
    letters = ["\n", "\n", "a", "<", "P", ">", "é", "😀", "\r", " ", "<S", "\x00"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 30))) for _ in range(300)]
    more = spark.createDataFrame(list(enumerate([*texts, "a<P>b\nc\n", "<M>"])), "doc_id bigint, text string")
    for docs, rate, spm in ((odd, 100, 50), (more, 100, 50), (more, 40, 100), (more, 0, 0)):
        rows = fill_in_middle.transform(docs, rate, spm)
        rows = rows.withColumn("restored", fill_in_middle.restored()).collect()
        given = docs.select("doc_id", "text").collect()
        want = sorted(str((i, *expected_fim(i, t, rate, spm), t or "")) for i, t in given)
        assert sorted(str(tuple(r)) for r in rows) == want


def test_other_markers(spark):
    docs = spark.createDataFrame([(i, "one\ntwo\n|a|three\n") for i in range(20)], "doc_id int, text string")
    marks = ("|pre|", "|suf|", "|mid|")
    rows = fill_in_middle.transform(docs, markers=marks, salt="x")
    rows = rows.withColumn("restored", fill_in_middle.restored(markers=marks)).collect()
    assert {r["form"] for r in rows} == {"psm", "spm"}
    assert {r["restored"] for r in rows} == {"one\ntwo\n|a|three\n"}


def test_fill_in_middle_of_nothing(odd):
    assert fill_in_middle.transform(odd.where("false")).collect() == []


# --- lexical search -----------------------------------------------------------------


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def expected_ranks(docs, items, top):
    counts = [(i, Counter(words(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    terms = defaultdict(set)
    for key, text in items:
        terms[key] |= set(words(text))
    rows = []
    for key, wanted in terms.items():
        scored = []
        for i, c in counts:
            m = 50 + 50 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in wanted if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        rows += [(key, r, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:top], 1)]
    return sorted(rows, key=str)


@pytest.fixture()
def small_segments(monkeypatch):
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", 40)
    monkeypatch.setattr(lexical, "FIRST_STRATA", 1)


def zipf_docs(n, seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    texts = [" ".join(draw.choices(vocabulary, weights, k=draw.randint(0, 60))) for _ in range(n - 60)]
    return [*enumerate(texts), *[(n + i, "same W1 w2, copies") for i in range(60)]]


@pytest.mark.parametrize("top", [1, 7, 500])
def test_search_against_brute_force(spark, small_segments, monkeypatch, top):
    docs = zipf_docs(700, top)
    items = [(i, " ".join(random.Random(i).choices([f"w{j}" for j in range(210)], k=6))) for i in range(30)]
    items += [(100, "Same copies"), (101, "unknown"), (102, ""), (103, None), (104, "w1"), (104, "w2")]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    queries_ = spark.createDataFrame(items, "item_id int, text string")
    index = lexical.build(rows, new_folder(spark, "lexical"))
    assert index == lexical.load(spark, index.folder)
    want = expected_ranks(docs, items, top)
    assert sorted(map(tuple, lexical.search(spark, index, queries_, top).collect()), key=str) == want
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 20)  # many blocks
    assert sorted(map(tuple, lexical.search(spark, index, queries_, top).collect()), key=str) == want


def test_index_of_strata(spark, small_segments):
    """Every posting lies in its stratum and group; every document with a term is indexed."""
    docs = zipf_docs(500, 2)
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    index = lexical.build(rows, new_folder(spark, "lexical"))
    counts = {i: Counter(words(t)) for i, t in docs}
    found = defaultdict(Counter)
    for row in index.segments(spark, *lexical._SEGMENT).collect():
        a = {k: np.frombuffer(v, "<i8" if k in ("ids", "stratum_m") else "<i4")
             for k, v in row.asDict().items() if k not in ("terms", "known")}
        for at, term in enumerate(row["terms"].split(b" ")):
            first, end = a["group_ends"][at - 1] if at else 0, a["group_ends"][at]
            groups = list(zip(a["group_stratum"][first:end], a["group_count"][first:end]))
            assert groups == sorted(set(groups))
            for g in range(first, end):
                low = a["group_posting_ends"][g - 1] if g else 0
                for place in a["postings"][low : a["group_posting_ends"][g]]:
                    stratum = a["group_stratum"][g]
                    assert (a["stratum_ends"][stratum - 1] if stratum else 0) <= place < a["stratum_ends"][stratum]
                    doc_id = int(a["ids"][place])
                    found[doc_id][term.decode()] = int(a["group_count"][g])
                    n = counts[doc_id].total()
                    assert a["stratum_m"][stratum] == 50 + 50 * n * index.n_docs // index.n_terms
    assert found == {i: c for i, c in counts.items() if c}


def test_segments_do_not_pile_up(spark, small_segments):
    """A segment is a row group by itself, whose footer holds no values, and is freed when it is written."""
    rows = spark.createDataFrame(zipf_docs(500, 3), "doc_id bigint, text string").coalesce(1)
    index = lexical.build(rows, new_folder(spark, "lexical"))
    files = index.segments(spark, "ids").inputFiles()
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(i) for f in files
              for i in range(pq.ParquetFile(f.removeprefix("file://")).metadata.num_row_groups)]
    assert len(groups) > 10 and all(g.num_rows == 1 for g in groups)
    assert not any(g.column(i).is_stats_set for g in groups for i in range(g.num_columns))
    segment, word = lexical._Segment(), type("Word", (), {})()
    assert [segment.index[w] for w in (b"a", word, b"a")] == [0, 1, 0]
    left = weakref.ref(word)
    gc.disable()
    try:
        del segment, word
        assert left() is None
    finally:
        gc.enable()


def test_bounds_skip_strata():
    """Strata whose bound is below the last place are not visited."""
    segment = lexical._Segment()
    for i in range(300):
        segment.add(i, b"rare " * (1 if i < 2 else 0) + b"common " + b"fill " * i)
    row = segment.row(300, sum(segment.lengths)).to_pylist()[0]
    opened = lexical._Open(row, {b"rare": 0, b"common": 1})
    best = lexical.Best(2)
    assert opened.strata > 50
    assert lexical.visit(opened, [(0, 5000), (1, 1)], best) <= 2 * lexical.FIRST_STRATA
    assert sorted(best.ids.tolist()) == [0, 1]


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 16)
    draw = random.Random(1)
    for _ in range(200):
        text = "".join(draw.choice("aB9 é.\n") for _ in range(draw.randint(0, 80)))
        found = [t.decode() for part in lexical.terms_of(text.encode()) for t in part]
        assert found == words(text)


def test_search_on_odd_rows(spark, odd, benchmark):
    index = lexical.build(odd, new_folder(spark, "lexical"))
    rows = lexical.search(spark, index, benchmark, 4).collect()
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    items = [tuple(r) for r in benchmark.collect()]
    assert sorted(map(tuple, rows), key=str) == expected_ranks(docs, items, 4)


def test_search_of_nothing(spark, odd, benchmark):
    empty = lexical.build(odd.where("false"), new_folder(spark, "lexical"))
    assert (empty.n_docs, lexical.search(spark, empty, benchmark).collect()) == (0, [])
    index = lexical.build(odd, new_folder(spark, "lexical"))
    none = lexical.search(spark, index, benchmark.where("false"))
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.collect() == []


# --- line deduplication ---------------------------------------------------------------


def expected_lines(docs, threshold=2, least=10):
    def key(line):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
        return low.strip(" \t\n\x0b\x0c\r")

    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(i)
    first = {
        k: min(ids, key=lambda i: (i is None, i or 0)) for k, ids in holders.items() if len(ids) >= threshold
    }
    rows = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in first or first[key(x)] == i]
        rows.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(rows, key=str)


@pytest.mark.parametrize("threshold", [2, 3])
def test_lines_against_brute_force(spark, monkeypatch, threshold):
    monkeypatch.setattr(line_dedup, "BLOCK", 64)
    monkeypatch.setattr(line_dedup, "ROWS", 16)
    draw = random.Random(threshold)
    pool = ["short", "A Line that Repeats", "\ta line that repeats \r", "éééééééééé", "ééééééééé", "",
            "another shared line", "x" * 200, " " * 30, "tab\tinside the line", "中" * 9, "中" * 10]
    docs = [
        (i % 37 if i % 11 else None,
         "\n".join(draw.choice([*pool, f"own line number {i}"]) for _ in range(draw.randint(0, 9))) or None)
        for i in range(120)
    ]
    docs += [(5, docs[5][1]), (200, "a line that repeats\nA LINE THAT REPEATS"), (201, "\n" * 300)]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    rows = line_dedup.drop_lines(frame, threshold)
    assert sorted(map(tuple, rows.collect()), key=str) == expected_lines(docs, threshold)


def test_lines_on_odd_rows(odd):
    rows = line_dedup.drop_lines(odd).collect()
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert sorted(map(tuple, rows), key=str) == expected_lines(docs)
    assert by_null(rows) == sorted((i is None, i or 0) for i in IDS)
    assert line_dedup.drop_lines(odd.where("false")).collect() == []


def test_a_line_of_every_document_stays_once(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('The notice of all.\nOwn words of ', id) as text")
    rows = line_dedup.drop_lines(docs)
    assert rows.where("n_dropped = 0").select("doc_id").collect() == [(0,)]
    assert rows.where("doc_id > 0 and kept = concat('Own words of ', doc_id)").count() == 2999
