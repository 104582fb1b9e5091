"""Operators against brute force on the given tables."""

import hashlib
import random
import re
import time
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from compare import connect, mismatch
from learnlog.llm import (
    decontaminate, html_blocks, licenses, oracle, pieces, queries, simhash, sketches,
    token_records, toxicity,
)
from learnlog.llm.graph import components
from learnlog.llm.shared import WORD_PATTERN, documents, new_folder
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return sorted(tuple(r) for r in documents(spark, sf_dir).select("doc_id", "text").collect())


def by_id(spark, sf_dir, name, key="doc_id"):
    return {r[key]: r for r in queries.queries()[name](spark, sf_dir).collect()}


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def odd_texts(letters, n, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 25))) for _ in range(n)]


def test_token_records(spark, sf_dir, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows, start = by_id(spark, sf_dir, "op1_token_records"), 0
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        row = rows[doc_id]
        crc = zlib.crc32(array("I", ids).tobytes())
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_token_chunks_on_odd_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, encode = Tokenizer.from_file(path), token_records._encoder(path, 2)
    letters = list("abAÉ Zé\n\t  's.,.,!1ß24µ")
    texts = odd_texts(letters, 3000) + odd_texts([*letters, *"́😀中\r\x00ﬁΣİǅ\x85\xa0", "<|endoftext|>"], 3000)
    whole = [[*e.ids, 2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [array("H", b).tolist() for b in encode(texts)] == whole


def test_damaged_records_are_noticed():
    record = token_records.framed(token_records.packed(7, 0, b"\1\0\2\0")) + b"\n"
    assert [token_records.unpacked(p)[0] for _, _, p in token_records.records(record * 2)] == [7, 7]
    for i in range(len(record)):
        broken = bytearray(record)
        broken[i] ^= 4
        with pytest.raises(ValueError):
            list(token_records.records(bytes(broken)))
    with pytest.raises(ValueError):
        list(token_records.records(record[:-1]))


def test_shuffled_records(spark, sf_dir):
    folder = new_folder(spark, "records")
    path = public_tokenizers.path("word_bpe_49k.json")
    token_records.write(documents(spark, sf_dir), folder, path, 2, shard_bytes=50_000)
    plain = {r.doc_id: r.ids for r in token_records.read(spark, folder).collect()}
    index = token_records.index(spark, folder).orderBy("start").collect()
    assert len({r.shard for r in index}) > 3
    assert [r.doc_id for r in index] == sorted(plain)
    mixed = token_records.shuffled(spark, folder, 5, 4).collect()
    assert {r.doc_id: r.ids for r in mixed} == plain and len(mixed) == len(plain)
    assert [r.doc_id for r in mixed] != sorted(plain)


def test_pieces(spark, sf_dir, docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = by_id(spark, sf_dir, "op8_pieces")
    for doc_id, text in docs:
        ids = processor.encode(text, add_bos=True, add_eos=True)
        row = rows[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(processor.decode(ids).encode()).hexdigest()


def test_piece_chunks_on_odd_texts():
    path = public_tokenizers.path("piece_bpe_32k.model")
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    letters = [*"ab Zé\n\t ▁  <s></s>ñ.,!1234́ 😀中\r\x00ﬁ", "<0x0A>", "<unk>", " ⁇ "]
    texts = odd_texts(letters, 6000) + ["", " ", "  ", "\n", "\n\n", " \n", "\n "]
    ids, decoded = pieces._compute(path, True, True)(texts)
    for text, found, back in zip(texts, ids.to_pylist(), decoded.to_pylist()):
        whole = processor.encode(text, add_bos=True, add_eos=True)
        assert array("I", found).tolist() == whole and back == processor.decode(whole)


def test_piece_decoding(spark, odd):
    path = public_tokenizers.path("piece_bpe_32k.model")
    back = pieces.decode(pieces.encode(odd, path), path).collect()
    texts = {r.doc_id: (r.text or "").replace("▁", " ") for r in odd.where("doc_id is not null").collect()}
    assert {r.doc_id: r.text for r in back if r.doc_id is not None} == texts


def test_decontaminate_sql(spark, sf_dir):
    for name, statement in oracle.statements().items():
        assert mismatch(queries.queries()[name](spark, sf_dir), connect(sf_dir), statement) is None


def test_remove_spans():
    text = "Keep this. One, TWO three! And that."
    assert decontaminate.remove_spans(text, [2, 5]) == "Keep this. ! And that."
    assert decontaminate.remove_spans(text, []) == text


def groups_of(prints, radius):
    """Smallest key of each component, by comparing all pairs."""
    keys = sorted(prints)
    values = np.array([prints[k] for k in keys], np.uint64)
    least = dict(zip(keys, keys))

    def root(k):
        while least[k] != k:
            k = least[k]
        return k

    for i, key in enumerate(keys):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius):
            a, b = root(key), root(keys[i + 1 + j])
            least[max(a, b)] = min(a, b)
    return {k: root(k) for k in keys}


def test_simhash(spark, sf_dir, docs):
    prints = {}
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
        found = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in found]
        prints[doc_id] = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    least = groups_of(prints, 3)
    for doc_id, row in by_id(spark, sf_dir, "op7_simhash").items():
        assert (row.fingerprint, row.component_id) == (f"{prints[doc_id]:016x}", least[doc_id])


@pytest.mark.parametrize("bucket", [4096, 4])
def test_links_of_crowded_fingerprints(spark, bucket):
    """Clouds of near fingerprints, with buckets compared at once and split again."""
    draw = random.Random(3)
    prints = set()
    for base in [draw.getrandbits(64) for _ in range(4)]:
        for _ in range(200):
            for _ in range(draw.randint(0, 8)):
                base ^= 1 << draw.randrange(64) if draw.random() < 0.6 else 0
            prints.add(base)
    signed = [simhash._signed(p) for p in prints]
    nodes = spark.createDataFrame([(p, p) for p in signed], "node bigint, fingerprint bigint")
    found = {r.node: r.component for r in components(simhash.links(nodes, 3, bucket)).collect()}
    expected = groups_of(dict(zip(signed, prints)), 3)
    assert {p: found.get(p, p) for p in signed} == expected


def test_masks_cover_every_small_difference():
    masks = simhash.covering_masks(list(range(64)), 3)
    assert len(masks) == 15
    draw = random.Random(0)
    for _ in range(5000):
        bits = sum(1 << b for b in draw.sample(range(64), 3))
        assert any(not m & bits for m in masks)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 300)] + [(5, 5)]
    links = spark.createDataFrame(chain + star, "a bigint, b bigint")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 300)}}
    assert components(links.where("false")).collect() == []


def test_sketches(spark, sf_dir, docs):
    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    def likeness(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    rows, seen = by_id(spark, sf_dir, "op5_sketches"), {}
    for i, (doc_id, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        tail = len(text) // 4
        edited = text[: len(text) - tail] + after[:tail]
        row = rows[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(text, row.fingerprint) == row.fingerprint
        assert abs(row.near_edited - likeness(shingles(text), shingles(edited))) < 0.2
        assert abs(row.near_next - likeness(shingles(text), shingles(after))) < 0.2


def test_sketches_merge_and_estimate(spark):
    words = [f"w{i}" for i in range(3000)]
    rows = [(1, " ".join(words)), (1, " ".join(words[2000:] + words[:900])), (2, " ".join(words[:1500]))]
    found = sketches.sketches(spark.createDataFrame(rows, "doc_id bigint, text string"), k=512)
    one = sketches.combined(found, ["doc_id"], 512).where("doc_id = 1").first()["sketch"]
    parts = sorted({h for r in found.where("doc_id = 1").collect() for h in r["sketch"]})
    assert one == parts[:512]
    a = found.where("doc_id = 2").selectExpr("sketch as a")
    b = found.where("doc_id = 1").orderBy("sketch").limit(1).selectExpr("sketch as b")
    row = a.crossJoin(b).select(
        sketches.distinct_shingles("a", 512).alias("n"), sketches.containment("a", "b", 512).alias("c")
    ).first()
    assert abs(row.n / 1496 - 1) < 0.2 and 0 <= row.c <= 1


def test_licenses(spark, sf_dir, docs):
    rows = by_id(spark, sf_dir, "op6_licenses")
    phrases = {label: own[0].split() for label, own in licenses.NAMES.items()}
    for doc_id, text in docs:
        words = re.findall(WORD_PATTERN, lowered(text))
        places = [
            (i, label)
            for label, phrase in phrases.items()
            for i in range(len(words))
            if words[i : i + len(phrase)] == phrase
        ]
        row = rows[doc_id]
        labels = ",".join(sorted({label for _, label in places}))
        ends = (min(places)[0], max(places)[0]) if places else (None, None)
        assert (row.n_words, row.n_base, row.base_labels) == (len(words), len(places), labels)
        assert (row.first_word, row.last_word) == ends
        assert set(filter(None, labels.split(","))) <= set(row.labels.split(","))


def test_license_texts_with_edits(spark):
    text = " ".join(licenses.TEXTS["mit"][0].split())
    edited = text.replace("free of charge", "at no cost or charge").replace("merge,", "")
    rows = [(1, "intro words " + text + " more"), (2, edited), (3, text[:150]), (4, "MIT\nLicense, mit LICENSE")]
    found = {r.doc_id: r for r in licenses.summary(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert (found[1].labels, found[1].score, found[1].n_base) == ("mit", 1.0, 0)
    assert found[2].labels == "mit" and 0.6 <= found[2].score < 1
    assert found[3].labels == "" and found[3].score == 0
    assert (found[4].n_base, found[4].first_word, found[4].last_word) == (2, 0, 2)


def summaries(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in licenses.summary(frame).collect()}
    return [found[i] for i in range(len(texts))]


def test_repeated_passages_are_no_license(spark):
    """One passage of a license, however often, covers its words once."""
    texts = []
    for label in ("isc", "bsd", "mit"):
        words = licenses.TEXTS[label][0].split()
        for first, length in ((0, 10), (5, 8), (12, 10)):
            for times in (2, 3, 9):
                for between in ("", " and then some other words", " x" * 15):
                    texts.append((" ".join(words[first : first + length]) + between + " ") * times)
    assert {(r.labels, r.score) for r in summaries(spark, texts)} == {("", 0.0)}


@pytest.mark.parametrize("label", ["mit", "bsd", "apache", "gpl"])
def test_inserted_words_keep_the_license(spark, label):
    words = licenses.TEXTS[label][0].split()
    cuts = [len(words) // 2, len(words) // 3]
    texts = [
        " ".join([*words[:cut], *[f"holder{i}" for i in range(n)], *words[cut:]])
        for cut in cuts for n in (1, 12, 13, 20, 40)
    ] + [" ".join([*words[:cut], *words[cut + 5 :]]) for cut in cuts]
    for row in summaries(spark, texts):
        assert row.labels == label and 0.75 < row.score <= 1
    apart = " ".join([*words[: cuts[0]], *["word"] * 60, *words[cuts[0] :]])
    if label in ("mit", "bsd"):  # the others hold a name, which stands by itself
        assert summaries(spark, [apart])[0].labels == ""
    assert summaries(spark, [" ".join(words)])[0].score == 1.0


def brute_license_score(text):
    """The best chain of a template's k-grams, by the rules, one pair of words at a time."""
    words, best, labels = re.findall(WORD_PATTERN, lowered(text)), 0.0, set()
    for label, own in licenses.TEXTS.items():
        for template in own:
            t = re.findall(WORD_PATTERN, lowered(template))
            votes = {}
            for p in range(len(words) - licenses.GRAM + 1):
                for q in range(len(t) - licenses.GRAM + 1):
                    if words[p : p + licenses.GRAM] == t[q : q + licenses.GRAM]:
                        votes.setdefault(p - q, set()).update(range(q, q + licenses.GRAM))
            rows = sorted((min(c) + d, -(max(c) + d + 1), d, c) for d, c in votes.items())
            kept, around = [], None
            for start, end, d, c in rows:
                at = {x + d for x in c}
                if around is None or -end > around[0] or at - around[1]:
                    kept.append((start, -end, d, c))
                if around is None or -end > around[0]:
                    around = (-end, at)
            span, spans = None, []
            for start, end, d, c in kept:
                if (
                    span is None or abs(d - span["d"]) > licenses.GAP or min(c) <= span["first"]
                    or start > span["end"] + licenses.GAP
                ):
                    span = {"words": set(), "end": end}
                    spans.append(span)
                span.update(d=d, first=min(c), end=max(span["end"], end))
                span["words"] |= c
            for span in spans:
                cover = len(span["words"]) / len(t)
                if cover >= licenses.LEAST_COVER:
                    labels.add(label)
                    best = max(best, cover)
    return labels, best


def test_license_labels_and_scores(spark):
    """Random cuts, copies and insertions of licenses against a slow scan."""
    draw, texts = random.Random(8), []
    pool = [t.split() for own in licenses.TEXTS.values() for t in own]
    for _ in range(60):
        words = []
        for _ in range(draw.randint(1, 3)):
            part = list(draw.choice(pool))
            for _ in range(draw.randint(0, 3)):
                at = draw.randrange(len(part))
                part[at : at + draw.randint(0, 6)] = ["other"] * draw.randint(0, 45)
            words += ["between"] * draw.randint(0, 60) + part
        texts.append(" ".join(words))
    for text, row in zip(texts, summaries(spark, texts)):
        labels, best = brute_license_score(text)
        named = set(filter(None, row.base_labels.split(",")))
        assert set(filter(None, row.labels.split(","))) == labels | named
        assert row.score == pytest.approx(1.0 if named else best)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left = [i]
        for j, y in enumerate(b, 1):
            left.append(min(row[j] + 1, left[-1] + 1, row[j - 1] + (x != y)))
        row = left
    return row[-1]


def misspelled(draw, words, n, letters="abcdiostué"):
    forms = []
    for _ in range(n):
        form = list(draw.choice(words))
        for _ in range(draw.randint(0, 3)):
            i = draw.randrange(len(form) + 1)
            form[i : i + draw.randint(0, 1)] = draw.choice(["", *letters])
        forms.append("".join(form) or "x")
    return forms


def check_codes(automaton, words, stem, forms):
    for form, code in zip(forms, automaton.codes(forms)):
        near = [
            (distance(form, w), w) for w in words if abs(len(w) - len(form)) <= 2
            if distance(form, w) <= toxicity.edits_allowed(w)
        ]
        kind, term, edits = automaton.hits[code]
        if form.startswith(stem) and form not in words:
            assert (kind, term) == ("stem", stem)
        else:
            assert ((edits, term) if code else None) == min(near, default=None)


def test_automaton_against_edit_distances():
    words = "idiot worthless scum moron clown pathetic loser trash disgusting stupid".split()
    automaton = toxicity.Automaton(toxicity.Lexicon(words, ["veju"], {}))
    forms = ["vejuté", "vej", "the", *misspelled(random.Random(0), words, 3000)]
    check_codes(automaton, words, "veju", forms)


@pytest.mark.parametrize("most", [100, 10**6])
def test_every_term_of_a_large_lexicon_may_be_misspelled(monkeypatch, most):
    """500 terms, with a table that is forgotten between batches and with one that is kept."""
    monkeypatch.setattr(toxicity, "MOST_STATES", most)
    draw = random.Random(1)
    words = sorted({"".join(draw.choices("abcdefgh", k=draw.randint(4, 12))) for _ in range(500)})
    draw.shuffle(words)
    automaton = toxicity.Automaton(toxicity.Lexicon(words, ["zzz"], {}))
    forms = [*misspelled(draw, words, 900, "abcdefghi"), *words]
    for a in range(0, len(forms), 200):
        check_codes(automaton, words, "zzz", forms[a : a + 200])
    for word in words:  # the last ones too
        if len(word) >= toxicity.ONE_EDIT:
            assert automaton.codes([word[:2] + "q" + word[2:]])[0] > 0


def test_html(spark, sf_dir):
    from html import unescape

    rows = by_id(spark, sf_dir, "op9_html_blocks", "page_id")
    for page in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", page.html, re.S)[1].replace("<br>", " ")
        blocks = [
            " ".join(unescape(re.sub(r"<[^>]*>", "", b)).split())
            for b in re.split(r"</?(?:p|h1)>", article)
        ]
        text = "\n".join(b for b in blocks if b)
        assert (rows[page.page_id].text, rows[page.page_id].n_chars) == (text, len(text))


def test_html_without_an_article():
    page = """<html><head><title>T</title></head><body><header><h1>Site</h1></header>
    <div class="cookie-notice">We use cookies</div><div id="menu"><a href=x>a</a></div>
    <div class="post"><h2>Title &amp; more</h2><p>First paragraph with<br>break &nbsp; and
    <a href="y">link</a> text.<p>Second one.</p><ul><li>item one<li>item two</ul>
    <div class=share><a>tw</a></div><p class="ad">Buy now<p>Third paragraph to read.</p>
    <form><input name=q><label>Search</label></form></div>
    <section id="comments"><p>A reader writes here.</p></section><aside>Side</aside>
    <footer>(c)</footer><script>var a="<p>no</p>"</script></body></html>"""
    assert html_blocks.main_text(page) == (
        "Title & more\nFirst paragraph with break and link text.\nSecond one.\nitem one\nitem two\n"
        "Third paragraph to read."
    )


PROSE = "A sentence of the article with enough words in it. " * 3


@pytest.mark.parametrize(
    "page, text",
    [
        # parts of the article that only look like something else
        ("<article><p>{p}<section id='legal'><p>Law {p}</section></article>", "{p}\nLaw {p}"),
        ("<article><p>{p}</p><h2 id='related-work'>Related</h2><p>{p}</article>", "{p}\nRelated\n{p}"),
        ("<article><p>{p}<p>{p}<p><a href=x>The source</a></article>", "{p}\n{p}\nThe source"),
        ("<article><p>{p}<aside>Aside <p>a</article><p>After", "{p}"),
        ("<div><aside>Aside</div><div><p>{p}<p>{p}</div>", "{p}\n{p}"),
        ("<div class='content with-sidebar'><p>{p}<p>{p}</div>", "{p}\n{p}"),
        ("<div class='post no-sidebar'><p>{p}</div><div class=sidebar>x</div>", "{p}"),
        ("<div class='comments-off post'><p>{p}</div>", "{p}"),
        # articles that are not the text
        ("<article>Teaser one</article><div><p>{p}<p>{p}<p>{p}</div><article>Teaser two</article>",
         "{p}\n{p}\n{p}"),
        ("<div><p>{p}<p>{p}</div><article class='comment-body'><p>{p}</article>", "{p}\n{p}"),
        ("<main><h1>Title</h1><p>{p}</p><article class=comment>Reader {p}</article></main>", "Title\n{p}"),
        ("<main><h1>Title</h1><article><p>{p}</article><article>Teaser</article></main>", "Title\n{p}"),
        # no marks: links between two parts
        ("<p>{p}<p>{p}<ul><li><a>a</a><li><a>b</a><li><a>c</a><li><a>d</a></ul><p>{p}<p>{p}",
         "{p}\n{p}\na\nb\nc\nd\n{p}\n{p}"),
        ("<article><p>Hi.</article>", "Hi."),
        ("<nav>x</nav>", ""),
        ("a < b and <p>c > d", "a < b and\nc > d"),
    ],
)
def test_html_cases(page, text):
    assert html_blocks.main_text(page.format(p=PROSE.strip())) == text.format(p=PROSE.strip())


def test_windows_choose_among_articles():
    """Of two articles the one with more text counts; a surge outside may outweigh both."""
    short, long = "<article><p>Short one.</article>", f"<article><p>{PROSE}</article>"
    assert html_blocks.main_text(short + long) == PROSE.strip()
    outside = f"<div><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div>"
    assert html_blocks.main_text(long + outside).count("\n") == 3
    assert html_blocks.regions([0, 0, 0, 50, 60, 0, 0, 0, 0, 5, 0, 0, 0]) == [(1, 5)]


@pytest.mark.parametrize(
    "page",
    ["<aside>a<article>b" * 50_000, "<a 'b " * 150_000, "<a b='c" * 150_000 + ">", "</div>" * 170_000,
     "<div>" * 100_000 + "</p></x>" * 60_000, "<p>a</div>" * 100_000, "<a " * 300_000 + ">", "<!-- " * 200_000,
     "<div class=ad>" * 70_000 + "x", "< " * 500_000, "<a b=\"c\" " * 100_000],
)
def test_long_pages_take_linear_time(page):
    start = time.process_time()
    html_blocks.main_text(page)
    assert time.process_time() - start < 5  # a second alone; quadratic time takes minutes
