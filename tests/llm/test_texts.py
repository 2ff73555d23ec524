from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece

from pathquality.llm import fst, html, licenses, lines, toxicity
from pathquality.llm.queries import PIECES

SCHEMA = "doc_id long, text string"


# SentencePiece ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    return fst.load(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_encodes_as_the_public_library_does(pieces):
    model, other = pieces
    rng, encoder = random.Random(3), fst.Encoder(model)
    parts = [" ", "  ", "\n", "\t", "a", "b", "the", "ing", "é", "漢", "🙂", "ß", "0", "...", "aaaa", "\x00",
             "<s>", "<0x41>", "'s", "def ", "==", "  return", "Hello", "▁"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        ids = encoder.encode(text)
        assert ids == other.encode(text)
        assert model.decode(ids) == other.decode(ids)
        assert "▁" in text or model.decode(ids) == text
    long = "".join(rng.choice("abcdefg") for _ in range(3000))
    assert encoder.encode(long) == other.encode(long)


def test_unigram_takes_the_lightest_path():
    names = ["<unk>", "a", "b", "ab", "ba", "aba", "▁"]
    weights = [0.0, -2.0, -2.5, -3.0, -2.2, -5.5, -1.0]
    model = fst.Model(names, weights, [2] + [1] * 6, False, False, True, False, 0)
    model.lexicon, model.longest = {p: i for i, p in enumerate(names) if i}, 3

    def best(text):
        if not text:
            return 0.0, []
        return min(((-weights[i] + best(text[len(p):])[0], [i, *best(text[len(p):])[1]])
                    for p, i in model.lexicon.items() if text.startswith(p)), default=(1e9, []))

    for text in ("a", "ab", "abab", "baab", "abababba"):
        assert fst.Encoder(model).encode(text) == best("▁" + text)[1]


def test_round_trip_in_spark(spark, pieces):
    rows = [(1, "Two  spaces\n\ttabs é漢🙂"), (2, None), (3, ""), (3, ""), (None, " lead"), (5, "x" * 5000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", ids int")
    encoded = fst.encode(docs, pieces[0])
    got = {(r.doc_id, r.n_tokens, r.round_trip) for r in encoded.collect()}
    assert all(r[2] for r in got) and (2, 0, True) in got and (3, 0, True) in got
    back = sorted((r.doc_id or 0, r.text) for r in fst.decode(encoded, pieces[0]).collect())
    assert back == sorted((d or 0, t or "") for d, t in rows)
    assert fst.encode(docs.limit(0), pieces[0]).count() == 0


# Pages ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def field():
    return html.default_field()


def test_held_out_pages(field):
    rng = random.Random(99)
    pages = [html.labelled_page(rng) for _ in range(200)]
    same = [x == y for page, label in pages for x, y in zip(field.decode(page), label, strict=True)]
    assert np.mean(same) > 0.99


@pytest.mark.parametrize(("page", "text"), [
    ('<body class="with-sidebar"><header><h1>Site</h1><nav><a href="/">Home</a></nav></header><main><h1>Title '
     "&amp; more</h1><p>First para with <a href=x>link</a> inside it.</p><div class='ad-slot'>Buy now!</div>"
     "<p>Second&nbsp;para &lt;b&gt; &#233;.</p><aside>Side note</aside><section class=comments><h3>Comments</h3>"
     "<p>Great article, I really liked it.</p></section></main><form>Sign up <input></form><footer>F</footer>",
     "Title & more\nFirst para with link inside it.\nSecond para <b> é."),
    ("<article><h1>T</h1><p>p1<p>p2<div class=related><a href=1>r1</a> <a href=2>r2</a></div><p>p3 <script>"
     'if (a<b) x("</p>")</script>after</article><div class="comments"><p>Nice text here</div>', "T\np1\np2\np3 after"),
    ("<p>Only paragraph here, no container.</p><p>And another one.</p>",
     "Only paragraph here, no container.\nAnd another one."),
    ("<article><p><b>one\n two<br><p>Is.</p></article><footer>&copy; x", "one two\nIs."),
    ("<article><p>one <svg class=i /> two</p><p>Three <math/> is.</p></article>", "one two\nThree is."),
    ("<article><p>one <SVG a='/>'><svg><g/><svg/></svg><title>x</title></Svg> two</p><p>Is.</p></article>",
     "one two\nIs."),
    ("<article><p>one <svg/> two <svg><!-- </svg> --><path d='1'/></svg> three.</p></article>", "one two three."),
    ("", ""), ("   ", ""), (None, ""), ("<script>x</script><style>y</style>", ""),
    ("<article><p>One is here.</p><div class=ad data-u=http://x/>Buy it now.</div><p>Two is too.</p></article>",
     "One is here.\nTwo is too."),
])
def test_main_text(field, page, text):
    assert html.main_text(page, field) == text


ARTICLE = "<h1>Title</h1><p>The first paragraph has some words.</p><p>And so has the second one.</p>"


@pytest.mark.parametrize("wrap", [
    '<article class="commentary">{}</article>', '<article class="inside-story">{}</article>',
    '<article class="post-side">{}</article>', '<div class="considerations content">{}</div>',
    '<article class="research">{}</article>', '<article class="platform">{}</article>',
    '<div id="information"><article>{}</article></div>', '<div class="content legal-analysis">{}</div>',
    '<div class="page-with-sidebar"><article>{}</article></div>', '<div class="layout no-sidebar"><main>{}</main></div>',
    '<form id="aspnetForm"><article>{}</article></form>', '<form><div class="hasSidebar"><main>{}</main></div></form>',
])
def test_names_that_only_look_like_notices(field, wrap):
    page = '<nav><a href="/">Home</a></nav>' + wrap.format(ARTICLE) + "<footer>&copy; x</footer>"
    assert html.main_text(page, field) == "Title\nThe first paragraph has some words.\nAnd so has the second one."


@pytest.mark.parametrize("piece", ["<a ", '<a "', "<!", "<a '<b", "</script ", "<svg ", "<"])
def test_long_broken_markup_is_read_in_linear_time(piece):
    import time

    start = time.perf_counter()
    for page in (piece * 200_000, "<script>" + piece * 200_000, "<p>x</p>" + piece * 200_001 + ">"):
        html.blocks(page)
    assert time.perf_counter() - start < 20


def test_viterbi_is_the_best_of_all_labellings(field):
    from itertools import product

    page = html.labelled_page(random.Random(4))[0][:8]
    emit = field.emissions(page)

    def weight(labels):
        return field.start[labels[0]] + sum(emit[i, s] for i, s in enumerate(labels)) + sum(
            field.steps[a, b] for a, b in zip(labels, labels[1:], strict=False))

    best = max(product((0, 1), repeat=len(page)), key=weight)
    assert field.decode(page) == [bool(s) for s in best]


def test_pages_in_spark(spark, field):
    rows = [(1, "u", "<article><p>a</p></article>", "x"), (2, None, None, "x"), (2, None, None, "x"),
            (None, "v", "<p>" + "long text " * 50_000, "x")]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), field)
    assert sorted((r.page_id or 0, r.n_chars) for r in got.collect()) == [(0, 499_999), (1, 1), (2, 0), (2, 0)]
    assert html.extract(got.select("page_id", "url", got.text.alias("html")).limit(0), field).count() == 0


# Toxicity ---------------------------------------------------------------------------------


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(5)
    y = rng.random(20_000) < 0.2
    votes = np.zeros(len(y), dtype=int)
    for j, (hit, false) in enumerate([(0.9, 0.02), (0.7, 0.05), (0.8, 0.1)]):
        votes |= (rng.random(len(y)) < np.where(y, hit, false)).astype(int) << j
    votes |= (votes & 1) << 3  # a copy of the first
    label = np.where(rng.random(len(y)) < 0.1, y.astype(int), -1)
    model = toxicity.fit_label_model(votes, label, np.ones(len(y)), 0.2)
    assert model.accuracy[:3] == pytest.approx([0.964, 0.9, 0.88], abs=0.03)
    assert model.correlation[0, 3] > 0.9 > model.correlation[0, 1]
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("bcdfgl") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    rows, marks = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.choice([5, 60, 400]))]
        toxic = i % 5 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["zorgish", "zorgun", "vexkel", "idiot"])
        rows.append((i, " ".join(text)))
        if i % 2 == 0:
            marks.append((i, 1, int(toxic)))
    rows += [(2000, None), (2001, ""), (None, "zorgish idiot"), (0, rows[0][1])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", score string")
    labels = spark.createDataFrame(marks + [(4, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i in range(900):
        assert by_id[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert by_id[i].predicted == int(i % 5 == 0)
    assert by_id[2000].score == by_id[2001].score < 0.5 and by_id[None].predicted == 1
    left = toxicity.without_toxic(docs, labels).collect()
    assert len(left) == sum(not r.predicted for r in got)


def test_held_out_labels_are_not_learned_from(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} thing{i % 2}") for i in range(120)], SCHEMA)
    labels = [(i, 1, i % 2) for i in range(120)]
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    scores = [sorted((r.doc_id, r.score) for r in toxicity.toxicity(
        docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect())
        for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in toxicity.toxicity(docs, none).collect()] == [0, 0]
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


# Licenses ---------------------------------------------------------------------------------


def base_places(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    places, names = [], set()
    for name, phrase in licenses.BASE.items():
        want = phrase.encode().split()
        found = [i for i in range(len(words)) if words[i:i + len(want)] == want]
        places += found
        names |= {name} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(names))


def test_license_scan(spark):
    rng = random.Random(8)
    mit = licenses.TEMPLATES["mit-text"]
    broken = re.sub("free of charge, ", "without any fee ", mit)
    rows = [(0, None), (1, ""), (2, "MIT License"), (3, "mit-license MIT  license, mit license"), (4, "emit license"),
            (5, "intro " + mit + " tail"), (6, broken), (7, mit[:200]), (7, mit[:200]),
            (None, "Apache License"), (8, "the GNU General Public License" * 3), (9, "é mit LICENSÉ"),
            (10, "This work is licensed under the GNU General Public License, version 3.")]
    rows += [(20 + i, " ".join(rng.choice(["mit", "license", "apache", "general", "public", "x"])
                               for _ in range(rng.randrange(60)))) for i in range(40)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], SCHEMA + ", labels string").repartition(4)
    got = licenses.scan(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text = dict(rows)[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_places(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    by_id = {r.doc_id: r for r in got}
    assert by_id[5].labels == "mit-text" and by_id[5].score == 1
    assert by_id[5].found[0][:2] == (1, len(licenses.split(mit.encode())))
    assert by_id[6].labels == "mit-text" and 0.8 <= by_id[6].score < 1
    assert by_id[7].labels == "" and by_id[10].labels == "gpl,gpl-3.0"
    assert licenses.scan(docs.limit(0)).count() == 0


# Lines ------------------------------------------------------------------------------------


def test_longest_run_against_brute_force():
    from itertools import combinations

    rng = random.Random(9)
    for _ in range(60):
        places = rng.sample(range(30), rng.randrange(9))
        run = lines.longest_run(places)
        assert [places[i] for i in run] == sorted(places[i] for i in run)
        assert len(run) == max((n for n in range(len(places) + 1) for c in combinations(places, n)
                                if list(c) == sorted(c)), default=0)


def test_line_dedup(spark):
    a = [f"line {i} of the first text" for i in range(6)]
    rows = [
        (1, "\n".join(a)), (5, "\n".join(["new words are here", *a[2:5], "", "more words", a[0]])),
        (7, "\n".join(a)), (3, "slogan of us\nown text three"), (4, "own text four\nslogan of us"), (8, None),
        (9, ""), (None, "\n".join(a)), (10, "ok\nno"), (11, "ok\nmore"), (7, "\n".join(a)),
    ]
    rows += [(100 + i, f"unique number {i}\nvery frequent line") for i in range(30)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", n_lines int").repartition(4)
    got = lines.line_dedup(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].n_removed == 0 and by_id[None].n_removed == 0 and by_id[8].text is None
    assert by_id[5].text == "new words are here\n\nmore words\n" + a[0]  # out of order: not aligned
    assert by_id[7].text == "" and by_id[7].n_removed == 6
    assert by_id[4].n_removed == 0 and by_id[11].text == "ok\nmore"  # a slogan is no passage
    assert all(by_id[100 + i].n_removed == 0 for i in range(30))
    assert lines.line_dedup(docs.limit(0)).count() == 0


def test_copies_holding_lines_of_other_documents_end_empty(spark):
    block = [f"text {i} of the copied document here" for i in range(3)]
    whole = "\n".join(["ok", block[0], "our slogan", block[1], "ok", block[2], "again a refrain"])
    rows = [(i, f"own words of {i} stand here\nour slogan\nown end of {i}") for i in range(25)]
    rows += [(i, f"own words of {i} stand here\nagain a refrain\nok\nown end of {i}") for i in range(25, 50)]
    rows += [(60, whole), (61, whole), (62, whole.replace(block[2], "a line of its own"))]
    by_id = {r.doc_id: r for r in lines.line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(by_id[i].n_removed == 0 for i in (*range(50), 60))
    assert by_id[61].text == ""
    assert by_id[62].text == "a line of its own"


def test_short_texts_go_however_many_copies_there_are(spark):
    passage = [f"part {i} of a passage of many" for i in range(4)]
    rows = [(i, f"{passage[i]}\nalone {i}") for i in range(4)]
    rows += [(10 + i, f"number {i}\n" + "\n".join(passage) + f"\nend {i}") for i in range(40)]
    rows += [(100 + i, "short text\ncopied often") for i in range(40)]
    rows += [(200 + i, "ok") for i in range(40)]
    by_id = {r.doc_id: r for r in lines.line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert by_id[10].n_removed == by_id[100].n_removed == by_id[200].n_removed == 0
    assert all(by_id[11 + i].text == f"number {i + 1}\nend {i + 1}" for i in range(39))
    assert all(by_id[101 + i].text == "" and by_id[201 + i].text == "" for i in range(39))


def plain_line_dedup(rows, rare, common):
    """Texts whose lines stand in one order everywhere and never twice: all common lines align."""
    docs = {d: t.split("\n") for d, t in sorted(rows)}
    count = lambda ls: sum(len(x.split()) for x in ls)

    def holds(e, run):
        return any(docs[e][i:i + len(run)] == run for i in range(len(docs[e])))

    def first(d, run, whole=False):
        return min((e for e in docs if e < d and (docs[e] == run if whole else holds(e, run))), default=None)

    out = {}
    for d, own in docs.items():
        wanted, weight = set(), {}
        for i, line in enumerate(own):
            e = first(d, [line])
            if e is not None:
                weight[e] = weight.get(e, 0) + count([line])
                if count([line]) >= common or sum(holds(x, [line]) for x in docs) <= rare:
                    wanted.add(e)
            stop = next((j for j in range(i + 1, len(own) + 1) if count(own[i:j]) >= common), None)
            if stop is not None:
                wanted.add(first(d, own[i:stop]))
        if count(own) < common:
            wanted.add(first(d, own, whole=True))
        if weight:
            wanted.add(min(weight, key=lambda e: (-weight[e], e)))
        gone = set()
        for e in wanted - {None}:
            blocks, before = [], None
            for i, line in enumerate(own):
                if line in docs[e]:
                    j = docs[e].index(line)
                    if before != (i - 1, j - 1):
                        blocks.append([])
                    blocks[-1].append(line)
                    before = i, j
            most = sum(map(count, blocks)) >= 0.8 * count(own)
            if blocks and (most or max(map(count, blocks)) >= common):
                gone |= {x for b in blocks if most or count(b) >= 3 for x in b}
        out[d] = "\n".join(x for x in own if x not in gone)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_against_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(f"w{i}" for _ in range(rng.choice((1, 2, 3, 5, 8, 12)))) for i in range(40)]
    rows = []
    for d in range(60):
        chosen = rng.sample(range(40), rng.randrange(1, 9)) + list(range(start := rng.randrange(36), start + rng.randrange(5)))
        rows.append((d, "\n".join(pool[i] for i in sorted(set(chosen)))))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for per_block in (1000, 2):
        gone = lines.overlaps(docs, rare=6, per_block=per_block).collect()
        left = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in dict((r.doc_id, r.gone) for r in gone).get(d, ()))
                for d, t in rows}
        assert left == plain_line_dedup(rows, 6, lines.COMMON)
    assert {r.doc_id: r.text for r in lines.line_dedup(docs, rare=6).collect()} == left
    assert sum(r.n_removed for r in lines.line_dedup(docs, rare=6).collect()) > 20


def test_blocks_go_alike_however_many_documents_have_them(spark):
    for n in (20, 21, 60):
        rows = [(i, f"own {i}\neight words that stand in all of them\nmore words for a passage\nend {i}") for i in range(n)]
        rows += [(100 + i, f"alone {i}\njust five words of it\nlast {i}") for i in range(n)]
        got = {r.doc_id: r.n_removed for r in lines.line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert got == {0: 0, **{i: 2 for i in range(1, n)}, **{100 + i: 0 for i in range(n)}}


def test_a_long_document_of_many_partners(spark):
    n = 6000
    line = "concat('line ', id, ' of ten words which one other document has too')"
    owners = spark.range(n).selectExpr("id as doc_id", f"concat('own ', id, '\\n', {line}) as text")
    long = spark.range(n).selectExpr(f"array_join(transform(sort_array(collect_list(id)), id -> {line}), '\n') as text")
    docs = owners.unionByName(long.selectExpr("1000000L as doc_id", "text"))
    sent = lines.line_dedup(docs).filter("n_removed > 0").collect()
    assert [(r.doc_id, r.n_removed, r.text) for r in sent] == [(1000000, n, "")]


def test_line_dedup_and_clashing_columns(spark):
    names = ("gone", "__d", "__row_key", "row_key", "later", "rest", "a.b", "c0")
    text = "a passage of more than ten words that two documents have here"
    docs = spark.createDataFrame([(i, text, *[f"{n}{i}" for n in names]) for i in (1, 2)], ["doc_id", "text", *names])
    got = sorted(map(tuple, lines.line_dedup(docs).collect()))
    assert lines.line_dedup(docs).columns == [*docs.columns, "n_lines", "n_removed"]
    assert got == [(1, text, *[f"{n}1" for n in names], 1, 0), (2, "", *[f"{n}2" for n in names], 1, 1)]
