import html
import random
import re

from samples import frame, odd, words

from tidemark.llm import queries
from tidemark.llm.html_text import extract_text, main_text
from tidemark.llm.license_texts import APACHE_HEADER, BSD_DISCLAIMER, BSD_TERMS, KNOWN, MIT, PUBLISHED, SPELLINGS
from tidemark.llm.licenses import COPYRIGHT_LINE, PARAGRAPH_END, RANKED, SENTENCE_END, find_licenses
from tidemark.llm.substring_dedup import chunk_rows, drop_repeats, repeated_spans

ROOT = "/root/testdata/sf0.01"
LONG = "This sentence is long enough that it counts as a part of the article, and it goes on for a while."


def test_pages_agree_with_a_plain_reading_of_their_article(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{ROOT}/pages.parquet").collect()}
    got = queries.QUERIES["op10_html_text"](spark, ROOT).collect()
    assert len(got) == len(pages)
    for r in got:
        inside = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)\b[^>]*>", inside)]
        assert r.text == "\n".join(p for p in parts if p)
        assert r.n_chars == len(r.text)


def test_what_surrounds_an_article_is_left_out():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style></head><body class="has-sidebar">
      <header><h1>Site</h1></header><nav><ul><li><a href=a>Home</a></ul></nav><div id="cookie-notice">We use cookies. {LONG}</div>
      <div class="wrap"><div class="content"><h2>Title</h2><div><p>{LONG} A &amp; B&nbsp;&#67;<!-- no --></p><p>Short.</p></div>
      <div><p>{LONG}<script>var x = "<p>";</script></p><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></div></div>
      <div class="sidebar widget"><p>{LONG}</p></div></div><div class="ad">Buy</div><form><p>{LONG}</p></form>
      <section id="comments"><p>{LONG} says a reader. {LONG}</p></section><footer>&copy; 2020</footer></body></html>"""
    assert main_text(page) == f"Title\n{LONG} A & B C\nShort.\n{LONG}\none\ntwo\nx\ny"


def test_article_and_main_win_and_their_own_headers_stay():
    page = f"<body><div class=teaser><p>{LONG * 9}</p></div><main><article><header><h1>Head</h1></header><p>{LONG * 12}<p>Tiny.</article></main>"
    assert main_text(page) == f"Head\n{LONG * 12}\nTiny."


def test_all_of_an_article_is_kept():
    links = "".join(f"<li><a href=r{k}>Reference number {k}</a></li>" for k in range(6))
    page = f"""<body><header><h1>Site</h1></header><main><h1>Both</h1><article><p>{LONG * 3}</p><div class="share-price"><p>Up 3.</p></div>
      <section id="related-work"><p>Others.</p></section><div class="search-results"><p>Found 7.</p></div><ol class="references">{links}</ol>
      <div class="related-posts"><p>More to read</p></div><div class="share-buttons"><p>Share it</p></div>
      <article class="comment"><p>{LONG} A reader.</p></article></article>
      <article><p>{LONG} Second.</p></article><article class="related"><p>{LONG}</p></article>
      <section class="comments"><p>{LONG}</p></section></main><div class="cookie-law-info"><p>{LONG}</p></div></body>"""
    references = "\n".join(f"Reference number {k}" for k in range(6))
    assert main_text(page) == f"Both\n{(LONG * 3)}\nUp 3.\nOthers.\nFound 7.\n{references}\n{LONG} Second."


def test_names_outside_an_article():
    page = f"""<body><div class="site-nav"><p>{LONG}</p></div><div class="wrap"><div class="post-content"><p>{LONG * 2}</p><div class="share-price"><p>{LONG}</p></div></div></div>
      <div class="ad-300x250"><p>{LONG}</p></div><ul><li><a href=a>One</a><li><a href=b>Two</a><li><a href=c>Three</a></ul></body>"""
    assert main_text(page) == f"{LONG * 2}\n{LONG}"


def test_pages_with_clashing_columns(spark):
    table = spark.createDataFrame([(1, "u", "<p>x</p>", 5, "y", "z")], "page_id long, url string, html string, n_chars long, c0 string, `a.b` string")
    assert [tuple(r) for r in extract_text(table).collect()] == [(1, "u", "x", 1)]


def test_odd_pages(spark):
    pages = [
        (1, None, None), (2, "u", ""), (3, "u", "plain text"), (4, "u", "<p>cut off <b>here &am"), (5, "u", "<<<>>><p>a<b"),
        (5, "u", "<<<>>><p>a<b"), (None, "u", "<body><nav>only menu</nav></body>"), (7, "u", "<div>" * 3000 + "deep" + "</div>" * 10),
        (8, "u", "<p>" + "word " * 200_000), (9, "u", '<a href="unclosed>text</a><p>more'),
    ]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in extract_text(table).collect()), key=lambda r: r[:2])
    text = {i: t for i, t, _ in got}
    assert len(got) == len(pages) and all(n == len(t) for _, t, n in got)
    assert (text[0], text[1], text[2], text[3], text[4], text[7]) == ("", "", "", "plain text", "cut off here &am", "deep")
    assert text[8] == " ".join(["word"] * 200_000)
    assert extract_text(table.limit(0)).count() == 0


def test_licences_by_whole_text_paragraph_line_and_sentence(spark):
    british = MIT.replace("sublicense", "sub-licence").replace("copyright holders", "copyright owners")
    docs = [
        (1, "Copyright (c) 2020 Some One\n\n" + MIT), (2, f"Intro.\nReleased under the MIT License!\n{LONG}"), (3, british.upper()),
        (4, f"{LONG}\n\n{APACHE_HEADER}\n\n{LONG}".replace("\n", " ")), (5, "# BSD\n" + BSD_TERMS + BSD_DISCLAIMER),
        (6, BSD_TERMS + BSD_DISCLAIMER), (7, "One. Licensed under CC BY-NC 4.0. Two."), (8, MIT + " And more."), *[(100 + k, t) for k, (_, t) in enumerate(odd())],
        (None, "All rights reserved."), (None, "All rights reserved."),
    ]
    got = {(r.doc_id, r.license, r.scope) for r in find_licenses(frame(spark, docs)).collect()}
    assert got == {
        (1, "MIT", "document"), (2, "MIT", "line"), (3, "MIT", "document"), (6, "BSD-2-Clause", "document"), (7, "CC-BY-NC-4.0", "sentence"),
        (None, "all-rights-reserved", "document"),
    }
    same = {tuple(r) for r in find_licenses(frame(spark, docs), broadcast_texts=0).collect()}
    assert same == got
    assert find_licenses(frame(spark, [])).count() == 0
    none = spark.createDataFrame([("x", None), (None, "")], "license string, text string")
    assert find_licenses(frame(spark, docs), none).count() == 0


def plain_licenses(text, known):
    """Scope by licence, each passage brought into canonical form by itself."""

    def canonical(t):
        t = re.sub(COPYRIGHT_LINE, "", t).lower()
        for found, read in SPELLINGS:
            t = t.replace(found, read)
        return " ".join(re.findall(r"[^\W_]+", t))

    parts = [p for p in map(canonical, re.split(PARAGRAPH_END, text)) if p]
    runs = {" ".join(parts[a:b]) for a in range(len(parts)) for b in range(a + 2, len(parts) + 1)}
    kinds = [
        {canonical(text)}, runs, set(parts), set(map(canonical, text.split("\n"))),
        set(map(canonical, re.sub(SENTENCE_END, r"\1\n", text).split("\n"))),
    ]
    out = {}
    for name, whole in known:
        paragraphs = [p for p in map(canonical, re.split(PARAGRAPH_END, whole)) if p]
        form = " ".join(paragraphs)
        for rank, kind in enumerate(kinds):
            if form and form in kind and (rank != 1 or len(paragraphs) > 1):
                out[name] = min(out.get(name, rank), rank)
    return {name: RANKED[rank] for name, rank in out.items()}


def test_licences_agree_with_a_search_passage_by_passage(spark):
    rng = random.Random(77)
    known = [*KNOWN, *(p for p in PUBLISHED if len(p[1]) < 3000)]
    pieces = [t for _, t in known] + ["Copyright (c) 2020 A. Released under the MIT License. More.", "© 2021 X", "Plain words. And more!", "", "  ", "\r", "--- per cent", "(c) 1999 B\nfavour"]
    docs = []
    for k in range(150):
        ends = ["\n", "\n\n", ". ", " ", "\n \t\r\n\n"]
        docs.append((k, "".join(x for _ in range(rng.randrange(1, 7)) for x in (rng.choice(pieces), rng.choice(ends)))))
    table = spark.createDataFrame(known, "license string, text string")
    got = {(r.doc_id, r.license, r.scope) for r in find_licenses(frame(spark, docs), table).collect()}
    want = {(i, name, scope) for i, t in docs for name, scope in plain_licenses(t, known).items()}
    assert got == want and len({s for _, _, s in want}) == 5


def test_many_licence_paragraphs_in_one_text(spark):
    opening = MIT.split("\n\n")[0]
    docs = [(1, "\n\n".join([opening] * 20_000)), (2, "\n\n".join([*[opening] * 500, MIT, *[opening] * 500]))]
    assert {tuple(r) for r in find_licenses(frame(spark, docs)).collect()} == {(2, "MIT", "paragraphs")}


def shared_case():
    rng = random.Random(12)
    docs, want = [], set()
    for k in range(40):
        passage = words(rng, rng.randrange(55, 80))
        for j in range(3):
            docs.append((10 * k + j, f"{words(rng, rng.randrange(30, 200))} {passage} {words(rng, rng.randrange(30, 200))}"))
            want.add(10 * k + j)
        few = words(rng, 18)
        for j in (5, 6):
            docs.append((10 * k + j, f"{words(rng, 100)} {few} {words(rng, 100)}"))
    return docs, want


def test_shared_passages_are_found_and_cut_once(spark):
    docs, want = shared_case()
    spans = repeated_spans(frame(spark, docs)).collect()
    assert {r.doc_id for r in spans} == want
    texts = dict(docs)
    for r in spans:
        passage = texts[r.doc_id].encode()[r.start : r.start + r.size]
        assert passage in texts[r.first_id].encode()  # what is reported is really there
        assert r.repeated == (r.first_id != r.doc_id)
    cut = {r.doc_id: r.text for r in drop_repeats(frame(spark, docs)).collect()}
    assert all(cut[i] == texts[i] for i in texts if i % 10 in (0, 5, 6))
    assert all(len(cut[i].split()) < len(texts[i].split()) - 25 for i in texts if i % 10 in (1, 2))


def test_chunks_make_up_the_text_and_shifts_move_no_cut(spark):
    text = words(random.Random(2), 3000)
    rows = chunk_rows(frame(spark, [(1, text), (2, "inserted " + text), (3, None)]), "doc_id", "text").collect()
    one, two = ({(r.hi, r.lo) for r in rows if r.doc_id == i} for i in (1, 2))
    assert len(one & two) > 0.97 * len(one)
    assert sum(r.size for r in rows if r.doc_id == 1) == len(text.encode())
    assert sum(r.n_words for r in rows if r.doc_id == 1) == 3000


def test_odd_documents(spark):
    spans = repeated_spans(frame(spark, odd())).collect()
    # A copy of 40 words is found; rows that are equal are one document.
    assert {r.doc_id for r in spans} <= {None, 6} and all(r.first_id == 6 for r in spans)
    assert drop_repeats(frame(spark, odd())).count() == len(odd())
    assert repeated_spans(frame(spark, [])).count() == 0


def test_what_a_document_holds_first_stays_in_it(spark):
    rng = random.Random(31)
    one, two, edit = words(rng, 80, 9000), words(rng, 80, 9000), words(rng, 45, 9000)
    around = lambda middle: f"{words(rng, 60, 9000)} {middle} {words(rng, 60, 9000)}"
    chain = words(rng, 80, 9000), words(rng, 80, 9000)
    docs = [
        (1, around(one)), (5, around(f"{one} {two}")), (9, around(two)),
        (11, around(" ".join(chain))), (15, around(f"{chain[0]} {edit} {chain[1]}")), (19, around(f"{chain[0]} {edit} {chain[1]}")),
    ]
    spans = repeated_spans(frame(spark, docs)).collect()
    assert {(r.doc_id, r.repeated) for r in spans} == {(1, False), (5, True), (5, False), (9, True), (11, False), (15, True), (15, False), (19, True)}
    cut = {r.doc_id: r.text for r in drop_repeats(frame(spark, docs)).collect()}
    inner = lambda passage: " ".join(passage.split()[20:-20])
    for passage, holders in ((one, [1]), (two, [5]), (edit, [15]), (chain[0], [11]), (chain[1], [11])):
        assert [i for i, t in cut.items() if (inner(passage) if passage != edit else passage) in t] == holders


def test_a_short_earlier_stretch_stays_with_its_run(spark):
    rng = random.Random(32)
    head, tail = words(rng, 24, 9000), words(rng, 60, 9000)
    around = lambda middle: f"{words(rng, 60, 9000)} {middle} {words(rng, 60, 9000)}"
    docs = [(1, around(head)), (5, around(f"{head} {tail}")), (9, around(f"{head} {tail}"))]
    spans = {r.doc_id: r for r in repeated_spans(frame(spark, docs)).collect()}
    assert {i: r.repeated for i, r in spans.items()} == {5: False, 9: True}
    assert spans[5].n_words == spans[9].n_words
    assert {r.doc_id: r.text for r in drop_repeats(frame(spark, docs)).collect()}[5] == docs[1][1]


def test_whole_texts_and_runs_of_paragraphs(spark):
    from tidemark.llm.license_texts import PUBLISHED

    full = {}
    for name, text in PUBLISHED:
        full.setdefault(name, text)
    some = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0")
    docs = [(k, full[n]) for k, n in enumerate(some)]
    docs += [(20, f"A header.\n\n{MIT}\n\n{LONG}"), (21, f"{LONG}\n\n{full['GPL-3.0']}"), (22, MIT.split("\n\n")[0] + f"\n\n{LONG}"), (23, "# SPDX-License-Identifier: MPL-2.0\ncode")]
    for limit in (100_000, 0):
        got = {tuple(r) for r in find_licenses(frame(spark, docs), broadcast_texts=limit).collect()}
        assert {(k, n, "document") for k, n in enumerate(some)} <= got
        assert {(20, "MIT", "paragraphs"), (21, "GPL-3.0", "paragraphs"), (23, "MPL-2.0", "line")} <= got
        assert not [r for r in got if r[0] == 22]
