"""Personal data, page extraction and benchmark passages against plain versions."""

import re
import time
from html.parser import HTMLParser

import pytest

from ringspan.llm import decontaminate as dc
from ringspan.llm import html_main, pii

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _luhn(digits):
    total = 0
    for place, d in enumerate(reversed(digits)):
        value = int(d) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _brute(text):
    spans = []
    for number, kind in enumerate(pii.KINDS):
        for m in PLAIN[kind].finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or (kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")))
                or (kind == "card" and 12 <= len(digits) <= 19 and _luhn(digits))
                or (kind == "phone" and 9 <= len(digits) <= 15)
            ):
                spans.append((m.start(), m.end(), number, True))
    return sorted(spans, key=lambda s: (s[0], s[2], s[1]))


def test_plain_identifiers_by_brute_force():
    import random

    rng = random.Random(4)
    parts = ["a", "b1", "@", ".", "1", "23", "255", "300", " ", "-", "+", "(", ")", "4111 1111 1111 1111", "+1 555 123 4567", "x@y.z"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [s for s in pii.find_spans(text) if s[3]] == _brute(text), text


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("mail john.doe (at) example [dot] com now", "email", "john.doe (at) example [dot] com"),
        ("write to jo at mail dot example dot org today", "email", "jo at mail dot example dot org"),
        ("jоhn@еxample.com", "email", "jоhn@еxample.com"),  # Cyrillic letters
        ("ｊｏｈｎ＠example．com", "email", "ｊｏｈｎ＠example．com"),
        ("call plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
        ("tel ＋1 555 123 4567", "phone", "＋1 555 123 4567"),
        ("four one one one one one one one one one one one one one one one", "card", "four one one one one one one one one one one one one one one one"),
        ("at 10 dot 0 dot 0 dot 1 there", "ip", "10 dot 0 dot 0 dot 1"),
        ("4111​1111​1111​1111", "card", "4111​1111​1111​1111"),
    ],
)
def test_disguises(text, kind, found):
    assert [(pii.KINDS[k], text[a:b], p) for a, b, k, p in pii.find_spans(text)] == [(kind, found, False)]


def test_plain_prose_has_no_disguises():
    for text in ("look at the dot on it", "one two three go", "un deux trois", "a (at) b", "x" * 50_000):
        assert pii.find_spans(text) == []


def test_pii_table(spark):
    texts = [None, "", "a@b.com or c at d dot com", "é +1 555 123 4567 é", "a@b.com or c at d dot com"]
    docs = spark.createDataFrame([(n, t, 1) for n, t in enumerate(texts)], "doc_id long, text string, spans int")
    found = pii.find_pii(docs)
    rows = {r["doc_id"]: r for r in pii.pii_report(found).collect()}
    assert rows[2]["spans"] == rows[4]["spans"] == "email:0:7,email:11:25"
    assert [rows[2][f"n_{k}"] for k in pii.KINDS] == [1, 0, 0, 0] and rows[2]["n_disguised"] == 1
    assert rows[3]["spans"] == "phone:2:17" and rows[0]["spans"] == rows[1]["spans"] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.mask_pii(found).collect()}
    assert masked[2] == "[email] or [email]" and masked[3] == "é [phone] é" and masked[0] == ""
    assert pii.find_pii(docs.limit(0)).collect() == []


PAGE = """<html><head><title>T</title><script>var x="</p>";</script></head><body class="has-sidebar"><nav><a href=x>Menu</a></nav>
<header><p>Site name</p></header><div class="wrap"><div class="sidebar"><p>Side text that is long enough to count</p></div>
<article class="post-%d"><h1>Title</h1><p>First &amp; <b>bold</b>&nbsp;words<br>second   line<!-- note --><p class="ad-box">Buy now
<p>third<ul><li>one<li>two</ul><div class="comments"><p>A comment that goes on and on, longer than the whole article, to be sure, as
comments on the web are wont to be and ever have been</p></div></article></div>
<form><p>Search</p></form><footer>&copy; me</footer></body></html>"""
TEXT = "Title\nFirst & bold words\nsecond line\nthird\none\ntwo"


def test_pages(spark):
    rows = [(n, f"http://Host.example/{n}", PAGE % n, "x") for n in range(6)]
    rows += [(10, None, PAGE % 3, "x"), (11, "http://host.example/e", None, "x"), (12, "bad url", "", "x"), (12, "bad url", "plain", "x")]
    rows += [(13, "http://host.example/t", (PAGE % 1).split('<div class="comments">')[0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_main.extraction_report(html_main.extract_main_text(pages)).collect()
    texts = {}
    for r in got:
        texts.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    assert all(texts[n] == [TEXT] for n in (*range(6), 10)) and texts[13] == [TEXT]
    assert texts[11] == [""] and sorted(texts[12]) == ["", "plain"]
    assert html_main.extract_main_text(pages.limit(0)).collect() == []


def test_host_paths_outvote_a_page(spark):
    body = "<body><div class='story'><p>%s</p></div><div class='teasers'><p>%s</p></div></body>"
    rows = [(n, "http://a.example/", body % ("long story " * 20, "short")) for n in range(5)]
    rows.append((9, "http://a.example/", body % ("tiny", "many teasers " * 20)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html_main.host_paths(pages).collect()[0]["paths"][0] == "body/div.story"
    got = {r["page_id"]: r["text"] for r in html_main.extract_main_text(pages).collect()}
    assert got[9] == "tiny"


@pytest.mark.parametrize("source", ["<div>" * 3000 + "x", "<" * 50_000, "<p>" * 20_000, '<a "' * 20_000, "<script>" * 5000, "&#x" * 9000])
def test_odd_markup(source):
    html_main.Page(source).main_text(["body/div"])


def _windows(words, size):
    return {tuple(words[i : i + size]): i for i in range(len(words) - size + 1)}


def _brute_hits(text, items, window=10):
    words = dc.words_of(text)
    hit, named = set(), set()
    for name, item in items:
        own = dc.words_of(item)
        size = min(window, len(own))
        if size:
            wanted = set(_windows(own, size))
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in wanted:
                    hit |= set(range(i, i + size))
                    named.add(name)
    return hit, named


def _random_case(seed):
    import random

    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "Ünd", "9"]
    items = [(str(n), " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 9, 10, 11, 25])))) for n in range(rng.randint(0, 5))]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(5)]
    texts += [f"x y {item}, z" for _, item in items]
    return items, texts


@pytest.mark.parametrize("seed", range(60))
def test_automaton_by_brute_force(seed):
    items, texts = _random_case(seed)
    items = [(n, t) for n, t in items if len(dc.words_of(t)) != 1]
    automaton = dc.Automaton([(n, dc.words_of(t)) for n, t in items])
    for text in texts:
        spans, names = automaton.hits(dc.words_of(text))
        assert ({w for a, b in spans for w in range(a, b)}, names) == _brute_hits(text, items)


def test_contamination_table(spark):
    items, texts = _random_case(7)
    items += [("77", "one two three four five six seven eight nine ten eleven"), ("8", "short item here")]
    texts += ["ONE, two three-four five six seven eight nine ten! eleven", "a short item, here", None, ""]
    docs = spark.createDataFrame([(n, t, 0) for n, t in enumerate(texts)], "doc_id long, text string, items int")
    bench = spark.createDataFrame([(int(n), t) for n, t in items] + [(None, "a b c"), (5, None)], "item_id long, text string")
    for block_words in (100_000, 12):
        found = dc.find_contamination(docs, bench, block_words=block_words).collect()
        for r in found:
            hit, named = _brute_hits(texts[r["doc_id"]] or "", items)
            assert {w for h in r["hits"] for w in range(h["from"], h["to"])} == hit
            assert r["items"] == sorted(named)
    none = dc.contamination_report(dc.find_contamination(docs, bench.limit(0))).collect()
    assert all(not r["contaminated"] and r["n_items"] == 0 for r in none) and len(none) == len(texts)


def test_decontaminate(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    clean = "nothing to see here " * 4
    rows = [(1, clean, 7), (2, clean + "- ONE " + item[4:] + "! " + clean, 7), (3, item, 7), (4, None, 7), (5, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in dc.decontaminate(docs, bench).collect()}
    assert got == {1: (clean, 7), 2: (clean + "- ! " + clean, len(clean) * 2 + 4), 4: (None, 7), 5: ("", 7)}
    assert dc.decontaminate(docs, bench).schema.names == docs.schema.names


@pytest.mark.parametrize(
    "attributes, shown",
    [
        ('class="content overflow-hidden"', True),
        ('style="overflow:hidden"', True),
        ('aria-hidden="false"', True),
        ('data-state="hidden"', True),
        ("data-hidden='no' title='display: none'", True),
        ('style="display-mode: none; x-display:none"', True),
        ("hidden", False),
        ('HIDDEN="until-found" class="a"', False),
        ("id=a aria-hidden=true", False),
        ("aria-hidden = 'True'", False),
        ('style="color:red; display : none"', False),
    ],
)
def test_hidden_containers(attributes, shown):
    words = "Text of the article that is long enough to win the page. " * 4
    source = f"<body><div {attributes}><p>{words}</p></div><div><p>Other words.</p></div></body>"
    assert (words.strip() in html_main.Page(source).main_text(())) == shown


ARTICLE = "<h1>T</h1><p>" + "Some words of the article here. " * 8 + "</p>"
CLASSES = [
    "main-content right-sidebar", "layout-with-sidebar", "post-header", "entry-content share-enabled", "legal",
    "row comments-open", "site header-sticky", "story",
]


@pytest.mark.parametrize("name", CLASSES)
@pytest.mark.parametrize("before", ["", "<nav><a href=x>Menu</a> and more</nav>", "<p>Stray line</p>"])
def test_an_article_stays_whatever_its_wrapper_is_called(name, before):
    inside = '<div class="share">Share</div>' + ARTICLE + "<footer>me</footer>"
    shown = html_main.Page(f'<body>{before}<div class="{name}">{inside}</div></body>').main_text(())
    assert shown == "T\n" + ("Some words of the article here. " * 8).strip()


def test_what_is_beside_the_article_goes():
    comments = "<p>A comment by a reader, as long as the article.</p>" * 30
    short = "<p>A short article of one paragraph.</p>"
    for page, wanted in (
        (f'<div class=post>{short}</div><div class="comments">{comments}</div>', "A short article of one paragraph."),
        (f"<section id=post>{short}</section><section id=comments>{comments}</section>", "A short article of one paragraph."),
        (f"<form><nav><a href=1>Home</a></nav><div>{short}</div><footer>me</footer></form>", "A short article of one paragraph."),
        (f"<article><header><h1>Title</h1></header>{short}<aside>{comments}</aside></article>", "Title\nA short article of one paragraph."),
        (f"<header><p>Site</p></header><h1 class=page-header>Title</h1>{short}", "Title\nA short article of one paragraph."),
        ("<nav><p>Only a menu</p></nav>", "Only a menu"),
    ):
        assert html_main.Page(f"<html><body>{page}</body></html>").main_text(()) == wanted


class _Plain(HTMLParser):
    """All text outside of elements that are no article by their tag or a class, by the library's parser."""

    BLOCKS = set("body main article section div table tr td ul ol li dl dt dd p h1 h2 h3 h4 br hr blockquote figure".split())
    BESIDE = set("head nav header footer aside form script style noscript button label".split())
    VOID = set("br hr img input meta link".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks = [], [[]]

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCKS:
            self.blocks.append([])
        if tag not in self.VOID:
            names = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
            words = set(names.lower().replace("-", " ").replace("_", " ").split())
            self.open.append((tag, tag in self.BESIDE or not html_main._MARKED.isdisjoint(words)))

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.blocks.append([])
        places = [n for n, (name, _) in enumerate(self.open) if name == tag]
        if places:
            del self.open[places[-1] :]

    def handle_data(self, data):
        if not any(beside for _, beside in self.open):
            self.blocks[-1].append(data)


def test_given_pages_by_the_library_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_main.extract_main_text(pages).collect()}
    for row in pages.collect():
        plain = _Plain()
        plain.feed(row["html"] or "")
        plain.close()
        blocks = [" ".join("".join(block).split()) for block in plain.blocks]
        assert got[row["page_id"]] == "\n".join(filter(None, blocks))


def test_time_is_in_proportion_to_white_space():
    def seconds(n):
        began = time.perf_counter()
        pii.find_spans("see [x] a" + " " * n + "b (at) c" + "\t " * n + "[ dot")
        return time.perf_counter() - began

    seconds(1_000)
    assert seconds(400_000) < 2


def test_brackets_take_the_blanks_round_them():
    spans = pii.find_spans("write to jo   ( at )  mail\t[dot] org, please")
    assert [(a, b, plain) for a, b, _, plain in spans] == [(9, 36, False)]


def test_decontaminate_is_one_python_step(spark):
    """A task has a Python worker for each step that follows another, and all of them stay with their memory."""
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(f"i{n}", f"w{n} " * 12) for n in range(9)], "item_id string, text string")
    for result in (dc.decontaminate(docs, items, block_words=20), dc.find_contamination(docs, items, block_words=20)):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1
        assert result.count() == 2
