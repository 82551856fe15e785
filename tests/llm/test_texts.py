"""Quality rules, license scan, line dedup, HTML and WARC against plain versions."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierworks.llm import html_text, license_scan, line_dedup, quality_cascade, queries, warc
from tierworks.session import work_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\n ", "one", "a b c d e a b c d e a b c d e", "x " * 4000, "A\nA\nB b\n\nA", "#* $%& |<>", "é\xa0ü ß",
       "x\x1cy", "same row here", "same row here", "\n".join(["line one two three"] * 40), "THE END!!! " * 30]


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "c", 7, "u") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, failed_rule string, n_words bigint, _row string")


def plain_features(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def random_texts(seed, n=60):
    draw = random.Random(seed)
    return ["".join(draw.choice(["a ", "b ", "c ", "dd ", "\n", "# ", "é "]) for _ in range(draw.randint(0, 80))) for _ in range(n)]


def test_features_equal_plain_counts(spark):
    texts = ODD + random_texts(1)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = quality_cascade.measured(table(spark, texts).select("doc_id", "text")).collect()
    assert {r.doc_id: tuple(r[n] for n in names) for r in rows} == {i: plain_features(t) for i, t in enumerate(texts)}


def test_cascade_keeps_the_same_rows_in_any_order(spark):
    docs = table(spark, ODD + random_texts(2) + ["A clean sentence with quite enough different words to be kept here."])
    rules = quality_cascade.BASE + quality_cascade.RULES
    one = quality_cascade.cascade(docs, rules, output="why", ordered=False)
    two = quality_cascade.cascade(docs, rules[::-1], output="why", ordered=False)
    left = lambda df: sorted(r.doc_id for r in df.where("why is null").select("doc_id").collect())
    assert left(one) == left(two) == sorted(r.doc_id for r in quality_cascade.kept(docs).select("doc_id").collect())
    assert quality_cascade.kept(docs).columns == docs.columns
    assert len(ODD) + 60 in left(one) and 0 not in left(one)
    assert quality_cascade.kept(docs.limit(0)).count() == 0


def test_rules_are_ordered_by_rejections_per_cost(spark):
    docs = table(spark, ["!!! a b c d e f g h i j k l m"] * 50)
    order = quality_cascade.estimate_order(docs.select("doc_id", "text"), quality_cascade.RULES)
    assert set(order) == set(quality_cascade.RULES) and order[0].name != "repeated_lines"


def test_of_equal_rejections_the_cheap_rule_comes_first(spark):
    docs = table(spark, [" ".join(f"w{k % 40}" for k in range(200))] * 60).select("doc_id", "text")
    dear = quality_cascade.Rule("dear", "n_repeat_words > 1", ("n_repeat_words",))
    cheap = quality_cascade.Rule("cheap", "n_marks < 1", ("n_marks",))
    features = quality_cascade.measured(docs)
    for _ in range(10):
        assert [r.name for r in quality_cascade.estimate_order(docs, (dear, cheap))] == ["cheap", "dear"]
    # as a column, the dear feature costs nothing, so both orders may come out, but each rule is timed as it will run
    names = quality_cascade.estimate_order(features, (dear, quality_cascade.BASE[0]), known=("n_words", "n_repeat_words"))
    assert {r.name for r in names} == {"dear", "few_words"} and names[0].name == "dear"  # few_words rejects none


LICENSED = [None, "", "MIT License", "mit  license and the Apache-License: mit license mit license", "Released under the MIT License.",
            "This work is licensed under the GNU General Public License, version 3.", "licensed\nunder CC BY", "Licensed under CC BY-NC 4.0.",
            "cc bye", "MIT Licenſe", "smit license", "é mit license", "Released under the MIT\nLicense", "mit license", "mit license",
            "All rights reserved " * 3000, "word " * 3000 + "apache license"]


def plain_scan(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += found
        labels |= {label} if found else set()
    more, best = set(), 0.0
    for line in low.split("\n"):
        held = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line))
        for label, wording in license_scan.TEMPLATES:
            parts = set(license_scan.template_words(wording))
            if 100 * len(held & parts) >= license_scan.PERCENT * len(parts):
                more.add(label)
                best = max(best, len(held & parts) / len(parts))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | more)), 1.0 if places else best)


def test_license_scan_equals_every_line_against_every_template(spark):
    draw = random.Random(3)
    pool = sorted({w for _, x in license_scan.TEMPLATES for w in license_scan.template_words(x)})
    made = [" ".join(draw.choice(pool) for _ in range(draw.randint(1, 60))) for _ in range(60)]
    texts = LICENSED + made + [f"{a}\n{b}" for a, b in zip(made, reversed(made))]
    rows = license_scan.scan(table(spark, texts), windows=False).collect()
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in rows}
    assert got == {i: plain_scan(t) for i, t in enumerate(texts)}
    assert [r.blocks for r in rows if r.doc_id == 4] == [[0]]
    spread = {r.doc_id: set(filter(None, r.labels.split(","))) for r in license_scan.scan(table(spark, texts)).collect()}
    assert spread == {i: plain_windows(t) | set(filter(None, plain_scan(t)[4].split(","))) for i, t in enumerate(texts)}


def test_registered_license_scan_equals_its_sql(spark, tmp_path):
    import duckdb

    draw = random.Random(8)
    pool = sorted({w for _, x in license_scan.TEMPLATES for w in license_scan.template_words(x)})
    wrapped = [re.sub(" (?=(?:\\S+ \\S+)*$)", "\n", w) for _, w in license_scan.TEMPLATES]
    texts = LICENSED + wrapped + [" ".join(draw.choice([*pool, "x", "y\n"]) for _ in range(60)) + " " + draw.choice(wrapped) for _ in range(40)]
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op3_license_scan(spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    wanted = duck.execute(queries.ORACLE_SQL["op3_license_scan"])
    names = [c[0] for c in wanted.description]
    assert sorted(found.columns) == sorted(names)
    rows = lambda all_rows: sorted(tuple(r) for r in all_rows)
    assert [repr(r) for r in rows(found.select(names).collect())] == [repr(r) for r in rows(wanted.fetchall())]


def plain_windows(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    labels = set()
    for label, wording in license_scan.TEMPLATES:
        parts, n = set(license_scan.template_words(wording)), len(re.findall(r"\w+", wording))
        step = license_scan.slack(n)
        for at in range(0, len(words), step):
            if 100 * len(set(words[at : at + n + step]) & parts) >= license_scan.PERCENT * len(parts):
                labels.add(label)
    return labels


def test_license_windows_find_wrapped_notices_and_no_scattered_words(spark):
    draw = random.Random(4)
    pool = sorted({w for _, x in license_scan.TEMPLATES for w in license_scan.template_words(x)})
    wrapped = []
    for k, (_, wording) in enumerate(license_scan.TEMPLATES):  # each at another place, a line of two words each
        words = ["zero"] * k + wording.split() + ["end"]
        wrapped.append("\n * ".join(" ".join(words[i : i + 2]) for i in range(0, len(words), 2)))
    scattered = " ".join(w + " x" * 30 for w in ("all", "rights", "reserved"))
    made = ["\n".join(" ".join(draw.choice(pool) for _ in range(9)) for _ in range(draw.randint(0, 9))) for _ in range(40)]
    texts = [*wrapped, scattered, None, "", "\n", *made]
    rows = license_scan.matches(table(spark, texts), windows=True).select("doc", "label").distinct().collect()
    got = {(r.doc, r.label) for r in rows}
    assert got == {(i, x) for i, t in enumerate(texts) for x in plain_windows(t)}
    assert {(i, label) for i, (label, _) in enumerate(license_scan.TEMPLATES)} <= got
    assert not [x for x in got if x[0] == len(wrapped)]
    out = license_scan.scan(table(spark, texts[:2] + texts[:1]), windows=True).collect()
    assert [r.labels for r in out if r.doc_id == 1] == ["agpl,gpl,gpl-notice,lgpl"] and len(out) == 3
    assert license_scan.scan(table(spark, []), windows=True).count() == 0


def test_license_scan_with_null_and_repeated_ids(spark):
    rows = license_scan.scan(table(spark, ["mit license", "apache license", "x", "Released under the MIT License"], [None, 1, 1, None])).collect()
    assert sorted((r.doc_id or 0, r.labels) for r in rows) == [(0, "mit"), (0, "mit,mit-notice"), (1, ""), (1, "apache")]
    assert license_scan.scan(table(spark, [])).count() == 0


def plain_lines(texts, min_words):
    """Deletes every line that lies in a run with enough words that also occurs at an earlier place."""
    seen, docs = [], []
    for i, text in enumerate(texts):
        held = [x for x in (text or "").split("\n") if WORD.search(x)]
        docs.append(held)
        seen += [(i, k) for k in range(len(held))]
    first, gone = {}, [set() for _ in texts]
    for i, k in seen:
        for end in range(k + 1, len(docs[i]) + 1):
            first.setdefault(tuple(docs[i][k:end]), (i, k))
    for i, k in seen:
        for end in range(k + 1, len(docs[i]) + 1):
            run = tuple(docs[i][k:end])
            if sum(len(WORD.findall(x)) for x in run) >= min_words and first[run] != (i, k):
                gone[i] |= set(range(k, end))
    out = []
    for i, text in enumerate(texts):
        if text is None:
            out.append((None, 0))
            continue
        kept, number = [], -1
        for line in text.split("\n"):
            number += bool(WORD.search(line))
            if number not in gone[i]:
                kept.append(line)
        out.append(("\n".join(kept) if gone[i] else text, len(gone[i])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_equals_all_runs(spark, seed):
    draw = random.Random(seed)
    lines = ["a b c", "d", "e f", "", "g h i j k l", "m n", " "]
    texts = ["\n".join(draw.choice(lines) for _ in range(draw.randint(0, 14))) for _ in range(25)]
    texts += [None, "", "\n", "solo line of words", "a b c\nd\ne f\n" * 30, texts[0]]
    got = {r.doc_id: (r.text, r.n) for r in line_dedup.deduplicated(table(spark, texts), min_words=9, count_col="n").collect()}
    assert got == dict(enumerate(plain_lines(texts, 9)))


def test_line_dedup_columns_nulls_and_empty_tables(spark):
    passage = " ".join(f"w{k}" for k in range(55))
    docs = table(spark, [passage, f"head\n{passage}\ntail", passage, passage, None], [1, 2, 3, 3, None])
    out = line_dedup.deduplicated(docs, drop_empty=True)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect() if r.text) == [(1, passage), (2, "head\ntail")]
    assert line_dedup.deduplicated(docs.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="has-sidebar">
<nav><a href="/x">Menu entry, with, commas, that, score, highly</a></nav><div class="cookie-notice">We use cookies, many, of them.</div>
<div id="page"><div class="post content"><h1>Head&nbsp;line</h1><p>First paragraph, long enough to be scored, with <b>bold</b> text &amp; more.
<p>Second<br>one, without an end tag, goes on for a while so that it scores.<div class="ad">Buy, now</div>
<script>var a = "</p><p>no";</script><p>Short.</p></div><div class="sidebar"><p>Side, text, with, very, many, commas, in, it, indeed.</p></div>
<section id="comments"><p>A reader, says something, at length, about all of this, and more.</p></section></div>
<form><p>Name, please, and a long enough sentence to be scored.</p></form><footer>&copy; all</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_blocks(PAGE) == [
        "Head line", "First paragraph, long enough to be scored, with bold text & more.",
        "Second one, without an end tag, goes on for a while so that it scores.", "Short.",
    ]


LONG = "A paragraph of the article, long enough to be scored, with commas, and more words than a menu has."


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "elementor-widget-container", "sidebar", "widget", "comments-open", "footer-wrap"])
@pytest.mark.parametrize("inner", ["<article>%s</article>", "<div>%s</div>"])
def test_wrappers_named_like_furniture_keep_the_article(name, inner):
    body = inner % f"<p>{LONG}</p><p>{LONG}</p>"
    page = f'<body><nav>Menu</nav><div class="{name}">{body}<div class="sidebar-left"><p>Side.</p></div></div><div id="widget-2">W.</div></body>'
    assert html_text.main_blocks(page) == [LONG, LONG]
    assert html_text.main_blocks(f'<body><div class="site-footer">{LONG}</div><article><p>{LONG * 2}</p></article></body>') == [LONG * 2]
    three = "".join(f'<section class="widget"><p>{LONG}</p></section>' for _ in range(3))
    assert LONG in html_text.main_blocks(f"<body>{three}</body>")
    assert html_text.main_blocks(f'<body><p><span class="widget">{LONG}</span> x</p></body>') == [LONG + " x"]


BOXES = ['class="post-comments"', 'id="comments" class="post"', 'class="comment-body"', 'class="comment-text"', 'class="page-footer"',
         'class="entry-footer"', 'class="article-sidebar"', 'class="post-share-bar"', 'class="main-navigation"']


@pytest.mark.parametrize("names", BOXES)
def test_content_words_do_not_keep_comments_footers_and_side_bars(names):
    page = f'<body><article><div class="post-header">Head</div><p>{LONG}</p><div class="text-widget">Tail</div><div {names}><p>{{}}</p></div></article></body>'
    for other in ("Said, by a reader.", LONG):
        assert html_text.main_blocks(page.format(other)) == ["Head", LONG, "Tail"]
    teasers = f"<div {names}><article class='comment-body'><p>{LONG}</p></article></div>"
    assert html_text.main_blocks(f"<body><article><p>{LONG}, x</p></article>{teasers}</body>") == [LONG + ", x"]


OPEN = ['<svg viewBox="0 0 1 1"/>', "<svg/>", '<svg><path d="M0"/><text>T</text>', "<math/>", "<math>", "<select><option>A<option>B", '<object data="x">',
        "<canvas>", "<noscript>", "<template>", "<title-bar></title-bar>", "<head>"]


@pytest.mark.parametrize("tag", OPEN)
def test_open_and_self_closing_elements_take_no_text_behind_them(tag):
    page = f"<body><article>{tag}<p>{LONG}</p><p>{LONG}</p></article><footer>All</footer></body>"
    assert html_text.main_blocks(page) == [LONG, LONG]
    choices = ["A", "B"] if "select" in tag else []
    assert html_text.all_blocks(page) == [*choices, LONG, LONG, "All"]


def test_drawings_and_formulas_inside_text():
    inside = '<svg><title>t</title><g><text>T</text></g></svg><math><mi>x</mi><annotation>tex</annotation></math><noscript><p>No</p></noscript>'
    page = f'<article><p>{LONG} {inside} = 1 <svg/><a class="share"><svg><path/></svg> Share</a></p><script>"</p>"</script></article>'
    assert html_text.main_blocks(page) == [LONG + " x = 1"]
    assert html_text.all_blocks(page) == [LONG + " x = 1 Share"]


def test_siblings_of_the_best_container_stay_by_their_links():
    half = lambda n: "a, " * n + "x" * (300 - 3 * n)
    links = '<ul><li><a href="/a">Another page</a></li><li><a href="/b">One more page</a></li></ul>'
    page = (
        f"<body><div><h3>Top</h3><section><p>{half(4)}</p></section>{links}<h4>Middle</h4><section><p>Short.</p></section>"
        f"<ul><li>One</li><li>Two</li></ul><table><tr><td>3</td></tr></table><figure><figcaption>Fig.</figcaption></figure>"
        f'<section><p>{half(2)}</p></section><div><p>In <a href="/c">short</a> that was all of it.</p></div>{links}</div></body>'
    )
    assert html_text.main_blocks(page) == [
        "Top", half(4), "Middle", "Short.", "One", "Two", "3", "Fig.", half(2), "In short that was all of it.",
    ]


def test_nested_sections_and_sources_stay():
    assert html_text.main_blocks(
        "<main><h2>H</h2><div><div><p>A</p></div></div><div><div><p>B</p></div></div></main>") == ["H", "A", "B"]
    parts = f"<h1>T</h1><div><div><p>{LONG}</p></div></div><div><div><h3>S</h3><p>{LONG}</p></div></div>"
    assert html_text.main_blocks(f"<body><nav>M</nav>{parts}<footer>F</footer></body>") == ["T", LONG, "S", LONG]
    sources = '<h3>Sources</h3><ul><li><a href="/x">One source</a></li><li><a href="/y">Two</a></li></ul>'
    assert html_text.main_blocks(f"<body><article><p>{LONG}</p>{sources}</article></body>") == [LONG, "Sources", "One source", "Two"]


@pytest.mark.parametrize("box", ['<ol class="commentlist"><li>%s</li></ol>', '<div class="sidebar"><p>%s</p></div>',
                                 '<div class="cookie-consent"><p>%s</p></div>', "<nav>%s</nav>", "<aside><p>%s</p></aside>"])
@pytest.mark.parametrize("home", ["<p>%s</p>", '<div class="text"><p>%s</p></div>', '<div class="post"><div><p>%s</p></div></div>'])
def test_boxes_longer_than_the_text_go(box, home):
    text = LONG * 2
    assert html_text.main_blocks(f"<body>{home % text}{box % (text * 4)}</body>") == [text]
    assert html_text.main_blocks(f"<body>{box % (text * 4)}{home % text}{box % text}</body>") == [text]


def random_page(draw):
    """A page whose main blocks are known, as it is put together from them and from furniture."""
    number = iter(range(1000))
    kept = []

    def prose(mark):
        text = f"{mark}{next(number)} " + " ".join(draw.choice(["some", "words,", "of", "text."]) for _ in range(draw.randint(12, 60)))
        return text

    def block():
        text = prose("k")
        kept.append(text)
        tag = draw.choice(["p", "p", "p", "h2", "blockquote", "li"])
        return f"<ul><li>{text}</li></ul>" if tag == "li" else f"<{tag}>{text}</{tag}>"

    def furniture():
        text = prose("f") if draw.random() < 0.5 else "f short"
        return draw.choice([
            "<nav>%s</nav>", "<aside>%s</aside>", '<div class="sidebar">%s</div>', '<div class="ad">%s</div>', "<form>%s</form>",
            '<ul class="commentlist"><li>%s</li></ul>', "<script>%s</script>", '<div role="banner">%s</div>', "<!-- %s -->",
            '<div id="comments"><p>%s</p></div>', '<div class="cookie-notice">%s</div>', '<p hidden>%s</p>',
        ]) % text

    def section(depth):
        parts = []
        for _ in range(draw.randint(1, 3)):
            parts.append(section(depth - 1) if depth and draw.random() < 0.5 else block())
            if draw.random() < 0.3:
                parts.append(furniture())
        tag = draw.choice(["div", "section", 'div class="inner"'])
        return f"<{tag}>{''.join(parts)}</{tag.split()[0]}>"

    home = draw.choice(["article", "main", 'article class="post"', "div"])
    body = "".join(section(3) for _ in range(draw.randint(1, 4)))
    around = ["".join(furniture() for _ in range(draw.randint(0, 3))) for _ in range(2)]
    page = f"<html><head><title>t</title></head><body>{around[0]}<{home}>{body}</{home.split()[0]}>{around[1]}</body></html>"
    return page, kept


@pytest.mark.parametrize("seed", range(200))
def test_main_text_equals_what_the_page_was_made_of(seed):
    page, kept = random_page(random.Random(seed))
    assert html_text.main_blocks(page) == kept


def test_many_articles_and_boxes_take_linear_time():
    import time

    def took(n):
        page = "<body>" + "<article><p>t</p></article><div class=sidebar>x</div>" * n + "</body>"
        began = time.process_time()
        html_text.main_blocks(page)
        return time.process_time() - began

    took(100)
    assert took(8000) < 12 * max(took(1000), 0.05)


@pytest.mark.parametrize("cut", range(0, len(PAGE), 37))
def test_cut_off_pages_do_not_fail(cut):
    html_text.main_blocks(PAGE[:cut])
    html_text.all_blocks(PAGE[cut:])


def test_extract_text_with_odd_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "v", "", ""), (3, "w", "plain text only", "y"),
            (4, "z", "<div>" * 3000 + "deep" + "</div>" * 3000, "z"), (5, "a", "<article><p>Of.</p></article>", "b")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in html_text.extract_text(pages).collect()), key=str)
    main = "\n\n".join(html_text.main_blocks(PAGE))
    assert got == sorted([(1, "u", main, len(main))] * 2 + [(0, None, "", 0), (2, "v", "", 0), (3, "w", "plain text only", 15),
                          (4, "z", "deep", 4), (5, "a", "Of.", 3)], key=str)
    assert html_text.extract_text(pages.limit(0)).count() == 0


def test_warc_round_trip_and_links(spark):
    rows = [(1, "http://a.example/x?y", PAGE), (2, None, None), (3, "http://b.example/\r\nX: y", "a\r\n\r\nWARC/1.1\r\n\r\nb"), (1, "http://a.example/x?y", PAGE),
            (4, "http://é.example", "ü" * 40000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("headers", F.lit("clash"))
    made = warc.responses(pages)
    for compression in ("gzip", "none"):
        path = work_dir(spark, "warc")
        warc.write_warc(made, path, compression=compression, records_per_file=2)
        read = warc.read_warc(spark, path)
        key = lambda df: sorted((sorted(dict(r.headers).items()), bytes(r.block)) for r in df.collect())
        assert key(read) == key(made)
    derived = [(dict(r.headers), bytes(r.block)) for r in warc.derive(read).collect()]
    assert len(derived) == 10
    sources = {r.headers["WARC-Record-ID"]: r.headers for r in made.collect()}
    names = {h["WARC-Record-ID"]: h for h, _ in derived}
    for h, block in derived:
        source = sources[h["WARC-Refers-To"]]
        assert h["X-Source-Payload-Digest"] == source["WARC-Payload-Digest"] and int(h["Content-Length"]) == len(block)
        assert names[h["WARC-Concurrent-To"]]["WARC-Concurrent-To"] == h["WARC-Record-ID"]
        assert h.get("WARC-Target-URI") == source.get("WARC-Target-URI")
    about = [b.decode() for h, b in derived if h["X-Source-Row"] == "1" and h["WARC-Type"] == "metadata"][0]
    assert "title: T & t\r\n" in about and "outlink: http://a.example/x\r\n" in about
    again = work_dir(spark, "warc")
    warc.write_warc(warc.derive(read), again)
    assert warc.read_warc(spark, again).count() == 10
    assert warc.derive(made.limit(0)).count() == 0


def test_warc_cut_off_and_with_a_member_per_record():
    import gzip

    record = lambda n: b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (n, b"x" * n)
    data = gzip.compress(record(5)) + gzip.compress(record(7))
    assert [len(b) for _, b in warc.parse_warc(data)] == [5, 7]
    assert [len(b) for _, b in warc.parse_warc(data[:-9])] in ([5], [5, 7])
    assert [len(b) for _, b in warc.parse_warc((record(5) + record(7))[:-8])] == [5]
    assert list(warc.parse_warc(b"")) == []


def response(body, *headers, name="WARC-Type"):
    block = b"\r\n".join([b"HTTP/1.1 200 OK", *(h.encode() for h in headers)]) + b"\r\n\r\n" + body
    return {name: "response", "warc-record-id": "<urn:uuid:1>", "WARC-Target-URI": "http://h.example/a/b", "warc-date": "2024"}, block


def derived(*record):
    return {own["WARC-Type"]: (own, body.decode()) for own, body in warc._derived(*record)}


PAGE_BYTES = b'<html lang="en"><title>A &amp; b</title><!-- <a href="/no"> --><p>Text <a data-href="/no" href="/yes">l</a><a href=c>m</a></p></html>'


@pytest.mark.parametrize("coding", ["gzip", "deflate", "zstd", "chunked", "gzip chunked", ""])
def test_encoded_payloads_are_read(coding):
    import gzip
    import zlib

    import zstandard

    body, headers = PAGE_BYTES, ["Content-Type: text/html; charset=utf-8"]
    if coding.startswith(("gzip", "deflate", "zstd")):
        kind = coding.split()[0]
        body = {"gzip": gzip.compress, "deflate": zlib.compress, "zstd": zstandard.compress}[kind](body)
        headers.append(f"Content-Encoding: {kind}")
    if "chunked" in coding:
        body = b"".join(b"%x;x=y\r\n%s\r\n" % (len(body[i : i + 50]), body[i : i + 50]) for i in range(0, len(body), 50)) + b"0\r\n\r\n"
        headers.append("Transfer-Encoding: chunked")
    found = derived(*response(body, *headers))
    assert found["conversion"][1] == "Text lm"
    about = found["metadata"][1].split("\r\n")
    assert [x for x in about if x.startswith(("title", "language", "outlink"))] == [
        "title: A & b", "language: en", "outlink: http://h.example/yes", "outlink: http://h.example/a/c"]
    assert found["conversion"][0]["WARC-Refers-To"] == "<urn:uuid:1>" and found["conversion"][0]["WARC-Refers-To-Date"] == "2024"


def test_responses_without_text_have_metadata_only():
    for headers in (["Content-Type: image/png"], ["Content-Type: text/html", "Content-Encoding: unheard"]):
        found = derived(*response(b"\x89PNG\r\n", *headers))
        assert set(found) == {"metadata"} and "WARC-Concurrent-To" not in found["metadata"][0]
    assert derived(*response(b"a < b\n<p>", "Content-Type: text/plain"))["conversion"][1] == "a < b\n<p>"


def test_header_names_count_in_any_case(spark):
    rows = [response(b"<p>x</p>", name=n) for n in ("warc-type", "WARC-TYPE", "Warc-Type")] + [({"WARC-Type": "warcinfo"}, b"")]
    records = spark.createDataFrame(rows, warc.RECORD)
    assert warc.derive(records).count() == 6


@pytest.mark.parametrize("piece", ["<a ", "<a href='", "<title>", "<title ", "<html ", "<a href=x ", "<!--", "<svg>", "&"])
def test_odd_pages_take_linear_time(piece):
    import time

    def took(n):
        record = response(("<p>x" + piece * n).encode(), "Content-Type: text/html")
        began = time.process_time()
        derived(*record)
        return time.process_time() - began

    took(100)
    assert took(40_000) < 16 * max(took(5_000), 0.05)


def test_metadata_equals_a_plain_recount(spark):
    """Fields and links as another parser finds them."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.links, self.lang, self.title, self.inside = [], None, "", False

        def handle_starttag(self, tag, attrs):
            held = dict(reversed(attrs))
            if tag == "a" and held.get("href"):
                self.links.append(held["href"])
            self.lang = held.get("lang") if tag == "html" else self.lang
            self.inside = tag == "title" or self.inside

        def handle_endtag(self, tag):
            self.inside = self.inside and tag != "title"

        def handle_data(self, data):
            self.title += data if self.inside else ""

    draw = random.Random(5)
    for k in range(60):
        links = [draw.choice(["/x?a=1&amp;b=2", "y.html", "http://o.example/z", "#f"]) for _ in range(draw.randint(0, 6))]
        page = f'<html lang="{draw.choice(["en", "de"])}"><head><title>T {k} &lt;</title></head><body>' + "".join(
            draw.choice(["<p>w <a class=k href='{0}'>l</a></p>", '<div><a href="{0}" title="q > r">l</a>', "<nav><a href={0}>l</a></nav>"]).format(x) for x in links)
        seen = Plain()
        seen.feed(page)
        about = dict.fromkeys(["title", "language"], None)
        outlinks = []
        for line in derived(*response(page.encode(), "Content-Type: text/html"))["metadata"][1].split("\r\n"):
            name, _, value = line.partition(": ")
            outlinks += [value] if name == "outlink" else []
            about[name] = value
        from urllib.parse import urljoin

        assert (about["title"], about["language"]) == (seen.title.strip(), seen.lang)
        assert outlinks == [urljoin("http://h.example/a/b", x) for x in seen.links]
