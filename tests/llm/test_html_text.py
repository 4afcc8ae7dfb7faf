import numpy as np
from helpers import documents  # noqa: F401
from pyspark.sql import functions as F
from riskweave.llm import html_text as ht


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("host", "shard", "digest", "text", "parts")})
    return {(r.page_id, r.url): r.text for r in ht.main_text(df, **options).collect()}


def test_one_page(spark):
    page = """<!doctype html><HTML><head><title>T</title><style>p{}</style><script>var a="</p><article>no</article>";</script></head>
    <body><nav><ul><li><a href="x>y">menu</a></li></ul></nav><!-- <p>no</p> --><header><h1>site</h1></header>
    <main><article class="post"><h1>Title &amp; more</h1><p>One <b>bo</b>ld&nbsp; word<br>next<p>unclosed &lt;p&gt; &am
    <div class="share-links">share me</div><aside>side</aside><form><label>name</label></form>
    <section id="comments"><article>reader comment</article></section><table><tr><td>a<td>b</table></article></main>
    <div class="cookie-notice">We use cookies</div><footer>&copy; x</footer></body></html>"""
    got = run(spark, [(1, "http://a.example/1", page), (2, "http://b.example/1", page[: page.index("unclosed") + 5]), (3, None, None), (4, None, ""), (None, "u", "plain <b>te</b>xt")])
    assert got[1, "http://a.example/1"] == "Title & more One bold word next unclosed <p> &am a b"
    assert got[2, "http://b.example/1"] == "Title & more One bold word next unclo"
    assert got[3, None] == got[4, None] == "" and got[None, "u"] == "plain text"


def pages_of(host, n, lead="Welcome to our wonderful site of many things", tail="All rights reserved by the owners of this site"):
    rng = np.random.default_rng(n)
    rows, texts = [], []
    for i in range(n):
        text = " ".join(f"w{x}" for x in rng.integers(0, 10_000, 30))
        rows.append((i, f"https://{host}/{i}", f"<div><span>{lead}</span></div><div><p>{text}</p></div><div><i>{tail}</i></div>"))
        texts.append(text)
    return rows, texts


def test_repeats_of_a_host_go_and_unique_runs_stay(spark):
    rows, texts = pages_of("h.example", 12)
    copies = [(100 + i, f"https://h.example/copy{i}", rows[0][2]) for i in range(5)]
    single = [(200, "https://single.example/", rows[3][2].replace("https", "http"))]
    for options in ({}, {"shard_bytes": 1 << 14}):
        got = run(spark, [*rows, *copies, *single, rows[2]], **options)
        assert [got[r[0], r[1]] for r in rows] == texts
        assert {got[c[0], c[1]] for c in copies} == {texts[0]}
    assert got[200, "https://single.example/"].startswith("Welcome")  # nothing says that it repeats


def test_paths_judged_by_other_hosts(spark):
    """A path that is boilerplate on large hosts is boilerplate on a host with one page."""
    rows = []
    for h in range(3):
        own, _ = pages_of(f"h{h}.example", 10)
        rows += [(i + 100 * h, u, f"<article>story {i} {h}</article><div class='blurb'>buy our fine goods at low prices today</div>") for i, u, _ in own]
    got = run(spark, [*rows, (999, "http://one.example/", "<article>alone</article><div class='blurb'>some unseen words are standing here</div>")])
    assert got[999, "http://one.example/"] == "alone"
    assert got[0, "https://h0.example/0"] == "story 0 0"


def test_articles_stay_whole_even_if_copied(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"http://c.example/{i}", f"<article><p>{text}</p></article>") for i in range(20)]
    rows.append((50, "http://c.example/long", f"<article><p>{'x ' * 50_000}</p></article>"))
    got = run(spark, rows)
    assert {got[r[0], r[1]] for r in rows[:20]} == {text} and len(got[50, "http://c.example/long"]) == 99_999
    assert run(spark, []) == {}


def test_names_do_not_take_articles_or_overrule_evidence(spark):
    frames = ['<body class="no-sidebar"><article>{}</article></body>', '<div id="main-search-page"><main>{}</main></div>', '<article class="post comment-open">{}</article>']
    rows = [(i, f"http://n{i}.example/", f.format(f"alone {i} <div class='share'>share me</div>")) for i, f in enumerate(frames)]
    own, texts = pages_of("named.example", 12)
    own = [(100 + i, u, h.replace("<div><p>", "<div class='search-result'><p>")) for i, u, h in own]
    inside = [(200 + i, f"http://in.example/{i}", f"<article>story {i}<div class='post-header'>{t}</div><div class='ad'>buy our fine goods at low prices today</div></article>") for i, t in enumerate(texts)]
    outside = [(300 + i, f"http://out.example/{i}", f"<div class='ad'>{t}</div><article>story {i}</article>") for i, t in enumerate(texts)]
    got = run(spark, rows + own + inside + outside)
    assert [got[r[0], r[1]] for r in rows] == ["alone 0", "alone 1", "alone 2"]
    assert [got[r[0], r[1]] for r in own] == texts
    assert [got[r[0], r[1]] for r in inside] == [f"story {i} {t}" for i, t in enumerate(texts)]
    assert [got[r[0], r[1]] for r in outside] == [f"story {i}" for i in range(12)]


def test_covered_runs_go_and_unique_articles_of_the_same_path_stay(spark):
    """More than half of the words of the one path are syndicated; menus differ from page to page."""
    rng = np.random.default_rng(9)
    story = [f"s{x}" for x in rng.integers(0, 9000, 120)]
    rows, want = [], []
    for i in range(20):
        words = [f"u{i}x{x}" for x in range(60)]
        if i < 12:
            words = [*story]
            words[10 + i] = f"changed{i}"
        menu = f"<div class='m{i}'>page {i} of a menu that is only here {i}</div>"
        rows.append((i, f"http://syn.example/{i}", f"<nav>go {i}</nav>{menu}<p>{' '.join(words)}</p><p>all rights reserved by the owner of this place</p>"))
        want.append(" ".join(words))
    got = run(spark, rows)
    assert all(got[r[0], r[1]].endswith(w) for r, w in zip(rows[12:], want[12:], strict=True))
    # a copy that most pages of the host have may count as its boilerplate; that of a few may not
    few = [r for r in rows if r[0] < 4 or r[0] >= 12]
    got = run(spark, few)
    assert all(want[r[0]] in got[r[0], r[1]] and "rights" not in got[r[0], r[1]] for r in few)


def test_runs_are_counted_over_all_shards_of_a_host(spark):
    """A notice on a few pages of a host of many shards, mostly one to a shard."""
    rng = np.random.default_rng(3)
    rows, want = [], []
    for i in range(60):
        text = " ".join(f"w{x}" for x in rng.integers(0, 100_000, 60))
        notice = "<div>this notice stands on every page of the place</div>"
        rows.append((i, "http://big.example/", f"{notice}<p>{text}</p>"))
        want.append(text)
    rows.append((99, "http://big.example/copy", rows[0][2]))
    want.append(want[0])
    whole, split = run(spark, rows), run(spark, rows, shard_bytes=1000)
    assert whole == split
    assert [split[r[0], r[1]] for r in rows] == want


def test_repeated_tokens_against_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(30):
        tokens, n = rng.integers(0, 4, 120), 4
        pages = np.sort(rng.integers(0, 6, 120))
        hosts = pages % 2
        got = ht.repeated_tokens(tokens, pages, hosts, n)
        where = {}
        for i in range(120 - n + 1):
            if pages[i] == pages[i + n - 1]:
                where.setdefault((hosts[i], *tokens[i : i + n]), set()).add(pages[i])
        want = np.zeros(120, dtype=int)
        for i in range(120 - n + 1):
            if pages[i] == pages[i + n - 1]:
                c = len(where[(hosts[i], *tokens[i : i + n])])
                if c > 1:
                    want[i : i + n] = np.maximum(want[i : i + n], c)
        assert (got == want).all()


def told(html):
    return " | ".join(b.text for b in ht.blocks_of(html) if b.state != ht.DROP)


def test_broken_tags_are_read_in_one_pass():
    assert told('<p class="x"">Main text here</p>') == "Main text here"
    assert told('<a title="x>tail</a><p class="z">text') == "text"
    assert told("<p>a < b <c </p> x &lt; z</ div><!-- no --><?x?><b title='u>end of <i>it") == "a < b x < zend of it"
    assert told("<p data-x = 'a>b' class=c>one<p/>two</p") == "one | two"


def test_very_long_broken_pages_take_seconds():
    import time

    begin = time.time()
    n = 1_500_000
    for page in ("<a " * n + '"', "<a x='y" * n, "<a x='y>" * n, "</" * n, "<!--" * n, "<script>" * n, "<div>" * (n // 5), "<div>" * (n // 20) + "</p></li>" * (n // 20)):
        ht.blocks_of(page)
    assert time.time() - begin < 90


def site(host, n, frame, words=60):
    """Pages of a host whose parts all vary; {text} {few} {more} {i} fill the frame."""
    rng = np.random.default_rng(n)
    rows, texts = [], []
    for i in range(n):
        def some(k):
            return " ".join(f"w{x}" for x in rng.integers(0, 10_000, k))
        texts.append(some(words))
        rows.append((i, f"https://{host}/{i}", frame.format(text=texts[-1], few=some(9), more=some(25), again=some(30), i=i)))
    return rows, texts


def test_varying_adverts_sidebars_and_comments_go_and_the_article_stays(spark):
    thread = "<ol><li><p>Ann {i} wrote</p><p>{few}</p></li><li><p>Bob 2024-01-0{i}</p><p>{more}</p></li><li><p>Cy, 3 hours ago</p><p>{again}</p></li></ol>"
    frames = {
        "a.example": "<article><p>{text}</p><div class='comments'><article>{more}</article><div>{again}</div></div></article>",
        "b.example": "<div class='ad-slot'>{few}</div><div class='story'><p>{text}</p></div><div id='sidebar'><p>{more}</p></div><div class='comments'>{again}</div>",
        "c.example": "<div class='post'><p>{text}</p></div>" + thread,
        "d.example": "<article><p>{text}</p>" + thread + "</article>",
        "e.example": "<div class='sidebar-layout'><article><p>{text}</p><div class='ad'>{few}</div></article></div>",
    }
    for host, frame in frames.items():
        rows, texts = site(host, 12, frame)
        got = run(spark, rows)
        assert [got[r[0], r[1]] for r in rows] == texts, host


def test_a_line_of_every_article_goes_and_copies_of_articles_stay(spark):
    line = "please follow our channel for more of these stories"
    rows, texts = site("l.example", 12, f"<article><p>{{text}}</p><p>{line}</p></article>")
    got = run(spark, rows)
    assert [got[r[0], r[1]] for r in rows] == texts
    few = rows[:5]
    got = run(spark, few)  # too few pages: no evidence
    assert [got[r[0], r[1]] for r in few] == [f"{t} {line}" for t in texts[:5]]
    story = " ".join(f"s{i}" for i in range(80))
    near = [(i, f"http://n.example/{i}", f"<article><p>{story} changed{i}</p></article>") for i in range(20)]
    got = run(spark, near)
    assert [got[r[0], r[1]] for r in near] == [f"{story} changed{i}" for i in range(20)]


def test_only_text_of_a_page_stays_whatever_it_is_called(spark):
    rows, texts = site("o.example", 12, "<div class='related-stories'><p>{text}</p></div>")
    got = run(spark, rows)
    assert [got[r[0], r[1]] for r in rows] == texts


def test_lines_of_articles_are_counted_over_all_shards_of_a_host(spark):
    """A line of most articles of a host that is dealt over shards with hardly any pages goes as on a small host."""
    line = "please follow our channel for more of these stories"
    rows, texts = site("large.example", 60, f"<div>this notice stands on every page of the place</div><article><p>{{text}}</p><p>{line}</p></article><p>{{more}}</p>")
    rare = "these words stand on some of the articles only"
    rows = [(i, u, h.replace("</article>", f"<p>{rare}</p><p>more for of channel our follow please {i}</p></article>") if i % 3 else h) for i, u, h in rows]
    copies = [(100 + i, f"http://large.example/copy{i}", rows[i][2]) for i in range(12)]
    whole = run(spark, rows + copies)
    assert line not in whole[rows[0][0], rows[0][1]]
    for shard_bytes in (1000, 8000):
        split = run(spark, rows + copies, shard_bytes=shard_bytes)
        assert split == whole
    assert [split[r[0], r[1]].startswith(t) for r, t in zip(rows, texts, strict=True)] == [True] * 60
    assert sum(rare in t for t in split.values()) == 0 and not any(line in t for t in split.values())
    few = [(i, u, h.replace(rare, "") if i % 9 else h) for i, u, h in rows]
    split = run(spark, few, shard_bytes=1000)
    assert split == run(spark, few) and sum(rare in t for t in split.values()) == sum(rare in h for _, _, h in few)
