"""Main text against the text that pages were made from."""

import random

from lodestar.llm import wrappers


def make_page(rng, n):
    words = lambda k: " ".join(rng.choice(["red", "blue", "a &amp; b", "&eacute;t&#233;", "x&nbsp;y", "café"]) for _ in range(k))
    plain = lambda t: " ".join(t.replace("&amp;", "&").replace("&eacute;", "é").replace("&#233;", "é").replace("&nbsp;", " ").split())
    halfway = lambda p: max(0, p.find(" ", len(p) // 2))
    title, paragraphs = words(4), [words(rng.randint(3, 30)) for _ in range(rng.randint(1, 6))]
    items = [words(3) for _ in range(rng.randint(0, 4))]
    body = f"<h1>{title}</h1>" + "".join(f"<p class='t{n}'>{p[: halfway(p)]}\n\t <b>{p[halfway(p) :]}</b></p>" for p in paragraphs)
    body += ("<ul>" + "".join(f"<li>{x}" for x in items) + "</ul>") if items else ""
    if rng.random() < 0.5:
        body += f"<aside>{words(5)}</aside><form><input name=q><button>Go</button>{words(2)}</form>"
    if rng.random() < 0.4:
        body += f"<section id=comments><h2>Comments</h2><p>{words(9)}</p></section>"
    source = f"<!DOCTYPE html><HTML><head><title>{title}</title><style>p>a{{}}</style><script>if(a<b){{x='</p>'}}</script></head><body><header>{words(2)}</header><nav><a href='/a>b'>{words(1)}</a></nav>"
    source += f"<div class='cookie-notice'>{words(6)}</div><!-- <p>no</p> --><article>{body}</article><div class=\"sidebar\">{words(8)}</div><footer>&copy; {words(3)}</footer></body>"
    return source, "\n".join(plain(x) for x in [title, *paragraphs, *items])


def test_pages_of_a_host(spark):
    rng = random.Random(2)
    made = [make_page(rng, i) for i in range(120)]
    rows = [(i, f"http://h{i % 3}.example/{i}", s) for i, (s, _) in enumerate(made)]
    rows += [(200, None, None), (201, "nonsense", ""), (202, "http://h0.example/x", "plain < text & more"), rows[0], (None, "http://h1.example/", made[0][0])]
    pages = spark.createDataFrame([(*r, "w", "x") for r in rows], "page_id long, url string, html string, wrapper string, host string").repartition(4)
    got = wrappers.extract(pages).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for i, (_, text) in enumerate(made):
        assert by_id[i].text == text
        assert by_id[i].n_chars == len(text)
    assert by_id[200].text == by_id[201].text == "" and by_id[None].text == made[0][1]
    assert sum(r.conforms for r in got) > 60
    assert wrappers.extract(pages.where("false")).count() == 0


def test_repeats_become_groups_and_gaps_optional():
    items = ["<ul>", *["<li>", "#", "</li>"] * 4, "</ul>", "<p>", "#", "</p>"]
    assert wrappers.collapse(items) == ["<ul>", '+["<li>","#","</li>"]', "</ul>", "<p>", "#", "</p>"]
    a = wrappers.Wrapper([[x, False] for x in wrappers.collapse(items)], {})
    b = wrappers.Wrapper([[x, False] for x in ["<ul>", "<li>", "#", "</li>", "</ul>"]], {})
    merged = a.merge(b)
    assert merged.parts == [["<ul>", False], ['+["<li>","#","</li>"]', False], ["</ul>", False], ["<p>", True], ["#", True], ["</p>", True]]
    pattern, letters = merged.pattern()
    for n in (1, 2, 7):
        assert pattern.fullmatch("".join(letters[x] for x in ["<ul>", *["<li>", "#", "</li>"] * n, "</ul>"]))


def test_without_article_the_varying_text_is_content():
    pages = [f"<body><div><p>Same line here</p><p>Story {i} of the day, number {i}</p></div><div class=footer>end</div></body>" for i in range(5)]
    whole = None
    for p in pages:
        part = wrappers.Wrapper.of(wrappers.Page(p))
        whole = part if whole is None else whole.merge(part)
    text = wrappers.main_text(wrappers.Page(pages[3]), lambda path: whole.is_content(path, whole.region()))
    assert "Story 3 of the day" in text and "end" not in text


def test_long_and_broken_pages_are_linear():
    for source in ("<a " * 50_000, "<p>" * 20_000, '<div class="' * 20_000, "<p>x</p>" * 20_000, "<" * 100_000):
        wrappers.Wrapper.of(wrappers.Page(source)).pattern()


def _texts(spark, sources, url="http://one.example/"):
    rows = [(i, url and f"{url}{i}", s) for i, s in enumerate(sources)]
    got = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    return {r.page_id: r for r in got}


def test_a_template_paragraph_on_the_path_of_the_article_is_left_out(spark):
    # the notice shares its path with the varying paragraphs; only its aligned slot never varies
    pages = [f"<body><article><h1>Title {i}</h1><p>Story {i} one</p><p>Story {i} two</p><hr><p>Read our notice</p></article></body>" for i in range(8)]
    got = _texts(spark, pages)
    for i in range(8):
        assert got[i].conforms and got[i].text == f"Title {i}\nStory {i} one\nStory {i} two"


def test_streams_of_any_length_are_aligned_whole():
    marks = [f"<p.{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}{'efghijklmn'[i // 1000]}>" for i in range(4000)]
    source = lambda word, drop: "".join(f"<p class='{m[3:-1]}'>{word if n % 2 else 'same'} {n}</p>" for n, m in enumerate(marks) if n != drop)
    whole = None
    for word, drop in (("red", None), ("blue", 3000), ("green", None)):
        part = wrappers.Wrapper.of(wrappers.Page(source(word, drop)))
        whole = part if whole is None else whole.merge(part)
    assert len(whole.parts) == 12000 and [x for x, missing in whole.parts if missing and x[0] == "<" and x != "</p>"] == [marks[3000]]
    natures = whole.settled().matcher()(wrappers.Page(source("white", 3000)).items)
    assert natures == [0 if n % 2 else wrappers.FIXED for n in range(4000) if n != 3000]
    # repetitive streams without a shared run: in order, equal, and in good time
    a, b = ["<p>", "#", "</p>", "<hr>"] * 3000, ["<hr>", "<p>", "#", "</p>"] * 2500
    blocks = wrappers.align(a, b)
    assert all(a[i:j] == b[k:m] for i, j, k, m in blocks) and sum(j - i for i, j, _, _ in blocks) > 9000


def test_every_page_has_its_own_region(spark):
    for url in ("http://one.example/", None):
        pages = []
        for i in range(12):
            words = f"Story {i} of the day"
            inside = (f"<article><p>{words}</p></article>", f"<main><p>{words}</p></main>", f"<div class=story><p>{words}</p></div>", "<div><article></article><p>Not this</p></div>")[i % 4]
            pages.append(f"<body><nav>menu</nav>{inside}<footer>end</footer></body>")
        got = _texts(spark, pages, url)
        assert [got[i].text for i in range(12)] == ["" if i % 4 == 3 else f"Story {i} of the day" for i in range(12)]


def test_attribute_values_of_any_length():
    for quote in "\"'":
        for size in (1000, 1024, 1025, 70_000, 300_000):
            value = ("<p>x</p> >" * size)[:size]
            source = f"<article><div data-x={quote}{value}{quote}><p>before <img src={quote}{value}{quote} alt=x>after</p></div></article>"
            page = wrappers.Page(source)
            assert page.items == ["<article>", "<div>", "<p>", "#", "</p>", "</div>", "</article>"]
            assert page.slots == [("article/div/p", ["before ", "after"], 0)]
    assert wrappers.Page(f"<p>a <b x=\"{'y' * 70_000} > c").slots[0][0] == "p"  # no closing quote: plain text
    for source in ("<a \"<" * 40_000, "<a 'x' \"" * 40_001, "<a '<b \"' <c \"" * 30_000, "<a" + "\"'" * 50_000, f"<a {'x' * 2000}\"" * 501):
        wrappers.Page(source)


def test_template_is_told_by_different_pages_not_rows_and_at_any_length(spark):
    notice = "This notice is the same on every page. " * 30
    page = lambda words: f"<body><div><section><p>{notice}</p></section><h1>{words}</h1></div></body>"
    got = _texts(spark, [page(f"Story {i}") for i in range(6)])
    assert [got[i].text for i in range(6)] == [f"Story {i}" for i in range(6)]
    for copies in (1, 2, 6):  # copies of one page say nothing about its template
        got = _texts(spark, [page("Story") + f"<script>track({i})</script>" for i in range(copies)])
        assert [got[i].text for i in range(copies)] == [f"{notice.strip()}\nStory"] * copies
    # the same by paths alone, for pages that do not match
    whole = None
    for i in range(6):
        part = wrappers.Wrapper.of(wrappers.Page(page(f"Story {i}")))
        whole = part if whole is None else whole.merge(part).merge(part)
    assert [whole.is_content(f"body/div/{x}", None) for x in ("section/p", "h1", "unknown")] == [False, True, True]
    one = wrappers.Wrapper.of(wrappers.Page(page("Story")))
    assert all(one.merge(one).merge(one).is_content(f"body/div/{x}", None) for x in ("section/p", "h1"))


def test_article_parts_named_after_their_subject_stay(spark):
    def page(i):
        article = f'<h1>Title {i}</h1><h2 id="related-work">Work near {i}</h2><section class="search-methods"><p>Methods {i}</p></section>'
        article += f'<div class="social-history"><p>History {i}</p></div><div class="article-header"><p>By {i}</p></div>'
        article += f'<div class="related">See {i}</div><div class="share-bar">Share {i}</div><div id="comment-list-2"><p>First {i}</p></div>'
        return f'<body><div class="site-header">Site {i}</div><article>{article}</article><div class="cookie-notice">Cookies {i}</div></body>'

    got = _texts(spark, [page(i) for i in range(4)])
    for i in range(4):
        assert got[i].text == "\n".join(f"{x} {i}" for x in ("Title", "Work near", "Methods", "History", "By"))
