"""What HTML and names seal, pages of one block, and inputs that a backtracking reader would take long for."""

import time

import pytest

from vellumry.llm import htmlcut


def words(of, n=60):
    return " ".join(f"{of}{k}" for k in range(n)) + "."


P = f"<p>{words('one')}</p><p>{words('two')}</p>"
TEXT = f"{words('one')}\n{words('two')}"


@pytest.mark.parametrize("n", [5, 20, 60])
@pytest.mark.parametrize(
    "chrome",
    ["<aside>{}</aside>", "<form>{}</form>", "<footer>{}</footer>", "<aside><article>{}</article></aside>", '<section id="comments"><article>{}</article></section>', '<div class="comments"><div class="post">{}</div></div>',
     '<div class="sidebar"><div class="content">{}</div></div>', '<section class="related"><article>{}</article></section>', "<nav><main>{}</main></nav>", '<div class="post-comments"><div class="text">{}</div></div>',
     '<article class="comment">{}</article>', '<ol class="commentlist"><li><article id="comment-17">{}</article></li></ol>', '<div class="cookie notice">{}</div>', "<dialog>{}</dialog>", '<div role="contentinfo">{}</div>'],
)
def test_named_chrome_is_never_content(chrome, n):
    piece = chrome.format(f"<h3>a heading</h3><p>{words('cut', n)}</p><p>{words('cut', n)}</p>")
    for outer in ("<article>{}</article>", "<main><h1>One title of it</h1>{}</main>", '<div class="entry-content">{}</div>', "<div>{}</div>"):
        title = "One title of it\n" if "h1" in outer else ""
        for page in (outer.format(P + piece), piece + outer.format(P), outer.format(P) + piece, outer.format(f"<p>{words('one')}</p>{piece}<p>{words('two')}</p>")):
            assert htmlcut.extract(f"<html><body>{page}</body></html>") == title + TEXT, page


@pytest.mark.parametrize("n", [5, 20, 60])
def test_page_header_goes_and_the_articles_own_stays(n):
    assert htmlcut.extract(f"<body><header><h2>Site</h2><p>{words('cut', n)}</p></header><article>{P}</article></body>") == TEXT
    assert htmlcut.extract(f"<body><article><header><h1>A title of words</h1></header>{P}</article></body>") == "A title of words\n" + TEXT


@pytest.mark.parametrize(
    "page, want",
    [
        (f'<article class="legal">{P}</article>', TEXT), (f'<article id="comment-theory">{P}</article>', TEXT), (f'<div class="legal">{P}</div>', TEXT), (f'<div class="social-science">{P}</div>', TEXT),
        ("<div>hello world text.</div>", "hello world text."), ("plain text of a page", "plain text of a page"), ("<body>One sentence of a page.</body>", "One sentence of a page."), ("<a href=/x>link</a>", "link"),
        (f"<body><nav><a href=/>Home</a></nav><form id=aspnet><div>{P}</div></form><footer>f</footer></body>", TEXT), ("<nav><a href=/>Home</a></nav>", ""), ("<p></p>", ""), ("<h1>x</h1>", "x"),
        ("<li>a</li>", "a"), ('<div class="has-sidebar"><div class="content">' + P + "</div></div>", TEXT), ("a < b and c <3 d", "a < b and c <3 d"), ("text <b", "text"), ("text <!-- never", "text"), ("text <a href='x", "text"),
        ('<p>He said <a title="5" wide" href=x>so</a> then.</p>', "He said so then."), ("<p>a <span hidden>secret</span>b</p>", "a b"), ("<p>words <span class=comment>within</p><p>more</p>", "words within\nmore"),
    ],
)
def test_pages_of_little_text(page, want):
    assert htmlcut.extract(page) == want


@pytest.mark.parametrize(
    "make",
    [lambda n: "<a" * n, lambda n: '<a b="' * n, lambda n: "<article><select>" * n, lambda n: "<p><object>" * n + "</object>", lambda n: "<!" * n, lambda n: "<!--" * n, lambda n: "</" * n, lambda n: "<p><li>" + "<b>" * n + "<div></div>" * n,
     lambda n: "<a " + "=" * n + " />", lambda n: "<svg><g>" * n + "<p>x", lambda n: "<button>" * n, lambda n: "<p>" + "<b>" * n + "</i>" * n, lambda n: "<p>x" + " <svg><path d='M0'>" * n, lambda n: "<a " + " " * n + "'" * n, lambda n: "<script>" * n,
     lambda n: "<div class='" + "ad-" * n + "'>x"],
)
def test_hostile_pages_take_linear_time(make):
    htmlcut.extract("<p>x</p>")

    def took(n):
        page = make(n)
        best = 1e9
        for _ in range(4):
            t = time.process_time()
            htmlcut.extract(page)
            best = min(best, time.process_time() - t)
        return best

    assert took(40_000) < 2.5 * took(20_000) + 0.1


def test_a_hostile_megabyte_ends_soon():
    for piece in ("<a", '<a b="', "<article><select>", "<p><object>", "<div><!"):
        t = time.perf_counter()
        htmlcut.extract(piece * (1_000_000 // len(piece)))
        assert time.perf_counter() - t < 20
