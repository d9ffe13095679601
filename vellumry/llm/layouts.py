"""Labelled pages made from a rule, on which the text classifier of htmlcut is fitted.

A page is an article among what surrounds articles: menus, headers, footers, sidebars, notices, adverts, forms,
lists of related pages and reader comments, around it and within it, in several ways of marking up. Words of an
article begin with CONTENT, all others with OTHER, so each block of text tells its own label; no feature reads words.
"""

from __future__ import annotations

import random
import re

CONTENT, OTHER = "c", "x"


def _words(r: random.Random, mark: str, n: int, end: str = "") -> str:
    return " ".join(mark + "".join(r.choices("aeioulnrst", k=r.randint(1, 8))) for _ in range(n)) + end


def _size(r: random.Random, article: bool = False) -> int:
    """Words of a piece: what surrounds articles is mostly short, paragraphs of articles mostly aren't."""
    return r.choice([2, 5, 10, 18, 25, 35, 50, 70, 110] if article else [1, 2, 3, 4, 6, 8, 12, 20, 60, 60])


def _links(r: random.Random, mark: str, n: int, tag: str = "li") -> str:
    return "".join(f'<{tag}><a href="/{k}">{_words(r, mark, r.randint(1, 6))}</a></{tag}>' for k in range(n))


def _chrome(r: random.Random) -> str:
    """One piece of what isn't the article."""
    kind = r.randrange(16)
    w = lambda n, end=".": _words(r, OTHER, n, end)
    if kind == 0:
        return f"<nav><ul>{_links(r, OTHER, r.randint(2, 8))}</ul></nav>"
    if kind == 1:
        return f"<div class=\"{r.choice(['ad', 'advert', 'banner', 'sponsored', 'promo'])}\"><p>{w(_size(r))}</p></div>"
    if kind == 2:
        inner = "".join(f"<p>{w(_size(r))}</p>" for _ in range(r.randint(1, 4)))
        return f"<{r.choice(['div', 'section'])} class=\"{r.choice(['comments', 'comment', 'disqus', 'post-comments'])}\"><h3>{w(2, '')}</h3>{inner}</div>"
    if kind == 3:
        return f"<aside><h3>{w(2, '')}</h3><ul>{_links(r, OTHER, r.randint(2, 6))}</ul><p>{w(_size(r))}</p></aside>"
    if kind == 4:
        return f"<div id=\"{r.choice(['sidebar', 'cookie', 'newsletter', 'related', 'notice', 'share'])}\">{r.choice(['<p>{}</p>', '{}', '<div><span>{}</span></div>']).format(w(_size(r)))}</div>"
    if kind == 5:
        return f"<form><label>{w(3, '')}</label><p>{w(_size(r))}</p></form>"
    if kind == 6:
        return f"<div class=\"{r.choice(['related', 'recommended', 'more', 'links'])}\"><ul>{_links(r, OTHER, r.randint(3, 9))}</ul></div>"
    if kind == 7:
        return f"<div>{_links(r, OTHER, r.randint(2, 6), 'span')}</div>"
    if kind < 11:  # names that tell nothing: a group of links with lines between them that aren't linked
        tag = r.choice(["p", "p", "p", "div", "li"])
        parts = [f"<{tag}>{w(r.randint(1, 8), r.choice(['.', ':', '']))}</{tag}>" if r.random() < 0.3 else f'<{tag}><a href="/n">{w(r.randint(1, 6), "")}</a></{tag}>' for _ in range(r.randint(4, 10))]
        return f"<div class=\"b{r.randrange(99)}\">{''.join(parts)}</div>"
    inner = "".join(f"<{x}>{w(_size(r))}</{x}>" for x in r.choices(["p", "p", "h3", "div"], k=r.randint(1, 3)))
    if kind == 12:
        tag = r.choice(["footer", "aside", "form", "dialog"])
        return f"<{tag}>{inner}</{tag}>"
    if kind == 13:  # articles and bodies beneath chrome
        outer = r.choice(['<section id="comments">', '<div class="comments">', '<div class="sidebar">', '<section class="related">', "<aside>", "<footer>"])
        return outer + r.choice(["<article>{}</article>", '<div class="post">{}</div>', '<div class="content">{}</div>', "<main>{}</main>"]).format(inner) + f"</{re.match('<([a-z]+)', outer)[1]}>"
    if kind == 14:
        return f"<header><h2>{w(2, '')}</h2>{inner}</header>" if r.random() < 0.5 else f"<form>{inner}</form>"
    return f"<footer><p>{w(_size(r))}</p></footer>"


def _piece(r: random.Random) -> str:
    """One piece of the article."""
    w = lambda n, end="": _words(r, CONTENT, n, end)
    kind = r.randrange(15)
    if kind > 11:  # lines of an article that are links and nothing else
        links = [f'<a href="/s">{w(r.randint(1, 6))}</a>' for _ in range(r.randint(1, 3))]
        return "".join(f"<p>{x}</p>" for x in links) if kind < 14 else "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>"
    if kind < 6:
        inline = f' <a href="/q">{w(r.randint(1, 3))}</a>' if r.random() < 0.3 else ""
        return f"<p>{w(_size(r, True))}{inline}{r.choice(['.', '.', '!', '', ':'])}</p>"
    if kind == 6:
        return f"<h2>{w(r.randint(1, 6))}</h2>"
    if kind == 7:
        return "<ul>" + "".join(f"<li>{w(_size(r, True))}</li>" for _ in range(r.randint(1, 5))) + "</ul>"
    if kind == 8:
        return f"<blockquote>{w(_size(r, True), '.')}</blockquote>"
    if kind == 9:
        return "<table>" + "".join("<tr>" + "".join(f"<td>{w(r.randint(1, 4))}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>"
    if kind == 10:
        return f"<div class=\"{r.choice(['side-by-side', 'legal-form', 'row', 'note-text', 'col'])}\"><p>{w(_size(r, True), '.')}</p></div>"
    return f"<div>{w(_size(r, True), '.')}</div>"


def page(r: random.Random) -> str:
    before = "".join(_chrome(r) for _ in range(r.randint(0, 4)))
    after = "".join(_chrome(r) for _ in range(r.randint(0, 4)))
    body = [f"<h1>{_words(r, CONTENT, r.randint(1, 9))}</h1>"] if r.random() < 0.8 else []
    for _ in range(r.randint(1, 14)):
        body.append(_piece(r))
        if r.random() < 0.1 and not (piece := _chrome(r)).startswith("<header"):
            body.append(piece)
    start, end = r.choice(
        [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="entry-content">', "</div>"), ('<div id="story">', "</div>"), ("<div>", "</div>"), ("<main><article>", "</article></main>"), ('<div class="page"><div>', "</div></div>"), ("", ""), ('<div class="has-sidebar"><div class="entry-content">', "</div></div>"), ('<div class="legal">', "</div>")]
    )
    return f"<html><body>{before}{start}{''.join(body)}{end}{after}</body></html>"


def pages(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    return [page(r) for _ in range(n)]
