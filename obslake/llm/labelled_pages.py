"""Small labelled pages: ``data-content`` says what is the article (1) and what is not (0).

They teach the model what a given sample of pages may lack: pages without <article>, with
comments, side columns, notices and adverts. The words are place holders; only tags, names,
lengths and links of blocks are learned.
"""

from __future__ import annotations

_LONG = "Some words of a sentence that goes on for a while, as in an article; then it ends. " * 4
_MEDIUM = "A sentence of the article that is not long, but has an end. "
_LINKS = "".join(f'<li><a href="/{k}">Section {k}</a></li>' for k in range(6))
_SHORT = "Words here"


def _page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>Title</title></head><body>{body}</body></html>"


def _article(tag: str, names: str = "") -> str:
    paragraphs = f"<h1>Title of it</h1><p>{_LONG}</p><h2>Part</h2><p>{_MEDIUM}</p><ul><li>{_MEDIUM}</li><li>{_SHORT}</li></ul><ol><li>{_SHORT}</li><li>{_LONG}</li></ol><dl><dt>{_SHORT}</dt><dd>{_MEDIUM}</dd></dl><h3>{_SHORT}</h3><p>{_SHORT}</p>"
    paragraphs += f"<blockquote>{_MEDIUM}</blockquote><pre>{_SHORT}</pre><p>{_SHORT}</p><table><tr><td>{_SHORT}</td></tr></table><p>{_LONG}</p>"
    return f'<{tag} {names} data-content="1">{paragraphs}</{tag}>'


_MENUS = (
    f'<nav data-content="0"><ul>{_LINKS}</ul></nav>',
    f'<div class="menu" data-content="0"><ul>{_LINKS}</ul></div>',
    f'<header data-content="0"><div>{_SHORT}</div><p>{_MEDIUM}</p><ul>{_LINKS}</ul></header>',
    f'<header class="top" data-content="0"><h1>{_SHORT}</h1><nav><ul>{_LINKS}</ul></nav></header>',
    f'<div id="header" data-content="0"><h1>{_SHORT}</h1><p>{_MEDIUM}</p></div>',
    f'<div class="breadcrumb" data-content="0"><a href="/">Home</a> &gt; <a href="/a">A</a></div>',
)
_ENDS = (
    f'<footer data-content="0"><p>&copy; {_SHORT}. {_MEDIUM}</p></footer>',
    f'<div class="footer" data-content="0"><p>{_MEDIUM}</p><ul>{_LINKS}</ul></div>',
    f'<div id="copyright" data-content="0">{_SHORT}</div>',
)
_SIDES = (
    f'<aside data-content="0"><h3>{_SHORT}</h3><p>{_MEDIUM}</p><ul>{_LINKS}</ul></aside>',
    f'<div class="sidebar" data-content="0"><h3>{_SHORT}</h3><p>{_LONG}</p></div>',
    f'<div class="ad" data-content="0">{_MEDIUM}</div>',
    f'<div class="advert banner" data-content="0"><p>{_LONG}</p></div>',
    f'<div class="cookie notice" data-content="0"><p>{_LONG}</p></div>',
    f'<section class="comments" data-content="0"><h3>Comments</h3><div class="comment"><p>{_LONG}</p></div><div class="comment"><p>{_MEDIUM}</p></div></section>',
    f'<ol class="comment-list" data-content="0"><li><p>{_LONG}</p></li><li><p>{_MEDIUM}</p></li></ol>',
    f'<div class="related" data-content="0"><h3>{_SHORT}</h3><ul>{_LINKS}</ul></div>',
    f'<div class="share social" data-content="0"><a href="/s">Share</a> <a href="/t">Post</a></div>',
    f'<div class="newsletter subscribe" data-content="0"><p>{_MEDIUM}</p></div>',
)
_BODIES = (
    _article("article"),
    _article("main"),
    _article("div", 'class="content"'),
    _article("div", 'id="main-content"'),
    _article("div", 'class="post-body"'),
    _article("section"),
    _article("div"),
)


def labelled_pages() -> list[str]:
    """Every kind of article with every kind of menu, end and side part, in turn."""
    pages = []
    for k, article in enumerate(_BODIES):
        for j, side in enumerate(_SIDES):
            menu, end = _MENUS[(k + j) % len(_MENUS)], _ENDS[(k + j) % len(_ENDS)]
            inside = article.replace("<h2>", side + "<h2>", 1) if (k + j) % 2 else article
            pages.append(_page(menu + (side if (k + j) % 2 == 0 else "") + inside + end))
            pages.append(_page(menu + f'<div class="wrapper">{article}{side}</div>' + end))
    return pages
