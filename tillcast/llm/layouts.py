"""Labelled pages to learn extraction from: articles of made-up words in varied layouts.

The words say nothing; layouts, element names, attribute words and amounts of text do. A page is made
from its number alone, so every run learns from the same pages.
"""

from __future__ import annotations

import random
from html import escape

MARK = "\u2063"  # in front of every run of main text; taken out before anything is measured

WRAPPERS = (
    ("<article>", "</article>"),
    ("<main>", "</main>"),
    ('<main id="content"><article class="post">', "</article></main>"),
    ('<div class="post-content">', "</div>"),
    ('<div id="content" class="content">', "</div>"),
    ('<div class="entry-content" itemprop="articleBody">', "</div>"),
    ('<section class="story-body">', "</section>"),
    ('<div id="main"><div class="article-text">', "</div></div>"),
    ('<div role="main">', "</div>"),
    ('<div class="container"><div class="row"><div class="col-8">', "</div></div></div>"),
    ("<div>", "</div>"),
    ("<article><section>", "</section></article>"),
    ("", ""),
)
MENUS = (
    ("<nav>", "</nav>"),
    ('<div class="menu">', "</div>"),
    ('<ul class="nav navbar">', "</ul>"),
    ('<div id="navigation" role="navigation">', "</div>"),
    ('<div class="breadcrumbs">', "</div>"),
    ('<div class="pagination">', "</div>"),
)
SIDES = (
    ("<aside>", "</aside>"),
    ('<div class="sidebar">', "</div>"),
    ('<div id="sidebar" class="widget">', "</div>"),
    ('<section class="related-posts">', "</section>"),
    ('<div class="recommended">', "</div>"),
    ('<aside class="popular">', "</aside>"),
)
ADVERTS = (
    ('<div class="ad">', "</div>"),
    ('<div class="ads banner">', "</div>"),
    ('<div id="ad-slot-1" class="advertisement">', "</div>"),
    ('<aside class="sponsored">', "</aside>"),
    ('<div class="promo">', "</div>"),
    ('<p class="advert">', "</p>"),
    ('<section class="partner-content promoted">', "</section>"),
)
NOTICES = (
    ('<div class="cookie-notice">', "</div>"),
    ('<div id="cookie-banner" role="dialog">', "</div>"),
    ('<div class="notice">', "</div>"),
    ('<div class="newsletter-signup">', "</div>"),
    ('<div class="alert" role="alert">', "</div>"),
    ('<section class="subscribe popup">', "</section>"),
    ('<p class="disclaimer">', "</p>"),
    ("<dialog>", "</dialog>"),
)
COMMENTS = (
    ('<div id="comments">', "</div>"),
    ('<section class="comments">', "</section>"),
    ('<ol class="comment-list">', "</ol>"),
    ('<div class="disqus-thread discussion">', "</div>"),
    ('<section id="responses" class="reader-comments">', "</section>"),
)
FOOTERS = (
    ("<footer>", "</footer>"),
    ('<div class="footer">', "</div>"),
    ('<div id="footer" class="copyright">', "</div>"),
    ('<footer class="site-footer" role="contentinfo">', "</footer>"),
)
HEADERS = (
    ("<header>", "</header>"),
    ('<div id="header" class="masthead">', "</div>"),
    ('<header class="site-header" role="banner">', "</header>"),
)


class Page:
    """One page under construction; ``r`` decides everything."""

    def __init__(self, number: int):
        self.r = random.Random(number)
        self.syllables = [
            "".join(self.r.choice("abcdefghijklmnoprstuvwzéäüñ") for _ in range(self.r.randint(1, 4)))
            for _ in range(60)
        ]

    def words(self, n: int) -> str:
        return " ".join(
            "".join(self.r.choices(self.syllables, k=self.r.randint(1, 4))) for _ in range(n)
        )

    def sentences(self, n: int) -> str:
        made = []
        for _ in range(n):
            text = self.words(self.r.choice((1, 2, 4, 7, 12, 18, 25)))
            text = text.replace(" ", ", ", 1) if self.r.random() < 0.3 else text
            end = self.r.choice(("", "", "!", "!!", "***", "%%%")) if self.r.random() < 0.1 else "."
            made.append(text.capitalize() + end)
        return escape(" ".join(made))

    def link(self, n: int = 2) -> str:
        return f'<a href="/{self.words(1)}">{self.words(self.r.randint(1, n))}</a>'

    def among(self, choices):
        return self.r.choice(choices)

    def length(self) -> int:
        return self.r.choice((1, 1, 2, 3, 5, 8, 14))

    def main_blocks(self) -> list[str]:
        r, blocks = self.r, []
        if r.random() < 0.85:
            level = r.choice((1, 1, 1, 2))
            blocks.append(f"<h{level}>{MARK}{self.words(r.randint(1, 12))}</h{level}>")
        for _ in range(r.choice((1, 2, 3, 4, 6, 9, 14, 25))):
            kind = r.random()
            text = self.sentences(self.length())
            if kind < 0.62:
                end = "" if r.random() < 0.15 else "</p>"
                mark = r.random()
                if mark < 0.1:
                    text = f"<b>{MARK}{text}<br>"
                elif mark < 0.2:
                    text = f"{MARK}{text} {self.link(4)} {self.sentences(1)}"
                elif mark < 0.25:
                    text = f"<em>{MARK}{self.words(3)}</em> {text}"
                else:
                    text = MARK + text
                blocks.append(f"<p>{text}{end}")
            elif kind < 0.7:
                items = "".join(f"<li>{MARK}{self.sentences(1)}</li>" for _ in range(r.randint(2, 6)))
                blocks.append(f"<ul>{items}</ul>")
            elif kind < 0.78:
                level = r.choice((2, 3))
                blocks.append(f"<h{level}>{MARK}{self.words(r.randint(1, 8))}</h{level}>")
            elif kind < 0.84:
                blocks.append(f"<blockquote>{MARK}{text}</blockquote>")
            elif kind < 0.88:
                cells = "".join(
                    "<tr>" + "".join(f"<td>{MARK}{self.words(2)}</td>" for _ in range(2)) + "</tr>"
                    for _ in range(r.randint(2, 4))
                )
                blocks.append(f"<table>{cells}</table>")
            elif kind < 0.94:
                blocks.append(f"<div>{MARK}{text}</div>")
            else:
                blocks.append(f"<pre>{MARK}{text}</pre>")
        return blocks

    def menu(self) -> str:
        a, b = self.among(MENUS)
        said = self.among((lambda: self.words(self.r.randint(1, 3)), lambda: self.sentences(1)))
        linked = self.r.random() < 0.85
        items = [
            f'<a href="/{self.words(1)}">{said()}</a>' if linked else said()
            for _ in range(self.r.randint(1, 9))
        ]
        if a.startswith("<ul"):
            return a + "".join(f"<li>{i}</li>" for i in items) + b
        if self.r.random() < 0.6:
            return a + "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" + b
        return a + self.among((" | ", " ", " › ")).join(items) + b

    def side(self) -> str:
        a, b = self.among(SIDES)
        title = self.among(("", f"<h3>{self.words(2)}</h3>", f"<h2>{self.words(1)}</h2>"))
        if self.r.random() < 0.6:
            body = "<ul>" + "".join(f"<li>{self.link(8)}</li>" for _ in range(self.r.randint(2, 7))) + "</ul>"
        else:
            body = "".join(f"<p>{self.sentences(self.length())}</p>" for _ in range(self.r.randint(1, 3)))
        return a + title + body + b

    def boxed(self, choices) -> str:
        a, b = self.among(choices)
        text = self.sentences(self.length())
        if a.startswith("<p") or self.r.random() < 0.5:
            return a + text + b
        more = self.among(("", self.link(), "<button>ok</button>", f"<h3>{self.words(2)}</h3>"))
        return f"{a}<p>{text}</p>{more}{b}"

    def form(self) -> str:
        label = self.among(("", f"<label>{self.words(2)}</label>", f"<p>{self.sentences(1)}</p>"))
        a, b = self.among((("<form>", "</form>"), ('<form class="search">', "</form>"), ('<div class="login-form"><form>', "</form></div>")))
        return f'{a}{label}<input name="q">{self.words(1)}<button>{self.words(1)}</button>{b}'

    def comments(self) -> str:
        a, b = self.among(COMMENTS)
        item = self.among((("<li>", "</li>"), ('<div class="comment">', "</div>"), ("<article>", "</article>"), ("<p>", "</p>")))
        made = []
        for _ in range(self.r.randint(1, 8)):
            who = "" if item[0] == "<p>" else self.among(("", f"<b>{self.words(1)}</b>", f'<span class="author">{self.words(2)}</span>', f"<h4>{self.words(2)}</h4>"))
            text = self.sentences(self.length())
            text = text if item[0] == "<p>" or self.r.random() < 0.4 else f"<p>{text}</p>"
            made.append(item[0] + who + text + item[1])
        title = self.among(("", f"<h2>{self.words(2)}</h2>", f"<h3>{self.words(1)} (3)</h3>"))
        return a + title + "".join(made) + b

    def footer(self) -> str:
        a, b = self.among(FOOTERS)
        text = self.among(("&copy; ", "© 2024 ", "")) + self.words(2)
        said = self.sentences(self.length())
        more = self.among(("", f" &middot; {said}", f"<p>{said}</p>", " " + self.link()))
        if self.r.random() < 0.2:
            text, more = "", f"<p>{said}</p><p>{self.sentences(self.length())}</p>"
        return a + text + more + b

    def header(self) -> str:
        a, b = self.among(HEADERS)
        inner = self.among((self.words(2), f"<h1>{self.words(2)}</h1>", f"<p>{self.sentences(1)}</p>", self.menu(), f'<a href="/">{self.words(2)}</a>'))
        return a + inner + b

    def share(self) -> str:
        a = self.among(('<div class="share">', '<ul class="social-links">', '<div class="byline meta">', '<p class="tags">'))
        body = "".join(self.link(1) for _ in range(self.r.randint(1, 5))) if self.r.random() < 0.7 else self.words(4)
        return a + body + f"</{a[1:].split(' ')[0]}>"

    def made(self) -> str:
        r = self.r
        blocks = self.main_blocks()
        extras = [self.share, lambda: self.boxed(ADVERTS), self.side, lambda: self.boxed(NOTICES), self.form]
        for _ in range(r.choice((0, 0, 0, 1, 2))):
            blocks.insert(r.randint(1, len(blocks)), r.choice(extras)())
        a, b = self.among(WRAPPERS)
        if r.random() < 0.15:
            blocks.append(self.comments())
        if r.random() < 0.15 and a.startswith("<article"):
            blocks.insert(0, f"<header>{blocks.pop(0)}{self.share()}</header>")
        main = a + "".join(blocks) + b
        before, after = [], []
        for chance, make in ((0.4, self.header), (0.75, self.menu), (0.3, lambda: self.boxed(NOTICES)), (0.5, lambda: self.boxed(ADVERTS)), (0.25, self.side), (0.1, self.form)):
            if r.random() < chance:
                before.append(make())
        if r.random() < 0.3:
            r.shuffle(before)
        for chance, make in ((0.2, self.share), (0.35, self.comments), (0.3, self.side), (0.3, lambda: self.boxed(ADVERTS)), (0.15, lambda: self.boxed(NOTICES)), (0.15, self.form), (0.2, self.menu), (0.8, self.footer)):
            if r.random() < chance:
                after.append(make())
        body = "".join(before) + main + "".join(after)
        if r.random() < 0.3:
            body = f'<div class="{self.among(("page", "wrapper", "site", "container"))}">{body}</div>'
        title = f"<head><title>{self.words(4)}</title><style>p{{margin:0}}</style></head>"
        end = "</body></html>" if r.random() < 0.9 else ""
        return f"<!DOCTYPE html><html>{title}<body>{body}{end}"
