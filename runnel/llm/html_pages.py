"""Labelled pages to learn extraction from: built from parts whose kind is known.

Layouts, wrappers, class names and texts are drawn at random. Texts of articles and of everything else are drawn
alike, long and short, so that a text alone seldom tells its kind; what surrounds it does.
"""

from __future__ import annotations

import random

# Names that pages give to what is no article, and to articles.
OTHER = {
    "nav": "nav menu navbar navigation topnav mainmenu breadcrumb breadcrumbs pagination pager toc tabs skip".split(),
    "header": "header masthead topbar banner site branding logo".split(),
    "footer": "footer bottom copyright colophon legal credits".split(),
    "aside": "sidebar aside widget rail related recommended trending popular more tags share social author bio".split(),
    "ad": "ad ads adv advert adverts advertisement sponsor sponsored promo promotion banner adsense dfp taboola outbrain".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay paywall warning message announcement privacy toast".split(),
    "comments": "comments comment commentlist replies reply discussion disqus respond feedback thread".split(),
    "form": "form newsletter subscribe signup login search contact register".split(),
}
ARTICLE = "content article post entry story main body text page primary hentry blog prose copy detail".split()
SHORT = (
    "Home;About;Contact;News;Sports;Login;Sign up;Subscribe;Privacy policy;Terms of use;Read more;Next;Previous;Share;Menu;Search;"
    "All rights reserved;Accept cookies;We use cookies to improve this site;Follow us;Advertisement;Sponsored;Leave a reply;Comments;"
    "Related articles;Most read;Sign in to comment;Back to top;Sitemap;Help;Archive;Tags"
).split(";")
SYLLABLES = "an be ci do en er fa ge ho in ka le mo nu or pa qui re sta the ti un ver wa xi yo zu ée ña öl ß ció eau".split()


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices(SYLLABLES, k=self.r.choice((1, 1, 2, 2, 3, 4)))) + self.r.choice(("",) * 18 + (",", "***"))

    def sentence(self, most: int = 18) -> str:
        words = [self.word() for _ in range(self.r.randint(1, most))]
        return " ".join(words).capitalize() + self.r.choice((".", ".", ".", "?", "!", ""))

    def text(self) -> str:
        kind = self.r.random()
        if kind < 0.06:
            return self.r.choice(SHORT) + self.r.choice(("", "."))
        if kind < 0.2:
            return self.sentence(4)
        return " ".join(self.sentence() for _ in range(1 if kind < 0.45 else self.r.randint(1, 9)))

    def mark(self, name: str, classes: list[str], inner: str) -> str:
        r = self.r
        shown = r.sample(classes, r.choice((1, 1, 1, 2)))
        label = r.choice(("-", "_", " ")).join(shown)
        if r.random() < 0.2:
            label = r.choice(("site", "js", "l", "block", "c", "wrap", "box")) + r.choice(("-", "__")) + label
        key = r.choice(("class", "class", "class", "id"))
        return f'<{name} {key}="{label}">{inner}</{name}>'

    def other(self, kind: str) -> str:
        """Something that is no article."""
        r = self.r
        items = [r.choice(SHORT) if r.random() < 0.4 else self.sentence(3) if r.random() < 0.6 else self.text() for _ in range(r.randint(1, 6))]
        shape = r.random()
        if kind == "comments":
            rows = "".join(f"<{(t := r.choice(('div', 'li', 'article', 'p')))}><p>{self.text()}</p></{t}>" for _ in range(r.randint(1, 5)))
            inner = f"<h3>{r.choice(SHORT)}</h3>{rows}"
        elif kind == "form":
            inner = f"<label>{self.sentence(3)}</label><input type=text><button>{r.choice(SHORT)}</button><p>{self.text()}</p>"
        elif shape < 0.35 or kind == "nav" and shape < 0.8:
            inner = "<ul>" + "".join(f'<li><a href="/x">{i}</a></li>' for i in items) + "</ul>"
        elif shape < 0.6:
            inner = "".join(f"<p>{i}</p>" for i in items)
        elif shape < 0.75:
            inner = " ".join(f'<a href="/y">{i}</a>' for i in items)
        elif shape < 0.85:
            inner = f"<h3>{items[0]}</h3>" + "".join(f"<div>{i}</div>" for i in items[1:])
        else:
            inner = self.text()
        semantic = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
        if semantic and r.random() < 0.4:
            return f"<{semantic}>{inner}</{semantic}>" if r.random() < 0.5 else self.mark(semantic, OTHER[kind], inner)
        wrapper = "form" if kind == "form" and r.random() < 0.7 else r.choice(("div", "div", "div", "section", "aside", "ul"))
        if wrapper == "ul":
            inner = f"<li>{inner}</li>"
        return self.mark(wrapper, OTHER[kind], inner)

    def body(self) -> list[str]:
        """The parts of an article."""
        r = self.r
        out = [f"<h1>{self.sentence(10)}</h1>"]
        if r.random() < 0.15:
            out[0] = f"<header>{out[0]}</header>"
        if r.random() < 0.2:
            out = []
        for _ in range(r.choice((1, 1, 2, 3, 4, 5, 6, 7, 8, 9))):
            k = r.random()
            if k < 0.05:
                out.append(f"<div>{self.text()}</div>")
            elif k < 0.1:
                out.append(f"{self.text()}<br>")
            elif k < 0.74:
                link = f' <a href="/z">{self.sentence(3)}</a> {self.sentence(6)}' if r.random() < 0.1 else ""
                out.append(f"<p>{r.choice(('', '', '', '<b>', '<em>'))}{self.text()}{link}" + r.choice(("</p>", "</p>", "</p>", "<br>")))
            elif k < 0.82:
                out.append(f"<h2>{self.sentence(6)}</h2>")
            elif k < 0.9:
                out.append("<ul>" + "".join(f"<li>{self.text()}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif k < 0.93:
                out.append(f"<blockquote>{self.text()}</blockquote>")
            elif k < 0.95:
                out.append(f"<figure><figcaption>{self.text()}</figcaption></figure>")
            elif k < 0.97:
                out.append(f"<table><tr><td>{self.sentence(3)}</td><td>{self.sentence(3)}</td></tr></table>")
            else:
                out.append(f"<pre>{self.text()}</pre>")
        return out

    def page(self) -> list[tuple[str, bool]]:
        """(html, is it article) in page order."""
        r = self.r
        out: list[tuple[str, bool]] = [(f"<!DOCTYPE html><html><head><title>{self.sentence(8)}</title></head><body>", False)]
        bare = r.random() < 0.12
        wrappers: list[tuple[str, str]] = []
        if not bare:
            for _ in range(r.choice((0, 0, 1, 1, 2))):
                wrappers.append((f'<div class="{r.choice(("wrapper", "container", "row", "layout", "outer", "page", "root", "app"))}">', "</div>"))
            style = r.random()
            if style < 0.45:
                wrappers.append(("<article>", "</article>") if r.random() < 0.7 else ("<main><article>", "</article></main>"))
            elif style < 0.6:
                wrappers.append(("<main>", "</main>"))
            elif style < 0.95:
                name = r.choice(("div", "div", "section", "td", "article"))
                left = f'<{name} {r.choice(("class", "id"))}="{r.choice(("-", " ")).join(r.sample(ARTICLE, r.choice((1, 2))))}">'
                wrappers.append(("<table><tr>" + left, "</td></tr></table>") if name == "td" else (left, f"</{name}>"))
        before = r.choices(("header", "nav", "nav", "notice", "ad", "form", "aside"), k=r.randint(0, 3))
        if bare and r.random() < 0.5:
            before = []
        after = r.choices(("footer", "footer", "aside", "ad", "comments", "comments", "form", "notice", "nav"), k=0 if bare and not before else r.randint(0, 4))
        out += [(self.other(k), False) for k in before]
        out += [(left, False) for left, _ in wrappers]
        article = [(b, True) for b in self.body()]
        for _ in range(r.choice((0, 0, 1, 1, 2, 3))):
            article.insert(r.randint(0, len(article)), (self.other(r.choice((*OTHER, "ad", "aside", "aside"))), False))
        inside = r.random() < 0.3
        tail = [(self.other(k), False) for k in after]
        out += article + (tail if inside else []) + [(right, False) for _, right in wrappers[::-1]] + ([] if inside else tail)
        return [*out, ("</body></html>", False)]


#: Stands around the text of an article while a training page is parsed; no generated text contains it.
MARK = "\x02"


def labelled_pages(n: int, seed: int = 5) -> list[tuple[str, list[bool]]]:
    """n pages, each with the kind of its blocks in page order."""
    from runnel.llm.html_blocks import blocks

    maker = _Maker(seed)
    out = []
    for _ in range(n):
        parts = maker.page()
        page = "".join(p for p, _ in parts)
        marked = "".join(_marked(p) if good else p for p, good in parts)
        kinds = [MARK in b.text for b in blocks(marked)]
        assert len(kinds) == len(blocks(page))
        out.append((page, kinds))
    return out


def _marked(part: str) -> str:
    """The part with MARK in every piece of text."""
    out, inside = [], False
    for c in part:
        if c == "<":
            inside = True
        elif not inside and not c.isspace() and (not out or out[-1] != MARK and MARK not in out[-1]):
            out.append(MARK)
        out.append(c)
        if c == ">":
            inside = False
    return "".join(out)
