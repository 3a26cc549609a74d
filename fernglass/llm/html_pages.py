"""Invented web pages with known main text, of many layouts, for fitting the trees of html_main.

A page's main text stands in elements marked data-y="1"; elements marked data-y="0" inside them are none of it. The
layouts differ in what tells main text apart: telling tags, telling classes, both or neither (plain div elements, table
layouts, text between line breaks, ends left out), with short and long articles, lists of links as content and as menus.
"""

from __future__ import annotations

import random

# Words in class, id and role by which pages name their parts.
WORDS = {
    "main": "article content main post entry story body text blog page prose post-content entry-content article-body main-content story-body richtext markdown wiki documentation".split(),
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs links site-nav main-menu navlinks skip dropdown".split(),
    "advert": "ad ads adv advert advertisement adsense sponsor sponsored promo promotion banner ad-slot dfp billboard outbrain taboola".split(),
    "foot": "footer foot copyright legal colophon contentinfo imprint site-footer bottom disclaimer".split(),
    "head": "header masthead logo brand topbar hero site-header branding tagline search".split(),
    "side": "sidebar aside side widget rail related recommended popular trending teaser more complementary see-also read-next latest archive".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login paywall cookie-banner toast".split(),
    "social": "share sharing social follow tags meta byline author social-share post-meta tag-list buttons".split(),
    "comment": "comment comments reply replies disqus respond discussion thread reviews comment-list comment-body feedback guestbook".split(),
    "plain": "c1 row col-8 wrap container grid u-mt box inner outer section1 block a3f flex clearfix layout module unit css-1x2y3z".split(),
}
SYLLABLES = "ka lo mi ren tas vo ul en ri san do pe the er sch ción que au ß ö st ou ли на 文 の".split()


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.telling = 1.0  # how often this page's parts have telling classes
        self.open = False  # whether this page leaves out ends
        self.style = "p"

    def often(self, p: float) -> bool:
        return self.r.random() < p

    def words(self, lo: int, hi: int) -> str:
        r = self.r
        out = []
        for _ in range(r.randint(lo, hi)):
            w = "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))
            out.append(w + (r.choice((",", ".", ".", ";")) if r.random() < 0.1 else ""))
        return " ".join(out)

    def sentence(self, lo: int, hi: int) -> str:
        return self.words(lo, hi).rstrip(",.;").capitalize() + self.r.choice((".", ".", ".", ".", "?", "!", ":", ""))

    def el(self, tag: str, inner: str, kinds: str = "", own: int | None = None, often: float = 0.75) -> str:
        r = self.r
        attributes = ""
        if kinds and r.random() < often * self.telling:
            word = r.choice(WORDS[kinds])
            form = r.choice(("{w}", "{w}", "{w}", "{w}-box", "site-{w}", "x1 {w}", "js-{w}__inner", "{w}Wrap"))
            attributes = f' {r.choice(("class", "class", "id", "role"))}="{form.format(w=word)}"'
        elif r.random() < 0.3:
            attributes = f' class="{r.choice(WORDS["plain"])}"'
        if r.random() < 0.03:
            attributes += r.choice((' style="x:1"', " hidden-x", " onclick='a(\"b>c\")'", ' data-n="12px"'))
        if own is not None:
            attributes += f' data-y="{own}"'
        return f"<{tag}{attributes}>{inner}</{tag}>"

    def end(self, tag: str) -> str:
        return "" if self.open and self.often(0.7) else f"</{tag}>"

    def link(self, lo: int = 1, hi: int = 4) -> str:
        return f'<a href="/{self.r.randint(1, 999)}">{self.words(lo, hi)}</a>'

    def links(self, lo: int, hi: int) -> str:
        r = self.r
        items = [self.link() for _ in range(r.randint(lo, hi))]
        k = r.random()
        if k < 0.55:
            return f"<ul>{''.join(f'<li>{x}' + self.end('li') for x in items)}</ul>"
        if k < 0.75:
            return r.choice((" | ", " ", " &middot; ", "<br>")).join(items)
        if k < 0.9:
            return "".join(f"<div>{x}</div>" for x in items)
        return "<table><tr>" + "".join(f"<td>{x}</td>" for x in items) + "</tr></table>"

    def prose(self) -> str:
        r = self.r
        text = " ".join(self.sentence(4, 22) for _ in range(r.choice((1, 1, 2, 3, 4, 6, 9))))
        if self.often(0.25):
            text += " " + self.link(1, 3) + " " + self.sentence(3, 9)
        if self.often(0.2):
            text = f"<b>{self.sentence(2, 6)}</b>{r.choice(('', ' ', '<br>'))}" + text
        if self.often(0.05):
            text += r.choice(("<br>", "<br><br>", " <img src=x> ", "<span>x</span> ", "<sup>1</sup>")) + self.sentence(3, 12)
        return text

    def paragraph(self) -> str:
        if self.style == "p":
            return f"<p>{self.prose()}" + self.end("p")
        if self.style == "div":
            return self.el("div", self.prose())
        if self.style == "span":
            return f"<div><span>{self.prose()}</span></div>"
        return self.prose() + "<br><br>"

    def main(self) -> str:
        r = self.r
        parts = []
        if self.often(0.85):
            parts.append(r.choice((f"<h1>{self.words(2, 12)}</h1>", f"<h1>{self.words(2, 12)}</h1>", f"<h2>{self.words(2, 9)}</h2>", f"<div><b>{self.words(2, 9)}</b></div>", f'<h1>{self.link(2, 8)}</h1>')))
        if self.often(0.2):  # very short pages, whose surroundings outweigh their text
            return "".join(parts) + f"<p>{r.choice(('', '<b>'))}{self.sentence(1, 9)}{r.choice(('', '<br>', '</p>'))}"
        for _ in range(r.choice((1, 2, 2, 3, 4, 6, 8, 14))):
            k = r.random()
            if k < 0.68:
                parts.append(self.paragraph())
            elif k < 0.75:
                n = r.randint(2, 4)
                parts.append(f"<h{n}>{self.words(1, 6)}</h{n}>")
            elif k < 0.8:
                tag = r.choice(("ul", "ol"))
                parts.append(f"<{tag}>" + "".join(f"<li>{self.sentence(2, 16)}" + self.end("li") for _ in range(r.randint(2, 6))) + f"</{tag}>")
            elif k < 0.85:  # a list of links that is content
                lead = f"<p>{self.sentence(4, 12)}</p>" if self.often(0.6) else ""
                parts.append(lead + "<ul>" + "".join(f"<li>{r.choice((self.link(2, 7), self.link(1, 4) + ' ' + self.sentence(2, 9)))}</li>" for _ in range(r.randint(1, 4))) + "</ul>")
            elif k < 0.88:
                parts.append(f"<blockquote><p>{self.sentence(6, 30)}</p></blockquote>" if self.often(0.5) else f"<blockquote>{self.sentence(6, 30)}</blockquote>")
            elif k < 0.9:
                parts.append(f"<pre>{self.words(4, 30)}</pre>")
            elif k < 0.93:
                cell = r.choice(("td", "td", "th"))
                rows = "".join("<tr>" + "".join(f"<{cell if not i else 'td'}>{self.words(1, 3)}" + self.end("td") for _ in range(3)) + "</tr>" for i in range(r.randint(2, 5)))
                parts.append(f"<table>{rows}</table>")
            elif k < 0.95:
                parts.append("<dl>" + "".join(f"<dt>{self.words(1, 3)}" + self.end("dt") + f"<dd>{self.sentence(3, 15)}" + self.end("dd") for _ in range(r.randint(2, 4))) + "</dl>")
            elif k < 0.97:
                parts.append(f"<figure><img src=y><figcaption>{self.sentence(3, 12)}</figcaption></figure>")
            elif k < 0.98:
                parts.append(f"<details><summary>{self.words(2, 5)}</summary>{self.paragraph()}</details>")
            else:
                parts.append(self.sentence(8, 40))
            if self.often(0.07):
                parts.append(self.el("div", r.choice((self.sentence(2, 12), self.link(2, 6))), r.choice(("advert", "social", "side")), 0, 1.2))
        return "".join(parts)

    def extra(self, kind: str) -> str:
        """A part of the page that is no main text; it has a telling tag wherever it has no telling class."""
        r = self.r
        if kind == "menu":
            return self.el(r.choice(("nav", "nav", "div", "ul", "td")) if self.style != "br" else "div", self.links(3, 12), "menu", 0)
        if kind == "advert":
            return self.el(r.choice(("div", "div", "aside", "section")), r.choice((self.sentence(2, 14), self.link(2, 8), f"<p>{self.sentence(3, 16)}</p>{self.link(1, 3)}")), "advert", 0, 2.0)
        if kind == "foot":
            mark = r.choice(("&copy; ", "&copy; 2020 ", "© ", "Copyright ", "(c) "))
            inner = r.choice((mark + f"{self.words(1, 3)}{r.choice((' &middot; ', ' | ', ' - '))}{self.sentence(3, 12)}", self.links(2, 8), f"<p>{self.sentence(3, 14)}</p>" + self.links(2, 6), f"<p>{mark}{self.words(2, 20)}</p>", mark + self.words(2, 8)))
            return self.el("footer", inner, "foot", 0, 0.3) if self.often(0.6) else self.el(r.choice(("div", "p", "center")), inner, "foot", 0, 0.8)
        if kind == "head":
            inner = r.choice((self.link(1, 2), f"<p>{self.words(2, 6)}</p>", self.links(2, 6), f"<div>{self.words(1, 3)}</div>" + self.links(3, 7)))
            return self.el("header", inner, "head", 0, 0.4) if self.often(0.7) else self.el("div", inner, "head", 0, 2.0)
        if kind == "side":
            inner = r.choice((f"<h3>{self.words(1, 3)}</h3>" + self.links(3, 9), "".join(f"<div>{self.link(3, 9)}<p>{self.sentence(3, 14)}</p></div>" for _ in range(r.randint(2, 5))), f"<h4>{self.words(1, 4)}</h4><p>{self.sentence(4, 25)}</p>"))
            return self.el("aside", inner, "side", 0, 0.5) if self.often(0.55) else self.el("div", inner, "side", 0, 2.0)
        if kind == "notice":
            return self.el(r.choice(("div", "section", "p")), r.choice((f"{self.sentence(5, 25)} {self.link(1, 2)}", f"<p>{self.sentence(5, 30)}</p><button>{self.words(1, 1)}</button>")), "notice", 0, 2.0)
        if kind == "form":
            return self.el("form", f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button>" + (f"<p>{self.sentence(4, 14)}</p>" if self.often(0.4) else ""), r.choice(("notice", "comment", "")), 0, 0.5)
        if kind == "social":
            return self.el("div", r.choice((self.links(2, 6), self.words(1, 5), f"<span>{self.words(1, 4)}</span>")), "social", 0, 2.0)
        comments = "".join(self.el(r.choice(("div", "li", "article")), f"<b>{self.words(1, 2)}</b> <p>{self.sentence(3, 30)}</p>" + (self.link(1, 1) if self.often(0.5) else ""), "comment", 0, 0.6) for _ in range(r.randint(1, 7)))
        return self.el(r.choice(("section", "div", "div", "ol")), f"<h3>{self.words(1, 2)}</h3>" + comments, "comment", 0, 2.0)

    def hidden(self) -> str:
        return self.r.choice(("<script>var a = '<p>no</p>';</script>", "<style>p{}</style>", "<noscript>Off</noscript>", "<!-- <p>x</p> -->", "<svg><text>v</text></svg>"))

    def page(self) -> str:
        r = self.r
        self.telling = r.choice((1.0, 1.0, 1.0, 0.5))
        self.open = self.often(0.25)
        self.style = r.choice(("p", "p", "p", "p", "p", "div", "div", "span", "br"))
        body = self.main()
        inside = [k for k, p in (("social", 0.2), ("advert", 0.15), ("comment", 0.06), ("side", 0.08)) if self.often(p)]
        body += "".join(self.extra(k) for k in inside)
        wrap = r.random()
        if wrap < 0.4:
            core = self.el("article", body, "main", 1, 0.3)
        elif wrap < 0.5:
            core = self.el("main", body, "main", 1, 0.3)
        elif wrap < 0.72:
            core = self.el(r.choice(("div", "section")), body, "main", 1, 0.85)
        elif wrap < 0.8:
            core = f'<table><tr><td data-y="0">{self.links(3, 8)}</td>' + self.el("td", body, "main", 1, 0.3) + "</tr></table>"
        else:
            core = self.el("div", body, "", 1)
        before = [k for k, p in (("notice", 0.2), ("head", 0.45), ("menu", 0.7), ("advert", 0.35), ("form", 0.15), ("side", 0.1)) if self.often(p)]
        after = [k for k, p in (("social", 0.25), ("comment", 0.35), ("side", 0.35), ("advert", 0.2), ("form", 0.2), ("foot", 0.8), ("notice", 0.12)) if self.often(p)]
        if self.often(0.1):
            before, after = [], []  # nothing but main text
        if self.often(0.3):
            r.shuffle(before)
        content = core
        if self.often(0.3):
            content = self.el("div", content, "main", None, 0.3)
        page = "".join(self.extra(k) for k in before) + content + "".join(self.extra(k) for k in after)
        if self.often(0.2):
            page = self.hidden() + page + self.hidden()
        for _ in range(r.choice((0, 0, 1, 2))):
            page = self.el("div", page, "", None)
        title = f"<title>{self.words(2, 6)}" + ("" if self.often(0.02) else "</title>")
        return r.choice(("<!DOCTYPE html>", "")) + f"<html><head>{title}<style>p{{}}</style></head><body>{page}" + ("</body></html>" if self.often(0.9) else "")
