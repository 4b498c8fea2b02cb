"""The labelled table for main-text extraction: small pages whose main blocks begin with a mark.

Each page is put together from a frame, what stands around its text, and a text
of blocks of given lengths. Pages come in turn with telling names, with names
that mislead (a wrapper of all that is called after its sidebar, notices that are
called content) and with none; with and without elements that tell of an article.
Some have surroundings longer than their text, some have none at all.
"""

from __future__ import annotations

import random

MARKED = "¶"
_WORDS = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod tempor invidunt ut labore et dolore magna aliquyam erat".split()
PAGES = 3000


class Writer:
    """One page's pieces. names: how class attributes are written; semantic: whether article, nav, footer and the like are used."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.names = ("telling", "none", "none", "misleading")[seed % 4]
        self.semantic = seed // 4 % 3  # 2: all such elements, 1: around the text only, 0: none

    def text(self, n: int) -> str:
        at = self.r.randrange(len(_WORDS))
        return " ".join(_WORDS[(at + i) % len(_WORDS)] for i in range(n)) + self.r.choice((".", ".", "", "!"))

    def some(self, low: int, high: int) -> str:
        return self.text(self.r.randint(low, high))

    def links(self, n: int, low: int = 1, high: int = 2) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{self.some(low, high)}</a></li>' for i in range(n)) + "</ul>"

    def box(self, name: str, inner: str, tag: str = "div") -> str:
        """A container with a name, or without where the page has none."""
        if tag != "div" and not self.semantic:
            tag = "div"
        attribute = {"telling": f' class="{name}"', "none": "", "misleading": self.r.choice((' class="content"', ' id="b7"', ""))}[self.names]
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def above(self) -> str:
        """What stands before a text."""
        t, r = self, self.r
        return r.choice((
            lambda: t.box("menu", t.links(r.randint(4, 9)), "nav"),
            lambda: t.box("menu", t.links(r.randint(4, 9)), "nav") + t.box("ad", t.some(3, 30)),
            lambda: t.box("site-header", f"<h2>{t.some(1, 4)}</h2><p>{t.some(3, 8)}</p>" + t.links(r.randint(3, 6)), "header"),
            lambda: t.box("banner", f"{t.some(2, 5)}" + t.links(r.randint(5, 8)), "header"),
            lambda: t.box("ad", t.some(3, 34)),
            lambda: t.box("ad", t.some(1, 12)),
            lambda: t.box("cookie-notice", f'<p>{t.some(12, 30)} <a href="/c">{t.some(1, 3)}</a></p>'),
            lambda: t.box("notice", t.some(8, 24)),
            lambda: t.box("search", f"<p>{t.some(2, 5)}</p><label>{t.some(1, 3)}</label>", "form"),
            lambda: t.box("breadcrumbs", f'<a href="/">{t.some(1, 1)}</a> <a href="/a">{t.some(1, 2)}</a> {t.some(1, 2)}'),
            lambda: t.links(r.randint(5, 9)),
        ))()

    def below(self) -> str:
        """What stands after a text. Long comments and sidebars of prose can't be told without names or elements."""
        t, r = self, self.r
        untold = self.names != "telling" and not self.semantic
        comment = lambda: t.box("comment", f"<p>{t.some(1, 2)}</p><p>{t.some(4, 12 if untold else 50)}</p>")
        return r.choice((
            lambda: t.box("footer", t.some(4, 30), "footer"),
            lambda: t.box("footer", f"&copy; {t.some(2, 4)} &middot; {t.some(4, 24)}", "footer"),
            lambda: t.box("footer", f"<p>{t.some(4, 25)}</p><p>&copy; {t.some(2, 12)}</p>" + t.links(r.randint(3, 7)), "footer"),
            lambda: t.box("sidebar", f"<h3>{t.some(1, 4)}</h3><p>{t.some(4, 12 if untold else 34)}</p>" + t.links(r.randint(3, 7), 2, 6), "aside"),
            lambda: t.box("related", f"<h3>{t.some(1, 3)}</h3>" + t.links(r.randint(3, 6), 4, 9)),
            lambda: t.box("comments", f"<h3>{t.some(1, 2)}</h3>" + "".join(comment() for _ in range(r.randint(1, 4))), "section"),
            lambda: t.box("newsletter", f"<p>{t.some(8, 20)}</p><label>{t.some(1, 2)}</label>", "form"),
            lambda: t.box("share", " ".join(f'<a href="/{i}">{t.some(1, 1)}</a>' for i in range(4))),
            lambda: t.box("advert", t.some(5, 30)),
            lambda: t.box("promo", f'<p><a href="/p">{t.some(5, 14)}</a></p>'),
            lambda: t.box("teasers", "".join(f'<div><h2><a href="/{i}">{t.some(3, 8)}</a></h2><p>{t.some(8, 28)} <a href="/{i}">{t.some(1, 3)}</a></p></div>' for i in range(r.randint(2, 4)))),
            lambda: t.box("teasers", "".join(f'<h3><a href="/{i}">{t.some(3, 8)}</a></h3><p>{t.some(8, 28)}</p>' for i in range(r.randint(2, 4)))),
        ))()

    def prose(self, n: int, title: str = "h3") -> str:
        """About n words in paragraphs, some below a heading."""
        t, r, out = self, self.r, []
        while n > 0:
            k = r.choice((6, 15, 30, 60, 90))
            out.append((f"<{title}>{t.some(1, 5)}</{title}>" if r.random() < 0.2 else "") + f"<p>{t.text(min(n, k))}</p>")
            n -= k
        return "".join(out)

    def long(self, n: int) -> str:
        """Surroundings of n words, which a name or an element tells of."""
        t, r = self, self.r
        if self.names != "telling":
            return r.choice(("<aside>{}</aside>", "<footer>{}</footer>", "<form>{}</form>", "<aside><div>{}</div></aside>")).format(t.prose(n))
        each = lambda tag: "".join(t.box("comment", f"<p>{t.some(1, 2)}</p>{t.prose(k)}", tag) for k in [40] * (n // 40) + [n % 40 + 1])
        return r.choice((
            lambda: t.box("sidebar", t.prose(n), "aside"), lambda: t.box("cookie-consent", t.prose(n)), lambda: t.box("comments", t.prose(n), "section"), lambda: t.box("related", t.prose(n)), lambda: t.box("notice", f"<p>{t.text(n)}</p>"),
            lambda: t.box("comments", f"<h2>{t.some(1, 2)}</h2>" + each("div"), "section"), lambda: t.box("comment-list", each("article")), lambda: t.box("site-footer", t.prose(n), "footer"),
        ))()

    def linked(self) -> str:
        """A block of links among those of a text, with no container of its own."""
        t, r = self, self.r
        return r.choice((
            lambda: f'<p><a href="/m">{t.some(3, 12)}</a></p>',
            lambda: f'<p>{t.some(1, 2)} <a href="/m">{t.some(5, 12)}</a></p>',
            lambda: t.links(r.randint(2, 6), 1, 6),
            lambda: "<p>" + " | ".join(f'<a href="/{i}">{t.some(1, 2)}</a>' for i in range(r.randint(2, 6))) + "</p>",
        ))()

    def inside(self) -> str:
        """Between the blocks of a text."""
        t, r = self, self.r
        if r.random() < 0.5:
            return ""
        if self.names == "telling" and r.random() < 0.3:
            return f'<p class="advert">{t.some(5, 14)}</p>'
        return r.choice((
            lambda: t.box("ad", t.some(3, 20)),
            lambda: t.box("related", t.links(3, 4, 8)),
            lambda: t.box("promo", f'<a href="/q">{t.some(3, 9)}</a>', "aside"),
            lambda: t.box("sidebar", f"<p>{t.some(2, 34)}</p>", "aside"),
            lambda: t.box("signup", f"<p>{t.some(2, 14)}</p>{t.some(1, 2)}", "form"),
            lambda: t.box("sidebar", t.some(1, 16), "aside"),
        ))()

    def main(self) -> str:
        """The labelled blocks of a text: a title, paragraphs of any length, lists, quotes, links."""
        t, r = self, self.r
        mark = lambda tag, low, high: f"<{tag}>{MARKED}{t.some(low, high)}</{tag}>"
        short = r.random() < 0.3
        lengths = [r.choice((1, 2, 3, 6, 9, 14)) for _ in range(r.randint(1, 3))] if short else [r.choice((1, 2, 3, 5, 8, 12, 20, 35, 60, 90, 160)) for _ in range(r.randint(2, 9))] + [r.randint(30, 200)]
        r.shuffle(lengths)
        titled = (short and self.semantic < 2) or r.random() < 0.75
        out = [f"<p>{MARKED}{t.text(n)}</p>" for n in lengths]
        if not short:
            if r.random() < 0.4:
                out.insert(r.randint(1, len(out)), "<ul>" + "".join(mark("li", 2, 16) for _ in range(r.randint(2, 4))) + "</ul>")
            if r.random() < 0.4:
                out.insert(r.randint(1, len(out)), f'<p>{MARKED}{t.some(9, 20)} <a href="/x">{t.some(1, 4)}</a> {t.some(4, 12)}</p>')
            if r.random() < 0.4:
                out.insert(r.randint(1, len(out) - 1), mark("h2", 2, 6))
            if r.random() < 0.2:
                out.insert(r.randint(1, len(out)), f"<blockquote>{mark('p', 6, 30)}</blockquote>")
            if r.random() < 0.4:
                out.insert(r.randint(1, len(out)), t.linked())
            if r.random() < 0.2:  # in sections of their own
                out = [f"<section>{mark('h2', 2, 6)}{mark('p', 2, 12)}{mark('p', 40, 90)}</section>" if r.random() < 0.4 else x for x in out]
        out.insert(r.randint(1, len(out)), t.inside())
        title = mark("h1", 1, 12)
        if titled and self.semantic == 2 and not short and r.random() < 0.2:
            return f"<header>{title}{mark('p', 3, 9)}</header>" + "".join(out)
        return (title if titled else "") + "".join(out)

    def framed(self) -> str:
        t, r, inner = self, self.r, self.main()
        if self.semantic == 2:
            return r.choice(("<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>")).format(inner)
        if self.names == "telling":
            return r.choice(('<div class="content">{}</div>', '<div id="main-content"><div class="post-body">{}</div></div>', '<div class="entry">{}</div>')).format(inner)
        return r.choice(("<div>{}</div>", "<div>{}</div>", "<div><div>{}</div></div>", "<section>{}</section>")).format(inner)

    def flat(self) -> str:
        """A page without containers: only words and links tell the blocks apart."""
        t, r = self, self.r
        lines = [t.linked() for _ in range(r.randint(1, 3))]
        text = (f"<h1>{MARKED}{t.some(2, 9)}</h1>" if r.random() < 0.7 else "") + "".join(f"<p>{MARKED}{t.some(low, high)}</p>" for low, high in [(30, 120), *((3, 90) for _ in range(r.randint(1, 6))), (30, 120)])
        end = r.choice((f'<p>&copy; {t.some(1, 4)} <a href="/i">{t.some(2, 5)}</a></p>', "".join(t.linked() for _ in range(3)), f"<hr>{t.linked()}<p>{t.some(1, 4)}</p>{t.linked()}"))
        return "".join(lines) + text + end

    def alone(self) -> str:
        """A page without surroundings: one block or a few, or text without a tag."""
        t, r = self, self.r
        n = r.choice((1, 2, 3, 5, 10, 20, 30, 40, 60, 100, 300))
        p = lambda n: f"<p>{MARKED}{t.text(n)}</p>"
        title = f"<h1>{MARKED}{t.some(1, 9)}</h1>"
        inner = r.choice((f"{MARKED}{t.text(n)}", p(n), title + p(n), p(n) + p(r.randint(1, 30)), title, title + p(3) + p(n), f"<div>{p(n)}</div>", f"<div>{MARKED}{t.text(n)}</div>", p(n) + f"<ul><li>{MARKED}{t.some(1, 9)}</li><li>{MARKED}{t.some(1, 9)}</li></ul>"))
        if self.semantic == 2 and r.random() < 0.3:
            inner = f"<article>{inner}</article>"
        return r.choice(("{}", "<html><body>{}</body></html>", "<html><head><title>x</title></head><body>{}</body></html>")).format(inner)

    def page(self) -> str:
        t, r = self, self.r
        if r.random() < 0.12:
            return self.alone()
        if self.names == "none" and not self.semantic and r.random() < 0.6:
            return f"<html><head><title>{t.some(2, 6)}</title></head><body>{t.flat()}</body></html>"
        above, inner, below = "".join(t.above() for _ in range(r.randint(1, 3))), t.framed(), "".join(t.below() for _ in range(r.randint(1, 3)))
        if (self.names == "telling" or self.semantic == 2) and r.random() < 0.7:
            more = t.long(max(3, int(inner.count(" ") * r.choice((0.3, 0.6, 0.9, 1.2, 2, 4)))))
            above, below = (above + more, below) if r.random() < 0.3 else (above, more + below) if r.random() < 0.5 else (above, below + more)
        if self.names == "telling" and self.semantic == 2 and r.random() < 0.2:  # a wrapper of some, called after a part of it
            inner, below = f'<div class="{r.choice(("has-sidebar", "with-ads", "no-comments"))}">{inner}{t.box("sidebar", t.prose(30), "aside")}</div>', below
        body = above + inner + below
        if self.names == "misleading":
            body = f'<div class="{r.choice(("has-sidebar", "page-with-ads", "no-comments share"))}">{body}</div>'
        return f"<html><head><title>{t.some(2, 6)}</title></head><body>{body}</body></html>"


def pages(n: int = PAGES) -> list[str]:
    """n pages, the same ones in every run."""
    return [Writer(seed).page() for seed in range(n)]
