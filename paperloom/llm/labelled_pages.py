"""Labelled pages to train block labelling on: random layouts and words, with each block's label known.

A block of the main text begins with the mark U+0001, which the trainer takes off again.  Layouts range from
pages with every kind of part around the text to pages that hold nothing but it.
"""

from __future__ import annotations

import random

MARK = "\x01"
#: Names that sites give to the parts of a page.
MAIN = "content article post entry story body main text postcontent articlebody entrycontent maincontent page prose markdown".split()
CHROME = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav mainmenu toc pagination pager".split(),
    "header": "header masthead banner topbar sitehead branding logo hero".split(),
    "footer": "footer foot bottom copyright colophon legal sitefooter".split(),
    "sidebar": "sidebar aside side rail widget related recommended trending popular more secondary".split(),
    "notice": "cookie notice consent gdpr alert banner popup modal overlay newsletter subscribe signup paywall disclaimer warning".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adbox adslot banner".split(),
    "comments": "comments comment discussion replies responses disqus reply thread reader".split(),
    "form": "form search login contact feedback newsletter".split(),
    "share": "share social sharing tags tagged follow tools".split(),
}
TAGS = {"nav": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "sidebar": ["aside", "div", "section"], "notice": ["div", "section", "dialog"], "ad": ["div", "aside", "ins"], "comments": ["section", "div", "ol"], "form": ["form"], "share": ["div", "ul"]}
LETTERS = ("etaoinshrdlu", "aeiounrstlcdñóí", "enirstahduülöß", "esaitnrulodéèêç", "оеаинтсрвл", "ابتثجحدرسل")
ICONS = ("<svg viewBox='0 0 9 9'><path d='M0 0'/></svg>", "<svg/>", "<img src=a.png>", "<hr>", "<canvas></canvas>")


class Pages:
    """A stream of labelled pages."""

    def __init__(self, seed: int = 0):
        self.r = random.Random(seed)

    def word(self) -> str:
        w = "".join(self.r.choice(self.letters) for _ in range(self.r.randint(1, 9)))
        return w + self.r.choice(("***", "###", "&amp;&amp;", "%%%", "!!")) if self.junk and self.r.random() < 0.8 else w

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentences(self, low: int = 1, high: int = 5) -> str:
        return " ".join(self.words(1, 16).capitalize() + self.r.choice(("." * 6 + ",?!")) for _ in range(self.r.randint(low, high)))

    def named(self, kind: str) -> tuple[str, str]:
        tag, name = self.r.choice(TAGS[kind]), self.r.choice(CHROME[kind])
        if tag in ("nav", "header", "footer", "aside", "form", "dialog") and self.r.random() < 0.5:
            return tag, ""
        name = self.r.choice(("{}", "{}", "{}", "{}-box", "site-{}", "{}_wrap", "{}Area", "page-{}", "{} clearfix", "c-{}__inner", "{}s", "{}-container", "js-{}", "{}-below")).format(name)
        return tag, self.r.choice((' class="{}"', ' id="{}"', " class='{}'")).format(name)

    def links(self, n: int) -> str:
        style = self.r.randint(0, 2)
        items = [f'<a href="/{self.word()}">{self.words(1, 3)}</a>' for _ in range(n)]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if style == 0 else self.r.choice((" | ", " ", "")).join(items) if style == 1 else "".join(f"<div>{x}</div>" for x in items)

    def chrome(self, kind: str) -> str:
        r = self.r
        tag, name = self.named(kind)
        if kind in ("nav", "share"):
            inner = r.choice(("", "", f"<h3>{self.words(1, 3)}:</h3>")) + self.links(r.randint(2, 8))
        elif kind == "header":
            inner = r.choice((f"<h1>{self.words(1, 4)}</h1>", f"<div>{self.words(1, 5)}</div>", f"<a href='/'>{self.words(1, 2)}</a>")) + r.choice(("", f"<p>{self.words(2, 8)}</p>", self.links(3)))
        elif kind == "footer":
            inner = r.choice((f"&copy; {self.words(1, 3)} &middot; {self.sentences(1, 2)}", f"<p>{r.choice(('&copy;', 'Copyright', '(c)'))} {r.randint(1995, 2030)} {self.words(1, 5)}</p>", self.links(4), f"<p>{self.sentences(1, 3)}</p>"))
        elif kind == "form":
            inner = f"<label>{self.words(1, 4)}</label><input type=text>" + r.choice(("", f"<p>{self.sentences(1, 2)}</p>")) + f"<button>{self.words(1, 2)}</button>"
        elif kind == "comments":
            inner = f"<h3>{self.words(1, 3)}</h3>" + "".join(f"<div class='comment'><b>{self.words(1, 2)}</b><p>{self.sentences(1, 3)}</p></div>" if r.random() < 0.5 else f"<li><p>{self.sentences(1, 4)}</p></li>" for _ in range(r.randint(1, 4)))
        elif kind == "sidebar":
            inner = f"<h3>{self.words(1, 4)}</h3>" + r.choice((self.links(4), f"<p>{self.sentences(1, 3)}</p>", f"<p>{self.sentences(1, 2)}</p>" + self.links(3)))
        else:
            inner = r.choice((self.sentences(1, 2), f"<p>{self.sentences(1, 3)}</p>", f"<p>{self.sentences(1, 1)}</p><button>{self.words(1, 1)}</button>", f"<h4>{self.words(1, 4)}</h4><p>{self.sentences(1, 2)}</p>"))
        return f"<{tag}{name}>{inner}</{tag}>"

    def paragraph(self) -> str:
        r, n = self.r, self.r.random()
        text = self.words(1, 3).capitalize() + "." if n < 0.2 else self.sentences(1, 7)
        if r.random() < 0.15:
            text += f' <a href="/{self.word()}">{self.words(1, 3)}</a> {self.words(1, 4)}.'
        if r.random() < 0.1:
            text = f"<b>{text}" + r.choice(("</b>", "<br>"))
        if r.random() < 0.05:
            text += f" {r.choice(ICONS[:3])} {self.words(1, 9)}"
        kind = r.random()
        if kind < 0.7:
            return f"<p>{MARK}{text}" + r.choice(("</p>", "</p>", "</p>", ""))
        if kind < 0.75:
            return f"<p>{MARK}{text}</p>{r.choice(('', *ICONS))} {MARK}{self.words(1, 12)}"
        if kind < 0.83:
            return f"<h{r.randint(2, 4)}>{MARK}{self.words(1, 7)}</h{r.randint(2, 4)}>"
        if kind < 0.9:
            return "<ul>" + "".join(f"<li>{MARK}{self.words(2, 12)}</li>" for _ in range(r.randint(1, 4))) + "</ul>"
        if kind < 0.95:
            return f"<blockquote><p>{MARK}{self.sentences(1, 3)}</p></blockquote>"
        if kind < 0.96:
            return "<dl>" + "".join(f"<dt>{MARK}{self.words(1, 3)}</dt><dd>{MARK}{self.words(2, 9)}</dd>" for _ in range(r.randint(1, 3))) + "</dl>"
        if kind < 0.97:
            return r.choice((f"<pre>{MARK}{self.words(3, 20)}</pre>", f"<figure><img src=a.png><figcaption>{MARK}{self.words(2, 12)}</figcaption></figure>"))
        if kind < 0.99:
            return "<table>" + "".join(f"<tr><td>{MARK}{self.words(1, 3)}</td><td>{MARK}{self.words(1, 3)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>"
        return f"<div>{MARK}{self.sentences(1, 4)}</div>"

    def article(self) -> list[str]:
        """Headings and paragraphs: a title, a title in a header of its own, or none."""
        r = self.r
        title = f"<h1>{MARK}{self.words(1, 10)}</h1>"
        head = r.choices(([], [title], [f"<header>{title}</header>"]), (0.3, 0.62, 0.08))[0]
        return head + [self.paragraph() for _ in range(1 if r.random() < 0.2 else r.randint(1, 9))]

    def wrapped(self, body: str, bare: float) -> str:
        """The text in an article, a main, an element with a name, or, in a share of pages, in none."""
        r = self.r
        if r.random() < bare:
            return body
        how = r.random()
        if how < 0.45:
            return f"<article{r.choice(('', '', f' class={chr(34)}{r.choice(MAIN)}{chr(34)}'))}>{body}</article>"
        if how < 0.6:
            return f"<main>{body}</main>"
        return f'<div {r.choice(("class", "id"))}="{r.choice(("{}", "{}-body", "post-{}", "the-{}", "{}_text")).format(r.choice(MAIN))}">{body}</div>'

    def plain(self) -> str:
        """A page of nothing but its text."""
        r, article = self.r, self.article()
        if r.random() < 0.15:
            article = [f"{MARK}{self.sentences(1, 3)}"]
        if r.random() < 0.2:
            article.insert(r.randint(0, len(article)), r.choice(ICONS))
        body = self.wrapped("".join(article), 0.4)
        if r.random() < 0.2:
            body = f"<div>{body}</div>"
        return body

    def nameless(self) -> str:
        """A page whose parts have no names: menus are told by their links, a last line by its copyright."""
        r, text = self.r, "".join(self.article())
        menu = self.links(r.randint(2, 8))
        legal = f"{r.choice(('&copy;', 'Copyright', 'Copyright &copy;', '(c)'))} {r.choice((str(r.randint(1995, 2030)), self.words(1, 2)))} {self.words(0, 5)}"
        tag = r.choice(("div", "div", "section", "p"))
        before, after = f"<div>{menu}</div>" if r.random() < 0.7 else "", f"<{tag}>{legal}</{tag}>" if r.random() < 0.7 else ""
        return f"{before}{r.choice(('<div>{}</div>', '<div>{}</div>', '<section>{}</section>', '{}')).format(text)}{after}"

    def in_table(self) -> str:
        """A page laid out by a table: a cell holds the text, cells beside, above and below it the menu and the rest."""
        r, text = self.r, "".join(self.article())
        cell = lambda inner, names: f"<td{r.choice(('', ' width=20%', *(f' class={chr(34)}{n}{chr(34)}' for n in r.sample(names, 2))))}>{inner}</td>"
        menu = cell(r.choice((self.links(r.randint(2, 8)), "<br>".join(f"<a href='/{self.word()}'>{self.words(1, 2)}</a>" for _ in range(r.randint(2, 6))))), CHROME["nav"])
        beside = cell(self.links(r.randint(2, 5)), CHROME["sidebar"]) if r.random() < 0.3 else ""
        rows = f"<tr>{menu if r.random() < 0.7 else ''}{cell(text, MAIN)}{beside}</tr>"
        if r.random() < 0.3:
            rows = f"<tr>{menu}</tr>{rows}"
        if r.random() < 0.5:
            rows += f"<tr>{cell(f'{r.choice(('&copy;', 'Copyright'))} {r.randint(1995, 2030)} {self.words(0, 4)}', CHROME['footer'])}</tr>"
        return f"<table>{rows}</table>"

    def page(self) -> str:
        r = self.r
        self.letters, self.junk = r.choice(LETTERS), r.random() < 0.12
        kind = r.random()
        if kind < 0.18:
            body = self.plain()
        elif kind < 0.23:
            body = self.nameless()
        elif kind < 0.28:
            body = self.in_table()
        else:
            article = self.article()
            for kind in ("share", "ad", "notice", "sidebar", "comments", "form"):
                if r.random() < 0.3:
                    article.insert(len(article) if r.random() < 0.3 else r.randint(1, len(article)), self.chrome(kind))
            body = self.wrapped("".join(article), 0.14)
            if r.random() < 0.35:
                body = f"<main>{body}</main>" if "<main" not in body and r.random() < 0.5 else f'<div class="{r.choice(("wrapper", "container", "row", "col", "layout"))}">{body}</div>'
            most = r.choice((0.15, 0.5, 0.5, 0.8))
            before = [self.chrome(k) for k in ("notice", "header", "nav", "ad", "form", "sidebar") if r.random() < most]
            after = [self.chrome(k) for k in ("comments", "share", "sidebar", "ad", "form", "notice", "footer") if r.random() < most]
            if r.random() < 0.3:
                r.shuffle(before)
            body = f"{''.join(before)}{body}{''.join(after)}"
        if r.random() < 0.03:
            return body
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 8)}</title><style>p{{margin:0}}</style></head><body>{body}</body></html>"
