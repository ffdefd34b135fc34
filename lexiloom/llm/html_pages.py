"""Labelled pages to train the extraction on: made from a grammar of layouts, labelled by data-content attributes.

Words are random syllables, so nothing but layout, names, lengths and punctuation can be learned. Each page draws its
container, names, order and boilerplate anew; a third of them name nothing, so that shape has to tell.
"""

from __future__ import annotations

import random

_SYLLABLES = [a + b for a in "bcdfglmnprstv" for b in ("a", "e", "i", "o", "u", "an", "er", "on", "is")]


class _Page:
    def __init__(self, rng: random.Random):
        self.r, self.named = rng, rng.random() < 0.67

    def word(self) -> str:
        return "".join(self.r.choices(_SYLLABLES, k=self.r.choice((1, 1, 2, 2, 3, 4))))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi)))

    def sentence(self, lo: int = 3, hi: int = 18) -> str:
        text = self.words(lo, hi)
        if self.r.random() < 0.3:
            text = text.replace(" ", ", ", 1)
        return text.capitalize() + self.r.choice(".....?!")

    def prose(self, lo: int = 1, hi: int = 6) -> str:
        out = " ".join(self.sentence() for _ in range(self.r.randint(lo, hi)))
        if self.r.random() < 0.25:
            parts = out.split(" ")
            k = self.r.randrange(len(parts))
            parts[k] = self.r.choice(('<a href="/x">{}</a>', "<b>{}</b>", "<em>{}</em>", "<strong>{}</strong>", "{}&nbsp;&amp;")).format(parts[k])
            out = " ".join(parts)
        return out

    def open(self, plain: str, *names: str, share: float = 1.0) -> tuple[str, str]:
        """A start and end tag: `plain`, or a div with one of the names where the page names things."""
        if names and self.named and self.r.random() < share:
            tag = self.r.choice((plain, "div", "div", "section"))
            return f'<{tag} {self.r.choice(("class", "id"))}="{self.r.choice(names)}"', tag
        return f"<{plain}", plain

    def boiler(self, inside: str, plain: str, *names: str) -> str:
        start, tag = self.open(plain, *names)
        return f'{start} data-content="0">{inside}</{tag}>'

    def links(self, lo: int = 3, hi: int = 9) -> str:
        items = [f'<a href="/{i}">{self.words(1, 3).capitalize()}</a>' for i in range(self.r.randint(lo, hi))]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}{self.r.choice(('</li>', '</li>', ''))}" for x in items) + "</ul>"
        return self.r.choice((" | ", " ", " &middot; ")).join(items)

    def ad(self) -> str:
        inside = self.r.choice((self.sentence(), self.prose(1, 4), f'<a href="/ad">{self.sentence()}</a>', f"<p>{self.prose(1, 3)}</p>", "Advertisement"))
        name = self.r.choice(("ad", "ads", "advert", "ad-box", "advertisement", "sponsored", "promo", "ad-banner"))
        tag = self.r.choice(("div", "div", "div", "aside", "section"))
        return f'<{tag} class="{name}" data-content="0">{inside}</{tag}>'

    def notice(self) -> str:
        inside = f"<p>{self.prose(1, 3)}</p>" + self.r.choice(("", "<button>Ok</button>", '<a href="/p">More</a>'))
        return self.boiler(inside, "div", "cookie-banner", "consent", "notice", "alert", "newsletter", "popup", "paywall") if self.named else f'<div class="{self.r.choice(("notice", "cookie-notice", "consent"))}" data-content="0">{inside}</div>'

    def form(self) -> str:
        inside = f'<label>{self.words(1, 3)}</label> <input name="q"> {self.r.choice(("", "<p>" + self.sentence() + "</p>"))}<button>{self.word()}</button>'
        return f'<form data-content="0">{inside}</form>'

    def comments(self) -> str:
        one = [f"<p>{self.r.choice((self.word() + ' says:', '<b>' + self.word() + '</b>'))}</p><p>{self.prose(1, 4)}</p>" if self.r.random() < 0.5 else f"<p>{self.prose(1, 3)}</p>" for _ in range(self.r.randint(1, 6))]
        kind = self.r.choice(("div", "li"))
        body = "".join(f'<{kind} class="comment">{x}</{kind}>' for x in one)
        body = f"<ol>{body}</ol>" if kind == "li" else body
        tag = self.r.choice(("section", "div"))
        return f'<{tag} {self.r.choice(("class", "id"))}="{self.r.choice(("comments", "comment-list", "reader-comments", "discussion", "responses"))}" data-content="0">{self.r.choice(("", "<h2>Comments</h2>", "<h3>" + self.words(1, 3) + "</h3>"))}{body}</{tag}>'

    def sidebar(self) -> str:
        inside = "".join(self.r.choice((f"<h3>{self.words(1, 3)}</h3>", self.links(), f"<p>{self.prose(1, 4)}</p>", f"<div>{self.sentence()}</div>")) for _ in range(self.r.randint(1, 4)))
        tag = self.r.choice(("aside", "aside", "div"))
        name = f' class="{self.r.choice(("sidebar", "widget", "side-bar", "right-rail", "related", "popular"))}"' if tag == "div" or self.named else ""
        return f'<{tag}{name} data-content="0">{inside}</{tag}>'

    def top(self) -> str:
        inside = self.r.choice(("", f'<a href="/">{self.words(1, 2)}</a>')) + self.r.choice((f"<h1>{self.words(1, 3)}</h1>", f"<p>{self.sentence()}</p>", f"<div>{self.words(1, 4)}</div>", f"<p>{self.words(2, 6)}</p>"))
        return self.boiler(inside, "header", "header", "masthead", "site-header", "topbar")

    def menu(self) -> str:
        return self.boiler(self.links(), "nav", "nav", "menu", "navbar", "main-menu", "breadcrumbs")

    def bottom(self) -> str:
        text = self.r.choice(("&copy; ", "&copy; 2024 ", "")) + self.r.choice((self.words(1, 4) + ". ", "www." + self.word() + ".com &middot; ", "")) + self.prose(1, 3)
        return self.boiler(self.r.choice((text, f"<p>{text}</p>", self.links() + f"<p>{text}</p>", text)), "footer", "footer", "site-footer", "colophon")

    def paragraph(self) -> str:
        text = self.prose(1, 8) if self.r.random() < 0.8 else self.r.choice((self.sentence(1, 4), self.words(1, 6)))
        if self.r.random() < 0.08:
            return f"<p><b>{text}<br>"
        return self.r.choice(("<p>{}</p>",) * 8 + ("<p>{}", "<div>{}</div>", "{}<br><br>")).format(text)

    def article(self) -> str:
        title = self.words(2, 10).capitalize()
        blocks = [self.paragraph() for _ in range(self.r.choice((1, 2, 3, 4, 6, 9, 14)))]
        for _ in range(self.r.choice((0, 0, 1, 2))):
            extra = self.r.choice(("h2", "list", "quote", "pre", "table", "figure"))
            made = {
                "h2": lambda: f"<h2>{self.words(1, 6).capitalize()}</h2>",
                "list": lambda: "<ul>" + "".join(f"<li>{self.r.choice((self.sentence(), self.words(1, 5)))}</li>" for _ in range(self.r.randint(2, 6))) + "</ul>",
                "quote": lambda: f"<blockquote><p>{self.prose(1, 3)}</p></blockquote>",
                "pre": lambda: f"<pre>{self.words(4, 20)}</pre>",
                "table": lambda: "<table>" + "".join("<tr>" + "".join(f"<td>{self.words(1, 4)}</td>" for _ in range(3)) + "</tr>" for _ in range(self.r.randint(2, 5))) + "</table>",
                "figure": lambda: f"<figure><img src=x><figcaption>{self.sentence()}</figcaption></figure>",
            }[extra]()
            blocks.insert(self.r.randint(0, len(blocks)), made)
        for _ in range(self.r.choice((0, 0, 1, 2))):
            made = self.r.choice((self.ad, self.ad, self.notice, self.form, lambda: f'<div class="{self.r.choice(("share", "social", "share-buttons"))}" data-content="0">{self.links(2, 4)}</div>', lambda: f'<div class="related" data-content="0">{self.links(2, 5)}</div>'))()
            blocks.insert(self.r.randint(0, len(blocks)), made)
        head = self.r.choice((f"<h1>{title}</h1>",) * 4 + (f"<header><h1>{title}</h1></header>", f"<h2>{title}</h2>", ""))
        if self.r.random() < 0.15:
            head += f"<p class=\"{self.r.choice(('byline', 'meta', 'date'))}\">{self.words(2, 5)}</p>"
        body = head + "".join(blocks)
        if self.r.random() < 0.15:
            body += self.comments()
        start, tag = self.open("article" if self.r.random() < 0.6 else self.r.choice(("main", "div", "section", "div")), "content", "post", "entry-content", "article-body", "story", "main-content", share=0.7)
        return f'{start} data-content="1">{body}</{tag}>'

    def html(self) -> str:
        r = self.r
        parts = [self.article()]
        before = [f for f in (self.top, self.menu, self.menu, self.notice, self.ad, self.form, self.sidebar) if r.random() < 0.4]
        after = [f for f in (self.sidebar, self.ad, self.comments, self.comments, self.form, self.notice, self.menu) if r.random() < 0.35]
        r.shuffle(before)
        r.shuffle(after)
        parts = [f() for f in before] + parts + [f() for f in after]
        if r.random() < 0.8:
            parts.append(self.bottom())
        inside = r.choice(("", "\n")).join(parts)
        for _ in range(r.choice((0, 0, 1, 2))):
            inside = f'<div{r.choice(("", " id=page", " class=wrapper", " class=container"))}>{inside}</div>'
        if r.random() < 0.04:
            inside = f"<form>{inside}</form>"
        end = r.choice(("</body></html>",) * 5 + ("",))
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style></head><body>{inside}{end}"


def labelled_pages(n: int = 450, seed: int = 20240305) -> list[str]:
    """n pages; the same for the same seed. A few are text alone or text with line breaks, all of it content."""
    out = []
    for k in range(n):
        rng = random.Random(f"{seed}-{k}")
        page = _Page(rng)
        if k % 12 == 0:
            texts = [rng.choice((page.prose(1, 5), page.sentence(1, 4), page.words(1, 4))) for _ in range(rng.choice((1, 1, 2, 4)))]
            deep = rng.choice((0, 0, 1, 3, 8))
            inside = "<div>" * deep + rng.choice(("<br><br>", "<p>", "\n")).join(["", *texts]) + "</div>" * deep
            out.append(rng.choice(('<body data-content="1">{}</body>', '<div data-content="1">{}</div>', '<p data-content="1">{}')).format(inside))
        else:
            out.append(page.html())
    return out
