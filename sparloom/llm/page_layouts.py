"""Labelled pages: layouts drawn by a seed, with the content between {{ and }}.

They show what tells an article from what stands around it: elements, names of
classes and ids (known ones, made-up ones, none), links, length, sentences and
order.  The weights of HTML extraction are fitted on them; nothing else is.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

#: What classes and ids are called around an article, by kind, and the elements that may hold it.
FOREIGN = {
    "menu": (("nav", "ul", "div"), "nav menu navbar navigation main-menu topnav breadcrumb breadcrumbs pagination toc tabs"),
    "header": (("header", "div"), "header site-header topbar top-bar head banner-top logo branding"),
    "footer": (("footer", "div"), "footer site-footer bottom copyright legal imprint"),
    "sidebar": (("aside", "div", "section"), "sidebar side-bar aside widget widgets related recommended more-stories trending"),
    "advert": (("div", "section", "aside"), "ad ads advert advertisement ad-slot ad-box sponsored promo promotion banner"),
    "notice": (("div", "section"), "cookie cookie-notice consent notice gdpr alert disclaimer popup modal overlay subscribe newsletter signup skip skip-link paywall"),
    "form": (("form", "div"), "form search search-form login contact-form"),
    "social": (("div", "ul"), "share social sharing follow tags meta-links"),
    "comments": (("section", "div", "ol"), "comments comment comment-list replies discussion responses disqus"),
}
#: Names around content.
HOLDERS = "content post entry article story text article-body post-content entry-content main-content page wrapper container reader body".split()
SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu lar men tos".split()


class Layout:
    """One random page."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.randint(1, 4)))

    def words(self, least: int, most: int, stop: float = 0.5) -> str:
        said = [self.word() for _ in range(self.rng.randint(least, most))]
        for k in range(len(said) - 1):
            if self.rng.random() < 0.12 * stop:
                said[k] += self.rng.choice(".,")
        return " ".join(said) + "." * (self.rng.random() < stop)

    def marked(self, least: int, most: int, stop: float) -> str:
        """Content, now and then with inline elements and a break."""
        said = [f"{{{{{w}}}}}" for w in self.words(least, most, stop).split()]
        if len(said) > 3 and self.rng.random() < 0.4:
            k = self.rng.randrange(len(said) - 2)
            tag = self.rng.choice(("a", "b", "i", "em", "span", "code"))
            said[k] = f"<{tag}>{said[k]}</{tag}>"
        if len(said) > 6 and self.rng.random() < 0.2:
            said.insert(len(said) // 2, "<br>")
        return " ".join(said)

    def named(self, tag: str, name: str | None) -> str:
        return f"<{tag}>" if name is None else f'<{tag} {self.rng.choice(("class", "id"))}="{name}">'

    def foreign(self, kind: str, unseen: float) -> str:
        tags, names = FOREIGN[kind]
        tag = self.rng.choice(tags)
        name = self.rng.choice(names.split())
        telling = tag in ("nav", "header", "footer", "aside", "form")
        if self.rng.random() < unseen:
            name = self.word() + self.word()
        elif telling and self.rng.random() < 0.5:
            name = None
        plain = self.rng.random() < 0.5
        link = lambda: self.words(1, 3, 0) if plain else f"<a href='/{self.word()}'>{self.words(1, 3, 0)}</a>"
        if kind in ("menu", "social") or self.rng.random() < 0.2:
            inner = "".join(f"<li>{link()}</li>" for _ in range(self.rng.randint(2, 7))) if tag in ("ul", "ol") else " ".join(link() for _ in range(self.rng.randint(2, 7)))
            inner = f"<ul>{inner}</ul>" if tag == "nav" and self.rng.random() < 0.6 else inner
        elif kind == "comments":
            inner = "".join(self.rng.choice(("<p>{}</p>", "<li><p>{}</p></li>", "<div>{}</div>")).format(self.words(2, 60)) for _ in range(self.rng.randint(1, 5)))
            inner = f"<h3>{self.words(1, 2, 0)}</h3>" * (self.rng.random() < 0.5) + inner
        else:
            inner = self.rng.choice(("{}", "<p>{}</p>", "<p>{}</p>", "<h3>{}</h3>", "{} <a>x</a>")).format(self.words(1, 30))
        return f"{self.named(tag, name)}{inner}</{tag}>"

    def block(self) -> str:
        """A block of content."""
        p = lambda: f"{self.named('p', self.word() if self.rng.random() < 0.1 else None)}{self.marked(1, 70, 0.85)}</p>"
        rows = lambda n: "".join(f"<li>{self.marked(1, 15, 0.4)}</li>" for _ in range(n))
        draw = self.rng.random()
        if draw < 0.62:
            return p()
        if draw < 0.72:
            return f"<h{(n := self.rng.randint(2, 4))}>{self.marked(1, 8, 0.05)}</h{n}>"
        if draw < 0.80:
            return f"<{(t := self.rng.choice(('ul', 'ol')))}>{rows(self.rng.randint(1, 5))}</{t}>"
        if draw < 0.84:
            return f"<blockquote>{self.rng.choice((p(), self.marked(3, 30, 0.9)))}</blockquote>"
        if draw < 0.88:
            return f"<pre>{self.marked(1, 20, 0)}</pre>"
        if draw < 0.92:
            return f"<table><tr><th>{self.marked(1, 2, 0)}</th><td>{self.marked(1, 5, 0)}</td></tr></table>"
        if draw < 0.95:
            return f"<figure><img><figcaption>{self.marked(1, 12, 0.5)}</figcaption></figure>"
        # a name that holds a telling word among others, on a paragraph of the article
        kind = self.rng.choice(list(FOREIGN))
        return f'<p class="{self.rng.choice(FOREIGN[kind][1].split())}-{self.word()}-{self.word()}">{self.marked(5, 60, 0.95)}</p>'

    def page(self) -> str:
        unseen = self.rng.choice((0, 0, 0.2, 0.5))
        kinds = lambda names, odds: "".join(self.foreign(k, unseen) for k in names if self.rng.random() < odds)
        holder = self.rng.choice(("article", "article", "main", "div", "div", "section", ""))
        rooted = holder in ("article", "main")
        title = f"<h1>{self.marked(1, 10, 0.05)}</h1>" if self.rng.random() < 0.85 else ""
        if rooted and title and self.rng.random() < 0.25:
            title = f"<header>{title}{f'<p>{self.marked(2, 15, 0.7)}</p>' * (self.rng.random() < 0.4)}</header>"
        blocks = [self.block() for _ in range(self.rng.choice((1, 1, 2, 4, 8, 16)))]
        if holder and self.rng.random() < 0.3:  # inside the article: only what its name or element tells apart
            blocks.insert(self.rng.randrange(len(blocks) + 1), self.foreign(self.rng.choice(("advert", "sidebar", "social", "menu", "notice")), 0))
        inner = title + "".join(blocks)
        if holder:
            name = self.word() + self.word() if self.rng.random() < 0.3 else self.rng.choice((None, *HOLDERS)) if rooted else self.rng.choice(HOLDERS)
            inner = f"{self.named(holder, name)}{inner}</{holder}>"
        before, after = kinds(("notice", "header", "menu", "advert"), 0.55), kinds(("social", "advert", "sidebar", "comments", "form", "footer"), 0.5)
        body = before + (inner if self.rng.random() < 0.9 else "") + after
        if not rooted and holder and self.rng.random() < 0.3:
            body = f'<div class="{self.rng.choice(HOLDERS)}">{body}</div>'
        return f"<html><head><title>{self.words(2, 6)}</title><style>p {{}}</style></head><body>{body}</body></html>"


def labelled_pages(many: int, seed: int = 1) -> Iterator[str]:
    """``many`` pages, always the same for a seed."""
    return (Layout(seed * 1_000_003 + k).page() for k in range(many))
