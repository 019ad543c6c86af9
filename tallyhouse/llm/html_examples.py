"""Pages to learn from: templates filled with invented words, each block known to be article
or not. They follow from a seed, so the model is the same every time."""

from __future__ import annotations

import random
from collections.abc import Iterator

# Names that pages give to their parts, and words found there.
_MENU = "nav menu navbar navigation topnav breadcrumb breadcrumbs tabs mainmenu site-nav pager pagination".split()
_HEADER = "header masthead topbar site-header banner branding logo brand".split()
_FOOTER = "footer site-footer bottom copyright legal colophon footer-links".split()
_SIDE = "sidebar aside side widget related recommended trending popular tags tag-cloud archive more-stories".split()
_NOTICE = "notice cookie cookie-banner consent gdpr alert popup modal newsletter-box subscribe paywall disclaimer".split()
_ADVERT = "ad ads advert advertisement sponsored promo promotion sponsor banner-ad adbox".split()
_SHARE = "share social social-links sharing meta byline toolbar actions buttons".split()
_COMMENTS = "comments comment comment-list reader-comments discussion replies reply respond disqus feedback".split()
_ARTICLE = "article content post entry story main article-body post-content entry-content body text page-content".split()
_MENU_WORDS = "Home News Sports World Business Contact About Login Search Archive Help Shop Blog".split()
_NOTICES = (
    "We use cookies to improve this site.", "Subscribe to our newsletter.", "Sign in to continue.",
    "Accept all cookies", "This site uses cookies. Read our privacy policy.", "Please log in.",
)
_FOOTERS = ("&copy; 2024 All rights reserved.", "Terms of use &middot; Privacy", "&copy; {host} &middot; {line}")

# The share of pages whose parts have no telling names.
NAMELESS = 0.4
# Names that say nothing, as many pages give to all of their parts.
_PLAIN = "d c1 c2 col box w x inner outer wrap left right center cell row1 row2 css-1a2b3c sc-xyz block grid item t1 td1 z".split()

_SOUNDS = "ba ke lo mi su tra vel qui zor nam pel dro gha fi sko lum ven cra bri ojo wex yam jud hif pon gle rik uva mex sol".split()


class _Page:
    def __init__(self, seed: int):
        self.draw = random.Random(seed)
        self.parts: list[str] = []

    def word(self) -> str:
        return "".join(self.draw.choices(_SOUNDS, k=self.draw.randint(1, 4)))

    def line(self, least: int, most: int) -> str:
        words = [self.word() for _ in range(self.draw.randint(least, most))]
        if self.draw.random() < 0.05:
            words = [w + self.draw.choice(["###", "!!", "&amp;&amp;", "$$$", " |"]) for w in words]
        return " ".join(words).capitalize() + self.draw.choice(["", ".", "."])

    def name(self, names: list[str]) -> str:
        name = self.draw.choice(names)
        kind = self.draw.choice(["class", "class", "id"])
        return f' {kind}="{name}"'

    def mark(self, good: bool, text: str) -> str:
        """The label travels in the text, and is taken off before the model reads it."""
        return f"{'+' if good else '-'}~{text}"

    def menu(self) -> str:
        items = []
        for _ in range(self.draw.randint(2, 9)):
            text = self.draw.choice([self.word().capitalize(), self.draw.choice(_MENU_WORDS), self.line(1, 2)])
            items.append(f'<li><a href="/{self.word()}">{self.mark(False, text)}</a></li>')
        tag = self.draw.choice(["nav", "nav", "div", "header"])
        named = "" if tag == "nav" and self.draw.random() < 0.6 else self.name(_MENU)
        return f"<{tag}{named}><ul>{''.join(items)}</ul></{tag}>"

    def aside(self, names: list[str], tags: list[str], low: int = 1, high: int = 25, most: int = 3) -> str:
        tag = self.draw.choice(tags)
        named = "" if tag in ("aside", "footer", "form") and self.draw.random() < 0.5 else self.name(names)
        inner = self.draw.choice(["p", "div", "li", "span", ""])
        rows = []
        for _ in range(self.draw.randint(1, most)):
            text = self.mark(False, self.line(low, high))
            rows.append(f"<{inner}>{text}</{inner}>" if inner and inner != "span" else f"<div>{text}</div>")
        if len(rows) == 1 and self.draw.random() < 0.5:
            rows = [self.mark(False, self.line(low, high))]
        return f"<{tag}{named}>{''.join(rows)}</{tag}>"

    def form(self) -> str:
        label = self.mark(False, self.draw.choice(_NOTICES + (self.line(1, 6),)))
        return f'<form{self.name(["search", "signup", "login", "subscribe"])}><label>{label}</label><input type="text"><button>{self.mark(False, self.word())}</button></form>'

    def notice(self) -> str:
        tag = self.draw.choice(["div", "section", "aside"])
        return f"<{tag}{self.name(_NOTICE)}><p>{self.mark(False, self.draw.choice(_NOTICES + (self.line(3, 25),)))}</p></{tag}>"

    def comments(self) -> str:
        rows = []
        for _ in range(self.draw.randint(1, 6)):
            text = self.mark(False, self.line(2, 60))
            rows.append(self.draw.choice([f"<p>{text}</p>", f"<li><p>{text}</p></li>", f'<div class="comment">{text}</div>']))
        tag, head = self.draw.choice(["section", "div", "ol"]), self.mark(False, self.draw.choice(["Comments", self.line(1, 2)]))
        return f"<{tag}{self.name(_COMMENTS)}><h3>{head}</h3>{''.join(rows)}</{tag}>"

    def article(self) -> str:
        title, rows = self.line(3, 14), []
        if self.draw.random() < 0.9:
            rows.append(f"<h1>{self.mark(True, title)}</h1>")
        if self.draw.random() < 0.15:
            rows.append(self.aside(_SHARE, ["div", "ul"], 1, 5))
        for _ in range(self.draw.choice([0, 1, 2, 3, 5, 8, 12, 20])):
            text = self.mark(True, self.line(1, self.draw.choice([3, 20, 80, 200])))
            kind = self.draw.random()
            if kind < 0.7:
                rows.append(f"<p>{text}</p>")
            elif kind < 0.78:
                # Left open, as many a page leaves its paragraphs and what stands out in them.
                inline = self.draw.choice(["", "<b>", "<i>", "<strong>", "<em>", "<font>", "<span>"])
                rows.append(f"<p>{inline}{text}" + self.draw.choice(["", "<br>"]))
            elif kind < 0.83:
                rows.append(f"<h2>{text}</h2>")
            elif kind < 0.88:
                items = "".join(f"<li>{self.mark(True, self.line(1, 15))}</li>" for _ in range(3))
                rows.append(f"<ul>{items}</ul>")
            elif kind < 0.91:
                rows.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.93:
                rows.append(f"<table><tr><td>{text}</td></tr></table>")
            elif kind < 0.95:
                rows.append(f"<pre>{text}</pre>")
            elif kind < 0.97:
                rows.append(self.aside(_ADVERT, ["div"], 2, 25, 1))
            elif kind < 0.985:
                rows.append(self.aside(_SIDE, ["aside", "div"], 2, 12))
            else:
                rows.append(self.notice())
        tag = self.draw.choice(["article", "article", "article", "main", "div", "section"])
        named = "" if tag in ("article", "main") and self.draw.random() < 0.6 else self.name(_ARTICLE)
        out = f"<{tag}{named}>{''.join(rows)}</{tag}>"
        if self.draw.random() < 0.15:
            out = f'<div class="{self.draw.choice(["container", "wrapper", "row", "layout", "page"])}">{out}</div>'
        return out

    def nameless(self) -> str:
        """A page whose parts are tables or divisions without telling names: only what stands in
        them, and where, says what they are."""
        draw, chance = self.draw, self.draw.random
        in_table = chance() < 0.4
        menu_first = chance() < 0.7

        # A page made by a program names its parts after nothing at all.
        made_up = [
            draw.choice(["css-{}", "sc-{}", "{}", "jsx-{}", "_{}"]).format(
                "".join(draw.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=draw.randint(1, 5))))
            for _ in range(4)
        ]
        names = made_up if chance() < 0.5 else _PLAIN

        def box(inner: str) -> str:
            if chance() < 0.5:
                return f"<div>{inner}</div>"
            return f"<div{self.name(names)}>{inner}</div>"

        def links(least: int, most: int) -> str:
            texts = [draw.choice([self.word().capitalize(), draw.choice(_MENU_WORDS), self.line(1, 5)])
                     for _ in range(draw.randint(least, most))]
            items = [f'<a href="/{self.word()}">{self.mark(False, text)}</a>' for text in texts]
            return draw.choice([
                "".join(f"<div>{x}</div>" for x in items), "".join(f"{x}<br>" for x in items),
                "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>",
                "".join(f"<p>{x}</p>" for x in items),
            ])

        def paragraph() -> str:
            text = self.mark(True, self.line(4, draw.choice([15, 40, 120])).rstrip(".") + ".")
            named = self.name(names) if chance() < 0.4 else ""
            return box(text) if chance() < 0.5 else draw.choice(
                [f"<p{named}>{text}</p>", f"{text}<br><br>", f"<p{named}>{text}"])

        title = self.mark(True, self.line(2, 9))
        named = self.name(names) if chance() < 0.4 else ""
        article = draw.choice(
            [f"<h1{named}>{title}</h1>", f"<h2>{title}</h2>", f"<div><b>{title}</b></div>", box(title)])
        article += "".join(paragraph() for _ in range(draw.randint(2, 12)))
        menu = links(3, 10)
        aside = "" if chance() < 0.5 else links(2, 6)
        line = draw.choice(_FOOTERS).format(host=f"{self.word()}.example.org", line=self.line(1, 8))
        foot = self.mark(False, draw.choice([line, f"Copyright 2019 {self.word().capitalize()}", "Powered by " + self.word()]))
        top = "" if chance() < 0.4 else self.mark(False, self.line(1, 4).rstrip("."))
        if in_table:
            cells = [f"<td>{menu}</td>", f'<td{draw.choice(["", " width=600", self.name(names)])}>{article}</td>']
            if not menu_first:
                cells.reverse()
            cells += [f"<td>{aside}</td>"] if aside else []
            top = f"<tr><td colspan=3>{top}</td></tr>" if top else ""
            return f"<table>{top}<tr>{''.join(cells)}</tr><tr><td>{foot}</td></tr></table>"
        parts = [box(menu), box(article)] if menu_first else [box(article), box(menu)]
        out = (box(top) if top else "") + "".join(parts) + (box(aside) if aside else "") + box(foot)
        wrapped = draw.choice(["", "", "root", "app", "page", "__next"])
        return f'<div id="{wrapped}">{out}</div>' if wrapped else out

    def html(self) -> str:
        chance = self.draw.random
        head = f"<head><title>{self.mark(False, self.line(2, 10))}</title></head>"
        if chance() < NAMELESS:
            return f"<html>{head}<body>{self.nameless()}</body></html>"
        body = []
        if chance() < 0.3:
            tag = self.draw.choice(["header", "div"])
            named = "" if tag == "header" and chance() < 0.5 else self.name(_HEADER)
            body.append(f"<{tag}{named}>{self.mark(False, self.line(1, 8))}</{tag}>")
        if chance() < 0.9:
            body.append(self.menu())
        if chance() < 0.2:
            body.append(self.notice())
        if chance() < 0.6:
            body.append(self.aside(_ADVERT, ["div", "section"], 2, 25, 1))
        if chance() < 0.2:
            body.append(self.form())
        if chance() < 0.2:
            body.append(self.aside(_SIDE, ["aside", "div"], 1, 15, 6))
        body.append(self.article())
        for likely, part in (
            (0.15, lambda: self.aside(_SHARE, ["div", "ul"], 1, 4)), (0.35, self.comments),
            (0.3, lambda: self.aside(_SIDE, ["aside", "div", "section"], 1, 25, 6)),
            (0.2, self.form), (0.2, lambda: self.aside(_ADVERT, ["div"], 2, 25, 1)),
            (0.15, self.notice),
        ):
            if chance() < likely:
                body.append(part())
        if chance() < 0.9:
            line = self.draw.choice(_FOOTERS).format(host=f"{self.word()}.example.org", line=self.line(1, 14))
            tag = self.draw.choice(["footer", "footer", "div"])
            named = "" if tag == "footer" and chance() < 0.6 else self.name(_FOOTER)
            body.append(f"<{tag}{named}>{self.mark(False, line)}</{tag}>")
        end = "" if chance() < 0.1 else "</body></html>"
        return f"<!DOCTYPE html><html>{head}<body>{''.join(body)}{end}"


def pages(count: int, seed: int = 11) -> Iterator[str]:
    """HTML whose every block begins with `+~` (article) or `-~` (not)."""
    for number in range(count):
        yield _Page(seed * 1_000_003 + number).html()
