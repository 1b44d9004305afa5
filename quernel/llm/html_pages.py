"""Labelled pages for training the page model: page designs of many kinds, written by rule from a fixed seed.

Every block that holds text carries data-label="1" (main text) or "0" (anything else); the trainer reads and removes it.
"""

from __future__ import annotations

import random

_WORDS = (
    "time year people way day man thing woman life child world school state family student group country problem hand part place case week company system program question work "
    "government number night point home water room mother area money story fact month lot right study book eye job word business issue side kind head house service friend father power "
    "hour game line end member law car city community name president team minute idea body information back parent face others level office door health person art war history party result"
).split()
_SMALL = "the of and to in a is that for it was on are as with they be at this have from or by one had not but what all were when we there can".split()


def labelled_pages(n: int = 600, seed: int = 13) -> list[str]:
    r = random.Random(seed)
    pick = r.choice

    def sentence(least: int = 5, most: int = 18) -> str:
        words = [pick(_SMALL if r.random() < 0.5 else _WORDS) for _ in range(r.randint(least, most))]
        return " ".join(words).capitalize() + pick("....!?")

    def prose(k: int) -> str:
        text = " ".join(sentence() for _ in range(k))
        words = text.split()
        if r.random() < 0.4:
            i = r.randrange(len(words))
            words[i] = pick(["<b>{}</b>", "<em>{}</em>", '<a href="/x">{}</a>', "<span>{}</span>"]).format(words[i])
        return " ".join(words)

    def el(tag: str, label: int, inner: str, attrs: str = "") -> str:
        return f'<{tag}{" " + attrs if attrs else ""} data-label="{label}">{inner}</{tag}>'

    def cue(names: list[str]) -> str:
        name = pick(names)
        return pick([f'class="{name}"', f'id="{name}"', f'class="{name} box"', f'class="site-{name}"'])

    def links(k: int) -> str:
        return "<ul>" + "".join(f'<li data-label="0"><a href="/{i}">{pick(_WORDS).title()}{pick(["", " " + pick(_WORDS)])}</a></li>' for i in range(k)) + "</ul>"

    def menu() -> str:
        inner = links(r.randint(3, 9))
        if r.random() < 0.15:
            return inner.replace("<ul>", f'<ul {cue(["menu", "nav", "breadcrumb"])}>')
        return pick([f"<nav>{inner}</nav>", f'<nav {cue(["menu", "main-nav"])}>{inner}</nav>', f'<div {cue(["menu", "nav", "navbar", "breadcrumb"])}>{inner}</div>', f'<div {cue(["menu", "navigation"])} data-label="0">' + " | ".join(f'<a href="/{i}">{pick(_WORDS)}</a>' for i in range(4)) + "</div>"])

    def header() -> str:
        inner = el(pick(["p", "div", "h2", "span"]), 0, f"{pick(_WORDS).title()} {pick(_WORDS)}") + (menu() if r.random() < 0.5 else "")
        return pick([f"<header>{inner}</header>", f'<div {cue(["header", "banner", "masthead", "topbar"])}>{inner}</div>'])

    def footer() -> str:
        inner = pick([el("p", 0, f"&copy; {r.randint(1999, 2030)} {sentence(2, 9)}"), f"<p data-label=\"0\">{sentence(3, 14)}</p>{links(3)}"])
        flat = f"&copy; {pick(_WORDS)}.example.com &middot; {sentence(3, 16)}"
        return pick([f"<footer>{inner}</footer>", f'<div {cue(["footer", "copyright", "legal"])}>{inner}</div>', f'<footer data-label="0">{flat}</footer>'])

    def advert() -> str:
        names = ["ad", "ads", "advert", "promo", "sponsored", "banner-ad", "advertisement"]
        return pick([el("div", 0, sentence(2, 12), cue(names)), f'<div {cue(names)}>{el("p", 0, sentence(3, 14))}</div>', el("aside", 0, sentence(3, 14), cue(names))])

    def notice() -> str:
        names = ["cookie-notice", "notice", "consent", "alert", "popup", "newsletter", "subscribe", "modal"]
        return pick([el("div", 0, prose(r.randint(1, 2)), cue(names)), f'<div {cue(names)}>{el("p", 0, prose(1))}<button>OK</button></div>', el("section", 0, prose(1), cue(names))])

    def hidden() -> str:
        return el(pick(["p", "div"]), 0, prose(r.randint(1, 2)), pick(["hidden", 'style="display:none"', 'aria-hidden="true"']))

    def form() -> str:
        fields = "".join(f'<label data-label="0">{pick(_WORDS).title()} <input name="f{i}"></label>' for i in range(r.randint(1, 4)))
        return f'<form action="/{pick(_WORDS)}" {pick(["", cue(["search", "login", "signup"])])}>{pick(["", el("p", 0, sentence(3, 9))])}{fields}<button>{pick(_WORDS)}</button></form>'

    def sidebar() -> str:
        inner = el("h3", 0, pick(["Related", "Popular", "Archive", "Tags", "More"])) + pick([links(r.randint(2, 7)), el("p", 0, prose(1)), links(3) + el("p", 0, sentence())])
        names = ["sidebar", "related", "widget", "recommended", "side", "secondary", "share", "social"]
        return pick([f"<aside>{inner}</aside>", f'<div {cue(names)}>{inner}</div>', f'<aside {cue(names)}>{inner}</aside>'])

    def comments() -> str:
        one = lambda: el(pick(["p", "div"]), 0, prose(r.randint(1, 3)))
        shape = r.randrange(3)
        if shape == 0:
            inner = "".join(f'<article class="comment">{el("p", 0, pick(_WORDS).title() + " says:")}{one()}</article>' for _ in range(r.randint(1, 5)))
        elif shape == 1:
            inner = '<ol class="commentlist">' + "".join(f"<li class=\"comment\">{one()}</li>" for _ in range(r.randint(1, 5))) + "</ol>"
        else:
            inner = "".join(f'<div class="{pick(["comment", "reply", "comment-body"])}">{one()}</div>' for _ in range(r.randint(1, 5)))
        if r.random() < 0.2:
            return f'<ul {cue(["comments", "replies"])}>' + "".join(el("li", 0, prose(r.randint(1, 2))) for _ in range(r.randint(1, 4))) + "</ul>"
        return pick(["<section {}>{}</section>", "<div {}>{}</div>"]).format(cue(["comments", "comment-section", "replies", "discussion"]), el("h3", 0, pick(["Comments", "Replies"])) + inner)

    def linked_list() -> str:
        item = lambda: pick([f'<a href="/{pick(_WORDS)}">{sentence(1, 4).rstrip(".")}</a>', f'<a href="/x">{pick(_WORDS)}</a> {sentence(3, 9)}'])
        return "<ul>" + "".join(el("li", 1, item()) for _ in range(r.randint(2, 4))) + "</ul>"

    def article_body() -> str:
        title = el("h1", 1, sentence(1, 10).rstrip("."))
        out = [title if r.random() < 0.7 else f"<header>{title}</header>"] if r.random() < 0.85 else []
        if r.random() < 0.2:
            return "".join(out) + "".join(f"<section>{el('h2', 1, sentence(1, 5).rstrip('.'))}{''.join(el('p', 1, prose(r.randint(1, 4))) for _ in range(r.randint(1, 3)))}</section>" for _ in range(r.randint(1, 4)))
        if r.random() < 0.1:
            return "".join(out) + "".join(el("p", 1, sentence(1, 4)) for _ in range(r.randint(1, 3)))
        for _ in range(r.randint(1, 12)):
            x = r.random()
            if x < 0.03:
                out.append(el("p", 1, pick([f"Copyright (c) {r.randint(1999, 2030)} {pick(_WORDS).title()}", "All rights reserved.", f"&copy; {sentence(2, 6)}"])))
            elif x < 0.15:
                out.append(el("p", 1, sentence(1, 3)))
            elif x < 0.20:
                out.append(linked_list())
            elif x < 0.72:
                out.append(el("p", 1, prose(pick([1, 1, 2, 3, 4, 5, 6]))))
            elif x < 0.78:
                out.append(el(pick(["h2", "h3"]), 1, sentence(2, 6).rstrip(".")))
            elif x < 0.84:
                out.append("<ul>" + "".join(el("li", 1, sentence(3, 14)) for _ in range(r.randint(2, 5))) + "</ul>")
            elif x < 0.89:
                out.append(f"<blockquote>{el('p', 1, prose(2))}</blockquote>" if r.random() < 0.5 else el("blockquote", 1, prose(2)))
            elif x < 0.93:
                out.append("<table>" + "".join("<tr>" + "".join(el("td", 1, pick(_WORDS)) for _ in range(3)) + "</tr>" for _ in range(3)) + "</table>")
            elif x < 0.96:
                out.append(f'<figure><img src="a.png">{el("figcaption", 1, sentence())}</figure>')
            elif x < 0.98:
                out.append(el("div", 1, prose(3)))
            else:
                out.append(el("pre", 1, "x = 1\ny = 2"))
        if r.random() < 0.25:
            out.insert(r.randint(0, len(out)), pick([advert, sidebar, form, bare_links, hidden])())
        if r.random() < 0.1:
            out.append(pick([comments, footer])())
        return "".join(out)

    def bare_links() -> str:
        """Links without a telling name."""
        return pick([f"<div>{links(r.randint(2, 6))}</div>", links(r.randint(2, 6)), el("div", 0, " ".join(f'<a href="/{i}">{pick(_WORDS)}</a>' for i in range(r.randint(2, 6)))), el("p", 0, " | ".join(f'<a href="/{i}">{pick(_WORDS)}</a>' for i in range(3)))])

    def bare_footer() -> str:
        return el(pick(["div", "p"]), 0, pick(["&copy; ", "Copyright "]) + f"{r.randint(1999, 2030)} {pick(_WORDS)} {pick(_WORDS)}")

    def article() -> str:
        inner = article_body()
        names = ["content", "article", "post", "entry-content", "story", "main-content", "article-body", "post-body"]
        return pick([
            f"<article>{inner}</article>", f"<article>{inner}</article>", f"<main>{inner}</main>", f"<main><article>{inner}</article></main>", f'<div {cue(names)}>{inner}</div>', f'<section {cue(names)}>{inner}</section>',
            f'<article class="post"><div class="entry-content">{inner}</div></article>', f"<div>{inner}</div>", f"<section>{inner}</section>", f"<div><div>{inner}</div></div>", inner,
        ])

    pages = []
    for _ in range(n):
        before = [f() for f in (header, menu, advert, notice, form, sidebar, bare_links) if r.random() < 0.35]
        after = [f() for f in (comments, sidebar, advert, notice, form, footer, bare_links, bare_footer) if r.random() < 0.35]
        r.shuffle(before)
        body = "".join(before) + article() + "".join(after)
        if r.random() < 0.3:
            body = f'<div {cue(["wrapper", "page", "container", "outer"])}>{body}</div>'
        pages.append(f"<!DOCTYPE html><html><head><title>{sentence()}</title></head><body>{body}</body></html>")
    return pages
