"""Labelled pages for the extraction field: layouts written out with what their article is.

Pages are drawn from a seed: containers with the customary tags and names (or
none that tell anything), paragraphs from one word to many, in any case and
with any signs, so that what decides is where a block stands before what it
says.
"""

from __future__ import annotations

import random

#: Names that sites give to the parts of a page.
MAIN_NAMES = ["content", "main", "post", "entry", "article-body", "story", "post-content", "entry-content", "text", "body-copy", "page"]
PART_NAMES = {
    "nav": ["nav", "menu", "navbar", "main-menu", "breadcrumb", "top-nav", "links", "pagination", "tabs"],
    "header": ["header", "masthead", "site-header", "branding", "topbar", "banner", "logo"],
    "footer": ["footer", "site-footer", "copyright", "legal", "bottom", "colophon"],
    "aside": ["sidebar", "aside", "widget", "related", "recommended", "trending", "most-read", "tags", "author-box", "share", "social"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "adsbox", "partner"],
    "notice": ["cookie", "cookie-banner", "consent", "notice", "alert", "popup", "modal", "gdpr", "paywall", "newsletter", "subscribe"],
    "form": ["search", "login", "signup", "contact-form", "subscribe-form"],
    "comments": ["comments", "comment-list", "discussion", "responses", "replies", "disqus"],
}
PHRASES = {
    "nav": ["Home", "About", "News", "Contact", "Next", "Previous", "Sports", "Archive", "Products", "Login"],
    "header": ["Daily News", "Welcome", "Skip to content", "The Times", "My Blog", "Search"],
    "footer": ["© 2024 Example", "All rights reserved.", "Privacy Policy", "Terms of use", "Imprint", "Powered by", "© example.com · "],
    "aside": ["Related articles", "Most popular", "Share this", "Tags:", "About the author", "Read more", "Follow us"],
    "ad": ["Advertisement", "Sponsored", "Buy now!", "Special offer", "Shop the sale", "Limited time only"],
    "notice": ["We use cookies.", "Accept all", "By continuing you agree to our policy.", "Subscribe to our newsletter", "Sign up today"],
    "form": ["Email", "Password", "Send", "Search", "Your name", "Submit"],
    "comments": ["Comments", "Reply", "Posted by", "Leave a comment", "says:", "3 replies", "Report", "Great post, thanks!"],
}
_SYLLABLES = "the an er re on in tion ch le qu os de as sch und en ment eau ado ion ou th ha st ui lo ma ti ne so ra".split()


def _word(r: random.Random) -> str:
    return "".join(r.choice(_SYLLABLES) for _ in range(r.choice((1, 1, 2, 2, 3, 4))))


def _sentence(r: random.Random, most: int = 18) -> str:
    return " ".join(_word(r) for _ in range(r.randint(1, most))).capitalize() + r.choice(("", ".", ".", ".", "?", "!"))


def _paragraph(r: random.Random, style: int) -> str:
    text = " ".join(_sentence(r) for _ in range(r.choice((1, 1, 1, 2, 3, 6))))
    if style == 1:
        text = text.upper().replace(" ", "!! ") + "!!"
    elif style == 2:
        text = " ".join(w + r.choice(("***", "###", "$$$", "%%%", "&amp;&amp;&amp;")) for w in text.split())
    elif style == 3:
        text = " | ".join(text.split())
    return text


def _opened(r: random.Random, tag: str, names: list[str]) -> str:
    name = r.choice(names)
    kind = r.random()
    if kind < 0.55:
        return f'<{tag} class="{name}">'
    if kind < 0.75:
        return f'<{tag} id="{name}">'
    if kind < 0.85:
        return f'<{tag} class="x{r.randint(1, 99)} {name} y">'
    return f"<{tag}>"


def _part(r: random.Random, kind: str) -> str:
    """A part of the page that is not its article."""
    semantic = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
    tag = semantic if semantic and r.random() < 0.6 else r.choice(("div", "div", "section"))
    opened = f"<{tag}>" if tag == semantic and r.random() < 0.5 else _opened(r, tag, PART_NAMES[kind])
    if tag in ("div", "section") and "=" not in opened:
        opened = f'<{tag} class="{r.choice(PART_NAMES[kind])}">'

    def phrase() -> str:
        roll = r.random()
        if roll < 0.45:
            return r.choice(PHRASES[kind])
        if roll < 0.6:
            return f"{r.choice(PHRASES[kind])} {_sentence(r, 8)}"
        return _paragraph(r, 0) if kind in ("ad", "footer", "comments", "aside") else _sentence(r, 6)

    n = r.randint(1, 7)
    if kind in ("nav", "aside") and r.random() < 0.7:
        inner = "<ul>" + "".join(f'<li><a href="/{i}">{_word(r) if r.random() < 0.6 else phrase()}</a></li>' for i in range(n)) + "</ul>"
    elif kind == "form":
        inner = "".join(f"<label>{phrase()}</label><input name='q'>" for _ in range(n)) + f"<button>{phrase()}</button>"
    elif kind == "comments":
        item = r.choice(("li", "div", "article"))
        inner = f"<h3>{phrase()}</h3>" + "".join(f'<{item} class="comment"><p>{_word(r)}</p><p>{_paragraph(r, 0)}</p></{item}>' for _ in range(n))
    elif r.random() < 0.4:
        inner = phrase()
    else:
        inner = "".join(r.choice((f"<p>{phrase()}</p>", f"<div>{phrase()}</div>", f'<a href="#">{phrase()}</a> ', f"<span>{phrase()}</span><br>")) for _ in range(min(n, 3)))
    return f"{opened}{inner}</{tag}>"


def _article(r: random.Random) -> str:
    """The article, its blocks marked by a \\x02 before the text of each."""
    style = r.choice((0, 0, 0, 1, 2, 3))
    out, sloppy = [], r.random() < 0.5
    if r.random() < 0.85:
        out.append(f"<h1>\x02{_sentence(r, 9)}</h1>")
    for _ in range(r.choice((1, 2, 3, 5, 8, 14))):
        roll, text = r.random(), _paragraph(r, style)
        if r.random() < 0.12:  # an article may say what other parts say, too
            text = r.choice(PHRASES[r.choice(list(PHRASES))])
        if roll < 0.68:
            out.append(f"<p>\x02{text}" + ("" if sloppy and r.random() < 0.3 else "</p>"))
        elif roll < 0.74:
            out.append(f"<p><b>\x02{text}<br>")
        elif roll < 0.80:
            out.append(f"<h2>\x02{_sentence(r, 6)}</h2>")
        elif roll < 0.86:
            list_ = r.choice(("ul", "ol"))
            out.append(f"<{list_}>" + "".join(f"<li>\x02{_sentence(r)}" + r.choice(("</li>", "")) for _ in range(r.randint(1, 5))) + f"</{list_}>")
        elif roll < 0.90:
            out.append(f"<blockquote>\x02{text}</blockquote>")
        elif roll < 0.94:
            out.append("<table>" + "".join(f"<tr><td>\x02{_word(r)}</td><td>\x02{_sentence(r, 4)}</td></tr>" for _ in range(r.randint(1, 3))) + "</table>")
        elif roll < 0.97:
            out.append(f'<p>\x02{_sentence(r)} <a href="/x">{_word(r)}</a> {_sentence(r)}</p>')
        else:
            out.append(f"<div>\x02{text}</div>")
        if r.random() < 0.06:
            out.append(_part(r, r.choice(("ad", "aside"))))
    return "".join(out)


def labelled_page(r: random.Random) -> str:
    body = []
    for kind, chance in (("notice", 0.25), ("header", 0.5), ("nav", 0.75), ("form", 0.15), ("ad", 0.4), ("aside", 0.2)):
        if r.random() < chance:
            body.append(_part(r, kind))
    frame = r.random()
    article = _article(r)
    if frame < 0.45:
        tag = r.choice(("article", "article", "main"))
        article = f"<{tag}>{article}</{tag}>"
    elif frame < 0.6:
        article = f"<main>{_opened(r, 'article', MAIN_NAMES)}{article}</article></main>"
    elif frame < 0.9:
        article = f"{_opened(r, r.choice(('div', 'section')), MAIN_NAMES)}{article}</div>"
    body.append(article)
    for kind, chance in (("ad", 0.2), ("comments", 0.35), ("aside", 0.35), ("notice", 0.15), ("form", 0.1), ("footer", 0.85)):
        if r.random() < chance:
            body.append(_part(r, kind))
    if r.random() < 0.3:
        body = [f'<div class="wrapper" id="page">{"".join(body)}</div>']
    return f"<!DOCTYPE html><html><head><title>{_sentence(r)}</title><script>var a='<p>';</script></head><body>{''.join(body)}</body></html>"


def labelled_pages(n: int, seed: int = 17) -> list[str]:
    r = random.Random(seed)
    return [labelled_page(r) for _ in range(n)]
