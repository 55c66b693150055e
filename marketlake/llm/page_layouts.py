"""Labelled pages to fit the block labeller on: layouts of the web with invented text.

Every page mixes an article with some of what surrounds articles (menus, headers, notices, adverts, sidebars, forms, comments, footers). The
text of both is made of syllables drawn anew for each page, so the labeller learns paths, shapes, places and the usual phrases, and not a vocabulary.
"""

from __future__ import annotations

import random

#: Starts each main block's text while a page is labelled.
MARK = ""

CONTENT_HINTS = (
    "content", "main-content", "post", "post-body", "entry-content", "article-body", "story", "text", "article__content", "page-content",
    "blog-post", "news-text", "td-post-content", "mw-parser-output", "document",
)
PLAIN_HINTS = ("container", "wrapper", "row", "col-md-8", "inner", "css-1x2y3", "grid", "box", "section", "layout", "page", "site", "block")
SHORT = {
    "menu": ("Home", "About us", "Contact", "News", "Products", "Blog", "Archive", "Search", "Sitemap", "Impressum", "Accueil", "Inicio", "Startseite", "FAQ"),
    "login": ("Log in", "Sign up", "Register", "My account", "Anmelden", "Connexion", "Iniciar sesión", "Forgot password?"),
    "share": ("Share", "Tweet", "Print", "Email this", "Facebook", "Teilen", "Partager", "Compartir", "Copy link"),
    "related": ("Related articles", "You may also like", "Popular posts", "Recent posts", "Most read", "Mehr zum Thema", "À lire aussi", "Tags", "Categories"),
    "comments": ("Comments", "3 comments", "Leave a reply", "Discussion", "Kommentare", "Commentaires", "Comentarios", "Reader comments"),
    "reply": ("Reply", "Report", "Like", "Antworten", "Répondre", "Responder", "Permalink"),
    "page": ("Next", "Previous", "Older posts", "Back to top", "Weiter", "Suivant", "Siguiente", "1", "2", "3"),
    "advert": ("Advertisement", "Sponsored", "Buy now", "Anzeige", "Publicité", "Publicidad", "Special offer", "Click here"),
}
NOTICES = (
    "We use cookies to improve your experience.", "By continuing you accept our privacy policy.", "Please enable JavaScript to view this page.",
    "Diese Website verwendet Cookies.", "Ce site utilise des cookies.", "Este sitio utiliza cookies.", "You have read 3 free articles this month.",
    "Subscribe to our newsletter.", "This site is no longer updated.", "Accept all", "Your browser is out of date.",
)
FOOTERS = (
    "All rights reserved.", "Terms of use", "Privacy policy", "Powered by", "Alle Rechte vorbehalten.", "Tous droits réservés.", "Datenschutz",
    "Mentions légales", "Aviso legal", "Imprint",
)
FIELDS = ("Name", "Email address", "Message", "Password", "Your comment", "Search", "Subject")


class Page:
    """One invented page: ``html`` in which each main block begins with MARK."""

    def __init__(self, seed: int):
        r = self.r = random.Random(seed)
        letters = "abcdefghijklmnoprstuvwzéèêçöäüßñóá"
        self.syllables = ["".join(r.choice(letters) for _ in range(r.randint(1, 4))) for _ in range(r.randint(10, 40))]
        self.common = [self.word() for _ in range(r.randint(4, 30))]
        self.tail = r.choice(["", "", "", "", "", "***", "%%%", "&amp;&amp;", "###"])
        self.hints = r.random() < 0.85  # whether containers have telling classes
        self.shift = r.random() < 0.75  # whether blocks are in containers of their own
        self.html = self.page()

    def word(self) -> str:
        return "".join(self.r.choice(self.syllables) for _ in range(self.r.randint(1, 4)))

    def sentence(self, short: bool = False) -> str:
        r = self.r
        words = [r.choice(self.common) if r.random() < 0.4 else self.word() for _ in range(r.randint(2, 5) if short else r.choice((1, 2, 3, *range(3, 23))))]
        text = " ".join(w + (self.tail if self.tail and r.random() < 0.6 else "," if r.random() < 0.08 else "") for w in words)
        return text[:1].upper() + text[1:] + ("" if r.random() < 0.08 else ".")

    def paragraph(self) -> str:
        r = self.r
        out = " ".join(self.sentence() for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9])))
        if r.random() < 0.15:
            out += f' <a href="/{self.word()}">{self.word()}</a> {self.sentence()}'
        return out

    def pick(self, kind: str) -> str:
        return self.r.choice(SHORT[kind]) if self.r.random() < 0.7 else self.sentence(short=True).rstrip(".")

    def element(self, body: str, tags: tuple, hints: tuple) -> str:
        """``body`` in an element whose name or class tells what it is, or in a plain one."""
        r = self.r
        if self.hints == "sure" or (self.hints and r.random() < 0.95):
            tag = r.choice(tags)
            hint = r.choice(hints) if tag in ("div", "section", "ul", "td", "p") or r.random() < 0.4 else ""
            kind = r.choice(["class", "class", "id"])
            return f'<{tag} {kind}="{hint}">{body}</{tag}>' if hint else f"<{tag}>{body}</{tag}>"
        return f'<div class="{r.choice(PLAIN_HINTS)}">{body}</div>' if r.random() < 0.7 else f"<div>{body}</div>"

    def links(self, kind: str, few: int, many: int) -> str:
        items = [f'<a href="/{self.word()}">{self.pick(kind)}</a>' for _ in range(self.r.randint(few, many))]
        how = self.r.random()
        if how < 0.75:
            return "<ul>" + "".join(f"<li>{x}</li>" if self.r.random() < 0.9 else f"<li>{x}" for x in items) + "</ul>"
        return " | ".join(items) if how < 0.9 else "".join(f"<span>{x}</span> " for x in items)

    def advert(self) -> str:
        body = self.pick("advert") if self.r.random() < 0.4 else " ".join(self.sentence() for _ in range(self.r.randint(1, 3)))
        if self.r.random() < 0.5:
            body = f"<p>{body}</p>"
        out = self.element(body, ("div", "div", "aside", "section", "ins"), ("ad", "ads", "advert", "sponsored", "promo", "banner", "ad-slot", "adsbygoogle"))
        return (f"<!-- ad {self.r.randint(0, 99)} -->" if self.r.random() < 0.3 else "") + out

    def notice(self) -> str:
        body = "".join(f"<p>{self.r.choice(NOTICES)} {self.sentence() if self.r.random() < 0.4 else ''}</p>" for _ in range(self.r.randint(1, 2)))
        if self.r.random() < 0.3:
            return f"<noscript>{body}</noscript>"
        return self.element(body, ("div", "section", "aside"), ("cookie-notice", "notice", "alert", "consent", "gdpr-banner", "message", "paywall"))

    def form(self) -> str:
        fields = "".join(f'<label>{self.r.choice(FIELDS)}</label><input type="text">' for _ in range(self.r.randint(1, 3)))
        lead = f"<p>{self.r.choice(NOTICES) if self.r.random() < 0.5 else self.sentence()}</p>" if self.r.random() < 0.6 else ""
        return f'<form action="/{self.word()}">{lead}{fields}<button>{self.pick("login")}</button></form>'

    def sidebar(self) -> str:
        parts = [f"<h3>{self.pick('related')}</h3>{self.links('menu', 2, 6)}"]
        if self.r.random() < 0.5:
            parts.append(f"<h4>{self.sentence(short=True)}</h4><p>{self.paragraph()}</p>")
        return self.element("".join(parts), ("aside", "div", "section"), ("sidebar", "widget", "related", "recommended", "widget-area", "rail", "secondary"))

    def comments(self) -> str:
        self.hints, before = "sure", self.hints
        items = []
        for _ in range(self.r.randint(1, 6)):
            who = f"<span>{self.word()}</span> <time>{self.r.randint(1, 28)}.{self.r.randint(1, 12)}.2024</time>"
            text = "".join(f"<p>{self.paragraph()}</p>" for _ in range(self.r.randint(1, 3)))
            items.append(f'<li class="comment"><div class="{self.r.choice(("comment-meta", "author"))}">{who}</div>{text}<a href="#r">{self.pick("reply")}</a></li>')
        body = f"<h3>{self.r.choice(SHORT['comments'])}</h3><ol>{''.join(items)}</ol>"
        if self.r.random() < 0.3:
            body = body.replace("<ol>", "<div>").replace("</ol>", "</div>").replace("<li ", "<div ").replace("</li>", "</div>")
        out = self.element(body, ("section", "div", "div"), ("comments", "comment-list", "comments-area", "discussion", "disqus_thread", "respond"))
        self.hints = before
        return out + (self.form() if self.r.random() < 0.4 else "")

    def head(self) -> str:
        body = "".join(
            [f"<h1>{self.sentence(short=True)}</h1>" if self.r.random() < 0.3 else f"<p>{self.sentence(short=True)}</p>" if self.r.random() < 0.5 else "",
             self.links("login", 1, 3) if self.r.random() < 0.5 else "", self.form() if self.r.random() < 0.2 else ""]
        )
        return self.element(body, ("header", "header", "div"), ("header", "masthead", "top-bar", "site-header", "branding"))

    def menu(self) -> str:
        return self.element(self.links("menu", 3, 9), ("nav", "nav", "div", "ul"), ("nav", "menu", "navigation", "navbar", "breadcrumb", "topnav"))

    def foot(self) -> str:
        r = self.r
        parts = [f"&copy; {self.word()}.example.com {r.choice(['&middot;', '-', '2024'])} {self.sentence()}", r.choice(FOOTERS), self.links("menu", 2, 5), f"<p>{self.sentence()}</p>"]
        return self.element(" ".join(r.sample(parts, r.randint(1, 3))), ("footer", "footer", "div"), ("footer", "site-footer", "copyright", "colophon", "legal"))

    def share(self) -> str:
        return self.element(self.links("share", 2, 5), ("div", "ul"), ("share", "social", "sharing-buttons", "toolbar", "tags"))

    def main(self) -> str:
        r, out = self.r, []
        title = self.sentence(short=r.random() < 0.6)
        if r.random() < 0.85:
            out.append(f"<h1>{MARK}{title}</h1>")
        loose = r.random() < 0.15  # text between line breaks instead of paragraphs
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 12, 20, 30])):
            kind = r.random()
            if kind < 0.07:
                out.append(f"<h2>{MARK}{self.sentence(short=True).rstrip('.')}</h2>")
            elif kind < 0.11:
                out.append("<ul>" + "".join(f"<li>{MARK}{self.sentence()}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.14:
                out.append(f"<blockquote>{MARK}{self.paragraph()}</blockquote>")
            elif kind < 0.16:
                out.append("<table>" + "".join(f"<tr><td>{MARK}{self.word()}</td><td>{MARK}{r.randint(1, 999)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
            elif kind < 0.28:
                out.append(f"<p><b>{MARK}{self.paragraph()}<br>")
            elif kind < 0.31:
                self.hints, before = "sure", self.hints  # without a telling name nobody can tell these from the article
                out.append(self.advert() if r.random() < 0.7 else self.share())
                self.hints = before
            else:
                text = f"{self.word().title()}." if r.random() < 0.12 else self.paragraph()
                out.append(f"<div>{MARK}{text}</div>" if loose else f"<p>{MARK}{text}</p>")
        if r.random() < 0.2:
            out.append(self.share())
        body, how = "".join(out), r.random()
        if how < 0.45:
            body = f"<article>{body}</article>" if r.random() < 0.7 else f"<main><article>{body}</article></main>"
        elif how < 0.55:
            body = f"<main>{body}</main>"
        elif how < 0.85:
            body = f'<{(t := r.choice(("div", "div", "section")))} {r.choice(("class", "id"))}="{r.choice(CONTENT_HINTS)}">{body}</{t}>'
        elif how < 0.95:
            body = f'<div class="{r.choice(PLAIN_HINTS)}">{body}</div>'
        return body

    def page(self) -> str:
        r = self.r
        before = [f for f, share in ((self.notice, 0.2), (self.head, 0.5), (self.menu, 0.85), (self.advert, 0.5), (self.sidebar, 0.12)) if r.random() < share]
        after = [f for f, share in ((self.share, 0.2), (self.sidebar, 0.3), (self.advert, 0.25), (self.comments, 0.3), (self.form, 0.15), (self.notice, 0.1)) if r.random() < share]
        if r.random() < 0.3:
            r.shuffle(before)
        r.shuffle(after)
        middle = [self.main] if r.random() < 0.97 else []
        body = "".join(f() for f in [*before, *middle, *after])
        if r.random() < 0.9:
            body += self.foot()
        if r.random() < 0.4:
            body = f'<div class="{r.choice(PLAIN_HINTS)}">{body}</div>'
        title = f"<title>{self.sentence()}</title>"
        head = f'<head><meta charset="utf-8">{title}<style>p{{margin:0}}</style><script>var t="</p>";</script></head>'
        return f'<!DOCTYPE html><html lang="en">{head}<body>{body}' + ("</body></html>" if r.random() < 0.85 else "")
