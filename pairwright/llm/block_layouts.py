"""Training pages for the block labeller: texts of given pages, laid out anew with known roles.

``data-keep`` says what a block is: 1 is article text, 0 is everything else;
- is left out of training.
"""

from __future__ import annotations

from html import escape

import numpy as np

# How sites name the parts of a page. A dot stands before class words, a hash before an id.
ARTICLES = ("article", "article.post", "main", "main#content", "div.post-content", "div.entry-content", "div#article-body", "section.story", "div.article", "div.content",
            "div#main", "div.text", "td.content", "section", "div")
HEADERS = ("header", "header.site-header", "div.header", "div#masthead", "div.top-bar", "div#banner", "div")
MENUS = ("nav", "nav.menu", "div.menu", "div#navigation", "ul.navbar", "div.nav-links", "div.topnav", "nav.breadcrumb", "div.breadcrumbs", "div.tabs", "div")
ADVERTS = ("div.ad", "div.ads", "div.advert", "div#ad-slot", "aside.sponsored", "div.promo", "div.banner", "ins.adsbygoogle", "section.promotion", "div.advertisement", "div")
NOTICES = ("div.cookie-banner", "div#cookie-notice", "div.consent", "div.notice", "div.alert", "section.gdpr", "div.popup", "div.paywall", "div.disclaimer", "div.subscribe", "p.notice", "div")
SIDEBARS = ("aside", "aside.sidebar", "div.sidebar", "div#right-column", "div.widget", "div.related", "section.recommended", "div.most-read", "div.tags", "div.share", "ul.social", "div")
FORMS = ("form", "form.search", "form.newsletter", "div.login", "div.signup", "form#contact", "fieldset")
COMMENTS = ("section.comments", "div#comments", "div.comment-list", "ol.commentlist", "div.discussion", "section.responses", "div#disqus", "div.reader-comments", "ul.replies", "div")
FOOTERS = ("footer", "footer.site-footer", "div.footer", "div#footer", "div.copyright", "div.colophon", "div#bottom", "div")
# Words that stand in such parts, in the languages of the tables.
MENU_WORDS = """Home News Sport Politics Business Contact About Login Search Archive Shop Help Start Nachrichten Wirtschaft Kontakt Suche Anmelden Über Accueil Actualités
 Économie Recherche Connexion Inicio Noticias Deportes Contacto Buscar Blog Menu Next Previous More Weiter Suivant Siguiente""".split()
NOTICE_TEXTS = ("We use cookies to improve your experience.", "By using this site you accept our privacy policy.", "Subscribe to our newsletter.", "Wir verwenden Cookies.",
                "Mit der Nutzung stimmen Sie der Datenschutzerklärung zu.", "Nous utilisons des cookies.", "En poursuivant, vous acceptez notre politique.", "Utilizamos cookies.",
                "Acepte nuestra política de privacidad.", "Please enable JavaScript.", "This article is for subscribers only.", "Sign in to continue reading.")
COMMENT_HEADS = ("Comments", "3 comments", "Leave a reply", "Responses", "Kommentare", "12 Kommentare", "Antworten", "Commentaires", "Laisser un commentaire", "Comentarios", "Deja un comentario")
SIDE_HEADS = ("Related articles", "Most read", "More stories", "Tags", "Share", "Mehr zum Thema", "Meistgelesen", "À lire aussi", "Les plus lus", "Más leídas", "Relacionado", "Follow us")
FOOTER_TEXTS = ("© 2024", "All rights reserved.", "Imprint", "Terms of use", "Privacy", "Impressum", "Datenschutz", "Mentions légales", "Aviso legal", "Contact us")
FORM_TEXTS = ("Name", "E-mail", "Your message", "Password", "Send", "Absenden", "Envoyer", "Enviar", "Search", "Suche")


class Layout:
    """One page. ``texts`` are paragraphs of the article, ``others`` texts that stand elsewhere."""

    def __init__(self, random: np.random.Generator, texts: list[str], others: list[str]):
        self.random, self.texts, self.others, self.parts = random, texts, others or ["x"], []
        self.named = random.random() < 0.75  # whether class words say what a part is

    def chance(self, p: float) -> bool:
        return self.random.random() < p

    def one(self, options):
        return options[int(self.random.integers(len(options)))]

    def other(self, words: int) -> str:
        text = self.one(self.others).split()
        at = int(self.random.integers(max(1, len(text) - words)))
        return " ".join(text[at:at + words])

    def opened(self, kinds: tuple[str, ...], keep: str) -> str:
        """The start tag of a part, and the name for its end tag."""
        kind = self.one(kinds)
        if not self.named and self.chance(0.6):
            kind = self.one(("div", "section", "div.x" + str(self.random.integers(1000)), "div.css-" + "".join(self.one("abcdefgh") for _ in range(5))))
        tag, mark, words = kind.partition("." if "." in kind else "#")
        name = f' {"class" if mark == "." else "id"}="{words}"' if words else ""
        extra = f' data-keep="{keep}"' if keep else ""
        self.parts.append(f"<{tag}{name}{extra}>")
        return tag

    def closed(self, tag: str) -> None:
        self.parts.append(f"</{tag}>")

    def put(self, tag: str, text: str, keep: str = "") -> None:
        inner = escape(text, quote=False)
        if self.chance(0.08) and " " in inner:
            first, rest = inner.split(" ", 1)
            inner = f"<b>{first}</b> {rest}"
        mark = f' data-keep="{keep}"' if keep else ""
        self.parts.append(f"<{tag}{mark}>{inner}" + ("" if tag in ("p", "li") and self.chance(0.08) else f"</{tag}>"))

    def links(self, n: int, words: int = 1) -> None:
        """A list of links, as a list or in a row."""
        listed = self.chance(0.7)
        self.parts.append("<ul>" if listed else "<div>")
        for _ in range(n):
            text = escape(self.one(MENU_WORDS) if self.chance(0.5) else self.other(int(self.random.integers(1, words + 2))), quote=False)
            link = f'<a href="/{self.random.integers(99)}">{text}</a>'
            self.parts.append(f"<li>{link}</li>" if listed else f"{link} ")
        self.parts.append("</ul>" if listed else "</div>")

    def prose(self, low: int, high: int) -> str:
        return self.other(int(self.random.integers(low, high)))

    def advert(self) -> None:
        tag = self.opened(ADVERTS, "0")
        for _ in range(int(self.random.integers(1, 3))):
            if self.chance(0.5):
                self.put(self.one(("p", "div", "span")), self.prose(3, 25))
            else:
                self.parts.append(escape(self.prose(3, 25), quote=False))
        self.closed(tag)

    def notice(self) -> None:
        tag = self.opened(NOTICES, "0")
        self.put(self.one(("p", "div", "span")), " ".join(self.one(NOTICE_TEXTS) for _ in range(int(self.random.integers(1, 4)))) if self.chance(0.7) else self.prose(4, 25))
        self.closed(tag)

    def form(self) -> None:
        tag = self.opened(FORMS, "0")
        for _ in range(int(self.random.integers(1, 4))):
            self.put(self.one(("label", "p", "div", "h3")), self.one(FORM_TEXTS) if self.chance(0.7) else self.prose(1, 10))
        self.parts.append('<input type="text"><button>OK</button>')
        self.closed(tag)

    def sidebar(self) -> None:
        tag = self.opened(SIDEBARS, "0")
        if self.chance(0.7):
            self.put(self.one(("h2", "h3", "h4", "div")), self.one(SIDE_HEADS) if self.chance(0.6) else self.prose(1, 6))
        if self.chance(0.7):
            self.links(int(self.random.integers(2, 8)), 6)
        if self.chance(0.5):
            self.put(self.one(("p", "div")), self.prose(5, 30))
        self.closed(tag)

    def comments(self) -> None:
        tag = self.opened(COMMENTS, "0")
        if self.chance(0.85):
            self.put(self.one(("h2", "h3", "h4", "div")), self.one(COMMENT_HEADS))
        for _ in range(int(self.random.integers(1, 6))):
            each = self.opened(("li.comment", "div.comment", "article.comment", "div.reply", "li", "div"), "")
            self.put(self.one(("span", "div", "h4", "cite", "p")), self.prose(1, 4) + self.one(("", " says:", " 12.03.2021", " 3 hours ago", " schrieb", " a dit")))
            for _ in range(int(self.random.integers(1, 3))):
                self.put(self.one(("p", "div")), self.prose(3, 60))
            if self.chance(0.3):
                self.parts.append('<a href="#">Reply</a>')
            self.closed(each)
        self.closed(tag)

    def article(self) -> None:
        wrapped = [self.opened(("main", "div#wrapper", "div.container", "div"), "-")] if self.chance(0.4) else []
        tag = self.opened(ARTICLES, "1")
        title = self.texts[0] if self.texts else self.prose(2, 8)
        if self.chance(0.85):
            inner = self.opened(("header", "div.title"), "1") if self.chance(0.2) else ""
            self.put(self.one(("h1", "h1", "h2")), title[:90])
            if inner:
                self.closed(inner)
        if self.chance(0.15):
            self.put("p", self.other(2) + " 4.5.2020", "-")
        body = self.one(("p", "p", "p", "div"))
        for text in self.texts:
            kind = self.random.random()
            if kind < 0.86:
                self.put(body, text)
            elif kind < 0.90:
                self.put(self.one(("h2", "h3")), " ".join(text.split()[:6]))
            elif kind < 0.94:
                self.parts.append("<ul>")
                for piece in text.split(". ")[:6]:
                    self.put("li", piece)
                self.parts.append("</ul>")
            elif kind < 0.97:
                self.parts.append("<blockquote>")
                self.put("p", text)
                self.parts.append("</blockquote>")
            else:
                self.put(self.one(("pre", "blockquote")), text)
            if self.chance(0.05):
                self.one((self.advert, self.sidebar, self.form, self.notice))()
        if self.chance(0.2):
            self.comments()
        self.closed(tag)
        for each in wrapped:
            self.closed(each)

    def page(self) -> str:
        self.parts.append(f"<!DOCTYPE html><html><head><title>{escape(self.other(4))}</title><script>var x;</script></head><body>")
        outer = self.opened(("div#page", "div.wrapper", "div"), "0") if self.chance(0.4) else ""
        if self.chance(0.5):
            tag = self.opened(HEADERS, "0")
            self.put(self.one(("h1", "div", "p", "span")), self.prose(1, 5))
            if self.chance(0.4):
                self.links(int(self.random.integers(2, 8)))
            self.closed(tag)
        for part, p in ((self.notice, 0.25), (self.menu, 0.75), (self.form, 0.15), (self.advert, 0.5), (self.sidebar, 0.2)):
            if self.chance(p):
                part()
        self.article()
        for part, p in ((self.advert, 0.25), (self.sidebar, 0.4), (self.comments, 0.4), (self.form, 0.2), (self.menu, 0.1), (self.footer, 0.85), (self.notice, 0.15)):
            if self.chance(p):
                part()
        if outer:
            self.closed(outer)
        return "".join(self.parts) + ("</body></html>" if self.chance(0.9) else "")

    def menu(self) -> None:
        tag = self.opened(MENUS, "0")
        self.links(int(self.random.integers(2, 10)))
        self.closed(tag)

    def footer(self) -> None:
        tag = self.opened(FOOTERS, "0")
        kind = self.random.random()
        if kind < 0.4:
            self.links(int(self.random.integers(1, 8)))
        if kind > 0.2:
            text = " · ".join([self.one(FOOTER_TEXTS), self.prose(1, 14)])
            self.parts.append(escape(text) if self.chance(0.5) else f"<p>{escape(text)}</p>")
        self.closed(tag)


def labelled_page(random: np.random.Generator, texts: list[str], others: list[str]) -> str:
    """A page around the paragraphs ``texts``, with roles as ``data-keep``."""
    return Layout(random, texts, others).page()
