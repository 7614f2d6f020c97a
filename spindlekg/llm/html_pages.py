"""Labelled pages to train the extraction model on, made by rule from a seed: every page shape is drawn anew.

Words are drawn from syllables, so the model cannot learn any; what it can learn is structure.
"""

from __future__ import annotations

import random

SYLLABLES = ("ka", "to", "mi", "re", "lun", "sor", "ve", "da", "pil", "no", "gra", "esh", "ur", "tin", "bo", "cal", "é", "ü", "ña", "ost")
#: Class and id names as web pages in English, German, French and Spanish use them; fixed values.
NAMES = {
    "nav": ("nav", "menu", "navbar", "main-nav", "site-menu", "breadcrumbs", "breadcrumb", "topnav", "pagination", "toc", "navigation", "hauptmenue", "navegacion", "menue", "brotkrumen", "menu-principal"),
    "head": ("header", "site-header", "masthead", "top", "page-header", "branding", "kopfzeile", "kopf", "entete", "en-tete", "cabecera", "encabezado"),
    "foot": ("footer", "site-footer", "colophon", "bottom", "copyright", "legal", "fusszeile", "fussbereich", "impressum", "pied", "pied-de-page", "pie", "pie-de-pagina"),
    "side": ("sidebar", "aside", "widget", "side", "rail", "related", "recommended", "tags", "popular", "author-box", "seitenleiste", "randspalte", "barre-laterale", "lateral", "barra-lateral", "articles-lies", "relacionados"),
    "ad": ("ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo", "ad-slot", "sponsor", "werbung", "anzeige", "publicite", "pub", "publicidad", "anuncio"),
    "note": ("cookie-notice", "cookie", "notice", "consent", "alert", "gdpr", "popup", "modal", "newsletter", "subscribe", "disclaimer", "share", "social", "hinweis", "meldung", "avis", "avertissement", "aviso", "notificacion"),
    "form": ("form", "search", "search-form", "login", "signup", "contact-form", "suche", "anmeldung", "formular", "recherche", "formulaire", "connexion", "buscar", "formulario"),
    "talk": ("comments", "comment", "comment-list", "responses", "replies", "discussion", "comments-area", "reader-comments", "kommentare", "leserkommentare", "commentaires", "commentaire", "comentarios", "comentario", "opiniones"),
    "body": ("content", "article", "post", "entry-content", "main", "story", "article-body", "post-content", "text", "body-text", "inhalt", "artikel", "beitrag", "contenu", "texte", "contenido", "articulo", "cuerpo"),
}


class Page:
    """html, and in order the words of each labelled piece of text. unknown: the share of names that are made up, so that
    structure has to tell."""

    def __init__(self, seed: int, unknown: float = 0.25):
        self.rng, self.unknown = random.Random(seed), unknown
        self.out: list[str] = []
        self.content: set[str] = set()
        self.n = 0

    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(3, 22).capitalize() + self.rng.choice(".....!?") for _ in range(self.rng.randint(low, high)))

    def say(self, text: str, good: bool) -> str:
        """The text with a mark of its own, by which its block is labelled."""
        self.n += 1
        mark = f"q{self.n}{'g' if good else 'b'}q"
        return f"{mark} {text}"

    def names(self, kind: str) -> str:
        name = self.word() + self.word() if self.rng.random() < self.unknown else self.rng.choice(NAMES[kind])
        return self.rng.choice((f' class="{name}"', f' id="{name}"', f' class="x {name} wide"', f' id="{name}" class="box"'))

    def links(self, many: int) -> str:
        return "".join(f'<li><a href="/{self.word()}">{self.say(self.words(1, 3), False)}</a></li>' for _ in range(many))

    def boilerplate(self, kind: str) -> str:
        r = self.rng
        if kind == "nav":
            inner = f"<ul>{self.links(r.randint(2, 9))}</ul>" if r.random() < 0.8 else " | ".join(f'<a href="/{self.word()}">{self.say(self.words(1, 2), False)}</a>' for _ in range(4))
            return f"<nav>{inner}</nav>" if r.random() < 0.5 else f"<div{self.names('nav')}>{inner}</div>"
        if kind == "head":
            inner = f"<{(h := r.choice(('h1', 'h2', 'p', 'div')))}>{self.say(self.words(1, 4), False)}</{h}>" + (f"<p>{self.say(self.words(3, 9), False)}</p>" if r.random() < 0.5 else "")
            return f"<header>{inner}</header>" if r.random() < 0.5 else f"<div{self.names('head')}>{inner}</div>"
        if kind == "foot":
            inner = r.choice((f"&copy; {self.say(self.sentences(1, 2), False)}", f"<p>{self.say(self.sentences(1, 2), False)}</p>", f"<ul>{self.links(4)}</ul><p>&copy; {self.say(self.words(2, 6), False)}</p>"))
            return f"<footer>{inner}</footer>" if r.random() < 0.5 else f"<div{self.names('foot')}>{inner}</div>"
        if kind == "side":
            inner = r.choice((f"<h3>{self.say(self.words(1, 3), False)}</h3><ul>{self.links(r.randint(2, 6))}</ul>", f"<p>{self.say(self.sentences(1, 3), False)}</p>", f"<h4>{self.say(self.words(1, 3), False)}</h4><p>{self.say(self.sentences(1, 4), False)}</p>"))
            return f"<aside>{inner}</aside>" if r.random() < 0.45 else f"<{(t := r.choice(('div', 'section', 'aside')))}{self.names('side')}>{inner}</{t}>"
        if kind in ("ad", "note"):
            text = self.say(self.sentences(1, 4), False)
            inner = r.choice((text, f"<p>{text}</p>", f'<p>{text}</p><a href="/x">{self.say(self.words(1, 3), False)}</a>', f"<span>{text}</span>"))
            return f"<{(t := r.choice(('div', 'div', 'section', 'p' if inner == text else 'div')))}{self.names(kind)}>{inner}</{t}>"
        if kind == "form":
            inner = f"<label>{self.say(self.words(1, 4), False)}</label><input name=q><p>{self.say(self.sentences(1, 2), False)}</p><button>{self.say(self.word(), False)}</button>"
            return f"<form action=/s>{inner}</form>" if r.random() < 0.7 else f"<div{self.names('form')}><form>{inner}</form></div>"
        items = "".join(r.choice((f"<li><b>{self.say(self.word(), False)}</b><p>{self.say(self.sentences(1, 5), False)}</p></li>", f'<div class="comment"><p>{self.say(self.sentences(1, 5), False)}</p></div>', f"<article{self.names('talk')}><p>{self.say(self.sentences(1, 5), False)}</p></article>", f"<{(e := r.choice(('article', 'div', 'li')))}><p>{self.say(self.sentences(1, 5), False)}</p></{e}>")) for _ in range(r.randint(1, 5)))
        inner = f"<h3>{self.say(self.words(1, 3), False)}</h3>{items}"
        return f"<{(t := r.choice(('section', 'div', 'ol')))}{self.names('talk')}>{inner}</{t}>"

    def block(self, plain: bool) -> str:
        r, x = self.rng, self.rng.random()
        text = self.say(self.sentences(1, 6) if x < 0.9 else self.words(1, 4), True)
        if r.random() < 0.2:
            text = f'{text} <a href="/{self.word()}">{self.words(1, 4)}</a> {self.words(0, 9)}.'
        if plain or x < 0.62:
            return f"<p>{text}</p>" if r.random() < 0.85 else f"<p><b>{text}<br><p>{self.say(self.sentences(1, 3), True)}</p>"
        if x < 0.72:
            return f"<h{(h := r.randint(2, 4))}>{self.say(self.words(1, 7), True)}</h{h}>"
        if x < 0.80:
            return "<ul>" + "".join(f"<li>{self.say(self.sentences(1, 2) if r.random() < 0.6 else self.words(1, 6), True)}</li>" for _ in range(r.randint(1, 5))) + "</ul>"
        if x < 0.86:
            return f"<blockquote><p>{text}</p></blockquote>" if r.random() < 0.6 else f"<blockquote>{text}</blockquote>"
        if x < 0.90:
            return f"<pre>{text}</pre>"
        if x < 0.94:
            return "<table>" + "".join(f"<tr><td>{self.say(self.words(1, 3), True)}</td><td>{self.say(self.words(1, 5), True)}</td></tr>" for _ in range(r.randint(1, 3))) + "</table>"
        if x < 0.97:
            return f"<figure><img src=a.png><figcaption>{text}</figcaption></figure>"
        return f"<div>{text}</div>"

    def article(self) -> str:
        r = self.rng
        blocks = [f"<h1>{self.say(self.words(1, 9), True)}</h1>"] if r.random() < 0.8 else []
        plain = r.random() < 0.5
        blocks += [self.block(plain) for _ in range(r.choice((1, 1, 2, 3, 5, 8, 13)))]
        if r.random() < 0.25:
            blocks.insert(r.randint(0, len(blocks)), self.boilerplate(r.choice(("ad", "side", "note", "nav"))))
        inner = "".join(blocks)
        if r.random() < 0.15:
            inner = f"<header>{blocks[0]}</header>" + "".join(blocks[1:]) if blocks[0].startswith("<h1>") else inner
        x = r.random()
        if x < 0.45:
            return f"<article>{inner}</article>"
        if x < 0.6:
            return f"<main>{inner}</main>"
        if x < 0.85:
            return f"<div{self.names('body')}>{inner}</div>"
        return f"<main><article{self.names('body')}>{inner}</article></main>" if x < 0.95 else inner

    def html(self) -> str:
        r = self.rng
        before = [self.boilerplate(k) for k in ("note", "head", "nav", "ad", "form", "side") if r.random() < 0.4]
        after = [self.boilerplate(k) for k in ("ad", "side", "talk", "note", "form", "foot", "nav") if r.random() < 0.4]
        r.shuffle(before)
        middle = self.article()
        if r.random() < 0.25:
            middle = f'<div class="{r.choice(("container", "wrapper", "row", "page"))}">{middle}{"".join(after)}</div>'
            after = []
        page = "".join([*before, middle, *after])
        if r.random() < 0.1:
            page = page[: int(len(page) * r.uniform(0.6, 1))]
        return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{page}</body></html>"
