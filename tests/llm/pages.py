"""Pages of many layouts, labelled by hand: elements of the main text carry the attribute data-main. And a
parser of its own for their texts.
"""

from __future__ import annotations

from html.parser import HTMLParser

_BREAKS = set(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_HIDDEN = {"script", "style", "title", "textarea", "iframe", "select", "svg", "template", "object", "head", "noscript"}


class Plain(HTMLParser):
    """The texts between block borders of a well-formed page, and whether each stands in a data-main element."""

    def __init__(self, page: str) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, bool]] = []
        self.text, self.hidden, self.open, self.main = "", [], [], False
        self.feed(page)
        self.close()
        self.flush()

    def flush(self) -> None:
        if self.text.split():
            self.found.append((" ".join(self.text.split()), self.main))
        self.text = ""
        self.main = any(m for _, m in self.open)

    def handle_starttag(self, tag, attrs) -> None:
        if tag in _HIDDEN:
            self.hidden.append(tag)
        if tag in ("br",):
            self.text += " "
        if tag in _BREAKS:
            self.flush()
            if tag in ("p", "li"):
                self.end(tag, {"ul", "ol", "div", "article", "section", "td", "blockquote"})
        if tag not in ("br", "img", "input", "hr", "meta", "link", "wbr", "path"):
            self.open.append((tag, any(k == "data-main" for k, _ in attrs)))
        if any(k == "data-main" for k, _ in attrs):
            self.main = True

    def end(self, tag, until=()) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return
            if self.open[i][0] in until:
                return

    def handle_endtag(self, tag) -> None:
        if self.hidden and tag == self.hidden[-1]:
            self.hidden.pop()
        if tag in _BREAKS:
            self.flush()
        self.end(tag)
        if tag in _BREAKS:
            self.main = any(m for _, m in self.open)

    def handle_data(self, data) -> None:
        if not self.hidden:
            self.text += data


def marked(page: str) -> list[str]:
    """The lines of the main text, as labelled."""
    return [text for text, main in Plain(page).found if main]


LONG = (
    "The river had risen during the night, and by the morning the lower fields were under water. "
    "Nobody had seen anything like it for forty years, the old men said, and they ought to know."
)
MORE = "Two of the bridges were closed before noon, which cut the village off from the road to the coast."
LAST = "By the end of the week the water had gone, and what it left behind took a month to clear away."
COMMENT = "I was there myself and I can tell you that it was much worse than that. The council did nothing, as always."

PAGES = {
    "blog with speaking body classes": f"""<!DOCTYPE html><html><head><title>t</title></head>
<body class="home comments-open has-sidebar"><div id="page" class="site no-ads header-fixed">
<header id="masthead" class="site-header"><div class="logo"><a href="/">My river blog</a></div><p class="tagline">Notes from the valley</p></header>
<nav class="main-nav"><ul><li><a href="/a">Home</a></li><li><a href="/b">About me</a></li></ul></nav>
<div id="content"><article class="post single"><header class="entry-header"><h1 data-main>When the river came</h1></header>
<div class="entry-content"><p data-main>{LONG}</p><p data-main>It rained.</p><p data-main>{MORE} <a href="/x">See the map</a>.</p>
<blockquote><p data-main>We have never been so wet, she said.</p></blockquote><p data-main>{LAST}</p></div>
<div class="share-buttons"><a href="#">Share</a> <a href="#">Tweet</a></div></article>
<section id="comments" class="comments-area"><h2>2 responses</h2><ol class="comment-list"><li class="comment"><div class="comment-body"><p>{COMMENT}</p></div></li>
<li class="comment"><div class="comment-body"><p>Nice pictures.</p></div></li></ol><form class="comment-form"><label>Name</label><input><button>Send</button></form></section></div>
<aside class="widget-area"><h3>Recent posts</h3><ul><li><a href="/1">Spring</a></li><li><a href="/2">The mill</a></li></ul></aside>
<footer class="site-footer"><p>&copy; 2021 the author</p></footer></div></body></html>""",
    "news with adverts inside": f"""<html><body class="has-ads"><header class="masthead"><a href="/">The Daily Valley</a></header>
<div class="breadcrumbs"><a href="/">News</a> &gt; <a href="/l">Local</a></div>
<main><article><h1 data-main>Floods close two bridges</h1><p data-main>{LONG}</p><div class="ad-slot"><p>Boots for every weather. Order them today and pay next month.</p></div>
<p data-main>Police warned drivers.</p><p data-main>{MORE}</p><aside class="related"><h3>Read more</h3><ul><li><a href="/1">Rain to go on</a></li><li><a href="/2">Farmers count losses</a></li></ul></aside>
<h2 data-main>What comes next</h2><p data-main>Nobody knows.</p><p data-main>{LAST}</p></article></main>
<form class="newsletter"><p>Get our letter every morning, free of charge.</p><label>Mail</label><input><button>Subscribe</button></form>
<footer><ul><li><a href="/i">Imprint</a></li><li><a href="/p">Privacy</a></li></ul><p>Copyright Valley Press</p></footer></body></html>""",
    "one form around the page": f"""<html><body><form id="aspnetForm" action="/"><div class="header"><a href="/">Valley council</a></div>
<div class="menu"><ul><li><a href="/1">Services</a></li><li><a href="/2">Contact</a></li><li><a href="/3">Jobs</a></li></ul></div>
<div class="content"><h1 data-main>Report on the flood</h1><p data-main>{LONG}</p><p data-main>{MORE}</p><p data-main>See below.</p><p data-main>{LAST}</p></div>
<div class="footer"><p>Valley council, all rights reserved</p></div></form></body></html>""",
    "layout by table": f"""<html><body><table><tr><td><a href="1.html">Start</a><br><a href="2.html">Pictures</a><br><a href="3.html">Guests</a></td>
<td><h1 data-main>The flood of that year</h1><p data-main>{LONG}</p><p data-main>{MORE}</p><p data-main>{LAST}</p></td></tr>
<tr><td><a href="m.html">Write to me</a></td></tr></table></body></html>""",
    "handbook": f"""<html><body><nav id="sidebar"><ul><li><a href="/1">Install</a><ul><li><a href="/2">On boats</a></li><li><a href="/3">On land</a></li></ul></li><li><a href="/4">Use</a></li></ul></nav>
<main class="content"><h1 data-main>Pumps</h1><p data-main>A pump moves water from where it is to where it should be.</p><h2 data-main>Kinds</h2>
<ul><li data-main>Hand pumps, which need two people and a good deal of time.</li><li data-main>Motor pumps, which need fuel.</li></ul>
<pre data-main>pump --fast --from cellar --to garden</pre><p data-main>{MORE}</p><h2 data-main>Care</h2><p data-main>Dry it well.</p></main>
<footer><a href="/prev">Before</a> <a href="/next">Next</a></footer></body></html>""",
    "cookie notice and plain div": f"""<html><body><div class="cookie-notice"><p>We use cookies to make this page better for you and our partners.</p><button>Agree</button></div>
<div id="top"><a href="/">Home</a> <a href="/news">News</a></div><div id="content"><h1 data-main>High water</h1><p data-main>{LONG}</p><p data-main>{LAST}</p></div>
<div id="comments"><h3>Comments</h3><div><div><p>{COMMENT}</p></div></div><div><div><p>{COMMENT}</p></div></div></div></body></html>""",
    "German names": f"""<html><body><div class="kopfzeile"><a href="/">Talbote</a></div><div class="werbung">Jetzt kaufen und sparen, nur diese Woche.</div>
<article class="artikel"><h1 data-main>Das Wasser kam in der Nacht</h1><p data-main>{LONG}</p><div class="anzeige"><p>Gummistiefel in jeder Gr&ouml;&szlig;e, jetzt bestellen.</p></div><p data-main>{MORE}</p><p data-main>Es regnete.</p></article>
<section class="kommentare"><h3>Kommentare</h3><p>{COMMENT}</p></section><div class="fusszeile"><p>Alle Rechte vorbehalten</p></div></body></html>""",
    "drawings, own elements and buttons in the text": f"""<html><body><nav><a href="/">Start</a><svg><title>x</title><g><svg><text>icon</text></svg></g></svg></nav>
<article><h1 data-main>The <my-mark>great</my-mark> flood <svg><path d="M0 0"/><text>drop</text></svg>of the year</h1>
<p data-main>The river had <x-word>risen</x-word> during the night, <button>listen</button> and by the morning <picture><img src="a"></picture>the lower fields, <ruby>kawa<rt>river</rt></ruby>, were under water.</p>
<p data-main>{MORE}<script>track("<p>no</p>")</script> It was late.</p><p data-main><label>Note</label> that nobody was hurt, and <output>forty</output> people were taken in by their neighbours.</p></article>
<template><p>row of the list</p></template><noscript><p>Please turn on scripts.</p></noscript><select><option>English<option>French</select><footer>Made by hand</footer></body></html>""",
    "nothing but the article": f"""<html><body><article><h1 data-main>Flood</h1><p data-main>{LONG}</p><p data-main>{MORE}</p></article></body></html>""",
    "recipe": f"""<html><body class="single-post"><header><h2>Kitchen by the river</h2></header><nav><ul><li><a href="/s">Soups</a></li><li><a href="/f">Fish</a></li></ul></nav>
<article><h1 data-main>Fish soup for a wet day</h1><p data-main>This is what we ate while the road was closed, and we ate it gladly.</p><ul><li data-main>one large fish</li><li data-main>two onions, cut small</li><li data-main>salt</li></ul>
<div class="advertisement">Pans that never burn, half price this week only.</div><h2 data-main>How it is made</h2><ol><li data-main>Clean the fish and cut it into pieces.</li><li data-main>Fry the onions.</li><li data-main>Add water and wait for an hour.</li></ol><p data-main>{LAST}</p></article>
<div class="comments"><div class="comment"><div>Anna</div><p>Made it twice, it is very good, thank you for it.</p></div></div><footer>Kitchen by the river</footer></body></html>""",
    "lines in one element": f"""<html><body><div class="menu"><a href="1">One</a> <a href="2">Two</a> <a href="3">Three</a></div>
<div class="text" data-main>{LONG}<br><br>{MORE}<br>{LAST}</div><div class="sidebar"><p>Other pages</p><ul><li><a href="x">Maps of the valley</a></li></ul></div></body></html>""",
    "notices between short paragraphs": f"""<html><body><header><h1>Valley Post</h1></header><article><header><h1 data-main>Seven days of rain</h1></header><p data-main>Monday was dry.</p><p data-main>{LONG}</p>
<div class="paywall-notice"><p>You have two free articles left this month. Subscribe to read on.</p></div><p data-main>Then it rained.</p><div class="share"><a href="#">Share</a></div><p data-main>It did not stop.</p>
<ul class="social"><li><a href="#">Mail</a></li><li><a href="#">Print</a></li></ul><p data-main>{MORE}</p><p data-main>So it went.</p></article><footer>Valley Post</footer></body></html>""",
    "more comments than text": f"""<html><body><div class="wrap with-sidebar"><div class="topbar"><a href="/">Forum home</a></div><main><h1 data-main>Was the flood foreseen?</h1><p data-main>{LONG}</p><p data-main>{MORE}</p></main>
<section class="replies">{"".join(f'<div class="reply"><div>user {n}</div><p>{COMMENT}</p><p>{LAST}</p></div>' for n in range(9))}</section></div></body></html>""",
    "licence quoted in the text": f"""<html><body><nav><ul><li><a href="/">Start</a></li></ul></nav><div class="ad">Cheap rope, by the metre.</div><article><h1 data-main>Songs of the river</h1>
<p data-main>{LONG}</p><p data-main>{MORE}</p><p data-main>All rights reserved.</p></article><footer>&copy; 2020 Songs. All rights reserved.</footer></body></html>""",
    "Spanish shop diary": f"""<html lang="es"><body class="menu-open"><div class="cabecera"><a href="/">Tienda</a></div><ul class="menu"><li><a href="/1">Botas</a></li><li><a href="/2">Mapas</a></li></ul>
<main><section class="story"><h1 data-main>La noche del r&iacute;o</h1><p data-main>{LONG}</p><div class="publicidad"><p>Botas nuevas para el invierno, con descuento.</p></div><p data-main>Nadie durmi&oacute;.</p><p data-main>{LAST}</p></section></main>
<div class="comentarios"><p>{COMMENT}</p><p>Muy bonito.</p></div><div class="suscribete newsletter"><p>Recibe nuestra carta cada semana en tu correo.</p></div></body></html>""",
    "deep nesting without names": f"""<html><body><div><div><div><div><a href="/">Home</a> <a href="/m">Map</a></div></div></div></div><div><div><div class="row"><div class="col"><div><h1 data-main>The dam</h1><div><p data-main>{LONG}</p><p data-main>{MORE}</p>
<p data-main>It held.</p></div></div></div></div></div></div><section id="comments"><div class="row"><div class="col"><div><p>{COMMENT}</p></div></div></div></section></body></html>""",
    "article with a list of links and then little": f"""<html><body><header class="site-header"><p>Valley walks</p></header><article><h1 data-main>Walks for a dry week</h1><p data-main>{LONG}</p><ul><li><a href="1">Mill walk</a></li><li><a href="2">Hill walk</a></li></ul>
<p data-main>Wear boots.</p><div class="related"><a href="3">Walks for a wet week</a></div><p data-main>Take bread.</p><section class="reactions"><h3>What readers say</h3><p>{COMMENT}</p></section></article><aside><p>Book a guide for the whole week and save.</p></aside></body></html>""",
}
