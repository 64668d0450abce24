"""Main text of web pages by site template removal.

Every element of a page is hashed with all that is below it.  Spark counts, per
host, on how many different pages a subtree occurs; subtrees that recur on many
of them are the site's template and are deleted, besides elements that are never
main text by their tag, role or class.  What lies in an article is the page's
own, also if other pages share it, and pages with the same main text count once.
"""

from __future__ import annotations

import html as references
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import save

MIN_PAGES = 5        # different pages of a host that share a template subtree,
MIN_SHARE = 0.2      # and this share of the host's different pages
PROSE_WORDS = 20     # words of a block that is prose and no caption or label

# Fixed values.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noframes".split())
NEVER = set("""script style noscript template head title nav header footer aside form button select
    option textarea input label fieldset dialog menu iframe object embed svg canvas audio video map
    applet frameset noframes datalist""".split())
NEVER_ROLES = set("""navigation banner contentinfo complementary search form dialog alertdialog alert
    menu menubar toolbar tablist""".split())
NEVER_NAMES = set("""ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo
    promotion nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager header masthead
    topbar footer bottombar sidebar side aside widget widgets notice notices cookie cookies consent gdpr
    alert popup modal overlay newsletter subscribe subscription signup login form search share sharing
    social follow related recommended recommendations comment comments commentlist respond reply replies
    disqus discussion feedback toolbar skip legal copyright""".split())
# Parts that a name may have beside one of these: "sidebar-left", but not "has-sidebar".
PLACES = set("""site main global left right top bottom primary secondary tertiary box block area section
    container wrapper wrap inner outer list items item bar buttons button links link icons posts card cards
    content label slot unit zone trail next prev previous""".split())
HEADINGS = {"header", "masthead"}       # in an article, its own; beside fewer other parts
HEADING_PLACES = set("site main global top bar container wrapper wrap inner outer".split())
OTHERS = set("comment comments commentlist respond cookie cookies consent gdpr".split())   # may be longer than the text
INLINE = set("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q
    rp rt ruby s samp small span strike strong sub sup time tt u var wbr""".split())
SPOKEN = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dd".split())
# A start tag of the first closes an open one of the second, up to the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
MARK = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
ATTRIBUTES = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
BROKEN = 8       # start tags of a page with a quote that never ends, before quotes are ignored
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME_PART = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


class Element:
    """``parts`` are texts and elements in page order; ``names`` those of its
    class and id that are no main text."""
    __slots__ = ("tag", "never", "names", "parts", "hash")

    def __init__(self, tag: str, never: bool = False, names=frozenset()):
        self.tag, self.never, self.names, self.parts, self.hash = tag, never, names, [], 0


def _names(attributes: str, in_article: bool) -> set[str]:
    """The names in a whole class or id that is one of them or is made of names
    and places only."""
    found = set()
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            for token in (a or b or c).lower().split():
                parts = set(NAME_PART.findall(token))
                names = parts & NEVER_NAMES
                if in_article:
                    names -= HEADINGS
                if names and parts - names <= (HEADING_PLACES if names <= HEADINGS else PLACES):
                    found |= names
    return found


def _is_never(tag: str, attributes: str) -> bool:
    if tag in NEVER:
        return True
    if not attributes:
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in NEVER_ROLES:
            return True
        if tag == "article" and name == "class" and "comment" in value:
            return True
    return False


def parse(page: str) -> Element:
    """Element tree of a page with its dropped elements marked."""
    root = _tree(page)
    _drop_named(root)
    return root


def _drop_named(root: Element) -> None:
    """Elements with names are dropped, besides those that hold an article or
    most of the page's text in paragraphs (all of it, for those that may be
    longer than the main text).  Articles in an article, as comments may be,
    don't count."""
    order, todo = [], [(root, False, False)]       # element, in an article, in a paragraph
    named = False
    while todo:
        e, inside, spoken = todo.pop()
        order.append((e, inside, spoken))
        if e.never:
            continue
        named |= bool(e.names)
        inside |= e.tag == "article"
        spoken |= e.tag == "p"
        todo += [(x, inside, spoken) for x in e.parts if isinstance(x, Element)]
    if not named:
        return
    said, holds = {}, {}        # characters in paragraphs; an article with text
    text = {}
    for e, inside, spoken in reversed(order):
        below = [] if e.never else e.parts
        own = sum(len(x.strip()) for x in below if isinstance(x, str))
        below = [id(x) for x in below if isinstance(x, Element)]
        text[id(e)] = own + sum(text[x] for x in below)
        said[id(e)] = (own if spoken or e.tag == "p" else 0) + sum(said[x] for x in below)
        holds[id(e)] = any(holds[x] for x in below) or (
            e.tag in ("article", "main") and not e.never and not inside and text[id(e)] > 0)
    most = said if said[id(root)] else text
    for e, _, _ in order:
        mine, page = most[id(e)], most[id(root)]
        if e.names and not holds[id(e)] and (mine < page if e.names & OTHERS else 2 * mine <= page):
            e.never = True


class _Open:
    """The open elements of a page, the root first.  Where the topmost one of a
    name is, and the topmost that is no inline one, is known without a search,
    so a page of any depth costs no more than its tags."""

    def __init__(self, root: Element):
        self.stack, self.at, self.blocks = [root], {root.tag: [0]}, [0]

    def push(self, e: Element) -> None:
        self.at.setdefault(e.tag, []).append(len(self.stack))
        if e.tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(e)

    def close(self, to: int) -> None:
        for e in reversed(self.stack[to:]):
            self.at[e.tag].pop()
            if e.tag not in INLINE:
                self.blocks.pop()
        del self.stack[to:]

    def top(self, tags) -> int:
        """Place of the topmost of the tags, 0 for none (the root has none)."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def end(self, tag: str) -> None:
        """An end tag: of an inline element, only up to the next block."""
        i = self.top((tag,))
        if i and not (tag in INLINE and i < self.blocks[-1]):
            self.close(i)

    def before(self, tag: str) -> None:
        """What a start tag ends."""
        if tag not in INLINE and self.stack[self.blocks[-1]].tag == "p":
            self.close(self.blocks[-1])          # a block ends an open paragraph
        if tag in CLOSES:
            ends, limits = CLOSES[tag]
            i = self.top(ends)
            if i > self.top(limits - ends):
                self.close(i)


def _tree(page: str) -> Element:
    """Tags that are open at an end tag or at the end are closed, end tags
    without a start tag are ignored, a tag that never ends is text.  Linear in
    the page, whatever is broken in it."""
    root = Element("#page")
    opened, at, broken = _Open(root), 0, 0
    last = page.rfind(">")

    def say(text: str):
        if text:
            opened.stack[-1].parts.append(text)

    while True:
        m = MARK.search(page, at)
        if not m:
            say(page[at:])
            return root
        start, kind = m.start(), m.group()
        if kind == "<!--":
            say(page[at:start])
            stop = page.find("-->", start + 4)
            at = stop + 3 if stop >= 0 else len(page)
            continue
        if start > last:                             # no tag ends any more
            say(page[at:])
            return root
        say(page[at:start])
        if kind in ("<!", "<?"):
            at = page.find(">", start) + 1
            continue
        name = NAME.match(page, m.end() - 1)
        tag = name.group().lower()
        if kind[1] == "/":
            at = page.find(">", name.end()) + 1
            opened.end(tag)
            continue
        rest = ATTRIBUTES.match(page, name.end()) if broken < BROKEN else None
        if not rest:
            broken += 1
        at = rest.end() if rest else page.find(">", name.end()) + 1
        attributes = page[name.end():at - 1]
        opened.before(tag)
        never, names = _is_never(tag, attributes), frozenset()
        if tag == "header" or "class" in attributes.lower() or "id" in attributes.lower():
            in_article = opened.top(("article", "main")) > 0
            if tag == "header" and in_article:
                never = False                    # an article's own heading
            if tag not in ("html", "body", "main", "article"):
                names = _names(attributes, in_article)
        element = Element(tag, never, names)
        opened.stack[-1].parts.append(element)
        if tag in RAW:
            stop = re.compile(f"</{tag}\\s*+>", re.I).search(page, at)
            element.parts.append(page[at:stop.start()] if stop else page[at:])
            at = stop.end() if stop else len(page)
        elif tag not in VOID:
            opened.push(element)


def articles(root: Element) -> list[Element]:
    """The outermost articles of a page that are not in a dropped element."""
    found, todo = [], [root]
    while todo:
        e = todo.pop()
        if e.never:
            continue
        if e.tag in ("article", "main"):
            found.append(e)
            continue
        todo += [x for x in reversed(e.parts) if isinstance(x, Element)]
    return found


def own_articles(root: Element) -> list[Element]:
    """The articles that are the page's own: those with prose and the longest;
    the others are teasers, which can be a site's template."""
    texts = [(e, _blocks([e])) for e in articles(root)]
    longest = max((sum(map(len, t)) for _, t in texts), default=0)
    return [e for e, t in texts if t and (
        sum(map(len, t)) == longest or any(len(x.split()) >= PROSE_WORDS for x in t))]


def content(root: Element, own: list[Element]) -> int:
    """Hash of what makes a page different from others: the text of its own
    articles; without any, its prose if that is most of its text, else all."""
    from xxhash import xxh64_intdigest
    blocks = _blocks(own or [root])
    if not own:
        prose = [x for x in blocks if len(x.split()) >= PROSE_WORDS]
        if 2 * sum(map(len, prose)) > sum(map(len, blocks)):
            blocks = prose
    h = xxh64_intdigest("\n".join(blocks).encode("utf-8", "replace"))
    return h - (1 << 64) if h >> 63 else h


def hash_subtrees(root: Element, own: list[Element]) -> list[Element]:
    """Sets the hash of the elements outside the page's own articles and lists
    those that can be a template: they hold text and no such article, and are
    no inline ones."""
    from xxhash import xxh64_intdigest
    kept = {id(e) for e in own}
    order, todo = [], [root]
    while todo:
        e = todo.pop()
        order.append(e)
        if id(e) not in kept:
            todo += [x for x in e.parts if isinstance(x, Element)]
    found = []
    for e in reversed(order):
        if id(e) in kept or any(isinstance(x, Element) and id(x) in kept for x in e.parts):
            kept.add(id(e))
            continue
        said = [e.tag]
        for x in e.parts:
            if isinstance(x, Element):
                said.append(f"\x01{x.hash}")
            elif x := SPACE.sub(" ", x).strip():
                said.append("\x02" + x)
        h = xxh64_intdigest("".join(said).encode("utf-8", "replace"))
        e.hash = h - (1 << 64) if h >> 63 else h
        if len(said) > 1 and e.tag not in INLINE and e.tag not in ("#page", "html", "body"):
            found.append(e)
    return found


def beside_prose(root: Element, template) -> set[int]:
    """Ids of the paragraphs that stay although they recur: those in a container,
    not the page's body, with a paragraph of prose of its own beside them.  A
    site's template has elements of its own around its text; a licence line or a
    passage that many articles share stands among their paragraphs."""
    order, todo = [], [root]
    while todo:
        e = todo.pop()
        order.append(e)
        todo += [x for x in e.parts if isinstance(x, Element) and not x.never]
    words: dict[int, int] = {}           # below each element
    stay = set()
    for e in reversed(order):
        below = [x for x in e.parts if isinstance(x, Element) and not x.never]
        words[id(e)] = sum(words[id(x)] for x in below) + sum(len(x.split()) for x in e.parts if isinstance(x, str))
        spoken = [x for x in below if x.tag in SPOKEN]
        if e.tag not in ("#page", "html", "body") and e.hash not in template and any(
                x.hash not in template and words[id(x)] >= PROSE_WORDS for x in spoken):
            stay |= {id(x) for x in spoken}
    return stay


def _blocks(top: list[Element]) -> list[str]:
    """Texts of the blocks below ``top`` in page order."""
    out, line = [], []

    def flush():
        text = SPACE.sub(" ", references.unescape("".join(line))).strip()
        line.clear()
        if text:
            out.append(text)

    for element in top:
        todo: list = [element]
        while todo:
            x = todo.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                line.append(x)
            elif x.never:
                if x.tag not in INLINE:
                    flush()
            elif x.tag == "br":
                line.append(" ")
            elif x.tag in INLINE:
                todo += reversed(x.parts)
            else:
                flush()
                todo.append(None)
                todo += reversed(x.parts)
        flush()
    return out


def main_text(page: str | None, template=frozenset()) -> str:
    """Blocks of the page's articles (of its body, if no article has text)
    without the subtrees whose hash is in ``template``, joined by blank lines."""
    if not page:
        return ""
    root = parse(page)
    if template:
        found = [e for e in hash_subtrees(root, own_articles(root)) if e.hash in template]
        stay = beside_prose(root, template) if found else ()
        for e in found:
            e.never = e.never or id(e) not in stay
    return "\n\n".join(_blocks(articles(root)) or _blocks([root]))


def host(url):
    """Lower-case host of a URL column, without port; none: empty."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, template)``: per host the hashes of the subtrees that occur on
    at least ``MIN_PAGES`` and ``MIN_SHARE`` of its different pages.  Pages with
    the same main text are one page, whatever is around it, and no subtree of
    or around a page's own article counts, so a shared article is no template."""
    def subtrees(batches):
        for b in batches:
            hosts, hashes, owners = [], [], []
            for site, page in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                root = parse(page.as_py())
                own = own_articles(root)
                # No hash: the page itself.
                mine = [None, *{e.hash for e in hash_subtrees(root, own)}]
                hosts += [site] * len(mine)
                hashes += mine
                owners += [content(root, own)] * len(mine)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(owners, pa.int64())],
                ["host", "subtree", "page"])

    texts = pages.where(F.col(html_col).isNotNull()).select(host(F.col(url_col)).alias("host"), F.col(html_col))
    seen = save(texts.mapInArrow(subtrees, "host string, subtree long, page long").distinct()
                .groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES), "subtrees")
    size = seen.where("subtree is null").select("host", F.col("n").alias("pages"))
    return (seen.where("subtree is not null").join(size, "host").where(F.col("n") >= MIN_SHARE * F.col("pages"))
            .groupBy("host").agg(F.collect_list("subtree").alias("template")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Id, url, ``text`` and ``n_chars`` of every page.

    A null or empty page, or one without main text, has an empty text; a null
    or odd url belongs to the host without a name; repeated rows are extracted
    each and count as one page of the template; an empty table gives an empty
    result.  Columns other than the three named are not read.
    """
    @arrow_udf("string")
    def text(html: pa.Array, template: pa.Array) -> pa.Array:
        return pa.array([main_text(h.as_py(), frozenset(t.as_py() or ()))
                         for h, t in zip(html, template, strict=True)], pa.string())

    rows = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(html_col).alias("__html"))
    found = save(templates(rows, "__url", "__html"), "templates")
    rows = rows.withColumn("__host", host(F.col("__url"))).join(
        found, F.col("__host") == found.host, "left")
    out = rows.select(F.col("__id").alias(id_col), F.col("__url").alias(url_col),
                      text("__html", "template").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
