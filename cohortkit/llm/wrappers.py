"""Main text of web pages by wrappers: union-free regular expressions inferred
from the pages of a host.

A page is a stream of tokens: tags and texts, balanced as a browser would do.
Aligning the streams of two pages of a host resolves their mismatches: texts that
differ become a text slot, an element that only one has becomes optional, and
elements that follow again become a repeated group (whose members are optional
if the pages have them in different orders).  So a wrapper has each child at
most once below its parent: its size is bounded by the site's vocabulary of tags
and classes, not by the number or the length of pages, and a page is
aligned with it by looking up every tag below its parent (elements deeper than ``DEEP`` belong to their ancestor there).  Where one element has
over ``MANY`` children of one tag that differ in their classes only, the class is a
slot, too.  Merging is a union of paths, sums, and a least common pattern, so tasks
infer the wrapper of their pages first and merge those in rounds of ``FAN`` at a
time, in whatever order, to the same slots.

The wrapper then says for each element whether it is boilerplate: by its tag
(nav, footer, form, script ..., a header outside the main part), by words of its class, id or role (menu, advert,
comment ...; not where the host has no article or main element but below such an element), and, outside a marked main part, by what the host's pages
show: text that doesn't change from page to page, or is mostly links.  A page's
text is that of its main part (article; else main; else an element whose class
says content; else the body) less the boilerplate, in the page's order.

Blocks: text between two starts or ends of block elements.  Character references
are decoded, white space (a line break element included) is one space, blocks are
joined by a newline; empty blocks are nothing.

Scale: tasks fold their pages into one wrapper a host and hand on only those;
the pages are read twice and joined with their host's wrapper by a plain join, which
Spark broadcasts when the written wrappers are small, and else sorts and splits where
a host is hot.  A task holds one wrapper for each host it meets, at most ``HELD`` elements in all.

Defined results: null and empty pages have an empty text.  A null url, or one
without a host, is of the host ''.  Repeated rows are pages of their own; null ids
are returned as they are.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import written

__all__ = ["tokens", "Wrapper", "infer", "extract", "host_of"]

#: Children of one tag and parent after which their classes are a slot.
MANY = 64

#: Depth from which elements are no nodes of their own.
DEEP = 200

#: Wrappers merged by one task at a time, and elements of wrappers that a task holds.
FAN, HELD = 64, 200_000

# Fixed values of HTML: element names by their role in the syntax.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
         "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "summary",
         "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: What a start tag closes if it is open, up to one of the elements after it.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "thead": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}), "option": ({"option"}, {"select", "datalist"}), "body": ({"head"}, {"html"})}
_CLOSES_P = BLOCK - {"body", "caption", "dd", "dt", "head", "html", "legend", "li", "optgroup", "option", "tbody", "td", "tfoot", "th", "thead", "tr"} | {"li", "dd", "dt"}
#: An end tag doesn't reach over these.
_SCOPE = {"table", "td", "th", "caption", "template", "button", "object"}
_REACH = _SCOPE | {"tr", "tbody", "thead", "tfoot", "body", "html"}

# Tags that are never main text, and words of class, id or role that say so.
ASIDE = {"nav", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "svg", "math", "button", "select", "textarea", "datalist", "dialog", "head", "title", "object", "canvas", "audio", "video", "menu", "search", "noembed", "noframes"}
ASIDE_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "discussion", "disqus", "footer", "gdpr", "login", "masthead",
               "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pager", "pagination", "popup", "promo", "promotion", "related", "replies", "reply", "respond", "search", "share", "sharing",
               "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "alert", "complementary", "contentinfo", "dialog"}
#: A class token with one of these speaks of something else (``has-sidebar``).
ABOUT = {"has", "with", "no", "not", "without"}
MAIN_WORDS = {"article", "content", "entry", "main", "post", "story", "articlebody", "body"}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++))?+|[\s/=]++)*+)>")
_ATTR = re.compile(r"(?<![^\s/\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_RUN = re.compile(r"\d+")
_COMMENT, _COMMENT_END = re.compile(r"<!---?>"), re.compile(r"--!?>")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in sorted(RAW)}
_NAMED = re.compile(r"class|id|role", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def host_of(url: Column) -> Column:
    """Lower-case host of a url; '' if there is none."""
    host = F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1)
    return F.coalesce(F.lower(host), F.lit(""))


_labels: dict[tuple[str, str], str] = {}


def _label(name: str, attributes: str) -> str:
    """Tag, kind (m: main part, x: boilerplate, -: neither) and class of an
    element, as ``tag kind class``.  Text-level elements and paragraphs have no class."""
    if name == "article":
        kind = "a"
    elif name == "main":
        kind = "m"
    else:
        kind = "x" if name in ASIDE else "-"
    if not attributes or not _NAMED.search(attributes):
        return f"{name} {kind} "
    key = (name, attributes)
    if (label := _labels.get(key)) is None:
        found: dict[str, str] = {}
        for m in _ATTR.finditer(attributes):
            found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        values = " ".join(found.values())
        tokens = [set(_WORD.findall(_CAMEL.sub(" ", t).lower())) for t in values.split()]
        tokens = [t for t in tokens if not t & ABOUT]
        if kind != "x" and any(t & ASIDE_WORDS for t in tokens) and name not in ("body", "html"):
            kind = "x"
        elif kind == "-" and "main" in found.get("role", "").lower().split():
            kind = "m"
        elif kind == "-" and name in BLOCK and name not in ("body", "html") and any(t & MAIN_WORDS for t in tokens):
            kind = "c"
        plain = name not in BLOCK or name in ("p", "li", "td", "th", "tr", "dd", "dt", "h1", "h2", "h3", "h4", "h5", "h6")
        label = f"{name} {kind} " + ("" if plain else ".".join(sorted(_RUN.sub("0", t) for t in found.get("class", "").split())))
        if len(_labels) > 50_000:
            _labels.clear()
        _labels[key] = label
    return label


def tokens(page: str) -> list[tuple[int, str, str]]:
    """The balanced token stream of a page: (1, name, label) opens an element,
    (-1, name, '') closes the innermost one, (0, text, '') is text with its
    character references decoded, (2, name, '') a void element, or an end of one
    that is too deep to be a node."""
    out: list[tuple[int, str, str]] = []
    open_: list[str] = []
    deep: list[str] = []
    at, n = 0, len(page)
    find, tag_at, put = page.find, _TAG.match, out.append

    def close(k: int) -> None:
        while len(open_) > k:
            put((-1, open_.pop(), ""))

    while at < n:
        i = find("<", at)
        while i >= 0 and not (page[i + 1 : i + 2].isalpha() and page[i + 1 : i + 2].isascii() or page[i + 1 : i + 2] in ("/", "!", "?")):
            i = find("<", i + 1)
        end = i if i >= 0 else n
        if end > at:
            text = page[at:end]
            put((0, html.unescape(text) if "&" in text else text, ""))
        if i < 0:
            break
        tag = tag_at(page, i)
        if tag is None:
            following = page[i + 1]
            if page.startswith("<!--", i):
                stop = _COMMENT.match(page, i) or _COMMENT_END.search(page, i + 4)
                at = stop.end() if stop else n
            elif following in "!?" or following == "/" and not page[i + 2 : i + 3].isalpha():  # read as a comment
                stop = find(">", i)
                at = stop + 1 if stop >= 0 else n
            else:
                break  # a tag that never ends takes the rest
            continue
        at = tag.end()
        ends, name, attributes = tag.groups()
        name = name.lower()
        if ends:
            if open_ and open_[-1] == name and not deep:
                put((-1, open_.pop(), ""))
            elif name == "br" or deep and deep[-1] == name:
                if name != "br":
                    deep.pop()
                put((2, name, ""))
            elif name in deep:
                del deep[len(deep) - 1 - deep[::-1].index(name) :]
                put((2, name, ""))
            else:
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k] == name:
                        close(k)
                        break
                    if open_[k] in _SCOPE and name not in _REACH:
                        break
            continue
        if name in VOID:
            if name == "hr" and "p" in open_:
                close(_open_p(open_))
            put((2, name, ""))
            continue
        if name in ("html", "body") and name in open_:
            continue
        if len(open_) >= DEEP and name not in RAW:
            deep.append(name)
            put((2, name, ""))
            continue
        if name in _CLOSES:
            own, until = _CLOSES[name]
            for k in range(len(open_) - 1, -1, -1):
                if open_[k] in until:
                    break
                if open_[k] in own:
                    close(k)
                    break
        if name in _CLOSES_P and "p" in open_:
            close(_open_p(open_))
        put((1, name, _label(name, attributes)))
        if name in RAW:
            stop = _RAW_END[name].search(page, at)
            until_ = stop.start() if stop else n
            if name in ("textarea", "title") and until_ > at:
                put((0, html.unescape(page[at:until_]), ""))
            at = until_
            if stop:
                shut = find(">", stop.end())
                at = shut + 1 if shut >= 0 else n
            put((-1, name, ""))
        else:
            open_.append(name)
    close(0)
    return out


def _open_p(open_: list[str]) -> int:
    """Place of the open paragraph that a block closes; the length if a scope
    lies between."""
    for k in range(len(open_) - 1, -1, -1):
        if open_[k] == "p":
            return k
        if open_[k] in _SCOPE:
            break
    return len(open_)


class Wrapper:
    """A node of the union-free expression: an element with its children.

    ``parts`` is the sequence of its children: [members, optional, repeated],
    several members being a repeated group of optional ones.  ``n``: pages
    that have the element; ``chars`` and ``linked``: characters of its own text,
    and those in links; ``said``: a hash of its text, if it is the same on all
    pages ('' for none), else None (a slot)."""

    __slots__ = ("children", "parts", "n", "chars", "linked", "said", "slot")

    def __init__(self) -> None:
        self.children: dict[str, Wrapper] = {}
        self.parts: list[list] = []
        self.n, self.chars, self.linked = 0, 0, 0
        self.said: str | None = ""
        self.slot = False  # whether a class is a slot among its children

    def size(self) -> int:
        return 1 + sum(c.size() for c in self.children.values())

    def child(self, label: str) -> Wrapper | None:
        """The child a page's element is aligned with."""
        found = self.children.get(label)
        return found if found is not None else self.children.get(_any_class(label))

    def add(self, other: Wrapper) -> None:
        """Align another wrapper of the host with this one."""
        self.parts = _aligned(self.parts, other.parts) if self.n and other.n else self.parts or other.parts
        for label, theirs in other.children.items():
            own = self.children.get(label)
            if own is None:
                self.children[label] = theirs
            else:
                own.add(theirs)
        self.n += other.n
        self.chars += other.chars
        self.linked += other.linked
        if self.said != other.said:
            self.said = None
        self.slot |= other.slot
        if self.slot or len(self.children) > MANY:
            self.slots()

    def slots(self) -> None:
        """Children of one tag that differ in class only, if many, are one
        child whose class is a slot."""
        tags: dict[str, list[str]] = {}
        for label in self.children:
            tags.setdefault(_any_class(label), []).append(label)
        for slot, labels in tags.items():
            if slot in labels and len(labels) == 1 or len(labels) <= MANY and slot not in labels:
                continue
            whole = Wrapper()
            for label in labels:
                whole.add(self.children.pop(label))
            self.children[slot], self.slot = whole, True
            gone = set(labels)
            self.parts = _single([[[slot if m in gone else m for m in members], optional, repeated] for members, optional, repeated in self.parts])

    def pattern(self, label: str = "") -> str:
        """The expression as text."""
        tag, _, cls = (label.split(" ") + ["", ""])[:3]
        out = []
        for members, optional, repeated in self.parts:
            each = ["#text" if m == "#" else self.children[m].pattern(m) for m in members]
            body = each[0] if len(each) == 1 else "(" + " ".join(e + "?" for e in each) + ")"
            out.append(body + ("*" if repeated and (optional or len(each) > 1) else "+" if repeated else "?" if optional else ""))
        inner = " ".join(out)
        return inner if not tag else f"<{tag}{'.' + cls if cls else ''}>{'(' + inner + ')' if inner else ''}"

    def state(self) -> list:
        return [self.n, self.chars, self.linked, self.said, self.parts, {k: c.state() for k, c in self.children.items()}]

    @classmethod
    def of(cls, state: list) -> Wrapper:
        self = cls()
        self.n, self.chars, self.linked, self.said, self.parts, children = state
        self.children = {k: cls.of(c) for k, c in children.items()}
        self.slot = any(k.endswith("*") for k in children)
        return self


def _any_class(label: str) -> str:
    tag, kind, cls = label.split(" ", 2)
    return f"{tag} {kind} *" if cls else label


def _single(parts: list[list]) -> list[list]:
    """Each child once: what stands between two places of a child, both
    included, becomes a repeated group."""
    out: list[list] = []
    place: dict[str, int] = {}
    for members, optional, repeated in parts:
        at = min((place[m] for m in members if m in place), default=None)
        if at is None:
            out.append([list(dict.fromkeys(members)), optional, repeated])
            place.update((m, len(out) - 1) for m in members)
        else:
            span = out[at:] + [[members, optional, repeated]]
            names = sorted({m for p in span for m in p[0]})
            out[at:] = [[names, all(p[1] for p in span) if len(names) == 1 else True, True]]
            place.update((m, at) for m in names)
    return out


_sequences: dict[tuple[str, ...], list[list]] = {}


def _sequence(labels: list[str]) -> list[list]:
    """Parts of one page's sequence of children."""
    key = tuple(k for i, k in enumerate(labels) if i < 2 or k != labels[i - 1] or k != labels[i - 2])
    parts = _sequences.get(key)
    if parts is None:
        if len(_sequences) > 20_000:
            _sequences.clear()
        parts = _sequences[key] = _single([[[k], False, False] for k in key])
    return [[list(m), o, r] for m, o, r in parts]


def _aligned(a: list[list], b: list[list]) -> list[list]:
    """Longest common order of two sequences of parts; a part that has no
    partner is optional."""
    if a == b:
        return a
    sets_a, sets_b = [set(p[0]) for p in a], [set(p[0]) for p in b]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if sets_a[i] & sets_b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and sets_a[i] & sets_b[j]:
            names = sorted(sets_a[i] | sets_b[j])
            out.append([names, a[i][1] or b[j][1] or len(names) > 1, a[i][2] or b[j][2] or len(names) > 1])
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append([a[i][0], True, a[i][2]])
            i += 1
        else:
            out.append([b[j][0], True, b[j][2]])
            j += 1
    return _single(out)


def _parsed(page: str) -> Wrapper:
    """One page's own wrapper."""
    top = Wrapper()
    stack: list[tuple[Wrapper, list[str], list[str]]] = [(top, [], [])]
    held = [top]
    links = 0

    def done(node: Wrapper, labels: list[str], texts: list[str]) -> None:
        own = _sequence(labels)
        said = hashlib.blake2b(" ".join("".join(texts).split()).encode(errors="replace"), digest_size=8).hexdigest() if texts else ""
        if node.n == 0:
            node.n, node.parts, node.said = 1, own, said
        else:  # the element again on this page
            node.parts = _aligned(node.parts, own)
            if node.said != said:
                node.said = None

    for kind, name, label in tokens(page):
        node, labels, texts = stack[-1]
        if kind == 0:
            if size := len(name.strip()):
                labels.append("#")
                texts.append(name)
                node.chars += size
                if links:
                    node.linked += size
        elif kind == 1:
            labels.append(label)
            child = node.children.get(label)
            if child is None:
                child = node.children[label] = Wrapper()
                held.append(child)
            links += name == "a"
            stack.append((child, [], []))
        elif kind == -1:
            done(*stack.pop())
            links -= name == "a"
    done(top, *stack[0][1:])
    for node in held:
        if len(node.children) > MANY:
            node.slots()
    return top


def infer(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row a host that has a page with text: ``host``, ``n_pages``, ``pattern``
    (the expression as text) and ``flags`` (which elements are boilerplate, as JSON)."""
    source = pages.select(host_of(F.col(url_col).cast("string")).alias("host"), F.col(html_col).cast("string").alias("html"))

    def rows(held: dict[str, Wrapper]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(w.state(), ensure_ascii=False, separators=(",", ":")) for w in held.values()], pa.string())], ["host", "wrapper"])

    def fold(batches):
        held: dict[str, Wrapper] = {}
        size = 0
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not page:
                    continue
                one = _parsed(page)
                own = held.get(host)
                if own is None:
                    held[host] = one
                    size += one.size()
                else:
                    size -= len(own.children)
                    own.add(one)
                    size += len(own.children)
                if size > HELD:
                    yield rows(held)
                    held, size = {}, 0
        if held:
            yield rows(held)

    def merged(group: pa.Table) -> pa.Table:
        states = group.column("wrapper").to_pylist()
        whole = Wrapper.of(json.loads(states[0]))
        for s in states[1:]:
            whole.add(Wrapper.of(json.loads(s)))
        return pa.Table.from_batches([rows({group.column("host")[0].as_py(): whole})])

    parts = written(source.mapInArrow(fold, "host string, wrapper string"), "wrappers")
    while (most := parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        salts = -(-most // FAN)
        salted = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper", F.monotonically_increasing_id()), F.lit(salts)) if salts > 1 else F.lit(0).cast("long"))
        parts = written(salted.groupBy("host", "salt").applyInArrow(merged, "host string, wrapper string"), "wrappers")

    def decide(batches):
        for batch in batches:
            whole = [Wrapper.of(json.loads(s)) for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([w.n for w in whole], pa.int64()), pa.array([w.pattern() for w in whole], pa.string()), pa.array([json.dumps(flags(w), separators=(",", ":")) for w in whole], pa.string())],
                                             ["host", "n_pages", "pattern", "flags"])

    return written(parts.select("host", "wrapper").mapInArrow(decide, "host string, n_pages long, pattern string, flags string"), "patterns")


def flags(wrapper: Wrapper) -> list:
    """What extraction needs of a wrapper, for every element: whether it is
    boilerplate, its kind, its children."""
    opened = not _has_main(wrapper, past=False)
    return _flags(wrapper, "", "-", False, wrapper.n, opened, _sums(wrapper)[0])


def _has_main(node: Wrapper, past: bool) -> bool:
    """Whether an article or main element is below, ``past`` boilerplate too."""
    for label, child in node.children.items():
        kind = label.split(" ", 2)[1]
        if kind in "am" or (past or kind != "x") and _has_main(child, past):
            return True
    return False


def _flags(node: Wrapper, tag: str, kind: str, inside: bool, pages: int, opened: bool, chars: int) -> list:
    total, linked, fixed = _sums(node)
    boiler = kind == "x" or tag == "header" and not inside
    if boiler and opened and (tag == "form" or tag not in ASIDE):  # all main parts stand in boilerplate: what holds one isn't
        boiler = not (_has_main(node, past=True) or tag == "form" and 2 * total > chars)
    if not boiler and not inside and pages >= 3 and kind == "-" and total and tag in _PARTS:
        boiler = fixed == total and node.n >= 3 or linked > 0.6 * total
    children = {}
    for label, child in () if boiler else node.children.items():
        tag_of, kind_of, _ = label.split(" ", 2)
        children[label] = _flags(child, tag_of, kind_of, inside or kind in "amc", pages, opened, chars)
    return [int(boiler), kind, children]


def _sums(node: Wrapper) -> tuple[int, int, int]:
    """Characters below a node, those in links, and those that never change."""
    total, linked, fixed = node.chars, node.linked, node.chars if node.said is not None else 0
    for child in node.children.values():
        t, k, f = _sums(child)
        total, linked, fixed = total + t, linked + k, fixed + f
    return total, linked, fixed


#: Elements that hold parts of a page rather than paragraphs.
_PARTS = BLOCK - {"blockquote", "body", "caption", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "head", "hr", "html", "legend", "li", "option", "p", "pre", "summary", "tbody", "td", "th", "tr"}

#: Kinds of a main part, the surest first; 3 is the body.
_RANK = {"a": 0, "m": 1, "c": 2}


def _text(page: str, flags: list) -> str:
    """Main text of a page by its host's wrapper."""
    blocks: list[list[list[str]]] = [[[]] for _ in range(4)]  # of each kind of main part
    ranks: tuple[int, ...] = (3,)
    skip = 0  # depth below an element that the wrapper drops
    stack = [(flags, skip, ranks)]  # the aligned element, and these two as they were before it

    def apart() -> None:
        for b in blocks:
            if b[-1]:
                b.append([])

    for kind, name, label in tokens(page):
        if kind == 0:
            if not skip:
                for r in ranks:
                    blocks[r][-1].append(name)
        elif kind == 2:
            if name in BLOCK:
                apart()
            elif name == "br" and not skip:
                for r in ranks:
                    blocks[r][-1].append(" ")
        elif kind == 1:
            if name in BLOCK:
                apart()
            node = stack[-1][0]
            child = None
            if not skip and node is not None:
                child = node[2].get(label)
                if child is None:
                    child = node[2].get(_any_class(label))
            stack.append((child, skip, ranks))
            k = label.split(" ", 2)[1]
            if skip or (child[0] if child is not None else k == "x"):
                skip += 1
            elif k in _RANK and _RANK[k] not in ranks:
                ranks = (*ranks, _RANK[k])
        else:
            if name in BLOCK:
                apart()
            if len(stack) > 1:
                _, skip, ranks = stack.pop()
    for b in blocks:
        lines = [" ".join("".join(t).split()) for t in b]
        if lines := [x for x in lines if x]:
            return "\n".join(lines)
    return ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row a page: id, url, ``text``, ``n_chars`` (code points)."""
    wrappers = infer(pages, url_col, html_col)
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"), host_of(F.col(url_col).cast("string")).alias("host"))
    kinds = [source.schema[c].dataType.simpleString() for c in ("id", "url")]

    def read(batches):
        read_flags: dict[str, list] = {}
        for batch in batches:
            texts = []
            for page, told in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if not page or told is None:
                    texts.append("")
                    continue
                if told not in read_flags:
                    if len(read_flags) > 200:
                        read_flags.clear()
                    read_flags[told] = json.loads(told)
                texts.append(_text(page, read_flags[told]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    joined = source.join(wrappers.select("host", "flags"), "host", "left").select("id", "url", "html", "flags")
    out = joined.mapInArrow(read, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
