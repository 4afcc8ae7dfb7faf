"""The main text of web pages, with repeats found by suffix arrays over hosts.

A page is cut into blocks, each with the path of its elements. Menus, headers,
footers, asides, forms and the like go at once. All other blocks of a shard of
hosts (a marker of the element path, the words, an end marker) form one token
string; its suffix array gives the token runs that stand on several different
pages of one host.

* Of ``article`` and ``main`` only short runs go that most pages of a host with
  ``HOST_PAGES`` or more share (a line to subscribe, say). Passages of ``LONG``
  words stay: they are copies of a text.
* Everything else is judged by repetition. An element path of a host whose words
  are mostly covered by runs is boilerplate: the covered runs go and unique runs
  of ``RUN`` words stay. In a path that is mostly unique only the runs go that a
  fifth of the host's pages share. A long passage that less than half of the
  pages share is a (near) copy of a text and counts as unique. Where a host has
  too few pages, the same count over all hosts decides; without evidence, the
  class and id names and the presence of an article do.
* Adverts, sidebars, cookie notices, share lines and readers' comments are unique
  by nature, so repetition cannot tell: a class or id that begins with such a
  word, or a thread by its structure (three or more siblings of one kind, each a
  row with an author's or a time's look and a text), is left out wherever the
  page has other text. Without other text it is judged like the rest.

A name never takes an article: names on ``body``, ``article`` and ``main`` say
nothing, and an outermost article stays whatever its ancestors are called (an
article inside a named part of an article is a reader's comment). Outside the
article of a page that has one, any name goes before a verdict of text.

Pages whose articles and undecided blocks are equal count as one page, whatever
their menus are, so copies are no boilerplate. Large hosts are dealt out over several
shards; these send the runs of undecided blocks, as hashes with the number of
pages, and get the sums over the whole host back before anything is judged. Runs
of articles go with them if all their words may be widespread on the whole host;
the shards first tell each other which words of articles these are.

Defined cases: null or empty html gives an empty text; a null url is a host of
its own; broken or cut markup is read in one pass as far as it goes (a quote
without partner ends its tag at the next ``>``); repeated rows each get a row; an
empty table gives an empty result; columns other than page_id, url and html are
ignored.
"""

from __future__ import annotations

import hashlib
import html as references
import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm import tokens as tk
from riskweave.llm.suffixes import common_prefixes, concatenated, suffix_array
from riskweave.session import materialize

RUN = 6
HOST_PAGES, ALL_PAGES = 8, 20
MOSTLY = 0.5
#: Share of a host's different pages that must have a run before it counts against a single block.
SHARED_BY = 0.2
#: Words of a passage that counts as a copied text unless most pages have it.
LONG = 40
SHARD_BYTES = 2 << 20

# What elements and names mean (fixed values).
RAW = {"script", "style"}
GONE = {"nav", "header", "footer", "aside", "form", "head", "title", "noscript", "template", "button", "select", "textarea",
        "svg", "iframe", "object", "menu", "dialog", "canvas", "audio", "video", "map"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BREAK = {"br", "hr"}
BLOCK = {"address", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure",
         "h1", "h2", "h3", "h4", "h5", "h6", "html", "legend", "li", "ol", "p", "pre", "section", "summary", "table", "tbody",
         "td", "tfoot", "th", "thead", "tr", "ul"} | GONE | MAIN
CLOSES_ITSELF = {"p", "li", "dt", "dd", "tr", "td", "th"}
HINTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion",
         "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "signup", "sidebar",
         "side", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "topbar",
         "comment", "comments", "respond", "disqus", "share", "sharing", "social", "related", "widget", "toolbar", "pagination",
         "contentinfo", "complementary", "search"}

#: Words that name what is never the article when they begin a class or an id (fixed values).
SURE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "cookie", "cookies", "consent",
        "gdpr", "newsletter", "subscribe", "signup", "sidebar", "comment", "comments", "respond", "disqus", "share", "sharing", "social",
        "related", "breadcrumb", "breadcrumbs", "pagination"}
#: What a row with the author or the time of a remark looks like.
BYLINE = re.compile(
    r"\d{4}-\d\d?-\d\d?|\d\d?[./]\d\d?[./]\d\d|\d\d?:\d\d|\b\d+ (?:second|minute|hour|day|week|month|year)s? ago\b|\b(?:yesterday|reply|says|wrote)\b", re.I
)
BYLINE_WORDS, THREAD, NEAREST = 12, 3, 6

#: A tag without errors: it holds no angle bracket, and quotes only around values.
PLAIN_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/<>"'=]*)((?:[^<>"'=]|=\s*"[^<>"]*"|=\s*'[^<>']*'|=)*)>""")
NAMES = re.compile(r"""(?:^|[\s/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(\s*=\s*)?")
UNQUOTED = re.compile(r"[^\s>]*")
GAP = re.compile(r"[\s/]*")
NAMING = {"class", "id", "role"}
NAME_WORD = re.compile(r"[a-z]+")

KEEP, ASK, DROP = 0, 1, 2
#: Whether a block or an element around it has a name of HINTS, outside or inside
#: an article; the last two: it says for sure, or by its structure, that it is none.
UNNAMED, NAMED, NAMED_INSIDE, NOT_MAIN, NOT_MAIN_INSIDE = 0, 1, 2, 3, 4
INSIDE = (NAMED_INSIDE, NOT_MAIN_INSIDE)
#: Longer paths are not told apart: very deep nesting stays cheap.
MOST_PATH = 2000


class Markup:
    """Reads a page tag by tag in one pass, however broken the tags are.

    Attributes are read one by one. A quote without its partner is an error and
    the tag ends at the next ``>``; a tag without that ends with the page.
    """

    def __init__(self, html: str):
        self.html = html
        self.gone: set[str] = set()  # quotes that do not occur any more

    def _next(self, text: str, at: int) -> int:
        """Where ``text`` comes next; the end of the page if it does not."""
        found = -1 if text in self.gone else self.html.find(text, at)
        if found < 0:
            self.gone.add(text)
            return len(self.html)
        return found

    def attributes(self, at: int) -> tuple[str, int]:
        """The words of class, id and role, and where the tag ends."""
        html, names = self.html, []
        while True:
            at = GAP.match(html, at).end()
            if at >= len(html):
                return " ".join(names), at
            if html[at] == ">":
                return " ".join(names), at + 1
            found = ATTRIBUTE.match(html, at)
            at = found.end()
            value = ""
            if found[2]:
                quote = html[at : at + 1]
                if quote in ("'", '"') and quote:
                    end = self._next(quote, at + 1)
                    if end >= len(html):
                        return " ".join(names), min(self._next(">", at) + 1, len(html))
                    value, at = html[at + 1 : end], end + 1
                else:
                    plain = UNQUOTED.match(html, at)
                    value, at = plain[0], plain.end()
            if value and found[1].lower() in NAMING:
                names.append(value.lower())

    def next(self, at: int) -> tuple[str, str, bool, str, int]:
        """The text from ``at`` to the next tag, the tag's name, whether it
        closes, its naming words and its end; a comment and the end have no name."""
        html = self.html
        begin = self._next("<", at)
        while begin < len(html):
            plain = PLAIN_TAG.match(html, begin)
            if plain:
                given = plain[3]
                names = " ".join(x or y or z for x, y, z in NAMES.findall(given)).lower() if "=" in given else ""
                return html[at:begin], plain[2].lower(), bool(plain[1]), names, plain.end()
            first = html[begin + 1 : begin + 2]
            if first.isascii() and (first.isalpha() or first in ("!", "?", "/")) and first:
                break
            begin = self._next("<", begin + 1)
        else:
            return html[at:], "", False, "", len(html)
        text, closing = html[at:begin], html[begin + 1] == "/"
        named = TAG_NAME.match(html, begin + 1 + closing)
        if named:
            names, end = self.attributes(named.end())
            return text, named[0].lower(), closing, names, end
        mark, size = ("-->", 3) if html.startswith("<!--", begin) else (">", 1)
        return text, "", False, "", min(self._next(mark, begin + (4 if size == 3 else 1)) + size, len(html))


class Block:
    """A stretch of text, its element path and what the markup says of it."""

    __slots__ = ("path", "state", "hinted", "text")

    def __init__(self, path: str, state: int, hinted: int, text: str):
        self.path, self.state, self.hinted, self.text = path, state, hinted, text


def _name_hint(names: str, inside: bool) -> int:
    """What the class, id and role words of an element say."""
    words = NAME_WORD.findall(names)
    if any(found and found[0] in SURE for found in map(NAME_WORD.findall, names.split())):
        return NOT_MAIN_INSIDE if inside else NOT_MAIN
    return UNNAMED if HINTS.isdisjoint(words) else NAMED_INSIDE if inside else NAMED


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in order, white space already turned into single spaces."""
    root = ("", "", ASK, UNNAMED, -1)
    stack: list[tuple[str, str, int, int, int]] = []  # element, path, state, hinted, number
    opened: Counter = Counter()
    top = root
    found: list[Block] = []
    elements: list[tuple[int, str]] = []  # number of the parent, path
    around: list[list[int]] = []  # of each block the elements next to it, from the inside
    parts: list[str] = []

    def close() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                found.append(Block(top[1], top[2], top[3], text))
                around.append([e[4] for e in stack[: -NEAREST - 1 : -1]])

    markup, at = Markup(html), 0
    while at < len(html):
        piece, name, closing, names, at = markup.next(at)
        if piece:
            parts.append(references.unescape(piece) if "&" in piece else piece)
        if not name:
            continue
        if closing:
            if name in BLOCK:
                close()
                while opened[name]:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
                top = stack[-1] if stack else root
            continue
        if name in RAW:
            end = re.compile(rf"</{name}", re.I).search(html, at)
            at = end.start() if end else len(html)
            continue
        if name in BREAK:
            parts.append(" ")
        if name in VOID or name not in BLOCK:
            continue
        close()
        if name in CLOSES_ITSELF and stack and stack[-1][0] == name:
            stack.pop()
            opened[name] -= 1
            top = stack[-1] if stack else root
        state, hinted = top[2], top[3]
        main = name in MAIN or names == "main"
        if name in GONE:
            state = DROP
        elif state != DROP and main and hinted not in INSIDE:
            state, hinted = KEEP, UNNAMED
        elif hinted < NOT_MAIN and name not in ("html", "body") and not main:
            told = _name_hint(names, state == KEEP or hinted == NAMED_INSIDE)
            if told > hinted:
                hinted = told
                state = ASK if state == KEEP else state
        path = f"{top[1]}>{name}.{names}" if names else f"{top[1]}>{name}"
        elements.append((top[4], path))
        top = (name, path if len(path) <= MOST_PATH else top[1], state, hinted, len(elements) - 1)
        stack.append(top)
        opened[name] += 1
    close()
    _mark_threads(found, around, elements)
    return found


def _mark_threads(blocks: list[Block], around: list[list[int]], elements: list[tuple[int, str]]) -> None:
    """Marks remarks of readers: three or more siblings of one kind, each a row
    with an author's or a time's look and a text beside it."""
    bylines = [b.text.count(" ") < BYLINE_WORDS and BYLINE.search(b.text) is not None for b in blocks]
    if sum(bylines) < THREAD:
        return
    sizes: dict[int, list[int]] = {}
    for byline, own in zip(bylines, around, strict=True):
        for e in own:
            held = sizes.setdefault(e, [0, 0])
            held[0] += 1
            held[1] += byline
    kinds: dict[tuple[int, str], list[int]] = {}
    for e in sizes:
        kinds.setdefault(elements[e], []).append(e)
    threads = {e for own in kinds.values() if len(own) >= THREAD and all(sizes[e][0] > sizes[e][1] > 0 for e in own) for e in own}
    if threads:
        for b, own in zip(blocks, around, strict=True):
            if b.state != DROP and not threads.isdisjoint(own):
                b.hinted = NOT_MAIN_INSIDE if b.state == KEEP or b.hinted in INSIDE else NOT_MAIN
                b.state = ASK


def _hash(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _path_key(path: str, host: str | None = None) -> int:
    """Not negative; of the path over all hosts, or of one host."""
    return (_hash(path) if host is None else _hash(path, host)) & (2**63 - 1)


def _page_count_key(host: str) -> int:
    """The key under which the number of different pages of a host is summed."""
    return _hash("pages", host)


CUT = "host string, parts long, shard long, digest long, content long, paths array<string>, states array<int>, hints array<int>, texts array<string>"
CUT_FIELDS = [("content", pa.int64()), ("paths", pa.list_(pa.string())), ("states", pa.list_(pa.int32())), ("hints", pa.list_(pa.int32())), ("texts", pa.list_(pa.string()))]


def cut(batches):
    """Pages as blocks, without those that go anyhow; ``content`` tells different pages of a host apart."""
    for b in batches:
        found: list[list] = [[], [], [], [], []]
        for html, host in zip(b.column("html").to_pylist(), b.column("host").to_pylist(), strict=True):
            blocks = [x for x in blocks_of(html or "") if x.state != DROP]
            told = [t for x in blocks for t in (x.path if x.state == ASK else "", x.text)]
            values = _hash(host, *told), [x.path for x in blocks], [x.state for x in blocks], [x.hinted for x in blocks], [x.text for x in blocks]
            for column, value in zip(found, values, strict=True):
                column.append(value)
        keep = [n for n in b.schema.names if n != "html"]
        arrays = [b.column(n) for n in keep] + [pa.array(v, t) for v, (_, t) in zip(found, CUT_FIELDS, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *(n for n, _ in CUT_FIELDS)])


class Pages:
    """The pages of a shard in a fixed order, as blocks."""

    def __init__(self, table: pa.Table):
        ids, digests = table["page_id"].to_pylist(), table["digest"].to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, digests[i]))
        self.table = table.take(pa.array(order, pa.int64()))
        columns = (self.table[n].to_pylist() for n in ("paths", "states", "hints", "texts"))
        self.blocks = [[Block(*b) for b in zip(*page, strict=True)] for page in zip(*columns, strict=True)]
        self.hosts = self.table["host"].to_pylist()
        self.contents = self.table["content"].to_pylist()
        self.large = [n > 1 for n in self.table["parts"].to_pylist()]
        self.has_main = [any(b.state == KEEP for b in blocks) for blocks in self.blocks]
        # one page stands for all of its content
        seen: dict[int, int] = {}
        self.first = [seen.setdefault(c, i) for i, c in enumerate(self.contents)]
        self.of_host: dict[str, set] = {}
        for h, c in zip(self.hosts, self.contents, strict=True):
            self.of_host.setdefault(h, set()).add(c)

    def compared(self, host_pages: int) -> list[bool]:
        """Whether a page's articles are compared: its host has enough pages, or is in other shards too."""
        return [large or len(self.of_host[h]) >= host_pages for h, large in zip(self.hosts, self.large, strict=True)]


class Tokens:
    """The tokens of the pages that stand for others: markers and words.

    Articles are among them where ``articles`` says so, page by page.
    """

    def __init__(self, pages: Pages, articles: list[bool]):
        self.blocks: list[tuple[int, Block]] = []
        known: dict[str, int] = {}
        codes, lengths, page_of, pieces = [], [], [], []
        size = piece = 0
        for i, first in enumerate(pages.first):
            if first != i:
                continue
            piece += 1
            for b in pages.blocks[i]:
                piece += b.state == KEEP  # undecided runs do not reach over an article
                if b.state == KEEP and not articles[i]:
                    continue
                pieces.append(piece)
                # the markers of an article are its own: no run reaches over its borders
                path = b.path if b.state == ASK else f"{pages.contents[i]} {len(lengths)}"
                own = [f"<{path}", *b.text.split(" "), f"</{path}"]
                codes.append(np.fromiter(map(known.setdefault, own, itertools.count(size)), np.int64, len(own)))
                size += len(own)
                lengths.append(len(own))
                page_of.append(i)
                self.blocks.append((i, b))
        first = np.fromiter(known.values(), np.int64, len(known))  # rising
        self.numbers = np.searchsorted(first, np.concatenate(codes)) if codes else np.zeros(0, np.int64)
        self.words = list(known)
        self.sizes = np.array(lengths, dtype=np.int64)
        self.pages = np.repeat(np.array(page_of, dtype=np.int64), self.sizes)
        self.pieces = np.repeat(np.array(pieces, dtype=np.int64), self.sizes)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.asked = np.repeat(np.array([b.state == ASK for _, b in self.blocks], dtype=bool), self.sizes)

    def told_words(self, host: np.ndarray, words: dict[int, set[str]]) -> np.ndarray:
        """Whether each token is one of the words that are told for its host."""
        place = {w: n for n, w in enumerate(self.words)} if words else {}
        pairs = [h << 40 | place[w] for h, own in words.items() for w in own if w in place]
        return np.isin((host[self.pages] << 40) | self.numbers, np.array(pairs, dtype=np.int64))

    def widespread_stretches(self, host: np.ndarray, least: np.ndarray, run: int, told: np.ndarray, large: np.ndarray) -> np.ndarray:
        """Stretches of ``run`` tokens of articles each of which stands on ``least``
        pages of its host: no other run of an article can be that widespread.
        On the pages that are ``large``, ``told`` says which tokens do."""
        often = told & ~self.asked & large[self.pages]
        at = np.flatnonzero(~self.asked & ~large[self.pages])
        if len(at) and (np.bincount(host) >= least.min()).any():
            page = self.pages[at]
            _, word = np.unique((host[page] << 40) | self.numbers[at], return_inverse=True)
            pairs = np.unique(word.astype(np.int64) << 24 | page)  # a shard has fewer pages
            often[at] = np.bincount(pairs >> 24, minlength=int(word.max()) + 1)[word] >= least[page]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], often.view(np.int8), [0]])))
        for a, b in zip(edge[::2], edge[1::2], strict=True):
            if b - a < run:
                often[a:b] = False
        return often

    def run_keys(self, run: int, host: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The chosen tokens, a hash of the host and the run that starts at
        each, and whether one does (within its page, without a gap)."""
        at = np.flatnonzero(chosen)
        used, number = np.unique(self.numbers[at], return_inverse=True)
        word = np.array([_hash(self.words[w]) for w in used.tolist()], dtype=np.int64).view(np.uint64)
        n, page = max(0, len(at) - run + 1), self.pages[at]
        key = host[page[:n]].view(np.uint64).copy()
        for j in range(run):
            key ^= word[number[j : n + j]]
            key *= np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        last = at[run - 1 : run - 1 + n]
        inside = (self.pieces[at[:n]] == self.pieces[last]) & (last - at[:n] == run - 1)
        return at[:n], np.where(inside, key.view(np.int64), np.int64(-1)), inside


def _whole_runs(flags: np.ndarray, place: np.ndarray, run: int) -> np.ndarray:
    """Whether all ``run`` tokens from each place on are flagged."""
    before = np.concatenate([[0], np.cumsum(flags)])
    return before[np.minimum(place + run, len(flags))] - before[place] == run


def repeated_tokens(tokens: np.ndarray, pages: np.ndarray, hosts: np.ndarray, run: int = RUN, contents: np.ndarray | None = None, told: np.ndarray | None = None) -> np.ndarray:
    """For each token, the number of pages of its host that share the most
    widespread run of ``run`` tokens over it (0 if only one page has it).

    ``pages`` and ``hosts`` number the page and the host of each token. Pages
    of equal ``contents`` count as one. ``told`` gives the pages that have the
    run at a token where they were counted elsewhere, -1 where they were not.
    """
    contents = pages if contents is None else contents
    shared = np.zeros(len(tokens), dtype=np.int64)
    if len(tokens) < run:
        return shared
    _, symbols = np.unique(tokens, return_inverse=True)
    heads = np.flatnonzero(np.concatenate([[True], pages[1:] != pages[:-1]]))
    lengths = np.diff(np.append(heads, len(tokens)))
    x, places, sources = concatenated(heads, lengths, symbols, np.uint32)
    sa, rank = suffix_array(x, places, run)
    prefix = common_prefixes(x, sa, rank, run)
    origin = np.zeros(len(x), dtype=np.int64)
    origin[places] = sources
    start = origin[sa]
    group = np.cumsum(np.concatenate([[True], prefix[1:] < run])) - 1
    order = np.lexsort((contents[start], hosts[start], group))
    g, h, p = group[order], hosts[start][order], contents[start][order]
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (h[1:] != h[:-1])])
    fresh = np.concatenate([[True], new[1:] | (p[1:] != p[:-1])])
    number = np.cumsum(new) - 1
    several = np.bincount(number, weights=fresh).astype(np.int64)[number]
    several[several < 2] = 0
    inside = np.zeros(len(tokens), dtype=np.int64)
    inside[start[order]] = several
    if told is not None:
        inside = np.where(told >= 0, told, inside)
        inside[inside < 2] = 0
    # a suffix shorter than the run is no run; groups of such suffixes hold one page at most
    for j in range(run):
        shared[j:] = np.maximum(shared[j:], inside[: len(tokens) - j])
    return shared


SENT = "shard long, key long, n long, host string, word string"
#: What a shard gets to know: pages that another one counts, and words of articles that may be widespread.
NOTES = "shard long, content long, host string, word string"
WORDS = "host string, word string, n long, slack long"
#: Makes the key of a run whose words may all be widespread, counted in articles too.
EVERYWHERE = np.int64(0x5851F42D4C957F2D)
ASKED = "key long, shard long, pages long, tokens long, covered long, flags binary"
TEXT, BOILERPLATE, UNKNOWN = 0, 1, 2
COVERED, WIDESPREAD = 1, 2


def words_of_articles(table: pa.Table, foreign: pa.Table, mostly: float) -> pa.Table:
    """The words that so large a share of the articles here have, of each large
    host, with the number of pages; a row without a word has that of all pages.

    A word that is missing stands on ``slack`` pages here at most.
    """
    table, elsewhere = table.filter(pc.greater(table["parts"], 1)), set(foreign["content"].to_pylist())
    seen: dict[str, set] = {}
    found: dict[str, Counter] = {}
    for host, content, states, texts in zip(*(table[c].to_pylist() for c in ("host", "content", "states", "texts")), strict=True):
        if content in elsewhere or content in seen.setdefault(host, set()):
            continue
        seen[host].add(content)
        found.setdefault(host, Counter()).update({w for state, text in zip(states, texts, strict=True) if state == KEEP for w in text.split(" ")})
    rows = []
    for host, counts in found.items():
        n = len(seen[host])
        slack = max(0, math.ceil(mostly * n) - 1)
        rows += [(host, None, n, slack), *((host, w, c, slack) for w, c in counts.items() if c > slack)]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["host", "word", "n", "slack"])


def _has_stretch(blocks: list[Block], words: set[str], run: int) -> bool:
    """Whether ``run`` of the words follow each other in an article."""
    for b in blocks:
        n = 0
        for w in b.text.split(" ") if b.state == KEEP else ():
            n = n + 1 if w in words else 0
            if n >= run:
                return True
    return False


def _words_by_host(told: pa.Table) -> dict[str, set[str]]:
    out: dict[str, set[str]] = {}
    for h, w in zip(told["host"].to_pylist(), told["word"].to_pylist(), strict=True):
        out.setdefault(h, set()).add(w)
    return out


def send(table: pa.Table, notes: pa.Table, run: int) -> pa.Table:
    """The runs of the large hosts of a shard with the number of different pages
    that have them here; a page that another shard counts too counts there.

    Undecided runs have a key of their own. Runs of words that may be widespread
    in articles have a second one, for the pages with such a run anywhere; the
    pages with such a word in their article are sent beside it.
    """
    rows, words, counts = [np.zeros((0, 2), np.int64)], [], []
    shard = table["shard"][0].as_py() if len(table) else 0
    table = table.filter(pc.greater(table["parts"], 1))
    if len(table):
        pages = Pages(table)
        elsewhere = set(notes["content"].drop_null().to_pylist())
        known = _words_by_host(notes.filter(pc.is_valid(notes["word"])))
        none: set[str] = set()
        tokens = Tokens(pages, [_has_stretch(b, known.get(h, none), run) for h, b in zip(pages.hosts, pages.blocks, strict=True)])
        host = np.array([_hash(h) for h in pages.hosts], dtype=np.int64)
        number = {h: i for i, h in enumerate(pages.of_host)}
        numbers, large = np.array([number[h] for h in pages.hosts]), np.array(pages.large)
        content = np.array(pages.contents, dtype=np.int64)
        own = np.array([c not in elsewhere for c in pages.contents])
        told = tokens.told_words(numbers, {number[h]: w for h, w in known.items() if h in number})
        stretches = tokens.widespread_stretches(numbers, np.zeros(len(numbers)), run, told, large)
        place, key, inside = tokens.run_keys(run, host, tokens.asked | stretches)
        page = tokens.pages[place]
        for at, keys in ((inside & tokens.asked[place], key), (inside & _whole_runs(told, place, run), key ^ EVERYWHERE)):
            pairs = np.unique(np.stack([keys[at], content[page[at]], own[page[at]].astype(np.int64)], axis=1), axis=0)
            used, back = np.unique(pairs[:, 0], return_inverse=True)
            rows.append(np.stack([used, np.bincount(back.ravel(), weights=pairs[:, 2], minlength=len(used)).astype(np.int64)], axis=1))
        counted: dict[str, set] = {}
        found: dict[str, Counter] = {}
        for i, (h, c, o, blocks) in enumerate(zip(pages.hosts, pages.contents, own.tolist(), pages.blocks, strict=True)):
            counted.setdefault(h, set()).update([c] if o else [])
            if h in known and pages.first[i] == i:
                # a word of a page that is counted elsewhere is asked for too
                present = {w for b in blocks if b.state == KEEP for w in b.text.split(" ")} & known[h]
                found.setdefault(h, Counter()).update(dict.fromkeys(present, int(o)))
        rows.append(np.array([(_page_count_key(h), len(c)) for h, c in counted.items()], dtype=np.int64).reshape(-1, 2))
        words = [(h, w) for h, c in found.items() for w in c]
        counts = [(_hash("word", h, w), found[h][w]) for h, w in words]
    out = np.concatenate([np.array(counts, dtype=np.int64).reshape(-1, 2), *rows])
    rest = [None] * (len(out) - len(words))
    named = [pa.array([x[k] for x in words] + rest, pa.string()) for k in range(2)]
    return pa.table({"shard": pa.array(np.full(len(out), shard)), "key": pa.array(out[:, 0]), "n": pa.array(out[:, 1]), "host": named[0], "word": named[1]})


def without_copies(shared: np.ndarray, tokens: Tokens, pages_of_host: np.ndarray, run: int, mostly: float) -> np.ndarray:
    """``shared`` with 0 in long passages (gaps below a run included) that few of the host's pages have."""
    out = shared.copy()
    for (_, b), begin, size, n in zip(tokens.blocks, tokens.begins.tolist(), tokens.sizes.tolist(), pages_of_host.tolist(), strict=True):
        if size < LONG:
            continue
        most = max(3, mostly * n) if b.state == ASK else np.inf  # no long passage of an article goes
        few = np.flatnonzero((shared[begin : begin + size] > 0) & (shared[begin : begin + size] < most))
        if not len(few):
            continue
        for passage in np.split(few, np.flatnonzero(np.diff(few) > run) + 1):
            if passage[-1] - passage[0] + 1 >= LONG:
                out[begin + passage] = 0
    return out


def judge(table: pa.Table, answers: pa.Table, run: int, host_pages: int, mostly: float, shared_by: float) -> pa.Table:
    """The evidence of a shard per element path, of each host and of all, and
    which words of the undecided blocks are covered.

    ``answers``: what :func:`send` sent, summed over the shards; pages with n
    below 0 are counted elsewhere."""
    if not len(table):
        return pa.table({n: pa.array([], t) for n, t in zip(("key", "shard", "pages", "tokens", "covered", "flags"), [pa.int64()] * 5 + [pa.binary()], strict=True)})
    pages, shard = Pages(table), table["shard"][0].as_py()
    tokens = Tokens(pages, pages.compared(host_pages))
    common = answers.filter(pc.is_valid(answers["word"]))
    answers = answers.filter(pc.is_null(answers["word"]))
    told = answers["n"].to_numpy() >= 0
    elsewhere = set(answers["key"].to_numpy()[~told].tolist())
    order = np.argsort(answers["key"].to_numpy()[told])
    keys, sums = answers["key"].to_numpy()[told][order], answers["n"].to_numpy()[told][order]
    contents = pages.of_host
    number = {h: i for i, h in enumerate(contents)}
    distinct = {h: len(c) for h, c in contents.items()}
    for h in {h for h, large in zip(pages.hosts, pages.large, strict=True) if large}:
        at = np.searchsorted(keys, _page_count_key(h))
        distinct[h] = int(sums[at]) if at < len(keys) and keys[at] == _page_count_key(h) else 1
    evidence: dict[int, list[int]] = {}
    flags = np.zeros(0, np.uint8)
    if len(tokens.numbers):
        host = np.array([number[h] for h in pages.hosts])
        content = np.unique(pages.contents, return_inverse=True)[1]
        least = np.maximum(host_pages, mostly * np.array([distinct[h] for h in pages.hosts], dtype=np.int64))
        large = np.array(pages.large)
        wide = _words_by_host(common.filter(pc.greater_equal(common["n"], pa.array([max(host_pages, mostly * distinct.get(h, 0)) for h in common["host"].to_pylist()], pa.float64()))))
        often = tokens.told_words(host, {number[h]: w for h, w in wide.items() if h in number})
        chosen = tokens.asked | tokens.widespread_stretches(host, least, run, often, large)
        asked_elsewhere = np.full(len(tokens.numbers), -1, dtype=np.int64)
        if any(pages.large):
            place, key, inside = tokens.run_keys(run, np.array([_hash(h) for h in pages.hosts], dtype=np.int64), chosen)
            key = np.where(_whole_runs(often, place, run), key ^ EVERYWHERE, key)
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            known = inside & (keys[at] == key) if len(keys) else np.zeros(len(key), bool)
            asked_elsewhere[large[tokens.pages]] = 0
            known &= large[tokens.pages[place]]
            asked_elsewhere[place[known]] = sums[at[known]]
        at = np.flatnonzero(chosen)
        page = tokens.pages[at]
        piece = np.cumsum(np.concatenate([[0], (np.diff(at) > 1) | (np.diff(page) > 0)])) if len(at) else at
        shared = np.zeros(len(tokens.numbers), dtype=np.int64)
        shared[at] = repeated_tokens(tokens.numbers[at], piece, host[page], run, content[page], asked_elsewhere[at])
        of_block = np.array([distinct[pages.hosts[i]] for i, _ in tokens.blocks], dtype=np.int64)
        article = ~tokens.asked
        shared = without_copies(shared, tokens, of_block, run, mostly)
        least = np.where(article, np.repeat(np.maximum(host_pages, mostly * of_block), tokens.sizes), np.repeat(np.maximum(3, shared_by * of_block), tokens.sizes))
        flags = (COVERED * (shared > 0) + WIDESPREAD * ((shared > 0) & (shared >= least))).astype(np.uint8)
        covered = np.add.reduceat((shared > 0).astype(np.int64), tokens.begins)
        counts: dict[tuple[str, str], list] = {}
        for (i, b), n, c in zip(tokens.blocks, tokens.sizes.tolist(), covered.tolist(), strict=True):
            if b.state != ASK:
                continue
            entry = counts.setdefault((pages.hosts[i], b.path), [set(), 0, 0])
            if pages.contents[i] not in elsewhere:
                entry[0].add(pages.contents[i])
                entry[1] += n
                entry[2] += c
        for (h, path), (which, n, c) in counts.items():
            told_by = [_path_key(path, h), _path_key(path)]
            for k, key in enumerate(told_by):
                total = evidence.setdefault(key, [0, 0, 0])
                if k == 0 or distinct[h] >= host_pages:
                    total[0] += len(which)
                    total[1] += n
                    total[2] += c
    rows = [(key, shard, *total, None) for key, total in evidence.items()]
    rows.append((-1 - shard, shard, 0, 0, 0, flags.tobytes()))
    kinds = [pa.int64()] * 5 + [pa.binary()]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["key", "shard", "pages", "tokens", "covered", "flags"])


def _remaining(words: list[str], flags: np.ndarray, verdict: int, run: int, named: bool) -> list[str]:
    """What stays of a block: in text all but widespread runs, in boilerplate the unique runs."""
    if verdict == TEXT:
        return [w for w, f in zip(words, flags.tolist(), strict=True) if not f & WIDESPREAD]
    if named:
        return []
    unique = np.flatnonzero(flags & COVERED == 0)
    stretches = np.split(unique, np.flatnonzero(np.diff(unique) > 1) + 1)
    return [words[k] for s in stretches if len(s) >= run for k in s]


def assemble(table: pa.Table, told: pa.Table, run: int, host_pages: int, all_pages: int, mostly: float) -> pa.Table:
    """The text of each page from the blocks and runs that stay."""
    pages = Pages(table)
    compared = pages.compared(host_pages)
    places, size = {}, 0
    for i, first in enumerate(pages.first):
        if first == i:
            places[i] = size
            size += sum(b.text.count(" ") + 3 for b in pages.blocks[i] if b.state == ASK or compared[i])
    sums, flags = {}, np.zeros(0, np.uint8)
    for key, n, size, covered, f in zip(*(told[c].to_pylist() for c in ("key", "pages", "tokens", "covered", "flags")), strict=True):
        if key < 0:
            flags = np.frombuffer(f, np.uint8)
        else:
            sums[key] = n, size, covered

    def verdict(key: int, least: int) -> int:
        n, size, covered = sums.get(key, (0, 0, 0))
        return UNKNOWN if n < least else int(covered >= mostly * size)

    texts = []
    for i, blocks in enumerate(pages.blocks):
        at = places[pages.first[i]]
        has_main = pages.has_main[i]
        kept: list[tuple[bool, str]] = []  # whether it is surely no main text, what stays
        for b in blocks:
            if b.state == KEEP and not compared[i]:
                kept.append((False, b.text))
                continue
            n = b.text.count(" ") + 1
            own = flags[at + 1 : at + 1 + n]
            at += n + 2
            if b.state == KEEP:
                kept.append((False, " ".join(_remaining(b.text.split(" "), own, TEXT, run, False)) if own.any() else b.text))
                continue
            words = b.text.split(" ")
            judged = verdict(_path_key(b.path, pages.hosts[i]), host_pages)
            if judged == UNKNOWN:
                judged = verdict(_path_key(b.path), all_pages)
                if judged == BOILERPLATE or (judged == UNKNOWN and (has_main or b.hinted)):
                    continue
                judged = TEXT
            if judged == TEXT and has_main and b.hinted == NAMED:
                continue
            kept.append((b.hinted >= NOT_MAIN, " ".join(_remaining(words, own, judged, run, bool(b.hinted)))))
        other = any(text for none, text in kept if not none)
        texts.append(" ".join(text for none, text in kept if text and not (none and other)))
    return pa.table({"page_id": pages.table["page_id"], "url": pages.table["url"], "text": pa.array(texts, pa.string())})


def _shard(host: Column, part: Column, shards: int) -> Column:
    """Where a part (a long) of a host goes."""
    return F.pmod(F.xxhash64(host, part), F.lit(shards))


def main_text(
    pages: DataFrame,
    run: int = RUN,
    host_pages: int = HOST_PAGES,
    all_pages: int = ALL_PAGES,
    mostly: float = MOSTLY,
    shared_by: float = SHARED_BY,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """page_id, url, text: one row per page.

    The blocks of the pages are shuffled once, by shards of hosts; the exchange
    serves counting, judging and assembling. Hosts larger than a shard (their
    number is bounded by the number of shards) are dealt out over several, and
    their runs are summed by key over the shards, those of articles too.
    """
    body = F.coalesce("html", F.lit(""))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", body.alias("html"), host.alias("host"))
    sizes = materialize(rows.groupBy("host").agg(F.sum(F.octet_length("html")).alias("bytes")), "hosts")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    large = materialize(sizes.where(F.col("bytes") > shard_bytes).select(F.col("host").alias("_host"), F.ceil(F.col("bytes") / shard_bytes).alias("parts")), "large-hosts")
    parts = F.coalesce("parts", F.lit(1)).cast("long")
    placed = rows.join(large, F.col("host") == F.col("_host"), "left").select(
        "page_id",
        "url",
        "html",
        "host",
        parts.alias("parts"),
        _shard(F.col("host"), F.pmod(F.xxhash64("html", "url", "page_id"), parts), shards).alias("shard"),
        F.xxhash64("html", "url").alias("digest"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema if f.name in ("page_id", "url")}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, {CUT}"
    blocks = placed.mapInArrow(cut, schema)
    dealt = blocks.repartition(shards, "shard")
    spark = pages.sparkSession
    answers = spark.createDataFrame([], SENT)
    if not large.isEmpty():
        # pages that stand in several shards count in the first of them
        where = placed.where("parts > 1").mapInArrow(cut, schema).groupBy("content").agg(F.collect_set("shard").alias("shards")).where(F.size("shards") > 1)
        copies = where.select("content", F.array_min("shards").alias("owner"), F.explode("shards").alias("shard")).where("shard <> owner")
        foreign = materialize(copies.select("shard", "content"), "copies")
        words = dealt.groupBy("shard").cogroup(foreign.groupBy("shard")).applyInArrow(lambda t, f: words_of_articles(t, f, mostly), WORDS)
        # a word can be on so many pages of the host only if those told of and the slack of the other shards reach them
        counted = words.groupBy("host", "word").agg(F.sum("n").alias("n"), F.sum("slack").alias("slack"))
        of_host = Window.partitionBy("host")
        whole = {c: F.max(F.when(F.col("word").isNull(), F.col(c))).over(of_host) for c in ("n", "slack")}
        reach = counted.withColumns({"pages": whole["n"], "most": whole["slack"]})
        common = reach.where("word IS NOT NULL").where(F.col("n") + F.col("most") - F.col("slack") >= F.greatest(F.lit(float(host_pages)), F.lit(mostly) * F.col("pages")))
        every = large.select("_host", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        shards_of = every.select("_host", _shard(F.col("_host"), F.col("part"), shards).alias("shard")).distinct()
        told = common.select("host", "word").join(shards_of, F.col("host") == F.col("_host"))
        notes = foreign.select("shard", "content", F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("word")).unionByName(
            told.select("shard", F.lit(None).cast("long").alias("content"), "host", "word")
        )
        sent = dealt.groupBy("shard").cogroup(notes.groupBy("shard")).applyInArrow(lambda t, f: send(t, f, run), SENT)
        # one row a shard and key: the blocks' exchange serves all steps of one job
        total = sent.withColumn("n", F.sum("n").over(Window.partitionBy("key"))).where("n > 1")
        elsewhere = foreign.select("shard", F.col("content").alias("key"), F.lit(-1).cast("long").alias("n"))
        answers = total.unionByName(elsewhere, allowMissingColumns=True)
    asked = dealt.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(lambda t, a: judge(t, a, run, host_pages, mostly, shared_by), ASKED)
    of_key = Window.partitionBy("key")
    told = asked.withColumns({c: F.sum(c).over(of_key) for c in ("pages", "tokens", "covered")})
    out = f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    return dealt.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(lambda t, a: assemble(t, a, run, host_pages, all_pages, mostly), out)
