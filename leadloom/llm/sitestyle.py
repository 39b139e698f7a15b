"""Main text of web pages by site style trees.

The pages of one host are merged into a style tree: elements with the same chain of tags and classes are one node.
Equal pages of a host are one page of it: each of c copies weighs 1 / c. A node has two importances, both from entropies over the m pages that have it. Presentation: the entropy
of its sequences of children, in units of log m; a node that always looks alike tells nothing. Content: one less
the mean of log(k) / log(m) over the texts below it, where k pages share a text; text that all pages
repeat tells nothing. With l different presentations, the composite importance is ``(1 - G**l)`` of the
first and ``G**l`` of the second, G = 0.9. Branches of low importance leave each page.

A branch is never cut if it holds the page's article or most of its text (without an article, of the text outside low
branches), and a site needs ``MIN_PAGES`` pages with a node to
judge it. What elements say of themselves (tag, role, class, id) removes navigation, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments on small sites too. A class or id alone condemns neither an article or
main element, unless it names another kind of text (comments, adverts, related pages), nor an element that holds most of
the text of its page or article.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.linefreq import host_of
from leadloom.session import materialise

MIN_PAGES = 5
MIN_IMPORTANCE = 0.25
DAMPING = 0.9

_BEGIN = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_STOP = re.compile(r"[>\"']")
_SIMPLE = re.compile(r"[^<>]*>")
#: Elements nested deeper become siblings at this depth.
_DEEPEST = 128
_ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: Elements whose content is not text of the page.
_SKIPPED = frozenset("script style noscript template iframe svg math canvas object video audio head title textarea select datalist map".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
#: Elements that end when one of the given elements begins.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_NOISE_TAGS = frozenset("nav footer aside form menu dialog button fieldset".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
_NOISE_WORDS = re.compile(
    r"(?:nav|navbar|navigation|menus?|submenu|sidebar|footer|masthead|topbar|breadcrumbs?|ads?|adverts?|advert\w+|adsense|banner|sponsor\w*|promo\w*"
    r"|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related"
    r"|recommended|comments?|commentlist|disqus|replies|respond|widgets?|toolbar|pagination|pager|copyright|disclaimer|skip|hidden)"
)
#: Class names that tell how a container is laid out, not what it is.
_LAYOUT = re.compile(r"(?:has|with|without|no|is|js)[_-]")
#: Words for texts of another kind than the page's; the other noise words may also tell the layout around its text.
_OTHER_TEXT = re.compile(
    r"(?:ads?|adverts?|advert\w+|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|related|recommended|comments?|commentlist|disqus|replies|respond|copyright|disclaimer)"
)
_HEADER_WORDS = frozenset(("header", "head", "hdr"))
#: Words that go with a noise word in a name that is noise as a whole; inside an article other names tell what a part is about.
_HELPERS = re.compile(r"(?:posts?|lists?|items?|box|block|section|area|wrap(?:per)?|container|links?|articles?|stories|content|bar|buttons?|form|site|main|page|top|bottom|left|right|inner|outer|unit|slot|\d+)")
#: Of several articles side by side, those with this share of the largest one's text are its parts.
_PART = 0.25
#: An article or main element with less than this share of the text outside noise around it is a teaser.
_TEASER = 0.2


#: Inside an article, such elements are text and are never judged by their site.
_PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption".split())


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _tag_end(source: str, at: int) -> int:
    """Place of the first ``>`` outside quotes, -1 if there is none."""
    while (m := _STOP.search(source, at)) is not None:
        if m[0] == ">":
            return m.start()
        at = source.find(m[0], m.end()) + 1
        if not at:
            return -1
    return -1


def _all_noise(name: str) -> bool:
    """Whether a class or id consists of noise words and words that go with them."""
    words = [w.lower() for w in re.split(r"[_-]+|(?<=[a-z])(?=[A-Z])", name) if w]
    return any(map(_NOISE_WORDS.fullmatch, words)) and all(_NOISE_WORDS.fullmatch(w) or _HELPERS.fullmatch(w) for w in words)


class Page:
    """Elements and text blocks of one page; inline elements are part of their block."""

    def __init__(self, source: str):
        self.parent, self.tag, self.words, self.noisy, self.main, self.hidden = [-1], [""], [()], [False], [False], [False]
        self.children: list[list[str]] = [[]]
        self.blocks: list[tuple[int, str]] = []
        self._named, self._other = set(), set()  # noise by class or id alone; of these, other kinds of text
        self._stack, self._text = [0], []
        self._open_tags: dict[str, int] = {}
        self._within = [False]  # whether a main element is around each
        self._read(source)
        self._pardon()

    def _flush(self) -> None:
        if self._text:
            line = " ".join(entities.unescape("".join(self._text)).split())
            self._text = []
            if line:
                self.blocks.append((self._stack[-1], line))

    def _pop(self, names: tuple[str, ...], stop: frozenset[str] = frozenset()) -> None:
        """Close the innermost open element of the given names, unless one of ``stop`` is inside out before it."""
        if not any(self._open_tags.get(n) for n in names):
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            if self.tag[self._stack[depth]] in names:
                for e in self._stack[depth:]:
                    self._open_tags[self.tag[e]] -= 1
                del self._stack[depth:]
                return
            if self.tag[self._stack[depth]] in stop:
                return

    def _open(self, tag: str, rest: str) -> None:
        if len(self._stack) > _DEEPEST:
            self._open_tags[self.tag[self._stack.pop()]] -= 1
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)} if rest and "=" in rest else {}
        names = [x for name in ("class", "id") for x in found.get(name, "").split() if not _LAYOUT.match(x)]
        small = sorted({w.lower() for x in names for w in re.split(r"[_-]+|(?<=[a-z])(?=[A-Z])", x) if w})
        role = found.get("role", "").lower()
        own = tag in ("article", "main") or role in ("article", "main")
        here = len(self.tag)
        self.parent.append(self._stack[-1])
        self.tag.append(tag)
        self.words.append(tuple(w for w in small if not any(c.isdigit() for c in w)))
        other = any(_OTHER_TEXT.fullmatch(w) for w in small)
        self.main.append(own and not other)
        hides = "hidden" in rest.lower().split() or re.search(r"display\s*:\s*none", found.get("style", "")) is not None
        self.hidden.append(hides or found.get("aria-hidden", "").lower() == "true")
        inside = self._within[self._stack[-1]] or self.main[self._stack[-1]]
        self._within.append(inside)
        named = tag not in ("html", "body") and any(_NOISE_WORDS.fullmatch(w) for w in small) and (not inside or any(map(_all_noise, names)))
        headed = tag not in ("h1", "h2", "h3", "h4", "h5", "h6") and any(w in _HEADER_WORDS for w in small) and not inside
        sure = tag in _NOISE_TAGS or role in _NOISE_ROLES or (tag == "header" and not inside)
        worded = (named or headed) and not self.main[here]
        self.noisy.append(sure or worded)
        if worded and not sure:
            self._named.add(here)
            if other:
                self._other.add(here)
        self.children[self._stack[-1]].append(self.name(here))
        self.children.append([])
        self._stack.append(here)
        self._open_tags[tag] = self._open_tags.get(tag, 0) + 1

    def name(self, e: int) -> str:
        return ".".join((self.tag[e], *self.words[e]))

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        quoted, unclosed = True, set()  # whether quotes are heeded; skipped elements that end nowhere below
        stop_p = frozenset(("article", "main", "section", "div", "td", "body", "li", "blockquote"))
        stop_list = {"li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",))}
        while at < end:
            m = _BEGIN.search(source, at)
            if m is None:
                self._text.append(source[at:])
                break
            if m.start() > at:
                self._text.append(source[at : m.start()])
            if m[2] is None:
                close = {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0], ">")
                stop = source.find(close, m.end())
                if stop < 0 and close == ">":  # no tag ends below
                    self._text.append(source[m.start() :])
                    break
                at = end if stop < 0 else stop + len(close)
                continue
            stop = _tag_end(source, m.end()) if quoted else -1
            if stop < 0:
                # a quote that swallows all that follows: from here on quotes mean nothing, so that no tag is read to the end again
                simple = None if quoted else _SIMPLE.match(source, m.end())
                quoted = False
                if simple is None:
                    self._text.append("<")
                    at = m.start() + 1
                    continue
                stop = simple.end() - 1
            rest, at = source[m.end() : stop], stop + 1
            tag, closing = m[2].lower(), bool(m[1])
            if tag in _SKIPPED:
                if not closing and not rest.rstrip().endswith("/"):
                    close = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\b[^<>]*>", re.I).search(source, at)
                    if close is not None:
                        at = close.end()
                    elif tag not in ("head", "title"):
                        at = end
                    else:
                        unclosed.add(tag)
                self._text.append(" ")
                continue
            if tag in _INLINE:
                continue
            if tag in _VOID:
                if tag == "hr":
                    self._flush()
                elif tag == "br":
                    self._text.append(" ")
                continue
            self._flush()
            if closing:
                self._pop((tag,))
                continue
            self._pop(("p",), stop_p)
            if tag in _CLOSES:
                self._pop(_CLOSES[tag], stop_list.get(tag, frozenset(("table",))))
            self._open(tag, rest)
        self._flush()

    def _pardon(self) -> None:
        """Elements that are noise by class or id only, and hold most of the text of the page or their article, are no noise.

        Text in what is noise for another reason doesn't count. Other kinds of text are pardoned only if there is no text besides.
        """
        if not self._named:
            return
        size = len(self.tag)
        own = [0] * size
        for e, line in self.blocks:
            own[e] += len(line)
        clean, every = own[:], own[:]  # below each element: outside all noise, and outside noise for other reasons
        for e in range(size - 1, 0, -1):
            sure = self.hidden[e] or (self.noisy[e] and e not in self._named)
            every[self.parent[e]] += 0 if sure else every[e]
            clean[self.parent[e]] += 0 if sure or self.noisy[e] else clean[e]
        home = [0] * size  # the innermost main element around each
        for e in range(1, size):
            up = self.parent[e]
            home[e] = up if self.main[up] else home[up]
        for e in self._named:
            if any(2 * every[e] > every[a] and (e not in self._other or not clean[a]) for a in {0, home[e]}):
                self.noisy[e] = False

    def paths(self) -> list[int]:
        """A 64-bit signed hash of every element's chain of names."""
        chain = [0]
        for e in range(1, len(self.tag)):
            chain.append(_hash(f"{chain[self.parent[e]]}/{self.name(e)}"))
        return chain

    def article(self) -> tuple[int, ...]:
        """The main elements: the article with most text and its parts beside it, else a main element, else the page.

        An article or main element that holds a small share of the text around it is a teaser, not the page's text.
        """
        length = [0] * len(self.tag)
        for e, line in self.blocks:
            length[e] += len(line)
        for e in range(len(self.tag) - 1, 0, -1):
            if self.hidden[e] or (self.noisy[e] and not self.main[e]):
                length[e] = 0
            length[self.parent[e]] += length[e]
        home = [0] * len(self.tag)  # the outermost main element around each, or the page
        for e in range(1, len(self.tag)):
            up = self.parent[e]
            home[e] = home[up] or (up if self.main[up] and self.tag[up] != "article" else 0)
        for kind in ("article", "main"):
            found = [e for e in range(1, len(self.tag)) if self.main[e] and length[e] and (self.tag[e] == kind or kind == "main")]
            found = [e for e in found if not self._within[e] or not any(self.main[a] and self.tag[a] == kind for a in self._above(e))] or found
            found = [e for e in found if length[e] >= _TEASER * length[home[e]] and length[e] >= _TEASER * length[0]]
            if found:
                best = max(found, key=lambda e: (length[e], -e))
                parts = [e for e in found if self.parent[e] == self.parent[best] and self.tag[e] == "article" and length[e] >= _PART * length[best]]
                return tuple(parts) if self.tag[best] == "article" and len(parts) > 1 else (best,)
        return (0,)

    def _above(self, e: int) -> Iterator[int]:
        e = self.parent[e]
        while e >= 0:
            yield e
            e = self.parent[e]

    def text(self, low: set[int]) -> str:
        """Blocks of the main element outside noise and branches of low importance."""
        roots = set(self.article())
        whole = 0 in roots
        paths = self.paths() if low else []
        held, total = self._held(roots, [p in low for p in paths]) if low else ([], 0)
        gone = [not whole]
        for e in range(1, len(self.tag)):
            poor = bool(low) and paths[e] in low and self.tag[e] not in ("html", "body") and not (not whole and self.tag[e] in _PLAIN)
            poor = poor and 2 * held[e] <= total
            gone.append(e not in roots and (gone[self.parent[e]] or self.noisy[e] or self.hidden[e] or poor))
        return "\n".join(line for e, line in self.blocks if not gone[e])

    def _held(self, roots: set[int], low: list[bool]) -> tuple[list[int], int]:
        """Characters of the main elements' text outside noise below each element, and of all of it; of a page without one, only outside low branches."""
        whole = 0 in roots
        out = [not whole]
        for e in range(1, len(self.tag)):
            out.append(e not in roots and (out[self.parent[e]] or self.noisy[e] or self.hidden[e]))
        held, total = [0] * len(self.tag), 0
        for e, line in self.blocks:
            if not out[e] and (not whole or not low[e]):
                held[e] += len(line)
                total += len(line)
        for e in range(len(self.tag) - 1, 0, -1):
            held[self.parent[e]] += held[e]
        return held, total

    def nodes(self) -> list[tuple[int, int, list[int]]]:
        """(path, presentation, texts below) for every node of the page, nodes of the same path together."""
        paths = self.paths()
        texts: dict[int, set[int]] = {}
        below: list[set[int] | None] = [None] * len(paths)
        for e, line in self.blocks:
            below[e] = below[e] or set()
            below[e].add(_hash(line))
        for e in range(len(paths) - 1, -1, -1):
            some, below[e] = below[e], None
            if some:
                up = self.parent[e]
                texts.setdefault(paths[e], set()).update(some)
                if e and below[up] is None:
                    below[up] = some
                elif e:
                    below[up] |= some
        looks: dict[int, set[str]] = {}
        for e, path in enumerate(paths):
            row = self.children[e]
            looks.setdefault(path, set()).add(" ".join(name for i, name in enumerate(row) if i == 0 or row[i - 1] != name))
        return [(p, _hash("|".join(sorted(s))), sorted(texts.get(p, ()))) for p, s in looks.items()]


def style_nodes(pages: DataFrame) -> DataFrame:
    """(host, html, copies) -> (host, node, style, texts, weight), one row for each page and node; weight is 1 / copies."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = zip(batch["host"], batch["html"], batch["copies"], strict=True)
            rows = [(host, *node, 1 / copies) for host, source, copies in cells if source for node in Page(source).nodes()]
            if rows:
                yield pd.DataFrame(rows, columns=["host", "node", "style", "texts", "weight"])

    columns = pages.select("host", F.coalesce("html", F.lit("")).alias("html"), "copies")
    return columns.mapInPandas(run, "host string, node bigint, style bigint, texts array<bigint>, weight double")


def with_copies(pages: DataFrame) -> DataFrame:
    """(host, html) with ``copies``, the number of rows of the host with the same html.

    Only hashes of host and html are grouped; the list of those with copies is joined: broadcast if Spark finds it small.
    """
    marked = pages.select("host", "html", F.xxhash64("host", F.col("host").isNull(), "html").alias("_page"))
    again = materialise(marked.groupBy("_page").agg(F.count("*").alias("copies")).filter("copies > 1"))
    return marked.join(again, "_page", "left").select("host", "html", F.coalesce("copies", F.lit(1)).alias("copies"))


def node_importance(nodes: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(host, node) -> pages, presentation, content and importance, from entropies; all sums are partial before the shuffle.

    Pages are counted by the column ``weight`` if there is one. The copies of a page have equal rows, so sums of weights are whole
    but for rounding.
    """
    count = F.round(F.sum("weight")).cast("bigint") if "weight" in nodes.columns else F.count("*")
    weight = ["weight"] if "weight" in nodes.columns else []
    entry = lambda text, key: F.struct(F.lit(text).alias("text"), key.alias("key"))
    entries = F.concat(F.array(entry(False, F.col("style"))), F.transform("texts", lambda t: entry(True, t)))
    seen = nodes.select("host", "node", *weight, F.inline(entries)).groupBy("host", "node", "text", "key").agg(count.alias("c"))
    n, look = F.col("c"), ~F.col("text")
    looks = seen.groupBy("host", "node").agg(
        F.sum(F.when(look, n)).alias("pages"), F.count_if(look).alias("styles"), F.sum(F.when(look, n * F.log(n))).alias("s"),
        F.sum(F.when(F.col("text"), n)).alias("all"), F.sum(F.when(F.col("text"), n * F.log(n))).alias("w"),
    )
    m = F.col("pages").cast("double")
    shown = F.when(F.col("pages") > 1, (F.log(m) - F.col("s") / m) / F.log(m)).otherwise(1.0)
    both = looks.withColumn("presentation", shown)
    content = F.when(F.col("pages") > 1, F.coalesce(1 - F.col("w") / F.col("all") / F.log(m), F.lit(0.0))).otherwise(1.0)
    damped = F.pow(F.lit(damping), F.col("styles"))
    both = both.withColumn("content", content)
    return both.select("host", "node", "pages", "presentation", "content", ((1 - damped) * F.col("presentation") + damped * F.col("content")).alias("importance"))


def main_text(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), min_pages: int = MIN_PAGES, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """``keep``, text and n_chars of every row of (url, html).

    White space inside a block is one space, blocks are joined by line ends in page order, character references are decoded;
    markup that never ends is read to the end of the page. Null and empty pages have an empty text; pages without a host
    form one site; repeated rows get the same text; an empty table gives no rows. The list of low
    branches is joined by host: broadcast if Spark finds it small, split where a host is skewed.
    """
    hosted = pages.select(*keep, host_of("url").alias("host"), "html")
    judged = node_importance(style_nodes(with_copies(hosted)))
    low = judged.filter((F.col("pages") >= min_pages) & (F.col("importance") < min_importance))
    by_host = materialise(low.groupBy("host").agg(F.collect_list("node").alias("low")))
    joined = hosted.join(by_host, "host", "left").select(*keep, "html", "low")

    @F.pandas_udf("string")
    def extract(sources: pd.Series, lows: pd.Series) -> pd.Series:
        return pd.Series([Page(s).text(set() if n is None else set(n)) if s else "" for s, n in zip(sources, lows, strict=True)], dtype=object)

    done = joined.select(*keep, extract("html", "low").alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("bigint"))
