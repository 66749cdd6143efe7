"""Main text of web pages by removal of what a site's pages share.

Every page becomes a tree of elements, and every element's subtree a hash. Spark counts, for
each host, on how many pages of different content each subtree occurs; subtrees on many pages of a host are its
template and are deleted. Elements that say what they are (navigation, adverts, forms and
the like, by tag, class, id or role) go in any case, which serves hosts with few pages. An
article may quote what others say, so paragraphs inside one go only if they recur on a large
share of the host's pages, or are short and stand at the article's edge. What stands outside
articles and is neither template nor marked is text of the page like any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, matched, stored

# A subtree is a template's if it occurs on so many pages of a host and this share of them,
# or on as many pages as are beyond doubt on a host of any size.
TEMPLATE_PAGES, TEMPLATE_SHARE, MANY_PAGES = 4, 0.1, 50
# A paragraph inside an article needs a larger share, and as many pages to be beyond doubt.
PROSE_SHARE, PROSE_PAGES = 0.3, 20
# Below that share, paragraphs of so many words go if they occur on so many pages.
LONG_WORDS, LONG_PAGES = 8, 500
# Recurring paragraphs at an article's edge go up to so many words.
EDGE_WORDS = 25
# Doubtful paragraphs beyond so many go only if they hold at most half of an article's text:
# pages that share most of their text are versions of one article.
DOUBTFUL = 2

# --- fixed values: what HTML elements are -------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tr td th figure figcaption".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 pre".split())
GROUPS = frozenset("blockquote ul ol dl table figure".split())  # prose that holds prose; their parts are no blocks
ROOTS = frozenset("html body article main".split())
DROPPED = frozenset(
    "head nav footer aside form script style noscript template iframe svg button select input textarea "
    "dialog menu object canvas audio video title option datalist noembed xmp".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|respond|replies)(?:$|[\s_-])")
# Names that say that a page has, lacks or is about something, not that an element is it.
ABOUT = re.compile(r"(?:^|\s)(?:has|have|no|not|with|without|is|category|tag|post|page|type|format|style|layout|theme|section|container)[_-]\S*")
SIGNS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|breadcrumbs?|"
    r"sidebar|footer|header|masthead|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|"
    r"subscri\w+|signup|login|social|share|sharing|related|recommend\w*|comments?|commentlist|disqus|respond|"
    r"replies|widget|toolbar|pagination|pager|copyright|legal|disclaimer|skip)(?:$|[\s_-])"
)
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]), "tbody": frozenset(["thead", "tbody", "tr", "td", "th"]),
}
SCOPES = frozenset("ul ol dl table article main section body html div".split())
# ------------------------------------------------------------------------------------------

# Levels of templates: outside articles and, if short, at their edges; inside articles if the
# article keeps its text; inside articles if long; inside articles in any case.
OUTSIDE, DOUBTED, LONG, EVERYWHERE = 1, 2, 3, 4
LEVELS = 7  # the bits that hold a level

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.DOTALL,
)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)


class Tree:
    """Elements in page order: tag, attributes, parent and what they hold (text or places)."""

    def __init__(self, html: str):
        self.tags, self.attributes, self.parents, self.items = ["#root"], [""], [-1], [[]]
        self.measured: tuple[list[int], list[bool]] | None = None
        opened = [0]
        at, size = 0, len(html)
        while at < size:
            found = _TOKEN.search(html, at)
            if found is None:
                self._text(opened[-1], html[at:])
                break
            if found.start() > at:
                self._text(opened[-1], html[at : found.start()])
            at = found.end()
            tag = found[2] or found[5]
            if not tag:
                continue
            tag = tag.lower()
            if found[1] or found[4]:
                self._close(opened, tag)
                continue
            self._make_room(opened, tag)
            place = len(self.tags)
            self.tags.append(tag)
            self.attributes.append(found[3] or found[6] or "")
            self.parents.append(opened[-1])
            self.items.append([])
            self.items[opened[-1]].append(place)
            if tag in RAW:
                # what is inside is no markup, and no text of the page
                end = re.compile(f"</{re.escape(tag)}\\s*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else size
            elif tag not in VOID and not self.attributes[-1].rstrip().endswith("/"):
                opened.append(place)

    def _text(self, place: int, text: str) -> None:
        self.items[place].append(unescape(text) if "&" in text else text)

    def _make_room(self, opened: list[int], tag: str) -> None:
        """Closes what a new element ends by starting."""
        if tag not in INLINE:
            for depth in range(len(opened) - 1, 0, -1):
                if self.tags[opened[depth]] == "p":
                    del opened[depth:]
                    break
                if self.tags[opened[depth]] not in INLINE:
                    break
        ended = CLOSED_BY.get(tag)
        if ended:
            for depth in range(len(opened) - 1, 0, -1):
                name = self.tags[opened[depth]]
                if name in ended:
                    del opened[depth:]
                    if tag not in ("tr", "tbody"):
                        break
                elif name in SCOPES:
                    break

    def _close(self, opened: list[int], tag: str) -> None:
        for depth in range(len(opened) - 1, 0, -1):
            name = self.tags[opened[depth]]
            if name == tag:
                del opened[depth:]
                return
            if tag in INLINE and name not in INLINE:
                return  # an inline element does not end a block
            if tag in PROSE and name in ROOTS:
                return

    def hashes(self) -> list[int]:
        """A hash for every subtree, 0 where it holds no text."""
        out = [0] * len(self.tags)
        for place in range(len(self.tags) - 1, -1, -1):
            parts = []
            for item in self.items[place]:
                if isinstance(item, int):
                    if out[item]:
                        parts.append(f"{out[item]:x}")
                elif words := item.split():
                    parts.append(" ".join(words))
            if parts:
                text = f"{self.tags[place]}\0{self.named(place)[0]}\0" + "\0".join(parts)
                # the lowest bits are left for the level of a template
                out[place] = xxhash.xxh3_64_intdigest(text) & ~LEVELS or LEVELS + 1
        return out

    def named(self, place: int) -> tuple[str, bool]:
        """Class and id, and whether role or visibility make an element boilerplate."""
        text = self.attributes[place]
        if not text:
            return "", False
        names, odd = [], False
        for key, value in _NAMED.findall(text):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id"):
                names.append(value)
            elif key == "role":
                odd |= value in ROLES
            elif key == "style":
                odd |= "display:none" in value.replace(" ", "")
            else:
                odd |= key == "hidden" or value == "true"
        return " ".join(names), odd

    def _weights(self) -> tuple[list[int], list[bool]]:
        """Characters of text below each element, and whether an article or main is there."""
        count = len(self.tags)
        weights, holds = [0] * count, [False] * count
        for place in range(count - 1, -1, -1):
            tag = self.tags[place]
            weights[place] += sum(len(x) for x in self.items[place] if isinstance(x, str) and not x.isspace())
            holds[place] |= tag in ("article", "main")
            if place and tag not in RAW and tag not in ("head", "nav", "footer", "aside"):
                weights[self.parents[place]] += weights[place]
                holds[self.parents[place]] |= holds[place]
        return weights, holds

    def _is_page(self, place: int, names: str) -> bool:
        """Whether what is marked as boilerplate holds the page itself: most of its text, and
        for comments, which may be longer than what they are about, an article as well."""
        if self.measured is None:
            self.measured = self._weights()
        weights, holds = self.measured
        return 2 * weights[place] > weights[0] and (holds[place] or not COMMENTS.search(names))

    def _blocks(self, root: int, gone: list[bool], levels: dict[int, int], hashes: list[int]) -> list[tuple]:
        """(place, level, words, characters) of an article's paragraphs and other text (place 0)."""
        out, todo = [], [root]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                if words := item.split():
                    out.append((0, 0, len(words), sum(map(len, words))))
            elif not gone[item]:
                tag = self.tags[item]
                level = levels.get(hashes[item], 0) if tag in PARAGRAPHS or tag in GROUPS else 0
                if level or tag in PARAGRAPHS:
                    words = self._words(item, gone)
                    if words:
                        out.append((item, level, len(words), sum(map(len, words))))
                else:
                    todo += self.items[item][::-1]
        return out

    def _words(self, place: int, gone: list[bool]) -> list[str]:
        words, todo = [], [place]
        while todo:
            item = todo.pop()
            if isinstance(item, str):
                words += item.split()
            elif not gone[item]:
                todo += self.items[item]
        return words

    def _cut(self, root: int, gone: list[bool], levels: dict[int, int], hashes: list[int]) -> None:
        """Marks the recurring paragraphs of an article as gone."""
        blocks = self._blocks(root, gone, levels, hashes)
        cut = {
            at for at, x in enumerate(blocks) if x[1] == EVERYWHERE or x[1] == LONG and x[2] >= LONG_WORDS
        }
        doubtful = {at for at, x in enumerate(blocks) if x[1] == DOUBTED}
        for order in (range(len(blocks)), range(len(blocks) - 1, -1, -1)):
            for at in order:
                if at in cut or at in doubtful:
                    continue
                if not blocks[at][1] or blocks[at][2] > EDGE_WORDS:
                    break
                doubtful.add(at)
        size = sum(blocks[at][3] for at in doubtful)
        whole = sum(x[3] for at, x in enumerate(blocks) if at not in cut)
        if 2 * size <= whole or len(doubtful) <= DOUBTFUL and size < whole:
            cut |= doubtful
        for at in cut:
            gone[blocks[at][0]] = True

    def text(self, levels: dict[int, int]) -> str:
        """The page's blocks of text, one per line, without templates of these levels."""
        hashes = self.hashes() if levels else []
        count = len(self.tags)
        gone, inside = [False] * count, [False] * count
        roots = []  # outermost articles
        for place in range(1, count):
            tag, above = self.tags[place], self.parents[place]
            inside[place] = inside[above] or tag in ("article", "main")
            if gone[above]:
                gone[place] = True
                continue
            names, odd = self.named(place)
            own = ABOUT.sub(" ", names)
            if odd or tag in DROPPED and not (tag == "form" and self._is_page(place, own)):
                gone[place] = True
            elif (
                tag not in ROOTS and not (tag == "header" and inside[above])
                and SIGNS.search(own) and not self._is_page(place, own)
            ):
                gone[place] = True
            elif tag == "header" and not inside[above]:
                gone[place] = True
            elif levels and hashes[place] in levels and tag not in ROOTS and not (
                inside[above] and (tag in PROSE or tag in INLINE)
            ):
                gone[place] = True
            elif inside[place] and not inside[above]:
                roots.append(place)
        if levels:
            for root in roots:
                self._cut(root, gone, levels, hashes)
        blocks: list[str] = []
        open_block: list[str] = []

        def end() -> None:
            if words := "".join(open_block).split():
                blocks.append(" ".join(words))
            open_block.clear()

        todo: list = [0]
        while todo:
            item = todo.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                open_block.append(item)
            elif not gone[item]:
                tag = self.tags[item]
                if tag == "br":
                    open_block.append(" ")
                elif tag in INLINE:
                    todo += self.items[item][::-1]
                else:
                    end()
                    todo.append(None)
                    todo += self.items[item][::-1]
        end()
        return "\n".join(blocks)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted subtrees of each page, subtree 0 included, and a hash of its content.

    The content is the text without marked elements, so that mirrors, print views and copies
    with other adverts are one page.
    """
    for batch in batches:
        pages, found = [], []
        for html in batch.column("html").to_pylist():
            tree = Tree(html or "")
            own = {
                value for tag, value in zip(tree.tags, tree.hashes())
                if value and tag not in INLINE and tag not in ROOTS and tag != "#root"
            }
            own.add(0)
            pages.append(xxhash.xxh3_64_intdigest(tree.text({})) - 2**63)
            found.append(np.sort(np.array(list(own), np.uint64).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("doc"), pa.array(pages, pa.int64()),
             pa.array(found, pa.list_(pa.int64()))],
            ["host", "doc", "page", "subtrees"],
        )


def _levels(marks: Iterable[int]) -> dict[int, int]:
    """The level of each template from hashes that bear their level."""
    return {x % 2**64 & ~LEVELS: x & LEVELS for x in marks}


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple, dict[int, int]] = {}
    for batch in batches:
        texts = []
        columns = (batch.column(name).to_pylist() for name in ("html", "template", "rare"))
        for html, template, rare in zip(*columns):
            key = tuple(template or ())
            if key not in known:
                known.clear()
                known[key] = _levels(key)
            levels = known[key] | _levels(rare) if rare else known[key]
            texts.append(Tree(html or "").text(levels))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(x) for x in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def main_texts(
    pages: DataFrame,
    least_pages: int = TEMPLATE_PAGES,
    least_share: float = TEMPLATE_SHARE,
    many_pages: int = MANY_PAGES,
) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    The text is that of the whole page without what is deleted; blocks are in page order,
    one per line. Outside articles a subtree is deleted that occurs on ``least_pages`` and
    ``least_share`` of a host's pages, or on ``many_pages``. Paragraphs, lists and tables as a whole inside an
    article are, where they occur on a share of ``PROSE_SHARE`` or are long and on ``LONG_PAGES``, or as above if they have up
    to ``EDGE_WORDS`` words and nothing but deleted ones stand between them and the edge.
    A null or empty html gives an empty text. Pages without a host, and a null url, have
    no template. Pages of a host with equal text beside
    marked elements count as one page. Other columns are ignored.
    """
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)", 1))
    hosted = pages.select("page_id", "url", "html", F.coalesce(host, F.lit("")).alias("host"))
    named = hosted.filter("host <> ''").select("host", "html", F.xxhash64("host", "html").alias("doc"))
    subtrees = map_arrow(named, _subtrees, "host string, doc long, page long, subtrees array<long>")
    # of the copies of a page the one with most subtrees counts
    distinct = subtrees.groupBy("host", "page").agg(
        F.max(F.struct(F.size("subtrees").alias("size"), "subtrees")).alias("most")
    )
    counted = distinct.select("host", F.explode("most.subtrees").alias("subtree")).groupBy("host", "subtree").agg(
        F.count(F.lit(1)).alias("n")
    )
    counts = stored(counted.filter(f"subtree = 0 OR n >= {least_pages}"), "subtree_counts")
    totals = counts.filter("subtree = 0").select("host", F.col("n").alias("pages"))
    level = F.expr(
        f"CASE WHEN n >= pages * {PROSE_SHARE} THEN if(n < {PROSE_PAGES}, {DOUBTED}, {EVERYWHERE}) "
        f"WHEN n >= {LONG_PAGES} THEN {LONG} ELSE {OUTSIDE} END"
    )
    shares = counts.filter("subtree <> 0").join(totals, "host").select(
        "host", "subtree", F.col("subtree").bitwiseOR(level).alias("mark"),
        (F.col("n") >= F.col("pages") * least_share).alias("common"), "n",
    )
    # A page has few subtrees and each common template covers a share of pages, so lists are
    # short; written out, they have a size by which Spark decides whether to broadcast them.
    templates = stored(
        shares.filter("common").groupBy("host").agg(F.sort_array(F.collect_list("mark")).alias("template")),
        "templates",
    )
    joined = hosted.join(templates, "host", "left")
    # Of the others a large host may have any number: a page gets those that it holds.
    others = stored(
        shares.filter(f"NOT common AND n >= {many_pages}").select(
            F.xxhash64("host", "subtree").alias("subtree"), "mark"
        ),
        "rare_templates",
    )
    if others.isEmpty():
        joined = joined.withColumn("rare", F.lit(None).cast("array<long>"))
    else:
        held = subtrees.select("host", "doc", F.explode("subtrees").alias("subtree")).select(
            "doc", F.xxhash64("host", "subtree").alias("subtree")
        )
        rare = stored(
            matched(held, others, "subtree", "inner").groupBy("doc").agg(F.collect_set("mark").alias("rare")),
            "rare_templates_of_pages",
        )
        joined = joined.withColumn("doc", F.xxhash64("host", "html")).join(rare, "doc", "left")
    joined = joined.select("page_id", "url", "html", "template", "rare")
    return map_arrow(joined, _texts, "page_id long, url string, text string, n_chars long")
