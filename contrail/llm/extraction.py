"""Main text of web pages by consensus host paths.

Pass one scores every page's containers and lets the page vote for the
generalised tag-class path of its best one; Spark adds the votes up per host
and path. Pass two re-extracts each page at its host's winning path, or at its
own best container where the page has no such path.

Reading a page takes time and memory in proportion to its length, also where
quotes stay open or elements nest deeply: an element knows the one around it
instead of its whole path, and where tags end is worked out once.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import table
from contrail.session import materialize

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
TAG = re.compile(NAME.pattern + r"""((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
UNFINISHED = re.compile(r"<[a-zA-Z][^<>]*+(?:>|\Z)")
QUOTES = re.compile("""[>"']""")
CLASS = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr img nobr").split())
CONTAINERS = frozenset("body main article section div td center".split())
CLOSED_BY_BLOCK = frozenset(["p"])
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
            "option": {"option"}}
SCOPES = frozenset("table ul ol dl article section div main body nav aside footer header form blockquote td th".split())
BOILERPLATE = frozenset("nav aside footer form script style head noscript template iframe button select menu dialog object svg canvas".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
PREFERRED = {"article": 3.0, "main": 2.0}
HEADLINES = frozenset("h1 h2 h3 h4 h5 h6 th".split())
#: Words in class and id names that mark what is not the article.
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|adsbygoogle|banner|sponsor\w*|promo\w*|sidebar\w*|side|menu\w*|\w*nav|navbar|navigation|"
    r"breadcrumbs?|masthead|footer|foot|comments?|commentlist|respond|replies|disqus|discussion|cookies?|consent|gdpr|notice|notices|alert|"
    r"popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|widget\w*|pagination|pager|toolbar|"
    r"skip|tags)(?:$|[\s_-]|\d)", re.I)
#: Words that mark a header: of one inside the article the headline belongs to it.
HEAD = re.compile(r"(?:^|[\s_-])(?:header|heading|headline)(?:$|[\s_-]|\d)", re.I)
#: Names that tell what a layout has beside it (``with-sidebar``), not what the element is.
BESIDE = re.compile(r"(?:^|(?<=[\s_-]))(?:has|no|with|without)[_-][\w-]+", re.I)
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    """An open element: its tag and label, the element around it (inline ones apart), the number and length of its
    path, and whether it is outside the article, in a link, a header, an ``h1`` or an ``h1`` or ``h2``."""

    __slots__ = ("tag", "label", "up", "path", "length", "noise", "link", "head", "title", "headline")

    def __init__(self, tag: str, label: str, up: Node | None, path: int, noise: bool, link: bool, head: bool):
        self.tag, self.label, self.up, self.path, self.noise, self.link, self.head = tag, label, up, path, noise, link, head
        self.length = up.length + 1 + len(label) if up else 0
        self.title = tag == "h1" or bool(up and up.title)
        self.headline = tag in ("h1", "h2") or bool(up and up.headline)

    def path_text(self) -> str:
        labels, n = [], self
        while n.up:
            labels.append(f"/{n.label}")
            n = n.up
        return "".join(reversed(labels))


class Block:
    """A run of text between block boundaries, with the innermost element it lies in (inline ones apart)."""

    __slots__ = ("parts", "link", "node")

    def __init__(self, node: Node):
        self.parts, self.link, self.node = [], 0, node

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


class Scanner:
    """Markup of a page from front to back."""

    def __init__(self, page: str):
        self.page = page
        self.places: list[int] | None = None

    def _ends(self) -> None:
        """By place of a ``>`` or quote: where a tag ends that reaches it outside quotes (-1: nowhere), worked out from the end."""
        self.places = [m.start() for m in QUOTES.finditer(self.page)]
        self.ends = [-1] * (len(self.places) + 1)
        later: dict[str, int] = {}
        for k in range(len(self.places) - 1, -1, -1):
            c = self.page[self.places[k]]
            if c == ">":
                self.ends[k] = self.places[k]
            else:
                if c in later:
                    self.ends[k] = self.ends[later[c] + 1]
                later[c] = k

    def _tag(self, start: int) -> re.Match | None:
        name = NAME.match(self.page, start)
        if name is None:
            return None
        if self.places is not None and self.ends[bisect_left(self.places, name.end())] < 0:
            return None
        m = TAG.match(self.page, start)
        if m is None:
            self._ends()  # the first tag without an end: from here on no search for one goes through the page again
        return m

    def token(self, at: int) -> tuple[int, int, str, str | None, str] | None:
        """(start, end, slash, name, attributes) of the next markup; no name for comments, declarations and unfinished tags.

        None if only text follows. A ``<`` that begins nothing is text.
        """
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                close = page.find("-->", start + 4)
                return start, close + 3 if close >= 0 else len(page), "", None, ""
            m = self._tag(start)
            if m:
                return start, m.end(), m.group(1), m.group(2).lower(), m.group(3)
            if page.startswith(("<!", "<?", "</"), start):
                close = page.find(">", start + 2)
                return start, close + 1 if close >= 0 else len(page), "", None, ""
            m = UNFINISHED.match(page, start)
            if m:
                return start, m.end(), "", None, ""
            at = start + 1
        return None


def label(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """``tag.class`` with digits generalised, and whether the names or role mark boilerplate, or a header."""
    classes, noise, head = "", False, False
    if attributes:
        for kind, a, b, c in CLASS.findall(attributes):
            value = a or b or c
            if kind.lower() == "class":
                classes = ".".join(sorted(set(re.sub(r"\d+", "#", value.lower()).split())))
            if kind.lower() == "role":
                noise = noise or value.lower() in ROLES
                continue
            names = BESIDE.sub("", HUMP.sub("-", value))
            noise, head = noise or bool(NOISE.search(names)), head or bool(HEAD.search(names))
    return (f"{tag}.{classes}" if classes else tag), noise, head


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, boilerplate ones included."""
    root = Node("", "", None, 0, False, False, False)
    stack, around, out, at, end = [root], [root], [], 0, len(page)  # around: the innermost block element of each open one
    number, opened, scanner = {}, Counter(), Scanner(page)
    current = Block(root)

    def cut() -> None:
        nonlocal current
        if current.parts:
            out.append(current)
        current = Block(around[-1])

    def say(text: str) -> None:
        if text:
            text = html.unescape(text) if "&" in text else text
            current.parts.append(text)
            if stack[-1].link:
                current.link += len(text)

    def close_to(index: int) -> None:
        opened.subtract(n.tag for n in stack[index:])
        del stack[index:], around[index:]

    while at < end:
        token = scanner.token(at)
        if token is None:
            say(page[at:])
            break
        start, stop, slash, tag, attributes = token
        say(page[at:start])
        at = stop
        if tag is None:
            continue
        if slash:
            if not opened[tag]:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    block = any(n.tag not in INLINE for n in stack[i:])
                    close_to(i)
                    if block:
                        cut()
                    break
                if stack[i].tag in SCOPES and tag in INLINE | {"p", "li"}:
                    break
            continue
        if tag == "br":
            current.parts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                cut()
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        inline, ended = tag in INLINE, CLOSED_BY_BLOCK | SIBLINGS.get(tag, frozenset())
        if not inline and any(opened[t] for t in ended):
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph, an item its sibling
                if stack[i].tag in ended:
                    close_to(i)
                    if tag not in SIBLINGS:
                        break
                elif stack[i].tag in SCOPES:
                    break
        above, up = stack[-1], around[-1]
        name, noise, head = label(tag, attributes)
        whole = tag in ("body", "html", "article", "main")
        noise = above.noise or tag in BOILERPLATE or (noise and not whole)
        head = above.head or tag == "header" or (head and not whole and tag not in HEADLINES)
        path = up.path if inline else number.setdefault((up.path, name), len(number) + 1)
        stack.append(Node(tag, name, up, path, noise, above.link or tag == "a", head))
        around.append(up if inline else stack[-1])
        opened[tag] += 1
        if not inline:
            cut()
    cut()
    return out


def lineage(found: list[Block]) -> list[Node]:
    """The elements around the blocks, each once, outer ones first."""
    seen: set[Node] = set()
    order: list[Node] = []
    for b in found:
        n, new = b.node, []
        while n is not None and n not in seen:
            seen.add(n)
            new.append(n)
            n = n.up
        order.extend(reversed(new))
    return order


def scores(found: list[Block]) -> dict[int, tuple[float, Node]]:
    """Score and first element by path number: unlinked text of the blocks, whole for the nearest container, less for each one further out.

    The small loss per level prefers the container that holds all parts of the text over its largest part.
    """
    carried: dict[Node, float] = {}
    for b in found:
        if b.node.noise:
            continue
        text = b.text()
        worth = (len(text) - 1.5 * b.link) * (0.2 if b.node.head else 1.0) + min(3, text.count(",") + text.count("."))
        carried[b.node] = carried.get(b.node, 0.0) + worth
    total: dict[int, tuple[float, Node]] = {}
    for n in reversed(lineage(found)):
        worth = carried.pop(n, None)
        if worth is None:
            continue
        if n.tag in CONTAINERS or n.tag == "":
            total[n.path] = (total.get(n.path, (0.0,))[0] + worth * PREFERRED.get(n.tag, 1.0), n)
            worth *= 0.85
        if n.up:
            carried[n.up] = carried.get(n.up, 0.0) + worth
    return total


def best_path(found: list[Block]) -> tuple[str, float]:
    """Path of the page's best container (the shorter, then first by name, of equals); the root for a page without text."""
    total = scores(found)
    if not total:
        return "", 0.0
    top = max(score for score, _ in total.values())
    equal = [n for score, n in total.values() if score == top]
    least = min(n.length for n in equal)
    node = min((n for n in equal if n.length == least), key=lambda n: n.path_text() if len(equal) > 1 else "")
    return with_headline(found, node).path_text(), top


def with_headline(found: list[Block], node: Node) -> Node:
    """The container, or where no headline lies in its path the nearest one above it, inside the body, that has one."""
    seen: set[Node] = set()
    held: set[int] = set()
    for b in found:
        n = b.node if b.node.title and not b.node.noise else None
        while n is not None and n not in seen:
            seen.add(n)
            if n.tag in CONTAINERS and n.tag != "body":
                held.add(n.path)
            n = n.up
    n = node
    while n is not None and n.path not in held:
        n = n.up
    return n or node


def main_text(found: list[Block], path: str) -> str | None:
    """Blocks at or below the path without boilerplate; None if no element has the path."""
    reached: dict[Node, tuple[int, bool]] = {}  # how much of the path an element spells (-1: leaves it), whether it is inside
    for n in lineage(found):
        at, inside = reached[n.up] if n.up else (0, False)
        if n.up and at >= 0:
            step = f"/{n.label}"
            at = at + len(step) if path.startswith(step, at) else -1
        reached[n] = at, inside or at == len(path)
    within = [b for b in found if reached[b.node][1]]
    if not within:
        return None
    texts = []
    for b in within:
        if b.node.noise or (b.node.head and not b.node.headline):
            continue  # of a header inside the article only the headline belongs to it
        text = b.text()
        if text:
            texts.append(text)
    return "\n\n".join(texts)


def host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1))


def host_paths(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(host, path, votes) of each host's winning path; votes are counted, ties go to the higher total score, then the first path.

    Pages without any text don't vote. A null url has the empty host, a host like any other.
    """
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, values = [], [], []
            for of, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                path, score = best_path(blocks(page.as_py() or ""))
                if score > 0:
                    hosts.append(of)
                    paths.append(path)
                    values.append(score)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(values, pa.float64())],
                                             ["host", "path", "score"])

    votes = pages.select(host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(
        vote, "host string, path string, score double")
    summed = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"))
    return summed.groupBy("host").agg(F.min(F.struct(-F.col("votes"), -F.col("score"), "path")).alias("w")).select(
        "host", F.col("w.path").alias("path"), (-F.col("w.col1")).alias("votes"))


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Main text of every row of ``pages(page_id, url, html)``: ``page_id, url, text, path, consensus``.

    Blocks in page order are joined by two line breaks; null, empty or text-less html gives the
    empty text. ``consensus`` tells whether the host's path was found in the page. Repeated rows give a
    row each, an empty table none; other columns are left out whatever they are called.
    """
    paths = materialize(spark, host_paths(spark, pages), "host-paths")  # written: its size decides the join, not a hint
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host(F.col("url")).alias("host"))
    joined = rows.join(paths.withColumnRenamed("host", "voted"), F.col("host") == F.col("voted"), "left").select("page_id", "url", "html", "path")
    kinds = [joined.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, used, agreed = [], [], []
            for page, path in zip(batch.column(2), batch.column(3).to_pylist()):
                found = blocks(page.as_py() or "")
                text = None if path is None else main_text(found, path)
                agreed.append(text is not None)
                if not text:
                    path = best_path(found)[0]
                    text = main_text(found, path) or ""
                texts.append(text)
                used.append(path)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(used, pa.string()),
                                              pa.array(agreed, pa.bool_())], ["page_id", "url", "text", "path", "consensus"])

    return joined.mapInArrow(cut, f"page_id {kinds[0]}, url {kinds[1]}, text string, path string, consensus boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
