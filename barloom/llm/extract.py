"""Main text of HTML pages by tree scoring.

Paragraphs pass points, for their length and commas, to their ancestors; a link's
share of the text discounts them. The best container is kept with those of its
siblings that score or read like it, and what is no article inside is left out.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame

from barloom.llm import frames

# Elements of HTML by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
NEVER = frozenset(
    "script style noscript template textarea title head iframe object embed svg math canvas audio video select "
    "option button input form nav footer aside menu dialog noembed noframes xmp fieldset label".split()
)
PARAGRAPHS = frozenset("p pre td blockquote li dd".split())
CLOSES_P = BLOCK - {"body", "html", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot"}
START_POINTS = {"article": 10, "main": 8, "section": 3, "div": 5, "pre": 3, "td": 3, "blockquote": 3, "ul": -3, "ol": -3, "dl": -3,
                "li": -3, "th": -5, "h1": -5, "h2": -5, "h3": -5, "h4": -5, "address": -3}
# Words in class, id or role that mark what is not the article, and what is.
UNWANTED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|consent|cookies?|disqus|disclaimer|"
    r"footer|foot|gdpr|login|masthead|menu|modal|nav\w*|newsletter|notices?|outbrain|pager|pagination|popup|promo\w*|"
    r"recommend\w*|related|remark|replies|reply|respond|search|share|sharing|shoutbox|sidebar|signup|site-?header|"
    r"skip|social|sponsor\w*|subscri\w*|tags|toolbar|topbar|widget|complementary|navigation|alert)(?:$|[\s_-])"
)
WANTED = re.compile(r"(?:^|[\s_-])(?:article\w*|body|content|entry|hentry|main|post|story|text)(?:$|[\s_-])")

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


class Node:
    __slots__ = ("tag", "parent", "children", "names", "hidden", "points", "length", "links", "commas")

    def __init__(self, tag: str, parent: Node | None, rest: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        found = NAMES.findall(rest) if "=" in rest else ()
        self.names = " ".join(value.strip("\"'").lower() for _, value in found)
        self.hidden = bool(rest) and HIDDEN.search(rest) is not None
        self.points = 0.0
        self.length = self.links = self.commas = 0


def parse(page: str) -> Node:
    """The page's elements as a tree; texts are strings among the children. Missing ends are implied."""
    root = here = Node("html", None)
    at = 0
    while at < len(page):
        mark = TOKEN.search(page, at)
        text = page[at : mark.start() if mark else len(page)]
        if text:
            here.children.append(html.unescape(text))
        if mark is None:
            break
        at = mark.end()
        if mark["cdata"]:
            here.children.append(mark["cdata"])
        if mark["name"] is None:
            continue
        tag = mark["name"].lower()
        if mark["close"]:
            node = here
            while node is not None and node.tag != tag:
                node = None if node.tag in ("td", "th", "article", "main") and tag not in BLOCK else node.parent
            if node is not None and node.parent is not None:
                here = node.parent
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P or tag == "li":
            node, over = here, {"p"} | ({"li"} if tag == "li" else set())
            while node.parent is not None and node.tag not in BLOCK - over:
                if node.tag in over:
                    here = node.parent
                    break
                node = node.parent
        elif tag in ("td", "th", "tr", "dd", "dt"):
            over = {"tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, ("dd", "dt"))
            node = here
            while node.parent is not None and node.tag not in ("table", "dl"):
                if node.tag in over:
                    here = node.parent
                node = node.parent
        new = Node(tag, here, mark["rest"])
        here.children.append(new)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = len(page) if end is None else page.find(">", end.start()) + 1 or len(page)
        elif not mark["rest"].endswith("/") or tag in BLOCK:
            here = new
    return root


def unwanted(node: Node) -> bool:
    """Whether the element is none of the article, by its tag or names."""
    if node.tag in NEVER or node.hidden:
        return True
    if node.tag == "header":  # of the page, unless it stands in the article
        above = node.parent
        while above is not None and above.tag not in ("article", "main"):
            above = above.parent
        return above is None
    if node.tag in ("article", "main", "body", "html") or not node.names:
        return False
    return UNWANTED.search(node.names) is not None


def order(root: Node) -> list[Node]:
    """All elements but those in unwanted ones, parents first."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        found.append(node)
        todo.extend(c for c in reversed(node.children) if not isinstance(c, str) and not unwanted(c))
    return found


def measure(nodes: list[Node]) -> None:
    """Text length, length within links, and commas of each element."""
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, str):
                n = len(child) if child.strip() else 0
                node.length += n
                node.commas += child.count(",") + child.count("，") + child.count("、")
        if node.tag == "a":
            node.links = node.length
        if node.parent is not None:
            node.parent.length += node.length
            node.parent.links += node.links
            node.parent.commas += node.commas


def density(node: Node) -> float:
    return node.links / node.length if node.length else 0.0


def score(nodes: list[Node]) -> list[Node]:
    """Points of the containers, discounted by link density; the containers with any."""
    held: list[Node] = []
    for node in nodes:
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        if node.tag in PARAGRAPHS:
            length = node.length
        elif node.tag in BLOCK and own >= 25:  # a container whose text stands in it directly
            length = own
        else:
            continue
        if length < 25:
            continue
        points = 1 + node.commas + min(length / 100, 3)
        above = node.parent if node.tag in PARAGRAPHS else node
        for level in range(4):
            if above is None:
                break
            if above.points == 0:
                held.append(above)
                above.points = START_POINTS.get(above.tag, 0) + 0.01
                if above.names:
                    above.points += 25 * (WANTED.search(above.names) is not None)
            above.points += points / (1, 2, 6, 9)[level]
            above = above.parent
    for node in held:
        node.points *= 1 - density(node)
    return held


def blocks(node: Node, out: list[str]) -> None:
    """The texts of the blocks in a kept element, in page order."""
    line: list[str] = []

    def close() -> None:
        text = " ".join("".join(line).split())
        if text:
            out.append(text)
        line.clear()

    todo: list = [node]
    while todo:
        item = todo.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            line.append(item)
        elif item.tag == "br":
            line.append(" ")
        elif item is node or not unwanted(item):
            if item.tag in BLOCK:
                close()
                todo.append(None)
            todo.extend(reversed(item.children))
    close()


ENDS = re.compile(r"[.!?。！？][\"'”’)\]]*$")


def beside(best: Node, articles: list[Node]) -> list[Node]:
    """The best container and those siblings that score or read like it, in page order.

    Around an article or main, siblings are tried on each level up to the outermost one that
    holds it; short paragraphs without links, headers with a title, and elements that hold a
    like article count there too, headings after which nothing is kept do not.
    """
    article = best.tag in ("article", "main")
    least = max(10.0, 0.2 * best.points) if best.points or not article else 0.0
    top, above = best, best.parent
    while article and above is not None:
        top, above = above if above.tag in ("article", "main") else top, above.parent
    others = set()  # what holds an article like the best
    for one in articles if article else []:
        if one.points >= least and one.names == best.names and one.tag == best.tag:
            while one is not None and id(one) not in others:
                others.add(id(one))
                one = one.parent

    def title(one: Node) -> bool:
        heads = one.children if article and one.tag in ("header", "hgroup") else [one]
        named = any(not isinstance(c, str) and c.tag in ("h1", "h2") and c.length for c in heads)
        return named and density(one) < 0.25

    def belongs(one: Node | str) -> bool:
        if isinstance(one, str) or unwanted(one):
            return False
        like = one.points >= least and one.names == best.names and one.tag == best.tag
        reads = one.tag == "p" and one.length > 80 and density(one) < 0.25
        if article and one.tag == "p" and not one.links and not reads and one.length >= 25:
            lines: list[str] = []
            blocks(one, lines)
            reads = ENDS.search(" ".join(lines)) is not None
        return like or reads or title(one) or id(one) in others or (one.points >= least and one.tag in ("article", "section"))

    kept, here = [best], best
    while here.parent is not None:
        around = here.parent.children
        at = next(i for i, one in enumerate(around) if one is here)
        before, after = [one for one in around[:at] if belongs(one)], [one for one in around[at + 1 :] if belongs(one)]
        while article and after and title(after[-1]) and after[-1].tag in ("h1", "h2"):
            after.pop()
        kept = before + kept + after
        if here is top:
            break
        here = here.parent
    return kept


def main_text(page: str | None) -> str:
    """The main text of a page; empty if it has none."""
    if not page or not page.strip():
        return ""
    root = parse(page)
    nodes = order(root)
    measure(nodes)
    held = score(nodes)
    articles = [n for n in nodes if n.tag in ("article", "main") and n.length]
    if not held:
        best = max(articles, key=lambda n: n.length) if articles else root
    else:
        best = max(held, key=lambda n: n.points)
        # An article that holds the best container, or is held by it, is the container itself.
        around = best
        while around is not None and around.tag not in ("article", "main"):
            around = around.parent
        if around is not None:
            best = around
        elif inside := [n for n in articles if n.points > 0 and 2 * n.length >= best.length]:
            best = max(inside, key=lambda n: n.points)
    kept = beside(best, articles)
    out: list[str] = []
    for node in kept:
        blocks(node, out)
    return " ".join(out)


def extract(df: DataFrame, html_column: str = "html") -> DataFrame:
    """``df`` with ``text`` (the main text) and ``n_chars`` (its code points).

    A null or empty page, and one without text, gives an empty text. Broken markup is
    read as far as it goes. Columns of the new names are replaced, others kept; repeated
    rows give the same; an empty table stays empty. Pages are read whole, in their rows,
    without a shuffle; the tree is held flat on lists, so depth is no limit.
    """

    def start():
        def work(pages):
            for page in pages:
                text = main_text(page)
                yield text, len(text)

        return work

    return frames.extend(df, [frames.col(html_column)], start, {"text": "string", "n_chars": "bigint"})
