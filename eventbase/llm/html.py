"""Main text of web pages, by a site style tree.

The pages of a host are merged into one tree: a style node is a chain of tags and classes, and holds on how
many pages each of its looks occurs, that is each sequence of child tags (presentation) and each text (content). A look
counts once per page, and pages with the same text count as one, so neither a table of few values nor copies of an
article look like a template. The entropy of the looks, over the logarithm of their number, is the node's importance: 0
if all pages agree there, 1 if all differ. A branch whose nodes are all of low importance is a template, and its texts that
at least eight pages have are removed from each page.

Two features of a branch speak beside its entropy. Names (class, id, role): a name made of words for menus, adverts,
comments and the like alone ("ad", "reader-feedback", "cookie-notice"), such a tag, or a hidden element has no importance at all,
as sites fill adverts at random; a name that holds such a word among others ("related-work", "ad-hoc") lowers the importance, so
that the tree decides, or goes if most of it is links. Links: a block that is mostly links is a node of its own beside
the prose around it.

If a page marks its article, text outside it is left out; a ``main`` is preferred to articles beside it. Inside
the mark the tree's verdict holds for blocks with one of the two features only: paragraphs of prose stay, however often they repeat.

The tree is built by grouping: copies by host and text, then counts, partly summed before any shuffle, so a host with a
third of all pages is no hot spot; only the hashes of repeated template texts are joined back to the pages of their host.

Rules for odd input: null or empty html gives an empty text; a null url is a host of its own; unclosed and stray tags
are taken as browsers mostly do; pages that repeat an id are each extracted.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventbase.llm.common import arrow_rows, settle

LOW_IMPORTANCE = 0.2
LEAST_PAGES = 8  # of a node, and of a text, below which it is no template
NAME_WEIGHT = 0.4  # times the importance of a branch with a doubtful name
DOUBTFUL, LINKED = "\x01", "\x02"  # marks in the path of a node

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S
)
NAMES = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?(?=[\s/]|$)""", re.I)
# Fixed: element kinds of HTML.
UNREAD = set("script style noscript template textarea title svg iframe object select button canvas audio video".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
BARRIER = set("article aside body blockquote dd div dl fieldset figure footer form header html li main nav ol section table td th ul".split())
NOISE_TAGS = set("nav footer aside form menu dialog search head".split())
NOISE_NAMES = set(
    "ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu menubar"
    " breadcrumb breadcrumbs topbar masthead footer sidebar aside complementary contentinfo widget cookie cookies consent gdpr notice notices"
    " notification alert popup modal overlay newsletter subscribe subscription share sharing social comment comments disqus respond replies reply"
    " related recommended recommendations pagination pager login signin signup search form toolbar skip dialog disclaimer feedback buy shop".split()
)
# Words that say nothing against a name made of noise words.
PLAIN_NAMES = set(
    "area bar block body bottom box btn button buttons card column container content global group holder inner item items js left link links"
    " list main message now outer page pages panel post posts primary reader readers right row secondary site slot small text thread title top"
    " unit user users visitor wrap wrapper zone".split()
)
LAYOUT_NAMES = {"has", "with", "no", "without", "is", "layout"}
HEADER_NAMES = {"header", "head", "top"}


class Element:
    __slots__ = ("tag", "path", "noise", "inside", "link", "children")

    def __init__(self, tag: str, path: str, noise: bool, inside: int, link: bool) -> None:
        self.tag, self.path, self.noise, self.inside, self.link, self.children = tag, path, noise, inside, link, []


def _says(attributes: str) -> tuple[str, bool, set[str]]:
    """Classes for the path, whether it is hidden, and what class, id and role say: noise, doubt, header, main."""
    classes, hidden, says = "", False, set()
    for name, value in NAMES.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "class":
            classes = "." + ".".join(sorted(value.split()))
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style":
            hidden = hidden or "display:none" in value.replace(" ", "")
        else:
            for token in value.split():
                parts = [x for x in re.split(r"[-_]+", token) if x and not x.isdigit()]
                if not parts or parts[0] in LAYOUT_NAMES:  # "has-sidebar" speaks of the page around it
                    continue
                others = set(parts) - NOISE_NAMES - PLAIN_NAMES
                if token in NOISE_NAMES or len(others) < len(set(parts) - PLAIN_NAMES) and not others - HEADER_NAMES:
                    says.add("noise")
                elif {parts[0], parts[-1]} & NOISE_NAMES:
                    says.add("doubt")
                elif {parts[0], parts[-1]} & HEADER_NAMES:
                    says.add("doubt" if others - HEADER_NAMES else "header")
                if "main" in (parts[0], parts[-1]):
                    says.add("main")
    return classes, hidden, says


def parse(page: str | None) -> tuple[list[tuple[str, str, int]], set]:
    """Blocks (path, text, 1 inside an article or 2 inside a main) that are not noise by name, and the looks (path, hash)."""
    page = page or ""
    stack = [Element("", "", False, 0, False)]
    blocks: list[tuple[str, str, int]] = []
    looks: set[tuple[str, int]] = set()
    words: list[str] = []
    sizes = [0, 0]  # characters outside and inside links
    seen_article = False
    at = 0

    def flush() -> None:
        if words:
            text = " ".join(entities.unescape("".join(words)).split())
            linked = sizes[1] > sizes[0]
            words.clear()
            sizes[:] = 0, 0
            top = next(e for e in reversed(stack) if e.tag in BLOCK or not e.tag)
            if text and not stack[-1].noise:
                path = f"{top.path}/{LINKED}" if linked else top.path
                blocks.append((path, text, top.inside))
                looks.add((path, look_of(path, text)))

    def take(text: str) -> None:
        if not stack[-1].noise:
            words.append(text)
            sizes[stack[-1].link] += len(text.strip())

    def close(n: int) -> None:
        while len(stack) > n:
            gone = stack.pop()
            if gone.children and not gone.noise:
                looks.add((gone.path, look_of(gone.path, "<" + " ".join(gone.children))))

    while found := TAG.search(page, at):
        if found.start() > at:
            take(page[at : found.start()])
        at = found.end()
        ending, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if ending:
            n = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if n:
                if tag in BLOCK or any(e.tag in BLOCK for e in stack[n:]):
                    flush()
                close(n)
            continue
        if tag in UNREAD:
            if not attributes.rstrip().endswith("/") or tag in ("script", "style", "title", "textarea"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            if not stack[-1].noise:
                words.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            if not stack[-1].noise:
                words.append(" " if tag in ("br", "hr", "img") else "")
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSED_BY:
                same = {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in same:
                        close(i)
                        break
                    if stack[i].tag in CLOSED_BY[tag]:
                        break
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in BARRIER:
                    break
        up = stack[-1]
        classes, hidden, says = _says(attributes) if attributes else ("", False, set())
        inside, noise = up.inside, up.noise
        named = "noise" in says
        if tag in ("article", "main") or "main" in says and tag in BLOCK:
            if not named and not seen_article:
                noise, inside, seen_article = False, inside or 1, True
            if not named and not noise:
                inside = 1 if tag == "article" and inside < 2 else 2
        bad = hidden or tag in NOISE_TAGS or named
        if not inside:
            bad = bad or tag == "header" or "header" in says
        if tag in ("html", "body") or (tag in ("article", "main") and not named and not hidden):
            bad = False
        path = up.path
        if tag in BLOCK:
            up.children.append(tag)
            path += f"/{tag}{classes}{DOUBTFUL if 'doubt' in says and tag not in ('html', 'body') else ''}"
        stack.append(Element(tag, path, noise or bad, inside, up.link or tag == "a"))
    if at < len(page):
        take(page[at:])
    flush()
    close(1)
    return blocks, looks


def look_of(path: str, what: str) -> int:
    return xxhash.xxh64_intdigest(f"{path}\n{what}") - (1 << 63)


def article(blocks: list[tuple[str, str, int]]) -> list[tuple[str, str, int]]:
    """The blocks inside the marked article, or all if there is none."""
    return [b for b in blocks if b[2] == 2] or [b for b in blocks if b[2]] or blocks


def main_text(page: str | None, dull: set[int]) -> str:
    kept = []
    for path, text, inside in article(parse(page)[0]):
        doubtful, linked = DOUBTFUL in path, path.endswith(LINKED)
        template = look_of(path, text) in dull if dull and (doubtful or linked or not inside) else False
        if not (template or doubtful and linked):
            kept.append(text)
    return "\n".join(kept)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))


def template_looks(pages: DataFrame) -> DataFrame:
    """Rows (host, dull): the hashes of texts that repeat in branches of low importance. ``pages`` has host and html."""

    def rows(columns: list[list]) -> Iterator[tuple]:
        for host, page in zip(*columns):
            blocks, looks = parse(page)
            whole = look_of("", "\n".join(text for _, text, _ in article(blocks)))
            yield host, whole, sorted(looks) + [(path, None) for path in sorted({path for path, _ in looks})]

    each = arrow_rows(pages.select("host", "html"), rows, "host string, whole long, looks array<struct<path: string, look: long>>")
    each = each.groupBy("host", "whole").agg(F.min("looks").alias("looks")).select("host", F.inline("looks"))
    looks = settle(each.groupBy("host", "path", "look").agg(F.count("*").alias("n")))  # without a look: the pages of the path
    m, nlogn = F.sum(F.when(F.col("look").isNotNull(), F.col("n"))), F.sum(F.when(F.col("look").isNotNull(), F.col("n") * F.log("n")))
    pages_of = F.max(F.when(F.col("look").isNull(), F.col("n")))
    nodes = looks.groupBy("host", "path").agg(m.alias("m"), nlogn.alias("nlogn"), pages_of.alias("pages"))
    importance = F.when(F.col("m") > 1, 1 - F.col("nlogn") / (F.col("m") * F.log("m"))).otherwise(1.0)
    importance = importance * F.when(F.col("path").contains(DOUBTFUL), NAME_WEIGHT).otherwise(1.0)
    nodes = nodes.withColumn("importance", F.when(F.col("pages") < LEAST_PAGES, 1.0).otherwise(importance))
    # a branch is as important as its most important node
    steps = F.split("path", "/")
    upward = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    branches = nodes.select("host", "importance", F.explode(upward).alias("path"))
    branches = branches.groupBy("host", "path").agg(F.max("importance").alias("importance"))
    low = branches.filter(F.col("importance") < LOW_IMPORTANCE).select("host", "path")
    dull = looks.filter((F.col("n") >= LEAST_PAGES) & F.col("look").isNotNull()).join(low, ["host", "path"], "left_semi")
    return dull.groupBy("host").agg(F.collect_list("look").alias("dull"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per page."""
    pages = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(F.col(url)).alias("host"))
    with_dull = pages.join(settle(template_looks(pages)), "host", "left").select("page_id", "url", "html", "dull")
    kinds = {f.name: f for f in with_dull.schema}
    schema = T.StructType([kinds["page_id"], kinds["url"], *T._parse_datatype_string("text string, n_chars long")])

    def rows(columns: list[list]) -> Iterator[tuple]:
        for key, address, page, dull in zip(*columns):
            text = main_text(page, set(dull or ()))
            yield key, address, text, len(text)

    return arrow_rows(with_dull, rows, schema)
