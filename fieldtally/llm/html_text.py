"""Main text of web pages by composite text density.

Each element of a page has C characters, T tags, LC characters in links and LT link tags in it. Its density is

    C / T * log[C / LC * T / LT],  to the base  ln(C / (C - LC) * LC + LC of the body / C of the body * C + e),

zeros counted as one: characters for each tag, less where links hold much of the text. The density sum of an element adds up the
densities of its children; text that stands in it directly counts as one child. Formatting tags are no elements (see ``dom``).

First goes what by its name is not the article: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments, told by tag (``OUT``), role (``OUT_ROLES``) or a word of a class or identifier (``OUT_WORDS``). An element around the whole
article or main part stays, unless its name is one of comments or teasers, and so does a header with a heading inside an article. Of the rest, the element with
the largest density sum is chosen. If it lies in an ``article`` element, the text is that of the whole article. Otherwise the
threshold is the least density on the path from the body (or the ``main`` element) down to it; every element that a chain of elements
at the threshold or above joins to the body adds the subtree with the largest density sum in it, and a first-level heading before them,
beside their path, is added if they have none.

A page is read by one row's helper in linear time; pages are dealt out by Spark, without a shuffle, and a task holds one slice of pages.

Defined results: character references are decoded; runs of white space, as Unicode has it, and ``br`` are one space inside a block; blocks
are trimmed, and empty ones left out. A null or empty page, and a page without text, give an empty text. Equal sums go to the first
element in page order. Null and repeated identifiers and addresses stay as they are. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dom import HEADINGS, Tree, read
from .words import slices

# Names that are never article text.
OUT = frozenset(
    "nav aside footer header form dialog menu search fieldset option select button label input datalist noscript template object svg canvas "
    "audio video map applet frameset".split()
)
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert alerts newsletter subscribe subscription signup login popup modal overlay sidebar comment comments disqus respond replies share sharing "
    "social related recommended recommendations breadcrumb breadcrumbs pagination pager menu menus nav navbar navigation footer header masthead "
    "toolbar widget widgets copyright".split()
)
# Words beside those that tell only of place or shape: ``ad-box`` goes, ``related-work`` stays.
PLAIN_WORDS = frozenset(
    "area article bar block body bottom box btn buttons card center col column container content css div entry feed form global group holder inner "
    "item items js left line link links list main media message middle news outer page panel place post posts primary reader readers right row "
    "rail secondary section side site slot space stories story sub text thread top unit user users wrap wrapper zone".split()
)
# Go with articles inside: comments and teasers often are article elements themselves.
OTHER_ARTICLES = frozenset("comment comments disqus respond replies related recommended recommendations".split())
NAMED = frozenset("address article center dd details dialog dir div dl dt figure li ol p pre section span summary table tbody td tr ul".split())
LAYOUT = re.compile(r"(^|[-_])(has|with|no|without|is|hide|show)[-_]", re.IGNORECASE)  # tells of something elsewhere
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HOLDS_OTHERS = ("nav", "form", "header", "menu", "search", "fieldset", "label", "object")  # stay if an article is inside, closed or not


def told(marks: dict[str, str]) -> set[str]:
    """The ``OUT_WORDS`` among the names of classes and identifier that hold no other telling word."""
    found = set()
    for name in (n for k in ("class", "id") for n in marks.get(k, "").split() if not LAYOUT.search(n)):
        words = {w.lower() for w in WORD.findall(name)}
        if (whole := "".join(WORD.findall(name)).lower()) in OUT_WORDS:
            found.add(whole)
        elif words <= OUT_WORDS | PLAIN_WORDS:
            found |= words & OUT_WORDS
    return found


def is_node(name: str, attributes: str) -> bool:
    """Of the names that are not blocks, links are elements, and whatever may have to go."""
    return name == "a" or name in OUT or bool(attributes) and ("class" in (low := attributes.lower()) or "id" in low or "role" in low)


def within(tree: Tree, kinds: tuple[str, ...]) -> list[bool]:
    """Which elements are one of these kinds or inside one."""
    found = [False] * len(tree.names)
    for i in range(1, len(found)):
        found[i] = found[tree.parents[i]] or tree.names[i] in kinds
    return found


def kept(tree: Tree) -> list[bool]:
    """Which elements stay."""
    n = len(tree.names)
    article = within(tree, ("article", "main"))
    around, headed = [False] * n, [False] * n  # has an outermost article or main element, has a heading inside
    for i in range(n - 1, 0, -1):
        up = tree.parents[i]
        around[up] |= around[i] or article[i] and not article[up]
        headed[up] |= headed[i] or tree.names[i] in HEADINGS
    stays = [True] * n
    for i in range(1, n):
        name, up, words = tree.names[i], tree.parents[i], told(tree.marks[i]) if tree.marks[i] and tree.names[i] in NAMED else set()
        if name in OUT:
            out = not (around[i] and name in HOLDS_OTHERS) and not (name == "header" and article[i] and headed[i])
        elif words & OTHER_ARTICLES:
            out = True
        elif words == {"header"}:
            out = not around[i] and not (article[i] and headed[i])
        else:
            out = (bool(words) or tree.marks[i].get("role", "").lower() in OUT_ROLES) and not around[i]
        stays[i] = stays[up] and not out
    return stays


def densities(tree: Tree, stays: list[bool]) -> tuple[list[float], list[float], list[int]]:
    """Density, density sum and characters of each element that stays."""
    n = len(tree.names)
    chars, tags, link_chars, link_tags, own = ([0] * n for _ in range(5))
    for element, _, text in tree.pieces:
        if stays[element]:
            own[element] += len(" ".join(text.split()))
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[tree.parents[i]] or tree.names[i] == "a"
    for i in range(n - 1, -1, -1):
        if stays[i]:
            chars[i] += own[i]
            link_chars[i] += own[i] if linked[i] else 0
            if i:
                up = tree.parents[i]
                chars[up] += chars[i]
                link_chars[up] += link_chars[i]
                tags[up] += tags[i] + 1
                link_tags[up] += link_tags[i] + (tree.names[i] == "a")
    share = link_chars[0] / max(1, chars[0])

    def density(c: int, t: int, lc: int, lt: int) -> float:
        if not c:
            return 0.0
        base = log(c / max(1, c - lc) * max(1, lc) + share * c + e)
        return c / max(1, t) * log(c / max(1, lc) * max(1, t) / max(1, lt)) / log(base)

    each = [density(*x) for x in zip(chars, tags, link_chars, link_tags, strict=True)]
    sums = [0.0 if linked[i] else density(own[i], 1, 0, 0) for i in range(n)]
    for i in range(1, n):
        if stays[i]:
            sums[tree.parents[i]] += each[i]
    return each, sums, chars


def outermost(tree: Tree, stays: list[bool], kind: str, chars: list[int]) -> list[int]:
    """Elements of the kind that stay, hold text and are in no other."""
    inner = within(tree, (kind,))
    return [i for i in range(1, len(inner)) if tree.names[i] == kind and stays[i] and chars[i] and not inner[tree.parents[i]]]


def best_inside(tree: Tree, stays: list[bool], sums: list[float]) -> list[int]:
    """For each element, the one of the largest sum in its subtree; the first of equal ones."""
    best = list(range(len(sums)))
    for i in range(len(sums) - 1, 0, -1):
        up = tree.parents[i]
        if stays[i] and (sums[best[i]], -best[i]) > (sums[best[up]], -best[up]):
            best[up] = best[i]
    return best


def covered(tree: Tree, roots: set[int]) -> list[bool]:
    """Which elements are one of the roots or inside one."""
    found = [False] * len(tree.names)
    for i in range(len(found)):
        found[i] = i in roots or i > 0 and found[tree.parents[i]]
    return found


def chosen(tree: Tree, stays: list[bool]) -> list[bool]:
    """The elements whose text is the page's text."""
    each, sums, chars = densities(tree, stays)
    best = best_inside(tree, stays, sums)
    if articles := outermost(tree, stays, "article", chars):
        return covered(tree, {max(articles, key=lambda i: (sums[best[i]], -i))})
    top = max(outermost(tree, stays, "main", chars), key=lambda i: (sums[best[i]], -i), default=0)
    path = [best[top]]
    while path[-1] != top:
        path.append(tree.parents[path[-1]])
    threshold = min(each[i] for i in path)
    reached, roots = {top}, {best[top]}
    for i in range(top + 1, tree.last[top] + 1):
        if stays[i] and tree.parents[i] in reached and each[i] >= threshold:
            reached.add(i)
            roots.add(best[i])
    found = covered(tree, roots)
    titles = [i for i in range(top, tree.last[top] + 1) if tree.names[i] == "h1" and stays[i]]
    if not any(found[i] for i in titles):
        on_path = set(path)
        beside = [i for i in titles if i < path[0] and tree.parents[i] in on_path]
        found = covered(tree, roots | set(beside[-1:]))
    return found


def text_of(page: str) -> str:
    """The main text of one page."""
    if not page:
        return ""
    tree = read(page, is_node)
    stays = kept(tree)
    found = chosen(tree, stays)
    blocks: list[tuple[int, list[str]]] = []
    for element, block, text in tree.pieces:
        if stays[element] and found[element]:
            if not blocks or blocks[-1][0] != block:
                blocks.append((block, []))
            blocks[-1][1].append(text)
    joined = (" ".join("".join(b).split()) for _, b in blocks)
    return "\n\n".join(b for b in joined if b)


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    schema = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string"

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = pa.array([text_of(h.as_py()) for h in part.column("html")], type=pa.string())
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), texts], names=["page_id", "url", "text"])

    return rows.mapInArrow(extracted, schema).withColumn("n_chars", F.length("text").cast("long"))
