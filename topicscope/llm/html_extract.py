"""HTML extraction (7): consensus host paths.

Each page is read into text pieces, each inside a container (a sectioning
element).  Elements that are never article text (menus, page headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments; by tag,
role, class or id) are set aside; forms and parts named by role, class or id
only after the page is read, if they don't enclose the article (:func:`_settle`).
A page's containers are scored by the text left in them, and the page votes,
with the logarithm of that text's length, for the generalised tag-class path of
its best container: the outermost article or main element that holds most of
the text, else the outermost container named as the article, else the container
beyond which text would be left out.  Spark adds up the votes
per (host, path) and takes each host's winner, and every page is then read
again with its host's winning path: the text of the containers on that path, or
of the page's own best container where the page has no such path (or no text
there); a page's own article is kept beside the path.

Character references are decoded, white space inside a block becomes one
space, blocks are joined in page order by one space.

Votes are partial sums per task.  The winners are written first: up to
``BROADCAST_BYTES`` of them go to all tasks and no page is shuffled, more are
joined by host and one of ``SALTS`` parts of its pages, so that no host's pages
meet in one task.

Defined cases: a null html is empty and gives an empty text; a null url counts
as the host ''; a page without text votes for nothing; a page whose text is all
set aside is read again with it; equal votes go to the
first path in alphabetical order; repeated rows each get a row; other columns
are passed through, and the output column text replaces an input column of that
name.
"""

from __future__ import annotations

import html as htmllib
import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicscope.session import input_bytes

from .common import bounded_batches, sliced, staged, without

#: Winners (as written) that are broadcast, and the parts a host's pages are dealt into beyond that.
BROADCAST_BYTES = 16 << 20
SALTS = 32
#: Share of a page's text that its best container has to hold.
SHARE = 0.7

# one match per markup item, tried only where a "<" stands: tag, else comment, CDATA, declaration
_TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"""
    r"""|<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*+>""", re.S)
#: The same where no CDATA end lies ahead.
_PLAIN = re.compile(_TAG.pattern.replace(r"<!\[CDATA\[(.*?)\]\]>", r"(?!)()"), re.S)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_DIGITS = re.compile(r"\d+")
_TOKEN = re.compile(r"[A-Za-z]+[0-9]*|[0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")

# Element names by their part in a page
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover semantics".split())
SKIPPED = frozenset(
    "nav header footer aside script style noscript template iframe svg canvas button select option "
    "textarea input menu head title object embed audio video map xmp noembed noframes "
    "datalist annotation annotation-xml".split())
#: Of these, what is no text even on a page that has no other.
NO_TEXT = SKIPPED - frozenset("nav header footer aside noscript menu xmp noembed noframes".split())
#: Set aside unless they enclose the article.
WRAPPERS = frozenset("form fieldset dialog".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
CONTAINERS = frozenset("body main article section div td table center blockquote".split())
SKIPPED_ROLES = frozenset(
    "navigation banner complementary contentinfo search dialog alert alertdialog form menu menubar "
    "toolbar note status tablist".split())
#: Class and id tokens of parts that are no article text.
SKIPPED_TOKENS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot adunit sponsor sponsored "
    "promo promoted promotion banner sidebar sidebars aside rail menu menus nav navbar navigation topnav "
    "subnav breadcrumb breadcrumbs header masthead topbar footer bottom comment comments commentlist "
    "disqus replies reply responses discussion respond reviews cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login search social share sharing "
    "related recommended recommendations trending pagination pager toolbar widget widgets skip "
    "copyright legal disclaimer paywall form".split())
#: Of these, tokens that set an inline element aside amid the article's text.
ADVERT_TOKENS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot adunit sponsor sponsored promo "
    "promoted promotion".split())
#: Of these, tokens that an article or its wrapper may bear as well.
MILD_TOKENS = frozenset(
    "sponsored promoted promo promotion rail header masthead bottom discussion reviews notice notices alert "
    "modal overlay subscription login search social share sharing widget widgets skip copyright legal "
    "disclaimer paywall form".split())
#: Of these, tokens of what readers wrote.
REMARK_TOKENS = frozenset(
    "comment comments commentlist disqus replies reply responses discussion respond reviews".split())
#: Tokens that mark the article itself; they outweigh the tokens above on sectioning elements.
ARTICLE_TOKENS = frozenset("article post entry content story main body".split())
#: Tokens that name a container as the article, and those of a part of it.
NAMED_TOKENS = frozenset("article post entry story".split())
PART_TOKENS = frozenset("content body text main header title meta".split())
CLOSES_P = frozenset(
    "address article aside blockquote center div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
            "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
SCOPES = frozenset("ul ol dl table div section article aside nav main body header footer form "
                   "blockquote td".split())


@dataclass
class Page:
    """Pieces of kept text with their containers."""

    steps: list[str]         # per container: its step of the generalised path
    parents: list[int]       # per container: enclosing container
    semantic: list[bool]     # per container: an article or main element, or inside one
    marks: list[int]         # per container: 2 an article or main element, 1 named as an article
    asides: list[int]        # per container: 0, or the grade by which it is set aside
    pieces: list[tuple[int, str]]  # (container, text or "\n" at a block's edge)
    source: str = ""         # read again if no piece is left ('' if nothing was set aside)


def _names(attrs: dict[str, str]) -> list[set[str]]:
    """The tokens of each class and of the id."""
    return [{t.lower() for t in _TOKEN.findall(_CAMEL.sub(" ", n))}
            for n in [*attrs.get("class", "").split(), attrs.get("id", "")]]


def _hidden(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in SKIPPED:
        # a header inside the article holds its headline
        return not (tag == "header" and in_article)
    if not attrs:
        return False
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" \
        or "display:none" in attrs.get("style", "").replace(" ", "")


def _aside(tag: str, attrs: dict[str, str], in_text: bool) -> int:
    """0 for a part of the article, else how little the element may be one: 1 a
    form or a name that articles bear too, 2 another name or role, 3 remarks."""
    grade = 1 if tag in WRAPPERS else 0
    if not attrs or tag in ("main", "body", "html"):
        return grade
    if attrs.get("role") in SKIPPED_ROLES:
        grade = max(grade, 1 if attrs["role"] in ("form", "note", "status", "dialog") else 2)
    if not ("class" in attrs or "id" in attrs):
        return grade
    names = _names(attrs)
    if tag in INLINE and in_text:
        # of the parts inside a text only adverts are told by their names
        return 2 if any(n & ADVERT_TOKENS for n in names) else grade
    tokens = set().union(*names)
    bad = tokens & SKIPPED_TOKENS
    # "post-header" belongs to the article, "post-comments" or "content-ad" does not
    if not bad or tokens & ARTICLE_TOKENS and bad <= {"header", "body"}:
        return grade
    if tag in CONTAINERS and (tag == "article" or bad <= MILD_TOKENS):
        # a name of its own that marks the article outweighs the others
        if any(n & ARTICLE_TOKENS and all(t in ARTICLE_TOKENS or t.isdigit() for t in n) for n in names):
            return grade
        if tag == "article" and bad <= MILD_TOKENS:
            return grade
    return max(grade, 3 if bad & REMARK_TOKENS else 1 if bad <= MILD_TOKENS else 2)


def _mark(tag: str, attrs: dict[str, str]) -> int:
    if tag in ("article", "main"):
        return 2
    if not attrs or tag == "body" or not ("class" in attrs or "id" in attrs):
        return 0
    return int(any(n & NAMED_TOKENS and not n & (PART_TOKENS | SKIPPED_TOKENS) for n in _names(attrs)))


def _settle(page: Page) -> None:
    """Drop the pieces of what is set aside.

    A form or a part named as no article text stays if it encloses the article:
    inside an article, if it outweighs the rest of it (grade 1); elsewhere, if no
    article lies outside and it holds one or outweighs the page's other text
    (grade 1), or holds one article or main element that does (grades 2 and 3)."""
    n = len(page.steps)
    own = [0] * n
    for box, text in page.pieces:
        if text != "\n" and not text.isspace():
            own[box] += len(text)
    region, article = [0] * n, [0] * n  # nearest part set aside; outermost article in that region
    for b in range(1, n):
        up = page.parents[b]
        if page.asides[b]:
            region[b], article[b] = b, b if page.marks[b] else 0
        else:
            region[b], article[b] = region[up], article[up] or (b if page.marks[b] else 0)
    plain, marked, elements = [0] * n, [0] * n, [0] * n  # per region: text, text in articles, their number
    rest = [0] * n  # per article: its text outside further parts
    main = [0] * n  # per region: text in article and main elements
    for b in range(n):
        plain[region[b]] += own[b]
        if article[b]:
            marked[region[b]] += own[b]
            rest[article[b]] += own[b]
            if page.marks[article[b]] == 2:
                main[region[b]] += own[b]
                elements[region[b]] += article[b] == b
    # parts of remarks count for nothing outside themselves
    full = plain[:]
    for b in range(n - 1, 0, -1):
        if page.asides[b] in (1, 2):
            up = region[page.parents[b]]
            full[up] += full[b] if page.asides[b] == 1 else 0
            marked[up] += marked[b] if up else 0
            main[up] += main[b] if up else 0
            elements[up] += elements[b] if up else 0
    kept = [False] * n
    kept[0] = True
    text, articles = plain[0], marked[0]
    for b in range(1, n):
        up = region[page.parents[b]]
        if not page.asides[b] or not kept[up]:
            continue
        around, grade = article[page.parents[b]], page.asides[b]
        if around:
            stays = grade == 1 and full[b] > rest[around]
        elif articles:
            stays = False
        elif grade == 1:
            stays = marked[b] > 0 or full[b] > text
        else:
            stays = main[b] > text and (grade == 2 or elements[b] == 1)
        if stays:
            kept[b] = True
            text += plain[b]
            articles += sum(own[i] for i in range(b, n) if region[i] == b and article[i])
    page.pieces = [(b, t) for b, t in page.pieces if kept[region[b]]]


def _step(tag: str, attrs: dict[str, str]) -> str:
    """One element of a generalised path: tag and classes, digits as 0."""
    classes = sorted({_DIGITS.sub("0", c.lower()) for c in attrs.get("class", "").split()})
    return ".".join([tag, *classes]).replace(">", "")


def path_of(page: Page, box: int) -> str:
    """The generalised path of a container."""
    steps = [page.steps[box]]
    while box:
        box = page.parents[box]
        steps.append(page.steps[box])
    return ">".join(reversed(steps))


def on_path(page: Page, path: str) -> set[int]:
    """The containers whose path is ``path``, in one pass over the containers."""
    wanted = path.split(">")
    depth = [0] * len(page.steps)  # steps of the path that lead here, 0: none
    for box, step in enumerate(page.steps):
        before = depth[page.parents[box]] if box else 0
        if (before or not box) and before < len(wanted) and wanted[before] == step:
            depth[box] = before + 1
    return {box for box, d in enumerate(depth) if d == len(wanted)}


def _attrs(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(text):
        out.setdefault(name.lower(), htmllib.unescape(a or b or c))
    return out


def _close(stack: list, names, scopes) -> None:
    """Close the innermost open element of ``names``, not beyond a scope."""
    for i in range(len(stack) - 1, 0, -1):
        name = stack[i][0]
        if name in names:
            del stack[i:]
            return
        if name in scopes:
            return


def read_page(source: str, whole: bool = False) -> Page:
    """The page's text; ``whole``: also what is else set aside."""
    page = Page(["html"], [0], [False], [0], [0], [], "" if whole else source)
    _read(page, source, whole)
    if any(page.asides):
        _settle(page)
    return page


def _read(page: Page, source: str, whole: bool) -> None:
    pieces = page.pieces
    # open elements: (tag, container inside, skipped inside, inside an article, inside a paragraph or a container named as an article)
    stack: list[tuple[str, int, bool, bool, bool]] = [("html", 0, False, False, False)]
    find, match = source.find, _TAG.match
    at, mark = 0, find("<")
    # behind these nothing ends a tag or a CDATA section: no need to look to the page's end each time
    last_end, last_cdata = source.rfind(">"), source.rfind("]]>")
    while True:
        if mark < 0 or mark > last_end and not source.startswith("<!--", mark):
            m = None
        else:
            m = (match if mark + 9 <= last_cdata else _PLAIN.match)(source, mark)
        if m is None and mark >= 0:  # a "<" that opens nothing is text
            mark = find("<", mark + 1)
            continue
        stop = mark if mark >= 0 else len(source)
        if stop > at and not stack[-1][2]:
            text = source[at:stop]
            pieces.append((stack[-1][1], htmllib.unescape(text) if "&" in text else text))
        if m is None:
            return
        at = m.end()
        end, tag, inner, end2, tag2, inner2, cdata = m.groups()
        if tag is None:
            end, tag, inner = end2, tag2, inner2
        if tag is None:
            if cdata and not stack[-1][2]:
                pieces.append((stack[-1][1], cdata))
            mark = find("<", at)
            continue
        tag = tag.lower()
        if tag not in INLINE and not stack[-1][2]:
            pieces.append((stack[-1][1], "\n"))
        if tag in VOID:
            pass
        elif end:
            if stack[-1][0] == tag:
                if len(stack) > 1:
                    stack.pop()
            else:
                # an end tag of a sectioning element may cross whatever was left open
                _close(stack, (tag,), frozenset() if tag in SCOPES else SCOPES)
            if stack[-1][2] is False and tag not in INLINE:
                pieces.append((stack[-1][1], "\n"))
        else:
            if tag in CLOSES_P:
                _close(stack, ("p",), SCOPES)
            if tag in SIBLINGS:
                _close(stack, SIBLINGS[tag], SCOPES)
            _, box, skip, article, prose = stack[-1]
            if not skip or tag in RAW:
                attrs = _attrs(inner) if inner and not skip else {}
                skip = skip or (tag in NO_TEXT if whole else _hidden(tag, attrs, article or prose))
                if tag in RAW:
                    # text up to the end tag is no markup
                    over = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                    if not skip:
                        pieces.append((box, htmllib.unescape(source[at:over.start() if over else None])))
                    at = over.end() if over else len(source)
                    mark = find("<", at)
                    continue
                aside = 0 if skip or whole else _aside(tag, attrs, article or prose)
                article = article or tag in ("article", "main")
                named = _mark(tag, attrs) if tag in CONTAINERS else 0
                prose = prose or tag in PROSE or named > 0 and not aside
                if (tag in CONTAINERS or aside) and not skip:
                    page.steps.append(_step(tag, attrs) if attrs else tag)
                    page.parents.append(box)
                    page.semantic.append(article)
                    page.marks.append(named)
                    page.asides.append(aside)
                    box = len(page.steps) - 1
            stack.append((tag, box, skip, article, prose))
        mark = find("<", at)


def best_container(page: Page) -> tuple[int, int]:
    """The container of the article, and its text's length (article and main
    elements count threefold): the outermost article or main element that holds
    ``SHARE`` of the page's text, else the outermost container named as the
    article that does, else the deepest container that leaves no text out."""
    n = len(page.steps)
    total = [0] * n
    for box, text in page.pieces:
        if text != "\n" and not text.isspace():
            total[box] += len(text) * (3 if page.semantic[box] else 1)
    for box in range(n - 1, 0, -1):  # children come after their parents
        total[page.parents[box]] += total[box]
    for mark in (2, 1):
        for box in range(1, n):
            if page.marks[box] == mark and total[box] >= SHARE * total[0] > 0:
                return box, total[box]
    best = 0
    for box in range(1, n):
        if page.parents[box] == best and total[box] == total[best] > 0:
            best = box
    return best, total[best]


def text_of(page: Page, path: str | None) -> str:
    """Text of the containers on ``path``; without any, of the best container;
    of a page that has none left, all that was set aside."""
    inside = [False] * len(page.steps)
    best = best_container(page)[0]
    for use_path in (True, False):
        if use_path:
            roots = on_path(page, path) if path is not None else set()
            if not roots:
                continue
            if page.marks[best]:  # the path may lie elsewhere on this page
                roots.add(best)
        else:
            roots = {best}
        for i in range(len(inside)):
            inside[i] = i in roots or (i > 0 and inside[page.parents[i]])
        text = " ".join("".join(t for box, t in page.pieces if inside[box] or t == "\n").split())
        if text:
            return text
    return text_of(read_page(page.source, whole=True), None) if page.source else ""


def host_of(url: Column) -> Column:
    """Lower-case host of a url, without user and port; '' if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][^:/?#]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1),
                              F.lit("")))


def votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path, votes, pages: the sum of the pages' votes."""
    def run(batches):
        for batch in sliced(batches):
            paths, weights = [], []
            for v in batch.column(1):
                page = read_page(v.as_py() or "")
                box, length = best_container(page)
                paths.append(path_of(page, box) if length else None)
                # whole thousandths: sums don't depend on their order
                weights.append(round(1000 * math.log1p(length)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(paths, pa.string()), pa.array(weights, pa.int64())],
                names=["host", "path", "w"])

    one = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html")) \
        .mapInArrow(run, "host string, path string, w long")
    return one.where(F.col("path").isNotNull()).groupBy("host", "path").agg(
        F.sum("w").alias("votes"), F.count(F.lit(1)).alias("pages"))


def winners(voted: DataFrame) -> DataFrame:
    """host, path: the path of most votes (the first in order among equals)."""
    best = F.min(F.struct((-F.col("votes")).alias("v"), F.col("path").alias("path")))
    return voted.groupBy("host").agg(best.alias("b")).select("host", F.col("b.path").alias("path"))


def extract(pages: DataFrame, paths: DataFrame, url_col: str = "url", html_col: str = "html",
            keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``pages`` (all by default) with ``text``."""
    pages = without(bounded_batches(pages), ["text", "_host", "_path", "_salt"], html_col, url_col)
    keep = [c for c in (pages.columns if keep is None else keep) if c != "text"]
    n = len(pages.columns)
    at, columns = pages.columns.index(html_col), [pages.columns.index(c) for c in keep]
    hosts = pages.withColumn("_host", host_of(F.col(url_col)))
    won = staged(paths.select(F.col("host").alias("_host"), F.col("path").alias("_path")), "winners")
    if input_bytes(pages.sparkSession, won.inputFiles()) <= BROADCAST_BYTES:
        joined = hosts.join(F.broadcast(won), "_host", "left")
    else:
        salt = F.pmod(F.xxhash64(F.col(html_col).cast("string")), F.lit(SALTS)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
        joined = hosts.withColumn("_salt", salt).join(won.select("_host", "_path", every), ["_host", "_salt"], "left")
    joined = joined.select(*pages.columns, "_path")

    def run(batches):
        for batch in sliced(batches):
            texts = [text_of(read_page(v.as_py() or ""), p.as_py())
                     for v, p in zip(batch.column(at), batch.column(n), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in columns] + [pa.array(texts, pa.string())],
                names=[batch.schema.names[i] for i in columns] + ["text"])

    return joined.mapInArrow(run, T.StructType([pages.schema[c] for c in keep]
                                               + [T.StructField("text", T.StringType())]))
