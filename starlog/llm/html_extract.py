"""Main text of web pages by deducing each host's template from equivalence classes of tokens.

A page's tokens are its elements, told apart by their path of tags, classes and ids. The occurrence vector
of a token says how often it occurs on each page of the host; it is kept as sums of hashes of (page,
count), so it needs no list of pages and is added up before the shuffle. Tokens that share a vector are an
equivalence class; a class is valid if it occurs on at least a fifth (`support`) of the host's pages, and classes
nest as the paths of their tokens do. The valid classes whose tokens mostly stand once on a page are the frames of the
host's templates. Their slots are the places where text stands; a slot that stands wherever its parent does and says
the same on all of its pages is part of the template, the others hold data. Pages of one content count once for
that, and fewer than three contents tell nothing. The articles are the frames' `article` elements and then their
`main` elements, those with most data first; a page is extracted by the first that stands on it, but for elements
whose tag, role, class or id names them as menu, advert, reader comments, form or the like. Words such as "share" or "related"
in a class or id tell so outside an article only; within one, the element must also recur on the host's pages
and consist of links or say the same on all of them.

A page without any of them falls back to its own `article` and `main` or else its body. On a host whose frames have
neither, all text is taken but for the template's slots, slots that consist of links, elements of one class that stand
twice and more on a page if half of the data or more stands elsewhere (teasers, reader comments), and what stands outside the smallest
element around all data
on a fifth of the pages or more (a page's own `article` or `main` is taken there if it is the only one).

Edge cases: a NULL or empty html has no tokens and an empty text; NULL urls are one host; unclosed tags
are closed by what follows; markup cut off at the end is dropped; repeated rows are pages of their
own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlog.llm.common import map_arrow, text_batches
from starlog.operators.joins import join_null_safe
from starlog.session import materialise

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|iframe|noscript|noembed|xmp)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/<>]*)(?P<rest>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-z][^<]*\Z"
    r"|<[a-z/][^<>]*>",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
DIGITS = re.compile(r"\d+")

# Fixed values of HTML: which elements have no content, which stand in a line, which end which.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
CONTAINERS = frozenset("ul ol dl table tbody select article main section div body html nav aside header footer form".split())

#: Elements whose text is never the article's.
NOISE_TAGS = frozenset(
    "head title nav footer aside form button select option textarea template svg math canvas menu dialog object audio "
    "video".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Words of classes and ids that name what is not the article (fixed values): wherever they stand, and outside articles.
NOISE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|newsletter|sidebar|comments?|disqus|replies|respond)(?=$|[\s_-])", re.IGNORECASE
)
DOUBTFUL_WORDS = re.compile(
    r"(?:^|[\s_-])(?:promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay"
    r"|subscri\w*|signup|login|widgets?|nav\w*|menus?|breadcrumbs?|footer|masthead|topbar"
    r"|share|sharing|social|related|recommended|pagination|pager|search)(?=$|[\s_-])",
    re.IGNORECASE,
)
ARTICLE_TAGS = ("article", "main")
HEADING = re.compile("h[1-6]")
REPEATING = re.compile("(?:div|section|li|dl|dd|table|tr|blockquote|figure)[.#]")  # as signs: with a class or id
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Element:
    """An open element: its token, and what its ancestors and itself say about the text in it."""

    __slots__ = ("name", "token", "parent", "sign", "noise", "doubt", "link", "article")

    def __init__(self, name: str, above: Element | None, sign: str, noise: bool, doubt: bool):
        import xxhash

        self.name, self.sign = name, sign
        self.parent = above.token if above else 0
        self.token = xxhash.xxh64_intdigest(f"{self.parent}/{sign}") - (1 << 63)
        self.noise = noise or (above.noise if above else False)
        self.doubt = doubt or (above.doubt if above else False)
        self.link = name == "a" or (above.link if above else False)
        self.article = name in ARTICLE_TAGS or (above.article if above else False)


def _element(name: str, rest: str, above: Element | None) -> Element:
    inside = above is not None and above.article
    sign, noise, doubt = name, name in NOISE_TAGS or (name == "header" and not inside), False
    for key, value in ATTRIBUTE.findall(rest) if rest else ():
        key, value = key.lower(), value.strip("\"' ").lower()
        if key in ("class", "id") and value:
            sign += ("." if key == "class" else "#") + DIGITS.sub("0", " ".join(sorted(value.split())))
            if name not in ("html", "body", *ARTICLE_TAGS):
                noise = noise or bool(NOISE_WORDS.search(value))
                doubt = doubt or bool(DOUBTFUL_WORDS.search(value))
        elif key == "role":
            noise = noise or value in NOISE_ROLES
        elif key == "hidden" or key == "style" and HIDDEN.search(value):
            noise = True
    return Element(name, above, sign, noise or (doubt and not inside), doubt and inside)


def read(page: str) -> Iterator[tuple[str, Element | None, str]]:
    """The page as ("open", element, ""), ("text", element, decoded text) and ("break", None, "")."""
    stack: list[Element] = []
    at = 0
    for found in MARKUP.finditer(page):
        if found.start() > at:
            text = page[at : found.start()]
            yield "text", stack[-1] if stack else None, html.unescape(text) if "&" in text else text
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        name = name.lower()
        if name not in INLINE:
            yield "break", None, ""
        if found["end"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
            continue
        if name not in INLINE:  # a block ends an open paragraph, and some blocks end their like
            ended = ("p", *ENDS.get(name, ()))
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name in ended:
                    del stack[depth:]
                elif stack[depth].name in CONTAINERS:
                    break
        if name not in VOID:
            stack.append(_element(name, found["rest"], stack[-1] if stack else None))
            yield "open", stack[-1], ""
    if at < len(page):
        text = page[at:]
        yield "text", stack[-1] if stack else None, html.unescape(text) if "&" in text else text


TOKENS = "host string, page long, token long, parent long, sign string, noise boolean, doubt boolean, n long, place long, chars long, linked long, said long, content long"


def host_of(url: str | Column) -> Column:
    """The lower-cased host of a URL, empty if there is none."""
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def tokens_of(page: str) -> list[tuple]:
    """(token, parent, sign, noise, doubt, count, place, chars, linked chars, hash of its own text, hash of the page's content).

    The content is the text outside noise, in the page's own `article` or `main` if any stands there.
    """
    import xxhash

    found: dict[int, list] = {}
    texts: dict[int, list[str]] = {}
    own: list[str] = []
    rest: list[str] = []
    for kind, element, text in read(page):
        if kind == "open":
            row = found.get(element.token)
            if row is None:
                found[element.token] = [
                    element.token, element.parent, element.sign, element.noise, element.doubt, 1, len(found), 0, 0
                ]
            else:
                row[5] += 1
        elif kind == "text" and element is not None and (bare := " ".join(text.split())):
            row = found[element.token]
            row[7] += len(bare)
            row[8] += len(bare) if element.link else 0
            texts.setdefault(element.token, []).append(bare)
            if not element.noise:
                (own if element.article else rest).append(bare)
    hashes = {token: xxhash.xxh64_intdigest("\n".join(parts)) - (1 << 63) for token, parts in texts.items()}
    content = xxhash.xxh64_intdigest("\n".join(own or rest)) - (1 << 63)
    return [(*row, hashes.get(row[0]), content) for row in found.values()]


def page_tokens(pages: DataFrame) -> DataFrame:
    """TOKENS of all pages (host, page, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("host", pa.string()), ("page", pa.int64()), ("token", pa.int64()), ("parent", pa.int64())]
            + [("sign", pa.string()), ("noise", pa.bool_()), ("doubt", pa.bool_())]
            + [(name, pa.int64()) for name in ("n", "place", "chars", "linked", "said", "content")]
        )
        for batch in batches:
            hosts, keys = batch.column("host").to_pylist(), batch.column("page").to_pylist()
            for at, texts in text_batches(batch, "html"):
                rows = [(hosts[at + i], keys[at + i], *row) for i, text in enumerate(texts) for row in tokens_of(text)]
                columns = zip(*rows) if rows else [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return map_arrow(pages.select("host", "page", "html"), run, TOKENS)


def _contents(skip: int) -> Column:
    """At most the number of different contents: the bits that six of their hash's bits set in a word."""
    six = F.shiftrightunsigned("content", skip).bitwiseAND(F.lit(63)).cast("int")
    return F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), six)))


def host_tokens(pages: DataFrame, support: float) -> DataFrame:
    """The tokens of each host on at least `support` of its pages, with their occurrence vectors.

    That leaves a host at most (mean tokens of a page) / support tokens.
    """
    mark = F.xxhash64("page", "n")
    vectors = page_tokens(pages).groupBy("host", "token").agg(
        F.min("parent").alias("parent"),
        F.min("sign").alias("sign"),
        F.max("noise").alias("noise"),
        F.max("doubt").alias("doubt"),
        F.count("*").alias("pages"),
        F.sum("n").alias("n"),
        F.sum((F.col("n") == 1).cast("long")).alias("once"),
        F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftrightunsigned(mark, 32)).alias("high"),
        F.avg("place").alias("place"),
        F.sum("chars").alias("chars"),
        F.sum("linked").alias("linked"),
        F.count("said").alias("speaking"),
        (F.min("said") != F.max("said")).alias("varies"),
        _contents(0).alias("contents"),
        _contents(6).alias("contents_too"),
    )
    totals = pages.groupBy("host").agg(F.count("*").alias("all_pages"))
    joined = join_null_safe(vectors, totals, ["host"], "inner")
    return joined.where(F.col("pages") >= support * F.col("all_pages"))


def classes(tokens: pd.DataFrame) -> pd.Series:
    """The equivalence class of each token: those with one occurrence vector."""
    return tokens.groupby(["pages", "n", "low", "high"], sort=False).ngroup()


def deduce(tokens: pd.DataFrame, few: int = 3) -> dict[str, list[int]]:
    """The templates of one host from its tokens: its articles' elements, best first, and the tokens of template text.

    Fewer than `few` contents say nothing about what varies.
    """
    tokens = tokens.sort_values("place")
    rows = {row.token: row for row in tokens.assign(family=classes(tokens)).itertuples(index=False)}
    parent = {token: row.parent for token, row in rows.items()}
    name = {token: re.split("[.#]", row.sign, maxsplit=1)[0] for token, row in rows.items()}

    def block(token: int) -> int:
        """Its slot: an element in a line is a part of its block's."""
        while name[token] in INLINE and parent[token] in rows:
            token = parent[token]
        return token

    def still(row) -> bool:
        # a path's pages are among its parent's, so as many pages are the same ones
        always = row.parent in rows and rows[row.parent].pages == row.pages
        told = max(row.contents, row.contents_too) >= few
        return bool(always and told and row.speaking == row.pages and row.varies == False)  # noqa: E712

    # the frames: what mostly stands once on its pages, which holds for a whole class
    frame = {token for token, row in rows.items() if 2 * row.once >= row.pages}
    loose = {block(token) for token, row in rows.items() if row.chars and not still(row)}
    constant = {token for token in frame - loose if still(rows[token]) and name[token] not in INLINE}
    fixed = {
        token
        for token, row in rows.items()
        if row.chars and (at := block(token)) not in loose and not constant.isdisjoint(_path(at, parent))
    }
    # a doubtful element of an article is none of it if it consists of links or its slots are template
    for top, row in rows.items():
        if row.doubt and not (row.parent in rows and rows[row.parent].doubt):
            below = [token for token in rows if rows[token].chars and top in _path(token, parent)]
            linked = sum(rows[token].linked for token in below)
            if 2 * linked >= sum(rows[token].chars for token in below) or all(still(rows[block(token)]) for token in below):
                fixed.update(below)
    # data of an element: what varies in it and below it, without noise and without links but those of headings
    data = dict.fromkeys(rows, 0)
    total = 0
    for token, row in rows.items():
        if row.noise or token in fixed:
            continue
        own = row.chars - (0 if HEADING.fullmatch(name[block(token)]) else row.linked)
        total += own
        for above in _path(token, parent):
            data[above] += own
    usable = [token for token in rows if token in frame and not rows[token].noise]
    best: dict[tuple[int, int], int] = {}  # of each name and class
    for token in usable:
        if name[token] in ARTICLE_TAGS:
            key = ARTICLE_TAGS.index(name[token]), rows[token].family
            if key not in best or data[token] > data[best[key]]:
                best[key] = token
    chosen = [best[key] for key in sorted(best, key=lambda key: (key[0], -data[best[key]]))]
    if not chosen and total:
        listed = _lists(rows, parent, block, data, total)
        for token in listed - fixed:
            row = rows[token]
            own = row.chars - (0 if HEADING.fullmatch(name[block(token)]) else row.linked)
            if not row.noise:
                total -= own
                for above in _path(token, parent):
                    data[above] -= own
        fixed |= listed
        # the last in page order is the deepest, as all lie on one path
        around = [token for token in usable if data[token] == total][-1:]
        if around:
            fixed |= {token for token, row in rows.items() if row.chars and around[0] not in _path(token, parent)}
    return {"article": [int(t) for t in chosen], "fixed": [int(t) for t in fixed]}


def _lists(rows: dict, parent: dict[int, int], block: Callable[[int], int], data: dict[int, int], total: int) -> set[int]:
    """Tokens whose text is in slots that consist of links, or in elements of one class that repeat on a page.

    The latter if no less data stands outside them. Headings are no such slots.
    """
    chars: dict[int, int] = defaultdict(int)
    linked: dict[int, int] = defaultdict(int)
    for token, row in rows.items():
        chars[block(token)] += row.chars
        linked[block(token)] += row.linked
    links = {at for at in chars if chars[at] and 2 * linked[at] >= chars[at] and not HEADING.match(rows[at].sign)}
    several = {token for token, row in rows.items() if row.n >= 2 * row.pages and REPEATING.match(row.sign) and not row.noise}
    tops = [token for token in several if several.isdisjoint(_path(token, parent)[1:])]
    if 2 * sum(data[token] for token in tops) > total:
        several = set()
    return {
        token
        for token, row in rows.items()
        if row.chars and (block(token) in links or not several.isdisjoint(_path(token, parent)))
    }


def _path(token: int, parent: dict[int, int]) -> list[int]:
    """The token and those above it, as far as they are known."""
    path: list[int] = []
    while token in parent and token not in path:
        path.append(token)
        token = parent[token]
    return path


def templates(pages: DataFrame, support: float = 0.2) -> DataFrame:
    """(host, article, fixed): tokens of the articles' elements, best first, and of template text."""

    def run(tokens: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"host": tokens["host"].iloc[0], **deduce(tokens)}])

    return host_tokens(pages, support).groupBy("host").applyInPandas(run, "host string, article array<long>, fixed array<long>")


def main_text(page: str, article: list[int], fixed: frozenset[int]) -> str:
    """The text of the article's slots; blocks are parted by one space."""
    events = list(read(page))
    here = {element.token for kind, element, _ in events if kind == "open"}
    top = next((token for token in article if token in here), None)
    parts: list[str] = []
    own: list[str] = []
    rest: list[str] = []
    open_in: dict[int, tuple[bool, bool]] = {0: (False, False)}  # token: within the chosen article, within any
    starts = 0
    for kind, element, text in events:
        if kind == "open":
            within, any_article = open_in[element.parent]
            starts += element.article and not any_article
            open_in[element.token] = (within or element.token == top, element.article)
        elif kind == "break":
            parts.append(" ")
            own.append(" ")
            rest.append(" ")
        elif element is None:
            rest.append(text)
        elif not element.noise and element.token not in fixed:
            if open_in[element.token][0]:
                parts.append(text)
            if element.article:
                own.append(text)
            rest.append(text)
    if top is None:
        parts = own if (article or starts == 1) and any(part.strip() for part in own) else rest
    return " ".join("".join(parts).split())


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, text) of every row of `pages` (page_id, url, html)."""
    keyed = pages.select("page_id", "url", "html", host_of("url").alias("host"), F.xxhash64("page_id", "url").alias("page"))
    found = materialise(templates(keyed))
    joined = keyed.join(found.withColumnRenamed("host", "of"), F.col("host") == F.col("of"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            article, fixed = batch.column("article").to_pylist(), batch.column("fixed").to_pylist()
            for at, texts in text_batches(batch, "html"):
                rows = batch.slice(at, len(texts))
                done = [
                    main_text(text, article[at + i] or [], frozenset(fixed[at + i] or ()))
                    for i, text in enumerate(texts)
                ]
                columns = [rows.column(name) for name in ("page_id", "url", "host")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(done, pa.string())], ["page_id", "url", "host", "text"])

    types = ", ".join(f"{name} {pages.schema[name].dataType.simpleString()}" for name in ("page_id", "url"))
    wanted = joined.select("page_id", "url", "host", "html", "article", "fixed")
    return map_arrow(wanted, run, f"{types}, host string, text string")
