"""Main text of web pages by differencing each page with its nearest neighbour by URL.

Pages are ordered by host, URL path and query. Pages of equal lines that follow each other are a run, and count as one:
the nearest of a page is the one before or after its run, on the same host, whose path and query share the longer
start. The lines of both are aligned by their longest common subsequence, and shared lines are
deleted: what a site repeats from page to page is not the page's text.

A line (the text of one block, white space made single) carries what the markup says of it. Lines in the page's
own article are confirmed: they stay also where the nearest page has them. Menus, forms, adverts and the like are
deleted also where no neighbour repeats them. The differencing decides on all other lines, beside an article too.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerhouse.llm.common import saved
from layerhouse.llm.neighbours import ordered
from layerhouse.llm.url_filter import host_of, path_of

ARTICLE, OPEN, OUT, DOUBT = "A", "O", "X", "?"
RAW_TAGS = frozenset(("script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"))
OUT_TAGS = frozenset(("nav", "footer", "aside", "head", "button", "select", "menu", "dialog", "svg", "math", "canvas", "object",
                      "audio", "video", "fieldset"))
OUT_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu",
                       "menubar", "toolbar"))
VOID_TAGS = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
INLINE_TAGS = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i",
                         "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
                         "sub", "sup", "time", "tt", "u", "var", "wbr", "picture", "source"))
#: A class or id made of these words alone marks a part of a page beside its article.
OUT_WORDS = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promoted",
    "nav", "navbar", "navigation", "menu", "menus", "breadcrumb", "breadcrumbs", "sidebar", "sidebars", "aside", "footer", "masthead",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription",
    "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations", "widget", "toolbar", "pagination", "pager",
    "comment", "comments", "commentlist", "replies", "disqus", "respond", "skip", "copyright", "form", "search"))
HEADER_WORDS = frozenset(("header", "topbar"))
#: Words that say nothing beside a listed one; with any other word (has-sidebar, social-policy) the block is in doubt.
PLAIN_WORDS = frozenset(("site", "page", "top", "bottom", "list", "links", "item", "items", "bar", "box", "block", "slot", "button", "buttons",
                         "posts", "articles", "section"))

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|[^<]+|<", re.S)
#: One attribute after the other, its name whole and its value with it, so that words in other names and values are not read as names.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>]+)))?|[\s\"'>/=]")
_WORD = re.compile(r"[a-z]+")


def _outside(tag: str, attributes: str) -> str | None:
    """'out' for an element beside the article, 'soft' for one that its class or id says so of, 'header' for a header (part
    of an article if inside one), 'form'. Only a class or id whose words are all listed counts; the differencing decides on others."""
    if tag in OUT_TAGS:
        return "out"
    if tag in ("header", "form"):
        return tag
    if not attributes or tag in ("html", "body", "article", "main"):
        return None
    found = None
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name not in ("class", "id", "role", "hidden", "aria-hidden", "style"):
            continue
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return "out"
        if name == "role" and value in OUT_ROLES:
            return "out"
        if name == "role" and value == "form":
            found = "form"
        if name in ("class", "id"):
            for token in re.split(r"\s+", value):
                words = set(_WORD.findall(token)) - PLAIN_WORDS
                if words and words <= OUT_WORDS | HEADER_WORDS:
                    found = "header" if words <= HEADER_WORDS and not found else "soft"
    return found


def lines(page: str) -> list[tuple[str, str]]:
    """(kind, text) of every block that has text, in page order: in the article, outside it, or open.

    An article in a block that only its class or id puts beside the article, and a form in an article, are the article
    if the page has no other.
    """
    found: list[tuple[str, str]] = []
    pieces: list[str] = []
    stack: list[tuple[str, str]] = []  # (tag, what it is) of open elements
    held = dict.fromkeys(("", "article", "nested", "out", "soft", "form"), 0)  # how many are open
    at, end = 0, len(page)

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                if held["out"] or held["soft"] and not held["nested"]:
                    kind = OUT
                elif held["soft"] or held["form"]:
                    kind = DOUBT
                else:
                    kind = ARTICLE if held["article"] else OPEN
                found.append((kind, text))

    while at < end:
        token = _TOKEN.match(page, at)
        at = token.end()
        tag = token.group(2)
        if tag is None:
            if page[token.start()] != "<" or at - token.start() == 1:
                pieces.append(token.group())
            continue
        tag = tag.lower()
        if tag in RAW_TAGS:  # not shown, so it does not break the line it stands in
            if not token.group(1):
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if tag not in INLINE_TAGS:
            flush()
        elif tag == "br":
            pieces.append(" ")
        if token.group(1):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    if any(what for _, what in stack[depth:]):
                        flush()
                    for _, what in stack[depth:]:
                        held[what] -= 1
                    del stack[depth:]
                    break
            continue
        attributes = token.group(3)
        if tag in VOID_TAGS or attributes.endswith("/") and tag in INLINE_TAGS:
            continue
        what = "article" if tag in ("article", "main") else _outside(tag, attributes)
        inside = held["article"] or held["nested"]
        if what == "header":
            what = None if inside else "out" if tag == "header" else "soft"
        if what == "article" and held["soft"]:
            what = "nested"
        elif what == "soft" and held["nested"]:
            what = "out"
        elif what == "form" and not inside:
            what = None
        if what and tag in INLINE_TAGS:
            flush()
        if tag == "p":  # a paragraph ends where the next one starts
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == "p":
                    if not any(w for _, w in stack[depth:]):
                        del stack[depth:]
                    break
                if stack[depth][0] not in INLINE_TAGS:
                    break
        held[what or ""] += 1
        stack.append((tag, what or ""))
    flush()
    doubt = OUT if any(kind == ARTICLE for kind, _ in found) else ARTICLE
    return [(doubt if kind == DOUBT else kind, text) for kind, text in found]


def _lengths(a: list[int], b: list[int]) -> list[int]:
    """Length of the longest common subsequence of ``a`` and each start of ``b``, by bits."""
    masks: dict[int, int] = {}
    for i, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        match = row & masks.get(x, 0)
        row = (row + match | row - match) & full
    out, n = [0], 0
    for bit in bin(row | 1 << len(b))[:2:-1]:
        n += bit == "0"
        out.append(n)
    return out


def shared(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``, in memory that grows with the lines only.

    Lines that only one page has can not be in it and go first; then halves are aligned in turn.
    """
    numbers: dict[str, int] = {}
    other = set(b)
    places = [i for i, x in enumerate(a) if x in other]
    mine = set(a)
    left = [numbers.setdefault(a[i], len(numbers)) for i in places]
    right = [numbers.setdefault(x, len(numbers)) for x in b if x in mine]
    found: set[int] = set()
    tasks = [(0, len(left), 0, len(right))]
    while tasks:
        a0, a1, b0, b1 = tasks.pop()
        while a0 < a1 and b0 < b1 and left[a0] == right[b0]:
            found.add(places[a0])
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and left[a1 - 1] == right[b1 - 1]:
            found.add(places[a1 - 1])
            a1, b1 = a1 - 1, b1 - 1
        if a0 >= a1 or b0 >= b1:
            continue
        if a1 - a0 == 1:
            if left[a0] in right[b0:b1]:
                found.add(places[a0])
            continue
        half = (a0 + a1) // 2
        ahead = _lengths(left[a0:half], right[b0:b1])
        behind = _lengths(left[half:a1][::-1], right[b0:b1][::-1])[::-1]
        best = max(range(len(ahead)), key=lambda k: ahead[k] + behind[k])
        tasks += [(a0, half, b0, b0 + best), (half, a1, b0 + best, b1)]
    return found


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def nearest(path: str, before: tuple | None, after: tuple | None) -> tuple | None:
    """The neighbour whose path shares the longer start with ``path``; on a tie the one before.

    A neighbour of the same path is the page itself once more, and none.
    """
    before, after = (None if x is None or x[0] == path else x for x in (before, after))
    if before is None or after is None:
        return before or after
    return after if _common(path, after[0]) > _common(path, before[0]) else before


def main_text(own: list[tuple[str, str]], other: list[tuple[str, str]] | None) -> str:
    """The lines that are left, each after a line feed; ``other`` are the lines of the nearest page, if any.

    The lines shared with it are deleted. Then the markup has the last word on single lines: those of the
    page's article come back, those beside it go even if no other page has them. Open lines stay if they are not
    shared; without a page to compare with, they stay only if the markup shows no article.
    """
    gone = shared([x for _, x in own], [x for _, x in other]) if other else set()
    asked = bool(other) or all(kind != ARTICLE for kind, _ in own)
    return "\n".join(text for i, (kind, text) in enumerate(own) if kind == ARTICLE or kind == OPEN and asked and i not in gone)


def _packed(found: list[tuple[str, str]]) -> bytes:
    """The lines as they are shuffled: one text, compressed."""
    return zstandard.compress("\n".join(kind + text for kind, text in found).encode())


def _unpacked(packed: bytes | None) -> list[tuple[str, str]] | None:
    if packed is None:
        return None
    text = zstandard.decompress(packed).decode()
    return [(x[0], x[1:]) for x in text.split("\n")] if text else []


_LINED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("path", pa.string()),
                    ("query", pa.string()), ("lines", pa.binary())])
_DONE = "page_id long, url string, text string"
_EDGE = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("part", pa.int32()), ("edge", pa.int32()),
    ("host", pa.string()), ("path", pa.string()), ("last_path", pa.string()), ("lines", pa.binary()), ("near_path", pa.string()),
    ("near_lines", pa.binary())])
FIRST, LAST, ONLY = 1, 2, 3  #: runs at the ends of a partition
ROWS = 512


def _split(batches):
    for batch in batches:
        packed = [_packed(lines(x or "")) for x in batch.column(5).to_pylist()]
        yield pa.record_batch([*batch.columns[:5], pa.array(packed, pa.binary())], schema=_LINED)


def _batched(rows, schema):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _texts(own: bytes, before: tuple | None, after: tuple | None):
    """The text of a run's page by its path, which tells the nearer of the run's neighbours (path, lines)."""
    known: dict[bytes | None, str] = {}

    def text(path: str) -> str:
        near = nearest(path, before, after)
        other = near[1] if near else None
        if other not in known:
            known[other] = main_text(_unpacked(own), _unpacked(other))
        return known[other]

    return text


def _partition(batches):
    """Finished rows; of the runs at the ends of the partition, the rows without text (lines null) and one row for the run."""

    def rows():
        part = TaskContext.get().partitionId()
        before = host = own = None
        run: list[tuple] = []  # (page_id, url, path and query)
        first = True

        def edge(kind: int, near: tuple | None):
            for page_id, url, path in run:
                yield (page_id, url, None, part, kind, host, path, None, None, None, None)
            yield (None, None, None, part, kind, host, run[0][2], run[-1][2], own, *(near or (None, None)))

        for batch in batches:
            for page_id, url, its_host, path, query, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if not its_host:
                    yield (page_id, url, main_text(_unpacked(packed), None), part, 0, *[None] * 6)
                    continue
                path += query
                if run and (its_host, packed) != (host, own):
                    after = (path, packed) if its_host == host else None
                    if first:
                        yield from edge(FIRST, after)
                    else:
                        text = _texts(own, before, after)
                        for r in run:
                            yield (r[0], r[1], text(r[2]), part, 0, *[None] * 6)
                    before, first = (run[-1][2], own) if its_host == host else None, False
                    run = []
                host, own = its_host, packed
                run.append((page_id, url, path))
        if run:
            yield from edge(ONLY if first else LAST, before)

    return _batched(rows(), _EDGE)


def _links(runs: list[tuple[int, int, str, str]]) -> list[tuple]:
    """Where the neighbours of the runs at partition ends stand, from all such runs (part, edge, host, mark of the lines).

    Rows (part, edge, then for before and after: part, edge, inner); ``inner`` is the near page of that run, not the run.
    A run that goes on in the next partitions is followed to its end.
    """
    runs = sorted(runs)
    found = []
    for step, ends in ((1, (LAST, ONLY)), (-1, (FIRST, ONLY))):
        side: list[tuple] = [(None, None, None)] * len(runs)
        for i in range(len(runs))[::-step]:
            part, edge, host, mark = runs[i]
            if edge not in ends:
                side[i] = (part, edge, True)
            elif 0 <= i + step < len(runs) and runs[i + step][2] == host:
                beyond = runs[i + step]
                side[i] = side[i + step] if beyond[3] == mark else (beyond[0], beyond[1], False)
        found.append(side)
    return [(*run[:2], *before, *after) for run, after, before in zip(runs, *found)]


def _ends(batches):
    schema = pa.schema([_EDGE.field(i) for i in range(3)])
    held, text = None, None
    for batch in batches:
        rows = []
        for page_id, url, path, part, edge, own, *sides in zip(*(c.to_pylist() for c in batch.columns)):
            if held != (part, edge):
                held, text = (part, edge), _texts(own, *(None if x[0] is None else x for x in (tuple(sides[:2]), tuple(sides[2:]))))
            rows.append((page_id, url, text(path)))
        yield from _batched(rows, schema)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Rows (page_id, url, text, n_chars), one for each row of ``pages``.

    A null page is empty; a page without a host (a null url, or one without ``://``) is compared with none. Equal
    urls are ordered by page_id; repeated rows stay, and have the text of the single row. A page alone on its host
    is compared with none. An empty table gives no rows. The driver holds two numbers for each partition.
    """
    address = F.col(url)
    query = F.coalesce(F.regexp_extract(address, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1), F.lit(""))
    source = pages.select(
        F.col(page_id).cast("long").alias("page_id"), address.alias("url"), host_of(address).alias("host"),
        path_of(address).alias("path"), query.alias("query"), F.col(page).alias("html"))
    lined = source.mapInArrow(_split, "page_id long, url string, host string, path string, query string, lines binary")
    extra = ", part int, edge int, host string, path string, last_path string, lines binary, near_path string, near_lines binary"
    done = saved(ordered(lined, "host", "path", "query", "page_id", "url", ties="lines").mapInArrow(_partition, _DONE + extra), "pages")
    runs = done.filter("edge > 0 and lines is not null")
    marks = runs.select("part", "edge", "host", F.sha2("lines", 256)).collect()
    links = pages.sparkSession.createDataFrame(_links([tuple(r) for r in marks]), "part int, edge int, " + ", ".join(
        f"part_{x} int, edge_{x} int, inner_{x} boolean" for x in ("before", "after")))
    near = runs.select("part", "edge", "lines").join(links, ["part", "edge"])
    for x, end in (("before", "last_path"), ("after", "path")):
        other = runs.select(*(F.col(c).alias(f"{c}_{x}") for c in ("part", "edge")), F.col(end).alias("_path"), F.col("lines").alias("_lines"),
                            "near_path", "near_lines")
        pick = {f"path_{x}": F.when(F.col(f"inner_{x}"), F.col("near_path")).otherwise(F.col("_path")),
                f"lines_{x}": F.when(F.col(f"inner_{x}"), F.col("near_lines")).otherwise(F.col("_lines"))}
        near = near.join(other, [f"part_{x}", f"edge_{x}"], "left").withColumns(pick).drop("_path", "_lines", "near_path", "near_lines")
    rows = done.filter("edge > 0 and lines is null").select("page_id", "url", "path", "part", "edge")
    ends = rows.join(near, ["part", "edge"]).select(
        "page_id", "url", "path", "part", "edge", "lines", "path_before", "lines_before", "path_after", "lines_after").mapInArrow(_ends, _DONE)
    found = done.filter("edge = 0").select("page_id", "url", "text").unionByName(ends)
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
