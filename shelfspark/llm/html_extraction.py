"""Main-text extraction by tag-path ratios.

Each text node belongs to a root-to-leaf tag path (``html/body/article/p``).  For every path the corpus gives its nodes
and the sums of the logarithms of their characters and punctuation marks.  A path's ratios are characters a node and
punctuation a node, as geometric means, so that one node of any length moves them by its share of the nodes only; both
are smoothed along the path (a path shares in the ratios of its container, so the heading of an article profits from its
paragraphs), fused into their geometric mean, and paths at or above a threshold hold content.  The threshold is a share
of the median fused ratio of a character, every page weighing the same however long it is, so it follows the data and no
single page.  Paths through elements that never hold an article (menus, forms, scripts ...; FIXED VALUES below) get no
score.

Aggregating over the corpus instead of one page keeps the one-word article of a site whose articles are long.

Labels: a path step is a tag name; unknown tags are ``x``.  An element that is hidden, or one of whose class names, id or
role values is a known block name, is ``x.skip`` and holds no article, unless it is an article or main part or encloses
one.  A block whose names only have such a word between hyphens, or beside the name of a content block (``post related``),
keeps its tag name with ``.word``, and its ratios decide.  An element that never holds an article stands as ``div`` where
it encloses an article or main part; so do a form with more than half of the page's characters (pages that old server
frameworks wrap in one).  A header with a heading inside an article is no step of the path.  A label or button inside a paragraph outside
forms stands as ``span``.
Repeated steps count once and steps beyond DEPTH are left off, but all that lies in an element that never
holds an article, however deep, has the path ``x.skip``.  The paths may still grow with the corpus: up to
BROADCAST_PATHS content paths are sent to the tasks, more are joined with the text nodes.

Parsing takes time in proportion to the page, whatever its tags: names and attributes are matched without backtracking,
open elements are found by their tag, and after BROKEN_TAGS tags whose quotes never close a tag ends at its first ``>``.
A slash closes ``svg`` and ``math`` only; a CDATA section is left out as a whole.

Edge cases: null, empty and markup-free html (text outside any tag belongs to path ``html/body``); unclosed and
misplaced tags; character references also without ``;``; repeated rows; an empty table gives no rows; extra columns are
ignored.  A page without a content path has an empty text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import only, ship, stored

DEPTH = 24
#: Share of the median fused ratio that a path must reach, and weight of the container in the smoothing.
THRESHOLD, SMOOTH = 0.3, 0.5
#: Logarithms and page shares are summed as integers of this unit, so the sums don't depend on the order of the rows.
UNIT = 1_000_000
#: Steps of the logarithm of a fused ratio among which the median is taken.
STEPS = 64
#: Paths that a task sums up before it hands them on.
HELD_PATHS = 100_000
#: Tags with unclosed quotes after which a page's quotes count no more.
BROKEN_TAGS = 32
#: More selected paths than this are joined instead of broadcast.
BROADCAST_PATHS = 20_000

# FIXED VALUES: element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math canvas object textarea title select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul".split()
)
INLINE = frozenset(
    "a abbr b bdi bdo big button cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var".split()
)
#: Of RAW: those whose content is text up to the end tag or the end of the page, and those that a slash closes.
RAW_TEXT, SLASHED = frozenset("script style textarea title iframe".split()), frozenset("svg math".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER = frozenset("aside button dialog footer form header head label menu nav select x.skip".split())
#: Elements that a new one of the same group closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: Names in class, id or role that mark a block as no article.
SKIP_NAMES = frozenset(
    "ad ads advert advertisement advertising adbox banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies copyright disclaimer disqus footer footnav header login masthead menu menubar modal nav navbar navigation "
    "newsletter notice pager pagination popup promo promoted related replies reply respond search share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Of these, the ones that don't cut a block which also has a name of a content block.
WEAK_NAMES = frozenset("related share search social widget".split())
CONTENT_NAMES = frozenset("article content entry post story".split())
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
#: Elements and roles that the names of blocks never cut.
MAIN = frozenset("article main".split())

_TEXT = re.compile(r"[^<]++")
_NAME = re.compile(r"</?+([a-zA-Z][^\s/>]*+)")
_QUOTED = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_LEADING, _LONG_NUMBER = re.compile(r"&#0++(?=[0-9])"), re.compile(r"(&#[0-9]{8})[0-9]++")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PUNCTUATION = re.compile(r"[^\w\s]", re.U)
_SPACE = re.compile(r"\s+")


def _unescape(text: str) -> str:
    """The text with its character references decoded; numbers of any length are references too."""
    if "&" not in text:
        return text
    return entities.unescape(_LONG_NUMBER.sub(r"\1", _LEADING.sub("&#", text)))


class _Element:
    """An open tag: its step of the path, the step that it takes if it encloses a main part, and the element around it."""

    __slots__ = ("tag", "label", "plain", "main", "encloses", "parent", "inside", "never", "steps", "path")

    def __init__(self, tag: str, attributes: str, parent: _Element | None, inside: bool = False):
        self.tag, self.parent, self.encloses, self.never, self.steps, self.path = tag, parent, False, False, (), None
        self.label = name = tag if tag in BLOCK or tag in INLINE else "x"
        self.plain = "div" if name in NEVER else name
        self.main = tag in MAIN
        self.inside = inside or self.main  # an article or main part
        if not attributes or name in ("html", "body"):
            return
        given: dict[str, str] = {}
        for key, *values in _ATTRIBUTE.findall(attributes):
            given.setdefault(key.lower(), "".join(values).lower())
        roles = given.get("role", "").split()
        self.main = self.main or not MAIN.isdisjoint(roles)
        if given.get("hidden", "false") != "false" or given.get("aria-hidden", "").strip() == "true" or NOT_SHOWN.search(given.get("style", "")):
            self.label = self.plain = "x.skip"
        elif not self.main:
            names = [*given.get("class", "").split(), given.get("id", "").strip(), *roles]
            word = next((w for n in names for w in re.split(r"[\s_-]+", n) if w in SKIP_NAMES), None)
            if word and tag in BLOCK:
                self.plain = f"{self.plain}.{word}"
                self.label = name if name in NEVER else self.plain
            cut = SKIP_NAMES.intersection(names)
            if cut and not (tag in BLOCK and cut <= WEAK_NAMES and not CONTENT_NAMES.isdisjoint(names)):
                self.label = "x.skip"


def _path(element: _Element) -> str:
    """The element's path; those of the elements around it are kept with them."""
    todo = []
    while element.path is None:
        todo.append(element)
        element = element.parent
    for e in reversed(todo):
        above = e.parent.steps
        e.steps = above if e.label in ("", "html", "body", above[-1]) or len(above) == DEPTH else (*above, e.label)
        e.never = e.parent.never or e.label in NEVER
        e.path = "x.skip" if e.never else "/".join(e.steps)
        element = e
    return element.path


def blocks(page: str | None) -> list[list[tuple[str, str]]]:
    """The page's blocks in order; a block is its text nodes as (path, text), inline elements in place."""
    out: list[list[tuple[_Element, str]]] = []
    now: list[tuple[_Element, str]] = []
    top = _Element("html", "", None)
    top.steps, top.path = ("html", "body"), "html/body"
    stack: list[_Element] = []
    places: dict[str, list[int]] = defaultdict(list)  # tag -> its places in the stack
    inner = top

    def flush():
        nonlocal now
        if any(t.strip() for _, t in now):
            out.append(now)
        now = []

    def close(i: int):
        nonlocal inner
        while len(stack) > i:
            gone = stack.pop()
            places[gone.tag].pop()
            if gone.tag in BLOCK:
                flush()
        inner = stack[-1] if stack else top

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    text, at, broken = page or "", 0, 0
    sections_end = text.rfind("]]>")
    endless: set[str] = set()  # RAW elements that no end tag follows
    forms: list[_Element] = []
    while at < len(text):
        if text[at] != "<":
            found = _TEXT.match(text, at)
            at = found.end()
            now.append((inner, _unescape(found[0])))
            continue
        mark = text[at + 1 : at + 2]
        if mark in ("!", "?"):
            if text.startswith("<!--", at):
                stop, size = text.find("-->", at + 4), 3
            elif at < sections_end and text.startswith("<![CDATA[", at):
                stop, size = text.find("]]>", at), 3
            else:
                stop, size = text.find(">", at), 1
            at = stop + size if stop >= 0 else len(text)
            continue
        m = _NAME.match(text, at)
        if m is None:
            now.append((inner, "<"))
            at += 1
            continue
        end, tag = mark == "/", m[1].lower()
        found = _QUOTED.match(text, m.end()) if broken < BROKEN_TAGS else None
        if found:
            at = found.end()
        else:
            broken += 1
            stop = text.find(">", m.end())
            at = stop + 1 if stop >= 0 else len(text)
        if end:
            if places.get(tag):
                close(places[tag][-1])
            elif tag in BLOCK:
                flush()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                now.append((inner, " "))
            continue
        attributes = text[m.end() : at - (text[at - 1] == ">")]
        if tag in RAW:
            if not (tag in SLASHED and attributes.endswith("/")):
                stop = None if tag in endless else re.compile(rf"</{re.escape(tag)}\b[^>]*+(?:>|\Z)", re.I).search(text, at)
                if stop:
                    at = stop.end()
                elif tag in RAW_TEXT and not attributes.endswith("/"):
                    at = len(text)
                else:
                    endless.add(tag)
            continue
        if tag in BLOCK:
            if tag not in ("html", "body") and places["p"]:
                close(places["p"][0])
            if tag in CLOSES and (i := last(CLOSES[tag])) > last(("ul", "ol", "dl", "table")):
                close(i)
            flush()
        if not attributes.endswith("/") or tag in BLOCK:
            inner = _Element(tag, attributes, inner, inner.inside)
            if inner.main:
                for e in reversed(stack):
                    if e.encloses:
                        break
                    e.encloses, e.label = True, e.plain
            elif inner.label in ("label", "button") and places["p"] and not places["form"]:
                inner.label = "span"
            elif tag in HEADINGS and places["header"]:
                header = stack[places["header"][-1]]
                if header.label == "header" and header.parent.inside:
                    header.label = ""  # no step: its heading is one of the article
            elif inner.label == "form":
                if places["form"]:
                    inner.label = inner.plain  # the form around it decides
                else:
                    forms.append(inner)
            places[tag].append(len(stack))
            stack.append(inner)
    flush()
    if forms:
        _open_whole_forms(forms, out)
    return [[(_path(e), t) for e, t in block] for block in out]


def _open_whole_forms(forms: list[_Element], out: list[list[tuple[_Element, str]]]) -> None:
    """Forms with more than half of the page's characters become ``div``; an element has one form around it at most."""
    of: dict[int, _Element | None] = {}  # element -> the outermost form around it
    own = {id(f) for f in forms}

    def around(element: _Element) -> _Element | None:
        todo = []
        while element is not None and id(element) not in of:
            todo.append(element)
            element = element.parent
        form = of[id(element)] if element is not None else None
        for e in reversed(todo):
            form = form or (e if id(e) in own else None)
            of[id(e)] = form
        return form

    total, held = 0, defaultdict(int)
    for block in out:
        for e, t in block:
            n = len(t.strip())
            total += n
            if n and (form := around(e)):
                held[id(form)] += n
    for f in forms:
        if 2 * held[id(f)] > total:
            f.label = f.plain


def path_sums(pages: DataFrame) -> DataFrame:
    """path, nodes, log_chars, log_marks (sums over the nodes) and weight (shares of their pages' characters outside
    elements that never hold an article) over all pages; partial sums per task, so a hot path is one row a task."""
    ship(pages.sparkSession)
    names = ("nodes", "log_chars", "log_marks", "weight")

    def made(sums: dict[str, list[int]]) -> pa.RecordBatch:
        columns = [pa.array(list(sums), pa.string()), *(pa.array([s[k] for s in sums.values()], pa.int64()) for k in range(4))]
        return pa.RecordBatch.from_arrays(columns, names=["path", *names])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
        for batch in batches:
            for page in batch.column(0):
                chars: dict[str, int] = defaultdict(int)
                for block in blocks(page.as_py()):
                    for path, text in block:
                        if clean := text.strip():
                            s = sums[path]
                            s[0] += 1
                            s[1] += round(UNIT * math.log1p(len(clean)))
                            s[2] += round(UNIT * math.log1p(len(_PUNCTUATION.findall(clean))))
                            chars[path] += len(clean)
                live = {p: c for p, c in chars.items() if NEVER.isdisjoint(p.split("/"))}
                total = sum(live.values())
                for path, c in live.items():
                    sums[path][3] += UNIT * c // total
                if len(sums) > HELD_PATHS:
                    yield made(sums)
                    sums.clear()
        yield made(sums)

    found = pages.select("html").mapInArrow(count, "path string, " + ", ".join(f"{c} long" for c in names))
    return found.groupBy("path").agg(*[F.sum(c).alias(c) for c in names])


def content_paths(sums: DataFrame, threshold: float = THRESHOLD, smooth: float = SMOOTH) -> DataFrame:
    """The paths whose smoothed, fused ratio reaches the threshold."""
    never = F.exists(F.split("path", "/"), lambda s: s.isin(*sorted(NEVER)))
    live = sums.where(~never)
    steps = F.split("path", "/")
    # the container: the nearest block that encloses the leaf block; inline steps don't count
    flat = F.filter(steps, lambda s: ~s.isin(*sorted(INLINE)))
    live = live.withColumn("box", F.array_join(F.slice(flat, 1, F.greatest(F.size(flat) - 1, F.lit(2))), "/"))

    def mean(logs: Column, nodes: Column) -> Column:
        return F.expm1(logs / nodes / UNIT)

    boxes = live.groupBy("box").agg(*[mean(F.sum(f"log_{c}"), F.sum("nodes")).alias(f"box_{c}") for c in ("chars", "marks")])
    both = live.join(boxes, "box")

    def mixed(name: str) -> Column:
        return (1 - smooth) * mean(F.col(f"log_{name}"), F.col("nodes")) + smooth * F.col(f"box_{name}")

    scored = both.withColumn("score", F.sqrt(mixed("chars") * (1 + mixed("marks"))))
    median = F.percentile(F.round(F.log("score") * STEPS).cast("int"), 0.5, F.greatest("weight", F.lit(1)))
    level = scored.agg(F.exp(median / STEPS).alias("level"))
    return scored.join(F.broadcast(level), F.col("score") >= threshold * F.col("level")).select("path", "score")


def _join_block(nodes: list[tuple[str, str]], keep) -> str:
    return _SPACE.sub(" ", "".join(t for p, t in nodes if p in keep)).strip()


_NODES = "nodes array<struct<block:int,place:int,text:string>>"


def _joined(src: DataFrame, paths: DataFrame, schema: T.StructType) -> DataFrame:
    """The texts by a join of the text nodes with the content paths.  The nodes of a page by path, and one row without a
    path for the page itself, are written once, so that both sides of the last join know the page by the same number."""
    names = schema.names[:-1]
    at = len(names)
    node = pa.list_(pa.struct([("block", pa.int32()), ("place", pa.int32()), ("text", pa.string())]))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page_at, numbers, steps, nodes = [], [], [], []
            for i, (page, number) in enumerate(zip(batch.column(at), batch.column(at + 1), strict=True)):
                by_path: dict[str | None, list] = {None: []}
                for b, block in enumerate(blocks(page.as_py())):
                    for k, (path, text) in enumerate(block):
                        if NEVER.isdisjoint(path.split("/")):
                            by_path.setdefault(path, []).append((b, k, text))
                page_at += [i, *[None] * (len(by_path) - 1)]
                numbers += [number.as_py()] * len(by_path)
                steps += by_path.keys()
                nodes += by_path.values()
            own = [batch.column(c).take(pa.array(page_at, pa.int64())) for c in range(at)]
            made = [*own, pa.array(numbers, pa.int64()), pa.array(steps, pa.string()), pa.array(nodes, node)]
            yield pa.RecordBatch.from_arrays(made, names=[*names, "row", "path", "nodes"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for nodes in batch.column(at):
                parts: dict[int, list[str]] = defaultdict(list)
                for n in nodes.as_py() or ():
                    parts[n["block"]].append(n["text"])
                made = (_SPACE.sub(" ", "".join(t)).strip() for t in parts.values())
                texts.append("\n".join(t for t in made if t))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(texts, pa.string())], names=schema.names)

    numbered = src.withColumn("row", F.monotonically_increasing_id())
    spec = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields[:-1]), "row long, path string", _NODES])
    parts = stored(numbered.mapInArrow(spread, spec), "page-parts")
    kept = parts.where("path IS NOT NULL").join(paths, "path", "left_semi")
    whole = kept.groupBy("row").agg(F.sort_array(F.flatten(F.collect_list("nodes"))).alias("nodes"))
    pages = parts.where("path IS NULL").drop("path", "nodes").join(whole, "row", "left")
    return pages.select(*names, "nodes").mapInArrow(read, schema)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, ``keep`` columns and text (never null) of every page."""
    src = pages.select(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keep)], F.col(f"`{html_col}`").alias("html"))
    sums = stored(path_sums(src), "path-sums")  # read twice, with other columns each time
    paths = stored(content_paths(sums).select("path"), "content-paths")
    found = [p for p, in paths.limit(BROADCAST_PATHS + 1).collect()]
    schema = T.StructType([*src.drop("html").schema.fields, T.StructField("text", T.StringType())])
    if len(found) > BROADCAST_PATHS:
        return _joined(src, paths, schema).toDF(id_col, *keep, "text")
    sent = src.sparkSession.sparkContext.broadcast(frozenset(found))
    at = len(keep) + 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page in batch.column(at):
                made = (_join_block(b, sent.value) for b in blocks(page.as_py()))
                texts.append("\n".join(t for t in made if t))
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(texts, pa.string())], names=schema.names)

    return src.mapInArrow(read, schema).toDF(id_col, *keep, "text")
