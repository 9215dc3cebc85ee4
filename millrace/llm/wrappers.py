"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page is a stream of tokens (tags and texts), balanced by the ends that HTML implies. The wrapper of a host
starts as the stream of one page and is aligned with one page after another, from the outside in. Where the
streams differ, texts become slots, tags that one of them lacks become optional, and what stands
several times in a row, alone or as a stretch of tags, becomes a repeated group. So it never needs a union.

Aligning two wrappers is the same as aligning a wrapper with a page. Every task folds the pages it reads
into one wrapper per host, and wrappers of a host are merged in rounds of 64; a host with a third of all
pages is a few hundred bytes more from each task, never one group of pages.

On the finished wrapper the region of the article is chosen: an `article` or `main` tag that holds text,
else the innermost container that holds nearly all text of slots. Every page is matched against its host's wrapper
and gives the text of its tokens in the region, without menus, notices, adverts, forms, comments and the like.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import cut
from millrace.llm.lines import fresh

FAN_IN = 64
BROADCAST_BYTES = 32 << 20
_HOSTS_HELD = 2_000
_DEEPEST = 120
_MOST = 0.9

# Tags by what HTML or their authors mean with them.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script|style|title|textarea|iframe|xmp"
_IN_HEAD = set("title style script meta link base noscript template".split())
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
_ENDS_P = _BLOCKS - set("body caption html legend option tbody td tfoot th thead title tr".split())
_ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HOLDERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
_NEVER_TAGS = set(
    "head nav aside footer form script style noscript template iframe select button textarea dialog svg object canvas title xmp".split()
)
_NEVER_WORDS = set(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs "
    "pagination pager sidebar aside widget related recommended footer contentinfo complementary cookie cookies consent notice "
    "alert popup modal dialog newsletter subscribe signup paywall comment comments disqus reply replies respond share sharing "
    "social search login copyright".split()
)
_OUTSIDE_WORDS = {"header", "masthead", "banner"}
_MAIN = {"article", "main"}
_CONTAINERS = {"div", "section", "article", "main", "ul", "ol", "table"}
_NAMES = 61

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b(?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*+>(?P<inner>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<tag>/?[a-z][^\s/><]*)(?P<attributes>(?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*+)>|<(?P<broken>/?[a-z][^\s/><]*)(?P<rest>[^<>]*)>?"
    r"|<[!?/][^>]*>?|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_WORDS = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

# A page is nested lists: a text is a string, an element is [label, children].


def _label(tag: str, attributes: str) -> str:
    """Tag, a number from the words that name it, `-` if it never holds main text and `~` if only in an article.

    Containers are told apart by their names, in `_NAMES` classes, so that a host that makes up a new name
    for every page has a bounded number of labels all the same.
    """
    if tag in _NEVER_TAGS:
        return f"{tag}-"
    found = {w for groups in _WORDS.findall(attributes) for w in re.split(r"[^a-z]+", "".join(groups).lower()) if w} if attributes else set()
    named = f"{tag}.{crc32(' '.join(sorted(found)).encode()) % _NAMES}" if found and tag in _CONTAINERS else tag
    if not _NEVER_WORDS.isdisjoint(found):
        return f"{named}-"
    if tag == "header" or not _OUTSIDE_WORDS.isdisjoint(found):
        return f"{named}~"
    return named


def _tag(label: str) -> str:
    return label.rstrip("-~").split(".")[0]


def parse(page: str) -> list:
    """The balanced token stream of a page, as the children of its root."""
    root: list = []
    open_: list[tuple[str, list]] = [("", root)]

    def close(names: set[str], until: set[str] = frozenset()) -> None:
        """End the innermost open tag of these names, and all inside; none beyond a tag of `until`."""
        for at in range(len(open_) - 1, 0, -1):
            if open_[at][0] in names:
                del open_[at:]
                return
            if open_[at][0] in until:
                return

    for found in _TOKEN.finditer(page):
        if text := found["text"]:
            inside = open_[-1][1]
            if inside and isinstance(inside[-1], str):
                inside[-1] += text
            else:
                inside.append(text)
            continue
        if raw := found["raw"]:
            open_[-1][1].append([_label(raw.lower(), ""), [found["inner"]] if raw.lower() == "title" else []])
            continue
        tag = (found["tag"] or found["broken"] or "").lower()
        if not tag:
            continue
        if tag[0] == "/":
            name = tag[1:]
            if name == "br":
                open_[-1][1].append(["br", []])
            # An inline end does not reach out of its block.
            close({name}, set() if name in _BLOCKS else _BLOCKS)
            continue
        if open_[-1][0] == "head" and tag not in _IN_HEAD:
            open_.pop()
        if tag in _ENDS_P:
            close({"p"}, _BLOCKS - {"p"})
        if tag in _ENDED_BY:
            close(_ENDED_BY[tag], _HOLDERS[tag])
        attributes = found["attributes"] or found["rest"] or ""
        children: list = []
        open_[-1][1].append([_label(tag, attributes), children])
        # As browsers do, what is nested too deep continues beside.
        if tag not in _VOID and not (attributes.endswith("/") and tag in ("svg", "path")) and len(open_) < _DEEPEST:
            open_.append((tag, children))
    return root


# A wrapper is a list of nodes: key, optional, repeated, times seen, characters, checksum of a text
# that was the same every time (else -1), children. Keys: `#` a text, a label, or ( ) around a group's keys.
KEY, OPTIONAL, REPEATED, SEEN, CHARS, SAME, CHILDREN = range(7)


def _merged(a: list, b: list) -> list:
    return [
        a[KEY],
        a[OPTIONAL] or b[OPTIONAL],
        a[REPEATED] or b[REPEATED],
        a[SEEN] + b[SEEN],
        a[CHARS] + b[CHARS],
        a[SAME] if a[SAME] == b[SAME] else -1,
        aligned(a[CHILDREN], b[CHILDREN]) if a[CHILDREN] or b[CHILDREN] else [],
    ]


def _folded(nodes: list) -> list:
    """Neighbours of one key become a repeated node, stretches of keys that follow each other a repeated group."""
    single: list = []
    for node in nodes:
        if single and single[-1][KEY] == node[KEY]:
            single[-1] = _merged(single[-1], node)
            single[-1][REPEATED] = 1
        else:
            single.append(node)
    for size in range(2, min(6, len(single) // 2) + 1):
        keys = [n[KEY] for n in single]
        out: list = []
        at = 0
        while at < len(single):
            if keys[at : at + size] == keys[at + size : at + 2 * size] and at + 2 * size <= len(single):
                group = single[at : at + size]
                at += size
                while keys[at : at + size] == [n[KEY] for n in group]:
                    group = [_merged(x, y) for x, y in zip(group, single[at : at + size])]
                    at += size
                out.append(_group(group, 1))
            else:
                out.append(single[at])
                at += 1
        single = out
    return single


def _group(nodes: list, repeated: int) -> list:
    return ["(" + " ".join(n[KEY] for n in nodes) + ")", 0, repeated, 1, 0, -1, nodes]


def _grouped(nodes: list, other: list) -> list:
    """Stretches that are one turn of a group of `other` become such a group."""
    for group in other:
        if group[KEY][0] == "(" and all(n[KEY] != group[KEY] for n in nodes):
            keys, size = [n[KEY] for n in group[CHILDREN]], len(group[CHILDREN])
            for at in range(len(nodes) - size + 1):
                if [n[KEY] for n in nodes[at : at + size]] == keys:
                    nodes = nodes[:at] + [_group(nodes[at : at + size], 0)] + nodes[at + size :]
                    break
    return nodes


def aligned(a: list, b: list) -> list:
    """The wrapper of all that either wrapper reads."""
    if [n[KEY] for n in a] == [n[KEY] for n in b]:
        return [_merged(x, y) for x, y in zip(a, b)]
    a, b = _grouped(a, b), _grouped(b, a)
    first = 0
    while first < min(len(a), len(b)) and a[first][KEY] == b[first][KEY]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last][KEY] == b[-1 - last][KEY]:
        last += 1
    x, y = a[first : len(a) - last], b[first : len(b) - last]
    # Most matches of what is left in between, from each pair of places on.
    most = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            most[i][j] = most[i + 1][j + 1] + 1 if x[i][KEY] == y[j][KEY] else max(most[i + 1][j], most[i][j + 1])
    out = [_merged(n, m) for n, m in zip(a[:first], b[:first])]
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i][KEY] == y[j][KEY]:
            out.append(_merged(x[i], y[j]))
            i, j = i + 1, j + 1
            continue
        take_x = j == len(y) or (i < len(x) and most[i + 1][j] >= most[i][j + 1])
        node = list(x[i] if take_x else y[j])
        node[OPTIONAL] = 1
        out.append(node)
        i, j = i + take_x, j + (not take_x)
    ends = zip(a[len(a) - last :], b[len(b) - last :]) if last else ()
    return _folded(out + [_merged(n, m) for n, m in ends])


def of_page(children: list) -> list:
    """The wrapper of a single page."""
    nodes = []
    for child in children:
        if isinstance(child, str):
            text = " ".join(child.split())
            if text:
                nodes.append(["#", 0, 0, 1, len(text), crc32(text.encode("utf-8", "replace")), []])
        else:
            nodes.append([child[0], 0, 0, 1, 0, -1, of_page(child[1])])
    return _folded(nodes)


def _weights(node: list, pages: int) -> tuple[int, int, int]:
    """Characters of slots that may be main text, of those in links, and of all texts, below a node."""
    if node[KEY] == "#":
        # A text that is the same on every one of several pages belongs to the template.
        fixed = node[SAME] >= 0 and node[SEEN] >= 3 and node[SEEN] >= pages
        return 0 if fixed else node[CHARS], 0, node[CHARS]
    if node[KEY][-1] in "-~" and node[KEY][0] != "(":
        return 0, 0, 0
    slots = links = every = 0
    for child in node[CHILDREN]:
        s, k, t = _weights(child, pages)
        slots, links, every = slots + s, links + k, every + t
    return slots, slots if node[KEY] == "a" else links, every


def _elements(nodes: list, path: tuple = ()) -> Iterator[tuple[tuple, list]]:
    """Elements that may hold main text and their paths, outer ones first."""
    for at, node in enumerate(nodes):
        if node[KEY] != "#" and (node[KEY][0] == "(" or node[KEY][-1] not in "-~"):
            yield (*path, at), node
            yield from _elements(node[CHILDREN], (*path, at))


def finished(wrapper: list, pages: int) -> dict:
    """A wrapper with the paths of its regions: those that hold the article."""
    regions: list[tuple] = []
    for path, node in _elements(wrapper):
        if _tag(node[KEY]) in _MAIN and _weights(node, pages)[2] and not any(path[: len(r)] == r for r in regions):
            regions.append(path)
    if regions:
        return {"nodes": wrapper, "pages": pages, "regions": regions}
    # From the root on into the element that holds nearly all slots, as long as it is a single container.
    path, inside = (), wrapper
    while True:
        own = [(w[0] - w[1], at) for at, w in enumerate(_weights(n, pages) for n in inside)]
        most, at = max(own, default=(0, 0))
        if not most or most < _MOST * sum(w for w, _ in own):
            break
        node = inside[at]
        if node[REPEATED] or _tag(node[KEY]) not in _CONTAINERS | {"html", "body", "td", "tr", "tbody", "center"}:
            break
        path, inside = (*path, at), node[CHILDREN]
    return {"nodes": wrapper, "pages": pages, "regions": [path] if path else []}


class Reader:
    """Reads pages by the finished wrapper of their host."""

    def __init__(self, wrapper: dict):
        self.pages = wrapper["pages"]
        self.regions = {id(self._at(wrapper["nodes"], path)) for path in wrapper["regions"]}
        self.nodes = wrapper["nodes"]
        self.flat: dict[int, tuple[list, dict[str, list[int]]]] = {}

    @staticmethod
    def _at(nodes: list, path: list[int]) -> list:
        for at in path[:-1]:
            nodes = nodes[at][CHILDREN]
        return nodes[path[-1]]

    def _members(self, nodes: list) -> tuple[list, dict[str, list[int]]]:
        """Nodes in order with groups opened, and the places of each key."""
        known = self.flat.get(id(nodes))
        if known is None:
            flat: list = []

            def opened(some: list) -> None:
                for node in some:
                    if node[KEY][0] == "(":
                        opened(node[CHILDREN])
                    else:
                        flat.append(node)

            opened(nodes)
            places: dict[str, list[int]] = {}
            for at, node in enumerate(flat):
                places.setdefault(node[KEY], []).append(at)
            known = self.flat[id(nodes)] = (flat, places)
        return known

    def matched(self, children: list, nodes: list) -> Iterator[tuple]:
        """Each child with its node: the same one again if it repeats, else the next of its key, else one
        of a group that starts anew; None for what the wrapper does not know."""
        flat, places = self._members(nodes)
        at = 0
        for child in children:
            key = "#" if isinstance(child, str) else child[0]
            if at < len(flat) and flat[at][KEY] == key:
                yield child, flat[at]
            elif key in places:
                at = next((p for p in places[key] if p > at), places[key][0])
                yield child, flat[at]
            else:
                yield child, None

    def text(self, page: str) -> str:
        """Blocks of the article, joined by empty lines."""
        blocks: list[str] = []
        others: list[str] = []
        self._walk(parse(page), self.nodes, False, [[], []], [blocks, others])
        return "\n\n".join(blocks or others)

    def _walk(self, children: list, nodes: list, inside: bool, held: list, done: list) -> None:
        """Collect blocks of regions (0), and those of a page that has no region (1)."""

        def flush() -> None:
            for parts, out in zip(held, done):
                block = " ".join(html.unescape("".join(parts)).split())
                if block:
                    out.append(block)
                parts.clear()

        for child, node in self.matched(children, nodes):
            if isinstance(child, str):
                if inside:
                    held[0].append(child)
                fixed = node is not None and node[SAME] >= 0 and node[SEEN] >= 3 and node[SEEN] >= self.pages
                if not fixed or not child.strip():
                    held[1].append(child)
                continue
            label, below = child
            if label in ("br", "wbr"):
                for parts in held:
                    parts.append(" " if label == "br" else "")
                continue
            if label[-1] == "-" or (label[-1] == "~" and not inside):
                if _tag(label) in _BLOCKS:
                    flush()
                continue
            within = inside or (id(node) in self.regions if node is not None else _tag(label) in _MAIN)
            block = _tag(label) in _BLOCKS or within != inside
            if block:
                flush()
            self._walk(below, node[CHILDREN] if node is not None else [], within, held, done)
            if block:
                flush()
        if nodes is self.nodes:
            flush()


def host(url: str = "url") -> Column:
    """Host of an address in lower case, empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


_WRAPPER = "_host string, _place bigint, _pages bigint, _wrapper string"
_SCHEMA = pa.schema([("_host", pa.string()), ("_place", pa.int64()), ("_pages", pa.int64()), ("_wrapper", pa.string())])


def _texts(column: pa.Array, rows: int = 64) -> Iterator[str]:
    for at in range(0, len(column), rows):
        yield from (v or "" for v in column.slice(at, rows).to_pylist())


def _of_tasks(batches) -> Iterator[pa.RecordBatch]:
    """One wrapper for each host of a task; if there are very many hosts, now and then."""
    place = TaskContext.get().partitionId()
    held: dict[str, list] = {}

    def rows() -> pa.RecordBatch:
        columns = [list(held), [place] * len(held), [w[0] for w in held.values()], [json.dumps(w[1]) for w in held.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SCHEMA.types)], schema=_SCHEMA)

    for batch in batches:
        for name, page in zip(_texts(batch.column(0)), _texts(batch.column(1))):
            new = of_page(parse(page))
            known = held.get(name)
            held[name] = [known[0] + 1, aligned(known[1], new)] if known else [1, new]
            if len(held) >= _HOSTS_HELD:
                yield rows()
                held.clear()
    yield rows()


def _of_group(rows: pd.DataFrame) -> pd.DataFrame:
    """Merge at most some dozens of wrappers of one host."""
    rows = rows.sort_values(["_place", "_pages", "_wrapper"])
    nodes = None
    for text in rows["_wrapper"]:
        nodes = json.loads(text) if nodes is None else aligned(nodes, json.loads(text))
    return pd.DataFrame(
        {"_host": rows["_host"].iloc[:1], "_place": int(rows["_place"].iloc[0]) // FAN_IN, "_pages": int(rows["_pages"].sum()), "_wrapper": json.dumps(nodes)}
    )


def infer_wrappers(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """`_host, _place, _pages, _wrapper`: one wrapper per host, as JSON."""
    read = pages.select(host(url_column).alias("_host"), F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("_html"))
    wrappers = cut(read.mapInArrow(_of_tasks, _WRAPPER), "wrappers")
    places = wrappers.agg(F.max("_place")).first()[0] or 0
    while True:
        group = F.floor(F.col("_place") / FAN_IN)
        wrappers = wrappers.groupBy("_host", group.alias("_group")).applyInPandas(_of_group, _WRAPPER)
        if places < FAN_IN:
            return cut(wrappers, "wrappers")
        places //= FAN_IN


_READERS_KEPT = 256


def _extract(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    readers: dict[str, Reader] = {}
    for pages, wrappers in batches:
        out = []
        for page, wrapper in zip(_texts(pages), _texts(wrappers)):
            reader = readers.get(wrapper)
            if reader is None:
                if len(readers) >= _READERS_KEPT:
                    readers.clear()
                count, nodes = wrapper.split(" ", 1) if wrapper else ("0", "[]")
                reader = readers[wrapper] = Reader(finished(json.loads(nodes), int(count)))
            out.append(reader.text(page))
        yield pa.array(out, pa.string())


_extract.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}


def main_text(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """The rows of `pages` with `text`, the main text of the whole page, and `n_chars`, its code points.

    Blocks are joined by an empty line; inside a block, references are decoded and white space is one space. A
    null or empty page has an empty text; a null address, or one without a host, is of the empty host.
    Repeated rows have equal texts. New columns take the place of columns of the same name; all others pass
    through. An empty table gives an empty one. Tags nested deeper than 120 continue beside each other.
    Wrappers are joined to pages by a broadcast if all of them, counted first, hold less than `BROADCAST_BYTES`.
    """
    wrappers = infer_wrappers(pages, url_column, html_column)
    key, name = fresh(pages, "_host_key"), fresh(pages, "_wrapper_text")
    known = wrappers.select(F.col("_host").alias(key), F.concat_ws(" ", F.col("_pages").cast("string"), "_wrapper").alias(name))
    size = known.agg(F.sum(F.length(name) + F.length(key) + 64)).first()[0] or 0
    if size < BROADCAST_BYTES:
        known = F.broadcast(known)
    joined = pages.join(known, host(url_column) == known[key], "left")
    text = F.arrow_udf(_extract, "string")(F.col(html_column).cast("string"), F.col(name))
    made = joined.withColumn("text", text)
    kept = [c for c in pages.columns if c.lower() not in ("text", "n_chars")]
    return made.select(*kept, "text", F.char_length("text").cast("bigint").alias("n_chars"))
