"""HTML main text by wrappers: union-free regular expressions inferred from the pages of a host.

A page is a stream of block elements and text slots. Repeats in it are folded into groups, and the streams of one host are
aligned one after the other: what differs becomes optional, what repeats becomes a repeated group, and texts become slots.
Only the different shapes of a host - streams without texts - are aligned, in groups of a few hundred and then these
again, so a host of a third of all pages weighs no more than its shapes.

Every shape is then matched to its host's wrapper, which gives every block of text a slot: a place in the wrapper and
the elements around it. Slots are judged by what the host's different pages have there: a slot that mostly holds constant
texts is template, a constant text in another slot is, too, and where no element is marked as the article, so is a slot
of links. The article is looked for in the elements that hold enough of the varying text. Names of elements and classes
(navigation, advert, comment) tell what is left, above all on hosts of few pages.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.llm.common import cut, drop

# a quote opens a value only after an equals sign, and only if it is closed; groups are possessive, so no part is read twice
TAG_END = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+(?:>|\Z)"""
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|</?[a-zA-Z]" + TAG_END + r"|<[!?/][^>]*(?:>|\Z)|<[^<]*|[^<]+", re.S)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
MARK = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?![\w-])\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
BLANK = re.compile(r"\s+")

#: Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg iframe object select math canvas audio video".split())
DROPPED = frozenset("nav header footer aside form button menu dialog fieldset label option".split()) | RAW | {"head"}
BLOCK = frozenset("address article aside blockquote body caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"])}
#: Words of class, id and role names that mark what is not the article, what is, and what says neither.
AWAY = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer disqus footer form header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related replies respond reply share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets alert complementary contentinfo search".split())
STRICT = frozenset("ad ads advert adverts advertisement comment comments cookie cookies nav navbar navigation sidebar sponsor sponsored".split())
HOME = frozenset("article content entry main post story body".split())
NEUTRAL = frozenset("area bar block bottom box container global inner left list outer page primary reader right secondary section site slot text top unit user wrap wrapper".split())
#: The whole of a page: what no word can take away.
WHOLE = frozenset(["html", "body", "article", "main"])
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
#: The longest repeated unit that is folded, in items; shapes that are aligned in one group.
PERIOD, TOGETHER = 16, 256
BROADCAST_ROWS = 50_000
#: A text is template if it is on so many pages of a host at least, and on this part of them; a slot, if that part of its texts is.
CONSTANT_PAGES, CONSTANT_SHARE = 4, 0.5
#: The article's elements hold this part of the varying text at least; a slot of links has this part of its text in links.
ROOT_SHARE, LINK_SHARE = 0.2, 0.6


@lru_cache(maxsize=100_000)
def words_of(token: str) -> frozenset[str]:
    """The words that a class, id or role says: itself, or its parts if all of them are known ones (site-nav, not nav-less)."""
    parts = frozenset(re.split(r"[-_]+", token)) - {""}
    return parts if parts <= AWAY | HOME | NEUTRAL else frozenset([token])


def attributes(tag: str) -> tuple[str, bool]:
    """The words of an element's class, id and role, sorted, and whether it is hidden."""
    names: set[str] = set()
    hidden = False
    for name, value in MARK.findall(tag):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            for token in value.split():
                names |= words_of(token)
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and HIDING.search(value)):
            hidden = True
    return ".".join(sorted(names)), hidden


def stream(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, value): kind is open, close or text; raw elements keep their inside to themselves."""
    skip = ""
    at, n = 0, len(page)
    match = TOKEN.match
    while at < n:
        if skip:
            end = RAW_END[skip].search(page, at)
            at, skip = (end.start() if end else n), ""
            continue
        m = match(page, at)
        at = m.end()
        token = m[0]
        tag = TAG.match(token)
        if not tag:
            if not token.startswith(("<!", "<?", "</")):
                yield "text", "", token
            elif token.startswith("<![CDATA["):
                yield "text", "", token[9:].removesuffix("]]>")
            continue
        name = tag[2].lower()
        if tag[1]:
            yield "close", name, ""
        else:
            yield "open", name, token
            if name in RAW and not token.endswith("/>"):
                skip = name


#: How the article may be told, best first: an article element, a main element, a name that says so, or nothing.
ROOTS = range(4)


@lru_cache(maxsize=200_000)
def part_of(label: str) -> tuple[bool, int]:
    """Whether a label's element is away from the article, and the bits of the ``ROOTS`` that it is."""
    name, _, words = label.removesuffix("!").partition(".")
    said = frozenset(words.split(".")) if words else frozenset()
    away = label.endswith("!") or name in DROPPED
    if name not in WHOLE:
        away = away or bool(said & STRICT) or bool(said & AWAY and not said & HOME)
    root = 0 if name == "article" else 1 if name == "main" else 2 if said & HOME and name in BLOCK - WHOLE else 3
    return away, 8 | 1 << root


class Page:
    """One walk over a page: its shape, and its blocks of text outside what is away from the article.

    ``shape`` has labels of block elements, their ends and # with the path of each block. A label is an element's name with
    the words of its class, id and role, ! if hidden. ``blocks`` has (index in the shape, path, bits of ``ROOTS``, text,
    characters in links). Elements left open end with those around them.
    """

    def __init__(self, source: str):
        self.shape: list[str] = []
        self.blocks: list[tuple[int, str, int, str, int]] = []
        self.open: list[tuple[str, str, bool, int]] = [("", "", False, 8)]  # name, path, away and roots of the elements around
        self.parts: list[str] = []
        self.linked = 0
        links = 0
        for kind, name, value in stream(source):
            if kind == "text":
                if not self.open[-1][2]:
                    said = html.unescape(value) if "&" in value else value
                    self.parts.append(said)
                    self.linked += len(said) if links else 0
                continue
            if name in BLOCK:
                self.flush()
            elif name == "br":
                self.parts.append(" ")
            if kind == "open":
                self.end_implied(name)
                words, hidden = attributes(value) if " " in value or "\n" in value or "\t" in value else ("", False)
                label = name + ("." + words if words else "") + ("!" if hidden else "")
                _, path, away, roots = self.open[-1]
                gone, bits = part_of(label)
                if name in BLOCK:
                    self.shape.append(label)
                    path = f"{path}>{label}" if path else label
                    roots |= bits
                if name not in VOID and not value.endswith("/>"):
                    self.open.append((name, path, away or gone, roots))
                    links += name == "a"
            else:
                for k in range(len(self.open) - 1, 0, -1):
                    if self.open[k][0] == name:
                        links -= sum(e[0] == "a" for e in self.open[k:])
                        del self.open[k:]
                        if name in BLOCK:
                            self.shape.append("/" + name)
                        break
        self.flush()

    def flush(self) -> None:
        if self.parts:
            said = BLANK.sub(" ", "".join(self.parts)).strip()
            if said:
                _, path, _, roots = self.open[-1]
                self.blocks.append((len(self.shape), path, roots, said, min(self.linked, len(said))))
                self.shape.append("#" + path)
            self.parts, self.linked = [], 0

    def end_implied(self, name: str) -> None:
        ends = CLOSES.get(name) or (CLOSES["p"] if name in BLOCK else ())
        for k in range(len(self.open) - 1, 0, -1) if ends else ():
            if self.open[k][0] in ends:
                del self.open[k:]
                return
            if self.open[k][0] in BLOCK:
                return


def digest(said: str) -> int:
    return int.from_bytes(blake2b(said.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


Item = str | list  # a label or slot, or a repeated group: the list of its items
Wrapper = list[tuple[Item, bool]]  # items in order, with whether every page has them


def folded(items: list[str]) -> tuple[list[Item], list[int]]:
    """The items with tandem repeats of up to ``PERIOD`` of them as repeated groups, and where each begins in ``items``."""
    out: list[Item] = []
    first: list[int] = []
    for at, item in enumerate(items):
        out.append(item)
        first.append(at)
        n = len(out)
        for period in range(1, min(PERIOD, n - 1) + 1):
            before = out[n - period - 1]
            if isinstance(before, list) and before == out[n - period :]:
                del out[n - period :], first[n - period :]
                break
            if before == item and 2 * period <= n and out[n - 2 * period : n - period] == out[n - period :]:
                out[n - 2 * period :] = [out[n - period :]]
                del first[n - 2 * period + 1 :]
                break
    return out, first


def aligned(a: Wrapper, b: Wrapper) -> Wrapper:
    """One wrapper for what either matches: items of both keep their need, a group stands for its unit, others are optional."""
    left, right = [json.dumps(x) for x, _ in a], [json.dumps(x) for x, _ in b]
    out: Wrapper = []
    for op, i, j, k, m in SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        if op == "equal":
            out += [(x, n and o) for (x, n), (_, o) in zip(a[i:j], b[k:m], strict=True)]
            continue
        one, two = a[i:j], b[k:m]
        for x, y in ((one, two), (two, one)):
            if len(x) == 1 and isinstance(x[0][0], list) and [item for item, _ in y] == x[0][0]:
                out.append((x[0][0], x[0][1] and all(need for _, need in y)))
                break
        else:
            out += [(x, False) for x, _ in (*one, *two)]
    return out


def expression(wrapper: Wrapper) -> str:
    """The wrapper as a union-free regular expression over labels and slots."""

    def said(item: Item) -> str:
        return item if isinstance(item, str) else "( " + " ".join(map(said, item)) + " )+"

    out: list[str] = []
    was = True
    for item, need in [*wrapper, ("", True)]:
        if was and not need:
            out.append("(")
        elif need and not was:
            out.append(")?")
        out.append(said(item))
        was = need
    return " ".join(out).strip()


def slots_in(item: Item) -> Iterator[str]:
    if isinstance(item, list):
        for x in item:
            yield from slots_in(x)
    elif item.startswith("#"):
        yield item


def matched(shape: list[Item], wrapper: Wrapper) -> list[int]:
    """For each item of a shape the place in the wrapper that it matches, -1 if none.

    Items that the alignment leaves over go to the nearest place that has their slots: that of the group they are a unit of.
    """
    places: dict[str, list[int]] = {}
    for k, (item, _) in enumerate(wrapper):
        for slot in slots_in(item):
            places.setdefault(slot, []).append(k)
    out = [-1] * len(shape)
    left, right = [json.dumps(x) for x in shape], [json.dumps(x) for x, _ in wrapper]
    for op, i, j, k, m in SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        for at in range(i, j):
            if op == "equal":
                out[at] = k + at - i
            else:
                near = [p for slot in slots_in(shape[at]) for p in places.get(slot, ())]
                out[at] = min(near, key=lambda p: (max(k - p, p - m + 1, 0), p), default=-1)
    return out


def host_of(url: str) -> Column:
    """Host in lower case; '' where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


#: Pages of a batch that are parsed at once.
SLICE = 256


def parse_pages(rows: DataFrame) -> DataFrame:
    """``rows`` (page_id, url, host, html) with shape, its digest, the digest of all texts, and blocks, without html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("item", pa.int32()), ("path", pa.string()), ("roots", pa.int32()), ("text", pa.string()), ("key", pa.int64()), ("links", pa.int32())]))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                shapes, wholes, blocks = [], [], []
                for source in part.column("html").to_pylist():
                    page = Page(source or "")
                    items, first = folded(page.shape)
                    shapes.append(json.dumps([(x, True) for x in items]))  # a wrapper: every item is needed
                    keys = [digest(b[3]) for b in page.blocks]
                    wholes.append(digest(repr(keys)))
                    blocks.append([{"item": bisect_right(first, b[0]) - 1, "path": b[1], "roots": b[2], "text": b[3], "key": key, "links": b[4]} for b, key in zip(page.blocks, keys, strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), part.column("host"), pa.array(shapes, pa.string()), pa.array(map(digest, shapes), pa.int64()), pa.array(wholes, pa.int64()), pa.array(blocks, kind)],
                    ["page_id", "url", "host", "shape", "shape_id", "whole", "blocks"],
                )

    block = T.StructType().add("item", T.IntegerType()).add("path", "string").add("roots", T.IntegerType()).add("text", "string").add("key", T.LongType()).add("links", T.IntegerType())
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"]]).add("host", "string").add("shape", "string").add("shape_id", T.LongType()).add("whole", T.LongType())
    return rows.mapInArrow(run, schema.add("blocks", T.ArrayType(block)))


def infer_wrappers(shapes: DataFrame) -> DataFrame:
    """(host, wrapper) of ``shapes`` (host, shape_id, shape), different ones of each host: the inferred expression as JSON.

    ``TOGETHER`` shapes or so are aligned in a task, then so many of the partial wrappers, until each host has one.
    """

    def merge(table: pa.Table) -> pa.Table:
        wrapper: Wrapper | None = None
        for said in sorted(set(table.column("wrapper").to_pylist())):
            next_one = [(x, n) for x, n in json.loads(said)]
            wrapper = next_one if wrapper is None else aligned(wrapper, next_one)
        return pa.table({"host": table.column("host").slice(0, 1), "id": table.column("id").slice(0, 1), "wrapper": pa.array([json.dumps(wrapper)])})

    most = shapes.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    parts = -(-most // TOGETHER)
    found = shapes.select("host", F.col("shape_id").alias("id"), F.col("shape").alias("wrapper"))
    while True:
        found = found.groupBy("host", F.pmod(F.xxhash64("id"), F.lit(max(parts, 1))).alias("part")).applyInArrow(merge, "host string, id long, wrapper string")
        if parts <= 1:
            return found.select("host", "wrapper")
        parts = -(-parts // TOGETHER)


def match_shapes(shapes: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, shape_id, places): the place in its host's wrapper of each item of each shape."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = lru_cache(maxsize=64)(json.loads)
        for batch in batches:
            found = [matched([x for x, _ in json.loads(s)], read(w)) for s, w in zip(batch.column("shape").to_pylist(), batch.column("wrapper").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("shape_id"), pa.array(found, pa.list_(pa.int32()))], ["host", "shape_id", "places"])

    return shapes.join(wrappers, "host").select("host", "shape_id", "shape", "wrapper").mapInArrow(run, "host string, shape_id long, places array<int>")


def slot_of(block: Column, places: Column) -> Column:
    return F.xxhash64(F.get(places, block["item"]), block["path"])


def text_of(block: Column) -> Column:
    """A text and the elements around it: a page without some part may have it at another place of the wrapper."""
    return F.xxhash64(block["path"], block["key"])


def judge_slots(placed: DataFrame) -> DataFrame:
    """(host, root, slots, texts): which of ``ROOTS`` holds the article, the slots that are template, and the constant texts of others.

    Counted over all different pages of a host, copies of a page once. A page holds a constant text at most
    1 / ``CONSTANT_SHARE`` times as often as there are such texts, and slots are as many as the wrapper has: lists stay short.
    """
    brief = F.transform("blocks", lambda b: F.struct(slot_of(b, F.col("places")).alias("slot"), text_of(b).alias("said"), b["roots"].alias("roots"), F.length(b["text"]).alias("size"), b["links"].alias("links")))
    different = cut(placed.select("host", "whole", brief.alias("blocks")).groupBy("host", "whole").agg(F.first("blocks").alias("blocks")))
    pages = different.groupBy("host").agg(F.count("*").alias("pages"))
    blocks = different.select("host", F.explode("blocks").alias("b")).select("host", "b.*")
    # once a page, though it may hold a text several times
    once = different.select("host", F.explode(F.array_distinct("blocks.said")).alias("said"))
    sums = blocks.groupBy("host", "slot", "said").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.sum("links").alias("links"), F.first("roots").alias("roots"))
    texts = sums.join(once.groupBy("host", "said").agg(F.count("*").alias("on")), ["host", "said"]).join(pages, "host")
    constant = (F.col("on") >= CONSTANT_PAGES) & (F.col("on") >= F.col("pages") * CONSTANT_SHARE)
    slots = cut(
        texts.withColumn("constant", constant).groupBy("host", "slot").agg(
            F.first("roots").alias("roots"), F.sum("n").alias("n"), F.sum(F.when(F.col("constant"), F.col("n")).otherwise(0)).alias("fixed"),
            F.sum(F.when(F.col("constant"), 0).otherwise(F.col("size"))).alias("varying"), F.sum("size").alias("size"), F.sum("links").alias("links"),
            F.collect_list(F.when(F.col("constant"), F.col("said"))).alias("texts"),
        )
    )
    template = F.col("fixed") >= F.col("n") * CONSTANT_SHARE
    mass = [F.sum(F.when(~template & (F.col("roots").bitwiseAND(1 << r) != 0), F.col("varying")).otherwise(0)) for r in ROOTS]
    masses = slots.groupBy("host").agg(F.array(*mass).alias("mass"))
    root = F.coalesce(*(F.when((F.col("mass")[r] > 0) & (F.col("mass")[r] >= ROOT_SHARE * F.col("mass")[3]), F.lit(r)) for r in ROOTS), F.lit(3))
    of_links = (F.col("root") == 3) & (F.col("n") >= CONSTANT_PAGES) & (F.col("links") >= LINK_SHARE * F.col("size"))
    out = cut(
        slots.join(masses.select("host", root.alias("root")), "host").groupBy("host").agg(
            F.first("root").alias("root"), F.collect_list(F.when(template | of_links, F.col("slot"))).alias("slots"), F.array_distinct(F.flatten(F.collect_list("texts"))).alias("texts"),
        )
    )
    drop(different, slots)
    return out


def joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A left join; ``right``, short rows, is broadcast while it has few of them, and shuffled otherwise."""
    small = right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return left.join(F.broadcast(right) if small else right, keys, "left")


def extract_text(pages: DataFrame, url: str = "url", source: str = "html", row_id: str = "page_id") -> DataFrame:
    """(page_id, url, text): the main text of every page by its host's wrapper.

    A page that has no text where its host has its articles is judged by the elements of its own. Blocks are joined by a
    newline, white space in them by one space. A null or empty page, or one of template only, has an empty text; repeated
    rows are extracted each; pages without a url share the host ''; an empty table gives none.
    """
    rows = pages.select(F.col(row_id).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"), host_of(url).alias("host"))
    parsed = cut(parse_pages(rows))
    shapes = cut(parsed.groupBy("host", "shape_id").agg(F.first("shape").alias("shape")))
    wrappers = cut(infer_wrappers(shapes))
    places = cut(match_shapes(shapes, wrappers))
    placed = joined(parsed, places, ["host", "shape_id"]).select("page_id", "url", "host", "whole", "blocks", "places")
    judged = joined(placed, judge_slots(placed), ["host"])
    drop(shapes, wrappers)

    slot = lambda b: slot_of(b, F.col("places"))
    free = F.filter("blocks", lambda b: ~F.array_contains(F.coalesce("slots", F.array().cast("array<long>")), slot(b)) & ~F.array_contains(F.coalesce("texts", F.array().cast("array<long>")), text_of(b)))
    under = lambda bit: F.filter("free", lambda b: b["roots"].bitwiseAND(bit) != 0)
    said = lambda bit: F.array_join(F.transform(under(bit), lambda b: b["text"]), "\n")
    holds = lambda bit: F.exists("blocks", lambda b: b["roots"].bitwiseAND(bit) != 0)
    by_host = F.coalesce(*(F.when(F.col("root") == r, said(1 << r)) for r in ROOTS))
    own = F.coalesce(*(F.when(holds(1 << r), said(1 << r)) for r in ROOTS), F.lit(""))
    return judged.withColumn("free", free).select("page_id", "url", F.coalesce(F.nullif(by_host, F.lit("")), own).alias("text"))
