"""Main text of web pages by union-free wrappers per host.

A page becomes a stream of block tags and text slots (inline tags belong to the text around them). Repeats in a stream
fold into repeated groups; the folded streams of a host are aligned one after the other, and a mismatch becomes an
optional group or widens a repeated one. The result is a regular expression without unions, the wrapper of the host,
which accepts every page it was inferred from. Text is taken from the wrapper's slots that lie in the article.

A text that stays the same over the pages of a host is template: a symbol of the wrapper, no slot. Texts are counted per
host by their hash and the blocks around them before streams are made. Words of class, id or role mark what is not the
article, too; on a host with several pages they give way where a page has no other text in its article. A page of which less
than a quarter varies is taken for another edition of its neighbours' article, not for an article in their template, and
keeps all of it.

Pages are parsed once, into a stored table of symbols, texts and their keys. Streams are folded and counted before anything moves, so a host's group holds its distinct streams only; a host with
many of them is reduced in portions, since wrappers align with each other just as streams do. What would outgrow
``MAX_SYMBOLS`` stays apart, as a further wrapper of the host.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relfeat.llm.common import slices, small_batches, stored
from relfeat.llm.url_filter import host_and_path

# fixed values: elements that are not blocks of their own
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea iframe svg math canvas object select title".split())
DROPPED = set("head nav header footer aside form button menu dialog fieldset".split()) | RAW
# words of class, id or role that mark what is not the article
DROPPED_WORDS = set(
    "ad ads advert advertisement adverts banner sponsor sponsored promo promotion sidebar nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer contentinfo complementary cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup share sharing social comment comments reply replies "
    "respond disqus related recommended widget toolbar pagination pager search login form skip".split()
)
CLOSES_P = set(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul li".split()
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
LABELS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
REPEAT = re.compile(r"(.{1,64}?)\1+", re.S)
# names of several words mark it only if the other words say where or what it is in the page
PLACING_WORDS = set(
    "area article articles bar block body bottom box btn button buttons card cards col column container content entry field "
    "global group inline inner item items js left link links list main middle more outer page panel post posts primary reader "
    "readers right row secondary section site slot sticky stories story text thread title top unit user users wrap wrapper".split()
)
# streams are merged into wrappers of at most so many symbols: a host that needs more has several wrappers, and each page is
# matched with the one that its own stream went into
MAX_SYMBOLS = 4000
# a page keeps its article whole unless one part in so many of its text varies
VARYING = 4
# per-host tables are broadcast up to so many bytes of content
BROADCAST_BYTES = 32 << 20
PORTION = 64
SLOT, OTHER, MARKED = "#article", "#other", "#marked"
BY_WORD, BY_ELEMENT = 1, 2


def label_words(attributes: str) -> tuple[set[str], bool]:
    """Words of the classes, id and role of an element, and whether one of these names marks what is not the article."""
    words: set[str] = set()
    marked = False
    for name in " ".join("".join(g) for g in LABELS.findall(attributes)).lower().split():
        parts = set(re.findall("[a-z]+", name))
        words |= parts
        marked |= bool(parts & DROPPED_WORDS) and parts <= DROPPED_WORDS | PLACING_WORDS
    return words, marked


def blocks(page: str) -> tuple[list[str], list[str]]:
    """The token stream of a page: symbols, and the text of each (empty for tags).

    A text slot is ``#article`` inside an article element (without one: inside main, else in the body), outside of
    everything that is dropped by its element or by a word in its class, id or role; otherwise ``#other``.
    """
    symbols, texts, _ = slots(page)
    return [OTHER if s == MARKED else s for s in symbols], texts


def slots(page: str) -> tuple[list[str], list[str], list[str]]:
    """As ``blocks``, with ``#marked`` for what only a word drops from the article, and the open blocks of each slot."""
    symbols, texts, where, paths = [], [], [], []
    stack: list[tuple[str, int, str]] = []  # element, dropped from here on, container
    pending, at, raw = [], 0, None

    def flush() -> None:
        text = " ".join("".join(pending).split())
        pending.clear()
        if text:
            dropped = stack[-1][1] if stack else 0
            symbols.append(("#", MARKED, OTHER)[dropped])
            texts.append(text)
            where.append(stack[-1][2] if stack else "body")
            paths.append(" ".join(s[0] for s in stack))

    def close(name: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                flush()
                for element, _, _ in stack[i:][::-1]:
                    symbols.append("/" + element)
                    texts.append("")
                    where.append("")
                    paths.append("")
                del stack[i:]
                return

    for m in TOKEN.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            pending.append(html.unescape(page[at : m.start()]))
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name not in INLINE or any(s[0] == name for s in stack):
                close(name)
            continue
        if name in VOID:
            pending.append(" " if name in ("br", "hr") else "")
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            pending.append(" " if name not in ("svg", "math", "canvas") else "")
            continue
        words, marked = label_words(m[3]) if m[3] else (set(), False)
        within = stack[-1] if stack else ("", 0, "body")
        own = name in ("html", "body", "main") or name == "article" and within[2] != "article"
        drop = BY_ELEMENT if name in DROPPED else BY_WORD if marked and not own else 0
        if name in INLINE and not drop:
            continue
        flush()
        if name in CLOSES_P and stack and stack[-1][0] == "p":
            close("p")
        if name == "li" and stack and stack[-1][0] == "li":
            close("li")
        within = stack[-1] if stack else ("", 0, "body")
        container = "article" if name == "article" or within[2] == "article" else "main" if name == "main" or "main" in words else within[2]
        stack.append((name, max(within[1], drop), container))
        symbols.append(name)
        texts.append("")
        where.append("")
        paths.append("")
    if at < len(page):
        pending.append(html.unescape(page[at:]))
    flush()
    kept = {w for s, w in zip(symbols, where) if s == "#"} or {w for s, w in zip(symbols, where) if s == MARKED}
    best = next((c for c in ("article", "main", "body") if c in kept), "")
    names = {"#": SLOT, MARKED: MARKED}
    return [s if s not in names else names[s] if w == best else OTHER for s, w in zip(symbols, where)], texts, paths


def text_key(path: str, text: str) -> int:
    digest = hashlib.blake2b(f"{path}\0{text}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True) or 1


def stream(symbols: list[str], keys: list[int], sizes: list[int], template: set[int] | None) -> tuple[list[str], list[int]]:
    """The token stream of a parsed page on a host whose template texts have these keys (None: too few pages to tell), and
    the numbers of the texts in its article slots. ``keys`` and ``sizes`` are those of its article and marked texts.

    Template texts are symbols of their own. Marked slots that vary are the article's when nothing else is in it. A page
    of which too little varies keeps its article: its host holds copies or editions of it.
    """
    taken = SLOT if template is None or SLOT in symbols else MARKED
    which = [s for s in symbols if s in (SLOT, MARKED)]
    if template is not None:
        own = [(k, n) for s, k, n in zip(which, keys, sizes) if s == taken]
        varying = sum(n for k, n in own if k not in template)
        if not varying or taken == SLOT and VARYING * varying < sum(n for _, n in own):
            template, taken = None, SLOT
    found = template or set()
    slot = [f"={k & (1 << 64) - 1:x}" if k in found else SLOT if s == taken else OTHER for s, k in zip(which, keys)]
    rest = iter(slot)
    return [next(rest) if s in (SLOT, MARKED) else s for s in symbols], [i for i, s in enumerate(slot) if s == SLOT]


def own_text(symbols: list[str], texts: list[str]) -> str:
    return " ".join(t for s, t in zip(symbols, texts) if s == SLOT)


# A wrapper is a sequence of nodes: a symbol, or ("+", nodes) for a repeated and ("?", nodes) for an optional group.


def fold(symbols: list[str]) -> tuple:
    """Fold adjacent repeats, inner ones first, until none is left."""
    nodes: dict[str, object] = {}
    names: dict[object, str] = {}

    def char(node: object) -> str:
        if node not in names:
            names[node] = chr(0xF0000 + len(names))
            nodes[names[node]] = node
        return names[node]

    line = "".join(map(char, symbols))
    while True:
        folded = REPEAT.sub(lambda m: char(("+", tuple(nodes[c] for c in m[1])) if len(m[1]) > 1 or nodes[m[1]][0] != "+" else nodes[m[1]]), line)
        if folded == line:
            return tuple(nodes[c] for c in line)
        line = folded


def align(a: tuple, b: tuple) -> tuple:
    """The smallest union-free wrapper this finds that accepts what either accepts."""
    a, b = widened(a, b), widened(b, a)
    out: list = []
    for kind, i, j, k, m in SequenceMatcher(None, [key(x) for x in a], [key(x) for x in b], autojunk=False).get_opcodes():
        if kind == "equal":
            out += [merged(x, y) for x, y in zip(a[i:j], b[k:m])]
        else:
            for part in (a[i:j], b[k:m]):
                if part:
                    out.append(part[0] if len(part) == 1 and part[0][0] == "?" else ("?", part))
    return tuple(out)


def key(node) -> object:
    """Nodes that can be merged have the same key: an optional group and what it holds, for one."""
    while isinstance(node, tuple) and node[0] == "?" and len(node[1]) == 1:
        node = node[1][0]
    return node


def merged(x, y):
    if x == y:
        return x
    return x if isinstance(x, tuple) and x[0] == "?" else y


def widened(a: tuple, b: tuple) -> tuple:
    """Where ``b`` repeats a group that ``a`` has once, ``a`` gets the repeated group."""
    for group in (x for x in b if isinstance(x, tuple) and x[0] == "+"):
        unit, out, i = group[1], [], 0
        while i < len(a):
            if a[i : i + len(unit)] == unit:
                out.append(group)
                i += len(unit)
            else:
                out.append(a[i])
                i += 1
        a = tuple(out)
    return a


def size(nodes: tuple) -> int:
    return sum(1 if isinstance(x, str) else size(x[1]) for x in nodes)


def written(nodes: tuple) -> str:
    return " ".join(x if isinstance(x, str) else f"( {written(x[1])} ){x[0]}" for x in nodes)


def parsed(text: str) -> tuple:
    levels: list[list] = [[]]
    for word in text.split():
        if word == "(":
            levels.append([])
        elif word in (")+", ")?"):
            group = (word[1], tuple(levels.pop()))
            levels[-1].append(group)
        else:
            levels[-1].append(word)
    return tuple(levels[0])


class Wrapper:
    """Accepts token streams; each symbol of the wrapper is one character of a pattern, matched in linear time (RE2)."""

    def __init__(self, text: str):
        self.chars: dict[str, str] = {}
        self.written = text
        # one stream that is larger by itself is compared as it is, not matched
        self.pattern = None if size(nodes := parsed(text)) > MAX_SYMBOLS else f"^(?:{self.compiled(nodes)})$"
        self.seen: dict[str, bool] = {}

    def compiled(self, nodes: tuple) -> str:
        out = []
        for x in nodes:
            if isinstance(x, tuple):
                out.append(f"(?:{self.compiled(x[1])}){x[0]}")
            else:
                out.append(self.chars.setdefault(x, chr(0xF0000 + len(self.chars))))
        return "".join(out)

    def accepts(self, symbols: list[str]) -> bool:
        if self.pattern is None:
            return written(fold(symbols)) == self.written
        line = "".join(self.chars.get(s, "\ue000") for s in symbols)
        if line not in self.seen:
            if len(self.seen) > 1_000:
                self.seen.clear()
            self.seen[line] = pc.match_substring_regex(pa.array([line]), self.pattern)[0].as_py()
        return self.seen[line]

    def text(self, symbols: list[str], texts: list[str]) -> str | None:
        """Text of the article slots in page order; None when the page does not fit."""
        return own_text(symbols, texts) if self.accepts(symbols) else None


PARSED = "page_id LONG, url STRING, host STRING, page LONG, symbols STRING, texts ARRAY<STRING>, keys ARRAY<LONG>"


def parsed_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's key, symbols (separated by spaces), and the texts of its article and marked slots with their keys."""
    for batch in slices(batches, "html"):
        names, streams, texts, keys = [], [], [], []
        for page in batch.column("html").to_pylist():
            symbols, found, paths = slots(page)
            kept = [(t, text_key(p, t)) for s, t, p in zip(symbols, found, paths) if s in (SLOT, MARKED)]
            names.append(text_key("", page))
            streams.append(" ".join(symbols))
            texts.append([t for t, _ in kept])
            keys.append([k for _, k in kept])
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("page_id", "url", "host")), pa.array(names, pa.int64()), pa.array(streams, pa.string()),
                pa.array(texts, pa.list_(pa.string())), pa.array(keys, pa.list_(pa.int64())),
            ],
            ["page_id", "url", "host", "page", "symbols", "texts", "keys"],
        )


def host_templates(pages: DataFrame) -> DataFrame:
    """``host, template`` from parsed pages, for hosts with two different pages or more: keys of the texts that more
    than half of the host's different pages have, and three of them at least (both, where there are two)."""
    one = F.array_union(F.array(F.lit(0).cast("long")), F.col("keys"))  # 0: the page itself
    keys = pages.where("size(keys) > 0").select("host", "page", F.explode(one).alias("key")).distinct()
    counts = stored(keys.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "text-counts")
    hosts = counts.where("key = 0").select("host", F.col("n").alias("pages"))
    constant = counts.where("key <> 0").join(hosts, "host").where("2 * n > pages AND n >= least(pages, 3)")
    constant = constant.groupBy("host").agg(F.collect_list("key").alias("template"))
    empty = F.array().cast("array<bigint>")
    return stored(hosts.join(constant, "host", "left").select("host", F.coalesce("template", empty).alias("template")), "templates")


def light(df: DataFrame, size: Column) -> DataFrame:
    """Mark a stored per-host table for broadcast when its content is within ``BROADCAST_BYTES``."""
    total = df.agg(F.sum(F.octet_length("host") + size + 16)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


_templates: dict[tuple, set[int]] = {}


def template_of(keys: list[int] | None) -> set[int] | None:
    if keys is None:
        return None
    if len(_templates) > 10_000:
        _templates.clear()
    return _templates.setdefault(tuple(keys), set(keys))


_folded: dict[tuple, tuple[str, int]] = {}


def folded(symbols: list[str]) -> tuple[str, int]:
    """The folded stream as text, and its name."""
    found = _folded.get(line := tuple(symbols))
    if found is None:
        if len(_folded) > 50_000:
            _folded.clear()
        text = written(fold(symbols))
        found = _folded[line] = text, text_key("", text)
    return found


def stream_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct folded streams of each host in this task."""
    seen: dict[tuple[str, int], str] = {}
    for batch in batches:
        for host, line, keys, sizes, template in zip(*(batch.column(c) for c in ("host", "symbols", "keys", "sizes", "template"))):
            text, name = folded(stream(line.as_py().split(), keys.as_py(), sizes.as_py(), template_of(template.as_py()))[0])
            seen[host.as_py(), name] = text
        if len(seen) > 50_000:
            yield stream_batch(seen)
            seen = {}
    yield stream_batch(seen)


def stream_batch(seen: dict[tuple[str, int], str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([h for h, _ in seen], pa.string()), pa.array([n for _, n in seen], pa.int64()), pa.array(list(seen.values()), pa.string())],
        ["host", "name", "wrapper"],
    )


def inferred(group: pd.DataFrame) -> pd.DataFrame:
    """Align the streams or wrappers of one portion of a host, the shortest first, a new wrapper whenever the last would
    outgrow ``MAX_SYMBOLS``. One row per stream or wrapper: ``name``, the one it went ``into`` (named by its first member),
    and in the row of this member the wrapper. ``last``: the portion is the whole host, or half of its rows are wrappers still."""
    order = sorted(zip(group["wrapper"], group["name"]), key=lambda w: (len(w[0]), *w))
    found: list[tuple] = []
    into: list[int] = []
    for text, name in order:
        nodes = parsed(text)
        both = align(found[-1], nodes) if found and size(nodes) <= MAX_SYMBOLS and size(found[-1]) <= MAX_SYMBOLS else None
        if both is None or size(both) > MAX_SYMBOLS:
            found.append(nodes)
            first = name
        else:
            found[-1] = both
        into.append(first)
    wrappers = dict(zip(dict.fromkeys(into), found))
    return pd.DataFrame({
        "host": group["host"].iloc[0], "name": [n for _, n in order], "into": into,
        "wrapper": [written(wrappers[k]) if k == n else None for (_, n), k in zip(order, into)],
        "last": bool(group["whole"].iloc[0]) or 2 * len(found) > len(order),
    })


def host_wrappers(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``host, name, into`` and ``host, into, wrapper`` from parsed pages with ``template``: the wrapper that each stream of a
    host went into. Streams are reduced in portions, until a host is one portion or its wrappers are too large to merge."""
    pages = pages.select("host", "symbols", "keys", F.transform("texts", F.length).alias("sizes"), "template")
    rows = stored(pages.mapInArrow(stream_texts, "host STRING, name LONG, wrapper STRING").distinct(), "streams")
    went = wrappers = None
    while True:
        many = stored(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "stream-counts")
        most = many.agg(F.max("n")).first()[0] or 0
        portion = F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("n") / PORTION)).alias("portion")
        parts = rows.join(many, "host").select("host", "name", "wrapper", portion, (F.col("n") <= PORTION).alias("whole"))
        done = parts.groupBy("host", "portion").applyInPandas(inferred, "host STRING, name LONG, into LONG, wrapper STRING, last BOOLEAN")
        done = stored(done, "wrappers")
        kept = done.where("last AND wrapper IS NOT NULL").select("host", "into", "wrapper")
        wrappers = kept if wrappers is None else wrappers.unionByName(kept)
        step = done.select("host", "name", "into")
        if went is None:
            went = step
        else:
            step = step.select("host", F.col("name").alias("into"), F.col("into").alias("next"))
            went = stored(went.join(step, ["host", "into"], "left").select("host", "name", F.coalesce("next", "into").alias("into")), "went-into")
        if most <= PORTION:
            return went, wrappers
        rows = done.where("NOT last AND wrapper IS NOT NULL").select("host", F.col("into").alias("name"), "wrapper")


_wrappers: dict[str, Wrapper] = {}


def wrapper_of(text: str) -> Wrapper:
    if text not in _wrappers:
        if len(_wrappers) > 10_000:
            _wrappers.clear()
        _wrappers[text] = Wrapper(text)
    return _wrappers[text]


TEXTS = "page_id LONG, url STRING, text STRING, n_chars LONG"


def main_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's article, its token stream and the name of that."""
    for batch in batches:
        out, lines, names = [], [], []
        for line, texts, keys, template in zip(*(batch.column(c) for c in ("symbols", "texts", "keys", "template"))):
            texts = texts.as_py()
            symbols, taken = stream(line.as_py().split(), keys.as_py(), [len(t) for t in texts], template_of(template.as_py()))
            out.append(" ".join(texts[i] for i in taken))
            lines.append(" ".join(symbols))
            names.append(folded(symbols)[1])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64()),
                batch.column("host"), pa.array(lines, pa.string()), pa.array(names, pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars", "host", "line", "name"],
        )


def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("wrapper").to_pylist(), batch.column("line").to_pylist())
        fits = [w is not None and wrapper_of(w).accepts(line.split()) for w, line in pairs]
        kept = ["page_id", "url", "text", "n_chars"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(fits, pa.bool_())], [*kept, "fits"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars, fits (whether the wrapper of the page's host matched it;
    of several, the one that its own stream went into).

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one space in
    page order. NULL html is empty and has the empty text; a NULL url belongs to the empty host. A page that the wrapper
    does not match gives the text of its own article slots, those of its host's template left out as well.
    """
    small_batches(pages.sparkSession, 256)
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), url.alias("url"), host_and_path(url)[0].alias("host"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
    )
    pages = stored(rows.mapInArrow(parsed_pages, PARSED), "parsed-pages", "zstd")
    templates = light(host_templates(pages), 8 * F.size("template"))
    pages = pages.join(templates, "host", "left")
    went, wrappers = host_wrappers(pages)
    went, wrappers = light(went, F.lit(16)), light(wrappers, F.octet_length("wrapper"))
    texts = pages.select("page_id", "url", "host", "symbols", "texts", "keys", "template").mapInArrow(main_texts, f"{TEXTS}, host STRING, line STRING, name LONG")
    matched = texts.join(went, ["host", "name"], "left").join(wrappers, ["host", "into"], "left")
    return matched.select("page_id", "url", "text", "n_chars", "line", "wrapper").mapInArrow(fitted, f"{TEXTS}, fits BOOLEAN")
