"""Main text of web pages, with boilerplate found by a host's suffix array.

A tolerant scan cuts a page into blocks and tells three kinds apart: chrome (inside elements that never hold
an article, or marked so by class, id or role), content (inside article or main) and open blocks. A name marks
an element by a whole class (``site-footer``, not ``no-sidebar`` or ``header-fixed``), and an article or main inside
an element so marked is content all the same, but for reader comments; a form outside the content marks nothing, nor
does an element that the page never closes. Chrome is left out and content is kept. What is left undecided are the open blocks, and for these the host decides:

The token streams of all blocks outside the content of a host's pages stand one behind the other, across the
borders of blocks, and their suffixes are sorted as far as ``LEAST`` tokens. Spark does so by grouping on (host, hash of the first ``LEAST``
tokens): neighbours of such a suffix array share a long substring exactly if they fall into one group. Pages of a
host with equal tokens are one page, whatever their urls. Where a group has ``PAGES`` pages and a share of the host's,
its tokens are covered; overlapping marks add up to the maximal repeated substrings. A run inside an open block
is removed if each mark has a half of the pages (``PART``); a block covered as a whole, also by runs that begin or end in its neighbours,
goes with a tenth (``WHOLE``). A block shorter than ``LEAST`` tokens goes too if a half of the pages have a block like it. What
fewer pages share, a phrase or a quotation, stays. A group is only summed up (number of pages, smallest and
largest row), so a host with a third of all pages, or a notice on each of them, is never gathered in one place.
"""

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfade.llm.tables import materialize, small_side
from crossfade.llm.words import hash_text, mix, shingles

_BLOCK_MARK = np.uint64(0xA24BAED4963EE407)  # tells a short block's hash from a short page's
_PAGE = np.iinfo(np.int32).min  # the place in a row that stands for a page

LEAST = 6  # tokens of a repeated substring
PAGES = 3  # distinct pages of a host, at least, that it stands on
PART, WHOLE = 2, 10  # one of so many of the host's pages, at least, to cut from a block or drop a block

# Elements of HTML by what they are for.
CHROME = frozenset(
    "head script style noscript template nav aside footer form button select option datalist fieldset label input textarea "
    "iframe object embed svg canvas audio video map menu dialog title".split()
)
CONTENT = frozenset("article main".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner billboard nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs pagination pager sidebar sidebars aside rail widget widgets footer header masthead toolbar "
    "cookie cookies consent gdpr notice notices notification alert disclaimer popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social comment comments commentlist disqus reply replies respond related recommended search searchform "
    "contentinfo complementary skip".split()
)

# Articles in elements so named, or so named themselves, are what readers wrote.
COMMENT_NAMES = frozenset("comment comments commentlist disqus reply replies respond".split())

# Elements whose end tag may be left out, the elements that end them, and those they don't reach out of.
ENDED_BY = {
    "p": frozenset(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
        "header hgroup hr main menu nav ol p pre search section table ul li dd dt td th tr".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option", "optgroup"]),
    "optgroup": frozenset(["optgroup"]),
    "td": frozenset("td th tr tbody tfoot thead".split()),
    "th": frozenset("td th tr tbody tfoot thead".split()),
    "tr": frozenset("tr tbody tfoot thead".split()),
    "thead": frozenset(["tbody", "tfoot"]),
    "tbody": frozenset(["tbody", "tfoot"]),
    "head": frozenset("body article main header nav div p h1 section".split()),
}
HOLDERS = frozenset(
    "article aside blockquote body button caption datalist details dialog div dl fieldset figure footer form header main menu nav ol section "
    "select table ul".split()
)
ENDERS = frozenset().union(*ENDED_BY.values())

# A class like share-buttons names a part of what its first words say; no-sidebar or with-sidebar names what is around it.
PARTS = frozenset("area bar block box button buttons form icons item items link links list slot unit".split())
AROUND = frozenset("no not non with without has have hide hides hidden is show shows".split())

# A quote opens a value only after an equals sign.
_TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*)(?:>|\Z))",
    re.DOTALL,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*(?:\"[^\"]*|'[^']*)display\s*:\s*none)", re.IGNORECASE)


def _chrome_name(name: str) -> str | None:
    """The word by which one class, id or role says chrome: its last one, or the one before those for parts."""
    words = _WORD.findall(name)
    while len(words) > 1 and words[-1] in PARTS and words[-1] not in CHROME_NAMES:
        words.pop()
    if not words or words[-1] not in CHROME_NAMES or not AROUND.isdisjoint(words[:-1]):
        return None
    return words[-1]


def _chrome_names(attributes: str) -> set[str]:
    """The words by which an element's class, id and role say chrome."""
    found = (_chrome_name(x) for match in _NAMES.finditer(attributes) for x in (match[1] or match[2] or match[3] or "").lower().split())
    return {x for x in found if x}


def _inside(name: str, attributes: str, kind: str) -> str:
    """The kind of text inside this element, which stands in text of the given kind. ``named`` is chrome by a name
    outside the content, which an article or main ends."""
    if kind == "chrome":
        return kind
    if name in CONTENT:
        return "content" if COMMENT_NAMES.isdisjoint(_chrome_names(attributes)) else "chrome"
    inside_content = kind == "content"
    if name in CHROME and (name != "form" or inside_content) or (name == "header" and not inside_content):
        return "chrome"
    if not attributes or name in ("html", "body"):
        return kind
    if _HIDDEN.search(attributes):
        return "chrome"
    said = _chrome_names(attributes)
    if inside_content:
        said.discard("header")
    if not said:
        return kind
    return "chrome" if inside_content or not COMMENT_NAMES.isdisjoint(said) else "named"


def scan(page: str) -> list[tuple[str, str]]:
    """(kind, text) of the non-empty blocks in order; kind is chrome, content or open."""
    blocks: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []  # open elements and the kind of text inside
    words: list[str] = []
    kind, at = "open", 0
    lowered = b""  # as bytes only A-Z are lower-cased, and at once
    last_end: dict[str, int] = {}  # where the last end tag of a name begins

    def closed(name: str) -> bool:
        """Whether the page has an end tag of this name from here on."""
        nonlocal lowered
        if name not in last_end:
            lowered = lowered or page.encode("utf-8", "surrogatepass").lower()
            found = lowered.rfind(f"</{name}".encode("utf-8", "surrogatepass"))
            last_end[name] = found if found < 0 else len(lowered[:found].decode("utf-8", "surrogatepass"))
        return last_end[name] >= at

    def end_of(depth: int) -> None:
        """The element at this depth, and all in it, end here."""
        nonlocal kind
        outer = stack[depth - 1][1] if depth else "open"
        if outer != kind:
            flush()
        del stack[depth:]
        kind = outer

    def flush() -> None:
        if not words:
            return
        text = " ".join("".join(words).split())
        if text:
            blocks.append(("chrome" if kind == "named" else kind, text))
        words.clear()

    while True:
        match = _TAG.search(page, at)
        if match is None:
            words.append(html.unescape(page[at:]))
            break
        if match.start() > at:
            words.append(html.unescape(page[at : match.start()]))
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        if name in BLOCK:
            flush()
        if match[1]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    end_of(depth)
                    break
            continue
        if name == "br":
            words.append(" ")
        if name in ENDERS:  # walks out to the next element that holds others, as far as open ones end
            for depth in range(len(stack) - 1, -1, -1):
                if name in ENDED_BY.get(stack[depth][0], ()):
                    end_of(depth)
                elif stack[depth][0] in HOLDERS:
                    break
        if name in VOID or match[3].endswith("/") and name not in BLOCK and name not in RAW:
            continue
        inside = _inside(name, match[3], kind)
        if inside == "chrome" != kind and name not in RAW and name not in ENDED_BY and not closed(name):
            inside = kind
        if inside != kind:
            flush()
        stack.append((name, inside))
        kind = inside
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            if name in ("title", "textarea"):
                words.append(html.unescape(page[at : end.start() if end else len(page)]))
            at = end.start() if end else len(page)
    flush()
    return blocks


def host_of(url: str = "url"):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; empty if there is none."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rows(pages: DataFrame) -> DataFrame:
    key = F.xxhash64(F.col("page_id").cast("long"), "url", "html")
    return pages.select(key.alias("key"), F.col("page_id").cast("long").alias("page_id"), "url", "html")


def parse(pages: DataFrame) -> DataFrame:
    """(key, page_id, url, text, blocks): ``text`` joins the content blocks, and is null where the host decides;
    ``blocks`` are then the content and open blocks, each with the place of its first token (content: -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, opens = [], []
            for page in batch.column(3).to_pylist():
                blocks = scan(page or "")
                decided = all(kind != "open" for kind, _ in blocks)
                free, at = [], 0
                for kind, text in [] if decided else blocks:
                    if kind == "content":
                        free.append({"at": -1, "text": text})
                        continue
                    if kind == "open":
                        free.append({"at": at, "text": text})
                    at += len(_TOKEN.findall(text))
                texts.append("\n".join(text for kind, text in blocks if kind == "content") if decided else None)
                opens.append(free)
            kind = pa.list_(pa.struct({"at": pa.int32(), "text": pa.string()}))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(texts, pa.string()), pa.array(opens, kind)], ["key", "page_id", "url", "text", "blocks"]
            )

    schema = "key long, page_id long, url string, text string, blocks array<struct<at: int, text: string>>"
    return _rows(pages).mapInArrow(run, schema)


def suffixes(pages: DataFrame) -> DataFrame:
    """(start, key, at, page, host): a row for each place outside the content that LEAST tokens follow: their hash with
    the host's, the row's key, the place among the tokens outside the content (-1: all of them are chrome), and the
    hashes of all tokens of the page and of its host. A page with fewer tokens has a row for all of them, an open
    block with fewer a row at -2 less its place. One row more per page has no start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, places, counts, whole = [], [], [], []
            hosts = batch.column(2).to_numpy()
            for page, host in zip(batch.column(1).to_pylist(), hosts, strict=True):
                blocks, salt = scan(page or ""), mix(host.view(np.uint64))
                every = " ".join(text for _, text in blocks).lower()
                whole.append(int.from_bytes(hashlib.blake2b(every.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True))
                outside = [(kind == "open", text) for kind, text in blocks if kind != "content"]
                stream = hash_text(" ".join(text for _, text in outside))
                sizes = np.array([text.count(" ") + 1 for _, text in outside], np.int64)
                is_open, ends = np.array([x for x, _ in outside], bool), np.cumsum(sizes)
                opened = np.concatenate([[0], np.cumsum(np.repeat(is_open, sizes))])
                value, _ = shingles(stream, np.array([0, len(stream)]), LEAST)
                at = np.arange(len(value))
                touches = opened[np.minimum(at + LEAST, len(stream))] > opened[at]
                found, place = [value], [np.where(touches, at, -1)]
                for i in np.flatnonzero(is_open & (sizes < LEAST)):
                    short, _ = shingles(stream[ends[i] - sizes[i] : ends[i]], np.array([0, sizes[i]]), LEAST)
                    found.append(mix(short ^ _BLOCK_MARK))
                    place.append(np.array([sizes[i] - ends[i] - 2]))
                starts += [mix(np.concatenate(found) ^ salt), np.zeros(1, np.uint64)]
                places += [*place, np.array([_PAGE])]
                counts.append(sum(map(len, found)) + 1)
            starts = np.concatenate([np.zeros(0, np.uint64), *starts]).view(np.int64)
            places = np.concatenate([np.zeros(0, np.int64), *places]).astype(np.int32)
            again = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield pa.record_batch(
                {
                    "start": pa.array(starts, pa.int64(), mask=places == _PAGE),
                    "key": batch.column(0).take(again),
                    "page": pa.array(whole, pa.int64()).take(again),
                    "host": batch.column(2).take(again),
                    "at": pa.array(places, pa.int32()),
                }
            )

    rows = _rows(pages).select("key", "html", F.xxhash64(host_of()).alias("host"))
    return rows.mapInArrow(run, "start long, key long, page long, host long, at int")


def repeated(pages: DataFrame) -> DataFrame:
    """(key, at, level) of the suffixes that stand in another row of the host too. The level is 2 if a half of the
    host's distinct pages have it, 1 if a tenth, else 0."""
    rows = materialize(suffixes(pages))
    sizes = rows.where("start is null").select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    groups = rows.where("start is not null").groupBy("start", "page").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.first("host").alias("host")
    )
    groups = groups.groupBy("start").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("n"), F.first("host").alias("host"))
    groups = groups.where("low <> high").join(small_side(materialize(sizes)), "host")
    enough = F.col("n") >= PAGES
    level = F.when(enough & (F.col("n") * PART >= F.col("pages")), 2).when(enough & (F.col("n") * WHOLE >= F.col("pages")), 1).otherwise(0)
    return rows.join(groups.select("start", level.alias("level")), "start").select("key", "at", "level")


def _left(at: int, text: str, level: np.ndarray, short: set[int]) -> str:
    """What is left of an open block whose first token is at this place; ``level`` holds the marks by place, ``short``
    the places of short blocks that the host repeats."""
    tokens = _TOKEN.findall(text)
    end = at + len(tokens)
    first = max(0, at - LEAST + 1)

    def covered(places: np.ndarray) -> np.ndarray:
        found = np.zeros(len(tokens) + 1, np.int64)
        np.add.at(found, np.maximum(places - at, 0), 1)
        np.add.at(found, np.minimum(places + LEAST, end) - at, -1)
        return np.cumsum(found[:-1]) > 0

    if at in short or covered(first + np.flatnonzero(level[first:end] >= 1)).all():
        return ""
    gone = covered(at + np.flatnonzero(level[at : max(at, end - LEAST + 1)] >= 2))
    return " ".join(t for t, x in zip(tokens, gone, strict=True) if not x) if gone.any() else text


def _decide(parsed: DataFrame) -> DataFrame:
    """(page_id, url, text, n_repeated) of parsed pages with their marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, (blocks, marks) in enumerate(zip(batch.column("blocks").to_pylist(), batch.column("covered").to_pylist(), strict=True)):
                if texts[i] is not None:
                    continue
                level = np.zeros(max((b["at"] + len(b["text"]) for b in blocks), default=0), np.int8)
                short = set()
                for mark in marks or []:
                    if mark["at"] >= 0 and mark["at"] < len(level):
                        level[mark["at"]] = mark["level"]
                    elif mark["at"] < -1 and mark["level"] == 2:
                        short.add(-2 - mark["at"])
                left = [b["text"] if b["at"] < 0 else _left(b["at"], b["text"], level, short) for b in blocks]
                texts[i] = "\n".join(x for x in left if x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), batch.column("n_repeated")],
                ["page_id", "url", "text", "n_repeated"],
            )

    return parsed.mapInArrow(run, "page_id long, url string, text string, n_repeated long")


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_repeated (places outside the content where a substring
    begins that the host repeats).

    Null or empty html, and pages without text: empty text. Repeated rows count as one page of their host, and
    each gives a row. Other columns are ignored. Pages are scanned twice, so that no text is shuffled.
    """
    marks = repeated(pages).groupBy("key", "at").agg(F.count("*").alias("n"), F.max("level").alias("level"))
    copies = _rows(pages).groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1")
    marks = marks.join(copies, "key", "left").withColumn("n", (F.col("n") / F.coalesce("copies", F.lit(1))).cast("long"))
    marks = materialize(marks.select("key", "at", "level", "n"))
    totals = materialize(marks.where("at >= -1").groupBy("key").agg(F.sum("n").alias("n_repeated")))
    covered = materialize(marks.where("at <> -1 and level > 0").groupBy("key").agg(F.collect_list(F.struct("at", "level")).alias("covered")))
    parsed = parse(pages).join(small_side(totals), "key", "left").join(covered, "key", "left")
    parsed = parsed.withColumn("n_repeated", F.coalesce("n_repeated", F.lit(0)).cast("long"))
    return _decide(parsed).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")
