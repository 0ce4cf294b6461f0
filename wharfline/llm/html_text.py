"""The main text of web pages, with a suffix array per host for what the markup leaves open.

A page is cut into blocks at block elements. Where the markup names the main part (``article``, ``main``), its blocks are
the text, without what is named as something else: navigation, headers and footers of the page, sidebars, notices,
adverts, forms, comments. The parser decides this, not a search in the raw html. Pages without a block in a named main
part leave the question open. For them the method is the host's token stream: the suffixes of all blocks outside main
parts, of all pages of a host, are sorted, cut at ``SUFFIX`` words; neighbours with the same beginning from two distinct
pages are a passage that the host repeats. Such passages are boilerplate; the unique runs of an open page are its text.
Shards of the suffix array are dealt by host and first words, so a host with a third of all pages has as many shards as
there are. Pages are parsed once. Every page of every host is in the array, whether or not an open page asks its host.

In named main parts the host decides too, over the suffixes at the beginnings of blocks, compared to the block's end: a block
that ``FRAME_SHARE`` of the different main texts of a host have is part of its frame (a letter to subscribe to, a notice without a
name) and goes. The first block, where the headline stands, stays; so does a main part of which less than half of the words would
be left. Hosts of fewer than ``FRAME_TEXTS`` main texts can't show it. Whether passages of a main part stand outside main parts
too says nothing: adverts quote articles, lists of links repeat headlines and teasers.

Names of something else are words of class, id or role. A token that tells of a layout (``with-sidebar``) names nothing,
nor do the tokens of ``html``, ``body`` and ``main``. A ``main`` ends whatever holds around it; an ``article`` ends what
is only a frame (a form, a widget), not navigation, asides, sidebars or reader comments; of an outermost article's
own names only those of comments and adverts count.

Repetition alone would be wrong for marked pages: articles quote passages of each other, adverts and footers come from
a pool that differs from page to page.

Defined results: null, empty and text-less html give an empty text; unclosed elements end with their parents; a page whose
main part is empty is an open page; an open page without open blocks gives the articles of its asides and sidebars, if
any; repeated rows of one page don't count as distinct pages; null ids and urls are values of their own. Nothing is cut
off at any length. Extra columns don't matter.
"""

from __future__ import annotations

import html as entities
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sharing import KEY, SLICE_HASHES, answered, answers, edges_of, shared
from .tables import column, written
from .words import mix, windows, words_of

#: Words at which suffixes are cut: a repeated passage is at least so long. Shorter blocks count as wholes.
SUFFIX = 8
#: A block of main parts is a frame if so many of the host's main texts have it, of at least so many. The passage that articles of
#: the given tables share most is in a quarter of a host's texts, in two fifths where one line is made very common.
FRAME_SHARE, FRAME_TEXTS = 0.75, 12

#: Elements by their part in a page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time "
    "tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is no text at all.
RAW = frozenset("script style noscript template iframe object svg math canvas textarea title".split())
#: Never part of the main text.
OTHER = frozenset("nav footer aside form button select dialog menu head".split())
#: Words of class, id or role that name something other than the main text.
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr masthead menu "
    "modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted related replies reply share sharing sidebar social "
    "sponsor sponsored subscribe subscription toolbar widget widgets complementary contentinfo search".split()
)
#: These end an unclosed element of the same kind.
SELF_ENDING = {"p": frozenset("p"), "li": frozenset(["li"]), "td": frozenset(["td", "tr"]), "tr": frozenset(["tr"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"])}

TAG = regex.compile(r"<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>", regex.S)
NAMED = regex.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", regex.I)
NAME_WORD = regex.compile(r"[a-z]+")

#: Elements and names that an article inside them doesn't end: it is a teaser or a comment there.
CLOSED = frozenset("nav footer aside button select dialog menu head".split())
CLOSED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising complementary contentinfo footer menu nav navbar navigation promoted related sidebar sponsored".split()
)
READERS = frozenset("comment comments disqus replies reply".split())
#: Names that, as a whole token or before a number, make an outermost article something else.
NOT_AN_ARTICLE = regex.compile(r"(?:ad|ads|advert|advertisement|comment|promoted|reply|sponsored)(?:[-_]?\d+)?")
#: A token that begins with one of these tells of a layout or state.
LAYOUT = frozenset("has have hide hidden is no not show toggle with without".split())


def _tokens(attributes: str) -> list[str]:
    if "=" not in attributes:
        return []
    return [token for found in NAMED.findall(attributes) for token in "".join(found).lower().split()]


def _other(name: str, attributes: str, in_article: bool = True) -> str:
    """What an element holds instead of main text: readers, closed, other or nothing of the kind."""
    if name in OTHER:
        return "closed" if name in CLOSED else "other"
    tokens = _tokens(attributes) if name not in ("html", "body") else []
    if name == "article" and not in_article:
        return "readers" if any(NOT_AN_ARTICLE.fullmatch(t) for t in tokens) else ""
    held = ""
    for token in tokens:
        words = NAME_WORD.findall(token)
        if words and words[0] not in LAYOUT:
            if any(w in READERS for w in words):
                return "readers"
            if any(w in CLOSED_NAMES for w in words):
                held = "closed"
            elif any(w in OTHER_NAMES for w in words):
                held = held or "other"
    return held


def _is_main(name: str, attributes: str) -> bool:
    return name == "main" or ("role" in attributes and regex.search(r"role\s*=\s*[\"']?main\b", attributes, regex.I) is not None)


def blocks(page: str) -> list[tuple[str, str]]:
    """(part, text) of every block in page order; part is main, open, other, closed, readers, or teaser: an article in a closed part."""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    stack: list[tuple[str, str]] = []  # element, and the part that holds inside it
    part, at = "open", 0
    aside: list = []  # a marked inline element: its name, depth, and the text and part around it

    def end_aside() -> None:
        nonlocal part
        if aside:
            close_block()
            part = aside[3]
            held.extend(aside[2])
            aside.clear()

    def close_block() -> None:
        text = "".join(held)
        held.clear()
        words = (entities.unescape(text) if "&" in text else text).split()
        if words:
            out.append((part, " ".join(words)))

    lower = None
    while True:
        found = TAG.search(page, at)
        held.append(page[at : found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        closing, name, attributes = found.group(1) or found.group(4), found.group(2) or found.group(5), found.group(3) or found.group(6) or ""
        if not name:
            continue
        name = name.lower()
        if name in RAW and not closing:
            if attributes.endswith("/"):
                continue
            lower = page.lower() if lower is None else lower
            end = lower.find(f"</{name}", at) if len(lower) == len(page) else page.find(f"</{name}", at)
            at = len(page) if end < 0 else end
            continue
        if name in INLINE:
            if name == "br":
                held.append(" ")
            elif aside and name == aside[0]:
                aside[1] += -1 if closing else 1
                if not aside[1]:
                    end_aside()
            elif not aside and not closing and name not in VOID and part in ("main", "open") and _other(name, attributes):
                # its text is a block of its own, the block around it goes on after it
                aside.extend([name, 1, held.copy(), part])
                held.clear()
                part = "other"
            continue
        end_aside()
        close_block()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    part = stack[k][1]
                    del stack[k:]
                    break
        elif name not in VOID and not attributes.endswith("/"):
            ends = SELF_ENDING.get(name)
            if stack and (ends and stack[-1][0] in ends or stack[-1][0] == "p"):
                part = stack.pop()[1]
            stack.append((name, part))
            inside = name == "article" and any(element == "article" for element, _ in stack[:-1])
            if _is_main(name, attributes):
                part = "main"
            elif part in ("main", "open"):
                kind = "closed" if name == "header" and part == "open" else _other(name, attributes, inside)
                part = kind or ("main" if name == "article" else part)
            elif name == "article" and not inside:
                part = _other(name, attributes, inside) or {"other": "main", "closed": "teaser"}.get(part, part)
    end_aside()
    close_block()
    return out


def parts_of(page: str) -> tuple[bool, list[str], list[str]]:
    """Whether a main part is named; its blocks or else the open ones; those outside main parts, open ones among them."""
    found = blocks(page)
    main = [t for part, t in found if part == "main"]
    if main:
        return True, main, [t for part, t in found if part != "main"]
    own = [t for part, t in found if part == "open"] or [t for part, t in found if part == "teaser"]
    return False, own, [t for _, t in found]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [parts_of(page or "") for page in batch.column("html").to_pylist()]
        named, own, others = zip(*rows) if rows else ((), (), ())
        names = ["page_id", "url", "host", "page"]
        found = [pa.array(named, pa.bool_()), pa.array(own, pa.list_(pa.string())), pa.array(others, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *found], [*names, "named", "own", "others"])


def _suffixes(texts: list[str], hosts: list[int]) -> list[np.ndarray]:
    """For each block the hashes of (host, the SUFFIX words from here on); of a shorter block, of all its words."""
    words = words_of(pa.array(texts, pa.large_string()), lower=False)
    hashes = words.hashes()
    long = windows(hashes, SUFFIX)
    out = []
    for a, b, host in zip(words.first[:-1].tolist(), words.first[1:].tolist(), hosts):
        if b - a >= SUFFIX:
            own = long[a : b - SUFFIX + 1]
        else:
            own = mix(np.array([windows(hashes[a:b], b - a)[0] if b > a else 0], np.uint64) + np.uint64(b - a))
        out.append(mix(own ^ np.uint64(host)))
    return out


def _host_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(page, suffixes) of every block outside main parts; pages that ask nothing are sorted together first."""
    quiet, held, n = [], [], 0
    for batch in batches:
        hosts, pages, others = (batch.column(c).to_pylist() for c in ("host", "page", "others"))
        is_open = batch.column("is_open").to_pylist()
        for host, page, texts, asks in zip(hosts, pages, others, is_open):
            if not texts:
                continue
            own = np.unique(np.concatenate(_suffixes(texts, [host & (2**64 - 1)] * len(texts))))
            if asks:
                yield _name(page & (2**64 - 1), 1), own
                continue
            quiet.append(page & (2**64 - 1))
            held.append(own)
            n += len(own)
            if n >= SLICE_HASHES:
                yield from _proofs(quiet, held)
                quiet, held, n = [], [], 0
    if n:
        yield from _proofs(quiet, held)


def _name(page: int, asks: int) -> np.ndarray:
    name = np.zeros(1, KEY)
    name["a"], name["b"] = page, asks
    return name


def _proofs(pages: list[int], held: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sorted suffixes of pages that get no answer, with two of the pages of each: that two distinct pages have it is all that an open page asks.

    So a passage that is on all pages of a large host doesn't gather all of them in one task.
    """
    flat, own = np.concatenate(held), np.repeat(np.array(pages, np.uint64), [len(s) for s in held])
    order = np.lexsort((own, flat))
    flat, own = flat[order], own[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    distinct = new | np.concatenate(([True], own[1:] != own[:-1]))
    flat, own, new = flat[distinct], own[distinct], new[distinct]
    proof = new | np.concatenate(([False], new[:-1]))
    flat, own = flat[proof], own[proof]
    order = np.argsort(own, kind="stable")
    flat, own = flat[order], own[order]
    edges = edges_of(own)
    for a, b in zip(edges[:-1], edges[1:]):
        yield _name(own[a], 0), flat[a:b]


def repeated_for_open(flat: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In the sorted suffixes, those whose neighbour is from another page; only open pages need to know."""
    edges = edges_of(flat)
    pages = np.repeat(np.diff(edges), np.diff(edges))
    return (pages > 1) & (keys["b"] == 1), pages


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for name, flat, _ in answers(batches):
        page = int(name["a"].view("<i8"))
        yield pa.RecordBatch.from_arrays([pa.array([page], pa.int64()), pa.array([np.sort(flat).tobytes()], pa.binary())], ["page", "found"])


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        hosts, blocks_of, known = (batch.column(n).to_pylist() for n in ("host", "own", "found"))
        for own, host, found in zip(blocks_of, hosts, known):
            repeated = np.frombuffer(found or b"", "<u8")
            kept = []
            for text, suffixes in zip(own, _suffixes(own, [host & (2**64 - 1)] * len(own)) if own else []):
                words = text.split(" ")
                hit = np.flatnonzero(np.isin(suffixes, repeated))
                gone = np.zeros(len(words) + SUFFIX, bool)
                for k in hit:
                    gone[k : k + min(SUFFIX, len(words))] = True
                unique = [w for w, g in zip(words, gone) if not g]
                if unique:
                    kept.append(" ".join(unique))
            texts.append("\n".join(kept))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


PARSED = "page_id long, url string, host long, page long, named boolean, own array<string>, others array<string>"
FOUND = pa.schema([("page", pa.int64()), ("found", pa.binary())])


def frames(marked: DataFrame) -> DataFrame:
    """host, frames: hashes of the blocks that FRAME_SHARE of its main texts have; as each is in so many texts, they are not many more than a text's blocks."""
    text = F.xxhash64("own").alias("main_text")
    texts = marked.select("host", text).distinct().groupBy("host").agg(F.count("*").alias("texts")).filter(F.col("texts") >= FRAME_TEXTS)
    later = F.slice("own", F.lit(2), F.greatest(F.size("own") - 1, F.lit(0)))
    held = marked.select("host", text, F.explode(later).alias("block")).select("host", "main_text", F.xxhash64("host", "block").alias("block")).distinct()
    common = held.groupBy("host", "block").agg(F.count("*").alias("n")).filter(F.col("n") >= FRAME_SHARE * FRAME_TEXTS)
    return common.join(texts, "host").filter(F.col("n") >= FRAME_SHARE * F.col("texts")).groupBy("host").agg(F.collect_set("block").alias("frames"))


def _words(blocks: Column) -> Column:
    return F.size(F.split(F.array_join(blocks, " "), " "))


def _main_texts(marked: DataFrame) -> DataFrame:
    """page_id, url and text of pages with a named main part."""
    found = written(frames(marked), "html-frames")
    own = F.col("own")
    if found.isEmpty():
        return marked.select("page_id", "url", F.array_join(own, "\n").alias("text"))
    left = F.filter(own, lambda t, i: (i == 0) | ~F.array_contains("frames", F.xxhash64("host", t)))
    whole = F.col("frames").isNull() | (2 * _words(left) < _words(own))
    return marked.join(found, "host", "left").select("page_id", "url", F.when(whole, F.array_join(own, "\n")).otherwise(F.array_join(left, "\n")).alias("text"))


def html_text(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its length of every page."""
    rows = pages.select(column(pages, "page_id", "long").alias("page_id"), column(pages, "url", "string").alias("url"), column(pages, "html", "string").alias("html"))
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    named = rows.select("*", F.xxhash64(host).alias("host"), F.xxhash64("page_id", "url", F.lit(1)).alias("page"))
    parsed = written(named.mapInArrow(_parsed, PARSED), "html-blocks")
    marked = _main_texts(parsed.filter("named"))
    open_pages = parsed.filter("NOT named")
    streams = parsed.select("host", "page", "others", (~F.col("named")).alias("is_open"), F.concat_ws("\n", "others").alias("stream"))
    found = answered(shared(streams, _host_suffixes, repeated_for_open, "stream"), _packed, "page long, found binary", FOUND)
    left = open_pages.join(found, "page", "left").select("page_id", "url", "host", "own", "found")
    texts = marked.unionByName(left.mapInArrow(_open, "page_id long, url string, text string"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
