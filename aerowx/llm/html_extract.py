"""Main text of web pages: content elements, and a suffix array per host for the rest.

A page is cut into blocks. Markup that names something else (navigation, adverts, comments,
forms and so on) is left out; only containers are judged by class or id, and only if every word
of the name says so, so a link, a heading or a paragraph in an article is never taken for one. The
blocks inside the innermost named content (article, main, or a class or id that says so) are
text, and repetition decides nothing about them: an article may well share lines with others.

The host decides about the rest: blocks of a content element around the article, such as a
title and a lead in a main above it, and all blocks of a page that names no content. What
repeats is found over the token streams of all pages of a host, with the blocks that stay and
those outside any content element, which are left out but tell what the host repeats:

1. The suffixes of all streams are dealt and sorted by a short hash of their host and first
   ``run_words`` words, packed with what they differ by; each is compared with its neighbours.
   Those alike on several pages, one of them at a block to decide, are put into a bitmap.
2. Suffixes that the bitmap knows meet again by host and the whole hash of their first words.
   They mark a run as repeated if it is on a page of other content: sketches far apart.
   Each page has 128 bits, the signs of sums over its distinct words, and a run counts
   as repeated if more than ``DIFFERENT`` bits vary over the pages that have it. Near copies of
   a page, however many, vary in few.
3. Repeated runs that follow each other or overlap are one longer run. Blocks that such runs cover
   are boilerplate; unique blocks stay.

Equal suffixes are reduced in each task before they meet, so a line on every page of a host with
a third of all pages weighs one row per task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .bitmap import bitmap, has_bits
from .runs import packed, run_starts, slices, unpacked, whole_runs
from .shared import id_text, written
from .words import grams, hash_words, mixed

#: Words of a run that must repeat on the host.
RUN_WORDS = 6
#: Bits of a sketch, of 128, in which near copies may vary: about a seventh of a page's words.
DIFFERENT = 22
#: Bits of a suffix's short hash; a bucket holds about so many suffixes, and there are so many buckets at least.
SHORT_BITS = 40
BUCKET = 1 << 20
LEAST_BUCKETS = 64
#: Buckets that meet in a task, on average, at most.
TASK_BUCKETS = 4
#: Bits that tell which suffixes may repeat.
FILTER_BITS = 1 << 24
_FLUSH = 1 << 20
_PAGES = 256

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")

# Names from the HTML standard (fixed values).
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
    "search section summary table tbody tfoot thead tr ul".split()
)
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_CELL = frozenset(("td", "th", "br"))
_NEVER = frozenset(
    "script style noscript template svg math iframe object canvas audio video noembed noframes title "
    "nav footer aside form button select textarea datalist dialog menu search".split()
)
_OTHER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar "
    "tablist status log".split()
)
# Parts of class and id names that say what an element holds (word lists of our own).
_OTHER = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer masthead topbar cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "signin paywall share sharing social related recommended recommendations trending teaser comment comments "
    "commentlist disqus reply replies respond discussion widget toolbar pagination pager skip copyright "
    "disclaimer banner callout search form".split()
)
_HEADERS = frozenset(("header", "head", "top"))
_CONTENT = frozenset("article content post entry story main body text".split())
# Words beside those that say nothing about what an element holds.
_PLAIN = frozenset(
    "area bar bars block blocks body bottom box button buttons card cards center closed col column container content "
    "enabled feed footer form global group has header holder icons inline inner is item items left link links list main "
    "message no open outer page panel post posts region right row section sections site slot small strip tag tags "
    "text thread title top unit up widget widgets with without wrap wrapper zone".split()
)
_STATES = frozenset(("has", "with", "no", "without", "is", "enabled", "open", "closed"))
# Elements that classes and ids may mark as something else: containers, never text in a line, headings or paragraphs.
_CONTAINERS = frozenset(
    "div section ul ol dl table tbody tr td figure blockquote header center details fieldset article".split()
)
_HOLDS_ARTICLE = re.compile(r"<(?:article|main|h1)\b|\brole\s*=\s*[\"']?main\b|\bitemprop\s*=\s*[\"']?articleBody\b", re.I)

ARTICLE, MAIN, NAMED, OPEN = 3, 2, 1, 0


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _parts(attributes: dict[str, str]) -> list[frozenset[str]]:
    """The words of each class and of the id."""
    names = attributes.get("class", "").split() + attributes.get("id", "").split()
    return [frozenset(p.lower() for p in _PARTS.findall(unescape(n))) for n in names]


def _is_other(tag: str, attributes: dict[str, str], parts: list[frozenset[str]], inside: int) -> bool:
    if tag in ("html", "body", "main"):
        return False
    if tag in _NEVER or (tag in ("header", "head") and inside < MAIN):
        return True
    role = attributes.get("role", "").lower()
    style = attributes.get("style", "").replace(" ", "").lower()
    if role in _OTHER_ROLES or "hidden" in attributes or "display:none" in style:
        return True
    if tag not in _CONTAINERS:
        return False
    for name in parts:
        if name & _STATES:
            continue
        said = name & _OTHER or (inside < MAIN and name & _HEADERS)
        if said and name <= _OTHER | _HEADERS | _PLAIN:
            return True
    return False


def _content_level(tag: str, attributes: dict[str, str], parts: list[frozenset[str]]) -> int:
    role = attributes.get("role", "").lower()
    if tag == "article" or role == "article" or attributes.get("itemprop", "").lower() == "articlebody":
        return ARTICLE
    if tag == "main" or role == "main":
        return MAIN
    if tag in ("div", "section", "td") and any(name & _CONTENT and not name & _STATES for name in parts):
        return NAMED
    return OPEN


def page_blocks(html: str | None) -> list[tuple[int, str]]:
    """(level, text) of every block that is not other matter; level 4 is an article in a main."""
    html = html or ""
    blocks: list[tuple[int, str]] = []
    open_tags: list[tuple[str, int]] = []
    held: list[str] = []
    level, at = OPEN, 0

    def flush() -> None:
        if held:
            text = " ".join(unescape("".join(held)).split())
            held.clear()
            if text:
                blocks.append((level, text))

    def close(tag: str) -> None:
        nonlocal level
        for k in range(len(open_tags) - 1, -1, -1):
            if open_tags[k][0] == tag:
                level = open_tags[k][1]
                del open_tags[k:]
                return

    def skip_from(tag: str, place: int) -> int:
        """Where the matter of an unwanted element ends."""
        depth, around = 1, {t for t, _ in open_tags}
        while found := _TOKEN.search(html, place):
            name = (found[2] or found[5] or "").lower()
            ends = (found[1] or found[4]) == "/"
            place = found.end()
            if name in _RAW and not ends and name != tag:
                place = raw_end(name, place)
            elif name == tag:
                depth += -1 if ends else 1
                if depth == 0:
                    return place
            elif (ends and name in around and name not in ("div", "span")) or (tag == "head" and name == "body"):
                return found.start()
            elif tag == "p" and not ends and name in _BLOCK:
                return found.start()
        return len(html)

    def raw_end(tag: str, place: int) -> int:
        found = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, place)
        return found.end() if found else len(html)

    def around_page(place: int) -> bool:
        """Whether a form that begins here holds the article, or all that the page has to say."""
        end = skip_from("form", place)
        if _HOLDS_ARTICLE.search(html, place, end):
            return True
        after = _TOKEN.sub(" ", html[end:])
        return not blocks and not after.strip() and re.search(r"<p\b", html[place:end], re.I) is not None

    while found := _TOKEN.search(html, at):
        held.append(html[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        ends = (found[1] or found[4]) == "/"
        if tag in _CELL:
            held.append(" ")
        if tag in _BLOCK:
            flush()
        if ends:
            close(tag)
            continue
        if tag in _BLOCK and open_tags and open_tags[-1][0] == "p":
            close("p")
        text = found[3] or found[6] or ""
        if tag in _VOID or (tag not in _BLOCK and tag not in _NEVER and not text.strip()):
            continue
        attributes = _attributes(text)
        parts = _parts(attributes)
        if tag == "form" and around_page(at):
            open_tags.append((tag, level))
            continue
        if _is_other(tag, attributes, parts, level):
            if tag in _BLOCK:
                flush()
            if not text.rstrip().endswith("/") or tag not in ("svg", "math"):
                at = raw_end(tag, at) if tag in _RAW else skip_from(tag, at)
            continue
        if tag in _BLOCK or tag == "td":
            open_tags.append((tag, level))
            new = _content_level(tag, attributes, parts)
            level = 4 if {new, level} == {ARTICLE, MAIN} else max(level, new)
    held.append(html[at:])
    flush()
    return blocks


def _host(url: str | None) -> str:
    found = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)", url or "")
    return found[1].lower() if found else ""


def sketch(words: np.ndarray) -> np.ndarray:
    """128 bits as two numbers: for each, whether most distinct words have it set."""
    kinds = np.unique(words)
    bits = np.unpackbits(np.stack((mixed(kinds, 21), mixed(kinds, 22)), axis=1).view(np.uint8), axis=1)
    return np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(kinds)).view(np.int64)


def _hashed(text: str) -> np.ndarray:
    return hash_words(text.encode("utf-8", "surrogatepass"))[2]


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks and what markup says of them; ``text`` where it decides about all, ``outside`` for blocks it leaves out."""
    for batch in batches:
        out = []
        for page, url, html in zip(batch["page_id"], batch["url"], batch["html"]):
            blocks = page_blocks(html)
            top = max((level for level, _ in blocks), default=OPEN)
            # Blocks outside any content element go, if the page has one.
            kept = [(t, level < top or not top) for level, t in blocks if level or not top]
            outside = "\n".join(t for level, t in blocks if top and not level)
            words = _hashed("\n".join(t for _, t in blocks))
            high, low = sketch(words).tolist()
            texts, free = [t for t, _ in kept], [f for _, f in kept]
            text = None if any(free) else "\n".join(texts)
            if text is not None:
                texts = free = None
            out.append((page, url, _host(url), high, low, text, texts, free, outside, len(words)))
        yield pd.DataFrame(
            out, columns=["page_id", "url", "host", "high", "low", "text", "blocks", "free", "outside", "n"]
        )


def _page_runs(batch: pd.DataFrame, run_words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each page the suffixes of its streams by their first words, and which are of blocks to decide."""
    for text, blocks, free, outside in zip(batch["text"], batch["blocks"], batch["free"], batch["outside"]):
        loose = "" if blocks is None else "\n".join(b for b, f in zip(blocks, free) if f)
        stays = [text] if blocks is None else [b for b, f in zip(blocks, free) if not f]
        runs = [grams(_hashed(t), run_words, 6) for t in (loose, "\n".join([*stays, outside]))]
        yield np.concatenate(runs), np.repeat([True, False], [len(r) for r in runs])


def _short(host: str, runs: np.ndarray) -> np.ndarray:
    """A short hash of a host and the first words of its suffixes."""
    own = int.from_bytes(hashlib.blake2b(host.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    return mixed(runs ^ np.uint64(own), 31) >> np.uint64(64 - SHORT_BITS)


def _ordered(key: np.ndarray, free: np.ndarray, page: np.ndarray, buckets: int) -> pd.DataFrame:
    """A row for each bucket: its sorted distinct suffixes, whether one is free and whether several pages have it."""
    order = np.argsort(key, kind="stable")
    key, free, page = key[order], free[order], page[order]
    starts = run_starts(key)
    several = np.minimum.reduceat(page, starts) != np.maximum.reduceat(page, starts)
    loose = np.logical_or.reduceat(free, starts)
    key = key[starts]
    entry = key << np.uint64(2) | loose.astype(np.uint64) << np.uint64(1) | several.astype(np.uint64)
    bucket = (key * np.uint64(buckets)) >> np.uint64(SHORT_BITS)
    cuts = run_starts(bucket)
    parts = np.split(entry, cuts[1:])
    rows = [packed((np.diff(p, prepend=np.uint64(0)),), (np.uint64,)) for p in parts]
    return pd.DataFrame({"bucket": bucket[cuts].astype(np.int64), "entries": rows})


def _suffixes(run_words: int, buckets: int):
    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        count = pages = 0

        def flush() -> pd.DataFrame:
            parts = [np.concatenate([h[k] for h in held]) for k in range(3)]
            held.clear()
            return _ordered(*parts, buckets)

        for batch in batches:
            for host, (runs, free) in zip(batch["host"], _page_runs(batch, run_words)):
                if len(runs):
                    held.append((_short(host, runs), free, np.full(len(runs), pages)))
                    count += len(runs)
                    pages += 1
                if count >= _FLUSH:
                    yield flush()
                    count = 0
        if held:
            yield flush()

    return suffixes


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Suffixes that neighbours in the order share, if one of them is of a block to decide."""
    for frame in whole_runs(batches, ["bucket"]):
        for a, b in slices(frame, ["bucket"]):
            parts = [np.cumsum(unpacked(x, (np.uint64,))[0], dtype=np.uint64) for x in frame["entries"].iloc[a:b]]
            entry = np.sort(np.concatenate(parts))
            starts = run_starts(entry >> np.uint64(2))
            alike = np.diff(np.append(starts, len(entry))) > 1
            said = np.bitwise_or.reduceat(entry & np.uint64(3), starts)
            shared = (alike | (said & np.uint64(1) > 0)) & (said & np.uint64(2) > 0)
            yield pd.DataFrame({"short": (entry[starts] >> np.uint64(2))[shared].astype(np.int64)})


def _shared_suffixes(run_words: int, shared):
    """(place, host, run, high, low, free) of the suffixes that the bitmap knows."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), _PAGES):
                pages = batch.iloc[at : at + _PAGES]
                runs, free, of = [], [], []
                for k, (host, (own, loose)) in enumerate(zip(pages["host"], _page_runs(pages, run_words))):
                    if len(own) and (known := has_bits(shared.value, _short(host, own))).any():
                        # Once for a page; streams of blocks to decide come first.
                        own, once = np.unique(own[known], return_index=True)
                        loose = loose[known][once]
                        runs.append(own.view(np.int64))
                        free.append(loose)
                        of.append(np.full(len(own), k))
                if runs:
                    out = pages[["place", "host", "high", "low"]].iloc[np.concatenate(of)]
                    yield out.assign(run=np.concatenate(runs), free=np.concatenate(free))

    return found


def unique_blocks(blocks: list[str], free: list[bool], runs: list[int], repeated: set[int], run_words: int) -> list[str]:
    """Blocks without those free ones that repeated runs of the free blocks' stream cover from end to end."""
    sizes = [len(hash_words(b.encode("utf-8", "surrogatepass"))[0]) if f else 0 for b, f in zip(blocks, free)]
    covered = np.zeros(sum(sizes) + 1, np.int64)
    for k, run in enumerate(runs):
        if run in repeated:
            covered[k : k + run_words] = 1
    ends = np.cumsum([0, *sizes])
    return [b for b, x, y in zip(blocks, ends[:-1], ends[1:]) if x == y or not covered[x:y].all()]


def _finish(run_words: int):
    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for blocks, free, repeated in zip(batch["blocks"], batch["free"], batch["repeated"]):
                seen = set() if repeated is None else set(repeated.tolist())
                blocks, free = list(blocks), list(free)
                words = _hashed("\n".join(b for b, f in zip(blocks, free) if f))
                runs = grams(words, run_words, 6).view(np.int64).tolist()
                texts.append("\n".join(unique_blocks(blocks, free, runs, seen, run_words)))
            yield batch[["page_id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    return finish


def _repeated(parsed: DataFrame, run_words: int) -> DataFrame:
    """(place, repeated): the runs of blocks to decide that pages of other content on the host have."""
    spark = parsed.sparkSession
    buckets = max(LEAST_BUCKETS, (parsed.agg(F.sum("n")).first()[0] or 0) // BUCKET)
    # Rows are wide: a task gets a few buckets, whatever the session's partitions and the input.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets // TASK_BUCKETS)
    streams = parsed.select("place", "host", "high", "low", "text", "blocks", "free", "outside")
    suffixes = streams.mapInPandas(_suffixes(run_words, buckets), "bucket long, entries binary")
    dealt = suffixes.repartition(parts, "bucket").sortWithinPartitions("bucket")
    shared = bitmap(dealt.mapInPandas(_neighbours, "short long"), FILTER_BITS)
    schema = "place long, host string, high long, low long, run long, free boolean"
    met = durable(streams.mapInPandas(_shared_suffixes(run_words, shared), schema))
    varied = " + ".join(f"bit_count(bit_or({c}) ^ bit_and({c}))" for c in ("high", "low"))
    order = met.groupBy("host", "run").agg(F.expr(varied).alias("varied"))
    repeated = durable(order.where(F.col("varied") > DIFFERENT).select("host", "run"))
    wanted = met.where("free").select("place", "host", "run")
    return wanted.join(repeated, ["host", "run"]).groupBy("place").agg(F.collect_list("run").alias("repeated"))


def extract_main_text(
    pages: DataFrame, run_words: int = RUN_WORDS, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) for every page: its article, one block to a line.

    Character references are decoded and white space in a block is one space. A NULL or empty
    page has the text "". NULL addresses, and those without a host, form one host of their
    own. Pages that agree in all but about a seventh of their words count as one page for
    repetition, so a page stored twice keeps its text, also if a date in it changed. Ids may be NULL or repeat. Other columns are ignored; an empty
    table gives an empty result.
    """
    given = pages.select(
        id_text(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    schema = (
        "page_id string, url string, host string, high long, low long, text string, "
        "blocks array<string>, free array<boolean>, outside string, n long"
    )
    parsed = given.mapInPandas(_parse, schema)
    parsed = written(parsed.withColumn("place", F.monotonically_increasing_id()), "pages", "zstd")
    cover = _repeated(parsed, run_words)
    unsettled = parsed.where("blocks IS NOT NULL")
    settled = parsed.where("blocks IS NULL").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    rest = unsettled.join(cover, "place", "left").select("page_id", "url", "blocks", "free", "repeated")
    found = settled.unionByName(
        rest.mapInPandas(_finish(run_words), "page_id string, url string, text string, n_chars long")
    )
    return found.withColumn("page_id", F.col("page_id").cast("long"))
