"""Main text of web pages: page structure, and differences to the pages with the nearest URLs of the host."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text, html
from ._store import save

# Elements that never hold main text; class and id words that name page furniture; those of them that also name parts
# of a text; words of layout that stand beside them in compound names; roles of furniture.
DROPPED = frozenset("nav footer aside form button select option label input dialog menu svg canvas object audio video head script style title noscript template iframe textarea".split())
FURNITURE = frozenset(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments commentary consent cookie cookies disqus footer"
    " masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related remark reply replies respond share"
    " sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
AMBIGUOUS = frozenset("banner commentary consent footer masthead menu navigation notice notices promoted related remark reply replies respond share sharing skip social sponsor sponsored".split())
LAYOUT = frozenset(
    "area bar block bottom box button buttons column container content footer global group header home icon icons inner item items left link links list main middle"
    " outer page panel post posts primary right row secondary section site tab thread top wrap wrapper".split()
)
# only outside an article: inside, these name parts of it
OUTER = frozenset("header topbar copyright legal disclaimer".split())
#: Share of a block's characters that stand in links, from which a suspected block inside an article goes.
LINKED = 0.5
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
BLOCKS = frozenset("address article blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
_PARA_ENDS = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

_NAME, _PART = re.compile(r"[^\s]+"), re.compile(r"[a-z]+")


def _named(name: str, in_article: bool) -> int:
    """2 for the name of page furniture, 1 for one that may also name a part of an article, else 0.

    A compound name counts if each of its parts names furniture or layout: ``share-buttons``, but not ``share-price``.
    """
    parts = set(_PART.findall(name))
    telling = parts & FURNITURE if in_article else parts & (FURNITURE | OUTER)
    if not telling or parts - telling - LAYOUT:
        return 0
    return 1 if in_article and telling <= AMBIGUOUS else 2


def _furniture(name: str, raw: str, in_article: bool) -> int:
    """2 for an element of page furniture, 1 for one inside an article that has to be proven to be, else 0."""
    if name in DROPPED or name == "header" and not in_article:
        return 2
    if not raw or name in ("body", "html", "main") or name == "article" and not in_article and "omment" not in raw:
        return 0
    low = raw.lower()
    if "class" not in low and "id" not in low and "role" not in low and "hidden" not in low:
        return 0
    found = html.attributes(raw)
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in ROLES:
        return 2
    names = _NAME.findall((found.get("class", "") + " " + found.get("id", "")).lower())
    return max((_named(n, in_article) for n in names), default=0)


def blocks(page: str) -> tuple[list[str], list[int]]:
    """All text blocks of a page in order, and for each 3 (in the article, under a name of furniture), 2 (in the article), 1 (open to
    doubt) or 0 (furniture).

    A block under such a name goes if half of it are links. Unclosed elements end with the element that holds them; an end tag
    that opened nothing is ignored.
    """
    texts: list[str] = []
    kinds: list[int] = []
    words: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int, bool, bool]] = []  # name, furniture, article, link, with what stands around it
    none = (0, False, False)
    gone, inside, link = none

    def flush() -> None:
        if words:
            text = html.clean("".join(words))
            kind = 0 if gone == 2 else 1 if not inside else 3 if gone else 2
            if kind == 3 and len(html.clean("".join(linked))) >= LINKED * len(text):
                kind = 0
            words.clear()
            linked.clear()
            if text:
                texts.append(text)
                kinds.append(kind)

    for kind, name, value in html.events(page):
        if kind == "text":
            words.append(value)
            if link:
                linked.append(value)
            continue
        if kind == "raw":
            continue
        heavy = name in BLOCKS or name in DROPPED
        if name == "br":
            words.append(" ")
        elif kind == "open":
            if heavy:
                flush()
                if name in _PARA_ENDS and stack and stack[-1][0] == "p":
                    stack.pop()
                elif name in ("li", "dd", "dt", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
                    stack.pop()
                gone, inside, link = stack[-1][1:] if stack else none
            elif name not in html.VOID and value and _furniture(name, value, inside) > gone:
                flush()
            elif name in html.VOID or name not in ("span", "a", "b", "i", "em", "strong", "ins", "section"):
                continue
            if name in html.VOID or value.endswith("/") and not heavy:
                continue
            gone = max(gone, _furniture(name, value, inside))
            inside, link = inside or name in ("article", "main"), link or name == "a"
            stack.append((name, gone, inside, link))
        else:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is None or not heavy and any(x[0] in BLOCKS or x[0] in DROPPED for x in stack[at + 1 :]):
                continue
            after = stack[at - 1][1:] if at else none
            if heavy or after[:2] != (gone, inside):
                flush()
            del stack[at:]
            gone, inside, link = after
    flush()
    return texts, kinds


_URL = re.compile(r"^(?:[a-z][a-z0-9+.-]*:)?(?://)?(?:[^/@?#]*@)?([^/?#:]*)(?::\d*)?([^?#]*)", re.I)


def extract_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html, ph) → its key, host and path, line hashes, and the blocks that may be main text.

    ``numbers`` has the line number of a block that goes if a neighbour shares it, and -1 for one that stays; a page is ``sure``
    if all stay.
    """
    for batch in batches:
        for part in _text.slices(batch, "html", 8 << 20):
            urls, pages = part.column("url").to_pylist(), part.column("html").to_pylist()
            host, path, texts, numbers, sure, has, lines = [], [], [], [], [], [], []
            for url, page in zip(urls, pages, strict=True):
                m = _URL.match(url or "")
                host.append(m[1].lower())
                path.append(m[2])
                all_texts, kinds = blocks(page or "")
                article = 2 in kinds or 3 in kinds
                keep = [i for i, k in enumerate(kinds) if (k >= 2 if article else k == 1)]
                open_ = [i if kinds[i] in (1, 3) else -1 for i in keep]
                has.append(article)
                sure.append(article and max(open_) < 0)
                texts.append([all_texts[i] for i in keep])
                numbers.append(open_)
                lines.append(all_texts)
            flat = pa.array([t for x in lines for t in x], pa.string())
            data, offsets = _text.buffers(flat)
            hashes = _text.Rolling(data).ranges(offsets[:-1], offsets[1:]).view(np.int64)
            at = np.concatenate([[0], np.cumsum([len(x) for x in lines])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), part.column("ph"), pa.array(host, pa.string()), pa.array(path, pa.string()), pa.array(sure, pa.bool_()), pa.array(has, pa.bool_()), pa.array(texts, pa.list_(pa.string())), pa.array(numbers, pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array(at), pa.array(hashes, pa.int64()))],
                ["page_id", "url", "ph", "host", "path", "sure", "has_article", "texts", "numbers", "lines"],
            )


def common_lines(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Places of a longest common subsequence. The k-th of equal lines is taken to match the k-th of the other page."""

    def numbered(x: list[int]) -> list[tuple[int, int]]:
        seen: Counter = Counter()
        out = []
        for v in x:
            out.append((v, seen[v]))
            seen[v] += 1
        return out

    place = {v: i for i, v in enumerate(numbered(b))}
    pairs = [(i, place[v]) for i, v in enumerate(numbered(a)) if v in place]
    tails: list[int] = []
    tops: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        back[k] = tops[at - 1] if at else -1
        if at == len(tails):
            tails.append(j)
            tops.append(k)
        else:
            tails[at], tops[at] = j, k
    k, found = (tops[-1] if tops else -1), []
    while k >= 0:
        found.append(pairs[k])
        k = back[k]
    return [i for i, _ in found][::-1], [j for _, j in found][::-1]


def shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring pages (lines, next_lines) → the places of shared lines. Pages with equal lines say nothing."""
    for batch in batches:
        both = [([], []) if a == b else common_lines(a, b) for a, b in zip(batch.column("lines").to_pylist(), batch.column("next_lines").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("ph"), batch.column("next_page_id"), batch.column("next_ph"), *(pa.array([x[k] for x in both], pa.list_(pa.int32())) for k in (0, 1))],
            ["page_id", "ph", "next_page_id", "next_ph", "here", "there"],
        )


def neighbours(rows: DataFrame) -> DataFrame:
    """Each page with the next one of its host, by path: a range sort, then a join of adjacent ranks.

    No window holds a host: a host of a third of all pages is spread over many sorted partitions.
    """
    key = ["host", "path", "page_id", "ph"]
    ranked = save(rows.select(*key, "lines").distinct().orderBy(*key).withColumn("mid", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("mid", 33)
    sizes = ranked.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()  # a row for each sorted partition
    before, total = [], 0
    for r in sorted(sizes):
        before += [F.lit(r["part"]), F.lit(total)]
        total += r["n"]
    start = F.element_at(F.create_map(*before), part) if before else F.lit(0)
    placed = ranked.select(*key, "lines", (start + F.col("mid").bitwiseAND((1 << 33) - 1)).alias("at"))
    after = placed.select((F.col("at") - 1).alias("at"), F.col("host").alias("next_host"), F.col("page_id").alias("next_page_id"), F.col("ph").alias("next_ph"), F.col("lines").alias("next_lines"))
    return placed.join(after, "at").where("host = next_host").select("page_id", "ph", "lines", "next_page_id", "next_ph", "next_lines")


def main_text(pages: DataFrame) -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars (code points), has_article.

    ``pages`` needs page_id, url and html; other columns are ignored. All text blocks of a page are aligned with those
    of the pages before and after it in the order of URL paths of its host, and lines that they share are deleted, but
    for those inside ``article`` or ``main``: there a page that repeats a neighbour's article would lose it, so a shared line only goes
    if its class or id could name page furniture, too. Of what is left, blocks in menus, headers, footers, sidebars,
    notices, adverts, forms, scripts and comments go; a page with an article keeps only the blocks inside. Null and empty pages have the text ''. A null URL is an empty host.
    Repeated rows get equal results. An empty table gives an empty result. Texts are neither cut nor dropped.
    """
    source = pages.select("page_id", "url", "html").withColumn("ph", F.xxhash64("url", "html"))
    rows = save(source.mapInArrow(extract_rows, "page_id long, url string, ph long, host string, path string, sure boolean, has_article boolean, texts array<string>, numbers array<int>, lines array<long>"), "blocks")
    pairs = neighbours(rows).mapInArrow(shared_rows, "page_id long, ph long, next_page_id long, next_ph long, here array<int>, there array<int>")
    pairs = save(pairs.where("size(here) > 0"), "shared_lines")
    shared = pairs.select("page_id", "ph", F.col("here").alias("s")).unionByName(pairs.select(F.col("next_page_id").alias("page_id"), F.col("next_ph").alias("ph"), F.col("there").alias("s")))
    shared = shared.groupBy("page_id", "ph").agg(F.array_distinct(F.flatten(F.collect_list("s"))).alias("shared"))
    shared = shared.withColumnsRenamed({"page_id": "_p", "ph": "_h"})
    match = F.col("page_id").eqNullSafe(F.col("_p")) & (F.col("ph") == F.col("_h"))
    sure = rows.where("sure").select("page_id", "url", F.array_join("texts", "\n\n").alias("text"), "has_article")
    # only pages of which lines can go meet the shared lines
    doubtful = rows.where("not sure").select("page_id", "url", "ph", F.arrays_zip("numbers", "texts").alias("open"), "has_article").join(shared, match, "left")
    left = F.filter("open", lambda x: ~F.coalesce(F.array_contains("shared", x["numbers"]), F.lit(False)))
    doubtful = doubtful.select("page_id", "url", F.array_join(F.transform(left, lambda x: x["texts"]), "\n\n").alias("text"), "has_article")
    out = sure.unionByName(doubtful)
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "has_article")


def op7_query(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
