"""Main text of pages by differencing each page with its nearest different neighbour by URL.

Pages of a host are sorted by path; a page's lines are aligned with those of its
neighbour by longest common subsequence, and shared lines are taken for the
template and deleted. A check on the page's own markup follows: what an article
element holds is article text even if another page shares it, and menus,
adverts, forms and the like are dropped even if no page shares them.
"""

from __future__ import annotations

import bisect
import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quire.llm.arrow import slices
from quire.scratch import materialise

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<[!?/a-zA-Z][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z:-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
# Element names by their role, and class or id words that mark boilerplate.
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
CHROME = frozenset("nav footer aside form button select dialog menu svg math head object canvas audio video map".split())
CHROME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disclaimer footer gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification pagination pager popup promo promotion related reply respond search share sharing sidebar "
    "signup site-header page-header site-footer skip-link social sponsor sponsored subscribe toolbar widget".split()
)
# Inside an article: elements that may be boilerplate by their class, words that make a compound class no more than
# its other words say, and elements whose text belongs to the article.
CONTAINERS = frozenset("div section ul ol dl table details fieldset header center".split())
LAYOUT_WORDS = frozenset(
    "area bar block box button buttons container count form icon icons inner left link links list outer panel post posts "
    "right row site top bottom thread wrap wrapper".split()
)
KEPT_IN_ARTICLE = frozenset("math svg object".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CLOSED_BY = {
    "li": frozenset(["ul", "ol", "menu", "dir"]),
    "dt": frozenset(["dl"]),
    "dd": frozenset(["dl"]),
    "tr": frozenset(["table", "thead", "tbody", "tfoot"]),
    "td": frozenset(["tr", "table"]),
    "th": frozenset(["tr", "table"]),
    "option": frozenset(["select", "optgroup"]),
}
MAIN, PLAIN, DROPPED = 0, 1, 2
# Share of the plain lines of two pages from which they may be copies rather than pages of one template.
COPY_SHARE = 0.9
# How hard the lines of a page are packed for the exchange, 1 to 9.
PACK_LEVEL = 6


@dataclass
class Page:
    lines: list[str]
    zones: list[int]


def _chrome_class(token: str) -> bool:
    """A class that names boilerplate by itself: ``share``, ``share-buttons``, but not ``share-of-votes``."""
    parts = re.split(r"[-_]+", token.strip("-_"))
    return token in CHROME_WORDS or not CHROME_WORDS.isdisjoint(parts) and CHROME_WORDS | LAYOUT_WORDS >= set(parts)


def _boilerplate(name: str, rest: str, in_main: bool) -> bool:
    if name in CHROME and not (in_main and name in KEPT_IN_ARTICLE) or name == "header" and not in_main:
        return True
    if not rest or name in ("html", "body"):
        return False
    for key, value in ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'").lower()
        if in_main and key in ("class", "id"):
            # ids are made from titles, and single words of a class say little about a part of the text
            if key == "class" and name in CONTAINERS and any(map(_chrome_class, value.split())):
                return True
        elif key in ("class", "id"):
            words = value.split()
            if any(w in CHROME_WORDS or any(p in CHROME_WORDS for p in re.split(r"[-_]+", w)) for w in words):
                return True
        elif key == "role" and value in CHROME_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        elif key == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def parse(text: str) -> Page:
    """Blocks of a page in order, with the zone each stands in.

    ``MAIN``: in an article (without any, in a main element); ``PLAIN``:
    elsewhere in the body; ``DROPPED``: in boilerplate by its markup. Scripts,
    styles, comments and the head give no line. Inside an article or main
    element only a container with a class for boilerplate, an element that is
    none of the text, a role or a hidden state drops text, never an id.
    """
    lines: list[str] = []
    spots: list[tuple[bool, bool, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []
    buffer: list[str] = []
    dropped = article = main = False
    at, end = 0, len(text)

    def flush() -> None:
        if buffer:
            if block := " ".join(html.unescape("".join(buffer)).split()):
                lines.append(block)
                spots.append((dropped, article, main))
            buffer.clear()

    def inline(name: str) -> bool:
        """Formulas of an article stand in its sentences."""
        return name == "math" and (article or main) and not dropped

    while at < end:
        token = TOKEN.match(text, at)
        if token is None:  # cannot happen: the last alternative takes any character
            break
        at = token.end()
        piece, name = token["text"], token["name"]
        if piece is not None:
            buffer.append(piece)
            continue
        if name is None:
            continue
        name = name.lower()
        if token["close"]:
            if name in BLOCKS or name in CHROME and not inline(name):
                flush()
            elif name == "text":
                buffer.append(" ")
            if any(s[0] == name for s in stack):
                while (popped := stack.pop())[0] != name:
                    pass
                dropped, article, main = popped[1:]
            continue
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(text, at)
            at = close.start() if close else end
            continue
        if name == "br":
            buffer.append(" ")
            continue
        if name in BLOCKS or name in CHROME and not inline(name):
            flush()
            if stack and stack[-1][0] == "p":
                dropped, article, main = stack.pop()[1:]
            if name in CLOSED_BY:
                k = len(stack) - 1
                while k >= 0 and stack[k][0] not in CLOSED_BY[name] and stack[k][0] != name:
                    k -= 1
                if k >= 0 and stack[k][0] == name:
                    dropped, article, main = stack[k][1:]
                    del stack[k:]
        if name in VOID or token["rest"].endswith("/") and name not in BLOCKS:
            continue
        if name in BLOCKS or name in CHROME or token["rest"]:
            stack.append((name, dropped, article, main))
            dropped = dropped or _boilerplate(name, token["rest"], article or main)
            if not dropped:
                article = article or name == "article"
                main = main or name == "main" or "role=\"main\"" in token["rest"]
    flush()
    inner = 1 if any(s[1] and not s[0] for s in spots) else 2
    return Page(lines, [DROPPED if s[0] else MAIN if s[inner] else PLAIN for s in spots])


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence of lines.

    Equal ends are matched first; the rest by increasing runs over the places
    of equal lines, so that time follows the number of equal pairs.
    """
    low, high_a, high_b = 0, len(a), len(b)
    while low < high_a and low < high_b and a[low] == b[low]:
        low += 1
    while high_a > low and high_b > low and a[high_a - 1] == b[high_b - 1]:
        high_a -= 1
        high_b -= 1
    matched = set(range(low)) | set(range(high_a, len(a)))
    where: dict[str, list[int]] = {}
    for k in range(low, high_b):
        where.setdefault(b[k], []).append(k)
    tails: list[int] = []
    links: list[tuple] = []
    for i in range(low, high_a):
        for j in reversed(where.get(a[i], ())):
            at = bisect.bisect_left(tails, j)
            link = (i, links[at - 1] if at else None)
            if at == len(tails):
                tails.append(j)
                links.append(link)
            elif j < tails[at]:
                tails[at] = j
                links[at] = link
    link = links[-1] if links else None
    while link:
        matched.add(link[0])
        link = link[1]
    return matched


def _near_copy(page: Page, other: Page, shared: set[int]) -> bool:
    """Nearly all plain lines of either page stand in the other, so that text may be shared, not only the template."""
    own = [k for k, zone in enumerate(page.zones) if zone == PLAIN]
    common = sum(k in shared for k in own)
    return common >= COPY_SHARE * max(len(own), other.zones.count(PLAIN))


def main_text(page: Page, neighbour: Page | None, other: Page | None = None) -> tuple[str, int]:
    """Main text of a page and the number of its lines that the neighbour shares.

    The neighbour's lines are deleted first; those of ``other``, the page on the
    other side, if the neighbour is nearly a copy and ``other`` is not. Of what
    is left, boilerplate by its markup goes, and article lines come back.
    Without a different page to compare with, the markup alone decides.
    """
    near = [p for p in (neighbour, other) if p and p.lines != page.lines]
    shares = [common_lines(page.lines, p.lines) for p in near[:1]]
    if len(near) > 1 and _near_copy(page, near[0], shares[0]):
        shares.append(common_lines(page.lines, near[1].lines))
        if not _near_copy(page, near[1], shares[1]):
            shares.reverse()
    shared = shares[0] if shares else set()
    # lines beside an article are only text if a template was found and they are not of it
    outside = bool(shared) or MAIN not in page.zones
    kept = [
        line
        for k, (line, zone) in enumerate(zip(page.lines, page.zones))
        if zone == MAIN or zone == PLAIN and outside and k not in shared
    ]
    return "\n".join(kept), len(shared)


def _shared_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


@dataclass
class Run:
    """Consecutive pages of a host with the same lines."""

    host: str
    page: Page
    first: str
    last: str
    rows: list[tuple]

    def text(self, before: Run | None, after: Run | None) -> tuple[str, int]:
        """Main text by the nearer of two runs, the one after if both are as near."""
        found = [(_shared_prefix(self.last, after.first), 1, after.page)] if after else []
        found += [(_shared_prefix(before.last, self.first), 0, before.page)] if before else []
        return main_text(self.page, *[p for _, _, p in sorted(found, key=lambda x: x[:2], reverse=True)] or [None])


def _packed(lines: list[str]) -> bytes:
    return zlib.compress("\n".join(lines).encode(), PACK_LEVEL)


def _unpacked(packed: bytes) -> list[str]:
    return zlib.decompress(packed).decode().split("\n")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Run]:
    run = None
    for batch in batches:
        for page_id, url, host, path, packed, zones in zip(
            *(batch.column(c).to_pylist() for c in ("_id", "url", "_host", "_path", "_lines", "_zones"))
        ):
            page = Page(_unpacked(packed) if zones else [], [int(z) for z in zones])
            if run and run.host == host and run.page == page:
                run.last = path
                run.rows.append((page_id, url))
                continue
            if run:
                yield run
            run = Run(host, page, path, path, [(page_id, url)])
    if run:
        yield run


# What one pass over a range gives: finished pages, pages whose run may go on in another range, and runs at the ends.
DONE, OPEN, BORDER = range(3)
_MADE = (
    "kind int, page_id {}, url string, text string, n_chars long, n_shared long, part int, place long, edge boolean, "
    "host string, first string, last string, lines array<string>, zones array<int>"
)
_RUN = ("part", "place")


def _difference(id_type: pa.DataType):
    """One pass over the pages of one range of (host, path), in order; a few runs are held at a time.

    Runs between two others are decided here. The pages of the first and the
    last run are passed on ``OPEN``, with the run's place in the range; these two
    runs and the ones next to them are passed on as ``BORDER`` with their lines.
    """
    kinds = [pa.int32(), id_type, pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_()]
    kinds += [pa.string()] * 3 + [pa.list_(pa.string()), pa.list_(pa.int32())]
    names = [part.split()[0] for part in _MADE.format("x").split(", ")]

    def rows(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: dict[int, Run] = {}  # the runs at the beginning, and the last two so far
        out: list[tuple] = []
        n = 0

        def pages(place: int, text: str | None = None, shared: int | None = None) -> Iterator[pa.RecordBatch]:
            kind, size = (OPEN, None) if text is None else (DONE, len(text))
            for page_id, url in held[place].rows:
                out.append((kind, page_id, url, text, size, shared, part, place, *[None] * 6))
                if len(out) >= 512:
                    yield rows(out)
                    out.clear()
            held[place].rows = []

        for found in _runs(batches):
            held[n] = found
            if n == 1:
                yield from pages(0)
            if n > 1:
                sides = (held[k] if held[k].host == held[n - 1].host else None for k in (n - 2, n))
                yield from pages(n - 1, *held[n - 1].text(*sides))
            if n > 3:
                del held[n - 2]
            n += 1
        if n:
            yield from pages(n - 1)
        for place, r in held.items():
            edge = place in (0, n - 1)
            own = (r.host, r.first, r.last, r.page.lines, r.page.zones)
            out.append((BORDER, *[None] * 5, part, place, edge, *own))
        if out:
            yield rows(out)

    return run


_LINK = (
    "part int, place long, host string, first string, last string, before_part int, before_place long, before_last string, "
    "after_part int, after_place long, after_first string"
)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each run at an end of a range, in order: its extent over ranges, and the different runs before and after it.

    Reads at most four narrow rows a range; equal neighbours of a host are one run.
    """
    group: dict | None = None
    before: dict | None = None

    def close(after: dict | None) -> list[tuple]:
        prev = before if before and before["host"] == group["host"] else None
        nxt = after if after and after["host"] == group["host"] else None
        sides = (*prev["at"], prev["last"]) if prev else (None,) * 3
        sides += (*nxt["at"], nxt["first"]) if nxt else (None,) * 3
        return [(*at, group["host"], group["first"], group["last"], *sides) for at in group["edges"]]

    def rows(made: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int64()] + [pa.string()] * 3 + [pa.int32(), pa.int64(), pa.string()] * 2
        names = [part.split()[0] for part in _LINK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)

    for batch in batches:
        for r in batch.to_pylist():
            at = (r["part"], r["place"])
            if group and (group["host"], group["same"]) == (r["host"], r["same"]):
                group["last"] = r["last"]
            else:
                new = dict(host=r["host"], same=r["same"], first=r["first"], last=r["last"], at=at, edges=[])
                if group:
                    if made := close(new):
                        yield rows(made)
                    before = group
                group = new
            if r["edge"]:
                group["edges"].append(at)
    if group and (made := close(None)):
        yield rows(made)


def _border_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the linked runs."""

    def side(r: dict, name: str) -> Run | None:
        if r[f"{name}_lines"] is None:
            return None
        page = Page(r[f"{name}_lines"], r[f"{name}_zones"])
        return Run(r["host"], page, r.get(f"{name}_first") or "", r.get(f"{name}_last") or "", [])

    for batch in batches:
        for at in range(batch.num_rows):
            r = batch.slice(at, 1).to_pylist()[0]
            own = Run(r["host"], Page(r["lines"], r["zones"]), r["first"], r["last"], [])
            text, shared = own.text(side(r, "before"), side(r, "after"))
            made = (r["part"], r["place"], text, len(text), shared)
            kinds = (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(made, kinds)], names=[*_RUN, "text", "n_chars", "n_shared"]
            )


def border_texts(border: DataFrame) -> DataFrame:
    """``part``, ``place``, ``text``, ``n_chars``, ``n_shared`` of the runs at the ends of ranges.

    Which runs are neighbours is found on narrow rows, a few per range; lines
    are fetched by range and place, so no host gathers them in one task.
    """
    same = F.xxhash64("lines", "zones")
    narrow = border.select(*_RUN, "edge", "host", "first", "last", same.alias("same"))
    links = narrow.repartition(1).sortWithinPartitions(*_RUN).mapInArrow(_linked, _LINK)
    for name in ("", "before_", "after_"):
        theirs = border.select(
            *[F.col(c).alias(f"_{c}") for c in _RUN], F.col("lines").alias(f"{name}lines"), F.col("zones").alias(f"{name}zones")
        )
        on = [F.col(f"{name}{c}") == F.col(f"_{c}") for c in _RUN]
        links = links.join(theirs, on, "left").drop(*[f"_{c}" for c in _RUN])
    return links.mapInArrow(_border_texts, "part int, place long, text string, n_chars long, n_shared long")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*", "")


def extract_pages(pages: DataFrame, id_column: str = "page_id") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``, ``n_shared`` of every row of ``pages`` (url, html).

    ``text``: the blocks of the main text in page order, white space within a
    block as one blank, character references decoded, joined by a newline: the
    lines outside of boilerplate that the nearest page of the host does not
    share, and all lines of an article element. ``n_shared``: lines shared with
    that page, of any zone. The nearest page is the one before or after by path
    with the longer common path, whatever task's range holds it; pages with the
    same lines are passed over, and nearly equal ones if the page on the other
    side is none. A page without such a neighbour gives its article or, without
    one, all lines outside of boilerplate. A null or empty html gives an empty
    text, a null url belongs to the host of no name; repeated rows stay, and
    other columns are ignored. An empty table gives an empty one.
    """
    kind = pages.schema[id_column].dataType
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select(
        F.col(id_column).alias("_id"),
        "url",
        host_of(F.col("url")).alias("_host"),
        path_of(F.col("url")).alias("_path"),
        F.coalesce("html", F.lit("")).alias("_html"),
    )
    keys = ["_host", "_path", "_id"]
    columns = ["_id", "url", "_host", "_path"]

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_html"):
            found = [parse(text) for text in batch.column("_html").to_pylist()]
            made = [
                pa.array((_packed(p.lines) for p in found), pa.binary()),
                pa.array(("".join(map(str, p.zones)) for p in found), pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *made], [*columns, "_lines", "_zones"])

    # lines without markup, packed page by page, are what is dealt out
    parsed = rows.mapInArrow(
        lines, f"_id {kind.simpleString()}, url string, _host string, _path string, _lines binary, _zones string"
    )
    sorted_ = parsed.repartitionByRange(n, *keys).sortWithinPartitions(*keys, F.xxhash64("_lines", "_zones"))
    # one pass over the sorted pages, written once: what follows does not depend on how they fall into ranges
    made = materialise(
        sorted_.mapInArrow(_difference(to_arrow_type(kind)), _MADE.format(kind.simpleString())), "extracted"
    )
    result = ["page_id", "url", "text", "n_chars", "n_shared"]
    texts = border_texts(made.where(F.col("kind") == BORDER))
    left = made.where(F.col("kind") == OPEN).select("page_id", "url", *_RUN)
    found = made.where(F.col("kind") == DONE).select(*result).unionByName(left.join(texts, list(_RUN)).select(*result))
    return found if id_column == "page_id" else found.withColumnRenamed("page_id", id_column)
