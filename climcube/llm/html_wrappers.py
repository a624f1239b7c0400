"""Main text of web pages by wrappers that are inferred from pages of the same host.

A wrapper is a union-free regular expression over tags and text slots, kept as a tree: every node
stands once, may be optional, and may repeat.  Within a page, neighbours with the same
label, and groups of two or three labels that recur at once, are folded into a repeated node.
Two wrappers are aligned level by level: nodes with the same label in order are merged, a node that
one side lacks becomes optional, and what is then repeated is folded again.  Text is a slot in the
node where it stands; a slot knows how much text and link text it held on how many pages, and
whether the text was always the same.

Tasks fold their pages into a wrapper per host; these are merged first by host and a salt, then by
host, as streams over sorted partitions with one wrapper in memory.  So every page takes part, a hot host
is spread over tasks, and no group is gathered.  Copies of a page count once: they are no evidence that a
text is the same everywhere.  From a host's wrapper the slots of the main text are
chosen: those outside menus, headers, footers, sidebars, notices, adverts, forms and comments, inside
the article where the host has one, else wherever a slot is neither constant nor link-heavy.

Defined cases: a null or empty page has an empty text; pages without a host share one wrapper; a page on
which the wrapper's slots are all empty is judged by its own slots; nodes nested deeper than
``MAX_DEPTH`` count as children of that depth; wrappers stop taking in new nodes at ``MAX_NODES``, and
all further slots are added up by host and path and judged per path; rows that repeat are extracted each;
empty tables give no rows; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, small_batches, text_or_empty
from .urls import host_of

MAX_DEPTH = 60
MAX_NODES = 3000
SALTS = 32
#: Different pages that show a text to be the same everywhere.
EVIDENCE = 3
#: Alignments keep one row of so many.
KEPT_ROWS = 256
#: Wrappers that a task holds before it hands them on.
HELD = 4000

#: Raw text up to the end tag; comments, declarations; tags.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|math|xmp|noembed)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s>/]*)[^>]*(?:>|\Z)"
    r"|<(?P<tag>[a-zA-Z][^\s>/]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag of the key closes an open one of the values, as browsers do.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
}
#: Block elements end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SKIPPED = frozenset(
    "head nav header footer aside form menu button select option input dialog script style noscript template iframe "
    "object embed audio video canvas svg".split()
)
SKIPPED_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|banners?|promos?|nav|navbar|navigation|menus?|"
    r"breadcrumbs?|header|masthead|footer|sidebars?|side-bar|aside|widgets?|cookies?|consent|notices?|alerts?|"
    r"notifications?|popups?|modal|overlay|newsletter|subscribe|signup|login|search|comments?|commentlist|respond|"
    r"replies|reply|disqus|share|sharing|social|related|recommended|toolbar|pagination|pager|copyright)(?:$|[\s_-])",
    re.I,
)
SKIPPED_ROLE = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog form menu menubar".split())
ARTICLE = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story)(?:[_-]?(?:body|content|text))?(?:$|[\s])|^(?:main|content)$", re.I)


Path = tuple[str, ...]


def _label(tag: str, attrs: str) -> str:
    """The tag with what matters of its attributes: ! is skipped, * is an article, then its class without digits."""
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attrs)} if attrs.strip(" /") else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".strip()
    if (
        tag in SKIPPED or found.get("role", "").lower() in SKIPPED_ROLE or "hidden" in found
        or found.get("aria-hidden") == "true" or (names and SKIPPED_NAME.search(names))
    ):
        mark = "!"
    elif tag in ("article", "main") or found.get("role") in ("main", "article") or found.get("itemprop") == "articleBody" or any(
        ARTICLE.search(x) for x in names.split()
    ):
        mark = "*"
    else:
        mark = ""
    return f"{mark}{tag}.{re.sub(r'[0-9/]+', '', found.get('class', ''))}".rstrip(".")


def blocks_of(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """Path of labels, text and length of link text of every block, in page order."""
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, str]] = []  # tag, label
    texts: list[str] = []
    linked = 0
    in_link = 0
    hidden: list[str] = []  # open inline elements that are skipped

    def end_block() -> None:
        nonlocal linked
        if texts:
            text = " ".join(html.unescape("".join(texts)).split())
            texts.clear()
            if text:
                out.append((tuple(x[1] for x in stack[:MAX_DEPTH]), text, linked))
        linked = 0

    def close(upto: int) -> None:
        end_block()
        del stack[upto:]

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at and not hidden:
            texts.append(page[at : m.start()])
            linked += (m.start() - at) if in_link else 0
        at = m.end()
        if m["end"]:
            tag = m["end"].lower()
            if tag in INLINE:
                in_link -= tag == "a" and in_link > 0
                if hidden and hidden[-1] == tag:
                    hidden.pop()
                continue
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            else:
                end_block()
        elif m["tag"]:
            tag, attrs = m["tag"].lower(), m["attrs"]
            if tag in INLINE:
                in_link += tag == "a" and not in_link
                if hidden and tag == hidden[-1] or attrs and "!" in _label("span", attrs)[:1]:
                    hidden.append(tag)
                continue
            if tag in VOID:
                texts.append(" ")
                continue
            in_link, hidden = 0, []
            if tag in ENDS_P and any(x[0] == "p" for x in stack):
                close(max(i for i, x in enumerate(stack) if x[0] == "p"))
            elif stack and stack[-1][0] in CLOSES.get(tag, ()):
                close(len(stack) - 1)
            end_block()
            stack.append((tag, _label(tag, attrs)))
    if at < len(page) and not hidden:
        texts.append(page[at:])
    end_block()
    return out


# A node is [label, optional, repeated, children, slot]; a slot is [pages, characters, characters in links,
# digest of the text or -1 if it differs], its pages being the digests of up to ``EVIDENCE`` of them, smallest first.


def _new(label: str) -> list:
    return [label, 0, 0, [], [[], 0, 0, 0]]


def _add_slot(a: list, b: list) -> None:
    if b[0]:
        a[3] = b[3] if not a[0] or a[3] == b[3] else -1
        a[0] = a[0] if a[0] == b[0] else sorted({*a[0], *b[0]})[:EVIDENCE]
        a[1], a[2] = a[1] + b[1], a[2] + b[2]


def _merge(a: list, b: list, path: Path = (), rest: dict[Path, list] | None = None) -> list:
    a[1], a[2] = a[1] | b[1], a[2] | b[2]
    _add_slot(a[4], b[4])
    a[3] = align(a[3], b[3], path, rest)
    return a


def _hand_on(node: list, path: Path, rest: dict[Path, list]) -> None:
    """Add the slots of a subtree to ``rest``."""
    path = (*path, node[0])
    if node[4][0]:
        _add_slot(rest.setdefault(path, [[], 0, 0, 0]), node[4])
    for x in node[3]:
        _hand_on(x, path, rest)


def _fold(nodes: list[list]) -> list[list]:
    """Neighbours with equal labels, singly or in groups of up to three, become one repeated occurrence."""
    out: list[list] = []
    for node in nodes:
        out.append(node)
        shrunk = True
        while shrunk:
            shrunk = False
            for n in (1, 2, 3):
                if len(out) >= 2 * n and all(out[-n + i][0] == out[-2 * n + i][0] for i in range(n)):
                    for i in range(n):
                        _merge(out[-2 * n + i], out[-n + i])[2] = 1
                    del out[-n:]
                    shrunk = True
                    break
    return out


def _best(a: list[list], b: list[list]) -> Callable[[int, int], int]:
    """Function of i and j: length of the longest common sequence of labels of a[i:] and b[j:]; i must not decrease.

    A row is an integer whose bits tell where its lengths do not grow.  Every ``KEPT_ROWS``-th row is
    kept, and those between two kept ones are computed again when they are asked for.
    """
    n, m = len(a), len(b)
    every = (1 << m) - 1
    places: dict[str, int] = {}
    for j, y in enumerate(reversed(b)):
        places[y[0]] = places.get(y[0], 0) | 1 << j

    def above(row: int, i: int) -> int:
        common = row & places.get(a[i][0], 0)
        return (row + common | row - common) & every

    kept, row = {n: every}, every
    for i in range(n - 1, -1, -1):
        row = above(row, i)
        if i % KEPT_ROWS == 0:
            kept[i] = row
    rows: dict[int, int] = {}

    def best(i: int, j: int) -> int:
        if i not in rows:
            start = i - i % KEPT_ROWS
            end = min(n, start + KEPT_ROWS)
            rows.clear()
            rows[end] = kept[end]
            for k in range(end - 1, start - 1, -1):
                rows[k] = above(rows[k + 1], k)
            if i == n:
                rows[n] = every
        return m - j - (rows[i] & (1 << m - j) - 1).bit_count()

    return best


def align(a: list[list], b: list[list], path: Path = (), rest: dict[Path, list] | None = None) -> list[list]:
    """Children of two nodes, which stand at the path, as one sequence; with ``rest``, it takes in what only b has."""
    if [x[0] for x in a] == [x[0] for x in b]:
        return [_merge(x, y, (*path, x[0]), rest) for x, y in zip(a, b, strict=True)]
    n, m = len(a), len(b)
    best = _best(a, b)
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append(_merge(a[i], b[j], (*path, a[i][0]), rest))
            i, j = i + 1, j + 1
        elif j == m or i < n and best(i + 1, j) >= best(i, j + 1):
            a[i][1] = 1
            out.append(a[i])
            i += 1
        else:
            if rest is None:
                b[j][1] = 1
                out.append(b[j])
            else:
                _hand_on(b[j], path, rest)
            j += 1
    return _fold(out)


def wrapper_of(blocks: list[tuple[tuple[str, ...], str, int]]) -> list:
    """A page's own wrapper."""
    root = _new("")
    open_nodes = [root]
    before: tuple[str, ...] = ()
    digest = int.from_bytes(hashlib.blake2b(repr(blocks).encode("utf-8", "replace"), digest_size=7).digest())
    for path, text, linked in blocks:
        same = 0
        while same < min(len(path), len(before)) and path[same] == before[same]:
            same += 1
        # The same path again is a new occurrence of its last node.
        same = min(same, len(path) - 1) if path == before and path else same
        del open_nodes[same + 1 :]
        for label in path[same:]:
            node = _new(label)
            open_nodes[-1][3].append(node)
            open_nodes.append(node)
        _add_slot(open_nodes[-1][4], [[digest], len(text), min(linked, len(text)), zlib.crc32(text.encode())])
        before = path

    def folded(node: list) -> list:
        node[3] = _fold([folded(x) for x in node[3]])
        return node

    return folded(root)


def _size(node: list) -> int:
    return 1 + sum(map(_size, node[3]))


def merged(a: list | None, b: list, rest: dict[Path, list] | None = None) -> list:
    """Both as one; above ``MAX_NODES``, ``rest`` takes the slots of nodes that a does not have."""
    if a is None:
        return b
    return _merge(a, b, (), rest if _size(a) + _size(b) > 2 * MAX_NODES else None)


def expression(node: list) -> str:
    """The wrapper as a regular expression, to read."""
    inner = ("#" if node[4][0] else "") + "".join(map(expression, node[3]))
    if not node[0]:
        return inner
    mark = ("+" if node[2] else "") + ("?" if node[1] else "")
    return f"(<{node[0]}>{inner}</>){mark}" if mark else f"<{node[0]}>{inner}</>"


def _skipped(path: tuple[str, ...]) -> bool:
    return any(x[0] == "!" for x in path)


def _in_article(path: tuple[str, ...]) -> bool:
    return any(x[0] == "*" for x in path)


def slots_of(wrapper: list) -> dict[Path, list[list]]:
    """Slots by path, without those that are skipped."""
    found: dict[Path, list[list]] = {}

    def walk(node: list, path: Path) -> None:
        if node[4][0] and not _skipped(path):
            found.setdefault(path, []).append(node[4])
        for x in node[3]:
            walk(x, (*path, x[0]))

    walk(wrapper, ())
    return found


def _good(slot: list) -> bool:
    return 2 * slot[2] <= slot[1] and not (len(slot[0]) >= EVIDENCE and slot[3] != -1)


def judged(wrapper: list, rest: Iterable[tuple[Path, list]] = ()) -> tuple[bool, set[Path], set[Path]]:
    """Whether there is an article; if not, the paths of the slots that hold the main text and of the others.

    A path of which ``rest`` has a part is judged as one slot with all that was seen of it.  Paths of
    the rest that stand on one page only are not listed, as that page says as much about them.
    """
    found = slots_of(wrapper)
    article, good = any(map(_in_article, found)), False
    for path, slot in rest:
        if _skipped(path):
            continue
        article = article or _in_article(path)
        if path in found:
            whole = [[], 0, 0, 0]
            for x in (*found[path], slot):
                _add_slot(whole, x)
            found[path] = [whole]
        elif len(slot[0]) > 1:
            found[path] = [slot]
        else:
            good = good or _good(slot)
    if article:
        return True, set(), set()
    kept = {p for p, slots in found.items() if any(map(_good, slots))}
    return (False, kept, found.keys() - kept) if kept or good else (False, set(found), set())


def main_text(page: str, choice: tuple[bool, set[Path], set[Path]]) -> str:
    blocks = blocks_of(page)
    article, kept, others = choice
    takes = {p: not _skipped(p) and (_in_article(p) or not article and p in kept) for p, _, _ in blocks}
    unknown = {} if article else {p: [[], 0, 0, 0] for p in takes if p not in kept and p not in others and not _skipped(p)}
    if unknown:
        for p, text, linked in blocks:
            if p in unknown:
                _add_slot(unknown[p], [[0], len(text), min(linked, len(text)), 0])
        takes |= {p: _good(slot) for p, slot in unknown.items()}
    out = [t for p, t, _ in blocks if takes[p]]
    if not out and blocks:
        article, kept, _ = judged(wrapper_of(blocks))
        out = [t for p, t, _ in blocks if p in kept or article and _in_article(p) and not _skipped(p)]
    return " ".join(out)


# Rows are (host, path, salt, value): a wrapper with an empty path, or the slot of a path that is in a rest.


def _rest_rows(rest: dict[tuple[str, Path], list], salt: int) -> list[tuple[str, str, int, str]]:
    rows = [(host, json.dumps(path), salt, json.dumps(slot)) for (host, path), slot in rest.items()]
    rest.clear()
    return rows


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str, int, str]]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in _NAMES), strict=True)


def _fold_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper or slot for each run of equal (host, path, salt) in a sorted partition."""
    out: list[tuple[str, str, int, str]] = []
    for (host, path, salt), run in groupby(_rows(batches), key=lambda r: r[:3]):
        total, rest = None, {}
        for *_, value in run:
            value = json.loads(value)
            if path:
                total = total or [[], 0, 0, 0]
                _add_slot(total, value)
                continue
            total = merged(total, value, rest)
            if len(rest) >= HELD:
                yield _batch(_rest_rows({(host, p): x for p, x in rest.items()}, salt))
                rest.clear()
        out += [(host, path, salt, json.dumps(total)), *_rest_rows({(host, p): x for p, x in rest.items()}, salt)]
        if len(out) >= (HELD if path else 1):
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


_NAMES, _SCHEMA = ["host", "path", "salt", "value"], "host string, path string, salt int, value string"


def _batch(rows: list[tuple[str, str, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = (pa.string(), pa.string(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _NAMES)


def wrappers(pages: DataFrame) -> DataFrame:
    """host, path, salt, value: a wrapper (JSON) per host, and the slots by path that it did not take in, in parts."""
    small_batches(pages.sparkSession)

    def of_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        rest: dict[tuple[str, Path], list] = {}

        def handed() -> pa.RecordBatch:
            rows = [(host, "", n % SALTS, json.dumps(w)) for n, (host, w) in enumerate(held.items(), salt)]
            held.clear()
            return _batch(rows)

        salt = 0
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("_html"), strict=True):
                page = page.as_py()
                salt = salt or zlib.crc32(page.encode()) % SALTS
                more: dict[Path, list] = {}
                held[host] = merged(held.get(host), wrapper_of(blocks_of(page)), more)
                for path, slot in more.items():
                    _add_slot(rest.setdefault((host, path), [[], 0, 0, 0]), slot)
            if len(held) >= HELD:
                yield handed()
            if len(rest) >= HELD:
                yield _batch(_rest_rows(rest, salt))
        if rest:
            yield _batch(_rest_rows(rest, salt))
        if held:
            yield handed()

    rows = pages.select(host_of(F.col("url")).alias("host"), text_or_empty("html").alias("_html"))
    # Equal pages of a host meet in the task that reads them first, so many copies are no large group.
    rows = rows.withColumn("_digest", F.sha2("_html", 256)).dropDuplicates(["host", "_digest"])
    rows = rows.select("host", "_html").mapInArrow(of_pages, _SCHEMA)
    rows = rows.repartition("host", "path", "salt").sortWithinPartitions(*_NAMES).mapInArrow(_fold_runs, _SCHEMA)
    rows = rows.withColumn("salt", F.lit(0)).repartition("host", "path").sortWithinPartitions(*_NAMES)
    return rows.mapInArrow(_fold_runs, _SCHEMA)


def chosen_slots(wrapped: DataFrame) -> DataFrame:
    """host, slots (JSON): what ``judged`` says of each host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for host, rows in groupby(_rows(batches), key=lambda r: r[0]):
            wrapper = json.loads(next(rows)[3])  # its path is empty, so it comes first

            def rest(rows: Iterator = rows) -> Iterator[tuple[Path, list]]:
                for path, parts in groupby(rows, key=lambda r: r[1]):
                    total = [[], 0, 0, 0]
                    for *_, slot in parts:
                        _add_slot(total, json.loads(slot))
                    yield tuple(json.loads(path)), total

            article, kept, others = judged(wrapper, rest())
            slots = json.dumps([article, sorted(kept), sorted(others)])
            yield pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([slots], pa.string())], ["host", "slots"])

    return wrapped.repartition("host").sortWithinPartitions(*_NAMES).mapInArrow(run, "host string, slots string")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars; a row for each page row."""
    known = cut(chosen_slots(wrappers(pages)))
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), text_or_empty("html").alias("_html"))
    rows = rows.join(broadcast_if_small(known, 20_000), "host", "left").select("page_id", "url", "_html", "slots")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, tuple[bool, set, set]] = {}
        for batch in batches:
            texts = []
            for page, slots in zip(batch.column("_html"), batch.column("slots").to_pylist(), strict=True):
                if slots not in read:
                    if len(read) >= HELD:
                        read.clear()
                    article, kept, others = json.loads(slots)
                    read[slots] = article, set(map(tuple, kept)), set(map(tuple, others))
                texts.append(main_text(page.as_py(), read[slots]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    out = rows.mapInArrow(run, f"{kinds}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
