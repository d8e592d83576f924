"""Main text of web pages by template deduction over the pages of a host.

A page is a sequence of tokens: its structural elements, each with the path of elements that holds
it, and its text blocks with their paths.  Tokens that occur equally often in each page of a host have
the same occurrence vector; vectors are compared by a commutative hash, the sum of a hash of the
page and the occurrences, so no list of pages is gathered for any token.  Pages with equal html
count once.  The tokens of one vector that most pages of the host have are an equivalence class.  A class is
valid if its tokens come in one order on all pages and its occurrences nest with those of the
other classes: of two that cross, the one with fewer tokens is not valid.

The valid classes are the template; their texts are no main text (an article or main element is content, its
texts are no tokens).  What remains lies in slots,
told apart by the template element around a block and the template token before it.  Slots
inside menus, headers, footers, sidebars, notices, adverts, forms or comments (by element, class, id
or role) are left out.  Of the others, those that hold an article or main element are taken, or else
those of the template element that holds most of the host's text outside of links.

A host with fewer than ``TEMPLATE_PAGES`` different pages has no template: nothing tells its repeated
tokens from chance.  Its pages are read in their article or main element, or else wherever
they are not marked as something else.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Collection, Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallgrass.llm.url_filter import host_of
from tallgrass.plans.lineage import cut_lineage

#: Elements that structure a page; each is a step of a path.
CONTAINERS = frozenset(
    "html body div section article main nav header footer aside form ul ol dl table thead tbody tfoot tr td th "
    "figure figcaption details summary dialog fieldset blockquote center".split()
)
#: Elements that begin and end a block of text.
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr address caption legend option noscript hgroup search menu".split())
#: Elements whose content is never text of the page.
SILENT = frozenset("script style template noscript svg math iframe object canvas audio video select textarea button head title datalist".split())
#: Of these, the content is not even markup.
RAW = frozenset("script style title textarea iframe noscript".split())
#: Elements and names that mark what is not main text.
ASIDE_ELEMENTS = frozenset("nav header footer aside form dialog menu search".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar alertdialog".split())
ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu "
    "header masthead footer sidebar rail breadcrumb breadcrumbs cookie cookies consent gdpr notice notification alert popup modal overlay "
    "newsletter subscribe subscription signup login form share sharing social comment comments disqus reply replies discussion related "
    "recommended recommendations widget pagination pager toolbar copyright skip".split()
)
#: Share of a host's different pages that a template token must be in, and the number of pages a host must have for that.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.6, 8
#: Steps of a path; elements deeper inside have the path of the last step, their texts stay whole.
DEPTH = 512
#: Bytes of templates that may be broadcast; more are joined by host.
BROADCAST_BYTES = 16 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d{3,}")


def _step(tag: str, attributes: str) -> tuple[str, bool]:
    """Name of an element in a path, and whether it marks something other than main text."""
    name, aside = tag, tag in ASIDE_ELEMENTS
    if attributes and not attributes.isspace():
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key in ("class", "id") and value:
                # long numbers in names are those of the page
                name += ("." if key == "class" else "#") + _DIGITS.sub("0", " ".join(value.split()))
                words = re.split(r"[\s_\-]+", value)
                aside |= any(w in ASIDE_NAMES or _NAME.match(w) is not None and _NAME.match(w)[0] in ASIDE_NAMES and w[len(_NAME.match(w)[0]):].isdigit() for w in words)
            elif key == "role":
                aside |= value in ASIDE_ROLES
            elif key == "hidden" or value == "true":
                aside = True
    return name, aside


def events_of(page: str) -> list[tuple[str, bool, str | None, int]]:
    """Elements and text blocks in page order: path, aside, text (none: the element opens), characters in links."""
    out: list[tuple[str, bool, str | None, int]] = []
    stack: list[tuple[str, str, bool]] = []  # element, path, aside
    text: list[str] = []
    state = ["", False]
    linked = link_depth = 0

    def close() -> None:
        nonlocal linked
        block = _SPACE.sub(" ", _html.unescape("".join(text))).strip()
        text.clear()
        if block:
            out.append((state[0], state[1], block, linked))
        linked = 0

    at, size, silent = 0, len(page), ""
    while at < size:
        token = _TOKEN.search(page, at)
        begin = token.start() if token else size
        if begin > at and not silent:
            text.append(page[at:begin])
            if link_depth:
                linked += begin - at
        if token is None:
            break
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            if page.startswith("<![CDATA[", begin) and not silent:
                text.append(_html.escape(page[begin + 9:at].removesuffix("]]>"), quote=False))
            continue
        closing = bool(token[1])
        if silent:
            if closing and tag == silent:
                silent = ""
            elif silent == "head" and not closing and tag in ("body", "article", "main"):
                silent = ""
            else:
                if not closing and tag in RAW:
                    end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                    at = end.end() if end else size
                continue
            if closing:
                continue
        if not closing and tag in SILENT:
            if tag in BLOCKS or tag in ("head", "title"):
                close()
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else size
            elif not token[3].rstrip().endswith("/"):
                silent = tag
            continue
        if tag == "a":
            link_depth = 0 if closing else 1
        elif tag == "br":
            text.append(" ")
        if tag not in BLOCKS:
            continue
        close()
        if tag not in CONTAINERS:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        else:
            name, aside = _step(tag, token[3])
            if len(stack) < DEPTH:
                path = (stack[-1][1] + ">" if stack else "") + name
            else:
                path = stack[-1][1]
            stack.append((tag, path, aside or bool(stack) and stack[-1][2]))
            out.append((path, stack[-1][2], None, 0))
        state[0], state[1] = (stack[-1][1], stack[-1][2]) if stack else ("", False)
    close()
    return out


@lru_cache(maxsize=4096)
def _is_article(path: str) -> bool:
    return any(re.match(r"(article|main)\b|\w+[.#].*\b(article|main)\b", step) for step in path.split(">"))


def _token(path: str, text: str | None = None) -> int:
    """Signed 64-bit hash of an element's path, or of a text block with its path."""
    value = xxhash.xxh3_64_intdigest((path if text is None else f"{path}\n{text}").encode("utf-8", "replace"))
    return value - (1 << 64) if value >> 63 else value


def _is_token(path: str, aside: bool, text: str | None) -> bool:
    """Elements are tokens, and texts that are neither marked as something else nor in an article."""
    return text is None or not aside and not _is_article(path)


def _tokens(pages: DataFrame) -> DataFrame:
    """How often each token occurs in each page: host, token, page_key and times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int, int]] = []
            for host, key, page in zip(batch.column("host").to_pylist(), batch.column("page_key").to_pylist(), batch.column("html")):
                here = Counter(_token(*e[:3:2]) for e in events_of(page.as_py()) if _is_token(*e[:3]))
                rows += [(host, token, key, times) for token, times in here.items()]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["host", "token", "page_key", "times"])

    return pages.mapInArrow(run, "host long, token long, page_key long, times long")


def token_classes(pages: DataFrame) -> DataFrame:
    """Tokens that most pages of their host have: host, token and class, the hash of the occurrence vector.

    ``pages`` has host, page_key (a hash of the html) and html (not null).  Pages with equal html count once.
    """
    once = _tokens(pages).groupBy("host", "token", "page_key").agg(F.max("times").alias("times"))
    # sums modulo 2 ** 64; 20 digits hold any sum of 10 ** 19 pages
    vectors = once.groupBy("host", "token").agg(
        F.sum(F.xxhash64("page_key", "times").cast("decimal(20,0)")).alias("vector"), F.count(F.lit(1)).alias("pages")
    )
    sizes = pages.select("host", "page_key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    often = vectors.join(sizes.where(F.col("host_pages") >= TEMPLATE_PAGES), "host").where(F.col("pages") >= TEMPLATE_SHARE * F.col("host_pages"))
    return often.select("host", "token", F.xxhash64("vector", "pages").alias("class"))


def class_orders(tokens: list[int], classes: dict[int, int]) -> tuple[dict[int, int], set[int]]:
    """Hash of each class's order on one page, and the classes that are not valid there.

    ``classes`` has the class of each token.  The tokens of a class must come as one sequence, once or
    repeated; a sequence may hold whole sequences of other classes, but none that begins before or ends after it.
    """
    size = Counter(classes.values())
    found: dict[int, list[int]] = {}
    faulty: set[int] = set()
    begun: list[int] = []  # classes whose sequence is not complete, the innermost last
    left: dict[int, int] = {}
    for token in tokens:
        kind = classes.get(token)
        if kind is None:
            continue
        found.setdefault(kind, []).append(token)
        if kind in faulty:
            continue
        if kind not in left:
            begun.append(kind)
            left[kind] = size[kind]
        while begun[-1] != kind:
            # the innermost crosses this one
            least = min(begun[-1], kind, key=lambda c: (size[c], c))
            faulty.add(least)
            begun.remove(least)
            del left[least]
            if least == kind:
                break
        else:
            left[kind] -= 1
            if not left[kind]:
                begun.pop()
                del left[kind]
    orders = {}
    for kind, seen in found.items():
        cycle = seen[: size[kind]]
        if len(set(cycle)) < size[kind] or len(seen) % len(cycle) or cycle * (len(seen) // len(cycle)) != seen:
            faulty.add(kind)
        orders[kind] = _token("", " ".join(map(str, cycle)))
    return orders, faulty


def slots_of(events: list[tuple[str, bool, str | None, int]], template: Collection[int]) -> Iterator[tuple[int, str, str, str, int, int | None]]:
    """Text blocks not marked as something else: slot, template element around it, path, text, characters in links, token."""
    around: dict[str, str] = {"": ""}

    def element(path: str) -> str:
        holder = path
        while holder not in around and _token(holder) not in template:
            holder = holder.rpartition(">")[0]
        around[path] = around.get(holder, holder)
        return around[path]

    before = 0
    for path, aside, text, linked in events:
        token = _token(path, text) if _is_token(path, aside, text) else None
        if text is not None and not aside:
            holder = element(path)
            yield _token(holder, str(before)), holder, path, text, min(linked, len(text)), token
        if token in template:
            before = token


def _evidence(joined: DataFrame) -> DataFrame:
    """Summed for each run of pages: the order of each class (kind 0) and the text of each slot (kind 1)."""
    schema = "host long, kind int, id long, element string, low long, high long, faults long, chars long, links long, article long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            orders: dict[tuple[int, int], list[int]] = {}
            slots: dict[tuple[int, int, str], list[int]] = {}
            for host, page, tokens, kinds in zip(batch.column("host").to_pylist(), batch.column("html"), batch.column("tokens").to_pylist(), batch.column("classes").to_pylist()):
                classes = dict(zip(tokens, kinds))
                events = events_of(page.as_py())
                order, faulty = class_orders([_token(*e[:3:2]) for e in events if _is_token(*e[:3])], classes)
                for kind, value in order.items():
                    seen = orders.setdefault((host, kind), [value, value, 0])
                    seen[:] = min(seen[0], value), max(seen[1], value), seen[2] + (kind in faulty)
                for slot, holder, path, text, linked, token in slots_of(events, classes):
                    if token not in classes:
                        total = slots.setdefault((host, slot, holder), [0, 0, 0])
                        total[0] += len(text)
                        total[1] += linked
                        total[2] += len(text) if _is_article(path) else 0
            rows = [(h, 0, k, "", *v, 0, 0, 0) for (h, k), v in orders.items()] + [(h, 1, k, e, 0, 0, 0, *v) for (h, k, e), v in slots.items()]
            columns = list(zip(*rows)) or [()] * 10
            fields = [f.split() for f in schema.split(", ")]
            kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])

    summed = joined.mapInArrow(run, schema).groupBy("host", "kind", "id", "element")
    return summed.agg(F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(c).alias(c) for c in ("faults", "chars", "links", "article")])


def _by_host(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """Rows with the lists of their host; few lists are broadcast, more are joined by host."""
    size = templates.agg(F.sum(sum((F.size(c) for c in templates.columns if c != "host"), F.lit(1)))).first()[0] or 0
    return rows.join(F.broadcast(templates) if 8 * size <= BROADCAST_BYTES else templates, "host", "left")


def host_templates(pages: DataFrame) -> DataFrame:
    """One row per host that has a template: tokens of all its classes, fixed (tokens of the valid ones) and main (its main slots).

    ``pages`` has host, page_key (a hash of the html) and html (not null).  An empty table gives no
    rows.  A list is no longer than two pages of the host on average, as each of its tokens is on most pages.
    """
    classes = cut_lineage(token_classes(pages))
    lists = cut_lineage(classes.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("token", "class"))).alias("all")).select(
        "host", F.col("all.token").alias("tokens"), F.col("all.class").alias("classes")
    ))
    seen = cut_lineage(_evidence(_by_host(pages.select("host", "html"), lists).where("tokens is not null")))
    broken = seen.where("kind = 0 and (low <> high or faults > 0)").select("host", F.col("id").alias("class"))
    fixed = classes.join(broken, ["host", "class"], "left_anti").groupBy("host").agg(F.collect_list("token").alias("fixed"))
    slots = seen.where("kind = 1").select("host", F.col("id").alias("slot"), "element", "chars", "links", "article")
    # the element whose own text, not in links, is most
    best = slots.groupBy("host", "element").agg(F.sum(F.col("chars") - 2 * F.col("links")).alias("own"), F.sum("article").alias("article"))
    best = best.groupBy("host").agg(F.max(F.struct("own", "element"))["element"].alias("best"), (F.sum("article") > 0).alias("has_article"))
    inside = (F.col("element") == F.col("best")) | F.col("element").startswith(F.concat("best", F.lit(">"))) | (F.col("best") == "")
    main = slots.join(best, "host").where(F.when(F.col("has_article"), F.col("article") > 0).otherwise(inside & (2 * F.col("links") <= F.col("chars"))))
    main = main.groupBy("host").agg(F.collect_set("slot").alias("main"))
    return lists.drop("classes").join(fixed, "host", "left").join(main, "host", "left")


def main_text(page: str, tokens: Collection[int] | None, fixed: Collection[int] | None, main: Collection[int] | None) -> tuple[str, bool]:
    """Blocks of a page joined by line feeds, and whether the template of its host decided.

    Without a template, or if the page has no text in its main slots, the blocks in its article or main element
    are taken, or else all that are not marked as something else and are no text of the template.
    """
    known = set(fixed or ())
    blocks = [(slot, path, text) for slot, _, path, text, _, token in slots_of(events_of(page), set(tokens or ())) if token not in known]
    slots = set(main or ())
    chosen = [b for b in blocks if b[0] in slots]
    rest = chosen or blocks
    # a slot may hold an article together with other elements
    return "\n".join(b[2] for b in [b for b in rest if _is_article(b[1])] or rest), bool(chosen)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and by_template of every row, from the whole html.

    A null or empty html, or one without main text, gives the empty text.  Null urls, and those
    without ``://``, are pages of one host without a name.  Repeated rows and null ids stay, and change no
    template; other columns are not read; an empty table gives no rows.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("host", F.xxhash64(host_of(F.col("url"))))
    templates = cut_lineage(host_templates(rows.select("host", F.xxhash64("html").alias("page_key"), "html")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(c).to_pylist() for c in ("tokens", "fixed", "main")]
            found = [main_text(h.as_py(), *of) for h, *of in zip(batch.column("html"), *lists)]
            columns = [batch.column("page_id"), batch.column("url"), pa.array([t for t, _ in found], pa.string()), pa.array([d for _, d in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "by_template"])

    joined = _by_host(rows, templates).select("page_id", "url", "html", "tokens", "fixed", "main")
    return joined.mapInArrow(run, "page_id long, url string, text string, by_template boolean")
