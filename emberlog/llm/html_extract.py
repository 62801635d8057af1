"""HTML extraction by deduction of host templates: tokens with equal occurrence vectors make classes, classes nest into a template.

A page's tokens are its elements, told apart by their path of names and classes, and its runs of text, told apart by path
and words. The occurrence vector of a token over the pages of a host says how often each page has it. Tokens with equal
vectors form a class; the class that every page has once is the template's skeleton, nested by paths. Runs of text in it
are the template's own words. What is left between is the pages' own text, in slots. The main slot is the innermost
element of the skeleton that holds most of it; of an article around it the whole is taken, less the template's own words in
it. Word lists only tell what stands apart inside the slot, such as comments and adverts, and what a single page without a
template of its host holds.

No host's pages are gathered anywhere. A vector is known by sums of hashes of (page, count), which tasks add up before
the shuffle; a template's slot is a short row, which goes to the pages, so that large hosts' pages aren't shuffled.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm import common
from emberlog.llm.url_filter import host_of

#: A host with more than this share of all pages is a large one; there can only be so many such hosts.
LARGE_SHARE = 0.0002
#: Up to so many hosts' slots (some 200 bytes each) are sent to all executors; beyond, only those of large hosts.
SMALL_TABLE = 50_000
#: A token is of the template if this share of the host's pages has it.
SUPPORT = 0.5
#: The article's slot is the innermost that holds this share of the text that all pages of the host have outside links.
HOLDS = 0.6
#: Runs of text are the template's own only if a host has so many pages, and if they are less than half of its text: else its pages are copies.
LEAST_PAGES = 3
#: Elements deeper than this have a path of bounded length, with a hash of the whole one, and names longer than this too.
DEEPEST, LONGEST = 24, 40

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*)(?:>|\Z)", re.S)
HINT = re.compile(r"""\b(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe template".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that never hold article text.
APART = frozenset("nav footer aside form script style noscript template iframe head title button select option textarea input dialog menu svg canvas object audio video".split())
#: Parts of class, id and role that mark what isn't article text, whatever stands beside them.
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsbygoogle banner sponsor sponsored promo nav navbar navigation breadcrumb breadcrumbs pagination pager sidebar sidebars footer masthead "
    "cookie cookies consent gdpr popup modal newsletter subscribe signup login comment comments commentlist respond disqus replies toolbar complementary contentinfo".split()
)
#: Parts that mark it if they stand alone or beside words of layout only; an article may be on social science or related work.
WEAK_WORDS = frozenset("menu aside widget rail promotion notice notices overlay alert toast reactions share sharing social related recommended search form".split())
LAYOUT_WORDS = frozenset("area articles bar block bottom box button buttons center container content field group header icon icons inner input item items left links list main media message module more news outer panel post posts reading right row section site stories story tools top widget wrap wrapper".split())
#: Beside these a mark tells of the layout around an article: with-sidebar, no-comments, content-sidebar-wrap.
AROUND_WORDS = frozenset("has no with without".split())
COLUMN_WORDS = frozenset("nav rail sidebar sidebars".split())
#: Elements that are never apart by their attributes.
WHOLE = frozenset("html body main article".split())
#: Opening one of these closes an open paragraph.
CLOSES_P = BLOCKS - {"body", "html", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend", "summary"} | {"p"}
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Elements that an implied end doesn't reach beyond.
FENCE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}


class Element:
    """An open element; inside says whether it stands in the slot, size counts the letters that it holds."""

    __slots__ = ("apart", "depth", "inside", "name", "path", "size")

    def __init__(self, name: str, path: str, apart: bool, depth: int, inside: bool):
        self.name, self.path, self.apart, self.depth, self.inside, self.size = name, path, apart, depth, inside, 0


def short(text: str) -> str:
    import xxhash

    return xxhash.xxh64_hexdigest(text.encode("utf-8", "surrogatepass"))


def hints(attributes: str) -> tuple[str, bool]:
    """First class or id as part of the path, and whether the attributes say that this is no article text."""
    first, apart = "", False
    for m in HINT.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind in ("hidden", "aria-hidden"):
            apart = apart or (kind == "hidden" and not (value or "hidden").lower() == "false") or value.lower() == "true"
            continue
        words = value.lower().split()
        if words and not first and kind in ("class", "id"):
            name = re.sub(r"\d+", "0", words[0]).replace("/", ":").replace("~", "-")
            first = ("." if kind == "class" else "#") + (name if len(name) <= LONGEST else name[:LONGEST] + short(name))
        apart = apart or any(map(marks_apart, words))
    return first, apart


def marks_apart(word: str) -> bool:
    """Whether a class, an id or a role says that its element holds no article text."""
    parts = {x for x in re.split(r"[-_]+|(?<=[a-z])\d+", word) if x}
    marks = parts & APART_WORDS
    if parts & AROUND_WORDS or (marks and marks <= COLUMN_WORDS and {"content", "main"} & parts and {"wrap", "wrapper"} & parts):
        return False
    return bool(marks or (parts & WEAK_WORDS and parts <= WEAK_WORDS | LAYOUT_WORDS))


def walk(page: str, slot: str | None = None) -> Iterator[tuple[str, Element | None, str]]:
    """(kind, element, text) in page order: open and close of elements, text with the element it stands in, void for elements without content.

    Time is linear in the page whatever its nesting: where names and blocks are open is kept beside the stack.
    """
    root = Element("", "", False, 0, slot is None)
    stack = [root]
    where: dict[str, list[int]] = {}
    blocks = [0]
    articles = 0
    at, n = 0, len(page)

    def last(name: str) -> int:
        found = where.get(name)
        return found[-1] if found else 0

    def close(k: int) -> Iterator[tuple[str, Element | None, str]]:
        nonlocal articles
        while len(stack) > k:
            element = stack.pop()
            where[element.name].pop()
            if blocks[-1] == len(stack):
                blocks.pop()
            articles -= element.name == "article"
            yield "close", element, ""
            stack[-1].size += element.size

    while at < n:
        m = MARKUP.search(page, at)
        upto = m.start() if m else n
        if upto > at:
            yield "text", stack[-1], page[at:upto]
        if not m:
            break
        at = m.end()
        if m[1]:
            yield "text", stack[-1], m[1].replace("&", "&amp;")
        if not m[3]:
            continue
        name = m[3].lower()
        if m[2]:
            if name in VOID:
                continue
            k = last(name)
            if k and (name in BLOCKS or blocks[-1] <= k):
                yield from close(k)
            continue
        if name in VOID:
            yield "void", stack[-1], name
            continue
        if name in CLOSES_P and (k := last("p")) and blocks[-1] <= k:
            yield from close(k)
        if name in SAME:
            k = max(last(x) for x in SAME[name] + FENCE[name])
            if k and stack[k].name in SAME[name]:
                yield from close(k)
        first, apart = hints(m[4])
        parent = stack[-1]
        path = f"{parent.path}/{name}{first}"
        if parent.depth >= DEEPEST:
            path = f"{'/'.join(parent.path.split('/')[: DEEPEST + 1])}/{name}~{parent.depth + 1}~{short(path)}"
        # An article's own header holds its title; others are the site's.
        apart = parent.apart or (apart and name not in WHOLE) or name in APART or (name == "header" and not articles)
        element = Element(name, path, apart, parent.depth + 1, parent.inside or path == slot)
        yield "open", element, ""
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            yield "close", element, ""
            continue
        if m[0].endswith("/>") and name not in BLOCKS:
            continue
        where.setdefault(name, []).append(len(stack))
        if name in BLOCKS:
            blocks.append(len(stack))
        articles += name == "article"
        stack.append(element)
    yield from close(1)


def run_token(element: Element, words: str) -> int:
    """Hash of a run of text at its path."""
    import xxhash

    return xxhash.xxh64_intdigest(f"{element.path} {words}".encode("utf-8", "surrogatepass")) - (1 << 63)


def tokens(page: str) -> tuple[Counter, Counter, Counter, dict[int, tuple[str, int]]]:
    """How often each path opens; the letters of text, outside what is apart, that it holds; how often each run of text occurs, and its path and letters."""
    opened: Counter = Counter()
    held: Counter = Counter()
    runs: Counter = Counter()
    known: dict[int, tuple[str, int]] = {}
    for kind, element, text in walk(page):
        if kind == "open":
            opened[element.path] += 1
        elif kind == "close":
            held[element.path] += element.size
            if element.depth == 1:
                held[""] += element.size
        elif kind == "text" and not element.apart and (words := text.split()):
            size = sum(map(len, words))
            element.size += size
            if not element.depth:
                held[""] += size
            token = run_token(element, " ".join(words))
            runs[token] += 1
            known[token] = (element.path, size)
    return opened, held, runs, known


def depth_of(path: str) -> int:
    _, *deep = path.rsplit("/", 1)[-1].split("~")
    return int(deep[0]) if len(deep) == 2 else path.count("/")


def ancestors(path: str) -> Iterator[str]:
    """A path and those above it, the page's own '' too."""
    while path:
        yield path
        path = path[: path.rindex("/")]
    yield ""


def article_of(template: list[tuple[str, int | None, bool, float]], total: float, pages: int) -> tuple[str | None, list[int]]:
    """The main slot's path, and the template's own runs of text in it. template: (path, run of text or null, whether it's of the skeleton, letters)."""
    words = [t for t in template if t[1] is not None and t[2]]
    if pages < LEAST_PAGES or 2 * sum(t[3] for t in words) >= total:
        words = []
    own: Counter = Counter()
    for path, _, _, size in words:
        for above in ancestors(path):
            own[above] += size
    elements = [(path, once, size - own[path]) for path, run, once, size in template if run is None]
    left = total - own[""]
    fit = [t for t in elements if t[1] and t[2] > 0 and t[2] >= HOLDS * left and re.search(r"/(article|main|div|section|td|body|center)(?![a-z0-9])[^/]*$", t[0])]
    slot = max(fit, key=lambda t: (depth_of(t[0]), t[2], t[0]), default=(None,))[0]
    # The whole article around the slot; without one around it, the article that holds most.
    for name in ("article", "main"):
        around = [x for x in ancestors(slot or "") if re.search(rf"/{name}[^/]*$", x)]
        named = [t for t in elements if t[2] > 0 and re.search(rf"/{name}[^/]*$", t[0])]
        if around or named:
            slot = around[-1] if around else max(named, key=lambda t: (t[2], -t[0].count("/"), t[0]))[0]
            break
    return slot, [run for path, run, _, _ in words if slot is not None and (path == slot or path.startswith(slot + "/"))]


def extract(page: str, slot: str | None, words: frozenset[int] = frozenset()) -> tuple[str, bool]:
    """The blocks of a page's slot, one a line, and whether the page has the slot: its path by the host's template, None for the whole page. words: the template's own runs."""
    seen = slot is None
    blocks: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if text := " ".join(html.unescape("".join(held)).split()):
            blocks.append(text)
        held.clear()

    for kind, element, text in walk(page, slot):
        if kind == "text":
            if element.inside and not element.apart and not (words and run_token(element, " ".join(text.split())) in words):
                held.append(text)
        elif kind == "void":
            if text == "hr":
                flush()
            elif text == "br":
                held.append(" ")
        else:
            seen = seen or element.path == slot
            if element.name in BLOCKS:
                flush()
    flush()
    return "\n".join(blocks), seen


def main_text(page: str, slot: str | None, words: list[int] | None = None) -> str:
    """extract() by the template's slot; a page without that slot is its own template."""
    if not page:
        return ""
    if slot is not None:
        text, seen = extract(page, slot, frozenset(words or ()))
        if seen:
            return text
    opened, held, _, _ = tokens(page)
    return extract(page, article_of([(p, None, n == 1, held.get(p, 0)) for p, n in opened.items()], held.get("", 0), 1)[0])[0]


def host_templates(pages: DataFrame) -> DataFrame:
    """(host, pages, slot, words) of pages with columns host, page, html: the main slot and the template's own runs in it.

    For each token of a host the occurrence vector is summed up as hashes; a token's class is the vector. Tokens with enough
    support stay, at most those of one page divided by SUPPORT; so a host's template is small whatever the host's size.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        for batch in batches:
            out = ([], [], [], [], [], [])
            for host, page, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                opened, held, runs, known = tokens(text)
                rows = [(path, None, n, held.get(path, 0)) for path, n in [*opened.items(), ("", 1)]]
                rows += [(known[token][0], token, n, n * known[token][1]) for token, n in runs.items()]
                for path, token, n, size in rows:
                    for column, value in zip(out, (host, path, token, page, n, size), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)], ["host", "path", "run", "page", "n", "held"])

    seen = pages.select("host", "page", "html").mapInArrow(run, "host string, path string, run long, page long, n long, held long")
    # The vector's hash: sums of both halves of a hash of (page, count), in any order, with partial sums, whatever repeats.
    h = F.xxhash64("page", "n")
    vector = (F.sum(F.shiftrightunsigned(h, 32)).alias("high"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"))
    vectors = seen.groupBy("host", "path", "run").agg(F.count("*").alias("support"), F.sum("held").alias("held"), *vector)
    vectors = vectors.select("host", "path", "run", "support", "held", F.struct("high", "low").alias("vector"))
    # Each page has its root once. Hosts' roots come from a scan of the keys alone; where they are few, tokens meet them before any further shuffle.
    one = F.xxhash64("page", F.lit(1).cast("long"))
    roots = pages.groupBy("host").agg(F.count("*").alias("pages"), F.sum(F.shiftrightunsigned(one, 32)).alias("high"), F.sum(one.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"))
    roots = common.checkpoint(roots.select("host", "pages", F.struct("high", "low").alias("every")))
    few = roots.limit(SMALL_TABLE + 1).count() <= SMALL_TABLE
    kept = vectors.join(F.broadcast(roots) if few else roots, "host").where(F.col("support") >= F.col("pages") * SUPPORT)
    # The skeleton is the class of the tokens that every page has once: their vector is the root's.
    token = F.struct("path", "run", (F.col("vector") == F.col("every")).alias("once"), F.col("held").cast("double").alias("held"))
    total = F.max(F.when((F.col("path") == "") & F.col("run").isNull(), F.col("held")).otherwise(F.lit(0))).cast("double")
    templates = kept.groupBy("host").agg(F.max("pages").alias("pages"), total.alias("total"), F.collect_list(token).alias("template"))

    def choose(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            host, count, total, template = (c.to_pylist() for c in batch.columns)
            found = [article_of([(t["path"], t["run"], t["once"], t["held"]) for t in x], z, n) for x, z, n in zip(template, total, count, strict=True)]
            columns = [pa.array(host, pa.string()), pa.array(count, pa.int64()), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["host", "pages", "slot", "words"])

    return templates.mapInArrow(choose, "host string, pages long, slot string, words array<long>")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page, a row per input row: page_id, url, text, n_chars, host, host_pages (of the template).

    Character references are decoded, white space within a block is one space, blocks are joined by newlines in page
    order. Null or empty html gives an empty text; a page whose host's template fits it badly, and the only page of a
    host, is its own template; unclosed elements end where the next one of their kind or their parent does. Pages with
    a null URL share the host ''. Time is linear in a page's length, whatever its nesting. Repeated rows give a row each; an empty table gives none; other columns are left out.
    """
    common.prepare(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    templates = common.checkpoint(host_templates(rows.withColumn("page", F.xxhash64("page_id", "url"))))
    if templates.limit(SMALL_TABLE + 1).count() <= SMALL_TABLE:
        met = rows.join(F.broadcast(templates), "host", "left")
    else:
        # At most 1 / LARGE_SHARE hosts hold more than LARGE_SHARE of all pages; their slots are sent, the pages of others meet theirs by host.
        least = F.lit(LARGE_SHARE * (templates.agg(F.sum("pages")).first()[0] or 0))
        large = templates.where(F.col("pages") > least)
        met = rows.join(F.broadcast(large), "host").unionByName(rows.join(F.broadcast(large.select("host")), "host", "left_anti").join(templates.where(F.col("pages") <= least), "host", "left"))
    met = met.select("page_id", "url", "html", "host", "slot", "pages", "words")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(*x) for x in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), batch.column(6).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), batch.column(3), batch.column(5)], ["page_id", "url", "text", "n_chars", "host", "host_pages"])

    kind = dict(rows.dtypes)["page_id"]
    return met.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, host string, host_pages long")
