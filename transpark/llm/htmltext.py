"""Main text of pages by equivalence-class template deduction.

Tokens of a page are the opening and closing tags of its block elements, told apart by their path:
tags with their class and id (digits aside), and a number among siblings of one name. Over the
distinct pages of a host, tokens that occur equally often on every page are a class; its vector of
occurrences is held as two order-free 64-bit sums, so hosts of any size are added up without their
pages meeting. A class is valid if SUPPORT of the pages have it and each element's opening and
closing tags are both in it. Valid classes whose elements occur once a page are nested by their
paths into the host's template; what is between their tokens are its slots, of which the sums also
tell the mean length, the share of links, and whether the text varies between pages.

The article is found by going down the template, from the page to the slot that holds MAIN times as
much text as all that is beside it, where text that never varies counts for less and so do links.
Everything in that slot is extracted, repeated or not, but for elements that are boilerplate by
their tag, and elements whose name says so if the template agrees: they are short beside the
article, mostly links, or the same on all pages. A page that lacks its host's slot, and a host of
one page, are deduced by the same rules from that page alone.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ship_by_value, small_or_not

#: Attributes are taken whole or not at all. A tag, script or declaration that the page ends in is taken
#: to the end, so that no part of a page is looked at twice.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|svg|iframe|select)\b[^>]*+(?:\Z|>.*?(?:</\1\s*+>|\Z))"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|(\Z|[\"'].*))"
    r"|<[!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
BOILER = frozenset("head title nav footer aside button dialog menu select option label fieldset".split())
#: Elements that end an open one of these.
CLOSES = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
SCOPES = frozenset("article section main div body html td th li ul ol table aside nav footer header form blockquote".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: Elements that may hold an article; others are parts of one.
HOLDS = frozenset("html body div section article main center table tbody tr td".split())
#: Names of boilerplate, whole; as the last part of a name; and parts that may follow the first.
NAMES = frozenset("ad ads advert advertisement advertising adsbygoogle sponsor sponsored banner promo cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login nav navbar navigation menu breadcrumb breadcrumbs sidebar widget widgets footer masthead topbar toolbar pagination pager share sharing social related recommended recommendations search copyright legal skip".split())
HEADS = frozenset("ad ads advert advertisement nav navbar navigation menu breadcrumb breadcrumbs sidebar footer banner notice widget pagination popup modal promo newsletter toolbar masthead".split())
SHAPES = frozenset("slot container list area box bar wrapper wrap section posts items links link buttons icons block panel form thread unit top bottom left right inner message text title head".split())
COMMENTS = frozenset("comment comments disqus respond responses reply replies reactions feedback discussion".split())
#: Names that are boilerplate however long it is, as long as something is left without it.
SURE = frozenset("ad ads advert advertisement advertising adsbygoogle sponsor sponsored cookie cookies consent gdpr".split())
#: Elements by which a form that holds an article is told.
PROSE = frozenset("article main h1 h2 p".split())
PARTS = re.compile(r"[-_:]+|(?<=[a-z])(?=[A-Z])")
DIGITS = re.compile(r"[0-9]+")
#: Share of a host's pages that a class needs; how much more text the article's slot has than all
#: beside it; what text counts that is the same on all pages; and what is short and what is a list
#: of links, for named elements.
SUPPORT, MAIN, SAME, SHORT, SHORT_CHARS, LINKS = 0.5, 4.0, 0.25, 0.25, 300, 0.5
#: How many times the rest of the text a surely named element may have; the share of a page's text from
#: which on a form that holds prose is the page's frame; characters of a path.
SURE_TIMES, FORM_SHARE, PATH_CHARS = 20, 0.5, 4000
#: Siblings of one name that are told apart.
SIBLINGS = 9


def _spoken(attributes: str) -> int:
    """What an element's names say: 0 nothing, 1 boilerplate, 2 readers' comments, 3 boilerplate for sure."""
    said = 0
    for m in ATTRIBUTE.finditer(attributes):
        if m[1].lower() not in ("class", "id"):
            continue
        for name in (m[2] or m[3] or m[4] or "").split():
            parts = [x for x in PARTS.split(name) if x]
            parts = [x.lower() for x in parts]
            if not parts:
                continue
            shaped = all(x in SHAPES or x.isdigit() for x in parts[1:])
            glued = parts[0].removeprefix("comments") if parts[0].startswith("comments") else parts[0].removeprefix("comment")
            if parts[0] in COMMENTS and shaped or parts[-1] in ("comment", "comments") or glued != parts[0] and glued in SHAPES and shaped:
                return 2
            if "".join(parts) in NAMES or parts[0] in NAMES and shaped or parts[-1] in HEADS:
                said = max(said, 3 if parts[0] in SURE or parts[-1] in SURE else 1)
    return said


def _label(tag: str, attributes: str) -> str:
    if not attributes or tag not in HOLDS or tag in ("html", "body"):
        return tag
    named = ".".join(sorted((m[2] or m[3] or m[4] or "").strip().lower() for m in ATTRIBUTE.finditer(attributes)))
    return f"{tag}.{DIGITS.sub('#', named)}".replace("/", "|") if named else tag


class Page:
    """The block elements of a page and its text blocks, in page order.

    ``elements`` are [path, parent, boilerplate by tag, what its names say, closed, the form around it,
    tag], ``blocks`` are (text, element, characters in links).
    """

    def __init__(self, page: str):
        self.elements: list[list] = [["", -1, False, 0, True, 0, ""]]
        self.blocks: list[tuple[str, int, int]] = []
        self._parse(page)
        self._judge_forms()

    def _judge_forms(self) -> None:
        """Forms are boilerplate, but for one that prose and most of the page's text are in."""
        elements = self.elements
        if not any(e[5] for e in elements):
            return
        chars: Counter = Counter()
        for said, e, _ in self.blocks:
            if not elements[e][2]:
                chars[elements[e][5]] += len(said)
        prose = {e[5] for e in elements if e[6] in PROSE and not e[2]}
        frames = {f for f, n in chars.items() if f in prose and n >= FORM_SHARE * chars.total()}
        for e in elements:
            if e[5] and e[5] not in frames:
                e[2] = True

    def _parse(self, page: str) -> None:
        elements, blocks = self.elements, self.blocks
        stack: list[tuple[str, int]] = [("", 0)]  # tag, element
        siblings: list[Counter] = [Counter()]
        text: list[str] = []
        at = linked = 0
        in_link = False

        def flush() -> None:
            nonlocal linked
            if text:
                said = "".join(text)
                said = " ".join((html.unescape(said) if "&" in said else said).split())
                if said:
                    blocks.append((said, stack[-1][1], min(linked, len(said))))
                text.clear()
            linked = 0

        def close(down_to: int) -> None:
            flush()
            while len(stack) > down_to:
                elements[stack.pop()[1]][4] = True
                siblings.pop()

        def open_element(tag: str, attributes: str, boiler: bool, said: int) -> None:
            above = elements[stack[-1][1]]
            label = _label(tag, attributes)
            if tag in HOLDS:
                siblings[-1][label] += 1
                label = f"{label}[{min(siblings[-1][label], SIBLINGS)}]"
            # Paths of elements that are nested without end would grow with their depth.
            path = above[0] if len(above[0]) < PATH_CHARS else f"/~/~/~{_hash(above[0])}"
            form = len(elements) if tag == "form" and not above[5] else above[5]
            elements.append([f"{path}/{label}", stack[-1][1], boiler or above[2], said, False, form, tag])
            stack.append((tag, len(elements) - 1))
            siblings.append(Counter())

        for m in TOKEN.finditer(page):
            if m.start() > at:
                text.append(page[at : m.start()])
                if in_link:
                    linked += m.start() - at
            at = m.end()
            if m[3] is None:
                continue
            if m[5] is not None and ">" not in m[0]:
                text.append(m[0] if m.start() else "")  # a lone < in plain text
                continue
            if m[5] is not None:
                continue
            tag, attributes = m[3].lower(), m[4]
            if tag in INLINE:
                if tag == "a":
                    in_link = not m[2]
                # An inline element that is named boilerplate is an element of its own.
                if not m[2] and tag not in VOID and attributes and _spoken(attributes):
                    flush()
                    open_element(tag, attributes, True, 1)
                elif m[2] and stack[-1][0] == tag:
                    close(len(stack) - 1)
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    flush() if tag == "hr" else text.append("\n")
                continue
            if m[2]:
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), None)
                if depth is None:
                    flush()
                else:
                    close(depth)
                continue
            flush()
            for i in range(len(stack) - 1, 0, -1):
                if tag in CLOSES.get(stack[i][0], ()):
                    close(i)
                    break
                if stack[i][0] in SCOPES:
                    break
            boiler = tag in BOILER or tag == "header" and not any(t in ("article", "main") for t, _ in stack)
            said = 0
            if attributes and tag not in ("html", "body", "article", "main"):
                said = _spoken(attributes)
                boiler = boiler or said == 2 or any(a[1].lower() == "role" and (a[2] or a[3] or a[4] or "").lower() in ROLES for a in ATTRIBUTE.finditer(attributes))
            open_element(tag, attributes, boiler, said)
        if at < len(page):
            rest = page[at:]
            text.append(rest if not re.match(r"<[A-Za-z/!?]", rest) else "")
        flush()

    def statistics(self) -> dict[str, list[int]]:
        """For each path that isn't boilerplate by tag: how often it opens and closes, its text's
        characters, those in links, a sum of its blocks' hashes, and what its names say."""
        elements, out = self.elements, {}
        own = [[0, 0, 0] for _ in elements]
        for said, e, links in self.blocks:
            if not elements[e][2]:
                x = own[e]
                x[0] += len(said)
                x[1] += links
                x[2] += _hash(said)
        for e in range(len(elements) - 1, -1, -1):
            path, parent, boiler, said, closed = elements[e][:5]
            if boiler:
                continue
            x = own[e]
            if parent >= 0:
                up = own[parent]
                # Text under a boilerplate name doesn't speak for the elements around it.
                if not said:
                    up[0] += x[0]
                    up[1] += x[1]
                up[2] += x[2]
            s = out.setdefault(path, [0, 0, 0, 0, 0, 0])
            s[0] += 1
            s[1] += closed or path.count("/") < 3
            s[2] += x[0]
            s[3] += x[1]
            s[4] += x[2]
            s[5] = max(s[5], said)
        return out


def _hash(text: str) -> int:
    x = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return x - (1 << 64) if x >> 63 else x


FIELDS = ("pages", "low", "high", "shut_low", "shut_high", "most", "chars", "links", "least_text", "most_text", "said")


def _vector(key: int, n: int) -> tuple[int, int]:
    x = xxhash.xxh3_128_intdigest(b"%d %d" % (key, n))
    return x & (2**63 - 1), x >> 65


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and path: pages that have it, order-free sums of its opening and closing tags'
    vectors, the most it occurs on a page, its text and links, the least and most of its text's
    hashes, and what its names say."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            seen: dict[tuple[str, str], list[int]] = {}
            for host, page, key in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                for path, (opens, shuts, chars, links, text, said) in Page(page).statistics().items():
                    low, high = _vector(key, opens)
                    shut = (low, high) if shuts == opens else _vector(key, shuts)
                    text &= 2**63 - 1
                    s = seen.get((host, path))
                    if s is None:
                        seen[host, path] = [1, low, high, *shut, opens, chars, links, text, text, said]
                        continue
                    s[0] += 1
                    s[1] ^= low
                    s[2] ^= high
                    s[3] ^= shut[0]
                    s[4] ^= shut[1]
                    s[5] = max(s[5], opens)
                    s[6] += chars
                    s[7] += links
                    s[8] = min(s[8], text)
                    s[9] = max(s[9], text)
                    s[10] = max(s[10], said)
            keys, values = list(seen), list(seen.values())
            arrays = [pa.array([k[i] for k in keys], pa.string()) for i in range(2)] + [pa.array([v[i] for v in values], pa.int64()) for i in range(len(FIELDS))]
            yield pa.RecordBatch.from_arrays(arrays, names=["host", "path", *FIELDS])


class Slot:
    """An element of a template: its path, class, and what is in it."""

    __slots__ = ("chars", "klass", "links", "named", "once", "pages", "path", "same", "sure", "valid")

    def __init__(self, path: str, pages: int, klass: tuple, valid: bool, once: bool, chars: int, links: int, same: bool, said: int):
        self.path, self.pages, self.klass, self.valid, self.once = path, pages, klass, valid, once
        self.chars, self.links, self.same, self.named, self.sure = chars, links, same, said > 0, said == 3

    def weight(self) -> float:
        return (self.chars - self.links) * (SAME if self.same else 1.0)

    def tag(self) -> str:
        return re.split(r"[.\[]", self.path.rpartition("/")[2], maxsplit=1)[0]


def nest(slots: list[Slot]) -> dict[str, list[Slot]]:
    """The template: elements of valid classes that occur once a page, by the path of the nearest
    such element around them. The page itself, '', is the outermost."""
    nodes = {s.path: s for s in slots if s.valid and s.once and s.tag() in HOLDS or not s.path}
    inside: dict[str, list[Slot]] = {}
    for path in sorted(nodes):
        if path:
            above = path.rpartition("/")[0]
            while above not in nodes and above:
                above = above.rpartition("/")[0]
            inside.setdefault(above, []).append(nodes[path])
    return inside


def article_slot(slots: list[Slot]) -> str:
    """The path of the slot that holds the article."""
    by_path, inside, here = {s.path: s for s in slots}, nest(slots), ""
    while True:
        parts = [s for s in inside.get(here, ()) if not s.named]
        if not parts:
            return here
        doubled = lambda s: s.weight() * (2 if s.tag() in ("article", "main") else 1)
        best = max(parts, key=lambda s: (doubled(s), s.path))
        # Beside the best one: other slots, and text in no slot.
        loose = by_path[here].chars - by_path[here].links - sum(s.chars - s.links for s in parts)
        beside = sum(s.weight() for s in parts if s is not best) + max(0, loose)
        if best.weight() <= 0 or doubled(best) < MAIN * beside:
            return here
        here = best.path


def is_boilerplate(slot: Slot, article: Slot) -> bool:
    """Whether the template agrees with the name of a slot that it is boilerplate."""
    mean, whole = slot.chars / slot.pages, article.chars / article.pages
    if slot.sure and 0 < mean <= SURE_TIMES * whole:
        return True
    return slot.chars == 0 or slot.links >= LINKS * slot.chars or slot.same or mean <= max(SHORT_CHARS, SHORT * whole)


def verdicts(slots: list[Slot]) -> tuple[str, list[str], list[str]]:
    """The article's path, and the named paths that are and aren't boilerplate."""
    path = article_slot(slots)
    article = next(s for s in slots if s.path == path)
    named = [s for s in slots if s.named]
    drop = {s.path for s in named if is_boilerplate(s, article)}
    return path, sorted(drop), sorted(s.path for s in named if s.path not in drop)


def slots_of(page: Page) -> list[Slot]:
    """The slots of a page that is alone."""
    return [Slot(path, 1, (1,), opens == shuts, opens == 1, chars, links, False, said) for path, (opens, shuts, chars, links, _, said) in page.statistics().items()]


def _deduce(table: pa.Table) -> pa.Table:
    """The frequent paths of a host (at most those of 1 / SUPPORT mean pages) -> its template."""
    slots = [Slot(r["path"], r["pages"], (r["low"], r["high"]), (r["low"], r["high"]) == (r["shut_low"], r["shut_high"]), r["most"] == 1, r["chars"], r["links"], r["pages"] > 1 and r["least_text"] == r["most_text"], r["said"]) for r in table.to_pylist()]
    path, drop, keep = verdicts(slots)
    lists = [pa.array([x], pa.list_(pa.string())) for x in (drop, keep)]
    return pa.table({"host": table.column("host").slice(0, 1), "article": pa.array([path], pa.string()), "drop": lists[0], "keep": lists[1]})


def deduce_templates(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The template of each host: host, article (the path of its slot), and named paths that are
    boilerplate (drop) or not (keep). pages: (host, html, key), key telling distinct pages apart."""
    counts = pages.select("host", "html", "key").mapInArrow(_statistics, "host string, path string, " + ", ".join(f"{f} long" for f in FIELDS))
    how = {"pages": F.sum, "chars": F.sum, "links": F.sum, "most": F.max, "said": F.max, "most_text": F.max, "least_text": F.min}
    counts = cut(counts.groupBy("host", "path").agg(*[how.get(f, F.bit_xor)(f).alias(f) for f in FIELDS]))
    total = counts.where("path = ''").select("host", F.col("pages").alias("total"))
    frequent = counts.join(small_or_not(total), "host").where(F.col("pages") >= F.col("total") * support).drop("total")
    return frequent.groupBy("host").applyInArrow(_deduce, "host string, article string, drop array<string>, keep array<string>")


def extract_text(page: str | None, article: str | None = None, drop: frozenset = frozenset(), keep: frozenset = frozenset()) -> str:
    """The text of the article's slot, blocks joined by empty lines.

    Without the slot on the page it is deduced from the page alone, and so is what the template
    doesn't say about named elements.
    """
    parsed = Page(page or "")
    elements = parsed.elements
    paths = {e[0] for e in elements if not e[2]}
    alone = None
    if article is None or article not in paths or any(e[3] and not e[2] and e[0] not in drop and e[0] not in keep for e in elements):
        alone = {s.path: s for s in slots_of(parsed)}
    if article is None or article not in paths:
        article = article_slot(list(alone.values()))
    out = [True] * len(elements)
    inside = [False] * len(elements)
    for e, (path, parent, boiler, said) in enumerate(x[:4] for x in elements):
        bad = boiler
        if said and not bad and path != article and not article.startswith(path + "/"):
            bad = path in drop or path not in keep and is_boilerplate(alone[path], alone[article])
        out[e] = bad or parent >= 0 and out[parent]
        inside[e] = path == article or parent >= 0 and inside[parent]
    return "\n\n".join(said for said, e, _ in parsed.blocks if inside[e] and not out[e])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page, article, drop, keep in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
            out.append(extract_text(page, article, frozenset(drop or ()), frozenset(keep or ())))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """page_id, url and the main text of every row.

    White space inside a block is one space, blocks are trimmed and joined by two line feeds. Null
    and empty html give an empty text. Rows without a host in their url are one host (the empty
    one). Pages that lack their host's slot, and hosts of one page, are deduced from that page.
    Repeated rows are rows of their own; as pages of equal html count once for their host's
    template, a host of nothing but copies of a page has one page, and what all pages of a host
    repeat inside the article's slot is kept. Very long pages are extracted whole. Other columns,
    whatever their names, are ignored; an empty table gives an empty result.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.coalesce(F.col(markup), F.lit("")).alias("html"))
    keyed = rows.select("host", "html", F.xxhash64("html").alias("key"))
    again = small_or_not(cut(keyed.groupBy("host", "key").count().where("count > 1").select("host", "key")))
    distinct = keyed.join(again, ["host", "key"], "left_anti").unionByName(keyed.join(again, ["host", "key"], "left_semi").dropDuplicates(["host", "key"]))
    templates = cut(deduce_templates(distinct))
    joined = rows.join(small_or_not(templates), "host", "left").select("page_id", "url", "html", "article", "drop", "keep")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return joined.mapInArrow(_extract, f"page_id {kinds['page_id']}, url string, text string")


def op10_htmltext(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.length("text").cast("long"))


#: Knows the layout of the given pages only (one article element, of headings and paragraphs): a
#: check of the result by other means, not a statement of the method.
SQL = r"""
WITH a AS (SELECT page_id, url, string_split_regex(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(?:p|h[1-6])>') b FROM pages),
t AS (SELECT page_id, url, list_transform(b, lambda x: regexp_replace(regexp_replace(regexp_replace(replace(replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'), '&quot;', '"'), '&middot;', '·'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g')) b FROM a),
c AS (SELECT page_id, url, array_to_string(list_filter(list_transform(b, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10) || chr(10)) AS text FROM t)
SELECT page_id, url, text, length(text)::BIGINT n_chars FROM c
"""

ship_by_value(__name__)
