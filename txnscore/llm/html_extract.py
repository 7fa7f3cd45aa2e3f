"""Main text of web pages by consensus of host paths.

Every page's containers are scored by the text of their blocks, less links; the best one votes, in
Spark, for its path of generalised tags and classes (digits dropped) on its host. A host's paths
that win a good share of its pages are its templates, and every page is extracted again from the
first template that holds a tenth or more of its own best container's score; a page without one keeps
its own best container. The container is widened to its parent while that adds text outside links. Where a
template holds less than half of the page's best score, the page may be of another layout: its own best container
is kept too, but for the paths that stand beside the winners of the host's pages without winning (its usual side parts).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import cut
from .url_filter import host_and_path

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/)?(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    # a tag with an unclosed quote ends at the next >
    r"|<(?P<end2>/)?(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*+)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page, whatever it holds.
_RAW = set("script style noscript template svg iframe textarea select title canvas".split())
_BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
             "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
             "tr ul".split())
_CONTAINER = set("article main section div body td blockquote".split())
_CLOSES_P = _BLOCK - {"html", "head", "body", "option", "legend", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: A start tag closes the nearest open element of its set, up to the given barriers.
_IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Elements and class or id words that are not the article.
_SKIP_TAGS = set("nav footer aside form button menu dialog label input fieldset".split())
_SKIP_WORDS = set("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion nav navbar "
                  "navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies consent gdpr notice "
                  "notices alert disclaimer popup modal overlay newsletter subscribe signup login search share sharing social related "
                  "recommended comment comments commentlist reply replies respond disqus discussion pagination pager toolbar copyright".split())
_SKIP_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Elements that hold the text itself: skip words in their classes and ids tell about the text, not about a part of the page.
_TEXT_TAGS = set("h1 h2 h3 h4 h5 h6 p".split())
#: With one of these in the same class or id, "header" is the article's own.
_ARTICLE_WORDS = set("article post entry story content".split())
_HEADING = re.compile(r"\s*(?:<(?!h[1-6]\b)[^>]*>\s*){0,3}<h[1-6]\b[^>]*>(.*?)</h[1-6]", re.S | re.I)
_LAYOUT = re.compile(r"\b(?:with|has|no|without|under|below|after)[-_]\w+")
_SPACE = re.compile(r"\s+")
#: Share of a host's pages that a path must win to be one of its templates.
TEMPLATE_SHARE = 0.1
#: Share of the page's own best score that a template must reach on a page to be used there.
TEMPLATE_SCORE = 0.1
#: Share of the page's own best score from which a template is taken for the whole article.
WHOLE_SCORE = 0.5
#: Share of a host's pages on which a path must stand beside the winner to be one of its side parts.
SIDE_SHARE = 0.1
#: Summed bytes of the templates up to which they are broadcast; beyond it, a shuffle join by host.
MAX_BROADCAST_BYTES = 8_000_000


def _skip_words(names: list[str]) -> set[str]:
    """The words of classes or ids that tell that the element is not part of an article."""
    out: set[str] = set()
    for name in names:
        # "with-sidebar" and the like tell about the layout around the element
        words = {w for w in re.split(r"[^a-z]+", _LAYOUT.sub(" ", name)) if w}
        out |= (words & _SKIP_WORDS) - ({"header"} if words & _ARTICLE_WORDS else set())
    return out


def _names_heading(name: str, page: str, at: int) -> bool:
    """Whether an id consists of words of the heading that the element begins with."""
    m = _HEADING.match(page, at)
    words = set(re.split(r"[\W_]+", html.unescape(re.sub(r"<[^>]*>", " ", m[1])).lower())) if m else set()
    of_id = {w for w in re.split(r"[\W_]+", name) if w}
    return len(of_id) > 1 and of_id <= words


def _label(tag: str, attrs: str, page: str = "", at: int = 0) -> tuple[str, bool]:
    """Generalised name ``tag.class`` and whether the element, whose content starts at ``at``, is not
    part of an article."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs.strip(" /") else {}
    classes = html.unescape(found.get("class", "")).lower().split()
    own = found.get("id", "").lower()
    words = tag not in _TEXT_TAGS and (bool(_skip_words(classes)) or bool(_skip_words([own])) and not _names_heading(own, page, at))
    skip = (tag in _SKIP_TAGS or (tag not in ("html", "body", "main", "article") and words)
            or found.get("role", "").lower() in _SKIP_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
            or bool(re.search(r"display\s*:\s*none", found.get("style", ""))))
    name = ".".join([tag, *sorted({re.sub(r"\d+", "", c) for c in classes} - {""})])
    return name, skip


def blocks(page: str) -> Iterator[tuple[tuple, str, int]]:
    """(path, text, characters inside links) of every block of text outside skipped elements.

    ``path`` names the open elements outside in; each entry is (generalised name, element number).
    """
    stack: list[list] = []  # [tag, name, number, skip]
    skipping = links = number = 0
    path: tuple = ()
    parts: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        out = (path, text, min(linked, len(text))) if text else None
        parts.clear()
        linked = 0
        return out

    def pop_to(k: int):
        nonlocal skipping, links, path
        while len(stack) > k:
            tag, _, _, skip = stack.pop()
            skipping -= skip
            links -= tag == "a"
        path = tuple((n, i) for t, n, i, _ in stack if t in _CONTAINER or t in _BLOCK)

    def text_at(a: int, b: int):
        nonlocal linked
        if b > a and not skipping:
            parts.append(page[a:b])
            linked += (b - a) if links else 0

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        text_at(at, m.start() if m else end)
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["end2"]:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if tag in _BLOCK and (out := flush()):
                yield out
            if k is not None:
                pop_to(k)
            continue
        if tag in _RAW:
            if not m[0].endswith("/>"):
                close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if tag in _BLOCK:
            if out := flush():
                yield out
            if tag in _CLOSES_P:
                k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"), None)
                if k is not None and not any(x[0] in _BLOCK for x in stack[k + 1:]):
                    pop_to(k)
            if tag in _IMPLIED:
                ends, barriers = _IMPLIED[tag]
                k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in ends or stack[i][0] in barriers), None)
                if k is not None and stack[k][0] in ends:
                    pop_to(k)
        if tag == "br":
            parts.append(" ")
        if tag in _VOID or m[0].endswith("/>") and tag not in _BLOCK:
            continue
        name, skip = _label(tag, m["attrs"] or m["attrs2"] or "", page, at)
        # the page's header is skipped, an article's own one (its title) is not
        if tag == "header":
            skip = skip or not any(x[0] in ("article", "main") for x in stack)
        number += 1
        stack.append([tag, name, number, skip])
        skipping += skip
        links += tag == "a"
        if tag in _BLOCK or tag in _CONTAINER:
            path = tuple((n, i) for t, n, i, _ in stack if t in _CONTAINER or t in _BLOCK)
    if out := flush():
        yield out


def _containers(found: list) -> dict[str, float]:
    """Score of each generalised path that ends in a container: unlinked text of the blocks below, less for
    every level between, so that the closest element around the article's blocks wins."""
    scores: dict[str, float] = {}
    for path, text, linked in found:
        names = [n for n, _ in path]
        # the block's own element counts as a container only if it is one
        below = 0
        for k in range(len(path), 0, -1):
            if names[k - 1].split(".")[0] in _CONTAINER:
                key = "/".join(names[:k])
                scores[key] = scores.get(key, 0.0) + max(len(text) - 2 * linked, 0) * 0.9 ** below
                below += 1
    preferred = {k: s * (1.5 if k.rsplit("/", 1)[-1].split(".")[0] in ("article", "main") else 1.0) for k, s in scores.items()}
    return preferred


def _widened(wanted: str, found: list) -> str:
    """The container at ``wanted``, or its parent while that adds blocks with more text outside links
    than inside; ``article`` and ``main`` are whole, and the page's body is no part of it."""
    while wanted.rsplit("/", 1)[-1].split(".")[0] not in ("article", "main"):
        parent = wanted.rsplit("/", 1)[0]
        while "/" in parent and parent.rsplit("/", 1)[-1].split(".")[0] not in _CONTAINER:
            parent = parent.rsplit("/", 1)[0]
        if "/" not in parent or parent.rsplit("/", 1)[-1].split(".")[0] == "body":
            break
        adds = False
        for path, text, linked in found:
            own = "/".join(n for n, _ in path) + "/"
            adds |= own.startswith(parent + "/") and not own.startswith(wanted + "/") and len(text) > 2 * linked
        if not adds:
            break
        wanted = parent
    return wanted


def _once(found: list) -> list:
    """The blocks less those whose text stands on the page before."""
    return list({text: (path, text, linked) for path, text, linked in reversed(found)}.values())


def _best(found: list, scores: dict[str, float]) -> str:
    return _widened(max(scores, key=lambda k: (scores[k], k)), found)


def votes(page: str) -> tuple[str | None, list[str]]:
    """The path of the page's best container, and the paths of the containers beside it (neither in it nor around it)."""
    found = list(blocks(page))
    scores = _containers(found)
    if not scores:
        return None, []
    best = _best(found, scores)
    return best, [p for p, s in scores.items() if s > 0 and not f"{p}/".startswith(f"{best}/") and not f"{best}/".startswith(f"{p}/")]


def best_path(page: str) -> str | None:
    return votes(page)[0]


def extract(page: str, templates: list[str], sides: list[str] = ()) -> str:
    """Blocks under the first template that holds a tenth or more of the page's own best score, else
    under its own best container, else all. A template of less than half of that score is joined by what the own best
    container holds outside ``sides``, unless that score comes from blocks that the page repeats (teasers)."""
    found = list(blocks(page))
    scores = _containers(found)
    if not scores:
        return "\n\n".join(t for _, t, _ in found)
    keys = [["/".join(n for n, _ in path[:k]) for k in range(1, len(path) + 1)] for path, _, _ in found]
    own, top, beside = _best(found, scores), max(scores.values()), set(sides)
    for t in templates:
        if scores.get(t, 0) > 0 and scores[t] >= TEMPLATE_SCORE * top:
            wanted = _widened(t, found)
            both = scores[t] < WHOLE_SCORE * top and scores[t] < WHOLE_SCORE * max(_containers(_once(found)).values())
            return "\n\n".join(text for (_, text, _), at in zip(found, keys)
                               if wanted in at or both and own in at and beside.isdisjoint(at))
    return "\n\n".join(text for (_, text, _), at in zip(found, keys) if own in at)


def host_templates(pages: DataFrame) -> DataFrame:
    """(host, paths, sides): per host the paths that win a share of its pages, most frequent first, and the other paths
    that stand beside the winners on a share of them."""

    def vote(batches):
        for batch in batches:
            won, beside = Counter(), Counter()
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                best, others = votes(page) if page else (None, [])
                if best is not None:
                    won[host, best] += 1
                    beside.update((host, p) for p in others)
            keys = list(won.keys() | beside.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in keys], pa.string()), pa.array([p for _, p in keys], pa.string()),
                 pa.array([won[k] for k in keys], pa.int64()), pa.array([beside[k] for k in keys], pa.int64())], names=["host", "path", "won", "beside"])

    counts = pages.select("host", "html").mapInArrow(vote, "host string, path string, won long, beside long")
    tally = cut(counts.groupBy("host", "path").agg(F.sum("won").alias("n"), F.sum("beside").alias("b")))
    totals = tally.groupBy("host").agg(F.sum("n").alias("total"))
    # at most 1 / TEMPLATE_SHARE winners remain per host, and of the side parts those of a page, 1 / SIDE_SHARE times
    good = tally.join(totals, "host").withColumn("wins", F.col("n") >= TEMPLATE_SHARE * F.col("total")).filter(
        F.col("wins") | (F.col("b") >= SIDE_SHARE * F.col("total")))
    ranked = F.sort_array(F.collect_list(F.when(F.col("wins"), F.struct((-F.col("n")).alias("votes"), "path"))))
    return good.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"),
                                    F.sort_array(F.collect_list(F.when(~F.col("wins"), F.col("path")))).alias("sides"))


def main_text(pages: DataFrame) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    Null and empty html, and pages without text outside skipped elements, give an empty text. Pages
    with a null or malformed url share the empty host. Blocks keep the page's order and nothing is
    cut; character references are decoded. Ids may be null or repeated; other columns are ignored; an
    empty table gives no rows.
    """
    host: Column = host_and_path(F.col("url").cast("string"))[0]
    rows = pages.select("page_id", "url", host.alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    templates = cut(host_templates(rows).withColumnRenamed("host", "h"))
    size = templates.agg(F.sum(F.octet_length("h") + F.octet_length(F.array_join(F.concat("paths", "sides"), " ")))).first()[0] or 0
    side = F.broadcast(templates) if size <= MAX_BROADCAST_BYTES else templates
    joined = rows.join(side, F.col("host") == F.col("h"), "left").select("page_id", "url", "html", "paths", "sides")

    def run(batches):
        for batch in batches:
            texts = [extract(p, t or [], x or []) for p, t, x in zip(*[batch.column(k).to_pylist() for k in (2, 3, 4)])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    out = joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
