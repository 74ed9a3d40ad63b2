"""Main text of web pages by tag-path ratios.

A page is cut into text nodes, each with the path of block tags from the root to its leaf. Spark sums characters,
punctuation and nodes of each path of a page, smooths the ratios along the page, fuses each path with its ancestors and keeps
the whole lowest subtree that holds enough of the page's score, and of the containers around it those whose ratio is like
its own. Boilerplate tags never count. Boilerplate names (class, id) only tell of elements that are no frame of the page: one
that holds an article or the main part, most of the page's text, or a headline inside the article, is judged by its ratios.

Defined cases: null, empty and tagless html give what text they have; pages without content give empty text; repeated rows
are extracted each; an empty table gives an empty result; columns named like an output are replaced.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import fresh

#: The content is the lowest subtree whose fused score is at least this share of the page's.
SHARE = 0.5
#: An element with a boilerplate name is a frame if it holds this share of its own text and that outside all such elements.
FRAME = 0.9
#: Containers around the content stay if their ratio of text to nodes is at least this share of the content's.
LIKE = 0.4
#: Weights of the scores of paths through these tags.
PRIOR = {"article": 1.5, "main": 1.2}

# Fixed lists: tags that begin and end blocks, tags whose content is never text, names of boilerplate.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
SILENT = frozenset("script style noscript template textarea select button svg math iframe object audio video canvas title".split())
RAW = frozenset("script style textarea title".split())
NOISE_TAGS = frozenset("nav header footer aside form menu fieldset dialog".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar dialog alert".split())
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "header masthead footer sidebar aside widget widgets toolbar cookie cookies consent gdpr notice notices alert popup modal overlay comment comments commentlist disqus "
    "replies reply respond discussion share sharing social related recommended newsletter subscribe subscription signup login form search pagination pager copyright skip".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: An opening tag ends these if they are open, up to the nearest tag of the second set.
_CLOSES_P = BLOCKS - {"option", "optgroup", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "summary"}
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[a-z]+")
_MARKS = re.compile(r"[.,;:!?…。，、؟]")


def noise_of(tag: str, attributes: str) -> str:
    """How this element is boilerplate: by its "tag" or role, by its "name" (class or id), or not at all."""
    if tag in NOISE_TAGS:
        return "tag"
    named = ""
    for m in _ATTRIBUTE.finditer(attributes) if attributes else ():
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "hidden" and m[2] is None or name == "role" and value in NOISE_ROLES:
            return "tag"
        if name in ("class", "id") and tag not in ("html", "body", "main") and not NOISE_NAMES.isdisjoint(_NAME.findall(value)):
            named = "name"
    return named


def text_nodes(html: str) -> list[tuple[str, int, str]]:
    """(path, number of the block, text) of each text that is not boilerplate, in page order; texts of a block share its number."""
    out: list[tuple[str, int, str, tuple[int, ...]]] = []
    stack: list[tuple[str, bool, int]] = []  # tag, boilerplate by tag, number of the element if boilerplate by name
    block, noisy, at, quiet, elements = 0, 0, 0, "", 0
    frames: set[int] = set()
    inner: list[str] = []  # blocks opened inside the silent element
    last: dict[str, int] = {}

    def add(text: str, path: str | None = None) -> None:
        path = "/".join(t for t, _, _ in stack if t in BLOCKS) if path is None else path
        out.append((path, block, text, tuple(n for _, _, n in stack if n)))

    def ended(tag: str) -> bool:
        """Does an end tag of this name follow?"""
        if tag not in last:
            last[tag] = max((m.start() for m in re.finditer(f"</{tag}[\\s/>]", html, re.I)), default=-1)
        return last[tag] >= at

    while m := _TOKEN.search(html, at):
        if not quiet and not noisy and m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if not m[1] and tag in RAW and not m[0].endswith("/>"):  # raw text up to the end tag
            if ended(tag):
                at = html.find(">", re.compile(f"</{tag}[\\s/>]", re.I).search(html, at).start()) + 1 or len(html)
            elif not quiet:
                at = len(html)
            continue
        if quiet:
            if m[1] and tag == quiet:
                quiet = ""
                continue
            if m[1] and tag in BLOCKS:
                if tag in inner:
                    while inner.pop() != tag:
                        pass
                    continue
                if not any(t == tag for t, _, _ in stack):
                    continue
            elif m[1] or tag != "body":
                if tag in BLOCKS and tag not in VOID:
                    inner.append(tag)
                continue
            quiet = ""  # the element was left open: <body> or the end of a block around it ends it
        if not m[1]:
            if tag in SILENT:
                if not m[0].endswith("/>") and ended(tag):
                    quiet, inner = tag, []
                continue
            if tag == "br":
                add(" ", "") if not noisy else None
            if tag in VOID:
                block += tag == "hr"
                continue
            noise = noise_of(tag, m[3])
            if tag not in BLOCKS and not noise:
                continue
            if tag in BLOCKS:
                block += 1
                ends, within = _SIBLINGS.get(tag, (set(), set()))
                if tag in _CLOSES_P:
                    ends, within = ends | {"p"}, within | {"td", "th", "table", "li", "div", "article", "section", "main", "body"} - ends
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        noisy -= sum(n for _, n, _ in stack[i:])
                        del stack[i:]
                        break
                    if stack[i][0] in within:
                        break
            if tag == "main" or tag == "article" and not noise:
                frames.update(n for _, _, n in stack)
            if tag == "h1":
                within_story = next((i for i, (t, _, _) in enumerate(stack) if t in ("article", "main")), len(stack))
                frames.update(n for _, _, n in stack[within_story:])
            if tag == "article":
                noise = "" if noise == "name" else noise
            if not m[0].endswith("/>") or tag in BLOCKS:
                elements += noise == "name"
                stack.append((tag, noise == "tag", elements if noise == "name" else 0))
                noisy += noise == "tag"
        else:
            if tag in BLOCKS:
                block += 1
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    noisy -= sum(n for _, n, _ in stack[i:])
                    del stack[i:]
                    break
    if not quiet and not noisy and at < len(html):
        add(html[at:])
    while True:  # a named element that holds nearly all text that is left is a frame; those inside it may be too
        free, held = 0, {}
        for _, _, text, named in out:
            outermost = next((n for n in named if n not in frames), 0)
            size = len(text.strip())
            if outermost:
                held[outermost] = held.get(outermost, 0) + size
            else:
                free += size
        largest = max(held, key=lambda n: (held[n], -n), default=0)
        if not largest or held[largest] < FRAME * (held[largest] + free):
            break
        frames.add(largest)
    return [(path, number, text) for path, number, text, named in out if frames.issuperset(named)]


def blocks(html: str) -> list[dict]:
    """Blocks of a page: path, text with single spaces, characters, punctuation marks."""
    out: list[list] = []
    for path, block, text in text_nodes(html):
        if out and out[-1][1] == block:
            out[-1][2].append(text)
            out[-1][0] = out[-1][0] or path
        else:
            out.append([path, block, [text]])
    found = []
    for path, _, texts in out:
        text = " ".join(entities.unescape("".join(texts)).split())
        if text:
            found.append({"path": path, "text": text, "chars": len(text), "marks": len(_MARKS.findall(text))})
    return found


def page_blocks(pages: DataFrame, html: str, carry: list[str]) -> DataFrame:
    """``carry``, the digest of the html, and the blocks of each page."""
    kind = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string()), ("chars", pa.int64()), ("marks", pa.int64())]))

    def cut(batches):
        for batch in batches:
            found = pa.array([blocks(h or "") for h in batch.column("__html").to_pylist()], kind)
            yield pa.record_batch([*[batch.column(c) for c in carry], batch.column("__page"), found], names=[*carry, "__page", "__blocks"])

    digest = F.sha2(F.coalesce(F.col(html), F.lit("")), 256)
    df = pages.select(*[F.col(f"`{c}`") for c in carry], digest.alias("__page"), F.col(html).alias("__html"))
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "__html")
    return df.mapInArrow(cut, f"{own}, __blocks array<struct<path:string,text:string,chars:bigint,marks:bigint>>")


def content_containers(cut: DataFrame, share: float = SHARE) -> DataFrame:
    """``content``: the path of the lowest subtree of each distinct page (by __page) that holds ``share`` of its smoothed score;
    ``around``: paths of the containers above it that are kept too.

    Copies of a page are summed together, and the sums divided by their number.
    """
    nodes = cut.select("__page", F.posexplode(F.transform("__blocks", lambda b: F.struct(b["path"].alias("path"), b["chars"].alias("chars"), b["marks"].alias("marks")))).alias("place", "b"))
    paths = nodes.groupBy("__page", F.col("b.path").alias("path")).agg(
        F.min("place").alias("place"), F.sum("b.chars").alias("chars"), F.sum("b.marks").alias("marks"), F.count("*").alias("nodes"), F.count_if(F.col("place") == 0).alias("firsts")
    )
    paths = paths.withColumn("marks", F.col("marks") / F.sum("firsts").over(Window.partitionBy("__page")))
    along = Window.partitionBy("__page").orderBy("place")
    ratio = F.col("chars") * (1 + F.col("marks")) / F.col("nodes")
    near = lambda f: F.coalesce(f("ratio").over(along), F.col("ratio"))
    paths = paths.withColumn("ratio", ratio).withColumn("smooth", 0.5 * F.col("ratio") + 0.25 * near(F.lag) + 0.25 * near(F.lead))
    for tag, weight in PRIOR.items():
        paths = paths.withColumn("smooth", F.when(F.col("path").rlike(f"(^|/){tag}(/|$)"), weight).otherwise(1.0) * F.col("smooth"))
    steps = F.filter(F.split(container(F.col("path")), "/"), lambda x: x != "")
    up = F.transform(F.sequence(F.lit(0), F.size("steps")), lambda n: F.array_join(F.slice("steps", 1, n), "/"))
    above = paths.withColumn("steps", steps).select("__page", "smooth", F.posexplode(up).alias("depth", "top"))
    trees = above.groupBy("__page", "top", "depth").agg(F.sum("smooth").alias("score"))
    page = trees.groupBy("__page").agg(F.collect_list(F.struct("depth", "score", "top")).alias("trees"), F.max(F.when(F.col("depth") == 0, F.col("score"))).alias("whole"))
    enough = F.filter("trees", lambda t: (t["depth"] == 0) | (t["score"] >= share * F.col("whole")))
    own = paths.groupBy("__page", container(F.col("path")).alias("top")).agg((F.sum("chars") / F.sum("nodes")).alias("ratio"))
    own = own.groupBy(F.col("__page").alias("own_page")).agg(F.collect_list(F.struct("top", "ratio")).alias("own"))
    page = page.select("__page", F.array_max(enough)["top"].alias("content")).join(own, F.col("__page") == F.col("own_page"))
    # What surrounds the content, up to its article or main part, else up to the outermost element of the body.
    begins = lambda path, of: F.startswith(F.concat(path, F.lit("/")), F.concat(of, F.lit("/")))
    limit = F.coalesce(
        F.nullif(F.regexp_extract("content", "^((?:[^/]+/)*(?:article|main))(?:/|$)", 1), F.lit("")), F.nullif(F.regexp_extract("content", "^((?:(?:html|body)/)*(?:div|center))(?:/|$)", 1), F.lit(""))
    )
    inside = F.filter("own", lambda c: (F.col("content") == "") | begins(c["top"], F.col("content")))
    usual = F.array_max(F.transform(inside, lambda c: c["ratio"]))
    around = F.filter("own", lambda c: begins(F.col("content"), c["top"]) & begins(c["top"], limit) & (c["ratio"] >= LIKE * usual))
    return page.select("__page", "content", F.coalesce(F.transform(around, lambda c: c["top"]), F.array()).alias("around"))


def container(path):
    """Path of the innermost body, main, article or div above the leaf; sections, lists, tables and quotes are parts of it."""
    parent = F.regexp_replace(path, "(^|/)[^/]*$", "")
    return F.regexp_replace(parent, "(?:(?:^|/)(?!(?:html|body|main|article|div|center|search)(?:/|$))[^/]+)++$", "")


def main_text(pages: DataFrame, html: str = "html", carry: list[str] | None = None, share: float = SHARE) -> DataFrame:
    """``carry`` (all columns but the html by default), text and n_chars."""
    carry = [c for c in fresh(pages, "text", "n_chars").columns if c != html] if carry is None else carry
    # Cut twice: once for the paths, once for the texts, which so need not be stored in between.
    kept = content_containers(page_blocks(pages, html, []), share)
    out = page_blocks(pages, html, carry).join(kept.withColumnRenamed("__page", "__kept_page"), F.col("__page") == F.col("__kept_page"), "left")
    under = lambda path: (F.col("content") == "") | F.startswith(F.concat(container(path), F.lit("/")), F.concat("content", F.lit("/")))
    inside = F.filter("__blocks", lambda b: under(b["path"]) | F.array_contains("around", container(b["path"])))
    text = F.coalesce(F.array_join(F.transform(inside, lambda b: b["text"]), "\n"), F.lit(""))
    return out.select(*[F.col(f"`{c}`") for c in carry], text.alias("text")).withColumn("n_chars", F.char_length("text").cast("bigint"))
