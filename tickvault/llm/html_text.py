"""Operator 8: main text of HTML pages by a maximum-scoring subsequence.

A page is a row of tags and texts.  A text scores one per word; a tag costs
what pages with a marked article teach: the log of how much oftener a tag
stands outside the article than inside.  One linear scan finds the contiguous
region of the largest score.  Words of menus, headers, footers, sidebars,
notices, adverts, forms and reader comments, and tags there, cost a little,
wherever they stand, and are left out of the region's text.

The costs are counted by Spark over all pages that have one article element,
for every tag name (names of over 20 characters by a 128-bit hash).  The driver
gets the 2,000 most frequent; costs of the others stay a table, joined to the
pages that hold them.

Edge cases: a null, empty or tagless page is one text; markup that never ends
runs to the end of the page; references are decoded once; without marked pages
the costs below hold; of regions with equal scores the first is taken.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickvault.llm.common import fingerprint, map_arrow, written

# Element names of HTML.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "math", "object", "canvas", "xmp", "noframes"}
ASIDE = {"nav", "footer", "aside", "form", "header", "menu", "dialog", "button", "select", "fieldset", "head"}
MARKED = {"article"}
BODY = {"main", "body", "html"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
          "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "nobr"}
NOT_MAIN = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w*|adsense|banner|sponsor\w*|promo\w*|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumbs?|"
                      r"footer|masthead|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|"
                      r"social|comments?|comment-list|disqus|replies|respond|related|recommend\w*|pagination|pager|toolbar|widgets?|skip-link)(?:$|[\s_-])", re.I)
NOT_MAIN_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "menu", "menubar", "toolbar"}

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)

#: Costs without marked pages, of tags that usually stand around or in a main text; the least cost of a tag; seen so many times beforehand.
LEAST, OTHER, AROUND, BEFOREHAND = 0.01, 1.0, 6.0, 2.0
#: Names whose costs go through the driver; a task hands on so many counts at most.
COMMON, HELD = 2000, 200_000
#: Cost of a word or tag of what is not main text.
ASIDE_COST = 0.05
EXPECTED = dict.fromkeys(("p", "br", "b", "i", "em", "strong", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "code", "table", "tr", "td", "th", "figure", "figcaption", "img", "sup", "sub", "q", "hr", "span"), LEAST) \
    | dict.fromkeys(("ul", "ol", "li", "dl", "dt", "dd"), 0.25) | dict.fromkeys(("a", "div", "section"), 0.5) \
    | dict.fromkeys(("nav", "footer", "aside", "form", "header", "article", "main", "body", "html"), AROUND)


def boilerplate(name: str, attributes: str) -> bool:
    if name in ASIDE:
        return True
    if name in BODY or not attributes.strip():
        return False
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).strip()
        if key in ("class", "id") and NOT_MAIN.search(value) or key == "role" and value.lower() in NOT_MAIN_ROLE \
                or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
    return False


def tokens(page: str) -> Iterator[tuple[str, str, bool]]:
    """(kind, value, aside): kind ``text``, or a tag's name as ``name`` or
    ``/name`` under kind ``tag``; aside: it belongs to what is not main text.
    Scripts, comments and the like are passed over."""
    at, n = 0, len(page)
    skipped, depth = "", 0  # the element that is not main text, and how deep it nests in itself
    articles, opened = 0, False  # articles so far; are we in one that is main text?
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], bool(skipped)
            return
        if lt > at:
            yield "text", page[at:lt], bool(skipped)
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page[lt + 1:lt + 2] in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = TAG.match(page, lt)
        if not m:
            if not re.match(r"</?[a-zA-Z]", page[lt:lt + 3]):  # a bare "<" is text
                yield "text", "<", bool(skipped)
                at = lt + 1
                continue
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        close, name, attributes = m[1], m[2].lower(), m[3]
        at = m.end()
        if name in RAW and not close:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if skipped and (name in BODY or name == "article" != skipped and (opened if close else not articles)):
            skipped, depth = "", 0  # it was never closed
        if name == "article":
            opened = not close and not skipped
            articles += not close
        if skipped and name == skipped:
            if not close:
                depth += 1
            else:
                depth -= 1
                if not depth:
                    yield "tag", f"/{name}", True
                    skipped = ""
                    continue
        elif not skipped and not close and name not in VOID and not attributes.endswith("/") and boilerplate(name, attributes):
            skipped, depth = name, 1
        yield "tag", close + name, bool(skipped)


class Costs(dict):
    """Costs of the common names; ``rare`` has (name, cost) of all others, if any."""

    rare: DataFrame | None = None


def cost_key(tag: str) -> str:
    name = tag.lstrip("/")
    return name if len(name) <= 20 else "?" + hashlib.blake2b(name.encode("utf-8", "replace"), digest_size=16).hexdigest()


def tag_counts(page: str) -> Counter:
    """(name, inside the article?) of the tags of a page with one article, else
    nothing; the article's own tags count as outside."""
    if len(re.findall(r"<article\b", page, re.I)) != 1:
        return Counter()
    out, inside = Counter(), False
    for kind, value, aside in tokens(page):
        if kind != "tag" or aside:
            continue
        name = value.lstrip("/")
        if name in MARKED:
            inside = value[0] != "/"
        out[cost_key(name), inside and name not in MARKED] += 1
    return out


def main_text(page: str, costs: dict[str, float], rare: dict[str, float] = {}) -> str:
    """The page's main text, blocks joined by newlines; rare: its other costs."""
    row = list(tokens(page))
    best = total = 0.0
    start = first = last = 0
    for i, (kind, value, aside) in enumerate(row):
        if kind == "text":
            words = len(value.split())
            total += -ASIDE_COST * words if aside else words
        else:
            key = cost_key(value)
            total -= ASIDE_COST if aside else costs[key] if key in costs else rare.get(key, OTHER)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, first, last = total, start, i + 1
    blocks, parts = [], []
    for kind, value, aside in row[first:last]:
        if kind == "text":
            if not aside:
                parts.append(value)
        elif value.lstrip("/") == "br":
            parts.append(" ")
        elif value.lstrip("/") not in INLINE:
            blocks.append(parts)
            parts = []
    blocks.append(parts)
    lines = (" ".join(html.unescape("".join(p)).split()) for p in blocks)
    return "\n".join(x for x in lines if x)


def learn_costs(pages: DataFrame, page: Column, common: int = COMMON) -> Costs:
    schema = pa.schema([("name", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())])

    def count(batches):
        total = Counter()

        def found():
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in total], pa.string()), pa.array([i for _, i in total], pa.bool_()), pa.array(list(total.values()), pa.int64())], schema=schema)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                total.update(tag_counts(text))
                if len(total) > HELD:
                    yield found()
                    total.clear()
        yield found()

    counted = map_arrow(pages.select(page.alias("page")).where("page is not null"), count, "name string, inside boolean, n long")
    per_tag = written(counted.groupBy("name").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"), F.sum("n").alias("n")), "tags")
    known = F.col("name").isin(*EXPECTED)
    first = per_tag.where(~known).orderBy(F.desc("n"), "name").limit(common).collect()
    out = Costs(EXPECTED)
    for name, inside, n in first + per_tag.where(known).collect():
        expected = EXPECTED.get(name, OTHER)
        odds = np.log((n - inside + BEFOREHAND) / (inside + BEFOREHAND))
        weight = n / (n + 10 * BEFOREHAND)
        out[name] = float(max(LEAST, weight * odds + (1 - weight) * expected))
    if len(first) == common:
        weight = F.col("n") / (F.col("n") + 10 * BEFOREHAND)
        odds = F.log((F.col("n") - F.col("inside") + BEFOREHAND) / (F.col("inside") + BEFOREHAND))
        out.rare = per_tag.where(~known & ~F.col("name").isin(*[r["name"] for r in first])).select("name", F.greatest(F.lit(LEAST), weight * odds + (1 - weight) * OTHER).alias("cost"))
    return out


def rare_costs(rows: DataFrame, costs: Costs) -> DataFrame:
    """rows (last columns __print, __page) with __names and __costs: the learned
    costs of the page's tags that are not common."""
    common = dict(costs)

    def names(batches):
        for batch in batches:
            for mark, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = sorted({cost_key(v) for kind, v, aside in tokens(page) if kind == "tag" and not aside} - common.keys())
                yield pa.RecordBatch.from_arrays([pa.array([mark] * len(found), pa.int64()), pa.array(found, pa.string())], names=["__print", "name"])

    held = map_arrow(rows.select("__print", "__page").where("__page is not null"), names, "__print long, name string").distinct()
    pairs = held.join(costs.rare, "name").groupBy("__print").agg(F.collect_list(F.struct("name", "cost")).alias("__pairs"))
    per_page = pairs.select("__print", F.col("__pairs.name").alias("__names"), F.col("__pairs.cost").alias("__costs"))
    return rows.join(per_page, "__print", "left")


def extract(pages: DataFrame, page: Column, keep: list[str], costs: dict[str, float]) -> DataFrame:
    """The columns ``keep`` of pages, then text."""
    rows = pages.select(*[F.col(f"`{c}`") for c in keep if c != "text"], page.alias("__page"))
    kept, common = rows.columns[:-1], dict(costs)
    fields = rows.schema.fields[:-1]
    more = getattr(costs, "rare", None) is not None
    if more:
        rows = rare_costs(rows.withColumn("__print", fingerprint(F.col("__page"))), costs).select(*[F.col(f"`{c}`") for c in kept], "__names", "__costs", "__page")

    def work(batches):
        for batch in batches:
            found = batch.column(batch.num_columns - 1).to_pylist()
            rare = [{}] * len(found)
            if more:
                both = (batch.column(batch.num_columns - i).to_pylist() for i in (3, 2))
                rare = [dict(zip(n or (), c or ())) for n, c in zip(*both)]
            texts = [main_text(p or "", common, r) for p, r in zip(found, rare)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(kept))], pa.array(texts, pa.string())], names=[*kept, "text"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return map_arrow(rows, work, f"{schema}text string")
