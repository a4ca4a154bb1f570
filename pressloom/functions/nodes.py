"""Sql expressions on the node array of a page.

``id`` is a node's position, so the subtree of a node is a slice.  Pruning blanks
nodes instead of removing them, which keeps positions valid.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pressloom.functions.sqltext import F, Sql, column_function, filled, first, let, strip

_SIMPLE = re.compile(
    r"^(?P<tag>[a-z][a-z0-9]*|\*)?(?:\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)"
    r"|\[(?P<attr>[\w-]+)(?:(?P<op>\*?=)'(?P<val>[^']*)')?\])?$"
)
SELECTOR = "struct<rank:int,tag:string,attr:string,op:string,val:string,above:array<string>>"
ABOVE_SEPARATOR = "\t"
SPAN = "struct<id:int,end:int>"


# ---- selectors ---------------------------------------------------------------------------

def simple_selector(css: str) -> tuple[str | None, str | None, str | None, str | None]:
    """``tag``, ``.class``, ``#id``, ``[attr]``, ``[attr='v']``, ``[attr*='v']`` with an optional tag in front."""
    m = _SIMPLE.match(css)
    if not m or not css:
        raise ValueError(f"selector {css!r} is not supported")
    tag = None if m["tag"] in (None, "*") else m["tag"]
    if m["cls"]:
        return tag, "class", "~", m["cls"]
    if m["id"]:
        return tag, "id", "=", m["id"]
    if m["attr"]:
        return tag, m["attr"], m["op"] or "has", m["val"]
    return tag, None, None, None


def selectors(ranked: Iterable[str]) -> list[tuple]:
    """Selector rows of a ranked list; the members of a comma list share their rank."""
    rows = []
    for rank, group in enumerate(ranked):
        for css in (c.strip() for c in group.split(",")):
            *above, last = css.split()
            tag, attr, op, val = simple_selector(last)
            outer = [ABOVE_SEPARATOR.join(x or "" for x in simple_selector(a)) for a in above]
            rows.append((rank, tag, attr, op, val, outer))
    return rows


def selector_array(ranked: Iterable[str]) -> Sql:
    """Literal array of selector rows."""
    def text(v):
        return F.lit(v).cast("string")

    rows = [
        F.struct(
            F.lit(rank).alias("rank"), text(tag).alias("tag"), text(key).alias("attr"), text(op).alias("op"),
            text(val).alias("val"), F.array(*above).cast("array<string>").alias("above"),
        )
        for rank, tag, key, op, val, above in selectors(ranked)
    ]
    return F.array(*rows) if rows else F.empty(SELECTOR)


def attr(node: Sql, name: str | Sql) -> Sql:
    return F.try_element_at(node.getField("attr"), name)


def has_class(node: Sql, name: Sql) -> Sql:
    return F.coalesce(F.array_contains(F.split(attr(node, "class"), r"\s+"), name), F.lit(False))


def _fits(node: Sql, tag: Sql, key: Sql, op: Sql, val: Sql) -> Sql:
    value = attr(node, key)
    test = (
        F.when(op.isNull(), node.getField("tag") != "#text")
        .when(op == "has", value.isNotNull())
        .when(op == "=", value == val)
        .when(op == "~", has_class(node, val))
        .otherwise(F.contains(value, val))
    )
    return (tag.isNull() | (node.getField("tag") == tag)) & F.coalesce(test, F.lit(False))


def _inside(node: Sql, outer: Sql) -> Sql:
    return (node.getField("id") > outer.getField("id")) & (node.getField("id") <= outer.getField("end"))


def _fits_above(node: Sql, packed: Sql) -> Sql:
    part = lambda i: F.nullif(F.split_part(packed, F.lit(ABOVE_SEPARATOR), F.lit(i)), F.lit(""))
    return _fits(node, part(1), part(2), part(3), part(4))


def matches(nodes: Sql, node: Sql, sel: Sql) -> Sql:
    """Whether ``node`` fits ``sel``, its outer selectors included.

    A node that fits climbs from parent to parent, the nearest outer selector first, so
    the work follows its depth and not the page's size.
    """
    own = _fits(node, *[sel.getField(k) for k in ("tag", "attr", "op", "val")])
    above = sel.getField("above")

    def climbed(state: Sql, _: Sql) -> Sql:
        met = lambda outer: (state.getField("left") > 0) & _fits_above(
            outer, F.get(above, state.getField("left") - 1))
        return let(F.get(nodes, state.getField("at")), lambda outer: F.struct(
            outer.getField("parent").alias("at"),
            (state.getField("left") - F.when(F.coalesce(met(outer), F.lit(False)), 1).otherwise(0)).alias("left")))

    start = F.struct(node.getField("parent").alias("at"), F.size(above).alias("left"))
    met_all = F.aggregate(F.sequence(F.lit(1), node.getField("depth")), start, climbed).getField("left") == 0
    return own & ((F.size(above) == 0) | ((node.getField("depth") > 0) & met_all))


@column_function
def select_first(nodes: Sql, sels: Sql) -> Sql:
    """``struct<rank, id, end>`` of the best-ranked, then first matching node, or NULL."""
    hits = F.transform(sels, lambda s: F.transform(
        F.slice(F.filter(nodes, lambda n: matches(nodes, n, s)), 1, 1),
        lambda n: F.struct(s.getField("rank").alias("rank"), n.getField("id").alias("id"), n.getField("end").alias("end")),
    ))
    return F.array_min(F.flatten(hits))


def whole(nodes: Sql) -> Sql:
    """The page itself in the shape of a selected node."""
    return F.struct(F.lit(-1).alias("rank"), F.lit(-1).alias("id"), (F.size(nodes) - 1).alias("end"))


def subtree(nodes: Sql, node: Sql) -> Sql:
    """The node and everything inside it."""
    start = F.greatest(node.getField("id"), F.lit(0))
    return F.slice(nodes, start + 1, node.getField("end") - start + 1)


def inside(nodes: Sql, node: Sql) -> Sql:
    """Everything inside the node, without itself."""
    return F.slice(nodes, node.getField("id") + 2, node.getField("end") - node.getField("id"))


def ancestors(nodes: Sql, node: Sql) -> Sql:
    """Open elements around the node, the nearest first."""
    return F.reverse(F.filter(nodes, lambda a: _inside(node, a)))


def climb(nodes: Sql, node: Sql, tags: list[str], steps: int | Sql) -> Sql:
    """The topmost of the node's unbroken chain of ``tags`` parents (at most ``steps``), else the node."""
    def top(chain: Sql) -> Sql:
        fits = F.transform(chain, lambda a: a.getField("tag").isin(tags))
        broken = F.array_position(fits, False)
        n = F.when(broken == 0, F.size(chain)).otherwise(broken - 1).cast("int")
        return F.when(n == 0, node).otherwise(F.get(chain, n - 1))

    return let(F.slice(ancestors(nodes, node), 1, steps), top)


# ---- text --------------------------------------------------------------------------------

@column_function
def texts_of(nodes: Sql) -> Sql:
    """Trimmed, non-empty texts of visible text nodes."""
    visible = F.filter(nodes, lambda n: n.getField("tag") == "#text")
    return F.filter(F.transform(visible, lambda n: strip(n.getField("text"))), lambda t: t != "")


@column_function
def visible_text(nodes: Sql, separator: str) -> Sql:
    return F.array_join(texts_of(nodes), separator)


@column_function
def node_text(nodes: Sql, node: Sql, separator: str = " ") -> Sql:
    return visible_text(subtree(nodes, node), separator)


# ---- pruning -----------------------------------------------------------------------------

def prune_sets(css: Iterable[str]) -> dict[str, list]:
    """Selectors of a prune list sorted into sets, so that most nodes need a few look-ups only."""
    out = {"tags": [], "classes": [], "ids": [], "class_like": [], "id_like": [], "other": []}
    for one in (c.strip() for group in css for c in group.split(",")):
        if len(one.split()) > 1:
            out["other"].append(one)
            continue
        tag, key, op, val = simple_selector(one)
        if key is None:
            out["tags"].append(tag)
        elif tag is None and key == "class" and op == "~":
            out["classes"].append(val)
        elif tag is None and key == "id" and op == "=":
            out["ids"].append(val)
        elif tag is None and key == "class" and op == "*=":
            out["class_like"].append(val)
        elif tag is None and key == "id" and op == "*=":
            out["id_like"].append(val)
        else:
            out["other"].append(one)
    return out


PRUNE = (
    "struct<tags:array<string>,classes:array<string>,ids:array<string>,class_like:array<string>,"
    f"id_like:array<string>,other:array<{SELECTOR}>>"
)


def prune_struct(css: Iterable[str]) -> Sql:
    sets = prune_sets(css)
    strings = [
        F.array(*sets[k]).cast("array<string>").alias(k)
        for k in ("tags", "classes", "ids", "class_like", "id_like")
    ]
    return F.struct(*strings, selector_array(sets["other"]).alias("other"))


def _is_pruned(nodes: Sql, n: Sql, p: Sql) -> Sql:
    cls, dom_id = attr(n, "class"), attr(n, "id")
    by_class = cls.isNotNull() & (
        F.arrays_overlap(F.split(cls, r"\s+"), p.getField("classes"))
        | F.exists(p.getField("class_like"), lambda v: F.contains(cls, v))
    )
    by_id = dom_id.isNotNull() & (
        F.array_contains(p.getField("ids"), dom_id) | F.exists(p.getField("id_like"), lambda v: F.contains(dom_id, v))
    )
    other = F.exists(p.getField("other"), lambda s: matches(nodes, n, s))
    return F.coalesce(F.array_contains(p.getField("tags"), n.getField("tag")) | by_class | by_id | other, F.lit(False))


@column_function
def prune(nodes: Sql, p: Sql) -> Sql:
    """Blank every node inside a pruned element (tag, attributes and text become NULL)."""
    roots = F.filter(nodes, lambda n: (n.getField("tag") != "#text") & _is_pruned(nodes, n, p))
    spans = F.transform(roots, lambda n: F.struct(n.getField("id").alias("id"), n.getField("end").alias("end")))
    # roots stand in document order, so one that starts inside the last outermost one is part of it
    outermost = F.aggregate(spans, F.struct(F.lit(-1).alias("end"), F.empty(SPAN).alias("spans")), lambda s, c: F.when(
        c.getField("id") > s.getField("end"),
        F.struct(c.getField("end").alias("end"), F.concat(s.getField("spans"), F.array(c)).alias("spans"))).otherwise(s))

    def blank(n: Sql) -> Sql:
        return F.struct(
            n.getField("id").alias("id"), n.getField("end").alias("end"), n.getField("depth").alias("depth"),
            F.nothing().alias("tag"), F.nothing("map<string,string>").alias("attr"), F.nothing().alias("text"),
            n.getField("parent").alias("parent"), n.getField("upto").alias("upto"),
        )

    def cut(s: Sql) -> Sql:
        """The nodes before each span as they are, the span's blanked, and what follows the last."""
        end_before = lambda i: F.coalesce(F.get(s, i - 1).getField("end"), F.lit(-1))
        pieces = F.transform(s, lambda c, i: F.concat(
            F.slice(nodes, end_before(i) + 2, c.getField("id") - end_before(i) - 1), F.transform(subtree(nodes, c), blank)))
        last = end_before(F.size(s))
        return F.concat(F.flatten(pieces), F.slice(nodes, last + 2, F.size(nodes) - last - 1))

    return let(outermost.getField("spans"), lambda s: F.when(F.size(s) == 0, nodes).otherwise(cut(s)))


# ---- blocks ------------------------------------------------------------------------------

# In a class or id these mark an interface element.
UI_TOKENS = (
    "share", "tag", "breadcrumb", "nav", "comment", "meta", "byline", "author", "toolbar", "footer", "banner",
)


def _class_and_id(n: Sql) -> Sql:
    return F.lower(F.concat_ws(" ", attr(n, "class"), attr(n, "id")))


@column_function
def paragraphs(
    nodes: Sql, box: Sql, tags: Sql, min_chars: Sql, wrappers: Sql, min_heading: int = 60, skip_like: Sql | None = None
) -> Sql:
    """Texts of the given tags inside ``box``.

    Texts under ``min_chars`` are dropped.  ``div`` and ``span`` count only if they
    hold none of the ``wrappers``; ``h2`` and ``h3`` only if longer than ``min_heading``.
    Elements whose class or id contains one of ``skip_like`` are left out.
    """
    found = F.filter(inside(nodes, box), lambda n: F.coalesce(F.array_contains(tags, n.getField("tag")), F.lit(False)))
    if skip_like is not None:
        found = F.filter(found, lambda n: ~F.exists(skip_like, lambda t: F.contains(_class_and_id(n), t)))

    def is_wrapper(n: Sql) -> Sql:
        nested = F.exists(inside(nodes, n), lambda m: F.array_contains(wrappers, m.getField("tag")))
        return n.getField("tag").isin("div", "span") & F.coalesce(nested, F.lit(False))

    texts = F.transform(F.filter(found, lambda n: ~is_wrapper(n)), lambda n: F.struct(
        n.getField("tag").alias("tag"), node_text(nodes, n).alias("text")))
    kept = F.filter(texts, lambda t: (F.length(t.getField("text")) >= min_chars) & (t.getField("text") != "")
                    & (~t.getField("tag").isin("h2", "h3") | (F.length(t.getField("text")) > min_heading)))
    return F.transform(kept, lambda t: t.getField("text"))


@column_function
def largest_block(nodes: Sql, min_block: int = 120, min_part: int = 25) -> Sql:
    """Parts of the longest ``div``/``section``/``article``/``main`` text, at least two, or NULL.

    Blocks that look like interface elements by class or id are left out.  The shredder's
    running text lengths tell each block's size, so only the longest one's text is put
    together; ``nodes`` is a page as shredded, not a pruned one.
    """
    ui = "|".join(UI_TOKENS)
    blocks = F.filter(nodes, lambda n: n.getField("tag").isin("div", "section", "article", "main")
                      & ~_class_and_id(n).rlike(ui))
    after = lambda n: F.get(nodes, n.getField("end")).getField("upto")
    sized = F.transform(blocks, lambda n: F.struct(
        (after(n) - n.getField("upto") - 1).alias("n"), n.getField("upto").alias("before"), after(n).alias("after")))
    # boxes around one and the same text are one candidate
    longest = let(sized, lambda all_sizes: let(F.array_max(F.transform(all_sizes, lambda b: b.getField("n"))), lambda most: F.when(
        most > min_block, F.array_distinct(F.filter(all_sizes, lambda b: b.getField("n") == most)))))
    text = F.array_max(F.transform(longest, lambda b: visible_text(F.filter(
        nodes, lambda n: (n.getField("upto") > b.getField("before")) & (n.getField("upto") <= b.getField("after"))), " ")))
    pieces = F.transform(F.split(text, r"(?U)\n+|\s{2,}"), strip)
    return let(F.filter(pieces, lambda p: F.length(p) >= min_part),
               lambda parts: F.when(F.size(parts) >= 2, F.array_join(parts, "\n")))


@column_function
def meta_content(nodes: Sql, key: str, name: str) -> Sql:
    """Trimmed content of the first ``<meta key=name>`` that has one; NULL when none or empty."""
    hit = first(nodes, lambda n: (n.getField("tag") == "meta") & (attr(n, key) == name))
    return filled(strip(attr(hit, "content")))


@column_function
def first_tag_text(nodes: Sql, tag: str) -> Sql:
    return filled(let(first(nodes, lambda n: n.getField("tag") == tag), lambda n: node_text(nodes, n)))


def script_texts(nodes: Sql) -> Sql:
    return F.transform(
        F.filter(nodes, lambda n: (n.getField("tag") == "script") & n.getField("text").isNotNull()),
        lambda n: n.getField("text"),
    )


@column_function
def chunks_after(nodes: Sql, anchor: Callable[[Sql], Sql], stop: str) -> Sql:
    """Texts of the siblings after the first ``anchor`` node, then after its parent, up to ``stop``.

    NULL when there is no anchor.  A chunk that matches ``stop`` ends the list and is not part of it.
    """
    def after(n: Sql, of: Sql) -> Sql:
        return (n.getField("id") > of.getField("end")) & (n.getField("depth") == of.getField("depth"))

    def chunks(a: Sql) -> Sql:
        around = ancestors(nodes, a)
        parent, grand = F.get(around, F.lit(0)), F.get(around, F.lit(1))
        last = F.size(nodes) - 1
        near = F.filter(nodes, lambda n: F.coalesce(
            (after(n, a) & (n.getField("id") <= F.coalesce(parent.getField("end"), last)))
            | (parent.isNotNull() & after(n, parent) & (n.getField("id") <= F.coalesce(grand.getField("end"), last))),
            F.lit(False)))
        texts = F.filter(F.transform(near, lambda n: node_text(nodes, n, "\n")), lambda t: t != "")
        return let(texts, lambda r: let(
            F.array_position(F.transform(r, lambda t: t.rlike(stop)), True),
            lambda p: F.when(p > 0, F.slice(r, 1, (p - 1).cast("int"))).otherwise(r)))

    return let(first(nodes, anchor), lambda a: F.when(a.isNotNull(), chunks(a)))


@column_function
def longest(texts: Sql) -> Sql:
    """Longest text of an array, the earliest among equals."""
    ranked = F.transform(texts, lambda t, i: F.struct(F.length(t).alias("n"), (-i).alias("i"), t.alias("t")))
    return F.array_max(ranked).getField("t")
