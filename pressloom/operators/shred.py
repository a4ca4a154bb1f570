"""Page shredding: one Arrow pass turns HTML into an array of nodes.

This is the only per-row Python of the extraction.  It knows tags and nesting and
nothing about articles; every rule is a column expression on the node array.
"""

from __future__ import annotations

from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE = T.StructType([
    T.StructField("id", T.IntegerType()),      # position in the array, document order from 0
    T.StructField("end", T.IntegerType()),     # last id inside the element; its own id for text
    T.StructField("depth", T.IntegerType()),
    T.StructField("tag", T.StringType()),      # lower case, '#text' for text
    T.StructField("attr", T.MapType(T.StringType(), T.StringType())),
    T.StructField("text", T.StringType()),     # of text nodes, scripts and styles
    T.StructField("parent", T.IntegerType()),  # id of the element around it, -1 outside of all
    T.StructField("upto", T.IntegerType()),    # characters of visible text up to here, one more per piece
])

# HTML's nesting facts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset(["script", "style"])
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center dd details dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# The code points with the Unicode property White_Space.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
PARAGRAPH_SCOPE = frozenset(["table", "td", "th", "caption", "button", "object", "html"])


class _Nodes(HTMLParser):
    """Collects the nodes of one page in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.ends, self.depths, self.attrs, self.texts, self.parents = [], [], [], [], [], []
        self.open: list[tuple[str, int]] = []

    def _add(self, tag, attr, text):
        self.tags.append(tag)
        self.ends.append(len(self.ends))
        self.depths.append(len(self.open))
        self.attrs.append(attr)
        self.texts.append(text)
        self.parents.append(self.open[-1][1] if self.open else -1)

    def _pop_to(self, level):
        last = len(self.tags) - 1
        for _, node in self.open[level:]:
            self.ends[node] = last
        del self.open[level:]

    def _close_open(self, names, scope):
        for level in range(len(self.open) - 1, -1, -1):
            tag = self.open[level][0]
            if tag in names:
                return self._pop_to(level)
            if tag in scope:
                return None

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_PARAGRAPH:
            self._close_open({"p"}, PARAGRAPH_SCOPE)
        if tag in SIBLINGS:
            self._close_open(*SIBLINGS[tag])
        attr: dict = {}
        for name, value in attrs:
            attr.setdefault(name, value or "")
        self._add(tag, list(attr.items()), None)
        if tag not in VOID:
            self.open.append((tag, len(self.tags) - 1))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._pop_to(len(self.open) - 1)

    def handle_endtag(self, tag):
        self._close_open({tag}, ())

    def handle_data(self, data):
        if self.open and self.open[-1][0] in RAW_TEXT:
            node = self.open[-1][1]
            self.texts[node] = (self.texts[node] or "") + data
        elif self.tags and self.tags[-1] == "#text" and self.depths[-1] == len(self.open):
            self.texts[-1] += data
        else:
            self._add("#text", None, data)

    def finish(self):
        self.close()
        self._pop_to(0)

    def text_sums(self):
        """Running length of the trimmed, non-empty texts, each one longer for a separator."""
        pieces = [len(x.strip(WHITE_SPACE)) if tag == "#text" else 0 for tag, x in zip(self.tags, self.texts)]
        return accumulate(n + 1 if n else 0 for n in pieces)


@F.arrow_udf(T.ArrayType(NODE))
def shred(html: pa.Array) -> pa.Array:
    """Node array of each page; NULL for NULL."""
    offsets, ids, ends, depths, tags, attrs, texts, parents, sums = [0], [], [], [], [], [], [], [], []
    for page in html.to_pylist():
        if page is not None:
            p = _Nodes()
            p.feed(page)
            p.finish()
            ids.extend(range(len(p.tags)))
            ends += p.ends
            depths += p.depths
            tags += p.tags
            attrs += p.attrs
            texts += p.texts
            parents += p.parents
            sums += p.text_sums()
        offsets.append(len(ids))
    nodes = pa.StructArray.from_arrays(
        [
            pa.array(ids, pa.int32()), pa.array(ends, pa.int32()), pa.array(depths, pa.int32()),
            pa.array(tags, pa.string()), pa.array(attrs, pa.map_(pa.string(), pa.string())),
            pa.array(texts, pa.string()), pa.array(parents, pa.int32()), pa.array(sums, pa.int32()),
        ],
        names=[f.name for f in NODE],
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), nodes, mask=html.is_null())
