"""Byte-level BPE's first split, for many texts at once.

The pattern (``public_tokenizers.PATTERN``) cuts text into runs of letters,
digits, other characters and white space; one space joins the run after it, and
an apostrophe of its own takes a contraction's letters.  Here the runs of a
whole chunk of texts are found with array operations, and equal pieces are
numbered once, so the merges run once per distinct piece.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np

from pressloom.llm.arrays import offsets, slice_hashes, worker_cache

OTHER, LETTER, NUMBER, SPACE = range(4)
# The code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def classes() -> np.ndarray:
    held = worker_cache("char-classes", 4)
    if "table" not in held:
        kinds = {"L": LETTER, "N": NUMBER}
        table = np.full(0x110000, OTHER, np.uint8)
        # of the planes after these, only 14 is assigned: neither letters nor numbers in the others
        for first, stop in ((0, 0x40000), (0xE0000, 0xF0000)):
            table[first:stop] = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(first, stop)]
        table[WHITE_SPACE] = SPACE
        held["table"] = table
    return held["table"]


@dataclass
class Pieces:
    """Pieces of some texts: piece i is the distinct piece ``number[i]``; text t owns pieces rows[t]..rows[t+1].

    A distinct piece is known by its hash in ``keys``; its characters are ``whole[start:end]``.
    """

    keys: np.ndarray
    number: np.ndarray
    rows: np.ndarray
    whole: str
    starts: np.ndarray
    ends: np.ndarray

    def texts(self, which: np.ndarray) -> list[str]:
        """The characters of some distinct pieces."""
        return [self.whole[a:b] for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist())]

    @property
    def distinct(self) -> list[str]:
        return self.texts(np.arange(len(self.keys)))


def split_points(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Starts of all pieces.  ``rows``: offsets of the texts; no piece runs over a text's end."""
    kind = classes()[points]
    new = np.ones(len(points), np.bool_)
    new[1:] = kind[1:] != kind[:-1]
    new[rows[:-1][rows[:-1] < len(points)]] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(points))
    k = kind[start]
    text_end = np.zeros(len(points) + 1, np.bool_)
    text_end[rows[1:]] = True
    goes_on = ~text_end[end]  # another run of the same text follows

    cut = np.zeros(len(points) + 1, np.bool_)
    cut[start] = True
    before = (k == SPACE) & goes_on
    last = end - 1
    joins = before & (points[last] == 0x20)
    # the last white space stands apart from the others; a blank opens the next piece
    cut[last[before]] = True
    cut[end[joins]] = False

    alone = np.zeros(len(start), np.bool_)
    alone[1:] = ~joins[:-1]
    alone[0] = True
    mark = alone & (end - start == 1) & (points[start] == 0x27) & goes_on
    at = np.flatnonzero(mark)
    at = at[k[at + 1] == LETTER]
    if len(at):
        one = points[end[at]]
        room = end[at + 1] - end[at] >= 2
        two = np.where(room, points[np.minimum(end[at] + 1, len(points) - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for took, n in ((short, 1), (long & ~short, 2)):
            here = at[took]
            cut[end[here]] = False
            cut[end[here] + n] = True  # the rest of the letters, or the run that follows, which is a start already
        # a run that a blank had joined never follows a contraction without its own start
    cut[len(points)] = False
    return np.flatnonzero(cut)


def pieces(texts: list[str]) -> Pieces:
    whole = "".join(texts)
    rows = offsets([len(t) for t in texts])
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        none = np.zeros(0, np.int64)
        return Pieces(none.astype(np.uint64), none, np.zeros(len(texts) + 1, np.int64), whole, none, none)
    start = split_points(points, rows)
    end = np.append(start[1:], len(points))
    keys, first, number = np.unique(slice_hashes(points, start, end), return_index=True, return_inverse=True)
    return Pieces(keys, number, np.searchsorted(start, rows), whole, start[first], end[first])
