"""Toxicity of whole texts behind obfuscation, by a noisy channel and a learned score.

Writers hide words by leetspeak (``1d10t``), spacing (``i d i o t``, ``i.d.i.o.t``) and
repetition (``idiooot``).  Each suspicious stretch becomes a lattice: a sign may stand
for itself or for a letter, a separator for itself or nothing, a repeated letter for
itself or nothing.  Signs without any letter (``455``) are read as a word only if the
whole of it is likelier than the number.  Repeated are signs that stand three times in a
row, or twice and more if none of a word's stands alone; otherwise doubled letters are
ordinary spelling (``w0rthl3ss``), so ``iddiot`` stays.  Viterbi decoding finds the path that is likeliest under the
channel and a character language model (orders 1 to 4) counted over all documents.

The restored text's words and word beginnings are features of a logistic regression.
Only labels teach it; language, source and ids are no features.

The language model and the features' counts are hashed tables of fixed size, summed
from one table per task.  The classifier is fitted on at most LABELLED_ROWS labelled
documents (those with the lowest id hashes); everything else covers all documents.

Rows: a null or empty text has no features and gets the score of the intercept.  Rows
without an id are not held out and teach nothing.  Repeated labels of an id count as toxic
if one of them is.  Repeated rows get equal scores.  Without labels of both kinds every
score is the share of toxic labels (half a label added to either kind).
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.llm.arrays import lean, offsets, parts, worker_cache

# Bounds of the classifier's training.
LABELLED_ROWS = 40_000
SELECTED_FEATURES = 20_000
# Fixed sizes of the hashed tables.
GRAM_BITS, FEATURE_BITS, SLICE = 18, 22, 1 << 16
ORDERS = 4
SMOOTHING = 4.0
REMEMBERED_WORDS = 100_000
REJECT_FROM = 0.7

# Signs and the letters that leetspeak writes with them.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c",
}
SEPARATORS = ".-_*'~/ "
# Log probabilities of the channel.
STANDS_FOR, AS_IT_IS, DROPPED_SEPARATOR, DROPPED_REPEAT = -1.0, -2.0, -1.5, -0.7

SIGN = r"(?:[^\W_]|[@$!|+€(])"
SPACED = re.compile(rf"(?<!\S){SIGN}(?:\s+{SIGN}){{2,}}(?!\S)")
PULLED = re.compile(r"([^\W\d_])\1\1+")
REPEATED = re.compile(rf"({SIGN})\1\1+")
# each sign's whole row at once: no other way to divide it up is tried when the rest doesn't fit
DOUBLED = re.compile(rf"(?:({SIGN})\1++){{2,}}|({SIGN})\2{{3,}}")
SPELLED = re.compile(rf"{SIGN}(?:[.\-_*'~/]+{SIGN})+")
LAST_SIGNS = re.compile(r"[$@]{1,2}(?![$@])")  # may be letters; a longer row of them is decoration
RIGHT_EDGE = "!?.,;:)]}\"'*%&#~|+<>=/-_$@€("
LEFT_EDGE = "([{\"'*%&#~<>=/-_.,;:?"
# Bits of character_kinds().  Longer words, and words between more marks, are read one by one.
ALPHA, SPACE, LEFT, RIGHT, LAST = 1, 2, 4, 8, 16
LONGEST_PLAIN, MOST_MARKS = 40, 8
FIT_BLOCK = 1 << 16
CRC_STEPS = np.array([zlib.crc32(bytes([i]), 0xFFFFFFFF) ^ 0xFFFFFFFF for i in range(256)], np.uint32)


def count_runs(points: np.ndarray, counts: np.ndarray, block: int = 1 << 14) -> None:
    """Adds all runs of 1 to len(counts) characters to the tables ``counts``.

    A run's hash goes on from that of the run without its last character; blocks stay in the processor's cache.
    """
    points = points.astype(np.uint64) + np.uint64(1)
    for a in range(0, len(points), block):
        h = np.zeros(block, np.uint64)
        for k, row in enumerate(counts):
            more = points[a + k : a + k + block]
            h = h[: len(more)] * np.uint64(0x9E3779B97F4A7C15) + more
            np.add.at(row, (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - GRAM_BITS)).view(np.int64), np.uint32(1))


def gram_bucket(text: str) -> int:
    h = 0
    for c in text:
        h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return (h * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF) >> (64 - GRAM_BITS)


def summed_tables(tables: DataFrame, kinds: int, size: int) -> np.ndarray:
    """Sums of the tasks' tables, which come in slices (kind, slice, packed uint32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for kind, i, packed in zip(*(batch.column(c).to_pylist() for c in ("kind", "slice", "packed"))):
                sums[kind, i] = sums.get((kind, i), 0) + np.frombuffer(zlib.decompress(packed), np.uint32).astype(np.uint64)
        if sums:
            keys, values = zip(*sums.items())
            yield slices_batch([k for k, _ in keys], [i for _, i in keys], [zlib.compress(v.tobytes(), 1) for v in values])

    out = np.zeros((kinds, size // SLICE, SLICE), np.uint64)
    total = tables.repartitionById(kinds * size // SLICE, F.col("kind") * (size // SLICE) + F.col("slice")).mapInArrow(lean(run), SLICES)
    # all at once: an iterator would run a job for each slice, one after the other
    for row in total.collect():
        out[row["kind"], row["slice"]] = np.frombuffer(zlib.decompress(row["packed"]), np.uint64)
    return out.reshape(kinds, size)


SLICES = "kind int, slice int, packed binary"


def slices_batch(kinds: list[int], slices: list[int], packed: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(slices, pa.int32()), pa.array(packed, pa.binary())], names=["kind", "slice", "packed"])


def table_slices(counts: np.ndarray) -> pa.RecordBatch:
    """The slices of a task's tables that aren't all zero."""
    found = [(k, i, zlib.compress(x.tobytes(), 1)) for k, row in enumerate(counts) for i, x in enumerate(row.reshape(-1, SLICE)) if x.any()]
    return slices_batch([k for k, _, _ in found], [i for _, i, _ in found], [x for _, _, x in found])


def letters_only(text: str) -> np.ndarray:
    """Code points of the lower-cased text; every run of other characters is one blank."""
    held = worker_cache("letters", 2)
    if "table" not in held:
        held["table"] = np.array([chr(c).isalpha() for c in range(0x110000)])
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    alpha = held["table"].take(points)
    keep = alpha.copy()
    keep[0] = True
    keep[1:] |= alpha[:-1]
    return np.where(alpha, points, np.uint32(32))[keep]


def count_grams(docs: DataFrame) -> np.ndarray:
    """Counts of runs of 1 to ORDERS characters over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((ORDERS, 1 << GRAM_BITS), np.uint32)
        for part in (p for batch in batches for p in parts(batch, "text")):
            count_runs(letters_only(" ".join([t for t in part.column("text").to_pylist() if t])), counts)
        yield table_slices(counts)

    return summed_tables(docs.select("text").mapInArrow(lean(run), SLICES), ORDERS, 1 << GRAM_BITS)


class Decoder:
    """Viterbi decoding of stretches under the language model ``counts``."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.total = float(counts[0].sum())
        self.known: dict[str, float] = {}

    def log_p(self, context: str, c: str) -> float:
        """log P(c | context), smoothed from order to order."""
        key = context + c
        if (out := self.known.get(key)) is None:
            p = (float(self.counts[0][gram_bucket(c)]) + 0.1) / (self.total + 100.0)
            for k in range(1, len(context) + 1):
                of = context[-k:]
                p = (float(self.counts[k][gram_bucket(of + c)]) + SMOOTHING * p) / (float(self.counts[k - 1][gram_bucket(of)]) + SMOOTHING)
            if len(self.known) > REMEMBERED_WORDS:
                self.known.clear()
            out = self.known[key] = math.log(p)
        return out

    def decode(self, stretch: str) -> str:
        """The likeliest letters behind a lower-case stretch; what is no letter stays only as itself."""
        # double letters are common; three and more may be one or two, and so may two if none stands alone
        again = {i for m in REPEATED.finditer(stretch) for i in range(m.start() + 1, m.end())}
        if DOUBLED.fullmatch(stretch):
            again = {i for i in range(1, len(stretch)) if stretch[i] == stretch[i - 1]}
        # a state is the last characters of the path; a node keeps each state's best path
        states: dict[str, tuple[float, tuple]] = {" ": (0.0, ())}
        for i, seen in enumerate(stretch):
            edges: list[tuple[str, float]] = [(seen, 0.0 if seen.isalpha() else AS_IT_IS)]
            edges += [(c, STANDS_FOR) for c in LEET.get(seen, "")]
            if seen in SEPARATORS:
                edges.append(("", DROPPED_SEPARATOR))
            elif i in again:
                edges.append(("", DROPPED_REPEAT))
            after: dict[str, tuple[float, tuple]] = {}
            for context, (score, path) in states.items():
                for c, cost in edges:
                    if not c and i in again and context[-1] == " ":
                        continue  # a row of digits that stand for themselves is no repeated letter
                    if c:
                        sign = c if c.isalpha() else " "
                        if sign == " " and context[-1] == " ":
                            found, state = score + cost, context
                        else:
                            found, state = score + cost + self.log_p(context, sign), (context + sign)[1 - ORDERS :]
                        way = (path, c)
                    else:
                        found, state, way = score + cost, context, path
                    if state not in after or after[state][0] < found:
                        after[state] = (found, way)
            states = after
        ends = {s: (score + (0.0 if s[-1] == " " else self.log_p(s, " ")), path) for s, (score, path) in states.items()}
        path, out = max(ends.values(), key=lambda x: x[0])[1], []
        while path:
            path, c = path
            out.append(c)
        return "".join(reversed(out)).rstrip(RIGHT_EDGE)

    def word(self, word: str) -> str:
        """The word, without marks at its edges, restored if it looks hidden."""
        held = word.lstrip(LEFT_EDGE)
        plain = held.rstrip(RIGHT_EDGE)
        last = LAST_SIGNS.match(held, len(plain))
        if plain.isalpha() and not last:
            return self.decode(plain) if PULLED.search(plain) or DOUBLED.fullmatch(plain) else plain
        held = plain + (last[0] if last else "")
        if not any(c.isalpha() for c in held):
            return self.signs(held) or plain
        if any(c in LEET for c in held) or PULLED.search(held) or SPELLED.fullmatch(held):
            return self.decode(held)
        return plain

    def restore(self, text: str) -> str:
        """The whole text, lower-cased and restored; white space between words becomes one blank."""
        return " ".join(map(self.word, self.unspaced(text.lower()).split()))

    def signs(self, stretch: str) -> str:
        """What signs without a letter spell; nothing if a number is likelier."""
        if not all(c in LEET or c in SEPARATORS for c in stretch):
            return ""
        out = self.decode(stretch)
        return out if out.replace(" ", "").isalpha() else ""

    def unspaced(self, text: str) -> str:
        """The text with its rows of single signs decoded, whatever blanks stand between them."""

        def row(m: re.Match) -> str:
            stretch = " ".join(m[0].split())
            return self.decode(stretch) if any(c.isalpha() for c in stretch) else self.signs(stretch) or m[0]

        return SPACED.sub(row, text)


def word_features(restored: str) -> list[int]:
    """Table places of the features of a restored word: itself and its beginnings."""
    out = []
    for w in restored.split():
        w = w.strip(LEFT_EDGE + RIGHT_EDGE)
        if len(w) > 2:
            found = [f"w{w}", *(f"b{w[:k]}" for k in (4, 5, 6) if len(w) >= k)]
            out += [zlib.crc32(x.encode()) & ((1 << FEATURE_BITS) - 1) for x in found]
    return out


def known_features(word: str, decoder: Decoder, known: dict[str, tuple[int, ...]]) -> tuple[int, ...]:
    """Table places of the features of a lower-case word.  ``known``: those of words met before."""
    if (found := known.get(word)) is None:
        if len(known) >= REMEMBERED_WORDS:
            known.clear()
        found = known[word] = tuple(word_features(decoder.word(word)))
    return found


def character_kinds() -> np.ndarray:
    """What every character is: the sum of the bits that hold for it."""
    held = worker_cache("kinds", 2)
    if "table" not in held:
        table = np.zeros(0x110000, np.uint8)
        for bit, of in ((ALPHA, str.isalpha), (SPACE, str.isspace)):
            table[np.fromiter(map(of, map(chr, range(len(table)))), np.bool_, len(table))] |= bit
        for bit, signs in ((LEFT, LEFT_EDGE), (RIGHT, RIGHT_EDGE), (LAST, "$@")):
            table[[ord(c) for c in signs]] |= bit
        held["table"] = table
    return held["table"]


def crc_fed(states: np.ndarray, points: np.ndarray) -> np.ndarray:
    """crc32 states after one more character each, in UTF-8."""
    out = CRC_STEPS[(states ^ points) & 255] ^ states >> 8
    if len(wide := np.flatnonzero(points > 127)):
        c, s = points[wide], states[wide]
        size = 2 + (c > 0x7FF) + (c > 0xFFFF)
        s = CRC_STEPS[(s ^ (0xF00 >> size & 0xFF | c >> 6 * (size - 1))) & 255] ^ s >> 8
        for k in (2, 1, 0):
            more = np.flatnonzero(size > k + 1)
            s[more] = CRC_STEPS[(s[more] ^ (0x80 | c[more] >> 6 * k & 0x3F)) & 255] ^ s[more] >> 8
        out[wide] = s
    return out


def plain_features(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """word_features of the words points[start:start+length], all of 3 to LONGEST_PLAIN letters: their numbers and the places."""
    order = np.argsort(-lengths, kind="stable")
    at, lengths = starts[order], lengths[order]
    # longer words stand first: so many have a character k
    longer = len(lengths) - np.searchsorted(lengths[::-1], np.arange(LONGEST_PLAIN + 1), side="right")
    whole, begun = (np.full(n, zlib.crc32(c) ^ 0xFFFFFFFF, np.uint32) for n, c in ((len(at), b"w"), (longer[3], b"b")))
    for k, n in enumerate(longer.tolist()):
        if not n:
            break
        c = points[at[:n] + k]
        whole[:n] = crc_fed(whole[:n], c)
        if k < 6:
            n = min(n, len(begun))
            begun[:n] = crc_fed(begun[:n], c[:n])
        if 3 <= k < 6:
            yield order[:n], ~begun[:n] & (1 << FEATURE_BITS) - 1
    yield order, ~whole & (1 << FEATURE_BITS) - 1


def text_features(texts: list[str], decoder: Decoder, known: dict[str, tuple[int, ...]], numbers: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and features of whole texts, each pair once and in order.  ``numbers``: by table places, the features' numbers; those below 0 are left out.

    Words of letters are read from all texts at once, marks around them cut off.  Words that may hide something, and
    texts with rows of single signs, are decoded one by one.
    """
    lowered = [t.lower() for t in texts]
    joined = "\n".join([*lowered, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = character_kinds().take(points)
    inside = np.zeros(len(points) + 1, np.bool_)
    np.equal(kinds & SPACE, 0, out=inside[1:])
    bounds = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = bounds[::2], bounds[1::2]
    row = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets([len(t) + 1 for t in lowered]))))

    # words between marks
    first, last = starts.copy(), ends.copy()
    for place, step, back, edge in ((first, 1, 0, LEFT), (last, -1, 1, RIGHT)):
        i = np.flatnonzero(kinds[place - back] & edge)
        for _ in range(MOST_MARKS):
            i = i[first[i] < last[i]]
            place[i] += step
            i = i[kinds[place[i] - back] & edge > 0]
    letters = np.zeros(len(points) + 1, np.int32)
    np.cumsum(kinds & ALPHA, dtype=np.int32, out=letters[1:])
    lengths = last - first
    plain = (lengths > 0) & (lengths <= LONGEST_PLAIN) & (letters[ends] - letters[starts] == lengths)
    plain &= (last == ends) | (kinds[last] & LAST == 0)
    # no letter three times in a row, none twice at both ends
    alike = points[1:] == points[:-1]
    thrice = np.flatnonzero(alike[1:] & alike[:-1] & (kinds[2:] & ALPHA > 0))
    plain[np.searchsorted(starts, thrice, side="right") - 1] = False
    i = np.flatnonzero(plain & (lengths > 3))
    plain[i[alike[first[i]] & alike[last[i] - 2]]] = False

    single = ends - starts == 1
    spaced = np.unique(row[2:][single[2:] & single[1:-1] & single[:-2] & (row[2:] == row[:-2])])
    left = ~plain
    if len(spaced):
        alone = np.isin(row, spaced)
        plain, left = plain & ~alone, left & ~alone
    words = [(r, w) for r in spaced.tolist() for w in set(decoder.unspaced(lowered[r]).split())]
    words += [(r, joined[a:b]) for r, a, b in zip(*(x[left].tolist() for x in (row, starts, ends)))]
    read = [(r, x) for r, w in words for x in known_features(w, decoder, known)]
    found = [tuple(np.array(read, np.int64).reshape(-1, 2).T)]
    i = np.flatnonzero(plain & (lengths > 2))
    found += [(row[i[k]], x) for k, x in plain_features(points, first[i], lengths[i])]
    if numbers is not None:
        found = [(r[hit], n[hit]) for r, x in found for n in (numbers[x],) for hit in (np.flatnonzero(n >= 0),)]
    pairs = np.unique(np.concatenate([r << 32 | x for r, x in found]))
    return pairs >> 32, pairs & 0xFFFFFFFF


@dataclass
class ToxicityModel:
    grams: np.ndarray
    wanted: dict[int, int]
    weights: np.ndarray
    intercept: float


def feature_numbers(wanted: dict[int, int]) -> np.ndarray:
    """The number of the feature at each table place, or -1."""
    out = np.full(1 << FEATURE_BITS, -1, np.int32)
    out[list(wanted)] = list(wanted.values())
    return out


def held_out(doc_id: Column) -> Column:
    """Rows that teach nothing: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """text and toxic (0/1) of the labelled documents that may teach."""
    taught = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    taught = taught.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic"))
    taught = taught.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    return docs.join(F.broadcast(taught), F.col("doc_id") == F.col("_id")).select("text", "toxic")


def fit(rows: list[np.ndarray], toxic: np.ndarray, features: int, penalty: float = 0.3, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression with an L2 penalty, by accelerated gradient steps.

    A step goes through blocks of rows of about FIT_BLOCK features, which stay in the processor's cache.
    """
    share = (toxic.sum() + 0.5) / (len(toxic) + 1.0)
    w, b = np.zeros(features), math.log(share / (1 - share))
    if not len(toxic) or not 0 < toxic.sum() < len(toxic):
        return w, b
    at, lengths = np.concatenate(rows).astype(np.int64), np.array([len(r) for r in rows])
    ends = offsets(lengths)
    cuts = sorted({0, *np.searchsorted(ends, range(FIT_BLOCK, int(ends[-1]), FIT_BLOCK)).tolist(), len(rows)})
    blocks = []
    for x, y in zip(cuts, cuts[1:]):
        some = np.flatnonzero(lengths[x:y])
        blocks.append((slice(x, y), at[ends[x] : ends[y]], lengths[x:y], some, (ends[x:y] - ends[x])[some]))
    seen = np.bincount(at, minlength=features) + penalty
    step = 1.0 / max(1.0, float(lengths.mean()))
    v, vb, gap = w.copy(), b, np.empty(len(rows))
    for k in range(steps):
        pull = penalty * v
        for block, found, each, some, first in blocks:
            sums = np.full(len(each), vb)
            if len(found):
                sums[some] += np.add.reduceat(v.take(found), first)
            gap[block] = 1 / (1 + np.exp(-np.clip(sums, -30, 30))) - toxic[block]
            pull += np.bincount(found, np.repeat(gap[block], each), minlength=features)
        new = v - step * pull / seen
        new_b = vb - step * 4 * gap.mean()
        v, vb = new + k / (k + 3) * (new - w), new_b + k / (k + 3) * (new_b - b)
        w, b = new, new_b
    return w, float(b)


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> ToxicityModel:
    """Language model over all ``docs``, classifier from their ``labels`` (doc_id, toxic)."""
    grams = count_grams(docs)
    context = docs.sparkSession.sparkContext
    held = context.broadcast(grams.astype(np.float32))
    taught = labelled(docs.select("doc_id", "text"), labels, rows)
    size = 1 << FEATURE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, known = Decoder(held.value), {}
        counts = np.zeros((2, size), np.uint32)
        for part in (p for batch in batches for p in parts(batch, "text")):
            rows, found = text_features([t or "" for t in part.column("text").to_pylist()], decoder, known)
            toxic = np.array([x > 0 for x in part.column("toxic").to_pylist()])[rows]
            for kind in (0, 1):
                np.add.at(counts[kind], found[toxic == kind], np.uint32(1))
        yield table_slices(counts)

    counts = summed_tables(taught.mapInArrow(lean(count), SLICES), 2, size)
    kinds = {r["toxic"] > 0: r["n"] for r in taught.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = float(kinds.get(False, 0)), float(kinds.get(True, 0))
    best = np.flatnonzero(counts[1] >= 2)
    clean, toxic = counts[:, best].astype(np.float64)
    del counts
    leans = toxic * n_clean > clean * n_toxic
    best, clean, toxic = best[leans], clean[leans], toxic[leans]
    rate = (clean + toxic) / max(1.0, n_clean + n_toxic)
    surprise = 2 * toxic * np.log(toxic / (rate * n_toxic))
    some = clean > 0
    surprise[some] += 2 * clean[some] * np.log(clean[some] / (rate[some] * n_clean))
    order = np.argsort(-surprise, kind="stable")[:SELECTED_FEATURES]
    best = best[order[surprise[order] >= 8]]
    wanted = {int(x): i for i, x in enumerate(best)}
    sent = context.broadcast(wanted)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, known, numbers = Decoder(held.value), {}, feature_numbers(sent.value)
        for part in (p for batch in batches for p in parts(batch, "text")):
            rows, found = text_features([t or "" for t in part.column("text").to_pylist()], decoder, known, numbers)
            each = np.split(found.astype(np.int32), np.searchsorted(rows, np.arange(1, part.num_rows)))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in each], pa.binary()), part.column("toxic").cast(pa.int32())], names=["found", "toxic"])

    # documents without a feature are all alike: their number is enough
    sample = taught.mapInArrow(lean(rows_of), "found binary, toxic int").groupBy("found", "toxic").agg(F.count("*").alias("n")).collect()
    sample.sort(key=lambda r: (bytes(r["found"]), r["toxic"]))
    rows_in = [np.frombuffer(bytes(r["found"]), np.int32) for r in sample for _ in range(r["n"])]
    weights, intercept = fit(rows_in, np.array([float(r["toxic"] > 0) for r in sample for _ in range(r["n"])]), len(wanted))
    return ToxicityModel(grams.astype(np.float32), wanted, weights, intercept)


def with_toxicity(docs: DataFrame, model: ToxicityModel, restored: str | None = None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and, if named, the column of restored texts.  Columns of these names are replaced."""
    added = {"score", (restored or "score").lower()}
    keep = [f for f in docs.schema.fields if f.name.lower() not in added]
    schema = docs.select(*[docs[f.name] for f in keep]).withColumn("score", F.lit(0.0))
    schema = (schema.withColumn(restored, F.lit("")) if restored else schema).schema
    # plain values: a broadcast is pickled by reference, and executors need not have the package
    held = docs.sparkSession.sparkContext.broadcast((model.grams, model.wanted, model.weights, model.intercept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, wanted, weights, intercept = held.value
        decoder, known, numbers = Decoder(grams), {}, feature_numbers(wanted)
        for part in (p for batch in batches for p in parts(batch, "text")):
            texts = [t or "" for t in part.column("text").to_pylist()]
            rows, found = text_features(texts, decoder, known, numbers)
            sums = intercept + np.bincount(rows, weights[found], minlength=len(texts))
            columns = [*(part.column(f.name) for f in keep), pa.array(1 / (1 + np.exp(-np.clip(sums, -700, 700))), pa.float64())]
            if restored:
                columns.append(pa.array([decoder.restore(t) for t in texts], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return docs.mapInArrow(lean(run), schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = with_toxicity(docs.select("doc_id", "text"), fit_toxicity(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= REJECT_FROM).cast("int").alias("predicted"))
