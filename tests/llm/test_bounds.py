"""What the operators hold and ask for at a time."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from pressloom.llm import arrays, bpe, pretokens, substring_dedup, token_files
from pressloom.llm.queries import RANKS, TOKENIZER


class Counted:
    """A tokenizer that counts the texts it gets."""

    def __init__(self, of):
        vars(self).update(of=of, texts=0)

    def __getattr__(self, name):
        return getattr(self.of, name)

    def __setattr__(self, name, value):
        setattr(self.of, name, value)

    def encode_batch_fast(self, texts, **how):
        vars(self)["texts"] += len(texts)
        return self.of.encode_batch_fast(texts, **how)


def test_new_pieces_reach_the_library_many_in_one_text():
    plain, rng = token_files.Tokenizer.from_file(TOKENIZER), random.Random(3)
    signs = "ab zZ'\u00e9\u4e2d9\n\t.\x00\ue000\U0001f600\u0301 "
    texts = [" ".join(f"word{i}x{rng.randrange(10**9)}" for i in range(2000))]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += ["", "one <|endoftext|> two", "".join(token_files.MARKS), "\x00<|endoftext|>\x00", " " * 5000, "x" * 5000]
    for some in (texts, texts[:1], texts[-5:]):
        counted = Counted(token_files.Tokenizer.from_file(TOKENIZER))
        got = [x.tolist() for x in token_files.library_ids(some, counted, f"test{len(some)}")]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in some]
    counted = Counted(token_files.Tokenizer.from_file(TOKENIZER))
    list(token_files.library_ids(texts[:1], counted, "one text"))
    assert counted.texts < 20 and counted.pre_tokenizer.use_regex
    # all marks occur: each piece goes alone
    assert token_files.joined_ids([*token_files.MARKS], counted, "marks") is None


def test_character_classes_are_the_categories():
    import unicodedata

    kinds = {"L": pretokens.LETTER, "N": pretokens.NUMBER}
    want = [kinds.get(unicodedata.category(chr(c))[0], pretokens.OTHER) for c in range(0x110000)]
    table = pretokens.classes()
    differ = np.flatnonzero(table != np.array(want, np.uint8))
    assert set(differ.tolist()) <= set(pretokens.WHITE_SPACE)


def test_hashes_need_little_beside_the_text():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 256, 1_000_000).astype(np.uint8)
    starts = np.arange(0, 999_000, 10)
    arrays.worker_cache("none", 1)
    tracemalloc.start()
    got = arrays.slice_hashes(values, starts, starts + 15)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12_000_000
    assert got.tolist()[:50] == [int(arrays.slice_hashes(values[a : a + 15], np.array([0]), np.array([15]))[0]) for a in starts[:50]]


def test_windows_take_sixteen_bytes():
    hashes, row, place = substring_dedup.windows_of(pa.array([" ".join(f"w{i}" for i in range(500)), None, "a b"]), 20)
    assert len(hashes) == 481 and hashes.itemsize + row.itemsize + place.itemsize == 16


def test_merges_share_queues_of_bounded_size(monkeypatch):
    encoder, rng, sizes = bpe.encoder(RANKS), random.Random(2), []
    pieces = [bytes(rng.choice(b"abcde fgh'01") for _ in range(rng.randrange(14))) for _ in range(3000)]
    pieces[7] = b"x" * 5000
    ids, stops = encoder._merge(np.frombuffer(b"".join(pieces), np.uint8), arrays.offsets([len(p) for p in pieces]))
    merge = encoder._merge
    monkeypatch.setattr(bpe, "MERGED_BYTES", 1000)
    monkeypatch.setattr(encoder, "_merge", lambda data, edges: sizes.append(len(data)) or merge(data, edges))
    got, at = encoder.encode_many(pieces)
    assert (got == ids).all() and (at == stops).all() and sorted(sizes)[-2] < 2000 and len(sizes) > 15
    assert encoder.encode_many([])[1].tolist() == [0] and encoder.encode(b"") == []
