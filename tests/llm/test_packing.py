import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import odd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lotkeeper.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def placed(histogram, capacity):
    slots, bins = packing.plan_bins(histogram, capacity)
    use = defaultdict(list)
    for length, n in histogram.items():
        for rank in range(n):
            own = [s for s in slots if s[0] == length and s[1] <= rank][-1]
            ahead = rank - own[1]
            use[own[3] + ahead // own[2]].append((own[4] + ahead % own[2] * length, length))
    return use, bins


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_gapless_and_within_capacity(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 30, 100])
    histogram = {rng.randint(1, capacity): rng.randint(1, 9) for _ in range(rng.randint(0, 25))}
    use, bins = placed(histogram, capacity)
    assert len(use) == bins
    for items in use.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity
        assert sum(3 * length > capacity for _, length in items) <= 2


def test_plan_equals_matching_item_by_item():
    rng = random.Random(3)
    capacity, histogram = 60, Counter(rng.randint(21, 60) for _ in range(80))
    left, bins = sorted(histogram.elements()), 0
    while left:  # largest first with the largest that fits
        item = left.pop()
        fits = [x for x in left if x <= capacity - item]
        if fits:
            left.remove(fits[-1])
        bins += 1
    assert packing.plan_bins(dict(histogram), capacity)[1] == bins


def same_ids(texts):
    own, plain = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    assert own.ranked is not None
    for text in texts:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_ranks_give_the_tokenizers_ids():
    same_ids(["", "a  b", " a", "a ", "\n", "a\n\nb", "a\xa0b", "x<|endoftext|>y z", "don't  stop\t'll", "é\r\nb", "a \nb", "\x1c a b",
              "a\x85b c", "plain words. And\nlines, two\nof them", "\nfirst", "last\n", "a" * 30_000, " " * 30_000, "12" * 9_000])


def test_ranks_give_the_tokenizers_ids_on_any_characters():
    rng = random.Random(3)
    every = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    same_ids("\n".join(f"a{c}b {c}{c}1" for c in every[at:at + 4_000]) for at in range(0, 0x3000, 4_000))
    pool = every[:0x3000] + rng.sample(every, 2_000)
    blanks = [*" \t\n\r\x0b\x0c\x1c\x85\xa0\u2003\u3000\u200b", "'s", "'ll", "  "]
    same_ids("".join(rng.choice(rng.choice((pool, blanks, "abXY01.,'"))) for _ in range(rng.randint(1, 40))) for _ in range(2_000))


def test_other_kinds_of_tokenizers_are_used_as_they_are():
    own = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert own.ranked is None
    assert np.frombuffer(own.encode("Some words."), "<u4").tolist() == plain.encode("Some words.", add_special_tokens=False).ids


def test_cut_puts_the_remainder_first():
    assert packing.cut(5, 8) == [(0, 5)]
    assert packing.cut(16, 8) == [(0, 8), (8, 8)]
    assert packing.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def test_every_piece_round_trips(spark):
    capacity, frame = 64, odd.documents(spark)
    found = packing.pack(frame, PATH, capacity).collect()
    plain = Tokenizer.from_file(PATH)
    wanted = Counter()
    for doc_id, text, *_ in odd.rows():
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, (start, length) in enumerate(packing.cut(len(ids), capacity)):
            crc = zlib.crc32(np.asarray(ids[start:start + length], "<u4").tobytes())
            wanted[doc_id, piece, start, length, crc] += 1
    assert Counter(tuple(r)[:5] for r in found) == wanted
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for items in bins.values():
        items.sort()
        assert [o for o, _ in items] == [sum(n for _, n in items[:i]) for i in range(len(items))]
        assert sum(n for _, n in items) <= capacity
    total = sum(n for items in bins.values() for _, n in items)
    assert len(bins) <= total / capacity * 1.03 + 1


def test_empty_table(spark):
    assert packing.pack(odd.empty(spark), PATH).count() == 0
