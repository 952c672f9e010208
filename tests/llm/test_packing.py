from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from siftledger.llm import packing, token_counts


def check(packing_, counts, capacity):
    used = Counter()
    for filling, times in packing_:
        assert times > 0 and sum(filling) <= capacity
        for x in filling:
            used[x] += times
    assert used == Counter({x: n for x, n in counts.items() if n})
    return sum(times for _, times in packing_)


def fewest(items, capacity):
    """The optimum for a handful of items, by trying all subsets around the largest."""
    if not items:
        return 0
    first, *rest = sorted(items, reverse=True)
    best = len(items)
    for n in range(len(rest) + 1):
        for chosen in combinations(range(len(rest)), n):
            if first + sum(rest[i] for i in chosen) <= capacity:
                left = [x for i, x in enumerate(rest) if i not in chosen]
                best = min(best, 1 + fewest(left, capacity))
    return best


@pytest.mark.parametrize("seed", range(25))
def test_optimal_on_small_cases(seed):
    draw = random.Random(seed)
    items = [draw.randint(1, 20) for _ in range(8)]
    counts = Counter(items)
    assert check(packing.pack_lengths(counts, 20), counts, 20) == fewest(items, 20)


def test_best_fit_is_improved():
    counts = Counter([6, 6, 5, 5, 5, 4, 4, 3, 2])  # 40 tokens: 4 bins of 10
    assert check(packing.pack_lengths(counts, 10), counts, 10) == 4


def test_close_to_the_bound_on_many():
    draw = random.Random(1)
    counts = Counter(min(2048, int(draw.lognormvariate(5.5, 1)) + 1) for _ in range(20_000))
    bins = check(packing.pack_lengths(counts), counts, 2048)
    total = sum(x * n for x, n in counts.items())
    assert bins <= -(-total // 2048) + 2


def test_cuts():
    assert packing.cuts(1, 8) == [(0, 1)]
    assert packing.cuts(8, 8) == [(0, 8)]
    assert packing.cuts(9, 8) == [(0, 1), (1, 8)]
    assert packing.cuts(24, 8) == [(0, 8), (8, 8), (16, 8)]


def test_every_token_is_packed_once(awkward):
    tokenizer = token_counts.tokenizer_at("byte_bpe_50k.json")
    capacity = 512
    rows = packing.packed_documents(awkward, capacity).collect()
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    expected = Counter()
    for r in awkward.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [packing.END_ID]
        for k, (start, length) in enumerate(packing.cuts(len(ids), capacity)):
            data = np.array(ids[start : start + length], "<u4").tobytes()
            expected[r["doc_id"], k, start, length, zlib.crc32(data)] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected


def test_empty_table(documents):
    assert packing.packed_documents(documents()).count() == 0


def test_pre_tokens_encoded_together_are_encoded_alone():
    """A row of pre-tokens, cut by bytes, gives what each gives by itself."""
    encoder = packing.Encoder()
    rows = [
        [" plain", " words", " plain-ish,", "\nline", " 12,345", " naïve", " 日本", " 😀😀", " é́"],
        [" a", " ", " b", "\n", " tab\t", "no", " x" * 3, " <|endoftext|>", " don't", "  wide"],
        [" q"],
        [],
    ]
    for row in rows:
        alone = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in row]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encoded(row)] == alone


def whole(encoder, texts):
    """What the tokenizer gives for each text in one go."""
    return [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("remembered", [packing.REMEMBERED, 3_000])
def test_ids_of_batches_are_those_of_whole_texts(monkeypatch, remembered):
    monkeypatch.setattr(packing, "REMEMBERED", remembered)
    encoder, draw = packing.Encoder(), random.Random(3)
    marks = [".", ",***", "'", "'s", "'ll", "-", "<|", "<|endoftext|>", "²", "́", "12"]
    blanks = [" ", " ", " ", "\n", "\n", "  ", "\t", "\r\n", " ", "\x1c", " "]
    words = ["a", "Word", "plain", "é", "naïve", "Łódź", "ǀɏ", "ß", "日本", "😀", "x" * 300]
    texts = [None, "", " ", "\n", "a", " a", "\na", None] + [
        "".join(draw.choice(draw.choice([words, words, marks, blanks])) for _ in range(n % 14))
        for n in range(3_000)
    ]
    for batch in (texts, texts[::-1], texts[3:40], [None], [""], []):
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder(pa.array(batch, pa.string()))]
        assert got == whole(encoder, batch)


def test_words_with_other_punctuation_are_not_tokenised_again():
    encoder, asked = packing.Encoder(), []
    encoder.encoded = lambda texts: asked.extend(texts) or [b""] * len(texts)
    model, calls = encoder.model, []

    class Counting:
        def tokenize(self, text):
            calls.append(text)
            return model.tokenize(text)

    encoder.model = Counting()
    texts = ["so plain*** plain!! (plain) plain", "so naïve, plain&&& naïve.%%%", "so plain###"]
    for text in texts:
        list(encoder(pa.array([text])))
    assert asked == [" (plain)"]
    assert sorted(calls) == sorted(set(calls))


def test_remembered_bytes_are_bounded(monkeypatch):
    """However long the pre-tokens are; frequent ones are kept when others go."""
    monkeypatch.setattr(packing, "REMEMBERED", 100_000)
    encoder = packing.Encoder()
    for n in range(100):
        list(encoder(pa.array([f"{n}{'x' * 5_000} 7{n}{'y' * 5_000} again word{n}"])))
    kept = [x for both in (encoder.known, encoder.later) for x in both]
    assert sum(len(k) + len(v) for x in kept for k, v in x.items()) < 2 * 100_000 + 30_000
    assert any("again" in x for x in encoder.later)
