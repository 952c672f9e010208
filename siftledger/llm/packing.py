"""Token sequences of fixed capacity, packed by bin completion over lengths.

Packing depends on lengths alone, and there are at most ``capacity`` of those. Spark
counts the pieces of each length; the driver packs that bounded histogram, whatever the
number of documents; and each piece finds its place from its number within its length.

Bin completion takes the largest remaining length and enumerates what may share its bin,
leaving out dominated fillings, and repeats a filling as often as its lengths allow. A
best-fit packing is the first incumbent; branches whose waste already rules out a smaller
number of bins are cut.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from siftledger.llm.common import (
    arrow_batches_of,
    hash63,
    shuffle_partitions,
    table,
    with_ordinal,
    worker_memory,
)
from siftledger.llm.token_counts import (
    VOCABULARY,
    has_double,
    led,
    pre_tokens,
    tokenizer_at,
)
from siftledger.session import materialise

CAPACITY = 2048
# The id that ends a document.
END_ID = 0
# Pre-tokens are forgotten by generation: one fills up to this many bytes, about 100,000
# of them, and the one before it is kept beside it. What both lack is tokenised again.
REMEMBERED = 25_000_000
# What a remembered pre-token takes besides its characters and ids.
ENTRY = 220
# Texts that a worker gets at once, and ids that it hands back at once.
BATCH_BYTES = 4_000_000
# Steps of the search, and fillings it tries per bin (the first found in 400 steps). They
# bound how good the packing gets: sequences may be more than need be, no piece is left out.
STEPS = 3_000
FILLINGS = 8


# A space or line break, Latin letters and ASCII punctuation, each perhaps none but the
# letters. The byte-level pattern cuts such a pre-token before its letters, unless a space
# stands there, and after them; these letters are the same in every version of Unicode.
_WORD = re.compile(r"(\n?)((?:(?<!\n) )?[A-Za-zÀ-ÖØ-öø-ɏ]+)([!-/:-@\[-`{-~]*)")


def _byte_characters() -> dict[int, str]:
    """The character that the byte-level vocabulary writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [x for x in range(256) if x not in shown]
    return {x: chr(x) for x in shown} | {x: chr(256 + n) for n, x in enumerate(others)}


_WRITTEN = _byte_characters()


class Encoder:
    """Token ids of whole texts as little-endian 32-bit bytes; pre-tokens are remembered."""

    def __init__(self, name: str = VOCABULARY):
        self.tokenizer = tokenizer_at(name)
        self.model = self.tokenizer.model
        # Pre-tokens by themselves, and by the part that a space or line break precedes:
        # those of this generation, and those of the one before.
        self.known: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self.later: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}
        self.held = 0
        self.ends: dict[str, bytes] = {"": b""}
        # A token of the byte-level vocabulary is written with one character per byte.
        written = self.tokenizer.get_vocab()
        self.n_bytes = np.zeros(max(written.values(), default=0) + 1, np.int64)
        for token, number in written.items():
            self.n_bytes[number] = len(token)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        before = self.tokenizer.pre_tokenizer
        self.by_parts = (
            isinstance(before, ByteLevel)
            and not before.add_prefix_space
            and before.use_regex
            and self.tokenizer.normalizer is None
            and not any(_WORD.search(x) and _WORD.fullmatch(x) for x in self.special)
        )

    def encoded(self, texts: list[str]) -> list[bytes]:
        """The ids of each pre-token by itself.

        Pre-tokens that begin with a space or line break and end in something else do not
        touch in a row: they are encoded as one text, whose ids are cut by the bytes they
        stand for. The others, and rows with a special string, are encoded one by one.
        """
        row = [t for t in texts if t[:1] in (" ", "\n") and not t[-1:].isspace()]
        joined = "".join(row)
        found: dict[str, bytes] = {}
        if row and not any(x in joined for x in self.special):
            (one,) = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)
            ids = np.array(one.ids, np.uint32)
            upto = np.append(0, np.cumsum(self.n_bytes[ids]))
            ends = np.cumsum([len(t.encode()) for t in row])
            cuts_at = np.searchsorted(upto, ends)
            if np.array_equal(upto[cuts_at], ends):
                raw = ids.astype("<u4").tobytes()
                starts = [0, *(4 * cuts_at).tolist()]
                found = {t: raw[a:b] for t, a, b in zip(row, starts, starts[1:])}
        single = [t for t in texts if t not in found]
        alone = self.tokenizer.encode_batch_fast(single, add_special_tokens=False)
        found |= {t: array("I", e.ids).tobytes() for t, e in zip(single, alone)}
        return [found[t] for t in texts]

    def _word(self, text: str) -> bytes:
        """The ids of what the byte-level pattern leaves whole, as the model has them."""
        if text.isascii():
            text = text.replace(" ", _WRITTEN[32])
        else:
            text = text.encode().decode("latin-1").translate(_WRITTEN)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def _end(self, text: str) -> bytes:
        """The ids of a line break or of punctuation by itself; few of them differ."""
        found = self.ends.get(text)
        if found is None:
            if len(self.ends) > 1_000:
                self.ends = {"": b""}
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = self.ends[text] = array("I", ids).tobytes()
        return found

    def _learned(self, new: list[str], known: dict, before: dict, whole) -> dict[str, bytes]:
        """The ids of new pre-tokens: of words by their parts, of others by the tokenizer."""
        found, others, match = {}, [], _WORD.fullmatch
        for key in new:
            word = match(whole(key)) if self.by_parts else None
            if word is None:
                others.append(key)
                continue
            line, text, end = word.groups()
            if end:
                stem = key[: -len(end)]
                ids = known.get(stem) or before.get(stem) or found.get(stem)
                if ids is None:
                    ids = found[stem] = self._end(line) + self._word(text)
                found[key] = ids + self._end(end)
            elif key not in found:
                ids = self._word(text)
                found[key] = self._end(line) + ids if line else ids
        found.update(zip(others, self.encoded([whole(k) for k in others])))
        return found

    def _ids(self, which: str, keys: list[str], whole=str) -> list[bytes]:
        known, before = getattr(self, which)
        ids = list(map(known.get, keys))
        if None in ids:
            missing = [k for k, x in zip(keys, ids) if x is None]
            found = {k: before[k] for k in missing if k in before}
            new = [k for k in missing if k not in found] if found else missing
            found |= self._learned(new, known, before, whole)
            known.update(found)
            ids = list(map(known.get, keys))
            self.held += ENTRY * len(found) + 2 * sum(map(len, found))
            if self.held > REMEMBERED:
                self.known, self.later = ({}, self.known[0]), ({}, self.later[0])
                self.held = 0
        return ids

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, none for NULL. Parts that texts share are looked up once."""
        texts = pc.fill_null(texts, "")
        whole = [None if has_double(x) else x for x in texts.to_pylist()]
        # As in ``spaced``; of a text without double white space only the first part has
        # neither a space nor a line break before it.
        plain = pc.if_else(pa.array([x is not None for x in whole], pa.bool_()), texts, "")
        parts = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        coded = parts.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(self._ids("later", distinct, led), pa.binary())
        ids = ids.take(coded.indices)
        data = memoryview(ids.buffers()[2] or b"")
        at = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, 4 * ids.offset)
        bounds = np.append(0, np.cumsum(parts.value_lengths().to_numpy(zero_copy_only=False)))
        starts, ends = at[bounds[:-1] + 1].tolist(), at[bounds[1:]].tolist()
        for row, (text, start, end) in enumerate(zip(whole, starts, ends)):
            if text is None:
                yield b"".join(self._ids("known", pre_tokens(texts[row].as_py())))
            else:
                first = text[: re.search(r"[ \n]|$", text).start()]
                head = self._ids("known", [first]) if first else []
                yield b"".join([*head, data[start:end]])


def worker_encoder(name: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return worker_memory(f"token ids {name}", lambda: Encoder(name))


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; only the first may be short."""
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


def pieces(docs: DataFrame, capacity: int = CAPACITY, name: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length and ids (little-endian 32-bit) of every piece.

    A NULL or empty text is the single end id. Repeated rows have pieces of their own;
    other columns are not read. An empty table gives none.
    """

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = worker_encoder(name), np.array([END_ID], "<u4").tobytes()
        for part in parts:
            rows: list[tuple] = []
            held = 0
            for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1))):
                ids += end
                for k, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    rows.append((doc, k, start, length, ids[4 * start : 4 * (start + length)]))
                held += len(ids)
                if held > BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
            yield _batch(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids binary"
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64()}
    types["ids"] = pa.binary()
    columns = zip(*rows) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, types.values())], names=list(types)
    )


class Lengths:
    """How many pieces of each length are left, and which lengths those are."""

    def __init__(self, counts: dict[int, int]):
        self.counts = dict(counts)
        self.left = sorted(x for x, n in counts.items() if n)

    def copy(self) -> Lengths:
        new = Lengths.__new__(Lengths)
        new.counts, new.left = dict(self.counts), list(self.left)
        return new

    def take(self, filling: tuple[int, ...]) -> int:
        """Take the filling as often as possible; how often that was."""
        used = Counter(filling)
        times = min(self.counts[x] // k for x, k in used.items())
        for x, k in used.items():
            self.counts[x] -= k * times
            if not self.counts[x]:
                self.left.remove(x)
        return times

    def fitting(self, space: int, used: Counter) -> int | None:
        """The largest length left that fits."""
        at = bisect_right(self.left, space)
        while at:
            at -= 1
            if self.counts[self.left[at]] > used[self.left[at]]:
                return self.left[at]
        return None


def best_fit(lengths: Lengths, capacity: int) -> tuple[int, ...]:
    """The largest length left, and always the largest that still fits."""
    filling = [lengths.left[-1]]
    used, space = Counter(filling), capacity - filling[0]
    while (x := lengths.fitting(space, used)) is not None:
        filling.append(x)
        used[x] += 1
        space -= x
    return tuple(filling)


def _dominated(filling: tuple[int, ...], slack: int, lengths: Lengths, used: Counter) -> bool:
    """Whether one or two of the added lengths could give way to a larger one that is left."""
    added = filling[1:]
    for i, x in enumerate(added):
        y = lengths.fitting(min(x + slack, filling[0]), used)
        if y is not None and y > x:
            return True
        for z in added[i + 1 :]:
            y = lengths.fitting(min(x + z + slack, filling[0]), used)
            if y is not None and y >= x + z:
                return True
    return False


def fillings(lengths: Lengths, capacity: int, waste: int, steps: int) -> Iterator[tuple[int, ...]]:
    """Undominated fillings around the largest length that waste at most ``waste``."""
    largest = lengths.left[-1]

    def extend(filling: tuple[int, ...], used: Counter, space: int) -> Iterator[tuple[int, ...]]:
        nonlocal steps
        limit, closed = min(space, filling[-1]), True
        while steps > 0 and (x := lengths.fitting(limit, used)) is not None:
            closed = False
            steps -= 1
            used[x] += 1
            yield from extend((*filling, x), used, space - x)
            used[x] -= 1
            limit = x - 1
        if closed and space <= waste and not _dominated(filling, space, lengths, used):
            yield filling

    yield from extend((largest,), Counter([largest]), capacity - largest)


def _choices(lengths: Lengths, capacity: int, waste: int, greedy: tuple[int, ...]) -> list:
    """The best fit and some undominated fillings, least waste first."""
    found = {greedy} if capacity - sum(greedy) <= waste else set()
    for filling in islice(fillings(lengths, capacity, waste, 400), FILLINGS):
        found.add(filling)
        if sum(filling) == capacity:
            break
    return sorted(found, key=lambda f: (-sum(f), [-x for x in f]))


Packing = list[tuple[tuple[int, ...], int]]


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> Packing:
    """Fillings and how often each is used, for the given number of pieces of each length."""
    total = sum(x * n for x, n in counts.items())
    halves = sum(n for x, n in counts.items() if 2 * x > capacity)
    fewest = max(-(-total // capacity), halves)

    lengths, incumbent = Lengths(counts), []
    while lengths.left:
        filling = best_fit(lengths, capacity)
        incumbent.append((filling, lengths.take(filling)))
    bins = sum(n for _, n in incumbent)

    # Depth first. A level holds the lengths left, the packing's waste so far and the
    # fillings still to try; the last bins, which waste most, are tried anew first.
    start = Lengths(counts)
    levels = [(start, 0, None)] if start.left else []
    path: Packing = []
    while levels and bins > fewest and steps > 0:
        lengths, wasted, untried = levels[-1]
        allowed = (bins - 1) * capacity - total - wasted
        if untried is None:
            untried = _choices(lengths, capacity, allowed, best_fit(lengths, capacity))
            levels[-1] = (lengths, wasted, untried)
        steps -= 1
        if not untried or allowed < 0:
            levels.pop()
            if path:
                path.pop()
            continue
        filling = untried.pop(0)
        left = lengths.copy()
        times = left.take(filling)
        spent = wasted + times * (capacity - sum(filling))
        if spent + total > (bins - 1) * capacity and left.left:
            continue
        path.append((filling, times))
        if left.left:
            levels.append((left, spent, None))
        else:
            if sum(n for _, n in path) < bins:
                incumbent, bins = list(path), sum(n for _, n in path)
            path.pop()
    return incumbent


def _places(packing: Packing) -> list[tuple[int, int, int, int, int, int]]:
    """For each filling and length in it: length, first and last number, copies, offset, bin."""
    rows, begun, sequence = [], Counter(), 0
    for filling, times in packing:
        offset = 0
        for x, copies in sorted(Counter(filling).items(), reverse=True):
            first = begun[x]
            begun[x] += copies * times
            rows.append((x, first, begun[x] - 1, copies, offset, sequence))
            offset += copies * x
        sequence += times
    return rows


def packed(stored: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces with a ``length`` of 1 to ``capacity``.

    The broadcast holds at most ``capacity`` fillings of under ``sqrt(2 * capacity)``
    distinct lengths each.
    """
    spark = stored.sparkSession
    counts = {r["length"]: r["count"] for r in stored.groupBy("length").count().collect()}
    places = spark.createDataFrame(
        _places(pack_lengths(counts, capacity)),
        "_length long, _first long, _last long, _copies long, _offset long, _sequence long",
    )
    bits = (2 * shuffle_partitions(spark) - 1).bit_length()
    spread = stored.withColumn(
        "_bucket", F.shiftrightunsigned(hash63("doc_id", "piece", "start"), 63 - bits)
    )
    numbered = with_ordinal(spread, ["length"], ["_bucket"], ["doc_id", "piece"], "_number")
    inside = (
        (F.col("length") == F.col("_length"))
        & (F.col("_number") >= F.col("_first"))
        & (F.col("_number") <= F.col("_last"))
    )
    at = F.col("_number") - F.col("_first")
    return numbered.join(F.broadcast(places), inside).select(
        *stored.columns,
        (F.col("_sequence") + F.call_function("div", at, F.col("_copies"))).alias("sequence_id"),
        (F.col("_offset") + (at % F.col("_copies")) * F.col("length")).alias("offset"),
    )


def packed_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its checksum and its place in a sequence."""
    cut = pieces(docs, capacity).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32")
    )
    with arrow_batches_of(docs.sparkSession, BATCH_BYTES):
        stored = materialise(cut, "pieces")
    return packed(stored, capacity)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(table(spark, folder, "documents"))
