"""Benchmark items found in documents, also with other numbers, names and units.

Words become template tokens: numbers, units and names are typed placeholders. Windows
of template tokens (and, beside them, of plain lower-case words) are hashed and joined
with the benchmark's windows. Verbatim windows count as they are. In template windows, a
benchmark name or unit stands for one value of the document, and two names for two; slots
that disagree with most others take out the template windows that hold them. Numbers are
free: one number may stand for two quantities, and two quantities may become equal.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger.llm.common import fresh, mixed, strings, table, worker_memory

WINDOW = 8
# Plain words a window needs, so that placeholders alone never match.
PLAIN = 5
# Words of an item that must be covered: this many, or all of a shorter item.
COVERED = 13
# Benchmark words per broadcast block: about 60 MB of windows in a worker.
BLOCK_WORDS = 1_000_000

# Words a worker remembers at once; a forgotten word is read again.
REMEMBERED = 300_000

# Fixed values.
UNITS = frozenset(
    "mm cm m km in ft yd mi g kg mg lb lbs oz t l ml s sec min h hr hrs ms hz khz mhz ghz b kb mb "
    "gb tb w kw mw v a j k c f % ° °c °f $ € £ usd eur gbp cent cents dollar dollars euro euros "
    "meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters "
    "inch inches foot feet yard yards mile miles gram grams kilogram kilograms pound pounds ounce "
    "ounces liter liters litre litres second seconds minute minutes hour hours day days week weeks "
    "month months year years percent degree degrees".split()
)
SPELLED = frozenset(
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion".split()
)
PLACEHOLDERS = ("", "\x00number", "\x00unit", "\x00name")
WORD, NUMBER, UNIT, NAME = range(4)
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:%|[a-zA-Z°]{1,3})?")
_EDGE = re.compile(r"^[^\w$€£%°+-]+|[^\w%°$€£]+$")
_STOPS = ".?!:"


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


class _Known(dict):
    """Words and their numbers; a new word is added by the reader."""

    def __init__(self, add):
        self.add = add

    def __missing__(self, word: str) -> int:
        return self.add(word)


class Reader:
    """Whole texts as arrays: literal hashes, template hashes, kinds, and the words."""

    def __init__(self):
        self.known = _Known(self._add)
        self._clear(REMEMBERED)

    def _clear(self, most: int) -> None:
        self.known.clear()
        self.literal = np.zeros(most, np.uint64)
        self.kind = np.zeros(most, np.int8)
        self.capital, self.stop = np.zeros(most, bool), np.zeros(most, bool)

    def _add(self, word: str) -> int:
        core = _EDGE.sub("", word)
        low = core.lower()
        if not core:
            kind = -1
        elif low in SPELLED or _NUMBER.fullmatch(core):
            kind = NUMBER
        elif low in UNITS and len(low) > 1 or low in ("%", "°", "$", "€", "£"):
            kind = UNIT
        else:
            kind = WORD
        self.known[word] = at = len(self.known)
        self.literal[at] = _hash(low)
        self.kind[at] = kind
        self.capital[at] = core[:1].isupper() and core[1:2].islower()
        self.stop[at] = word[-1] in _STOPS or word[-2:-1] in _STOPS
        return at

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Literal and template hashes, kinds, and each token's place among the words."""
        words = text.split()
        if len(self.known) + len(words) > len(self.literal):
            self._clear(max(REMEMBERED, len(words)))
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        kinds = self.kind[at]
        opens = np.ones(len(at), bool)
        opens[1:] = self.stop[at[:-1]]
        kinds = np.where((kinds == WORD) & self.capital[at] & ~opens, NAME, kinds)
        place = np.flatnonzero(kinds >= 0)
        kinds = kinds[place]
        literal = self.literal[at[place]]
        return literal, np.where(kinds == WORD, literal, _HASHES[kinds]), kinds, place


def worker_reader() -> Reader:
    """One reader for all tasks of a Python worker."""
    return worker_memory("templates", Reader)


_HASHES = np.array([_hash(p) for p in PLACEHOLDERS], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def windows(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of ``size`` codes."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * _ODD + codes[i : i + n]
    return mixed(total)


def _size(n: int) -> int:
    """Window length for an item of ``n`` tokens: shorter items are one window."""
    return min(WINDOW, n)


class Benchmark:
    """The windows of a block of items, for lookup."""

    def __init__(self, items: list[tuple[int, str]]):
        reader = Reader()
        # By the item's number in the block; ids may be NULL or repeated.
        self.ids = [item for item, _ in items]
        self.words: dict[int, tuple] = {}
        found = defaultdict(list)
        for item, (_, text) in enumerate(items):
            literal, template, kinds, place = reader.read(text or "")
            n = len(literal)
            if n == 0:
                continue
            words = text.split()
            self.words[item] = ([_EDGE.sub("", words[p]).lower() for p in place], kinds, literal)
            size = _size(n)
            plain = np.convolve(kinds == WORD, np.ones(size, int), "valid")
            for codes, least in ((literal, 0), (template, min(PLAIN, size))):
                for at, (code, has) in enumerate(zip(windows(codes, size).tolist(), plain)):
                    if has >= least:
                        found[size].append((code, item, at))
        self.sizes = {}
        for size, rows in found.items():
            rows = sorted(set(rows))
            codes = np.array([r[0] for r in rows], np.uint64)
            near = np.zeros(1 << 20, bool)
            near[(codes >> np.uint64(44)).astype(np.int64)] = True
            self.sizes[size] = (near, codes, rows)

    def hits(self, codes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(place in the document, item's number, place in the item, window length)."""
        for size, (near, known, rows) in self.sizes.items():
            hashes = windows(codes, size)
            maybe = np.flatnonzero(near[(hashes >> np.uint64(44)).astype(np.int64)])
            if not len(maybe):
                continue
            first = np.searchsorted(known, hashes[maybe])
            for at, k in zip(maybe.tolist(), first.tolist()):
                while k < len(rows) and rows[k][0] == hashes[at]:
                    yield at, rows[k][1], rows[k][2], size
                    k += 1

    def leaks(self, reader: Reader, text: str, covered: int) -> list[dict]:
        """Items that the text holds, verbatim or with other slot values."""
        literal, template, kinds, place = reader.read(text)
        verbatim = set(self.hits(literal))
        found = set(verbatim)
        if (kinds != WORD).any():
            found |= set(self.hits(template))
        if not found:
            return []
        words = text.split()
        by_item: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for at, item, of, size in found:
            by_item[item][at - of].append((of, size, (at, item, of, size) in verbatim))
        leaks = []
        for item, diagonals in sorted(by_item.items()):
            values, item_kinds, item_literal = self.words[item]
            best = None
            for shift, hits in diagonals.items():
                filled = {}
                for x in sorted({x for a, size, _ in hits for x in range(a, a + size)}):
                    if literal[x + shift] == item_literal[x]:
                        filled[x] = values[x]
                    else:
                        filled[x] = _EDGE.sub("", words[place[x + shift]]).lower()
                bad = _inconsistent([(x, item_kinds[x], values[x], y) for x, y in filled.items()])
                kept = [range(a, a + n) for a, n, same in hits if same or bad.isdisjoint(range(a, a + n))]
                of = sorted({x for window in kept for x in window})
                slots = sum(int(item_kinds[x] != WORD) for x in of)
                changed = sum(filled[x] != values[x] for x in of)
                if of and (best is None or len(of) > best["words"]):
                    best = {
                        "item_id": self.ids[item],
                        "words": len(of),
                        "first_word": int(place[of[0] + shift]),
                        "slots": slots,
                        "changed": changed,
                    }
            total = 0 if best is None else best["words"]
            if total >= min(covered, len(values)):
                leaks.append(best)
        return leaks


def _inconsistent(filled: list[tuple]) -> set[int]:
    """Places of the slots (place, kind, item's value, document's value) that disagree with most.

    Where no value has most, all that disagree are taken.
    """
    bad = set()
    for kinds, mine, theirs in (((UNIT, NAME), 2, 3), ((NAME,), 3, 2)):
        stands = defaultdict(Counter)
        for slot in filled:
            if slot[1] in kinds:
                stands[slot[1], slot[mine]][slot[theirs]] += 1
        for slot in filled:
            counts = stands.get((slot[1], slot[mine]), {})
            if len(counts) > 1:
                (value, first), (_, second) = counts.most_common(2)
                if first == second or slot[theirs] != value:
                    bad.add(slot[0])
    return bad


def _one_per_id(leaks: list[dict]) -> list[dict]:
    """Of each item id the leak of the most words, the first of equal ones."""
    best: dict[int | None, dict] = {}
    for leak in leaks:
        known = best.setdefault(leak["item_id"], leak)
        if leak["words"] > known["words"]:
            best[leak["item_id"]] = leak
    return list(best.values())


LEAKS = "array<struct<item_id:bigint,words:bigint,first_word:bigint,slots:bigint,changed:bigint>>"
_TYPE = pa.list_(
    pa.struct([(n, pa.int64()) for n in ("item_id", "words", "first_word", "slots", "changed")])
)


def _blocks(benchmark: DataFrame, words: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``words`` words (one larger item is a block)."""
    block, held = [], 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        n = len((row["text"] or "").split())
        if block and held + n > words:
            yield block
            block, held = [], 0
        block.append((row["item_id"], row["text"]))
        held += n
    if block:
        yield block


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    name: str = "leaks",
    covered: int = COVERED,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Add the array ``name``: item_id, words, first_word, slots and changed per leaked item.

    The benchmark is broadcast in blocks of bounded size; each block reads the documents
    once. Documents are never shuffled, so no passage or source is a hot key. A NULL or
    empty text, or item, matches nothing; repeated rows are judged one by one; texts under
    one item id (NULL is one) are judged each, and the longest match is given. ``name`` is lengthened where ``docs`` has such a column.
    """
    spark = docs.sparkSession
    columns = docs.columns
    (name,) = fresh(docs, name)
    found = docs.withColumn(name, F.lit(None).cast(LEAKS))
    for block in _blocks(benchmark, block_words):
        shared = spark.sparkContext.broadcast(block)
        schema = found.schema

        def search(parts: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known, reader = Benchmark(shared.value), worker_reader()
            for part in parts:
                texts = strings(part.column(columns.index("text")))
                before = part.column(len(columns)).to_pylist()
                now = [
                    _one_per_id((b or []) + known.leaks(reader, t, covered))
                    for b, t in zip(before, texts)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(now, _TYPE)], names=part.schema.names
                )

        found = found.mapInArrow(search, schema)
    return found.withColumn(name, F.coalesce(name, F.array().cast(LEAKS)))


def leaked_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it."""
    found = with_leaks(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id", "leak.*", (F.col("leak.changed") > 0).alias("reworded")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item was found."""
    (name,) = fresh(docs, "leaks")
    return with_leaks(docs, benchmark, name).where(F.size(name) == 0).drop(name)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
