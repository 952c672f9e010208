"""Texts scored by a hierarchical Pitman-Yor bigram model.

Every word of the training texts is a customer in the restaurant of the word before it;
each of its tables sends a customer to the parent restaurant, which all contexts share;
and that one draws new words from a uniform base. Seating is sampled by Gibbs sweeps, and
the predictive probabilities of the kept sweeps are averaged.

The texts are cut into chunks of whole Arrow batches. A chunk sends its distinct words and
bigrams with their counts to buckets by hash, which add them up and answer; so a frequent
word or bigram is one entry per chunk, and a bucket is a part of the vocabulary. One chunk
owns each bigram and seats its customers; per sweep, chunks send table counts per word to
the word buckets and get back what the next sweep needs. Every step is a shuffle of
compressed arrays, written to the shared folder.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger.llm.common import arrow_batches_of, mixed, shuffle_partitions, strings, table
from siftledger.session import materialise, release

# Tokens of a chunk, at most; longer texts go on in the next chunk.
CHUNK = 1_250_000
# Gibbs sweeps, and how many of the last are averaged.
SWEEPS, KEPT = 3, 2
# Concentration of context restaurants and of the shared parent.
CONTEXT, PARENT = 2.0, 100.0
# Seats are drawn from the exact conditional up to this many customers of a dish, and
# beyond in blocks of a sixteenth of those seated.
EXACT = 64
REMEMBERED = 250_000
# Bytes of an Arrow batch, about: messages have up to a few MB, and every batch is held by
# the JVM and by Python at once.
BATCH_BYTES = 4 << 20

END = np.uint64(xxhash.xxh64_intdigest(b"\x00end", 1))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MESSAGE = pa.schema(
    [("to", pa.int64()), ("kind", pa.string()), ("source", pa.int64()), ("data", pa.binary())]
)
_SQL_MESSAGE = "to long, kind string, source long, data binary"


def held_out(doc_id) -> bool:
    """Whether a document is left out of training."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


# Messages ------------------------------------------------------------------------------


def _pack(*arrays) -> bytes:
    raw = pickle.dumps(arrays, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> tuple:
    size = int.from_bytes(data[:8], "little")
    return pickle.loads(pa.decompress(data[8:], size, codec="zstd", asbytes=True))


def _steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as byte planes of their differences, which compress well."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T)


def _keys(planes: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _small(counts: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest type that holds them."""
    return counts.astype(np.min_scalar_type(int(counts.max()) if len(counts) else 0))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and each key's place among them; only the distinct are sorted."""
    coded = pa.array(keys).dictionary_encode()
    found = coded.dictionary.to_numpy()
    order = np.argsort(found)
    place = np.empty(len(found), np.int32)
    place[order] = np.arange(len(found), dtype=np.int32)
    return found[order], place[coded.indices.to_numpy()]


def _received(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
    """The messages of one receiver after the other: (kind -> {source: data})."""
    last, held = None, {}
    for part in parts:
        for to, kind, source, data in zip(*(c.to_pylist() for c in part.columns)):
            if last is not None and to != last:
                yield last, held
                held = {}
            last = to
            held.setdefault(kind, {})[source] = data
    if last is not None:
        yield last, held


def _sent(messages: Iterator[tuple], flush: int = 32) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for message in messages:
        held.append(message)
        size += len(message[-1])
        if len(held) >= flush or size >= BATCH_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(zip(*rows), _MESSAGE)], schema=_MESSAGE
    )


def exchanged(messages: DataFrame, receive: Callable, label: str, schema: str = _SQL_MESSAGE) -> DataFrame:
    """Bring the messages of every receiver together, let it answer, and store the answers."""

    def work(parts):
        answers = (m for to, held in _received(parts) for m in receive(to, held))
        return _sent(answers) if schema == _SQL_MESSAGE else answers

    together = messages.repartition("to").sortWithinPartitions("to", "kind", "source")
    with arrow_batches_of(messages.sparkSession, BATCH_BYTES):
        return materialise(together.mapInArrow(work, schema), label)


# Texts to chunks -----------------------------------------------------------------------


class _Known(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_known = _Known()


def tokens(text: str) -> np.ndarray:
    """Hashes of the words, lower-cased A-Z, and the end."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    codes = np.empty(len(words) + 1, np.uint64)
    codes[:-1] = np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    codes[-1] = END
    return codes


class Chunk:
    """Token numbers, the words they stand for (sorted hashes), and the texts' pieces."""

    def __init__(self, words, numbers, sizes, rows, ids, out, before):
        self.words, self.numbers, self.sizes = words, numbers, sizes
        self.rows, self.ids, self.out, self.before = rows, ids, out, before

    @classmethod
    def of(cls, pieces: list[tuple]) -> Chunk:
        """From (row, doc_id, held out, hash before the first token, hashes)."""
        rows, ids, out, before, codes = zip(*pieces)
        sizes = np.array([len(c) for c in codes], np.int32)
        every = np.concatenate([np.array(before, np.uint64), *codes])
        words, numbers = _distinct(every)
        n = len(before)
        return cls(words, numbers[n:], sizes, list(rows), list(ids), np.array(out), numbers[:n])

    def state(self) -> bytes:
        planes = np.ascontiguousarray(self.numbers.view(np.uint8).reshape(-1, 4).T)
        return _pack(
            _steps(self.words), planes, self.sizes, self.rows, self.ids, self.out, self.before
        )

    @classmethod
    def load(cls, data: bytes) -> Chunk:
        words, planes, *rest = _unpack(data)
        return cls(_keys(words), np.ascontiguousarray(planes.T).view(np.int32).ravel(), *rest)

    @property
    def training(self) -> np.ndarray:
        """Which tokens are learned."""
        return np.repeat(~self.out, self.sizes)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, word) as one number, the tokens' pairs, and training counts."""
        context = np.empty_like(self.numbers)
        context[1:] = self.numbers[:-1]
        context[np.cumsum(self.sizes) - self.sizes] = self.before
        code = context.astype(np.int64) * len(self.words) + self.numbers
        pairs, of = np.unique(code, return_inverse=True)
        counts = np.bincount(of, weights=self.training, minlength=len(pairs)).astype(np.int64)
        return pairs, of, counts

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.numbers[self.training], minlength=len(self.words))

    def pair_hashes(self, pairs: np.ndarray) -> np.ndarray:
        context, word = np.divmod(pairs, len(self.words))
        return mixed(self.words[context] * _ODD + mixed(self.words[word]))


def _slices(sorted_keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of the sorted hashes begins, and the end."""
    bounds = [(b << 64) // buckets for b in range(1, buckets)]
    inner = np.searchsorted(sorted_keys, np.array(bounds, np.uint64))
    return np.concatenate([[0], inner, [len(sorted_keys)]]).astype(np.int64)


def _chunked(buckets: int, answer: Callable) -> Callable:
    """Cut texts into chunks and send what ``answer`` makes of each; names do not depend on it."""

    def messages(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        task, row, number, held, size = TaskContext.get().partitionId(), 0, 0, [], 0

        def close():
            nonlocal held, size, number
            if held:
                yield from answer(Chunk.of(held), (task << 24) + number, buckets)
                held, size, number = [], 0, number + 1

        for part in parts:
            for doc_id, text in zip(part.column(0).to_pylist(), strings(part.column(1))):
                codes, before, out = tokens(text), END, held_out(doc_id)
                while len(codes):
                    piece, codes = codes[: CHUNK - size], codes[CHUNK - size :]
                    held.append((f"{task}-{row}", doc_id, out, before, piece))
                    before, size = piece[-1], size + len(piece)
                    if size >= CHUNK:
                        yield from close()
                row += 1
        yield from close()

    return lambda parts: _sent(messages(parts), 64)


def _state(chunk: Chunk, name: int, buckets: int) -> Iterator[tuple]:
    """The chunk's state to itself."""
    yield name, "state", name, chunk.state()


def _entries(chunk: Chunk, name: int, buckets: int) -> Iterator[tuple]:
    """The chunk's words and bigrams with counts to the buckets."""
    counts = chunk.word_counts()
    at = _slices(chunk.words, buckets)
    for b in range(buckets):
        part = slice(at[b], at[b + 1])
        yield -1 - b, "words", name, _pack(_steps(chunk.words[part]), _small(counts[part]))
    pairs, _, counts = chunk.pairs()
    hashes = chunk.pair_hashes(pairs)
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    at = _slices(hashes, buckets)
    for b in range(buckets):
        part = slice(at[b], at[b + 1])
        yield -1 - b, "pairs", name, _pack(_steps(hashes[part]), _small(counts[part]))


def _merged(received: dict[int, bytes]) -> tuple[list, list, np.ndarray, np.ndarray, np.ndarray]:
    """Sources, sizes, each entry's place among the distinct keys, totals, and owning entries."""
    sources = sorted(received)
    parts = [_unpack(received[s]) for s in sources]
    keys = np.concatenate([_keys(p[0]) for p in parts])
    counts = np.concatenate([p[1].astype(np.int64) for p in parts])
    distinct, place = np.unique(keys, return_inverse=True)
    totals = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)
    owner = np.zeros(len(keys), bool)
    some = np.flatnonzero(counts)
    owner[some[np.unique(place[some], return_index=True)[1]]] = True
    return sources, [p[1].shape[0] for p in parts], place, totals, owner


def _count(bucket: int, held: dict) -> Iterator[tuple]:
    """Totals to every chunk that asked; the places of words are kept for the sweeps."""
    for kind in ("words", "pairs"):
        if kind not in held:
            continue
        sources, sizes, place, totals, owner = _merged(held[kind])
        ends = np.cumsum(sizes)
        if kind == "words":
            steps = [np.diff(place[e - n : e], prepend=0) for n, e in zip(sizes, ends)]
            yield bucket, "places", 0, _pack(sources, [_small(s) for s in steps], _small(totals))
        known = totals[totals > 0]
        ones, twos = int((known == 1).sum()), int((known == 2).sum())
        yield 0, f"{kind}-sums", bucket, pickle.dumps((int(known.sum()), len(known), ones, twos))
        for source, n, end in zip(sources, sizes, ends):
            part = slice(end - n, end)
            answer = _pack(_small(totals[place[part]]), np.packbits(owner[part]))
            yield source, kind, -1 - bucket, answer


# Seating -------------------------------------------------------------------------------


class Seating:
    """Tables of n customers of one dish, at strength ``a`` for opening one and discount d.

    p(t | n, a) is proportional to S(n, t) a^t with generalised Stirling numbers S. It is
    tabulated for n up to EXACT over a grid of log a.
    """

    GRID = np.linspace(-14, 14, 113)

    def __init__(self, discount: float):
        self.discount = discount
        log = np.full((EXACT + 1, EXACT + 1), -np.inf)
        log[1, 1] = 0.0
        with np.errstate(divide="ignore"):
            for n in range(1, EXACT):
                t = np.arange(1, n + 1)
                log[n + 1, 1 : n + 1] = log[n, 1 : n + 1] + np.log(n - discount * t)
                log[n + 1, 2 : n + 2] = np.logaddexp(log[n + 1, 2 : n + 2], log[n, 1 : n + 1])
        weight = log[None, :, :] + self.GRID[:, None, None] * np.arange(EXACT + 1)
        weight[:, 0, 0] = 0.0
        weight = np.exp(weight - weight.max(axis=2, keepdims=True))
        weight /= weight.sum(axis=2, keepdims=True)
        self.below = np.cumsum(weight, axis=2).astype(np.float32)
        self.mean = (weight * np.arange(EXACT + 1)).sum(axis=2)

    def _at(self, strength: np.ndarray) -> np.ndarray:
        scale = (np.log(strength) - self.GRID[0]) / (self.GRID[1] - self.GRID[0])
        return np.clip(np.rint(scale), 0, len(self.GRID) - 1).astype(np.int64)

    def expected(self, n: np.ndarray, strength: np.ndarray) -> np.ndarray:
        """Mean number of tables."""
        tables = self.mean[self._at(strength), np.minimum(n, EXACT)]
        return self._further(n, strength, tables, None)

    def drawn(self, n: np.ndarray, strength: np.ndarray, draw: np.random.Generator) -> np.ndarray:
        """A sample of the number of tables."""
        u = draw.random(len(n)).astype(np.float32)
        tables = np.zeros(len(n))
        for at in range(0, len(n), 200_000):
            part = slice(at, at + 200_000)
            below = self.below[self._at(strength[part]), np.minimum(n[part], EXACT)]
            tables[part] = np.minimum((below < u[part, None]).sum(axis=1), np.minimum(n[part], EXACT))
        return self._further(n, strength, np.maximum(tables, n > 0), draw)

    def _further(self, n, strength, tables, draw) -> np.ndarray:
        open_ = np.flatnonzero(n > EXACT)
        if not len(open_):
            return tables
        want, a, t = n[open_], strength[open_], tables[open_].astype(float)
        seated = np.full(len(open_), EXACT)
        while True:
            step = np.minimum(np.maximum(seated // 16, 1), want - seated)
            if not step.any():
                break
            new = a / (a + seated + step / 2 - self.discount * t)
            t = t + (step * new if draw is None else draw.binomial(step, np.clip(new, 0, 1)))
            seated = seated + step
        tables = tables.astype(float)
        tables[open_] = t
        return tables


def _discount(ones: int, twos: int) -> float:
    return min(max(ones / (ones + 2 * twos), 0.05), 0.95) if ones else 0.5


# Chunks and word buckets over the sweeps ------------------------------------------------


def _answers(held: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Totals and ownership in bucket order."""
    totals, owners = [], []
    for bucket in sorted(held):
        values, bits = _unpack(held[bucket])
        totals.append(values.astype(np.int64))
        owners.append(np.unpackbits(bits, count=len(values)).astype(bool))
    return np.concatenate(totals), np.concatenate(owners)


def _tables(chunk_words: np.ndarray, buckets: int, name: int, *values: np.ndarray) -> Iterator[tuple]:
    """Values per word to the word buckets."""
    at = _slices(chunk_words, buckets)
    for b in range(buckets):
        part = slice(at[b], at[b + 1])
        yield -1 - b, "tables", name, _pack(*[v[part] for v in values])


def _begin(buckets: int) -> Callable:
    def begin(name: int, held: dict) -> Iterator[tuple]:
        """Seat one table per owned bigram; keep the owned bigrams with several customers."""
        chunk = Chunk.load(held["state"][name])
        pairs, _, _ = chunk.pairs()
        order = np.argsort(chunk.pair_hashes(pairs))
        by_hash, owned = _answers(held["pairs"])
        totals, mine = np.empty_like(by_hash), np.empty_like(owned)
        totals[order], mine[order] = by_hash, owned
        context, word = np.divmod(pairs, len(chunk.words))
        known, _ = _answers(held["words"])
        yield name, "totals", name, _pack(_small(known), _small(totals))
        several = mine & (totals > 1)
        single = mine & (totals == 1)
        n = len(chunk.words)
        single_of_word = np.bincount(word[single], minlength=n)
        single_of_context = np.bincount(context[single], minlength=n)
        yield (
            name,
            "seats",
            name,
            _pack(
                _steps(chunk.words),
                context[several].astype(np.int32),
                word[several].astype(np.int32),
                totals[several],
                _small(single_of_word),
                _small(single_of_context),
            ),
        )
        of_word = single_of_word + np.bincount(word[several], minlength=n)
        of_context = single_of_context + np.bincount(context[several], minlength=n)
        first = of_context.astype(np.float32)
        yield from _tables(chunk.words, buckets, name, _small(of_word), _small(of_context), first)

    return begin


def _sweep(buckets: int, sweep: int, discount: float, new: float) -> Callable:
    def seat(name: int, held: dict) -> Iterator[tuple]:
        """Draw the tables of every owned bigram, given the parent as of the last sweep."""
        words, context, word, n, single_of_word, single_of_context = _unpack(held["seats"][name])
        words = _keys(words)
        opened, _, seated = _values(held["values"])
        strength = (CONTEXT + discount * opened[context]) * (seated + new)[word]
        seating = Seating(discount)
        draw = np.random.default_rng([sweep, name & 0x7FFFFFFF])
        tables, mean = seating.drawn(n, strength, draw), seating.expected(n, strength)
        size = len(words)
        of_word = single_of_word + np.bincount(word, weights=tables, minlength=size)
        of_context = single_of_context + np.bincount(context, weights=tables, minlength=size)
        expected = single_of_context + np.bincount(context, weights=mean, minlength=size)
        yield from _tables(
            words,
            buckets,
            name,
            _small(of_word.astype(np.int64)),
            _small(of_context.astype(np.int64)),
            expected.astype(np.float64),
        )

    return seat


def _values(held: dict[int, bytes]) -> list[np.ndarray | None]:
    """Word values in bucket order: tables as context, expected tables, parent probability.

    None for those that were not sent because no later step reads them.
    """
    parts = [_unpack(held[bucket]) for bucket in sorted(held)]
    return [
        None if column[0] is None else np.concatenate(column).astype(np.float64)
        for column in zip(*parts)
    ]


def _added(held: dict) -> tuple[list, list[np.ndarray], list[np.ndarray]]:
    sources, steps, totals = _unpack(held["places"][0])
    places = [np.cumsum(s.astype(np.int64)) for s in steps]
    sums = [np.zeros(len(totals)) for _ in range(3)]
    for source, place in zip(sources, places):
        if source in held["tables"]:
            for total, part in zip(sums, _unpack(held["tables"][source])):
                total[place] += part
    return sources, places, sums


def _parent_counts(bucket: int, held: dict) -> Iterator[tuple]:
    """Customers of the parent restaurant in this bucket, and how many words have one or two."""
    _, _, (customers, _, _) = _added(held)
    n = customers.astype(np.int64)
    row = (int(n.sum()), int((n > 0).sum()), int((n == 1).sum()), int((n == 2).sum()))
    yield 0, "parent", bucket, pickle.dumps(row)


def _parent(
    customers: int,
    words: int,
    discount: float,
    known: int,
    send_opened: bool = True,
    send_expected: bool = True,
) -> Callable:
    def answer(bucket: int, held: dict) -> Iterator[tuple]:
        """Each word's probability in the parent restaurant, and its sums as a context."""
        sources, places, (n, opened, expected) = _added(held)
        uniform = 1.0 / (known + 1)
        # The base strength per word follows from the expected number of tables of all.
        strength = np.full(len(n), (PARENT + discount * words) * uniform)
        whole = n.astype(np.int64)
        tables = Seating(discount).expected(whole, strength)
        yield 0, "parent-tables", bucket, pickle.dumps(float(tables[whole > 0].sum()))
        seated = np.where(whole > 0, n - discount * tables, 0.0) / (PARENT + customers)
        for source, place in zip(sources, places):
            yield (
                source,
                "values",
                bucket,
                _pack(
                    _small(opened[place].astype(np.int64)) if send_opened else None,
                    expected[place] if send_expected else None,
                    seated[place],
                ),
            )

    return answer


def _score(kept: list[tuple], numbers: tuple, discount: float) -> Callable:
    total, distinct = numbers

    def score(name: int, held: dict) -> Iterator[pa.RecordBatch]:
        """Sums over the tokens of every text piece."""
        chunk = Chunk.load(held["state"][name])
        known, together = (x.astype(np.int64) for x in _unpack(held["totals"][name]))
        pairs, of, _ = chunk.pairs()
        context, word = np.divmod(pairs, len(chunk.words))
        customers = known[context]
        probability = np.zeros(len(pairs))
        seating = Seating(discount)
        for before, now, new_before, new_now in kept:
            opened, _, seated = _values(held[before])
            _, expected, later = _values(held[now])
            earlier_parent, parent = seated + new_before, later + new_now
            strength = (CONTEXT + discount * opened[context]) * earlier_parent[word]
            several = np.flatnonzero(together > 1)
            tables = (together > 0).astype(float)
            tables[several] = seating.expected(together[several], strength[several])
            back = (CONTEXT + discount * expected[context]) / (CONTEXT + customers)
            mine = (together - discount * tables) / (CONTEXT + customers)
            probability += np.where(customers > 0, mine + back * parent[word], parent[word])
        logs = np.log10(probability / len(kept))
        base = np.log10((known + 0.1) / (total + 0.1 * (distinct + 1)))
        starts = np.cumsum(chunk.sizes) - chunk.sizes
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(chunk.rows, pa.string()),
                pa.array(chunk.ids, pa.int64()),
                pa.array(chunk.out, pa.bool_()),
                pa.array(chunk.sizes, pa.int64()),
                pa.array(np.add.reduceat((known > 0)[chunk.numbers].astype(np.int64), starts)),
                pa.array(np.add.reduceat(base[chunk.numbers], starts)),
                pa.array(np.add.reduceat(logs[of], starts)),
            ],
            names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )

    return score


_SCORES = (
    "row string, doc_id long, held_out boolean, n_tokens long, n_known long, "
    "base_score double, score double"
)


def _sums(messages: DataFrame, kind: str) -> np.ndarray:
    """Column sums of the buckets' small tallies; there is a row per bucket."""
    rows = messages.where((F.col("to") == 0) & (F.col("kind") == kind)).select("data").collect()
    return np.sum([np.atleast_1d(pickle.loads(r["data"])) for r in rows], axis=0)


def scores(docs: DataFrame, sweeps: int = SWEEPS, kept: int = KEPT) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score (the model's log10 probability of the text and its end).

    Documents with crc32(doc_id as text) mod 10 = 0 are held out of training; a NULL id is
    learned. A NULL or empty text is its end alone. Words that training lacks share the
    uniform base's one unknown type each. Repeated rows are learned and scored one by one;
    other columns are not read. An empty table gives an empty result. ``docs`` is read
    three times and must have the same rows in the same partitions, as a stored table has.
    """
    spark = docs.sparkSession
    buckets = 2 * shuffle_partitions(spark)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    # Neither entries nor state are stored on their way: chunks are cut once more for each
    # step that reads their state, which takes less disk. It comes first in every union, so
    # that its tasks have the numbers they have alone, by which chunks are named.
    entries = texts.mapInArrow(_chunked(buckets, _entries), _SQL_MESSAGE)
    counted = exchanged(entries, _count, "counts")
    empty = counted.isEmpty()
    state = texts.mapInArrow(_chunked(buckets, _state), _SQL_MESSAGE)
    to_chunks = counted.where("kind in ('words', 'pairs')")
    if empty:
        names = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long"
        return spark.createDataFrame([], names + ", base_score double, score double")
    total, distinct, _, _ = (int(x) for x in _sums(counted, "words-sums"))
    _, _, ones, twos = (int(x) for x in _sums(counted, "pairs-sums"))
    discount = _discount(ones, twos)
    begun = exchanged(state.unionByName(to_chunks), _begin(buckets), "seats")
    # What later steps do not read goes: places are read by every sweep, counts no more.
    places = materialise(counted.where("kind = 'places'"), "places")
    release(counted)
    seats, tables = begun.where("kind = 'seats'"), begun.where("kind = 'tables'")
    values, news = [], []
    wanted = range(max(sweeps - kept, 0), sweeps + 1)
    for sweep in range(sweeps + 1):
        if sweep:
            last = values[-1].where("kind = 'values'")
            tables = exchanged(
                seats.unionByName(last), _sweep(buckets, sweep, discount, news[-1]), "tables"
            )
        both = places.unionByName(tables)
        tallies = exchanged(both, _parent_counts, "parent-counts")
        customers, words, one, two = (int(x) for x in _sums(tallies, "parent"))
        parent_discount = _discount(one, two)
        # The next sweep reads opened tables, and so do the scores with the sweep after;
        # expected ones are read by the scores alone, with the sweep before.
        reads = sweep < sweeps, sweep in wanted and sweep - 1 in wanted
        found = exchanged(
            both, _parent(customers, words, parent_discount, distinct, *reads), "values"
        )
        opened = float(_sums(found, "parent-tables")[0])
        news.append((PARENT + parent_discount * opened) / (PARENT + customers) / (distinct + 1))
        values.append(found)
        # The tables of this sweep are summed up; the last values are read by those kept only.
        done = [tallies, *([tables] if sweep else [])]
        release(*done, *(values[sweep - 1 : sweep] if sweep and sweep - 1 not in wanted else []))
    totals = materialise(begun.where("kind = 'totals'"), "totals")
    release(begun, places)
    messages = state.unionByName(totals)
    for sweep in wanted:
        named = values[sweep].where("kind = 'values'").withColumn("kind", F.lit(f"values-{sweep}"))
        messages = messages.unionByName(named)
    pairs = [
        (f"values-{s - 1}", f"values-{s}", news[s - 1], news[s]) for s in wanted if s - 1 in wanted
    ]
    found = exchanged(
        messages, _score(pairs, (total, distinct), discount), "scores", _SCORES
    )
    return (
        found.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            F.sum("base_score").alias("base_score"),
            F.sum("score").alias("score"),
        )
        .drop("row")
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return scores(table(spark, folder, "documents"))
