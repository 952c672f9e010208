"""Spelling variants by composing a vocabulary's acceptor with a one-edit transducer.

Two words are near if one inserted, deleted or replaced code point lies between them. The
composition acceptor - one edit - acceptor accepts exactly such pairs: both sides read the
same code points up to the edit, the transducer spends its edit, and both read the same
code points to the end. Started anywhere, it is bounded by what the initial state fixes: a
partition is an initial state (``n`` code points in the shorter word, edit at a place from
``lo`` to before ``hi``) with the code points before ``lo`` and after ``hi`` in common, so
every near pair is in exactly one partition, the one that holds the first place at which its words
differ. Every word starts in the halves of two lengths; a partition of too many words is
halved again, down to one free place, where words differ in no more than two letters.
In a task, each partition's words become minimised acceptors that share their states.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger.llm.common import table
from siftledger.session import materialise

LEAST_LETTERS, LEAST_COUNT = 7, 2
# A form occurs at least this many times as often as its variant.
FORM_FACTOR = 10
# One occurrence in so many, by its hash, loses a letter.
CUT_ONE_IN = 31
# Words that one task composes at once, and partitions too large for that which are broadcast.
PARTITION_WORDS = 20_000
MAX_BROADCAST = 1_000_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = "A-Za-zÀ-ÿ"


def vocabulary(
    documents: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT
) -> DataFrame:
    """word and n (occurrences) over whole texts.

    Of a run of letters, with A-Z in lower case, one occurrence in 31 by its hash with the
    doc_id loses a code point. NULL and empty texts have no words; in rows without a doc_id
    no letter is lost; rows that repeat count again.
    """
    # Shorter runs cannot become words, and a maximal run of enough letters matches whole.
    runs = F.regexp_extract_all("text", F.lit(f"[{_LETTERS}]{{{least_letters},}}"), F.lit(0))
    run = documents.select(F.col("doc_id").cast("string").alias("of"), F.explode(runs).alias("run"))
    run = run.withColumn("run", F.translate("run", _UPPER, _UPPER.lower()))
    h = F.crc32(F.concat_ws(":", "of", "run").cast("binary"))
    run = run.withColumn("h", F.when(F.col("of").isNotNull(), h))
    at = (F.col("h") % F.length("run")).cast("int")
    without = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % CUT_ONE_IN == 0, without).otherwise(F.col("run"))
    counts = run.groupBy(word.alias("word")).agg(F.count("*").alias("n"))
    return counts.where((F.length("word") >= least_letters) & (F.col("n") >= least_count))


def _placed(words: DataFrame, states: Column) -> DataFrame:
    """Words under each initial state (length of the shorter word, lo, hi) of ``states``."""
    rows = words.withColumn("state", F.explode(states)).select("word", "n", "state.*")
    # Code points after the edit: those behind hi, counted from the end.
    after = F.greatest(F.col("short") - F.col("hi"), F.lit(0))
    before = F.substring("word", F.lit(1), F.col("lo"))
    end = F.substring("word", (F.length("word") - after + 1).cast("int"), after.cast("int"))
    return rows.withColumn("fixed", F.concat(before, end))


def _state(short: Column, lo: Column, hi: Column) -> Column:
    return F.struct(
        short.cast("int").alias("short"), lo.cast("int").alias("lo"), hi.cast("int").alias("hi")
    )


_INITIAL = ["short", "lo", "hi", "fixed"]


def partitions(words: DataFrame, most: int = PARTITION_WORDS) -> DataFrame:
    """A row per initial state with two words or more: short, lo, hi and words (word, n).

    ``words``: word (distinct) and n. Partitions of over ``most`` words are halved until they
    are smaller or have one free place.
    """

    def halves(short: Column, lo: Column, hi: Column) -> list[Column]:
        middle = F.floor((lo + hi) / 2)
        return [_state(short, lo, middle), _state(short, middle, hi)]

    length, zero = F.length("word"), F.lit(0)
    own = halves(length, zero, length + 1)
    as_longer = halves(length - 1, zero, length)
    open_ = _placed(words, F.array(*own, *as_longer))
    closed = []
    while True:
        open_ = materialise(open_, "initial-states")
        sizes = open_.groupBy(*_INITIAL).agg(F.count("*").alias("words"))
        large = sizes.where((F.col("words") > most) & (F.col("hi") - F.col("lo") > 1))
        large = materialise(large.drop("words"), "large-states")
        found = large.count()
        if not found:
            break
        large = F.broadcast(large) if found <= MAX_BROADCAST else large
        closed.append(open_.join(large, _INITIAL, "left_anti"))
        split = F.array(*halves(F.col("short"), F.col("lo"), F.col("hi")))
        open_ = _placed(
            open_.join(large, _INITIAL, "left_semi")
            .withColumn("states", split)
            .select("word", "n", "states"),
            F.col("states"),
        )
    for rows in closed:
        open_ = open_.unionByName(rows)
    grouped = open_.groupBy(*_INITIAL).agg(
        F.min(F.length("word")).alias("shortest"),
        F.collect_list(F.struct("word", "n")).alias("words"),
    )
    several = (F.size("words") > 1) & (F.col("shortest") == F.col("short"))
    return grouped.where(several).select("short", "lo", "hi", "words")


class Acceptors:
    """Minimised acceptors of sets of words of one length each, sharing equal states.

    ``arcs``: per state, letter to next state. State 0 is final and has none.
    """

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self._state_of: dict[tuple, int] = {(): 0}

    def add(self, words: list[str]) -> int | None:
        """The initial state for distinct sorted ``words`` of one length; None for no words.

        States are made from the last letter to the first, so equal rests are one state.
        """
        if not words:
            return None
        shared = [-1, *(_common_prefix(a, b) for a, b in zip(words, words[1:]))]
        level = [(i, 0) for i in range(len(words))]  # first word below a state, and the state
        for depth in range(len(words[0]) - 1, -1, -1):
            above: list[tuple[int, int]] = []
            begin, arcs = level[0][0], []
            for first, state in level:
                if arcs and shared[first] < depth:
                    above.append((begin, self._state(arcs)))
                    begin, arcs = first, []
                arcs.append((words[first][depth], state))
            above.append((begin, self._state(arcs)))
            level = above
        return level[0][1]

    def _state(self, arcs: list[tuple[str, int]]) -> int:
        key = tuple(arcs)
        state = self._state_of.setdefault(key, len(self.arcs))
        if state == len(self.arcs):
            self.arcs.append(dict(arcs))
        return state

    def common(self, one: int, other: int) -> list[str]:
        """What both states accept; they are equally far from the end."""
        found, open_ = [], [(one, other, "")]
        while open_:
            one, other, read = open_.pop()
            if not one:
                found.append(read)
                continue
            few, many = sorted((self.arcs[one], self.arcs[other]), key=len)
            for letter, state in few.items():
                if letter in many:
                    open_.append((state, many[letter], read + letter))
        return found

    def one_edit(
        self, short: int | None, long: int | None, places: int
    ) -> Iterator[tuple[str, str]]:
        """Pairs accepted with the first difference at one of the first ``places`` places.

        Both words from ``short``, or the second one, a letter longer, from ``long``.
        """
        open_ = [(short, long, "")] if short is not None else []
        while open_:
            one, other, read = open_.pop()
            if len(read) == places:
                continue
            arcs = self.arcs[one]
            longer = {} if other is None else self.arcs[other]
            for (a, after_a), (b, after_b) in combinations(arcs.items(), 2):  # replaced
                for rest in self.common(after_a, after_b):
                    yield read + a + rest, read + b + rest
            for letter, after in longer.items():  # inserted
                for rest in self.common(one, after):
                    if not rest.startswith(letter):  # else a later place differs first
                        yield read + rest, read + letter + rest
            for letter, after in arcs.items():  # read by both
                open_.append((after, longer.get(letter), read + letter))


def _common_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def near_pairs(words: list[str], short: int, lo: int, hi: int) -> Iterator[tuple[str, str]]:
    """Near pairs of a partition: the first of ``short`` code points, first differing from
    ``lo`` on and before ``hi``."""
    after = max(short - hi, 0)
    free: dict[int, list[str]] = {short: [], short + 1: []}
    for word in words:
        free[len(word)].append(word[lo : len(word) - after])
    acceptors = Acceptors()
    roots = [acceptors.add(sorted(free[n])) for n in (short, short + 1)]
    before, end = words[0][:lo], words[0][len(words[0]) - after :]
    for a, b in acceptors.one_edit(*roots, hi - lo):
        yield before + a + end, before + b + end


_NEAR = "word string, n_near long, near_n long, near string"


def _compose(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per word of a partition: its near words there, and the most frequent of them."""
    for part in parts:
        rows = []
        for row in part.itertuples(index=False):
            count = {w["word"]: w["n"] for w in row.words}
            near: dict[str, list[str]] = defaultdict(list)
            for a, b in near_pairs(list(count), row.short, row.lo, row.hi):
                near[a].append(b)
                near[b].append(a)
            for word, others in near.items():
                best = min(others, key=lambda w: (-count[w], w))
                rows.append((word, len(others), count[best], best))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in _NEAR.split(", ")])


def variants(words: DataFrame, factor: int = FORM_FACTOR, most: int = PARTITION_WORDS) -> DataFrame:
    """word, n, n_near, form, form_n and root for distinct ``words`` (word, n).

    The form is the most frequent near word (ties: the smallest in code-point order) if it
    occurs ``factor`` times as often; the root is reached by following forms. Words without a
    form are their own root. An empty vocabulary gives an empty result.
    """
    words = materialise(words.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    near = (
        partitions(words, most)
        .mapInPandas(_compose, _NEAR)
        .groupBy("word")
        .agg(
            F.sum("n_near").alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"),
        )
    )
    form_n = -F.col("best.order")
    is_form = form_n >= factor * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, form_n).alias("form_n"),
    )
    found = materialise(found, "forms")
    return found.join(_roots(found, factor), "word", "left").withColumn(
        "root", F.coalesce("root", "word")
    )


def _roots(found: DataFrame, factor: int) -> DataFrame:
    """word and root of words with a form, in rounds that double the way covered.

    Each form is ``factor`` times as frequent, so the way is no longer than the number of
    digits of the largest count.
    """
    most = found.agg(F.max("n")).first()[0] or 1
    hops = 0
    while factor > 1 and factor ** (hops + 1) <= most:
        hops += 1
    roots = found.where("form is not null").select("word", F.col("form").alias("root"))
    covered = 1
    while covered < hops:
        roots = materialise(roots, "roots")
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = roots.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root")
        )
        covered *= 2
    return roots


def query(spark: SparkSession, folder: str) -> DataFrame:
    return variants(vocabulary(table(spark, folder, "documents")))


SQL = f"""
WITH RECURSIVE remainders AS (
  SELECT list(list_reduce(range(8)::UBIGINT[], lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END,
    i::UBIGINT) ORDER BY i) AS t
  FROM range(256) r(i)
), runs AS (
  SELECT doc_id, translate(run, '{_UPPER}', '{_UPPER.lower()}') AS run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[{_LETTERS}]{{{LEAST_LETTERS},}}')) AS run
        FROM documents)
  GROUP BY ALL
), hashed AS (
  SELECT run, c, hex(encode(doc_id || ':' || run)) AS bytes,
    xor(list_reduce(
      list_transform(range(length(bytes) // 2),
        lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::UBIGINT),
      lambda r, b: xor(r >> 8, t[CAST(xor(r, b) & 255 AS BIGINT) + 1]), 4294967295::UBIGINT),
      4294967295::UBIGINT)::BIGINT AS h
  FROM runs, remainders
), words AS (
  SELECT CASE WHEN h % {CUT_ONE_IN} = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    CAST(sum(c) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING sum(c) >= {LEAST_COUNT} AND length(word) >= {LEAST_LETTERS}
), cuts AS (
  SELECT word, p, substr(word, 1, p) || substr(word, p + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS p FROM words)
), links AS (
  SELECT a.word, b.word AS near FROM cuts a JOIN cuts b USING (rest, p) WHERE a.word <> b.word
  UNION
  SELECT a.word, b.word FROM words a JOIN cuts b ON b.rest = a.word
  UNION
  SELECT b.word, a.word FROM words a JOIN cuts b ON b.rest = a.word
), nearest AS (
  SELECT l.word, l.near, w.n AS near_n, count(*) OVER (PARTITION BY l.word) AS n_near
  FROM links l JOIN words w ON w.word = l.near
  QUALIFY row_number() OVER (PARTITION BY l.word ORDER BY w.n DESC, l.near) = 1
), forms AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= {FORM_FACTOR} * n THEN near END AS form,
    CASE WHEN near_n >= {FORM_FACTOR} * n THEN near_n END AS form_n
  FROM words LEFT JOIN nearest ON nearest.word = words.word
), ways AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT w.word, f.form FROM ways w JOIN forms f ON f.word = w.root AND f.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, w.root
FROM forms f JOIN ways w ON w.word = f.word
WHERE w.root IN (SELECT word FROM forms WHERE form IS NULL)
"""
