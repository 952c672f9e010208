"""Token counts of whole texts, from counts per distinct pre-token.

A pre-token here is a run of white space with the run of other characters after it. The
tokenizer never joins characters across such a boundary, so a text has as many tokens as
its pre-tokens have. Each distinct pre-token is tokenised once. The most frequent ones
(:data:`FREQUENT` at most) are broadcast with their counts, which settles most of every
text in place and keeps hot keys out of the join; all others are joined in a shuffle.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siftledger.llm.common import strings, table
from siftledger.session import materialise

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
# The broadcast holds this many pre-tokens at most: about 5 MB, and 40 MB in a worker.
FREQUENT = 300_000

# White space next to white space; this pattern's class is the wider one.
_DOUBLE = re.compile(r"\s\s")
_PIECE = regex.compile(r"\s*\S+|\s+")


def tokenizer_at(name: str) -> Tokenizer:
    """The public vocabulary's tokenizer, whole texts in, no padding, one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    found = Tokenizer.from_file(public_tokenizers.path(name))
    found.no_truncation()
    found.no_padding()
    return found


def has_double(text: str) -> bool:
    return _DOUBLE.search(text) is not None


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, in order; joined they are the text.

    With single spaces and line breaks only, a plain split finds them; other texts need
    the pattern.
    """
    if not text:
        return []
    if has_double(text):
        return _PIECE.findall(text)
    first, *rest = spaced(text)
    found = [led(part) for part in rest]
    return [first, *found] if first else found


def spaced(text: str) -> list[str]:
    """A text without double white space, cut at its spaces and before its line breaks."""
    return text.replace("\n", " \n").split(" ")


def led(part: str) -> str:
    """The pre-token of a later part: the space it was cut at, unless it is a line."""
    return part if part[:1] == "\n" else " " + part


def _distinct(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter[str] = Counter()
    for part in parts:
        for text in strings(part.column(0)):
            seen.update(pre_tokens(text))
        if len(seen) > 500_000:
            yield _counted(seen)
            seen = Counter()
    yield _counted(seen)


def _counted(seen: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
        names=["pre_token", "n"],
    )


def pre_token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every distinct pre-token of all texts and how often it occurs."""
    counted = docs.select(text).mapInArrow(_distinct, "pre_token string, n long")
    return counted.groupBy("pre_token").agg(F.sum("n").alias("n"))


def with_pieces(vocabulary: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """Add ``pieces``: how many tokens the pre-token has."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_at(name)
        for part in parts:
            texts = strings(part.column(0))
            pieces = [
                len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(pieces, pa.int64())], names=[*part.schema.names, "pieces"]
            )

    return vocabulary.select("pre_token", "n").mapInArrow(
        count, "pre_token string, n long, pieces long"
    )


def _frequent(vocabulary: DataFrame, most: int) -> dict[str, int]:
    """Pieces of the most frequent pre-tokens, ``most`` at the very most.

    How many pre-tokens are how frequent is counted first, in steps of an eighth of a
    power of two, so that no task sends more than the answer to the driver.
    """
    step = F.floor(8 * F.log2("n")).alias("step")
    held, least = 0, None
    for row in vocabulary.groupBy(step).count().orderBy(F.desc("step")).collect():
        held += row["count"]
        if held > most:
            break
        least = row["step"]
    if least is None:
        return {}
    top = vocabulary.where(step >= least).select("pre_token", "pieces")
    return {r["pre_token"]: r["pieces"] for r in top.collect()}


_PARTS = "key string, row string, doc_id long, n_bytes long, times long, pieces long"


def _split(doc_id: str, text: str, known):
    """Per text one row with what the frequent pre-tokens add up to, and one for each other."""

    def split(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = known.value
        task, row = TaskContext.get().partitionId(), 0
        for part in parts:
            keys, rows, ids, sizes, times, sums = [], [], [], [], [], []
            for doc, body in zip(part.column(0).to_pylist(), strings(part.column(1))):
                name, row, total = f"{task}-{row}", row + 1, 0
                for pre_token, n in Counter(pre_tokens(body)).items():
                    pieces = frequent.get(pre_token)
                    if pieces is None:
                        keys.append("t" + pre_token)
                        rows.append(name)
                        ids.append(None)
                        sizes.append(None)
                        times.append(n)
                        sums.append(None)
                    else:
                        total += n * pieces
                keys.append("r" + name)
                rows.append(name)
                ids.append(doc)
                sizes.append(len(body.encode()))
                times.append(None)
                sums.append(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.string()),
                    pa.array(rows, pa.string()),
                    *[pa.array(x, pa.int64()) for x in (ids, sizes, times, sums)],
                ],
                names=["key", "row", "doc_id", "n_bytes", "times", "pieces"],
            )

    return split


def token_counts(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    name: str = VOCABULARY,
    limit: int = LIMIT,
    frequent: int = FREQUENT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens and over_limit.

    A NULL text is empty and has 0 tokens. Repeated rows and ids are counted one by one,
    other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    vocabulary = materialise(with_pieces(pre_token_counts(docs, text), name), "pre-tokens")
    shared = spark.sparkContext.broadcast(_frequent(vocabulary, frequent))
    parts = docs.select(F.col(doc_id).cast("long"), text).mapInArrow(
        _split("doc_id", "text", shared), _PARTS
    )
    others = vocabulary.select(
        F.concat(F.lit("t"), "pre_token").alias("key"), F.col("pieces").alias("each")
    )
    return (
        parts.join(others, "key", "left")
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.coalesce("pieces", F.col("times") * F.col("each"))).alias("n_tokens"),
        )
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )


def query(spark, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"))
