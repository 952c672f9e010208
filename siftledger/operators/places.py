"""Mark stored rows by their place: a file, and bits for the numbers of rows in it.

Joining whole rows with many keys shuffles and sorts them all. Here the key and the place of
each row are shuffled alone; the places found come back as bitmaps, 32,768 rows in under five
kilobytes, that are broadcast. The rows are then read a second time and never moved.

``rows`` are everywhere a scan of files with columns taken from it, so that Spark knows where
each row comes from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftledger.session import CODEC, materialise

BLOCK = 32_768
# Rows whose bitmaps a broadcast may hold: 8,192 blocks, about 39 MB per executor. Rows in
# many small files fill their blocks less, so blocks are counted, not rows.
MAX_BLOCKS = 8_192
# So many bytes of a bitmap make one number.
WORD = 7


def can_be_marked(rows: DataFrame, max_blocks: int = MAX_BLOCKS) -> bool:
    """Whether the bitmaps of ``rows`` fit a broadcast, and hashes tell their files apart."""
    by_file = rows.select(F.col("_metadata.file_path").alias("path")).groupBy("path")
    seen = by_file.agg(F.count("*").alias("n")).agg(
        F.sum(F.ceil(F.col("n") / BLOCK)).alias("blocks"),
        F.count("*").alias("files"),
        F.count_distinct(F.xxhash64("path")).alias("hashes"),
    )
    return seen.where(f"blocks <= {max_blocks} AND files = hashes").count() == 1


def with_place(rows: DataFrame) -> DataFrame:
    """``rows`` with their file, their block in it and their bit of the block."""
    return rows.select(
        *rows.columns,
        F.xxhash64("_metadata.file_path").alias("_file"),
        F.expr(f"_metadata.row_index div {BLOCK}").alias("_block"),
        F.expr(f"_metadata.row_index % {BLOCK}").alias("_bit"),
    )


def places(rows: DataFrame) -> DataFrame:
    """The places that ``rows``, of :func:`with_place`, have: stored bitmaps, as numbers."""
    bits = rows.groupBy("_file", "_block").agg(F.bitmap_construct_agg("_bit").alias("bits"))
    padded = F.concat("bits", F.lit(bytes(WORD)))
    numbers = F.transform(
        F.sequence(F.lit(0), F.lit(BLOCK // 8 // WORD)),
        lambda i: F.conv(F.hex(padded.substr(i * WORD + 1, F.lit(WORD))), 16, 10).cast("long"),
    )
    return materialise(bits.select("_file", "_block", numbers.alias("_words")), "places", CODEC)


def marked(rows: DataFrame, found: DataFrame, flag: str) -> DataFrame:
    """``rows`` with ``flag``: true where :func:`places` has the row's place."""
    word = f"get(_words, cast(_bit div {8 * WORD} as int))"
    bit = f"getbit({word}, cast(8 * ({WORD - 1} - _bit div 8 % {WORD}) + _bit % 8 as int)) = 1"
    placed = with_place(rows).join(F.broadcast(found), ["_file", "_block"], "left")
    return placed.select(*rows.columns, F.coalesce(F.expr(bit), F.lit(False)).alias(flag))


def without(
    rows: DataFrame, keys: DataFrame, key: str, max_blocks: int = MAX_BLOCKS
) -> DataFrame:
    """``rows`` whose ``key`` is not among ``keys``; rows without a key stay."""
    return _by_place(rows, keys, key, "left_anti", "NOT _found", max_blocks)


def among(
    rows: DataFrame, keys: DataFrame, key: str, max_blocks: int = MAX_BLOCKS
) -> DataFrame:
    """``rows`` whose ``key`` is among ``keys``."""
    return _by_place(rows, keys, key, "left_semi", "_found", max_blocks)


def _by_place(
    rows: DataFrame, keys: DataFrame, key: str, join: str, wanted: str, max_blocks: int
) -> DataFrame:
    if not rows.inputFiles():
        return rows  # there are none
    if not can_be_marked(rows, max_blocks):
        return rows.join(keys, key, join).select(*rows.columns)
    found = places(with_place(rows.select(key)).join(keys, key, "left_semi"))
    return marked(rows, found, "_found").where(wanted).select(*rows.columns)
