"""Repeated runs of lines, found with a suffix array over line ids, and deleted.

Every line that occurs twice gets an id by rank. Prefix doubling then ranks the suffixes
of all documents by their first 2, 4, 8 ... lines: the rank of 2n lines follows from the
pair of ranks of n lines here and n lines further on. Suffixes of equal rank share that
many lines, so an interval of equal ranks is a longest-common-prefix interval of at least
that depth. A run counts as repeated when it has ``min_words`` words; doubling stops at
the depth that the shortest such runs can have, and longer runs are unions of those. Each
run stays where it comes first and is deleted everywhere else.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftledger.llm.common import fresh, shuffle_partitions, table
from siftledger.session import materialise

# Words a repeated run needs. Shorter lines recur by chance.
MIN_WORDS = 5


def _words(line: Column) -> Column:
    """Words of a line that is not blank: its inner spaces and one."""
    inner = F.trim(line)
    return F.length(inner) - F.length(F.replace(inner, F.lit(" "), F.lit(""))) + 1


def _lines(text: Column) -> Column:
    """The lines of a text that are not blank, as structs of line and words."""
    split = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.transform(
        F.filter(split, lambda x: F.trim(x) != ""),
        lambda x: F.struct(x.alias("line"), _words(x).alias("words")),
    )


def _reach(words: Column, at: Column, least: int, forward: bool) -> Column:
    """Lines from ``at`` on (or back to) until ``least`` words; NULL if there are too few."""
    if forward:
        near = F.slice(words, at + 1, F.lit(least))
    else:
        first = F.greatest(at + 2 - least, F.lit(1))
        near = F.reverse(F.slice(words, first, at + 2 - first))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("sum"))
    end = F.aggregate(
        near,
        start,
        lambda a, w: F.when(a["sum"] >= least, a).otherwise(
            F.struct((a["n"] + 1).alias("n"), (a["sum"] + w).alias("sum"))
        ),
    )
    return F.when(end["sum"] >= least, end["n"])


def numbered_lines(stored: DataFrame, least: int) -> DataFrame:
    """row, doc_id, pos, two hashes of the line, and how far its shortest runs reach."""
    lines = stored.select("row", "doc_id", _lines(F.col("text")).alias("lines"))
    lines = lines.withColumn("words", F.col("lines.words"))
    return lines.select(
        "row",
        "doc_id",
        F.posexplode(
            F.transform(
                "lines",
                lambda x, i: F.struct(
                    x["line"].alias("line"),
                    _reach(F.col("words"), i, least, True).alias("ahead"),
                    _reach(F.col("words"), i, least, False).alias("back"),
                ),
            )
        ).alias("pos", "x"),
    ).select(
        "row",
        "doc_id",
        "pos",
        F.xxhash64("x.line").alias("h1"),
        F.hash("x.line", F.lit(1)).alias("h2"),
        "x.ahead",
        "x.back",
    )


def ranked(counted: DataFrame, of: str, key: str, bucket: Column) -> DataFrame:
    """Add ``rank``: ``of`` and the number of suffixes in smaller keys of the same ``of``.

    ``counted`` has a row per distinct (of, key) with its number of suffixes ``n``;
    ``bucket`` grows with ``key`` and splits the rows of one ``of`` over tasks: the
    buckets are summed up first, then each adds its own rows.
    """
    placed = counted.withColumn("_bucket", bucket)
    before = Window.partitionBy(of).orderBy("_bucket")
    sums = placed.groupBy(of, "_bucket").agg(F.sum("n").alias("_sum"))
    sums = sums.withColumn("_base", F.sum("_sum").over(before) - F.col("_sum")).drop("_sum")
    within = Window.partitionBy(of, "_bucket").orderBy(key).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inside = F.sum("n").over(within) - F.col("n")
    return (
        placed.withColumn("_inside", inside)
        .join(sums, [of, "_bucket"])
        .withColumn("rank", F.col(of) + F.col("_base") + F.col("_inside"))
        .drop("_bucket", "_base", "_inside")
    )


def suffix_ranks(lines: DataFrame, least: int) -> DataFrame:
    """row, pos, level and rank of every suffix whose first 2^level lines occur twice.

    Ranks order the suffixes of a level by their first 2^level lines. Levels go up to the
    most lines a run of ``least`` words can need.
    """
    spark = lines.sparkSession
    buckets = 4 * shuffle_partitions(spark)
    repeated = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    repeated = repeated.withColumn("of", F.lit(0).cast("long"))
    # Hashes in unsigned steps; ranks start from 0.
    place = F.shiftrightunsigned("h1", 1) * F.lit(float(buckets)) / F.lit(float(1 << 63))
    ids = ranked(
        repeated.withColumn("key", F.struct(F.shiftrightunsigned("h1", 1), "h1", "h2")),
        "of",
        "key",
        place.cast("int"),
    )
    level = materialise(
        lines.join(ids.select("h1", "h2", "rank"), ["h1", "h2"]).select("row", "pos", "rank"),
        "suffix-ranks",
    )
    total = max(level.count(), 1)
    found = level.withColumn("level", F.lit(0))
    depth, step = 1, 1
    while 2 * step <= least:
        later = level.select("row", (F.col("pos") - step).alias("pos"), F.col("rank").alias("key"))
        pairs = level.withColumnRenamed("rank", "of").join(later, ["row", "pos"])
        classes = pairs.groupBy("of", "key").agg(F.count("*").alias("n")).where("n > 1")
        place = F.col("key") * F.lit(float(buckets)) / F.lit(float(total))
        names = ranked(classes, "of", "key", place.cast("int")).select("of", "key", "rank")
        level = materialise(
            pairs.join(names, ["of", "key"]).select("row", "pos", "rank"), "suffix-ranks"
        )
        found = found.unionByName(level.withColumn("level", F.lit(depth)))
        depth, step = depth + 1, 2 * step
    return found


def repeated_positions(lines: DataFrame, least: int) -> DataFrame:
    """row and pos of every line in a run of ``least`` words that comes earlier as well.

    Earlier: in a smaller doc_id (NULL first), then a smaller row, then further up.
    """
    ranks = suffix_ranks(lines, least)
    ahead = lines.where("ahead is not null").select(
        "row", "doc_id", F.col("pos").alias("start"), F.col("ahead").alias("len")
    )
    back = lines.where("back is not null").select(
        "row", "doc_id", (F.col("pos") - F.col("back") + 1).alias("start"), F.col("back").alias("len")
    )
    # The deepest level not longer than the run; its two blocks overlap and cover the run.
    level = sum(
        (F.col("len") >= (1 << k)).cast("int") for k in range(1, max(least, 1).bit_length())
    )
    runs = ahead.unionByName(back).withColumn("level", level if least > 1 else F.lit(0))
    runs = runs.withColumn(
        "second", (F.col("start") + F.col("len") - F.call_function("shiftleft", F.lit(1), F.col("level"))).cast("int")
    )
    first = ranks.select("row", F.col("pos").alias("start"), "level", F.col("rank").alias("r1"))
    second = ranks.select("row", F.col("pos").alias("second"), "level", F.col("rank").alias("r2"))
    runs = (
        runs.join(first, ["row", "start", "level"])
        .join(second, ["row", "second", "level"])
        .select("row", "doc_id", "start", "len", "r1", "r2")
        .distinct()
    )
    runs = materialise(runs, "runs")
    place = F.struct("doc_id", "row", "start")
    classes = (
        runs.groupBy("len", "r1", "r2")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .where("n > 1")
    )
    later = runs.join(classes, ["len", "r1", "r2"]).where(
        ~place.eqNullSafe(F.col("first"))
    )
    return later.select(
        "row",
        F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("pos"),
    ).distinct()


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with ``text`` freed of repeated runs, and what was removed.

    Added (with longer names where ``docs`` has such columns): ``n_lines``, the lines that
    are not blank, and ``n_removed`` of them. Blank lines stay and do not interrupt a run.
    A NULL text has no lines and stays NULL; repeated rows are documents like others, so
    the later one is emptied. Nothing is dropped; an empty table gives an empty result.
    """
    n_lines, n_removed, row, gone = fresh(docs, "n_lines", "n_removed", "_row", "_gone")
    stored = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "line-documents")
    keyed = stored.select(F.col(row).alias("row"), "doc_id", "text")
    lines = materialise(numbered_lines(keyed, min_words), "lines")
    positions = repeated_positions(lines, min_words)
    # Neighbouring positions as ranges, so that a document carries few of them.
    by_row = Window.partitionBy("row").orderBy("pos")
    ranges = (
        positions.withColumn("island", F.col("pos") - F.row_number().over(by_row))
        .groupBy("row", "island")
        .agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
        .groupBy(F.col("row").alias(row))
        .agg(F.collect_list(F.struct("first", "last")).alias(gone))
    )
    split = F.split(F.coalesce("text", F.lit("")), "\n")
    # Each line with its place among those that are not blank.
    filled = F.filter(
        F.transform(split, lambda x, i: F.struct(x.alias("line"), i.alias("at"))),
        lambda x: F.trim(x["line"]) != "",
    )
    removed = F.transform(
        F.filter(
            F.transform(filled, lambda x, i: F.struct(x["at"].alias("at"), i.alias("pos"))),
            lambda x: F.exists(
                F.col(gone), lambda r: (x["pos"] >= r["first"]) & (x["pos"] <= r["last"])
            ),
        ),
        lambda x: x["at"],
    )
    kept = F.array_join(
        F.filter(split, lambda x, i: ~F.array_contains(F.col(n_removed), i)), "\n"
    )
    has = F.col(gone).isNotNull()
    return (
        stored.join(ranges, row, "left")
        .withColumn(n_lines, F.size(F.filter(split, lambda x: F.trim(x) != "")).cast("long"))
        .withColumn(n_removed, F.when(has, removed))
        .withColumn("text", F.when(has, kept).otherwise(F.col("text")))
        .withColumn(n_removed, F.when(has, F.size(n_removed)).otherwise(0).cast("long"))
        .select(*docs.columns, n_lines, n_removed)
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return deduplicated(docs).select(
        "doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("kept_md5")
    )


# The same by definition: the texts of all shortest runs of MIN_WORDS words, forwards and
# backwards, are compared as they are.
SQL = f"""
with split as (select doc_id, string_split(text, chr(10)) as parts from documents),
every as (select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as ln from split),
l as (select doc_id, line, ln,
    row_number() over (partition by doc_id order by ln) as pos,
    length(trim(line)) - length(replace(trim(line), ' ', '')) + 1 as words
  from every where trim(line) <> ''),
c as (select *, sum(words) over (partition by doc_id order by pos) as upto from l),
runs as (
  select a.doc_id, a.pos as s, min(b.pos) as e from c a join c b
    on a.doc_id = b.doc_id and b.pos between a.pos and a.pos + {MIN_WORDS - 1}
    and b.upto - a.upto + a.words >= {MIN_WORDS} group by 1, 2
  union
  select b.doc_id, max(a.pos) as s, b.pos as e from c a join c b
    on a.doc_id = b.doc_id and b.pos between a.pos and a.pos + {MIN_WORDS - 1}
    and b.upto - a.upto + a.words >= {MIN_WORDS} group by 1, 3),
texts as (select r.doc_id, s, e, string_agg(line, chr(10) order by pos) as t
  from runs r join c on c.doc_id = r.doc_id and c.pos between s and e group by 1, 2, 3),
later as (select * from (select *, row_number() over (partition by t order by doc_id, s) as nth
  from texts) where nth > 1),
gone as (select distinct c.doc_id, c.ln from later r join c
  on c.doc_id = r.doc_id and c.pos between s and e),
kept as (select v.doc_id, string_agg(line, chr(10) order by v.ln) as t
  from every v anti join gone g on g.doc_id = v.doc_id and g.ln = v.ln group by 1),
n as (select doc_id, count(*) as n_lines from l group by 1),
m as (select doc_id, count(*) as n_removed from gone group by 1)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed,
  case when d.text is not null then md5(coalesce(kept.t, '')) end as kept_md5
from documents d left join n using (doc_id) left join m using (doc_id) left join kept using (doc_id)"""
