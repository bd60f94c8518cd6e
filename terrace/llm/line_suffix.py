"""Line dedup: suffix ranks of line-ID sequences by distributed prefix doubling.

Every document is the sequence of its lines that hold a word. Lines get IDs (128 bits of
hash); suffixes of the sequences are ranked by their first line, then by their first 2, 4,
8 ... lines, each round from two ranks of the round before (prefix doubling). A rank is the
place of the prefix in sorted order, so equal ranks are an interval of the suffix array whose
longest common prefix is at least that many lines. Only prefixes that occur at least
twice keep a rank, so the tables shrink to what repeats.

A run of lines is deleted if it has at least ``min_words`` words and occurs earlier (by
doc_id, then line). Every such run is a union of shortest stretches of ``min_words`` words:
those that start at its lines and, for the last lines, with too few words from there on, the one
that ends at its end. Equal stretches are shortest wherever they occur, so it is enough to
find those: a stretch of L lines is the interval of two ranks at depth 2^k <= L, its first
and its last 2^k lines. Doubling stops at the depth of the longest such stretch, at most
``min_words`` lines; deeper ranks could not change a deletion. What is left over is merged
into maximal runs. The first copy of every line always stays.

DataFrame functions only. Hot lines are counted before they are joined, joins on a hot
class are ones that Spark can split, and nothing is windowed wider than a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import WORD, document_key, free_name, materialize

BROADCAST_BYTES = 16 * 1024 * 1024


def _lines(text: Column) -> Column:
    """The text's lines as (line_no, line), without those that hold no word."""
    numbered = F.transform(F.split(text, "\n", -1), lambda x, k: F.struct(k.alias("line_no"), x.alias("line")))
    return F.filter(numbered, lambda s: s["line"].rlike(WORD))


def _ranks(pairs: DataFrame, *by: str) -> DataFrame:
    """The values of ``by`` that occur at least twice, with their place in sorted order."""
    several = pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*by)
    return materialize(several.orderBy(*by).withColumn("rank", F.monotonically_increasing_id()), "ranks")


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, identity (k1, k2), i (place among the lines with a word), line_no, words and the
    two halves of the line's ID."""
    k1, k2 = document_key(F.col("doc_id"), F.col("text"))
    lines = (docs.select("doc_id", k1.alias("k1"), k2.alias("k2"), F.posexplode(_lines(F.col("text"))).alias("i", "s")))
    line = F.col("s.line")
    return lines.select("doc_id", "k1", "k2", "i", F.col("s.line_no").alias("line_no"),
                        F.regexp_count(line, F.lit(WORD)).alias("words"),
                        F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("second"), line).alias("h2"))


def with_stretch(lines: DataFrame, min_words: int) -> DataFrame:
    """Add ``need``, the least number of lines from here on that hold ``min_words`` words, and
    ``last``, the number of the last of them; 0 and NULL if an unranked line comes before. Also
    ``back`` and ``first``, the same for the lines that end here; 0 and NULL as well if their
    first line's own stretch is the same one."""
    w = Window.partitionBy("k1", "k2").orderBy("i")
    lines = lines.withColumn("isle", F.col("i") - F.row_number().over(w))
    isle = Window.partitionBy("k1", "k2", "isle").orderBy("i")
    line = F.struct("words", "line_no")
    lines = (lines.withColumn("ahead", F.collect_list(line).over(isle.rowsBetween(0, min_words - 1)))
             .withColumn("behind", F.reverse(F.collect_list(line).over(isle.rowsBetween(1 - min_words, 0)))))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("words"))

    def reach(side: str, beyond: Column) -> Column:
        return F.aggregate(
            side, zero,
            lambda a, x: F.when(a["words"] >= min_words, a).otherwise(
                F.struct((a["n"] + 1).alias("n"), (a["words"] + x["words"]).alias("words"))),
            lambda a: F.when(a["words"] - beyond >= min_words, a["n"]).otherwise(0))

    # A stretch that has too few words without its last line is the shortest from its start too.
    return (lines.withColumn("need", reach("ahead", F.lit(0))).withColumn("last", F.get("ahead", F.col("need") - 1)["line_no"])
            .withColumn("back", reach("behind", F.col("words"))).withColumn("first", F.get("behind", F.col("back") - 1)["line_no"])
            .drop("isle", "ahead", "behind"))


def repeated_stretches(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """(k1, k2, doc_id, i, first, last, copies, and the earliest copy's doc_id as of_doc): the
    shortest stretches of ``min_words`` words, from a line on or up to one, that occur earlier as
    well."""
    lines = line_table(docs)
    ranks = _ranks(lines, "h1", "h2")
    ranked = (lines.join(ranks, ["h1", "h2"]).drop("h1", "h2").dropDuplicates(["k1", "k2", "i"]))
    base = materialize(with_stretch(ranked, min_words), "lines")
    keys = ("doc_id", "k1", "k2")
    starts = base.where("need > 0").select(*keys, "i", "need", F.col("line_no").alias("first"), "last").unionByName(
        base.where("back > 0").select(*keys, (F.col("i") - F.col("back") + 1).alias("i"), F.col("back").alias("need"),
                                      "first", F.col("line_no").alias("last")))
    deepest = starts.agg(F.max("need")).first()[0] or 1
    level, found, k = base.select("k1", "k2", "i", "rank"), [], 0
    while True:
        depth = 1 << k
        here = starts.where(F.col("need").between(depth, 2 * depth - 1))
        first = level.select("k1", "k2", "i", F.col("rank").alias("a"))
        tail = level.select("k1", "k2", (F.col("i") + depth).alias("end"), F.col("rank").alias("b"))
        found.append(here.withColumn("end", F.col("i") + F.col("need")).join(first, ["k1", "k2", "i"])
                     .join(tail, ["k1", "k2", "end"])
                     .select("need", "a", "b", "doc_id", "k1", "k2", "i", "first", "last"))
        if 2 * depth > deepest:
            break
        after = Window.partitionBy("k1", "k2").orderBy("i").rangeBetween(depth, depth)
        pairs = level.withColumn("next", F.max("rank").over(after)).where(F.col("next").isNotNull())
        pairs = pairs.withColumnRenamed("rank", "a")
        level = materialize(pairs.join(_ranks(pairs, "a", "next"), ["a", "next"]).select("k1", "k2", "i", "rank"), "level")
        k += 1
    stretches = found[0]
    for more in found[1:]:
        stretches = stretches.unionByName(more)
    # Ranks of different depths may be equal numbers, so the depth (that is, need) is a key too.
    stretches = materialize(stretches, "stretches")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2", "i")
    classes = (stretches.groupBy("need", "a", "b").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("f"))
               .where("copies > 1"))
    return (stretches.join(classes, ["need", "a", "b"]).where(place != F.col("f"))
            .select("k1", "k2", "doc_id", "i", "first", "last", "copies", F.col("f.doc_id").alias("of_doc")))


def repeated_runs(stretches: DataFrame) -> DataFrame:
    """(k1, k2, runs): each document's maximal runs of deleted lines, as an array of
    (first, last) line numbers in order."""
    gone = stretches.select("k1", "k2", F.explode(F.sequence("first", "last")).alias("line")).distinct()
    by = Window.partitionBy("k1", "k2").orderBy("line")
    runs = (gone.withColumn("isle", F.col("line") - F.row_number().over(by)).groupBy("k1", "k2", "isle")
            .agg(F.min("line").alias("first"), F.max("line").alias("last")))
    return runs.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def _without(lines: Column, runs: Column) -> Column:
    """``lines`` without the runs: the slices between them, in one pass."""
    start = F.transform(runs, lambda r, k: F.struct(
        F.when(k == 0, F.lit(0)).otherwise(F.element_at(runs, F.greatest(k, F.lit(1)).cast("int"))["last"] + 1).alias("at"),
        r["first"].alias("to")))
    before = F.transform(start, lambda s: F.slice(lines, s["at"] + 1, s["to"] - s["at"]))
    at = F.element_at(runs, -1)["last"] + 1
    tail = F.slice(lines, at + 1, F.greatest(F.size(lines) - at, F.lit(0)))
    return F.concat(F.flatten(before), tail)


def delete_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text``, and two columns
    more: n_lines (of the text as it was) and n_deleted.

    Lines are what line feeds separate; they are compared as they are. Lines without a word
    are not compared; they go only where they lie inside one of the shortest stretches that go. NULL and empty texts
    and documents without a repeat stay as they are. Rows with the same id and text are one
    document and get the same result. Documents without an id come last in the order. Other
    columns pass through untouched.
    """
    names = docs.columns
    a, b, runs, lines = (free_name(names, n) for n in ("k1", "k2", "runs", "lines"))
    n_lines, n_deleted = free_name(names, "n_lines"), free_name(names, "n_deleted")
    gone = repeated_runs(repeated_stretches(docs.select("doc_id", "text"), min_words))
    gone = materialize(gone.select(F.col("k1").alias(a), F.col("k2").alias(b), F.col("runs").alias(runs)), "runs")
    weight = gone.agg(F.sum(F.size(runs) * 16 + 64)).first()[0] or 0
    k1, k2 = document_key(F.col("doc_id"), F.col("text"))
    joined = (docs.withColumn(a, k1).withColumn(b, k2)
              .join(F.broadcast(gone) if weight <= BROADCAST_BYTES else gone, [a, b], "left")
              .withColumn(lines, F.split("text", "\n", -1)))
    kept = F.when(F.col(runs).isNull(), F.col("text")).otherwise(
        F.array_join(_without(F.col(lines), F.col(runs)), "\n"))
    deleted = F.aggregate(F.col(runs), F.lit(0), lambda s, r: s + r["last"] - r["first"] + 1)
    return joined.select(
        *[kept.alias(c) if c == "text" else F.col(f"`{c}`") for c in names],
        F.when(F.col(lines).isNull(), 0).otherwise(F.size(lines)).alias(n_lines),
        F.coalesce(deleted, F.lit(0)).alias(n_deleted))
