"""Line dedup over levelled sorted runs of line hashes, in built-in functions only.

A line's key is the line without blanks at both ends and with A-Z in lower case.
A key of at least ``min_chars`` code points that stands in two documents or more
loses all its lines except those of the document with the smallest id.

The documents come in batches of rising ids.  ``LineRuns`` keeps the 128-bit
hashes of all keys seen so far as runs: tables bucketed and sorted by hash, no key
in two of them.  A batch's own keys go through a chain of merge anti-joins with the
runs; what is left is new and becomes a run of level 0.  When a level holds
``fanout`` runs they are merged into one of the next level.  Own keys and runs share
buckets, so neither the anti-joins nor the merges shuffle anything: a key is moved
once, when it comes in.

A key that an anti-join removed was seen in an earlier batch, so all its lines in
this batch go; a new key's lines go from the documents behind its first one.  Only
those repeated keys meet the lines.  Keys with more than 1/``heavy`` of a batch's
lines (fewer than ``heavy`` of them in each batch, whatever the data) are broadcast; the others
travel by hash, and none of them is large enough to fill a task.

Null or empty text is one empty line.  Rows without an id are one document that
comes last.  Rows that repeat an id are one document; if they repeat the text too,
each gets that result.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rekko.llm.common import keyed, own_path, stored

BLANKS = " \t\n\x0b\x0c\r"
HASH = ["h", "g"]


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def lower_ascii(key: Column) -> Column:
    """A-Z in lower case; ``lower`` does that, and faster, where all characters are ASCII."""
    return F.when(F.octet_length(key) == F.length(key), F.lower(key)).otherwise(
        F.translate(key, string.ascii_uppercase, string.ascii_lowercase))


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def bucketed(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """``df`` written to the shared folder, bucketed and sorted by hash, and read again.

    The catalog entry that carries the bucketing goes at once; the files stay
    until ``release``.
    """
    spark = df.sparkSession
    path = own_path(spark, name)
    table = "line_runs_" + path.rsplit("-", 1)[1]
    (df.write.format("parquet").bucketBy(buckets, *HASH).sortBy(*HASH).option("path", path).saveAsTable(table))
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def without(keys: DataFrame, run: DataFrame) -> DataFrame:
    """The keys that a run does not hold, by a merge join of two sorted tables."""
    return keys.join(run.select(*HASH).hint("merge"), HASH, "left_anti")


class LineRuns:
    """Sorted runs of the keys seen so far: ``levels[i]`` holds fewer than ``fanout`` of them."""

    def __init__(self, buckets: int, fanout: int = 4):
        self.buckets, self.fanout = buckets, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def add(self, lines: DataFrame) -> DataFrame:
        """Take in a batch's lines (``k``, hash) and return its repeated keys:
        hash, ``first`` (null: seen in an earlier batch) and ``n``, the key's lines in the batch."""
        # the partial aggregate leaves one row for each key of a map task
        own = bucketed(lines.groupBy(*HASH).agg(
            F.min("k").alias("first"), F.max("k").alias("last"), F.count(F.lit(1)).alias("n")), "keys", self.buckets)
        new = own
        for run in self.runs():
            new = without(new, run)
        new = bucketed(new, "run", self.buckets) if self.runs() else own
        self.levels[0].append(new)
        self.compact()
        repeated = new.filter(F.col("first") < F.col("last")).select(*HASH, "first", "n")
        if new is own:
            return repeated
        seen = without(own, new).select(*HASH, F.lit(None).cast("long").alias("first"), "n")
        return repeated.unionByName(seen)

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def compact(self) -> None:
        """Merge the runs of a level that is full into one of the next."""
        for i, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                merged = level[0]
                for run in level[1:]:
                    merged = merged.unionByName(run)
                self.levels[i] = []
                if i + 1 == len(self.levels):
                    self.levels.append([])
                # bucket by bucket: the runs share buckets, and no key is in two of them
                self.levels[i + 1].append(bucketed(merged.groupBy(*HASH).agg(
                    F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")),
                    "run", self.buckets))


def numbered_lines(rows: DataFrame, min_chars: int, bounds: list[int]) -> DataFrame:
    """(``k``, ``t``, ``pos``, hash, ``batch``) for every line whose key is long enough."""
    batch = sum((F.when(F.col("k") > b, 1).otherwise(0) for b in bounds), F.lit(0))
    lines = rows.select("k", "t", batch.alias("batch"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    # the length is that of the key, and the filter below the hashes does not compute it twice
    lines = lines.select("k", "t", "batch", "pos", stripped(F.col("line")).alias("key")).filter(
        F.length("key") >= min_chars)
    key = lower_ascii(F.col("key"))
    return lines.select("k", "t", "pos", F.xxhash64(key).alias("h"), F.xxhash64(F.lit("second"), key).alias("g"), "batch")


def id_bounds(rows: DataFrame, batches: int) -> list[int]:
    """Ids that cut the rows into about equal batches; any cut gives the same result."""
    shares = [i / batches for i in range(1, batches)]
    found = rows.agg(F.percentile_approx("k", shares, 1000)).first()[0] if shares else None
    return sorted(set(found or []))


def repeated_places(lines: DataFrame, repeated: DataFrame, heavy: int) -> DataFrame:
    """(``k``, ``t``, ``pos``) of the lines that go."""
    totals = lines.groupBy("batch").agg(F.count(F.lit(1)).alias("total"))    # one row for each batch
    sized = repeated.join(F.broadcast(totals), "batch")
    often = F.col("n") * heavy > F.col("total")
    key = ["batch", *HASH]
    hot = F.broadcast(sized.filter(often).select(*key, "first"))
    cold = sized.filter(~often).select(*key, "first")
    goes = F.col("first").isNull() | (F.col("k") > F.col("first"))
    near = lines.join(hot, key).filter(goes)
    far = lines.join(hot.select(*key), key, "left_anti").join(cold.hint("merge"), key).filter(goes)
    return near.unionByName(far).select("k", "t", "pos")


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 8, fanout: int = 4, heavy: int = 2000,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_lines``, ``n_dropped`` and ``kept``, the lines that stay."""
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    bounds = id_bounds(rows, batches)
    path = own_path(spark, "lines")
    numbered = numbered_lines(rows, min_chars, bounds)
    numbered.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(numbered.schema).parquet(path)
    runs = LineRuns(int(spark.conf.get("spark.sql.shuffle.partitions")), fanout)
    found = None
    for i in range(len(bounds) + 1):
        more = runs.add(lines.filter(F.col("batch") == i)).withColumn("batch", F.lit(i))
        found = more if found is None else found.unionByName(more)
    gone = (repeated_places(lines, stored(found, "repeated"), heavy)
            .groupBy("k", "t").agg(F.collect_set("pos").alias("gone")))
    # the lines are cut once, in a projection of their own, and picked by place
    cut = rows.join(gone, ["k", "t"], "left").select(
        F.col("row").getField(id_col).alias(id_col), "text", "gone", split_lines(F.col("text")).alias("lines"))
    n = F.size("lines")
    stays = F.array_except(F.sequence(F.lit(0), n - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(stays, lambda i: F.get("lines", i)), "\n"))
    return cut.select(id_col, n.cast("long").alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))
