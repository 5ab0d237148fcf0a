"""Line duplicates over levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm.common import SPACE, plain, set_aside, stored
from rillmark.session import scratch_path

#: Shortest key that counts, and the number of documents from which it goes (fixed values of the contract).
MIN_CHARS, MIN_DOCS = 40, 5
#: Batches a table is dealt into, and runs of a level that are merged into one of the next.
BATCHES, FANOUT = 4, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


class LineRuns:
    """Runs (h1, h2, docs, last) of line hashes in the shared folder, each sorted, in levels.

    A batch is a run of level 0; FANOUT runs of a level are merged into one run of the next, so a line is rewritten a logarithmic number of
    times however many batches come.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, root: str | None = None):
        self.spark, self.fanout, self.levels = spark, fanout, [[]]
        self.root = root or f"{scratch_path(spark)}/lines-{uuid.uuid4().hex}"

    def _write(self, run: DataFrame, level: int) -> None:
        path = f"{self.root}/{level}-{uuid.uuid4().hex}"
        run.sortWithinPartitions("h1", "h2").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _read(self, *paths: str) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, docs long, last long").parquet(*paths)

    def add(self, batch: DataFrame) -> None:
        """Add a batch (h1, h2, docs, last) and compact the levels that are full. A document's lines come in one batch."""
        self._write(batch, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self._merge(self._read(*self.levels[level])), []
            self._write(merged, level + 1)
            level += 1

    @staticmethod
    def _merge(runs: DataFrame) -> DataFrame:
        return runs.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))

    def merged(self) -> DataFrame:
        paths = [p for level in self.levels for p in level]
        return self._merge(self._read(*paths)) if paths else self.spark.createDataFrame([], "h1 long, h2 long, docs long, last long")

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The batch's rows whose line is in no run."""
        return batch.join(self.merged(), ["h1", "h2"], "left_anti")


def admit(runs: LineRuns, lines: DataFrame) -> DataFrame:
    """For a feed of batches: the lines (h1, h2, doc) not seen before, each once (in its smallest doc), added to the runs."""
    fresh = stored(runs.unseen(lines).groupBy("h1", "h2").agg(F.min("doc").alias("doc")))
    runs.add(fresh.select("h1", "h2", F.lit(1).cast("long").alias("docs"), F.col("doc").alias("last")))
    return fresh


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """All columns of documents (doc_id, text, ...) plus n_lines, n_dropped and kept (the text without its dropped lines).

    A line's key is the line without white space at its ends and with A-Z in lower case. Keys of ``min_chars`` code points or more that
    are in ``min_docs`` documents or more keep only the lines of the largest doc_id. Documents are dealt into batches by id; each batch
    adds a run of its lines with document counts; then each batch's lines are anti-joined with the merged runs' frequent lines, and what
    survives is put together again by position. Lines are known by 128 bits of hash.

    A missing or empty text is one empty line. Rows with the same doc_id are one document; rows without id too, which is smaller than any
    other. Long texts cost time in proportion to their length. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows, own = set_aside(docs, "doc_id", "text")
    rows = rows.withColumn("_doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))).withColumn("_hash", F.xxhash64(plain("text")))
    split = F.split(plain("text"), "\n", -1)
    lines = rows.select("_doc", "_hash", F.posexplode(split).alias("pos", "line")).withColumn("line", line_key(F.col("line"))).filter(F.length("line") >= min_chars)
    low = F.translate("line", UPPER, LOWER)
    lines = lines.select(F.col("_doc").alias("doc"), F.col("_hash").alias("text_hash"), "pos", F.xxhash64(low).alias("h1"), F.xxhash64(F.lit(1), low).alias("h2"),
                         F.pmod(F.xxhash64("_doc"), F.lit(batches)).cast("int").alias("batch"))
    lines = stored(lines, "batch")

    runs = LineRuns(spark)
    for n in range(batches):
        part = lines.filter(F.col("batch") == n).groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
        runs.add(part.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("last")))
    frequent = stored(runs.merged().filter(F.col("docs") >= min_docs).select("h1", "h2", "last"))

    stay = lines.join(frequent.select("h1", "h2", F.col("last").alias("_last")), (lines.h1 == frequent.h1) & (lines.h2 == frequent.h2) & (lines.doc != F.col("_last")), "left_anti")
    kept = stay.groupBy("doc", "text_hash").agg(F.collect_set("pos").alias("_long"))  # positions of the document's own lines
    joined = rows.join(kept, (F.col("_doc") == F.col("doc")) & (F.col("_hash") == F.col("text_hash")), "left")
    short = F.filter(F.transform(split, lambda x, i: F.when(F.length(line_key(x)) < min_chars, i).otherwise(-1)), lambda i: i >= 0)
    joined = joined.withColumn("_split", split)
    joined = joined.withColumn("_keep", F.sort_array(F.concat(short, F.coalesce("_long", F.array().cast("array<int>")))))
    text = F.array_join(F.transform("_keep", lambda i: F.get(F.col("_split"), i)), "\n")
    return joined.select(
        *own, F.size("_split").cast("long").alias("n_lines"), (F.size("_split") - F.size("_keep")).cast("long").alias("n_dropped"), text.alias("kept"))
