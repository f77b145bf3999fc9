"""Exact deduplication by a log-structured merge index of digests, in DataFrame functions only.

The index of a corpus grows by runs. `flush` writes a batch's rows: every task is a memtable, whose rows leave
sorted by digest. `Index.add` makes them a run of level 0, sorted by digest, with one row for each digest: the
row that stays and the number of rows. A batch's digests are held against every older run's bit filter, and only
those that may be in are joined with that run. FANOUT runs of a level are merged into one of the next, which
keeps of each digest the row that stays and adds the sizes; so a row is rewritten once for each level, and a
corpus has FANOUT - 1 runs of each level at most. Digests with more than one row are hits; `verify` compares the
bytes of their normalised texts by grouping on the texts themselves.

Equal means identical after deleting the characters of [\\x20\\x09-\\x0D]; a null text is empty. Of equal
texts the row with the most code points stays, then the smallest id (a null id counts as the largest).
Repeated rows of one id share its decision; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import common

#: Runs of a level that are merged into one of the next.
FANOUT = 4
#: [\x20\x09-\x0D]
BLANKS = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def sha256(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


def _rows(docs: DataFrame, id_col: str, text_col: str, digest=sha256) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(text).cast("long").alias("n"),
        normalised(text).alias("norm"),
    ).withColumn("digest", digest(F.col("norm")))


def _rank() -> Column:
    """Smaller is better: more code points, then the smaller id, null ids last."""
    return F.struct((-F.col("n")).alias("minus_n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"))


def flush(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """The rows (digest, n, doc_id) of a batch, written to `path` in files sorted by digest."""
    rows = _rows(docs, id_col, text_col, digest).select("digest", "n", "doc_id").sortWithinPartitions("digest")
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def compact(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays (smallest rank) and how many rows there are."""
    return rows.groupBy("digest").agg(F.min(_rank()).alias("best"), F.count(F.lit(1)).alias("size"))


def merged(runs: list[DataFrame]) -> DataFrame:
    """One row per digest from runs that each have one."""
    return reduce(DataFrame.unionByName, runs).groupBy("digest").agg(F.min("best").alias("best"), F.sum("size").alias("size"))


class Run:
    """One row per digest, saved in sorted files; its filter is built when a later batch asks."""

    def __init__(self, level: int, rows: DataFrame):
        self.level = level
        self.rows = common.saved(rows.sortWithinPartitions("digest"), f"run-{level}")

    @cached_property
    def filter(self) -> common.BitFilter:
        return common.bit_filter(self.rows, F.col("digest"), "digests")

    def hits(self, digests: DataFrame) -> DataFrame:
        """The run's rows of these digests; only those that its filter lets pass are joined."""
        return self.rows.join(common.maybe_in(digests, F.col("digest"), self.filter), "digest", "left_semi")


class Index:
    """The runs of all batches so far; they lie in the shared folder, their order is the driver's."""

    def __init__(self) -> None:
        self.runs: list[Run] = []

    def add(self, rows: DataFrame) -> DataFrame:
        """Adds a batch's rows (digest, n, doc_id); returns digest, best, size over all batches for its digests."""
        new = Run(0, compact(rows))
        older = [run.hits(new.rows.select("digest")) for run in self.runs]
        found = common.saved(merged([new.rows, *older]), "found") if older else new.rows
        self.runs.append(new)
        level = 0
        while len(full := [r for r in self.runs if r.level == level]) >= FANOUT:
            self.runs = [r for r in self.runs if r.level != level] + [Run(level + 1, merged([r.rows for r in full]))]
            level += 1
        return found


def verify(docs: DataFrame, level: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """Groups of byte-equal texts among the hits: digest, norm, best, size. Copies combine before the shuffle."""
    several = common.bit_filter(level.filter("size > 1"), F.col("digest"), "several")
    hits = common.maybe_in(_rows(docs, id_col, text_col, digest), F.col("digest"), several)
    return hits.groupBy("digest", "norm").agg(F.min(_rank()).alias("best"), F.count(F.lit(1)).alias("size"))


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest=sha256,
    index: Index | None = None,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 (the digest) for every row of docs.

    With an index of earlier batches, rows are held against these, too; `earlier` has their documents, whose bytes
    are compared where digests are equal.
    """
    spark = docs.sparkSession
    rows = flush(docs, common.table_path(spark, "rows"), id_col, text_col, digest)
    level = (index or Index()).add(rows)
    pair = [id_col, text_col]
    every = docs.select(*pair) if earlier is None else docs.select(*pair).unionByName(earlier.select(*pair))
    # digests under which the bytes differ: none, unless the digest is weak
    torn = common.saved(
        verify(every, level, id_col, text_col, digest).groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1"),
        "torn",
    )
    whole = rows.join(level, "digest")
    if not torn.isEmpty():
        whole = whole.join(torn.select("digest"), "digest", "left_anti")
        of_torn = lambda d: _rows(d, id_col, text_col, digest).join(torn.select("digest"), "digest", "left_semi")
        groups = of_torn(every).groupBy("digest", "norm").agg(F.min(_rank()).alias("best"), F.count(F.lit(1)).alias("size"))
        whole = whole.select("digest", "n", "doc_id", "best", "size").unionByName(
            of_torn(docs).join(groups, ["digest", "norm"]).select("digest", "n", "doc_id", "best", "size"),
        )
    return whole.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("best.doc_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns: one row for each text, repeated rows included.

    Rows that the filter of hits rules out pass unmoved; only possible copies are shuffled, combined by
    digest and bytes in their own task first.
    """
    spark, names = docs.sparkSession, docs.columns
    level = Index().add(flush(docs, common.table_path(spark, "rows"), id_col, text_col))
    several = common.bit_filter(level.filter("size > 1"), F.col("digest"), "several")
    norm = normalised(F.col(text_col))
    rank = F.struct(
        (-F.length(F.coalesce(F.col(text_col), F.lit("")))).alias("minus_n"), F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id")
    )
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        norm.alias("norm"),
        rank.alias("rank"),
    ).withColumn("digest", sha256(F.col("norm")))
    marked = common.probed(row, F.col("digest"), several)
    best = marked.filter("_hit").groupBy("digest", "norm").agg(F.min_by("row", "rank").alias("row"))
    return marked.filter(~F.col("_hit")).select("row.*").unionByName(best.select("row.*"))
