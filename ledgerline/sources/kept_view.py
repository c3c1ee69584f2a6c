"""A view with sums that is kept up to date by what changes, not computed anew.

``KeptView`` holds, for each group, how many rows it has and the exact sums of some values. Changes come as rows with a sign: 1 for an inserted row,
-1 for a deleted one, both images for a changed one (``signed``). They are added up per group first, and only the parts
(whole numbers, such as quarters) in which some group changes are read and written again; a group without rows is gone.

Parts are written to folders of their own, and a manifest that names the folder of each part is published last, so readers see all of a
batch or nothing. Batches are numbered: one that was applied before changes nothing when it comes again. Counts and sums make this exact; least and
greatest values can't be kept under deletion.

The manifest has one row per part and is read by the driver, as are the numbers of the parts that a batch changes.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import cut_lineage
from ledgerline.sources import sinks

SIGN, ROWS = "__sign", "n_rows"
SUM = "decimal(38,6)"


def signed(inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """Rows to add and to take away as one table of changes; a changed row is its old image deleted and its new one inserted."""
    parts = [df.withColumn(SIGN, F.lit(s)) for df, s in ((inserted, 1), (deleted, -1)) if df is not None]
    if not parts:
        raise ValueError("no changes are given")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


class KeptView:
    """``part`` is a whole number per row, ``group`` names columns, ``sums`` maps output names to values. A null value adds nothing."""

    def __init__(self, spark: SparkSession, root: str, part: Column, group: Sequence[str], sums: Mapping[str, Column]):
        self.spark, self.root, self.part = spark, root, part
        self.group, self.sums = list(group), dict(sums)

    @property
    def _manifest(self) -> str:
        return f"{self.root}/manifest"

    def _folders(self) -> tuple[int, dict[int, str]]:
        """The last batch, and the folder of each part."""
        path = sinks.snapshot_path(self.spark, self._manifest)
        if path is None:
            return -1, {}
        rows = self.spark.read.parquet(path).collect()
        last = max((r.batch for r in rows), default=-1)
        return last, {r.part: r.folder for r in rows if r.folder is not None}

    def last_batch(self) -> int:
        """Number of the batch that was applied last, -1 before the first."""
        return self._folders()[0]

    def _added_up(self, rows: DataFrame) -> DataFrame:
        """One row per part and group of rows that are partial sums."""
        names = [ROWS, *self.sums]
        kinds = dict.fromkeys(self.sums, SUM) | {ROWS: "bigint"}
        return rows.groupBy("part", *self.group).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in names])

    def _partial(self, changes: DataFrame) -> DataFrame:
        sign = F.col(SIGN)
        values = [F.coalesce(value.cast(SUM), F.lit(0)).cast(SUM).alias(name) for name, value in self.sums.items()]
        rows = changes.select(self.part.cast("bigint").alias("part"), *self.group, sign.alias(ROWS), *values)
        return self._added_up(rows.select("part", *self.group, ROWS, *[(F.col(c) * F.col(ROWS)).cast(SUM).alias(c) for c in self.sums]))

    def apply(self, changes: DataFrame, batch: int) -> list[int]:
        """Apply one batch; the numbers of the parts that were written anew. A null part is an error."""
        last, folders = self._folders()
        if batch <= last:
            return []
        delta = cut_lineage(self._partial(changes))
        # A change that takes away what it brings leaves its part alone.
        moved = F.col(ROWS) != 0
        for c in self.sums:
            moved = moved | (F.col(c) != 0)
        delta = delta.filter(moved)
        touched = sorted((r.part for r in delta.select("part").distinct().collect()), key=lambda p: (p is not None, p))
        if None in touched:
            raise ValueError("a row has no part")
        before = self._read({p: folders[p] for p in touched if p in folders})
        rows = self._added_up(delta if before is None else before.unionByName(delta))
        below = F.raise_error(F.lit("a group has fewer rows than none: a deleted row was not there")).cast("boolean")
        now = rows.filter(F.when(F.col(ROWS) < 0, below).otherwise(F.col(ROWS) > 0))
        base = f"{self.root}/data/batch={batch:012d}"
        now.withColumn("p", F.col("part")).hint("rebalance", "p").write.mode("overwrite").partitionBy("p").parquet(base)
        there = set(sinks.folder_names(self.spark, base))
        folders = {p: f for p, f in folders.items() if p not in touched} | {p: f"{base}/p={p}" for p in touched if f"p={p}" in there}
        listed = [(batch, p, f) for p, f in folders.items()] or [(batch, None, None)]
        sinks.publish_snapshot(self.spark.createDataFrame(listed, "batch bigint, part bigint, folder string").coalesce(1), self._manifest, batch)
        return touched

    def _read(self, folders: Mapping[int, str]) -> DataFrame | None:
        return self.spark.read.parquet(*folders.values()) if folders else None

    def read(self, parts: Iterable[int] | None = None) -> DataFrame:
        """The view: ``part``, the group, ``n_rows`` and the sums; of some parts, only their files are read."""
        _, folders = self._folders()
        wanted = folders if parts is None else {p: folders[p] for p in set(parts) if p in folders}
        found = self._read(wanted)
        if found is not None:
            return found
        if not folders:
            raise FileNotFoundError(f"nothing was applied to the view below {self.root}")
        return self._read(dict([next(iter(folders.items()))])).limit(0)

    def retire(self) -> int:
        """Remove the folders of batches of which no part is read any more, once no reader needs an older state; how many."""
        _, folders = self._folders()
        used = {f.rpartition("/")[0].rpartition("/")[2] for f in folders.values()}
        gone = [n for n in sinks.folder_names(self.spark, f"{self.root}/data") if n not in used]
        for name in gone:
            sinks.drop_path(self.spark, f"{self.root}/data/{name}")
        return len(gone)
