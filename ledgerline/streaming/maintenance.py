"""Three jobs that run on schedules of their own, and a view of the latest values that they keep up to date.

Quotes and financials are loaded in batches, in any order and as often as wanted; each load notes the
entities whose rows it brought. The third job recomputes the view for the noted entities alone: it reads
the buckets in which they lie, and of those their rows, derives their part of the view and
replaces their groups there. The notes are forgotten once the view is written, so a job that dies runs again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import periods
from ledgerline.session import written
from ledgerline.sources.buckets import BucketTable

#: (facts, quotes) of some entities to their rows of the view, which has a column entity.
Derive = Callable[[DataFrame, DataFrame], DataFrame]


def latest_values(facts: DataFrame, quotes: DataFrame) -> DataFrame:
    """entity, concept, value, end, strategy of the trailing twelve months, with the last quote of the entity and the
    multiple of it (NULL unless the value is positive)."""
    last = quotes.groupBy("entity").agg(F.max_by("price", F.struct("day", "price")).alias("price"))
    values = periods.trailing_twelve_months(periods.latest_filed(facts))
    multiple = F.when(F.col("value") > 0, F.col("price") / F.col("value"))
    return values.join(last, "entity", "left").withColumn("multiple", multiple)


class Jobs:
    """The tables in one folder: facts and quotes by entity, notes of what changed, and the view."""

    def __init__(self, spark: SparkSession, root: str, derive: Derive = latest_values, buckets: int = 64):
        self.spark, self.root, self.derive = spark, root.rstrip("/"), derive
        self.facts, self.quotes, self.view = (BucketTable(f"{self.root}/{name}", ("entity",), buckets) for name in ("facts", "quotes", "view"))

    def _note(self, batch: DataFrame) -> None:
        """Before the rows are merged and after it: a load that dies, or a refresh in between, loses no change."""
        batch.select("entity").distinct().write.parquet(f"{self.root}/changed/part={uuid.uuid4().hex}")

    def load_financials(self, batch: DataFrame) -> None:
        """Facts (entity, concept, seq, start, end, val, filed); one row for each vintage of a period."""
        batch = written(batch)
        self._note(batch)
        self.facts.upsert(batch, ["entity", "concept", "start", "end", "filed"], ["seq"])
        self._note(batch)

    def load_quotes(self, batch: DataFrame) -> None:
        """Quotes (entity, day, price); the last one of a day stays."""
        batch = written(batch)
        self._note(batch)
        self.quotes.upsert(batch, ["entity", "day"], ["price"])
        self._note(batch)

    def changes(self) -> tuple[DataFrame | None, list[str]]:
        """The entities noted since the last refresh, and the notes' folders."""
        top = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/changed")
        fs = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        parts = [str(x.getPath()) for x in fs.listStatus(top)] if fs.exists(top) else []
        return (self.spark.read.parquet(*parts).select("entity").distinct() if parts else None), parts

    def inputs(self, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The facts and quotes of the changed entities; other buckets aren't read, and of theirs no other entity is kept."""
        touched = self.facts.touched(changed)
        return tuple(t.read(self.spark, touched).join(changed, "entity", "left_semi") for t in (self.facts, self.quotes))

    def refresh(self, everything: bool = False) -> list[int]:
        """Recomputes the view for what changed (or for all entities, after a change of a formula); returns the buckets written.
        Until both facts and quotes have rows there is no view, and the notes stay."""
        if not (self.facts.exists(self.spark) and self.quotes.exists(self.spark)):
            return []
        changed, parts = self.changes()
        if everything:
            facts, quotes = self.facts.read(self.spark), self.quotes.read(self.spark)
        elif changed is None:
            return []
        else:
            facts, quotes = self.inputs(written(changed))
        done = self.view.replace_groups(self.derive(facts, quotes), "entity")
        for part in parts:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(part)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        return done
