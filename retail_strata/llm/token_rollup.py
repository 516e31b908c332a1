"""Token counts: totals by source, language and tokenizer version, kept up to date by deltas.

A batch of changes inserts documents' counts, revises them or deletes them. Each change becomes
signed rows of a ledger: what the ledger holds for the document is taken back, and the new count, if
any, is added. Totals are sums of signed rows, so a batch adds its own sums to the totals before it.

The ledger is parted by a hash of the document. A batch reads and writes the parts that its own
documents fall into and no others. A part is one base and at most ``deltas`` files of signed rows;
the batch that would add one more writes a new base instead, so what a batch reads does not grow
with the number of batches before it. Parts are as even as the hash: copies of a document's changes
are brought down to one before they are dealt.

A batch is written under a name of its own attempt and takes effect by one commit, a file that names
all batches and the attempts that make up every part. A batch that is committed already is left
out when it comes again; an attempt that broke off is never read. One writer at a time is assumed.

Within a batch the last change of a document and tokenizer counts (by ``seq``; among equal ones a
deletion comes last, then the larger count). Inserting a document that is there replaces it,
revising one that is not inserts it, and deleting one that is not does nothing. A null count is 0;
null ids, sources, languages and tokenizers are values like others. Totals without documents are
left out, so empty tables give no rows. Only the named columns are read.
"""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_strata.storage import DONE, entries, exists

GROUP = ["source", "lang", "tokenizer"]
CHANGES = "op string, seq bigint, doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint"
_LEDGER = "doc_id bigint, source string, lang string, tokenizer string, d_docs bigint, d_tokens bigint"
_TOTALS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
#: Rows of a commit: a ``batch`` that took effect, the number of ``parts``, and a part's ``base`` or ``delta``.
_COMMIT = "kind string, position int, name string, attempt string"


class TokenRollup:
    """Totals under a folder that all executors share.

    The number of ``parts`` is settled by the first batch; choose it so that a part is some hundred
    MB. A part has ``deltas`` files of changes at most.
    """

    def __init__(self, spark: SparkSession, root: str, parts: int = 64, deltas: int = 8) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.parts, self.deltas = parts, deltas

    def _committed(self) -> list[tuple[str, int, str, str]]:
        """Rows of the last commit, in order: one for each batch, and ``deltas + 1`` at most a part."""
        found = entries(self.spark, f"{self.root}/commits") or []
        for entry in sorted(found, key=lambda e: e.name, reverse=True):
            if exists(self.spark, f"{entry.path}/{DONE}"):
                return sorted(tuple(r) for r in self.spark.read.schema(_COMMIT).parquet(entry.path).collect())
        return []

    def commits(self) -> list[tuple[int, str, str]]:
        """Position, batch and attempt of every batch that took effect, in order."""
        return [row[1:] for row in self._committed() if row[0] == "batch"]

    def totals(self) -> DataFrame:
        """``(source, lang, tokenizer, n_docs, n_tokens)`` after the last batch that took effect."""
        return self._totals(self.commits())

    def _totals(self, done: list[tuple[int, str, str]]) -> DataFrame:
        if not done:
            return self.spark.createDataFrame([], _TOTALS)
        return self.spark.read.schema(_TOTALS).parquet(f"{self.root}/totals/{done[-1][2]}")

    def part_files(self, part: int) -> list[str]:
        """Folders that make up a part of the ledger: its base, if it has one, and its deltas."""
        return self._paths(self._committed(), {part})

    def _paths(self, rows: list[tuple[str, int, str, str]], parts: set[int]) -> list[str]:
        return [
            f"{self.root}/{kind}/{attempt}/part={part}"
            for kind, part, _, attempt in rows
            if kind in ("base", "delta") and part in parts
        ]

    def _ledger(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], _LEDGER)
        return self.spark.read.schema(_LEDGER).parquet(*paths)

    def _write(self, rows: DataFrame, kind: str, attempt: str) -> set[int]:
        """Write ledger rows by part; the parts that got some."""
        path = f"{self.root}/{kind}/{attempt}"
        rows.repartition(self.parts, "part").write.partitionBy("part").parquet(path)
        written = self.spark.read.schema(f"{_LEDGER}, part int").parquet(path)
        return {r["part"] for r in written.select("part").distinct().collect()}  # parts at most

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Bring a batch of ``CHANGES`` into effect; False if it was so before."""
        rows = self._committed()
        done = [row[1:] for row in rows if row[0] == "batch"]
        if any(name == batch for _, name, _ in done):
            return False
        self.parts = next((n for kind, n, _, _ in rows if kind == "parts"), self.parts)
        attempt = f"{batch}-{uuid.uuid4().hex}"
        part = F.pmod(F.xxhash64("doc_id"), F.lit(self.parts)).cast("int")
        deletes = (F.col("op") == "delete").cast("int")
        count = F.coalesce("n_tokens", F.lit(0).cast("bigint"))
        last = (
            changes.select("doc_id", "tokenizer", F.struct("seq", deletes.alias("gone"), count.alias("n"), "source", "lang").alias("c"))
            .groupBy("doc_id", "tokenizer")
            .agg(F.max("c").alias("c"))
        )
        if done:
            last.write.parquet(f"{self.root}/changes/{attempt}")  # read for its parts, then twice more
            last = self.spark.read.schema(last.schema).parquet(f"{self.root}/changes/{attempt}")
            touched = {r["part"] for r in last.select(part.alias("part")).distinct().collect()}
        else:
            touched = set()  # nothing is held yet
        held = (
            self._ledger(self._paths(rows, touched))
            .groupBy("doc_id", *GROUP)
            .agg(F.sum("d_docs").alias("docs"), F.sum("d_tokens").alias("tokens"))
            .where("docs <> 0 or tokens <> 0")
        )
        same = held["doc_id"].eqNullSafe(last["doc_id"]) & held["tokenizer"].eqNullSafe(last["tokenizer"])
        back = held.join(last, same, "left_semi").select(
            "doc_id", *GROUP, (-F.col("docs")).alias("d_docs"), (-F.col("tokens")).alias("d_tokens")
        )
        new = last.where("c.gone = 0 or c.gone is null").select(
            "doc_id",
            F.col("c.source").alias("source"),
            F.col("c.lang").alias("lang"),
            "tokenizer",
            F.lit(1).cast("bigint").alias("d_docs"),
            F.col("c.n").alias("d_tokens"),
        )
        changed = self._write(back.unionByName(new).withColumn("part", part), "delta", attempt)
        rows = self._compacted(rows + [("delta", p, "", attempt) for p in changed], changed, attempt)
        own = (
            self._ledger([f"{self.root}/delta/{attempt}"] if changed else [])
            .groupBy(*GROUP)
            .agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
        )
        totals = (
            self._totals(done)
            .unionByName(own)
            .groupBy(*GROUP)
            .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .where("n_docs <> 0")
        )
        totals.write.parquet(f"{self.root}/totals/{attempt}")
        rows += [("batch", len(done), batch, attempt)] + ([] if done else [("parts", self.parts, "", "")])
        commit = self.spark.createDataFrame(rows, _COMMIT).coalesce(1)
        commit.write.mode("overwrite").parquet(f"{self.root}/commits/{len(done):09d}")
        return True

    def _compacted(self, rows: list, changed: set[int], attempt: str) -> list:
        """The rows of a commit after parts with too many deltas have got a new base."""
        counts = Counter(p for kind, p, _, _ in rows if kind == "delta")
        full = {p for p in changed if counts[p] > self.deltas}
        if not full:
            return rows
        sums = (
            self._ledger(self._paths(rows, full))
            .groupBy("doc_id", *GROUP)
            .agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))
            .where("d_docs <> 0 or d_tokens <> 0")
        )
        part = F.pmod(F.xxhash64("doc_id"), F.lit(self.parts)).cast("int")
        based = self._write(sums.withColumn("part", part), "base", attempt)
        kept = [r for r in rows if r[0] not in ("base", "delta") or r[1] not in full]
        return kept + [("base", p, "", attempt) for p in based]
