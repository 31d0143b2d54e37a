"""Delta-maintained token counts: totals by source, language and tokenizer version, kept up to date by signed changes.

A batch of changes holds inserts, deletes and revised counts of documents.  Each becomes signed rows (a revision takes the old count away
and adds the new one, in another group where ``old_source``, ``old_lang`` or ``old_tokenizer_version`` say so), which are summed before
anything is shuffled, so a group that holds most documents costs a row a task.  The sums of a batch are appended under the
batch's name, and a view adds them up; totals only ever change by addition, so the order of batches does not matter.

A commit is idempotent: a batch is one folder, named by the batch, and it counts only with its commit mark, which Spark's writer leaves last; a batch that is there is
not applied again, and an attempt that failed half way has no mark and is overwritten by the next.  One writer commits at a time.
``fold`` adds up committed batches to a base by the same rule: the base is one folder that holds the totals and the names of its
batches, so a view reads the newest base and the batches that it does not hold.

Defined results: null sources and languages are groups of their own; a null count is no change of tokens; changes of an unknown kind and
changes without a kind are refused; equal rows are changes of their own; an empty batch is committed as such; totals that have come back to no
documents and no tokens are left out.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspan.llm.packing import default_tokenizer, load_encoder, text_blocks
from flatspan.session import new_stage_path, write_stage

_WORD = re.compile(r"\S+")
KINDS = ("insert", "delete", "revise")
KEYS = ("source", "lang", "tokenizer_version")
#: Files of a batch at most; a batch has a row for each group, not for each document.
BATCH_FILES = 8
TOTALS = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"
#: A base has the rows of its totals and one for the name of each batch.
BASE = f"{TOTALS}, batch string"
BASE_COLUMNS = [c.split()[0] for c in BASE.split(", ")]


def signed(changes: DataFrame) -> DataFrame:
    """One row for each group: the documents and tokens that the changes (kind, source, lang, tokenizer_version, n_tokens,
    old_tokens) add or take away."""
    kind = F.coalesce("kind", F.lit(""))
    known = F.when(kind.isin(*KINDS), kind).otherwise(F.raise_error(F.concat(F.lit("unknown kind of change: "), kind)))
    new, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    keys = [F.col(c) for c in KEYS]
    before = [F.col(f"old_{c}").alias(c) if f"old_{c}" in changes.columns else F.col(c) for c in KEYS]
    added = F.struct(*keys, F.lit(1).alias("docs"), new.cast("long").alias("tokens"))
    taken = lambda group: F.struct(*group, F.lit(-1).alias("docs"), (-old).cast("long").alias("tokens"))
    rows = changes.select(F.when(known == "insert", F.array(added)).when(known == "delete", F.array(taken(keys))).otherwise(F.array(added, taken(before))).alias("s"))
    rows = rows.select(F.explode("s").alias("s")).select("s.*")
    return rows.groupBy(*KEYS).agg(F.sum("docs").cast("long").alias("n_docs"), F.sum("tokens").cast("long").alias("n_tokens"))


class Rollup:
    """Totals in a folder that all executors reach; one folder for each committed batch."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _path(self, batch: str) -> str:
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        return f"{self.folder}/batch={batch}"

    def committed(self, batch: str) -> bool:
        return self._marked(self._path(batch))

    def _marked(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False if it is there already."""
        if self.committed(batch):
            return False
        signed(changes).coalesce(BATCH_FILES).write.mode("overwrite").parquet(self._path(batch))
        return True

    def _base(self, number: int) -> str:
        return f"{self.folder}/base={number}"

    def bases(self) -> int:
        """How many bases there are; each one holds what the one before it held."""
        number = 0
        while self._marked(self._base(number + 1)):
            number += 1
        return number

    def _parts(self, batches: list[str]) -> tuple[DataFrame, list[str]]:
        """The rows to be added up for ``batches``, and the names of those that are committed."""
        there, rows, held = [b for b in batches if self.committed(b)], self.spark.createDataFrame([], TOTALS), set()
        number = self.bases()
        if number:
            base = self.spark.read.schema(BASE).parquet(self._base(number))
            names = {r["batch"] for r in base.where("batch is not null").select("batch").collect()}  # one a batch
            if names <= set(there):
                rows, held = base.where("batch is null").drop("batch"), names
        paths = [self._path(b) for b in there if b not in held]
        return (rows.unionByName(self.spark.read.schema(TOTALS).parquet(*paths)) if paths else rows), there

    def fold(self, batches: list[str]) -> bool:
        """Add the committed ones of ``batches``, and what the newest base holds, up to a new base; False if there is nothing new."""
        number = self.bases()
        held = set()
        if number:
            held = {r["batch"] for r in self.spark.read.schema(BASE).parquet(self._base(number)).where("batch is not null").select("batch").collect()}
        rows, there = self._parts(sorted({*batches, *held}))
        if set(there) <= held:
            return False
        names = self.spark.createDataFrame([(b,) for b in there], "batch string")
        added_up(rows).unionByName(names, allowMissingColumns=True).select(*BASE_COLUMNS).coalesce(BATCH_FILES).write.mode("overwrite").parquet(self._base(number + 1))
        return True

    def totals(self, batches: list[str]) -> DataFrame:
        """The totals after those of ``batches`` that are committed."""
        return added_up(self._parts(batches)[0])


def added_up(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return sums.where("n_docs <> 0 or n_tokens <> 0")


def counted(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, source, lang, text_hash, n_words, n_tokens): tokens by two versions, words between blanks and the vocabulary's ids."""
    schema = "doc_id long, source string, lang string, text_hash binary, n_words long, n_tokens long"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(tokenizer or default_tokenizer())
        for batch in batches:
            words, tokens = [], []
            for value in batch.column(4):
                text = value.as_py() or ""
                words.append(sum(1 for _ in _WORD.finditer(text)))
                tokens.append(sum(len(encode(b)) for b in text_blocks(text)))
            counts = pa.array(words, pa.int64()), pa.array(tokens, pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *counts], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("text_hash"), "text")
    return rows.mapInArrow(run, schema)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over all documents: inserts counted by words and by ids; revisions of the word counts to the ids' counts; deletes of
    every copy of a text but the one with the smallest id.  Each is committed twice, the second time without effect."""
    rows = write_stage(counted(spark.read.parquet(f"{sf_dir}/documents.parquet")), "token-counts")
    firsts = write_stage(rows.groupBy("text_hash").agg(F.min("doc_id").alias("first")), "token-firsts")
    copies = rows.join(firsts, "text_hash").where("doc_id > first")
    version = lambda v: F.lit(v).alias("tokenizer_version")
    none = F.lit(None).cast("long")
    change = lambda df, kind, v, new, old: df.select(F.lit(kind).alias("kind"), "source", "lang", version(v), new.alias("n_tokens"), old.alias("old_tokens"))
    words, tokens = F.col("n_words"), F.col("n_tokens")
    batches = {
        "load": change(rows, "insert", "v1", words, none).union(change(rows, "insert", "v2", tokens, none)),
        "recount": change(rows, "revise", "v1", tokens, words),
        "copies": change(copies, "delete", "v1", none, tokens).union(change(copies, "delete", "v2", none, tokens)),
    }
    rollup = Rollup(spark, new_stage_path(spark, "token-rollup"))
    for _ in range(2):
        for name, changes in batches.items():
            rollup.commit(name, changes)
        rollup.fold(["load", "recount"])
    return rollup.totals(list(batches))
