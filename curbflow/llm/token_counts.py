"""Token totals by source, language and tokenizer, kept up to date by signed deltas.

A batch of changes inserts documents, deletes them, or revises their counts. Each change becomes a
signed row (documents, tokens), and only the batch's sums by group are stored, in a folder of the
batch's own. Totals are the sums over all batches, so the order of batches does not matter. A batch
is written aside and renamed into place: a batch id that is already there is not applied again,
and a failed write leaves nothing that counts.

Columns of a change: change_id, op (``insert``, ``delete`` or ``revise``), source, lang, tokenizer,
n_tokens, and for revisions old_n_tokens, the count that it replaces.

Defined results: rows of one change_id within a batch count once, as the greatest of them (rows without an id each
count); a null count is 0; null sources, languages and tokenizers are groups of their own; rows
with another or no op change nothing; an empty batch commits as one without groups. Other columns
are not read.

Sums are formed within each task before the one shuffle, so a source with a third of all rows is a
few rows per task.
"""

from __future__ import annotations

import urllib.parse
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.groups import stored
from curbflow.llm.tokens import WordBpe
from curbflow.session import scratch_path

GROUP = ["source", "lang", "tokenizer"]
_SCHEMA = "source string, lang string, tokenizer string, d_docs long, d_tokens long"


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``docs`` as struct ``row`` with n_tokens, by a vocabulary file that every executor can open."""

    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        bpe = WordBpe.shared(tokenizer)
        return pa.array([len(ids) for _, ids in bpe.encode(texts)], pa.int64())

    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    return docs.select(row, counted(docs["text"].cast("string")).alias("n_tokens"))


def one_of_each(rows: DataFrame, id: str) -> DataFrame:
    """One row for each id: of rows that contradict each other the greatest by all columns, whatever
    their order. Rows with a null id stay."""
    rest = [c for c in rows.columns if c != id]
    one = rows.where(f"{id} IS NOT NULL").groupBy(id).agg(F.max(F.struct(*rest)).alias("_one")).select(id, "_one.*")
    return one.select(*rows.columns).union(rows.where(f"{id} IS NULL"))


def signed(changes: DataFrame) -> DataFrame:
    """The sums of a batch by group: d_docs, d_tokens."""
    named = one_of_each(changes, "change_id")
    sign = F.expr("CASE op WHEN 'insert' THEN 1 WHEN 'delete' THEN -1 WHEN 'revise' THEN 0 END").cast("long")
    new, old = F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)), F.coalesce(F.col("old_n_tokens").cast("long"), F.lit(0))
    tokens = F.when(F.col("op") == "revise", new - old).otherwise(sign * new)
    kept = named.withColumn("d_docs", sign).withColumn("d_tokens", tokens).where("d_docs IS NOT NULL")
    return kept.groupBy(*[F.col(c).cast("string").alias(c) for c in GROUP]).agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))


class TokenLedger:
    """Deltas by batch in a folder that every executor reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._paths(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _folder(self, batch_id: str) -> str:
        return f"{self.path}/batches/{urllib.parse.quote(str(batch_id), safe='')}"

    def has(self, batch_id: str) -> bool:
        return self._files.exists(self._paths(self._folder(batch_id)))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Applies a batch once; False if it was applied before."""
        if self.has(batch_id):
            return False
        aside = f"{self.path}/pending/{uuid.uuid4().hex}"
        signed(changes.select("change_id", "op", *GROUP, "n_tokens", "old_n_tokens")).write.parquet(aside)
        self._files.mkdirs(self._paths(f"{self.path}/batches"))
        # a writer that came second finds the folder and its rename is refused or nests nothing
        if self.has(batch_id) or not self._files.rename(self._paths(aside), self._paths(self._folder(batch_id))):
            self._files.delete(self._paths(aside), True)
            return False
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of all committed batches; empty groups are left out."""
        root = self._paths(f"{self.path}/batches")
        folders = [s.getPath().toString() for s in self._files.listStatus(root)] if self._files.exists(root) else []
        deltas = self.spark.read.schema(_SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], _SCHEMA)
        sums = deltas.groupBy(*GROUP).agg(F.sum("d_docs").alias("n_docs"), F.sum("d_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 OR n_tokens <> 0")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches over all documents: every document comes in; copies of a text with
    a smaller id go; the others' counts are revised for an end token. The deletions come twice.

    A null text is a text of its own without tokens. A null id comes after all others. An id with
    several texts is one document, with the greatest of its rows."""
    import public_tokenizers

    name = "word_bpe_49k.json"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "text")
    keyed = docs.select("*", F.xxhash64("text").alias("a"), F.coalesce(F.crc32(F.reverse("text")), F.lit(-1)).alias("b"))
    counted = count_tokens(keyed, public_tokenizers.path(name)).select("row.doc_id", "row.source", "row.lang", "row.a", "row.b", "n_tokens")
    counted = stored(spark, one_of_each(counted, "doc_id"), "counts")
    first = counted.groupBy("a", "b").agg(F.min("doc_id").alias("first"))
    seen = counted.join(first, ["a", "b"]).select(
        F.col("doc_id").alias("change_id"), "source", "lang", F.lit(name).alias("tokenizer"), "n_tokens", F.coalesce(F.col("doc_id") > F.col("first"), F.col("first").isNotNull()).alias("copy")
    )
    none = F.lit(None).cast("long").alias("old_n_tokens")
    inserts = seen.select("change_id", F.lit("insert").alias("op"), *GROUP, "n_tokens", none)
    deletes = seen.where("copy").select("change_id", F.lit("delete").alias("op"), *GROUP, "n_tokens", none)
    revised = seen.where("NOT copy").select(
        "change_id", F.lit("revise").alias("op"), *GROUP, (F.col("n_tokens") + 1).alias("n_tokens"), F.col("n_tokens").alias("old_n_tokens")
    )
    ledger = TokenLedger(spark, scratch_path(spark, "token-ledger"))
    for batch_id, changes in (("insert", inserts), ("delete", deletes), ("revise", revised), ("delete", deletes)):
        ledger.commit(batch_id, changes)
    return ledger.totals()
