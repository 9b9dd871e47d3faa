"""Token totals by source, language and tokenizer version, maintained by deltas.

A batch of changes is a table of signed parts: an insert adds a document and its tokens, a delete
takes both away, a revision takes the old count and adds the new one (under another version,
source or language, if that changed). A commit adds the parts up by key, writes the few sums to a
folder of its own, and then creates the batch's marker file in the log, which names that folder. Creating
the file, never over another one, is the commit: a batch that has a marker is not added again, whether it is
sent twice, by two writers at once, or a driver or executor was lost half-way. Totals are the sums over the
log; compaction replaces its batches by one numbered snapshot that remembers their names, and a number too
is taken by creating its marker, so of two compactors one wins and the other changes nothing.

Sums are partial before the shuffle, so no key is hot, and the log holds keys, not documents.

Cases: null source, language or version are keys of their own; null tokens count as 0; repeated rows
count as often as they occur; an empty batch commits and changes nothing; keys whose documents
and tokens are both 0 are left out of the totals; a text of any length is counted whole; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.bpe import encoder
from quire.llm.common import SPACE_WORD, drop_folder, materialize, new_folder

#: Rows whose texts are encoded together.
ENCODE_ROWS = 200
KEY = ("source", "lang", "version")
SCHEMA = "source string, lang string, version string, n_docs long, n_tokens long"


def inserts(counts: DataFrame) -> DataFrame:
    """Parts for new documents, from (source, lang, version, tokens)."""
    return counts.select(*KEY, F.lit(1).cast("long").alias("n_docs"), F.coalesce("tokens", F.lit(0)).cast("long").alias("n_tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    """Parts for documents that go, from (source, lang, version, tokens)."""
    return counts.select(*KEY, F.lit(-1).cast("long").alias("n_docs"), (-F.coalesce("tokens", F.lit(0))).cast("long").alias("n_tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Parts for documents counted again: what was counted goes, what is counted now comes."""
    return deletes(old).unionByName(inserts(new))


class Rollup:
    """Totals kept under ``folder``: data/ with the sums of batches and snapshots, and markers that name them
    in log/ (by batch) and snapshots/ (by number)."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, folder or new_folder(spark, "rollup")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for kind in ("log", "snapshots", "data"):
            self._fs.mkdirs(self._path(f"{self.folder}/{kind}"))

    def _names(self, kind: str) -> list[str]:
        return sorted(n for s in self._fs.listStatus(self._path(f"{self.folder}/{kind}")) if not (n := s.getPath().getName()).startswith("."))

    def _mark(self, marker: str, told: str) -> bool:
        """Create a marker file; False if there is one."""
        try:
            out = self._fs.create(self._path(f"{self.folder}/{marker}"), False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception):
                return False
            raise
        out.write(bytearray(told.encode()))
        out.close()
        return True

    def _data(self, marker: str) -> str:
        """The folder that a marker names. A writer lost before it wrote the name leaves an empty marker; that
        stands for the first whole folder written for it."""
        told = "".join(r.value for r in self.spark.read.text(f"{self.folder}/{marker}").collect())
        if not told:
            start = marker.replace("/", "-") + "-"
            whole = [n for n in self._names("data") if n.startswith(start) and self._fs.exists(self._path(f"{self.folder}/data/{n}/_SUCCESS"))]
            told = whole[0]
        return f"{self.folder}/data/{told}"

    def _snapshot(self) -> tuple[str | None, set[str]]:
        names = self._names("snapshots")
        if not names:
            return None, set()
        path = self._data(f"snapshots/{names[-1]}")
        return path, {r.batch for r in self.spark.read.parquet(f"{path}-batches").collect()}

    def batches(self) -> set[str]:
        """Names of all batches that are committed. The log is listed first: what leaves it is in a snapshot by then."""
        return set(self._names("log")) | self._snapshot()[1]

    def _stage(self, marker: str, rows: DataFrame) -> str:
        name = f"{marker.replace('/', '-')}-{uuid.uuid4().hex}"
        rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).write.parquet(f"{self.folder}/data/{name}")
        return name

    def commit(self, batch: str, parts: DataFrame) -> bool:
        """Add a batch of signed parts; False if the batch is in already (nothing changes then)."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_-]*", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        if batch in self.batches():
            return False
        return self._publish(batch, self._stage(f"log/{batch}", parts))

    def _publish(self, batch: str, staged: str) -> bool:
        # A batch that a snapshot took up meanwhile has no marker any more, so both are asked.
        if batch in self._snapshot()[1] or not self._mark(f"log/{batch}", staged):
            drop_folder(self.spark, f"{self.folder}/data/{staged}")  # another writer was first
            return False
        return True

    def _rows(self) -> tuple[DataFrame, set[str]]:
        log = self._names("log")
        snapshot, done = self._snapshot()
        paths = [self._data(f"log/{b}") for b in log if b not in done] + ([snapshot] if snapshot else [])
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        return rows, done | set(log)

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens over all committed batches."""
        sums = self._rows()[0].groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 or n_tokens <> 0")

    def compact(self) -> bool:
        """Replace the log's batches by a snapshot; False if another compactor took its number first."""
        staged = self.prepare()
        return self.publish(*staged)

    def prepare(self) -> tuple[str, str, set[str]]:
        """(number, folder, batches) of a snapshot that is written but doesn't count yet."""
        names = self._names("snapshots")
        number = f"{int(names[-1]) + 1 if names else 0:08d}"
        rows, done = self._rows()
        staged = self._stage(f"snapshots/{number}", rows)
        self.spark.createDataFrame([(b,) for b in sorted(done)], "batch string").coalesce(1).write.parquet(f"{self.folder}/data/{staged}-batches")
        return number, staged, done

    def publish(self, number: str, staged: str, done: set[str]) -> bool:
        if not self._mark(f"snapshots/{number}", staged):
            for part in (staged, f"{staged}-batches"):
                drop_folder(self.spark, f"{self.folder}/data/{part}")
            return False
        for batch in done & set(self._names("log")):  # markers only: a plan made before may still read the sums
            drop_folder(self.spark, f"{self.folder}/log/{batch}")
        return True


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """doc_id, source, lang, words, tokens (of the tokenizer) and a digest of the text, for each row."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            enc = encoder(tokenizer_path)
            texts = batch.column(0).to_pylist()
            counts = [len(ids) // 4 for at in range(0, len(texts), ENCODE_ROWS) for ids in enc.encode_all(texts[at : at + ENCODE_ROWS])]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(counts, pa.int64())], [*batch.schema.names[1:], "tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        text.alias("text"), F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), F.col(lang_col).alias("lang"),
        F.regexp_count(text, F.lit(SPACE_WORD)).cast("long").alias("words"), F.md5(text.cast("binary")).alias("digest"),
    )
    return rows.mapInArrow(run, "doc_id long, source string, lang string, words long, digest string, tokens long")


def copies_of_earlier(counts: DataFrame) -> DataFrame:
    """The rows whose text an earlier doc_id has too."""
    # Only digests that repeat are joined, from a written table, so the join may split a hot one.
    first = counts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = materialize(first, "token-first")
    return counts.join(first, "digest").where("doc_id > first").drop("first")


def maintain(docs: DataFrame, tokenizer_path: str, name: str, end_ids: int = 1) -> DataFrame:
    """The life of a corpus in four batches, some sent twice, and the totals after them:

    * ``load`` inserts every document, counted in words and by the tokenizer,
    * ``copies`` deletes exact copies of earlier documents, in both versions,
    * ``end-ids`` revises the tokenizer's counts of what is left: an end id is counted too, version 2,
    * ``load`` and ``copies`` arrive again, and must change nothing, before and after compaction.
    """
    counts = materialize(token_counts(docs, tokenizer_path), "token-counts")
    words = lambda rows: rows.select("source", "lang", F.lit("words@1").alias("version"), F.col("words").alias("tokens"))
    ids = lambda rows, version, more=0: rows.select("source", "lang", F.lit(f"{name}@{version}").alias("version"), (F.col("tokens") + more).alias("tokens"))
    gone = materialize(copies_of_earlier(counts), "token-copies")
    load, copies = inserts(words(counts).unionByName(ids(counts, 1))), deletes(words(gone).unionByName(ids(gone, 1)))
    rollup = Rollup(counts.sparkSession)
    rollup.commit("load", load)
    rollup.commit("copies", copies)
    rollup.commit("load", load)
    rollup.compact()
    # What is left is everything counted less the copies; both sides are signed, so no anti-join is needed.
    left = revisions(ids(counts, 1), ids(counts, 2, end_ids)).unionByName(inserts(ids(gone, 1))).unionByName(deletes(ids(gone, 2, end_ids)))
    rollup.commit("end-ids", left)
    rollup.commit("copies", copies)
    return rollup.totals()
