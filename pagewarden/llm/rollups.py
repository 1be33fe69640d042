"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed deltas. A batch of changes is reduced to one row for
each key that it touches and written into a folder of its own. It counts from the moment when the next manifest names it:
manifests are numbered files with the folders that count and the ids of all batches committed, each put in place by one
rename that fails where the number is taken (then the commit is tried again after the other's). So a replay changes nothing,
a batch that broke off counts for nothing, and ``compact``, which publishes one folder for all, has no moment without totals.
``vacuum`` deletes what no manifest of the last two names.

Changes are rows (doc_id, source, lang, tokenizer, change, n_tokens, old_tokens): an insert adds a document and its
count, a delete takes both away (the count is in old_tokens), a revision adds the difference of the two counts. Null
sources, languages and versions are keys of their own; null counts are 0; other changes are an error; repeated rows count
each time; extra columns are ignored; an empty batch commits and adds nothing; keys that come to nothing disappear.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import shared_dir

KEYS = ("source", "lang", "tokenizer")
_SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
# A word of each tokenizer version, as a pattern.
VERSIONS = {"words-1": r"[^\x20\x09-\x0D]+", "words-2": r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}


def counts(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens) of every row under every version."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    each = F.array(*[F.struct(F.lit(v).alias("tokenizer"), F.regexp_count(text, F.lit(p)).cast("long").alias("n_tokens")) for v, p in VERSIONS.items()])
    return docs.select("doc_id", "source", "lang", F.explode(each).alias("c")).select("doc_id", "source", "lang", "c.tokenizer", "c.n_tokens")


def inserts(counted: DataFrame) -> DataFrame:
    return counted.select("doc_id", *KEYS, F.lit("insert").alias("change"), "n_tokens", F.lit(0).cast("long").alias("old_tokens"))


def deletes(counted: DataFrame) -> DataFrame:
    return counted.select("doc_id", *KEYS, F.lit("delete").alias("change"), F.lit(0).cast("long").alias("n_tokens"), F.col("n_tokens").alias("old_tokens"))


def revisions(counted: DataFrame, new) -> DataFrame:
    """new: a column, the revised count."""
    return counted.select("doc_id", *KEYS, F.lit("revise").alias("change"), new.cast("long").alias("n_tokens"), F.col("n_tokens").alias("old_tokens"))


class Rollup:
    """A rollup in a folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{shared_dir(spark)}/pagewarden/rollup-{uuid.uuid4().hex}"
        path = self._path("")
        self.fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(path)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _names(self, prefix: str) -> list[str]:
        return sorted(n for s in self.fs.listStatus(self._path("")) if (n := s.getPath().getName()).startswith(prefix))

    def _manifest(self, name: str) -> dict:
        stream = self.fs.open(self._path(name))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def state(self) -> tuple[int, dict]:
        """Number and content of the last manifest: the folders that count, and the batch ids committed."""
        names = self._names("manifest-")
        return (int(names[-1].removeprefix("manifest-")), self._manifest(names[-1])) if names else (0, {"folders": [], "batches": []})

    def _publish(self, number: int, content: dict) -> bool:
        """Whether this call put the manifest of that number in place."""
        own = self._path(f"attempt-{uuid.uuid4().hex}")
        out = self.fs.create(own, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        try:
            context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.toUri() if own.toUri().getScheme() else self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
            none = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = none
            context.rename(self.fs.makeQualified(own), self.fs.makeQualified(self._path(f"manifest-{number:012d}")), options)
            return True
        except Py4JJavaError as error:
            self.fs.delete(own, False)
            if "FileAlreadyExists" in str(error.java_exception):
                return False
            raise

    def committed(self, batch_id: str) -> bool:
        return batch_id in self.state()[1]["batches"]

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Applies a batch once; whether this call did. The hash aggregate combines before the shuffle."""
        if self.committed(batch_id):
            return False
        sign = F.when(F.col("change") == "insert", 1).when(F.col("change") == "delete", -1).when(F.col("change") == "revise", 0)
        sign = sign.otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("change", F.lit("null")))).cast("int"))
        delta = F.coalesce("n_tokens", F.lit(0)) - F.coalesce("old_tokens", F.lit(0))
        rows = changes.groupBy(*KEYS).agg(F.sum(sign).cast("long").alias("n_docs"), F.sum(delta).cast("long").alias("n_tokens"))
        own = f"data-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{own}")
        while True:
            number, now = self.state()
            if batch_id in now["batches"]:
                self.fs.delete(self._path(own), True)
                return False
            if self._publish(number + 1, {"folders": [*now["folders"], own], "batches": [*now["batches"], batch_id]}):
                return True

    def _totals(self, folders: list[str]) -> DataFrame:
        paths = [f"{self.folder}/{n}" for n in folders]
        rows = self.spark.read.schema(_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], _SCHEMA)
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 OR n_tokens <> 0")

    def totals(self) -> DataFrame:
        return self._totals(self.state()[1]["folders"])

    def compact(self) -> None:
        """Folds what all committed batches say into one folder; replays of theirs stay without effect."""
        while True:
            number, now = self.state()
            own = f"data-{uuid.uuid4().hex}"
            self._totals(now["folders"]).write.parquet(f"{self.folder}/{own}")
            if self._publish(number + 1, {"folders": [own], "batches": now["batches"]}):
                return
            self.fs.delete(self._path(own), True)

    def vacuum(self) -> None:
        """Deletes folders and manifests that the last two manifests do not name; not while a commit is under way."""
        names = self._names("manifest-")
        live = {f for n in names[-2:] for f in self._manifest(n)["folders"]} | set(names[-2:])
        for n in [x for prefix in ("data-", "manifest-", "attempt-") for x in self._names(prefix)]:
            if n not in live:
                self.fs.delete(self._path(n), True)
