"""Content addresses and an index of finished operations: a stage that ran on the same inputs is skipped."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.sources.sinks import write_text_file


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """`(path, size, sha256)` of the files under a path, hashed in Spark's tasks."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return rows.select("path", F.col("length").alias("size"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("sha256"))


def tree_hash(spark: SparkSession, path: str) -> str:
    """Hash of a folder's files by relative path, size and content; neither listing order nor the folder's place matter.

    Each file has a hash; four words of each are combined by exclusive or with map-side combine, so no
    list of files is gathered. Spark's own part names (which hold a random id) count by their number.
    """
    rows = file_hashes(spark, path)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath().rstrip("/")
    name = F.substring_index(F.col("path"), root + "/", -1)
    rows = rows.where(~F.element_at(F.split("path", "/"), -1).rlike(r"^[._]"))
    own = F.sha2(F.concat_ws("\x1f", F.regexp_replace(name, r"(part-\d+)-[^./]*", "$1"), F.col("size").cast("string"), "sha256"), 256)
    words = [F.bit_xor(F.conv(F.substring(own, 1 + 15 * k, 15), 16, 10).cast("long")).alias(f"w{k}") for k in range(4)]
    got = rows.agg(F.count(F.lit(1)).alias("n"), *words).first()
    return "sha256:" + hashlib.sha256("|".join(str(v) for v in got).encode()).hexdigest()


def operation_key(operation: str, inputs: Sequence[str]) -> str:
    """Key of an operation and its inputs, in any order."""
    return hashlib.sha256("|".join([operation, "|".join(sorted(inputs))]).encode()).hexdigest()


class OperationIndex:
    """Finished operations as small JSON files in a folder, one per key, so that writers do not clash."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._jvm.org.apache.hadoop.fs.Path(path))

    def find(self, operation: str, inputs: Sequence[str], schema_fingerprint: str | None = None) -> list[str] | None:
        """Outputs of a finished operation; an entry with a lost output or another schema is dropped."""
        path = f"{self.root}/{operation_key(operation, inputs)}.json"
        if not self._exists(path):
            return None
        entry = json.loads("\n".join(r[0] for r in self.spark.read.text(path).collect()))
        stale = schema_fingerprint is not None and entry.get("schema_fingerprint") != schema_fingerprint
        if stale or not all(self._exists(p) for p in entry["outputs"]):
            self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(path), False)
            return None
        return entry["outputs"]

    def record(self, operation: str, inputs: Sequence[str], outputs: Sequence[str], schema_fingerprint: str | None = None) -> None:
        entry = {"operation": operation, "inputs": sorted(inputs), "outputs": list(outputs), "schema_fingerprint": schema_fingerprint}
        write_text_file(self.spark, f"{self.root}/{operation_key(operation, inputs)}.json", json.dumps(entry, sort_keys=True))

    def run(self, operation: str, inputs: Sequence[str], stage: Callable[[], Sequence[str]], schema_fingerprint: str | None = None) -> tuple[list[str], bool]:
        """Outputs of the stage and whether it was skipped."""
        if (known := self.find(operation, inputs, schema_fingerprint)) is not None:
            return known, True
        outputs = list(stage())
        self.record(operation, inputs, outputs, schema_fingerprint)
        return outputs, False
