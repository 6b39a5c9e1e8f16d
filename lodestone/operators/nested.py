"""Deeply nested records to related flat tables, in one pass over each record.

A depth-first visitor walks a record once and emits, for each object of a tagged field, the table
tag, its own key, the key of the enclosing emitted object and its scalar payload. Nothing is
shuffled; `flat_tables` then selects by tag and applies one schema per table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The tagged fields and the columns of their tables.
LABEL_TABLES = {
    "approvals": "approval_id string, code string, type string",
    "territories": "country string, since string",
    "ingredients": "name string, unii string, role string, strength string",
    "moieties": "name string, unii string",
    "sections": "loinc string, name string, title string, text string",
}
BATCH = 20_000


def _opened(value):
    """The value, read again as long as it is JSON text of an object or a list."""
    while isinstance(value, str):
        text = value.strip()
        if text[:1] not in ("{", "[", '"'):
            return value
        try:
            value = json.loads(text)
        except (ValueError, RecursionError):
            return value
    return value


def _holder(root, key: str):
    """The outermost object that has the field `key`, breadth first; else the root itself."""
    level = [root]
    while level:
        below = []
        for node in level:
            node = _opened(node)
            if isinstance(node, dict):
                if key in node:
                    return node
                below += node.values()
            elif isinstance(node, list):
                below += [x for x in node if not isinstance(x, str)]
        level = below
    return _opened(root)


def visit(text: str | None, tags: frozenset[str], root_key: str) -> Iterator[tuple[str, str, str, str]]:
    """`(tag, path, parent path, payload JSON)` of each object of a tagged field, depth first."""
    if text is None:
        return
    try:
        root = json.loads(text)
    except (ValueError, RecursionError):
        return
    root = _holder(root, root_key)
    # an explicit stack: depth is limited by memory only
    stack: list[tuple[str, object, str, str]] = [("", root, "", "")]
    while stack:
        tag, node, path, parent = stack.pop()
        if isinstance(node, dict):
            if tag:
                flat = {k: v for k, v in node.items() if k not in tags}
                yield tag, path, parent, json.dumps(flat, ensure_ascii=False)
                parent = path
            nested = []
            for k, v in node.items():
                below = f"{path}.{k}" if path else k
                v = _opened(v)
                if k in tags and isinstance(v, dict):
                    nested.append((k, v, f"{below}.0", parent))
                elif isinstance(v, list):
                    nested += [(k if k in tags else "", x, f"{below}.{i}", parent) for i, x in enumerate(v) if isinstance(x, (dict, list))]
                elif isinstance(v, dict):
                    nested.append(("", v, below, parent))
            stack += reversed(nested)
        elif isinstance(node, list):  # a list right inside a list
            stack += [(tag, x, f"{path}.{i}", parent) for i, x in reversed(list(enumerate(node))) if isinstance(x, (dict, list))]


def emit_objects(records: DataFrame, record_id: str = "record_id", payload: str = "payload", tags: Sequence[str] = tuple(LABEL_TABLES), root_key: str = "set_id") -> DataFrame:
    """`(record_id, kind, path, parent_path, payload)`, a row for each object of a tagged field.

    Null payloads and texts that are no JSON give no rows; nulls, strings and numbers in lists give
    none but count as positions; a tagged object without a list has position 0. Of a key repeated
    within an object the last value holds. Repeated records give their rows each. Only the two named
    columns are read, so extra columns cannot clash.
    """
    kind, wanted = records.schema[record_id].dataType, frozenset(tags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "kind", "path", "parent_path", "payload"]
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for rid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for row in visit(text, wanted, root_key):
                    for col, v in zip(out, (rid, *row)):
                        col.append(v)
                if len(out[0]) >= BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(out[0], b.schema.field(0).type), *[pa.array(x, pa.string()) for x in out[1:]]], names=names)
                    out = [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b.schema.field(0).type), *[pa.array(x, pa.string()) for x in out[1:]]], names=names)

    source = records.select(F.col(record_id).alias("record_id"), F.col(payload).alias("payload"))
    return source.mapInArrow(run, f"record_id {kind.simpleString()}, kind string, path string, parent_path string, payload string")


def flat_tables(objects: DataFrame, tables: Mapping[str, str] = LABEL_TABLES) -> dict[str, DataFrame]:
    """Of emitted objects, one typed table per tag: record_id, path, parent_path and its columns.

    Each table selects its tag, so objects should be a written table (see stored_tables): partitioned
    by tag, a table then reads its own rows only.
    """
    out = {}
    for tag, schema in tables.items():
        own = objects.where(F.col("kind") == tag)
        out[tag] = own.select("record_id", "path", "parent_path", F.from_json("payload", schema).alias("o")).select("record_id", "path", "parent_path", "o.*")
    return out


def write_tables(objects: DataFrame, path: str) -> None:
    """Writes emitted objects once, partitioned by tag."""
    objects.write.mode("overwrite").partitionBy("kind").parquet(path)


def stored_tables(objects: DataFrame, path: str, tables: Mapping[str, str] = LABEL_TABLES) -> dict[str, DataFrame]:
    """flat_tables() of the objects as written to `path`: one pass over the records for all tables."""
    write_tables(objects, path)
    return flat_tables(objects.sparkSession.read.schema(objects.schema).parquet(path), tables)
