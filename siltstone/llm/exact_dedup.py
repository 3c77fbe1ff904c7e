"""Exact dedup by Grace hashing with complete content comparison.

Each task keeps an open-addressing table of the distinct contents it has seen. Once the table holds
its limit of bytes, contents that it does not hold go to spill files chosen by hash bits, and each
file is then treated in the same way with the next bits, until it fits. A first round runs inside
the input partitions, so that a content reaches the exchange at most once per input partition
however many copies it has; the second round runs where contents of one hash meet.

Defined cases: null text is the empty text; white space runs are one space (not trimmed), so an
empty text and a text of spaces differ; of repeated rows (same id, same text) exactly one is kept; a
null id sorts after all others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare, table

#: Bytes that a table may hold before it spills, spill files per level, levels; bytes that Python needs besides for a content and for a member.
LIMIT_BYTES, FANOUT, MAX_DEPTH, CONTENT_BYTES, MEMBER_BYTES = 96 << 20, 16, 8, 200, 64
NO_ID = (1 << 63) - 1

_SPACES = b" \t\n\x0b\x0c\r"


def normalize(text: str | None) -> bytes:
    """UTF-8 of the text with each run of white space as one space."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = b" ".join(raw.split())
    if not words:
        return b" " if raw else b""
    return (b" " if raw[0] in _SPACES else b"") + words + (b" " if raw[-1] in _SPACES else b"")


class OpenTable:
    """Open addressing with linear probing: 64-bit hashes in the slots, whole contents compared."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = np.full(slots, -1, np.int64).tolist()
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, h: int, content: bytes, add: bool) -> int:
        """The number of the content's group; -1 if it is absent and not added."""
        mask, slots = len(self.slots) - 1, self.slots
        at = h & mask
        while (g := slots[at]) >= 0:
            if self.hashes[g] == h and self.contents[g] == content:
                return g
            at = (at + 1) & mask
        if not add:
            return -1
        slots[at] = g = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + CONTENT_BYTES
        if 2 * len(self.hashes) > len(slots):
            self._grow()
        return g

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        slots = [-1] * (mask + 1)
        for g, h in enumerate(self.hashes):
            at = h & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = g
        self.slots = slots


def grace_groups(records, limit: int = LIMIT_BYTES, fanout: int = FANOUT, depth: int = 0) -> Iterator[tuple[bytes, list]]:
    """(content, its payloads) for each distinct content of records, (content, payload) pairs in any order."""
    open_table, members, files, folder = OpenTable(), [], [], None
    try:
        for content, payload in records:
            h = xxhash.xxh64_intdigest(content, seed=depth)
            g = open_table.find(h, content, add=open_table.bytes < limit or depth >= MAX_DEPTH)
            if g < 0:
                if folder is None:
                    folder = tempfile.mkdtemp(prefix="grace-")
                    files = [open(os.path.join(folder, str(k)), "wb") for k in range(fanout)]  # noqa: SIM115
                blob = payload if isinstance(payload, bytes) else bytes(payload)
                files[(h >> 40) % fanout].write(struct.pack("<QQ", len(content), len(blob)) + content + blob)
                continue
            open_table.bytes += len(payload) + MEMBER_BYTES
            if g == len(members):
                members.append([payload])
            else:
                members[g].append(payload)
        yield from zip(open_table.contents, members, strict=True)
        del open_table, members
        for f in files:
            f.close()
        for f in files:
            if os.path.getsize(f.name):
                yield from grace_groups(_spilled(f.name), limit, fanout, depth + 1)
            os.remove(f.name)
    finally:
        for f in files:
            f.close()
        if folder is not None:
            shutil.rmtree(folder, ignore_errors=True)


def _spilled(path: str) -> Iterator[tuple[bytes, bytes]]:
    with open(path, "rb") as f:
        while head := f.read(16):
            n, m = struct.unpack("<QQ", head)
            yield f.read(n), f.read(m)


_LOCAL = "doc_id long, rk long, first boolean, size long, h binary, text binary"


def _local_round(limit: int):
    """Per input partition: a row for each document, and one with the content for each group."""

    def records(batches):
        at = 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield normalize(t), struct.pack("<qq", NO_ID if i is None else i, at * 2 + (i is None))
                at += 1

    def run(batches):
        base, k = TaskContext.get().partitionId() << 36, 0
        out = _Rows(_LOCAL_SCHEMA)
        for content, payloads in grace_groups(records(batches), limit):
            k += 1
            rows = sorted(struct.unpack("<qq", p) for p in payloads)
            for n, (i, at) in enumerate(rows):
                yield from out.add((None if at & 1 else i, base + k, n == 0, None, None, None))
            i, at = rows[0]
            yield from out.add((None if at & 1 else i, base + k, None, len(rows), xxhash.xxh3_128_digest(content), content), len(content))
        yield from out.rest()

    return run


_GLOBAL = "rk long, keep_rk long, keep_id long, group_size long, text_sha256 string"


def _global_round(limit: int):
    """Where all groups of one hash meet: groups of the same content, and the one that stays."""

    def records(batches):
        for b in batches:
            for i, rk, size, text in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True):
                yield text, struct.pack("<qqq?", NO_ID if i is None else i, rk, size, i is None)

    def run(batches):
        out = _Rows(_GLOBAL_SCHEMA)
        for content, payloads in grace_groups(records(batches), limit):
            rows = [struct.unpack("<qqq?", p) for p in payloads]
            i, keep, _, none = min(rows, key=lambda r: (r[3], r[0], r[1]))
            size, sha = sum(r[2] for r in rows), hashlib.sha256(content).hexdigest()
            for r in rows:
                yield from out.add((r[1], keep, None if none else i, size, sha))
        yield from out.rest()

    return run


class _Rows:
    """Gathers rows to Arrow batches of bounded count and bytes."""

    def __init__(self, schema: pa.Schema, rows: int = 4096, size: int = 8 << 20):
        self.schema, self.most, self.size, self.rows, self.bytes = schema, rows, size, [], 0

    def add(self, row: tuple, size: int = 0):
        self.rows.append(row)
        self.bytes += size
        if len(self.rows) >= self.most or self.bytes >= self.size:
            yield from self.rest()

    def rest(self):
        if self.rows:
            cols = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, self.schema, strict=True)], schema=self.schema)
            self.rows, self.bytes = [], 0


_KINDS = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
_LOCAL_SCHEMA, _GLOBAL_SCHEMA = (pa.schema([(n, _KINDS[t]) for n, t in (c.split() for c in s.split(", "))]) for s in (_LOCAL, _GLOBAL))


def dedup_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    prepare(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    local = materialize(narrow.mapInArrow(_local_round(limit_bytes), _LOCAL), "dedup-local")
    groups = local.where("h is not null").repartition("h").select("doc_id", "rk", "size", "text")
    whole = groups.mapInArrow(_global_round(limit_bytes), _GLOBAL)
    rows = local.where("h is null").select("doc_id", "rk", "first")
    return rows.join(whole, "rk").select(
        "doc_id", "keep_id", "group_size", (F.col("first") & (F.col("rk") == F.col("keep_rk"))).alias("kept"), "text_sha256"
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; ids must be unique here."""
    keep = dedup_groups(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias(id_col))
    return docs.join(keep, id_col, "left_semi")


def op10(spark, sf_dir: str) -> DataFrame:
    return dedup_groups(table(spark, sf_dir, "documents"))


QUERIES = {"op10_exact_dedup": op10}
ORACLE_SQL = {
    "op10_exact_dedup": r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents),
g as (select *, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size from n)
select doc_id, keep_id, cast(group_size as bigint) as group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from g
"""
}
