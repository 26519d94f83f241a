"""Line dedup (operator 8).

Hashes of line keys are dealt by range over (key, document descending) and sorted inside each partition, so a
streaming pass meets the largest document of a key first and keeps its lines; documents after it lose theirs once
the key is known to stand in enough documents. A key of very many documents may span partitions: each partition
reports its first and last run (one row a partition), and the totals of those runs go with the second pass.
The result is a zlib-compressed bitmap of kept lines for each document, not text.

Defined cases: null or empty text is one empty line; rows without an id are kept whole and not counted; rows that
repeat an id count as one document, and each row has its own bitmap; a text of any length is cut up whole; an empty
table gives no rows; extra columns are carried if asked for, but for those named like the columns added.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.llm import text as tx
from loomline.session import cut

MIN_CHARS, MIN_DOCS = 20, 3
ADDED = ("n_lines", "n_dropped", "keep_bitmap")


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """The stripped line with A-Z lower-cased, or None if it has too few code points to count."""
    key = line.strip(tx.SPACE)
    return key.encode().lower() if len(key) >= min_chars else None


def _emit(min_chars: int):
    def run(batches):
        for b in tx.each(batches):
            keys, docs, rows, at = [], [], [], []
            for doc, row, text in zip(b["_doc"].to_pylist(), b["_row"].to_pylist(), b["_text"].to_pylist(), strict=True):
                for i, line in enumerate(text.split("\n")):
                    if key := line_key(line, min_chars):
                        keys.append(xxhash.xxh3_128_digest(key))
                        docs.append(doc)
                        rows.append(row)
                        at.append(i)
            halves = np.frombuffer(b"".join(keys), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(docs, pa.int64()), pa.array(rows, pa.int64()), pa.array(at, pa.int32())], ["hi", "lo", "doc", "row", "at"])

    return run


def _runs(batches) -> Iterator[tuple[tuple, int, int, int]]:
    """(key, doc, row, position) in sorted order."""
    for b in tx.each(batches):
        hi, lo, doc, row, at = (b[c].to_pylist() for c in ("hi", "lo", "doc", "row", "at"))
        yield from zip(zip(hi, lo, strict=True), doc, row, at, strict=True)


def _edges(batches):
    """One row a partition: the keys and document counts of its first and last run."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    first, last, many, doc_of, head = None, None, 0, None, 0
    for key, doc, _, _ in _runs(batches):
        if key != last:
            if first is None:
                first = key
            elif last == first:
                head = many
            last, many, doc_of = key, 0, None
        if doc != doc_of:
            many, doc_of = many + 1, doc
    if first is not None:
        if last == first:
            head = many
        yield pa.RecordBatch.from_pylist([{"part": part, "hi1": first[0], "lo1": first[1], "n1": head, "hi2": last[0], "lo2": last[1], "n2": many if last != first else 0}])


def _drops(totals: dict, starts: dict, min_docs: int):
    """totals: documents of the keys on partitions' edges; starts: the partition where each such key begins."""

    def run(batches):
        from pyspark import TaskContext

        part, out = TaskContext.get().partitionId(), ([], [], [])

        def rows():
            last, seen, doc_of, held = None, 0, None, []
            for key, doc, row, at in _runs(batches):
                if key != last:
                    last, seen, doc_of, held = key, 0, None, []
                    if key in totals:  # known in whole from the edges
                        seen = 0 if starts[key] == part else 1
                        known = totals[key]
                    else:
                        known = None
                if doc != doc_of:
                    seen, doc_of = seen + 1, doc
                if seen == 1:
                    continue
                if known is not None:
                    if known >= min_docs:
                        yield doc, row, at
                elif seen >= min_docs:
                    yield from held
                    held = []
                    yield doc, row, at
                else:
                    held.append((doc, row, at))

        for x in rows():
            for column, value in zip(out, x, strict=True):
                column.append(value)
            if len(out[0]) >= 1 << 16:
                yield _dropped(out)
                out = ([], [], [])
        if out[0]:
            yield _dropped(out)

    return run


def _dropped(out):
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32())], ["_doc", "_row", "_at"])


def keep_bitmap(keep: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(keep).tobytes())


def apply_bitmap(text: str | None, bitmap: bytes) -> str:
    lines = (text or "").split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    return "\n".join(x for x, k in zip(lines, keep.tolist(), strict=True) if k)


def _bitmaps(with_text: bool):
    def run(batches):
        for b in tx.each(batches):
            lines, dropped, maps = [], [], []
            for text, drops in zip(b["_text"].to_pylist(), b["_drops"].to_pylist(), strict=True):
                keep = np.ones(text.count("\n") + 1 if text else 1, bool)
                if drops:
                    keep[drops] = False
                lines.append(len(keep))
                dropped.append(int(len(keep) - keep.sum()))
                maps.append(keep_bitmap(keep))
            rest = [(n, c) for n, c in zip(b.schema.names, b.columns, strict=True) if n != "_drops" and (with_text or n != "_text")]
            yield pa.RecordBatch.from_arrays([c for _, c in rest] + [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())], [n for n, _ in rest] + list(ADDED))

    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, carry: list[str] | None = None, apply: bool = False) -> DataFrame:
    """carry (default: the id) and n_lines, n_dropped, keep_bitmap for each row of docs.

    With apply the bitmaps are applied to a carried text where they are made, and not returned: the rows of
    apply_keep_bitmaps, with one Python worker a task instead of two, each of which would hold its memory on.
    """
    carry = [c for c in (carry or [id_col]) if c not in ADDED]
    doc, row = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))
    lines = docs.where(doc.isNotNull() & (F.length(text_col) >= min_chars)).select(doc.alias("_doc"), row.alias("_row"), F.col(text_col).alias("_text")).mapInArrow(_emit(min_chars), "hi long, lo long, doc long, row long, at int")
    order = ["hi", "lo", F.desc("doc")]
    dealt = cut(lines.repartitionByRange(*order).sortWithinPartitions(*order, "row", "at"))
    totals, starts = {}, {}
    for e in sorted(dealt.mapInArrow(_edges, "part long, hi1 long, lo1 long, n1 long, hi2 long, lo2 long, n2 long").collect()):
        for key, n in (((e.hi1, e.lo1), e.n1), ((e.hi2, e.lo2), e.n2)):
            totals[key] = totals.get(key, 0) + n
            starts.setdefault(key, e.part)
    drops = dealt.mapInArrow(_drops(totals, starts, min_docs), "_doc long, _row long, _at int").groupBy("_doc", "_row").agg(F.sort_array(F.collect_set("_at")).alias("_drops"))
    kept = [c for c in carry if c != text_col]
    with_text = text_col in carry
    base = docs.select(doc.alias("_doc"), row.alias("_row"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)])
    joined = base.join(drops, ["_doc", "_row"], "left").select(*[f"c{i}" for i in range(len(kept))], "_text", "_drops")
    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(kept)])
    schema = schema.add("_text", "string") if with_text else schema
    schema = schema.add("n_lines", "long").add("n_dropped", "long")
    apply = apply and with_text
    out = joined.mapInArrow(_applied, schema) if apply else joined.mapInArrow(_bitmaps(with_text), schema.add("keep_bitmap", "binary"))
    place = {c: f"c{i}" for i, c in enumerate(kept)} | {text_col: "_text"}
    return out.select(*[F.col(place[c]).alias(c) for c in carry], *[c for c in ADDED if c in out.columns])


def _apply(text_col: str):
    def run(batches):
        for b in tx.each(batches):
            i, j = b.schema.get_field_index(text_col), b.schema.get_field_index("keep_bitmap")
            done = [apply_bitmap(t, k) for t, k in zip(b.column(i).to_pylist(), b.column(j).to_pylist(), strict=True)]
            cols = [pa.array(done, pa.string()) if k == i else c for k, c in enumerate(b.columns) if k != j]
            yield pa.RecordBatch.from_arrays(cols, [n for k, n in enumerate(b.schema.names) if k != j])

    return run


def _applied(batches):
    """Texts cut down by bitmaps made in the same worker."""
    return _apply("_text")(_bitmaps(True)(batches))


def apply_keep_bitmaps(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with its texts cut down to the kept lines, and without the bitmaps. No line left: the empty text."""
    rest = df.drop("keep_bitmap").schema
    return df.mapInArrow(_apply(text_col), rest)
