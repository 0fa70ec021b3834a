"""Lines that many documents share, kept in one of them: a keep bitmap for each document.

A line's key is stripped of white space at both ends, its A-Z lower-cased. Long enough keys travel as 128-bit
digests with document and place, no text. These rows are dealt by ranges of (digest, document, place), so a line
that a third of all documents hold spreads over as many tasks as its rows fill, and sorted within each. A task
then streams its rows: the first document of a digest, the largest id, keeps its lines, all later ones lose theirs once there
are enough documents. Only the digests at a task's two ends may go on elsewhere; a task tells how many documents it has
seen of these, two rows a task, and rows that hang on it wait for the sum over its neighbours.

A document's dropped places become one compressed bitmap. Texts meet only their bitmaps, in the end.

Rows of one id are one document: they share what they keep, repeated rows as well as unlike texts. A null id is
smaller than any other. Null and empty texts have one empty line.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from waymill.llm.common import fresh, nothing_if_null, written

SPACE = b" \t\n\x0b\x0c\r"
#: Line rows of a range, and of an Arrow batch that a task returns.
RANGE_ROWS, BATCH_ROWS = 1 << 20, 1 << 16


def key_of(line: bytes) -> bytes:
    return line.strip(SPACE).lower()  # of bytes, lower() changes A-Z alone


def long_enough(key: bytes, least: int) -> bool:
    """Whether the key has so many code points."""
    return len(key) >= least and (len(key) >= 4 * least or key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= least)


def _marked(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, text, mark: the mark tells unlike texts of one id apart."""
    text = nothing_if_null(F.col(text_col))
    return df.select(F.col(id_col).alias("doc"), text.alias("text"), F.xxhash64(text).alias("mark"))


def line_keys(df: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """h1, h2 (the digest), doc, mark, pos of every line whose key is long enough."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            places: list[int] = []
            hashed: list[bytes] = []

            def flushed() -> pa.RecordBatch:
                pair = np.frombuffer(b"".join(hashed), dtype="<i8").reshape(-1, 2)
                own = batch.select(["doc", "mark"]).take(pa.array(rows, pa.int64()))
                out = pa.RecordBatch.from_pydict({"h1": pa.array(pair[:, 0].copy()), "h2": pa.array(pair[:, 1].copy()), "doc": own.column(0), "mark": own.column(1), "pos": pa.array(places, pa.int32())})
                rows.clear(), places.clear(), hashed.clear()
                return out

            for row, text in enumerate(batch.column("text")):
                for place, line in enumerate(text.as_buffer().to_pybytes().split(b"\n")):
                    if len(line) >= least and long_enough(key := key_of(line), least):
                        rows.append(row), places.append(place), hashed.append(hashlib.blake2b(key, digest_size=16).digest())
                        if len(rows) >= BATCH_ROWS:
                            yield flushed()
            if rows:
                yield flushed()

    marked = _marked(df, id_col, text_col)
    return marked.mapInArrow(digests, f"h1 bigint, h2 bigint, doc {dict(marked.dtypes)['doc']}, mark bigint, pos int")


def _unlike_before(column: pa.Array, before: Any) -> np.ndarray:
    """Whether each value differs from the one before it, the first from ``before``; nulls are alike."""
    shifted = pa.concat_arrays([pa.array([before], column.type), column.slice(0, len(column) - 1)])
    both_null = pc.and_(column.is_null(), shifted.is_null())
    return ~pc.or_(both_null, pc.fill_null(pc.equal(column, shifted), False)).to_numpy(zero_copy_only=False)


class _Stream:
    """One task's sorted rows, batch by batch: rows that lose their line, rows that may (with ``run``), and what was seen of its first and last digest (with ``docs``)."""

    def __init__(self, enough: int, part: int) -> None:
        self.enough, self.part = enough, part
        self.key: tuple[int, int] | None = None  # the digest that the rows so far end in
        self.first = True  # whether it is the task's first
        self.docs, self.top, self.last = 0, None, None  # its documents so far, the first and the last one
        self.held: list[pa.RecordBatch] = []  # rows of its second document while there are not enough

    def out(self, rows: pa.RecordBatch, run: int | None = None) -> pa.RecordBatch:
        kind, n = rows.column("doc").type, len(rows)
        ends = {"docs": pa.int32(), "h1": pa.int64(), "h2": pa.int64(), "top": kind, "last": kind}
        own = {c: rows.column(c) for c in ("doc", "mark", "pos")}
        return pa.RecordBatch.from_pydict(own | {"run": pa.array([run] * n, pa.int64())} | {c: pa.nulls(n, t) for c, t in ends.items()})

    def seen(self, kind: pa.DataType) -> pa.RecordBatch:
        none = {"doc": (None, kind), "mark": (None, pa.int64()), "pos": (None, pa.int32())}
        own = {"run": (2 * self.part + (not self.first), pa.int64()), "docs": (min(self.docs, self.enough), pa.int32()), "h1": (self.key[0], pa.int64()), "h2": (self.key[1], pa.int64()), "top": (self.top, kind), "last": (self.last, kind)}
        return pa.RecordBatch.from_pydict({c: pa.array([v], t) for c, (v, t) in (none | own).items()})

    def ordinals(self, rows: pa.RecordBatch, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Running numbers of documents, and which rows repeat the one before."""
        new = starts | _unlike_before(rows.column("doc"), self.last)
        same = ~new & ~_unlike_before(rows.column("mark"), None) & ~_unlike_before(rows.column("pos"), None)
        return np.cumsum(new), same

    def begin(self, rows: pa.RecordBatch) -> None:
        self.first = self.key is None
        self.key = (rows.column("h1")[0].as_py(), rows.column("h2")[0].as_py())
        self.docs, self.top, self.last, self.held = 0, rows.column("doc")[0].as_py(), None, []

    def go_on(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Rows of the digest that the task is at."""
        starts = np.zeros(len(rows), dtype=bool)
        starts[0] = not self.docs
        count, same = self.ordinals(rows, starts)
        count = count + self.docs
        self.docs, self.last = int(count[-1]), rows.column("doc")[len(rows) - 1].as_py()
        if self.first:  # its largest document may be in a task before
            yield self.out(rows.filter(pa.array(~same)), 2 * self.part)
            return
        self.held.append(rows.filter(pa.array(~same & (count >= 2))))
        if self.docs >= self.enough:
            yield from map(self.out, self.held)
            self.held = []

    def whole(self, rows: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        """Rows of digests that begin and end among them."""
        count, same = self.ordinals(rows, starts)
        firsts, run = np.flatnonzero(starts), np.cumsum(starts) - 1
        count = count - (count[firsts] - 1)[run]
        total = count[np.append(firsts[1:], len(rows)) - 1]
        return self.out(rows.filter(pa.array(~same & (count >= 2) & (total[run] >= self.enough))))

    def feed(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
        starts = np.concatenate([[self.key != (int(h1[0]), int(h2[0]))], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        firsts = np.flatnonzero(starts).tolist()
        if firsts[:1] != [0]:
            yield from self.go_on(batch.slice(0, firsts[0] if firsts else len(batch)))
        if firsts and self.key is None:
            self.begin(batch)
            yield from self.go_on(batch.slice(0, firsts[1] if firsts[1:] else len(batch)))
            firsts = firsts[1:]
        if firsts:
            if self.first:
                yield self.seen(batch.column("doc").type)
            begin, end = firsts[0], firsts[-1]
            if end > begin:
                yield self.whole(batch.slice(begin, end - begin), starts[begin:end])
            self.begin(batch.slice(end))
            yield from self.go_on(batch.slice(end))


def _streamed(enough: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, kind = _Stream(enough, TaskContext.get().partitionId()), None
        for batch in batches:
            if len(batch):
                kind = batch.column("doc").type
                yield from (rows for rows in task.feed(batch) if len(rows))
        if kind is not None:
            yield from (task.out(rows, 2 * task.part + 1) for rows in task.held if len(rows))
            yield task.seen(kind)

    return run


def decided(ends: list[Any], enough: int) -> list[tuple[int, Any]]:
    """(run, top): runs whose waiting rows lose their line unless their document is ``top``. ``ends``: what tasks saw, a few numbers for each task."""
    out: list[tuple[int, Any]] = []
    same: list[Any] = []

    def close() -> None:
        docs = sum(r.docs for r in same) - sum(a.last == b.top for a, b in zip(same, same[1:]))
        if docs >= enough:
            out.extend((r.run, same[0].top) for r in same)

    for r in sorted(ends, key=lambda r: r.run):
        if same and (same[-1].h1, same[-1].h2) != (r.h1, r.h2):
            close()
            same = []
        same.append(r)
    if same:
        close()
    return out


def dropped_lines(df: DataFrame, id_col: str, text_col: str, least: int = 20, enough: int = 3) -> DataFrame:
    """doc, mark, pos of every line that goes: its key has at least ``least`` code points, ``enough`` documents hold it, this is not the largest."""
    keys = written(line_keys(df, id_col, text_col, least))
    count = keys.count()
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(count / RANGE_ROWS))
    order = ["h1", "h2", F.col("doc").desc_nulls_last(), "mark", "pos"]
    dealt = keys.repartitionByRange(ranges, *order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    kind = dict(keys.dtypes)["doc"]
    schema = f"doc {kind}, mark bigint, pos int, run bigint, docs int, h1 bigint, h2 bigint, top {kind}, last {kind}"
    found = written(dealt.mapInArrow(_streamed(enough), schema))
    lost = decided(found.where("docs IS NOT NULL").select("run", "docs", "h1", "h2", "top", "last").collect(), enough)
    table = F.broadcast(df.sparkSession.createDataFrame(lost, f"run bigint, only {kind}"))
    rows = found.where("docs IS NULL")
    waiting = rows.where("run IS NOT NULL").select("run", "doc", "mark", "pos").join(table, "run").where(~F.col("doc").eqNullSafe(F.col("only")))
    return rows.where("run IS NULL").select("doc", "mark", "pos").unionByName(waiting.select("doc", "mark", "pos"))


@F.pandas_udf(BinaryType())
def keep_bitmap(dropped: pd.Series) -> pd.Series:
    """Bit k, from the lowest of the first byte on, tells whether line k stays; lines beyond the bitmap stay. Compressed by zlib."""

    def one(places: np.ndarray) -> bytes:
        keep = np.ones((int(places.max()) // 8 + 1) * 8, dtype=np.uint8)
        keep[places] = 0
        return zlib.compress(np.packbits(keep, bitorder="little").tobytes())

    return dropped.map(lambda x: one(np.asarray(x)))


@F.pandas_udf(StringType())
def kept_text(text: pd.Series, keep: pd.Series) -> pd.Series:
    def one(t: str | None, packed: bytes | None) -> str | None:
        if t is None or packed is None:
            return t
        lines = t.split("\n")
        bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), dtype=np.uint8), bitorder="little")
        return "\n".join([line for k, line in enumerate(lines) if k >= len(bits) or bits[k]])

    return pd.Series([one(t, k) for t, k in zip(text, keep)], dtype=object)


def keep_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 20, enough: int = 3) -> DataFrame:
    """doc, mark (xxhash64 of the text), n_dropped, keep: a bitmap for each document that loses lines."""
    places = dropped_lines(df, id_col, text_col, least, enough).groupBy("doc", "mark").agg(F.collect_set("pos").alias("places"))
    return places.select("doc", "mark", F.size("places").cast("long").alias("n_dropped"), keep_bitmap("places").alias("keep"))


def without_repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 20, enough: int = 3) -> DataFrame:
    """All rows and columns with the lines that stay, plus n_lines and n_dropped; a null text stays null if nothing goes.

    Names of its own are fresh; an input column n_lines or n_dropped is replaced.
    """
    doc, mark, gone, keep = (fresh(c) for c in ("doc", "mark", "n", "keep"))
    maps = keep_bitmaps(df, id_col, text_col, least, enough).toDF(doc, mark, gone, keep)
    text = nothing_if_null(F.col(text_col))
    rows = df.withColumn(mark + "_", F.xxhash64(text))
    met = rows.join(maps.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(mark + "_") == F.col(mark)), "left")
    changed = kept_text(F.when(F.col(keep).isNotNull(), F.col(text_col)), keep)
    lines = (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    return met.withColumns({"n_lines": lines, "n_dropped": F.coalesce(gone, F.lit(0)).cast("long")}).withColumn(text_col, F.when(F.col(keep).isNull(), F.col(text_col)).otherwise(changed)).drop(doc, mark, mark + "_", gone, keep)


def line_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 20, enough: int = 3) -> DataFrame:
    """Per row: id, n_lines (before), n_dropped, kept_sha256 (lowercase hex of the kept lines joined by line feeds)."""
    out = without_repeated_lines(df.select(id_col, text_col), id_col, text_col, least, enough)
    return out.select(id_col, "n_lines", "n_dropped", F.sha2(nothing_if_null(F.col(text_col)), 256).alias("kept_sha256"))
