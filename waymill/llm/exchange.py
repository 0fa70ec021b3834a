"""Texts in packed pieces that ask hash blocks of an index and get answers, without any key meeting in one task.

Rows travel as they come, in pieces of about ``PIECE_BYTES`` of text that are compressed whole, so a repeated
row, a null id or a source with a third of all rows fills pieces like any other. A piece sends each key once,
however often it has it, to the block of its hash; blocks are as many as pieces, so a block's share stays as
large as a piece's, and a key in a third of all rows reaches its block at most once a piece. A message holds at
least one key, so messages never outnumber the distinct keys of the pieces. Keys travel as differences of
ascending numbers, in full. Blocks answer in the order of the question, so answers carry no keys.

A piece is named by the task that packed it, so the rows must come in the same order if that task runs again,
as those of a written table do.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 8 << 20


def blocks_for(df: DataFrame, text_col: str, piece_bytes: int = PIECE_BYTES) -> int:
    """Blocks for these texts, from their bytes and, for many short ones, their rows."""
    size, rows = df.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)), F.count("*")).first()
    return max(1, math.ceil(size / piece_bytes), math.ceil(rows / 20_000))


def spread(df: DataFrame, key: str, count: int) -> DataFrame:
    """Rows dealt by a key to enough partitions for ``count`` different keys."""
    return df.repartition(max(count, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), key)


def packed(df: DataFrame, id_col: str, text_col: str, count: int, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """piece, rows: the ids and texts of all rows, so many bytes (or one long text) to a row. Consumers in one plan share this exchange."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, own, size = TaskContext.get().partitionId() << 32, [], 0

        def piece() -> pa.RecordBatch:
            table = pa.Table.from_batches(own).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table)
            return pa.RecordBatch.from_pydict({"piece": pa.array([name], pa.int64()), "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            start = 0
            while start < len(batch):
                before = int(ends[start - 1]) if start else 0
                end = min(len(batch), int(np.searchsorted(ends, before + piece_bytes - size)) + 1)
                own.append(batch.slice(start, end - start))
                size += int(ends[end - 1]) - before
                start = end
                if size >= piece_bytes:
                    yield piece()
                    name, own, size = name + 1, [], 0
        if own:
            yield piece()

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return spread(rows.mapInArrow(pack, "piece long, rows binary"), "piece", count)


def unpack(group: pd.DataFrame) -> pd.DataFrame:
    """id and text of the rows of one piece, in the order in which they were packed."""
    return pa.ipc.open_stream(group["rows"].iloc[0]).read_all().to_pandas(integer_object_nulls=True)


def block_of(keys: np.ndarray, count: int) -> np.ndarray:
    """Blocks by the high bits of the keys, so that they ascend with them."""
    return ((keys >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def by_block(keys: np.ndarray, count: int) -> Iterator[tuple[int, slice]]:
    """Each block's part of ascending keys."""
    blocks = block_of(keys, count)
    for block in np.unique(blocks).tolist():
        yield block, slice(int(np.searchsorted(blocks, block)), int(np.searchsorted(blocks, block, side="right")))


def pack_ints(values: np.ndarray) -> bytes:
    """Numbers from zero on, in as many bytes each as the largest needs."""
    values = np.ascontiguousarray(values).astype("<u8")
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_ints(packed_: bytes) -> np.ndarray:
    width, raw = packed_[0], np.frombuffer(packed_, dtype=np.uint8, offset=1)
    wide = np.zeros((len(raw) // width, 8), dtype=np.uint8)
    wide[:, :width] = raw.reshape(-1, width)
    return wide.view("<u8").ravel()


def pack_keys(ascending: np.ndarray) -> bytes:
    """Ascending 64-bit keys as the first and the differences: lossless, and short where keys lie close."""
    if not len(ascending):
        return b""
    return int(ascending[0]).to_bytes(8, "little") + pack_ints(np.diff(ascending))


def unpack_keys(packed_: bytes) -> np.ndarray:
    if not packed_:
        return np.zeros(0, dtype=np.uint64)
    first = np.array([int.from_bytes(packed_[:8], "little")], dtype=np.uint64)
    return np.cumsum(np.concatenate([first, unpack_ints(packed_[8:])]), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """Their number, one byte each, and in full those that need more, whose byte is 255."""
    small = np.minimum(counts, 255).astype("u1")
    return len(counts).to_bytes(8, "little") + small.tobytes() + counts[small == 255].astype("<i8").tobytes()


def unpack_counts(packed_: bytes) -> np.ndarray:
    end = 8 + int.from_bytes(packed_[:8], "little")
    counts = np.frombuffer(packed_[8:end], dtype="u1").astype(np.int64)
    counts[counts == 255] = np.frombuffer(packed_[end:], dtype="<i8")
    return counts


def pack_flags(flags: np.ndarray) -> bytes:
    return len(flags).to_bytes(8, "little") + np.packbits(flags).tobytes()


def unpack_flags(packed_: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed_, dtype=np.uint8, offset=8), count=int.from_bytes(packed_[:8], "little")).astype(bool)


def in_order(answers: pd.DataFrame, column: str, unpack_: Callable[[bytes], np.ndarray], kind: type) -> np.ndarray:
    """All answers to a piece, by block: one for each of its ascending keys."""
    return np.concatenate([np.zeros(0, dtype=kind), *map(unpack_, answers.sort_values("block")[column])])


def met(keys: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys of several questions, and where those of each question are among them."""
    distinct, place = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *keys]), return_inverse=True)
    return distinct, np.split(place, np.cumsum([len(k) for k in keys])[:-1])


def ask(pieces: DataFrame, questions: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """The packed questions of every piece to the blocks."""
    return pieces.groupBy("piece").applyInPandas(questions, schema)


def answer(asked: DataFrame, count: int, answers: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """What each block answers, one row for each question."""
    return spread(asked, "block", count).groupBy("block").applyInPandas(answers, schema)


def receive(pieces: DataFrame, answered: DataFrame, use: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Each piece's rows with all answers to it."""
    return pieces.groupBy("piece").cogroup(answered.groupBy("piece")).applyInPandas(use, schema)
