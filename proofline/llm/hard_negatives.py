"""Hard negatives of anchors: the best scored rows of other labels inside a margin below each positive.

Vectors are scored by the method of the Four Russians.  A vector's components are whole numbers, written in two's complement as
bit planes; the bits of a plane are packed into one byte for every eight dimensions.  For every eight dimensions of an
anchor a table holds the sums of all 256 subsets of its components.  A plane's part of the inner product is the sum of the
entries that the bytes point at; planes are added from the sign down, doubling what there is before each.
The sums are exact; a score that does not fit a long raises an error.

All anchors meet all rows in blocks.  Rows are dealt by hash into chunks and anchors into blocks of about ``BLOCK``; a task gets one
chunk and one block, so it holds a bounded number of vectors whatever the sizes of both tables and of labels,
and no vector passes through the driver.  Each block and chunk meet twice: the first time rows of the anchor's label are
scored and the best few leave the task as positives, the second time those of other labels, of which the best few in each
positive's range leave.  What leaves is ranked per anchor, or anchor and positive, by a window.

Rows with a null id, label or vector, or a null or non-finite component take no part.  A shorter vector counts as filled up
with zeros.  Rows equal in id, label and whole numbers are one row.  Of different rows under one anchor's id the least
by label, then numbers, is the anchor; rows of the anchor's own id are neither its positives nor its negatives.  Equal
scores are ordered by id.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from proofline.llm.arrays import spans
from proofline.llm.staging import stage

GROUP = 8
SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# A negative's score lies between these hundredths of its positive's.
MARGIN = (30, 90)
# Anchors of a block; rows of a chunk at least and at most.  Rows travel once per block and anchors once per chunk, so large
# ones keep the shuffle far below the scoring.
BLOCK = 16_384
CHUNK = (1024, 65_536)
# Rows and anchors that are scored at once.
SCORED_ROWS = 1024
SCORED_ANCHORS = 64
# Components beyond this are refused before they are made whole numbers.
LARGEST = 2.0**46

PLANES = "vec_id long, label long, planes int, codes binary"
FOUND = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def bit_planes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Planes that each row of whole numbers needs, and its bytes of all 64 planes from the sign down, by eight dimensions."""
    rows, dims = numbers.shape
    groups = -(-dims // GROUP)
    spread = np.where(numbers < 0, ~numbers, numbers).max(axis=1, initial=0)
    needed = np.frexp(spread.astype(np.float64))[1] + 1
    padded = np.zeros((rows, groups * GROUP), np.int64)
    padded[:, :dims] = numbers
    bits = padded[:, None, :] >> np.arange(int(needed.max(initial=1)) - 1, -1, -1)[:, None] & 1
    return needed, np.packbits(bits.astype(np.uint8), axis=2)


def coded(vectors: DataFrame, id_column: str, label_column: str, vector_column: str) -> DataFrame:
    """``PLANES`` of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = lists.value_lengths().to_numpy()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            bad = ~np.isfinite(flat)
            row = np.repeat(np.arange(len(sizes)), sizes)
            good = np.bincount(row, bad, len(sizes)) == 0
            ends = np.cumsum(sizes)
            for size in np.unique(sizes[good]).tolist():
                chosen = np.flatnonzero(good & (sizes == size))
                values = flat[spans(ends[chosen] - size, sizes[chosen])].reshape(len(chosen), size) * SCALE
                if (np.abs(values) > LARGEST).any():
                    raise ValueError("a component is too large for exact scores")
                needed, planes = bit_planes(np.floor(values).astype(np.int64))
                most = planes.shape[1]
                codes = [planes[i, most - n :].tobytes() for i, n in enumerate(needed.tolist())]
                picked = pa.array(chosen)
                arrays = [batch.column(0).take(picked), batch.column(1).take(picked), pa.array(needed, pa.int32()), pa.array(codes, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "planes", "codes"])

    chosen = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("long").alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    return chosen.dropna().mapInArrow(run, PLANES)


def unpacked(planes: np.ndarray, codes: list[bytes]) -> np.ndarray:
    """Bytes by row, plane and group; all rows with as many planes and groups as the most any of them has."""
    most = int(planes.max(initial=1))
    sizes = np.array([len(c) for c in codes]) // planes
    result = np.zeros((len(codes), most, int(sizes.max(initial=0))), np.uint8)
    for count in np.unique(planes).tolist():
        for size in np.unique(sizes[planes == count]).tolist():
            rows = np.flatnonzero((planes == count) & (sizes == size))
            own = np.frombuffer(b"".join([codes[i] for i in rows.tolist()]), np.uint8).reshape(len(rows), count, size)
            result[rows, most - count :, :size] = own
            # A number's sign goes on in all planes above.
            result[rows, : most - count, :size] = own[:, :1, :]
    return result


def numbers_of(codes: np.ndarray) -> np.ndarray:
    """The whole numbers of rows of bytes by plane and group."""
    rows, planes, groups = codes.shape
    numbers = np.zeros((rows, groups * GROUP), np.int64)
    for plane in range(planes):
        numbers = 2 * numbers + np.unpackbits(codes[:, plane], axis=1)
        if not plane:
            numbers = -numbers
    return numbers


class Tables:
    """Sums of all subsets of every eight components of the anchors."""

    def __init__(self, anchors: np.ndarray, largest: int) -> None:
        rows, dims = anchors.shape
        bound = int(np.abs(anchors).sum(axis=1).max(initial=0)) * largest
        if bound >= 1 << 62:
            raise ValueError("a score may not fit a long")
        kind = np.int32 if bound < 1 << 30 else np.int64
        parts = anchors.reshape(rows, dims // GROUP, GROUP).transpose(1, 2, 0)
        self.sums = np.zeros((dims // GROUP, 1 << GROUP, rows), kind)
        for bit in range(GROUP):
            # The first dimension is the highest bit of a byte.
            size = 1 << bit
            self.sums[:, size : 2 * size] = self.sums[:, :size] + parts[:, GROUP - 1 - bit, None, :].astype(kind)

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Inner products of rows (bytes by plane and group) with the anchors."""
        rows, planes, groups = codes.shape
        total = np.zeros((rows, self.sums.shape[2]), self.sums.dtype)
        for plane in range(planes):
            if plane:
                np.left_shift(total, 1, out=total)
            for group in range(min(groups, len(self.sums))):
                total += self.sums[group].take(codes[:, plane, group], axis=0)
            if not plane:
                np.negative(total, out=total)
        return total


class Block:
    """Anchors of one task, in order of their labels, with tables for ``SCORED_ANCHORS`` of them at a time."""

    def __init__(self, table: pa.Table) -> None:
        table = table.sort_by([("label", "ascending"), ("vec_id", "ascending")])
        self.ids, self.labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
        self.numbers = numbers_of(unpacked(table.column("planes").to_numpy(), table.column("codes").to_pylist()))
        self.table = table

    def parts(self, largest: int, same_label: bool) -> Iterator[tuple[slice, Tables]]:
        edges = np.flatnonzero(np.r_[True, self.labels[1:] != self.labels[:-1], True]) if same_label else np.array([0, len(self.ids)])
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            for at in range(begin, end, SCORED_ANCHORS):
                part = slice(at, min(at + SCORED_ANCHORS, end))
                yield part, Tables(self.numbers[part], largest)


def _chunk(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Ids, labels and bytes of a chunk's rows in order of their ids, and their largest possible component."""
    table = table.sort_by([("vec_id", "ascending"), ("label", "ascending")])
    ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
    codes = unpacked(table.column("planes").to_numpy(), table.column("codes").to_pylist())
    return ids, labels, codes, 1 << (codes.shape[1] - 1)


def _scored(tables: Tables, codes: np.ndarray) -> np.ndarray:
    """Scores by anchor and row."""
    parts = [tables.scores(codes[at : at + SCORED_ROWS]) for at in range(0, len(codes), SCORED_ROWS)]
    return np.concatenate(parts).T


def _best_first(scores: np.ndarray) -> np.ndarray:
    """For every anchor the rows by falling score; rows come in order of their ids, which decides between equal scores."""
    return np.argsort(-scores.astype(np.int64), axis=1, kind="stable")


def _positives(block: Block, chunk: tuple, count: int) -> Iterator[pa.RecordBatch]:
    ids, labels, codes, largest = chunk
    for part, tables in block.parts(largest, True):
        rows = np.flatnonzero(labels == block.labels[part.start])
        if not len(rows):
            continue
        scores = _scored(tables, codes[rows]).astype(np.int64)
        own = block.ids[part, None] == ids[rows]
        scores[own] = np.iinfo(np.int64).min + 1
        best = _best_first(scores)[:, : count + int(own.sum(axis=1).max())]
        anchor, place = np.nonzero(~np.take_along_axis(own, best, 1))
        row = best[anchor, place]
        arrays = [pa.array(block.ids[part][anchor]), pa.array(ids[rows][row]), pa.array(scores[anchor, row])]
        yield pa.RecordBatch.from_arrays(arrays, names=["anchor_id", "vec_id", "score"])


def _negatives(block: Block, chunk: tuple, count: int, margin: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    ids, labels, codes, largest = chunk
    positives = block.table.column("positives").to_pylist()
    least, most = margin
    for part, tables in block.parts(largest, False):
        scores = _scored(tables, codes)
        for at, anchor in enumerate(range(part.start, part.stop)):
            rows = np.flatnonzero((labels != block.labels[anchor]) & (ids != block.ids[anchor]))
            own = scores[at, rows].astype(np.int64)
            listed = [(p["vec_id"], p["score"]) for p in positives[anchor]]
            # Whole numbers at both ends of the margin.
            ranges = [(-(-least * s // 100), most * s // 100) for _, s in listed]
            inside = np.flatnonzero((own >= min(r[0] for r in ranges)) & (own <= max(r[1] for r in ranges)))
            rows, own = rows[inside], own[inside]
            order = np.argsort(-own, kind="stable")
            rows, falling = rows[order], -own[order]
            found = []
            for low, high in ranges:
                first = int(np.searchsorted(falling, -high, "left"))
                after = int(np.searchsorted(falling, -low, "right"))
                found.append(np.arange(first, max(first, min(first + count, after))))
            counts = [len(f) for f in found]
            chosen = np.concatenate(found)
            arrays = [
                pa.array(np.full(len(chosen), block.ids[anchor])),
                pa.array(np.repeat(np.array([i for i, _ in listed], np.int64), counts)),
                pa.array(np.repeat(np.array([s for _, s in listed], np.int64), counts)),
                pa.array(ids[rows[chosen]]),
                pa.array(-falling[chosen]),
            ]
            if len(chosen):
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in FOUND.split(", ")])


def _met(rows: DataFrame, anchors: DataFrame, chunks: int, blocks: int, score, fields: str) -> DataFrame:
    """Every chunk of rows with every block of anchors, each in a task of its own."""
    kind = pa.schema([(f.split()[0], pa.int64()) for f in fields.split(", ")])
    dealt = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    spread = anchors.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return kind.empty_table()
        found = list(score(Block(right), _chunk(left)))
        return pa.Table.from_batches(found, kind) if found else kind.empty_table()

    return dealt.groupBy("chunk", "block").cogroup(spread.groupBy("chunk", "block")).applyInArrow(run, fields)


def _first(frame: DataFrame, keys: list[str], order: list[Column], count: int) -> DataFrame:
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return frame.withColumn("rank", ranked).filter(F.col("rank") <= count)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    margin: tuple[int, int] = MARGIN,
    block_rows: int = BLOCK,
) -> DataFrame:
    """``FOUND`` and ``rank`` from 1: the negatives of every anchor and positive.  ``is_anchor`` is a condition on ``vec_id``."""
    spark = vectors.sparkSession
    known = stage(coded(vectors, id_column, label_column, vector_column).distinct(), "vectors")
    sizes = known.agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_anchor).alias("anchors")).first()
    # The plan alone depends on these: enough chunks for all tasks, none too large.
    wanted = -(-sizes["rows"] // (4 * spark.sparkContext.defaultParallelism))
    chunks = max(1, -(-sizes["rows"] // min(max(wanted, CHUNK[0]), CHUNK[1])))
    blocks = max(1, -(-sizes["anchors"] // block_rows))
    rows = known.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "label", "codes"), F.lit(chunks)).cast("int"))
    chosen = known.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "planes", "codes")).alias("a"))
    anchors = stage(
        chosen.select("vec_id", "a.*", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")), "anchors"
    )
    near = _met(rows, anchors, chunks, blocks, lambda b, c: _positives(b, c, n_positives), "anchor_id long, vec_id long, score long")
    best = _first(near, ["anchor_id"], [F.desc("score"), F.asc("vec_id")], n_positives)
    listed = best.groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))
    ready = stage(anchors.join(listed, anchors["vec_id"] == listed["anchor_id"]).drop("anchor_id"), "positives")
    far = _met(rows, ready, chunks, blocks, lambda b, c: _negatives(b, c, n_negatives, margin), FOUND)
    order = [F.desc("negative_score"), F.asc("negative_id")]
    # Rows that repeat an anchor's positive under its id and score count once.
    return _first(far, ["anchor_id", "positive_id", "positive_score"], order, n_negatives)
