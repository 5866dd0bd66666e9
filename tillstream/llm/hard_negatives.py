"""Hard negatives by Kronecker-packed products.

The vectors become integers, floor(scale * x). A work cell holds one stripe of anchors and some chunks of rows. In it,
the components of several rows are biased to be nonnegative and laid into separated fields of one wide integer, so one
multiplication by an anchor's component serves all of these rows; the sum over the components is unpacked field by
field into exact scores. The wide integers are those that a double holds exactly (53 bits), which lets numpy's matrix
product add them up; a field is as wide as the anchors' and rows' own bounds ask for. Where not even one field
fits, the products are taken in 64-bit integers, whose overflow cancels out because each score itself fits.

Spark deals out the work: rows are packed into chunks, anchors into stripes of bounded size, and cells are the pairs
of a stripe and a group of chunks, shuffled by hash; a label, a hot vector or an id decides nothing there, so none
can fill a task. A first round finds each anchor's positives (rows of its label only are multiplied), a second one the
negatives below them. Cells return the few best rows of each anchor and positive, merged at most FAN_IN at a time.
All anchors meet all rows: that is the job, and its cost is their product.

Defined results: rows without id or label, without a vector, or with a null or non-finite component take no part, nor do
vectors whose product with themselves is 2^62 or more, as their scores would not fit a long. A shorter vector counts as
if filled up with zeros, an empty one is all zeros. Ties go to the smaller id. Repeated rows count once: an anchor's
equal (score, id) pairs are one. Rows that share an id but not the vector are different rows and different anchors;
a row with the anchor's own id is never its positive. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.components import written
from tillstream.llm.words import ship_package
from tillstream.session import scratch_folder

SCALE = 256
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100  # per cent of the positive's score
CHUNK_ROWS = 1024
STRIPE_BYTES = 8 << 20  # of anchors, as 64-bit integers
CELL_BYTES = 32 << 20  # of rows, as 64-bit integers
BLOCK = 1024  # anchors, and at most twice as many rows, that are multiplied at once
FAN_IN = 32
EXACT_BITS = 53
MOST_NORM = 2.0**62
NONE = np.iinfo(np.int64).min

CHUNK = "key long, n int, dim int, ids binary, labels binary, parts binary"
BLOCKS = f"stripe int, block int, {CHUNK}"
TOPS = "stripe int, block int, part int, scores binary, ids binary"


# Packing rows


def integers(vectors: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Components as integers (rows x longest), and which rows can be used."""
    sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(vectors.flatten().cast(pa.float64()), math.nan).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    whole = np.floor(flat * scale)
    # Sums of squares that are not finite are no number of this kind either.
    with np.errstate(over="ignore", invalid="ignore"):
        norms = np.bincount(rows, whole * whole, len(sizes))
    usable = norms < MOST_NORM
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    places = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = usable[rows]
    out[rows[keep], places[keep]] = whole[keep].astype(np.int64)
    return out, usable


def stored(parts: np.ndarray) -> bytes:
    """The same numbers in as few bytes as the largest needs."""
    widest = max(int(parts.max(initial=0)), -int(parts.min(initial=0)) - 1)
    for kind in (np.int8, np.int16, np.int32):
        if widest <= np.iinfo(kind).max:
            return parts.astype(kind).tobytes()
    return parts.tobytes()


def matrix(row: dict) -> np.ndarray:
    cells = row["n"] * row["dim"]
    kind = np.dtype(f"i{len(row['parts']) // cells}") if cells else np.int64
    return np.frombuffer(row["parts"], kind).reshape(row["n"], row["dim"]).astype(np.int64)


def joined(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and components of several chunks."""
    dim = max(r["dim"] for r in rows)
    parts = [np.pad(matrix(r), ((0, 0), (0, dim - r["dim"]))) for r in rows]
    ids, labels = (np.concatenate([np.frombuffer(r[c], np.int64) for r in rows]) for c in ("ids", "labels"))
    return ids, labels, np.concatenate(parts)


def chunk_of(ids: np.ndarray, labels: np.ndarray, parts: np.ndarray) -> dict:
    key = int(ids[0]) if len(ids) else 0
    return {"key": key, "n": len(ids), "dim": parts.shape[1], "ids": ids.tobytes(), "labels": labels.tobytes(),
            "parts": stored(parts)}


def table_of(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


def arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


CHUNK_SCHEMA, BLOCKS_SCHEMA, TOPS_SCHEMA = map(arrow, (CHUNK, BLOCKS, TOPS))


def usable_rows(batch: pa.RecordBatch | pa.Table, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = batch.column("embedding")
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    parts, usable = integers(vectors, scale)
    ids, labels = (batch.column(c).to_numpy() if isinstance(batch, pa.Table) else
                   batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
    return ids[usable], labels[usable], parts[usable]


def chunks(vectors: DataFrame, scale: int) -> DataFrame:
    """Rows of at most CHUNK_ROWS vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                found = usable_rows(batch.slice(at, CHUNK_ROWS), scale)
                if len(found[0]):
                    yield from table_of([chunk_of(*found)], CHUNK_SCHEMA).to_batches()

    return vectors.mapInArrow(run, CHUNK)


def stripes_of(anchors: DataFrame, stripes: int, scale: int) -> DataFrame:
    """The anchors in blocks of BLOCK, ``stripes`` groups of them; equal ones are one."""

    def run(table: pa.Table) -> pa.Table:
        stripe = table["stripe"][0].as_py()
        ids, labels, parts = usable_rows(table, scale)
        # Blocks by label: the first round multiplies rows of one label only.
        order = np.lexsort((ids, labels))
        cuts = [order[a:a + BLOCK] for a in range(0, len(order), BLOCK)]
        rows = [{"stripe": stripe, "block": k} | chunk_of(ids[c], labels[c], parts[c]) for k, c in enumerate(cuts)]
        return table_of(rows, BLOCKS_SCHEMA)

    dealt = anchors.distinct().withColumn("stripe", F.pmod(F.xxhash64("vec_id", "label"), F.lit(stripes)).cast("int"))
    return dealt.groupBy("stripe").applyInArrow(run, BLOCKS)


# Exact scores


class Packed:
    """Rows packed for one block of anchors."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        dim = min(anchors.shape[1], rows.shape[1])
        self.anchors, rows = anchors[:, :dim], rows[:, :dim]
        self.n = len(rows)
        self.bias = int(rows.min(initial=0))
        most = int(np.abs(self.anchors).astype(np.float64).sum(axis=1).max(initial=0))
        span = most * (int(rows.max(initial=0)) - self.bias)
        # A field holds span added to a sum between -span and span.
        self.span, self.width = span, max(1, (2 * span).bit_length())
        self.fields = EXACT_BITS // self.width
        if self.fields:
            biased = np.zeros((-(-self.n // self.fields) * self.fields, dim), np.int64)
            biased[: self.n] = rows - self.bias
            shifts = np.arange(self.fields, dtype=np.int64) * self.width
            fields = biased.reshape(len(biased) // self.fields, self.fields, dim) << shifts[None, :, None]
            self.wide = fields.sum(axis=1).astype(np.float64)
            self.shifts, self.offset = shifts, int(sum(span << int(s) for s in shifts))
            self.unbias = self.bias * self.anchors.sum(axis=1) - span
        else:
            self.rows = rows

    def scores(self, first: int, last: int) -> np.ndarray:
        """Anchors x rows first to last, int64; ``first`` is a multiple of the number of fields."""
        if not self.fields:
            return self.anchors @ self.rows[first:last].T
        wide = self.wide[first // self.fields:-(-last // self.fields)]
        sums = (self.anchors.astype(np.float64) @ wide.T).astype(np.int64) + self.offset
        out = (sums[:, :, None] >> self.shifts) & ((1 << self.width) - 1)
        return out.reshape(len(sums), sums.shape[1] * self.fields)[:, : last - first] + self.unbias[:, None]

    def parts(self) -> Iterator[tuple[int, np.ndarray]]:
        """Place and scores of parts of the rows: small ones first, as they tell what later rows must beat."""
        step = max(1, self.fields)
        at, size = 0, 32 * step
        while at < self.n:
            end = min(self.n, at + size)
            yield at, self.scores(at, end)
            at, size = end, min(2 * BLOCK // step * step, 4 * size)


class Tops:
    """The best ``k`` (score, id) of many lists: higher scores first, then smaller ids."""

    def __init__(self, lists: int, k: int):
        self.scores = np.full((lists, k), NONE)
        self.ids = np.full((lists, k), np.iinfo(np.int64).max)

    def bound(self) -> np.ndarray:
        """The least score that can enter each list, if later rows have larger ids than earlier ones."""
        return self.scores[:, -1] + 1

    def offer(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(lists):
            return
        k = self.scores.shape[1]
        touched = np.unique(lists)
        lists = np.concatenate((np.repeat(touched, k), lists))
        scores = np.concatenate((self.scores[touched].reshape(-1), scores))
        ids = np.concatenate((self.ids[touched].reshape(-1), ids))
        there = scores != NONE
        lists, scores, ids = lists[there], scores[there], ids[there]
        order = np.lexsort((ids, -scores, lists))
        lists, scores, ids = lists[order], scores[order], ids[order]
        new = np.ones(len(lists), bool)
        new[1:] = (lists[1:] != lists[:-1]) | (scores[1:] != scores[:-1]) | (ids[1:] != ids[:-1])
        lists, scores, ids = lists[new], scores[new], ids[new]
        first = np.flatnonzero(np.concatenate(([True], lists[1:] != lists[:-1])))
        rank = np.arange(len(lists)) - np.repeat(first, np.diff(np.append(first, len(lists))))
        best = rank < k
        self.scores[touched], self.ids[touched] = NONE, np.iinfo(np.int64).max
        self.scores[lists[best], rank[best]] = scores[best]
        self.ids[lists[best], rank[best]] = ids[best]

    def row(self) -> dict:
        return {"scores": self.scores.tobytes(), "ids": self.ids.tobytes()}


def tops_of(row: dict, k: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(row[c], np.int64).reshape(-1, k) for c in ("scores", "ids"))


def runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, from, to) of each run of equal values."""
    if len(values):
        cuts = np.flatnonzero(np.diff(values, prepend=values[0] - 1))
        for a, b in zip(cuts, [*cuts[1:], len(values)], strict=True):
            yield int(values[a]), int(a), int(b)


def positives_in(block: dict, ids: np.ndarray, labels: np.ndarray, parts: np.ndarray, k: int) -> Tops:
    """The best rows of each anchor's label; the rows come by (label, id)."""
    own, kinds, anchors = joined([block])
    tops = Tops(len(own), k)
    for label, a, b in runs(kinds):
        x, y = np.searchsorted(labels, label), np.searchsorted(labels, label, "right")
        for at, scores in Packed(anchors[a:b], parts[x:y]).parts():
            those = ids[x + at:x + at + scores.shape[1]]
            hit = (scores >= tops.bound()[a:b, None]) & (those != own[a:b, None])
            which, place = np.nonzero(hit)
            tops.offer(a + which, scores[which, place], those[place])
    return tops


def limits(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest score between low and high per cent of each score; no product passes 64 bits."""
    whole, rest = scores // 100, scores % 100
    return low * whole - (-low * rest) // 100, high * whole + high * rest // 100


def negatives_in(
    block: dict, ids: np.ndarray, labels: np.ndarray, parts: np.ndarray, k: int, low: int, high: int, positives: int
) -> Tops:
    """The best rows of other labels in the range of each (anchor, positive); the rows come by id."""
    own, kinds, anchors = joined([block])
    scores, _ = tops_of({"scores": block["scores"], "ids": block["positive_ids"]}, positives)
    least, most = limits(np.where(scores == NONE, 0, scores), low, high)
    # A positive that is not there has an empty range.
    least, most = np.where(scores == NONE, 1, least), np.where(scores == NONE, 0, most)
    tops = Tops(scores.size, k)
    for at, found in Packed(anchors, parts).parts():
        those = slice(at, at + found.shape[1])
        enough = np.maximum(least, tops.bound().reshape(scores.shape))
        never = enough > most
        floor = np.where(never, np.iinfo(np.int64).max, enough).min(axis=1, initial=np.iinfo(np.int64).max)
        ceiling = most.max(axis=1, initial=NONE)
        hit = (found >= floor[:, None]) & (found <= ceiling[:, None]) & (labels[those] != kinds[:, None])
        which, place = np.nonzero(hit)
        value, name = found[which, place], ids[those][place]
        for r in range(positives):
            inside = (value >= enough[which, r]) & (value <= most[which, r])
            tops.offer(which[inside] * positives + r, value[inside], name[inside])
    return tops


# The rounds


def cells(blocks: DataFrame, rows: DataFrame, stripes: int, groups: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the cells they belong to: a stripe meets every group, a chunk every stripe."""
    left = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    part = F.pmod(F.xxhash64("key", "ids"), F.lit(groups)).cast("int")
    right = rows.withColumn("part", part).withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    return left, right


def searched(blocks: DataFrame, rows: DataFrame, stripes: int, groups: int, by_label: bool, search) -> DataFrame:
    """A row of TOPS per cell and block: what ``search`` finds in the cell's rows."""

    def run(anchors: pa.Table, there: pa.Table) -> pa.Table:
        if not (anchors.num_rows and there.num_rows):
            return table_of([], TOPS_SCHEMA)
        ids, labels, parts = joined(there.to_pylist())
        order = np.lexsort((ids, labels)) if by_label else np.argsort(ids, kind="stable")
        ids, labels, parts = ids[order], labels[order], parts[order]
        found = [
            {c: block[c] for c in ("stripe", "block", "part")} | search(block, ids, labels, parts).row()
            for block in anchors.to_pylist()
        ]
        return table_of(found, TOPS_SCHEMA)

    left, right = cells(blocks, rows, stripes, groups)
    left, right = (side.groupBy("stripe", "part") for side in (left, right))
    return left.cogroup(right).applyInArrow(run, TOPS)


def merged(tops: DataFrame, groups: int, k: int) -> DataFrame:
    """One row per block; a merge reads FAN_IN rows."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        scores, ids = zip(*(tops_of(row, k) for row in rows), strict=True)
        best = Tops(len(scores[0]), k)
        lists = np.tile(np.repeat(np.arange(len(scores[0])), k), len(rows))
        scores, ids = (np.concatenate(x).reshape(-1) for x in (scores, ids))
        there = scores != NONE
        best.offer(lists[there], scores[there], ids[there])
        return table_of([{c: rows[0][c] for c in ("stripe", "block", "part")} | best.row()], TOPS_SCHEMA)

    while True:
        groups = -(-groups // FAN_IN)
        tops = tops.withColumn("part", F.pmod("part", F.lit(groups)).cast("int"))
        tops = tops.groupBy("stripe", "block", "part").applyInArrow(run, TOPS)
        if groups == 1:
            return tops.drop("part")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of vectors (vec_id, label, embedding).

    Per anchor the best ``positives`` other rows of its label, and for each of them the best ``negatives`` rows of
    other labels that score between ``low`` and ``high`` per cent of it.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    named = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding",
        is_anchor.alias("_anchor"),
    ).dropna(subset=["vec_id", "label", "embedding"])
    folder = scratch_folder(spark, "vectors")
    rows = written(chunks(named.drop("_anchor"), scale), f"{folder}/rows")
    size = rows.agg(F.sum(F.col("n").cast("long") * F.col("dim") * 8).alias("bytes"), F.max("dim").alias("dim")).first()
    anchors = named.where("_anchor").drop("_anchor")
    # Longest vectors times anchors bounds the bytes of all stripes together.
    stripes = max(1, math.ceil(anchors.count() * (size["dim"] or 0) * 8 / STRIPE_BYTES))
    least = int(spark.conf.get("spark.sql.shuffle.partitions")) // stripes
    groups = max(1, math.ceil((size["bytes"] or 0) / CELL_BYTES), least)

    blocks = written(stripes_of(anchors, stripes, scale), f"{folder}/anchors")
    near = searched(
        blocks, rows, stripes, groups, True, lambda block, *those: positives_in(block, *those, positives)
    )
    near = merged(near, groups, positives).withColumnRenamed("ids", "positive_ids")
    paired = written(blocks.join(near, ["stripe", "block"]), f"{folder}/positives")
    hard = searched(
        paired, rows, stripes, groups, False,
        lambda block, *those: negatives_in(block, *those, negatives, low, high, positives),
    )
    hard = merged(hard, groups, negatives)
    found = paired.select("stripe", "block", "ids", "scores", "positive_ids").join(
        hard.select("stripe", "block", F.col("scores").alias("negative_scores"), F.col("ids").alias("negative_ids")),
        ["stripe", "block"],
    )
    return spelled_out(found, positives, negatives)


def spelled_out(found: DataFrame, positives: int, negatives: int) -> DataFrame:
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            anchors = np.frombuffer(row["ids"], np.int64)
            scores, ids = tops_of({"scores": row["scores"], "ids": row["positive_ids"]}, positives)
            theirs, names_of = tops_of({"scores": row["negative_scores"], "ids": row["negative_ids"]}, negatives)
            which, rank = np.nonzero(theirs != NONE)
            pair = which // positives, which % positives
            values = (anchors[pair[0]], ids[pair], (rank + 1).astype(np.int32), names_of[which, rank], scores[pair],
                      theirs[which, rank])
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names)

    return found.mapInArrow(run, ", ".join(f"{n} {'int' if n == 'rank' else 'long'}" for n in names))


def op11_hard_negatives(vectors: DataFrame) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 100; a label moves on by one where it is divisible by 7."""
    label = F.col("label").cast("long")
    noisy = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = vectors.select("vec_id", noisy.alias("label"), "embedding")
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)
