"""Hard-negative mining with Kronecker-packed products (operator 13).

Scores are exact integer inner products of floor(scale * x). Components are biased by the least one, so
none is negative; the biased components of several candidates then stand in separated fields of one
wide integer, wide enough for a whole inner product. One multiplication of an anchor's component with
that integer multiplies all of them, the sums of the products stay in their fields, and the exact scores
are unpacked and freed of the bias. Up to 53 bits the wide integers are doubles, which hold such integers
exactly, so a block of them is one matrix product; beyond, they are Python integers of any width.

Anchors and candidates meet in cells: a cell holds one group of anchors, as small integers, and reads past
them one part of the candidates, block by block (a stated query set against all rows). It keeps the best rows
per anchor found so far, so later blocks only have to beat these, and returns a few rows per anchor at its end.
The first pass keeps the best ``POSITIVES`` rows of the anchor's label, the second the best ``NEGATIVES`` rows per
positive whose score lies in the stated share of the positive's. Anchors are dealt by a hash of the row and
candidates by turns, so no label, vector or id makes a large cell; memory of a cell does not depend on the table.

Defined cases: rows with a null label, a null vector or a null, NaN or infinite component take no part;
a null id is no anchor, keeps its label and comes last among ties; repeated rows are rows of their own,
and only the anchor's own row is left out of its candidates; a shorter vector is filled up with zeros;
an anchor without positives, a positive without negatives, and an empty table give no rows; other
columns are ignored. Scores must fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultkit.llm.common import land, table, tasks

EVERY = 50                 # anchors: ids divisible by this
POSITIVES, NEGATIVES = 5, 3
LEAST_PCT, MOST_PCT = 50, 95
SCALE = 256
ANCHORS, CANDIDATES = 262_144, 4096   # anchors of a cell, about; candidates of a block
COMPONENTS = 1 << 24, 1 << 20         # of a cell's anchors and of a block, at most: longer vectors, fewer rows
AT_ONCE = 64                          # anchors of one matrix product
EXACT = 53                 # bits of integers that a double holds exactly
FIELDS = 16                # fields of a Python integer, where a field is wider


def usable(label: Column, vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)))
    return label.isNotNull() & vector.isNotNull() & finite


def pack(x: np.ndarray, low: int, width: int) -> tuple[np.ndarray, int]:
    """(wide integers: one row per group of candidates, one column per component; fields in each)."""
    fields = EXACT // width or FIELDS
    kind = np.float64 if width <= EXACT else object
    groups = -(-len(x) // fields)
    biased = np.zeros((groups * fields, x.shape[1]), object if kind is object else np.int64)
    biased[:len(x)] = x.astype(biased.dtype) - low
    out = np.zeros((groups, x.shape[1]), biased.dtype)
    for f in range(fields):
        out += biased[f::fields] * (1 << f * width)
    return out.astype(kind), fields


def packed(x: np.ndarray, low: int, width: int) -> tuple[np.ndarray, int, np.ndarray]:
    """(wide integers and fields of ``pack``, the candidates' share of the bias, with places that ``pack`` filled up)."""
    wide, fields = pack(x, low, width)
    big = object if wide.dtype == object else np.int64
    bias = np.zeros(len(wide) * fields, big)
    # sum (a - low)(x - low) = sum a x - low * (sum a + sum x) + d * low^2
    bias[:len(x)] = low * x.astype(big).sum(1) - x.shape[1] * low * low
    return wide, fields, bias


def products(anchors: np.ndarray, wide: np.ndarray, fields: int, bias: np.ndarray, low: int, width: int):
    """(f, inner products with the candidates at f, f + fields, ...) but for ``low`` times the sum of the anchor's components."""
    kind = wide.dtype if wide.dtype == object else np.int64
    sums = (anchors.astype(kind) - low).astype(wide.dtype) @ wide.T
    if kind != object:
        sums = sums.astype(kind)
    for f in reversed(range(fields)):      # the highest field needs no mask, the lowest no shift
        field = sums >> f * width if f else sums
        if f + 1 < fields:
            field = field & ((1 << width) - 1)
        field += bias[f::fields]
        yield f, field


def scores(anchors: np.ndarray, x: np.ndarray, low: int, width: int) -> np.ndarray:
    """Inner products (anchors x candidates, int64) through packed products."""
    wide, fields, bias = packed(x, low, width)
    out = np.empty((len(anchors), len(bias)), bias.dtype)
    for f, s in products(anchors, wide, fields, bias, low, width):
        out[:, f::fields] = s
    return (out[:, :len(x)] + low * anchors.astype(bias.dtype).sum(1)[:, None]).astype(np.int64)


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    offsets = np.asarray(vectors.offsets)
    n = np.diff(offsets)
    flat = np.asarray(vectors.values)[offsets[0]:offsets[-1]]
    out = np.zeros((len(n), dims), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], n)] = flat
    return out


def small(low: int, high: int) -> np.dtype:
    """The least integer type for these components."""
    return next(np.dtype(t) for t in ("int8", "int16", "int32", "int64") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)


def _planes(x: np.ndarray, low: int, size: int) -> bytes:
    """Biased components, ``size`` bytes each: all lowest bytes first, as the highest are mostly zero and compress."""
    return np.ascontiguousarray((x - low).astype("<i8").reshape(-1, 1).view(np.uint8)[:, :size].T).tobytes()


def _bytes(low: int, high: int) -> int:
    return max(1, -(-(high - low).bit_length() // 8))


def _unplaned(data, low: int, size: int, dims: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(size, -1).T
    return out.view("<i8").reshape(-1, dims) + low


_BOX = "part long, at binary, id binary, none binary, label binary, q binary, wanted binary"


def boxes(rows: DataFrame, size: int, dims: int, low: int, high: int, parts: int, places: int = 0) -> DataFrame:
    """Blocks of at most ``size`` rows, each column's values one binary: rows with a column ``part`` are kept apart by it,
    others are cut into blocks as they come, and these are dealt to ``parts`` parts by turns."""
    dealt, kind = "part" not in rows.columns, small(low, high)

    def run(batches):
        waiting, turn = {}, int((TaskContext.get().partitionId() * 0.618033988749895) % 1 * parts)
        for b in batches:
            b = {name: b.column(name) for name in b.schema.names}
            many = len(b["at"])
            part = np.zeros(many, np.int64) if dealt else b["part"].to_numpy()
            values = {"at": b["at"].to_numpy(), "id": b["id"].fill_null(0).to_numpy(), "none": b["id"].is_null().to_numpy(zero_copy_only=False),
                      "label": b["label"].to_numpy(), "q": _matrix(b["q"], dims).astype(kind)}
            values["wanted"] = _asked(b["wanted"], places) if places else np.empty((many, 0), np.int64)
            for p in np.unique(part):
                mine = part == p
                kept = waiting.setdefault(int(p), [])
                kept.append({k: v[mine] for k, v in values.items()})
                while sum(len(k["at"]) for k in kept) >= size:
                    whole = {k: np.concatenate([x[k] for x in kept]) for k in values}
                    yield box(turn % parts if dealt else int(p), {k: v[:size] for k, v in whole.items()})
                    turn += 1
                    kept[:] = [{k: v[size:] for k, v in whole.items()}]
        for p, kept in waiting.items():
            if any(len(k["at"]) for k in kept):
                yield box(turn % parts if dealt else p, {k: np.concatenate([x[k] for x in kept]) for k in kept[0]})

    def box(part, values):
        cells = {k: v.tobytes() for k, v in values.items()} | {"q": _planes(values["q"].astype(np.int64), low, _bytes(low, high))}
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *(pa.array([v], pa.binary()) for v in cells.values())], names=["part", *cells])

    return tasks(rows, run, _BOX)


def _asked(lists: pa.Array, places: int) -> np.ndarray:
    """Number of the positives' scores, then these."""
    n = np.diff(np.asarray(lists.offsets))
    return np.column_stack([n, _matrix(lists, places)])


def _opened(row: dict, dims: int, low: int, high: int, places: int) -> dict:
    out = {k: np.frombuffer(row[k].as_buffer(), t) for k, t in (("at", np.int64), ("id", np.int64), ("none", bool), ("label", np.int64))}
    out["q"] = _unplaned(row["q"].as_buffer(), low, _bytes(low, high), dims)
    if places:
        out["wanted"] = np.frombuffer(row["wanted"].as_buffer(), np.int64).reshape(-1, 1 + places)
    return out


_LEAST, _MOST = -(1 << 63) + 1, (1 << 63) - 1


def _windows(wanted: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest admissible score (anchors x places); nothing is admissible where there is no positive."""
    p = wanted[:, 1:]
    if max(1, -int(p.min(initial=0)), int(p.max(initial=0))) * max(abs(least), abs(most)) > _MOST:
        p = p.astype(object)
    low, high = -(-p * least // 100), p * most // 100
    empty = (np.arange(p.shape[1]) >= wanted[:, :1]) | (low > high) | (low > _MOST) | (high < _LEAST)
    clipped = [np.array(np.clip(x, _LEAST, _MOST), np.int64).reshape(p.shape) for x in (low, high)]
    return np.where(empty, _MOST, clipped[0]), np.where(empty, _LEAST, clipped[1])


class _Cell:
    """A group of anchors and the best rows found for each place of each: of its own label, or of the others within a window."""

    def __init__(self, anchors: list[dict], k: int, low: int, width: int, window: tuple[int, int] | None):
        a = {key: np.concatenate([x[key] for x in anchors]) for key in anchors[0]}
        order = np.argsort(a["label"], kind="stable")     # anchors at once have few labels
        self.at, self.label, self.q = a["at"][order], a["label"][order], a["q"][order]
        self.k, self.low, self.width, self.same, self.begun = k, low, width, window is None, False
        n = len(order)
        if self.same:
            self.least, self.most = np.full((n, 1), _LEAST), np.full((n, 1), _MOST)
        else:
            self.least, self.most = _windows(a["wanted"][order], *window)
        self.places = self.least.shape[1]
        slots = n * self.places
        self.score, self.none = np.full((slots, k), _LEAST), np.ones((slots, k), bool)
        self.id, self.other = np.full((slots, k), _MOST), np.full((slots, k), _MOST)

    def meet(self, c: dict) -> None:
        """Take in a block of candidates."""
        order = np.argsort(c["label"], kind="stable")
        c = {key: c[key][order] for key in ("at", "id", "none", "label", "q")}
        wide, fields, bias = packed(c["q"], self.low, self.width)
        for start in range(0, len(self.at), AT_ONCE):
            rows = slice(start, min(start + AT_ONCE, len(self.at)))
            first, last = 0, len(wide)
            if self.same:
                first = int(np.searchsorted(c["label"], self.label[rows.start], "left")) // fields
                last = -(-int(np.searchsorted(c["label"], self.label[rows.stop - 1], "right")) // fields)
            step = last if self.begun else 32      # a few candidates first, as there is no bound yet
            while first < last:
                self._meet(rows, c, wide, fields, bias, first, min(first + step, last))
                first, step = first + step, step * 8
        self.begun = True

    def _meet(self, rows: slice, c: dict, wide, fields, bias, first: int, last: int) -> None:
        q = self.q[rows]
        own = self.low * q.astype(bias.dtype).sum(1)
        n = len(q)
        slots = slice(rows.start * self.places, rows.stop * self.places)
        kth = self.score[slots, -1].reshape(n, self.places)
        least, most = np.maximum(self.least[rows], kth), self.most[rows]
        floor, roof = least.min(1), most.max(1)
        if bias.dtype != object:     # scores and sums are far below this
            floor, roof = np.clip(floor, -(1 << 60), 1 << 60), np.clip(roof, -(1 << 60), 1 << 60)
        floor, roof = floor.astype(bias.dtype) - own, roof.astype(bias.dtype) - own
        found = []
        for f, s in products(q, wide[first:last], fields, bias[first * fields:last * fields], self.low, self.width):
            hit = s >= floor[:, None]
            if not self.same and np.count_nonzero(hit) * 16 > hit.size:
                hit &= s <= roof[:, None]
            i = np.flatnonzero(hit)
            if len(i):
                r, j = np.divmod(i, s.shape[1])
                found.append((r, (first + j) * fields + f, (s.reshape(-1)[i] + own[r])))
        if not found:
            return
        r, j, s = (np.concatenate(x) for x in zip(*found))
        ok = j < len(c["at"])        # places that only fill up the last wide integer
        r, j, s = r[ok], j[ok], s[ok].astype(np.int64)
        if self.same:
            ok = (c["label"][j] == self.label[rows][r]) & (c["at"][j] != self.at[rows][r])
        else:
            ok = c["label"][j] != self.label[rows][r]
        r, j, s = r[ok], j[ok], s[ok]
        slot, at = [], []
        for p in range(self.places):
            i = np.flatnonzero((s >= least[r, p]) & (s <= most[r, p]))
            slot.append(slots.start + r[i] * self.places + p)
            at.append(i)
        slot, at = np.concatenate(slot), np.concatenate(at)
        self._take(slot, s[at], c["none"][j[at]], c["id"][j[at]], c["at"][j[at]])

    def _take(self, slot, score, none, ids, other) -> None:
        """Keep the k first of these and the kept ones per slot: greatest score, then least id, null ids last, then least row."""
        # Ties of the last one kept must come before it.
        last = [x[slot, -1] for x in (self.none, self.id, self.other)]
        before = (none < last[0]) | (none == last[0]) & ((ids < last[1]) | (ids == last[1]) & (other < last[2]))
        ok = (score > self.score[slot, -1]) | before
        if not ok.any():
            return
        new = [x[ok] for x in (score, none, ids, other)]
        slot = slot[ok]
        touched = np.unique(slot)
        kept = (self.score, self.none, self.id, self.other)
        slot = np.concatenate([np.repeat(touched, self.k), slot])
        new = [np.concatenate([old[touched].reshape(-1), x]) for old, x in zip(kept, new)]
        order = np.lexsort((new[3], new[2], new[1], -new[0], slot))
        of = slot[order]
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        rank = np.arange(len(of)) - np.repeat(starts, np.diff(np.r_[starts, len(of)]))
        top = order[rank < self.k]
        for old, x in zip(kept, new):
            old[touched] = x[top].reshape(len(touched), self.k)

    def found(self):
        size = max(1, 100_000 // self.k)
        for start in range(0, len(self.score), size):
            slot, i = np.nonzero(self.other[start:start + size] != _MOST)
            if len(slot):
                slot += start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(self.at[slot // self.places]), pa.array((slot % self.places).astype(np.int32)), pa.array(self.other[slot, i]),
                     pa.array(self.id[slot, i], mask=self.none[slot, i]), pa.array(self.score[slot, i])], names=["anchor", "place", "other", "id", "score"])


_FOUND = "anchor long, place int, other long, id long, score long"


def search(anchors: DataFrame, candidates: DataFrame, groups: int, parts: int, dims: int, low: int, high: int, width: int, k: int,
           places: int = 0, window: tuple[int, int] | None = None) -> DataFrame:
    """The best k rows per anchor and place in each cell: boxes of anchors of a group beside boxes of candidates of a part."""
    a = anchors.withColumn("cell", F.explode(F.sequence(F.col("part") * parts, F.col("part") * parts + parts - 1))).withColumn("turn", F.lit(0))
    c = candidates.withColumn("cell", F.explode(F.sequence(F.col("part"), F.lit((groups - 1) * parts) + F.col("part"), F.lit(parts).cast("long")))).withColumn("turn", F.lit(1))
    met = a.unionByName(c).drop("part").repartitionById(groups * parts, F.col("cell").cast("int")).sortWithinPartitions("cell", "turn")

    def run(batches):
        waiting, cell, of = [], None, None
        for b in batches:
            for i in range(len(b)):
                row = {name: b.column(name)[i] for name in b.schema.names}
                if row["cell"].as_py() != of:
                    if cell:
                        yield from cell.found()
                    waiting, cell, of = [], None, row["cell"].as_py()
                if row["turn"].as_py() == 0:
                    one = _opened(row, dims, low, high, places)
                    waiting.append({key: v.astype(small(low, high) if key == "q" else v.dtype) for key, v in one.items()})
                elif waiting or cell:
                    if cell is None:
                        cell, waiting = _Cell(waiting, k, low, width, window), []
                    cell.meet(_opened(row, dims, low, high, 0))
        if cell:
            yield from cell.found()

    return tasks(met, run, _FOUND)


def _best(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k first rows per key over all cells: at most k come from each."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = EVERY,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST_PCT, most: int = MOST_PCT,
                   scale: int = SCALE, sizes: tuple[int, int] = (ANCHORS, CANDIDATES)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the hardest admissible
    negatives of every anchor and positive; a score must lie between ``least`` and ``most`` percent of the positive's."""
    src = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    q = F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    valid = land(src.where(usable(F.col("label"), F.col("v"))).select("id", "label", q.alias("q")).withColumn("at", F.monotonically_increasing_id()), "vectors")
    anchor = F.coalesce(F.col("id") % every == 0, F.lit(False))
    st = valid.agg(F.count("*").alias("n"), F.count_if(anchor).alias("m"), F.coalesce(F.min(F.array_min("q")), F.lit(0)).alias("low"),
                   F.coalesce(F.max(F.array_max("q")), F.lit(0)).alias("high"), F.coalesce(F.max(F.size("q")), F.lit(0)).alias("dims")).first()
    low, dims = min(st.low, 0), max(st.dims, 1)
    high = max(st.high, 0)
    width = max(1, (dims * (high - low) ** 2).bit_length())
    most_anchors, most_rows = (max(1, min(s, c // dims)) for s, c in zip(sizes, COMPONENTS))
    groups = max(1, -(-st.m // most_anchors))
    # Each anchor is copied to the parts and each candidate to the groups: anchors' copies are no more than the rows.
    wanted_cells = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(-(-st.n // most_rows), -(-st.n // max(st.m, 1)), -(-wanted_cells // groups)))
    group = F.pmod(F.xxhash64("at"), F.lit(groups)).alias("part")
    boxed = boxes(valid, most_rows, dims, low, high, parts)
    anchors = valid.where(anchor)
    asking = boxes(anchors.select("id", "label", "q", "at", group), most_rows, dims, low, high, parts)
    found = search(asking, boxed, groups, parts, dims, low, high, width, positives)
    best = land(_best(found, positives, "anchor"), "positives")
    per = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("id").alias("pid"), F.col("score").alias("ps")))).alias("p"))
    asked = land(anchors.join(per, F.col("at") == F.col("anchor")).select("id", "label", "q", "at", "p", F.col("p.ps").alias("wanted")), "anchors")
    asking = boxes(asked.select("id", "label", "q", "at", "wanted", group), most_rows, dims, low, high, parts, positives)
    found = search(asking, boxed, groups, parts, dims, low, high, width, negatives, positives, (least, most))
    hard = _best(found, negatives, "anchor", "place")
    one = F.element_at("p", F.col("place") + 1)
    return hard.join(asked.select(F.col("at").alias("anchor"), F.col("id").alias("anchor_id"), "p"), "anchor").select(
        "anchor_id", one["pid"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        one["ps"].alias("positive_score"), F.col("score").alias("negative_score"))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", label.alias("label")))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
p AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM p WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN p USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
