"""Product codes of vectors: k-means codebooks per part, with bounds that skip most exact distances.

Whole-number vectors are cut into ``PARTS`` consecutive parts; each part position has a codebook of up to
``ENTRIES`` entries. A round assigns every part to its nearest entry (ties to the lower index) and then moves
each entry to the floored mean of its parts. All distances that decide are exact whole numbers.

Bounds: entries are taken in groups of ``GROUP``. A vector part remembers for each group a lower bound of its
distance to the group's entries (its own entry left out) and the round in which that bound was measured, its
stamp. The driver keeps the codebooks of all rounds, so a bound is lowered by how far a group's entries have
moved *net* between the stamp and now: the norm of the sum of their moves, which is never more than the sum
of norms that running drifts would take off. Only groups whose lowered bound doesn't exceed the exact
distance to the part's own entry are measured again, and get a new bound and stamp.

A round is one scan of the vectors with their codes and bounds, written to the shared folder as Parquet (small
whole numbers take little room there); every task
adds up its own entries' sums, so that the driver sees the codebooks (their size is fixed by ``ENTRIES`` and
the vectors' length), never rows. Codebooks travel to the tasks with the function.

Defined results: vectors that are null or hold null or non-finite components are left out. Shorter vectors
are followed by zeros up to the longest, whose length is rounded up to a multiple of ``PARTS``; an empty vector
is thus all zeros. Rows that repeat a vec_id are vectors of their own; the starting entries are the first rows by
(vec_id, components), and rows without vec_id come into them never but are encoded. With fewer rows than
entries, codebooks are smaller. Components of 2 ** 29 and more, or vectors so long that squared distances leave
64 bits, are a ValueError. Other columns are not read. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.tables import bounded_batches, read, settle
from tallyhouse.sources.sinks import create_table_as

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Entries that share a bound.
GROUP = 32
#: Rows measured at once.
ROWS = 2048
#: Labels whose sums may be broadcast: 24 bytes each.
FEW_LABELS = 100_000
_FAR = float(1 << 62)
_STATE = "code binary, bounds binary, stamps binary, error long, slot int, sums array<long>"


def net_moves(history: list[np.ndarray]) -> np.ndarray:
    """[part, stamp, group]: the largest net move of a group's entries from the stamp's codebook to the last."""
    now = history[-1]
    groups = -(-now.shape[1] // GROUP)
    moves = np.zeros((PARTS, len(history), groups))
    for stamp, then in enumerate(history):
        net = np.sqrt(((now - then).astype(np.float64) ** 2).sum(axis=2)) * (1 + 1e-9)
        for g in range(groups):
            moves[:, stamp, g] = net[:, g * GROUP : (g + 1) * GROUP].max(axis=1, initial=0.0)
    return moves


def _squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all ``entries``, in the type of ``x``."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)[None, :]


def assign(x: np.ndarray, entries: np.ndarray, moves: np.ndarray, code: np.ndarray | None, bounds: np.ndarray, stamps: np.ndarray):
    """(codes, squared distances, groups measured) of one part's rows; ``bounds`` and ``stamps`` are brought up to date.

    ``code`` None: nothing is known yet, and every group is measured.
    """
    n, now = len(x), moves.shape[0] - 1
    every = np.arange(n)
    low = bounds - moves[stamps, np.arange(bounds.shape[1])]
    if code is None:
        best, at = np.full(n, _FAR).astype(x.dtype), np.full(n, len(entries))
        asked = np.ones(bounds.shape, dtype=bool)
    else:
        at = code.astype(np.int64)
        best = ((x - entries[at]) ** 2).sum(axis=1)
        reach = np.sqrt(best.astype(np.float64))
        # A bound speaks only if it is larger beyond all rounding.
        asked = low <= (reach + 1e-6 * (1 + reach))[:, None] + 1e-6 * bounds
    old, old_best = at.copy(), best.copy()
    second = np.full(bounds.shape, _FAR)
    for g in range(bounds.shape[1]):
        rows = np.flatnonzero(asked[:, g])
        if not len(rows):
            continue
        d = _squared(x[rows], entries[g * GROUP : (g + 1) * GROUP])
        near = d.argmin(axis=1)
        here = np.arange(len(rows))
        least = d[here, near]
        bounds[rows, g], stamps[rows, g] = least, now  # squared until the end of this function
        d[here, near] = _FAR
        second[rows, g] = d.min(axis=1)
        near = near + g * GROUP
        wins = (least < best[rows]) | ((least == best[rows]) & (near < at[rows]))
        best[rows[wins]], at[rows[wins]] = least[wins], near[wins]
    own = at // GROUP
    inside = asked[every, own]
    bounds[every[inside], own[inside]] = second[every[inside], own[inside]]  # its own entry is left out
    bounds[asked] = np.sqrt(bounds[asked]) * (1 - 1e-7)
    if code is not None:
        # An entry that is left counts in its group again; a group that was not measured learns of it here.
        left = np.flatnonzero((at != old) & ~asked[every, old // GROUP])
        g = old[left] // GROUP
        bounds[left, g] = np.minimum(low[left, g], np.sqrt(old_best[left].astype(np.float64)) * (1 - 1e-7))
        stamps[left, g] = now
    return at, best, int(asked.sum())


def _round(history: list[np.ndarray], exact: bool, last: bool):
    """One scan: rows with new codes and bounds, then each task's sums per entry (slot = part * entries + entry).

    Nothing comes after the ``last`` one, so its rows go without vectors and bounds.
    """
    entries, moves = history[-1], net_moves(history)
    kind = np.float64 if exact else np.int64
    entries = entries.astype(kind)
    _, size, width = entries.shape
    groups = moves.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, size, width + 1), dtype=np.int64)
        schema = None
        for batch in batches:
            schema = batch.schema
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                n = part.num_rows
                whole = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(n, PARTS, width)
                fresh = part.column("code").null_count == n
                kept = lambda name, t: np.frombuffer(b"".join(part.column(name).to_pylist()), t)  # noqa: B023, E731
                codes = None if fresh else kept("code", np.uint8).reshape(n, PARTS)
                bounds = np.zeros((n, PARTS, groups)) if fresh else kept("bounds", np.float32).reshape(n, PARTS, groups).astype(np.float64)
                stamps = np.zeros((n, PARTS, groups), np.uint8) if fresh else kept("stamps", np.uint8).reshape(n, PARTS, groups).copy()
                new, error = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64)
                for p in range(PARTS):
                    held, stamped = bounds[:, p], stamps[:, p].copy()
                    at, best, _ = assign(whole[:, p].astype(kind), entries[p], moves[p], None if fresh else codes[:, p], held, stamped)
                    new[:, p], stamps[:, p] = at, stamped
                    error += best.astype(np.int64)
                    np.add.at(sums[p, :, 0], at, 1)
                    np.add.at(sums[p, :, 1:], at, whole[:, p])
                # Kept in 4 bytes, rounded down.
                short = bounds.astype(np.float32)
                short = np.nextafter(short, np.float32(-np.inf))
                packed = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
                none = pa.nulls(n, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("label"),
                        pa.nulls(n, schema.field("v").type) if last else part.column("v"),
                        packed(new),
                        none if last else packed(short),
                        none if last else packed(stamps),
                        pa.array(error),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.list_(pa.int64())),
                    ],
                    names=["id", "label", "v", "code", "bounds", "stamps", "error", "slot", "sums"],
                )
        if schema is not None and not last:
            some = np.flatnonzero(sums[:, :, 0].reshape(-1))
            n = len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, schema.field(c).type) for c in ("id", "label", "v")]
                + [pa.nulls(n, pa.binary())] * 3
                + [pa.nulls(n, pa.int64()), pa.array(some.astype(np.int32))]
                + [pa.array(list(sums.reshape(PARTS * size, -1)[some]), pa.list_(pa.int64()))],
                names=["id", "label", "v", "code", "bounds", "stamps", "error", "slot", "sums"],
            )

    return run


def _moved(entries: np.ndarray, scanned: DataFrame) -> np.ndarray:
    """The next codebooks: floored means; entries without parts stay."""
    totals = (
        scanned.where("slot IS NOT NULL")
        .select("slot", F.posexplode("sums").alias("at", "x"))
        .groupBy("slot", "at")
        .agg(F.sum("x").alias("x"))
        .collect()
    )
    _, size, width = entries.shape
    sums = np.zeros((PARTS * size, width + 1), dtype=np.int64)
    for slot, at, x in totals:
        sums[slot, at] = x
    sums = sums.reshape(PARTS, size, width + 1)
    used = sums[:, :, 0] > 0
    out = entries.copy()
    out[used] = sums[:, :, 1:][used] // sums[:, :, :1][used]
    return out


def product_codes(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable row; up to 256 ``entries``."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.where(F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale)).alias("v")
    )
    # Limits count over all rows before anything is cut to four bytes.
    shape = kept.agg(F.max(F.size("v")).alias("length"), F.max(F.greatest(F.abs(F.array_min("v")), F.abs(F.array_max("v")))).alias("most")).first()
    named = spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    if shape.length is None:
        return named
    width, most = -(-shape.length // PARTS), int(shape.most or 0)
    if most >= 1 << 29 or PARTS * width * (2 * most + 2) ** 2 >= 1 << 62:
        raise ValueError(f"components up to {most} in vectors of {shape.length} are too large for exact 64-bit distances")
    exact = PARTS * width * (2 * most + 2) ** 2 < 1 << 53  # then doubles hold every sum exactly
    room = PARTS * width
    padded = F.concat(F.col("v"), F.array_repeat(F.lit(0).cast("long"), F.lit(room) - F.size("v"))).cast("array<int>")
    blank = [F.lit(None).cast(kind).alias(name) for name, kind in (("code", "binary"), ("bounds", "binary"), ("stamps", "binary"))]
    rows = create_table_as(kept.select("id", "label", padded.alias("v")), "vectors").select("id", "label", "v", *blank)

    start = rows.where("id IS NOT NULL").orderBy("id", "v").limit(entries).select("v").collect()
    if not start:  # no row has an id: the first rows by components start
        start = rows.orderBy("v").limit(entries).select("v").collect()
    book = np.array([r.v for r in start], dtype=np.int64).reshape(len(start), PARTS, width).transpose(1, 0, 2)
    kind = next(f.dataType for f in rows.schema.fields if f.name == "label").simpleString()
    schema = f"id long, label {kind}, v array<int>, {_STATE}"
    history = [book]
    for step in range(rounds + 1):
        scanned = create_table_as(rows.mapInArrow(_round(history, exact, step == rounds), schema), "coded")
        rows = scanned.where("slot IS NULL").select("id", "label", "v", "code", "bounds", "stamps")
        if step < rounds:
            history.append(_moved(history[-1], scanned))
    final = scanned.where("slot IS NULL").select("id", "label", "code", "error")
    digest = hashlib.sha256(",".join(map(str, history[-1].reshape(-1).tolist())).encode()).hexdigest()
    sums = settle(final.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")))
    if sums.count() <= FEW_LABELS:
        sums = F.broadcast(sums)
    return final.join(sums, F.col("label").eqNullSafe(F.col("same"))).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, four rounds of 256 entries."""
    return product_codes(read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def oracle(rounds: int = ROUNDS) -> str:
    """DuckDB SQL for the same rows, without any bounds; for vectors of one length that four parts divide."""
    distance = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (
  SELECT r, part, min(struct_pack(d := d, entry := entry)) AS near
  FROM (SELECT p.r, p.part, c.entry, CAST({distance} AS BIGINT) AS d FROM p JOIN c{t} c ON c.part = p.part)
  GROUP BY r, part
)""")
        if t < rounds:
            steps.append(f"""s{t} AS (
  SELECT part, entry, pos, sum(y)::BIGINT AS y, count(*) AS n
  FROM (SELECT p.part, a.near.entry AS entry, unnest(p.x) AS y, generate_subscripts(p.x, 1) AS pos FROM p JOIN a{t} a ON a.r = p.r AND a.part = p.part)
  GROUP BY part, entry, pos
), c{t + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(m.x, c.x) AS x
  FROM c{t} c LEFT JOIN (
    SELECT part, entry, list((y - ((y % n) + n) % n) // n ORDER BY pos) AS x FROM s{t} GROUP BY part, entry
  ) m ON m.part = c.part AND m.entry = c.entry
)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, e) AS r, e
  FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  )
), p AS MATERIALIZED (
  SELECT r, part, e[(part * len(e) // {PARTS} + 1):((part + 1) * len(e) // {PARTS})] AS x
  FROM v, (SELECT unnest(range({PARTS})) AS part)
), c0 AS MATERIALIZED (
  SELECT part, r - 1 AS entry, x FROM p WHERE r <= {ENTRIES}
), {", ".join(steps)}, coded AS (
  SELECT r, string_agg(lower(printf('%02x', near.entry)), '' ORDER BY part) AS code, sum(near.d)::BIGINT AS error
  FROM a{rounds} GROUP BY r
), book AS (
  SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, pos)) AS h
  FROM (SELECT part, entry, unnest(x) AS y, generate_subscripts(x, 1) AS pos FROM c{rounds})
)
SELECT v.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT h FROM book) AS codebooks_sha256
FROM v JOIN coded ON coded.r = v.r
"""
