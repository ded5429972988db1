"""Vector search in cells: exact, and reading only the cells that matter.

``build_cells`` writes vectors once, a folder a cell. The cells' centres come
from k-means over a sample of at most ``SAMPLE_BYTES`` of vectors; every
vector is then assigned to the nearest centre, and a cell keeps its radius,
the largest angle between its centre and a member.

``search_cells`` first reads, for every query, the nearest cells that hold k
vectors, which gives a score that the answer reaches at least. Angles obey the
triangle inequality, so no member of a cell is nearer to a query than the
angle to its centre less the radius: cells that cannot reach the score are
left out, the others are read. The answer is that of the plain search,
whatever the sample was; a bad sample only reads more. Vectors that are all
zero have no angle; they lie in a cell of their own, which is read when the
others hold fewer than k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.retrieval import (
    Best,
    answered,
    cosines,
    ids_of,
    matrix_of,
    ranked_vectors,
    vector_blocks,
    vector_side,
    written,
)

SAMPLE_BYTES = 32 << 20
MOST_CELLS = 4096
ROUNDS = 12
NO_ANGLE = -1  # the cell of vectors that are all zero
_SLACK = 1e-6  # far above the rounding of angles and scores


def _units(m):
    import numpy as np

    m = m.astype("float64")
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0), norm[:, 0] > 0


def _centres(sample, cells: int, seed: int = 7):
    """Unit centres of spherical k-means over the sample's unit vectors."""
    import numpy as np

    rng = np.random.default_rng(seed)
    centres = sample[rng.permutation(len(sample))[:cells]].copy()
    for _ in range(ROUNDS):
        near = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        unit, some = _units(sums)
        centres[some] = unit[some]
    return centres


def build_cells(
    vectors: DataFrame, path: str, vec_id: str = "vec_id", vec: str = "embedding", cells: int | None = None
) -> None:
    """Write ``vectors`` under ``path``: ``members`` (a folder a cell) and
    ``cells`` (centre, radius, count). By default about the square root of
    the number of vectors, at most ``MOST_CELLS``. A crowded cell is spread
    over files by id."""
    import numpy as np

    spark = vectors.sparkSession
    v = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vec).cast("array<float>").alias("vector"))
    v = v.filter(F.col("vector").isNotNull())
    some = v.select(F.size("vector").alias("d")).first()
    dim = int(some["d"]) if some else 1
    n = v.count()
    rows = v.orderBy(F.xxhash64("vec_id")).limit(max(1, SAMPLE_BYTES // (8 * dim))).select("vector").toPandas()
    sample, good = _units(np.stack([np.asarray(x) for x in rows["vector"]]) if len(rows) else np.zeros((0, dim)))
    sample = sample[good]
    cells = max(1, min(cells or int(n**0.5), MOST_CELLS, len(sample) or 1))
    centres = _centres(sample, cells) if len(sample) else np.zeros((1, dim))
    known = spark.sparkContext.broadcast(centres)

    def assign(batches):
        import pyarrow as pa

        for batch in batches:
            units, good = _units(matrix_of(batch.column("vector")))
            cos = units @ known.value.T if len(units) else np.zeros((0, 1))
            near = np.where(good, cos.argmax(axis=1), NO_ANGLE) if len(units) else np.zeros(0, int)
            angle = np.arccos(np.clip(cos.max(axis=1), -1, 1)) if len(units) else np.zeros(0)
            placed = {"cell": pa.array(near.astype(np.int32)), "angle": pa.array(np.where(good, angle, 0.0))}
            yield pa.RecordBatch.from_pydict(placed | {c: batch.column(c) for c in ("vec_id", "vector")})

    schema = f"cell int, angle double, vec_id {dict(v.dtypes)['vec_id']}, vector array<float>"
    placed = v.mapInArrow(assign, schema).repartitionByRange("cell", "vec_id").sortWithinPartitions("cell", "vec_id")
    placed.write.partitionBy("cell").parquet(f"{path}/members")
    kept = spark.read.schema(schema).parquet(f"{path}/members")
    sizes = kept.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"))
    at = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
    types = F.lit(schema).alias("schema")  # an empty folder has no files to tell it
    sizes.join(at, "cell", "left").coalesce(1).write.parquet(f"{path}/cells")
    spark.range(1).select(types).write.parquet(f"{path}/form")


def _cell_scan(side, k: int):
    """Cosines of members with the queries that want their cell."""

    def scan(batches):
        import numpy as np

        qids, qmat, wanted = side.value
        best, batch = Best(qids, k), None
        for batch in batches:
            cell = np.asarray(batch.column("cell"))
            ids, m = ids_of(batch.column("vec_id")), matrix_of(batch.column("vector"))
            for c in np.unique(cell):
                rows, some = np.flatnonzero(cell == c), wanted[int(c)]
                sims = cosines(m[rows], qmat[some])
                for i, j in enumerate(some):
                    best.add(int(j), ids[rows], sims[:, i])
        out = best.batch("vec_id", batch.column("vec_id").type) if batch is not None else None
        if out is not None:
            yield out

    return scan


class CellSearch:
    """A search over stored cells: ``answer()`` and, after it, ``read`` of
    ``held`` vectors (over all queries)."""

    def __init__(self, spark: SparkSession, path: str, queries: DataFrame, k: int = 5):
        self.spark, self.path, self.k = spark, path, k
        self.queries = queries.select("qid", "vector")
        form = spark.read.schema("schema string").parquet(f"{path}/form").first()["schema"]
        self.members = spark.read.schema(form).parquet(f"{path}/members")
        self.cells = spark.read.parquet(f"{path}/cells").toPandas()  # at most MOST_CELLS and one more
        ids = dict(self.members.dtypes)["vec_id"]
        self.schema = f"qid {dict(self.queries.dtypes)['qid']}, vec_id {ids}, score double"
        self.held = self.read = 0

    def _scan(self, qids, qmat, mask) -> DataFrame:
        """Members of the cells that ``mask`` (queries x cells) wants."""
        import numpy as np

        some = [int(c) for c, any_ in zip(self.cells["cell"], mask.any(axis=0)) if any_]
        wanted = {int(c): np.flatnonzero(mask[:, i]) for i, c in enumerate(self.cells["cell"])}
        self.read += int((mask * self.cells["n"].to_numpy()[None, :]).sum())
        side = self.spark.sparkContext.broadcast((qids, qmat, wanted))
        rows = self.members.filter(F.col("cell").isin(some)).select("cell", "vec_id", "vector")
        return rows.mapInArrow(_cell_scan(side, self.k), self.schema)

    def _hits(self, block) -> DataFrame:
        import numpy as np

        qids, qmat = vector_side(block)
        n = self.cells["n"].to_numpy()
        angled = self.cells["cell"].to_numpy() != NO_ANGLE
        self.held += int(n.sum()) * len(qids)
        centres = np.stack([np.asarray(c) if c is not None else np.zeros(qmat.shape[1]) for c in self.cells["centre"]])
        units, good = _units(qmat)
        between = np.where(angled[None, :], np.arccos(np.clip(units @ centres.T, -1, 1)), np.inf)
        order = np.argsort(between, axis=1, kind="stable")
        before = np.cumsum(n[order], axis=1) - n[order]
        first = np.zeros(order.shape, bool)
        np.put_along_axis(first, order, before < self.k, axis=1)
        first[~good] = True  # a query that is all zero scores nothing: every id competes
        seen = written(self._scan(qids, qmat, first))  # k rows a query and partition
        asked = self.spark.createDataFrame([(q,) for q in qids.tolist()], self.schema.split(",")[0])
        # the score that a query's answer reaches at least
        kth = ranked_vectors(asked, seen, self.k).filter(F.col("rank") == self.k)
        least = {r["qid"]: r["score"] for r in kth.select("qid", "score").collect()}
        reach = np.array([-np.inf if (s := least.get(q)) is None else s for q in qids.tolist()])
        nearest = np.clip(between - self.cells["radius"].to_numpy()[None, :] - _SLACK, 0, np.pi)
        near = (np.cos(nearest) + _SLACK >= reach[:, None]) & angled[None, :]
        more = (near | np.isinf(reach)[:, None]) & ~first
        return seen.unionByName(self._scan(qids, qmat, more)) if more.any() else seen

    def answer(self) -> DataFrame:
        if not len(self.cells):
            return ranked_vectors(self.queries, self.spark.createDataFrame([], self.schema), self.k)
        n_blocks, blocks = vector_blocks(self.queries, self.members, "vector")
        hits = (self._hits(block) for block in blocks)
        return ranked_vectors(self.queries, answered(self.spark, n_blocks, hits, self.schema), self.k)


def search_cells(spark: SparkSession, path: str, queries: DataFrame, k: int = 5) -> DataFrame:
    """``kb_search_vec`` over stored cells (``build_cells``)."""
    return CellSearch(spark, path, queries, k).answer()
