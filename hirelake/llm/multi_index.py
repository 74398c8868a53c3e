"""Operator 5: approximate nearest neighbours by an inverted multi-index.

Both halves of the vectors are quantised by codebooks of their own, so ``k``
centroids each make ``k * k`` cells.  A query visits centroid pairs in the order
of their summed distance, by a heap over the two sorted lists, until the cells
hold ``T`` vectors, and reranks those by the exact measure.  Distance is the
negative inner product, the measure asked for.

``T`` is not guessed: the exact neighbours of a bounded number of queries are
found by brute force over all vectors, and T is the least number of candidates
that reaches ``recall`` on them, but never fewer than fill a query's ranks.

Vectors that are equal are one entry with their smallest ids, which is all that
any answer can hold, so a very common vector costs as much as a rare one.
Entries are handled in blocks of bounded size, queries as well.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm.common import batches_of, bounded_batches, written

#: Centroids of each half, vectors the codebooks are fitted on, queries T is fitted on, and the recall it aims at.
CENTROIDS, FIT_ROWS, FIT_QUERIES, RECALL = 64, 20_000, 256, 0.96
#: Most entries and queries of one block.
BLOCK, QUERY_BLOCK = 4096, 8192
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the vectors that take part.

    Out are null ids and vectors, empty and zero ones, those with a null or
    non-finite component, and those of another length than most.
    """
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad & F.exists("embedding", lambda x: x != 0))
    n = v.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return v.where(F.size("embedding") == (n["n"] if n else 0))


def entries_of(vectors: DataFrame, keep: int) -> DataFrame:
    """``embedding, ids``: distinct vectors with their ``keep`` smallest ids, in order.

    Ids are cut per bucket of ids first, so a very common vector never meets in one task.
    """
    w = Window.partitionBy("embedding", "part").orderBy("vec_id")
    cut = (vectors.distinct().withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
           .withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= keep))
    return cut.groupBy("embedding").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, keep).alias("ids"))


def fit_codebook(x: np.ndarray, k: int, steps: int = 15, seed: int = 7) -> np.ndarray:
    """k-means; a centroid that loses all its points stays where it is."""
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(steps):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1) - 2 * x @ c.T).argmin(1)


def matrix(column) -> np.ndarray:
    """A list column as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), -1)


class Index:
    """Codebooks and the number of vectors in each cell: at most ``k * k`` numbers, whatever the data."""

    def __init__(self, one: np.ndarray, two: np.ndarray):
        self.one, self.two, self.half = one, two, one.shape[1]
        self.count = np.zeros((len(one), len(two)), np.int64)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest(x[:, :self.half], self.one), nearest(x[:, self.half:], self.two)

    def visits(self, q: np.ndarray) -> Iterator[tuple[int, int]]:
        """Centroid pairs by summed distance, from the heads of two sorted lists."""
        a, b = -(self.one @ q[:self.half]), -(self.two @ q[self.half:])
        oa, ob = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
        a, b = a[oa].tolist(), b[ob].tolist()
        heap, row = [(a[0] + b[0], 0, 0)], [0] * len(a)  # row[i]: how many pairs of the i-th were taken
        while heap:
            _, i, j = heapq.heappop(heap)
            yield oa[i], ob[j]
            row[i] = j + 1
            if j + 1 < len(b) and (i == 0 or row[i - 1] > j + 1):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if i + 1 < len(a) and row[i + 1] == j:
                heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))

    def wanted(self, q: np.ndarray, most: int) -> np.ndarray:
        """The cells a query visits until they hold ``most`` vectors, as a matrix of flags."""
        take = np.zeros(self.count.shape, bool)
        held = 0
        for i, j in self.visits(q):
            take[i, j] = True
            held += int(self.count[i, j])
            if held >= most:
                break
        return take


def fit(entries: DataFrame, centroids: int, rows: int) -> Index | None:
    """Codebooks from at most ``rows`` entries, the first by a hash; None without entries."""
    sample = entries.select("embedding").orderBy(F.xxhash64("embedding")).limit(rows).collect()
    if not sample:
        return None
    x = np.array([r["embedding"] for r in sample])
    half = x.shape[1] // 2
    return Index(fit_codebook(x[:, :half], centroids), fit_codebook(x[:, half:], centroids))


def indexed(entries: DataFrame, index: Index) -> DataFrame:
    """Entries with their cell: ``i, j``."""
    def run(batches):
        for b in batches:
            i, j = index.cells(matrix(b.column("embedding")))
            yield pa.RecordBatch.from_arrays([b.column("embedding"), b.column("ids"), pa.array(i, pa.int32()), pa.array(j, pa.int32())],
                                             names=["embedding", "ids", "i", "j"])
    return entries.select("embedding", "ids").mapInArrow(run, "embedding array<double>, ids array<long>, i int, j int")


def best(x: np.ndarray, ids: list[list[int]], first: np.ndarray, q: np.ndarray, own: int, top: int) -> list[tuple[int, float]]:
    """The ``top`` nearest ids among these entries, without the query's own, ties to the smaller id."""
    score = np.einsum("ij,j->i", x, q)
    if len(score) > top + 1:
        least = np.partition(score, len(score) - top - 1)[len(score) - top - 1]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    at = at[np.lexsort((first[at], -score[at]))][:top + 1]
    found = [(-float(score[k]), v) for k in at for v in ids[k] if v != own]
    return [(v, -s) for s, v in sorted(found)[:top]]


def exact(entries: DataFrame, queries: list[tuple[int, np.ndarray]], top: int) -> DataFrame:
    """The true neighbours of a bounded number of queries, by brute force over all entries."""
    def run(batches):
        def rows():
            for b in batches:
                x, ids = matrix(b.column("embedding")), b.column("ids").to_pylist()
                first = np.array([v[0] for v in ids])
                for own, q in queries:
                    for v, s in best(x, ids, first, q, own, top):
                        yield own, v, s
        yield from batches_of(rows(), FOUND)
    return nearest_first(entries.select("embedding", "ids").mapInArrow(run, "query_id long, vec_id long, score double"), top)


def nearest_first(found: DataFrame, top: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def candidates_needed(index: Index, queries: list[tuple[int, np.ndarray]], truth: list, cell: dict[int, tuple[int, int]], recall: float) -> int:
    """The least T that finds a share ``recall`` of these queries' true neighbours."""
    of: dict[int, list[int]] = {}
    for r in truth:
        of.setdefault(r["query_id"], []).append(r["vec_id"])
    need = []
    for own, q in queries:
        wanted: dict[tuple[int, int], int] = {}
        for v in of.get(own, []):
            wanted[cell[v]] = wanted.get(cell[v], 0) + 1
        held = 0
        for pair in index.visits(q):
            if not wanted:
                break
            # the visit goes on while fewer than T are held, so one more than before this cell reaches it
            need += [held + 1] * wanted.pop(pair, 0)
            held += int(index.count[pair])
    return sorted(need)[min(len(need) - 1, int(np.ceil(recall * len(need))) - 1)] if need else 1


def search(vectors: DataFrame, queries: DataFrame | None = None, top: int = 20, centroids: int = CENTROIDS, fit_rows: int = FIT_ROWS,
           fit_queries: int = FIT_QUERIES, recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of each query, its own row left out.

    ``vectors`` and ``queries`` (default: the vectors whose id is divisible by
    20) have ``vec_id`` and ``embedding``; other columns are not read.  Rows that
    ``usable`` leaves out take no part; repeated rows count once.  No vectors
    or no queries: no rows.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    all_ = written(usable(vectors), "vectors")
    queries = all_.where("vec_id % 20 = 0") if queries is None else usable(queries)
    queries = written(queries.dropDuplicates(["vec_id"]), "queries")
    entries = written(entries_of(all_, top + 1), "entries")
    index = fit(entries, centroids, fit_rows)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    cells = written(indexed(entries, index), "multi-index")
    for r in cells.groupBy("i", "j").count().collect():  # one row for each cell
        index.count[r["i"], r["j"]] = r["count"]
    sample = [(r["vec_id"], np.array(r["embedding"])) for r in queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_queries).collect()]
    truth = written(exact(entries, sample, top), "true-neighbours")
    where = {r["vec_id"]: (r["i"], r["j"]) for r in
             cells.select(F.explode("ids").alias("vec_id"), "i", "j").join(truth.select("vec_id").distinct(), "vec_id").collect()}
    # at least as many entries as fill the ranks beside the query's own, whatever the sample needs
    most = max(top + 1, candidates_needed(index, sample, truth.collect(), where, recall))
    # entries in blocks of a row of cells, split where it holds more than a block
    rows = index.count.sum(1)
    blocks = [max(1, -(-int(n) // BLOCK)) for n in rows]
    split = F.array([F.lit(b) for b in blocks])[F.col("i")]
    n_query = max(1, -(-queries.count() // QUERY_BLOCK))
    held = (cells.withColumn("block", F.pmod(F.xxhash64("embedding"), split).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1)))))

    def visit(batches):
        for b in batches:
            out = []
            for own, q in zip(b.column("vec_id").to_pylist(), matrix(b.column("embedding"))):
                take = index.wanted(q, most)
                for i in np.flatnonzero((take & (index.count > 0)).any(1)).tolist():
                    flags = np.packbits(take[i]).tobytes()
                    out += [(own, q, i, k, own % n_query, flags) for k in range(blocks[i])]
            for at in range(0, len(out), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at:at + 4096]), visited.types)], schema=visited)

    visited = pa.schema([("query_id", pa.int64()), ("q", pa.list_(pa.float64())), ("i", pa.int32()), ("block", pa.int32()),
                         ("part", pa.int32()), ("flags", pa.binary())])
    asked = queries.select("vec_id", "embedding").mapInArrow(visit, "query_id long, q array<double>, i int, block int, part int, flags binary")
    k = len(index.two)

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(left) and len(right):
            x, j, ids = matrix(left.column("embedding")), np.asarray(left.column("j")), left.column("ids").to_pylist()
            order = np.argsort(j, kind="stable")
            x, j, ids = np.ascontiguousarray(x[order]), j[order], [ids[n] for n in order]
            first = np.array([v[0] for v in ids])
            for own, q, flags in zip(right.column("query_id").to_pylist(), matrix(right.column("q")), right.column("flags").to_pylist()):
                at = np.flatnonzero(np.unpackbits(np.frombuffer(flags, np.uint8), count=k).astype(bool)[j])
                out += [(own, v, s) for v, s in best(x[at], [ids[n] for n in at], first[at], q, own, top)] if len(at) else []
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3, FOUND.types)], schema=FOUND)

    found = (held.groupBy("i", "block", "part").cogroup(asked.groupBy("i", "block", "part"))
             .applyInArrow(rerank, "query_id long, vec_id long, score double"))
    return nearest_first(found, top)
