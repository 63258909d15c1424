"""Nearest-vector search: exact over all rows, by inverted lists that end exactly, and by product codes with re-ranking.
Also the rows of largest product with a query, exactly.

A search pairs blocks of rows with blocks of queries; each pair is one bounded task, which multiplies matrices and returns
its best rows per query. Those are ranked again in Spark. Distances are Euclidean, ties go to the smaller id, and a row is
never its own neighbour.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.runtime import materialise

#: Rows and queries of one task.
BLOCK_ROWS, BLOCK_QUERIES = 8192, 1024
#: Most inverted lists; their centres and sizes are held by the driver and sent to tasks.
MOST_LISTS = 1024
#: Rows that centres and codebooks are fitted on, the first by a hash of their id. All rows are indexed.
SAMPLE_ROWS = 20_000

FOUND = "query_id long, id long, distance double"


def vectors(rows: DataFrame, row_id: str, vector: str, width: int | None = None) -> DataFrame:
    """(id, v): double vectors, filled up with zeros to the widest. Rows with a null id or vector, or with a component
    that is null or not finite, take no part."""
    v = F.col(vector).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = rows.select(F.col(row_id).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~odd)
    if width is None:
        width = some.agg(F.max(F.size("v"))).first()[0] or 0
    return some.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v"))))


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def first_of(found: DataFrame, k: int) -> DataFrame:
    """The nearest `k` of each query with their rank; Spark cuts each task's rows to `k` a query before the exchange."""
    order = Window.partitionBy("query_id").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_in_block(k: int):
    """For each query the nearest `k` of the rows, and no row whose distance from the centre rules it out."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        x, q = matrix(rows["v"]), matrix(queries["v"])
        ids, asked = rows["id"].to_numpy(), queries["query_id"].to_numpy()
        out = [[], [], []]
        if len(x) and len(q):
            squares = (x * x).sum(1)
            slack = 1e-9 * (squares.max() + (q * q).sum(1).max() + 1)
            limit = queries["limit"].to_numpy() if "limit" in queries.column_names else np.full(len(q), math.inf)
            radius = rows["radius"].to_numpy() if "radius" in rows.column_names else None
            own = queries["to_centre"].to_numpy() if radius is not None else None
            for a in range(0, len(q), 128):
                near = squares - 2 * (q[a : a + 128] @ x.T)  # squared distance less the query's own square
                for j, row in enumerate(near, a):
                    able = ids != asked[j]
                    if radius is not None and limit[j] < math.inf:
                        able &= np.abs(radius - own[j]) <= limit[j] + 1e-9
                    able = np.flatnonzero(able)
                    if len(able) > k:
                        able = able[row[able] <= np.partition(row[able], k - 1)[k - 1] + slack]
                    exact = np.sqrt(((x[able] - q[j]) ** 2).sum(1))
                    best = np.lexsort((ids[able], exact))[:k]
                    out[0] += [asked[j]] * len(best)
                    out[1] += ids[able][best].tolist()
                    out[2] += exact[best].tolist()
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "id": pa.array(out[1], pa.int64()), "distance": pa.array(out[2], pa.float64())})

    return run


def exact_nearest(rows: DataFrame, queries: DataFrame, k: int, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, id, distance, rank): the nearest `k` rows (id, v) of every query (id, v), compared with all of them."""
    n_rows, n_queries = (max(1, math.ceil(df.count() / size)) for df, size in ((rows, block_rows), (queries, block_queries)))
    part = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("id", "v", part(n_rows).alias("r"), every(n_queries).alias("q"))
    right = queries.select(F.col("id").alias("query_id"), "v", part(n_queries).alias("q"), every(n_rows).alias("r"))
    found = left.groupBy("r", "q").cogroup(right.groupBy("r", "q")).applyInArrow(nearest_in_block(k), FOUND)
    return first_of(found, k)


def sample(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.xxhash64("id"), "id").limit(n)


@dataclass(frozen=True)
class InvertedLists:
    """Every row in the list of its nearest centre. `sizes[c]` is (rows, least and greatest distance from the centre)."""

    rows: DataFrame
    centres: np.ndarray
    sizes: dict[int, tuple[int, float, float]]

    @staticmethod
    def build(rows: DataFrame, n_lists: int | None = None, sample_rows: int = SAMPLE_ROWS, rounds: int = 5) -> InvertedLists:
        """`n_lists` is the root of the number of rows, MOST_LISTS at most. Centres come from k-means on a sample."""
        n = rows.count()
        n_lists = min(n_lists or math.isqrt(n), MOST_LISTS, n) or 1
        if n == 0:
            return InvertedLists(materialise(rows.selectExpr("id", "v", "0 AS list", "0D AS radius"), "lists"), np.zeros((1, 1)), {})
        if n_lists < 2:
            centres = np.zeros((1, len(rows.first()["v"])))
        else:
            fit = KMeans(k=n_lists, maxIter=rounds, seed=7, initMode="random").fit(sample(rows, sample_rows).select(array_to_vector("v").alias("features")))
            centres = np.array(fit.clusterCenters())
        width = centres.shape[1]

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            squares = (centres * centres).sum(1)
            for batch in batches:
                x = matrix(batch.column("v")).reshape(len(batch), width)
                near = (squares - 2 * (x @ centres.T)).argmin(1)
                radius = np.sqrt(((x - centres[near]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("v"), pa.array(near, pa.int32()), pa.array(radius)], ["id", "v", "list", "radius"]
                )

        placed = materialise(rows.select("id", "v").mapInArrow(assign, "id long, v array<double>, list int, radius double"), "lists")
        found = placed.groupBy("list").agg(F.count("*").alias("n"), F.min("radius").alias("a"), F.max("radius").alias("b")).collect()
        return InvertedLists(placed, centres, {r["list"]: (r["n"], r["a"], r["b"]) for r in found})

    def probes(self, queries: DataFrame, n_probes: int | None, beyond: int = 0) -> DataFrame:
        """(query_id, v, list, to_centre, limit) of the lists to look into, in the order of the least distance that a
        list can hold: | d(query, centre) - distance of a row from it |. The first `beyond` are left out, and those that
        cannot hold a row within `limit`; without `n_probes` all others come."""
        known = sorted(self.sizes)
        centres = self.centres[known] if known else self.centres[:0]
        least, most = (np.array([self.sizes[c][i] for c in known]) for i in (1, 2))

        def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q = matrix(batch.column("v"))
                for j in range(len(batch)):
                    to_centre = np.sqrt(((centres - q[j]) ** 2).sum(1))
                    bound = np.maximum(0, np.maximum(to_centre - most, least - to_centre))
                    chosen = np.lexsort((to_centre, bound))[beyond : None if n_probes is None else beyond + n_probes]
                    limit = batch.column("limit")[j].as_py()
                    chosen = chosen[bound[chosen] <= limit + 1e-9]
                    n = len(chosen)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([batch.column("query_id")[j].as_py()] * n, pa.int64()), batch.column("v").take(pa.array([j] * n, pa.int32())),
                            pa.array(np.array(known, np.int32)[chosen]), pa.array(to_centre[chosen]), pa.array([limit] * n, pa.float64()),
                        ],
                        ["query_id", "v", "list", "to_centre", "limit"],
                    )

        return queries.mapInArrow(order, "query_id long, v array<double>, list int, to_centre double, limit double")

    def look(self, probes: DataFrame, k: int) -> DataFrame:
        """The nearest `k` of each probed list. Long lists and lists with many queries are split over tasks."""
        spark = probes.sparkSession
        probes = materialise(probes, "probes")
        asked = {r["list"]: r["n"] for r in probes.groupBy("list").agg(F.count("*").alias("n")).collect()}
        plan = [(c, math.ceil(self.sizes[c][0] / BLOCK_ROWS), math.ceil(n / BLOCK_QUERIES)) for c, n in asked.items()]
        plan = F.broadcast(spark.createDataFrame(plan, "list int, parts int, blocks int"))  # MOST_LISTS rows at most
        part = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = self.rows.join(plan, "list").select("id", "v", "radius", "list", part("id", "parts").alias("r"), every("blocks").alias("q"))
        right = probes.join(plan, "list").select(*probes.columns, part("query_id", "blocks").alias("q"), every("parts").alias("r"))
        keys = ("list", "r", "q")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(nearest_in_block(k), FOUND)

    def nearest(self, queries: DataFrame, k: int, n_probes: int = 4, exact: bool = True) -> DataFrame:
        """(query_id, id, distance, rank) for queries (id, v).

        `n_probes` lists are looked into. With `exact`, the distance of the k-th row then bounds which other lists can hold
        a nearer one: those are looked into as well, so the result is that of `exact_nearest`."""
        asked = queries.select(F.col("id").alias("query_id"), "v", F.lit(math.inf).alias("limit"))
        found = self.look(self.probes(asked, n_probes), k)
        if not exact:
            return first_of(found, k)
        found = materialise(first_of(found, k), "first_probes")
        reached = found.filter(F.col("rank") == k).select("query_id", F.col("distance").alias("reached"))
        rest = asked.join(reached, "query_id", "left").select("query_id", "v", F.coalesce("reached", "limit").alias("limit"))
        more = self.look(self.probes(rest, None, beyond=n_probes), k)
        return first_of(found.drop("rank").unionByName(more), k)


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of the true neighbours that were found, over all queries, as a one-row frame."""
    hit = truth.join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    return hit.agg(F.try_divide(F.count("hit"), F.count("*")).alias("recall"))


#: Rows and queries of one task that looks for products, and rows of a box of its rows.
PRODUCT_ROWS, PRODUCT_QUERIES, BOX_ROWS = 1 << 18, 1 << 16, 256
#: So many numbers of boxes or rows are looked at together.
AT_ONCE = 1 << 21


def halved(x: np.ndarray, n_boxes: int) -> np.ndarray:
    """An order of the rows in which each of `n_boxes` equal stretches is a box: halves along the widest side."""
    order, todo = np.arange(len(x)), [(0, n_boxes)]
    cuts = np.linspace(0, len(x), n_boxes + 1).astype(int)
    while todo:
        a, b = todo.pop()
        if b - a > 1:
            rows, middle = order[cuts[a] : cuts[b]], (a + b) // 2
            side = np.ptp(x[rows], axis=0).argmax()
            order[cuts[a] : cuts[b]] = rows[np.argpartition(x[rows, side], cuts[middle] - cuts[a])]
            todo += [(a, middle), (middle, b)]
    return order


def first_products(asked: np.ndarray, ids: np.ndarray, products: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The `k` of largest product of each query; ties go to the smaller id."""
    order = np.lexsort((ids, -products, asked))
    asked, ids, products = asked[order], ids[order], products[order]
    new = np.flatnonzero(np.diff(asked, prepend=-1))
    place = np.arange(len(asked)) - np.repeat(new, np.diff(new, append=len(asked)))
    return asked[place < k], ids[place < k], products[place < k]


def products_in_block(k: int, box_rows: int = BOX_ROWS):
    """For each query the `k` rows of largest product. The product with any row of a box is at most that with the corner
    which each component's sign chooses; a box whose corner stays below the k-th product already found is left out."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        x, q = matrix(rows["v"]), matrix(queries["v"])
        ids, names = rows["id"].to_numpy(), queries["query_id"].to_numpy()
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(x) and len(q):
            width, n_boxes = x.shape[1], max(1, len(x) // max(box_rows, k))
            order, cuts = halved(x, n_boxes), np.linspace(0, len(x), n_boxes + 1).astype(int)
            # Boxes of one length, filled up with places that have no row.
            place = cuts[:-1, None] + np.arange(np.diff(cuts).max())
            gap = place >= cuts[1:, None]
            place = order[np.minimum(place, cuts[1:, None] - 1)]
            box = x[place]
            low, high = (np.ascontiguousarray(f.reduceat(x[order], cuts[:-1], axis=0).T) for f in (np.minimum, np.maximum))
            slack = 1e-9 * (np.abs(x).max() * np.abs(q).max() * width + 1e-300)

            def scored(some: np.ndarray, boxes: np.ndarray) -> np.ndarray:
                products = np.matmul(box[boxes], some[:, :, None])[:, :, 0]
                products[gap[boxes]] = -np.inf
                return products

            step = max(1, AT_ONCE // max(width * place.shape[1], n_boxes))
            for a in range(0, len(q), step):
                some = q[a : a + step]
                bound = np.maximum(some, 0) @ high + np.minimum(some, 0) @ low
                near = scored(some, bound.argmax(1))
                reached = (np.partition(near, -k, axis=1)[:, -k] if near.shape[1] >= k else np.full(len(some), -np.inf)) - slack
                held, (who, where) = found[0], np.nonzero(bound >= reached[:, None])
                for b in range(0, len(who), step):
                    whose, boxes = who[b : b + step], where[b : b + step]
                    products = scored(some[whose], boxes)
                    i, j = np.nonzero((products >= reached[whose, None]) & ~gap[boxes])
                    more = (whose[i], ids[place[boxes[i], j]], products[i, j])
                    held = tuple(np.concatenate(pair) for pair in zip(held, more))
                    if len(held[0]) > AT_ONCE:
                        held = first_products(*held, k)
                held = first_products(*held, k)
                found.append((names[a + held[0]], held[1], held[2]))
        asked, ids, products = (np.concatenate(part) for part in zip(*found))
        return pa.table({"query_id": pa.array(asked, pa.int64()), "id": pa.array(ids, pa.int64()), "product": pa.array(products, pa.float64())})

    return run


def largest_products(rows: DataFrame, queries: DataFrame, k: int, block_rows: int = PRODUCT_ROWS, block_queries: int = PRODUCT_QUERIES) -> DataFrame:
    """(query_id, id, product, rank): the `k` rows (id, v) of largest inner product with each query (id, v); ties go to the
    smaller id. Each block of rows meets each block of queries in one bounded task, which looks only into boxes of rows
    that can hold one of the `k`."""
    n_rows, asked = max(1, math.ceil(rows.count() / block_rows)), queries.count()
    # Few queries are dealt to all cores.
    n_queries = max(1, math.ceil(asked / block_queries), min(rows.sparkSession.sparkContext.defaultParallelism, asked // 4096))
    part = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("id", "v", part(n_rows).alias("r"), every(n_queries).alias("q"))
    right = queries.select(F.col("id").alias("query_id"), "v", part(n_queries).alias("q"), every(n_rows).alias("r"))
    found = left.groupBy("r", "q").cogroup(right.groupBy("r", "q")).applyInArrow(products_in_block(k), "query_id long, id long, product double")
    order = Window.partitionBy("query_id").orderBy(F.desc("product"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def lloyd(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centres of k-means on the rows of a small matrix. A centre that loses all its rows stays where it was."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = ((centres * centres).sum(1) - 2 * (x @ centres.T)).argmin(1)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


@dataclass(frozen=True)
class ProductCodes:
    """Rows as one byte for each sub-vector: the number of its nearest codeword."""

    rows: DataFrame
    codes: DataFrame
    books: list[np.ndarray]

    @staticmethod
    def build(rows: DataFrame, n_parts: int = 16, n_words: int = 256, sample_rows: int = SAMPLE_ROWS, rounds: int = 8) -> ProductCodes:
        """One codebook of up to 256 words for each of `n_parts` stretches of the components, each fitted in its own task."""
        first = rows.first()
        width = len(first["v"]) if first else 0
        cuts = [round(p * width / n_parts) for p in range(n_parts + 1)]

        def fit(key: tuple, table: pa.Table) -> pa.Table:
            p = key[0].as_py()
            book = lloyd(matrix(table["v"])[:, cuts[p] : cuts[p + 1]], n_words, rounds, p)
            return pa.table({"p": pa.array([p], pa.int32()), "book": pa.array([book.ravel().tolist()], pa.list_(pa.float64()))})

        parts = sample(rows, sample_rows).withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
        fitted = {r["p"]: r["book"] for r in parts.groupBy("p").applyInArrow(fit, "p int, book array<double>").collect()}
        books = [np.array(fitted.get(p, [])).reshape(-1, max(1, cuts[p + 1] - cuts[p])) if cuts[p + 1] > cuts[p] else np.zeros((1, 0)) for p in range(n_parts)]

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column("v"))
                near = [((b * b).sum(1) - 2 * (x[:, cuts[p] : cuts[p + 1]] @ b.T)).argmin(1) for p, b in enumerate(books)] if len(batch) else []
                codes = np.array(near, np.uint8).T
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([c.tobytes() for c in codes], pa.binary())], ["id", "code"])

        codes = materialise(rows.select("id", "v").mapInArrow(encode, "id long, code binary"), "codes")
        return ProductCodes(rows, codes, books)

    def nearest(self, queries: DataFrame, k: int, n_candidates: int = 100) -> DataFrame:
        """(query_id, id, distance, rank): the `n_candidates` of least distance between query and codewords, by one table of
        distances a query, ranked again by the distance of the vectors themselves."""
        books = self.books
        cuts = np.concatenate([[0], np.cumsum([b.shape[1] for b in books])])

        def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
            ids, out = rows["id"].to_numpy(), [[], [], []]
            codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(rows), -1)
            for name, q in zip(queries["query_id"].to_pylist(), matrix(queries["v"])):
                far = np.zeros(len(ids))
                for p, book in enumerate(books):
                    far += ((book - q[cuts[p] : cuts[p + 1]]) ** 2).sum(1)[codes[:, p]]
                other = np.flatnonzero(ids != name)
                best = other[np.lexsort((ids[other], far[other]))[:n_candidates]]
                out[0] += [name] * len(best)
                out[1] += ids[best].tolist()
                out[2] += far[best].tolist()
            return pa.table({"query_id": pa.array(out[0], pa.int64()), "id": pa.array(out[1], pa.int64()), "distance": pa.array(out[2], pa.float64())})

        n_rows, n_queries = (max(1, math.ceil(df.count() / size)) for df, size in ((self.codes, BLOCK_ROWS), (queries, BLOCK_QUERIES)))
        part = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = self.codes.select("id", "code", part(n_rows).alias("r"), every(n_queries).alias("q"))
        right = queries.select(F.col("id").alias("query_id"), "v", part(n_queries).alias("q"), every(n_rows).alias("r"))
        found = left.groupBy("r", "q").cogroup(right.groupBy("r", "q")).applyInArrow(run, FOUND)
        return re_ranked(first_of(found, n_candidates), self.rows, queries, k)


def re_ranked(candidates: DataFrame, rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The nearest `k` of the candidates (query_id, id) by the distance of the vectors themselves."""
    both = candidates.select("query_id", "id").join(rows.select("id", F.col("v").alias("x")), "id")
    both = both.join(queries.select(F.col("id").alias("query_id"), "v"), "query_id")
    squares = F.aggregate(F.zip_with("x", "v", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)
    return first_of(both.select("query_id", "id", F.sqrt(squares).alias("distance")), k)


def signed_keys(rows: DataFrame, n_tables: int, bits: int) -> DataFrame:
    """(id, v, keys): by table the signs of `bits` sums of the components with changing signs (rows of a Walsh matrix)."""

    def positive(m):
        signed = F.transform("v", lambda x, i: x * (1 - 2 * F.pmod(F.bit_count(i.bitwiseAND(m)), F.lit(2))))
        return (F.aggregate(signed, F.lit(0.0), lambda s, x: s + x) > 0).cast("long")

    # Each sign is made where it is used: a column of signs would be made again for every table.
    key = lambda t: F.aggregate(F.sequence(t * bits + 1, t * bits + bits), F.lit(0).cast("long"), lambda s, m: s * 2 + positive(m))
    return rows.select("id", "v", F.transform(F.sequence(F.lit(0), F.lit(n_tables - 1)), key).alias("keys"))


def candidates_in_block(k: int):
    """For each query the nearest `k` of the rows that share a bucket with it in one table at least."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        x, q = matrix(rows["v"]), matrix(queries["v"])
        ids, asked = rows["id"].to_numpy(), queries["query_id"].to_numpy()
        out = [[], [], []]
        if len(x) and len(q):
            row_keys, query_keys = matrix(rows["keys"]), matrix(queries["keys"])
            buckets = []  # of each table: rows by key, and where those of each query's key begin and end
            for t in range(row_keys.shape[1]):
                order = np.argsort(row_keys[:, t], kind="stable")
                held = row_keys[order, t]
                buckets.append((order, np.searchsorted(held, query_keys[:, t]), np.searchsorted(held, query_keys[:, t], "right")))
            for j in range(len(q)):
                able = np.zeros(len(x), bool)
                for order, begin, end in buckets:
                    able[order[begin[j] : end[j]]] = True
                able &= ids != asked[j]
                able = np.flatnonzero(able)
                exact = np.sqrt(((x[able] - q[j]) ** 2).sum(1))
                if len(able) > k:
                    near = exact <= np.partition(exact, k - 1)[k - 1]
                    able, exact = able[near], exact[near]
                best = np.lexsort((ids[able], exact))[:k]
                out[0] += [asked[j]] * len(best)
                out[1] += ids[able][best].tolist()
                out[2] += exact[best].tolist()
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "id": pa.array(out[1], pa.int64()), "distance": pa.array(out[2], pa.float64())})

    return run


def lsh_nearest(
    rows: DataFrame, queries: DataFrame, n_tables: int, bits: int, k: int, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_ROWS
) -> DataFrame:
    """(query_id, id, distance, rank): the nearest `k` of the rows that share a bucket with a query in one table at least.

    Candidates grow with the product of rows and queries; they are ranked inside the task of their blocks and none becomes a
    row of its own."""
    n_rows, n_queries = (max(1, math.ceil(df.count() / size)) for df, size in ((rows, block_rows), (queries, block_queries)))
    part = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = signed_keys(rows, n_tables, bits).select("id", "v", "keys", part(n_rows).alias("r"), every(n_queries).alias("q"))
    asked = signed_keys(queries, n_tables, bits).select(F.col("id").alias("query_id"), "v", "keys", part(n_queries).alias("q"), every(n_rows).alias("r"))
    found = left.groupBy("r", "q").cogroup(asked.groupBy("r", "q")).applyInArrow(candidates_in_block(k), FOUND)
    return first_of(found, k)
