"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

`build_graph` gives every distinct vector (a node) its K nearest found.  It starts from pairs inside short runs of
nodes that were sorted by the signs of random projections, and then joins neighbours of neighbours: each node
meets the forward and (up to REVERSE, fresh ones first) reverse neighbours of a common neighbour, and keeps whom it
finds nearer.  Pairs that met before are not compared again, and it ends when few edges change.  A vector is
sent once to each bucket of BUCKET nodes in which it is somebody's neighbour, and only pairs that improve an edge
come back, so no step emits all pairs of a group.

`search` walks the graph for many queries at once: each keeps the BEAM nearest nodes seen, and every round the
neighbours of its nearest unexpanded nodes are measured, until all of its beam are expanded.

Equal vectors are one node, so that copies cannot fill one another's lists: a node keeps its smallest k + 1
vec_ids, which is all that a list of k can show, as ties go to the smaller vec_id.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite entries and rows with a NULL vec_id
take no part; rows equal in vec_id and vector count once; a vec_id with several vectors is a row for each; vectors
of another length are never compared (each length has its own graph); with fewer candidates than k all are
returned; an empty table gives no rows.  Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polidata.llm.common import positions, written

#: Neighbours of a node, and reverse neighbours that join beside them.
K = 32
REVERSE = 32
#: Sorted orders that the first graph is taken from, and nodes of a run of which all are compared.
ORDERS = 2
RUN = 64
SIGNS = 16
#: Nodes of a bucket: those whose neighbours meet in one group, and those that a search measures in one.
BUCKET = 256
SEARCH_BUCKET = 4096
#: It ends when a smaller share of the edges is new, or after this many joins.
LEAST_NEW = 0.25
ITERATIONS = 20
#: Nodes a query keeps, those it expands in a round, and those measured again in double precision at the end.
BEAM = 192
EXPAND = 64
EXACT = 32


@dataclass
class Index:
    nodes: DataFrame    # idx, vec array<double>, ids (the smallest vec_ids, ascending)
    graph: DataFrame    # idx, code (float32 of the scaled vector), edges array<struct<d, v, fresh>> by distance
    n: int


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part, vec as array<double>."""
    ok = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = df.select(F.col(vec_id).alias("vec_id"), F.transform(vector, lambda x: x.cast("double") + F.lit(0.0)).alias("vec"))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ok)


def column_means(rows: DataFrame, length: int) -> tuple[np.ndarray, float]:
    """Mean of the vectors and largest absolute entry, from partial sums of the tasks."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count, most = np.zeros(length), 0, 0.0
        for batch in batches:
            x = matrix(batch.column("vec"), length)
            total, count, most = total + x.sum(axis=0), count + len(x), max(most, float(np.abs(x).max(initial=0)))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([count]), pa.array([most])], names=["t", "c", "m"])

    parts = rows.select("vec").mapInArrow(sums, "t binary, c long, m double").collect()     # one short row a task
    return sum(np.frombuffer(p.t) for p in parts) / max(1, sum(p.c for p in parts)), max(p.m for p in parts)


def matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


def codes_matrix(column: pa.Array, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, length).astype(np.float64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


# -- the graph -------------------------------------------------------------------------------------------------
def node_table(rows: DataFrame, k: int) -> DataFrame:
    """(vec, ids): distinct vectors with their k + 1 smallest vec_ids."""
    w = Window.partitionBy("vec").orderBy("vec_id")
    few = rows.withColumn("_r", F.dense_rank().over(w)).filter(F.col("_r") <= k + 1)
    return few.groupBy("vec").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))


def ordered_nodes(nodes: DataFrame, length: int, mean: np.ndarray, scale: float, seed: int, name: str) -> DataFrame:
    """nodes with code, idx and n: positions by the signs of random projections of the centred vectors."""
    planes = np.random.default_rng(seed).normal(size=(length, SIGNS + 1))
    weights = 1 << np.arange(SIGNS - 1, -1, -1)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("vec"), length) / scale
            y = (x - mean / scale) @ planes
            code = pa.array([c.tobytes() for c in x.astype(np.float32)], pa.binary())
            signs = ((y[:, :SIGNS] > 0) * weights).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, code, pa.array(signs.astype(np.int64)), pa.array(y[:, SIGNS])],
                                             names=[*batch.schema.names, "code", "signs", "along"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    placed = nodes.mapInArrow(project, f"{shape}, code binary, signs long, along double").withColumn("all", F.lit("all"))
    return positions(placed, "all", ["signs", "along"], name).drop("all", "signs", "along")


def run_pairs(nodes: DataFrame, length: int) -> DataFrame:
    """(u, v, d): the K nearest of each node inside its run of consecutive positions.  nodes: at, n, idx, code."""
    last = F.greatest(F.floor(F.col("n") / RUN) - 1, F.lit(0))
    runs = nodes.select(F.least(F.floor(F.col("at") / RUN), last).cast("long").alias("run"), "idx", "code")

    def pairs(table: pa.Table) -> pa.Table:
        idx = table["idx"].to_numpy()
        d = distances(*[codes_matrix(table["code"], length)] * 2)
        np.fill_diagonal(d, np.inf)
        near = np.argsort(d, axis=1, kind="stable")[:, :min(K, len(idx) - 1)]
        return edge_table(np.repeat(idx, near.shape[1]), idx[near].ravel(), np.take_along_axis(d, near, 1).ravel())

    return runs.groupBy("run").applyInArrow(pairs, "u long, v long, d double")


def edge_table(u: np.ndarray, v: np.ndarray, d: np.ndarray) -> pa.Table:
    return pa.table({"u": u.astype(np.int64), "v": v.astype(np.int64), "d": d.astype(np.float64)})


def nearest_edges(edges: DataFrame) -> DataFrame:
    """(u, edges): the K nearest of each node; an edge known before stays known.  edges: u, v, d, fresh."""
    once = edges.repartition("u").groupBy("u", "v").agg(F.min("d").alias("d"), F.min("fresh").alias("fresh"))
    return once.groupBy("u").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "v", "fresh"))), 1, K).alias("edges"))


def meetings(graph: DataFrame, length: int) -> DataFrame:
    """(u, v, d): nodes that met at a common neighbour and are nearer than the farthest edge of u."""
    edge = graph.select(F.col("idx").alias("w"), F.explode("edges").alias("e")).select("w", "e.v", "e.fresh")
    back = Window.partitionBy("v").orderBy(F.col("fresh").desc(), F.xxhash64("w", "v"), "w")
    reverse = edge.withColumn("_r", F.row_number().over(back)).filter(F.col("_r") <= REVERSE) \
        .select(F.col("v").alias("host"), F.col("w").alias("guest"), "fresh")
    guests = edge.select(F.col("w").alias("host"), F.col("v").alias("guest"), "fresh").unionByName(reverse)
    sent = guests.groupBy("guest", F.floor(F.col("host") / BUCKET).cast("long").alias("bucket")) \
        .agg(F.collect_list("host").alias("hosts"), F.collect_list("fresh").alias("fresh"))
    farthest = F.when(F.size("edges") < K, F.lit(float("inf"))).otherwise(F.element_at("edges", -1)["d"])
    travelling = sent.join(graph.select(F.col("idx").alias("guest"), "code", farthest.alias("limit")), "guest")

    def meet(table: pa.Table) -> pa.Table:
        guest, limit = table["guest"].to_numpy(), table["limit"].to_numpy()
        x = codes_matrix(table["code"], length)
        hosts = table["hosts"].combine_chunks()
        row = np.repeat(np.arange(len(guest)), np.diff(hosts.offsets.to_numpy()))
        host = hosts.flatten().to_numpy()
        fresh = table["fresh"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        by = np.lexsort((~fresh, row, host))
        host, row, fresh = host[by], row[by], fresh[by]
        first = np.r_[True, (host[1:] != host[:-1]) | (row[1:] != row[:-1])][:len(host)]
        host, row, fresh = host[first], row[first], fresh[first]
        ends = np.flatnonzero(np.r_[host[1:] != host[:-1], True][:len(host)]) + 1
        us, vs, ds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for a, b in zip(np.r_[0, ends[:-1]], ends):
            f = fresh[a:b]
            if b - a < 2 or not f.any():
                continue
            g = row[a:b]
            d = distances(x[g], x[g])
            d[~(f[:, None] | f[None])] = np.inf
            np.fill_diagonal(d, np.inf)
            if b - a > K + 1:
                far = np.partition(d, K - 1, axis=1)[:, K - 1]
                i, j = np.nonzero((d < limit[g][:, None]) & (d <= far[:, None]))
            else:
                i, j = np.nonzero(d < limit[g][:, None])
            us.append(guest[g[i]])
            vs.append(guest[g[j]])
            ds.append(d[i, j])
        return edge_table(np.concatenate(us), np.concatenate(vs), np.concatenate(ds))

    return travelling.groupBy("bucket").applyInArrow(meet, "u long, v long, d double")


def build_graph(rows: DataFrame, length: int, k: int) -> Index:
    """The index of usable rows of one length (vec_id, vec)."""
    mean, most = column_means(rows, length)
    scale = most if most > 1e15 or most < 1e-15 else 1.0
    nodes = written(ordered_nodes(node_table(rows, k), length, mean, scale, 1, "ann-order"), "ann-nodes")
    n = nodes.count()
    runs = [nodes.select(F.col("idx").alias("at"), "n", "idx", "code")]
    for order in range(1, ORDERS):
        again = ordered_nodes(nodes.select(F.col("idx").alias("node"), "vec"), length, mean, scale, 1 + order, "ann-order")
        runs.append(again.select(F.col("idx").alias("at"), "n", F.col("node").alias("idx"), "code"))
    first = reduce(DataFrame.unionByName, [run_pairs(r, length) for r in runs]).withColumn("fresh", F.lit(True))
    keep = nodes.select("idx", "code")
    graph = written(with_edges(keep, nearest_edges(first)), "ann-graph")
    for _ in range(ITERATIONS):
        old = graph.select(F.col("idx").alias("u"), F.explode("edges").alias("e")).select("u", "e.v", "e.d", F.lit(False).alias("fresh"))
        found = meetings(graph, length).withColumn("fresh", F.lit(True))
        graph = written(with_edges(keep, nearest_edges(old.unionByName(found))), "ann-graph")
        new = graph.agg(F.sum(F.size(F.filter("edges", lambda e: e["fresh"]))), F.sum(F.size("edges"))).first()
        if not new[1] or new[0] < LEAST_NEW * new[1]:
            break
    return Index(nodes.select("idx", "vec", "ids"), graph, n)


def with_edges(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Every node with its edges; a node alone has none."""
    none = F.array().cast("array<struct<d:double,v:bigint,fresh:boolean>>")
    return nodes.join(found.withColumnRenamed("u", "idx"), "idx", "left").withColumn("edges", F.coalesce("edges", none))


# -- search ------------------------------------------------------------------------------------------------------
def adjacency(graph: DataFrame) -> DataFrame:
    """(idx, near): forward neighbours, and up to REVERSE reverse ones, the nearest first."""
    edge = graph.select(F.col("idx").alias("w"), F.explode("edges").alias("e")).select("w", "e.v", "e.d")
    back = edge.withColumn("_r", F.row_number().over(Window.partitionBy("v").orderBy("d", "w"))).filter(F.col("_r") <= REVERSE)
    both = edge.select(F.col("w").alias("idx"), F.col("v").alias("other")).unionByName(back.select(F.col("v").alias("idx"), F.col("w").alias("other")))
    return both.groupBy("idx").agg(F.collect_set("other").alias("near"))


def measure(wanted: DataFrame, nodes: DataFrame, length: int) -> DataFrame:
    """(q, v, d) for wanted (q, code, v): a query's vector goes once to each bucket where it wants nodes."""
    asked = wanted.groupBy("q", F.floor(F.col("v") / SEARCH_BUCKET).cast("long").alias("bucket")).agg(F.collect_set("v").alias("vs"), F.first("code").alias("code"))
    held = nodes.select(F.floor(F.col("idx") / SEARCH_BUCKET).cast("long").alias("bucket"), "idx", F.col("code").alias("node_code"))

    def measured(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"q": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "d": pa.array([], pa.float64())})
        idx = right["idx"].to_numpy()
        by = np.argsort(idx)
        idx, x = idx[by], codes_matrix(right["node_code"], length)[by]
        y, q = codes_matrix(left["code"], length), left["q"].to_numpy()
        qs, vs, ds = [], [], []
        for i, wants in enumerate(left["vs"].to_pylist()):
            v = np.array(wants, np.int64)
            near = x[np.searchsorted(idx, v)] - y[i]
            qs.append(np.full(len(v), q[i]))
            vs.append(v)
            ds.append((near * near).sum(axis=1))
        return pa.table({"q": np.concatenate(qs), "v": np.concatenate(vs), "d": np.concatenate(ds)})

    return asked.groupBy("bucket").cogroup(held.groupBy("bucket")).applyInArrow(measured, "q long, v long, d double")


def search(index: Index, queries: DataFrame, length: int) -> DataFrame:
    """(q, v, d): the BEAM nearest nodes found of each query.  queries: q (distinct), code, start (nodes to begin at)."""
    near = written(adjacency(index.graph), "ann-near")
    nodes = index.graph.select("idx", "code")
    wanted = queries.select("q", "code", F.explode("start").alias("v"))
    beam: DataFrame | None = None
    while True:
        seen = measure(wanted, nodes, length).withColumn("expanded", F.lit(False))
        if beam is not None:
            seen = seen.unionByName(beam.select("q", F.explode("beam").alias("b")).select("q", "b.v", "b.d", "b.expanded"))
        once = seen.repartition("q").groupBy("q", "v").agg(F.min("d").alias("d"), F.max("expanded").alias("expanded"))
        kept = once.groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "v", "expanded"))), 1, BEAM).alias("beam"))
        front = F.transform(F.slice(F.filter("beam", lambda b: ~b["expanded"]), 1, EXPAND), lambda b: b["v"])
        kept = kept.withColumn("front", front)
        marked = F.transform("beam", lambda b: F.struct(b["d"].alias("d"), b["v"].alias("v"), (b["expanded"] | F.array_contains("front", b["v"])).alias("expanded")))
        beam = written(kept.withColumn("beam", marked), "ann-beam")
        live = beam.filter(F.size("front") > 0)
        if live.isEmpty():
            return beam.select("q", F.explode("beam").alias("b")).select("q", "b.v", "b.d")
        known = F.transform("beam", lambda b: b["v"])
        step = live.select("q", known.alias("known"), F.explode("front").alias("idx")).join(near, "idx") \
            .select("q", F.explode(F.array_except("near", "known")).alias("v")).distinct()
        wanted = step.join(queries.select("q", "code"), "q")


def nearest_rows(df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found of every row that is_query (a condition on ``vec_id``)."""
    rows = written(usable(df, vec_id, vector), "ann-rows")
    spark = df.sparkSession
    results = [spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")]
    for length in sorted(r[0] for r in rows.select(F.size("vec")).distinct().collect()):    # one number a length
        results.append(rows_of_length(rows.filter(F.size("vec") == length), length, is_query, k))
    return reduce(DataFrame.unionByName, results)


def euclidean(a: Column, b: Column) -> Column:
    """Distance in double precision; differences whose squares leave the range of doubles are scaled first."""
    def length(scale: Column | float) -> Column:
        squares = F.zip_with(a, b, lambda x, y: (x - y) / scale * ((x - y) / scale))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)) * scale

    plain = F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    most = F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))
    return F.when((plain > 1e150) | ((plain < 1e-150) & (most > 0)), length(most)).otherwise(plain)


def rows_of_length(rows: DataFrame, length: int, is_query: Column, k: int) -> DataFrame:
    index = build_graph(rows, length, k)
    asking = rows.filter(is_query).distinct().join(index.nodes.select("vec", F.col("idx").alias("q")), "vec").select("q", "vec_id")
    asking = written(asking, "ann-queries")
    start = asking.select("q").distinct().join(index.graph.withColumnRenamed("idx", "q"), "q")
    start = start.select("q", "code", F.concat(F.array("q"), F.transform("edges", lambda e: e["v"])).alias("start"))
    found = search(index, written(start, "ann-start"), length)
    w = Window.partitionBy("q")
    best = found.withColumn("_r", F.row_number().over(w.orderBy("d", "v"))).filter((F.col("_r") <= max(EXACT, k + 1)) | (F.col("v") == F.col("q")))
    nodes = index.nodes
    pairs = best.select("q", "v").join(nodes.select(F.col("idx").alias("v"), F.col("vec").alias("other"), "ids"), "v") \
        .join(nodes.select(F.col("idx").alias("q"), "vec"), "q")
    rows_found = pairs.select("q", euclidean(F.col("vec"), F.col("other")).alias("score"), F.explode("ids").alias("vec_id"))
    short = rows_found.withColumn("_r", F.row_number().over(w.orderBy("score", "vec_id"))).filter(F.col("_r") <= k + 1)
    lists = short.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("found"))
    own = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    out = asking.withColumnRenamed("vec_id", "query_id").join(lists, "q").select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
