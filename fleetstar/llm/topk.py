"""Exact top-k inner-product search over an impact-ordered, score-at-a-time index.

Vectors are made integers; a shard of the index holds, for every component
and each of ``LEVELS`` quantised impact levels, a posting segment: the
shard's rows whose component lies in that level, with the level's bounds.

For a query, a segment's impact is the most that its rows gain in that
component over the component's least gain. Segments are processed by
descending impact, adding to each row's score a lower and an upper bound.
After each batch of segments the least score that can still reach the top is
known (the query's k-th best so far: a bounded probe of the shard scored
exactly, then lower bounds); processing stops once the rows that can still
reach it are proven few, and only those are scored exactly. Rows whose upper
bound equals the threshold stay in, so ties are settled by the smaller id.

Every vector is indexed; nothing is sampled. Queries travel in blocks to
every shard (a stated query set against all rows); a shard answers k rows a
query, and those are ranked once more.

Edge cases: vectors that are null or hold null or non-finite components take
no part; vectors meet only vectors of their own length, and empty ones none; repeated ids are candidates each, but a
query's own id never is; query rows with the same id are answered each, with k rows of their own; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

K = 10
SCALE = 1024
LEVELS = 16              # quantised impacts of a component
SHARD_ROWS = 8192        # expected rows of a shard
BLOCK = 256              # queries that travel together
STEPS = 12               # batches of segments, after each of which the bounds are compared
FEW = 4                  # rows times k that are proven few enough to score exactly


def integer_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and ``v``, floor(scale * x) of each component; incomplete vectors are left out."""
    finite = F.forall("embedding", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return (table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
            .select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v")))


class Shard:
    """Posting segments of a matrix of integer vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        n, dims = rows.shape
        order = np.argsort(rows, axis=0, kind="stable")
        cuts = np.linspace(0, n, LEVELS + 1).astype(int)
        self.segments = []               # component, least and most value, rows
        for d in range(dims):
            for a, b in zip(cuts[:-1], cuts[1:]):
                if b > a:
                    who = order[a:b, d]
                    self.segments.append((d, int(rows[who[0], d]), int(rows[who[-1], d]), who.astype(np.int32)))
        self.component = np.array([s[0] for s in self.segments])
        self.low = np.array([s[1] for s in self.segments], np.int64)
        self.high = np.array([s[2] for s in self.segments], np.int64)
        self.size = np.array([len(s[3]) for s in self.segments])
        self.postings = np.concatenate([s[3] for s in self.segments])
        self.at = np.concatenate([[0], np.cumsum(self.size)])

    def dump(self) -> bytes:
        n, dims = self.rows.shape
        return (struct.pack("<IIQ", n, dims, len(self.segments)) + self.ids.astype("<i8").tobytes() + self.rows.astype("<i8").tobytes()
                + np.stack([self.component, self.low, self.high, self.size]).astype("<i8").tobytes()
                + self.postings.astype("<i4").tobytes())

    @classmethod
    def load(cls, data: bytes) -> "Shard":
        n, dims, segments = struct.unpack_from("<IIQ", data)
        shard, at = cls.__new__(cls), 16
        shard.ids = np.frombuffer(data, "<i8", n, at)
        shard.rows = np.frombuffer(data, "<i8", n * dims, at + 8 * n).reshape(n, dims)
        at += 8 * n * (dims + 1)
        shard.component, shard.low, shard.high, shard.size = np.frombuffer(data, "<i8", 4 * segments, at).reshape(4, segments)
        shard.postings = np.frombuffer(data, "<i4", n * dims, at + 32 * segments)
        shard.at = np.concatenate([[0], np.cumsum(shard.size)])
        return shard

    def search(self, query_id: int, q: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, exact scores) of at least the k best rows other than the query's own."""
        others = self.ids != query_id
        n = int(others.sum())
        if n <= FEW * k:
            rows = np.flatnonzero(others)
            return rows, self.rows[rows] @ q
        weight = q[self.component]
        one, two = weight * self.low, weight * self.high
        least, most = np.minimum(one, two), np.maximum(one, two)
        floor = np.full(len(q), np.iinfo(np.int64).max)
        np.minimum.at(floor, self.component, least)
        base = int(floor.sum())
        gain_low, gain_high = least - floor[self.component], most - floor[self.component]
        order = np.argsort(-gain_high, kind="stable")
        sizes = self.size[order]
        ends = np.cumsum(sizes)
        # A lower bound of the k-th best: rows that lie in the segments of most impact, scored exactly.
        head = np.unique(self.postings[np.concatenate([np.arange(self.at[s], self.at[s + 1]) for s in order[:4]])])
        head = head[others[head]]
        scores = self.rows[head] @ q
        reach = int(np.partition(scores, len(scores) - k)[-k]) if len(scores) >= k else np.iinfo(np.int64).min
        low, high = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), np.int64)
        left = np.zeros(len(q), np.int64)                # most gain left by component
        done, may = 0, np.flatnonzero(others)
        for stop in np.unique(np.searchsorted(ends, np.linspace(0, ends[-1], STEPS + 1)[1:]) + 1):
            part = order[done:stop]
            who = self.postings[np.concatenate([np.arange(self.at[s], self.at[s + 1]) for s in part])]
            times = self.size[part]
            np.add(low, np.bincount(who, np.repeat(gain_low[part], times), len(low)).astype(np.int64), out=low)
            np.add(high, np.bincount(who, np.repeat(gain_high[part], times), len(high)).astype(np.int64), out=high)
            done = int(stop)
            left[:] = 0
            np.maximum.at(left, self.component[order[done:]], gain_high[order[done:]])
            bound = low[others] + base
            reach = max(reach, int(np.partition(bound, n - k)[-k]))
            may = np.flatnonzero(others & (high + int(left.sum()) + base >= reach))   # all others are proven out
            if len(may) <= FEW * k:
                break
        return may, self.rows[may] @ q


def build(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """The index as read back from the shared folder (shard, data), and its number of shards."""
    shards = max(1, -(-vectors.count() // shard_rows))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("dims", F.size("v"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        shard = Shard(pdf["vec_id"].to_numpy(np.int64), np.array(pdf["v"].tolist(), np.int64).reshape(len(pdf), -1))
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "dims": [int(pdf["dims"].iloc[0])], "data": [shard.dump()]})

    index = dealt.where("dims > 0").groupBy("shard", "dims").applyInPandas(run, "shard int, dims int, data binary")
    return materialise(index, "index"), shards


def search(queries: DataFrame, index: DataFrame, shards: int, k: int = K, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best rows."""
    n_blocks = max(1, -(-queries.count() // block))
    packed = (queries.where(F.size("v") > 0).withColumn("row", F.monotonically_increasing_id())
              .groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).alias("block"), F.size("v").alias("dims"))
              .agg(F.collect_list(F.struct("row", "vec_id", "v")).alias("queries")))   # about ``block`` queries each
    # Each block goes to every shard: an equi-join on the shard's number.
    routed = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).repartition("shard")
    schema = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, queries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard.load(data)
                for query in queries:
                    rows, scores = shard.search(query["vec_id"], np.array(query["v"], np.int64), k)
                    best = np.lexsort((shard.ids[rows], -scores))[:k]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), query["row"])), pa.array(np.full(len(best), query["vec_id"])),
                                                      pa.array(shard.ids[rows][best]), pa.array(scores[best])], schema=schema)

    found = routed.join(index, ["shard", "dims"]).select("data", "queries").mapInArrow(run, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
