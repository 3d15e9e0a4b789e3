"""Near-duplicate groups by a chosen-path set similarity join.

Each tree sends a document down the path of its minwise tokens: at every
level a node's documents branch by the token that the level's hash function
chooses. Nodes of at most ``NODE`` documents are compared exhaustively, larger
ones branch again; ``TREES`` independent trees bring the recall of a pair at
the threshold above 0.9999 for paths of ``FIRST`` levels (1 - (1 - 0.8^3)^16).
Nodes that are still large after ``LEVELS`` levels hold texts that are all
alike and are dealt into random parts of about ``NODE``, anew in each tree.

Documents with the same set are one member. In a node, members are compared
by their signatures (``TREES * LEVELS`` minwise bytes). In the first ``SEEDS``
trees only a maximum spanning forest of the pairs that may be links is
confirmed on the full sets, which joins most groups at one pair a member. Then
every tree's nodes are compared again for pairs between different groups:
members with such a pair meet inside their node, where each brings its full
set once, and candidates are confirmed, the most alike first, until two groups
are one or none is left. Only links leave a node, so no stage's rows grow with
the square of a group. Nodes that are large at level ``FIRST`` lose links by
branching on; they are met whole, block by block, the members outside the
largest group with all of the node.

Groups are the connected components of the confirmed links (alternating large
and small stars). Hot sets, nodes and hubs are pre-aggregated or joined
through written tables, whose skewed partitions adaptive execution splits.

Edge cases: a null or empty text has no shingles and is linked with nothing;
rows with the same text are one group; a null id takes part but never names a
group, and a group without any id has none; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .shingles import mix, shingle_sets
from .tokens import text_blocks

TREES = 16
SEEDS = 4           # trees whose forests are confirmed first
LEVELS = 8          # levels of a tree with tokens of their own
FIRST = 3           # levels of the shortest path
NODE = 256          # members of a node that is compared exhaustively
BLOCK = 2000        # members of a large node that others meet at once
BLOCK_SHINGLES = 4_000_000  # shingles of them, about
OUTSIDE = 20_000    # members outside of the largest group that meet a block in one task, about
SURELY_NOT = 0.16   # signatures that agree on this much less than the threshold can't be links (5 sigma)
_RNG = np.random.default_rng(977)
_MULTIPLY = _RNG.integers(0, 2**63, TREES * LEVELS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**64, TREES * LEVELS, dtype=np.uint64)
SKETCH = "doc_id long, text_key long, n_shingles long, set_id long, paths array<long>, signature binary"


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The least hash of a set under each of the ``TREES * LEVELS`` functions."""
    least = np.full(TREES * LEVELS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        least = np.minimum(least, (shingles[at:at + 1024, None] * _MULTIPLY + _ADD).min(0))
    return least


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Set size and identity, first path and signature of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64()),
                        ("paths", pa.list_(pa.int64())), ("signature", pa.binary())])
    tree = np.arange(TREES, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts, keys = (batch.column(i).to_pylist() for i in range(3))
            for a, b in text_blocks(texts):
                rows: list[list] = [[], [], [], []]
                for s in shingle_sets(texts[a:b], words):
                    least = minwise(s)
                    path = tree.copy()
                    for level in range(FIRST):
                        path = mix(path * np.uint64(31) + least.reshape(TREES, LEVELS)[:, level])
                    rows[0].append(len(s))
                    rows[1].append(int(mix(mix(s).sum(dtype=np.uint64, keepdims=True)).astype(np.int64)[0]) if len(s) else None)
                    rows[2].append(path.astype(np.int64).tolist() if len(s) else None)
                    rows[3].append((mix(least) & np.uint64(0xFF)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                    [doc_ids[a:b], keys[a:b], *rows], schema)], schema=schema)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("k")).mapInArrow(run, SKETCH)


def leaves(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes where the seed trees' branching ends (key, set_id, signature), and every tree's
    nodes at level ``FIRST`` with their size ``n``; two members at least in each."""
    rows = members.select("set_id", F.posexplode("paths").alias("tree", "key"))
    first = _shared(rows, "paths").join(members.select("set_id", "signature"), "set_id")
    first = materialise(first, "nodes")
    live = first.where(F.col("tree") < SEEDS)
    done = [live.where(F.col("n") <= NODE)]
    for level in range(FIRST, LEVELS):
        big = live.where(F.col("n") > NODE)
        if big.isEmpty():
            return _union(done), first
        at = F.col("tree") * LEVELS + level + 1
        branched = big.drop("n").withColumn("key", F.xxhash64("key", F.substring("signature", at, F.lit(1)), F.lit(level)))
        live = materialise(_shared(branched, f"level{level}"), "nodes")
        done.append(live.where(F.col("n") <= NODE))
    # What no token divides any more is dealt into random parts, others in every tree.
    part = F.pmod(F.xxhash64("set_id", "tree"), F.ceil(F.col("n") / NODE))
    done.append(live.where(F.col("n") > NODE).withColumn("key", F.xxhash64("key", part)))
    return _union(done), first


def _shared(rows: DataFrame, name: str) -> DataFrame:
    """Rows whose node has two members at least, with the node's size ``n``."""
    rows = materialise(rows, name)
    sizes = materialise(rows.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"{name}-sizes")
    return rows.join(sizes, rows["key"] == sizes["_key"]).drop("_key")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("key", "set_id", "signature")


def _forest(pairs: np.ndarray, alike: np.ndarray) -> np.ndarray:
    """Pairs of a maximum spanning forest, most alike first."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    chosen = []
    for i in np.argsort(-alike, kind="stable").tolist():
        a, b = root(int(pairs[i, 0])), root(int(pairs[i, 1]))
        if a != b:
            parent[a] = b
            chosen.append(i)
    return pairs[chosen]


def _node_pairs(size: int, cache: dict[int, np.ndarray] = {}) -> np.ndarray:  # noqa: B006 - shared on purpose
    """Index pairs of a node's members."""
    if size not in cache:
        cache[size] = np.stack(np.triu_indices(size, 1), 1)
    return cache[size]


def _by_node(nodes: DataFrame, compare, names: list[str]) -> DataFrame:
    """Rows (two longs) that ``compare(key, ids, roots, signatures, bounds)`` finds in whole nodes, some nodes at a time."""
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows of the node that the last batch ended in

        def answer(columns: tuple, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
            for found in compare(*columns, bounds):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], schema=schema)

        for batch in batches:
            key, ids, roots = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
            signatures = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(len(ids), -1)
            held.append((key, ids, roots, signatures))
            columns = tuple(np.concatenate(c) for c in zip(*held))
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(columns[0])) + 1])
            last = bounds[-1]
            held = [tuple(c[last:] for c in columns)]
            yield from answer(columns, bounds)
        if held:
            columns = tuple(np.concatenate(c) for c in zip(*held))
            yield from answer(columns, np.array([0, len(columns[0])]))

    ordered = nodes.select("key", "set_id", "signature", "root").repartition("key").sortWithinPartitions("key", "set_id")
    return ordered.mapInArrow(run, ", ".join(f"{n} long" for n in names)).distinct()


def _alike(signatures: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Signature bytes that each pair has in common."""
    return np.concatenate([np.zeros(0, np.int64)] + [
        (signatures[p[:, 0]] == signatures[p[:, 1]]).sum(1) for p in (pairs[i:i + 100_000] for i in range(0, len(pairs), 100_000))])


def candidates(nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) to confirm: a spanning forest of each node's pairs that may be links."""
    least = (threshold - SURELY_NOT) * TREES * LEVELS

    def compare(key: np.ndarray, ids: np.ndarray, roots: np.ndarray, signatures: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        for k0 in range(0, len(bounds) - 1, 2000):
            ends = bounds[k0:k0 + 2001]
            parts = [lo + _node_pairs(int(hi - lo)) for lo, hi in zip(ends[:-1], ends[1:]) if hi - lo > 1]
            if not parts:
                continue
            node, pairs = np.repeat(np.arange(len(parts)), [len(p) for p in parts]), np.concatenate(parts)
            alike = _alike(signatures, pairs)
            keep = alike >= least
            pairs, node, alike = pairs[keep], node[keep], alike[keep]
            if len(pairs):
                cuts = np.flatnonzero(np.diff(node)) + 1
                pairs = np.concatenate([p if len(p) == 1 else _forest(p, s)
                                        for p, s in zip(np.split(pairs, cuts), np.split(alike, cuts))])
                yield np.sort(ids[pairs], 1)

    return _by_node(nodes.withColumn("root", F.col("set_id")), compare, ["a", "b"])


def open_members(nodes: DataFrame, threshold: float, groups: DataFrame) -> DataFrame:
    """(node, member): the members of each node that may be linked with a member of another group there."""
    least = (threshold - SURELY_NOT) * TREES * LEVELS

    def compare(key: np.ndarray, ids: np.ndarray, roots: np.ndarray, signatures: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        held: list[np.ndarray] = []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo > 1 and (roots[lo:hi] != roots[lo]).any():
                pairs = lo + _node_pairs(int(hi - lo))
                held.append(pairs[roots[pairs[:, 0]] != roots[pairs[:, 1]]])
            if held and (hi == bounds[-1] or sum(map(len, held)) > 100_000):
                pairs = np.concatenate(held)
                found = np.unique(pairs[_alike(signatures, pairs) >= least])
                held = []
                if len(found):
                    yield np.stack([key[found], ids[found]], 1)
        if held:
            pairs = np.concatenate(held)
            found = np.unique(pairs[_alike(signatures, pairs) >= least])
            if len(found):
                yield np.stack([key[found], ids[found]], 1)

    rooted = nodes.join(groups, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    return _by_node(rooted, compare, ["node", "member"])


class Block:
    """Members of one block of a node, with full sets, and the groups that links join."""

    def __init__(self, rows: pa.Table, threshold: float):
        self.percent, self.least = round(threshold * 100), (threshold - SURELY_NOT) * TREES * LEVELS
        self.ids, self.label = rows["set_id"].to_numpy(), rows["root"].to_numpy().copy()
        self.main = rows["main"].to_numpy()
        self.paths = np.array(rows["paths"].to_pylist(), np.int64)
        self.signatures = np.ascontiguousarray(_signatures(rows).T)
        sets = rows["shingles"].to_pylist()
        self.sizes = np.array([len(s) // 8 for s in sets])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.known, self.codes = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)
        self.joined: dict[int, int] = {}

    def group(self, root: int) -> int:
        while root in self.joined:
            root = self.joined[root]
        return root

    def shared(self, members: np.ndarray, held: np.ndarray) -> np.ndarray:
        """How many shingles of each of ``members`` are marked in ``held``."""
        sizes = self.sizes[members]
        first = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[members] - first, sizes) + np.arange(sizes.sum())
        return np.add.reduceat(held[self.codes[at]].astype(np.int64), first)

    def meet(self, rows: pa.Table) -> list[tuple[int, int]]:
        """Links of ``rows`` to the block's members of other groups, at least one for each two groups
        that are linked: the most alike are confirmed first, until both are of one group or
        no candidate is left."""
        ids, roots, trees = (rows[c].to_numpy() for c in ("set_id", "root", "tree"))
        paths, signatures, sets = np.array(rows["paths"].to_pylist(), np.int64), _signatures(rows), rows["shingles"].to_pylist()
        found = []
        for lo in range(0, len(ids), 64):
            some = signatures[lo:lo + 64]
            alike = np.zeros((len(some), len(self.ids)), np.uint8)  # TREES * LEVELS at most
            for k, row in enumerate(self.signatures):
                alike += row[None, :] == some[:, k, None]
            for i, near in enumerate(alike, lo):
                group = self.group(int(roots[i]))
                # Two members outside of the largest group meet once, in the first tree they share a node of.
                left = np.flatnonzero((near >= self.least) & (self.label != group) & (self.main | (self.ids > ids[i])))
                left = left[~(self.paths[left, :trees[i]] == paths[i, :trees[i]]).any(1)]
                if not len(left):
                    continue
                left = left[np.argsort(-near[left].astype(np.int64), kind="stable")]
                own = np.frombuffer(sets[i], np.uint64)
                at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
                held = np.zeros(len(self.known), bool)
                held[at[self.known[at] == own]] = True
                take = 8
                while len(left):
                    now, left = left[:take], left[take:]
                    common = self.shared(now, held)
                    for j in now[100 * common >= self.percent * (self.sizes[now] + len(own) - common)]:
                        other = int(self.label[j])
                        if other != group:
                            found.append((min(int(ids[i]), int(self.ids[j])), max(int(ids[i]), int(self.ids[j]))))
                            self.joined[group] = other
                            self.label[self.label == group] = other
                            group = other
                    left, take = left[self.label[left] != group], min(4 * take, 512)
        return found


def _signatures(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint8).reshape(len(rows), -1)


def full_sets(texts: DataFrame, words: int) -> DataFrame:
    """(set_id, shingles): the hashes of each set as bytes."""
    schema = pa.schema([("set_id", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column(0), batch.column(1).to_pylist()
            for a, b in text_blocks(found):
                sets = [s.tobytes() for s in shingle_sets(found[a:b], words)]
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(sets, pa.binary())], schema=schema)

    return texts.select("set_id", "text").mapInArrow(run, "set_id long, shingles binary")


def stragglers(large: DataFrame, members: DataFrame, groups: DataFrame, docs: DataFrame, words: int, threshold: float) -> DataFrame:
    """Links (a, b) between different groups of a node: its members outside of the
    largest group meet all of the node, and every candidate is confirmed on the full
    sets until its two groups are one."""
    rooted = (large.select("set_id", "tree", "key", "signature").join(members.select("set_id", "paths", "n_shingles"), "set_id")
              .join(groups, "set_id", "left").withColumn("root", F.coalesce("root", "set_id")))
    rooted = materialise(rooted, "large-nodes")
    sizes = materialise(rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("held"), F.sum("n_shingles").alias("size")), "node-groups")
    mixed = sizes.groupBy(F.col("key").alias("_key")).agg(
        F.max(F.struct("held", "root")).alias("m"), F.sum("held").alias("n"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("roots"))
    mixed = materialise(mixed.where("roots > 1").select(
        "_key", F.col("m.root").alias("_main"), F.ceil(F.greatest(F.col("n") / BLOCK, F.col("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
        F.ceil((F.col("n") - F.col("m.held")) / OUTSIDE).cast("int").alias("parts")), "mixed-nodes")
    rows = materialise(rooted.join(mixed, rooted["key"] == mixed["_key"]).withColumn("main", F.col("root") == F.col("_main")), "mixed-members")
    wanted = rows.select(F.col("set_id").alias("a"), F.col("set_id").alias("b"))
    # The same joins whatever the number of members met.
    rows = rows.join(materialise(full_sets(_texts(docs, members, wanted), words), "sets").hint("merge"), "set_id")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n: F.pmod(F.xxhash64("set_id", F.lit(n)), F.col(n)).cast("int")
    columns = ["key", "block", "part", "outside", "set_id", "root", "main", "tree", "signature", "paths", "shingles"]
    inside = rows.withColumn("block", dealt("blocks")).withColumn("part", every("parts")).withColumn("outside", F.lit(False))
    outside = rows.where("not main").withColumn("part", dealt("parts")).withColumn("block", every("blocks")).withColumn("outside", F.lit(True))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, block = None, [], None
        for batch in batches:
            key, at, part, out = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(at) != 0) | (np.diff(part) != 0) | (out[1:] != out[:-1])) + 1
            for a, b in zip(np.append(0, cuts), np.append(cuts, len(key))):
                if (key[a], at[a], part[a]) != current:
                    current, held, block = (key[a], at[a], part[a]), [], None
                piece = pa.Table.from_batches([batch.slice(a, b - a)])
                if not out[a]:
                    held.append(piece)
                elif held:
                    block = block or Block(pa.concat_tables(held), threshold)
                    found = block.meet(piece)
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)

    ordered = (inside.select(*columns).unionByName(outside.select(*columns)).repartition("key", "block", "part")
               .sortWithinPartitions("key", "block", "part", "outside"))
    return ordered.mapInArrow(run, "a long, b long").distinct()


def confirm(pairs: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """The pairs that are links: Jaccard similarity of the full shingle sets against the threshold."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    percent = round(threshold * 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = (batch.column(i).to_pylist() for i in range(4))
            for lo, hi in text_blocks(left):
                one, two = shingle_sets(left[lo:hi], words), shingle_sets(right[lo:hi], words)
                linked = []
                for s, t in zip(one, two):
                    both = np.concatenate([s, t])
                    both.sort()
                    common = int((both[1:] == both[:-1]).sum())
                    linked.append(100 * common >= percent * (len(both) - common))
                yield pa.RecordBatch.from_arrays([pa.array(c[lo:hi], pa.int64()).filter(pa.array(linked, pa.bool_())) for c in (a, b)], schema=schema)

    left = texts.select(F.col("set_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("set_id").alias("b"), F.col("text").alias("text_b"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(run, "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """(set_id, root): the least member of each connected component with a link.

    Alternating large and small stars; every round's tables are written, so
    the hub of a star is only a skewed partition of a plain join.
    """
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialise(both.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m")).select("x", F.least("x", "m").alias("m")), "large")
        large = materialise(both.join(low, both["u"] == low["x"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "stars")
        low = materialise(large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m")), "small")
        moved = (large.join(low, large["u"] == low["x"]).where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = materialise(moved.unionByName(low.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == seen:
            break
        seen = state
    return edges.select(F.col("u").alias("set_id"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("set_id"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id (least id reachable), kept and text_key, one row per row of ``docs``."""
    sketched = materialise(sketches(docs, words), "sketches")
    members = sketched.where("n_shingles > 0").dropDuplicates(["set_id"])
    members = materialise(members, "members")
    nodes, first = leaves(members)
    pairs = materialise(candidates(nodes, threshold), "pairs")
    links = materialise(confirm(pairs, _texts(docs, members, pairs), words, threshold), "links")
    groups = materialise(components(links), "groups")
    found = materialise(open_members(first.where(F.col("n") <= NODE), threshold, groups), "open-members")
    met = first.join(found, (first["key"] == found["node"]) & (first["set_id"] == found["member"]), "left_semi")
    met = materialise(met.unionByName(first.where(F.col("n") > NODE)), "met")
    if not met.isEmpty():
        more = materialise(stragglers(met, members, groups, docs, words, threshold), "more-links")
        if not more.isEmpty():
            stars = groups.where("set_id <> root").select(F.col("set_id").alias("a"), F.col("root").alias("b"))
            groups = components(stars.unionByName(more))
    rooted = _with_roots(sketched, materialise(groups, "roots"))
    names = materialise(rooted.where("root is not null").groupBy(F.col("root").alias("_root")).agg(F.min("doc_id").alias("name")), "names")
    named = rooted.join(names, rooted["root"] == names["_root"], "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("name"))
    return named.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "text_key")


def keep_one(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """One document of each group, with all its columns; documents without an id stay if their group has none."""
    found = materialise(near_duplicates(docs, words, threshold), "near-duplicates")
    keep = found.where("kept or (doc_id is null and component_id is null)").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    kept = docs.join(keep, docs["doc_id"].eqNullSafe(keep["_id"]) & (F.xxhash64(docs["text"]) == keep["_key"]), "left_semi")
    repeated = keep.where("_id is not null").groupBy("_id", "_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():
        return kept
    named = kept.where("doc_id is not null").withColumn("__key", F.xxhash64("text")).dropDuplicates(["doc_id", "__key"])
    return named.drop("__key").unionByName(kept.where("doc_id is null"))


def _with_roots(sketched: DataFrame, groups: DataFrame) -> DataFrame:
    base = sketched.select("doc_id", "text_key", "n_shingles", "set_id")
    renamed = groups.select(F.col("set_id").alias("_set"), F.col("root").alias("_root"))
    return materialise(base.join(renamed, base["set_id"] == renamed["_set"], "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("_root", "set_id").alias("root")), "rooted")


def _texts(docs: DataFrame, members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(set_id, text) of every set that occurs in ``pairs``."""
    ids = pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct()
    wanted = materialise(members.join(ids, "set_id").select("set_id", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")), "wanted")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("k"), "text")
    return materialise(keyed.join(wanted.hint("merge"), (F.col("k") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
                       .select("set_id", "text"), "texts")

