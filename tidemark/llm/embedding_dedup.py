"""Near-duplicate vectors by NN-descent on a neighbour graph.

Vectors that are equal are one node. Each node starts with the neighbours it
meets in short runs of vectors sorted by hyperplane codes; then neighbours of a
common neighbour are compared, and every list keeps its best, and its best
outside the node's component. Links over the threshold join nodes into
components. As a link inside a component takes no place of one that leads out,
a list full of links hides no component; n_links is counted in the whole
component: members near its centre are linked to each other by the triangle
inequality and are counted, the others are compared in blocks. Each further
round sorts by codes of its own and looks for links between components alone. A
fresh bounded sample of vectors is compared with all of them after each round.
The rounds end when one finds no link and the sample's are found; if rounds find
none although the sample shows that there are, the search fails.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.tables import bound_batches, cut

#: Centres of up to this many components are sent to all executors (8 bytes a dimension each); more are joined by shuffle.
BROADCAST_CENTRES = 1 << 12

@dataclass(frozen=True)
class Settings:
    threshold: float = 0.93
    neighbours: int = 6
    #: Sort orders of a round at least (see ``orders_for``), bits of each code, and vectors in a run.
    orders: int = 6
    bits: int = 24
    run: int = 128
    #: Members of a common neighbour that are compared with each other at a time; others a member keeps of them.
    local: int = 64
    taken: int = 3
    #: Members of a component compared with each other at a time.
    block: int = 512
    #: Vectors of the audit (they go to all executors), the share of its links to find for the mean vector and
    #: for that of each class by number of links, vectors that make a class, and rounds that may find no link before.
    audited: int = 500
    recall: float = 0.99
    least_class: int = 30
    stalled: int = 4


def orders_for(nodes: int, s: Settings) -> int:
    """Orders in which a pair at the threshold shares a run's code prefix at least once with a chance of ``recall``."""
    same_bit = 1 - math.acos(s.threshold) / math.pi
    shared = same_bit ** min(s.bits, max(0.0, math.log2(max(nodes, 1) / s.run)))
    return max(s.orders, math.ceil(math.log(1 - s.recall) / math.log(1 - shared)) if shared < 1 else 1)


def _planes(dimensions: int, orders: int, bits: int, turn: int) -> np.ndarray:
    return np.random.default_rng([dimensions, turn]).standard_normal((dimensions, orders * bits))


def _matrix(blobs: list[bytes], width: int) -> np.ndarray:
    """Unit vectors in double precision."""
    x = np.frombuffer(b"".join(blobs), f"<f{width}").reshape(len(blobs), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nodes_of(vectors: DataFrame, width: int) -> DataFrame:
    """(id, space, same, vec) of the vectors that can be linked; a space is a label and a number of dimensions."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            raw = lists.flatten().to_numpy(zero_copy_only=False).astype(f"<f{width}") + 0.0  # one kind of zero
            ends = np.cumsum(lists.value_lengths().to_numpy()).tolist()
            blobs = [raw[a:b].astype(f"<f{width}").tobytes() for a, b in zip([0, *ends], ends)]
            same = [hashlib.blake2b(b, digest_size=16).digest() for b in blobs]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("space"), pa.array(same, pa.binary()), pa.array(blobs, pa.binary())], names=["id", "space", "same", "vec"])

    bound_batches(vectors.sparkSession)
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.where("id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(good)
    rows = rows.select("id", F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string")).alias("space"), "embedding")
    return rows.mapInArrow(task, f"id {rows.schema['id'].dataType.simpleString()}, space string, same binary, vec binary")


def _runs(batches: Iterator[pa.RecordBatch], key: list[str], most: int) -> Iterator[tuple[dict, dict[str, list]]]:
    """Rows with equal keys that follow each other, ``most`` at a time."""
    held: dict[str, list] | None = None
    now: tuple | None = None
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        keys = list(zip(*(columns[k] for k in key), strict=True))
        at = 0
        while at < len(keys):
            if held is None or keys[at] != now or len(held[key[0]]) >= most:
                if held is not None:
                    yield dict(zip(key, now, strict=True)), held
                held, now = {n: [] for n in columns}, keys[at]
            end = at
            while end < len(keys) and keys[end] == now and end - at < most - len(held[key[0]]):
                end += 1
            for n, values in columns.items():
                held[n].extend(values[at:end])
            at = end
    if held is not None:
        yield dict(zip(key, now, strict=True)), held


def _pairs_out(ids: list[tuple[int, int, float, bool]]) -> pa.RecordBatch:
    a, b, s, out = zip(*ids, strict=True) if ids else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64()), pa.array(out, pa.bool_())], names=["a", "b", "cosine", "out"])


def _best_of(rows: dict[str, list], width: int, most: int, least: float | None) -> list[tuple[int, int, float, bool]]:
    """For every vector of a run, the most similar others of it, and those outside its component.

    With ``least``, only those outside that are at least so similar.
    """
    ids = rows["id"]
    if len(ids) < 2:
        return []
    component = np.array(rows["component"])
    outside = component[:, None] != component[None]
    if least is not None and not outside.any():
        return []
    x = _matrix(rows["vec"], width)
    cosine = x @ x.T
    np.fill_diagonal(cosine, -2)
    k = min(most, len(ids) - 1)
    found: set[tuple[int, int, float, bool]] = set()
    for seen in [np.where(outside, cosine, -2)] + ([cosine] if least is None else []):
        best = np.argpartition(-seen, k - 1, axis=1)[:, :k]
        i, j = np.repeat(np.arange(len(ids)), k), best.ravel()
        good = seen[i, j] >= (-1.5 if least is None else least)
        i, j = i[good], j[good]
        found.update((ids[p], ids[q], c, o) for p, q, c, o in zip(i.tolist(), j.tolist(), cosine[i, j].tolist(), outside[i, j].tolist()) if ids[p] != ids[q])
    return list(found)


def _compare(sorted_rows: DataFrame, key: list[str], width: int, run: int, taken: int, least: float | None = None) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, float, bool]] = []
        for _, rows in _runs(batches, key, run):
            out += _best_of(rows, width, taken, least)
            if len(out) > 20_000:
                yield _pairs_out(out)
                out = []
        yield _pairs_out(out)

    return sorted_rows.mapInArrow(task, "a long, b long, cosine double, out boolean")


def _shortened(edges: DataFrame, most: int) -> DataFrame:
    """The best neighbours of every node and the best outside its component, each once."""
    each = F.struct((-F.col("cosine")).alias("far"), "b")
    found = edges.groupBy("a").agg(F.collect_set(each).alias("all"), F.collect_set(F.when(F.col("out"), each)).alias("others"))
    best = F.array_union(F.slice(F.array_sort("all"), 1, most), F.slice(F.array_sort("others"), 1, most))
    return found.select("a", F.explode(best).alias("x")).select("a", "x.b", (-F.col("x.far")).alias("cosine"))


def in_runs(nodes: DataFrame, width: int, s: Settings, orders: int, turn: int, least: float | None = None) -> DataFrame:
    """(a, b, cosine, out) from runs of the sort orders of a turn; a run never crosses spaces. ``nodes`` has component."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list[int]] = {}
            for i, blob in enumerate(batch.column("vec").to_pylist()):
                by_size.setdefault(len(blob), []).append(i)
            for rows in by_size.values():
                part = batch.take(pa.array(rows))
                x = _matrix(part.column("vec").to_pylist(), width)
                bits = (x @ _planes(x.shape[1], orders, s.bits, turn) > 0).reshape(len(rows), orders, s.bits)
                codes = bits @ (1 << np.arange(s.bits, dtype=np.int64))
                for order in range(orders):
                    columns = [part.column("space"), pa.array(np.full(len(rows), order, np.int32)), pa.array(codes[:, order]), *(part.column(c) for c in ("id", "component", "vec"))]
                    yield pa.RecordBatch.from_arrays(columns, names=["space", "order", "code", "id", "component", "vec"])

    coded = nodes.select("id", "component", "space", "vec").mapInArrow(task, "space string, order int, code long, id long, component long, vec binary")
    # vectors with equal codes lie in another order each time
    by = ["space", "order", "code", F.xxhash64("id", "order", F.lit(turn)), "id"]
    ordered = cut(coded, "codes").repartitionByRange(*by).sortWithinPartitions(*by)
    return _compare(ordered, ["space", "order"], width, s.run, s.neighbours, least)


def descend(graph: DataFrame, nodes: DataFrame, width: int, s: Settings, turn: int) -> DataFrame:
    """One round: all that have a neighbour in common, or are neighbours, are compared; lists keep the best."""
    members = graph.select(F.col("b").alias("centre"), F.col("a").alias("id")).unionAll(graph.select(F.col("a").alias("centre"), F.col("b").alias("id")))
    members = members.unionAll(nodes.select(F.col("id").alias("centre"), "id")).distinct().join(nodes.select("id", "component", "vec"), "id")
    members = cut(members.select("centre", "id", "component", "vec"), "members")
    # a node that many have as neighbour is dealt out to several tasks, and compared part by part, with other parts each time
    by = ["centre", F.xxhash64("id", F.lit(turn)), "id"]
    ordered = members.repartitionByRange(*by).sortWithinPartitions(*by)
    a, b = (nodes.select(F.col("id").alias(x), F.col("component").alias(f"of_{x}")) for x in "ab")
    before = graph.join(a, "a").join(b, "b").select("a", "b", "cosine", (F.col("of_a") != F.col("of_b")).alias("out"))
    return _shortened(before.unionAll(_compare(ordered, ["centre"], width, s.local, s.taken)), s.neighbours)


def recall_of(links: list[int], found: list[int], s: Settings) -> float:
    """Mean share of a vector's links that was found: the least of that over all vectors and that of each class by number of links."""
    n, shares = np.array(links), np.array(found) / np.maximum(links, 1)
    classes = np.floor(np.log2(np.maximum(n, 1)) / 3)
    groups = [n > 0, *((n > 0) & (classes == c) for c in set(classes.tolist()) if ((n > 0) & (classes == c)).sum() >= s.least_class)]
    return min((float(shares[g].mean()) for g in groups if g.any()), default=1.0)


def audit(nodes: DataFrame, width: int, s: Settings, turn: int = 0) -> tuple[float, DataFrame]:
    """Recall of the links of a turn's sample (against all vectors): those whose ends are in one component. And links (a, b) that were not found.

    ``nodes`` has component.
    """
    sample = nodes.orderBy(F.xxhash64("id", F.lit("audit"), F.lit(turn))).limit(s.audited).select("id", "space", "vec", "component").collect()
    spaces: dict[str, list] = {}
    for r in sample:
        spaces.setdefault(r["space"], []).append((r["id"], bytes(r["vec"]), r["component"]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = {k: (np.array([q[0] for q in v]), _matrix([q[1] for q in v], width), np.array([q[2] for q in v])) for k, v in spaces.items()}
        sums = {k: np.zeros((2, len(v)), np.int64) for k, v in spaces.items()}
        missed: dict[tuple[int, int], int] = {}  # one link of a vector to each component
        for batch in batches:
            space = np.array(batch.column("space").to_pylist(), object)
            blobs, ids, component = batch.column("vec").to_pylist(), batch.column("id").to_numpy(), batch.column("component").to_numpy()
            for k in set(space.tolist()) & set(queries):
                rows = np.flatnonzero(space == k)
                theirs, x, own = queries[k]
                hit = (_matrix([blobs[i] for i in rows], width) @ x.T >= s.threshold) & (ids[rows][:, None] != theirs[None])
                inside = component[rows][:, None] == own[None]
                sums[k] += [hit.sum(axis=0), (hit & inside).sum(axis=0)]
                i, j = np.nonzero(hit & ~inside)
                missed.update(zip(zip(theirs[j].tolist(), component[rows][i].tolist()), ids[rows][i].tolist()))
        a = [i for k in spaces for i in queries[k][0].tolist()]
        n, f = np.concatenate([np.zeros((2, 0), np.int64), *sums.values()], axis=1).tolist()
        m = len(missed)
        columns = [a + [x for x, _ in missed], [None] * len(a) + list(missed.values()), n + [0] * m, f + [0] * m]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "links", "found"])

    told = cut(nodes.select("id", "space", "vec", "component").mapInArrow(task, "a long, b long, links long, found long"), "audit")
    per_vector = told.groupBy("a").agg(F.sum("links").alias("n"), F.sum("found").alias("f")).collect()
    return recall_of([r["n"] for r in per_vector], [r["f"] for r in per_vector], s), told.where("b IS NOT NULL").select("a", "b")


def _counted(rows: dict[str, list], width: int, threshold: float) -> list[tuple[int, int]]:
    """(id, other vectors linked) inside one block of distinct vectors."""
    x = _matrix(rows["vec"], width)
    hit = x @ x.T >= threshold
    np.fill_diagonal(hit, False)
    return list(zip(rows["id"], (hit @ np.array(rows["n"], np.int64)).tolist(), strict=True))


def _sums_out(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["id", "links"])


def _centres(members: DataFrame, width: int) -> DataFrame:
    """(component, centre): mean of the unit vectors, summed in the tasks first."""

    def partly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = _matrix(batch.column("vec").to_pylist(), width) if batch.num_rows else np.zeros((0, 1))
            for c, row in zip(batch.column("component").to_pylist(), x, strict=True):
                sums[c] = sums.get(c, 0) + row
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["component", "sum"])

    parts = members.select("component", "vec").mapInArrow(partly, "component long, sum array<double>").select("component", F.posexplode("sum"))
    return parts.groupBy("component", "pos").agg(F.sum("col").alias("x")).groupBy("component").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("s")).select("component", F.col("s.x").alias("centre"))


def count_links(members: DataFrame, width: int, s: Settings) -> DataFrame:
    """(id, links): how many vectors outside its node each node of a component is linked with, counted exactly.

    ``members`` has component, id, n (equal vectors in the node) and vec.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    sized = cut(members.join(sizes, "component"), "component-members")

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, ["component"], s.block):
            yield _sums_out(_counted(rows, width, s.threshold))

    few = sized.where(F.col("size") <= s.block).repartition("component").sortWithinPartitions("component")
    direct = few.select("component", "id", "n", "vec").mapInArrow(small, "id long, links long")

    # vectors within half the threshold's angle of one direction are all linked to each other
    near = math.cos(math.acos(s.threshold) / 2) + 1e-9

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [batch.column(c) for c in ("component", "size", "id", "n", "vec")]
            if batch.num_rows:
                x = _matrix(batch.column("vec").to_pylist(), width)
                centre = np.array(batch.column("centre").to_pylist(), np.float64)
                core = np.einsum("ij,ij->i", x, centre) >= near * np.linalg.norm(centre, axis=1)
            else:
                core = np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([*keep, pa.array(core)], names=["component", "size", "id", "n", "vec", "core"])

    many = sized.where(F.col("size") > s.block)
    centres = cut(_centres(many, width), "centres")
    if centres.count() <= BROADCAST_CENTRES:
        centres = F.broadcast(centres)
    marked = many.join(centres, "component").select("component", "size", "id", "n", "vec", "centre")
    marked = cut(marked.mapInArrow(split, "component long, size long, id long, n long, vec binary, core boolean"), "cores")
    weights = marked.where("core").groupBy("component").agg(F.sum("n").alias("w"))
    inner = marked.where("core").select("component", "id", "n").join(weights, "component").select("id", (F.col("w") - F.col("n")).alias("links"))
    # those outside the core against all members, a block of each at a time
    outer = marked.where("not core")
    tiles = F.ceil(F.col("size") / (4 * s.block)).cast("int")  # larger than a run, as every vector goes once to each tile
    place = F.pmod(F.xxhash64("id"), tiles).cast("int")
    queries = outer.select("component", "id", "n", "vec", place.alias("tile"), F.explode(F.sequence(F.lit(0), tiles - 1)).alias("against"), F.lit(True).alias("query"), F.lit(False).alias("core"))
    query_tiles = outer.select("component", place.alias("tile")).distinct()
    targets = marked.select("component", "id", "n", "vec", place.alias("against"), F.lit(False).alias("query"), "core").join(query_tiles, "component")
    columns = ["component", "tile", "against", "query", "core", "id", "n", "vec"]
    blocks = queries.select(columns).unionAll(targets.select(columns))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, ["component", "tile", "against"], 1 << 40):
            q = [i for i, x in enumerate(rows["query"]) if x]
            t = [i for i, x in enumerate(rows["query"]) if not x]
            if not q or not t:
                continue
            hit = _matrix([rows["vec"][i] for i in q], width) @ _matrix([rows["vec"][i] for i in t], width).T >= s.threshold
            qid, tid = np.array([rows["id"][i] for i in q]), np.array([rows["id"][i] for i in t])
            qn, tn = np.array([rows["n"][i] for i in q], np.int64), np.array([rows["n"][i] for i in t], np.int64)
            hit &= qid[:, None] != tid[None]
            back = np.array([rows["core"][i] for i in t])  # a member of the core hears of links to those outside it here alone
            yield _sums_out([*zip(qid.tolist(), (hit @ tn).tolist()), *zip(tid[back].tolist(), (hit.T @ qn)[back].tolist())])

    ordered = blocks.repartition("component", "tile", "against").sortWithinPartitions("component", "tile", "against")
    return direct.unionAll(inner).unionAll(ordered.mapInArrow(compare, "id long, links long")).groupBy("id").agg(F.sum("links").alias("links"))


def _joined(named: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component) with the components that links (a, b) join made one, by the graph of components alone."""
    a, b = (named.select(F.col("id").alias(x), F.col("component").alias(f"of_{x}")) for x in "ab")
    bridges = links.join(a, "a").join(b, "b").where("of_a <> of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct()
    bridges = cut(bridges, "bridges")
    if bridges.isEmpty():
        return named
    roots = components(bridges).select(F.col("id").alias("component"), F.col("component").alias("root"))
    return cut(named.join(roots, "component", "left").select("id", F.coalesce("root", "component").alias("component")), "named")


def linked_components(nodes: DataFrame, width: int, s: Settings) -> tuple[DataFrame, float]:
    """(id, component) of all nodes, and the audit's recall. It is an error if that stays below ``s.recall``."""
    named = cut(nodes.select("id", F.col("id").alias("component")), "named")
    count = named.count()
    orders, idle, turn = orders_for(count, s), 0, 0
    graph = missed = None
    while True:
        own = nodes.join(named, "id")
        if graph is None:
            graph = cut(_shortened(in_runs(own, width, s, orders, turn), s.neighbours), "graph")
        else:
            graph = graph.unionAll(cut(in_runs(own, width, s, orders, turn, s.threshold).select("a", "b", "cosine"), "fresh"))
        better = cut(descend(graph, own, width, s, turn), "graph")
        links = graph.unionAll(better).where(F.col("cosine") >= s.threshold).select("a", "b")
        named = _joined(named, links if missed is None else links.unionAll(missed))
        left = named.where("id = component").count()
        recall, missed = audit(nodes.join(named, "id"), width, s, turn)
        idle = idle + 1 if left == count else 0
        if idle and recall >= s.recall:
            return _joined(named, missed), recall
        if idle >= s.stalled:
            raise RuntimeError(f"near-duplicate vectors: rounds find no more links, with a recall of {recall:.4f} below {s.recall}")
        orders *= 1 if recall >= s.recall else 2
        graph, count, turn = better, left, turn + 1


def near_vectors(vectors: DataFrame, settings: Settings = Settings(), key: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(key, n_links, component_id, kept) of every row; kept if it is the least key of its component.

    Vectors are linked if their labels are equal and not null, they have as
    many dimensions, and their cosine in double precision is at least the
    threshold. A vector that is null, empty, all zero, or has a null or
    non-finite component links with nothing and is its own component. Equal
    vectors are linked with each other and share all else. Keys should be whole
    numbers and unique; a row with a null key links with nothing. Other columns
    are left behind, and an empty table gives no rows.
    """
    kind = vectors.schema[embedding].dataType
    width = 4 if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else 8
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(embedding).alias("embedding"), F.col(label).alias("label"))
    usable = cut(nodes_of(rows, width), "vectors")
    groups = usable.groupBy("space", "same").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "vec")).alias("r"))
    nodes = cut(groups.select("space", "same", "n", F.col("r.id").alias("id"), F.col("r.vec").alias("vec")), "nodes")
    named, _ = linked_components(nodes, width, settings)
    alone = named.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("component")
    members = nodes.join(named.join(alone, "component", "left_semi"), "id").select("component", "id", "n", "vec")
    links = count_links(members, width, settings)
    per_node = nodes.select("space", "same", "id", "n").join(named, "id").join(links, "id", "left")
    per_node = per_node.select("space", "same", "component", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    of_usable = usable.select("id", "space", "same").join(per_node, ["space", "same"]).select("id", "n_links", "component")
    joined = rows.select("id").join(of_usable, "id", "left")
    component = F.coalesce("component", "id")
    return joined.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
