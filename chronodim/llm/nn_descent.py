"""Embedding near-duplicates: links of cosine >= 0.95 found by NN-descent.

1. Equal vectors become one class with a count.
2. Seeds: the classes are sorted in ``ORDERS`` random orders (signs of random
   projections, then one projection) and meet their next ``NEXT`` neighbours.
3. Cells: classes around a leader, each within half the threshold angle of it, so
   that any two of a cell are surely linked.  A dense group is then a few leaders,
   its inner links are counted without pairs.
4. NN-descent over the leaders: the neighbours of a leader, and those it is a
   neighbour of, meet each other, unless they met before; the nearest ``LIST`` stay.
   A list that is mostly within reach is saturated: its length doubles.  Rounds go
   on until one brings nothing within reach and enlarges no list.  Entries beyond
   three threshold angles lead nowhere near and are not kept.
5. The cells of leaders within reach (threshold angle plus both radii) are
   compared in double precision, in tiles of at most about ``TILE`` by ``TILE``
   members; tiles give counts per member and linked cells, no pairs of members.
6. Components of cells by star steps on written tables.
7. Audit: ``AUDIT`` classes (a fixed bound) meet all classes; below a recall of
   ``RECALL`` the search goes on from the lists with new orders.

Neighbours travel as 16-bit floats; cosines that decide are computed in double
precision from the given components.  Every vector is indexed.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; shorter vectors count as if filled up with zeros;
rows with a null id are left out; rows that share an id are vectors of their own; an empty
table gives none; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronodim.llm.common import column, components, map_arrow, stage, table
from chronodim.plans.session import broadcast_if_small

THRESHOLD = 0.95
ORDERS, NEXT = 10, 4
LIST = 12
ROUNDS = 12      # of a pass; the audit starts another if they didn't do
CHUNK = 64       # neighbours that meet at a time
TILE = 1024
AUDIT = 512
RECALL, PASSES = 0.98, 4
SLACK = 0.004    # of a cosine of 16-bit floats
SURE = 1e-6      # of an angle


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names.split())


def _binaries(x: np.ndarray) -> pa.Array:
    width = x.shape[1] * x.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(x), [None, pa.py_buffer(np.ascontiguousarray(x).tobytes())]).cast(pa.binary())


def _matrix(c: pa.Array, dim: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(c.to_pylist()), kind).reshape(len(c), dim)


def vectors(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """row, vec_id, key (digest) and vec (doubles, scaled by a power of two;
    null where the vector takes no part), and the dimension."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(column(id_col).cast("long").alias("vec_id"), column(vector_col).cast("array<double>").alias("v")).where("vec_id is not null")
    rows = rows.select("vec_id", F.when(finite & F.exists("v", lambda x: x != 0), F.col("v")).alias("v"))
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 0
    dim = max(dim, 1)

    def run(batches):
        for b in batches:
            v = b.column("v")
            n = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(v), 0)).astype(np.int64)
            out = np.zeros((len(v), dim))
            row = np.repeat(np.arange(len(n)), n)
            out[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = np.asarray(v.flatten(), np.float64)
            out = np.ldexp(out, -np.frexp(np.abs(out).max(1))[1][:, None]) + 0.0
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.compute.if_else(pa.array(n > 0), _binaries(out), pa.scalar(None, pa.binary()))], names=["vec_id", "vec"])

    out = map_arrow(rows, run, "vec_id long, vec binary")
    return stage(out.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.unhex(F.sha2("vec", 256)).alias("key"), "vec"), "nn-rows"), dim


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.square(x).sum(1, keepdims=True))


def classes(rows: DataFrame, dim: int) -> DataFrame:
    """cid, key, least (vec_id), n (rows), vec, code (16-bit unit vector)."""
    c = rows.where("vec is not null").groupBy("key").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec"))

    def run(batches):
        for b in batches:
            code = _unit(_matrix(b.column("vec"), dim, np.float64)).astype(np.float16)
            yield pa.RecordBatch.from_arrays([*b.columns, _binaries(code)], names=[*b.schema.names, "code"])

    c = c.select(F.monotonically_increasing_id().alias("cid"), "key", "least", "n", "vec")
    return stage(map_arrow(c, run, "cid long, key binary, least long, n long, vec binary, code binary"), "nn-classes")


def best(entries: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each u, one entry a pair."""
    near = F.row_number().over(W.partitionBy("u").orderBy(F.desc("s"), "v"))
    return entries.groupBy("u", "v").agg(F.max("s").alias("s")).withColumn("at", near).where(F.col("at") <= k).drop("at")


def seeds(c: DataFrame, dim: int, total: int, floor: float, first: int) -> DataFrame:
    """u, v, s: neighbours in ``ORDERS`` random orders, those from ``first`` on."""
    bits = max(1, min(60, math.ceil(math.log2(max(2, total / 16)))))

    def place(batches):
        planes = [np.random.default_rng(t).normal(size=(dim, bits + 1)) for t in range(first, first + ORDERS)]
        powers = 2 ** np.arange(bits, dtype=np.int64)
        for b in batches:
            x = _matrix(b.column("code"), dim, np.float16).astype(np.float64)
            for t, plane in enumerate(planes):
                p = x @ plane
                yield _batch("t sign along cid code", np.full(len(x), t), (p[:, :bits] > 0) @ powers, p[:, bits], b.column("cid"), b.column("code"))

    def meet(batches):
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            t, cid = np.asarray(b.column("t")), np.asarray(b.column("cid"))
            x = _matrix(b.column("code"), dim, np.float16).astype(np.float32)
            if last:
                t, cid, x = (np.concatenate(p) for p in zip(last, (t, cid, x), strict=True))
            old = len(last[0]) if last else 0
            for step in range(1, NEXT + 1):
                a = np.arange(max(0, old - step), len(t) - step)
                s = np.einsum("ij,ij->i", x[a], x[a + step])
                good = (t[a] == t[a + step]) & (s >= floor)
                u, v, s = cid[a[good]], cid[a[good] + step], s[good].astype(np.float64)
                yield _batch("u v s", np.concatenate((u, v)), np.concatenate((v, u)), np.concatenate((s, s)))
            last = (t[-NEXT:], cid[-NEXT:], x[-NEXT:])

    placed = map_arrow(c.select("cid", "code"), place, "t long, sign long, along double, cid long, code binary")
    by = ["t", "sign", "along", "cid"]
    return map_arrow(placed.repartitionByRange(*by).sortWithinPartitions(*by), meet, "u long, v long, s double")


def cosines(pairs: DataFrame, c: DataFrame, dim: int, field: str = "vec") -> DataFrame:
    """``pairs`` (a, b) with s, the cosine of their vectors."""
    kind = np.float64 if field == "vec" else np.float16
    p = pairs.join(c.select(F.col("cid").alias("a"), F.col(field).alias("x")), "a").join(c.select(F.col("cid").alias("b"), F.col(field).alias("y")), "b").select("a", "b", "x", "y")

    def run(batches):
        for b in batches:
            x, y = (_unit(_matrix(b.column(n), dim, kind).astype(np.float64)) for n in ("x", "y"))
            yield _batch("a b s", b.column("a"), b.column("b"), np.einsum("ij,ij->i", x, y))

    return map_arrow(p, run, "a long, b long, s double")


def cells(c: DataFrame, lists: DataFrame, dim: int, angle: float) -> DataFrame:
    """cid, leader, theta (angle to the leader): leaders are the least ids of
    what hangs together closely; what is too far from its leader tries again with
    the others left, and leads itself in the end."""
    half = angle / 2 - SURE
    close = stage(lists.where(F.col("s") >= math.cos(half)).where("u > v").select(F.col("u").alias("hi"), F.col("v").alias("lo")), "nn-close")
    done = None
    for _ in range(3):
        if close.isEmpty():
            break
        group = components(close, "nn-close").where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        near = cosines(group, c, dim).withColumn("theta", F.acos(F.least("s", F.lit(1.0)))).where(F.col("theta") <= half)
        near = stage(near.select(F.col("a").alias("cid"), F.col("b").alias("leader"), "theta"), "nn-cells")
        done = near if done is None else done.union(near)
        gone = stage(near.select("cid").union(near.select("leader")).distinct().withColumnRenamed("cid", "gone"), "nn-gone")
        left = close.join(gone, close.hi == gone.gone, "left_anti")
        close = stage(left.join(gone, left.lo == gone.gone, "left_anti"), "nn-close")
    alone = c.select("cid", F.col("cid").alias("leader"), F.lit(0.0).alias("theta"))
    return stage(alone if done is None else done.union(alone.join(done.select("cid"), "cid", "left_anti")), "nn-cells")


def descend(leaders: DataFrame, lists: DataFrame, dim: int, angle: float, floor: float) -> DataFrame:
    """Rounds of NN-descent over ``leaders`` (cid, code, radius) from ``lists``
    (u, v, s); returns a, b: pairs within reach."""
    radius = leaders.select(F.col("cid").alias("id"), "radius")
    own = [radius.where("radius > 0").withColumnRenamed("id", x).withColumnRenamed("radius", f"r{x}") for x in "uv"]
    reach = F.cos(F.least(F.lit(angle) + F.coalesce("ru", F.lit(0.0)) + F.coalesce("rv", F.lit(0.0)), F.lit(math.pi))) - SLACK
    lists = lists.join(own[0], "u", "left").join(own[1], "v", "left").select(
        "u", "v", "s", F.lit(1).alias("new"), F.lit(LIST).cast("long").alias("k"), (F.col("s") >= reach).alias("within"))
    lists = stage(lists, "nn-lists")
    hubs = None  # centres whose neighbours met in chunks only: they meet again, dealt anew
    for turn in range(ROUNDS):
        if not lists.where("new = 1").limit(1).count():
            break
        both = lists.select("u", "v", "new").union(lists.select(F.col("v"), F.col("u"), "new")).groupBy("u", "v").agg(F.max("new").alias("new"))
        if hubs is not None:
            both = both.join(broadcast_if_small(hubs), "u", "left").select("u", "v", F.coalesce("again", "new").alias("new"))
        both = stage(both, "nn-both")
        sizes = both.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.max("new").alias("any")).where("any = 1 and n > 1")
        sizes = sizes.select("u", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
        hubs = sizes.where("chunks > 1").select("u", F.lit(1).alias("again"))
        full = lists.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k"), F.min("s").alias("last")).where("n >= k").select(F.col("u").alias("v"), "last")
        known = leaders.select(F.col("cid").alias("v"), "code", "radius").join(full, "v", "left")
        met = both.join(sizes, "u").join(known, "v").select("u", F.pmod(F.xxhash64("v", F.lit(turn)), F.col("chunks")).alias("chunk"), "v", "new", "code", "radius", F.coalesce("last", F.lit(-1.0)).alias("last"))

        def meet(batches):
            for u, (v, new, x, r, last) in _groups(batches, dim):
                s = x @ x.T
                i, j = np.triu_indices(len(v), 1)
                near = s[i, j]
                good = ((new[i] + new[j]) > 0) & (near >= floor) & (v[i] != v[j])
                i, j, near = i[good], j[good], near[good]
                within = near >= np.cos(np.minimum(angle + r[i] + r[j], np.pi)) - SLACK
                for a, b in ((i, j), (j, i)):
                    use = within | (near > last[a])
                    yield _batch("u v s within", v[a[use]], v[b[use]], near[use].astype(np.float64), within[use])

        found = map_arrow(met.repartition("u", "chunk").sortWithinPartitions("u", "chunk"), meet, "u long, v long, s double, within boolean")
        # known entries stay as they are, so that only what is new counts as such
        both = lists.select("u", "v", "s", "within", F.lit(0).alias("new"), "k").union(found.select("u", "v", "s", "within", F.lit(1), F.lit(LIST).cast("long")))
        both = both.groupBy("u", "v").agg(F.max("s").alias("s"), F.max("within").alias("within"), F.min("new").alias("new"), F.max("k").alias("k"))
        mine = W.partitionBy("u")
        both = both.withColumn("k", F.max("k").over(mine)).withColumn("inside", F.sum(F.col("within").cast("long")).over(mine))
        both = both.withColumn("k", F.expr("CASE WHEN 4 * inside >= 3 * k THEN k * cast(pow(2, floor(log2(inside * 4 / (3 * k))) + 1) AS long) ELSE k END"))
        both = both.withColumn("at", F.row_number().over(mine.orderBy(F.desc("within"), F.desc("s"), "v"))).where("at <= k")
        lists = stage(both.select("u", "v", "s", "new", "k", "within"), "nn-lists")
        if not lists.where("new = 1 and within").limit(1).count():
            break
    return lists.where("within").select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def _groups(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple]:
    """Chunks of neighbours, at most ``4 CHUNK`` of one centre at a time."""
    held: list = []
    now = None

    def flush():
        v, new, code, r, last = zip(*held, strict=True)
        x = np.frombuffer(b"".join(code), np.float16).reshape(len(code), dim).astype(np.float32)
        return np.array(v), np.array(new), x, np.array(r), np.array(last)

    for b in batches:
        cols = [b.column(n).to_pylist() for n in ("u", "chunk", "v", "new", "code", "radius", "last")]
        for u, chunk, *rest in zip(*cols, strict=True):
            if (u, chunk) != now or len(held) >= 4 * CHUNK:
                if len(held) > 1:
                    yield now, flush()
                held, now = [], (u, chunk)
            held.append(rest)
    if len(held) > 1:
        yield now, flush()


def tiles(pairs: DataFrame, members: DataFrame, dim: int, threshold: float) -> DataFrame:
    """Linked members of the cells in ``pairs`` (a, b): rows (cid, links) with
    the linked rows of a member, and rows (a, b) of linked cells."""
    size = members.groupBy("leader").agg(F.count(F.lit(1)).alias("size"))
    p = pairs.join(size.withColumnRenamed("leader", "a").withColumnRenamed("size", "sa"), "a").join(size.withColumnRenamed("leader", "b").withColumnRenamed("size", "sb"), "b")
    p = p.select(F.expr("CASE WHEN sa >= sb THEN a ELSE b END").alias("big"), F.expr("CASE WHEN sa >= sb THEN b ELSE a END").alias("small"), F.greatest("sa", "sb").alias("most"), F.least("sa", "sb").alias("few"))
    p = stage(p, "nn-pairs")
    frame = p.groupBy("big").agg(F.ceil(F.max("most") / TILE).cast("long").alias("across"), F.ceil(F.sum("few") / TILE).cast("long").alias("down"))
    fields = ["leader", "cid", "n", "vec"]
    left = frame.join(members, frame.big == members.leader).select("big", F.pmod(F.xxhash64("cid"), F.col("across")).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)).alias("j"), F.lit(0).alias("side"), *fields)
    right = p.join(frame, "big").join(members, F.col("small") == members.leader)
    right = right.select("big", F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)).alias("i"), F.pmod(F.xxhash64("cid"), F.col("down")).alias("j"), F.lit(1).alias("side"), *fields)
    both = left.union(right)
    names = "cid links a b"

    def arrays(held: list) -> tuple:
        leader, cid, n, vec = zip(*held, strict=True)
        return np.array(leader), np.array(cid), np.array(n), _unit(np.frombuffer(b"".join(vec), np.float64).reshape(len(held), dim))

    def compare(own: tuple, partners: list) -> Iterator[pa.RecordBatch]:
        big, ids, many, y = own
        leader, cid, n, x = arrays(partners)
        link = y @ x.T >= threshold
        mine, theirs = link @ n, many @ link
        who, links = np.concatenate((ids[mine > 0], cid[theirs > 0])), np.concatenate((mine[mine > 0], theirs[theirs > 0]))
        yield _batch(names, who, links, *[pa.nulls(len(who), pa.int64())] * 2)
        met = np.unique(leader[theirs > 0])
        yield _batch(names, *[pa.nulls(len(met), pa.int64())] * 2, np.full(len(met), big[0]), met)

    def run(batches):
        """Tile by tile: the big cell's members (side 0) come first, their
        partners meet them in turn."""
        now, first, own, wait = None, [], None, []
        for b in batches:
            cols = [b.column(k).to_pylist() for k in ("big", "i", "j", "side", *fields)]
            for big, i, j, side, *rest in zip(*cols, strict=True):
                if (big, i, j) != now:
                    if wait:
                        yield from compare(own, wait)
                    now, first, own, wait = (big, i, j), [], None, []
                if side == 0:
                    first.append(rest)
                elif first:
                    own = own or arrays(first)
                    wait.append(rest)
                    if len(wait) == TILE:
                        yield from compare(own, wait)
                        wait = []
        if wait:
            yield from compare(own, wait)

    return map_arrow(both.repartition("big", "i", "j").sortWithinPartitions("big", "i", "j", "side"), run, "cid long, links long, a long, b long")


def audit(c: DataFrame, links: DataFrame, dim: int, threshold: float) -> float:
    """Mean share of its links that a vector was given, over those of the
    ``AUDIT`` classes of least hash that have any."""
    spark = c.sparkSession
    asked = c.select("cid", "vec", F.xxhash64("vec").alias("h")).orderBy("h").limit(AUDIT).drop("h").toArrow().combine_chunks()
    if not asked.num_rows:
        return 1.0
    ids = np.asarray(asked.column("cid"))
    shared = spark.sparkContext.broadcast((ids, _unit(_matrix(asked.column("vec").combine_chunks(), dim, np.float64))))

    def run(batches):
        ids, q = shared.value
        n = np.zeros(len(ids), np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                p = b.slice(at, 4096)
                n += (q @ _unit(_matrix(p.column("vec"), dim, np.float64)).T >= threshold) @ np.asarray(p.column("n"))
        yield _batch("cid n", ids, n)

    true = map_arrow(c.select("vec", "n"), run, "cid long, n long").groupBy("cid").agg((F.sum("n") - 1).alias("all_links"))
    asked_ids = F.broadcast(c.sparkSession.createDataFrame([(int(i),) for i in ids], "cid long"))  # AUDIT rows
    given = links.join(asked_ids, "cid").select("cid", "n_links")
    got = true.where("all_links > 0").join(given, "cid", "left").agg(F.avg(F.least(F.lit(1.0), F.coalesce("n_links", F.lit(0)) / F.col("all_links")))).first()[0]
    return 1.0 if got is None else got


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> tuple[DataFrame, float]:
    """vec_id, n_links, component_id, kept of every row, and the audited recall."""
    rows, dim = vectors(df, id_col, vector_col)
    c = classes(rows, dim)
    total = c.count()
    angle = math.acos(threshold)
    floor = math.cos(min(3 * angle, math.pi))
    lists, recall = None, 0.0
    for turn in range(PASSES):
        found = seeds(c, dim, total, floor, turn * ORDERS)
        lists = stage(best(found if lists is None else lists.union(found), LIST), "nn-seeds")
        cell = cells(c, lists, dim, angle)
        leaders = cell.groupBy("leader").agg(F.max("theta").alias("radius")).withColumnRenamed("leader", "cid").join(c.select("cid", "code"), "cid")
        leaders = stage(leaders.select("cid", "code", "radius"), "nn-leaders")
        moved = cell.where("cid <> leader").select("cid", "leader")
        e = lists.join(broadcast_if_small(moved.withColumnRenamed("cid", "u").withColumnRenamed("leader", "lu")), "u", "left")
        e = e.join(broadcast_if_small(moved.withColumnRenamed("cid", "v").withColumnRenamed("leader", "lv")), "v", "left")
        still = e.where("lu is null and lv is null").select("u", "v", "s")
        shift = e.where("lu is not null or lv is not null").select(F.coalesce("lu", "u").alias("x"), F.coalesce("lv", "v").alias("y")).where("x <> y")
        shift = stage(cosines(shift.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), c, dim, "code"), "nn-shift").where(F.col("s") >= floor)
        start = best(still.union(shift.select("a", "b", "s")).union(shift.select("b", "a", "s")), 4 * LIST)
        pairs = stage(descend(leaders, start, dim, angle, floor), "nn-reach")
        members = stage(cell.join(c.select("cid", "n", "vec"), "cid").select("leader", "cid", "n", "vec"), "nn-members")
        linked = stage(tiles(pairs, members, dim, threshold), "nn-linked")
        inside = members.groupBy("leader").agg((F.sum("n") - 1).alias("inside"))
        across = linked.where("cid is not null").groupBy("cid").agg(F.sum("links").alias("across"))
        links = members.select("leader", "cid").join(inside, "leader").join(across, "cid", "left")
        links = stage(links.select("cid", "leader", (F.col("inside") + F.coalesce("across", F.lit(0))).alias("n_links")), "nn-links")
        recall = audit(c, links, dim, threshold)
        if recall >= RECALL:
            break
    edges = linked.where("a is not null").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    root = components(edges, "nn-components").withColumnRenamed("node", "leader")
    whole = links.join(root, "leader", "left").join(c.select("cid", "key", "least"), "cid").select("key", "least", "n_links", F.coalesce("root", "leader").alias("root"))
    whole = stage(whole, "nn-whole")
    named = whole.groupBy("root").agg(F.min("least").alias("component_id"))
    whole = whole.join(named, "root").select("key", "n_links", "component_id")
    inside = rows.where("key is not null").select("vec_id", "key").join(whole, "key").select("vec_id", "n_links", "component_id")
    outside = rows.where("key is null").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return inside.union(outside).withColumn("kept", F.col("vec_id") == F.col("component_id")), recall


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: links and components of all embeddings at cosine 0.95."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))[0]
