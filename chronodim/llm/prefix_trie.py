"""Prefix trie of conversations, from adaptive radix trees.

A turn (role, text) gets a 16-byte id (SHA-256 of both), so a conversation is
a byte string of fixed-width ids and two of them share a depth-d node exactly
if their first 16 d bytes are equal.  Radix trees over these strings hold
branches at any byte; only depths of whole turns emit nodes.

How the work is dealt:

* Conversations are cut into bands of ``TURNS`` turns.  A band's string starts
  with the digest of all turns before it, so trees of a band are independent of
  the bands above, and no conversation is ever held whole.  A band in which a
  conversation goes on alone needs no tree: its nodes are written directly.
* Equal strings are counted before they meet (however many copies).  The
  distinct ones are range-partitioned by their bytes, so a hot first turn is
  spread, and each task builds one tree per ``SLAB`` strings.
* Nodes on the path of a slab's first or last string may go on in the
  neighbouring slab.  They are emitted in parts, with the sums of the whole
  subtrees that hang from them, and put together by their digest; all others
  are final.  At most 2 (TURNS + 1) of a slab are of this kind.
* Bands are worked from the deepest shared one upwards, since a node's leaves
  and savings include those of the bands below it: one round a band, and one in
  all while no two conversations share over ``TURNS`` turns.
* Ids of a node's ending conversations are sorted by range partitioning, packed
  into blocks and hashed block by block.

``rebuild`` makes the sequences: the first h turns of the conversation
``c - c % group``, then its own turns after its first h, with
h = crc32(decimal c) % ``heads``.

Edge cases: rows with a null conv_id take no part; null role or text counts as
empty, null turns come first, equal turns are ordered by role and text (their
first 64 characters, then the id), repeated rows are turns of their own; a
conversation without rebuilt turns is a member of the root; an empty table has no nodes, not even a root; texts may have any length
(only ids travel); extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronodim.llm.art import Node, Tree
from chronodim.llm.common import column, map_arrow, stage, table
from chronodim.plans.session import broadcast_if_small

WIDTH = 16          # bytes of a turn id and of a digest
TURNS = 64          # turns in a band
SLAB = 20_000       # strings in a tree
BLOCK = 4096        # ids of ending conversations packed into one row
SUPER = 4096        # bands whose digests are summed at a time
TOP = bytes(WIDTH)  # digest of no turns
GROUP, HEADS = 100, 6


def digest(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, WIDTH)


def node_id(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()[:WIDTH]


# ------------------------------------------------------------- sequences
def positions(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, part, seq, id, chars) in order, and the pieces of
    conversations (conv_id, part, first, n, before): a row's place in its
    conversation is before + seq - first.  The order comes from one range
    partitioning, so a conversation may span any number of tasks."""
    role, text = (F.coalesce(column(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    t = df.select(column(conv_col).cast("long").alias("conv_id"), column(turn_col).alias("turn"), F.left(role, F.lit(64)).alias("r"), F.left(text, F.lit(64)).alias("t"),
                  digest(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role.cast("binary"), text.cast("binary")).alias("id"),
                  F.length(text).cast("long").alias("chars")).where("conv_id is not null")
    # equal rows may be cut anywhere: the random last key spreads them
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("r"), F.col("t"), F.col("id"), F.col("any")]
    t = t.withColumn("any", F.rand(1)).repartitionByRange(*by).sortWithinPartitions(*by)
    turns = stage(t.select("conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"), "id", "chars"), "trie-turns")
    pieces = turns.groupBy("conv_id", "part").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return turns, stage(pieces.withColumn("before", before), "trie-pieces")


def rebuild(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
            group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, idx from 0, id, chars) and conversations
    (conv_id, total), turnless ones included."""
    turns, pieces = positions(df, conv_col, turn_col, role_col, text_col)
    own = pieces.groupBy("conv_id").agg(F.sum("n").alias("n"))
    c = own.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"))
    c = c.join(own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
    c = c.withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = stage(c.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")), "trie-convs")
    place = F.col("before") + F.col("seq") - F.col("first")
    lead = turns.where(F.col("conv_id") % group == 0).join(pieces, ["conv_id", "part"]).select(F.col("conv_id").alias("base"), place.alias("idx"), "id", "chars")
    lead = lead.where(F.col("idx") < heads)
    lead = convs.where("taken > 0").join(lead, "base").where("idx < h").select("conv_id", "idx", "id", "chars")
    rest = turns.join(pieces.join(convs.select("conv_id", "h", "taken"), "conv_id"), ["conv_id", "part"])
    rest = rest.where(place >= F.col("h")).select("conv_id", (F.col("taken") + place - F.col("h")).alias("idx"), "id", "chars")
    return lead.union(rest), convs.select("conv_id", "total")


def bands(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, band, start (digest of the turns before), ids, chars, after
    (digest of the turns up to here, where the conversation goes on)."""
    g = turns.groupBy("conv_id", (F.col("idx") / TURNS).cast("long").alias("band")).agg(F.sort_array(F.collect_list(F.struct("idx", "id", "chars"))).alias("t"))
    g = g.join(convs, "conv_id").select("conv_id", "band", "total", F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["id"])), "")).alias("ids"), F.col("t.chars").alias("chars"))
    none = convs.where("total = 0").select("conv_id", F.lit(0).cast("long"), "total", F.lit(b""), F.array().cast("array<bigint>"))
    g = stage(g.union(none), "trie-bands")
    short = g.where(F.col("total") <= TURNS).select("conv_id", "band", F.lit(TOP).alias("start"), "ids", "chars", F.lit(None).cast("binary").alias("after"))
    # digests add up, so those of a very long conversation are summed in two steps
    long = g.where(F.col("total") > TURNS).withColumn("block", F.floor(F.col("band") / SUPER))
    mine = F.sha2(F.concat(F.col("band").cast("string").cast("binary"), F.lit(b":"), F.col("ids")), 256)
    names = [f"d{i}" for i in range(6)]
    long = long.select("*", *[F.conv(F.substring(mine, 1 + 8 * i, 8), 16, 10).cast("long").alias(n) for i, n in enumerate(names)])
    inside = W.partitionBy("conv_id", "block").orderBy("band").rowsBetween(W.unboundedPreceding, 0)
    across = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = long.groupBy("conv_id", "block").agg(*[F.sum(n).alias(n) for n in names])
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.sum(n).over(across), F.lit(0)).alias(f"b{n}") for n in names])
    long = long.select("conv_id", "band", "block", "total", "ids", "chars", *names, *[F.sum(n).over(inside).alias(f"s{n}") for n in names]).join(blocks, ["conv_id", "block"])
    def name(parts):
        return digest(F.concat_ws(",", *[p.cast("string") for p in parts]).cast("binary"))
    before = name([F.col(f"b{n}") + F.col(f"s{n}") - F.col(n) for n in names])
    upto = name([F.col(f"b{n}") + F.col(f"s{n}") for n in names])
    long = long.select("conv_id", "band", F.when(F.col("band") == 0, F.lit(TOP)).otherwise(before).alias("start"), "ids", "chars",
                       F.when(F.col("total") > (F.col("band") + 1) * TURNS, upto).alias("after"))
    return stage(short.union(long), "trie-strings")


# ------------------------------------------------------------------ trees
STRINGS = "start binary, ids binary, chars array<bigint>, n long, least long, ending long, b_children long, b_leaves long, b_saved long"
NODES = ("open boolean, node binary, parent binary, up array<binary>, start binary, depth long, conv_id long, parent_conv_id long, n_convs long, chars long, "
         "n_children long, n_leaves long, saved_tokens long, ending long")


class Emitter:
    """Nodes of one slab of sorted strings, from its tree."""

    def __init__(self, rows: list[dict]):
        self.rows = rows
        self.keys = [r["start"] + r["ids"] for r in rows]
        self.out: list[list] = []
        tree = Tree()
        for i, key in enumerate(self.keys):
            tree.insert(key, i)
        self._visit(tree.root, 0)

    def _visit(self, node: Node, at: int) -> tuple:
        """(members, least id, top nodes, leaves, saved, a row) of a subtree
        whose own bytes begin at depth ``at``; sums are over whole nodes."""
        end = at + len(node.prefix)
        here = None if node.value is None else self.rows[node.value]
        n, least, tops, leaves, saved, row = 0, None, [], 0, 0, node.value
        if here:
            n, least = here["n"], here["least"]
        for _, kid in node.below.items() if node.below else ():
            m, low, t, lv, sv, row = self._visit(kid, end + 1)
            n, leaves, saved = n + m, leaves + lv, saved + sv
            least = low if least is None or low < least else least
            if tops:
                tops.extend(t)
            else:
                tops = t
        key = self.keys[row]
        for depth in range(end - end % WIDTH, max(at, WIDTH) - 1, -WIDTH):
            below = here if depth == end else None
            tops, leaves, saved = self._emit(depth, key, row, n, least, tops, leaves, saved, below)
        return n, least, tops, leaves, saved, row

    def _emit(self, depth, key, row, n, least, tops, leaves, saved, here) -> tuple:
        mine = key[:depth]
        turn = depth // WIDTH - 1
        chars = self.rows[row]["chars"][turn - 1] if turn else 0
        children, ending = len(tops), 0
        if here:
            children, leaves, saved, ending = children + here["b_children"], leaves + here["b_leaves"], saved + here["b_saved"], here["ending"]
        start = key[:WIDTH]
        is_open = mine == self.keys[0][:depth] or mine == self.keys[-1][:depth]
        own = node_id(mine) if is_open or ending else None
        # the start of a lower band is a node of the band above: its least id is looked up by the digest
        named = start if not turn and start != TOP else own if is_open else None
        for t in tops:
            self.out[t][2 if named else 7] = named or least
        if is_open:
            up = [node_id(key[:d]) for d in range(WIDTH, depth, WIDTH)]
            parent = None if not turn else start if turn == 1 and start != TOP else up[-1]
            self.out.append([True, own, parent, up, start, turn, least, None, n, chars, children, leaves, saved, ending])
            return [], 0, 0
        if not children:
            leaves = 1
        if turn:
            saved += (n - 1) * chars
        self.out.append([False, own, None, None, None if turn else start, turn, least, None, n, chars, children, leaves, saved, ending])
        return [len(self.out) - 1], leaves, saved


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    rows: list[dict] = []
    for b in batches:
        rows += b.to_pylist()
        while len(rows) >= SLAB:
            yield rows[:SLAB]
            rows = rows[SLAB:]
    if rows:
        yield rows


def trees(strings: DataFrame) -> DataFrame:
    """Whole and partial nodes of one band's distinct strings."""
    by = [F.col("start"), F.col("ids")]
    names = [x.split()[0] for x in NODES.split(", ")]
    kinds = [pa.bool_(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.binary()] + [pa.int64()] * 9

    def run(batches):
        for rows in _slabs(batches):
            out = Emitter(rows).out
            for a in range(0, len(out), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[a:a + 50_000], strict=True), kinds, strict=True)], names=names)

    return map_arrow(strings.repartitionByRange(*by).sortWithinPartitions(*by), run, NODES)


def put_together(parts: DataFrame) -> DataFrame:
    """Partial nodes of all slabs as whole ones, with their ``up`` lists."""
    m = parts.groupBy("node").agg(*[F.first(c).alias(c) for c in ("parent", "up", "start", "depth", "chars")], F.min("conv_id").alias("conv_id"),
                                  *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "ending")])
    m = stage(m, "trie-open")
    kids = m.where(F.size("up") > 0).groupBy(F.element_at("up", -1).alias("node")).agg(F.count(F.lit(1)).alias("kids"))
    m = m.join(kids, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).drop("kids")
    m = m.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
    m = m.withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars"))
    sums = m.select(F.explode(F.array_append("up", F.col("node"))).alias("node"), "n_leaves", "saved_tokens").groupBy("node").agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    return stage(m.drop("n_leaves", "saved_tokens").join(sums, "node"), "trie-joined")


def ends(strings: DataFrame) -> DataFrame:
    """node, ends_sha256: the hash of the ascending ids of the conversations
    that end at a node, read in blocks."""
    e = strings.where("after is null").select(digest(F.col("start"), F.col("ids")).alias("node"), "conv_id")
    e = e.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")

    def pack(batches):
        for b in batches:
            nodes, ids, out, at = b.column("node").to_pylist(), b.column("conv_id").to_pylist(), [], 0
            for i in range(1, len(ids) + 1):
                if i == len(ids) or nodes[i] != nodes[at] or i - at == BLOCK:
                    out.append((nodes[at], ids[at], ",".join(map(str, ids[at:i]))))
                    at = i
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.string()), strict=True)], names=["node", "first", "text"])

    def join(batches):
        node, h = None, None
        for b in batches:
            done = []
            for own, text in zip(b.column("node").to_pylist(), b.column("text").to_pylist(), strict=True):
                if own != node:
                    if h:
                        done.append((node, h.hexdigest()))
                    node, h = own, hashlib.sha256(text.encode())
                else:
                    h.update(b"," + text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), (pa.binary(), pa.string()), strict=True)], names=["node", "ends_sha256"])
        if h:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([h.hexdigest()])], names=["node", "ends_sha256"])

    packed = map_arrow(e, pack, "node binary, first long, text string").repartition("node").sortWithinPartitions("node", "first")
    return map_arrow(packed, join, "node binary, ends_sha256 string")


OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of sequences (see ``rebuild``): conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, n_ends,
    ends_sha256."""
    s = bands(turns, convs)
    top = s.agg(F.max("band")).first()[0] or 0
    shared, found = s.where("band = 0"), []
    starts = None  # where a lower band begins: digest and least member
    deepest = 0
    if top:
        alone = s.where("band > 0").groupBy("band", "start").agg(F.count(F.lit(1)).alias("goes_on"))
        lower = stage(s.where("band > 0").join(alone, ["band", "start"]).select(*s.columns, "goes_on"), "trie-lower")
        deepest = lower.where("goes_on > 1").agg(F.max("band")).first()[0] or 0
        shared = shared.union(lower.where("goes_on > 1").select(*s.columns))
        full = s.where(F.length("ids") == TURNS * WIDTH).groupBy("band", "start", "ids").agg(F.min("conv_id").alias("conv_id"), F.max("after").alias("node"))
        starts = stage(full.where("node is not null").select("node", "conv_id"), "trie-starts")
        last = (F.col("i") == F.size("chars") - 1) & F.col("after").isNull()
        chain = lower.where("goes_on = 1").select("*", F.posexplode("chars").alias("i", "c"))
        found.append(chain.select(
            F.when(last, digest(F.col("start"), F.col("ids"))).alias("node"), F.when(F.col("i") == 0, F.col("start")).alias("parent"), "conv_id", (F.col("band") * TURNS + F.col("i") + 1).alias("depth"),
            F.when(F.col("i") > 0, F.col("conv_id")).alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"), (~last).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), last.cast("long").alias("n_ends")))
    below = None
    wanted = ["node", "parent", *OUT, F.col("ending").alias("n_ends")]
    opened = []
    for band in range(deepest, -1, -1):
        goes = F.col("after").isNotNull()
        k = shared.where(F.col("band") == band).groupBy("start", "ids").agg(
            F.first("chars").alias("chars"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.count_if(~goes).alias("ending"),
            F.max(goes.cast("long")).alias("alone"), F.max("after").alias("after"))
        if below is None:
            k = k.select("*", *[F.lit(None).cast("long").alias(c) for c in ("children", "leaves", "saved")])
        else:
            k = k.join(below, "after", "left")
        # a conversation that goes on alone has one child and one leaf below
        k = k.select("start", "ids", "chars", "n", "least", "ending", F.coalesce("children", "alone").alias("b_children"), F.coalesce("leaves", "alone").alias("b_leaves"),
                     F.coalesce("saved", F.lit(0).cast("long")).alias("b_saved"))
        nodes = stage(trees(k), "trie-nodes")
        joined = put_together(nodes.where("open"))
        whole = nodes.where("not open")
        sums = [F.col("start").alias("after"), F.col("n_children").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")]
        if band:
            below = whole.where("depth = 0").select(*sums).union(joined.where("depth = 0").select(*sums))
            joined, whole = joined.where("depth > 0"), whole.where("depth > 0")
        opened.append(joined.select("node", "conv_id"))
        deeper = F.col("depth") + band * TURNS
        for part in (whole, joined.withColumn("parent_conv_id", F.lit(None).cast("long"))):
            found.append(part.withColumn("depth", deeper).select(*wanted))
    nodes = found[0]
    for f in found[1:]:
        nodes = nodes.unionByName(f)
    names = opened[0]
    for o in opened[1:]:
        names = names.union(o)
    if starts is not None:
        names = names.union(starts)
    names = broadcast_if_small(names.select(F.col("node").alias("parent"), F.col("conv_id").alias("least")))
    ready = nodes.where("parent is null").withColumn("least", F.lit(None).cast("long")).unionByName(nodes.where("parent is not null").join(names, "parent", "left"))
    ready = ready.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "least")).select("node", *OUT, "n_ends")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    ended = ready.where("n_ends > 0").join(ends(s), "node").select(*OUT, "n_ends", "ends_sha256")
    return ready.where("n_ends = 0").select(*OUT, "n_ends", nothing.alias("ends_sha256")).union(ended)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the prefix trie of all rebuilt conversations."""
    return trie(*rebuild(table(spark, sf_dir, "conversations"))).drop("n_ends")
