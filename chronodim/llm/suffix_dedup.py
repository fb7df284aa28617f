"""Suffix-array dedup: remove every byte covered by a string of ``length``
bytes (200) that also starts anywhere else.

Column-wise multi-document construction: strings aligned by column get one
symbol each per round, from the last column to the first.  A round stably
re-sorts the collection by the new symbol (the positional Burrows-Wheeler
step) and updates the common prefixes of neighbours; a window of 200 columns
is repeated exactly if its common prefix with a neighbour reaches 200.  The
columns lie in one scratch file per task (in memory while small), written
once and read column by column, so memory holds an order, a prefix length
and one column.

Run on whole documents the construction needs as many rounds as the longest
document has bytes, each over the whole transform.  So it runs on the strings
where it decides something:

1. Each 200-byte window is assigned its anchor: the 32-byte gram of least
   hash inside it.  Equal windows have equal anchors at equal offsets.
   Neighbouring windows with one anchor form a run (at most 369 bytes).
2. Runs meet by gram.  A gram met once: its windows are unique.  Runs of
   equal content: repeated.  Only a gram met in unequal runs stays open.
   Each task settles what it can before the shuffle: of a content it has met
   twice only one run goes to the gram, and a gram it has met in ``CROWD``
   unequal runs is open there and then, so a very common gram sends a few
   rows a task.
3. Open runs (and one run for each repeated content beside them) are the
   documents of the column-wise construction, aligned at their gram: at most
   284 rounds.  They are dealt by the gram and the 84 bytes after it, for
   windows that hold these, and by the 84 bytes before it, for the others.

Every window of every text takes part; nothing is sampled.  Equal texts are
folded first: a text of 200 bytes or more that occurs twice goes whole.

Edge cases: null counts as empty (0 bytes, nothing removed); texts under 200
bytes keep everything; repeated rows are copies like any other; an empty
table gives no rows; extra columns travel in the row struct untouched.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronodim.llm.common import column, map_arrow, slices, table, text_bytes
from chronodim.plans.session import new_run_dir

LENGTH = 200
GRAM = 32
SPOOL = 32 << 20   # bytes of columns held in memory before the scratch file
PIECE = 1 << 22    # longest stretch of a text hashed at once
JOINED = 1 << 20   # bytes of short texts hashed together
CROWD = 32         # unequal runs of a gram in a task's piece that make it open
KNOWN = 400_000    # repeated contents a task remembers


# ---- anchors -------------------------------------------------------------
def gram_hashes(x: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position of ``x`` (uint8)."""
    h = (x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    m, size = 0x2545F4914F6CDD1D, 1
    while size < GRAM:
        h = h[:-size] * np.uint64(m) + h[size:]
        m, size = m * m % 2 ** 64, size * 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_anchors(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the least (hash, position) among ``width`` grams from each
    position."""
    bits = max(1, int(len(h)).bit_length())
    mask = np.uint64((1 << bits) - 1)
    k = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        k = np.minimum(k[:-size], k[size:])
        size *= 2
    if width > size:
        k = np.minimum(k[:size - width], k[width - size:])
    return (k & mask).astype(np.int64)


def runs_of(texts: list[bytes], length: int):
    """(text index, first window, windows, anchor offset, gram hash, run hash)
    arrays over all runs of ``texts``."""
    data = b"".join(texts)
    width = length - GRAM + 1
    if len(data) < length:
        return None
    ends = np.cumsum([len(t) for t in texts])
    x = np.frombuffer(data, np.uint8)
    h = gram_hashes(x)
    anchor = window_anchors(h, width)
    starts = np.arange(len(anchor))
    doc = np.searchsorted(ends, starts, side="right")
    ok = starts + length <= ends[np.minimum(doc, len(ends) - 1)]
    at = np.flatnonzero(ok)
    if not len(at):
        return None
    a, d = anchor[at], doc[at]
    cut = np.concatenate(([True], (a[1:] != a[:-1]) | (d[1:] != d[:-1]) | (at[1:] != at[:-1] + 1)))
    first = np.flatnonzero(cut)
    n = np.diff(np.append(first, len(at)))
    s = at[first]
    view, digest = memoryview(data), xxhash.xxh3_64_digest
    run = np.frombuffer(b"".join([digest(view[i:j]) for i, j in zip(s.tolist(), (s + n + length - 1).tolist(), strict=True)]), ">i8").astype(np.int64)
    of = d[first]
    begin = np.concatenate(([0], ends[:-1]))[of]
    return of, s - begin, n, a[first] - s, h[a[first]].view(np.int64), run


def pieces(texts: list[bytes], length: int):
    """Lists of (text index, offset, bytes) of bounded size; neighbours
    overlap so that each window lies in exactly one piece."""
    held, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), PIECE):
            held.append((i, at, t[at:at + PIECE + length - 1]))
            size += len(held[-1][2])
            if size > JOINED:
                yield held
                held, size = [], 0
    if held:
        yield held


# states of a run before the shuffle
MEETS, REPEATED, REPEATED_ONCE, CROWDED, OPEN, COMPARED = range(6)


def settle(gram: np.ndarray, run: np.ndarray, known: np.ndarray):
    """What a task can settle by itself about runs, given the sorted keys of
    the contents ``known`` to repeat in it.

    Returns the state of each run, the runs that stand for a newly repeated
    content, the grams with CROWD unequal runs, and the new ``known``."""
    key = run ^ (gram * np.int64(0x5851F42D4C957F2D))
    state = np.full(len(gram), MEETS, np.int8)
    state[np.isin(key, known)] = REPEATED
    left = np.flatnonzero(state == MEETS)
    if not len(left):
        return state, left, np.zeros(0, bool), left, known
    left = left[np.lexsort((run[left], gram[left]))]
    g, r = gram[left], run[left]
    new_gram = np.concatenate(([True], g[1:] != g[:-1]))
    new = np.concatenate(([True], (g[1:] != g[:-1]) | (r[1:] != r[:-1])))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(left)))
    many = np.repeat(count > 1, count)
    state[left[many]] = REPEATED
    stand = left[first[count > 1]]
    # unequal runs of each gram
    kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_gram))
    crowded = np.repeat(kinds >= CROWD, np.diff(np.append(np.flatnonzero(new_gram), len(left))))
    state[left[crowded & ~many]] = OPEN
    mark = left[new_gram & crowded]
    in_crowd = np.zeros(len(gram), bool)
    in_crowd[left[crowded]] = True
    known = np.union1d(known, key[stand])
    return state, stand, in_crowd[stand], mark, known if len(known) < KNOWN else known[:0]


def anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    """(gram, run, tid, at, state) of ``texts`` (tid, tag, text); ``at`` packs
    first window, windows, anchor offset and tag.  Rows that need no meeting
    have a null run and lie at a value of their own instead of the gram."""
    schema = pa.schema([("gram", pa.int64()), ("run", pa.int64()), ("tid", pa.int64()), ("at", pa.int64()), ("state", pa.int8())])

    def run(batches):
        known = np.zeros(0, np.int64)
        for b in slices(batches):
            tids, tags = np.asarray(b.column("tid")), np.asarray(b.column("tag"))
            for part in pieces(b.column("text").to_pylist(), length):
                found = runs_of([t for _, _, t in part], length)
                if found is None:
                    continue
                of, s, n, off, gram, content = found
                owner = np.array([i for i, _, _ in part])[of]
                s = s + np.array([at for _, at, _ in part])[of]
                at = (s << 25) | ((n - 1) << 17) | (off << 9) | tags[owner]
                tid = tids[owner]
                state, stand, compared, mark, known = settle(gram, content, known)
                # a content's stand-in takes the place of one of its runs
                state[stand] = np.where(compared, COMPARED, REPEATED_ONCE)
                alone = (state == REPEATED) | (state == OPEN) | (state == COMPARED)
                where = np.where(alone, (tid ^ at) * np.int64(0x5851F42D4C957F2D) ^ (at >> 25), gram)
                k = len(mark)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate((where, gram[mark]))), pa.array(np.concatenate((content, content[mark])), mask=np.concatenate((alone, np.ones(k, bool)))),
                    pa.array(np.concatenate((tid, tid[mark]))), pa.array(np.concatenate((at, at[mark]))),
                    pa.array(np.concatenate((state, np.full(k, CROWDED, np.int8))))], schema=schema)

    return map_arrow(texts.select("tid", "tag", "text"), run, "gram long, run long, tid long, at long, state byte")


# ---- column-wise construction --------------------------------------------
class Columns:
    """Rows of ``width`` bytes, added in blocks, read back column by column."""

    def __init__(self, width: int):
        self.width, self.blocks, self.at = width, [], 0
        self.file = tempfile.SpooledTemporaryFile(max_size=SPOOL)

    def add(self, rows: np.ndarray) -> None:
        self.file.write(np.ascontiguousarray(rows.T).tobytes())
        self.blocks.append((self.at, len(rows)))
        self.at += rows.size

    def read(self, c: int) -> np.ndarray:
        out = []
        for at, n in self.blocks:
            self.file.seek(at + c * n)
            out.append(self.file.read(n))
        return np.frombuffer(b"".join(out), np.uint8)


def repeated_windows(columns: Columns, group: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int, last: int):
    """Column-wise rounds over rows that fill columns lo to hi - 1.

    ``group``: rows of unequal groups share no window.  Yields (rows, first
    column, columns): stretches of columns up to ``last`` from which the
    row's window is repeated in another row."""
    m = len(group)
    order = np.argsort(group, kind="stable")
    g = group[order].astype(np.int64)
    lcp = np.zeros(m + 1, np.int32)  # with the row before, from the column on
    since = np.full(m, -1, np.int32)  # column of the row's open stretch
    for c in range(columns.width - 1, -1, -1):
        symbol = np.where((lo <= c) & (c < hi), columns.read(c), 256).astype(np.int64)
        s = g * 257 + symbol[order]
        by = np.argsort(s, kind="stable")
        s = s[by]
        same = np.flatnonzero(s[1:] == s[:-1]) + 1
        fresh = np.zeros(m + 1, np.int32)
        if len(same):
            # least prefix among the old neighbours between the two rows
            pairs = np.empty(2 * len(same), np.int64)
            pairs[0::2], pairs[1::2] = by[same - 1] + 1, by[same] + 1
            fresh[same] = np.minimum.reduceat(lcp, pairs)[0::2] + 1
        order, lcp = order[by], fresh
        if c <= last:
            hit = np.zeros(m, bool)
            hit[order] = (lcp[:-1] >= length) | (lcp[1:] >= length)
            hit &= (lo <= c) & (c <= hi - length)
            ended = np.flatnonzero(~hit & (since >= 0))
            if len(ended):
                yield ended, np.full(len(ended), c + 1), since[ended] - c
                since[ended] = -1
            since[hit & (since < 0)] = c
    ended = np.flatnonzero(since >= 0)
    yield ended, np.zeros(len(ended), np.int64), since[ended] + 1


def open_windows(contexts: DataFrame, length: int) -> DataFrame:
    """(tid, tag, s, n): repeated stretches of windows among ``contexts``
    (key, tid, tag, s, n, lo, bytes)."""
    left = length - GRAM
    half = left // 2
    width = left - half + length

    def run(batches):
        columns, held = Columns(width), {c: [] for c in ("key", "tid", "tag", "s", "n", "lo")}
        for b in batches:
            if b.num_rows:
                columns.add(np.frombuffer(b"".join(b.column("bytes").to_pylist()), np.uint8).reshape(-1, width))
                for c, parts in held.items():
                    parts.append(np.array(b.column(c)))
        if not held["key"]:
            return
        key, tid, tag, s, n, lo = (np.concatenate(x) for x in held.values())
        for r, c, k in repeated_windows(columns, np.unique(key, return_inverse=True)[1], lo, lo + n + length - 1, length, left - half):
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (tid[r], tag[r], s[r] + c - lo[r], k)], names=["tid", "tag", "s", "n"])

    return map_arrow(contexts.repartition("key"), run, "tid long, tag long, s long, n long")


def context_rows(text: bytes, at: np.ndarray, length: int) -> list[tuple[int, int, int, int, bytes]]:
    """(key, s, n, lo, bytes) of a text's open runs: windows from ``s`` on
    whose anchor is at most half the way in, and the others."""
    left = length - GRAM
    half = left // 2
    width = left - half + length
    out = []
    for i, m, o in zip(*(x.tolist() for x in unpack(at)[:3]), strict=True):
        p = i + o  # of the gram
        skip = max(0, o - half)
        for side, first, n, lo, key in ((b">", i + skip, m - skip, left - o + skip - half, text[p:p + GRAM + half]), (b"<", i, min(m, o - half), left - o, text[p - half:p + GRAM])):
            if n > 0:
                row = (bytes(lo) + text[first:first + n - 1 + length]).ljust(width, b"\0")
                out.append((xxhash.xxh3_64_intdigest(side + key) - 2 ** 63, first, n, lo, row))
    return out


def unpack(at: np.ndarray):
    return at >> 25, ((at >> 17) & 255) + 1, (at >> 9) & 255, at & 511


# ---- whole operator ------------------------------------------------------
def text_keys(text: F.Column) -> list[F.Column]:
    """tid (64 bits) and tag (9 more) of a text's MD5."""
    md5 = F.md5(text)
    return [F.conv(F.substring(md5, 1, 16), 16, -10).cast("long").alias("tid"),
            F.conv(F.substring(md5, 17, 4), 16, 10).cast("long").bitwiseAND(F.lit(511)).alias("tag")]


def distinct_texts(df: DataFrame) -> DataFrame:
    """(tid, tag, text, copies) of ``df`` (tid, tag, text), a table bucketed
    by tid in the shared folder: later joins bring their side to the texts.
    Each task sends one copy of a text at most."""
    spark = df.sparkSession

    def run(batches):
        seen: dict[tuple[int, int], int] = {}
        schema = pa.schema([("tid", pa.int64()), ("tag", pa.int64()), ("text", pa.binary()), ("copies", pa.int64())])
        for b in slices(batches):
            keys = list(zip(b.column("tid").to_pylist(), b.column("tag").to_pylist(), strict=True))
            fresh = []
            for i, k in enumerate(keys):
                if k in seen:
                    seen[k] += 1
                else:
                    seen[k] = 0
                    fresh.append(i)
            b = b.take(pa.array(fresh, pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([1] * len(fresh), pa.int64())], schema=schema)
        more = [(*k, n) for k, n in seen.items() if n]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in more], pa.int64()), pa.array([x[1] for x in more], pa.int64()),
                                          pa.nulls(len(more), pa.binary()), pa.array([x[2] for x in more], pa.int64())], schema=schema)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    once = map_arrow(df.select("tid", "tag", "text"), run, "tid long, tag long, text binary, copies long")
    folded = once.repartition(n, "tid").groupBy("tid", "tag").agg(F.first("text", ignorenulls=True).alias("text"), F.sum("copies").alias("copies"))
    name = f"suffix_texts_{uuid.uuid4().hex[:12]}"
    folded.write.bucketBy(n, "tid").option("path", new_run_dir(spark, name)).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def spans_of(starts: list[int], counts: list[int], length: int) -> list[list[int]]:
    """Maximal removed byte runs from stretches of repeated windows."""
    out: list[list[int]] = []
    for s, n in sorted(zip(starts, counts, strict=True)):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s + n - 1 + length)
        else:
            out.append([s, s + n - 1 + length])
    return out


def removed(texts: DataFrame, length: int = LENGTH, whole_characters: bool = False) -> DataFrame:
    """(tid, tag, n_bytes, n_removed, n_spans, kept binary, kept_sha256) for
    each distinct text of ``texts`` (see :func:`distinct_texts`).  With
    ``whole_characters`` a character cut in half goes whole from ``kept``."""
    by = W.partitionBy("gram")
    sorted_ = by.orderBy("run")
    runs = anchor_rows(texts, length)
    met = runs.select("gram", "tid", "at", "run", "state", F.lag("run").over(sorted_).alias("before"), F.lead("run").over(sorted_).alias("after"),
                      F.min("run").over(by).alias("lo"), F.max("run").over(by).alias("hi"), F.max(F.col("state") == CROWDED).over(by).alias("crowded"))
    same = (F.col("state") == REPEATED_ONCE) | F.coalesce(F.col("run") == F.col("before"), F.lit(False)) | F.coalesce(F.col("run") == F.col("after"), F.lit(False))
    lead = F.coalesce(F.col("run") != F.col("before"), F.lit(True))
    unequal = (F.col("lo") != F.col("hi")) | F.col("crowded")
    # 1: repeated; 2: open; 3: repeated, and compared with the open ones
    kind = F.when(F.col("state") == CROWDED, None).when(F.col("state") == REPEATED, 1).when(F.col("state") == OPEN, 2).when(F.col("state") == COMPARED, 3) \
        .when(same & ~(unequal & lead), 1).when(same, 3).when(unequal, 2)
    decided = met.select("tid", "at", kind.alias("kind")).where("kind is not null")
    lists = decided.groupBy("tid").agg(F.collect_list(F.struct("at", "kind")).alias("found"))
    path = new_run_dir(texts.sparkSession, "suffix-runs")
    lists.write.option("compression", "zstd").parquet(path)
    lists = texts.sparkSession.read.schema(lists.schema).parquet(path)

    def contexts(batches):
        for b in slices(batches):
            found, keys = b.column("found"), (b.column("tid").to_pylist(), b.column("tag").to_pylist())
            for k, (text, tid, tag) in enumerate(zip(b.column("text").to_pylist(), *keys, strict=True)):
                at, kind_ = (np.asarray(found[k].values.field(i)) for i in (0, 1))
                rows = context_rows(text, at[(kind_ > 1) & ((at & 511) == tag)], length)
                if rows:
                    key, s, n, lo, row = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array([tid] * len(rows), pa.int64()), pa.array([tag] * len(rows), pa.int64()),
                                                      *[pa.array(x, pa.int64()) for x in (s, n, lo)], pa.array(row, pa.binary())], names=["key", "tid", "tag", "s", "n", "lo", "bytes"])

    some = lists.where(F.exists("found", lambda x: x["kind"] > 1))
    wanted = map_arrow(texts.join(some, "tid").select("tid", "tag", "text", "found"), contexts, "key long, tid long, tag long, s long, n long, lo long, bytes binary")
    opened = open_windows(wanted, length)
    sure = lists.select("tid", F.explode(F.filter("found", lambda x: x["kind"] != 2)).alias("f")).select(
        "tid", F.col("f.at").bitwiseAND(F.lit(511)).alias("t"), F.shiftright("f.at", 25).alias("s"), (F.shiftright("f.at", 17).bitwiseAND(F.lit(255)) + 1).alias("n"))
    spans = sure.unionByName(opened.select("tid", F.col("tag").alias("t"), "s", "n")).groupBy("tid").agg(F.collect_list(F.struct("t", "s", "n")).alias("spans"))

    def cut(batches):
        for b in slices(batches):
            out = []
            for text, tag, copies, found in zip(b.column("text").to_pylist(), b.column("tag").to_pylist(), b.column("copies").to_pylist(), b.column("spans"), strict=True):
                if copies > 1 and len(text) >= length:
                    out.append((len(text), len(text), 1, b""))
                    continue
                gone: list[list[int]] = []
                if found.is_valid:
                    t, s, n = (np.asarray(found.values.field(i)) for i in range(3))
                    mine = t == tag
                    gone = spans_of(s[mine].tolist(), n[mine].tolist(), length)
                kept, at = [], 0
                for i, j in gone:
                    kept.append(text[at:i])
                    at = j
                kept.append(text[at:])
                out.append((len(text), sum(j - i for i, j in gone), len(gone), b"".join(kept)))
            if whole_characters:
                out = [(*x, k.decode("utf-8", "ignore").encode()) for *x, k in out]
            columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([
                b.column("tid"), b.column("tag"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.binary()),
                pa.array([hashlib.sha256(k).hexdigest() for k in columns[3]], pa.string())],
                names=["tid", "tag", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return map_arrow(
        texts.join(spans, "tid", "left").select("tid", "tag", "text", "copies", "spans"), cut, "tid long, tag long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def suffix_dedup(df: DataFrame, text_col: str = "text", length: int = LENGTH, whole_characters: bool = False) -> DataFrame:
    """(row struct without the text, n_bytes, n_removed, n_spans, kept binary,
    kept_sha256) for every row of ``df``."""
    text = text_bytes(text_col)
    texts = distinct_texts(df.select(*text_keys(text), text.alias("text")))
    result = removed(texts, length, whole_characters)
    rows = df.select(F.struct(*[column(c) for c in df.columns if c != text_col]).alias("row"), *text_keys(text))
    return rows.join(result, ["tid", "tag"]).drop("tid", "tag")


def cut(df: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``df`` with its texts cut; null becomes empty, other columns stay, but
    ``n_chars`` (if there is one) counts the new text's characters."""
    out = suffix_dedup(df, text_col, length, whole_characters=True)
    text = F.col("kept").cast("string")
    new = {text_col: text, "n_chars": F.length(text).cast("long")}
    return out.select(*[(new[c] if c in new else F.col("row").getField(c)).alias(c) for c in df.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: what is left of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup(docs).select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
