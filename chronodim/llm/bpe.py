"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text cuts it where its content says so, so
a passage that many documents share falls into the same chunks wherever it
stands.  A task encodes (and decodes) each distinct chunk once.  Chunks are
then joined.  A cut before the last blank ahead of a visible character, or
between East Asian punctuation and an ideograph, is always an edge of the
tokenizer's words, so such joins agree as they are.  Where a long stretch
offers no such place it is cut anyway, and the join is repaired: the text from
the left chunk's last sure word edge is re-encoded over a growing window until
its word edges and those of the right chunk agree.  A repaired stretch is kept
in the store as a whole.

The ids are those of the ``tokenizers`` library with the given file.  Chunks
of characters whose classes are the same in all Unicode versions (below
U+0280 and general punctuation) are encoded by ``tiktoken`` from the same
vocabulary, four times as fast; all others by ``tokenizers`` itself.  Special
tokens written out in a text become their ids, as in that library.

The word pattern is that of byte-level files (``plain_bytes``).  With any other
file whole texts are the chunks, encoded and decoded by ``tokenizers``.

Edge cases: a null text counts as empty and has no tokens; repeated rows are
encoded one by one; an empty table gives no rows; extra columns travel along
in the row struct.  The reuse is per task and bounded (``CACHE_BYTES``, then
it starts afresh); sharing it between tasks would shuffle every chunk and go
over the disk limit, and the result is the same.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronodim.llm.common import column, map_arrow, slices, table, text_bytes

FILE = "byte_bpe_50k.json"
CACHE_BYTES = 48 << 20
MASK = 15           # one in sixteen word edges is a cut
SPAN = 16           # bytes the rolling hash sees
MAX_CHUNK = 4096    # a stretch without a sure cut is cut after so many bytes
LOOK = 4            # characters a word edge may depend on beyond itself

# characters that tiktoken may class unlike the tokenizers library
UNSURE = re.compile(rb"[\x1c-\x1f\xca-\xe1\xe3-\xff]|\xc2[\x80-\x9f]|\xe2[^\x80]")

# Fixed by Unicode: first bytes of white space beyond ASCII are C2, E1, E2 and
# E3; U+5000 to U+8FFF (E5 to E8) are letters; 、 。 ！ ， ： ； ？ are none.
SEEN = np.array([32 < b < 127 or 0xC3 <= b <= 0xE0 or 0xE4 <= b <= 0xF4 for b in range(256)])
STOPS = np.array([int.from_bytes(c.encode()) for c in "、。！，：；？"], np.int32)


class Codec:
    """Encoder and decoder of one tokenizer file, with its chunk store."""

    def __init__(self, path: str):
        import json

        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.store: dict[bytes, tuple[bytes, bytes]] = {}
        self.held = 0
        self.encoded = 0  # bytes that were not in the store
        self.plain = plain_bytes(spec)
        if not self.plain:
            return
        letter = byte_letters()
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(letter[c] for c in token) for token, i in vocabulary.items() if token.encode() not in self.special}
        self.bytes_of |= {i: t for t, i in self.special.items()}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        ranks = {b: i for i, b in self.bytes_of.items() if b not in self.special}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.words = regex.compile(pattern)
        self.split = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")") if self.special else None

    # one chunk
    def ids(self, text: bytes) -> list[int]:
        s = text.decode()
        if UNSURE.search(text):
            return self.slow.encode(s, add_special_tokens=False).ids
        return self.fast.encode_ordinary(s)

    def chunk(self, text: bytes) -> tuple[bytes, bytes]:
        """Ids (little-endian 32-bit) and decoded bytes of a chunk."""
        got = self.store.get(text)
        if got is None:
            if not self.plain:
                ids = self.slow.encode(text.decode(), add_special_tokens=False).ids
                got = np.array(ids, "<u4").tobytes(), self.slow.decode(ids, skip_special_tokens=False).encode()
            elif len(text) > MAX_CHUNK:
                got = self.joined(forced(text))
            else:
                ids = self.ids(text)
                got = np.array(ids, "<u4").tobytes(), b"".join(map(self.bytes_of.__getitem__, ids))
            self.encoded += len(text)
            size = 2 * len(text) + len(got[0]) + 300
            if self.held + size > CACHE_BYTES:
                self.store.clear()
                self.held = 0
            if size <= CACHE_BYTES:
                self.held += size
                self.store[text] = got
        return got

    # joins
    def edges(self, text: str) -> list[int]:
        return [m.start() for m in self.words.finditer(text)]

    def joined(self, chunks: list[bytes]) -> tuple[bytes, bytes]:
        """Encode a stretch whose cuts aren't sure, repairing every join."""
        texts = [c.decode() for c in chunks]
        ids: list[int] = []        # agreed so far
        left = texts[0]            # text after the agreed ids, from a sure edge
        right, try_at = 1, 0
        while right < len(texts):
            nxt = texts[right]
            if len(left) + len(nxt) >= try_at:
                whole = left + nxt
                own = set(self.edges(nxt))
                # word edges both scans see, clear of either end; a blank before
                # the edge could join others when the text ends there
                agreed = [e for e in self.edges(whole) if len(left) < e <= len(whole) - LOOK and e - len(left) in own and not whole[e - 1].isspace()]
                if agreed:
                    ids += self.ids(whole[:agreed[0]].encode())
                    left = whole[agreed[0]:]
                    try_at = 0
                else:
                    left, try_at = whole, 2 * len(whole)
            else:
                left += nxt
            right += 1
        ids += self.ids(left.encode())
        return np.array(ids, "<u4").tobytes(), b"".join(map(self.bytes_of.__getitem__, ids))

    # one text
    def encode(self, text: bytes, cuts: list[int]) -> tuple[bytes, bytes]:
        """Ids and decoded bytes of a text, given its sure cuts."""
        if not self.plain:
            return self.chunk(text)
        if self.split and any(s in text for s in self.special):
            out = []
            for part in self.split.split(text):
                if part in self.special:
                    out.append((np.array([self.special[part]], "<u4").tobytes(), part))
                elif part:
                    out.append(self.encode_plain(part, sure_cuts(part)))
            return b"".join(x for x, _ in out), b"".join(x for _, x in out)
        return self.encode_plain(text, cuts)

    def encode_plain(self, text: bytes, cuts: list[int]) -> tuple[bytes, bytes]:
        if not text:
            return b"", b""
        out, chunk, at = [], self.chunk, 0
        for end in [*cuts, len(text)]:
            out.append(chunk(text[at:end]))
            at = end
        return b"".join([x for x, _ in out]), b"".join([x for _, x in out])


def plain_bytes(spec: dict) -> bool:
    """Whether a tokenizer file splits and joins as this module knows: bytes
    by the word pattern above, special tokens taken literally."""
    pre, model, decoder = (spec.get(k) or {} for k in ("pre_tokenizer", "model", "decoder"))
    return (spec.get("normalizer") is None and pre.get("type") == decoder.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")))


def byte_letters() -> dict[str, int]:
    """Byte of each letter that byte-level vocabularies write bytes as:
    printable Latin-1 as itself, the others in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def rolling(x: np.ndarray) -> np.ndarray:
    """Rolling hash of the SPAN bytes before each position from SPAN on."""
    h = (x.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    m, size = 0x85EBCA6B, 1
    while size < SPAN:
        h = h[:-size] * np.uint32(m) + h[size:]
        m, size = m * m % 2 ** 32, size * 2
    return (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(12)


def sure_positions(x: np.ndarray) -> np.ndarray:
    """Positions that the rolling hash chooses among blanks ahead of a
    character that is no white space (of those beyond ASCII, the ones whose
    first byte no white space has), and ideographs after East Asian
    punctuation."""
    if len(x) <= SPAN + 1:
        return np.zeros(0, np.int64)
    edge = np.flatnonzero((x[SPAN:-1] == 32) & SEEN[x[SPAN + 1:]]) + SPAN
    wide = np.flatnonzero((x[SPAN:] >= 0xE5) & (x[SPAN:] <= 0xE8)) + SPAN
    if len(wide):
        before = x[wide - 3].astype(np.int32) << 16 | x[wide - 2].astype(np.int32) << 8 | x[wide - 1]
        edge = np.union1d(edge, wide[np.isin(before, STOPS)])
    return edge[rolling(x)[edge - SPAN] & np.uint32(MASK) == 0]


def sure_cuts(text: bytes) -> list[int]:
    return sure_positions(np.frombuffer(text, np.uint8)).tolist()


def forced(text: bytes) -> list[bytes]:
    """Content-defined chunks of a stretch without sure cuts."""
    x = np.frombuffer(text, np.uint8)
    starts = (x & 0xC0) != 0x80  # of characters
    h = np.zeros(len(x), np.uint32)
    h[SPAN:] = rolling(x)[:len(x) - SPAN]
    chosen = np.flatnonzero(starts & (h & np.uint32(1023) == 7))
    out, at = [], 0
    for c in [*chosen.tolist(), len(text)]:
        while c - at > MAX_CHUNK:
            end = at + MAX_CHUNK
            while not starts[end]:
                end -= 1
            out.append(text[at:end])
            at = end
        if c > at and (c - at >= 256 or c == len(text)):
            out.append(text[at:c])
            at = c
    return out


def encode_batch(codec: Codec, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
    data = b"".join(texts)
    cuts = sure_positions(np.frombuffer(data, np.uint8))
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    # a cut's hash sees SPAN bytes of its own text, so that equal texts agree
    lo, hi = np.searchsorted(cuts, begins + SPAN), np.searchsorted(cuts, ends - 1)
    return [codec.encode(t, (cuts[a:b] - s).tolist()) for t, a, b, s in zip(texts, lo, hi, begins, strict=True)]


def bpe(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """(row struct without the text, ids binary, decoded binary) for every row
    of ``df``: ids as little-endian unsigned 32-bit integers, decoded the
    UTF-8 bytes of the text that the ids decode to.  ``path``: the tokenizer
    file, found under that path on every executor."""
    mark = "__row"  # a struct needs a field
    while mark in df.columns:
        mark += "_"
    src = df.select(F.struct(*[column(c) for c in df.columns if c != text_col], F.lit(True).alias(mark)).alias("row"), text_bytes(text_col).alias("text"))

    def run(batches):
        codec = Codec(path)
        for b in slices(batches):
            out = encode_batch(codec, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([x for x, _ in out], pa.binary()),
                                              pa.array([x.decode("utf-8", "replace").encode() for _, x in out], pa.binary())], names=["row", "ids", "decoded"])

    out = map_arrow(src, run, T.StructType([src.schema["row"], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())]))
    return out.withColumn("row", F.col("row").dropFields(mark)) if len(src.schema["row"].dataType) > 1 else out


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 beside the row."""
    return encoded.select("row", *more, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(FILE)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(bpe(docs, default_path())).select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
