"""Best-fit packing with certified bin counts.

Documents become token ids, one end id is added, longer ones are cut into pieces
of the sequence length (the first piece takes the remainder), and pieces are
packed into as few sequences as can be shown. Pieces are dealt to groups of a
bounded size by hash. Each group is packed by best-fit decreasing, and a lower
bound from dual feasible functions certifies it when the bound equals its bin
count. Groups with a gap hand all documents of their unfilled bins to an exchange,
certified ones only those of their emptiest bin; the exchange is dealt anew to as
few groups as its tokens need, and rerun. A rerun counts only if it saves bins.

Defined results: null and empty texts are the end id alone; repeated rows are
packed each; texts of any length are tokenised whole; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import base64
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import doc_columns, with_uid, written

SEQUENCE, END_ID = 2048, 0
GROUP_TOKENS, GROUP_PIECES, ROUNDS = 2_000_000, 200_000, 6


class PieceEncoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    The vocabulary never joins what is before a space to the space, so a text
    without runs of white space that end in a space is cut there, and each
    space-led word's ids are looked up; ``limit`` bounds the memory of that table.
    """

    SPECIAL = "<|endoftext|>"

    def __init__(self, ranks_path: str, json_path: str, pattern: str, limit: int = 400_000):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._starts_with_space = {i: token[:1] == b" " for token, i in ranks.items()}
        self._encode = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks,
                                         special_tokens={}).encode_ordinary
        self._json, self._full, self._limit = json_path, None, limit
        self._known: dict[str, bytes] = {}
        self._leads: np.ndarray | None = None

    def _bytes(self, text: str) -> bytes:
        return np.array(self._encode(text), dtype="<u4").tobytes()

    def word(self, word: str) -> bytes:
        """Ids of a space-led word."""
        ids = self._encode(" " + word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def words(self, words: list[bytes]) -> list[bytes]:
        """``word`` of each, in one call: no piece goes on over a space, and only an id
        that begins a word has one. White space of any script in a word undoes that."""
        each = [w.decode("utf-8", "replace") for w in words]
        joined = " ".join(each)
        if joined.split() != each:
            return [self.word(w) for w in each]
        if not each:
            return []
        ids = np.array(self._encode(" " + joined), "<u4")
        if self._leads is None:
            self._leads = self.leads_with_space(max(self._starts_with_space) + 1)
        at = (4 * np.append(np.flatnonzero(self._leads[ids]), len(ids))).tolist()
        data = ids.tobytes()
        return [data[lo:hi] for lo, hi in zip(at, at[1:])]

    def leads_with_space(self, size: int) -> np.ndarray:
        """Which ids' bytes begin with a space; the last one, for the end, counts as well."""
        return np.array([self._starts_with_space.get(i, i == size - 1) for i in range(size)])

    def _special(self, text: str) -> bytes:
        if self._full is None:
            from tokenizers import Tokenizer

            self._full = Tokenizer.from_file(self._json)
        return np.array(self._full.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.SPECIAL in text:
            return self._special(text)
        first, *words = text.split(" ")
        if not first or first[-1].isspace():
            return self._bytes(text)
        known, out = self._known, [self._bytes(first)]
        for w in words:
            ids = known.get(w)
            if ids is None:
                if not w or w[-1].isspace():
                    return self._bytes(text)
                if len(known) >= self._limit:
                    known.clear()
                ids = known[w] = self.word(w)
            out.append(ids)
        return b"".join(out)


_encoders: dict[tuple, PieceEncoder] = {}


def encoder(name: str) -> PieceEncoder:
    """This worker's encoder for a public byte-level vocabulary (cached)."""
    import public_tokenizers as files

    if name not in _encoders:
        _encoders[name] = PieceEncoder(files.path(f"{name}.tiktoken"), files.path(f"{name}.json"), files.PATTERN)
    return _encoders[name]


def pieces(docs: DataFrame, vocabulary: str = "byte_bpe_50k", length: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """_uid, doc_id, piece, start, length, ids_crc32 of every piece of every row."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(vocabulary)
        for b in batches:
            # rows of a batch one at a time: a long text is not held twice
            out = [[], [], [], [], [], []]
            for uid, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                ids = ids_of.encode(text.as_py() or "") + end
                n = len(ids) // 4
                lo, k = 0, 0
                while lo < n:
                    size = n % length or length if lo == 0 and n > length else min(length, n)
                    for column, value in zip(out, (uid, doc_id, k, lo, size, zlib.crc32(ids[4 * lo:4 * (lo + size)]))):
                        column.append(value)
                    lo, k = lo + size, k + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], b.schema.field(1).type), pa.array(out[2], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in out[3:]]],
                names=["_uid", "doc_id", "piece", "start", "length", "ids_crc32"])

    d = with_uid(doc_columns(docs, {"doc_id": "doc_id", "text": "text"})).select("_uid", "doc_id", F.col("text").cast("string"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(cut, f"_uid long, doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Largest of the bounds that dual feasible functions give on the bins needed."""
    if not len(sizes):
        return 0
    x = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((x * size).sum()) // capacity)
    # sizes over capacity - k count as whole bins, those under k not at all
    whole = np.concatenate([np.cumsum(x[::-1])[::-1], [0]])  # pieces of at least a size
    volume = np.concatenate([[0], np.cumsum(x * size)])  # volume of pieces under a size
    k = np.arange(1, capacity // 2 + 1)
    best = max(best, int((whole[capacity - k + 1] + -(-(volume[capacity - k + 1] - volume[k]) // capacity)).max()))
    for k in range(1, 33):  # rounding to multiples of capacity / (k + 1)
        scaled = (k + 1) * size
        f = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((x * f).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place of each size; every piece goes to the fullest bin it fits."""
    bins, places = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0  # bit r of rooms: some bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        fit = rooms >> s
        if fit:
            room = s + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, used
            used += 1
        bins[i], places[i] = b, capacity - room
        room -= s
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins, places


_PACKED = "_uid long, piece int, length long, bin long, offset long, room long, lower long, bins long"


def _pack_group(capacity: int, round_no: int):
    def run(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["length", "_uid", "piece"], ascending=[False, True, True], ignore_index=True)
        sizes = g["length"].to_numpy()
        bins, places = best_fit_decreasing(sizes, capacity)
        room = capacity - np.bincount(bins, weights=sizes).astype(np.int64)
        return pd.DataFrame({
            "_uid": g["_uid"], "piece": g["piece"], "length": sizes,
            # round, group and bin of the group in one number
            "bin": ((round_no << 56) | (int(key[0]) << 24)) + bins, "offset": places, "room": room[bins],
            "lower": lower_bound(sizes, capacity), "bins": len(room)})
    return run


def _deal(items: DataFrame, tokens: int, count: int, round_no: int) -> DataFrame:
    groups = max(1, -(-tokens // GROUP_TOKENS), -(-count // GROUP_PIECES))
    return items.withColumn("_group", F.pmod(F.xxhash64("_uid", "piece", F.lit(round_no)), F.lit(groups)))


def pack(items: DataFrame, capacity: int = SEQUENCE, rounds: int = ROUNDS) -> DataFrame:
    """(_uid, piece, length) -> also bin and offset. ``items`` is a written table.

    The driver sees a handful of sums a round. A round's exchange moves only what
    its bins left open, so the rounds shrink; a group's size never depends on the data.
    """
    done, pool = None, items.select("_uid", "piece", "length")
    old = None  # how the pool is packed so far, and in how many bins
    for r in range(rounds):
        size = pool.agg(F.sum("length"), F.count(F.lit(1))).first()
        if not size[1]:
            break
        packed = written(_deal(pool, size[0], size[1], r).groupBy("_group")
                         .applyInPandas(_pack_group(capacity, r), _PACKED))
        if old is not None:
            bins = packed.agg(F.count_distinct("bin")).first()[0]
            if bins >= old[1]:
                break
        if done is not None:
            done = done.unionByName(kept)
        # emptiest bin of each group, by (room, bin); the bins of a group are few thousand rows
        group = F.shiftright("bin", 24)
        emptiest = packed.groupBy(group.alias("_g")).agg(F.max(F.struct("room", "bin")).alias("_e")).select("_e.bin")
        marked = packed.join(emptiest.withColumn("_emptiest", F.lit(True)), "bin", "left")
        open_ = (F.col("room") > 0) & (F.coalesce("_emptiest", F.lit(False)) | (F.col("bins") > F.col("lower")))
        marked = written(marked.withColumn("_open", open_))
        kept, left = marked.filter("not _open"), marked.filter("_open")
        if done is None:
            done = kept.limit(0)
        pool = left.select("_uid", "piece", "length")
        old = (left, left.agg(F.count_distinct("bin")).first()[0])
        single = size[0] <= GROUP_TOKENS and size[1] <= GROUP_PIECES
        if single or not old[1]:
            break
    if old is None:
        return items.select("_uid", "piece", "length", F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset")).limit(0)
    return done.unionByName(kept).unionByName(old[0]).select("_uid", "piece", "length", "bin", "offset")


def pack_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k", length: int = SEQUENCE,
                   end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = written(pieces(docs, vocabulary, length, end_id))
    placed = pack(cut, length)
    return cut.join(placed.drop("length"), ["_uid", "piece"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
