"""SentencePiece encoding and decoding by a max-plus parallel scan.

Encoding is the best path through the lattice of vocabulary pieces: the sum of piece
scores is greatest, and at equal sums the piece that starts earlier wins at every
position. A file made for merges holds ranks r, not scores; a piece then scores -log(r + 2), as
if its share of a text fell with its rank (ids are the best path over these, not the file's
own merge order). Scores are whole numbers of 1 / ``UNIT``, so that sums don't depend on their
order. Texts up to ``chunk``
characters are encoded where they are read. Longer ones are cut into chunks that
other tasks take: a chunk's transfer matrix holds the best score from every entry
state to every exit state, where a state says how far the piece across the boundary
reaches into the next chunk. Matrices are combined in a tree (max-plus products are
associative), which gives each chunk the scores of its entry states; with them each
chunk knows which entry every exit comes from, and these maps, composed in the same
tree, give every chunk its exit; then all chunks backtrace independently.

No piece has the word mark after another character, so a path always breaks before a
word, and words' encodings are remembered in a table of bounded size. Words not in it
are taken in blocks: one numpy pass per position advances all words of a block through
the trie of the pieces, with the sums and ties of the plain pass.

Defined results: null and empty texts have no ids; characters outside the vocabulary
are byte pieces; a text that itself holds the word mark U+2581 decodes to a space there,
as the format has it; repeated rows are encoded each; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import doc_columns, with_uid, written

MODEL, CHUNK, FAN, MARK = "piece_bpe_32k", 32_768, 64, "▁"
_REMEMBERED, _LONGEST_WORD, _BLOCK, _GROUP_CHARS = 300_000, 64, 8192, 1 << 20
_LOW, UNIT = -np.inf, 1 << 16


def unit_scores(raw: list[float]) -> list[float]:
    """Piece scores in whole units: ranks (0, -1, -2, ...) by their logarithm, others as they are."""
    ranks = all(s <= 0 and s == int(s) for s in raw)
    return [-float(round(math.log(2 - s) * UNIT)) if ranks else float(round(s * UNIT)) for s in raw]


class Pieces:
    """Vocabulary of a SentencePiece model file with its scores, as a lattice."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.known: dict[str, tuple[int, float]] = {}
        self.text: list[bytes] = []
        bytes_of: dict[int, int] = {}
        scores = unit_scores([sp.get_score(i) for i in range(sp.get_piece_size())])
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            plain = not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))
            if plain:
                self.known[piece] = (i, scores[i])
            if sp.is_byte(i):
                bytes_of[int(piece[3:5], 16)] = i
            self.text.append(bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else
                             piece.replace(MARK, " ").encode() if plain else b"")
        self.byte_ids = [bytes_of.get(b, sp.unk_id()) for b in range(256)]
        self.unknown = min(s for _, s in self.known.values()) - 10.0 * UNIT
        self.states = max(map(len, self.known))
        self.prefixes = {p[:n] for p in self.known for n in range(1, len(p) + 1)}
        if any(MARK in p.lstrip(MARK) for p in self.known):
            raise ValueError("a piece has the word mark after another character")
        # score of each id; a character of byte pieces counts once, at its first byte
        self.scores = np.array(scores, np.float64)
        for b, i in enumerate(self.byte_ids):
            self.scores[i] = 0.0 if 0x80 <= b < 0xC0 else self.unknown
        self._words: dict[str, bytes] = {}
        self._build_trie()

    def _build_trie(self) -> None:
        """Edges as sorted keys (node, character code); code 0 is in no piece."""
        letters = sorted({c for p in self.known for c in p})
        code = {c: i + 1 for i, c in enumerate(letters)}
        self._code_of = np.zeros(0x110000, np.int32)
        self._code_of[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self._alphabet = len(letters) + 1
        node = {"": 0, **{p: i + 1 for i, p in enumerate(self.prefixes)}}
        keys = np.array([node[p[:-1]] * self._alphabet + code[p[-1]] for p in self.prefixes], np.int64)
        order = np.argsort(keys)
        self._edges = np.append(keys[order], np.iinfo(np.int64).max)
        self._child = np.append(order + 1, 0)
        self._node_id, self._node_score = np.zeros(len(node), np.uint32), np.full(len(node), _LOW)
        self._single = np.zeros(self._alphabet, bool)  # characters that are pieces
        for p, (i, score) in self.known.items():
            self._node_id[node[p]], self._node_score[node[p]] = i, score
            if len(p) == 1:
                self._single[code[p]] = True

    def _solve(self, words: list[str]) -> dict[str, bytes]:
        """Ids of non-empty words, by the recurrence of ``forward`` for all words at once."""
        n, lengths = len(words), np.fromiter(map(len, words), np.int64, len(words))
        longest = int(lengths.max())
        codes = np.zeros((n, longest), np.int64)
        codes[np.arange(longest) < lengths[:, None]] = self._code_of[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        plain = (self._single[codes] | (np.arange(longest) >= lengths[:, None])).all(axis=1)
        best = np.full((n, longest + 1), _LOW)
        best[:, 0] = 0.0
        back, ids = np.zeros((n, longest + 1), np.int64), np.zeros((n, longest + 1), np.uint32)
        for i in range(longest):
            row = np.flatnonzero(plain & (lengths > i))
            node, at, j = np.zeros(len(row), np.int64), best[row, i], i
            while len(row):
                key = node * self._alphabet + codes[row, j]
                edge = np.searchsorted(self._edges, key)
                on = self._edges[edge] == key
                row, node, at, j = row[on], self._child[edge[on]], at[on], j + 1
                total = at + self._node_score[node]
                better = total > best[row, j]
                won = row[better]
                best[won, j], back[won, j], ids[won, j] = total[better], i, self._node_id[node[better]]
                on = lengths[row] > j
                row, node, at = row[on], node[on], at[on]
        out, count = np.zeros((n, longest), "<u4"), np.zeros(n, np.int64)
        at = np.where(plain, lengths, 0)
        row = np.flatnonzero(at)
        while len(row):
            count[row] += 1
            out[row, longest - count[row]] = ids[row, at[row]]
            at[row] = back[row, at[row]]
            row = row[at[row] > 0]
        found = {w: out[k, longest - c:].tobytes() for k, (w, c) in enumerate(zip(words, count.tolist())) if c}
        for k in np.flatnonzero(~plain).tolist():  # characters of byte pieces
            w = words[k]
            found[w] = self.trace(w, self.forward(w, len(w), [0.0])[1], len(w))[1]
        return found

    def learn(self, words: Iterable[str]) -> None:
        """Put the encodings of all ``words`` of bounded length into the table."""
        known = self._words
        missing = {w for w in words if w not in known and len(w) <= _LONGEST_WORD}
        if len(known) + len(missing) > _REMEMBERED:
            known.clear()
            missing = {w for w in words if len(w) <= _LONGEST_WORD}
        ordered = sorted(missing, key=len)
        for lo in range(0, len(ordered), _BLOCK):
            known.update(self._solve(ordered[lo:lo + _BLOCK]))

    def forward(self, text: str, end: int, entry: list[float]) -> tuple[list[float], list[int]]:
        """Best score of every position and the start of the piece that ends there (-1:
        an entry). Pieces start before ``end`` and may reach past it, within ``text``."""
        n, known, prefixes = len(text), self.known, self.prefixes
        best = entry[:n + 1] + [_LOW] * (n + 1 - len(entry))
        back = [-1] * (n + 1)
        for i in range(end):
            at = best[i]
            if at == _LOW:
                continue
            j = i + 1
            while j <= n:
                piece = text[i:j]
                if piece not in prefixes:
                    break
                found = known.get(piece)
                if found is not None and at + found[1] > best[j]:
                    best[j], back[j] = at + found[1], i
                j += 1
            if text[i] not in known and at + self.unknown > best[i + 1]:
                best[i + 1], back[i + 1] = at + self.unknown, i
        return best, back

    def trace(self, text: str, back: list[int], at: int) -> tuple[int, bytes]:
        """Entry and ids of the path that ends at position ``at``."""
        spans = []
        while back[at] >= 0:
            spans.append((back[at], at))
            at = back[at]
        ids = []
        for lo, hi in reversed(spans):
            found = self.known.get(text[lo:hi])
            if found is None:
                ids.extend(self.byte_ids[b] for b in text[lo:hi].encode())
            else:
                ids.append(found[0])
        return at, np.array(ids, dtype="<u4").tobytes()

    def score(self, ids: bytes) -> int:
        return int(self.scores[np.frombuffer(ids, "<u4")].sum())

    def word(self, word: str) -> bytes:
        """Ids of a text that a path can't leave but at its ends."""
        found = self._words.get(word)
        if found is None:
            _, back = self.forward(word, len(word), [0.0])
            _, found = self.trace(word, back, len(word))
            if len(word) <= _LONGEST_WORD:
                if len(self._words) >= _REMEMBERED:
                    self._words.clear()
                self._words[word] = found
        return found

    def words(self, text: str) -> list[str]:
        """``text`` cut before every run of word marks."""
        parts = text.split(MARK)
        if "" in parts[1:]:
            return re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", text)
        return [*([parts[0]] if parts[0] else []), *[MARK + p for p in parts[1:]]]

    def encode(self, text: str) -> bytes:
        """Ids (little-endian 32 bit) of a whole marked text."""
        words = self.words(text)
        if len(words) >= 1024:
            self.learn(words)
        return b"".join(map(self.word, words))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """``encode`` of each text, with unknown words learnt for many short texts at once."""
        lo = 0
        while lo < len(texts):
            hi, held = lo, 0
            while hi < len(texts) and held < _GROUP_CHARS:
                held, hi = held + len(texts[hi]), hi + 1
            words = [self.words(t) for t in texts[lo:hi]]
            self.learn({w for ws in words for w in ws})
            for ws in words:
                yield b"".join(map(self.word, ws))
            lo = hi

    def decode(self, ids: bytes) -> bytes:
        out = b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return out[1:] if out[:1] == b" " else out

    def matrix(self, body: str, ahead: str, last: bool) -> np.ndarray:
        """Transfer matrix of a chunk: entry overhang x exit overhang."""
        s = self.states
        m = np.full((s, s), _LOW)
        text, n = body + ahead, len(body)
        exits = 1 if last else min(s, len(ahead) + 1)
        cuts = self.cuts(body)
        if cuts:
            first, final = cuts
            middle = self.score(self.encode(body[first:final]))
            tail, _ = self.forward(text[final:], n - final, [0.0])
            for i in range(min(s, first + 1)):
                head, _ = self.forward(body[i:first], first - i, [0.0])
                m[i, :exits] = head[-1] + middle + np.array(tail[n - final:n - final + exits])
        else:
            for i in range(min(s, n + 1)):
                best, _ = self.forward(text, n, [_LOW] * i + [0.0])
                m[i, :exits] = best[n:n + exits]
        return m - m.max()  # only differences matter

    @staticmethod
    def cuts(body: str) -> tuple[int, int] | None:
        """First and last place in a chunk where a path always breaks."""
        first = re.search(f"(?<=[^{MARK}]){MARK}", body)
        if first is None:
            return None
        final = body.rstrip(MARK).rfind(MARK)
        while final > 0 and body[final - 1] == MARK:
            final -= 1
        if body.endswith(MARK):
            final = max(final, len(body.rstrip(MARK)))
        return first.start(), max(final, first.start())

    def origins(self, body: str, ahead: str, last: bool, entry: list[float]) -> bytes:
        """For every exit state the entry state its best path comes from."""
        text, n, cuts = body + ahead, len(body), self.cuts(body)
        exits = 1 if last else min(self.states, len(ahead) + 1)
        if cuts:  # all paths pass the first break
            text, n, places = body[:cuts[0]], cuts[0], [cuts[0]] * exits
        else:
            places = [n + j for j in range(exits)]
        _, back = self.forward(text, n, entry)
        out = [0] * self.states
        for j, at in enumerate(places):
            while back[at] >= 0:
                at = back[at]
            out[j] = min(at, self.states - 1)
        return bytes(out)

    def backtrace(self, body: str, ahead: str, entry: list[float], exit_: int) -> bytes:
        """Ids of the pieces that start in the chunk."""
        text, n, cuts = body + ahead, len(body), self.cuts(body)
        if not cuts:
            return self.trace(text, self.forward(text, n, entry)[1], n + exit_)[1]
        first, final = cuts
        head = self.trace(body[:first], self.forward(body[:first], first, entry)[1], first)[1]
        tail = self.trace(text[final:], self.forward(text[final:], n - final, [0.0])[1], n - final + exit_)[1]
        return head + self.encode(body[first:final]) + tail


_loaded: dict[str, Pieces] = {}


def pieces(model: str) -> Pieces:
    """This worker's vocabulary (cached): a public model's name or a file's path."""
    if model not in _loaded:
        import public_tokenizers as files

        _loaded[model] = Pieces(model if "/" in model else files.path(f"{model}.model"))
    return _loaded[model]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product, shifted so that its greatest entry is 0."""
    c = (a[:, :, None] + b[None, :, :]).max(axis=1)
    return c - c.max()


def _matrix(blob: bytes, s: int) -> np.ndarray:
    return np.frombuffer(blob, np.float64).reshape(-1, s)


def _tree(leaves: DataFrame, levels: int, join) -> list[DataFrame]:
    """``leaves`` (_uid, k, m) and each level above: FAN neighbours joined in order."""
    out = [leaves]
    for _ in range(levels):
        def up(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"_uid": [key[0]], "k": [key[1]], "m": [join(g.sort_values("k")["m"].tolist())]})

        out.append(written(out[-1].withColumn("p", F.floor(F.col("k") / FAN).cast("long"))
                           .groupBy("_uid", "p").applyInPandas(up, "_uid long, k long, m binary")))
    return out


def _down(tree: list[DataFrame], root, spread) -> DataFrame:
    """From the top level's value (``root``) every leaf's: ``spread`` takes a parent's
    value and its children's entries in order."""
    value = tree[-1].select("_uid", "k", F.lit(bytearray(root)).alias("v"))
    for level in reversed(tree[:-1]):
        def down(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
            g = g.sort_values("k")
            return pd.DataFrame({"_uid": g["_uid"], "k": g["k"], "v": spread(g["v"].iloc[0], g["m"].tolist())})

        parents = value.select("_uid", F.col("k").alias("p"), "v")
        value = written(level.withColumn("p", F.floor(F.col("k") / FAN).cast("long")).join(parents, ["_uid", "p"])
                        .groupBy("_uid", "p").applyInPandas(down, "_uid long, k long, v binary"))
    return value


def _chunk_map(df: DataFrame, fn, schema: str, *names: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [fn(*row) for row in zip(*[b.column(n).to_pylist() for n in names])]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(
                {"_uid": b.column("_uid").to_pylist(), "k": b.column("k").to_pylist(),
                 **{c.split()[0]: [o[i] for o in out] for i, c in enumerate(schema.split(", "))}}), preserve_index=False)

    return df.mapInArrow(run, f"_uid long, k long, {schema}")


def _encode_long(long: DataFrame, model: str, chunk: int) -> DataFrame:
    """_uid, doc_id, ids, score, n_chunks, text_crc32 of texts longer than a chunk (column marked)."""
    states = pieces(model).states
    parts = F.regexp_extract_all("marked", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    each = long.select("_uid", "doc_id", F.crc32(F.col("text").cast("binary")).alias("text_crc32"), parts.alias("parts")).select(
        "_uid", "doc_id", "text_crc32", F.size("parts").alias("n_chunks"), F.posexplode(F.transform("parts", lambda p, i: F.struct(
            p.alias("body"), F.coalesce(F.substring(F.get("parts", i + 1), 1, states - 1), F.lit("")).alias("ahead")))))
    # dealt out by chunk, so a document's chunks are worked on by many tasks
    # and a row is numbered once: nothing reads the input for its number again
    each = written(each.select("_uid", "doc_id", "text_crc32", F.col("pos").cast("long").alias("k"), "n_chunks", "col.body", "col.ahead",
                               (F.col("pos") == F.col("n_chunks") - 1).alias("last")).repartition("_uid", "k"), "zstd")
    most = each.agg(F.max("n_chunks")).first()[0]
    if most is None:
        return each.select("_uid", "doc_id", F.lit(b"").alias("ids"), F.lit(0).cast("long").alias("score"), "n_chunks",
                           "text_crc32").limit(0)
    levels, span = 0, 1
    while span < most:
        levels, span = levels + 1, span * FAN

    leaves = written(_chunk_map(each, lambda body, ahead, last: (pieces(model).matrix(body, ahead, last).tobytes(),),
                                "m binary", "body", "ahead", "last"))

    def joined(blobs: list[bytes]) -> bytes:
        m = _matrix(blobs[0], states)
        for b in blobs[1:]:
            m = product(m, _matrix(b, states))
        return m.tobytes()

    def entries(v: bytes, blobs: list[bytes]) -> list[bytes]:
        out, at = [], _matrix(v, states)
        for b in blobs:
            out.append(at.tobytes())
            at = product(at, _matrix(b, states))
        return out

    start = np.full((1, states), _LOW)
    start[0, 0] = 0.0
    entry = _down(_tree(leaves, levels, joined), start.tobytes(), entries)
    known = written(each.drop("doc_id", "text_crc32").join(entry, ["_uid", "k"]), "zstd")

    maps = written(_chunk_map(known, lambda body, ahead, last, v: (
        pieces(model).origins(body, ahead, last, np.frombuffer(v, np.float64).tolist()),),
        "m binary", "body", "ahead", "last", "v"))

    def composed(blobs: list[bytes]) -> bytes:
        out = blobs[-1]  # exit state of the last -> entry state of the first
        for b in reversed(blobs[:-1]):
            out = bytes(b[x] for x in out)
        return out

    def exits(v: bytes, blobs: list[bytes]) -> list[bytes]:
        out, at = [], v[0]
        for b in reversed(blobs):
            out.append(bytes([at]))
            at = b[at]
        return out[::-1]

    exit_ = _down(_tree(maps, levels, composed), bytes([0]), exits).withColumnRenamed("v", "x")

    def backtrace(body: str, ahead: str, v: bytes, x: bytes) -> tuple[bytes, int]:
        p = pieces(model)
        ids = p.backtrace(body, ahead, np.frombuffer(v, np.float64).tolist(), x[0])
        return ids, p.score(ids)

    traced = _chunk_map(known.join(exit_, ["_uid", "k"]), backtrace, "ids binary, score long", "body", "ahead", "v", "x")

    def whole(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        # a document's ids are as large as its text, which is one row of the input
        return pd.DataFrame({"_uid": [key[0]], "ids": [b"".join(g.sort_values("k")["ids"])],
                             "score": [int(g["score"].sum())], "n_chunks": [len(g)]})

    done = traced.groupBy("_uid").applyInPandas(whole, "_uid long, ids binary, score long, n_chunks int")
    return done.join(each.filter("k = 0").select("_uid", "doc_id", "text_crc32"), "_uid")


def encode(docs: DataFrame, model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """_uid, doc_id, ids (binary, little-endian 32 bit), score, n_chunks, text_crc32 of
    every row; score is in units of 1 / ``UNIT``. Encoding and decoding each run in a Python worker of their own; a caller
    that decodes at once writes the encoded table between them."""
    d = with_uid(doc_columns(docs, {"doc_id": "doc_id", "text": "text"})) \
        .withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in batches:
            texts = b.column("text").to_pylist()
            ids = list(p.encode_all([MARK + t.replace(" ", MARK) if t else "" for t in texts]))
            score = [p.score(x) for x in ids]
            crc = [zlib.crc32(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("_uid"), b.column("doc_id"), pa.array(ids, pa.binary()), pa.array(score, pa.int64()),
                 pa.array([1] * len(ids), pa.int32()), pa.array(crc, pa.int64())],
                names=["_uid", "doc_id", "ids", "score", "n_chunks", "text_crc32"])

    is_long = F.char_length("text") >= chunk
    short = d.filter(~is_long).mapInArrow(run, f"_uid long, doc_id {kind}, ids binary, score long, n_chunks int, text_crc32 long")
    long = d.filter(is_long).withColumn("marked", F.concat(F.lit(MARK), F.replace("text", F.lit(" "), F.lit(MARK))))
    return short.unionByName(_encode_long(long, model, chunk).select(*short.columns))


def decode(encoded: DataFrame, model: str = MODEL, name: str = "decoded") -> DataFrame:
    """``encoded`` with the text (binary, UTF-8) of its ids added."""

    @F.pandas_udf("binary")
    def of(ids: pd.Series) -> pd.Series:
        p = pieces(model)
        return ids.map(lambda x: p.decode(x))

    return encoded.withColumn(name, of("ids"))
