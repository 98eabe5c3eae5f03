"""SentencePiece encoding and decoding, with a max-plus parallel scan for giant documents.

Texts up to ``giant`` characters are encoded by the library, each in its task.  A
giant text is split into chunks.  A segmentation is a path of pieces; its *state* at
a cut is the last piece that ends at or before the cut while the next one ends after
it.  Each chunk yields, on its own, a transfer matrix: the best score of a path from
each possible state at its start to each at its end.  Max-plus products of the
matrices are associative: blocks of chunks are multiplied in parallel, a document's
few block products give the states at the blocks' ends, blocks then give the states
at their chunks' ends, and every chunk is backtraced independently between its two
known states.  No task holds more than a block's matrices, a document's block
products, or a chunk's text.

Unigram models: a path's score is the sum of its pieces' scores.  BPE models: pieces
weigh nothing, and two pieces may only follow each other if the merges, run on the
two together, give just these two; the one path of such pairs is what the merges
give on the whole text.  Both equal the library (which sums unigram scores in single
precision, so that ties on long texts may fall otherwise there).
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import materialise

GIANT, CHUNK, BLOCK = 100_000, 16_384, 256
MATRIX = "k1 bigint, k2 bigint, k bigint, ep array<bigint>, et array<bigint>, xp array<bigint>, " \
         "xt array<bigint>, w array<double>"
START = -(1 << 40)  # the state before the first piece: (0, START)
UNKNOWN_PENALTY = 10.0  # fixed value: how far below the worst piece an unknown character is


@dataclass
class Lattice:
    """A model's pieces as the scan needs them.  A piece is named by its id, a character
    that no piece has by -1 - code point."""
    ids: dict[str, int]
    scores: list[float]
    bpe: bool
    longest: int
    unknown: float
    bytes_at: list[int]
    follows: dict[tuple[int, int], bool] = field(default_factory=dict)
    whole: dict[int, bool] = field(default_factory=dict)
    pieces: list[str] = field(default_factory=list)

    def name(self, token: int) -> str:
        return self.pieces[token] if token >= 0 else chr(-1 - token)

    def merged(self, text: str) -> list[str]:
        """The merges on a short text: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            at, best = -1, -np.inf
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and self.scores[found] > best:
                    at, best = i, self.scores[found]
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def usable(self, token: int) -> bool:
        if not self.bpe or token < 0:
            return True
        ok = self.whole.get(token)
        if ok is None:
            ok = self.whole[token] = len(self.merged(self.pieces[token])) == 1
        return ok

    def may_follow(self, left: int, right: int) -> bool:
        if not self.bpe or left == START:
            return True
        ok = self.follows.get((left, right))
        if ok is None:
            if len(self.follows) > 1 << 20:
                self.follows.clear()
            a, b = self.name(left), self.name(right)
            ok = self.follows[left, right] = self.merged(a + b) == [a, b]
        return ok

    def starting(self, text: str, at: int) -> list[tuple[int, int]]:
        """(length, token) of the pieces that start here, shortest first."""
        out = []
        for n in range(1, min(self.longest, len(text) - at) + 1):
            token = self.ids.get(text[at:at + n])
            if token is None:
                if n > 1:
                    continue
                token = -1 - ord(text[at])
            if self.usable(token):
                out.append((n, token))
        return out

    def weight(self, token: int) -> float:
        return 0.0 if self.bpe else self.scores[token] if token >= 0 else self.unknown

    def output(self, tokens: list[int]) -> list[int]:
        out = []
        for t in tokens:
            out += [t] if t >= 0 else [self.bytes_at[b] for b in self.name(t).encode("utf-8", "replace")]
        return out


@functools.lru_cache(maxsize=4)
def processor(model: str | bytes):
    import sentencepiece

    if isinstance(model, bytes):
        return sentencepiece.SentencePieceProcessor(model_proto=model)
    return sentencepiece.SentencePieceProcessor(model_file=model)


@functools.lru_cache(maxsize=4)
def lattice(model: str | bytes, bpe: bool) -> Lattice | None:
    """None for a model without byte fallback: its unknown runs join across pieces."""
    sp = processor(model)
    n = sp.get_piece_size()
    if not any(sp.is_byte(i) for i in range(n)):
        return None
    pieces = [sp.id_to_piece(i) for i in range(n)]
    plain = {pieces[i]: i for i in range(n)
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    scores = [sp.get_score(i) for i in range(n)]
    return Lattice(plain, scores, bpe, max(map(len, plain)),
                   min(scores[i] for i in plain.values()) - UNKNOWN_PENALTY,
                   [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], pieces=pieces)


def entries(lat: Lattice, text: str, base: int, a: int) -> list[tuple[int, int]]:
    """All states a path can be in at cut ``a``; ``text`` starts at position ``base``."""
    if a == 0:
        return [(0, START)]
    out = []
    for p in range(max(1, a - lat.longest + 1), a + 1):
        if not lat.bpe:
            out.append((p, 0))
            continue
        for n in range(1, min(lat.longest, p - base) + 1):
            piece = text[p - n - base:p - base]
            token = lat.ids.get(piece, -1 - ord(piece) if n == 1 else None)
            if token is not None and lat.usable(token):
                out.append((p, token))
    return out


def transfer(lat: Lattice, text: str, base: int, a: int, b: int,
             start: list[tuple[int, int]]) -> dict:
    """{state at b: scores from each of ``start``} over the chunk [a, b)."""
    nodes: dict[int, dict[int, np.ndarray]] = {}
    for i, (p, t) in enumerate(start):
        v = np.full(len(start), -np.inf)
        v[i] = 0.0
        nodes.setdefault(p, {})[t] = v
    for p in range(min(nodes, default=b), b):
        here = nodes.get(p)
        if not here:
            continue
        for n, token in lat.starting(text, p - base):
            e = p + n
            if e > b or e <= a:
                continue
            w, tag = lat.weight(token), token if lat.bpe else 0
            for left, v in here.items():
                if lat.may_follow(left, token):
                    there = nodes.setdefault(e, {})
                    old = there.get(tag)
                    there[tag] = v + w if old is None else np.maximum(old, v + w)
        if p <= b - lat.longest:
            del nodes[p]
    return {(p, t): v for p, at in nodes.items() if b - lat.longest < p <= b and p > 0
            for t, v in at.items()}


def backtrace(lat: Lattice, text: str, base: int, a: int, b: int, entry: tuple[int, int],
              leave: tuple[int, int]) -> list[int]:
    """The pieces of the best path between two states."""
    nodes: dict[int, dict[int, tuple]] = {entry[0]: {entry[1]: (0.0, None, None)}}
    for p in range(entry[0], leave[0]):
        for n, token in lat.starting(text, p - base) if nodes.get(p) else ():
            e = p + n
            if e > b or e <= a:
                continue
            w, tag = lat.weight(token), token if lat.bpe else 0
            for left, (score, *_) in nodes[p].items():
                if lat.may_follow(left, token):
                    there = nodes.setdefault(e, {})
                    if tag not in there or score + w > there[tag][0]:
                        there[tag] = (score + w, (p, left), token)
    out, at = [], leave
    while at != entry:
        _, back, token = nodes[at[0]][at[1]]
        out.append(token)
        at = back
    return out[::-1]


Matrix = dict[tuple, dict[tuple, float]]  # {entry: {exit: score}}


def product(x: Matrix, y: Matrix) -> Matrix:
    """Max-plus: the best way through both."""
    out: Matrix = {}
    for entry, mids in x.items():
        row: dict[tuple, float] = {}
        for mid, s in mids.items():
            for leave, t in y.get(mid, {}).items():
                if s + t > row.get(leave, -np.inf):
                    row[leave] = s + t
        if row:
            out[entry] = row
    return out


def resolve(matrices: list[Matrix], entry: tuple | None = None,
            leave: tuple | None = None) -> list[tuple[tuple, tuple]]:
    """(entry, exit) of each matrix on the best way through the chain."""
    now = {e: 0.0 for e in matrices[0]} if entry is None else {entry: 0.0}
    first, steps = dict(now), []
    for m in matrices:
        best: dict[tuple, tuple[float, tuple]] = {}
        for e, s in now.items():
            for x, t in m.get(e, {}).items():
                if x not in best or s + t > best[x][0]:
                    best[x] = (s + t, e)
        steps.append(best)
        now = {x: s for x, (s, _) in best.items()}
    at = leave if leave is not None else max(now, key=now.get)
    out = []
    for best in reversed(steps):
        out.append((best[at][1], at))
        at = best[at][1]
    assert at in first
    return out[::-1]


def _pack(m: Matrix) -> dict:
    flat = [(e, x, w) for e, row in m.items() for x, w in row.items()]
    return {"ep": [e[0] for e, _, _ in flat], "et": [e[1] for e, _, _ in flat],
            "xp": [x[0] for _, x, _ in flat], "xt": [x[1] for _, x, _ in flat],
            "w": [float(w) for _, _, w in flat]}


def _unpack(row) -> Matrix:
    out: Matrix = {}
    for ep, et, xp, xt, w in zip(row.ep, row.et, row.xp, row.xt, row.w):
        out.setdefault((int(ep), int(et)), {})[int(xp), int(xt)] = w
    return out


def scan(texts: DataFrame, model: str | bytes, bpe: bool, chunk: int = CHUNK,
         block: int = BLOCK) -> DataFrame:
    """(k1, k2, text) -> (k1, k2, ids), by the max-plus scan."""
    longest = lattice(model, bpe).longest
    chunk = max(chunk, 2 * longest)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k1", "k2", "k", "base", "a", "b", "part"]
        for batch in batches:
            for row in batch.to_pylist():
                text = processor(model).normalize(row["text"])
                cuts = list(range(0, max(1, len(text) - chunk // 2), chunk)) + [len(text)]
                out = [(row["k1"], row["k2"], k, max(0, a - 2 * longest), a, b,
                        text[max(0, a - 2 * longest):b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lat = lattice(model, bpe)
        for batch in batches:
            for r in batch.itertuples(index=False):
                start = entries(lat, r.part, r.base, r.a)
                found = transfer(lat, r.part, r.base, r.a, r.b, start)
                if r.last:  # a whole text ends with a piece's end
                    found = {x: v for x, v in found.items() if x[0] == r.b}
                m: Matrix = {}
                for x, v in found.items():
                    for i in np.flatnonzero(v > -np.inf):
                        m.setdefault(start[i], {})[x] = v[i]
                yield pd.DataFrame([{"k1": r.k1, "k2": r.k2, "k": r.k, **_pack(m)}])

    chunks = texts.select("k1", "k2", "text").mapInArrow(
        split, "k1 bigint, k2 bigint, k bigint, base bigint, a bigint, b bigint, part string")
    chunks = materialise(chunks.repartition("k1", "k2", "k"), "pieces-chunks")
    ends = chunks.groupBy("k1", "k2").agg(F.max("k").alias("_m"))
    chunks = chunks.join(ends, ["k1", "k2"]).withColumn("last", F.col("k") == F.col("_m")).drop("_m")
    each = materialise(chunks.mapInPandas(matrices, MATRIX), "pieces-matrices").withColumn(
        "blk", F.floor(F.col("k") / block))

    def multiply(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        chain = [_unpack(r) for r in rows.sort_values("k").itertuples(index=False)]
        return pd.DataFrame([{"k1": key[0], "k2": key[1], "k": key[2],
                              **_pack(functools.reduce(product, chain))}])

    def states(rows: pd.DataFrame, entry=None, leave=None) -> pd.DataFrame:
        rows = rows.sort_values("k")
        found = resolve([_unpack(r) for r in rows.itertuples(index=False)], entry, leave)
        return pd.DataFrame({"k1": rows["k1"].to_numpy(), "k2": rows["k2"].to_numpy(),
                             "k": rows["k"].to_numpy(),
                             "state": [[*e, *x] for e, x in found]})

    def inside(rows: pd.DataFrame) -> pd.DataFrame:
        e = [int(x) for x in rows["state"].iloc[0]]
        return states(rows, (e[0], e[1]), (e[2], e[3]))

    kind = "k1 bigint, k2 bigint, k bigint, state array<bigint>"
    blocks = materialise(each.groupBy("k1", "k2", "blk").applyInPandas(multiply, MATRIX),
                         "pieces-blocks")
    tops = blocks.groupBy("k1", "k2").applyInPandas(lambda rows: states(rows), kind)
    known = (each.join(tops.withColumnRenamed("k", "blk"), ["k1", "k2", "blk"])
             .groupBy("k1", "k2", "blk").applyInPandas(inside, kind))

    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lat = lattice(model, bpe)
        for batch in batches:
            for r in batch.itertuples(index=False):
                s = [int(x) for x in r.state]
                tokens = backtrace(lat, r.part, r.base, r.a, r.b, (s[0], s[1]), (s[2], s[3]))
                yield pd.DataFrame([{"k1": r.k1, "k2": r.k2, "k": r.k, "ids": lat.output(tokens)}])

    traced = chunks.join(known, ["k1", "k2", "k"]).mapInPandas(
        trace, "k1 bigint, k2 bigint, k bigint, ids array<int>")
    return (traced.groupBy("k1", "k2")
            .agg(F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("x"))
            .select("k1", "k2", F.flatten("x.ids").alias("ids")))


def encode(docs: DataFrame, model: str, bpe: bool = True, giant: int = GIANT, chunk: int = CHUNK,
           block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``, one row per input row, ids as the library's, none added.

    ``bpe``: the model's kind.  A null or empty text has no ids.  Null and repeated ids
    are kept; equal giant texts are encoded once; other columns are not looked at; an
    empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    large = (F.char_length("text") > giant) if lattice(model, bpe) is not None else F.lit(False)

    def library(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        for b in batches:
            texts = b.column("text").to_pylist()
            for at in range(0, len(texts), 500):
                ids = sp.encode(texts[at:at + 500], num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(at, 500), pa.array(ids, pa.list_(pa.int32()))],
                    names=["doc_id", "ids"])

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>"
    plain = rows.where(~large).mapInArrow(library, schema)
    giants = rows.where(large).withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})
    found = scan(giants.dropDuplicates(["k1", "k2"]), model, bpe, chunk, block)
    named = giants.select("doc_id", "k1", "k2").join(found, ["k1", "k2"]).select("doc_id", "ids")
    return plain.unionAll(named)


def decode(rows: DataFrame, model: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``rows`` with the text of ``ids_col`` in ``out_col``, in place of a column of that
    name; null ids give a null text."""
    if out_col != ids_col:
        rows = rows.drop(out_col)
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        for b in batches:
            texts = [None if ids is None else sp.decode(ids) for ids in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             names=[*b.schema.names, out_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, `{out_col}` string")


def summary(encoded: DataFrame, model: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32, decoded_sha256)``: the CRC-32 (unsigned) of the ids as
    little-endian unsigned 32-bit numbers, and the SHA-256 of the text they decode to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        import hashlib

        for b in batches:
            ids = b.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(sp.decode(x).encode()).hexdigest() for x in ids])],
                names=["doc_id", "n_tokens", "ids_crc32", "decoded_sha256"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_crc32 bigint, decoded_sha256 string")
