"""Cross-tokenizer alignment by lockstep vectorised merging.

Two tokenizers A and B cut the same bytes differently.  Walking both token
lists by byte ends, a pair of tokens that overlap is a *link*, a byte offset at
which both have an end is a *cut*; cuts part a text into the smallest groups of
A and B tokens that cover the same bytes.

The walk is one merge for many documents at once.  A state vector holds the A
and the B pointer of every unfinished document (a *lane*); at each step the
lanes' tokens are links, the pointers whose token ends first move on, lanes
where both end together emit a cut, and finished lanes are compacted away.  A
long document is several lanes, parted at offsets at which both tokenizers have
an end, so that no lane keeps a batch waiting.

Corpus counts (in how many documents a pair of ids is linked) are a sparse
matrix-vector product in blocks: per document the distinct pairs with their
multiplicity are kept packed; counts are summed per pair, dealt into blocks of
A ids, and joined with the same blocks of the documents' pairs.  No table is
broadcast by hand, none goes through the driver.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import materialise
from spendlens.llm.tokens import TIKTOKEN_CHARS, _byte_of_char, byte_bpe

#: Texts are aligned in groups of about so many characters; bounds a task's memory.
CHARS = 1 << 20
#: A tokens of a lane, and how many more are searched for a common end to part a long one.
LANE, WINDOW = 512, 32
#: Pairs in a block of the corpus counts, in the mean, and pairs of documents in a tile.
BLOCK, TILE = 1 << 18, 1 << 21
#: More than any tokenizer has ids.
IDS = 1 << 24
#: A row's number is its task's, then so many bits of its place in the task.
ROW_BITS = 40

SCHEMA = ("row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
          " groups string, pairs binary")


class Side:
    """One tokenizer: ids of texts without special tokens, and each id's bytes."""

    def __init__(self, path: str):
        self.path = path
        if path.endswith(".model"):
            import sentencepiece

            sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.bytes = [bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i)
                          else sp.id_to_piece(i).replace("▁", " ").encode()
                          for i in range(sp.get_piece_size())]
            return
        from tokenizers import Tokenizer

        self.sp = None
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.plain.no_truncation()
        self.plain.no_padding()
        at = _byte_of_char()
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.bytes[i] = bytes(at[c] for c in entry if c in at)

    def encode(self, texts: list[str]) -> list:
        """Ids of each text with a space before it (which sentencepiece puts there itself)."""
        if self.sp is not None:
            return self.sp.encode(texts, num_threads=1)
        return [self._ids(" " + t) for t in texts]

    def _ids(self, text: str):
        fast = byte_bpe(self.path)
        if fast is not None and len(text) <= TIKTOKEN_CHARS:
            try:
                return fast.encode_to_numpy(text, disallowed_special=())
            except Exception as e:  # noqa: BLE001  the pattern engine's stack is bounded
                if "stack" not in str(e).lower() and "backtrack" not in str(e).lower():
                    raise
        return self.plain.encode(text, add_special_tokens=False).ids

    def gives_back(self, ids, text: bytes) -> bool:
        """Whether the ids' bytes are the text."""
        if self.sp is None and byte_bpe(self.path) is not None:
            # merges of the text's own bytes: they can be too few, but not other ones
            return int(self.lengths[ids].sum()) == len(text)
        return b"".join(map(self.bytes.__getitem__, ids)) == text

    @functools.cached_property
    def lengths(self) -> np.ndarray:
        return np.array([len(b) for b in self.bytes], np.int64)

    @functools.cached_property
    def decimals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each id in decimal, with a comma, a bar and a semicolon after it."""
        return tuple(np.array([f"{i}{mark}" for i in range(len(self.bytes))], object)
                     for mark in ",|;")


@functools.lru_cache(maxsize=4)
def side(path: str) -> Side:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
    return Side(path)


def _lanes(ends_a: np.ndarray, ends_b: np.ndarray, off_a: np.ndarray, off_b: np.ndarray,
           lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First A and B token of every lane, and where its A tokens stop: documents, parted
    after common ends about every ``lane`` A tokens."""
    sizes = np.diff(off_a)
    more = np.maximum(sizes - 1, 0) // lane
    doc = np.repeat(np.arange(sizes.size), more)
    step = np.arange(doc.size) - np.repeat(np.cumsum(more) - more, more) + 1
    at = off_a[doc] + step * lane
    seen = at[:, None] + np.arange(min(WINDOW, lane))
    inside = seen < off_a[doc + 1][:, None] - 1
    seen = np.where(inside, seen, 0)
    other = np.searchsorted(ends_b, ends_a[seen]) if seen.size else seen
    hit = inside & (ends_b[np.minimum(other, max(ends_b.size - 1, 0))] == ends_a[seen]) \
        if seen.size else inside
    found = hit.any(axis=1)
    first = hit.argmax(axis=1)[found]
    rows = np.flatnonzero(found)
    start_a = np.concatenate([off_a[:-1], seen[rows, first] + 1])
    start_b = np.concatenate([off_b[:-1], other[rows, first] + 1])
    order = np.argsort(start_a, kind="stable")
    start_a, start_b = start_a[order], start_b[order]
    return start_a, start_b, np.append(start_a, off_a[-1])[1:]


def merge(ends_a: np.ndarray, ends_b: np.ndarray, off_a: np.ndarray, off_b: np.ndarray,
          lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (A index, B index) and cuts (A index, B index of the tokens that end there)
    of documents whose tokens' byte ends, over all documents, are ``ends_*``; a document
    d has the tokens ``off_*[d]`` to ``off_*[d + 1]``.  Every document has tokens, and as
    many bytes by A as by B."""
    start_a, start_b, stop = _lanes(ends_a, ends_b, off_a, off_b, lane)
    n_a = ends_a.size
    ends = np.concatenate([ends_a, ends_b])
    state = np.stack([start_a, start_b + n_a])
    links, cut = [state[:, :0]], [np.empty(0, bool)]
    while stop.size:
        end_a, end_b = ends[state]
        moves = np.stack([end_a <= end_b, end_b <= end_a])
        links.append(state)
        cut.append(end_a == end_b)
        state = state + moves
        alive = state[0] < stop
        if not alive.all():
            state, stop = state[:, alive], stop[alive]
    links = np.concatenate(links, axis=1)
    cuts = links[:, np.concatenate(cut)]
    return links[0], links[1] - n_a, cuts[0], cuts[1] - n_a


class Aligned:
    """The alignment of some texts, arrays over all their tokens and links."""

    def __init__(self, texts: list[str | None], a: Side, b: Side, lane: int = LANE):
        self.a, self.b, self.n = a, b, len(texts)
        some = [i for i, t in enumerate(texts) if t]
        ids = list(zip(a.encode([texts[i] for i in some]), b.encode([texts[i] for i in some])))
        self.docs, kept = [], []
        for i, (x, y) in zip(some, ids):
            want = b" " + texts[i].encode("utf-8", "surrogatepass")
            if a.gives_back(x, want) and b.gives_back(y, want):
                self.docs.append(i)
                kept.append((np.asarray(x, np.int64), np.asarray(y, np.int64)))
        sizes = np.array([[x.size, y.size] for x, y in kept], np.int64).reshape(-1, 2)
        self.off_a, self.off_b = (np.concatenate([[0], np.cumsum(s)]) for s in sizes.T)
        none = [np.empty(0, np.int64)]
        self.ids_a, self.ids_b = (np.concatenate(none + list(x)) for x in (zip(*kept) if kept else ((), ())))
        self.link_a, self.link_b, cut_a, cut_b = merge(
            np.cumsum(a.lengths[self.ids_a]), np.cumsum(b.lengths[self.ids_b]),
            self.off_a, self.off_b, lane)
        self.cut_a, self.cut_b = np.sort(cut_a), np.sort(cut_b)
        self.doc = np.repeat(np.arange(len(self.docs)), np.diff(self.off_a))[self.link_a]

    def counts(self) -> list[np.ndarray]:
        """n_a, n_b, n_groups and n_links of every text."""
        out = []
        for each in (np.diff(self.off_a), np.diff(self.off_b),
                     np.diff(np.searchsorted(self.cut_a, self.off_a)),
                     np.bincount(self.doc, minlength=len(self.docs))):
            full = np.zeros(self.n, np.int64)
            full[self.docs] = each
            out.append(full)
        return out

    def groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3``: the ids of every text's groups; '' without tokens."""
        n_a, n_b = self.ids_a.size, self.ids_b.size
        end_a, end_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
        end_a[self.cut_a], end_b[self.cut_b] = True, True
        text = np.empty(n_a + n_b, object)
        comma, bar, _ = self.a.decimals
        at = np.arange(n_a) + np.append(0, self.cut_b + 1)[np.cumsum(end_a) - end_a]
        text[at] = np.where(end_a, bar[self.ids_a], comma[self.ids_a])
        comma, _, semi = self.b.decimals
        at = np.arange(n_b) + np.append(self.cut_a + 1, 0)[np.cumsum(end_b) - end_b]
        text[at] = np.where(end_b, semi[self.ids_b], comma[self.ids_b])
        out, ends = [""] * self.n, (self.off_a + self.off_b).tolist()
        for i, s, e in zip(self.docs, ends, ends[1:]):
            out[i] = "".join(text[s:e].tolist())[:-1]
        return out

    def pairs(self) -> list[bytes | None]:
        """Every text's distinct linked id pairs and how often it links them, packed."""
        wide = len(self.b.bytes)
        space = len(self.a.bytes) * wide
        codes, times = np.unique(self.doc * space + self.ids_a[self.link_a] * wide
                                 + self.ids_b[self.link_b], return_counts=True)
        ends = np.searchsorted(codes, np.arange(len(self.docs) + 1) * space).tolist()
        codes %= space
        out: list[bytes | None] = [None] * self.n
        for i, s, e in zip(self.docs, ends, ends[1:]):
            out[i] = pack(0, codes[s:e], times[s:e], wide)
        return out


def pack(docs, codes: np.ndarray, times: np.ndarray, wide: int) -> bytes:
    """Pairs ``a * wide + b`` of documents with multiplicities, in order of document and A
    id: steps of these two, then B ids, then multiplicities, byte by byte."""
    a, b = np.divmod(codes, wide)
    parts = [np.diff(docs * IDS + a, prepend=0), b, times]
    kinds = [np.min_scalar_type(int(p.max(initial=0))) for p in parts]
    head = np.array([codes.size, *(k.itemsize for k in kinds)], "<i8").tobytes()
    body = b"".join(p.astype(k).view(np.uint8).reshape(-1, k.itemsize).T.tobytes()
                    for p, k in zip(parts, kinds))
    return zstandard.ZstdCompressor(level=1).compress(head + body)


def unpack(data: bytes, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, codes and multiplicities as ``pack`` got them."""
    data = zstandard.ZstdDecompressor().decompress(data)
    n, *sizes = np.frombuffer(data, "<i8", 4).tolist()
    parts, at = [], 32
    for size in sizes:
        planes = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
        parts.append(np.ascontiguousarray(planes.T).view(f"<u{size}").reshape(-1).astype(np.int64))
        at += n * size
    docs, a = np.divmod(np.cumsum(parts[0]), IDS)
    return docs, a * wide + parts[1], parts[2]


def _portions(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of items of about ``most`` in sum, one item at least."""
    at = 0
    while at < len(sizes):
        end, size = at, 0
        while end < len(sizes) and (size < most or end == at):
            size += sizes[end]
            end += 1
        yield at, end
        at = end


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
          text_col: str = "text", lane: int = LANE, chars: int = CHARS) -> DataFrame:
    """One row per input row: ``row`` (its own number), ``doc_id``, ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``groups`` (ids of the groups, ``a1,a2|b1;a3|b2,b3``) and
    ``pairs`` (packed distinct id pairs, null without tokens).

    A text that is null, empty, or not given back byte for byte by the tokens of both
    tokenizers has no tokens: zeros and ''.  Special tokens' strings are plain text.
    Repeated and null ids keep their rows; other columns are not looked at; an empty
    table gives an empty one; long texts are whole, as several lanes of the merge.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = side(a_path), side(b_path)
        row = TaskContext.get().partitionId() << ROW_BITS
        for batch in batches:
            sizes = [len(t.as_py() or "") for t in batch.column("text")]
            for s, e in _portions(sizes, chars):
                part = batch.slice(s, e - s)
                found = Aligned(part.column("text").to_pylist(), a, b, lane)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + e - s)), part.column("doc_id"),
                     *map(pa.array, found.counts()), pa.array(found.groups(), pa.string()),
                     pa.array(found.pairs(), pa.binary())],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])
                row += e - s

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, SCHEMA))


def _unpacked(batch: pa.RecordBatch, wide: int) -> Iterator[tuple]:
    """(row numbers of pairs, codes, times) of a batch's documents, some at a time.

    A batch can span the files of several tasks, whose row numbers lie far apart; a portion
    has ascending rows of one task only, as ``pack`` needs it."""
    rows, packed = batch.column("row").to_numpy(), batch.column("pairs").to_pylist()
    sizes = [len(p) for p in packed]
    breaks = np.flatnonzero((np.diff(rows) <= 0) | (np.diff(rows >> ROW_BITS) != 0)) + 1
    runs = [0, *breaks.tolist(), len(packed)]
    for low, high in zip(runs, runs[1:]):
        for s, e in _portions(sizes[low:high], TILE):
            each = [unpack(p, wide)[1:] for p in packed[low + s:low + e]]
            yield (np.repeat(rows[low + s:low + e], [c.size for c, _ in each]),
                   np.concatenate([c for c, _ in each]), np.concatenate([t for _, t in each]))


def pair_counts(aligned: DataFrame, wide: int) -> DataFrame:
    """``(pair, n)``: in how many rows of ``aligned`` an id pair is linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, codes, _ in _unpacked(batch, wide):
                pair, n = np.unique(codes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    return (aligned.where("pairs is not null").select("row", "pairs")
            .mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")))


def _block(a, n_blocks: int):
    """Block of an A id, for numpy arrays; ``_BLOCK`` is the same in SQL."""
    return (a * 2654435761 & 0xFFFFFFFF) // 65536 % n_blocks


_BLOCK = "cast(((pair div {wide}) * 2654435761L & 4294967295L) div 65536 % {n_blocks} as int)"


def score_links(aligned: DataFrame, wide: int, block: int = BLOCK) -> DataFrame:
    """``aligned`` (a stored table) without ``pairs``, with ``n_best``: links whose pair has
    the highest count of all pairs of its A id, ties included, and ``count_sum``: the sum of
    the counts over all links.  ``wide``: ids of tokenizer B."""
    counts = materialise(pair_counts(aligned, wide), "alignment-counts")
    n_blocks = max(1, -(-counts.count() // block))
    counts = counts.withColumns({"a": F.expr(f"pair div {wide}"),
                                 "block": F.expr(_BLOCK.format(wide=wide, n_blocks=n_blocks))})
    best = counts.groupBy("a").agg(F.max("n").alias("top"))
    # an A id has `wide` pairs at most, and A ids are dealt evenly: a block is bounded
    blocks = materialise(
        counts.join(best, "a").groupBy("block").agg(F.array_sort(F.collect_list(F.struct(
            "pair", "n", F.expr("n = top").cast("bigint").alias("best")))).alias("c"))
        .select("block", F.col("c.pair").alias("known"), "c.n", "c.best"), "alignment-blocks")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, codes, times in _unpacked(batch, wide):
                at = _block(codes // wide, n_blocks)
                order = np.argsort(at, kind="stable")
                ends = np.searchsorted(at[order], np.arange(n_blocks + 1))
                base = int(rows.min())
                out = [(k, base, pack(rows[own] - base, codes[own], times[own], wide))
                       for k in np.flatnonzero(np.diff(ends)).tolist()
                       for own in [order[ends[k]:ends[k + 1]]]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary()))],
                    names=["block", "base", "tile"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, n, best = (batch.column(c) for c in ("known", "n", "best"))
            for i, (base, tile) in enumerate(zip(batch.column("base").to_pylist(),
                                                 batch.column("tile").to_pylist())):
                doc, codes, times = unpack(tile, wide)
                at = np.searchsorted(known[i].values.to_numpy(), codes)
                first = np.flatnonzero(np.diff(doc, prepend=-1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[first] + base),
                     pa.array(np.add.reduceat(times * best[i].values.to_numpy()[at], first)),
                     pa.array(np.add.reduceat(times * n[i].values.to_numpy()[at], first))],
                    names=["row", "n_best", "count_sum"])

    packed = aligned.where("pairs is not null").select("row", "pairs")
    scores = (packed.mapInArrow(tiles, "block int, base bigint, tile binary").join(blocks, "block")
              .select("base", "tile", "known", "n", "best")
              .mapInArrow(sums, "row bigint, n_best bigint, count_sum bigint")
              .groupBy("row").agg(F.sum("n_best").alias("n_best"),
                                  F.sum("count_sum").alias("count_sum")))
    zero = F.lit(0).cast("bigint")
    return (aligned.drop("pairs").join(scores, "row", "left")
            .withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")}))


def align_and_score(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 ('' without
    tokens) per row; see ``align`` and ``score_links``."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = materialise(align(docs, a_path, b_path).withColumn("groups_sha256", digest)
                          .drop("groups"), "alignment")
    return score_links(aligned, len(side(b_path).bytes)).drop("row")
