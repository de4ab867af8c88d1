"""Best-fit packing by swap-based local search.

``tokenise`` cuts every document into pieces of at most ``capacity`` tokens (a document's
ids, then an end id), and ``pack`` places pieces into as few sequences as it can.

Packing works in groups of about ``group_bins`` sequences, each in one task: a best-fit
start in falling order of length, then local search between underfull bins. A step moves
a piece, or exchanges one for one or two for one, from a less full to a fuller bin, so
the sum of squared fills rises strictly and the search ends; donors are taken from the
least full bin up, until bins empty or the group's lower bound is reached. The least full
eighth of every group's bins (``forward``) is dealt anew into fewer groups in the next
round, until one group is left: rounds shrink geometrically, the result comes close to one
big packing, and no task ever holds more than about ``group_bins`` sequences.

Groups are dealt by row number, not by content, so equal documents and hot sources
spread evenly. Every round is written to shared storage before the next reads it.

Defined results: a NULL or empty text is a document of the end id alone. NULL ids and
repeated rows are packed like others, once per row. An empty table gives no rows. Extra
columns of the pieces travel with them; ``pack`` itself reads only ``length``.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laminar.llm.common import Words, bounded_batches, materialise, split_words, worker_state

CAPACITY = 2048
GROUP_BINS = 1024
FORWARD = 0.125                # share of a group's sequences that the next round packs anew


# ---------------------------------------------------------------- token ids
def word_encoder(vocabulary: str) -> "WordEncoder":
    """An encoder that is made once per Python worker."""
    return worker_state("encoder " + vocabulary, lambda: WordEncoder(vocabulary))


class WordEncoder:
    """Ids of texts that are split at white space into chunks.

    The vocabulary's splitting rule never crosses white space, so texts are encoded chunk
    by chunk; ``known`` numbers the chunks met so far, and those that a call adds are
    encoded together. Chunks of common Latin letters and symbols are split by the
    vocabulary's own pattern and their parts are merged side by side; any other chunk goes
    through the whole tokenizer. ``full`` says that ``known`` should be cleared.
    """

    def __init__(self, vocabulary: str, cache_size: int = 600_000):
        import json

        import regex
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as f:
            rules = json.load(f)
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.merge = make_merger(rules["model"], self.tokenizer.model)
        self.split = regex.compile(rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        # Characters whose lower case and composition do not depend on the Unicode version;
        # each has a lower case of one character.
        self.plain = regex.compile("[ !-~¡-¬®-įı-ž]+").fullmatch
        self.cache_size = cache_size
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(0, dtype=np.int32)             # of all known chunks, one after another
        self.ends = np.zeros(0, dtype=np.int64)            # of every known chunk's ids
        self.counts = np.zeros(0, dtype=np.int64)

    @property
    def full(self) -> bool:
        return len(self.known) > self.cache_size

    def encode(self, chunks: Words) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many of them each text has."""
        kinds = chunks.kinds.cast(pa.binary()).to_pylist()
        found = list(map(self.known.get, kinds))
        if None in found:
            self._add([c for c, k in zip(kinds, found) if k is None])
            found = [self.known[c] if k is None else k for c, k in zip(kinds, found)]
        numbers = np.array(found, dtype=np.int64)[chunks.which]
        n = self.counts[numbers]
        ends = np.cumsum(n)
        ids = self.ids[np.repeat(self.ends[numbers] - ends, n) + np.arange(n.sum())]
        return ids, np.diff(np.concatenate([[0], ends])[np.cumsum(chunks.sizes)], prepend=0)

    def _usual(self, text: str) -> bool:
        return self.plain(text) is not None and unicodedata.is_normalized("NFC", text)

    def _add(self, new: list[bytes]) -> None:
        text = b" ".join(new).decode()
        if not self._usual(text):
            usual = [c for c in new if self._usual(c.decode())]
            odd = list(set(new).difference(usual))
            coded = [self.tokenizer.encode(c.decode(), add_special_tokens=False).ids for c in odd]
            self._keep(odd, np.array([i for c in coded for i in c], dtype=np.int32), np.array([len(c) for c in coded]))
            new, text = usual, b" ".join(usual).decode()
        if not new:
            return
        parts = self.split(text.lower())                    # none crosses a space, and all else is in one
        kinds = dict.fromkeys(parts)
        ids, begins, counts = self.merge(list(kinds))
        kinds = dict(zip(kinds, range(len(kinds))))
        which = np.fromiter(map(kinds.__getitem__, parts), dtype=np.int64, count=len(parts))
        part_ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))
        chunk_ends = np.cumsum(np.fromiter(map(len, text.split(" ")), dtype=np.int64, count=len(new)))
        n = counts[which]
        ends = np.cumsum(n)
        flat = ids[np.repeat(begins[which] - (ends - n), n) + np.arange(ends[-1])]
        self._keep(new, flat, np.diff(ends[np.searchsorted(part_ends, chunk_ends)], prepend=0))

    def _keep(self, new: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        at = len(self.known)
        self.known.update(zip(new, range(at, at + len(new))))
        self.ends = np.concatenate([self.ends, len(self.ids) + np.cumsum(counts)])
        self.ids = np.concatenate([self.ids, ids])
        self.counts = np.concatenate([self.counts, counts])


def make_merger(rules: dict, model, bits: int = 6):
    """A function from parts to (ids, begin of each part's ids, their number).

    The model's merges, side by side for all parts of one length: each step replaces the pair
    of least rank, the first of equals, in every part that has one. Parts of more than
    ``2 ** bits`` bytes go through ``model``.
    """
    vocabulary = rules["vocab"]
    # Printable stand-ins of bytes, by the byte-level rule: visible Latin-1 characters
    # stand for themselves, the rest follow from U+0100 on.
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    letters = [table[b] for b in range(256)]
    end = rules["end_of_word_suffix"]
    inner, last = (np.array([vocabulary[c + e] for c in letters], dtype=np.int32) for e in ("", end))
    pairs = [m.split(" ") if isinstance(m, str) else m for m in rules["merges"]]
    left, right, into = (np.array([vocabulary[x] for x in xs], dtype=np.int64)
                         for xs in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
    none = len(pairs)
    kind, half = (np.uint32, 16) if len(vocabulary) <= 1 << 16 else (np.int64, 32)     # a pair as one number
    order = np.argsort(left << half | right, kind="stable")
    keys = (left << half | right)[order].astype(kind)
    into = into.astype(np.int32)

    def rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a.astype(kind) << half | b.astype(kind)
        at = np.minimum(np.searchsorted(keys, pair), none - 1)
        return np.where(keys[at] == pair, order[at], none).astype(np.int32)

    starts = [rank(inner[:, None], x[None, :]).ravel() for x in (inner, last)]      # ranks of pairs of bytes

    def merge(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw = [p.encode() for p in parts]
        counts = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        begins = np.cumsum(counts) - counts
        data = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.int64)
        ids = np.empty(len(data), dtype=np.int32)                                   # never more ids than bytes
        for size in np.unique(counts).tolist():
            rows = np.flatnonzero(counts == size)
            if size > 1 << bits:
                for r in rows.tolist():
                    found = [t.id for t in model.tokenize("".join([letters[b] for b in raw[r]]))]
                    ids[begins[r]:begins[r] + len(found)] = found
                    counts[r] = len(found)
                continue
            got = data[begins[rows] + np.arange(size)[:, None]]
            symbols = inner[got]
            symbols[-1] = last[got[-1]]
            ranks = np.empty((size - 1, len(rows)), dtype=np.int32)
            if size > 1:
                ranks[:-1] = starts[0][got[:-2] << 8 | got[1:-1]]
                ranks[-1] = starts[1][got[-2] << 8 | got[-1]]
            while len(rows):
                size = len(symbols)
                place = np.arange(size - 1, dtype=np.int32)[:, None]
                best = (ranks << bits | place).min(axis=0) if size > 1 else np.full(len(rows), none << bits, dtype=np.int32)
                ready = best >= none << bits
                if ready.any():
                    at = np.flatnonzero(ready)
                    ids[begins[rows[at]] + np.arange(size)[:, None]] = symbols[:, at]
                    counts[rows[at]] = size
                    on = np.flatnonzero(~ready)
                    rows, symbols, ranks, best = rows[on], symbols[:, on], ranks[:, on], best[on]
                    if not len(rows):
                        break
                at, cols = best & (1 << bits) - 1, np.arange(len(rows))
                later = place > at
                symbols = np.where(later, symbols[1:], symbols[:-1])
                symbols[at, cols] = into[best >> bits]
                ranks = np.where(later[:-1], ranks[1:], ranks[:-1])
                for on, shift in ((np.flatnonzero(at > 0), -1), (np.flatnonzero(at < size - 2), 0)):
                    first = at[on] + shift
                    ranks[first, on] = rank(symbols[first, on], symbols[first + 1, on])
        return ids, begins, counts

    return merge


def tokenise(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
             capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces (id, piece, start, length, ids) of every document; ids is the piece's tokens
    as little-endian unsigned 32-bit integers."""
    schema = pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids", pa.binary())])
    end = int(end_id).to_bytes(4, "little")
    width = 4 * capacity

    def run(batches):
        coder = None
        for batch in bounded_batches(batches, 4 << 20):
            coder = coder or word_encoder(vocabulary)
            if coder.full:
                coder.clear()
            cols = [[], [], [], [], []]
            coded, counts = coder.encode(split_words(batch.column(1)))
            coded, ends = coded.astype("<u4").tobytes(), [0, *(4 * np.cumsum(counts)).tolist()]
            for key, *of in zip(batch.column(0).to_pylist(), ends, ends[1:]):
                ids = coded[slice(*of)] + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    cut = ids[at:at + width]
                    for col, value in zip(cols, (key, piece, at // 4, len(cut) // 4, cut)):
                        col.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id bigint, piece int, start bigint, length bigint, ids binary")


# ---------------------------------------------------------------- packing of one group
def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit in falling order of length: the fullest bin that still has room."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []               # (free, bin), sorted
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        at = bisect_left(room, (n, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append(int(i))
        if free > n:
            insort(room, (free - n, b))
    return bins


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Steps that raise the sum of squared fills, until bins empty or none helps.

    The donor is the least full bin that is not stuck. When all are, those steps that landed
    since may have made room, so every bin is tried again; the search ends when a whole round
    lands no step. Its best step over all receivers at
    least as full (the largest gain in the receiver's fill) is taken: move one piece,
    exchange one for one, or two for one. A donor's different sizes add up to at most
    ``capacity``, so there are few of them and few pairs.
    """
    where = np.zeros(len(lengths), dtype=np.int64)
    for b, rows in enumerate(bins):
        where[rows] = b
    fill = np.array([int(lengths[b].sum()) for b in bins], dtype=np.int64)
    live, need = int((fill > 0).sum()), -(-int(lengths.sum()) // capacity)
    open_ = (fill > 0) & (fill < capacity)
    stuck, landed = np.zeros(len(bins), dtype=bool), False
    while live > need:
        donors = np.flatnonzero(open_ & ~stuck)
        if not len(donors):
            if not landed:
                break
            stuck[:], landed = False, False
            continue
        a = donors[np.argmin(fill[donors])]
        step = _best_step(a, where, lengths, fill, open_, capacity)
        if step is None:
            stuck[a] = True
            continue
        out, back, b = step
        landed = True
        gain = int(lengths[out].sum()) - (0 if back is None else int(lengths[back]))
        where[out] = b
        if back is not None:
            where[back] = a
        fill[a] -= gain
        fill[b] += gain
        open_[a], open_[b] = fill[a] > 0, fill[b] < capacity
        live -= int(fill[a] == 0)
    order = np.argsort(where, kind="stable")
    edges = np.flatnonzero(np.r_[True, np.diff(where[order]) != 0, True])
    return [order[lo:hi].tolist() for lo, hi in zip(edges, edges[1:])]


def _best_step(a: int, where: np.ndarray, lengths: np.ndarray, fill: np.ndarray, open_: np.ndarray,
               capacity: int) -> tuple[list[int], int | None, int] | None:
    """(pieces that leave ``a``, piece that comes back or None, receiver) of the largest gain."""
    takes = open_ & (fill >= fill[a])
    takes[a] = False
    receivers = np.flatnonzero(takes)
    if not len(receivers):
        return None
    mine = np.flatnonzero(where == a)
    sizes, first = np.unique(lengths[mine], return_index=True)
    twice = np.flatnonzero(np.bincount(np.searchsorted(sizes, lengths[mine])) > 1)
    singles = [[int(mine[i])] for i in first]
    pairs = [[int(mine[i]), int(mine[j])] for x, i in enumerate(first) for j in first[x + 1:]]
    pairs += [mine[lengths[mine] == sizes[i]][:2].tolist() for i in twice]
    theirs = np.flatnonzero(takes[where])
    room = capacity - fill[where[theirs]]
    spare = capacity - fill[receivers]
    best, gain = None, 0
    for out in singles + pairs:
        size = int(lengths[out].sum())
        if len(out) == 1:
            fits = np.flatnonzero(spare >= size)
            if len(fits) and size > gain:                    # into the fullest bin that has room
                best, gain = (out, None, int(receivers[fits[np.argmin(spare[fits])]])), size
        gains = size - lengths[theirs]
        gains[gains > room] = 0
        at = int(np.argmax(gains))
        if gains[at] > gain:
            best, gain = (out, int(theirs[at]), int(where[theirs[at]])), int(gains[at])
    return best


def pack_group(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    return local_search(best_fit(lengths, capacity), lengths, capacity)


# ---------------------------------------------------------------- packing of a table
def pack(pieces: DataFrame, capacity: int = CAPACITY, group_bins: int = GROUP_BINS,
         forward: float = FORWARD) -> DataFrame:
    """``pieces`` (with ``length`` in 1..capacity) plus sequence_id and offset.

    ``pieces`` should be a written table: its rows are dealt by row number, which a
    recomputed task must find unchanged.
    """
    columns = pieces.columns
    clash = {"sequence_id", "offset", "_group", "_pending"} & set(columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made by pack")
    placed, rest, level = None, pieces, 0
    while True:
        tokens = rest.agg(F.sum("length")).first()[0] or 0
        groups = max(1, -(-tokens // (capacity * group_bins)))
        done = materialise(_round(rest, capacity, groups, 0 if groups == 1 else forward, level), f"pack-{level}")
        kept = done.where("NOT _pending").drop("_pending")
        placed = kept if placed is None else placed.unionByName(kept)
        if groups == 1:
            return placed
        rest, level = done.where("_pending").select(*columns), level + 1


def _round(rest: DataFrame, capacity: int, groups: int, forward: float, level: int) -> DataFrame:
    schema = T.StructType([*rest.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType()), T.StructField("_pending", T.BooleanType())])
    base = level << 56

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop(columns="_group").reset_index(drop=True)
        lengths = pdf["length"].to_numpy(dtype=np.int64)
        bins = sorted(pack_group(lengths, capacity), key=lambda b: int(lengths[b].sum()))
        sequence, offset = np.zeros(len(pdf), dtype=np.int64), np.zeros(len(pdf), dtype=np.int64)
        pending = np.zeros(len(pdf), dtype=bool)
        for n, rows in enumerate(bins):
            sequence[rows] = base + (int(key[0]) << 24) + n
            offset[rows] = np.cumsum(lengths[rows]) - lengths[rows]
            pending[rows] = n < forward * len(bins) and lengths[rows].sum() < capacity
        return pdf.assign(sequence_id=sequence, offset=offset, _pending=pending)

    group = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    return rest.withColumn("_group", group).groupBy("_group").applyInPandas(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed ids of every sequence, from pieces that kept ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["ids"])).alias("ids"))
