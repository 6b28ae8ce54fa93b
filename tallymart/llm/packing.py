"""Packing of tokenised documents into sequences of bounded length by minimum bin slack.

Each sequence is filled at once. Of the pieces left, the longest goes in; then a subset-sum
table over the lengths available, one bit for each sum, finds the fullest sequence that can be
made with it, and those pieces are removed. Pieces are dealt into blocks of bounded size, each
packed by one task; what the blocks could not fill is packed once more together.
"""

from __future__ import annotations

import functools
import math
import sys
import zlib
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.common import (
    FINE_BYTES,
    KEPT_UNITS,
    LOWER,
    Powers,
    documents,
    small_batches,
    span_hashes,
    staged,
    text_blocks,
    tidy,
)

CAPACITY = 4096
END_ID = 1
#: Pieces that one task packs, on average.
BLOCK = 20_000
PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def pack(
    docs: DataFrame,
    spark: SparkSession,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    block: int = BLOCK,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. A document longer than a sequence is cut into full
    pieces and a rest. Rows that repeat an id or text are packed each for itself. An empty table
    gives no rows. The tokenizer's file must be found under the given path on every executor.
    """
    small_batches(spark)
    pieces = documents(docs).withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        lambda batches: token_pieces(batches, tokenizer_path, capacity, end_id), PIECES
    )
    pieces = staged(pieces, "pieces", spark)
    ids = pieces.select(F.struct("row", "piece").alias("id"), "length")
    number = pieces.count()
    first = packed(ids, max(1, math.ceil(number / block)), capacity, 0)
    first = staged(first, "packed", spark)
    # Sequences with room left are opened again and packed together, now in fewer blocks.
    loose = first.where(F.col("fill") < capacity)
    open_number = loose.count()
    again = packed(loose.select("id", "length"), max(1, math.ceil(open_number / block)), capacity, 1)
    placed = first.where(F.col("fill") == capacity).unionByName(again)
    return pieces.join(
        placed.select(F.col("id.row").alias("row"), F.col("id.piece").alias("piece"), "sequence_id", "offset"),
        ["row", "piece"],
    ).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def packed(ids: DataFrame, blocks: int, capacity: int, turn: int) -> DataFrame:
    """id, length, sequence_id, offset, fill of each piece. Blocks are dealt by a hash of the id."""
    dealt = ids.withColumn("block", F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(blocks)))

    def pack_block(key, table):
        lengths = table.column("length").to_numpy().astype(np.int64)
        order = np.lexsort((table.column("tie").to_numpy(), lengths))
        bins, offsets, fills = minimum_slack(lengths[order], capacity)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        sequence = (np.int64(key[0].as_py()) * 2 + turn << 32) + bins[back]
        return table.select(["id", "length"]).append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offsets[back])
        ).append_column("fill", pa.array(fills[back]))

    schema = "id struct<row:bigint,piece:int>, length long, sequence_id long, offset long, fill long"
    dealt = dealt.withColumn("tie", F.xxhash64("id"))
    return dealt.groupBy("block").applyInArrow(pack_block, schema)


def minimum_slack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and the bin's fill of each piece; ``lengths`` ascend and are 1 to capacity."""
    n = len(lengths)
    bins, offsets, fills = (np.zeros(n, np.int64) for _ in range(3))
    values, starts = np.unique(lengths, return_index=True)
    stacks = {int(v): [int(s), int(e)] for v, s, e in zip(values, starts, np.append(starts[1:], n))}
    left = [int(v) for v in values]  # lengths that are still there, ascending
    number = 0
    while left:
        longest = left[-1]
        chosen = [longest, *fullest(left, stacks, longest, capacity - longest)]
        at, fill = 0, sum(chosen)
        for length in chosen:
            stack = stacks[length]
            stack[1] -= 1
            place = stack[1]
            bins[place], offsets[place], fills[place] = number, at, fill
            at += length
        for length in set(chosen):
            if stacks[length][0] == stacks[length][1]:
                left.remove(length)
        number += 1
    return bins, offsets, fills


def fullest(left: list[int], stacks: dict[int, list[int]], used: int, room: int) -> list[int]:
    """Lengths whose sum comes nearest to ``room`` from below; one of ``used`` is taken already.

    ``sums`` has bit s set where the lengths looked at so far can sum to s. Longer lengths come
    first, as they are harder to place later; the search ends once the room can be filled whole.
    """
    mask, sums, steps = (1 << room + 1) - 1, 1, []
    for length in reversed(left):
        if length > room:
            continue
        there = stacks[length][1] - stacks[length][0] - (length == used)
        many = 1
        while there > 0 and many * length <= room:
            many = min(many, there)
            grown = (sums | sums << many * length) & mask
            steps.append((sums, length, many))
            there -= many
            many *= 2
            if grown >> room & 1:
                sums, there = grown, 0
                break
            sums = grown
        if sums >> room & 1:
            break
    target, chosen = sums.bit_length() - 1, []
    for before, length, many in reversed(steps):
        if not before >> target & 1:
            chosen += [length] * many
            target -= many * length
    return chosen


class UnitTokens:
    """Token ids of units of text, which no token crosses, encoded once each and looked up by hash.

    A unit ends where white space is, or between an ASCII letter and an ASCII sign or digit
    other than the apostrophe: there the tokenizer's own word pattern always splits. Units are
    numbered as they come. A table with a place for each low part of a hash finds nearly all of
    them at once; those whose place is taken are in a dictionary.
    """

    def __init__(self, path: str, most: int = 1_000_000, bits: int = 21) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.powers = Tokenizer.from_file(path), most, Powers()
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mask = np.uint64((1 << bits) - 1)
        self.clear()

    @classmethod
    def of_worker(cls, path: str) -> UnitTokens:
        """The table of this Python worker, kept from task to task of packing; bounded by ``most`` units."""
        kept = sys.modules.setdefault(KEPT_UNITS, ModuleType(KEPT_UNITS)).__dict__
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def clear(self) -> None:
        self.at_place = np.full(int(self.mask) + 1, -1, np.int32)
        self.hash_at = np.zeros(int(self.mask) + 1, np.uint64)
        self.others: dict[int, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        """Adds units that are not known. Plain words are encoded many at a time."""
        lists: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        plain = [k for k, x in enumerate(texts) if x.isascii() and x.isalpha()]
        for k in set(range(len(texts))).difference(plain):
            lists[k] = self.encode(texts[k])
        for a in range(0, len(plain), 64):
            own = plain[a : a + 64]
            ids = self.encode(" ".join(texts[k] for k in own))
            stops = np.flatnonzero(self.ends[ids]) + 1
            for k, x in zip(own, np.split(ids, stops[:-1])):
                lists[k] = x
        number = len(self.starts) - 1 + np.arange(len(texts))
        self.ids = np.concatenate([self.ids, *lists])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(x) for x in lists], dtype=np.int64)])
        place = (hashes & self.mask).astype(np.int64)
        _, first = np.unique(place, return_index=True)
        free = np.zeros(len(texts), bool)
        free[first] = self.at_place[place[first]] < 0
        self.at_place[place[free]], self.hash_at[place[free]] = number[free], hashes[free]
        self.others.update(zip(hashes[~free].tolist(), number[~free].tolist()))

    def numbers(self, hashes: np.ndarray, lower: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each unit; new ones are learnt."""
        place = (hashes & self.mask).astype(np.int64)
        found = self.at_place[place].astype(np.int64)
        missed = np.flatnonzero((self.hash_at[place] != hashes) | (found < 0))
        if not len(missed):
            return found
        distinct, where, which = np.unique(hashes[missed], return_index=True, return_inverse=True)
        number = np.array([self.others.get(h, -1) for h in distinct.tolist()], np.int64)
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            spans = zip(begins[missed[where[fresh]]].tolist(), ends[missed[where[fresh]]].tolist())
            number[fresh] = len(self.starts) - 1 + np.arange(len(fresh))
            self.learn(distinct[fresh], [lower[a:b].tobytes().decode() for a, b in spans])
        found[missed] = number[which]
        return found

    def tokens(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        lower = LOWER[data]
        begins, ends = unit_bounds(lower, starts)
        if not len(begins):
            return np.zeros(0, np.uint32), np.zeros(len(starts) - 1, np.int64)
        if len(self.starts) > self.most:
            self.clear()
        number = self.numbers(span_hashes(lower, begins, ends, self.powers), lower, begins, ends)
        first, last = self.starts[number], self.starts[number + 1]
        sizes = last - first
        upto = np.cumsum(sizes)
        ids = self.ids[np.repeat(first - (upto - sizes), sizes) + np.arange(int(upto[-1]))]
        # Units stand in order, so each text's are a stretch of them.
        edges = np.concatenate([[0], upto])[np.searchsorted(begins, starts)]
        return ids, np.diff(edges)


SPACE, LETTER, SIGN, OTHER = range(4)
KIND = np.full(256, SIGN, np.uint8)
KIND[[9, 10, 11, 12, 13, 32]] = SPACE
KIND[97:123] = LETTER
KIND[39] = OTHER
KIND[128:] = OTHER


def unit_bounds(lower: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kind = KIND[lower]
    n = len(kind)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.ones(n, bool)
    a, b = kind[:-1], kind[1:]
    edge[1:] = (a != b) & ((a == SPACE) | (b == SPACE) | ((a != OTHER) & (b != OTHER)))
    edge[starts[:-1][starts[:-1] < n]] = True
    begins = np.flatnonzero(edge)
    ends = np.append(begins[1:], n)
    solid = kind[begins] != SPACE
    return begins[solid], ends[solid]


@functools.partial(tidy, forget=False)
def token_pieces(batches, path: str, capacity: int, end_id: int):
    units = UnitTokens.of_worker(path)
    for batch in batches:
        doc_id, row = np.asarray(batch.column("doc_id").fill_null(0)), np.asarray(batch.column("row"))
        absent = np.asarray(batch.column("doc_id").is_null())
        for first, past, data, starts in text_blocks(batch.column("text"), FINE_BYTES):
            raw = data.tobytes()
            if any(x in raw for x in units.special):  # a special token's text: such documents as wholes
                each = [units.encode(raw[a:b].decode()) for a, b in zip(starts[:-1], starts[1:])]
            else:
                ids, counts = units.tokens(data, starts)
                each = np.split(ids, np.cumsum(counts)[:-1])
            end = np.array([end_id], np.uint32)
            out: list[tuple] = []
            for k, own in enumerate(each, first):
                own = np.append(own, end).astype("<u4")
                for piece, at in enumerate(range(0, len(own), capacity)):
                    part = own[at : at + capacity]
                    out.append((row[k], None if absent[k] else doc_id[k], piece, at, len(part), zlib.crc32(part)))
            columns = zip(*out)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["row", "doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)
