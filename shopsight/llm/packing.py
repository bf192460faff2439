"""Packing documents into fixed-length token sequences.

Each document becomes its token ids and an end id, cut into full sequences and
one shorter piece. Full pieces are sequences of their own and are only numbered.
Shorter pieces are dealt into random groups and each group is packed by itself:
first-fit decreasing, the first bin with room found by descent in a tournament
tree of bin capacities. Groups are as many as the counted pieces of either kind
need, so each is of bounded size however long the texts are. Only piece lengths
and check sums are shuffled, never the ids.

Defined results: null or empty text is the end id alone; equal rows (same id and
text) are packed as separate documents with the same values; very long texts are
encoded whole and give many pieces; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsight.llm.common import col, cut

SEQUENCE = 1024
END_ID = 0
#: Pieces in a group, about (a document has one short piece at most): its table is a few MB, and with
#: thousands of pieces first-fit decreasing leaves little room unused.
GROUP_DOCS = 20_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, salt long"
PACKED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


#: Added tokens of byte_bpe_50k.json. A text that holds one gets its id.
ADDED_TOKENS = {"<|endoftext|>": 50256}


@lru_cache(maxsize=2)
def _encoding(ranks_path: str):
    """The vocabulary of ``ranks_path``; it gives the ids of byte_bpe_50k.json."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=ADDED_TOKENS)


def token_ids(text: str | None, ranks_path: str) -> np.ndarray:
    """Ids of the whole text and the end id."""
    ids = _encoding(ranks_path).encode(text or "", allowed_special=set(ADDED_TOKENS), disallowed_special=())
    return np.array([*ids, END_ID], dtype="<u4")


def pieces(docs: DataFrame, ranks_path: str, text: str = "text", doc_id: str = "doc_id",
           sequence: int = SEQUENCE) -> DataFrame:
    """One row a piece: place in its document, length and check sum of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for key, value in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = token_ids(value.as_py(), ranks_path)
                whole = zlib.crc32(ids.tobytes())
                for at in range(0, len(ids), sequence):
                    part = ids[at : at + sequence]
                    out.append((key, at, len(part), zlib.crc32(part.tobytes()), len(ids), whole))
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt")
            arrays = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names=names)

    part = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    return part.mapInArrow(run, PIECES)


class Tournament:
    """Capacities of bins in a complete binary tree; a parent holds the larger
    child. ``place`` puts a length into the first bin with room."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.tree = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the room that it had."""
        tree, at = self.tree, 1
        while at < self.leaves:
            at *= 2
            if tree[at] < length:
                at += 1
        bin_, room = at - self.leaves, tree[at]
        tree[at] = room - length
        while at > 1:
            at //= 2
            best = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                break
            tree[at] = best
        return bin_, room


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, the longest placed first."""
    tree = Tournament(max(1, len(lengths)), capacity)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        bins[i], room = tree.place(int(lengths[i]))
        offsets[i] = capacity - room
    return bins, offsets


def pack(docs: DataFrame, ranks_path: str, text: str = "text", doc_id: str = "doc_id",
         sequence: int = SEQUENCE, group_docs: int = GROUP_DOCS) -> DataFrame:
    """One row a piece, with its sequence and its offset there.

    A piece of full length is a sequence of its own. ``sequence_id`` is the
    group number times 2**32 plus the bin, so groups need not know each other.
    """
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt")
    # equal pieces of equal rows are numbered, so that they need not meet in one group
    found = cut(pieces(docs, ranks_path, text, doc_id, sequence).groupBy(*names).agg(F.count(F.lit(1)).alias("n")))
    full = F.col("length") == sequence
    counts = found.groupBy(full.alias("full")).agg(F.sum("n").alias("n")).collect()
    short_groups, full_groups = (max([1, *(-(-c.n // group_docs) for c in counts if c.full == kind)]) for kind in (False, True))

    def run(table: pa.Table) -> pa.Table:
        # sorted, so that a repeated run gives the same sequences
        t = table.sort_by([(n, "ascending") for n in ("doc_id", "start", "ids_crc32", "salt", "copy")])
        group = t.column("group")[0].as_py()
        if group < short_groups:
            bins, offsets = first_fit_decreasing(t.column("length").to_numpy(), sequence)
        else:
            bins, offsets = np.arange(len(t)), np.zeros(len(t), np.int64)
        return pa.table([*(t.column(n) for n in names[:-1]), pa.array(bins + (group << 32)), pa.array(offsets)],
                        names=[*names[:-1], "sequence_id", "offset"])

    place = F.xxhash64("doc_id", "start", "salt", "copy")
    group = F.when(full, short_groups + F.pmod(place, F.lit(full_groups))).otherwise(F.pmod(place, F.lit(short_groups)))
    dealt = found.select(*names, F.explode(F.sequence(F.lit(1), "n")).alias("copy")).withColumn("group", group)
    return dealt.groupBy("group").applyInArrow(run, PACKED)
