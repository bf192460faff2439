import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from shopsight.llm import packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_ids_equal_the_tokenizer(corpus):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n", "<|endoftext| >", "<|END|>"]
    for text in [r[1] for r in corpus] + special + ["naïve 12,5€ — it's\n\n  x", "日本語 text", "\x00\x7f"]:
        want = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        assert packing.token_ids(text, RANKS).tolist() == want


def test_every_id_is_in_one_piece_and_sequences_are_full(spark, docs, corpus):
    rows = packing.pack(docs, RANKS, group_docs=15).collect()
    texts = defaultdict(list)
    for r in corpus:
        texts[r[0]].append(packing.token_ids(r[1], RANKS))
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        assert any((ids[r.start : r.start + r.length].tobytes(), len(ids)) and
                   zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and len(ids) == r.doc_tokens
                   for ids in texts[r.doc_id])
    for key, ids in texts.items():
        assert sum(p.length for p in pieces[key]) == sum(map(len, ids))
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    # the same sequences again
    again = packing.pack(docs, RANKS, group_docs=15).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)
    assert packing.pack(docs.limit(0), RANKS).count() == 0


def test_groups_are_bounded_by_pieces(spark):
    """Few documents of many pieces, and many equal rows."""
    rows = [(1, "word " * 200_000), (2, "two words " * 60_000)] + [(3, "same row")] * 400
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, group_docs=40).collect()
    assert sum(r.length for r in out) == sum(len(packing.token_ids(t, RANKS)) for _, t in rows)
    groups = Counter(r.sequence_id >> 32 for r in out)
    assert len(out) > 600 and max(groups.values()) <= 100
    full = [r.sequence_id for r in out if r.length == 1024]
    others = {r.sequence_id for r in out if r.length < 1024}
    assert len(set(full)) == len(full) and not others & set(full)


def test_first_fit_decreasing_equals_a_plain_scan():
    r = np.random.default_rng(1)
    for n in (1, 2, 50, 400):
        lengths = r.integers(1, 1025, n)
        bins, offsets = packing.first_fit_decreasing(lengths, 1024)
        room = []
        for i in np.argsort(-lengths, kind="stable"):
            b = next((k for k, x in enumerate(room) if x >= lengths[i]), len(room))
            if b == len(room):
                room.append(1024)
            assert (bins[i], offsets[i]) == (b, 1024 - room[b])
            room[b] -= lengths[i]
