"""Quality rules by distribution divergence.

Each document's histogram of character classes and of common words is compared
with its language's reference by Jensen-Shannon distance. The references are
the mean histograms of all documents of the language, summed by Spark, and
summed once more without the documents that the first reference finds strange,
so that junk doesn't set the norm; fixed lists of common words name the bins. A
document too short for a stable histogram is judged by the base rules alone
(minimum-length guards).

Defined results: null or empty text has no words and fails the base rule of
length; a null language is a language of its own; equal rows are judged
alike, each by itself; an empty table gives an empty result; other columns
pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.llm import textops as X
from shopsight.llm.common import col, cut, fresh, map_rows, slices, text_bytes, trimmed

#: Common words of four languages, the bins of the word histogram.
COMMON_WORDS = {
    "en": "the of and to in is that for it was on are as with be by at this from or an not have",
    "de": "der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es an",
    "fr": "le la les de des et en un une du que est pour qui dans par sur au pas avec ce il plus",
    "es": "el la los las de que y en un una del se por con no es para su al lo como más o",
}
#: Bins of the character histogram. Digits count with the lower
#: case: numbers in a text say nothing about its quality.
CLASSES = ("lower", "upper", "white", "stop", "symbol", "other", "letter")
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """Thresholds of the verdict; distances run from 0 to 1."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_chars: int = 200
    max_char_distance: float = 0.15
    min_histogram_words: int = 150
    max_word_distance: float = 0.32


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), np.int64)
    for name, chars in (
        ("lower", [*range(97, 123), *range(48, 58)]), ("upper", range(65, 91)), ("white", [*range(9, 14), 32]), ("stop", b".,;:!?'\"-()"), ("symbol", SYMBOLS),
        ("letter", range(0xC0, 0x100)),
    ):
        table[list(chars)] = CLASSES.index(name)
    return table


_CLASS = _class_table()
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_STOP = np.isin(np.arange(256), list(b".,;:!?"))
VOCABULARY = sorted({w for ws in COMMON_WORDS.values() for w in ws.split()})


def _bin_hashes() -> tuple[np.ndarray, np.ndarray]:
    raw = "".join(VOCABULARY).encode()
    ends = np.cumsum([len(w.encode()) for w in VOCABULARY])
    h = X.Hasher(np.frombuffer(raw, np.uint8)).of(np.r_[0, ends[:-1]], ends)
    order = np.argsort(h)
    return h[order], order


_BIN_HASH, _BIN = _bin_hashes()

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars")
FEATURES = T.StructType(
    [T.StructField(n, T.LongType()) for n in COUNTS]
    + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("chars", "words")]
)


def _repeated(key: np.ndarray) -> np.ndarray:
    """Which entries of ``key`` occur twice or more."""
    if not len(key):
        return np.zeros(0, bool)
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def features(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The counts and histograms of each text."""
    n = len(off) - 1
    starts, ends, rows = X.word_spans(data, off)
    lead = (data & 0xC0) != 0x80
    hashes = X.Hasher(data)
    salt = X.mix(np.arange(n, dtype=np.uint64) + X.U(1))

    key, first = X.shingles(hashes.of(starts, ends), rows, 3)
    again = first[_repeated(X.mix(key ^ salt[rows[first]]))]
    repeat = np.zeros(len(starts) + 2, bool)
    for k in range(3):
        repeat[again + k] = True

    line_at = np.unique(np.r_[off[:-1], np.flatnonzero(data == 10) + 1])
    line_at = line_at[line_at < len(data)]
    line_to = np.r_[line_at[1:], len(data)]
    line_row = np.searchsorted(off, line_at, "right") - 1
    line_to = np.where(data[line_to - 1] == 10, line_to - 1, line_to) if len(line_to) else line_to
    seen = np.r_[0, np.cumsum(~X.WHITE[data])]
    real = seen[line_to] > seen[line_at]
    line_row = line_row[real]
    _, one = np.unique(X.mix(hashes.of(line_at[real], line_to[real]) ^ salt[line_row]), return_index=True)
    lines, distinct = np.bincount(line_row, minlength=n), np.bincount(line_row[one], minlength=n)

    byte_row = np.repeat(np.arange(n), np.diff(off))
    chars = np.bincount((byte_row * len(CLASSES) + _CLASS[data])[lead], minlength=n * len(CLASSES))

    low = X.LOWER[data]
    cut = ends.copy()
    for _ in range(3):  # closing punctuation is no part of a word here
        cut = np.where((cut > starts) & _STOP[low[cut - 1]], cut - 1, cut) if len(cut) else cut
    words = X.Hasher(low).of(starts, cut)
    at = np.minimum(np.searchsorted(_BIN_HASH, words), len(_BIN) - 1)
    bins = np.where(_BIN_HASH[at] == words, _BIN[at], len(VOCABULARY))
    width = len(VOCABULARY) + 1
    return {
        "n_words": np.bincount(rows, minlength=n),
        "word_chars": X.per_row(lead & ~X.WHITE[data], off),
        "n_symbols": X.per_row(_SYMBOL[data], off),
        "n_dup_lines": lines - distinct,
        "n_repeat_words": np.bincount(rows[repeat[: len(rows)]], minlength=n),
        "n_chars": X.per_row(lead, off),
        "chars": chars.reshape(n, -1),
        "words": np.bincount(rows * width + bins, minlength=n * width).reshape(n, -1),
    }


def _struct(column: pa.Array) -> pa.StructArray:
    data, off = text_bytes(column)
    parts = [features(data[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in slices(off)]
    out = []
    for f in FEATURES.fields:
        x = np.concatenate([p[f.name] for p in parts]) if parts else np.zeros((0, 1), np.int64)
        if isinstance(f.dataType, T.ArrayType):
            ends = np.arange(len(column) + 1, dtype=np.int32) * x.shape[1]
            out.append(pa.ListArray.from_arrays(ends, pa.array(x.ravel().astype(np.int64))))
        else:
            out.append(pa.array(x.ravel().astype(np.int64)))
    return pa.StructArray.from_arrays(out, names=FEATURES.names)


def with_features(docs: DataFrame, text: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` and a struct column ``out`` of counts and histograms."""
    at = docs.columns.index(text)

    return map_rows(docs, lambda b: [_struct(b.column(at))], [T.StructField(out, FEATURES)])


_WIDTH = {"chars": len(CLASSES), "words": len(VOCABULARY) + 1}


def _shares(counts: Column) -> Column:
    total = F.greatest(F.aggregate(counts, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(1))
    return F.transform(counts, lambda x: x / total)


def language_references(scored: DataFrame, lang: Column, features: str) -> DataFrame:
    """Mean histograms (shares) of the documents of each language.

    Plain sums, so each task sends a row for each language and bin, however
    many documents the language has.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str | None, np.ndarray] = {}
        for b in batches:
            counts = np.concatenate([b.column(1 + k).flatten().to_numpy().reshape(b.num_rows, -1) for k in range(len(_WIDTH))], axis=1)
            codes = b.column(0).dictionary_encode()
            at = codes.indices.fill_null(len(codes.dictionary)).to_numpy()
            for k, name in enumerate([*codes.dictionary.to_pylist(), None]):
                sums[name] = sums.get(name, 0) + counts[at == k].sum(axis=0)
        total = pa.array(np.concatenate(list(sums.values())) if sums else np.zeros(0), pa.int64())
        bins = sum(_WIDTH.values())
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.array(list(sums), object), bins), pa.string()),
            pa.array(np.tile(np.arange(bins, dtype=np.int32), len(sums))), total], names=["__ref_lang", "bin", "n"])

    plain = scored.select(lang.cast("string").alias("lang"), *(F.col(features)[n].alias(n) for n in _WIDTH))
    sums = plain.mapInArrow(trimmed(run), "__ref_lang string, bin int, n long").groupBy("__ref_lang", "bin").agg(F.sum("n").alias("n"))
    whole = sums.groupBy("__ref_lang").agg(F.sum("n").alias("all"), F.transform(
        F.sort_array(F.collect_list(F.struct("bin", "n"))), lambda x: x["n"]).alias("counts")).where(F.col("all") > 0)
    out, first = [F.col("__ref_lang")], 1
    for n, w in _WIDTH.items():
        out.append(_shares(F.slice("counts", first, w)).alias(f"__ref_{n}"))
        first += w
    return whole.select(*out)


def js_distance(counts: Column, total: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (square root, base 2) of a histogram with this
    ``total`` and the ``reference`` shares; 0 for an empty histogram."""
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    parts = F.zip_with(counts, reference, lambda c, y: term(c / total, (c / total + y) / 2) + term(y, (c / total + y) / 2))
    divergence = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x) / 2
    return F.when(total > 0, F.sqrt(F.greatest(divergence, F.lit(0.0)))).otherwise(0.0)


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits(),
          out: str = "quality") -> DataFrame:
    """``docs`` and a struct ``out``: the five counts, both distances,
    ``base_failed`` and ``kept``."""
    get = lambda n: F.col(out)[n]
    with_refs = lambda df, key, refs: df.join(
        refs, key.cast("string").eqNullSafe(F.col("__ref_lang")), "left")
    # without a reference (all documents of the language are strange) everything is as far as can be
    far = lambda n, ref: F.when(F.col(ref).isNull(), 1.0).otherwise(js_distance(get(n), get(f"n_{n}"), F.col(ref)))
    by_char = F.when(get("n_chars") >= limits.min_chars, far("chars", "__ref_chars")).otherwise(0.0)
    by_word = F.when(get("n_words") >= limits.min_histogram_words, far("words", "__ref_words")).otherwise(0.0)
    strange = (by_char > limits.max_char_distance) | (by_word > limits.max_word_distance)

    # kept: both references are made of these narrow rows
    bare = cut(with_features(docs.select(col(text).alias(text), col(lang).alias("__lang")), text, out).drop(text))
    first = language_references(bare, F.col("__lang"), out)
    usual = with_refs(bare, F.col("__lang"), first).where(~strange).select("__lang", out)
    refs = language_references(usual, F.col("__lang"), out)

    base_failed = (get("n_words") < limits.min_words) | (
        100 * get("n_repeat_words") > limits.max_repeat_percent * get("n_words"))
    return with_refs(with_features(docs, text, out), col(lang), refs).withColumn(out, F.struct(
        *(get(n).alias(n) for n in COUNTS),
        by_char.alias("char_distance"), by_word.alias("word_distance"),
        base_failed.alias("base_failed"), (~base_failed & ~strange).alias("kept"),
    )).select(*(col(c) for c in docs.columns), F.col(out))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    out = fresh(docs, "quality")
    return judge(docs, text, lang, limits, out).where(F.col(out)["kept"]).drop(out)
