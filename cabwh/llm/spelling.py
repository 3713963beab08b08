"""Spelling variants of words: PartEnum signatures over letter multisets.

A word's letters are a binary vector with a place for every (letter, k): set if the letter occurs at least k times.
One inserted or deleted letter changes one place, one replaced letter two. The places are dealt over ``GROUPS``
groups; vectors at distance two or less agree on all but two groups at most, so each vector enumerates the sets of
groups left after taking two away and files the rest under an exact signature:

* replaced: words of one length agree on all but two groups, ``GROUPS * (GROUPS - 1) / 2`` signatures;
* inserted or deleted: the shorter and the longer word agree on all but one group, ``GROUPS`` signatures each way.

Length and the groups left out are part of a signature, so only words that may be near meet in the equi-join. It runs
over distinct multisets (anagrams are one row), whose letters are compared before their words are; the words of the
pairs left are verified by edit distance. Nothing is capped: the join's rows are what shares a signature.

1. One pass over the texts counts words by Arrow kernels, a slice's counts at a time; Spark adds them up.
2. Signatures, equi-join, verification.
3. A word's form is its most frequent near word, if frequent enough; roots follow forms by pointer doubling (each
   step multiplies the count by ``RATIO``, so few rounds do).

Simulated slips of the pen (``drop_one_in``): an occurrence whose checksum with its document's id is divisible by
the parameter loses one letter before it is counted; ``None`` counts the text as it is.

Defined cases: null and empty texts have no words; rows that repeat an id and its text count again; a null id enters
the checksum as an empty one; an empty table gives no rows; very long texts and words are taken whole; ties between
near words go to the smaller one in code-point order; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwh.llm.common import mix64, plain, table, written
from cabwh.llm.words import bytes_of, crc32_each, crc32_joined, slices, words_of

SEPARATORS = "[^A-Za-zÀ-ÿ]+"
DROP_ONE_IN = 31
MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10
GROUPS = 6
#: Letters by how common they are, so that the common ones are dealt over different groups.
_COMMON = "etaoinsrhldcumfpgwybvkxjqz"
_SAME, _SHORTER, _LONGER = 0, 1, 2


def _counted(distinct: pa.Array, count: np.ndarray, min_letters: int) -> tuple[pa.Array, pa.Array]:
    keep = (pc.utf8_length(distinct).to_numpy(zero_copy_only=False) >= min_letters) & (count > 0)
    return distinct.filter(pa.array(keep)), pa.array(count[keep].astype(np.int64))


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, drop_one_in: int | None = DROP_ONE_IN,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words of at least ``min_letters`` code points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part in slices(batch.column(1)):
                words = words_of(part, SEPARATORS)
                whole = words.index
                if drop_one_in:
                    ids = batch.column(0).slice(at, len(part)).to_pylist()
                    prefix = crc32_each([f"{'' if i is None else i}:".encode() for i in ids])
                    size = pc.binary_length(words.distinct).to_numpy(zero_copy_only=False).astype(np.int64)
                    h = crc32_joined(np.repeat(prefix, words.count), crc32_each(bytes_of(words.distinct))[whole],
                                     size[whole])
                    slip = h % np.uint32(drop_one_in) == 0
                    yield _slipped(words.distinct, whole[slip], h[slip], min_letters)
                    whole = whole[~slip]
                count = np.bincount(whole, minlength=len(words.distinct))
                yield pa.RecordBatch.from_arrays(list(_counted(words.distinct, count, min_letters)), ["word", "n"])

    return plain(docs, id=id_col, text=text_col).mapInArrow(run, "word string, n bigint").groupBy("word").agg(
        F.sum("n").alias("n"))


def _slipped(distinct: pa.Array, index: np.ndarray, h: np.ndarray, min_letters: int) -> pa.RecordBatch:
    """Words without the code point that the checksum names, counted."""
    letters = pc.utf8_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
    long_enough = letters[index] > min_letters
    index, h = index[long_enough], h[long_enough].astype(np.int64)
    which, count = np.unique(np.stack([index, h % letters[index]]), axis=1, return_counts=True)
    out = []
    for w, place in zip(distinct.take(pa.array(which[0])).to_pylist(), which[1].tolist(), strict=True):
        out.append(w[:place] + w[place + 1:])
    return pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(count.astype(np.int64))], ["word", "n"])


def letters_of(words: list[str]) -> list[str]:
    """Each word's letters, sorted: equal for words with the same multiset."""
    return ["".join(sorted(w)) for w in words]


def group_sums(letters: list[str]) -> np.ndarray:
    """For each multiset (sorted letters) and group of places: the sum of the random numbers of its set places."""
    size = np.array([len(m) for m in letters], dtype=np.int64)
    code = np.frombuffer("".join(letters).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    own = np.repeat(np.arange(len(letters)), size)
    at = np.arange(len(code))
    first = np.ones(len(code), dtype=bool)
    first[1:] = (code[1:] != code[:-1]) | (own[1:] != own[:-1])
    k = at - np.maximum.accumulate(np.where(first, at, 0))               # the letter's occurrence, from 0
    common = np.arange(0x110000 if len(code) and code.max() > 0xFF else 0x100)
    common[[ord(c) for c in _COMMON]] = np.arange(len(_COMMON))
    group = (common[code] + 5 * k) % GROUPS
    value = mix64((code << 32 | k).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    sums = np.zeros((len(letters), GROUPS), dtype=np.uint64)
    np.add.at(sums, (own, group), value)
    return sums


def signatures(letters: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(sides, signatures): a column of the second per signature, the first says what it is for."""
    sums = group_sums(letters)
    size = np.array([len(m) for m in letters], dtype=np.uint64)
    whole = sums.sum(axis=1, dtype=np.uint64)
    sides, out = [], []

    def add(side: int, rest: np.ndarray, left_out: int, shorter: np.ndarray) -> None:
        tag = mix64(np.uint64((left_out + 1) * 0xC2B2AE3D27D4EB4F % 2**64) + shorter)
        sides.append(side)
        out.append(mix64(rest + tag))

    for i in range(GROUPS):
        for j in range(i):
            add(_SAME, whole - sums[:, i] - sums[:, j], GROUPS + i * GROUPS + j, size)
        add(_SHORTER, whole - sums[:, i], i, size)
        add(_LONGER, whole - sums[:, i], i, size - np.uint64(1))
    return np.array(sides, dtype=np.int8), np.stack(out, axis=1).view(np.int64)


def _with_letters(words: DataFrame) -> DataFrame:
    """``words`` (word, n) with ``letters``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(letters_of(batch.column(0).to_pylist()), pa.string())],
                ["word", "n", "letters"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, letters string")


def _filed(multisets: DataFrame) -> DataFrame:
    """(signature, side, letters): every multiset under all its signatures."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.column(0).slice(at, 2_000)
                sides, signature = signatures(part.to_pylist())
                row = np.repeat(np.arange(len(part)), len(sides))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signature.ravel()), pa.array(np.tile(sides, len(part))), part.take(pa.array(row))],
                    ["signature", "side", "letters"])

    return multisets.select("letters").mapInArrow(run, "signature bigint, side tinyint, letters string")


def near_words(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): the pairs of ``words`` (word, n; words distinct) that one edit apart, once each."""
    words = written(_with_letters(words), "word-letters")
    filed = written(_filed(words.select("letters").distinct()), "signatures")
    a, b = (filed.select("signature", F.col("side").alias(f"side_{c}"), F.col("letters").alias(c)) for c in "ab")
    meets = ((F.col("side_a") == _SAME) & (F.col("side_b") == _SAME) & (F.col("a") < F.col("b"))
             | (F.col("side_a") == _SHORTER) & (F.col("side_b") == _LONGER))
    # sorted letters of vectors at distance two or less are at most two edits apart
    pairs = (a.join(b, "signature").filter(meets).filter(F.levenshtein("a", "b", 2) >= 0)
             .select("a", "b").distinct())
    of = lambda c: words.select(F.col("letters").alias(c), F.col("word").alias(f"word_{c}"),
                                F.col("n").alias(f"n_{c}"))
    return (pairs.join(of("a"), "a").drop("a").join(of("b"), "b")
            .filter(F.levenshtein("word_a", "word_b", 1) == 1)
            .select(F.col("word_a").alias("a"), "n_a", F.col("word_b").alias("b"), "n_b"))


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form; no cycles): the end of each word's chain, by pointer doubling."""
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = written(state.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if state.filter("moved").isEmpty():
            return state.drop("moved")
        state = state.drop("moved")


def spelling_variants(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = RATIO,
                      drop_one_in: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = written(word_counts(docs, min_letters, drop_one_in, id_col, text_col).filter(F.col("n") >= min_count),
                    "words")
    pairs = written(near_words(words), "near-words")
    links = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("n")))
    best = links.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                     F.min(F.struct((-F.col("n")).alias("minus"), "other")).alias("best"))
    rows = words.join(best, "word", "left").withColumn("best_n", -F.col("best.minus"))
    follows = F.col("best_n") >= ratio * F.col("n")
    rows = written(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                               F.when(follows, F.col("best.other")).alias("form"),
                               F.when(follows, F.col("best_n")).alias("form_n")), "forms")
    roots = roots_of(rows.filter("form is not null"))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def with_standard_words(words: DataFrame, variants: DataFrame, word_col: str = "word") -> DataFrame:
    """``words`` with the column ``root``: each word's most frequent spelling (itself where it has no variant)."""
    known = variants.select(F.col("word").alias("__word"), F.col("root").alias("__root")).filter("__root <> __word")
    return (words.join(known, words[word_col] == known["__word"], "left")
            .withColumn("root", F.coalesce("__root", F.col(f"`{word_col}`"))).drop("__word", "__root"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, some occurrences with a slip, and the spelling each is a variant of."""
    return spelling_variants(table(spark, sf_dir, "documents"), drop_one_in=DROP_ONE_IN).select(
        "word", "form", "root", "n", "n_near", "form_n")
