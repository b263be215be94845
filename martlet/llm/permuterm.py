"""Operator 12: spelling variants by permuterm rotations.

1. Words: every run of letters of every text, A-Z lower-cased. By the contract of
   the registered query a run loses one code point where a CRC-32 of its document
   and itself says so (``planted_typos``). Results of at least ``min_length`` code
   points that occur ``min_count`` times or more are the words. Tasks add up their
   counts before the shuffle.
2. Rotations: a word marked with a terminator, ``w$``, has ``len(w) + 1``
   rotations; each is one row. The rotation that begins right after position i and
   ends with the code point at i is ``y$xc``: words that differ by a replacement
   there have rotations equal up to the last code point, and the word without
   that code point has the rotation ``y$x`` itself. So near words are the rows of
   one prefix range, with the edited code point skipped.
3. Rows are dealt out by their first ``min_length`` code points, which all rows of
   a range share, and sorted within partitions. One scan keeps a stack of the open
   ranges (each a prefix of the next one, each of at most one member a letter of
   the alphabet) and emits one row a member: how many neighbours the range gives
   it and the best of them. Every pair of near words has exactly one range: in a
   run of equal code points only the first may be the deleted one.
4. A word's form is its most frequent neighbour (ties: smallest in code-point
   order) where that is ``ratio`` times as frequent; roots follow by pointer
   doubling, in rounds logarithmic in the longest chain.

Words of ``LONG`` code points and more would make rotations of quadratic size.
They take the same ranges by hash: the word less code point i, by two polynomial
hashes modulo 2**61 - 1 and the position, one short row a position.

Defined results: null and empty texts have no words; a null ``doc_id`` counts as
an empty text in the CRC; repeated rows count each time; an empty table gives an
empty result; further columns of the table are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import stored

MARK = "$"
#: From this length on, ranges are found by hash.
LONG = 64
#: Distinct words a task holds before it passes its counts on.
HELD = 200_000
_PRIME = (1 << 61) - 1
_BASES = (1_000_003, 998_244_353)

#: Latin-1 bytes: letters lower-cased (A-Z only), all else to a space.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def runs(text: str | None) -> list[bytes]:
    """The maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, as Latin-1;
    a code point beyond Latin-1 is no letter here."""
    return [] if text is None else text.encode("latin-1", "replace").translate(_LETTERS).split()


def planted_typo(run: bytes, head: int, every: int = 31) -> bytes:
    """``run`` less the code point its CRC-32 names where ``every`` divides that;
    ``head`` is the CRC-32 of ``<doc_id>:``."""
    utf8 = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(utf8, head)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, min_length: int = 7, planted_typos: bool = False) -> DataFrame:
    """``word, n`` of all words of ``min_length`` code points or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])

        held: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                found = [w for w in runs(text.as_py()) if len(w) >= min_length]
                if not planted_typos:
                    held.update(found)
                else:
                    head = zlib.crc32(b"%s:" % (doc_id.as_py() or "").encode())
                    for w, k in Counter(found).items():
                        w = planted_typo(w, head)
                        if len(w) >= min_length:
                            held[w] += k
                if len(held) >= HELD:
                    yield out()
                    held = Counter()
        yield out()

    rows = docs.select(docs["doc_id"].cast("string").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """``rotation, n``: every rotation of the marked words."""
    marked = F.concat("word", F.lit(MARK))
    cut = words.select(
        "n", marked.alias("marked"), F.explode(F.sequence(F.lit(1), F.char_length("word") + 1)).alias("i")
    )
    return cut.select(F.expr("concat(substring(marked, i), substring(marked, 1, i - 1))").alias("rotation"), "n")


def _word_of(rotation: str) -> str:
    at = rotation.index(MARK)
    return rotation[at + 1 :] + rotation[:at]


def neighbours_of_range(whole: tuple | None, members: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
    """``word, near, best n, best word`` for everyone in one range.

    ``whole`` is ``(rotation, n)`` of the word without the skipped code point,
    ``members`` those of the words with one there.
    """
    named = sorted((-n, _word_of(r), r[-1] != r[-2]) for r, n in members)
    first = [x for x in named if x[2]]
    if whole is not None and first:
        yield _word_of(whole[0]), len(first), -first[0][0], first[0][1]
        shorter = (-whole[1], _word_of(whole[0]))
    for i, (_, word, deletes) in enumerate(named):
        others = [x[:2] for x in named[: 2] if x[1] != word]
        near = len(named) - 1
        if whole is not None and deletes:
            others.append(shorter)
            near += 1
        if near:
            best = min(others)
            yield word, near, -best[0], best[1]


def scan_rotations(sorted_rows: Iterator[tuple[str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """Neighbours by one pass over sorted rotations; holds the open ranges only."""
    keys: list[str] = []  # the open ranges' prefixes, each a prefix of the next
    ranges: list[tuple[tuple | None, list]] = []
    for rotation, n in sorted_rows:
        while keys and not rotation.startswith(keys[-1]):
            keys.pop()
            whole, members = ranges.pop()
            if len(members) > (whole is None):
                yield from neighbours_of_range(whole, members)
        skipped = rotation[:-1]
        if rotation[-1] != MARK:
            if not keys or keys[-1] != skipped:
                keys.append(skipped)
                ranges.append((None, []))
            ranges[-1][1].append((rotation, n))
        keys.append(rotation)
        ranges.append(((rotation, n), []))
    while ranges:
        whole, members = ranges.pop()
        if len(members) > (whole is None):
            yield from neighbours_of_range(whole, members)


_NEAR = "word string, near long, best_n long, best string"


def _near_short(words: DataFrame, min_length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[str, int]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        def out() -> pa.RecordBatch:
            columns = list(zip(*found))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["word", "near", "best_n", "best"])

        found: list[tuple] = []
        for row in scan_rotations(rows()):
            found.append(row)
            if len(found) == 10_000:
                yield out()
                found = []
        if found:
            yield out()

    dealt = rotations(words).repartition(F.substring("rotation", 1, min_length))
    return dealt.sortWithinPartitions("rotation").mapInArrow(run, _NEAR)


def skip_hashes(codes: list[int], base: int) -> tuple[int, list[int]]:
    """Polynomial hash of a word and of the word less each of its code points."""
    n = len(codes)
    power, prefix, suffix = [1] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i, c in enumerate(codes):
        power[i + 1] = power[i] * base % _PRIME
        prefix[i + 1] = (prefix[i] * base + c) % _PRIME
    for i in range(n - 1, -1, -1):
        suffix[i] = (suffix[i + 1] + codes[i] * power[n - 1 - i]) % _PRIME
    return prefix[n], [(prefix[i] * power[n - 1 - i] + suffix[i + 1]) % _PRIME for i in range(n)]


def _near_long(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word in batch.column(0).to_pylist():
                codes = [ord(c) for c in word]
                (w1, s1), (w2, s2) = (skip_hashes(codes, b) for b in _BASES)
                at = [-1]
                h1, h2, first = [w1], [w2], [False]
                if len(word) >= LONG:
                    at += range(len(word))
                    h1, h2 = h1 + s1, h2 + s2
                    first += [i == 0 or codes[i] != codes[i - 1] for i in range(len(word))]
                ref = [xxhash.xxh3_128_hexdigest(word.encode())] * len(at)
                columns = [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(at, pa.int64()), pa.array(first), pa.array(ref)]
                yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "at", "first", "ref"])

    # LONG - 1: such a word is the shorter one of a pair with a word of LONG.
    names = stored(
        words.select("word").where(F.char_length("word") >= LONG - 1).mapInArrow(run, "h1 long, h2 long, at long, first boolean, ref string"),
        "permuterm-long",
    )
    cut, whole = names.where("at >= 0"), names.where("at < 0").select("h1", "h2", F.col("ref").alias("other"))
    replaced = cut.alias("x").join(cut.alias("y"), ["h1", "h2", "at"]).where("x.ref <> y.ref").select("x.ref", F.col("y.ref").alias("other"))
    deleted = cut.where("first").join(whole, ["h1", "h2"]).select("ref", "other")
    pairs = replaced.union(deleted).union(deleted.select("other", "ref"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ref = pa.array([xxhash.xxh3_128_hexdigest(w.encode()) for w in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([ref, batch.column(0), batch.column(1)], ["ref", "word", "n"])

    texts = words.select("word", "n").where(F.char_length("word") >= LONG - 1).mapInArrow(hashed, "ref string, word string, n long")
    return (
        pairs.join(texts.select("ref", "word"), "ref")
        .join(texts.select(F.col("ref").alias("other"), F.col("n").alias("best_n"), F.col("word").alias("best")), "other")
        .select("word", F.lit(1).cast("long").alias("near"), "best_n", "best")
    )


def _with_roots(forms: DataFrame) -> DataFrame:
    """``word, form, root`` from ``word, form``: forms of larger and larger count
    end, so doubling the pointers does, too."""
    at = stored(forms.select("word", F.col("form").alias("root")), "permuterm-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(at.join(on, "root", "left"), "permuterm-roots")
        at = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.where("next IS NOT NULL").isEmpty():
            return forms.join(at, "word")


def spelling_variants(
    docs: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = 10, planted_typos: bool = False
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``docs``.

    ``ratio`` is above 1, so that the counts of a chain of forms grow and it ends.
    """
    if ratio <= 1:
        raise ValueError(f"ratio {ratio}")
    counted = word_counts(docs, min_length, planted_typos).where(F.col("n") >= min_count)
    words = stored(counted, "permuterm-words")
    short = _near_short(words.where(F.char_length("word") < LONG), min_length)
    near = short.unionByName(_near_long(words)).groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best")
    )
    strong = -F.col("best.less") >= ratio * F.col("n")
    judged = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(strong, F.col("best.word")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"),
        ),
        "permuterm-judged",
    )
    roots = _with_roots(judged.where("form IS NOT NULL").select("word", "form")).select("word", "root")
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
