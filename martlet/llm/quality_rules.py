"""Operator 3: line-first quality rules.

Every line of a text is judged alone by three rules; a line that fails any of
them is removed:

- punctuation: the line ends without a terminal mark and is short, most of its
  words carry doubled marks, or symbols crowd its words;
- navigation: separators (``|``, ``>``, ...) stand between its words;
- boilerplate: phrases of licences, cookie notices or site chrome make it up: it
  holds one for every ``words_per_phrase`` of its words. So a phrase takes a short
  line away, and a paragraph that mentions one stays.

A document is rejected when the base rules fail (too few words, or too many
words in repeated 3-word windows) or when the removed lines held more than
``max_loss_percent`` of its word characters.

Defined results: a null or empty text has no words, fails the base rules and is
rejected; a line without words never fails and is kept as it is; equal rows
give equal results, row by row; an empty table gives an empty result. Other
columns are carried through untouched by :func:`clean_documents` and ignored by
:func:`judge_documents`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from martlet.llm.common import text_bytes

SYMBOLS = "#*$%&|<>"
#: A terminal mark, closing quotes or brackets, the end of the line.
TERMINAL_PATTERN = r"[.!?…:;。！？][\"'”’»)\]}]*[\x20\x09-\x0D]*$"
SEPARATORS = ["|", ">", "/", "»", "›", "•", "·"]
BOILERPLATE_PATTERN = (
    r"\b(?:all rights reserved\b|licensed under\b|released under\b|copyright \(c\)|terms of (?:use|service)\b"
    r"|privacy policy\b|cookies?\b|enable javascript\b|subscribe to\b|click here\b|sign in to\b|log in to\b)"
)
_terminal = re.compile(TERMINAL_PATTERN)
# ASCII word boundaries, as in the SQL form.
_boilerplate = re.compile(BOILERPLATE_PATTERN, re.IGNORECASE | re.ASCII)
_separators = frozenset(x.encode() for x in SEPARATORS)


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the rules (the defaults are the production values)."""

    min_words: int = 50
    max_repeat_percent: int = 50
    short_line_words: int = 10
    max_doubled_percent: int = 30
    max_symbol_percent: int = 50
    max_separator_percent: int = 15
    max_loss_percent: int = 50
    words_per_phrase: int = 20


@dataclass(frozen=True)
class Verdict:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_failed_lines: int
    lost_chars: int
    base_failed: bool
    kept: bool
    clean_text: str


def line_fails(line: str, rules: LineRules) -> bool:
    """True if one line fails the punctuation, navigation or boilerplate rule."""
    words = text_bytes(line).split()
    n = len(words)
    if n == 0:
        return False
    if n < rules.short_line_words and not _terminal.search(line):
        return True
    if 100 * sum(w.endswith((b"!!", b"??")) for w in words) > rules.max_doubled_percent * n:
        return True
    separators = sum(w in _separators for w in words)
    if separators >= 3 and 100 * separators > rules.max_separator_percent * n:
        return True
    if 100 * sum(map(line.count, SYMBOLS)) > rules.max_symbol_percent * n:
        return True
    phrases = len(_boilerplate.findall(line))
    return phrases > 0 and phrases * rules.words_per_phrase >= n


def repeated_window_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = 0
    upto = 0  # words before this position are counted already
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(upto, i)
            upto = i + 3
    return covered


def word_chars_of(text: str) -> int:
    return len(text) - sum(map(text.count, " \t\n\v\f\r"))


def judge(text: str | None, rules: LineRules) -> Verdict:
    """All counts and the verdict of one text."""
    text = text or ""
    words = text_bytes(text).split()
    lines = text.split("\n")
    seen: set[str] = set()
    dup_lines = 0
    failed = 0
    lost = 0
    kept_lines = []
    for line in lines:
        if line in seen:
            dup_lines += 1
        elif word_chars_of(line):
            seen.add(line)
        if line_fails(line, rules):
            failed += 1
            lost += word_chars_of(line)
        else:
            kept_lines.append(line)
    n = len(words)
    chars = word_chars_of(text)
    repeats = repeated_window_words(words)
    base_failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    return Verdict(
        n, chars, sum(map(text.count, SYMBOLS)), dup_lines, repeats, failed, lost,
        base_failed, not base_failed and 100 * lost <= rules.max_loss_percent * chars, "\n".join(kept_lines),
    )


def judge_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: the counts, ``base_failed`` and ``kept``."""
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
              "base_failed", "kept", "n_failed_lines", "lost_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = [judge(x.as_py(), rules) for x in batch.column(1)]
            columns = [
                pa.array([getattr(v, f) for v in verdicts], pa.bool_() if f in ("base_failed", "kept") else pa.int64())
                for f in fields
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *fields])

    schema = "doc_id long, " + ", ".join(
        f"{f} {'boolean' if f in ('base_failed', 'kept') else 'long'}" for f in fields
    )
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, schema)


def clean_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The kept documents, all columns, with their failing lines removed.

    ``n_chars``, where present, becomes the length of the cleaned text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = [judge(x.as_py(), rules) for x in batch.column("text")]
            batch = batch.filter(pa.array([v.kept for v in verdicts], pa.bool_()))
            texts = pa.array([v.clean_text for v in verdicts if v.kept], batch.schema.field("text").type)
            columns = []
            for name, column in zip(batch.schema.names, batch.columns):
                if name == "text":
                    column = texts
                elif name == "n_chars":
                    column = pc.utf8_length(texts).cast(column.type)
                columns.append(column)
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
