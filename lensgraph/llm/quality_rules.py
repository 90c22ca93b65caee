"""Line-first document cleaning.

Each line meets these rules: terminal punctuation (a line that ends like a
sentence, or has fewer than ``HEADING_WORDS`` words, passes), navigation (menus:
separators in most gaps between words, or a run of ``MENU_LINES`` lines of a few
words each that do not end like sentences), symbol runs, shouting, and boilerplate.
Lines that fail go; a document that loses more than ``MAX_LOST`` of its word
characters goes with them.

Boilerplate is learned from the corpus: a line of ``BOILERPLATE_WORDS`` words is
boilerplate if it stands between different neighbours in many documents, at
``MIN_CONTEXTS`` places at least and at one for each ``DOCS_A_CONTEXT`` documents.
Copies of a document have the same neighbours and do not count.  Case and digits
are folded, so that pages with numbers of as many digits are one line.  As the places needed grow with
the corpus, the boilerplate lines are at most DOCS_A_CONTEXT times the lines of a
mean document, whatever its size; their hashes go to all tasks.  Phrases of
licences, cookies and copyright, which name themselves, count in any number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lensgraph.llm import textnp

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
#: A document is rejected if its failed lines hold more than this share of its word characters.
MAX_LOST = 0.5
#: A line of at least this many words has to end like a sentence.
HEADING_WORDS = 10
#: So many lines in a row, of at most SHORT_WORDS words and without a sentence's end, are a menu.
MENU_LINES = 4
SHORT_WORDS = 3
BOILERPLATE_WORDS = (3, 40)
MIN_CONTEXTS = 10
DOCS_A_CONTEXT = 2000
#: A menu has separators in at least so many gaps between its words, and in more than half of them.
MENU_GAPS = 2

# Phrases that mark a line as boilerplate, separators of menus.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "this site uses cookies",
    "this website uses cookies",
    "we use cookies",
)
#: The phrase has to name a licence, as prose also speaks of what is released or available under something.
LICENCES = (
    r"\b(?:licen[cs]ed|released|distributed|published|available) under\b.{0,80}?\b(?:licen[cs]es?\b|cc[ -]?(?:by|0)\b|creative commons\b)",
    r"\bspdx-license-identifier\b",
    r"\bcopyright\s*(?:\(c\)|©|[12]\d{3}\b)",
    r"(?:\(c\)|©)\s*(?:copyright\b|[12]\d{3}\b)",
)
SEPARATORS = ("|", "||", "/", "//", ">", ">>", "::", "\u00b7", "\u00bb", "\u2022", "\u203a")
# End of the fixed values.

_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)).encode())
_LICENCE = re.compile("|".join(LICENCES).encode())
#: Each licence pattern needs one of these, which are quicker to look for.
_LICENCE_KEYS = tuple(x.encode() for x in ("under", "spdx-", "copyright", "(c)", "©"))
_SEPARATORS = frozenset(x.encode() for x in SEPARATORS)
#: Terminal punctuation at the end, with quotes, brackets and white space behind it.
_SENTENCE_END = re.compile("(?:[.!?:;]|\u2026|\u3002|\uff01|\uff1f|\u061f|\u06d4|\u0964)(?:[\"')\\]\\s*_]|\u00bb|\u00ab|\u2019|\u201c|\u201d|\u203a|\u300d|\u00a0)*$".encode())
_SHOUT = re.compile(rb"!!")
#: A-Z as a-z, digits as 0.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[48:58] = 48
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_FIELDS = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_lines", pa.int64()), ("n_failed_lines", pa.int64()), ("clean_text", pa.string())]
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, n_failed_lines long, clean_text string"


def has_licence(lowered: bytes) -> bool:
    return any(x in lowered for x in _LICENCE_KEYS) and _LICENCE.search(lowered) is not None


def is_menu(words: list[bytes]) -> bool:
    """Whether separators stand in most gaps between the other words."""
    if _SEPARATORS.isdisjoint(words):
        return False
    items = [i for i, w in enumerate(words) if w not in _SEPARATORS]
    parted = sum(b - a > 1 for a, b in zip(items, items[1:], strict=False))
    return parted >= MENU_GAPS and 2 * parted > len(items) - 1


def ends_sentence(line: bytes) -> bool:
    return _SENTENCE_END.search(line.rstrip()[-32:]) is not None


def line_digests(words: textnp.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, words, digest) of each line that has a word, case and digits folded."""
    if not len(words.starts):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(np.uint64)
    # Texts are joined by a line feed, so a new document is a new line.
    line = np.concatenate(([0], np.cumsum(words.raw == 10)))[words.starts]
    first = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
    stop = np.append(first[1:], len(line))
    doc = np.searchsorted(words.bounds, first, side="right") - 1
    return doc, stop - first, words.span_hashes(words.starts[first], words.ends[stop - 1], _FOLD)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, context) of each line that may be boilerplate; a context is the pair of its neighbours."""
    for batch in batches:
        for _, _, texts in textnp.chunks(batch, "text"):
            doc, size, digest = line_digests(textnp.Words(texts, lower=False))
            edge = doc[1:] != doc[:-1]
            before, after = np.zeros_like(digest), np.zeros_like(digest)
            before[1:], after[:-1] = np.where(edge, 0, digest[:-1]), np.where(edge, 0, digest[1:])
            context = textnp.mix(before * np.uint64(0x9E3779B97F4A7C15) + textnp.mix(after))
            able = (size >= BOILERPLATE_WORDS[0]) & (size <= BOILERPLATE_WORDS[1])
            yield pa.RecordBatch.from_arrays([pa.array(digest[able].view(np.int64)), pa.array(context[able].view(np.int64))], names=["digest", "context"])


def boilerplate(texts: DataFrame) -> np.ndarray:
    """Sorted digests of the lines that stand in many contexts; ``texts`` has one column, text."""
    least = max(MIN_CONTEXTS, -(-texts.count() // DOCS_A_CONTEXT))
    places = texts.mapInArrow(_places, "digest long, context long").distinct()
    found = places.groupBy("digest").agg(F.count("*").alias("contexts")).where(F.col("contexts") >= least).select("digest").toArrow()
    return np.sort(found["digest"].to_numpy().view(np.uint64))


def line_fails(line: bytes, n_words: int, n_symbols: int) -> bool:
    """The verdict on one line; lines without a word pass."""
    if not n_words:
        return False
    lowered = line.lower()
    if _BOILERPLATE.search(lowered) or has_licence(lowered) or n_symbols * 4 > n_words + 4 or is_menu(line.split()):
        return True
    return n_words >= HEADING_WORDS and not ends_sentence(line) or len(_SHOUT.findall(line)) * 2 > n_words > 3


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside a window of REPEAT_WINDOW words that the text holds twice or more."""
    windows = textnp.runs(hashes, REPEAT_WINDOW)
    if len(windows) < 2:
        return 0
    ordered = np.argsort(windows, kind="stable")
    same = np.diff(windows[ordered].view(np.int64)) == 0
    if not same.any():
        return 0
    twice = np.zeros(len(windows), dtype=bool)
    twice[ordered[1:][same]] = twice[ordered[:-1][same]] = True
    edge = np.zeros(len(hashes) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    edge[at] += 1
    edge[at + REPEAT_WINDOW] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def menu_lines(short: list[bool]) -> list[bool]:
    """Which lines stand in a run of at least MENU_LINES short ones."""
    out, at = [False] * len(short), 0
    while at < len(short):
        end = at
        while end < len(short) and short[end]:
            end += 1
        if end - at >= MENU_LINES:
            out[at:end] = [True] * (end - at)
        at = max(end, at + 1)
    return out


def _measurer(known: np.ndarray):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in textnp.chunks(batch, "text"):
                rows = _measured(texts, known)
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], *(pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS[1:], strict=True))], names=[n for n, _ in _FIELDS])

    return measure


def _measured(texts: list[bytes | None], known: np.ndarray) -> list[tuple]:
    words = textnp.Words(texts, lower=False)
    hashes, bounds, raw = words.hashes, words.bounds, words.raw
    # Code points inside words: bytes that are neither continuation bytes nor white space.
    points = np.concatenate(([0], np.cumsum(((raw & 0xC0) != 0x80) & ~textnp._SPACE[raw])))
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[raw])))
    of, _, digest = line_digests(words)
    common = _among(digest, known)
    lines_of = np.searchsorted(of, np.arange(len(texts) + 1))
    rows: list[tuple] = []
    for i, text in enumerate(texts):
        lo, hi = bounds[i], bounds[i + 1]
        begin, end = words.doc_starts[i], words.doc_starts[i] + len(text or b"")
        n = int(hi - lo)
        chars = int(points[end] - points[begin])
        repeat = repeated_words(hashes[lo:hi])
        base = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
        if text is None:
            rows.append((n, chars, 0, 0, repeat, base, False, 0, 0, None))
            continue
        lines = text.split(b"\n")
        at = np.concatenate(([begin], begin + np.cumsum([len(x) + 1 for x in lines]))).astype(np.int64)
        counts = np.diff(np.searchsorted(words.starts[lo:hi], at))
        filled = [j for j in range(len(lines)) if counts[j]]
        menus = menu_lines([counts[j] <= SHORT_WORDS and not ends_sentence(lines[j]) for j in filled])
        seen: set[bytes] = set()
        gone: set[int] = set()
        dup = lost = 0
        for j, menu, boiler in zip(filled, menus, common[lines_of[i] : lines_of[i + 1]], strict=True):
            line, stop = lines[j], at[j] + len(lines[j])
            dup += line in seen
            seen.add(line)
            if menu or boiler or line_fails(line, int(counts[j]), int(symbols[stop] - symbols[at[j]])):
                gone.add(j)
                lost += int(points[stop] - points[at[j]])
        clean = b"\n".join(x for j, x in enumerate(lines) if j not in gone) if gone else text
        rows.append((n, chars, int(symbols[end] - symbols[begin]), dup, repeat, base, not base and lost <= MAX_LOST * chars, len(lines), len(gone), clean.decode("utf-8", "replace")))
    return rows


def clean_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The measures, the verdict and the cleaned text of each row of ``docs``.

    Null text: all counts 0, base_failed, not kept, null clean text.  An empty
    text has one line without a word; lines without a word pass.  Texts of any
    length are read whole, in linear time.  Repeated rows give repeated rows; null
    ids stay null; there are no ties.  Other columns are not looked at, whatever
    their names; an empty table gives no rows.
    """
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return picked.mapInArrow(_measurer(boilerplate(picked.select("text"))), SCHEMA)
