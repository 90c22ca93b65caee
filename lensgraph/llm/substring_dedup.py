"""Removal of repeated passages by hashing lines and the sentences inside them.

Units are lines, cut after sentences (``.!?``), as quoted passages often stand
inside a line.  A unit alone proves nothing, as short lines and sentences repeat
by chance; what is hashed is a *run* of consecutive units of at least
``RUN_WORDS`` words: from each unit on to the first unit end that far away, and
back from each unit's end to the last unit start that far away, so that every
repeated run has a digest that ends where it ends.  A text of fewer words is one
run.  Digests are 96 bits of the normalised words: A-Z lower-cased, white space
collapsed.

Occurrences rank by document id, text hash and offset.  The earliest of each
digest stays; in all others the units of the run go, with their offsets in the
original text kept.  Every unit that goes stands in an earlier run, so one copy
of it is left somewhere.

Digests are grouped with a map-side minimum and count, and only digests found
more than once are joined back to their occurrences.  The few digests that make
up more than one in ``HOT`` occurrences each are joined by broadcast, so no task
gets all copies of a passage that a third of all documents share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lensgraph.llm import textnp
from lensgraph.llm.session import cut, join_with_hot

RUN_WORDS = 20
#: Rows that are rewritten at a time.
CLEANED_ROWS = 512
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?"]] = True
_ODD = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_FOUND = "doc_id long, th int, begin int, end int, d1 long, d2 int"


def run_digests(hashes: np.ndarray, first: np.ndarray, stop: np.ndarray, odd: int) -> np.ndarray:
    """A hash of the words first:stop of each run, the same wherever the run lies."""
    n = len(hashes)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * textnp._power_table(odd, n)[:n], out=sums[1:])
    inverse = textnp._power_table(pow(odd, -1, 1 << 64), n + 1)
    return textnp.mix((sums[stop] - sums[first]) * inverse[first] + (stop - first).astype(np.uint64))


def unit_starts(words: textnp.Words) -> np.ndarray:
    """The words that open a unit: after a line feed (texts are joined by one) or after the end of a sentence."""
    raw, starts, ends = words.raw, words.starts, words.ends
    feeds = np.concatenate(([0], np.cumsum(raw == 10)))
    opens = np.ones(len(starts), dtype=bool)
    opens[1:] = (feeds[starts[1:]] > feeds[ends[:-1]]) | _STOP[raw[ends[:-1] - 1]]
    return np.flatnonzero(opens)


def runs(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first byte, last byte + 1, digest, second digest) of each run; bytes count within the run's own text."""
    words = textnp.Words(texts)
    if not len(words.starts):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    first = unit_starts(words)
    stops = np.append(first[1:], len(words.starts))
    doc = np.searchsorted(words.bounds, first, side="right") - 1
    low, high = words.bounds[doc], words.bounds[doc + 1]
    short = high - low < RUN_WORDS
    ahead = stops[np.minimum(np.searchsorted(stops, first + RUN_WORDS), len(stops) - 1)]
    behind = first[np.maximum(np.searchsorted(first, stops - RUN_WORDS, side="right") - 1, 0)]
    fits, begins = (ahead <= high) & (ahead - first >= RUN_WORDS), (behind >= low) & (stops - behind >= RUN_WORDS)
    pairs = np.concatenate((np.stack((first[fits], ahead[fits])), np.stack((behind[begins], stops[begins])), np.stack((low[short], high[short]))), axis=1)
    a, b = np.unique(pairs, axis=1)
    doc = np.searchsorted(words.bounds, a, side="right") - 1
    offset = words.doc_starts[doc]
    hashes = words.hashes
    d1, d2 = (run_digests(hashes, a, b, odd) for odd in _ODD)
    return doc, words.starts[a] - offset, words.ends[b - 1] - offset, d1, d2


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, _, texts in textnp.chunks(batch, "text"):
            doc, begin, end, d1, d2 = runs(texts)
            rows = pa.array(doc + first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(d1.view(np.int64)), pa.array((d2 >> np.uint64(32)).astype(np.uint32).view(np.int32))],
                names=["doc_id", "th", "begin", "end", "d1", "d2"],
            )


def rewrite(text: bytes, spans: list[tuple[int, int]]) -> tuple[str, list[list[int]], int]:
    """(text without the spans, removed spans in code points, words removed) for byte spans in any order."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and text[merged[-1][1] : a].strip() == b"":
            merged[-1][1] = max(merged[-1][1], b)
        elif merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    parts, at, gone = [], 0, 0
    for a, b in merged:
        parts.append(text[at:a])
        gone += len(text[a:b].split())
        # What parted the span from the next unit goes too, unless it ends a line that keeps something.
        line_empty = a == 0 or text[a - 1 : a] == b"\n"
        if text[b : b + 1] == b" " or line_empty and text[b : b + 1] == b"\n":
            b += 1
        at = b
    parts.append(text[at:])
    return b"".join(parts).decode("utf-8", "replace"), [[int(points[a]), int(points[b])] for a, b in merged], gone


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(at, CLEANED_ROWS) for b in batches for at in range(0, b.num_rows, CLEANED_ROWS)):
        ids, spans = batch.column(0), batch.column(2).to_pylist()
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        out: list[tuple] = []
        for text, own in zip(texts, spans, strict=True):
            if text is None or not own:
                out.append((0, [], None if text is None else text.decode("utf-8", "replace")))
            else:
                clean, removed, gone = rewrite(text, [(s["begin"], s["end"]) for s in own])
                out.append((gone, removed, clean))
        gone, removed, clean = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([len(t.split()) if t else 0 for t in texts], pa.int64()), pa.array(gone, pa.int64()), pa.array(removed, pa.list_(pa.list_(pa.int64()))), pa.array(clean, pa.string())],
            names=["doc_id", "n_words", "n_removed_words", "removed_spans", "clean_text"],
        )


def substring_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed_words, removed_spans, clean_text) for each row of ``docs``.

    Spans are [first, last + 1] in code points of the original text.  Null text
    stays null, and texts without a word stay as they are; neither loses anything.
    Texts of any length are hashed whole, in time and memory in proportion to the
    longest one.  A null id ranks first; rows that share an id rank by the hash
    of their text; rows that repeat id and text are one occurrence, so all of them
    lose what one of them loses, and no other ties exist.  Other columns are not
    looked at, whatever their names; an empty table gives no rows.
    """
    base = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.hash(text_column).alias("th"), F.col(text_column).alias("text"))
    found = base.select("doc_id", "th", "text").mapInArrow(_find, _FOUND)
    rank = F.struct("doc_id", "th", "begin")
    repeated = cut(found.groupBy("d1", "d2").agg(F.count("*").alias("m"), F.min(rank).alias("keep")).where("m > 1"))
    gone = join_with_hot(found, repeated, ["d1", "d2"], "m").where(~rank.eqNullSafe(F.col("keep"))).groupBy("doc_id", "th").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    return (
        base.alias("d")
        .join(gone.alias("g"), F.expr("d.doc_id <=> g.doc_id AND d.th = g.th"), "left")
        .select("d.doc_id", "d.text", "g.spans")
        .mapInArrow(_clean, "doc_id long, n_words long, n_removed_words long, removed_spans array<array<long>>, clean_text string")
    )


#: DuckDB SQL for op1.  t: words with the white space before them; u: units; r: runs; c: the words that go; s: spans.
ORACLE = rf"""
WITH d AS (SELECT doc_id, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents),
w AS (SELECT doc_id, coalesce(regexp_extract_all(lowered, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+'), []) AS parts FROM d),
t AS (SELECT doc_id, i, part, regexp_extract(part, '[^\x20\x09-\x0D]+') AS word, sum(len(part)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM (SELECT doc_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i FROM w)),
o AS (SELECT *, CASE WHEN i = 1 OR contains(part[:len(part) - len(word)], chr(10)) OR right(lag(word) OVER (PARTITION BY doc_id ORDER BY i), 1) IN ('.', '!', '?') THEN 1 ELSE 0 END AS opens FROM t),
u AS (SELECT doc_id, min(i) AS a, max(i) AS b FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS unit FROM o) GROUP BY doc_id, unit),
n AS (SELECT doc_id, count(*) AS n, list(word ORDER BY i) AS words FROM t GROUP BY doc_id),
x AS (SELECT p.doc_id, p.a, min(q.b) AS b FROM u p JOIN u q ON p.doc_id = q.doc_id AND q.b - p.a + 1 >= {RUN_WORDS} GROUP BY p.doc_id, p.a
      UNION SELECT p.doc_id, max(q.a), p.b FROM u p JOIN u q ON p.doc_id = q.doc_id AND p.b - q.a + 1 >= {RUN_WORDS} GROUP BY p.doc_id, p.b
      UNION SELECT doc_id, 1, n FROM n WHERE n < {RUN_WORDS}),
r AS (SELECT x.doc_id, a, b, array_to_string(list_slice(words, a, b), ' ') AS content FROM x JOIN n ON x.doc_id = n.doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, a) AS place FROM r) WHERE place > 1),
s AS (SELECT doc_id, count(*) AS n_gone, min(stop - len(word)) AS a, max(stop) AS b FROM (SELECT c.doc_id, c.i, stop, word, c.i - row_number() OVER (PARTITION BY c.doc_id ORDER BY c.i) AS run FROM c JOIN t ON c.doc_id = t.doc_id AND c.i = t.i) GROUP BY doc_id, run),
z AS (SELECT s.doc_id, n_gone, a, b, b + CASE WHEN substr(text, b::BIGINT + 1, 1) = ' ' OR (a = 0 OR substr(text, a::BIGINT, 1) = chr(10)) AND substr(text, b::BIGINT + 1, 1) = chr(10) THEN 1 ELSE 0 END AS upto FROM s JOIN d ON d.doc_id = s.doc_id),
k AS (SELECT doc_id, sum(n_gone)::BIGINT AS n_gone, list([a::BIGINT, b::BIGINT] ORDER BY a) AS spans, list(a::BIGINT ORDER BY a) AS starts, list(upto::BIGINT ORDER BY a) AS ends FROM z GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(n_gone, 0)::BIGINT AS n_removed_words, coalesce(spans, []) AS removed_spans,
       CASE WHEN spans IS NULL THEN text ELSE array_to_string(list_transform(range(1, len(starts) + 2), lambda j: substr(text, CASE WHEN j = 1 THEN 1 ELSE ends[j - 1] + 1 END, CASE WHEN j > len(starts) THEN len(text) ELSE starts[j] - CASE WHEN j = 1 THEN 0 ELSE ends[j - 1] END END)), '') END AS clean_text
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
"""
