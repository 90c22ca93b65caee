"""Chat transcripts from event logs.

A log is split by conversation and sorted by sequence number; events fold into
messages, and messages are rendered with the template below.  Event kinds:

* ``message``: a whole message of ``role``;
* ``delta``: a streamed piece, appended to the last message if that has the same
  role and was streamed or begun by a delta, else the start of a message;
* ``edit``: replaces the text of message number ``target``, and drops all later
  messages, which answered the old text;
* ``regenerate``: drops the last message if it is the assistant's; what follows replaces it.

Everything streams: tasks get their conversations sorted (Spark's sort spills),
the fold holds the last message alone unless a log has edits or regenerations, and
texts are escaped and read back in blocks of ``BLOCK`` characters by one reader,
which sees the joined output of a conversation across all turn borders.

Template: ``<s>`` opens a conversation, then each turn is
``[INST] <<ROLE>> text [/INST]`` with the role escaped like the text, or
``[OUT] text </s>`` for an assistant's turn.  Inside a text every backslash
becomes ``\\\\`` and the first character of each control string gets a backslash
before it, so that no control string occurs inside a text and unescaping is exact.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
BEGIN, END = "<s>", "</s>"
ASK, ASK_END = "[INST]", "[/INST]"
ROLE, ROLE_END = "<<", ">>"
ANSWER = "[OUT]"
CONTROL = (BEGIN, END, ASK, ASK_END, ROLE, ROLE_END, ANSWER)
# End of the fixed values.

#: Characters that are escaped or read back at a time.
BLOCK = 1 << 18
_REACH = max(map(len, CONTROL)) - 1
#: A backslash, or the first character of a control string.
_ESCAPED = re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_GUARDED = re.compile(r"\\(.)", re.S)


def escaped(text: str) -> Iterator[str]:
    """The escaped text in blocks.  What a character becomes hangs on the ones after it alone."""
    sub = lambda x: _ESCAPED.sub(r"\\\g<0>", x)
    for at in range(0, len(text), BLOCK):
        end = at + BLOCK
        after = sub(text[end : end + _REACH])
        whole = sub(text[at : end + _REACH])
        yield whole[: len(whole) - len(after)]


def escape(text: str) -> str:
    return "".join(escaped(text))


def unescape(text: str) -> str:
    return _GUARDED.sub(r"\1", text)


def render_pieces(turns: Iterable[tuple[str, str]]) -> Iterator[str]:
    """The output in pieces of at most about BLOCK characters."""
    yield BEGIN
    for role, text in turns:
        if role == "assistant":
            yield f"{ANSWER} "
            yield from escaped(text)
            yield f" {END}"
        else:
            yield f"{ASK} {ROLE}{escape(role)}{ROLE_END} "
            yield from escaped(text)
            yield f" {ASK_END}"


def render(turns: Iterable[tuple[str, str]]) -> str:
    return "".join(render_pieces(turns))


class Reader:
    """Reads an output back piece by piece, with nothing but the characters that may still belong together in memory.

    ``feed`` yields ("open", role, place), then ("text", part, None) for each part
    of the text, unescaped, and ("close", None, place) for each turn; places are
    those of the text's first character and of the one after its last.  No control
    string stands in an escaped text, so its end is the first one after a blank.
    """

    def __init__(self) -> None:
        self.rest, self.place, self.state = "", 0, "begin"

    def _take(self, n: int) -> str:
        taken, self.rest = self.rest[:n], self.rest[n:]
        self.place += n
        return taken

    def _opened(self) -> str | None:
        """The role of the turn that begins here, or None if too little is known of it yet."""
        if self.rest.startswith(ANSWER + " "):
            self._take(len(ANSWER) + 1)
            return "assistant"
        head = f"{ASK} {ROLE}"
        if not self.rest.startswith(head):
            if any(x.startswith(self.rest) for x in (head, ANSWER + " ")):
                return None
            raise ValueError(f"no turn at {self.place}")
        at = self.rest.find(ROLE_END + " ", len(head))
        while at >= 0 and (at - len(self.rest[:at].rstrip("\\"))) % 2:
            at = self.rest.find(ROLE_END + " ", at + 1)
        if at < 0:
            return None
        return unescape(self._take(at + len(ROLE_END) + 1)[len(head) : at])

    def feed(self, piece: str) -> Iterator[tuple[str, str | None, int | None]]:
        self.rest += piece
        while self.rest:
            if self.state == "begin":
                if not self.rest.startswith(BEGIN):
                    if BEGIN.startswith(self.rest):
                        return
                    raise ValueError("a conversation has to begin with " + BEGIN)
                self._take(len(BEGIN))
                self.state = "between"
            elif self.state == "between":
                role = self._opened()
                if role is None:
                    return
                self.state = f" {END if role == 'assistant' else ASK_END}"
                yield "open", role, self.place
            else:
                at = self.rest.find(self.state)
                known = at if at >= 0 else max(0, len(self.rest) - len(self.state) + 1)
                # A backslash and what it guards stay together.
                if at < 0 and (known - len(self.rest[:known].rstrip("\\"))) % 2:
                    known -= 1
                if known:
                    yield "text", unescape(self._take(known)), None
                if at < 0:
                    return
                yield "close", None, self.place
                self._take(len(self.state))
                self.state = "between"

    def end(self) -> None:
        if self.rest or self.state != "between":
            raise ValueError(f"the output ends inside a turn at {self.place}")


def read_back(formatted: str) -> Iterator[tuple[str, str, tuple[int, int] | None]]:
    """(role, text, span of the loss mask in ``formatted`` or None) of each turn."""
    reader, parts, role, begin = Reader(), [], "", 0
    for at in range(0, max(1, len(formatted)), BLOCK):
        for kind, value, place in reader.feed(formatted[at : at + BLOCK]):
            if kind == "open":
                parts, role, begin = [], value, place
            elif kind == "text":
                parts.append(value)
            else:
                yield role, "".join(parts), (begin, place) if role == "assistant" else None
    reader.end()


def fold(events: Iterable[tuple[str, str | None, str | None, int | None]], settled: bool = False) -> Iterator[tuple[str, str]]:
    """Final (role, text) messages of (kind, role, text, target) events in order.

    A ``settled`` log has messages and deltas alone, so that all messages but the
    last are final and leave at once.  Null role: ``user``.  Null text: empty.
    Unknown kinds, edits of messages that do not exist, and changes in a settled
    log are errors.
    """
    messages: list[tuple[str, list[str], bool]] = []
    for kind, role, text, target in events:
        role, text = role or "user", text or ""
        if kind == "message":
            messages.append((role, [text], False))
        elif kind == "delta":
            if messages and messages[-1][2] and messages[-1][0] == role:
                messages[-1][1].append(text)
            else:
                messages.append((role, [text], True))
        elif settled:
            raise ValueError(f"{kind} in a settled log")
        elif kind == "edit":
            if target is None or not 0 <= target < len(messages):
                raise ValueError(f"no message {target} to edit")
            del messages[target + 1 :]
            messages[target] = (messages[target][0], [text], False)
        elif kind == "regenerate":
            if messages and messages[-1][0] == "assistant":
                messages.pop()
        else:
            raise ValueError(f"unknown event {kind}")
        if settled and len(messages) > 1:
            done = messages.pop(0)
            yield done[0], "".join(done[1])
    for role, parts, _ in messages:
        yield role, "".join(parts)


class _Digest:
    """What is read back from one conversation's output, piece by piece."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n, self.loss, self.chars, self.masks = conv_id, 0, 0, 0, False
        self.turns, self.masked, self.reader = hashlib.sha256(), hashlib.sha256(), Reader()

    def add(self, piece: str) -> None:
        self.chars += len(piece)
        for kind, value, _ in self.reader.feed(piece):
            if kind == "close":
                self.turns.update(b"\n")
                continue
            raw = value.encode("utf-8", "surrogatepass")
            if kind == "open":
                self.n, self.masks = self.n + 1, value == "assistant"
                self.turns.update(raw + b"\n")
            else:
                self.turns.update(raw)
                if self.masks:
                    self.loss += len(value)
                    self.masked.update(raw)

    def row(self) -> tuple:
        self.reader.end()
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss, self.masked.hexdigest(), self.chars


_SCHEMA = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
_TEXT_SCHEMA = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss_spans", pa.list_(pa.list_(pa.int64())))])


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple[str, str]]]]:
    """(conv_id, its messages) of a sorted partition; messages have to be used up in turn."""
    rows = _events(batches)
    row = next(rows, None)
    while row is not None:
        conv, settled = row[:2]

        def own() -> Iterator[tuple]:
            nonlocal row
            while row is not None and row[0] == conv:
                event, row = row[2:], None
                yield event
                row = next(rows, None)

        yield conv, fold(own(), settled)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for conv, messages in _conversations(batches):
        digest = _Digest(conv)
        for piece in render_pieces(messages):
            digest.add(piece)
        rows.append(digest.row())
        if len(rows) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for conv, messages in _conversations(batches):
        reader, parts, spans, masks = Reader(), [], [], False
        for piece in render_pieces(messages):
            parts.append(piece)
            for kind, value, place in reader.feed(piece):
                if kind == "open":
                    masks = value == "assistant"
                    if masks:
                        spans.append([place, place])
                elif kind == "close" and masks:
                    spans[-1][1] = place
        reader.end()
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array(["".join(parts)]), pa.array([spans], _TEXT_SCHEMA.field(2).type)], schema=_TEXT_SCHEMA)


def _sorted_log(log: DataFrame) -> DataFrame:
    """Conversations whole and in order; ``settled`` says that a log has no edits and no regenerations."""
    columns = set(log.columns)
    optional = lambda name, default: F.col(name) if name in columns else default
    picked = log.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), optional("kind", F.lit("message")).alias("kind"), F.col("role"), F.col("text"), optional("target", F.lit(None)).cast("int").alias("target")
    )
    if "kind" in columns:
        changed = picked.where("kind NOT IN ('message', 'delta')").select(F.col("conv_id").alias("changed")).distinct()
        picked = picked.join(changed, F.col("conv_id").eqNullSafe(F.col("changed")), "left").withColumn("settled", F.col("changed").isNull())
    else:
        picked = picked.withColumn("settled", F.lit(True))
    n = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return picked.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "settled", "kind", "role", "text", "target")


def digests(log: DataFrame) -> DataFrame:
    """One row per conversation: what reading its formatted text back gives.

    ``log``: conv_id, turn, role, text, and kind and target where there are
    events other than messages.  Null kind is not allowed; null role: user; null
    text: empty; null turns come first; rows of a null conv_id are one
    conversation.  Ties in turn are ordered by role and text, and repeated rows
    are repeated turns.  A task holds one message at a time, however long; of
    logs with edits or regenerations it holds the conversation.  An empty log gives no
    rows; other columns are not looked at, whatever their names.
    """
    return _sorted_log(log).mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted(log: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): the training text, with the code point spans under the loss mask."""
    return _sorted_log(log).mapInArrow(_texts, "conv_id long, formatted string, loss_spans array<array<long>>")


def _sql_escaped(x: str) -> str:
    """DuckDB: the length of ``escape(x)``.  Doubled brackets overlap themselves, so a run of k holds k - 1."""
    once = " + ".join(f"(len({x}) - len(replace({x}, '{c}', ''))) // {len(c)}" for c in (BEGIN, END, ASK, ASK_END, ANSWER))
    runs = " + ".join(f"len({x}) - len(replace({x}, '{c}', '')) - len(regexp_extract_all({x}, '{c}+'))" for c in "<>")
    return f"(len({x}) + (len({x}) - len(replace({x}, '\\', ''))) + {once} + {runs})"


_SAME = f"{END}{ASK} ok {ASK_END}"
#: The conversation that holds nothing but control strings.
CONTROL_CONVERSATION = [(-7, 0, "user", _SAME), (-7, 1, "assistant", _SAME)]
ORACLE = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '{_SAME}'), (-7, 1, 'assistant', '{_SAME}')),
e AS (SELECT *, {_sql_escaped("text")} AS n_text, {_sql_escaped("role")} AS n_role FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST({len(BEGIN)} + sum(CASE WHEN role = 'assistant' THEN {len(ANSWER) + len(END) + 2} + n_text ELSE {len(ASK + ASK_END + ROLE + ROLE_END) + 3} + n_role + n_text END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
