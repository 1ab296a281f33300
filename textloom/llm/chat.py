"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events; the log is partitioned by conversation,
sorted by sequence and folded into final messages, which are rendered with a
template.  Events:

* ``message``: a whole message of a role; ``delta``: text that is streamed onto
  the message of the same key (or opens it); ``edit``: replaces that message's
  text; ``regenerate``: drops that message and all after it, and opens it anew
  with the event's text.

A message's key is ``message``; where that is null, the event is a message of its
own (for a delta: the last one).  Edits of messages that are not there open them.

The template marks turns as ``<|role|>\\n`` text ``<|end|>\\n``.  Inside a text,
every character that begins a control string, this template's or another known
one's, is followed by a backslash, and backslashes are doubled; taking the
backslashes out again restores the text, so that no text can forge a turn.  The
loss mask is the spans, in code points, of assistant texts.

A conversation streams through its task message by message: folding holds only
what can still change (nothing, for logs of whole messages), and a long rendering
is written in parts of bounded size.

Defined results: a null text is empty, a null role too; events of equal sequence
are in order of message, event, role and text; repeated rows are repeated
messages; a null conversation id is a conversation of its own; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

#: Control strings of public chat templates; none has a backslash.
CONTROL = [
    "<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>", "<bos>", "<eos>", "<unk>", "<pad>",
]
_CONTROL = re.compile(r"\\|(?=" + "|".join(map(re.escape, CONTROL)) + r")(.)", re.DOTALL)
_ESCAPED = re.compile(r"\\\\|\\")
END = "<|end|>\n"
#: Code points of a rendering's part.
PART = 1 << 20


def escape(text: str) -> str:
    """A doubled backslash for each, and one after every character that begins a control string."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    """No control string's second character is a backslash, so that a doubled one is always a backslash of the text."""
    return _ESCAPED.sub(lambda m: "\\" if m[0] == "\\\\" else "", text)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and where its escaped text is."""
    head = f"<|{escape(role)}|>\n"
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


class Fold:
    """Folds one conversation's events; ``add`` yields messages that nothing can change any more."""

    def __init__(self):
        self.open: list[list] = []  # key, role, text parts
        self.place: dict[str, int] = {}  # of the last open message of each key

    def add(self, event: str, message, role: str, text: str) -> Iterator[tuple[str, str]]:
        at = self.place.get(message) if message is not None else None
        if event == "delta":
            if message is None and self.open:
                at = len(self.open) - 1
            if at is not None:
                self.open[at][2].append(text)
                return
        elif event == "edit" and at is not None:
            self.open[at][2] = [text]
            return
        elif event == "regenerate" and at is not None:
            role = role or self.open[at][1]
            while len(self.open) > at:
                self._forget(self.open.pop(), len(self.open))
        elif event == "message" and message is None and not self.place:
            # no message before a whole one without a key can be named again
            yield from self.end()
        if message is not None:
            self.place[message] = len(self.open)
        self.open.append([message, role, [text]])

    def _forget(self, m: list, at: int) -> None:
        if m[0] is not None and self.place.get(m[0]) == at:
            del self.place[m[0]]
            # an earlier message of the same key, if there is one, takes its place again
            earlier = next((i for i in range(at - 1, -1, -1) if self.open[i][0] == m[0]), None)
            if earlier is not None:
                self.place[m[0]] = earlier

    def end(self) -> Iterator[tuple[str, str]]:
        for m in self.open:
            yield m[1], "".join(m[2])
        self.open = []


OUTPUT = "conv_id long, part long, formatted string, mask array<long>"


class _Parts:
    """Cuts a conversation's turns into parts of about PART code points, each with the mask spans inside it."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.reset(None)

    def reset(self, conv):
        self.conv, self.part, self.text, self.mask, self.size = conv, 0, [], [], 0

    def turn(self, role: str, text: str):
        body, a, b = render_turn(role, text)
        if role == "assistant":
            self.mask += [self.size + a, self.size + b]
        self.text.append(body)
        self.size += len(body)
        if self.size >= PART:
            self.flush()

    def flush(self):
        if self.text or not self.part:
            self.rows.append((self.conv, self.part, "".join(self.text), self.mask))
            self.part, self.text, self.mask, self.size = self.part + 1, [], [], 0


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("mask", pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(kinds)], names=[k for k, _ in kinds])


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, fold, conv, begun = _Parts(), Fold(), None, False
    for batch in batches:
        for c, event, message, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "event", "message", "role", "text"))):
            if not begun or c != conv:
                if begun:
                    for m in fold.end():
                        out.turn(*m)
                    out.flush()
                begun, conv = True, c
                out.reset(c)
            for m in fold.add(event, message, role or "", text or ""):
                out.turn(*m)
        if out.rows:
            yield _batch(out.rows)
            out.rows = []
    if begun:
        for m in fold.end():
            out.turn(*m)
        out.flush()
        yield _batch(out.rows)


def format_conversations(events: DataFrame) -> DataFrame:
    """Renders a log: conv_id, part, formatted, mask (starts and ends by turns, within the part).

    ``events`` needs conv_id, seq, event, message, role and text.
    """
    log = events.select(
        F.col("conv_id").cast("long").alias("conv_id"), "seq", F.col("event"), F.col("message").cast("string").alias("message"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    # equal sequences are told apart by hash where the texts are long; equal rows are interchangeable
    ordered = log.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "message", "event", "role", "text")
    return ordered.drop("seq").mapInArrow(_render, OUTPUT)


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of a rendering, or of a part of it."""
    at = 0
    while at < len(formatted):
        head = formatted.find("|>\n", at + 2) if formatted.startswith("<|", at) else -1
        end = formatted.find(END, head + 3) if head >= 0 else -1
        if end < 0:
            raise ValueError("not a rendering of this template")
        yield unescape(formatted[at + 2 : head]), unescape(formatted[head + 3 : end])
        at = end + len(END)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    conv, begun, n, chars, loss, turns, masked = None, False, 0, 0, 0, None, None

    def done():
        rows.append((conv, n, turns.hexdigest(), loss, masked.hexdigest(), chars))

    for batch in batches:
        for c, formatted, mask in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "formatted", "mask"))):
            if not begun or c != conv:
                if begun:
                    done()
                begun, conv, n, chars, loss, turns, masked = True, c, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            for role, text in parse_turns(formatted):
                n += 1
                turns.update(f"{role}\n{text}\n".encode())
            for a, b in zip(mask[::2], mask[1::2]):
                text = unescape(formatted[a:b])
                loss += len(text)
                masked.update(text.encode())
            chars += len(formatted)
    if begun:
        done()
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from its rendering."""
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part").drop("part")
    return ordered.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    events = rows.union(probe).select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("event"), F.lit(None).cast("string").alias("message"), "role", "text")
    scratch = Scratch(spark, "chat")
    return read_conversations(scratch.table(format_conversations(events), "formatted"))


def _escapes_sql(column: str) -> str:
    return " + ".join(f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}" for c in ["\\", *CONTROL])


#: A text grows by one character for each backslash and each place where a control string begins; none begins where another does.
OP6_SQL = f"""
WITH r AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), x AS (
  SELECT *, {_escapes_sql("text")} AS more_text, {_escapes_sql("role")} AS more_role FROM r
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + more_role + length(text) + more_text + {len("<||>") + 1 + len(END)}) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id
"""
