"""Chat formatting: a finite-state machine over roles and a declarative template.

``format_conversations`` turns rows (conv_id, turn, role, text) into text
segments with a loss flag each.  Conversations are dealt out by conv_id and
sorted by turn inside their partition, and rows stream through the machine
one at a time, so a conversation of any length needs the memory of one turn.

Defined results: null text or role is empty; turns sort by (turn, role, text)
with nulls first, so ties and repeated rows are turns of their own in that
order; null conv_id is one conversation; an order of roles that the machine
does not allow is still formatted, and its state becomes "error" from the
offending turn on; an empty table gives no rows; other columns are ignored.

Escaping: in a text every ``<``, any backslashes, ``|`` gets one backslash
more before the bar, so no text holds the control prefix ``<|`` and removing
one backslash restores it.  Roles also escape the newline that ends a header.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import by_value

by_value(__name__)

CHATML = {
    "start": "start",
    "moves": {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user",
    },
    "accept": ["assistant"],
    # (kind, pattern): control pieces carry {role}, the text piece is the turn's text
    "turn": [("control", "<|im_start|>{role}\n"), ("text", None), ("control", "<|im_end|>\n")],
    "loss_roles": ["assistant"],
    # how a formatted turn is read back
    "parse": r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n",
    "turn_end": "<|im_end|>\n",
}

SEGMENTS = "conv_id long, turn long, turn_no long, segment int, kind string, text string, loss boolean, state string"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, valid_order boolean")

_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4000, chars: int = 8_000_000):
    """Arrow batches of bounded row count and text."""
    cols, weight = [], 0
    for row in rows:
        cols.append(row)
        weight += sum(len(v) for v in row if isinstance(v, str))
        if len(cols) >= size or weight >= chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*cols), schema)], schema=schema)
            cols, weight = [], 0
    if cols:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*cols), schema)], schema=schema)


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(col.to_pylist() for col in batch.columns))


def format_conversations(conversations: DataFrame, template: dict = CHATML) -> DataFrame:
    """Segments in order: (conv_id, turn, turn_no, segment, kind, text, loss, state).

    ``state`` is the machine's state after the turn.  A partition holds whole
    conversations, each contiguous and in order, and keeps them so.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("turn_no", pa.int64()), ("segment", pa.int32()),
                        ("kind", pa.string()), ("text", pa.string()), ("loss", pa.bool_()), ("state", pa.string())])

    def run(batches):
        def rows():
            here, state, turn_no, begun = None, None, 0, False
            for conv_id, turn, role, text in _tuples(batches):
                if not begun or conv_id != here:
                    here, state, turn_no, begun = conv_id, template["start"], 0, True
                role, text = role or "", text or ""
                state = template["moves"].get((state, role), "error")
                for k, (kind, pattern) in enumerate(template["turn"]):
                    body = escape(text) if kind == "text" else pattern.replace("{role}", escape_role(role))
                    yield (conv_id, turn, turn_no, k, kind, body, kind == "text" and role in template["loss_roles"], state)
                turn_no += 1
        yield from _batches(rows(), schema)

    dealt = (conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
             .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    return dealt.mapInArrow(run, SEGMENTS)


def digest_conversations(segments: DataFrame, template: dict = CHATML) -> DataFrame:
    """Per conversation, read back from the formatted output: turns are parsed
    out of the joined segment texts, the loss text is what the mask covers.
    ``segments`` must come straight from format_conversations (same order)."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("valid_order", pa.bool_())])

    def run(batches):
        turn_of = re.compile(template["parse"], re.S)

        def rows():
            here, open_, buf = None, False, []
            for conv_id, body, loss, state in _tuples(batches):
                if open_ and conv_id != here:
                    yield (here, n, turns.hexdigest(), loss_chars, lost.hexdigest(), chars, last in template["accept"])
                    open_ = False
                if not open_:
                    here, open_, buf, n, loss_chars, chars = conv_id, True, [], 0, 0, 0
                    turns, lost = hashlib.sha256(), hashlib.sha256()
                last = state
                chars += len(body)
                buf.append(body)
                if loss:
                    plain = unescape(body)
                    loss_chars += len(plain)
                    lost.update(plain.encode())
                if template["turn_end"] in body:
                    joined, end = "".join(buf), 0
                    for m in turn_of.finditer(joined):
                        turns.update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
                        n, end = n + 1, m.end()
                    buf = [joined[end:]]
            if open_:
                yield (here, n, turns.hexdigest(), loss_chars, lost.hexdigest(), chars, last in template["accept"])
        yield from _batches(rows(), schema)

    return segments.select("conv_id", "text", "loss", "state").mapInArrow(run, DIGEST)
