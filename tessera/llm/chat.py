"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string.
Nothing is known of it: the prefixes of a conversation are rendered one
after the other and consecutive outputs are compared.  Where an output
extends the one before, the new part is the span of the new turn; where it
does not, the template rewrites history, and the conversation is marked with
the first turn at which it did so.  Inside the span of a learnt turn the text
itself is located by rendering the same prefix with an empty text and with a
probe character: the place where these two part is where the text begins, and
what follows that place in the empty rendering ends the span.

The prefixes are those of the whole conversation: a template may look back, or
rewrite, as far as it likes, so the cost grows with the square of the turns and a
conversation has to fit its task.  Only for a template that is declared
``turn_local`` (an output is the header, ``template([])``, and one part per turn
that depends on that turn alone, like ``render``'s) is a conversation rendered in
segments of at most ``segment_turns`` turns, so that the cost and the memory per
row stay bounded however long it is; the header stays in the first segment only,
and the segments' outputs, concatenated, are the whole one.  Rows are shuffled
once by conversation and sorted, and Python streams through them.

Defined results: null text and null role are empty; a null conv_id is one
conversation of its own; turns go by turn, then role and text, null first;
repeated rows are turns of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = list[tuple[str, str]]
PROBE = "\ue000"

# The default template.  Marks begin with "<" or "["; in texts and roles a
# backslash is put after each of these two, so no control string of this or
# another common template can occur there, and taking it out again is exact.
TURN, BODY, END = "<|turn|>", "<|text|>", "</s>\n"


def escape(text: str) -> str:
    return text.replace("<", "<\\").replace("[", "[\\")


def unescape(text: str) -> str:
    return text.replace("<\\", "<").replace("[\\", "[")


def render(turns: Turns) -> str:
    return "".join(f"{TURN}{escape(role)}{BODY}{escape(text)}{END}" for role, text in turns)


def read_back(formatted: str) -> Turns:
    """The turns of a string that ``render`` made."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        role, _, text = part.partition(BODY)
        turns.append((unescape(role), unescape(text[:-len(END)])))
    return turns


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    if b.startswith(a):
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


def turn_spans(turns: Turns, template: Callable[[Turns], str], learnt: str = "assistant"):
    """(formatted, spans, masks, rewritten): per turn its span, the spans of learnt
    texts, and the first turn whose prefix did not extend the one before (or -1)."""
    out, spans, masks, rewritten = template([]), [], [], -1
    for k, (role, text) in enumerate(turns):
        now = template(turns[:k + 1])
        start = _common(out, now)
        if start < len(out) and rewritten < 0:
            rewritten = k
        spans.append((start, len(now)))
        if role == learnt:
            empty = template([*turns[:k], (role, "")])
            begin = _common(empty, template([*turns[:k], (role, PROBE)]))
            masks.append((begin, len(now) - (len(empty) - begin)))
        out = now
    return out, spans, masks, rewritten


SEGMENT = pa.schema([("conv_id", pa.int64()), ("segment", pa.int32()), ("formatted", pa.string()),
                     ("spans", pa.list_(pa.list_(pa.int64()))), ("masks", pa.list_(pa.list_(pa.int64()))),
                     ("rewritten", pa.int64())])


def _format(template: Callable[[Turns], str], learnt: str, segment_turns: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, current, segment, turns = [], None, 0, []

        def close() -> None:
            out, spans, masks, rewritten = turn_spans(turns, template, learnt)
            if segment_turns and rewritten >= 0:
                raise ValueError("the template is declared turn-local and rewrites history")
            header = len(template([])) if segment else 0
            rows.append({"conv_id": current[0], "segment": segment, "formatted": out[header:],
                         "spans": [[a - header, b - header] for a, b in spans],
                         "masks": [[a - header, b - header] for a, b in masks], "rewritten": rewritten})

        for batch in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if turns and (current[0] != conv or len(turns) == segment_turns):
                    close()
                    segment = segment + 1 if current[0] == conv else 0
                    turns = []
                elif not turns:
                    segment = 0
                current = (conv,)
                turns.append((role, text))
            if len(rows) >= 64:
                yield pa.RecordBatch.from_pylist(rows, SEGMENT)
                rows = []
        if turns:
            close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, SEGMENT)
    return run


def format_conversations(conversations: DataFrame, template: Callable[[Turns], str] = render,
                         learnt: str = "assistant", segment_turns: int = 128,
                         turn_local: bool | None = None) -> DataFrame:
    """(conv_id, segment, formatted, spans, masks, rewritten), a conversation's segments
    in order within one partition.  Spans count code points within the segment's string.
    Without ``turn_local``, whose default is true for ``render`` only, a conversation is
    one segment."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                                F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    cut = segment_turns if (template is render if turn_local is None else turn_local) else None
    return ordered.select("conv_id", "role", "text").mapInArrow(
        _format(template, learnt, cut),
        "conv_id long, segment int, formatted string, spans array<array<long>>, masks array<array<long>>, rewritten long")


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                    ("rewrites_history", pa.bool_())])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, now = [], None
    for batch in batches:
        for conv, segment, formatted, masks, rewritten in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "segment", "formatted", "masks", "rewritten"))):
            if segment == 0:
                if now:
                    rows.append(now)
                now = {"conv_id": conv, "n_turns": 0, "turns_sha256": hashlib.sha256(), "loss_chars": 0,
                       "loss_sha256": hashlib.sha256(), "formatted_chars": 0, "rewrites_history": False}
            for role, text in read_back(formatted):
                now["n_turns"] += 1
                now["turns_sha256"].update(f"{role}\n{text}\n".encode())
            for a, b in masks:
                learnt = unescape(formatted[a:b])
                now["loss_chars"] += len(learnt)
                now["loss_sha256"].update(learnt.encode())
            now["formatted_chars"] += len(formatted)
            now["rewrites_history"] |= rewritten >= 0
        if len(rows) >= 4096:
            yield _closed(rows)
            rows = []
    if now:
        yield _closed([*rows, now])


def _closed(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        [r | {k: r[k].hexdigest() for k in ("turns_sha256", "loss_sha256")} for r in rows], DIGEST)


def digest(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from the segments of ``format_conversations``
    (with the default template) in their partitions' order."""
    return formatted.mapInArrow(
        _digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                 "formatted_chars long, rewrites_history boolean")
