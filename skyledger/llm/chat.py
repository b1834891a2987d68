"""Chat formatting with loss masks by aligned offsets.

A conversation is rendered whole; each turn is ``<|turn|>role<|text|>text<|end|>``
and the spans of the assistants' texts are noted on the way. The rendered text is
encoded once, with offsets. The turn marks are special tokens, so no token crosses
one. Token spans and turn spans are both sorted: for each turn the tokens it
covers are found by binary search, and these tokens carry the loss.

Control strings inside roles and texts get a backslash after their first
character (one more if they have some already), which unescaping takes away;
so they never become special tokens, and every text comes back as it was.

Rows are ordered by turn (nulls first), then role and text, so repeated rows stay
and have a defined order. A null text or role is empty. A null conv_id is a
conversation of its own. A conversation is one document and is built in one task,
the rows of a partition stream by in order, and what is written is built for a group
of conversations of ``GROUP`` characters (one at least, however long). An empty table
gives no rows; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.common import shuffle_partitions

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED = "assistant"
GROUP = 1 << 20
#: What counts as a control string: own marks and those of common templates.
_ESCAPE = re.compile(r"(<\\*)(?=\||/?s>|<\\*/?SYS>>)|(\[\\*)(?=/?INST\])")
_UNESCAPE = re.compile(r"(<)\\(\\*)(?=\||/?s>|<\\*/?SYS>>)|(\[)\\(\\*)(?=/?INST\])")

FORMATTED = "conv_id long, text string, ids array<int>, loss array<boolean>, starts array<long>, stops array<long>"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: (m[1] or m[2]) + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: (m[1] or m[3]) + (m[2] or m[4] or ""), text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The whole conversation, and the spans of the texts to learn."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == LEARNED and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(text: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    turns = []
    for part in text.split(TURN)[1:]:
        role, _, body = part.partition(TEXT)
        turns.append((unescape(role), unescape(body.removesuffix(END))))
    return turns


def loss_mask(starts: np.ndarray, stops: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in a span; both are sorted."""
    mask = np.zeros(len(starts), dtype=bool)
    for lo, hi in spans:
        mask[np.searchsorted(stops, lo, side="right"):np.searchsorted(starts, hi, side="left")] = True
    return mask


@lru_cache(maxsize=1)
def _tokenizer(spec: str):
    from tokenizers import AddedToken, Tokenizer, processors

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.add_special_tokens([AddedToken(t, normalized=False, special=True) for t in (TURN, TEXT, END)])
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    return tokenizer


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple[str, str]]]]:
    """Runs of rows of one conversation."""
    now, turns = None, []
    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if turns and conv != now:
                yield now, turns
                turns = []
            now = conv
            turns.append((role, text))
    if turns:
        yield now, turns


def _encoded(tokenizer, convs: list, texts: list[str], spans: list) -> pa.RecordBatch:
    """One row per text: its tokens, their mask and offsets, each as one flat array cut by row."""
    ids, masks, starts, stops, cuts = [], [], [], [], [0]
    for text, span in zip(texts, spans):
        found = tokenizer.encode(text, add_special_tokens=False)
        ids.append(np.array(found.ids, dtype=np.int32))
        offsets = np.fromiter(chain.from_iterable(found.offsets), dtype=np.int64).reshape(-1, 2)
        starts.append(offsets[:, 0])
        stops.append(offsets[:, 1])
        masks.append(loss_mask(starts[-1], stops[-1], span))
        cuts.append(cuts[-1] + len(offsets))
    lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(x))) for x in (ids, masks, starts, stops)]
    return pa.RecordBatch.from_arrays(
        [pa.array(convs, pa.int64()), pa.array(texts, pa.string()), *lists], ["conv_id", "text", "ids", "loss", "starts", "stops"])


def _runs(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Sorted token spans put together where they touch or overlap."""
    if not len(starts):
        return []
    reached = np.maximum.accumulate(stops)
    new = np.flatnonzero(starts[1:] > reached[:-1]) + 1
    return list(zip(starts[np.append(0, new)].tolist(), reached[np.append(new - 1, -1)].tolist()))


def format_chats(rows: DataFrame, path: str) -> DataFrame:
    """One row per conversation: ``conv_id``, the rendered ``text``, token ``ids``, their ``loss`` mask and their offsets (``starts``, ``stops``)."""
    with open(path, encoding="utf-8") as file:
        spec = rows.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(spec.value)

        texts, spans, convs, size = [], [], [], 0
        for conv, turns in _conversations(batches):
            text, span = render(turns)
            texts.append(text)
            spans.append(span)
            convs.append(conv)
            size += len(text)
            if size >= GROUP:
                yield _encoded(tokenizer, convs, texts, spans)
                texts, spans, convs, size = [], [], [], 0
        if convs:
            yield _encoded(tokenizer, convs, texts, spans)

    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    flat = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", empty("role"), empty("text"))
    dealt = flat.repartition(shuffle_partitions(rows.sparkSession), "conv_id")
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``turns`` (role, text), ``learned`` (all text under the mask, unescaped) and ``formatted_chars``."""
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, learned, chars = [], [], []
            loss, starts, stops = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("loss", "starts", "stops"))
            cuts = np.append(0, np.cumsum(pc.list_value_length(batch.column("loss")).to_numpy(zero_copy_only=False)))
            for text, a, b in zip(batch.column("text").to_pylist(), cuts, cuts[1:]):
                turns.append([{"role": r, "text": t} for r, t in parse(text)])
                chars.append(len(text))
                on = loss[a:b]
                learned.append("".join(unescape(text[lo:hi]) for lo, hi in _runs(starts[a:b][on], stops[a:b][on])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(turns, turn), pa.array(learned, pa.string()), pa.array(chars, pa.int64())],
                ["conv_id", "turns", "learned", "formatted_chars"])

    return formatted.select("conv_id", "text", "loss", "starts", "stops").mapInArrow(
        run, "conv_id long, turns array<struct<role: string, text: string>>, learned string, formatted_chars long")
