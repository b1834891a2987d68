"""Personal data in texts: exact patterns, and a skip-chain conditional random field that adds what they miss.

Patterns find e-mail addresses, IP addresses, card and phone numbers. The field then labels the
candidates, the words with a digit or an ``@``, as one of these kinds or none:

- a word's own potential comes from its shape, its two neighbours and its check (digits, octets, ``@``);
- words that follow each other share a chain potential, one for all kinds that agree and one for kinds that differ;
- distant words that repeat each other (equal letters and digits, or the same last seven digits, however
  written) share a skip potential: log odds that two such mentions agree. Every later mention is linked with the first one in the text, so links
  grow with the mentions, and no mention is further than two links from any other.

What the patterns found is given evidence. Loopy belief propagation carries it over both kinds of links,
``ROUNDS`` damped rounds of sum-product messages, vectorised over the texts of a batch. A candidate outside
the patterns' spans whose label then has at least ``SURE`` probability becomes a span as well: a number mentioned
again without its prefix, an address in another spelling. Other words are none for certain, so the field
needs no nodes for them.

All potentials are trained here, piecewise, from the patterns' labels of all texts: counts of (feature,
label) and of label pairs, by grouped aggregation. Features are hashed to ``CELLS`` cells, so the model has
a fixed size whatever the vocabulary. Texts are read once; the candidates are staged and read twice.

Defined cases: null and empty texts have no spans; words and texts of any length are read whole, every
pattern in linear time (memory grows with the candidates of one text, about 300 bytes each); equal rows get
equal results, each its own; a table without rows gives none; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.common import staged, steps, texts_of

# The kinds in the order of their names in a list of spans; label 0 is none.
KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)

#: Cells that features are hashed to.
CELLS = 1 << 15
#: Damped rounds of messages.
ROUNDS = 24
DAMPING = 0.3
#: Probability from which a candidate's label makes a span.
SURE = 0.9
#: What the counts of a feature get added, in proportion to the labels' shares, so that a rare one says little;
#: and what those of links get added.
RARE = 10.0
SMOOTH = 1.0
#: Characters beside a candidate that its neighbours are looked for in.
BESIDE = 64
#: Candidates in one step of inference; a single text may have more.
STEP_NODES = 50_000
#: From how many characters a word of each label is a span by itself: addresses always, cards from 12 digits, phones never.
WHOLE = np.array([1, 1, 1, 12, 1 << 30])
#: The log potential of a label that evidence rules out.
NEVER = -40.0

# The patterns. A match of the first three can only start where no digit stands before it, and
# possessive repeats give the same matches without trying a run of digits from each of its places.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_MARK = re.compile("[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_SPACES = frozenset(" \t\n\v\f\r")
_EDGES = ".,;:!?\"'()[]{}<>*#$%&=|~`^_/\\"
_NOT_DIGIT = re.compile("[^0-9]")
_LETTERS = re.compile(r"[^\W\d_]+")
_SEPARATORS = re.compile(r"[\W_]+")

Span = tuple[int, int, int]  # start, label, end


def luhn(digits: str) -> bool:
    values = [ord(c) - 48 for c in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _octets(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))


def _emails(text: str) -> Iterator[Span]:
    """Every ``@`` with what can stand before it and a domain behind it."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        floor = domain.end() if domain else at + 1
        if domain:
            yield start, 1, floor
        at = text.find("@", floor)


def pattern_spans(text: str) -> list[Span]:
    """The spans of the patterns by start, then kind."""
    spans = list(_emails(text))
    spans += [(m.start(), 2, m.end()) for m in _QUAD.finditer(text) if _octets(m.group())]
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 3, m.end()))
    if "+" in text:
        spans += [(m.start(), 4, m.end()) for m in _PHONE.finditer(text)
                  if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return sorted(spans)


def candidates(text: str) -> list[tuple[int, int]]:
    """Where the words with a digit or an ``@`` start and end."""
    found, end = [], 0
    mark = _MARK.search(text)
    while mark:
        start = mark.start()
        while start > end and text[start - 1] not in _SPACES:
            start -= 1
        stop = _SPACE.search(text, mark.end())
        end = stop.start() if stop else len(text)
        found.append((start, end))
        mark = _MARK.search(text, end)
    return found


def core_of(text: str, start: int, end: int) -> tuple[int, int]:
    """The word without the punctuation around it."""
    word = text[start:end]
    return end - len(word.lstrip(_EDGES)), start + len(word.rstrip(_EDGES))


def shape(word: str) -> str:
    """Each digit as 9, each run of letters as a."""
    return _LETTERS.sub("a", re.sub("[0-9]", "9", word))


def _check(core: str) -> str:
    digits = _NOT_DIGIT.sub("", core)
    if "@" in core:
        return "@."[: 1 + ("." in core.rpartition("@")[2])]
    if _QUAD.fullmatch(core):
        return "octets" if _octets(core) else "quad"
    if 12 <= len(digits) <= 19:
        return "luhn" if luhn(digits) else "long"
    return "plus" if core.startswith("+") else ""


def likeness(core: str) -> str | None:
    """What words that repeat each other have in common: the last seven digits, or all letters and digits."""
    plain = _SEPARATORS.sub("", core).lower()
    if plain.isdecimal():
        return plain[-7:] if len(plain) >= 7 else None
    return plain if len(plain) >= 7 else None


def _neighbour(word: str) -> str:
    return shape(word) if _MARK.search(word) else word.lower()


def features(text: str, start: int, end: int, core: str) -> list[int]:
    """The cells of a candidate's features."""
    before = text[max(0, start - BESIDE):start].split()
    after = text[end:end + BESIDE].split()
    named = (
        "s " + shape(core), "c " + _check(core),
        "b " + (_neighbour(before[-1]) if before else ""), "a " + (_neighbour(after[0]) if after else ""))
    return [crc32(f.encode("utf-8", "surrogatepass")) % CELLS for f in named]


FEATURES = 4

_FOUND = ("id long, starts array<int>, labels array<int>, ends array<int>, "
          "from array<int>, to array<int>, given array<int>, cells array<int>, first array<int>, follows array<int>")
_LISTS = ("starts", "labels", "ends", "from", "to", "given", "cells", "first", "follows")


def _read_text(text: str) -> list[list[int]]:
    """The lists of one text: pattern spans, and its candidates with label, cells, first mention, and whether they follow on."""
    spans = pattern_spans(text)
    out: list[list[int]] = [[] for _ in _LISTS]
    out[0], out[1], out[2] = ([s[i] for s in spans] for i in range(3))
    mentions: dict[str, int] = {}
    at, last_end = 0, None
    for i, (start, end) in enumerate(candidates(text)):
        while at < len(spans) and spans[at][2] <= start:
            at += 1
        # Spans of two kinds may overlap, so a longer one can hide behind an ended one: look at all that start before the end.
        given, j = 0, at
        while j < len(spans) and spans[j][0] < end:
            if spans[j][2] > start and (given == 0 or spans[j][1] < given):
                given = spans[j][1]
            j += 1
        low, high = core_of(text, start, end)
        core = text[low:high] if low < high else text[start:end]
        like = likeness(core)
        out[3].append(min(low, high) if low < high else start)
        out[4].append(high if low < high else end)
        out[5].append(given)
        out[6].extend(features(text, start, end, core))
        out[7].append(mentions.setdefault(like, i) if like is not None else i)
        # Candidates follow each other when nothing but white space stands between them.
        out[8].append(int(last_end is not None and start - last_end <= BESIDE and not text[last_end:start].strip()))
        last_end = end
    return out


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "text"):
        read = [_read_text(text) for text in texts_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array([r[i] for r in read], pa.list_(pa.int32())) for i in range(len(_LISTS)))],
            names=["id", *_LISTS])


class Graph(NamedTuple):
    """The candidates of some texts: evidence, cells, and links (one end, other end, 0 chain or 1 skip)."""

    given: np.ndarray
    cells: np.ndarray
    one: np.ndarray
    other: np.ndarray
    kind: np.ndarray
    rows: np.ndarray


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def graph_of(batch: pa.RecordBatch) -> Graph:
    sizes = batch.column("from").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(batch.num_rows), sizes)
    node = np.arange(len(rows))
    first = _flat(batch, "first") + np.repeat(np.cumsum(sizes) - sizes, sizes)
    chained, skipped = node[_flat(batch, "follows") == 1], node[first != node]
    # Neighbours that repeat each other have the skip link as well as the chain's.
    return Graph(
        _flat(batch, "given"), _flat(batch, "cells").reshape(-1, FEATURES),
        np.concatenate([chained - 1, first[skipped]]), np.concatenate([chained, skipped]),
        np.repeat([0, 1], [len(chained), len(skipped)]), rows)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by place in one array: cells by label, then pairs of labels by kind of link."""
    totals = np.zeros(CELLS * LABELS + 2 * LABELS * LABELS, dtype=np.int64)
    for batch in batches:
        g = graph_of(batch)
        at = (g.cells * LABELS + g.given[:, None]).ravel()
        pairs = (g.kind * LABELS + g.given[g.one]) * LABELS + g.given[g.other]
        totals += np.bincount(np.concatenate([at, CELLS * LABELS + pairs]), minlength=len(totals))
    used = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(totals[used], pa.int64())], names=["at", "n"])


class Model(NamedTuple):
    """Log potentials: of labels, of a cell's label against the label alone, and of linked labels, by kind of link."""

    share: np.ndarray
    cells: np.ndarray
    links: np.ndarray


def model_of(counts: np.ndarray) -> Model:
    """Each factor's share by itself: the closed form of piecewise training."""
    cells = counts[: CELLS * LABELS].reshape(CELLS, LABELS).astype(float)
    labels = cells.sum(axis=0) / FEATURES
    share = (labels + SMOOTH) / (labels.sum() + SMOOTH * LABELS)
    by_cell = (cells + RARE * share) / (cells.sum(axis=1, keepdims=True) + RARE)
    pairs = counts[CELLS * LABELS:].reshape(2, LABELS, LABELS).astype(float)
    expected = share[:, None] * share[None, :]
    # Kinds that follow each other share two potentials, to agree or to differ: a pattern that takes two numbers
    # for one long one is silent on both, so a pair of kinds that was never labelled says nothing by itself.
    seen = pairs[0].copy()
    for which in (np.eye(LABELS - 1, dtype=bool), ~np.eye(LABELS - 1, dtype=bool)):
        usual = expected[1:, 1:][which]
        seen[1:, 1:][which] = seen[1:, 1:][which].sum() * usual / usual.sum()
    chain = np.log((seen + SMOOTH * expected) / (seen.sum() + SMOOTH) / expected)
    # A pattern is evidence for a kind, but its silence is none against: of the mentions of one thing only
    # those count that are both labelled. All labels share one odds of agreement.
    found = pairs[1, 1:, 1:]
    odds = (np.trace(found) + SMOOTH) / (found.sum() - np.trace(found) + SMOOTH)
    return Model(np.log(share), np.log(by_cell / share), np.stack([chain, np.eye(LABELS) * max(0.0, np.log(odds))]))


def _log_sum(values: np.ndarray) -> np.ndarray:
    top = values.max(axis=-1, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=-1, keepdims=True)))[..., 0]


def marginals(model: Model, g: Graph) -> np.ndarray:
    """Probabilities of the labels of each node, by loopy belief propagation; exact where links form no loop."""
    own = model.share + model.cells[g.cells].sum(axis=1)
    known = g.given > 0
    own[known] = NEVER
    own[known, g.given[known]] = 0.0
    own -= _log_sum(own)[:, None]
    source, target = np.concatenate([g.one, g.other]), np.concatenate([g.other, g.one])
    back = np.roll(np.arange(len(source)), len(g.one))
    pair = model.links[g.kind]
    pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
    sent = np.zeros((len(source), LABELS))
    belief = own
    for _ in range(ROUNDS if len(source) else 0):
        told = belief[source] - sent[back]
        fresh = _log_sum((told[:, :, None] + pair).transpose(0, 2, 1))
        fresh -= _log_sum(fresh)[:, None]
        sent = DAMPING * sent + (1 - DAMPING) * fresh
        belief = own.copy()
        np.add.at(belief, target, sent)
    return np.exp(belief - _log_sum(belief)[:, None])


def _in_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column("from").value_lengths().to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // STEP_NODES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            # A slice's flattened lists are those of its own rows.
            yield batch.slice(start, stop - start)


def _labeller(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = pa.array(["none", *KINDS])
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def structs(starts: np.ndarray, labels: np.ndarray, ends: np.ndarray) -> pa.Array:
        return pa.StructArray.from_arrays(
            [names.take(pa.array(labels, pa.int64())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
            fields=list(span))

    def lists(rows: np.ndarray, count: int, starts: np.ndarray, labels: np.ndarray, ends: np.ndarray) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=count))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs(starts, labels, ends))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_steps(batches):
            sizes = batch.column("starts").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.repeat(np.arange(batch.num_rows), sizes)
            starts, labels, ends = (_flat(batch, c) for c in ("starts", "labels", "ends"))
            g = graph_of(batch)
            chances = marginals(model, g)
            best = chances.argmax(axis=1) if len(chances) else np.zeros(0, dtype=np.int64)
            sure = (g.given == 0) & (best > 0) & (chances.max(axis=1, initial=0) >= SURE)
            low, high, follows = (_flat(batch, c) for c in ("from", "to", "follows"))
            # Added candidates of one label that follow each other are one span, but for those whole by themselves.
            whole = high - low >= WHOLE[best]
            goes_on = np.zeros(len(sure), dtype=bool)
            goes_on[1:] = sure[1:] & sure[:-1] & (best[1:] == best[:-1]) & (follows[1:] == 1) & ~(whole[1:] | whole[:-1])
            opens = np.flatnonzero(sure & ~goes_on)
            closes = np.flatnonzero(sure & ~np.append(goes_on[1:], False))
            all_rows = np.concatenate([rows, g.rows[opens]])
            all_starts, all_labels = np.concatenate([starts, low[opens]]), np.concatenate([labels, best[opens]])
            all_ends = np.concatenate([ends, high[closes]])
            order = np.lexsort((all_ends, all_labels, all_starts, all_rows))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), lists(rows, batch.num_rows, starts, labels, ends),
                lists(all_rows[order], batch.num_rows, all_starts[order], all_labels[order], all_ends[order])],
                names=["doc_id", "base", "spans"])

    return label


def find_private(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans): the patterns' spans and all spans of each text, as (kind, start, end) in code points."""
    read = staged(docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(_read, _FOUND), "private-candidates")
    counts = np.zeros(CELLS * LABELS + 2 * LABELS * LABELS, dtype=np.int64)
    # One row per cell and label at most.
    for row in read.mapInArrow(_count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[row["at"]] = row["n"]
    span = "array<struct<kind string, start int, end int>>"
    return read.mapInArrow(_labeller(model_of(counts)), f"doc_id long, base {span}, spans {span}")


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the patterns' spans, and all spans as text."""
    def told(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number(kind) for kind in KINDS],
        F.sha2(told("base").cast("binary"), 256).alias("base_sha256"), told("spans").alias("spans"))
