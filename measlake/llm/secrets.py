"""Secrets in texts, found by one automaton for all rules.

The rules' regexes become one nondeterministic automaton over bytes, that one
deterministic automaton by subset construction, and that a minimal one by
refinement. Its transition array reads every byte once, for all rules together.

Where the automaton is in its start state no match is under way, so texts fall
apart there: a segment between two such places is matched on its own. Only
segments in which a rule accepts long enough are then read exactly, to get the
leftmost non-overlapping matches.

Null and empty texts hold no spans. Repeated rows give repeated results. A null
id is passed on. Other columns of the input are not read.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as parser
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measlake.llm.common import gathered


@dataclass(frozen=True)
class Rule:
    """A kind of secret.

    A match counts if ``group`` has at least ``least`` characters; then the last
    ``run`` bytes of it, at least, all end a match.
    """

    kind: str
    pattern: str
    group: int
    least: int
    run: int


RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, 16),
    Rule("hex", r"[0-9a-f]+", 0, 24, 24),
)

# Never part of a text in UTF-8: always leads back to the start state.
BETWEEN = 0xFF
SLICE = 4 << 20
LANE = 2048
FEW_LANES = 48


class Nfa:
    """States with empty moves and moves on sets of bytes (as 256-bit numbers)."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[int, int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, items: Iterable, at: int, fold: bool = False) -> int:
        """Append the parsed items behind state ``at``; returns the last state."""
        for op, arg in items:
            if op in (sre.LITERAL, sre.NOT_LITERAL, sre.IN, sre.ANY):
                to = self.state()
                self.moves[at].append((byte_set(op, arg, fold), to))
                at = to
            elif op is sre.BRANCH:
                to = self.state()
                for branch in arg[1]:
                    start = self.state()
                    self.empty[at].append(start)
                    self.empty[self.add(branch, start, fold)].append(to)
                at = to
            elif op is sre.SUBPATTERN:
                _, on, off, inner = arg
                at = self.add(inner, at, (fold or bool(on & re.I)) and not off & re.I)
            elif op is sre.MAX_REPEAT:
                low, high, inner = arg
                for _ in range(low):
                    at = self.add(inner, at, fold)
                if high is sre.MAXREPEAT:
                    loop, out = self.state(), self.state()
                    self.empty[at].append(loop)
                    self.empty[loop].append(out)
                    self.empty[self.add(inner, loop, fold)].append(loop)
                    at = out
                else:
                    out = self.state()
                    self.empty[at].append(out)
                    for _ in range(high - low):
                        at = self.add(inner, at, fold)
                        self.empty[at].append(out)
                    at = out
            else:
                raise ValueError(f"a rule uses {op}, which the automaton does not know")
        return at

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        seen = set(states)
        todo = list(seen)
        while todo:
            for to in self.empty[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)


def byte_set(op: object, arg: object, fold: bool) -> int:
    """The bytes one item of a pattern takes."""
    codes: set[int] = set()
    negated = op is sre.NOT_LITERAL
    for kind, value in arg if op is sre.IN else [(sre.LITERAL if negated else op, arg)]:
        if kind is sre.NEGATE:
            negated = True
        elif kind is sre.LITERAL:
            codes.add(value)
        elif kind is sre.RANGE:
            codes.update(range(value[0], value[1] + 1))
        elif kind is sre.ANY:
            codes, negated = {ord("\n")}, True
        else:
            raise ValueError(f"a rule uses {kind}, which the automaton does not know")
    if any(code > 127 for code in codes):
        raise ValueError("rules name ASCII characters only")
    if fold:
        codes |= {ord(c) for code in codes for c in (chr(code).lower(), chr(code).upper())}
    if negated:
        codes = set(range(256)) - codes
    return sum(1 << code for code in codes - {BETWEEN})


@dataclass(frozen=True)
class Automaton:
    """Minimal automaton: class of each byte, next states, rules that accept in each state.

    States are numbered by the place of their row in ``table``; 0 is the start.
    """

    classes: np.ndarray
    table: np.ndarray
    accepts: np.ndarray


def compiled(rules: Iterable[Rule]) -> Automaton:
    nfa = Nfa()
    start = nfa.state()
    finals = []
    for rule in rules:
        first = nfa.state()
        nfa.empty[start].append(first)
        finals.append(nfa.add(parser.parse(rule.pattern), first))
    # Bytes that no move tells apart are one class.
    sets = sorted({taken for moves in nfa.moves for taken, _ in moves})
    signatures = [tuple(taken >> byte & 1 for taken in sets) for byte in range(256)]
    kinds = {s: i for i, s in enumerate(dict.fromkeys(signatures))}
    classes = np.array([kinds[s] for s in signatures], dtype=np.int32)
    samples = [signatures.index(s) for s in kinds]
    # Subset construction; a match may start at any byte, so the start is in every subset.
    begin = nfa.closure([start])
    number = {begin: 0}
    order = [begin]
    rows = []
    for subset in order:
        row = []
        for byte in samples:
            moved = {to for s in subset for taken, to in nfa.moves[s] if taken >> byte & 1}
            reached = nfa.closure(moved | {start})
            if reached not in number:
                number[reached] = len(order)
                order.append(reached)
            row.append(number[reached])
        rows.append(row)
    moves = np.array(rows)
    masks = np.array([sum(1 << i for i, f in enumerate(finals) if f in s) for s in order])
    # Refinement; the start stays apart, since it says that no match is under way.
    block = np.unique(np.stack([masks, np.arange(len(order)) == 0]), axis=1, return_inverse=True)[1]
    while True:
        finer = np.unique(
            np.column_stack([block, block[moves]]), axis=0, return_inverse=True
        )[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    firsts = np.unique(block, return_index=True)[1]
    ranked = np.argsort(np.argsort(np.where(firsts == 0, -1, firsts)))
    block = ranked[block]
    firsts = np.sort(firsts)
    table = block[moves[firsts]].astype(np.int32)
    return Automaton(classes, table, masks[firsts].astype(np.uint8))


def states_of(automaton: Automaton, data: np.ndarray) -> np.ndarray:
    """State after each byte. ``data`` starts in the start state.

    The bytes are cut into lanes behind bytes that lead back to the start from
    every state, and all lanes advance together.
    """
    width = automaton.table.shape[1]
    table = (automaton.table * width).ravel()
    kinds = automaton.classes[data]
    back = np.flatnonzero((automaton.table == 0).all(axis=0)[kinds])
    wanted = np.arange(0, len(data), LANE)[1:]
    at = np.searchsorted(back, wanted)
    starts = np.unique(np.concatenate([[0], back[at[at < len(back)]] + 1]))
    starts = starts[starts < len(data)]
    lengths = np.diff(np.append(starts, len(data)))
    by_length = np.argsort(-lengths, kind="stable")
    place, lengths = starts[by_length], lengths[by_length]
    out = np.zeros(len(data), dtype=np.int32)
    state = np.zeros(len(place), dtype=np.int32)
    active = len(place)
    for step in range(lengths[0] if len(lengths) else 0):
        while active and lengths[active - 1] <= step:
            active -= 1
        if active < FEW_LANES:
            break
        place, state = place[:active], state[:active]
        state = table[state + kinds[place]]
        out[place] = state
        place = place + 1
    else:
        return out // width
    as_list = table.tolist()
    for lane in range(active):
        now, first = int(state[lane]), int(place[lane])
        rest = kinds[first : first + lengths[lane] - step].tolist()
        for i, kind in enumerate(rest):
            rest[i] = now = as_list[now + kind]
        out[first : first + len(rest)] = rest
    return out // width


def segments(
    automaton: Automaton, rules: tuple[Rule, ...], data: np.ndarray
) -> Iterator[tuple[int, int, int]]:
    """Rule, first byte and end of each segment in which the rule may match."""
    first = 0
    back = (automaton.table == 0).all(axis=0)[automaton.classes]
    while first < len(data):
        end = min(first + SLICE, len(data))
        while end < len(data) and not back[data[end - 1]]:
            end += 1
        states = states_of(automaton, data[first:end])
        accepts = automaton.accepts[states]
        idle = np.flatnonzero(states == 0)
        for i, rule in enumerate(rules):
            edges = np.flatnonzero(np.diff((accepts >> i & 1).astype(np.int8), prepend=0, append=0))
            begun, ended = edges[::2], edges[1::2]
            long = ended - begun >= rule.run
            begun, ended = begun[long], ended[long]
            before = np.searchsorted(idle, begun) - 1
            after = np.searchsorted(idle, ended)
            low = np.where(before >= 0, idle[before] + 1 if len(idle) else 0, 0)
            high = np.where(after < len(idle), np.append(idle, end - first)[after], end - first)
            for a, b in dict.fromkeys(zip(low.tolist(), high.tolist())):
                yield i, first + a, first + b
        first = end


def spans_of(
    automaton: Automaton, rules: tuple[Rule, ...], texts: list[bytes]
) -> list[list[tuple[int, int, int]]]:
    """(start, rule, end) of each text's secrets, in characters, in order."""
    data = np.frombuffer(bytes([BETWEEN]).join(texts), dtype=np.uint8)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    exact = [re.compile(rule.pattern.encode()) for rule in rules]
    found: dict[int, list[tuple[int, int, int]]] = {}
    for i, a, b in segments(automaton, rules, data):
        doc = int(np.searchsorted(begins, a, side="right")) - 1
        offset = a - int(begins[doc])
        part = texts[doc][offset : offset + b - a]
        for match in exact[i].finditer(part):
            if len(match.group(rules[i].group)) >= rules[i].least:
                span = (offset + match.start(), i, offset + match.end())
                found.setdefault(doc, []).append(span)
    result: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for doc, spans in found.items():
        ends = sorted({x for start, _, end in spans for x in (start, end)})
        chars, last, count = {}, 0, 0
        for x in ends:
            count += len(texts[doc][last:x].decode("utf-8", "replace"))
            chars[x], last = count, x
        result[doc] = sorted((chars[s], i, chars[e]) for s, i, e in spans)
    return result


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Each document's id and its ``spans``: kind, start, end (exclusive) in characters."""
    automaton = compiled(rules)
    kinds = [rule.kind for rule in rules]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in gathered(batches):
            found = [
                [{"kind": kinds[i], "start": s, "end": e} for s, i, e in spans]
                for spans in spans_of(automaton, rules, texts)
            ]
            spans = pa.array(
                found,
                pa.list_(
                    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
                ),
            )
            ids = rows.column("doc_id").combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, spans], names=["doc_id", "spans"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + (
        "spans array<struct<kind:string,start:bigint,end:bigint>>"
    )
    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def mask_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]"
) -> DataFrame:
    """The documents with every secret replaced by ``mask``; spans that overlap become one.

    All columns stay; texts without secrets, null texts included, are unchanged.
    """
    automaton = compiled(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in gathered(batches):
            column = rows.column("text")
            new = column.to_pylist()
            for doc, spans in enumerate(spans_of(automaton, rules, texts)):
                if not spans:
                    continue
                parts, last, old = [], 0, new[doc]
                for start, _, end in spans:
                    if start >= last:
                        parts += [old[last:start], mask]
                    last = max(last, end)
                new[doc] = "".join([*parts, old[last:]])
            at = rows.schema.get_field_index("text")
            changed = rows.set_column(at, rows.schema.field(at), pa.array(new, column.type))
            yield from changed.combine_chunks().to_batches()

    return docs.mapInArrow(scan, docs.schema)


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts per kind and the spans as one text, with its SHA-256."""
    joined = F.array_join(
        F.transform(
            "spans",
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(rule.kind).alias(f"n_{rule.kind}") for rule in rules]
    return found.select("doc_id", *counts, joined.alias("spans")).withColumn(
        "base_sha256", F.sha2("spans", 256)
    )
