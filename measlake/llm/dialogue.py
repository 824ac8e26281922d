"""Conversations brought into the order of roles ``(system? (user assistant)+)?``.

Each row is kept, given another role, or deleted, and rows are inserted; the
cheapest edits count, and of these the ones whose initials (D, I, K, R) come
first. Blank rows and repeats must be deleted; a truncated row that stays costs
extra.

Method: iterative-deepening A*. A depth-first search tries D, I, K, R in this
order and gives up where the cost so far and a lower bound of the rest pass the
bound; a table holds what failed states were shown to cost at least, and the
bound rises to the least cost that was cut off. The first accepting path is the
answer. The lower bound adds what each row costs by itself and pairs of
neighbours that cannot both stay as they are.

Long conversations: rows are sorted over ranges and cut into segments of at most
32 rows. Costs between the four states at a segment's ends (nothing yet, after
system, user, assistant) come from the same search and are added up along the
conversation, four numbers at a time; then every segment is searched once more
with the exact cost of what follows it, so the joined paths are the path of one
search. No task holds more than a segment, however long a conversation is; only
the four numbers and the digest of the repaired text, which is sequential by
nature, pass along it in one task. The set of texts is shuffled by text, not by
conversation.

Order: turn, nulls first, then role, then the SHA-256 of the text; equal rows
are neighbours. A null role or text is one space, a null conv_id is a
conversation of its own. An initial is a role's first character; an empty role has none,
fits nowhere and cannot be kept. Conversations without rows have no edits. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measlake.llm.common import kept

SEGMENT = 32
# Costs: another role, delete, insert, a truncated row that stays.
REROLE, DELETE, INSERT, OPEN = 3, 4, 3, 3
NEVER = 1 << 60
SPACES = " \t\n\x0b\x0c\r"
NO_FAULT, BLANK, COPY, TRUNCATED = range(4)
SYSTEM, USER, ASSISTANT, OTHER = range(4)
# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
STATES = range(4)
WANTED = (USER, USER, ASSISTANT, USER)
NEXT = (2, 2, 3, 2)
# What is left to do after the last row: nothing, insert both, insert the assistant, nothing.
LAST = (0, 2 * INSERT, INSERT, 0)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
NAMES = {USER: "user", ASSISTANT: "assistant"}


class Search:
    """Cheapest edits of a segment; a row's code is its role's class and four times its fault."""

    def __init__(self, codes: bytes, after: tuple[int, ...]) -> None:
        self.rows = [(code & 3, code >> 2) for code in codes]
        self.after = after
        later = min(after[2], after[3])
        self.least = (min(after), min(after[1], later), later, later)
        self.rest = self.lower_bounds()
        self.shown: dict[tuple[int, int], int] = {}
        self.path: list[str] = []

    def lower_bounds(self) -> list[int]:
        """For each row, what it and all behind it cost at least."""
        bounds, total = [0], 0
        # The row behind, if it is not deleted anyway nor already part of a pair.
        behind: tuple[int, int] | None = None
        for role, fault in reversed(self.rows):
            if fault in (BLANK, COPY):
                total += DELETE
            else:
                alone = OPEN if fault == TRUNCATED else 0
                total += min(DELETE, alone + (REROLE if role == OTHER else 0))
                pair = behind is not None and OTHER not in (role, behind[0])
                if pair and (role, behind[0]) not in LEGAL:
                    total += DELETE - OPEN if TRUNCATED in (fault, behind[1]) else INSERT
                    behind = None
                else:
                    behind = (role, fault)
            bounds.append(total)
        return bounds[::-1]

    def moves(self, place: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """Letter, cost, next place and state, in the order of the letters."""
        role, fault = self.rows[place]
        yield "D", DELETE, place + 1, state
        yield "I", INSERT, place, NEXT[state]
        if fault in (BLANK, COPY):
            return
        extra = OPEN if fault == TRUNCATED else 0
        if role == WANTED[state] or (role, state) == (SYSTEM, 0):
            yield "K", extra, place + 1, 1 if role == SYSTEM else NEXT[state]
        yield "R", REROLE + extra, place + 1, NEXT[state]

    def descend(self, place: int, state: int, budget: int) -> int:
        """The cost of the first path within the budget, or a lower bound above it."""
        if place == len(self.rows):
            return self.after[state]
        at_least = self.shown.get((place, state))
        if at_least is None:
            at_least = self.rest[place] + self.least[state]
        if at_least > budget:
            return at_least
        best = NEVER
        for letter, cost, to, next_state in self.moves(place, state):
            self.path.append(letter)
            found = cost + self.descend(to, next_state, budget - cost)
            if found <= budget:
                return found
            self.path.pop()
            best = min(best, found)
        self.shown[place, state] = best
        return best

    def cheapest(self, state: int) -> tuple[int, str]:
        """Cost and path from a state before the first row; no path if none leads to the end."""
        bound = self.rest[0] + self.least[state]
        while bound < NEVER:
            self.path.clear()
            found = self.descend(0, state, bound)
            if found <= bound:
                return found, "".join(self.path)
            bound = found
        return NEVER, ""


def state_after(state: int, codes: bytes, path: str) -> int:
    place = 0
    for letter in path:
        if letter == "K" and codes[place] & 3 == SYSTEM:
            state = 1
        elif letter != "D":
            state = NEXT[state]
        place += letter != "I"
    return state


def costs_across(codes: bytes) -> list[int]:
    """Cost from each state before the segment to each state behind it."""
    across = [[NEVER] * 4 for _ in STATES]
    for end in STATES:
        search = Search(codes, tuple(0 if end == state else NEVER for state in STATES))
        for start in STATES:
            across[start][end] = search.cheapest(start)[0]
    return [cost for row in across for cost in row]


def lines_of(state: int, codes: bytes, path: str, last: bool) -> list[tuple[int, str | None]]:
    """The repaired rows: place of the row (-1: inserted) and new role (None: its own)."""
    lines: list[tuple[int, str | None]] = []
    place = 0
    for letter in path + ("I" * (LAST[state_after(state, codes, path)] // INSERT) if last else ""):
        role = None if letter == "K" else NAMES[WANTED[state]]
        if letter != "D":
            lines.append((-1 if letter == "I" else place, role))
            state = 1 if letter == "K" and codes[place] & 3 == SYSTEM else NEXT[state]
        place += letter != "I"
    return lines


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults put in by a hash of conversation and turn; nulls are one space."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    key = F.concat(filled[0], F.lit(":"), filled[1])
    rows = turns.select(
        "conv_id",
        "turn",
        filled[2].alias("role"),
        filled[3].alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("kind"),
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    times = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.where("kind <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(times).alias("copy"),
    )


def row_key() -> Column:
    """With the text's digest, enough to find the text of a row again."""
    return F.xxhash64("conv_id", "turn", "role")


def marked(rows: DataFrame) -> DataFrame:
    """Equal rows once, with their number and the fault of the first; texts by digest."""
    tail = F.rtrim("text", F.lit(SPACES))
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        F.unhex(F.sha2("text", 256)).alias("text_id"),
        (tail == "").alias("blank"),
        (~F.right(tail, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    equal = narrow.groupBy("conv_id", "turn", "role", "text_id").agg(
        F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut")
    )
    groups = kept(equal, "dialogue-rows")
    # Structs compare nulls first, as the order of rows does.
    earliest = groups.where("NOT blank").groupBy("conv_id", "role", "text_id")
    repeated = earliest.agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns"))
    repeated = repeated.where("turns > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_id").alias("t"), "first"
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
    joined = groups.join(repeated, same & (F.col("text_id") == F.col("t")), "left")
    again = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    fault = F.when(F.col("blank"), BLANK).when(again, COPY).when(F.col("cut"), TRUNCATED)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT)
    return joined.select(
        *groups.columns,
        fault.otherwise(NO_FAULT).cast("int").alias("fault"),
        role.otherwise(OTHER).cast("int").alias("role_class"),
    )


def segments(rows: DataFrame) -> DataFrame:
    """Rows in order, up to 32 a segment; ``part`` rises with the order.

    ``across`` is null for a conversation that is one segment.
    """
    order = ["conv_id", "turn", "role", "text_id"]
    ranged = rows.withColumn("key", row_key()).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("range", F.spark_partition_id())
    kind = pa.list_(pa.struct([("key", pa.int64()), ("text_id", pa.binary()), ("role", pa.string())]))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = 0, [], 0
        conv: object = None
        codes, keys = bytearray(), []
        first, fresh = True, True  # the first conversation of the range; nothing of this one told yet

        def told(whole: bool, id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal number, codes, keys, fresh
            across = None if whole else costs_across(bytes(codes))
            arrays = [
                pa.array([conv], type=id_type),
                pa.array([(place << 33) + number], type=pa.int64()),
                pa.array([bytes(codes)], type=pa.binary()),
                pa.array([keys], type=kind),
                pa.array([across], type=pa.list_(pa.int64())),
            ]
            number, codes, keys, fresh = number + 1, bytearray(), [], False
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "part", "codes", "keys", "across"])

        place = 0
        id_type = pa.null()
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                place = row["range"]
                if keys and row["conv_id"] != conv:
                    # A conversation at a range's start may have begun before it.
                    held.append(told(fresh and not first, id_type))
                    first = False
                if row["conv_id"] != conv:
                    conv, fresh = row["conv_id"], True
                for copy in range(row["n"]):
                    if len(codes) == SEGMENT:
                        held.append(told(False, id_type))
                    fault = row["fault"]
                    if copy and fault != BLANK:
                        fault = COPY
                    codes.append(row["role_class"] + 4 * fault)
                    keys.append({name: row[name] for name in ("key", "text_id", "role")})
                    if len(held) >= 500:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                        held = []
        if keys:
            held.append(told(False, id_type))
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    id_type = rows.schema["conv_id"].dataType.simpleString()
    parts = (
        f"conv_id {id_type}, part bigint, codes binary, "
        "keys array<struct<key: bigint, text_id: binary, role: string>>, across array<bigint>"
    )
    narrow = ranged.select("conv_id", "role", "text_id", "n", "fault", "role_class", "key", "range")
    return kept(narrow.mapInArrow(cut, parts), "dialogue-segments")


def along(
    parts: DataFrame, down: bool, start: tuple, step: Callable[[tuple, dict], tuple[tuple, dict]], result: str
) -> DataFrame:
    """Walk each conversation's segments in order, handing a small state on; one row per segment."""
    order = F.desc("part") if down else F.asc("part")
    sorted_parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", order)
    names = [field.split()[0] for field in result.split(", ")]

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv: object = object()
        state = start
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] != conv:
                    conv, state = row["conv_id"], start
                state, told = step(state, row)
                out.append(told)
            columns = {name: [row[name] for row in out] for name in names}
            yield pa.RecordBatch.from_pydict(columns, schema=schema)

    schema = pa.schema([(f.split()[0], ARROW[f.split()[1]]) for f in result.split(", ")])
    return sorted_parts.mapInArrow(walk, result)


ARROW = {"bigint": pa.int64(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64())}


def costs_before(after: tuple[int, ...], row: dict) -> tuple[tuple[int, ...], dict]:
    across = row["across"]
    before = tuple(min(across[4 * a + b] + after[b] for b in STATES) for a in STATES)
    return tuple(min(cost, NEVER) for cost in before), {"part": row["part"], "after": list(after)}


def state_before(state: tuple[int], row: dict) -> tuple[tuple[int], dict]:
    return (row["ends"][state[0]],), {"part": row["part"], "state": state[0]}


def searched(parts: DataFrame) -> DataFrame:
    """Segments with the state before them, their paths and the cost of what follows."""
    several = parts.where("across IS NOT NULL").select("conv_id", "part", "across")
    after = along(several, True, LAST, costs_before, "part bigint, after array<bigint>")
    joined = parts.drop("across").join(after, "part", "left")
    known = F.coalesce("after", F.array(*[F.lit(cost).cast("long") for cost in LAST]))
    starts = F.when(F.col("after").isNull(), F.array(F.lit(0))).otherwise(F.array(*map(F.lit, STATES)))
    joined = joined.select("conv_id", "part", "codes", "keys", known.alias("after"), starts.alias("starts"))

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, ends = [], []
            for row in batch.select(["codes", "after", "starts"]).to_pylist():
                search = Search(row["codes"], tuple(row["after"]))
                found = [search.cheapest(state)[1] for state in row["starts"]]
                paths.append(found)
                ends.append([state_after(s, row["codes"], p) for s, p in zip(row["starts"], found)])
            columns = [batch.column(name) for name in ("conv_id", "part", "codes", "keys", "after")]
            columns += [pa.array(paths, type=pa.list_(pa.string())), pa.array(ends, type=pa.list_(pa.int64()))]
            names = ["conv_id", "part", "codes", "keys", "after", "paths", "ends"]
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = {f.name: f.dataType.simpleString() for f in joined.schema}
    schema = ", ".join(f"{n} {fields[n]}" for n in ("conv_id", "part", "codes", "keys", "after"))
    solved = joined.mapInArrow(solve, f"{schema}, paths array<string>, ends array<bigint>")
    solved = kept(solved, "dialogue-paths")
    long = solved.where("size(paths) = 4").select("conv_id", "part", "ends")
    begun = along(long, False, (0,), state_before, "part bigint, state bigint")
    states = solved.join(begun, "part", "left").withColumn("state", F.coalesce("state", F.lit(0)))
    path = F.get("paths", F.col("state").cast("int")).alias("path")
    return states.select("conv_id", "part", "codes", "keys", "state", path)


def with_ends(parts: DataFrame) -> DataFrame:
    """Whether a segment is its conversation's last, and the last code before it."""
    bounds = parts.select("conv_id", "part", F.expr("substring(codes, -1, 1)").alias("tail"))
    step = "part bigint, before bigint"

    def previous(state: tuple[int], row: dict) -> tuple[tuple[int], dict]:
        return (row["tail"][0] & 3,), {"part": row["part"], "before": state[0]}

    ends = parts.groupBy("conv_id").agg(F.max("part").alias("part")).select("part", F.lit(True).alias("last"))
    return parts.join(along(bounds, False, (-1,), previous, step), "part").join(ends, "part", "left")


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired rows and one report row per conversation of ``turns`` that has rows.

    Rows: conv_id, part and place (their order), role, text. Report: conv_id,
    gaps, blank, duplicate, truncated, illegal, cost, audit.
    """
    turns = turns.select("conv_id", "turn", "role", "text")
    rows = marked(turns)
    counts = rows.groupBy("conv_id").agg(
        F.coalesce(
            F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)
        ).cast("long").alias("gaps"),
        F.sum(F.when(F.col("fault") == BLANK, F.col("n")).otherwise(0)).alias("blank"),
        F.sum(
            F.when(F.col("fault") == COPY, F.col("n")).when(F.col("fault") == BLANK, 0).otherwise(F.col("n") - 1)
        ).alias("duplicate"),
        F.sum((F.col("fault") == TRUNCATED).cast("long")).alias("truncated"),
    )
    parts = with_ends(searched(segments(rows)))
    line = "array<struct<place: int, role: string>>"

    def written(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("place", pa.int32()), ("role", pa.string())]))
        for batch in batches:
            lines, illegal, cost, audit = [], [], [], []
            for row in batch.select(["codes", "state", "path", "before", "last"]).to_pylist():
                codes, path = row["codes"], row["path"]
                if row["last"]:
                    path += "I" * (LAST[state_after(row["state"], codes, path)] // INSERT)
                found = lines_of(row["state"], codes, path, False)
                lines.append([{"place": place, "role": role} for place, role in found])
                roles = [code & 3 for code in codes]
                pairs = zip([row["before"], *roles], roles)
                illegal.append(sum(a >= 0 and (a, b) not in LEGAL for a, b in pairs))
                cut = sum(codes[p] >> 2 == TRUNCATED for p, _ in found if p >= 0)
                cost.append(
                    DELETE * path.count("D") + INSERT * path.count("I") + REROLE * path.count("R") + OPEN * cut
                )
                audit.append(path)
            arrays = [batch.column(name) for name in ("conv_id", "part", "keys")]
            arrays += [pa.array(lines, type=kind), pa.array(illegal, pa.int64()), pa.array(cost, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(audit, pa.string())],
                ["conv_id", "part", "keys", "lines", "illegal", "cost", "audit"],
            )

    fields = {f.name: f.dataType.simpleString() for f in parts.schema}
    schema = f"conv_id {fields['conv_id']}, part bigint, keys {fields['keys']}, lines {line}"
    schema += ", illegal bigint, cost bigint, audit string"
    narrow = parts.select("conv_id", "part", "codes", "keys", "state", "path", "before", "last")
    done = kept(narrow.mapInArrow(written, schema), "dialogue-edits")

    # An audit is as long as its conversation has rows, so its pieces fit where it fits.
    pieces = F.sort_array(F.collect_list(F.struct("part", "audit")))
    sums = done.groupBy(F.col("conv_id").alias("c")).agg(
        F.sum("illegal").alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"),
    )
    report = counts.join(sums, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")

    edits = done.select("conv_id", "part", "keys", F.posexplode("lines").alias("place", "line"))
    own = F.when(F.col("line.place") >= 0, F.get("keys", F.col("line.place")))
    edits = edits.select("conv_id", "part", "place", F.col("line.role").alias("new_role"), own.alias("own"))
    texts = turns.select(row_key().alias("key"), F.unhex(F.sha2("text", 256)).alias("text_id"), "text")
    texts = texts.dropDuplicates(["key", "text_id"])
    inserted = edits.where("own IS NULL").select(
        "conv_id", "part", "place", F.col("new_role").alias("role"), F.lit("").alias("text")
    )
    stayed = edits.where("own IS NOT NULL").select(
        "conv_id", "part", "place", "new_role", "own.key", "own.text_id", F.col("own.role").alias("old_role")
    )
    stayed = stayed.join(texts, ["key", "text_id"]).select(
        "conv_id", "part", "place", F.coalesce("new_role", "old_role").alias("role"), "text"
    )
    return stayed.union(inserted), report


def text_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` joined by newlines, row after row."""
    rows = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    id_type = repaired.schema["conv_id"].dataType.simpleString()

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sha, kind = None, None, None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            ids, digests = [], []
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "role", "text")]
            for new, role, text in zip(*columns):
                if sha is None or new != conv:
                    if sha is not None:
                        ids.append(conv)
                        digests.append(sha.hexdigest())
                    conv, sha = new, hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, kind), pa.array(digests, pa.string())], ["conv_id", "repaired_sha256"]
            )
        if sha is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], kind), pa.array([sha.hexdigest()], pa.string())], ["conv_id", "repaired_sha256"]
            )

    narrow = rows.select("conv_id", "role", "text", "part", "place")
    return narrow.mapInArrow(hashed, f"conv_id {id_type}, repaired_sha256 string")


def digest(turns: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost and edits of the damaged rows, digest of the repaired ones."""
    repaired, report = repair(damaged(turns))
    report = report.withColumnRenamed("conv_id", "r")
    digests = text_digests(repaired).withColumnRenamed("conv_id", "d")
    all_ids = turns.select("conv_id").distinct()
    joined = all_ids.join(report, F.col("conv_id").eqNullSafe(F.col("r")), "left")
    joined = joined.join(digests, F.col("conv_id").eqNullSafe(F.col("d")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
