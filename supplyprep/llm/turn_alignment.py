"""Repair of conversations by Wagner-Fischer alignment with the turns they should have had.

The role initials of a sound conversation form ``(s?(ua)+)?``. Turns are kept, given another role,
deleted, or inserted; blank and repeated turns must go, and a cut-off turn that stays costs more.

* Must-go turns are taken out first; each costs the same wherever it stands.
* The other turns are aligned with the grammar strings. All strings of one ending are suffixes of
  one endless alternation, so a Wagner-Fischer table from the last turn backwards has, in its k-th
  column, the cheapest alignment with the last k characters: its first row holds every feasible
  length at once.
* A plain pass (re-role, or insert, whatever does not fit) gives an incumbent. More insertions or
  deletions than its cost can pay for are outside Ukkonen's band and are never computed.
* Each length that reaches the least cost is backtraced to its ASCII-least audit, one initial for
  each edit, and the audits are compared.

A conversation may hold a third of all rows, so rows are sorted by range over the cluster and cut
into segments. A segment is aligned for each pair of grammar states in which it may begin and end;
the segments of a conversation are then put together in order, by cost and audit. Choices that all
states share are given out at once, so little is held. A table of edits results; only a digest of
a whole conversation reads it in order, in a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyprep.llm.common import map_arrow, staged

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a segment.
SEGMENT = 64
#: Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)

_FAR = 1 << 60
_ROLES = {"u": "user", "a": "assistant"}


# --- one segment ------------------------------------------------------------------------------


def _other(role: str) -> str:
    return "a" if role == "u" else "u"


def _incumbent(turns: tuple[tuple[str, bool], ...], wanted: str, last: str) -> int:
    """A cost that some alignment has: every turn that does not fit gets another role, or a turn before it."""
    best = _FAR
    for insert in (False, True):
        cost, expected = 0, wanted
        for initial, cut in turns:
            if initial == expected:
                cost += TRUNCATED * cut
                expected = _other(expected)
            elif insert and initial in _ROLES:
                cost += INSERT + TRUNCATED * cut  # the turn itself fits after the inserted one
            else:
                cost += REROLE + TRUNCATED * cut
                expected = _other(expected)
        if expected == last or not turns:  # the last turn must be `last`, so the next is another
            cost += INSERT
            expected = _other(expected)
        best = min(best, cost + INSERT * (not turns))
    return best


def _suffix_table(turns: tuple[tuple[str, bool], ...], last: str, bound: int) -> list[dict[int, int]]:
    """``table[i][k]``: cost of aligning the turns from i on with the k last characters of ...ua or ...au; only inside the band."""
    n = len(turns)
    cuts = sum(cut for _, cut in turns)
    spare = bound - TRUNCATED * cuts
    most_inserts = max(0, spare // INSERT)
    most_deletes = 0
    while most_deletes < n and DELETE * (most_deletes + 1) - TRUNCATED * min(most_deletes + 1, cuts) <= spare:
        most_deletes += 1
    table: list[dict[int, int]] = [{} for _ in range(n + 1)]
    for k in range(most_inserts + 1):
        table[n][k] = INSERT * k
    for i in range(n - 1, -1, -1):
        (initial, cut), below, row = turns[i], table[i + 1], table[i]
        keep, change = TRUNCATED * cut, TRUNCATED * cut + REROLE
        left, before = n - i, _FAR
        for k in range(max(0, left - most_deletes), left + most_inserts + 1):
            cost = below.get(k, _FAR) + DELETE
            if k:
                character = last if k % 2 else _other(last)
                cost = min(cost, below.get(k - 1, _FAR) + (keep if initial == character else change), before + INSERT)
            row[k] = before = cost
    return table


def _trace(turns: tuple[tuple[str, bool], ...], table: list[dict[int, int]], last: str, i: int, k: int) -> str:
    """The ASCII-least audit of the cheapest alignments of the turns from i on with the k last characters."""
    out, n = [], len(turns)
    while i < n or k:
        cost = table[i][k]
        character = last if k % 2 else _other(last)
        if i < n and table[i + 1].get(k, _FAR) + DELETE == cost:
            out.append("D")
            i += 1
            continue
        if k and table[i].get(k - 1, _FAR) + INSERT == cost:
            out.append("I")
            k -= 1
            continue
        out.append("K" if turns[i][0] == character else "R")
        i, k = i + 1, k - 1
    return "".join(out)


def _least(found: list[tuple[int, str]]) -> tuple[int, str] | None:
    return min(found, default=None)


def _align(turns: tuple[tuple[str, bool], ...], entry: int, exit_: int) -> tuple[int, str] | None:
    """Cost and audit of the cheapest alignment that leads from one grammar state to another."""
    n = len(turns)
    if exit_ == START:
        return (DELETE * n, "D" * n) if entry == START else None
    if exit_ == SYSTEM:
        if entry == SYSTEM:
            return DELETE * n, "D" * n
        kept = [(DELETE * (n - 1) + TRUNCATED * cut, "D" * i + "K" + "D" * (n - 1 - i)) for i, (initial, cut) in enumerate(turns) if initial == "s"]
        return _least(kept) if entry == START else None
    last = "u" if exit_ == USER else "a"
    first = "a" if entry == USER else "u"
    bound = _incumbent(turns, first, last)
    table = _suffix_table(turns, last, bound)

    def lengths(i: int) -> tuple[int, list[int]]:
        """The least cost from turn i on, and the lengths that reach it and begin as they must."""
        odd = first == last
        fitting = {k: c for k, c in table[i].items() if k % 2 == odd and (k or entry == exit_)}
        least = min(fitting.values(), default=_FAR)
        return least, [k for k, c in fitting.items() if c == least]

    cost, chosen = lengths(0)
    starts = [("", 0, chosen)]
    if entry == START:
        for i, (initial, cut) in enumerate(turns):
            if initial != "s":
                continue
            rest, ks = lengths(i + 1)
            total = DELETE * i + TRUNCATED * cut + rest
            if total < cost:
                cost, starts = total, []
            if total == cost:
                starts.append(("D" * i + "K", i + 1, ks))
    audits = [head + _trace(turns, table, last, i, k) for head, i, ks in starts for k in ks]
    return cost, min(audits)


@lru_cache(maxsize=20_000)
def alignments(turns: tuple[tuple[str, bool], ...], whole: bool) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest alignments by pair of states; a whole conversation begins at the start and may end there or after an assistant turn."""
    pairs = [(START, START), (START, ASSISTANT)] if whole else [(e, x) for e in range(4) for x in range(4)]
    found = {pair: _align(turns, *pair) for pair in pairs}
    return {pair: f for pair, f in found.items() if f is not None}


Row = tuple[str, bool, int, int]
"""A row of a segment: role initial, whether cut off, 1 if it is a turn to be aligned, and copies that must go."""


def woven(rows: list[Row], audit: str) -> str:
    """The audit with one D for all must-go copies of a row, right after what stands before them.

    D is the least initial, so that is their ASCII-least place; all copies of a row go together, so
    their number does not matter where audits are compared.
    """
    out, at = [], 0
    for _, _, alive, gone in rows:
        if alive:
            start = at
            while audit[at] == "I":
                at += 1
            at += 1
            out.append(audit[start:at])
        if gone:
            out.append("D")
    return "".join(out) + audit[at:]


def edits_of(rows: list[Row], letters: str) -> list[tuple[str, int | None, int]]:
    """Edits (initial, row, times) that a woven audit stands for."""
    out, at = [], 0
    for index, (_, _, alive, gone) in enumerate(rows):
        if alive:
            while letters[at] == "I":
                out.append(("I", None, 1))
                at += 1
            out.append((letters[at], index, 1))
            at += 1
        if gone:
            out.append(("D", index, gone))
            at += 1
    return out + [("I", None, 1)] * (len(letters) - at)


def roles_of(entry: int, rows: list[Row], edits: list[tuple[str, int | None, int]]) -> list[str | None]:
    """The new role of each re-roled or inserted turn, else null."""
    state, out = entry, []
    for edit, index, _ in edits:
        if edit == "D":
            out.append(None)
            continue
        if edit == "K":
            initial = rows[index][0]
            out.append(None)
        else:
            initial = "a" if state == USER else "u"
            out.append(_ROLES[initial])
        state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[initial]
    return out


# --- segments of a conversation -----------------------------------------------------------------


class Chain:
    """Puts the segments of one conversation together, in order.

    ``live`` has, for each grammar state that may still lead to the best repair, the cost so far and
    the (entry state, audit) chosen for each segment not yet given out.
    """

    def __init__(self) -> None:
        self.live: dict[int, tuple[int, list[tuple[int, str]]]] = {START: (0, [])}
        self.waiting: list[tuple] = []  # segments not yet given out

    def add(self, segment: tuple, pairs: dict[tuple[int, int], tuple[int, str]]) -> Iterator[tuple[tuple, int, str]]:
        fresh: dict[int, tuple[int, list[tuple[int, str]]]] = {}
        for (entry, exit_), (cost, audit) in pairs.items():
            if entry in self.live:
                before, path = self.live[entry]
                option = (before + cost, [*path, (entry, audit)])
                if exit_ not in fresh or self._key(option) < self._key(fresh[exit_]):
                    fresh[exit_] = option
        self.live = self._pruned(fresh)
        self.waiting.append(segment)
        yield from self._given(len(self.waiting))

    @staticmethod
    def _key(option: tuple[int, list[tuple[int, str]]]) -> tuple[int, str]:
        return option[0], "".join(audit for _, audit in option[1])

    @staticmethod
    def _pruned(options: dict) -> dict:
        """States that another one beats whatever follows: what a state can do, the other can with so much more."""
        more = {
            (ASSISTANT, START): DELETE, (USER, START): DELETE + INSERT, (ASSISTANT, SYSTEM): 0, (USER, SYSTEM): INSERT,
            (ASSISTANT, USER): INSERT, (USER, ASSISTANT): INSERT,
        }
        return {s: o for s, o in options.items() if not any((b, s) in more and options[b][0] + more[b, s] < o[0] for b in options)}

    def _given(self, most: int) -> Iterator[tuple[tuple, int, str]]:
        paths = [path for _, path in self.live.values()]
        n = 0
        while n < most and all(path[n] == paths[0][n] for path in paths):
            n += 1
        for segment, (entry, audit) in zip(self.waiting[:n], paths[0][:n], strict=True):
            yield segment, entry, audit
        self.waiting = self.waiting[n:]
        self.live = {s: (cost, path[n:]) for s, (cost, path) in self.live.items()}

    def end(self) -> Iterator[tuple[tuple, int, str]]:
        """What is left; ``cost`` has the whole cost afterwards."""
        ends = {s: o for s, o in self.live.items() if s in (START, ASSISTANT)}
        best = min(ends, key=lambda s: self._key(ends[s]))
        self.cost = ends[best][0]
        self.live = {best: ends[best]}
        yield from self._given(len(self.waiting))


# --- tables ---------------------------------------------------------------------------------------

_PAIR = "struct<entry:int,leave:int,cost:long,audit:string>"
_ROWS = "conv {kind}, part long, row long, role string, text string"
_SEGMENTS = (
    "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first string, last string, "
    f"initials array<string>, cut array<boolean>, alive array<int>, gone array<long>, at array<long>, pairs array<{_PAIR}>"
)
_LONG, _TEXT = pa.int64(), pa.string()
_SEGMENT_KINDS = [
    *[_LONG] * 7, _TEXT, _TEXT, pa.list_(_TEXT), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(_LONG), pa.list_(_LONG),
    pa.list_(pa.struct([("entry", pa.int32()), ("leave", pa.int32()), ("cost", _LONG), ("audit", _TEXT)])),
]


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _trimmed(text: str) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+\z", "")


def _marked(turns: DataFrame) -> DataFrame:
    """Equal rows as one with ``times``; blank, cut-off and repeated ones marked."""
    rows = turns.groupBy("conv", "turn", "role", "text").agg(F.sum("times").alias("times"))
    rows = rows.withColumn("blank", F.length(_trimmed("text")) == 0)
    rows = rows.withColumn("truncated", ~F.substring(_trimmed("text"), -1, 1).isin(".", "!", "?"))
    rows = staged(rows.withColumn("digest", F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)), "turns")
    # Of texts that a conversation has at several turns the first turn is looked up by digest.
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    several = rows.where("times > 0 and not blank").groupBy("conv", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("earliest")).where("n > 1")
    several = staged(several.select(F.col("conv").alias("of"), F.col("digest").alias("known_digest"), "earliest"), "repeated-turns")
    rows = rows.join(several, F.col("conv").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("known_digest")), "left")
    again = F.col("earliest").isNotNull() & ~order.eqNullSafe(F.col("earliest"))
    return staged(rows.select("conv", "turn", "role", "text", "times", "blank", "truncated", again.alias("again")), "marked-turns")


def _illegal(before: str, after: str) -> bool:
    return before + after not in ("su", "ua", "au")


def _segment(rows: list[tuple], whole: bool) -> tuple:
    """Counts, pattern and alignments of a segment; rows: number, turn, role initial, times, blank, cut off, seen before."""
    blank = duplicate = truncated = illegal = turns = 0
    low = high = before = None
    kept: list[Row] = []
    at = []
    for row, turn, initial, times, is_blank, is_cut, again in rows:
        if not times:
            continue
        if turn is not None:
            turns += turn != high
            low, high = turn if low is None else low, turn
        alive = not (is_blank or again)
        blank += times * is_blank
        duplicate += 0 if is_blank else times - alive
        truncated += alive and is_cut
        illegal += (before is not None and _illegal(before, initial)) + times - 1
        before = initial
        kept.append((initial, is_cut, int(alive), times - alive))
        at.append(row)
    pattern = tuple((initial if initial in ("s", "u", "a") else "x", cut) for initial, cut, alive, _ in kept if alive)
    pairs = [{"entry": e, "leave": x, "cost": c, "audit": woven(kept, a)} for (e, x), (c, a) in alignments(pattern, whole).items()]
    columns = [list(c) for c in zip(*kept, strict=True)] or [[], [], [], []]
    return (blank, duplicate, truncated, illegal, turns, low, high, columns[0][0] if at else None, before, *columns, at, pairs)


def _segments(turns: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Rows in order, numbered by part and row, and the segments that they make up."""
    rows = _marked(turns).repartitionByRange("conv", "turn", "role", "text").sortWithinPartitions("conv", "turn", "role", "text")
    schema = _ROWS.format(kind=rows.schema["conv"].dataType.simpleString()) + ", " + _SEGMENTS
    names = _names(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, n_convs, n_cut = TaskContext.get().partitionId(), 0, 0, 0
        held: list[tuple] = []
        found: list[tuple] = []
        conv = kind = None

        def close(whole: bool) -> None:
            found.append((conv, part, held[0][0], None, None, *_segment(held, whole)))
            held.clear()

        def written() -> pa.RecordBatch:
            kinds = [kind, _LONG, _LONG, _TEXT, _TEXT, *_SEGMENT_KINDS]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=names)
            found.clear()
            return out

        for batch in batches:
            n, kind = batch.num_rows, batch.schema.field(0).type
            numbers = [pa.array([part] * n, _LONG), pa.array(range(row, row + n), _LONG)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, batch.column(2), batch.column(3), *[pa.nulls(n, t) for t in _SEGMENT_KINDS]], names=names)
            values = [batch.column(i).to_pylist() for i in (0, 1, 4, 5, 6, 7)]
            initials = [r[:1] for r in batch.column(2).to_pylist()]
            for key, turn, times, is_blank, is_cut, again, initial in zip(*values, initials, strict=True):
                if n_convs and key != conv:
                    # A conversation at the edge of a part may go on in another.
                    close(whole=not n_cut and n_convs > 1)
                elif len(held) == size:
                    close(whole=False)
                    n_cut += 1
                if not n_convs or key != conv:
                    conv, n_convs, n_cut = key, n_convs + 1, 0
                held.append((row, turn, initial, times, is_blank, is_cut, again))
                row += 1
            if found:
                yield written()
        if held:
            close(whole=False)
            yield written()

    both = staged(map_arrow(rows, run, schema), "ordered-turns")
    is_segment = F.col("pairs").isNotNull()
    return both.where(~is_segment).select(*names[:5]), both.where(is_segment).select("conv", "part", "row", *names[5:])


_CHOSEN = "conv {kind}, part long, row long, place long, edit string, times long, role string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _chosen(segments: DataFrame) -> DataFrame:
    """Edits of all conversations by row; the one without an edit has the conversation's figures."""
    schema = _CHOSEN.format(kind=segments.schema["conv"].dataType.simpleString())
    names, counted = _names(schema), ("blank", "duplicate", "truncated", "illegal")
    work = segments.repartition("conv").sortWithinPartitions("conv", "part", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kinds: list = []
        now: dict = {}

        def give(chosen: Iterator[tuple[tuple, int, str]]) -> None:
            for (part, row, rows, at), entry, letters in chosen:
                edits = edits_of(rows, letters)
                for (edit, index, times), role in zip(edits, roles_of(entry, rows, edits), strict=True):
                    # An inserted turn has no row; a number of its own keeps such rows apart in joins.
                    out.append((now["conv"], part, -1 - row if index is None else at[index], now["place"], edit, times, role, *[None] * 6))
                    now["place"] += 1

        def finish() -> None:
            give(now["chain"].end())
            gaps = 0 if now["low"] is None else min(now["high"] - now["low"] + 1 - now["turns"], (1 << 63) - 1)
            out.append((now["conv"], *now["at"], -1, None, None, None, gaps, *[now[c] for c in counted], now["chain"].cost + DELETE * now["gone"]))

        def written() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
            out.clear()
            return made

        for batch in batches:
            kinds = [batch.schema.field(0).type, _LONG, _LONG, _LONG, _TEXT, _LONG, _TEXT, *[_LONG] * 6]
            for x in batch.to_pylist():
                if not now or now["conv"] != x["conv"]:
                    if now:
                        finish()
                    now = {"conv": x["conv"], "chain": Chain(), "place": 0, "low": None, "high": None, "last": None, "turns": 0, "gone": 0} | dict.fromkeys(counted, 0)
                for c in counted:
                    now[c] += x[c]
                now["at"] = (x["part"], -1 - x["row"])
                now["gone"] += sum(x["gone"])
                now["turns"] += x["turns"] - (x["low"] is not None and x["low"] == now["high"])
                if x["low"] is not None:
                    now["low"], now["high"] = x["low"] if now["low"] is None else now["low"], x["high"]
                if x["first"] is not None:
                    now["illegal"] += now["last"] is not None and _illegal(now["last"], x["first"])
                    now["last"] = x["last"]
                rows = list(zip(x["initials"], x["cut"], x["alive"], x["gone"], strict=True))
                pairs = {(p["entry"], p["leave"]): (p["cost"], p["audit"]) for p in x["pairs"]}
                give(now["chain"].add((x["part"], x["row"], rows, x["at"]), pairs))
                if len(out) >= 4096:
                    yield written()
        if now:
            finish()
        if out:
            yield written()

    return staged(map_arrow(work, run, schema), "edits")


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", times: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """Edits that make each conversation sound, in order: conv, place, edit, times, role, text; and its figures.

    ``edit`` is K (kept), R (new role), D (deleted) or I (inserted), each standing ``times`` times;
    rows with an edit other than D are, by ``place``, the repaired conversation. One row for each
    conversation has place -1, no edit, and the figures gaps, blank, duplicate, truncated, illegal,
    cost. Rows are ordered by turn, nulls first, then role and text. A null role or text counts as
    one space, null conversation ids are one conversation. ``times`` names a column that tells how
    often a row stands there: 0 for a conversation that only has its id. No rows: none.
    Other columns are not read.
    """
    space = F.lit(" ")
    turns = conversations.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"),
        (F.col(times) if times else F.lit(1)).cast("long").alias("times"),
    )
    rows, segments = _segments(turns, segment)
    edits = _chosen(segments)
    texts = rows.select(F.col("part").alias("of_part"), F.col("row").alias("of_row"), F.col("role").alias("own_role"), "text")
    joined = edits.join(texts, (F.col("part") == F.col("of_part")) & (F.col("row") == F.col("of_row")), "left")
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    shown = F.when(F.col("edit") == "I", F.lit("")).otherwise(F.col("text"))
    return joined.select(F.col("conv").alias(conv), "place", "edit", "times", F.coalesce("role", "own_role").alias(role), shown.alias(text), *figures)


def digests(edits: DataFrame, conv: str = "conv_id", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its figures, audit, and SHA-256 of the repaired ``role:text`` lines.

    Rows of a conversation are read in order, as a stream; what is held is the audit.
    """
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    work = edits.select(F.col(conv).alias("conv"), "place", "edit", "times", F.concat_ws(":", role, text).alias("line"), *figures)
    work = work.repartition("conv").sortWithinPartitions("conv", "place")
    kind = work.schema["conv"].dataType.simpleString()
    names = [conv, *figures, "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now = [], None
        kinds = None

        def ended() -> tuple:
            return (*now["head"], "".join(now["audit"]), now["hash"].hexdigest())

        def written() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            kinds = kinds or [batch.schema.field(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
            for key, place, edit, times, line, *figures in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place < 0:
                    if now:
                        out.append(ended())
                        if len(out) >= 2048:
                            yield written()
                            out = []
                    now = {"head": (key, *figures), "audit": [], "hash": hashlib.sha256(), "lines": 0}
                    continue
                now["audit"].append(edit * times)
                if edit != "D":
                    now["hash"].update(b"\n" * (now["lines"] > 0) + line.encode())
                    now["lines"] += 1
        if now:
            out.append(ended())
        if out:
            yield written()

    return map_arrow(work, run, f"`{conv}` {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The test damage: by the CRC-32 of ``conv_id:turn`` modulo 20 a row is dropped, emptied, unpunctuated, repeated, or made the user's.

    Columns conv_id, turn, role, text and ``times``: 0 for a dropped row, 2 for a repeated one.
    """
    space = F.lit(" ")
    mark = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return conversations.select(
        "conv_id", "turn",
        F.when(mark == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(mark == 1, F.lit("")).when(mark == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(mark == 0, 0).when(mark == 3, 2).otherwise(1).alias("times"),
    )
