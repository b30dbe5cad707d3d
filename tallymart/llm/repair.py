"""Repair of conversation structure: the cheapest edits that make roles alternate, with an audit of them.

A conversation should read as an optional system turn, then user and assistant in
turn. The edits of its rows are Keep, Rerole, Delete and Insert. A dynamic program over
the rows keeps, for each state of that pattern, the cost and the edits of its cheapest
prefix; of equally cheap ones the least in ASCII order wins.

Prefixes are shared: a prefix is a node that links to the one without its last
edit. Each node has its ancestors 1, 2, 4, ... edits back and a rolling hash of the
whole prefix. Two tied prefixes meet by a search for their longest common one: both go
up by halving steps while the hashes differ, and the next edits decide. That
the common prefixes are equal, and not only their hashes, is verified by walking both
up to the node they share. Neither of two tied prefixes of the same rows begins
with the other, as it would have cost the edits that are left, so the order found stays
when both grow.

Rows come to a task sorted and stream through it. A state that can no longer be on the
cheapest way is dropped; what all others agree on is decided, goes into the
digest and the audit, and is forgotten. So memory follows the undecided rows, and a
conversation with a third of all rows is streamed, not held; only its audit, one letter a row,
is kept. The digest of a conversation has to meet its texts in order, in one task.

Copies are found without a group by text: the first turn of each conversation, role and text
(a partial minimum) travels as a marker that sorts right before the rows it marks.

Edge cases: a null role or text is one space, so is a null id or number in the key of the
damage. Rows go by number, nulls first, then by role and by SHA-256 of the text. A role of
no known initial can't be kept. Rows without an id are one conversation. A conversation that
lost all rows has zeros, an empty audit and the digest of an empty string. An empty
table gives no rows. Only ``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3

#: States of ``(s?(ua)+)?``: nothing yet, after a system turn, after a user, after an assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a kept row leads to, by state and role initial.
KEPT = {
    (NOTHING, "s"): SYSTEM,
    (NOTHING, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
#: The state that a turn of the role due leads to, and that role.
DUE = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}

#: Rows between looks at what is decided.
SETTLE_ROWS = 512

_MODULUS = (1 << 61) - 1
_BASE = 0x1F3D5B79A2C4E687


class Prefixes:
    """Edit prefixes as linked nodes; node 0 is the empty one."""

    def __init__(self, base: int = _BASE, modulus: int = _MODULUS) -> None:
        self.base, self.modulus = base, modulus
        self.up: list[tuple[int, ...]] = [()]  # ancestors 1, 2, 4, ... edits back
        self.edit: list[str] = [""]
        self.state: list[int] = [NOTHING]
        self.depth: list[int] = [0]
        self.hash: list[int] = [1]

    def extend(self, node: int, edit: str, state: int) -> int:
        up, step = [node], 0
        while len(self.up[up[step]]) > step:
            up.append(self.up[up[step]][step])
            step += 1
        self.up.append(tuple(up))
        self.edit.append(edit)
        self.state.append(state)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.base + ord(edit)) % self.modulus)
        return len(self.edit) - 1

    def above(self, node: int, depth: int) -> int:
        """The ancestor at that depth."""
        while (left := self.depth[node] - depth) > 0:
            node = self.up[node][left.bit_length() - 1]
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether the edits of ``a`` come before those of ``b`` in ASCII order."""
        shorter = min(self.depth[a], self.depth[b])
        x, y = self.above(a, shorter), self.above(b, shorter)
        if self.hash[x] == self.hash[y]:
            return self.depth[a] < self.depth[b] if self._verified(x, y) else self._walked(a, b)
        for step in reversed(range(len(self.up[x]))):
            # ancestors reach less far back the nearer the root is
            if step < len(self.up[x]) and self.hash[self.up[x][step]] != self.hash[self.up[y][step]]:
                x, y = self.up[x][step], self.up[y][step]
        if not self._verified(self.up[x][0], self.up[y][0]):
            return self._walked(a, b)
        return self.edit[x] < self.edit[y]

    def _verified(self, x: int, y: int) -> bool:
        """Whether two prefixes of one length are equal, edit by edit up to the node they share."""
        while x != y:
            if self.edit[x] != self.edit[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def _walked(self, a: int, b: int) -> bool:
        return self.spelled(a) < self.spelled(b)

    def path(self, node: int) -> list[int]:
        """The nodes from the first edit to this one."""
        nodes = []
        while self.up[node]:
            nodes.append(node)
            node = self.up[node][0]
        return nodes[::-1]

    def spelled(self, node: int) -> str:
        return "".join(self.edit[n] for n in self.path(node))

    def shared(self, nodes: list[int]) -> int:
        """The deepest node above all of these."""
        low = min(self.depth[n] for n in nodes)
        at = {self.above(n, low) for n in nodes}
        for step in reversed(range(low.bit_length())):
            if len(at) > 1 and all(step < len(self.up[n]) for n in at):
                higher = {self.up[n][step] for n in at}
                if len(higher) > 1:
                    at = higher
        return at.pop() if len(at) == 1 else self.up[at.pop()][0]


class Repair:
    """The dynamic program over the rows of one conversation, fed one by one."""

    def __init__(self, settle_rows: int = SETTLE_ROWS) -> None:
        self.prefixes = Prefixes()
        self.cells: dict[int, tuple[int, int]] = {NOTHING: (0, 0)}  # state -> cost, prefix
        self.settle_rows = settle_rows
        self.waiting: list[tuple[str, str]] = []  # rows whose edit is undecided
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.written = False
        self._insert()

    def _offer(self, cells: dict, state: int, cost: int, node: int, edit: str) -> bool:
        held = cells.get(state)
        if held and held[0] < cost:
            return False
        p = self.prefixes
        if held and held[0] == cost and (p.up[held[1]][:1], p.edit[held[1]]) == ((node,), edit):
            return False
        new = p.extend(node, edit, state)
        if held and held[0] == cost and not p.less(new, held[1]):
            return False
        cells[state] = (cost, new)
        return True

    def _insert(self) -> None:
        """Inserted turns, until none makes a state cheaper; then states without a future go."""
        cells, changed = self.cells, True
        while changed:
            changed = False
            for state in sorted(cells, key=lambda s: cells[s][0]):
                cost, node = cells[state]
                changed |= self._offer(cells, DUE[state], cost + INSERT_COST, node, INSERT)
        # From ASSISTANT all is possible that is from SYSTEM, and from NOTHING but to keep a
        # system turn, which can be deleted instead.
        done = cells[ASSISTANT][0]
        if SYSTEM in cells and cells[SYSTEM][0] > done:
            del cells[SYSTEM]
        if NOTHING in cells and cells[NOTHING][0] > done + DELETE_COST:
            del cells[NOTHING]

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        old, new = self.cells, {}
        self.waiting.append((role, text))
        extra = TRUNCATED_COST if truncated else 0
        for state, (cost, node) in old.items():
            self._offer(new, state, cost + DELETE_COST, node, DELETE)
            if must_go:
                continue
            if (kept := KEPT.get((state, role[:1]))) is not None:
                self._offer(new, kept, cost + extra, node, KEEP)
            self._offer(new, DUE[state], cost + REROLE_COST + extra, node, REROLE)
        self.cells = new
        self._insert()
        if len(self.waiting) >= self.settle_rows and len(self.waiting) % self.settle_rows == 0:
            self._settle()

    def _decide(self, node: int) -> None:
        """Write out the edits up to ``node``."""
        p, used, path = self.prefixes, 0, self.prefixes.path(node)
        self.audit.append("".join(p.edit[n] for n in path))
        for n in path:
            edit = p.edit[n]
            role, text = "", ""
            if edit != INSERT:
                role, text = self.waiting[used]
                used += 1
            if edit == DELETE:
                continue
            if edit != KEEP:
                role = ROLES[p.state[n]]
            self.digest.update(f"{chr(10) if self.written else ''}{role}:{text}".encode())
            self.written = True
        self.waiting = self.waiting[used:]

    def _settle(self) -> None:
        """Decide what all states share and go on without it."""
        p = self.prefixes
        node = p.shared([end for _, end in self.cells.values()])
        self._decide(node)
        fresh = Prefixes()
        fresh.state[0] = p.state[node]
        moved = {node: 0}
        for state, (cost, end) in self.cells.items():
            for n in p.path(end)[p.depth[node] :]:
                if n not in moved:
                    moved[n] = fresh.extend(moved[p.up[n][0]], p.edit[n], p.state[n])
            self.cells[state] = (cost, moved[end])
        self.prefixes = fresh

    def end(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the repaired conversation."""
        ends = [c for s, c in self.cells.items() if s in (NOTHING, ASSISTANT)]
        cost, node = ends[0]
        for other in ends[1:]:
            if other[0] < cost or other[0] == cost and self.prefixes.less(other[1], node):
                cost, node = other
        self._decide(node)
        return cost, "".join(self.audit), self.digest.hexdigest()


class Conversation:
    """Counts of faults and the repair of one conversation, row by row."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.initial: str | None = None
        self.repair = Repair()

    def row(self, turn: int | None, role: str, text: str, first: bool, blank: bool, complete: bool) -> None:
        duplicate = not blank and not first
        truncated = not blank and first and not complete
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        self.repair.row(role, text, blank or duplicate, truncated)

    def end(self) -> tuple:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        cost, audit, digest = self.repair.end()
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the damage that the checksum of their key deals: ``copies`` is 0 for dropped ones, 2 for repeated ones."""
    or_space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    key = F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        or_space("role").alias("role"),
        or_space("text").alias("text"),
        kind.alias("kind"),
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )


def repaired(rows: DataFrame) -> DataFrame:
    """A row per conversation: its faults, the cheapest edits and the digest of what they make of it.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text`` and ``copies``, how often a row is there.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    keyed = rows.withColumns(
        {
            "digest": F.sha2(F.col("text").cast("binary"), 256),
            "blank": ~F.col("text").rlike(r"[^\x20\x09-\x0D]"),
            "complete": F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"),
            "marker": F.lit(1),
        }
    )
    # Spark orders nulls of a struct first, as the rows are ordered
    first = keyed.where("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("_at"))
    marks = first.select("conv_id", F.col("_at.turn").alias("turn"), "role", "digest", F.lit(0).alias("marker"))
    stream = keyed.unionByName(marks, allowMissingColumns=True).repartition("conv_id")
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest", "marker"]
    columns = ["conv_id", "turn", "role", "digest", "marker", "copies", "blank", "complete", "text"]
    stream = stream.sortWithinPartitions(*order).select(*columns)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current: Conversation | None = None
        marked: tuple | None = None

        def out(key: pa.DataType) -> pa.RecordBatch:
            kinds = (key, *[pa.int64()] * 6, pa.string(), pa.string())
            made = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(made, names)

        for batch in batches:
            for conv_id, turn, role, digest, marker, copies, blank, complete, text in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if current is None or current.conv_id != conv_id:
                    if current:
                        done.append(current.end())
                    current, marked = Conversation(conv_id), None
                if marker == 0:
                    marked = (turn, role, digest)
                    continue
                for _ in range(copies):
                    # the first row after its marker is the first of its copies
                    current.row(turn, role, text, marked == (turn, role, digest), blank, complete)
                    marked = None
            if done:
                yield out(batch.schema.field(0).type)
        if current:
            done.append(current.end())
            yield out(batch.schema.field(0).type)

    longs = ", ".join(f"{n} long" for n in names[1:7])
    return stream.mapInArrow(streamed, f"conv_id {kind}, {longs}, audit string, repaired_sha256 string")
