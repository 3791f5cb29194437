"""Repair of damaged conversations: cheapest edits, and of these the least audit.

A conversation is repaired to an optional system turn and pairs of user and assistant turns. Nodes are
(row, state); the state says which role came last. Arcs delete, keep or rerole the row, or insert an
empty turn before it, and each carries the initial of its edit. A backward pass gives every node its cost
to the end; arcs that keep to it are the optimal ones. Nodes are then ranked by the least audits of
length 1, 2, 4, ... that optimal arcs spell, each length from two of half of it, along with pointers to
the nodes these lead to; ranks and pointers together give the least path. Arcs of one node have different
initials (the role that a state wants next is one only), so a prefix leads to one node.

Rows are put in order by one range partitioning over (conversation, turn, ...): a conversation that holds
a third of all rows lies in many partitions. What begins and ends inside a partition and is not long is
repaired there, many conversations side by side. The rest lies in blocks: each block gives its costs from
every state to every state, a scan from the end gives what follows each block, blocks find their least
paths from all four states, and a scan from the start picks one. The scans read a few numbers a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.taskcontext import TaskContext

from ebbtide.llm.common import scratch_path, shared_dir

#: Rows and text characters of a block, and of the conversations repaired at once.
BLOCK_ROWS = 4096
BLOCK_CHARS = 1 << 22
BLANKS = " \t\n\v\f\r"
LEGAL = ("su", "ua", "au")

# Costs of the edits, and of an undeleted truncated row.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
FAR = 1 << 50

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the role that a state wants next.
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: By initial (s, u, a, other) and state: the state after the row is kept, -1 where it cannot be.
KEEP = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1, -1, -1, -1]])
#: Cheapest end: each state's cost to an empty conversation or an assistant turn.
END = np.array([0, 2 * INSERT, INSERT, 0])
EDITS = np.frombuffer(b"\0DIKR", np.uint8)
ROLES = {USER: "user", ASSISTANT: "assistant"}


# --- cheapest edits and least audits ----------------------------------------------------------


@dataclass
class Chains:
    """Rows of several chains end to end: code of the initial, whether the row must go, whether it is
    truncated; rows per chain."""

    code: np.ndarray
    gone: np.ndarray
    cut: np.ndarray
    lengths: np.ndarray

    def __post_init__(self) -> None:
        self.row = np.cumsum(self.lengths) - self.lengths
        self.node = self.row + np.arange(len(self.lengths))  # one more node than rows each

    def _arcs(self, after: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """Costs to the end by deleting, keeping, reroling ``rows``, for each state."""
        extra = TRUNCATED * self.cut[rows][:, None] + np.where(self.gone[rows], FAR, 0)[:, None]
        kept = KEEP[self.code[rows]]
        keep = np.where(kept >= 0, np.take_along_axis(after, np.maximum(kept, 0), 1) + extra, FAR)
        return after + DELETE, keep, after[:, NEXT] + REROLE + extra

    def costs(self, end: np.ndarray) -> np.ndarray:
        """Cost from every node and state to the end, ``end`` being that of the last node."""
        go = np.empty((len(self.code) + len(self.lengths), 4), np.int64)
        go[self.node + self.lengths] = end
        by_length = np.argsort(-self.lengths, kind="stable")
        longer = len(self.lengths) - np.searchsorted(
            np.sort(self.lengths), np.arange(1, int(self.lengths.max(initial=0)) + 1)
        )
        for back, active in enumerate(longer.tolist(), 1):
            chains = by_length[:active]
            at = self.node[chains] + self.lengths[chains] - back
            rows = self.row[chains] + self.lengths[chains] - back
            best = np.minimum.reduce(self._arcs(go[at + 1], rows))
            for _ in range(3):  # inserts in front of the row
                best = np.minimum(best, best[:, NEXT] + INSERT)
            go[at] = np.minimum(best, FAR)
        return go

    def least_arcs(self, go: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least initial among the optimal arcs of each (node, state), 0 where a path ends, and the node
        it leads to. ``closed`` chains may still insert at their end."""
        n = len(go)
        label = np.zeros((n, 4), np.int64)
        target = np.arange(n * 4).reshape(n, 4)
        inserted = 4 * np.arange(n)[:, None] + NEXT
        rows = np.arange(len(self.code))
        at = rows + np.repeat(np.arange(len(self.lengths)), self.lengths)
        delete, keep, rerole = self._arcs(go[at + 1], rows)
        here = go[at]
        moved = 4 * (at + 1)[:, None]
        choices = [
            (4, rerole == here, moved + NEXT),
            (3, keep == here, moved + np.maximum(KEEP[self.code], 0)),
            (2, here[:, NEXT] + INSERT == here, inserted[at]),
            (1, delete == here, moved + np.arange(4)),
        ]
        for code, optimal, to in choices:  # the least one stays
            label[at] = np.where(optimal, code, label[at])
            target[at] = np.where(optimal, to, target[at])
        last = (self.node + self.lengths)[closed]
        for state in (SYSTEM, USER):
            label[last, state] = 2
            target[last, state] = inserted[last, state]
        return label.ravel(), target.ravel()


def least_paths(
    label: np.ndarray, target: np.ndarray, starts: np.ndarray
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Nodes of the least path from each start, the node it ends at, and every node's rank.

    ``rank`` orders nodes by the least audit of length 2^k, an ended audit before a longer one; each
    round puts two ranks together, the node's and that of the node 2^k arcs on."""
    rank, pointer = np.unique(label, return_inverse=True)[1], target
    pointers = [pointer]
    while label[pointer].any():
        pair = rank * (int(rank.max()) + 1) + rank[pointer]
        rank = np.unique(pair, return_inverse=True)[1]
        pointer = pointer[pointer]
        pointers.append(pointer)
    path = starts[:, None]
    for pointer in pointers:
        path = np.concatenate([path, pointer[path]], axis=1)
    steps = (label[path] > 0).sum(axis=1)
    last = path[np.arange(len(path)), steps]
    return [nodes[:n] for nodes, n in zip(path, steps, strict=True)], last, rank


@dataclass
class Piece:
    """Rows of one conversation in order, with their turns."""

    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    turns: list[int | None] = field(default_factory=list)
    chars: int = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.turns.append(turn)
        self.chars += len(text) + len(role)

    def flags(self, late: set[int] = frozenset()) -> tuple[np.ndarray, ...]:
        """Code of the initial, blank, duplicate, truncated; ``late`` rows repeat an earlier piece."""
        n = len(self.roles)
        code = np.fromiter(("sua".find(r[:1]) if r else 3 for r in self.roles), np.int64, n)
        blank, repeated, cut = (np.zeros(n, bool) for _ in range(3))
        seen: set[tuple[str, str]] = set()
        for i, key in enumerate(zip(self.roles, self.texts, strict=True)):
            body = key[1].rstrip(BLANKS)
            if not body:
                blank[i] = True
            elif key in seen or i in late:
                repeated[i] = True
            else:
                cut[i] = body[-1] not in ".!?"
            seen.add(key)
        return np.where(code < 0, 3, code), blank, repeated, cut

    def repaired(self, audit: str, state: int) -> list[dict[str, str]]:
        """What the edits leave, from a state."""
        out, i = [], 0
        for edit in audit:
            if edit == "I":
                state = int(NEXT[state])
                out.append({"role": ROLES[state], "text": ""})
                continue
            if edit == "K":
                code = "sua".find(self.roles[i][:1])
                state = int(KEEP[code, state])
                out.append({"role": self.roles[i], "text": self.texts[i]})
            elif edit == "R":
                state = int(NEXT[state])
                out.append({"role": ROLES[state], "text": self.texts[i]})
            i += 1
        return out

    def profile(self) -> dict[str, object]:
        """What a report adds up over pieces."""
        known = [t for t in self.turns if t is not None]
        pairs = zip(self.roles, self.roles[1:], strict=False)
        return {
            "rows": len(self.roles),
            "first_turn": min(known, default=None),
            "last_turn": max(known, default=None),
            "turns": len(set(known)),
            "first_initial": self.roles[0][:1] if self.roles else None,
            "last_initial": self.roles[-1][:1] if self.roles else None,
            "illegal": sum(a[:1] + b[:1] not in LEGAL for a, b in pairs),
        }


def solve(pieces: list[Piece]) -> list[dict[str, object]]:
    """Faults, cost, audit and repaired turns of whole conversations."""
    out: list[dict[str, object]] = [{} for _ in pieces]
    classes = [len(p.roles).bit_length() for p in pieces]
    for size in set(classes):  # lengths within a factor of two
        chosen = [i for i, c in enumerate(classes) if c == size]
        flags = [pieces[i].flags() for i in chosen]
        code, blank, repeated, cut = (np.concatenate(x) for x in zip(*flags, strict=True))
        chains = Chains(code, blank | repeated, cut, np.array([len(pieces[i].roles) for i in chosen]))
        go = chains.costs(np.broadcast_to(END, (len(chosen), 4)))
        label, target = chains.least_arcs(go, np.ones(len(chosen), bool))
        paths, _, _ = least_paths(label, target, 4 * chains.node + START)
        for i, f, nodes, first in zip(chosen, flags, paths, chains.node, strict=True):
            audit = EDITS[label[nodes]].tobytes().decode()
            out[i] = {
                "blank": int(f[1].sum()),
                "duplicate": int(f[2].sum()),
                "truncated": int(f[3].sum()),
                "cost": int(go[first, START]),
                "audit": audit,
                "repaired": pieces[i].repaired(audit, START),
            }
    return out


# --- rows in order ----------------------------------------------------------------------------

_PROFILE = (
    "rows bigint, first_turn bigint, last_turn bigint, turns bigint, first_initial string, "
    "last_initial string, illegal bigint"
)
_FAULTS = "blank bigint, duplicate bigint, truncated bigint"
_TURNS = "array<struct<role:string,text:string>>"
#: One row per piece; ``whole`` conversations are one piece, the cost of others is with their first.
PIECES = f"piece bigint, whole boolean, {_PROFILE}, {_FAULTS}, cost bigint, audit string, repaired {_TURNS}"


def _schema(rows: DataFrame, rest: str) -> StructType:
    out = StructType().add("conv_id", rows.schema["conv_id"].dataType)
    for item in StructType.fromDDL(rest).fields:
        out = out.add(item)
    return out


def _batch(rows: list[dict[str, object]], schema: StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))


def prepared(rows: DataFrame) -> DataFrame:
    """Turns of ``rows(conv_id, turn, role, text)`` as they are: NULL role or text is one space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.lit(True).alias("there"),
        role.alias("order_role"),
        F.md5(text).alias("order_text"),
        F.lit(0).alias("copy"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """The same turns damaged by ``crc32("conv_id:turn") % 20``: 0 drops one (a row that is not there
    stays, so that the conversation is not forgotten), 1 empties its text, 2 takes out ``[.!?]``, 3 has
    it twice, 4 makes it the user's."""
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(key[0], F.lit(":"), key[1])) % 20
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = (
        F.when(F.col("_fault").isin(0, 1), "")
        .when(F.col("_fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    return (
        turns.withColumn("_fault", fault)
        .withColumns(
            {
                "text": text,
                "role": F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")),
                "there": F.col("_fault") != 0,
                "copy": F.explode(copies),
            }
        )
        .drop("_fault")
    )


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns in order, NULL first, those of one number by role and text. Rows that agree in all this are
    interchangeable, so they may be spread over partitions."""
    names = ("conv_id", "turn", "order_role", "order_text", "copy", "_spread")
    order = [F.col(c).asc_nulls_first() for c in names]
    spread = turns.withColumn("_spread", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select("conv_id", "turn", "role", "text", "there")


def _first_pass(turns: DataFrame) -> DataFrame:
    """Whole conversations repaired, and blocks (as they are, in ``repaired``) of those that are long or
    may go on in another partition: the first and the last of each."""
    schema = _schema(turns, PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        ready: list[tuple[object, Piece]] = []
        size = chars = 0
        conv: object = None
        piece: Piece | None = None
        is_open = True  # the first conversation of a partition

        def row(conv: object, piece: Piece, **rest: object) -> dict[str, object]:
            nonlocal number
            number += 1
            return {"conv_id": conv, "piece": number, "whole": False, **piece.profile(), **rest}

        def block() -> pa.RecordBatch:
            turns = [{"role": r, "text": t} for r, t in zip(piece.roles, piece.texts, strict=True)]
            return _batch([row(conv, piece, repaired=turns)], schema)

        def wholes() -> pa.RecordBatch:
            solved = solve([p for _, p in ready])
            return _batch(
                [row(c, p, **s) | {"whole": True} for (c, p), s in zip(ready, solved, strict=True)], schema
            )

        for batch in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
            for here, turn, role, text, there in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if piece is None:
                    conv, piece = here, Piece()
                elif here != conv:
                    if is_open:
                        yield block()
                    else:
                        ready.append((conv, piece))
                        size, chars = size + len(piece.roles), chars + piece.chars
                        if size >= BLOCK_ROWS or chars >= BLOCK_CHARS:
                            yield wholes()
                            ready, size, chars = [], 0, 0
                    conv, piece, is_open = here, Piece(), False
                elif len(piece.roles) >= BLOCK_ROWS or piece.chars >= BLOCK_CHARS:
                    yield block()
                    piece, is_open = Piece(), True
                if there:
                    piece.add(turn, role, text)
        if ready:
            yield wholes()
        if piece is not None:
            yield block()

    return _ordered(turns).mapInArrow(run, schema)


# --- conversations in several blocks ----------------------------------------------------------


def _piece_of(turns: list[dict[str, str]]) -> Piece:
    return Piece([t["role"] for t in turns], [t["text"] for t in turns])


def _late(blocks: DataFrame) -> DataFrame:
    """``(piece, late)``: rows whose role and text an earlier block of the conversation holds. A block
    sends each content once, so a content counts no more rows than there are blocks."""
    schema = _schema(blocks, "piece bigint, i int, content binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, piece, turns in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                first: dict[bytes, int] = {}
                for i, t in enumerate(turns):
                    if t["text"].rstrip(BLANKS):
                        data = f"{len(t['role'])}:{t['role']}{t['text']}".encode()
                        first.setdefault(hashlib.blake2b(data, digest_size=16).digest(), i)
                rows = [{"conv_id": conv, "piece": piece, "i": i, "content": c} for c, i in first.items()]
                yield _batch(rows, schema)

    contents = blocks.select("conv_id", "piece", "repaired").mapInArrow(run, schema)
    rank = F.row_number().over(Window.partitionBy("conv_id", "content").orderBy("piece"))
    again = contents.withColumn("_rank", rank).filter("_rank > 1")
    return again.groupBy("piece").agg(F.collect_list("i").alias("late"))


def _transfers(blocks: DataFrame) -> DataFrame:
    """Rows of each block as codes, its faults, and its costs from every state to every state."""
    schema = _schema(blocks, f"piece bigint, {_FAULTS}, codes binary, transfer array<bigint>")
    unit = np.where(np.eye(4, dtype=bool), 0, FAR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, piece, turns, late in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                code, blank, repeated, cut = _piece_of(turns).flags(set(late or ()))
                gone, n = blank | repeated, len(code)
                chains = Chains(*[np.tile(x, 4) for x in (code, gone, cut)], np.full(4, n))
                to = chains.costs(unit)[chains.node]  # a row per state at the end
                row = {
                    "conv_id": conv,
                    "piece": piece,
                    "blank": int(blank.sum()),
                    "duplicate": int(repeated.sum()),
                    "truncated": int(cut.sum()),
                    "codes": (code + 4 * gone + 8 * cut).astype(np.uint8).tobytes(),
                    "transfer": to.T.ravel().tolist(),
                }
                yield _batch([row], schema)

    flagged = blocks.select("conv_id", "piece", "repaired").join(_late(blocks), "piece", "left")
    return flagged.select("conv_id", "piece", "repaired", "late").mapInArrow(run, schema).checkpoint()


def _ends(transfers: DataFrame) -> DataFrame:
    """``(piece, end, closed)``: cost from each state at the end of a block to the end of the
    conversation, from its last block to its first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple = ()
        go = END
        for batch in batches:
            rows = []
            for conv, piece, transfer in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                closed = before != (conv,)
                go = END if closed else go
                rows.append({"piece": piece, "end": go.tolist(), "closed": closed})
                go = np.minimum((np.array(transfer).reshape(4, 4) + go).min(axis=1), FAR)
                before = (conv,)
            yield _batch(rows, schema)

    schema = StructType.fromDDL("piece bigint, end array<bigint>, closed boolean")
    order = [F.col("conv_id"), F.col("piece").desc()]
    kept = transfers.select("conv_id", "piece", "transfer").repartition("conv_id")
    return kept.sortWithinPartitions(*order).mapInArrow(run, schema)


def _block_paths(transfers: DataFrame, ends: DataFrame) -> DataFrame:
    """Least audit of each block from each of the four states, and the state it ends in."""
    rest = f"piece bigint, {_FAULTS}, costs array<bigint>, exits array<int>, audits array<string>"
    schema = _schema(transfers, rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.frombuffer(row.pop("codes"), np.uint8).astype(np.int64)
                gone, cut = codes & 4 > 0, codes & 8 > 0
                chains = Chains(codes & 3, gone, cut, np.array([len(codes)]))
                go = chains.costs(np.array([row.pop("end")]))
                label, target = chains.least_arcs(go, np.array([row.pop("closed")]))
                paths, last, _ = least_paths(label, target, np.arange(4))
                row["costs"] = go[0].tolist()
                row["exits"] = (last % 4).tolist()
                row["audits"] = [EDITS[label[nodes]].tobytes().decode() for nodes in paths]
                yield _batch([row], schema)

    kept = transfers.drop("transfer").join(ends, "piece")
    names = ["conv_id", "piece", "blank", "duplicate", "truncated", "codes", "end", "closed"]
    return kept.select(*names).mapInArrow(run, schema)


def _entered(paths: DataFrame) -> DataFrame:
    """The state in which each block is entered and the audit it has then, from the first block on."""
    schema = StructType.fromDDL(f"piece bigint, {_FAULTS}, cost bigint, entry int, audit string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple = ()
        state = START
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                first = before != (row["conv_id"],)
                before, state = (row.pop("conv_id"),), START if first else state
                row["cost"] = row.pop("costs")[START] if first else 0
                row["entry"], row["audit"] = state, row.pop("audits")[state]
                state = row.pop("exits")[state]
                rows.append(row)
            yield _batch(rows, schema)

    return paths.repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(run, schema)


def _repaired_blocks(blocks: DataFrame) -> DataFrame:
    transfers = _transfers(blocks)
    entered = _entered(_block_paths(transfers, _ends(transfers)))
    kept = blocks.drop("blank", "duplicate", "truncated", "cost", "audit").join(entered, "piece")
    names = [f.name for f in _schema(blocks, PIECES).fields]
    schema = _schema(blocks, PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                state = row.pop("entry")
                row["repaired"] = _piece_of(row["repaired"]).repaired(row["audit"], state)
                yield _batch([row], schema)

    return kept.select(*names, "entry").mapInArrow(run, schema)


# --- whole operator ---------------------------------------------------------------------------


def repair(turns: DataFrame) -> DataFrame:
    """Pieces of repaired conversations from ``prepared`` turns, ``damaged`` or not: ``conv_id, piece``
    (pieces of a conversation in order), what ``repair_report`` adds up, the audit and the turns left.

    Turns of one number go by role and text (as they were before any damage); equal rows count each.
    NULL conversation ids are one conversation, NULL turns come first. Empty tables give no pieces.
    """
    spark = turns.sparkSession
    shared_dir(spark)
    path = scratch_path(spark, "pieces")
    _first_pass(turns).write.option("parquet.block.size", 8 << 20).parquet(path)
    pieces = spark.read.schema(_schema(turns, PIECES)).parquet(path)
    whole, blocks = pieces.filter("whole"), pieces.filter("NOT whole")
    return whole.unionByName(_repaired_blocks(blocks))


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """``(conv_id, piece, position, role, text)``, in order by piece and position."""
    return pieces.select("conv_id", "piece", F.posexplode("repaired").alias("position", "turn")).select(
        "conv_id", "piece", "position", "turn.role", "turn.text"
    )


REPORT = (
    f"gaps bigint, {_FAULTS}, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)


def _report(pieces: DataFrame) -> DataFrame:
    """One row per conversation from pieces in order; of one in several pieces only sums, the audit and
    the state of the digest are held."""
    schema = _schema(pieces, REPORT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[str, object] | None = None
        held: dict[str, object] = {}

        def done() -> dict[str, object]:
            low, high = held["low"], held["high"]
            at["gaps"] = 0 if low is None else high - low + 1 - held["turns"]
            at["audit"] = "".join(held["audit"])
            at["repaired_sha256"] = held["digest"].hexdigest()
            return at

        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if at is None or row["conv_id"] != at["conv_id"]:
                    if at is not None:
                        rows.append(done())
                    at = {"conv_id": row["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0}
                    at |= {"illegal": 0, "cost": 0}
                    held = {"low": None, "high": None, "turns": 0, "audit": [], "initial": None}
                    held |= {"digest": hashlib.sha256(), "any": False}
                for name in ("blank", "duplicate", "truncated", "illegal", "cost"):
                    at[name] += row[name]
                if row["rows"]:
                    if held["initial"] is not None:
                        at["illegal"] += held["initial"] + row["first_initial"] not in LEGAL
                    held["initial"] = row["last_initial"]
                if row["first_turn"] is not None:
                    held["turns"] += row["turns"] - (held["high"] == row["first_turn"])
                    held["low"] = row["first_turn"] if held["low"] is None else held["low"]
                    held["high"] = row["last_turn"]
                held["audit"].append(row["audit"])
                for turn in row["repaired"]:
                    line = f"{turn['role']}:{turn['text']}"
                    held["digest"].update((f"\n{line}" if held["any"] else line).encode())
                    held["any"] = True
            yield _batch(rows, schema)
        if at is not None:
            yield _batch([done()], schema)

    return pieces.mapInArrow(run, schema)


def repair_report(pieces: DataFrame) -> DataFrame:
    """Per conversation: gaps in its turns, rows by their first fault, illegal neighbours, cost, audit,
    digest of what is left. Whole conversations are reported where they lie; the pieces of others are
    brought together and read one after the other, since the digest has to be taken in order."""
    others = pieces.filter("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return _report(pieces.filter("whole")).unionByName(_report(others))
