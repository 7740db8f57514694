"""Repair of conversation structure by generalised LR parsing.

A conversation is a string of role initials that should read ``(s?(ua)+)?``.  Turns may be kept, deleted, given another
role, or inserted, each at a weight, and the cheapest edits win.  The parser is a generalised LR one: it keeps every viable
stack as a graph of nodes, each with the LR state on top and a link to the node below.  Of nodes with equal tops, which
read the same rest of the input, only the one with the least (cost, audit) is kept, so there are never more tops than states.

Spark brings a conversation's rows together in order; a task reads them as a stream.  As soon as all tops agree on the
first edits, these are settled and applied, so a task holds neither a whole conversation nor a whole partition.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from os.path import commonprefix
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: LR tables of: conversation -> nothing | turns | s turns;  turns -> u a | turns u a.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 5, (3, "u"): 6, (4, "u"): 6, (6, "a"): 7}
REDUCE = {5: 2, 7: 3}  # state: how many symbols the finished rule has; both rules make "turns"
TURNS = {0: 3, 1: 4}  # state below: state after "turns"
ACCEPT = {0, 3, 4}
ROLES = {"u": "user", "a": "assistant"}

NONE, BLANK, DUPLICATE, TRUNCATED = range(4)  # faults
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5  # weights; an undeleted truncated turn costs UNFINISHED more
#: No top costs more to finish than another by this: two insertions lead to where it can read all that the other still can,
#: but for one system turn to delete.  Dearer tops cannot win.
SPAN = 2 * INSERT + DELETE
SETTLE = 64  # edits after which tops are asked what they agree on


class Node(NamedTuple):
    """A top of the graph: its state, the node below, and the cheapest edits that lead to it."""

    cost: int
    audit: str
    state: int
    below: Node | None


def shifted(node: Node, symbol: str, cost: int, letter: str) -> Node | None:
    """The top after reading ``symbol`` by an edit, with finished rules reduced; None if the grammar forbids it."""
    state = SHIFT.get((node.state, symbol))
    if state is None:
        return None
    cost, audit, below = node.cost + cost, node.audit + letter, node
    while state in REDUCE:
        for _ in range(REDUCE[state] - 1):  # the symbol just read is not a node yet
            below = below.below
        state = TURNS[below.state]
    return Node(cost, audit, state, below)


def merge(tops: dict[int, Node], node: Node | None) -> bool:
    """Keep the least of nodes with equal tops."""
    if node is None or (node.state in tops and tops[node.state][:2] <= node[:2]):
        return False
    tops[node.state] = node
    return True


def inserted(tops: dict[int, Node]) -> dict[int, Node]:
    """``tops`` and what insertions reach from them."""
    todo = deque(tops.values())
    while todo:
        node = todo.popleft()
        for symbol in ROLES:
            new = shifted(node, symbol, INSERT, "I")
            if merge(tops, new):
                todo.append(new)
    return tops


class Parser:
    """The edits of one conversation, fed turn by turn.  ``applied`` gets (letter, role, text), text null if inserted."""

    def __init__(self, applied: Callable[[str, str, str | None], None]):
        self.tops = inserted({0: Node(0, "", 0, None)})
        self.settled: list[str] = []
        self.waiting: deque[tuple[str, str]] = deque()  # turns whose edits are not settled
        self.replay = Node(0, "", 0, None)
        self.applied = applied
        self.turns = 0

    def feed(self, role: str, text: str, fault: int) -> None:
        tops: dict[int, Node] = {}
        more = UNFINISHED if fault == TRUNCATED else 0
        for node in self.tops.values():
            merge(tops, Node(node.cost + DELETE, node.audit + "D", node.state, node.below))
            if fault not in (BLANK, DUPLICATE):
                merge(tops, shifted(node, role[:1], more, "K"))
                for symbol in ROLES:
                    merge(tops, shifted(node, symbol, REROLE + more, "R"))
        tops = inserted(tops)
        least = min(node.cost for node in tops.values())
        self.tops = {s: node for s, node in tops.items() if node.cost <= least + SPAN}
        self.waiting.append((role, text))
        self.turns += 1
        if not self.turns % SETTLE:
            agreed = commonprefix([node.audit for node in self.tops.values()])
            self.settle(agreed)
            cut = len(agreed)
            self.tops = {s: node._replace(audit=node.audit[cut:]) for s, node in self.tops.items()}

    def settle(self, letters: str) -> None:
        self.settled.append(letters)
        for letter in letters:
            role, text = ("", None) if letter == "I" else self.waiting.popleft()
            if letter == "D":
                self.applied(letter, role, text)
                continue
            if letter == "K":
                symbol = role[:1]
            else:  # in any state the grammar goes on with one of the two
                symbol = next(x for x in ROLES if (self.replay.state, x) in SHIFT)
                role = ROLES[symbol]
            self.replay = shifted(self.replay, symbol, 0, "")
            self.applied(letter, role, text)

    def end(self) -> tuple[int, str]:
        """(cost, audit) of the whole conversation."""
        best = min(node for state, node in self.tops.items() if state in ACCEPT)
        self.settle(best.audit)
        return best.cost, "".join(self.settled)


def _ordered(conversations: DataFrame, present: Column | None) -> DataFrame:
    """Rows of each conversation together and by turn, with their faults; absent ones only name their conversation.

    Words are runs of anything but space and \\t to \\r.  Repeats are numbered over (conversation, role, text), which
    spreads a long conversation; its rows then come to one task, as its digest is of one stream, sorted by Spark.
    """
    there = F.coalesce(present, F.lit(False)) if present is not None else F.lit(True)
    rows = conversations.select(
        F.col("conv_id").alias("conv"),
        F.when(there, F.col("turn").cast("long")).alias("turn"),
        F.when(there, F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(there, F.coalesce("text", F.lit(" "))).alias("text"),
        there.alias("there"),
    )
    first = Window.partitionBy("conv", "role", "text", "there").orderBy(F.asc_nulls_first("turn"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
        .when(F.col("place") > 1, DUPLICATE)
        .when(~last.isin(".", "!", "?"), TRUNCATED)
        .otherwise(NONE)
    )
    rows = rows.withColumn("place", F.row_number().over(first)).withColumn("fault", fault.cast("int")).drop("place")
    order = ["conv", F.asc_nulls_first("turn"), "role", "text"]
    return rows.repartition("conv").sortWithinPartitions(*order).select("conv", "turn", "role", "text", "there", "fault")


class Typed:
    """Batches, and the type of their first column once one was read."""

    def __init__(self, batches):
        self.batches, self.kind = batches, None

    def __iter__(self):
        for batch in self.batches:
            self.kind = batch.schema.field(0).type
            yield batch


def _runs(batches) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conversation, its rows) of sorted rows; each run is to be read to its end before the next is asked for."""

    def rows():
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield from zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns), strict=True)

    stream = rows()
    head = next(stream, None)

    def run(name):
        nonlocal head
        while head is not None and head[0] == name:
            row, head = head, next(stream, None)
            yield row

    while head is not None:
        yield head[0], run(head[0])


def repair(conversations: DataFrame, present: Column | None = None) -> DataFrame:
    """Per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of the repaired turns.

    Rows are taken by turn, null turns first, equal turns by role and text.  Null roles and texts count as one space; a null
    conv_id names a conversation like any other.  Rows for which ``present`` is not true take no part, but their conversation
    is returned: without rows it has zeros, no edits and the digest of the empty string.  A row's first fault counts: blank,
    duplicate (role and text seen earlier), truncated (no ``.``, ``!`` or ``?`` at its end).  Repeated rows are duplicates.  A
    role can be kept if its first letter is s, u or a; an empty role cannot.  Texts may have any length and conversations any
    number of turns.  Other columns are ignored, whatever they are called; an empty table gives no rows.
    """
    kind = conversations.select("conv_id").schema[0].dataType.simpleString()
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def work(batches):
        first = Typed(batches)
        out: list[tuple] = []

        def cut():
            types = [first.kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv_id", *longs, "audit", "repaired_sha256"])

        for conv, rows in _runs(first):
            out.append((conv, *_verdict(rows)))
            if len(out) >= 1000:
                yield cut()
        if out:
            yield cut()

    schema = f"conv_id {kind}, {', '.join(f'{x} long' for x in longs)}, audit string, repaired_sha256 string"
    return _ordered(conversations, present).mapInArrow(work, schema)


def _verdict(rows) -> tuple:
    digest, some = hashlib.sha256(), False
    counts, illegal, before = [0] * 4, 0, None
    low = high = None
    distinct = 0

    def applied(letter: str, role: str, text: str | None) -> None:
        nonlocal some
        if letter != "D":
            digest.update(f"{chr(10) if some else ''}{role}:{text or ''}".encode("utf-8", "surrogatepass"))
            some = True

    parser = Parser(applied)
    for _, turn, role, text, there, fault in rows:
        if not there:
            continue
        counts[fault] += 1
        illegal += before is not None and before + role[:1] not in ("su", "ua", "au")
        before = role[:1]
        if turn is not None:
            distinct += turn != high  # turns come in order
            low, high = turn if low is None else low, turn
        parser.feed(role, text, fault)
    cost, audit = parser.end()
    gaps = high - low + 1 - distinct if distinct else 0
    return gaps, *counts[1:], illegal, cost, audit, digest.hexdigest()


def repaired_turns(conversations: DataFrame, present: Column | None = None) -> DataFrame:
    """The turns themselves: conv_id, place (from 0), edit (K, R, D or I), role and text; deleted turns have null places.

    Conversations, order and nulls as in ``repair``; inserted turns have empty texts.
    """
    kind = conversations.select("conv_id").schema[0].dataType.simpleString()

    def work(batches):
        first = Typed(batches)
        for conv, rows in _runs(first):
            out: list[tuple] = []
            place = -1

            def applied(letter, role, text, out=out, conv=conv):
                nonlocal place
                place += letter != "D"
                out.append((conv, None if letter == "D" else place, letter, role, text or ""))

            def cut(out=out):
                types = [first.kind, pa.int64(), pa.string(), pa.string(), pa.string()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), types, strict=True)]
                out.clear()
                return pa.RecordBatch.from_arrays(columns, ["conv_id", "place", "edit", "role", "text"])

            parser = Parser(applied)
            for _, _, role, text, there, fault in rows:
                if there:
                    parser.feed(role, text, fault)
                    if len(out) >= 1000:
                        yield cut()
            parser.end()
            if out:
                yield cut()

    return _ordered(conversations, present).mapInArrow(work, f"conv_id {kind}, place long, edit string, role string, text string")
