"""Conversations brought back into order by their cheapest edits, found with a search from both ends.

A conversation is in order if its roles read: an optional system turn, then user and assistant in turn, at least once; or
if it is empty. The edit lattice has a node for every row boundary and state of that pattern, and an edge for every edit:
``K`` keeps a row, ``R`` gives it the role that is due, ``D`` deletes it, ``I`` inserts an empty turn of the role that is due.
Two heaps settle nodes from the start and from the ends. When their least costs together pass the best crossing, every
cheapest path leads over an edge between settled nodes of both sides; of those the least audit is read off.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.llm.common import map_arrow
from citygrain.scale import cut_lineage, join_on

#: White space that makes a text blank.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"

#: Characters a whole text ends with.
ENDS = ".!?"

#: Costs of the edits; a row that ends without a mark costs one more unless it is deleted.
RENAME, DELETE, INSERT, UNFINISHED = 2, 3, 2, 1

#: States of the pattern: nothing yet, system, user, assistant; the state that the role due next leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
DUE = (USER, USER, ASSISTANT, USER)
BEFORE = ((), (), (START, SYSTEM, ASSISTANT), (USER,))
NAMES = {USER: "user", ASSISTANT: "assistant"}
_INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}

#: Faults of a row.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)


class Lattice:
    """The edits of one conversation. Node ``4 * i + q``: the first i rows are done, the state is q."""

    def __init__(self, initials: list[str], faults: list[int]):
        self.kept = [_INITIALS.get(c, START) for c in initials]
        self.must_go = [f in (BLANK, DUPLICATE) for f in faults]
        self.extra = [UNFINISHED if f == TRUNCATED else 0 for f in faults]
        self.rows = len(initials)

    def keeps(self, row: int, state: int) -> bool:
        role = self.kept[row]
        return role == DUE[state] or role == SYSTEM and state == START

    def edits(self, node: int) -> Iterator[tuple[str, int, int]]:
        """Letter, cost and next node, in the order of the letters."""
        i, q = divmod(node, 4)
        if i < self.rows:
            yield "D", DELETE, node + 4
        yield "I", INSERT, node - q + DUE[q]
        if i < self.rows and not self.must_go[i]:
            if self.keeps(i, q):
                yield "K", self.extra[i], node - q + 4 + self.kept[i]
            yield "R", RENAME + self.extra[i], node - q + 4 + DUE[q]

    def back(self, node: int) -> Iterator[tuple[int, int]]:
        """Cost and node of every edit that leads to this one."""
        i, q = divmod(node, 4)
        base = node - q
        for p in BEFORE[q]:
            yield INSERT, base + p
        if not i:
            return
        yield DELETE, node - 4
        if self.must_go[i - 1]:
            return
        for p in BEFORE[q]:
            yield RENAME + self.extra[i - 1], base - 4 + p
        if q != START and self.kept[i - 1] == q:
            for p in (START,) if q == SYSTEM else BEFORE[q]:
                yield self.extra[i - 1], base - 4 + p

    def cheapest(self) -> tuple[int, str]:
        """The least cost and the least audit of that cost.

        Edits that cost nothing lead to a later row, so nodes of equal cost are taken in the order of their rows, from
        either end: a node is settled only when nothing can better it.
        """
        last = 4 * self.rows
        ahead, behind = {0: 0}, {last + START: 0, last + ASSISTANT: 0}
        out, home = [(0, 0)], [(0, -node) for node in behind]
        heapq.heapify(home)
        settled: list[int] = []
        reached: set[int] = set()
        done: set[int] = set()
        best = behind.get(0, 1 << 60)
        # both ends are settled first, so that every path leaves the one side and enters the other
        while out and home and (len(reached) < 2 or out[0][0] + home[0][0] <= best):
            if len(reached) >= 2 and out[0][0] <= home[0][0]:
                cost, node = heapq.heappop(out)
                if node in done:
                    continue
                done.add(node)
                settled.append(node)
                for _, more, then in self.edits(node):
                    total = cost + more
                    if total < ahead.get(then, 1 << 60):
                        ahead[then] = total
                        heapq.heappush(out, (total, then))
                    if then in behind:
                        best = min(best, total + behind[then])
            else:
                cost, node = heapq.heappop(home)
                node = -node
                if node in reached:
                    continue
                reached.add(node)
                for more, prior in self.back(node):
                    total = cost + more
                    if total < behind.get(prior, 1 << 60):
                        behind[prior] = total
                        heapq.heappush(home, (total, -prior))
                    if prior in ahead:
                        best = min(best, total + ahead[prior])
        return best, self._least(best, ahead, behind, settled, reached)

    def _least(self, best: int, ahead: dict, behind: dict, settled: list[int], reached: set[int]) -> str:
        """The least audit over all crossings.

        The letters tell the way, so audits of one cost that end in one node are no beginnings of each other:
        the least whole is the least letter at every step among edits that lie on a cheapest path.
        """

        def crosses(cost: int, then: int) -> bool:
            return then in reached and cost + behind[then] == best

        useful: set[int] = set()
        for node in reversed(settled):
            cost = ahead[node]
            for _, more, then in self.edits(node):
                if crosses(cost + more, then) or then in useful and ahead[then] == cost + more:
                    useful.add(node)
                    break
        audit, node, cost = [], 0, 0
        while cost < best or node not in (4 * self.rows + START, 4 * self.rows + ASSISTANT):
            for letter, more, then in self.edits(node):
                if crosses(cost + more, then) or then in useful and ahead[then] == cost + more:
                    audit.append(letter)
                    node, cost = then, cost + more
                    break
            else:
                raise AssertionError("no cheapest path goes on")
        return "".join(audit)


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with planted faults, decided by the CRC-32 of ``conv_id:turn``.

    Of twenty remainders 0 drops the row, 1 empties its text, 2 takes its sentence marks, 3 repeats it, 4 makes it the user's.
    A null counts as one space in the key, the role and the text; the id and the turn themselves stay null.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(
        "conv_id",
        "turn",
        blank("role").alias("role"),
        blank("text").alias("text"),
        (F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20).alias("_d"),
    ).where("_d <> 0")
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("_d") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("_d") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_c")).drop("_c")


#: The order of rows in a conversation: by turn, null first; rows of one turn by role and digest of the text.
ORDER = ("turn", "role", "digest")


def _ordered(turns: DataFrame) -> DataFrame:
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), filled("role").alias("role"), filled("text").alias("text"))
    return rows.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))


def _first_faults(roles: list[str], digests: list[bytes], blank: list[bool], cut: list[bool]) -> list[int]:
    n = len(roles)
    codes: dict[str, int] = {}
    role = np.array([codes.setdefault(r, len(codes)) for r in roles], np.int64)
    halves = np.frombuffer(b"".join(digests), np.int64).reshape(n, 2)
    order = np.lexsort((np.arange(n), halves[:, 1], halves[:, 0], role))
    same = (np.diff(role[order]) == 0) & (np.diff(halves[order], axis=0) == 0).all(axis=1)
    again = np.zeros(n, bool)
    again[order[1:]] = same
    return np.where(blank, BLANK, np.where(again, DUPLICATE, np.where(cut, TRUNCATED, FINE))).tolist()


AUDIT = "n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(turns: DataFrame) -> DataFrame:
    """conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost, audit: one row per conversation of ``turns``.

    A row's first fault counts: blank, then a repetition of an earlier role and text, then a text whose last character
    that is not white space is no sentence mark. ``gaps`` are whole turns missing between the least and the largest, ``illegal``
    neighbours whose initials are not su, ua or au. Nulls in role and text count as one space; rows with a null id are one
    conversation; null turns come first; rows of one turn are ordered by role and digest of the text. A role without
    letters or with another initial can't be kept. Extra columns are not read.

    Only initials, flags and digests of rows travel here, about 50 bytes a row, whatever the length of the texts; a
    conversation is the unit that one task must hold.
    """
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    narrow = _ordered(turns).select(
        "conv_id", "turn", "role", "digest", (last == "").alias("blank"), (~last.isin(*ENDS)).alias("cut")
    )
    narrow = narrow.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    names = [f.split()[0] for f in AUDIT.split(", ")]
    columns = narrow.columns

    def audited(rows: list[tuple]) -> tuple:
        turn, roles, digests, blank, cut = zip(*rows)
        faults = _first_faults(roles, digests, blank, cut)
        initials = [r[:1] for r in roles]
        known = [t for t in turn if t is not None]
        gaps = known[-1] - known[0] + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = [faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
        return (len(rows), gaps, *counts, illegal, *Lattice(initials, faults).cheapest())

    def run(batches) -> Iterator[dict]:
        held: list[tuple] = []
        current = None
        for batch in batches:
            out: list[tuple] = []
            for conv, *row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if held and conv != current:
                    out.append((current, *audited(held)))
                    held = []
                current = conv
                held.append(tuple(row))
            if out:
                yield dict(zip(["conv_id", *names], map(list, zip(*out))))
        if held:
            yield {c: [x] for c, x in zip(["conv_id", *names], (current, *audited(held)))}

    return map_arrow(narrow, run, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, {AUDIT}")


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, edit, turn, role, text: the rows of every conversation after its edits, in order inside it.

    ``found`` are the :func:`audits` of the same turns. Inserted rows have no turn and an empty text. Audits travel as one row
    ahead of their conversation; texts stream through, so no conversation's texts are held.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = _ordered(turns).select("conv_id", F.lit(1).alias("part"), *ORDER, "text")
    heads = found.select(
        F.col("conv_id").cast(kind), F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"), F.lit(b"").alias("digest"), F.col("audit").alias("text"),
    )
    ordered = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", "part", *ORDER)

    def run(batches) -> Iterator[dict]:
        audit, at, state, current = "", 0, START, None

        def emit(out: list, edit: str, turn, role: str, text: str):
            nonlocal state
            state = _INITIALS.get(role[:1], START)
            out.append((current, edit, turn, role, text))

        def inserted(out: list):
            nonlocal at
            while audit[at : at + 1] == "I":
                emit(out, "I", None, NAMES[DUE[state]], "")
                at += 1

        for batch in batches:
            out: list[tuple] = []
            for conv, part, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "turn", "role", "text"))):
                if not part:
                    audit, at, state, current = text, 0, START, conv
                    inserted(out)
                    continue
                edit = audit[at]
                at += 1
                if edit != "D":
                    emit(out, edit, turn, role if edit == "K" else NAMES[DUE[state]], text)
                inserted(out)
            if out:
                yield dict(zip(("conv_id", "edit", "turn", "role", "text"), map(list, zip(*out))))

    return map_arrow(ordered, run, f"conv_id {kind}, edit string, turn long, role string, text string")


def digests(rows: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the rows as :func:`repaired` leaves them, conversation after conversation."""

    def run(batches) -> Iterator[dict]:
        current, digest = None, None
        for batch in batches:
            out: dict[str, list] = {"conv_id": [], "repaired_sha256": []}
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if digest is None or conv != current:
                    if digest:
                        out["conv_id"].append(current)
                        out["repaired_sha256"].append(digest.hexdigest())
                    current, digest = conv, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    digest.update(f"\n{role}:{text}".encode())
            yield out
        if digest:
            yield {"conv_id": [current], "repaired_sha256": [digest.hexdigest()]}

    kind = rows.schema["conv_id"].dataType.simpleString()
    return map_arrow(rows.select("conv_id", "role", "text"), run, f"conv_id {kind}, repaired_sha256 string")


def repair_report(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per distinct conv_id of ``ids``: the faults, cost and audit of its turns, and the digest of the repaired ones.

    An id without turns has zeros, an empty audit and the digest of an empty text, as has a conversation of which nothing is left.
    """
    found = cut_lineage(audits(turns))
    whole = join_on(ids.select("conv_id").distinct(), found, ["conv_id"], "left")
    whole = join_on(whole, digests(repaired(turns, found)), ["conv_id"], "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return whole.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
