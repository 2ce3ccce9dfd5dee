"""Cheapest repair of conversations whose turns are blank, repeated, cut off or out of order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import named

# What an edit costs, and what a turn that stays cut off adds.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
ROLES = ("user", "assistant")
ENDS = ".!?"
_BLANKS = " \t\n\x0b\x0c\r"

#: States are what has been said last: nothing, system, user, assistant. What must follow each,
#: and where a turn leads from each state if it stays with its role's initial (none, s, u, a).
_FOLLOWS = np.array([2, 2, 3, 2])
_STAYS = np.array([[-1, -1, -1, -1], [1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1]])
_NEVER = 1 << 40
#: Edits in ASCII order; the end of an audit comes before all of them.
EDITS = "DIKR"

RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, roles array<string>, texts array<string>"
)


def repair_turns(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: faults, least cost, its edits, and the repaired turns.

    Turns come by number, null first, ties by role and text. A turn's first fault counts: blank,
    a repeat of role and text, or cut off (its last character is no ``.!?``). Repaired roles
    read ``(s?(ua)+)?`` by their initials. Keep is free, Rerole (user or assistant) costs 3, Delete 4
    and is a must for blank and repeated turns, Insert (an empty one) 3; cut-off turns that stay
    cost 3. ``audit`` has the initials of the cheapest edits, of equal ones the least in ASCII.
    ``gaps`` are the missing numbers between the first and the last turn; ``illegal`` counts
    neighbours other than su, ua and au before the repair.

    Null roles and texts are one space, conversations without a number are one, other columns are
    left out, and no row gives no row. A turn of an empty role has no initial and cannot be kept as it
    is. A conversation is one value of the result and must
    fit a worker; of the others a worker holds a batch at a time.
    """
    order = ["has_id", "conv_id", "has_turn", "turn", "role", "text"]
    # Numbers come without nulls, which pandas would turn into rounded ones.
    rows = turns.select(
        named(conversation).isNotNull().alias("has_id"), named(turn).isNotNull().alias("has_turn"),
        *[F.coalesce(named(c).cast("long"), F.lit(0)).alias(name)
          for c, name in ((conversation, "conv_id"), (turn, "turn"))],
        *[F.coalesce(named(c), F.lit(" ")).alias(name) for c, name in ((role, "role"), (text, "text"))])
    dealt = rows.repartition("has_id", "conv_id").sortWithinPartitions(*order)
    return dealt.mapInPandas(_repaired, RESULT)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with known faults, chosen by a hash of conversation and turn.

    Of twenty turns about one is dropped, one emptied, one loses its ``.!?``, one is there
    twice and one becomes the user's. Nulls are one space.
    """
    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn"))) % 20
    text = F.when(F.col("fault") == 1, "").when(
        F.col("fault") == 2, F.regexp_replace(shown("text"), f"[{ENDS}]", "")).otherwise(shown("text"))
    role = F.when(F.col("fault") == 4, ROLES[0]).otherwise(shown("role"))
    times = F.when(F.col("fault") == 3, 2).otherwise(1)
    return turns.withColumn("fault", fault).where("fault <> 0").select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.explode(F.sequence(F.lit(1), times)).alias("copy")).drop("copy")


def best_edits(starts: np.ndarray, initials: np.ndarray, must_go: np.ndarray,
               cut_off: np.ndarray) -> tuple[np.ndarray, list[bytes], list[np.ndarray]]:
    """Costs, audits and states after each edit of conversations that follow one another.

    ``starts`` are the first rows of the conversations, and the end. Costs of finishing come
    first, from the last turn backwards, all conversations at once. Arcs that reach them
    are optimal; each leads to a node (turn, state). Nodes are then ranked by the first letter
    of their least audit, by the first two, four and so on, from the ranks of a node and of the
    one that half the length leads to. Ranks pick every node's arc, and the path of a
    conversation grows by pointers over 1, 2, 4 ... edits. Optimal arcs of one node never
    share a letter, since an edit leaves no choice of the next state.
    """
    groups, n = len(starts) - 1, len(initials)
    sizes = np.diff(starts)
    begins = starts[:-1] + np.arange(groups)  # a position more than turns in each conversation
    ends = begins + sizes
    row_of = np.zeros(n + groups, np.int64)  # the turn that stands at a position
    at_row = np.arange(n) + np.repeat(np.arange(groups), sizes)
    row_of[at_row] = np.arange(n)
    left = np.full((n + groups, 4), _NEVER)  # least cost to finish
    left[ends] = [0, 2 * INSERT, INSERT, 0]
    stays = _STAYS[initials]
    extra = np.where(cut_off, CUT_OFF, 0)

    def arcs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Costs of Delete, Keep and Rerole at positions that have a turn."""
        row, after = row_of[at], left[at + 1]
        goes = np.where(must_go[row], _NEVER, extra[row])[:, None]
        kept = np.where(stays[row] < 0, _NEVER, np.take_along_axis(after, np.maximum(stays[row], 0), 1))
        return DELETE + after, goes + kept, goes + REROLE + after[:, _FOLLOWS]

    by_size = np.argsort(-sizes, kind="stable")
    open_ = np.searchsorted(-sizes[by_size], -np.arange(1, sizes.max(initial=0) + 1), side="right")
    for step, many in enumerate(open_, 1):
        at = ends[by_size[:many]] - step
        best = np.minimum.reduce(arcs(at))
        for states in ([2, 3], [0, 1]):  # an insertion leads to another state of the same position
            best[:, states] = np.minimum(best[:, states], INSERT + best[:, _FOLLOWS[states]])
        left[at] = best

    nodes = 4 * (n + groups)
    letter, pointer = np.zeros(nodes, np.int64), np.arange(nodes)
    here = np.arange(n + groups)[:, None] * 4
    options = [np.full((n + groups, 4), _NEVER) for _ in EDITS]
    targets = [here + 4 + np.arange(4), here + _FOLLOWS, here + 4, here + 4 + _FOLLOWS]
    options[0][at_row], options[2][at_row], options[3][at_row] = arcs(at_row)
    options[1] = INSERT + left[:, _FOLLOWS]
    targets[2] = np.broadcast_to(targets[2], (n + groups, 4)).copy()
    targets[2][at_row] += np.maximum(stays, 0)
    flat = [(cost.ravel() == left.ravel(), target.ravel()) for cost, target in zip(options, targets)]
    for code in range(len(EDITS), 0, -1):
        optimal, target = flat[code - 1]
        letter[optimal], pointer[optimal] = code, target[optimal]

    longest = int((left[begins, 0] // INSERT).max(initial=0) + sizes.max(initial=0)) + 1
    rank, jump, reach = letter, pointer, 1
    while reach < longest:
        rank = np.unique(rank << 32 | rank[jump], return_inverse=True)[1]
        jump, reach = jump[jump], 2 * reach
    least = np.full(nodes, np.iinfo(np.int64).max)
    for code, (optimal, target) in enumerate(flat, 1):
        key = np.where(optimal, code << 32 | rank[np.minimum(target, nodes - 1)], least)
        pointer = np.where(key < least, target, pointer)
        least = np.minimum(key, least)

    path, conversation, jump, reach = begins * 4, np.arange(groups), pointer, 1
    step = np.zeros(groups, np.int64)
    while reach < longest:
        path, step = np.concatenate([path, jump[path]]), np.concatenate([step, step + reach])
        conversation = np.concatenate([conversation, conversation])
        going = letter[path] > 0
        path, step, conversation = path[going], step[going], conversation[going]
        jump, reach = jump[jump], 2 * reach
    order = np.lexsort((step, conversation))
    path = path[order]
    bounds = np.searchsorted(conversation[order], np.arange(1, groups))
    codes = np.frombuffer(b" " + EDITS.encode(), np.uint8)[letter[path]]
    audits = [part.tobytes() for part in np.split(codes, bounds)]
    return left[begins, 0], audits, np.split(pointer[path] % 4, bounds)


def _faults(keys: list[tuple], roles: list[str], texts: list[str]) -> tuple[np.ndarray, ...]:
    seen: set[tuple] = set()
    blank, again, cut_off = (np.zeros(len(texts), bool) for _ in range(3))
    for i, said in enumerate(zip(keys, roles, texts)):
        tail = texts[i].rstrip(_BLANKS)[-1:]
        blank[i], again[i] = not tail, said in seen
        cut_off[i] = tail not in ENDS
        seen.add(said)
    again &= ~blank
    return blank, again, cut_off & ~blank & ~again


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = _starts(held)[-2] if len(held) else 0
        if last:  # the last conversation may go on
            yield _of_whole(held.iloc[:last].reset_index(drop=True))
            held = held.iloc[last:].reset_index(drop=True)
    if held is not None and len(held):
        yield _of_whole(held)


def _starts(df: pd.DataFrame) -> np.ndarray:
    """First rows of conversations, and the end."""
    ids, known = df["conv_id"].to_numpy(), df["has_id"].to_numpy()
    return np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (known[1:] != known[:-1]), True])


def _of_whole(df: pd.DataFrame) -> pd.DataFrame:
    starts = _starts(df)
    sizes = np.diff(starts)
    group = np.repeat(np.arange(len(sizes)), sizes)
    roles, texts = df["role"].tolist(), df["text"].tolist()
    blank, again, cut_off = _faults(group.tolist(), roles, texts)
    first = [role[:1] for role in roles]
    initials = np.array(["sua".find(c) + 1 if c else 0 for c in first])
    costs, audits, states = best_edits(starts, initials, blank | again, cut_off)

    def total(flags: np.ndarray) -> np.ndarray:
        return np.bincount(group, flags, len(sizes)).astype(np.int64)

    legal = np.array([a + b in ("su", "ua", "au") for a, b in zip(first, first[1:])] + [True])
    inside = np.r_[group[1:] == group[:-1], False]
    numbers = pd.DataFrame({"group": group, "turn": df["turn"]})[df["has_turn"].to_numpy()].groupby("group")["turn"]
    gaps = (numbers.max() - numbers.min() + 1 - numbers.nunique()).reindex(range(len(sizes)), fill_value=0)
    said = [_apply(audit, after, roles[lo:], texts[lo:hi]) for audit, after, lo, hi in zip(
        audits, states, starts[:-1], starts[1:])]
    heads = df.iloc[starts[:-1]]
    return pd.DataFrame({
        "conv_id": pd.array(heads["conv_id"], "Int64"), "gaps": gaps.to_numpy(np.int64),
        "blank": total(blank), "duplicate": total(again), "truncated": total(cut_off),
        "illegal": total(~legal & inside), "cost": costs, "audit": [a.decode() for a in audits],
        "roles": [x[0] for x in said], "texts": [x[1] for x in said],
    }).assign(conv_id=lambda made: made["conv_id"].where(heads["has_id"].to_numpy()))


def _apply(audit: bytes, states: np.ndarray, roles: list[str], texts: list[str]) -> tuple[list, list]:
    new_roles, new_texts, at = [], [], 0
    for edit, state in zip(audit.decode(), states.tolist()):
        if edit != "D":
            new_roles.append(roles[at] if edit == "K" else ROLES[state - 2])
            new_texts.append("" if edit == "I" else texts[at])
        at += edit != "I"
    return new_roles, new_texts
