"""Conversation structure repair by iterative-deepening A*.

A conversation is a sequence of turns ordered by ``turn`` (nulls first; equal turns by role,
then text). Each turn's first fault counts: ``blank`` (no character beyond space and
\\t \\n \\v \\f \\r), ``duplicate`` (role and text seen earlier in the conversation), ``truncated``
(its last such character is not one of ``.!?``).

A repair is a sequence of edits whose role initials read ``(s?(ua)+)?``: Keep (cost 0), Rerole
to user or assistant (1), Delete (2; the only edit a blank or duplicate turn allows), Insert an
empty user or assistant turn anywhere (5); a truncated turn that stays adds 5. The search is
IDA*: depth-first over states (turns consumed, place in the pattern), edits tried in ASCII
order D < I < K < R, under cost bounds that rise to the least exceeding f-value, with a table
of states that failed under the bound at some cost. The heuristic (2 for every faulty turn
left) never overestimates and is consistent, so the first path found is the cheapest, and among
the cheapest the least in ASCII order.

Spark groups the turns by conversation; one conversation is one group, since its edits are one
sequential choice over all of its turns. Everything across conversations is Spark's.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: the damage modulo and its codes, the faults, edits and costs.
DAMAGE_MOD = 20  # 0 drops the row, 1 empties its text, 2 removes [.!?], 3 repeats it, 4 sets role user
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
ENDS = ".!?"
COST = {"D": 2, "I": 5, "K": 0, "R": 1}
TRUNCATED_KEPT = 5
#: The pattern (s?(ua)+)? on role initials: states 0 (start), 1 (after s), 2 (after u), 3 (after a).
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPT = (0, 3)
ROLE_OF = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")
INFINITE = float("inf")

RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows after damage by crc32 of ``conv_id:turn`` mod 20; nulls read as one space.

    0 drops the row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it (same
    turn), 4 sets its role to ``user``. Result: ``conv_id, turn, role, text``.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    code = F.crc32(key) % DAMAGE_MOD
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    text = F.when(code == 1, F.lit("")).when(code == 2, F.regexp_replace(text, r"[.!?]", "")).otherwise(text)
    role = F.when(code == 4, F.lit("user")).otherwise(role)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                role.alias("role"), text.alias("text"), code.alias("_code")).where(F.col("_code") != 0)
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_code") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", "role", "text", copies.alias("_copy")).drop("_copy")


def faults(turns: list[tuple[str, str]]) -> list[str | None]:
    """The first fault of every turn, in order: ``blank``, ``duplicate``, ``truncated`` or None."""
    seen, found = set(), []
    for role, text in turns:
        visible = VISIBLE.findall(text)
        if not visible:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        elif visible[-1] not in ENDS:
            found.append("truncated")
        else:
            found.append(None)
        seen.add((role, text))
    return found


def search(turns: list[tuple[str, str]], found: list[str | None]) -> tuple[int, list[tuple[str, str | None]]]:
    """IDA* over edits: ``(cost, [(edit, new role or None), ...])``, cheapest and ASCII-least."""
    n = len(turns)
    forced = [f in ("blank", "duplicate") for f in found]
    truncated = [f == "truncated" for f in found]
    rest = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + (2 if found[i] else 0)

    def moves(i: int, q: int):
        insert = "u" if (q, "u") in NEXT else "a"
        if i < n:
            yield "D", COST["D"], i + 1, q, None
        yield "I", COST["I"], i, NEXT[q, insert], insert
        if i < n and not forced[i]:
            extra = TRUNCATED_KEPT if truncated[i] else 0
            initial = turns[i][0][:1]
            if (q, initial) in NEXT:
                yield "K", COST["K"] + extra, i + 1, NEXT[q, initial], None
            yield "R", COST["R"] + extra, i + 1, NEXT[q, insert], insert

    def dive(bound: float):
        if n == 0:
            return []
        failed: dict[tuple[int, int], int] = {}
        least, path, stack = INFINITE, [], [(0, 0, 0, moves(0, 0))]
        while stack:
            i, q, g, options = stack[-1]
            step = next(options, None)
            if step is None:
                stack.pop()
                failed[i, q] = min(failed.get((i, q), INFINITE), g)
                if path:
                    path.pop()
                continue
            edit, cost, i2, q2, role = step
            g2 = g + cost
            if g2 + rest[i2] > bound:
                least = min(least, g2 + rest[i2])
                continue
            if failed.get((i2, q2), INFINITE) <= g2:
                continue
            path.append((edit, role, g2))
            if i2 == n and q2 in ACCEPT:
                return path
            stack.append((i2, q2, g2, moves(i2, q2)))
        return least

    bound = rest[0]
    while True:
        found_path = dive(bound)
        if isinstance(found_path, list):
            cost = found_path[-1][2] if found_path else 0
            return cost, [(e, r) for e, r, _ in found_path]
        bound = found_path


def repair_one(turns: list[tuple[str, str]], turn_numbers: list[int | None]) -> dict:
    """Counts, cheapest repair and its hash for one conversation's damaged, ordered turns."""
    found = faults(turns)
    numbers = [t for t in turn_numbers if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    initials = [r[:1] for r, _ in turns]
    illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
    cost, edits = search(turns, found)
    lines, audit, i = [], [], 0
    for edit, role in edits:
        audit.append(edit)
        if edit == "I":
            lines.append(f"{ROLE_OF[role]}:")
            continue
        if edit == "K":
            lines.append(f"{turns[i][0]}:{turns[i][1]}")
        elif edit == "R":
            lines.append(f"{ROLE_OF[role]}:{turns[i][1]}")
        i += 1
    return {"gaps": gaps, "blank": found.count("blank"), "duplicate": found.count("duplicate"),
            "truncated": found.count("truncated"), "illegal": illegal, "cost": cost, "audit": "".join(audit),
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def _repair_group(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["_null_turn", "_turn", "role", "text"], ascending=[False, True, True, True], kind="stable")
    turns = list(zip(frame["role"], frame["text"]))
    numbers = [None if null else int(t) for null, t in zip(frame["_null_turn"], frame["_turn"])]
    out = repair_one(turns, numbers)
    return pd.DataFrame([{"conv_id": frame["conv_id"].iloc[0], **out}])


def repair_conversations(turns: DataFrame) -> DataFrame:
    """Cheapest repair of every conversation: one row per ``conv_id`` (null is one conversation).

    Columns: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. ``gaps`` counts missing turn numbers between the least and the greatest
    (nulls ignored, all null: 0); ``illegal`` counts adjacent role initials other than su, ua,
    au. Null role or text is read as empty; an empty or missing role has an empty initial and
    can only be rerolled or deleted. Repeated rows are turns like any other (the second is a
    duplicate). Extra input columns are ignored.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("_turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                        F.col("turn").isNull().alias("_null_turn"))
    return rows.groupBy("conv_id").applyInPandas(_repair_group, RESULT)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Every original conv_id after damage; one whose rows were all dropped has zeros, an empty
    audit and the hash of the empty string."""
    repaired = repair_conversations(damage(conversations))
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = ids.alias("i").join(repaired.alias("r"), F.col("i.conv_id").eqNullSafe(F.col("r.conv_id")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        F.col("i.conv_id").alias("conv_id"),
        *[F.coalesce(F.col(f"r.{c}"), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(F.col("r.audit"), F.lit("")).alias("audit"),
        F.coalesce(F.col("r.repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
