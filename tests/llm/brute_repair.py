"""Conversation repair, written plainly: all states forwards, row by row,
with the audit itself as part of what is compared."""

import hashlib
import zlib

FROM = {"": "u", "s": "u", "u": "a", "a": "u"}
NAME = {"u": "user", "a": "assistant"}
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (2 if fault == 3 else 1)
    return out


def inserted(ways):
    """Ways with up to two turns inserted; the better of each state stays."""
    best = dict(ways)
    for _ in range(2):
        for state, (cost, audit, lines) in list(best.items()):
            to = FROM[state]
            new = (cost + 2, audit + "I", [*lines, NAME[to] + ":"])
            if to not in best or new[:2] < best[to][:2]:
                best[to] = new
    return best


def repaired(rows):
    """Cheapest, then least audit: (counts, cost, audit, lines) of ordered (turn, role, text)."""
    seen, ways = set(), {"": (0, "", [])}
    blank = duplicate = truncated = 0
    for _turn, role, text in rows:
        body = text.rstrip(SPACES)
        must = False
        cut = 0
        if not body:
            blank, must = blank + 1, True
        elif (role, text) in seen:
            duplicate, must = duplicate + 1, True
        elif body[-1] not in ".!?":
            truncated, cut = truncated + 1, 1
        seen.add((role, text))
        new = {}

        def put(state, way):
            if state not in new or way[:2] < new[state][:2]:
                new[state] = way

        for state, (cost, audit, lines) in (ways if must else inserted(ways)).items():
            put(state, (cost + 3, audit + "D", lines))
            if must:
                continue
            first = role[:1]
            if first and first in ({"": "su", "s": "u", "u": "a", "a": "u"}[state]):
                put(first, (cost + cut, audit + "K", [*lines, f"{role}:{text}"]))
            to = FROM[state]
            put(to, (cost + 2 + cut, audit + "R", [*lines, f"{NAME[to]}:{text}"]))
        ways = new
    ways = inserted(ways)
    cost, audit, lines = min((w for s, w in ways.items() if s in ("", "a")), key=lambda w: w[:2])
    return (blank, duplicate, truncated), cost, audit, lines


def brute(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)}"""
    out = {}
    for conv, own in damaged(rows).items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        firsts = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        (blank, duplicate, truncated), cost, audit, lines = repaired(own)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)
    return out
