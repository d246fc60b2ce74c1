"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = str.maketrans(UPPER, LOWER)


def lowered(text: str | None) -> str:
    return (text or "").translate(_LOWERED)


def words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lowered(text)) if w]


def shingle_set(text: str | None, n: int) -> frozenset:
    found = words(text)
    n = min(n, len(found))
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1)) if found else frozenset()


def exact_groups(docs: list[dict]) -> dict[int, tuple]:
    groups = defaultdict(list)
    for d in docs:
        groups[lowered(d["text"])].append(d["doc_id"])
    return {
        i: (max(ids), len(ids), i == max(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
        for i in ids
    }


def near_components(docs: list[dict], n: int, percent: int = 80) -> dict[int, tuple[int, int]]:
    """Set size and smallest reachable id of each document; every pair is compared."""
    sets = {d["doc_id"]: shingle_set(d["text"], n) for d in docs}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for place, i in enumerate(ids):
        for j in ids[:place]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    one, other = sorted((find(i), find(j)))
                    parent[other] = one
    return {i: (len(sets[i]), find(i)) for i in ids}


def repeated_words(docs: list[dict], least: int = 50) -> dict[int, set[int]]:
    """Places of the words of each document that lie in a run of ``least`` words which a different text has too."""
    own, first = {}, {}
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        if lowered(d["text"]) not in first:
            first[lowered(d["text"])] = d["doc_id"]
            own[d["doc_id"]] = words(d["text"])
    seen = defaultdict(set)
    for i, w in own.items():
        for p in range(len(w) - least + 1):
            seen[tuple(w[p : p + least])].add(i)
    out = defaultdict(set)
    for i, w in own.items():
        for p in range(len(w) - least + 1):
            if len(seen[tuple(w[p : p + least])]) > 1:
                out[i].update(range(p, p + least))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[-1::-2]) + sum(t - 9 if t > 9 else t for t in twice)) % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""

    def digits(value):
        return re.sub("[^0-9]", "", value)

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and _luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


def local_alignment(item: list, text: list, match=2, mismatch=-1, gap=-1) -> int:
    """The best Smith-Waterman score, cell by cell."""
    last, best = [0] * (len(text) + 1), 0
    for a in item:
        now = [0]
        for j, b in enumerate(text, 1):
            now.append(max(0, last[j - 1] + (match if a == b else mismatch), last[j] + gap, now[j - 1] + gap))
        best, last = max(best, *now), now
    return best


def edf(weights: list[int]) -> list[tuple[int, int]]:
    """``(source, block)`` slot by slot: of the blocks released by now, the one due first."""
    slots = sum(weights)
    blocks = [(i, j, j * slots // a, -(-(j + 1) * slots // a)) for i, a in enumerate(weights) for j in range(a)]
    out = []
    for t in range(slots):
        pick = min((b for b in blocks if b[2] <= t), key=lambda b: (b[3], b[0]))
        blocks.remove(pick)
        assert t < pick[3]
        out.append(pick[:2])
    return out


def repeated_runs(streams: list[list], length: int, least: int) -> list[list[bool]]:
    """Which items of each stream lie in a run of ``length`` that at least ``least`` different streams have."""
    pages = defaultdict(set)
    for s in streams:
        for p in range(len(s) - length + 1):
            pages[tuple(s[p : p + length])].add(tuple(s))
    out = []
    for s in streams:
        marks = [False] * len(s)
        for p in range(len(s) - length + 1):
            if len(pages[tuple(s[p : p + length])]) >= least:
                marks[p : p + length] = [True] * length
        out.append(marks)
    return out


