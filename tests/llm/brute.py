"""Plain forms of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def near(rows: list[tuple], width: int = 2) -> dict:
    """doc_id to (set size, smallest reachable doc_id)."""
    sets = {}
    for doc, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        w = min(width, len(words))
        sets[doc] = {tuple(words[i : i + w]) for i in range(len(words) - w + 1)} if words else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if not x or not y or 100 * min(len(x), len(y)) < 80 * max(len(x), len(y)):
                continue
            common = len(x & y)
            if 100 * common >= 80 * (len(x) + len(y) - common):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: (len(s), find(d)) for d, s in sets.items()}


def repeated_bytes(rows: list[tuple], size: int = 50) -> dict:
    """doc_id to (n_bytes, n_removed, n_spans, digest of what is left)."""
    first: dict[bytes, int] = {}
    data = {d: (t or "").encode() for d, t in rows}
    for d in sorted(data):
        for i in range(len(data[d]) - size + 1):
            first.setdefault(data[d][i : i + size], d)
    found = {}
    for d, b in data.items():
        gone = [False] * len(b)
        for i in range(len(b) - size + 1):
            if first[b[i : i + size]] < d:
                gone[i : i + size] = [True] * size
        spans = sum(g and not p for p, g in zip([False, *gone], gone))
        found[d] = (len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g)))
    return found


def repeated_words(rows: list[tuple], size: int = 20) -> dict:
    """doc_id to (n_words, n_removed, digest of the words left)."""
    words = {d: WORD.findall(t or "") for d, t in rows}
    first: dict[tuple, tuple] = {}
    for d in sorted(words):
        for i in range(len(words[d]) - size + 1):
            first.setdefault(tuple(words[d][i : i + size]), (d, i))
    found = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < (d, i):
                gone[i : i + size] = [True] * size
        found[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode()))
    return found


def packed(pieces: list[tuple], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of (size, source, cluster) in the order given: the tightest compatible bin."""
    bins: list[list] = []
    placed = []
    for size, source, cluster in pieces:
        fit = [
            (room, i)
            for i, (room, sources, clusters) in enumerate(bins)
            if room >= size and (source is None or source not in sources) and cluster not in clusters
        ]
        if not fit:
            bins.append([capacity, set(), set()])
            fit = [(capacity, len(bins) - 1)]
        room, i = min(fit)
        placed.append((i, capacity - room))
        bins[i][0] -= size
        bins[i][1].add(source)
        bins[i][2].add(cluster)
    return placed


PIECE = re.compile(r"[.,;:!?\x0A-\x0D]")


def phrases(rows: list[tuple], least: int = 100, top: int = 2000, longest: int = 5) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text)."""
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in PIECE.split((text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    found = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inner = {p[i:j] for p, a in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                 if j - i < len(p) and 100 * a >= 100 * f[p[i:j]]}
        best = []
        for p, a in often.items():
            if p not in inner:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return found


def nearest(rows: list[tuple], every: int, k: int) -> list[tuple]:
    """(query_id, rank, vec_id, score) of (vec_id, vector)."""
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    found = []
    for place, (q, x) in enumerate(good):
        if q % every:
            continue
        near = []
        for other, (vec, y) in enumerate(good):
            if other != place and len(x) == len(y):
                score = 0.0
                for a, b in zip(x, y):
                    score += a * b
                near.append((-score, vec))
        found += [(q, n, vec, -s) for n, (s, vec) in enumerate(sorted(near)[:k], 1)]
    return found


def repairs(turns: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of (initial, fault) turns, by trying all edits with up to two insertions a gap."""
    gaps = ["", "u", "a", "uu", "ua", "au", "aa"]
    best = None
    options = []
    for initial, fault in turns:
        stay = [] if fault in (1, 2) else [("K", initial, 0), ("R", "u", 2), ("R", "a", 2)]
        options.append([("D", "", 3)] + [(e, x, c + (fault == 3)) for e, x, c in stay])
    for edits in itertools.product(*options):
        for between in itertools.product(gaps, repeat=len(turns) + 1):
            roles = between[0] + "".join(x + g for (_, x, _), g in zip(edits, between[1:]))
            if re.fullmatch(r"(s?(ua)+)?", roles):
                audit = "I" * len(between[0]) + "".join(e + "I" * len(g) for (e, _, _), g in zip(edits, between[1:]))
                found = sum(c for _, _, c in edits) + 2 * sum(map(len, between)), audit
                best = found if best is None else min(best, found)
    return best


def repaired(rows: list[tuple]) -> dict:
    """conv_id to (gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of (conv_id, turn, role, text)."""
    convs: dict = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    found = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha(r[2].encode())))
        seen, turns = set(), []
        for _, role, text in own:
            last = text.rstrip("\t\n\x0b\x0c\r ")[-1:]
            turns.append((role[:1], 1 if not last else 2 if (role, text) in seen else 3 if last not in ".!?" else 0))
            seen.add((role, text))
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(turns, turns[1:]))
        heap, done = [(0, "", 0, "", [])], set()
        while heap:  # Dijkstra from the front, by cost and audit; the state is what the roles end in
            cost, audit, i, state, out = heapq.heappop(heap)
            if (i, state) in done:
                continue
            done.add((i, state))
            if i == len(turns) and state in ("", "a"):
                break
            legal = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
            new = legal[-1]
            name = {"u": "user", "a": "assistant"}[new]
            heapq.heappush(heap, (cost + 2, audit + "I", i, new, [*out, f"{name}:"]))
            if i < len(turns):
                (initial, fault), (_, role, text) = turns[i], own[i]
                heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
                if fault not in (1, 2):
                    more = cost + (fault == 3)
                    heapq.heappush(heap, (more + 2, audit + "R", i + 1, new, [*out, f"{name}:{text}"]))
                    if initial and initial in legal:
                        heapq.heappush(heap, (more, audit + "K", i + 1, initial, [*out, f"{role}:{text}"]))
        known = {r[0] for r in own if r[0] is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        faults = [sum(f == code for _, f in turns) for code in (1, 2, 3)]
        found[conv] = (gaps, *faults, illegal, cost, audit, sha("\n".join(out).encode()))
    return found
