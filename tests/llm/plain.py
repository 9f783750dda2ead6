"""What the operators should give, in plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ANY_CASE = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in KEYWORDS
)
SECRETS = (
    ("assign", rf"""({ANY_CASE})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(text: str | None) -> tuple:
    found, counts = [], []
    for rank, (kind, pattern, group, least) in enumerate(SECRETS):
        held = [m for m in re.finditer(pattern, text or "") if len(m.group(group)) >= least]
        counts.append(len(held))
        found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in held]
    return *counts, digest(",".join(s for _, _, s in sorted(found)))


def quality(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(repeated),
        len(words) < 10 or 100 * len(repeated) > 20 * len(words),
    )


def benchmark_windows(items) -> dict:
    found = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        size = min(13, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            found[tuple(words[i : i + size])].add(item)
    return found


def contamination(text: str | None, windows: dict) -> tuple:
    words = ALNUM.findall((text or "").translate(LOWER))
    hit, items = set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            if held := windows.get(tuple(words[i : i + size])):
                hit.update(range(i, i + size))
                items |= held
    names = sorted(map(str, items))
    return len(words), len(hit), len(items), names, len(hit) > 0 and 20 * len(hit) >= len(words)


def chat(rows: list[tuple]) -> tuple:
    rows = [(t, r or "", x or "") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    said = "".join(f"{r}\n{x}\n" for _, r, x in rows)
    loss = "".join(x for _, r, x in rows if r == "assistant")
    return len(rows), digest(said), len(loss), digest(loss)


def quotas(weights: list[int], seats: int) -> list[int]:
    """Sainte-Laguë, a seat at a time; ties to the first."""
    won = [0] * len(weights)
    for _ in range(seats):
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


def targets(sizes: list[int], weights=(3, 1, 2), share=1.5, cap=2.0) -> list[float]:
    """Shares by weight, the excess over the caps dealt again until there is none."""
    total = share * sum(sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    capped: set[int] = set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(cap * sizes[i] for i in capped)
        parts = sum(weight[i] for i in free)
        now = [cap * sizes[i] if i in capped else left * weight[i] / parts for i in range(len(sizes))]
        over = {i for i in free if now[i] > cap * sizes[i]}
        if not over:
            return now
        capped |= over
        if len(capped) == len(sizes):
            return [cap * s for s in sizes]
