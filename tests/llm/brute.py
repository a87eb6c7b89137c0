"""Plain recomputations that tests hold operators against."""

import hashlib
import math
import re
from collections import defaultdict

import numpy as np


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(found[k : k + words]) for k in range(len(found) - words + 1)} if len(found) >= words else ({tuple(found)} if found else set())


def likelihoods(model, text):
    """Log likelihood of a text under each language, and its number of trigrams, trigram by trigram."""
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    logs = np.zeros(len(model.languages))
    for k in range(len(data) - 2):
        code = (data[k] << 16) | (data[k + 1] << 8) | data[k + 2]
        logs += model.weights[((code * 0x9E3779B1) & 0xFFFFFFFF) >> 16]
    return logs, max(0, len(data) - 2)


def softmax(x):
    e = np.exp(x - x.max())
    return e / e.sum()


def fusion(rows, model):
    """(language, probability, mean log likelihood of its trigrams) of each (declared, suffix, host, site, text)."""
    n = len(model.languages)
    logs = [likelihoods(model, r[4]) for r in rows]
    texts = [x * (min(60, grams) / max(grams, 1)) for x, grams in logs]
    chances = [softmax(x) for x in texts]
    sums = sum(chances) + 1.0
    prior = sums / sums.sum()
    counts = [defaultdict(lambda: np.zeros(n)) for _ in range(4)]
    for row, p in zip(rows, chances, strict=True):
        for place in range(4):
            if row[place] is not None:
                counts[place][row[place]] = counts[place][row[place]] + p
    out = []
    for row, text, p, (whole, grams) in zip(rows, texts, chances, logs, strict=True):
        total = text.copy()
        for place in (0, 1):
            if row[place] is not None:
                total += np.log((counts[place][row[place]] + 1 / n) / (sums + 1))
        own = lambda place: np.maximum(0, counts[place][row[place]] - p) if row[place] is not None else np.zeros(n)  # noqa: B023, E731
        site = (own(3) + 20 * prior) / (own(3).sum() + 20)
        total += np.log((own(2) + 4 * site) / (own(2).sum() + 4))
        posterior = softmax(total)
        best = int(posterior.argmax())
        out.append((model.languages[best], float(posterior[best]), whole[best] / grams if grams else None))
    return out


def mixed(rows, seed=17, limit=3):
    """How often each (id, source, text) is taken, and the shares of its source's target at which its copies come."""
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for _, _, text in rows]
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s))
    whole = {s: sum(n for n, r in zip(sizes, rows, strict=True) if r[1] == s) for s in names}
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    target, left, free = {}, float(sum(sizes)), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > limit * whole[s]}
        target |= {s: limit * whole[s] if over else weight[s] * level for s in over or free}
        left -= sum(limit * whole[s] for s in over)
        free = free - over if over else set()
    out = [0] * len(rows)
    for s in names:
        before = 0
        order = sorted((k for k in range(len(rows)) if rows[k][1] == s), key=lambda k: (hashlib.md5(f"{seed}:{'' if rows[k][0] is None else rows[k][0]}:{hashlib.md5((rows[k][2] or '').encode()).hexdigest()}".encode()).hexdigest(), rows[k][0] or 0, sizes[k]))
        for k in order:
            middle = before + sizes[k] / 2
            out[k] = sum(middle + c * whole[s] <= target[s] for c in range(limit)) if sizes[k] else 0
            before += sizes[k]
    return out, {s: (whole[s], target[s]) for s in names}


assert math.isclose(sum(softmax(np.zeros(4))), 1)
