"""Plain one-machine versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def token_ids(texts: list[str | None]) -> list[np.ndarray]:
    tok = Tokenizer.from_file(TOKENIZER)
    return [np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for t in texts]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())


BASE = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                              r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16))


def base_spans(text: str | None) -> list[tuple[int, int, str, int]]:
    return sorted((m.start(), i, kind, m.end()) for i, (kind, p, g, least) in enumerate(BASE)
                  for m in p.finditer(text or "") if len(m.group(g)) >= least)


def base_digest(text: str | None) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in base_spans(text)).encode()).hexdigest()


def quality_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def fingerprint(text: str | None, n: int = 4) -> int:
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: list[int], radius: int = 4) -> list[int]:
    """For each fingerprint, the position of the first in its group."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return [find(i) for i in range(len(prints))]


def least_capacity(sizes: list[int], shards: int) -> int:
    def fits(c):
        used, held = 1, 0
        for s in sizes:
            if s > c:
                return False
            if held + s > c:
                used, held = used + 1, 0
            held += s
        return used <= shards

    low, high = 0, sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def top_k(vectors: list[tuple], queries: list[int], k: int) -> dict[int, list[tuple[int, int]]]:
    rows = [(i, np.floor(np.array(v, float) * 1024).astype(int)) for i, v in vectors
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dim = max((len(v) for _, v in rows), default=0)
    rows = [(i, np.pad(v, (0, dim - len(v)))) for i, v in rows]
    own = dict(reversed(rows))
    return {q: sorted(((i, int(v @ own[q])) for i, v in rows if i != q), key=lambda r: (-r[1], r[0]))[:k]
            for q in queries if q in own}


WORDS = ("river stone cloud market signal garden winter copper lantern bridge valley engine paper harbor "
         "silver meadow thunder velvet orchard compass island mirror quartz saddle timber walnut anchor "
         "basket candle dagger ember falcon glacier hammer ivory jungle kettle ladder magnet needle").split()


def prose(seed: int, n: int) -> str:
    """``n`` words that hardly repeat in threes."""
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "s", "ed", "ing", ".", ","]) for _ in range(n))
