"""Plain-Python versions of the operators, on lists of rows."""

from __future__ import annotations

import re
from itertools import pairwise

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(n: int, linked) -> list[int]:
    """The lowest place reachable from each place; `linked(i)` yields the places next to i."""
    root = list(range(n))
    for start in range(n):
        if root[start] != start:
            continue
        edge = [start]
        while edge:
            for j in linked(edge.pop()):
                if root[j] == j and j > start:
                    root[j] = start
                    edge.append(j)
    return root


def fingerprint(text: str | None) -> int:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def near_prints(prints: list[int], bits: int = 3) -> list[int]:
    own = np.array(prints, dtype=np.uint64)
    return components(len(own), lambda i: np.flatnonzero(np.bitwise_count(own ^ own[i]) <= bits).tolist())


def without_repeats(texts: list[str | None]) -> list[str | None]:
    """Texts in document order without the lines of later three-line windows."""
    seen, kept = set(), []
    for text in texts:
        if text is None:
            kept.append(None)
            continue
        lines, covered = text.split("\n"), set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if any(WORD.search(line) for line in window):
                if window in seen:
                    covered |= {i, i + 1, i + 2}
                seen.add(window)
        kept.append("\n".join(line for i, line in enumerate(lines) if i not in covered))
    return kept


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    names = sorted(sizes, key=lambda name: (name is None, name))
    weights = {name: i % 3 + 1 for i, name in enumerate(names)}
    open_, left, found = set(names), float(sum(sizes.values())), {}
    while open_:
        share = {name: left * weights[name] / sum(weights[one] for one in open_) for name in open_}
        over = [name for name in open_ if share[name] > 3 * sizes[name]]
        if not over:
            return found | share
        for name in over:
            found[name] = 3.0 * sizes[name]
            left -= found[name]
            open_.remove(name)
    return found


SECRETS = {
    "assign": r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
    r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def base_secrets(text: str | None) -> list[tuple[str, int, int]]:
    found = []
    for i, (kind, pattern) in enumerate(SECRETS.items()):
        for match in re.finditer(pattern, text or ""):
            if len(match[2] if kind == "assign" else match[0]) >= (6, 20, 24)[i]:
                found.append((match.start(), i, kind, match.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def cosine_links(vectors, labels, threshold: float = 0.93) -> np.ndarray:
    """A matrix of links; unusable vectors have none."""
    n = len(vectors)
    usable = [
        label is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for v, label in zip(vectors, labels, strict=True)
    ]
    links = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(n):
            if i != j and usable[i] and usable[j] and labels[i] == labels[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                links[i, j] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold
    return links


def views(turns: list[tuple]) -> dict[tuple, tuple[str, list[tuple[int, int]]]]:
    """(conversation, participant) -> the whole dialogue as that participant sees it, and the spans of its own words."""
    found = {}
    for conv, participant in {(conv, speaker) for conv, _, speaker, _ in turns}:
        said = [(turn, speaker, text or "") for other, turn, speaker, text in turns if other == conv]
        said.sort(key=lambda one: (one[0] is not None, one[0] or 0, one[1] is not None, (one[1] or "").encode(), one[2].encode()))
        rendered, masks = "", []
        for _, speaker, text in said:
            name = "" if speaker is None else " " + speaker.replace("<|", "<||").replace("\n", " ")
            rendered += "<|assistant|>\n" if speaker == participant else f"<|user|>{name}\n"
            start = len(rendered)
            rendered += text.replace("<|", "<||") + "<|end|>\n"
            if speaker == participant:
                masks.append((start, len(rendered)))
        found[conv, participant] = rendered, masks
    return found



def in_order(spans) -> bool:
    return all(a[1] <= b[1] for a, b in pairwise(spans))
