"""Plain versions of the operators' contracts, and small tables with awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

BLANK = re.compile(rb"[\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Columns that operators use inside.
CLASHES = ["n", "key", "anchor", "digest", "component", "h", "row", "counts", "_label", "budget", "label", "start", "frame", "score"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHES)


def awkward(seed: int = 3) -> list[tuple]:
    """Nulls, empty and blank texts, a very long text, copies, near copies, shared passages and repeated rows."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["Ünï", "日本", "a\x0bb", "x y"]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, body = words(40), words(120)
    near = lambda: " ".join([w if rng.random() > 0.01 else "changed" for w in body])
    texts = [None, "", " \t\n ", "one", "one two three four", "ONE two", "mit license", "x y z"]
    texts += [" ".join(words(150)), " ".join(words(20)), " ".join(words(19))]
    texts += [" ".join(words(30) + passage + words(30)) for _ in range(6)]
    texts += [" ".join(body)] * 4 + ["  ".join(body), "\n".join(body)] + [near() for _ in range(8)]
    texts += ["again " * 200, "tick tock " * 60, " ".join(words(5)), " ".join(words(30_000))]
    texts += ["The Apache License here, an MIT\nLicense and a GNU General Public License", "MIT-license apache License!", "mit licenses"]
    rows = [(i * 3, t, "en", rng.choice(["a", "b", None, "a"]), 0) for i, t in enumerate(texts)]
    rows += [rows[9], rows[12], (None, " ".join(body), "en", "a", 0), (None, None, None, None, None)]
    return [r + ("clash",) * len(CLASHES) for r in rows]


def words_of(text: str | None) -> list[bytes]:
    return [w for w in BLANK.split((text or "").encode()) if w]


def cut(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256); rows that share an id share places, but not what is cut of them."""
    first: dict[tuple, tuple] = {}
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - 19) if i is not None else []:
            key = tuple(w[k : k + 20])
            first[key] = min(first.get(key, (i, k)), (i, k))
    out = []
    for i, t in rows:
        w, gone = words_of(t), set()
        for k in range(len(w) - 19) if i is not None else []:
            if first[tuple(w[k : k + 20])] != (i, k):
                gone.update(range(k, k + 20))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def shingles(text: str | None) -> set:
    w = [x.lower() for x in words_of(text)]
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def linked(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id)."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None:
                continue
            both = len(sets[a] & sets[b])
            same = rows[a][0] == rows[b][0] and sets[a] == sets[b]
            if same or (both and 100 * both >= 75 * len(sets[a] | sets[b])):
                up[root(a)] = root(b)
    least: dict[int, int] = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[root(a)] = min(least.get(root(a), i), i)
    # A row without id has no component of its own; one that equals others stands with them.
    return [(i, len(s), least.get(root(a)) if i is not None else None) for a, ((i, _), s) in enumerate(zip(rows, sets))]


def licensed(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels)."""
    base = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
    out = []
    for i, t in rows:
        w = ALNUM.findall((t or "").encode().lower())
        at = [(k, label) for p, label in base for k in range(len(w)) if w[k : k + len(p.split())] == p.encode().split()]
        places = [k for k, _ in at]
        out.append((i, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))))
    return out


def mixture(sizes: dict[int, tuple[str, int]], share: float, repeats: float, budget: float, order) -> Counter:
    """Readings of each document: the largest exponent that meets the entropy, raised to the repetition limit."""
    tokens: dict[str, int] = defaultdict(int)
    for source, n in sizes.values():
        tokens[source] += n
    total = sum(tokens.values())
    p = {s: n / total for s, n in tokens.items()}

    def weights(a: float) -> dict[str, float]:
        z = sum(x**a for x in p.values())
        return {s: x**a / z for s, x in p.items()}

    def entropy(w: dict[str, float]) -> float:
        return -sum(x * math.log(x) for x in w.values())

    target = entropy(p) + share * (math.log(len(p)) - entropy(p))
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(weights(mid)) >= target else (low, mid)
    a = low
    over = lambda x: max(w * budget / tokens[s] for s, w in weights(x).items()) > repeats
    if over(a):
        low, high = a, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if over(mid) else (low, mid)
        a = high
    out: Counter = Counter()
    for s, w in weights(a).items():
        place = 0
        for i in order(s):
            out[i] = max(0, math.ceil((w * budget - place) / tokens[s]))
            place += sizes[i][1]
    return out
