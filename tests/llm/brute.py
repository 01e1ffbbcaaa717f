"""Plain re-statements of the contracts, for the tests."""
import hashlib
import re

import xxhash


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def simhash(t, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(ids, fps, bits=2):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    out = []
    for i in range(len(ids)):
        own = [ids[j] for j in range(len(ids)) if find(j) == find(i) and ids[j] is not None]
        out.append(min(own) if own else None)
    return out


def words3(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def contamination(text, items, window=13, share=20):
    w = words3(text)
    hit, ids = set(), set()
    for item, body in items:
        b = words3(body)
        m = min(window, len(b))
        wins = {tuple(b[i:i + m]) for i in range(len(b) - m + 1)} if b else set()
        for i in range(len(w) - m + 1 if wins else 0):
            if tuple(w[i:i + m]) in wins:
                hit |= set(range(i, i + m))
                if item is not None:
                    ids.add(str(item))
    sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return len(w), len(hit), len(ids), sha, len(hit) > 0 and share * len(hit) >= len(w)


def base6(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen: dict = {}
    for i, x in enumerate(wins):
        seen.setdefault(x, []).append(i)
    rep = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 50 or 100 * len(rep) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep), failed


def base9(t):
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        odd = [int(c) for c in d[::-1]]
        luhn = sum(odd[::2]) + sum(sum(divmod(2 * c, 10)) for c in odd[1::2])
        if 14 <= len(d) <= 19 and luhn % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)
