"""Plain Python versions of the operators, by their contracts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def sha(s):
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def secrets(text):
    t = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    found.sort()
    n = Counter(f[3] for f in found)
    return n["assign"], n["access"], n["hex"], sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in found))


def measures(text):
    t = text or ""
    w = WORD.findall(t)
    lines, dup, seen = t.split("\n"), 0, set()
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {p for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit),
            len(w) < 20 or 100 * len(hit) > 30 * len(w))


def substring_dedup(rows):
    """rows: (doc_id, text) -> list of (doc_id, n_words, n_removed, sha of what is left)."""
    words = [WORD.findall(t or "") for _, t in rows]
    rank = [float("inf") if d is None else d for d, _ in rows]
    least = {}
    for r, w in zip(rank, words):
        for i in range(len(w) - 12):
            k = tuple(w[i:i + 13])
            least[k] = min(least.get(k, r), r)
    out = []
    for (d, _), r, w in zip(rows, rank, words):
        gone = {p for i in range(len(w) - 12) if least[tuple(w[i:i + 13])] < r for p in range(i, i + 13)}
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def leaks(rows, items):
    grams = defaultdict(set)
    for item, t in items:
        w = ALNUM.findall((t or "").translate(AZ))
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            grams[tuple(w[i:i + m])].add("" if item is None else str(item))
    out = []
    sizes = {len(g) for g in grams}
    for d, t in rows:
        w = ALNUM.findall((t or "").translate(AZ))
        hit, found = set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if (g := tuple(w[i:i + m])) in grams:
                    hit |= set(range(i, i + m))
                    found |= grams[g]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def shingles(text):
    w = WORD.findall((text or "").translate(AZ))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_duplicates(rows):
    """rows: distinct doc_ids -> (doc_id, n_shingles, component_id, kept)."""
    sets = {d: shingles(t) for d, t in rows}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    where = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            where[g].append(d)
    done = set()
    for ds in where.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1:]:
                if (a, b) not in done:
                    done.add((a, b))
                    n = len(sets[a] & sets[b])
                    if 100 * n >= 75 * len(sets[a] | sets[b]):
                        x, y = root(a), root(b)
                        up[max(x, y)] = min(x, y)
    return [(d, len(s), root(d), root(d) == d) for d, s in sets.items()]


def token_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def pieces(doc_id, ids, most=1024):
    """(doc_id, piece, start, length, crc) of ids and their end."""
    import numpy as np
    ids = ids + [2]
    head = len(ids) % most or most
    cuts = [(0, head)] + [(s, most) for s in range(head, len(ids), most)]
    return [(doc_id, k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())) for k, (s, n) in enumerate(cuts)]


def filter_audit(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic) -> Counter of result rows."""
    from itertools import permutations
    ids = defaultdict(set)
    for d, t, _ in rows:
        if d is not None:
            ids[t or ""].add(d)
    good = {d for d, q, _ in labels if d is not None and q == 1}
    bad = {d for d, _, x in labels if d is not None and x == 1}
    parts = defaultdict(list)
    for d, t, source in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and min(ids[t]) < d}
        parts[source or ""].append((d, {f for f, x in fails.items() if x}))
    out = []
    for part, docs in parts.items():
        found, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = list(docs)
            for k, f in enumerate(order):
                gone = [d for d, x in left if f in x]
                redundant = sum(f in x and bool(x & set(order[:k])) for _, x in docs)
                left = [(d, x) for d, x in left if f not in x]
                shapley[f] += len(gone)
                found.append(("".join(order), k + 1, len(left), len(gone), redundant, sum(x == {f} for _, x in docs),
                              sum(d in good for d in gone), sum(d in bad for d in gone)))
        out += [(part, *x, shapley[x[0][x[1] - 1]]) for x in found]
    return Counter(out)


def damaged(rows):
    """rows: (conv_id, turn, role, text) -> the same after damage, in order."""
    out = []
    for c, n, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if n is None else n}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, n, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    md5 = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, md5(r)))


def faults(rows):
    """Faults of one conversation's rows: b, d, t or none."""
    seen, out = set(), []
    for _, _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("b" if not last else "d" if (role, text) in seen else "t" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


ROLES = re.compile(r"(s?(ua)+)?")


def every_repair(initials, found):
    """Cheapest audit of a short conversation by trying all edits."""
    best = None

    def go(i, roles, audit, cost):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(found):
            for more in ("", "u", "a", "ua", "au"):
                if ROLES.fullmatch(roles + more):
                    new = (cost + 3 * len(more), audit + "I" * len(more))
                    best = new if best is None or new < best else best
            return
        for front in ("", "u", "a", "ua", "au"):
            r, a, c = roles + front, audit + "I" * len(front), cost + 3 * len(front)
            go(i + 1, r, a + "D", c + 4)
            if found[i] not in ("b", "d"):
                extra = 3 if found[i] == "t" else 0
                if initials[i] in ("s", "u", "a"):
                    go(i + 1, r + initials[i], a + "K", c + extra)
                for x in "ua":
                    go(i + 1, r + x, a + "R", c + 3 + extra)

    go(0, "", "", 0)
    return best


def repair(initials, found):
    """Cheapest audit by states: nothing (n), s, u, a."""
    states = {"n": (0, "")}

    def after(state, x):
        return x if (state, x) in {("n", "s"), ("n", "u"), ("s", "u"), ("u", "a"), ("a", "u")} else None

    def inserted(states):
        for _ in range(3):
            for st, (c, a) in list(states.items()):
                for x in "ua":
                    if (n := after(st, x)) and (n not in states or (c + 3, a + "I") < states[n]):
                        states[n] = (c + 3, a + "I")
        return states

    for i, f in zip(initials, found):
        new = {}
        for st, (c, a) in inserted(dict(states)).items():
            ways = [(st, 4, "D")]
            if f not in ("b", "d"):
                extra = 3 if f == "t" else 0
                ways += [(after(st, i), extra, "K")] + [(after(st, x), 3 + extra, "R") for x in "ua"]
            for n, k, letter in ways:
                if n and (n not in new or (c + k, a + letter) < new[n]):
                    new[n] = (c + k, a + letter)
        states = new
    ends = inserted(dict(states))
    return min(ends[k] for k in ("n", "a") if k in ends)


def repaired(rows, audit):
    """Lines of the repaired conversation."""
    it, out, roles = iter(rows), [], ""
    for letter in audit:
        row = next(it) if letter != "I" else None
        if letter == "D":
            continue
        want = "a" if roles[-1:] == "u" else "u"
        role = row[2] if letter == "K" else {"u": "user", "a": "assistant"}[want]
        roles += role[:1]
        out.append(f"{role}:{row[3] if row else ''}")
    assert ROLES.fullmatch(roles)
    return out


def conversations(rows):
    """Result rows of the conversation query."""
    by = {c: [] for c, *_ in rows}
    for r in damaged(rows):
        by[r[0]].append(r)
    out = []
    for c, rs in by.items():
        f, initials = faults(rs), [r[2][:1] for r in rs]
        cost, audit = repair(initials, f)
        turns = {r[1] for r in rs} - {None}
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count("b"), f.count("d"), f.count("t"),
                    sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])), cost, audit,
                    sha("\n".join(repaired(rs, audit)))))
    return out


def licences(text, made, threshold=0.8):
    """(template, first word, last word, shared, Dice) by trying every window of every template."""
    words = [w.lower() for w in re.findall("[A-Za-z0-9]+", text or "")]
    pairs = list(zip(words, words[1:]))

    def apart(windows, order):
        out = []
        for w in sorted(windows, key=order):
            if all(w[2] < x[1] or x[2] < w[1] for x in out):
                out.append(w)
        return out
    best = []
    for t, x in enumerate(made):
        tw = [w.lower() for w in re.findall("[A-Za-z0-9]+", x)]
        want = set(zip(tw, tw[1:]))
        n = len(tw) - 1
        windows = []
        for length in {max(1, int(n * p / q + 0.5)) for p, q in ((2, 3), (5, 6), (1, 1), (5, 4), (3, 2))}:
            for s in range(len(pairs)):
                have = pairs[s:s + length]
                shared = set(have) & want
                dice = 2.0 * len(shared) / (len(set(have)) + len(want))
                if have[0] in want and dice >= threshold:
                    windows.append((t, s, s + max(i for i, g in enumerate(have) if g in want), len(shared), dice, length))
        best += apart(windows, lambda w: (-w[4], -w[3], w[1], w[5]))
    return sorted((t, s, e + 1, k, d) for t, s, e, k, d, _ in apart(best, lambda w: (-w[3], -w[4], w[0], w[1])))
