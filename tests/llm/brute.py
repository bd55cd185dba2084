"""Plain versions of operators and stages, on lists."""

import base64
import hashlib
import heapq
import math
import zlib
from collections import Counter, defaultdict
from itertools import combinations


def words_of(line):
    return [w for w in line.split(" ") if w]


def one_edit(a, b):
    """Word edit distance of at most 1, by trying all edits."""
    if a == b:
        return True
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def dedup_lines(rows, text_hash, min_words=8):
    """rows: (doc_id, text); the texts kept and counts, row by row."""
    places = {}
    for doc_id, text in rows:
        if text is not None:
            for pos, line in enumerate(text.split("\n")):
                if words_of(line):
                    at = (doc_id is not None, doc_id or 0, text_hash[text], pos)
                    key = tuple(words_of(line))
                    places[key] = min(places.get(key, at), at)
    near = {k for k, at in places.items() if len(k) >= min_words
            and any(o < at and len(x) >= min_words and one_edit(list(x), list(k)) for x, o in places.items())}
    out = []
    for doc_id, text in rows:
        if text is None:
            out.append((doc_id, None, 0, 0, 0))
            continue
        kept, exact, close = [], 0, 0
        lines = text.split("\n")
        for pos, line in enumerate(lines):
            key, at = tuple(words_of(line)), (doc_id is not None, doc_id or 0, text_hash[text], pos)
            if doc_id is None or not key or (places[key] == at and key not in near):
                kept.append(line)
            elif places[key] == at:
                close += 1
            else:
                exact += 1
        out.append((doc_id, "\n".join(kept), len(lines), exact, close))
    return out


def bag(text, size=5):
    words = text.split()
    if not words:
        return Counter()
    words += [""] * (size - len(words))
    return Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def similarity(a, b):
    both = sum((a & b).values())
    return both / max(1, sum(a.values()) + sum(b.values()) - both)


def classes(rows, least=0.8):
    """rows: (doc_id, text); the class of each doc_id."""
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [(d, bag(t or "")) for d, t in rows]
    for (a, x), (b, y) in combinations(bags, 2):
        if a == b or not x or not y:
            continue
        small, large = sorted((sum(x.values()), sum(y.values())))
        if small >= least * large and similarity(x, y) >= least:
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    return {d: root(d) for d, _ in rows}


def token_count(text):
    for c in "\t\n\x0b\f\r":
        text = (text or "").replace(c, " ")
    return len([w for w in text.split(" ") if w])


def mixture(rows, repeats, seed=7):
    """rows: (doc_id, source, text); (index of row, block) of the mixture that gives each row at least once."""
    tokens, total = {}, 0
    for _, source, text in rows:
        tokens[source] = tokens.get(source, 0) + token_count(text)
    shares = {s: t for s, t in tokens.items() if t}
    total = sum(shares.values())
    most, least = max(shares.values(), default=1), min(shares.values(), default=1)
    lo, hi = 0.0, 1.0
    if (most / least) ** 1.0 <= repeats:
        hi = 0.0
    for _ in range(60 if hi else 0):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (most / least) ** (1 - mid) > repeats else (lo, mid)
    out = []
    for source, t in tokens.items():
        r = ((most / t) ** (1 - hi)) if t else 1.0
        blocks = math.floor(r + 1e-9)
        room = max(0, math.floor((r - blocks) * t + 1e-6))
        own = [(hashlib.md5("|".join(str(x) for x in (seed, blocks, d) if x is not None).encode()).hexdigest(), k)
               for k, (d, s, _) in enumerate(rows) if s == source]
        spent, extra = 0, set()
        for place in sorted({p for p, _ in own}):
            at = [k for p, k in own if p == place]
            spent += sum(token_count(rows[k][2]) for k in at)
            if spent > room or not room:
                break
            extra.update(at)
        for _, k in own:
            out += [(k, b) for b in range(blocks + (k in extra))]
    assert total or not shares
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


_NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
_ROLE = {"u": "user", "a": "assistant"}


def cheapest_repair(rows):
    """rows: (role, text, lost, truncated); cost, audit and lines, by trying edits in order of (cost, audit)."""
    heap, seen = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, lines
        if cost > seen.setdefault((i, last), cost):
            continue
        tries = [(2, "I", c, i, f"{_ROLE[c]}:") for c in "ua"]
        if i < len(rows):
            role, text, lost, truncated = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, lines))
            if not lost:
                tries.append((truncated, "K", role[:1], i + 1, f"{role}:{text}"))
                tries += [(2 + truncated, "R", c, i + 1, f"{_ROLE[c]}:{text}") for c in "ua"]
        for c, edit, initial, j, line in tries:
            if (last, initial) in _NEXT:
                heapq.heappush(heap, (cost + c, audit + edit, j, initial, (*lines, line)))


def damaged(rows):
    """rows: (conv_id, turn, role, text); conversations as lists of damaged (turn, role, text)."""
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        own = out[conv_id]
        fault = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fault == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def repaired(conversations):
    """A result row per conversation."""
    out = {}
    for conv_id, rows in conversations.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        counts, marked, seen = Counter(), [], set()
        for _, role, text in rows:
            said = text.strip(" \t\n\v\f\r")
            fault = ("blank" if not said else "duplicate" if (role, text) in seen
                     else "truncated" if said[-1] not in ".!?" else None)
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, lines = cheapest_repair(marked)
        out[conv_id] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
                        sha256("\n".join(lines)))
    return out


def archived(rows, least=0):
    """rows: (page_id, html); sorted results (page_id, bytes, digest, type, refers_to)."""
    payloads = [(p, (h or "").encode()) for p, h in rows]
    groups = defaultdict(list)
    for k, (p, h) in enumerate(payloads):
        groups[h].append((p is not None, p or 0, k))
    out = []
    for k, (p, h) in enumerate(payloads):
        _, _, top = max(groups[h])
        again = len(h) >= least and k != top
        out.append((p, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(),
                    "revisit" if again else "response", payloads[top][0] if again else None))
    return sorted(out, key=str)


def runs_of(words):
    """(start, length, period) by start, then period: every period and place tried."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(
                    words[i:i + length - r] == words[i + r:i + length] for r in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def run_digest(words):
    found = runs_of(words)
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in found)]
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha256("".join(f"{s},{m},{q}\n" for s, m, q in found)), hashlib.sha256(b" ".join(kept)).hexdigest())
