"""Plain Python versions of the operators, on lists of rows."""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from collections import Counter

WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def utf8(text):
    return (text or "").encode("utf-8")


def minimax_capacity(sizes, k):
    """Smallest largest part of ordered sizes cut into at most k runs, by trying every capacity in turn."""
    def parts(capacity):
        n, room = 0, -1
        for s in sizes:
            if s > room:
                n, room = n + 1, capacity
            room -= s
        return n

    low, high = max(sizes), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if parts(mid) <= k else (mid + 1, high)
    return low


def base_rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, r, n < 10 or 100 * r > 20 * n


def chat_digest(turns):
    """n_turns, turns_sha256, loss_chars, loss_sha256 of (role, text) turns."""
    lines = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(utf8(lines)).hexdigest(), len(loss), hashlib.sha256(utf8(loss)).hexdigest()


def shingle_set(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def near_components(rows, percent):
    """(id, n_shingles, component, kept) of (id, text) rows; every pair that shares a shingle is compared."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in sets.items():
        common = Counter(j for x in s for j in holders[x] if j < i)
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {(i, len(s), root(i), root(i) == i) for i, s in sets.items()}


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
RULES = [("assign", ASSIGN, lambda m: len(m[2]) >= 8), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
         ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32)]


def secrets(text):
    """n_assign, n_access, n_hex, base_sha256."""
    found = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(RULES) for m in p.finditer(text or "") if ok(m))
    counts = [sum(f[1] == k for f in found) for k in range(3)]
    return (*counts, hashlib.sha256(",".join(f"{RULES[k][0]}:{a}:{b}" for a, k, b in found).encode()).hexdigest())


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def url_rule(url):
    """host, path, rule, verdict of a page without links."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
        host, path = m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def crc(data):
    return zlib.crc32(data)


def plain_words(text):
    return re.findall(r"\w+", unicodedata.normalize("NFC", text.lower()))


def licence_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", lowered)


def _stands(words, at, phrase):
    return at >= 0 and words[at:at + len(phrase)] == phrase


def notices(text, templates, slack=8, least=0.8):
    """(template, place, share) by trying every place of every template's first key phrase."""
    words, found = licence_words(text), []
    for number, (_, notice) in enumerate(templates):
        full = licence_words(notice)
        phrases, at = [], 0
        for i, part in enumerate(re.split(r"[\[\]]", notice)):
            own = licence_words(part)
            if i % 2:
                phrases.append((at, own))
            at += len(own)
        for place in range(len(words)):
            if not _stands(words, place, phrases[0][1]):
                continue
            base = place - phrases[0][0]
            if all(any(_stands(words, base + p + d, own) for d in range(-slack, slack + 1)) for p, own in phrases):
                near = [w in words[max(0, base + i - slack):max(0, base + i + slack + 1)] for i, w in enumerate(full)]
                if sum(near) / len(full) >= least:
                    found.append((number, place, sum(near) / len(full)))
    return found


def licenses(text, templates, n_base=3):
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = notices(text, templates)
    base = [f for f in found if f[0] < n_base]
    names = lambda some: ",".join(sorted({templates[f[0]][0] for f in some}))
    starts = [f[1] for f in base]
    return (len(licence_words(text)), len(base), min(starts, default=None), max(starts, default=None), names(base), names(found), max((f[2] for f in found), default=0.0))


def two_sides(text, byte_level, pieces):
    """[(id, bytes)] of both sides, or two empty lists."""
    if not text:
        return [], []
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelled = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    a = [(i, bytes(spelled[c] for c in byte_level.id_to_token(i))) for i in byte_level.encode(" " + text, add_special_tokens=False).ids]
    names = [(i, pieces.id_to_piece(i)) for i in pieces.encode(text)]
    b = [(i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()) for i, p in names]
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == b"".join(x for _, x in b) == want else ([], [])


def _spans(side):
    at, out = 0, []
    for i, piece in side:
        out.append((i, at, at + len(piece)))
        at += len(piece)
    return out


def token_links(a, b):
    """(a id, b id) of overlapping occurrences, by two pointers."""
    left, right, i, j, out = _spans(a), _spans(b), 0, 0, []
    while i < len(left) and j < len(right):
        out.append((left[i][0], right[j][0]))
        if left[i][2] == right[j][2]:
            i, j = i + 1, j + 1
        elif left[i][2] < right[j][2]:
            i += 1
        else:
            j += 1
    return out


def groups(a, b):
    left, right = _spans(a), _spans(b)
    cuts = sorted({s[2] for s in left} & {s[2] for s in right})
    parts, before = [], 0
    for cut in cuts:
        own = [",".join(str(i) for i, x, y in side if before <= x and y <= cut) for side in ([s for s in left if before <= s[1] < cut], [s for s in right if before <= s[1] < cut])]
        parts.append("|".join(own))
        before = cut
    return ";".join(parts)


def _grouped(a, b):
    """The groups of long texts by one walk."""
    ends = {s[2] for s in _spans(a)} & {s[2] for s in _spans(b)}

    def cut(side):
        runs, own = [], []
        for i, _, y in _spans(side):
            own.append(str(i))
            if y in ends:
                runs.append(",".join(own))
                own = []
        return runs

    return [f"{x}|{y}" for x, y in zip(cut(a), cut(b))]


def alignments(rows, sides):
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    known = [(i, *sides(t)) for i, t in rows]
    links = [token_links(a, b) for _, a, b in known]
    count = Counter(x for own in links for x in own)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for (i, a, b), own in zip(known, links):
        parts = _grouped(a, b)
        out.append((i, len(a), len(b), len(parts), len(own), sum(count[x] == best[x[1]] for x in own), sum(count[x] for x in own),
                    hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    return out


def hard_negatives(rows, is_anchor, n_positives=5, n_negatives=5, low=80, high=100):
    out = []
    for anchor in filter(is_anchor, rows):
        def partners(same):
            scored = [(-sum(x * y for x, y in zip(anchor[2], r[2])), r[0]) for r in rows if r[0] != anchor[0] and (r[1] == anchor[1]) == same]
            return [(-s, i) for s, i in sorted(scored)]

        others = partners(False)
        for score, positive in partners(True)[:n_positives]:
            fit = [(s, i) for s, i in others if low * score <= 100 * s <= high * score][:n_negatives]
            out += [(anchor[0], positive, rank, i, score, s) for rank, (s, i) in enumerate(fit, 1)]
    return out
