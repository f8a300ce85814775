"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SPACED = r"[^\x20\x09-\x0D]+"
LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(text):
    text = text or ""
    kinds = ("assign", "access", "hex")
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [
        [("assign", m.start(), m.end()) for m in re.finditer(assign, text, re.A | re.I) if len(m[2]) >= 6],
        [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
        [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24],
    ]
    spans = sorted(sum(found, []), key=lambda s: (s[1], kinds.index(s[0])))
    return *map(len, found), ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def licenses(text):
    words = re.findall(LETTERS, lower(text))
    starts, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def repeats(docs, length=13):
    """{row: (n_words, n_removed, kept text)} of (id, text) rows."""
    none = math.inf
    words = [re.findall(SPACED, t or "") for _, t in docs]
    first = {}
    for (i, _), w in zip(docs, words):
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(first.get(key, none), none if i is None else i)
    out = []
    for (i, _), w in zip(docs, words):
        gone = set()
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < (none if i is None else i):
                gone.update(range(k, k + length))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def shingles(text, k):
    w = re.findall(SPACED, lower(text))
    return frozenset(zip(*[w[j:] for j in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near(docs, k, percent):
    """{id: (n_shingles, component)} by comparing all pairs."""
    sets = {i: shingles(t, k) for i, t in docs}
    component = {i: i for i in sets}

    def find(x):
        while component[x] != x:
            x = component[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                component[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def leaks(text, items, span=10):
    words, hit, found = re.findall(LETTERS, lower(text)), set(), set()
    for i, item in items:
        own = re.findall(LETTERS, lower(item))
        n = min(span, len(own))
        windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n]) in windows:
                hit.update(range(k, k + n))
                found.add(str(i))
    return len(words), len(hit), sorted(found)


def quality(text):
    text = text or ""
    w = re.findall(SPACED, text)
    grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    again = {j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in text.split("\n") if re.search(SPACED, x)]
    n_symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), n_symbols, len(lines) - len(set(lines)), len(again), len(w) < 10 or 100 * len(again) > 20 * len(w)


def unigrams(docs):
    """{id: (held_out, n_tokens, n_known, train_tokens, base_score)}."""
    tokens = {i: [*re.findall(SPACED, lower(t)), None] for i, t in docs}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    counts = Counter(x for i, w in tokens.items() if not held[i] for x in w)
    n, v = sum(counts.values()), len(counts)
    base = {i: sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w) for i, w in tokens.items()}
    return {i: (held[i], len(w), sum(counts[x] > 0 for x in w), n, base[i]) for i, w in tokens.items()}


def smallest_capacity(sizes, shards):
    """By trying every way to cut."""

    def best(i, k):
        if k == 1:
            return sum(sizes[i:])
        return min(max(sum(sizes[i:j]), best(j, k - 1)) for j in range(i, len(sizes) + 1))

    return best(0, shards)


def by_shard(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out


def planted_words(key, text):
    """Words of a text, of every tenth key with a period."""
    words = re.findall(SPACED, text or "")
    n = len(words)
    h = zlib.crc32(str(key).encode())
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs(words, least=12):
    """(start, length, period) of all runs, by trying every period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def collapsed(words, own):
    gone = {i for start, length, q in own for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def tokenizers():
    """Encoders of a text by the two vocabularies, as (ids, bytes of each id)."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    first = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in first]
    letters = {chr(b): b for b in first} | {chr(256 + k): b for k, b in enumerate(rest)}
    one = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def a(text):
        ids = one.encode(" " + text, add_special_tokens=False).ids
        return ids, [bytes(letters[c] for c in one.id_to_token(i)) for i in ids]

    def b(text):
        ids = two.encode(text)
        pieces = [two.id_to_piece(i) for i in ids]
        return ids, [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]

    return a, b


def alignments(docs):
    """{id: (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)} of (id, text) rows."""
    a, b = tokenizers()
    groups = {}
    for i, text in docs:
        if not text:
            continue
        (ids_a, spelled_a), (ids_b, spelled_b) = a(text), b(text)
        whole = (" " + text).encode()
        if b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
            continue
        ends = [[sum(map(len, side[: k + 1])) for k in range(len(side))] for side in (spelled_a, spelled_b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        own, at = [], 0
        for cut in cuts:
            own.append(tuple([x for x, end in zip(ids, e) if at < end <= cut] for ids, e in ((ids_a, ends[0]), (ids_b, ends[1]))))
            at = cut
        groups[i] = own
    linked = {i: [(x, y) for xs, ys in own for x in xs for y in ys] for i, own in groups.items()}
    counts = Counter(pair for own in linked.values() for pair in set(own))
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = {}
    for i, _ in docs:
        own, links = groups.get(i, []), linked.get(i, [])
        text = ";".join(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}" for xs, ys in own)
        out[i] = (
            sum(len(xs) for xs, _ in own), sum(len(ys) for _, ys in own), len(own), len(links), sum(counts[p] == highest[p[0]] for p in links),
            sum(counts[p] for p in links), sha(text) if own else "",
        )
    return out
