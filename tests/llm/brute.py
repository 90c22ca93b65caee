"""Plain versions of the operators, for small tables."""

import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return SPACED.findall(lower(text))


def shingles(text, k=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def components(rows):
    """{id: (n_shingles, component)} of (id, text) rows."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in ids}


def contamination(docs, items, window=10):
    """{id: (n_words, n_hit, items)} of (id, text) rows."""
    token = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: token.findall(lower(t))
    windows = {}
    for item, text in items:
        w = split(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = {}
    for i, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                own = windows.get(tuple(w[at : at + n]))
                if own:
                    hit |= set(range(at, at + n))
                    found |= own
        out[i] = (len(w), len(hit), found)
    return out


def base_quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    w = SPACED.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    places = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)


def substring_dedup(rows, least=20):
    """{(id, text): (n_words, n_removed, spans, clean)} of (id, text) rows; an id has one text."""
    found, first = {}, {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        tokens = [(m.start(), m.end()) for m in SPACED.finditer(text or "")]
        w = [lower((text or "")[a:b]) for a, b in tokens]
        opens = [k for k in range(len(w)) if k == 0 or "\n" in text[tokens[k - 1][1] : tokens[k][0]] or w[k - 1][-1] in ".!?"]
        stops = [*opens[1:], len(w)] if w else []
        runs = {(0, len(w))} if 0 < len(w) < least else set()
        for a in opens:
            runs |= {(a, b) for b in [next((b for b in stops if b - a >= least), None)] if b}
        for b in stops:
            runs |= {(a, b) for a in [next((a for a in reversed(opens) if b - a >= least), None)] if a is not None}
        gone = set()
        for a, b in sorted(runs):
            if first.setdefault(tuple(w[a:b]), (i, text, a)) != (i, text, a):
                gone |= set(range(a, b))
        spans = []
        for k in sorted(gone):
            if k - 1 in gone:
                spans[-1][1] = tokens[k][1]
            else:
                spans.append(list(tokens[k]))
        clean, at = "", 0
        for a, b in spans:
            clean += text[at:a]
            after, opening = text[b : b + 1], a == 0 or text[a - 1] == "\n"
            at = b + (after == " " or (opening and after == "\n"))
        found[i, text] = (len(w), len(gone), spans, None if text is None else clean + text[at:])
    return found
