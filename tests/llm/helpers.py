"""Brute-force versions that the operators are compared with."""

import re

LONG = "long " + " ".join(f"w{i}" for i in range(60_000))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def shingle_set(text, width):
    w = blank_words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


def components(texts, width, percent=80):
    """Smallest id within reach over links, by id."""
    sets = {i: shingle_set(t, width) for i, t in texts.items()}
    least = {i: i for i in sets}
    changed = True
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return {i: (len(sets[i]), least[i]) for i in sets}


def kept_lines(rows, width=3):
    """``(id, text)`` rows in order to ``(text, lines, removed)`` by id."""
    seen, out = set(), {}
    for i, text in rows:
        if text is None:
            out[i] = (None, 0, 0)
            continue
        lines, gone = text.split("\n"), set()
        for k in range(len(lines) - width + 1):
            window = tuple(lines[k : k + width])
            if window in seen:
                gone.update(range(k, k + width))
            seen.add(window)
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone))
    return out
