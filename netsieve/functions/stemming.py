"""Porter stemming (M. F. Porter, 1980) with the extensions of the common NLP toolkit.

A small word function; Spark partitions the rows and Arrow carries the batches.
"""

from __future__ import annotations

from functools import lru_cache

# Irregular words, and the suffix rules of steps 2 to 4.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
]
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


def _shape(word: str) -> str:
    """The word as a string of c (consonant) and v (vowel)."""
    out = []
    for i, ch in enumerate(word):
        if ch in "aeiou":
            out.append("v")
        elif ch == "y":
            out.append("c" if i == 0 or out[-1] == "v" else "v")
        else:
            out.append("c")
    return "".join(out)


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _ends_cvc(word: str) -> bool:
    shape = _shape(word)
    if len(word) == 2:
        return shape == "vc"
    return shape.endswith("cvc") and word[-1] not in "wxy"


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in _shape(stem):
            break
    else:
        return word
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _double_consonant(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    return stem + "e" if _measure(stem) == 1 and _ends_cvc(stem) else stem


def _final_y(word: str) -> str:
    stem = word[:-1]
    if word.endswith("y") and len(stem) > 1 and _shape(stem)[-1] == "c":
        return stem + "i"
    return word


def _replace(word: str, rules) -> str:
    """The first suffix that fits decides, whether or not its stem is long enough."""
    for suffix, new in rules:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            # the "logi" rule measures one letter more than its stem
            measured = word[:-3] if suffix == "logi" else stem
            return stem + new if _measure(measured) > 0 else word
    return word


def _step2(word: str) -> str:
    while word.endswith("alli") and _measure(word[:-4]) > 0:
        word = word[:-4] + "al"
    return _replace(word, STEP2)


def _step4(word: str) -> str:
    for suffix in STEP4:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            fits = _measure(stem) > 1 and (suffix != "ion" or stem[-1:] in ("s", "t"))
            return stem if fits else word
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _ends_cvc(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _final_y(_past(_plural(word)))
    word = _replace(_step2(word), STEP3)
    return _tidy(_step4(word))
