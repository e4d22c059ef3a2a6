"""Porter's stemmer (1980), with the additions that the usual scorer of ROUGE stems with: a few irregular words, and endings of short ones.

Each step is a table of endings; of those a word ends in, the longest is tried,
and its stem has to be of a least measure (the vowel-consonant sequences in it).
"""

from __future__ import annotations

import re
from functools import lru_cache

IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news", "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful", "logi": "log",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = dict.fromkeys("al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split(), "")


def shape(word: str) -> str:
    """A word as ``c`` and ``v``; a y behind a consonant is a vowel."""
    out = ""
    for c in word:
        out += "v" if c in "aeiou" or (c == "y" and out[-1:] == "c") else "c"
    return out


def measure(stem: str) -> int:
    return shape(stem).count("vc")


def short(stem: str) -> bool:
    """Ends in consonant, vowel and a consonant but w, x and y; or is a vowel and a consonant."""
    s = shape(stem)
    return s == "vc" or (s.endswith("cvc") and stem[-1] not in "wxy")


def ending(word: str, table: dict[str, str]) -> str | None:
    return max((e for e in table if word.endswith(e)), key=len, default=None)


def plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def participle(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if measure(word[:-3]) > 0 else word
    cut = re.sub("(ed|ing)$", "", word)
    if cut == word or "v" not in shape(cut):
        return word
    if cut.endswith(("at", "bl", "iz")):
        return cut + "e"
    if cut[-1:] == cut[-2:-1] and shape(cut)[-1] == "c":
        return cut if cut[-1] in "lsz" else cut[:-1]
    return cut + "e" if measure(cut) == 1 and short(cut) else cut


def step_2(word: str) -> str:
    e = ending(word, STEP_2)
    if e is None or measure(word[: -len(e)] + ("l" if e == "logi" else "")) == 0:
        return word
    out = word[: -len(e)] + STEP_2[e]
    return step_2(out) if e == "alli" else out


def step_3(word: str) -> str:
    e = ending(word, STEP_3)
    return word if e is None or measure(word[: -len(e)]) == 0 else word[: -len(e)] + STEP_3[e]


def step_4(word: str) -> str:
    e = ending(word, STEP_4)
    if e is None or measure(word[: -len(e)]) < 2 or (e == "ion" and word[-4] not in "st"):
        return word
    return word[: -len(e)]


def last(word: str) -> str:
    if word.endswith("e"):
        m = measure(word[:-1])
        if m > 1 or (m == 1 and not short(word[:-1])):
            word = word[:-1]
    return word[:-1] if word.endswith("ll") and measure(word[:-1]) > 1 else word


@lru_cache(maxsize=65536)
def stem(word: str) -> str:
    """The stem of a lower-case word."""
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) < 3:
        return word
    word = participle(plural(word))
    if word.endswith("y") and shape(word[:-1]).endswith("c") and len(word) > 2:
        word = word[:-1] + "i"
    return last(step_4(step_3(step_2(word))))
