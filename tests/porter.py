"""The Porter algorithm on one word, straight from the published rules, to check the columns against."""


def _consonant(word, i):
    if word[i] in "aeiou":
        return False
    return word[i] != "y" or i == 0 or not _consonant(word, i - 1)


def _measure(stem):
    kinds = "".join("c" if _consonant(stem, i) else "v" for i in range(len(stem)))
    return sum(1 for a, b in zip(kinds, kinds[1:]) if a == "v" and b == "c")


def _vowel(stem):
    return any(not _consonant(stem, i) for i in range(len(stem)))


def _double(word):
    return len(word) > 1 and word[-1] == word[-2] and _consonant(word, len(word) - 1)


def _cvc(word):
    n = len(word)
    return (
        n > 2 and _consonant(word, n - 3) and not _consonant(word, n - 2) and _consonant(word, n - 1)
        and word[-1] not in "wxy"
    )


def _table(word, pairs, least):
    for suffix, new in sorted(pairs.items(), key=lambda p: -len(p[0])):
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            return stem + new if _measure(stem) >= least else word
    return word


def stem(word, step_2, step_3, step_4):
    if len(word) < 3:
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            rest = word[: len(word) - len(suffix)]
            if word.endswith(suffix) and _vowel(rest):
                word = rest
                if word[-2:] in ("at", "bl", "iz"):
                    word += "e"
                elif _double(word) and word[-1] not in "lsz":
                    word = word[:-1]
                elif _measure(word) == 1 and _cvc(word):
                    word += "e"
                break
    if word.endswith("y") and _vowel(word[:-1]):
        word = word[:-1] + "i"
    word = _table(word, step_2, 1)
    word = _table(word, step_3, 1)
    for suffix in sorted(step_4, key=len, reverse=True):
        if word.endswith(suffix):
            rest = word[:-3] if suffix in ("sion", "tion") else word[: len(word) - len(suffix)]
            if _measure(rest) > 1:
                word = rest
            break
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _cvc(word[:-1])):
            word = word[:-1]
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word
