"""Names and addresses of business records, cut into comparable parts."""

from __future__ import annotations

import re
import unicodedata

# Words and abbreviations of postal addresses.
STREET_TYPES = ["road", "street", "lane", "marg", "drive", "boulevard", "avenue", "rue", "chemin"]
TYPE_SPELLINGS = {
    "rd": "road", "st": "street", "str": "street", "ln": "lane", "mg": "marg", "dr": "drive", "drv": "drive",
    "blvd": "boulevard", "boul": "boulevard", "bvd": "boulevard", "bd": "boulevard", "ave": "avenue", "av": "avenue", "aven": "avenue", "r": "rue", "che": "chemin", "chem": "chemin",
    "ch": "chemin", "mn": "main", "cr": "cross", "x": "cross", "ngr": "nagar", "col": "colony", "extn": "extension", "ext": "extension", "sec": "sector", "nr": "near", "opposite": "opp",
    "flr": "floor", "fl": "floor", "ste": "suite", "apt": "apartment", "jn": "junction", "jct": "junction", "junc": "junction",
}
UNITS = ["shop", "sh", "suite", "apartment", "unit", "flat", "office", "room", "apt", "ste"]
ORDINALS = ["ground", "first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth"]
LANDMARK_WORDS = ["off", "opp", "near", "behind", "above", "beside", "next"]
LANDMARKS = ["water", "tank", "post", "office", "cinema", "temple", "railway", "gate", "school", "clock", "tower", "bus", "stand", "stop", "station", "bank", "hospital", "market", "bridge", "church", "mosque", "stadium", "college", "park", "hall"]
LOCALITIES = ["colony", "nagar", "extension"]
FILLERS = ["no", "plot", "pin", "zip", "h", "s", "hno", "sno", "the", "du", "de", "des", "la", "le", "les", "l", "d", "sur", "india", "usa", "us", "france", "f", "n", "e", "w", "north", "south", "east", "west", "main", "cross", "door", "number", "num", "house", "cedex", "code", "and"]
# two neighbouring letters of a street type swapped
TYPE_SPELLINGS |= {w[:i] + w[i + 1] + w[i] + w[i + 2 :]: w for w in STREET_TYPES if len(w) > 3 for i in range(len(w) - 1) if w[i] != w[i + 1]}
_TYPES, _UNITS, _ORD, _LW, _LM, _LOC, _FILL = (frozenset(x) for x in (STREET_TYPES, UNITS, ORDINALS, LANDMARK_WORDS, LANDMARKS, LOCALITIES, FILLERS))

_PIECE = re.compile(r"[a-z]+|\d+[a-z]*|[,;/\n|#-]")
_PLUS4 = re.compile(r"\b(\d{5})-\d{4}\b")
_SPLIT_PIN = re.compile(r"(?<![\d,] )(?<!\d)(\d{3}) (\d{3})(?!\d)")
_DOTTED = re.compile(r"\b([a-z])\.(?=[a-z]\b)")


def fold(text: str) -> str:
    """Lower case without accents."""
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower().replace("œ", "oe").replace("ß", "ss")) if not unicodedata.combining(c))


def address_parts(text: str | None) -> tuple[str, str, list[str], list[bool], list[str], str]:
    """(house number, postal code, words of street and town, which of them stand at a street type, words of landmark and locality, unit)."""
    s = _PLUS4.sub(r"\1", fold(text or ""))
    s = _SPLIT_PIN.sub(r"\1\2", s).replace("n°", "no ").replace("’", "'")
    t = [TYPE_SPELLINGS.get(x, x) for x in _PIECE.findall(s)]
    main: list[tuple[str, int]] = []  # word and place in t
    side: list[str] = []
    numbers: list[tuple[str, int]] = []
    unit = ""
    i, n = 0, len(t)
    while i < n:
        w = t[i]
        c = w[0]
        if c.isdigit():
            digits = w.rstrip("abcdefghijklmnopqrstuvwxyz")
            after = w[len(digits):]
            nxt = t[i + 1] if i + 1 < n else ""
            if after in ("st", "nd", "rd", "th") or nxt == "floor":
                i += 2 if nxt == "floor" else 1
                continue
            numbers.append((digits.lstrip("0") or "0", i))
        elif w in _UNITS or (w == "floor"):
            j = i + 1
            while j < n and t[j] in ("no", "#", ".", "number", "-"):
                j += 1
            if j < n and t[j][0].isdigit() and (w != "floor"):
                unit = unit or t[j].lstrip("0")
                i = j + 1
                continue
        elif w in _ORD and i + 1 < n and t[i + 1] == "floor":
            i += 2
            continue
        elif w == "sector":
            if i + 1 < n and t[i + 1][0].isdigit():
                side.append("sector" + t[i + 1])
                i += 2
                continue
        elif w in _LW:
            j, words = i + 1, []
            while j < n and j <= i + 4 and t[j].isalpha():
                words.append(t[j])
                if t[j] == "flyover" or (t[j] == "road" and not (j + 1 < n and t[j + 1] == "flyover")) or (t[j] in _LM and not (j + 1 < n and t[j + 1] in _LM)):
                    j += 1
                    break
                j += 1
            side += [x for x in words if x not in _TYPES and x not in _FILL and x != "flyover" and len(x) > 2]
            i = j
            continue
        elif w == "junction":
            while main and main[-1][1] >= i - 3 and (main[-1][1] >= i - 1 or t[i - 1] == "road"):
                x, at = main.pop()
                if x not in _TYPES:
                    side.append(x)
                    break
        elif w in _LOC:
            if main and main[-1][1] == i - 1 and main[-1][0] not in _TYPES:
                side.append(main.pop()[0])
        elif c.isalpha() and (w in _TYPES or (len(w) > 2 and w not in _FILL)):
            main.append((w, i))
        i += 1
    words: list[str] = []
    street: list[bool] = []
    for k, (w, at) in enumerate(main):
        if w in _TYPES:
            continue
        before = k + 1 < len(main) and main[k + 1][0] in _TYPES and all(x.isalpha() for x in t[at : main[k + 1][1]])
        after = k > 0 and main[k - 1][0] in _TYPES and at > main[k - 1][1] + 1 and all(x in _FILL for x in t[main[k - 1][1] + 1 : at])
        words.append(w)
        street.append(before or after)
    return *_numbers(t, numbers), words, street, side, unit


def _numbers(t: list[str], numbers: list[tuple[str, int]]) -> tuple[str, str]:
    """House number and postal code among the numbers of an address."""
    postal, rest, fives = "", [], []
    for x, i in numbers:
        if len(x) == 6:
            postal = postal or x
        elif len(x) == 5 or len(t[i]) == 5 and t[i].isdigit() and t[i][0] == "0":
            fives.append((t[i] if t[i].isdigit() else x, i))
        elif len(x) < 5:
            rest.append((x, i))
    if fives and not postal:

        several = len(fives) > 1

        def is_code(i: int) -> int:
            before, after = t[i - 1] if i else "", t[i + 1] if i + 1 < len(t) else ""
            if before in ("zip", "pin") or (len(before) == 2 and before.isalpha() and before != "no"):
                return 3
            if several and after.isalpha() and len(after) != 2:
                return 0  # of two, the one before a street is the house number
            return 3 if before in ("f", "-") else 2 if i == len(t) - 1 else 1

        fives = sorted(fives, key=lambda f: -is_code(f[1]))
        if several or rest or is_code(fives[0][1]) > 1:
            postal = fives.pop(0)[0]
    rest += [f for f in fives if f[0] != postal]
    rest.sort(key=lambda r: r[1])
    if len(rest) > 1:  # a number behind 'S.No' or '#' is the house number only if no other is
        survey = lambda i: i > 1 and t[i - 1] == "no" and t[i - 2] == "s"
        rest = [r for r in rest if not survey(r[1])] or rest
        rest = [r for r in rest if not (r[1] and t[r[1] - 1] == "#")] or rest
        near = [r for r in rest if r[1] + 1 < len(t) and t[r[1] + 1][0] in ",abcdefghijklmnopqrstuvwxyz" and t[r[1] - 1] != "sector"]
        rest = near or rest
    return (rest[0][0] if rest else ""), postal
