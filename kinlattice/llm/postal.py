"""Postal lines and business names taken apart, word by word, in plain Python.

These functions run inside Arrow batches, once per distinct line of a batch: a line
of an address or a name needs some twenty decisions that depend on each other, which
as column expressions make plans that take longer to compile than to run.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

#: Thoroughfare suffixes of the public postal addressing standard (standard abbreviation: words and usual short forms).
SUFFIXES = {
    "aly": ["allee", "alley", "ally", "aly"],
    "ave": ["av", "ave", "aven", "avenu", "avenue", "avn", "avnue"],
    "blvd": ["blvd", "boul", "boulevard", "boulv"],
    "byp": ["byp", "bypa", "bypas", "bypass", "byps"],
    "cir": ["cir", "circ", "circl", "circle", "crcl", "crcle"],
    "cres": ["cres", "crescent", "crsent", "crsnt"],
    "cswy": ["causeway", "causwa", "cswy"],
    "ct": ["court", "ct", "crt"],
    "dr": ["dr", "driv", "drive", "drv"],
    "expy": ["exp", "expr", "express", "expressway", "expw", "expy"],
    "fwy": ["freeway", "freewy", "frway", "frwy", "fwy"],
    "hwy": ["highway", "highwy", "hiway", "hiwy", "hway", "hwy"],
    "ln": ["lane", "ln"],
    "loop": ["loop", "loops"],
    "pike": ["pike", "pikes"],
    "pkwy": ["parkway", "parkwy", "pkway", "pkwy", "pky"],
    "pl": ["pl", "place"],
    "plz": ["plaza", "plz", "plza"],
    "rd": ["rd", "road"],
    "row": ["row"],
    "rte": ["route", "rte"],
    "sq": ["sq", "sqr", "sqre", "squ", "square"],
    "st": ["st", "str", "street", "strt"],
    "ter": ["ter", "terr", "terrace"],
    "tpke": ["trnpk", "turnpike", "turnpk", "tpke"],
    "trl": ["trail", "trails", "trl", "trls"],
    "way": ["way", "wy"],
}
#: Suffix words that also end names ("Park Place", "Long Trail").
NAME_LIKE = {"alley", "circle", "court", "crescent", "loop", "pike", "place", "plaza", "row", "square", "terrace", "trail", "way"}
#: Directions.
DIRECTIONS = {
    "n": ["n", "north"], "s": ["s", "south"], "e": ["e", "east"], "w": ["w", "west"],
    "ne": ["ne", "northeast"], "nw": ["nw", "northwest"], "se": ["se", "southeast"], "sw": ["sw", "southwest"],
}
#: Ordinals written as words.
ORDINALS = {
    "first": "1st", "second": "2nd", "third": "3rd", "fourth": "4th", "fifth": "5th", "sixth": "6th", "seventh": "7th", "eighth": "8th", "ninth": "9th", "tenth": "10th",
    "eleventh": "11th", "twelfth": "12th", "thirteenth": "13th", "fourteenth": "14th", "fifteenth": "15th", "sixteenth": "16th", "seventeenth": "17th", "eighteenth": "18th",
    "nineteenth": "19th", "twentieth": "20th",
}
#: Words before the number of a suite, a building, a floor.
SUITE, BUILDING, FLOOR = {"suite", "ste", "unit", "apartment", "apt", "room", "rm"}, {"building", "bldg", "bld"}, {"floor", "flr", "fl"}
#: State codes.
STATES = {
    "al", "ak", "az", "ar", "ca", "co", "ct", "de", "dc", "fl", "ga", "hi", "id", "il", "in", "ia", "ks", "ky", "la", "me", "md", "ma", "mi", "mn", "ms", "mo", "mt", "ne", "nv",
    "nh", "nj", "nm", "ny", "nc", "nd", "oh", "ok", "or", "pa", "ri", "sc", "sd", "tn", "tx", "ut", "vt", "va", "wa", "wv", "wi", "wy", "pr", "vi", "gu",
}
TYPE_OF = {w: k for k, ws in SUFFIXES.items() for w in ws}
DIRECTION_OF = {w: k for k, ws in DIRECTIONS.items() for w in ws}
#: Spelled-out suffixes are also known with one letter missing, wrong, too many or swapped.
LONG_TYPES = {w: k for w, k in TYPE_OF.items() if len(w) > 5}
SAINT = {"st", "saint", "sainte", "ste"}
PLAIN = str.maketrans({"ø": "o", "œ": "oe", "æ": "ae", "ß": "ss", "ł": "l", "đ": "d"})


class Form(NamedTuple):
    """One reading of an address; '' where a part is missing, no blanks inside a part."""

    num: str
    street: str
    town: str
    zip5: str
    st: str
    pre: str
    kind: str
    unit: str


def _shorter(w: str) -> list[str]:
    return [w[:i] + w[i + 1 :] for i in range(len(w))]


NEAR_TYPES = {v: k for w, k in LONG_TYPES.items() for v in [*_shorter(w), w]}


def street_type(w: str) -> str:
    """Standard abbreviation of a suffix word, also of one misspelt by a letter; '' for other words."""
    found = TYPE_OF.get(w, "")
    return found or (next((NEAR_TYPES[v] for v in [w, *_shorter(w)] if v in NEAR_TYPES), "") if len(w) > 4 else "")


def plain(s: str | None) -> str:
    """Lower case without accents; null is ''."""
    s = (s or "").lower()
    return s if s.isascii() else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).translate(PLAIN)


def words(s: str) -> list[str]:
    """Words and the signs that part them."""
    return re.findall(r"[a-z0-9]+|[,#/-]", s)


def town(ws: list[str]) -> str:
    """Town of its words: without blanks, "saint" in one spelling."""
    ws = [w for w in ws if w.isalnum()]
    if len(ws) > 1 and ws[0] in SAINT:
        ws[0] = "saint"
    return "".join(ws)


def zip5(s: str | None) -> str:
    d = "".join(c for c in s or "" if "0" <= c <= "9")
    return d[:5] if len(d) >= 5 else ""


def _cut_zip(t: list[str]) -> tuple[list[str], str]:
    digits = lambda w, n: len(w) == n and w.isdigit()
    for back in (["-", 4], [4], []):
        n = len(back) + 1
        tail = t[-n:]
        if len(tail) == n and digits(tail[0], 5) and all(w == b if isinstance(b, str) else digits(w, b) for w, b in zip(tail[1:], back)):
            return t[:-n], tail[0]
    return (t[:-1], t[-1][:5]) if t and digits(t[-1], 9) else (t, "")


def _strip(t: list[str]) -> list[str]:
    while t and t[-1] in ",#/-":
        t = t[:-1]
    return t


def tail(t: list[str]) -> tuple[list[str], list[str], str, str]:
    """The line without its own town, state and ZIP, and these; all '' if it has no such end.

    The end is read from the right: ZIP, state code, and the words up to the comma
    before them. A line without a ZIP needs a comma before the state as well. Without
    any comma the town begins behind the street type, its direction and its unit.
    """
    rest, code = _cut_zip(_strip(t))
    rest = _strip(rest)
    if not rest or rest[-1] not in STATES or (not code and (rest[-1] in FLOOR or len(rest) < 2 or rest[-2] != ",")):
        return t, [], "", ""
    st, rest = rest[-1], _strip(rest[:-1])
    at = len(rest)
    while at and (rest[at - 1].isalpha() or rest[at - 1] in "/-"):
        at -= 1
    if at and at < len(rest) and rest[at - 1] == ",":
        return rest[: at - 1], rest[at:], st, code
    if not code or "," in rest:
        return t, [], "", ""
    for k in range(len(rest) - 1, 1, -1):
        if street_type(rest[k]):
            end = k + 1
            if end < len(rest) and rest[end] in DIRECTION_OF:
                end += 1
            while end < len(rest) and (rest[end] in SUITE or rest[end] in BUILDING or rest[end] in FLOOR or rest[end] == "#"):
                end += 2 if end + 1 < len(rest) and rest[end + 1] != "#" else 3
            if end < len(rest) and all(w.isalpha() for w in rest[end:]):
                return rest[:end], rest[end:], st, code
    return t, [], "", ""


_VALUE = re.compile(r"[a-z]?\d+|\d+[a-z]|[a-z]")
_JOINED = re.compile(r"(suite|ste|unit|apt|rm|bldg|fl|flr)(\d+[a-z]?)")


def _unit(t: list[str]) -> tuple[list[str], str]:
    """The words without building, floor, suite and "rear", and these in one spelling."""
    found: dict[str, str] = {}
    out: list[str] = []
    i = 0
    while i < len(t):
        w, nxt = t[i], i + 1
        joined = _JOINED.fullmatch(w)
        if joined:
            w, t = joined[1], [*t[:nxt], joined[2], *t[nxt:]]
        slot = "2ste" if w in SUITE or w == "#" else "0bldg" if w in BUILDING else "1fl" if w in FLOOR else ""
        if slot == "1fl" and out and re.fullmatch(r"\d+(st|nd|rd|th)", out[-1]):
            found.setdefault(slot, out.pop()[:-2])
        elif slot and nxt < len(t):
            at = nxt + 1 if t[nxt] == "#" else nxt
            if at < len(t) and _VALUE.fullmatch(t[at]):
                value, nxt = t[at], at + 1
                if nxt + 1 < len(t) and t[nxt] == "-" and _VALUE.fullmatch(t[nxt + 1]) and value.isalpha() != t[nxt + 1].isalpha():
                    value, nxt = value + t[nxt + 1], nxt + 2
                found.setdefault(slot, value)
            elif w != "#":
                out.append(w)
        elif w == "rear":
            found.setdefault("3rear", "")
        elif w != "#":
            out.append(w)
        i = nxt
    return out, "".join(k[1:] + v for k, v in sorted(found.items()))


def _number(t: list[str]) -> tuple[str, list[str]]:
    """House number and what follows it; what stands before ("c/o front desk") is no part of the address."""
    for i, w in enumerate(t):
        m = re.match(r"[a-z]*(\d+)(.*)", w)
        if m:
            rest = t[i + 1 :]
            if len(m[2]) > 1:  # "79th", without a house number
                return ("", t[i:]) if re.fullmatch(r"\d+(?:st|nd|rd|th)", w) else (m[1], [m[2], *rest])
            if len(rest) > 1 and rest[0] == "-" and rest[1].isdigit():  # a range: its first number
                rest = rest[2:]
            return m[1], rest
    return "", t


def _street(ws: list[str]) -> str:
    if len(ws) > 1 and ws[0] in SAINT:
        ws = ["saint", *ws[1:]]
    s = "".join(ws)
    return s[:-2] if re.fullmatch(r"\d+(?:st|nd|rd|th)", s) else s


@lru_cache(1 << 15)
def readings(line: str | None, city: str | None, state: str | None, zip_: str | None) -> tuple[Form, ...]:
    """All plausible readings of an address, the likeliest first; none without a house number and a street.

    A suffix word that also ends names may be a type or part of the name, a word that
    begins with a direction may hold that direction, a bare number behind the type may
    be the unit or part of the name. Town, state and ZIP of the columns come before
    those inside the line.
    """
    t = words(plain(line))
    body, tail_town, tail_st, tail_zip = tail(t)
    place = (town(words(plain(city))) or town(tail_town), zip5(zip_) or tail_zip, re.sub("[^a-z]", "", plain(state)) or tail_st)
    body, unit = _unit([ORDINALS.get(w, w) for w in body])
    num, rest = _number(body)
    ws = [w for w in rest if w not in ",/-#"]
    if not num or not ws:
        return ()
    found: list[tuple[str, str, str, str]] = []

    def read(ws: list[str], unit: str) -> tuple[str, str, str, str]:
        post = kind = pre = ""
        if len(ws) > 1 and ws[-1] in DIRECTION_OF:
            post, ws = DIRECTION_OF[ws[-1]], ws[:-1]
        last = ws[-1]
        if len(ws) > 1:
            kind = street_type(last)
            ws = ws[:-1] if kind else ws
        if len(ws) > 1 and ws[0] in DIRECTION_OF:
            pre, ws = DIRECTION_OF[ws[0]], ws[1:]
        street = _street(ws)
        if kind and last in NAME_LIKE:
            others.append((street + last, pre or post, "", unit))
        whole = next((d for d in DIRECTION_OF if len(d) > 2 and street.startswith(d) and len(street) > len(d) + 2), "")
        if whole and not pre and not post:
            others.append((street[len(whole) :], DIRECTION_OF[whole], kind, unit))
        return street, pre or post, kind, unit

    others: list[tuple[str, str, str, str]] = []
    bare = len(ws) > 2 and not unit and ws[-2] in TYPE_OF and TYPE_OF[ws[-2]] not in ("hwy", "rte") and re.fullmatch(r"\d+[a-z]?|[a-z]\d+", ws[-1])
    if bare:
        found.append(read(ws[:-1], "ste" + ws[-1]))
    found.append(read(ws, unit))
    forms = (Form(num, street, *place, pre, kind, unit) for street, pre, kind, unit in dict.fromkeys(found + others) if street)
    return tuple(forms)


#: Legal forms, and the word that each spelling of a name's word stands for.
LEGAL = {"llc", "inc", "incorporated", "corp", "corporation", "pc", "pllc", "pa", "lp", "llp", "ltd", "co", "company"}
WORD_OF = {
    "assoc": "associates", "behav": "behavioral", "behavioural": "behavioral", "behaviour": "behavior", "behaviors": "behavior", "cent": "center", "centers": "center",
    "centre": "center", "clin": "clinic", "cntr": "center", "ctr": "center", "dev": "development", "devel": "development", "developmental": "development", "grp": "group",
    "learn": "learning", "lrng": "learning", "mgmt": "management", "mgt": "management", "paediatric": "pediatric", "ped": "pediatric", "peds": "pediatric", "serv": "services",
    "service": "services", "st": "saint", "ste": "saint", "svc": "services", "svcs": "services", "ther": "therapy", "therapies": "therapy",
}
_ALSO = re.compile(r"\s+(?:d ?/ ?b ?/ ?a|dba|doing business as|trading as|aka)\.?:?\s+")


class Name(NamedTuple):
    """A business name without blanks: whole, its first word, and the others."""

    whole: str
    head: str
    rest: str


def _without_legal(ws: list[str]) -> list[str]:
    while ws and (ws[-1] in LEGAL or ws[-1] == ","):
        ws = ws[:-1]
    return ws


@lru_cache(1 << 15)
def names(text: str | None, *towns: str) -> tuple[Name, ...]:
    """The names that a line gives: two for "doing business as", none for null and blank.

    Legal form, one of the ``towns`` behind the name, "the", abbreviations and words
    put last behind a comma are undone.
    """
    out = []
    for part in _ALSO.split(plain(text)):
        ws = _without_legal(re.findall(r"[a-z0-9]+|,", re.sub(r"[.'’]", "", part).replace("&", " and ")))
        ws = [WORD_OF.get(w, w) for w in ws]
        for k in range(1, min(len(ws) - 1, 5) + 1):
            # Behind a comma it is no town but a part of the name put last.
            if "".join(ws[-k:]) in towns and ws[-k - 1] != ",":
                ws = ws[:-k]
                break
        ws = [w for w in ws if w not in LEGAL]
        if "," in ws[1:-1]:
            cut = ws.index(",", 1)
            ws = ws[cut + 1 :] + ws[:cut]
        ws = [w for w in ws if w != ","]
        if len(ws) > 2 and ws[-1] in ("of", "at", "in"):
            ws = ws[:-1]
        if len(ws) > 1 and ws[0] == "the":
            ws = ws[1:]
        if ws:
            out.append(Name("".join(ws), ws[0], "".join(ws[1:])))
    return tuple(out)
