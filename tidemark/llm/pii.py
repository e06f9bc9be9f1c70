"""Personal information in free text, by a semi-Markov conditional random field (problem 3).

Candidate segments of every type are proposed wherever a pattern, the list of known names or the writing of two words as a
name gives reason, with all their possible boundaries. Features of the whole span (shape, length, known parts, endings, what stands before and after) score
each one; dynamic programming over the lattice of candidates picks the set of segments that don't overlap with the highest
total, so boundaries and types are decided jointly. Text between segments scores 0. Segments are bounded, so decoding is
linear in the text. Weights are fitted by the conditional likelihood of whole segmentations (forward and backward sums
over the same lattice) on sentences this module writes itself, with known names left out at random so that unknown ones
are learned by their form and place.

Texts are matched in a length-preserving comparable form, so what is found is given exactly as it stands. Patterns
are tried only where their own marks (sign, digits, word for a street) stand; no post is passed over or cut short.

Defined results: null and empty texts have no cases and stay as they are; a value found twice in a post is one case;
repeated rows of a post give one case each value; the known-names table may be empty.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .charform import FROM, LIGATURES, TO

TYPES = ("email", "phone", "id_number", "address", "name")
PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}
#: Most known names that are sent to the tasks.
MOST_NAMES = 100_000

_ONE = {ord(c): (TO[i] if i < len(TO) else "") for i, c in enumerate(FROM)}
_ODD = re.compile("[" + "".join(LIGATURES) + "]")

L = r"(?<![\w@#$.\-+/,])"
R = r"(?![\w@])(?![.,/\-]\d)"
_HOST = r"[a-z0-9](?:[\w\-]*[a-z0-9])?"
_AT = r"(?:\s?\[at\]\s?|\s?\(at\)\s?|\s?\{at\}\s?|\sat\s|\sarroba\s)"
_DOT = r"(?:\s?\[dot\]\s?|\s?\(dot\)\s?|\s?\{dot\}\s?|\sdot\s|\spunto\s)"
EMAILS = [
    ("sign", re.compile(rf"(?i)(?<![\w.+\-@])[a-z0-9][\w.+\-]*@{_HOST}(?:\.{_HOST}){{1,4}}")),
    ("words", re.compile(rf"(?i)(?<![\w.+\-@])[a-z0-9][\w.+\-]*{_AT}{_HOST}(?:{_DOT}{_HOST}){{1,4}}")),
    ("both", re.compile(rf"(?i)(?<![\w.+\-@])[a-z0-9][\w.+\-]*(?:@{_HOST}(?:{_DOT}{_HOST}){{1,4}}|\s?[\[({{]at[\])}}]\s?{_HOST}(?:\.{_HOST}){{1,4}})")),
]
PHONES = [
    ("intl", re.compile(r"(?<![\w.,+])(?<!\d[ \-])\+\d{1,3}(?:[ \-]?\d{2,5}){2,4}(?![\w\-])(?!\.\d)")),
    ("zeros", re.compile(r"(?<![\w.,+])(?<!\d[ \-])00\d{1,3}(?:[ \-]\d{2,5}){2,4}(?![\w\-])(?!\.\d)")),
    ("intl_solid", re.compile(r"(?<![\w.,+])\+\d{1,3}[ \-]?\d{8,11}(?![\w\-])(?!\.\d)")),
    ("area", re.compile(r"(?<![\w.,+])\(\d{3}\)[ \-.]?\d{3}[ \-.]\d{4}(?![\w\-])")),
    ("us", re.compile(r"(?<![\w.,+])(?:1[ \-.])?\d{3}([\-. ])\d{3}\1\d{4}(?![\w\-])(?!\.\d)")),
    ("five", re.compile(r"(?<![\w.,+\-])\d{5}[ \-]\d{5}(?![\w\-])(?!\.\d)")),
    ("uk", re.compile(r"(?<![\w.,+\-])(?<!\d )0\d{4} ?\d{3} ?\d{3}(?![\w\-])(?!\.\d)")),
    ("ten", re.compile(r"(?<![\w.,+\-])\d{10,11}(?![\w\-])(?!\.\d)")),
    ("trunk", re.compile(r"(?<![\w.,+\-])(?<!\d )0[1-9]\d{1,3}[ \-]\d{3,4}[ \-]\d{3,4}(?![\w\-])(?!\.\d)(?! \d)")),
]
IDS = [
    ("twelve", re.compile(r"(?<![\w.,+\-])\d{12}(?![\w\-])(?!\.\d)")),
    ("fours", re.compile(r"(?<![\w.,+\-])\d{4}([ \-])\d{4}\1\d{4}(?![\w\-])(?! ?\d)")),
    ("ssn", re.compile(r"(?<![\w.,+\-])\d{3}-\d{2}-\d{4}(?![\w\-])")),
    ("pan", re.compile(r"(?i)(?<![\w$#@.])[a-z]{5}\d{4}[a-z](?!\w)")),
    ("letters", re.compile(r"(?i)(?<![\w$#@.])[a-z]{1,2}\d{6,8}(?!\w)")),
    ("ten", dict(PHONES)["ten"]),
    ("pair", re.compile(r"(?<![\w.,+\-])\d{4}-\d{4}(?![\w\-])")),
]
_HEAD = r"(?:(?:flat|house|plot|door|apartment|apt|h\.?\s?no|मकान|फ्लैट|फ़्लैट|प्लॉट|घर|casa|piso)\.?\s*(?:no|nº|number|नं|संख्या)?\.?\s*)"
_TYPE = r"(?:street|st\.?|road|rd\.?|avenue|ave\.?|boulevard|blvd\.?|lane|ln|way|terrace|square|marg|gali|cross|nagar|colony|drive|sector \d+|गली \d+|मार्ग|नगर|सेक्टर \d+)"
_TOWN = r"[^\W\d_][\wऀ-ॣ'’]*"
ADDRESS = re.compile(rf"(?i)(?<![\w.,@#$/\-])(?:{_HEAD}\d+[a-z]?(?:/\d+)?|\d{{1,4}}(?:/\d+)?)(?P<mid>,? (?:[^\W_][\wऀ-ॣ.]* ){{0,4}}{_TYPE}(?:, (?:near|opp|opposite|behind|beside)\.? (?:[\w]+ ){{0,4}}[\w]+)?),? ?(?P<town>{_TOWN}(?: {_TOWN})?)?(?P<code> ?[\-,]? ?(?:\d{{3}} ?\d{{3}}|\d{{5}})(?![\d.,]))?")
_WORD = re.compile(r"[^\W\d_](?:[\wऀ-ॣ'’])*\.?")
NAME_TITLES = {"mr", "mrs", "ms", "dr", "shri", "smt", "prof", "sir", "madam", "sr", "sra", "श्री", "श्रीमती"}
PHONE_CUES = {"call", "dial", "phone", "mobile", "whatsapp", "line", "number", "ring", "ringing", "rings", "text", "tel", "cell", "contact", "llamen", "llama", "número", "numero", "teléfono", "फोन", "फ़ोन", "नंबर", "मोबाइल", "karo", "करें"}
ID_CUES = {"aadhaar", "aadhar", "pan", "passport", "tax", "code", "ssn", "kyc", "id", "identity", "documento", "pasaporte", "dni", "nif", "आधार", "पैन", "पासपोर्ट", "leaked", "licence", "national"}
NUMBER_CUES = {"order", "ref", "reference", "ticket", "contract", "oi", "volume", "invoice", "txn", "shares", "vwap", "pivot", "signal", "alert", "delivery", "lot", "no", "crossed", "traded", "r1", "r2", "s1", "bid", "close", "orden", "pedido", "settled", "filled", "t+1", "expired", "pedido", "batch"}
ADDRESS_CUES = {"at", "to", "address", "live", "lives", "moved", "meetup", "courier", "papers", "parcel", "office", "rent", "goes", "pata", "kagaz", "पता", "कागज़", "dirección", "vivo", "en"}
HONORIFICS = {"ji", "जी", "saab", "sahab", "साहब"}
NAME_BEFORE = {"with", "against", "to", "by", "from", "wale", "con", "a", "से", "thanks", "mr", "mrs", "ms", "dr", "shri", "smt", "client", "manager", "met", "colleague", "friend", "neighbour", "meet", "and"}
NAME_AFTER = {"ji", "जी", "ne", "ने", "confirmed", "from", "called", "yesterday", "for", "this", "por", "ayer", "se", "said", "told", "says", "the", "at", "will", "has", "was", "is"}

_BESIDE = NAME_BEFORE | NAME_AFTER
#: What every match of the patterns above holds, without what must stand around it: cheap to look for, and never absent from a match.
EMAIL_MARK = re.compile(rf"(?i)[\w.+\-](?:@|{_AT}|\s?[\[({{]at[\])}}]\s?)[a-z0-9]")
NUMBER_MARK = re.compile(r"(?i)\+\d|(?<![\w.,+])00\d|\(\d{3}\)|\d{3}[\-. ]\d{3}[\-. ]\d{4}|\d{5}[ \-]\d{5}|0\d{4} ?\d{3} ?\d{3}|0\d{2,4}[ \-]\d{3,4}[ \-]\d{3,4}|\d{10}|\d{4}[ \-]\d{4}|\d{3}-\d\d-\d{4}|[a-z]{5}\d{4}[a-z]|[a-z]{1,2}\d{6}")
ADDRESS_MARK = re.compile(rf"(?i) {_TYPE}")


def comparable(text: str) -> tuple[str, list[int] | None]:
    """The text in matching form, and where each of its characters stands in the original (None: at the same place)."""
    if text.isascii():
        return text, None
    mapped = text.translate(_ONE)
    if not _ODD.search(mapped):
        return mapped, None
    out, at = [], []
    for i, c in enumerate(mapped):
        if c != "":
            for x in LIGATURES.get(c, c):
                out.append(x)
                at.append(i)
    return "".join(out), at


class Names:
    """Known given and family names, and the endings that several of them share."""

    def __init__(self, given: set[str], family: set[str]):
        self.given, self.family = given, family
        self.given_ends, self.family_ends = self._ends(given), self._ends(family)

    @staticmethod
    def _ends(names: set[str]) -> set[str]:
        n: dict[str, int] = defaultdict(int)
        for x in names:
            for k in (3, 4):
                if len(x) > k + 1:
                    n[x[-k:]] += 1
        return {k for k, v in n.items() if v >= 3}


Candidate = tuple[int, int, str, list[str]]


def _near(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    before = [w.strip(".,:;!?()[]-|\"'").lower() for w in text[max(0, start - 40) : start].split()[-4:]]
    after = [w.strip(".,:;!?()[]-|\"'।").lower() for w in text[end : end + 40].split()[:3]]
    return before, after


def _cues(prefix: str, before: list[str], after: list[str], *lists: tuple[str, set[str]]) -> list[str]:
    out = []
    for name, words in lists:
        if before and before[-1] in words:
            out.append(f"{prefix}:{name}:just")
        if any(w in words for w in before[:-1]):
            out.append(f"{prefix}:{name}:before")
        if any(w in words for w in after):
            out.append(f"{prefix}:{name}:after")
    return out


def candidates(text: str, names: Names, drop: frozenset[str] = frozenset()) -> list[Candidate]:
    """(start, end, type, features) of every proposed segment of a text in matching form. Names in ``drop`` count as unknown."""
    out: list[Candidate] = []
    for shape, pattern in EMAILS if EMAIL_MARK.search(text) else ():
        out += [(*m.span(), "email", ["email", f"email:{shape}"]) for m in pattern.finditer(text)]
    numeric = (("phone", PHONE_CUES), ("id", ID_CUES), ("number", NUMBER_CUES))
    for kind, patterns in (("phone", PHONES), ("id_number", IDS)) if NUMBER_MARK.search(text) else ():
        seen = set()
        for shape, pattern in patterns:
            for m in pattern.finditer(text):
                if m.span() not in seen:
                    seen.add(m.span())
                    out.append((*m.span(), kind, [kind, f"{kind}:{shape}", *_cues(kind, *_near(text, *m.span()), *numeric)]))
    for m in ADDRESS.finditer(text) if ADDRESS_MARK.search(text) else ():
        head = text[m.start()].isdigit()
        town, code = m.group("town"), m.group("code")
        base = ["address", "address:number" if head else "address:keyword", *_cues("address", *_near(text, m.start(), m.end()), ("cue", ADDRESS_CUES))]
        if not town:
            out.append((m.start(), m.end("mid"), "address", [*base, "address:no town"]))
            continue
        first = town.split(" ")[0]
        ends = {(m.start("town") + len(first), 1), (m.end("town"), 2 if " " in town else 1)}
        for end, n in ends:
            last = town.split(" ")[-1]
            feats = [*base, f"address:town {n}", "address:town cap" if first[0] != first[0].lower() or first[0] == first[0].upper() else "address:town low"]
            if n == 2:
                feats.append("address:second cap" if last[0] != last[0].lower() else "address:second low")
            if code and end == m.end("town"):
                out.append((m.start(), m.end("code"), "address", [*feats, "address:code"]))
                feats = [*feats, "address:code left"]
            out.append((m.start(), end, "address", feats))
    words = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(text)]
    lows = [w.rstrip(".").lower() for *_, w in words]

    def form(i: int, known: set[str], ends: set[str]) -> str:
        w = lows[i]
        if w in known and w not in drop and "!" + w not in drop:
            return "known"
        return "ending" if (w[-3:] in ends or w[-4:] in ends) and "!" + w not in drop else "new"

    for i in range(len(words)):
        for n in (2, 3):
            j = i + n - 1
            if j >= len(words) or any(text[words[k][1] : words[k + 1][0]] not in (" ", "  ") for k in range(i, j)):
                break
            if words[i][0] and text[words[i][0] - 1] in "@#$._-+" or lows[i] in NAME_TITLES:
                break
            first, last = form(i, names.given, names.given_ends), form(j, names.family, names.family_ends)
            prior, later = lows[i - 1] if i else "", lows[j + 1] if j + 1 < len(words) else ""
            # A word that names stand beside is no part of one, unless it is listed as a name.
            if any(lows[k] in _BESIDE and form_ != "known" for k, form_ in ((i, first), (j, last))):
                continue
            # Words that neither the lists nor two endings speak for are proposed where they are written as names are, or where names stand; context decides.
            if "known" not in (first, last) and not (first == last == "ending"):
                ends = (words[i][2], words[j][2])
                written = all(w[0] != w[0].lower() and w[1:].islower() for w in ends)
                caseless = all(w.lower() == w.upper() for w in ends)
                if not (written or prior in NAME_TITLES or later in HONORIFICS or (caseless and prior in NAME_BEFORE and later in NAME_AFTER) or (prior, later) == ("wale", "ne")):
                    continue
            end = words[j][1] - words[j][2].endswith(".")
            if end < len(text) and text[end] in "@_+" or words[i][2].endswith(".") or (n == 3 and words[i + 1][2].endswith(".") and len(words[i + 1][2]) > 2):
                continue
            feats = ["name", f"name:{n}", f"name:first {first}", f"name:last {last}", f"name:{first}+{last}"]
            if n == 3:
                w = words[i + 1][2].rstrip(".")
                mid = "initial" if len(w) == 1 else form(i + 1, names.given, names.given_ends)
                feats += [f"name:mid {mid}"]
            cases = {"none" if w[0].lower() == w[0].upper() else "upper" if w.rstrip(".").isupper() else "title" if w[0] != w[0].lower() else "low" for w in (words[i][2], words[j][2])}
            feats.append("name:case " + (cases.pop() if len(cases) == 1 else "both"))
            if feats[-1] == "name:case low" and "known" not in (first, last):
                feats.append("name:low unknown")
            feats += _cues("name", *_near(text, words[i][0], end), ("b", NAME_BEFORE), ("a", NAME_AFTER))
            out.append((words[i][0], end, "name", feats))
    return out


class SemiCRF:
    """Weights by feature; segmentations are sets of candidates that don't overlap."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights or {}

    def score(self, c: Candidate) -> float:
        w = self.weights
        return sum(w.get(f, 0.0) for f in c[3])

    def decode(self, found: list[Candidate]) -> list[Candidate]:
        """The best segmentation: Viterbi over the ends of segments, text between them scoring 0."""
        scored = sorted(((c, s) for c in found if (s := self.score(c)) > 0), key=lambda x: (x[0][1], x[0][0]))
        ends, best, back = [0], [0.0], [None]
        for c, s in scored:
            k = len(ends) - 1
            while ends[k] > c[0]:
                k -= 1
            if best[k] + s > best[-1] + 1e-12:
                ends.append(c[1])
                best.append(best[k] + s)
                back.append((k, c))
        out, k = [], len(ends) - 1
        while k > 0:
            k, c = back[k]
            out.append(c)
        return out[::-1]

    def marginals(self, found: list[Candidate]) -> tuple[float, np.ndarray]:
        """log Z and the probability of each candidate, by forward and backward sums."""
        places = sorted({0, *(c[0] for c in found), *(c[1] for c in found)})
        at = {p: i for i, p in enumerate(places)}
        s = [self.score(c) for c in found]
        fore, back = [0.0] * len(places), [0.0] * len(places)
        by_end, by_start = defaultdict(list), defaultdict(list)
        for k, c in enumerate(found):
            by_end[at[c[1]]].append(k)
            by_start[at[c[0]]].append(k)
        for p in range(1, len(places)):
            fore[p] = np.logaddexp.reduce([fore[p - 1], *(fore[at[found[k][0]]] + s[k] for k in by_end[p])])
        for p in range(len(places) - 2, -1, -1):
            back[p] = np.logaddexp.reduce([back[p + 1], *(back[at[found[k][1]]] + s[k] for k in by_start[p])])
        z = float(fore[-1])
        return z, np.array([math.exp(fore[at[c[0]]] + s[k] + back[at[c[1]]] - z) for k, c in enumerate(found)])

    def fit(self, data: list[tuple[list[Candidate], set[int]]], epochs: int = 25, rate: float = 0.5, l2: float = 1e-3, seed: int = 3) -> SemiCRF:
        """Adaptive gradient ascent on the conditional likelihood of the given segmentations."""
        square: dict[str, float] = defaultdict(lambda: 1e-6)
        w = self.weights
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in rng.permutation(len(data)):
                found, gold = data[i]
                if not found:
                    continue
                _, p = self.marginals(found)
                step: dict[str, float] = defaultdict(float)
                for k, c in enumerate(found):
                    d = (k in gold) - p[k]
                    if abs(d) > 1e-4:
                        for f in c[3]:
                            step[f] += d
                for f, g in step.items():
                    g -= l2 * w.get(f, 0.0)
                    square[f] += g * g
                    w[f] = w.get(f, 0.0) + rate * g / math.sqrt(square[f])
        return self


def training_sentences(names: Names, n: int = 1500, seed: int = 5) -> list[tuple[str, list[tuple[str, str]]]]:
    """Sentences with the values in them, (text, [(type, value)]), written from this module's own wording."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    digits = lambda k: "".join(str(d) for d in rng.integers(0, 10, k))
    given, family = sorted(names.given) or ["asha"], sorted(names.family) or ["verma"]
    letters = lambda k: "".join(chr(97 + int(x)) for x in rng.integers(0, 26, k))
    streets, towns = ["Canal", "Mill Hill", "Rose Garden", "Old Fort", "Temple", "Lake View"], ["Lonavale", "Kettering", "Port Mira", "Sagarpur", "Bridgeton", "Nandigram"]

    def name() -> str:
        mid = pick(["", "", "", f"{letters(1).upper()}. ", pick(given).title() + " "])
        known = rng.random() > 0.2  # else a name from no list
        x = f"{pick(given).title()} {mid}{pick(family).title()}" if known else f"{letters(int(rng.integers(4, 9))).title()} {mid if mid.endswith('. ') else ''}{letters(int(rng.integers(5, 11))).title()}"
        return pick([x, x, x, x, x.upper(), x.lower()])

    def phone() -> str:
        return pick([f"+91 {digits(5)} {digits(5)}", f"+91-{digits(10)}", f"0091 {digits(2)} {digits(4)} {digits(4)}", f"00{digits(2)} {digits(4)} {digits(4)}", f"07{digits(3)} {digits(6)}", f"+44 7{digits(3)} {digits(3)} {digits(3)}", f"1-{digits(3)}-{digits(3)}-{digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"0{pick('123456789')}{digits(1)} {digits(4)} {digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}", digits(10), f"{digits(5)}-{digits(5)}", f"{digits(5)} {digits(5)}"])

    def number() -> str:
        x = pick([digits(12), f"00{digits(10)}", f"00{digits(2)} {digits(4)} {digits(4)}", f"{digits(4)} {digits(4)} {digits(4)}", f"{digits(4)}-{digits(4)}-{digits(4)}", f"{digits(3)}-{digits(2)}-{digits(4)}", letters(5).upper() + digits(4) + letters(1).upper(), letters(1).upper() + digits(7), letters(2).upper() + digits(6)])
        return pick([x, x, x.lower()])

    def email() -> str:
        user = pick([f"{pick(given)}.{pick(family)}", f"{pick(given)}_{digits(2)}", letters(1) + pick(family) + digits(2)])
        host = pick(["example.org", "mail.example", "news-desk.test"])
        return pick([f"{user}@{host}", f"{user} at {host.replace('.', ' dot ')}", f"{user} [at] {host.replace('.', ' [dot] ')}", f"{user}@{host}".upper()])

    def address() -> str:
        kind, town, code = pick(["Street", "Road", "Rd", "St.", "Lane", "Avenue", "Marg", "Boulevard", "Way"]), pick(towns), digits(6)
        street = f"{pick(streets)} {kind}"
        return pick([f"{digits(3)} {street}, {town} {code}", f"Flat {digits(2)}B, {digits(2)} {street}, {town}", f"{digits(2)} {street}, {town} {digits(5)}", f"door {digits(3)}, {street}, {town}-{code}", f"H.No. {digits(3)}, {street.lower()}, {town}", f"Plot No. {digits(3)}, Sector {digits(2)}, {town} - {code[:3]} {code[3:]}", f"{digits(3)}/{digits(1)} {street}, near the old mill, {town} {code}", f"मकान नं. {digits(3)}, गली {digits(2)}, सागरपुर"])

    frames = {
        "email": ["please reply to {}", "my address is {} now", "send it to {} today.", "{} is the right mail."],
        "phone": ["call {} after six", "my number is {} now.", "whatsapp me on {} please", "mera number {} hai", "ring {} tomorrow", "फोन करें {} पर", "llamen al {} hoy.", "keep getting calls from {} daily"],
        "id_number": ["my passport {} was lost", "aadhaar {} does not match.", "tax code {} was refused", "pan {} galat hai", "आधार {} में गलती है", "mi documento {} fue rechazado", "kyc waits for {} again", "they leaked {} in the form"],
        "address": ["we moved to {} last month", "meet at {} on Monday.", "send the papers to {} today", "naya pata {} hai", "rent for {} every month"],
        "name": ["spoke with {} this morning.", "Mr {} confirmed it", "complaint against {} yesterday", "thanks to {} for the help", "{} from the branch called", "{} ji se baat hui", "I met {} at the desk", "my colleague {} will answer", "got the file from {} again", "written by {} and filed", "({}) agreed", "a note of {}, they say", "{} was there", "शाखा से {} ने बताया", "gracias a {} por todo"],
    }
    make = {"email": email, "phone": phone, "id_number": number, "address": address, "name": name}
    neutral = [
        lambda: f"order {digits(4)} {digits(4)} {digits(4)} filled late", lambda: f"ref {digits(12)} settled T+1", lambda: f"ticket no {digits(4)}-{digits(4)} is open", lambda: f"contract NIF{digits(1)}FEB{digits(4)}CE expired",
        lambda: f"oi {digits(7)}.", lambda: f"volume was {digits(1)},{digits(3)},{digits(3)} shares by noon", lambda: f"Signal {digits(6)}: BUY Zelkora above {digits(4)}.{digits(2)}", lambda: f"$ZELKORA traded {digits(3)}.{digits(2)}, bid {digits(3)}.{digits(2)}",
        lambda: "Zelkora Motors opens new outlets", lambda: f"{letters(6).title()} {pick(['Motors', 'Capital', 'Steel', 'Power', 'Finance', 'Cement'])} {pick(['gained', 'fell', 'opens new outlets', 'was flat', 'is weak'])}", lambda: pick(["Stay Light", "Book Half", "Small Caps", "Put Sellers", "Trade Plan", "Morning Note", "Bank Nifty"]) + pick([" today", " is the plan", " will see", ""]),
        lambda: f"thanks to {letters(5).title()} {pick(['Capital', 'Research', 'Desk', 'Motors'])} for the chart", lambda: f"lane {digits(1)} of the road story is priced in", lambda: f"sector {digits(1)} rotation is on", lambda: "@desk_owl12 says hold", lambda: f"order no {digits(10)} was cut", lambda: f"invoice {letters(2).upper()}{digits(6)} is paid",
        lambda: f"R1 {digits(3)}.{digits(2)} R2 {digits(3)}.{digits(2)}", lambda: "call me maybe at support", lambda: f"thanks to {pick(given).title()} Capital for the notes", lambda: "spoke with the branch this morning",
    ]
    out = []
    for _ in range(n):
        parts, gold = [], []
        for _ in range(int(rng.integers(1, 4))):
            if rng.random() < 0.5:
                t = pick(TYPES)
                v = make[t]()
                parts.append(pick(frames[t]).format(v))
                gold.append((t, v.rstrip(".") if t == "name" else v))
            else:
                parts.append(pick(neutral)())
        out.append((pick([". ", " ", " - "]).join(parts), gold))
    # Prose whose words end like names by chance.
    ends = [sorted(e) or ["an"] for e in (names.given_ends, names.family_ends)]
    for _ in range(n // 10):
        pair = " ".join(letters(int(rng.integers(1, 5))) + pick(e) for e in ends)
        out.append((f"{letters(5)} {letters(4)} {pair} {letters(6)}", []))
    return out


def train(names: Names, n: int = 1500, seed: int = 5) -> SemiCRF:
    rng = np.random.default_rng(seed)
    data = []
    for text, gold in training_sentences(names, n, seed):
        text, _ = comparable(text)
        words = {w.rstrip(".").lower() for w in _WORD.findall(text)} & (names.given | names.family)
        lost = rng.random(len(words))
        drop = frozenset(w if u < 0.2 else "!" + w for w, u in zip(sorted(words), lost) if u < 0.4)
        found = candidates(text, names, drop)
        wanted = {(t, comparable(v)[0]) for t, v in gold}
        data.append((found, {k for k, c in enumerate(found) if (c[2], text[c[0] : c[1]]) in wanted}))
    return SemiCRF().fit(data)


def find(text: str | None, model: SemiCRF, names: Names) -> list[tuple[int, int, str]]:
    """(start, end, type) of every value, in the text as it stands."""
    if not text:
        return []
    plain, at = comparable(text)
    best = model.decode(candidates(plain, names))
    return [(a, b, t) if at is None else (at[a], at[b - 1] + 1, t) for a, b, t, _ in best]


def known_names(table: DataFrame, kind: str = "name_kind", text: str = "name_text") -> Names:
    """The table's names; it must have at most ``MOST_NAMES`` rows."""
    rows = table.where(F.col(kind).isNotNull() & F.col(text).isNotNull()).select(kind, text).limit(MOST_NAMES + 1).collect()
    if len(rows) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} known names")
    part = lambda k: {comparable(r[1])[0].lower() for r in rows if r[0] == k}
    return Names(part("given"), part("family"))


class Finder:
    def __init__(self, names: Names, model: SemiCRF | None = None):
        self.names, self.model = names, model or train(names)

    def values(self, df: DataFrame, id_col: str, text: str) -> DataFrame:
        """(id, pii_type, pii_text), each value of an id once."""
        model, names = self.model, self.names

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                out = [(i, t, x[a:b]) for i, x in zip(frame["id"], frame["text"]) for a, b, t in find(x, model, names)]
                yield pd.DataFrame(out, columns=["id", "pii_type", "pii_text"])

        kind = df.schema[id_col].dataType.simpleString()
        return df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInPandas(run, f"id {kind}, pii_type string, pii_text string").distinct()

    def masked(self, df: DataFrame, text: str) -> DataFrame:
        """``df`` with typed placeholders in ``text``."""
        model, names = self.model, self.names

        @F.pandas_udf("string")
        def mask(texts: pd.Series) -> pd.Series:
            def one(x: str | None) -> str | None:
                for a, b, t in reversed(find(x, model, names)):
                    x = x[:a] + PLACEHOLDER[t] + x[b:]
                return x

            return texts.map(one, na_action="ignore")

        return df.withColumn(text, mask(F.col(text)))
