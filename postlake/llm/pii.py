"""Personal data in free text: found, scored and replaced by typed placeholders.

Regular expressions propose spans; checksums (Luhn for card-like, mod 97 for account numbers) confirm
them; words nearby raise or lower the score. Names are proposed by their form and judged by a
lexicon of given names and surnames learned from the mailbox's own address book.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Span = tuple[int, int, str]

#: A proposal is taken from this score on; how many signs before it count as nearby.
TAKEN, NEARBY = 0.5, 32
#: Up to so many names the lexicon goes to the executors whole; beyond, each text gets the part it needs by a join.
LEXICON_LIMIT = 400_000

#: Between parts of an item: a space, or a line end with the quote signs of the next line.
_GAP = r"(?:[  ]|[ ]?\r?\n(?:[ ]{0,3}[A-Za-z]{0,3}[>|][ ]?)*)"
_LINE = r"[ ]?\r?\n(?:[ ]{0,3}[A-Za-z]{0,3}[>|][ ]?)*"

# E-mail addresses, also spelled out.
_AT, _DOT = rf"{_GAP}?(?:\(at\)|\[at\]|\{{at\}}|\(ät\)){_GAP}?|{_GAP}at{_GAP}", rf"{_GAP}?(?:\(dot\)|\[dot\]|\{{dot\}}|\(punkt\)){_GAP}?|{_GAP}(?:dot|punkt|point|punto){_GAP}"
_EMAIL = re.compile(r"[^\W_][\w.+'-]*@[^\W_][\w-]*(?:\.[^\W_][\w-]*)+")
_SPELLED = re.compile(rf"(?i)[^\W_][\w+-]*(?:(?:\.|{_DOT})[\w+-]+)*(?:{_AT})[^\W_][\w-]*(?:(?:\.|{_DOT})[^\W_][\w-]*)+")

#: A spelled-out at sign, and what must follow where it is a plain word.
_AT_SIGN = re.compile(r"(?i)[(\[{](?:at|ät)[)\]}]|(?<=\w)\s(?=(?:[A-Za-z]{0,3}[>|]\s?)*at\s[^.?!,;]{1,40}?\b(?:dot|punkt|punto)\b)")
_DOT_WORD = re.compile(r"(?i)\b(?:dot|punkt|punto)\b")

# Numbers.
_IDS = (
    (re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), 0.6),
    (re.compile(r"(?<![\w-])\d{4}-\d{2}-\d{4}(?![\w-])"), 0.4),
    (re.compile(r"(?<![\w/])\d{2}/\d{3}/\d{5}(?![\w/])"), 0.5),
    (re.compile(rf"(?<![\w-])\d{{2}}{_GAP}\d{{6}}{_GAP}[A-Z]{_GAP}\d{{3}}(?![\w-])"), 0.6),
    (re.compile(r"(?<![\w-])[A-CEGHJ-PR-TW-Z]{2}(?: ?\d{2}){3} ?[A-D](?![\w-])"), 0.5),
    (re.compile(r"(?<![\w-])[A-Z]\d{7}(?![\w-])"), 0.4),
    (re.compile(r"(?<![\w-])[A-Z]{1,2}\d{6,8}[A-Z]?(?![\w-])"), 0.2),
    (re.compile(r"(?<![\w-])\d{8}-?[A-HJ-NP-TV-Z](?![\w-])"), 0.3),
    (re.compile(r"(?<![\w-])[12] ?\d{2} ?[01]\d ?\d{2} ?\d{3} ?\d{3}(?: ?\d{2})?(?![\w-])"), 0.2),
)
_IBAN = re.compile(r"(?<![\w-])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![\w-])")
_CARD = re.compile(r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])")
_PHONE = re.compile(rf"(?<![\w.,/#+-])(?:\+|00(?=[1-9]))?\(?\d{{1,5}}\)?(?:(?:{_GAP}?[-./]{_GAP}?|{_GAP})?\(?\d{{1,8}}\)?){{1,6}}(?![\w]|[-/.,]\d)(?:{_GAP}?(?:ext|x|Durchwahl|poste)\.?{_GAP}?\d{{1,5}})?")
#: A stretch of digits, signs between them and single capitals.
_ZONE = re.compile(r"(?:\b[A-Z]{1,2})?[+(]?\d(?:[\dA-Z]|[ \u00a0()/.\-]|ext|x|\r?\n(?:[ ]{0,3}[A-Za-z]{0,3}[>|][ ]?)*)*")
#: No number of interest has fewer digits than this.
_MANY = re.compile(r"\d(?:[^\d\n]{0,2}\d){5}|\d[ ]?\r?\n[^\d]{0,8}\d")
_DATE = re.compile(r"^\(?(?:(?:19|20)\d\d[-./](?:0?[1-9]|1[0-2])[-./](?:0?[1-9]|[12]\d|3[01])(?!\d)|(?:0?[1-9]|[12]\d|3[01])([./-])(?:0?[1-9]|[12]\d|3[01])\1(?:19|20)?\d\d(?![.\d]))")
_ID_WORDS = re.compile(r"(?i)\b(?:id|ssn|passport|licen[cs]e|national|insurance|identity|tax|personal|social|payroll|form says|should say|passeport|personalausweis|ausweis|steuer\w*|documento|dni|nie|nif|identité|sécurité|identidad|badge)\b")
_PHONE_WORDS = re.compile(r"(?i)\b(?:call|phone|tel|text|mobile|cell|fax|number is|reach|dial|ring|joindre|appel\w*|telefon\w*|anruf\w*|erreich\w*|llam\w*|teléfono|téléphone|portable|handy|failing that|or)\b|(?:^|[\s;])[MTPF]:? $|tel=")
_OTHER_WORDS = re.compile(r"(?i)(?:\b(?:meeting|parcel|po|purchase order|order|invoice|inv|ticket|case|build|block|room|ref|reference|document|doc|version|serial|sku|item|bestellung|rechnung|paket|réunion|colis|commande|facture|pedido|factura|paquete|folder|row|page|number HR|HR)[\s.:#№-]*|#|0x)$")

# Postal addresses.
_CAP = r"[A-ZÀ-ÖØ-Þ][\w'’-]*"
_WORDS = rf"{_CAP}(?:{_GAP}{_CAP}){{0,2}}"
_UNIT = rf"(?:(?:Flat|Apt\.?|Apartment|Unit|Suite|Room){_GAP}\d+\w?,?{_GAP})"
_EN_WAY = r"(?:Street|St|Road|Rd|Lane|Ln|Court|Ct|Row|Crescent|Cres|Avenue|Ave|Close|Drive|Dr|Way|Place|Pl|Square|Sq|Terrace|Gardens|Gdns|Mews|Boulevard|Blvd|Parade|Grove|Walk)\b\.?"
_DE_WAY = r"[A-ZÄÖÜ][\w-]*(?:straße|strasse|str\.|weg|allee|gasse|platz|ufer|damm|ring|graben|steig|markt)|(?:[A-ZÄÖÜ][\w-]*[ -])+(?:Straße|Str\.|Weg|Allee|Gasse|Platz|Ring|Ufer|Damm|Hafen|Deich|Markt|Graben|Tor|Hof|Berg|Brücke|Steig|Wall|Kai|Chaussee|Promenade)"
_FR_WAY = r"(?:rue|quai|avenue|boulevard|chemin|place|allée|impasse|cours|route|square|passage|sentier)"
_ES_WAY = r"(?:Calle|Paseo|Avenida|Avda\.|Plaza|Camino|Carrera|Ronda|Travesía|Callejón|C/)"
_TOWN = rf"(?:,?{_GAP}(?:\d{{4,5}}{_GAP}{_WORDS}|{_WORDS}{_GAP}\d{{4,5}}\b|(?<=,[ \n]){_WORDS}))?"
#: Each form of address with what a text must hold for it, which is cheap to look for.
_ADDRESSES = (
    (re.compile(r"Box|Postfach|Apartado|Boîte|BP "), re.compile(rf"(?:P\.?{_GAP}?O\.?{_GAP}Box|Postfach|Apartado(?: de Correos)?|Boîte postale|\bBP){_GAP}\d+")),
    (re.compile(rf"[ \n]{_EN_WAY}"), re.compile(rf"{_UNIT}?(?<![\w.-])\d{{1,5}}[a-z]?,?{_GAP}(?:{_CAP}{_GAP}){{1,3}}{_EN_WAY}")),
    (re.compile(rf"[\d, \n]{_FR_WAY}[ \n]"), re.compile(rf"(?<!\w){_UNIT}?\d{{1,4}}(?:{_GAP}(?:bis|ter))?,?{_GAP}{_FR_WAY}{_GAP}(?:(?:de la|de l'|du|des|de|d'){_GAP}?)?{_WORDS}")),
    (re.compile(_ES_WAY), re.compile(rf"(?<!\w){_ES_WAY}{_GAP}(?:(?:de los|de las|de la|del|de){_GAP})?{_WORDS},?{_GAP}\d{{1,4}}")),
    (re.compile(r"(?:straße|strasse|str\.|weg|allee|gasse|platz|ufer|damm|ring|graben|steig|markt|Straße|Str\.|Weg|Allee|Gasse|Platz|Ring|Ufer|Damm|Hafen|Deich|Markt|Graben|Tor|Hof|Berg|Brücke|Steig|Wall|Kai|Chaussee|Promenade)\s\W{0,3}\d"), re.compile(rf"(?<!\w)(?:{_DE_WAY}){_GAP}\d{{1,4}}{_GAP}?[a-z]?\b")),
    (re.compile(r"\d[a-z]?(?:,\s|[ ]?\r?\n)[^\d\n]{0,6}\d{5}\s"), re.compile(rf"(?<!\w)(?:(?:Am|Im|Zum|Zur|An|Auf|Bei|Hinterm|Hinter|Unterm|Unter)(?:{_GAP}de[rnm])?(?:{_GAP}{_CAP}){{1,3}}|{_CAP}(?: {_CAP}){{0,3}}){_GAP}\d{{1,4}}[a-z]?(?:,{_GAP}|{_LINE})\d{{5}}{_GAP}{_CAP}")),
)
_UNIT_BEFORE = re.compile(rf"(?:{_UNIT})$")

# Names.
_TOKEN = re.compile(r"(?<![\w@.])[A-ZÀ-ÖØ-Þ][^\W\d_]*(?:['’-][A-ZÀ-ÖØ-Þa-zß-ÿ][^\W\d_]*)*")
_NEAR = re.compile(rf"(?:{_GAP}| {_GAP})\Z")
_COMMA = re.compile(rf",{_GAP}\Z")
_STOP_AFTER_INITIAL = re.compile(rf"\.{_GAP}?\Z")
#: Words that open a letter before a name.
_GREETING = re.compile(r"(?im)^[ ]{0,3}(?:[A-Za-z]{0,3}[>|][ ]?)*(?:hi|hello|hey|dear|good (?:morning|afternoon|evening)|morning|hallo|liebe/r|liebe|lieber|guten (?:morgen|tag)|cher/chère|cher|chère|bonjour|salut|estimado/a|estimado|estimada|hola|querido|querida|buenos días)[ ]+$")
#: Words that are no names where a name may stand.
_NO_NAME = frozenset(
    "all team everyone everybody both there colleagues folks sir madam the this that we you i it he she they our your his her no yes if when why what who how where could can may please thanks thank regards best cheers kind from to sent subject date cc"
    " on in at by for of and or but as to not just one two three some any each every before after until while since let mark will made rose great new old next first last mr mrs ms dr prof head box monday tuesday wednesday thursday friday saturday sunday"
    " january february march june july august september october november december apr jan feb mar jun jul aug sep oct nov dec sie der die das ein eine wir ich ihr bitte vielen le la les un une nous vous el los las una es se de del van von zu".split()
)
#: Given names that are also common words or months.
_COMMON_WORD = frozenset("april may june august mark rose will grace hope faith joy art bill rob sue pat drew frank jack dick rich chuck max ray dawn eve ivy lily iris ruby violet daisy jo kit peg meg sandy guy dean dale penny olive heather basil miles chip skip lance chase grant ward wade earl duke gene dot fern hazel summer autumn amber jasmine crystal carol".split())
_MONTH = frozenset(("april", "may", "june", "august"))
_PERSON_VERB = re.compile(rf"(?:'s\b|’s\b|{_GAP}(?:has|had|asked|knows|does|did|is|was|said|says|wrote|called|told|wants|answered)\b)")
_PERSON_BEFORE = re.compile(rf"(?i)\b(?:met|ask|asked|for|with|cc|to|and|von|an|de|of|than|tell|told|c/o|à|a|joindre|contestado|ring|did|hat|reach|call|phone|tell){_GAP}\Z")


def fold(word: str) -> str:
    low = word.lower()
    return low if low.isascii() else "".join(c for c in unicodedata.normalize("NFD", low) if not unicodedata.combining(c)).replace("ł", "l").replace("ø", "o")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _nearby(text: str, at: int) -> str:
    return re.sub(r"\s*\n[ ]{0,3}(?:[A-Za-z]{0,3}[>|][ ]?)*", " ", text[max(0, at - NEARBY) : at])


def numbers(text: str) -> list[tuple[int, int, str, float]]:
    """Proposals with their score: identity numbers and phones."""
    out = []
    if not _MANY.search(text):
        return out
    zones = [(m.start(), min(len(text), m.end() + 2)) for m in _ZONE.finditer(text) if sum(map(str.isdigit, m.group())) > 5]
    if not zones:
        return out
    for pattern, base in _IDS:
        for m in (x for a, b in zones for x in pattern.finditer(text, a, b)):
            before = _nearby(text, m.start())
            score = base + 0.4 * bool(_ID_WORDS.search(before)) - 0.8 * bool(_OTHER_WORDS.search(before))
            score += 0.2 * (text[m.start() - 1 : m.start()] == "(" and text[m.end() : m.end() + 1] == ")")
            out.append((m.start(), m.end(), "id_number", score))
    for m in (x for a, b in zones for x in _IBAN.finditer(text, a, b)):
        bare = m.group().replace(" ", "")
        if 15 <= len(bare) <= 34 and mod97(bare):
            out.append((m.start(), m.end(), "id_number", 0.9))
    for m in (x for a, b in zones for x in _CARD.finditer(text, a, b)):
        if luhn(re.sub(r"\D", "", m.group())):
            before = _nearby(text, m.start())
            out.append((m.start(), m.end(), "id_number", 0.45 + 0.4 * bool(_ID_WORDS.search(before)) - 0.8 * bool(_OTHER_WORDS.search(before)) + 0.3 * bool(re.search(r"(?i)\b(?:card|visa|karte|carte|tarjeta)\b", before))))
    for m in (x for a, b in zones for x in _PHONE.finditer(text, a, b)):
        s, start, end = m.group(), m.start(), m.end()
        if s[0] == "(" and not re.match(r"\(\+?\d{1,5}\)", s):
            s, start = s[1:], start + 1
        if s.count(")") > s.count("("):
            cut = s.rindex(")")
            s, end = s[:cut], start + cut
        core = re.split(r"(?i)ext|x|Durchwahl|poste", s)[0]
        digits = re.sub(r"\D", "", core)
        if not 9 <= len(digits) <= 15 or _DATE.match(s):
            continue
        before = _nearby(text, start)
        if s[0] == "+" or s.startswith("00"):
            score = 0.8
        elif s[0] == "(" or s[0] == "0" or re.match(r"\d{3}[-.]\d{3}[-.]\d{4}(?!\d)", s):
            score = 0.65
        elif re.match(r"\d{3} \d{3} \d{4}(?!\d)", s):
            score = 0.5
        else:
            score = 0.2
        if _PHONE_WORDS.search(before):
            score += 0.3
        if _OTHER_WORDS.search(before) and s[0] != "+":
            score -= 0.8
        out.append((start, end, "phone", score))
    return out


def tokens(text: str) -> list[tuple[int, int, str]]:
    """(start, end, word) of the words that may be names, without a possessive 's."""
    toks = [(m.start(), m.end(), m.group()) for m in _TOKEN.finditer(text)]
    return [(a, b - 2, w[:-2]) if w.endswith(("'s", "’s")) else (a, b, w) for a, b, w in toks]


def names(text: str, given: frozenset | set, surname: frozenset | set) -> list[tuple[int, int, str, float]]:
    """Names of persons: given and surname in either order, initial and surname, a given name alone."""
    toks = tokens(text)
    low = [fold(w) for _, _, w in toks]
    n, i, out = len(toks), 0, []

    def gap(k: int) -> str:
        return text[toks[k][1] : toks[k + 1][0]] if k + 1 < n and toks[k + 1][0] - toks[k][1] < 14 else "\0"

    def near(k: int) -> bool:
        # Capitals before a quote sign are the sign's, not a name's.
        return bool(_NEAR.match(gap(k))) and text[toks[k + 1][1] : toks[k + 1][1] + 1] != ">"

    def plain(k: int) -> bool:
        return k < n and len(toks[k][2]) > 1 and low[k] not in _NO_NAME

    while i < n:
        a, b, w = toks[i]
        g, known = gap(i), low[i] in given
        if len(w) == 1 and text[b : b + 1] == ".":
            # Initials, then a surname; an abbreviation such as P.O. is none.
            j = i
            while j + 1 < n and len(toks[j][2]) == 1 and _STOP_AFTER_INITIAL.match(gap(j)):
                j += 1
            abbreviation = text[max(0, a - 1) : a] == "." or text[b + 1 : b + 2].isalpha() and len(toks[j][2]) == 1
            if j > i and plain(j) and len(toks[j][2]) > 2 and not abbreviation and (low[j] in surname or (toks[j][2][1].islower() and not known and _surname_like(text, a, low[j]))):
                out.append((a, toks[j][1], "name", 0.8))
                i = j + 1
                continue
        if low[i] in surname and not known and i + 1 < n:
            comma = bool(_COMMA.match(g))
            second = low[i + 1] in given
            if (comma or near(i)) and second and not (near(i + 1) and plain(i + 2) and low[i + 2] in surname and comma):
                out.append((a, toks[i + 1][1], "name", 0.8))
                i += 2
                continue
            if comma and len(toks[i + 1][2]) == 1 and text[toks[i + 1][1] : toks[i + 1][1] + 1] == ".":
                out.append((a, toks[i + 1][1], "name", 0.7))
                i += 2
                continue
        if known or (plain(i) and _named_by_place(text, a, b)):
            follows = near(i) and plain(i + 1) and low[i + 1] not in given
            middle = near(i) and i + 2 < n and len(toks[i + 1][2]) == 1 and _STOP_AFTER_INITIAL.match(gap(i + 1)) and plain(i + 2)
            common = low[i] in _COMMON_WORD
            if middle:
                out.append((a, toks[i + 2][1], "name", 0.9))
                i += 3
                continue
            if known and follows and (not common or low[i + 1] in surname or (toks[i + 1][2][0].isupper() and "\n" not in g)):
                out.append((a, toks[i + 1][1], "name", 0.9))
                i += 2
                continue
            place = _named_by_place(text, a, b)
            if place or not common:
                score = 0.7
            elif _PERSON_VERB.match(text, b) or (_PERSON_BEFORE.search(text[max(0, a - 16) : a]) and low[i] not in _MONTH):
                score = 0.6
            elif low[i] in _MONTH and re.search(r"(?i)\b(?:met|did|hat|ring|cher|for)\s\Z", text[max(0, a - 6) : a]) and not re.match(r"\s+(?:\d|figures|review|window)", text[b : b + 10]):
                score = 0.55
            else:
                score = 0.1
            # Upper case alone may be an abbreviation.
            if len(w) > 1 and w.isupper() and not place:
                score -= 0.4
            out.append((a, b, "name", score))
        i += 1
    return out


def _surname_like(text: str, at: int, word: str) -> bool:
    """An initial in the middle of a sentence, or at the start of a line, before an unknown word."""
    return word not in _NO_NAME and (at == 0 or text[at - 1] in " \n(<\"'/=:")


def _named_by_place(text: str, a: int, b: int) -> bool:
    """A word alone in its line, behind a greeting's opening or under a closing phrase."""
    start = text.rfind("\n", 0, a) + 1
    if a - start > 40:
        return False
    head = text[start:a]
    if head[-1:] == " " and _GREETING.match(head):
        return True
    if not re.match(r"^[ ]{0,3}(?:[A-Za-z]{0,3}[>|][ ]?)*$", head):
        return False
    end = text.find("\n", b)
    rest = text[b : len(text) if end < 0 else end].strip()
    if rest not in ("", ",", " -", "-", ":", "!"):
        return False
    above = [x for x in text[:start].split("\n")[-4:] if re.sub(r"^[ ]{0,3}(?:[A-Za-z]{0,3}[>|][ ]?)*", "", x).strip()]
    if rest and fold(text[a:b]) in _COMMON_WORD:
        return True
    if rest:
        return not above or bool(re.search(r":\s*$|(?i:subject|objet|betreff|asunto)\W", above[-1]))
    return bool(above) and bool(re.match(r"(?i)^[ ]{0,3}(?:[A-Za-z]{0,3}[>|][ ]?)*(?:many |kind |best |warm |yours |with )?(?:thanks|thank you|regards|best|cheers|sincerely|wishes|yours|mfg|gr[uü](?:ß|ss)\w*|mit freundlichen grüßen|viele grüße|liebe grüße|cordialement|bien à vous|saludos(?: cordiales)?|un saludo|thanks and.*|.*wishes),?\s*$", above[-1]))


def spans(text: str, given: frozenset | set, surname: frozenset | set) -> list[Span]:
    """(start, end, kind) of what is taken, in order, none overlapping: the kinds in the order e-mail,
    address, identity number, phone, name, and within one kind the longer first."""
    found: list[tuple[int, int, str, float]] = [(m.start(), m.end(), "email", 1.0) for m in _EMAIL.finditer(text)] if "@" in text else []
    for m in _AT_SIGN.finditer(text):
        w = max(0, m.start() - 64)
        while 0 < w < m.start() and not text[w - 1].isspace():
            w += 1
        for x in _SPELLED.finditer(text, w, min(len(text), m.end() + 96)):
            if x.start() < m.start() < x.end() and (m.group()[0] in "([{" or _DOT_WORD.search(x.group())):
                found.append((x.start(), x.end(), "email", 1.0))
                break
    for key, pattern in _ADDRESSES:
        if key.search(text):
            for m in pattern.finditer(text):
                a = m.start()
                u = _UNIT_BEFORE.search(text[max(0, a - 16) : a])
                found.append((a - len(u.group()) if u else a, m.end(), "address", 1.0))
    found += numbers(text)
    found += names(text, given, surname)
    order = {"email": 0, "address": 1, "id_number": 2, "phone": 3, "name": 4}
    taken: list[Span] = []
    used = bytearray(len(text))
    for a, b, kind, score in sorted(found, key=lambda x: (order[x[2]], -x[3], x[0] - x[1], x[0])):
        if score >= TAKEN and not any(used[a:b]):
            used[a:b] = b"\1" * (b - a)
            taken.append((a, b, kind))
    return sorted(taken)


def replaced(text: str, found: list[Span]) -> str:
    out, at = [], 0
    for a, b, kind in found:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join(out) + text[at:]


# The lexicon


def _plain(c: Column) -> Column:
    """Letters without their marks, in lower case."""
    return F.regexp_replace(F.translate(F.lower(c), "äáàâãåąçćčéèêëęíìîïłñńóòôöõøśšúùûüýÿźżž", "aaaaaaaccceeeeeiiiilnnoooooossuuuuyyzzz"), r"\p{M}", "")


def lexicon(messages: DataFrame, recipients: DataFrame, name_forms: DataFrame) -> DataFrame:
    """(kind, word): given names and surnames, without marks and in lower case.

    A display name of two words whose first is the first part of the address given.surname@ gives a
    given name and a surname; the given names of name_forms count too.
    """
    seen = messages.select(F.col("sender_name").alias("name"), F.col("sender_email").alias("email")).unionByName(recipients.select("name", "email")).where("name IS NOT NULL AND email IS NOT NULL").distinct()
    two = r"^['\"(]?([\p{L}'’-]{2,})[\s]+(?:\p{L}\.\s+)?([\p{L}'’-]{3,})"
    turned = r"^['\"(]?([\p{L}'’-]{3,}),\s+([\p{L}'’-]{2,})"
    local = F.regexp_extract(F.lower(F.trim("email")), r"^([a-z]{2,})\.([a-z]{3,})@", 1)
    a, b = F.regexp_extract("name", two, 1), F.regexp_extract("name", two, 2)
    c, d = F.regexp_extract("name", turned, 2), F.regexp_extract("name", turned, 1)
    pairs = seen.select(local.alias("first"), F.explode(F.array(F.struct(_plain(a).alias("g"), _plain(b).alias("s")), F.struct(_plain(c).alias("g"), _plain(d).alias("s")), F.struct(_plain(b).alias("g"), _plain(a).alias("s")))).alias("p")).where("first <> '' AND p.g = first AND p.s <> ''")
    learned = pairs.select(F.explode(F.array(F.struct(F.lit("given").alias("kind"), F.col("p.g").alias("word")), F.struct(F.lit("surname").alias("kind"), F.col("p.s").alias("word")))).alias("x")).select("x.*")
    forms = name_forms.select(F.explode(F.array("short_form", "full_form")).alias("word")).where("word IS NOT NULL").select(F.lit("given").alias("kind"), _plain(F.col("word")).alias("word"))
    return learned.unionByName(forms).distinct()


def _texts(messages: DataFrame, bodies: DataFrame) -> DataFrame:
    body = bodies.select("nid", F.lit("body_plain").alias("field_name"), F.col("body_plain").alias("text"))
    return body.unionByName(messages.select("nid", F.lit("subject").alias("field_name"), F.col("subject").alias("text"))).where("text IS NOT NULL AND text <> ''")


def _apply(texts: DataFrame, lex: DataFrame, make, schema: str) -> DataFrame:
    """Run ``make(pdf, i -> (given, surname))`` over the texts with the lexicon at hand."""
    spark = texts.sparkSession
    lex = lex.persist()
    try:
        size = lex.count()
        words = [(r["kind"], r["word"]) for r in lex.toLocalIterator()] if size <= LEXICON_LIMIT else None
    finally:
        lex.unpersist()
    if words is not None:
        held = spark.sparkContext.broadcast((frozenset(w for k, w in words if k == "given"), frozenset(w for k, w in words if k == "surname")))

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                yield make(pdf, lambda i: held.value)

        return texts.mapInPandas(run, schema)
    # Each text with the names that occur in it, by the same words that names() looks up.
    def words_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = [(n, f, w) for n, f, text in zip(pdf["nid"], pdf["field_name"], pdf["text"]) for w in {fold(x) for _, _, x in tokens(text)}]
            yield pd.DataFrame(rows, columns=["nid", "field_name", "word"])

    inside = texts.mapInPandas(words_of, "nid long, field_name string, word string")
    mine = inside.join(lex, "word").groupBy("nid", "field_name").agg(F.collect_set(F.when(F.col("kind") == "given", F.col("word"))).alias("given"), F.collect_set(F.when(F.col("kind") == "surname", F.col("word"))).alias("surname"))

    def run_with(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            own = [(frozenset(g if g is not None else ()), frozenset(s if s is not None else ())) for g, s in zip(pdf["given"], pdf["surname"])]
            yield make(pdf, own.__getitem__)

    return texts.join(mine, ["nid", "field_name"], "left").mapInPandas(run_with, schema)


def found(messages: DataFrame, bodies: DataFrame, recipients: DataFrame, name_forms: DataFrame) -> DataFrame:
    """(nid, field_name, start_pos, pii_kind): every item, start_pos in code points from 1.

    NULL and empty texts hold none; whole texts however long; repeated rows give theirs once.
    """

    def make(pdf: pd.DataFrame, lex) -> pd.DataFrame:
        rows = [(n, f, a + 1, k) for i, (n, f, t) in enumerate(zip(pdf["nid"], pdf["field_name"], pdf["text"])) for a, _, k in spans(t, *lex(i))]
        return pd.DataFrame(rows, columns=["nid", "field_name", "start_pos", "pii_kind"])

    return _apply(_texts(messages, bodies), lexicon(messages, recipients, name_forms), make, "nid long, field_name string, start_pos int, pii_kind string")


def masked(messages: DataFrame, bodies: DataFrame, recipients: DataFrame, name_forms: DataFrame) -> DataFrame:
    """(nid, field_name, text): the texts with [EMAIL], [PHONE], [ID_NUMBER], [ADDRESS] and [NAME]."""

    def make(pdf: pd.DataFrame, lex) -> pd.DataFrame:
        return pd.DataFrame({"nid": pdf["nid"], "field_name": pdf["field_name"], "text": [replaced(t, spans(t, *lex(i))) for i, t in enumerate(pdf["text"])]})

    return _apply(_texts(messages, bodies), lexicon(messages, recipients, name_forms), make, "nid long, field_name string, text string")
