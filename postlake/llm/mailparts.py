"""The parts of a plain mail body by its own marks: quotes, history, signatures and notices.

Pure functions on one body; :mod:`postlake.llm.quoted` compares sentences across messages.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

NEW, QUOTE, INTRO, HISTORY, SIGN, NOTICE = "new", "quote", "intro", "history", "sign", "notice"

#: Words of the fields of a quoted header, in the languages of the mailbox.
_FROM = "From|Von|De|Da|Van|Expéditeur|Remitente"
_OTHER = "Sent|Date|Gesendet|Datum|Envoyé|Enviado|Enviado el|Fecha|To|An|À|A|Para|Cc|CC|Kopie|Subject|Betreff|Objet|Asunto|Reply-To|Inviato|Oggetto|Verzonden|Aan|Onderwerp"
#: Phrases that close a letter.
_CLOSINGS = (
    "thanks|many thanks|thank you|thanks a lot|thanks and regards|thanks and best wishes|many thanks and best wishes|best|all the best|best wishes|best regards|kind regards|warm regards|warmest regards|regards|with regards|with kind regards|"
    "cheers|sincerely|yours|yours sincerely|yours faithfully|yours truly|sincerely yours|cordially|respectfully|take care|talk soon|"
    "mit freundlichen grüßen|mit freundlichem gruß|mit besten grüßen|freundliche grüße|viele grüße|liebe grüße|beste grüße|schöne grüße|herzliche grüße|beste grüsse|viele grüsse|mit freundlichen grüssen|grüße|gruß|mfg|lg|vg|danke|vielen dank|"
    "cordialement|bien cordialement|bien à vous|bien à toi|sincères salutations|meilleures salutations|salutations|amicalement|merci|merci beaucoup|bonne journée|"
    "saludos|saludos cordiales|un saludo|un cordial saludo|cordiales saludos|atentamente|muchas gracias|gracias|un abrazo|abrazos"
)
_CLOSING = re.compile(rf"(?i)^\s*(?:{_CLOSINGS})\s*[,.!;–—-]*\s*$")
#: Signs that a paragraph is a notice of lawyers, lists or gateways.
_NOTICE = re.compile(
    r"(?i)(?:e-?mail|message|communication|transmission)\b.{0,80}\b(?:confidential|privileged)|\bconfidential(?:ity)? (?:notice|and intended)|\b(?:confidentiality|legal|privacy) (?:notice|disclaimer)\b|\bdisclaimer:|intended (?:solely|only) for|(?:not|if you are) the intended recipient"
    r"|accepts? no (?:liability|responsibility)|(?:views|opinions) expressed (?:here|in this)|consider the environment|(?:originated|came) from outside|originated outside|(?:don't|do not) often get (?:e-?mail|mail|messages?) from|\[external\]|external (?:e-?mail|sender|message)\b.{0,40}(?:caution|warning|check)"
    r"|checked it on arrival|scanned (?:by|for) |\bto unsubscribe\b|^\s*unsubscribe\b|you (?:get|receive|are receiving|received) this (?:digest|e-?mail|message|mail|newsletter)|\bmailing list\s*$|all rights reserved"
    r"|diese e-?mail enthält|vertrauliche informationen|nicht der richtige adressat|vernichten sie|absender prüfen|bitte denken sie an die umwelt|rechtlich geschützt"
    r"|ce (?:message|courriel).{0,60}confidentiel|sont confidentiels|réservés à leurs? destinataire|pensez à l'environnement|expéditeur externe|courriel externe"
    r"|este (?:mensaje|correo).{0,60}confidencial|dirige exclusivamente|destinatario indicado|medio ambiente antes de imprimir|remitente externo|correo externo"
)
#: Every match of _NOTICE holds one of these; looking for them first is cheap.
_NOTICE_KEYS = tuple(
    "confiden|privileg|disclaimer|intended|liability|responsib|expressed|environment|outside|often get|external|arrival|scanned|unsubscribe|receiv|digest|you get this|mailing list|all rights"
    "|enthält|vertraulich|adressat|vernichten|absender|umwelt|geschützt|réserv|courriel|environnement|expéditeur|correo|exclusivamente|destinatario|medio ambiente|remitente".split("|")
)
_KEY_WORDS = tuple((k, max(k.split(), key=len)) for k in _NOTICE_KEYS)
_TAGLINE = re.compile(
    r"(?i)^\s*(?:sent (?:from|with|using|via) (?:my |a |the )?\S.*|get (?:the )?\S+(?: \S+)? (?:app )?for \S.*|von (?:meinem|meiner) .{1,40}gesendet\b.*|gesendet (?:mit|von|über) \S.*|envoyé (?:depuis|de|avec|à partir de) \S.*|enviado (?:desde|con|mediante) \S.*|inviato da \S.*|diese nachricht wurde von .{1,40} gesendet.*)$"
)
_QUOTED = re.compile(r"^\s{0,3}(?:[A-Z][A-Za-z]{0,3})?>|^\s{0,3}\|(?!\|)")
_RULE = re.compile(r"^\s*([-_=*~#—–])(?:\s?\1)+\s*$|^\s*[—–]\s*$")
_SEPARATOR = re.compile(r"(?i)^\s*(?:-{2,}\s*\S.{2,60}?\s*-{2,}|_{2,}\s*\S.{2,60}?\s*_{2,})\s*$|^\s*(?:begin forwarded message|anfang der weitergeleiteten nachricht|début du message (?:réexpédié|transféré)|inicio del mensaje reenviado)\s*:?\s*$")
_SEPARATOR_WORD = re.compile(r"(?i)original|forward|weitergeleitet|ursprüngliche|transféré|transmis|d'origine|reenviado|mensaje|message|nachricht|inoltrato")
_FIELD = re.compile(rf"^\s*\*?(?:{_FROM}|{_OTHER})\s?:\*?\s*(.*)$")
_FROM_FIELD = re.compile(rf"^\s*\*?(?:{_FROM})\s?:\*?\s+(\S.*)$")
_INTRO = re.compile(
    r"(?i)^\s*(?:on\s.{4,140}\bwrote\s*:|(?:am|on)\s.{4,140}\bschrieb\b.{0,100}:|le\s.{4,140}\ba écrit\s?:|el\s.{4,140}\bescribió\s?:|il\s.{4,140}\bha scritto\s?:|op\s.{4,140}\bschreef\b.{0,80}:"
    r"|\S.{1,80}\swrote(?: on [^:]{4,40}(?::\d\d)*[^:]{0,6})?\s*:|\S.{1,80}\sschrieb(?: am .{4,40})?\s*:|\S.{1,80}\sa écrit(?: le .{4,40})?\s*:|\S.{1,80}\sescribió(?: el .{4,40})?\s*:|(?:quoting|zitat von|citando a|citation de)\s\S.{1,100}:)\s*$"
)
_INTRO_START = re.compile(r"(?i)^\s*(?:on|am|le|el|il|op)\s+\S|^\s*\S.{1,60}\s(?:wrote|schrieb|escribió)\b")
_CONTACT = re.compile(r"(?i)\S@\S+\.\S|^\s*(?:(?:tel|phone|mobile|mob|fax|m|t|p|f|telefon|téléphone|teléfono|handy)\b\.?:?\s*)?[+(]?\d[\d\s()./-]{5,}(?:\s*(?:ext|x)\.?\s*\d+)?\s*$|\b(?:GmbH|AG|Inc|Ltd|LLC|Limited|B\.V|S\.A)\b")
_STOPPED = re.compile(r"[.!?…]['\"»”)]*\s*$")
_NAME_LINE = re.compile(r"^\s*\*?(?:(?:Dr|Mr|Mrs|Ms|Prof)\.?\s)?[^\W\d_][\w.'’-]*(?:\s+[^\W\d_][\w.'’-]*){0,3}\*?\s*$")


def _name_like(line: str) -> bool:
    if len(line) > 50 or not _NAME_LINE.match(line):
        return False
    return all(w[0].isupper() for w in line.strip(" *\t").split() if w[0].isalpha())


def _keys_of(body: str) -> list[str]:
    """The keys that paragraphs of the body may hold. Of a key of several words, between which a line may end, the longest tells."""
    low = body.lower()
    return [k for k, word in _KEY_WORDS if word in low]


def _notice(text: str, keys: Sequence[str] = _NOTICE_KEYS) -> bool:
    low = text.lower()
    return any(k in low for k in keys) and bool(_NOTICE.search(low))


def _contact_block(rows: list[str]) -> bool:
    """A name with what belongs to it: short lines that are no sentences, one of them a contact or title."""
    if not rows or not _name_like(rows[0]) or any(len(r) > 90 for r in rows):
        return False
    return len(rows) > 1 and not any(_STOPPED.search(r) and not _CONTACT.search(r) and len(r.split()) > 4 for r in rows)


def parts(body: str) -> list[str]:
    """The part of every line (split at LF); blank lines get ""."""
    lines = body.split("\n")
    if "\r" in body:
        lines = [x.rstrip("\r") for x in lines]
    n = len(lines)
    blank = [not x.strip() for x in lines]
    kind = ["" if b else NEW for b in blank]

    # Quoted lines.
    if ">" in body or "|" in body:
        for i, x in enumerate(lines):
            if not blank[i] and (">" in x or "|" in x) and _QUOTED.match(x):
                kind[i] = QUOTE

    # Introductions of quotes, on one line or two.
    cut = n
    for i, x in enumerate(lines):
        if ":" not in x or kind[i] != NEW or not x.rstrip().endswith(":"):
            continue
        first = -1
        if _INTRO.match(x):
            first = i
        elif i and kind[i - 1] == NEW and len(x) + len(lines[i - 1]) < 240 and _INTRO_START.match(lines[i - 1]) and _INTRO.match(lines[i - 1].strip() + " " + x.strip()):
            first = i - 1
        if first < 0:
            continue
        after = next((k for k in range(i + 1, n) if not blank[k]), -1)
        quoted = after >= 0 and kind[after] == QUOTE
        if not quoted and not re.search(r"\d", "".join(lines[first : i + 1])) and "@" not in x and not re.match(r"(?i)\s*(?:quoting|zitat|citando|citation)", x):
            continue
        for k in range(first, i + 1):
            kind[k] = INTRO
        if not quoted and after >= 0:
            cut = min(cut, after)

    # A forwarded or replied-to header: all behind it is history.
    for i, x in enumerate(lines):
        if i >= cut:
            break
        if kind[i] != NEW:
            continue
        if ":" in x and _FROM_FIELD.match(x):
            fields, k = 0, i + 1
            while k < n and not blank[k] and k < i + 9:
                fields += bool(_FIELD.match(lines[k]))
                k += 1
            if fields < 2 and not (k == i + 1 and i and kind[i - 1] == HISTORY):
                continue
            start = i
        elif _SEPARATOR.match(x) and _SEPARATOR_WORD.search(x):
            start = i
        else:
            continue
        back = start - 1
        while back >= 0 and blank[back]:
            back -= 1
        if back >= 0 and kind[back] == NEW and (_RULE.match(lines[back]) or (_SEPARATOR.match(lines[back]) and _SEPARATOR_WORD.search(lines[back]))):
            start = back
        cut = min(cut, start)
        break
    for k in range(cut, n):
        if kind[k] == NEW:
            kind[k] = HISTORY

    # Paragraphs of what is left.
    keys = _keys_of(body)
    i, signed, last_close = 0, False, False
    while i < n:
        if kind[i] != NEW:
            if kind[i]:
                signed = last_close = False
            i += 1
            continue
        j = i
        while j < n and kind[j] == NEW:
            j += 1
        rows = lines[i:j]
        text = " ".join(r.strip() for r in rows)
        whole = None
        if (len(rows) > 1 or len(text) < 400) and _notice(text, keys):
            whole = NOTICE
        elif _RULE.match(rows[0]) and len(rows) > 1:
            whole = SIGN if len(rows[0].strip()) < 8 or _contact_block(rows[1:]) else NOTICE
            if len(rows[0].strip()) >= 8 and not _contact_block(rows[1:]) and len(text) > 600 and not _notice(text, keys):
                whole = None
        elif _RULE.match(rows[0]) and len(rows) == 1:
            nxt = j
            while nxt < n and blank[nxt]:
                nxt += 1
            end = nxt
            while end < n and kind[end] == NEW:
                end += 1
            if nxt < n and kind[nxt] == NEW and (_contact_block(lines[nxt:end]) or _notice(" ".join(lines[nxt:end]), keys)):
                whole = SIGN
                signed = True
        elif len(rows) == 1 and _TAGLINE.match(rows[0]) and len(rows[0]) < 80:
            whole = SIGN
        elif last_close and len(rows) <= 8 and _name_like(rows[0]) and (len(rows) == 1 or _contact_block(rows)):
            whole = SIGN
        elif _contact_block(rows) and (signed or any(_CONTACT.search(r) for r in rows[1:]) or rows[0].strip().startswith("*") or re.search(r"\s[|-]\s|,\s", rows[1])):
            whole = SIGN
        close = False
        if whole:
            for k in range(i, j):
                kind[k] = whole
            signed = signed or whole == SIGN
        else:
            for k in range(i, j):
                x = lines[k]
                if len(x) < 60 and _CLOSING.match(x) and all(len(r) < 80 and not (_STOPPED.search(r) and len(r.split()) > 4) for r in lines[k + 1 : j]):
                    for q in range(k, j):
                        kind[q] = SIGN
                    close, signed = k == j - 1, True
                    break
                if len(x) < 80 and k == j - 1 and _TAGLINE.match(x):
                    kind[k] = SIGN
        last_close = close
        i = j
    return kind
