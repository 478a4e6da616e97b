"""Markup residue: HTML, typed markup (Markdown, wiki, TeX) inside it, and RTF, to clean text.

A page is read as a sequence of words and tags. Words score positive, tags by their kind, with
weights that are log odds over labelled pages, and words of links and controls by theirs; a linear scan finds the contiguous
region of the greatest score, and what lies outside it is dropped. The region's blocks keep what they are:
paragraph, heading, list item, code or formula.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Block = tuple[str, str]

_TOKEN = re.compile(r"(?is)<!--.*?(?:-->|$)|<(script|style|title|xml)\b[^>]*>.*?(?:</\1\s*>|$)|<!\[[^>]*>|</?[a-z!?][^<>]*>|[^<]+|<")
_NAME = re.compile(r"</?([a-z][a-z0-9:]*)", re.I)

#: Labelled pages for the weights, invented: what stands between two bars is content, the rest is what clients, gateways and
#: site templates put around it. This list is the whole of the sample and its bound.
LABELLED = (
    "<html><head><title>Mail</title><style>p{margin:0}</style></head><body>|<h2>Plan</h2><p>We move the store on Monday and test it on Tuesday.</p><ul><li>copy the folders</li><li>count the rows</li></ul><p>Who has the key?</p>|<img src='x' width=1 height=1></body></html>",
    "<html><head><meta charset='utf-8'><!-- made by a client --></head><body lang='EN'>|<p>The report is late.</p><pre>run --all</pre><ol><li>first</li><li>second</li></ol><table><tr><td>a</td><td>one more cell</td></tr></table>|</body></html><!-- gw 1 -->",
    "<div>|Hello all,<br><br>the index is <b>ready</b>, see <i>below</i>.<br><h3>Next</h3><p>x <math><mtext>a+b</mtext></math> holds</p>|</div>",
    "<html><head><script>var a='<h1>no</h1>';</script><link rel='x'></head><body><div>|<p>All <span>words</span> count here, and <code>this</code> too.</p><blockquote><p>quoted words</p></blockquote>|<a href='u'></a><img src='t.gif'></div></body></html>",
    "<html><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li><li><a href='/a'>About us</a></li></ul></nav><div>|<h1>Release notes</h1><p>The reader opens large stores in place, see <a href='/d'>the notes</a> for details.</p><p>Nothing else changed.</p>|</div><footer><a href='/i'>Imprint</a> <a href='/p'>Privacy</a> <a href='/u'>Unsubscribe</a></footer></body></html>",
    "<html><body><table><tr><td><a href='v'>View in browser</a></td><td><a href='f'>Forward</a></td></tr></table>|<h2>Digest</h2><p>Three folders were repaired this week.</p><ul><li>inbox of the service desk</li><li>archive of <a href='q'>last quarter</a></li></ul>|<table><tr><td><a href='p'>Preferences</a></td><td><a href='u'>Unsubscribe</a></td><td><img src='o.gif' width=1></td></tr></table></body></html>",
    "<div><a href='s'>Skip to content</a> <a href='m'>Menu</a><form><input><select><option>en</option><option>de</option></select></form></div><div>|<p>Please compare both lists and tell me which rows are missing by Friday.</p><pre>a = b</pre>|</div><ul><li><a href='1'>Share</a></li><li><a href='2'>Print</a></li><li><a href='3'>Top</a></li></ul>",
)

#: Elements of a page that hold its controls, not its text.
_CHROME = frozenset("nav footer aside form select option button menu noscript".split())


def _kind(token: str) -> str:
    if token.startswith("<!") or token.startswith("<?"):
        return "!"
    m = _NAME.match(token)
    return m.group(1).lower() if m else "word"


def _weighed(kind: str) -> str:
    """The kind a weight is held for: headings of all levels share one."""
    return "h" if len(kind) == 2 and kind[0] == "h" and kind[1].isdigit() else kind


def classes(tokens: list[str]) -> list[tuple[str, int]]:
    """(kind, times) of each token of a page: "word" with its number of words, "link" for words of a link, "chrome" for
    words of a page's controls, else the tag; white space counts 0 times."""
    out, link, chrome = [], 0, 0
    for t in tokens:
        if t[0] != "<" or len(t) == 1:
            out.append(("chrome" if chrome else "link" if link else "word", len(t.split())))
            continue
        kind = _kind(t)
        step = 0 if t.endswith("/>") else -1 if t[1] == "/" else 1
        if kind == "a":
            link = max(0, link + step)
        elif kind in _CHROME:
            chrome = max(0, chrome + step)
        out.append((_weighed(kind), 1))
    return out


WORDS = ("word", "link", "chrome")


def fit_weights(pages: tuple[str, ...] = LABELLED) -> dict[str, float]:
    """Log odds that a token of a kind is content, from pages with two bars around the content.

    Tags never speak for content: the best of them costs a little. Bounded by the pages given; kinds not
    seen get the weight "?".
    """
    inside, outside = Counter(), Counter()
    for page in pages:
        first, last = page.index("|"), page.rindex("|") - 1
        tokens = [m for m in _TOKEN.finditer(page.replace("|", ""))]
        for m, (kind, n) in zip(tokens, classes([m.group() for m in tokens])):
            (inside if first <= m.start() < last else outside)[kind] += n
    odds = {k: math.log((inside[k] + 0.5) / (outside[k] + 0.5)) for k in inside.keys() | outside.keys()}
    return {k: v if k in WORDS else min(v, 0.0) - 0.1 for k, v in odds.items()} | {"?": -0.5}


@functools.lru_cache(maxsize=1)
def default_weights() -> dict[str, float]:
    return fit_weights()


_PAGE = frozenset("html head body meta link ! script style title xml img".split())


def best_span(scored: list[tuple[str, int]], weights: dict[str, float]) -> tuple[int, int]:
    """First and behind-last item of the contiguous span of the greatest score: one linear scan.

    The earliest of several best spans; (0, 0) if nothing scores positive.
    """
    best, best_at, run, start, other = 0.0, (0, 0), 0.0, 0, weights["?"]
    for i, (kind, n) in enumerate(scored):
        run += weights.get(kind, other) * n
        if run <= 0:
            run, start = 0.0, i + 1
        elif run > best:
            best, best_at = run, (start, i + 1)
    return best_at


def content_region(tokens: list[str], weights: dict[str, float]) -> tuple[int, int]:
    """First and behind-last token of a page's content, with the tags that open right before its first word: they say
    what block it is in."""
    a, b = best_span(classes(tokens), weights)
    while b and a and (tokens[a - 1].isspace() or (tokens[a - 1][0] == "<" and tokens[a - 1][1:2] != "/" and _kind(tokens[a - 1]) not in _PAGE)):
        a -= 1
    return a, b


# Typed markup

_FENCES = (
    (re.compile(r"^\s{0,3}(```+|~~~+)[^`]*$"), None),
    (re.compile(r"^\s*\{code(?::[^}]*)?\}\s*$"), re.compile(r"^\s*\{code\}\s*$")),
    (re.compile(r"^\s*\{noformat\}\s*$"), re.compile(r"^\s*\{noformat\}\s*$")),
    (re.compile(r"^\s*\{\{\{(?:\s*#!\w+)?\s*$"), re.compile(r"^\s*\}\}\}\s*$")),
    (re.compile(r"(?i)^\s*<(syntaxhighlight|source|pre)\b[^>]*>\s*$"), re.compile(r"(?i)^\s*</(?:syntaxhighlight|source|pre)\s*>\s*$")),
    (re.compile(r"^\s*\\begin\{(verbatim|lstlisting|Verbatim|minted|alltt)\*?\}.*$"), re.compile(r"^\s*\\end\{(?:verbatim|lstlisting|Verbatim|minted|alltt)\*?\}\s*$")),
)
_TEX = re.compile(r"\\(?:begin\{|item\b|(?:sub)*section\*?\{|emph\{|textbf\{|chapter\*?\{|paragraph\*?\{)")
_WIKI = re.compile(r"(?m)^\s*(={1,6})\s*[^=\s].*?\1\s*$|'''?[^'\n]+'''?|\[\[[^\]\n]+\]\]|^\s*\{code|^\s*\{\{\{|<(?:syntaxhighlight|source|math)\b|^\s*(?:\*\*|##+\*?|[*#]+[*#])\s+\S.*\n\s*[*#]\s|^h[1-6]\.\s")
_MARKDOWN = re.compile(r"(?m)^\s{0,3}(?:```|~~~)|\*\*[^*\n]+\*\*|(?<!`)`[^`\n]+`(?!`)|^\s*[-+]\s+\S|^\s*\d+[.)]\s+\S|\]\(\w+:|^#{2,6} \S[^\n]*\n\s*\n|(?<![*\w])\*[^*\s][^*\n]*\*(?!\*)")
_SETEXT = re.compile(r"^\s{0,3}(=+|-+)\s*$")
_TEX_HEAD = re.compile(r"^\s*\\(?:part|chapter|(?:sub)*section|(?:sub)?paragraph)\*?\{(.*)\}\s*$")
_WIKI_HEAD = re.compile(r"^\s*(={1,6})\s*([^=\s].*?)\s*\1\s*$")
_JIRA_HEAD = re.compile(r"^\s*h[1-6]\.\s+(\S.*)$")
_MD_HEAD = re.compile(r"^\s{0,3}#{1,6}\s+(\S.*?)(?:\s+#+)?\s*$")
_MD_ITEM = re.compile(r"^\s*(?:[-+*]|\d{1,9}[.)])\s+(\S.*)$")
_WIKI_ITEM = re.compile(r"^\s*[*#]+\s+(\S.*)$")
_TEX_ITEM = re.compile(r"^\s*\\item\b(?:\[[^\]]*\])?\s*(.*)$")
_FORMULA = re.compile(
    r"(?s)\$\$(?=\S).+?\$\$|\\\[.+?\\\]|\\\(.+?\\\)|<math\b[^>]*>.+?</math\s*>"
    r"|\\begin\{(equation|align|gather|displaymath|eqnarray|math)\*?\}.+?\\end\{\1\*?\}"
    r"|(?<![\\$\w])\$(?![\s$\d]*\s)(?=\S)[^$\n]*?[^\s$\\]\$(?![\d\w$])"
)


def dialect(text: str) -> str:
    """"tex", "wiki", "markdown" or "" by what the text, without its code blocks, shows most of."""
    if _TEX.search(text):
        return "tex"
    wiki, mark = len(_WIKI.findall(text)), len(_MARKDOWN.findall(text))
    if not wiki and not mark:
        return ""
    return "wiki" if wiki >= mark else "markdown"


def formulas(text: str) -> list[str]:
    """Formulas in a text: $..$, $$..$$, \\(..\\), \\[..\\], TeX environments, <math>; sums of money are none."""
    if "$" not in text and "\\" not in text and "<math" not in text:
        return []
    return [m.group() for m in _FORMULA.finditer(text)]


def typed_blocks(text: str) -> list[Block]:
    """Blocks of a text with typed markup; fenced code first, so that nothing in it counts."""
    rows, code, close, fence = [], None, None, ""
    for line in text.replace("\r\n", "\n").replace("\r", "\n").replace(" ", " ").split("\n"):
        if code is not None:
            done = close.match(line) if close else bool(re.match(rf"^\s{{0,3}}{re.escape(fence[0])}{{{len(fence)},}}\s*$", line))
            if done:
                rows.append(("code", "\n".join(code)))
                code = None
            else:
                code.append(line)
            continue
        for begin, end in _FENCES:
            m = begin.match(line)
            if m:
                code, close, fence = [], end, m.group(1) if end is None else ""
                break
        else:
            rows.append(("line", line))
    if code is not None:
        rows.append(("code", "\n".join(code)))
    plain = "\n".join(t for k, t in rows if k == "line")
    how = dialect(plain)
    fences = "\n".join(line for line in text.split("\n") if any(b.match(line) for b, _ in _FENCES[:5]))
    if how != "tex" and fences:
        marked = bool(re.search(r"```|~~~", fences))
        how = how or ("markdown" if marked else "wiki")
    if not how and len(re.findall(r"(?m)^# \S", plain)) > 1:
        how = "wiki"
    out: list[Block] = []

    def text_line(t: str) -> None:
        if out and out[-1][0] == "text" and t.strip():
            out[-1] = ("text", out[-1][1] + "\n" + t.strip())
        elif t.strip():
            out.append(("text", t.strip()))
        elif out and out[-1][0] == "text":
            out.append(("gap", ""))

    for i, (k, t) in enumerate(rows):
        if k == "code":
            out.append((k, t))
            continue
        m = _TEX_HEAD.match(t) or _JIRA_HEAD.match(t)
        if m:
            out.append(("heading", m.group(1)))
        elif how != "markdown" and (m := _WIKI_HEAD.match(t)):
            out.append(("heading", m.group(2)))
        elif how == "tex":
            if m := _TEX_ITEM.match(t):
                out.append(("list_item", m.group(1)))
            elif not re.match(r"^\s*\\(?:begin|end)\{(?:itemize|enumerate|description)\}", t):
                text_line(t)
        elif how == "wiki" and (m := _WIKI_ITEM.match(t)):
            out.append(("list_item", m.group(1)))
        elif how != "wiki" and (m := _MD_HEAD.match(t)):
            out.append(("heading", m.group(1)))
        elif how != "wiki" and (m := _SETEXT.match(t)) and i and rows[i - 1][0] == "line" and rows[i - 1][1].strip() and out and out[-1][0] == "text":
            *above, title = out.pop()[1].split("\n")
            if above:
                out.append(("text", "\n".join(above)))
            out.append(("heading", title))
        elif m := _MD_ITEM.match(t):
            out.append(("list_item", m.group(1)))
        else:
            text_line(t)
    return [b for b in out if b[0] != "gap"]


# HTML

_HEAD_TAG, _LIST_CLASS = re.compile(r"(?i)^<h[1-6]\b"), re.compile(r"(?i)class\s*=\s*['\"]?MsoListParagraph|mso-list:")
_HEAD_ATTR = re.compile(r"(?i)role\s*=\s*['\"]?heading|class\s*=\s*['\"]?Mso(?:Heading\d?|Title)")
_CODE_ATTR = re.compile(r"(?i)class\s*=\s*['\"]?(?:code|src|source|highlight)\b|font-family:[^;'\"]*mono[^'\"]*white-space:\s*pre\b(?!-wrap)|white-space:\s*pre\b(?!-wrap)[^'\"]*font-family:[^;'\"]*mono")
_WRAP_ATTR, _FORMULA_ATTR = re.compile(r"(?i)white-space:\s*pre-wrap"), re.compile(r"(?i)class\s*=\s*['\"]?(?:formula|math|katex)\b")
_SIZE = re.compile(r"(?i)font-size:\s*(\d+(?:\.\d+)?)\s*(pt|px|em|rem)")
_BLOCKS = frozenset("p div li ul ol h1 h2 h3 h4 h5 h6 pre table tr td th blockquote body html section article header footer hr dl dt dd".split())
_STRUCTURE = re.compile(r"(?i)<(?:p|li|ul|ol|h[1-6]|table)\b")


def _large(tag: str) -> bool:
    m = _SIZE.search(tag)
    return bool(m) and float(m.group(1)) >= {"pt": 13, "px": 17.3, "em": 1.15, "rem": 1.15}[m.group(2).lower()]


def html_blocks(page: str, weights: dict[str, float] | None = None) -> list[Block]:
    """Blocks of an HTML page. Comments, styles and scripts hold none, nor does what code holds."""
    tokens = [m.group() for m in _TOKEN.finditer(page)]
    a, b = content_region(tokens, weights or default_weights())
    region = tokens[a:b]
    # A container that opens before the region and governs its white space still does.
    before = "".join(t for t in tokens[:a] if t[0] == "<" and not t.startswith("<!"))
    joined = "".join(t for t in region if t[0] == "<")
    wrap = bool(_WRAP_ATTR.search(before + joined))
    typed = wrap or not _STRUCTURE.search(before + joined)
    out: list[Block] = []
    text: list[str] = []
    kind, until, size_seen, body_seen = "text", None, False, False
    code: list[str] | None = None
    formula: list[str] | None = None
    hold = 0

    def flush() -> None:
        nonlocal kind, size_seen, body_seen
        raw = html.unescape("".join(text))
        text.clear()
        if raw.strip():
            if typed and kind == "text":
                out.extend(typed_blocks(raw))
            else:
                k = "heading" if kind == "text" and size_seen and not body_seen else kind
                out.append((k, re.sub(r"\s+", " ", raw).strip()))
        elif kind == "list_item":
            out.append((kind, ""))
        kind, size_seen, body_seen = "text", False, False

    large = 0
    for t in region:
        if t[0] != "<" or len(t) == 1:
            if formula is not None:
                formula.append(t)
            elif code is not None:
                code.append(t)
            else:
                # Line ends of the source are lines only where white space is kept.
                text.append(t.replace("\r", "").replace("\n", "" if text and text[-1] == "\n" else " ") if typed and not wrap else t)
                if t.strip():
                    size_seen, body_seen = size_seen or large > 0, body_seen or large == 0
            continue
        name = _kind(t)
        if name in ("!", "script", "style", "title", "xml"):
            continue
        closing = t[1] == "/"
        if formula is not None:
            if closing and name == until:
                out.append(("formula", html.unescape("".join(formula)).strip()))
                text.append(" ")
                formula = None
            continue
        if code is not None:
            if name == until:
                hold += -1 if closing else 1
                if hold == 0:
                    out.append(("code", html.unescape("".join(code)).strip("\n")))
                    code = None
            elif name == "br":
                code.append("\n")
            continue
        if name == "math" and not closing or name == "span" and not closing and _FORMULA_ATTR.search(t):
            formula, until = [], name
            continue
        if name == "br":
            text.append("\n" if typed else " ")
            continue
        if name == "span":
            large = max(0, large + (-1 if closing else 1)) if closing and large or _large(t) or large else large
            continue
        if name not in _BLOCKS:
            continue
        if typed and not _STRUCTURE.match(t) and not (name == "div" and closing) and not _CODE_ATTR.search(t) and name != "pre" and not _HEAD_ATTR.search(t):
            text.append("\n" if name in ("div", "tr", "hr") else "")
            continue
        flush()
        if closing:
            large = 0
            continue
        if (name == "pre" and not _WRAP_ATTR.search(t)) or _CODE_ATTR.search(t):
            code, until, hold = [], name, 1
        elif _HEAD_TAG.match(t) or _HEAD_ATTR.search(t):
            kind = "heading"
        elif name == "li" or _LIST_CLASS.search(t):
            kind = "list_item"
    if code is not None:
        out.append(("code", html.unescape("".join(code)).strip("\n")))
    if formula is not None:
        out.append(("formula", html.unescape("".join(formula)).strip()))
    flush()
    return out


# RTF

_RTF = re.compile(r"\\([a-zA-Z]+)(-?\d+)? ?|\\'([0-9a-fA-F]{2})|\\([^a-zA-Z])|([{}])|[\r\n]+|([^\\{}\r\n]+)", re.S)
_SKIP = frozenset("fonttbl colortbl stylesheet info pict object header footer headerl headerr footerl footerr listtable listoverridetable generator themedata datastore".split())
_CHARS = {"bullet": "•", "tab": "\t", "line": "\n", "emdash": "—", "endash": "–", "lquote": "‘", "rquote": "’", "ldblquote": "“", "rdblquote": "”", "~": " ", "_": "-"}


def rtf_classes(tokens: list[re.Match]) -> list[tuple[str, int]]:
    """(kind, times) of the tokens of a document: words, hidden words as what a page hides, control words as plain tags."""
    out, hidden, stack = [], False, []
    for m in tokens:
        word, _, hexed, sign, brace, plain = m.groups()
        if brace == "{":
            stack.append(hidden)
        elif brace and stack:
            hidden = stack.pop()
        elif word in _SKIP or word in ("pntext", "listtext") or sign == "*":
            hidden = True
        n = len(plain.split()) if plain is not None else int(hexed is not None or word in _CHARS or word == "u" or (sign is not None and sign in "\\{}~_"))
        out.append(("!" if hidden else "word", n) if n else ("p", int(word in ("par", "row"))))
    return out


def rtf_blocks(source: str, weights: dict[str, float] | None = None) -> list[Block]:
    """Blocks of the content region of an RTF document. A paragraph is a heading by outline level or a type size over the
    document's own, code in a monospaced font, a list item by its numbering text or bullet."""
    mono = set(re.findall(r"\{\\f(\d+)\\fmodern", source))
    out: list[Block] = []
    # State that groups save: hidden, font is monospaced, size.
    state, stack = [False, False, 0], []
    base, text, sizes, monos, item, outline, skip_uc = 0, [], set(), set(), False, False, 0
    tokens = list(_RTF.finditer(source))
    region = best_span(rtf_classes(tokens), weights or default_weights())
    within = False

    def flush() -> None:
        nonlocal text, sizes, monos, item, outline
        raw = "".join(text)
        t = raw.strip()
        if t:
            if item or t.startswith(("•\t", "·\t")):
                out.append(("list_item", t.lstrip("•·\t ")))
            elif monos == {True}:
                out.append(("code", raw.strip("\n")))
            elif outline or (sizes and min(sizes) > max(base, 1)):
                out.append(("heading", t))
            else:
                out.append(("text", t))
        text, sizes, monos, item = [], set(), set(), False

    def put(s: str) -> None:
        if within and not state[0]:
            text.append(s)
            if s.strip():
                sizes.add(state[2])
                monos.add(state[1])

    for at, m in enumerate(tokens):
        word, num, hexed, sign, brace, plain = m.groups()
        within = region[0] <= at < region[1]
        if plain is not None:
            if skip_uc:
                plain, skip_uc = plain[skip_uc:], 0
            put(plain)
        elif brace == "{":
            stack.append(list(state))
        elif brace == "}":
            if stack:
                state = stack.pop()
        elif word:
            if word in _SKIP:
                state[0] = True
            elif word in ("pntext", "listtext"):
                item, state[0] = item or at < region[1], True
            elif word == "par" or word == "row":
                flush()
            elif word == "pard":
                if any(x.strip() for x in text):
                    flush()
                outline, state[1] = False, False
                state[2] = base or state[2]
                item = False
            elif word == "plain":
                state[1], state[2] = False, base
            elif word == "fs":
                state[2] = int(num or 0)
                if not base and len(stack) == 1:
                    base = state[2]
            elif word == "f":
                state[1] = (num or "") in mono
            elif word == "outlinelevel":
                outline = True
            elif word == "u" and num:
                put(chr(int(num) % 65536) if not 0xD800 <= int(num) % 65536 < 0xE000 else "?")
                skip_uc = 1
            elif word in _CHARS:
                put(_CHARS[word])
        elif hexed:
            if skip_uc:
                skip_uc = 0
            else:
                put(bytes([int(hexed, 16)]).decode("cp1252", "replace"))
        elif sign is not None:
            if sign == "*":
                state[0] = True
            elif sign in "\\{}":
                put(sign)
            elif sign in _CHARS:
                put(_CHARS[sign])
    flush()
    return out


# Both

COUNTED = ("heading", "list_item", "code", "formula")


def blocks(field: str, value: str, weights: dict[str, float] | None = None) -> list[Block]:
    """Blocks of a value, formulas within text as blocks of their own behind it."""
    found = html_blocks(value, weights) if field == "body_html" else rtf_blocks(value, weights)
    out = []
    for k, t in found:
        out.append((k, t))
        if k not in ("code", "formula"):
            out.extend(("formula", f) for f in formulas(t))
    return out


def clean_text(field: str, value: str) -> str:
    """Text in which headings begin with "# ", list items with "- ", code is fenced and set-off formulas are kept."""
    out = []
    for k, t in html_blocks(value) if field == "body_html" else rtf_blocks(value):
        out.append({"heading": f"# {t}", "list_item": f"- {t}", "code": f"```\n{t}\n```", "formula": f"$${t}$$"}.get(k, t))
    return "\n\n".join(out)


def _values(bodies: DataFrame) -> DataFrame:
    both = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("v")) for f in ("body_html", "body_rtf")])
    return bodies.select("nid", F.explode(both).alias("x")).select("nid", "x.field_name", "x.v").where("v IS NOT NULL AND v <> ''")


def elements(bodies: DataFrame) -> DataFrame:
    """(nid, field_name, element, n): the structural elements, numbered in document order.

    NULL, empty and plain values have none. Whole values however long; no shuffle. Repeated nids
    each give their rows.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = default_weights()
        for pdf in parts:
            rows = []
            for nid, field, v in zip(pdf["nid"], pdf["field_name"], pdf["v"]):
                seen = Counter(k for k, _ in blocks(field, v, weights))
                rows.extend((nid, field, k, i) for k in COUNTED for i in range(1, seen[k] + 1))
            yield pd.DataFrame(rows, columns=["nid", "field_name", "element", "n"])

    return _values(bodies).mapInPandas(run, "nid long, field_name string, element string, n int")


def texts(bodies: DataFrame) -> DataFrame:
    """(nid, field_name, text): every value as clean text."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"nid": pdf["nid"], "field_name": pdf["field_name"], "text": [clean_text(f, v) for f, v in zip(pdf["field_name"], pdf["v"])]})

    return _values(bodies).mapInPandas(run, "nid long, field_name string, text string")
