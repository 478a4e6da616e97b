"""Variant spellings of names: one entity per group of spellings.

Every spelling is rewritten in every way the rules allow: titles and additions dropped, parts put in
order, short given names written out, initials, one letter left out, legal forms and small words
dropped, words of an organisation abbreviated. Spellings meet in an equi-join on their rewritten
forms. A form that does not say the whole name counts by its rarity, over the number of entities that offer it, and
an entity joins the one that clearly scores best; a form shared alike by several entities (an initial, an
ambiguous short name, a role address) decides nothing by itself.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.session import materialise

#: Legal forms, words that organisations add or drop, titles.
LEGAL = frozenset("ag gmbh inc ltd llc limited bv b.v plc corp co company kg sa s.a srl s.r.l nv n.v oy ab as sarl kgaa se ug ohg incorporated corporation".split())
SMALL = frozenset("the and of und et y de der die das la le el".split())
TITLES = frozenset("dr mr mrs ms miss prof dipl ing herr frau mme m sr sra dott".split())
#: Mailboxes of an office, not of a person.
ROLES = frozenset("office info billing noreply no-reply support sales orders admin contact help service team mail postmaster accounts hello newsletter digest".split())

#: Kinds of form: it names the entity; so it does but for one letter; it asks for the one entity that offers it.
STRONG, NEAR, ASK, OFFER = 0, 1, 2, 3
#: What a form of each class is worth if one entity alone offers it: short names and addresses; then exact initials
#: and parts, those one letter off, first words of organisations.
WHOLE = {"q": 1.0, "mi": 1.0}
PARTLY = {"i": 1.0, "oa": 1.0, "ol": 1.0, "op": 0.5, "in": 0.5, "of": 0.25}
#: The least score of a link, and how many times the second best it must be.
LEAST_SCORE, CLEAR = 0.25, 1.5


def fold(word: str) -> str:
    low = word.lower().replace("ß", "ss").replace("ø", "o").replace("ł", "l")
    return "".join(c for c in unicodedata.normalize("NFD", low) if not unicodedata.combining(c))


def ascii_forms(word: str) -> set[str]:
    """How a name's letters are written in an address: without marks, or ä as ae and so on."""
    low = unicodedata.normalize("NFC", word.lower())
    return {fold(word), fold(low.replace("ä", "ae").replace("ö", "oe").replace("ü", "ue").replace("å", "aa"))}


def deletions(word: str) -> set[str]:
    return {word} | {word[:i] + word[i + 1 :] for i in range(len(word))} if len(word) > 3 else {word}


def one_edit(a: str, b: str) -> bool:
    """At most one letter more, less, other, or two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 3:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def bare(spelling: str) -> str:
    """Without quotes, additions in brackets, behind a bar or "via", and outer space."""
    s = re.sub(r"\s+", " ", spelling.replace(" ", " ")).strip()
    s = re.sub(r"\s*\([^)]*\)", "", s)
    s = re.sub(r"\s+(?:via|on behalf of|c/o)\s+.*$", "", s, flags=re.I)
    s = re.sub(r"\s*[|/]\s.*$", "", s)
    return s.strip(" '\"‘’“”<>;")


def split_address(email: str | None) -> tuple[str, str]:
    """Local part and the domain's main label, lower case; "" where there is none."""
    e = (email or "").strip().lower()
    if e.count("@") != 1:
        return "", ""
    local, domain = e.split("@")
    return local, domain.split(".")[0]


def is_organisation(spelling: str, email: str | None) -> bool:
    words = [w.strip(".,()").lower() for w in re.split(r"[\s,]+", bare(spelling)) if w]
    if any(w in LEGAL for w in words[1:]):
        return True
    local, label = split_address(email)
    firsts = [fold(w) for w in re.split(r"[\s,-]+", bare(spelling)) if w and w.lower() not in SMALL]
    return bool(label and firsts and local in ROLES and one_edit(firsts[0], label))


def organisation_forms(spelling: str, email: str | None) -> list[tuple[str, int]]:
    words = [fold(w.strip(".,")) + ("." if w.endswith(".") else "") for w in re.split(r"[\s,-]+", bare(spelling)) if w.strip(".,-")]
    words = [w for w in words if w.strip(".") not in LEGAL and w not in SMALL]
    if not words:
        return []
    first, rest = words[0].strip("."), [w.strip(".") for w in words[1:]]
    name = " ".join([first, *rest])
    out = [(f"o|{name}", STRONG), (f"of|{first}", ASK), (f"of|{first}", OFFER)]
    out += [(f"od|{d}", NEAR) for d in deletions(name.replace(" ", ""))]
    if rest:
        out += [(f"oa|{first} {''.join(w[0] for w in rest)}", OFFER), (f"ol|{first} {rest[-1]}", OFFER), (f"op|{first} {rest[-1][:4]}", OFFER)]
        if len(rest) == 1:
            out += [(f"oa|{first} {rest[0]}", ASK), (f"ol|{first} {rest[0]}", ASK)]
        out.append((f"op|{first} {rest[-1][:4]}", ASK))
    _, label = split_address(email)
    if label and one_edit(first, label):
        out.append((f"oe|{label}", STRONG))
    return out


def person_parts(spelling: str) -> tuple[str, str] | None:
    """(given or initial, surname) as written, or None if it is no name of two parts."""
    s = bare(spelling)
    s = re.sub(r"@.*$", "", s)
    if "," in s:
        last, _, first = s.partition(",")
        words = [w for w in first.split() if fold(w.strip(".")) not in TITLES or len(w.strip(".")) == 1]
        return (words[0].strip("."), last.strip()) if words and last.strip() and " " not in last.strip() else None
    if " " not in s:
        m = re.fullmatch(r"([^\W\d_]+)[._]([^\W\d_]{3,})", s) or re.fullmatch(r"([A-ZÀ-Þ])([A-ZÀ-Þ][a-zß-ÿ][^\W\d_]+)", s)
        return (m.group(1), m.group(2)) if m else None
    words = [w for w in s.split() if not (fold(w.strip(".")) in TITLES and len(w.strip(".")) > 1)]
    words = [words[0], *[w for w in words[1:-1] if len(w.strip(".")) > 1], *words[-1:]] if len(words) > 2 else words
    if len(words) != 2 or not all(re.fullmatch(r"[^\W\d_][^\W\d_'’-]*(?:['’-][^\W\d_]+)*\.?", w) for w in words):
        return None
    if len(words[1].strip(".")) == 1:
        return words[1].strip("."), words[0]
    return words[0].strip("."), words[1].strip(".")


def person_forms(spelling: str, email: str | None, full: dict[str, set[str]], givens: set[str]) -> list[tuple[str, int]]:
    """full: the given names a short form stands for; givens: given names known from name_forms."""
    parts = person_parts(spelling)
    if not parts:
        return []
    out: list[tuple[str, int]] = []
    local, _ = split_address(email)
    dotted = re.fullmatch(r"([a-z]+)\.([a-z]{2,})", local)
    a, b = parts
    for given, surname in ((a, b), (b, a)):
        turned = (given, surname) != (a, b)
        if turned and ("," in bare(spelling) or len(a) == 1 or len(given) == 1):
            continue
        g, s = fold(given), fold(surname)
        means = full.get(g, set()) | {g}
        sure = False
        if dotted:
            eg, es = dotted.groups()
            fits = any(one_edit(x, es) for x in ascii_forms(surname))
            if fits and len(eg) > 1 and (eg in means or (len(g) == 1 and eg[0] == g) or (len(g) > 2 and any(one_edit(eg, x) for x in means))):
                out += [(f"e|{eg}|{es}", STRONG)]
                sure = True
            elif fits and len(eg) == 1 and g[0] == eg:
                out += [(f"ei|{eg}|{es}", OFFER)]
        elif len(local) > 4 and local not in ROLES and any(local[0] == x[0] for x in means) and any(one_edit(x, local[1:]) for x in ascii_forms(surname)):
            if len(g) > 1:
                out += [(f"m|{x}|{local[1:]}", STRONG if len(means) <= 2 else OFFER) for x in means if x[0] == local[0] and (x not in full or x == g)]
                out += [(f"ms|{d}|{local[1:]}", NEAR) for d in deletions(g)]
            out += [(f"mi|{local}", OFFER if len(g) > 1 else ASK)]
        if turned and not sure and a and fold(a) in givens and fold(b) not in givens:
            continue
        if turned and not sure and not (g in givens or g in full):
            # Which part is the given name is open: both orders are one form.
            continue
        if len(g) == 1:
            out += [(f"i|{g}|{d}", ASK) for d in {s}] + [(f"in|{g}|{d}", ASK) for d in deletions(s)]
            continue
        only = sorted(full.get(g, ()))
        out.append((f"p|{g}|{s}", STRONG))
        if len(only) == 1:
            out.append((f"p|{only[0]}|{s}", STRONG))
        out += [(f"q|{x}|{s}", ASK) for x in only if len(only) > 1]
        out.append((f"q|{g}|{s}", OFFER))
        out += [(f"s|{x}|{d}", NEAR) for x in ({g} | set(only) if len(only) < 2 else {g}) for d in deletions(s)]
        out += [(f"g|{d}|{s}", NEAR) for d in deletions(g)]
        for x in means:
            out += [(f"i|{x[0]}|{s}", OFFER)] + [(f"in|{x[0]}|{d}", OFFER) for d in deletions(s)]
    two = sorted((fold(a), fold(b)))
    if len(two[0]) > 1 and len(two[1]) > 1:
        out.append((f"t|{two[0]}|{two[1]}", STRONG))
    return out


FORMS = "name string, form string, kind int, sure boolean"


def forms(seen: DataFrame, name_forms: DataFrame) -> DataFrame:
    """FORMS of all (name, email). name_forms is a hand-written table of a few dozen rows."""
    rows = [(fold(r[0]), fold(r[1])) for r in name_forms.where("short_form IS NOT NULL AND full_form IS NOT NULL").select("short_form", "full_form").collect()]
    full: dict[str, set[str]] = {}
    for short, whole in rows:
        full.setdefault(short, set()).add(whole)
    givens = {x for r in rows for x in r}

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for name, email in zip(pdf["name"], pdf["email"]):
                if is_organisation(name, email):
                    own = organisation_forms(name, email)
                else:
                    own = person_forms(name, email, full, givens)
                    p = person_parts(name)
                    m = re.fullmatch(r"([a-z]+)\.([a-z]{2,})", split_address(email)[0])
                    sure = bool(p and m and {m.group(1)} <= ascii_forms(p[0]) | {fold(p[0])} and m.group(2) in ascii_forms(p[1]))
                    out.extend((name, f, k, sure) for f, k in own)
                    continue
                out.extend((name, f, k, False) for f, k in own)
            yield pd.DataFrame(out, columns=["name", "form", "kind", "sure"])

    return seen.mapInPandas(run, FORMS).groupBy("name", "form", "kind").agg(F.max("sure").alias("sure"))


def components(edges: DataFrame) -> DataFrame:
    """(a, root) for edges (a, b): the smallest node each node is joined with.

    Alternates hooking to the smallest neighbour's root with a jump of every pointer, so the rounds
    grow with the logarithm of a component's breadth; each round is written to the shared folder.
    """
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    now = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")), "roots")
    while True:
        root = now.select(F.col("a").alias("b"), F.col("root").alias("r"))
        best = both.join(root, "b").groupBy("a").agg(F.min("r").alias("r"))
        hooked = now.join(best, "a").select("a", F.col("root").alias("old"), F.least("root", "r").alias("r"))
        # Roots hook too: the root of a takes the smallest root any of its nodes sees.
        up = hooked.groupBy(F.col("old").alias("k")).agg(F.min("r").alias("m"))
        new = hooked.join(up, hooked["old"] == up["k"]).select("a", "old", F.least("r", "m").alias("root"))
        new = materialise(new, "roots")
        jump = new.select(F.col("a").alias("j"), F.col("root").alias("to"))
        nxt = materialise(new.join(jump, new["root"] == jump["j"], "left").select("a", "old", F.least("root", F.coalesce("to", "root")).alias("root")), "roots")
        changed = not nxt.where("root <> old").isEmpty()
        now = nxt.select("a", "root")
        if not changed:
            return now


def entities(messages: DataFrame, recipients: DataFrame, name_forms: DataFrame) -> DataFrame:
    """(name, entity): every spelling of sender_name and recipients.name; entity is its smallest spelling.

    NULL and blank names are none. Spellings are compared as stored; how often one occurs plays no part,
    so equal rows are combined first. A spelling that links to nothing is an entity of its own.
    """
    seen = messages.select(F.col("sender_name").alias("name"), F.lower(F.trim("sender_email")).alias("email")).unionByName(recipients.select("name", F.lower(F.trim("email")).alias("email")))
    seen = seen.where(F.length(F.trim("name")) > 0).distinct()
    seen = materialise(seen, "names")
    f = materialise(forms(seen, name_forms), "forms")
    alone = seen.select("name").distinct().select(F.col("name").alias("a"), F.concat(F.lit("\u0001"), "name").alias("b"))
    strong = alone.unionByName(f.where(f"kind = {STRONG}").select(F.col("name").alias("a"), F.concat(F.lit("\u0001\u0001"), "form").alias("b")))

    def of_names(edges: DataFrame) -> DataFrame:
        c = components(edges)
        names = c.where(~F.startswith("a", F.lit("\u0001")))
        least = names.groupBy("root").agg(F.min("a").alias("entity"))
        return names.join(least, "root").select(F.col("a").alias("name"), "entity")

    now = materialise(of_names(strong), "entities")
    told = f.where(f"kind <> {STRONG}").select("name", "form", "kind", "sure")
    # First what says the whole name but for a letter, or that a short name stands for one of several; then initials and parts of names.
    for near, classes in ((True, WHOLE), (False, PARTLY)):
        known = f.where("sure").select("name").distinct().join(now, "name").select("entity").distinct().withColumn("known", F.lit(True))
        held = told.join(now, "name").join(known, "entity", "left").groupBy("form", "entity", "kind").agg(F.coalesce(F.max("known"), F.lit(False)).alias("known"))
        held = materialise(held, "held")
        links = _asked(held, classes)
        links = links.unionByName(_near(held)) if near else links.unionByName(_peers(held))
        now = materialise(_merged(now, links), "entities")
    return now


def _near(held: DataFrame) -> DataFrame:
    """(entity, to): entities that meet in a form one letter off, if at most one of them is confirmed by its own address."""
    form = held.where(f"kind = {NEAR}").groupBy("form").agg(F.count("*").alias("n"), F.sum(F.col("known").cast("int")).alias("k"), F.min("entity").alias("to")).where("n > 1 AND k <= 1")
    return held.where(f"kind = {NEAR}").join(form.select("form", "to"), "form").where("entity <> to").select("entity", "to").distinct()


def _asked(held: DataFrame, classes: dict[str, float]) -> DataFrame:
    """(entity, to): the one entity that scores best for each that asks.

    A form is worth the weight of its class over the number of entities that offer it: its rarity. Of the forms of a
    class the rarest counts, classes add up. The best must reach LEAST_SCORE and be CLEAR times the second, so forms
    that several entities offer alike decide nothing. An entity confirmed by its own address asks by first words only.
    """
    prefix = F.substring_index("form", "|", 1)
    mine = held.withColumn("class", prefix).where(F.col("class").isin(*classes))
    worth = F.element_at(F.create_map(*[F.lit(x) for kv in classes.items() for x in kv]), F.col("class"))
    offers = mine.where(f"kind = {OFFER}").select("form", F.col("entity").alias("to"))
    # What more entities offer than this cannot reach the least score, in whatever sum: it makes no pairs.
    rare = offers.groupBy("form").agg(F.count("*").alias("n")).where(F.col("n") <= int(sum(classes.values()) / LEAST_SCORE))
    asks = mine.where((F.col("kind") == ASK) & (~F.col("known") | (F.col("class") == "of"))).select("form", "class", "entity")
    each = asks.join(rare, "form").join(offers, "form").where("entity <> to").groupBy("entity", "to", "class").agg(F.max(worth / F.col("n")).alias("s"))
    scored = each.groupBy("entity", "to").agg(F.sum("s").alias("score"))
    best = scored.groupBy("entity").agg(F.max(F.struct("score", "to")).alias("best"), F.array_sort(F.collect_list("score")).alias("all"))
    second = F.coalesce(F.try_element_at("all", F.lit(-2)), F.lit(0.0))
    return best.where((F.col("best.score") >= LEAST_SCORE) & (F.col("best.score") >= CLEAR * second)).select("entity", F.col("best.to").alias("to"))


def _peers(held: DataFrame) -> DataFrame:
    """(entity, to): those that ask by the same initial and surname, which nobody offers, are one."""
    mine = held.where(F.startswith("form", F.lit("i|")))
    orphan = mine.where(f"kind = {ASK} AND NOT known").join(mine.where(f"kind = {OFFER}").select("form"), "form", "left_anti")
    return orphan.join(orphan.groupBy("form").agg(F.min("entity").alias("to")), "form").where("entity <> to").select("entity", "to").distinct()


def _merged(now: DataFrame, links: DataFrame) -> DataFrame:
    """(name, entity) after joining entities along (entity, to)."""
    edges = links.select(F.col("entity").alias("a"), F.col("to").alias("b")).where("a <> b")
    roots = components(edges).select(F.col("a").alias("entity"), "root")
    return now.join(roots, "entity", "left").select("name", F.coalesce("root", "entity").alias("entity"))


def pairs(groups: DataFrame) -> DataFrame:
    """(name_a, name_b) of one entity, name_a < name_b: the form in which the result is asked for.
    An entity has few spellings, however often they are used."""
    return groups.select("entity", F.col("name").alias("name_a")).join(groups.select("entity", F.col("name").alias("name_b")), "entity").where("name_a < name_b").select("name_a", "name_b")
