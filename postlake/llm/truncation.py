"""Text cut off by field limits, found from word trigrams, with SQL expressions only.

All trigrams of a corpus are counted inside texts and at ends of texts (of blocks, in markup). A
value whose last trigram is common inside but hardly ever ends a text was cut between words; one
whose last word is the beginning of what is common inside was cut in a word. A source with a length
limit shows as a pile of values of exactly its greatest length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.operators.skew import join_facts
from postlake.session import materialise

#: A last trigram counts as cut if seen at least so often inside, and at ends at most this share.
LEAST_INSIDE, MOST_ENDING = 3, 0.1
#: A pair of words, or a word, that is so many times more often inside than at ends ends nothing.
PAIR_INSIDE, PAIR_TIMES, WORD_INSIDE, WORD_TIMES = 5, 9, 20, 30
#: A word counts as common if seen at least so often. A last word is the beginning of common words if it is
#: inside at most this share of the times it ends, and its other ends are at most this share of those words.
COMMON_WORD, STUB_INSIDE, STUB_ENDING = 5, 0.1, 0.2
#: Words of an item of a list.
ITEM_WORDS = 3
#: A length is a limit if at least so many of the source's values have it, and so many times more
#: than have another length from half of it on.
LIMIT_LEAST, LIMIT_TIMES = 3, 5.0
#: Cutting at a word takes up to so many characters off a limit.
WORD_SLACK = 16

#: How a client marks what it cut, at the very end.
MARKER = r"(?i)(?:\s*\[(?:more|mehr|plus|m[aá]s|…|\.\.\.)\]|…|\.\.\.)\s*$"
#: What stands between the items of a list.
SEPARATOR = r"\s*[;,]\s+|\s+[-–—•|]\s+|:\s+"
_STOP = r"[.!?][\"'»”’)\]]*\s*$"
_BLOCK = r"(?is)</?(?:p|div|li|ul|ol|h[1-6]|pre|table|tr|td|th|br|blockquote|body|html|title)\b[^>]*>"
_HIDDEN = r"(?is)<!--.*?-->|<(head|style|script|math)\b.*?</\1\s*>"


#: The text of markup ends in a paragraph, not in a heading, list item, code or formula, which need no stop.
_PLAIN_END = r"(?is)[^<>]\s*(?:<o:p>\s*</o:p>)?\s*</p>\s*(?:<img\b[^>]*>|<!--.*?-->|</(?:div|body|html)\s*>|\s)*$"


def text_of_markup(html: Column) -> Column:
    """Markup as text, a line for each block; an unfinished tag at the end falls off."""
    t = F.regexp_replace(html, _HIDDEN, " ")
    t = F.regexp_replace(t, _BLOCK, "\n")
    t = F.regexp_replace(t, r"(?s)<[^>]*$", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", "")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(char))
    return t


def words(line: Column) -> Column:
    """Words of a line; one with digits is written as # with the sign it ends in, links by their form."""
    parts = F.filter(F.split(line, r"[\s\u00a0]+"), lambda w: w != "")
    digits = lambda w: F.when(F.startswith(w, F.lit("http")), F.regexp_replace(w, r"\d+", "0")).when(F.regexp_like(w, F.lit(r"\d")), F.concat(F.lit("#"), F.regexp_extract(w, r"[^\w]?$", 0))).otherwise(w)
    return F.transform(parts, digits)


def values(hx: DataFrame) -> DataFrame:
    """rec_id, source, field_name, raw: the values that are there and not blank."""
    both = hx.select("rec_id", "source", F.explode(F.array(F.struct(F.lit("preview").alias("field_name"), F.col("preview").alias("raw")), F.struct(F.lit("html").alias("field_name"), F.col("html").alias("raw")))).alias("v"))
    return both.select("rec_id", "source", "v.*").where(F.length(F.trim("raw")) > 0)


def lines(vals: DataFrame) -> DataFrame:
    """Each value with ``lines``: an array of word arrays, two starting signs before each."""
    text = F.when(F.col("field_name") == "html", text_of_markup(F.col("raw"))).otherwise(F.col("bare"))
    vals = vals.withColumn("cut", F.filter(F.split(text, r"[\r\n]+"), lambda x: F.length(F.trim(x)) > 0))
    vals = vals.withColumn("items", F.transform("cut", lambda x: F.split(F.regexp_replace(x, r"\d+", "0"), SEPARATOR)))
    return vals.withColumn("lines", F.transform("cut", lambda x: F.concat(F.array(F.lit("^"), F.lit("^")), words(x)))).withColumn("lines", F.filter("lines", lambda x: F.size(x) > 2))


def item_counts(with_lines: DataFrame) -> DataFrame:
    """(item, followed, final): how often a list item has a further one behind it, and how often it is the last of its line."""
    each = with_lines.select(F.explode("items").alias("i")).where(F.size("i") > 2).select(F.posexplode("i").alias("k", "item"), F.size("i").alias("n")).where("k > 0")
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return each.groupBy(F.trim("item").alias("item")).agg(one(F.col("k") < F.col("n") - 1).alias("followed"), one(F.col("k") == F.col("n") - 1).alias("final"))


def trigram_counts(with_lines: DataFrame) -> DataFrame:
    """(a, b, c, inside, ending) over all lines, combined before the shuffle."""
    each = with_lines.select(F.explode("lines").alias("w"))
    grams = each.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.struct(F.element_at("w", i).alias("a"), F.element_at("w", i + 1).alias("b"), F.element_at("w", i + 2).alias("c"), (i == F.size("w") - 2).alias("last")))).alias("g"))
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return grams.select("g.*").groupBy("a", "b", "c").agg(one(~F.col("last")).alias("inside"), one(F.col("last")).alias("ending"))


def limits(vals: DataFrame) -> DataFrame:
    """(source, field_name, unit, most) of the sources that cut at a length, in characters or bytes.

    vals: source, field_name, chars, bytes."""
    sizes = vals.select("source", "field_name", F.explode(F.array(*[F.struct(F.lit(u).alias("unit"), F.col(u).alias("n")) for u in ("chars", "bytes")])).alias("s")).select("source", "field_name", "s.*")
    hist = sizes.groupBy("source", "field_name", "unit", "n").agg(F.count("*").alias("k"))
    top = hist.groupBy("source", "field_name", "unit").agg(F.max(F.struct("k", "n")).alias("t"), F.max("n").alias("longest"))
    # The commonest length among the longer half of the lengths is the candidate.
    far = hist.join(top.select("source", "field_name", "unit", "longest"), ["source", "field_name", "unit"]).where("n * 2 > longest")
    best = far.groupBy("source", "field_name", "unit").agg(F.max(F.struct("k", "n")).alias("t"), F.sum("k").alias("all"), F.max("longest").alias("longest"))
    rest = (F.col("all") - F.col("t.k")) / F.greatest(F.col("longest") / 2, F.lit(1))
    return best.where((F.col("t.k") >= LIMIT_LEAST) & (F.col("t.k") > LIMIT_TIMES * F.greatest(rest, F.lit(0.2)))).select("source", "field_name", "unit", F.col("t.n").alias("most"))


def unfinished_markup(bare: Column) -> Column:
    """Whether markup, without its whole comments and end space, ends inside a tag or comment, or lacks the end of what holds the whole."""
    count = lambda pattern: F.size(F.regexp_extract_all(bare, F.lit(pattern), F.lit(0)))
    # From the last opening sign on: no scan of the whole for each of them.
    in_tag = ~F.contains(F.substring_index(bare, "<", -1), F.lit(">")) & F.contains(bare, F.lit("<"))
    ends = F.regexp_like(F.substring(bare, -20, 20), F.lit(r"(?i)</(html|body)\s*>$"))
    page = F.regexp_like(bare, F.lit(r"(?i)<(html|body)\b"))
    div = F.regexp_like(bare, F.lit(r"(?i)^\s*<div\b"))
    more = div & (count(r"(?i)<div\b") > count(r"(?i)</div\s*>"))
    return in_tag | (page & ~ends) | (~page & more) | F.contains(bare, F.lit("<!--"))


def judged(hx: DataFrame) -> DataFrame:
    """rec_id, source, field_name, cut for every value that is there.

    A value ending in a full stop, ! or ? is whole, also at its source's limit, unless a mark of
    the cut follows or its markup is torn. NULL and blank values give no row; a NULL source is a source of its own; repeated rec_ids each count.
    """
    last = F.try_element_at("lines", F.lit(-1))
    n = F.size(last)
    row = F.try_element_at("items", F.lit(-1))
    at = lambda back: F.when(n > 2, F.element_at(last, n - back))
    markup = F.col("field_name") == "html"
    # Read once: what follows works on the words and on what is known of each value.
    bare = F.when(markup, F.rtrim(F.regexp_replace(F.regexp_replace("raw", r"(?s)<!--.*?-->", ""), r"\s+$", ""))).otherwise(F.regexp_replace("raw", MARKER, ""))
    base = materialise(
        lines(values(hx).withColumn("bare", bare)).select(
            "rec_id",
            "source",
            "field_name",
            "lines",
            "items",
            F.when((F.size(row) > 2) & (F.size(F.split(F.trim(F.element_at(row, -2)), r"\s+")) <= ITEM_WORDS), F.trim(F.element_at(row, -1))).alias("item"),
            F.length("raw").alias("chars"),
            F.octet_length("raw").alias("bytes"),
            F.regexp_like(F.when(markup, F.element_at(last, -1)).otherwise(F.col("bare")), F.lit(_STOP)).alias("stops"),
            (~markup & F.regexp_like("raw", F.lit(MARKER))).alias("marked"),
            F.when(markup, unfinished_markup(F.col("bare"))).otherwise(F.lit(False)).alias("torn"),
            (~markup | F.regexp_like("raw", F.lit(_PLAIN_END))).alias("prose"),
            at(2).alias("a"),
            at(1).alias("b"),
            at(0).alias("c"),
        ),
        "ends",
    )
    grams = materialise(trigram_counts(base), "grams")
    items = item_counts(base)
    base = base.drop("lines", "items")
    # Per distinct last trigram, not per value: what the corpus says of it.
    counted = base.where("NOT stops AND c IS NOT NULL").groupBy("a", "b", "c").agg(F.count("*").alias("n"))
    # Lists end in an item, without a stop: whether other lists end in it too, or it is a short one hardly known.
    rest = F.col("followed") + F.col("final") - 1
    known = (rest >= 3) & (F.col("final") - 1 >= MOST_ENDING * rest)
    short = (rest < 3) & (F.size(F.split("item", r"\s+")) <= ITEM_WORDS)
    listed = base.where("NOT stops AND item IS NOT NULL").select("item").distinct().join(items, "item").where(known | short).select("item", F.lit(True).alias("listed"))
    asked = counted.select("a", "b", "c")
    seen = asked.join(grams, ["a", "b", "c"], "left").select("a", "b", "c", F.coalesce("inside", F.lit(0)).alias("inside"), F.coalesce("ending", F.lit(0)).alias("ending"))
    longer = grams.where("inside > 0").select(F.col("a").alias("la"), F.col("b").alias("lb"), F.col("c").alias("lc"), F.col("inside").alias("li"))
    begun = asked.join(longer, (F.col("a") == F.col("la")) & (F.col("b") == F.col("lb")) & F.startswith("lc", "c") & (F.col("lc") != F.col("c"))).groupBy("a", "b", "c").agg(F.sum("li").alias("begun"))
    pairs = grams.groupBy("b", "c").agg(F.sum("inside").alias("in2"), F.sum("ending").alias("end2"))
    single = grams.groupBy("c").agg(F.sum("inside").alias("in1"), F.sum("ending").alias("end1"))
    # Words by their first three signs: only those of a last word that the corpus hardly has but at ends. Shares, not
    # counts, as several values of a large corpus end in the same piece of a word.
    rare = asked.select("c").distinct().join(single, "c").where(F.col("in1") <= STUB_INSIDE * F.col("end1")).select("c", "end1", F.substring("c", 1, 3).alias("k"))
    common = single.where(F.col("in1") + F.col("end1") >= COMMON_WORD).select(F.substring("c", 1, 3).alias("k"), F.col("c").alias("full"), (F.col("in1") + F.col("end1")).alias("times"))
    stub = rare.join(common, (rare["k"] == common["k"]) & F.startswith("full", "c") & (F.col("full") != F.col("c"))).groupBy("c", "end1").agg(F.sum("times").alias("times"))
    stub = stub.where(F.col("end1") - 1 <= STUB_ENDING * F.col("times")).select("c", F.lit(True).alias("stub"))
    facts = seen.join(counted, ["a", "b", "c"]).join(begun, ["a", "b", "c"], "left").join(pairs, ["b", "c"], "left").join(single, "c", "left").join(stub, "c", "left")
    facts = facts.select(
        "a",
        "b",
        "c",
        "n",
        ((F.col("inside") >= LEAST_INSIDE) & (F.col("ending") <= MOST_ENDING * (F.col("inside") + F.col("ending")))).alias("between"),
        ((F.col("inside") == 0) & (F.coalesce("begun", F.lit(0)) >= 2) & (F.coalesce("begun", F.lit(0)) > 2 * F.col("ending"))).alias("in_word"),
        F.coalesce("stub", F.lit(False)).alias("stub"),
        (F.col("end2") > F.col("in2")).alias("natural"),
        (((F.col("in2") >= PAIR_INSIDE) & (F.col("in2") > PAIR_TIMES * F.col("end2"))) | ((F.col("in1") >= WORD_INSIDE) & (F.col("in1") > WORD_TIMES * F.col("end1")) & (F.col("end2") <= F.col("in2")))).alias("inner"),
    )
    lim = limits(base)
    # One row per source and field at most.
    by_unit = lambda u: F.max(F.when(F.col("unit") == u, F.col("most"))).alias(f"most_{u}")
    caps = lim.groupBy(F.col("source").alias("cap_source"), F.col("field_name").alias("cap_field")).agg(by_unit("chars"), by_unit("bytes"))
    out = base.join(listed, "item", "left")
    out = out.join(caps, F.col("source").eqNullSafe(F.col("cap_source")) & (F.col("field_name") == F.col("cap_field")), "left")
    # A common last phrase may end a third of the values.
    out = join_facts(out, materialise(facts, "facts"), ["a", "b", "c"], how="left")
    yes = lambda name: F.coalesce(name, F.lit(False))
    full = yes(F.col("chars") == F.col("most_chars")) | yes(F.col("bytes") == F.col("most_bytes"))
    near = yes(F.col("chars").between(F.col("most_chars") - WORD_SLACK, F.col("most_chars"))) | yes(F.col("bytes").between(F.col("most_bytes") - WORD_SLACK, F.col("most_bytes")))
    grams_say = ~yes("listed") & (yes("between") | yes("in_word") | yes("stub") | yes("inner"))
    open_end = ~F.col("stops") & F.col("prose") & (full | grams_say | (~yes("listed") & near & ~yes("natural")))
    marked = F.col("marked") & (~F.col("stops") | near)
    why = F.when(~F.col("stops") & F.col("prose") & grams_say, "trigrams").when(F.col("torn"), "torn markup").when(marked, "mark of the client").otherwise("length limit")
    return out.select("rec_id", "source", "field_name", (F.col("torn") | marked | open_end).alias("cut"), why.alias("evidence"))


def cut_values(hx: DataFrame) -> DataFrame:
    """(rec_id, field_name) of the values that were cut, once each."""
    return judged(hx).where("cut").select("rec_id", "field_name").distinct()


def cut_report(hx: DataFrame) -> DataFrame:
    """source, field_name, n_values, n_cut, cut_share."""
    n = judged(hx).groupBy("source", "field_name").agg(F.count("*").alias("n_values"), F.sum(F.col("cut").cast("long")).alias("n_cut"))
    return n.withColumn("cut_share", F.round(F.col("n_cut") / F.col("n_values"), 6))


def cut_evidence(hx: DataFrame) -> DataFrame:
    """field_name, evidence, n_cut: the first of trigrams, torn markup, mark of the client and length limit that holds."""
    return judged(hx).where("cut").groupBy("field_name", "evidence").agg(F.count("*").alias("n_cut"))
