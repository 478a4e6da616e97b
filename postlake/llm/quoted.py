"""Quoted history, signatures and notices in mails: only what the sender newly wrote stays.

Every sentence of every body, marked as a quotation or not, is fingerprinted with SimHash. Tables keyed by a
quarter of the fingerprint retrieve what was said earlier in the same conversation within a Hamming distance
of 3, and the edit distance confirms it: such sentences are inherited. Every line outside quotations is counted
under its sender and over all senders: lines that recur across conversations, and hardly ever begin a
mail, are boilerplate where they end one. What a mail says of itself (:mod:`postlake.llm.mailparts`)
adds header lines, introductions, and quotations and signatures whose like the mailbox does not hold.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.conversations import has_text, topic_key
from postlake.llm.mailparts import HISTORY, NEW, QUOTE, parts
from postlake.session import materialise, release

#: Most differing bits, most edits a character, fewest characters of a sentence that is compared.
BITS, EDITS, LEAST_CHARS = 3, 0.1, 25
#: A sentence in so many conversations (its own and one it was forwarded to show nothing) is a common phrase if most of
#: them do not repeat it, or this share of all conversations has it. A conversation of several mails counts once, copies do not.
COMMON_TALKS, COMMON_SHARE = 3, 0.001
#: Boilerplate of a sender: lines in so many of their mails, in several conversations; of all: in so many mails of so
#: many senders. Of the occurrences at most this share in the first paragraph, where greetings stand.
SENDER_MAILS, ALL_MAILS, ALL_SENDERS, MOST_FIRST = 4, 10, 3, 0.1

#: Hashes that may be broadcast: 8 bytes each.
BROADCAST_ROWS = 500_000

_SENTENCE = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("own", pa.bool_()), ("fp", pa.int64()), ("num", pa.int64()), ("th", pa.int64())])
_LINE = pa.struct([("line", pa.int32()), ("own", pa.bool_()), ("head", pa.bool_()), ("mask", pa.int64())])
PARTS = (
    "nid long, talk long, who long, us long, whole long, marked array<int>, sents array<struct<first:int,last:int,own:boolean,fp:long,num:long,th:long>>,"
    " texts array<string>, plates array<struct<line:int,own:boolean,head:boolean,mask:long>>"
)
_SIGNS = re.compile(r"^\s{0,3}(?:[A-Za-z]{0,4}[>|]\s?)+")
_STOP = re.compile(r"[.!?]\s+")
_WORD = re.compile(r"\w+")
_DIGITS = re.compile(r"\d+")
#: What _WORD and lower() make of each byte of a text in ASCII: itself in lower case, or a space.
_ASCII = bytes(ord(chr(i).lower()) if i < 128 and _WORD.match(chr(i)) else 32 for i in range(256))


def _long(text: str) -> int:
    """A hash that is the same in every process."""
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def _words(text: str) -> str:
    """The words in lower case, one space between."""
    if text.isascii():
        return b" ".join(text.encode().translate(_ASCII).split()).decode()
    return " ".join(_WORD.findall(text.lower()))


@functools.lru_cache(maxsize=200_000)
def _bits(word: str) -> bytes:
    """The 64 bits of a word, a byte each."""
    return np.unpackbits(np.frombuffer(hashlib.blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), np.uint8)).tobytes()


def _coded(sentences: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Number of words of each sentence, the distinct words, and the place among them of each word of each sentence."""
    words = [s.split() for s in sentences]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = list(chain.from_iterable(words))
    ids = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    return counts, list(ids), np.fromiter(map(ids.__getitem__, flat), np.int64, len(flat))


def _simhash(counts: np.ndarray, vocabulary: list[str], index: np.ndarray) -> np.ndarray:
    out = np.zeros(len(counts), np.int64)
    some = np.flatnonzero(counts)
    if not some.size:
        return out
    vectors = b"".join(map(_bits, vocabulary))
    starts = np.concatenate(([0], np.cumsum(counts[some])[:-1]))
    # Eight bits in one addition: up to 255 words no byte overflows.
    ones = np.stack([np.add.reduceat(v[index], starts) for v in np.frombuffer(vectors, np.uint64).reshape(-1, 8).T.copy()], axis=1).view(np.uint8)
    most = ones > (np.minimum(counts[some], 255) // 2).astype(np.uint8)[:, None]
    bits = np.frombuffer(vectors, np.uint8).reshape(-1, 64)
    for i in np.flatnonzero(counts[some] > 255):
        n = counts[some[i]]
        most[i] = 2 * bits[index[starts[i] : starts[i] + n]].sum(axis=0, dtype=np.int64) > n
    out[some] = np.packbits(most, axis=1).view(">i8").ravel()
    return out


def simhash(sentences: list[str]) -> np.ndarray:
    """64-bit SimHash over the words of each sentence; one of no words has 0."""
    return _simhash(*_coded(sentences))


def _numbers(counts: np.ndarray, vocabulary: list[str], index: np.ndarray) -> np.ndarray:
    """A hash of the words of each sentence that are not letters only, in their order."""
    out = np.full(len(counts), _long(""), np.int64)
    at = np.flatnonzero(np.fromiter((not w.isalpha() for w in vocabulary), bool, len(vocabulary))[index])
    rows, starts = np.unique(np.repeat(np.arange(len(counts)), counts)[at], return_index=True)
    words, ends = [vocabulary[i] for i in index[at].tolist()], [*starts[1:].tolist(), len(at)]
    out[rows] = [_long(" ".join(words[i:j])) for i, j in zip(starts.tolist(), ends)]
    return out


def sentences(lines: list[str], kinds: list[str]) -> list[tuple[int, int, bool, str]]:
    """(first line, last line, own, text) of the sentences of a body, lines from 1.

    Own: in lines without a mark; else in history. A paragraph ends at a blank line, quoted or not, or another
    part. Text: lower case words, one space between.
    """
    out, at, n = [], 0, len(lines)
    while at < n:
        k = kinds[at]
        if k not in (NEW, QUOTE, HISTORY):
            at += 1
            continue
        own, pieces, starts, length, first = k == NEW, [], [], 0, at
        while at < n and kinds[at] == k:
            line = _SIGNS.sub("", lines[at]).strip() if ">" in lines[at] or "|" in lines[at] else lines[at].strip()
            at += 1
            if not line:
                break
            starts.append(length)
            pieces.append(line)
            length += len(line) + 1
        text = " ".join(pieces)
        row, pos, rows = 0, 0, len(starts)
        for end, after in [*((m.start() + 1, m.end()) for m in _STOP.finditer(text)), (len(text), 0)]:
            words = _words(text[pos:end]) if end - pos >= LEAST_CHARS else ""
            if len(words) >= LEAST_CHARS:
                while row + 1 < rows and starts[row + 1] <= pos:
                    row += 1
                last = row
                while last + 1 < rows and starts[last + 1] < end:
                    last += 1
                out.append((first + row + 1, first + last + 1, own, words))
            pos = after
    return out


def plate_lines(lines: list[str], kinds: list[str]) -> list[tuple[int, bool, bool, str]]:
    """(line, own, in the first paragraph, its words) of the lines that are no quotation and not blank."""
    out, paragraph, gap = [], 0, False
    for i, k in enumerate(kinds):
        if not k:
            gap = True
            continue
        paragraph, gap = paragraph + (gap and bool(i)), False
        if k not in (QUOTE, HISTORY):
            out.append((i + 1, k == NEW, paragraph == 0, _words(lines[i])))
    return out


def _unmarked(lines: list[str]) -> list[str]:
    return [NEW if x.strip() else "" for x in lines]


def read(mails: DataFrame, marks: bool = True) -> DataFrame:
    """PARTS of each mail (nid, talk, who, us, body_plain). Narrow.

    ``whole`` is a hash of all words without a mark. Without ``marks`` a body says nothing of itself: all its
    lines count as its own.
    """

    def run(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks:
            marked, wholes, sents, plates = [], [], [], []
            for body in batch.column("body_plain").to_pylist():
                lines = body.split("\n")
                kinds = parts(body) if marks else _unmarked(lines)
                marked.append([i for i, k in enumerate(kinds, 1) if k and k != NEW])
                sents.append(sentences(lines, kinds))
                plates.append(plate_lines(lines, kinds))
                # Lines without a mark are all among these.
                wholes.append(_long(" ".join([p[3] for p in plates[-1] if p[1] and p[3]])))
            flat = list(chain.from_iterable(sents))
            texts = [s[3] for s in flat]
            coded = _coded(texts)
            columns = [pa.array([s[i] for s in flat], _SENTENCE.field(i).type) for i in range(3)] + [pa.array(_simhash(*coded)), pa.array(_numbers(*coded)), pa.array(list(map(_long, texts)), pa.int64())]
            lines_flat = list(chain.from_iterable(plates))
            line_columns = [pa.array([p[i] for p in lines_flat], _LINE.field(i).type) for i in range(3)] + [pa.array([_long(_DIGITS.sub("0", p[3])) for p in lines_flat], pa.int64())]
            offsets = lambda xs: pa.array(np.concatenate(([0], np.cumsum([len(x) for x in xs]))), pa.int32())
            at = offsets(sents)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("nid", "talk", "who", "us")],
                    pa.array(wholes, pa.int64()),
                    pa.array(marked, pa.list_(pa.int32())),
                    pa.ListArray.from_arrays(at, pa.StructArray.from_arrays(columns, fields=list(_SENTENCE))),
                    pa.ListArray.from_arrays(at, pa.array(texts, pa.string())),
                    pa.ListArray.from_arrays(offsets(plates), pa.StructArray.from_arrays(line_columns, fields=list(_LINE))),
                ],
                ["nid", "talk", "who", "us", "whole", "marked", "sents", "texts", "plates"],
            )

    return mails.mapInArrow(run, PARTS)


def mails_of(messages: DataFrame, bodies: DataFrame) -> DataFrame:
    """(nid, talk, who, us, body_plain) of the bodies that are not blank; talk and who are hashes of topic and sender.

    Messages without a column sender_email are of unknown senders."""
    key, who = topic_key(F.col("conversation_topic")), F.lower(F.trim("sender_email")) if "sender_email" in messages.columns else F.lit(None).cast("string")
    told = bodies.where(has_text(F.col("body_plain"))).select("nid", F.when(key.isNotNull(), F.xxhash64(key)).alias("talk"), "body_plain")
    sent = messages.select("nid", F.when(who != "", F.xxhash64(who)).alias("who"), F.col("delivered_us").alias("us"))
    return told.join(sent, "nid", "left").select("nid", "talk", "who", "us", "body_plain")


def tables(d: DataFrame) -> DataFrame:
    """Hamming partition tables: a row for each quarter of the fingerprint, with its bucket as key. Of two
    fingerprints within three bits one quarter is equal. A bucket is of one conversation and of one
    sequence of numbers in the sentence."""
    quarter = lambda i: F.shiftrightunsigned("fp", 16 * i).bitwiseAND(0xFFFF)
    return d.withColumn("bucket", F.explode(F.array(*[F.xxhash64("talk", "num", F.lit(i), quarter(i)) for i in range(4)])))


def near(said: DataFrame, texts: DataFrame) -> DataFrame:
    """(talk, th, near): when a text within the edit distance was said before this one in the conversation.

    said: talk, th, fp, num, us, a row for each text of a conversation, so that copies make no pairs; texts: th,
    text. The text is fetched only for what the fingerprints leave.
    """
    # A text of a conversation has a hash of both as its name. Both sides read the same shuffle.
    claim = F.xxhash64("talk", "th")
    named = said.select(claim.alias("claim"), "talk", "th")
    d = tables(said.where("fp IS NOT NULL").select("talk", claim.alias("claim"), "fp", "num", "us")).select("bucket", "claim", "fp", "us").repartition("bucket")
    a, b = d.alias("a"), d.alias("b")
    found = a.join(b, F.col("a.bucket") == F.col("b.bucket")).where((F.col("a.claim") != F.col("b.claim")) & (F.col("b.us") < F.col("a.us")) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= BITS))
    found = materialise(found.select(F.col("a.claim").alias("ca"), F.col("b.claim").alias("cb"), F.col("b.us").alias("since")).distinct(), "found")
    few = found.count() <= BROADCAST_ROWS // 2
    release(said.sparkSession)
    claims = found.select(F.explode(F.array("ca", "cb")).alias("claim")).distinct()
    of = materialise(named.join(F.broadcast(claims) if few else claims, "claim", "left_semi"), "claims")
    pairs = found.join(of.select(F.col("claim").alias("ca"), "talk", F.col("th").alias("a")), "ca").join(of.select(F.col("claim").alias("cb"), F.col("th").alias("b")), "cb").select("talk", "a", "b", "since")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("th")).distinct()
    # Few hashes go to the texts; only more than that are worth a shuffle of all texts.
    wanted = F.broadcast(wanted) if few else wanted
    words = materialise(texts.join(wanted, "th", "left_semi").groupBy("th").agg(F.first("text").alias("text")), "words")
    both = pairs.join(words.select(F.col("th").alias("a"), F.col("text").alias("ta")), "a").join(words.select(F.col("th").alias("b"), F.col("text").alias("tb")), "b")
    close = both.where(F.levenshtein("ta", "tb") <= EDITS * F.greatest(F.length("ta"), F.length("tb")))
    return close.groupBy("talk", F.col("a").alias("th")).agg(F.min("since").alias("near"))


def repeated(told: DataFrame) -> DataFrame:
    """(nid, no): sentences said before in their conversation, by their place in ``sents``; -1 for a mail whose own words, all of
    them, are an earlier mail's: it is a copy of that, not a reply that holds it.

    Of the sentences without a mark, common phrases are left out.
    """
    dated = told.where("talk IS NOT NULL AND us IS NOT NULL")
    body = F.struct(F.lit(-1).alias("no"), F.lit(True).alias("own"), F.col("whole").alias("th"), F.lit(None).cast("long").alias("fp"), F.lit(None).cast("long").alias("num"))
    each = F.transform("sents", lambda s, i: F.struct(i.alias("no"), s["own"].alias("own"), s["th"].alias("th"), s["fp"].alias("fp"), s["num"].alias("num")))
    talk = dated.select("nid", "talk", "us", "whole", F.explode(F.concat(F.array(body), each)).alias("s")).select("nid", "talk", "us", "whole", "s.*")
    mine = F.when(F.col("own"), F.col("whole"))
    said = talk.groupBy("talk", "th").agg(F.min("us").alias("us"), F.max("us").alias("until"), F.first("fp").alias("fp"), F.first("num").alias("num"), F.max("own").alias("own"), F.coalesce(F.min(mine) != F.max(mine), F.lit(False)).alias("again"))
    said = materialise(said, "said")
    release(told.sparkSession)
    first = near(said, told.select(F.explode(F.arrays_zip(F.col("sents.th").alias("th"), F.col("texts").alias("text"))).alias("t")).select("t.th", "t.text"))
    claim = F.xxhash64("talk", "th").alias("claim")
    since = said.select("talk", "th", "us", "until").join(first, ["talk", "th"], "left").select(claim, "th", F.least("us", "near").alias("since"), "until").where("until > since")
    before = materialise(talk.select(claim, "nid", "us", "no", "own").join(since.drop("until"), "claim").where("since < us").select("nid", "no", "own", "th"), "before")
    release(told.sparkSession)
    talks = said.select("talk").distinct().count()
    common = said.where("own AND fp IS NOT NULL").groupBy("th").agg(F.count("*").alias("n"), F.sum(F.col("again").cast("long")).alias("again"))
    common = common.where((F.col("n") >= COMMON_TALKS) & ((F.col("n") > 2 * F.col("again")) | (F.col("n") >= COMMON_SHARE * talks))).select("th")
    own = F.col("own") & (F.col("no") >= 0)
    return before.where(~own).select("nid", "no").unionByName(before.where(own).join(common, "th", "left_anti").select("nid", "no"))


def boilerplate(told: DataFrame) -> DataFrame:
    """(nid, no): lines outside quotations that recur under their sender or over senders; no is -1 - line."""
    lines = told.where("who IS NOT NULL").select("nid", "who", F.coalesce("talk", "nid").alias("talk"), F.explode("plates").alias("p")).select("nid", "who", "talk", "p.line", "p.head", "p.mask")
    per = lines.groupBy("who", "mask").agg(F.count("*").alias("n"), F.sum(F.col("head").cast("long")).alias("h"), (F.min("talk") != F.max("talk")).alias("several"))
    per = materialise(per, "lines")
    release(told.sparkSession)
    everywhere = per.groupBy("mask").agg(F.sum("n").alias("n"), F.sum("h").alias("h"), F.count("*").alias("senders"))
    stock = per.where((F.col("n") >= SENDER_MAILS) & F.col("several") & (F.col("h") <= MOST_FIRST * F.col("n"))).select("who", "mask")
    shared = everywhere.where((F.col("n") >= ALL_MAILS) & (F.col("senders") >= ALL_SENDERS) & (F.col("h") <= MOST_FIRST * F.col("n"))).select("mask")
    stock = stock.unionByName(per.join(shared, "mask", "left_semi").select("who", "mask")).distinct()
    return lines.join(stock, ["who", "mask"], "left_semi").select("nid", (-1 - F.col("line")).alias("no"))


def _spans(sents: Column) -> Column:
    return F.flatten(F.transform(sents, lambda s: F.sequence(s["first"], s["last"])))


def judged(messages: DataFrame, bodies: DataFrame, marks: bool = True) -> DataFrame:
    """Every body that is not blank as (nid, marked, said, stock): lines it marks itself, lines of sentences said before, lines
    of boilerplate. The last two hold lines with and without a mark.

    A sentence without a mark counts only beside another such, one alone may be what people say anyway, and not in a
    copy; its line stays if another new sentence shares it. A line without a mark is
    boilerplate if nothing new comes behind it.
    """
    told = materialise(read(mails_of(messages, bodies), marks), "parts")
    release(told.sparkSession)
    hits = repeated(told).unionByName(boilerplate(told)).groupBy("nid").agg(F.collect_set("no").alias("hits"))
    d = told.select("nid", "marked", F.transform("sents", lambda s, i: F.struct(i.alias("no"), s["first"].alias("first"), s["last"].alias("last"), s["own"].alias("own"))).alias("sents"), F.transform("plates", lambda p: F.struct(p["line"].alias("line"), p["own"].alias("own"))).alias("plates"))
    d = d.join(hits, "nid", "left").withColumn("hits", F.coalesce("hits", F.array().cast("array<int>")))
    hit = lambda no: F.array_contains("hits", no)
    d = d.withColumn("own_hits", F.filter("sents", lambda s: s["own"] & hit(s["no"]) & ~hit(F.lit(-1)))["no"])
    beside = lambda s: F.array_contains("own_hits", s["no"]) & (F.array_contains("own_hits", s["no"] + 1) | F.array_contains("own_hits", s["no"] - 1))
    d = d.withColumn("taken", F.filter("sents", beside)).withColumn("left", F.filter("sents", lambda s: s["own"] & ~beside(s)))
    d = d.withColumn("mine", F.array_except(_spans(F.col("taken")), _spans(F.col("left"))))
    plates = F.transform(F.filter("plates", lambda p: hit(-1 - p["line"])), lambda p: p["line"])
    # A line is no boilerplate if a new sentence goes on in another line.
    whole = lambda s: F.size(F.array_except(F.sequence(s["first"], s["last"]), "plates_hit")) == 0
    d = d.withColumn("plates_hit", plates).withColumn("plates_hit", F.array_except("plates_hit", _spans(F.filter("left", lambda s: ~whole(s)))))
    new = F.filter("plates", lambda p: p["own"] & ~F.array_contains("plates_hit", p["line"]) & ~F.array_contains("mine", p["line"]))
    d = d.withColumn("behind", F.coalesce(F.array_max(F.transform(new, lambda p: p["line"])), F.lit(0)))
    stock = F.filter("plates_hit", lambda x: F.array_contains("marked", x) | (x > F.col("behind")))
    said = F.array_union(F.col("mine"), _spans(F.filter("sents", lambda s: ~s["own"] & hit(s["no"]))))
    return d.select("nid", "marked", said.alias("said"), stock.alias("stock"))


def inherited_lines(messages: DataFrame, bodies: DataFrame, marks: bool = True) -> DataFrame:
    """(nid, line_no) of the lines of body_plain that the sender did not newly write.

    Blank lines are never returned; a line that begins a new sentence stays. NULL and blank bodies
    have no lines; rows without topic have no conversation, without delivery time no earlier mail, without sender
    no boilerplate. Repeated rows give their lines once. ``marks=False`` leaves out what mails say of themselves.
    """
    every = F.array_union(F.array_union("said", "stock"), "marked")
    # Already laid out by nid: no further shuffle.
    return judged(messages, bodies, marks).select("nid", F.explode(every).alias("line_no")).distinct()


def evidence(messages: DataFrame, bodies: DataFrame) -> DataFrame:
    """(evidence, n_lines) of the inherited lines: "said before", "boilerplate" or "mark only", the first that holds."""
    every = F.array_union(F.array_union("said", "stock"), "marked")
    d = judged(messages, bodies).select(F.explode(F.transform(every, lambda x: F.when(F.array_contains("said", x), "said before").when(F.array_contains("stock", x), "boilerplate").otherwise("mark only"))).alias("evidence"))
    return d.groupBy("evidence").agg(F.count("*").alias("n_lines"))


def own_text(messages: DataFrame, bodies: DataFrame) -> DataFrame:
    """(nid, text): body_plain without inherited lines; NULL stays NULL."""
    gone = inherited_lines(messages, bodies).groupBy("nid").agg(F.collect_set("line_no").alias("gone"))
    lines = bodies.select("nid", "body_plain").join(gone, "nid", "left").withColumn("l", F.split("body_plain", "\n"))
    kept = F.filter("l", lambda x, i: F.coalesce(~F.array_contains("gone", i + 1), F.lit(True)))
    return lines.select("nid", F.when(F.col("body_plain").isNotNull(), F.regexp_replace(F.array_join(kept, "\n"), r"^\s+|\s+$", "")).alias("text"))
