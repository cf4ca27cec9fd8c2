"""Text cut off by field limits: a vocabulary trie, how words end lines, and length evidence.

One pass over whole texts counts, for every kind of line, each word and how often it stands at a line's end without mark,
before a closing mark, or before dots; another few columns describe each text's end. The vocabulary of known words becomes
a trie of prefixes; a final word that isn't known itself, but is a proper prefix of known words, was cut. Ends at a whole
word are judged by how its kind of line and its word end elsewhere, ends in an open block or a broken character by
themselves, and lengths at which texts of a source pile up lend weight.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.skew import lookup
from sluice.session import stored

_STATS = "tag string, kind string, word string, n bigint, bare bigint, marked bigint, dotted bigint, final bigint, doc_id bigint, source string, chars bigint, bytes bigint, cause string, ending string, last string, message string, tail string, inner_kind string, inner_last string"
_FIELDS = [("tag", pa.string()), ("kind", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("bare", pa.int64()), ("marked", pa.int64()), ("dotted", pa.int64()), ("final", pa.int64()), ("doc_id", pa.int64()),
           ("source", pa.string()), ("chars", pa.int64()), ("bytes", pa.int64()), ("cause", pa.string()), ("ending", pa.string()), ("last", pa.string()), ("message", pa.string()),
           ("tail", pa.string()), ("inner_kind", pa.string()), ("inner_last", pa.string())]
_KINDS = [(re.compile(p), k) for p, k in (
    (r"\s*[-*+•]\s", "bullet"), (r"\s*\d{1,3}[.)]\s", "number"), (r"\s*#{1,6}\s", "heading"), (r"\s*>", "quote"), (r"\[?\d{4}-\d\d-\d\d[ T]\d\d:\d\d", "log"), (r"[A-Za-z][\w.-]{0,20}: ", "speaker"),
)]
_OPENING, _CLOSING = tuple("([{<"), tuple(")]}>")
_DOTS = re.compile(r"\s*(?:…|\.{3,})[\"'”»)]*$")
_MARK = re.compile(r"[.!?。！？]['\"”’»)\]*_`]*$")
_EDGE = "\"'“”‘’«»()[]{}<>*_`,;:"
_HEX = re.compile(r"(?=[a-f]*\d)[0-9a-f]{2,}")
#: Characters up to which the trie holds every prefix.
STEM = 40
_DIGITS = str.maketrans("0123456789", "9999999999")


def _shape(word: str) -> str:
    """A word without outer marks, digits as 9 and hexadecimal runs as h, so that numbers and ids share their statistics."""
    if any(c.isdigit() for c in word):
        word = _HEX.sub(lambda m: m[0].translate(_DIGITS) if m[0].isdigit() else "h" * len(m[0]), word).translate(_DIGITS)
    return word


def _end(token: str) -> tuple[str, str]:
    """(word, how it ends: bare, marked, dotted, inside) of a token in running text."""
    if _DOTS.search(token):
        return _DOTS.sub("", token).strip(_EDGE), "dotted"
    if token[-1] in ",;:":
        return token.strip(_EDGE), "inside"
    if _MARK.search(token):
        return token.rstrip(".!?。！？'\"”’»)]*_`").lstrip(_EDGE), "marked"
    return token, "bare"


def _kind(line: str) -> str:
    for pattern, kind in _KINDS:
        if pattern.match(line):
            return kind
    return "plain"


def describe(text: str) -> tuple[str, str, str, str, str]:
    """(cause or '', ending, kind of last line, last word, last line without its speaker) of a text's end.

    cause: ``character`` (ends in a broken character), ``block`` (inside a fenced or JSON block).
    ending: ``bare``, ``marked``, ``dotted``, ``fence``, ``none``.
    """
    body = text.rstrip()
    if not body:
        return "", "none", "plain", "", ""
    if body[-1] == "�":
        return "character", "bare", "plain", "", ""
    if sum(1 for x in body.split("\n") if x.lstrip().startswith("```")) % 2:
        return "block", "bare", "plain", "", ""
    line = body[body.rfind("\n") + 1 :]
    if line.strip().startswith("```"):
        return "", "fence", "plain", "", ""
    kind = _kind(line)
    message = line.split(": ", 1)[1] if kind == "speaker" and ": " in line else line
    token = line.split()[-1] if line.split() else ""
    if not token:
        return "", "none", kind, "", ""
    if _DOTS.search(line):
        head = _DOTS.sub("", line).rstrip()
        return "", "dotted", kind, (head.split() or [""])[-1].strip(_EDGE), message
    if _MARK.search(token):
        return "", "marked", kind, _end(token)[0], message
    return "", "bare", kind, _end(token)[0], message


def bracketed(text: str) -> tuple[str, str, str, str] | None:
    """(shape of what a text has in brackets at its very end; kind, last word and last token of what stands before); None without such
    brackets."""
    body = text.rstrip()
    if body[-1:] not in _CLOSING:
        return None
    start = max(body.rfind(c, -62) for c in _OPENING)
    inside = body[start + 1 : -1]
    if start < 0 or not inside.strip() or "\n" in inside or any(c in inside for c in _CLOSING):
        return None
    line = body[:start].rstrip()
    line = line[line.rfind("\n") + 1 :]
    tokens = line.split()
    return (_shape(inside.strip().casefold()), _kind(line), _end(tokens[-1])[0], tokens[-1]) if tokens else None


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, Counter] = defaultdict(Counter)
        ends: dict[str, Counter] = defaultdict(Counter)
        finals: dict[str, Counter] = defaultdict(Counter)
        style: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0])
        short: Counter = Counter()
        rows: list[tuple] = []
        for i, text, source in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if not text:
                continue
            cause, ending, kind, last, message = describe(text)
            source = source or ""
            tail = None if cause else bracketed(text)
            if tail:  # if the brackets are a remark, the word before them is a text's last, and no evidence that it is whole
                finals[tail[1]][tail[3]] += 1
            rows.append(("doc", kind, _shape(last), *[None] * 5, i, source, len(text), len(text.encode("utf-8", "replace")), cause, ending, last, _shape(message.strip()) if message and len(message.split()) <= 4 else None, *(tail[:3] if tail else (None,) * 3)))
            lines = text.rstrip().split("\n")
            by: dict[str, list[str]] = {}
            fenced = False
            for k, line in enumerate(lines):
                tokens = line.split()
                if not tokens:
                    continue
                if tokens[0].startswith("```"):
                    fenced = not fenced
                    continue
                this = "code" if fenced else _kind(line)
                by.setdefault(this, []).append(line)
                ends[this][tokens[-1]] += 1
                if k + 1 == len(lines):
                    finals[this][tokens[-1]] += 1
                else:
                    s = style[source, this]
                    s[0] += 1
                    s[1] += not _MARK.search(tokens[-1])
                if len(tokens) <= 6:
                    msg = line.split(": ", 1)[1] if this == "speaker" and ": " in line else line
                    if len(msg.split()) <= 4:
                        short[_shape(msg.strip())] += 1
            for this, own in by.items():
                counts[this].update(" ".join(own).split())
        for kind, tokens in counts.items():
            total: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0, 0])
            for token, n in tokens.items():
                word, how = _end(token)
                if not word:
                    continue
                t = total[_shape(word)]
                t[0] += n
                if how == "marked":
                    t[2] += n
                elif how == "dotted":
                    t[3] += n
            for token, n in ends[kind].items():
                word, how = _end(token)
                if word and how in ("bare", "inside"):
                    total[_shape(word)][1] += n
            for token, n in finals[kind].items():
                word, how = _end(token)
                if word and how != "marked":
                    total[_shape(word)][4] += n
            rows += [("word", kind, w, *t, *[None] * 11) for w, t in total.items()]
        rows += [("style", kind, None, n, bare, None, None, None, None, source, *[None] * 9) for (source, kind), (n, bare) in style.items()]
        rows += [("short", None, m, n, *[None] * 15) for m, n in short.items()]
        cols = list(zip(*rows)) if rows else [()] * len(_FIELDS)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _FIELDS)], [k for k, _ in _FIELDS])


def profile(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The one pass over all texts: rows tagged ``doc`` (one a text), ``word``, ``style`` and ``short`` (counts to be added up).
    Meant to be stored, as ``detect`` reads it several times."""
    return documents.select(F.col(doc_id).cast("bigint"), F.col(text), F.col(source)).mapInArrow(_profile, _STATS)


def trie(words: DataFrame, finals: DataFrame | None = None) -> DataFrame:
    """The vocabulary trie as a table: for each prefix, ``below``, how often known words run through it and on.

    Prefixes of over STEM characters are made only for the ``finals`` (column ``last``) that have them, so that long words
    don't grow the table by the square of their length; without ``finals``, for none."""
    prefixes = words.where(F.length("word") > 1).select(F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length("word") - 1, F.lit(STEM))), lambda k: F.substring(F.col("word"), F.lit(1), k))).alias("prefix"), "n")
    if finals is not None:
        stem = lambda c: F.substring(F.col(c), 1, STEM).alias("stem")
        long = finals.where(F.length("last") > STEM).select("last", stem("last")).distinct()
        runs = words.where(F.length("word") > STEM + 1).select("word", "n", stem("word")).join(long, "stem")
        prefixes = prefixes.unionByName(runs.where(F.col("word").startswith(F.col("last")) & (F.length("word") > F.length("last"))).select(F.col("last").alias("prefix"), "n"))
    return prefixes.groupBy("prefix").agg(F.sum("n").alias("below"))


def detect(profiled: DataFrame, piled: int = 8) -> DataFrame:
    """(doc_id, source, cause) of each text that stops because the rest is lost.

    cause: ``character``, ``block``, ``remark`` (ends in brackets before which, in a tenth of the texts that end so or more, a word is cut), ``word`` (the final word is an unknown proper prefix of known words),
    ``dots`` (dots that no text puts there on purpose), ``sentence`` (an end without mark where such lines have one, or at a
    word that doesn't end such lines), ``limit`` (an end without mark, at a length at which ``piled`` or more times as many
    texts of the source end as at the lengths around it).

    Null and empty texts are never truncated; repeated texts are judged alike; a text of one cut word is judged like any.
    An empty table gives an empty table.
    """
    evidence = weigh(profiled, piled)
    return evidence.where(F.col("cause") != "").select("doc_id", "source", "cause")


def weigh(profiled: DataFrame, piled: int = 8) -> DataFrame:
    """Every text with the evidence about its end and its cause, '' for a whole text; see detect."""
    docs = profiled.where(F.col("tag") == "doc").select("doc_id", "source", "chars", "bytes", "cause", "ending", "kind", F.col("word").alias("last"), "message", "tail", "inner_kind", F.col("inner_last"))
    words = profiled.where(F.col("tag") == "word").groupBy("kind", "word").agg(*[F.sum(c).alias(c) for c in ("n", "bare", "marked", "dotted", "final")])
    # Known: stands elsewhere than at a text's end, where nothing shows that it goes on (see is_known below).
    over = words.groupBy("word").agg(F.sum(F.col("n") - F.col("final")).alias("inner"), F.sum("n").alias("all"), F.sum(F.col("bare") + F.col("marked")).alias("all_ends"))
    known = over.where("inner >= 2")
    # A kind of line is rigid if nearly all its lines end in words that do little else: log lines, not list items.
    closing = F.try_divide(F.sum(F.when(F.col("bare") >= 0.9 * F.col("n"), F.col("bare")).otherwise(0)), F.sum("bare"))
    rigid = words.groupBy("kind").agg((closing >= 0.9).alias("rigid"), F.sum("bare").alias("kind_bare"))
    vocabulary = known.where(F.length("word") >= 2).select("word", F.col("inner").alias("n"))
    style = profiled.where(F.col("tag") == "style").groupBy("source", "kind").agg((F.sum("bare") / F.sum("n")).alias("bare_style"))
    short = profiled.where(F.col("tag") == "short").groupBy(F.col("word").alias("message")).agg(F.sum("n").alias("times"))
    lengths = docs.where(F.col("ending") == "bare").select("source", F.explode(F.array_distinct(F.array("chars", "bytes"))).alias("length")).groupBy("source", "length").agg(F.count(F.lit(1)).alias("here"))
    near = lengths.select("source", F.explode(F.sequence(F.col("length") - 25, F.col("length") + 25)).alias("length"), "here").groupBy("source", "length").agg(F.sum("here").alias("around"))
    limits = lengths.where("here >= 5").join(near, ["source", "length"]).where(F.col("here") * 50 >= piled * (F.col("around") - F.col("here"))).select("source", "length", F.lit(True).alias("at_limit"))

    maybe = docs.where((F.col("cause") == "") & F.col("ending").isin("bare", "dotted"))
    tails = docs.where(F.col("tail").isNotNull()).select("doc_id", "tail", F.col("inner_kind").alias("kind"), F.col("inner_last").alias("last"))
    # What is known of a final word is joined once for each distinct one, then attached; a source, a word or a length may have any share of the texts.
    ends = maybe.select("kind", "last").unionByName(tails.select("kind", "last")).distinct()
    facts = ends.join(words.withColumnRenamed("word", "last"), ["kind", "last"], "left").join(over.select(F.col("word").alias("last"), "inner", "all", "all_ends"), "last", "left")
    facts = facts.join(trie(vocabulary, ends).withColumnRenamed("prefix", "last"), "last", "left").join(rigid, "kind", "left")
    facts, style, limits = stored(facts, "p9-facts"), stored(style, "p9-style"), stored(limits, "p9-limits")
    # Brackets at the end are a remark if words before them are cut in a tenth of their texts or more.
    unknown = lambda times: ~(((inner >= 2) & (inner >= 0.0005 * below)) | times) & (below > 0)
    inner, below = F.coalesce("inner", F.lit(0)), F.coalesce("below", F.lit(0))
    learnt = lookup(tails, facts, ["kind", "last"], "doc_id", small=0).groupBy("tail").agg(F.count_if(unknown(F.lit(False))).alias("cut"), F.count(F.lit(1)).alias("tails")).where("cut > 0 and cut * 10 >= tails")
    docs = lookup(docs, stored(learnt.select("tail", F.lit(True).alias("remark")), "p9-remarks"), ["tail"], "doc_id")
    docs = docs.withColumn("cause", F.when((F.col("cause") == "") & F.col("remark"), "remark").otherwise(F.col("cause")))
    open_ = docs.where((F.col("cause") == "") & F.col("ending").isin("bare", "dotted"))
    total = open_.count()
    x = lookup(open_, facts, ["kind", "last"], "doc_id", open_, total, small=0)
    x = lookup(x, short, ["message"], "doc_id", open_, total, small=0)
    # As small as there are sources and limits: counted, and broadcast if they are.
    x = lookup(x, style, ["source", "kind"], "doc_id", open_, total)
    for c in ("chars", "bytes"):
        x = lookup(x, limits.select("source", F.col("length").alias(c), F.col("at_limit").alias(f"at_{c}")), ["source", c], "doc_id", open_, total)
    n, bare, dotted = (F.greatest(F.coalesce(c, F.lit(0)) - own, F.lit(0)) for c, own in (("n", 1), ("bare", F.when(F.col("ending") == "bare", 1).otherwise(0)), ("dotted", F.when(F.col("ending") == "dotted", 1).otherwise(0))))
    times = F.coalesce("times", F.lit(0)) - 1
    at_limit = F.coalesce("at_chars", "at_bytes", F.lit(False))
    loose = F.coalesce("bare_style", F.when(F.col("kind").isin("bullet", "heading", "log"), 1.0).otherwise(0.0)) >= 0.5
    # All bounds are shares of what runs through the prefix or ends such lines, so they mean the same at any size.
    kind_bare = F.coalesce("kind_bare", F.lit(0))
    often = F.greatest(F.lit(3), 0.005 * kind_bare)
    part = unknown(times >= often)
    closer = (times >= often) | ((bare >= often) & (bare >= 0.5 * n))
    own = F.when(F.col("ending") == "bare", 1).otherwise(0)
    of, ends = (F.when(F.coalesce("rigid", F.lit(False)), a).otherwise(F.coalesce(b, F.lit(0)) - o) for a, b, o in ((n, "all", 1), (bare, "all_ends", own)))
    ends_rarely = F.when(of >= 3, ends < F.when(at_limit, 0.5).otherwise(0.002) * of).otherwise(F.col("last").rlike("[0-9]") | (F.col("last") == "") | at_limit)
    cause = (F.when(part, "word").when(F.col("ending") == "dotted", F.when((dotted >= 3) & (dotted >= 0.3 * n), "").otherwise("dots"))
             .when(loose, F.when(ends_rarely, F.when(at_limit, "limit").otherwise("sentence")).otherwise("")).when(closer, "").otherwise(F.when(at_limit, "limit").otherwise("sentence")))
    judged = x.select("doc_id", "source", "chars", "ending", "kind", "last", n.alias("n"), bare.alias("bare"), dotted.alias("dotted"), below.alias("below"), times.alias("times"), "bare_style", at_limit.alias("at_limit"), cause.alias("cause"))
    rest = docs.where(~((F.col("cause") == "") & F.col("ending").isin("bare", "dotted"))).select("doc_id", "source", "chars", "ending", "kind", "last", "cause")
    return judged.unionByName(rest, allowMissingColumns=True)


def rates(profiled: DataFrame, piled: int = 8) -> DataFrame:
    """(source, texts, truncated, share): how often each source truncates; texts without source count under ''."""
    return weigh(profiled, piled).groupBy("source").agg(F.count(F.lit(1)).alias("texts"), F.count_if(F.col("cause") != "").alias("truncated")).withColumn("share", F.col("truncated") / F.col("texts"))
