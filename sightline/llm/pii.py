"""Personal data by bootstrapped contextual extraction.

Seeds are what the fixed rules for e-mail, IP, card and phone find. One scan
notes, for every seed and for every string that merely looks like one of the
kinds, the two words before it: its lexical pattern. Spark then scores the
graph of patterns and instances in rounds. A lookalike is unknown, unless it
fails a check of its kind (``fails``): those contradict. A pattern's
confidence is the share of the trusted among its distinct instances that are
trusted or contradict, if ``min_support`` of them are trusted; unknown ones do
not count against it, however many. An instance's trust grows with the
patterns that hold it (1 for seeds). The patterns that reach
``min_confidence`` hand trust to instances no rule knew, which support further
patterns in the next round. Trust never falls, and the rounds end when one
adds no trusted instance. In the end the occurrences of trusted instances are
added to the seeds' spans; spans of the rules stay.

The scan writes narrow rows (spans, not texts) to the shared folder. All
graph tables are pre-aggregated before their shuffles, so a pattern that a
third of the corpus shares is one row a task and instance. The texts are
read once and never shuffled; nothing is collected.

Defined cases: a null text is empty and has no spans; an added span never
overlaps a seed's; rows that repeat id and text get equal results; null ids
are allowed; extra columns are ignored; an empty table gives an empty result.
Very long texts are scanned whole, in time that grows with their length. The
loose shapes keep to their formats: an address has at most 64 characters
before the @ and in each of at most nine labels, a card 12 to 19 digits; a
pattern's words have at most ``_LONGEST`` code points. Positions are code points, the end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, StringType, StructField, StructType)

from sightline.llm.common import map_columns
from sightline.session import materialize

#: The kinds, in the order that breaks ties between spans.
KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match ends with its run of digits, so none can begin inside a run.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Looser shapes of the kinds: only contexts can make them count.
_LOOSE = (
    re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}(?: ?[\[(]at[\])] ?|@)[A-Za-z0-9-]{1,64}"
               r"(?:(?: ?[\[(]dot[\])] ?|\.)[A-Za-z0-9-]{1,64}){0,8}"),
    re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![\w:])"),
    re.compile(r"(?<!\w)[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])(?!\w)"),
    re.compile(r"(?<![\w+])\(?[0-9][\x20().0-9-]{5,}[0-9](?!\w)"),
)
# Numbers that are no phone: dates, spans of years, decimal numbers.
_NO_PHONE = re.compile(r"(?:1[0-9]|20)[0-9]{2}([-. ])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-. ])[0-9]{1,2}\2(?:1[0-9]|20)[0-9]{2}"
                       r"|(?:1[0-9]|20)[0-9]{2} ?- ?(?:1[0-9]|20)[0-9]{2}|[0-9]+\.[0-9]+")
_DOT = re.compile(r"\.|[\[(]dot[\])]", re.IGNORECASE)
_WORD = re.compile(r"\S+")
_MARKS = ".,:;!?()[]{}\"'=<>*#-"
#: Words of more code points are no part of a pattern.
_LONGEST = 160


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str):
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", m.end() if m else at + 1)


def seeds(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed rules, sorted."""
    out: list[tuple[int, int, int]] = []
    if not text:
        return out
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() < 14:
                continue
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def lookalikes(text: str | None, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of strings that look like a kind and overlap neither
    a seed nor each other; of overlapping ones the first kind, then the first
    place, counts."""
    out: list[tuple[int, int, int]] = []
    if not text:
        return out
    low = "@" in text or "(at)" in text or "[at]" in text
    digits = _DIGIT.search(text) is not None
    taken = bytearray(len(text))               # code points that a span holds
    for a, _, b in found:
        taken[a:b] = b"\1" * (b - a)
    for kind, shape in enumerate(_LOOSE):
        if not (low if kind == 0 else digits or (kind == 1 and ":" in text)):
            continue
        for m in shape.finditer(text):
            if kind == 3 and not 7 <= len(_DIGIT.findall(m.group())) <= 15:
                continue
            a, b = m.span()
            if taken.find(1, a, b) < 0:
                out.append((a, kind, b))
                taken[a:b] = b"\1" * (b - a)
    return out


def fails(kind: int, found: str) -> bool:
    """Whether a lookalike fails a check of its kind: a mail domain without a
    dot, an address of too few groups, a card number of full length without
    its check digit, a date, a span of years or a decimal for a phone."""
    if kind == 0:
        return not _DOT.search(re.split(r"@|[\[(]at[\])]", found, maxsplit=1)[-1])
    if kind == 1:
        return found.count(":") < 7
    if kind == 2:
        digits = found.replace(" ", "").replace("-", "")
        return len(digits) >= 14 and not luhn(digits)
    return _NO_PHONE.fullmatch(found) is not None


def contexts(text: str, starts: list[int]) -> list[str | None]:
    """For each place the two words before it, lower-cased, without marks
    around them; of a word that the place cuts, the part before it. None if
    there are no two, or one is longer than ``_LONGEST`` code points."""
    if not starts:
        return []
    words = [m.span() for m in _WORD.finditer(text, 0, max(starts))]
    begins = [a for a, _ in words]
    out: list[str | None] = []
    for start in starts:
        i = bisect_left(begins, start) - 1
        pair = [(a, min(b, start)) for a, b in words[max(0, i - 1):i + 1]] if i > 0 else []
        if len(pair) < 2 or any(b - a > _LONGEST for a, b in pair):
            out.append(None)
            continue
        found = [text[a:b].strip(_MARKS).lower() for a, b in pair]
        out.append(" ".join(found) if all(found) else None)
    return out


def context(text: str, start: int) -> str | None:
    return contexts(text, [start])[0]


_SPAN = StructType([StructField("start", IntegerType()), StructField("kind", IntegerType()),
                    StructField("end", IntegerType())])
_NODE = StructType([StructField("kind", IntegerType()), StructField("start", IntegerType()),
                    StructField("end", IntegerType()), StructField("pattern", StringType()),
                    StructField("instance", StringType()), StructField("seed", BooleanType()),
                    StructField("wrong", BooleanType())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, k (hash of id and text), the seeds' spans,
    and every seed and lookalike with its pattern."""
    def batch(_state, texts: pa.Array) -> list:
        spans, nodes = [], []
        for t in texts.to_pylist():
            found = seeds(t)
            more = lookalikes(t, found)
            spans.append([{"start": a, "kind": k, "end": b} for a, k, b in found])
            before = iter(contexts(t, [a for group in (found, more) for a, _, _ in group]))
            nodes.append([{"kind": k, "start": a, "end": b, "pattern": next(before),
                           "instance": " ".join(t[a:b].lower().split()), "seed": own,
                           "wrong": not own and fails(k, t[a:b])}
                          for group, own in ((found, True), (more, False)) for a, k, b in group])
        return [spans, nodes]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"),
                       F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("k"))
    return map_columns(rows, batch, ["t"], [StructField("seeds", ArrayType(_SPAN)),
                                            StructField("nodes", ArrayType(_NODE))], keep=["id", "k"])


def trusted_instances(nodes: DataFrame, min_support: int = 5, min_confidence: float = 0.8,
                      min_trust: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(instances no rule knew that are trusted: kind, instance; patterns
    that reached the confidence: kind, pattern, confidence), from rows
    (kind, pattern, instance, seed, wrong)."""
    edges = (nodes.groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed"), F.max("wrong").alias("wrong"))
             .transform(lambda d: materialize(d, "pii-edges")))
    known = (edges.groupBy("kind", "instance").agg(F.max("seed").alias("seed"), F.max("wrong").alias("wrong"))
             .withColumn("trusted", F.col("seed")))
    known = known.transform(lambda d: materialize(d, "pii-trust-0"))
    graph = edges.where("pattern is not null").select("kind", "pattern", "instance")
    before, r = 0, 0
    while True:
        r += 1
        patterns = (graph.join(known, ["kind", "instance"])
                    .groupBy("kind", "pattern")
                    .agg(F.sum(F.col("trusted").cast("int")).alias("support"),
                         F.sum((F.col("wrong") & ~F.col("trusted")).cast("int")).alias("against"))
                    .withColumn("confidence", F.col("support") / F.greatest(F.col("support") + F.col("against"), F.lit(1)))
                    .where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
                    .select("kind", "pattern", "confidence")
                    .transform(lambda d, n=r: materialize(d, f"pii-patterns-{n}")))
        miss = F.sum(F.log(F.lit(1.0) - F.least(F.col("confidence"), F.lit(0.999))))
        given = (graph.join(patterns, ["kind", "pattern"]).groupBy("kind", "instance")
                 .agg((F.lit(1.0) - F.exp(miss)).alias("given")))
        # A float of 1 - exp(log(1 - c)) may fall short of c by rounding.
        enough = F.coalesce(F.col("given") >= min_trust - 1e-9, F.lit(False))
        known = (known.join(given, ["kind", "instance"], "left")
                 .select("kind", "instance", "seed", "wrong", (F.col("trusted") | enough).alias("trusted"))
                 .transform(lambda d, n=r: materialize(d, f"pii-trust-{n}")))
        now = known.where("trusted and not seed").count()
        if now == before:
            break
        before = now
    found = known.where(~F.col("seed") & F.col("trusted")).select("kind", "instance")
    return found, patterns


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, ``seeds`` (spans of the fixed rules) and
    ``spans`` (those and the added ones): arrays of (start, kind, end),
    sorted."""
    rows = scan(docs, id_col, text_col).transform(lambda d: materialize(d, "pii-scan"))
    nodes = rows.select("k", F.explode("nodes").alias("n")).select("k", "n.*")
    found, _ = trusted_instances(nodes.select("kind", "pattern", "instance", "seed", "wrong"), **options)
    added = (nodes.where(~F.col("seed")).join(found, ["kind", "instance"])
             .groupBy("k").agg(F.collect_set(F.struct("start", "kind", "end")).alias("added")))
    return (rows.select("id", "k", "seeds").join(added, "k", "left")
            .select(F.col("id").alias(id_col), "seeds",
                    F.array_sort(F.concat("seeds", F.coalesce("added", F.array().cast(ArrayType(_SPAN)))))
                    .alias("spans")))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def n_spans(spans: Column, kind: str) -> Column:
    """How many of the spans are of a kind. The lambda takes the span alone:
    Spark hands a second argument the span's index."""
    at = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == at))
