"""Personal data: candidate gradient boosting.

Generators propose spans of four kinds -- email, ip, card, phone.  The strict
patterns of the contract give base spans, which always stay.  Wider generators
propose more, with spans that overlap each other and base spans: spelled-out or
bracketed e-mail addresses, dotted and colon-separated network addresses, and
within a run of digit groups every part of card or telephone length (a group of
digits is never split).

Boosted trees (``GBTClassifier``) learn from format and context features which
candidates are personal data.  Their labels do not ask the base patterns: a
candidate is a positive example when its own check holds (:func:`weak_label`) --
check digit, issuer digit and grouping of a card; octets or a parsable IPv6
address; country code, grouping or a telephone word nearby; a spelled or plain
address with a top-level domain of letters -- and it is not cut out of a longer word
or number.  Every candidate takes part: by hash, seven tenths are fitted on, and
for each kind the threshold is calibrated on all the others, which the trees have
not seen: the lowest score from which on at least ``PRECISION`` of the candidates
are positive, and above 1 (nothing is added) where no score reaches that.

Accepted candidates that overlap a base span give way to it.  The others are
taken greedily: higher scores (in hundredths) first, then longer spans, then
earlier ones, each unless it overlaps one taken before.

Defined cases: null and empty texts have no spans; parts, digits and check
digits are checked after a match and failing matches are dropped without
another try; where positive or negative candidates are missing altogether
nothing is learned and nothing added; rows that repeat a doc_id each get a row; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import ipaddress
import re
from typing import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpath.session import checkpoint_root

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
TREES, DEPTH = 10, 4
#: characters of context on either side
CONTEXT = 40

# fixed patterns of the contract
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never starts inside a run of digits: a match that ends there has taken the run
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGIT = re.compile(r"[0-9]")
_AT, _DOT = r" ?[(\[{<] ?at ?[)\]}>] ?", r"(?:\.| ?[(\[{<] ?dot ?[)\]}>] ?| dot )"
SPELLED = re.compile(rf"[A-Za-z0-9._%+-]{{1,64}}(?:{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}})+"
                     r"| at [A-Za-z0-9-]{1,63}(?: dot [A-Za-z0-9-]{1,63})+)", re.I)
BARE = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?@ ?[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*")
COLONS = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f:]*:[0-9A-Fa-f]*:[0-9A-Fa-f:]*(?![0-9A-Za-z:.])")
DOTTED = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[.][0-9]{1,3}){3}(?![0-9.])")
#: a run of digit groups, and one group
RUN = re.compile(r"[0-9]+(?:[ ().\-/]{1,3}[0-9]+)*")
GROUP = re.compile(r"[0-9]+")
#: groups that a card number is written in; longest group counts of a telephone number
CARD_GROUPS = frozenset({(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 1), (4, 4, 4, 4, 2), (4, 4, 4, 4, 3)} | {(n,) for n in range(13, 20)})
PHONE_GROUPS = 6
NANP = re.compile(r"(?:\+?1[ .-])?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[0-9]{3}[ .-][0-9]{4}")
#: context words of each kind
CONTEXT_WORDS = {
    "email": re.compile(r"e-?mail|contact|write|mailto|correo|courriel|kontakt", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|adresse|direcci", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|karte|tarjeta|carte|payment", re.I),
    "phone": re.compile(r"phone|tel\b|call|fax|mobile|telefon|tel[eé]fono|t[eé]l[eé]phone", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(ch for ch in s if "0" <= ch <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Spans of the e-mail pattern, found from each ``@`` in linear time."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        i = at
        while i > floor and text[i - 1] in LOCAL:
            i -= 1
        m = DOMAIN.match(text, at + 1) if i < at else None
        if m:
            out.append((i, m.end()))
        floor = m.end() if m else at + 1
        at = text.find("@", floor)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) of the contract's base spans, in order."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        d = digits_of(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(digits_of(m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def group_spans(text: str) -> list[tuple[int, int, int]]:
    """Card and telephone spans within runs of digit groups: every stretch of
    whole groups with a fitting number of digits and grouping."""
    out = []
    for run in RUN.finditer(text):
        groups = [m.span() for m in GROUP.finditer(text, run.start(), run.end())]
        sizes = [b - a for a, b in groups]
        for i, (start, _) in enumerate(groups):
            digits = 0
            for j in range(i, len(groups)):
                digits += sizes[j]
                if digits > 19 or j - i >= PHONE_GROUPS:
                    break
                end = groups[j][1]
                if tuple(sizes[i:j + 1]) in CARD_GROUPS:
                    out.append((2, start, end))
                if 7 <= digits <= 15 and all(n > 1 for n in sizes[i + 1:j + 1]):
                    s = start
                    if s and text[s - 1] == "(":
                        s -= 1
                    if s and text[s - 1] == "+":
                        s -= 1
                    out.append((3, s, end))
    return out


def proposals(text: str) -> list[tuple[int, int, int]]:
    """Spans of the wide generators; they overlap."""
    out = []
    if "@" in text:
        out += [(0, m.start(), m.end()) for m in BARE.finditer(text)]
    if " at " in text or "at" in text and re.search(r"[(\[{<] ?at", text, re.I) or "AT" in text:
        out += [(0, m.start(), m.end()) for m in SPELLED.finditer(text)]
    if ":" in text:
        out += [(1, m.start(), m.end()) for m in COLONS.finditer(text) if m.end() - m.start() <= 39]
    if DIGIT.search(text):
        out += [(1, m.start(), m.end()) for m in DOTTED.finditer(text)]
        out += group_spans(text)
    return out


def weak_label(text: str, kind: int, start: int, end: int) -> int:
    """1 where a span passes the checks of its kind, whatever pattern found it."""
    s, before, after = text[start:end], text[max(0, start - CONTEXT):start], text[end:end + 1]
    if before[-1:].isalnum() or after.isalnum():
        return 0
    if kind == 0:
        parts = re.split(rf"{_DOT}", re.split(rf" ?@ ?|{_AT}| at ", s, maxsplit=1, flags=re.I)[-1], flags=re.I)
        return int(len(parts) > 1 and parts[-1].isalpha() and len(parts[-1]) >= 2)
    if kind == 1:
        if ":" in s:
            try:
                return int(bool(ipaddress.IPv6Address(s)) and len(s) > 3)
            except ValueError:
                return 0
        return int(all(len(p) <= 3 and int(p) <= 255 and (p == "0" or p[0] != "0") for p in s.split(".")))
    d = digits_of(s)
    # a stretch of a longer run of groups that look alike is not a number by itself
    if kind == 2:
        return int(d[0] in "23456" and luhn(d) and tuple(map(len, GROUP.findall(s))) in CARD_GROUPS and before[-1:] not in ("-", "/", ".", "+"))
    if s.startswith("+"):
        return int(8 <= len(d) <= 15 and d[0] != "0")
    if before[-1:] in ("+", "-", "/", ".") or before[-2:-1].isdigit():
        return 0
    return int(bool(NANP.fullmatch(s)) or (len(d) >= 7 and bool(CONTEXT_WORDS["phone"].search(before))))


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    s = text[start:end]
    d = digits_of(s)
    before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    groups = re.findall(r"[0-9]+", s)
    seps = set(s) & set(" .-()/:[]{}")
    octets = [g for g in groups if len(g) <= 3 and int(g) <= 255]
    near = f"{before} {after}"
    return [*(float(kind == k) for k in range(4)), float(len(s)), float(len(d)), float(len(groups)),
            float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)), float(len(seps)),
            float(s.startswith("+")), float("(" in s), float("@" in s), float(s.count(".")), float(s.count(":")),
            float(len(octets)), float(int(d[0]) if d else -1), float(len(d) >= 12 and luhn(d)),
            float(sum(ch.isalpha() for ch in s)), float(before[-1:].isalnum()), float(after[:1].isalnum()),
            float(before[-1:] in "\n" or not before), float(len(digits_of(near))), float(before[-2:-1].isdigit()),
            float(before[-1:] in "+-/." and bool(before)), float(bool(NANP.fullmatch(s))), float(tuple(map(len, groups)) in CARD_GROUPS),
            float(len(s) - len(s.rstrip("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))), float("::" in s), float(" dot " in s.lower()),
            float(max((len(x) for x in s.split(":")), default=0)), float(s[:1] == "0" or ".0" in s),
            *(float(bool(CONTEXT_WORDS[k].search(near))) for k in KINDS)]


FOUND = ("doc_id long, base array<struct<kind: int, start: long, end: long>>, "
         "candidates array<struct<kind: int, start: long, end: long, known: boolean, positive: int, x: array<double>>>")


def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans and candidates (base ones included) of every text."""
    for b in batches:
        base, cand = [], []
        for t in b.column("text").to_pylist():
            spans = base_spans(t) if t else []
            mine = set(spans)
            every = sorted(mine | set(proposals(t))) if t else []
            base.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
            cand.append([{"kind": k, "start": s, "end": e, "known": (k, s, e) in mine, "positive": weak_label(t, k, s, e),
                          "x": features(t, k, s, e)} for k, s, e in every])
        span = [("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").cast(pa.int64()), pa.array(base, pa.list_(pa.struct(span))),
             pa.array(cand, pa.list_(pa.struct([*span, ("known", pa.bool_()), ("positive", pa.int32()),
                                                ("x", pa.list_(pa.float64()))])))],
            names=["doc_id", "base", "candidates"])


def learn(candidates: DataFrame):
    """(model, threshold by kind) from candidates (kind, positive, x, h), or None."""
    n = {r.positive: r.n for r in candidates.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    examples = candidates.select(
        "kind", F.col("positive").cast("double").alias("label"), array_to_vector("x").alias("features"),
        (F.pmod(F.shiftright("h", 20), F.lit(10)) < 7).alias("seen"))
    fit_on = examples.where("seen")
    if fit_on.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=5, maxBins=32).fit(fit_on)
    judged = probability(model, examples.where("not seen"))
    bins = judged.groupBy("kind", F.floor(F.col("p") * 100).alias("bin")).agg(
        F.sum("label").alias("good"), F.count("*").alias("n")).collect()          # at most 404 rows
    limits = {}
    for k in range(len(KINDS)):
        good = total = 0.0
        for r in sorted((r for r in bins if r.kind == k), key=lambda r: -r.bin):
            good, total = good + r.good, total + r.n
            if good / total >= PRECISION:
                limits[k] = r.bin / 100
    return model, limits


def probability(model, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("p", vector_to_array("probability")[1]).drop("rawPrediction", "prediction", "probability")


def joined(spans: Column) -> Column:
    """kind:start:end by kind and start, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added) of every row: arrays of (kind index, start, end)."""
    checkpoint_root(docs.sparkSession)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, FOUND) \
        .withColumn("row", F.monotonically_increasing_id()).checkpoint()
    each = found.select("row", F.posexplode("candidates").alias("at", "c")) \
        .select("row", "at", "c.*", F.xxhash64("row", "at").alias("h"))
    learned = learn(each)
    empty = F.expr("cast(array() as array<struct<kind: int, start: long, end: long>>)")
    if learned is None or not learned[1]:
        return found.select("doc_id", "base", empty.alias("added"))
    model, limits = learned
    limit = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in limits.items()], F.lit(2.0))
    judged = probability(model, each.where("not known").withColumn("features", array_to_vector("x")).drop("x"))
    entry = F.struct((-F.floor(F.col("p") * 100)).alias("rank"), (F.col("start") - F.col("end")).alias("size"), "start", "end", "kind")
    added = judged.where(F.col("p") >= limit).groupBy("row").agg(F.array_sort(F.collect_list(entry)).alias("more"))  # of one text
    overlaps = lambda a, b: (b["start"] < a["end"]) & (a["start"] < b["end"])
    span = lambda a: F.struct(a["kind"].alias("kind"), a["start"].alias("start"), a["end"].alias("end"))
    free = F.filter("more", lambda a: ~F.exists("base", lambda b: overlaps(a, b)))
    taken = F.aggregate(free, empty, lambda acc, a: F.when(F.exists(acc, lambda b: overlaps(a, b)), acc)
                        .otherwise(F.concat(acc, F.array(span(a)))))
    return found.join(added, "row", "left").select("doc_id", "base", F.coalesce(taken, empty).alias("added"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, as text."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
