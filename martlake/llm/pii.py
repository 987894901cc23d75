"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from strict and loose patterns. Four labelers vote on each
candidate: the pattern itself with its checks, a gazetteer (top-level domains,
reserved addresses, issuer prefixes, calling codes), cue words in the
surroundings, and whether the candidate stands alone between blanks and
punctuation. Expectation-maximisation over the counts of vote patterns
estimates how reliable each labeler is, without labels; its posteriors train
the final span classifier, a logistic regression on votes and shape. Both fits
work on counts by pattern, whose number is fixed by the labelers and not by the
corpus. Spans of the strict patterns always stay; the classifier adds others.

Defined results: null texts count as empty; empty texts have no spans; rows are
independent, so repeated rows get equal results; a corpus without candidates
gives a model that adds nothing; other columns pass through, but for one that
has the name of the added column. Texts of any length give the same spans: long
ones are read in pieces, so that places far into them cost no more than others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import text_or_empty

KINDS = ("email", "ip", "card", "phone")

# Patterns of base spans. They equal the plain definitions (see the tests), and
# scan in linear time: a run of characters is entered at its beginning only, or
# right after the match before (\G), and is never given back.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++ ?(?:\[at\]|\(at\)|\{at\}) ?[a-z0-9-]++(?: ?(?:\.|\[dot\]|\(dot\)|\{dot\}) ?[a-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}+:){7}[0-9A-Fa-f]{1,4}+(?![0-9A-Fa-f:.])",
    "card": r"(?<![0-9.])[0-9]{4}+(?:[./][0-9]{4}+){3}(?![0-9./])",
    "phone": r"(?<![0-9+.-])(?<![0-9+] )(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|[ .-][0-9])",
}
# what must occur in a text before the pattern is tried
HINT = {"email": "@", "phone": "+"}
LOOSE_HINT = {"email": r"(?i)[\[({]at[\])}]", "ip": ":[0-9A-Fa-f]{1,4}:"}

# Gazetteers (fixed values).
TOP_LEVEL = ("com", "org", "net", "edu", "gov", "int", "mil", "info", "biz", "io", "co", "me", "eu", "de", "fr", "es", "it", "uk", "us", "ca", "nl", "be", "ch", "at", "pl", "pt", "se", "no", "dk", "fi", "ie", "cz", "ru", "jp", "cn", "in", "br", "mx", "ar", "au", "nz", "za")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "351", "352", "353", "358", "420", "421")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65)"
RESERVED = r"^(?:0|127|22[4-9]|2[3-5][0-9])\."
# Cue words that point to a kind (fixed values).
CUES = {
    "email": ("mail", "contact", "write", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse", "client"),
    "card": ("card", "visa", "karte", "tarjeta", "carte", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon"),
}
CUE_WINDOW = 40
LABELERS = ("pattern", "gazetteer", "cue", "alone")
SHAPES = ("strict", "long", "mixed")  # further features of the classifier

# Bounds of the fits.
EM_ROUNDS, EM_TOLERANCE = 500, 1e-9
FIT_ROUNDS, FIT_RATE = 2000, 0.5
THRESHOLD = 0.5

CANDIDATES = "array<struct<kind:string,start:int,end:int,base:boolean,votes:string>>"
LONG = 1 << 14  # bytes from which a text is long
PIECE = 1024  # code points of the pieces of a long text
RUN = 64  # matches whose results are appended one after the other in long texts


@dataclass(frozen=True)
class Model:
    """Reliabilities (chance of a vote given personal data, and given none) and classifier weights, by kind."""

    prior: dict[str, float]
    reliability: dict[str, dict[str, tuple[float, float]]]
    weights: dict[str, list[float]]  # intercept, then labelers and shapes


def let(value: Column, body) -> Column:
    """``body(value)``, with the value found once however often lambdas inside use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def is_long(text: Column) -> Column:
    return F.octet_length(text) > LONG


def in_pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def part(pieces: Column, start: Column, length: Column) -> Column:
    """``length`` code points from ``start`` (from 0) on of a text in pieces, fewer at its end."""
    first = F.floor(start / PIECE).cast("int")
    near = F.slice(pieces, first + 1, F.floor((start + length) / PIECE).cast("int") - first + 1)
    return F.substring(F.array_join(near, ""), start - first * PIECE + 1, length)


def folded(items: Column, at: Column, step, emit, element: str) -> Column:
    """``emit(at, item)`` of each item as an array, and ``at`` after ``step(at, item)`` of all of them."""
    return F.aggregate(
        items,
        F.struct(at.alias("at"), F.array().cast(f"array<{element}>").alias("out")),
        lambda acc, x: F.struct(step(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(emit(acc["at"], x))).alias("out")),
    )


def folded_in_runs(items: Column, step, emit, element: str) -> Column:
    """The array of ``folded`` from 0 on. Appending copies what is there, so items are folded in runs and the runs joined."""

    def joined(every: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor(F.size(every) / RUN).cast("int")), lambda r: F.slice(every, r * RUN + 1, F.lit(RUN)))
        none = F.array().cast(f"array<array<{element}>>")
        return F.aggregate(
            runs,
            F.struct(F.lit(0).alias("at"), none.alias("out")),
            lambda acc, run: let(
                folded(run, acc["at"], step, emit, element),
                lambda got: F.struct(got["at"].alias("at"), F.concat(acc["out"], F.array(got["out"])).alias("out")),
            ),
            lambda acc: F.flatten(acc["out"]),
        )

    return let(items, joined)


def matches(text: Column, pattern: str, long: bool = False) -> Column:
    """Array of (start, end, value) of all matches, left to right; code points, end exclusive.

    The matches and the gaps between them have the lengths that give the places.
    """
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(gaps, found, lambda g, m: F.struct(F.char_length(g).alias("gap"), m.alias("value")))
    steps = F.filter(steps, lambda s: s["value"].isNotNull())
    element = "struct<start:int,end:int,value:string>"

    def after(at: Column, s: Column) -> Column:
        return at + s["gap"] + F.char_length(s["value"])

    def span(at: Column, s: Column) -> Column:
        return F.struct((at + s["gap"]).alias("start"), after(at, s).alias("end"), s["value"].alias("value"))

    return folded_in_runs(steps, after, span, element) if long else folded(steps, F.lit(0), after, span, element)["out"]


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    doubled = F.transform(
        F.reverse(F.split(digits, "")),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    """The checks of base matches."""
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.char_length(digits_of(value)).between(13, 19) & luhn(digits_of(value))
    if kind == "phone":
        return F.char_length(digits_of(value)).between(9, 15)
    return F.lit(True)


def _listed(kind: str, value: Column) -> Column:
    """The gazetteer's vote."""
    if kind == "email":
        return F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1)).isin(*TOP_LEVEL)
    if kind == "ip":
        return ~value.rlike(RESERVED)
    if kind == "card":
        return digits_of(value).rlike(ISSUERS)
    codes = "|".join(sorted(CALLING_CODES, key=len, reverse=True))
    return value.rlike(rf"^\+(?:{codes})") | value.rlike(r"^\(?[2-9]")


def _voted(kind: str, cut, span: Column, strict: Column) -> Column:
    """A candidate with its votes and shape as a pattern of 0 and 1; ``cut(start, length)`` gives the text around it."""
    value, start, end = span["value"], span["start"], span["end"]
    before = cut(F.greatest(start - CUE_WINDOW, F.lit(0)), F.least(start, F.lit(CUE_WINDOW)))
    after = cut(end, F.lit(CUE_WINDOW))
    cue = F.concat(before, F.lit(" "), after).rlike(rf"(?i)(?<![a-z])(?:{'|'.join(CUES[kind])})")
    alone = before.rlike(r"(?:^|[\s(\[<:,;\"'])$") & after.rlike(r"^(?:$|[\s)\]>:,;.!?\"'])")
    flags = [strict, _listed(kind, value), cue, alone, strict, F.char_length(value) > 14, value.rlike("[A-Za-z]") & value.rlike("[0-9]")]
    pattern = F.concat(*[F.when(f, "1").otherwise("0") for f in flags])
    return F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), strict.alias("base"), pattern.alias("votes"))


def _check(kind: str):
    return lambda span: passes(kind, span["value"])


def _voter(kind: str, cut, strict: bool):
    return lambda span: _voted(kind, cut, span, F.lit(strict))


def _candidates(kind: str, text: Column, strict: bool) -> Column:
    """The candidates of one kind from its strict or its loose pattern."""
    pattern = BASE[kind] if strict else LOOSE[kind]

    def found(cut, long: bool) -> Column:
        spans = matches(text, pattern, long)
        return F.transform(F.filter(spans, _check(kind)) if strict else spans, _voter(kind, cut, strict))

    short = found(lambda start, length: F.substring(text, start + 1, length), False)
    long = let(in_pieces(text), lambda pieces: found(lambda start, length: part(pieces, start, length), True))
    return F.when(~text.rlike(pattern), F.array().cast(CANDIDATES)).when(is_long(text), long).otherwise(short)


def _base_of(kind: str):
    return lambda span: span["base"] & (span["kind"] == kind)


def with_candidates(docs: DataFrame, column: str = "candidates") -> DataFrame:
    """Adds the candidates of ``text``: kind, start, end, base and votes, by kind as listed and then start."""
    others = [c for c in docs.columns if c.lower() != column.lower()]
    own = "_"  # no other column begins like those that are dropped again
    while any(c.lower().startswith(own) for c in others):
        own += "_"
    rows = docs.select(*[F.col(f"`{c}`") for c in others], text_or_empty().alias(f"{own}text"))
    text, found = F.col(f"{own}text"), []
    none = F.array().cast(CANDIDATES)
    for kind in KINDS:
        base, loose = _candidates(kind, text, True), _candidates(kind, text, False)
        if kind in HINT:
            base = F.when(F.contains(text, F.lit(HINT[kind])), base).otherwise(none)
        if kind in LOOSE_HINT:
            loose = F.when(text.rlike(LOOSE_HINT[kind]), loose).otherwise(none)
        rows = rows.withColumns({f"{own}base_{kind}": base, f"{own}loose_{kind}": loose})
        found.append(F.col(f"{own}base_{kind}"))
    # a loose candidate that touches a base span of any kind adds nothing
    bases = F.concat(*found)
    rows = rows.withColumn(f"{own}bases", bases)
    parts = []
    for kind in KINDS:
        base, loose = F.col(f"{own}base_{kind}"), F.col(f"{own}loose_{kind}")
        free = F.filter(loose, lambda s: ~F.exists(F.col(f"{own}bases"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        parts.append(F.when(F.size(loose) == 0, base).otherwise(F.array_sort(F.concat(base, free), _by_start)))
    rows = rows.withColumn(column, F.concat(*parts))
    return rows.drop(f"{own}text", f"{own}bases", *[f"{own}{x}_{k}" for k in KINDS for x in ("base", "loose")])


def _by_start(a: Column, b: Column) -> Column:
    return F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(a["end"] - b["end"])


def fit(docs: DataFrame, column: str = "candidates") -> Model:
    """Reliabilities and classifier from the votes on all candidates of all documents."""
    counts = docs.select(F.explode(column).alias("c")).groupBy("c.kind", "c.votes").agg(F.count("*").alias("n"))
    rows = [(r["kind"], r["votes"], r["n"]) for r in counts.collect()]  # a row for each pattern of votes
    prior, reliability, weights = {}, {}, {}
    for kind in KINDS:
        own = [([int(x) for x in votes], n) for k, votes, n in rows if k == kind]
        prior[kind], reliability[kind] = expectation_maximisation([(v[: len(LABELERS)], n) for v, n in own])
        soft = [(v, n, posterior(v[: len(LABELERS)], prior[kind], list(reliability[kind].values()))) for v, n in own]
        weights[kind] = logistic(soft)
    return Model(prior, reliability, weights)


def posterior(votes: list[int], prior: float, rates: list[tuple[float, float]]) -> float:
    """Chance of personal data given the votes."""
    yes, no = math.log(prior), math.log(1 - prior)
    for v, (p, q) in zip(votes, rates, strict=True):
        yes += math.log(p if v else 1 - p)
        no += math.log(q if v else 1 - q)
    return 1 / (1 + math.exp(min(700, no - yes)))


def expectation_maximisation(patterns: list[tuple[list[int], int]]) -> tuple[float, dict[str, tuple[float, float]]]:
    """Prior and reliabilities of the labelers from counted vote patterns.

    Starts from labelers that are right four times in five. One thought vote
    each way keeps rates inside (0, 1) where votes never differ.
    """
    prior, rates = 0.5, [(0.8, 0.2)] * len(LABELERS)
    total = sum(n for _, n in patterns)
    for _ in range(EM_ROUNDS if total else 0):
        weights = [(v, n, n * posterior(v, prior, rates)) for v, n in patterns]
        yes = sum(w for _, _, w in weights)
        new = []
        for k, (start_yes, start_no) in enumerate([(0.8, 0.2)] * len(LABELERS)):
            voted_yes = sum(w for v, _, w in weights if v[k])
            voted_no = sum(n - w for v, n, w in weights if v[k])
            new.append(((voted_yes + 2 * start_yes) / (yes + 2), (voted_no + 2 * start_no) / (total - yes + 2)))
        moved = max(abs(a - b) for x, y in zip(new, rates, strict=True) for a, b in zip(x, y, strict=True))
        prior, rates = (yes + 1) / (total + 2), new
        if moved < EM_TOLERANCE:
            break
    return prior, dict(zip(LABELERS, rates, strict=True))


def logistic(rows: list[tuple[list[int], int, float]]) -> list[float]:
    """Intercept and weights of a logistic regression on counted 0/1 features with soft labels."""
    width = len(LABELERS) + len(SHAPES)
    weights, total = [-1.0] + [0.0] * width, sum(n for _, n, _ in rows)
    for _ in range(FIT_ROUNDS if total else 0):
        slope = [0.0] * (width + 1)
        for features, n, label in rows:
            score = weights[0] + sum(w for w, x in zip(weights[1:], features, strict=True) if x)
            off = n * (1 / (1 + math.exp(-max(-700, min(700, score)))) - label) / total
            slope[0] += off
            for k, x in enumerate(features):
                slope[k + 1] += off * x
        weights = [w - FIT_RATE * (g + 1e-4 * w * (k > 0)) for k, (w, g) in enumerate(zip(weights, slope, strict=True))]
    return weights


def _probability(candidate: Column, model: Model) -> Column:
    score = F.lit(None).cast("double")
    for kind in reversed(KINDS):
        weights = model.weights[kind]
        own = F.lit(weights[0])
        for k, w in enumerate(weights[1:]):
            own = own + F.when(F.substring(candidate["votes"], k + 1, 1) == "1", F.lit(w)).otherwise(F.lit(0.0))
        score = F.when(candidate["kind"] == kind, own).otherwise(score)
    return 1 / (1 + F.exp(-score))


def with_spans(docs: DataFrame, model: Model, candidates: str = "candidates", column: str = "spans") -> DataFrame:
    """Adds the spans: base candidates, and others that the classifier takes."""
    kept = F.filter(candidates, lambda c: c["base"] | (_probability(c, model) >= THRESHOLD))
    return docs.withColumn(column, F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base"))))


def span_string(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(spans: str = "spans") -> list[Column]:
    """n_ of each kind and base_sha256 of the base spans, and all spans as a string."""
    base = F.filter(spans, lambda s: s["base"])
    counts = [F.size(F.filter(spans, _base_of(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return [*counts, F.sha2(span_string(base), 256).alias("base_sha256"), span_string(F.col(spans)).alias("spans")]


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; spans that overlap are one."""

    def parts(ordered: Column, cut, long: bool) -> Column:
        """The text before each span that lies behind those before it, and the span's kind; then the rest."""

        def reached(at: Column, s: Column) -> Column:
            return F.greatest(at, s["end"])

        def seen(at: Column, s: Column) -> Column:
            return F.struct(at.alias("at"), s["start"].alias("start"), s["kind"].alias("kind"))

        element = "struct<at:int,start:int,kind:string>"
        steps = folded_in_runs(ordered, reached, seen, element) if long else folded(ordered, F.lit(0), reached, seen, element)["out"]
        apart = F.filter(steps, lambda s: s["start"] >= s["at"])
        heads = F.transform(apart, lambda s: F.concat(cut(s["at"], s["start"] - s["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")))
        last = F.array_max(F.transform(ordered, lambda s: s["end"]))
        return F.concat(F.array_join(heads, ""), cut(last, F.char_length(text) - last))

    ordered = F.array_sort(spans, _by_start)
    short = parts(ordered, lambda start, length: F.substring(text, start + 1, length), False)
    long = let(in_pieces(text), lambda pieces: parts(ordered, lambda start, length: part(pieces, start, length), True))
    return F.when(F.size(spans) == 0, text).when(is_long(text), long).otherwise(short)
