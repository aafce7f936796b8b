"""Personal data by weak supervision.

Patterns propose spans. Four labelers vote on each or abstain: its form (checksums, ranges), a gazetteer (domains,
calling codes, issuers, given names), cue words before it, and what it touches. Expectation maximisation over the counts
of vote patterns estimates, for each kind, how reliable each labeler is and how likely each pattern is personal data.
These likelihoods train the final span classifier, a naive Bayes model over the span's shape, length and surroundings.
Spans of the base definition always stay; a proposed span that is not one of them stays if the classifier finds it at
least as likely as not.

Everything runs in column expressions. A text's spans are found and kept in its row; what leaves the rows are counts of
vote patterns and of features, whose number is fixed. All patterns take time in proportion to the text.

Null texts count as empty. Repeated rows are judged one by one. An empty table gives an empty result. Positions are in
code points, ends exclusive. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from premia.llm.common import ascii_lower, staged, text_or_empty

# The base definition. Possessive forms and the look-behind for the start of a run match the same text as
# the plain forms and keep the time linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"

# Given names of the gazetteer, by language.
GIVEN_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Thomas Sarah "
    "Hans Anna Peter Ursula Klaus Monika Wolfgang Petra Stefan Sabine Andreas Claudia Juergen Heike "
    "Jean Marie Pierre Nathalie Michel Isabelle Philippe Sylvie Alain Catherine Nicolas Sandrine "
    "Antonio Carmen Jose Maria Manuel Josefa Francisco Isabel Juan Pilar Javier Lucia"
).split()
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Sr", "Sra")
WEAK = {
    "local_phone": r"(?<![0-9A-Za-z+.(-])(?<!\+[0-9]{1,3}\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
    "national_id": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[0-9A-Z]{4}){3,7}(?![0-9A-Za-z])",
    "name": rf"(?<!\p{{L}})(?:(?:{'|'.join(TITLES)})\.?\x20\p{{Lu}}\p{{Ll}}{{1,30}}|(?:{'|'.join(GIVEN_NAMES)})\x20\p{{Lu}}\p{{Ll}}{{1,30}})(?!\p{{L}})",
    "credential": r"(?<![0-9A-Za-z])(?:AKIA[0-9A-Z]{16}|(?:password|passwd|token|secret|api_key)\x20?[=:]\x20?[\x22']?[0-9A-Za-z]{8,128})(?![0-9A-Za-z])",
}
#: Matches of the base patterns that fail their checks are proposed under these kinds.
FAILED = {"ip": "ip_like", "card": "card_like", "phone": "phone_like"}
KINDS = (*BASE, *WEAK, *FAILED.values())

CUES = {
    "email": r"e-?mail|mail|contact|write to|kontakt|correo|courriel",
    "ip": r"\bip\b|address|host|server|login|client|from",
    "card": r"card|visa|master|amex|karte|carte|tarjeta|payment|iban|account",
    "phone": r"phone|tel|call|mobile|fax|handy|anruf|llam|appel",
    "local_phone": r"phone|tel|call|mobile|fax|handy|anruf|llam|appel",
    "national_id": r"ssn|social|security|id no|ausweis|dni|insee",
    "iban": r"iban|konto|compte|cuenta|account|bank",
    "name": r"name|contact|dear|sincerely|regards|author|von|herr|frau|signed",
    "credential": r"key|secret|token|pass|login|auth|aws|=",
    "ip_like": r"\bip\b|address|host|server",
    "card_like": r"card|visa|master|amex|karte|carte|tarjeta",
    "phone_like": r"phone|tel|call|mobile|fax",
}
ANTI_CUES = r"version|release|section|chapter|isbn|issn|doi|order|invoice|page|fig\.|table|©|build"
LABELERS = ("form", "gazetteer", "cue", "touch")
CONTEXT = 40
CHUNK = 64
SHAPES = 256

SPAN = "struct<start:int,end:int,kind:string,base:boolean,votes:array<int>,features:array<string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _added(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def running(lengths: Column) -> Column:
    """Sum of the values before each one, from sums of ``CHUNK`` values so that long arrays stay cheap."""

    def of(x: Column, sums: Column) -> Column:
        def before(i: Column) -> Column:
            c = F.floor(i / CHUNK).cast("int")
            return _added(F.slice(sums, F.lit(1), c)) + _added(F.slice(x, c * CHUNK + 1, i - c * CHUNK))

        return F.transform(x, lambda _, i: before(i))

    def chunks(x: Column) -> Column:
        last = F.floor((F.size(x) - 1) / CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda j: _added(F.slice(x, j * CHUNK + 1, CHUNK)))

    return let(lengths, lambda x: let(chunks(x), lambda sums: of(x, sums)))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match, before, after>> of the leftmost matches that do not overlap."""

    def placed(found: Column, gaps: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.char_length(m) + F.char_length(F.element_at(gaps, i + 1)))

        def span(m: Column, i: Column, at: Column) -> Column:
            gap = F.element_at(gaps, i + 1)
            start = F.element_at(at, i + 1) + F.char_length(gap)
            return F.struct(
                start.alias("start"), (start + F.char_length(m)).alias("end"), m.alias("match"),
                F.right(gap, F.lit(CONTEXT)).alias("before"), F.left(F.element_at(gaps, i + 2), F.lit(CONTEXT)).alias("after"),
            )

        return let(running(steps), lambda at: F.transform(found, lambda m, i: span(m, i, at)))

    none = F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    out = let(found, lambda m: F.when(F.size(m) > 0, let(F.split(text, pattern, -1), lambda g: placed(m, g))).otherwise(none))
    return out


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def valid(kind: str, m: Column) -> Column:
    """The base definition's check."""
    n = F.length(_digits(m))
    if kind == "ip":
        return m.rlike(IP)
    if kind == "card":
        return F.when(n.between(12, 19), luhn(_digits(m))).otherwise(False)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _form(kind: str, m: Column, base: Column) -> Column:
    """1, 0, or -1 to abstain."""
    if kind == "email":
        return m.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@.*\.[A-Za-z]{2,24}$").cast("int")
    if kind in ("ip", "card", "phone", *FAILED.values()):
        return base.cast("int")
    if kind == "national_id":
        return (~m.rlike("^(?:000|666|9)|-00-|-0000$")).cast("int")
    if kind == "iban":
        return F.regexp_replace(m, " ", "").rlike("^[A-Z]{2}(?!0[01])[0-9]{2}[0-9A-Z]{11,30}$").cast("int")
    return F.lit(1) if kind == "credential" else F.lit(-1)


def _gazetteer(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.when(m.rlike(r"\.(?:com|org|net|edu|gov|io|de|fr|es|uk|eu|info)$"), 1).otherwise(-1)
    if kind in ("ip", "ip_like"):
        return (~m.rlike(r"^(?:0|10|127|22[4-9]|23[0-9]|24[0-9]|25[0-9])\.|^192\.168\.|^169\.254\.")).cast("int")
    if kind in ("card", "card_like"):
        return _digits(m).rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)").cast("int")
    if kind in ("phone", "phone_like"):
        return F.when(m.rlike(r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"), 1).otherwise(0)
    if kind == "local_phone":
        return m.rlike(r"^\(?[2-9]").cast("int")
    if kind == "iban":
        return m.rlike("^(?:DE|FR|ES|IT|NL|BE|AT|CH|GB|IE|PT|PL|SE|DK|FI|LU)").cast("int")
    if kind == "name":
        return F.when(m.rlike("|".join(GIVEN_NAMES)), 1).otherwise(-1)
    return F.lit(-1)


def _shape(m: Column) -> Column:
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(m, r"\p{Lu}+", "A"), r"\p{Ll}+", "a"), "[0-9]", "9")
    return F.pmod(F.xxhash64(kinds), F.lit(SHAPES)).cast("string")


def _span(kind: str, s: Column, base: Column, proposed: bool) -> Column:
    m, before, after = s["match"], ascii_lower(s["before"]), s["after"]
    cue = F.when(before.rlike(CUES[kind]), 1).when(before.rlike(ANTI_CUES), 0).otherwise(-1)
    touches = s["before"].rlike(r"[\p{L}\p{N}_./=-]$") | after.rlike(r"^[\p{L}\p{N}_/=-]")
    word = F.regexp_extract(before, r"(\p{L}+)[^\p{L}]*$", 1)
    features = F.array(
        F.concat(F.lit("shape "), _shape(m)),
        F.concat(F.lit("length "), F.least(F.floor(F.log2(F.char_length(m))), F.lit(8)).cast("string")),
        F.concat(F.lit("word "), F.pmod(F.xxhash64(word), F.lit(SHAPES)).cast("string")),
        F.concat(F.lit("mark "), F.regexp_extract(s["before"], r"([^\p{L}\p{N}\s])\s*$", 1) != "", F.lit(" "), touches),
    )
    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), (F.lit(False) if proposed else base).alias("base"),
        F.array(_form(kind, m, base), _gazetteer(kind, m), cue, F.when(touches, 0).otherwise(1)).alias("votes"),
        features.alias("features"),
    )


def proposals(docs: DataFrame) -> DataFrame:
    """doc_id, spans: every span that a pattern proposes, with its votes and features."""
    text = text_or_empty()

    def checked(kind: str) -> Callable[[Column], Column]:
        return lambda s: let(valid(kind, s["match"]), lambda ok: F.when(ok, _span(kind, s, ok, False)))

    def failed(kind: str) -> Callable[[Column], Column]:
        n = lambda s: F.length(_digits(s["match"]))
        near = {"ip": lambda s: n(s) >= 4, "card": lambda s: n(s).between(12, 19), "phone": lambda s: n(s).between(7, 17)}[kind]
        return lambda s: near(s) & ~valid(kind, s["match"])

    def proposed(kind: str, base: bool) -> Callable[[Column], Column]:
        return lambda s: _span(kind, s, F.lit(base), True)

    out = []
    for kind, pattern in BASE.items():
        found = F.when(text.contains("@"), matches(text, pattern)) if kind == "email" else matches(text, pattern)
        out.append(F.filter(F.transform(found, checked(kind)), lambda s: s.isNotNull()))
        if kind in FAILED:
            out.append(F.transform(F.filter(found, failed(kind)), proposed(FAILED[kind], False)))
    for kind, pattern in WEAK.items():
        out.append(F.transform(matches(text, pattern), proposed(kind, True)))
    none = F.array().cast(f"array<{SPAN}>")
    return docs.select("doc_id", F.concat(*[F.coalesce(x.cast(f"array<{SPAN}>"), none) for x in out]).alias("spans"))


Pattern = tuple[str, tuple[int, ...]]


def reliabilities(counts: dict[Pattern, int], rounds: int = 60) -> tuple[dict[Pattern, float], dict[str, list[tuple[float, float]]]]:
    """Likelihood of each (kind, votes) and each labeler's rate of yes on personal and on other spans, by kind."""
    posterior: dict[Pattern, float] = {}
    rates: dict[str, list[tuple[float, float]]] = {}
    for kind in {k for k, _ in counts}:
        mine = {v: n for (k, v), n in counts.items() if k == kind}
        # Start from the majority; priors say that labelers are right more often than not.
        p = {v: (1 + sum(x for x in v if x > 0)) / (2 + sum(x >= 0 for x in v)) for v in mine}
        for _ in range(rounds):
            yes = sum(n * p[v] for v, n in mine.items())
            no = sum(mine.values()) - yes
            prior = (yes + 2) / (yes + no + 4)
            rates[kind] = []
            for j in range(len(LABELERS)):
                a = (8 + sum(n * p[v] for v, n in mine.items() if v[j] == 1)) / (10 + sum(n * p[v] for v, n in mine.items() if v[j] >= 0))
                b = (2 + sum(n * (1 - p[v]) for v, n in mine.items() if v[j] == 1)) / (
                    10 + sum(n * (1 - p[v]) for v, n in mine.items() if v[j] >= 0)
                )
                rates[kind].append((a, b))
            for v in mine:
                odds = math.log(prior / (1 - prior))
                for x, (a, b) in zip(v, rates[kind]):
                    odds += 0 if x < 0 else math.log(a / b) if x else math.log((1 - a) / (1 - b))
                p[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        posterior |= {(kind, v): q for v, q in p.items()}
    return posterior, rates


def _key(s: Column) -> Column:
    return F.concat_ws(" ", s["kind"], F.array_join(F.transform(s["votes"], lambda v: v.cast("string")), " "))


def classifier(found: DataFrame) -> dict[str, float]:
    """Log odds by kind, and by kind and feature, trained on the estimated likelihoods of all spans.

    Collected are counts of vote patterns (at most 81 for each kind) and of features (under 600 for each kind).
    """
    spans = found.select(F.explode("spans").alias("s"))
    rows = spans.groupBy(F.col("s.kind").alias("kind"), F.col("s.votes").alias("votes")).count().collect()
    posterior, _ = reliabilities({(r["kind"], tuple(r["votes"])): r["count"] for r in rows})
    if not posterior:
        return {}
    known = F.create_map(*[x for (k, v), p in sorted(posterior.items()) for x in (F.lit(" ".join([k, *map(str, v)])), F.lit(p))])
    scored = spans.select(F.col("s.kind").alias("kind"), F.explode(F.concat(F.array(F.lit("")), F.col("s.features"))).alias("feature"), known[_key(F.col("s"))].alias("p"))
    out: dict[str, float] = {}
    sums = {(r["kind"], r["feature"]): (r["yes"], r["n"]) for r in scored.groupBy("kind", "feature").agg(F.sum("p").alias("yes"), F.count("*").alias("n")).collect()}
    for (kind, feature), (yes, n) in sums.items():
        all_yes, all_n = sums[kind, ""]
        if feature == "":
            out[kind] = math.log((yes + 1) / (n - yes + 1))
        else:
            out[f"{kind} {feature}"] = math.log((yes + 1) / (all_yes + 2)) - math.log((n - yes + 1) / (all_n - all_yes + 2))
    return out


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, spans: array<struct<start, end, kind, base>> in order of start, then kind as listed in ``KINDS``."""
    found = staged(proposals(docs))
    weights = classifier(found)
    table = F.create_map(*[x for k, w in sorted(weights.items()) for x in (F.lit(k), F.lit(w))]) if weights else None

    def odds(s: Column) -> Column:
        of = lambda key: F.coalesce(F.try_element_at(table, key), F.lit(0.0))
        return F.aggregate(s["features"], of(s["kind"]), lambda a, f: a + of(F.concat_ws(" ", s["kind"], f)))

    stays = F.col("spans") if table is None else F.filter("spans", lambda s: s["base"] | (odds(s) >= 0))
    place = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(
        F.transform(stays, lambda s: F.struct(s["start"].alias("start"), F.array_position(place, s["kind"]).alias("n"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base")))
    )
    return found.select("doc_id", F.transform(ordered, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base"))).alias("spans"))


def joined(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digested(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda kind: lambda s: s["kind"] == kind
    return found.select(
        "doc_id",
        *[F.size(F.filter(base, of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
