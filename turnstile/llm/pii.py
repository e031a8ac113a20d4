"""Personal data by votes of simple labelers. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("shape", "gazetteer", "context", "form")

# Runs start where no run precedes, or where the last match ended, and never give back characters. This finds the same
# leftmost matches as the plain patterns, in time linear in the text.
_BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further candidates, which the votes decide on.
_EXTRA = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++"
    r"(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)|[0-9]{3})[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
# What a text must hold before a pattern is tried.
_NEEDS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]"}
_EXTRA_NEEDS = {"email": r"(?i)[\[(]at[\])]", "phone": r"[0-9]{3}[\x20.-][0-9]{4}"}

# Fixed word lists of the gazetteer and context labelers.
_DOMAINS = "com|org|net|edu|gov|info|biz|io|de|fr|es|uk|it|nl|eu|ch|at|be|us|ca|mx|ar|example|test|invalid"
_ISSUERS = "4|5[1-5]|2[2-7]|34|37|35|36|38|6011|64|65|62"
_CUES = {
    "email": r"e-?mail|mail|contact|write|address|correo|courriel|kontakt|adresse",
    "ip": r"\bip\b|host|server|addr|client|login|network|from",
    "card": r"card|visa|master|credit|debit|payment|tarjeta|carte|karte|account",
    "phone": r"phone|tel|call|mobile|fax|cell|contact|telefon|appel|llam|whatsapp",
}
_AGAINST = r"version|\bv$|release|isbn|issn|order|invoice|item|serial|section|chapter|figure|page|\bno\.?$|#$|token|key"

THRESHOLD = 0.5
_CONTEXT = 32


def _located(text: Column, pattern: str, needs: str) -> Column:
    """Matches in order with their start and the text before them, as structs (start, match, before)."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.when(
        F.contains(text, F.lit(needs)) if len(needs) == 1 else F.rlike(text, F.lit(needs)),
        F.arrays_zip(F.transform(gaps, lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(_CONTEXT)).alias("t"))).alias("g"), matches.alias("m")),
    )
    empty = F.struct(
        F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,match:string,before:string>>)").alias("all")
    )

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["g"]["n"]
        one = F.struct(start.alias("start"), pair["m"].alias("match"), pair["g"]["t"].alias("before"))
        # There is one gap more than matches.
        return F.when(pair["m"].isNull(), state).otherwise(
            F.struct((start + F.length(pair["m"])).alias("at"), F.concat(state["all"], F.array(one)).alias("all"))
        )

    return F.coalesce(F.aggregate(pairs, empty, add, lambda s: s["all"]), empty["all"])


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    """The checks of the base patterns."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return F.rlike(match, F.lit(rf"^{part}(?:\.{part}){{3}}$"))
    if kind == "card":
        return F.length(_digits(match)).between(12, 19) & F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _votes(kind: str, base: Column, match: Column, before: Column) -> list[Column]:
    """1 for, -1 against, 0 none: shape, gazetteer, context, form."""
    digits = _digits(match)
    known = {
        "email": F.rlike(match, F.lit(rf"(?i)\b(?:{_DOMAINS})$")),
        "ip": ~F.rlike(match, F.lit(r"^0*(?:0|127|22[4-9]|2[3-5][0-9])\.")),
        "card": F.rlike(digits, F.lit(f"^(?:{_ISSUERS})")),
        "phone": F.rlike(digits, F.lit("^[1-9]")),
    }[kind]
    left = F.lower(before)
    cue = F.when(F.rlike(left, F.lit(_CUES[kind])), 1).when(F.rlike(left, F.lit(_AGAINST)), -1).otherwise(0)
    plain = {
        "email": F.rlike(match, F.lit(r"^[A-Za-z0-9].*[A-Za-z]")),
        "ip": ~F.rlike(match, F.lit(r"(?:^|\.)0[0-9]")),
        "card": base & ~F.rlike(digits, F.lit(r"^([0-9])\1+$")),  # a wrong check digit speaks twice against a card
        "phone": ~F.rlike(digits, F.lit(r"^([0-9])\1+$")),
    }[kind]
    sign = lambda c: F.when(c, 1).otherwise(-1)
    return [sign(base), sign(known), cue, sign(plain)]


def _structs(kind: str, located: Column, extra: bool) -> Column:
    """(start, kind, end, base, votes..., length class) of each candidate."""

    def one(s: Column) -> Column:
        base = F.lit(False) if extra else _valid(kind, s["match"])
        votes = _votes(kind, base, s["match"], s["before"])
        return F.struct(
            s["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            (s["start"] + F.length(s["match"])).alias("end"),
            base.alias("base"),
            *(v.alias(name) for v, name in zip(votes, LABELERS, strict=True)),
            F.least(F.length(s["match"]).cast("int").bitwiseAND(~7), F.lit(40)).alias("size"),
        )

    wanted = located if kind != "card" else F.filter(located, lambda s: F.length(_digits(s["match"])).between(12, 19))
    found = F.transform(wanted, one)
    # Only cards may fail a check and still be candidates.
    return found if kind == "card" or extra else F.filter(found, lambda s: s["base"])


def candidates(text: Column) -> Column:
    """All candidate spans of a text, ordered by start and kind."""
    base = [_structs(k, _located(text, _BASE[k], _NEEDS[k]), False) for k in KINDS]
    extra = [_structs(k, _located(text, _EXTRA[k], _EXTRA_NEEDS[k]), True) for k in _EXTRA]
    return F.sort_array(F.concat(*base, *extra))


# --- reliabilities and classifier -------------------------------------------


def _patterns(spans: DataFrame) -> list[dict]:
    """How often each combination of kind, votes and length class occurs: 4 * 3**4 * 6 rows at most."""
    one = spans.select(F.explode("spans").alias("s"))
    columns = [F.col(f"s.{c}").alias(c) for c in ("kind", *LABELERS, "size")]
    return [r.asDict() for r in one.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(*("kind", *LABELERS, "size")).collect()]


def estimate(patterns: list[dict], rounds: int = 50) -> None:
    """Expectation-maximisation: adds to each pattern the probability `p` that such a span is personal data.

    Every labeler has, for each kind, its own chances to vote 1, 0 or -1 on true and on false spans. Votes start as
    majorities, and pseudo-counts hold that labelers are right more often than wrong.
    """
    for row in patterns:
        row["p"] = 1 / (1 + math.exp(-sum(row[v] for v in LABELERS)))
    for kind in {r["kind"] for r in patterns}:
        rows = [r for r in patterns if r["kind"] == kind]
        for _ in range(rounds):
            true = sum(r["n"] * r["p"] for r in rows)
            false = sum(r["n"] * (1 - r["p"]) for r in rows)
            prior = math.log((true + 2) / (false + 2))
            odds = {}
            for v in LABELERS:
                for x in (-1, 0, 1):
                    t = sum(r["n"] * r["p"] for r in rows if r[v] == x) + 2 + 2 * x
                    f = sum(r["n"] * (1 - r["p"]) for r in rows if r[v] == x) + 2 - 2 * x
                    odds[v, x] = math.log(((t + 0.1) / (true + 6.3)) / ((f + 0.1) / (false + 6.3)))
            for r in rows:
                r["p"] = 1 / (1 + math.exp(-max(-30, min(30, prior + sum(odds[v, r[v]] for v in LABELERS)))))


def _features(row: dict) -> list[tuple]:
    kind = row["kind"]
    return [("kind", kind), ("size", kind, row["size"]), *((v, kind, row[v]) for v in LABELERS)]


def fit(patterns: list[dict], rounds: int = 300, rate: float = 0.5, decay: float = 1e-3) -> dict[tuple, float]:
    """Weights of a logistic regression on kind, votes and length, learned from the estimated probabilities."""
    weights = {f: 0.0 for r in patterns for f in _features(r)}
    total = sum(r["n"] for r in patterns) or 1
    slope_sum = dict.fromkeys(weights, 1e-9)
    for _ in range(rounds):
        slope = {f: decay * w for f, w in weights.items()}
        for r in patterns:
            z = sum(weights[f] for f in _features(r))
            error = (1 / (1 + math.exp(-max(-30, min(30, z)))) - r["p"]) * r["n"] / total
            for f in _features(r):
                slope[f] += error
        for f, s in slope.items():  # steps scaled by the slopes seen so far
            slope_sum[f] += s * s
            weights[f] -= rate * s / math.sqrt(slope_sum[f])
    return weights


def train(docs: DataFrame, text_col: str = "text") -> dict[tuple, float]:
    """Weights of the span classifier, from the votes on all candidates of all texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    patterns = _patterns(docs.select(candidates(text).alias("spans")))
    estimate(patterns)
    return fit(patterns)


def _score(span: Column, weights: dict[tuple, float]) -> Column:
    total = F.lit(0.0)
    for feature, w in sorted(weights.items(), key=str):
        name, kind, value = (feature[0], feature[1], feature[1]) if len(feature) == 2 else feature
        total = total + F.when((span["kind"] == kind) & (span[name] == value), F.lit(w)).otherwise(0.0)
    return total


def accepted(spans: Column, weights: dict[tuple, float], threshold: float = THRESHOLD) -> Column:
    """Base spans, and candidates that the classifier accepts and no base span overlaps."""
    limit = math.log(threshold / (1 - threshold))
    extras = F.filter(spans, lambda s: ~s["base"] & (_score(s, weights) >= limit))
    base = F.filter(spans, lambda s: s["base"])
    # Without extras, the common case, nothing is compared.
    free = F.filter(extras, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.sort_array(F.concat(base, free))


# --- operator ----------------------------------------------------------------


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat(F.get(names, s["kind"]), F.lit(":"), s["start"], F.lit(":"), s["end"])
        ),
        ",",
    )


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for every row of docs.

    Regular expressions find spans of the four kinds that always stay, and looser candidates: written-out e-mail
    addresses, telephone numbers without +, card numbers with a wrong check digit. Labelers (shape, gazetteer,
    context, form) vote on all of them. Expectation-maximisation over the counts of vote patterns estimates how
    reliable each labeler is, and a logistic regression is trained on the resulting probabilities; it decides on the
    looser candidates. The driver sees only counts of patterns, whose number is fixed.

    `spans` lists kind:start:end by start and kind, in code points, end exclusive. Null texts count as empty and have
    no spans. Rows are judged one by one, so null ids, repeated rows and other columns do not matter. An empty table
    gives an empty result.
    """
    weights = train(docs, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), candidates(text).alias("all")).withColumn(
        "kept", accepted(F.col("all"), weights)
    )
    base = F.filter("all", lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter("all", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    added = F.size(F.filter("kept", lambda s: ~s["base"])).cast("long")
    return found.select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("kept")).alias("spans"),
        added.alias("n_added"),
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every span replaced by its kind in brackets; overlapping spans become one. Null texts stay null."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = accepted(candidates(text), train(docs, text_col))
    marks = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def replace(state: Column, s: Column) -> Column:
        before = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        fresh = F.struct(s["end"].alias("at"), F.concat(state["out"], before, F.get(marks, s["kind"])).alias("out"))
        longer = F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out"))
        return F.when(s["start"] >= state["at"], fresh).otherwise(longer)

    rest = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    clean = F.aggregate(spans, start, replace, rest)
    return docs.withColumn(text_col, F.when(F.col(text_col).isNotNull(), clean))
